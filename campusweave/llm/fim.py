"""Fill-in-middle: texts cut into prefix, middle and suffix, and put together in another order.

Texts are never moved whole. A task cuts its texts into pieces of at most CHUNK units, keyed by document and by place
in the output; `repartitionAndSortWithinPartitions` brings a document's pieces together in output order, and they stream
into the output (or its digest) piece by piece. For restoration the output's own sentinels are found in that stream, each piece is
keyed by its place in the text, and the pieces are sorted again. Both sorts have the same partitioner, so the second one moves nothing
between machines, and both go to disk beyond the worker's memory. A task holds pieces, however long the text is.

A document's key is a hash of doc_id, text and the number of the task that read it: it does not hang on the order of rows, so a task that runs
again makes the same keys. Rows that repeat within a task share their pieces and are told apart by their number.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 4096
#: Bytes of text for each partition of the sorted pieces.
PART_BYTES = 16_000_000
HEAD = -1


@dataclass(frozen=True)
class Recipe:
    """What decides cuts and forms: a seed, shares of a hundred, sentinels, and a pattern of units (None: code points).

    With a pattern, units are its matches from left to right; what lies before a match belongs to that unit, and what
    follows the last match to the last one.
    """

    seed: str = "1"
    plain_from: int = 90
    spm_below: int = 20
    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    unit: str | None = None

    def __post_init__(self):
        for a in self.sentinels:
            for b in self.sentinels:
                meets = any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b)))
                if not a or not b or meets or (a != b and a in b):
                    raise ValueError("sentinels must not be empty, hold each other or begin as one of them ends")

    def ends(self, text: str) -> list[int] | None:
        """Where each unit ends; None if units are code points."""
        if self.unit is None:
            return None
        ends = [m.end() for m in re.finditer(self.unit, text) if m.end() > m.start()]
        return [*ends[:-1], len(text)] if ends else [len(text)] * bool(text)

    def cut(self, doc_id: int | None, text: str) -> tuple[int, str, int, int]:
        """Units, form, and the code points before the middle's begin and end."""
        ends = self.ends(text)
        n = len(text) if ends is None else len(ends)
        drawn = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = [int(drawn[i : i + 8], 16) for i in (0, 8, 16, 24)]
        low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        if ends is not None:
            low, high = ([0, *ends][i] for i in (low, high))
        if not text or any(s in text for s in self.sentinels) or h[2] % 100 >= self.plain_from:
            return n, "plain", 0, 0
        return n, "spm" if h[3] % 100 < self.spm_below else "psm", low, high

    def layout(self, form: str) -> list[tuple[str, int]]:
        """Sentinels of a form in output order, each with the rank in the text of what follows it."""
        p, s, m = self.sentinels
        return {"psm": [(p, 0), (s, 2), (m, 1)], "spm": [(s, 2), (p, 0), (m, 1)], "plain": []}[form]

    def output(self, form: str, text: str, low: int, high: int) -> Iterator[str]:
        """The output's pieces in order."""
        if form == "plain":
            spans = [("", 0, len(text))]
        else:
            where = [(0, low), (low, high), (high, len(text))]
            spans = [(mark, *where[rank]) for mark, rank in self.layout(form)]
        for mark, begin, end in spans:
            yield mark + text[begin : min(end, begin + CHUNK)]
            for at in range(begin + CHUNK, end, CHUNK):
                yield text[at : min(end, at + CHUNK)]

    def parts(self, form: str, pieces: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
        """An output's pieces without its sentinels, each with its part's rank in the text, from output and form alone.

        A text that is not plain holds no sentinel, so the first one found is the one put there, also across pieces.
        """
        marks = [(mark.encode(), rank) for mark, rank in self.layout(form)]
        rank, held = 0, b""
        for data in pieces:
            data = held + data
            while marks:
                mark = marks[0][0]
                at = data.find(mark)
                if at < 0:
                    break
                yield rank, data[:at]
                data, rank = data[at + len(mark) :], marks.pop(0)[1]
            keep = len(marks[0][0]) - 1 if marks else 0
            held = data[max(0, len(data) - keep) :] if keep else b""
            yield rank, data[: len(data) - len(held)]
        yield rank, held


def _home(key: tuple[bytes, int]) -> int:
    """Pieces of a document go to one partition; partitionBy takes this modulo their number."""
    return int.from_bytes(key[0][:7], "big")


def pieces(docs: DataFrame, recipe: Recipe) -> RDD:
    """((document, place), piece) of every output; at place HEAD its (doc_id, n, form, prefix_chars, middle_chars)."""

    def emit(number: int, rows: Iterable) -> Iterator:
        for doc_id, text in rows:
            n, form, low, high = recipe.cut(doc_id, text)
            key = hashlib.blake2b(f"{number}:{doc_id}:{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
            yield (key, HEAD), (doc_id, n, form, *((None, None) if form == "plain" else (low, high - low)))
            place = 0
            for piece in recipe.output(form, text, low, high):
                yield (key, place), piece.encode()
                place += len(piece)

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))
    return texts.rdd.mapPartitionsWithIndex(emit)


def _partitions(docs: DataFrame) -> int:
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1, -(-total // PART_BYTES))


def _documents(rows: Iterable) -> Iterator[tuple[bytes, tuple, int, Iterator[bytes]]]:
    """Sorted pieces as (document, head, number of equal rows, its pieces in order, once each)."""

    def once(first, rest):
        place = None
        if first is not None:
            place = first[0][1]
            yield first[1]
        for (_, at), piece in rest:
            if at != place:
                place = at
                yield piece

    for key, group in groupby(rows, key=lambda row: row[0][0]):
        (_, head), copies, first = next(group), 1, None
        for row in group:
            if row[0][1] != HEAD:
                first = row
                break
            copies += 1
        stream = once(first, group)
        yield key, head, copies, stream
        for _ in stream:
            pass


def _sorted(rows: RDD, partitions: int) -> RDD:
    return rows.repartitionAndSortWithinPartitions(partitions, _home)


def transformed(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output (the whole transformed text) of every row; cases as in `digests`."""

    def whole(rows):
        for _, head, copies, stream in _documents(rows):
            output = b"".join(stream).decode()
            for _ in range(copies):
                yield (*head, output)

    rows = _sorted(pieces(docs, recipe), _partitions(docs)).mapPartitions(whole, True)
    return docs.sparkSession.createDataFrame(rows, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, recipe: Recipe = Recipe()) -> Column:
    """The text, from output and form."""
    p, s, m = recipe.sentinels

    def between(start: str, end: str | None) -> Column:
        tail = F.substring_index(output, start, -1)
        return F.substring_index(tail, end, 1) if end else tail

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if plain), output_sha256 and restored_sha256
    (of the text rebuilt from output and form; lowercase hex of UTF-8) of every row of docs (doc_id, text).

    A null text is empty; empty texts and those that hold a sentinel stay plain. A null doc_id is hashed as no digits.
    Each of several equal rows has a row; rows that share a doc_id but not the text stand alone. Other columns are
    left behind. An empty table gives an empty result.
    """
    partitions = _partitions(docs)

    def outputs(rows):
        for key, head, copies, stream in _documents(rows):
            digest = hashlib.sha256()

            def passed(stream=stream, digest=digest):
                for piece in stream:
                    digest.update(piece)
                    yield piece

            place = [0, 0, 0]
            for rank, piece in recipe.parts(head[2], passed()):
                if piece:
                    yield (key, (rank << 48) + place[rank]), piece
                    place[rank] += len(piece)
            for _ in range(copies):
                yield (key, HEAD), (*head, digest.hexdigest())

    def texts(rows):
        for _, head, copies, stream in _documents(rows):
            digest = hashlib.sha256()
            for piece in stream:
                digest.update(piece)
            for _ in range(copies):
                yield (*head, digest.hexdigest())

    ordered = _sorted(pieces(docs, recipe), partitions)
    again = _sorted(ordered.mapPartitions(outputs, preservesPartitioning=True), partitions)
    return docs.sparkSession.createDataFrame(
        again.mapPartitions(texts), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    )


#: DuckDB SQL of `digests` with the usual recipe.
ORACLE = """WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || CAST(doc_id AS STRING)) AS h FROM documents),
 d AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS b, CAST('0x' || h[17:24] AS BIGINT) % 100 AS c, CAST('0x' || h[25:32] AS BIGINT) % 100 AS e FROM t),
 f AS (SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form,
 substr(text, 1, least(a, b)) AS prefix, substr(text, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle, substr(text, greatest(a, b) + 1) AS suffix FROM d)
 SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
 sha256(text) AS restored_sha256 FROM f"""
