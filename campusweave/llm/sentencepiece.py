"""SentencePiece encoding and decoding by a batched Viterbi pass in numpy.

A text is cut where no piece can reach across: before a run of spaces, and around characters that no
piece holds. Units of like length go through the lattice together, one position at a time. Hashes of all
substrings that end there come from running polynomial sums and probe the sorted hashes of the pieces,
those that a table of bits lets through; a vectorised choice among the arcs that are allowed stores score
and backpointer.

The given model is of the merging kind (BPE), whose encoding is not the path of greatest summed score. It
is a path all the same: of each prefix of a unit exactly one last piece is right, the one that merging
leaves next to the last piece of what is before it (merging both strings alone gives the two pieces). So
an arc is allowed if its piece stands that test with the backpointer's piece, answers are kept by pair,
and ids equal the library's. For a unigram model all arcs are allowed and scores are summed.
Characters without a piece become byte pieces.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from campusweave.llm import words
from campusweave.llm.common import by_step, texts

#: Path of the model file that queries take, a parameter of all functions.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Units and piece pairs kept by a worker, of pairs as bits of their number. A full store of units becomes the older one, from which those in use come back; a pair gives way to one of its place.
UNITS, PAIRS = 250_000, 21
#: Bits of a piece's hash in the table that most substrings fail, and numbers of a lattice.
FIRST, LATTICE = 22, 400_000
#: Ids from here on stand for a character without a piece.
LOOSE = 1 << 24
U = np.uint64


class Pieces:
    """A vocabulary as plain values that tasks can be sent: pieces, scores, and which kind of model."""

    def __init__(self, pieces: list[str], scores: list[float], usable: list[bool], merging: bool):
        self.pieces, self.merging = pieces, merging
        self.score = {p: s for p, s, ok in zip(pieces, scores, usable, strict=True) if ok}
        self.id = {p: i for i, (p, ok) in enumerate(zip(pieces, usable, strict=True)) if ok}
        self.byte = {i: int(p[1:-1], 16) for i, p in enumerate(pieces) if not usable[i] and re.fullmatch(r"<0x[0-9A-F]{2}>", p)}
        self.raw = [bytes([self.byte[i]]) if i in self.byte else p.replace(SPACE, " ").encode() if ok else b"" for i, (p, ok) in enumerate(zip(pieces, usable, strict=True))]
        self.of_byte = {b: i for i, b in self.byte.items()}
        self.unknown = next((i for i, p in enumerate(pieces) if p == "<unk>"), 0)


def load(path: str = MODEL) -> Pieces:
    """The pieces of a model file, read at the driver; they are bounded by the vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    usable = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)]
    pieces, scores = [model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)]
    # scores of a merging model are the negative numbers of its merges
    merging = all(s == round(s) for s, ok in zip(scores, usable, strict=True) if ok)
    return Pieces(pieces, scores, usable, merging)


class Encoder:
    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.longest = max(map(len, pieces.id), default=1)
        names = list(pieces.id)
        keys = np.array([self._hash(x) for x in names], U)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([pieces.id[x] for x in names], np.int64)[order]
        self.scores = np.zeros(len(pieces.pieces) + 1)
        for name, i in pieces.id.items():
            self.scores[i] = pieces.score[name]
        self.low = min(pieces.score.values(), default=0.0) - 10
        held = set("".join(names))
        # a piece with a space after another character would reach across a cut
        self.cuts = not any(SPACE in x.lstrip(SPACE) for x in names)
        self.break_at = "".join(c for c in "\n\t\r\v\f" if c not in held)
        own = re.escape(self.break_at)
        self.unit = re.compile(f"[{own}]|{SPACE}+[^{SPACE}{own}]*|[^{SPACE}{own}]+" if own else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.units: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.maybe = np.zeros(1 << FIRST, bool)
        self.maybe[self.keys >> U(64 - FIRST)] = True
        self.held, self.answer = np.full(1 << PAIRS, -1, np.int64), np.zeros(1 << PAIRS, bool)

    def _hash(self, text: str) -> int:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
        return int(words.mix(np.array([(words.mix(points + U(1)) * words.powers(len(points))[0][: len(points)]).sum(dtype=U)]) + U(len(points)))[0])

    def text_of(self, token: int) -> str:
        return chr(token - LOOSE) if token >= LOOSE else self.p.pieces[token]

    def stays(self, left: str, right: str) -> bool:
        """Whether merging leaves two strings as they are: again and again the pair of best score, the leftmost of equals, and never one across."""
        parts, get, none = [*left, *right], self.p.score.get, -np.inf
        if left and left + right in self.p.score:
            return False
        edge, scores = len(left) - 1, [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            if i == edge:
                return False
            edge -= i < edge
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], none)
        return parts == ([left] if left else []) + [right]

    def allowed(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether merging leaves these neighbours as they are; before is -1 at the start of a unit."""
        code = ((before + 1) << 26) | token
        place = lambda c: words.mix(c.view(U)) >> U(64 - PAIRS)
        at = place(code)
        answers, fresh = self.answer[at], np.flatnonzero(self.held[at] != code)
        if len(fresh):
            rest = np.unique(code[fresh])
            pairs = ((self.text_of((c >> 26) - 1) if c >> 26 else "", self.text_of(c & ((1 << 26) - 1))) for c in rest.tolist())
            found = np.fromiter((self.stays(*p) for p in pairs), bool, len(rest))
            answers[fresh] = found[np.searchsorted(rest, code[fresh])]
            at, one = np.unique(place(rest), return_index=True)
            self.held[at], self.answer[at] = rest[one], found[one]
        return answers

    def viterbi(self, units: list[str]) -> list[tuple[int, ...]]:
        """Ids of units, the longest first."""
        sizes, n = np.array([len(u) for u in units]), len(units)
        size = int(sizes[0])
        points = np.zeros((n, size), np.int64)
        points[np.arange(size) < sizes[:, None]] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        up, down = words.powers(size + 1)
        total = np.zeros((n, size + 1), U)
        np.cumsum(words.mix(points.astype(U) + U(1)) * up[:size], axis=1, out=total[:, 1:])
        last = np.full((n, size + 1), -2, np.int64)
        back = np.zeros((n, size + 1), np.int32)
        best = np.full((n, size + 1), -np.inf)
        last[:, 0], best[:, 0] = -1, 0
        long = n - np.searchsorted(sizes[::-1], np.arange(size + 1))  # units of so many characters
        for end in range(1, size + 1):
            first, m = max(0, end - self.longest), long[end]
            key = words.mix((total[:m, end, None] - total[:m, first:end]) * down[first:end] + np.arange(end - first, 0, -1).astype(U))
            some = self.maybe[key >> U(64 - FIRST)]
            some[:, -1] = True  # a character is an arc, with a piece or without
            rows, start = np.nonzero(some)
            key, start = key[rows, start], start + first
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            token = np.where(hit, self.ids[at], LOOSE + points[rows, end - 1])
            real = hit | (start == end - 1)
            rows, start, token, hit = rows[real], start[real], token[real], hit[real]
            if self.p.merging:  # one arc is allowed: a unit's arcs are tried from the longest on
                now = np.flatnonzero(np.diff(rows, prepend=-1))
                stop = np.append(now[1:], len(rows))
                while len(now):
                    before = last[rows[now], start[now]]
                    fits = (before > -2) & self.allowed(before, token[now])
                    took = now[fits]
                    last[rows[took], end], back[rows[took], end] = token[took], start[took]
                    now, stop = now[~fits] + 1, stop[~fits]
                    now, stop = now[now < stop], stop[now < stop]
            else:
                reach = best[rows, start] + np.where(hit, self.scores[np.where(hit, token, 0)], self.low)
                order = np.lexsort((start, -reach, rows))
                took = order[np.flatnonzero(np.diff(rows[order], prepend=-1))]
                best[rows[took], end], last[rows[took], end], back[rows[took], end] = reach[took], token[took], start[took]
        row, found, at = [], [], sizes.copy()
        while (open_ := np.flatnonzero(at > 0)).size:
            row.append(open_)
            found.append(last[open_, at[open_]])
            at[open_] = back[open_, at[open_]]
        row, found = np.concatenate(row[::-1]), np.concatenate(found[::-1])
        order = np.argsort(row, kind="stable")
        row, found = row[order], found[order]
        ends = np.searchsorted(row, np.arange(n + 1)).tolist()
        flat = found.tolist()
        out = [tuple(flat[i:j]) for i, j in zip(ends, ends[1:], strict=False)]
        for i in np.unique(row[found >= LOOSE]).tolist():
            out[i] = self._bytes(out[i])
        return out

    def _bytes(self, tokens: tuple[int, ...]) -> tuple[int, ...]:
        out = []
        for t in tokens:
            if t < LOOSE:
                out.append(t)
            else:
                out += [self.p.of_byte.get(b, self.p.unknown) for b in chr(t - LOOSE).encode("utf-8", "replace")]
        return tuple(out)

    def encode(self, batch: list[str]) -> list[list[int]]:
        """Ids of each text; an empty one has none. One space is put before a text, as the library does."""
        cut = [self.unit.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in batch]
        if not self.cuts:
            cut = [["".join(c)] if c else [] for c in cut]
        if len(self.units) > UNITS:
            self.older, self.units = self.units, {}
        fresh: dict[int, list[str]] = {}
        for unit in set().union(*cut) - self.units.keys():
            if unit in self.older:
                self.units[unit] = self.older[unit]
            else:
                fresh.setdefault(len(unit).bit_length(), []).append(unit)
        for units in fresh.values():
            units.sort(key=len, reverse=True)
            step = max(1, LATTICE // len(units[0]))
            for i in range(0, len(units), step):
                self.units.update(zip(units[i : i + step], self.viterbi(units[i : i + step]), strict=True))
        known = self.units.__getitem__
        return [list(chain.from_iterable(map(known, c))) for c in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: spaces for their sign, bytes put together, the space before the text taken off."""
        raw = self.p.raw
        out = b"".join(map(raw.__getitem__, ids))
        return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


_encoders: dict[int, Encoder] = {}


def encoder(pieces: Pieces) -> Encoder:
    """One for each vocabulary and worker: what it has learnt serves the next task."""
    key = hash((len(pieces.pieces), tuple(pieces.pieces[-50:]), pieces.merging))
    if key not in _encoders:
        _encoders[key] = Encoder(pieces)
    return _encoders[key]


def encoded(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids, n_tokens, and whether the ids decode to the text, for every row of `docs` (doc_id, text).

    Null and empty texts have no ids and decode to the empty text. A text with the space sign itself (U+2581) decodes to a
    space in its place, as in the library, and round_trip is false for it. Rows that repeat a doc_id each give a row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))  # bounded by the vocabulary

    def run(batch):
        coder = encoder(shared.value)
        plain = [t.decode() for t in batch.column("text").to_pylist()]
        found = coder.encode(plain)
        same = [coder.decode(i) == t for i, t in zip(found, plain, strict=True)]
        rows = [np.array(i, np.int32) for i in found]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), words.lists(rows, pa.int32()), pa.array([len(i) for i in found], pa.int32()), pa.array(same)], ["doc_id", "ids", "n_tokens", "round_trip"])

    return by_step(texts(docs), run, "doc_id long, ids array<int>, n_tokens int, round_trip boolean")


def decoded(tokens: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and text from doc_id and ids; null and empty ids give the empty text, ids outside the vocabulary are left out."""
    shared = tokens.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        coder = encoder(shared.value)
        n = len(shared.value.pieces)
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            plain = [coder.decode([i for i in r or [] if i is not None and 0 <= i < n]) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(plain, pa.string())], ["doc_id", "text"])

    return tokens.select(tokens["doc_id"].cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
