"""Language-model scores by Brown's class-based bigrams (Brown et al., 1992).

Words of the training texts are counted and every one of them gets a class by the mutual information of
neighbouring classes; unknown words and a text's end have classes of their own. A text's log10 probability
is the sum over its tokens of the class transition and the word's emission in its class, transitions smoothed.

Exchange: the most frequent words settle first. Each turn counts, for every one of them, the classes before
and after it (a Spark job over the table of word pairs), and moves it to the class where the pairs' mutual
information is greatest given the class counts of the turn before; half of the words may move in a turn, so
that two words do not swap for ever. It ends when neither half moves or after TURNS turns. All other words
are then put in by the same measure, as Brown et al. put in theirs by falling frequency: a job counts the
classes on both sides of each, words that are not yet in being one class, and each goes where it adds most.

What is broadcast has a proven bound: words whose count is at least N / SHARE are at most SHARE many.
Tokens of other words are joined with their classes and put back at their places, so that transitions are
counted and scored between the classes of all words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.llm import words
from campusweave.llm.common import by_step, cut, steps, texts, whole_groups

#: Words with at least 1 / SHARE of all tokens go to tasks as a table; at most SHARE words.
SHARE = 100_000
#: Words that settle before the others are put in (the most frequent ones), classes, and turns of exchange.
CLUSTERED, CLASSES, TURNS = 2_000, 48, 8
#: In a text's classes: a word that the join has yet to bring.
OPEN = 255
#: Weight of the add-constant smoothing of transitions, and of the mass kept for words not seen.
TRANSITION = 0.5
U = np.uint64
#: The end of a text is a token; its hash is that of no word but for a chance of 2^-64.
END = int(words.mix(np.array([0x5E17], U)).view(np.int64)[0])


def _summed(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    distinct, back = np.unique(keys, return_inverse=True)
    return distinct, *(np.bincount(back, w, len(distinct)).astype(np.int64) for w in weights)


def counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word, as its hash, and the end occur in the texts of `docs`."""

    def run(batch):
        w = words.split(batch.column("text"))
        key, n = np.unique(words.signed(w.hash), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(np.append(key, END)), pa.array(np.append(n, batch.num_rows))], ["word", "n"])

    return by_step(texts(docs), run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lookup:
    """Word hashes, sorted, with what is known of each."""

    def __init__(self, keys, **values):
        order = np.argsort(keys)
        self.keys = np.asarray(keys, np.int64)[order]
        self.values = {k: np.asarray(v)[order] for k, v in values.items()}

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return at, self.keys[at] == hashes


def _sequence(batch: pa.RecordBatch, known: Lookup) -> tuple[words.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, and of all tokens with the ends in place: hash, place in `known` or -1, and text number."""
    w = words.split(batch.column("text"))
    ends = w.first[1:] + np.arange(batch.num_rows)
    n = len(w.hash) + batch.num_rows
    hashes = np.full(n, END, np.int64)
    inside = np.ones(n, bool)
    inside[ends] = False
    hashes[inside] = words.signed(w.hash)
    at, hit = known.find(hashes)
    text = np.repeat(np.arange(batch.num_rows), np.diff(w.first) + 1)
    return w, hashes, np.where(hit, at, -1), text


def pairs(docs: DataFrame, known: Lookup, groups: int) -> DataFrame:
    """(a, b, n): counts of neighbouring tokens by their group; a text begins after an end."""
    group = known.values["group"]
    end = int(group[known.find(np.array([END]))[0][0]])

    def run(batch):
        _, _, at, text = _sequence(batch, known)
        mine = np.where(at >= 0, group[np.maximum(at, 0)], groups - 1)
        before = np.concatenate([[end], mine[:-1]])
        key, n = np.unique(before * groups + mine, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array((key // groups).astype(np.int32)), pa.array((key % groups).astype(np.int32)), pa.array(n)], ["a", "b", "n"])

    return by_step(texts(docs), run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def exchange(pair_counts: DataFrame, n: int, classes: int = CLASSES, turns: int = TURNS) -> np.ndarray:
    """Classes of the words 0 to n - 1, which are in order of falling count; words from n on are in classes of their own.

    pair_counts (a, b, n) is bounded by the square of the number of clustered words.
    """
    spark = pair_counts.sparkSession
    own = classes + np.arange(pair_counts.agg(F.max(F.greatest("a", "b"))).first()[0] + 1 - n if n else 0)
    of = np.concatenate([np.arange(n) % classes, own]).astype(np.int64)
    total = classes + len(own)
    still = 0  # turns on end in which no word of their half moved
    for turn in range(turns):
        table = cut(spark.createDataFrame([(i, int(c)) for i, c in enumerate(of)], "word int, class int"), "classes")
        right = pair_counts.join(table.select(F.col("word").alias("b"), F.col("class").alias("cb")), "b")
        both = right.join(table.select(F.col("word").alias("a"), F.col("class").alias("ca")), "a")
        matrix = np.zeros((total, total))
        for r in both.groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():  # one row for each pair of classes
            matrix[r["ca"], r["cb"]] = r["n"]
        after = both.groupBy(F.col("a").alias("word"), F.col("cb").alias("class")).agg(F.sum("n").alias("out"), F.sum(F.lit(0)).alias("into"))
        before = both.groupBy(F.col("b").alias("word"), F.col("ca").alias("class")).agg(F.sum(F.lit(0)).alias("out"), F.sum("n").alias("into"))
        around = after.unionByName(before).where(F.col("word") < n).where(F.pmod(F.xxhash64("word"), F.lit(2)) == turn % 2)
        profile = around.groupBy("word").agg(F.collect_list(F.struct("class", "out", "into")).alias("near"))  # as many as classes, twice
        moved = profile.mapInArrow(_moves(matrix, of, classes), "word int, class int")
        found = {r["word"]: r["class"] for r in moved.collect()}  # bounded by the clustered words
        fresh = of.copy()
        for word, kind in found.items():
            fresh[word] = kind
        still = still + 1 if (fresh == of).all() else 0
        of = fresh
        if still == 2:
            break
    return of


def _moves(matrix: np.ndarray, of: np.ndarray, classes: int):
    """For words with their neighbours' classes, the class that adds most to sum n log(n / (left right))."""

    def gain(x):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    def run(batches):
        for batch in batches:
            word, kind = batch.column("word").to_pylist(), []
            for w, near in zip(word, batch.column("near").to_pylist(), strict=True):
                out, into = np.zeros(len(matrix)), np.zeros(len(matrix))
                for x in near:
                    out[x["class"]] += x["out"]
                    into[x["class"]] += x["into"]
                m = matrix.copy()
                m[of[w], :] -= out
                m[:, of[w]] -= into
                m = np.maximum(m, 0)
                rows, columns = m[:classes, :], m[:, :classes].T
                left, right = m.sum(axis=1)[:classes], m.sum(axis=0)[:classes]
                change = (gain(rows + out) - gain(rows)).sum(axis=1) + (gain(columns + into) - gain(columns)).sum(axis=1)
                change -= gain(left + out.sum()) - gain(left) + gain(right + into.sum()) - gain(right)
                best = int(change.argmax())
                kind.append(best if change[best] > change[of[w]] + 1e-9 else int(of[w]))
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int32()), pa.array(kind, pa.int32())], ["word", "class"])

    return run


def contexts(docs: DataFrame, known: Lookup, total: int, among: np.ndarray | None = None) -> DataFrame:
    """(word, near, n): how often each word that is not in `known` (of `among`, if given) stands between two classes, near being the
    class before times `total` and the class after. Words that are not in `known` are the last class."""
    among = None if among is None else Lookup(among)

    def run(batch):
        _, hashes, at, _ = _sequence(batch, known)
        near = _near(at, known, total)
        here = np.flatnonzero(at < 0)
        if among is not None:
            here = here[among.find(hashes[here])[1]]
        word, near = hashes[here], near[here]
        order = np.lexsort((near, word))
        word, near = word[order], near[order]
        new = np.ones(len(order), bool)
        new[1:] = (word[1:] != word[:-1]) | (near[1:] != near[:-1])
        lead = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays([pa.array(word[lead]), pa.array(near[lead].astype(np.int32)), pa.array(np.diff(np.append(lead, len(order))))], ["word", "near", "n"])

    return by_step(texts(docs), run, "word long, near int, n long")


def _near(at: np.ndarray, known: Lookup, total: int) -> np.ndarray:
    """The classes before and after each token of whole texts, in one number."""
    kind = np.where(at >= 0, known.values["kind"][np.maximum(at, 0)], total - 1)
    end = total - 2
    return np.concatenate([[end], kind[:-1]]) * total + np.concatenate([kind[1:], [end]])


class Placement:
    """For words with their neighbours' classes, the class to which each adds most."""

    def __init__(self, matrix: np.ndarray):
        self.total = len(matrix)
        self.classes = self.total - 2
        self.after, self.before = matrix[: self.classes].T.copy(), matrix[:, : self.classes].copy()
        self.sums = matrix.sum(axis=1)[None, : self.classes], matrix.sum(axis=0)[None, : self.classes]
        # most words are met once: all there can be of these
        every = np.arange(self.total**2)
        self.once = self._best(every, every, np.ones(len(every), np.int64), len(every))

    @staticmethod
    def _added(by_class: np.ndarray, of: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What n more pairs with a class add, in each of the classes."""

        def gain(x):
            return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

        return gain(by_class[of] + n[:, None]) - gain(by_class[of])

    def _best(self, word: np.ndarray, near: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
        met = np.bincount(word, n, size)
        change = -sum(self._added(x, np.zeros(size, np.int64), met) for x in self.sums)
        for by_class, of in ((self.after, near % self.total), (self.before, near // self.total)):
            key, m = _summed(word * self.total + of, n)
            for i in range(0, len(key), 20_000):
                at, other = np.divmod(key[i : i + 20_000], self.total)
                lead = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                change[at[lead]] += np.add.reduceat(self._added(by_class, other, m[i : i + 20_000].astype(float)), lead)
        return change.argmax(axis=1)

    def kinds(self, word: np.ndarray, near: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts and classes of the words 0 to size - 1, from entries in their order; of a word without entries the last class."""
        met = np.bincount(word, n, size).astype(np.int64)
        kind = np.full(size, self.total - 1)
        lone, more = met == 1, met > 1
        kind[lone] = self.once[near[lone[word]]]
        if more.any():
            rest = more[word]
            kind[more] = self._best((np.cumsum(more) - 1)[word[rest]], near[rest], n[rest], int(more.sum()))
        return met, kind


def settled_by_contexts(around: DataFrame, matrix: np.ndarray) -> DataFrame:
    """(word, n, kind) of the words of `contexts`."""
    placement = Placement(matrix)

    def run(batches):
        for batch in batches:
            for piece in steps([batch], "near"):
                held = piece.column("near")
                near, n = (x.to_numpy().astype(np.int64) for x in held.flatten().flatten())
                size = len(piece)
                met, kind = placement.kinds(np.repeat(np.arange(size), np.diff(held.offsets.to_numpy())), near, n, size)
                yield pa.RecordBatch.from_arrays([piece.column("word"), pa.array(met), pa.array(kind.astype(np.int32))], ["word", "n", "kind"])

    # dealt by word once: both groupings keep to it
    dealt = around.repartition("word").groupBy("word", "near").agg(F.sum("n").alias("n"))
    profile = dealt.groupBy("word").agg(F.collect_list(F.struct("near", "n")).alias("near"))  # as many as pairs of classes
    return profile.mapInArrow(run, "word long, n long, kind int")


class Model:
    """What tasks need: the frequent words with class and count, each class's tokens, the log10 transitions, and the totals."""

    def __init__(self, known: Lookup, matrix: np.ndarray, tokens: int, distinct: int):
        self.known, self.matrix, self.tokens, self.distinct = known, matrix, tokens, distinct
        self.total = len(matrix)
        self.end, self.unknown = self.total - 2, self.total - 1
        self.mass, self.moves = np.zeros(self.total), np.full(matrix.shape, -math.log10(self.total))

    def count(self, tags: DataFrame) -> None:
        """Takes the transitions from training texts; a text begins after an end."""
        total, end = self.total, self.end

        def run(batch):
            kind = words.buffers(batch.column("kinds"))[0].astype(np.int64)
            key, n = np.unique(np.concatenate([[end], kind[:-1]]) * total + kind, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(n)], ["key", "n"])

        found = by_step(tags.select("kinds"), run, "key int, n long", "kinds").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # a row for each pair of classes
        moves = np.zeros(total * total)
        moves[found.column("key").to_numpy()] = found.column("n").to_numpy()
        moves = moves.reshape(total, total)
        self.mass = moves.sum(axis=0)
        self.moves = np.log10((moves + TRANSITION) / (moves.sum(axis=1, keepdims=True) + TRANSITION * total))


def settled(train: DataFrame, classes: int = CLASSES, share: int = SHARE, clustered: int = CLUSTERED) -> Model:
    """A model that knows the classes of the frequent words, and counts of neighbouring classes in which the others are not yet in."""
    if classes + 2 > OPEN:
        raise ValueError(f"at most {OPEN - 2} classes")
    table = cut(counts(train), "counts")
    totals = table.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, distinct = int(totals[0] or 0), int(totals[1] or 0)
    total = classes + 2  # the end, and what is unknown or not yet in
    if not tokens:
        return Model(Lookup(np.array([END]), kind=[classes], n=[0]), np.zeros((total, total)), 0, 0)
    if tokens // share >= 1 << 24:
        raise ValueError("a larger share is needed: a rare word's count takes 24 bits")
    # at most `share` words hold so large a part each
    frequent = table.where(F.col("n") >= max(1.0, tokens / share)).where(F.col("word") != END).toArrow()
    word, n = frequent.column("word").to_numpy(), frequent.column("n").to_numpy()
    order = np.lexsort((word, -n))
    word, n = word[order], n[order]
    size = min(clustered, len(word))
    # groups for counting pairs: a clustered word each, then frequent others by size of their count, the end, the rare
    bands = np.minimum(np.floor(np.log2(np.maximum(n[size:], 1))).astype(np.int64), 39)
    bins = np.unique(bands)
    group = np.concatenate([np.arange(size), size + np.searchsorted(bins, bands), [size + len(bins)]]).astype(np.int64)
    groups = size + len(bins) + 2
    near = cut(pairs(train, Lookup(np.append(word, END), group=group), groups), "pairs")
    of = np.full(groups, total - 1)
    of[:size] = exchange(near, size, classes)[:size]
    of[groups - 2] = classes
    # bounded by the square of the number of groups
    kinds, matrix = of[group], _matrix(near.toArrow(), of, total)
    if len(word) > size:
        first = Lookup(np.append(word[:size], END), kind=np.append(of[:size], classes))
        found = settled_by_contexts(contexts(train, first, total, word[size:]), matrix).toArrow()  # at most `share`
        at = Lookup(found.column("word").to_numpy(), kind=found.column("kind").to_numpy())
        kinds[size:-1] = at.values["kind"][at.find(word[size:])[0]]
        known = Lookup(np.append(word, END), group=kinds)
        matrix = _matrix(pairs(train, known, total).toArrow(), np.arange(total), total)
    return Model(Lookup(np.append(word, END), kind=kinds, n=np.append(n, train.count())), matrix, tokens, distinct)


def _matrix(pair_counts: pa.Table, of: np.ndarray, total: int) -> np.ndarray:
    matrix = np.zeros((total, total))
    np.add.at(matrix, (of[pair_counts.column("a").to_numpy()], of[pair_counts.column("b").to_numpy()]), pair_counts.column("n").to_numpy())
    return matrix


#: A row of a text, which its open words' rows follow.
TEXT = "struct<doc_id: bigint, train: boolean, n_known: bigint, base_score: double, log_counts: double, kinds: binary>"


def spread(docs: DataFrame, model: Model, train: Column) -> DataFrame:
    """A row for each text, with code -1 and the classes of its tokens, OPEN for words that are not in the model, and one for each of these:
    word, row (of its text) and code, which holds its place among them, the classes around it and whether the text is one to learn from."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    below = math.log10(model.tokens + model.distinct + 1)

    def run(batch):
        m = shared.value
        _, hashes, at, text = _sequence(batch, m.known)
        size = batch.num_rows
        row, learns = batch.column("row").to_numpy(), batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
        safe, hit = np.maximum(at, 0), at >= 0
        kind = np.where(hit, m.known.values["kind"][safe], OPEN).astype(np.uint8)
        n = np.where(hit, m.known.values["n"][safe], 0)
        sums = [np.bincount(text, n > 0, size).astype(np.int64), np.bincount(text, np.where(hit, np.log10(n + 1.0) - below, 0.0), size), np.bincount(text, np.log10(np.maximum(n, 1.0)), size)]
        kinds = pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(np.searchsorted(text, np.arange(size + 1)).astype(np.int32)), pa.py_buffer(kind)])
        rest = np.flatnonzero(~hit)
        place = np.arange(len(rest)) - np.searchsorted(text[rest], text[rest])
        code = (place << 17) | (_near(at, m.known, m.total)[rest] << 1) | learns[text[rest]]
        names = ["doc_id", "train", "n_known", "base_score", "log_counts", "kinds"]
        told = pa.StructArray.from_arrays([batch.column("doc_id"), pa.array(learns), *(pa.array(x) for x in sums), kinds], names)
        told = told.take(pa.array(np.append(np.arange(size), np.full(len(rest), -1)), mask=np.arange(size + len(rest)) >= size))
        # texts have no word: their rows are dealt out evenly
        word = np.concatenate([words.signed(words.mix(row.view(U))), hashes[rest]])
        columns = [pa.array(word), pa.array(np.concatenate([row, row[text[rest]]])), pa.array(np.concatenate([np.full(size, -1), code])), told]
        return pa.RecordBatch.from_arrays(columns, ["word", "row", "code", "text"])

    numbered = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train")).withColumn("row", F.monotonically_increasing_id())
    return by_step(texts(numbered, "row", "train"), run, f"word long, row long, code long, text {TEXT}")


def _found(at: Column, n: Column, kind: Column) -> Column:
    return F.shiftleft(at, 32) + n * 256 + kind


def gathered(rows: DataFrame, model: Model) -> DataFrame:
    """The texts with the classes of all tokens, from rows (row, code, text) in which a word's code holds its place, count and class."""
    below = math.log10(model.tokens + model.distinct + 1)

    def run(batches):
        for batch in whole_groups(batches, "row"):
            code = batch.column("code").to_numpy()
            is_text = code < 0
            told = batch.column("text").filter(pa.array(is_text))
            text, code = (np.cumsum(is_text) - 1)[~is_text], code[~is_text]
            n, size = (code >> 8) & ((1 << 24) - 1), len(told)
            columns = dict(zip([f.name for f in told.type], told.flatten(), strict=True))
            raw, offsets = words.buffers(columns["kinds"])
            kind = raw.copy()
            kind[kind == OPEN] = code & 255
            more = {"n_known": n > 0, "base_score": np.log10(n + 1.0) - below, "log_counts": np.log10(np.maximum(n, 1.0))}
            for name, x in more.items():
                old = columns[name].to_numpy()
                columns[name] = pa.array(old + np.bincount(text, x, size).astype(old.dtype))
            columns["kinds"] = pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(kind)])
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows.repartition("row").sortWithinPartitions("row", "code").mapInArrow(run, TEXT[7:-1].replace(": ", " "))


def learn(train: DataFrame, classes: int = CLASSES, share: int = SHARE, clustered: int = CLUSTERED) -> tuple[Model, DataFrame]:
    """A model and the table of words (word, n, kind) from the texts of `train`."""
    spark = train.sparkSession
    model = settled(train, classes, share, clustered)
    known = model.known
    first = [(int(w), int(n), int(k)) for w, n, k in zip(known.keys, known.values["n"], known.values["kind"], strict=True) if n]
    first = spark.createDataFrame(first, "word long, n long, kind int")
    table = cut(first.union(settled_by_contexts(contexts(train, known, model.total), model.matrix)), "words")
    model.count(tagged(train, model, table))
    return model, table


def tagged(docs: DataFrame, model: Model, table: DataFrame) -> DataFrame:
    """The texts of `docs` with the classes that `table` has for their words."""
    rows = spread(docs, model, F.lit(True)).join(table, "word", "left")
    found = _found(F.shiftright("code", 17), F.coalesce("n", F.lit(0)), F.coalesce("kind", F.lit(model.unknown)))
    return gathered(rows.select("row", F.when(F.col("code") < 0, F.col("code")).otherwise(found).alias("code"), "text"), model)


def scored(docs: DataFrame, model: Model, table: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score and perplexity for every row of `docs` (doc_id, text).

    base_score: log10 of the words' add-one probabilities; score: log10 of the class model's. Null and empty texts are
    their end alone. Without training tokens nothing is known. Rows that repeat a doc_id each give a row.
    """
    return _rated(tagged(docs, model, table), model)


def learnt_and_scored(docs: DataFrame, train: Column, classes: int = CLASSES, share: int = SHARE, clustered: int = CLUSTERED) -> DataFrame:
    """`scored` of all `docs` by the model of those where `train`; open words are dealt out once, to be put in and to be looked up."""
    model = settled(docs.where(train), classes, share, clustered)
    placement = Placement(model.matrix)

    def run(batches):
        for batch in whole_groups(batches, "word"):  # a rare word's rows: under tokens / share to learn from
            code = batch.column("code").to_numpy()
            is_text = code < 0
            word = batch.column("word").to_numpy()[~is_text]
            held = code[~is_text]
            new = np.concatenate([[True], word[1:] != word[:-1]]) if len(word) else np.zeros(0, bool)
            at, size = np.cumsum(new) - 1, int(new.sum())
            learns = (held & 1) == 1
            n, kind = placement.kinds(at[learns], (held[learns] >> 1) & 0xFFFF, np.ones(int(learns.sum()), np.int64), size)
            code = code.copy()
            code[~is_text] = ((held >> 17) << 32) | (n[at] << 8) | kind[at]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(code), batch.column("text")], ["row", "code", "text"])

    rows = spread(docs, model, train).repartition("word").sortWithinPartitions("word")
    tags = cut(gathered(rows.mapInArrow(run, f"row long, code long, text {TEXT}"), model), "tags")
    model.count(tags.where("train"))
    return _rated(tags, model)


def _rated(tags: DataFrame, model: Model) -> DataFrame:
    end, mass = model.end, np.log10(np.maximum(model.mass, 1))
    mass[model.unknown] = 0.0  # an unknown word is the only one of its class
    moves = model.moves

    def run(batch):
        raw, offsets = words.buffers(batch.column("kinds"))
        kind, size = raw.astype(np.int64), np.diff(offsets)
        text = np.repeat(np.arange(batch.num_rows), size)
        score = np.bincount(text, moves[np.concatenate([[end], kind[:-1]]), kind] - mass[kind], batch.num_rows) + batch.column("log_counts").to_numpy()
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size), batch.column("n_known"), batch.column("base_score"), pa.array(score)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    out = by_step(tags, run, "doc_id long, n_tokens long, n_known long, base_score double, score double", "kinds")
    return out.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
