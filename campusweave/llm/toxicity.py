"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read a clause word by word. The insult transducer is a trie with weights on words and
on word beginnings, learnt from labelled rows; threat, target, negation and reported speech read closed
word classes. Their composition walks the clause once: an insult or an aimed threat emits its weight,
scaled by the state it is met in (within the scope of a negation, inside reported speech, with a target
in the clause). Clauses that emit nothing are not scored; a document's score is a logistic function of
its strongest clause, the sum over its clauses and their share of all words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campusweave.llm.common import by_step, texts

#: Labelled rows that the grammar's weights are learnt from, at most; the choice is by a hash of doc_id.
TRAIN_ROWS = 20_000
#: Entries of the learnt trie, at most, the strongest first; toxic texts that an entry must be found in (fewer if there are under 80).
ENTRIES, LEAST_DOCS = 4_000, 8
PREFIXES = range(4, 8)
LEAST_WEIGHT = 2.0

# The closed word classes, by language en, de, fr, es
SEED_INSULTS = "idiot moron scum loser stupid worthless pathetic disgusting trash clown".split()
THREATS = set("kill hurt destroy beat burn shoot stab crush töten verletzen umbringen verbrennen tuer frapper brûler détruire matar golpear quemar destruir".split())
TARGETS = set("you your yours yourself u du dich dir dein deine euch ihr tu toi te ton vous votre tú ti tu usted ustedes he she they him her them".split())
NEGATIONS = set("not no never none neither nor isn't aren't don't nicht kein keine nie pas jamais aucun ne nunca jamás ningún ni".split())
REPORTS = set("said says say wrote writes quoted claimed told reported sagte schrieb zitierte dit écrit déclara dijo escribió citó".split())
#: Scope of a negation and reach of a threat, in words.
SCOPE = 3
NEGATED, REPORTED, TARGETED, THREAT = 0.5, 0.7, 1.25, 4.0

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[.!?;:,\n|]+")


@dataclass
class Grammar:
    """Weights of the insult trie (words, and beginnings marked by a final *) and of the document's logistic function."""

    entries: dict[str, float]
    bias: float = -4.0
    weights: tuple[float, ...] = (1.0, 0.5, 0.0)
    seen: dict[str, float] = field(default_factory=dict)

    def insult(self, word: str) -> float:
        """Largest weight on the word's path through the trie, 0 if it leaves it."""
        found = self.seen.get(word)
        if found is None:
            found = self.entries.get(word, 0.0)
            for n in PREFIXES:
                if len(word) < n:
                    break
                found = max(found, self.entries.get(word[:n] + "*", 0.0))
            if len(self.seen) > 300_000:
                self.seen.clear()
            self.seen[word] = found
        return found

    def clause(self, words: list[str]) -> float:
        """Weight that the composed transducers emit over one clause."""
        total, negated, reported, aimed, threat = 0.0, 0, False, False, 0
        for word in words:
            if word in NEGATIONS:
                negated = SCOPE + 1
            elif word in REPORTS:
                reported = True
            elif word in TARGETS:
                aimed = True
                if threat:
                    total += THREAT * (REPORTED if reported else 1)
                    threat = 0
            elif word in THREATS:
                if not negated:
                    threat = SCOPE + 1
            else:
                weight = self.insult(word)
                if weight:
                    total += weight * (NEGATED if negated else 1) * (REPORTED if reported else 1)
            negated, threat = max(0, negated - 1), max(0, threat - 1)
        return total * (TARGETED if aimed else 1)

    def features(self, text: str) -> tuple[float, float, float]:
        lowered = text.lower()
        words = WORD.findall(lowered)
        distinct = set(words)
        if not any(map(self.insult, distinct)) and distinct.isdisjoint(THREATS):
            return 0.0, 0.0, 0.0
        found = [x for x in (self.clause(WORD.findall(c)) for c in CLAUSE.split(lowered)) if x]
        total = sum(found)
        return max(found, default=0.0), math.log1p(total), 100 * total / (len(words) + 20)

    def score(self, text: str) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def marks(text: str) -> set[str]:
    """Trie entries that a text would walk: its words and their beginnings."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) >= n}


def _counted(rows: DataFrame, least: int, only: frozenset[str] | None = None) -> dict[str, tuple[int, int]]:
    """Toxic and clean texts that hold each entry; with no `only`, of toxic texts and entries in `least` of them."""

    def count(batch):
        found = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            if only is not None or toxic:
                held = marks(text.decode())
                found[toxic].update(held if only is None else held & only)
        names = list(found[0] | found[1])
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([found[1][x] for x in names], pa.int64()), pa.array([found[0][x] for x in names], pa.int64())], ["entry", "toxic", "clean"])

    summed = by_step(rows, count, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # bounded by the sample: the entries found in most of its toxic texts
    return {r["entry"]: (r["toxic"], r["clean"]) for r in summed.where(F.col("toxic") >= least).orderBy(F.desc("toxic"), "entry").limit(50_000).collect()}


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Grammar:
    """A grammar from labelled rows (doc_id, toxic 0 or 1) of `docs`, at most `rows` of them.

    Rows with null or other labels, and labels of unknown documents, are not used. Two thirds of the rows give the
    trie, the others the logistic function. Without toxic and clean rows the trie holds the seed words only.
    """
    marked = labels.where("toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("long").alias("toxic"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    held = texts(docs).join(F.broadcast(sample), "doc_id").dropDuplicates(["text"])  # at most `rows` short rows
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3))
    first, second = held.where(part != 0), held.where(part == 0)
    n = {r["toxic"]: r["count"] for r in first.groupBy("toxic").count().collect()}
    least = min(LEAST_DOCS, max(3, n.get(1, 0) // 10))
    found = _counted(first, least)
    found = _counted(first, least, frozenset(found)) if found else {}
    grammar = Grammar(dict.fromkeys(SEED_INSULTS, 3.0))
    entries = {}
    for name, (toxic, clean) in found.items():
        odds = math.log((toxic + 0.5) / (n.get(1, 0) + 1)) - math.log((clean + 0.5) / (n.get(0, 0) + 1))
        weight = odds - math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
        if weight >= LEAST_WEIGHT:
            entries[name] = weight
    strongest = sorted(entries, key=lambda x: (-entries[x], x))[:ENTRIES]
    grammar.entries |= {x: entries[x] for x in strongest}

    def measure(batch):
        rows = [(*grammar.features(t.decode()), y) for t, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True)]
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], ["a", "b", "c", "y"])

    data = np.array([tuple(r) for r in by_step(second, measure, "a double, b double, c double, y double").collect()], float).reshape(-1, 4)
    if len(set(data[:, 3])) == 2:
        grammar.bias, *weights = fitted(data[:, :3], data[:, 3])
        grammar.weights = tuple(weights)
    return grammar


def fitted(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> list[float]:
    """Bias and weights of a logistic function by damped Newton steps, with a quadratic penalty on the weights."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    x = np.column_stack([np.ones(len(x)), x / scale])
    ridge = np.array([1e-3] + [penalty] * (x.shape[1] - 1))

    def loss(w):
        return np.logaddexp(0, x @ w).sum() - y @ (x @ w) + 0.5 * ridge @ (w * w)

    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w += size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return [float(v) for v in w / np.concatenate([[1.0], scale])]


def held_out(divisor: int, remainder: int):
    """Whether crc32 of doc_id as text leaves this remainder; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor == remainder


def scored(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id and score in (0, 1) for every row of `docs` (doc_id, text); null and empty texts get the score of no clause."""

    def run(batch):
        found = [grammar.score(t.decode()) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    return by_step(texts(docs), run, "doc_id long, score double")
