"""Vector codes and fill-in-middle: brute force, exact round trips, rows of every kind."""

import collections
import hashlib
import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from campusweave.llm import fim, vector_codes
from campusweave.llm.fim import Recipe

# -- vector codes ------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, code string, error long, vector int, part int"


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], VECTORS)


def plain_codes(rows, parts, entries, rounds, scale):
    """The contract, vector by vector, in Python's whole numbers."""
    kept = [(i, [math.floor(scale * Fraction(x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    kept = [(i, [(v + [0] * parts * width)[p * width : (p + 1) * width] for p in range(parts)], label) for i, v, label in kept]
    start = sorted((i, v) for i, v, _ in kept if i is not None)
    start = [next(g) for _, g in itertools.groupby(start, key=lambda r: r[0])][:entries] or [(None, min(v for _, v, _ in kept))]
    books = [[list(v[p]) for _, v in start] for p in range(parts)]

    def assign():
        out = []
        for _, v, _ in kept:
            far = [[sum((a - b) ** 2 for a, b in zip(v[p], e)) for e in books[p]] for p in range(parts)]
            out.append([(f.index(min(f)), min(f)) for f in far])
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for (_, v, _), c in zip(kept, codes) if c[p][0] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    codes = assign()
    most = 2**63 - 1
    error = [min(most, sum(f for _, f in c)) for c in codes]
    by = collections.Counter()
    for (_, _, label), e in zip(kept, error):
        by[label] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{c:02x}" for c, _ in cs), e, min(most, by[label]), sha) for (i, _, label), cs, e in zip(kept, codes, error)]


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def random_rows(n, width, seed, values=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) if values is None else rng.choice(values, size=(n, width))
    return [(int(i), [float(v) for v in row], int(i) % 3 if i % 4 else None) for i, row in enumerate(x)]


@pytest.mark.parametrize("rows, options", [
    (random_rows(120, 16, 1), {}),
    (random_rows(60, 24, 2), {"parts": 4, "entries": 7, "rounds": 3}),  # parts of 6, padded to 8
    (random_rows(90, 8, 3, [0.0, 0.5, -0.5, 1e-5]), {}),  # ties and equal entries
    (random_rows(30, 8, 4, [1e30, -3.5, 2.0**45 + 0.5, 7e200]), {"entries": 4, "rounds": 2}),  # past 64 bits
    (random_rows(10, 16, 5), {}),  # fewer rows than entries
])
def test_codes_against_plain_distances(vectors, rows, options):
    used = {"parts": 8, "entries": 16, "rounds": 6, "scale": 4096} | options
    same(vector_codes.encoded(vectors(rows), **used).collect(), plain_codes(rows, **used))


def test_codes_of_rows_of_every_kind(vectors):
    rows = random_rows(30, 16, 6) + [(100, None, 1), (101, [None] * 16, 1), (102, [math.nan] * 16, 1), (103, [math.inf] + [0.0] * 15, None)]
    rows += [(5, [0.25] * 16, 2), (5, [0.25] * 16, 2), (None, [0.5] * 16, None), (104, [], 1), (105, [1.0] * 5, 1), (106, [0.0] * 16, 1), (107, [-0.0] * 16, 1)]
    out = vector_codes.encoded(vectors(rows))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = plain_codes(rows, 8, 16, 6, 4096)
    same(out.collect(), want)
    same(vector_codes.encoded(vectors(rows).repartition(7)).collect(), want)
    assert vector_codes.encoded(vectors(rows).where("vec_id in (100, 102)")).collect() == [] == vector_codes.encoded(vectors(rows).limit(0)).collect()
    alone = [(None, [0.5] * 16, None)]
    same(vector_codes.encoded(vectors(alone)).collect(), plain_codes(alone, 8, 16, 6, 4096))


def test_many_labels_are_joined_by_a_shuffle(vectors, monkeypatch):
    monkeypatch.setattr(vector_codes, "LABELS", 1)
    rows = random_rows(80, 16, 7) + [(200 + i, [0.1 * i] * 16, 9) for i in range(60)]
    same(vector_codes.encoded(vectors(rows), rounds=1).collect(), plain_codes(rows, 8, 16, 1, 4096))


@pytest.mark.parametrize("length", [1, 2, 4, 8, 32])
def test_transform_is_hadamard_in_sequency_order(length):
    rows = vector_codes.transform(np.eye(length, dtype=np.int64)).T
    assert (abs(rows) == 1).all() and (rows @ rows.T == length * np.eye(length)).all()
    assert [int((np.diff(r) != 0).sum()) for r in rows] == list(range(length))


def test_elimination_leaves_no_nearer_entry_out():
    rng = np.random.default_rng(8)
    for kind in (np.int64, object):
        x, e = (rng.integers(-9, 9, (n, 8)).astype(kind) for n in (300, 12))
        far = ((x[:, None] - e[None]) ** 2).sum(axis=2)
        code, distance = vector_codes.nearest(vector_codes.transform(x), vector_codes.transform(e))
        assert (code == np.array([list(f).index(min(f)) for f in far])).all() and (distance == 8 * far.min(axis=1)).all()


# -- fill in the middle ------------------------------------------------------------------------


def plain_digest(doc_id, text):
    text = text or ""
    n, h = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    form = "plain" if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
    out = {"plain": text, "psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[form]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sizes = (None, None) if form == "plain" else (low, high - low)
    return (doc_id, n, form, *sizes, sha(out), sha(text)), out


def texts_of_every_kind():
    rng = random.Random(3)
    letters = "ab <>PSM\né😀"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(30)))) for i in range(150)]
    rows += [(300 + i, "".join(rng.choice(letters.replace("P", "").replace("S", "").replace("M", "")) for _ in range(rng.choice([4095, 4096, 4097, 9000, 30_000])))) for i in range(25)]
    return rows + [(400, None), (401, ""), (402, "<P>"), (7, "twice"), (7, "twice"), (7, "other"), (None, "no id"), (None, "no id"), (None, None), (2**62, "x"), (-5, "neg <")]


def test_middles_against_whole_texts(docs):
    rows = texts_of_every_kind()
    want = [plain_digest(*r)[0] for r in rows]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    out = fim.digests(docs(*rows))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    same(out.collect(), want)
    same(fim.digests(docs(*rows).repartition(9)).collect(), want)
    assert fim.digests(docs(*rows).limit(0)).collect() == []


def test_middles_over_many_partitions(docs, monkeypatch):
    monkeypatch.setattr(fim, "PART_BYTES", 20_000)
    monkeypatch.setattr(fim, "CHUNK", 7)
    rows = texts_of_every_kind()
    same(fim.digests(docs(*rows)).collect(), [plain_digest(*r)[0] for r in rows])


def test_outputs_and_exact_restoration(docs):
    rows = texts_of_every_kind()
    out = fim.transformed(docs(*rows))
    back = out.withColumn("text", fim.restored(out["output"], out["form"]))
    same(back.select("doc_id", "output", "text").collect(), [(r[0], plain_digest(*r)[1], r[1] or "") for r in rows])


def test_units_of_words_and_other_sentinels(docs):
    recipe = Recipe(seed="x", plain_from=100, spm_below=50, sentinels=("[pre]", "[suf]", "[mid]"), unit=r"\S+\s*")
    rows = [(i, " ".join(f"w{j}" for j in range(i))) for i in range(30)] + [(50, "  led"), (51, "   ")]
    out = fim.transformed(docs(*rows), recipe)
    got = {r["doc_id"]: r for r in out.withColumn("text", fim.restored(out["output"], out["form"], recipe)).collect()}
    for i, text in rows:
        r = got[i]
        assert r["text"] == text and r["n"] == (len(text.split()) or int(bool(text)))
        assert all(at in (0, len(text)) or text[at - 1].isspace() for at in (r["prefix_chars"] or 0, (r["prefix_chars"] or 0) + (r["middle_chars"] or 0)))
    for bad in (("<a>", "<a>x", "<b>"), ("", "<a>", "<b>"), ("aba", "x", "y"), ("<a", "ab", "c")):
        with pytest.raises(ValueError):
            Recipe(sentinels=bad)


def test_sentinels_are_found_across_pieces():
    recipe = Recipe()
    text = "<<S<S" * 3 + "x"
    out = "".join(recipe.output("psm", text, 5, 9)).encode()
    for size in range(1, 7):
        got = ["", "", ""]
        for rank, piece in recipe.parts("psm", [out[i : i + size] for i in range(0, len(out), size)]):
            got[rank] += piece.decode()
        assert got == [text[:5], text[5:9], text[9:]]


def test_one_shuffle_serves_both_sorts(docs):
    """The second sort keeps the first one's partitioner: the lineage has one shuffle."""
    rows = docs(*texts_of_every_kind())
    lineage = fim.digests(rows).rdd.toDebugString().decode()
    assert lineage.count("ShuffledRDD") == 1
