import itertools
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from campusweave.llm import graph, near_dedup, substring_dedup, words
from campusweave.llm.graph import components
from tests.llm.conftest import prose


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """component_id by comparing all pairs."""
    sets = {d: shingles(t) for d, t in rows}
    least = {d: d for d in sets}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in links:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return {d: (len(sets[d]), least[d], least[d] == d) for d in sets}


def edited(text, seed, n):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_against_all_pairs(spark, docs):
    """Chains of edits, a group with a hub, truncated copies, equal texts, short and empty texts."""
    texts, base = [], [prose(120, s) for s in range(4)]
    for s, b in enumerate(base):
        texts += [b, b.upper()]
        step = b
        for k in range(6):  # each like the one before, the ends not like each other
            step = edited(step, 10 * s + k, 2)
            texts.append(step)
        texts += [edited(b, 100 + s * 10 + k, k) for k in range(1, 9)]
        texts += [" ".join(b.split()[: 120 - 10 * k]) for k in range(1, 6)]
    texts += ["a b", "A  b\n", "a", "", None, "   ", "a b c d e", "a b c d f"]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    assert found(near_dedup.near_duplicates(docs(*rows))) == brute(rows)


def test_one_large_group(spark, docs):
    """Many different copies of one text, some edited beyond the threshold, and many equal ones."""
    base = prose(60, 1)
    rows = [(i, base if i % 3 == 0 else edited(base, i, i % 5)) for i in range(200)]
    assert found(near_dedup.near_duplicates(docs(*rows))) == brute(rows)


def test_open_members_hold_open_keys_alone(spark, docs, monkeypatch):
    """Members that go on to be met pair by pair carry the keys they may meet in, not those of all items that their pivot lacks."""
    shared = prose(50, 1)
    rows = [(f"{shared} " + edited(prose(60, 10 + k), 7 * k + i, 4)) for k in range(4) for i in range(12)]
    rows = list(enumerate(rows))
    tables, plain = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df, name: tables.append(plain(df, name)) or tables[-1])
    assert found(near_dedup.near_duplicates(docs(*rows))) == brute(rows)
    held = [r for t in tables if {"keys", "pivot"} <= set(t.columns) for r in t.collect()]
    met = {}
    for r in held:
        met.setdefault(r["id"], set()).add(r["key"])
    assert held and all(set(r["keys"]) == met[r["id"]] for r in held)


def test_common_items_make_no_pairs(spark, monkeypatch):
    """Sets of one bucket that share half their items, all of them beyond the pivot, meet by what is rare: pairs grow with the sets, not with their square."""
    n = 60
    sets = {0: set(range(10))}
    for i in range(1, n + 1):
        own = {1000 * i + k for k in range(8)}
        sets[i] = {0, 1, *range(100, 108), *own}
        if i % 10 == 0:  # one alike
            sets[n + i] = sets[i] - {1000 * i} | {1000 * i + 9}
    contents = {i: np.unique(words.mix(np.array([*s], np.uint64) + np.uint64(7))) for i, s in sets.items()}
    table = spark.createDataFrame([(i, words.signed(x).tolist()) for i, x in contents.items()], "id long, content array<long>")
    buckets = spark.createDataFrame([(1, i) for i in sets] + [(2, 0), (2, 1)], "key long, id long")
    tables, plain = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df, name: tables.append((name, plain(df, name))) or tables[-1][1])
    out = graph.linked(buckets, graph.Sets(lambda ids: table, substring_dedup._read, 75))
    assert {(r["id"], r["component"]) for r in out.collect()} == {(x, i) for i in range(10, n + 1, 10) for x in (i, n + i)}
    assert sum(t.count() for name, t in tables if name == "pairs") <= 3 * len(sets)


def test_empty_table_and_null_id(spark, docs):
    assert near_dedup.near_duplicates(docs().limit(0)).collect() == []
    rows = near_dedup.first_of_each(docs((None, "a b c"), (1, "a b c"), (2, "a b c"))).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "None"] and len(rows[0]) == 10


def test_repeated_rows(spark, docs):
    rows = near_dedup.near_duplicates(docs((3, "q r s t u v"), (3, "q r s t u v"), (5, "q r s t u v"))).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(3, 3), (3, 3), (5, 3)]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6))
def test_every_coordinate_fills(n, salt):
    items = words.seeds(n, salt)
    out = near_dedup.sketch(items, 128)
    assert (out != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert (near_dedup.sketch(items[::-1].copy(), 128) == out).all()


def test_equal_coordinates_estimate_similarity():
    a, b = words.seeds(1000, 0), words.seeds(1000, 250)
    both = np.mean(near_dedup.sketch(a, 1024) == near_dedup.sketch(b, 1024))
    assert abs(both - 750 / 1250) < 0.06


def test_words_and_shingles():
    import pyarrow as pa

    texts = ["A b\tc", "a b c", "", "x\x1fy  z\x0b", "a B C"]
    w = words.split(pa.array([t.encode() for t in texts]))
    assert np.diff(w.first).tolist() == [len(t.encode().split()) for t in texts]
    assert w.hash[0] == w.hash[-3] and len({*w.hash.tolist()}) == 6
    assert [len(s) for s in words.sets(pa.array([b"a b c d e f", b"a a a a a a", b"q", b""]))] == [2, 1, 1, 0]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 300), (300, 200), (7, 7)]
    out = {r["id"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 200, 300), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
