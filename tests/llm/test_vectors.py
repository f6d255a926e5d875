"""Shards, passages, benchmark windows, nearest vectors and the pipeline."""

import collections
import os
import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as driver
from campusweave.llm import ann, decontam, queries, sharding, substring_dedup
from tests.llm.conftest import prose

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
DATA = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_shards(spark, docs):
    rows = [(i, prose(5, i)) for i in range(150)] + [(200 + i, "same text") for i in range(60)] + [(300 + i, prose(4, i % 20)) for i in range(60)] + [(400, ""), (401, None), (5, "twice"), (5, "twice")]
    out = sharding.shards(docs(*rows), 7).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == sorted((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    by = collections.defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert len(by) == 7 and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    texts = collections.defaultdict(list)
    of = collections.defaultdict(list)
    for d, t in rows:
        of[d].append(t or "")
    for r in out:
        texts[of[r["doc_id"]][0]].append(r["shard"])
    pairs = [(t, s) for t, s in texts.items() if len(s) > 1]
    # a group needs as many shards as its size asks for; moves go by hash, so shards of 40 rows leave some groups split further
    extra = [len(set(s)) - -(-len(s) // (len(rows) // 7)) for _, s in pairs]
    assert max(extra) <= 4 and sum(x == 0 for x in extra) >= 0.7 * len(extra)


def test_few_rows_and_none(spark, docs):
    assert sorted((r["shard"], r["slot"]) for r in sharding.shards(docs("a", "b"), 5).collect()) == [(0, 0), (1, 0)]
    assert sharding.shards(docs().limit(0), 5).collect() == []


def test_grants():
    flows = np.array([[0, 10, 0], [0, 0, 0], [0, 10, 0]], float)
    assert (sharding._grant(flows, np.array([0, 20, 0.0])) == 1).all()
    share = sharding._grant(flows, np.array([0, 5, 0.0]))
    assert (flows * share).sum() == pytest.approx(5, rel=0.1)


def test_passages(spark, docs):
    """A passage set into the midst of other lines is found in all its places, and nothing of the texts around it."""
    passage = prose(70, 1)
    rows = [(i, f"{prose(40 + 9 * i, 50 + i)} {passage} {prose(30, 80 + i)}\n{prose(20, 90 + i)}") for i in range(6)]
    rows += [(10 + i, prose(150, 200 + i) + "\nReleased under the same short licence.") for i in range(10)]
    rows += [(30, ""), (31, None), (32, "word"), (33, "x " * 5000)]
    out = substring_dedup.repeated(docs(*rows)).collect()
    where = {r["doc_id"]: r for r in out if r["doc_id"] < 10}
    assert set(where) == set(range(6)) and not any(10 <= r["doc_id"] < 30 for r in out)
    for i, r in where.items():
        begin = 40 + 9 * i
        # a paragraph at the edge may be alike with a word or two from beside the passage
        assert begin - 3 <= r["start_word"] < r["end_word"] <= begin + 73 and r["n_words"] >= 25 and r["removed"] == (i > 0) and r["first_doc"] == 0


def test_neighbouring_passages_keep_links_and_copies(spark, docs):
    """Of repeated lines side by side each keeps a copy, and each link is told; the least length is that of both."""
    a, b = prose(20, 1), prose(20, 2)
    short_a, short_b = prose(10, 3), prose(10, 4)
    rows = [(1, f"{prose(20, 5)}\n{b}"), (2, f"{a}\n{b}"), (3, f"{a}\n{prose(20, 6)}")]
    rows += [(11, f"{prose(20, 7)}\n{short_b}"), (12, f"{short_a}\n{short_b}"), (13, f"{short_a}\n{prose(20, 8)}")]
    got = collections.defaultdict(list)
    for r in substring_dedup.repeated(docs(*rows)).orderBy("doc_id", "start_word").collect():
        got[r["doc_id"]].append((r["start_word"], r["end_word"], r["n_words"], r["first_doc"], r["removed"]))
    assert got == {1: [(20, 40, 20, 1, False)], 2: [(0, 20, 20, 2, False), (20, 40, 20, 1, True)], 3: [(0, 20, 20, 2, True)], 12: [(0, 10, 10, 12, False), (10, 20, 10, 11, True)]}
    for x, y in ((a, b), (b, a)):
        of = {r["doc_id"]: set(r["clusters"]) for r in substring_dedup.repeated(docs((1, x), (2, y), (3, f"{x}\n{y}"))).collect()}
        assert of[1] and of[2] and not of[1] & of[2] and of[3] == of[1] | of[2]


def test_near_paragraphs_against_all_pairs(spark, docs):
    base = [prose(40, i) for i in range(5)]
    texts = base + [b.replace(b.split()[-1], "other") for b in base] + [base[0], base[1].upper()]
    out = substring_dedup.repeated(docs(*texts)).collect()
    assert {r["doc_id"] for r in out} == set(range(len(texts)))
    assert substring_dedup.repeated(docs().limit(0)).collect() == []


def test_filter_lets_few_others_through(spark):
    """All keys pass; with three million of them fewer than 2 % of others do."""
    from pyspark.sql import functions as F

    from campusweave.llm.common import bitmap, passes

    keys = spark.range(3_000_000).select(F.xxhash64("id").alias("key"))
    bits = bitmap(keys)
    assert passes(bits, keys.limit(50_000).toArrow().column("key").to_numpy()).all()
    others = spark.range(10**9, 10**9 + 200_000).select(F.xxhash64("id").alias("key")).toArrow().column("key").to_numpy()
    assert passes(bits, others).mean() < 0.02


def test_cuts_depend_on_the_content_alone():
    import pyarrow as pa

    passage = prose(80, 3)
    cuts = []
    for k in range(4):
        before = prose(17 + 31 * k, 30 + k)
        _, start, _, _ = substring_dedup._paragraphs(pa.array([f"{before} {passage} {prose(20, k)}".encode()]))
        n = len(before.split())
        cuts.append([int(s) - n for s in start if n + substring_dedup.REACH < s < n + 80 - substring_dedup.REACH])
    assert cuts[0] and all(c == cuts[0] for c in cuts)


def windows_by_hand(docs, items):
    def shingles(w):
        return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])

    out = {}
    for d, t in docs:
        w = (t or "").lower().split()
        for i, text in items:
            v = (text or "").lower().split()
            for at in range(max(1, len(w) - len(v) + 1)) if v else []:
                a, b = shingles(w[at : at + len(v)]), shingles(v)
                same, total = sum((a & b).values()), sum((a | b).values())
                if 100 * same >= 75 * total and same:
                    out[d, i] = max(out.get((d, i), 0), same / total)
    return out


def test_decontamination_against_all_windows(spark, docs):
    rng = random.Random(2)
    items = [(i, prose(rng.randrange(14, 60), 500 + i)) for i in range(12)] + [(20, "one two three"), (21, ""), (22, None), (23, "go go go go go go go go go go")]
    rows = []
    for i in range(12):
        w = items[i][1].split()
        rows.append((i, f"{prose(30, i)} {items[i][1].upper()} {prose(10, i)}"))
        w[rng.randrange(len(w))] = "changed"
        rows.append((50 + i, f"{prose(20, 60 + i)}\n{' '.join(w)} {prose(12, i)}"))
        rows.append((80 + i, " ".join(items[i][1].split()[2:]) + " " + prose(9, i)))
        rows.append((110 + i, " ".join(items[i][1].split()[: -1])))
    rows += [(200, "say one two three now"), (201, ""), (202, None), (203, "go " * 30), (204, "one two"), (205, "x" * 100_000)]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontam.contaminated(docs(*rows), table).collect()}
    assert found == pytest.approx(windows_by_hand(rows, items))
    kept = {r["doc_id"] for r in decontam.clean(docs(*rows), table).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in found}
    assert decontam.contaminated(docs("a b"), table.limit(0)).collect() == [] == decontam.contaminated(docs().limit(0), table).collect()


def test_decontamination_of_reordered_items(spark, docs):
    """Items whose halves or last third changed places, in a longer text, at a line's start and in a text of their own."""
    items = [(i, prose(40 + 7 * i, 700 + i)) for i in range(6)]
    rows = []
    for i, text in items:
        w = text.split()
        for k, at in enumerate((len(w) // 2, 2 * len(w) // 3)):
            moved = " ".join(w[at:] + w[:at])
            rows += [(100 * k + i, f"{prose(30, i)} {moved} {prose(30, 50 + i)}"), (100 * k + 20 + i, moved), (100 * k + 40 + i, f"{moved} {prose(9, i)}")]
        rows.append((300 + i, f"{prose(30, i)} {' '.join(w[: len(w) // 2])} {prose(30, 60 + i)}"))
    table = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.contaminated(docs(*rows), table).collect()
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in out}
    want = windows_by_hand(rows, items)
    assert len(want) == 36 and found == pytest.approx(want)
    assert all(r["start_word"] == 30 for r in out if r["doc_id"] % 100 < 20)


def test_decontamination_is_native(spark, docs):
    table = spark.createDataFrame([(1, prose(20, 1))], "item_id long, text string")
    plan = decontam.contaminated(docs(prose(20, 1)), table)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_fingerprint_blocks(spark):
    """Any two fingerprints within the radius agree in a block."""
    rng = random.Random(1)
    pairs = []
    for _ in range(50):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), decontam.RADIUS):
            y ^= 1 << b
        pairs.append(tuple(v - (1 << 64) if v >> 63 else v for v in (x, y)))
    df = spark.createDataFrame(pairs, "x long, y long")
    from pyspark.sql import functions as F

    agree = F.size(F.array_intersect(decontam.blocks(F.col("x"), decontam.RADIUS), decontam.blocks(F.col("y"), decontam.RADIUS)))
    assert df.where(agree == 0).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string, pivot int")


def test_nearest_on_few(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    x[10] = x[11] = x[12] = x[3]
    rows = [(i, [float(v) for v in x[i]], 1, "s", 2) for i in range(60)]
    odd = [(100, None, 1, "", 1), (120, [0.0] * 8, 1, "", 1), (140, [float("nan")] + [1.0] * 7, 1, "", 1), (160, [None] + [1.0] * 7, 1, "", 1), (180, [float("inf")] * 8, 1, "", 1), (None, [1.0] * 8, 1, "", 1)]
    got = collections.defaultdict(list)
    for r in ann.nearest(vectors(spark, rows + odd), "vec_id % 20 = 0", k=20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    assert set(got) == {0, 20, 40}
    for q, found in got.items():
        s = (x.astype(float) * x[q].astype(float)).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(60), -s)) if i != q][:20]
        assert [v for v, _, _ in found] == want and [r for _, _, r in found] == list(range(1, 21))
        assert all(abs(score - s[v]) < 1e-12 for v, score, _ in found)
    assert len(ann.nearest(vectors(spark, rows[:5]), "vec_id % 20 = 0").collect()) == 4
    assert ann.nearest(vectors(spark, odd), "vec_id % 20 = 0").collect() == []


def test_index_grows_with_the_vectors():
    """Each query meets a falling share of the vectors as the table grows, and postings per vector stay as they are."""
    share = [ann.LIST * files / pivots for pivots, files in map(ann.index_size, (10_000, 50_000, 200_000, 1_000_000, 10_000_000))]
    assert all(b <= a for a, b in zip(share, share[1:])) and share[-1] < 0.4 * share[1]
    assert ann.index_size(ann.FEW)[0] == ann.index_size(ann.FEW)[1] and ann.index_size(10**12)[0] == ann.MOST


def test_nearest_among_many_copies(spark):
    """Of equal vectors those of smallest vec_id are found, by queries of the group and beside it; blocks and parts lose none."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 6)).astype(np.float32)
    x[100:700] = x[5]
    rows = [(i, [float(v) for v in x[i]], 1, "s", 2) for i in range(900)]
    for block in (ann.BLOCK, 100):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(ann, "BLOCK", block)
            got = collections.defaultdict(list)
            for r in ann.nearest(vectors(spark, rows), "vec_id % 20 = 0").orderBy("query_id", "rank").collect():
                got[r["query_id"]].append(r["vec_id"])
        assert len(got) == 45
        for q, found in got.items():
            s = (x.astype(float) * x[q].astype(float)).sum(axis=1)
            assert found == [i for i in np.lexsort((np.arange(900), -s)) if i != q][:20]


def test_recall_of_vectors_of_unlike_length(spark, monkeypatch):
    """Long vectors are the nearest of many queries, also of those whose direction is another."""
    monkeypatch.setattr(ann, "FEW", 0)
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(4000, 32)) * np.exp(rng.normal(size=(4000, 1)))).astype(np.float32)
    got = collections.defaultdict(set)
    for r in ann.nearest(vectors(spark, [(i, [float(v) for v in x[i]], 1, "s", 2) for i in range(4000)]), "vec_id % 20 = 0").collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q, found in got.items():
        s = (x.astype(float) * x[q].astype(float)).sum(axis=1)
        hits += len(found & set([i for i in np.lexsort((np.arange(4000), -s)) if i != q][:20]))
    assert len(got) == 200 and hits >= 0.9 * 4000


@DATA
def test_recall(spark):
    sf = os.path.join(os.path.dirname(SF), "sf0.1")
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = table.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = collections.defaultdict(set)
    for r in ann.nearest(table, "vec_id % 20 = 0").collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(axis=1)
        s[i] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits, total = hits + len(best & got[ids[i]]), total + len(best)
    assert hits >= 0.9 * total


@DATA
def test_pipeline_against_its_stages(spark):
    """What run() returns follows from brute-force versions of the stages' rules on the same rows."""
    import corpus_pipeline
    from campusweave.llm import quality, secrets, sentencepiece
    from tests.llm.test_near_dedup import brute

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = {r["doc_id"] for r in quality.sampled(docs, quality.learn(docs, labels)).where("kept").collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(d in kept for d in rows if known.get(d) == 1)
    texts = [(d, rows[d]["text"]) for d in sorted(kept)]
    texts = [(d, t) for d, t in texts if brute(texts)[d][2]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in windows_by_hand([(d, t) for d, t in texts], items)}
    texts = [(d, secrets.redacted(t, secrets.base_spans(t) + secrets.structural_spans(t))) for d, t in texts if d not in bad]
    coder = sentencepiece.Encoder(sentencepiece.load())
    want = {d: ids for (d, _), ids in zip(texts, coder.encode([t for _, t in texts]), strict=True)}
    assert {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()} == want
    assert [len(x) for x in corpus_pipeline.STAGES] == [2] * 5


@DATA
def test_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a b c password=abcdef", "en", "s", 21, "more"), (2, None, None, None, None, None), (None, "", "en", "s", 0, "x")], "doc_id long, text string, lang string, source string, n_chars long, extra string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_registered():
    names = [x for x in driver.queries() if x.startswith("op")]
    assert len(names) == 10 and "pipeline" in driver.queries() and set(queries.QUERIES) <= set(driver.queries())
