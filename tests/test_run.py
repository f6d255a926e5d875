"""The incremental run: one parse for all outputs, seen keys, settled rankings, progress."""

import os

import pytest
from pyspark.sql import functions as F

from campusweave.operators import html as H
from campusweave.plans import run
from campusweave.sources import pages as P
from campusweave.sources import seen, staging
from campusweave.sources.datasets import read_dataset
from campusweave.streaming import ingest
from tests.conftest import rows

STATE = '{"props":{"initialProps":{"pageProps":{"data":{"basic_info":{"ranking":[{"agency":"NIRF","rank":"3","year":"2024"}]}}}}}}'
PAGES = [
    ("1", "a", "info", "u", f'<title>A College</title><script id="__NEXT_DATA__">{STATE}</script>'),
    ("1", "a", "hostel", "u", "<p>gym</p>"),
    ("1", "a", "placements", "u", "<p>Ranked 8 by Outlook. Highest package: INR 9 LPA</p>"),
    ("2", "b", "reviews", "u", '<div class="review-card"><p class="text">ok</p></div>'),
    ("2", "b", "courses", "u", "<h2>Courses</h2><table><tr><th>Course</th><th>Fees</th></tr><tr><td>BCA</td><td>INR 1 L</td></tr></table>"),
    ("3", "c", "cutoff", "u", "<p>x</p>"),
    ("3", "c", "faculty", "u", "<p>a</p><![foo[x]]>"),
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_parse_serves_all_outputs(spark, tmp_path, monkeypatch):
    calls = []
    pages = spark.createDataFrame(PAGES, P.PAGES)
    parse = type(pages).mapInArrow
    monkeypatch.setattr(type(pages), "mapInArrow", lambda self, *a, **k: calls.append(1) or parse(self, *a, **k))
    run.parse_batch(pages, str(tmp_path / "out"), "0")
    assert len(calls) == 1
    apart = {n: rows(df, *df.columns) for n, df in run.build_datasets(pages).items()}
    assert len(calls) > 1
    assert {n: rows(df, *df.columns) for n, df in run.load_datasets(spark, str(tmp_path / "out")).items()} == apart
    assert rows(run.load_rejected(spark, str(tmp_path / "out")), "college_id", "page_type") == [("3", "faculty")]


def test_jobs_on_staged_pages_have_no_python_step(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, P.PAGES)
    staged = staging.stage_pages(pages, str(tmp_path / "s"))
    for name, df in run.build_datasets(staged).items():
        assert "MapInArrow" not in plan(df), name
    one = plan(run.build_datasets(staged)["hostel"])
    assert "PartitionFilters: [isnotnull(page_type" in one and "ReadSchema: struct<college_id:string,texts:array<string>,parse_error:string>" in one
    for df in (H.html_tables(staged, ["college_id"]), H.html_cards(staged, ["college_id"], H.has_class("review-card"), {"text": H.has_class("text")})):
        assert df.count() == 4 or df.count() == 1
        assert "Exchange" not in plan(df) and "MapInArrow" not in plan(df)
    staging.clear_staged(spark, str(tmp_path / "s"))
    assert staging.staged_pages(spark, str(tmp_path / "s")).count() == 0


def test_rankings_are_settled_when_written(spark, tmp_path):
    root = str(tmp_path / "out")
    batches = [[PAGES[2]], [PAGES[0]], [("9", "z", "placements", "u", "<p>Ranked 7 by Outlook.</p>")]]
    told = []
    for i, batch in enumerate(batches):
        run.parse_batch(spark.createDataFrame(batch, P.PAGES), root, str(i), buckets=4)
        found = run.load_datasets(spark, root)["rankings"]
        told.append(rows(found, "college_id", "ranking_body", "rank"))
        assert "Window" not in plan(found) and "Exchange" not in plan(found) and "Sort" not in plan(found)
    # the info page's own ranking takes the place of what was read in text
    assert told == [[("1", "Outlook", "#8")], [("1", "NIRF", "#3")], [("1", "NIRF", "#3"), ("9", "Outlook", "#7")]]
    run.parse_batch(spark.createDataFrame(batches[1], P.PAGES), root, "1", buckets=16)  # the stored count of buckets holds
    assert rows(run.load_datasets(spark, root)["rankings"], "college_id", "ranking_body", "rank") == told[-1]


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "k string")


def test_seen_keys_through_folds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen, "FOLD", 3)
    monkeypatch.setattr(seen, "PER_BUCKET", 2)
    path, done = str(tmp_path / "seen"), set()
    for i in range(8):
        names = [f"k{j}" for j in range(i, i + 4)]
        new = seen.unseen(keys(spark, *names, names[0]), path, ["k"], str(i))
        found = {r["k"] for r in new.collect()}
        assert found == set(names) - done and new.count() == len(found)
        seen.add(keys(spark, *found), path, ["k"], str(i))
        done |= found
        # the same batch again finds and enters the same
        assert {r["k"] for r in seen.unseen(keys(spark, *names), path, ["k"], str(i)).collect()} >= found
    now = seen.layout(spark, path)
    assert now["version"] == 2 and now["buckets"] > 1
    assert seen.unseen(keys(spark, *done), path, ["k"], "other").collect() == []
    assert seen.older(spark, path, ["k"], 2).count() + seen.recent(spark, path, ["k"], 2).count() == len(done)
    assert seen.older(spark, path, ["k"], 1).count() == 0  # the version before is emptied
    # a fold that was cut short before it was named is not in force
    spark.createDataFrame([("kx", "9", 0)], "k string, batch string, bucket int").write.partitionBy("bucket").parquet(f"{path}/base=3")
    assert [r["k"] for r in seen.unseen(keys(spark, "kx"), path, ["k"], "other").collect()] == ["kx"]


def test_seen_keys_read_do_not_grow(spark, tmp_path, monkeypatch):
    """What batch 50 reads of the seen keys is no more than what batch 5 reads."""
    monkeypatch.setattr(seen, "FOLD", 4)
    monkeypatch.setattr(seen, "PER_BUCKET", 8)
    path, read = str(tmp_path / "seen"), {}
    for i in range(51):
        names = [f"college-{i * 20 + j}" for j in range(20)]
        if i in (6, 50):  # as many recent batches at both
            few = keys(spark, *names[:3], f"college-{i * 10}").coalesce(1)
            others = seen.known_to_others(few, path, ["k"], str(i))
            read[i] = (sum(os.path.getsize(f.removeprefix("file:")) for f in others.inputFiles()), others.count())
            assert {r["k"] for r in seen.unseen(few, path, ["k"], str(i)).collect()} == set(names[:3])
        seen.add(keys(spark, *names).coalesce(1), path, ["k"], str(i))
    assert seen.layout(spark, path)["buckets"] >= 100
    (early_bytes, early_rows), (late_bytes, late_rows) = read[6], read[50]
    assert late_bytes <= 1.25 * early_bytes and late_rows <= 1.25 * early_rows


def test_stream_tells_of_its_batches(spark, tmp_path):
    source, root, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    for batch in (PAGES, [PAGES[0], ("8", "h", "hostel", "u", "x"), (None, "h", "hostel", "u", "x")]):
        spark.createDataFrame(batch, P.PAGES).coalesce(1).write.mode("append").parquet(source)
    assert ingest.stream_pages(spark, source, root, offsets, files_per_batch=1, buckets=4) == 2
    told = ingest.stream_progress(spark, root)
    assert rows(told, "batch", "rows_in", "new", "saved", "rejected", "saved_before", "saved_after") == [(0, 7, 7, 6, 1, 0, 6), (1, 2, 1, 1, 0, 6, 7)]
    assert all(r["trigger_ms"] >= r["batch_ms"] > 0 for r in told.collect())
    assert ingest.stream_pages(spark, source, root, offsets) == 0
    assert told.count() == 2


def test_a_failed_output_fails_the_batch(spark, tmp_path, monkeypatch):
    """No key counts as seen if an output could not be written; the next try completes the batch."""
    root = str(tmp_path / "out")
    pages = spark.createDataFrame(PAGES, P.PAGES)
    with monkeypatch.context() as broken:
        broken.setattr(run, "settled", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run.parse_batch(pages, root, "0")
    assert seen.recent(spark, f"{root}/_seen", run.PAGE_KEY, 0).count() == 0
    run.parse_batch(pages, root, "0")
    assert run.load_datasets(spark, root)["rankings"].count() == 1
    assert rows(run.load_progress(spark, root).select(F.sum("saved").alias("s")), "s") == [(6,)]


def test_a_batch_writes_what_its_page_types_give(spark, tmp_path, monkeypatch):
    """Outputs of page types that a batch does not hold are neither planned nor written; a batch that is repeated writes all."""
    root, built = str(tmp_path / "out"), []
    jobs = run.dataset_jobs

    def counted(*a):
        return {name: (lambda name=name, job=job: built.append(name) or job()) for name, job in jobs(*a).items()}

    monkeypatch.setattr(run, "dataset_jobs", counted)
    monkeypatch.setattr(run, "ranking_entries", lambda *a, made=run.ranking_entries, **k: built.append("rankings") or made(*a, **k))
    hostels = spark.createDataFrame([PAGES[1]], P.PAGES)
    run.parse_batch(hostels, root, "0")
    assert built == ["hostel"]
    assert {n: df.count() for n, df in run.load_datasets(spark, root).items() if df.count()} == {"hostel": 1}
    assert run.load_rejected(spark, root).count() == 0
    built.clear()
    run.parse_batch(spark.createDataFrame([PAGES[6], PAGES[0], PAGES[5]], P.PAGES), root, "1")
    assert sorted(built) == ["colleges", "faculty", "rankings"]
    assert run.load_rejected(spark, root).count() == 1
    built.clear()
    run.parse_batch(hostels, root, "0")
    assert sorted(built) == sorted(run.DATASETS) and run.load_datasets(spark, root)["hostel"].count() == 1


def test_what_is_not_there_yet_costs_no_job(spark, tmp_path):
    """A first batch looks nothing up: what is missing is known to be empty before anything runs."""
    path, group = str(tmp_path / "none"), f"none-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        assert seen.layout(spark, path) == (0, 0) and read_dataset(spark, path, run.ENTRIES).collect() == []
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert read_dataset(spark, path, run.ENTRIES).schema == run.ENTRIES
    new = seen.unseen(keys(spark, "a", "a", "b"), path, ["k"], "0")
    assert "Join" not in plan(new) and {r["k"] for r in new.collect()} == {"a", "b"}


def test_keys_spread_over_all_buckets_are_not_asked_for_them(spark, tmp_path, monkeypatch):
    """A batch of many keys reads the whole table at once, and gets the same."""
    monkeypatch.setattr(seen, "FOLD", 1)
    monkeypatch.setattr(seen, "PER_BUCKET", 4)
    path, names = str(tmp_path / "seen"), [f"k{i}" for i in range(12)]
    seen.add(keys(spark, *names), path, ["k"], "0")
    now = seen.layout(spark, path)
    assert now["buckets"] == 3
    fresh, group = keys(spark, *names, "new"), f"spread-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        found = seen.unseen(fresh, path, ["k"], "1", now, 13)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        seen.unseen(fresh, path, ["k"], "1", now, 2)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r["k"] for r in found.collect()] == ["new"]


def test_small_files_of_a_batch_are_dealt_out(spark, tmp_path):
    """Each small file is a split of its own, as work on pages costs far more than opening a file; the session's settings come back."""
    source, root, files = str(tmp_path / "in"), str(tmp_path / "out"), ingest.SPLITS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.range(0, files, 1, files).selectExpr("cast(id AS STRING) AS college_id", "'a' AS slug", "'hostel' AS page_type", "'u' AS url", "'<p>gym</p>' AS html").write.parquet(source)
    held = ["spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes", "spark.sql.maxConcurrentOutputFileWriters"]
    before = [spark.conf.get(key, None) for key in held]
    assert ingest.stream_pages(spark, source, root, str(tmp_path / "offsets"), files_per_batch=files, buckets=4) == 1
    assert [spark.conf.get(key, None) for key in held] == before
    assert sum(name.startswith("part-") for name in os.listdir(f"{root}/_arrived/batch=0")) == files
    assert run.load_datasets(spark, root)["hostel"].count() == files


def test_batches_of_any_name_and_of_nothing_new(spark, tmp_path):
    """The folders of a batch are known by its name, whatever is in it; pages that are all known give nothing."""
    root = str(tmp_path / "out")
    for name, pages in (("7 a", [PAGES[2]]), ("c=d", [PAGES[0], PAGES[0]]), ("e", [PAGES[0], PAGES[2]])):
        run.parse_batch(spark.createDataFrame(pages, P.PAGES), root, name, buckets=4)
    assert rows(run.load_datasets(spark, root)["rankings"], "college_id", "ranking_body", "rank") == [("1", "NIRF", "#3")]
    assert rows(run.load_progress(spark, root), "rows_in", "new") == [(1, 1), (2, 0), (2, 2)]
