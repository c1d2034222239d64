"""The levelled index of stored jobs against the plain tables; what its look-ups read; crashes and repeats."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postweave import schemas as S
from postweave.operators import tables as T
from postweave.operators.jobindex import JobIndex


@pytest.fixture
def store(spark, tmp_path):
    return T.JobTables(str(tmp_path))


def parsed(spark, ids, title="Role"):
    known = {"id": F.col("id"), "raw_id": F.concat(F.lit("r"), "id"), "status": F.lit("parsed"), "job_title": F.lit(title), "reviewer_notes": F.lit(""),
             "confidence": F.lit(0.9), "parsed_at": F.timestamp_seconds(F.crc32(F.col("id").cast("binary")) % 1000)}
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    return rows.select(*(known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.PARSED))


def events(spark, ids, status, seq=1):
    now = F.timestamp_seconds(F.lit(10_000 + seq))
    return T.status_events(spark.createDataFrame([(i,) for i in ids], "job_id string"), status, f"n{seq}", now, seq)


def state(df):
    return sorted((r.id, r.status, r.job_title, r.reviewer_notes) for r in df.collect())


def plain(spark, store):
    return T.current_jobs(store.parsed(spark), store.status_log(spark)).drop("run_id")


def check(spark, store, ids):
    """Everything that the index answers, against the tables read whole."""
    want = plain(spark, store)
    assert state(T.current_jobs(store.parsed(spark), store.last_events(spark))) == state(want)
    assert state(store.pending(spark, None)) == state(T.pending(want, None))
    assert state(store.pending(spark, 3)) == state(T.pending(want, 3))
    asked = spark.createDataFrame([(i,) for i in [*ids, "none"]], "job_id string")
    assert state(store.jobs_of(spark, asked)) == state(want.filter(F.col("id").isin([*ids, "none"])))
    for i in [*ids[:2], "none"]:
        assert state(store.job(spark, i)) == state(T.get_by_id(want, i))


def named(run, n=20):
    return [f"{run}-{i:03d}" for i in range(n)]


def test_levels_and_tail_give_the_plain_answer(spark, store):
    check(spark, store, ["a"])
    store.save_parsed(parsed(spark, named("a")), "run-a")
    store.log_status(events(spark, named("a")[:9], "sent"), "run-a")
    check(spark, store, named("a")[8:10])
    assert store.compact_log(spark) == 1 and store.compact_log(spark) == 1
    check(spark, store, named("a")[8:10])
    for k, run in enumerate("bcdef"):
        store.save_parsed(parsed(spark, named(run)), f"run-{run}")
        # Events of jobs that lie in lower levels, some of them back to parsed.
        store.log_status(events(spark, [named(r)[3 + k] for r in "ab"] + named(run)[:4], ("rejected", "parsed", "failed")[k % 3], 2 + k), f"review-{k}")
        if k in (1, 4):
            check(spark, store, [named("a")[3 + k], named(run)[0]])
        if k != 4:
            store.index.compact(spark, ratio=2, file_rows=16)
    manifest = store.index.manifest(spark)
    assert len(manifest.levels) >= 2 and manifest.version == 5
    # A vacuum removes what the newest manifest does not name, and nothing else.
    assert store.index.vacuum(spark) > 0 and store.index.vacuum(spark) == 0
    check(spark, store, [named("a")[3], named("f")[0]])


def test_events_before_their_rows(spark, store):
    """Whatever the order of saving: an event that a level took in before the job's row still counts."""
    store.log_status(events(spark, named("z", 8)[:4], "sent") .unionByName(events(spark, named("z", 8)[4:5], "parsed")), "early")
    store.index.compact(spark, ratio=2, file_rows=1)
    with pytest.raises(ValueError, match="twice"):
        store.index.compact(spark, ratio=1)
    store.save_parsed(parsed(spark, named("z", 8)), "run-z")
    check(spark, store, named("z", 8)[3:5])
    store.save_parsed(parsed(spark, named("y", 3)), "run-y")
    store.index.compact(spark, ratio=100, file_rows=100)
    check(spark, store, named("z", 8)[3:5])


def test_a_level_has_a_bounded_number_of_files(spark, store, monkeypatch):
    """More rows make larger files: what the driver samples and lists of a level does not grow with the store."""
    monkeypatch.setattr("postweave.operators.jobindex.LEVEL_FILES", 3, raising=False)
    for k in range(2):
        store.save_parsed(parsed(spark, named(f"r{k}", 40)), f"run-{k}")
        store.log_status(events(spark, named(f"r{k}", 40)[:7], "sent", k), f"run-{k}")
        store.index.compact(spark, ratio=100, file_rows=2)
    manifest = store.index.manifest(spark)
    files = spark.read.parquet(manifest.levels[1]).inputFiles()
    assert list(manifest.levels) == [1] and 1 < len(files) <= 3
    check(spark, store, [named("r0")[3], named("r1", 40)[39]])


def test_current_status_reads_the_newest_levels_and_the_tail(spark, store):
    for k in range(6):
        store.save_parsed(parsed(spark, named(f"r{k}", 5)), f"run-{k}")
        store.log_status(events(spark, named(f"r{k}", 5)[:2], "sent", k), f"run-{k}")
        store.compact_log(spark)
    store.log_status(events(spark, ["r0-004"], "rejected", 9), "by-hand")
    read = sorted({f.split("/run_id=")[-1].split("/")[0] if "run_id=" in f else "level" for f in store.last_events(spark).inputFiles()})
    assert read == ["by-hand", "level"] and len(store.index.manifest(spark).levels) == 1


def scan_counts(df):
    """Files opened and rows that came out of the row groups read, over all scans of the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, files, rows = [plan], 0, 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        if "FileSourceScan" in node.getClass().getSimpleName():
            metrics = node.metrics()
            files += metrics.apply("numFiles").value()
            rows += metrics.apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return files, rows


def test_look_up_opens_two_row_groups_of_a_hundred_runs(spark, store):
    jobs = parsed(spark, named("x", 2000)).withColumn("run", F.pmod(F.xxhash64("id"), F.lit(100)))
    jobs = jobs.persist()
    for i in range(100):
        store.save_parsed(jobs.filter(F.col("run") == i).drop("run").coalesce(1), f"run-{i}")
    store.log_status(events(spark, named("x", 2000)[::3], "sent"), "delivery")
    store.index.compact(spark, file_rows=200)
    entries = store.index._entries(spark, 1).filter("kind = 'file'")
    assert entries.select("name").distinct().count() >= 8
    found = store.index.find(spark, ["x-700"])
    files, _ = scan_counts(found)
    # One file per status whose ranges hold the id; Bloom filter and statistics leave one row group among them.
    assert files <= 2
    row = store.job(spark, "x-700")
    files, rows = scan_counts(row)
    assert files == 1 and rows <= 40 and row.first().status == "parsed"
    # The queue reads the files that can hold the status, and no others.
    holding = entries.filter("status = 'parsed'").select("name").distinct().count()
    assert len(store.index.with_status(spark, "parsed").inputFiles()) == holding < entries.select("name").distinct().count()
    jobs.unpersist()


def test_bloom_filters_are_written(spark, store):
    import glob

    import pyarrow.parquet as pq

    store.save_parsed(parsed(spark, named("x")), "run-x")
    store.compact_log(spark)
    for pattern, column in ((f"{store.path('parsed_jobs')}/*/*.parquet", "id"), (f"{store.path('job_index')}/level-*/*.parquet", "job_id")):
        for f in glob.glob(pattern):
            meta = pq.ParquetFile(f).metadata
            if meta.num_rows:
                size = max(sum(meta.row_group(0).column(i).total_compressed_size for i in range(meta.num_columns)), 1)
                # Bytes between the columns and the footer are the filters.
                assert open(f, "rb").seek(0, 2) > size


def test_a_compaction_that_stops_early_loses_nothing(spark, store, monkeypatch):
    store.save_parsed(parsed(spark, named("a")), "run-a")
    store.compact_log(spark)
    store.save_parsed(parsed(spark, named("b")), "run-b")
    store.log_status(events(spark, named("a")[:5] + named("b")[:5], "sent"), "run-b")

    def lost(self, spark, version):
        raise RuntimeError("lost")

    # Stopped after the level was written, before the manifest.
    real = JobIndex._manifest_path
    with monkeypatch.context() as m:
        m.setattr(JobIndex, "_manifest_path", lambda self, v: lost(self, None, v) if v == 2 else real(self, v))
        with pytest.raises(RuntimeError):
            store.compact_log(spark)
    check(spark, store, [named("a")[0], named("b")[6]])
    # Stopped in the middle of the manifest: the folder is there without its mark.
    (tmp := __import__("pathlib").Path(store.path("job_index")) / "manifest" / "version=000000000002").mkdir()
    (tmp / "part-0.parquet").write_bytes(b"half")
    check(spark, store, [named("a")[0], named("b")[6]])
    assert store.compact_log(spark) == 3
    check(spark, store, [named("a")[0], named("b")[6]])


def test_a_repeated_run_replaces_what_the_levels_hold_of_it(spark, store):
    store.save_parsed(parsed(spark, named("a", 8)), "run-a")
    store.log_status(events(spark, named("a", 8)[:4], "failed"), "run-a")
    store.save_parsed(parsed(spark, named("b", 8)), "run-b")
    store.compact_log(spark)
    store.save_parsed(parsed(spark, named("a", 6), "Again"), "run-a")
    store.log_status(events(spark, named("a", 6)[:2], "sent"), "run-a")
    check(spark, store, named("a", 8))
    store.compact_log(spark)
    check(spark, store, named("a", 8))
    assert {r.job_title for r in store.jobs_of(spark, spark.createDataFrame([(i,) for i in named("a", 8)], "job_id string")).collect()} == {"Again"}


def test_runs_being_written_are_not_taken_in(spark, store, tmp_path):
    store.save_parsed(parsed(spark, named("a")), "run-a")
    (tmp_path / "parsed_jobs" / "run_id=run-b" / "_temporary").mkdir(parents=True)
    store.compact_log(spark)
    assert [k for k in store.index.manifest(spark).runs] == [("parsed_jobs", "run-a")]
    (tmp_path / "parsed_jobs" / "run_id=run-b" / "_temporary").rmdir()
    store.save_parsed(parsed(spark, named("b")), "run-b")
    check(spark, store, [named("b")[0]])
