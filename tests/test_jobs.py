import json

import pytest
from pyspark.sql import functions as F

from postweave import schemas as S
from postweave.functions import rules as R
from postweave.operators import deliver as D
from postweave.operators import metrics as M
from postweave.operators import model as N
from postweave.operators import parse as P
from postweave.operators import review as V
from postweave.operators import tables as T
from postweave.operators import validate as W
from postweave.plans import intake as J
from postweave.streaming import cycle as C


def raw_rows(spark, rows):
    """rows: (seq, source, external_id, text, metadata)."""
    df = spark.createDataFrame(rows, "seq long, source string, external_id string, raw_text string, metadata string")
    return df.select("seq", F.col("seq").cast("string").alias("id"), "source", "external_id", "raw_text",
                     F.lit(None).cast("string").alias("source_url"), F.current_timestamp().alias("fetched_at"), "metadata")


def mock_source(spark, name, n, dup, start):
    return raw_rows(spark, [
        (start + i, "manual" if name == "alpha" else "indeed_rss", f"{name}_{'dup' if i == dup else i}",
         f"Title: {name.title()} Engineer {'Dup' if i == dup else i}\nCompany: Mock Company {name.upper()}\nDescription: Python", None)
        for i in range(n)
    ])


def mock_parser(raw):
    """First two lines as title and company; duplicates get low confidence and no skills."""
    line = F.split("raw_text", "\n")
    low = F.col("external_id").contains("dup")
    return P._finish(raw.select(
        F.col("id").alias("raw_id"), F.replace(line[0], F.lit("Title: "), F.lit("")).alias("job_title"),
        F.replace(line[1], F.lit("Company: "), F.lit("")).alias("company"), F.when(low, 0.45).otherwise(0.95).alias("confidence"),
        F.when(low, F.array().cast("array<string>")).otherwise(F.array(F.lit("Python"))).alias("required_skills"),
        F.lit("mock").alias("model_used"),
    ))


@pytest.fixture
def store(tmp_path):
    return T.JobTables(f"{tmp_path}/store")


@pytest.fixture
def to_files(tmp_path):
    return D.to_files(f"{tmp_path}/delivered")


def test_bulk_run(spark, store, to_files):
    """8 + 6 rows, target 15: 14 taken in, the two dup rows flagged with two issues each."""
    intake = J.Intake(store, to_files, parse=mock_parser)
    sources = {"alpha": lambda: mock_source(spark, "alpha", 8, 2, 0), "beta": lambda: mock_source(spark, "beta", 6, 1, 100)}
    r = J.run_bulk(spark, intake, sources, target=15, run_id="one").first()
    assert (r.fetched, r.parsed, r.validated, r.flagged, r.errors, r.duplicates) == (14, 14, 12, 2, 0, 0)
    assert r.per_source == {"manual": 8, "indeed_rss": 6}
    flagged = store.parsed(spark).filter(F.size("validation_issues") > 0).collect()
    assert [len(f.validation_issues) for f in flagged] == [2, 2]
    jobs = T.current_jobs(store.parsed(spark), store.status_log(spark))
    assert {x.status for x in jobs.collect()} == {"sent"}
    again = J.run_bulk(spark, intake, sources, target=15, run_id="two").first()
    assert (again.fetched, again.parsed, again.duplicates) == (14, 0, 14)
    same = J.run_bulk(spark, intake, sources, target=15, run_id="one").first()
    assert (same.parsed, store.raw(spark).count(), store.runs(spark).count()) == (14, 14, 2)


def test_failing_source_does_not_stop_the_others(spark, store, to_files):
    def broken():
        raise OSError("no such page")

    sources = {"ok": lambda: mock_source(spark, "alpha", 3, 9, 0), "bad": broken}
    r = J.run_bulk(spark, J.Intake(store, to_files, parse=mock_parser), sources, target=10).first()
    assert (r.fetched, r.duplicates, r.error) == (3, 0, None)
    r = J.run_bulk(spark, J.Intake(store, to_files), {"bad": broken}).first()
    assert (r.fetched, r.errors, r.error) == (0, 1, "all sources failed")
    tries = sorted((x.source, x.ok, x.error) for x in store.fetches(spark).collect())
    assert tries == [("bad", False, "no such page")] * 2 + [("ok", True, None)]


def test_failing_run_is_closed_as_failed(spark, store, to_files):
    def broken(raw):
        raise RuntimeError("no parser")

    sources = {"ok": lambda: mock_source(spark, "alpha", 3, 9, 0)}
    r = J.run_bulk(spark, J.Intake(store, to_files, parse=broken), sources, run_id="one").first()
    assert (r.errors, r.error, r.finished_at is not None) == (1, "no parser", True)
    assert [x.state for x in M.run_status(store.runs(spark)).collect()] == ["failed"]


def test_run_is_running_until_it_ends(spark, store, to_files):
    seen = []

    def parse(raw):
        seen.extend(x.state for x in M.run_status(store.runs(raw.sparkSession)).collect())
        return mock_parser(raw)

    J.run_bulk(spark, J.Intake(store, to_files, parse=parse), {"ok": lambda: mock_source(spark, "alpha", 3, 9, 0)})
    assert seen == ["running"] and [x.state for x in M.run_status(store.runs(spark)).collect()] == ["completed"]


def test_runs_numbered_alike(spark, store, to_files, tmp_path):
    """Two runs that start at the same seq have ids of their own; a repeated run has the same ids and sends nothing twice."""
    intake = J.Intake(store, to_files, parse=mock_parser)
    for run, name in (("run-9", "Job A"), ("run-10", "Job B"), ("run-9", "Job A")):
        J.ingest(intake, raw_rows(spark, [(0, "manual", "x", f"Title: {name}\nCompany: C", None)]), run)
    jobs = store.parsed(spark).collect()
    assert sorted(j.job_title for j in jobs) == ["Job A", "Job B"] and len({j.id for j in jobs}) == 2
    assert spark.read.json(f"{tmp_path}/delivered").count() == 2


def test_last_saved_row_wins_whatever_the_run_ids(spark, store):
    for run, text in (("run-9", "first"), ("run-10", "second")):
        store.save_raw(raw_rows(spark, [(0, "manual", "x", text, None)]), run)
    assert [r.raw_text for r in store.raw(spark).collect()] == ["second"] and store.raw_rows(spark).count() == 2


def test_queue_longer_than_a_request(spark):
    rows = [(str(i), "parsed", 0.9, []) for i in range(1200)]
    jobs = spark.createDataFrame(rows, "id string, status string, confidence double, validation_issues array<string>").withColumn("parsed_at", F.current_timestamp())
    assert V.queue_targets(jobs, 0.5, True).count() == 1200 and V.queue_targets(jobs, 0.5, True, limit=1000).count() == 1000


def test_compact_log(spark, store):
    for i, status in enumerate(("sent", "rejected")):
        store.log_status(T.status_events(spark.createDataFrame([("a",)], "job_id string"), status, event_seq=i), f"r{i}")
    store.compact_log(spark)
    rows = store.last_events(spark).collect()
    assert [(r.job_id, r.status) for r in rows] == [("a", "rejected")]
    assert not [f for f in store.last_events(spark).inputFiles() if "status_log" in f]


def test_stream_equals_batch(spark, store, to_files, tmp_path):
    """Ids seen on rows that a fingerprint dropped stay seen, over micro-batches as within one."""
    rows = [(0, "manual", "a", "Title: x", None), (1, "manual", "b", "Title: x", None), (2, "manual", "b", "Title: y", None),
            (3, "manual", None, "Title: z", None), (4, "manual", "", "Title: z", None), (5, "manual", "c", "Title: w", None),
            (6, "manual", "a", "Title: v", None), (7, "manual", "d", "Title: w", None), (8, "manual", "e", "Title: u", None)]
    df = raw_rows(spark, rows)
    for part in range(3):
        df.filter(F.floor(F.col("seq") / 3) == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    C.run_cycle(J.Intake(store, to_files), stream, f"{tmp_path}/ck").awaitTermination()
    assert sorted(r.seq for r in store.raw(spark).collect()) == [0, 3, 5, 8]
    total = store.cycles(spark).agg(F.sum("fetched"), F.sum("parsed"), F.sum("handoff_ok"), F.sum("errors")).first()
    assert tuple(total) == (4, 4, 4, 0)


def test_compacted_keys_are_still_seen(spark, store, to_files, tmp_path):
    rows = [(i, "manual", f"id{i % 4}", f"Title: t{i % 6}", None) for i in range(12)]
    df = raw_rows(spark, rows)
    for part in range(4):
        df.filter(F.floor(F.col("seq") / 3) == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    C.run_cycle(J.Intake(store, to_files), stream, f"{tmp_path}/ck", compact_every=2).awaitTermination()
    assert sorted(r.seq for r in store.raw(spark).collect()) == [0, 1, 2, 3]
    assert spark.read.parquet(store.path("seen_compact")).select("run_id").distinct().count() == 1
    values = sorted((r.kind, r.value) for r in store.seen_keys(spark).filter("kind = 'id'").collect())
    assert values == [("id", f"id{i}") for i in range(4)]


def test_gate_and_review(spark, store, to_files):
    intake = J.Intake(store, to_files, review_gate=True)
    raw = raw_rows(spark, [(i, "manual", None, f"Title: Role {i}\nCompany: A\n{'Python' if i % 2 else ''}", None) for i in range(6)])
    assert {r.status for r in J.ingest(intake, raw).collect()} == {"parsed"}
    done = J.review(intake, spark, "approve", "ann", exclude_flagged=True, confidence_min=0.5).collect()
    assert len(done) == 3 and all(r.success and r.status == "sent" for r in done)
    jobs = T.current_jobs(store.parsed(spark), store.status_log(spark))
    assert sorted(r.status for r in jobs.collect()) == ["parsed"] * 3 + ["sent"] * 3
    again = J.review(intake, spark, "approve", "ann", ids=spark.createDataFrame([(done[0].job_id,), ("x",)], "job_id string")).collect()
    assert sorted(r.message for r in again) == sorted([f"Job {done[0].job_id} is in status sent, cannot approve", "Job x not found"])
    J.review(intake, spark, "reject", "ann", reason="spam", ids=spark.createDataFrame([(done[0].job_id,)], "job_id string"))
    jobs = T.current_jobs(store.parsed(spark), store.status_log(spark))
    row = jobs.filter(F.col("id") == done[0].job_id).first()
    assert (row.status, row.reviewer_notes, row.reviewed_by) == ("rejected", "spam", "system")
    assert T.pending(jobs).count() == 3
    with pytest.raises(ValueError, match="Invalid bulk action: pause"):
        J.review(intake, spark, "pause", "ann")


def test_single_ingest_with_sender(spark, store):
    def send(body):
        assert isinstance(body["required_skills"], list)
        if body["job_title"] == "Role 0":
            raise D.SendError("gone", 410)

    intake = J.Intake(store, send=D.to_sender(send))
    done = J.ingest(intake, raw_rows(spark, [(i, "manual", None, f"Title: Role {i}", None) for i in range(2)])).orderBy("status").collect()
    assert [(r.success, r.status, r.message) for r in done] == [(False, "failed", "Parse OK, handoff failed: gone"), (True, "sent", "")]
    notes = {r.status: r.reviewer_notes for r in T.current_jobs(store.parsed(spark), store.status_log(spark)).collect()}
    assert notes == {"sent": "Auto-handoff", "failed": "gone"}


def test_files_with_nulls(spark, store, tmp_path):
    intake = J.Intake(store, send=D.to_files(f"{tmp_path}/out"))
    J.ingest(intake, raw_rows(spark, [(1, "manual", None, "Title: Role", None)]))
    body = json.loads(spark.read.text(f"{tmp_path}/out").first()[0])
    assert body["job_title"] == "Role" and body["company"] is None and body["salary_currency"] == "USD"


def test_delivery_attempts(spark):
    def send(body):
        raise {"a": D.SendError("net"), "b": D.SendError("bad", 422), "c": KeyError("k"), "d": D.SendError("down", 502)}[body["job_id"]]

    df = spark.createDataFrame([(x,) for x in "abcd"], "job_id string")
    assert {r.job_id: (r.ok, r.attempts) for r in D.deliver(df, send).collect()} == {
        "a": (False, 3), "b": (False, 1), "c": (False, 1), "d": (False, 3)}


def test_workable_rows(spark):
    meta = json.dumps({"title": "", "company": "Meta Co", "location": {"city": "Oslo", "subregion": "", "countryName": "Norway"}, "workplace": "remote"})
    rows = [(1, "workable", "1", "Title: From text\nLocation: Rome", meta), (2, "workable", "2", "nothing here", None), (3, "manual", "3", "nothing", None)]
    a, b, c = P.parse_structured(raw_rows(spark, rows)).orderBy("raw_id").collect()
    assert (a.job_title, a.company, a.location, a.remote, a.confidence, a.parse_warnings) == ("From text", "Meta Co", "Oslo, Norway", True, 0.7, [])
    assert (b.job_title, b.confidence) == (S.FAILED_TITLE, 0.0)
    assert (c.job_title, c.confidence, c.parse_warnings) == (S.UNKNOWN_TITLE, 0.3, [P.NO_TITLE, P.NO_COMPANY])
    assert a.id != b.id and a.status == "parsed"


ANSWERS = {
    '{"job_title": "A"}': ("A", 1.0, None),
    '```json\n{"job_title": "A", "salary": {"min": 5, "max": null}}\n```': ("A", 1.0, (5, None, "USD", "yearly")),
    '{"job_title": "A", "salary": {}, "confidence": "0.4"}': ("A", 0.4, None),
    '{"confidence": 0}': (S.UNKNOWN_TITLE, 0.0, None),
    '{"job_title": null}': None, '{"job_title": 5}': None, "[]": None, "{": None, '{"job_title": "A", "salary": 5}': None,
    '{"job_title": "A", "required_skills": null}': None, '{"job_title": "A", "required_skills": ["a", null]}': None,
    '{"job_title": "A", "years_experience": 1.5}': None, '{"job_title": "A", "years_experience": "3"}': ("A", 1.0, None),
    '{"job_title": "A", "confidence": null}': None, '{"job_title": "A", "remote": null}': None, '{"job_title": "A", "remote": 7}': None,
    '{"job_title": "A", "salary": {"currency": null}}': None, '{"job_title": "A", "salary": {"min": 1, "period": "hourly"}}': ("A", 1.0, (1, None, "USD", "hourly")),
}


def test_decoding(spark):
    df = spark.createDataFrame([(str(i), "m", a) for i, a in enumerate(ANSWERS)], "raw_id string, model_used string, response string")
    got = {r.raw_id: r for r in P.decode_model_json(df).collect()}
    for i, (answer, want) in enumerate(ANSWERS.items()):
        r = got[str(i)]
        if want is None:
            assert (r.job_title, r.confidence, len(r.parse_warnings)) == (S.FAILED_TITLE, 0.0, 1), answer
        else:
            assert (r.job_title, r.confidence, r.salary and tuple(r.salary)) == want, answer
        assert usable(answer) == (want is not None), answer


def test_decoding_reads_lists_in_generated_code(spark):
    """A lambda would be interpreted, with the reading of the variant under it."""
    df = spark.createDataFrame([], "raw_id string, model_used string, response string")
    assert "exists(" not in P.decode_model_json(df)._jdf.queryExecution().optimizedPlan().toString()


def usable(answer):
    try:
        return N._usable(answer)
    except Exception:  # noqa: BLE001
        return False


def test_model_attempts(spark):
    def model(prompt):
        if "bad" in prompt:
            return "{"
        return json.dumps({"job_title": "ok"})

    raw = raw_rows(spark, [(1, "manual", None, "good", None), (2, "manual", None, "bad", None)])
    rows = N.extract_with_model(raw, model, "m").orderBy("raw_id").collect()
    assert [(r.job_title, r.failed_attempts, r.used_fallback) for r in rows] == [("ok", 0, False), (S.FAILED_TITLE, 3, False)]
    assert rows[1].parse_warnings[0].startswith("All 3 parse attempts failed")
    rows = N.extract_with_model(raw, model, "m", fallback=lambda p: '{"job_title": "fb"}', fallback_name="f").orderBy("raw_id").collect()
    assert [(r.job_title, r.model_used, r.used_fallback) for r in rows] == [("ok", "m", False), ("fb", "f", True)]


def test_overlay(spark):
    raw = raw_rows(spark, [(i, "manual", None, f"Title: T{i}\nCompany: C", None) for i in range(4)])
    given = {"0": '{"job_title": "M", "confidence": 0.3}', "1": '{"job_title": "M", "confidence": 0.29}', "2": "{"}
    answers = spark.createDataFrame([(k, "m", v) for k, v in given.items()], "raw_id string, model_used string, response string")
    rows = P.hybrid_overlay(P.decode_model_json(answers), P.parse_structured(raw)).orderBy("raw_id").collect()
    assert [r.job_title for r in rows] == ["M", "T1", "T2", "T3"]
    assert [r.parse_warnings for r in rows[1:]] == [[P.FELL_BACK]] * 3
    shorter = J.hybrid_parser(lambda _: P.decode_model_json(answers))(raw).orderBy("raw_id").collect()
    assert [r.asDict() | {"parsed_at": None} for r in shorter] == [r.asDict() | {"parsed_at": None} for r in rows]


def test_rules_can_be_added(spark):
    raw = raw_rows(spark, [(1, "manual", None, "Title: T", None)])
    own = (*R.STANDARD, lambda: F.when(F.length("job_title") < 3, "Title too short"))
    r = W.validate(P.parse_generic(raw), own).first()
    assert r.validation_issues == [R.NO_SKILLS, "Title too short"] and not r.is_valid


def test_confidence_text(spark):
    df = spark.createDataFrame([(0.345,), (0.355,), (0.005,), (0.5,)], "confidence double")
    got = [r[0] for r in df.select(R.confidence_high_enough()).collect()]
    assert got == [f"Low LLM confidence ({c:.0%}) — review extraction carefully" if c < 0.5 else None for c in (0.345, 0.355, 0.005, 0.5)]


def test_stats_of_empty_store(spark, store):
    got = {(r.section, r.name): r.value for r in T.stats(store.raw(spark), store.parsed(spark)).collect()}
    assert got == {("total", "raw"): 0.0, ("total", "parsed"): 0.0, ("total", "avg_confidence"): 1.0}


def test_native_operators_have_no_python_node(spark):
    raw = raw_rows(spark, [(1, "manual", None, "Title: T", None)])
    plan = W.validate(P.parse_structured(raw))._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("EvalPython", "InPandas", "InArrow"))


def test_progress_is_read_while_a_run_goes_on(spark, store, to_files):
    """Another session sees the steps that are done; the counts are those of the steps."""
    seen = []

    def send(payloads, run_id):
        seen.extend((r.step, r.current, r.total) for r in store.progress(spark.newSession()).orderBy("at").collect())
        return to_files(payloads, run_id)

    assert store.progress(spark).count() == 0
    J.run_bulk(spark, J.Intake(store, send, parse=mock_parser), {"ok": lambda: mock_source(spark, "alpha", 3, 9, 0), "no": lambda: 1 / 0}, run_id="r")
    assert seen == [("fetching", 1, 2), ("saving", 3, 3), ("parsing", 3, 3)]
    last = store.progress(spark).orderBy("at").collect()[-1]
    assert (last.run_id, last.step, last.current, last.total) == ("r", "delivering", 3, 3)


def test_parts_of_many_files_are_kept_as_one_batch_would(spark, tmp_path):
    """A part that lands as several files, dealt by a key other than the arrival, is still one micro-batch."""
    from postweave.catalog.queries import QUERIES

    for t in ("customer", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    # Every external id stands six times, twice in each part.
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter("o_orderkey between 1 and 60")
    orders.withColumn("o_orderkey", F.expr("o_orderkey % 10 + 1 + 9000 * (o_orderkey div 10)")).write.parquet(f"{tmp_path}/orders.parquet")
    shuffled = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in shuffled}
    for k, v in shuffled.items():
        spark.conf.set(k, v)
    try:
        got = QUERIES["streaming_ingest"](spark, str(tmp_path)).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, QUERIES["dedup_postings"](spark, str(tmp_path)).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
