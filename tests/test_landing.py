"""Landed payloads as a stream: the rows and numbers of a batch over the same folders, over restarts."""

from __future__ import annotations

import json

import pytest

from postweave.operators import deliver as D
from postweave.operators.tables import JobTables
from postweave.plans.intake import Intake
from postweave.streaming.cycle import run_cycle
from postweave.streaming.landing import raw_of_folders


def land(folder, name, pages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps({"page_seq": n, "unit": f"u{n}", "query": "q", "payload": p}) + "\n" for n, p in pages))


def workable(*ids):
    return json.dumps({"jobs": [{"id": i, "title": f"Role {i}", "description": "text"} for i in ids]})


def feed(*ids):
    items = "".join(f"<item><title>t</title><description>Title: feed {i}</description><guid>{i}</guid></item>" for i in ids)
    return f"<rss><channel>{items}</channel></rss>"


def test_equal_to_batch_over_a_restart(spark, tmp_path):
    folders = {"workable": str(tmp_path / "w"), "indeed_rss": str(tmp_path / "r")}
    tables = JobTables(f"{tmp_path}/store")
    intake = Intake(tables, D.to_files(f"{tmp_path}/out"))

    def run():
        run_cycle(intake, raw_of_folders(spark, folders, files_per_batch=1), f"{tmp_path}/ck").awaitTermination()

    land(tmp_path / "w", "b", [(1, workable("w1", "w2")), (2, "no json")])
    land(tmp_path / "r", "a", [(1, feed("f1"))])
    run()
    # Listed before the first file, arrived after it.
    land(tmp_path / "w", "a", [(3, workable("w3", "w1"))])
    (tmp_path / "r" / "z.json").write_text("no line of json\n")
    run()
    run()
    rows = raw_of_folders(spark, folders, stream=False)
    every = {(r.seq, r.source, r.external_id) for r in rows.collect()}
    assert len(every) == 5 and len({s for s, *_ in every}) == 5
    got = {(r.seq, r.source, r.external_id) for r in tables.raw(spark).collect()}
    again = max(s for s, _, i in every if i == "w1")
    assert got == {e for e in every if e[0] != again}


def test_folders_without_files_and_unknown_sources(spark, tmp_path):
    (tmp_path / "w").mkdir()
    assert raw_of_folders(spark, {"workable": str(tmp_path / "w")}, stream=False).count() == 0
    with pytest.raises(ValueError):
        raw_of_folders(spark, {"elsewhere": str(tmp_path / "w")})


def test_methods_of_a_stream_are_small_enough_to_be_compiled(spark, tmp_path):
    """The JVM never compiles a method of more than 8,000 bytes; the board's projection was one of them."""
    land(tmp_path / "workable", "a", [(0, workable("a", "b"))])
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(limit)
    rows = raw_of_folders(spark, {"workable": str(tmp_path / "workable")}, stream=False)
    assert int(spark.conf.get(limit)) == 8000
    assert sorted(r.external_id for r in rows.collect()) == ["a", "b"]
    spark.conf.set(limit, 4000)
    raw_of_folders(spark, {"workable": str(tmp_path / "workable")}, stream=False)
    assert int(spark.conf.get(limit)) == 4000
    spark.conf.unset(limit)
