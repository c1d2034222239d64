"""Filters over stored ids: equal to the plain anti join, new ids read no stored ids, repeated runs and unfinished levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from postweave.operators import dedup as U
from postweave.operators import membership as B
from postweave.operators import tables as T
from tests.test_jobs import raw_rows


def store(spark, tmp_path, runs):
    tables = T.JobTables(f"{tmp_path}/store")
    for run, ids in runs.items():
        tables.save_raw(raw_rows(spark, [(i, "manual", x, f"Title: {x}", None) for i, x in enumerate(ids)]), run)
    return tables


def batch(spark, ids):
    return raw_rows(spark, [(i, "manual", x, "Title: b", None) for i, x in enumerate(ids)])


def kept(rows):
    return sorted(r.seq for r in rows.select("seq").collect())


ASKED = ["a1", "n1", None, "", "b2", "n1", "a1", "c3", "é"]


def test_equal_to_the_plain_join_at_every_state(spark, tmp_path):
    tables = store(spark, tmp_path, {"r1": ["a1", "a2", None, "", "é"], "r2": ["b1", "b2"]})
    rows = batch(spark, ASKED)

    def same(besides=None, which="true"):
        plain = tables.raw_rows(spark).where(which)
        assert kept(tables.known.drop_known(rows, besides)) == kept(U.drop_known(rows, plain))

    same()
    assert tables.known.absorb(spark) == 1 and tables.known.absorb(spark) == 1
    same()
    same("r1", "run_id <> 'r1'")
    same("r*", "false")
    # A run that no level holds, and then a repeated one that lost ids.
    tables.save_raw(batch(spark, ["c3"]), "r3")
    same()
    same("r3", "run_id <> 'r3'")
    same("r*", "false")
    tables.known.absorb(spark)
    same()
    tables.save_raw(batch(spark, ["n1"]), "r1")
    same()
    assert tables.known.absorb(spark) == 3
    same()
    # A level whose manifest was not finished is not seen.
    spark.createDataFrame([("level", "level-lost", None, 1, 1)], B._MANIFEST).write.parquet(f"{tmp_path}/store/known_ids/manifest/version=000000000004x")
    (tmp_path / "store/known_ids/manifest/version=000000000004x/_SUCCESS").unlink()
    same()


def test_new_ids_read_no_stored_ids(spark, tmp_path):
    tables = store(spark, tmp_path, {"r1": [f"id{i}" for i in range(3_000)]})
    tables.known.absorb(spark)
    new = tables.known.stored(spark, batch(spark, ["zz1", "zz2"]))
    old = tables.known.stored(spark, batch(spark, ["id7", "zz1"]))
    assert new.inputFiles() == [] and [r[0] for r in old.collect()] == ["id7"]
    # One part of the hash is read for one id.
    assert len({f.rsplit("/", 2)[1] for f in old.inputFiles() if "/ids/" in f}) == 1


def test_no_id_is_missed_and_few_are_let_through(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("external_id"))
    blocks = -(-20_000 // B.IDS_PER_BLOCK)
    bloom = B.bloom_filter(ids, blocks)
    assert bloom.count() == blocks
    assert B.may_hold(ids, bloom, blocks).count() == 20_000
    others = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("external_id"))
    assert B.may_hold(others, bloom, blocks).count() < 200


def test_empty_tables(spark, tmp_path):
    tables = T.JobTables(f"{tmp_path}/none")
    assert tables.known.absorb(spark) == 0 and kept(tables.known.drop_known(batch(spark, ["a", None]))) == [0, 1]
    tables.save_raw(batch(spark, [None, ""]), "r1")
    assert tables.known.absorb(spark) == 1 and kept(tables.known.drop_known(batch(spark, ["a", None]))) == [0, 1]
