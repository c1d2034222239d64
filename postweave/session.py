"""Session settings for local runs, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; on a cluster the submitted settings are used instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postweave")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; a temporary one only in local mode without that setting."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    made = tempfile.mkdtemp(prefix="postweave-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def spread(scan: DataFrame, key: str) -> DataFrame:
    """The rows of a plain scan over all cores, by a unique key, for costly work per row.

    A file is read by row group: a table of few groups keeps few tasks busy, and a split without a group has no rows. A scan of at
    least four splits a core is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(2 * cores, key) if scan.rdd.getNumPartitions() < 4 * cores else scan


# Bytes of a method beyond which the JVM leaves it interpreted, for as long as it runs.
COMPILED = 8_000


def small_methods(df: DataFrame) -> DataFrame:
    """df, after lowering the session's limit for the methods of generated code to the JVM's where it is larger.

    A projection of many columns can become one method of more bytes than that; with the limit Spark takes its projections in parts,
    which are compiled. It is read when a plan runs, so it stays lowered.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.codegen.hugeMethodLimit")) > COMPILED:
        conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED)
    return df


def pin(df: DataFrame) -> DataFrame:
    """Computes df once into reliable storage, so that every later use sees the same rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
