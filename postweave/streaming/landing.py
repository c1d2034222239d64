"""Landed payloads as a stream of raw rows.

Spark's file source does the bookkeeping: a folder's new files are the next micro-batch, and the checkpoint's log says which files a
batch holds, so a restarted stream repeats the same batch and goes on behind it. Arrival numbers come from the pages themselves and the
source, never from the order in which files are listed, so they are the same in a stream, after a restart and in a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from postweave import schemas as S
from postweave.operators.dedup import union_sources
from postweave.sources import landed as L

READERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "jsearch_api": L.raw_from_jsearch, "adzuna_api": L.raw_from_adzuna, "workable": L.raw_from_workable, "indeed_rss": L.raw_from_rss,
}


def raw_of_folders(
    spark: SparkSession, landed: Mapping[str, str], stream: bool = True, files_per_batch: int | None = None,
    readers: Mapping[str, Callable[[DataFrame], DataFrame]] = READERS, **options: str,
) -> DataFrame:
    """Raw rows of the payload folders (source to folder of JSON lines with the columns of `schemas.PAGE`), as a stream or at once.

    page_seq counts the pages of one source; sources take turns in the numbers of all, in the fixed order of `schemas.SOURCES`, so
    seq is unique over them. A folder must exist and may be empty. files_per_batch bounds the files that a micro-batch takes of a
    source. Payloads that cannot be read give no rows (`landed.unreadable_pages`); lines that are no JSON give none either.
    Further options go to the file source, such as cleanSource and sourceArchiveDir.
    """
    def one(source: str, folder: str) -> DataFrame:
        if source not in readers:
            raise ValueError(f"no reader for {source}")
        reader = (spark.readStream if stream else spark.read).schema(S.PAGE).options(**options)
        if stream and files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        pages = reader.json(folder).filter("page_seq IS NOT NULL")
        turn = F.col("page_seq") * len(S.SOURCES) + S.SOURCES.index(source)
        return readers[source](pages.withColumn("page_seq", turn))

    return union_sources(*(one(s, f) for s, f in landed.items()))
