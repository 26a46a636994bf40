"""Captured pages that arrive as files: every micro-batch gives rows and rejections."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.capture import judge_pages, raw_rows, rejections


def page_files(spark: SparkSession, path: str, glob: str = "*.html", per_batch: int = 1000) -> DataFrame:
    """A folder of archived pages as a stream of files, for ``readers.archived_pages``."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_batch).load(path)


def stream_captures(pages: DataFrame, out: str, checkpoint: str, destinations: DataFrame | None = None) -> StreamingQuery:
    """Judges a stream of pages (layout ``schemas.PAGES``) and ends when all that is there has been read.

    Each page is judged once.  Rows go to ``out``/rows, reasons to ``out``/rejections, each batch in a folder of its
    own (``batch=``) that only the same batch replaces: one that is repeated after a failure leaves the same tables.
    """

    def batch(arrived: DataFrame, number: int) -> None:
        judged = judge_pages(arrived).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, made in (("rows", raw_rows(judged, destinations)), ("rejections", rejections(judged))):
                made.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/{name}/batch={number}")
        finally:
            judged.unpersist()

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
