"""The streaming forms: files that arrive are upserted into daily partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import DAY, KEY, newest, upsert


def stream_upsert(source: DataFrame, target: str, checkpoint: str, key: str = KEY, day: str = DAY, moment: str = "extraido_en") -> StreamingQuery:
    """Upserts a stream of rows into ``target`` and ends when all that is there has been read.

    Within a micro-batch the latest row of a key counts; between batches the later batch.
    Nothing is late: no watermark drops revisions.  A batch that is run again after a failure
    leaves the same table.
    """

    def batch(rows: DataFrame, _: int) -> None:
        upsert(newest(rows, key, moment), target, key, day, cluster=(key,))

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def files(spark: SparkSession, path: str, schema, per_batch: int = 1000) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def day_totals(rows: DataFrame, moment: str, delay: str = "2 days") -> DataFrame:
    """Rows a day of a stream, with a watermark that bounds the state."""
    return rows.withWatermark(moment, delay).groupBy(F.window(moment, "1 day")).agg(F.count(F.lit(1)).alias("n_rows"))
