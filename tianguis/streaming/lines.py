"""Rows that arrive as a stream, written as dated lines: the files that a batch would leave."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import readers
from ..sources.sinks import DAY_FOLDERS, LINE_KEYS, as_lines, other_lines, put_days


def stream_lines(source: DataFrame, root: str, checkpoint: str, folders: tuple[str, ...] = LINE_KEYS) -> StreamingQuery:
    """Writes a stream of raw rows as lines below ``root`` and ends when all that is there has been read.

    A run is what one ``checkpoint`` has seen.  The first batch of a run that touches a partition (day, market, mode)
    replaces it; later batches of the run add to it, each in a folder of its own (``lote=``).  So a rerun with
    a new checkpoint replaces the days instead of doubling them, and no partition is held in memory or written twice.
    A batch that is repeated after a failure leaves the same lines: which partitions earlier
    batches touched is written down by batch, and a batch's files only ever replace its own.

    With ``folders`` DAY_FOLDERS a day's partitions share its files, and a batch writes its days anew.  What it keeps of them
    is written down before (``days`` below ``checkpoint``), so that a repeated batch starts from the same lines.
    """
    touched = f"{checkpoint}/touched"

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        rows = as_lines(rows).persist()
        try:
            mine = rows.select(*LINE_KEYS).distinct()
            try:
                before = spark.read.schema(mine.schema).parquet(*[f"{touched}/batch={n}" for n in range(number)]) if number else mine.limit(0)
            except AnalysisException as e:
                raise RuntimeError("the checkpoint lacks the partitions of an earlier batch") from e
            # written down before any line, so that the batch, once repeated, splits its partitions in the same way
            mine.write.mode("overwrite").parquet(f"{touched}/batch={number}")
            if folders == DAY_FOLDERS:
                kept = f"{checkpoint}/days/batch={number}"
                if readers.whole(spark, kept) is None:
                    gone = mine.join(before.distinct().select(*[F.col(c).alias(f"__{c}") for c in LINE_KEYS]), [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in LINE_KEYS], "left_anti")
                    other_lines(root, mine, gone).write.mode("overwrite").parquet(kept)
                put_days(rows.select("value", "fecha").unionByName(spark.read.schema("value string, fecha date").parquet(kept)), root)
                return
            again = before.distinct().withColumn("again", F.lit(True))
            marked = rows.join(again, list(LINE_KEYS), "left")
            _put(marked.where("again is null").drop("again"), root, LINE_KEYS)
            _put(marked.where("again").drop("again").withColumn("lote", F.lit(number)), root, (*LINE_KEYS, "lote"))
        finally:
            rows.unpersist()

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", f"{checkpoint}/progress").trigger(availableNow=True).start()


def _put(lines: DataFrame, root: str, keys: tuple[str, ...]) -> None:
    out = lines.repartition(*keys).sortWithinPartitions(*keys).write.partitionBy(*keys)
    out.mode("overwrite").option("partitionOverwriteMode", "dynamic").text(root)
