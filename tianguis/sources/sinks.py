"""Sinks: dated lines, the raw table, sorted CSV, appended counts and alerts, failures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.coverage import remaining
from ..operators.upsert import CLUSTER, upsert
from ..plans.requests import failure_line
from ..schemas import RAW_SCHEMA, REQUIRED
from . import readers


#: Folders of raw lines.
LINE_KEYS = ("fecha", "destino", "precio")
#: Folders of days alone, for markets with a few rows a day: a folder for each market would be a file for nearly every row.
DAY_FOLDERS = ("fecha",)


def as_lines(raw: DataFrame) -> DataFrame:
    """One JSON object a row (``value``), all fields, and the folders that it belongs to."""
    line = F.to_json(F.struct(*[f.name for f in RAW_SCHEMA]), {"ignoreNullFields": "false"})
    return raw.select(line.alias("value"), "fecha", F.coalesce(F.col("destino_id").cast("string"), F.lit("todos")).alias("destino"), F.col("tipo_precio").alias("precio"))


def write_lines(raw: DataFrame, root: str, folders: tuple[str, ...] = LINE_KEYS) -> None:
    """One JSON object a line under fecha=/destino=/precio=, gzipped; only touched partitions (day, market, mode) are replaced.

    Rows are shuffled as they are, which takes less room than their lines, and become lines behind the shuffle.
    A task that would get too much is split by adaptive rebalancing.  With ``folders`` DAY_FOLDERS a day's partitions share
    its files; still only the touched ones are replaced, as the day's other lines are written again.
    """
    if folders == DAY_FOLDERS and readers.is_there(raw.sparkSession, root):
        lines = as_lines(raw)
        put_days(lines.select("value", "fecha").unionByName(other_lines(root, lines.select(*LINE_KEYS).distinct())), root)
        return
    if folders == DAY_FOLDERS:
        # nothing to keep: rows are computed once, and sorted before they become lines
        lines = as_lines(raw.hint("rebalance", F.col("fecha")).sortWithinPartitions("fecha")).select("value", "fecha")
    else:
        lines = as_lines(raw.hint("rebalance", F.col("fecha"), F.col("destino_id"), F.col("tipo_precio"))).sortWithinPartitions(*LINE_KEYS)
    lines.write.partitionBy(*folders).option("compression", "gzip").mode("overwrite").option("partitionOverwriteMode", "dynamic").text(root)


def other_lines(root: str, partitions: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """Lines (value, fecha) of DAY_FOLDERS below ``root``, of the days of ``partitions`` (LINE_KEYS), but not of the partitions ``replaced`` (all of them unless named)."""
    spark, replaced = partitions.sparkSession, partitions if replaced is None else replaced
    schema = "value string, fecha date"
    held = readers._or_empty(spark, lambda: spark.read.schema(schema).option("pathGlobFilter", readers.LINES).text(root), schema)
    # a year has 366 days: the folders to be read are named
    held = held.where(F.col("fecha").isin([r["fecha"] for r in partitions.select("fecha").distinct().collect()]))
    own = F.from_json("value", "destino_id long, tipo_precio string")
    lines = held.withColumn("__own", own).select("value", "fecha", F.coalesce(F.col("__own.destino_id").cast("string"), F.lit("todos")).alias("destino"), F.col("__own.tipo_precio").alias("precio"))
    gone = replaced.select(*[F.col(c).alias(f"__{c}") for c in LINE_KEYS])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in LINE_KEYS]
    return lines.join(gone, same, "left_anti").select("value", "fecha")


def put_days(lines: DataFrame, root: str) -> None:
    """Lines (value, fecha) as the whole content of their days' folders; other days stay."""
    out = lines.hint("rebalance", F.col("fecha")).sortWithinPartitions("fecha").write.partitionBy("fecha").option("compression", "gzip")
    out.mode("overwrite").option("partitionOverwriteMode", "dynamic").text(root)


def read_lines(spark: SparkSession, root: str) -> DataFrame:
    """What ``write_lines`` wrote, as raw rows."""
    return readers.raw_lines(spark, root)


def load_report(stage: DataFrame, files: DataFrame) -> DataFrame:
    """One row on a stage before it is loaded: files, staged rows and days."""
    days = stage.agg(F.count(F.lit(1)).alias("staged_rows"), F.array_sort(F.collect_set("fecha")).alias("dates"))
    return files.agg(F.sum("n_files").alias("files")).crossJoin(days)  # one row each


def create_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """The raw table: Parquet, partitioned by day, with its fields' constraints as comments; a property names what ``upsert`` clusters a day by."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()} COMMENT '{'required' if f.name in REQUIRED else 'optional'}'" for f in RAW_SCHEMA)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (fecha){place} TBLPROPERTIES ('clustered_by' = '{",".join(CLUSTER)}')")


def write_catalog(rows: DataFrame, path: str, id_col: str) -> None:
    """A small dimension as one CSV file in order of its numeric ids, arrays joined by blanks."""
    flat = rows.select(*[F.array_join(c, " ").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes])
    flat.orderBy(F.col(id_col).cast("long")).coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')


def resume_counts(grid: DataFrame, path: str, count: Callable[[DataFrame], DataFrame], slices: int = 1) -> int:
    """Counts the cells of ``grid`` (destination_id, year) that the table at ``path`` lacks and appends them.

    ``count`` gives rows (destination_id, year, rows) of the cells it is handed.  The cells are dealt into ``slices``
    by hash, the same ones in every run, and each slice is appended before the next one is counted: a failure loses
    its own slice alone, and the next call goes on with what is missing.  Returns how many cells were missing.
    """
    if slices < 1:
        raise ValueError("at least one slice")
    spark, total = grid.sparkSession, 0
    of = F.pmod(F.xxhash64(F.col("destination_id").cast("string"), F.col("year").cast("int")), F.lit(slices))
    for k in range(slices):
        rest = remaining(grid.where(of == k), readers.stored_counts(spark, path))
        n = rest.count()
        if n:
            append(count(rest).select("destination_id", "year", "rows"), path)
        total += n
    return total


def append(rows: DataFrame, path: str) -> None:
    """Appends counts or alerts to their table."""
    rows.write.mode("append").parquet(path)


def write_failures(rejections: DataFrame, path: str) -> None:
    """This run's failures only, as the lines that ``readers.failures`` reads; no line if there are none.

    ``rejections`` has destination_id, prices_per_id, window_start, window_end, reason and message.
    """
    line = failure_line(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("destination_id", "prices_per_id", "window_start", "window_end", "reason", "message")])
    rejections.select(line.alias("value")).write.mode("overwrite").text(path)


def load(spark: SparkSession, root: str, table: str, staging: str | None = None) -> DataFrame:
    """Upserts all raw lines below ``root`` into the table at ``table``: one row with files, staged_rows, affected_rows, table and dates.

    A file outside any day's folder, an empty input and a null in a required field are errors.  Lines are parsed
    once: rows, and nulls of required fields, are observed while they are staged as Parquet (at ``staging``, beside
    the table unless named), and the upsert reads that, without another copy.  A refused stage stays there to be looked at; the next load replaces it.
    """
    days = readers.checked_days(spark, root)
    # a year has 366 days: the report's list is as long as the days that were touched
    files = days.agg(F.sum("n_files").alias("files"), F.array_sort(F.collect_set("day")).alias("dates")).first()
    if not files["files"]:
        raise ValueError(f"no raw lines below {root}")
    seen, staging = Observation(), staging or f"{table.rstrip('/')}.stage"
    # Parquet keeps no "not null": required fields are checked before they reach the table
    stage = readers.raw_lines(spark, root).observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED])
    stage.write.mode("overwrite").option("compression", "zstd").parquet(staging)
    nulls = [f"null {c}" for c in REQUIRED if seen.get[c]]
    if nulls:
        raise ValueError(f"required fields without a value: {', '.join(sorted(nulls))}")
    staged = upsert(spark.read.schema(RAW_SCHEMA).parquet(staging), table, stored=True)
    return spark.createDataFrame([(files["files"], seen.get["rows"], staged, table, files["dates"])], "files long, staged_rows long, affected_rows long, table string, dates array<date>")
