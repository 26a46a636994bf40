"""Idempotent upsert of raw rows into a table of daily partitions."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, DAY = "llave_fila", "fecha"
#: Columns that a day's rows lie together by.
CLUSTER = ("producto_raw", "destino_id", "tipo_precio")
#: Rows that the ranges of clustering columns are read from, at most (about), and ranges of a column (a power of two).
CLUSTER_SAMPLE, CLUSTER_RANGES = 10_000, 16


def merged(target: DataFrame, stage: DataFrame, key: str = KEY, day: str = DAY) -> DataFrame:
    """What the touched days hold after the upsert: staged rows, and target rows of those days that no staged row replaces.

    The target is pruned to the stage's range of days by literals (partitions that lie
    outside are not listed) and then to its very days.  Keys match within a day.
    """
    low, high = stage.agg(F.min(day), F.max(day)).first()
    if low is None:
        return stage.limit(0)
    pruned = target.where(F.col(day).between(F.lit(low), F.lit(high)))
    touched = stage.select(day).distinct()
    kept = pruned.join(touched, day, "left_semi").join(stage.select(key, day), [key, day], "left_anti")
    return stage.unionByName(kept.select(*stage.columns))


def upserted(target: DataFrame, stage: DataFrame, key: str = KEY, day: str = DAY) -> DataFrame:
    """The whole table after the upsert."""
    untouched = target.join(stage.select(day).distinct(), day, "left_anti")
    return merged(target, stage, key, day).unionByName(untouched.select(*stage.columns))


def ranges_of(bounds: list[tuple[str, list]]) -> dict[str, Column]:
    """The range of each column's value, from 0 on, under the names that ``interleaved`` reads.

    ``bounds`` gives for each column the least values of its ranges but the first, ascending; nulls lie in the first range.
    """

    def of(column: str, least: list) -> Column:
        return F.size(F.filter(F.lit(least), lambda x: x <= F.col(column)))

    return {f"__range_{c}": of(c, least) for c, least in bounds if least}


def interleaved(bounds: list[tuple[str, list]]) -> Column:
    """One number whose order keeps rows together by all columns: the bits of their ranges in turn, highest first.

    A column with few ranges has few bits, which count as its highest ones.
    """
    bits_of = [(F.col(f"__range_{c}"), len(least).bit_length()) for c, least in bounds if least]
    number = F.lit(0).cast("long")
    for level in range(max((bits for _, bits in bits_of), default=0)):
        for of, bits in bits_of:
            if level < bits:
                number = F.shiftleft(number, 1).bitwiseOR(F.shiftright(of, bits - 1 - level).bitwiseAND(F.lit(1)).cast("long"))
    return number


def cluster_bounds(stage: DataFrame, columns: list[str], n_rows: int) -> list[tuple[str, list]]:
    """Ranges of the columns for ``interleaved``, from a sample of bounded size: they shape the order of rows alone, never the rows."""
    some = stage.select(*columns).sample(min(1.0, CLUSTER_SAMPLE / max(n_rows, 1)), 1).collect() if columns else []
    out = []
    for c in columns:
        values = sorted(r[c] for r in some if r[c] is not None)
        known = sorted(set(values))
        if len(known) > CLUSTER_RANGES:
            known = sorted({values[len(values) * i // CLUSTER_RANGES] for i in range(CLUSTER_RANGES)})
        out.append((c, known[1:]))
    return out


def repeated(stage: DataFrame, key: str = KEY, day: str = DAY) -> tuple[int, bool]:
    """Rows of a stage, and whether one of its keys is there twice in a day.

    Hashes of the keys are shuffled in their place, as keys are most of a row; keys are compared only where
    hashes of a day are equal.
    """
    digest = F.xxhash64(key).alias("__hash")
    same = stage.groupBy(day, digest).agg(F.count(F.lit(1)).alias("n"))
    seen = same.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    if (seen["most"] or 0) < 2:
        return seen["n"] or 0, False
    doubtful = same.where("n > 1").select(F.col(day).alias("__day"), "__hash")
    met = stage.select(key, day, digest).withColumnRenamed("__hash", "__own").join(doubtful, F.col(day).eqNullSafe(F.col("__day")) & (F.col("__own") == F.col("__hash")), "left_semi")
    return seen["n"], not met.groupBy(key, day).count().where("count > 1").isEmpty()


def upsert(stage: DataFrame, path: str, key: str = KEY, day: str = DAY, cluster: tuple[str, ...] = CLUSTER, stored: bool = False) -> int:
    """Replaces the touched days under ``path``; other days stay.  One writer at a time.  Returns the rows staged.

    A stage with a key twice in a day is refused.  The stage is computed once and kept while
    it is used; one that is ``stored`` (read from a table, filtered at most) is read again instead, so that there is no other copy of it.
    Within a day rows lie in the interleaved order of the cluster columns, so that row groups can be
    skipped by each of them; a day that is too large for one task is split over several (adaptive rebalancing).
    """
    spark = stage.sparkSession
    stage = stage if stored else stage.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_rows, twice = repeated(stage, key, day)
        if twice:
            raise ValueError("a key is staged twice")
        try:
            rows = merged(spark.read.schema(stage.schema).parquet(path), stage, key, day)
        except AnalysisException as e:  # no table yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = stage
        sort = [c for c in cluster if c in stage.columns]
        bounds = cluster_bounds(stage, sort, n_rows)
        places = ranges_of(bounds)  # columns of their own: each is found once a row
        out = rows.hint("rebalance", F.col(day)).withColumns(places).sortWithinPartitions(day, interleaved(bounds), *sort).drop(*places)
        out.write.partitionBy(day).mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(path)
        return n_rows
    finally:
        if not stored:
            stage.unpersist()


def newest(stage: DataFrame, key: str = KEY, moment: str = "extraido_en") -> DataFrame:
    """One row a key, the latest by ``moment`` (a stream's micro-batch may hold revisions of one row).

    Of rows with equal moments the greatest by their columns counts, in the columns' order: the same
    rows give the same result, however they are dealt out.
    """
    rest = [F.desc_nulls_last(c) for c, t in stage.dtypes if c not in (key, moment) and not t.startswith("map")]
    latest = Window.partitionBy(key).orderBy(F.desc_nulls_last(moment), *rest)
    return stage.withColumn("__n", F.row_number().over(latest)).where("__n = 1").drop("__n")
