"""What several operators of this folder share: scratch space, cut lineage, free names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    ``spark.checkpoint.dir`` names it on a cluster.  Only where that is unset (tests on
    one machine) a temporary folder takes its place.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage ended by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back (compressed, columns prunable)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(column) -> F.Column:
    """Null texts count as empty ones."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once for each Spark application.

    Also bounds the batches that they get at once: texts may be long, and a batch of ten
    thousand rows with what is made of it should not fill a worker's memory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    import io
    import os
    import zipfile
    from pathlib import Path

    sc, top = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_shipped_package", False) or os.environ.get("PYTHONPATH", "").find(str(top.parent)) >= 0:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{top.name}.zip"
    target.write_bytes(data.getvalue())
    sc.addPyFile(str(target))
    sc._shipped_package = True
