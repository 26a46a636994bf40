"""Line items as parsed price rows, with faults at fixed places: an order is a page, its lines are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(cents):
    return F.concat((F.floor(cents / 100)).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def _grouped(cents):
    whole = F.floor(cents / 100)
    return F.concat((F.floor(whole / 1000)).cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def parsed(spark: SparkSession, sf_dir: str, by_page: bool = False) -> DataFrame:
    """Rows in the layout of parsed pages, all criteria strings.

    ``by_page`` deals them by page before they become texts, so that what groups them by page need not shuffle the texts.
    """
    li, part, supplier, nation = (table(spark, sf_dir, n) for n in ("lineitem", "part", "supplier", "nation"))
    # some lines twice, at another place of their page: repeated natural keys
    twice = F.when((F.col("l_linenumber") == 2) & (F.col("l_quantity") > 48), F.array(F.lit(0), F.lit(100))).otherwise(F.array(F.lit(0)))
    # what joins shuffle of a line: whole cents and flags instead of doubles
    li = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", F.explode(twice).alias("copy"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        F.round(F.col("l_tax") * 10000).cast("long").alias("tax"), (F.col("l_discount") > 0.085).alias("less"), (F.col("l_quantity") > 48).alias("many"), (F.col("l_returnflag") == "R").alias("kilo"),
    )
    rows = li.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    if by_page:
        rows = rows.repartition(F.col("l_orderkey"))
    cents, n = F.col("cents"), F.col("l_linenumber")
    return rows.select(
        F.col("l_orderkey").alias("page_id"),
        (n + F.col("copy")).alias("row_pos"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("date"),
        F.col("p_name").alias("product"),
        F.col("p_type").alias("quality"),
        F.when((n == 3) & F.col("many"), F.lit("")).otherwise(F.col("p_brand")).alias("presentation"),
        F.col("n_name").alias("origin"),
        F.col("s_name").alias("destination"),
        F.lit("-1").alias("product_id"),
        F.lit("-1").alias("origin_id"),
        F.col("l_suppkey").cast("string").alias("destination_id"),
        F.when(F.col("kilo"), "2").otherwise("1").alias("prices_per_id"),
        F.when(n == 7, "N/D").when(n == 6, "0.00").when(n == 4, _grouped(cents)).when(n != 5, _money(cents)).alias("price_min"),
        _money(cents + F.col("tax")).alias("price_max"),
        _money(F.when(F.col("less"), cents - 100).otherwise(cents)).alias("price_frequent"),
        F.lit(None).cast("string").alias("obs"),
        F.col("p_brand").alias("category"),
        F.concat(F.lit("page/"), F.col("l_orderkey").cast("string")).alias("source_url"),
        F.col("l_shipdate").cast("timestamp").alias("fetched_at"),
    )


#: The same rows for DuckDB.
SQL = """
parsed AS (
  SELECT l_orderkey AS page_id, l_linenumber + copy AS row_pos, strftime(l_shipdate, '%d/%m/%Y') AS "date", p_name AS product, p_type AS quality,
    CASE WHEN l_linenumber = 3 AND l_quantity > 48 THEN '' ELSE p_brand END AS presentation, n_name AS origin, s_name AS destination,
    '-1' AS product_id, '-1' AS origin_id, CAST(l_suppkey AS VARCHAR) AS destination_id,
    CASE WHEN l_returnflag = 'R' THEN '2' ELSE '1' END AS prices_per_id,
    CASE l_linenumber WHEN 7 THEN 'N/D' WHEN 6 THEN '0.00' WHEN 5 THEN NULL
      WHEN 4 THEN CAST(cents // 100000 AS VARCHAR) || ',' || lpad(CAST((cents // 100) % 1000 AS VARCHAR), 3, '0') || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
      ELSE CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS price_min,
    CAST((cents + tax) // 100 AS VARCHAR) || '.' || lpad(CAST((cents + tax) % 100 AS VARCHAR), 2, '0') AS price_max,
    CAST((cents - less) // 100 AS VARCHAR) || '.' || lpad(CAST((cents - less) % 100 AS VARCHAR), 2, '0') AS price_frequent,
    p_brand AS category, l_shipdate AS fetched_at
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(round(l_tax * 10000) AS BIGINT) AS tax, CASE WHEN l_discount > 0.085 THEN 100 ELSE 0 END AS less FROM lineitem JOIN (VALUES (0), (100)) AS c(copy) ON copy = 0 OR l_linenumber = 2 AND l_quantity > 48)
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
keyed AS (
  SELECT *, product || ' - ' || quality AS product_key,
    concat_ws('|', "date", product || ' - ' || quality, presentation, origin, destination, prices_per_id) AS natural_key
  FROM parsed
),
verdicts AS (
  SELECT page_id, CASE WHEN bool_or(presentation = '') THEN 'MissingFields: presentation' WHEN max(same) > 1 THEN 'DuplicateKey' END AS reason, count(*) AS n_rows
  FROM (SELECT *, count(*) OVER (PARTITION BY page_id, natural_key) AS same FROM keyed) GROUP BY page_id
),
typed AS (
  SELECT k.*, CAST(strptime("date", '%d/%m/%Y') AS DATE) AS fecha,
    TRY_CAST(replace(price_min, ',', '') AS DECIMAL(38,9)) AS low, TRY_CAST(replace(price_max, ',', '') AS DECIMAL(38,9)) AS high, TRY_CAST(replace(price_frequent, ',', '') AS DECIMAL(38,9)) AS freq,
    sha256(natural_key) AS llave_fila
  FROM keyed k JOIN verdicts v ON v.page_id = k.page_id WHERE v.reason IS NULL
)
"""
