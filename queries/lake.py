"""Snapshot lake: orders as monthly snapshots within years."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import query, table
from snapledger.operators import coverage
from snapledger.session import scratch_path
from snapledger.sinks.parquet import pack_snapshots, write_snapshot
from snapledger.sources import snapshots
from snapledger.sources.union_by_name import read_union_by_name

FIRST, LAST = 1977, 2026
COLUMNS = "o_orderkey bigint, cents bigint"


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.withColumns(
        {
            "cents": F.round(F.col("o_totalprice") * 100).cast("bigint"),
            "release_year": F.year("o_orderdate"),
            "scraped_date": F.trunc("o_orderdate", "month"),
        }
    )


ORDERS_SQL = """
    SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
           CAST(year(o_orderdate) AS INTEGER) AS release_year,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS month
    FROM orders
"""


def orders_lake(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "orders")
    rows = dated_orders(spark, sf_dir)
    write_snapshot(
        rows.select("o_orderkey", "cents", "release_year", "scraped_date"), base, "release_year"
    )
    return base


def read_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.read_snapshots(
        spark, orders_lake(spark, sf_dir), "release_year", columns=COLUMNS
    )


def with_text_date(df: DataFrame) -> DataFrame:
    return df.withColumn("scraped_date", F.col("scraped_date").cast("string"))


@query(
    f"SELECT o_orderkey, cents, release_year, CAST(month AS VARCHAR) AS scraped_date FROM ({ORDERS_SQL})"
)
def snapshot_scan(spark, sf_dir):
    return with_text_date(read_orders(spark, sf_dir))


@query(
    """
    SELECT c_custkey, c_name, 'gr' || c_nationkey AS release_group_id, '2024-05-01' AS scraped_date
    FROM customer
    """
)
def snapshot_scan_by_id(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.concat(F.lit("gr"), "c_nationkey").alias("release_group_id"),
        F.lit("2024-05-01").cast("date").alias("scraped_date"),
    )
    base = scratch_path(spark, "groups")
    write_snapshot(rows, base, "release_group_id")
    return with_text_date(
        snapshots.read_snapshots(
            spark, base, "release_group_id", "string", "c_custkey bigint, c_name string"
        )
    )


@query(
    """
    SELECT c_custkey, 'gr' || c_nationkey AS release_group_id, c_acctbal < 0 AS again,
           CASE WHEN c_acctbal < 0 THEN '2024-05-02' ELSE '2024-05-01' END AS scraped_date
    FROM customer
    """
)
def packed_scan_by_id(spark, sf_dir):
    """Two days of customers by nation, packed; then the second day is written once more."""
    again = F.col("c_acctbal") < 0
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        again.alias("again"),
        F.concat(F.lit("gr"), "c_nationkey").alias("release_group_id"),
        F.when(again, "2024-05-02").otherwise("2024-05-01").cast("date").alias("scraped_date"),
    )
    base = scratch_path(spark, "packed-groups")
    write_snapshot(rows, base, "release_group_id")
    pack_snapshots(spark, base, "release_group_id", "string", "2024-05-03")
    write_snapshot(rows.where("again"), base, "release_group_id")
    return with_text_date(
        snapshots.read_snapshots(
            spark, base, "release_group_id", "string", "c_custkey bigint, again boolean"
        )
    )


@query(
    f"""
    SELECT o_orderkey, CAST(release_year AS VARCHAR) AS release_year,
           CAST(month AS VARCHAR) AS scraped_date, true AS agrees
    FROM ({ORDERS_SQL})
    """
)
def path_tokens(spark, sf_dir):
    rows = snapshots.with_source_file(read_orders(spark, sf_dir))
    rows = snapshots.with_path_values(rows, "release_year")
    year, date = F.col("release_year_from_path"), F.col("scraped_date_from_path").cast("date")
    agrees = (year.cast("int") == F.col("release_year")) & (date == F.col("scraped_date"))
    return rows.select(
        "o_orderkey",
        year.alias("release_year"),
        date.cast("string").alias("scraped_date"),
        agrees.alias("agrees"),
    )


@query(
    """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority,
           CASE WHEN o_orderstatus <> 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS cents
    FROM orders
    """
)
def union_by_name(spark, sf_dir):
    orders = dated_orders(spark, sf_dir)
    status, base = F.col("o_orderstatus"), scratch_path(spark, "mixed")
    number, word = F.col("o_custkey"), F.col("o_custkey").cast("string")
    priority = F.col("o_orderpriority").alias("priority")
    parts = {
        1: orders.where(status == "F").select("o_orderkey", number.alias("customer"), priority),
        2: orders.where(status == "O").select("o_orderkey", word.alias("customer"), "cents"),
        3: orders.where(~status.isin("F", "O") | status.isNull()).select(
            "o_orderkey", number.alias("customer"), "cents"
        ),
    }
    for part, rows in parts.items():
        rows.write.parquet(f"{base}/release_year=2024/scraped_date=2024-01-0{part}")
    return read_union_by_name(spark, base).select("o_orderkey", "customer", "priority", "cents")


@query(
    f"""
    SELECT o_orderkey, cents, release_year, CAST(month AS VARCHAR) AS scraped_date
    FROM ({ORDERS_SQL}) QUALIFY month = max(month) OVER (PARTITION BY release_year)
    """
)
def latest_snapshot(spark, sf_dir):
    return with_text_date(
        snapshots.latest_snapshot(read_orders(spark, sf_dir), "release_year")
    )


@query(f"SELECT DISTINCT release_year FROM ({ORDERS_SQL})")
def snapshot_keys(spark, sf_dir):
    return snapshots.snapshot_keys(read_orders(spark, sf_dir), "release_year")


def shipped_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "shipped")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.year("l_shipdate").alias("release_year"),
        F.trunc("l_shipdate", "year").alias("scraped_date"),
    )
    write_snapshot(rows, base, "release_year")
    return snapshots.read_snapshots(spark, base, "release_year", columns="l_orderkey bigint")


COVERED_SQL = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS release_year FROM orders
    INTERSECT SELECT CAST(year(l_shipdate) AS INTEGER) FROM lineitem
"""

MISSING_SQL = f"""
    SELECT CAST(y AS INTEGER) AS release_year FROM range({FIRST}, {LAST + 1}) AS t(y)
    WHERE y NOT IN ({COVERED_SQL})
"""


@query(COVERED_SQL)
def covered_years(spark, sf_dir):
    both = [read_orders(spark, sf_dir), shipped_lake(spark, sf_dir)]
    return coverage.covered_years(both, "release_year", FIRST, LAST)


@query(MISSING_SQL)
def missing_years(spark, sf_dir):
    return coverage.missing_years(
        spark, covered_years(spark, sf_dir), "release_year", FIRST, LAST
    )


@query(f"SELECT max(release_year) AS release_year FROM ({MISSING_SQL})")
def next_missing_year(spark, sf_dir):
    return coverage.next_missing_year(missing_years(spark, sf_dir), "release_year")


@query(
    f"""
    SELECT o_orderkey, cents, release_year, CAST(month AS VARCHAR) AS scraped_date
    FROM ({ORDERS_SQL}) WHERE release_year BETWEEN 1996 AND 1998
    """
)
def year_range(spark, sf_dir):
    rows = read_orders(spark, sf_dir)
    return with_text_date(coverage.within_years(rows, "release_year", 1996, 1998))


@query(
    f"""
    SELECT o_orderkey, cents, release_year, CAST(month AS VARCHAR) AS scraped_date
    FROM ({ORDERS_SQL}) WHERE month(month) = 5
    """
)
def path_pattern(spark, sf_dir):
    base = orders_lake(spark, sf_dir)
    rows = snapshots.files_matching(spark, base, "release_year=*/scraped_date=*-05-01")
    return with_text_date(rows)


@query(
    """
    SELECT o_orderkey, CASE WHEN year(o_orderdate) > 1997 THEN o_orderpriority END AS priority
    FROM orders
    """
)
def concat_years(spark, sf_dir):
    orders, year = table(spark, sf_dir, "orders"), F.year("o_orderdate")
    early = orders.where((year <= 1997) | year.isNull()).select("o_orderkey")
    late = orders.where(year > 1997).select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    return early.unionByName(late, allowMissingColumns=True)


@query(
    f"""
    SELECT release_year, CAST(month AS VARCHAR) AS scraped_date,
           CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(cents) AS BIGINT) AS cents
    FROM ({ORDERS_SQL}) GROUP BY ALL
    """
)
def snapshot_write(spark, sf_dir):
    rows = with_text_date(read_orders(spark, sf_dir))
    return rows.groupBy("release_year", "scraped_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("cents").alias("cents")
    )


@query(
    f"""
    SELECT o_orderkey, CASE WHEN month = DATE '1996-05-01' THEN cents + 1 ELSE cents END AS cents,
           release_year, CAST(month AS VARCHAR) AS scraped_date
    FROM ({ORDERS_SQL})
    """
)
def snapshot_rewrite(spark, sf_dir):
    base = orders_lake(spark, sf_dir)
    again = (
        dated_orders(spark, sf_dir)
        .where(F.col("scraped_date") == F.lit("1996-05-01").cast("date"))
        .select("o_orderkey", (F.col("cents") + 1).alias("cents"), "release_year", "scraped_date")
    )
    write_snapshot(again, base, "release_year")
    return with_text_date(
        snapshots.read_snapshots(spark, base, "release_year", columns=COLUMNS)
    )
