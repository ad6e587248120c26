"""Datasets and layers end to end: landed as snapshots, read back, cleaned, published."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.cleaning import GROSS_SQL, gross_text
from queries.pages import (
    DOMESTIC_SQL,
    MARKETS_SQL,
    METADATA_SQL,
    customer_groups,
    order_listings,
    parse,
    part_releases,
)
from queries.registry import BASE_URL, markup, money, query, table
from snapledger.functions import grids
from snapledger.operators import checks, coverage
from snapledger.operators import pages as page_ops
from snapledger.plans import daily, layers, page_index
from snapledger.plans import datasets as ds
from snapledger.session import scratch_path, stage
from snapledger.sinks.parquet import publish, read_published, write_snapshot
from snapledger.sources.snapshots import DATE

DAY = "2024-05-01"
PARTS = ["release_year", "loaded_date"]
RUN_TS = datetime.datetime(2024, 5, 1, 7, 0, 0)


def revenue_lake(spark: SparkSession, sf_dir: str) -> str:
    """Orders as revenue snapshots: a film per order, by order year and month."""
    gross = gross_text()
    status = F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        markup("Film ", F.col("o_orderkey")).alias("Release Group"),
        gross.alias("Worldwide"),
        F.when(status == "F", gross).alias("Domestic"),
        F.when(status == "O", F.substring(gross, 2, 20)).otherwise("-").alias("Foreign"),
        F.year("o_orderdate").alias("release_year"),
        F.trunc("o_orderdate", "month").alias("scraped_date"),
    )
    base = scratch_path(spark, "revenue")
    write_snapshot(rows, base, "release_year")
    return base


def _amount(sql: str) -> str:
    return f"coalesce(try_cast(replace(substring({sql}, 2), ',', '') AS INTEGER), 0)"


REVENUE_SQL = f"""
    SELECT 'Film ' || o_orderkey AS title, {_amount("g")} AS revenue,
           {_amount("CASE WHEN o_orderstatus = 'F' THEN g END")} AS domestic_rev,
           {_amount("CASE WHEN o_orderstatus = 'O' THEN substring(g, 2, 20) ELSE '-' END")} AS foreign_rev,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS loaded_date,
           CAST(year(o_orderdate) AS INTEGER) AS release_year
    FROM (SELECT *, {GROSS_SQL} AS g FROM orders)
"""

PUBLISHED_SQL = f"""
    SELECT *, TIMESTAMP '2024-05-01 07:00:00' AS published_timestamp_utc FROM ({REVENUE_SQL})
"""


@query(REVENUE_SQL)
def cleaned_revenue(spark, sf_dir):
    return layers.cleaned_revenue(layers.raw_revenue(spark, revenue_lake(spark, sf_dir)))


def _published(spark, sf_dir) -> DataFrame:
    published = layers.published_revenue(cleaned_revenue(spark, sf_dir), RUN_TS)
    differences = checks.schema_differences(published, layers.PUBLISHED_SCHEMA)
    if differences:
        raise ValueError(f"published table breaks its contract: {differences}")
    return published


@query(PUBLISHED_SQL)
def published_layer(spark, sf_dir):
    return _published(spark, sf_dir)


@query(PUBLISHED_SQL)
def publish_readback(spark, sf_dir):
    root = scratch_path(spark, "published")
    publish(_published(spark, sf_dir), root, "daily_ranks", 1, PARTS)
    return read_published(spark, root, "daily_ranks", 1, layers.PUBLISHED_SCHEMA)


@query(PUBLISHED_SQL)
def failed_publish(spark, sf_dir):
    """What readers have after a second publish broke off in its last partitions."""
    root = scratch_path(spark, "published")
    first = _published(spark, sf_dir)
    publish(first, root, "daily_ranks", 1, PARTS)
    last = F.when(F.col("release_year") < 1998, F.lit("new")).otherwise(F.raise_error(F.lit("broken")))
    broken = first.withColumn("title", last.cast("string"))
    try:
        publish(broken, root, "daily_ranks", 1, PARTS)
    except Exception as problem:
        if "broken" not in str(problem):
            raise
    else:
        raise ValueError("the second publish did not fail")
    return read_published(spark, root, "daily_ranks", 1, layers.PUBLISHED_SCHEMA)


@query(PUBLISHED_SQL.replace("FROM (", "FROM (SELECT * FROM (", 1) + ") WHERE release_year >= 1995")
def smaller_publish(spark, sf_dir):
    """A second publish of fewer years leaves none of the others behind."""
    root = scratch_path(spark, "published")
    first = _published(spark, sf_dir)
    publish(first, root, "daily_ranks", 1, PARTS)
    publish(first.where("release_year >= 1995"), root, "daily_ranks", 1, PARTS)
    return read_published(spark, root, "daily_ranks", 1, layers.PUBLISHED_SCHEMA)


@query(
    f"""
    SELECT release_year, loaded_date, CAST(count(*) AS BIGINT) AS copies
    FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS release_year,
                 CAST(date_trunc('month', o_orderdate) AS DATE) AS loaded_date FROM orders)
    GROUP BY o_custkey, release_year, loaded_date HAVING count(*) > 1
    """
)
def grain_violations(spark, sf_dir):
    films = table(spark, sf_dir, "orders").select(
        markup("Film ", F.col("o_custkey")).alias("title"),
        F.year("o_orderdate").alias("release_year"),
        F.trunc("o_orderdate", "month").alias("loaded_date"),
    )
    twice = checks.grain_violations(films, ["title", "release_year", "loaded_date"])
    return twice.select("release_year", "loaded_date", "copies")


def lookup_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a lookup: a customer is a group, its domestic release may be unknown."""
    status, key = F.col("o_orderstatus"), F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        markup("Film ", F.col("o_orderkey")).alias("movie_title"),
        F.when(status != "O", markup(f"{BASE_URL}/releasegroup/gr", key, "/")).alias(
            "release_group_url"
        ),
        F.when(status == "F", markup(f"{BASE_URL}/release/rl", key, "/"))
        .when(status == "O", markup(f"{BASE_URL}/release/x", key))
        .when(F.col("o_orderpriority") == "5-LOW", "  ")
        .alias("domestic_release_url"),
        F.year("o_orderdate").alias("release_year"),
        F.trunc("o_orderdate", "month").alias("scraped_date"),
    )
    base = scratch_path(spark, "lookup")
    write_snapshot(rows, base, "release_year")
    return layers.raw_lookup(spark, base)


LATEST_SQL = """
    SELECT *, CAST(year(o_orderdate) AS INTEGER) AS release_year FROM orders
    QUALIFY date_trunc('month', o_orderdate)
          = max(date_trunc('month', o_orderdate)) OVER (PARTITION BY year(o_orderdate))
"""

IDS_SQL = f"""
    SELECT DISTINCT release_year,
           CASE o_orderstatus WHEN 'F' THEN 'rl' ELSE 'x' END || o_custkey AS id
    FROM ({LATEST_SQL}) WHERE o_orderstatus IN ('F', 'O')
"""

GROUP_IDS_SQL = f"""
    SELECT DISTINCT release_year, o_custkey FROM ({LATEST_SQL}) WHERE o_orderstatus <> 'O'
"""


def release_ids(spark, sf_dir) -> DataFrame:
    return ds.lookup_ids(lookup_lake(spark, sf_dir), "domestic_release_url", page_index.RELEASE_ID)


@query(IDS_SQL)
def lookup_ids(spark, sf_dir):
    return release_ids(spark, sf_dir)


DAILY = ["Date", "DOW", "Daily", "Theaters"]


def wanted_releases(spark, sf_dir) -> DataFrame:
    """Release pages of parts whose id the lookup has."""
    day = F.lit(DAY).cast("date").alias("fetched_date")
    pages = part_releases(spark, sf_dir).select(F.col("url").alias("page_key"), "url", "html", day)
    firsts = page_index.first_pages(page_index.page_index(pages, BASE_URL, RUN_TS.date()))
    ids = ds.with_years(release_ids(spark, sf_dir))
    wanted = stage(page_index.listed_pages(firsts, page_index.RELEASE_PATH, ids), "wanted")
    return page_index.with_markup(wanted, pages, RUN_TS.date()).drop(DATE)


@query(
    f"""
    SELECT release_year, id, '{BASE_URL}/release/' || id || '/' AS url, p_name AS movie_title
    FROM ({IDS_SQL}) JOIN part ON id = 'rl' || p_partkey
    """
)
def lookup_pages_join(spark, sf_dir):
    parsed = page_ops.parse(wanted_releases(spark, sf_dir), tags=("h1",), tables=None)
    title = page_ops.heading(ds.TITLE_CLASS)
    return ds.by_year(parsed.select("years", "id", "url", title.alias("movie_title")))


def _daily(sql: str) -> str:
    return f"SELECT release_year, id AS release_id, {sql} FROM ({IDS_SQL}) JOIN part ON id = 'rl' || p_partkey"


PRICE = "CAST(floor(p_retailprice) AS BIGINT)"


@query(
    " UNION ALL ".join(
        [
            _daily(
                f"""'Jan 1' AS "Date", 'Friday' AS "DOW", '$' || format('{{:,}}', {PRICE}) AS "Daily",
                    format('{{:,}}', p_size * 100) AS "Theaters" """
            ),
            _daily(f"'Jan 2', 'Saturday', '$' || format('{{:,}}', {PRICE} * 2), NULL"),
            _daily("'Jan 3', 'Sunday', '-', NULL"),
        ]
    )
)
def release_daily_rows(spark, sf_dir):
    parsed = page_ops.parse(wanted_releases(spark, sf_dir), tags=(), tables=grids.LAST)
    dated = ds.by_year(parsed.withColumn("scraped_date", F.lit(DAY).cast("date")))
    return ds.daily_rows(dated, DAILY).drop("scraped_date", "extras")


@query(
    f"""
    SELECT release_id, movie_title, distributor, CAST(opening_amount AS INTEGER) AS opening_amount,
           CAST(opening_theaters AS INTEGER) AS opening_theaters, release_date, rating, runtime,
           genres, CAST(widest_release AS INTEGER) AS widest_release, DATE '{DAY}' AS scraped_date
    FROM (SELECT {METADATA_SQL} FROM part)
    """
)
def cleaned_metadata(spark, sf_dir):
    pages = part_releases(spark, sf_dir).select(
        markup("rl", F.col("p_partkey")).alias("id"),
        "html",
        F.lit(2024).alias("release_year"),
        F.lit(DAY).cast("date").alias("scraped_date"),
    )
    base = scratch_path(spark, "metadata")
    parsed = parse(pages, ds.RELEASE_TAGS)
    write_snapshot(ds.metadata_rows(parsed), base, "release_year")
    return layers.cleaned_metadata(layers.raw_metadata(spark, base))


@query(
    f"""
    SELECT movie_title, 'gr' || c_custkey AS release_group_id, region, market, release_date,
           try_cast(opening AS INTEGER) AS opening, try_cast(total_gross AS INTEGER) AS total_gross,
           '{BASE_URL}/releasegroup/gr' || c_custkey || '/' AS release_group_url,
           DATE '{DAY}' AS scraped_date
    FROM ({MARKETS_SQL})
    """
)
def cleaned_markets(spark, sf_dir):
    pages = customer_groups(spark, sf_dir).select(
        markup("gr", F.col("c_custkey")).alias("id"),
        "url",
        "html",
        F.lit(2024).alias("release_year"),
        F.lit(DAY).cast("date").alias("scraped_date"),
    )
    base = scratch_path(spark, "markets")
    write_snapshot(ds.market_rows(parse(pages, ds.GROUP_TAGS)), base, "release_year")
    return layers.cleaned_markets(layers.raw_markets(spark, base))


@query(
    """
    SELECT 'rl' || p_partkey AS release_id, p_name AS movie_title, CAST(NULL AS VARCHAR) AS distributor,
           CAST(NULL AS INTEGER) AS opening_amount, CAST(NULL AS INTEGER) AS opening_theaters,
           CAST(NULL AS VARCHAR) AS release_date, CAST(NULL AS VARCHAR) AS rating,
           CAST(NULL AS VARCHAR) AS runtime, p_type AS genres,
           p_size AS widest_release, '2024-05-01' AS scraped_date
    FROM part
    """
)
def optional_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        markup("rl", F.col("p_partkey")).alias("release_id"),
        F.col("p_name").alias("movie_title"),
        F.col("p_type").alias("genres"),
        F.col("p_size").cast("string").alias("widest_release"),
        F.lit(DAY).alias("scraped_date"),
    )
    return layers.cleaned_metadata(rows)


@query(
    """
    WITH requested AS (
        SELECT dataset, CAST(y AS VARCHAR) AS item
        FROM (VALUES ('orders'), ('shipments')) AS d(dataset), range(1977, 2027) AS t(y)
    ), loaded AS (
        SELECT 'orders' AS dataset, CAST(year(o_orderdate) AS VARCHAR) AS item FROM orders
        UNION ALL SELECT 'shipments', CAST(year(l_shipdate) AS VARCHAR) FROM lineitem
    ), counts AS (SELECT dataset, item, count(*) AS n FROM loaded GROUP BY ALL)
    SELECT dataset, item, CAST(coalesce(n, 0) AS BIGINT) AS rows,
           coalesce(n, 0) = 0 AND dataset = 'orders' AS failed
    FROM requested LEFT JOIN counts USING (dataset, item)
    """
)
def batch_report(spark, sf_dir):
    dataset = F.explode(F.array(F.lit("orders"), F.lit("shipments"))).alias("dataset")
    requested = spark.range(1977, 2027).select(dataset, F.col("id").cast("string").alias("item"))
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("dataset"), F.year("o_orderdate").cast("string").alias("item")
    )
    shipped = table(spark, sf_dir, "lineitem").select(
        F.lit("shipments").alias("dataset"), F.year("l_shipdate").cast("string").alias("item")
    )
    return checks.batch_report(requested, orders.unionByName(shipped), ["orders"])


@query(
    """
    SELECT 'orders' AS dataset, CAST(count(*) AS BIGINT) AS rows,
           CAST(50 - count(DISTINCT year(o_orderdate)) AS BIGINT) AS failed
    FROM orders
    UNION ALL SELECT 'shipments', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT) FROM lineitem
    """
)
def batch_totals(spark, sf_dir):
    return checks.batch_totals(batch_report(spark, sf_dir))


def site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as year listings, customers as groups and parts as releases, one page each."""
    listings = order_listings(spark, sf_dir).select(
        markup(f"{BASE_URL}{page_index.YEAR_PATH}", F.col("release_year"), "/?page=", F.col("o_orderkey")).alias("url"),
        "html",
    )
    groups = customer_groups(spark, sf_dir).select("url", "html")
    releases = part_releases(spark, sf_dir).select("url", "html")
    pages = listings.unionByName(groups).unionByName(releases)
    return pages.select(
        F.col("url").alias("page_key"), "url", "html", F.lit(DAY).cast("date").alias("fetched_date")
    )


@query(
    f"""
    WITH films AS (
        SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS x, CAST(year(o_orderdate) AS INTEGER) AS y
        FROM orders
    )
    SELECT 'Film ' || o_orderkey AS title, coalesce(try_cast(x AS INTEGER), 0) AS revenue,
           CAST(0 AS INTEGER) AS domestic_rev, CAST(0 AS INTEGER) AS foreign_rev,
           DATE '{DAY}' AS loaded_date, y AS release_year,
           TIMESTAMP '2024-05-01 07:00:00' AS published_timestamp_utc
    FROM films
    UNION ALL
    SELECT 'A & B', coalesce(try_cast(x * 20000 AS INTEGER), 0), coalesce(try_cast(x AS INTEGER), 0), 0,
           DATE '{DAY}', y, TIMESTAMP '2024-05-01 07:00:00'
    FROM films
    """
)
def daily_run(spark, sf_dir):
    """All five datasets parsed, landed, cleaned and published from one table of pages."""
    root, _ = run_site(spark, sf_dir)
    return read_published(spark, root, "daily_ranks", 1, layers.PUBLISHED_SCHEMA)


def run_site(spark, sf_dir, pages: DataFrame | None = None) -> tuple[str, daily.Result]:
    """The daily run over the years that orders have; years without pages do not fail it."""
    root = scratch_path(spark, "daily")
    span = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    years = [row["y"] for row in span.collect()]
    pages = site(spark, sf_dir) if pages is None else pages
    return root, daily.run_daily(pages, root, RUN_TS.date(), BASE_URL, years=years, run_ts=RUN_TS)


LISTED_SQL = "(SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS release_year, o_custkey FROM orders)"
GROUPS_SQL = f"{LISTED_SQL} JOIN customer ON c_custkey = o_custkey"
RELEASES_SQL = f"""
    (SELECT DISTINCT release_year, parse AS id FROM (
        SELECT release_year, regexp_extract({DOMESTIC_SQL}, '(rl[0-9]+)', 1) AS parse
        FROM {GROUPS_SQL}) WHERE parse <> '') AS r JOIN part ON id = 'rl' || p_partkey
"""
LANDED_SQL = f"""
    SELECT 'worldwide_box_office' AS dataset, CAST(year(o_orderdate) AS INTEGER) AS release_year,
           CAST(2 * count(*) AS BIGINT) AS rows FROM orders GROUP BY ALL
    UNION ALL SELECT 'release_id_lookup', CAST(year(o_orderdate) AS INTEGER), 2 * count(*)
        FROM orders GROUP BY ALL
    UNION ALL SELECT 'release_domestic', release_year, 3 * count(*) FROM {RELEASES_SQL} GROUP BY ALL
    UNION ALL SELECT 'release_metadata', release_year, count(*) FROM {RELEASES_SQL} GROUP BY ALL
    UNION ALL SELECT 'release_worldwide_snapshot', release_year, 3 * count(*)
        FROM {GROUPS_SQL} GROUP BY ALL
"""


@query(LANDED_SQL)
def daily_run_rows(spark, sf_dir):
    """Rows of all five landed datasets, by year."""
    root, result = run_site(spark, sf_dir)
    report = result.report(spark).where("rows > 0")
    return report.select("dataset", F.col("item").cast("int").alias("release_year"), "rows")


@query(
    f"""
    WITH wanted AS (
        SELECT DISTINCT regexp_extract({DOMESTIC_SQL}, '(rl[0-9]+)', 1) AS id FROM {GROUPS_SQL}
    ), absent AS (
        SELECT id FROM wanted WHERE id <> '' AND id NOT IN (SELECT 'rl' || p_partkey FROM part)
    )
    SELECT 'release_domestic' AS dataset, id AS item, 'no page' AS error FROM absent
    UNION ALL SELECT 'release_metadata', id, 'no page' FROM absent
    UNION ALL
    SELECT 'release_id_lookup', '{BASE_URL}/releasegroup/gr' || c_custkey, 'fetched 2 times'
    FROM customer WHERE c_custkey % 5 = 0
    """
)
def daily_run_failures(spark, sf_dir):
    """Ids without a page and repeated pages; other spellings of a URL lose nothing."""
    pages = site(spark, sf_dir)
    group = F.col("url").contains(page_index.GROUP_PATH)
    url = F.regexp_replace("url", "^https:", "HTTPS:")
    pages = pages.withColumn("url", F.when(group, F.regexp_replace(url, "/$", "")).otherwise(F.col("url")))
    number = F.regexp_extract("url", r"/gr(\d+)$", 1).try_cast("long")
    twice = pages.where(number % 5 == 0).withColumn("page_key", F.concat("page_key", F.lit("again")))
    root, result = run_site(spark, sf_dir, pages.unionByName(twice))
    return result.failed_items(spark).where("dataset <> 'daily_ranks'")


def mixed_lake(spark, sf_dir) -> str:
    """Revenue snapshots whose files differ: numbers, texts, only nulls, more columns."""
    base, orders = scratch_path(spark, "mixed"), table(spark, sf_dir, "orders")
    keys = {"release_year": F.year("o_orderdate"), "scraped_date": F.trunc("o_orderdate", "month")}
    title = markup("Film ", F.col("o_orderkey")).alias("Release Group")
    whole = F.floor("o_totalprice")
    kinds = {
        "O": [whole.alias("Worldwide"), (whole / 2).alias("Domestic")],
        "F": [money(whole).alias("Worldwide"), F.lit(None).cast("string").alias("Domestic")],
        "P": [F.lit(None).cast("int").alias("Worldwide"), F.lit("x").alias("More"), whole.alias("Foreign")],
    }
    for status, columns in kinds.items():
        rows = orders.where(F.col("o_orderstatus") == status).withColumns(keys)
        rows.select(title, *columns, *keys).write.mode("append").partitionBy(*keys).parquet(base)
    return base


WHOLE = "CAST(floor(o_totalprice) AS BIGINT)"


@query(
    f"""
    SELECT 'Film ' || o_orderkey AS title,
           CAST(coalesce(try_cast(CASE o_orderstatus WHEN 'O' THEN substring(CAST({WHOLE} AS VARCHAR), 2)
                WHEN 'F' THEN CAST({WHOLE} AS VARCHAR) END AS INTEGER), 0) AS INTEGER) AS revenue,
           CAST(coalesce(try_cast(CASE o_orderstatus WHEN 'P' THEN
                substring(CAST({WHOLE} AS VARCHAR), 2) END AS INTEGER), 0) AS INTEGER) AS foreign_rev,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS loaded_date,
           CAST(year(o_orderdate) AS INTEGER) AS release_year
    FROM orders
    """
)
def raw_mixed_files(spark, sf_dir):
    """Files of differing types and columns through the raw and cleaned layers."""
    raw = layers.raw_revenue(spark, mixed_lake(spark, sf_dir), mixed=True)
    return layers.cleaned_revenue(raw).drop("domestic_rev")


@query(PUBLISHED_SQL)
def models_as_tables(spark, sf_dir):
    """The published model as a table, built from its raw and cleaned tables' models."""
    root = scratch_path(spark, "models")
    rows = spark.read.parquet(revenue_lake(spark, sf_dir))
    write_snapshot(rows, f"{root}/raw/worldwide_box_office", "release_year")
    names = [f"{layer}.worldwide_box_office" for layer in ("raw", "cleaned", "published")]
    layers.refresh_models(spark, root, names, RUN_TS)
    return spark.table("published.worldwide_box_office")


@query(
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS release_year, CAST(count(*) AS BIGINT) AS rows,
           CAST(1 AS BIGINT) AS stamps, 'timestamp_ntz' AS kind, true AS recent
    FROM orders GROUP BY ALL
    """
)
def published_stamp(spark, sf_dir):
    """Without a given time, every row has the one UTC time of the query."""
    published = layers.published_revenue(cleaned_revenue(spark, sf_dir))
    stamp = F.col("published_timestamp_utc")
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    old = F.lit((now - datetime.timedelta(hours=1)).isoformat(sep=" ")).cast("timestamp_ntz")
    late = F.lit((now + datetime.timedelta(hours=3)).isoformat(sep=" ")).cast("timestamp_ntz")
    return published.groupBy("release_year").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(stamp).alias("stamps"),
        F.max(F.typeof(stamp)).alias("kind"),
        F.bool_and(stamp.between(old, late)).alias("recent"),
    )


@query(
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS release_year, 'latest two' AS request,
           CAST(count(*) AS BIGINT) AS rows
    FROM orders WHERE year(o_orderdate) IN (1996, 1995) GROUP BY ALL
    UNION ALL
    SELECT CAST(year(o_orderdate) AS INTEGER), 'since', CAST(count(*) AS BIGINT)
    FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996 GROUP BY ALL
    UNION ALL
    SELECT CAST(year(o_orderdate) AS INTEGER), 'until', CAST(count(*) AS BIGINT)
    FROM orders WHERE year(o_orderdate) BETWEEN 1977 AND 1993 GROUP BY ALL
    UNION ALL
    SELECT CAST(year(o_orderdate) AS INTEGER), 'named', CAST(count(*) AS BIGINT)
    FROM orders WHERE year(o_orderdate) IN (1992, 1998) GROUP BY ALL
    """
)
def requested_years(spark, sf_dir):
    """Orders of the years that each kind of request asks for."""
    as_of = datetime.date(1996, 5, 1)
    asked = {
        "latest two": coverage.requested_years(as_of),
        "since": coverage.requested_years(as_of, start=1994),
        "until": coverage.requested_years(as_of, end=1993),
        "named": coverage.requested_years(as_of, [1992, 1998]),
    }
    pairs = [(name, year) for name, years in asked.items() for year in years]
    wanted = spark.createDataFrame(pairs, "request string, release_year int")
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("release_year"))
    found = orders.join(F.broadcast(wanted), "release_year")
    return found.groupBy("release_year", "request").agg(F.count(F.lit(1)).alias("rows"))
