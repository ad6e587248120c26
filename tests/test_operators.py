import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.operators import checks, coverage
from snapledger.plans import datasets, layers
from snapledger.sinks.parquet import write_snapshot
from snapledger.sources.union_by_name import read_union_by_name

AS_OF = datetime.date(2026, 3, 1)


def test_requested_years():
    assert coverage.requested_years(AS_OF) == [2026, 2025]
    assert coverage.requested_years(AS_OF, [1990, 1980]) == [1990, 1980]
    assert coverage.requested_years(AS_OF, start=2024) == [2024, 2025, 2026]
    assert coverage.requested_years(AS_OF, end=1978) == [1977, 1978]
    with pytest.raises(ValueError):
        coverage.requested_years(AS_OF, start=2025, end=2024)


def years(spark, *present):
    return spark.createDataFrame([(y,) for y in present], "release_year int")


def test_missing_years(spark):
    both = [years(spark, 2026, 2025, 2023, 2023, 1900), years(spark, 2026, 2025, 2024, 2023, 2020)]
    covered = coverage.covered_years(both, "release_year", 1977, 2026)
    assert {r[0] for r in covered.collect()} == {2026, 2025, 2023}
    missing = coverage.missing_years(spark, covered, "release_year", 1977, 2026)
    found = [r[0] for r in missing.collect()]
    assert found == sorted(found, reverse=True)
    assert len(found) == 47 and set(found) | {2026, 2025, 2023} == set(range(1977, 2027))
    assert coverage.next_missing_year(missing, "release_year").first()[0] == 2024


def test_nothing_missing(spark):
    covered = years(spark, 2024, 2025)
    missing = coverage.missing_years(spark, covered, "release_year", 2024, 2025)
    assert coverage.next_missing_year(missing, "release_year").collect() == []


def test_columns(spark):
    frame = spark.createDataFrame([("x", 1)], "a string, b int")
    assert checks.missing_columns(frame, {"a", "z"}) == ["z"]
    assert checks.require_columns(frame, {"a", "z"}).count() == 0
    assert checks.require_columns(frame, {"a", "b"}).count() == 1
    filled = checks.with_optional_columns(frame, ["b", "c", "d"])
    assert filled.dtypes[2:] == [("c", "string"), ("d", "string")]
    assert tuple(filled.first()) == ("x", 1, None, None)


def test_failure_summary(spark, plan):
    rows = [("d1", str(i), "e") for i in range(25)] + [("d2", "7", "e")]
    failures = spark.createDataFrame(rows, "dataset string, item string, error string")
    summary = checks.failure_summary(failures, F.col("item").cast("int"))
    found = {r["dataset"]: (r["failed"], r["first_items"]) for r in summary.collect()}
    assert found == {"d1": (25, [str(i) for i in range(10)]), "d2": (1, ["7"])}
    # The limit is applied before the shuffle as well as after it.
    assert plan(summary).count("WindowGroupLimit") >= 2


def test_batch_report(spark):
    requested = spark.createDataFrame(
        [("a", "2024"), ("a", "2023"), ("b", "2024")], "dataset string, item string"
    )
    loaded = spark.createDataFrame([("a", "2024"), ("a", "2024"), ("c", "2024")], "dataset string, item string")
    report = checks.batch_report(requested, loaded, ["a"])
    assert sorted(tuple(r) for r in report.collect()) == [
        ("a", "2023", 0, True),
        ("a", "2024", 2, False),
        ("b", "2024", 0, False),
    ]
    assert sorted(tuple(r) for r in checks.batch_totals(report).collect()) == [("a", 2, 1), ("b", 0, 0)]


def test_grain(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "title string, day int")
    assert [tuple(r) for r in checks.grain_violations(frame, ["title", "day"]).collect()] == [("a", 1, 2)]


def test_schema_differences(spark):
    contract = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert checks.schema_differences(spark.createDataFrame([], "a string, b int"), contract) == []
    assert checks.schema_differences(spark.createDataFrame([], "b int, a string"), contract) == [
        "columns in another order"
    ]
    assert checks.schema_differences(spark.createDataFrame([], "a string, b bigint"), contract) == [
        "missing b int",
        "unexpected b bigint",
    ]


def cleaned(spark):
    return spark.createDataFrame(
        [("t", 1, 2, 3, datetime.date(2024, 5, 1), 2024)],
        "title string, revenue int, domestic_rev int, foreign_rev int, loaded_date date, release_year int",
    )


def test_published_schema_and_time(spark):
    published = layers.published_revenue(cleaned(spark))
    assert checks.schema_differences(published, layers.PUBLISHED_SCHEMA) == []
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert abs(published.first()["published_timestamp_utc"] - now) < datetime.timedelta(minutes=5)


def test_published_time_is_utc_in_any_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        stamp = layers.published_revenue(cleaned(spark)).first()["published_timestamp_utc"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert abs(stamp - now) < datetime.timedelta(minutes=5)


def test_wide_amounts(spark):
    raw = spark.createDataFrame(
        [("t", "$2,923,706,026", "-", None, datetime.date(2024, 5, 1), 2024)],
        "`Release Group` string, Worldwide string, Domestic string, Foreign string, "
        "scraped_date date, release_year int",
    )
    assert tuple(layers.cleaned_revenue(raw).first())[1:4] == (0, 0, 0)
    assert tuple(layers.cleaned_revenue(raw, to="bigint").first())[1:4] == (2923706026, 0, 0)


def test_filters_on_published_columns_prune_partitions(spark, tmp_path, plan):
    base = str(tmp_path / "raw")
    raw = spark.createDataFrame(
        [("t", "$1", "-", "-", datetime.date(2024, 5, 1), 2024)],
        "`Release Group` string, Worldwide string, Domestic string, Foreign string, "
        "scraped_date date, release_year int",
    )
    write_snapshot(raw, base, "release_year")
    published = layers.published_revenue(layers.cleaned_revenue(layers.raw_revenue(spark, base)))
    text = plan(published.where("loaded_date = DATE '2024-05-01' AND release_year = 2024"))
    filters = text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "scraped_date" in filters and "release_year" in filters
    assert "Release Group" in text and "_from_path" not in text


def test_layers_over_a_lake_of_differing_files(spark, tmp_path):
    """One file per entity and day, written by something that infers a schema per file."""
    for release, frame in {
        "rl1": pd.DataFrame({"release_id": ["rl1"], "movie_title": ["A"], "opening_amount": ["5"]}),
        "rl2": pd.DataFrame({"release_id": ["rl2"], "movie_title": ["B"], "opening_amount": [None]}),
        "rl3": pd.DataFrame({"release_id": ["rl3"], "widest_release": [7]}),
    }.items():
        folder = tmp_path / f"release_id={release}" / "scraped_date=2024-05-01"
        folder.mkdir(parents=True)
        frame.to_parquet(folder / "data.parquet", index=False)
    rows = layers.cleaned_metadata(read_union_by_name(spark, str(tmp_path)))
    found = rows.select("release_id", "movie_title", "opening_amount", "widest_release", "genres")
    assert sorted(tuple(r) for r in found.collect()) == [
        ("rl1", "A", 5, None, None),
        ("rl2", "B", None, None, None),
        ("rl3", None, None, 7, None),
    ]


def test_a_heavily_listed_group_is_split(spark):
    """A third of all listings name one group: its join partition is split over tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        listed = spark.range(0, 300_000, 1, 8).select(
            F.concat(F.lit("g"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias(
                "release_group_url"
            ),
            F.md5(F.col("id").cast("string")).alias("movie_title"),
            F.lit(2024).alias("release_year"),
            F.lit(datetime.date(2024, 5, 1)).alias("scraped_date"),
        )
        domestic = spark.range(0, 300_000, 1, 8).select(
            F.concat(F.lit("g"), "id").alias("release_group_url"),
            F.concat(F.lit("r"), "id").alias("domestic_release_url"),
        )
        rows = datasets.lookup_rows(listed, domestic)
        found = rows.groupBy().agg(F.count("domestic_release_url").alias("n"))
        counted = found.collect()[0]["n"]
        executed = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert counted == 300_000
    assert "skew=true" in executed
