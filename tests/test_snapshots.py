import datetime
import os
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger import session
from snapledger.sinks import switch
from snapledger.sinks.parquet import (
    counted_by_footers,
    landed_rows,
    pack_snapshots,
    publish,
    published_path,
    read_published,
    refresh_table,
    write_snapshot,
)
from snapledger.sources import snapshots
from snapledger.sources.union_by_name import read_text_by_name, read_union_by_name

D1, D2, D3 = (datetime.date(2024, 5, d) for d in (1, 2, 3))
ROWS = [("a", 2023, D1), ("b", 2023, D2), ("c", 2024, D1), ("d", 2024, D1), ("e", 2022, D3)]


@pytest.fixture
def lake(spark, tmp_path):
    base = str(tmp_path / "lake")
    frame = spark.createDataFrame(ROWS, "v string, release_year int, scraped_date date")
    assert write_snapshot(frame, base, "release_year") == len(ROWS)
    return base


def read(spark, base):
    return snapshots.read_snapshots(spark, base, "release_year", columns=["v"])


def values(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_round_trip(spark, lake):
    assert values(read(spark, lake)) == sorted(ROWS)
    assert values(snapshots.read_snapshots(spark, lake, "release_year")) == sorted(ROWS)


def test_missing_column_is_null_and_missing_dataset_is_empty(spark, lake):
    rows = snapshots.read_snapshots(spark, lake, "release_year", columns=["v", "w"])
    assert {r["w"] for r in rows.collect()} == {None}
    assert read(spark, lake + "-none").count() == 0


def test_ids_that_look_like_numbers_stay_text(spark, tmp_path):
    base = str(tmp_path / "ids")
    frame = spark.createDataFrame([("a", "007", D1)], "v string, release_id string, scraped_date date")
    write_snapshot(frame, base, "release_id")
    for columns in (None, ["v"]):
        rows = snapshots.read_snapshots(spark, base, "release_id", "string", columns)
        assert values(rows) == [("a", "007", D1)]


def test_rewriting_one_snapshot_keeps_the_others(spark, lake):
    again = spark.createDataFrame([("z", 2024, D1)], "v string, release_year int, scraped_date date")
    assert write_snapshot(again, lake, "release_year") == 1
    kept = [row for row in ROWS if row[1:] != (2024, D1)]
    assert values(read(spark, lake)) == sorted([*kept, ("z", 2024, D1)])


def test_writing_nothing(spark, lake):
    assert write_snapshot(read(spark, lake).where("v = 'none'"), lake + "2", "release_year") == 0
    assert write_snapshot(read(spark, lake).limit(0), lake + "3", "release_year") == 0


def test_a_heavy_snapshot_is_split_over_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        heavy = spark.range(0, 200_000, 1, 8).select(
            F.md5(F.col("id").cast("string")).alias("v"),
            F.lit(2024).alias("release_year"),
            F.lit(D1).alias("scraped_date"),
        )
        base = tmp_path / "heavy"
        assert write_snapshot(heavy, str(base), "release_year") == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(base.glob("release_year=2024/scraped_date=2024-05-01/*.parquet"))) > 4


LATEST = [row for row in ROWS if row[0] != "a"]


@pytest.mark.parametrize("limits", [{}, {"max_pairs": 1}, {"max_pairs": 1, "max_bytes": 1}])
def test_latest_snapshot_by_every_strategy(spark, lake, limits):
    assert values(snapshots.latest_snapshot(read(spark, lake), "release_year", **limits)) == sorted(LATEST)


@pytest.mark.parametrize("limits", [{}, {"max_pairs": 1}, {"max_pairs": 1, "max_bytes": 1}])
def test_latest_snapshot_as_of(spark, lake, limits):
    rows = snapshots.latest_snapshot(read(spark, lake), "release_year", as_of=D1, **limits)
    assert [v for v, *_ in values(rows)] == ["a", "c", "d"]


def test_latest_snapshot_of_nothing(spark, lake):
    none = snapshots.latest_snapshot(read(spark, lake), "release_year", as_of="2020-01-01")
    assert none.count() == 0


def test_latest_snapshot_plans(spark, lake, plan):
    few = plan(snapshots.latest_snapshot(read(spark, lake), "release_year"))
    assert "PartitionFilters: [" in few and "Exchange" not in few
    many = plan(snapshots.latest_snapshot(read(spark, lake), "release_year", max_pairs=1))
    assert "BroadcastHashJoin" in many and "dynamicpruning" in many
    huge = plan(snapshots.latest_snapshot(read(spark, lake), "release_year", max_pairs=1, max_bytes=1))
    assert "LeftSemi" in huge


def test_index_and_keys_read_no_column(spark, lake, plan):
    rows = read(spark, lake)
    assert values(snapshots.snapshot_index(rows, "release_year")) == [
        (2022, D3), (2023, D1), (2023, D2), (2024, D1),
    ]
    keys = snapshots.snapshot_keys(rows, "release_year")
    assert values(keys) == [(2022,), (2023,), (2024,)]
    assert "ReadSchema: struct<>" in plan(keys)


def test_partition_values_come_from_the_listing(spark, lake, plan):
    latest = snapshots.latest_dates(read(spark, lake), "release_year")
    listed = session.from_listing(latest)
    assert "FileScan" not in plan(listed)
    assert values(listed) == [(2022, D3), (2023, D2), (2024, D1)]
    # Queries of the caller's own session, before and after and meanwhile, are not affected.
    assert "FileScan" in plan(latest) and values(latest) == values(listed)
    assert spark.conf.get("spark.sql.optimizer.metadataOnly") == "false"


def test_concurrent_queries_keep_their_own_plans(spark, lake, plan):
    rows = read(spark, lake)

    def listed(_):
        found = session.from_listing(rows.select("release_year").distinct())
        return "FileScan" in plan(found), values(found)

    def scanned(_):
        found = rows.select("release_year").distinct()
        return "FileScan" in plan(found), values(found)

    with ThreadPoolExecutor(8) as pool:
        mine = [pool.submit(f, n) for n in range(8) for f in (listed, scanned)]
    years = [(2022,), (2023,), (2024,)]
    assert [m.result() for m in mine] == [(False, years), (True, years)] * 8


def test_keys_that_are_no_numbers_are_skipped(spark, tmp_path):
    base = str(tmp_path / "odd")
    frame = spark.createDataFrame(
        [("a", "2024", D1), ("b", "abc", D1)], "v string, release_year string, scraped_date date"
    )
    write_snapshot(frame, base, "release_year")
    rows = snapshots.read_snapshots(spark, base, "release_year", "string", ["v"])
    assert values(snapshots.snapshot_keys(rows, "release_year")) == [(2024,)]


def test_path_values(spark, lake):
    rows = snapshots.with_path_values(snapshots.with_source_file(read(spark, lake)), "release_year")
    for row in rows.collect():
        assert row["release_year_from_path"] == str(row["release_year"])
        assert row["scraped_date_from_path"].date() == row["scraped_date"]


def test_files_matching(spark, lake):
    rows = snapshots.files_matching(spark, lake, "release_year=2024/scraped_date=*/*.parquet")
    assert values(rows.select("v", "release_year")) == [("c", 2024), ("d", 2024)]


def drop(base, year, day, frame):
    folder = base / f"release_year={year}" / f"scraped_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    frame.to_parquet(folder / f"data{len(list(folder.iterdir()))}.parquet", index=False)


def test_union_by_name_widens_and_fills(spark, tmp_path):
    drop(tmp_path, 2023, "2023-01-01", pd.DataFrame(
        {"title": ["a"], "rank": [1], "x": [None], "n": pd.Series([1], dtype="int32"), "f": [1]}))
    drop(tmp_path, 2023, "2023-01-02", pd.DataFrame(
        {"title": ["b"], "rank": ["2nd"], "x": ["q"], "n": [2**40], "f": [1.5]}))
    drop(tmp_path, 2024, "2024-01-01", pd.DataFrame({"title": ["c"], "extra": [2.5]}))
    rows = read_union_by_name(spark, str(tmp_path))
    kinds = dict(rows.dtypes)
    assert (kinds["rank"], kinds["x"], kinds["n"], kinds["f"]) == ("string", "string", "bigint", "double")
    found = values(rows.select("title", "rank", "x", "n", "f", "extra", "release_year"))
    assert found == [
        ("a", "1", None, 1, 1.0, None, 2023),
        ("b", "2nd", "q", 2**40, 1.5, None, 2023),
        ("c", None, None, None, None, 2.5, 2024),
    ]
    assert all(row["filename"].endswith(".parquet") for row in rows.collect())


def test_union_by_name_of_agreeing_files_is_one_scan(spark, tmp_path, plan):
    drop(tmp_path, 2023, "2023-01-01", pd.DataFrame({"title": ["a"], "x": ["1"]}))
    drop(tmp_path, 2024, "2024-01-01", pd.DataFrame({"title": ["b"]}))
    rows = read_union_by_name(spark, str(tmp_path))
    assert values(rows.select("title", "x")) == [("a", "1"), ("b", None)]
    assert plan(rows).count("FileScan") == 1


def test_union_by_name_with_both_kinds_in_one_directory(spark, tmp_path):
    drop(tmp_path, 2023, "2023-01-01", pd.DataFrame({"v": [1]}))
    drop(tmp_path, 2023, "2023-01-01", pd.DataFrame({"v": ["x"]}))
    drop(tmp_path, 2024, "2024-01-01", pd.DataFrame({"v": [2]}))
    assert values(read_union_by_name(spark, str(tmp_path)).select("v")) == [("1",), ("2",), ("x",)]


def test_text_by_name_of_files_that_clash(spark, tmp_path, plan):
    keys = {"release_year": "int", "scraped_date": "date"}
    drop(tmp_path, 2022, "2022-01-01", pd.DataFrame({"v": [1, 2], "w": ["a", None]}))
    drop(tmp_path, 2023, "2023-01-01", pd.DataFrame({"v": ["x", None], "more": [1.5, 2.5]}))
    drop(tmp_path, 2024, "2024-01-01", pd.DataFrame({"other": [7]}))
    drop(tmp_path, 2024, "2024-01-01", pd.DataFrame({"v": [None, None]}))
    rows = read_text_by_name(spark, str(tmp_path), ["v", "w", "none"], keys)
    found = rows.select("v", "w", "none", "release_year", F.col("scraped_date").cast("string")).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("1", "a", None, 2022, "2022-01-01"), ("2", None, None, 2022, "2022-01-01"),
         ("x", None, None, 2023, "2023-01-01"), (None, None, None, 2023, "2023-01-01")]
        + [(None, None, None, 2024, "2024-01-01")] * 3, key=str,
    )
    assert rows.where("filename IS NULL").count() == 0
    text = plan(rows)
    assert "MapInArrow" not in text and "more" not in text and "FileScan parquet" in text


def test_text_by_name_of_one_kind_is_one_scan(spark, lake, plan):
    rows = read_text_by_name(spark, lake, ["v"], {"release_year": "int"})
    assert plan(rows).count("FileScan") == 1
    assert rows.count() == len(ROWS)
    none = read_text_by_name(spark, f"{lake}-none", ["v"], {"release_year": "int"})
    assert none.columns == ["v", "release_year", "filename"] and none.isEmpty()


def test_footers_of_stores_that_only_spark_opens(spark, tmp_path):
    drop(tmp_path, 2022, "2022-01-01", pd.DataFrame({"v": [1]}))
    drop(tmp_path, 2023, "2023-01-01", pd.DataFrame({"v": ["x"]}))
    other = session.with_settings(spark, {})
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.lake.link./in", f"file://{tmp_path}")
    rows = read_text_by_name(other, "viewfs://lake/in", ["v"], {"release_year": "int"})
    assert values(rows.select("v", "release_year")) == [("1", 2022), ("x", 2023)]


def days(spark, n):
    return spark.range(n).withColumn("day", F.col("id") % 4)


def published(spark, root, name="t", major=1):
    return values(read_published(spark, root, name, major, T.StructType.fromDDL("id long, day long")))


def test_publish_is_versioned_and_replaces(spark, tmp_path):
    root = str(tmp_path)
    assert publish(days(spark, 5), root, "t", 1, ["day"]) == 5
    assert publish(days(spark, 3), root, "t", 1, ["day"]) == 3
    assert publish(days(spark, 7), root, "t", 2, ["day"]) == 7
    assert len(published(spark, root)) == 3 and len(published(spark, root, major=2)) == 7
    assert published_path(root, "t", 2).endswith("/published_tables/t/v2")
    with pytest.raises(FileNotFoundError):
        published(spark, root, "other")


def test_failed_or_empty_publish_leaves_what_is_there(spark, tmp_path):
    root, rows = str(tmp_path), days(spark, 8)
    publish(rows, root, "t", 1, ["day"])
    broken = rows.withColumn("id", F.when(F.col("day") < 3, F.col("id")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        publish(broken, root, "t", 1, ["day"])
    with pytest.raises(ValueError, match="no rows"):
        publish(rows.limit(0), root, "t", 1, ["day"])
    assert len(published(spark, root)) == 8
    assert len(os.listdir(f"{published_path(root, 't', 1)}/_data")) == 1


def test_publish_that_breaks_at_its_switch_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish(days(spark, 8), root, "t", 1, ["day"])

    def broken(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(switch, "created", broken)
        with pytest.raises(OSError, match="gone"):
            publish(days(spark, 99), root, "t", 1, ["day"])
    assert len(published(spark, root)) == 8
    # A mark that was begun and not finished counts for nothing, and its number is left out.
    open(f"{published_path(root, 't', 1)}/_marks/0000000002", "w").close()
    assert len(published(spark, root)) == 8
    publish(days(spark, 5), root, "t", 1, ["day"])
    assert len(published(spark, root)) == 5
    assert switch.marks(spark, published_path(root, "t", 1))[0][0] == 3


def test_readers_keep_the_table_they_began_with(spark, tmp_path):
    root = str(tmp_path)
    publish(days(spark, 8), root, "t", 1, ["day"])
    before = read_published(spark, root, "t", 1, T.StructType.fromDDL("id long, day long"))
    publish(days(spark, 3), root, "t", 1, ["day"])
    assert before.count() == 8 and len(published(spark, root)) == 3
    for n in (4, 5, 6):
        publish(days(spark, n), root, "t", 1, ["day"])
    assert len(os.listdir(f"{published_path(root, 't', 1)}/_data")) == 2
    # Whoever reads the folder itself sees no rows rather than those of several publishes.
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        spark.read.parquet(published_path(root, "t", 1))


def test_publishing_evaluates_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    publish(days(spark, 40).mapInArrow(count, "id long, day long"), str(tmp_path), "t", 1, ["day"])
    assert seen.value == 40


def test_one_of_many_publishers_is_what_readers_have(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: publish(days(spark, n), root, "t", 1, ["day"]), [4, 5, 6, 7]))
    found = published(spark, root)
    assert len(found) in (4, 5, 6, 7) and len({r[0] for r in found}) == len(found)


def test_two_writers_of_a_snapshot_leave_one_result(spark, tmp_path):
    base = str(tmp_path / "lake")

    def rows(writer):
        return spark.range(40).select(
            F.lit(writer).alias("writer"),
            (2000 + F.col("id") % 5).cast("int").alias("release_year"),
            F.lit(D1).alias("scraped_date"),
        )

    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda w: write_snapshot(rows(w), base, "release_year"), "abcd"))
    assert counts == [40] * 4
    found = snapshots.read_snapshots(spark, base, "release_year", columns=["writer"]).collect()
    assert len(found) == 40
    for year in range(2000, 2005):
        assert len({r["writer"] for r in found if r["release_year"] == year}) == 1
    assert [n for n in os.listdir(base) if n.startswith("_")] == []


def test_a_snapshot_that_cannot_be_moved_leaves_the_old_one(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "lake")
    frame = spark.createDataFrame([("old", 2024, D1)], "v string, release_year int, scraped_date date")
    write_snapshot(frame, base, "release_year")
    broken = frame.withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        write_snapshot(broken, base, "release_year")
    with switch.turn(spark, base):
        monkeypatch.setattr(switch, "WAIT_SECONDS", 0)
        with pytest.raises(switch.Busy), switch.turn(spark, base, wait_seconds=0):
            pass
    assert values(read(spark, base).select("v")) == [("old",)]
    assert [n for n in os.listdir(base) if n.startswith("_")] == []


def test_the_turn_of_a_writer_that_is_gone_is_taken_over(spark, tmp_path):
    base = str(tmp_path)
    assert switch.created(spark, f"{base}/_turn", "someone")
    with pytest.raises(switch.Busy), switch.turn(spark, base, wait_seconds=0):
        pass
    with switch.turn(spark, base, wait_seconds=5, stale_seconds=-1) as own:
        assert switch.content(spark, f"{base}/_turn") == own != "someone"
    assert os.listdir(base) == []


def test_rows_by_key_come_from_the_footers(spark, lake, plan):
    datasets = {"a": (lake, "release_year", "int"), "none": (lake + "-none", "release_year", "int")}
    assert values(landed_rows(spark, datasets, D1)[0]) == sorted(
        ("a", str(r["release_year"]), r["count"])
        for r in read(spark, lake).where(F.col("scraped_date") == F.lit(D1)).groupBy("release_year").count().collect()
    )
    footers = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    other = session.with_settings(spark, footers)
    text = plan(counted_by_footers(other, lake, "release_year", "int", D1))
    assert "PushedAggregation: [COUNT(*)]" in text


def by_id(spark, rows, base):
    frame = spark.createDataFrame(rows, "v string, w long, release_id string, scraped_date date")
    write_snapshot(frame, base, "release_id")


def parquet_files(base):
    return [f for _, _, names in os.walk(base) for f in names if f.endswith(".parquet")]


def test_packed_snapshots_read_like_loose_ones(spark, tmp_path):
    base = str(tmp_path / "ids")
    rows = [(f"v{i}", i, f"{i:03d}", d) for i in range(15) for d in (D1, D2, D3)]
    by_id(spark, rows, base)

    def scan(columns=None):
        return snapshots.read_snapshots(spark, base, "release_id", "string", columns, source_file=True)

    before = values(scan())
    assert pack_snapshots(spark, base, "release_id", "string", D3) == 30
    assert len(parquet_files(base)) <= 15 + 4
    assert values(scan()) == before and scan().columns == ["v", "w", "release_id", "scraped_date", "filename"]
    assert values(scan("v string, w long")) == before
    by_path = snapshots.with_path_values(scan(["v"]), "release_id").where("release_id = '007'")
    assert {r["release_id_from_path"] for r in by_path.collect()} == {"007"}
    assert pack_snapshots(spark, base, "release_id", "string", D3) == 0
    latest = snapshots.latest_snapshot(scan().drop("filename"), "release_id", D2)
    assert values(latest) == sorted(r for r in rows if r[3] == D2)


def test_a_packed_snapshot_that_is_written_again_is_the_new_one(spark, tmp_path):
    base = str(tmp_path / "ids")
    by_id(spark, [("a", 1, "1", D1), ("b", 2, "2", D1), ("n", 3, None, D1)], base)
    pack_snapshots(spark, base, "release_id", "string", D3)
    by_id(spark, [("new", 9, "1", D1)], base)
    want = [("b", 2, "2", D1), ("n", 3, None, D1), ("new", 9, "1", D1)]

    def scan():
        return {tuple(r) for r in snapshots.read_snapshots(spark, base, "release_id", "string").collect()}

    assert scan() == set(want)
    assert pack_snapshots(spark, base, "release_id", "string", D3) == 1
    assert scan() == set(want) and len(parquet_files(base)) == 1


def test_packing_that_breaks_leaves_the_rows(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "ids")
    rows = [(f"v{i}", i, str(i), D1) for i in range(4)]
    by_id(spark, rows, base)
    from snapledger.sinks import parquet

    def breaks(*_):
        raise OSError("gone")

    monkeypatch.setattr(parquet, "_remove_file", breaks)
    with pytest.raises(OSError, match="gone"):
        pack_snapshots(spark, base, "release_id", "string", D3)
    read = snapshots.read_snapshots(spark, base, "release_id", "string")
    assert values(read) == sorted(rows)
    assert pack_snapshots(spark, str(tmp_path / "none"), "release_id", "string", D3) == 0


def test_refresh_table(spark):
    refresh_table(spark.range(5), "layer_table")
    refresh_table(spark.range(2), "layer_table")
    assert spark.table("layer_table").count() == 2
    refresh_table(spark.range(3).withColumn("more", F.lit("x")), "layer_table")
    assert spark.table("layer_table").columns == ["id", "more"]
    tables = [r["tableName"] for r in spark.sql("SHOW TABLES LIKE 'layer_table*'").collect()]
    assert len(tables) == 3


def test_a_failing_refresh_leaves_the_table(spark):
    refresh_table(spark.range(5), "failing_table")
    broken = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        refresh_table(broken, "failing_table")
    assert spark.table("failing_table").count() == 5
    assert spark.sql("SHOW TABLES LIKE 'failing_table*'").count() == 2


def test_a_table_of_old_becomes_a_view(spark):
    spark.range(4).write.mode("overwrite").saveAsTable("older_table")
    refresh_table(spark.range(6), "older_table")
    assert spark.table("older_table").count() == 6


def test_broadcast_only_below_the_bound(spark, plan):
    big, small = spark.range(1000), spark.range(10).withColumn("s", F.lit("x" * 100))
    hinted = big.join(session.broadcast_if_small(small), "id")
    assert "BroadcastHashJoin" in plan(hinted)
    assert session.broadcast_if_small(small, max_bytes=100) is small


def test_scratch_path_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    path = session.scratch_path(spark, "x")
    assert path != session.scratch_path(spark, "x")
    assert path.startswith(shared)


def test_nested_columns_are_measured(spark):
    nested = spark.range(3).select(F.array(F.lit("x" * 1000)).alias("a"))
    assert nested.select(session.row_bytes(nested).alias("n")).first()["n"] > 1000


def test_staged_tables_are_removed(spark, tmp_path):
    _, path = session.write_stage(spark.range(3), "gone")
    session.discard(spark, path)
    assert not os.path.exists(path)


def test_a_table_beyond_the_bound_is_not_broadcast_by_its_files(spark, plan, tmp_path):
    """Files of a few KB, but rows of one long text: Spark alone would broadcast them."""
    spark.range(500).withColumn("s", F.lit("x" * 1000)).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    big = spark.range(1000)
    assert "BroadcastHashJoin" in plan(big.join(session.broadcast_if_small(table, 1000), "id"))
    for how in ("inner", "left", "left_anti", "left_semi"):
        large = plan(big.join(session.join_side(table, 1000), "id", how))
        assert "SortMergeJoin" in large and "BroadcastHashJoin" not in large
    assert "BroadcastHashJoin" in plan(big.join(session.join_side(table), "id"))


def test_narrow_rows_are_measured_as_they_are_broadcast(spark):
    ids = spark.range(1000).select(F.col("id").cast("string"))
    assert not session.is_small(ids, 1000 * 100)
