"""Parquet sinks. Each counts its rows while writing, without a second pass."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapledger.session import discard, from_listing, with_settings, write_stage
from snapledger.sinks import switch
from snapledger.sources.snapshots import DATE, FILE, NO_FILES, PACKED, read_snapshots

# Publishes whose files stay: the current one, and the one that readers may still be at.
KEPT = 2
# Properties of a layer's view: the tables of its last refresh and of the one before.
LAST_TABLE, TABLE_BEFORE = "refreshed", "refreshed.before"


def write_snapshot(df: DataFrame, base: str, key: str) -> int:
    """Write ``df`` by ``(key, scraped_date)``; returns the number of rows.

    Only the snapshots that occur in ``df`` are replaced. Rows of a snapshot are
    brought together so that it has few files; adaptive execution merges small
    snapshots into one task and splits a large one over several, so one heavy key
    never lands in a single task.

    A run writes below a folder of its own that readers do not see, and moves its
    snapshots to their places when all of them are there and no other run is moving
    (``switch.Busy`` if one is). So a run that fails changes nothing, and of two runs
    that overlap each snapshot is one run's whole.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    stage = f"{base}/_stage-{uuid.uuid4().hex}"
    try:
        rows = _write(df, stage, [key, DATE])
        if rows:
            with switch.turn(spark, base):
                _move_snapshots(spark, stage, base)
    finally:
        discard(spark, stage)
    return rows


def _write(df: DataFrame, path: str, keys: list[str]) -> int:
    rows = Observation()
    (
        df.hint("rebalance", *keys)
        .observe(rows, F.count(F.lit(1)).alias("rows"))
        .write.partitionBy(*keys)
        .parquet(path)
    )
    return rows.get["rows"]


def _move_snapshots(spark: SparkSession, stage: str, base: str) -> None:
    """Puts every staged snapshot in the place of the one that is there.

    The old one waits beside until the new one is in its place, and goes back if the
    move fails.
    """
    fs, root = switch.file_system(spark, base)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for found in fs.globStatus(path(f"{stage}/*=*/{DATE}=*")) or []:
        staged = found.getPath()
        place = path(root, f"{staged.getParent().getName()}/{staged.getName()}")
        old = path(f"{stage}/_old/{staged.getParent().getName()}/{staged.getName()}")
        fs.mkdirs(place.getParent())
        replaced = fs.exists(place)
        if replaced:
            fs.mkdirs(old.getParent())
            if not fs.rename(place, old):
                raise OSError(f"{place} could not be moved")
        if not fs.rename(staged, place):
            if replaced:
                fs.rename(old, place)
            raise OSError(f"{staged} could not be moved to {place}")


def pack_snapshots(spark: SparkSession, base: str, key: str, key_type: str, before) -> int:
    """Bring snapshots dated before ``before`` together by date; returns how many files went.

    A dataset by id has a folder and a file for each id and day. Packed, it has a few files
    a day, sorted by the key so that a key skips row groups; ``read_snapshots`` gives the
    same rows, keys, dates and source files. Only days with loose snapshots are written.
    They take their place in the turn of one writer; until the loose files are gone, readers
    take those. A snapshot that is written again meanwhile stays loose, and so newer.
    A query that listed the loose files before fails when they go under it; pack when no
    scan of those days is running.
    """
    base = base.rstrip("/")
    limit = F.col(DATE) < F.lit(before)
    try:
        loose = spark.read.schema(f"`{key}` {key_type}, `{DATE}` date").parquet(base)
    except AnalysisException as problem:
        if problem.getCondition() not in NO_FILES:
            raise
        return 0
    # The dates of the listing, and the files of those alone.
    days = [r[0] for r in from_listing(loose.where(limit).select(DATE).distinct()).collect()]
    files = sorted({f for f in loose.inputFiles() if _day(f) in {str(d) for d in days}})
    if not files:
        return 0
    stage = f"{base}/_stage-{uuid.uuid4().hex}"
    try:
        rows = read_snapshots(spark, base, key, key_type, source_file=True)
        rows = rows.where(F.col(DATE).isin(days))
        together = rows.hint("rebalance", DATE).sortWithinPartitions(DATE, key)
        together.write.partitionBy(DATE).parquet(stage)
        with switch.turn(spark, base):
            _move_days(spark, stage, f"{base}/{PACKED}")
            for file in files:
                _remove_file(spark, file)
    finally:
        discard(spark, stage)
    return len(files)


def _day(file: str) -> str:
    return file.rsplit(f"/{DATE}=", 1)[-1].split("/")[0]


def _move_days(spark: SparkSession, stage: str, place: str) -> None:
    fs, root = switch.file_system(spark, place)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(root)
    fs.mkdirs(path(f"{stage}/_old"))
    for found in fs.globStatus(path(f"{stage}/{DATE}=*")) or []:
        staged = found.getPath()
        target, old = path(root, staged.getName()), path(f"{stage}/_old/{staged.getName()}")
        replaced = fs.exists(target)
        if replaced and not fs.rename(target, old):
            raise OSError(f"{target} could not be moved")
        if not fs.rename(staged, target):
            if replaced:
                fs.rename(old, target)
            raise OSError(f"{staged} could not be moved to {target}")


def _remove_file(spark: SparkSession, file: str) -> None:
    """Remove a packed file, and the folders of its day and key when nothing else is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(path, False)
    for folder in (path.getParent(), path.getParent().getParent()):
        visible = [s for s in fs.listStatus(folder) if s.getPath().getName()[0] not in "_."]
        if visible:
            return
        fs.delete(folder, True)


def landed_rows(
    spark: SparkSession, datasets: dict[str, tuple[str, str, str]], date
) -> tuple[DataFrame, str]:
    """``dataset, item, rows`` of the snapshots of one date, from the counts in the files'
    footers, staged; and where.

    ``datasets`` has for each name its folder, its key and the key's type. No row is
    read: the scan itself answers the counts by partition.
    """
    footers = {
        "spark.sql.sources.useV1SourceList": "",
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    other = with_settings(spark, footers)
    counts = other.createDataFrame([], "dataset string, item string, rows long")
    for name, (base, key, kind) in datasets.items():
        found = counted_by_footers(other, base, key, kind, date)
        if found is not None:
            item = F.col(key).cast("string").alias("item")
            counts = counts.unionByName(found.select(F.lit(name).alias("dataset"), item, "rows"))
    _, path = write_stage(counts, "landed-rows")
    return spark.read.schema(counts.schema).parquet(path), path


def counted_by_footers(spark: SparkSession, base: str, key: str, kind: str, date):
    """``key, scraped_date, rows`` of one date, or ``None`` when there is no such dataset."""
    try:
        found = spark.read.schema(f"`{key}` {kind}, `{DATE}` date").parquet(base)
    except AnalysisException as problem:
        if problem.getCondition() not in NO_FILES:
            raise
        return None
    today = found.where(F.col(DATE) == F.lit(date))
    return today.groupBy(key, DATE).agg(F.count("*").alias("rows"))


def refresh_table(df: DataFrame, table: str) -> None:
    """Replace a layer table by ``df`` (full refresh).

    Rows go to a table of their own; ``table`` is a view of the last one that is whole,
    replaced by one change of the catalog. A refresh that fails leaves it as it was, and
    one with other columns needs nothing else. The table before the last one stays for
    those who read it now; the view's properties name both.
    """
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    prefix = f"`{database}`." if database else ""
    view, fresh = f"{prefix}`{name}`", f"{name}__{uuid.uuid4().hex}"
    try:
        df.write.saveAsTable(f"{prefix}`{fresh}`")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}`{fresh}`")
        raise
    said = {}
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "VIEW":
            said = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
        else:
            spark.sql(f"DROP TABLE {view}")
    last = said.get(LAST_TABLE, "")
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES "
        f"('{LAST_TABLE}' = '{fresh}', '{TABLE_BEFORE}' = '{last}') AS SELECT * FROM {prefix}`{fresh}`"
    )
    if said.get(TABLE_BEFORE):
        spark.sql(f"DROP TABLE IF EXISTS {prefix}`{said[TABLE_BEFORE]}`")


def published_path(root: str, name: str, major: int) -> str:
    return f"{root.rstrip('/')}/published_tables/{name}/v{major}"


def publish(df: DataFrame, root: str, name: str, major: int, keys: list[str]) -> int:
    """Replace version ``major`` of a published table, by ``keys``; returns the rows.

    A publish writes a folder of its own, once, and then one mark that names it is the
    switch: readers have the old table whole until it is there, and the new one whole
    after it. A publish that fails or ends early anywhere has changed nothing. Of several
    publishers the last to finish is what readers have. A table without any row is an
    error and replaces nothing.
    """
    spark, path = df.sparkSession, published_path(root, name, major)
    folder = f"_data/{uuid.uuid4().hex}"
    try:
        rows = _write(df, f"{path}/{folder}", keys)
        if not rows:
            raise ValueError(f"no rows to publish as {name}")
        switch.mark(spark, path, folder)
    except Exception:
        discard(spark, f"{path}/{folder}")
        raise
    for number, old in switch.marks(spark, path)[KEPT:]:
        discard(spark, f"{path}/{old}")
        discard(spark, f"{path}/{switch.MARKS}/{number:010d}")
    return rows


def published_files(spark: SparkSession, root: str, name: str, major: int) -> str:
    """The folder with the files of a published table, by its last mark."""
    path = published_path(root, name, major)
    folder = switch.current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return f"{path}/{folder}"


def read_published(spark: SparkSession, root: str, name: str, major: int, schema) -> DataFrame:
    """A published table as of now; later publishes do not change what was read."""
    rows = spark.read.schema(schema).parquet(published_files(spark, root, name, major))
    # The values of the partitions would come last otherwise.
    return rows.select(*[F.col(f"`{field.name}`") for field in schema])
