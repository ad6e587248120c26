"""One table from Parquet files whose schemas differ.

Executors read the footers. Files that agree on the type of every shared column are
one scan, whatever columns they lack; only columns whose types clash split the files
into further scans, and those are united by name.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions import text
from snapledger.session import stage

FOOTER = "path string, name string, kind string"
# Footers that are read at once where only Spark opens the store.
READERS = 16


def footer_columns(spark: SparkSession, base: str) -> DataFrame:
    """``(path, dir, name, kind)`` for every column of every file, from the footers.

    Tasks open footers of files that they reach as files. In any other store they are read
    by Spark's own reader, with its credentials, a few at a time.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select("path")
    )
    here = F.col("path").startswith("file:")
    columns = files.where(here).mapInArrow(_local_footers, FOOTER)
    others = [row["path"] for row in files.where(~here).collect()]
    if others:
        with ThreadPoolExecutor(READERS) as pool:
            found = [row for rows in pool.map(lambda p: _footer(spark, p), others) for row in rows]
        columns = columns.unionByName(spark.createDataFrame(found, FOOTER))
    return columns.withColumn("dir", F.regexp_replace("path", "[^/]+$", ""))


def _local_footers(batches):
    for batch in batches:
        found = {"path": [], "name": [], "kind": []}
        for path in batch.column("path").to_pylist():
            uri = f"file://{quote(path.partition(':')[2].removeprefix('//'), safe='/=@:')}"
            store, name = fs.FileSystem.from_uri(uri)
            with store.open_input_file(name) as file:
                for field in pq.read_schema(file):
                    found["path"].append(path)
                    found["name"].append(field.name)
                    found["kind"].append(str(field.type))
        yield pa.RecordBatch.from_pydict(found)


def _footer(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    fields = spark.read.parquet(path).schema.fields
    return [(path, f.name, f.dataType.simpleString()) for f in fields]


def read_union_by_name(spark: SparkSession, base: str) -> DataFrame:
    """Every file below ``base``: missing columns are null, clashing types widen.

    Numbers widen to the wider number and a column that is only null takes the other
    files' type; anything else that clashes becomes text. Path values stay columns
    and ``filename`` names the source file. Only when types clash do directories have
    to be told apart, and then their names (not data) reach the driver, which holds
    the file listing of the scan anyway.
    """
    columns = stage(footer_columns(spark, base), "footers")
    kinds = columns.groupBy("name").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))
    clashing = [row["name"] for row in kinds.where(F.size("kinds") > 1).collect()]
    if not clashing:
        only_null = [r["name"] for r in kinds.where(F.array_contains("kinds", "null")).collect()]
        scan = _scan(spark, base, [base], {}, [])
        return scan.withColumns({c: F.lit(None).cast("string") for c in only_null})

    scans: dict = defaultdict(list)
    for row in _classes(columns, clashing).collect():
        scans[row["class"]].append(row["dir"])
    frames = []
    for key, dirs in sorted(scans.items()):
        own = dict(part.split("\t") for part in key.split("\n") if part)
        empty = [name for name, kind in own.items() if kind == "null"]
        frames.append(_scan(spark, base, dirs, own, empty))
    types = defaultdict(set)
    for frame in frames:
        for field in frame.schema:
            types[field.name].add(field.dataType)
    as_text = {
        name
        for name, found in types.items()
        if len(found) > 1 and not all(isinstance(kind, T.NumericType) for kind in found)
    }
    frames = [
        frame.withColumns({c: F.col(f"`{c}`").cast("string") for c in frame.columns if c in as_text})
        for frame in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _classes(columns: DataFrame, clashing: list[str]) -> DataFrame:
    """``(class, dir)``: the types a directory's files have in the clashing columns."""
    own = [
        F.max(F.when(F.col("name") == name, F.concat(F.lit(f"{name}\t"), "kind")))
        for name in sorted(clashing)
    ]
    files = columns.groupBy("path", "dir").agg(F.concat_ws("\n", *own).alias("class"))
    split = files.groupBy("dir").agg(
        F.min("class").alias("class"), (F.min("class") != F.max("class")).alias("mixed")
    )
    # A directory with both kinds of files is given file by file.
    return (
        files.join(split.where("mixed"), "dir", "left_semi").select("class", F.col("path").alias("dir"))
    ).unionByName(split.where("NOT mixed").select("class", "dir"))


def _scan(spark, base, paths, own, empty):
    scan = (
        spark.read.option("mergeSchema", "true").option("basePath", base).parquet(*paths)
    ).select("*", F.col("_metadata.file_path").alias("filename"))
    return scan.drop(*[F.col(f"`{name}`") for name in empty])


def read_text_by_name(
    spark: SparkSession, base: str, columns: list[str], keys: dict[str, str]
) -> DataFrame:
    """Every file below ``base`` with its values as text, whatever types the files have.

    Gives the named ``columns`` (null where a file lacks one or has only nulls), the
    values of ``keys`` (name and type) in the files' paths, and ``filename``. Files that
    agree in the types of these columns are one scan of Spark's, split and pruned like
    any other whatever the files' size, and each scan's columns become text. Only where
    types clash are there several scans. A dataset that is not there is empty.
    """
    schema = ", ".join([*(f"`{c}` string" for c in columns), "filename string"])
    try:
        footers = stage(footer_columns(spark, base).where(F.col("name").isin(columns)), "footers")
        files = stage(_files(spark, base), "files")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    else:
        kinds = footers.groupBy("name").agg(F.collect_set("kind").alias("kinds"))
        clashing = [row["name"] for row in kinds.where(F.size("kinds") > 1).collect()]
        scans: dict = defaultdict(list)
        if clashing:
            for row in _classes(footers, clashing).collect():
                scans[row["class"]].append(row["dir"])
            # Files with none of these columns still have rows.
            bare = files.join(footers.select("dir").distinct(), "dir", "left_anti")
            scans[""] += [row["dir"] for row in bare.select("dir").distinct().collect()]
        elif not files.isEmpty():
            scans[""] = [base]
        frames = [spark.createDataFrame([], schema)]
        only_null = {row["name"] for row in kinds.where("array_contains(kinds, 'null')").collect()}
        for key, paths in sorted(scans.items()):
            own = dict(part.split("\t") for part in key.split("\n") if part)
            if paths:
                empty = {name for name in only_null if own.get(name, "null") == "null"}
                frames.append(_as_text(_scan(spark, base, paths, own, []), columns, empty))
        rows = reduce(lambda a, b: a.unionByName(b), frames)
    return rows.select(
        *[F.col(f"`{c}`") for c in columns],
        *[text.path_value(F.col("filename"), k).try_cast(kind).alias(k) for k, kind in keys.items()],
        "filename",
    )


def _files(spark: SparkSession, base: str) -> DataFrame:
    """``(path, dir)`` of every file, from the listing."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(base)
    )
    return files.select("path", F.regexp_replace("path", "[^/]+$", "").alias("dir"))


def _as_text(scan: DataFrame, columns: list[str], empty: set[str]) -> DataFrame:
    """The columns of a scan as text, and its ``filename``; null where it has none."""
    found = {name for name in scan.columns if name not in empty}
    texts = [
        (F.col(f"`{c}`").cast("string") if c in found else F.lit(None).cast("string")).alias(c)
        for c in columns
    ]
    return scan.select(*texts, "filename")


# Pickled by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
