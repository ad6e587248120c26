"""Switches: what a folder's readers see, told by one small file.

Data is written beside what is there, and then one file with the next number, created
only if it is absent, says where the data is. So a change is seen whole or not at all,
and of two writers that ask for the same number one gets it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MARKS = "_marks"
TURN = "_turn"
# A turn older than this is of a writer that is gone; the longest turn is a few renames.
STALE_SECONDS = 900
# How long a writer waits for the turn of another, and looks again.
WAIT_SECONDS, LOOK_SECONDS = 60, 0.2


class Busy(RuntimeError):
    """Another writer has its turn at this folder."""


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def created(spark: SparkSession, path: str, content: str) -> bool:
    """Whether this call made the file: false if there is one already."""
    fs, target = file_system(spark, path)
    fs.mkdirs(target.getParent())
    local = fs.getUri().getScheme() == "file"
    try:
        if local:
            # Hadoop's local files are looked for first and made then, which two may do at once.
            nothing = spark.sparkContext._gateway.new_array(
                spark._jvm.java.nio.file.attribute.FileAttribute, 0
            )
            place = spark._jvm.java.io.File(target.toUri().getPath()).toPath()
            spark._jvm.java.nio.file.Files.createFile(place, nothing)
        out = fs.create(target, local)
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" in str(problem.java_exception):
            return False
        raise
    try:
        out.write((content + "\n").encode())
    finally:
        out.close()
    return True


def content(spark: SparkSession, path: str) -> str | None:
    """What a file says; ``None`` while it is not written to its end, or not there."""
    fs, target = file_system(spark, path)
    try:
        stream = fs.open(target)
    except Exception:
        if fs.exists(target):
            raise
        return None
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text[:-1] if text.endswith("\n") else None


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none when it is not there."""
    fs, target = file_system(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def marks(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """All complete marks of a folder as ``(number, content)``, the latest first."""
    numbers = [n for n in names(spark, f"{folder}/{MARKS}") if n.isdigit()]
    said = ((int(n), content(spark, f"{folder}/{MARKS}/{n}")) for n in reversed(numbers))
    return [(number, text) for number, text in said if text]


def current(spark: SparkSession, folder: str) -> str | None:
    """What the latest complete mark of a folder says."""
    for name in reversed([n for n in names(spark, f"{folder}/{MARKS}") if n.isdigit()]):
        said = content(spark, f"{folder}/{MARKS}/{name}")
        if said:
            return said
    return None


def mark(spark: SparkSession, folder: str, said: str) -> int:
    """The next mark of a folder, as ``said``; returns its number.

    A number that another writer takes first is left to it, and the next one is tried.
    """
    numbers = [int(n) for n in names(spark, f"{folder}/{MARKS}") if n.isdigit()]
    number = max(numbers, default=0) + 1
    while not created(spark, f"{folder}/{MARKS}/{number:010d}", said):
        number += 1
    return number


@contextmanager
def turn(
    spark: SparkSession,
    folder: str,
    wait_seconds: float = WAIT_SECONDS,
    stale_seconds: float = STALE_SECONDS,
) -> Iterator[str]:
    """The only turn at a folder; ``Busy`` when another writer keeps it too long.

    A turn that is older than ``stale_seconds`` is taken over: it is moved away, which
    only one of several writers can do, and then asked for like any other.
    """
    path, own = f"{folder}/{TURN}", uuid.uuid4().hex
    until = time.monotonic() + wait_seconds
    while not created(spark, path, own):
        if _age(spark, path) > stale_seconds:
            _move_away(spark, path)
        elif time.monotonic() > until:
            raise Busy(f"another writer has its turn at {folder}")
        else:
            time.sleep(LOOK_SECONDS)
    try:
        yield own
    finally:
        if content(spark, path) == own:
            fs, target = file_system(spark, path)
            fs.delete(target, False)


def _age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written; none when it is gone."""
    fs, target = file_system(spark, path)
    found = fs.globStatus(target)
    return time.time() - found[0].getModificationTime() / 1000 if found else 0.0


def _move_away(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    away = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    if fs.rename(target, away):
        fs.delete(away, False)
