"""Driver-side Hadoop FileSystem metadata calls (exists, rename, delete, one-level listings).

Only directory metadata goes through the driver; data never does.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def jpath(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = jpath(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = jpath(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def rename_path(spark: SparkSession, src: str, dst: str) -> None:
    fs, ps = jpath(spark, src)
    _, pd = jpath(spark, dst)
    if not fs.rename(ps, pd):
        raise OSError(f"rename failed: {src} -> {dst}")


def list_subdirs(spark: SparkSession, path: str, prefix: str = "") -> list[tuple[str, str]]:
    """(name, full path) of the entries of ``path`` whose name starts with ``prefix`` (partition
    folders such as ``order_date=...``; names starting with ``_`` or ``.`` are markers, skipped).
    One JVM call per entry (its name): this runs over thousands of day folders."""
    fs, p = jpath(spark, path)
    if not fs.exists(p):
        return []
    base = path.rstrip("/")
    out = []
    if fs.getScheme() == "file":  # the local file system is the OS directory: list it directly
        local = p.toUri().getPath()
        for entry in os.scandir(local):
            if entry.name.startswith(prefix) and not entry.name.startswith(("_", ".")):
                out.append((entry.name, f"{base}/{entry.name}"))
        return out
    for jp in spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p)):
        name = jp.getName()
        if name.startswith(prefix) and not name.startswith(("_", ".")):
            out.append((name, f"{base}/{name}"))
    return out


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small marker file, or None if there is none."""
    fs, p = jpath(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small marker file in one step: written beside it, then renamed over it."""
    jvm = spark.sparkContext._jvm
    fs, tmp = jpath(spark, f"{path}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(tmp, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    rename[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(tmp), fs.makeQualified(target), rename)
