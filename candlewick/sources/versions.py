"""Versioned folders of tables: a job's new files become visible at once.

A versioned folder holds data files that are never changed, and one small
manifest per version under ``_versions`` that names the files of each table.
The newest manifest is the folder's content. A job writes its files under a
name of its own, then its manifest beside the others under a temporary name,
and last renames it to the next number: one atomic step of the file system,
refused if that number is taken. A job that dies before has changed nothing a
reader can see; a reader keeps the version it has opened until ``expire``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from candlewick.session import hadoop_path, remove

VERSIONS = "_versions"


class ConcurrentChange(RuntimeError):
    """Another job has committed the version that this one was about to commit."""


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, p = hadoop_path(spark, f"{root}/{VERSIONS}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())


def _file(root: str, number: int) -> str:
    return f"{root}/{VERSIONS}/{number:08d}.json"


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The manifest of a version, by default of the newest; None without any."""
    if number is None:
        found = _numbers(spark, root)
        if not found:
            return None
        number = found[-1]
    fs, p = hadoop_path(spark, _file(root, number))
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, content: dict, after: int) -> int:
    """Makes ``content`` the version behind ``after`` (0: the first one)."""
    number = after + 1
    draft = f"{root}/{VERSIONS}/.{uuid.uuid4().hex}.draft"
    fs, p = hadoop_path(spark, draft)
    out = fs.create(p, False)
    out.write(bytearray(json.dumps(content | {"version": number}).encode()))
    out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # no overwriting
    target = hadoop_path(spark, _file(root, number))[1]
    try:
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        files.rename(fs.makeQualified(p), fs.makeQualified(target), plain)
    except Exception as e:  # the file system's error, as py4j hands it on
        taken = fs.exists(target)
        fs.delete(p, False)
        if taken:
            raise ConcurrentChange(f"version {number} of {root} is there already") from e
        raise
    return number


def named_files(content: dict) -> set[str]:
    """The folders that a manifest names, relative to the root."""
    return {f for files in content["tables"].values() for f in files}


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes the versions before the last ``keep`` and the data folders that
    none of the kept ones names (those of jobs that died included; run it when
    no job is writing). Returns the folders deleted."""
    numbers = _numbers(spark, root)
    if not numbers:
        return []
    kept = set().union(*(named_files(manifest(spark, root, n)) for n in numbers[-keep:]))
    gone = []
    fs, p = hadoop_path(spark, root)
    for n in numbers[:-keep]:
        remove(spark, _file(root, n))
    for table in fs.listStatus(p):
        name = table.getPath().getName()
        if name == VERSIONS or not table.isDirectory():
            continue
        for run in fs.listStatus(table.getPath()):
            folder = f"{name}/{run.getPath().getName()}"
            if not any(k == folder or k.startswith(folder + "/") for k in kept):
                remove(spark, f"{root}/{folder}")
                gone.append(folder)
    return sorted(gone)
