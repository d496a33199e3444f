"""Versioned folders of parquet (B1): loads land beside each other, one step makes them visible.

``root/load=<name>`` holds what one load wrote and never changes. ``root/_commits``
holds a small JSON file for each version, which names the loads that it adds and
what is worth knowing of them without reading them (row counts, partitions). A
version exists when its file does: the file is written under a hidden name
and renamed to its number, which fails when another writer was first. So a load that
dies at any point leaves the version before it as it was, its folder is
read by nobody, and of two writers one has to look at the other's version and
try again.

The rename must not replace an existing file and must be one step, as
HDFS guarantees; a store without such a rename needs another committer.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: An empty or missing folder; any other failure to read it is an error.
NO_STORE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, root: str) -> list[dict]:
    """The commits of ``root`` by version; one small record for each load ever made."""
    fs, folder = _path(spark, f"{root}/_commits")
    lines = spark.read.text(f"{root}/_commits").collect() if fs.exists(folder) else []
    return sorted((json.loads(r.value) for r in lines), key=lambda c: c["version"])


def latest(commits: list[dict]) -> int:
    return commits[-1]["version"] if commits else 0


def commit(spark: SparkSession, root: str, version: int, loads: list[str], **known) -> bool:
    """Make ``loads`` the version ``version``; False when there is one already."""
    fs, folder = _path(spark, f"{root}/_commits")
    fs.mkdirs(folder)
    _, hidden = _path(spark, f"{root}/_commits/_{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(json.dumps({"version": version, "loads": loads, **known}).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    never_replace = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    never_replace[0] = hadoop.Options.Rename.NONE
    _, numbered = _path(spark, f"{root}/_commits/{version:08d}")
    try:
        files.rename(hidden, numbered, never_replace)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        fs.delete(hidden, False)
        return False
    return True


def load_name(version: int) -> str:
    return f"v{version:08d}-{uuid.uuid4().hex[:12]}"


def load_path(root: str, load: str) -> str:
    return f"{root}/load={load}"


def read_loads(spark: SparkSession, root: str, loads: list[str], schema: str) -> DataFrame:
    """The rows of the loads named; the listing is of their folders alone."""
    return spark.read.schema(schema).option("basePath", root).parquet(*[load_path(root, x) for x in loads])


def drop_load(spark: SparkSession, root: str, load: str) -> None:
    """Take away a load that is not committed."""
    fs, path = _path(spark, load_path(root, load))
    fs.delete(path, True)


def drop_partitions(spark: SparkSession, root: str, load: str, partitions: list[str]) -> None:
    """Take partitions out of a load that is not committed."""
    for p in partitions:
        fs, path = _path(spark, f"{load_path(root, load)}/{p}")
        fs.delete(path, True)


def remove_unfinished(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders that no commit names and return their names. Not beside a load that is running."""
    fs, folder = _path(spark, root)
    if not fs.exists(folder):
        return []
    live = {x for c in committed(spark, root) for x in c["loads"]}
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    gone = sorted(n.removeprefix("load=") for n in names if n.startswith("load=") and n.removeprefix("load=") not in live)
    for n in gone:
        fs.delete(_path(spark, load_path(root, n))[1], True)
    return gone


def holds_other_files(spark: SparkSession, root: str) -> bool:
    """Whether there is data at ``root`` that is of no load."""
    fs, folder = _path(spark, root)
    return fs.exists(folder) and any(not s.getPath().getName().startswith(("load=", "_", ".")) for s in fs.listStatus(folder))
