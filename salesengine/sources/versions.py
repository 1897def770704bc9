"""Table sets that are replaced as one.

Every run writes its tables into a folder of its own under ``versions/``; an empty marker file in
``_commits/``, whose name holds a number and the folder's name, makes that set the current one. Readers take the
marker with the highest name, so they see all tables of a run or none, whatever
the store: creating one empty file is atomic on file systems and object stores alike. A run that
ends before its marker leaves the old set current. Two runs that commit at once may take the same number;
each one's set is whole, and the higher folder name wins.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

COMMITS, VERSIONS, RESULTS = "_commits", "versions", "_results"
#: In a set's folder: names of the folders whose ``staged`` tables together are its fact table, oldest first.
PARTS = "parts.json"


def _at(spark: SparkSession, path: str):
    """(Hadoop path, its file system)"""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _names(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder and when they were last changed (ms); none if there is no folder."""
    p, fs = _at(spark, path)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)}


def write_json(spark: SparkSession, path: str, value) -> None:
    """A small file beside the tables, written by the driver."""
    p, fs = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(json.dumps(value).encode())
    finally:
        out.close()


def read_json(spark: SparkSession, path: str):
    """What ``write_json`` wrote, read without a Spark job; None if there is no such file."""
    p, fs = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table, or another folder or file."""
    p, fs = _at(spark, path)
    fs.delete(p, True)


def new_version(spark: SparkSession, base: str) -> str:
    """A folder for the tables of one run."""
    return f"{base.rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}"


def commits(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """(number, folder) of all commits, oldest first."""
    base = base.rstrip("/")
    found = sorted(n for n in _names(spark, f"{base}/{COMMITS}") if n[0].isdigit())
    return [(int(number), f"{base}/{VERSIONS}/{folder}") for number, folder in (n.split("-", 1) for n in found)]


def commit(spark: SparkSession, base: str, folder: str) -> int:
    """Makes the tables in ``folder`` the current set; returns the commit's number."""
    known = commits(spark, base)
    number = known[-1][0] + 1 if known else 1
    p, fs = _at(spark, f"{base.rstrip('/')}/{COMMITS}/{number:012d}-{folder.rstrip('/').rpartition('/')[2]}")
    fs.create(p, False).close()
    return number


def current(spark: SparkSession, base: str) -> str:
    """Folder of the current set; ``base`` itself where nothing was ever committed (a run without versions)."""
    known = commits(spark, base)
    return known[-1][1] if known else base.rstrip("/")


def version_of(spark: SparkSession, base: str) -> tuple[int, str]:
    """(number, folder) of the current set; number 0 where nothing was ever committed."""
    known = commits(spark, base)
    return known[-1] if known else (0, base.rstrip("/"))


def parts(spark: SparkSession, folder: str) -> list[str]:
    """Folders whose ``staged`` tables make up the set in ``folder``."""
    root = folder.rstrip("/").rpartition("/")[0]
    names = read_json(spark, f"{folder.rstrip('/')}/{PARTS}")
    return [f"{root}/{n}" for n in names] if names else [folder.rstrip("/")]


def vacuum(spark: SparkSession, base: str, keep: int = 2, grace_hours: float = 24) -> list[str]:
    """Deletes sets that are neither among the last ``keep`` commits, nor part of one of these, nor changed within
    ``grace_hours`` (a run that still writes, or a reader of an older set), with their stored results; returns their folders."""
    if keep < 1:
        raise ValueError("the current set stays")
    base = base.rstrip("/")
    known = commits(spark, base)
    kept = {f.rpartition("/")[2] for _, folder in known[-keep:] for f in (folder, *parts(spark, folder))}
    before = (time.time() - grace_hours * 3600) * 1000
    gone = [n for n, changed in _names(spark, f"{base}/{VERSIONS}").items() if n not in kept and changed < before]
    for n in gone:  # its marker first: no reader is led to a folder that is half gone
        for marker in _names(spark, f"{base}/{COMMITS}"):
            if marker.endswith(f"-{n}"):
                p, fs = _at(spark, f"{base}/{COMMITS}/{marker}")
                fs.delete(p, False)
        for below in (RESULTS, VERSIONS):
            remove(spark, f"{base}/{below}/{n}")
    return [f"{base}/{VERSIONS}/{n}" for n in gone]
