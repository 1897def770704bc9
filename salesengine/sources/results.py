"""Results of ad-hoc statements, stored by statement, parameters and table version.

The tables of a version never change, so a stored result holds as long as its version is current; a
new version has a folder of results of its own. A statement is stored only if its answer follows from
these tables alone: it is deterministic, reads nothing else, and names no function of time or user.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import open_tables, sql
from .versions import RESULTS, _at, _names, version_of

#: Words whose value depends on when or by whom a statement runs. A statement with one of them, be it
#: in a comment or as a column's name, is run each time.
VARYING = re.compile(
    r"\b(current_\w+|curdate|curtime|now|localtime\w*|today|tomorrow|yesterday|unix_timestamp|session_user|user|uuid|version|input_file\w*|reflect|java_method|try_reflect)\b", re.I)
POSITION = "__position"


def statement_key(text: str, args: dict) -> str:
    """Name of a result: a digest of the statement without its ends' white space, and of the parameters with their types."""
    known = [text.strip().rstrip(";").rstrip(), sorted((k, type(v).__name__, repr(v)) for k, v in args.items())]
    return hashlib.sha256(json.dumps(known).encode()).hexdigest()


def _roots(plan) -> set[str]:
    """Root folders of all files that an analysed plan reads; any other input is named by its kind."""
    found, below = set(), plan.subqueriesAll()
    for tree in [plan, *(below.apply(i) for i in range(below.size()))]:
        leaves = tree.collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            kind = leaf.getClass().getSimpleName()
            if kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
                roots = leaf.relation().location().rootPaths()
                found |= {roots.apply(i).toString() for i in range(roots.size())}
            elif kind not in ("OneRowRelation", "LocalRelation", "Range", "CTERelationRef"):
                found.add(kind)
    return found


def cached_sql(spark: SparkSession, out_path: str, text: str, **args) -> DataFrame:
    """S5 over the current tables of ``out_path``; the second call reads the first one's result, and no table.

    Values are bound as named parameters. The statement sees the views of ``open_tables`` in a session of
    its own. Rows keep the order of an outer ORDER BY. Tables that were written without versions, and
    statements that don't qualify (see above), are answered without storing anything. Two callers that miss at once both store;
    either result serves.
    """
    number, folder = version_of(spark, out_path)
    name = folder.rpartition("/")[2]
    key = statement_key(text, args)
    store = f"{out_path.rstrip('/')}/{RESULTS}/{name}"
    if number:
        for found in sorted(n for n in _names(spark, store) if n.startswith(key)):
            if "_SUCCESS" in _names(spark, f"{store}/{found}"):
                return _ordered(spark.read.parquet(f"{store}/{found}"))
    own = spark.newSession()
    tables = open_tables(own, out_path, folder)
    df = sql(own, text, **args)
    plan = df._jdf.queryExecution()
    known = set().union(*(_roots(t._jdf.queryExecution().analyzed()) for t in tables.values()))
    if not number or VARYING.search(text) or not plan.analyzed().deterministic() or not known.issuperset(_roots(plan.analyzed())):
        return df
    if not plan.optimizedPlan().outputOrdering().isEmpty():
        df = df.withColumn(POSITION, F.monotonically_increasing_id())
    path = f"{store}/{key}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return _ordered(spark.read.parquet(path))


def _ordered(df: DataFrame) -> DataFrame:
    return df.orderBy(POSITION).drop(POSITION) if POSITION in df.columns else df
