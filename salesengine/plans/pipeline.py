"""The batch job: read -> clean -> write fact table -> rollup -> summaries.

Reports never re-run the cleaning: they read the written tables (the
partitioned Parquet fact table, or the sales rollup), with column pruning,
pushed filters and partition pruning. The written tables also cut the
lineage, so a lost executor during a report recomputes from Parquet, not from
the raw input and the dedupe shuffle.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import OK, STATUS, clean_with_status, status_counts
from ..operators.rollup import product_rollup, sales_rollup
from ..session import new_table_path, sized_for, sized_session
from ..sources.domains import DOMAINS, read_domains, write_domains
from ..sources.csv import CSV_ORDER_COLUMNS, accepted, checked_sales, loss_counts, quarantined, read_sales
from ..sources.scan import input_bytes, spread
from ..sources.tables import SUMMARY_TABLES, read_sales_table, read_staged, write_jdbc, write_staged, write_summaries, write_table
from ..sources.testdata import ORDER_COLUMNS as STAR_ORDER_COLUMNS
from ..sources.testdata import raw_sales_from_star
from ..sources.versions import VERSIONS, commit, new_version, remove


@dataclass
class RunResult:
    sales: DataFrame
    sales_path: str
    summary_paths: dict[str, str]
    quality: DataFrame | None
    rollup: DataFrame | None = None
    rollup_path: str | None = None
    products: DataFrame | None = None
    products_path: str | None = None
    folder: str | None = None
    losses: DataFrame | None = None


def run(spark: SparkSession, raw_path: str | list[str], out_path: str, quality: bool = True, multi_line: bool = False,
        jdbc_url: str | None = None, jdbc_properties: dict[str, str] | None = None, quoted_breaks: bool = False,
        quarantine: bool = False, versioned: bool = False) -> RunResult:
    """Full job over raw CSV files (the reference's extract/transform/load).

    One pass over the raw input writes ``staged``: the first row of every
    transaction id, partitioned by data-quality status and year/month. Its
    ``dq_status=ok`` directory is the fact table; the rejected rows sit
    beside it. Then ``sales_rollup``, ``product_rollup`` and the three
    summary tables are written (from the rollups, so after the fact table is
    written it is scanned only by the two rollups). ``quality`` returns the
    T11 counters as a lazy DataFrame over the staged table's status and copy
    columns: no second pass over the raw input, and exact under task retries
    (a real aggregation over written data, not accumulator metrics). With
    ``jdbc_url`` the fact table and the summaries also replace the tables of their
    names in that database.

    ``quoted_breaks`` reads line breaks inside quoted fields without giving up the parallel read of a file.
    ``quarantine`` keeps records with too many fields or an open quote out of the tables, writes them and what
    else is lost to ``quarantine`` (a second, narrow pass over the raw input), and returns the counts as ``losses``.
    With ``versioned`` the tables go to a folder of their own, and readers (``open_tables``) see
    them all from the moment this run ends (``sources.versions``).
    """
    base = new_version(spark, out_path) if versioned else out_path.rstrip("/")
    staged_path = f"{base}/staged"
    # The order columns are fixed by the scan; spreading afterwards only
    # matters for unsplittable input (e.g. one large gzip file).
    with sized_for(spark, input_bytes(spark, raw_path)):
        if quarantine:
            checked = checked_sales(spark, raw_path, multi_line=multi_line, quoted_breaks=quoted_breaks)
            raw = spread(accepted(checked))
        else:
            raw = spread(read_sales(spark, raw_path, multi_line=multi_line, quoted_breaks=quoted_breaks))
        sales_path = write_staged(clean_with_status(raw, CSV_ORDER_COLUMNS), staged_path)
        if quarantine:
            write_table(quarantined(checked), f"{base}/quarantine")
    sales = read_sales_table(spark, sales_path)
    rollup, products, paths = write_reports(sales_rollup(sales), product_rollup(sales), base)
    if versioned:
        commit(spark, out_path, base)
    if jdbc_url is not None:
        write_jdbc(sales, jdbc_url, "sales", jdbc_properties)
        for name, path in paths.items():
            write_jdbc(spark.read.parquet(path), jdbc_url, name, jdbc_properties)
    staged = read_staged(spark, staged_path)
    q = status_counts(staged) if quality else None
    losses = loss_counts(spark.read.parquet(f"{base}/quarantine"), status_counts(staged).select("raw_rows")) if quarantine else None
    return RunResult(sales, sales_path, paths, q, rollup, f"{base}/sales_rollup", products, f"{base}/product_rollup", base, losses)


def write_reports(rollup: DataFrame, products: DataFrame, base: str) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Writes the rollups, the domain dictionary and the summaries of one set; (rollup, products, summary paths) as written."""
    spark = rollup.sparkSession
    paths = f"{base}/sales_rollup", f"{base}/product_rollup"
    write_table(rollup, paths[0])
    write_table(products, paths[1])
    rollup, products = (spark.read.parquet(p) for p in paths)
    write_domains(rollup, f"{base}/{DOMAINS}")
    return rollup, products, write_summaries(None, base, rollup=rollup, products=products)


# --- tables for the star-schema test tables -------------------------------------
_lock = threading.RLock()
_written: dict[tuple[str, str, str], str] = {}
_tables: dict[str, DataFrame] = {}


#: Bytes of a raw row as text for each byte of the line items' files.
TEXT_FACTOR = 8


def star_raw(spark: SparkSession, sf_dir: str, together: bool = False) -> tuple[DataFrame, list[str]]:
    """The raw view (``together``: copies of a transaction id in one partition) and its order columns; its session has shuffle
    partitions by the size of the line items."""
    sized = sized_session(spark, TEXT_FACTOR * input_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet"))
    return raw_sales_from_star(sized, sf_dir, together), list(STAR_ORDER_COLUMNS)


def _shared(spark: SparkSession, path: str, read) -> DataFrame:
    """One DataFrame per written table, shared by every report: its file index
    (the listing of all its directories) is built once, not per query."""
    with _lock:
        df = _tables.get(path)
        if df is None or df.sparkSession is not spark:
            df = _tables[path] = read(spark, path)
    return df


def fact_table(spark: SparkSession, path: str) -> DataFrame:
    return _shared(spark, path, read_sales_table)


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple[str, str, str]:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)


def star_staged(spark: SparkSession, sf_dir: str) -> str:
    """Path of the staged table (all first-per-key rows by status), written once per application; its folder is that
    of a set, which ``star_set`` completes and commits.

    The first rows by key are written as they come out of the dedupe and read back for the months' shuffle, so that the shuffle files of the
    joins and the dedupe are gone by then; that table is dropped at the end.
    """
    with _lock:
        path = _written.get(_key(spark, sf_dir, "staged"))
        if path is None:
            raw, order = star_raw(spark, sf_dir, together=True)
            path, first = f"{new_version(spark, new_table_path(spark, 'set'))}/staged", new_table_path(spark, "first")
            cleaned = clean_with_status(raw, order)
            write_table(cleaned, first)
            write_staged(raw.sparkSession.read.schema(cleaned.schema).parquet(first), path)
            remove(spark, first)
            _written[_key(spark, sf_dir, "staged")] = path
    return path


def star_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned fact table for a test-table folder, written once per
    application to the shared work folder and read back for every report."""
    with _lock:
        path = _written.get(_key(spark, sf_dir, "sales"))
        if path is None:
            path = f"{star_staged(spark, sf_dir)}/{STATUS}={OK}"
            _written[_key(spark, sf_dir, "sales")] = path
    return fact_table(spark, path)


def star_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales rollup of ``star_sales`` and its domain dictionary, written once per application."""
    with _lock:
        path = _written.get(_key(spark, sf_dir, "rollup"))
        if path is None:
            path = new_table_path(spark, "rollup")
            write_table(sales_rollup(star_sales(spark, sf_dir)), path)
            write_domains(spark.read.parquet(path), f"{path}-{DOMAINS}")
            _written[_key(spark, sf_dir, "rollup")] = path
    return _shared(spark, path, lambda sp, p: sp.read.parquet(p))


def domains_of(rollup: DataFrame) -> dict[str, list[str]] | None:
    """The dictionary written beside a ``star_rollup``, read without a job; None for any other frame."""
    with _lock:
        path = next((p for p, df in _tables.items() if df is rollup), None)
    return path and read_domains(rollup.sparkSession, f"{path}-{DOMAINS}")


def star_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product rollup of ``star_sales``, written once per application."""
    with _lock:
        path = _written.get(_key(spark, sf_dir, "products"))
        if path is None:
            path = new_table_path(spark, "products")
            write_table(product_rollup(star_sales(spark, sf_dir)), path)
            _written[_key(spark, sf_dir, "products")] = path
    return _shared(spark, path, lambda sp, p: sp.read.parquet(p))


def star_summaries(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Paths of the three summary tables by name, written once per application."""
    rollup, products = star_rollup(spark, sf_dir), star_products(spark, sf_dir)
    with _lock:
        base = _written.get(_key(spark, sf_dir, "summaries"))
        if base is None:
            base = new_table_path(spark, "summaries")
            write_summaries(None, base, rollup=rollup, products=products)
            _written[_key(spark, sf_dir, "summaries")] = base
    return {name: f"{base}/{name}" for name in SUMMARY_TABLES}


def star_set(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a versioned set of the star tables, committed once per application: the staged table where it lies, and its rollups."""
    with _lock:
        base = _written.get(_key(spark, sf_dir, "set"))
        if base is None:
            folder = star_staged(spark, sf_dir).rpartition("/")[0]
            base = folder.rpartition(f"/{VERSIONS}/")[0]
            write_reports(star_rollup(spark, sf_dir), star_products(spark, sf_dir), folder)
            commit(spark, base, folder)
            _written[_key(spark, sf_dir, "set")] = base
    return base
