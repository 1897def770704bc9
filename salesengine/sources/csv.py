"""S1/S2 — raw transaction CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import MISSING_TOKENS, RAW_COLUMNS, RAW_SALES, WIDE
from ..session import released
from .records import INSIDE, SWAP, read_records, step_of

# Order columns appended by read_sales; they give "first row wins" a meaning
# on a distributed scan (file, then block, then position inside the task).
CSV_ORDER_COLUMNS = ["_file", "_block", "_pos"]


def _number(c):
    """A text cell as a number of WIDE, null if it is none."""
    return c.try_cast(WIDE)


def _typed(c, kind):
    """A text cell as ``kind``: whole numbers and flags may be written as floats
    (``3.0``, ``0.0``), as writers do for a column with a missing value."""
    if kind == T.IntegerType():
        n = _number(c)
        return F.when(n == F.floor(n), n.try_cast("int"))
    if kind == T.BooleanType():
        return F.coalesce(c.try_cast("boolean"), _number(c) != 0)
    return _number(c)


#: Columns that ``checked_sales`` adds: what is wrong with the record, its text, and the columns that lost a value.
PROBLEM, RECORD, LOST = "_problem", "_record", "_lost"
TOO_MANY, TOO_FEW, OPEN_QUOTE = "too_many_fields", "too_few_fields", "open_quote"
#: Records with these problems are no rows of the table; a record with too few fields is one, its last cells null.
REJECTED = (TOO_MANY, OPEN_QUOTE)
#: RFC 4180 quoting, as CSV writers like pandas produce it: a quote inside a quoted field is doubled
#: (Spark's default escape is "\\").
_OPTIONS = {"mode": "PERMISSIVE", "nullValue": "", "escape": '"'}
_CORRUPT = "_corrupt"


def header_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names of the first file."""
    names = spark.read.options(**_OPTIONS).option("header", True).csv(path).columns
    absent = [c for c in RAW_COLUMNS if c not in names]
    if absent:
        raise ValueError(f"{path}: no column {', '.join(absent)}")
    return names


def _cells(names: list[str]) -> T.StructType:
    return T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField(_CORRUPT, T.StringType())])


def _cells_of_lines(spark: SparkSession, path: str | list[str], multi_line: bool, problems: bool = False) -> DataFrame:
    """Text cells, record text if it has not the header's number of fields, and order columns, by Spark's own reader."""
    df = (
        spark.read.options(**_OPTIONS)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", not problems)  # a pruned parse doesn't see the number of fields
        .schema(_cells(header_of(spark, path)))
        .csv(path)
    )
    return df.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
                           "_pos": F.monotonically_increasing_id(), "_open": F.lit(False)})


def _cells_of_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same from ``read_records``, so that line breaks in quotes don't cost the parallel read of a file."""
    names = header_of(spark, path)
    kind = _cells(names)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in kind.fields)
    parsed = F.from_csv("text", ddl, {**_OPTIONS, "multiLine": "true", "columnNameOfCorruptRecord": _CORRUPT}).alias("c")
    # an open record counts once, by its first piece, and its cells are not read
    rows = read_records(spark, path).where("first").select(
        F.col("number").alias("_file"), F.col("block").alias("_block"), F.col("pos").alias("_pos"), F.col("open").alias("_open"), "text", parsed)
    same = F.lit(True)
    for n in names:
        same = same & F.col("c").getField(n).eqNullSafe(F.lit(n))
    other = F.raise_error(F.concat(F.lit("a file's header differs from the first one's: "), "text")).cast("boolean")
    header = (F.col("_block") == 0) & (F.col("_pos") == 0)
    data = rows.where(F.when(header, F.when(same, F.lit(False)).otherwise(other)).otherwise(F.lit(True)))
    cells = [F.when(~F.col("_open"), F.col("c").getField(n)).alias(n) for n in names]
    corrupt = F.when(F.col("_open"), F.col("text")).otherwise(F.col("c").getField(_CORRUPT)).alias(_CORRUPT)
    return data.select(*cells, corrupt, "_file", "_block", "_pos", "_open")


def _typed_columns() -> list:
    """RAW_SALES columns from text cells: missing tokens become null in every column (text too), then each column is
    ``try_cast`` to its type, so a malformed number is null for that cell only and never fails the job."""
    cols = []
    for f in RAW_SALES.fields:
        c = F.col(f.name)
        if f.dataType == T.StringType():
            c = F.when(~c.isin(*MISSING_TOKENS), c)
        else:
            # No missing token parses as a number or a boolean, and the cast
            # trims surrounding whitespace itself, so try_cast alone maps
            # tokens, blanks and malformed cells to null.
            c = _typed(c, f.dataType)
        cols.append(c.alias(f.name))
    return cols


def checked_sales(spark: SparkSession, path: str | list[str], multi_line: bool = False, quoted_breaks: bool = False) -> DataFrame:
    """S1 with its losses: ``read_sales`` of every record, beside order columns, PROBLEM, RECORD and LOST.

    PROBLEM is null for a record with the header's number of fields, else TOO_MANY, TOO_FEW, or OPEN_QUOTE where a quoted
    field doesn't end (without ``multi_line`` or ``quoted_breaks``: in its line; with ``quoted_breaks``: in its
    file). RECORD is the record's text where there is a problem (at most its first PIECE bytes if it is open
    to the end of a file). LOST lists the columns whose cell holds a value that its type can't take.
    """
    cells = _cells_of_records(spark, path) if quoted_breaks else _cells_of_lines(spark, path, multi_line, problems=True)
    text = F.col(_CORRUPT)
    names = [c for c in cells.columns if c not in (_CORRUPT, "_file", "_block", "_pos", "_open")]
    outside = F.regexp_replace(text, '(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    fields = F.char_length(outside) - F.char_length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    problem = (F.when(F.col("_open") | step_of(text).isin(SWAP, INSIDE), OPEN_QUOTE).when(fields > len(names), TOO_MANY).otherwise(TOO_FEW))
    lost = []
    for f, c in zip(RAW_SALES.fields, _typed_columns()):
        if f.dataType != T.StringType():
            cell = F.col(f.name)
            lost.append(F.when(c.isNull() & (F.trim(cell) != "") & ~F.trim(cell).isin(*MISSING_TOKENS), F.lit(f.name)))
    return cells.select(*_typed_columns(), *CSV_ORDER_COLUMNS, F.when(text.isNotNull(), problem).alias(PROBLEM), text.alias(RECORD),
                        F.array_compact(F.array(*lost)).alias(LOST))


def accepted(checked: DataFrame) -> DataFrame:
    """The rows of ``checked_sales`` that are rows of the table, as ``read_sales`` gives them."""
    return checked.where(F.col(PROBLEM).isNull() | ~F.col(PROBLEM).isin(*REJECTED)).select(*RAW_COLUMNS, *CSV_ORDER_COLUMNS)


def quarantined(checked: DataFrame) -> DataFrame:
    """(PROBLEM, LOST, RECORD, transaction_id, order columns) of the records with a problem or a lost value."""
    return checked.where(F.col(PROBLEM).isNotNull() | (F.size(LOST) > 0)).select(PROBLEM, LOST, RECORD, RAW_COLUMNS[0], *CSV_ORDER_COLUMNS)


def loss_counts(checked: DataFrame, accepted_rows: DataFrame | None = None) -> DataFrame:
    """(what, column_name, n): records in all (``records``), without a problem (``sound``), with each problem, and of the
    accepted ones the cells of each typed column that hold a value it can't take (``lost_value``).

    ``records`` is the sum of ``sound`` and the three problems. ``checked`` is ``checked_sales``, or, with the number
    of accepted records as the one value of ``accepted_rows``, the ``quarantined`` part of it alone. One aggregate, of
    one row a task.
    """
    problem = F.col(PROBLEM)
    kept = problem.isNull() | ~problem.isin(*REJECTED)
    typed = [f.name for f in RAW_SALES.fields if f.dataType != T.StringType()]
    counted = checked.agg(
        F.count_if(kept).alias("accepted"), *[F.count_if(problem == p).alias(p) for p in (TOO_MANY, TOO_FEW, OPEN_QUOTE)],
        *[F.count_if(kept & F.array_contains(LOST, c)).alias(c) for c in typed])
    if accepted_rows is not None:
        known = accepted_rows.select(F.coalesce(F.col(accepted_rows.columns[0]), F.lit(0)).cast("long").alias("accepted"))
        both = counted.drop("accepted").unionByName(known, allowMissingColumns=True)
        counted = both.agg(*[F.sum(c).alias(c) for c in both.columns])
    accepted_, sound = F.col("accepted"), F.col("accepted") - F.col(TOO_FEW)
    rows = [("records", None, accepted_ + F.col(TOO_MANY) + F.col(OPEN_QUOTE)), ("sound", None, sound)]
    rows += [(p, None, F.col(p)) for p in (TOO_MANY, TOO_FEW, OPEN_QUOTE)] + [("lost_value", c, F.col(c)) for c in typed]
    return counted.select(F.inline(F.array(*[F.struct(F.lit(w).alias("what"), F.lit(c).cast("string").alias("column_name"), n.alias("n")) for w, c, n in rows])))


def read_sales(spark: SparkSession, path: str | list[str], with_order: bool = True, multi_line: bool = False, quoted_breaks: bool = False) -> DataFrame:
    """CSV with header -> DataFrame with the columns of RAW_SALES, numbers in WIDE.

    Columns are taken by the header's names, in any order and beside others; an
    absent one is an error, and so is a file whose header differs from the first
    file's. Line breaks inside quoted fields need ``quoted_breaks``, which reads the
    splits of a file in parallel (``records.read_records``; the header must be one line), or ``multi_line``, one task a
    file; without either such a record comes in as broken rows. Records with too many
    fields lose the last, those with too few have nulls; ``checked_sales`` tells which.

    Every cell is read as text, then typed (``_typed_columns``).
    No schema inference (that would be an extra pass over the data).
    """
    cells = _cells_of_records(spark, path).where("NOT _open") if quoted_breaks else _cells_of_lines(spark, path, multi_line)
    return cells.select(*_typed_columns(), *(CSV_ORDER_COLUMNS if with_order else []))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Header, no index column, one folder of part files; quotes inside
    quoted fields are doubled, so ``read_sales`` reads the files back. A compressed
    file is read by one task, so it should be no larger than a split."""
    with released(df.sparkSession):
        df.write.mode(mode).option("header", True).option("escape", '"').option("compression", compression).csv(path)
