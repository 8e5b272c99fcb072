"""Tables on disk: CSV as the sales data comes, Parquet for large star schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallystar.sources.records import csv_records
from tallystar.sources.scratch import pin
from tallystar.sources.types_of_text import typed, types_of

# Quotes inside a quoted field are doubled, as spreadsheet and pandas writers do it.
_CSV = {"header": True, "escape": '"'}
# A row that does not fit its schema stops the read: one with too few or too many fields also if few columns are asked for.
_STRICT = {"mode": "FAILFAST", "columnPruning": "false"}


# What the reader puts for a field with nothing between its commas, before it becomes null: no text, so that "" stays one.
_NO_TEXT = "\x00"


def _declared(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    line_breaks: bool = False,
    line_end: str | None = None,
) -> DataFrame:
    """A headered CSV file or folder. Blanks at either end of a field are kept.

    ``schema`` declares the columns by name, in any order and any case; they come out in
    its order. A column that is missing or not declared, a file whose
    header differs from the first one's, and a row that does not fit stop the read. Without ``schema`` the types
    are inferred, which reads the whole input once more. Quoted fields that hold line breaks need ``line_breaks``,
    which reads each file in one task (``read_records`` uses many). ``line_end`` is given for files of ``write_csv``: ends of lines within fields
    then stay as they are, and a quoted empty field is an empty text, not null.
    """
    options = {**_CSV, **_STRICT, "multiLine": line_breaks}
    if line_end is not None:
        options |= {"lineSep": line_end, "nullValue": _NO_TEXT}
    if schema is None:
        return spark.read.options(**options).csv(path, inferSchema=True)
    wanted = _declared(spark, schema)
    there = _in_header_order(path, spark.read.options(**(options | {"mode": "PERMISSIVE"})).csv(path).columns, wanted)
    read = spark.read.options(**options).csv(path, schema=there, enforceSchema=False)
    return read.select(*[F.col(f"`{f.name}`") for f in wanted])


def _in_header_order(path: str, header: list[str], wanted: StructType) -> StructType:
    by_name = {f.name.lower(): f for f in wanted}
    missing = [f.name for f in wanted if f.name.lower() not in {c.lower() for c in header}]
    extra = [c for c in header if c.lower() not in by_name]
    if missing or extra or len(header) != len(wanted):
        raise ValueError(f"{path}: columns missing: {missing}; not declared: {extra}; header: {header}")
    return StructType([by_name[c.lower()] for c in header])


#: Of a row that does not fit its schema: the file, the line where it begins, and its text.
REJECTED = ["file", "line", "record"]
_BAD = "__record that does not fit"


def read_records(spark: SparkSession, path: str, schema: StructType | str | None = None, reject: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """``read_csv`` for fields that hold line breaks, a file read by many tasks; and with ``reject`` the rows that do not fit.

    Without ``schema`` all columns are text. With ``reject`` the rows are parsed once, to a pinned
    table: those that do not fit are in the second frame (``REJECTED``), the others in the first. Without it they stop the read. A
    file whose header differs from the first one's stops the read in any case, as then no row of it can be trusted.
    """
    header = spark.read.options(**_CSV, multiLine=True).csv(path).columns
    wanted = StructType([StructField(c, StringType()) for c in header]) if schema is None else _declared(spark, schema)
    there = _in_header_order(path, header, wanted)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _CSV.items()} | {"multiLine": "true"}
    records = csv_records(spark, path)

    names = F.from_csv("record", ", ".join(f"_{i} STRING" for i in range(len(header))), options | {"mode": "FAILFAST"})
    same = F.lower(F.to_json(names)) == F.lower(F.to_json(F.struct(*[F.lit(c).alias(f"_{i}") for i, c in enumerate(header)])))
    told = F.concat(F.lit("another header in "), F.col("file"), F.lit(": "), F.col("record"))
    is_row = F.when(F.col("line") > 1, True).when(same, False).otherwise(F.raise_error(told).cast("boolean"))
    rows = records.where(is_row)

    def ddl(fields: StructType) -> str:
        return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)

    columns = [F.col(f"row.`{f.name}`").alias(f.name) for f in wanted]
    if not reject:
        return rows.select(F.from_csv("record", ddl(there), options | {"mode": "FAILFAST"}).alias("row")).select(*columns), None
    lenient = options | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = rows.select("file", "line", F.from_csv("record", f"{ddl(there)}, `{_BAD}` STRING", lenient).alias("row"))
    bad = F.col(f"row.`{_BAD}`")
    kept = pin(parsed.select(F.struct(*columns).alias("row"), F.when(bad.isNotNull(), F.struct("file", "line", bad.alias("record"))).alias("bad")))
    return kept.where("bad IS NULL").select("row.*"), kept.where("bad IS NOT NULL").select("bad.*")


def read_source(
    spark: SparkSession, path: str, schema: StructType | str | None = None, line_breaks: bool = False, reject: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """A CSV source pinned as columns, its text parsed once; and with ``reject`` the rows that do not fit (``read_records``).

    Without ``schema`` the columns are pinned as text, and the types they all fit come from that copy; then a row is rejected for its
    number of fields only.
    """
    rejected = None
    if line_breaks or reject:
        rows, rejected = read_records(spark, path, schema, reject)
    elif schema is None:
        header = spark.read.options(**_CSV).csv(path).columns
        rows = read_csv(spark, path, StructType([StructField(c, StringType()) for c in header]))
    else:
        rows = read_csv(spark, path, schema)
    rows = rows if reject else pin(rows)
    return (rows if schema is not None else typed(rows, types_of(rows))), rejected


def write_csv(df: DataFrame, path: str, codec: str | None = None) -> None:
    """Write ``df`` as a folder of headered CSV files, each by the task that holds the rows.

    With ``codec`` (such as gzip) the files are compressed, and named so; readers see that by the name.
    """
    df.write.mode("overwrite").csv(
        path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, lineSep="\n", compression=codec, **_CSV
    )


def table_path(folder: str, name: str, fmt: str) -> str:
    """Where table ``name`` lies: a folder, or a single file that another program wrote."""
    return f"{folder}/{name}.{fmt}"


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str | None = None,
    line_breaks: bool = False,
    line_end: str | None = None,
) -> DataFrame:
    """A table in format ``csv`` or ``parquet``."""
    if fmt == "csv":
        return read_csv(spark, path, schema, line_breaks, line_end)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(path)


def read_written(spark: SparkSession, path: str, fmt: str, schema: StructType | str | None = None) -> DataFrame:
    """A table that ``write_table`` wrote, with line breaks in fields and all.

    Each of its files is what one task wrote, so a file per task is no burden.
    """
    return read_table(spark, path, fmt, schema, line_breaks=True, line_end="\n")


def write_table(df: DataFrame, path: str, fmt: str, codec: str | None = None) -> None:
    """Write a table in format ``csv`` or ``parquet``, replacing what is there; the ``codec`` is the format's own if not given."""
    if fmt == "csv":
        write_csv(df, path, codec)
    else:
        df.write.mode("overwrite").format(fmt).options(**({"compression": codec} if codec else {})).save(path)
