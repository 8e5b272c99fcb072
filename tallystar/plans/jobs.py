"""The two jobs: wide sales table to star schema, star schema to reports.

    spark-submit run_job.py star sales.csv output
    spark-submit run_job.py reports output output-reports --year 2011

Every table is a folder of files named after it, such as time_dim.csv; those of a star lie in the folder of its
version, which the newest file of output/manifests names.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Collection, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystar.operators.surrogate import dense_surrogate_key
from tallystar.plans import reports
from tallystar.plans.layout import StarLayout
from tallystar.plans.star import (
    distinct_rows,
    inventory_fact,
    product_rows,
    repeated_keys,
    sales_without_date,
    time_dimension,
)
from tallystar.session import PARTITION_BYTES, fit_shuffles, prepare
from tallystar.sources.scratch import at_once, pin, scratch_of_job
from tallystar.sources.tables import read_source, read_table, read_written, table_path, write_csv, write_table
from tallystar.sources.versions import Version, current

# The year, the category and the number of customers the reports show.
YEAR = 2011
CATEGORY = 4005
TOP_CUSTOMERS = 10

Schema = StructType | str


# Rows the star leaves out or that will count more than once, by table.
CHECKS = "star_checks"
IDS = {
    "time_dim": "TIME_DIM_ID",
    "inventory_fact": "FACT_ID",
    "customers_dim": "CUSTOMER_DIM_ID",
    "products_dim": "PRODUCT_DIM_ID",
    "sellers_dim": "SELLER_DIM_ID",
    "transaction_dim": "TRANSACTION_DIM_ID",
}


def build_star(
    source: DataFrame,
    out: str,
    layout: StarLayout = StarLayout(),
    fmt: str = "csv",
    lenient_dates: bool = False,
    only: Collection[str] = tuple(IDS),
    rejected: DataFrame | None = None,
    codec: str | None = None,
) -> dict[str, StructType]:
    """Write the five dimensions and the fact as a new version of the star in ``out``; gives the schema of each table written.

    Readers see the new tables all at once, when the last is written (``sources.versions``); if the job fails they keep the old
    ones. With ``only`` some tables are rebuilt and the others stay as they are. The fact refers to the ids of the time table, so the
    one is never rebuilt without the other.

    Also written, unless ``only`` some of the tables are asked
    for, is ``star_checks``: how many distinct sales have no date and so are in no fact, and how many
    natural keys have several rows in their dimension, which multiplies their sales; and, if the rows that were ``rejected`` when the
    source was read are given, how many there are.

    ``codec`` compresses the files of the tables; a CSV star is plain text without. Its files are read whole in any case.

    The six tables read different columns of ``source``. Parquet lets each read
    only its own, so pass a Parquet frame, or pin a CSV first: otherwise its text
    is parsed six times, and once more to learn how many sales there are.
    """
    spark = source.sparkSession
    version = Version(spark, out)
    wanted = set(only)
    if "inventory_fact" in wanted or "time_dim" in wanted and "inventory_fact" in version.before.tables:
        wanted |= {"inventory_fact", "time_dim"}
    dimensions = {"customers_dim": layout.customer, "products_dim": layout.product, "sellers_dim": layout.seller, "transaction_dim": layout.transaction}

    def write(name: str, made: DataFrame) -> None:
        write_table(made, version.add(name, fmt, made.schema).path, fmt, *([codec] if codec else []))

    def written(name: str) -> DataFrame:
        there = version.added[name]
        return read_written(spark, there.path, fmt, there.schema)

    def write_dated() -> None:
        if "time_dim" in wanted:
            write("time_dim", time_dimension(source, layout.date, layout.date_format, lenient=lenient_dates))
        if "inventory_fact" in wanted:
            with scratch_of_job(spark):
                hold = partial(pin, codec="zstd")
                write("inventory_fact", inventory_fact(source, written("time_dim"), layout.fact, layout.date, rows=source.count(), hold=hold))

    def write_dimension(name: str) -> DataFrame:
        """Gives the rows without their ids, as a pinned table, which also tells how many there are."""
        made = pin(product_rows(source, layout.product, layout.stock) if name == "products_dim" else distinct_rows(source, dimensions[name]))
        write(name, dense_surrogate_key(made, IDS[name], dimensions[name], made.count()))
        return made

    try:
        with scratch_of_job(spark):
            # The fact takes most disk by far, so it is written before the dimensions, which are made beside each other.
            write_dated()
            names = [name for name in dimensions if name in wanted]
            made = at_once(*[partial(write_dimension, name) for name in names]) if names else []
            schemas = {name: version.added[name].schema for name in IDS if name in wanted}
            if set(IDS) <= wanted:
                checks = [sales_without_date(source, layout.fact, layout.date).select(F.lit("inventory_fact").alias("TABLE"), F.lit("undated sales").alias("CHECK"))]
                checks += [repeated_keys(rows, dimensions[n][0]).select(F.lit(n).alias("TABLE"), F.lit("repeated keys").alias("CHECK")) for n, rows in zip(names, made, strict=True)]
                named = [("inventory_fact", "undated sales"), *((n, "repeated keys") for n in dimensions)]
                if rejected is not None:
                    named.append(("source", "rejected rows"))
                    checks.append(rejected.select(F.lit("source").alias("TABLE"), F.lit("rejected rows").alias("CHECK")))
                all_checks = spark.createDataFrame(named, "TABLE string, CHECK string")
                counts = reduce(DataFrame.unionByName, checks).groupBy("TABLE", "CHECK").agg(F.count(F.lit(1)).alias("ROWS"))
                report = all_checks.join(counts, ["TABLE", "CHECK"], "left").select("TABLE", "CHECK", F.coalesce("ROWS", F.lit(0)).alias("ROWS"))
                write(CHECKS, report.orderBy("TABLE"))
        version.publish()
    except BaseException:
        version.discard()
        raise
    return schemas


def stored_schemas(spark: SparkSession, star: str) -> dict[str, StructType]:
    """The schemas of the tables of a star that ``build_star`` wrote; none for a star of another origin."""
    return {name: there.schema for name, there in current(spark, star).tables.items() if name in IDS}


def read_star(spark: SparkSession, star: str, name: str, fmt: str = "csv", schema: Schema | None = None) -> DataFrame:
    """Table ``name`` of a star: as the newest version has it, or what lies in the folder if another program wrote the star."""
    return _reader(spark, star, fmt, {} if schema is None else {name: schema})(name)


def _reader(spark: SparkSession, star: str, fmt: str, schemas: Mapping[str, Schema]) -> Callable[[str], DataFrame]:
    """Reads tables of one and the same version, also while a new one is built."""
    manifest = current(spark, star)

    def read(name: str) -> DataFrame:
        there = manifest.tables.get(name)
        if there is not None:
            return read_written(spark, there.path, there.fmt, schemas.get(name, there.schema))
        return read_written(spark, table_path(star, name, fmt), fmt, schemas.get(name))

    return read


def run_reports(
    spark: SparkSession,
    star: str,
    out: str,
    year: int = YEAR,
    category: int | str | None = CATEGORY,
    k: int = TOP_CUSTOMERS,
    fmt: str = "csv",
    schemas: Mapping[str, Schema] | None = None,
) -> dict[str, DataFrame]:
    """Write the five reports as CSV below ``out``; gives them as frames that read what was written.

    The star is the newest version of ``build_star``, whose manifest says format and types; or one of another origin in format
    ``fmt``, with types from ``schemas`` or inferred. Tables of a CSV star that several reports
    read are parsed once, and the fact is passed over twice for all five. Sellers take no part in any report and are not read.
    """
    stored = current(spark, star).tables
    read = _reader(spark, star, fmt, schemas or {})

    def table(name: str, often: bool = True) -> DataFrame:
        text = (stored[name].fmt if name in stored else fmt) == "csv"
        return pin(read(name)) if often and text else read(name)

    with scratch_of_job(spark):
        often = ["inventory_fact", "customers_dim", "time_dim", "transaction_dim"]
        fact, customers, time, transactions = at_once(*[partial(table, name) for name in often])
        results = reports.all_reports(fact, customers, time, table("products_dim", often=False), transactions, year, category, k)
        at_once(*[partial(write_csv, report, table_path(out, name, "csv")) for name, report in results.items()])
    return {name: read_written(spark, table_path(out, name, "csv"), "csv", report.schema) for name, report in results.items()}


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallystar")
    jobs = parser.add_subparsers(dest="job", required=True)
    star = jobs.add_parser("star", help="build the star schema")
    star.add_argument("source")
    star.add_argument("out")
    star.add_argument("--source-format", choices=["csv", "parquet"], default="csv")
    star.add_argument("--source-schema", help="DDL of a CSV source; inferred if not given")
    star.add_argument("--line-breaks", action="store_true", help="fields of a CSV source may hold line breaks")
    star.add_argument("--rejects", metavar="DIR", help="write rows of a CSV source that do not fit here, with file and line, and go on without them")
    star.add_argument("--codec", help="compresses the files of the star, such as gzip for CSV")
    star.add_argument("--lenient-dates", action="store_true", help="unreadable dates become null")
    report = jobs.add_parser("reports", help="run the reports")
    report.add_argument("star")
    report.add_argument("out")
    report.add_argument("--year", type=int, default=YEAR)
    report.add_argument("--category", default=str(CATEGORY), help="a category, or 'all'")
    report.add_argument("--top", type=int, default=TOP_CUSTOMERS)
    for job in (star, report):
        job.add_argument("--format", choices=["csv", "parquet"], default="csv", help="of the star; reports of a star built here need not say it")
        job.add_argument("--split-bytes", type=int, help="input a task reads; the session's setting if not given")
        job.add_argument("--partition-bytes", type=int, default=PARTITION_BYTES, help="input per shuffle partition")
    given = parser.parse_args(args)

    spark = prepare(SparkSession.builder.appName("tallystar").getOrCreate())
    sizes = given.split_bytes, given.partition_bytes
    if given.job == "star":
        with scratch_of_job(spark):
            rejected = None
            if given.source_format == "csv":
                fit_shuffles(spark.read.text(given.source), *sizes)
                source, rejected = read_source(spark, given.source, given.source_schema, given.line_breaks, given.rejects is not None)
                if rejected is not None:
                    write_csv(rejected, given.rejects)
            else:
                source = read_table(spark, given.source, given.source_format)
                fit_shuffles(source, *sizes)
            build_star(source, given.out, fmt=given.format, lenient_dates=given.lenient_dates, rejected=rejected, codec=given.codec)
    else:
        category = None if given.category == "all" else given.category
        # Only the splits count here, and one declared column spares inferring the types.
        stored = current(spark, given.star).tables.get("inventory_fact")
        path, fmt = (stored.path, stored.fmt) if stored else (table_path(given.star, "inventory_fact", given.format), given.format)
        fit_shuffles(spark.read.schema("FACT_ID BIGINT").format(fmt).load(path), *sizes)
        run_reports(spark, given.star, given.out, given.year, category, given.top, given.format)


if __name__ == "__main__":
    main()
