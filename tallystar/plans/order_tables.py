"""Sales data out of order tables (orders, lineitem, part, customer, supplier, nation).

The star-schema builders take one wide table. These functions give the part of
it that a builder reads, in the column names of the sales data, joined no wider
than needed. Rows that only serve a distinct are made distinct before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.dates import in_year
from tallystar.plans.layout import StarLayout
from tallystar.sources.scratch import pin, pin_in_turn, scratch_of_job, scratch_path

LAYOUT = StarLayout(
    customer=("CUSTOMER_ID", "Customer Name", "CUSTOMER_STATE", "CUSTOMER_SEGMENT"),
    product=("PRODUCT_ID", "CATEGORY_ID", "PRODUCT Name", "PRODUCT Brand"),
    seller=("SELLER_ID", "SELLER_NAME", "SELLER_STATE"),
    transaction=("TRANSACTION_ID", "TRANSACTION_DATE", "TRANSACTION_AMOUNT", "TRANSACTION_TYPE"),
)

MONEY = "decimal(18,2)"

#: Most turns in which the lines of the wide table meet their orders, and lines of a turn at least. Each turn reads all keys again.
TURNS = 4
TURN_LINES = 1 << 20

# Given, so that opening a table reads no file.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": """
        c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING
    """,
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """
        p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE
    """,
    "orders": """
        o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING
    """,
    "lineitem": """
        l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ
    """,
    "events": """
        event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,
        props STRING
    """,
}


class OrderTables:
    """The Parquet tables of one folder, and the sales data in them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def rows(self, name: str) -> int:
        """The rows of a table, which its files tell without a column being read."""
        return self.table(name).count()

    def dates(self) -> DataFrame:
        """The dates of all orders."""
        return self.table("orders").select(F.col("o_orderdate").cast("date").alias("Date"))

    def _sold(self) -> DataFrame:
        """Keys of the lines that are sales: those whose part and supplier there are."""
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"))
        sellers = self.sellers().select(F.col("SELLER_ID").alias("l_suppkey"))
        return lines.join(parts, "l_partkey", "left_semi").join(sellers, "l_suppkey", "left_semi")

    def _ordered(self) -> DataFrame:
        """Keys and dates of the orders whose customer there is."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("Date"))
        customers = self.customers().select(F.col("CUSTOMER_ID").alias("o_custkey"))
        return orders.join(customers, "o_custkey", "left_semi")

    def _sold_orders(self) -> DataFrame:
        """The orders that have sales. Orders without lines are no sales."""
        keys = self._sold().select(F.col("l_orderkey").alias("o_orderkey")).distinct()
        return self._ordered().join(keys, "o_orderkey", "left_semi")

    def _sold_lines(self) -> DataFrame:
        """The lines whose order there is too."""
        keys = self._ordered().select(F.col("o_orderkey").alias("l_orderkey"))
        return self._sold().join(keys, "l_orderkey", "left_semi")

    def sale_dates(self) -> DataFrame:
        """The dates of the sales."""
        return self._sold_orders().select("Date")

    def customers(self) -> DataFrame:
        """All customers."""
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("CUSTOMER_STATE"))
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("CUSTOMER_ID"),
                F.col("c_name").alias("Customer Name"),
                "CUSTOMER_STATE",
                F.col("c_mktsegment").alias("CUSTOMER_SEGMENT"),
            )
        )

    def ordering_customers(self) -> DataFrame:
        """The customers that have sales."""
        keys = self._sold_orders().select(F.col("o_custkey").alias("CUSTOMER_ID")).distinct()
        return self.customers().join(keys, "CUSTOMER_ID", "left_semi")

    def sellers(self) -> DataFrame:
        """All sellers."""
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("SELLER_STATE"))
        return (
            self.table("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("SELLER_ID"),
                F.col("s_name").alias("SELLER_NAME"),
                "SELLER_STATE",
            )
        )

    def selling_sellers(self) -> DataFrame:
        """The sellers that have sales."""
        keys = self._sold_lines().select(F.col("l_suppkey").alias("SELLER_ID")).distinct()
        return self.sellers().join(keys, "SELLER_ID", "left_semi")

    def _parts(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("PRODUCT_ID"),
            F.col("p_type").alias("CATEGORY_ID"),
            F.col("p_name").alias("PRODUCT Name"),
            F.col("p_brand").alias("PRODUCT Brand"),
            "p_retailprice",
        )

    def products(self) -> DataFrame:
        """All products."""
        return self._parts().drop("p_retailprice")

    def stocked_products(self) -> DataFrame:
        """The products that have sales, with their smallest quantity as stock."""
        stock = (
            self.table("lineitem")
            .join(self._ordered().select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
            .join(self.sellers().select(F.col("SELLER_ID").alias("l_suppkey")), "l_suppkey", "left_semi")
            .groupBy(F.col("l_partkey").alias("PRODUCT_ID"))
            .agg(F.min("l_quantity").alias("PRODUCT_STOCK"))
        )
        return self.products().join(stock, "PRODUCT_ID")

    def _orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("TRANSACTION_ID"),
            F.col("o_custkey").alias("CUSTOMER_ID"),
            F.col("o_orderdate").cast("date").alias("Date"),
            F.col("o_orderdate").cast("date").alias("TRANSACTION_DATE"),
            F.col("o_totalprice").cast(MONEY).alias("TRANSACTION_AMOUNT"),
            F.col("o_orderpriority").alias("TRANSACTION_TYPE"),
        )

    def transactions(self) -> DataFrame:
        """The orders that have sales."""
        keys = self._sold_orders().select(F.col("o_orderkey").alias("TRANSACTION_ID"))
        return self._orders().select(*LAYOUT.transaction).join(keys, "TRANSACTION_ID", "left_semi")

    def all_transactions(self) -> DataFrame:
        """All orders, for joins with sales, which find only those they need."""
        return self._orders().select(*LAYOUT.transaction)

    def _lines(self, orders: DataFrame, orders_first: bool = False) -> DataFrame:
        """Order lines with their product and their order.

        Orders come last, so that a later distinct or count by transaction finds
        the rows partitioned as it needs them, unless they are few: then they
        come first and keep the other lines from being shuffled to the products.
        """
        lines = self._unpriced()
        if orders_first:
            joined = self._with_products(lines.join(orders, "TRANSACTION_ID"))
        else:
            joined = self._with_products(lines).join(orders, "TRANSACTION_ID")
        return self._priced(joined)

    def _unpriced(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("TRANSACTION_ID"),
            F.col("l_partkey").alias("PRODUCT_ID"),
            F.col("l_suppkey").alias("SELLER_ID"),
            F.col("l_quantity").alias("PRODUCT_STOCK"),
            "l_extendedprice",
        )

    def _with_products(self, lines: DataFrame) -> DataFrame:
        return lines.join(self._parts().withColumn("unit_price", F.col("p_retailprice").cast(MONEY)), "PRODUCT_ID")

    def _priced(self, joined: DataFrame) -> DataFrame:
        cost = F.col("PRODUCT_STOCK").cast(MONEY) * F.col("unit_price")
        return (
            joined.withColumn("PRODUCT_COST_PRICE", cost.cast("decimal(18,4)"))
            .withColumn("PRODUCT_SELLING_PRICE", F.col("l_extendedprice").cast(MONEY))
            .drop("unit_price", "p_retailprice", "l_extendedprice")
        )

    def sale_lines(self, year: int | None = None) -> DataFrame:
        """What the fact table reads of a sale, of one year or of all."""
        orders = self._orders()
        if year is not None:
            orders = orders.where(in_year(F.col("Date"), year))
        return self._lines(orders, orders_first=year is not None).select(LAYOUT.date, *LAYOUT.fact)

    def sales(self, year: int | None = None) -> DataFrame:
        """The distinct sales, each with its date: a fact table before its ids."""
        return self.sale_lines(year).dropDuplicates()

    def pinned_wide(self) -> DataFrame:
        """The wide table, pinned: every line with its product, order, customer and seller.

        Lines meet sellers, of few columns, and then products, and are written; so the shuffles of that are gone before they meet
        their orders, and they meet these in ``TURNS``, a share of the orders after the other. Customers are joined to the
        orders, of which there are fewer than lines. Wide rows are never shuffled.
        """
        path = scratch_path(self.spark)
        turns = max(1, min(TURNS, self.rows("lineitem") // TURN_LINES))
        with scratch_of_job(self.spark):
            lines = pin(self._with_products(self._unpriced().join(self.sellers(), "SELLER_ID")), "zstd")

            def turn(k: int) -> DataFrame:
                mine = F.pmod(F.xxhash64("TRANSACTION_ID"), F.lit(turns)) == k
                orders = self._orders().where(mine).join(self.customers(), "CUSTOMER_ID")
                return self._priced(lines.where(mine).join(orders, "TRANSACTION_ID"))

            return pin_in_turn(map(turn, range(turns)), path, "zstd")
