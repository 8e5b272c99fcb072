"""For each query, SQL that another engine (DuckDB) runs on the same tables."""

from __future__ import annotations

# The distinct sales, as the fact table holds them.
_SALES = """
    SELECT DISTINCT
        CAST(o.o_orderdate AS DATE) AS "Date",
        l.l_orderkey AS "TRANSACTION_ID",
        l.l_partkey AS "PRODUCT_ID",
        o.o_custkey AS "CUSTOMER_ID",
        l.l_suppkey AS "SELLER_ID",
        CAST(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(p.p_retailprice AS DECIMAL(18,2))
             AS DECIMAL(18,4)) AS "PRODUCT_COST_PRICE",
        CAST(l.l_extendedprice AS DECIMAL(18,2)) AS "PRODUCT_SELLING_PRICE"
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
"""

_CALENDAR = """
    SELECT DISTINCT
        CAST(o_orderdate AS DATE) AS "Date",
        CAST(year(o_orderdate) AS INT) AS "YEAR",
        CAST(quarter(o_orderdate) AS INT) AS "QUARTER",
        CAST(month(o_orderdate) AS INT) AS "MONTH",
        CAST(dayofweek(o_orderdate) + 1 AS INT) AS "DAY_OF_WEEK"
    FROM orders
"""

# A sale is a line with its order, product, customer and seller.
_WIDE = """
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation m ON s.s_nationkey = m.n_nationkey
"""

_SALE_DATES = f"""
    SELECT DISTINCT CAST(o.o_orderdate AS DATE) AS "Date" {_WIDE}
"""

_TOP_CUSTOMERS = f"""
    WITH f AS ({_SALES})
    SELECT CAST(year(f."Date") AS INT) AS "YEAR", c.c_name AS "Customer Name",
        c.c_custkey AS "CUSTOMER_ID",
        CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS "TOTAL_SELLING_PRICE"
    FROM f
    JOIN customer c ON f."CUSTOMER_ID" = c.c_custkey
    JOIN orders o ON f."TRANSACTION_ID" = o.o_orderkey
    WHERE year(f."Date") = 1998
    GROUP BY 1, 2, 3
    ORDER BY 4 DESC, 3
    LIMIT 10
"""

_STATE_ORDERS = f"""
    WITH f AS ({_SALES})
    SELECT upper(n.n_name) AS "CUSTOMER_STATE",
        CAST(count(f."TRANSACTION_ID") AS BIGINT) AS "ORDER_COUNT"
    FROM f
    JOIN customer c ON f."CUSTOMER_ID" = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY 1
    ORDER BY 1
"""

_PAYMENT_MODE = f"""
    WITH f AS ({_SALES})
    SELECT o.o_orderpriority AS "TRANSACTION_TYPE",
        CAST(count(f."TRANSACTION_ID") AS BIGINT) AS "ORDER_COUNT"
    FROM f
    JOIN orders o ON f."TRANSACTION_ID" = o.o_orderkey
    GROUP BY 1
    ORDER BY 2, 1
"""

_QUARTERLY_PROFIT = f"""
    WITH f AS ({_SALES})
    SELECT CAST(year("Date") AS INT) AS "YEAR", CAST(quarter("Date") AS INT) AS "QUARTER",
        CAST(trunc(sum("PRODUCT_SELLING_PRICE" - "PRODUCT_COST_PRICE")) AS BIGINT) AS "PROFIT"
    FROM f
    WHERE year("Date") = 1998
    GROUP BY 1, 2
    ORDER BY 2
"""


def _category_sales(condition: str) -> str:
    return f"""
    WITH f AS ({_SALES})
    SELECT CAST(year(f."Date") AS INT) AS "YEAR", CAST(quarter(f."Date") AS INT) AS "QUARTER",
        p.p_type AS "CATEGORY_ID", p.p_name AS "PRODUCT Name",
        CAST(count(f."TRANSACTION_ID") AS BIGINT) AS "SALES_COUNT"
    FROM f
    JOIN part p ON f."PRODUCT_ID" = p.p_partkey
    WHERE year(f."Date") = 1998 AND {condition}
    GROUP BY 1, 2, 3, 4
    ORDER BY 1, 2, 3, 4
    """


# The tables of a star built from the wide table: only what some sale refers to.
_STAR_TABLES = {
    "customers_dim": """
        SELECT DISTINCT c.c_custkey, c.c_name, n.n_name, c.c_mktsegment
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
    """,
    "products_dim": """
        SELECT p.p_partkey, p.p_type, p.p_name, p.p_brand, min(l.l_quantity)
        FROM lineitem l
        JOIN part p ON l.l_partkey = p.p_partkey
        GROUP BY ALL
    """,
    "sellers_dim": """
        SELECT DISTINCT s.s_suppkey, s.s_name, n.n_name
        FROM lineitem l
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey
    """,
    "time_dim": """
        SELECT DISTINCT CAST(o.o_orderdate AS DATE)
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
    """,
    "transaction_dim": """
        SELECT DISTINCT o.o_orderkey, CAST(o.o_orderdate AS DATE),
            CAST(o.o_totalprice AS DECIMAL(18,2)), o.o_orderpriority
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
    """,
    "inventory_fact": _SALES,
}

# Dense ids of n rows are 1 to n and add up to n (n + 1) / 2.
_BUILD_STAR = " UNION ALL ".join(
    f"""
    SELECT '{name}' AS table_name, count(*) AS row_count, CAST(1 AS BIGINT) AS first_id,
        count(*) AS last_id, CAST(count(*) * (count(*) + 1) // 2 AS DECIMAL(38,0)) AS id_sum
    FROM ({rows})
    """
    for name, rows in _STAR_TABLES.items()
)

_RUN_REPORTS = " UNION ALL ".join(
    f"""
    SELECT '{name}' AS report, CAST({label} AS VARCHAR) AS label,
        CAST({value} AS DECIMAL(38,2)) AS value
    FROM ({sql})
    """
    for name, label, value, sql in [
        ("top_10_customers", '"CUSTOMER_ID"', '"TOTAL_SELLING_PRICE"', _TOP_CUSTOMERS),
        ("statewise_orders", '"CUSTOMER_STATE"', '"ORDER_COUNT"', _STATE_ORDERS),
        ("payment_mode_by_state", '"TRANSACTION_TYPE"', '"ORDER_COUNT"', _PAYMENT_MODE),
        ("quarterly_profit", '"QUARTER"', '"PROFIT"', _QUARTERLY_PROFIT),
        (
            "quarterly_sales_count",
            """concat_ws('/', "QUARTER", "PRODUCT Name")""",
            '"SALES_COUNT"',
            _category_sales("p.p_type = 'PROMO'"),
        ),
    ]
)

ORACLES: dict[str, str] = {
    "csv_scan": """
        SELECT CAST(c_custkey AS INT) AS c_custkey, c_name, CAST(c_nationkey AS INT) AS c_nationkey,
            c_acctbal, c_mktsegment
        FROM customer
    """,
    "csv_scan_schema": """
        SELECT c_custkey, c_name, CAST(c_nationkey AS INT) AS c_nationkey, c_acctbal, c_mktsegment
        FROM customer
    """,
    "csv_scan_reordered": """
        SELECT c_custkey, c_name, CAST(c_nationkey AS INT) AS c_nationkey, c_acctbal, c_mktsegment
        FROM customer
    """,
    "csv_sink": """
        SELECT o_orderpriority AS transaction_type, count(o_orderkey) AS order_count
        FROM orders
        GROUP BY o_orderpriority
    """,
    "project_columns": "SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority FROM orders",
    "spaced_alias": 'SELECT c_custkey AS "CUSTOMER_ID", c_name AS "Customer Name" FROM customer',
    "arith_subtract": """
        SELECT l_orderkey, l_linenumber,
            CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,2)) AS diff
        FROM lineitem
    """,
    "cast_truncate": """
        SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS BIGINT) AS price_int,
            CAST(trunc(-l_extendedprice) AS BIGINT) AS negative_int
        FROM lineitem
    """,
    "upper_case": "SELECT p_partkey, upper(p_name) AS p_name FROM part",
    "parse_date": """
        SELECT event_id, CAST(strptime(strftime(ts, '%d-%b-%y'), '%d-%b-%y') AS DATE) AS d
        FROM events
    """,
    "date_parts": f"""
        SELECT "Date" AS order_date, "YEAR" AS year, "QUARTER" AS quarter, "MONTH" AS month,
            "DAY_OF_WEEK" AS day_of_week
        FROM ({_CALENDAR})
    """,
    "filter_equality": "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1998",
    "filter_chained": """
        SELECT o_orderkey, o_orderdate
        FROM orders
        WHERE year(o_orderdate) = 1998 AND o_orderpriority = '1-URGENT'
    """,
    "inner_join": """
        SELECT o.o_orderkey, c.c_name
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
    """,
    "join_chain": """
        SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey
    """,
    "drop_duplicates": "SELECT DISTINCT o_custkey, o_orderpriority FROM orders",
    "agg_sum": """
        SELECT o_custkey,
            CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
        FROM orders
        GROUP BY o_custkey
    """,
    "agg_count": "SELECT o_custkey, count(o_orderkey) AS n FROM orders GROUP BY o_custkey",
    "agg_min": """
        SELECT p_name, p_brand, p_type, min(p_size) AS stock
        FROM part
        GROUP BY p_name, p_brand, p_type
    """,
    "agg_then_cast": """
        SELECT l_returnflag,
            CAST(trunc(sum(CAST(l_extendedprice AS DECIMAL(18,2))
                           - CAST(l_quantity AS DECIMAL(18,2)))) AS BIGINT) AS profit
        FROM lineitem
        GROUP BY l_returnflag
    """,
    "group_by_expression": """
        SELECT upper(p_type) AS p_type, count(p_partkey) AS n
        FROM part
        GROUP BY upper(p_type)
    """,
    "dense_surrogate_key": """
        SELECT o_custkey, o_orderpriority,
            row_number() OVER (ORDER BY o_custkey NULLS FIRST, o_orderpriority NULLS FIRST) AS id
        FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)
    """,
    "sort_multi": """
        SELECT o_orderkey, o_custkey, o_orderdate
        FROM orders
        ORDER BY o_custkey ASC NULLS FIRST, o_orderdate DESC NULLS LAST, o_orderkey ASC NULLS FIRST
    """,
    "top_k": """
        SELECT o_orderkey, o_totalprice
        FROM orders
        ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS FIRST
        LIMIT 10
    """,
    "dim_customer": f"""
        SELECT *, row_number() OVER (ORDER BY "CUSTOMER_ID" NULLS FIRST) AS "CUSTOMER_DIM_ID"
        FROM (
            SELECT DISTINCT c.c_custkey AS "CUSTOMER_ID", c.c_name AS "Customer Name",
                n.n_name AS "CUSTOMER_STATE", c.c_mktsegment AS "CUSTOMER_SEGMENT"
            {_WIDE}
        )
    """,
    "dim_product": f"""
        SELECT *, row_number() OVER (ORDER BY "PRODUCT_ID" NULLS FIRST) AS "PRODUCT_DIM_ID"
        FROM (
            SELECT p.p_partkey AS "PRODUCT_ID", p.p_type AS "CATEGORY_ID",
                p.p_name AS "PRODUCT Name", p.p_brand AS "PRODUCT Brand",
                min(l.l_quantity) AS "PRODUCT_STOCK"
            {_WIDE}
            GROUP BY p.p_partkey, p.p_type, p.p_name, p.p_brand
        )
    """,
    "dim_seller": f"""
        SELECT *, row_number() OVER (ORDER BY "SELLER_ID" NULLS FIRST) AS "SELLER_DIM_ID"
        FROM (
            SELECT DISTINCT s.s_suppkey AS "SELLER_ID", s.s_name AS "SELLER_NAME",
                m.n_name AS "SELLER_STATE"
            {_WIDE}
        )
    """,
    "dim_time": f"""
        SELECT *, row_number() OVER (ORDER BY "Date" NULLS FIRST) AS "TIME_DIM_ID"
        FROM ({_CALENDAR}) WHERE "Date" IN (SELECT "Date" FROM ({_SALE_DATES}))
    """,
    "dim_time_text": """
        SELECT strftime(d, '%d-%b-%y') AS "Date", CAST(year(d) AS INT) AS "YEAR",
            CAST(quarter(d) AS INT) AS "QUARTER", CAST(month(d) AS INT) AS "MONTH",
            CAST(dayofweek(d) + 1 AS INT) AS "DAY_OF_WEEK",
            row_number() OVER (ORDER BY d NULLS FIRST) AS "TIME_DIM_ID"
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
    """,
    "dim_transaction": f"""
        SELECT *, row_number() OVER (ORDER BY "TRANSACTION_ID" NULLS FIRST) AS "TRANSACTION_DIM_ID"
        FROM (
            SELECT DISTINCT o.o_orderkey AS "TRANSACTION_ID",
                CAST(o.o_orderdate AS DATE) AS "TRANSACTION_DATE",
                CAST(o.o_totalprice AS DECIMAL(18,2)) AS "TRANSACTION_AMOUNT",
                o.o_orderpriority AS "TRANSACTION_TYPE"
            {_WIDE}
        )
    """,
    "fact_inventory": f"""
        WITH f AS ({_SALES}),
        t AS (
            SELECT "Date", row_number() OVER (ORDER BY "Date") AS "TIME_DIM_ID"
            FROM ({_SALE_DATES})
        )
        SELECT
            row_number() OVER (ORDER BY t."TIME_DIM_ID", f."TRANSACTION_ID" NULLS FIRST,
                f."PRODUCT_ID" NULLS FIRST, f."CUSTOMER_ID" NULLS FIRST,
                f."SELLER_ID" NULLS FIRST, f."PRODUCT_COST_PRICE" NULLS FIRST,
                f."PRODUCT_SELLING_PRICE" NULLS FIRST) AS "FACT_ID",
            t."TIME_DIM_ID", f."TRANSACTION_ID", f."PRODUCT_ID", f."CUSTOMER_ID", f."SELLER_ID",
            f."PRODUCT_COST_PRICE", f."PRODUCT_SELLING_PRICE"
        FROM f
        JOIN t ON f."Date" = t."Date"
    """,
    "report_top_customers": _TOP_CUSTOMERS,
    "report_state_orders": _STATE_ORDERS,
    "report_payment_mode": _PAYMENT_MODE,
    "report_quarterly_profit": _QUARTERLY_PROFIT,
    "report_category_sales": _category_sales("p.p_type = 'PROMO'"),
    "report_category_sales_all": _category_sales("TRUE"),
    "job_build_star": _BUILD_STAR,
    "job_run_reports": _RUN_REPORTS,
    "job_run_reports_csv": _RUN_REPORTS,
    "undated_sales": f"""
        SELECT count(*) AS undated_sales FROM ({_SALES}) WHERE year("Date") <> 1998
    """,
    "repeated_keys": """
        SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1
    """,
}

# The content of the tables the job writes is that of the dimensions and the fact, in either format.
for _name, _key in {
    "time_dim": "dim_time",
    "inventory_fact": "fact_inventory",
    "customers_dim": "dim_customer",
    "products_dim": "dim_product",
    "sellers_dim": "dim_seller",
    "transaction_dim": "dim_transaction",
}.items():
    ORACLES[f"job_star_{_name}"] = ORACLES[f"job_star_csv_{_name}"] = ORACLES[_key]
