"""The same answers in plain SQL, written against the given tables alone."""

from __future__ import annotations

PROFIT = """
    ROUND(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(18, 2))), 2)
"""

BY_GRAIN = f"""
WITH order_lines AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
           p_type AS category,
           p_brand AS sub_category,
           o_custkey AS customer_id,
           c_name AS customer_name,
           l_orderkey AS order_id,
           {PROFIT} AS profit
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN part ON l_partkey = p_partkey
),
by_grain AS (
    SELECT order_year, category, sub_category, customer_id, customer_name,
           SUM(profit) AS profit,
           COUNT(DISTINCT order_id) AS order_id_distinct_count
    FROM order_lines
    GROUP BY ALL
)
"""

TOTAL = "CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit"


def _rollup(dimensions: str, order_by: str) -> str:
    return f"""{BY_GRAIN}
        SELECT {dimensions}, {TOTAL} FROM by_grain GROUP BY {dimensions} ORDER BY {order_by}"""


FIRST_LINES = f"""
WITH lines AS (
    SELECT lineitem.*, {PROFIT} AS profit,
           row_number() OVER (
               PARTITION BY l_orderkey, l_linenumber
               ORDER BY CAST(l_shipdate AS DATE), l_returnflag || l_linestatus,
                        'P' || l_partkey, l_quantity, l_extendedprice, l_discount
           ) AS place
    FROM lineitem
)
"""

SOME_NATIONS = """
WITH joined AS (
    SELECT c.*, n.n_name, n.n_regionkey, CAST(n.n_regionkey AS BIGINT) AS n_weight,
           CAST(n.n_regionkey AS DOUBLE) AS n_share,
           CASE WHEN n.n_nationkey IS NOT NULL THEN TRUE END AS n_known
    FROM customer c
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey IN (0, 3)) n
           ON c.c_nationkey = n.n_nationkey
)
"""

FLAGS = """
WITH flags AS (SELECT DISTINCT l_partkey, l_returnflag AS flag FROM lineitem)
"""

CLEAN_NAME = (
    r"trim(regexp_replace(regexp_replace({}, '[^a-zA-Z\s'']', '', 'g'), '\s+', ' ', 'g'))"
)

# Digits, then the national part by cases, then ten characters or nothing.
PHONE_STEPS = r"""
digits AS (
    SELECT *, regexp_replace(raw, '[^0-9]', '', 'g') AS d FROM numbers
),
national AS (
    SELECT *, CASE WHEN raw LIKE '%#ERROR!%' THEN NULL
                   WHEN d LIKE '001%' THEN substr(d, 4)
                   WHEN d LIKE '1%' AND length(d) > 10 THEN substr(d, 2)
                   ELSE d END AS n
    FROM digits
)
"""
PHONE = "CASE WHEN length(n) >= 10 THEN substr(n, 1, 10) END AS phone"

LINE_TABLE = f"""
SELECT concat_ws('-', l_orderkey, l_linenumber) AS row_id,
       'O' || l_orderkey AS order_id,
       CASE WHEN o_orderstatus = 'P' THEN 'unknown'
            ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS order_date,
       strftime(l_shipdate, '%-d/%-m/%Y') AS ship_date,
       ' ' || l_returnflag || l_linestatus AS ship_mode,
       'C' || o_custkey AS customer_id,
       'P' || l_partkey AS product_id,
       CAST(l_quantity AS INTEGER) AS quantity,
       l_extendedprice AS price,
       l_discount AS discount,
       CAST({PROFIT} AS DOUBLE) AS profit
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
"""

PRODUCT_TABLE = """
SELECT 'P' || p_partkey AS product_id,
       p_type AS category,
       p_brand AS sub_category,
       p_name || ', "' || p_brand || '"' || chr(10) || p_type AS product_name,
       'State ' || p_size AS state,
       p_retailprice AS price_per_product
FROM part
"""

PRODUCT_STATES = """
SELECT product_id, category, sub_category, product_name, l_returnflag AS state, price_per_product
FROM (
    SELECT 'P' || p_partkey AS product_id,
           p_type AS category,
           p_brand AS sub_category,
           p_name || ', "' || p_brand || '"' || chr(10) || p_type AS product_name,
           p_retailprice AS price_per_product,
           p_partkey
    FROM part
)
LEFT JOIN (SELECT DISTINCT l_partkey, l_returnflag FROM lineitem) ON p_partkey = l_partkey
"""


def _enriched_orders(products: str) -> str:
    """Order lines after every step; ``products`` holds key, category and sub_category."""
    return f"""{FIRST_LINES},
    enriched AS (
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS row_id,
               'O' || l_orderkey AS order_id,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS order_date,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER)
                    ELSE 0 END AS order_year,
               CAST(l_shipdate AS DATE) AS ship_date,
               l_returnflag || l_linestatus AS ship_mode,
               'C' || o_custkey AS customer_id,
               'P' || l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               l_extendedprice AS price,
               l_discount AS discount,
               CAST(profit AS DOUBLE) AS profit,
               coalesce({CLEAN_NAME.format("c_mktsegment || '  & ' || c_name")}, 'Unknown')
               AS customer_name,
               coalesce(n_name, 'Unknown') AS country,
               coalesce(category, 'Unknown') AS category,
               coalesce(sub_category, 'Unknown') AS sub_category
        FROM lines
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey
                   WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey
        LEFT JOIN ({products}) ON l_partkey = p_partkey
        WHERE place = 1
    )"""


FANNED_PRODUCTS = """
    SELECT p_partkey, p_type AS category, p_brand AS sub_category
    FROM part
    LEFT JOIN (SELECT DISTINCT l_partkey AS state_key, l_returnflag FROM lineitem)
           ON p_partkey = state_key
    WHERE p_type <> 'ECONOMY'"""

SINGLE_PRODUCTS = """
    SELECT p_partkey, p_type AS category, p_brand AS sub_category
    FROM part WHERE p_type <> 'ECONOMY'"""

ORACLE_SQL: dict[str, str] = {
    "profit_by_grain": f"""{BY_GRAIN}
        SELECT order_year, category, sub_category, customer_id, customer_name,
               CAST(profit AS DOUBLE) AS total_profit, order_id_distinct_count
        FROM by_grain""",
    "profit_by_year": _rollup("order_year", "order_year"),
    "profit_by_year_category": _rollup("order_year, category", "order_year, category"),
    "profit_by_customer": _rollup("customer_id, customer_name", "total_profit DESC, customer_id"),
    "profit_by_customer_year": _rollup(
        "customer_id, customer_name, order_year", "customer_name, customer_id, order_year"
    ),
    "profit_grouping_sets": f"""{BY_GRAIN}
        SELECT order_year, category, customer_id, customer_name,
               CASE WHEN GROUPING(category) = 0 THEN 'profit_by_year_category'
                    WHEN GROUPING(customer_id) = 1 THEN 'profit_by_year'
                    WHEN GROUPING(order_year) = 1 THEN 'profit_by_customer'
                    ELSE 'profit_by_customer_year' END AS rollup,
               {TOTAL}
        FROM by_grain
        GROUP BY GROUPING SETS ((order_year), (order_year, category),
                                (customer_id, customer_name),
                                (customer_id, customer_name, order_year))""",
    "top_customers": f"""{BY_GRAIN}
        SELECT customer_id, customer_name, {TOTAL}
        FROM by_grain GROUP BY ALL ORDER BY total_profit DESC, customer_id LIMIT 10""",
    "sum_and_two_distinct_counts": """
        SELECT l_returnflag, l_linestatus,
               CAST(SUM(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS total_l_quantity,
               COUNT(DISTINCT l_orderkey) AS l_orderkey_distinct_count,
               COUNT(DISTINCT l_partkey) AS l_partkey_distinct_count
        FROM lineitem GROUP BY ALL ORDER BY l_returnflag, l_linestatus""",
    "sum_of_any_values": """
        WITH valued AS (
            SELECT l_orderkey, l_linenumber % 4 AS n, l_extendedprice,
                   CASE l_linenumber % 4 WHEN 0 THEN l_quantity * 1125899906842624.0::DOUBLE
                                         WHEN 1 THEN l_quantity / 1024.0::DOUBLE
                                         ELSE l_quantity / 1048576.0::DOUBLE END AS v
            FROM lineitem
        ),
        totals AS (
            SELECT n, COUNT(DISTINCT l_orderkey) AS orders,
                   CASE WHEN n = 3 THEN CAST(SUM(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE)
                        WHEN n = 0 THEN SUM(v)
                        ELSE ROUND(SUM(v), 2) END AS total
            FROM valued GROUP BY n
        )
        SELECT CASE n WHEN 0 THEN 'huge' WHEN 1 THEN 'fine' WHEN 2 THEN 'tiny' ELSE 'plain' END AS kind,
               total AS total_hinted, total AS total_unhinted,
               orders AS l_orderkey_distinct_count
        FROM totals""",
    "count_metric": """
        SELECT o_orderpriority, COUNT(c_name) AS customer_name_count,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_o_totalprice
        FROM orders
        LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey
        GROUP BY ALL ORDER BY o_orderpriority""",
    "summed_counts": """
        SELECT l_returnflag, CAST(COUNT(l_orderkey) AS BIGINT) AS l_orderkey_count,
               CAST(SUM(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS total_l_quantity
        FROM lineitem GROUP BY ALL""",
    "latest_batch": """
        SELECT event_id, user_id, event_type, value FROM events
        WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "snake_case_rename": """
        SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS sub_brand,
               p_type AS type_of_part, p_size AS size_cm, p_retailprice AS retail_price
        FROM part""",
    "trim_strings": """
        SELECT p_partkey, trim(p_name) AS p_name, trim(p_brand) AS p_brand,
               trim(p_type || '  ' || p_name) AS p_type, p_size
        FROM part""",
    "clean_names": f"""
        SELECT c_custkey, {CLEAN_NAME.format("c_name")} AS name,
               {CLEAN_NAME.format("'  O''' || c_mktsegment || ' 567   -' || c_name || '.. Jr.'")}
               AS full_name
        FROM customer""",
    "validate_emails": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\r\n]+')) AS raw FROM documents
        )
        SELECT DISTINCT raw,
               CASE WHEN regexp_full_match(raw, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.-]+')
                    THEN raw ELSE 'not valid' END AS email
        FROM words""",
    "normalise_phones": f"""
        WITH numbers AS (
            SELECT doc_id,
                   unnest(regexp_extract_all(text, '[+(]?[0-9][0-9().x +-]{{5,}}[0-9]')) AS raw
            FROM documents
        ), {PHONE_STEPS}
        SELECT doc_id, raw, {PHONE} FROM national""",
    "normalise_phone_cases": f"""
        WITH spelled AS (
            SELECT c_custkey, c_mktsegment,
                   lpad(CAST(floor(abs(c_acctbal) * 100) AS BIGINT) || '' || c_custkey, 10, '7') AS s
            FROM customer
        ),
        numbers AS (
            SELECT c_custkey,
                   CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '001-' || s
                                     WHEN 'BUILDING' THEN '1 (' || s || ')x12'
                                     WHEN 'FURNITURE' THEN '#ERROR!' || s
                                     WHEN 'HOUSEHOLD' THEN '001' || c_custkey || '.' || c_custkey
                                     ELSE s END AS raw
            FROM spelled
        ), {PHONE_STEPS}
        SELECT c_custkey, raw, {PHONE} FROM national""",
    "pad_postal": """
        SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS code,
               lpad(p_partkey || '-' || p_size, 5, '0') AS long_code
        FROM part""",
    "parse_dates": r"""
        WITH rendered AS (
            SELECT o_orderkey,
                   CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '31/2/%Y')
                        WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
                        WHEN o_orderstatus = 'P' THEN 'not-a-date'
                        WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
                        ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS raw
            FROM orders
        ),
        parsed AS (
            SELECT *, CASE WHEN regexp_full_match(raw, '\d{1,2}/\d{1,2}/\d{4}')
                           THEN CAST(try_strptime(raw, '%d/%m/%Y') AS DATE) END AS order_date
            FROM rendered
        )
        SELECT o_orderkey, raw, order_date, CAST(year(order_date) AS INTEGER) AS order_year
        FROM parsed""",
    "round_values": """
        SELECT l_orderkey, l_linenumber,
               CAST(ROUND(CAST(l_quantity AS DECIMAL(13, 2)) * CAST(l_tax AS DECIMAL(3, 2)), 1)
                    AS DOUBLE) AS tax_share,
               CAST(ROUND(CAST(l_quantity AS DECIMAL(13, 2)) * CAST(l_tax AS DECIMAL(3, 2)), 0)
                    AS DOUBLE) AS whole_share
        FROM lineitem""",
    "dedupe_on_key": """
        SELECT * EXCLUDE (place) FROM (
            SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate),
                   row_number() OVER (
                       PARTITION BY l_orderkey, l_linenumber
                       ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                                l_tax, l_returnflag, l_linestatus, l_shipdate
                   ) AS place
            FROM lineitem
        ) WHERE place = 1""",
    "dedupe_preferring_latest_shipment": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (
                       PARTITION BY l_orderkey ORDER BY days_left, l_partkey, l_suppkey
                   ) AS place
            FROM (
                SELECT l_orderkey, l_partkey, l_suppkey,
                       CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '2030-01-01') AS INTEGER)
                       AS days_left
                FROM lineitem
            )
        ) WHERE place = 1""",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS copies
        FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
    "duplicate_summary": """
        SELECT COUNT(*) AS row_count, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS key_count,
               COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS dropped
        FROM lineitem""",
    "fill_missing": f"""{SOME_NATIONS}
        SELECT * REPLACE (coalesce(n_name, 'Unknown') AS n_name,
                          coalesce(n_weight, 0) AS n_weight,
                          coalesce(n_share, 0) AS n_share)
        FROM joined""",
    "audit_table": f"""{SOME_NATIONS}
        SELECT COUNT(*) AS row_count,
               COUNT(*) FILTER (WHERE c_custkey IS NULL OR n_name IS NULL) AS null_rows
        FROM joined""",
    "enrich_left_unmatched": """
        SELECT o_orderkey, o_custkey AS customer_id, o_orderpriority, o_totalprice,
               c_name AS customer_name
        FROM orders
        LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey
        """,
    "enrich_left_fanout": f"""{FLAGS}
        SELECT l.l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, flag
        FROM lineitem l LEFT JOIN flags f ON l.l_partkey = f.l_partkey""",
    "enrich_left_unique": f"""{FLAGS}
        SELECT l.l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, flag
        FROM lineitem l
        LEFT JOIN (SELECT l_partkey, min(flag) AS flag FROM flags GROUP BY l_partkey) f
               ON l.l_partkey = f.l_partkey""",
    "enrich_left_checked": """
        SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, p_brand, p_size
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "enrich_left_composite_key": """
        SELECT l.l_partkey, l_orderkey, l_linenumber, l.l_suppkey, l.l_quantity, largest
        FROM lineitem l
        LEFT JOIN (
            SELECT l_partkey, l_suppkey, max(l_quantity) AS largest
            FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL
        ) s ON l.l_partkey = s.l_partkey AND l.l_suppkey = s.l_suppkey""",
    "join_growth": f"""{FLAGS}
        SELECT (SELECT COUNT(*) FROM lineitem) AS rows_before,
               COUNT(*) AS rows_after,
               COUNT(*) FILTER (WHERE f.flag IS NULL) AS rows_unmatched
        FROM lineitem l
        LEFT JOIN (SELECT * FROM flags WHERE flag <> 'A') f ON l.l_partkey = f.l_partkey""",
    "schema_contract": """
        SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders""",
    "csv_roundtrip": PRODUCT_TABLE,
    "typed_workbook_ingest": PRODUCT_TABLE,
    "appended_batches": PRODUCT_TABLE,
    "reloaded_batch": PRODUCT_TABLE,
    "json_roundtrip": LINE_TABLE,
    "workbook_ingest": """
        SELECT 'C' || c_custkey AS customer_id,
               c_mktsegment || '  & ' || c_name AS customer_name,
               CASE WHEN c_acctbal < 0 THEN 'no <mail>'
                    ELSE 'c' || c_custkey || '@example.com' END AS email,
               '001-' || lpad(CAST(c_custkey AS VARCHAR), 10, '5') AS phone,
               c_custkey || ' Main St' AS address,
               c_mktsegment AS segment,
               n_name AS country,
               CAST(NULL AS VARCHAR) AS city,
               'State ' || c_nationkey AS state,
               CAST(c_custkey AS VARCHAR) AS postal_code,
               CAST(NULL AS VARCHAR) AS region
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "enriched_customers": f"""
        SELECT 'C' || c_custkey AS customer_id,
               {CLEAN_NAME.format("c_mktsegment || '  & ' || c_name")} AS customer_name,
               CASE WHEN c_acctbal < 0 THEN 'not valid'
                    ELSE 'c' || c_custkey || '@example.com' END AS email,
               lpad(CAST(c_custkey AS VARCHAR), 10, '5') AS phone,
               c_custkey || ' Main St' AS address,
               c_mktsegment AS segment,
               n_name AS country,
               'Unknown' AS city,
               'State ' || c_nationkey AS state,
               lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS postal_code,
               'NA' AS region
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "enriched_products": PRODUCT_STATES,
    "enriched_orders_fanout": f"{_enriched_orders(FANNED_PRODUCTS)} SELECT * FROM enriched",
    "enriched_orders_unique": f"{_enriched_orders(SINGLE_PRODUCTS)} SELECT * FROM enriched",
    "profit_with_fanout": f"""{_enriched_orders(FANNED_PRODUCTS)}
        SELECT order_year, category, sub_category, customer_id, customer_name,
               CAST(SUM(CAST(profit AS DECIMAL(18, 2))) AS DOUBLE) AS total_profit,
               COUNT(DISTINCT order_id) AS order_id_distinct_count
        FROM enriched GROUP BY ALL""",
    "mart_end_to_end": f"""{FIRST_LINES}
        SELECT CASE WHEN o_orderstatus = 'P' THEN 0
                    ELSE CAST(year(o_orderdate) AS INTEGER) END AS order_year,
               coalesce(p_type, 'Unknown') AS category,
               coalesce(p_brand, 'Unknown') AS sub_category,
               'C' || o_custkey AS customer_id,
               coalesce({CLEAN_NAME.format("c_mktsegment || '  & ' || c_name")}, 'Unknown')
               AS customer_name,
               CAST(SUM(profit) AS DOUBLE) AS total_profit,
               COUNT(DISTINCT l_orderkey) AS order_id_distinct_count
        FROM lines
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey
        LEFT JOIN (SELECT * FROM part WHERE p_type <> 'ECONOMY') ON l_partkey = p_partkey
        WHERE place = 1
        GROUP BY ALL""",
}

ORACLE_SQL["appended_enriched_batches"] = (
    f"SELECT * FROM ({ORACLE_SQL['enriched_customers']}) "
    f"UNION ALL SELECT * FROM ({ORACLE_SQL['enriched_customers']})"
)
ORACLE_SQL["stored_reports"] = f"""
    WITH totals AS (
        SELECT customer_id, customer_name, ROUND(SUM(total_profit), 2) AS total_profit
        FROM ({ORACLE_SQL['mart_end_to_end']}) GROUP BY ALL
    )
    SELECT *, 'report' AS origin FROM totals UNION ALL SELECT *, 'view' AS origin FROM totals"""

ORACLE_SQL["landed_workbooks"] = f"SELECT *, TRUE AS stamped FROM ({ORACLE_SQL['workbook_ingest']})"
ORACLE_SQL["repeated_runs"] = f"""
    SELECT run_id, country, count(*) AS enriched_rows, TRUE AS stamped,
           count(DISTINCT customer_id) AS customer_id_distinct_count
    FROM ({ORACLE_SQL['enriched_customers']}), (VALUES ('first'), ('second')) AS runs(run_id)
    GROUP BY run_id, country"""
ORACLE_SQL["quarantined_rows"] = """
    WITH judged AS (
        SELECT *, CASE WHEN l_quantity = 7 THEN 'bad value in Quantity'
                       WHEN l_quantity = 11 THEN 'other number of fields'
                       WHEN l_suppkey % 7 = 0 THEN 'header in another order'
                       ELSE 'landed' END AS reason
        FROM lineitem
    )
    SELECT reason, count(*) AS row_count,
           CASE WHEN reason = 'header in another order' THEN 0 ELSE count(*) END AS as_delivered,
           CASE WHEN reason = 'landed' THEN CAST(sum(l_quantity) AS BIGINT) END AS quantity,
           (SELECT count(*) FROM judged WHERE reason = 'landed') AS reported
    FROM judged GROUP BY reason"""
ORACLE_SQL["mergeable_distinct_counts"] = """
    SELECT 'order_year' AS dimension, CAST(year(o_orderdate) AS BIGINT) AS value,
           count(DISTINCT o_orderkey) AS exact_orders, TRUE AS within_bound
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
    UNION ALL
    SELECT 'customer_id', CAST(o_custkey AS BIGINT), count(DISTINCT o_orderkey), TRUE
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""
