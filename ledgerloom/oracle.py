"""Independent DuckDB SQL for every registered query (the correctness oracle).

Plain windows number the surrogate keys and grains are formed by grouping, so it
checks the Spark plans (distributed keys, broadcast or shuffled lookups) against
the plain form.
Nothing is imported from the library: grains, key orders, relations and markers
are stated here by hand. It runs over the pre-registered test tables (region
nation customer part orders lineitem ...). Target tables are CTEs named ``t_<table>``.
"""

from __future__ import annotations

import re

VALUE = "DECIMAL(38,4)"

# The model as this oracle understands it, stated apart from the library's own
# schema so that a slip there shows as a difference.
# table -> (surrogate key, order that numbers it, other columns)
NUMBERED = {
    "product": ("product_code", ("product_id", "product_name", "category", "sub_category"),
                ("product_id", "category", "sub_category", "product_name")),
    "addresses": ("addresses_id", ("country", "state", "city", "postal_code"),
                  ("country", "city", "state", "postal_code")),
    "type_ship": ("ship_id", ("ship_mode",), ("ship_mode",)),
    "people": ("people_id", ("region", "person"), ("person", "region")),
    "date_ship": ("date_ship_id", ("order_id", "ship_date", "ship_id"), ("ship_id", "order_id", "ship_date")),
    "returns": ("return_id", ("detail_id", "returned"), ("returned", "detail_id")),
}
DETAIL_ORDER = ("order_id", "product_code", "quantity", "sales", "discount", "profit")
STORED = {
    **{name: (key, *columns) for name, (key, _, columns) in NUMBERED.items()},
    "customers": ("customer_id", "customer_name", "segment"),
    "orders": ("order_id", "order_date", "people_id", "customer_id", "ship_id", "addresses_id"),
    "order_details": ("detail_id", *DETAIL_ORDER),
}
PRIMARY_KEYS = {
    "product": ("product_code",), "addresses": ("addresses_id",), "type_ship": ("ship_id",),
    "people": ("people_id",), "customers": ("customer_id",), "orders": ("order_id",),
    "date_ship": ("date_ship_id",), "order_details": ("detail_id",), "returns": ("return_id",),
}
NATURAL_KEYS = {
    "people": ("region",), "type_ship": ("ship_mode",),
    "addresses": ("country", "city", "state", "postal_code"), "product": ("product_id", "product_name"),
}
# (child, column, parent); the parent's column has the same name
RELATIONS = (
    ("orders", "people_id", "people"), ("orders", "customer_id", "customers"), ("orders", "ship_id", "type_ship"),
    ("orders", "addresses_id", "addresses"), ("date_ship", "ship_id", "type_ship"), ("date_ship", "order_id", "orders"),
    ("order_details", "order_id", "orders"), ("order_details", "product_code", "product"),
    ("returns", "detail_id", "order_details"),
)
# The text cells that count as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
           "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _nf(cols) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


def postal_sql(x: str) -> str:
    """NULL → 0, truncate, text, zero-pad to 5 (sign first); longer codes stay whole."""
    s = f"CAST(CAST(trunc(coalesce({x}, 0)) AS BIGINT) AS VARCHAR)"
    return (f"CASE WHEN length({s}) < 5 THEN (CASE WHEN {s} LIKE '-%' "
            f"THEN '-' || lpad(substr({s}, 2), 4, '0') ELSE lpad({s}, 5, '0') END) ELSE {s} END")


def postal_key_sql(x: str) -> str:
    return f"coalesce({postal_sql(x)}, '00000')"


def _numbered(table: str, rows: str) -> str:
    key, order, columns = NUMBERED[table]
    return (f"SELECT CAST(row_number() OVER (ORDER BY {_nf(order)}) AS BIGINT) AS {key}, {', '.join(columns)} "
            f"FROM ({rows}) AS grain")


_FIXTURE_CTES = f"""
lines AS (
  SELECT * FROM lineitem
  UNION ALL
  SELECT * FROM lineitem WHERE l_orderkey % 100 = 0
),
raw_orders AS (
  SELECT CAST(NULL AS BIGINT) AS row_id,
         'O-' || CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(o_orderdate AS TIMESTAMP) AS order_date,
         CAST(l_shipdate AS TIMESTAMP) AS ship_date,
         o_orderpriority AS ship_mode,
         'C-' || CAST(c_custkey AS VARCHAR) AS customer_id,
         c_name AS customer_name,
         c_mktsegment AS segment,
         n_name AS country,
         'City ' || CAST(c_custkey % 50 AS VARCHAR) AS city,
         'State ' || CAST(c_custkey % 10 AS VARCHAR) AS state,
         CASE WHEN c_custkey % 50 = 7 THEN CAST(NULL AS DOUBLE)
              ELSE CAST((c_custkey % 50) * 1999 AS DOUBLE) END AS postal_code,
         r_name AS region,
         'P-' || CAST(p_partkey - p_partkey % 2 AS VARCHAR) AS product_id,
         p_type AS category,
         p_brand AS sub_category,
         p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
         l_extendedprice AS sales,
         CAST(l_quantity AS INTEGER) AS quantity,
         l_discount AS discount,
         round(l_extendedprice * (0.05 - l_discount), 4) AS profit
  FROM lines
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
),
raw_people_seq AS (
  SELECT concat('Manager ', CAST(r_regionkey AS VARCHAR)) AS person, r_name AS region,
         CAST(r_regionkey AS BIGINT) AS seq
  FROM region
),
raw_people AS (SELECT person, region FROM raw_people_seq),
raw_returns_seq AS (
  SELECT 'Yes' AS returned, concat('O-', CAST(l_orderkey AS VARCHAR)) AS order_id,
         CAST(l_orderkey * 1000 + l_linenumber AS BIGINT) AS seq
  FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT 'Yes', 'O-none-' || CAST(r_regionkey AS VARCHAR), CAST(-1 AS BIGINT) FROM region WHERE r_regionkey = 0
),
raw_returns AS (SELECT returned, order_id FROM raw_returns_seq),
"""

# The awkward variant: the same rows with the edits of FIXTURES.md §6.
_EDGE_CTES = re.sub(r"\braw_(orders|people_seq|people|returns_seq|returns)\b", r"clean_\1", _FIXTURE_CTES) + f"""
numbered AS (
  SELECT *, CAST(substr(order_id, 3) AS BIGINT) AS o, CAST(substr(customer_id, 3) AS BIGINT) AS c,
         CAST(substr(product_id, 3) AS BIGINT) AS p
  FROM clean_orders
),
edge_text AS (
  SELECT * EXCLUDE (o, c, p) REPLACE (
    CASE WHEN c % 11 = 0 THEN NULL WHEN c % 13 = 0 THEN 'Nowhere' ELSE region END AS region,
    CASE WHEN c % 17 = 0 THEN NULL ELSE city END AS city,
    CASE WHEN o % 23 = 0 THEN 'N/A' WHEN o % 29 = 0 THEN '' ELSE ship_mode END AS ship_mode,
    CASE WHEN p % 20 = 0 THEN NULL ELSE product_name END AS product_name,
    CASE c % 50 WHEN 9 THEN 123456.0::DOUBLE WHEN 11 THEN postal_code + 0.9::DOUBLE WHEN 12 THEN -42.0::DOUBLE
      ELSE postal_code END AS postal_code,
    CASE WHEN quantity % 2 = 0 THEN sales + 0.00003::DOUBLE ELSE sales END AS sales)
  FROM numbered
),
raw_orders AS (
  SELECT * REPLACE (CASE WHEN ship_mode IN ('N/A', '') THEN NULL ELSE ship_mode END AS ship_mode) FROM edge_text
),
raw_people_seq AS (
  SELECT person, region, seq FROM clean_people_seq
  UNION ALL
  SELECT 'Deputy ' || CAST(r_regionkey AS VARCHAR), r_name, CAST(r_regionkey - 100 AS BIGINT)
  FROM region WHERE r_regionkey % 2 = 0
  UNION ALL
  SELECT 'Floater', NULL, 500 FROM region WHERE r_regionkey = 0
),
raw_people AS (SELECT person, region FROM raw_people_seq),
raw_returns_seq AS (
  SELECT CASE WHEN seq % 5 = 1 THEN 'No' ELSE returned END AS returned, order_id, seq FROM clean_returns_seq
),
raw_returns AS (SELECT returned, order_id FROM raw_returns_seq),
"""

# Target tables from the raw views raw_orders, raw_people, raw_returns: the raw
# rows are brought to their grains, each dimension gives a map from its natural
# to its surrogate key, and the facts are the grains with the maps applied.
TARGET_CTES = f"""
g_order AS (
  SELECT order_id, order_date, customer_id, region, ship_mode, country, city, state,
         {postal_key_sql('postal_code')} AS postal_code
  FROM raw_orders GROUP BY ALL
),
g_shipment AS (SELECT order_id, ship_mode, ship_date FROM raw_orders GROUP BY ALL),
g_line AS (
  SELECT order_id, product_id, product_name, quantity, sales, discount, profit FROM raw_orders GROUP BY ALL
),
g_return AS (SELECT order_id, returned FROM raw_returns GROUP BY ALL),
t_customers AS (SELECT customer_id, customer_name, segment FROM raw_orders GROUP BY ALL),
t_people AS ({_numbered("people", "SELECT person, region FROM raw_people GROUP BY ALL")}),
t_type_ship AS ({_numbered("type_ship", "SELECT ship_mode FROM g_shipment GROUP BY ALL")}),
t_addresses AS ({_numbered("addresses", "SELECT country, city, state, postal_code FROM g_order GROUP BY ALL")}),
t_product AS ({_numbered("product", "SELECT product_id, product_name, category, sub_category FROM raw_orders GROUP BY ALL")}),
m_region AS (SELECT region, people_id FROM t_people WHERE region IS NOT NULL),
m_mode AS (SELECT ship_mode, ship_id FROM t_type_ship WHERE ship_mode IS NOT NULL),
m_place AS (SELECT country, city, state, postal_code, addresses_id FROM t_addresses),
m_item AS (SELECT product_id, product_name, product_code FROM t_product),
t_orders AS (
  SELECT order_id, order_date, people_id, customer_id, ship_id, addresses_id
  FROM g_order LEFT JOIN m_place USING (country, city, state, postal_code)
  LEFT JOIN m_mode USING (ship_mode) LEFT JOIN m_region USING (region)
  GROUP BY ALL
),
t_date_ship AS ({_numbered("date_ship", "SELECT order_id, ship_id, ship_date FROM g_shipment LEFT JOIN m_mode USING (ship_mode) GROUP BY ALL")}),
g_detail AS (
  SELECT order_id, product_code, quantity, sales, discount, profit
  FROM g_line LEFT JOIN m_item USING (product_id, product_name) GROUP BY ALL
),
t_order_details AS (
  SELECT CAST(row_number() OVER (ORDER BY {_nf(DETAIL_ORDER)}) AS BIGINT) AS detail_id, order_id, product_code, quantity,
         CAST(sales AS DECIMAL(12,4)) AS sales, CAST(discount AS DECIMAL(6,4)) AS discount,
         CAST(profit AS DECIMAL(12,4)) AS profit
  FROM g_detail
),
g_returned_line AS (
  SELECT r.returned, d.detail_id FROM t_order_details d JOIN g_return r USING (order_id) GROUP BY ALL
),
t_returns AS ({_numbered("returns", "SELECT * FROM g_returned_line")}),
t_returns_unfiltered AS ({_numbered("returns", """
  SELECT * FROM g_returned_line
  UNION
  SELECT returned, NULL FROM g_return r
  WHERE NOT EXISTS (SELECT 1 FROM t_order_details d WHERE d.order_id = r.order_id)""")})
"""


def with_ctes(body: str, raw: str = _FIXTURE_CTES) -> str:
    return f"WITH {raw}\n{TARGET_CTES}\n{body}"


def damaged(sql: str) -> str:
    """The check's SQL over a product table that lacks every seventh code and
    details of which every fiftieth is repeated."""
    return (sql.replace("t_product", "(SELECT * FROM t_product WHERE product_code % 7 <> 0)")
            .replace("t_order_details", "(SELECT * FROM t_order_details UNION ALL "
                                        "SELECT * FROM t_order_details WHERE detail_id % 50 = 0)"))


def target_sql(table: str) -> str:
    """SQL for one target table over existing raw_orders/raw_people/raw_returns
    views (used by tests on hand-made raw rows)."""
    return f"WITH {TARGET_CTES}\nSELECT * FROM t_{table}"


def _na(col: str) -> str:
    markers = ", ".join("'" + m.replace("'", "''") + "'" for m in MISSING)
    return f"CASE WHEN {col} IN ({markers}) THEN NULL ELSE {col} END AS {col}"


_RAW_STRING_COLS = ("order_id", "ship_mode", "customer_id", "customer_name", "segment", "country",
                    "city", "state", "region", "product_id", "category", "sub_category",
                    "product_name")
_RAW_COLS = ("order_id", "order_date", "ship_date", "ship_mode", "customer_id",
             "customer_name", "segment", "country", "city", "state", "postal_code", "region",
             "product_id", "category", "sub_category", "product_name", "sales", "quantity",
             "discount", "profit")


def _status(cond: str) -> str:
    return f"CASE WHEN coalesce({cond}, false) THEN 'OK' ELSE 'MISMATCH' END"


# Order lines as the store must hold them: an incompletely named product is none.
_LINES = ("SELECT DISTINCT order_id, CASE WHEN product_name IS NOT NULL THEN product_id END AS product_id, "
          "CASE WHEN product_id IS NOT NULL THEN product_name END AS product_name, "
          "quantity, sales, discount, profit FROM raw_orders")


def _row_counts_sql() -> str:
    expected = {
        "product": "SELECT count(*) FROM (SELECT DISTINCT product_id, category, sub_category, product_name FROM raw_orders)",
        "addresses": f"SELECT count(*) FROM (SELECT DISTINCT country, city, state, {postal_key_sql('postal_code')} FROM raw_orders)",
        "type_ship": "SELECT count(*) FROM (SELECT DISTINCT ship_mode FROM raw_orders)",
        "people": "SELECT count(*) FROM (SELECT DISTINCT person, region FROM raw_people)",
        "customers": "SELECT count(*) FROM (SELECT DISTINCT customer_id, customer_name, segment FROM raw_orders)",
        "orders": "SELECT count(*) FROM (SELECT DISTINCT order_id FROM raw_orders)",
        "date_ship": "SELECT count(*) FROM (SELECT DISTINCT order_id, ship_date, ship_mode FROM raw_orders)",
        "order_details": f"SELECT count(*) FROM ({_LINES})",
        "returns": ("SELECT coalesce(sum(n), 0) FROM (SELECT DISTINCT returned, order_id FROM raw_returns) r "
                    f"JOIN (SELECT order_id, count(*) AS n FROM ({_LINES}) GROUP BY order_id) l USING (order_id)"),
    }
    parts = []
    for name in PRIMARY_KEYS:
        parts.append(
            f"SELECT 'row_count' AS check_group, '{name}' AS check_name, "
            f"CAST(({expected[name]}) AS {VALUE}) AS expected, "
            f"CAST((SELECT count(*) FROM t_{name}) AS {VALUE}) AS actual")
    body = " UNION ALL ".join(parts)
    return f"SELECT check_group, check_name, expected, actual, {_status('expected = actual')} AS status FROM ({body})"


def _dup_sql(group: str, name: str, key: tuple[str, ...], skip_null: bool) -> str:
    keys = ", ".join(key)
    where = " WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in key) if skip_null else ""
    any_null = " OR ".join(f"{k} IS NULL" for k in key)
    label = f"{name}.{','.join(key)}"
    return (f"SELECT '{group}' AS check_group, '{label}' AS check_name, CAST(0 AS {VALUE}) AS expected, "
            f"CAST(bad AS {VALUE}) AS actual, CASE WHEN bad = 0 THEN 'OK' ELSE 'MISMATCH' END AS status "
            f"FROM (SELECT count(*) FILTER (WHERE n > 1 OR {any_null}) AS bad FROM "
            f"(SELECT {keys}, count(*) AS n FROM t_{name}{where} GROUP BY {keys}))")


def _pk_sql() -> str:
    return " UNION ALL ".join(_dup_sql("pk_unique", n, PRIMARY_KEYS[n], False) for n in PRIMARY_KEYS)


def _lookup_unique_sql() -> str:
    return " UNION ALL ".join(_dup_sql("lookup_unique", n, NATURAL_KEYS[n], True)
                              for n in NATURAL_KEYS)


def _fk_sql() -> str:
    parts = []
    for child, column, parent in RELATIONS:
        name = f"{child}.{column} -> {parent}"
        counts = (f"SELECT count(*) FILTER (WHERE c.{column} IS NOT NULL AND NOT EXISTS "
                  f"(SELECT 1 FROM t_{parent} p WHERE p.{column} = c.{column})) AS orphans, "
                  f"count(*) FILTER (WHERE c.{column} IS NULL) AS nulls FROM t_{child} c")
        parts.append(f"SELECT 'fk_orphans' AS check_group, '{name}' AS check_name, "
                     f"CAST(0 AS {VALUE}) AS expected, CAST(orphans AS {VALUE}) AS actual, "
                     f"CASE WHEN orphans = 0 THEN 'OK' ELSE 'MISMATCH' END AS status FROM ({counts})")
        parts.append(f"SELECT 'fk_nulls', '{name}', CAST(NULL AS {VALUE}), CAST(nulls AS {VALUE}), 'INFO' "
                     f"FROM ({counts})")
    return " UNION ALL ".join(parts)


def _totals_sql() -> str:
    lines = f"({_LINES})"

    def expected(col: str) -> str:
        return (f"(SELECT CAST(sum(CAST({col} AS DECIMAL(12,4))) AS {VALUE}) "
                f"FROM {lines})")

    def actual(col: str) -> str:
        return f"(SELECT CAST(sum({col}) AS {VALUE}) FROM t_order_details)"

    rows = (f"SELECT 'sum_sales' AS check_name, {expected('sales')} AS expected, "
            f"{actual('sales')} AS actual UNION ALL "
            f"SELECT 'sum_profit', {expected('profit')}, {actual('profit')}")
    return (f"SELECT 'control_total' AS check_group, check_name, expected, actual, "
            f"{_status('abs(actual - expected) < 1.0')} AS status FROM ({rows})")


def _sales_view_sql() -> str:
    return """
SELECT d.detail_id, d.order_id, o.order_date, o.customer_id, c.customer_name, c.segment,
       a.country, a.city, a.state, a.postal_code, p.region, p.person, ts.ship_mode,
       d.product_code, pr.product_id, pr.category, pr.sub_category, pr.product_name,
       d.quantity, d.sales, d.discount, d.profit,
       (r.detail_id IS NOT NULL) AS is_returned
FROM t_order_details d
LEFT JOIN t_orders o ON o.order_id = d.order_id
LEFT JOIN t_customers c ON c.customer_id = o.customer_id
LEFT JOIN t_addresses a ON a.addresses_id = o.addresses_id
LEFT JOIN t_people p ON p.people_id = o.people_id
LEFT JOIN t_type_ship ts ON ts.ship_id = o.ship_id
LEFT JOIN t_product pr ON pr.product_code = d.product_code
LEFT JOIN (SELECT DISTINCT detail_id FROM t_returns) r ON r.detail_id = d.detail_id
"""


def _counts_sql(names: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {src}"
        for label, src in names)


def _metrics_sql() -> str:
    rows = [f"SELECT '{n}' AS table_name, 'rows' AS metric, CAST(count(*) AS {VALUE}) AS value FROM t_{n}" for n in PRIMARY_KEYS]
    rows += [f"SELECT '{child}', 'null {column}', CAST(count(*) FILTER (WHERE {column} IS NULL) AS {VALUE}) FROM t_{child}"
             for child, column, _ in RELATIONS]
    rows += [f"SELECT 'order_details', 'sum {c}', CAST(sum({c}) AS {VALUE}) FROM t_order_details"
             for c in ("sales", "discount", "profit")]
    return " UNION ALL ".join(rows)


def _second_load_sql() -> dict[str, str]:
    """Tables of a load of the awkward rows that keeps the keys of a load of the clean
    ones: keys of rows seen before, and new ones in order after the largest."""
    grains = {
        "product": "SELECT DISTINCT product_id, category, sub_category, product_name FROM {}_orders",
        "addresses": f"SELECT DISTINCT country, city, state, {postal_key_sql('postal_code')} AS postal_code FROM {{}}_orders",
        "type_ship": "SELECT DISTINCT ship_mode FROM {}_orders",
        "people": "SELECT DISTINCT person, region FROM {}_people",
    }
    ctes, out = [], {}

    def numbered(name: str, key: str, order, columns, first: str, second: str) -> None:
        same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in columns)
        ctes.append(f"f_{name} AS (SELECT row_number() OVER (ORDER BY {_nf(order)}) AS {key}, * FROM ({first}))")
        ctes.append(f"s_{name} AS (SELECT a.*, b.{key} AS old FROM ({second}) a LEFT JOIN f_{name} b ON {same})")
        ctes.append(f"k_{name} AS (SELECT * EXCLUDE (old), CAST(coalesce(old, (SELECT max({key}) FROM f_{name}) + "
                    f"row_number() OVER (PARTITION BY old IS NULL ORDER BY {_nf(order)})) AS BIGINT) AS {key} FROM s_{name})")

    for name, grain in grains.items():
        key, order, columns = NUMBERED[name]
        numbered(name, key, order, columns, grain.format("clean"), grain.format("raw"))
        out[name] = f"SELECT {', '.join(STORED[name])} FROM k_{name}"
    lines = ("SELECT DISTINCT order_id, product_code, quantity, sales, discount, profit FROM {0}_orders o "
             "LEFT JOIN {1}_product p ON p.product_id = o.product_id AND p.product_name = o.product_name")
    numbered("order_details", "detail_id", DETAIL_ORDER, DETAIL_ORDER, lines.format("clean", "f"), lines.format("raw", "k"))
    out["order_details"] = ("SELECT detail_id, order_id, product_code, quantity, CAST(sales AS DECIMAL(12,4)) AS sales, "
                            "CAST(discount AS DECIMAL(6,4)) AS discount, CAST(profit AS DECIMAL(12,4)) AS profit FROM k_order_details")
    return {name: f"WITH {', '.join(ctes)} {sql}" for name, sql in out.items()}


def oracle_queries() -> dict[str, str]:
    raw_select = ", ".join(_na(c) if c in _RAW_STRING_COLS else c for c in _RAW_COLS)
    locale_text = "translate(format('{:,.2f}', l_extendedprice), ',.', ' ,')"
    postal_double = ("CASE WHEN c_custkey % 50 = 7 THEN CAST(NULL AS DOUBLE) "
                     "ELSE CAST((c_custkey % 50) * 1999 AS DOUBLE) END")
    body = {
        "scan_raw_orders": f"SELECT {raw_select} FROM raw_orders",
        "scan_csv_sheets": f"SELECT {raw_select} FROM raw_orders",
        "csv_with_rejects": """
            SELECT * FROM (WITH n AS (SELECT *, CAST(substr(order_id, 3) AS BIGINT) AS o, CAST(substr(customer_id, 3) AS BIGINT) AS c FROM raw_orders),
            f AS (SELECT *, concat_ws(',', CASE WHEN c % 41 = 0 THEN 'order_date' END, CASE WHEN o % 31 = 0 THEN 'quantity' END) AS failed FROM n)
            SELECT order_id, product_id, CASE WHEN c % 19 = 0 THEN customer_name || ', "the' || chr(10) || 'third"' ELSE customer_name END AS customer_name,
              CASE WHEN o % 31 = 0 THEN 'many' WHEN o % 37 = 0 THEN CASE WHEN failed <> '' THEN 'NA' END ELSE CAST(quantity AS VARCHAR) END AS quantity,
              CASE WHEN c % 41 = 0 THEN 'some day' ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
              CASE WHEN o % 43 = 0 THEN NULL ELSE CAST(sales AS VARCHAR) END AS sales, failed
            FROM f)""",
        "lookup_product_hot": """
            SELECT * FROM (WITH h AS (SELECT product_id AS h_id, product_name AS h_name FROM raw_orders ORDER BY product_id, product_name LIMIT 1),
            l AS (SELECT order_id, quantity, CASE CAST(substr(order_id, 3) AS BIGINT) % 9 WHEN 0 THEN h_id WHEN 3 THEN h_id WHEN 6 THEN h_id
                    WHEN 1 THEN NULL ELSE product_id END AS product_id,
                  CASE CAST(substr(order_id, 3) AS BIGINT) % 9 WHEN 0 THEN h_name WHEN 3 THEN h_name WHEN 6 THEN h_name
                    WHEN 1 THEN NULL ELSE product_name END AS product_name FROM raw_orders, h)
            SELECT l.*, p.product_code FROM l LEFT JOIN t_product p ON p.product_id = l.product_id AND p.product_name = l.product_name)""",
        "raw_counts": _counts_sql([("raw_orders", "raw_orders"), ("raw_people", "raw_people"),
                                   ("raw_returns", "raw_returns")]),
        "parse_locale_number": (
            f"SELECT l_orderkey, l_linenumber, {locale_text} AS price_text, "
            f"TRY_CAST(replace(replace({locale_text}, ' ', ''), ',', '.') AS DOUBLE) AS price_parsed "
            f"FROM lineitem"),
        "postal_normalize": (
            f"SELECT concat('C-', CAST(c_custkey AS VARCHAR)) AS customer_id, {postal_double} AS postal_code, "
            f"{postal_sql(postal_double)} AS postal_norm FROM customer"),
        "parse_dates": (
            "SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ship_date_text, "
            "CAST(strptime(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) "
            "AS ship_date_parsed FROM lineitem"),
        "format_dates": (
            "SELECT concat('O-', CAST(o_orderkey AS VARCHAR)) AS order_id, "
            "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date_text FROM orders"),
        "null_sentinels": (
            "SELECT DISTINCT o.order_id, o.product_id, o.product_name, coalesce(o.region, '-') AS region_key, "
            "coalesce(CAST(p.product_code AS VARCHAR), '-') AS product_code_text FROM raw_orders o "
            "LEFT JOIN t_product p ON p.product_id = o.product_id AND p.product_name = o.product_name"),
        "decimal_cast": (
            "SELECT order_id, product_id, product_name, quantity, CAST(sales AS DECIMAL(12,4)) AS sales, "
            "CAST(discount AS DECIMAL(6,4)) AS discount, CAST(profit AS DECIMAL(12,4)) AS profit FROM "
            "(SELECT DISTINCT order_id, product_id, product_name, quantity, sales, discount, profit FROM raw_orders)"),
        "dim_product": "SELECT DISTINCT product_id, category, sub_category, product_name FROM raw_orders",
        "dim_addresses": (f"SELECT DISTINCT country, city, state, {postal_key_sql('postal_code')} AS postal_code "
                          f"FROM raw_orders"),
        "dim_ship_mode": "SELECT DISTINCT ship_mode FROM raw_orders",
        "dim_people": "SELECT DISTINCT person, region FROM raw_people",
        "dim_customers": "SELECT * FROM t_customers",
        "keyed_product": "SELECT * FROM t_product",
        "keyed_addresses": "SELECT * FROM t_addresses",
        "keyed_ship_mode": "SELECT * FROM t_type_ship",
        "keyed_people": "SELECT * FROM t_people",
        "keyed_order_details": "SELECT * FROM t_order_details",
        "keyed_date_ship": "SELECT * FROM t_date_ship",
        "keyed_returns": "SELECT * FROM t_returns",
        "lookup_people": ("SELECT o.order_id, o.region, p.people_id FROM (SELECT DISTINCT order_id, region "
                          "FROM raw_orders) o LEFT JOIN t_people p ON p.region = o.region"),
        "lookup_ship_mode": ("SELECT o.order_id, o.ship_mode, ts.ship_id FROM (SELECT DISTINCT order_id, ship_mode "
                             "FROM raw_orders) o LEFT JOIN t_type_ship ts ON ts.ship_mode = o.ship_mode"),
        "lookup_addresses": (
            f"SELECT o.order_id, o.country, o.city, o.state, o.postal_code, a.addresses_id FROM "
            f"(SELECT DISTINCT order_id, country, city, state, {postal_key_sql('postal_code')} AS postal_code "
            f"FROM raw_orders) o LEFT JOIN t_addresses a ON a.country = o.country AND a.city = o.city "
            f"AND a.state = o.state AND a.postal_code = o.postal_code"),
        "lookup_product": ("SELECT o.product_id, o.product_name, p.product_code FROM (SELECT DISTINCT product_id, "
                           "product_name FROM raw_orders) o LEFT JOIN t_product p ON p.product_id = o.product_id "
                           "AND p.product_name = o.product_name"),
        "fact_orders": "SELECT * FROM t_orders",
        "fact_date_ship": "SELECT * FROM t_date_ship",
        "fact_order_details": "SELECT * FROM t_order_details",
        "fact_returns": "SELECT * FROM t_returns",
        "returns_unfiltered": "SELECT * FROM t_returns_unfiltered",
        "orders_sorted": (f"SELECT *, row_number() OVER (ORDER BY {_nf(('order_date', 'customer_id', 'order_id'))}) "
                          f"AS place FROM t_orders"),
        "flat_orders": f"SELECT {', '.join(_RAW_COLS)} FROM raw_orders",
        "flat_people": ("SELECT person, region FROM (SELECT person, region, row_number() OVER "
                        "(PARTITION BY region ORDER BY seq, person NULLS FIRST) AS rn FROM raw_people_seq) "
                        "WHERE rn = 1"),
        "flat_returns": ("SELECT returned, order_id FROM (SELECT returned, order_id, row_number() OVER "
                         "(PARTITION BY order_id ORDER BY seq, returned NULLS FIRST) AS rn FROM raw_returns_seq) "
                         "WHERE rn = 1"),
        "sink_roundtrip": " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in cols)}) AS row_text "
            f"FROM t_{n}" for n, cols in STORED.items()),
        "check_pk_unique": _pk_sql(),
        "check_lookup_unique": _lookup_unique_sql(),
        "check_fk_orphans": _fk_sql(),
        "check_row_counts": _row_counts_sql(),
        "check_control_totals": _totals_sql(),
        "validation_report": (
            f"SELECT *, bool_and(CASE WHEN status = 'INFO' THEN true ELSE status = 'OK' END) OVER () "
            f"AS all_passed FROM ({_row_counts_sql()} UNION ALL {_pk_sql()} UNION ALL "
            f"{_lookup_unique_sql()} UNION ALL {_fk_sql()} UNION ALL {_totals_sql()})"),
        "write_metrics": _metrics_sql(),
        "resumed_load": "SELECT *, table_name IN ('product', 'addresses', 'type_ship', 'people') AS taken_up, 5 AS tables_written "
                        f"FROM ({_counts_sql([(n, f't_{n}') for n in PRIMARY_KEYS])})",
        "sales_view": _sales_view_sql(),
        "sales_by_region_category": (
            "SELECT p.region, pr.category, CAST(count(*) AS BIGINT) AS lines, "
            "CAST(count(*) FILTER (WHERE r.detail_id IS NOT NULL) AS BIGINT) AS returned_lines, "
            "CAST(sum(d.sales) AS DECIMAL(38,4)) AS total_sales, "
            "CAST(sum(d.profit) AS DECIMAL(38,4)) AS total_profit "
            "FROM t_order_details d "
            "LEFT JOIN (SELECT DISTINCT detail_id FROM t_returns) r ON r.detail_id = d.detail_id "
            "LEFT JOIN t_orders o ON o.order_id = d.order_id "
            "LEFT JOIN t_people p ON p.people_id = o.people_id "
            "LEFT JOIN t_product pr ON pr.product_code = d.product_code "
            "GROUP BY p.region, pr.category"),
    }
    body["validation_report_scanned"] = body["validation_report"]
    raw_of = {name: _FIXTURE_CTES for name in body}
    edge = {
        "edge_scan": f"SELECT {', '.join(_RAW_COLS)} FROM raw_orders",
        "edge_null_sentinels": body["null_sentinels"],
        "edge_postal": (f"SELECT DISTINCT customer_id, postal_code, {postal_sql('postal_code')} AS postal_norm "
                        f"FROM raw_orders"),
        **{f"edge_{name}": f"SELECT * FROM t_{name}" for name in PRIMARY_KEYS},
        "edge_returns_unfiltered": body["returns_unfiltered"],
        "edge_flat_people": body["flat_people"],
        "edge_flat_returns": body["flat_returns"],
        "edge_check_pk_unique": damaged(_pk_sql()),
        "edge_check_lookup_unique": damaged(_lookup_unique_sql()),
        "edge_check_fk_orphans": damaged(_fk_sql()),
        "edge_check_row_counts": damaged(_row_counts_sql()),
        "edge_sales_view": _sales_view_sql(),
        "edge_write_metrics": _metrics_sql(),
        "colocated_returns": "SELECT * FROM t_returns",
        "colocated_sales_view": _sales_view_sql(),
        **{f"second_load_{name}": f"SELECT * FROM ({sql})" for name, sql in _second_load_sql().items()},
        "lookup_product_shuffled": body["lookup_product"],
        "fact_orders_shuffled": "SELECT * FROM t_orders",
        "fact_order_details_shuffled": "SELECT * FROM g_detail",
    }
    body |= edge
    raw_of |= {name: _EDGE_CTES for name in edge}
    from .catalog import DECIMAL_OUTPUTS
    out = {}
    for name, sql in body.items():
        cols = DECIMAL_OUTPUTS.get(name)
        if cols:
            casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
            sql = f"SELECT * REPLACE ({casts}) FROM ({sql}) q"
        out[name] = with_ctes(sql, raw_of[name])
    return out
