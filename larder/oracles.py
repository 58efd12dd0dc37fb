"""DuckDB SQL for every query, written against the raw tables on its own terms."""

from __future__ import annotations

import re

# Views over the raw tables (see FIXTURES.md).
_VIEWS = {
    "fx_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE o_orderstatus WHEN 'F' THEN ' Prior ' WHEN 'O' THEN 'TRAIN' ELSE 'test' END
                   AS eval_set,
               CAST(o_orderkey % 100 + 1 AS INTEGER) AS order_number,
               CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
               CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
               CASE WHEN o_orderkey % 100 > 0 THEN CAST(o_orderkey % 31 AS DOUBLE) END
                   AS days_since_prior_order
        FROM orders""",
    "fx_aisles": """
        SELECT DISTINCT CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS aisle_id,
               p_type AS aisle FROM part""",
    "fx_departments": """
        SELECT DISTINCT CAST('0x' || substr(md5(p_brand), 1, 15) AS BIGINT) AS department_id,
               p_brand AS department FROM part""",
    "fx_products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS aisle_id,
               CAST('0x' || substr(md5(p_brand), 1, 15) AS BIGINT) AS department_id
        FROM part""",
    "fx_prior": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               l_linenumber AS add_to_cart_order,
               CAST(l_returnflag = 'R' AS INTEGER) AS reordered
        FROM lineitem WHERE l_linestatus = 'F'""",
    "fx_train": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               l_linenumber AS add_to_cart_order,
               CAST(l_returnflag = 'R' AS INTEGER) AS reordered
        FROM lineitem WHERE l_linestatus = 'O'""",
    "merged": "SELECT * FROM fx_prior UNION ALL SELECT * FROM fx_train",
    "lines": """
        SELECT order_id, product_id, add_to_cart_order, max(reordered) AS reordered
        FROM merged GROUP BY order_id, product_id, add_to_cart_order""",
    "enriched": """
        SELECT product_id, trim(regexp_replace(product_name, '\\s+', ' ', 'g')) AS product_name,
               lower(aisle) AS aisle, lower(department) AS department
        FROM fx_products LEFT JOIN fx_aisles USING (aisle_id)
        LEFT JOIN fx_departments USING (department_id)""",
    "fact": """
        SELECT order_id, user_id, product_id, product_name, aisle, department,
               add_to_cart_order, reordered, order_dow, order_hour_of_day
        FROM lines JOIN fx_orders USING (order_id) JOIN enriched USING (product_id)""",
    "products_kpi": """
        SELECT product_id, product_name, count(*) AS total_orders,
               CAST(sum(reordered) AS BIGINT) AS total_reorders,
               CAST(sum(reordered) AS DOUBLE) / count(*) AS reorder_rate
        FROM fact GROUP BY product_id, product_name""",
    "departments_kpi": """
        SELECT department, count(*) AS total_products_sold,
               count(DISTINCT user_id) AS unique_customers
        FROM fact WHERE department IS NOT NULL GROUP BY department""",
    "order_level": """
        SELECT order_id, user_id, count(*) AS basket_size
        FROM fact GROUP BY order_id, user_id""",
    "customers_kpi": """
        SELECT user_id, count(*) AS total_orders, CAST(sum(basket_size) AS BIGINT) AS total_products,
               avg(basket_size) AS avg_basket_size
        FROM order_level GROUP BY user_id""",
    # untidy inputs
    "messy_base": """
        SELECT * REPLACE (CASE WHEN order_dow <> 3 THEN user_id END AS user_id,
                          order_number - 1 AS order_number)
        FROM fx_orders""",
    "messy_orders": """
        SELECT * FROM messy_base UNION ALL
        SELECT * REPLACE (order_hour_of_day + 1 AS order_hour_of_day)
        FROM messy_base WHERE eval_set = 'test'""",
    "messy_parts": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_size = 1 THEN '   '
                    WHEN p_size <> 2
                    THEN '  ' || upper(p_name) || chr(9) || '  ' || p_type || ' ' END
                   AS product_name,
               CASE WHEN p_size <> 3 THEN CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) END
                   AS aisle_id,
               CAST('0x' || substr(md5(p_brand), 1, 15) AS BIGINT) AS department_id
        FROM part""",
    "messy_products": """
        SELECT * FROM messy_parts UNION ALL
        SELECT * REPLACE ('A second ' || product_name AS product_name) FROM messy_parts""",
    "messy_lines": """
        SELECT order_id, product_id, add_to_cart_order - 1 AS add_to_cart_order, reordered
        FROM fx_prior UNION ALL
        SELECT order_id, product_id, add_to_cart_order - 1,
               CASE WHEN add_to_cart_order = 2 THEN 2 ELSE 1 - reordered END
        FROM fx_prior UNION ALL
        SELECT * FROM fx_train""",
    "tidy_orders": """
        SELECT order_id, user_id, lower(trim(eval_set)) AS eval_set, order_number, order_dow,
               order_hour_of_day, days_since_prior_order
        FROM messy_orders
        WHERE user_id IS NOT NULL AND order_number >= 1 AND order_hour_of_day BETWEEN 0 AND 23
        QUALIFY row_number() OVER (
            PARTITION BY order_id
            ORDER BY user_id DESC, order_dow DESC, order_hour_of_day DESC, order_number DESC) = 1""",
    "tidy_products": """
        SELECT product_id, name AS product_name, aisle_id, department_id
        FROM (SELECT *, trim(regexp_replace(product_name, '\\s+', ' ', 'g')) AS name
              FROM messy_products WHERE product_name IS NOT NULL AND aisle_id IS NOT NULL)
        WHERE length(name) > 0
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY name DESC) = 1""",
    "tidy_lines": """
        SELECT order_id, product_id, add_to_cart_order, max(reordered) AS reordered
        FROM messy_lines
        WHERE add_to_cart_order >= 1 AND reordered IN (0, 1)
          AND order_id IN (SELECT order_id FROM tidy_orders)
          AND product_id IN (SELECT product_id FROM tidy_products)
        GROUP BY order_id, product_id, add_to_cart_order""",
    "tidy_fact": """
        SELECT order_id, user_id, product_id, product_name, lower(aisle) AS aisle,
               lower(department) AS department, add_to_cart_order, reordered, order_dow,
               order_hour_of_day
        FROM tidy_lines JOIN tidy_orders USING (order_id) JOIN tidy_products USING (product_id)
        LEFT JOIN fx_aisles USING (aisle_id) LEFT JOIN fx_departments USING (department_id)""",
    # reports
    "reports": """
        SELECT doc_id, lang, source, CASE lang
            WHEN 'en' THEN '## Executive Summary' || chr(10) || text || chr(10)
                || '## Key Business Recommendations' || chr(10) || '1. ' || lang || chr(10)
                || '2) ' || source
            WHEN 'de' THEN source || chr(13) || chr(10) || '## Basket-Size Analysis' || chr(10)
                || '## Executive Summary' || chr(10) || 'first' || chr(10)
                || '## Executive Summary' || chr(10) || chr(10) || '  ' || text || '  ' || chr(10)
            WHEN 'fr' THEN text || chr(10) || ' 12. ' || source || chr(10) || '3) ' || chr(10)
                || '4 x' || chr(10)
            ELSE '## Notes' || chr(10) || 'first' || chr(10) || '## Executive Summary' || chr(13)
                || chr(10) || text || chr(10) || '## Notes' || chr(10) || chr(10) || '1. '
                || source || chr(10)
            END AS text
        FROM documents
        UNION ALL
        SELECT -1 - doc_id, lang, source, NULL FROM documents
        WHERE coalesce(lang, '') NOT IN ('en', 'de', 'fr')""",
    "report_lines": """
        SELECT doc_id, line_no, line FROM (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no
            FROM (SELECT doc_id, string_split(
                      regexp_replace(regexp_replace(text, '\\r\\n|\\r', chr(10), 'g'), '\\n$', ''),
                      chr(10)) AS lines
                  FROM reports WHERE text <> ''))""",
    "report_marks": """
        SELECT *, starts_with(line, '## ') AS is_heading,
               count(*) FILTER (starts_with(line, '## '))
                   OVER (PARTITION BY doc_id ORDER BY line_no) AS section_at
        FROM report_lines""",
    "report_bodies": """
        SELECT doc_id, section_at,
               coalesce(max(replace(replace(lower(trim(substr(line, 4))), ' ', '_'), '-', '_'))
                            FILTER (is_heading), 'introduction') AS section,
               regexp_replace(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT is_heading),
                              '^\\s+|\\s+$', '', 'g') AS body
        FROM report_marks GROUP BY doc_id, section_at
        HAVING count(*) FILTER (NOT is_heading) > 0""",
    "found_sections": """
        SELECT doc_id, section, body,
               CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_at) - 1 AS INTEGER)
                   AS section_no
        FROM (SELECT doc_id, section, min(section_at) AS first_at,
                     arg_max(body, section_at) AS body
              FROM report_bodies GROUP BY doc_id, section)""",
    "advice": """
        SELECT doc_id, CAST(item_at - 1 AS INTEGER) AS item_no, recommendation FROM (
            SELECT doc_id, unnest(items) AS recommendation, generate_subscripts(items, 1) AS item_at
            FROM (SELECT doc_id, list_filter(
                      list_transform(
                          regexp_extract_all(text, '(?m)^\\s*\\d+[.)]\\s*(.+)$', 1),
                          lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')),
                      lambda x: x <> '') AS items
                  FROM reports WHERE text IS NOT NULL))""",
}


# KPI views, which also exist over the tidied inputs, as tidy_...
_KPI_VIEWS = ("products_kpi", "departments_kpi", "order_level", "customers_kpi")


def _with(*wanted: str, query: str) -> str:
    """The query under the views it names, in the order they are defined above."""
    needed = set(wanted)
    for name in reversed(_VIEWS):
        if name in needed:
            needed |= {other for other in _VIEWS if _names(other, _VIEWS[name])}
    parts = [f"{name} AS ({_VIEWS[name].strip()})" for name in _VIEWS if name in needed]
    return f"WITH {', '.join(parts)} {query.strip()}" if parts else query.strip()


def _names(view: str, text: str) -> bool:
    return view in text.replace("(", " ").replace(")", " ").replace(",", " ").split()


def _sql(query: str) -> str:
    return _with(*[view for view in _VIEWS if _names(view, query)], query=query)


def _round(expression: str, places: int) -> str:
    return f"CAST(format('{{:.{places}f}}', CAST({expression} AS DOUBLE)) AS DOUBLE)"


def _position(order: str) -> str:
    return f"CAST(row_number() OVER (ORDER BY {order}) AS INTEGER)"


def _contents(tables: dict[str, tuple[str, str, str, str]]) -> str:
    """Rows and value sums; a table comes with its whole, fractional and text columns."""

    def total(terms: list[str]) -> str:
        return f"CAST(coalesce(sum({' + '.join(terms) or '0'}), 0) AS BIGINT)"

    return " UNION ALL ".join(
        f"""SELECT '{name}' AS dataset, count(*) AS n_rows,
            {total([f'coalesce({c} % 1000003, 0)' for c in whole.split()]
                   + [f'coalesce(CAST(floor({c} * 1000 + 0.5) AS BIGINT), 0)'
                      for c in fractions.split()])} AS numbers,
            {total([f'coalesce(strlen({c}), 0)' for c in texts.split()])} AS letters
            FROM {source}"""
        for name, (source, whole, fractions, texts) in tables.items()
    )


_ORDER_PARTS = (
    "order_id user_id order_number order_dow order_hour_of_day",
    "days_since_prior_order",
    "eval_set",
)
_PRODUCT_PARTS = ("product_id aisle_id department_id", "", "product_name")
_LINE_PARTS = ("order_id product_id add_to_cart_order reordered", "", "")
_NAME_PARTS = {name: (f"{name}_id", "", name) for name in ("aisle", "department")}

_BY_ORDERS = "total_orders DESC, product_id"
_BY_RATE = "reorder_rate DESC, product_id"
_BY_SOLD = "total_products_sold DESC, department"
_BY_VISITS = "total_orders DESC, user_id"

_ORDER_COLUMNS = {
    "order_id": "bigint",
    "user_id": "bigint",
    "eval_set": "string",
    "order_number": "int",
    "order_dow": "int",
    "order_hour_of_day": "int",
    "days_since_prior_order": "double",
}
_PRODUCT_COLUMNS = {
    "product_id": "bigint",
    "product_name": "string",
    "aisle_id": "bigint",
    "department_id": "bigint",
}
_LINE_COLUMNS = {
    "order_id": "bigint",
    "product_id": "bigint",
    "add_to_cart_order": "int",
    "reordered": "int",
}


def _check(dataset, kind, column, metric, value, status) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{kind}' AS check_type, '{column}' AS column_name, "
        f"'{metric}' AS metric_name, {value} AS metric_value, {status} AS status"
    )


def _schema_rows(dataset, columns, missing="", extra="", mistyped=None) -> list[str]:
    def fixed(column, metric, value, status):
        return _check(dataset, "schema", column, metric, f"'{value}'", f"'{status}'")

    rows = [
        fixed("*", "missing_columns", missing or "none", "FAIL" if missing else "PASS"),
        fixed("*", "extra_columns", extra or "none", "WARN" if extra else "PASS"),
    ]
    for column, kind in columns.items():
        if column != missing:
            actual = (mistyped or {}).get(column, kind)
            verdict = "PASS" if actual == kind else "FAIL"
            rows.append(fixed(column, "expected_type", kind, verdict))
            rows.append(fixed(column, "actual_type", actual, verdict))
    return rows


def _null_rows(dataset, source, columns) -> list[str]:
    rows = []
    for column in columns:
        n = f"count(*) FILTER ({column} IS NULL)"
        status = f"CASE WHEN {n} = 0 THEN 'PASS' ELSE 'WARN' END"
        share = f"printf('%.4f', {_round(f'{n} * 100.0 / count(*)', 4)})"
        for metric, value in (("null_count", f"CAST({n} AS VARCHAR)"), ("null_pct", share)):
            rows.append(f"{_check(dataset, 'null', column, metric, value, status)} FROM {source}")
    return rows


def _cast_rows(dataset, source, columns, bad=None) -> list[str]:
    rows = []
    for column in columns:
        n = f"count(*) FILTER ({(bad or {}).get(column, 'false')})"
        status = f"CASE WHEN {n} = 0 THEN 'PASS' ELSE 'FAIL' END"
        check = _check(
            dataset, "dtype", column, "invalid_cast_count", f"CAST({n} AS VARCHAR)", status
        )
        rows.append(f"{check} FROM {source}")
    return rows


def _duplicate_rows(dataset, source, key) -> list[str]:
    keys = ",".join(key)
    # a row of all keys is never null itself, so null keys count as one more value
    distinct = f"count(DISTINCT row({keys}))"
    excess = f"(count(*) - {distinct})"
    status = f"CASE WHEN {excess} = 0 THEN 'PASS' ELSE 'WARN' END"
    metrics = [
        ("total_rows", "count(*)", "'INFO'"),
        ("distinct_keys", distinct, "'INFO'"),
        ("duplicate_rows", excess, status),
    ]
    return [
        f"{_check(dataset, 'duplicate', keys, metric, f'CAST({value} AS VARCHAR)', verdict)} "
        f"FROM {source}"
        for metric, value, verdict in metrics
    ]


def _all_checks() -> str:
    aisle = {"aisle_id": "bigint", "aisle": "string"}
    department = {"department_id": "bigint", "department": "string"}
    noted = "(SELECT *, 'x' AS note FROM fx_departments)"
    rows = [
        *_schema_rows("orders", _ORDER_COLUMNS),
        *_null_rows("orders", "messy_orders", _ORDER_COLUMNS),
        *_cast_rows("orders", "messy_orders", _ORDER_COLUMNS),
        *_duplicate_rows("orders", "messy_orders", ["order_id"]),
        *_schema_rows("products", _PRODUCT_COLUMNS),
        *_null_rows("products", "messy_products", _PRODUCT_COLUMNS),
        *_cast_rows("products", "messy_products", _PRODUCT_COLUMNS),
        *_duplicate_rows("products", "messy_products", ["product_id"]),
        *_schema_rows("departments", department, extra="note"),
        *_null_rows("departments", noted, [*department, "note"]),
        *_cast_rows("departments", "fx_departments", department),
        *_duplicate_rows("departments", "fx_departments", ["department_id"]),
        *_schema_rows("aisles", aisle, mistyped={"aisle_id": "string"}),
        *_null_rows("aisles", "fx_aisles", aisle),
        *_cast_rows("aisles", "fx_aisles", aisle),
        *_duplicate_rows("aisles", "fx_aisles", ["aisle_id"]),
        *_schema_rows("order_products__prior", _LINE_COLUMNS),
        *_schema_rows("order_products__train", _LINE_COLUMNS, missing="reordered"),
        *_schema_rows("order_products_merged", _LINE_COLUMNS),
        *_null_rows("order_products_merged", "merged", _LINE_COLUMNS),
        *_cast_rows("order_products_merged", "merged", _LINE_COLUMNS),
        *_duplicate_rows("order_products_merged", "merged", list(_LINE_COLUMNS)[:3]),
    ]
    return " UNION ALL ".join(rows)


_BUCKETS = [
    ("1", "basket_size = 1"),
    ("2", "basket_size = 2"),
    ("3-4", "basket_size BETWEEN 3 AND 4"),
    ("5-9", "basket_size BETWEEN 5 AND 9"),
    ("10-19", "basket_size BETWEEN 10 AND 19"),
    ("20-49", "basket_size BETWEEN 20 AND 49"),
    ("50-99", "basket_size BETWEEN 50 AND 99"),
    ("100+", "basket_size >= 100"),
]
_SEGMENT = """CASE WHEN total_orders = 1 THEN 'Single Order'
    WHEN total_orders BETWEEN 2 AND 5 THEN 'Occasional (2-5)'
    WHEN total_orders BETWEEN 6 AND 10 THEN 'Regular (6-10)'
    WHEN total_orders BETWEEN 11 AND 20 THEN 'Loyal (11-20)'
    ELSE 'Power User (21+)' END"""
_OVERVIEW = """
    (SELECT count(DISTINCT product_id) FROM products_kpi) AS total_unique_products,
    (SELECT count(DISTINCT department) FROM departments_kpi) AS total_departments,
    (SELECT count(DISTINCT order_id) FROM order_level) AS total_orders,
    (SELECT count(DISTINCT user_id) FROM customers_kpi) AS total_customers,
    (SELECT CAST(sum(basket_size) AS BIGINT) FROM order_level) AS total_line_items"""


def _shown(*columns: str) -> str:
    """Columns as documents show them: rates and means to four decimals."""
    return ", ".join(
        f"{_round(c, 4)} AS {c}" if c in ("reorder_rate", "avg_basket_size") else c
        for c in columns
    )


_TOP_PRODUCTS = f"""SELECT {_shown('product_id', 'product_name', 'total_orders',
    'total_reorders', 'reorder_rate')}, {_position(_BY_ORDERS)} AS position
    FROM products_kpi ORDER BY position LIMIT %d"""
_TOP_RATES = f"""SELECT {_shown('product_id', 'product_name', 'reorder_rate')},
    {_position(_BY_RATE)} AS position FROM products_kpi ORDER BY position LIMIT %d"""
_TOP_CUSTOMERS = f"""SELECT {_shown('user_id', 'total_orders', 'total_products',
    'avg_basket_size')}, {_position(_BY_VISITS)} AS position
    FROM customers_kpi ORDER BY position LIMIT %d"""
_TOP_DEPARTMENTS = f"""SELECT department, total_products_sold, unique_customers,
    {_position(_BY_SOLD)} AS position FROM departments_kpi ORDER BY position LIMIT %d"""


def _means(names: dict[str, str], at_least: int, share: str) -> str:
    mean = names.get("avg_basket_size", "avg_basket_size")
    single = names.get("single", "single_order_customer_pct")
    return f"""
        {_round('avg(total_orders)', 2)} AS avg_orders_per_customer,
        {_round('median(total_orders)', 2)} AS median_orders_per_customer,
        {_round('avg(total_products)', 2)} AS avg_products_per_customer,
        {_round('avg(avg_basket_size)', 2)} AS {mean},
        {_round('count(*) FILTER (total_orders = 1) * 100.0 / count(*)', 2)} AS {single},
        {_round(f'count(*) FILTER (total_orders >= {at_least}) * 100.0 / count(*)', 2)} AS {share}"""


_TRENDS = _means(
    {
        "avg_basket_size": "avg_basket_size_per_customer",
        "single": "customers_with_single_order_pct",
    },
    10,
    "customers_with_10plus_orders_pct",
)
_SIZES = f"""
    {_round('avg(basket_size)', 2)} AS mean_basket_size,
    {_round('median(basket_size)', 2)} AS median_basket_size,
    min(basket_size) AS min_basket_size, max(basket_size) AS max_basket_size,
    {_round('stddev_samp(basket_size)', 2)} AS std_basket_size"""


_SEGMENTATION = f"""
    SELECT {_SEGMENT} AS segment, count(*) AS customers,
           {_round('count(*) * 100.0 / (SELECT count(*) FROM customers_kpi)', 2)} AS percentage,
           {_round('avg(avg_basket_size)', 2)} AS avg_basket_size,
           {_round('avg(total_products)', 2)} AS avg_products
    FROM customers_kpi GROUP BY 1"""
_FREQUENCY = """
    SELECT total_orders AS orders, count(*) AS customers FROM customers_kpi
    GROUP BY total_orders ORDER BY total_orders LIMIT 15"""


def _list(select: str, *fields: str) -> str:
    packed = ", ".join(f"'{f}': {f}" for f in fields)
    return f"(SELECT list({{{packed}}} ORDER BY position) FROM ({select}))"


def _summary_document() -> str:
    product = ("product_id", "product_name", "total_orders", "total_reorders", "reorder_rate")
    rates = _list(_TOP_RATES % 10, "product_id", "product_name", "reorder_rate")
    customers = _list(
        _TOP_CUSTOMERS % 5, "user_id", "total_orders", "total_products", "avg_basket_size"
    )
    buckets = ", ".join(f"'{b}': count(*) FILTER ({test})" for b, test in _BUCKETS)
    overview = ("total_unique_products", "total_departments", "total_orders", "total_customers",
                "total_line_items")
    sizes = ("mean_basket_size", "median_basket_size", "min_basket_size", "max_basket_size",
             "std_basket_size")

    def packed(names) -> str:
        return ", ".join(f"'{n}': {n}" for n in names)

    return f"""
        SELECT CAST(to_json({{
            'dataset_overview': (SELECT {{{packed(overview)}}} FROM (SELECT {_OVERVIEW})),
            'top_performing_products': {{
                'description': 'Top 10 products by total order volume',
                'products': {_list(_TOP_PRODUCTS % 10, *product)}}},
            'most_reordered_products': {{
                'description': 'Top 10 products by reorder rate', 'products': {rates}}},
            'best_performing_departments': {{
                'description': 'Top 10 departments by products sold',
                'departments': {_list(_TOP_DEPARTMENTS % 10, 'department',
                                      'total_products_sold', 'unique_customers')}}},
            'basket_size_analysis': (
                SELECT {{{packed(sizes)}, 'distribution_by_size_bucket': spread}}
                FROM (SELECT {_SIZES}, {{{buckets}}} AS spread FROM order_level)),
            'customer_purchasing_trends': (SELECT {{
                'avg_orders_per_customer': avg_orders_per_customer,
                'avg_products_per_customer': avg_products_per_customer,
                'avg_basket_size_per_customer': avg_basket_size_per_customer,
                'median_orders_per_customer': median_orders_per_customer,
                'top_customers_by_orders': {customers},
                'customers_with_single_order_pct': customers_with_single_order_pct,
                'customers_with_10plus_orders_pct': customers_with_10plus_orders_pct}}
                FROM (SELECT {_TRENDS} FROM customers_kpi)),
            'reorder_highlights': (SELECT {{
                'overall_avg_reorder_rate': {_round('avg(reorder_rate)', 4)},
                'products_with_reorder_rate_above_50pct':
                    count(*) FILTER (reorder_rate > 0.5),
                'top_reorder_rate_products': {rates}}} FROM products_kpi)
        }}) AS VARCHAR) AS document"""


def _documents() -> str:
    """The six dashboard documents, from the tidied inputs, without a report."""
    product = ("product_id", "product_name", "total_orders", "total_reorders", "reorder_rate")
    rate = ("product_id", "product_name", "reorder_rate")
    customer = ("user_id", "total_orders", "total_products", "avg_basket_size")

    def packed(names) -> str:
        return ", ".join(f"'{n}': {n}" for n in names)

    sizes = ("total_orders", "total_line_items", "mean_basket_size", "median_basket_size",
             "min_basket_size", "max_basket_size", "std_basket_size")
    means = ("total_customers", "avg_orders_per_customer", "median_orders_per_customer",
             "avg_products_per_customer", "avg_basket_size", "single_order_customer_pct",
             "power_user_pct")
    segment = ("segment", "customers", "percentage", "avg_basket_size", "avg_products")
    buckets = ", ".join(
        f"{{'bucket': '{b}', 'orders': count(*) FILTER ({test})}}" for b, test in _BUCKETS
    )
    fields = {
        "top_products.json": f"""'total_products': (SELECT count(*) FROM products_kpi),
            'products': {_list(_TOP_PRODUCTS % 500, *product)}""",
        "reorder_metrics.json": f"""'total_products': (SELECT count(*) FROM products_kpi),
            'products': {_list(_TOP_RATES % 500, *rate)}""",
        "department_metrics.json": f"""'total_departments': (SELECT count(*) FROM departments_kpi),
            'departments': {_list(_TOP_DEPARTMENTS % 1000000, "department",
                                  "total_products_sold", "unique_customers")}""",
        "basket_metrics.json": f"""'summary': (SELECT {{{packed(sizes)}}} FROM (
                SELECT count(DISTINCT order_id) AS total_orders,
                       CAST(sum(basket_size) AS BIGINT) AS total_line_items, {_SIZES}
                FROM order_level)),
            'distribution': (SELECT [{buckets}] FROM order_level)""",
        "customer_metrics.json": f"""'summary': (SELECT {{{packed(means)}}} FROM (
                SELECT count(DISTINCT user_id) AS total_customers,
                       {_means({}, 21, 'power_user_pct')} FROM customers_kpi)),
            'segmentation': (SELECT list({{{packed(segment)}}} ORDER BY segment)
                             FROM ({_SEGMENTATION})),
            'order_frequency': (SELECT list({{'orders': orders, 'customers': customers}}
                                            ORDER BY orders) FROM ({_FREQUENCY})),
            'top_customers': {_list(_TOP_CUSTOMERS % 50, *customer)}""",
    }
    stamp = "2024-01-01T00:00:00+00:00"
    rows = [
        f"""SELECT '{name}' AS name,
            CAST(to_json({{'last_updated': '{stamp}', {content}}}) AS VARCHAR) AS document"""
        for name, content in fields.items()
    ]
    pending = (
        f'{{"last_updated":"{stamp}","model":"pending","executive_summary":'
        '"AI insights will be generated in the next pipeline task.","sections":{},'
        '"recommendations":[],"full_text":"","kpi_overview":{}}'
    )
    rows.append(f"SELECT 'ai_insights.json', '{pending}'")
    query = " UNION ALL ".join(rows)
    for view in _KPI_VIEWS:
        query = re.sub(rf"\b{view}\b", f"tidy_{view}", query)
    return query


def _search(label: str, condition: str, order: str) -> str:
    return f"""(SELECT {_shown('product_id', 'product_name', 'total_orders', 'total_reorders',
        'reorder_rate')}, {_position(order)} AS position, count(*) OVER () AS matches,
        '{label}' AS search
        FROM products_kpi WHERE {condition} ORDER BY {order} LIMIT 100)"""


_QUERIES = {
    "csv_scan": "SELECT * FROM fx_orders",
    "csv_malformed_split": """
        SELECT CASE WHEN add_to_cart_order IN (2, 3) THEN 'malformed' ELSE 'valid' END AS side,
               concat_ws(',', order_id,
                   CASE WHEN add_to_cart_order = 2 THEN 'n/a' ELSE CAST(product_id AS VARCHAR) END,
                   CASE WHEN add_to_cart_order = 3 THEN '3.5'
                        ELSE CAST(add_to_cart_order AS VARCHAR) END,
                   reordered) AS record
        FROM fx_prior""",
    "ingest_counts": _contents(
        {
            "orders": ("fx_orders", *_ORDER_PARTS),
            "products": ("fx_products", *_PRODUCT_PARTS),
            "departments": ("fx_departments", *_NAME_PARTS["department"]),
            "aisles": ("fx_aisles", *_NAME_PARTS["aisle"]),
            "order_products__prior": (
                "fx_prior WHERE add_to_cart_order NOT IN (2, 3)", *_LINE_PARTS),
            "order_products__train": ("fx_train", *_LINE_PARTS),
            "order_products__prior__malformed": (
                """(SELECT concat_ws(',', order_id,
                       CASE WHEN add_to_cart_order = 2 THEN 'n/a' ELSE product_id::VARCHAR END,
                       CASE WHEN add_to_cart_order = 3 THEN '3.5' ELSE add_to_cart_order::VARCHAR END,
                       reordered) AS record
                    FROM fx_prior WHERE add_to_cart_order IN (2, 3))""", "", "", "record"),
        }
    ),
    "bronze_roundtrip": "SELECT product_id, product_name FROM fx_products",
    "fact_projection": """
        SELECT order_id, user_id, product_id, product_name, department, reordered FROM fact""",
    "silver_checkpoint": "SELECT * FROM lines",
    "silver_tables": _contents(
        {
            "clean_orders": ("tidy_orders", *_ORDER_PARTS),
            "clean_products": ("tidy_products", *_PRODUCT_PARTS),
            "clean_departments": ("fx_departments", *_NAME_PARTS["department"]),
            "clean_aisles": ("fx_aisles", *_NAME_PARTS["aisle"]),
            "clean_order_products": ("tidy_merged", *_LINE_PARTS),
            "retail_transactions": (
                "tidy_whole",
                "order_id user_id product_id add_to_cart_order reordered order_dow"
                " order_hour_of_day",
                "",
                "product_name aisle department",
            ),
        }
    ),
    "gold_roundtrip": _contents(
        {
            "gold_top_products": (
                "products_kpi", "product_id total_orders total_reorders", "reorder_rate",
                "product_name"),
            "gold_department_metrics": (
                "departments_kpi", "total_products_sold unique_customers", "", "department"),
            "gold_customer_metrics": (
                "customers_kpi", "user_id total_orders total_products", "avg_basket_size", ""),
            "gold_basket_metrics": ("order_level", "order_id basket_size", "", ""),
            "gold_reorder_metrics": ("products_kpi", "product_id", "reorder_rate", "product_name"),
        }
    ),
    "dashboard_export": _documents(),
    "normalize_text": """
        SELECT doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS text
        FROM documents""",
    "tolerant_cast": """
        SELECT p_partkey, TRY_CAST(CASE WHEN p_type = 'PROMO' THEN p_brand
            ELSE split_part(p_brand, '#', -1) END AS DOUBLE) AS brand_number FROM part""",
    "clean_orders": "SELECT * FROM tidy_orders",
    "clean_products": "SELECT * FROM tidy_products",
    "clean_departments": """
        SELECT department_id, lower(department) AS department FROM fx_departments""",
    "clean_aisles": "SELECT aisle_id, lower(aisle) AS aisle FROM fx_aisles",
    "clean_order_products": "SELECT * FROM tidy_lines",
    "dedup_by_key": "SELECT * FROM lines",
    "merge_order_products": "SELECT * FROM merged",
    "distinct_keys": "SELECT DISTINCT order_id FROM merged",
    "products_enriched": """
        SELECT product_id, product_name, aisle,
               CASE WHEN NOT ends_with(department, '5') THEN department END AS department
        FROM enriched""",
    "retail_transactions": "SELECT * FROM fact",
    "star_join": "SELECT * FROM tidy_fact",
    "dq_profile": "SELECT count(*) AS total_rows, "
    + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null__{c}" for c in _ORDER_COLUMNS)
    + ", "
    + ", ".join(f"CAST(0 AS BIGINT) AS invalid__{c}" for c in _ORDER_COLUMNS)
    + " FROM messy_orders",
    "dq_nulls": " UNION ALL ".join(_null_rows("orders", "messy_orders", _ORDER_COLUMNS)),
    "dq_invalid_cast": " UNION ALL ".join(
        _cast_rows(
            "orders",
            "fx_orders",
            _ORDER_COLUMNS,
            {"days_since_prior_order": "days_since_prior_order IS NULL"},
        )
    ),
    "dq_duplicates": " UNION ALL ".join(
        _duplicate_rows("order_products_merged", "merged", list(_LINE_COLUMNS)[:3])
    ),
    "dq_report": _all_checks(),
    "dq_summary": f"""
        SELECT count(*) AS total_checks, count(*) FILTER (status = 'FAIL') AS failures,
               count(*) FILTER (status = 'WARN') AS warnings FROM ({_all_checks()})""",
    "product_aggregates": "SELECT * FROM products_kpi",
    "gold_top_products": "SELECT * FROM products_kpi",
    "gold_reorder_metrics": "SELECT product_id, product_name, reorder_rate FROM products_kpi",
    "gold_department_metrics": "SELECT * FROM departments_kpi",
    "order_level": "SELECT * FROM order_level",
    "gold_basket_metrics": "SELECT order_id, basket_size FROM order_level",
    "gold_customer_metrics": "SELECT * FROM customers_kpi",
    "top_products_n": f"""
        SELECT *, (SELECT count(DISTINCT product_id) FROM products_kpi) AS total_products
        FROM ({_TOP_PRODUCTS % 500})""",
    "top_reorder_n": f"""
        SELECT *, (SELECT count(DISTINCT product_id) FROM products_kpi) AS total_products
        FROM ({_TOP_RATES % 500})""",
    "department_ranking": """
        SELECT *, (SELECT count(DISTINCT department) FROM departments_kpi) AS total_departments
        FROM departments_kpi""",
    "department_rank": f"SELECT *, {_position(_BY_SOLD)} AS rank FROM departments_kpi",
    "department_share_top6": f"""
        SELECT position, department, total_products_sold,
               {_round('total_products_sold / sum(total_products_sold) OVER ()', 4)} AS share
        FROM ({_TOP_DEPARTMENTS % 6})""",
    "top_reorder_mean": f"""
        SELECT {_round('avg(reorder_rate)', 4)} AS mean_reorder_rate
        FROM ({_TOP_RATES % 500})""",
    "basket_histogram": " UNION ALL ".join(
        f"SELECT {at} AS position, '{label}' AS bucket, count(*) AS orders "
        f"FROM order_level WHERE {test}"
        for at, (label, test) in enumerate(_BUCKETS, start=1)
    ),
    "basket_summary": f"""
        SELECT count(DISTINCT order_id) AS total_orders,
               CAST(sum(basket_size) AS BIGINT) AS total_line_items, {_SIZES}
        FROM order_level""",
    "customer_segment": f"SELECT user_id, {_SEGMENT} AS segment FROM customers_kpi",
    "customer_segmentation": _SEGMENTATION,
    "order_frequency": _FREQUENCY,
    "top_customers_n": _TOP_CUSTOMERS % 50,
    "customer_summary": f"""
        SELECT count(DISTINCT user_id) AS total_customers, {_means({}, 21, 'power_user_pct')}
        FROM customers_kpi""",
    "customer_trends": f"SELECT {_TRENDS} FROM customers_kpi",
    "dataset_overview": f"SELECT {_OVERVIEW}",
    "dashboard_overview": f"""
        SELECT total_customers, total_unique_products AS total_products, total_departments,
               (SELECT count(*) FROM orders) AS total_transactions, total_line_items,
               '2024-01-01T00:00:00+00:00' AS last_updated
        FROM (SELECT {_OVERVIEW})""",
    "reorder_highlights": f"""
        SELECT {_round('avg(reorder_rate)', 4)} AS overall_avg_reorder_rate,
               count(*) FILTER (reorder_rate > 0.5) AS products_with_reorder_rate_above_50pct
        FROM products_kpi""",
    "kpi_top10_slices": f"""
        SELECT 'top_performing_products' AS slice, position, product_name AS name,
               CAST(total_orders AS DOUBLE) AS measure FROM ({_TOP_PRODUCTS % 10}) UNION ALL
        SELECT 'most_reordered_products', position, product_name, reorder_rate
        FROM ({_TOP_RATES % 10}) UNION ALL
        SELECT 'best_performing_departments', position, department,
               CAST(total_products_sold AS DOUBLE) FROM ({_TOP_DEPARTMENTS % 10})""",
    "product_search": " UNION ALL ".join(
        [
            _search("by name", "product_name ILIKE '%anvil%'", _BY_ORDERS),
            _search("by id", "CAST(product_id AS VARCHAR) LIKE '%19%'", "reorder_rate, product_id"),
            _search("all", "true", "product_name, product_id"),
        ]
    ),
    "kpi_summary_json": _summary_document(),
    "report_sections": "SELECT doc_id, section_no, section, body FROM found_sections",
    "report_recommendations": "SELECT * FROM advice",
    "report_assembled": """
        SELECT reports.doc_id, '2024-01-01T00:00:00+00:00' AS last_updated,
               CASE WHEN reports.text IS NULL THEN 'pending' ELSE 'unknown' END AS model,
               CASE WHEN reports.text IS NULL
                    THEN 'AI insights will be generated in the next pipeline task.'
                    ELSE coalesce(summary, substr(reports.text, 1, 500)) END AS executive_summary,
               coalesce(sections, '') AS sections,
               coalesce(array_to_string(list_filter(
                   list_transform(
                       regexp_extract_all(coalesce(advice_section, reports.text),
                                          '(?m)^\\s*\\d+[.)]\\s*(.+)$', 1),
                       lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')),
                   lambda x: x <> ''), chr(10)), '') AS recommendations,
               coalesce(reports.text, '') AS full_text
        FROM reports LEFT JOIN (
            SELECT doc_id, string_agg(section || '=' || body, chr(30) ORDER BY section) AS sections,
                   max(body) FILTER (section = 'executive_summary') AS summary,
                   max(body) FILTER (section = 'key_business_recommendations') AS advice_section
            FROM found_sections GROUP BY doc_id) AS s ON s.doc_id = reports.doc_id""",
}

_VIEWS["tidy_merged"] = """
    SELECT order_id, product_id, add_to_cart_order, max(reordered) AS reordered
    FROM merged
    WHERE order_id IN (SELECT order_id FROM tidy_orders)
      AND product_id IN (SELECT product_id FROM tidy_products)
    GROUP BY order_id, product_id, add_to_cart_order"""

_VIEWS["tidy_whole"] = """
    SELECT order_id, user_id, product_id, product_name, lower(aisle) AS aisle,
           lower(department) AS department, add_to_cart_order, reordered, order_dow,
           order_hour_of_day
    FROM tidy_merged JOIN tidy_orders USING (order_id) JOIN tidy_products USING (product_id)
    LEFT JOIN fx_aisles USING (aisle_id) LEFT JOIN fx_departments USING (department_id)"""
for _view in _KPI_VIEWS:
    _VIEWS[f"tidy_{_view}"] = re.sub(
        r"\b(fact|order_level)\b",
        lambda m: "tidy_whole" if m[0] == "fact" else "tidy_order_level",
        _VIEWS[_view],
    )

ORACLES = {name: _sql(query) for name, query in _QUERIES.items()}
