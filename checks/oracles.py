"""The same results in DuckDB SQL over the given tables."""

from __future__ import annotations

from checks.queries import COMMON, FOREIGN_KEYS, LABELLED, ODD_PARTS, PROFILED, SELECTED, SELECTIONS
from checks.sources import TABLES, view_body

# The given tables' columns, in order, with their Spark types.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _views(*names: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({view_body(name, '')})" for name in names) + " "


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _selection(name: str) -> str:
    sql = SELECTIONS[name].replace("@", "").replace("* except", "* exclude")
    # DuckDB's own NULL order is not that of the selections, so it is spelled out.
    sql = sql.replace("order by o_totalprice desc, o_orderkey", "order by o_totalprice desc nulls first, o_orderkey")
    sql = sql.replace("order by o_totalprice, o_orderkey", "order by o_totalprice nulls last, o_orderkey")
    views = [name for name in ("priced_orders", "odd_customers") if name in sql]
    return (_views(*views) if views else "") + sql


def _profile_rows(name: str) -> list[str]:
    widths = {"note": "avg(strlen(note))", "lines": "avg(strlen(lines))",
              "o_orderpriority": "avg(strlen(o_orderpriority))", "c_nationkey": "4.0"}
    return [
        f"SELECT '{name}' AS relation, '{column}' AS column_name, count(*) AS row_count,"
        f" 1 - count({column}) / count(*) AS null_fraction, count(DISTINCT {column}) AS distinct_count,"
        f" CAST({widths.get(column, '8.0')} AS double) AS width FROM {name}"
        for column in PROFILED[name]
    ]


def _profile() -> str:
    return (
        _views(*PROFILED) + ", measured AS (" + _union([r for n in PROFILED for r in _profile_rows(n)]) + ")"
    )


def _common() -> str:
    counted = _union(
        [
            f"SELECT '{name}' AS relation, '{column}' AS \"column\", CAST({column} AS varchar) AS value,"
            f" count(*) AS \"rows\", count(*) / (SELECT count(*) FROM {name}) AS frequency"
            f" FROM {name} WHERE {column} IS NOT NULL GROUP BY {column}"
            for name, columns in COMMON.items()
            for column in columns
        ]
    )
    return (
        _views("odd_customers")
        + f', counted AS ({counted}), ranked AS (SELECT *, row_number() OVER'
        ' (PARTITION BY relation, "column" ORDER BY "rows" DESC, value) AS rank FROM counted)'
        ' SELECT relation, "column", CAST(rank AS integer) AS rank, value, "rows",'
        " round(frequency, 9) AS frequency FROM ranked WHERE rank <= 3"
    )


def _common_many() -> str:
    counted = _union(
        [
            f"SELECT '{column}' AS \"column\", CAST({column} AS varchar) AS value, count(*) AS \"rows\""
            f" FROM lineitem GROUP BY {column}"
            for column in ("l_partkey", "l_suppkey")
        ]
    )
    return (
        f'SELECT "column", CAST(rank AS integer) AS rank, value, "rows" FROM (SELECT *, row_number()'
        f' OVER (PARTITION BY "column" ORDER BY "rows" DESC, value) AS rank FROM ({counted}))'
        " WHERE rank <= 2000"
    )


def _common_all() -> str:
    counted = _union(
        [
            f"SELECT '{name}' AS relation, '{column}' AS \"column\", CAST({column} AS varchar) AS value, count(*) AS \"rows\""
            f" FROM {name} WHERE {column} IS NOT NULL GROUP BY {column}"
            for name in ("documents", "lineitem")
            for column in (part.split(" ")[0] for part in COLUMNS[name].split(", "))
        ]
    )
    return (
        'SELECT relation, "column", CAST(rank AS integer) AS rank, value, "rows" FROM (SELECT *, row_number() OVER'
        f' (PARTITION BY relation, "column" ORDER BY "rows" DESC, value) AS rank FROM ({counted})) WHERE rank <= 5'
    )


def _stored() -> str:
    rows = []
    for column in COLUMNS["orders"].split(", "):
        name, kind = column.split(" ")
        few = name in ("o_orderstatus", "o_orderpriority")
        top = f"FROM orders GROUP BY {name} ORDER BY count(*) DESC, {name} LIMIT 1)"
        width = f"avg(strlen({name}))" if kind == "string" else "8.0"
        rows.append(
            f"SELECT '{name}' AS \"column\", count(*) AS \"rows\", 1 - count({name}) / count(*) AS null_fraction,"
            " true AS distinct_agrees, true AS median_is_close,"
            f" round(CAST({width} AS double), 6) AS average_width_bytes,"
            + (f" (SELECT {name} {top} AS first_value," if few else " CAST(NULL AS varchar) AS first_value,")
            + (f" (SELECT count(*) {top} AS first_rows" if few else " CAST(NULL AS bigint) AS first_rows")
            + " FROM orders"
        )
    return _union(rows)


def _labels() -> str:
    distinct = _union(
        [
            f"SELECT DISTINCT '{name}' AS relation, '{column}' AS \"column\", {column} AS label FROM {name}"
            for name, columns in LABELLED.items()
            for column in columns
        ]
    )
    return (
        f'SELECT relation, "column", CAST(position AS integer) AS position, label FROM (SELECT *,'
        ' row_number() OVER (PARTITION BY relation, "column" ORDER BY label) AS position,'
        f' count(*) OVER (PARTITION BY relation, "column") AS labels FROM ({distinct})) WHERE labels <= 10'
    )


def _described() -> str:
    rows = []
    for name in TABLES:
        for ordinal, column in enumerate(COLUMNS[name].split(", "), start=1):
            column_name, column_type = column.split(" ")
            rows.append(
                f"SELECT '{name}' AS relation, 'table' AS kind, {ordinal} AS ordinal,"
                f" '{column_name}' AS \"column\", '{column_type}' AS type, true AS nullable,"
                f" (SELECT count(*) FROM {name}) AS \"rows\""
            )
    return _union(rows)


def _manifests() -> str:
    rows = [
        f"SELECT 'binary' AS data_format, {position} AS position, '{name}' AS relation, '*' AS projection,"
        f" {len(COLUMNS[name].split(', '))} AS columns, (SELECT count(*) FROM {name}) AS \"rows\""
        for position, name in enumerate(TABLES)
    ]
    rows.append(
        "SELECT 'csv', 0, 'lineitem', 'except_list', 10,"
        " (SELECT count(*) FROM lineitem WHERE l_quantity > 25)"
    )
    return _union(rows)


def _compat() -> str:
    rows = []
    for column in COLUMNS["orders"].split(", "):
        name, wanted = column.split(" ")
        rows.append(
            f"SELECT 'orders' AS target, '{name}' AS \"column\", '{wanted}' AS expected,"
            f" '{wanted}' AS actual, 'ok' AS status, 2 * (SELECT count(*) FROM orders) AS \"rows\""
        )
        found, status = f"'{wanted}'", "ok"
        if name in ("o_orderdate", "o_orderpriority"):
            found, status = "CAST(NULL AS varchar)", "missing"
        elif name == "o_totalprice":
            found, status = "'decimal(12,2)'", "type differs"
        rows.append(
            f"SELECT 'order_targets', '{name}', '{wanted}', {found}, '{status}',"
            " (SELECT count(*) FROM orders)"
        )
    return _union(rows)


def _outside() -> str:
    return _union(
        [
            f"SELECT '{name}' AS name, '{child}' AS relation, '{parent}' AS parent,"
            f" count({column}) AS referencing_rows FROM {child}"
            for name, child, column, parent, _ in FOREIGN_KEYS
            if child in SELECTED and parent not in SELECTED
        ]
    )


def _reconciled(columns: str, before: str, after: str) -> str:
    def missing(left: str, right: str, side: str) -> str:
        return (
            f"SELECT {columns}, '{side}' AS side, count(*) AS copies FROM"
            f" (SELECT * FROM {left} EXCEPT ALL SELECT * FROM {right}) GROUP BY ALL"
        )

    return _views(after) + missing(before, after, "left") + " UNION ALL " + missing(after, before, "right")


def _reconciled_nested() -> str:
    def items(side: str, whole: str, label: str, where: str) -> list[str]:
        return [
            f"SELECT vec_id, '{side}' AS side, {place} AS position, '{name}' AS name, {part} AS part"
            f" FROM embeddings WHERE {where}"
            for place, (name, part) in enumerate((("whole", whole), ("label", label)))
        ]

    value = "CAST(label AS float)"
    parts = [
        *items("left", "embedding", f"[{value}]", "vec_id % 5 < 3"),
        *items("right", "embedding", "NULL", "vec_id % 5 = 0"),
        *items("right", "list_prepend(CAST(0 AS float), embedding)", f"[{value}]", "vec_id % 5 = 1"),
        *items("right", f"list_append(embedding, {value})", "CAST([] AS float[])", "vec_id % 5 = 2"),
        *items("right", "embedding", f"[{value}]", "vec_id % 50 = 3"),
    ]
    return (
        f"WITH items AS ({_union(parts)}) SELECT vec_id, side, CAST(1 AS bigint) AS copies, position, name,"
        " CAST(len(part) AS integer) AS size, CAST(part[1] AS double) AS first_value FROM items"
    )


def all_oracles() -> dict[str, str]:
    oracles = {name: _selection(name) for name in SELECTIONS}
    oracles |= {
        "limit_by_position": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"
        " ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 14000",
        "export_in_order": "SELECT row_number() OVER (ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) - 1 AS place,"
        " l_orderkey, l_linenumber FROM lineitem ORDER BY place LIMIT 40000",
        "limit_zero": "SELECT 'orders' AS relation, count(*) AS \"rows\" FROM (SELECT * FROM orders LIMIT 0)"
        " UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
        "roundtrip_parquet": "SELECT * FROM events",
        "roundtrip_csv": _views("odd_customers") + "SELECT * FROM odd_customers",
        "roundtrip_csv_timestamps": "SELECT * FROM events",
        "roundtrip_csv_documents": "SELECT * FROM documents",
        "roundtrip_csv_nested": "SELECT vec_id, label, CAST(position AS integer) AS position,"
        " CAST(embedding[position + 1] AS double) AS value FROM"
        " (SELECT *, unnest(range(len(embedding))) AS position FROM embeddings)",
        "roundtrip_encrypted": _views("odd_customers") + "SELECT * FROM odd_customers",
        "roundtrip_encrypted_csv": "SELECT * FROM events",
        "view_as_table": view_body("nation_revenue", ""),
        "view_dependency_order": "SELECT 1 AS position, 'lineitem' AS relation, 'table' AS kind,"
        " 'table' AS export_as, (SELECT count(*) FROM lineitem) AS \"rows\""
        " UNION ALL SELECT 2, 'orders', 'table', 'table', (SELECT count(*) FROM orders)"
        " UNION ALL SELECT 3, 'customer', 'table', 'table', (SELECT count(*) FROM customer)"
        " UNION ALL SELECT 4, 'order_lines', 'view', 'table',"
        " (SELECT count(*) FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"
        " UNION ALL SELECT 5, 'customer_lines', 'view', 'table',"
        " (SELECT count(*) FROM orders JOIN lineitem ON l_orderkey = o_orderkey"
        " JOIN customer ON c_custkey = o_custkey)"
        " UNION ALL SELECT 6, 'segment_report', 'view', 'view', NULL",
        "manifest_objects": _manifests(),
        "import_replace": "SELECT * FROM orders",
        "import_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
        "append_subset_defaults": "SELECT 'web' AS channel, o_totalprice,"
        " CAST(NULL AS varchar) AS note, o_orderkey FROM orders",
        "import_schema_only": "SELECT 'lineitem' AS relation, count(*) AS snapshot_rows,"
        " CAST(0 AS bigint) AS loaded_rows, 11 AS columns FROM lineitem",
        "append_compat_report": _compat(),
        "not_null_violations": _views("odd_customers")
        + _union(
            [
                f"SELECT '{column}' AS \"column\", count(*) - count({column}) AS violations FROM odd_customers"
                for column in PROFILED["odd_customers"]
            ]
        ),
        "key_watermark": "SELECT 'orders' AS relation, 'o_orderkey' AS \"column\","
        " coalesce(max(o_orderkey) + 1, 1) AS next_value FROM orders"
        " UNION ALL SELECT 'orders', 'o_custkey', coalesce(max(o_custkey) + 1, 1) FROM orders"
        " UNION ALL SELECT 'customer', 'c_custkey', coalesce(max(c_custkey) + 1, 1) FROM customer"
        " UNION ALL SELECT 'part', 'p_partkey', coalesce(max(p_partkey) + 1, 1) FROM part WHERE p_size < 0",
        "assign_keys": "SELECT (SELECT max(o_orderkey) FROM orders)"
        " + row_number() OVER (ORDER BY event_type, event_id) AS new_orderkey,"
        " event_id, user_id, event_type FROM events",
        "row_counts": _union([f"SELECT '{name}' AS relation, count(*) AS \"rows\" FROM {name}" for name in TABLES]),
        "describe_columns": _described(),
        "profile_basic": _profile() + 'SELECT relation, column_name AS "column", row_count AS "rows",'
        " round(null_fraction, 6) AS null_fraction, distinct_count AS distinct_values,"
        " round(width, 4) AS average_width_bytes FROM measured",
        "profile_approx": _profile() + 'SELECT relation, column_name AS "column", row_count AS "rows",'
        " true AS distinct_is_close, true AS null_fraction_agrees, true AS width_agrees FROM measured",
        "profile_report": _profile() + "SELECT CAST(row_number() OVER () AS integer) AS ordinal,"
        " column_name AS \"column\", printf('%.2f%%', null_fraction * 100) AS nulls,"
        " CASE WHEN distinct_count >= 100 THEN printf('~%.0f', CAST(distinct_count AS double))"
        " ELSE printf('~%.2f', CAST(distinct_count AS double)) END AS \"distinct\""
        " FROM (SELECT * FROM measured WHERE relation = 'odd_customers' ORDER BY list_position("
        "['c_custkey', 'note', 'lines', 'c_acctbal', 'c_nationkey'], column_name))",
        "common_values": _common(),
        "common_values_many": _common_many(),
        "common_values_all": _common_all(),
        "stored_statistics": _stored(),
        "enum_labels": _labels(),
        "fk_outside_selection": _outside(),
        "fk_orphans": "SELECT l_orderkey, count(*) AS \"rows\" FROM lineitem WHERE NOT EXISTS"
        " (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F') GROUP BY l_orderkey",
        "pk_duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS \"rows\" FROM lineitem"
        " GROUP BY ALL HAVING count(*) > 1",
        "constraint_report": _views("priced_orders", "odd_customers", "discounted_lines")
        + """
            SELECT 'orders_pk' AS "constraint", 'primary_key' AS kind, coalesce(sum(n), 0)::BIGINT AS violations
            FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
            UNION ALL SELECT 'customer_nation', 'unique', coalesce(sum(n), 0)::BIGINT
            FROM (SELECT count(*) AS n FROM customer WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey HAVING count(*) > 1)
            UNION ALL SELECT 'odd_pk', 'primary_key', count(*) FROM odd_customers WHERE c_nationkey IS NULL
            UNION ALL SELECT 'lineitem_order', 'foreign_key', count(*) FROM lineitem
            WHERE l_orderkey NOT IN (SELECT o_orderkey FROM priced_orders)
            UNION ALL SELECT 'orders_supplier', 'foreign_key', count(*) FROM orders
            WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)
            UNION ALL SELECT 'priority_form', 'check', count(*) FROM orders
            WHERE NOT regexp_full_match(o_orderpriority, '[1-3]-\\S+')
            UNION ALL SELECT 'discount_range', 'check', count(*) FROM discounted_lines WHERE NOT l_discount <= 0.08
        """,
        "check_violations": _views("discounted_lines")
        + "SELECT * FROM discounted_lines WHERE NOT (l_discount <= 0.08)",
        "reconcile_diff": _reconciled(
            "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
            "orders", "changed_orders",
        ),
        "reconcile_scattered": _reconciled(
            "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,"
            " l_returnflag, l_linestatus, l_shipdate", "lineitem", "recounted_lines",
        ),
        "reconcile_nested": _reconciled_nested(),
        "pinned_inputs": "SELECT CASE o_orderpriority "
        + " ".join(f"WHEN '{name}' THEN '{part}'" for name, part in ODD_PARTS.items())
        + " END AS part, count(*) AS \"rows\", true AS pinned FROM orders GROUP BY o_orderpriority",
        "damaged_files": _views("changed_orders")
        + "SELECT 'orders' AS relation, 'missing' AS status, count(*) AS rows_before,"
        " CAST(NULL AS bigint) AS rows_after FROM orders"
        " UNION ALL SELECT 'orders', 'unlisted', NULL, count(*) FROM changed_orders",
        "import_view": view_body("nation_revenue", ""),
        "import_defaults": "SELECT o_orderkey, 'shop' AS channel, CAST(1 AS integer) AS points FROM orders"
        " UNION ALL SELECT o_orderkey, 'web', 5 FROM orders",
    }
    return oracles
