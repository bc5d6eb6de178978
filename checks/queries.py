"""One function per operator: (spark, sf_dir) -> DataFrame, always over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sources import TABLES, Tables, open_tables, view_body
from tablecrate.config import Constraint, General, JobConfig, ObjectConfig, select_objects
from tablecrate.errors import CrateError
from tablecrate.operators import keys, loading, profile, quality, sketches
from tablecrate.operators.numbering import with_positions
from tablecrate.operators.reconcile import reconcile
from tablecrate.operators.selection import parse
from tablecrate.reports import describe
from tablecrate.session import scratch_dir
from tablecrate.sinks import export as exports
from tablecrate.sinks import load as loads
from tablecrate.sinks.export import export_snapshot
from tablecrate.sources import ledger, manifests, relations
from tablecrate.sources.files import MetadataFiles

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(function: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(open_tables(spark, sf_dir))

    _REGISTRY[function.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- selections -----------------------------------------------------------------------

SELECTIONS = {
    "scan_all": "select * from @lineitem",
    "project_list": "select o_totalprice, o_orderkey from @orders",
    "project_except": "select * except (l_tax, l_discount) from @lineitem",
    "filter_predicate": "select * from @orders where o_totalprice > 250000"
    " and o_orderpriority in ('1-URGENT', '2-HIGH')",
    "filter_quoted_keywords": "select * from @orders"
    " where o_orderpriority <> 'order by ''limit''' and (\"o_totalprice\" > 300000)",
    "filter_in_subquery": "select l_orderkey, l_linenumber, l_quantity from @lineitem"
    " where l_orderkey in (select o_orderkey from @orders where o_totalprice > 400000)",
    "filter_not_exists": "select * from @customer where not exists"
    " (select 1 from @orders where o_custkey = c_custkey and o_totalprice > 300000)",
    "filter_not_in_subquery": "select o_orderkey, o_custkey from @priced_orders where o_orderpriority is not null"
    " and o_custkey not in (select c_custkey from @customer where c_acctbal > 0)"
    " and o_totalprice not in (select o_totalprice from @orders where o_orderstatus = 'F')",
    "filter_not_in_with_nulls": "select c_custkey, c_acctbal from @odd_customers where c_nationkey not in"
    " (select n_nationkey from @nation where n_regionkey > 7) and c_custkey not in"
    " (select o_custkey from @priced_orders where o_totalprice is null)",
    "order_limit_expr": "select p_partkey, p_name from @part order by length(p_name) desc, p_partkey limit 25",
    "topk_order_limit": "select * from @orders order by o_totalprice desc, o_orderkey limit 50",
    "topk_nulls_asc": "select o_orderkey, o_totalprice from @priced_orders"
    " where o_totalprice is null or o_totalprice > 495000"
    " order by o_totalprice, o_orderkey limit 140",
    "topk_nulls_desc": "select o_orderkey, o_totalprice from @priced_orders"
    " order by o_totalprice desc, o_orderkey limit 140",
    "filter_project_topk": "select o_orderkey, o_totalprice from @orders where o_orderstatus = 'F'"
    " order by o_orderdate desc, o_orderkey limit 50",
}


def _selection_query(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return open_tables(spark, sf_dir).select(SELECTIONS[name])

    _REGISTRY[name] = run


for _name in SELECTIONS:
    _selection_query(_name)


@_query
def limit_by_position(tables: Tables) -> DataFrame:
    """A large limit, on a sort with few distinct keys first."""
    return tables.select(
        "select o_orderkey, o_orderpriority, o_totalprice from @orders"
        " order by o_orderpriority, o_totalprice desc, o_orderkey limit 14000"
    )


@_query
def export_in_order(tables: Tables) -> DataFrame:
    """An ordered export with a large limit, read back with the place of each row."""
    path = _export(
        tables,
        "select l_orderkey, l_linenumber, l_shipdate from @lineitem"
        " order by l_shipdate desc, l_orderkey, l_linenumber limit 40000",
    )
    snapshot = manifests.open_snapshot(tables.spark, path)
    rows = tables.spark.read.parquet(f"{path}/{loads.find_object(snapshot, 'lineitem').payload}")
    place = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    placed = with_positions(rows.select("*", place[0].alias("file"), place[1].alias("row")), "place", [F.col("file"), F.col("row")])
    return placed.select("place", "l_orderkey", "l_linenumber")


@_query
def limit_zero(tables: Tables) -> DataFrame:
    path = _export(tables, "select * from @orders limit 0", "select * from @lineitem")
    return _manifest_counts(tables, path)


# --- snapshots ------------------------------------------------------------------------


def _config(tables: Tables, *selects: str, **options: object) -> JobConfig:
    return select_objects(*[tables.text(select) for select in selects], **options)


def _export(
    tables: Tables, *selects: str, password: str | None = None, **options: object
) -> str:
    path = scratch_dir(tables.spark, "snapshot")
    export_snapshot(tables.spark, _config(tables, *selects, **options), path, password=password)
    return path


def _read_back(tables: Tables, path: str, name: str, password: str | None = None) -> DataFrame:
    snapshot = manifests.open_snapshot(tables.spark, path, password)
    return loads.read_object(tables.spark, snapshot, loads.find_object(snapshot, name))


def _manifest_counts(tables: Tables, path: str) -> DataFrame:
    return manifests.manifest_objects(tables.spark, path).select(
        "relation", "rows"
    )


@_query
def roundtrip_parquet(tables: Tables) -> DataFrame:
    return _read_back(tables, _export(tables, "select * from @events"), "events")


@_query
def roundtrip_csv(tables: Tables) -> DataFrame:
    path = _export(tables, "select * from @odd_customers", data_format="csv")
    return _read_back(tables, path, "odd_customers")


@_query
def roundtrip_csv_timestamps(tables: Tables) -> DataFrame:
    path = _export(tables, "select * from @events", data_format="csv")
    return _read_back(tables, path, "events")


@_query
def roundtrip_csv_documents(tables: Tables) -> DataFrame:
    path = _export(tables, "select * from @documents", data_format="csv")
    return _read_back(tables, path, "documents")


@_query
def roundtrip_csv_nested(tables: Tables) -> DataFrame:
    path = _export(tables, "select * from @embeddings", data_format="csv")
    rows = _read_back(tables, path, "embeddings")
    return rows.select("vec_id", "label", F.posexplode("embedding").alias("position", "value")).select(
        "vec_id", "label", "position", F.col("value").cast("double").alias("value")
    )


@_query
def roundtrip_encrypted(tables: Tables) -> DataFrame:
    path = _export(tables, "select * from @odd_customers", password="a strong passphrase")
    return _read_back(tables, path, "odd_customers", "a strong passphrase")


@_query
def roundtrip_encrypted_csv(tables: Tables) -> DataFrame:
    path = _export(tables, "select * from @events", password="a strong passphrase", data_format="csv")
    return _read_back(tables, path, "events", "a strong passphrase")


@_query
def view_as_table(tables: Tables) -> DataFrame:
    """A view is a table after export and load, whatever its body computes."""
    path = _export(tables, "select * from @nation_revenue")
    return _load_and_read(tables, path, "nation_revenue")


@_query
def view_dependency_order(tables: Tables) -> DataFrame:
    """A view kept as a view brings its dependencies as tables, in creation order."""
    item = ObjectConfig(parse(tables.text("select * from @segment_report")), export_as="view")
    path = scratch_dir(tables.spark, "snapshot")
    config = JobConfig(objects=(item,), general=General(concurrency=4))
    export_snapshot(tables.spark, config, path)
    return manifests.manifest_objects(tables.spark, path).select(
        (F.col("position") + 1).alias("position"),
        "relation",
        "kind",
        "export_as",
        "rows",
    )


@_query
def manifest_objects(tables: Tables) -> DataFrame:
    """The manifests of two snapshots as one table."""
    first = _export(tables, *[f"select * from @{name}" for name in TABLES], concurrency=8)
    second = _export(
        tables, "select * except (l_tax) from @lineitem where l_quantity > 25 order by l_orderkey",
        data_format="csv",
    )
    return manifests.manifest_objects(tables.spark, first, second).select(
        F.col("payload_format").alias("data_format"),
        "position",
        "relation",
        "projection",
        F.size("columns").alias("columns"),
        "rows",
    )


# --- loads ----------------------------------------------------------------------------


def _load(tables: Tables, path: str, warehouse: str, **options: object) -> DataFrame:
    return loads.load_snapshot(tables.spark, path, warehouse=warehouse, **options)


def _renamed(tables: Tables, select: str, target: str, name: str) -> str:
    item = ObjectConfig(parse(tables.text(select)), target=(target, name))
    path = scratch_dir(tables.spark, "snapshot")
    export_snapshot(tables.spark, JobConfig(objects=(item,)), path)
    return path


def _new_schema(tables: Tables) -> tuple[str, str]:
    """A target schema of its own, and the folder for its tables."""
    warehouse = scratch_dir(tables.spark, "warehouse")
    return f"t_{warehouse[-32:]}", warehouse


def _load_and_read(tables: Tables, path: str, name: str) -> DataFrame:
    schema, warehouse = _new_schema(tables)
    snapshot = manifests.open_snapshot(tables.spark, path)
    source = loads.find_object(snapshot, name)
    target = _renamed(tables, f"select * from {'.'.join(source.target)}", schema, name)
    _load(tables, target, warehouse)
    return relations.rows(tables.spark, schema, name)


@_query
def import_replace(tables: Tables) -> DataFrame:
    schema, warehouse = _new_schema(tables)
    path = _renamed(tables, "select * from @orders", schema, "orders")
    _load(tables, path, warehouse)
    _load(tables, path, warehouse)
    return relations.rows(tables.spark, schema, "orders")


@_query
def import_append(tables: Tables) -> DataFrame:
    schema, warehouse = _new_schema(tables)
    path = _renamed(tables, "select * from @orders", schema, "orders")
    _load(tables, path, warehouse, mode="append")  # creates the table
    _load(tables, path, warehouse, mode="append")
    return relations.rows(tables.spark, schema, "orders")


@_query
def append_subset_defaults(tables: Tables) -> DataFrame:
    schema, warehouse = _new_schema(tables)
    tables.spark.sql(f"CREATE SCHEMA {schema} LOCATION '{warehouse}/{schema}'")
    tables.spark.sql(
        f"CREATE TABLE {schema}.orders (channel STRING DEFAULT 'web', o_totalprice DOUBLE,"
        f" note STRING, o_orderkey BIGINT) USING parquet LOCATION '{warehouse}/{schema}/orders'"
    )
    path = _renamed(tables, "select o_orderkey, o_totalprice from @orders", schema, "orders")
    _load(tables, path, warehouse, mode="append")
    return relations.rows(tables.spark, schema, "orders")


@_query
def import_schema_only(tables: Tables) -> DataFrame:
    schema, warehouse = _new_schema(tables)
    path = _renamed(tables, "select * from @lineitem", schema, "lineitem")
    _load(tables, path, warehouse)
    _load(tables, path, warehouse, schema_only=True)  # empties the table again
    emptied = relations.rows(tables.spark, schema, "lineitem")
    return manifests.manifest_objects(tables.spark, path).select(
        "relation",
        F.col("rows").alias("snapshot_rows"),
        emptied.agg(F.count(F.lit(1))).scalar().alias("loaded_rows"),
        F.lit(len(emptied.columns)).alias("columns"),
    )


@_query
def append_compat_report(tables: Tables) -> DataFrame:
    """Append orders to a fitting and to an unfitting table: the column report, and how
    many rows each table holds afterwards."""
    reports = []
    for select in ("select * from @orders", "select * from @order_targets"):
        schema, warehouse = _new_schema(tables)
        _load(tables, _renamed(tables, select, schema, "orders"), warehouse)
        path = _renamed(tables, "select * from @orders", schema, "orders")
        item = manifests.open_snapshot(tables.spark, path).manifest.objects[0]
        target = relations.get(tables.spark, schema, "orders")
        report = loading.compatibility(
            item.column_names, [c.type for c in item.columns], target
        )
        try:
            _load(tables, path, warehouse, mode="append")
        except CrateError:
            pass
        held = relations.rows(tables.spark, schema, "orders").agg(F.count(F.lit(1))).scalar()
        reports.append(
            tables.spark.createDataFrame(report, loading.COMPAT_SCHEMA).select(
                F.lit(parse(tables.text(select)).name).alias("target"), "*", held.alias("rows")
            )
        )
    return reports[0].unionAll(reports[1])


@_query
def not_null_violations(tables: Tables) -> DataFrame:
    rows = tables.rows("odd_customers")
    return loading.not_null_violations(rows, rows.columns)


@_query
def key_watermark(tables: Tables) -> DataFrame:
    marked = []
    for name, select, columns in (
        ("orders", "select * from @orders", ["o_orderkey", "o_custkey"]),
        ("customer", "select * from @customer", ["c_custkey"]),
        ("part", "select * from @part where p_size < 0", ["p_partkey"]),
    ):
        marks = keys.key_watermark(tables.select(select), columns)
        marked.append(marks.select(F.lit(name).alias("relation"), "column", "next_value"))
    return marked[0].unionAll(marked[1]).unionAll(marked[2])


@_query
def assign_keys(tables: Tables) -> DataFrame:
    """Every event becomes an order with a fresh key after the largest one."""
    start = tables.rows("orders").agg(keys.next_value(F.col("o_orderkey"))).scalar()
    events = tables.rows("events").select("event_id", "user_id", "event_type")
    return keys.assign_keys(events, "new_orderkey", start, [F.col("event_type"), F.col("event_id")])


# --- statistics -----------------------------------------------------------------------


@_query
def row_counts(tables: Tables) -> DataFrame:
    sources = [(tables.schema, name) for name in TABLES]
    return describe.row_counts(tables.spark, sources).select("relation", "rows")


@_query
def describe_columns(tables: Tables) -> DataFrame:
    sources = [(tables.schema, name) for name in TABLES]
    counts = describe.row_counts(tables.spark, sources)
    facts = describe.column_facts(tables.spark, sources)
    return facts.join(counts, ["schema", "relation"]).select(
        "relation", "kind", "ordinal", "column", "type", "nullable", "rows"
    )


PROFILED = {
    "priced_orders": ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"],
    "odd_customers": ["c_custkey", "note", "lines", "c_acctbal", "c_nationkey"],
}


def _profiles(tables: Tables, measure: Callable[[DataFrame], DataFrame]) -> DataFrame:
    first, second = (
        measure(tables.rows(name)).select(F.lit(name).alias("relation"), "*") for name in PROFILED
    )
    return first.unionAll(second)


@_query
def profile_basic(tables: Tables) -> DataFrame:
    return _profiles(tables, profile.profile_exact).select(
        "relation",
        "column",
        "rows",
        F.round("null_fraction", 6).alias("null_fraction"),
        F.col("distinct_values").cast("bigint").alias("distinct_values"),
        F.round("average_width_bytes", 4).alias("average_width_bytes"),
    )


@_query
def profile_approx(tables: Tables) -> DataFrame:
    exact = _profiles(tables, profile.profile_exact)
    approximate = _profiles(tables, profile.profile_approximate)
    close = F.abs(approximate["distinct_values"] - exact["distinct_values"]) <= (
        0.05 * exact["distinct_values"]
    )
    same = F.abs(approximate["null_fraction"] - exact["null_fraction"]) < 1e-9
    width = F.abs(approximate["average_width_bytes"] - exact["average_width_bytes"]) < 1e-6
    return exact.join(
        approximate,
        (exact["relation"] == approximate["relation"]) & (exact["column"] == approximate["column"]),
    ).select(
        exact["relation"],
        exact["column"],
        exact["rows"],
        close.alias("distinct_is_close"),
        same.alias("null_fraction_agrees"),
        width.alias("width_agrees"),
    )


@_query
def profile_report(tables: Tables) -> DataFrame:
    rows = tables.rows("odd_customers")
    return describe.profile_report(profile.profile_exact(rows)).drop("width")


COMMON = {
    "orders": ["o_orderstatus", "o_orderpriority", "o_custkey"],
    "events": ["event_type", "user_id"],
    "odd_customers": ["note", "c_nationkey"],
}


@_query
def common_values(tables: Tables) -> DataFrame:
    found = None
    for name, columns in COMMON.items():
        one = profile.common_values(tables.rows(name), 3, columns).select(
            F.lit(name).alias("relation"),
            "column",
            "rank",
            "value",
            "rows",
            F.round("frequency", 9).alias("frequency"),
        )
        found = one if found is None else found.unionAll(one)
    return found


@_query
def common_values_many(tables: Tables) -> DataFrame:
    """More values per column than Spark's own rank pushdown covers."""
    return profile.common_values(tables.rows("lineitem"), 2_000, ["l_partkey", "l_suppkey"]).select(
        "column", "rank", "value", "rows"
    )


@_query
def common_values_all(tables: Tables) -> DataFrame:
    """Of every column of two tables, keys, prices and whole texts included."""
    found = None
    for name in ("documents", "lineitem"):
        one = profile.common_values(tables.rows(name), 5)
        one = one.select(F.lit(name).alias("relation"), "column", "rank", "value", "rows")
        found = one if found is None else found.unionAll(one)
    return found


@_query
def stored_statistics(tables: Tables) -> DataFrame:
    """Orders loaded in two batches, the second added to the stored sketches of the first:
    what the store says, and whether sketches of the whole table say the same."""
    schema, warehouse = _new_schema(tables)
    early = _renamed(tables, "select * from @orders where o_orderkey % 3 > 0", schema, "orders")
    _load(tables, early, warehouse)
    relation = relations.get(tables.spark, schema, "orders")
    sketches.analyze(tables.spark, relation, relations.rows(tables.spark, schema, "orders"))
    late = _renamed(tables, "select * from @orders where o_orderkey % 3 = 0", schema, "orders")
    _load(tables, late, warehouse, mode="append")
    held = sketches.summary(sketches.stored(tables.spark, relation), 1)
    whole = sketches.summary(sketches.sketch(tables.rows("orders")), 1).select(
        F.col("column").alias("of"), F.col("distinct_values").alias("all_distinct"), F.col("median").alias("middle")
    )
    first = F.when(F.col("common_is_exact"), F.get("common", F.lit(0)))
    return held.join(whole, F.col("column") == F.col("of")).select(
        "column",
        "rows",
        F.col("null_fraction"),
        (F.abs(F.col("distinct_values") - F.col("all_distinct")) <= 0.03 * F.col("all_distinct")).alias("distinct_agrees"),
        F.coalesce(F.abs(F.col("median") - F.col("middle")) <= 0.05 * F.abs("middle"), F.lit(True)).alias("median_is_close"),
        F.round("average_width_bytes", 6).alias("average_width_bytes"),
        first["value"].alias("first_value"),
        first["rows"].alias("first_rows"),
    )


LABELLED = {
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
    "customer": ["c_mktsegment", "c_name"],
}


@_query
def enum_labels(tables: Tables) -> DataFrame:
    found = None
    for name, columns in LABELLED.items():
        one = profile.enum_labels(tables.rows(name), 10, columns)
        one = one.select(F.lit(name).alias("relation"), "column", "position", "label")
        found = one if found is None else found.unionAll(one)
    return found


# --- constraints and comparison -------------------------------------------------------

FOREIGN_KEYS = (
    ("lineitem_order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem_part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders_customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer_nation", "customer", "c_nationkey", "nation", "n_nationkey"),
)
SELECTED = ("lineitem", "orders", "part")


@_query
def fk_outside_selection(tables: Tables) -> DataFrame:
    """Foreign keys that lead out of the selection, and how many rows use them."""
    schema = tables.schema
    declared = [
        Constraint((schema, child), name, "foreign_key", (column,), (schema, parent), (key,))
        for name, child, column, parent, key in FOREIGN_KEYS
    ]
    outside = quality.foreign_keys_outside(
        tables.spark, declared, [(schema, name) for name in SELECTED]
    )
    usage = None
    for name, child, column, _, _ in FOREIGN_KEYS:
        used = tables.rows(child).agg(F.count(column).alias("referencing_rows"))
        used = used.select(F.lit(name).alias("name"), "referencing_rows")
        usage = used if usage is None else usage.unionAll(used)
    return outside.join(usage, "name").select("name", "relation", "parent", "referencing_rows")


@_query
def fk_orphans(tables: Tables) -> DataFrame:
    parents = tables.select("select * from @orders where o_orderstatus <> 'F'")
    return quality.orphan_keys(tables.rows("lineitem"), ["l_orderkey"], parents, ["o_orderkey"])


@_query
def pk_duplicates(tables: Tables) -> DataFrame:
    return quality.duplicate_keys(tables.rows("lineitem"), ["l_orderkey", "l_linenumber"])


@_query
def constraint_report(tables: Tables) -> DataFrame:
    def of(relation: str, name: str, kind: str, **more: object) -> Constraint:
        return Constraint((tables.schema, relation), name, kind, **more)

    declared = [
        of("orders", "orders_pk", "primary_key", columns=("o_orderkey",)),
        of("customer", "customer_nation", "unique", columns=("c_nationkey",)),
        of("odd_customers", "odd_pk", "primary_key", columns=("c_custkey", "c_nationkey")),
        of("lineitem", "lineitem_order", "foreign_key", columns=("l_orderkey",),
           references=(tables.schema, "priced_orders"), referenced_columns=("o_orderkey",)),
        of("orders", "orders_supplier", "foreign_key", columns=("o_custkey",),
           references=(tables.schema, "supplier"), referenced_columns=("s_suppkey",)),
        of("orders", "priority_form", "check", expression=r"o_orderpriority rlike '^[1-3]\-\S+$'"),
        of("discounted_lines", "discount_range", "check", expression="l_discount <= 0.08"),
    ]
    report = quality.constraint_report(tables.spark, declared)
    return report.select("constraint", "kind", "violations")


@_query
def check_violations(tables: Tables) -> DataFrame:
    return quality.check_violations(tables.rows("discounted_lines"), "l_discount <= 0.08")


@_query
def reconcile_diff(tables: Tables) -> DataFrame:
    return reconcile(tables.rows("orders"), tables.rows("changed_orders"))


@_query
def reconcile_scattered(tables: Tables) -> DataFrame:
    """Changes all over a table: one row in twelve has another quantity."""
    return reconcile(tables.rows("lineitem"), tables.rows("recounted_lines"))


@_query
def reconcile_nested(tables: Tables) -> DataFrame:
    """Arrays inside structs inside an array, changed in one element or nulled."""
    found = reconcile(tables.rows("nested_vectors"), tables.rows("changed_vectors"))
    items = F.posexplode("items").alias("position", "item")
    return found.select("vec_id", "side", "copies", items).select(
        "vec_id", "side", "copies", "position", F.col("item.name").alias("name"),
        F.size("item.part").alias("size"), F.get("item.part", F.lit(0)).cast("double").alias("first_value"),
    )


# --- files of a snapshot ----------------------------------------------------------------

# Partition names that a path spells in another way.
ODD_PARTS = {"1-URGENT": "a b", "2-HIGH": "50%", "3-MEDIUM": "[x]", "4-NOT SPECIFIED": "{é,2}", "5-LOW": "q?*"}


@_query
def pinned_inputs(tables: Tables) -> DataFrame:
    """Rows of a table by partition, and whether the files of each partition are pinned."""
    spark = tables.spark
    schema, warehouse = _new_schema(tables)
    names = F.create_map(*[F.lit(text) for pair in ODD_PARTS.items() for text in pair])
    place = f"{warehouse}/parted"
    rows = tables.rows("orders").withColumn("part", names[F.col("o_orderpriority")])
    rows.write.partitionBy("part").parquet(place)
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{warehouse}/{schema}'")
    spark.sql(f"CREATE TABLE {schema}.parted USING parquet LOCATION '{place}'")
    spark.sql(f"MSCK REPAIR TABLE {schema}.parted")
    path = scratch_dir(spark, "snapshot")
    export_snapshot(spark, select_objects(f"select * from {schema}.parted"), path)
    snapshot = manifests.open_snapshot(spark, path)
    written = F.regexp_extract("path", "/part=([^/]*)/", 1)
    pinned = exports.pinned_inputs(spark, snapshot).select(F.url_decode(written).alias("part")).distinct()
    read = loads.read_object(spark, snapshot, snapshot.manifest.objects[0])
    counted = read.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(pinned.withColumn("pinned", F.lit(True)), "part", "full_outer")


@_query
def damaged_files(tables: Tables) -> DataFrame:
    """A snapshot whose orders were deleted and replaced by others, by file status."""
    spark = tables.spark
    path = _export(tables, "select * from @orders", "select * from @lineitem", file_ledger=True)
    snapshot = manifests.open_snapshot(spark, path)
    payload = f"{path}/{loads.find_object(snapshot, 'orders').payload}"
    MetadataFiles(spark).delete_tree(payload)
    tables.rows("changed_orders").write.option("compression", "zstd").parquet(payload)
    found = ledger.damaged_files(spark, snapshot)
    return found.groupBy(F.substring_index("object", ".", -1).alias("relation"), "status").agg(
        F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after")
    )


@_query
def import_view(tables: Tables) -> DataFrame:
    """A view and the tables below it, dropped and loaded again."""
    spark = tables.spark
    schema, warehouse = _new_schema(tables)
    files = {name: f"{tables.sf_dir}/{name}.parquet" for name in ("nation", "customer", "orders", "lineitem")}
    relations.register_files(spark, schema, files, f"{warehouse}/{schema}")
    spark.sql(f"CREATE VIEW {schema}.nation_revenue AS {view_body('nation_revenue', schema + '.')}")
    path = scratch_dir(spark, "snapshot")
    item = ObjectConfig(parse(f"select * from {schema}.nation_revenue"), export_as="view")
    export_snapshot(spark, JobConfig(objects=(item,)), path)
    spark.sql(f"DROP VIEW {schema}.nation_revenue")
    for name in files:
        spark.sql(f"DROP TABLE {schema}.{name}")
    _load(tables, path, warehouse)
    return relations.rows(spark, schema, "nation_revenue")


@_query
def import_defaults(tables: Tables) -> DataFrame:
    """Defaults travel: rows added to a loaded table without a channel get the first one's."""
    spark = tables.spark
    schema, warehouse = _new_schema(tables)
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{warehouse}/{schema}'")
    spark.sql(
        f"CREATE TABLE {schema}.sold (o_orderkey BIGINT, channel STRING DEFAULT 'web', points INT DEFAULT 2 + 3)"
        f" USING parquet LOCATION '{warehouse}/{schema}/sold'"
    )
    path = scratch_dir(spark, "snapshot")
    spark.sql(f"INSERT INTO {schema}.sold SELECT o_orderkey, 'shop', 1 FROM {tables.schema}.orders")
    item = ObjectConfig(parse(f"select * from {schema}.sold"), target=(schema, "sold_again"))
    export_snapshot(spark, JobConfig(objects=(item,)), path)
    _load(tables, path, warehouse)
    spark.sql(f"INSERT INTO {schema}.sold_again (o_orderkey) SELECT o_orderkey FROM {tables.schema}.orders")
    return relations.rows(spark, schema, "sold_again")
