"""The given tables and a few views over them, as catalog relations."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablecrate.operators.selection import parse
from tablecrate.session import job_session, scratch_dir
from tablecrate.sources import relations

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The tables hold no NULL, no empty text and no broken reference, so the views make some,
# always over all rows. Each body is plain SQL that the oracle shares.
VIEWS = {
    "priced_orders": """
        SELECT o_orderkey, o_custkey, o_orderpriority,
               CASE WHEN o_totalprice > 499000 THEN NULL ELSE o_totalprice END AS o_totalprice
        FROM {orders}""",
    "odd_customers": """
        SELECT c_custkey,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
                    WHEN c_mktsegment = 'MACHINERY' THEN ''
                    WHEN c_mktsegment = 'FURNITURE' THEN chr(92) || chr(92) || 'N'
                    ELSE '  "' || c_name || '", it''s a ' || chr(92) || 'n back' || chr(92)
                         || 'slash ' END AS note,
               CASE WHEN c_acctbal < 0 THEN NULL
                    ELSE c_name || chr(10) || 'line, two' || chr(13) || chr(10) END AS lines,
               CASE WHEN c_acctbal < 500 THEN NULL ELSE c_acctbal END AS c_acctbal,
               CASE WHEN c_nationkey < 5 THEN NULL ELSE c_nationkey END AS c_nationkey
        FROM {customer}""",
    "discounted_lines": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END AS l_discount
        FROM {lineitem}""",
    "nation_revenue": """
        SELECT n.n_name, count(*) AS line_count,
               CAST(sum(CAST(l.l_extendedprice AS decimal(15,2))
                        * (1 - CAST(l.l_discount AS decimal(15,2)))) AS double) AS revenue
        FROM {lineitem} l
        JOIN {orders} o ON o.o_orderkey = l.l_orderkey
        JOIN {customer} c ON c.c_custkey = o.o_custkey
        JOIN {nation} n ON n.n_nationkey = c.c_nationkey
        GROUP BY n.n_name""",
    "order_lines": """
        SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_quantity
        FROM {orders} o JOIN {lineitem} l ON l.l_orderkey = o.o_orderkey""",
    "customer_lines": """
        WITH buyers AS (SELECT c_custkey, c_mktsegment FROM {customer})
        SELECT b.c_custkey, b.c_mktsegment, l.l_quantity
        FROM {order_lines} l JOIN buyers b ON b.c_custkey = l.o_custkey""",
    "segment_report": """
        SELECT c_mktsegment, count(*) AS line_count FROM {customer_lines}
        GROUP BY c_mktsegment""",
    "changed_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_totalprice > 495000 THEN 0.0 ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM {orders} WHERE o_totalprice > 5000
        UNION ALL SELECT * FROM {orders} WHERE o_totalprice > 490000""",
    "recounted_lines": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CASE WHEN (l_orderkey * 7 + l_linenumber) % 12 = 0 THEN l_quantity + 1
                    ELSE l_quantity END AS l_quantity,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        FROM {lineitem}""",
    "order_targets": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS decimal(12,2)) AS o_totalprice
        FROM {orders}""",
}


# Nested values have no SQL that both engines read; the oracle says the same in its own.
NESTED_VIEWS = {
    "nested_vectors": """
        SELECT vec_id, array(named_struct('name', 'whole', 'part', embedding),
                             named_struct('name', 'label', 'part', array(CAST(label AS float)))) AS items
        FROM {embeddings}""",
    "changed_vectors": """
        SELECT vec_id, CASE vec_id % 5
            WHEN 0 THEN array(named_struct('name', 'whole', 'part', embedding),
                              named_struct('name', 'label', 'part', CAST(NULL AS array<float>)))
            WHEN 1 THEN array(named_struct('name', 'whole', 'part', concat(array(CAST(0 AS float)), embedding)),
                              items[1])
            WHEN 2 THEN array(named_struct('name', 'whole', 'part', concat(embedding, items[1].part)),
                              named_struct('name', 'label', 'part', CAST(array() AS array<float>)))
            ELSE items END AS items
        FROM {nested_vectors} JOIN {embeddings} USING (vec_id)
        UNION ALL SELECT * FROM {nested_vectors} WHERE vec_id % 50 = 3""",
}


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    schema: str
    sf_dir: str

    def rows(self, name: str) -> DataFrame:
        return relations.rows(self.spark, self.schema, name)

    def text(self, select: str) -> str:
        """Selection text with `@` for the schema."""
        return select.replace("@", f"{self.schema}.")

    def select(self, select: str) -> DataFrame:
        selection = parse(self.text(select))
        source = relations.rows(self.spark, *selection.source)
        return selection.rows(source)


def view_body(name: str, qualify: str) -> str:
    names = {key: f"{qualify}{key}" for key in (*TABLES, *VIEWS, *NESTED_VIEWS)}
    return (VIEWS | NESTED_VIEWS)[name].format(**names)


def open_tables(spark: SparkSession, sf_dir: str) -> Tables:
    session = job_session(spark)
    sf_dir = sf_dir.rstrip("/")
    # A catalog that outlives the session must not serve older view bodies.
    schema = f"sf_{zlib.crc32(repr((sf_dir, VIEWS, NESTED_VIEWS)).encode()):08x}"
    if not session.catalog.databaseExists(schema):
        files = {name: f"{sf_dir}/{name}.parquet" for name in TABLES}
        relations.register_files(session, schema, files, scratch_dir(session, schema))
        for name in (*VIEWS, *NESTED_VIEWS):
            session.sql(f"CREATE VIEW {schema}.{name} AS {view_body(name, schema + '.')}")
    return Tables(session, schema, sf_dir)
