"""A graph projected from the test tables, for running the graph operators at scale.

Regions, nations, customers and suppliers stand for classes that extend each
other; orders for service registrations; part types and brands for service
names, local keys and interfaces; market segments for permissions, of which some
are not declared. ``GRAPH_SQL`` states the same projection as SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.ids import canonical_json, stable_id
from factloom.graph import Graph
from factloom.session import table

NODE_COLUMNS = ("node_id", "node_type", "qualified_name", "display_name", "properties_json", "source_path", "line_start")
EDGE_COLUMNS = ("edge_type", "from_node_id", "to_node_id", "source_path", "line_start")


def _rows(df: DataFrame, columns: tuple[str, ...], **values) -> DataFrame:
    kinds = {"line_start": "long"}
    return df.select(*[values.get(c, F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in columns])


def status_of(order_status):
    return F.when(order_status == "F", "resolved").when(order_status == "O", "unresolved_key").otherwise("unresolved_instance")


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t, lit = F.col, lambda n: table(spark, sf_dir, n), F.lit
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else lit(p) for p in parts])
    day = lambda col: F.date_format(col, "yyyy-MM")
    part = t("part")

    def classes(df: DataFrame, kind: str, key: str, name: str, props, path, line) -> DataFrame:
        return _rows(df, NODE_COLUMNS, node_id=stable_id("JAVA_CLASS", text(f"{kind}.", c(key).cast("string"))), node_type=lit("JAVA_CLASS"), qualified_name=text(f"{kind}.", c(name)), display_name=c(name), properties_json=props, source_path=path, line_start=line)

    def named(df: DataFrame, node_type: str, name: str) -> DataFrame:
        return _rows(df.select(name).distinct(), NODE_COLUMNS, node_id=stable_id(node_type, c(name)), node_type=lit(node_type), qualified_name=c(name), display_name=c(name), properties_json=lit("{}"))

    found = [
        classes(t("region"), "region", "r_regionkey", "r_name", lit("{}"), lit("model/region.java"), c("r_regionkey") + 1),
        classes(t("nation"), "nation", "n_nationkey", "n_name", lit("{}"), lit("model/nation.java"), c("n_nationkey") + 1),
        classes(t("customer"), "customer", "c_custkey", "c_name", canonical_json(repository=c("c_mktsegment")), text("customer/", c("c_nationkey").cast("string"), "/", c("c_custkey").cast("string"), ".java"), lit(1)),
        classes(t("supplier"), "supplier", "s_suppkey", "s_name", lit("{}"), text("supplier/tests/", c("s_suppkey").cast("string"), ".java"), lit(1)),
        named(part, "AIDL_INTERFACE", "p_brand"),
        named(part, "BINDER_SERVICE_NAME", "p_type"),
        named(part, "LOCAL_SERVICE_KEY", "p_brand"),
        named(t("customer").where(c("c_mktsegment") < "F"), "PERMISSION", "c_mktsegment"),
        _rows(t("orders"), NODE_COLUMNS, node_id=stable_id("SERVICE_REGISTRATION", c("o_orderkey").cast("string")), node_type=lit("SERVICE_REGISTRATION"), qualified_name=text("order#", c("o_orderkey").cast("string")), display_name=text("order@", c("o_orderkey").cast("string")),
              properties_json=canonical_json(resolution_status=status_of(c("o_orderstatus")), repository=c("o_orderpriority")), source_path=text("orders/", day("o_orderdate"), ".java"), line_start=F.dayofmonth("o_orderdate")),
    ]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t, lit = F.col, lambda n: table(spark, sf_dir, n), F.lit
    ident = lambda kind, key: stable_id("JAVA_CLASS", F.concat(lit(f"{kind}."), c(key).cast("string")))
    edge = lambda df, kind, a, b, path=lit(None), line=lit(None): _rows(df, EDGE_COLUMNS, edge_type=lit(kind), from_node_id=a, to_node_id=b, source_path=path, line_start=line)
    registration = stable_id("SERVICE_REGISTRATION", c("o_orderkey").cast("string"))
    # At most 25 brands, numbered in their order.
    brands = F.broadcast(t("part").agg(F.sort_array(F.collect_set("p_brand")).alias("brands")))
    brand_of = lambda df, key: df.crossJoin(brands).withColumn("brand", F.get("brands", (c(key) % F.size("brands")).cast("int")))
    first = t("lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.min("l_partkey").alias("p_partkey"))
    ordered = t("orders").select("o_orderkey", "o_custkey", "o_orderdate").join(first, "o_orderkey").join(t("part").select("p_partkey", "p_type", "p_brand"), "p_partkey")
    path, line = F.concat(lit("orders/"), F.date_format("o_orderdate", "yyyy-MM"), lit(".java")), F.dayofmonth("o_orderdate")
    odd, even = ordered.where(c("o_orderkey") % 2 == 1), ordered.where(c("o_orderkey") % 2 == 0)
    found = [
        edge(t("nation"), "EXTENDS", ident("nation", "n_nationkey"), ident("region", "n_regionkey")),
        edge(t("customer"), "EXTENDS", ident("customer", "c_custkey"), ident("nation", "c_nationkey")),
        edge(t("supplier"), "EXTENDS", ident("supplier", "s_suppkey"), ident("nation", "s_nationkey")),
        edge(brand_of(t("nation"), "n_nationkey"), "IMPLEMENTS_BINDER", ident("nation", "n_nationkey"), stable_id("AIDL_INTERFACE", c("brand"))),
        edge(brand_of(t("supplier"), "s_suppkey"), "IMPLEMENTS_BINDER", ident("supplier", "s_suppkey"), stable_id("AIDL_INTERFACE", c("brand"))),
        edge(t("customer"), "ENFORCES_PERMISSION", ident("customer", "c_custkey"), stable_id("PERMISSION", c("c_mktsegment"))),
        edge(odd, "REGISTERS_BINDER_NAME", registration, stable_id("BINDER_SERVICE_NAME", c("p_type")), path, line),
        edge(even, "REGISTERS_LOCAL_KEY", registration, stable_id("LOCAL_SERVICE_KEY", c("p_brand")), path, line),
        edge(ordered, "REGISTERS_INSTANCE", registration, ident("customer", "o_custkey"), path, line),
        edge(odd.select("o_custkey", "p_type").distinct(), "REGISTERED_AS", ident("customer", "o_custkey"), stable_id("BINDER_SERVICE_NAME", c("p_type"))),
        edge(even.select("o_custkey", "p_brand").distinct(), "EXPOSED_AS_LOCAL_SERVICE", ident("customer", "o_custkey"), stable_id("LOCAL_SERVICE_KEY", c("p_brand"))),
    ]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def warehouse_graph(spark: SparkSession, sf_dir: str) -> Graph:
    return Graph(nodes(spark, sf_dir), edges(spark, sf_dir))


GRAPH_SQL = """
first_part AS (SELECT l_orderkey AS o_orderkey, min(l_partkey) AS p_partkey FROM lineitem GROUP BY 1),
ordered AS (SELECT o.o_orderkey, o_custkey, o_orderdate, p_type, p_brand, 'orders/' || strftime(o_orderdate, '%Y-%m') || '.java' AS path, day(o_orderdate) AS line
  FROM orders o JOIN first_part f USING (o_orderkey) JOIN part p USING (p_partkey)),
brand AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS n, count(*) OVER () AS total FROM (SELECT DISTINCT p_brand FROM part)),
node AS (
  SELECT 'JAVA_CLASS:region.' || r_regionkey AS node_id, 'JAVA_CLASS' AS node_type, 'region.' || r_name AS qualified_name, r_name AS display_name, '{}' AS properties_json, 'model/region.java' AS source_path, CAST(r_regionkey + 1 AS BIGINT) AS line_start FROM region
  UNION ALL SELECT 'JAVA_CLASS:nation.' || n_nationkey, 'JAVA_CLASS', 'nation.' || n_name, n_name, '{}', 'model/nation.java', n_nationkey + 1 FROM nation
  UNION ALL SELECT 'JAVA_CLASS:customer.' || c_custkey, 'JAVA_CLASS', 'customer.' || c_name, c_name, '{"repository": "' || c_mktsegment || '"}', 'customer/' || c_nationkey || '/' || c_custkey || '.java', 1 FROM customer
  UNION ALL SELECT 'JAVA_CLASS:supplier.' || s_suppkey, 'JAVA_CLASS', 'supplier.' || s_name, s_name, '{}', 'supplier/tests/' || s_suppkey || '.java', 1 FROM supplier
  UNION ALL SELECT DISTINCT 'AIDL_INTERFACE:' || p_brand, 'AIDL_INTERFACE', p_brand, p_brand, '{}', NULL, NULL::BIGINT FROM part
  UNION ALL SELECT DISTINCT 'BINDER_SERVICE_NAME:' || p_type, 'BINDER_SERVICE_NAME', p_type, p_type, '{}', NULL, NULL::BIGINT FROM part
  UNION ALL SELECT DISTINCT 'LOCAL_SERVICE_KEY:' || p_brand, 'LOCAL_SERVICE_KEY', p_brand, p_brand, '{}', NULL, NULL::BIGINT FROM part
  UNION ALL SELECT DISTINCT 'PERMISSION:' || c_mktsegment, 'PERMISSION', c_mktsegment, c_mktsegment, '{}', NULL, NULL::BIGINT FROM customer WHERE c_mktsegment < 'F'
  UNION ALL SELECT 'SERVICE_REGISTRATION:' || o_orderkey, 'SERVICE_REGISTRATION', 'order#' || o_orderkey, 'order@' || o_orderkey,
    '{"repository": "' || o_orderpriority || '", "resolution_status": "' || CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'O' THEN 'unresolved_key' ELSE 'unresolved_instance' END || '"}',
    'orders/' || strftime(o_orderdate, '%Y-%m') || '.java', day(o_orderdate) FROM orders),
edge AS (
  SELECT 'EXTENDS' AS edge_type, 'JAVA_CLASS:nation.' || n_nationkey AS from_node_id, 'JAVA_CLASS:region.' || n_regionkey AS to_node_id, NULL::VARCHAR AS source_path, NULL::BIGINT AS line_start FROM nation
  UNION ALL SELECT 'EXTENDS', 'JAVA_CLASS:customer.' || c_custkey, 'JAVA_CLASS:nation.' || c_nationkey, NULL, NULL FROM customer
  UNION ALL SELECT 'EXTENDS', 'JAVA_CLASS:supplier.' || s_suppkey, 'JAVA_CLASS:nation.' || s_nationkey, NULL, NULL FROM supplier
  UNION ALL SELECT 'IMPLEMENTS_BINDER', 'JAVA_CLASS:nation.' || n_nationkey, 'AIDL_INTERFACE:' || p_brand, NULL, NULL FROM nation, brand WHERE n_nationkey % total = n
  UNION ALL SELECT 'IMPLEMENTS_BINDER', 'JAVA_CLASS:supplier.' || s_suppkey, 'AIDL_INTERFACE:' || p_brand, NULL, NULL FROM supplier, brand WHERE s_suppkey % total = n
  UNION ALL SELECT 'ENFORCES_PERMISSION', 'JAVA_CLASS:customer.' || c_custkey, 'PERMISSION:' || c_mktsegment, NULL, NULL FROM customer
  UNION ALL SELECT 'REGISTERS_BINDER_NAME', 'SERVICE_REGISTRATION:' || o_orderkey, 'BINDER_SERVICE_NAME:' || p_type, path, line FROM ordered WHERE o_orderkey % 2 = 1
  UNION ALL SELECT 'REGISTERS_LOCAL_KEY', 'SERVICE_REGISTRATION:' || o_orderkey, 'LOCAL_SERVICE_KEY:' || p_brand, path, line FROM ordered WHERE o_orderkey % 2 = 0
  UNION ALL SELECT 'REGISTERS_INSTANCE', 'SERVICE_REGISTRATION:' || o_orderkey, 'JAVA_CLASS:customer.' || o_custkey, path, line FROM ordered
  UNION ALL SELECT DISTINCT 'REGISTERED_AS', 'JAVA_CLASS:customer.' || o_custkey, 'BINDER_SERVICE_NAME:' || p_type, NULL, NULL::BIGINT FROM ordered WHERE o_orderkey % 2 = 1
  UNION ALL SELECT DISTINCT 'EXPOSED_AS_LOCAL_SERVICE', 'JAVA_CLASS:customer.' || o_custkey, 'LOCAL_SERVICE_KEY:' || p_brand, NULL, NULL::BIGINT FROM ordered WHERE o_orderkey % 2 = 0)"""


def graph_sql(query: str, *ctes: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' * recursive}{','.join([GRAPH_SQL, *ctes])}\n{query}"
