"""The registered queries of the graph engine, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import text as tx
from factloom.functions.ids import edge_hash, edge_id, node_hash
from factloom.graph import first_wins, last_wins
from factloom.operators import graph_queries as gq
from factloom.operators import integrity, match
from factloom.operators.closure import closure, closure_sql, resolve_chain
from factloom.session import table
from factloom.warehouse import graph_sql, warehouse_graph

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


WALK = """walk(class_id, ancestor_id, depth, visited) AS (
  SELECT from_node_id, to_node_id, 1, [from_node_id, to_node_id] FROM edge WHERE edge_type = 'EXTENDS'
  UNION ALL SELECT w.class_id, e.to_node_id, w.depth + 1, list_append(w.visited, e.to_node_id) FROM walk w JOIN edge e ON e.from_node_id = w.ancestor_id
  WHERE e.edge_type = 'EXTENDS' AND w.depth < 20 AND NOT list_contains(w.visited, e.to_node_id))"""


@registered(graph_sql("""SELECT i.qualified_name AS implementation, a.qualified_name AS binder_interface, a.source_path AS aidl_file FROM edge e
  JOIN node i ON i.node_id = e.from_node_id JOIN node a ON a.node_id = e.to_node_id WHERE e.edge_type = 'IMPLEMENTS_BINDER' AND i.qualified_name = 'nation.' || (SELECT min(n_name) FROM nation)"""))
def endpoint_join(spark: SparkSession, d: str) -> DataFrame:
    name = table(spark, d, "nation").agg(F.min("n_name")).first()[0]
    return gq.binder_of(warehouse_graph(spark, d), f"nation.{name}")


@registered(graph_sql("""SELECT i.qualified_name AS implementation, a.qualified_name AS binder_interface, i.source_path FROM edge e
  JOIN node i ON i.node_id = e.from_node_id JOIN node a ON a.node_id = e.to_node_id WHERE e.edge_type = 'IMPLEMENTS_BINDER' AND a.qualified_name = 'Brand#11'"""))
def binder_by_interface(spark: SparkSession, d: str) -> DataFrame:
    return gq.implementations_of(warehouse_graph(spark, d), "Brand#11")


@registered(graph_sql("SELECT node_type, count(*) AS count FROM node GROUP BY 1"))
def node_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return gq.type_counts(warehouse_graph(spark, d))


@registered(graph_sql("SELECT edge_type, count(*) AS count FROM edge GROUP BY 1"))
def edge_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return gq.type_counts(warehouse_graph(spark, d), edges=True)


@registered(graph_sql("SELECT node_type, count(*) AS count FROM node WHERE node_type IN ('SERVICE_REGISTRATION', 'BINDER_SERVICE_NAME', 'LOCAL_SERVICE_KEY') GROUP BY 1"))
def service_node_counts(spark: SparkSession, d: str) -> DataFrame:
    return gq.type_counts(warehouse_graph(spark, d), only=gq.REGISTRATION_TYPES)


@registered(graph_sql("SELECT edge_type, count(*) AS count FROM edge WHERE edge_type IN ('REGISTERS_BINDER_NAME', 'REGISTERS_LOCAL_KEY', 'REGISTERS_INSTANCE', 'REGISTERED_AS', 'EXPOSED_AS_LOCAL_SERVICE') GROUP BY 1"))
def service_edge_counts(spark: SparkSession, d: str) -> DataFrame:
    return gq.type_counts(warehouse_graph(spark, d), edges=True, only=gq.REGISTRATION_EDGES)


@registered(graph_sql("SELECT json_extract_string(properties_json, '$.resolution_status') AS resolution_status, count(*) AS count FROM node WHERE node_type = 'SERVICE_REGISTRATION' GROUP BY 1"))
def json_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return gq.property_counts(warehouse_graph(spark, d), "SERVICE_REGISTRATION", "resolution_status")


@registered(graph_sql("SELECT json_extract_string(properties_json, '$.repository') AS repository, count(*) AS count FROM node WHERE node_type = 'JAVA_CLASS' GROUP BY 1"))
def json_null_group_counts(spark: SparkSession, d: str) -> DataFrame:
    return gq.property_counts(warehouse_graph(spark, d), "JAVA_CLASS", "repository")


@registered(graph_sql("SELECT json_extract_string(properties_json, '$.repository') AS repository, node_type, count(*) AS count FROM node WHERE json_extract_string(properties_json, '$.repository') IS NOT NULL GROUP BY 1, 2"))
def json_two_key_counts(spark: SparkSession, d: str) -> DataFrame:
    return gq.coverage(warehouse_graph(spark, d))


CHAIN = """FROM edge r JOIN node i ON i.node_id = r.from_node_id JOIN node s ON s.node_id = r.to_node_id
  JOIN edge k ON k.to_node_id = s.node_id AND k.edge_type = '{key}' JOIN edge n ON n.from_node_id = k.from_node_id AND n.to_node_id = i.node_id AND n.edge_type = 'REGISTERS_INSTANCE'
  JOIN node g ON g.node_id = k.from_node_id AND g.node_type = 'SERVICE_REGISTRATION'"""


@registered(graph_sql(f"""SELECT DISTINCT s.qualified_name AS service_name, i.qualified_name AS implementation, a.qualified_name AS binder_interface, g.source_path, g.line_start
  {CHAIN.format(key='REGISTERS_BINDER_NAME')} LEFT JOIN edge b ON b.from_node_id = i.node_id AND b.edge_type = 'IMPLEMENTS_BINDER' LEFT JOIN node a ON a.node_id = b.to_node_id
  WHERE r.edge_type = 'REGISTERED_AS'"""))
def service_chain(spark: SparkSession, d: str) -> DataFrame:
    return gq.service_chain(warehouse_graph(spark, d))


@registered(graph_sql(f"""SELECT DISTINCT s.qualified_name AS service_name, i.qualified_name AS implementation, b.qualified_name AS binder_base, a.qualified_name AS binder_interface, w.depth, g.source_path, g.line_start
  {CHAIN.format(key='REGISTERS_BINDER_NAME')} JOIN walk w ON w.class_id = i.node_id JOIN edge e ON e.from_node_id = w.ancestor_id AND e.edge_type = 'IMPLEMENTS_BINDER'
  JOIN node b ON b.node_id = w.ancestor_id JOIN node a ON a.node_id = e.to_node_id WHERE r.edge_type = 'REGISTERED_AS'""", WALK, recursive=True))
def inherited_service_chain(spark: SparkSession, d: str) -> DataFrame:
    return gq.inherited_service_chain(warehouse_graph(spark, d))


@registered(graph_sql(f"""SELECT s.qualified_name AS local_service_key, i.qualified_name AS implementation, g.source_path, g.line_start {CHAIN.format(key='REGISTERS_LOCAL_KEY')}
  WHERE r.edge_type = 'EXPOSED_AS_LOCAL_SERVICE'"""))
def local_services_fixed(spark: SparkSession, d: str) -> DataFrame:
    return gq.local_services(warehouse_graph(spark, d), limit=None)


@registered(graph_sql("""SELECT k.qualified_name AS local_service_key, i.qualified_name AS implementation, g.source_path, g.line_start FROM edge x
  JOIN node i ON i.node_id = x.from_node_id JOIN node k ON k.node_id = x.to_node_id LEFT JOIN node g ON g.node_type = 'SERVICE_REGISTRATION'
  WHERE x.edge_type = 'EXPOSED_AS_LOCAL_SERVICE' ORDER BY 1, 2, 3, 4 LIMIT 100"""))
def local_services_parity(spark: SparkSession, d: str) -> DataFrame:
    return gq.local_services(warehouse_graph(spark, d), parity=True)


@registered(graph_sql("SELECT class_id, ancestor_id, depth FROM walk", WALK, recursive=True))
def closure_exact(spark: SparkSession, d: str) -> DataFrame:
    return closure(warehouse_graph(spark, d).links("EXTENDS"))


#: All parts, those of each fifty in rings: ids such as P:1 are parts of others, so the two guards differ.
RING = """ring AS (SELECT 'P:' || p_partkey AS from_node_id, 'P:' || (p_partkey - p_partkey % 50 + (p_partkey * 7 + 1) % 50) AS to_node_id FROM part)"""


def _ring(spark: SparkSession, d: str) -> DataFrame:
    ident = lambda x: F.concat(F.lit("P:"), x.cast("string"))
    key = F.col("p_partkey")
    return table(spark, d, "part").select(ident(key).alias("from_node_id"), ident(key - key % 50 + (key * 7 + 1) % 50).alias("to_node_id"))


def _ring_sql(start: str, step: str, guard: str) -> str:
    return f"""WITH RECURSIVE {RING}, walk(class_id, ancestor_id, depth, visited) AS (SELECT from_node_id, to_node_id, 1, {start} FROM ring
      UNION ALL SELECT w.class_id, e.to_node_id, w.depth + 1, {step} FROM walk w JOIN ring e ON e.from_node_id = w.ancestor_id WHERE w.depth < 20 AND {guard})
      SELECT class_id, ancestor_id, depth FROM walk"""


@registered(_ring_sql("[from_node_id, to_node_id]", "list_append(w.visited, e.to_node_id)", "NOT list_contains(w.visited, e.to_node_id)"))
def closure_cyclic(spark: SparkSession, d: str) -> DataFrame:
    return closure(_ring(spark, d))


@registered(_ring_sql("from_node_id || '|' || to_node_id", "w.visited || '|' || e.to_node_id", "instr(w.visited, e.to_node_id) = 0"))
def closure_parity(spark: SparkSession, d: str) -> DataFrame:
    return closure(_ring(spark, d), guard="substring")


@registered(_ring_sql("[from_node_id, to_node_id]", "list_append(w.visited, e.to_node_id)", "NOT list_contains(w.visited, e.to_node_id)"))
def closure_recursive_sql(spark: SparkSession, d: str) -> DataFrame:
    return closure_sql(spark, _ring(spark, d))


@registered(graph_sql("""SELECT DISTINCT i.qualified_name AS implementation, b.qualified_name AS binder_base, a.qualified_name AS binder_interface, w.depth FROM walk w
  JOIN edge e ON e.from_node_id = w.ancestor_id AND e.edge_type = 'IMPLEMENTS_BINDER' JOIN node i ON i.node_id = w.class_id JOIN node b ON b.node_id = w.ancestor_id JOIN node a ON a.node_id = e.to_node_id""", WALK, recursive=True))
def transitive_binder(spark: SparkSession, d: str) -> DataFrame:
    return gq.transitive_binder(warehouse_graph(spark, d))


@registered(graph_sql("""SELECT edge_type, 'from' AS side, from_node_id AS node_id FROM edge e WHERE NOT EXISTS (SELECT 1 FROM node WHERE node_id = e.from_node_id)
  UNION ALL SELECT edge_type, 'to', to_node_id FROM edge e WHERE NOT EXISTS (SELECT 1 FROM node WHERE node_id = e.to_node_id)"""))
def fk_check(spark: SparkSession, d: str) -> DataFrame:
    return integrity.foreign_keys(warehouse_graph(spark, d))


@registered(graph_sql("SELECT from_node_id, to_node_id, 'to_node_id_missing' AS reason FROM edge e WHERE edge_type = 'ENFORCES_PERMISSION' AND NOT EXISTS (SELECT 1 FROM node WHERE node_id = e.to_node_id)"))
def unresolved_edges(spark: SparkSession, d: str) -> DataFrame:
    g = warehouse_graph(spark, d)
    return integrity.unresolved(g.links("ENFORCES_PERMISSION").select("from_node_id", "to_node_id"), g.nodes, "from_node_id", "to_node_id")


@registered(graph_sql("SELECT from_node_id, to_node_id FROM edge e WHERE edge_type = 'ENFORCES_PERMISSION' AND EXISTS (SELECT 1 FROM node WHERE node_id = e.to_node_id)"))
def endpoint_exists(spark: SparkSession, d: str) -> DataFrame:
    g = warehouse_graph(spark, d)
    return integrity.existing(g.links("ENFORCES_PERMISSION").select("from_node_id", "to_node_id"), "to_node_id", g.nodes)


@registered("""SELECT CAST(count(*) FILTER (WHERE p_partkey IS NOT NULL) AS BIGINT) AS resolved, CAST(count(*) FILTER (WHERE p_partkey IS NULL) AS BIGINT) AS missing_owner, count(*) AS total
  FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON l_partkey = p_partkey""")
def owner_resolution(spark: SparkSession, d: str) -> DataFrame:
    owners = table(spark, d, "part").where("p_size > 10").select("p_partkey")
    joined = table(spark, d, "lineitem").select("l_partkey").join(owners, F.col("l_partkey") == F.col("p_partkey"), "left")
    return joined.agg(F.count_if(F.col("p_partkey").isNotNull()).alias("resolved"), F.count_if(F.col("p_partkey").isNull()).alias("missing_owner"), F.count("*").alias("total"))


def _calls(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, d, "events")
    return events.where("event_type = 'purchase'").select("user_id", "ts", "event_id"), events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("near"))


@registered("""SELECT p.event_id, p.user_id, max_by(v.event_id, v.ts) AS near FROM (SELECT * FROM events WHERE event_type = 'purchase') p
  LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON v.user_id = p.user_id AND v.ts <= p.ts GROUP BY 1, 2""")
def asof_backward(spark: SparkSession, d: str) -> DataFrame:
    left, right = _calls(spark, d)
    return match.asof(left, right, "user_id", "ts", "near").select("event_id", "user_id", "near")


@registered("""SELECT p.event_id, p.user_id, min_by(v.event_id, v.ts) AS near FROM (SELECT * FROM events WHERE event_type = 'purchase') p
  LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON v.user_id = p.user_id AND v.ts >= p.ts GROUP BY 1, 2""")
def asof_forward(spark: SparkSession, d: str) -> DataFrame:
    left, right = _calls(spark, d)
    return match.asof(left, right, "user_id", "ts", "near", forward=True).select("event_id", "user_id", "near")


@registered("""WITH r AS (SELECT l_orderkey AS k, l_linenumber AS n, l_linenumber * 10 AS s, 200 - l_linenumber * 10 AS e FROM lineitem),
  p AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) % 200 AS at FROM orders)
  SELECT p.k, p.at, max_by(r.n, r.s) AS inner_line FROM p LEFT JOIN r ON r.k = p.k AND r.s < p.at AND p.at < r.e GROUP BY 1, 2""")
def innermost_interval(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order as nested ranges [10 n, 200 - 10 n]; a place in the order falls into the innermost."""
    n = F.col("l_linenumber")
    ranges = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), n.alias("inner_line"), (n * 10).alias("s"), (200 - n * 10).alias("e"))
    points = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (F.floor("o_totalprice").cast("long") % 200).alias("at"))
    return match.innermost(points, ranges, "k", "at", "s", "e", "inner_line")


@registered(graph_sql("""SELECT n.node_id, max_by(p.name, length(p.prefix)) AS repository FROM (SELECT * FROM node WHERE node_type = 'JAVA_CLASS') n
  LEFT JOIN prefixes p ON n.source_path = p.prefix OR starts_with(n.source_path, p.prefix || '/') GROUP BY 1""",
  "prefixes AS (SELECT 'customer' AS prefix, 'customer' AS name UNION ALL SELECT 'supplier/tests', 'supplier tests' UNION ALL SELECT 'supplier', 'supplier' UNION ALL SELECT 'customer/' || n_nationkey, n_name FROM nation WHERE n_regionkey > 1)"))
def longest_prefix(spark: SparkSession, d: str) -> DataFrame:
    fixed = spark.createDataFrame([("customer", "customer"), ("supplier/tests", "supplier tests"), ("supplier", "supplier")], "prefix string, name string")
    nations = table(spark, d, "nation").where("n_regionkey > 1").select(F.concat(F.lit("customer/"), F.col("n_nationkey").cast("string")).alias("prefix"), F.col("n_name").alias("name"))
    nodes = warehouse_graph(spark, d).of_type("JAVA_CLASS").select("node_id", "source_path")
    return match.longest_prefix(nodes, fixed.unionByName(nations), "source_path", "prefix", "name").select("node_id", F.col("name").alias("repository"))


@registered("""WITH uniq AS (SELECT p_name AS k, CASE WHEN count(*) = 1 THEN min(p_partkey) END AS v FROM part GROUP BY 1),
  line AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
  c AS (SELECT l_partkey, l_suppkey, 0 AS rank, p.p_partkey AS hit FROM line JOIN part p ON p.p_partkey = l_partkey + 1000
   UNION ALL SELECT l_partkey, l_suppkey, 1, p.p_partkey FROM line JOIN part p ON p.p_partkey = l_suppkey AND p.p_size > 25
   UNION ALL SELECT l.l_partkey, l.l_suppkey, 2, u.v FROM line l JOIN part p ON p.p_partkey = l.l_partkey JOIN uniq u ON u.k = p.p_name AND u.v IS NOT NULL)
  SELECT l.l_partkey, l.l_suppkey, min_by(c.hit, c.rank) AS target FROM line l LEFT JOIN c ON c.l_partkey = l.l_partkey AND c.l_suppkey = l.l_suppkey GROUP BY 1, 2""")
def ranked_lookup(spark: SparkSession, d: str) -> DataFrame:
    """For part and supplier: the part numbered 1000 further, else a large one numbered as the supplier, else the only one of the part's name."""
    lines, part = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct(), table(spark, d, "part")
    named = match.unique_or_null(part, "p_name", "p_partkey").where("p_partkey is not null").select("p_name", F.col("p_partkey").alias("only"))
    names = lines.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey", "left").join(named, "p_name", "left")
    choices = match.ranked(F.concat(F.lit("any:"), (F.col("l_partkey") + 1000).cast("string")), F.concat(F.lit("large:"), F.col("l_suppkey").cast("string")), F.concat(F.lit("any:"), F.col("only").cast("string")))
    candidates = names.select(F.struct("l_partkey", "l_suppkey").alias("id"), F.explode(choices).alias("c")).select("id", "c.rank", "c.candidate")
    kinds = F.explode(F.array(F.lit("any:"), F.when(F.col("p_size") > 25, F.lit("large:")))).alias("kind")
    targets = part.select(kinds, "p_partkey").where("kind is not null").select(F.concat("kind", F.col("p_partkey").cast("string")).alias("name"), F.col("p_partkey").alias("target"))
    best = match.first_match(candidates, targets, "id", "rank", "candidate", "name", "target").select("id.*", "target")
    return lines.join(best, ["l_partkey", "l_suppkey"], "left")


@registered("SELECT p_name, CASE WHEN count(DISTINCT p_partkey) = 1 THEN min(p_partkey) END AS p_partkey FROM part GROUP BY 1")
def unique_candidate(spark: SparkSession, d: str) -> DataFrame:
    return match.unique_or_null(table(spark, d, "part"), "p_name", "p_partkey")


@registered("""WITH RECURSIVE c AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 10 = 0 THEN p_brand END AS value, CASE WHEN p_partkey % 10 <> 0 THEN CASE WHEN p_partkey % 97 = 1 THEN p_partkey ELSE p_partkey - 1 END END AS next FROM part),
  walk AS (SELECT id, value, next, 0 AS n FROM c UNION ALL SELECT w.id, c.value, c.next, n + 1 FROM walk w JOIN c ON c.id = w.next WHERE w.value IS NULL AND n < 10)
  SELECT c.id, max(w.value) AS value FROM c LEFT JOIN walk w ON w.id = c.id AND w.value IS NOT NULL GROUP BY 1""")
def constant_chain(spark: SparkSession, d: str) -> DataFrame:
    """Each tenth part holds a literal, others refer to the part before, some to themselves."""
    key = F.col("p_partkey")
    literal = key % 10 == 0
    constants = table(spark, d, "part").select(key.alias("id"), F.when(literal, F.col("p_brand")).alias("value"), F.when(~literal, F.when(key % 97 == 1, key).otherwise(key - 1)).alias("next"))
    return resolve_chain(constants)


@registered("SELECT user_id, min_by(event_id, ts) AS event_id, min(ts) AS ts FROM events GROUP BY 1")
def first_writer(spark: SparkSession, d: str) -> DataFrame:
    return first_wins(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", "ts")


@registered("SELECT user_id, max_by(event_id, ts) AS event_id, max(ts) AS ts FROM events GROUP BY 1")
def last_writer(spark: SparkSession, d: str) -> DataFrame:
    return last_wins(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", "ts")


@registered("SELECT max_by(c_name, c_acctbal) AS build_id FROM customer")
def latest_build(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").agg(F.max_by("c_name", "c_acctbal").alias("build_id"))


@registered(graph_sql("SELECT count(*) AS local_services, count(*) >= 1 AS passed FROM edge WHERE edge_type = 'EXPOSED_AS_LOCAL_SERVICE'"))
def scalar_gate(spark: SparkSession, d: str) -> DataFrame:
    n = integrity.gate(warehouse_graph(spark, d).links("EXPOSED_AS_LOCAL_SERVICE"), 1, "local services")
    return spark.range(1).select(F.lit(n).cast("long").alias("local_services"), F.lit(n >= 1).alias("passed"))


@registered(graph_sql("SELECT edge_type, from_node_id, to_node_id, sha256(edge_type || '|' || from_node_id || '|' || to_node_id || '|' || coalesce(source_path, '') || '|' || coalesce(CAST(nullif(line_start, 0) AS VARCHAR), '')) AS edge_id, sha256(edge_type || '|' || from_node_id || '|' || to_node_id || '|{}') AS content_hash FROM edge"))
def edge_ids(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return warehouse_graph(spark, d).edges.select("edge_type", "from_node_id", "to_node_id", edge_id(c("edge_type"), c("from_node_id"), c("to_node_id"), c("source_path"), c("line_start")).alias("edge_id"), edge_hash(c("edge_type"), c("from_node_id"), c("to_node_id"), F.lit("{}")).alias("content_hash"))


@registered(graph_sql("SELECT node_id, sha256(concat_ws('|', node_type, coalesce(qualified_name, ''), display_name, properties_json, coalesce(source_path, ''), coalesce(CAST(nullif(line_start, 0) AS VARCHAR), ''), '')) AS content_hash FROM node"))
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return warehouse_graph(spark, d).nodes.select("node_id", node_hash(c("node_type"), c("qualified_name"), c("display_name"), c("properties_json"), c("source_path"), c("line_start"), F.lit(None)).alias("content_hash"))


@registered("""SELECT CASE WHEN grouping(o_orderpriority) = 0 THEN 'api' WHEN grouping(o_orderstatus) = 0 THEN 'status' ELSE 'kind' END AS dimension, coalesce(o_orderpriority, o_orderstatus, CAST(k AS VARCHAR)) AS value, count(*) AS count
  FROM (SELECT o_orderpriority, o_orderstatus, o_orderkey % 2 AS k FROM orders) GROUP BY GROUPING SETS ((o_orderpriority), (o_orderstatus), (k))""")
def grouping_counters(spark: SparkSession, d: str) -> DataFrame:
    """Orders as registrations."""
    from factloom.plans.report import registration_counters

    kind = (F.col("o_orderkey") % 2).cast("string")
    orders = table(spark, d, "orders").select(F.col("o_orderpriority").alias("api"), F.col("o_orderstatus").alias("resolution_status"), kind.alias("service_kind"), F.lit(False).alias("is_test"))
    return registration_counters(orders).select(F.substring_index("counter", ":", 1).alias("dimension"), F.regexp_extract("counter", "(?s)^[^:]*:(.*)$", 1).alias("value"), "count")


@registered("SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS extends, count(*) FILTER (WHERE l_returnflag = 'A') AS implements, count(*) FILTER (WHERE l_returnflag NOT IN ('R', 'A')) AS unresolved FROM lineitem")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    """Returned lines as EXTENDS, accepted ones as IMPLEMENTS_JAVA_INTERFACE, others as unresolved."""
    from factloom.plans.report import inheritance_summary

    flag, lines = F.col("l_returnflag"), table(spark, d, "lineitem").select("l_returnflag")
    resolved = lines.where(flag.isin("R", "A")).select(F.when(flag == "R", "EXTENDS").otherwise("IMPLEMENTS_JAVA_INTERFACE").alias("edge_type"))
    return inheritance_summary(resolved, lines.where(~flag.isin("R", "A")))


@registered("SELECT l_orderkey AS interface, count(*) AS method_count, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS methods FROM lineitem GROUP BY 1")
def collected_methods(spark: SparkSession, d: str) -> DataFrame:
    listed = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).getField("l_partkey")
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("interface")).agg(F.count("*").alias("method_count"), F.array_join(listed.cast("array<string>"), ",").alias("methods"))


@registered("""SELECT coalesce(b.s_suppkey, c.c_custkey) AS path, coalesce(c.c_name, b.s_name) AS name, CASE WHEN c.c_custkey IS NOT NULL THEN 'config' ELSE 'manifest' END AS source
  FROM (SELECT s_suppkey, s_name FROM supplier) b FULL JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0) c ON b.s_suppkey = c.c_custkey""")
def config_merge(spark: SparkSession, d: str) -> DataFrame:
    from factloom.plans.planner import merge_repositories

    manifest = table(spark, d, "supplier").select(F.col("s_suppkey").alias("path"), F.col("s_name").alias("name"))
    config = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("path"), F.col("c_name").alias("name"))
    return merge_repositories([("manifest", manifest), ("config", config)])


@registered("""WITH need(p_type, capability) AS (SELECT DISTINCT p_type, unnest(['symbols', 'binder', 'build']) FROM part), have AS (SELECT DISTINCT p_type, 'symbols' AS capability FROM part WHERE p_size < 3 UNION SELECT min(p_type), 'binder' FROM part)
  SELECT p_brand AS repository, p.p_type AS language, n.capability, CASE WHEN h.p_type IS NULL THEN 'unsupported' ELSE 'scheduled' END AS status, count(*) AS files
  FROM part p JOIN need n ON n.p_type = p.p_type LEFT JOIN have h ON h.p_type = n.p_type AND h.capability = n.capability GROUP BY 1, 2, 3, 4""")
def capability_matrix(spark: SparkSession, d: str) -> DataFrame:
    from factloom.plans.planner import capability_tasks

    part = table(spark, d, "part")
    inventory = part.groupBy(F.col("p_brand").alias("repository"), F.col("p_type").alias("language")).agg(F.count("*").alias("files"))
    needs = part.select(F.col("p_type").alias("language")).distinct().select("language", F.explode(F.array(F.lit("symbols"), F.lit("binder"), F.lit("build"))).alias("capability"))
    have = part.where("p_size < 3").select(F.col("p_type").alias("language"), F.lit("symbols").alias("capability")).distinct().unionByName(part.agg(F.min("p_type").alias("language")).withColumn("capability", F.lit("binder")))
    return capability_tasks(inventory, needs, have.withColumn("parser", F.lit("p"))).select("repository", "language", "capability", "status", "files")


@registered("SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49)")
def scheduled_repos(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as repositories, their lines as tasks, large ones scheduled."""
    from factloom.plans.planner import repositories_for

    status = F.when(F.col("l_quantity") > 49, "scheduled").otherwise("unsupported")
    tasks = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("repository"), F.lit("java").alias("language"), F.lit("symbols").alias("capability"), status.alias("status"))
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_suppkey").cast("string").alias("name"), F.lit(True).alias("enabled"), F.lit("available").alias("status"))
    return repositories_for(suppliers, tasks, "java", "symbols").select("s_suppkey", "s_name")


@registered("""SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN b.p_partkey IS NULL THEN 'removed' ELSE 'modified' END AS change
  FROM (SELECT p_partkey, p_size FROM part WHERE p_size > 10) a FULL JOIN (SELECT p_partkey, p_size + CASE WHEN p_brand < 'Brand#3' THEN 1 ELSE 0 END AS p_size FROM part WHERE p_retailprice > 1000) b USING (p_partkey)
  WHERE a.p_partkey IS NULL OR b.p_partkey IS NULL OR a.p_size <> b.p_size""")
def map_diff(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    new = part.where("p_retailprice > 1000").withColumn("p_size", F.col("p_size") + F.when(F.col("p_brand") < "Brand#3", 1).otherwise(0))
    return integrity.map_diff(part.where("p_size > 10"), new, "p_partkey", "p_size")


@registered("SELECT 'C:' || c_custkey AS node_id, 'n/' || c_nationkey AS first_source, 'n/0' AS replacement_source FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey <> 0")
def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    c, path = F.col, lambda x: F.concat(F.lit("n/"), x.cast("string")).alias("source_path")
    rows = table(spark, d, "customer")
    ident = F.concat(F.lit("C:"), c("c_custkey").cast("string")).alias("node_id")
    return integrity.moved(rows.select(ident, path(c("c_nationkey"))), rows.select(ident, path(F.when(c("c_mktsegment") == "BUILDING", 0).otherwise(c("c_nationkey")))))


@registered("SELECT o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def baseline_anti(spark: SparkSession, d: str) -> DataFrame:
    return integrity.beyond_baseline(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@registered("SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal < 2000 UNION ALL SELECT NULL WHERE false")
def key_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).subtract(table(spark, d, "supplier").where("s_acctbal < 2000").select("s_nationkey"))


@registered("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal < 2000")
def key_intersection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").where("s_acctbal < 2000").select("s_nationkey"))


@registered(graph_sql("SELECT node_id, list_has_any(string_split(source_path, '/'), ['tests', 'out', '7']) AS excluded FROM node WHERE source_path IS NOT NULL"))
def path_exclude(spark: SparkSession, d: str) -> DataFrame:
    nodes = warehouse_graph(spark, d).nodes.where("source_path is not null")
    return nodes.select("node_id", tx.is_excluded(F.col("source_path"), ["tests", "out", "7"]).alias("excluded"))


@registered(graph_sql("SELECT node_id, list_has_any(string_split(lower(source_path), '/'), ['test', 'tests', 'testing', 'unittest', 'unittests', 'mock', 'mocks', 'benchmark', 'benchmarks']) AS is_test FROM node WHERE source_path IS NOT NULL"))
def test_path(spark: SparkSession, d: str) -> DataFrame:
    return warehouse_graph(spark, d).nodes.where("source_path is not null").select("node_id", tx.is_test_path(F.col("source_path")).alias("is_test"))


@registered(graph_sql("SELECT edge_type, from_node_id, to_node_id FROM edge WHERE source_path LIKE 'orders/1995%'"))
def prefix_filter(spark: SparkSession, d: str) -> DataFrame:
    return gq.with_prefix(warehouse_graph(spark, d), "orders/1995").select("edge_type", "from_node_id", "to_node_id")


@registered("""SELECT source AS repository, CASE WHEN lang = 'en' THEN 'java' WHEN lang = 'de' THEN 'cpp' WHEN lang = 'fr' THEN 'blueprint' END AS language, count(*) AS files FROM documents WHERE lang IN ('en', 'de', 'fr') GROUP BY 1, 2""")
def language_inventory(spark: SparkSession, d: str) -> DataFrame:
    from factloom.plans.planner import inventory

    name = F.when(F.col("lang") == "en", ".JAVA").when(F.col("lang") == "de", ".cc").when(F.col("lang") == "fr", "Android.bp").otherwise(".txt")
    base = F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.col("doc_id").cast("string"))
    files = table(spark, d, "documents").select(F.col("source").alias("repository"), F.concat(F.lit("src/"), base, name).alias("path"))
    return inventory(files)


@registered("""SELECT doc_id, CAST(i AS BIGINT) AS line, string_split(text, chr(10))[i] AS content FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)
  WHERE NOT (i = len(string_split(text, chr(10))) AND string_split(text, chr(10))[i] = '')""")
def line_scan(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(tx.lines(F.col("text"))).alias("at", "content")).select("doc_id", (F.col("at") + 1).cast("long").alias("line"), "content")


@registered("""SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages""")
def href_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1)).alias("href"))


@registered("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(100)


@registered("SELECT conv_id, turn, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS last_user_turn FROM conversations")
def last_declaration(spark: SparkSession, d: str) -> DataFrame:
    """The last user turn at or before each turn, as a declaration before its use."""
    turns = table(spark, d, "conversations")
    return match.asof(turns.select("conv_id", "turn"), turns.where("role = 'user'").select("conv_id", "turn", F.col("turn").alias("last_user_turn")), "conv_id", "turn", "last_user_turn")


@registered("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) < 10")
def json_property_filter(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, d, "events").select("event_id", k.alias("k")).where("k < 10")


# --- extraction, over sources made of the parts ------------------------------


def _sources(spark: SparkSession, d: str) -> DataFrame:
    """A Java file, an interface file and a manifest for each part."""
    key = F.col("p_partkey").cast("string")
    n = lambda m: (F.col("p_partkey") % m).cast("string")
    java = F.concat(
        F.lit("package com.p"), n(5), F.lit(";\n// class Ghost extends IGhost.Stub { }\nimport com.aidl.I"), n(7), F.lit(";\nclass S"), key, F.lit(" extends I"), n(7), F.lit('.Stub {\n  static final String NAME = "svc'), key,
        F.lit('";\n  @RequiresPermission("perm.'), n(3), F.lit('")\n  void go() {\n    ServiceManager.addService(NAME, this);\n    checkPermission("perm.'), n(4), F.lit('");\n    LocalServices.addService(S'), key, F.lit(".class, new S"), key, F.lit("());\n  }\n}\n"),
    )
    aidl = F.concat(F.lit("package com.aidl;\ninterface J"), key, F.lit(" { int a(int x); /* void no(); */ oneway void b(in List<String> y, "), n(4), F.lit("); const int C = 1; }\n").cast("string"))
    xml = F.concat(F.lit('<manifest xmlns:android="http://schemas.android.com/apk/res/android"><permission android:name="perm.'), key, F.lit('"/>'), F.when(F.col("p_partkey") % 10 == 0, "<broken>").otherwise("</manifest>"))
    shared = spark.range(7).select(F.concat(F.lit("aidl/I"), F.col("id").cast("string"), F.lit(".aidl")).alias("path"), F.concat(F.lit("package com.aidl; interface I"), F.col("id").cast("string"), F.lit(" { void run(); }")).alias("text"))
    part = table(spark, d, "part").select("p_partkey")
    files = part.select(F.explode(F.array(*[F.struct(F.concat(F.lit(f"{kind}/"), key, F.lit(f".{kind}")).alias("path"), text.alias("text")) for kind, text in (("java", java), ("aidl", aidl), ("xml", xml))])).alias("f")).select("f.*")
    return files.unionByName(shared)


def _tags(spark: SparkSession, d: str) -> DataFrame:
    """What a symbol listing says of the Java files; every class but each fifth extends the class before it."""
    key = F.col("p_partkey")
    name, path = F.concat(F.lit("S"), key.cast("string")), F.concat(F.lit("java/"), key.cast("string"), F.lit(".java"))
    parent = F.when(key % 5 != 0, F.concat(F.lit("com.p"), ((key - 1) % 5).cast("string"), F.lit(".S"), (key - 1).cast("string")))
    none = F.lit(None).cast("string")
    row = lambda kind, own, line, scope, scope_kind, inherits: F.struct(F.lit(kind).alias("kind"), own.alias("name"), F.lit(line).cast("long").alias("line"), scope.alias("scope"), F.lit(scope_kind).cast("string").alias("scopeKind"), inherits.alias("inherits"))
    rows = F.array(row("class", name, 4, none, None, parent), row("method", F.lit("go"), 7, name, "class", none), row("field", F.lit("NAME"), 5, name, "class", none))
    listed = table(spark, d, "part").select("p_partkey", path.alias("path"), F.posexplode(rows).alias("i", "t"))
    return listed.select("t.kind", "t.name", "path", "t.line", "t.scope", "t.scopeKind", F.when(F.col("t.kind") == "method", "()").alias("signature"), none.alias("access"), none.alias("pattern"), "t.inherits", (F.col("p_partkey") * 3 + F.col("i")).alias("seq"))


@registered("SELECT 'java/' || p_partkey || '.java' AS path, 'com.p' || (p_partkey % 5) AS package, 'S' || p_partkey AS class_name, 'I' || (p_partkey % 7) AS reference FROM part")
def binder_impls(spark: SparkSession, d: str) -> DataFrame:
    from factloom.sources.aidl import stub_subclasses

    return stub_subclasses(_sources(spark, d).where("path like 'java/%'")).drop("imports")


@registered("""SELECT 'aidl/' || p_partkey || '.aidl' AS path, m.name, m.return_type, m.signature FROM part, (SELECT unnest([1, 2]) AS i) t,
  LATERAL (SELECT CASE i WHEN 1 THEN 'a' ELSE 'b' END AS name, CASE i WHEN 1 THEN 'int' ELSE 'void' END AS return_type, CASE i WHEN 1 THEN '(int x)' ELSE '(in List<String> y, ' || (p_partkey % 4) || ')' END AS signature) m
  UNION ALL SELECT 'aidl/I' || i || '.aidl', 'run', 'void', '()' FROM (SELECT unnest(generate_series(0, 6)) AS i)""")
def aidl_methods(spark: SparkSession, d: str) -> DataFrame:
    from factloom.sources.aidl import parse_aidl

    parsed = parse_aidl(_sources(spark, d).where("path like 'aidl/%'"))
    return parsed.select("path", F.explode("methods").alias("m")).select("path", "m.name", "m.return_type", "m.signature")


@registered("""SELECT 'java/' || p_partkey || '.java' AS path, CASE i WHEN 1 THEN 'ServiceManager.addService' ELSE 'LocalServices.addService' END AS api, CASE i WHEN 1 THEN 8 ELSE 10 END AS line,
  CASE i WHEN 1 THEN 'svc' || p_partkey ELSE 'com.p' || (p_partkey % 5) || '.S' || p_partkey END AS resolved_key, 'com.p' || (p_partkey % 5) || '.S' || p_partkey AS instance FROM part, (SELECT unnest([1, 2]) AS i)""")
def service_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls with their keys, resolved through the files' constants, and the instances' types."""
    from factloom.operators.extract import resolve_strings
    from factloom.sources.java import parse_java

    parsed = parse_java(_sources(spark, d).where("path like 'java/%'")).persist()
    calls = parsed.select("path", F.explode("calls").alias("r")).select("path", "r.*", F.concat(F.lit("call:"), "path", F.lit(":"), F.col("r.offset").cast("string")).alias("id"))
    keys = resolve_strings(parsed).select("id", F.col("value").alias("resolved_key"))
    return calls.join(keys, "id", "left").select("path", "api", "line", "resolved_key", F.col("guess").alias("instance"))


@registered("SELECT 'xml/' || p_partkey || '.xml' AS path, CASE WHEN p_partkey % 10 <> 0 THEN 'perm.' || p_partkey END AS name, p_partkey % 10 = 0 AS failed FROM part")
def xml_declarations(spark: SparkSession, d: str) -> DataFrame:
    from factloom.sources.files import xml_permissions

    return xml_permissions(_sources(spark, d).where("path like 'xml/%'")).select("path", "name", F.col("error").isNotNull().alias("failed"))


@registered("""SELECT edge_type, CAST(count AS BIGINT) AS count FROM (SELECT count(*) AS n, count(*) FILTER (WHERE p_partkey % 5 <> 0) AS heirs, count(*) FILTER (WHERE p_partkey % 10 <> 0) AS sound FROM part),
  LATERAL (VALUES ('DECLARED_IN', 3 * n + 3 * n + 14 + 2 * n + sound), ('HAS_METHOD', n), ('HAS_MEMBER', n), ('EXTENDS', heirs), ('IMPLEMENTS_BINDER', n), ('AIDL_HAS_METHOD', 2 * n + 7), ('REGISTERS_BINDER_NAME', n), ('REGISTERS_LOCAL_KEY', n),
    ('REGISTERS_INSTANCE', 2 * n), ('REGISTERED_AS', n), ('EXPOSED_AS_LOCAL_SERVICE', n), ('REQUIRES_PERMISSION', n), ('ENFORCES_PERMISSION', n)) v(edge_type, count)""")
def full_graph_build(spark: SparkSession, d: str) -> DataFrame:
    """The whole build, from texts and listings to merged edges, counted by type."""
    from factloom.operators.extract import build_graph

    graph, _ = build_graph(spark, _tags(spark, d), _sources(spark, d))
    return graph.edges.groupBy("edge_type").agg(F.count("*").alias("count"))


#: Names of what the sources of part p declare.
BUILT = """p AS (SELECT p_partkey AS k, 'java/' || p_partkey || '.java' AS path, 'com.p' || (p_partkey % 5) || '.S' || p_partkey AS cls,
  'com.p' || ((p_partkey - 1) % 5) || '.S' || (p_partkey - 1) AS parent FROM part)"""


@registered(f"""WITH {BUILT} SELECT t.type || ':' || cls || tail AS node_id, t.type AS node_type, cls || tail AS qualified_name, coalesce(name, 'S' || k) AS display_name, path AS source_path, CAST(line AS BIGINT) AS line_start
  FROM p, (VALUES ('JAVA_CLASS', '', NULL, 4), ('JAVA_METHOD', '#go()', 'go', 7), ('JAVA_FIELD', '#NAME', 'NAME', 5)) t(type, tail, name, line)""")
def built_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Symbol nodes of the whole build, by content."""
    from factloom.operators.extract import build_graph

    graph, _ = build_graph(spark, _tags(spark, d), _sources(spark, d))
    return graph.of_type("JAVA_CLASS", "JAVA_METHOD", "JAVA_FIELD").select("node_id", "node_type", "qualified_name", "display_name", "source_path", "line_start")


@registered(f"""WITH {BUILT}, e AS (SELECT 'HAS_METHOD' AS edge_type, 'JAVA_CLASS:' || cls AS from_node_id, 'JAVA_METHOD:' || cls || '#go()' AS to_node_id, path AS source_path, 7 AS line_start FROM p
  UNION ALL SELECT 'HAS_MEMBER', 'JAVA_CLASS:' || cls, 'JAVA_FIELD:' || cls || '#NAME', path, 5 FROM p
  UNION ALL SELECT 'EXTENDS', 'JAVA_CLASS:' || cls, 'JAVA_CLASS:' || parent, path, 4 FROM p WHERE k % 5 <> 0
  UNION ALL SELECT 'IMPLEMENTS_BINDER', 'JAVA_CLASS:' || cls, 'AIDL_INTERFACE:com.aidl.I' || (k % 7), path, NULL FROM p
  UNION ALL SELECT 'REGISTERED_AS', 'JAVA_CLASS:' || cls, 'BINDER_SERVICE_NAME:svc' || k, path, 8 FROM p
  UNION ALL SELECT 'EXPOSED_AS_LOCAL_SERVICE', 'JAVA_CLASS:' || cls, 'LOCAL_SERVICE_KEY:' || cls, path, 10 FROM p
  UNION ALL SELECT 'REQUIRES_PERMISSION', 'JAVA_METHOD:' || cls || '#go()', 'PERMISSION:perm.' || (k % 3), path, 6 FROM p
  UNION ALL SELECT 'ENFORCES_PERMISSION', 'JAVA_METHOD:' || cls || '#go()', 'PERMISSION:perm.' || (k % 4), path, 9 FROM p)
  SELECT edge_type, from_node_id, to_node_id, source_path, CAST(line_start AS BIGINT) AS line_start, sha256(edge_type || '|' || from_node_id || '|' || to_node_id || '|' || source_path || '|' || coalesce(CAST(line_start AS VARCHAR), '')) AS edge_id FROM e""")
def built_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of the whole build, by content, but for those that say where a thing is declared."""
    from factloom.operators.extract import build_graph

    graph, _ = build_graph(spark, _tags(spark, d), _sources(spark, d))
    kinds = ("HAS_METHOD", "HAS_MEMBER", "EXTENDS", "IMPLEMENTS_BINDER", "REGISTERED_AS", "EXPOSED_AS_LOCAL_SERVICE", "REQUIRES_PERMISSION", "ENFORCES_PERMISSION")
    return graph.links(*kinds).select("edge_type", "from_node_id", "to_node_id", "source_path", "line_start", "edge_id")
