"""Chains from services to their implementations: results on odd graphs, and rows that the steps make."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import functions as F

from factloom import catalog
from factloom.graph import Graph
from factloom.operators import graph_queries as gq

NODE = "node_id string, node_type string, qualified_name string, source_path string, line_start long"
EDGE = "edge_type string, from_node_id string, to_node_id string"


def crowd(spark, n, link, key_edge):
    """One key that n registrations have, each with an instance of its own."""
    nodes = [("k", "KEY", "key", None, None)] + [x for i in range(n) for x in ((f"r{i}", "SERVICE_REGISTRATION", f"r{i}", "p", i), (f"c{i}", "JAVA_CLASS", f"c{i}", None, None))]
    edges = [x for i in range(n) for x in ((link, f"c{i}", "k"), (key_edge, f"r{i}", "k"), ("REGISTERS_INSTANCE", f"r{i}", f"c{i}"))]
    return nodes, edges


def graph(spark, nodes, edges):
    return Graph(spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges, EDGE))


def most_rows(df):
    """The most rows that a step of the executed plan gave."""

    def walk(plan):
        rows, kind = plan.metrics().get("numOutputRows"), plan.getClass().getSimpleName()
        inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else []
        children = plan.children()
        return max([rows.get().value() if rows.isDefined() else 0, *map(walk, inner), *(walk(children.apply(i)) for i in range(children.size()))])

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_service_of_many_registrations_multiplies_no_rows(spark):
    nodes, edges = crowd(spark, 200, "REGISTERED_AS", "REGISTERS_BINDER_NAME")
    g = graph(spark, nodes, edges)
    chain = gq.service_chain(g)
    assert most_rows(chain) <= 1000 and {tuple(r) for r in chain.collect()} == {("key", f"c{i}", None, "p", i) for i in range(200)}


def test_local_service_exposed_twice_gives_two_rows_a_registration(spark):
    nodes, edges = crowd(spark, 2, "EXPOSED_AS_LOCAL_SERVICE", "REGISTERS_LOCAL_KEY")
    g = graph(spark, nodes, edges + [("EXPOSED_AS_LOCAL_SERVICE", "c0", "k"), ("EXPOSED_AS_LOCAL_SERVICE", "r0", "k")])
    assert [tuple(r) for r in gq.local_services(g, None).collect()] == [("key", "c0", "p", 0)] * 2 + [("key", "c1", "p", 1), ("key", "r0", None, None)]


def test_local_service_key_of_many_registrations_multiplies_no_rows(spark):
    g = graph(spark, *crowd(spark, 200, "EXPOSED_AS_LOCAL_SERVICE", "REGISTERS_LOCAL_KEY"))
    assert most_rows(gq.local_services(g, None)) <= 1000


def test_inherited_chain_walks_from_the_service_alone(spark, monkeypatch):
    nodes, edges = crowd(spark, 3, "REGISTERED_AS", "REGISTERS_BINDER_NAME")
    edges += [("EXTENDS", "c0", "c1"), ("EXTENDS", "c1", "c2"), ("EXTENDS", "c2", "x"), ("EXTENDS", "y", "x"), ("IMPLEMENTS_BINDER", "x", "a"), ("REGISTERED_AS", "y", "other"), ("REGISTERS_BINDER_NAME", "ry", "other"), ("REGISTERS_INSTANCE", "ry", "y")]
    nodes += [("x", "JAVA_CLASS", "x", None, None), ("y", "JAVA_CLASS", "y", None, None), ("a", "AIDL_INTERFACE", "a", None, None), ("other", "KEY", "other", None, None), ("ry", "SERVICE_REGISTRATION", "ry", "q", 9)]
    g, walks = graph(spark, nodes, edges), []
    monkeypatch.setattr(gq, "closure", lambda *a, f=gq.closure, **b: walks.append(f(*a, **b)) or walks[-1])
    want = [("key", f"c{i}", "x", "a", 3 - i, "p", i) for i in (2, 1, 0)]
    assert [tuple(r) for r in gq.inherited_service_chain(g, "key").collect()] == want
    assert {r["class_id"] for r in walks[-1].collect()} == {"c0", "c1", "c2"}
    assert [tuple(r) for r in gq.inherited_service_chain(g).collect()] == sorted([*want, ("other", "y", "x", "a", 1, "q", 9)], key=lambda r: (r[4], r[1]))


def test_inherited_chain_query_walks_from_every_service(spark):
    d = "/root/testdata/sf0.001"
    got = [tuple(r) for r in catalog.QUERIES["inherited_service_chain"](spark, d).collect()]
    first = spark.read.parquet(f"{d}/lineitem.parquet").where("l_orderkey % 2 = 1").groupBy("l_orderkey").agg(F.min("l_partkey").alias("p_partkey"))
    kinds = {r[0] for r in first.join(spark.read.parquet(f"{d}/part.parquet"), "p_partkey").select("p_type").distinct().collect()}
    assert len(kinds) > 1 and {r[0] for r in got} == kinds
    with duckdb.connect() as db:
        for p in Path(d).glob("*.parquet"):
            db.execute(f"CREATE VIEW {p.stem} AS FROM '{p}'")
        want = db.execute(catalog.ORACLES["inherited_service_chain"]).fetchall()
    assert got == sorted(want, key=lambda r: (r[4], r[1], r[5], r[6], r[0], r[2], r[3]))
