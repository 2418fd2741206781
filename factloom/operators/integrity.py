"""Checks of a graph, and differences between graphs and other keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.graph import Graph


def foreign_keys(graph: Graph) -> DataFrame:
    """Edge ends that no node has: edge_type, side, node_id. Empty in a sound graph."""
    nodes = graph.nodes.select("node_id")
    sides = [graph.edges.select("edge_type", F.lit(side).alias("side"), F.col(column).alias("node_id")).join(nodes, "node_id", "left_anti") for side, column in (("from", "from_node_id"), ("to", "to_node_id"))]
    return sides[0].unionByName(sides[1]).select("edge_type", "side", "node_id")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that are null or held by several rows."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).where(F.col(key).isNull() | (F.col("rows") > 1))


def existing(df: DataFrame, column: str, nodes: DataFrame) -> DataFrame:
    """Rows whose column names a node."""
    return df.join(nodes.select(F.col("node_id").alias(column)), column, "left_semi")


def unresolved(relations: DataFrame, nodes: DataFrame, source: str, target: str) -> DataFrame:
    """Relations with a missing end, with the reason; a row with both ends missing counts by its source."""
    known = nodes.select("node_id")
    no_source = relations.join(known, F.col(source) == F.col("node_id"), "left_anti").withColumn("reason", F.lit(f"{source}_missing"))
    rest = relations.join(known, F.col(source) == F.col("node_id"), "left_semi")
    return no_source.unionByName(rest.join(known, F.col(target) == F.col("node_id"), "left_anti").withColumn("reason", F.lit(f"{target}_missing")))


def map_diff(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """(key, change) for keys added, removed or modified between two keyed tables."""
    joined = expected.select(key, F.col(value).alias("_old"), F.lit(True).alias("_was")).join(actual.select(key, F.col(value).alias("_new"), F.lit(True).alias("_is")), key, "full_outer")
    change = F.when(F.col("_was").isNull(), "added").when(F.col("_is").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "modified")
    return joined.select(key, change.alias("change")).where("change is not null")


def moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """Nodes of both snapshots with another source path than before: the same name declared twice."""
    old = before.where("source_path != ''").select("node_id", F.col("source_path").alias("first_source"))
    new = after.where("source_path != ''").select("node_id", F.col("source_path").alias("replacement_source"))
    return old.join(new, "node_id").where("first_source != replacement_source")


def beyond_baseline(df: DataFrame, baseline: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key the baseline doesn't have."""
    return df.join(baseline, key, "left_anti")


def gate(df: DataFrame, least: int, what: str) -> int:
    """The number of rows; fewer than ``least`` stop the build."""
    n = df.count()
    if n < least:
        raise ValueError(f"{what}: {n} rows, {least} needed")
    return n
