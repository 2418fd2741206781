"""Bounded transitive closure with a cycle guard."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def settle(df: DataFrame) -> DataFrame:
    """``df``, computed once into the checkpoint folder."""
    sc = df.sparkSession.sparkContext
    if not (sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().isDefined()):
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="factloom-checkpoint-"))
    return df.checkpoint()


def closure(edges: DataFrame, depth: int = 20, guard: str = "exact", distinct_pairs: bool = False, starts: DataFrame | None = None) -> DataFrame:
    """(class_id, ancestor_id, depth) along edges (from_node_id, to_node_id), every path up to ``depth`` steps.

    ``guard='exact'`` does not enter a node twice on one path. ``'substring'``
    also refuses a node whose id is part of the path's text, as a plain string
    test would. ``distinct_pairs`` keeps one row for each pair, of the smallest
    depth, and then stays small on graphs with many parallel paths. ``starts``, of
    one column of ids, keeps the walks that begin there; null: all.

    Each step is an equality join of the last step's rows; its result goes to
    the checkpoint folder, so plans stay short and a lost executor costs a step.
    """
    if guard not in ("exact", "substring"):
        raise ValueError("guard must be 'exact' or 'substring'")
    steps = edges.select(F.col("from_node_id").alias("_at"), F.col("to_node_id").alias("_next"))
    visited = F.array("from_node_id", "to_node_id") if guard == "exact" else F.concat_ws("|", "from_node_id", "to_node_id")
    first = edges if starts is None else edges.join(starts.toDF("_start"), F.col("from_node_id") == F.col("_start"), "left_semi")
    last = first.select(F.col("from_node_id").alias("class_id"), F.col("to_node_id").alias("ancestor_id"), F.lit(1).alias("depth"), visited.alias("_visited"))
    if distinct_pairs:
        last = last.drop("_visited").distinct()
    found = last = settle(last)
    for n in range(2, depth + 1):
        grown = last.join(steps, last["ancestor_id"] == steps["_at"])
        if distinct_pairs:
            last = grown.select("class_id", F.col("_next").alias("ancestor_id"), F.lit(n).alias("depth")).distinct().join(found, ["class_id", "ancestor_id"], "left_anti").where("class_id != ancestor_id")
        elif guard == "exact":
            last = grown.where(~F.array_contains("_visited", F.col("_next"))).select("class_id", F.col("_next").alias("ancestor_id"), F.lit(n).alias("depth"), F.array_append("_visited", F.col("_next")).alias("_visited"))
        else:
            last = grown.where(F.instr("_visited", F.col("_next")) == 0).select("class_id", F.col("_next").alias("ancestor_id"), F.lit(n).alias("depth"), F.concat_ws("|", "_visited", "_next").alias("_visited"))
        last = settle(last)
        if last.isEmpty():
            break
        found = found.unionByName(last)
    return found.select("class_id", "ancestor_id", "depth")


def closure_sql(spark: SparkSession, edges: DataFrame, depth: int = 20) -> DataFrame:
    """The same closure (exact guard) as one recursive query; LIMIT ALL lifts the limit of a million rows that Spark sets by itself."""
    return spark.sql(
        """
        WITH RECURSIVE walk(class_id, ancestor_id, depth, visited) AS (
          SELECT from_node_id, to_node_id, 1, array(from_node_id, to_node_id) FROM {edges}
          UNION ALL
          SELECT w.class_id, e.to_node_id, w.depth + 1, array_append(w.visited, e.to_node_id)
          FROM walk w JOIN {edges} e ON e.from_node_id = w.ancestor_id
          WHERE w.depth < {depth} AND NOT array_contains(w.visited, e.to_node_id))
        SELECT class_id, ancestor_id, depth FROM walk LIMIT ALL""",
        edges=edges, depth=depth,
    )


def resolve_chain(constants: DataFrame, depth: int = 10) -> DataFrame:
    """(id, value): follow ``next`` from constant to constant until a literal ``value``.

    ``constants``: (id, value, next), one of value and next null. References that
    run in a cycle, beyond ``depth`` steps, or to nothing give null.
    """
    nodes = constants.select("id", "value", "next")
    at = nodes.select(F.col("id").alias("start"), "value", "next", F.array("id").alias("_seen"))
    for _ in range(depth):
        open_ = at.where("value is null and next is not null and not array_contains(_seen, next)")
        if open_.isEmpty():
            break
        step = open_.select("start", F.col("next").alias("id"), "_seen").join(nodes, "id", "left").select("start", "value", "next", F.array_append("_seen", F.col("id")).alias("_seen"))
        at = settle(at.where("value is not null").unionByName(step))
    known = at.where("value is not null").select(F.col("start").alias("id"), "value")
    return nodes.select("id").join(known, "id", "left")
