"""The property graph: two DataFrames, merged by key and checked."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.ids import edge_hash, edge_id, node_hash
from factloom.schema import EXTRACTOR_VERSION


def last_wins(df: DataFrame, key: str | list[str], order: Column | str) -> DataFrame:
    """For each key the row of the largest ``order``: an aggregate that combines map-side, no window."""
    keys = [key] if isinstance(key, str) else key
    order = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def first_wins(df: DataFrame, key: str | list[str], order: Column | str) -> DataFrame:
    """For each key the row of the smallest ``order``."""
    keys = [key] if isinstance(key, str) else key
    order = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def _provenance(df: DataFrame, content_hash: Column, revision: str) -> DataFrame:
    return df.withColumns({
        "properties_json": F.coalesce("properties_json", F.lit("{}")), "source_revision": F.lit(revision), "extractor_version": F.lit(EXTRACTOR_VERSION),
        "content_hash": content_hash, "status": F.lit("active"), "updated_at": F.current_timestamp(),
    })


def merge_nodes(facts: DataFrame, revision: str = "unknown") -> DataFrame:
    """Node facts (schema.NODE_FACT) -> nodes: the last writer by ``ingest_seq`` sets every column of a node_id."""
    kept = last_wins(facts, "node_id", F.struct("ingest_seq", F.coalesce("source_path", F.lit("")), F.coalesce("line_start", F.lit(0)), "properties_json")).drop("ingest_seq")
    hash_ = node_hash(F.col("node_type"), F.col("qualified_name"), F.col("display_name"), F.coalesce("properties_json", F.lit("{}")), F.col("source_path"), F.col("line_start"), F.col("line_end"))
    return _provenance(kept, hash_, revision).select("node_id", "node_type", "qualified_name", "display_name", "properties_json", "source_path", "line_start", "line_end", "source_revision", "extractor", "extractor_version", "content_hash", "status", "updated_at")


def merge_edges(facts: DataFrame, revision: str = "unknown") -> DataFrame:
    """Edge facts (schema.EDGE_FACT) -> edges, one for each edge_id, of the last writer."""
    keyed = facts.withColumn("edge_id", edge_id(F.col("edge_type"), F.col("from_node_id"), F.col("to_node_id"), F.col("source_path"), F.col("line_start")))
    kept = last_wins(keyed, "edge_id", F.struct("ingest_seq", "properties_json")).drop("ingest_seq")
    hash_ = edge_hash(F.col("edge_type"), F.col("from_node_id"), F.col("to_node_id"), F.coalesce("properties_json", F.lit("{}")))
    return _provenance(kept, hash_, revision).select("edge_id", "edge_type", "from_node_id", "to_node_id", "properties_json", "source_path", "line_start", "line_end", "source_revision", "extractor", "extractor_version", "content_hash", "status", "updated_at")


@dataclass(frozen=True)
class Graph:
    """Nodes and edges; operators take what columns they need and return DataFrames."""

    nodes: DataFrame
    edges: DataFrame

    def of_type(self, *types: str) -> DataFrame:
        return self.nodes.where(F.col("node_type").isin(*types))

    def links(self, *types: str) -> DataFrame:
        return self.edges.where(F.col("edge_type").isin(*types))

    def write(self, folder: str) -> None:
        """Parquet, partitioned by type so that queries on a type read that type alone."""
        self.nodes.write.partitionBy("node_type").parquet(f"{folder}/nodes")
        self.edges.write.partitionBy("edge_type").parquet(f"{folder}/edges")

    @staticmethod
    def read(spark, folder: str) -> Graph:
        return Graph(spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/edges"))
