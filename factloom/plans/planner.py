"""Workspace plans: which repositories hold what, and which parser serves it."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import text as tx
from factloom.sources.config import Config, Registry, Repository
from factloom.sources.manifest import read_manifest

# What each language needs; other languages need symbols.
CAPABILITIES = {
    "java": ("symbols", "inheritance", "service_registration", "permission_enforcement"),
    "aidl": ("symbols", "binder"),
    "kotlin": ("symbols", "inheritance", "service_registration", "permission_enforcement"),
    "c": ("symbols", "native_binder"),
    "cpp": ("symbols", "native_binder"),
    "rust": ("symbols", "native_binder"),
    "hidl": ("symbols", "binder"),
    "python": ("symbols",),
    "blueprint": ("build",),
    "make": ("build",),
    "proto": ("symbols",),
}

TASK = "repository string, path string, language string, capability string, parser string, status string, files long"


class CoverageError(RuntimeError):
    """A strict plan has gaps."""


@dataclass(frozen=True)
class Plan:
    root: str
    repositories: tuple[Repository, ...]
    tasks: DataFrame
    inventory: DataFrame
    default_exclude: tuple[str, ...] = field(default=())


def merge_repositories(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """(path, name, source) of all sources; where several have a path, the later source wins."""
    out = None
    for rank, (source, df) in enumerate(sources):
        rows = df.select("path", "name", F.lit(source).alias("source"), F.lit(rank).alias("_rank"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("path").agg(F.max_by(F.struct("name", "source"), "_rank").alias("r")).select("path", "r.name", "r.source")


def inventory(files: DataFrame, *more: str) -> DataFrame:
    """(repository, language, files) of (repository, path) rows, with ``more`` keys if given; files of no known language don't count."""
    found = files.select("repository", *more, tx.language(F.col("path")).alias("language")).where("language is not null")
    return found.groupBy("repository", *more, "language").agg(F.count("*").alias("files"))


def selected(rule: Repository, default_exclude: tuple[str, ...]) -> Column:
    """Whether a repository's settings take the file of a ``path`` below it."""
    path = F.col("path")
    inside = reduce(lambda a, b: a | b, [tx.under(path, F.lit(folder)) for folder in rule.include], F.lit(not rule.include))
    known = tx.language(path).isin(*rule.languages) if rule.languages else F.lit(True)
    return inside & known & ~tx.is_excluded(path, [*default_exclude, *rule.exclude])


def capability_tasks(counted: DataFrame, needs: DataFrame, parsers: DataFrame) -> DataFrame:
    """Every need of every language found, scheduled if a parser serves it. needs: (language, capability); parsers: (language, capability, parser)."""
    wanted = counted.join(F.broadcast(needs), "language", "left").withColumn("capability", F.coalesce("capability", F.lit("symbols")))
    return wanted.join(F.broadcast(parsers), ["language", "capability"], "left").withColumn("status", F.when(F.col("parser").isNotNull(), "scheduled").otherwise("unsupported"))


def merged(config: Config, discovered: tuple[Repository, ...]) -> tuple[Repository, ...]:
    """Discovered repositories, then what the configuration sets for a path, then extra ones; in order of path."""
    found = {r.path: replace(r, enabled=config.auto_enable) for r in discovered}
    for r in config.repositories:
        name = r.name or (found[r.path].name if r.path in found else r.path)
        found[r.path] = replace(r, name=name, source="config")
    for r in config.extra:
        found[r.path] = replace(r, source="extra")
    return tuple(found[p] for p in sorted(found))


def build_plan(spark: SparkSession, config: Config, registry: Registry, files: DataFrame, strict: bool = False, strict_capability: str | None = None, available: set[str] | None = None) -> Plan:
    """Plan over ``files`` (path below the root). ``available``: repository paths that exist; all with files if not given.

    Strict plans raise ``CoverageError`` on a gap: an enabled repository that is
    missing, or a task without a parser; ``strict_capability`` counts only the
    tasks of that capability, and missing repositories.
    """
    manifest = Path(config.root) / ".repo/manifest.xml"
    discovered = read_manifest(manifest) if config.discover and manifest.is_file() else ()
    repositories = merged(config, discovered)
    roots = spark.createDataFrame([(r.path, r.name) for r in repositories] or [("", "")], "prefix string, repository string").where("prefix != ''")
    from factloom.operators.match import longest_prefix

    located = longest_prefix(files.select("path"), roots.select("prefix", "repository", F.col("prefix").alias("root")), "path", "prefix", "repository", "root").where("repository is not null").persist()
    seen = available if available is not None else {r[0] for r in located.select("root").distinct().collect()}
    repositories = tuple(replace(r, status="available" if r.path in seen else "missing") for r in repositories)
    # One pass over the files for all repositories: those with the same settings share a rule, and most have none of their own.
    active = [r for r in repositories if r.enabled and r.status == "available"]
    rules = {(r.include, r.exclude, r.languages): r for r in active}
    ruled = spark.createDataFrame([(r.path, list(rules).index((r.include, r.exclude, r.languages))) for r in active], "root string, rule int")
    rows = located.join(ruled, "root").select("repository", "root", "rule", F.expr("substring(path, length(root) + 2)").alias("path"))
    taken = reduce(lambda a, b: a | b, [(F.col("rule") == i) & selected(r, config.default_exclude) for i, r in enumerate(rules.values())], F.lit(False))
    chosen = inventory(rows.where(taken), "root").select("repository", "language", "files", F.col("root").alias("path"))
    needs = spark.createDataFrame([(lang, c) for lang, cs in CAPABILITIES.items() for c in cs], "language string, capability string")
    parsers = spark.createDataFrame(registry.rows() or [("", "", "")], "language string, capability string, parser string")
    tasks = capability_tasks(chosen, needs, parsers).select("repository", "path", "language", "capability", "parser", "status", "files")
    missing = [(r.name, r.path, "repository", "availability", None, "missing_repository", 0) for r in repositories if r.enabled and r.status == "missing"]
    if strict or config.strict or strict_capability is not None:
        short = tasks.where("status != 'scheduled'")
        short = short.where(F.col("capability") == strict_capability) if strict_capability is not None else short
        gaps = [*missing, *map(tuple, short.orderBy("repository", "language", "capability").limit(8).collect())]
        if gaps:
            raise CoverageError("coverage gaps: " + ", ".join(f"{g[0]}:{g[2]}:{g[3]}:{g[5]}" for g in gaps[:8]))
    return Plan(config.root, repositories, tasks.unionByName(spark.createDataFrame(missing, TASK)), chosen, config.default_exclude)


def repositories_for(repositories: DataFrame, tasks: DataFrame, language: str, capability: str) -> DataFrame:
    """Enabled, available repositories with a scheduled task of the kind, by name."""
    served = tasks.where((F.col("language") == language) & (F.col("capability") == capability) & (F.col("status") == "scheduled")).select(F.col("repository").alias("name"))
    return repositories.where("enabled and status = 'available'").join(served, "name", "left_semi")
