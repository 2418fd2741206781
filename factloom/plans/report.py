"""Stage reports and summaries."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.plans.planner import Plan
from factloom.plans.publish import write_json


def registration_counters(registrations: DataFrame) -> DataFrame:
    """(counter, count) by api, status and kind, and of test sources, in one pass."""
    rows = registrations.select(F.explode(F.array(
        F.concat(F.lit("api:"), "api"), F.concat(F.lit("status:"), "resolution_status"), F.concat(F.lit("kind:"), "service_kind"), F.when(F.col("is_test"), "test_sources"),
    )).alias("counter")).where("counter is not null")
    return rows.groupBy("counter").agg(F.count("*").alias("count"))


def binder_summary(interfaces: DataFrame, relations: DataFrame, unresolved: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: interfaces, methods, binder_relations, unresolved, failures."""
    one = interfaces.agg(F.count("*").alias("interfaces"), F.coalesce(F.sum("method_count"), F.lit(0)).alias("methods"))
    for name, df in (("binder_relations", relations), ("unresolved", unresolved), ("failures", failures)):
        one = one.crossJoin(df.agg(F.count("*").alias(name)))  # one row each
    return one


def inheritance_summary(resolved: DataFrame, unresolved: DataFrame) -> DataFrame:
    return resolved.agg(F.count_if(F.col("edge_type") == "EXTENDS").alias("extends"), F.count_if(F.col("edge_type") == "IMPLEMENTS_JAVA_INTERFACE").alias("implements")).crossJoin(unresolved.agg(F.count("*").alias("unresolved")))


def status_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("status").agg(F.count("*").alias("count"))


def write_plan(plan: Plan, folder: str | Path) -> None:
    """repositories, language-inventory, execution-plan and capability-report as JSON. A plan has a row per repository and capability."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    repositories = [{k: list(v) if isinstance(v, tuple) else v for k, v in vars(r).items()} for r in plan.repositories]
    tasks = [r.asDict() for r in plan.tasks.orderBy("path", "language", "capability").collect()]
    counts: dict[str, dict[str, int]] = {}
    for r in plan.inventory.orderBy("repository", "language").collect():
        counts.setdefault(r["repository"], {})[r["language"]] = r["files"]
    inventories = [{"repository": k, "counts": v} for k, v in counts.items()]
    write_json(folder / "repositories.json", repositories)
    write_json(folder / "language-inventory.json", inventories)
    write_json(folder / "capability-report.json", [{k: v for k, v in t.items() if k != "path"} for t in tasks])
    write_json(folder / "execution-plan.json", {"aosp_root": plan.root, "default_exclude": list(plan.default_exclude), "repositories": repositories, "inventories": inventories, "tasks": tasks})
