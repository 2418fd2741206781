"""Builds as immutable folders, published by replacing one pointer file.

``builds/<id>/`` holds nodes, edges, reports and the build manifest; ``CURRENT``
names the published build. Readers open what CURRENT names, so a build under way
or a failed one is never seen, and nothing has to be rolled back: replacing the
pointer is the commit. ``PENDING`` marks a publication that has begun.
"""

from __future__ import annotations

import fcntl
import json
import os
import re
import secrets
import shutil
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.ids import canonical_json
from factloom.graph import Graph, merge_nodes
from factloom.operators.extract import union
from factloom.operators.integrity import duplicate_keys, foreign_keys, gate


class PublicationError(RuntimeError):
    """A build may not be published as it is."""


@dataclass(frozen=True)
class Build:
    root: Path
    build_id: str

    @property
    def folder(self) -> Path:
        return self.root / "builds" / self.build_id

    @property
    def manifest(self) -> Path:
        return self.folder / "build-manifest.json"


def write_json(path: Path, value: object) -> None:
    """Whole or not at all: written beside and moved into place; keys sorted."""
    beside = path.with_name(f".{path.name}.{os.getpid()}-{secrets.token_hex(4)}")
    try:
        with open(beside, "x", encoding="utf-8") as f:
            json.dump(value, f, ensure_ascii=False, indent=2, sort_keys=True)
            f.write("\n")
            f.flush()
            os.fsync(f.fileno())
        os.replace(beside, path)
    finally:
        beside.unlink(missing_ok=True)


def new_build_id() -> str:
    return f"{time.strftime('%Y%m%dT%H%M%SZ', time.gmtime())}-{os.getpid()}-{secrets.token_hex(4)}"


@contextmanager
def locked(root: str | Path) -> Iterator[None]:
    """One writer at a time; a second one fails at once."""
    Path(root).mkdir(parents=True, exist_ok=True)
    with open(Path(root) / ".lock", "w") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError as e:
            raise PublicationError(f"another build works in {root}") from e
        yield


def begin(root: str | Path, build_id: str | None = None) -> Build:
    """A new, empty build folder; unsafe ids and ids that exist are refused."""
    ident = build_id or new_build_id()
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", ident) or ".." in ident:
        raise ValueError(f"unsafe build id {ident!r}")
    build = Build(Path(root).resolve(), ident)
    build.folder.mkdir(parents=True)
    (build.folder / "reports").mkdir()
    return build


def build_node(spark: SparkSession, build: Build, source_config: str, started_at: str, verified_at: str) -> DataFrame:
    """The GRAPH_BUILD node."""
    row = spark.createDataFrame([(build.build_id, source_config, started_at, verified_at)], "id string, source_config string, started_at string, verified_at string")
    c = F.col
    return merge_nodes(row.select(
        F.concat(F.lit("GRAPH_BUILD:"), "id").alias("node_id"), F.lit("GRAPH_BUILD").alias("node_type"), c("id").alias("qualified_name"), c("id").alias("display_name"),
        canonical_json(source_config=c("source_config"), started_at=c("started_at"), verified_at=c("verified_at")).alias("properties_json"),
        F.lit(None).cast("string").alias("source_path"), F.lit(None).cast("long").alias("line_start"), F.lit(None).cast("long").alias("line_end"), F.lit("build_publish").alias("extractor"), F.lit(0).cast("long").alias("ingest_seq"),
    ))


def stage(spark: SparkSession, build: Build, graph: Graph, reports: dict[str, DataFrame], source_config: str, started_at: str, least_local_services: int = 1) -> None:
    """Write the graph and reports into the build folder, check what was written, and sign it with a manifest."""
    verified_at = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    whole = Graph(union(graph.nodes, build_node(spark, build, source_config, started_at, verified_at)), graph.edges)
    whole.write(str(build.folder))
    for name, df in reports.items():
        df.write.json(f"{build.folder}/reports/{name}")
    written = Graph.read(spark, str(build.folder))
    broken = foreign_keys(written).limit(5).collect()
    if broken:
        raise PublicationError(f"edges without nodes, such as {[tuple(r) for r in broken]}")
    if not (duplicate_keys(written.nodes, "node_id").isEmpty() and duplicate_keys(written.edges, "edge_id").isEmpty()):
        raise PublicationError("ids are not unique")
    gate(written.links("EXPOSED_AS_LOCAL_SERVICE"), least_local_services, "local services")
    write_json(build.manifest, {"build_id": build.build_id, "source_config": source_config, "started_at": started_at, "status": "verified", "verified_at": verified_at})


def recorded_id(spark: SparkSession, folder: Path) -> str | None:
    """The id of the latest GRAPH_BUILD node in a build's data."""
    if not (folder / "nodes").is_dir():
        return None
    return Graph.read(spark, str(folder)).of_type("GRAPH_BUILD").agg(F.max_by("qualified_name", "updated_at")).first()[0]


def publish(spark: SparkSession, build: Build) -> None:
    """Make the build current. Data, manifest and folder must agree on its id."""
    signed = json.loads(build.manifest.read_text()) if build.manifest.is_file() else {}
    ids = {build.build_id, signed.get("build_id"), recorded_id(spark, build.folder)}
    if ids != {build.build_id} or signed.get("status") != "verified":
        raise PublicationError(f"build {build.build_id} is not verified: {sorted(map(str, ids))}")
    pending = build.root / "PENDING"
    if pending.exists():
        raise PublicationError("a publication was broken off: recover first")
    write_json(pending, {"build_id": build.build_id})
    write_json(build.root / "CURRENT", {"build_id": build.build_id})  # the commit
    pending.unlink()


def current(root: str | Path) -> Build | None:
    pointer = Path(root).resolve() / "CURRENT"
    return Build(Path(root).resolve(), json.loads(pointer.read_text())["build_id"]) if pointer.is_file() else None


def recover(root: str | Path) -> str:
    """After a crash: ``no_journal``, ``committed`` (the pending build is current), or ``rolled_back`` (the old one stays)."""
    pending = Path(root).resolve() / "PENDING"
    if not pending.is_file():
        return "no_journal"
    try:
        ident = json.loads(pending.read_text())["build_id"]
    except (ValueError, KeyError, TypeError) as e:
        raise PublicationError(f"unreadable {pending}") from e
    now = current(root)
    pending.unlink()
    return "committed" if now and now.build_id == ident else "rolled_back"


def discard(build: Build, keep: bool = False) -> Path | None:
    """Remove a failed build, or keep it for a look; the current one is never removed."""
    now = current(build.root)
    if keep or (now and now.build_id == build.build_id):
        return build.folder if build.folder.exists() else None
    shutil.rmtree(build.folder, ignore_errors=True)
    return None
