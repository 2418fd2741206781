"""Configuration, manifests, plans, payloads and publication."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from factloom.graph import Graph, merge_edges, merge_nodes
from factloom.plans import payload, publish, report
from factloom.plans.planner import CoverageError, build_plan, repositories_for
from factloom.schema import EDGE_FACT, NODE_FACT
from factloom.sources.config import read_config, read_registry
from factloom.sources.manifest import ManifestError, read_manifest

CONFIG = """
[workspace]
aosp_root = "{root}"
[defaults]
exclude = ["out_*", "tests"]
[repositories."frameworks/base"]
enabled = true
include = ["src"]
[repositories."gone"]
enabled = true
[[extra_repositories]]
name = "vendor"
path = "vendor/demo"
languages = ["java"]
"""


@pytest.fixture
def config(tmp_path):
    path = tmp_path / "roots.toml"
    path.write_text(CONFIG.format(root=tmp_path))
    return read_config(path)


def test_config(config, tmp_path):
    assert [r.path for r in config.repositories] == ["frameworks/base", "gone"] and config.extra[0].enabled and config.extra[0].name == "vendor"
    bad = tmp_path / "bad.toml"
    bad.write_text('[workspace]\naosp_root = "x"\n[repositories.a]\nlanguages = ["cobol"]\n')
    with pytest.raises(ValueError, match="cobol"):
        read_config(bad)
    bad.write_text("[workspace]\n")
    with pytest.raises(ValueError):
        read_config(bad)


def test_registry(tmp_path):
    path = tmp_path / "registry.toml"
    path.write_text('[parsers.java]\nimplementation = "j"\nenabled = true\ncapabilities = ["symbols"]\n[parsers.c]\nenabled = false\ncapabilities = ["symbols"]\n')
    registry = read_registry(path)
    assert registry.parser_for("java", "symbols").implementation == "j" and registry.parser_for("java", "inheritance") is None and registry.parser_for("c", "symbols") is None
    assert registry.parser_for("aidl", "binder") is not None


def test_manifest(tmp_path):
    store = tmp_path / ".repo" / "manifests"
    store.mkdir(parents=True)
    (tmp_path / ".repo" / "manifest.xml").write_text('<manifest><project name="b" path="p/b"/><include name="more.xml"/><project name="a"/></manifest>')
    (store / "more.xml").write_text('<manifest><project name="later" path="p/b"/><project name="c"/><project/></manifest>')
    assert [(r.path, r.name) for r in read_manifest(tmp_path / ".repo" / "manifest.xml")] == [("a", "a"), ("c", "c"), ("p/b", "b")]
    (store / "more.xml").write_text('<manifest><include name="more.xml"/></manifest>')
    with pytest.raises(ManifestError, match="cycle"):
        read_manifest(tmp_path / ".repo" / "manifest.xml")


def test_plan(spark, config):
    paths = ["frameworks/base/src/A.java", "frameworks/base/src/tests/T.java", "frameworks/base/src/out_x/B.java", "frameworks/base/other/C.java", "frameworks/base/src/C.rs", "vendor/demo/V.java", "vendor/demo/V.kt", "vendor/demonic/W.java"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    plan = build_plan(spark, config, read_registry(), files)
    rows = {(r["repository"], r["language"], r["capability"], r["status"], r["files"]) for r in plan.tasks.collect()}
    assert ("frameworks/base", "java", "symbols", "scheduled", 1) in rows and ("frameworks/base", "rust", "native_binder", "unsupported", 1) in rows
    assert ("vendor", "java", "permission_enforcement", "scheduled", 1) in rows and not [r for r in rows if r[0] == "vendor" and r[1] == "kotlin"]
    assert ("gone", "repository", "availability", "missing_repository", 0) in rows
    with pytest.raises(CoverageError):
        build_plan(spark, config, read_registry(), files, strict=True)
    repositories = spark.createDataFrame([("vendor", True, "available"), ("gone", True, "missing")], "name string, enabled boolean, status string")
    assert [r["name"] for r in repositories_for(repositories, plan.tasks, "java", "symbols").collect()] == ["vendor"]


def test_written_plan(spark, config, tmp_path):
    plan = build_plan(spark, config, read_registry(), spark.createDataFrame([("vendor/demo/V.java",)], "path string"))
    report.write_plan(plan, tmp_path / "plan")
    assert json.loads((tmp_path / "plan/language-inventory.json").read_text()) == [{"counts": {"java": 1}, "repository": "vendor"}]
    assert len(json.loads((tmp_path / "plan/execution-plan.json").read_text())["repositories"]) == 3


def test_payload(spark, tmp_path):
    for name, text in {"a.py": "1", "b/c.txt": "2", "data/x.py": "3", "d.pyc": "4"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    now = {r["path"]: r["digest"] for r in payload.digests(spark, str(tmp_path)).collect()}
    assert set(now) == {"a.py", "b/c.txt"}
    old = {"schema_version": 1, "source_commit": "x", "files": {"a.py": "0" * 64, "gone": "1" * 64}}
    assert {tuple(r) for r in payload.drift(spark, str(tmp_path), old).collect()} == {("a.py", "modified"), ("gone", "removed"), ("b/c.txt", "added")}
    with pytest.raises(ValueError):
        payload.validated({"schema_version": 1, "source_commit": "x", "files": {"../a": "0" * 64}})


def small_graph(spark, target="LOCAL_SERVICE_KEY:k"):
    nodes = spark.createDataFrame([("JAVA_CLASS:a", "JAVA_CLASS", "a", "a", "{}", None, None, None, "t", 1), ("LOCAL_SERVICE_KEY:k", "LOCAL_SERVICE_KEY", "k", "k", "{}", None, None, None, "t", 1)], NODE_FACT)
    edges = spark.createDataFrame([("EXPOSED_AS_LOCAL_SERVICE", "JAVA_CLASS:a", target, "{}", None, None, None, "t", 1)], EDGE_FACT)
    return Graph(merge_nodes(nodes), merge_edges(edges))


def test_publish_and_recover(spark, tmp_path):
    with publish.locked(tmp_path):
        with pytest.raises(publish.PublicationError), publish.locked(tmp_path):
            pass
        first = publish.begin(tmp_path, "one")
        publish.stage(spark, first, small_graph(spark), {"r": spark.range(1)}, "c.toml", "t0")
        publish.publish(spark, first)
    assert publish.current(tmp_path).build_id == "one" and publish.recover(tmp_path) == "no_journal"
    assert Graph.read(spark, str(publish.current(tmp_path).folder)).of_type("GRAPH_BUILD").first()["qualified_name"] == "one"
    second = publish.begin(tmp_path, "two")
    with pytest.raises(publish.PublicationError, match="without nodes"):
        publish.stage(spark, second, small_graph(spark, "LOCAL_SERVICE_KEY:none"), {}, "c.toml", "t0")
    with pytest.raises(publish.PublicationError, match="not verified"):
        publish.publish(spark, second)
    assert publish.current(tmp_path).build_id == "one"
    assert publish.discard(second, keep=True) == second.folder and publish.discard(second) is None and not second.folder.exists()
    assert publish.discard(first) == first.folder and first.folder.exists()
    publish.write_json(tmp_path / "PENDING", {"build_id": "two"})
    assert publish.recover(tmp_path) == "rolled_back"
    publish.write_json(tmp_path / "PENDING", {"build_id": "one"})
    assert publish.recover(tmp_path) == "committed"


def test_unsafe_ids(tmp_path):
    for ident in ("../x", "a/b", ".hidden", "a..b"):
        with pytest.raises(ValueError):
            publish.begin(tmp_path, ident)
    publish.begin(tmp_path, "x")
    with pytest.raises(FileExistsError):
        publish.begin(tmp_path, "x")


def test_registration_counters(spark):
    rows = spark.createDataFrame([("A", "resolved", "binder", False), ("A", "unresolved_key", "local", True)], "api string, resolution_status string, service_kind string, is_test boolean")
    got = {r["counter"]: r["count"] for r in report.registration_counters(rows).collect()}
    assert got == {"api:A": 2, "status:resolved": 1, "status:unresolved_key": 1, "kind:binder": 1, "kind:local": 1, "test_sources": 1}
    assert report.inheritance_summary(spark.createDataFrame([("EXTENDS",)], "edge_type string"), spark.range(3).withColumn("x", F.lit(1))).first()["unresolved"] == 3
