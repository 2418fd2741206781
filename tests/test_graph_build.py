"""The whole build over two small repositories, checked fact by fact."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from factloom.operators import graph_queries as gq
from factloom.operators import integrity
from factloom.operators.extract import build_graph, permissions
from factloom.schema import TAG
from factloom.sources.files import read_tags, read_texts, xml_permissions

FILES = {
    "base/IDemo.aidl": "package com.base; interface IDemo { int ping(int value); }",
    "base/Parcel.aidl": "package com.base; parcelable Parcel;",
    "base/Bad.aidl": "interface X { }",
    "base/Base.java": "package com.base;\npublic class Base {\n  @RequiresPermission(\"android.permission.A\")\n  void open() { }\n  void close() {\n    checkPermission(\"android.permission.B\");\n  }\n}\n",
    "base/DemoService.java": "package com.base;\nclass DemoService extends IDemo.Stub {\n  static final String NAME = \"demo\";\n  void start() { ServiceManager.addService(NAME, this); }\n}\n",
    "vendor/demo/Child.java": "package com.vendor;\nimport com.base.Base;\nimport com.base.DemoService;\nclass Child extends Base<String> implements Runnable {\n  void on() { ServiceManager.addService(\"vendor.demo\", new Child()); LocalServices.addService(Base.class, new Missing()); }\n}\n",
    "vendor/demo/tests/T.java": "package com.vendor;\nclass T { void on() { LocalServices.addService(Base.class, new T()); } }\n",
    "base/res/AndroidManifest.xml": '<manifest xmlns:android="http://schemas.android.com/apk/res/android"><permission android:name="android.permission.A"/><permission/></manifest>',
    "base/res/broken.xml": "<manifest><permission>",
}
TAGS = [
    ("class", "Base", "base/Base.java", 2, None, None, None, None),
    ("method", "open", "base/Base.java", 4, "Base", "class", "()", None),
    ("method", "close", "base/Base.java", 5, "Base", "class", "()", None),
    ("class", "DemoService", "base/DemoService.java", 2, None, None, None, "IDemo.Stub"),
    ("field", "NAME", "base/DemoService.java", 3, "DemoService", "class", None, None),
    ("class", "Child", "vendor/demo/Child.java", 4, None, None, None, "Base<String>,Runnable"),
    ("class", "T", "vendor/demo/tests/T.java", 2, None, None, None, None),
    ("method", "lost", "vendor/demo/tests/T.java", 2, "Nowhere", "class", "()", None),
    ("local", "x", "vendor/demo/tests/T.java", 2, "T", "class", None, None),
]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for path, text in FILES.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(text)
    listing = root.parent / "tags.jsonl"
    names = ("kind", "name", "path", "line", "scope", "scopeKind", "signature", "inherits")
    rows = [json.dumps({"_type": "tag", **{k: v for k, v in zip(names, t) if v is not None}, "path": f"{root}/{t[2]}"}) for t in TAGS]
    listing.write_text("\n".join([*rows[:3], "", "{broken", '{"_type": "ptag"}', *rows[3:]]))
    tags, files = read_tags(spark, str(listing), str(root)), read_texts(spark, str(root))
    repositories = spark.createDataFrame([("base", "base"), ("vendor", "vendor/demo")], "name string, path string")
    graph, reports = build_graph(spark, tags, files, repositories)
    return graph.__class__(graph.nodes.persist(), graph.edges.persist()), reports


def edges(graph, kind):
    return {(r["from_node_id"], r["to_node_id"]) for r in graph.links(kind).collect()}


def test_links(built):
    graph, _ = built
    assert edges(graph, "IMPLEMENTS_BINDER") == {("JAVA_CLASS:com.base.DemoService", "AIDL_INTERFACE:com.base.IDemo")}
    assert edges(graph, "EXTENDS") == {("JAVA_CLASS:com.vendor.Child", "JAVA_CLASS:com.base.Base")}
    assert edges(graph, "REGISTERED_AS") == {("JAVA_CLASS:com.base.DemoService", "BINDER_SERVICE_NAME:demo"), ("JAVA_CLASS:com.vendor.Child", "BINDER_SERVICE_NAME:vendor.demo")}
    assert edges(graph, "EXPOSED_AS_LOCAL_SERVICE") == set()  # one instance is unknown, the other a test's
    assert len(edges(graph, "REGISTERS_LOCAL_KEY")) == 2 and len(edges(graph, "REGISTERS_INSTANCE")) == 3
    assert edges(graph, "HAS_METHOD") == {("JAVA_CLASS:com.base.Base", "JAVA_METHOD:com.base.Base#open()"), ("JAVA_CLASS:com.base.Base", "JAVA_METHOD:com.base.Base#close()")}
    assert edges(graph, "HAS_MEMBER") == {("JAVA_CLASS:com.base.DemoService", "JAVA_FIELD:com.base.DemoService#NAME")}
    assert edges(graph, "REQUIRES_PERMISSION") == {("JAVA_METHOD:com.base.Base#open()", "PERMISSION:android.permission.A")}
    assert edges(graph, "ENFORCES_PERMISSION") == {("JAVA_METHOD:com.base.Base#close()", "PERMISSION:android.permission.B")}


def test_sound(built):
    graph, _ = built
    assert integrity.foreign_keys(graph).count() == 0
    assert integrity.duplicate_keys(graph.nodes, "node_id").count() == 0 and integrity.duplicate_keys(graph.edges, "edge_id").count() == 0


def test_places_and_annotation(built):
    graph, _ = built
    child = graph.nodes.where("node_id = 'JAVA_CLASS:com.vendor.Child'").first()
    assert (child["source_path"], child["line_start"]) == ("vendor/demo/Child.java", 4)
    properties = json.loads(child["properties_json"])
    assert properties["repository"] == "vendor" and properties["repository_relative_path"] == "Child.java" and properties["scope"] is None
    assert child["properties_json"] == json.dumps(properties, sort_keys=True, ensure_ascii=False)
    permission = graph.nodes.where("node_id = 'PERMISSION:android.permission.A'").first()
    assert permission["source_path"] == "base/res/AndroidManifest.xml"


def test_reports(built):
    _, reports = built
    assert [r["path"] for r in reports["interfaces.failures"].collect()] == ["base/Bad.aidl"]
    assert {(r["reason"], r["parent_reference"]) for r in reports["inheritance.unresolved"].collect()} == {("parent_not_found_or_ambiguous", "Runnable"), ("parent_not_found_or_ambiguous", "IDemo.Stub")}
    status = {(r["path"], r["api"], r["resolution_status"]) for r in reports["services.registrations"].collect()}
    assert ("vendor/demo/Child.java", "LocalServices.addService", "unresolved_instance") in status and len(status) == 4
    assert [r["qualified_name"] for r in reports["symbols.missing_owner"].collect()] == ["com.vendor.Nowhere#lost()"]
    assert [r["path"] for r in reports["permissions.rejected"].collect()] == ["base/res/broken.xml"]


def test_chain_query(built):
    graph, _ = built
    rows = [tuple(r) for r in gq.service_chain(graph, "demo").collect()]
    assert rows == [("demo", "com.base.DemoService", "com.base.IDemo", "base/DemoService.java", 4)]


def test_permission_overwrite_in_parity(spark, built):
    graph, _ = built
    files = spark.createDataFrame([(p, t) for p, t in FILES.items()], "path string, text string")
    both = permissions(files.where("path like '%.java'"), graph.nodes, files.where("path like '%.xml'"), parity=True)
    from factloom.graph import merge_nodes

    assert merge_nodes(both.nodes).where("node_id = 'PERMISSION:android.permission.A'").first()["source_path"] is None
    assert both.nodes.where("node_type = 'FILE'").count() == 0


def test_rebuilding_gives_the_same_hashes(spark, built):
    graph, _ = built
    from factloom.graph import merge_nodes

    facts = graph.nodes.select("node_id", "node_type", "qualified_name", "display_name", "properties_json", "source_path", "line_start", "line_end", "extractor", F.lit(1).cast("long").alias("ingest_seq"))
    again = merge_nodes(facts.orderBy(F.rand(1)))
    assert again.select("node_id", "content_hash").exceptAll(graph.nodes.select("node_id", "content_hash")).count() == 0


def test_kotlin_and_list_inherits(spark):
    from factloom.operators.extract import inheritance, symbols
    from factloom.graph import merge_nodes
    from factloom.sources.java import file_context

    rows = [("class", "A", "k.kt", 1, None, None, None, None, None, '["B","C<D>"]', 0), ("interface", "B", "k.kt", 2, None, None, None, None, None, None, 1), ("object", "C", "k.kt", 3, None, None, None, None, None, None, 2), ("variable", "v", "k.kt", 1, "A", "class", None, None, None, None, 3)]
    order = "kind string, name string, path string, line long, scope string, scopeKind string, signature string, access string, pattern string, inherits string, seq long"
    tags = spark.createDataFrame(rows, order)
    assert set(tags.columns) - {"seq"} == set(TAG.fieldNames()) - {"_type"}
    contexts = file_context(spark.createDataFrame([("k.kt", "package p.q\nimport x.Y\nimport x.*\n")], "path string, text string"))
    assert contexts.first().asDict() == {"path": "k.kt", "package": "p.q", "imports": {"Y": "x.Y"}, "wildcards": ["x"]}
    facts = symbols(tags, contexts, "kotlin")
    nodes = merge_nodes(facts.nodes)
    assert {r[0] for r in nodes.select("node_id").collect()} == {"KOTLIN_CLASS:p.q.A", "KOTLIN_INTERFACE:p.q.B", "KOTLIN_OBJECT:p.q.C", "KOTLIN_VARIABLE:p.q.A#v", "FILE:k.kt"}
    got = {(r["edge_type"], r["to_node_id"]) for r in inheritance(tags, contexts, nodes).edges.collect()}
    assert got == {("IMPLEMENTS_JAVA_INTERFACE", "KOTLIN_INTERFACE:p.q.B"), ("EXTENDS", "KOTLIN_OBJECT:p.q.C")}


def test_xml_names(spark):
    files = spark.createDataFrame([(p, t) for p, t in FILES.items() if p.endswith(".xml")] + [("n.xml", None)], "path string, text string")
    assert {(r["path"], r["name"], r["error"] is None) for r in xml_permissions(files).collect()} == {("base/res/AndroidManifest.xml", "android.permission.A", True), ("base/res/broken.xml", None, False)}
