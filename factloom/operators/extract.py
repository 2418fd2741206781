"""From parsed sources to graph facts. Files are parsed once; what links them is joins."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom import schema
from factloom.functions import text as tx
from factloom.functions.ids import Raw, canonical_json, merged_json, stable_id
from factloom.graph import Graph, merge_edges, merge_nodes
from factloom.operators.closure import resolve_chain
from factloom.operators.match import asof, longest_prefix
from factloom.sources.aidl import parse_aidl, stub_subclasses
from factloom.sources.files import xml_permissions
from factloom.sources.java import file_context, parse_java


def null() -> Column:
    return F.lit(None).cast("string")



@dataclass(frozen=True)
class Facts:
    """Node and edge facts of a stage, and its reports."""

    nodes: DataFrame
    edges: DataFrame
    reports: dict[str, DataFrame]


def _node(df: DataFrame, node_type: Column, qualified: Column, display: Column, extractor: str, seq: Column, properties: Column | None = None, path: Column | None = None, line: Column | None = None) -> DataFrame:
    path, line = null() if path is None else path, null() if line is None else line
    return df.select(
        stable_id(node_type, qualified).alias("node_id"), node_type.alias("node_type"), qualified.alias("qualified_name"), display.alias("display_name"),
        (F.lit("{}") if properties is None else properties).alias("properties_json"), path.alias("source_path"), line.cast("long").alias("line_start"), line.cast("long").alias("line_end"),
        F.lit(extractor).alias("extractor"), seq.cast("long").alias("ingest_seq"),
    )


def _edge(df: DataFrame, edge_type: Column, source: Column, target: Column, extractor: str, seq: Column, properties: Column | None = None, path: Column | None = None, line: Column | None = None, line_end: Column | None = None) -> DataFrame:
    path, line = null() if path is None else path, null() if line is None else line
    return df.select(
        edge_type.alias("edge_type"), source.alias("from_node_id"), target.alias("to_node_id"), (F.lit("{}") if properties is None else properties).alias("properties_json"),
        path.alias("source_path"), line.cast("long").alias("line_start"), (line if line_end is None else line_end).cast("long").alias("line_end"), F.lit(extractor).alias("extractor"), seq.cast("long").alias("ingest_seq"),
    )


def _file(df: DataFrame, extractor: str, seq: Column) -> DataFrame:
    path = F.col("path")
    return _node(df, F.lit("FILE"), path, tx.file_name(path), extractor, seq, path=path)


def union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _seq(stage: int) -> Column:
    """Later stages write later; within a stage the order of paths and places decides in the merge, however files are split."""
    return F.lit(10 * stage)


# --- symbols -----------------------------------------------------------------


def _scoped(language: str) -> tuple[dict[str, str], dict[str, str], tuple[str, ...]]:
    return (schema.KOTLIN_KINDS, schema.KOTLIN_OWNERS, schema.KOTLIN_MEMBERS) if language == "kotlin" else (schema.JAVA_KINDS, schema.JAVA_OWNERS, schema.JAVA_MEMBERS)


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.get(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in mapping.items()]), lambda x: x["k"] == key), F.lit(0)).getField("v")


def qualified(package: Column, name: Column) -> Column:
    return F.when((package != "") & (name != ""), F.concat(package, F.lit("."), name)).otherwise(F.when(name != "", name).otherwise(package))


def scope_name(scope: Column, package: Column) -> Column:
    """A listing's scope with its package; ``:`` is a dot there."""
    dotted = F.replace(F.coalesce(scope, F.lit("")), F.lit(":"), F.lit("."))
    return F.when(dotted == "", "").when((package != "") & F.startswith(dotted, F.concat(package, F.lit("."))), dotted).otherwise(qualified(package, dotted))


def named_tags(tags: DataFrame, contexts: DataFrame, language: str) -> DataFrame:
    """Tags of known kinds with node_type, package, qualified name and owner's name."""
    kinds, _, _ = _scoped(language)
    name, c = F.coalesce("name", F.lit("")), F.col
    known = tags.withColumn("node_type", _lookup(kinds, c("kind"))).where("node_type is not null")
    full = known.join(contexts.select("path", "package"), "path", "left").withColumn("package", F.coalesce("package", F.lit("")))
    full = full.withColumn("in_scope", scope_name(c("scope"), c("package")))
    kind = F.regexp_replace("node_type", "^(JAVA|KOTLIN)_", "")
    owner = F.when(c("in_scope") != "", c("in_scope")).otherwise(c("package"))
    signature = F.coalesce("signature", F.lit(""))
    member = lambda tail: F.when(owner != "", F.concat(owner, F.lit("#"), tail)).otherwise(tail)
    whole = (
        F.when(kind == "PACKAGE", F.when(c("package") != "", c("package")).otherwise(name))
        .when(kind.isin("CLASS", "INTERFACE", "ENUM", "ANNOTATION", "OBJECT", "TYPEALIAS"), F.when(c("in_scope") != "", F.concat("in_scope", F.lit("."), name)).otherwise(qualified(c("package"), name)))
        .when(kind == "METHOD", member(F.concat(name, signature)))
        .otherwise(member(name))
    )
    return full.withColumns({"qualified_name": whole, "owner": F.when((kind != "PACKAGE") & (owner != ""), owner)})


def symbols(tags: DataFrame, contexts: DataFrame, language: str = "java") -> Facts:
    """Nodes of symbols and their files, DECLARED_IN, and membership edges where the owner is a node too."""
    c, seq, by = F.col, _seq(1 if language == "java" else 2), "universal-ctags-v0.2.1"
    _, owners, members = _scoped(language)
    named = named_tags(tags, contexts, language)
    kept = named.where("qualified_name != ''")
    properties = canonical_json(kind=c("kind"), package=F.nullif(c("package"), F.lit("")), scope=c("scope"), scopeKind=c("scopeKind"), owner=c("owner"), signature=c("signature"), access=c("access"), pattern=c("pattern"))
    node = _node(kept, c("node_type"), c("qualified_name"), F.coalesce("name", "qualified_name"), by, seq, properties, c("path"), c("line"))
    ident = stable_id(c("node_type"), c("qualified_name"))
    declared = _edge(kept, F.lit("DECLARED_IN"), ident, stable_id("FILE", c("path")), by, seq, path=c("path"), line=c("line"))
    scope_kind = F.when(F.coalesce("scopeKind", F.lit("")) != "", c("scopeKind")).otherwise("package")
    inner = kept.where(c("kind").isin(*members)).withColumn("owner_id", stable_id(_lookup(owners, scope_kind), c("owner")))
    known = node.where(c("node_type").isin(*set(owners.values()))).select(c("node_id").alias("owner_id")).distinct()
    linked = inner.join(known, "owner_id", "left_semi")
    held = _edge(linked, F.when(c("kind") == "method", "HAS_METHOD").otherwise("HAS_MEMBER"), c("owner_id"), ident, by, seq, path=c("path"), line=c("line"))
    missing = inner.join(known, "owner_id", "left_anti").unionByName(inner.where("owner_id is null")).select("path", "line", "qualified_name", "owner").distinct()
    files = _file(kept.select("path").distinct(), "file-indexer-v0.2.1", _seq(1))
    skipped = named.where("qualified_name = '' or qualified_name is null").select("path", "line", "kind")
    return Facts(union(node, files), union(declared, held), {"skipped": skipped, "missing_owner": missing})


# --- inheritance -------------------------------------------------------------

TYPES = ("JAVA_CLASS", "JAVA_INTERFACE", "JAVA_ENUM", "KOTLIN_CLASS", "KOTLIN_INTERFACE", "KOTLIN_OBJECT")


def resolve_types(references: DataFrame, types: DataFrame) -> DataFrame:
    """Add parent_id, parent_type and parent to (reference, child, package, imports, wildcards, ref).

    In order: the name as written, an import of its simple name, the same
    package, scopes around the child from the inner to the outer, a wildcard
    import if only one fits, and a simple name that only one type has.
    ``ref`` tells references apart.
    """
    c = F.col
    dotted = F.replace("reference", F.lit("$"), F.lit("."))
    simple = F.element_at(F.split(dotted, r"\."), -1)
    base = F.when(c("package") != "", F.size(F.split("package", r"\."))).otherwise(0)
    parts = F.split("child", r"\.")
    own = F.size(parts) - base
    scopes = F.when(own > 0, F.transform(F.sequence(own - 1, F.lit(0), F.lit(-1)), lambda n: F.array_join(F.concat(F.slice(parts, 1, base + n), F.array(dotted)), "."))).otherwise(F.array().cast("array<string>"))
    exact = F.concat(F.array(dotted, c("imports")[simple], F.when(c("package") != "", F.concat("package", F.lit("."), dotted))), scopes)
    ranked = F.filter(F.transform(exact, lambda x, i: F.struct(i.alias("rank"), x.alias("qualified_name"))), lambda x: x["qualified_name"].isNotNull())
    starred = F.transform("wildcards", lambda w: F.struct(F.lit(1000).alias("rank"), F.concat(w, F.lit("."), simple).alias("qualified_name")))
    asked = references.select("ref", simple.alias("simple"), F.explode(F.concat(ranked, starred)).alias("x")).select("ref", "simple", "x.rank", "x.qualified_name")
    target = F.struct("node_id", "node_type", "qualified_name").alias("target")
    by_name = types.groupBy("qualified_name").agg(F.min(F.struct("node_id", "node_type", "qualified_name")).alias("target"))
    hits = asked.join(by_name, "qualified_name").groupBy("ref", "rank").agg(F.min("target").alias("target"), F.count("*").alias("n")).where("rank < 1000 or n = 1").select("ref", "rank", "target")
    alone = types.groupBy("display_name").agg(F.count("*").alias("n"), F.min(F.struct("node_id", "node_type", "qualified_name")).alias("target")).where("n = 1").select(c("display_name").alias("simple"), "target")
    last = references.select("ref", simple.alias("simple")).join(alone, "simple").select("ref", F.lit(2000).alias("rank"), "target")
    best = hits.unionByName(last).groupBy("ref").agg(F.min_by("target", "rank").alias("target"))
    return references.join(best, "ref", "left").select(*references.columns, c("target.node_id").alias("parent_id"), c("target.node_type").alias("parent_type"), c("target.qualified_name").alias("parent"))


def inheritance(tags: DataFrame, contexts: DataFrame, nodes: DataFrame) -> Facts:
    """EXTENDS and IMPLEMENTS_JAVA_INTERFACE edges of what listings say types inherit."""
    c, by = F.col, "java-inheritance-v0.1"
    types = nodes.where(c("node_type").isin(*TYPES) & c("qualified_name").isNotNull() & c("source_path").isNotNull()).select("node_id", "node_type", "qualified_name", "display_name")
    heirs = tags.where(c("kind").isin("class", "interface", "enum") & c("inherits").isNotNull()).join(contexts, "path", "left")
    package = F.coalesce("package", F.lit(""))
    child = qualified(F.when(F.coalesce("scope", F.lit("")) != "", scope_name(c("scope"), package)).otherwise(package), F.coalesce("name", F.lit("")))
    rows = heirs.select("path", "line", "seq", package.alias("package"), "imports", F.coalesce("wildcards", F.array().cast("array<string>")).alias("wildcards"), child.alias("child"), tx.split_parents(c("inherits")).alias("parents")).where(F.size("parents") > 0)
    known = types.groupBy("qualified_name").agg(F.min(F.struct("node_id", "node_type")).alias("c")).select(c("qualified_name").alias("child"), c("c.node_id").alias("child_id"), c("c.node_type").alias("child_type"))
    found = rows.join(known, "child", "left")
    lost = found.where("child_id is null").select(F.lit("child_not_found").alias("reason"), "child", null().alias("parent_reference"), "path", "line")
    each = found.where("child_id is not null").select("*", F.posexplode("parents").alias("pos", "reference"))
    refs = each.withColumn("ref", F.sha2(F.concat_ws("|", "path", F.coalesce(c("seq").cast("string"), F.lit("")), F.coalesce(c("line").cast("string"), F.lit("")), "child", "reference", c("pos").cast("string")), 256))
    resolved = resolve_types(refs, types)
    parent_interface, child_interface = c("parent_type").isin("JAVA_INTERFACE", "KOTLIN_INTERFACE"), c("child_type").isin("JAVA_INTERFACE", "KOTLIN_INTERFACE")
    kind = F.when(parent_interface & ~child_interface, "IMPLEMENTS_JAVA_INTERFACE").when(parent_interface | c("parent_type").isin("JAVA_CLASS", "JAVA_ENUM", "KOTLIN_CLASS", "KOTLIN_OBJECT"), "EXTENDS")
    typed = resolved.withColumn("edge_type", kind)
    ok = typed.where("edge_type is not null")
    # The first mention of a pair is its edge.
    first = ok.groupBy("edge_type", "child_id", "parent_id").agg(F.min(F.struct(F.coalesce("seq", F.lit(0)).alias("seq"), "path", "line", "child", "parent")).alias("f")).select("edge_type", "child_id", "parent_id", "f.*")
    edges = _edge(first, c("edge_type"), c("child_id"), c("parent_id"), by, _seq(4), canonical_json(source_field=F.lit("ctags.inherits"), direct=Raw(F.lit("true"))), c("path"), c("line"))
    open_ = typed.where("parent_id is null").select(F.lit("parent_not_found_or_ambiguous").alias("reason"), "child", c("reference").alias("parent_reference"), "path", "line")
    odd = typed.where("parent_id is not null and edge_type is null").select(F.lit("unsupported_type_relation").alias("reason"), "child", c("parent").alias("parent_reference"), "path", "line")
    spark = tags.sparkSession
    return Facts(spark.createDataFrame([], schema.NODE_FACT), edges, {"resolved": first.select("edge_type", "child", "parent", "path", "line"), "unresolved": union(lost, open_, odd)})


# --- interfaces --------------------------------------------------------------


def interfaces(aidl_files: DataFrame) -> tuple[Facts, DataFrame]:
    """Interface and method nodes, and the parsed interfaces."""
    c, by, seq = F.col, "aidl-parser-v0.1", _seq(3)
    parsed = parse_aidl(aidl_files).persist()
    good = parsed.where("error is null").withColumn("qname", F.concat("package", F.lit("."), "name"))
    ident = stable_id("AIDL_INTERFACE", c("qname"))
    imports = F.concat(F.lit("["), F.array_join(F.transform("imports", lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", "), F.lit("]"))
    methods = good.select("path", "qname", F.explode("methods").alias("m")).withColumn("mname", F.concat("qname", F.lit("#"), "m.name", "m.signature"))
    method_id = stable_id("AIDL_METHOD", c("mname"))
    nodes = union(
        _file(good.select("path").distinct(), by, seq),
        _node(good, F.lit("AIDL_INTERFACE"), c("qname"), c("name"), by, seq, canonical_json(package=c("package"), imports=Raw(imports)), c("path")),
        _node(methods, F.lit("AIDL_METHOD"), c("mname"), c("m.name"), by, seq, canonical_json(return_type=c("m.return_type"), signature=c("m.signature"), declaration=c("m.declaration")), c("path")),
    )
    edges = union(
        _edge(good, F.lit("DECLARED_IN"), ident, stable_id("FILE", c("path")), by, seq, path=c("path")),
        _edge(methods, F.lit("AIDL_HAS_METHOD"), stable_id("AIDL_INTERFACE", c("qname")), method_id, by, seq, path=c("path")),
        _edge(methods, F.lit("DECLARED_IN"), method_id, stable_id("FILE", c("path")), by, seq, path=c("path")),
    )
    failed = parsed.where("error is not null and error != 'no interface'").select("path", "error")
    counts = good.select("qname", F.size("methods").alias("method_count"))
    return Facts(nodes, edges, {"failures": failed, "interfaces": counts}), good


def binder_links(java_files: DataFrame, parsed: DataFrame, nodes: DataFrame) -> Facts:
    """IMPLEMENTS_BINDER edges of classes that extend an interface's Stub, where both ends are nodes."""
    c, by = F.col, "binder-implementation-v0.1"
    found = stub_subclasses(java_files).withColumn("dotted", F.replace("reference", F.lit("$"), F.lit("."))).withColumn("simple", F.element_at(F.split("dotted", r"\."), -1))
    by_simple = parsed.groupBy(c("name").alias("simple")).agg(F.collect_set("qname").alias("known"))
    joined = found.join(by_simple, "simple", "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
    imported = F.element_at(F.filter("imports", lambda x: F.element_at(F.split(x, r"\."), -1) == c("simple")), -1)
    beside = qualified(c("package"), c("simple"))
    aidl = F.when(c("dotted").contains(".") & tx.looks_like_package(c("dotted")), c("dotted")).when(F.exists("imports", lambda x: F.element_at(F.split(x, r"\."), -1) == c("simple")), imported).when(F.array_contains("known", beside), beside).when(F.size("known") == 1, F.get("known", F.lit(0)))
    relations = joined.select("path", qualified(c("package"), c("class_name")).alias("implementation"), aidl.alias("aidl_interface")).where("aidl_interface is not null")
    ids = relations.withColumns({"from_id": stable_id("JAVA_CLASS", c("implementation")), "to_id": stable_id("AIDL_INTERFACE", c("aidl_interface"))})
    have = nodes.select("node_id")
    linked = ids.join(have, c("from_id") == c("node_id"), "left_semi").join(have, c("to_id") == c("node_id"), "left_semi")
    lost = ids.join(linked.select("from_id", "to_id", "path"), ["from_id", "to_id", "path"], "left_anti").select("implementation", "aidl_interface", "path")
    edges = _edge(linked, F.lit("IMPLEMENTS_BINDER"), c("from_id"), c("to_id"), by, _seq(3), canonical_json(pattern=F.lit("extends_aidl_stub")), c("path"))
    return Facts(java_files.sparkSession.createDataFrame([], schema.NODE_FACT), edges, {"unresolved": lost})


# --- services ----------------------------------------------------------------


def resolve_strings(parsed: DataFrame) -> DataFrame:
    """(id, value) of every registration key and constant: literals, or what one definition leads to in 10 steps.

    A reference counts only if exactly one definition answers to any of its names.
    """
    c = F.col
    refs = lambda what, kind: parsed.select("path", F.explode(what).alias("r")).select(F.concat(F.lit(f"{kind}:"), "path", F.lit(":"), c("r.offset").cast("string")).alias("id"), "path", "r.*")
    constants, calls = refs("constants", "constant"), refs("calls", "call")
    wanted = union(*[df.select("id", "value", "names", "simple") for df in (constants, calls)]).persist()
    # Of definitions with one qualified name the last one counts.
    by_name = constants.groupBy("qualified").agg(F.max_by("id", F.struct("path", "offset")).alias("hit"))
    by_simple = constants.groupBy("simple_name").agg(F.count("*").alias("n"), F.min("id").alias("hit")).where("n = 1")
    named = wanted.where("value is null").select("id", F.explode("names").alias("qualified")).join(by_name, "qualified").select("id", "hit")
    simple = wanted.where("value is null").join(by_simple, c("simple") == c("simple_name")).select("id", "hit")
    only = named.unionByName(simple).groupBy("id").agg(F.min("hit").alias("lo"), F.max("hit").alias("hi")).where("lo = hi").select("id", c("lo").alias("next"))
    return resolve_chain(wanted.select("id", "value").join(only, "id", "left"))


def resolve_classes(guesses: DataFrame, nodes: DataFrame) -> DataFrame:
    """(guess, instance_id, instance_type): a class of that name, the only one of its simple name, or the only one it is a suffix of."""
    c = F.col
    classes = nodes.where("node_type in ('JAVA_CLASS', 'JAVA_INTERFACE', 'JAVA_ENUM') and qualified_name is not null").select("node_id", "node_type", "qualified_name", "display_name")
    only = classes.where("node_type = 'JAVA_CLASS'")
    asked = guesses.where("guess is not null").select("guess").distinct().withColumn("simple", F.element_at(F.split("guess", r"\."), -1))
    target = F.struct(c("node_id").alias("id"), c("qualified_name").alias("name"))
    exact = asked.join(only, c("guess") == c("qualified_name")).groupBy("guess").agg(F.min(target).alias("t")).withColumn("rank", F.lit(0))
    # Classes are counted by what may name them before guesses meet them: a name that many classes share is one row by then.
    alone = asked.join(only.groupBy(c("display_name").alias("simple")).agg(F.count("*").alias("n"), F.min(target).alias("t")).where("n = 1"), "simple").select("guess", "t", F.lit(1).alias("rank"))
    parts = F.split("qualified_name", r"\.")
    tails = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda at: F.array_join(F.slice(parts, at, F.size(parts)), "."))
    nested = only.where((F.size(parts) > 1) & (c("display_name") == F.element_at(parts, -1)))
    by_tail = nested.select(F.explode(tails).alias("guess"), target.alias("t")).groupBy("guess").agg(F.count("*").alias("n"), F.min("t").alias("t")).where("n = 1")
    tail = asked.join(by_tail, "guess").select("guess", "t", F.lit(2).alias("rank"))
    best = union(exact, alone, tail).groupBy("guess").agg(F.min_by("t", "rank").alias("t"))
    return best.select("guess", c("t.id").alias("instance_id"), c("t.name").alias("instance_type"))


def services(java_files: DataFrame, nodes: DataFrame) -> Facts:
    """Registrations with their keys and instances, and the links these give."""
    c, by, seq = F.col, "service-registration-v0.1", _seq(5)
    parsed = parse_java(java_files).persist()
    calls = parsed.select("path", F.explode("calls").alias("r")).select(F.concat(F.lit("call:"), "path", F.lit(":"), c("r.offset").cast("string")).alias("id"), "path", "r.*")
    keys = resolve_strings(parsed).select("id", c("value").alias("key"))
    facts = calls.join(keys, "id", "left").join(resolve_classes(calls, nodes), "guess", "left")
    has_key, has_type = F.coalesce(c("key"), F.lit("")) != "", c("instance_id").isNotNull()
    status = F.when(has_key & has_type, "resolved").when(has_type, "unresolved_key").when(has_key, "unresolved_instance").otherwise("unresolved_key_and_instance")
    facts = facts.withColumns({
        "status": status, "is_test": tx.is_test_path(c("path")), "has_key": has_key,
        "registration_id": stable_id("SERVICE_REGISTRATION", F.concat_ws(":", "api", "path", c("line").cast("string"), c("offset").cast("string"))),
        "key_type": F.when(c("kind") == "binder", "BINDER_SERVICE_NAME").otherwise("LOCAL_SERVICE_KEY"),
    }).persist()
    properties = canonical_json(
        api=c("api"), service_kind=c("kind"), key_expression=c("key_expression"), resolved_key=c("key"), instance_expression=c("instance_expression"), resolved_instance_type=c("instance_type"),
        resolution_status=c("status"), raw_call=c("raw_call"), is_test_source=Raw(c("is_test").cast("string")),
    )
    keyed = facts.where("has_key")
    key_id = stable_id(c("key_type"), c("key"))
    shown = F.when(c("kind") == "binder", c("key")).otherwise(F.element_at(F.split("key", r"\."), -1))
    registration = facts.select(
        c("registration_id").alias("node_id"), F.lit("SERVICE_REGISTRATION").alias("node_type"), F.concat_ws(":", "api", "path", c("line").cast("string")).alias("qualified_name"), F.concat("api", F.lit("@"), c("line").cast("string")).alias("display_name"),
        properties.alias("properties_json"), c("path").alias("source_path"), c("line").cast("long").alias("line_start"), c("line").cast("long").alias("line_end"), F.lit(by).alias("extractor"), seq.cast("long").alias("ingest_seq"),
    )
    key_nodes = _node(keyed, c("key_type"), c("key"), shown, by, seq, canonical_json(value=c("key"), source_expression=c("key_expression"), service_kind=c("kind")), c("path"), c("line"))
    place = {"path": c("path"), "line": c("line")}
    whole = keyed.where("instance_id is not null")
    edges = union(
        _edge(facts, F.lit("DECLARED_IN"), c("registration_id"), stable_id("FILE", c("path")), by, seq, **place),
        _edge(keyed, F.when(c("kind") == "binder", "REGISTERS_BINDER_NAME").otherwise("REGISTERS_LOCAL_KEY"), c("registration_id"), key_id, by, seq, **place),
        _edge(whole, F.lit("REGISTERS_INSTANCE"), c("registration_id"), c("instance_id"), by, seq, **place),
        _edge(whole.where("not is_test"), F.when(c("kind") == "binder", "REGISTERED_AS").otherwise("EXPOSED_AS_LOCAL_SERVICE"), c("instance_id"), key_id, by, seq, canonical_json(registration_id=c("registration_id"), api=c("api")), **place),
    )
    report = facts.select("registration_id", "api", c("kind").alias("service_kind"), c("key").alias("resolved_key"), c("instance_type").alias("resolved_instance_type"), c("status").alias("resolution_status"), "path", "line", "is_test")
    return Facts(union(registration, _file(facts.select("path").distinct(), by, seq), key_nodes), edges, {"registrations": report})


# --- permissions -------------------------------------------------------------


# Calls that check a permission.
CHECKS = ("checkPermission", "enforceCallingOrSelfPermission", "enforceCallingPermission", "enforcePermission")


def permissions(source_files: DataFrame, nodes: DataFrame, xml_files: DataFrame | None = None, parity: bool = False) -> Facts:
    """Permissions that methods require or enforce, and those that XML declares.

    An annotation belongs to the first method at or after its line, a check to
    the last one at or before; without one it is dropped. XML declarations come
    with their FILE node and keep their place when code names the permission
    too; ``parity`` writes the code's permission over it, and no FILE node.
    """
    c, by, seq = F.col, "java_permission_scanner", _seq(7)
    lines = source_files.where(F.contains("text", F.lit("ermission"))).select("path", F.posexplode(tx.lines(c("text"))).alias("at", "content")).select("path", (c("at") + 1).cast("long").alias("line"), "content")
    methods = nodes.where("node_type in ('JAVA_METHOD', 'KOTLIN_METHOD') and line_start is not null").select(c("source_path").alias("path"), c("line_start").alias("line"), c("node_id").alias("method_id"))
    # An annotation's strings stand before its first closing parenthesis, a check's name is its first argument.
    quoted = r'"([\w.]+)"'
    annotated = F.substring_index(F.regexp_extract("content", r"@RequiresPermission\s*\((.*)", 1), ")", 1)
    required = lines.where(F.col("content").rlike(r"@RequiresPermission\s*\(.*\)")).select("path", "line", F.explode(F.regexp_extract_all(annotated, F.lit(quoted), F.lit(1))).alias("permission"))
    checks = rf"\b(?:{'|'.join(CHECKS)})\s*\(\s*{quoted}"
    checked = lines.select("path", "line", F.explode(F.regexp_extract_all("content", F.lit(checks), F.lit(1))).alias("permission"))
    owned = asof(required, methods, "path", "line", "method_id", forward=True).withColumn("edge_type", F.lit("REQUIRES_PERMISSION")).unionByName(
        asof(checked, methods, "path", "line", "method_id").withColumn("edge_type", F.lit("ENFORCES_PERMISSION"))).where("method_id is not null")
    permission = stable_id("PERMISSION", c("permission"))
    named = _node(owned.select("permission").distinct(), F.lit("PERMISSION"), c("permission"), c("permission"), by, seq if parity else _seq(6))
    edges = _edge(owned, c("edge_type"), c("method_id"), permission, by, seq, path=c("path"), line=c("line"), line_end=null())
    reports = {"summary": owned.groupBy("edge_type").agg(F.count("*").alias("count"))}
    if xml_files is None:
        return Facts(named, edges, reports)
    x = xml_permissions(xml_files).persist()
    good = x.where("name is not null")
    declared = _node(good, F.lit("PERMISSION"), c("name"), c("name"), "xml_permission_importer", _seq(6) + 1, path=c("path"))
    declared_in = _edge(good, F.lit("DECLARED_IN"), stable_id("PERMISSION", c("name")), stable_id("FILE", c("path")), "xml_permission_importer", seq, path=c("path"))
    files = [] if parity else [_file(good.select("path").distinct(), "xml_permission_importer", _seq(0))]
    return Facts(union(named, declared, *files), union(edges, declared_in), reports | {"rejected": x.where("error is not null").select("path", "error")})


# --- all stages --------------------------------------------------------------


def annotate(nodes: DataFrame, repositories: DataFrame, parity: bool = False) -> DataFrame:
    """Nodes with repository, repository_path and the path below it in their properties.

    repositories: (name, path), enabled ones. The content hash follows the
    properties; with ``parity`` it stays as it was before.
    """
    from factloom.functions.ids import node_hash

    c = F.col
    found = longest_prefix(nodes, repositories.select("path", c("name").alias("_repository"), c("path").alias("_root")), "source_path", "path", "_repository", "_root")
    below = F.regexp_replace(F.expr("substring(source_path, length(_root) + 1)"), "^/+", "")
    properties = F.when(c("_repository").isNotNull(), merged_json(c("properties_json"), repository=c("_repository"), repository_path=c("_root"), repository_relative_path=below)).otherwise(c("properties_json"))
    out = found.withColumn("properties_json", properties).drop("_repository", "_root")
    if parity:
        return out
    return out.withColumn("content_hash", node_hash(c("node_type"), c("qualified_name"), c("display_name"), c("properties_json"), c("source_path"), c("line_start"), c("line_end")))


def build_graph(spark: SparkSession, java_tags: DataFrame, files: DataFrame, repositories: DataFrame | None = None, kotlin_tags: DataFrame | None = None, parity: bool = False) -> tuple[Graph, dict[str, DataFrame]]:
    """The graph of source ``files`` (path, text) and symbol listings, and the stages' reports."""
    ends = lambda *suffixes: files.where(reduce(lambda a, b: a | b, [F.endswith("path", F.lit(s)) for s in suffixes]))
    java, code = ends(".java"), ends(".java", ".kt", ".kts")
    contexts = file_context(code).persist()
    done: dict[str, Facts] = {"symbols": symbols(java_tags, contexts, "java")}
    if kotlin_tags is not None:
        done["kotlin_symbols"] = symbols(kotlin_tags, contexts, "kotlin")
    done["interfaces"], parsed = interfaces(ends(".aidl"))
    nodes = merge_nodes(union(*[f.nodes for f in done.values()])).persist()
    tags = java_tags if kotlin_tags is None else java_tags.unionByName(kotlin_tags)
    done["binder"] = binder_links(java, parsed, nodes)
    done["inheritance"] = inheritance(tags, contexts, nodes)
    done["services"] = services(java, nodes)
    done["permissions"] = permissions(code, nodes, ends(".xml"), parity)
    all_nodes = merge_nodes(union(*[f.nodes for f in done.values()]))
    if repositories is not None:
        all_nodes = annotate(all_nodes, repositories, parity)
    graph = Graph(all_nodes, merge_edges(union(*[f.edges for f in done.values()])))
    return graph, {f"{stage}.{name}": df for stage, f in done.items() for name, df in f.reports.items()}
