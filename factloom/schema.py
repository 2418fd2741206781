"""Row types and vocabularies of the graph."""

from __future__ import annotations

from pyspark.sql import types as T

_PROVENANCE = "properties_json string, source_path string, line_start long, line_end long, source_revision string, extractor string, extractor_version string, content_hash string, status string, updated_at timestamp"
NODE = f"node_id string, node_type string, qualified_name string, display_name string, {_PROVENANCE}"
EDGE = f"edge_id string, edge_type string, from_node_id string, to_node_id string, {_PROVENANCE}"

#: What extractors hand in, before hashing: ``properties`` as canonical JSON, ``ingest_seq`` orders writers.
NODE_FACT = "node_id string, node_type string, qualified_name string, display_name string, properties_json string, source_path string, line_start long, line_end long, extractor string, ingest_seq long"
EDGE_FACT = "edge_type string, from_node_id string, to_node_id string, properties_json string, source_path string, line_start long, line_end long, extractor string, ingest_seq long"

EXTRACTOR_VERSION = "1.0.0"

# Symbol kinds and the node types they become.
JAVA_KINDS = {
    "class": "JAVA_CLASS",
    "interface": "JAVA_INTERFACE",
    "method": "JAVA_METHOD",
    "field": "JAVA_FIELD",
    "package": "JAVA_PACKAGE",
    "enum": "JAVA_ENUM",
    "enumConstant": "JAVA_ENUM_CONSTANT",
    "annotation": "JAVA_ANNOTATION",
}
KOTLIN_KINDS = {
    "class": "KOTLIN_CLASS",
    "interface": "KOTLIN_INTERFACE",
    "object": "KOTLIN_OBJECT",
    "typealias": "KOTLIN_TYPEALIAS",
    "method": "KOTLIN_METHOD",
    "variable": "KOTLIN_VARIABLE",
    "property": "KOTLIN_PROPERTY",
    "constant": "KOTLIN_CONSTANT",
    "enumConstant": "KOTLIN_ENUM_CONSTANT",
    "package": "KOTLIN_PACKAGE",
}
JAVA_OWNERS = {k: JAVA_KINDS[k] for k in ("class", "interface", "enum", "annotation", "package")}
KOTLIN_OWNERS = {"enum": "KOTLIN_CLASS"} | {k: KOTLIN_KINDS[k] for k in ("class", "interface", "object", "package")}
JAVA_MEMBERS = ("method", "field", "enumConstant")
KOTLIN_MEMBERS = ("method", "variable", "constant", "property", "enumConstant")

# Path parts that mark test sources.
TEST_PARTS = ("test", "tests", "testing", "unittest", "unittests", "mock", "mocks", "benchmark", "benchmarks")

# File suffixes and names of languages.
LANGUAGE_SUFFIXES = {
    ".java": "java",
    ".aidl": "aidl",
    ".kt": "kotlin",
    ".kts": "kotlin",
    ".c": "c",
    ".h": "c",
    ".cc": "cpp",
    ".cpp": "cpp",
    ".cxx": "cpp",
    ".hpp": "cpp",
    ".hh": "cpp",
    ".rs": "rust",
    ".hal": "hidl",
    ".py": "python",
    ".proto": "proto",
    ".mk": "make",
    ".xml": "xml",
}
LANGUAGE_FILES = {"Android.bp": "blueprint", "Android.mk": "make"}

#: A symbol listing's record; ``inherits`` may be a string or a list, which arrives as its JSON text.
TAG = T.StructType([T.StructField(n, T.LongType() if n == "line" else T.StringType()) for n in ("_type", "name", "kind", "path", "line", "scope", "scopeKind", "signature", "access", "pattern", "inherits")])
