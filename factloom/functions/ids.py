"""Identities, content hashes and canonical JSON as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(kind: Column | str, identity: Column) -> Column:
    """``kind:identity``."""
    return F.concat(F.lit(kind) if isinstance(kind, str) else kind, F.lit(":"), identity)


def _or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def _line(value: Column) -> Column:
    """A line number as text; 0 and null are both empty."""
    return F.when(value != 0, value.cast("string")).otherwise(F.lit(""))


def hashed(*parts: Column) -> Column:
    """sha256 hex of the parts joined by ``|``; null parts are empty."""
    return F.sha2(F.concat_ws("|", *[_or_empty(p) for p in parts]), 256)


def edge_id(edge_type: Column, source: Column, target: Column, path: Column, line: Column) -> Column:
    return hashed(edge_type, source, target, path, _line(line))


def node_hash(node_type: Column, qualified_name: Column, display_name: Column, properties: Column, path: Column, line_start: Column, line_end: Column) -> Column:
    return hashed(node_type, qualified_name, display_name, properties, path, _line(line_start), _line(line_end))


def edge_hash(edge_type: Column, source: Column, target: Column, properties: Column) -> Column:
    """Place is no part of an edge's content."""
    return hashed(edge_type, source, target, properties)


def _quoted(value: Column) -> Column:
    """A JSON string literal, by the JSON writer's own rules; null for null."""
    text = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNotNull(), text.substr(F.lit(6), F.length(text) - 6))


@dataclass(frozen=True)
class Raw:
    """A property that is JSON text already: a boolean, a number, an array."""

    text: Column


def canonical_json(spaced: bool = True, **properties: Column | Raw) -> Column:
    """An object with sorted keys, null values kept; ``", "`` and ``": "`` between if ``spaced``.

    Columns are quoted as strings; pass booleans, numbers and arrays as ``Raw``.
    """
    comma, colon = (", ", ": ") if spaced else (",", ":")
    parts: list[Column] = []
    for i, key in enumerate(sorted(properties)):
        value = properties[key]
        parts += [F.lit(("{" if i == 0 else comma) + f'"{key}"' + colon), F.coalesce(value.text if isinstance(value, Raw) else _quoted(value), F.lit("null"))]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


def merged_json(properties: Column, spaced: bool = True, **more: Column) -> Column:
    """A JSON object of string, null or raw values with keys set anew, canonical again."""
    comma, colon = (", ", ": ") if spaced else (",", ":")
    old = F.transform(F.coalesce(F.json_object_keys(properties), F.array().cast("array<string>")), lambda k: F.struct(k.alias("k"), F.try_variant_get(F.parse_json(properties), F.lit("$"), "map<string,variant>")[k].alias("v")))
    kept = F.transform(F.filter(old, lambda x: ~x["k"].isin(*more)), lambda x: F.struct(x["k"].alias("k"), F.coalesce(F.to_json(x["v"]), F.lit("null")).alias("v")))
    added = F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(_quoted(v), F.lit("null")).alias("v")) for k, v in more.items()])
    pairs = F.transform(F.array_sort(F.concat(kept, added)), lambda x: F.concat(_quoted(x["k"]), F.lit(colon), x["v"]))
    return F.concat(F.lit("{"), F.array_join(pairs, comma), F.lit("}"))
