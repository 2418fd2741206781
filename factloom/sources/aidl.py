"""Interface definition files: one interface with its methods."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Declarations that are no methods.
OTHER = {"const", "parcelable", "enum", "union", "interface"}
_TOKEN = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*|\S")

INTERFACE = "path string, package string, name string, imports array<string>, methods array<struct<name: string, return_type: string, signature: string, declaration: string>>, error string"


def uncommented(text: str) -> str:
    """The text without block comments, and then without what follows ``//`` on a line."""
    kept, at = [], 0
    while (start := text.find("/*", at)) >= 0 and (end := text.find("*/", start + 2)) >= 0:
        kept.append(text[at:start])
        at = end + 2
    return "\n".join(line.partition("//")[0] for line in "".join([*kept, text[at:]]).split("\n"))


def statements(body: str) -> list[str]:
    """What stands before each ``;`` outside brackets; an unfinished end is dropped."""
    out, word, level = [], [], {")": 0, ">": 0, "]": 0}
    closes = {"(": ")", "<": ">", "[": "]"}
    for c in body:
        if c == ";" and not any(level.values()):
            out.append("".join(word).strip())
            word = []
            continue
        word.append(c)
        if c in closes:
            level[closes[c]] += 1
        elif level.get(c):
            level[c] -= 1
    return [x for x in out if x]


def without_annotations(statement: str) -> str:
    """One space between words, and no ``@Name`` with its parenthesis."""
    plain, *marked = statement.split("@")
    for part in marked:
        name = _TOKEN.match(part)
        if not name or not (name[0][0].isalpha() or name[0][0] == "_"):
            plain += "@" + part
            continue
        rest = part[name.end() :]
        closed = rest.find(")") if rest.startswith("(") else -1
        plain += rest[closed + 1 :]
    return " ".join(plain.split())


def parse_method(statement: str) -> dict | None:
    """A method's parts, or None for other declarations: ``[oneway] type name ( parameters ) [throws ...]``."""
    text = without_annotations(statement)
    head, opened, rest = text.partition("(")
    words = head.split()
    if not opened or words[:1] and words[0] in OTHER:
        return None
    if len(words) == 3 and words[0] == "oneway":
        words = words[1:]
    if len(words) != 2 or not re.fullmatch(r"[A-Za-z_][\w.$<>[\]?]*", words[0], re.ASCII) or not (words[1].isidentifier() and words[1].isascii()):
        return None
    # The parameters end at the last parenthesis with nothing, or what is thrown, behind it.
    for end in (i for i in range(len(rest) - 1, -1, -1) if rest[i] == ")"):
        tail = rest[end + 1 :]
        if not tail or tail.startswith(" throws "):
            return {"name": words[1], "return_type": words[0], "signature": f"({' '.join(rest[:end].split())})", "declaration": text}
    return None


def parse_interface(text: str) -> tuple[str, str, list[str], list[dict]]:
    """(package, name, imports, methods) of the first interface; ``ValueError`` says what is missing."""
    text = uncommented(text)
    tokens = [(m[0], m.end()) for m in _TOKEN.finditer(text)] + [("", len(text))] * 2
    threes = list(zip(tokens, tokens[1:], tokens[2:]))

    def named(keyword: str, mark: str) -> list[tuple[str, int]]:
        """(name, end of the mark) wherever a name stands between a keyword and a mark."""
        return [(name, end) for (word, _), (name, _), (last, end) in threes if word == keyword and last == mark and (name[0].isalpha() or name[0] == "_")]

    packages, heads = named("package", ";"), [x for x in named("interface", "{") if "." not in x[0]]
    if not packages:
        raise ValueError("no package")
    if not heads:
        raise ValueError("no interface")
    name, start = heads[0]
    depth = 1
    for word, end in ((w, e) for w, e in tokens if e > start and w in ("{", "}")):
        depth += 1 if word == "{" else -1
        if not depth:
            methods = [m for x in statements(text[start : end - 1]) if (m := parse_method(x))]
            return packages[0][0], name, [x for x, _ in named("import", ";")], methods
    raise ValueError("unclosed interface")


def parse_aidl(files: DataFrame) -> DataFrame:
    """(path, text) -> a row per file, with ``error`` where it can't be parsed.

    ``no interface`` is no failure (parcelables have none); reports leave it out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, text in zip(batch["path"], batch["text"]):
                try:
                    rows.append((path, *parse_interface(text or ""), None))
                except ValueError as e:
                    rows.append((path, None, None, [], [], str(e)))
            yield pd.DataFrame(rows, columns=["path", "package", "name", "imports", "methods", "error"])

    return files.select("path", "text").mapInPandas(run, INTERFACE)


def stub_subclasses(files: DataFrame) -> DataFrame:
    """(path, package, imports, class_name, reference) of Java classes that extend an interface's ``Stub``; no Python.

    The outer class is no part of the name, and anonymous classes don't count.
    """
    text = F.regexp_replace(F.regexp_replace(F.col("text"), r"(?s)/\*.*?\*/", ""), r"//[^\n]*", "")
    near = files.where(F.contains("text", F.lit(".Stub")) & F.contains("text", F.lit("extends"))).select("path", text.alias("t"))
    pattern = r"\bclass\s+([A-Za-z_][A-Za-z0-9_]*)[^;{}]*?\bextends\s+([A-Za-z_][A-Za-z0-9_$.]*)\.Stub"
    found = lambda group: F.regexp_extract_all("t", F.lit(pattern), F.lit(group))
    rows = near.select(
        "path", F.regexp_extract("t", r"\bpackage\s+([A-Za-z_][A-Za-z0-9_.]*)\s*;", 1).alias("package"),
        F.regexp_extract_all("t", F.lit(r"\bimport\s+([A-Za-z_][A-Za-z0-9_.]*)\s*;"), F.lit(1)).alias("imports"),
        F.explode(F.arrays_zip(found(1).alias("c"), found(2).alias("r"))).alias("x"),
    )
    return rows.select("path", "package", "imports", F.col("x.c").alias("class_name"), F.col("x.r").alias("reference"))
