"""Text and path functions as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.schema import LANGUAGE_FILES, LANGUAGE_SUFFIXES, TEST_PARTS


def squeezed(text: Column) -> Column:
    """White space, Unicode's too, as single spaces, none outside."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def without_comments(text: Column) -> Column:
    """Block and line comments removed, by pattern alone: comment marks in strings count as comments."""
    return F.regexp_replace(F.regexp_replace(text, r"(?s)/\*.*?\*/", ""), r"//[^\n]*", "")


def without_annotations(text: Column) -> Column:
    return F.regexp_replace(text, r"@[A-Za-z_][A-Za-z0-9_.]*(\s*\([^)]*\))?", "")


def simple_name(name: Column) -> Column:
    """What stands behind the last dot, ``$`` read as a dot."""
    return F.element_at(F.split(F.replace(name, F.lit("$"), F.lit(".")), r"\."), -1)


def looks_like_package(name: Column) -> Column:
    """The first character is a lower-case letter."""
    return name.rlike(r"^\p{Ll}")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def path_parts(path: Column) -> Column:
    return F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/")


def is_test_path(path: Column) -> Column:
    """Any part of the path, in lower case, marks tests."""
    return F.arrays_overlap(path_parts(F.lower(path)), F.array(*map(F.lit, TEST_PARTS)))


def glob_pattern(glob: str) -> str:
    """A regular expression for a path that ends with the glob: ``*`` and ``?`` stay within a part."""
    body = "".join("[^/]*" if c == "*" else "[^/]" if c == "?" else re.escape(c) for c in glob.strip("/"))
    return f"(^|/){body}$"


def is_excluded(path: Column, patterns: list[str], prune: bool = True) -> Column:
    """A part of the path equals a pattern, or the path ends with it as a glob.

    ``prune``: a directory that matches takes all below it along. Without it a
    glob such as ``out_*`` only excludes what it names itself.
    """
    if not patterns:
        return F.lit(False)
    hit = F.arrays_overlap(path_parts(path), F.array(*map(F.lit, patterns)))
    for glob in patterns:
        if any(c in glob for c in "*?/"):
            hit = hit | path.rlike(glob_pattern(glob).removesuffix("$") + ("(/|$)" if prune else "$"))
    return hit


def under(path: Column, root: Column) -> Column:
    """The path is the root or below it; ``.`` and the empty root hold all."""
    return root.isin("", ".") | (path == root) | F.startswith(path, F.concat(root, F.lit("/")))


def language(path: Column) -> Column:
    """The language of a file by its name or suffix; null for others."""
    name = file_name(path)
    out = F.lit(None).cast("string")
    for suffix, lang in LANGUAGE_SUFFIXES.items():
        out = F.when(F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1)) == suffix, lang).otherwise(out)
    for whole, lang in LANGUAGE_FILES.items():
        out = F.when(name == whole, lang).otherwise(out)
    return out


def slug(text: Column) -> Column:
    """Letters, digits, ``-`` and ``_`` kept, other characters ``-``, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "-"), r"^-+|-+$", "")


def lines(text: Column) -> Column:
    """The lines without their ends; CR LF, CR and LF end a line, and nothing follows the last end."""
    parts = F.split(text, r"\r\n?|\n")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def line_of(text: Column, offset: Column) -> Column:
    """The line, from 1, of the character at ``offset``, from 0."""
    return F.size(F.split(F.substring(text, F.lit(1), offset), "\n"))


def split_parents(inherits: Column) -> Column:
    """Parent references of a listing's ``inherits``: a string or a JSON list, generics and white space gone."""
    text = F.regexp_replace(inherits, r'^\[|\]$|"', "")
    for _ in range(8):
        text = F.regexp_replace(text, r"<[^<>]*>", "")
    names = F.transform(F.split(F.regexp_replace(text, r"(?U)\s+", ""), ","), lambda x: F.replace(x, F.lit("$"), F.lit(".")))
    return F.filter(names, lambda x: x.rlike(r"^[A-Za-z_][A-Za-z0-9_.]*$"))
