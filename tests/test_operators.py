"""Matching, closure, hashes and text functions on small inputs."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from factloom.functions import text as tx
from factloom.functions.ids import Raw, canonical_json, edge_id, merged_json
from factloom.graph import first_wins, last_wins
from factloom.operators import match
from factloom.operators.closure import closure, closure_sql, resolve_chain


def pairs(spark, *edges):
    return spark.createDataFrame(list(edges), "from_node_id string, to_node_id string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_closure_of_loops_and_diamonds(spark):
    assert rows(closure(pairs(spark, ("a", "a")))) == [("a", "a", 1)]
    assert rows(closure(pairs(spark, ("a", "b"), ("b", "a")))) == [("a", "b", 1), ("b", "a", 1)]
    diamond = pairs(spark, ("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"))
    assert rows(closure(diamond)).count(("a", "d", 2)) == 2
    assert rows(closure(diamond, distinct_pairs=True)).count(("a", "d", 2)) == 1
    assert rows(closure(diamond)) == rows(closure_sql(spark, diamond))


def test_closure_depth(spark):
    chain = pairs(spark, *[(f"n{i:02}", f"n{i + 1:02}") for i in range(25)])
    assert max(r[2] for r in closure(chain).collect()) == 20 and closure(chain).count() == sum(min(25 - i, 20) for i in range(25))


def test_recursive_query_of_more_rows_than_the_limit(spark):
    chain, limit = pairs(spark, *[(f"n{i:02}", f"n{i + 1:02}") for i in range(60)]), "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(limit)
    spark.conf.set(limit, 100)
    try:
        assert rows(closure_sql(spark, chain)) == rows(closure(chain))
    finally:
        spark.conf.set(limit, old)


def test_substring_guard(spark):
    edges = pairs(spark, ("X:a.Bc", "X:q"), ("X:q", "X:a.B"))
    assert ("X:a.Bc", "X:a.B", 2) in rows(closure(edges)) and ("X:a.Bc", "X:a.B", 2) not in rows(closure(edges, guard="substring"))
    with pytest.raises(ValueError):
        closure(edges, guard="other")


def test_chain(spark):
    data = [("a", None, "b"), ("b", None, "c"), ("c", "v", None), ("x", None, "y"), ("y", None, "x"), ("z", None, "gone"), ("s", None, "s"), ("n", None, None)]
    got = dict(rows(resolve_chain(spark.createDataFrame(data, "id string, value string, next string"))))
    assert got == {"a": "v", "b": "v", "c": "v", "x": None, "y": None, "z": None, "s": None, "n": None}
    long = [(str(i), None, str(i + 1)) for i in range(12)] + [("12", "end", None)]
    got = dict(rows(resolve_chain(spark.createDataFrame(long, "id string, value string, next string"))))
    assert got["2"] == "end" and got["1"] is None


def test_asof(spark):
    left = spark.createDataFrame([("f", 1), ("f", 5), ("f", 9), ("g", 1), ("f", None)], "path string, line long")
    right = spark.createDataFrame([("f", 5, "m1"), ("f", 5, "m2"), ("f", 7, "m3"), ("f", None, "m4")], "path string, line long, method string")
    assert rows(match.asof(left, right, "path", "line", "method")) == sorted([("f", 1, None), ("f", 5, "m2"), ("f", 9, "m3"), ("g", 1, None), ("f", None, None)], key=str)
    assert rows(match.asof(left, right, "path", "line", "method", forward=True)) == sorted([("f", 1, "m1"), ("f", 5, "m1"), ("f", 9, None), ("g", 1, None), ("f", None, None)], key=str)


def test_longest_prefix(spark):
    paths = spark.createDataFrame([("vendor/a/x",), ("vendor/ab/x",), ("vendor/a/b/x",), ("vendor/a",), ("other",), (None,)], "p string")
    prefixes = spark.createDataFrame([("vendor/a", 1), ("vendor/a/b/", 2), ("vendor", 3)], "prefix string, n int")
    got = dict(map(tuple, match.longest_prefix(paths, prefixes, "p", "prefix", "n").collect()))
    assert got == {"vendor/a/x": 1, "vendor/ab/x": 3, "vendor/a/b/x": 2, "vendor/a": 1, "other": None, None: None}


def test_innermost(spark):
    ranges = spark.createDataFrame([("f", 0, 100, "A"), ("f", 10, 50, "A.B"), ("f", 60, 90, "A.C")], "path string, s int, e int, q string")
    points = spark.createDataFrame([("f", 5), ("f", 20), ("f", 10), ("f", 50), ("f", 100), ("g", 1)], "path string, at int")
    assert {r["at"]: r["q"] for r in match.innermost(points.where("path = 'f'"), ranges, "path", "at", "s", "e", "q").collect()} == {5: "A", 20: "A.B", 10: "A", 50: "A", 100: None}


def test_unique_and_first(spark):
    df = spark.createDataFrame([("k", "a"), ("k", "a"), ("l", "a"), ("l", "b")], "k string, v string")
    assert dict(rows(match.unique_or_null(df, "k", "v"))) == {"k": "a", "l": None}
    seq = spark.createDataFrame([("k", 2, "x"), ("k", 1, "y"), ("k", 3, None)], "k string, n int, v string")
    assert last_wins(seq, "k", "n").first()["v"] is None and first_wins(seq, "k", "n").first()["v"] == "y"


def test_hashes_and_json(spark):
    row = spark.createDataFrame([("E", "a", "b", None, 0, 'q"é', None)], "t string, f string, o string, p string, l int, s string, n string")
    c = F.col
    got = row.select(edge_id(c("t"), c("f"), c("o"), c("p"), c("l")).alias("e"), canonical_json(b=c("s"), a=c("n"), c=Raw(F.lit("true"))).alias("j"), canonical_json(False, b=c("s")).alias("k")).first()
    assert got["e"] == hashlib.sha256(b"E|a|b||").hexdigest()
    assert got["j"] == json.dumps({"a": None, "b": 'q"é', "c": True}, sort_keys=True, ensure_ascii=False) and got["k"] == '{"b":"q\\"é"}'
    merged = spark.createDataFrame([('{"z": null, "b": "x", "n": true}',), ("{}",), (None,)], "j string").select(merged_json(c("j"), b=F.lit("y"), a=F.lit(None).cast("string")).alias("m"))
    assert [r["m"] for r in merged.collect()] == ['{"a": null, "b": "y", "n": true, "z": null}', '{"a": null, "b": "y"}', '{"a": null, "b": "y"}']


def test_text(spark):
    def one(column, **values):
        return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]

    c = F.col("s")
    assert one(tx.lines(c), s="a\r\nb\rc\n\nd\n") == ["a", "b", "c", "", "d"] and one(tx.lines(c), s="") == []
    assert one(tx.squeezed(c), s=" a b \n c ") == "a b c"
    assert one(tx.split_parents(c), s="Base<T>, First, Comparable<Child<T>>") == ["Base", "First", "Comparable"]
    assert one(tx.split_parents(c), s='["A$B","C d","x-y"]') == ["A.B", "Cd"]
    assert one(tx.slug(c), s="a/b c-é_") == "a-b-c-é_"
    assert one(tx.language(c), s="x/Android.mk") == "make" and one(tx.language(c), s="x/A.JAVA") == "java" and one(tx.language(c), s="README") is None
    assert one(tx.is_excluded(c, ["out_*", "tests"]), s="out_x/a.java") and not one(tx.is_excluded(c, ["out_*"], prune=False), s="out_x/a.java")
    assert one(tx.is_test_path(c), s="a/Tests/b") and not one(tx.is_test_path(c), s="a/latest/b")
    assert one(tx.without_comments(c), s="a/* x\n*/b// c\nd") == "ab\nd"
    assert one(tx.simple_name(c), s="a.b$C") == "C" and one(tx.line_of(c, F.lit(3)), s="a\nb\nc") == 2
    assert one(tx.under(c, F.lit("a/b")), s="a/b/c") and not one(tx.under(c, F.lit("a/b")), s="a/bc")


def test_classes_by_name_and_tail(spark):
    from factloom.operators.extract import resolve_classes

    names = ["a.Stub", "b.Stub", "b.In.Stub", "c.In.Stub", "a.Only", "Bare"]
    rows = [(f"JAVA_CLASS:{n}", "JAVA_CLASS", n, n.rsplit(".", 1)[-1]) for n in names] + [("JAVA_ENUM:z.Kind", "JAVA_ENUM", "z.Kind", "Kind")]
    nodes = spark.createDataFrame(rows, "node_id string, node_type string, qualified_name string, display_name string")
    guesses = spark.createDataFrame([("a.Stub",), ("Stub",), ("In.Stub",), ("x.Only",), ("b.In.Stub",), ("Bare",), ("Kind",), (None,), ("",)], "guess string")
    found = {r["guess"]: r["instance_type"] for r in resolve_classes(guesses, nodes).collect()}
    # x.Only is no class, but only one class is named Only; In.Stub is the tail of two, Stub the name of four.
    assert found == {"a.Stub": "a.Stub", "x.Only": "a.Only", "b.In.Stub": "b.In.Stub", "Bare": "Bare"}
    more = nodes.where("qualified_name != 'c.In.Stub'")
    assert {r["guess"]: r["instance_type"] for r in resolve_classes(guesses, more).collect()}["In.Stub"] == "b.In.Stub"
