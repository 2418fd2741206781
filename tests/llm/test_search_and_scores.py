"""Neighbours, quality, urls and pseudonyms."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import quality
from factloom.llm.neighbours import fit_quantiser, nearest, unit_rows
from factloom.llm.pseudonyms import luhn_digit, permute, permute_characters, pseudonymise, pseudonymise_documents
from factloom.llm.quality import fit_quality, score_quality, term_counts
from factloom.llm.queries import URL_RULES, op3_neighbours_additive, op5_quality_neighbours
from factloom.llm.urls import GlobAutomaton, judge_urls

SF = "/root/testdata/sf0.001"


def brute_nearest(vectors, query, k):
    q = vectors[query] / np.linalg.norm(vectors[query])
    scores = {i: float(v @ q / np.linalg.norm(v)) for i, v in vectors.items() if i != query}
    return sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]


def test_recall_and_scores(spark):
    rows = op3_neighbours_additive(spark, SF).collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    hits = total = 0
    for q in (i for i in vectors if i % 50 == 0):
        own = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        best = brute_nearest(vectors, q, 5)
        assert [r["rank"] for r in own] == list(range(1, len(best) + 1))
        hits, total = hits + len({r["vec_id"] for r in own} & {i for i, _ in best}), total + len(best)
        assert all(abs(r["score"] - float(vectors[r["vec_id"]] @ vectors[q] / np.linalg.norm(vectors[r["vec_id"]]) / np.linalg.norm(vectors[q]))) < 1e-12 for r in own)
    assert hits / total >= 0.9


def test_recall_on_a_larger_table(spark):
    """Ten thousand vectors against all cosines."""
    rows = op3_neighbours_additive(spark, "/root/testdata/sf0.1").toPandas()
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    unit = np.stack(table["embedding"].to_numpy()).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids, hits, total = table["vec_id"].to_numpy(), 0, 0
    for q in np.flatnonzero(ids % 50 == 0):
        cosine = unit @ unit[q]
        cosine[q] = -2
        best = set(ids[np.argsort(-cosine, kind="stable")[:5]].tolist())
        hits, total = hits + len(best & set(rows.loc[rows["query_id"] == ids[q], "vec_id"])), total + 5
    assert len(rows) == total and hits / total >= 0.9


def test_repeated_ids_and_other_lengths(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=4 + 2 * (i % 3 == 0)).astype(np.float32).tolist()) for i in range(90)]
    extra = [data[0], data[0], (1, [9.0, 9.0, 9.0, 9.0]), (2, [-9.0, 9.0, 9.0, 9.0]), data[4]]
    df = spark.createDataFrame(data + extra, "vec_id long, embedding array<float>")
    one = {}
    for i, v in data + extra:
        one[i] = min(one.get(i, v), v)
    for waves in (16384, 3):
        got = nearest(df, F.col("vec_id") % 5 == 0, 5, query_block=waves).toPandas()
        for q in range(0, 90, 5):
            same = {i: np.array(v) for i, v in one.items() if len(v) == len(one[q])}
            own = got[got["query_id"] == q].sort_values("rank")
            assert own["vec_id"].tolist() == [i for i, _ in brute_nearest(same, q, 5)] and own["rank"].tolist() == [1, 2, 3, 4, 5]


def test_neighbours_of_odd_vectors(spark):
    data = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (10, [-1.0, 0.5])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as v")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 6)) for r in nearest(df, F.col("vec_id").isin(0, 3, 4), 5).collect()}
    assert got == {(0, 1): (1, 1.0), (0, 2): (2, 1.0), (0, 3): (10, round(-1 / np.sqrt(1.25), 6))}
    assert nearest(df.limit(0), F.lit(True)).count() == 0 and nearest(df.where("vec_id = 0"), F.lit(True)).count() == 0


def test_a_crowd_is_ranked_exactly(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=16)
    vectors = {i: (base + 0.01 * rng.normal(size=16) if i % 2 else rng.normal(size=16)).astype(np.float32) for i in range(1200)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>")
    found = nearest(df, F.col("vec_id") % 101 == 1, 5, block=500, query_block=4).collect()
    exact = {i: v.astype(float) for i, v in vectors.items()}
    queries = {r["query_id"] for r in found}
    assert sum({r["vec_id"] for r in found if r["query_id"] == q} == {i for i, _ in brute_nearest(exact, q, 5)} for q in queries) >= 0.9 * len(queries)


def test_beam_is_no_worse_than_greedy():
    x = unit_rows(np.random.default_rng(0).normal(size=(400, 16)).astype(np.float32))
    model = fit_quantiser(x, stages=4, entries=16)
    error = lambda beam: ((x - type(model)(model.books, beam).encode(x)[1]) ** 2).sum()
    codes, sums = model.encode(x)
    assert np.allclose(sums, model.books[np.arange(4), codes].sum(axis=1), atol=1e-5) and error(8) <= error(1)


def test_quality_on_the_held_out_fold(spark):
    got = op5_quality_neighbours(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.95 and got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()


def test_quality_of_odd_rows(spark):
    good, bad = "the quick brown fox jumps over a lazy dog and runs away ", "BUY!! $$$ NOW!! *** "
    docs = spark.createDataFrame([(i, (good if i % 2 else bad) * (1 + i % 3)) for i in range(60)] + [(100, None), (101, ""), (102, "x"), (None, good), (103, good * 20000), (103, good)], "doc_id long, text string").selectExpr("*", "'y' as score", "0 as _score")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    model = fit_quality(docs, labels)
    got = {(r["doc_id"], len(r["text"] or "")): r for r in score_quality(docs, model).collect()}
    assert got[(100, 0)]["score"] == got[(101, 0)]["score"] == got[(102, 1)]["score"] == model.prior
    assert got[(103, len(good) * 20000)]["predicted"] == 1 and got[(2, len(bad) * 3)]["predicted"] == 0 and got[(None, len(good))]["held_out"]
    assert len(got) == 66 and score_quality(docs.limit(0), model).count() == 0
    empty = fit_quality(docs, labels.limit(0))
    assert {r["score"] for r in score_quality(docs, empty).collect()} == {0.5}
    assert len(term_counts("")) == len(term_counts("abc"))


def glob_regex(glob):
    return re.compile("".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in re.split(r"(\*\*|\*)", glob)), re.S)


def test_automaton_equals_regular_expressions():
    rng = random.Random(3)
    for _ in range(40):
        globs = ["".join(rng.choice(["a", "b", "/", ".", "*", "**", "é"]) for _ in range(rng.randint(0, 9))) for _ in range(30)]
        globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
        texts = ["".join(rng.choice("ab/.é") for _ in range(rng.randint(0, 12))) for _ in range(40)]
        got = GlobAutomaton(globs).matches([t.encode() for t in texts])
        assert [[bool(glob_regex(g).fullmatch(t)) for g in globs] for t in texts] == got.tolist()
    assert GlobAutomaton([]).matches([b"x"]).shape == (1, 0) and GlobAutomaton(["a"]).matches([]).shape == (0, 1)


def test_urls(spark):
    urls = ["https://www.example.com/en/1", "http://a.www.example.com/en/?q", "http://A.Example.COM/en/x", "http://example.com/de/", "http://example.com/EN/", "http://net/es/", "http://xnet/es/", "http://a.net/fr/#t", "http://com", "http://evil.org/.com/", "com/x", None, "", "http://com/" + "a" * 50000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'h' as host", "1 as _won")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(df, URL_RULES).collect()}
    assert got == {0: ("www.example.com/en/", "allow"), 1: ("www.example.com/en/", "allow"), 2: ("example.com/en/", "block"), 3: ("com/", "allow"), 4: ("com/", "allow"), 5: ("net/es/", "block"), 6: (None, "allow"), 7: ("net/fr/", "block"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"), 12: (None, "allow"), 13: ("com/", "allow")}
    assert judge_urls(df.limit(0), URL_RULES).count() == 0 and judge_urls(df, [], "block").where("verdict = 'block' and rule is null").count() == len(urls)


KEY = b"test key"


def test_permutations_are_bijections():
    for size in (1, 2, 3, 10, 97, 1000):
        image = [permute(i, size, KEY, "t") for i in range(size)]
        assert sorted(image) == list(range(size)) and [permute(i, size, KEY, "t", True) for i in image] == list(range(size))
    assert permute_characters(permute_characters("aB-9é", KEY, "x"), KEY, "x", True) == "aB-9é"
    assert [permute(5, 1000, k, "t") for k in (b"a", b"b")] != [5, 5]


def test_pseudonyms_keep_formats_and_links():
    card = "4" + "0" * 14
    card += luhn_digit(card)
    text = f"mail ann.9@mail1.example.com or +1 (743) 555-3824, card {card}!!! bad 4000000000000003 ip 10.2.3.4, 999.1.1.1 born 1990-02-28, 31.12.1999, 2020-02-30, ssn 123-45-6789 iban GB82 WEST 1234 5698 7654 32 v2.0. token = \"0f1e2d3c4b5a69788796a5b4c3d2e1f00f1e2d3c\""
    new, found = pseudonymise(text, KEY)
    kinds = sorted(k for k, _, _ in found)
    assert kinds == ["card", "date", "date", "email", "iban", "ip", "phone", "secret", "ssn"]
    for _, a, b in found:
        assert text[a:b] not in new
    assert re.sub(r"[A-Za-z0-9]", "x", new).replace("x", "") == re.sub(r"[A-Za-z0-9]", "x", text).replace("x", "")
    assert "bad 4000000000000003 ip" in new and "999.1.1.1" in new and "2020-02-30" in new and new.endswith('"') and "v2.0." in new
    other = re.search(r"card ([0-9]{16})", new)[1]
    assert luhn_digit(other[:-1]) == other[-1] and pseudonymise(f"again {card}", KEY)[0] == f"again {other}"
    assert pseudonymise(new, KEY, inverse=True)[0] == text


def test_values_beside_other_numbers_and_words():
    card, iban = "4111 1111 1111 1111", "DE89370400440532013000"
    for text, value in [(f"{card} 05/27", card), (f"{card} 123", card), (f"2024 {card}", card), (f"pay {iban} EUR 250", iban), (f"{iban} TO BANK", iban), (f"1234 5678 9012 34 {card} 99", card)]:
        new, found = pseudonymise(text, KEY)
        assert [text[a:b] for _, a, b in found] == [value] and value not in new and pseudonymise(new, KEY, inverse=True)[0] == text
    new, found = pseudonymise(f"{card} 5500 0000 0000 0004", KEY)
    assert len(found) == 2 and pseudonymise("4111 1111 1111 1112 05/27", KEY)[1] == []


def test_links_do_not_depend_on_the_format():
    only = lambda text: [re.sub(r"[^0-9A-Za-z]", "", pseudonymise(text, KEY)[0][a:b]) for _, a, b in pseudonymise(text, KEY)[1]]
    for a, b in [("+1 743 555 3824", "+17435553824"), ("+44 20 7946 0958", "+442079460958"), ("4111 1111 1111 1111", "4111-1111-1111-1111"), ("DE89 3704 0044 0532 0130 00", "DE89370400440532013000")]:
        assert only(a) == only(b) and len(only(a)) == 1 and only(a) != [re.sub(r"[^0-9A-Za-z]", "", a)], (a, b)
    assert only("+1 743 555 3824")[0] == "1" + only("call (743) 555-3824")[0] == "1" + only("743.555.3824")[0]
    parts = lambda text: sorted(re.findall(r"\d+", pseudonymise(text, KEY)[0]))
    assert parts("1990-02-28") == parts("28.02.1990") == parts("02/28/1990") != ["02", "1990", "28"] and parts("1990-02-03") == parts("03.02.1990")
    assert pseudonymise("Ann.Lee@Mail.example.com", KEY)[0].lower() == pseudonymise("ann.lee@mail.example.com", KEY)[0]
    for text in ("password: abcdefghijklmnopqrst", "API_KEY = 'ABCDefghIJKLmnopqrst'"):
        assert len(pseudonymise(text, KEY)[1]) == 1 and pseudonymise(pseudonymise(text, KEY)[0], KEY, True)[0] == text


def test_pseudonyms_can_be_undone_in_any_format():
    rng = random.Random(12)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    for _ in range(400):
        y, m, d = rng.randint(1900, 2099), rng.randint(1, 12), rng.randint(1, 28)
        text = rng.choice([f"{y}-{m:02}-{d:02}", f"{d:02}.{m:02}.{y}", f"{m:02}/{d:02}/{y}", f"+{digits(rng.randint(10, 13))}", f"+{rng.randint(1, 999)} {digits(3)} {digits(4)} {digits(2)}", f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{digits(4)}", f"Mr.{rng.choice(['Bob', 'eVe'])}@Ex.com"])
        new, found = pseudonymise(f"see {text}, ok", KEY)
        assert pseudonymise(new, KEY, inverse=True)[0] == f"see {text}, ok" and len(new) == len(text) + 8
        assert found or text[0] == "+"


def test_a_corpus_is_undone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    done = pseudonymise_documents(docs, KEY)
    back = pseudonymise_documents(done.select("doc_id", "text"), KEY, inverse=True)
    assert back.select("doc_id", "text").exceptAll(docs).count() == 0 and done.where("size(found) > 0").count() > 0


def test_pseudonymised_documents(spark):
    rows = [(1, "call +1 (743) 555-3824"), (1, "call +1 (743) 555-3824"), (2, None), (3, ""), (None, "clean text"), (4, "x " * 60000 + "10.0.0.1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as found", "'m' as _made")
    got = pseudonymise_documents(df, KEY).collect()
    by = {(r["doc_id"], r["text"]): r for r in got}
    assert len(got) == 6 and len({r["text"] for r in got if r["doc_id"] == 1}) == 1 and by[(2, None)]["found"] == [] and (3, "") in by and by[(None, "clean text")]["_made"] == "m"
    assert next(r for r in got if r["doc_id"] == 4)["found"][0]["start"] == 120000
    assert pseudonymise_documents(df.limit(0), KEY).count() == 0
    with pytest.raises(ValueError):
        pseudonymise_documents(df, b"")


def test_fit_holds_little_at_a_time():
    import tracemalloc

    rng = np.random.default_rng(5)
    counts = np.log1p(rng.poisson(0.3, (4000, quality.TERMS + quality.SHAPES))).astype(np.float16)
    labels = (rng.random(4000) < 0.5).astype(float)
    tracemalloc.start()
    model = quality.learnt(counts, labels, 48)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90e6 and model.vectors.shape == (4000, 48)


@pytest.mark.parametrize("rows", [1, 3, 40, 400])
def test_leading_vectors_equal_the_whole_decomposition(rows):
    wide = np.random.default_rng(rows).standard_normal((rows, 300)) * np.linspace(3, 0.1, 300)
    square, n = wide.T @ wide, min(20, rows)
    values, vectors = np.linalg.eigh(square)
    got = quality.leading(square, n)
    assert np.allclose(got.T @ got, np.eye(n)) and np.allclose(got @ got.T, vectors[:, ::-1][:, :n] @ vectors[:, ::-1][:, :n].T, atol=1e-4)
