"""Decontamination, and the pipeline stage by stage."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from factloom.llm.decontaminate import contaminated, decontaminate
from factloom.llm.lines import long_lines

SF = "/root/testdata/sf0.001"

ITEM = "If Anna buys 12 apples and gives 5 apples to her brother then how many apples has she left after 3 days of eating one each day"


def hits(spark, texts, items, **options):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in contaminated(docs, bench, **options).collect()}


def test_templates(spark):
    filler = "some words before that mean nothing much. "
    texts = [
        filler + ITEM + ". And more after it.",
        filler + ITEM.replace("12", "31").replace("5 ", "14 ").replace("3 days", "9 days"),
        filler + ITEM.replace("12", "31").replace("5 ", "31 ").replace("3 days", "31 days"),
        filler + ITEM.upper().replace(" ", "!! "),
        filler + " ".join(ITEM.split()[:12]),
        filler + " ".join(reversed(ITEM.split())),
        "",
    ]
    got = hits(spark, texts, [ITEM])
    assert got[(0, 0)] == "verbatim" and got[(1, 0)] == "reparameterised"
    assert (2, 0) not in got  # three values became one: not the same question
    assert not {(4, 0), (5, 0), (6, 0)} & set(got)


def test_names_and_units(spark):
    item = "yesterday afternoon our friend Robert walked 7 miles along the old river road and then Robert rested for two hours"
    other = item.replace("Robert", "Maria").replace("7 miles", "4 km").replace("two", "three")
    mixed = item.replace("Robert walked", "Maria walked")
    assert hits(spark, [item, other, mixed], [item]) == {(0, 0): "verbatim", (1, 0): "reparameterised"}


def test_equal_words_match_whatever_their_templates(spark):
    sums = " ".join(f"{i} + {2 * i} = {3 * i}" for i in range(1, 9))
    names = "Alice Bob Carol David Erin Frank Grace Heidi Ivan Judy Kevin Laura Mallory Niaj Olivia Peggy"
    items = [sums, names, names.upper(), ITEM]
    texts = ["pad " + sums, "pad " + names, names.lower(), "pad " + ITEM.upper().replace(" ", "!! "), "pad " + ITEM.title(), "pad " + sums.replace("1", "9"), "pad " + " ".join(reversed(names.split()))]
    got = hits(spark, texts, items)
    assert set(got) == {(0, 0), (1, 1), (1, 2), (2, 1), (2, 2), (3, 3), (4, 3)} and set(got.values()) == {"verbatim"}
    docs = spark.createDataFrame([(1, "pad " + sums), (2, "clean text")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontaminate(docs, spark.createDataFrame([(1, sums)], "item_id long, text string")).collect()] == [2]


def test_equal_numbers_behind_do_not_undo_a_template_match(spark):
    item = "yesterday our friend Robert walked along the old river road with many happy children and dogs then 1 2 3 4 5 6 Robert 7 8"
    assert hits(spark, [item.replace("Robert walked", "Maria walked")], [item]) == {(0, 0): "reparameterised"}


@pytest.mark.parametrize("marks", [" - ", " & ", " = ", " \u2014 "])
def test_words_of_marks_alone_shift_no_slots(spark, marks):
    item = "yesterday our friend Robert walked 7 miles along the old river road and then Robert rested for two hours"
    other = item.replace("Robert", "Maria").replace("7", "4")
    mixed = item.replace("Robert walked", "Maria walked")
    texts = [f"a{marks}b{marks}c " + t for t in (item, other, mixed)] + [item.replace(" along ", f" {marks} along ")]
    assert hits(spark, texts, [item]) == {(0, 0): "verbatim", (1, 0): "reparameterised", (3, 0): "verbatim"}


def test_placeholders_alone_match_their_very_words_only(spark):
    numbers = " ".join(str(i) for i in range(40))
    other = " ".join(str(i) for i in range(50, 90))
    assert hits(spark, [numbers, other, "so " + " ".join(f"The {i} Bob 9" for i in range(20))], [numbers]) == {(0, 0): "verbatim"}


def test_short_items(spark):
    got = hits(spark, ["before what is the capital town called after", "what is a capital town"], ["what is the capital town called", "town", ""])
    assert got == {(0, 0): "verbatim", (0, 1): "verbatim", (1, 1): "verbatim"}


def test_scripts_without_spaces(spark):
    item = "\u5317\u4eac\u662f\u4e2d\u56fd\u7684\u9996\u90fd\u5417\u8bf7\u56de\u7b54\u8fd9\u4e2a\u95ee\u9898"
    texts = ["\u524d\u8a00" + item + "\u540e\u8a18", item[:9], item.replace("\u5417", "\u7d93"), "plain words " + item]
    assert hits(spark, texts, [item, "\u0e2a\u0e27"]) == {(0, 0): "verbatim", (3, 0): "verbatim"}


def brute_templates(docs, items):
    """Alignments of word lists by the rules themselves, for texts of lower-case words, digits, names and number words."""
    units, numbers = {"miles", "hours", "kg"}, {"two", "seven", "twenty"}

    def template(words):
        out = []
        for k, w in enumerate(words):
            before = words[k - 1] if k else ""
            if w[0].isupper() and k:
                out.append("NAME")
            elif w.isdigit() or w in numbers:
                out.append("NUMBER")
            elif w in units and k and (before.isdigit() or before in numbers):
                out.append("UNIT")
            else:
                out.append(w.lower())
        return out

    found = {}
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            a, b = doc.split(), item.split()
            ta, tb = template(a), template(b)
            for shift in range(-len(b), len(a)):
                windows = [k for k in range(len(b) - 7) if 0 <= k + shift <= len(a) - 8 and ta[k + shift : k + shift + 8] == tb[k : k + 8]]
                places = {k + j for k in windows for j in range(8) if tb[k + j] in ("NAME", "NUMBER", "UNIT")}
                slots = {(tb[k], b[k].lower(), a[k + shift].lower()) for k in places}
                one = len({x[:2] for x in slots}) == len(slots) == len({(x[0], x[2]) for x in slots})
                if windows and len(windows) + 7 >= 13 and one:
                    same = all(x == y for _, x, y in slots)
                    found[d, i] = "verbatim" if same or found.get((d, i)) == "verbatim" else "reparameterised"
    return found


def test_templates_equal_brute_force(spark):
    rng = random.Random(6)
    plain = "the old river road leads along many quiet houses where people often sit and talk about nothing much".split()
    names, numbers, units = ["Anna", "Bob", "Carla", "Dan"], ["3", "14", "159", "two", "seven", "twenty"], ["miles", "hours", "kg"]

    def sentence():
        out = [rng.choice(plain) for _ in range(rng.randint(4, 6))]
        for _ in range(rng.randint(2, 3)):
            out += rng.choice([[rng.choice(names)], [rng.choice(numbers)], [rng.choice(numbers), rng.choice(units)]])
            out += [rng.choice(plain) for _ in range(rng.randint(4, 6))]
        return out

    items = [sentence() for _ in range(12)]
    docs = []
    for _ in range(60):
        words = list(rng.choice(items))
        swap = {w: w for w in names + numbers + units}
        if rng.random() < 0.6:
            for group in (names, numbers, units):
                swap |= dict(zip(group, rng.sample(group, len(group))))
        words = [swap.get(w, w) for w in words]
        if rng.random() < 0.4:
            k = rng.randrange(len(words))
            words[k] = rng.choice(names if words[k] in names else numbers if words[k] in numbers else plain)
        docs.append(" ".join([rng.choice(plain) for _ in range(rng.randint(1, 5))] + words[rng.randint(0, 3) :]))
    texts = [" ".join(x) for x in items]
    assert hits(spark, docs, texts) == brute_templates(docs, texts)


def test_items_full_of_numbers(spark):
    item = "let 1 2 3 4 5 6 7 8 9 10 then twelve plain words make the only windows that can tell something"
    other = item.replace("7", "70")
    assert set(hits(spark, ["pad " + item, other, "let 1 2 3 4 5 6 7 8 9 10 then"], [item])) == {(0, 0), (1, 0)}
    few = "add 1 2 3 4 5 6 7 8 9 10 now and see 11 12 13 14 15"
    assert hits(spark, [few, "pad " + few], [few]) == hits(spark, [few, "pad " + few], [few], literals=3) == {(0, 0): "verbatim", (1, 0): "verbatim"}


def test_items_little_longer_than_a_window(spark):
    item = "what nine words make this short benchmark item complete"
    texts = [" ".join(["pad"] * k + [item] + ["end"] * 9) for k in range(9)]
    assert set(hits(spark, texts, [item, ITEM])) == {(k, 0) for k in range(9)}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, ITEM), (3, ITEM), (3, ITEM), (4, "pad " * 30000 + ITEM), (5, "clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _id", "'h' as hash", "2 as width")
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (None, ITEM)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()}
    assert got == {(3, 1), (4, 1)}
    assert sorted(str(r["doc_id"]) for r in decontaminate(docs, bench).collect()) == ["1", "2", "5", "None"]
    assert contaminated(docs.limit(0), bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0


def brute_leaks(docs, items, run=13):
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    out = set()
    for i, t in items:
        w = words(t)
        n = min(run, len(w))
        parts = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        out |= {(d, i) for d, u in docs if (v := words(u)) and any(tuple(v[k : k + n]) in parts for k in range(len(v) - n + 1))}
    return out


def test_op6(spark):
    from factloom.llm.queries import op6_decontaminate_templates

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert {(r["doc_id"], r["item_id"]) for r in op6_decontaminate_templates(spark, SF).collect()} == brute_leaks(docs, items)


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    plan = contaminated(docs, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.01").write.parquet(f"{folder}/{name}")
        out[name] = docs = spark.read.parquet(f"{folder}/{name}")
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontaminate", "pack"]
    for name in names[:-1]:
        assert stages[name].columns == stages["input"].columns and 0 < stages[name].count() <= stages["input"].count()


def test_quality_keeps_clean_documents(spark, stages):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = labels.join(stages["quality"].select("doc_id").withColumn("kept", F.lit(1)), "doc_id", "left").groupBy("quality").agg((F.count("kept") / F.count("*")).alias("share"))
    share = {r["quality"]: r["share"] for r in kept.collect()}
    assert share[1] > 0.97 and share[0] < 0.2


def test_no_long_line_is_left_twice(stages):
    seen = set()
    for r in stages["line_dedup"].select("text", "n_chars").collect():
        assert r["n_chars"] == len(r["text"])
        for _, s in long_lines(r["text"], 24):
            assert s not in seen
            seen.add(s)
    before = {s for r in stages["quality"].select("text").collect() for _, s in long_lines(r["text"], 24)}
    assert len(before - seen) <= 20  # only lines within two edits of a kept one


def test_documents_of_short_lines_stay(spark):
    line = "a license line that stands in every document"
    rows = [(1, line, 44), (2, f"{line}\nWas orer.", 54), (3, f" \n{line}", 46)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()}
    assert got == {1: (line, 44), 2: ("Was orer.", 9)}


def test_one_of_each_group_stays(stages):
    from factloom.llm.simhash import simhash_groups

    assert corpus_pipeline.WORDS == 5
    groups = simhash_groups(stages["line_dedup"], corpus_pipeline.WORDS, corpus_pipeline.DISTANCE).toPandas()
    assert ids(stages["near_dedup"]) == set(groups["component_id"])


def test_no_leak_is_left(spark, stages):
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("item_id", "text").collect()]
    rows = lambda name: [tuple(r) for r in stages[name].select("doc_id", "text").collect()]
    leaks = {d for d, _ in brute_leaks(rows("near_dedup"), items)}
    assert leaks and ids(stages["decontaminate"]) == ids(stages["near_dedup"]) - leaks


def test_all_that_is_left_is_packed(stages):
    packed = stages["pack"].toPandas()
    assert set(packed["doc_id"]) == ids(stages["decontaminate"])
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048


def test_stages_on_odd_rows(spark):
    """Null ids and texts, repeated rows, columns named as outputs, no n_chars; and empty tables."""
    prose = " ".join(r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id").orderBy("doc_id").limit(3).collect())
    rows = [(1, prose), (1, prose), (None, prose + " and more"), (2, None), (3, ""), (4, "some line of its own\nand another one"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as score", "'r' as removed", "true as held_out", "8 as predicted", "'f' as fp", "'k' as _want")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        got = out.collect()
        assert out.columns == docs.columns and {(r["score"], r["removed"], r["predicted"], r["fp"], r["_want"]) for r in got} <= {(7, "r", 8, "f", "k")}
        assert len(got) <= len(rows) and any(r["doc_id"] is None for r in got) and sum(r["doc_id"] == 1 for r in got) == 2, name
        assert stage(spark, docs.limit(0), SF).count() == 0
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert packed.where("piece = 0").count() == len(rows) and corpus_pipeline.pack(spark, docs.limit(0), SF).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
