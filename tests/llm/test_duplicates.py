"""SimHash groups, line dedup, repeated passages and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from factloom.llm import simhash
from factloom.llm.components import connected_components
from factloom.llm.lines import dedup_lines, join_keys, line_forest, long_lines, sketches, verified, within_edits
from factloom.llm.queries import op4_repeats_suffix_array, op9_line_dedup_segments, op10_simhash_pigeonhole
from factloom.llm.suffixes import gram_hashes, repeated_passages, word_hashes

SF = "/root/testdata/sf0.001"


def brute_components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7), (500, 501), (501, 500)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    edges_ = [e for e in edges if e[0] != e[1]]
    expected = brute_components({x for e in edges_ for x in e}, edges_)
    assert dict(map(tuple, connected_components(df).collect())) == expected
    assert connected_components(df.limit(0)).count() == 0


def contract_fingerprint(text, n=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for t in ("", None, "  \t\n", "one", "A b C", "Ünïcode words HERE and There\x0bagain\x85x", "the cat sat on the mat " * 40, "a b c d"):
        assert simhash.fingerprint(t or "", 4) % (1 << 64) == contract_fingerprint(t)


def brute_groups(ids, fps, distance):
    first = {}
    for i, f in zip(ids, fps):
        first[f] = i if f not in first else min(first[f], i)
    values = np.array(list(first), np.uint64)
    edges = [(int(a), int(b)) for k, a in enumerate(values) for b in values[k + 1 :][np.bitwise_count(values[k + 1 :] ^ a) <= distance]]
    of = brute_components({int(v) for v in values}, edges)
    least = {}
    for v, root in of.items():
        least[root] = min(least.get(root, 1 << 62), first[v])
    return [least[of[f]] for f in fps]


def test_op10(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [contract_fingerprint(r["text"]) for r in docs]
    groups = brute_groups([r["doc_id"] for r in docs], fps, 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op10_simhash_pigeonhole(spark, SF).collect()}
    assert got == {r["doc_id"]: (f"{f:016x}", g) for r, f, g in zip(docs, fps, groups)}


def near_values(rng, centres, each, flips):
    out = set()
    for _ in range(centres):
        base = rng.getrandbits(64)
        out |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(each)}
    return sorted(out)


def test_links_connect_what_brute_force_does(spark):
    """Also with a crowd in one probe, dealt into blocks."""
    values = near_values(random.Random(6), 40, 12, 5) + near_values(random.Random(7), 1, 900, 6)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    a = np.array(values, np.uint64)
    edges = [(signed[i], signed[j]) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4) if j > i]
    expected = brute_components(signed, edges)
    for block in (4096, 64):
        links = simhash.hamming_links(df, 4, block)
        found = [tuple(r) for r in links.collect()]
        assert brute_components(signed, found) == expected
        assert all(((x ^ y) & (1 << 64) - 1).bit_count() <= 4 for x, y in found)


def test_links_with_blanked_bits(spark, monkeypatch):
    """Thresholds above 0, unequal, with a part that is not probed at all."""
    values = near_values(random.Random(8), 60, 10, 4)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    a = np.array(values, np.uint64)
    edges = [(signed[i], signed[j]) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4) if j > i]
    parts = [list(range(0, 30)), list(range(30, 50)), list(range(50, 58))]
    for thresholds in ((2, 1), (1, 1, 0)):
        monkeypatch.setattr(simhash, "plan_parts", lambda *_, t=thresholds: list(zip(parts, t)))
        found = [tuple(r) for r in simhash.hamming_links(df, 4, 64).collect()]
        assert sum(t + 1 for t in thresholds) == 5 and brute_components(signed, found) == brute_components(signed, edges)


def test_plans_obey_the_pigeonhole():
    rng = np.random.default_rng(1)
    bits = (rng.random((2000, 64)) < rng.random(64)).astype(float)
    bits[:, 1] = bits[:, 0]
    for n in (10, 10**5, 10**9):
        plan = simhash.plan_parts(n, bits.T @ bits * n / 2000, 4)
        assert sum(t + 1 for _, t in plan) == 5 and len({b for x, _ in plan for b in x}) == sum(len(x) for x, _ in plan)
    groups = simhash.grouped_bits(2000, bits.T @ bits, 4)
    assert any({0, 1} <= set(g) for g in groups) and sorted(sum(groups, [])) == list(range(64))


def test_groups_of_odd_rows(spark):
    rows = [(5, ""), (3, None), (4, " \n"), (7, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (9, "word " * 30000), (None, "lonely text that nobody else has at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "'r' as component_id")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (4, 3), (7, 7), (7, 7), (None, 7), (9, 9), (None, None)], key=str)
    assert simhash.simhash_groups(df.limit(0)).count() == 0


def test_edit_check():
    rng = random.Random(8)
    pairs = []
    for _ in range(800):
        a = "".join(rng.choice("abé🎉") for _ in range(rng.randint(0, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k, kind = rng.randint(0, len(b)), rng.random()
            b[k : k + (kind > 0.3)] = rng.choice("abé") if kind < 0.7 else ""
        pairs.append((a, "".join(b)))
    for edits in (1, 2, 3, 5):
        assert within_edits(pairs, edits).tolist() == [edit_distance(a, b) <= edits for a, b in pairs] == verified(pairs, edits).tolist()


def test_forests_connect_what_brute_force_does():
    rng = random.Random(3)
    for _ in range(20):
        bases = ["".join(rng.choice("abcdef") for _ in range(40)) for _ in range(3)]
        lines = set()
        for _ in range(60):
            b = list(rng.choice(bases))
            for _ in range(rng.randint(0, 5)):
                b[rng.randrange(len(b))] = rng.choice("xyz")
            lines.add("".join(b))
        lines = sorted(lines)
        links = list(line_forest(np.arange(len(lines)), lines, 2))
        expected = brute_components(range(len(lines)), [(i, j) for i in range(len(lines)) for j in range(i) if edit_distance(lines[i], lines[j]) <= 2])
        assert brute_components(range(len(lines)), links) == expected and len(links) == len(lines) - len(set(expected.values()))


def test_probes_meet_segments_and_sketches_bound_edits():
    rng = random.Random(9)
    for edits in (1, 2, 3):
        for _ in range(300):
            a = "".join(rng.choice("abc") for _ in range(rng.randint(12, 30)))
            b = list(a)
            for _ in range(edits):
                k, kind = rng.randint(0, len(b) - 1), rng.random()
                b[k : k + (kind > 0.3)] = rng.choice("abc") if kind < 0.7 else ""
            short, long = sorted((a, "".join(b)), key=len)
            key, own, asks, _ = join_keys([short, long], edits, 1)
            assert set(key[(own == 0) & ~asks].tolist()) & set(key[(own == 1) & asks].tolist())
            x, y = sketches([short, long])
            assert ((int(x) ^ int(y)) & (1 << 64) - 1).bit_count() <= 4 * edits


def brute_removed(docs, edits, least):
    lines = sorted((d, i, s) for d, t in docs for i, s in long_lines(t or "", least))
    distinct = sorted({s for *_, s in lines})
    close = [(a, b) for k, a in enumerate(distinct) for b in distinct[k + 1 :] if abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits]
    of, first, gone = brute_components(distinct, close), {}, {}
    for d, i, s in lines:
        if of[s] in first:
            gone.setdefault(d, []).append(i)
        first.setdefault(of[s], (d, i))
    return gone


def varied_lines(seed, n):
    rng, out = random.Random(seed), []
    bases = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(24, 40))).strip() + "x" * 6 for _ in range(12)]
    for d in range(n):
        lines = []
        for _ in range(rng.randint(0, 6)):
            b = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                b[rng.randint(0, len(b) - 1)] = rng.choice("abcxyz")
            lines.append("".join(b) if rng.random() < 0.8 else "short")
        out.append((d, "\n".join(lines)))
    return out


def test_lines_equal_brute_force(spark):
    for seed, block in ((1, 4096), (2, 8)):
        docs = varied_lines(seed, 60)
        df = spark.createDataFrame(docs, "doc_id long, text string")
        import factloom.llm.lines as module

        saved = module.edit_links.__defaults__
        module.edit_links.__defaults__ = (block,)  # small blocks: crowded keys are dealt out
        try:
            got = dedup_lines(df).collect()
        finally:
            module.edit_links.__defaults__ = saved
        gone = brute_removed(docs, 2, 24)
        texts = dict(docs)
        assert {r["doc_id"]: list(r["removed"]) for r in got if r["removed"]} == gone
        assert all(r["text"] == "\n".join(x for i, x in enumerate(texts[r["doc_id"]].split("\n")) if i not in gone.get(r["doc_id"], [])) for r in got)


def test_crowds_of_lines_equal_brute_force(spark, monkeypatch):
    """Also where groups give members instead of pairs, crowded keys leave early and forests meet in blocks."""
    import factloom.llm.lines as module

    docs = varied_lines(5, 80) + [(1000 + i, f"a line that many documents vary a bit, by number {i:03d}") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    gone = brute_removed(docs, 2, 24)
    for few, block, room in ((2, 4096, 1 << 22), (2, 6, 40)):
        monkeypatch.setattr(module, "FEW", few)
        monkeypatch.setattr(module, "ROOM", room)
        monkeypatch.setattr(module.edit_links, "__defaults__", (block,))
        assert {r["doc_id"]: list(r["removed"]) for r in dedup_lines(df).collect() if r["removed"]} == gone


def test_op9_equals_brute_force(spark):
    """The edit join over a whole table: pairs of neighbouring lengths whose character counts are close, then edits."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    lines = sorted((d, i, s) for d, t in docs for i, s in long_lines(t or "", 1))
    distinct = sorted({s for *_, s in lines if len(s) >= 24}, key=len)
    size, edges = np.array([len(s) for s in distinct]), []
    counts = np.zeros((len(distinct), 128), np.int32)
    for k, s in enumerate(distinct):
        np.add.at(counts[k], np.array([ord(c) % 128 for c in s]), 1)
    for k in range(len(distinct)):
        last = int(np.searchsorted(size, size[k] + 2, "right"))
        for j in k + 1 + np.flatnonzero(np.abs(counts[k + 1 : last] - counts[k]).sum(axis=1) <= 4):
            if edit_distance(distinct[k], distinct[j]) <= 2:
                edges.append((distinct[k], distinct[j]))
    of, first, gone = brute_components({s for *_, s in lines}, edges), {}, {}
    for d, i, s in lines:
        if of[s] in first:
            gone.setdefault(d, []).append(i)
        first.setdefault(of[s], (d, i))
    got = {r["doc_id"]: (r["text"], list(r["removed"])) for r in op9_line_dedup_segments(spark, SF).collect()}
    assert {d: x for d, (_, x) in got.items() if x} == gone and len(got) == len(docs)


def test_op9_on_real_lines(spark):
    """Exact copies on the whole table; the edit join is compared above."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    seen, exact = set(), {}
    for d, i, s in sorted((d, i, s) for d, t in docs for i, s in long_lines(t or "", 24)):
        if s in seen:
            exact.setdefault(d, set()).add(i)
        seen.add(s)
    got = {r["doc_id"]: set(r["removed"]) for r in op9_line_dedup_segments(spark, SF).collect()}
    assert len(got) == len(docs) and all(v <= got[d] for d, v in exact.items())


def test_equal_short_lines_go_too(spark):
    rows = [(1, "All rights reserved.\n\nab"), (2, "own\n  All rights reserved. \n\nab"), (3, "All rights reserved!")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), least_equal=1).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: rows[0][1], 2: "own\n", 3: rows[2][1]}
    seen, exact = set(), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    for d, i, s in sorted((d, i, s) for d, t in docs for i, s in long_lines(t or "", 1)):
        if s in seen:
            exact.setdefault(d, set()).add(i)
        seen.add(s)
    removed = {r["doc_id"]: set(r["removed"]) for r in op9_line_dedup_segments(spark, SF).collect()}
    assert all(v <= removed[d] for d, v in exact.items())


def test_lines_of_odd_rows(spark):
    line = "this line has more than twenty-four characters"
    rows = [(1, f"  {line}\r\nshort\n\n{line}"), (2, None), (3, ""), (None, line), (4, f"{line}!!"), (4, f"{line}!!"), (5, "word " * 40000), (6, line[:-3] + "abc")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as removed", "'l' as line", "1 as _gone_")
    got = sorted(((r["doc_id"], r["text"], tuple(r["removed"])) for r in dedup_lines(df).collect()), key=str)
    expected = [(1, f"  {line}\r\nshort\n", (3,)), (2, None, ()), (3, "", ()), (None, line, ()), (4, "", (0,)), (4, "", (0,)), (5, "word " * 40000, ()), (6, line[:-3] + "abc", ())]
    assert got == sorted(expected, key=str) and dedup_lines(df.limit(0)).count() == 0


def brute_passages(docs, least):
    where, out = {}, set()
    words = {d: (t or "").split() for d, t in docs}
    for d, w in words.items():
        for i in range(len(w) - least + 1):
            where.setdefault(tuple(w[i : i + least]), set()).add(d)
    for d, w in words.items():
        starts = [i for i in range(len(w) - least + 1) if len(where[tuple(w[i : i + least])]) > 1]
        for i in starts:
            if i - 1 not in starts:
                last = i
                while last + 1 in starts:
                    last += 1
                out.add((d, i, last - i + least))
    return out


def passages(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 40))
    shared = [[word() for _ in range(rng.randint(30, 90))] for _ in range(6)]
    docs = []
    for d in range(n):
        w = []
        for _ in range(rng.randint(1, 4)):
            w += [word() for _ in range(rng.randint(0, 40))]
            part = list(rng.choice(shared))
            if rng.random() < 0.4:
                part[rng.randint(0, len(part) - 1)] = word()
            w += part[rng.randint(0, 15) :]
        docs.append((d, " ".join(w)))
    return docs


def test_passages_equal_brute_force(spark):
    docs = passages(3, 60) + [(100, "same " * 120), (101, "same " * 90), (102, "lone " * 200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = repeated_passages(df).collect()
    assert {(r["doc_id"], r["start"], r["n_words"]) for r in got} == brute_passages(docs, 50)
    assert all(r["other_id"] != r["doc_id"] for r in got)


def test_heads_in_pieces(spark):
    """A head that many texts share is sorted in pieces, which find each other's windows."""
    docs = passages(4, 60) + [(200 + i, f"own{i} " * (i % 7) + " ".join(f"w{k}" for k in range(60)) + f" end{i % 5}") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r["doc_id"], r["start"], r["n_words"]) for r in repeated_passages(df, piece=3).collect()} == brute_passages(docs, 50)


def test_copies_and_repeated_ids(spark):
    """Equal texts are whole passages; texts of one id don't repeat each other, but may repeat another's."""
    shared, lone = " ".join(f"w{k}" for k in range(60)), " ".join(f"z{k}" for k in range(55))
    rows = [(1, shared), (2, shared), (3, "a b " + shared + " c"), (4, lone), (4, "x " + lone), (5, "y " + shared[:200]), (7, "q " + lone + " r"), (8, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in repeated_passages(df).collect())
    assert got == [(1, 0, 60, 2), (2, 0, 60, 1), (3, 2, 60, 1), (4, 0, 55, 7), (4, 1, 55, 7), (5, 1, 52, 1), (7, 1, 55, 4)]
    assert sorted(tuple(r) for r in repeated_passages(df.where("doc_id = 4")).collect()) == []


def test_op4(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert {(r["doc_id"], r["start"], r["n_words"]) for r in op4_repeats_suffix_array(spark, SF).collect()} == brute_passages(docs, 50)


def test_passages_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(70))
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text), (None, text), (4, text.upper()), (5, text + "\n" + "z " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as head")
    assert sorted(tuple(r) for r in repeated_passages(df).collect()) == [(1, 0, 70, 5), (5, 0, 70, 1)]
    assert repeated_passages(df.limit(0)).count() == 0 and repeated_passages(df.where("doc_id < 5")).count() == 0


def test_words_of_bytes():
    for text in ("", " ", "a", " a\tbb \x0b\x0cccc\r\n", "é\u00a0ü x\u2003y", "long " * 50 + "z" * 300 + " end"):
        raw = np.frombuffer(text.encode(), np.uint8)
        for most in (7, 1 << 20):
            found, starts = word_hashes(raw, most)
            words = text.encode().split()
            assert len(found) == len(words) and all(raw[s : s + len(w)].tobytes() == w for s, w in zip(starts, words))
            assert {w: h for w, h in zip(words, found.tolist())} == dict(zip(words, found.tolist())) and len(set(found.tolist())) == len(set(words))


def test_gram_hashes():
    w = np.random.default_rng(0).integers(0, 1 << 62, 90).astype(np.uint64)
    for n in (1, 2, 3, 8, 34, 90):
        g = gram_hashes(w, n)
        assert len(g) == 90 - n + 1 and len(set(g.tolist())) == len(g)
        assert gram_hashes(np.append(w[5:], w[:5]), n)[0] == g[5] if len(g) > 5 else True


def test_no_passage_without_a_partner(spark):
    df = spark.range(30).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(80)), lambda i: F.concat(F.col("id").cast("string"), F.lit("x"), i.cast("string")))).alias("text"))
    assert repeated_passages(df).count() == 0
