"""Sharding and packing against their laws and brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from factloom.llm import packing
from factloom.llm.packing import cut, pack_documents, pack_pieces, plan_slots, sequences, token_encoder
from factloom.llm.queries import op1_shard_hypergeometric, op2_pack_best_fit, public_vocabulary
from factloom.llm.sharding import communication_matrix, shuffle_into_shards

SF = "/root/testdata/sf0.001"
ODD = [(1, "a"), (1, "a"), (1, "b"), (None, None), (None, "x"), (2, ""), (3, "é " * 3000)]


def test_matrix_sums():
    rows = [5, 0, 17, 100, 1]
    m = communication_matrix(rows, 8, 3)
    assert m.sum(axis=1).tolist() == rows and set(m.sum(axis=0)) <= {123 // 8, 123 // 8 + 1}


def test_matrix_is_hypergeometric():
    """A block of 50 of 100 rows sends its rows to one of two shards as draws without replacement do."""
    counts = np.array([communication_matrix([50, 50], 2, s)[0, 0] for s in range(2000)])
    assert abs(counts.mean() - 25) < 0.3 and abs(counts.var() - 50 * 0.25 * 50 / 99) < 0.8


def test_shards_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "7 as slot", "'k' as _block", "1 as _rank")
    got = shuffle_into_shards(df, 3).collect()
    assert sorted((r["doc_id"], r["text"], r["_block"]) for r in got if r["doc_id"]) == sorted((i, t, "k") for i, t in ODD if i)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(map(len, slots.values())) == [2, 2, 3] and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shuffle_into_shards(df.limit(0), 3).count() == 0
    assert shuffle_into_shards(df.withColumn("shard", df.doc_id), 3).columns == ["doc_id", "text", "_block", "_rank", "shard", "slot"]
    with pytest.raises(ValueError):
        shuffle_into_shards(df, 0)


def test_shuffle_is_uniform_and_repeatable(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    got = [tuple(r) for r in shuffle_into_shards(df, 8).orderBy("shard", "slot").collect()]
    ids = np.array([r[0] for r in got])
    assert got == [tuple(r) for r in shuffle_into_shards(df.repartition(7), 8).orderBy("shard", "slot").collect()]
    assert abs(np.corrcoef(ids, np.arange(len(ids)))[0, 1]) < 0.05
    quarters = np.histogram2d(ids, np.arange(len(ids)), bins=4)[0]
    assert ((quarters - 250) ** 2 / 250).sum() < 40  # 9 degrees of freedom


def test_repeated_ids_share_no_block(spark):
    df = spark.range(3000).selectExpr("cast(null as long) as doc_id", "id as n")
    got = shuffle_into_shards(df, 4).groupBy("shard").agg({"*": "count", "slot": "max"}).collect()
    assert [r["count(1)"] for r in got] == [750] * 4 and {r["max(slot)"] for r in got} == {749}


def test_op1(spark):
    rows = op1_shard_hypergeometric(spark, SF).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    sizes = [len(x) for x in slots.values()]
    assert sorted(slots) == list(range(8)) and max(sizes) - min(sizes) <= 1 and all(sorted(x) == list(range(len(x))) for x in slots.values())
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    assert len(rows) == len(texts) and all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode()) for r in rows)


def test_cut():
    assert cut(5, 8) == [(0, 5)] and cut(16, 8) == [(0, 8), (8, 8)] and cut(19, 8) == [(0, 3), (3, 8), (11, 8)] and cut(1, 8) == [(0, 1)]


def brute_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b >= n]
        if fits:
            bins.remove(min(fits))
        bins.append((min(fits) if fits else capacity) - n)
    return len(bins)


def test_plan_equals_best_fit_of_single_pieces():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.randint(5, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        used: dict[int, list[tuple[int, int]]] = {}
        for n, low, high, first, each, offset in plan_slots(histogram, capacity):
            for r in range(low, high + 1):
                used.setdefault(first + (r - low) // each, []).append((offset + (r - low) % each * n, n))
        assert sum(len(x) for x in used.values()) == len(lengths)
        for places in used.values():
            at = 0
            for offset, n in sorted(places):
                assert offset == at
                at += n
            assert at <= capacity
        assert len(used) == brute_best_fit(lengths, capacity)


def test_plan_size_does_not_follow_counts():
    small = plan_slots({n: 7 * n % 50 + 1 for n in range(1, 2049)}, 2048)
    large = plan_slots({n: (7 * n % 50 + 1) * 1_000_003 for n in range(1, 2049)}, 2048)
    assert len(large) < 3 * len(small) + 6000
    with pytest.raises(ValueError):
        plan_slots({2049: 1}, 2048)


def test_encoders_agree(monkeypatch):
    texts = ["", " ", "Hello  world\n\n x", "<|endoftext|> a<|endoftext|>", "日本 é́ 🎉 don't 123456", "\x00\x01", "a" * 5000, "THE!! ***$$$"]
    fast = [x.tolist() for x in token_encoder(public_vocabulary())(texts)]
    packing._ENCODERS.clear()
    monkeypatch.setattr("os.path.exists", lambda p: False)
    slow = [x.tolist() for x in token_encoder(public_vocabulary())(texts)]
    packing._ENCODERS.clear()
    assert fast == slow


def test_encoders_agree_on_a_whole_table(spark):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_vocabulary()).encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in token_encoder(public_vocabulary())(texts)] == [e.ids for e in slow]


def test_texts_that_the_fast_encoder_refuses(spark):
    odd = ["\n" * 2_000_000, " " * 1_000_000 + "a"]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    rows = pack_documents(df, public_vocabulary()).toPandas()
    for i, t in enumerate(odd):
        ids = np.append(token_encoder(public_vocabulary())([t])[0], 0).astype("<u4")
        own = rows[rows["doc_id"] == i].sort_values("piece")
        assert own["length"].sum() == len(ids) and [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own["start"], own["length"])] == own["ids_crc32"].tolist()


def test_pack_odd_documents(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'x' as length", "1 as _cell")
    rows = pack_documents(df, public_vocabulary(), 64, with_ids=True).collect()
    whole = {}
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= 64
        whole.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in whole.values():
        assert [o for o, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:i]) for i in range(len(places))]
    assert sorted(str(r["doc_id"]) for r in rows if r["piece"] == 0) == sorted(str(i) for i, _ in ODD)
    assert len(whole) == brute_best_fit([r["length"] for r in rows], 64)
    assert pack_documents(df.limit(0), public_vocabulary()).count() == 0
    full = sequences(pack_documents(df, public_vocabulary(), 64, with_ids=True)).collect()
    assert sum(len(r["ids"]) for r in full) == sum(r["length"] for r in rows)


def test_op2(spark):
    rows = op2_pack_best_fit(spark, SF).toPandas()
    assert rows["sequence_id"].nunique() == brute_best_fit(rows["length"].tolist(), 2048)
    encode = token_encoder(public_vocabulary())
    for r in spark.read.parquet(f"{SF}/documents.parquet").limit(20).collect():
        ids = np.append(encode([r["text"] or ""])[0], 0).astype("<u4")
        own = rows[rows["doc_id"] == r["doc_id"]].sort_values("piece")
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own["start"], own["length"])] == own["ids_crc32"].tolist() and own["length"].sum() == len(ids)


def test_pack_pieces_with_a_hot_length(spark):
    pieces = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "cast(if(id % 3 = 0, 10, 1 + id % 16) as long) as length")
    rows = pack_pieces(pieces, 16).toPandas()
    assert not rows.duplicated(["sequence_id", "offset"]).any() and (rows["offset"] + rows["length"]).max() <= 16
    assert rows["sequence_id"].nunique() == brute_best_fit(rows["length"].tolist(), 16)
