"""Best-fit packing planned on the histogram of lengths.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens. The
driver sees only how many pieces have each length (at most ``capacity`` numbers)
and runs best-fit decreasing over those counts: bins that look alike are one
entry, so its work depends on the capacity and not on the number of documents.
The plan is a table of slot ranges for each length; a piece takes the slot at
its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups_for, settle, small_or_shuffled, text_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ENCODERS: dict[str, object] = {}


def token_encoder(vocabulary: str):
    """texts -> list of id arrays, of a byte-level BPE vocabulary given as a ``tokenizers`` JSON file.

    The ids are those of ``tokenizers`` with add_special_tokens=False; where
    the ranks file of the same name lies beside it, ``tiktoken`` computes the
    same ids in a fifth of the time (the tests compare the two). Texts that it
    refuses, such as a run of a million line ends, go to ``tokenizers``.
    """
    if vocabulary in _ENCODERS:
        return _ENCODERS[vocabulary]
    import base64
    import json
    import os

    from tokenizers import Tokenizer

    loaded: list[Tokenizer] = []

    def exact(texts: list[str]) -> list[np.ndarray]:
        if not loaded:
            loaded.append(Tokenizer.from_file(vocabulary))
        return [np.array(e.ids, np.uint32) for e in loaded[0].encode_batch(texts, add_special_tokens=False)]

    ranks = vocabulary.removesuffix(".json") + ".tiktoken"
    if os.path.exists(ranks):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(vocabulary, encoding="utf-8") as f:
            special = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}
        fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=special)

        def encode_one(text: str) -> np.ndarray:
            try:
                return fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # its pattern engine has a bounded stack
                return exact([text])[0]

        encode = lambda texts: [encode_one(t) for t in texts]
    else:
        encode = exact
    _ENCODERS[vocabulary] = encode
    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, and before them what is left over."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def tokenised_pieces(df: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and ids if asked for.

    A document is its ids and then ``end_id``; a null text is the empty one, so
    every row gives at least one piece. Texts are read whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = token_encoder(vocabulary)
        for batch in batches:
            for at in range(0, len(batch), 64):
                part, rows = batch.iloc[at : at + 64], []
                for doc, ids in zip(part["doc_id"], encode(part["text"].tolist())):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    doc = None if pd.isna(doc) else int(doc)
                    for k, (start, n) in enumerate(cut(len(ids), capacity)):
                        own = ids[start : start + n]
                        rows.append((doc, k, start, n, zlib.crc32(own.tobytes()), *([own.astype("i4")] if with_ids else [])))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])
                yield out.astype({"doc_id": "Int64"})

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInPandas(run, PIECES + ", ids array<int>" * with_ids)


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts. Rows (length, first rank, last rank, first sequence, pieces a sequence, offset).

    Piece of rank r in a row's range goes to sequence ``first + (r - first rank) // pieces``.
    """
    left: dict[int, list[tuple[int, int]]] = {}  # tokens left in a bin -> runs (first sequence, bins)
    sizes: list[int] = []  # the keys of left, sorted
    plan, opened = [], 0

    def put(room: int, first: int, bins: int) -> None:
        if bins and room:
            if room not in left:
                bisect.insort(sizes, room)
                left[room] = []
            left[room].append((first, bins))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"no piece may have {length} tokens")
        rank, todo = 0, histogram[length]
        while todo:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                room = sizes[at]
                first, bins = left[room].pop()
                if not left[room]:
                    del left[room], sizes[at]
            else:
                room, first, bins = capacity, opened, -(-todo // (capacity // length))
                opened += bins
            each = room // length  # the tightest bin stays the tightest until it is full
            full = min(bins, todo // each)
            some = todo - full * each if full < bins and todo - full * each < each else 0
            if full:
                plan.append((length, rank, rank + full * each - 1, first, each, capacity - room))
                put(room - each * length, first, full)
            if some:
                plan.append((length, rank + full * each, rank + full * each + some - 1, first + full, some, capacity - room))
                put(room - some * length, first + full, 1)
            put(room, first + full + (some > 0), bins - full - (some > 0))
            rank, todo = rank + full * each + some, todo - full * each - some
    return plan


def pack_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to rows that have doc_id, piece and length (1 to capacity).

    Ranks are counted in cells of (length, hash), so a length that many pieces
    share is spread over tasks; a cell's first rank comes from the cells' counts.
    Repeated rows take a slot each; an empty table stays empty.
    """
    spark = pieces.sparkSession
    cells = groups_for(pieces.count(), least=64)
    keyed = pieces.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(cells)))
    counts = settle(keyed.groupBy("length", "_cell").agg(F.count("*").alias("_n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = plan_slots(histogram, capacity)
    slots = spark.createDataFrame(plan, "length long, _from long, _to long, _seq long, _each long, _off long")
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))).select("length", "_cell", F.coalesce("_before", F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_cell").orderBy("doc_id", "piece")
    ranked = keyed.withColumn("_in", F.row_number().over(within) - 1).join(before, ["length", "_cell"]).withColumn("_rank", F.col("_before") + F.col("_in"))
    # One range of a length holds a rank: look it up in the length's sorted array of ranges.
    ranges = slots.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("_from", "_to", "_seq", "_each", "_off"))).alias("_ranges"))
    placed = ranked.join(small_or_shuffled(ranges, len(plan) * 48), "length").withColumn("_slot", F.filter("_ranges", lambda r: (r["_from"] <= F.col("_rank")) & (F.col("_rank") <= r["_to"]))[0])
    along = F.col("_rank") - F.col("_slot._from")
    return placed.select(
        *pieces.columns,
        (F.col("_slot._seq") + F.floor(along / F.col("_slot._each"))).cast("long").alias("sequence_id"),
        (F.col("_slot._off") + along % F.col("_slot._each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(df: DataFrame, vocabulary: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its place, and its ids with ``with_ids``.

    Null or empty texts are documents of the end token alone; very long ones
    are cut; repeated rows are packed each on its own; an empty table gives an
    empty result; columns other than id and text are not read.
    """
    return pack_pieces(settle(tokenised_pieces(df, vocabulary, capacity, id_col=id_col, text_col=text_col, with_ids=with_ids)), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with ids: sequence_id, doc_ids, ids (at most capacity tokens)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_p")).select("sequence_id", F.col("_p.doc_id").alias("doc_ids"), F.flatten(F.col("_p.ids")).alias("ids"))
