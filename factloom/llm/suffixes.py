"""Repeated passages by a distributed sparse suffix array.

Suffixes (of words) are kept only where a minimiser selects them: the smallest
hash of ``GRAM`` words among ``SPAN`` neighbouring ones. Two places that share
``least`` words agree on a minimiser within their first SPAN words, so on a kept
suffix of which at least ``least - SPAN + 1`` words are shared; that part is the
suffix's head. Suffixes whose head occurs in one text only are dropped. The rest
are sorted by head and the words behind it, and neighbours are compared: the words
they have in common to the right part the sorted rows into runs for every length.
The words in front of the head, sorted from the head backwards, do so to the left.
Rows in one run on either side share a match that reaches as far. Overlapping
matches merge to passages. Of equal texts only one is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, text_of
from .lines import _mixed, _powers

GRAM, SPAN = 8, 17
SIDE = SPAN - 1
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(raw: np.ndarray, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the words of UTF-8 bytes, about ``most`` bytes at a time.

    Each word's hash comes from two sums of the bytes, weighed with powers of
    BASE, so all words are hashed at once.
    """
    hashes, starts, at = [], [], 0
    while at < len(raw):
        end = min(len(raw), at + most)
        while end < len(raw) and not SPACE[raw[end]]:  # up to the end of the word
            ahead = np.flatnonzero(SPACE[raw[end : end + most]])
            end = end + int(ahead[0]) if len(ahead) else min(len(raw), end + most)
        part = raw[at:end]
        word = ~SPACE[part]
        edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) * _powers(BASE, len(part))[: len(part)], out=sums[1:])
        back = _powers(pow(BASE, -1, 1 << 64), len(part) + 1)
        hashes.append(_mixed((sums[last] - sums[first]) * back[first] + _mixed((last - first).astype(np.uint64))) | np.uint64(1))
        starts.append(first + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each place, by doubling."""
    with np.errstate(over="ignore"):
        out, have, power, half = None, 0, np.uint64(BASE), words
        size = 1
        total = len(words) - n + 1
        scale = np.uint64(1)
        for bit in range(n.bit_length()):
            if n >> bit & 1:  # append half (of ``size`` words) after the ``have`` words so far
                part = half[have : have + total]
                out = part * scale if out is None else out + part * scale
                scale, have = scale * power, have + size
            if n >> (bit + 1):
                half = half[: len(half) - size] + half[size:] * power
                power, size = power * power, size * 2
        return _mixed(out)


def joined_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts behind each other as hashes; where each text's words begin and end."""
    raw = [np.frombuffer(t.as_buffer(), np.uint8) if t.is_valid else np.zeros(0, np.uint8) for t in texts]
    sizes = np.array([len(x) for x in raw], np.int64)
    gap = np.full(1, 32, np.uint8)  # a space, so that no word goes on in the next text
    words, starts = word_hashes(np.concatenate([y for x in raw for y in (x, gap)])) if raw else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    begin = np.searchsorted(starts, np.cumsum(sizes + 1) - sizes - 1)
    return words, begin, np.append(begin[1:], len(words))


def kept_suffixes(words: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place among all words, head) of the kept suffixes of texts that have ``least`` words."""
    head = least - SPAN + 1
    none = np.zeros(0, np.int64)
    if len(words) < least:
        return none, none, none.astype(np.uint64)
    owner, limit = np.repeat(np.arange(len(begin)), end - begin), np.repeat(np.where(end - begin >= least, end, 0), end - begin)
    grams = gram_hashes(words, GRAM)
    low = np.lib.stride_tricks.sliding_window_view(grams, SPAN).argmin(axis=1)
    windows = np.arange(len(low))
    places = np.unique((low + windows)[windows + SPAN + GRAM - 1 <= limit[windows]])
    places = places[places + head <= limit[places]]
    return owner[places], places, gram_hashes(words, head)[places]


def _slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of the batches of about ``most`` bytes in a text column; a longer text is alone."""
    for batch in batches:
        size = np.cumsum([t.as_buffer().size if t.is_valid else 0 for t in batch.column(column)])
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most)))
            yield batch.slice(at, end - at)
            at = end


def heads(docs: DataFrame, least: int) -> DataFrame:
    """(head, t, u, doc_id, place, whole) of every kept suffix; t and u are the text's hashes.

    A text of ``least`` words also has a row ``whole``: its head is t, its place the number of words.
    """
    names = ["head", "t", "u", "doc_id", "place", "whole"]

    def rows(part: pa.RecordBatch, text: np.ndarray, head: pa.Array, place: np.ndarray, whole: bool) -> pa.RecordBatch:
        own = pa.array(text)
        return pa.RecordBatch.from_arrays([head, *(part.column(i).take(own) for i in (1, 2, 0)), pa.array(place.astype(np.int32)), pa.array(np.full(len(text), whole))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, 3):
            words, begin, end = joined_words(part.column(3))
            text, place, head = kept_suffixes(words, begin, end, least)
            if len(text):
                yield rows(part, text, pa.array(head.view(np.int64)), place - begin[text], False)
            if len(long := np.flatnonzero(end - begin >= least)):
                yield rows(part, long, part.column(1).take(pa.array(long)), (end - begin)[long], True)

    return docs.select("_id", "t", "u", "_text").mapInArrow(run, "head long, t long, u long, doc_id long, place int, whole boolean")


def suffix_rows(docs: DataFrame, least: int) -> DataFrame:
    """(head, salt, many, t, lo, hi, place, before, after): the suffixes at ``_places`` (place, pieces) with the words around the head.

    The rows of a head in ``pieces`` > 1 get a salt, so that they are sorted in as many groups.
    """
    head = least - SPAN + 1

    def binary(x: np.ndarray) -> pa.Array:
        offsets = np.arange(len(x) + 1, dtype=np.int32) * np.int32(SIDE * 8)
        return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(x).tobytes())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["head", "salt", "many", "t", "lo", "hi", "place", "before", "after"]
        for part in _slices(batches, 3):
            words, begin, end = joined_words(part.column(3))
            wanted = part.column(4)
            text = np.repeat(np.arange(part.num_rows), np.diff(wanted.offsets.to_numpy()))
            place = wanted.flatten().field("place").to_numpy(zero_copy_only=False).astype(np.int64)
            pieces = wanted.flatten().field("pieces").to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(place):
                continue
            grams = gram_hashes(words, head)
            at = place + begin[text]
            side = np.arange(SIDE)
            before, after = at[:, None] - 1 - side, at[:, None] + head + side
            left = np.where(before >= begin[text][:, None], words[np.maximum(before, 0)], np.uint64(0))
            right = np.where(after < end[text][:, None], words[np.minimum(after, len(words) - 1)], np.uint64(0))
            own, salt = pa.array(text), (grams[at] ^ _mixed(place.astype(np.uint64) + part.column(1).to_numpy(zero_copy_only=False).view(np.uint64)[text])) % pieces.astype(np.uint64)
            columns = [pa.array(grams[at].view(np.int64)), pa.array(salt.astype(np.int64)), pa.array(pieces > 1), *(part.column(i).take(own) for i in (1, 0, 2)), pa.array(place.astype(np.int32)), binary(left), binary(right)]
            for k in range(0, len(place), 4096):
                yield pa.RecordBatch.from_arrays([c.slice(k, 4096) for c in columns], names)

    return docs.select("lo", "t", "hi", "_text", "_places").mapInArrow(run, "head long, salt long, many boolean, t long, lo long, hi long, place int, before binary, after binary")


def shared_words(rows: np.ndarray) -> np.ndarray:
    """How many leading words each row has in common with the one before it; 0 is no word."""
    same = (rows[1:] == rows[:-1]) & (rows[1:] > 0)
    return np.append(0, np.logical_and.accumulate(same, axis=1).sum(axis=1)) if len(rows) else np.zeros(0, np.int64)


FOUND = "kind int, key long, t long, lo long, hi long, start int, end int, other long"


def _matches(least: int):
    """Suffix rows sorted by head and ``after`` -> FOUND rows.

    kind 0: a match of text (t, lo), from ``start`` to ``end``, with document
    ``other``. Heads in several pieces go on in other tasks; for them, kind 1 is a
    window that found no partner here, and kind 2 a window's key with the smallest
    and largest document that have it here (lo and hi).
    """

    def grown(words: np.ndarray) -> np.ndarray:
        """Hashes of the first 0 .. SIDE words."""
        out = [np.full(len(words), np.uint64(1))]
        for i in range(SIDE):
            out.append(_mixed(out[-1] * np.uint64(BASE) + words[:, i]))
        return np.stack(out)

    def compare(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        head, many, text, lo, hi, place, before, after = rows
        n = len(head)
        left, right = (np.frombuffer(b"".join(x), np.uint64).reshape(n, SIDE) for x in (before, after))
        # Runs of the suffix array that share r words behind the head end where neighbours share fewer.
        to_right = np.where(np.append(True, head[1:] != head[:-1]), -1, shared_words(right))
        backwards = np.lexsort(left.T[::-1])
        to_left, depth = shared_words(left[backwards]), (left > 0).sum(axis=1)
        reach = (right > 0).sum(axis=1)
        keys = (grown(left), grown(right)) if many.any() else None
        hit, partner, out = np.zeros((SIDE + 1, n), bool), np.zeros((SIDE + 1, n), np.int64), []
        run_left = np.empty(n, np.int64)
        for a in range(SIDE + 1):
            whole = np.flatnonzero((depth >= a) & (reach >= SIDE - a))
            if not len(whole):
                continue
            run_left[backwards] = np.cumsum(to_left < a)
            window = (np.cumsum(to_right < SIDE - a) * np.int64(n + 1) + run_left)[whole]
            order = np.argsort(window, kind="stable")
            cut = np.flatnonzero(np.append(True, window[order][1:] != window[order][:-1]))
            size = np.diff(np.append(cut, len(order)))
            own = whole[order]
            low, high = np.minimum.reduceat(lo[own], cut), np.maximum.reduceat(hi[own], cut)
            lows, highs = np.repeat(low, size), np.repeat(high, size)
            hit[a, own] = lows != highs
            partner[a, own] = np.where(lows == lo[own], highs, lows)
            if keys:
                key = _mixed(_mixed(head.view(np.uint64)[own] + keys[0][a][own] * np.uint64(3)) + keys[1][SIDE - a][own] * np.uint64(5) + np.uint64(a)).view(np.int64)
                lonely, seen = many[own] & (lows == highs), many[own[cut]]
                out.append((1, key[lonely], text[own][lonely], lo[own][lonely], hi[own][lonely], place[own][lonely] - a, place[own][lonely] - a + least, 0))
                out.append((2, key[cut][seen], 0, low[seen], high[seen], 0, 0, 0))
        # Windows that start at neighbouring words make one match.
        padded = np.vstack([np.zeros(n, bool), hit, np.zeros(n, bool)])
        first, last = np.nonzero((padded[1:-1] & ~padded[:-2]).T), np.nonzero((padded[1:-1] & ~padded[2:]).T)
        row, a, b = first[0], first[1], last[1]
        out.append((0, 0, text[row], lo[row], hi[row], place[row] - b, place[row] - a + least, partner[a, row]))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        for columns in out:
            if size := len(columns[3]):
                yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(c, size), kind) for c, kind in zip(columns, kinds)], ["kind", "key", "t", "lo", "hi", "start", "end", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            count += batch.num_rows
            if count < 1 << 15:
                continue
            rows = [np.concatenate(x) for x in zip(*held)]
            last = int(np.argmax(rows[0] == rows[0][-1]))
            if last:
                yield from compare([r[:last] for r in rows])
            held, count = [[r[last:] for r in rows]], 0
        if held:
            yield from compare([np.concatenate(x) for x in zip(*held)])

    return run


def repeated_passages(df: DataFrame, least: int = 50, id_col: str = "doc_id", text_col: str = "text", piece: int = 1 << 12) -> DataFrame:
    """Passages of at least ``least`` words that another document holds too: doc_id, start, n_words, other_id.

    Words are what white space parts, compared by hashes of 64 bits; equal texts
    are known by 128 bits. ``start`` counts the document's words from 0. A passage
    is a longest run in which every window of ``least`` words occurs in some other
    document; ``other_id`` is the smallest id found to share a part of it.
    Documents without such passages have no row. A head with more than ``piece``
    suffixes is sorted in several pieces, whose windows then meet by a hash.

    Null and empty texts have no words; texts are read whole, however long. Rows
    with a null id are not read; rows that repeat an id count as one document and
    do not repeat each other, and where their texts differ each has its own
    passages. Other columns are not read. An empty table gives an empty result.
    """
    if least < SPAN + GRAM:
        raise ValueError(f"least must be {SPAN + GRAM} or more")
    named = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))
    docs = named.select("_id", F.xxhash64("_text").alias("t"), F.xxhash64(F.lit(1), "_text").alias("u"), "_text")
    of = F.when(F.col("whole"), F.col("doc_id")).otherwise(F.col("t"))
    counted = heads(docs, least).groupBy("whole", "head", F.when(F.col("whole"), F.col("u")).alias("u")).agg(F.min(of).alias("a"), F.max(of).alias("b"), F.count("*").alias("n"), F.max("place").alias("words"))
    # Settled: with an exchange of its own on either side, the joins can split a head or text that fills the corpus.
    counted = settle(counted.where("whole or a < b"))
    shared = counted.where("not whole").select("head", F.ceil(F.col("n") / piece).cast("long").alias("pieces"))
    texts = counted.where("whole").select(F.col("head").alias("t"), "u", F.col("a").alias("lo"), F.col("b").alias("hi"), "words")
    places = heads(docs, least).where("not whole").join(shared, "head").groupBy("t", "u").agg(F.collect_set(F.struct("place", "pieces")).alias("_places"))
    asked = settle(places.join(texts, ["t", "u"]).select(F.col("t").alias("_t"), "lo", "hi", "_places"))
    wanted = docs.join(asked, (docs["_id"] == asked["lo"]) & (docs["t"] == asked["_t"])).select("lo", "t", "hi", "_text", "_places")
    dealt = suffix_rows(wanted, least).repartition("head", "salt").sortWithinPartitions("head", "after")
    found = settle(dealt.select("head", "many", "t", "lo", "hi", "place", "before", "after").mapInArrow(_matches(least), FOUND))
    across = found.where("kind = 2").groupBy("key").agg(F.min("lo").alias("low"), F.max("hi").alias("high")).where("low < high")
    late = found.where("kind = 1").select("key", "t", "lo", "hi", "start", "end").join(across, "key")
    matches = found.where("kind = 0").select("t", "lo", "start", "end", "other").unionByName(
        late.select("t", "lo", "start", "end", F.when(F.col("low") == F.col("lo"), F.col("high")).otherwise(F.col("low")).alias("other")))
    matches = matches.groupBy("t", "lo", "start").agg(F.max("end").alias("end"), F.min("other").alias("other"))
    along = Window.partitionBy("t", "lo").orderBy("start")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = matches.withColumn("new", (reach.isNull() | (F.col("start") > reach - (least - 1))).cast("int")).withColumn("run", F.sum("new").over(along))
    merged = settle(runs.groupBy("t", "lo", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("other").alias("other_id")))
    # A text of one document has its own passages; one of several is a passage as a whole.
    alone = merged.join(texts.where("lo = hi").select("t", "lo"), ["t", "lo"]).select(F.col("lo").alias("doc_id"), "start", (F.col("end") - F.col("start")).cast("int").alias("n_words"), "other_id")
    least_other = settle(texts.where("lo < hi").join(merged.groupBy("t", "lo").agg(F.min("other_id").alias("other")), ["t", "lo"], "left"))
    copies = docs.select("_id", "t", "u").join(least_other, ["t", "u"]).distinct()
    copy = F.when(F.col("_id") == F.col("lo"), F.col("hi")).otherwise(F.col("lo"))
    other = F.when(F.col("other") == F.col("_id"), copy).otherwise(F.least(copy, "other"))
    return alone.unionByName(copies.select(F.col("_id").alias("doc_id"), F.lit(0).alias("start"), F.col("words").cast("int").alias("n_words"), other.alias("other_id")))
