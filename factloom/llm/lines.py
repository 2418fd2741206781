"""Line deduplication by a segment-partition edit join.

Lines that are equal form a class by hash. Lines within ``edits`` edits of each
other join their classes: a line of n characters is split into edits + 1 even
segments, of which any close line must hold one unchanged near its place. The
segments are indexed under (n, segment number, segment); a line probes the
indexes of its own and the shorter lengths with the substrings that the
multi-match-aware rule selects (Li et al., 2011). Rows that meet under a key
are first compared by a 64-bit parity sketch of their character pairs, which
one edit changes in four bits at most, and what passes is verified on the texts
by a banded bit-parallel automaton: pair by pair in small groups, as a spanning
forest in large ones. The first line of a class stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, small_or_shuffled, text_of
from .components import connected_components
from .simhash import bits_apart


def _flat(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters behind each other, and the start and length of each line."""
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    return np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32), np.cumsum(size) - size, size


def sketches(lines: list[str]) -> np.ndarray:
    """Parities of the hashed character pairs of each line (of one character at least), as 64 bits."""
    return _sketches(*_flat(lines))


def _sketches(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    pair = flat * np.uint32(40503)
    pair[:-1] += flat[1:]
    pair *= np.uint32(2654435761)
    pair >>= np.uint32(26)
    bits = np.left_shift(np.uint64(1), pair.astype(np.uint64))
    bits[start + size - 1] = 0  # no pair reaches into the next line
    return np.bitwise_xor.reduceat(bits, start).view(np.int64) if len(start) else np.zeros(0, np.int64)


BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base ** 2 ... modulo 2 ** 64, at least n of them."""
    if len(_POWERS.get(base, ())) < n:
        _POWERS[base] = np.multiply.accumulate(np.append(np.uint64(1), np.full(max(n, 1 << 16) - 1, base, np.uint64)))
    return _POWERS[base]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join_keys(lines: list[str], edits: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, line, asks) rows of the index segments and the probes of every line, and the lines' sketches.

    Segments are even, the longer ones last. Segment i of a partner that is ``gap``
    characters shorter has moved by at most i, the edits before it, and by at most
    edits - i beyond ``gap``, those behind it.

    A substring's hash comes from two sums of its text's characters, each weighed
    with a power of BASE, so all substrings of all lines are hashed at once.
    """
    flat, start, size = _flat(lines)
    inverse = pow(int(BASE), -1, 1 << 64)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) * _powers(int(BASE), len(flat))[: len(flat)], out=sums[1:])
    back = _powers(inverse, len(flat) + 1)
    keys, owners, asks, everyone = [], [], [], np.arange(len(lines))

    def add(own: np.ndarray, seed: np.ndarray, at: np.ndarray, width: np.ndarray, ask: bool) -> None:
        a = start[own] + at
        keys.append(_mixed((sums[a + width] - sums[a]) * back[a] + _mixed(seed.astype(np.uint64))))
        owners.append(own)
        asks.append(np.full(len(own), ask))

    parts = edits + 1
    for gap in range(edits + 1):
        own = everyone[size - gap >= max(least, 1)]
        n = size[own] - gap  # the length under which partners are indexed
        for i in range(parts):
            whole, longer = n // parts, n % parts
            at, width = i * whole + np.maximum(0, i - (parts - longer)), whole + (i >= parts - longer)
            if not gap:
                add(own, n * 64 + i, at, width, False)
            for move in range(max(-i, gap - (edits - i)), min(i, gap + (edits - i)) + 1):
                fits = (at + move >= 0) & (at + move + width <= size[own])
                add(own[fits], (n * 64 + i)[fits], (at + move)[fits], width[fits], True)
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(asks), _sketches(flat, start, size)


def within_edits(pairs: list[tuple[str, str]], edits: int) -> np.ndarray:
    """Whether the two strings of each pair are within ``edits`` edits: all pairs step together.

    Bit d of the word for e errors stands for the diagonal d - edits of the
    edit matrix: only a band of 2 * edits + 1 diagonals is kept.
    """
    first, second = [np.array([len(x[k]) for x in pairs]) for k in (0, 1)]
    width, band = int(max(first.max(), second.max())), 2 * edits + 1
    a = np.zeros((len(pairs), width + 2 * band), np.uint32)
    b = np.full((len(pairs), width), np.uint32(0xFFFFFFFF))
    for i, (x, y) in enumerate(pairs):
        a[i, edits : edits + len(x)] = np.frombuffer(x.encode("utf-32-le"), np.uint32)
        b[i, : len(y)] = np.frombuffer(y.encode("utf-32-le"), np.uint32)
    a += 1  # 0 is beyond the text
    b += 1
    a[:, :edits] = 0
    for i in range(len(pairs)):
        a[i, edits + first[i] :] = 0
    b[b == 0] = 0xFFFFFFFE
    full = np.uint32((1 << band) - 1)
    states = [np.full(len(pairs), (((1 << (e + 1)) - 1) << edits) & int(full), np.uint32) for e in range(edits + 1)]
    result = np.zeros(len(pairs), bool)
    goal = first - second + edits
    possible = (goal >= 0) & (goal < band)
    for j in range(width + 1):
        ends = np.flatnonzero((second == j) & possible)
        if len(ends):
            result[ends] = (states[-1][ends] >> goal[ends].astype(np.uint32)) & 1
        if j == width:
            return result
        match = np.zeros(len(pairs), np.uint32)
        for d in range(band):
            match |= (a[:, j + d] == b[:, j]).astype(np.uint32) << np.uint32(d)
        fresh = [states[0] & match]
        for e in range(1, edits + 1):
            step = (states[e] & match) | states[e - 1] | (states[e - 1] >> np.uint32(1)) | (fresh[e - 1] << np.uint32(1))
            fresh.append(step & full)
        states = fresh
    return result


def _line_ids(lines: list[str]) -> np.ndarray:
    """Two numbers of 62 and 64 bits for each line, from one 128-bit hash."""
    import xxhash

    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.encode()) for x in lines), ">u8").astype(np.uint64).reshape(-1, 2)
    return np.stack([both[:, 0] >> np.uint64(2), both[:, 1]], axis=1).view(np.int64)


def long_lines(text: str, least: int) -> list[tuple[int, str]]:
    """(number, line without outer white space) of the lines that have ``least`` characters."""
    return [(i, s) for i, x in enumerate(text.split("\n")) if len(s := x.strip()) >= least]


def occurrences(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, line, id, other): every long line; id and other are two hashes of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [long_lines(t, least) for t in part.column(1).to_pylist()]
                ids = _line_ids([s for x in found for _, s in x])
                doc = np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(x) for x in found])
                line = np.array([i for x in found for i, _ in x], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, line, ids[:, 0], ids[:, 1])], ["doc_id", "line", "id", "other"])

    return docs.select("_id", "_text").mapInArrow(run, "doc_id long, line int, id long, other long")


#: A join row as bytes: its key, the line's id with a last bit for probes, the line's sketch.
ROW = np.dtype([("key", "<i8"), ("id", "<i8"), ("sketch", "<i8")])


def join_rows(docs: DataFrame, edits: int, least: int, bins: int, batch_chars: int = 1 << 18, batch_rows: int = 1 << 18) -> DataFrame:
    """(bin, rows): the index rows and probes of every line, many in one value, dealt by key into ``bins``.

    Lines that a task has just met are not sent again, so a line that fills the
    corpus gives a few rows a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        held: list[np.ndarray] = []

        def made(lines: list[str]) -> None:
            for at in range(0, len(lines), 1 << 14):
                part = lines[at : at + (1 << 14)]
                ids = _line_ids(part)[:, 0]
                fresh = []
                for k, h in enumerate(ids.tolist()):
                    if h not in met:
                        met.add(h)
                        fresh.append(k)
                if len(met) > 1 << 19:
                    met.clear()
                if fresh:
                    key, own, asks, sketch = join_keys([part[k] for k in fresh], edits, least)
                    rows = np.empty(len(key), ROW)
                    rows["key"], rows["id"], rows["sketch"] = key.view(np.int64), ids[fresh][own] << 1 | asks, sketch[own]
                    held.append(rows)

        def sent() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            held.clear()
            home = rows["key"].view(np.uint64) % np.uint64(bins)
            order = np.argsort(home, kind="stable")
            rows, home = rows[order], home[order]
            cut = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
            cut = np.union1d(cut, np.arange(0, len(rows), 1024))  # small values make small batches
            ends = np.append(cut, len(rows)) * ROW.itemsize
            values = pa.Array.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(rows.tobytes())])
            for at in range(0, len(cut), 256):
                yield pa.RecordBatch.from_arrays([pa.array(home[cut[at : at + 256]].astype(np.int64)), values.slice(at, 256).cast(pa.binary())], ["bin", "rows"])

        lines, chars = [], 0
        for batch in batches:
            for text in batch.column(0):
                found = [s for _, s in long_lines(text.as_py(), least)]
                lines += found
                chars += sum(map(len, found))
                if chars > batch_chars:
                    made(lines)
                    lines, chars = [], 0
                    if sum(map(len, held)) > batch_rows:
                        yield from sent()
        if lines:
            made(lines)
        if held:
            yield from sent()

    return docs.select("_text").mapInArrow(run, "bin long, rows binary")


def _close(rows: np.ndarray, i: np.ndarray, j: np.ndarray, edits: int) -> np.ndarray:
    """Whether a probe and an index row of two lines meet, with sketches that allow ``edits`` edits."""
    differ = rows["id"][i] ^ rows["id"][j]
    return (differ & 1 == 1) & (differ >> 1 != 0) & (bits_apart(rows["sketch"][i], rows["sketch"][j]) <= 4 * edits)


def _few(rows: np.ndarray, edits: int, most: int) -> Iterator[np.ndarray]:
    """Pairs of ids of close rows, from rows sorted by key of which at most ``most`` share one."""
    at = np.arange(len(rows))
    for gap in range(1, most):
        at = at[at + gap < len(rows)]
        at = at[rows["key"][at] == rows["key"][at + gap]]
        if not len(at):
            return
        good = at[_close(rows, at, at + gap, edits)]
        yield np.sort(np.stack([rows["id"][good] >> 1, rows["id"][good + gap] >> 1], axis=1), axis=1)


def _partnered(rows: np.ndarray, edits: int) -> np.ndarray:
    """Ids of the rows of one key that have a close partner among them."""
    asks = rows["id"] & 1 == 1
    asking, held = np.flatnonzero(asks), np.flatnonzero(~asks)
    found = np.zeros(len(rows), bool)
    step = max(1, (1 << 20) // max(1, len(held)))
    for at in range(0, len(asking) if len(held) else 0, step):
        part = asking[at : at + step]
        good = _close(rows, part[:, None], held[None, :], edits)
        found[part[good.any(axis=1)]] = True
        found[held[good.any(axis=0)]] = True
    return np.unique(rows["id"][found] >> 1)


MET = "kind int, key long, a long, b long"
PAIR, MEMBER, HOT = range(3)
#: A key with more rows gives members, not pairs. So many rows of a bin are held before crowded keys leave.
FEW, ROOM = 16, 1 << 22


def _met(kind: int, key, a, b) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.broadcast_to(key, n).astype(np.int64)), pa.array(np.asarray(a, np.int64)), pa.array(np.broadcast_to(b, n).astype(np.int64))], ["kind", "key", "a", "b"])


def _meet(edits: int, few: int, block: int, room: int):
    """Bins of join rows, sorted by bin -> rows of MET.

    PAIR: the lines a and b are candidates (of a key with ``few`` rows at most).
    MEMBER: line a has a candidate partner under the key. HOT: a row (a: id, b:
    sketch) of a key that has over ``block`` rows, which is left to ``_crowds``;
    such rows leave memory as soon as ``room`` rows are held.
    """

    def hot(rows: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sorted rows are of crowded keys, and all these keys."""
        cut = np.flatnonzero(np.append(True, rows["key"][1:] != rows["key"][:-1]))
        size = np.diff(np.append(cut, len(rows)))
        crowded = (size > block) | np.isin(rows["key"][cut], known)
        return np.repeat(crowded, size), np.union1d(known, rows["key"][cut][crowded])

    def settled(rows: np.ndarray, known: np.ndarray) -> Iterator[pa.RecordBatch]:
        same = rows["key"][1:] == rows["key"][:-1]
        rows = rows[np.append(False, same) | np.append(same, False) | (np.isin(rows["key"], known) if len(known) else False)]
        if not len(rows):
            return
        gone, known = hot(rows, known)
        if gone.any():
            yield _met(HOT, rows["key"][gone], rows["id"][gone], rows["sketch"][gone])
            rows = rows[~gone]
        if not len(rows):
            return
        cut = np.flatnonzero(np.append(True, rows["key"][1:] != rows["key"][:-1]))
        size = np.diff(np.append(cut, len(rows)))
        if found := [x for x in _few(rows[np.repeat(size <= few, size)], edits, few) if len(x)]:
            both = np.unique(np.concatenate(found), axis=0)
            yield _met(PAIR, 0, both[:, 0], both[:, 1])
        for at, n in zip(cut[size > few], size[size > few]):
            ids = _partnered(rows[at : at + n], edits)
            if len(ids):
                yield _met(MEMBER, rows["key"][at], ids, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, count, known, most = None, [], 0, np.zeros(0, np.int64), room
        for batch in batches:
            for home, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if home != at:
                    if held:
                        rows = np.concatenate(held)
                        yield from settled(rows[np.argsort(rows["key"], kind="stable")], known)
                    at, held, count, known, most = home, [], 0, np.zeros(0, np.int64), room
                held.append(np.frombuffer(value.as_buffer(), ROW).copy())
                count += len(held[-1])
                if count > most:
                    rows = np.concatenate(held)
                    rows = rows[np.argsort(rows["key"], kind="stable")]
                    gone, known = hot(rows, known)
                    if gone.any():
                        yield _met(HOT, rows["key"][gone], rows["id"][gone], rows["sketch"][gone])
                    held, count = [rows[~gone]], int((~gone).sum())
                    most = max(room, 2 * count)
        if held:
            rows = np.concatenate(held)
            yield from settled(rows[np.argsort(rows["key"], kind="stable")], known)

    return run


def _dealt(rows: DataFrame, counts: DataFrame, block: int, asks) -> DataFrame:
    """``rows`` with (key, pair): the rows of a key of ``counts`` (key, n) go to pairs of blocks of ``block`` rows.

    ``asks`` null: any two rows of a key meet somewhere; else a boolean column,
    and a row that asks meets all that do not.
    """
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("long")
    rows = rows.join(counts.select("key", n_blocks.alias("_blocks")), "key")
    own = F.pmod(F.xxhash64("a"), F.col("_blocks"))
    to = lambda x, y: x * (1 << 31) + y
    along = F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)
    pair = F.transform(along, lambda t: to(F.least(t, own), F.greatest(t, own)) if asks is None else F.when(asks, to(own, t)).otherwise(to(t, own)))
    return rows.withColumn("pair", F.explode(pair)).withColumn("key", F.xxhash64("key", "pair")).drop("_blocks", "pair")


def _crowds(edits: int):
    """HOT rows sorted by key -> MEMBER rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, columns in grouped(batches, 2):
            rows = np.empty(len(columns[0]), ROW)
            rows["key"], rows["id"], rows["sketch"] = key, columns[0], columns[1]
            ids = _partnered(rows, edits)
            if len(ids):
                yield _met(MEMBER, key, ids, 0)

    return run


def grouped(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, list]]:
    """(key, columns) of runs of one key, from batches of a key and ``width`` other columns that are sorted by key."""
    at, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy(zero_copy_only=False)
        cut = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
        for a, b in zip(cut, cut[1:]):
            if key[a] != at and held:
                yield at, [pa.concat_arrays(x) for x in zip(*held)]
                held = []
            at = key[a]
            held.append([batch.column(1 + i).slice(a, b - a) for i in range(width)])
    if held:
        yield at, [pa.concat_arrays(x) for x in zip(*held)]


def between(x: str, y: str) -> tuple[str, str]:
    """Two strings without what they have in common at the start and then at the end: as many edits apart."""
    n = min(len(x), len(y))
    a, b = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32) for s in (x, y))
    differ = a[:n] != b[:n]
    start = int(differ.argmax()) if n and differ.any() else n
    differ = (a[len(a) - (n - start) :] != b[len(b) - (n - start) :])[::-1]
    end = int(differ.argmax()) if n > start and differ.any() else n - start
    return x[start : len(x) - end], y[start : len(y) - end]


def verified(pairs: list[tuple[str, str]], edits: int) -> np.ndarray:
    """``within_edits`` in steps of pairs of like length, so that memory follows the longest pair."""
    pairs = [between(x, y) for x, y in pairs]
    size = np.fromiter((max(len(x), len(y)) for x, y in pairs), np.int64, len(pairs))
    order, good, at = np.argsort(size, kind="stable"), np.zeros(len(pairs), bool), 0
    while at < len(order):
        n = int(np.searchsorted((np.arange(1, 2049)[: len(order) - at]) * size[order[at : at + 2048]], 1 << 21, "right"))
        part = order[at : at + max(1, n)]
        good[part] = within_edits([pairs[k] for k in part], edits)
        at += len(part)
    return good


def line_forest(ids: np.ndarray, lines: list[str], edits: int) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of the lines within ``edits`` edits of each other; pairs already connected are not verified."""
    ids, place = np.unique(ids, return_index=True)
    lines = [lines[i] for i in place]
    sketch, size, part = sketches(lines), np.fromiter(map(len, lines), np.int64, len(lines)), np.arange(len(lines))
    step = max(1, (1 << 20) // len(lines))
    for at in range(0, len(lines), step):
        own = np.arange(at, min(at + step, len(lines)))[:, None]
        near = (bits_apart(sketch[own], sketch[None, :]) <= 4 * edits) & (np.abs(size[own] - size) <= edits) & (np.arange(len(lines)) > own)
        i, j = np.nonzero(near)
        i += at
        batch = 64  # few at first: one link can connect many pairs
        while len(i):
            open_ = part[i] != part[j]
            i, j = i[open_], j[open_]
            good = np.flatnonzero(verified([(lines[x], lines[y]) for x, y in zip(i[:batch].tolist(), j[:batch].tolist())], edits)) if len(i) else i
            for k in good:
                a, b = part[i[k]], part[j[k]]
                if a != b:
                    part[part == b] = a
                    yield int(ids[i[k]]), int(ids[j[k]])
            i, j, batch = i[batch:], j[batch:], min(2 * batch, 4096)


def line_texts(docs: DataFrame, firsts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text) of the distinct ``wanted`` (id) lines; ``firsts``: (id, doc_id, line) of each line's first place."""
    places = settle(firsts.join(wanted, "id").groupBy("doc_id").agg(F.collect_set(F.struct("line", "id")).alias("_want")).withColumnRenamed("doc_id", "_at"))
    size = places.agg(F.sum(F.size("_want")).alias("n")).first()["n"] or 0
    sources = docs.join(small_or_shuffled(places, size * 24), docs["_id"] == places["_at"]).select(F.split("_text", "\n").alias("_lines"), F.explode("_want").alias("w"))
    return settle(sources.select("w.id", F.get("_lines", F.col("w.line")).alias("text")).dropDuplicates(["id"]))


def edit_links(docs: DataFrame, firsts: DataFrame, edits: int, least: int, block: int = 4096) -> DataFrame:
    """Links (a, b) that connect what chains of distinct lines within ``edits`` edits connect. ``firsts``: (id, doc_id, line) of a line's text.

    Rows of one key give candidate pairs if there are at most ``FEW``. Of larger groups only
    members with some candidate partner are kept, and a spanning forest of them is
    verified. Groups of more than ``block`` rows are dealt into blocks whose pairs
    meet in separate tasks. So the output grows with the rows, whatever the groups.
    """
    bins = max(64, firsts.count() * 5 * (edits + 1) >> 19)  # about half a million rows in each
    dealt = join_rows(docs, edits, least, bins).repartition(bins, "bin").sortWithinPartitions("bin")
    met = settle(dealt.mapInArrow(_meet(edits, min(FEW, block), block, ROOM), MET))
    pairs = settle(met.where(F.col("kind") == PAIR).select("a", "b").distinct())
    members = met.where(F.col("kind") == MEMBER).select("key", "a").distinct()
    crowded = met.where(F.col("kind") == HOT).drop("kind")
    counts = settle(crowded.groupBy("key").agg(F.count("*").alias("n")))
    if counts.count():
        hot = _dealt(crowded, counts, block, F.col("a").bitwiseAND(1) == 1).select("key", "a", "b").repartition("key").sortWithinPartitions("key")
        members = members.unionByName(hot.mapInArrow(_crowds(edits), MET).select("key", "a")).distinct()
    members = settle(members)
    texts = line_texts(docs, firsts, pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).unionByName(members.select(F.col("a").alias("id"))).distinct())

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[verified([(x.strip(), y.strip()) for x, y in zip(batch["x"], batch["y"])], edits), ["a", "b"]]

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (ids, lines) in grouped(batches, 2):
            found = list(line_forest(ids.to_numpy(zero_copy_only=False), [x.strip() for x in lines.to_pylist()], edits))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    links = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(verify, "a long, b long")
    if members.isEmpty():
        return links
    sizes = members.groupBy("key").agg(F.count("*").alias("n"))
    groups = _dealt(members, sizes, block, None).join(left, "a").select("key", "a", "x").repartition("key").sortWithinPartitions("key")
    return links.unionByName(groups.mapInArrow(forest, "a long, b long"))


def dedup_lines(df: DataFrame, edits: int = 2, least: int = 24, id_col: str = "doc_id", text_col: str = "text", least_equal: int | None = None) -> DataFrame:
    """Every row with the lines removed that repeat an earlier one; ``removed`` has their numbers from 0.

    Classes are chains of lines that are equal or within ``edits`` edits, outer
    white space aside; of a class the line of the smallest (doc_id, number)
    stays. Lines under ``least`` characters are too short for two edits to mean a
    copy: from ``least_equal`` characters on (``least`` by default; the query and the
    pipeline give 1) they are removed where they equal an earlier line. Lines of
    white space alone are never removed. ``removed`` is empty, and the text unchanged,
    where nothing was removed.

    A null text stays null; an empty one empty; texts and lines are read whole,
    however long. Rows that repeat a doc_id count as one document: what is
    removed goes from all of them, and lines that only they share stay. Rows
    with a null doc_id are left as they are and give no lines. All input columns
    are returned; one named ``removed`` is replaced. An empty table stays empty.
    """
    docs = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))
    found = settle(occurrences(docs, least if least_equal is None else max(1, least_equal)))
    classes = settle(found.groupBy("id", "other").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n")))
    links = edit_links(docs, classes.select("id", "first.doc_id", "first.line"), edits, least)
    roots = settle(connected_components(links).withColumnRenamed("node", "id"))
    n_roots = roots.count()
    # Only lines that occur again, or have a close one, can go.
    rooted = settle(classes.join(small_or_shuffled(roots, n_roots * 16), "id", "left").where("n > 1 or root is not null"))
    merged = rooted.where("root is not null").groupBy("root").agg(F.min("first").alias("kept"))
    kept = rooted.join(merged, "root", "left").select("id", "other", F.coalesce("kept", "first").alias("kept"))
    extra = found.join(kept, ["id", "other"]).where(F.struct("doc_id", "line") != F.col("kept"))
    gone = settle(extra.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("_gone")).withColumnRenamed("doc_id", "_doc"))
    size = gone.agg(F.sum(F.size("_gone") * 4 + 24).alias("n")).first()["n"] or 0
    columns = [c for c in df.columns if c != "removed"]
    joined = df.select(*[F.col(f"`{c}`") for c in columns]).join(small_or_shuffled(gone, size), F.col(id_col) == F.col("_doc"), "left")
    rest = F.array_join(F.filter(F.split(text_col, "\n"), lambda _, i: ~F.array_contains("_gone", i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(rest).alias(text_col)
    return joined.select(*[text if c == text_col else F.col(f"`{c}`") for c in columns], F.coalesce("_gone", F.array().cast("array<int>")).alias("removed"))
