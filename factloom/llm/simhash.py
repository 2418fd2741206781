"""SimHash near-duplicates by the generalised pigeonhole principle.

Texts get a fingerprint of 64 bits. Two fingerprints within ``distance`` bits
of each other must, for any split of the bits into parts with thresholds t_i
where the sum of (t_i + 1) is distance + 1, agree within t_i bits on some part.
Bits that go together in the corpus are grouped into one part, and dynamic
programming chooses the thresholds (-1: not probed) for the fewest estimated
probes and candidates. A probe is a part's value with t_i of its bits blanked;
rows that share a probe are verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, small_or_shuffled, text_of
from .components import connected_components

BITS = 64
#: Cost of shuffling one probe, in verified pairs.
PROBE_COST = 200


def fingerprint(text: str, words: int) -> int:
    """The SimHash of the ``words``-word shingles of a text, as a signed 64-bit number."""
    import xxhash

    tokens = text.encode().lower().split()  # bytes: only A-Z and ASCII space
    if not tokens:
        return 0
    flat, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(tokens))
    hashes = np.array([digest(flat[a:b], 42) for a, b in zip(starts[: len(tokens) - k + 1].tolist(), ends[k - 1 :].tolist())], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; a text without words, or null, has fingerprint 0."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, words) for t in batch], dtype="int64")

    return df.select(F.col(id_col).cast("long").alias("doc_id"), hashed(text_of(text_col)).alias("fp"))


def pair_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and a 64 x 64 table of how many have bits i and j both set."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        if n:
            i, j = np.indices((BITS, BITS))
            rows = {"i": np.append(i.ravel(), -1), "j": np.append(j.ravel(), -1), "n": np.append(total.ravel(), n).astype(np.int64)}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in rows.items()})

    found = fps.select("fp").mapInArrow(counted, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    table, n = np.zeros((BITS, BITS)), 0
    for r in found:
        if r["i"] < 0:
            n = r["n"]
        else:
            table[r["i"], r["j"]] = r["n"]
    return n, table


def grouped_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of like size, each grown by the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    related = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(free, key=lambda b: (related[b, list(free)].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: (related[b, group].sum(), -b)))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def close_share(p: np.ndarray, most: int) -> np.ndarray:
    """Estimated share of pairs that differ in at most 0, 1, ... ``most`` of bits set with chance p."""
    law = np.zeros(most + 1)
    law[0] = 1
    for differs in 2 * p * (1 - p):
        law = law * (1 - differs) + np.append(0, law[:-1]) * differs
    return np.cumsum(law)


def plan_parts(n: int, together: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to probe, of least estimated cost over 2 to distance + 3 parts."""
    p, best = np.diag(together) / max(n, 1), (np.inf, [])
    for parts in range(2, distance + 4):
        groups = grouped_bits(n, together, parts)
        cost = []
        for bits in groups:
            share = close_share(p[bits], 2)
            cost.append([0.0] + [n * comb(len(bits), t) * PROBE_COST + n * n / 2 * share[t] for t in range(3)])
        # table[s]: least cost of the parts so far whose (t_i + 1) add up to s
        table, chosen = [0.0] + [np.inf] * (distance + 1), [[]] + [None] * (distance + 1)
        for c in cost:
            step = [min(((table[s - u] + c[u], u) for u in range(min(s, 3) + 1)), key=lambda x: x[0]) for s in range(distance + 2)]
            chosen = [None if not np.isfinite(v) else [*chosen[s - u], u] for s, (v, u) in enumerate(step)]
            table = [v for v, _ in step]
        if table[-1] < best[0]:
            best = (table[-1], [(bits, u - 1) for bits, u in zip(groups, chosen[-1]) if u])
    return best[1]


def probe_masks(plan: list[tuple[list[int], int]]) -> list[tuple[int, int]]:
    """(part, mask) of every probe: the bits of a part but for t of them."""
    out = []
    for part, (bits, t) in enumerate(plan):
        whole = sum(1 << b for b in bits)
        out += [(part, whole & ~sum(1 << b for b in blank)) for blank in combinations(bits, t)]
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bits_apart(a: np.ndarray, b: np.ndarray | np.int64) -> np.ndarray:
    """In how many of their 64 bits signed numbers differ (numpy counts the bits of absolute values)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(fp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the values within ``distance`` bits of each other."""
    links, rest = [], np.unique(fp)
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = bits_apart(rest, at) <= distance
            if near.any():
                found = rest[near].tolist()
                links += [(int(at), x) for x in found]
                queue += [np.int64(x) for x in found]
                rest = rest[~near]
    return links


def _verified(distance: int):
    """Arrow batches sorted by probe -> links; a probe's rows are verified together."""

    def small(key: np.ndarray, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at, gap = np.arange(len(fp)), 1
        while True:
            at = at[at + gap < len(fp)]
            at = at[(key[at] == key[at + gap]).all(axis=1)]
            if not len(at):
                return
            close = at[(bits_apart(fp[at], fp[at + gap]) <= distance) & (fp[at] != fp[at + gap])]
            yield fp[close], fp[close + gap]
            gap += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            cut = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
            sizes = np.diff(np.append(cut, len(fp)))
            found = [np.array(forest(fp[a : a + n], distance), np.int64).reshape(-1, 2) for a, n in zip(cut[sizes > 64], sizes[sizes > 64])]
            few = np.repeat((sizes > 1) & (sizes <= 64), sizes)
            found += [np.stack(x, axis=1) for x in small(key[few], fp[few])]
            if out := [x for x in found if len(x)]:
                both = np.unique(np.sort(np.concatenate(out), axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        held: list[np.ndarray] = []
        count = 0
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1))
            count += len(held[-1])
            if count < 1 << 17:
                continue
            rows = np.concatenate(held)
            same = (rows[:, :-1] == rows[-1, :-1]).all(axis=1)
            last = int(np.argmax(same))  # the last probe may go on in the next batch
            yield from links(rows[:last, :-1], rows[:last, -1])
            held, count = [rows[last:]], 0
        if held:
            rows = np.concatenate(held)
            yield from links(rows[:, :-1], rows[:, -1])

    return run


def hamming_links(fps: DataFrame, distance: int = 4, block: int = 4096) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints ``fp`` that chains of close ones connect.

    Probes with up to ``block`` rows are verified by one task. The rows of a
    larger one are dealt into blocks, and every pair of blocks meets somewhere.
    """
    n, together = pair_counts(fps)
    plan = plan_parts(max(n, 1), together, distance)
    probes = F.explode(F.array(*[F.struct(F.lit(k).alias("slot"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("value")) for k, (_, mask) in enumerate(probe_masks(plan))]))
    # A blanked value has at most the rows of the part's values that it stands for: few parts' values need counting.
    masks = probe_masks(plan)
    whole = [sum(1 << b for b in bits) for bits, _ in plan]
    values = fps.select(F.explode(F.array(*[F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for k, m in enumerate(whole)])).alias("x")).groupBy("x.part", "x.v").count()
    hot_values = settle(values.where(F.col("count") > block // 4))  # up to two blanked bits join up to four values
    heavy = hot_values.select(F.explode(F.array(*[F.struct(F.lit(k).alias("slot"), F.lit(part).alias("part"), F.col("v").bitwiseAND(F.lit(_signed(mask))).alias("value")) for k, (part, mask) in enumerate(masks)])).alias("x"), "part", "count").where("x.part = part").groupBy("x.slot", "x.value").agg(F.sum("count").alias("rows"))
    heavy = settle(heavy.where(F.col("rows") > block).withColumn("blocks", F.ceil(F.col("rows") / F.lit(block // 2)).cast("long")).drop("rows"))
    n_heavy = heavy.count()
    rows = fps.select(probes.alias("x"), "fp").select("x.slot", "x.value", "fp")
    if n_heavy:
        rows = rows.join(small_or_shuffled(heavy, n_heavy * 24), ["slot", "value"], "left")
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("long")
        pairs = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda t: F.least(t, own) * (1 << 31) + F.greatest(t, own)))
        rows = rows.select("slot", "value", F.explode(pairs).alias("pair"), "fp")
    else:
        rows = rows.select("slot", "value", F.lit(0).cast("long").alias("pair"), "fp")
    dealt = rows.repartition("slot", "value", "pair").sortWithinPartitions("slot", "value", "pair")
    return dealt.mapInArrow(_verified(distance), "a long, b long")


def simhash_groups(df: DataFrame, words: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp, component_id (the smallest doc_id that links reach).

    Null and empty texts have fingerprint 0 and are linked like any other; very
    long texts are hashed whole; repeated rows and equal texts share a
    fingerprint and so a component. A null doc_id never names a component that
    has another; an empty table gives an empty result. Other columns are not
    read.
    """
    hashed = settle(fingerprints(df, words, id_col, text_col))
    distinct = settle(hashed.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = connected_components(hamming_links(distinct.select("fp"), distance))
    labelled = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    # Settled: with an exchange of its own on either side, the join can split a component that fills the corpus.
    least = settle(labelled.groupBy("root").agg(F.min("rep").alias("component_id")))
    named = labelled.join(least, "root").select("fp", "component_id")
    return hashed.join(named, "fp").select("doc_id", "fp", "component_id")
