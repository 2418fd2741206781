"""URL rules as one bit-parallel wildcard automaton.

Each rule becomes a glob over the canonical url ``.host/path`` (a dot, the
host, the path): ``*`` runs over characters other than ``/``, ``**`` over any.
All globs are laid side by side into the bits of a few 64-bit words. A
Shift-And step then moves every pattern at once for one byte, and numpy takes
that step for a whole batch of urls together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

Rule = tuple[str, str, str]
"""(verdict, host, path): for the host and its subdomains, paths that start with path."""


class GlobAutomaton:
    """Many globs over bytes at once: ``*`` is any run without ``/``, ``**`` any run."""

    def __init__(self, globs: list[str]):
        tokens: list[tuple[int, str | int]] = []  # (rule, byte or wildcard)
        for rule, glob in enumerate(globs):
            raw, i = glob.encode(), 0
            tokens.append((rule, "start"))
            while i < len(raw):
                wild = "**" if raw[i : i + 2] == b"**" else "*" if raw[i : i + 1] == b"*" else None
                tokens.append((rule, wild or raw[i]))
                i += len(wild) if wild else 1
        self.words = max(1, -(-len(tokens) // 64))
        self.step = np.zeros((256, self.words), np.uint64)  # may enter this state on the byte
        self.stay = np.zeros((256, self.words), np.uint64)  # wildcard states hold themselves
        self.free = np.zeros(self.words, np.uint64)  # wildcards are entered without a byte
        self.first = np.zeros(self.words, np.uint64)
        self.accept: list[tuple[int, np.uint64]] = [(0, np.uint64(0))] * len(globs)
        for at, (rule, token) in enumerate(tokens):
            word, bit = at // 64, np.uint64(1 << (at % 64))
            if token == "start":
                self.first[word] |= bit
            elif isinstance(token, str):
                self.free[word] |= bit
                self.stay[:, word] |= bit
                if token == "*":
                    self.stay[ord("/"), word] &= ~bit
            else:
                self.step[token, word] |= bit
            self.accept[rule] = (word, bit)

    def _shift(self, state: np.ndarray) -> np.ndarray:
        moved = state << np.uint64(1)
        moved[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return moved

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text, a column for each glob: whether it matches the whole text."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order])
        data = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
        state = np.tile(self.first, (len(texts), 1))
        state |= self._shift(state) & self.free
        live = len(texts)
        for at in range(int(lengths[0]) if len(texts) else 0):
            live = int(np.searchsorted(-lengths[:live], -at, side="left"))  # those with a byte at this place
            now, byte = state[:live], data[begins[:live] + at]
            now = (self._shift(now) & self.step[byte]) | (now & self.stay[byte])
            state[:live] = now | (self._shift(now) & self.free)
        out = np.zeros((len(texts), len(self.accept)), bool)
        for rule, (word, bit) in enumerate(self.accept):
            out[order, rule] = (state[:, word] & bit) != 0
        return out


def judge_urls(df: DataFrame, rules: list[Rule], default: str = "allow", url_col: str = "url") -> DataFrame:
    """Add host, path, rule (null if none fits) and verdict for each row's url.

    The rule that is longest as ``host + path`` wins; where equal rules are
    given twice, the first. A url that no rule fits gets ``default``.

    A null url, or one without ``://``, has an empty host and path, and no rule
    fits it. Rows are judged one by one, without a shuffle: repeated rows, hot
    hosts and empty tables need no care, and a long url costs its length. All
    input columns are returned; one with an output's name is replaced.
    """
    columns = df.columns
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    machine = GlobAutomaton([f"*.{h}{p}**" for _, h, p in rules])
    by_length = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), i))

    @F.pandas_udf("int")
    def winner(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            hit = machine.matches([x.encode() for x in batch])
            best = np.full(len(batch), -1)
            for i in reversed(by_length):
                best[hit[:, i]] = i
            yield pd.Series(best)

    judged = packed(df, _host=host, _path=path).withColumn("_won", winner(F.concat(F.lit("."), "_host", "_path")))
    names = F.array(*[F.lit(h + p) for _, h, p in rules]) if rules else F.array(F.lit(None).cast("string"))
    verdicts = F.array(*[F.lit(v) for v, _, _ in rules]) if rules else F.array(F.lit(None).cast("string"))
    pick = lambda choices: F.when(F.col("_won") >= 0, F.get(choices, F.col("_won")))
    return unpacked(judged, columns, host=F.col("_host"), path=F.col("_path"), rule=pick(names), verdict=F.coalesce(pick(verdicts), F.lit(default)))
