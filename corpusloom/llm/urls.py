"""URL filters by a bit-parallel wildcard automaton."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import ship


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains and a path prefix. ``host`` and ``path`` may hold globs: ``*`` any run (in a host: without /), ``?`` one character."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _glob(host: str, path: str) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """Positions of a pattern over a canonical url ``\\0.host/path``: (bytes that go forward, bytes that stay after it)."""
    every = np.ones(256, bool)
    in_host = every.copy()
    in_host[ord("/")] = False

    def one(b: int) -> np.ndarray:
        x = np.zeros(256, bool)
        x[b] = True
        return x

    out: list[list] = [[one(0), in_host]]  # the start, and any labels of subdomains after it
    for text, stay in ((b"." + host.encode(), in_host), (path.encode(), every)):
        for b in text:
            if b == ord("*"):
                out[-1][1] = stay
            else:
                out.append([stay if b == ord("?") else one(b), None])
    return out


class ShiftAnd:
    """All patterns side by side in words of 64 bits.

    Bit i stands for "positions up to i have matched". A byte c moves every state forward by a shift, ANDs with the
    mask of the positions that take c, and keeps states that may stay on c (wildcards). A pattern fits when its last bit has ever been set: rules match prefixes of the path.
    """

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        cells = [_glob(r.host.lower(), r.path) for r in rules]
        n = sum(map(len, cells))
        self.words = max(1, -(-n // 64))
        go, stay = np.zeros((256, self.words * 64), bool), np.zeros((256, self.words * 64), bool)
        start, final, at = np.zeros(self.words * 64, bool), [], 0
        for cell in cells:
            start[at] = True
            for forward, stays in cell:
                go[:, at] = forward
                if stays is not None:
                    stay[:, at] = stays
                at += 1
            final.append(at - 1)
        self.go, self.stay, self.start = self._pack(go), self._pack(stay), self._pack(start[None])[0]
        self.final = np.array(final, np.int64)
        # a shift must not carry a pattern's last bit into the next pattern: that bit is a start, which `go` takes only at the first byte
        self.inner = ~self.start

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits.reshape(len(bits), self.words, 64), axis=2, bitorder="little").view("<u8").reshape(len(bits), self.words).astype(np.uint64)

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """(url, rule) -> fits."""
        n = len(urls)
        size = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-size, kind="stable")
        sorted_size = size[order]
        flat = np.frombuffer(b"".join(urls), np.uint8)
        begin = (np.cumsum(size) - size)[order]
        state, ever = np.zeros((n, self.words), np.uint64), np.zeros((n, self.words), np.uint64)
        one, top = np.uint64(1), np.uint64(63)
        for t in range(int(sorted_size[0]) if n else 0):
            live = int(np.searchsorted(-sorted_size, -t, side="left"))  # urls longer than t
            if not live:
                break
            c = flat[begin[:live] + t]
            s = state[:live]
            if t == 0:
                moved = np.broadcast_to(self.start, s.shape)
            else:
                moved = s << one
                moved[:, 1:] |= s[:, :-1] >> top
                moved &= self.inner
                if not s.any():
                    break
            state[:live] = s = (moved & self.go[c]) | (s & self.stay[c])
            ever[:live] |= s
        hit = (ever[:, self.final // 64] >> (self.final % 64).astype(np.uint64)) & one
        out = np.zeros((n, len(self.rules)), bool)
        out[order] = hit.astype(bool)
        return out

    def best(self, hosts: list[str], paths: list[str]) -> list[int]:
        """Index of the longest rule that fits each url, -1 for none (ties: the first rule)."""
        urls = [f"\0.{h}{p}".encode("utf-8", "surrogatepass") for h, p in zip(hosts, paths)]
        fits = self.matches(urls)
        if not self.rules:
            return [-1] * len(urls)
        length = np.array([len(r.name) for r in self.rules])
        weight = np.where(fits, length[None], -1)
        best = weight.argmax(1)
        return np.where(weight.max(1) >= 0, best, -1).tolist()


def canonical(url):
    """(host, path): host after the first :// up to / ? # or the end, A-Z lower-cased; path then up to ? or #. Null or no ://: both empty."""
    rest = F.when(F.contains(url, F.lit("://")), F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def judge_urls(df: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow", batch_rows: int = 4096) -> DataFrame:
    """``df`` with host, path, rule and verdict (columns of these names are replaced). Every row keeps its place; nothing is shuffled.

    All rules run at once over a url's bytes; of those that fit, the longest (host and path together) decides, and ``default`` where none does.
    Null and malformed urls fit no rule. Rules are data of the operator and travel with the task.
    """
    named = df.select(F.col(url_col).alias("url"), F.struct(*[F.col(c) for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]).alias("row"))
    host, path = canonical(F.col("url"))
    split = named.select("row", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rules = list(rules)
    ship(df.sparkSession)

    @F.pandas_udf("int")
    def which(h: pd.Series, p: pd.Series) -> pd.Series:
        automaton = ShiftAnd(rules)
        hs, ps, out = h.tolist(), p.tolist(), []
        for a in range(0, len(hs), batch_rows):
            out += automaton.best(hs[a : a + batch_rows], ps[a : a + batch_rows])
        return pd.Series(out, dtype="int32")

    judged = split.withColumn("k", which("host", "path"))
    names, verdicts = F.lit([r.name for r in rules] or [""]), F.lit([r.verdict for r in rules] or [""])
    hit = F.col("k") >= 0
    return judged.select(
        "row.*",
        "host",
        "path",
        F.when(hit, F.get(names, F.col("k"))).alias("rule"),
        F.when(hit, F.get(verdicts, F.col("k"))).otherwise(F.lit(default)).alias("verdict"),
    )
