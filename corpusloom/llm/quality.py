"""A quality classifier by compression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.runtime import discard, materialize, ship

#: Every text is compressed in blocks of so many bytes, so that the dictionary counts all along a long text.
BLOCK = 512


@dataclass(frozen=True)
class CompressionModel:
    """Two zstandard dictionaries and the calibration of the difference they make."""

    good: bytes
    bad: bytes
    weights: tuple[float, float]
    level: int = 3

    def compressors(self):
        import zstandard as z

        out = []
        for raw in (self.good, self.bad):
            d = z.ZstdCompressionDict(raw)
            d.precompute_compress(level=self.level)
            out.append(z.ZstdCompressor(level=self.level, dict_data=d, write_content_size=False, write_dict_id=False).compress)
        return out

    def scores(self, texts) -> np.ndarray:
        """Probability of label 1 for each text (None: empty)."""
        x = features(texts, *self.compressors())
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))


def features(texts, good, bad) -> np.ndarray:
    """1 and the normalised compressed-size difference: per cent of a text's bytes that the good dictionary saves beyond the bad one."""
    out = np.zeros((len(texts), 2))
    out[:, 0] = 1
    for i, t in enumerate(texts):
        raw = (t or "").encode("utf-8", "surrogatepass")
        saved = 0
        for a in range(0, len(raw), BLOCK):
            part = raw[a : a + BLOCK]
            saved += len(bad(part)) - len(good(part))
        out[i, 1] = 100 * saved / max(1, len(raw))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Newton's method for a ridge logistic fit in which both labels weigh alike."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - ridge * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(good: list[str], bad: list[str], dict_bytes: int = 110 << 10, level: int = 3, seed: int = 3) -> CompressionModel:
    """Dictionaries from two thirds of each list, calibration on the rest, which no dictionary has seen.

    With too few texts to train a dictionary the texts themselves are the dictionary; without a label's texts every score is that of the prior.
    """
    import zstandard as z

    rng = np.random.default_rng(seed)
    sets, rest = [], []
    for texts in (good, bad):
        order = rng.permutation(len(texts))
        cut = max(1, len(order) * 2 // 3) if len(order) else 0
        raw = [texts[i].encode("utf-8", "surrogatepass") for i in order[:cut]]
        parts = [x[a : a + BLOCK] for x in raw for a in range(0, len(x), BLOCK)]
        try:
            sets.append(z.train_dictionary(dict_bytes, parts).as_bytes())
        except z.ZstdError:
            sets.append((b"".join(parts) or b" " * 8)[:dict_bytes].ljust(8))
        rest.append([texts[i] for i in order[cut:]] or [texts[i] for i in order[:cut]])
    if not good or not bad:
        return CompressionModel(*sets, ((4.0 if good else -4.0) if good or bad else 0.0, 0.0), level)
    model = CompressionModel(*sets, (0.0, 0.0), level)
    comps = model.compressors()
    x = np.concatenate([features(t, *comps) for t in rest])
    y = np.concatenate([np.ones(len(rest[0])), np.zeros(len(rest[1]))])
    return CompressionModel(*sets, tuple(_logistic(x, y).tolist()), level)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    per_label: int = 2_000,
    longest: int = 200_000,
    most_bytes: int = 64 << 20,
) -> CompressionModel:
    """Fit on a bounded sample of the labelled rows for which ``usable`` (a condition on labels) holds.

    Bounds: of each label the ``per_label`` labelled ids of smallest hash; of these the texts of up to ``longest`` UTF-8 bytes, in order of the hash while they are together
    at most half of ``most_bytes``, which is what the driver gets. Of documents of one id the smallest text counts. A document with two labels counts under both. Scoring is not bounded.
    """
    picked = None
    for value in (1, 0):
        ids = labels.where(usable & (F.col(label_col) == value)).select(F.col(id_col).alias("lid")).distinct()
        some = ids.orderBy(F.xxhash64("lid"), "lid").limit(per_label).select("lid", F.lit(value).alias("label"))
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(F.col(id_col).alias("lid"), F.col(text_col).alias("text")).where(F.octet_length("text") <= longest)
    met = texts.join(F.broadcast(picked), "lid").groupBy("lid", "label").agg(F.min("text").alias("text"))
    sample = materialize(met.withColumn("bytes", F.octet_length("text")), "quality-sample")
    upto = Window.partitionBy("label").orderBy(F.xxhash64("lid"), "lid").rowsBetween(Window.unboundedPreceding, 0)
    short = sample.select("lid", "label", F.sum("bytes").over(upto).alias("upto")).where(F.col("upto") <= most_bytes // 2)
    rows = sample.join(F.broadcast(short), ["lid", "label"]).orderBy("lid").select("label", "text").collect()
    discard(sample)
    return train([r["text"] for r in rows if r["label"] == 1], [r["text"] for r in rows if r["label"] == 0])


def score_quality(df: DataFrame, model: CompressionModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the score of every whole text in ``out`` (a column of that name is replaced). Null texts count as empty; an empty text gets the score of no evidence."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(text.tolist()))

    return df.withColumn(out, score(F.col(text_col)))
