"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics come from whole texts: byte-class shares, word, line and repetition measures; no id, language or source is among them.
Labelled rows (at most ``max_labelled``, the smallest hashes of their ids) are split by hash: four fifths fit the ridge
through normal equations that each partition sums for its rows, one fifth fits the isotonic steps on a histogram of scores.

Whole texts of any length are read, one at a time. Nulls: a null text is the empty text; label rows with a null id or label are
ignored; an id that is labelled more than once counts with the mean of its labels. Repeated rows are scored each, and a labelled
id that comes more than once is learnt from each of its rows. Without any label every score is 0.5. An empty table gives an empty
result. Other columns are kept by :func:`scored`; ``as_col`` replaces a column of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared, workers

_CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,", b"!?", b"$%&#*+=~^", b"|<>{}[]\\/_@", b"'\"()-:;", b"\n\r", b" \t\x0b\x0c", bytes(range(128, 256)), bytes([*range(0, 9), *range(14, 32), 127]),
]
_TABLE = np.zeros((256, len(_CLASSES)))
for _i, _c in enumerate(_CLASSES):
    _TABLE[list(_c), _i] = 1
_END = re.compile(rb"[.!?]\s")
N_STATS = len(_CLASSES) + 12


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text; all are bounded shares or logarithms."""
    raw = (text or "").encode("utf-8", "replace")
    n = max(1, len(raw))
    shares = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _TABLE) / n
    words = raw.split()
    w = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct, distinct_lines = len(set(words)), len(set(lines))
    pairs = len(set(zip(words, words[1:], strict=False)))
    upper = sum(1 for x in words if x.isupper()) / w
    marked = sum(1 for x in words if not x[-1:].isalnum() and x[-1] < 128 and x[-1:] not in b".,;:!?)\"'") / w
    more = [
        np.log1p(len(raw)) / 12, np.log1p(len(words)) / 10, sizes.mean() / 10, sizes.std() / 10, sizes.max() / 100 if sizes.max() < 100 else 1.0,
        distinct / w, pairs / w, 1 - distinct_lines / max(1, len(lines)), np.log1p(w / max(1, len(lines))) / 8, upper, marked, len(_END.findall(raw)) / w,
    ]
    return np.concatenate([np.sqrt(shares), more])


def label_bucket(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


@dataclass
class Model:
    """Standardisation, Fourier features, ridge weights and calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    base: float
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.sqrt(2 / len(self.b)) * np.cos(np.clip(z, -6, 6) @ self.w + self.b)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.features(x) @ self.beta

    def score(self, texts) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        out = [self.raw(np.stack([statistics(t) for t in texts[at : at + 512]])) for at in range(0, len(texts), 512)]
        return np.clip(np.interp(np.concatenate(out), self.knots, self.values), 0, 1)


def pool_adjacent(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted isotonic (non-decreasing) regression of ``y``."""
    level: list[list[float]] = []
    for value, w in zip(y, weight, strict=True):
        level.append([value, w, 1])
        while len(level) > 1 and level[-2][0] >= level[-1][0]:
            v2, w2, n2 = level.pop()
            v1, w1, n1 = level[-1]
            level[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(n, v) for v, _, n in level]) if level else np.empty(0)


def _sums(rows: DataFrame, make, width: int) -> np.ndarray:
    """Sum of per-partition matrices that ``make`` returns for (statistics, labels); summed row by row on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = make(np.array(batch.column(0).to_pylist()), np.array(batch.column(1).to_pylist()))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel(), pa.float64())], ["i", "j", "v"])

    # Decimals add up to the same sum in whatever order partitions come.
    parts = rows.select("x", "y").mapInArrow(workers.tidied(run), "i int, j int, v double")
    got = parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,12)")).cast("double").alias("v")).toArrow()
    out = np.zeros((width, width))
    out[got.column("i").to_numpy(), got.column("j").to_numpy()] = got.column("v").to_numpy()
    return out


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, n_features: int = 192, gamma: float = 0.02, ridge: float = 1e-4, max_labelled: int = 20_000, bins: int = 2048,
    seed: int = 11, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Model | None:
    """Fit on the labelled rows for which ``usable`` (a condition on ``id_col``) holds; None without labels."""
    shared.small_batches(docs.sparkSession)
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.filter(usable) if usable is not None else known
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.avg(F.col(label_col).cast("double")).alias("__y"))
    known = shared.staged(known, "quality-labels")
    part = max_labelled * 1.1 / max(1, known.count())
    order = F.pmod(F.xxhash64("__id", F.lit(seed)), F.lit(2**31))
    if part < 1:
        known = known.filter(order < int(part * 2**31))
    known = known.orderBy(order, "__id").limit(max_labelled)  # the bounded sample of labelled rows

    def stats(texts: pd.Series) -> pd.Series:
        workers.drop()
        return pd.Series([statistics(t) for t in texts])

    rows = docs.select(F.col(id_col).alias("__key"), F.col(text_col).cast("string").alias("__text")).join(F.broadcast(known), F.col("__key") == F.col("__id"))
    rows = rows.select(F.pandas_udf(stats, "array<double>")("__text").alias("x"), F.col("__y").alias("y"), (F.pmod(F.xxhash64("__key", F.lit(seed + 1)), F.lit(5)) == 0).alias("calibrates"))
    rows = shared.staged(rows, "quality-statistics")

    first = _sums(rows, lambda x, y: (e := np.column_stack([np.ones(len(x)), x])).T @ e, N_STATS + 1)
    n = first[0, 0]
    if not n:
        return None
    mean = first[0, 1:] / n
    scale = np.sqrt(np.maximum(np.diag(first)[1:] / n - mean**2, 1e-6))
    rng = np.random.Generator(np.random.PCG64(seed))
    w = rng.normal(0, np.sqrt(2 * gamma), (N_STATS, n_features))
    model = Model(mean, scale, w, rng.uniform(0, 2 * np.pi, n_features), np.zeros(n_features), 0.0, np.array([0.0, 1.0]), np.array([0.5, 0.5]))

    def normal_equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        e = np.column_stack([model.features(x), np.ones(len(x)), y])
        return e.T @ e

    fitting = rows.filter("not calibrates")
    fitting = fitting if not fitting.isEmpty() else rows
    g = _sums(fitting, normal_equations, n_features + 2)
    a = g[: n_features + 1, : n_features + 1] + ridge * g[n_features, n_features] * np.diag([1.0] * n_features + [0.0])
    solved = np.linalg.lstsq(a, g[: n_features + 1, -1], rcond=None)[0]
    model.beta, model.base = solved[:-1], float(solved[-1])

    # Calibration: labels summed over a histogram of scores, then pooled. One pseudo-label of the mean keeps ends off 0 and 1.
    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = model.raw(np.array(batch.column(0).to_pylist()))
                bucket = np.clip(((s + 0.5) / 2 * bins).astype(np.int64), 0, bins - 1)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(s), batch.column(1)], ["bucket", "s", "y"])

    held = rows.filter("calibrates")
    held = held if not held.isEmpty() else rows
    mean_of = lambda c: (F.sum(F.col(c).cast("decimal(38,12)")).cast("double") / F.count(F.lit(1))).alias(c)
    h = held.select("x", "y").mapInArrow(workers.tidied(histogram), "bucket long, s double, y double")
    h = h.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), mean_of("s"), mean_of("y")).orderBy("bucket").toArrow()
    count, s, y = (h.column(c).to_numpy() for c in ("n", "s", "y"))
    model.knots, model.values = s, pool_adjacent((y * count + 0.01 * y.mean()) / (count + 0.01), count + 0.01)
    return model


def scored(docs: DataFrame, model: Model | None, text_col: str = "text", as_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row."""
    if model is None:
        return docs.withColumn(as_col, F.lit(0.5))

    def score(texts: pd.Series) -> pd.Series:
        workers.drop()
        return pd.Series(model.score(texts.tolist()))

    return docs.withColumn(as_col, F.pandas_udf(score, "double")(F.col(text_col).cast("string")))
