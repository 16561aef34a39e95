"""Language identification with bit-sliced Bloom filters of character n-grams.

Every language has a Bloom filter of the n-grams that it uses about as often as any language does. The filters are sliced by bit:
each position holds a mask of languages, so one lookup (an AND over the hash positions) returns all languages that contain an n-gram. Per
document, the masks' set bits are counted by language; counts are corrected for the filter's false positives, and the largest share
decides, ties by name.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Training rows with a null language are ignored. Without
any training row all texts are ``und``. Repeated rows are predicted each, and learnt from each. Whole texts of any length are read,
one at a time. An empty table gives an empty result. Only ``text_col`` is read for a prediction; :func:`predicted` keeps the other
columns, whatever they are called, but for one called ``as_col``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared, workers

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """Lower-case code point of each letter of the basic plane, 0 for anything else."""
    out = np.zeros(0x10000, np.uint32)
    for c in range(0x10000):
        if not 0xD800 <= c < 0xE000 and (x := chr(c)).isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _code_points(text: str, table: np.ndarray) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(c) and c.max() > 0xFFFF:
        c = np.where(c > 0xFFFF, np.fromiter((ord(x.lower()[0]) if (x := chr(v)).isalpha() else 0 for v in c), np.uint32, len(c)), table[np.minimum(c, 0xFFFF)])
    else:
        c = table[c]
    keep = np.ones(len(c), bool)  # one 0 for each run of others, and one at either end
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    return np.concatenate([[0], c[keep], [0]]).astype(np.uint64)


def ngrams(text: str | None, n: int, table: np.ndarray) -> np.ndarray:
    """64-bit hashes of the n-grams of letters and word ends of a whole text; empty if it has no letter."""
    c = _code_points(text or "", table)
    if not c.any():
        return np.empty(0, np.uint64)
    n = min(n, len(c))
    with np.errstate(over="ignore"):
        h = np.zeros(len(c) - n + 1, np.uint64)
        for i in range(n):
            h = (h + c[i : len(c) - n + 1 + i]) * _MIX
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


@dataclass
class Filters:
    """``words[i]`` holds the masks of languages 64 * i and on, one mask per position."""

    languages: list[str]
    words: np.ndarray
    n: int
    k: int

    @property
    def bits(self) -> int:
        return self.words.shape[1]

    def positions(self, h: np.ndarray) -> list[np.ndarray]:
        step = (h >> np.uint64(40)) | np.uint64(1)
        with np.errstate(over="ignore"):
            return [((h + np.uint64(i) * step) % np.uint64(self.bits)).astype(np.int64) for i in range(self.k)]

    def insert(self, language: int, h: np.ndarray) -> None:
        for p in self.positions(h):
            self.words[language // 64, p] |= np.uint64(1) << np.uint64(language % 64)

    def counts(self, h: np.ndarray) -> np.ndarray:
        """How many of the n-grams each language contains."""
        at = self.positions(h)
        out = []
        for w in range(len(self.words)):
            masks = self.words[w][at[0]]
            for p in at[1:]:
                masks &= self.words[w][p]
            out += [int(np.count_nonzero(masks & (np.uint64(1) << np.uint64(i)))) for i in range(min(64, len(self.languages) - 64 * w))]
        return np.array(out, float)

    def false_positives(self) -> np.ndarray:
        rates = [np.count_nonzero(self.words[i // 64] & (np.uint64(1) << np.uint64(i % 64))) / self.bits for i in range(len(self.languages))]
        return np.array(rates) ** self.k


def fit(
    docs: DataFrame, usable: Column | None = None, n: int = 3, k: int = 3, bits: int = 2**18, per_language: int = 4_000, least_share: float = 2e-5, near: float = 0.5, seed: int = 5,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Filters | None:
    """Fit on rows with a language for which ``usable`` holds; about ``per_language`` rows of each, by hash of their ids.

    An n-gram goes into a language's filter if its share of the language's n-grams is at least ``least_share`` and at least ``near``
    times its largest share in any language. So at most 1 / ``least_share`` n-grams per language come to the driver: 50,000 for
    each language, which grows with the languages and not with the texts.
    """
    shared.small_batches(docs.sparkSession)
    rows = docs.filter(F.col(lang_col).isNotNull())
    rows = rows.filter(usable) if usable is not None else rows
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sizes = shared.staged(rows.groupBy(F.col("lang").alias("l")).agg(F.count(F.lit(1)).alias("c")), "lang-sizes")
    rows = rows.join(shared.small_enough(sizes, 100_000), F.col("lang") == F.col("l"))
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(2**31)) / 2.0**31
    rows = rows.filter(draw < F.lit(float(per_language)) / F.col("c")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = _letters(), {}
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                grams, times = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(times, pa.int64())], ["lang", "gram", "c"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h = ngrams(text.as_py(), n, table)
                held.setdefault(lang, []).append(h)
                total += len(h)
                if total > 4_000_000:
                    yield from flush()
                    total = 0
        yield from flush()

    grams = shared.staged(rows.mapInArrow(workers.tidied(count), "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c")), "lang-ngrams")
    totals = grams.groupBy("lang").agg(F.sum("c").alias("total"))
    shares = grams.join(shared.small_enough(totals, 100_000), "lang").select("lang", "gram", (F.col("c") / F.col("total")).alias("share"))
    most = shares.groupBy("gram").agg(F.max("share").alias("most"))
    kept = shares.filter(F.col("share") >= least_share).join(most, "gram").filter(F.col("share") >= near * F.col("most"))
    got = kept.select("lang", "gram").toArrow()
    languages = sorted(set(got.column("lang").to_pylist()))
    if not languages:
        return None
    filters = Filters(languages, np.zeros((-(-len(languages) // 64), bits), np.uint64), n, k)
    lang, gram = np.array(got.column("lang").to_pylist()), got.column("gram").to_numpy().view(np.uint64)
    for i, name in enumerate(languages):
        filters.insert(i, gram[lang == name])
    return filters


def predicted(docs: DataFrame, filters: Filters | None, text_col: str = "text", as_col: str = "prediction") -> DataFrame:
    """``docs`` with a struct (lang, score) for every row; the score is the winner's part of all corrected counts."""
    known = docs.sparkSession.sparkContext.broadcast(filters)  # one mask per position: 2 MB for each 64 languages

    def predict(texts: pd.Series) -> pd.DataFrame:
        workers.drop()
        f = known.value
        table, lang, score = _letters_once(), [], []
        rates = f.false_positives() if f else None
        for text in texts:
            h = ngrams(text, f.n, table) if f else ()
            if not len(h):
                lang.append("und"), score.append(0.0)
                continue
            counts = np.maximum(0, (f.counts(h) - len(h) * rates) / np.maximum(1e-9, 1 - rates))
            best = int(counts.argmax())
            total = counts.sum()
            lang.append(f.languages[best]), score.append(float(counts[best] / total) if total else 0.0)
        return pd.DataFrame({"lang": lang, "score": score})

    return docs.withColumn(as_col, F.pandas_udf(predict, "lang string, score double")(F.col(text_col).cast("string")))


_TABLE: list[np.ndarray] = []


def _letters_once() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_letters())
    return _TABLE[0]
