"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Vectors become sparse rows of integer weights, dealt into tiles. A candidate tile is turned into posting lists once (per term: the
positions in the tile and their weights); tiles of queries stream past them. Every term of a query scatters its weighted
postings into the query's dense score array over the candidate tile; a partition selection keeps each query's k best
of the tile, and these partial lists are merged. Tiles have a fixed size, so memory doesn't grow with the tables.

Rows whose vector is null, or holds a null or a component that isn't finite, take no part; vectors shorter than others have
zeros there, and very long ones cost in proportion to their components. Rows with a null id take no part. Repeated rows are candidates
each; as queries they give the same list once. Ties go to the smaller id. Empty tables give an empty result. Weights and scores must
fit 64-bit integers. Only the id and the vector are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared, workers

TILE_ROWS, TILE_QUERIES = 8192, 512
#: Tiles of queries that go past one set of posting lists; more of them get the lists again, in another task.
TILES_PER_LISTS = 8
#: Tasks at most; beyond, a task takes several candidate tiles, one after the other.
MOST_TASKS = 20_000


def quantised(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, weights): floor(scale * component), computed as double, of the rows that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
    return v.select("id", F.transform("v", lambda x: F.floor(x * float(scale)).cast("long")).alias("weights"))


def _tiles(rows: DataFrame, per_tile: int, name: str) -> tuple[DataFrame, int]:
    """Rows packed into tiles of about ``per_tile``, each one row (tile, ids, lengths, terms' weights one after the other)."""
    n = max(1, -(-rows.count() // per_tile))
    tile = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    packed = rows.groupBy(tile.alias("tile")).agg(F.collect_list(F.struct("id", "weights")).alias("rows"))
    sizes = F.transform("rows", lambda r: F.size(r["weights"]))
    return shared.staged(packed.select("tile", F.col("rows.id").alias("ids"), sizes.alias("sizes"), F.flatten(F.col("rows.weights")).alias("weights")), f"topk-{name}"), n


def _flat(column: pa.Array, i: int) -> np.ndarray:
    """The list at ``i`` as NumPy, without a Python object per value."""
    return column[i].values.to_numpy(zero_copy_only=False)


class Postings:
    """A tile's posting lists: per term, the positions of the rows that have it and their weights, all lists in one array each."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray):
        self.ids, self.width = ids, int(sizes.max(initial=0))
        ends = np.cumsum(sizes)
        at = np.repeat(np.arange(len(ids)), sizes)
        term = np.arange(len(weights)) - np.repeat(ends - sizes, sizes)
        solid = weights != 0
        order = np.argsort(term[solid], kind="stable")
        self.rows, self.weights = at[solid][order], weights[solid][order]
        self.starts = np.searchsorted(term[solid][order], np.arange(self.width + 1))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        cut = slice(self.starts[term], self.starts[term + 1])
        return self.rows[cut], self.weights[cut]


def score_tiles(queries: Postings, candidates: Postings, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, candidate ids, scores) of the k best candidates in a tile for each query, its own id excluded."""
    q_ids, c_ids = queries.ids, candidates.ids
    scores = np.zeros((len(q_ids), len(c_ids)), np.int64)
    for term in range(min(queries.width, candidates.width)):
        rows, w = queries.of(term)
        at, x = candidates.of(term)
        if not len(rows) or not len(at):
            continue
        if len(at) == len(c_ids):
            for r, v in zip(rows, w, strict=True):  # every candidate has the term: whole rows
                scores[r] += v * x
        else:
            for r, v in zip(rows, w, strict=True):
                scores[r, at] += v * x  # positions in a list are distinct
    out_q, out_c, out_s = [], [], []
    for i, own in enumerate(q_ids):
        s, valid = scores[i], np.flatnonzero(c_ids != own)
        if not len(valid):
            continue
        s = s[valid]
        if len(valid) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            keep = np.flatnonzero(s >= least)
        else:
            keep = np.arange(len(valid))
        ids = c_ids[valid[keep]]
        best = np.lexsort((ids, -s[keep]))[:k]
        out_q.append(np.full(len(best), own))
        out_c.append(ids[best])
        out_s.append(s[keep][best])
    if not out_q:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_s)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, tile_rows: int = TILE_ROWS, tile_queries: int = TILE_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best candidates. Both tables are (id, weights), as :func:`quantised` gives them.

    Each task gets a candidate tile once, builds its posting lists, and lets up to TILES_PER_LISTS tiles of queries stream past them.
    """
    shared.small_batches(candidates.sparkSession)
    c_tiles, n_c = _tiles(candidates, tile_rows, "candidates")
    q_tiles, n_q = _tiles(queries.distinct(), tile_queries, "queries")
    groups = -(-n_q // TILES_PER_LISTS)
    lists = c_tiles.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("q_tile", F.lit(None).cast("int"))
    q_tiles = q_tiles.select(F.col("tile").alias("q_tile"), F.floor(F.col("tile") / TILES_PER_LISTS).cast("int").alias("turn"), "ids", "sizes", "weights")
    past = q_tiles.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    columns = ["tile", "turn", "q_tile", "ids", "sizes", "weights"]
    dealt = lists.select(columns).unionByName(past.select(columns)).repartitionById(min(n_c * groups, MOST_TASKS), F.col("tile") * groups + F.col("turn"))
    dealt = dealt.sortWithinPartitions("tile", "turn", F.col("q_tile").asc_nulls_first())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, candidates_here = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                here = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                rows = Postings(*(_flat(batch.column(n), i) for n in (3, 4, 5)))
                if batch.column(2)[i].as_py() is None:
                    of, candidates_here = here, rows
                elif of == here:  # else the tile has no candidate
                    found = score_tiles(rows, candidates_here, k)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["query_id", "vec_id", "score"])

    best = dealt.mapInArrow(workers.tidied(score), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
