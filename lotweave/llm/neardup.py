"""Near-duplicate groups: MinHash bands, sequential Bayesian verification, exact verification, components.

1. Each document's set of word shingles gives a 128-bit fingerprint, band keys and one byte of each of its minima.
2. Equal sets collapse to their smallest id. Only these representatives go on.
3. In each band bucket all members are compared with its smallest member, which is one pair per member. The components of the
   links found there mean that copies of one text needn't be compared with each other any more. While many pairs remain, further
   members are drawn as hubs: near copies that miss one hub meet another, so a large group never shows all its pairs.
4. Buckets that still hold several components, wide ones after being dealt again by longer bands, are compared in blocks of bounded size, hub's
   component against the others and the others among themselves, within Python; only pairs that survive leave the worker.
5. In both steps pairs go through batches of signature bytes. After each batch the posterior of the similarity (uniform prior)
   is known; a pair is pruned when the probability that it reaches the threshold falls below ``miss``.
6. Survivors are verified on full shingle sets; the links' components give each document its smallest reachable id.

Shingles are compared by 64-bit hashes, in the counts and in the exact step too: two different shingles of a pair are taken for one with a
probability of about 1e-12 for texts of some thousand words. Whole texts of any length are read; the longest step holds one set of each
side. Nulls: a null or empty text has an empty set and is linked with nothing; a null id is linked with nothing either. Rows that
share an id count as one document. Repeated rows are copies. An empty table gives an empty result. Only ``id_col`` and ``text_col`` are
read, other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, shingles, workers

#: Ids are joined by broadcast up to this many rows (8 bytes each, some 32 once hashed).
MAX_BROADCAST_IDS = 250_000
#: Links, or rows of a table about them, in one file of a round of the components.
LINKS_PER_FILE = 200_000


@dataclass(frozen=True)
class Plan:
    """``share`` is the similarity from which documents are linked, as a fraction of integers (85, 100).

    26 bands of 5 rows miss a pair at similarity 0.85 with probability 2.4e-7. ``miss``: probability at which a batch may prune
    a pair that reaches the threshold. Buckets that still hold more than ``wide`` documents of several components are dealt again by
    ``sub_bands`` bands of ``sub_rows`` signature bytes: a pair at 0.85 that only meets in such buckets is missed with probability
    1.1e-5 there, about as much as one batch may prune. Buckets get further hubs, ``rehubs`` at most, while more than ``direct`` pairs are left and
    hubs still settle a fifth of them. ``block`` and ``per_set`` only bound what is compared at once.
    """

    width: int = 5
    share: tuple[int, int] = (85, 100)
    bands: int = 26
    rows: int = 5
    hashes: int = 384
    batch: int = 64
    miss: float = 1e-5
    seed: int = 7
    block: int = 256
    per_set: int = 64
    direct: int = 200_000
    rehubs: int = 8
    wide: int = 1024
    sub_bands: int = 36
    sub_rows: int = 8

    def least_matches(self) -> list[tuple[int, int]]:
        """(n, least matches among the first n hashes with which a pair goes on) after each batch.

        With a uniform prior the posterior after m matches of n is Beta(m + 1, n - m + 1), whose mass above t equals the
        probability that at most m of n + 1 trials with probability t succeed.
        """
        t = self.share[0] / self.share[1]
        out = []
        for n in range(self.batch, self.hashes + 1, self.batch):
            below, m = 0.0, -1
            while below < self.miss and m < n:
                m += 1
                below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            out.append((n, m))
        return out


def signatures(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, print, bands, bytes) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = workers.kept("words", shingles.WordHashes)
        a, b = shingles.coefficients(plan.hashes, plan.seed)
        edges = [(i * plan.rows, (i + 1) * plan.rows) for i in range(plan.bands)]
        for batch in batches:
            n, prints, bands, low = [], [], [], []
            for text in batch.column(1):
                s = shingles.shingle_set(text.as_py(), plan.width, words)
                n.append(len(s))
                if not len(s):
                    prints.append(None), bands.append(None), low.append(None)
                    continue
                sig = shingles.signature(s, a, b)
                prints.append(shingles.fingerprint(s))
                bands.append([xxhash.xxh3_64_intdigest(sig[x:y].tobytes(), seed=x) - 2**63 for x, y in edges])
                low.append((sig & np.uint32(255)).astype(np.uint8).tobytes())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "print", "bands", "bytes"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(workers.tidied(run), "doc_id long, n_shingles long, print binary, bands array<long>, bytes binary")


def _of(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids`` (one column)."""
    return df.join(shared.small_enough(ids.toDF("__id"), MAX_BROADCAST_IDS), F.col(key) == F.col("__id"), "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("a").union(pairs.select("b")).distinct()


def _bayes(pairs: DataFrame, sigs: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) that no batch of signature bytes prunes."""
    low = _of(sigs, _ends(pairs)).select("doc_id", "n_shingles", "bytes")
    left, right = low.toDF("a", "a_n", "a_bytes"), low.toDF("b", "b_n", "b_bytes")
    both = pairs.join(left, "a").join(right, "b").filter(_sizes_allow(F.col("a_n"), F.col("b_n"), plan)).select("a", "b", "a_bytes", "b_bytes")
    least = plan.least_matches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, plan.hashes) for i in (2, 3))
            alive, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, m in least:
                matches = matches + (x[alive, done:n] == y[alive, done:n]).sum(1)
                keep = matches >= m
                alive, matches, done = alive[keep], matches[keep], n
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(alive)), batch.column(1).take(pa.array(alive))], ["a", "b"])

    return both.mapInArrow(workers.tidied(run), "a long, b long")


def _sizes_allow(x, y, plan: Plan):
    """Sets whose sizes differ more can't reach the threshold."""
    return F.least(x, y) * plan.share[1] >= F.greatest(x, y) * plan.share[0]


def _exact(pairs: DataFrame, docs: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """Pairs (a, b) that reach the threshold on full shingle sets, which are made again for their documents only.

    A set is as long as its text, so pairs are met by their first end: its set comes once for every ``Plan.per_set`` partners, followed by theirs,
    one at a time.
    """
    wanted = _of(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), _ends(pairs))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = workers.kept("words", shingles.WordHashes)
        for batch in batches:
            out = [shingles.shingle_set(t.as_py(), plan.width, words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "s"])

    made = shared.staged(wanted.mapInArrow(workers.tidied(sets), "doc_id long, s binary"), "near-sets")
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / plan.per_set).alias("salts"))
    salted = pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")))
    partners = salted.join(made.toDF("b", "s"), "b").select("a", "salt", "b", "s")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    firsts = salts.select("a", each.alias("salt")).join(made.toDF("a", "s"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "s")
    rows = firsts.unionByName(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    part, whole = plan.share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, firsts = None, []  # several sets where rows share an id
        for batch in batches:
            good_a, good_b = [], []
            for a, salt, b, s in zip(*(batch.column(i) for i in range(4)), strict=True):
                here, b, s = (a.as_py(), salt.as_py()), b.as_py(), np.frombuffer(s.as_py(), np.uint64)
                if of != here:
                    of, firsts = here, []
                if b is None:
                    firsts.append(s)
                    continue
                for first in firsts:
                    common = len(np.intersect1d(first, s, assume_unique=True))
                    if whole * common >= part * (len(first) + len(s) - common):
                        good_a.append(here[0]), good_b.append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(good_a, pa.int64()), pa.array(good_b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(workers.tidied(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every id in ``links`` (a, b); label is the smallest id that it reaches.

    Each round every label hooks to its smallest neighbour, chains are shortened by pointer jumping, and links are rewritten to labels; links
    within a label go. A label that isn't the least among its neighbours vanishes, so rounds grow with the logarithm. Tables shrink from round to
    round, and get as many files as their links need.
    """
    edges = shared.staged(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links")
    n = edges.count()
    put = lambda df, name, n: shared.staged(df.coalesce(max(1, -(-n // LINKS_PER_FILE))), name)
    nodes = 2 * n
    labels = put(_ends(edges).select(F.col("a").alias("id"), F.col("a").alias("label")), "cc-labels", nodes)
    while n:
        parents = edges.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("p"))
        parents = put(parents, "cc-parents", n)  # every p is less than its x: a forest
        while True:
            up = parents.select(F.col("x").alias("px"), F.col("p").alias("pp"))
            jumped = parents.join(up, F.col("p") == F.col("px"), "left").select("x", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved"))
            jumped = put(jumped, "cc-jump", n)
            parents = jumped.select("x", "p")
            if jumped.filter("moved").isEmpty():
                break
        labels = put(labels.join(parents, F.col("label") == F.col("x"), "left").select("id", F.coalesce("p", "label").alias("label")), "cc-labels", nodes)
        to = lambda side: parents.select(F.col("x").alias(f"x{side}"), F.col("p").alias(f"p{side}"))
        moved = edges.join(to("a"), F.col("a") == F.col("xa"), "left").join(to("b"), F.col("b") == F.col("xb"), "left")
        moved = moved.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b")).filter("a <> b")
        edges = put(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links", n)
        n = edges.count()
    return labels


def _narrowed(left: DataFrame, sigs: DataFrame, plan: Plan) -> DataFrame:
    """``left`` (key, band, doc_id, label, hub_label) with the members of wide buckets dealt into narrower ones.

    Members of a wide bucket share one band and mostly nothing else, so bands of more rows, made of signature bytes, part them. All wide buckets
    are dealt together: a pair that shares several meets once per longer band that it shares, of which the first counts. Such bands are
    numbered -1, -2 and so on.
    """
    sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > plan.wide).select(F.col("key").alias("k"))
    sizes = shared.staged(sizes, "near-wide")
    if sizes.isEmpty():
        return left
    wide = left.join(sizes, F.col("key") == F.col("k"), "left_semi").select("doc_id", "label").distinct()
    low = _of(sigs, wide.select("doc_id")).select(F.col("doc_id").alias("id"), "bytes")
    at = F.explode(F.sequence(F.lit(0), F.lit(plan.sub_bands - 1)))
    dealt = wide.join(low, F.col("doc_id") == F.col("id")).withColumn("sub", at)
    part = F.substring("bytes", F.col("sub") * plan.sub_rows + 1, F.lit(plan.sub_rows))
    dealt = dealt.select(F.xxhash64("sub", part).alias("key"), (-1 - F.col("sub")).alias("band"), "doc_id", "label")
    several = dealt.groupBy("key").agg(F.min("label").alias("hub_label"), F.max("label").alias("hi")).filter("hub_label <> hi").drop("hi")
    dealt = shared.staged(dealt.join(several, "key"), "near-narrow")
    return left.join(sizes, F.col("key") == F.col("k"), "left_anti").unionByName(dealt.select(left.columns))


def _blocks(left: DataFrame, sigs: DataFrame, plan: Plan) -> DataFrame:
    """Survivors (a, b) of the block-wise comparison; ``left`` has (key, band, doc_id, label, hub_label) of unresolved buckets."""
    left = _narrowed(left, sigs, plan)
    rows = left.withColumn("side", (F.col("label") == F.col("hub_label")).cast("int"))  # 1: the hub's component
    sizes = rows.groupBy("key", "side").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("key").agg(F.max(F.when(F.col("side") == 0, F.col("n"))).alias("n0"), F.coalesce(F.max(F.when(F.col("side") == 1, F.col("n"))), F.lit(0)).alias("n1"))
    sizes = sizes.select("key", F.ceil(F.col("n0") / plan.block).cast("int").alias("m0"), F.ceil(F.col("n1") / plan.block).cast("int").alias("m1"))
    low = _of(sigs, rows.select("doc_id").distinct()).select("doc_id", "n_shingles", "bands", "bytes")
    member = F.struct("doc_id", "label", "n_shingles", "bands", "bytes")
    rows = rows.join(sizes, "key").join(low, "doc_id")
    blk = F.pmod(F.xxhash64("doc_id"), F.when(F.col("side") == 1, F.col("m1")).otherwise(F.col("m0"))).cast("int")
    packed = shared.staged(rows.groupBy("key", "side", blk.alias("blk")).agg(F.first("band").alias("band"), F.first("m0").alias("m0"), F.first("m1").alias("m1"), F.collect_list(member).alias("rows")), "near-blocks")
    # Blocks of the others meet those of the hub's component, and each other once.
    others = packed.filter("side = 0")
    side1 = F.when(F.col("m1") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("m1") - 1)), lambda i: F.struct(F.lit(1).alias("s"), i.alias("i")))).otherwise(F.array().cast("array<struct<s:int,i:int>>"))
    side0 = F.transform(F.sequence(F.col("blk"), F.col("m0") - 1), lambda i: F.struct(F.lit(0).alias("s"), i.alias("i")))
    meets = others.select("key", "band", "blk", F.explode(F.concat(side1, side0)).alias("to"), F.col("rows").alias("x"))
    right = packed.select(F.col("key").alias("k2"), F.col("side").alias("s2"), F.col("blk").alias("b2"), F.col("rows").alias("y"))
    pairs = meets.join(right, (F.col("key") == F.col("k2")) & (F.col("to.s") == F.col("s2")) & (F.col("to.i") == F.col("b2")))
    pairs = pairs.select("band", ((F.col("to.s") == 0) & (F.col("to.i") == F.col("blk"))).alias("same"), "x", "y")
    least = plan.least_matches()
    part, whole = plan.share

    def unpack(rows) -> tuple:
        v = rows.values
        n = len(v)
        as_np = lambda name: v.field(name).to_numpy(zero_copy_only=False)
        bands = np.array(v.field("bands").to_pylist(), np.int64).reshape(n, plan.bands)
        return as_np("doc_id"), as_np("label"), as_np("n_shingles"), bands, np.frombuffer(b"".join(v.field("bytes").to_pylist()), np.uint8).reshape(n, plan.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                band, same = batch.column("band")[i].as_py(), batch.column("same")[i].as_py()
                (ia, la, na, ba, sa), (ib, lb, nb, bb, sb) = (unpack(batch.column(c)[i]) for c in ("x", "y"))
                ok = la[:, None] != lb[None, :]
                ok &= np.minimum(na[:, None], nb[None, :]) * whole >= np.maximum(na[:, None], nb[None, :]) * part
                if same:
                    ok = np.triu(ok, 1)
                p, q = np.nonzero(ok)
                if band > 0 and len(p):
                    first = ~(ba[p, :band] == bb[q, :band]).any(1)
                    p, q = p[first], q[first]
                elif band < -1:  # a longer band of a wide bucket
                    for sub in range(-1 - band):
                        cut = slice(sub * plan.sub_rows, (sub + 1) * plan.sub_rows)
                        first = (sa[p, cut] != sb[q, cut]).any(1)
                        p, q = p[first], q[first]
                matches, done = np.zeros(len(p), np.int64), 0
                for n, m in least:
                    for at in range(0, len(p), 16384):
                        cut = slice(at, at + 16384)
                        matches[cut] += (sa[p[cut], done:n] == sb[q[cut], done:n]).sum(1)
                    keep = matches >= m
                    p, q, matches, done = p[keep], q[keep], matches[keep], n
                a, b = ia[p], ib[q]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

    return pairs.mapInArrow(workers.tidied(run), "a long, b long").distinct()


def _unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, band, doc_id, label, hub_label) of the buckets in which others than the hub's component remain, and not only one."""
    far = members.filter("n > 2").join(labels.toDF("doc_id", "l"), "doc_id", "left").join(labels.toDF("hub", "h"), "hub", "left")
    far = far.select("key", "band", "hub", "doc_id", F.coalesce("l", "doc_id").alias("label"), F.coalesce("h", "hub").alias("hub_label"))
    far = shared.staged(far.filter("doc_id <> hub").drop("hub"), "near-far")
    several = far.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key")
    return shared.staged(far.join(several, "key", "left_semi"), "near-left")


def _pairs_left(left: DataFrame) -> int:
    return left.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0))).first()[0]


def _other_hubs(left: DataFrame, nth: int) -> DataFrame:
    """(a, b): in each unresolved bucket, one member that isn't in the hub's component, drawn by hash, with all of other components."""
    drawn = F.min_by(F.struct("doc_id", "label"), F.struct(F.xxhash64("doc_id", F.lit(nth)).alias("x"), "doc_id"))
    hubs = left.filter(F.col("label") != F.col("hub_label")).groupBy("key").agg(drawn.alias("hub"))
    pairs = left.join(hubs, "key").filter(F.col("label") != F.col("hub.label"))
    return pairs.select(F.least("doc_id", "hub.doc_id").alias("a"), F.greatest("doc_id", "hub.doc_id").alias("b")).distinct()


def near_groups(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    all_sigs = shared.staged(signatures(docs, plan, id_col, text_col), "near-signatures")
    classes = all_sigs.filter("print IS NOT NULL AND doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("rep"))
    classes = shared.staged(classes, "near-classes")
    shared.tidy(spark)
    sigs = _of(all_sigs.filter("print IS NOT NULL"), classes.select("rep").distinct())
    keys = sigs.select("doc_id", F.posexplode("bands").alias("band", "key")).select("key", "band", "doc_id")
    hubs = keys.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = shared.staged(keys.join(hubs, "key"), "near-buckets")  # only buckets with company

    def confirmed(pairs: DataFrame) -> DataFrame:
        return shared.staged(_exact(shared.staged(pairs, "near-likely"), docs, plan, id_col, text_col), "near-links")

    star = shared.staged(members.filter("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct(), "near-star")
    links = confirmed(_bayes(star, sigs, plan))
    labels = components(links)
    left, load = _unresolved(members, labels), None
    for nth in range(plan.rehubs):
        before, load = load, _pairs_left(left)
        if load <= plan.direct or (before and load > 0.8 * before):
            break
        shared.tidy(spark)
        more = shared.staged(_other_hubs(left, nth), "near-star")
        links = links.union(confirmed(_bayes(more, sigs, plan)))
        labels = components(links)
        left = _unresolved(members, labels)
    if not left.isEmpty():
        shared.tidy(spark)
        links = links.union(confirmed(_blocks(left, sigs, plan)))
        labels = components(links)

    named = classes.join(labels.toDF("rep", "label"), "rep", "left").select(F.col("print").alias("p"), F.coalesce("label", "rep").alias("component_id"))
    out = all_sigs.select("doc_id", "n_shingles", "print").join(named, F.col("print") == F.col("p"), "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def kept_rows(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, but for those whose group keeps another document; rows with a null id stay."""
    groups = near_groups(docs, plan, id_col, text_col)
    name = shared.fresh(docs.columns, "gone")
    gone = shared.staged(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct(), "near-gone")
    return docs.join(shared.small_enough(gone, MAX_BROADCAST_IDS), F.col(id_col) == F.col(name), "left_anti")
