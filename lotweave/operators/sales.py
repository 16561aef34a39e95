"""Sales of several venues: which are one sale, which card they are of, which may be loaded, and what backs their price."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cards, rules, scalars
from ..staging import small_or_merged

#: Which record of a sale is believed first.
SOURCE_ORDER = {"fanatics_api": 0, "neon": 1, "seed": 2}
#: Fixed value: from this price on a person looks at a sale before it is loaded.
REVIEW_FROM = 1_000_000
#: Sales that are alike but for their key are held in lists of about so many keys.
MAX_KEYS = 500
#: Groups of more than MAX_KEYS sales are broadcast up to so many rows.
MAX_BROADCAST_GROUPS = 100_000


# --- one sale or two --------------------------------------------------------------------------------------------------
def title_words(title: Column) -> Column:
    """Distinct words of three letters or more that begin with a letter."""
    return F.array_distinct(F.filter(scalars.tokens(title, "[a-z][a-z.'-]*"), lambda w: F.length(w) > 2))


def alike(title_a: Column, title_b: Column, players_a: Column, players_b: Column, least: float = 0.3) -> Column:
    """A shared player; if either side names none, titles that share enough of their words."""
    return _agree(title_words(title_a), title_words(title_b), players_a, players_b, least)


def _agree(words_a: Column, words_b: Column, players_a: Column, players_b: Column, least: float = 0.3) -> Column:
    known = (F.coalesce(F.size(players_a), F.lit(0)) > 0) & (F.coalesce(F.size(players_b), F.lit(0)) > 0)
    return F.when(known, F.arrays_overlap(players_a, players_b)).otherwise(scalars.jaccard(words_a, words_b) >= least)


def same_sales(rows: DataFrame, key: str, price: str, day: str, by_month: str, title: str, players: str, percent: float = 1.0, days: int = 3) -> DataFrame:
    """(a, b) with a < b that may be one sale: prices within ``percent`` of the larger one, days within ``days``, or the same month if either
    is only known by month (``by_month``), and :func:`alike`.

    Both ways of meeting are equi-joins on a price bucket with the day's bucket or the month, with all rules in the join. Sales that are alike
    but for their key meet as one group with a list of keys; pairs of keys are made last, in the tasks that return them, and are never shuffled.
    """
    width = -math.log(1 - percent / 100) * (1 + 1e-9)  # no rounding parts partners by two buckets
    p, d = F.col(price).cast("double"), F.col(day).cast("date")
    base = rows.filter(p > 0).select(F.col(key).alias("k"), p.alias("p"), d.alias("d"), scalars.month_of(F.col(day)).alias("ym"), F.col(by_month).alias("m"), title_words(F.col(title)).alias("w"), F.col(players).alias("ps"))
    facts = ["p", "d", "ym", "m", "w", "ps"]
    large = base.groupBy(*facts).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MAX_KEYS)
    large = large.select(F.struct(*facts).alias("f"), F.ceil(F.col("n") / MAX_KEYS).alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("k"), F.col("parts")), F.lit(0))
    base = base.join(small_or_merged(large, MAX_BROADCAST_GROUPS), F.struct(*facts) == F.col("f"), "left").withColumn("part", part)
    g = base.groupBy(*facts, "part").agg(F.min("k").alias("k0"), F.collect_list("k").alias("ks"))
    g = g.withColumns({"pb": F.floor(F.log("p") / width), "db": F.floor(F.unix_date("d") / (days + 1))})
    held = [*facts, "part", "k0", "ks", "pb"]
    every = F.struct(*facts, "part")  # tells groups of one first key apart
    other = {c: f"{c}2" for c in (*held, "db")}
    price_near = F.abs(F.col("p") - F.col("p2")) <= F.greatest("p", "p2") * (percent / 100)
    meets = price_near & _agree(F.col("w"), F.col("w2"), F.col("ps"), F.col("ps2"))
    same = (F.col("k0") == F.col("k02")) & every.eqNullSafe(F.struct(*[f"{c}2" for c in (*facts, "part")]))
    once = (F.col("k0") < F.col("k02")) | ((F.col("k0") == F.col("k02")) & (every <= F.struct(*[f"{c}2" for c in (*facts, "part")])))

    # Each two buckets meet once: in the next price bucket whatever the day's bucket, in one price bucket the next day's, in one bucket by first key.
    by_day = g.filter(~F.col("m"))
    to = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]
    dealt = by_day.withColumn("to", F.explode(F.array(*[F.struct((F.col("pb") + i).alias("pb"), (F.col("db") + j).alias("db"), F.lit((i, j) == (0, 0)).alias("own")) for i, j in to])))
    right = by_day.withColumnsRenamed(other)
    exact = dealt.join(right, (F.col("to.pb") == F.col("pb2")) & (F.col("to.db") == F.col("db2")) & (~F.col("to.own") | once) & (F.abs(F.datediff("d", "d2")) <= days) & meets)
    # A sale known by month meets all of its month; two such sales meet once.
    dealt = g.filter("m").withColumn("to", F.explode(F.array(*[F.col("pb") + i for i in (-1, 0, 1)])))
    right = g.withColumnsRenamed(other)
    monthly = dealt.join(right, (F.col("to") == F.col("pb2")) & (F.col("ym") == F.col("ym2")) & (~F.coalesce("m2", F.lit(False)) | once) & meets)
    pairs = exact.select("ks", "ks2", same.alias("same")).unionByName(monthly.select("ks", "ks2", same.alias("same")))
    pairs = pairs.select("same", "ks2", F.explode("ks").alias("x")).select("same", "x", F.explode("ks2").alias("y"))
    return pairs.filter((F.col("x") < F.col("y")) | (~F.col("same") & (F.col("x") > F.col("y")))).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def belief_order(source: Column, price: Column, order: dict[str, int] = SOURCE_ORDER) -> list[Column]:
    """Columns by which records are taken before they are merged: the most believed source first, then the highest price."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in order.items() for x in kv]), source), F.lit(len(order)))
    return [rank, -price]


def already_there(rows: DataFrame, present: DataFrame, equal: Sequence[str], price: str, day: str, percent: float = 2.0, days: int = 3) -> DataFrame:
    """``rows`` with ``present``: whether a row of ``present`` has equal keys, a day at most ``days`` away and a price within ``percent`` of the row's own."""
    span = F.explode(F.array(*[F.date_add(F.col(day).cast("date"), i) for i in range(-days, days + 1)]))
    there = present.select(*[F.col(e).alias(f"__{e}") for e in equal], F.col(price).alias("__price"), span.alias("__day"))
    near = F.abs(F.col("__price") - F.col(price)) <= F.col(price) * (percent / 100)
    cond = [F.col(e) == F.col(f"__{e}") for e in equal] + [F.col(day).cast("date") == F.col("__day"), near]
    found, new = rows.join(there, cond, "left_semi"), rows.join(there, cond, "left_anti")
    return found.withColumn("present", F.lit(True)).unionByName(new.withColumn("present", F.lit(False)))


# --- which card -------------------------------------------------------------------------------------------------------
def resolve_cards(sales: DataFrame, catalog: DataFrame, years: int = 1) -> DataFrame:
    """(sale_id, status, why, card_id): the card of each sale, if exactly one agrees.

    ``sales`` has sale_id, title, price, player_keys (array), year, code_key, print_run; ``catalog`` card_id, player_key, season_year, number,
    set_name, parallel, print_run. Cards of one of the players with the same number, at most ``years`` away, are held against the
    title by :func:`..functions.cards.mismatch`. Status: resolved, resolved_needs_review (from REVIEW_FROM on), needs_review, mint_candidate.
    """
    key = lambda c: scalars.number_key_plain(c)
    c = catalog.select("card_id", F.col("player_key").alias("pk"), F.col("season_year").alias("cy"), key(F.col("number")).alias("ck"), "set_name", "parallel", F.col("print_run").alias("card_run"))
    each = sales.select("sale_id", "title", "year", "code_key", "print_run", F.explode(F.array_distinct("player_keys")).alias("player"))
    j = each.join(c, (F.col("player") == F.col("pk")) & (F.col("code_key") == F.col("ck"))).filter(F.abs(F.col("cy") - F.col("year")) <= years)
    j = j.dropDuplicates(["sale_id", "card_id"])
    j = j.withColumn("why", cards.mismatch(F.col("title"), F.col("set_name"), F.coalesce("parallel", F.lit("")), F.col("print_run"), F.col("card_run"), F.col("year"), F.col("cy")))
    per = j.groupBy("sale_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("why").isNull()).alias("n_ok"), F.min(F.when(F.col("why").isNull(), F.col("card_id"))).alias("ok"),
        F.min_by("why", "card_id").alias("first_why"),
    )
    out = sales.select("sale_id", "player_keys", "year", "code_key", "price").join(per, "sale_id", "left")
    unread = (F.coalesce(F.size("player_keys"), F.lit(0)) <= 0) | F.col("year").isNull()
    status = rules.first_of([
        (unread, "needs_review"), (F.coalesce("code_key", F.lit("")) == "", "needs_review"), (F.col("n").isNull(), "mint_candidate"),
        ((F.col("n_ok") == 1) & (F.col("price") >= REVIEW_FROM), "resolved_needs_review"), (F.col("n_ok") == 1, "resolved"),
    ], "needs_review")
    why = rules.first_reason([
        (unread, F.lit("player or year not read from the title")), (F.coalesce("code_key", F.lit("")) == "", F.lit("no card number in the title")),
        (F.col("n").isNull(), F.lit("card not in the catalog (player/year/card number)")), (F.col("n_ok") == 1, F.lit("one card matches set, number and parallel")),
        (F.col("n_ok") > 1, F.concat(F.col("n_ok").cast("string"), F.lit(" cards match set, number and parallel"))),
        (F.lit(True), F.concat(F.lit("same player/year/number, but "), F.col("first_why"))),
    ])
    return out.select("sale_id", status.alias("status"), why.alias("why"), F.when(F.col("n_ok") == 1, F.col("ok")).alias("card_id"))


def propose_ids(sales: DataFrame, sports: DataFrame, stop: set[str], junk: set[str] = frozenset()) -> DataFrame:
    """(sale_id, proposed_id, confidence, notes) of sales whose title carries year, set, player and number in this order.

    ``sales`` has sale_id, title, year, code, player_keys; ``sports`` player_key, sport. The player is the first run of three or two words
    that is one of the keys, the set what stands between the year and that. No proposal without number, year, player or year before player.
    """
    folded = lambda w: F.regexp_replace(F.lower(scalars.to_ascii(w)), "[^a-z0-9]", "")
    keys = F.filter("player_keys", lambda k: ~k.isin(sorted(junk))) if junk else F.col("player_keys")
    s = sales.withColumn("keys", keys).withColumn("words", F.regexp_extract_all("title", F.lit(r"[A-Za-z0-9][A-Za-z0-9.'&\-/]*"), F.lit(0)))
    s = s.withColumn("folds", F.transform("words", folded))

    def first_run(n: int) -> Column:
        at = F.when(F.size("words") >= n, F.sequence(F.lit(0), F.size("words") - n)).otherwise(F.array().cast("array<int>"))
        hit = F.filter(at, lambda i: F.array_contains(F.col("keys"), F.array_join(F.slice("folds", i + 1, F.lit(n)), "")))
        return F.try_element_at(F.transform(hit, lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"))), F.lit(1))

    s = s.withColumn("player", F.coalesce(first_run(3), first_run(2)))
    years = F.filter(F.transform("words", lambda w, i: F.when(w.rlike(r"^(18|19|20)[0-9]{2}(-[0-9]{2})?$"), i)), lambda i: i.isNotNull())
    s = s.withColumn("year_at", F.try_element_at(years, F.lit(1)))
    s = s.filter(F.col("player").isNotNull() & (F.col("year_at") < F.col("player.at")) & (F.coalesce("code", F.lit("")) != "") & F.col("year").isNotNull())
    between = F.slice("words", F.col("year_at") + 2, F.greatest(F.lit(0), F.col("player.at") - F.col("year_at") - 1))
    name = F.array_join(F.slice("words", F.col("player.at") + 1, F.col("player.n")), " ")
    s = s.withColumn("set_words", F.filter(between, lambda w: ~folded(w).isin(sorted(stop)) & ~folded(w).rlike("^[0-9]*$") & (folded(w) != folded(F.col("code"))))).withColumn("name", name)
    in_set = F.transform("set_words", F.lower)
    s = s.withColumn("parallel", F.array_distinct(F.filter(scalars.tokens(F.col("title"), "[a-z]+"), lambda w: w.isin(sorted(cards.PARALLELS)) & ~F.array_contains(in_set, w))))
    known = sports.groupBy(F.col("player_key").alias("pk")).agg(F.min("sport").alias("sport"))
    s = s.withColumn("name_key", folded(F.col("name"))).join(known, F.col("name_key") == F.col("pk"), "left")
    base = F.concat_ws(":", F.coalesce("sport", F.lit("None")), F.concat_ws("-", F.col("year").cast("string"), scalars.slug(F.array_join("set_words", " "))), scalars.slug(F.col("name")), scalars.slug(F.col("code")))
    whole = F.when(F.size("parallel") > 0, F.concat(base, F.lit("~"), scalars.slug(F.array_join("parallel", " ")))).otherwise(base)
    notes = rules.all_reasons([(F.size("keys") > 1, "several_players"), (F.size("set_words") == 0, "no_set"), (F.col("sport").isNull(), "unknown_sport")])
    signed = F.arrays_overlap(cards.words_of(F.col("title")), F.array(F.lit("auto"), F.lit("signed"))) & ~F.arrays_overlap(F.concat(in_set, "parallel"), F.array(F.lit("auto"), F.lit("autograph")))
    s = s.withColumn("notes", notes).withColumn("confidence", F.when(F.size("notes") > 0, "low").otherwise("high"))
    return s.select("sale_id", whole.alias("proposed_id"), "confidence", F.when(signed, F.array_append("notes", "signed_copy")).otherwise(F.col("notes")).alias("notes"))


# --- which may be loaded ----------------------------------------------------------------------------------------------
def held_reason(
    status: Column, price: Column, venue: Column, url: Column, by_month: Column, title: Column, payment: Column, grade: Column, approved: Column, recorded: Column,
    houses: Sequence[str], floor: float,
) -> Column:
    """Why a sale isn't loaded, the first reason that holds; ``loaded`` if none does, null for sales that aren't considered at all."""
    low = F.lower(title)
    own_label = low.contains("black label") | (low.contains("gold label") & ~low.contains("topps gold label"))
    return F.when((price >= floor) & venue.isin(*houses) & status.isin("resolved", "resolved_needs_review"), rules.first_of([
        (~F.coalesce(recorded, F.lit(False)), "press_only"), (F.coalesce(url, F.lit("")).contains("/buy-now/"), "asking_price"),
        ((status == "resolved_needs_review") & ~F.coalesce(approved, F.lit(False)), "not_approved"), (by_month, "month_precision"),
        (own_label, "own_label_slab"), (payment == "Unpaid", "unpaid"), (F.coalesce(grade, F.lit("")) == "", "no_grade"),
    ], "loaded"))


def price_trust(best_offer: Column, basis_known: Column) -> Column:
    """What a price is worth: an accepted offer isn't shown, so it isn't the price; an unknown basis isn't verified."""
    return F.when(F.coalesce(best_offer, F.lit(False)), "best_offer").when(~F.coalesce(basis_known, F.lit(False)), "unverified_basis").otherwise("trusted")


def backed(rows: DataFrame, evidence: DataFrame, within: float = 10.0) -> DataFrame:
    """``rows`` with backed and level: whether another sale reaches a tenth of the price (1 / ``within``), judged at the first level that has any.

    Levels: the same card and grade, the card in any grade, then its family. A family's record counts only if it is independent: weekly
    records don't vouch for weekly ones. Both tables have sale_id, card_id, grade, price, venue; a row never backs itself.
    """
    family = F.substring_index("card_id", "~", 1)
    weekly = (F.col("venue") == "fanatics") & F.col("sale_id").startswith("WEEKLY")
    r = rows.withColumn("__family", family).withColumn("__weekly", weekly)
    e = evidence.select(F.col("sale_id").alias("es"), F.col("card_id").alias("ec"), F.col("grade").alias("eg"), F.col("price").alias("ep"), family.alias("ef"), weekly.alias("ew"))
    top = Window.partitionBy("ef", "ec", "eg", "ew").orderBy(F.col("ep").desc(), "es")
    # The two best sales of each card, grade and kind are enough: the best that isn't the row itself is one of them.
    e = e.withColumn("__r", F.row_number().over(top)).filter("__r <= 2").drop("__r")
    j = r.join(e, (F.col("__family") == F.col("ef")) & (F.col("sale_id") != F.col("es")))
    level = F.when((F.col("card_id") == F.col("ec")) & F.col("grade").eqNullSafe(F.col("eg")), 0).when(F.col("card_id") == F.col("ec"), 1).when(~(F.col("__weekly") & F.col("ew")), 2)
    best = j.withColumn("__l", level).filter("__l IS NOT NULL").groupBy("sale_id", "__l").agg(F.max("ep").alias("__p"))
    best = best.groupBy(F.col("sale_id").alias("__s")).agg(F.min("__l").alias("level"), F.min_by("__p", "__l").alias("__best"))
    out = rows.join(best, F.col("sale_id") == F.col("__s"), "left")
    return out.withColumn("backed", F.coalesce(F.col("__best") >= F.col("price") / within, F.lit(False))).drop("__s", "__best")


def fenced(sales: DataFrame, group: Sequence[str], raw: Column, price: str, by: Sequence[str], far: float = 10.0, thin: int = 5, most: float = 500.0) -> DataFrame:
    """``sales`` with ``trust``: outlier if a group of at least ``thin`` sales has a median more than ``far`` times off, thin_graded if a smaller group's sale is more
    than ``most`` times the median of raw ones (``raw``) of the same ``by``, else guaranteed."""
    from . import ordered

    mids = ordered.medians(sales, list(group), price).withColumnsRenamed({"n": "__n", "mid": "__mid"} | {g: f"__{g}" for g in group})
    raws = ordered.medians(sales.filter(raw), list(by), price).withColumnsRenamed({"mid": "__raw"} | {b: f"__raw_{b}" for b in by}).drop("n")
    j = sales.join(mids, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group], "left").join(raws, [F.col(b).eqNullSafe(F.col(f"__raw_{b}")) for b in by], "left")
    p = F.col(price)
    off = (F.col("__n") >= thin) & ((p > far * F.col("__mid")) | (p < F.col("__mid") / far))
    graded = (F.col("__n") < thin) & ~F.coalesce(raw, F.lit(False)) & (p > most * F.col("__raw"))
    trust = rules.first_of([(F.coalesce(off, F.lit(False)), "outlier"), (F.coalesce(graded, F.lit(False)), "thin_graded")], "guaranteed")
    return j.withColumn("trust", trust).select(*sales.columns, "trust")


# --- auctions and windows ---------------------------------------------------------------------------------------------
def newest_completed(auctions: DataFrame, done: DataFrame, n: int) -> DataFrame:
    """The ``n`` completed auctions that ended last and aren't done, the feature being that number."""
    return _completed(auctions, done).orderBy(F.col("end_timestamp").desc(), "auction_id").limit(n)


def completed_between(auctions: DataFrame, done: DataFrame, start: str, end: str) -> DataFrame:
    """All completed auctions not done that ended in [start, end), oldest first. Times are ISO texts, which compare as such."""
    at = F.col("end_timestamp")
    return _completed(auctions, done).filter((at >= start) & (at < end)).orderBy(at, "auction_id")


def _completed(auctions: DataFrame, done: DataFrame) -> DataFrame:
    known = auctions.filter((F.col("status") == "Completed") & F.col("auction_id").isNotNull() & (F.coalesce("end_timestamp", F.lit("")) != ""))
    return known.join(done.select("auction_id").distinct(), "auction_id", "left_anti")


def window_with_band(rows: DataFrame, day: str, floor: str, ceiling: str, gap: tuple[str, str], band: tuple[str, str] | None = None) -> DataFrame:
    """``rows`` of [floor, ceiling) without [gap), ``part`` main; and those of the side band, ``part`` band, for a table of their own."""
    d = F.col(day).cast("date")
    inside = lambda lo, hi: (d >= F.lit(lo).cast("date")) & (d < F.lit(hi).cast("date"))
    part = F.when(inside(floor, ceiling) & ~inside(*gap), "main")
    part = part.when(inside(*band), "band") if band else part
    return rows.withColumn("part", part).filter("part IS NOT NULL")


def pages_to_read(pages: DataFrame, day: str, page: str, wanted: Column) -> DataFrame:
    """(page, n, keep): rows of the wanted day per page of a list that goes back in time, and whether the page is read at all.

    Reading stops after the first page all of whose days are older, so what comes after it isn't kept; a page without any day doesn't stop it.
    """
    d = F.col(day).cast("date")
    per = pages.groupBy(page).agg(F.count_if(d == wanted).alias("n"), F.coalesce(F.max(d) < wanted, F.lit(False)).alias("old"))
    stop = per.agg(F.min(F.when(F.col("old"), F.col(page))).alias("stop"))
    return per.crossJoin(F.broadcast(stop)).select(page, "n", (F.col("stop").isNull() | (F.col(page) <= F.col("stop"))).alias("keep"))  # one row


def roster_order(rank: Column) -> Column:
    """Sort key of a roster: its rank, the unranked last."""
    return F.coalesce(rank.try_cast("long"), F.lit(1_000_000))
