"""Titles to pages of a card library whose addresses spell sport, year, set, product and number.

An address is ``<sport>-cards-<year>[-<yy>]-<set>/<player>-[<parallel>-]<number>``. Titles name the same things in other words, so each title
is looked up under several spellings of its number, its year and the one before, and its set, the set that a number's prefix belongs to,
and the families of both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules, scalars
from ..staging import small_or_merged, staged
from .strict import names_in

SLUG = r"^([a-z]+)-cards-([0-9]{4})(?:-[0-9]{2})?-([^/]+)/(.+)$"
#: What a title says beside player, set and number.
FILLER = ["psa", "bgs", "sgc", "cgc", "gem", "mint", "mt", "rc", "rookie", "auto", "graded", "card", "lot"]
AUTOGRAPH = ["auto", "autograph", "autographed", "signature", "signatures"]
#: Fixed value: share of a family set's further words that a title must have to be taken for that set.
NAMED = 0.5
#: Spellings of sets and prefixes of numbers are broadcast up to so many rows.
MAX_BROADCAST_SETS = 100_000
#: Groups of pages that a title is held against at once.
BLOCK = 256


def parse_library(pages: DataFrame, slug: str = "slug") -> DataFrame:
    """(slug, year, set_slug, product, tokens) of the addresses that have a product of two tokens or more."""
    part = lambda n: F.regexp_extract(slug, SLUG, n)
    out = pages.select(F.col(slug).alias("slug"), part(2).alias("year"), part(3).alias("set_slug"), part(4).alias("product"))
    return out.withColumn("tokens", F.split("product", "-")).filter("year <> '' AND size(tokens) >= 2")


def _numbers(tokens: Column) -> Column:
    """The keys of a product: its last token, and its last two."""
    return F.array(F.element_at(tokens, -1), F.array_join(F.slice(tokens, -2, 2), "-"))


def prefix_sets(library: DataFrame, floor: int = 20, share: float = 0.8) -> DataFrame:
    """(prefix, set_slug): prefixes of numbers (one to four letters before digits) that belong to one set."""
    before, last = F.element_at("tokens", -2), F.element_at("tokens", -1)
    p = library.filter(before.rlike("^[a-z]{1,4}$") & last.rlike("^[0-9]+$")).groupBy(before.alias("prefix"), "set_slug").agg(F.count(F.lit(1)).alias("n"))
    total = p.groupBy("prefix").agg(F.sum("n").alias("total"), F.max_by("set_slug", F.struct("n", "set_slug")).alias("set_slug"), F.max("n").alias("top"))
    return total.filter((F.col("top") >= floor) & (F.col("top") / F.col("total") >= share)).select("prefix", "set_slug")


def parallel_words(library: DataFrame, prefixes: DataFrame, floor: int = 25) -> DataFrame:
    """(token): words that stand after a name and before the number often, and more than three times as often as first or second."""
    at = library.select(F.size("tokens").alias("n"), F.posexplode("tokens").alias("at", "token"))
    inner = F.col("at").between(2, F.col("n") - 2) & ~F.col("token").rlike("^[0-9]+$")
    counts = at.groupBy("token").agg(F.count_if(inner).alias("inner"), F.count_if(F.col("at") < 2).alias("lead"))
    words = counts.filter((F.col("inner") >= floor) & (F.length("token") > 2) & (F.col("inner") > 3 * F.col("lead"))).select("token")
    return words.join(prefixes.select(F.col("prefix").alias("token")), "token", "left_anti")


def _number_forms(number: Column) -> Column:
    """Spellings of a number: as it is, after its hyphen, letters and digits apart, digits alone."""
    letters, digits = F.regexp_extract(number, "^([a-z]+)([0-9]+)$", 1), F.regexp_extract(number, "^([a-z]+)([0-9]+)$", 2)
    after = F.when(F.instr(number, "-") > 0, F.regexp_replace(number, "^[^-]*-", ""))
    forms = F.array(number, after, F.when(letters != "", F.concat_ws("-", letters, digits)), F.when(letters != "", digits))
    return F.array_distinct(F.array_compact(forms))


def _wanted(full: DataFrame, library: DataFrame, sets: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(rid, wants of set_slug, support and by_prefix): the sets that a title may mean: those of its set's name, that of its number's prefix, and the families of both."""
    own = sets.groupBy(scalars.name_key(F.col("name")).alias("sn")).agg(F.collect_set("set_slug").alias("of_title"))
    before = prefixes.groupBy("prefix").agg(F.collect_set("set_slug").alias("of_number"))
    t = full.join(small_or_merged(own, MAX_BROADCAST_SETS), F.col("set_name") == F.col("sn"), "left")
    t = t.join(small_or_merged(before, MAX_BROADCAST_SETS), F.regexp_extract("number", "^([a-z]+)-", 1) == F.col("prefix"), "left")
    of_title, of_number = (F.coalesce(c, F.array().cast("array<string>")) for c in ("of_title", "of_number"))
    base = t.select("rid", "words", of_number.alias("of_number"), F.explode(F.array_union(of_title, of_number)).alias("base"))
    # Families: sets that begin or end with another set, found once for each pair of sets, through the first and the last word that both must share.
    known = library.select("set_slug").distinct()
    ends = lambda df, c: df.withColumn("w", F.split(c, "-")).withColumn("end", F.explode(F.array_distinct(F.array(F.element_at("w", 1), F.element_at("w", -1)))))
    bases = sets.select(F.col("set_slug").alias("base")).union(prefixes.select("set_slug")).distinct()
    b, s = F.col("base"), F.col("set_slug")
    related = s.startswith(F.concat(b, F.lit("-"))) | b.startswith(F.concat(s, F.lit("-"))) | s.endswith(F.concat(F.lit("-"), b)) | b.endswith(F.concat(F.lit("-"), s))
    pairs = ends(bases, "base").select("base", F.col("w").alias("bw"), "end").join(ends(known, "set_slug"), "end").filter((b != s) & related)
    pairs = pairs.select("base", F.struct("set_slug", F.array_except("w", "bw").alias("extra")).alias("kin")).distinct()
    kin = small_or_merged(pairs.groupBy("base").agg(F.collect_list("kin").alias("kin")), MAX_BROADCAST_SETS, pairs)
    by_prefix = F.array_contains("of_number", b)
    direct = F.struct(b.alias("set_slug"), F.when(by_prefix, 0.9).otherwise(1.0).alias("support"), by_prefix.cast("int").alias("by_prefix"))
    support = lambda extra: F.size(F.array_intersect(extra, "words")) / F.greatest(F.size(extra), F.lit(1))
    family = F.transform("kin", lambda k: F.struct(k["set_slug"].alias("set_slug"), support(k["extra"]).alias("support"), F.lit(0).alias("by_prefix")))
    wants = base.join(kin, "base", "left").select("rid", F.explode(F.when(F.col("kin").isNull(), F.array(direct)).otherwise(F.concat(F.array(direct), family))).alias("w"))
    wants = wants.select("rid", "w.*").repartition("rid").groupBy("rid", "set_slug").agg(F.max("support").alias("support"), F.max("by_prefix").alias("by_prefix"))
    return wants.groupBy("rid").agg(F.collect_list(F.struct("set_slug", "support", "by_prefix")).alias("wants"))


def _blocks(library: DataFrame, several: DataFrame, par: Column) -> DataFrame:
    """(ly, ls, lk, pages, old): groups of the pages of a year, set and number, up to ``BLOCK`` in a row; ``old``: all are there ``again``.

    Pages that no title can tell apart (name, parallel words, autograph) are one group: ``lo`` is its first page by length of product, ``twin`` whether
    another is as short, ``many`` whether it has several products, ``again`` whether the set has the products the year after too. Where a title may mean
    ``several`` sets, a product that another of them has in a neighbouring year stays a group of its own, known by its ``tag``.
    """
    # An address that is listed often is one page.
    lib = library.dropDuplicates(["slug"]).select("slug", F.col("year").alias("ly"), F.col("set_slug").alias("ls"), "product", "tokens", F.col("year").cast("int").alias("at"))
    several = several.select(F.col("set_slug").alias("ls"), F.lit(True).alias("shared"))
    lib = lib.join(small_or_merged(several, MAX_BROADCAST_SETS), "ls", "left")
    year_after = Window.partitionBy("product", "ls").orderBy("at").rangeBetween(1, 1)
    around = Window.partitionBy("product").orderBy("at").rangeBetween(-1, 1)
    shared = F.when(F.col("shared"), F.col("ls"))
    elsewhere = F.coalesce(F.col("shared") & (F.min(shared).over(around) != F.max(shared).over(around)), F.lit(False))
    lib = lib.repartition("product").withColumns({"again": F.count(F.lit(1)).over(year_after) > 0, "tag": F.when(elsewhere, F.col("product")).otherwise("")})
    # Player: leading tokens of the product, up to a number, or a parallel's word from the third on.
    stops = F.filter(F.transform("tokens", lambda x, i: F.when(x.rlike("^[0-9]+$") | (F.array_contains(par, x) & (i >= 2)), i)), lambda i: i.isNotNull())
    name = F.slice("tokens", 1, F.least(F.lit(4), F.coalesce(F.try_element_at(stops, F.lit(1)), F.size("tokens"))))
    inner = F.sort_array(F.array_intersect(F.slice("tokens", 3, F.greatest(F.lit(0), F.size("tokens") - 3)), par))
    auto = F.concat_ws("-", "ls", "product").rlike("auto|signature")
    lib = lib.select("ly", "ls", F.explode(F.array_distinct(_numbers(F.col("tokens")))).alias("lk"), name.alias("name"), inner.alias("inner"), auto.alias("auto"), "again", "tag", "product", "slug")
    length = F.length("product")
    groups = lib.groupBy("ly", "ls", "lk", "name", "inner", "auto", "again", "tag").agg(
        F.min(F.struct(length.alias("l"), "product", "slug")).alias("lo"), F.max(F.struct((-length).alias("l"), "product", "slug")).alias("hi"), F.min("product").alias("least"), F.max("product").alias("most")
    )
    twin = (F.col("lo.l") == -F.col("hi.l")) & (F.col("lo.slug") != F.col("hi.slug"))
    page = F.struct("name", F.array_join("name", "").alias("joined"), "inner", "auto", "again", "tag", "lo", twin.alias("twin"), (F.col("least") != F.col("most")).alias("many"))
    place = F.row_number().over(Window.partitionBy("ly", "ls", "lk").orderBy("lo.slug")) - 1
    groups = groups.select("ly", "ls", "lk", page.alias("page"), F.floor(place / BLOCK).alias("block"))
    return groups.groupBy("ly", "ls", "lk", "block").agg(F.collect_list("page").alias("pages"), F.every("page.again").alias("old")).drop("block")


def _met(met: DataFrame) -> DataFrame:
    """(rid, part): what a title finds in a block of pages: whether any has its player, by words of four letters or of three, and the best of those that fit."""
    now = F.col("y") == F.col("year")
    meets = lambda p, said: F.arrays_overlap(p["name"], F.col(said)) | F.exists("within", lambda w: p["joined"].contains(w))
    fits = lambda p: (p["auto"] == F.col("wants_auto")) & (F.size(F.array_except("sure", p["inner"])) == 0)
    cover = lambda p: F.size(F.array_intersect("said4", p["name"]))
    pscore = lambda p: F.size(F.array_intersect("heard", p["inner"])) - F.size(F.array_except(p["inner"], F.col("heard")))
    scored = lambda p: F.struct(F.struct(cover(p).alias("cover"), pscore(p).alias("pscore")).alias("score"), p["tag"].alias("tag"), p["lo"].alias("lo"), p["twin"].alias("twin"), p["many"].alias("many"))

    def one(plain: Column, best: Column) -> Column:
        return scalars.once(_first(best), lambda lo: F.struct(best[0]["score"].alias("score"), F.lit("").alias("tag"), lo.alias("lo"), _twins(best, lo).alias("twin"), _several(plain).alias("many")))

    def kept(found: Column) -> Column:
        plain, tagged = F.filter(found, lambda x: x["tag"] == ""), F.filter(found, lambda x: x["tag"] != "")
        top = lambda held: scalars.once(F.array_max(F.transform(held, lambda x: x["score"])), lambda most: F.filter(held, lambda x: x["score"] == most))
        return scalars.once(plain, lambda held: F.when(F.size(held) == 0, tagged).otherwise(F.concat(F.array(scalars.once(top(held), lambda best: one(held, best))), tagged)))

    def part(pages: Column, four: Column) -> Column:
        fit = F.transform(F.filter(pages, lambda p: fits(p) & (~four | meets(p, "said4"))), scored)
        return F.struct((F.size(pages) > 0).alias("player"), four.alias("four"), now.alias("now"), *[F.col(c).alias(c) for c in ("y", "set_slug", "support", "by_prefix")], scalars.once(fit, kept).alias("kept"))

    # What the set has the year after too is found there; in the year before it says nothing more.
    pages = F.filter("pages", lambda p: (now | ~p["again"]) & meets(p, "said3"))
    return met.select("rid", scalars.once(pages, lambda held: scalars.once(F.exists(held, lambda p: meets(p, "said4")), lambda four: part(held, four))).alias("part"))


def _first(found: Column) -> Column:
    return F.array_min(F.transform(found, lambda x: x["lo"]))


def _twins(found: Column, lo: Column) -> Column:
    """Whether the first page has another as short beside it."""
    return F.exists(found, lambda x: (x["lo"]["l"] == lo["l"]) & (x["twin"] | (x["lo"]["slug"] != lo["slug"])))


def _several(found: Column) -> Column:
    """Whether there are several products."""
    return scalars.once(F.try_element_at(found, F.lit(1))["lo"]["product"], lambda first: F.exists(found, lambda x: x["many"] | (x["lo"]["product"] != first)))


def _leading(parts: Column) -> Column:
    """any_player, pick, open, many: whether a title's player was met, the page that leads, whether others lead as well, and whether there are several products."""
    alike = ("now", "y", "set_slug", "support", "by_prefix")
    order = lambda x: F.struct(*[x[c] for c in ("support", "by_prefix", "score")])

    def met(four: Column) -> Column:
        each = lambda p: F.transform(p["kept"], lambda x: F.struct(*[p[c].alias(c) for c in alike], *[x[c].alias(c) for c in ("score", "tag", "lo", "twin", "many")]))
        return F.flatten(F.transform(F.filter(parts, lambda p: p["four"] == four), each))

    def good(found: Column) -> Column:
        most = F.array_max(F.transform(found, lambda x: x["support"]))
        return scalars.once(most, lambda top: F.filter(found, lambda x: F.when(top >= NAMED, x["support"] >= NAMED).otherwise(x["support"] == top)))

    def unstated(found: Column) -> Column:
        stated = F.transform(F.filter(found, lambda x: x["now"] & (x["tag"] != "")), lambda x: x["tag"])
        return scalars.once(stated, lambda tags: F.filter(found, lambda x: x["now"] | ~F.array_contains(tags, x["tag"])))

    def leads(found: Column) -> Column:
        return scalars.once(F.array_max(F.transform(found, order)), lambda most: F.filter(found, lambda x: order(x) == most))

    def result(found: Column, lead: Column, pick: Column) -> Column:
        places = F.array_distinct(F.transform(lead, lambda x: F.struct(x["y"], x["set_slug"])))
        return F.struct(F.exists(parts, lambda p: p["player"]).alias("any_player"), pick.alias("pick"), ((F.size(places) > 1) | _twins(lead, pick)).alias("open"), _several(found).alias("many"))

    found = scalars.once(scalars.once(scalars.once(F.exists(parts, lambda p: p["four"]), met), good), unstated)
    return scalars.once(found, lambda held: scalars.once(leads(held), lambda lead: scalars.once(_first(lead), lambda pick: result(held, lead, pick))))


def assign(rows: DataFrame, library: DataFrame, sets: DataFrame, parallels: Sequence[str], hard: Sequence[str], prefixes: DataFrame, tcg: str, coin: str, row_key: str = "row_id", title: str = "title") -> DataFrame:
    """(row key, status, slug, confidence): assigned, ambiguous, no_library_card, player_mismatch, missing_field, coins or non_sports_tcg.

    ``sets`` has name (as titles spell it) and set_slug; ``parallels`` are the words that part products of one player, ``hard`` those that a title
    never names without meaning them; ``tcg`` and ``coin`` are patterns of what the library doesn't hold.
    """
    raw = F.coalesce(F.col(title), F.lit(""))
    # Nothing but the title counts, so each title is looked up once, under the first of its row keys.
    t = rows.groupBy(raw.alias("raw")).agg(F.min(row_key).alias("rid")).select("rid", "raw", F.lower("raw").alias("low"), scalars.name_key(F.col("raw")).alias("t"))
    t = t.withColumn("words", F.filter(F.split("t", " "), lambda w: w != ""))
    year = scalars.match(F.col("low"), r"\b((?:19|20)[0-9]{2})\b")
    number = scalars.match(F.col("low"), r"#\s*([a-z0-9]+(?:-[a-z0-9]+)*)(?!\s*/\s*[0-9])\b")
    t = t.withColumns({"year": year, "number": number, "is_tcg": F.col("low").rlike(tcg), "is_coin": F.col("low").rlike(coin), "wants_auto": F.col("t").rlike(rules.any_word(AUTOGRAPH))})
    named = names_in(t, sets.select(scalars.name_key(F.col("name")).alias("cname")))
    longest = named.groupBy("rid").agg(F.max_by("cname", F.struct(F.length("cname"), "cname")).alias("set_name"))
    t = t.join(longest.hint("merge"), "rid", "left")
    full = t.filter("NOT is_tcg AND NOT is_coin AND year IS NOT NULL AND number IS NOT NULL AND set_name IS NOT NULL")
    # Kept as a table: titles are read by four steps.
    t = staged(t.join(_wanted(full, library, sets, prefixes).hint("merge"), "rid", "left").select("rid", "raw", "is_tcg", "is_coin", "year", "number", "set_name", "words", "wants_auto", "wants"), "titles")
    several = t.filter("size(wants) > 1").select(F.explode("wants.set_slug").alias("set_slug")).distinct()

    par = F.array(*[F.lit(p) for p in parallels]).cast("array<string>")
    said = F.array_except(F.filter("words", lambda w: w.rlike("^[a-z]{2,}$")), F.array(*map(F.lit, FILLER)))
    sure = F.array_intersect("words", F.array(*[F.lit(h) for h in hard]).cast("array<string>"))
    heard = [F.filter("said", lambda w: F.length(w) >= 3).alias("said3"), F.filter("said", lambda w: F.length(w) >= 4).alias("said4"), F.filter("said", lambda w: (F.length(w) >= 5) & ~F.array_contains(par, w)).alias("within")]
    asks = t.filter("wants IS NOT NULL").withColumn("said", F.array_except(said, F.split("set_name", " "))).select(
        "rid", "year", "wants_auto", *heard, F.array_intersect("words", par).alias("heard"), sure.alias("sure"),
        F.explode(F.array(F.col("year"), (F.col("year").cast("int") - 1).cast("string"))).alias("y"), _number_forms(F.col("number")).alias("forms"), "wants",
    )
    asks = asks.withColumn("key", F.explode("forms")).drop("forms").withColumn("want", F.explode("wants")).select("*", "want.*").drop("wants", "want")
    blocks = _blocks(library, several, par)
    met = asks.join(blocks.hint("merge"), (F.col("y") == F.col("ly")) & (F.col("set_slug") == F.col("ls")) & (F.col("key") == F.col("lk")) & ((F.col("y") == F.col("year")) | ~F.col("old")))
    found = _met(met).groupBy("rid").agg(F.collect_list("part").alias("parts"))
    per = found.select("rid", _leading(F.col("parts")).alias("per")).select("rid", "per.*")
    out = t.select("rid", "raw", "is_tcg", "is_coin", "year", "number", "set_name", (F.size(F.array_intersect("words", par)) == 0).alias("silent")).join(per.hint("merge"), "rid", "left")
    status = rules.first_of([
        (F.col("is_tcg"), "non_sports_tcg"), (F.col("is_coin"), "coins"), (F.col("year").isNull() | F.col("number").isNull() | F.col("set_name").isNull(), "missing_field"),
        (F.col("any_player").isNull(), "no_library_card"), (~F.col("any_player"), "player_mismatch"), (F.col("pick").isNull(), "no_library_card"), (F.col("open"), "ambiguous"),
    ], "assigned")
    out = out.withColumn("status", status)
    sure = F.when(F.col("silent") & F.col("many"), "low").otherwise("high")
    out = out.select("raw", "status", F.when(F.col("status") == "assigned", F.col("pick.slug")).alias("slug"), F.when(F.col("status") == "assigned", sure).alias("confidence"))
    return rows.select(row_key, raw.alias("raw")).join(out.hint("merge"), "raw").select(row_key, "status", "slug", "confidence")
