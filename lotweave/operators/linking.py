"""Titles to catalog cards: parsing, strict linking with reasons for refusal, variants, ids, vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, scalars
from ..staging import small_or_merged, staged
from .strict import names_in

#: Groups of cards with equal keys and set words are broadcast up to so many rows.
MAX_BROADCAST_CARDS = 100_000
#: Grading companies as titles name them.
GRADERS = ["psa", "bgs", "sgc", "cgc", "hga", "csg"]


def parse_title(title: Column) -> dict[str, Column]:
    """year, card number, serial, print run, grader, grade; null where a title doesn't say."""
    low = F.lower(title)
    run = scalars.match(low, r"(?:^|[^0-9])[0-9]{0,5}/([0-9]{1,5})(?:[^0-9]|$)").try_cast("int")
    grader = scalars.match(low, r"(?:^|[^a-z0-9])(" + "|".join(GRADERS) + r")(?:[^a-z]|$)")
    return {
        "year": scalars.match(title, r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)").try_cast("int"),
        "number": scalars.match(low, r"#\s*([a-z0-9][a-z0-9\-]*)"),
        "serial": scalars.match(low, r"(?:^|[^0-9])([0-9]{1,5})/[0-9]{1,5}(?:[^0-9]|$)").try_cast("int"),
        "print_run": run,
        "grader": F.upper(grader),
        "grade": scalars.match(low, r"(?:" + "|".join(GRADERS) + r")[a-z \-]*([0-9]{1,2}(?:\.5)?)(?:[^0-9.]|$)").try_cast("double"),
    }


#: Brands whose backs are printed as "brand series/factory".
BACKS = [
    "sweet caporal", "piedmont", "sovereign", "polar bear", "old mill", "hindu", "tolstoi", "american beauty", "carolina brights", "cycle", "broadleaf",
    "broad leaf", "uzit", "lenox", "drum",
]
#: Grades of the four companies that headlines name.
HEADLINE_GRADES = ["10", "9.5", "9", "8.5", "8", "7.5", "7", "6.5", "6", "5.5", "5", "4.5", "4", "3.5", "3", "2.5", "2", "1.5", "1"]


def parse_headline(title: Column) -> Column:
    """struct(year, code, code_key, serial, print_run, grade) of a sale's title.

    A serial is "12/99" that isn't part of a number or a brand's back ("Piedmont 150/25"); a run without a serial is "/99". Up to three words may stand
    between company and grade ("SGC NM+ 7.5").
    """
    t = F.coalesce(title, F.lit(""))
    fronts = F.regexp_replace(t, rf"(?i)\b(?:{'|'.join(b.replace(' ', ' +') for b in BACKS)}) +[0-9]{{2,3}} */ *[0-9]{{2,3}}\b", " ")
    serial = r"(?<![#\w])([0-9]{1,3})\s*/\s*([0-9]{1,4})\b"
    first, run = scalars.match(fronts, serial), scalars.match(fronts, serial, 2)
    code = scalars.match(t, r"#\s*([A-Za-z0-9]+(?:-[A-Za-z0-9]+)*)")
    grades = "|".join(g.replace(".", "[.]") for g in HEADLINE_GRADES)
    graded = rf"(?i)\b(PSA|BGS|SGC|CGC)\s*(?:[A-Za-z][A-Za-z+\-]*\.?\s+){{0,3}}({grades})(?![0-9.]*[0-9])"
    company = scalars.match(t, graded)
    return F.struct(
        scalars.match(t, r"\b(19[0-9]{2}|20[0-4][0-9])(?:[-/][0-9]{2})?\b").try_cast("int").alias("year"), code.alias("code"), scalars.number_key_plain(code).alias("code_key"),
        F.when(first.isNotNull(), F.concat_ws("/", first, run)).alias("serial"),
        F.coalesce(run, F.when(first.isNull(), scalars.match(fronts, r"/\s*([0-9]{1,4})\b"))).try_cast("int").alias("print_run"),
        F.when(company.isNotNull(), F.concat_ws(" ", F.upper(company), scalars.match(t, graded, 2))).alias("grade"),
    )


def name_windows(title: Column) -> Column:
    """Folded runs of two or three adjacent words that begin with a capital: what may be a player's name."""
    words = F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit("[A-Za-z][A-Za-z.'-]*"), F.lit(0))
    capital = F.transform(F.filter(words, lambda w: w.rlike("^[A-Z]")), lambda w: F.regexp_replace(F.lower(w), "[^a-z0-9]", ""))
    return scalars.once(capital, lambda w: F.array_distinct(F.concat(scalars.windows(w, 2, ""), scalars.windows(w, 3, ""))))


def grade_label(grader: Column, grade: Column) -> Column:
    return F.when(grader.isNull(), "Ungraded").when(grade.isNull(), grader).otherwise(F.concat_ws(" ", grader, F.regexp_replace(grade.cast("string"), r"\.0$", "")))


def link_titles(rows: DataFrame, catalog: DataFrame, names: str = "character", row_key: str = "row_id", title: str = "title", reject: str = rules.any_word(["lot", "bundle", "sealed", "box", "pack"])) -> DataFrame:
    """(row key, card_id, reason) by strict rules: a link only where exactly one card agrees, otherwise a reason.

    ``catalog`` has card_id, set_words (array), number, ``names``. Names match as whole folded word runs, the longest first; a name within
    a longer match doesn't count. Names are looked up by an equi-join on word runs of every length that a name has, so the catalog may be large.
    """
    t = rows.select(F.col(row_key).alias("rid"), scalars.name_key(F.col(title)).alias("t"), F.lower(F.col(title)).rlike(reject).alias("many"), parse_title(F.col(title))["number"].alias("num"))
    t = t.withColumn("words", F.filter(F.split("t", " "), lambda w: w != ""))
    cat = catalog.select("card_id", "set_words", scalars.number_key(F.col("number")).alias("cnum"), scalars.name_key(F.col(names)).alias("cname"))
    per = names_in(t, cat.select("cname")).groupBy("rid").agg(F.count(F.lit(1)).alias("n_names"), F.min("cname").alias("cname"))
    j = t.join(per.hint("merge"), "rid", "left")
    # A title without a number meets cards of any number: each card stands under its number and under "*", which is no number's key.
    numbered = cat.withColumn("key", F.explode(F.array(F.col("cnum"), F.lit("*")))).filter("key IS NOT NULL")
    titles = j.filter("n_names = 1").withColumn("key", F.when(F.col("num").isNull(), "*").otherwise(scalars.number_key(F.col("num"))))
    hits = _best_sets(titles, _card_groups(numbered, ["cname", "key", "set_words"]), "rid", "words", ["cname", "key"])
    out = j.join(hits.withColumnRenamed("__row", "rid").hint("merge"), "rid", "left")
    reason = rules.first_of([
        (F.col("many"), "not_single"), (F.col("n_names").isNull(), "character_unknown"), (F.col("n_names") > 1, "multiple_characters"),
        (F.col("__met").isNull(), "no_catalog_match"), (F.col("__lo") != F.col("__hi"), "ambiguous"),
    ], "ok")
    out = out.withColumn("reason", reason)
    return out.select(F.col("rid").alias(row_key), F.when(F.col("reason") == "ok", F.col("__lo")).alias("card_id"), "reason")


def _card_groups(catalog: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cards alike in ``by`` as one group, held by its smallest and largest id, since more than one card is a tie however many there are."""
    return catalog.groupBy(*by).agg(F.min("card_id").alias("__lo"), F.max("card_id").alias("__hi"))


def _most_words(met: DataFrame, by: str) -> DataFrame:
    """(by, __met, __lo, __hi): of the groups met, each with its number of set words as __met, those with most; their smallest and largest id."""
    n, lo = F.col("__met"), F.col("__lo")
    best = met.groupBy(by).agg(F.min(F.struct((-n).alias("n"), lo.isNull().alias("none"), lo.alias("id"))).alias("lo"), F.max(F.struct(n.alias("n"), F.col("__hi").alias("id"))).alias("hi"))
    return best.select(by, F.col("hi.n").alias("__met"), F.col("lo.id").alias("__lo"), F.col("hi.id").alias("__hi"))


def _best_sets(rows: DataFrame, groups: DataFrame, row_key: str, words: str, keys: Sequence[str]) -> DataFrame:
    """(__row, __met, __lo, __hi) of rows that meet a card: of cards with equal keys whose set words all occur in the row, those with most set words; their smallest and largest id.

    A row meets one of :func:`_card_groups` through the group's rarest set word, so not every group of its keys is held against it.
    """
    ks = [f"__k{i}" for i in range(len(keys))]
    named = [F.col(k).alias(n) for k, n in zip(keys, ks, strict=True)]
    groups = groups.select(*named, "set_words", "__lo", "__hi")
    each = groups.select("set_words").distinct().select("set_words", F.explode(F.array_distinct("set_words")).alias("__w"))
    rare = each.join(each.groupBy("__w").agg(F.count(F.lit(1)).alias("__n")), "__w").groupBy("set_words").agg(F.min(F.struct("__n", "__w"))["__w"].alias("__w"))
    # Sets without words belong to every row: both stand under an empty word.
    c = groups.join(rare, "set_words", "left").withColumn("__w", F.coalesce("__w", F.lit("")))
    said = F.explode(F.array_distinct(F.concat(words, F.array(F.lit("")))))
    r = rows.select(F.col(row_key).alias("__row"), *named, F.col(words).alias("__words"), said.alias("__w"))
    j = r.join(small_or_merged(c, MAX_BROADCAST_CARDS, groups), [*ks, "__w"]).filter(F.size(F.array_except("set_words", "__words")) == 0)
    return _most_words(j.withColumn("__met", F.size("set_words")), "__row")


def assign_by_set(rows: DataFrame, catalog: DataFrame, row_key: str, words: str | Column, keys: Sequence[str], set_words: str | Column = "set_words") -> DataFrame:
    """(row key, card_id, reason): cards with equal keys whose set words all occur in the row; the one with most set words, ties refused.

    ``words`` and ``set_words`` are columns or made of columns. Rows that differ in their row key alone are held against cards once, as are
    cards that differ in card_id alone, so neither table should have further columns. Rows of one row key share their best card; a null one has none.
    """
    made = lambda c, name: (F.col(c) if isinstance(c, str) else c).alias(name)
    groups = _card_groups(catalog, [c for c in catalog.columns if c != "card_id"])
    groups = staged(groups.select(*keys, made(set_words, "set_words"), "__lo", "__hi"), "card_groups")
    alike = [c for c in rows.columns if c != row_key]
    kinds = rows.select(*alike).distinct().select(F.struct(*alike).alias("__kind"), *keys, made(words, "__words"))
    hits = staged(_best_sets(kinds, groups, "__kind", "__words", keys).withColumnRenamed("__row", "__kind"), "set_hits")
    hits, r = small_or_merged(hits, MAX_BROADCAST_CARDS), rows.withColumnRenamed(row_key, "__row")
    same = F.col("__row").isNotNull()
    for c in alike:
        same = same & F.col(c).eqNullSafe(F.col(f"__kind.{c}"))
    if r.filter("__row IS NOT NULL").groupBy("__row").count().filter("count > 1").isEmpty():
        out = r.join(hits, same, "left")
    else:
        out = r.join(_most_words(r.join(hits, same), "__row").hint("merge"), "__row", "left")
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    tie = F.col("__lo") != F.col("__hi")
    status = F.when(missing, "missing_field").when(F.col("__met").isNull(), "no_card").when(tie, "ambiguous").otherwise("assigned")
    return out.select(F.col("__row").alias(row_key), F.when(~tie, F.col("__lo")).alias("card_id"), status.alias("status"))


def variant_matrix(cards: DataFrame, parallels: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every card with every parallel of its set: id ``card~parallel``."""
    return cards.join(parallels, list(on)).withColumn("variant_id", F.concat_ws("~", "card_id", scalars.slug(F.col("parallel"))))


def family(card_id: Column) -> Column:
    return F.substring_index(card_id, "~", 1)


def mint_id(category: Column, year: Column, set_name: Column, name: Column, number: Column, section: Column) -> Column:
    """category:year-set:name:number; sets without numbers use nn-section."""
    last = F.coalesce(F.nullif(scalars.number_key(number), F.lit("")), F.concat(F.lit("nn-"), scalars.slug(section)))
    return F.concat_ws(":", category, F.concat_ws("-", year.cast("string"), scalars.slug(set_name)), scalars.slug(name), last)


def token_counts(rows: DataFrame, words: Column, stop: Sequence[str] = ()) -> DataFrame:
    out = rows.select(F.explode(words).alias("token"))
    return (out.filter(~F.col("token").isin(list(stop))) if stop else out).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def dominant(rows: DataFrame, key: str, value: str, least: float = 0.8) -> DataFrame:
    """(key, value, share) where one value holds at least ``least`` of a key's rows."""
    from .monitor import majority

    return majority(rows, key, value).filter(F.col("share") >= least).select(key, value, "share")
