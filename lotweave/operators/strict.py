"""Strict linking of titles to catalog cards: a link only where set, section, number, name, parallel and print run agree, else one reason.

Word lists, sets and checklists are parameters: they belong to a catalog and not to the method. Everything is joins on word runs, codes and names;
checklists, which are short, travel with each candidate as an array.

Reasons, in the order in which they are looked for: other_line, not_single, grade_unknown, product_not_in_catalog, set_unknown,
multiple_characters, number_character_conflict, character_unknown, no_catalog_match, ambiguous, ambiguous_parallel,
parallel_not_on_checklist, numbered_parallel_unnamed, print_run_conflict, variation_possible, linked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cards, rules, scalars
from ..staging import small_enough, small_or_merged

#: Sets, sections and checklists are broadcast up to so many rows.
MAX_BROADCAST_SETS = 100_000
#: Distinct names are broadcast up to so many rows.
MAX_BROADCAST_NAMES = 100_000
#: Grading companies, the grades that titles state, and words that say only that a card is graded.
GRADERS = ["psa", "bgs", "sgc", "cgc", "tag", "bvg", "csg", "hga"]
GRADES = ["10", "9.5", "9", "8.5", "8", "7.5", "7", "6", "5", "4", "3", "2", "1"]
GRADED = ["gem mint", "gem mt", "gemmint", "gemmt", "gem 10", "graded", "slabbed", "slab", "pristine", "black label", "gma", "mint cards", "bccg", "ksa", "isa", "beckett"]
#: What says that a sale is of several things, and phrases with such a word that don't.
SEVERAL = [
    "lot", "lots", "bundle", "you pick", "pick your", "choose your", "u pick", "complete set", "full set", "team set", "factory sealed", "sealed pack", "box",
    "boxes", "packs", "pack of", "case", "break", "breaks", "[0-9]+ *x", "x *[0-9]+", "[0-9]+ cards",
]
STILL_SINGLE = ["pack fresh", "fresh from the pack", "fresh from pack", "fresh out of the pack", "fresh out of pack", "pulled from a pack", "pulled from pack", "case hit", "case hits"]
MORE = ["plus", "bonus", "extra", "extras", "include", "includes", "including", "comes with"]
AUTOGRAPH = ["auto", "autograph", "autographed", "signed"]


@dataclass(frozen=True)
class SetRule:
    """A title that has all ``words`` may be of the set; of the sets with most words, those of the one year that the title names."""

    set_key: str
    words: tuple[str, ...]
    year: int | None = None


@dataclass(frozen=True)
class LinkRules:
    """What belongs to a catalog. ``line``: words of which a title must have one, spaces apart; empty: any title will do."""

    sets: Sequence[SetRule]
    line: Sequence[str] = ()
    uncatalogued: Sequence[str] = ()
    sections: Mapping[str, Sequence[str]] = field(default_factory=dict)
    base: str = "base"
    aliases: Mapping[str, str] = field(default_factory=dict)
    variations: Mapping[str, Sequence[str]] = field(default_factory=dict)
    variation_words: Sequence[str] = ("ssp", "short print")


def grade_of(title: Column) -> Column:
    """``PSA 10``: the company, then up to two words of praise, then the grade; null if no grade can be read."""
    praise = r"(?:gem\s*(?:mt|mint)\s*|mint\s*|pristine\s*|gem\s*)?"
    pattern = rf"(?i)\b({'|'.join(GRADERS)})[\s-]*{praise}({'|'.join(g.replace('.', '[.]') for g in GRADES)})(?![.0-9])"
    company, grade = scalars.match(title, pattern), scalars.match(title, pattern, 2)
    return F.when(company.isNotNull(), F.concat_ws(" ", F.upper(company), grade))


def code_of(title: Column) -> Column:
    """The number after a number sign, its letters before a hyphen, or a bare code such as HG-2; a serial ("#37/99") and a grade ("PSA-9") are none."""
    signed = r"#\s*(?:([A-Za-z]{1,4})-\s*)?([0-9]{1,3})\b(?!\s*/)"
    letters, digits = scalars.match(title, signed), scalars.match(title, signed, 2)
    bare = scalars.match(title, rf"(?<![A-Za-z0-9#/-])((?!(?:{'|'.join(g.upper() for g in GRADERS)})-)[A-Z]{{1,4}}-[0-9]{{1,3}})\b")
    return F.coalesce(F.when(digits.isNotNull(), F.concat_ws("-", F.upper(letters), digits)), bare)


def names_in(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(rid, cname): names (cname, folded) that occur as whole word runs in rows (rid, words), but for those within a longer one.

    Found by an equi-join on word runs of every length that a name has.
    """
    sizes = [r[0] for r in names.select(F.size(F.split("cname", " ")).alias("n")).distinct().orderBy("n").collect()] or [1]
    runs = scalars.once(F.col("words"), lambda w: F.concat(*[scalars.windows(w, n) for n in sizes]))
    named = rows.select("rid", F.explode(F.array_distinct(runs)).alias("cname"))
    named = named.join(small_or_merged(names.select("cname").distinct(), MAX_BROADCAST_NAMES), "cname")
    spaced = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    found = named.groupBy("rid").agg(F.collect_set("cname").alias("all"))
    longest = F.filter("all", lambda c: ~F.exists("all", lambda o: (o != c) & spaced(o).contains(spaced(c))))
    return found.select("rid", F.explode(longest).alias("cname"))


def _read(rows: DataFrame, row_key: str, title: str, r: LinkRules) -> DataFrame:
    """What a title says by itself."""
    raw = F.coalesce(F.col(title), F.lit(""))
    plain = scalars.name_key(raw)
    for phrase, full in r.aliases.items():
        plain = F.regexp_replace(plain, rf"\b(?:{phrase})\b", full)
    t = rows.select(F.col(row_key).alias("rid"), raw.alias("raw"), plain.alias("t"))
    close = F.replace(F.col("t"), F.lit(" "), F.lit(""))
    single = F.regexp_replace("t", rf"\b(?:{'|'.join(STILL_SINGLE)})\b", " ")
    in_brackets = F.col("raw").rlike(r"^\W*\(\s*[2-9][0-9]*\s*\)") | F.col("raw").rlike(r"(?i)\(\s*[0-9]+\s*\)\s*and\b|\(\s*[0-9]+\s*\).*\b(?:set|collection|lot)\b")
    more = F.col("raw").rlike(r"\s\+\s*\w") | F.col("t").rlike(rules.any_word(MORE)) | F.col("t").rlike(r"\bfree\b(?!\s*(shipping|ship|s ?h|postage|returns?))")
    grade = grade_of(F.col("raw"))
    several = single.rlike(rf"\b(?:{'|'.join(SEVERAL)})\b") | in_brackets | more
    t = t.withColumn("words", F.filter(F.split("t", " "), lambda w: w != ""))
    t = t.withColumns({
        "other_line": ~F.array_contains(F.array(*[close.contains(F.lit(w)) for w in r.line]), True) if r.line else F.lit(False), "several": several, "grade": grade,
        "grade_unknown": grade.isNull() & (F.col("t").rlike(rules.any_word(GRADED)) | F.col("t").rlike(rules.any_word(GRADERS))),
        "uncatalogued": F.col("t").rlike(rules.any_word(r.uncatalogued)) if r.uncatalogued else F.lit(False), "code": code_of(F.col("raw")),
        "run": cards.print_run(F.col("raw")), "auto": F.col("t").rlike(rules.any_word(AUTOGRAPH)),
        "numbered": F.col("t").rlike(rules.any_word(["serial numbered", "serially numbered"])),
    })
    return t.join(_sets_of(t, r), "rid", "left").withColumn("sets", F.coalesce("sets", F.array().cast("array<struct<set_key:string,n:int,year:int>>")))


def _sets_of(t: DataFrame, r: LinkRules) -> DataFrame:
    """(rid, sets): the sets all of whose words a title has, those with most words, and of these the ones of the only year that it names."""
    words = [(s.set_key, w, len(set(s.words)), s.year) for s in r.sets for w in set(s.words)]
    of_sets = F.broadcast(t.sparkSession.createDataFrame(words, "set_key string, word string, n int, year int"))  # as large as the rules
    said = t.select("rid", "words", F.explode(F.array_distinct("words")).alias("word")).join(of_sets, "word")
    whole = said.groupBy("rid", "set_key", "n", "year").agg(F.count(F.lit(1)).alias("hits"), F.any_value("words").alias("words")).filter("hits = n")
    named = F.array_contains("words", F.col("year").cast("string"))
    per = whole.withColumn("most", F.max("n").over(Window.partitionBy("rid"))).filter("n = most")
    per = per.withColumns({"named": F.coalesce(named, F.lit(False)), "in_year": F.size(F.collect_set(F.when(named, F.col("year"))).over(Window.partitionBy("rid")))})
    return per.filter("in_year <> 1 OR named").groupBy("rid").agg(F.collect_list(F.struct("set_key", "n", "year")).alias("sets"))


def _candidates(t: DataFrame, catalog: DataFrame, r: LinkRules) -> DataFrame:
    """(rid, card columns): cards of the title's sets that its number and name agree with."""
    sections = catalog.groupBy("set_key").agg(F.collect_set("section").alias("has"))
    prefix = F.regexp_extract("code", "^([A-Z]+)-", 1)
    prefixes = catalog.filter(prefix != "").select("set_key", prefix.alias("prefix"), "section").distinct()
    per_set = prefixes.groupBy("set_key").agg(F.collect_set(F.struct("prefix", "section")).alias("prefixes"))
    e = t.select("rid", "t", "code", "cname", "auto", F.explode("sets").alias("s")).select("*", F.col("s.set_key").alias("set_key")).drop("s")
    e = e.join(small_enough(sections, MAX_BROADCAST_SETS), "set_key").join(small_enough(per_set, MAX_BROADCAST_SETS), "set_key", "left")
    known = F.coalesce("prefixes", F.array().cast("array<struct<prefix:string,section:string>>"))
    own = F.regexp_extract(F.coalesce("code", F.lit("")), "^([A-Z]+)-", 1)
    by_prefix = F.try_element_at(F.filter(known, lambda p: p["prefix"] == own), F.lit(1))["section"]
    by_word = F.coalesce(F.lit(None).cast("string"), *[F.when(F.array_contains("has", name) & F.col("t").rlike(rules.any_word(list(words))), F.lit(name)) for name, words in r.sections.items()])
    section = F.when(own != "", by_prefix).otherwise(F.coalesce(by_word, F.when(~F.col("auto"), F.lit(r.base))))
    e = e.withColumn("section", section).filter(F.col("section").isNotNull())
    put = F.try_element_at(F.filter(known, lambda p: p["section"] == F.col("section")), F.lit(1))["prefix"]
    e = e.withColumn("code_in", F.when((own == "") & put.isNotNull() & F.col("code").isNotNull(), F.concat_ws("-", put, "code")).otherwise(F.col("code")))
    c = catalog.select(F.col("set_key").alias("k"), F.col("section").alias("cs"), F.upper("code").alias("cc"), scalars.name_key(F.col("character")).alias("cn"), "card_id", "character")
    same = (F.col("set_key") == F.col("k")) & (F.col("section") == F.col("cs"))
    by_code = e.filter("code_in IS NOT NULL").join(c, same & (F.col("code_in") == F.col("cc"))).filter(F.col("cname").isNull() | (F.col("cn") == F.col("cname")))
    by_name = e.filter("code_in IS NULL AND cname IS NOT NULL").join(c, same & (F.col("cname") == F.col("cn")))
    return by_code.unionByName(by_name).select("rid", "card_id", "set_key", "section", F.col("cc").alias("card_code"), F.col("cn").alias("card_name"))


def _parallel(p: Column, title_has_refractor: Column, r: LinkRules) -> Column:
    """struct(parallel, run, basis, why) from what a title says (``p``: features, stated run, checklist and more); ``why`` is a reason or null."""
    f, table, run = p["features"], p["checklist"], p["run"]
    finish, colour, mod = F.try_element_at(f["finishes"], F.lit(1)), F.try_element_at(f["colours"], F.lit(1)), f["modifier"]
    many = (F.size(f["finishes"]) > 1) | (F.size(f["colours"]) > 1) | (mod == "?")
    mixed = finish.isNotNull() & colour.isNotNull() & (finish != "catfractor")
    named = finish.isNotNull() | colour.isNotNull() | mod.isNotNull()
    plain = F.filter(table, lambda x: x["finish"].isNull())
    exact = F.filter(plain, lambda x: x["colour"].eqNullSafe(colour) & x["modifier"].eqNullSafe(mod))
    one_sided = F.when(mod.isNull(), F.filter(plain, lambda x: x["colour"] == colour)).when(colour.isNull(), F.filter(plain, lambda x: x["modifier"] == mod)).otherwise(F.slice(table, 1, 0))
    listed = F.exists(table, lambda x: x["name"] == "Refractor")
    base = F.filter(table, lambda x: x["name"] == F.when(title_has_refractor & listed, "Refractor").otherwise("Base"))
    empty = F.array(F.struct(F.lit("Base").alias("name"), F.lit(None).cast("int").alias("run"), *[F.lit(None).cast("string").alias(n) for n in ("finish", "colour", "modifier")]))
    found = F.when(finish.isNotNull(), F.filter(table, lambda x: x["finish"] == finish)).when(named, F.when(F.size(exact) > 0, exact).otherwise(one_sided)).otherwise(F.when(F.size(base) > 0, base).otherwise(empty))
    hit = F.try_element_at(found, F.lit(1))
    is_base = hit["name"] == "Base"
    by_run = F.filter(table, lambda x: (x["run"] == run) & (x["name"] != "Base"))
    inferred = run.isNotNull() & hit["run"].isNull() & ~named & (F.size(by_run) == 1) & (p["section"] == r.base)
    varied = F.lit(False)
    for set_key, codes in r.variations.items():
        varied = varied | ((p["set_key"] == set_key) & p["card_code"].isin(list(codes)) & run.isNull() & (F.arrays_overlap(f["colours"], F.array(F.lit("purple"), F.lit("green"))) | p["variation_word"]))
    why = rules.first_reason([
        (many | mixed, F.lit("ambiguous_parallel")), (F.size(found) == 0, F.lit("parallel_not_on_checklist")), (F.size(found) > 1, F.lit("ambiguous_parallel")),
        (run.isNotNull() & hit["run"].isNull() & ~inferred, F.lit("numbered_parallel_unnamed")), (p["numbered"] & run.isNull() & is_base & hit["run"].isNull(), F.lit("numbered_parallel_unnamed")),
        (run.isNotNull() & ~inferred & (run != hit["run"]) & named, F.lit("print_run_conflict")), (run.isNotNull() & ~inferred & (run != hit["run"]), F.lit("numbered_parallel_unnamed")),
        (varied, F.lit("variation_possible")),
    ])
    basis = F.when(inferred, "inferred_from_print_run").when(named | (hit["name"] == "Refractor"), "named_in_title").otherwise("default_none_named")
    return F.struct(F.when(inferred, by_run[0]["name"]).otherwise(hit["name"]).alias("parallel"), F.when(inferred, run).otherwise(hit["run"]).alias("run"), basis.alias("basis"), why.alias("why"))


def link(rows: DataFrame, catalog: DataFrame, checklist: DataFrame, r: LinkRules, row_key: str = "row_id", title: str = "title") -> DataFrame:
    """(row key, card_id, set_key, section, code, parallel, print_run, parallel_basis, grade, rule, reason), one row per row.

    ``catalog`` has card_id, set_key, section, code (null for sets without numbers), character; ``checklist`` set_key, section, parallel, run (null: not
    numbered; a row ``Base`` gives a numbered base its run). A title without a readable grade is ``Raw``.
    """
    t = _read(rows, row_key, title, r)
    names = catalog.select(scalars.name_key(F.col("character")).alias("cname")).filter("cname <> ''")
    per = names_in(t, names).groupBy("rid").agg(F.count(F.lit(1)).alias("n_names"), F.min("cname").alias("cname"))
    t = t.join(per, "rid", "left").withColumn("n_names", F.coalesce("n_names", F.lit(0)))
    open_ = ~F.col("other_line") & ~F.col("several") & ~F.col("grade_unknown") & ~F.col("uncatalogued") & (F.size("sets") > 0) & (F.col("n_names") <= 1)
    hits = _candidates(t.filter(open_), catalog, r)
    one = hits.groupBy("rid").agg(F.count(F.lit(1)).alias("n_hits"), F.min_by(F.struct("card_id", "set_key", "section", "card_code", "card_name"), "card_id").alias("hit"))
    j = t.join(one, "rid", "left")

    feats = cards.parallel_features(F.col("parallel"))
    lists = checklist.select("set_key", "section", "parallel", F.col("run").cast("int").alias("run"), feats.alias("f"))
    first = lambda c: F.try_element_at(F.col(c), F.lit(1))
    entry = F.struct(F.col("parallel").alias("name"), "run", first("f.finishes").alias("finish"), first("f.colours").alias("colour"), F.col("f.modifier").alias("modifier"))
    lists = lists.groupBy(F.col("set_key").alias("lk"), F.col("section").alias("ls")).agg(F.collect_list(entry).alias("checklist"))
    j = j.join(small_enough(lists, MAX_BROADCAST_SETS), (F.col("hit.set_key") == F.col("lk")) & (F.col("hit.section") == F.col("ls")), "left")
    # The card's own name words ("Lucky Black Cat") say nothing of a parallel.
    rest = F.trim(F.replace(F.concat(F.lit(" "), F.col("t"), F.lit(" ")), F.concat(F.lit(" "), F.col("hit.card_name"), F.lit(" ")), F.lit("  ")))
    none = F.slice(F.array(F.struct(F.lit("").alias("name"), F.lit(0).alias("run"), *[F.lit("").alias(n) for n in ("finish", "colour", "modifier")])), 1, 0)
    said = F.struct(
        cards.parallel_features(rest).alias("features"), F.coalesce("checklist", none).alias("checklist"), "run", "numbered", F.col("hit.section").alias("section"), F.col("hit.set_key").alias("set_key"),
        F.col("hit.card_code").alias("card_code"), F.col("t").rlike(rules.any_word(list(r.variation_words))).alias("variation_word"),
    )
    j = j.withColumn("par", F.when(F.col("n_hits") == 1, scalars.once(said, lambda p: _parallel(p, rest.rlike(r"\b(?:refractor|rf)\b"), r))))
    unmatched = F.when(F.col("code").isNotNull() & F.col("cname").isNotNull(), "number_character_conflict").when(F.col("code").isNull() & F.col("cname").isNull(), "character_unknown").otherwise("no_catalog_match")
    reason = rules.first_reason([
        (F.col("other_line"), F.lit("other_line")), (F.col("several"), F.lit("not_single")), (F.col("grade_unknown"), F.lit("grade_unknown")),
        (F.col("uncatalogued"), F.lit("product_not_in_catalog")), (F.size("sets") == 0, F.lit("set_unknown")), (F.col("n_names") > 1, F.lit("multiple_characters")),
        (F.col("n_hits").isNull(), unmatched), (F.col("n_hits") > 1, F.lit("ambiguous")), (F.col("par.why").isNotNull(), F.col("par.why")), (F.lit(True), F.lit("linked")),
    ])
    rule = F.when(F.col("code").isNotNull() & F.col("cname").isNotNull(), "code+character").when(F.col("code").isNotNull(), "code").otherwise("character")
    j = j.withColumn("reason", reason)
    if_linked = lambda c: F.when(F.col("reason") == "linked", c)
    return j.select(
        F.col("rid").alias(row_key), if_linked(F.col("hit.card_id")).alias("card_id"), if_linked(F.col("hit.set_key")).alias("set_key"), if_linked(F.col("hit.section")).alias("section"),
        if_linked(F.col("hit.card_code")).alias("code"), if_linked(F.col("par.parallel")).alias("parallel"), if_linked(F.coalesce(F.col("par.run"), F.col("run"))).alias("print_run"),
        if_linked(F.col("par.basis")).alias("parallel_basis"), if_linked(F.coalesce("grade", F.lit("Raw"))).alias("grade"), if_linked(rule).alias("rule"), "reason",
    )


# --- sets without numbers ---------------------------------------------------------------------------------------------
def link_finishes(
    rows: DataFrame, catalog: DataFrame, finishes: Sequence[str], sections: Mapping[str, Sequence[str]], runs: DataFrame, other: Sequence[str] = (),
    base: str = "base", row_key: str = "row_id", title: str = "title",
) -> DataFrame:
    """(row key, card_id, section, parallel, print_run, grade, reason) for sets whose cards have a name, a finish and perhaps a background, but no number.

    "Gold on Silver" is a finish on a background. ``catalog`` has card_id, section, character; ``sections`` the words of each section but ``base``;
    ``runs`` section, parallel, run. A number on such a title is a serial. Reasons: other_product (one of ``other``), ambiguous_section,
    character_unknown, multiple_characters, character_not_in_section, ambiguous_parallel, numbered_parallel_unnamed, finish_unnamed,
    print_run_conflict, linked.
    """
    raw = F.coalesce(F.col(title), F.lit(""))
    t = rows.select(F.col(row_key).alias("rid"), raw.alias("raw"), scalars.name_key(raw).alias("t"))
    t = t.withColumn("words", F.filter(F.split("t", " "), lambda w: w != ""))
    some = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(F.col("t").rlike(rules.any_word(list(w))), F.lit(s)) for s, w in sections.items()]))
    t = t.withColumn("some", some).withColumn("section", F.coalesce(F.try_element_at("some", F.lit(1)), F.lit(base)))
    t = t.withColumn("run", cards.print_run(F.col("raw"))).withColumn("numbered", F.col("run").isNotNull() | F.col("raw").rlike(r"#\s*[0-9/]") | F.col("t").rlike(rules.any_word(["numbered"])))
    c = catalog.select("card_id", F.col("section").alias("cs"), scalars.name_key(F.col("character")).alias("cname"))
    per = names_in(t, c.select("cname")).groupBy("rid").agg(F.count(F.lit(1)).alias("n_names"), F.min("cname").alias("cname"))
    j = t.join(per, "rid", "left").join(c.withColumnRenamed("cname", "cn"), (F.col("cname") == F.col("cn")) & (F.col("section") == F.col("cs")), "left")
    rest = F.replace(F.concat(F.lit(" "), F.col("t"), F.lit(" ")), F.concat(F.lit(" "), F.coalesce("cname", F.lit("")), F.lit(" ")), F.lit("  "))
    known = "|".join(sorted((folded(f) for f in finishes), key=len, reverse=True))
    j = j.withColumn("said", F.regexp_extract_all(rest, F.lit(rf"\b({known})\b"), F.lit(1)))
    j = j.withColumn("pair", scalars.match(rest, rf"\b((?:{known}) on (?:{known}))\b"))
    plain = F.array_distinct("said")
    parallel = F.when(F.col("pair").isNotNull() & (F.size("said") == 2), F.col("pair")).when(F.col("pair").isNull() & (F.size(plain) == 1), plain[0])
    j = j.withColumn("par", F.when(F.col("section") == base, parallel).otherwise(F.coalesce(parallel, F.lit("base"))))
    k = runs.select(F.col("section").alias("rs"), scalars.name_key(F.col("parallel")).alias("rp"), F.col("run").cast("int").alias("fixed"))
    j = j.join(small_enough(k, MAX_BROADCAST_SETS), (F.col("section") == F.col("rs")) & (F.col("par") == F.col("rp")), "left")
    bad = F.col("t").rlike(rules.any_word(list(other))) if other else F.lit(False)
    reason = rules.first_reason([
        (bad, F.lit("other_product")), (F.size("some") > 1, F.lit("ambiguous_section")), (F.col("n_names").isNull(), F.lit("character_unknown")), (F.col("n_names") > 1, F.lit("multiple_characters")),
        (F.col("card_id").isNull(), F.lit("character_not_in_section")), (F.size("said") > F.when(F.col("pair").isNotNull(), 2).otherwise(1), F.lit("ambiguous_parallel")),
        (F.col("numbered") & F.col("pair").isNull() & F.col("fixed").isNull(), F.lit("numbered_parallel_unnamed")), (F.col("par").isNull(), F.lit("finish_unnamed")),
        ((F.col("fixed") != F.col("run")), F.lit("print_run_conflict")), (F.lit(True), F.lit("linked")),
    ])
    j = j.withColumn("reason", reason)
    if_linked = lambda x: F.when(F.col("reason") == "linked", x)
    return j.select(
        F.col("rid").alias(row_key), if_linked(F.col("card_id")).alias("card_id"), if_linked(F.col("section")).alias("section"), if_linked(F.col("par")).alias("parallel"),
        if_linked(F.coalesce("fixed", "run")).alias("print_run"), if_linked(F.coalesce(grade_of(F.col("raw")), F.lit("Raw"))).alias("grade"), "reason",
    )


def folded(text: str) -> str:
    """A short constant folded as :func:`..functions.scalars.name_key` folds columns."""
    import re
    import unicodedata

    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    return re.sub("[^a-z0-9]+", " ", re.sub("['`]", "", plain)).strip()
