"""Whether a title can be a certain card: words of set, parallel and product line, print runs, and what a title says of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import listings, rules, scalars

# Words that decide which card a title names.
SET_STOP = {"cards", "card", "trading", "basketball", "baseball", "football", "hockey", "soccer", "the", "and", "of", "a", "set"}
#: Makers and lines that titles often leave out.
BRANDS = {"panini", "topps", "upper", "deck", "ud", "pokemon", "japanese", "english", "skybox", "fleer"}
PARALLELS = {
    "superfractor", "refractor", "xfractor", "gold", "red", "orange", "black", "blue", "green", "purple", "pink", "silver", "platinum", "nebula",
    "shimmer", "wave", "mojo", "atomic", "sapphire", "padparadscha", "emerald", "ruby", "cracked", "ice", "hyper", "power", "disco", "camo", "tiger",
    "zebra", "snakeskin", "laser", "lazer", "velocity", "rainbow", "sepia", "negative", "aqua", "teal", "bronze", "copper", "yellow", "lime",
    "magenta", "fuchsia", "sparkle", "geometric", "precious", "gems",
}
PRODUCTS = {
    "chrome", "finest", "bowman", "mini", "tiffany", "update", "traded", "optic", "select", "mosaic", "prizm", "stadium", "archives", "gallery",
    "draft", "national", "treasures", "contenders", "absolute", "donruss", "ultra", "metal", "exquisite", "flawless", "immaculate", "spectra",
    "obsidian", "origins", "chronicles", "hoops", "kaboom", "downtown", "sticker", "dynasty", "tribute", "inception", "sterling", "variation",
    "championship",
}
SYNONYMS = {
    "autographs": "auto", "autograph": "auto", "autos": "auto", "autographed": "auto", "rookies": "rookie", "rc": "rookie", "refractors": "refractor",
    "prizms": "prizm", "superfractors": "superfractor", "patches": "patch",
}
#: Teams, slab labels and certificates whose colour words name no parallel.
NOT_PARALLEL = ["red sox", "white sox", "blue jays", "golden state", "pristine black label", "black label", "gold label", "silver label", "gold diamond certified"]
CERTIFICATES = r"mba (?:gold|silver|bronze)(?: diamond)?(?: certified)?"
#: Colours, finishes and words before or after that make one parallel of several words.
COLOURS = ["green", "aqua", "pink", "yellow", "blue", "purple", "gold", "pearl", "orange", "black", "red", "teal", "white", "silver", "bronze", "rainbow", "platinum", "sapphire"]
FINISHES = {
    "catfractor": ["catfractor", "cat fractor", "black cat refractor", "black cat rf"], "superfractor": ["superfractor", "super fractor"],
    "blast off": ["blast off", "blastoff"], "x-fractor": ["x fractor", "xfractor"], "shimmer": ["shimmer"],
}
MODIFIERS = {"mini-diamond": ["mini diamond", "minidiamond"], "raywave": ["raywave", "ray wave"], "wave": ["wave"]}


def _whole(terms: list[str]) -> str:
    """A pattern for any of the terms between word boundaries that it doesn't take in, so that neighbours are replaced too."""
    return r"\b(?:" + "|".join(terms) + r")\b"


def words_of(text: Column) -> Column:
    """Distinct folded words that aren't numbers, each by its common form."""
    same = F.create_map(*[F.lit(x) for kv in SYNONYMS.items() for x in kv])
    words = scalars.tokens(scalars.to_ascii(text))
    return F.array_distinct(F.transform(F.filter(words, lambda w: ~w.rlike("^[0-9]+$")), lambda w: F.coalesce(F.try_element_at(same, w), w)))


def _set_of(words: set[str]) -> Column:
    return F.array(*[F.lit(w) for w in sorted(words)])


def _any(words: Column) -> Column:
    return F.size(words) > 0


def _listed(prefix: str, words: Column) -> Column:
    return F.concat(F.lit(prefix), F.array_join(F.sort_array(words), " "))


def mismatch(title: Column, set_name: Column, parallel: Column, run: Column, card_run: Column, year: Column | None = None, card_year: Column | None = None) -> Column:
    """Why a title can't be the card, the first reason that holds; null if it can be. Player and number are the caller's to check.

    In turn: several items; another year; words of the set that the title lacks (makers apart); another product line; a signed copy of a card without
    autograph; words of the parallel that the title lacks; a parallel that the card lacks; another print run. An unknown year or run is no reason.
    """
    plain = F.regexp_replace(F.lower(title), _whole([*NOT_PARALLEL, CERTIFICATES]), " ")
    said, of_set, of_parallel = words_of(plain), F.array_except(words_of(set_name), _set_of(SET_STOP)), F.array_except(words_of(parallel), _set_of(SET_STOP))

    def first_reason(w: Column) -> Column:
        said, of_set, of_parallel = w["said"], w["of_set"], w["of_parallel"]
        own = F.array_union(of_set, of_parallel)
        lacking = F.array_except(F.array_except(of_set, _set_of(BRANDS)), said)
        lines = F.array_except(F.array_intersect(_set_of(PRODUCTS), said), own)
        unnamed = F.array_except(of_parallel, said)
        others = F.array_except(F.array_intersect(_set_of(PARALLELS), said), own)
        return rules.first_reason([
            (w["several"], F.lit("not a single card (set, lot or sealed product)")),
            (w["year"] != w["card_year"], F.concat(F.lit("year "), w["year"].cast("string"), F.lit(" vs catalog "), w["card_year"].cast("string"))),
            (_any(lacking), _listed("set words not in the title: ", lacking)),
            (_any(lines), _listed("title names another product line: ", lines)),
            (F.arrays_overlap(said, _set_of({"auto", "signed"})) & ~F.array_contains(own, "auto"), F.lit("signed copy of a card with no autograph version (after-market signature)")),
            (_any(unnamed), _listed("catalog parallel not in the title: ", unnamed)),
            (_any(others), _listed("title names a parallel the card lacks: ", others)),
            ((w["run"] > 0) & (w["card_run"] > 0) & (w["run"] != w["card_run"]), F.concat(F.lit("print run /"), w["run"].cast("string"), F.lit(" vs /"), w["card_run"].cast("string"))),
        ])

    none = F.lit(None).cast("int")
    given = F.struct(
        listings.names_set(title).alias("several"), said.alias("said"), of_set.alias("of_set"), of_parallel.alias("of_parallel"), run.cast("int").alias("run"),
        card_run.cast("int").alias("card_run"), (none if year is None else year.cast("int")).alias("year"), (none if card_year is None else card_year.cast("int")).alias("card_year"),
    )
    return scalars.once(given, first_reason)


def parallel_features(text: Column, finishes: Mapping[str, list[str]] = FINISHES, modifiers: Mapping[str, list[str]] = MODIFIERS) -> Column:
    """struct(finishes, colours, modifier) that a text names; the modifier is ``?`` if it names several.

    A finish's words are gone before colours are read, so "black cat refractor" names no black. "ray wave" is no wave.
    """
    plain = scalars.name_key(text)
    found = F.array_compact(F.array(*[F.when(plain.rlike(rules.any_word(terms)), F.lit(name)) for name, terms in finishes.items()]))
    rest = F.regexp_replace(plain, _whole([t for terms in finishes.values() for t in terms]), " ")

    def read(rest: Column) -> Column:
        words = scalars.tokens(rest)
        colours = F.array_intersect(F.array(*[F.lit(c) for c in COLOURS]), words)
        bare = F.regexp_replace(rest, _whole(modifiers["raywave"]), " ") if "raywave" in modifiers else rest
        mods = F.array_compact(F.array(*[F.when((bare if n == "wave" else rest).rlike(rules.any_word(t)), F.lit(n)) for n, t in modifiers.items()]))
        return F.struct(colours.alias("colours"), F.when(F.size(mods) > 1, "?").otherwise(F.try_element_at(mods, F.lit(1))).alias("modifier"))

    seen = scalars.once(rest, read)
    return F.struct(found.alias("finishes"), seen["colours"].alias("colours"), seen["modifier"].alias("modifier"))


def print_run(title: Column) -> Column:
    """The run that a title states: "27/99" or "/99" is 99, "1/1" and "one of one" are 1."""
    low = F.lower(title)
    stated = scalars.match(low, r"(?:(?:^|[^0-9/])[0-9]{1,4}\s*/\s*|(?:^|[^0-9/])/\s*)([0-9]{1,4})(?:[^0-9]|$)").try_cast("int")
    return F.coalesce(stated, F.when(low.rlike(rules.any_word(["one of one"])), 1))
