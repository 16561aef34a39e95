"""Judgements on single listings as Columns: what a title names, pictures, payment, identifying keys, details from specifics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import once, tokens

# Words and phrases that decide what a title is, in lower case.
#: A title with one of these is several items, a sealed product or no physical card.
EXCLUDED = {
    "lot", "lots", "bundle", "collection", "pack", "packs", "box", "boxes", "sealed", "mystery", "repack", "supplies", "digital", "wrapper",
    "multiple", "set of", "complete set", "bulk", "case", "hobby box", "blaster", "hanger", "cello", "fat pack", "mega box", "retail box", "booster",
}
SEALED = {
    "booster", "blister", "box", "pack", "bundle", "case", "tin", "collection", "deck", "etb", "elite trainer", "display", "carton", "sleeve",
    "portfolio", "binder", "figure", "pin", "playmat", "poster",
}
#: Things other than cards.
OBJECTS = {
    "comic", "comics", "pages", "wata", "vga", "video game", "video games", "nintendo", "sega", "atari", "playstation", "xbox", "coin", "coins",
    "stamp", "stamps", "cabinet", "photograph", "photographs", "bat", "bats", "jersey", "jerseys", "uniform", "uniforms", "ball", "balls", "glove",
    "gloves", "helmet", "helmets", "cleats", "shoes", "sneaker", "sneakers", "trophy", "trophies", "ring", "rings", "program", "programs",
    "lobby card", "lobby cards", "giclee", "canvas", "pennant", "pennants", "poster", "posters", "magazine", "magazines", "figure", "figures",
    "figurine", "figurines", "toy", "toys", "funko", "signed letter", "handwritten letter", "document", "documents", "contract", "contracts",
    "check", "checks", "painting", "paintings", "artwork", "original art", "different", "album", "sheet", "sheets", "uncut", "lithograph",
}
#: What an auction house's lots are if not one card.
LOT_OBJECTS = {
    "collection", "collections", "lot of", "lots of", "group of", "complete set", "near complete", "nearly complete", "partial set", "set of",
    "sets of", "sets", "run of", "hoard", "archive", "album", "scrapbook", "uncut", "sheet", "sheets", "pack", "packs", "box", "boxes", "case",
    "cases", "wax", "display", "original art", "original artwork", "artwork", "painting", "photograph", "photographs", "letter", "letters",
    "document", "documents", "contract", "contracts", "check", "checks", "jersey", "jerseys", "uniform", "uniforms", "helmet", "helmets", "trophy",
    "trophies", "ring", "rings", "ticket", "tickets", "program", "programs", "pennant", "pennants", "poster", "posters", "trio", "pair", "duo",
    "bat", "bats", "ball", "balls", "glove", "gloves",
}
#: A word before or after that makes a thing a pose, a brand or a nickname.
POSE_BEFORE = {
    "bat": ["with", "holding", "the"], "bats": ["with", "holding", "the"], "ball": ["with", "holding", "play"], "balls": ["with", "holding", "play"],
    "coin": ["gold"], "coins": ["gold"], "collection": ["exquisite"], "collections": ["exquisite"], "ticket": ["rookie"], "tickets": ["rookie"],
}
POSE_AFTER = {"bat": ["off", "on"], "bats": ["off", "on"], "glove": ["show", "showing", "shows"], "gloves": ["show", "showing", "shows"]}
SIGNED = {"signed", "autographed", "game used", "game worn"}
SIGNED_THINGS = {"baseball", "football", "basketball", "puck", "ball", "bat", "jersey", "photo", "helmet", "glove", "cleats", "shoes"}
MEMORABLE = SIGNED | {"inscribed", "photo matched"}
MEMORABLE_THINGS = {
    "baseball", "baseballs", "football", "footballs", "basketball", "basketballs", "hockey puck", "hockey pucks", "puck", "pucks", "ball", "balls",
    "bat", "bats", "jersey", "jerseys", "photo", "photos", "photograph", "photographs", "helmet", "helmets", "glove", "gloves", "cleats", "shoes",
    "sneakers", "bobblehead", "bobbleheads", "pennant", "pennants", "program", "programs", "ticket", "tickets", "lithograph", "lithographs", "print", "prints",
}
WORN = {"game used", "game worn", "photo matched"}
WORN_CARDS = {"card", "patch", "relic", "swatch"}
CARDS = {"card", "cards"}
#: One of these, or a number sign before a number or letter, marks a card.
CARD_MARKS = {"card", "cards", "rookie", "rc", "psa", "bgs", "sgc", "cgc", "hga", "csg", "bvg", "bccg", "gai", "ksa", "isa"}
#: Whole auctions of other things.
OTHER_AUCTIONS = {
    "comic", "comics", "video game", "video games", "coin", "coins", "photography", "hollywood", "game used", "game worn", "sneaker", "sneakers",
    "wine", "watch", "watches", "stamp", "stamps", "toy", "toys", "music", "entertainment",
}
SETS = {
    "complete set", "near complete", "nearly complete", "team set", "partial set", "master set", "set w", "set with", "set of", "sets of", "lot of",
    "collection of", "card collection", "unopened", "sealed", "wax box", "hobby box", "blaster box", "wax pack", "box of", "case of", "hobby case",
}
#: Letters of old catalogue codes, such as T206.
CODE_LETTERS = "TENMRDW"
FIRST_YEAR, LAST_YEAR = 1850, 2099
#: Flags of a title for which a row isn't loaded, and the words that raise each.
TITLE_FLAGS = {
    "lot": ["lot", "lots"], "box": ["box", "boxes"], "sealed": ["sealed"], "break": ["break", "breaks", "breaker"], "pack": ["pack", "packs"],
    "reprint": ["reprint", "reprints"], "custom": ["custom"], "digital": ["digital"],
    "non_card": ["non card", "noncard", "poster", "photo", "coin", "pin", "sticker only"],
}
KINDS = [
    ("multi_card_or_lot", ["lot", "lots", "bundle", "collection"]),
    ("sealed_or_pack", ["box", "boxes", "pack", "packs", "sealed", "case"]),
    ("non_card_collectible", ["ticket", "photo", "poster", "comic", "coin", "game"]),
]
KEY = r"^[A-Za-z0-9._-]{1,128}$"


# --- titles -----------------------------------------------------------------------------------------------------------
def title_kind(title: Column, kinds: Sequence[tuple[str, Sequence[str]]] = KINDS, default: str = "card_or_unknown") -> Column:
    """The first kind one of whose words is among the title's."""
    words, out = tokens(title), None
    for name, some in kinds:
        hit = F.arrays_overlap(words, F.array(*map(F.lit, some)))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def _at(words: Column, i: Column) -> Column:
    """The word at position ``i`` from 0; null outside."""
    return F.when(i >= 0, F.try_element_at(words, i + 1))


def _among(words: Column, i: Column, terms: Iterable[str]) -> Column:
    """Whether one of ``terms`` (words, or pairs of words) begins at position ``i``."""
    single, pairs = sorted(t for t in terms if " " not in t), sorted(t for t in terms if " " in t)
    hit = F.lit(False)
    if single:
        hit = hit | F.coalesce(_at(words, i).isin(single), F.lit(False))
    if pairs:
        hit = hit | F.coalesce(F.concat_ws(" ", _at(words, i), _at(words, i + 1)).isin(pairs), F.lit(False))
    return hit


def _positions(words: Column) -> Column:
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))


def has_term(words: Column, terms: Iterable[str], before: Mapping[str, Sequence[str]] | None = None, after: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Whether one of ``terms`` is among the words, but for words that a neighbour excuses."""

    def excused(i: Column) -> Column:
        out = F.lit(False)
        for step, excuses in ((-1, before or {}), (1, after or {})):
            for word, others in excuses.items():
                out = out | ((_at(words, i) == word) & F.coalesce(_at(words, i + step).isin(list(others)), F.lit(False)))
        return out

    found = lambda i: _among(words, i, terms) & ~F.coalesce(excused(i), F.lit(False))
    return F.exists(_positions(words), found)


def _follows(words: Column, first: Iterable[str], things: Iterable[str], reach: int) -> Column:
    """Whether one of ``things`` comes up to ``reach`` words after one of ``first``, with no card right behind it."""
    thing = lambda j: _among(words, j, things) & ~_among(words, j + 1, CARDS)
    ahead = lambda i: F.exists(F.sequence(i + 1, i + reach), thing)
    return F.exists(_positions(words), lambda i: _among(words, i, first) & ahead(i))


def mentions(title: Column, terms: Iterable[str] = EXCLUDED) -> Column:
    """Whether a title has one of the words or phrases."""
    return once(tokens(title), lambda w: has_term(w, terms))


def names_object(title: Column, objects: Iterable[str] = OBJECTS) -> Column:
    """Whether a title names an object other than a card, a signed thing, or a count in brackets. Poses and brands don't count."""
    words = lambda w: has_term(w, objects, POSE_BEFORE, POSE_AFTER) | _follows(w, SIGNED, SIGNED_THINGS, 5)
    return once(tokens(title), words) | F.coalesce(title, F.lit("")).rlike(r"\([0-9]+\)")


def dated(title: Column, any_case: bool = False) -> Column:
    """Whether a word of the title is a year from 1850 to 2099 or an old catalogue code."""
    year = lambda w: (F.length(w) == 4) & F.coalesce(w.try_cast("int").between(FIRST_YEAR, LAST_YEAR), F.lit(False))
    code = lambda w: F.substring(w, 1, 1).isin(list(CODE_LETTERS)) & F.length(w).isin(3, 4) & F.substring(w, 2, 3).rlike("^[0-9]+$")
    text = F.coalesce(title, F.lit(""))
    words = F.regexp_extract_all(F.upper(text) if any_case else text, F.lit("[A-Za-z0-9]+"), F.lit(0))
    return F.exists(words, lambda w: year(w) | code(w))


def single_card(title: Column, marked: bool = True) -> Column:
    """A year or a catalogue code, a mark of a card (if asked), no other object, nothing that is several or sealed. Null is no card."""
    ok = dated(title) & ~names_object(title) & ~mentions(title)
    mark = once(tokens(title), lambda w: has_term(w, CARD_MARKS)) | F.coalesce(title, F.lit("")).rlike(r"#\s?[A-Za-z0-9]")
    return ok & mark if marked else ok


def single_lot(title: Column) -> Column:
    """An auction house's lot that is one card: dated, no set, sealed product, artwork or memorabilia.

    Memorabilia: a signed, worn or matched thing within twelve words and before any number sign, or a worn one that isn't a card's patch.
    """
    text = F.coalesce(title, F.lit(""))
    parts = F.transform(F.split(F.lower(text), "#"), lambda p: F.regexp_extract_all(p, F.lit("[a-z0-9]+"), F.lit(0)))
    worn = lambda w: F.exists(_positions(w), lambda i: _among(w, i, WORN) & ~F.exists(F.sequence(i + 1, i + 8), lambda j: _among(w, j, WORN_CARDS)))
    memorable = F.exists(parts, lambda w: _follows(w, MEMORABLE, MEMORABLE_THINGS, 12) | worn(w))
    several = once(tokens(title), lambda w: has_term(w, LOT_OBJECTS, POSE_BEFORE, POSE_AFTER)) | text.rlike(r"\([0-9]{2,}\)")
    counted = once(tokens(title), lambda w: F.exists(_positions(w), lambda i: F.coalesce(_at(w, i).rlike("^[0-9]{2,}$"), F.lit(False)) & (_at(w, i + 1) == "cards")))
    return dated(title, any_case=True) & ~several & ~F.coalesce(counted, F.lit(False)) & ~memorable


def other_auction(title: Column) -> Column:
    """Whether an auction's title says that it sells other things."""
    return mentions(title, OTHER_AUCTIONS)


def names_set(title: Column) -> Column:
    """A set, a lot, a sealed product, a number of different cards, or a count in brackets that no number follows."""
    different = lambda w: F.exists(_positions(w), lambda i: F.coalesce(_at(w, i).rlike("^[0-9]+$") & (_at(w, i + 1) == "different"), F.lit(False)))
    return once(tokens(title), lambda w: has_term(w, SETS) | different(w)) | F.coalesce(title, F.lit("")).rlike(r"\([0-9]+\)(?!\s*#)")


def title_flags(title: Column, flags: Mapping[str, Sequence[str]] = TITLE_FLAGS) -> Column:
    """Names of all flags that a title raises, in order."""
    return once(tokens(title), lambda w: F.array_compact(F.array(*[F.when(has_term(w, terms), F.lit(name)) for name, terms in flags.items()])))


def single_product(name: Column, number: Column) -> Column:
    """A catalogue product that isn't sealed and has a number."""
    return ~mentions(name, SEALED) & (F.coalesce(F.trim(number), F.lit("")) != "")


def grade_dialect(company: Column, grade: Column, title: Column) -> Column:
    """The company counts only at 10, with its two special labels; any other grade is ``Grade n``, none is ``Ungraded``."""
    g, low, name = grade.try_cast("double"), F.lower(F.coalesce(title, F.lit(""))), F.upper(company)
    ten = F.when((name == "BGS") & low.rlike(r"\bblack\s*label\b"), "BGS 10 Black").when((name == "CGC") & low.rlike(r"\bpristine\b"), "CGC 10 Prist.")
    other = F.concat(F.lit("Grade "), F.regexp_replace(g.cast("string"), r"\.0$", ""))
    return F.when(g.isNull(), "Ungraded").when((g == 10) & (F.coalesce(name, F.lit("")) != ""), ten.otherwise(F.concat(name, F.lit(" 10")))).otherwise(other)


# --- pictures ---------------------------------------------------------------------------------------------------------
def key_ok(key: Column) -> Column:
    """Up to 128 letters, digits, dots, dashes and underscores, and not dots alone."""
    return F.coalesce(key.rlike(KEY) & ~key.rlike(r"^\.+$"), F.lit(False))


def picture(url: Column, home: str, sources: Sequence[str]) -> Column:
    """struct(state, source, key): ``ok`` with both for /img/source/key on the host ``home``, otherwise the reason that comes first."""
    u = F.trim(F.coalesce(url, F.lit("")))
    name = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    parts = F.filter(F.split(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/"), lambda x: x != "")
    source, key = F.try_element_at(parts, F.lit(2)), F.try_element_at(parts, F.lit(3))
    state = (
        F.when(u == "", "empty").when(name != home.lower(), "other_host").when((F.size(parts) != 3) | (F.try_element_at(parts, F.lit(1)) != "img"), "other_route")
        .when(~source.isin(*sources), "unknown_source").when(~key_ok(key), "bad_key").otherwise("ok")
    )
    return F.struct(state.alias("state"), F.when(state == "ok", source).alias("source"), F.when(state == "ok", key).alias("key"))


def shard_path(source: Column, key: Column) -> Column:
    """source/ab/cd/key by the key's first letters; what is missing is ``__``."""
    low = F.lower(F.coalesce(key, F.lit("")))
    part = lambda at: F.coalesce(F.nullif(F.substring(low, at, 2), F.lit("")), F.lit("__"))
    return F.concat_ws("/", source, part(1), part(3), key)


def picture_urls(lists: Sequence[Column], singles: Sequence[Column]) -> Column:
    """Distinct trimmed addresses in order, lists first; blank ones and embedded data go."""
    none = F.array().cast("array<string>")
    every = F.concat(*[F.coalesce(c, none) for c in lists], F.array(*singles).cast("array<string>"))
    trimmed = F.transform(F.array_compact(every), lambda x: F.trim(x))
    return F.array_distinct(F.filter(trimmed, lambda x: (x != "") & ~x.startswith("data:")))


def routed_url(base: str, routes: Mapping[str, str], kind: Column, uid: Column, fallback: Column) -> Column:
    """base/route/uid by the upper-cased kind; without uid or route the fallback, made https."""
    k, path = F.upper(F.trim(kind)), None
    for name, route in routes.items():
        path = F.when(k == name, route) if path is None else path.when(k == name, route)
    made = F.concat(F.lit(base.rstrip("/") + "/"), path, F.lit("/"), F.nullif(F.trim(uid), F.lit("")))
    return F.coalesce(made, F.regexp_replace(F.trim(fallback), "^http://", "https://"), F.lit(""))


# --- payment, keys, details -------------------------------------------------------------------------------------------
def void_payment(status: Column, sold: Column, updated: Column, as_of: Column, days: int = 7) -> Column:
    """Unpaid, not updated since the day of sale, and that is ``days`` or more ago; false if a day is unknown."""
    return F.coalesce((status == "Unpaid") & (updated.cast("date") == sold.cast("date")) & (F.datediff(as_of, sold) >= days), F.lit(False))


def dedupe_keys(ids: Mapping[str, Column], title: Column, price: Column, day: Column) -> Column:
    """``name:value`` of each id that isn't blank, then title, price and day joined by a bar unless all are blank."""
    norm = lambda c: F.coalesce(F.trim(c.cast("string")), F.lit(""))
    each = [F.when(norm(c) != "", F.concat(F.lit(n + ":"), norm(c))) for n, c in ids.items()]
    last = F.concat_ws("|", norm(title), norm(price), norm(day))
    return F.array_compact(F.array(*each, F.when(last != "||", F.concat(F.lit("title_price_date:"), last))))


def detail(specifics: Column, *aliases: str) -> Column:
    """The value of the first alias that the map has, whatever the case of its names; null if blank."""
    entries = F.map_entries(specifics)
    named = lambda a: F.try_element_at(F.filter(entries, lambda e: F.lower(F.trim(e["key"])) == a), F.lit(-1))
    return F.nullif(F.trim(F.coalesce(*[named(a) for a in aliases])["value"]), F.lit(""))


def named_value(items: Column, name: str) -> Column:
    """The value of the last struct(name, value) of that name."""
    return F.try_element_at(F.filter(items, lambda e: e["name"] == name), F.lit(-1))["value"]
