"""Scalar functions as Columns: text, urls, money, dates, hashes, arrays. All parsing is null on failure, never an error."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- text -------------------------------------------------------------------------------------------------------------
#: Latin letters with marks and the plain letter for each.
MARKED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def fold_latin(text: Column) -> Column:
    """Lower case with the marks of common Latin letters removed, other characters kept; :func:`to_ascii` knows them all."""
    return F.translate(F.lower(text), MARKED, PLAIN)


def fold(text: Column) -> Column:
    """Lower case, compatibility-decomposed, marks removed: for scripts beyond :func:`fold_latin`."""

    def run(t: pd.Series) -> pd.Series:
        return t.str.normalize("NFKD").str.replace(r"[\u0300-\u036f]", "", regex=True).str.lower()

    return F.pandas_udf(run, "string")(text)


def html_unescape(text: Column) -> Column:
    def run(t: pd.Series) -> pd.Series:
        import html

        return t.map(html.unescape, na_action="ignore")

    return F.pandas_udf(run, "string")(text)


def _ascii_forms() -> dict[str, str]:
    """ASCII rest of the compatibility decomposition of each character of the basic plane that has one, but for those that lose all."""
    out = {}
    for c in map(chr, (*range(0x80, 0xD800), *range(0xF900, 0x10000))):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if x < "\x80")
        if plain:
            out[c] = plain
    return out


_FORMS = _ascii_forms()
_SINGLE = {c: x for c, x in _FORMS.items() if len(x) == 1}
#: Spread over several letters, such as ligatures, fractions and signs.
_SPREAD = {c: x for c, x in _FORMS.items() if len(x) > 1 and ord(c) < 0x2500 or 0xFB00 <= ord(c) < 0xFB07}


def to_ascii(text: Column) -> Column:
    """Compatibility-decomposed, then only ASCII kept: marked letters become plain ones, letters without a plain form go. Case stays.

    Runs in the JVM: a table of single letters, and one of letters that become several, which few texts have.
    """
    known = F.create_map(*[F.lit(x) for kv in _SPREAD.items() for x in kv])
    spread = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(known, c), c)), "")
    whole = F.when(text.rlike("[" + "".join(_SPREAD) + "]"), spread).otherwise(text)
    plain = F.regexp_replace(F.translate(whole, "".join(_SINGLE), "".join(_SINGLE.values())), r"[^\x00-\x7F]+", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), plain).otherwise(text)


def slug(text: Column, longest: int | None = None) -> Column:
    """Folded, runs of others than a-z and 0-9 as one hyphen, none at the ends, cut at ``longest`` before trimming."""
    out = F.regexp_replace(F.lower(to_ascii(text)), "[^a-z0-9]+", "-")
    out = F.substring(F.ltrim(out, F.lit("-")), 1, longest) if longest else out
    return F.btrim(out, F.lit("-"))


def name_key(text: Column) -> Column:
    """Folded, apostrophes gone, other separators as one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(to_ascii(text)), "['`]", ""), "[^a-z0-9]+", " "))


def number_key(text: Column) -> Column:
    """Letters and digits in lower case without leading zeros."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]", ""), "^0+([0-9])", "$1")


def number_key_plain(text: Column) -> Column:
    """Letters and digits in lower case, as they are written."""
    return F.regexp_replace(F.lower(to_ascii(text)), "[^a-z0-9]", "")


def words_from_slug(text: Column) -> Column:
    return F.initcap(F.replace(text, F.lit("-"), F.lit(" ")))


def strip_tags(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), "[ \t\r\n]+", " "))


def first_filled(*cols: Column) -> Column:
    """The first that isn't null or blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


# --- urls -------------------------------------------------------------------------------------------------------------
def match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group, or null where the pattern isn't found."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group), F.lit(""))


def item_id(url: Column) -> Column:
    """Digits after /itm/ (with or without a title between), or of the item parameter."""
    return F.coalesce(match(url, r"/itm/(?:[^/?#]+/)?([0-9]+)"), match(url, r"[?&]item=([0-9]+)"))


def host(url: Column) -> Column:
    return F.lower(match(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#:]+)"))


def url_path(url: Column) -> Column:
    return match(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]+([^?#]*)")


def canonical_url(url: Column) -> Column:
    """Scheme, lower-case host and path without a trailing slash; query and fragment gone."""
    return F.concat(F.lit("https://"), host(url), F.regexp_replace(F.coalesce(url_path(url), F.lit("")), "/+$", ""))


def query_param(url: Column, name: str) -> Column:
    """A decoded query parameter; a plus sign stays one."""
    return F.try_url_decode(F.replace(match(url, rf"[?&]{name}=([^&#]*)"), F.lit("+"), F.lit("%2B")))


# --- money ------------------------------------------------------------------------------------------------------------
def price(text: Column) -> Column:
    """The first signed number after dropping dollar signs, commas and blanks, as double."""
    return F.regexp_extract(F.regexp_replace(text, r"[$,\s]", ""), r"-?[0-9]+(\.[0-9]+)?", 0).try_cast("double")


def price_decimal(text: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(text, r"[$,\s]", ""), r"-?[0-9]+(\.[0-9]+)?", 0).try_cast("decimal(18,2)")


def last_money(text: Column) -> Column:
    """The last dollar amount of a line, with k, million or b after it."""
    each = F.regexp_extract_all(F.lower(text), F.lit(r"\$\s*([0-9][0-9,]*(?:\.[0-9]+)?\s*(?:million|billion|k|m|b)?)"), F.lit(1))
    last = F.try_element_at(each, F.lit(-1))
    unit = F.trim(F.regexp_replace(last, "[0-9.,]", ""))
    times = F.when(unit == "k", 1e3).when(unit.isin("m", "million"), 1e6).when(unit.isin("b", "billion"), 1e9).otherwise(1.0)
    return price(last) * times


def cents(value: Column) -> Column:
    """Rounded to cents through decimal, so that halves round the same in every engine."""
    return F.round(value.cast("decimal(28,6)"), 2).cast("decimal(18,2)")


def with_premium(hammer: Column, percent: Column) -> Column:
    return cents(hammer * (1 + F.coalesce(percent, F.lit(0.0)) / 100))


def bid_count(text: Column) -> Column:
    """The number before the word bid or bids, thousands commas allowed."""
    return F.replace(match(text, r"(?i)([0-9][0-9,]*)\s+bid"), F.lit(","), F.lit("")).try_cast("int")


def sale_format(best_offer: Column, stated: Column, bids: Column) -> Column:
    """OBO, else the stated format as it is, else auction if there was a bid, else BIN."""
    return F.when(best_offer, "OBO").when(first_filled(stated).isNotNull(), first_filled(stated)).when(bids > 0, "auction").otherwise("BIN")


def with_shipping(price: Column, shipping: Column) -> Column:
    """What a buyer paid in all, in cents; unknown or free shipping adds nothing."""
    return cents(price + F.coalesce(shipping, F.lit(0.0)))


# --- dates ------------------------------------------------------------------------------------------------------------
def sold_date(text: Column) -> Column:
    """``Sold``/``Ended`` prefix dropped; then ``Mar 1, 2026``, ``March 1, 2026`` or an ISO date at the start."""
    t = F.trim(F.regexp_replace(text, r"^\s*(?i:sold|ended)\s*:?\s*", ""))
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(t, 1, 10).try_cast("date"))
    return F.coalesce(F.try_to_date(t, "MMM d, yyyy"), F.try_to_date(t, "MMMM d, yyyy"), iso)


def us_date(text: Column) -> Column:
    return F.try_to_date(match(text, r"(\d{1,2}/\d{1,2}/\d{4})"), "M/d/yyyy")


def mail_date(text: Column) -> Column:
    """An RFC 822 date; the weekday is dropped first."""
    return F.try_to_timestamp(F.regexp_replace(text, r"^[A-Za-z]+,\s*", ""), F.lit("dd MMM yyyy HH:mm:ss Z"))


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def year_or_zero(day: Column) -> Column:
    return F.coalesce(F.year(day), F.lit(0))


#: The day that stands for an auction's season or month.
SEASON_DAYS = {
    "winter": "01-15", "spring": "05-01", "summer": "08-01", "fall": "11-01", "marketplace": "07-01", "encore": "07-01",
    "january": "01-15", "february": "02-15", "march": "03-15", "april": "04-15", "may": "05-15", "june": "06-15",
    "july": "07-15", "august": "08-15", "september": "09-15", "october": "10-15", "november": "11-15", "december": "12-15",
}


def season_date(year: Column, season: Column) -> Column:
    """The day that stands for a season or month of a year; mid-year for any other name or none, null without a year."""
    known = F.create_map(*[F.lit(x) for kv in SEASON_DAYS.items() for x in kv])
    day = F.coalesce(F.try_element_at(known, F.lower(F.trim(season))), F.lit("07-01"))
    return F.concat_ws("-", F.lpad(year.try_cast("int").cast("string"), 4, "0"), day).try_cast("date")


def age_hours(at: Column, as_of: Column) -> Column:
    return (F.unix_timestamp(as_of) - F.unix_timestamp(at)) / 3600


# --- hashes and flags -------------------------------------------------------------------------------------------------
def stable_id(prefix: str, *cols: Column) -> Column:
    return F.concat(F.lit(prefix + ":"), F.sha1(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])))


def flag(value: Column) -> Column:
    """Three-valued: true and false in any case, else null."""
    low = F.lower(F.trim(value.cast("string")))
    return F.when(low == "true", True).when(low == "false", False)


# --- arrays -----------------------------------------------------------------------------------------------------------
def tokens(text: Column, pattern: str = "[a-z0-9]+") -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({pattern})"), F.lit(1))


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once for each row, however often ``f`` names it: it is handed on as an array's one element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def windows(items: Column, n: int, sep: str = " ") -> Column:
    """All runs of ``n`` adjacent items, joined."""

    def runs(held: Column) -> Column:
        last = F.size(held) - n + 1
        each = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(held, i, F.lit(n)), sep))
        return F.when(last >= 1, each).otherwise(F.array().cast("array<string>"))

    return once(items, runs)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)
