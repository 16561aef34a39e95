"""Rows from saved web pages: auction listings, galleries, options, checklists, articles. One page may give many rows or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars

#: Marks put where a page's headings and lines begin.
_HEAD, _LINE = "\u0001", "\u0002"
#: What multiplies a price in words.
UNITS = {"million": 1e6, "m": 1e6, "billion": 1e9, "b": 1e9, "thousand": 1e3, "k": 1e3}


def _others(pages: DataFrame, html: str) -> list[str]:
    return [c for c in pages.columns if c != html]


def plain(html: Column) -> Column:
    """Text without tags, common entities resolved, white space as single blanks."""
    text = F.regexp_replace(html, "<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _pieces(html: Column, before: str) -> Column:
    """The page cut before each match; what comes before the first is left out."""
    return F.slice(F.split(html, f"(?={before})"), 2, F.greatest(F.lit(0), F.size(F.split(html, f"(?={before})")) - 1))


def deslug(slug: Column) -> Column:
    """A title from the words of an address: each begins with a capital, the rest is lower case."""
    return F.array_join(F.transform(F.filter(F.split(slug, "-"), lambda w: w != ""), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))), " ")


def archive_lots(pages: DataFrame, host: str, prefix: str = "archives", html: str = "html") -> DataFrame:
    """Lots of an archive's listing: url, title, sold_price, year, season, lot, sold_date, image_url. Lots without a positive price go.

    A lot's link is ``/prefix/year/season/lot/slug``. Its price is the one that the page's text states beside its number ("Lot 12 - $345"), if that number
    is stated once, else the first one after the link. Dates are those of the season.
    """
    link = rf'href="/{prefix}/[0-9]{{4}}/[^/"]+/[0-9]+/[^"]+"'
    each = pages.select(*_others(pages, html), plain(F.col(html)).alias("__text"), F.posexplode(_pieces(F.concat(F.lit(" "), F.col(html)), link)).alias("pos", "__piece"))
    part = lambda n: F.regexp_extract("__piece", rf'href="(/{prefix}/([0-9]{{4}})/([^/"]+)/([0-9]+)/([^"]+))"', n)
    stated = F.regexp_extract_all("__text", F.lit(r"Lot\s+[0-9]+\s*-\s*\$[0-9,]{3,}"), F.lit(0))
    number = lambda x: F.regexp_extract(x, r"Lot\s+([0-9]+)", 1)
    mine = F.filter(stated, lambda x: number(x) == part(4))
    beside = F.when(F.size(mine) == 1, F.regexp_extract(mine[0], r"\$([0-9,]+)", 1))
    after = scalars.match(F.col("__piece"), r"(\$[0-9,]{3,})")
    price = scalars.price(F.coalesce(beside, after))
    image = scalars.match(F.col("__piece"), r'(?:src|data-src)="(https?://[^"]+)"')
    out = each.select(
        *_others(pages, html), "pos", F.concat(F.lit(host), part(1)).alias("url"), deslug(part(5)).alias("title"), price.alias("sold_price"), part(2).alias("year"), part(3).alias("season"),
        part(4).alias("lot"), scalars.season_date(part(2), part(3)).alias("sold_date"), image.alias("image_url"),
    )
    return out.filter("sold_price > 0")


def gallery_lots(pages: DataFrame, html: str = "html") -> DataFrame:
    """Lots of a gallery: itemid, lot, title, bids, status, sold_price (null: not sold), and the auction's end."""
    end = scalars.us_date(scalars.match(plain(F.col(html)), r"End:\s*([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"))
    each = pages.select(*_others(pages, html), end.alias("auction_end"), F.posexplode(_pieces(F.concat(F.lit(" "), F.col(html)), '<div class="item">')).alias("pos", "__p"))
    get = lambda pattern, n=1: scalars.match(F.col("__p"), pattern, n)
    item = r'bidplace\.aspx\?itemid=([0-9]+)"[^>]*>([^<]+)</a>'
    return each.select(
        *_others(pages, html), "pos", get(item).alias("itemid"), get(r'<h5 class="boxed">\s*([^<]+?)\s*</h5>').alias("lot"), plain(get(item, 2)).alias("title"),
        get(r"Bids:\s*<strong>\s*([0-9]+)").try_cast("int").alias("bids"), get(r"Status:\s*<strong>\s*([^<]+?)\s*</strong>").alias("status"),
        scalars.price(get(r"SOLD FOR (\$[0-9,]+(?:\.[0-9]{2})?)")).alias("sold_price"), "auction_end",
    ).filter("itemid IS NOT NULL")


def options(pages: DataFrame, name: str, html: str = "html") -> DataFrame:
    """value and label of every option of the ``<select>`` with this id or name, in order."""
    select = scalars.match(F.col(html), rf'(?s)<select[^>]*(?:id|name)="{name}"[^>]*>(.*?)</select>')
    found = F.regexp_extract_all(F.coalesce(select, F.lit("")), F.lit(r'value="([^"]*)"[^>]*>([^<]*)<'), F.lit(0))
    each = pages.select(*_others(pages, html), F.posexplode(found).alias("pos", "__o"))
    get = lambda n: F.regexp_extract("__o", r'value="([^"]*)"[^>]*>([^<]*)<', n)
    return each.select(*_others(pages, html), "pos", get(1).alias("value"), plain(get(2)).alias("label"))


def checklist(pages: DataFrame, entry: str = r"^#?([A-Z]{0,4}-?[0-9]{1,3})[.:)]?\s+([A-Za-z].*)$", skip: str = "(?!)", html: str = "html") -> DataFrame:
    """section, code and character of every line of a checklist, ``section`` being the heading before it (``?`` before the first).

    Scripts and styles go; headings are h1 to h4, strong and b; lines end where paragraphs, items, cells and breaks do. A heading that matches ``skip`` or is
    longer than 89 characters doesn't begin a section. A page is read in order within its own row.
    """
    h = F.regexp_replace(F.col(html), r"(?is)<(script|style|noscript)[^>]*>.*?</\1>", " ")
    h = F.regexp_replace(h, r"(?i)<(h[1-4]|strong|b)(\s[^>]*)?>", _LINE + _HEAD)
    h = F.regexp_replace(h, r"(?i)</(h[1-4]|strong|b)>|<br\s*/?>|</(p|div|li|tr|td|h[5-6])>|\n", _LINE)
    lines = F.filter(F.transform(F.split(h, _LINE), plain), lambda x: x != "")
    heading = lambda x: F.trim(F.replace(x, F.lit(_HEAD), F.lit("")))
    opens = lambda x: x.startswith(_HEAD) & (F.length(heading(x)) > 0) & (F.length(heading(x)) < 90) & ~heading(x).rlike(skip)
    start = F.struct(F.lit("?").alias("section"), F.array().cast("array<struct<section:string,line:string>>").alias("rows"))

    def step(acc: Column, x: Column) -> Column:
        row = F.struct(acc["section"].alias("section"), x.alias("line"))
        return F.struct(F.when(opens(x), heading(x)).otherwise(acc["section"]).alias("section"), F.when(x.startswith(_HEAD), acc["rows"]).otherwise(F.array_append(acc["rows"], row)).alias("rows"))

    each = pages.select(*_others(pages, html), F.posexplode(F.aggregate(lines, start, step, lambda a: a["rows"])).alias("pos", "__r"))
    get = lambda n: F.regexp_extract("__r.line", entry, n)
    return each.select(*_others(pages, html), "pos", F.col("__r.section").alias("section"), get(1).alias("code"), F.trim(get(2)).alias("character")).filter("code <> '' AND character <> ''")


def article_lots(pages: DataFrame, least: int = 12, html: str = "html") -> DataFrame:
    """description, price_text and price of every list item of an article that ends in a price; repeats within a page count once.

    The price is the last dollar amount, words such as million included. Items whose text before it is shorter than ``least`` are navigation.
    """
    amount = r"\$\s*[0-9][0-9,]*(?:\.[0-9]+)?(?:\s*(?:million|billion|thousand|m|b|k)\b)?"
    items = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1))
    each = pages.select(*_others(pages, html), F.posexplode(F.transform(items, plain)).alias("pos", "__t"))
    last = F.try_element_at(F.regexp_extract_all("__t", F.lit(f"(?i){amount}"), F.lit(0)), F.lit(-1))
    each = each.withColumn("price_text", F.trim(last)).filter("price_text IS NOT NULL")
    cut = F.length("__t") - F.length(F.expr("substring_index(__t, price_text, -1)")) - F.length("price_text")
    text = F.regexp_replace(F.trim(F.substring("__t", F.lit(1), cut)), "[-–—:;,\\s]+$", "")
    unit = F.lower(F.trim(F.regexp_replace("price_text", "[$0-9.,]", "")))
    times = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv]), unit), F.lit(1.0))
    number = F.regexp_replace("price_text", "[^0-9.]", "").try_cast("double")
    out = each.select(*_others(pages, html), "pos", F.trim(text).alias("description"), "price_text", (number * times).alias("price"))
    out = out.filter((F.length("description") >= least) & (F.col("price") > 0))
    return out.groupBy(*_others(pages, html), "description", "price_text", "price").agg(F.min("pos").alias("pos"))
