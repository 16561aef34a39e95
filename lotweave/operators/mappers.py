"""Landed records of each source onto one contract, with reasons for what isn't loaded."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import listings, rules, scalars

#: Columns of the contract, all text but for the price (double), the day (date) and the facts (a map of texts).
CONTRACT = ["source_item_id", "title", "sold_price", "sold_date", "source_url", "grade", "set_name", "card_number", "scraped_at", "facts"]
#: What marks a headline as that of a card.
CARD_LIKE = r"(?i)\b(19|20)[0-9]{2}\b|\b(PSA|BGS|SGC|CGC|BVG|BCCG)\b|#\w"
#: Fields that may identify a record, best first.
ID_FIELDS = ["source_item_id", "api_id", "listing_uuid", "ref_id", "comp_id"]

Mapper = Callable[[DataFrame], DataFrame]


def _text(rows: DataFrame, name: str) -> Column:
    """A column as text, null where the source has none of that name."""
    return F.col(name).cast("string") if name in rows.columns else F.lit(None).cast("string")


def _facts(rows: DataFrame, fixed: Mapping[str, str] | None = None, **named: str | Column) -> Column:
    """A map of what is kept beside the contract; facts without a value stay out."""
    cells = [(F.lit(k), F.lit(v)) for k, v in (fixed or {}).items()]
    cells += [(F.lit(k), _text(rows, v) if isinstance(v, str) else v.cast("string")) for k, v in named.items()]
    every = F.map_from_arrays(F.array(*[k for k, _ in cells]), F.array(*[v for _, v in cells]))
    return F.map_filter(every, lambda k, v: v.isNotNull())


def _contract(rows: DataFrame, keep: Column, price: Column, item: Column, facts: Column, url: str = "url", **cols: Column) -> DataFrame:
    """The rows with a positive price, a day and an id for which ``keep`` holds."""
    given = {
        "source_item_id": item, "title": F.coalesce(_text(rows, "title"), F.lit("")), "sold_price": price, "sold_date": scalars.sold_date(_text(rows, "sold_date")),
        "source_url": _text(rows, url), "grade": F.lit(None).cast("string"), "set_name": F.lit(None).cast("string"), "card_number": F.lit(None).cast("string"),
        "scraped_at": _text(rows, "scraped_at"), "facts": facts,
    } | cols
    out = rows.select(keep.alias("__keep"), *[given[c].alias(c) for c in CONTRACT])
    return out.filter("coalesce(__keep, false) AND sold_price > 0 AND sold_date IS NOT NULL AND source_item_id IS NOT NULL").drop("__keep")


def hammer_and_premium(rows: DataFrame) -> DataFrame:
    """Auction lots whose buyer paid a premium on the hammer price."""
    hammer, premium = _text(rows, "sold_price").try_cast("double"), _text(rows, "buyer_premium_pct")
    percent = F.coalesce(premium.try_cast("double"), F.when(premium.isNull(), 0.0))  # an unreadable premium leaves the price unknown
    paid = F.round(hammer * (1 + percent / 100), 2)
    facts = _facts(rows, {"price_basis": "hammer_plus_bp"}, hammer=hammer, buyer_premium_pct=percent, realized=paid)
    return _contract(rows, F.lit(True), paid, F.coalesce(scalars.first_filled(_text(rows, "lot_id")), _text(rows, "comp_id")), facts)


def orders(rows: DataFrame) -> DataFrame:
    """Single orders of catalogue products: the id is product and time of order."""
    item = F.concat_ws(":", F.coalesce(_text(rows, "product_id"), F.lit("None")), F.coalesce(scalars.first_filled(_text(rows, "order_ts")), _text(rows, "sold_date")))
    facts = _facts(rows, {"sold_basis": "per_order_realized"}, condition="condition", variant="variant", rarity="rarity")
    cols = {"set_name": _text(rows, "set_name"), "card_number": _text(rows, "number"), "scraped_at": F.lit(None).cast("string")}
    return _contract(rows, F.lit(True), _text(rows, "sold_price").try_cast("double"), item, facts, **cols)


def slabs(rows: DataFrame) -> DataFrame:
    """Sold slabs; links without a slab number aren't records."""
    facts = _facts(rows, shipping="shipping", base="sold_price_base")
    return _contract(rows, _text(rows, "url").rlike("/slab/view/[0-9]+"), _text(rows, "sold_price").try_cast("double"), _text(rows, "url"), facts)


def headlines(rows: DataFrame) -> DataFrame:
    """Top lots that posts report; headlines that don't read like a card are prose."""
    price = _text(rows, "sold_price").try_cast("double")
    plain = F.regexp_replace(F.lower(F.trim(_text(rows, "title"))), r"\s+", " ")
    item = F.concat_ws("#", F.coalesce(_text(rows, "post_url"), F.lit("")), price.cast("string"), F.substring(F.coalesce(plain, F.lit("")), 1, 40))
    facts = _facts(rows, {"capture_tier": "top_lots_reference"}, auction_house="auction_house")
    return _contract(rows, _text(rows, "title").rlike(CARD_LIKE), price, item, facts, url="post_url")


def season_lots(rows: DataFrame) -> DataFrame:
    """Archive lots dated by the season of their auction."""
    facts = _facts(rows, {"sold_date_granularity": "season"}, year="year", season="season", lot="lot")
    url = scalars.first_filled(_text(rows, "url"))
    return _contract(rows, F.lit(True), _text(rows, "sold_price").try_cast("double"), url, facts, scraped_at=F.lit(None).cast("string"))


def gallery_lots(rows: DataFrame) -> DataFrame:
    """Gallery lots dated by their auction's end, premium included by the house's own word."""
    fixed = {"sold_date_granularity": "auction_end", "price_basis": "price realized incl. buyer's premium (stated by the house)"}
    facts = _facts(rows, fixed, auction_id="auction_id", auction_title="auction_title", lot="lot", bids="bids")
    url = scalars.first_filled(_text(rows, "url"))
    return _contract(rows, F.lit(True), _text(rows, "sold_price").try_cast("double"), url, facts)


#: The mapper of each source.
MAPPERS: dict[str, Mapper] = {
    "goldin": hammer_and_premium, "tcgplayer": orders, "myslabs": slabs, "auctionreport": headlines,
    "rea": season_lots, "hugginsandscott": season_lots, "memorylane": gallery_lots, "lelands": gallery_lots,
}


def map_sources(raws: Mapping[str, DataFrame]) -> DataFrame:
    """All sources by their mappers, united, with ``source``."""
    out = None
    for name, rows in raws.items():
        part = MAPPERS[name](rows).select(F.lit(name).alias("source"), *CONTRACT)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no source")
    return out


# --- one feed in full -------------------------------------------------------------------------------------------------
def money(text: Column) -> Column:
    """A decimal after dropping currency marks and commas; anything else around the number makes it null."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?i)\bUSD\b|US\s*\$", ""), r"[$,]", "")
    return F.trim(bare).try_cast("decimal(18,2)")


def day(text: Column) -> Column:
    """ISO, ``Mar 1, 2026``, ``March 1, 2026`` or ``3/1/2026``, or an ISO time with or without a zone; null otherwise."""
    t = F.trim(text)
    zoned = F.regexp_replace(t, r"(?i)\s+(PST|PDT|EST|EDT|CST|CDT|MST|MDT)$", "")
    iso = F.when(zoned.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), F.substring(zoned, 1, 10).try_cast("date"))
    return F.coalesce(iso, F.try_to_date(t, "MMM d, yyyy"), F.try_to_date(t, "MMMM d, yyyy"), F.try_to_date(t, "M/d/yyyy"))


def plain_url(url: Column) -> Column:
    """Scheme, host and path as written, without query, fragment and trailing slashes; null if it has no scheme or host."""
    return F.regexp_replace(scalars.match(url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]+[^?#]*)"), "/+$", "")


def first_image(one: Column, several: Column) -> Column:
    """The picture's address, or the first of several; only web addresses count."""
    web = lambda u: u.rlike("^https?://")
    return F.when(web(one), one).otherwise(F.try_element_at(F.filter(several, web), F.lit(1)))


def build_rows(raw: DataFrame, source: str) -> DataFrame:
    """Every record with ``rejects``: the reasons why it isn't loaded, in order, none for those that are.

    Reasons: missing_title, missing_price, nonpositive_price, missing_sold_date, missing_source_item_id, and title_flag:<name> for each flag that
    the title raises. Facts about the capture are nested in ``bridge``. ``raw`` has texts, and an array ``image_urls``.
    """
    t = lambda c: _text(raw, c)
    title = F.trim(F.coalesce(t("title"), F.lit("")))
    price, sold = money(F.coalesce(t("sold_price"), t("price"))), day(t("sold_date"))
    url = plain_url(t("url"))
    item = F.coalesce(*[F.nullif(t(c), F.lit("")) for c in ID_FIELDS], url)
    images = F.col("image_urls") if "image_urls" in raw.columns else F.array().cast("array<string>")
    image = first_image(t("image_url"), images)
    flags = F.transform(listings.title_flags(title), lambda f: F.concat(F.lit("title_flag:"), f))
    why = rules.all_reasons([
        (title == "", "missing_title"), (price.isNull(), "missing_price"), (price <= 0, "nonpositive_price"),
        (sold.isNull(), "missing_sold_date"), (item.isNull(), "missing_source_item_id"),
    ])
    graded = scalars.first_filled(F.concat_ws(" ", scalars.first_filled(t("grader")), scalars.first_filled(t("grade"))))
    n_images = F.when(F.coalesce(F.size(images), F.lit(0)) > 0, F.size(images)).when(image.isNotNull(), 1).otherwise(0)
    return raw.select(
        F.lit(source).alias("source_code"), item.alias("source_item_id"), t("url").alias("source_url"), url.alias("canonical_source_url"), title.alias("title"),
        scalars.name_key(title).alias("normalized_title"), price.alias("sold_price"), sold.alias("sold_date"),
        F.coalesce(scalars.first_filled(t("sale_format")), F.lit("auction")).alias("sale_format"), graded.alias("grade"), t("grader").alias("grading_company"),
        image.alias("image_url"), n_images.alias("image_count"),
        F.struct(t("src_file").alias("source_file"), t("src_row").alias("source_line"), F.lit(True).alias("reference_only"), F.lit(True).alias("not_trusted")).alias("bridge"),
        F.concat(why, flags).alias("rejects"),
    )


# --- nested archives and staged feeds ---------------------------------------------------------------------------------
NESTED = (
    "catalog_id string, source_item_id string, title string, sold_price string, sold_date string, source_url string, image_url string, slug string, "
    "raw struct<source:string, slug:string, ledger_anchor:string, grade_label:string, image_url:string, best_offer:string>"
)


def nested_spec() -> dict[str, Column]:
    """The contract of the nested sales archive (see NESTED): the marketplace's item id comes from the ledger anchor."""
    c = F.col
    title, grade = F.lower(c("title")), scalars.first_filled(c("raw.grade_label"))
    company = rules.first_match(title, [(n.upper(), rules.any_word([n])) for n in ("psa", "bgs", "sgc", "cgc")], "UNKNOWN")
    return {
        "observation_id": F.concat(F.lit("SCP:"), c("source_item_id")), "source_item_id": c("source_item_id"), "title": c("title"), "sold_price_usd": scalars.price(c("sold_price")),
        "sold_date": F.substring(c("sold_date"), 1, 10).try_cast("date"), "source_url": c("source_url"), "image_url": c("image_url"), "slug": c("slug"),
        "ebay_item_id": scalars.match(c("raw.ledger_anchor"), "ebay-([0-9]+)"), "grade": grade, "grade_company": F.when(grade.isNotNull(), company),
        "raw_or_graded": F.when(grade.isNotNull(), "graded").otherwise("raw_or_unknown"), "best_offer": F.coalesce(scalars.flag(c("raw.best_offer")), F.lit(False)),
        "src_file": c("src_file"), "src_row": c("src_row"),
    }


def by_priority(parts: list[DataFrame], keys: list[str], order: list[Column]) -> DataFrame:
    """The parts united by name, the first row of each key by ``order``, then by which part it is from (earlier ones first), then src_row."""
    from .canonical import first_wins

    out = None
    for i, part in enumerate(parts):
        p = part.withColumn("__priority", F.lit(i))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    if out is None:
        raise ValueError("no part")
    known = out.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys[:1]))
    return first_wins(known, keys, [*order, F.col("__priority"), F.col("src_row")]).drop("__priority")


def sale_key(venue: Column, item: Column) -> Column:
    """The id by which a venue's sale is known: of houses whose lots go by address, the ``itemid`` in it."""
    by_address = venue.isin("memorylane", "lelands")
    return F.when(by_address, F.coalesce(scalars.match(item, r"[?&]itemid=([0-9]+)"), item)).otherwise(item)


#: Names by which posts call auction houses, and the label of each; the first that is found counts.
HOUSES = [
    ("heritage", "Heritage Auctions"), ("goldin", "Goldin"), ("pwcc", "PWCC"), ("fanatics collect", "Fanatics Collect"), ("robert edward", "REA"), ("rea", "REA"),
    ("memory lane", "Memory Lane"), ("certifiedlink", "CertifiedLink"), ("comiclink", "ComicLink"), ("mile high", "Mile High Card Co"), ("clean sweep", "Clean Sweep"),
    ("sterling", "Sterling Sports"), ("iconic", "Iconic"), ("lelands", "Lelands"), ("classic auctions", "Classic Auctions"), ("rr auction", "RR Auction"),
]


def house(*texts: Column) -> Column:
    """The label of the first known house that one of the texts names as a whole word; empty if none does."""
    return rules.first_match(F.lower(F.concat_ws(" ", *texts)), [(label, rules.any_word([name])) for name, label in HOUSES], "")
