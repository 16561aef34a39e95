"""Corrected rules, readers, writers and mappers: edge cases and row-by-row versions."""

import datetime as dt
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from lotweave import staging
from lotweave.functions import cards, categories, listings, scalars
from lotweave.operators import canonical, mappers, monitor, sharding, states
from lotweave.sources import pages, readers, writers
from lotweave.streaming import incremental


def values(spark, expr, texts):
    return [r.x for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(expr(F.col("t")).alias("x")).collect()]


def test_folding_is_that_of_unicode(spark):
    texts = ["Dvořák Łukasz", "ﬁne № ½ ™", "Ωmega Øre ẞ ǆ", "日本", "plain", "", "naïve—café", None, "ÀÉîõü ÿ", "é"]
    assert values(spark, scalars.to_ascii, texts) == [None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert values(spark, scalars.name_key, ["Dvořák Łukasz", "O'Neal"]) == ["dvorak ukasz", "oneal"] and values(spark, scalars.slug, ["Dvořák"]) == ["dvorak"]


def test_bids_formats_and_seasons(spark):
    assert values(spark, scalars.bid_count, ["Lot 12, 3 bids", "1,234 Bids", "bids 5", "0 bid", None]) == [3, 1234, None, 0, None]
    form = lambda offer, stated, bids: spark.range(1).select(scalars.sale_format(F.lit(offer).cast("boolean"), F.lit(stated).cast("string"), F.lit(bids).cast("int"))).first()[0]
    assert [form(True, "x", 1), form(None, " Fixed Price ", 1), form(False, None, 2), form(False, " ", 0), form(None, None, None)] == ["OBO", "Fixed Price", "auction", "BIN", "BIN"]
    day = lambda y, s: spark.range(1).select(scalars.season_date(F.lit(y).cast("string"), F.lit(s).cast("string"))).first()[0]
    assert [day("2023", "Fall"), day("2024", "spring"), day("2025", "Marketplace"), day("2026", "Winter"), day("2022", "Unknown"), day("2007", "March"), day("2020", None)] == [
        dt.date(2023, 11, 1), dt.date(2024, 5, 1), dt.date(2025, 7, 1), dt.date(2026, 1, 15), dt.date(2022, 7, 1), dt.date(2007, 3, 15), dt.date(2020, 7, 1),
    ]
    assert day("bad", "Fall") is None and day(None, "Fall") is None


def one_by_one(batch, table, unique):
    have = [{tuple(r[i] for i in k) for r in table} for k in unique]
    out = []
    for r in batch:
        keys = [tuple(r[i] for i in k) for k in unique]
        if not any(None not in k and k in h for k, h in zip(keys, have, strict=True)):
            out.append(r)
            for k, h in zip(keys, have, strict=True):
                h.add(k)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_insert_ignoring_row_by_row(spark, seed):
    rng = random.Random(seed)
    row = lambda i: (i, rng.choice([None, *range(8)]), rng.choice([None, *range(6)]), rng.choice("ab"))
    batch, have = [row(i) for i in range(60)], [row(i) for i in range(100, 104)]
    if not seed:
        batch, have = [(1, 1, 1, "a"), (2, 1, 2, "a"), (3, 2, 2, "a")], []
    df = lambda rows: spark.createDataFrame(rows, "i int, a int, b int, c string")
    got = canonical.insert_ignoring(df(batch), df(have), [["a"], ["b", "c"]], [F.col("i")]).collect()
    assert sorted(r.i for r in got) == [r[0] for r in one_by_one(batch, have, [[1], [2, 3]])]


def test_canonicalize_flags_and_lists(spark):
    rows = [("a", None, 1.0, None, 3), ("a", None, 2.0, "q", 1), ("a", None, None, "p", 2), ("b", "d", 5.0, "q", 9)]
    df = spark.createDataFrame(rows, "observation_id string, sold_date string, price double, query string, captured_at int")
    out = {r.observation_id: r for r in canonical.canonicalize(df, [F.col("price").isNull(), F.col("captured_at")], {"queries": "query"}, {"differs": F.col("price")}).collect()}
    a, b = out["a"], out["b"]
    assert (a.price, a.n_observations, a.first_seen_at, a.last_seen_at, a.queries, a.differs) == (2.0, 3, 1, 3, ["p", "q"], True)
    assert (b.queries, b.differs, b.n_observations) == (["q"], False, 1) and canonical.canonicalize(df.limit(0), [F.col("price")], {}, {}).isEmpty()


def test_tail_of_long_and_bad_lines(spark, tmp_path):
    f = tmp_path / "t.jsonl"
    f.write_bytes(b'{"a": "' + b"x" * 5000 + b'"}\nbad\n{"b": 2}\n{"half"')
    for most in (16, 100, 1 << 20):
        r = incremental._TailReader(str(f), most, True)
        rows, at = [], r.initialOffset()
        for _ in range(6):
            more, at = r.read(at)
            rows += list(more)
        assert [v and len(v) for v, _ in rows] == [len(json.dumps({"a": "x" * 5000})), None, 8] and [b for _, b in rows] == [None, "bad", None]
    spark.dataSource.register(incremental.JsonTail)
    q = spark.readStream.format("json_tail").option("keepBad", "true").load(str(f)).writeStream.format("memory").queryName("tailed").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.bad is None) for r in spark.table("tailed").collect()) == [False, True, True]


def test_feed_ring(spark):
    items = spark.createDataFrame([("a", 1), ("b", 5), ("c", None), ("d", 9)], "link string, at int")
    seen = spark.createDataFrame([("d", 9)], "link string, at int")
    assert sorted(r.link for r in incremental.unseen_items(items, "link", "at", F.lit(1), seen).collect()) == ["b", "c"]
    assert [r.link for r in incremental.seen_ring(seen, items, "link", "at", 2).collect()] == ["d", "b"]


def test_shards_keep_every_row(spark):
    v = spark.createDataFrame([(float(x),) for x in range(14)] + [(None,), (-1.0,), (99.0,)], "v double")
    shards = sharding.bisect_shards(v, "v", 5, 0, 10).collect()
    assert sum(r.n for r in shards) == 14 and sharding.outside(v, "v", 0, 10).first().asDict() == {"n_below": 1, "n_above": 1, "n_missing": 1}
    parts = sharding.split_levels(spark.createDataFrame([("x", "p", i) for i in range(4)] + [("x", None, 1), ("y", "p", 1)], "a string, b string, c int"), ["a", "b", "c"], 2).collect()
    assert sorted((r.level, r.path, r.n, r.open) for r in parts if r.level < 2) == [(0, ["y"], 1, False), (1, ["x", None], 1, False)] and sum(r.n for r in parts) == 6


def test_chunks_hold_the_limit(spark):
    cards_ = spark.createDataFrame([(i, f"n{i}") for i in range(901)], "id int, name string").repartition(5)
    sales = spark.createDataFrame([(3, 1.0), (3, 2.0)], "id int, price double")
    out = writers.nested_chunks(cards_, sales, "id").collect()
    sizes = {}
    for r in out:
        sizes.setdefault(r.chunk, []).append(json.loads(r.json))
    assert {k: len(v) for k, v in sizes.items()} == {0: 900, 1: 1} and sizes[1][0]["id"] == 900
    assert [c["sales"] for c in sizes[0] if c["id"] == 3] == [[{"price": 1.0}, {"price": 2.0}]]


def test_runs_locks_snapshots_and_reports(spark, tmp_path):
    day = spark.createDataFrame([(1, dt.date(2024, 5, 1)), (2, None)], "id int, sold_date date")
    for _ in range(2):
        writers.append_lake(day, f"{tmp_path}/lake", "r1")
    writers.append_lake(day, f"{tmp_path}/lake", "r2")
    assert readers.read_lake(spark, f"{tmp_path}/lake").groupBy("ingest_run_id").count().filter("count = 2").count() == 2
    (tmp_path / "t").mkdir()
    with writers.single_writer(spark, f"{tmp_path}/t"), pytest.raises(RuntimeError), writers.single_writer(spark, f"{tmp_path}/t"):
        pass
    with writers.single_writer(spark, f"{tmp_path}/t"):
        pass
    for n in (3, 5):
        writers.write_snapshot(spark.range(n), f"{tmp_path}/snap")
    assert spark.read.parquet(f"{tmp_path}/snap").count() == 5
    writers.write_markdown(spark.createDataFrame([(1, "a|b"), (2, None)], "n int, t string"), f"{tmp_path}/md", "Report")
    assert [r.value for r in spark.read.text(f"{tmp_path}/md").collect()] == ["# Report", "", "| n | t |", "|---|---|", "| 1 | a\\|b |", "| 2 |  |"]
    writers.write_lake(day, f"{tmp_path}/groups", row_group=1 << 20)
    assert readers.read_files(spark, [f"{tmp_path}/groups/year=2024", f"{tmp_path}/groups/year=0"]).columns == ["id", "sold_date"]


def test_readers(spark, tmp_path):
    (tmp_path / "n.jsonl").write_text('{"id": "1", "raw": {"x": "a"}}\nbroken\n{"id": null}\n\n{"id": "2"}\n')
    path, schema = str(tmp_path / "n.jsonl"), "id string, raw struct<x:string>"
    assert readers.read_nested(spark, path, schema, "id").count() == 2
    counts = readers.nested_counts(spark, path, schema, "id").first()
    assert (counts.n_kept, counts.n_without, counts.n_broken, counts.n_seen) == (2, 1, 1, 4)
    (tmp_path / "seed.json").write_text('{"sales": [{"title": "a", "price": 1.5}, {"title": "b"}], "sources": {}}')
    assert [tuple(r) for r in readers.seed(spark, str(tmp_path / "seed.json"), "sales", "title string, price double").collect()] == [("a", 1.5), ("b", None)]
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/p")
    assert sorted(r.src_row for r in readers.with_lineage(spark.read.parquet(f"{tmp_path}/p")).collect()) == [0, 1, 2, 3, 4]


def test_staging(spark):
    with staging.recorded() as made:
        staging.staged(spark.range(3), "t")
    assert len(made) == 1 and staging.fresh(["A", "_a"], "a") == "__a"
    staging.delete(spark, made)
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(made[0])


def test_pages(spark):
    html = (
        '<a href="/archives/2023/Fall/1/1914-cracker-jack">x</a> <img src="https://i/1.jpg"> Lot 1 - $1,528 <a href="/archives/2023/Fall/2/no-price">y</a>'
        '<a href="/archives/2025/Marketplace/3/third-lot">z</a> <b>$456,000</b>'
    )
    gallery = '<p>End: 11/18/2004 1:00 PM</p><div class="item"><h5 class="boxed"> 12 </h5><a href="bidplace.aspx?itemid=77">Stars &amp; <i></i></a></div><div class="item"><a href="bidplace.aspx?itemid=78">Stars &amp; Rookies</a> Bids: <strong> 9</strong> Status: <strong>Closed </strong> SOLD FOR $1,234.50</div>'
    select = '<select id="Auction"><option value="3">A &amp; B</option><option value="4">C</option></select>'
    check = "<script>#9 No</script><h2>Base</h2><ul><li>1 Ann Lee</li><li>noise</li></ul><b>Gold &amp; more</b><p>MSS-2 Bo<br/>AB-3: Cy</p>"
    article = "<ul><li>1952 Topps #311 Mantle PSA 8 — sold for $1.5 million</li><li>Home $5</li><li>1952 Topps #311 Mantle PSA 8 — sold for $1.5 million</li><li>A card worth $20k then <b>$1,250</b></li></ul>"
    page = lambda x: spark.createDataFrame([(1, x), (2, None), (3, "")], "page_id int, html string")
    lots = pages.archive_lots(page(html), "https://h").orderBy("pos").collect()
    assert [(r.lot, r.title, r.sold_price, r.season, r.sold_date, r.image_url) for r in lots] == [("1", "1914 Cracker Jack", 1528.0, "Fall", dt.date(2023, 11, 1), "https://i/1.jpg"), ("3", "Third Lot", 456000.0, "Marketplace", dt.date(2025, 7, 1), None)]
    assert lots[0].url == "https://h/archives/2023/Fall/1/1914-cracker-jack"
    items = {r.itemid: r for r in pages.gallery_lots(page(gallery)).collect()}
    assert items["78"].title == "Stars & Rookies" and items["78"].bids == 9 and items["78"].sold_price == 1234.5 and items["78"].status == "Closed" and items["78"].auction_end == dt.date(2004, 11, 18)
    assert [(r.value, r.label) for r in pages.options(page(select), "Auction").orderBy("pos").collect()] == [("3", "A & B"), ("4", "C")]
    assert [(r.section, r.code, r.character) for r in pages.checklist(page(check)).orderBy("pos").collect()] == [("Base", "1", "Ann Lee"), ("Gold & more", "MSS-2", "Bo"), ("Gold & more", "AB-3", "Cy")]
    assert [(r.description, r.price_text, r.price) for r in pages.article_lots(page(article)).orderBy("pos").collect()] == [("1952 Topps #311 Mantle PSA 8 — sold for", "$1.5 million", 1.5e6), ("A card worth $20k then", "$1,250", 1250.0)]


def test_mappers(spark):
    raw = lambda rows: spark.createDataFrame([{k: v for k, v in r.items()} for r in rows], ", ".join(f"{c} string" for c in sorted({c for r in rows for c in r})))
    gold = raw([{"lot_id": "1", "comp_id": "c", "sold_price": "100", "buyer_premium_pct": "20", "sold_date": "2024-01-02", "title": "t", "url": "u"}, {"lot_id": "", "comp_id": "c2", "sold_price": "100", "buyer_premium_pct": None, "sold_date": "2024-01-02", "title": None, "url": "u"}, {"lot_id": "3", "comp_id": "", "sold_price": "x", "buyer_premium_pct": "5", "sold_date": "2024-01-02", "title": "", "url": ""}])
    got = mappers.MAPPERS["goldin"](gold).orderBy("source_item_id").collect()
    assert [(r.source_item_id, r.sold_price, r.title) for r in got] == [("1", 120.0, "t"), ("c2", 100.0, "")] and got[0].facts["price_basis"] == "hammer_plus_bp"
    report = raw([{"post_url": "p", "sold_price": "5", "title": "1952 Mantle  PSA 8", "sold_date": "2024-01-02", "auction_house": "H"}, {"post_url": "p", "sold_price": "5", "title": "Contractor bought it", "sold_date": "2024-01-02", "auction_house": "H"}])
    assert [(r.source_item_id, r.facts["auction_house"]) for r in mappers.MAPPERS["auctionreport"](report).collect()] == [("p#5.0#1952 mantle psa 8", "H")]
    lots = raw([{"url": "u1", "sold_price": "7", "sold_date": "2024-01-02", "season": "Fall"}, {"url": "", "sold_price": "7", "sold_date": "2024-01-02", "season": "Fall"}, {"url": "u3", "sold_price": "0", "sold_date": "2024-01-02", "season": ""}])
    assert [r.source_item_id for r in mappers.map_sources({"rea": lots, "memorylane": lots}).collect()] == ["u1", "u1"]
    with pytest.raises(ValueError, match="no source"):
        mappers.map_sources({})
    built = mappers.build_rows(raw([{"title": "Sealed lot of 3", "price": "US $5", "sold_date": "3/1/2024", "url": "https://x/a/?q"}]), "s").first()
    assert built.rejects == ["title_flag:lot", "title_flag:sealed"] and str(built.sold_price) == "5.00" and built.canonical_source_url == "https://x/a" and built.source_item_id == "https://x/a"
    assert values(spark, mappers.house, ["REA fall", "a great area", "Heritage and REA", None]) == ["REA", "", "Heritage Auctions", ""]


def test_titles(spark):
    lots = ["1909 T206 Cobb With Bat SGC 3", "1909-11 t206 set of 4", "Babe Ruth Single-Signed Baseball 1927 (PSA)", "1927 Game Worn Jersey Patch Card", "1927 Game Worn Jersey", "1933 Goudey (24)", "Undated card", "1952 Exquisite Collection Mantle", "1952 Topps 25 cards", None]
    assert values(spark, listings.single_lot, lots) == [True, False, False, False, False, False, False, True, False, False]
    assert values(spark, listings.other_auction, ["Video Games & Comics", "Spring cards", "Game-Used gear"]) == [True, False, True]
    assert values(spark, listings.title_flags, ["Lot of packs", "pilot", "Non-Card sticker only", None]) == [["lot", "pack"], [], ["non_card"], []]
    found = values(spark, lambda t: F.struct(F.coalesce(cards.print_run(t), F.lit(0)), cards.parallel_features(t)), ["black cat refractor", "Purple Mini Diamond /75", "blue ray wave 12/199", "gold red 1/1", "one of one"])
    assert [(a, f.finishes, f.colours, f.modifier) for a, f in found] == [(0, ["catfractor"], [], None), (75, [], ["purple"], "mini-diamond"), (199, [], ["blue"], "raywave"), (1, [], ["gold", "red"], None), (1, [], [], None)]
    kind = lambda t: F.struct(categories.category_by_keyword(t, F.lit(None).cast("string")), categories.sport_by_keyword(t, F.lit("")))
    assert [tuple(x) for x in values(spark, kind, ["Rolex watch", "LeBron", None])] == [("watches", "unknown"), ("sports", "basketball"), ("sports", "unknown")]


def test_runs(spark):
    log = spark.createDataFrame([("a", 1, "planned"), ("a", 2, "running"), ("a", 3, "completed"), ("a", 4, "running"), ("b", 1, "failed")], "w string, n int, status string")
    assert sorted((r.w, r.n) for r in states.bad_steps(log, ["w"], ["n"]).collect()) == [("a", 4), ("b", 1)]
    at = lambda h: dt.datetime(2026, 1, 1) + dt.timedelta(hours=h)
    items = spark.createDataFrame([("r", "x"), ("r", "y"), ("q", "z")], "ring string, item string")
    log = spark.createDataFrame([("x", at(1)), ("y", at(-5)), ("gone", at(2))], "item string, at timestamp")
    passes = spark.createDataFrame([("r", at(0))], "ring string, began timestamp")
    due = lambda h: {r.ring: (r.n_items, r.n_done, r.state) for r in states.pass_due(items, log, passes, "ring", "item", "at", F.lit(at(h)), 10).collect()}
    assert due(5) == {"r": (2, 1, "reading"), "q": (1, 0, "new_pass")} and due(16)["r"][2] == "new_pass"
    whole = log.unionByName(spark.createDataFrame([("y", at(3))], "item string, at timestamp"))
    assert [r.state for r in states.pass_due(items.filter("ring = 'r'"), whole, passes, "ring", "item", "at", F.lit(at(5)), 10).collect()] == ["complete"]
    assert monitor.store_audit(spark.createDataFrame([], "id int, p double"), "id", F.col("p"), {}).first().rows == 0
