import datetime as dt
import json
import random

from pyspark.sql import functions as F

from lotweave.functions import rules, scalars
from lotweave.operators import canonical, joins, linking, monitor, reconcile, sharding
from lotweave.sources import readers, writers
from lotweave.streaming import incremental

RAW = "title price sold_price price_text sold_date sold_date_raw url image_url best_offer source grade item_id player_query source_query comp_id scraped_at".split()


def one(spark, expr, **cols):
    row = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} string" for c in cols))
    return row.select(expr.alias("x")).first().x


def test_prices_and_dates(spark):
    p = lambda t: one(spark, scalars.price(F.col("t")), t=t)
    assert p("$1,234.56") == 1234.56 and p("") is None and p("abc") is None and p(None) is None
    d = lambda t: one(spark, scalars.sold_date(F.col("t")), t=t)
    assert d("Sold Apr 18, 2026") == dt.date(2026, 4, 18) and d("September 3, 2025") == dt.date(2025, 9, 3)
    assert d("2026-06-15") == dt.date(2026, 6, 15) and d("garbage") is None and d("2026-6") is None
    assert one(spark, scalars.last_money(F.col("t")), t="from $2k to $1.5 million") == 1.5e6
    assert one(spark, scalars.mail_date(F.col("t")).cast("date"), t="Tue, 03 Mar 2026 10:00:00 +0000") == dt.date(2026, 3, 3)


def test_text_helpers(spark):
    assert one(spark, scalars.slug(F.col("t")), t=" Él Niño's #1 ") == "el-nino-s-1"
    assert one(spark, scalars.fold(F.col("t")), t="Ǻrø") == "arø" and one(spark, scalars.html_unescape(F.col("t")), t="a &amp; b") == "a & b"
    assert one(spark, scalars.item_id(F.col("t")), t="https://x.com/itm/a-b/123?_skw=q") == "123"
    assert one(spark, scalars.query_param(F.col("t"), "_skw"), t="https://x.com/?_skw=a+b%20c") == "a+b c"
    assert one(spark, F.lower(F.col("t")).rlike(rules.any_word(["lot"])), t="a lot!") and not one(spark, F.col("t").rlike(rules.any_word(["lot"])), t="pilot lottery")


def test_canonical_stages(spark, tmp_path):
    def row(i, **x):
        return {**dict.fromkeys(RAW), "item_id": "5", "sold_date": "2026-03-01", "price": "10", "title": "t", **x}

    rows = [row(0, scraped_at="2026-05-01 00:00:00", source_query="q1"), row(1, grade="9", scraped_at="2026-04-10 00:00:00", source_query="q2", price="11"), row(2, sold_date="2026-03-02"), row(3, item_id="6", sold_date="bad")]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    raw = readers.read_json(spark, str(tmp_path / "a.json"), RAW)
    n = canonical.normalize(raw, canonical.listing_spec())
    c = canonical.canonicalize(n, [F.col("grade").isNull(), F.col("sold_price_usd").isNull(), F.col("src_file"), F.col("src_row")], {"queries": "query"}, {"price_conflict": scalars.cents(F.col("sold_price_usd"))})
    out = {r.key: r for r in c.withColumn("key", canonical.observation_key()).collect()}
    assert set(out) == {"EBAY:5:2026-03-01", "EBAY:5:2026-03-02", "EBAY:6:nodate"}
    won = out["EBAY:5:2026-03-01"]
    assert won.grade == "9" and won.n_observations == 2 and won.queries == ["q1", "q2"] and won.price_conflict and won.discovery == "ebay_v2_priority"
    assert not out["EBAY:6:nodate"].price_conflict
    again = canonical.new_rows(n, c, canonical.KEYS, [F.col("src_row")])
    assert again.isEmpty()
    writers.replace_source(c.withColumn("source", F.lit("m")), str(tmp_path / "lake"), "m")
    assert readers.read_lake(spark, str(tmp_path / "lake")).filter("source = 'm' AND year = 0").count() == 1


def test_gate(spark):
    g = lambda t, p="5", o="false": one(spark, canonical.valuation_gate(F.col("t"), F.col("p").cast("double"), F.col("o").cast("boolean")), t=t, p=p, o=o)
    assert [g("card"), g("card", o="true"), g("pick your card"), g("lot of 5"), g("card", p=None), g(" Shop on eBay "), g("not Shop on eBay at all")] == ["ok", "obo", "ambiguous_pick", "lot_bundle", "no_price", "not_a_listing", "ok"]


def test_joins_and_diffs(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    assert joins.semi_null_safe(a, spark.createDataFrame([(None,)], "k string"), ["k"]).first().id == 1
    have = spark.createDataFrame([(1, "a", True), (2, "a", True), (3, "b", False), (4, "c", True)], "k int, t string, v boolean")
    want = spark.createDataFrame([(1, "z"), (2, "z"), (3, "b"), (5, "n")], "k int, t string")
    plan = reconcile.diff(want, have, "k", "t", "v")
    assert {r.k: r.action for r in plan.collect()} == {1: "repoint", 2: "repoint", 3: "restore", 4: "withdraw", 5: "insert"}
    assert [tuple(r) for r in reconcile.redirects(plan).collect()] == [("a", "z")]
    b = spark.createDataFrame([(1, {"q": "1"}), (2, {"slug": "s"})], "id int, raw map<string,string>")
    m = reconcile.merge_tags(b, spark.createDataFrame([(1, "n"), (2, "n")], "id int, value string"), "id", "raw", "slug", "r")
    assert {r.id: r.raw for r in m.collect()} == {1: {"q": "1", "slug": "n", "slug_run": "r"}, 2: {"slug": "s"}}
    assert reconcile.same_rows(reconcile.undo_tags(m, "raw", "slug", "r").select("id", F.to_json("raw")), b.select("id", F.to_json("raw")))


def test_links_and_shards(spark):
    cat = spark.createDataFrame([("c1", "Ann Lee", ["topps"], "7"), ("c2", "Ann", ["topps"], "7"), ("c3", "Bo", ["topps"], "1"), ("c4", "Bo", ["topps"], "2")], "card_id string, character string, set_words array<string>, number string")
    rows = spark.createDataFrame([(1, "Topps Ann Lee #7"), (2, "topps ann #7"), (3, "topps bo"), (4, "topps bo #2"), (5, "lot topps bo #2"), (6, "zzz"), (7, "topps bo ann lee"), (8, "fleer bo #1")], "row_id int, title string")
    got = {r.row_id: (r.card_id, r.reason) for r in linking.link_titles(rows, cat).collect()}
    assert got == {1: ("c1", "ok"), 2: ("c2", "ok"), 3: (None, "ambiguous"), 4: ("c4", "ok"), 5: (None, "not_single"), 6: (None, "character_unknown"), 7: (None, "multiple_characters"), 8: (None, "no_catalog_match")}
    v = spark.range(100).select((F.col("id") % 10).cast("double").alias("v"))
    shards = sharding.bisect_shards(v, "v", 25, 0, 10).collect()
    assert sum(r.n for r in shards) == 100 and all(r.n <= 25 and not r.open for r in shards)


def test_monitoring(spark):
    e = spark.createDataFrame([(i, x) for i, x in enumerate([1, 1, 0, 1, 1, 1])], "i int, bad int")
    s = monitor.streaks(e.withColumn("g", F.lit(1)), ["g"], ["i"], F.col("bad") == 1).orderBy("i").collect()
    assert [r.streak for r in s] == [1, 2, 0, 1, 2, 3]
    lv = spark.createDataFrame([(i, x) for i, x in enumerate([30, 35, 30, 26, 30])], "i int, x int").withColumn("g", F.lit(1))
    assert [r.latched for r in monitor.latch(lv, ["g"], ["i"], F.col("x"), 34, 26).orderBy("i").collect()] == [False, True, True, False, False]


def test_streams(spark, tmp_path):
    src, sink = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    schema = "id long, v long"
    spark.createDataFrame([(1, 1), (2, 2), (2, 3)], schema).coalesce(1).write.mode("append").parquet(str(src))
    go = lambda: incremental.append_new(spark.readStream.schema(schema).parquet(str(src)), sink, str(tmp_path / "cp"), ["id"], [F.col("v")]).awaitTermination()
    go()
    spark.createDataFrame([(2, 9), (3, 9)], schema).coalesce(1).write.mode("append").parquet(str(src))
    go()
    go()
    assert sorted((r.id, r.v) for r in incremental.read_appended(spark, sink).collect()) == [(1, 1), (2, 2), (3, 9)]


def test_tail_and_lists(spark, tmp_path):
    f = tmp_path / "t.jsonl"
    f.write_bytes(b'{"a": 1}\nnot json\n{"title": "half')
    r = incremental._TailReader(str(f), 1 << 20)
    rows, at = r.read(r.initialOffset())
    assert [json.loads(x[0]) for x in rows] == [{"a": 1}] and at == {"at": 18}
    f.write_bytes(f.read_bytes() + b'"}\n')
    assert len(list(r.read(at)[0])) == 1
    ok = tmp_path / "l.txt"
    ok.write_text("#magic\nsrc/a/b\nsrc/c\n# end count=2\n")
    assert sorted(map(tuple, readers.read_checked_list(spark, str(ok), "#magic").collect())) == [("src", "a/b"), ("src", "c")]


def test_same_sale_across_month_end(spark, tmp_path):
    from lotweave.plans import linking as plans

    rng = random.Random(3)
    day = dt.datetime(2026, 1, 20)
    rows = [(1, 100.0, dt.datetime(2026, 1, 30), "x"), (2, 100.5, dt.datetime(2026, 2, 1), "x"), (3, 100.5, dt.datetime(2026, 2, 1), "y"), (4, 101.3, dt.datetime(2026, 2, 2), "x"), (5, 100.5, dt.datetime(2026, 2, 3), "x")]
    rows += [(i, 500 * rng.uniform(1, 1.1), day + dt.timedelta(rng.randrange(25)), rng.choice("xy")) for i in range(10, 250)]
    spark.createDataFrame(rows, "o_orderkey long, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    heads, want = [], {}
    for k, p, t, g in sorted(rows):
        found = next((h for h, hp, ht, hg in heads if hg == g and abs(p - hp) <= 0.01 * max(p, hp) and abs((t - ht).days) <= 3), None)
        if found is None:
            heads.append((k, p, t, g))
        want[k] = k if found is None else found
    got = {r.o_orderkey: r.group_head for r in plans.same_sale_groups(spark, str(tmp_path)).collect()}
    assert got == want and got[2] == 1 and got[3] == 3 and got[4] == 4 and got[5] == 4


def test_links_of_ten_name_lengths(spark):
    names = [" ".join(f"n{n}w{k}" for k in range(n)) for n in range(1, 10)]
    names.append(names[8] + " end")
    cat = spark.createDataFrame([(f"c{i}", n, ["topps"], str(i)) for i, n in enumerate(names)], "card_id string, character string, set_words array<string>, number string")
    rows = spark.createDataFrame([(i, f"topps {n} #{i}") for i, n in enumerate(names)], "row_id int, title string")
    assert {r.row_id: (r.card_id, r.reason) for r in linking.link_titles(rows, cat).collect()} == {i: (f"c{i}", "ok") for i in range(10)}


def test_fold_texts_beyond_a_head(spark, tmp_path):
    from lotweave.plans import registry

    spark.createDataFrame([(1, "x" * 60 + "É à")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert registry.queries()["fold_texts"](spark, str(tmp_path)).first().folded == "x" * 60 + "e a"


def test_catalog_resolve_all_takes_every_part(spark, tmp_path):
    from lotweave.plans import registry

    spark.createDataFrame([(1, "a", "b", "t", 3), (2, "a", "b", "t", 4)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    got = {r.row_id: (r.card_id, r.reason) for r in registry.queries()["catalog_resolve_all"](spark, str(tmp_path)).collect()}
    assert got == {1: ("card1", "ok"), 2: ("card2", "ok"), -2: (None, "no_match"), -3: (None, "no_match")}


def test_lookups_in_all_of_part(spark, tmp_path):
    from lotweave.plans import registry

    spark.createDataFrame([(1, "red fox", "b1", "t"), (7, "red fox", "b2", "t"), (8, "blue cat", "b2", "t")], "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    run = lambda name: sorted(map(tuple, registry.queries()[name](spark, str(tmp_path)).collect()))
    assert run("known_name_windows_all") == [(1, "red fox"), (7, "red fox"), (8, "blue cat")]
    assert run("set_word_match_all") == [(1, 1, "assigned"), (7, 7, "assigned"), (8, 8, "assigned")]


def test_near_anti_takes_any_tolerance_without_a_broadcast(spark):
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(i) if i is not None else None
    left = [(i, i % 3 if i % 11 else None, (i * 37) % 400 - 90 if i % 13 else None) for i in range(120)]
    right = [(i % 4 if i % 5 else None, (i * i * 7) % 400 - 90 if i % 6 else None) for i in range(25)]
    a = spark.createDataFrame([(i, k, day(x)) for i, k, x in left], "id int, k int, d date")
    b = spark.createDataFrame([(k, day(x)) for k, x in right], "k int, d date")
    for days in (0, 1, 6, 30):
        out = joins.near_anti(a, b, ["k"], "d", days)
        met = {i for i, k, x in left for rk, y in right if None not in (k, x, y) and k == rk and abs(x - y) <= days}
        assert sorted(r.id for r in out.collect()) == [i for i, _, _ in left if i not in met] and out.columns == a.columns
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
