"""Strict links, library pages and sales against catalogs: one fixture per reason."""

import datetime as dt

from pyspark.sql import functions as F

from lotweave.functions import cards
from lotweave.operators import library, sales, strict

CATALOG = [
    ("c1", "25-chrome", "base", "9", "Lucky Black Cat"), ("c2", "25-chrome", "base", "12", "Rare Robot"), ("c3", "25-chrome", "manga", "MS-3", "Rare Robot"), ("c4", "26-chrome", "base", "12", "Rare Robot"),
    ("c5", "26-chrome", "base", "200", "Tidy Troll"), ("c6", "25-chrome", "base", "40", "Bo"), ("c7", "25-chrome", "base", "41", "Bo"), ("c8", "25-chrome", "base", "50", "Bo Bold"),
]
CHECKLIST = [
    *[("25-chrome", "base", p, r) for p, r in [("Refractor", None), ("Gold Refractor", 50), ("Pink Refractor", 75), ("Black Refractor", 10), ("Aqua RayWave Refractor", 199), ("SuperFractor", 1), ("Black CatFractor", 7), ("Purple Refractor", 20), ("Purple Mini-Diamond Refractor", 20)]],
    *[("26-chrome", "base", p, r) for p, r in [("Refractor", None), ("Purple Refractor", 75)]], ("25-chrome", "manga", "Red Speckle", 5),
]
RULES = strict.LinkRules(
    sets=[strict.SetRule("25-chrome", ("chrome",), 2025), strict.SetRule("26-chrome", ("chrome",), 2026)], line=["cardline"], uncatalogued=["stained glass", "promo"], sections={"manga": ["manga"]},
    aliases={"very lucky cat": "lucky black cat"}, variations={"26-chrome": ["200"]},
)
TITLES = [
    ("2025 Card Line Chrome Rare Robot #12", "linked", "c2", "Base", None, "default_none_named"), ("2026 CardLine Chrome Rare Robot #12 PSA 10", "linked", "c4", "Base", None, "default_none_named"),
    ("Cardline Chrome Rare Robot #12 2025 Gold Refractor 07/50", "linked", "c2", "Gold Refractor", 50, "named_in_title"), ("2025 cardline chrome Very Lucky Cat #9", "linked", "c1", "Base", None, "default_none_named"),
    ("2025 cardline chrome Lucky Black Cat #9 black /10", "linked", "c1", "Black Refractor", 10, "named_in_title"), ("2025 cardline chrome Rare Robot #12 /199", "linked", "c2", "Aqua RayWave Refractor", 199, "inferred_from_print_run"),
    ("2025 cardline chrome Rare Robot #12 raywave", "linked", "c2", "Aqua RayWave Refractor", 199, "named_in_title"), ("2025 cardline chrome manga Rare Robot #3", "linked", "c3", "Base", None, "default_none_named"),
    ("2025 cardline chrome Rare Robot MS-3", "linked", "c3", "Base", None, "default_none_named"), ("2025 cardline chrome #12 refractor", "linked", "c2", "Refractor", None, "named_in_title"), ("2025 cardline chrome Bo Bold", "linked", "c8", "Base", None, "default_none_named"),
    ("2025 Chrome Rare Robot #12", "other_line"), ("2025 Cardline Chrome lot Rare Robot #12", "not_single"), ("2025 Cardline Chrome Rare Robot #12 + base", "not_single"), ("2025 Cardline Chrome Rare Robot #12 graded pristine", "grade_unknown"),
    ("2025 Cardline Chrome Rare Robot #12 PSA auth", "grade_unknown"), ("2025 Cardline Chrome promo Rare Robot #12", "product_not_in_catalog"), ("2025 Cardline Opaque Rare Robot #12", "set_unknown"), ("2025 Cardline Chrome Rare Robot Tidy Troll", "multiple_characters"),
    ("2025 Cardline Chrome Rare Robot #13", "number_character_conflict"), ("2025 Cardline Chrome", "character_unknown"), ("2025 Cardline Chrome #77", "no_catalog_match"), ("2025 Cardline Chrome Bo", "ambiguous"), ("Cardline Chrome Rare Robot #12", "ambiguous"),
    ("2025 Cardline Chrome Rare Robot #12 gold pink", "ambiguous_parallel"), ("2025 Cardline Chrome Rare Robot #12 teal", "parallel_not_on_checklist"), ("2025 Cardline Chrome Rare Robot #12 3/20", "numbered_parallel_unnamed"),
    ("2025 Cardline Chrome Rare Robot #12 refractor 3/250", "numbered_parallel_unnamed"), ("2025 Cardline Chrome Rare Robot #12 Gold /25", "print_run_conflict"), ("2026 Cardline Chrome Tidy Troll #200 SSP", "variation_possible"), (None, "other_line"), ("", "other_line"),
]


def test_strict_links(spark):
    catalog = spark.createDataFrame(CATALOG, "card_id string, set_key string, section string, code string, character string")
    lists = spark.createDataFrame(CHECKLIST, "set_key string, section string, parallel string, run int")
    rows = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TITLES)], "row_id int, title string")
    out = {r.row_id: r for r in strict.link(rows, catalog, lists, RULES).collect()}
    assert {i: out[i].reason for i in out} == {i: t[1] for i, t in enumerate(TITLES)}
    got = {i: (r.card_id, r.parallel, r.print_run, r.parallel_basis) for i, r in out.items() if r.reason == "linked"}
    assert got == {i: t[2:] for i, t in enumerate(TITLES) if t[1] == "linked"}
    assert out[1].grade == "PSA 10" and out[0].grade == "Raw" and out[9].rule == "code" and out[10].rule == "character" and len(out) == len(TITLES)
    assert strict.link(rows.limit(0), catalog, lists, RULES).isEmpty()


def test_links_of_finishes(spark):
    catalog = spark.createDataFrame([("s1", "base", "Ann"), ("s2", "base", "Bo"), ("s3", "mini", "Ann")], "card_id string, section string, character string")
    runs = spark.createDataFrame([("base", "Gold on Silver", 55), ("base", "Gold", None), ("mini", "base", None)], "section string, parallel string, run int")
    titles = [
        ("Ann Gold on Silver 3/55", "linked", "s1", "gold on silver", 55), ("Bo gold", "linked", "s2", "gold", None), ("Ann mini", "linked", "s3", "base", None), ("Ann gold on silver /10", "print_run_conflict"),
        ("Ann gold silver", "ambiguous_parallel"), ("Ann", "finish_unnamed"), ("Ann #5", "numbered_parallel_unnamed"), ("Ann Bo gold", "multiple_characters"), ("gold", "character_unknown"), ("Bo mini", "character_not_in_section"),
        ("Ann album gold", "other_product"), ("Ann mini foil gold", "ambiguous_section"), (None, "character_unknown"),
    ]
    rows = spark.createDataFrame([(i, t[0]) for i, t in enumerate(titles)], "row_id int, title string")
    out = {r.row_id: r for r in strict.link_finishes(rows, catalog, ["Gold", "Silver"], {"mini": ["mini"], "foil": ["foil"]}, runs, ["album"]).collect()}
    assert {i: out[i].reason for i in out} == {i: t[1] for i, t in enumerate(titles)}
    assert {i: (out[i].card_id, out[i].parallel, out[i].print_run) for i in range(3)} == {i: t[2:] for i, t in enumerate(titles[:3])}


def test_library(spark):
    pages = [
        "basketball-cards-2020-panini-prizm/ja-morant-10", "basketball-cards-2020-panini-prizm/ja-morant-gold-10", "basketball-cards-2019-panini-prizm/zion-williamson-248", "basketball-cards-2020-panini-prizm-downtown/ja-morant-10",
        "football-cards-2020-bowman-draft/aj-green-bd-50", "football-cards-2021-panini-select/joe-doe-pp-25", "football-cards-2021-panini-select/joe-doe-auto-7", "football-cards-2021-panini-select/joe-doe-7", "football-cards-2022-topps/ann-lee-3", "football-cards-2022-topps/ann-lou-3", "junk",
    ]
    lib = library.parse_library(spark.createDataFrame([(p,) for p in pages], "slug string"))
    assert lib.count() == 10
    sets = spark.createDataFrame([("Panini Prizm", "panini-prizm"), ("Prizm", "panini-prizm"), ("Bowman", "bowman"), ("Panini Select", "panini-select"), ("Topps", "topps")], "name string, set_slug string")
    prefixes = spark.createDataFrame([("bd", "bowman-draft")], "prefix string, set_slug string")
    cases = [
        ("2020 Panini Prizm Ja Morant #10 PSA 9", "assigned", pages[0]), ("2020 Prizm Ja Morant Gold #10", "assigned", pages[1]), ("2020 Panini Prizm Zion Williamson #248", "assigned", pages[2]), ("2020 Panini Prizm Downtown Ja Morant #10", "ambiguous", None),
        ("2020 Bowman AJ Green #BD-50", "assigned", pages[4]), ("2021 Panini Select Joe Doe #PP25", "assigned", pages[5]), ("2021 Panini Select Joe Doe auto #7", "assigned", pages[6]), ("2021 Panini Select Joe Doe #7", "assigned", pages[7]),
        ("2020 Panini Prizm Somebody Else #10", "player_mismatch", None), ("2020 Panini Prizm Ja Morant #99", "no_library_card", None), ("Panini Prizm Ja Morant #10", "missing_field", None), ("2020 Panini Prizm Ja Morant 10/25", "missing_field", None),
        ("2020 Pokemon Prizm #10", "non_sports_tcg", None), ("1921 Morgan Dollar #10", "coins", None), ("2022 Topps Ann #3", "ambiguous", None), (None, "missing_field", None),
    ]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "row_id int, title string")
    out = {r.row_id: (r.status, r.slug) for r in library.assign(rows, lib, sets, ["gold", "auto"], ["gold"], prefixes, "pokemon", "morgan dollar").collect()}
    assert out == {i: c[1:] for i, c in enumerate(cases)}


def test_library_words(spark):
    pages = [f"baseball-cards-2020-bowman/a{i}-b{i}-gold-bcp-{i}" for i in range(40)] + [f"baseball-cards-2020-topps/green-c{i}-{i}" for i in range(30)] + [f"baseball-cards-2020-topps/d{i}-e{i}-green-x-{i}" for i in range(30)]
    lib = library.parse_library(spark.createDataFrame([(p,) for p in pages], "slug string"))
    prefixes = library.prefix_sets(lib)
    assert sorted(map(tuple, prefixes.collect())) == [("bcp", "bowman"), ("x", "topps")]
    assert [r.token for r in library.parallel_words(lib, prefixes).collect()] == ["gold"]


def test_mismatches(spark):
    cases = [
        ("2020 Topps Chrome Gold Refractor #7", "Gold Refractor", None, 50, None), ("2020 Topps Chrome #7 red sox", "", None, None, None), ("2020 Topps Chrome complete set", "", None, None, "not a single card (set, lot or sealed product)"),
        ("2019 Topps #7", "", None, None, "set words not in the title: chrome"), ("2020 Topps Chrome Update", "", None, None, "title names another product line: update"), ("2020 Topps Chrome signed", "", None, None, "signed copy of a card with no autograph version (after-market signature)"),
        ("2020 Topps Chrome", "Gold", None, None, "catalog parallel not in the title: gold"), ("2020 Topps Chrome pink gold", "", None, None, "title names a parallel the card lacks: gold pink"), ("2020 Topps Chrome Gold /25", "Gold", 25, 50, "print run /25 vs /50"),
        ("2020 Topps Chrome autograph", "Auto", None, None, None),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, title string, parallel string, run int, card_run int, want string")
    why = cards.mismatch(F.col("title"), F.lit("2020 Topps Chrome Baseball"), F.col("parallel"), F.col("run"), F.col("card_run"))
    assert [(r.i, r.why) for r in df.select("i", why.alias("why")).orderBy("i").collect()] == [(i, c[-1]) for i, c in enumerate(cases)]


def test_resolved_sales(spark):
    catalog = spark.createDataFrame([("k1", "annlee", 2020, "7", "2020 Topps Chrome", "", None), ("k2", "annlee", 2020, "7", "2020 Topps Chrome", "Gold", 50), ("k3", "annlee", 2021, "7", "2021 Topps Finest", "", None), ("k4", "bo", 2020, "9", "Topps", "", None), ("k5", "bo", 2020, "9", "Topps", "", None)], "card_id string, player_key string, season_year int, number string, set_name string, parallel string, print_run int")
    rows = [
        (1, "2020 Topps Chrome Ann Lee #7", 5.0, ["annlee"], 2020, "7"), (2, "2020 Topps Chrome Ann Lee Gold #7", 2e6, ["annlee"], 2020, "7"), (3, "2020 Topps Ann Lee #7", 5.0, ["annlee"], 2020, "7"), (4, "2020 Topps Bo #9", 5.0, ["bo"], 2020, "9"),
        (5, "x", 5.0, [], 2020, "7"), (6, "x", 5.0, ["annlee"], 2020, None), (7, "x", 5.0, ["annlee"], 2020, "99"), (8, "x", 5.0, None, None, None),
    ]
    s = spark.createDataFrame([(*r, None) for r in rows], "sale_id int, title string, price double, player_keys array<string>, year int, code_key string, print_run int")
    out = {r.sale_id: (r.status, r.card_id) for r in sales.resolve_cards(s, catalog).collect()}
    assert out == {1: ("resolved", "k1"), 2: ("resolved_needs_review", "k2"), 3: ("needs_review", None), 4: ("needs_review", None), 5: ("needs_review", None), 6: ("needs_review", None), 7: ("mint_candidate", None), 8: ("needs_review", None)}


def test_proposed_ids(spark):
    s = spark.createDataFrame([
        (1, "2020 Topps Chrome Ann Lee Gold #7 PSA 9", 2020, "7", ["annlee"]), (2, "Ann Lee 2020 Topps #7", 2020, "7", ["annlee"]), (3, "2020 Ann Lee Bo Fox #7 signed", 2020, "7", ["annlee", "bofox"]), (4, "2020 Topps Ann Lee", 2020, None, ["annlee"]),
    ], "sale_id int, title string, year int, code string, player_keys array<string>")
    sports = spark.createDataFrame([("annlee", "bk")], "player_key string, sport string")
    out = {r.sale_id: (r.proposed_id, r.confidence, r.notes) for r in sales.propose_ids(s, sports, {"psa", "rookie"}).collect()}
    assert out == {1: ("bk:2020-topps-chrome:ann-lee:7~gold", "high", []), 3: ("bk:2020-:ann-lee:7", "low", ["several_players", "no_set", "signed_copy"])}


def test_same_sales_by_month(spark):
    day = dt.date
    rows = [(1, 100.0, day(2024, 1, 30), False, "Ann Lee rookie", []), (2, 100.4, day(2024, 2, 1), False, "ann lee rookie card", []), (3, 100.4, day(2024, 1, 1), True, "Ann Lee Rookie", []), (4, 100.0, day(2024, 1, 31), False, "another thing", []), (5, 100.0, day(2024, 1, 30), False, "x", ["p"]), (6, 100.0, day(2024, 1, 30), False, "y", ["p", "q"])]
    df = spark.createDataFrame(rows, "k int, p double, d date, m boolean, t string, ps array<string>")
    assert sorted(map(tuple, sales.same_sales(df, "k", "p", "d", "m", "t", "ps").collect())) == [(1, 2), (1, 3), (5, 6)]


def test_backing_is_independent(spark):
    rows = [("WEEKLY1", "c~a", "10", 100.0, "fanatics"), ("WEEKLY2", "c~b", "10", 90.0, "fanatics"), ("s3", "d", "9", 100.0, "x"), ("s4", "d", "10", 5.0, "x"), ("s5", "e", "9", 7.0, "x")]
    df = spark.createDataFrame(rows, "sale_id string, card_id string, grade string, price double, venue string")
    out = {r.sale_id: (r.level, r.backed) for r in sales.backed(df, df).collect()}
    assert out == {"WEEKLY1": (None, False), "WEEKLY2": (None, False), "s3": (1, False), "s4": (1, True), "s5": (None, False)}


def test_headlines(spark):
    from lotweave.operators import linking

    cases = [
        ("2003-04 Exquisite LeBron James #78 /99 BGS NM-MT+ 8.5", (2003, "78", "78", None, 99, "BGS 8.5")), ("1909 T206 Cobb Piedmont 150/25 SGC EX 5", (1909, None, None, None, None, "SGC 5")),
        ("2020 Prizm #BD-50 12/25 PSA GEM MINT 10", (2020, "BD-50", "bd50", "12/25", 25, "PSA 10")), ("Card #7 1/1", (None, "7", "7", "1/1", 1, None)), (None, (None,) * 6), ("PSA 10.5", (None,) * 6),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    out = {r.i: tuple(r.p) for r in df.select("i", linking.parse_headline(F.col("t")).alias("p")).collect()}
    assert out == {i: c[1] for i, c in enumerate(cases)}
    names = df.select(linking.name_windows(F.lit("1986 Fleer Michael Jordan rookie O'Neal")).alias("n")).first().n
    assert names == ["fleermichael", "michaeljordan", "jordanoneal", "fleermichaeljordan", "michaeljordanoneal"]


def test_catalog_plan(spark):
    from lotweave.functions import scalars
    from lotweave.operators import ledger, reconcile

    cards_ = spark.createDataFrame([("a", True, "01", "1"), ("b", True, None, None), ("c", False, "X-2", "bad"), ("d", True, "", "z"), ("e", True, None, None)], "card_id string, visible boolean, number string, number_key string")
    checklist = spark.createDataFrame([("c",), ("a",)], "card_id string")
    want = spark.createDataFrame([("s1", "a"), ("s2", "a"), ("s3", "n"), ("s4", "a")], "sale_id string, card_id string")
    have = spark.createDataFrame([("s1", "a", False), ("s2", "b", True), ("s4", "d", True), ("s5", "d", True), ("s6", "e", False)], "sale_id string, card_id string, published boolean")
    plan = ledger.catalog_plan(cards_, checklist, want, have, scalars.number_key)
    assert sorted((r.kind, r.action, r.id, r.new) for r in plan.collect() if r.action not in ("move",)) == [
        ("card", "add", "n", None), ("card", "number_key", "c", "x2"), ("card", "redirect", "b", "a"), ("card", "restore", "c", None), ("card", "withdraw", "b", None), ("card", "withdraw", "d", None),
        ("card", "withdraw", "e", None), ("sale", "insert", "s3", "n"), ("sale", "republish", "s1", "a"), ("sale", "retract", "s5", None),
    ]
    assert sorted((r.id, r.old, r.new) for r in plan.filter("action = 'move'").collect()) == [("s2", "b", "a"), ("s4", "d", "a")]
    old = spark.createDataFrame([("a", "A", "m1"), ("b", "B", None), ("z", "Z", "m9")], "card_id string, name string, minted_id string")
    new = spark.createDataFrame([("a", "A2", "other"), ("n", "N", "m2")], "card_id string, name string, minted_id string")
    kept, links = ledger.replace_links(old, new, spark.createDataFrame([("t1", "a"), ("t2", "b")], "id string, card_id string"))
    assert sorted(map(tuple, kept.collect())) == [("a", "A2", "m1"), ("n", "N", "m2"), ("z", "Z", "m9")] and [r.id for r in links.collect()] == ["t1"]
    image = ledger.before_image(old, spark.createDataFrame([("a",)], "card_id string"), "card_id")
    assert reconcile.same_rows(reconcile.revert(kept.filter("card_id = 'a'"), image, "card_id"), image)
    audit = spark.createDataFrame([("a", "A", "A2"), ("n", "old", "N1"), ("z", "Z", "Z")], "card_id string, name string, after string")
    assert [tuple(r) for r in ledger.to_revert(audit, kept, "card_id", "name").collect()] == [("a", "A")]


def test_index_outcomes_and_hosts(spark, tmp_path):
    import pytest

    from lotweave.operators import ledger

    with pytest.raises(FileNotFoundError):
        ledger.ensure_index(spark, f"{tmp_path}/none", f"{tmp_path}/i", ["k"], "at")
    spark.createDataFrame([(1, 5), (1, 3), (None, 2)], "k int, at int").write.parquet(f"{tmp_path}/lake")
    assert sorted(map(str, ledger.ensure_index(spark, f"{tmp_path}/lake", f"{tmp_path}/i", ["k"], "at").collect())) == ["Row(k=1, at=3)", "Row(k=None, at=2)"]
    spark.createDataFrame([(9, 9)], "k int, at int").write.mode("append").parquet(f"{tmp_path}/lake")
    assert ledger.ensure_index(spark, f"{tmp_path}/lake", f"{tmp_path}/i", ["k"], "at").count() == 2 and ledger.ensure_index(spark, f"{tmp_path}/lake", f"{tmp_path}/i", ["k"], "at", True).count() == 3
    rows = spark.range(20).select(F.when(F.col("id") % 2 == 0, "even").alias("why"), "id")
    assert {r.why: (r.n, r.examples) for r in ledger.outcomes(rows, ["why"], "id", 2).collect()} == {"even": (10, [0, 2]), None: (10, [1, 3])}
    pics = spark.createDataFrame([("http://Dead.host/a", "1"), ("http://ok/b", "2"), (None, "3"), ("http://ok/c", "4")], "url string, key string")
    assert sorted(r.key for r in ledger.without_hosts(pics, "url", ["dead.host"], spark.createDataFrame([("4",)], "key string")).collect()) == ["2", "3"]
    ids = spark.createDataFrame([("baseball-cards-2020-topps/x-1",), ("chess-cards-2020-a/x-1",), ("no-address",)], "s string").select(ledger.set_id(F.col("s")).alias("i")).collect()
    assert [r.i for r in ids] == ["scp:bb:2020-topps", None, None]
    assert [tuple(r) for r in ledger.best_company_count(spark.createDataFrame([("a", "PSA 9"), ("a", "psa"), ("a", "none"), ("a", "BGS")], "i string, t string"), "i", F.col("t")).collect()] == [("a", 2)]
