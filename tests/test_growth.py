"""Work that follows the rows, not the square of a group of alike ones."""

import datetime as dt
import random

from lotweave.operators import joins, library, linking, sales
from pyspark.sql import functions as F


def rows_made(df):
    """The most rows that a step of the plan gave while ``df`` was collected."""
    df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            made, kids = p.metrics().get("numOutputRows"), p.children()
            most = max(most, made.get().value()) if made.isDefined() else most
            todo += [kids.apply(i) for i in range(kids.size())]
    return most


def test_links_to_many_alike_cards(spark):
    cards = [(f"c{i}", "Ann Lee", ["topps"], "7") for i in range(300)] + [("d", "Ann Lee", ["topps", "chrome"], "7"), ("e", "Ann Lee", [], "9"), ("f", "Bo Fox", ["topps"], None), ("g", "Cy Dee", None, "1")]
    cat = spark.createDataFrame(cards, "card_id string, character string, set_words array<string>, number string")
    said = {"topps ann lee #7": (None, "ambiguous"), "topps chrome ann lee #7": ("d", "ok"), "fleer ann lee #9": ("e", "ok"), "topps ann lee": (None, "ambiguous"), "topps chrome ann lee": ("d", "ok"), "bo fox topps": ("f", "ok"), "bo fox topps #1": (None, "no_catalog_match"), "ann lee #8": (None, "no_catalog_match"), "cy dee #1": (None, "no_catalog_match")}
    rows = [(i, t) for i, t in enumerate(list(said) * 40)]
    out = linking.link_titles(spark.createDataFrame(rows, "row_id int, title string"), cat)
    assert {r.row_id: (r.card_id, r.reason) for r in out.collect()} == {i: said[t] for i, t in rows}
    assert rows_made(out) < 5000


def test_resolve_among_many_alike_cards(spark):
    cat = spark.createDataFrame([(f"c{i:03}", "a", 1) for i in range(300)] + [("d", "a", 2), ("e", "b", 1), ("e", "b", 1), (None, "n", 1)], "card_id string, k string, level int")
    rows = spark.createDataFrame([(i, "abnz"[i % 4]) for i in range(400)], "row int, k string")
    get = lambda df: {r.row: (r.card_id, r.reason) for r in df.collect()}
    rest = [("e", "ok"), (None, "ok"), (None, "no_match")]
    for rank, of_a in (([F.lit(1)], (None, "ambiguous")), ([F.col("level")], (None, "ambiguous")), ([F.col("level").desc()], ("d", "ok"))):
        out = joins.resolve(rows, cat, "row", ["k"], rank)
        assert get(out) == {i: [of_a, *rest][i % 4] for i in range(400)}
        assert rows_made(out) < 5000
    assert get(joins.resolve(rows.limit(1), cat, "row", ["k"], [F.col("level"), F.col("card_id")])) == {0: ("c000", "ok")}


def test_set_words_of_many_alike_cards(spark):
    cards = [(i, "b", ["red", "fox"]) for i in range(300)] + [(300, "b", ["red"]), (301, "b", ["red", "fox", "cub"]), (302, "b", []), (303, None, ["red"]), (304, "c", ["", "x"])]
    cat = spark.createDataFrame(cards, "card_id long, k string, set_words array<string>")
    said = [("b", ["fox", "red", "small"], None, "ambiguous"), ("b", ["cub", "fox", "red"], 301, "assigned"), ("b", ["red"], 300, "assigned"), ("b", ["blue"], 302, "assigned"), ("c", ["x"], None, "no_card"), ("c", ["x", ""], 304, "assigned"), (None, ["red"], None, "missing_field"), ("b", None, None, "no_card")]
    rows = [(i, *said[i % len(said)][:2]) for i in range(40 * len(said))]
    out = linking.assign_by_set(spark.createDataFrame(rows, "row long, k string, words array<string>"), cat, "row", "words", ["k"])
    assert {r.row: (r.card_id, r.status) for r in out.collect()} == {i: said[i % len(said)][2:] for i, _, _ in rows}
    assert rows_made(out) < 5000


def test_same_sales_of_many_alike_ones(spark, monkeypatch):
    monkeypatch.setattr(sales, "MAX_KEYS", 7)
    pick, day = random.Random(3), dt.date(2024, 1, 25)
    prices, titles, players = [100.0, 100.6, 99.0, 101.5, 0.0, None], ["ann lee rookie", "ann lee", "bo fox", None], [[], ["p"], ["p", "q"], None]
    kinds = [(pick.choice(prices), pick.choice([day + dt.timedelta(i) for i in range(0, 12, 2)] + [None]), pick.choice([True, False, False, None]), pick.choice(titles), pick.choice(players)) for _ in range(40)]
    rows = [(pick.randrange(400), *pick.choice(kinds)) for _ in range(150)] + [(1000 + i, 100.0, day, False, "ann lee", []) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, p double, d date, m boolean, t string, ps array<string>")
    words = lambda t: {w for w in (t or "").split() if len(w) > 2}

    def met(x, y):
        (_, p, d, m, t, ps), (_, q, e, n, u, qs) = x, y
        if not (p and q) or abs(p - q) > max(p, q) * 0.01 or d is None or e is None:
            return False
        near = (d.year, d.month) == (e.year, e.month) if m or n else None not in (m, n) and abs((d - e).days) <= 3
        both = words(t) | words(u)
        return near and (bool(set(ps) & set(qs)) if ps and qs else None not in (t, u) and len(words(t) & words(u)) / len(both) >= 0.3)

    want = sorted((x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and met(x, y))
    out = sales.same_sales(df, "k", "p", "d", "m", "t", "ps")
    assert sorted(map(tuple, out.collect())) == want and len(want) > 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(a#") + plan.count("Exchange hashpartitioning(b#") == 0


def test_library_of_many_alike_titles_and_addresses(spark):
    slugs = [("baseball-cards-2020-topps/ann-lee-7",)] * 100 + [("baseball-cards-2020-topps/bo-fox-7",)]
    lib = library.parse_library(spark.createDataFrame(slugs, "slug string"))
    sets, none = spark.createDataFrame([("Topps", "topps")], "name string, set_slug string"), spark.createDataFrame([], "prefix string, set_slug string")
    said = [("2020 Topps Lee #7", None), ("2020 Topps Leeann Fox", "missing_field"), (None, "missing_field"), ("2020 topps ann lee #7", "assigned"), ("2020 Topps Cy Dee #7", "player_mismatch"), ("2020 Topps Ann Lee #8", "no_library_card")]
    rows = [(i, said[i % 6][0]) for i in range(600)]
    out = library.assign(spark.createDataFrame(rows, "row_id int, title string"), lib, sets, [], [], none, "pokemon", "morgan dollar")
    got = {r.row_id: (r.status, r.slug) for r in out.collect()}
    assert len(got) == 600 and all(got[i] == got[i % 6] for i in got)
    assert all(got[i][0] == status for i, (_, status) in enumerate(said) if status) and got[3][1] == slugs[0][0]
    assert rows_made(out) < 2000


def test_library_of_many_pages_of_one_year_set_and_number(spark):
    said = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}x" for i in range(150)]
    slugs = [(f"baseball-cards-{y}-topps/{w}-lee-7",) for w in said for y in (2019, 2020)] + [("baseball-cards-2020-topps/bo-foxy-7",), ("football-cards-2020-topps/bo-foxy-7",)]
    lib = library.parse_library(spark.createDataFrame(slugs, "slug string"))
    sets, none = spark.createDataFrame([("Topps", "topps")], "name string, set_slug string"), spark.createDataFrame([], "prefix string, set_slug string")
    titles = [f"2020 Topps {w} #7" for w in said] + ["2020 Topps Foxy #7", "2020 Topps Bo Lee #7", "2020 Topps Cy #7"]
    out = library.assign(spark.createDataFrame(list(enumerate(titles)), "row_id int, title string"), lib, sets, [], [], none, "pokemon", "morgan dollar")
    got = {r.row_id: (r.status, r.slug) for r in out.collect()}
    assert got == {i: ("assigned", f"baseball-cards-2020-topps/{w}-lee-7") for i, w in enumerate(said)} | {150: ("ambiguous", None), 151: ("ambiguous", None), 152: ("player_mismatch", None)}
    assert rows_made(out) < 2000


def test_set_words_of_many_alike_rows(spark, monkeypatch):
    made = []
    monkeypatch.setattr(linking, "staged", lambda df, name: (made.append(rows_made(df)), df)[1], raising=False)
    cards = [(i, "b", [f"w{i}", f"w{i + 1}"]) for i in range(7)] + [(7, "b", ["w0", "w1", "w2"])]
    cat = spark.createDataFrame(cards, "card_id long, k string, set_words array<string>")
    said = [("b", [f"w{j}" for j in range(8)], 7, "assigned"), ("b", ["w5", "w6", "w7"], None, "ambiguous"), ("b", ["w6", "w7", "x"], 6, "assigned"), ("b", ["w6"], None, "no_card"), (None, ["w6", "w7"], None, "missing_field")]
    rows = [(i, *said[i % len(said)][:2]) for i in range(2500)]
    out = linking.assign_by_set(spark.createDataFrame(rows, "row long, k string, words array<string>"), cat, "row", "words", ["k"])
    assert {r.row: (r.card_id, r.status) for r in out.collect()} == {i: said[i % len(said)][2:] for i, _, _ in rows}
    assert max([*made, rows_made(out)]) <= 2500


def test_set_words_of_repeated_and_null_row_keys(spark, monkeypatch):
    cat = spark.createDataFrame([(1, "b", ["a"]), (2, "b", ["a", "c"]), (3, "d", ["e", "f"])], "card_id long, k string, set_words array<string>")
    rows = spark.createDataFrame([(1, "b", ["a"]), (1, "b", ["a", "c"]), (2, "b", ["c", "a"]), (2, "d", ["e", "f"]), (3, None, ["a"]), (3, "b", ["a"]), (4, "b", None), (None, "b", ["a"])], "row long, k string, words array<string>")
    want = [(None, None, "no_card"), (1, 2, "assigned"), (1, 2, "assigned"), (2, None, "ambiguous"), (2, None, "ambiguous"), (3, 1, "assigned"), (3, 1, "missing_field"), (4, None, "no_card")]
    for most in (linking.MAX_BROADCAST_CARDS, 0):
        monkeypatch.setattr(linking, "MAX_BROADCAST_CARDS", most)
        out = linking.assign_by_set(rows, cat, "row", "words", ["k"])
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_set_word_match_of_null_names_and_types(spark, tmp_path):
    from lotweave.plans import registry

    rows = [(1, "red fox", "b", "small"), (2, None, "b", "red"), (3, "red", "b", "x"), (4, "old cup", "b", None)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    got = sorted(map(tuple, registry.queries()["set_word_match_all"](spark, str(tmp_path)).collect()))
    assert got == [(1, 1, "assigned"), (2, None, "no_card"), (3, 3, "assigned"), (4, None, "no_card")]
