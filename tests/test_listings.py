from pyspark.sql import functions as F

from lotweave.functions import listings
from lotweave.operators import canonical, monitor, pictures, sharding
from lotweave.sources import readers, writers


def test_nulls_and_odd_values(spark):
    rows = spark.createDataFrame([(None, None), ("", ""), ("..", "http://h/img/a/.."), ("k", "nonsense")], "key string, url string")
    got = rows.select(listings.key_ok(F.col("key")).alias("ok"), listings.picture(F.col("url"), "h", ["a"])["state"].alias("state"), listings.single_card(F.col("url")).alias("single")).collect()
    assert [r.ok for r in got] == [False, False, False, True] and [r.state for r in got] == ["empty", "empty", "bad_key", "other_host"] and not any(r.single for r in got)
    facts = rows.limit(1).select(
        listings.dedupe_keys({"id": F.col("key")}, F.col("key"), F.col("key"), F.col("key")).alias("keys"), listings.void_payment(F.lit("Unpaid"), F.lit(None).cast("date"), F.lit(None).cast("date"), F.current_date()).alias("void"),
        listings.shard_path(F.lit("s"), F.lit("abc")).alias("path"), listings.picture_urls([F.lit(None).cast("array<string>")], [F.lit(None)]).alias("urls"), listings.single_product(F.lit("Booster"), F.lit("1")).alias("one"),
        listings.routed_url("http://b", {"A": "a"}, F.lit(None).cast("string"), F.lit("u"), F.lit(None).cast("string")).alias("url"),
    ).first()
    assert facts.asDict() == {"keys": [], "void": False, "path": "s/ab/c/abc", "urls": [], "one": False, "url": ""}


def test_public_without_a_list_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "1"), (None, "1"), ("a", None)], "source string, key string")
    got = {(r.source, r.key): (r.allowed, r.reason) for r in pictures.public(rows, None, ["a", "b"], open_without_list=["b"]).collect()}
    assert got == {("a", "1"): (False, "no_list_closed"), ("b", "1"): (True, "no_list_open_source"), (None, "1"): (False, "bad_request"), ("a", None): (False, "bad_request")}
    none = rows.limit(0)
    assert pictures.public(none, rows, ["a"]).count() == 0
    assert canonical.insert_counts(none, rows, ["source", "key"], F.lit(True)).first().asDict() == {"n_new": 0, "n_existing": 0, "n_bad": 0}
    assert canonical.insert_counts(rows.union(rows), none, ["source", "key"], F.col("source").isNotNull()).first().asDict() == {"n_new": 3, "n_existing": 3, "n_bad": 2}


def test_pairs_and_dense_bands(spark):
    lines = spark.createDataFrame([(1, "o"), (2, "o"), (3, "c"), (4, "c"), (5, "o"), (6, "x"), (7, "c"), (8, "o")], "at int, what string")
    for segment in (None, F.floor(F.col("at") / 2)):
        got = monitor.paired(lines, [], "at", F.col("what") == "o", F.col("what") == "c", segment).orderBy("closed").collect()
        assert [(r.opened, r.closed) for r in got] == [(2, 3), (5, 7)]
    sales = spark.range(50).select(F.lit(3.5).alias("price"), F.when(F.col("id") < 30, "a").when(F.col("id") < 45, "b").alias("kind"))
    shards = sharding.bisect_shards(sales, "price", 10, 0, 8)
    got = {r.kind: (r.lo, r.n, r.passes, r.residual) for r in sharding.split_dense(sales, shards, "price", "kind", 10).collect()}
    assert got == {"a": (3, 30, 2, 10), "b": (3, 15, 2, 0), None: (3, 5, 1, 0)}


def test_versions_runs_and_reports(spark, tmp_path):
    base = f"{tmp_path}/list"
    writers.publish_version(spark.range(5), base, 1)
    writers.publish_version(spark.range(2), base, 2)
    broken = tmp_path / "list" / "v0000000003"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"no table")
    assert readers.read_newest_good(spark, base)[1] == "v0000000002"
    (broken / "_SUCCESS").touch()
    df, version = readers.read_newest_good(spark, base, lambda t: t.count() >= 3)
    assert version == "v0000000001" and df.count() == 5
    for rows in (4, 3):
        writers.append_run(spark.range(rows), f"{tmp_path}/runs", "r1")
    writers.append_run(spark.range(2), f"{tmp_path}/runs", "r2")
    assert {r.ingest_run_id: r["count"] for r in spark.read.parquet(f"{tmp_path}/runs").groupBy("ingest_run_id").count().collect()} == {"r1": 3, "r2": 2}
    writers.write_dated_report(spark.range(1), f"{tmp_path}/report", "2026-01-02")
    assert spark.read.json(f"{tmp_path}/report/latest").count() == 1


def test_database_table(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(100).select(F.col("id").alias("ID"), (F.col("id") % 7).alias("N")).write.format("jdbc").options(url=url, dbtable="sales", **driver).save()
    got = readers.read_table(spark, url, "sales", "ID", 4, **driver)
    assert got.rdd.getNumPartitions() == 4 and got.count() == 100 and got.filter("n = 3").count() == 14
    assert readers.read_table(spark, url, "sales", **driver).select("id").distinct().count() == 100
    spark.range(0).select(F.col("id").alias("ID")).write.format("jdbc").options(url=url, dbtable="empty_sales", **driver).save()
    assert readers.read_table(spark, url, "empty_sales", "ID", **driver).count() == 0


def test_payloads_that_are_broken(spark):
    texts = spark.createDataFrame([(1, '{"a": {"b": [{"x": "1"}, {"x": null}]}}'), (2, '{"a": null}'), (3, "{"), (4, None)], "id int, body string")
    assert [(r.id, r.x) for r in readers.payload_records(texts, "body", ["a", "b"], "x string").collect()] == [(1, "1"), (1, None)]
    assert readers.urls_in(texts, "body").count() == 0
