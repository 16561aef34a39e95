"""Readers and writers that no query goes through, and the entry point without the corpus modules."""

import json
import os
import shutil
import subprocess
import sys

from pyspark.sql import functions as F

from lotweave.functions import scalars
from lotweave.operators import canonical, linking
from lotweave.sources import readers, writers

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"x, y"\n2,\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "a.csv"), ["id", "name"], True).collect()] == [("1", "x, y"), ("2", None)]
    (tmp_path / "a.jsonl").write_text('{"id": 1, "name": "x"}\nbad\n{"name": "y", "more": 1}\n')
    rows = readers.read_json(spark, str(tmp_path / "a.jsonl"), ["id", "name"]).orderBy("src_row").collect()
    assert [(r.id, r.name) for r in rows] == [("1", "x"), (None, None), (None, "y")] and all(r.src_file.endswith("a.jsonl") for r in rows)
    feed = "<rss><channel><item><title>One</title><link>u1</link><pubDate>Tue, 03 Mar 2026 10:00:00 +0000</pubDate><category>A</category><category>B</category></item><item><title>Two</title><link>u2</link></item></channel></rss>"
    (tmp_path / "feed.xml").write_text(feed)
    items = readers.read_feed(spark, str(tmp_path / "feed.xml")).orderBy("link").collect()
    assert [(r.title, r.link, r.category) for r in items] == [("One", "u1", ["A", "B"]), ("Two", "u2", None)]
    facts = readers.file_facts(spark, str(tmp_path / "a.csv")).first()
    assert facts["size"] == (tmp_path / "a.csv").stat().st_size and facts.path.endswith("a.csv") and facts.changed is not None
    marks = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id int, at int")
    assert [r.id for r in readers.read_after(marks, "at", F.lit(5)).collect()] == [1, 2, 3] and readers.read_after(marks, "at", F.lit(6)).count() == 2


def test_plain_sinks(spark, tmp_path):
    df = spark.range(25).select("id", F.lit("a,b").alias("t")).coalesce(1)
    writers.write_chunks(df, f"{tmp_path}/chunks", 10)
    files = [f for f in os.listdir(f"{tmp_path}/chunks") if f.endswith(".json")]
    lines = [json.loads(x) for f in files for x in open(f"{tmp_path}/chunks/{f}")]
    assert len(files) == 3 and sorted(r["id"] for r in lines) == list(range(25))
    writers.write_delta_csv(df.limit(1), f"{tmp_path}/csv")
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/csv").collect()] == [("0", "a,b")]


def test_pages_faults_and_canaries(spark, tmp_path):
    writers.write_html(spark.createDataFrame([(1, "a<b & c"), (2, None)], "n int, t string").orderBy("n"), f"{tmp_path}/html", "R & D")
    page = "".join(r.value for r in spark.read.text(f"{tmp_path}/html").collect())
    assert page.startswith("<!doctype html>") and "<title>R &amp; D</title>" in page and "<tr><td>1</td><td>a&lt;b &amp; c</td></tr><tr><td>2</td><td></td></tr></table>" in page
    good, bad = canonical.split_valid(spark.createDataFrame([(1, "x"), (None, ""), (3, "")], "i int, t string"), [(F.col("i") < 0, "negative"), (F.col("t") == "", "empty")])
    assert [r.i for r in good.collect()] == [1] and sorted(((r.i or 0), r.faults) for r in bad.collect()) == [(0, ["negative", "empty"]), (3, ["empty"])]
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(50).select(F.col("id").alias("ID")).write.format("jdbc").options(url=url, dbtable="t", **driver).save()
    assert readers.read_table(spark, url, "t", "ID", 4, most=7, queryTimeout="30", **driver).count() == 7


def test_first_numbers_and_families(spark):
    got = spark.createDataFrame([("70.0 to 80.0",), ("USD 1,250.5",), (None,), ("-",)], "t string").select(scalars.price(F.col("t")).alias("p")).collect()
    assert [r.p for r in got] == [70.0, 1250.5, None, None]
    assert spark.range(1).select(linking.family(F.lit("a:b~gold~x"))).first()[0] == "a:b"


def test_entry_without_the_corpus_folders(tmp_path):
    """What is left when lotweave/llm, its tests and the pipeline are deleted still imports and registers its queries."""
    copy = tmp_path / "repo"
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 100 and set(o) <= set(q) and not any(n.startswith('op1') or n == 'pipeline' for n in q); print(len(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) > 100, done.stderr[-800:]
