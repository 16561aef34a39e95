"""Every query of the subpackage against its SQL or a brute-force version, its columns and types, and odd tables."""

import math
import os
import re
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotweave.llm import chat, exact, langid, licenses, mixing, neardup, packing, quality, queries, tokens, topk

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "labels", "conversations"]
COLUMNS = {
    "op1_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint", "op2_quality_scores": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string", "op4_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op5_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double", "op6_chat_windows": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op8_exact_topk": "query_id bigint, rank int, vec_id bigint, score bigint", "op9_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op10_harmonic_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def text(v):
    return None if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def results(spark):
    return {name: q(spark, SF) for name, q in queries.queries().items()}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, results, name):
    df = results[name]
    if name in COLUMNS:
        assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == COLUMNS[name]
    rows = df.collect()
    if name in queries.oracle_sql():
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        order = sorted(df.columns)
        want = con.execute(f"SELECT {', '.join(order)} FROM ({queries.oracle_sql()[name]})").fetchall()
        assert sorted(repr([text(r[c]) for c in order]) for r in rows) == sorted(repr([text(v) for v in r]) for r in want)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def bucket(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_quality_by_plain_numpy(spark, results, documents):
    """The same model from the same rows with one matrix each: features, ridge, pooled steps."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality is not None and bucket(r.doc_id, 5)}
    hashed = {r.doc_id: r.h for r in spark.createDataFrame([(r.doc_id,) for r in documents], "doc_id long").select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(5)) == 0).alias("h")).collect()}
    known = [r for r in documents if r.doc_id in labels]
    x, y = np.array([quality.statistics(r.text) for r in known]), np.array([float(labels[r.doc_id]) for r in known])
    held = np.array([hashed[r.doc_id] for r in known])
    mean, scale = x.mean(0), np.sqrt(np.maximum((x**2).mean(0) - x.mean(0) ** 2, 1e-6))
    rng = np.random.Generator(np.random.PCG64(11))
    w = rng.normal(0, np.sqrt(0.04), (quality.N_STATS, 192))
    b = rng.uniform(0, 2 * np.pi, 192)
    features = lambda x: np.column_stack([np.sqrt(2 / 192) * np.cos(np.clip((x - mean) / scale, -6, 6) @ w + b), np.ones(len(x))])
    e = features(x[~held])
    beta = np.linalg.lstsq(e.T @ e + 1e-4 * len(e) * np.diag([1.0] * 192 + [0.0]), e.T @ y[~held], rcond=None)[0]
    raw = features(x[held]) @ beta
    steps = defaultdict(list)
    for s, label in zip(raw, y[held], strict=True):
        steps[int(np.clip((s + 0.5) / 2 * 2048, 0, 2047))].append((s, label))
    knots = np.array([np.mean([s for s, _ in steps[k]]) for k in sorted(steps)])
    ys, n = np.array([np.mean([v for _, v in steps[k]]) for k in sorted(steps)]), np.array([len(steps[k]) for k in sorted(steps)])
    level = [[v, c, 1] for v, c in zip((ys * n + 0.01 * ys.mean()) / (n + 0.01), n + 0.01, strict=True)]
    i = 0
    while i + 1 < len(level):  # merge neighbours that fall, from the left, until none does
        if level[i][0] >= level[i + 1][0]:
            (v1, c1, k1), (v2, c2, k2) = level[i], level[i + 1]
            level[i : i + 2] = [[(v1 * c1 + v2 * c2) / (c1 + c2), c1 + c2, k1 + k2]]
            i = max(0, i - 1)
        else:
            i += 1
    values = np.concatenate([np.full(k, v) for v, _, k in level])
    want = np.clip(np.interp(features(np.array([quality.statistics(r.text) for r in documents])) @ beta, knots, values), 0, 1)
    got = {r.doc_id: r for r in results["op2_quality_scores"].collect()}
    assert len(got) == len(documents) and all(abs(got[r.doc_id].score - s) < 1e-6 for r, s in zip(documents, want, strict=True))
    assert all(got[r.doc_id].held_out == (bucket(r.doc_id, 5) == 0) and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3) for r in documents)


def test_language_by_plain_counting(results, documents):
    """Sets of n-grams in place of the bit-sliced filters: the same languages but where false positives decide."""
    table = langid._letters()
    total, grams = Counter(), defaultdict(Counter)
    for r in documents:
        if r.lang is not None and bucket(r.doc_id, 4) != 2:
            h = langid.ngrams(r.text, 3, table).tolist()
            total[r.lang] += len(h)
            grams[r.lang].update(h)
    share = {lang: {g: c / total[lang] for g, c in grams[lang].items()} for lang in grams}
    most = defaultdict(float)
    for s in share.values():
        for g, v in s.items():
            most[g] = max(most[g], v)
    kept = {lang: {g for g, v in s.items() if v >= 2e-5 and v >= 0.5 * most[g]} for lang, s in share.items()}
    got = {r.doc_id: r for r in results["op5_language_id"].collect()}
    same = 0
    for r in documents:
        h = langid.ngrams(r.text, 3, table).tolist()
        if not h:
            assert got[r.doc_id].lang_pred == "und" and got[r.doc_id].score == 0
            continue
        counts = {lang: sum(g in kept[lang] for g in h) for lang in sorted(kept)}
        same += got[r.doc_id].lang_pred == max(counts, key=lambda lang: (counts[lang], [-ord(c) for c in lang]))
    assert same >= 0.98 * len(documents) and all(got[r.doc_id].held_out == (bucket(r.doc_id, 4) == 2) for r in documents)
    held = [r for r in documents if bucket(r.doc_id, 4) == 2 and r.lang and any(c.isalpha() for c in r.text or "")]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)


def units_of(low, space):
    """Whole text, lines and blocks, as the operator's description has them."""
    solid = space.anchors - set(licenses.COMMON)
    has = lambda x, words: any(t in words for t in re.findall(r"(?<![a-z0-9])[a-z0-9]+(?:[.\-][a-z0-9]+)*", x)) or any(re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", x) for t in words)
    lines = [x for x in re.split(r"\r\n|\n|\r", low) if re.search("[a-z0-9]", x)]
    out = [low, *[x for x in lines if has(x, space.anchors)]]
    spans = set()
    for i in (i for i, x in enumerate(lines) if has(x, solid)):
        spans |= {(a, n) for n in licenses.BLOCKS if n <= len(lines) for a in range(max(0, i - n + 1), min(i, len(lines) - n) + 1)}
        spans |= {(i, min(n, len(lines) - i)) for n in licenses.LONG_BLOCKS}
    return out + ["\n".join(lines[a : a + n]) for a, n in spans if n > 1]


def test_licences_by_dense_vectors(results, documents):
    space = licenses.Space(licenses.TEMPLATES, 0.75)
    got = {r.doc_id: r for r in results["op7_license_scan"].collect()}
    assert len(got) == len(documents)
    stated = 0
    for r in documents:
        low, best = (r.text or "").lower(), None
        if any(re.search(rf"(?<![a-z0-9]){re.escape(a)}(?![a-z0-9])", low) for a in space.anchors):
            for unit in units_of(low, space):
                x = {t: (1 + math.log(c)) * space.idf.get(t, space.unknown) for t, c in Counter(re.findall(licenses.TOKEN, unit)).items()}
                norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
                score, name = min((-round(sum(v * x.get(t, 0.0) for t, v in vec.items()) / norm, 9), n) for vec, n in zip(space.vectors, space.names, strict=True))
                if score <= -0.75:
                    key = (name == licenses.RESERVED, score, name)
                    best = key if best is None or key < best else best
        assert got[r.doc_id].stated == (best and best[2]), r.doc_id
        stated += best is not None
    assert stated


def test_clashing_columns(spark):
    """Columns that operators name inside, on every table that they take."""
    docs = [(i, f"word{i % 4} and more words here {i}", ["en", "de"][i % 2], f"s{i % 3}") for i in range(40)]
    names = ["l", "c", "id", "gone", "mix", "copy", "here", "row", "text2", "label", "size", "h", "score", "bucket", "salts", "keep", "_metadata", "w", "range", "some"]
    extra = [F.lit("x").alias(n) for n in names]
    base = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    odd = base.select("*", *extra)
    plain = lambda df: sorted(map(repr, df.collect()))
    f = langid.fit(odd, F.col("doc_id") >= 0)
    assert plain(langid.predicted(odd, f).select("doc_id", "prediction")) == plain(langid.predicted(base, langid.fit(base, F.col("doc_id") >= 0)).select("doc_id", "prediction"))
    for keep in (lambda df: exact.kept_rows(spark, df), neardup.kept_rows, mixing.apply_mix):
        out = keep(odd)
        assert out.columns == odd.columns and plain(out.select(base.columns)) == plain(keep(base)) and all(r[n] == "x" for r in out.limit(3).collect() for n in names)
    assert plain(mixing.mix_sizes(odd)) == plain(mixing.mix_sizes(base))
    assert plain(tokens.count_tokens(odd, public_tokenizers.path("byte_bpe_50k.json"))) == plain(tokens.count_tokens(base, public_tokenizers.path("byte_bpe_50k.json")))
    assert plain(licenses.scan(odd, F.col("source"))) == plain(licenses.scan(base, F.col("source")))
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)], "doc_id long, quality int, text string")
    assert plain(quality.scored(odd, quality.fit(odd, labels), as_col="p").select("doc_id", "p")) == plain(quality.scored(base, quality.fit(base, labels.drop("text")), as_col="p").select("doc_id", "p"))
    turns = spark.createDataFrame([(1, 0, "user", "a b"), (1, 1, "assistant", "c")], "conv_id long, turn long, role string, text string")
    clash = turns.select("*", *[F.lit(1).alias(n) for n in ("tokens", "body", "block", "key", "span", "window", "end", "system")])
    assert plain(chat.format_windows(clash)) == plain(chat.format_windows(turns))
    vectors = spark.createDataFrame([(i, [1.0 * i, 2.0]) for i in range(6)], "vec_id long, embedding array<double>")
    assert plain(topk.quantised(vectors.withColumns({"id": F.lit(0), "v": F.lit(1), "weights": F.lit(2)}))) == plain(topk.quantised(vectors))


def test_repeated_rows_and_long_texts(spark):
    long = " ".join(f"w{i % 5003}" for i in range(60_000))
    rows = [(1, "der hund und die katze", "de"), (1, "der hund und die katze", "de"), (2, "the dog and the cat", "en"), (3, long, "en"), (4, "Released under the MIT License.\n" + long, "en"), (4, "Released under the MIT License.\n" + long, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.predicted(docs, langid.fit(docs)).select("doc_id", "prediction.lang").collect()
    assert sorted(r.doc_id for r in out) == [1, 1, 2, 3, 4, 4] and {r.lang for r in out if r.doc_id == 1} == {"de"}
    scores = quality.scored(docs, quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0), (2, 1)], "doc_id long, quality int"), n_features=16)).collect()
    assert len(scores) == 6 and len({r.score for r in scores if r.doc_id == 4}) == 1
    scan = licenses.scan(docs, F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("/f.txt"))).collect()
    assert sorted((r.id, r.stated) for r in scan) == [(1, None), (1, None), (2, None), (3, None), (4, "MIT"), (4, "MIT")]
    turns = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_windows(turns)).first()
    assert back.n_turns == 3 and back.loss_text == long + long
    v = topk.quantised(spark.createDataFrame([(50, [1.0]), (50, [1.0]), (7, [2.0]), (7, [2.0]), (8, [0.5] * 3000)], "vec_id long, embedding array<double>"))
    got = topk.top_k(v, v.filter("id = 50")).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in got] == [(1, 7, 512 * 256), (2, 7, 512 * 256), (3, 8, 128 * 256)]


def test_chat_by_a_vocabulary(spark):
    turns = [(1, i, ["user", "assistant"][i % 2], "x" * (40 * (i % 5 + 1))) for i in range(60)]
    table = spark.createDataFrame([(*t, len(t[3]) // 4 if t[1] % 7 else None) for t in turns], "conv_id long, turn long, role string, text string, n long")
    w = chat.format_windows(table, budget=200, history=50, tokens_col="n").collect()
    assert len(w) > 5 and all(not r.over_budget for r in w) and chat.read_back(spark.createDataFrame(w)).first().n_turns == 60
    words = chat.format_windows(table, budget=200, history=50).collect()
    assert len(words) < len(w)
    system = [(1, 0, "system", "s " * 250), *[(1, i, "user", "u") for i in range(1, 5)]]
    big = chat.format_windows(spark.createDataFrame(system, "conv_id long, turn long, role string, text string"), budget=200).collect()
    assert len(big) == 5 and all(r.over_budget for r in big)  # no room beside the system turn: a window a turn


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_packing_of_other_vocabularies(spark, name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    texts = ["Hello World. ok", "ALL CAPS!  two  spaces\n\n end", "naïve CAFÉ İstanbul", "<|endoftext|>x <|startoftext|>", "don't.", "  lead", "", None, "a　b\x1cc."]
    out = packing.pack_harmonic(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), public_tokenizers.path(name), capacity=8).collect()
    for i, x in enumerate(texts):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r.start, r.length, r.ids_crc32) for r in out if r.doc_id == i)
        assert [(a, n, zlib.crc32(ids[a : a + n].tobytes())) for a, n, _ in pieces] == pieces and sum(n for _, n, _ in pieces) == len(ids)


def test_chunks_are_whole_pre_tokens():
    split = tokens.PreTokens(["<|endoftext|>"])
    rng = random.Random(5)
    parts = ["a", "bc", "É", "12", "!", "'s", "'", " ", "  ", "   ", "\n", "\n \n", "\t", "　", "\x1c", "\xa0", "\r\n", "_", "日本"]
    for _ in range(4000):
        x = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        chunks = split.chunks(x)
        assert "".join(chunks) == x and [t for c in chunks for t in split.find(c)] == split.find(x), repr(x)


def test_tokens_of_texts_without_single_spaces(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["  ".join(f"w{i}" for i in range(3000)), "日本語" * 3000, "x" * 20_000, "\n".join(f"  x{i} =  y{i}" for i in range(500))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for head in (50, 300_000):
        out = {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), head=head).collect()}
        assert out == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}


def test_mixing_with_a_source_per_host(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', CAST(id % 5 + 1 AS INT))").alias("text"), F.concat(F.lit("h"), (F.col("id") % 900).cast("string")).alias("source"))
    out = mixing.mix_sizes(docs)
    g = out.groupBy("source_size", "target").count()
    assert out.count() == 3000 and g.filter("target > 2 * source_size + 1e-6").isEmpty()
    by = docs.join(out, "doc_id").groupBy("source").agg(F.first("source_size").alias("s"), F.first("target").alias("t"), F.sum("taken").alias("n")).collect()
    ranked = sorted(by, key=lambda r: r.source)
    left, budget, want = {r.source: [5, 2, 1][i % 3] for i, r in enumerate(ranked)}, 1.5 * sum(r.s for r in by), {}
    size = {r.source: r.s for r in by}
    while left:
        each = budget / sum(left.values())
        over = [s for s in left if each * left[s] > 2 * size[s]]
        if not over:
            want |= {s: each * w for s, w in left.items()}
            break
        for s in over:
            want[s], budget = 2 * size[s], budget - 2 * size[s]
            del left[s]
    assert all(r.t == pytest.approx(want[r.source]) and abs(r.n - r.t) <= 5 for r in by)


def brute_components(rows, share, width=5):
    sets = {i: {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if (w := t.lower().split()) else set() for i, t in rows}
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and share[1] * len(sets[a] & sets[b]) >= share[0] * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_wide_buckets(spark):
    """One passage that many unlike texts share, and a large group whose members miss the first hub."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([*passage, *[f"u{i}x{rng.randrange(10**6)}" for _ in range(rng.randrange(8, 40))]])) for i in range(120)]
    base = [f"b{i}" for i in range(160)]
    for i in range(60):
        edited = list(base)
        for _ in range(rng.randrange(0, 5)):
            edited[rng.randrange(len(edited))] = f"e{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    label = brute_components(rows, (85, 100))
    for how in ({"direct": 0, "wide": 10}, {"direct": 0, "wide": 10, "rehubs": 0}, {"per_set": 2, "block": 9}):
        out = {r.doc_id: r.component_id for r in neardup.near_groups(docs, neardup.Plan(**how)).collect()}
        assert out == label, how


def test_pipeline_of_odd_documents(spark, tmp_path):
    long = " ".join(f"w{i % 4001}" for i in range(30_000))
    good = [f"this is document number {i} about thing {i * 7} and its story {i * 13}." for i in range(30)]
    rows = [*enumerate(good), (100, None), (101, ""), (102, long), (103, good[3]), (103, good[3]), (None, "no id at all in this one"), (104, good[4].upper())]
    docs = spark.createDataFrame([(i, t, "en" if i else None, None if i == 7 else "s", 1, "x", "y") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, gone string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {r.doc_id for r in out}
    assert 103 not in kept and 104 not in kept and kept <= {i for i, _ in rows}
    spans = defaultdict(list)
    for r in out:
        spans[r.sequence_id].append((r.offset, r.length))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_run_gives_what_its_stages_give(spark):
    """run() against the stages called one by one on stored tables: the same documents, as often, in whole pieces."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{os.environ.get('TMPDIR', '/tmp')}/lotweave-run-{os.getpid()}-{i}"
        stage(spark, docs, SF).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    piece = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    sums = lambda rows: Counter({k: sum(r.length for r in rows if r.doc_id == k) for k in {r.doc_id for r in rows}})
    ran, staged = corpus_pipeline.run(spark, SF).collect(), docs.collect()
    assert sums(ran) == sums(staged) and {(r.doc_id, r.doc_tokens) for r in ran} == {(r.doc_id, r.doc_tokens) for r in staged}
    assert len(set(map(piece, ran))) > 0
