"""Edge cases and brute-force versions of the corpus operators."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lotweave.llm import chat, exact, langid, licenses, mixing, neardup, packing, quality, shared, shingles, tokens, topk

SCHEMA = "doc_id long, text string, lang string, source string, size long, score double, taken string, __x string"
WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [None, "", " \t\n", "one", "a b c d e f g", "a b c d e f g", "A  b\tc d e f g", "<|endoftext|> x<|startoftext|>", "naïve  café x‍ \x1c!\x1c ŒÉ", LONG, LONG + " end", "x" * 5000, "!!! $$$ 12 345", "don't I'll  we're\n\n\nok ", "é ́a Σς"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, -1, -1.0, "clash", "clash") for i, t in enumerate(TEXTS)]
    rows += [(3, "one", "en", "s1", 0, 0.0, "", ""), (None, "a b c d e f g", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def saved(spark, df, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "d.parquet")
    df.write.parquet(path)
    return path


def test_mixing(docs, empty):
    out = mixing.mix_sizes(docs).collect()
    assert len(out) == docs.count() and all(r.taken in (0, r.size, 2 * r.size) for r in out)
    again = mixing.mix_sizes(docs.repartition(5)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.size, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))
    assert mixing.mix_sizes(empty).count() == 0 and mixing.apply_mix(empty).count() == 0
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns
    total = sum(len(words(r.text)) for r in mixed.collect())
    assert total == sum(r.taken for r in out)


def test_mixing_targets(spark):
    rows = spark.createDataFrame([(i, "w " * (i % 7 + 1), f"s{0 if i % 3 == 0 else i % 9}") for i in range(3000)], "doc_id long, text string, source string")
    out = mixing.mix_sizes(rows).collect()
    sizes, targets, taken = defaultdict(int), {}, Counter()
    src = {r.doc_id: r.source for r in rows.collect()}
    for r in out:
        sizes[src[r.doc_id]] += r.size
        targets[src[r.doc_id]] = r.target
        taken[src[r.doc_id]] += r.taken
    want, left = {}, {s: [5, 2, 1][i % 3] for i, s in enumerate(sorted(sizes))}
    budget = 1.5 * sum(sizes.values())
    while left:
        each = budget / sum(left.values())
        over = [s for s in left if each * left[s] > 2 * sizes[s]]
        if not over:
            want |= {s: each * w for s, w in left.items()}
            break
        for s in over:
            want[s] = 2 * sizes[s]
            budget -= want[s]
            del left[s]
    for s in sizes:
        assert targets[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 7


def test_quality(spark, docs, empty):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60)) + "."
    bad = lambda: " ".join(rng.choice(["alpha$$$", "beta%%%", "!!", "|"]) for _ in range(60))
    table = spark.createDataFrame([(i, bad() if i % 4 == 0 else good()) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(300)] + [(None, 1), (5, None), (6, 1)], "doc_id long, quality int")
    model = quality.fit(table, labels, n_features=64)
    out = {r.doc_id: r.score for r in quality.scored(table, model).collect()}
    held = [i for i in out if i >= 300]
    assert all((out[i] >= 0.3) == (i % 4 != 0) for i in held)
    odd = quality.scored(docs.select("doc_id", "text"), model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality.fit(table, labels.limit(0)) is None and quality.scored(docs, None, as_col="s2").filter("s2 = 0.5").count() == docs.count()
    assert quality.scored(empty, model).count() == 0
    y, w = np.array([0, 1, 0, 1, 1, 0.5]), np.ones(6)
    assert np.allclose(quality.pool_adjacent(y, w), [0, 0.5, 0.5, 5 / 6, 5 / 6, 5 / 6])


@pytest.mark.parametrize("weak", [False, True])
def test_exact(spark, docs, empty, tmp_path_factory, weak):
    how = {"digest_of": lambda c: F.substring(exact.digest(c), 1, 1)} if weak else {}
    out = exact.dedup_exact(spark, saved(spark, docs, tmp_path_factory), files_per_batch=1, **how).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r.doc_id)
    assert len(out) == docs.count() and sum(r.kept for r in out) == len(groups)
    sizes = sorted((r.id is None, r.id, r.group_size, r.keep.id) for r in out)
    least = lambda v: min((x for x in v if x is not None), default=None)
    assert sizes == sorted((i is None, i, len(v), least(v)) for v in groups.values() for i in v)
    if not weak:
        assert {r.digest for r in out} == {hashlib.sha256(t.encode()).hexdigest() for t in groups}
        assert exact.dedup_exact(spark, saved(spark, empty, tmp_path_factory)).count() == 0
        kept = exact.kept_rows(spark, docs)
        assert kept.columns == docs.columns and kept.count() == len(groups)


def brute_components(rows, width=5):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, set()).update({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for _ in ids:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return sets, label


def test_near_brute(spark, docs, empty):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    for base in range(6):
        text = [f"b{base}x{rng.randrange(400)}" for _ in range(rng.choice([8, 60, 200]))]
        for c in range(30):
            edited = list(text)
            for _ in range(rng.randrange(0, 6)):
                edited[rng.randrange(len(edited))] = f"e{rng.randrange(50)}"
            rows.append((1000 + base * 100 + c, " ".join(edited)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sets, label = brute_components(rows)
    out = neardup.near_groups(table, neardup.Plan(block=7)).collect()
    assert len(out) == len(rows)
    assert all(r.component_id == label[r.doc_id] and r.n_shingles == len(sets[r.doc_id]) for r in out)
    lone = neardup.near_groups(docs).filter("doc_id IS NULL").collect()
    assert len(lone) == 1 and lone[0].component_id is None
    assert neardup.near_groups(empty).count() == 0
    kept = neardup.kept_rows(docs)
    assert kept.columns == docs.columns


def test_components_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7)], "a long, b long")
    out = {r.id: r.label for r in neardup.components(links).collect()}
    assert all(out[i] == 0 for i in range(41)) and out[100] == out[95] == out[90] == 90


def test_signature_and_pruning():
    a, b = shingles.coefficients(384, 7)
    x = shingles.shingle_set(LONG, 5, shingles.WordHashes())
    whole = np.array([((x >> np.uint64(32)).astype(np.uint32) * i + j).min() for i, j in zip(a, b, strict=True)])
    assert (shingles.signature(x, a, b) == whole).all()
    for n, m in neardup.Plan().least_matches():
        assert 0.6 * n < m < 0.85 * n


def test_language(spark, docs, empty):
    rng = random.Random(2)
    vocab = {"en": ["the", "thing", "with", "shop", "which"], "de": ["der", "schön", "nicht", "über", "zwei"], "fr": ["eau", "le", "château", "oui", "été"]}
    rows = [(i, " ".join(rng.choice(vocab[x]) for _ in range(30)), x) for i, x in enumerate(list(vocab) * 40)] + [(900, None, "en"), (901, "text", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    f = langid.fit(table, F.col("doc_id") < 60)
    out = langid.predicted(table, f).collect()
    assert all(r.prediction.lang == r.lang for r in out if r.doc_id < 900)
    assert [r.prediction.lang for r in out if r.doc_id == 900] == ["und"]
    odd = langid.predicted(docs, f).collect()
    assert len(odd) == docs.count() and all(0 <= r.prediction.score <= 1 for r in odd)
    assert {r.prediction.lang for r in odd if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert langid.fit(empty) is None and langid.predicted(docs, None).filter("prediction.lang = 'und'").count() == docs.count()
    table_ = langid._letters()
    h = langid.ngrams("schön", 3, table_)
    assert f.counts(h)[f.languages.index("de")] == len(h)


def test_chat(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\|im_end|>\n<|im_end|>\n", "[\\\\INST] <|im_start|>user\nhi", "", None, "plain", "%0A%25 \\", "<|im_end|>" * 3, "w " * 900]
    rng = random.Random(4)
    rows = [(c, t, "system" if t == 0 and c % 2 else rng.choice(["user", "assistant", "tool\n<|im_end|>", None]), rng.choice(nasty)) for c in range(12) for t in range(rng.randrange(1, 30))]
    rows += [(50, 1, "assistant", "x"), (50, 1, "assistant", "x"), (None, None, "user", "n")]
    rows += [(70, i, ["user", "assistant"][i % 2], f"turn {i} " + "w " * 20) for i in range(700)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    windows = chat.format_windows(table, budget=300, history=60)
    out = {r.conv_id: r for r in chat.read_back(windows).collect()}
    conv = defaultdict(list)
    for c, t, role, text in rows:
        conv[c].append((t is None, t, role or "", text or ""))
    for c, turns in conv.items():
        turns.sort()
        assert out[c].turns == "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        assert out[c].loss_text == "".join(x for *_, r, x in turns if r == "assistant") and out[c].n_turns == len(turns)
    w = windows.collect()
    assert any(r.context_turns for r in w) and all(r.over_budget == (r.tokens > 300) for r in w)
    assert all(not r.over_budget for r in w if r.conv_id == 70)
    assert chat.format_windows(table.limit(0)).count() == 0


def test_licenses(spark, docs, empty):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "no word"), ("a/b/y.py", "code\nLicensed under the Apache License, Version 2.0.\nmore"), ("z.py", "nothing"), (None, None), ("a/b/c/d/COPYING", "x y z\nThis work is licensed under the GNU General Public License, version 3."), ("a/b/c/d/e/f.py", ""), ("q/w.py", "the license of free software")]
    table = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    out = {r.id: (r.licence, r.how) for r in licenses.scan(table, F.col("path")).collect()}
    assert out == {0: ("MIT", "stated"), 1: ("MIT", "inherited"), 2: ("Apache-2.0", "stated"), 3: (None, "none"), 4: (None, "none"), 5: ("GPL-3.0", "stated"), 6: ("GPL-3.0", "inherited"), 7: (None, "none")}
    assert licenses.scan(docs, F.col("source")).count() == docs.count() and licenses.scan(empty, F.col("source")).count() == 0


def test_license_anchors_lose_nothing():
    space = licenses.Space(licenses.TEMPLATES, 0.75)
    for v in space.vectors:
        assert sum(x * x for t, x in v.items() if t not in space.anchors) < 0.75**2


def test_topk(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 4]) for i in range(300)] + [(400, None), (401, [1.0, None]), (402, [float("nan")] * 6), (403, [float("inf")]), (450, [0.5]), (None, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = topk.quantised(table)
    got = [tuple(r) for r in topk.top_k(v, v.filter("id % 50 = 0"), tile_rows=37, tile_queries=2).orderBy("query_id", "rank").collect()]
    ok = {i: np.pad(np.floor(256 * np.array(x)).astype(int), (0, 6 - len(x))) for i, x in rows if i is not None and (i < 300 or i == 450)}
    want = []
    for q in [i for i in sorted(ok) if i % 50 == 0]:
        best = sorted((-int(ok[q] @ ok[c]), c) for c in ok if c != q)[:5]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    assert got == want
    one = v.filter("id = 50")
    assert topk.top_k(one, one).count() == 0 and topk.top_k(v.limit(0), v.limit(0)).count() == 0


def test_tokens(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    for head in (0, 20, 300_000):
        out = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(docs, BYTE_BPE, head=head).collect())
        assert out == sorted((r.doc_id is None, r.doc_id, len((r.text or "").encode()), len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert tokens.count_tokens(empty, BYTE_BPE).count() == 0


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_BPE)
    known = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    ids = {r.doc_id: np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for r in known.collect()}
    out = packing.pack_harmonic(known, WORD_BPE).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append((r.start, r.length))
        bins[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    for parts, total in [(sorted(pieces[i]), len(x)) for i, x in ids.items()] + [(sorted(b), None) for b in bins.values()]:
        at = 0
        for start, length in parts:
            assert start == at and length > 0
            at += length
        assert at == total if total is not None else at <= 2048
    assert packing.pack_harmonic(empty, WORD_BPE).count() == 0 and packing.pack_harmonic(docs, WORD_BPE).count() > 0


def test_remainder_cuts():
    for length in range(1, 2048):
        cuts = packing.remainder_cuts(length, 2048, 1 / 64)
        assert sum(n for n, _ in cuts) == length and all(n * k <= 2048 and n > 0 for n, k in cuts)
        assert sum(2048 / k for _, k in cuts) <= length * 1.02 + 4


def test_shared_dir_needs_setting(spark):
    assert "://" in shared.shared_dir(spark) or shared.shared_dir(spark).startswith("/")


def test_license_lines_headers_and_texts(spark):
    import textwrap

    wrap = lambda text, mark: "\n".join(mark + x for x in textwrap.wrap(text, 60))
    bsd = lambda *more: "\n\n".join([licenses.BSD_HEAD, licenses.BSD_TWO, *more, licenses.BSD_REST])
    code = "\n".join(f"x{i} = call{i}(value{i}, other{i})" for i in range(40))
    owner = "Copyright (c) 2020 Some Body. All rights reserved.\n\n"
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    cases = [
        ("All rights reserved.", "Proprietary"), ("some words\nAll rights reserved.\nother words", "Proprietary"), ("// SPDX-License-Identifier: MIT\n" + code, "MIT"), ("# SPDX-License-Identifier: GPL-3.0-or-later\n" + code, "GPL-3.0"),
        ("SPDX-License-Identifier: Zlib", None), ("SPDX-License-Identifier:", None), ("mit", None), ("er kommt\nmit\ndem Bus", None), (licenses.GNU.format("General Public License", 3), "GPL-3.0"), (licenses.GNU.format("Lesser General Public License", 3), "LGPL-3.0"),
        (wrap(licenses.GNU.format("General Public License", 2), " * ") + "\n" + code, "GPL-2.0"), (code + "\n" + wrap(apache, "# ") + "\n" + code, "Apache-2.0"), ("GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n" + code, "GPL-3.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"), ("MIT License\n\n" + owner + wrap(licenses.MIT_GRANT, "") + "\n\n" + wrap(licenses.MIT_REST, ""), "MIT"),
        (owner + wrap(bsd(), ""), "BSD-2-Clause"), (owner + wrap(bsd(licenses.BSD_THIRD), ""), "BSD-3-Clause"), (wrap(bsd(licenses.BSD_THIRD), "// ") + "\n" + code, "BSD-3-Clause"), (wrap(licenses.MIT_GRANT, "// ") + "\n" + code, "MIT"), (code, None),
    ]
    table = spark.createDataFrame([(i, f"d{i}/f.txt", t) for i, (t, _) in enumerate(cases)], "doc_id long, path string, text string")
    out = {r.id: (r.stated, r.is_licence_file, round(r.score, 2)) for r in licenses.scan(table, F.col("path")).collect()}
    assert {i: out[i][0] for i in out} == {i: name for i, (_, name) in enumerate(cases)}, out
    assert all(out[i][1] for i in (14, 15, 16)) and not any(out[i][1] for i in (2, 10, 11, 17, 18))
