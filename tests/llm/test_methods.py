"""Operators against brute force."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import ann, decontaminate, language_id, license_scan, near_dedup, quality, token_counts, toxicity

SMALL = "/root/testdata/sf0.001"


def table(spark, texts, **more):
    names = ["doc_id long", "text string", *(f"{k} {v[0]}" for k, v in more.items())]
    return spark.createDataFrame([(i, t, *(v[1](i) for v in more.values())) for i, t in texts], ", ".join(names))


# ---- language ID


def test_decoding_takes_the_codeword_of_least_loss(spark):
    langs = ["aa", "bb", "cc"]
    words = {"aa": ["rota", "mola", "tira"], "bb": ["shkin", "wrekt", "zhdur"], "cc": ["ueio", "oaiu", "eaou"]}
    rng = random.Random(3)
    docs = table(spark, [(i, " ".join(rng.choices(words[langs[i % 3]], k=12))) for i in range(60)], lang=("string", lambda i: langs[i % 3]))
    model = language_id.learn(docs, F.col("doc_id") % 4 != 1)
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    counts, letters = language_id.ngram_counts(texts)
    assert letters.tolist() == [sum(c.isalpha() for c in t) for t in texts]
    labels, score, gap = model.decode(counts, letters)
    for x, got, s in zip(counts, labels, score):
        margins = [4 * sum(x[c] * model.odds[c, b] for c in np.flatnonzero(x)) / x.sum() for b in range(model.codes.shape[1])]
        losses = [sum(model.weights[k, b] * np.exp(-model.codes[k, b] * margins[b]) for b in range(len(margins))) for k in range(3)]
        assert got == model.labels[int(np.argmin(losses))] and 0 <= s <= 1
    assert labels == [langs[i % 3] for i in range(60)]


def test_ngrams_of_many_short_texts_are_those_of_each(spark):
    texts = [f"wort{i} und {i}" for i in range(300)]
    whole, _ = language_id.ngram_counts(texts)
    assert all((whole[i] == language_id.ngram_counts([texts[i]])[0][0]).all() for i in (0, 1, 127, 128, 299))


# ---- token counts


@pytest.fixture(scope="module")
def counter():
    import public_tokenizers

    return token_counts.PrefixCounter(public_tokenizers.path("piece_bpe_32k.model"))


def test_every_prefix_counts_as_the_library_counts_it(counter):
    rng = random.Random(7)
    alphabet = ["the ", "ing", "token", "  ", "\n", "é", "中", "文", "😀", "▁", "-", "1234", "under", "standing", " a", "zzzz", "\t", "<s>"]
    for _ in range(60):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 25)))
        found = counter.every_prefix(text)
        assert found.tolist() == [len(counter.sp.encode(text[:j])) for j in range(len(text) + 1)], text
        for budget in (0, 1, 5, 12):
            assert counter.longest(text, budget) == max(j for j in range(len(text) + 1) if found[j] <= budget), (text, budget)


def test_long_texts_without_blanks_take_one_pass(counter):
    text = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz0123456789", k=4000))
    found = counter.every_prefix(text)
    assert [int(found[j]) for j in (1, 17, 999, 4000)] == [len(counter.sp.encode(text[:j])) for j in (1, 17, 999, 4000)]
    assert max(map(len, counter.memo)) <= token_counts.MEMO_CHARS


def test_truncate_keeps_the_longest_prefix_within_the_budget(spark, counter):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [(1, "A sentence of several words, understandable."), (2, None), (3, ""), (4, "short"), (5, "中文字符没有空格"), (5, "中文字符没有空格")]
    docs = table(spark, texts)
    for r in token_counts.truncate(docs, path, 4).collect():
        whole = dict(texts)[r["doc_id"]] or ""
        best = max(j for j in range(len(whole) + 1) if len(counter.sp.encode(whole[:j])) <= 4)
        assert r["text"] == whole[:best] and r["n_tokens"] == len(counter.sp.encode(whole))
    rows = token_counts.count_tokens(docs, path, cuts=True).collect()
    assert all(n == len(counter.sp.encode((dict(texts)[r["doc_id"]] or "")[:at])) for r in rows for at, n in zip(r["cut_chars"], r["cut_tokens"]))


# ---- quality


def test_forward_backward_against_all_label_sequences():
    rng = np.random.default_rng(2)
    lengths, move = np.array([4, 1, 6, 6, 2]), rng.normal(size=(2, 2))
    e = rng.normal(size=lengths.sum())
    packed = quality.Packed(lengths)
    good, pairs, log_z = quality.forward_backward(e[packed.rows], move, packed)
    back = np.zeros(len(e))
    back[packed.rows] = good
    both = np.zeros((len(e), 2, 2))
    both[packed.rows] = pairs
    at, total = 0, 0.0
    for n in lengths:
        weights, marginal, joint = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(e[at + i] * y for i, y in enumerate(labels)) + sum(move[a, b] for a, b in zip(labels, labels[1:])))
            weights += w
            marginal += w * np.array(labels)
            for i, (a, b) in enumerate(zip(labels, labels[1:]), 1):
                joint[i, a, b] += w
        assert back[at : at + n] == pytest.approx(marginal / weights)
        assert both[at + 1 : at + n] == pytest.approx(joint[1:] / weights)
        total += np.log(weights)
        at += n
    assert log_z == pytest.approx(total)


def test_of_too_many_languages_those_of_most_rows_are_learned(spark):
    langs = ["aa"] * 5 + ["bb"] * 3 + ["cc"] * 3 + ["dd"]
    docs = table(spark, [(i, f"words of {lang} number {i}") for i, lang in enumerate(langs)], lang=("string", lambda i: langs[i]))
    model = language_id.learn(docs, F.lit(True), languages=2)
    assert model.labels == ["aa", "bb"]
    assert {r["lang_pred"] for r in language_id.predict(docs, model).collect()} <= {"aa", "bb"}


# ---- toxicity


def test_nearest_examples_against_all_products():
    rng = np.random.default_rng(4)
    words = [f"w{i}".encode() for i in range(400)]
    texts = [b" ".join(rng.choice(words, size=rng.integers(1, 60), p=np.arange(400, 0, -1) / 80200)) for _ in range(700)] + [b"", b"unknown terms"]
    texts[5] = texts[9] = texts[300]  # equal examples: ties by id
    texts[7] += b" " + b" ".join(b"unknown%d" % i for i in range(50))
    model = toxicity.Model({w: 1 + i / 100 for i, w in enumerate(words)})
    ids, labels = rng.permutation(10_000)[: len(texts)], (np.arange(len(texts)) % 7 == 0).astype(float)
    model.class_weight = (1.0, 1.0)
    x = model.vectors(texts)
    model.index(ids, x, labels)
    dense = np.zeros((len(texts), 400))
    dense[x[0], x[1]] = x[2]
    for i, text in enumerate(texts):  # lengths are those of whole texts; terms that the index lacks weigh 1
        counts = Counter(text.split())
        whole = {w: (1 + np.log(c)) * (1 + words.index(w) / 100 if w in words else 1) for w, c in counts.items()}
        length = np.sqrt(sum(v * v for v in whole.values()))
        for w in whole.keys() & set(words):
            assert dense[i, words.index(w)] == pytest.approx(whole[w] / length)
    assert (dense[7] ** 2).sum() < 0.999
    asked = slice(0, 128)
    part = tuple(v[x[0] < 128] for v in x)
    for skip in (None, ids[asked]):
        best, place = model.nearest(128, part, 25, skip)
        for i in range(128):
            sims = np.round(dense @ dense[i], 9)
            if skip is not None:
                sims[ids == skip[i]] = -1
            order = [j for j in np.lexsort((ids, -sims)) if sims[j] > 1e-9][:25]
            assert model.ids[place[i][place[i] >= 0]].tolist() == ids[order].tolist()
            assert best[i][place[i] >= 0] == pytest.approx(sims[order], abs=1e-8)


def test_votes_against_products():
    rng = np.random.default_rng(6)
    words = [b"w%d" % i for i in range(80)]
    texts = [b" ".join(rng.choice(words, 12)) for _ in range(200)] + [b"", b"nothing known"]
    relevance, labels = rng.random(80), (rng.random(202) < 0.3).astype(float)
    model = toxicity.Model({w: 1.5 for w in words})
    model.class_weight = (0.5, 2.0)
    x = model.vectors(texts)
    model.index(np.arange(202), x, labels, relevance)
    dense = np.zeros((202, 80))
    dense[x[0], x[1]] = x[2]
    place = model.nearest(202, x, 7)[1]
    weight = model.weights_of(x, place)
    for i in range(200):
        near = model.ids[place[i]]
        assert weight[i] == pytest.approx(((dense[near] * dense[i]) @ relevance) ** 2 * np.where(labels[near] == 1, 2.0, 0.5), rel=1e-5)
    votes = model.votes(weight, place)
    assert votes[:200] == pytest.approx((weight * labels[model.ids[place]]).sum(1)[:200] / weight.sum(1)[:200], abs=1e-6)
    assert votes[200] == votes[201] == model.base


def test_equal_votes_are_one_point_whatever_their_order():
    votes, labels = np.array([0.1, 0.5, 0.5, 0.5, 0.9, 0.9]), np.array([0.0, 1.0, 0.0, 0.0, 1.0, 1.0])
    points = toxicity.isotonic(votes, labels, np.ones(6))
    assert [v.tolist() for v in points] == [[0.1, 0.5, 0.9], [0.0, pytest.approx(1 / 3), 1.0]]
    for order in ([5, 3, 1, 0, 2, 4], [2, 1, 3, 4, 5, 0]):
        assert all(np.array_equal(a, b) for a, b in zip(points, toxicity.isotonic(votes[order], labels[order], np.ones(6))))


def test_blocks_under_the_bound_are_not_read(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(toxicity, "BLOCK", 32)
    monkeypatch.setattr(toxicity, "DENSE", 0)
    topics, pool = [[b"t%dw%d" % (g, i) for i in range(25)] for g in range(20)], [b"w%d" % i for i in range(40)]
    texts = [b" ".join([*rng.choice(topics[i % 20], 20, replace=False), *rng.choice(pool, 6)]) for i in range(2_000)]
    model = toxicity.Model({w: 2.0 for g in [*topics, pool] for w in g})
    x = model.vectors(texts)
    model.index(np.arange(2_000), x, np.zeros(2_000))
    read = []
    expanded = toxicity._expanded
    monkeypatch.setattr(toxicity, "FIRST", 1)
    monkeypatch.setattr(toxicity, "_expanded", lambda a, b: read.append(int((b - a).sum())) or expanded(a, b))
    best, place = model.nearest(64, tuple(v[x[0] < 64] for v in x), 10)
    dense = np.zeros((2_000, 540))
    dense[x[0], x[1]] = x[2]
    full = dense[:64] @ dense.T
    assert best[:, 9] == pytest.approx(np.sort(full, 1)[:, -10])
    assert sum(read[1:]) < 0.8 * (((dense[:64] > 0) * (dense > 0).sum(0)).sum(0) * (model.row < 0)).sum()


def test_example_bytes_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LONGEST", 1_000)
    monkeypatch.setattr(toxicity, "BYTES", 500)
    docs = table(spark, [(i, "word " * (1_000 if i == 3 else 20)) for i in range(40)])
    told = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    rows = toxicity.examples(docs, told, F.lit(True), 100).collect()
    assert [sum(r["label"] == c for r in rows) for c in (0, 1)] == [5, 5] and 3 not in {r["doc_id"] for r in rows}


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0), (2, 0)], [(1, None), (2, 3)], [(4, 0), (5, 1)]])
def test_toxicity_without_usable_examples(spark, labels):
    docs = table(spark, [(1, "some text"), (2, "other text"), (3, None), (4, ""), (5, "..."), (None, "text")])
    told = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, told, F.lit(True))
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)


# ---- near duplicates


def _bag(text):
    words = text.lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def _classes(texts, least=0.8):
    bags, root = [_bag(t) for t in texts], list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sum((bags[i] & bags[j]).values()) >= least * sum((bags[i] | bags[j]).values()):
            root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(texts))]


@pytest.mark.parametrize("split", [4096, 8])
def test_a_large_group_of_near_copies_against_brute_force(spark, monkeypatch, split):
    monkeypatch.setattr(near_dedup, "SPLIT", split)
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = []
    for i in range(160):
        words = base.copy()
        for at in rng.sample(range(150), rng.choice([0, 1, 2, 3, 4, 6, 8])):
            words[at] = f"x{i}y{at}"
        texts.append(" ".join(words))
    texts += [" ".join(f"a{i}b{j}" for j in range(40)) for i in range(40)]
    texts += ["same line again and again " * 30, "same line again and again " * 31, "same line again and again " * 60, "", "  ", "short"]
    truth = _classes(texts)
    rows = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(table(spark, list(enumerate(texts)))).collect()}
    wrong = [i for i in range(len(texts)) if rows[i] != truth[i]]
    # every class found is part of a true one, and of the true links nearly all are met
    assert all(truth[rows[i]] == truth[i] for i in rows) and len(wrong) <= 2, wrong


def test_links_of_the_collision_buckets_are_all_found(spark):
    """Against all pairs that share a bucket: none with enough overlap is lost."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    made = near_dedup.signatures(docs).collect()
    bands, bags = {r["doc"]: r["bands"] for r in made}, {r["doc_id"]: _bag(r["text"] or "") for r in docs.collect()}
    buckets, root = {}, {d: d for d in bags}
    for d, keys in bands.items():
        for k in keys:
            buckets.setdefault(k, []).append(d)

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in {tuple(sorted(p)) for m in buckets.values() for p in itertools.combinations(m, 2)}:
        if sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
            root[max(top(a), top(b))] = min(top(a), top(b))
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    for a, b in ((a, b) for a in root for b in (top(a),) if a != b):
        assert found[a] == found[b]


# ---- decontamination


def _tiles(item, text, least):
    """Greedy string tiling by looking at every pair of places."""
    used_item, used_text, tiles = set(), set(), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and i + n not in used_item and j + n not in used_text:
                    n += 1
                if n >= least and (best is None or (-n, i, j) < best):
                    best = (-n, i, j)
        if best is None:
            return tiles
        n, i, j = -best[0], best[1], best[2]
        used_item.update(range(i, i + n))
        used_text.update(range(j, j + n))
        tiles.append((i, j, n))


@pytest.mark.parametrize("pairs", [1_000_000, 0])
def test_tiling_against_all_places(monkeypatch, pairs):
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    rng = random.Random(5)
    for k in range(25):
        few = ["a", "b", "c"] if k % 2 else [f"w{i}" for i in range(12)]
        item = rng.choices(few, k=24)
        text = rng.choices([*few, "z"], k=10) + item[10:] + ["z"] + item[:12] + rng.choices(few, k=8)
        index = decontaminate.SeedIndex([(1, " ".join(item).encode())], 3, 0.0)
        found = index.matches(" ".join(text).encode())
        expected = _tiles(item, text, 3)
        assert sum(n for *_, n in found[0][4]) == sum(n for *_, n in expected) and found[0][4][0] == expected[0]


def test_a_benchmark_in_several_passes_finds_the_same(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = lambda: sorted((r["doc_id"], r["item_id"], r["covered"]) for r in decontaminate.contaminated(docs, bench).collect())
    kept = lambda: sorted(r["doc_id"] for r in decontaminate.remove_contaminated(docs, bench).select("doc_id").collect())
    whole, left = rows(), kept()
    monkeypatch.setattr(decontaminate, "PASS_WORDS", 400)
    assert whole and rows() == whole and kept() == left


# ---- vector search


def _nearest(m, ids, q, k):
    s = m @ m[q]
    order = [j for j in np.lexsort((ids, -s)) if j != q][:k]
    return [int(ids[j]) for j in order]


@pytest.mark.parametrize("n", [10_000, 100_000])
def test_vector_search_at_two_sizes(spark, n):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(n // 100, 32))
    m = centres[rng.integers(0, len(centres), n)] + 0.4 * rng.normal(size=(n, 32))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(m.tolist())], "vec_id long, embedding array<double>").repartition(16)
    asked = list(range(0, n, n // 100))
    rows = ann.search(vectors, spark.createDataFrame([(q,) for q in asked], "query_id long")).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == asked and len(rows) == 20 * len(asked)
    hits = 0
    for q in asked:
        ranked = sorted(found[q])
        assert [r for r, *_ in ranked] == list(range(1, 21)) and all(a[2] >= b[2] for a, b in zip(ranked, ranked[1:]))
        hits += len({v for _, v, _ in ranked} & set(_nearest(m, np.arange(n), q, 20)))
    print("recall", n, hits / (20 * len(asked)))
    assert hits >= 0.95 * 20 * len(asked)


def test_vector_search_of_few_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5), 1.0, float(i)]) for i in range(30)] + [(40, None), (60, [0.0, 0.0, 0.0]), (80, [nan, 1.0, 1.0]), (100, [inf, 0.0, 1.0]), (120, [1.0, None, 2.0]), (140, [1.0]), (None, [1.0, 1.0, 1.0]), (20, [0.0, 1.0, 20.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("query_id", F.lit(1)).withColumn("cell", F.lit("x"))
    found = {}
    for r in ann.search(vectors, vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"))).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    m = np.array([v for i, v in rows[:30]])
    assert {q: [v[k] for k in sorted(v)] for q, v in found.items()} == {q: _nearest(m, np.arange(30), q, 20) for q in (0, 20)}
    few = vectors.filter("vec_id < 4")
    assert ann.search(few, few.filter("vec_id = 0").select(F.col("vec_id").alias("query_id"))).count() == 3
    assert ann.search(vectors.filter("vec_id < 0"), vectors.select(F.col("vec_id").alias("query_id"))).count() == 0


# ---- licenses


def test_wrapped_notices_are_found_wherever_they_stand(spark):
    notices = [t for t in license_scan.NOTICES if t.label not in ("mit", "cc-by", "apache", "gpl", "lgpl")]
    filler = "some other words that are in no notice at all and go on for a while "
    texts = []
    for i, t in enumerate(notices):
        words = t.text.split()
        wrapped = "\n".join(" ".join(words[j : j + 4]) for j in range(0, len(words), 4))
        texts.append((i, filler * (i % 5) + "\n" + wrapped.upper() + "\n\n" + filler))
    rows = {r["doc_id"]: {m["label"] for m in r["matches"] if m["kind"] == "notice"} for r in license_scan.scan_licenses(table(spark, texts)).collect()}
    assert all(t.label in rows[i] for i, t in enumerate(notices))
    plain = table(spark, [(1, "This work is licensed under a Creative Commons Attribution 4.0 International License."), (2, filler * 30), (3, None)])
    labels = {r["doc_id"]: sorted({m["label"] for m in r["matches"]}) for r in license_scan.scan_licenses(plain).collect()}
    assert labels == {1: ["cc-by"], 2: [], 3: []}


@pytest.mark.parametrize("text,labels", [
    ("Licensed under CC BY 4.0", {"cc-by"}), ("Licensed under CC BY-NC 4.0", {"cc-by", "cc-by-nc"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", {"cc-by-nc"}), ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", {"cc-by-nd"}),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"cc-by-sa"}), ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", {"cc-by-nc-sa"}),
    ("Licensed under the Apache License, Version 1.0", {"apache"}), ("Licensed under the Apache License, Version 2.0", {"apache", "apache-2.0"}), ("We nc by 4 cc 0 licensed words under here", set()),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", {"lgpl"}),
])
def test_no_label_of_another_license(spark, text, labels):
    """The phrase `cc by` is a base label wherever it stands."""
    found = license_scan.scan_licenses(table(spark, [(1, text), (2, "some words before " + text + " and behind")])).collect()
    assert [{m["label"] for m in r["matches"]} for r in found] == [labels, labels]


def test_blocks_against_counting_every_window():
    rng = random.Random(9)
    templates = [license_scan.Template(f"t{k}", " ".join(rng.sample([f"v{i}" for i in range(60)], n)), "notice", 0.7) for k, n in enumerate((3, 8, 9, 20, 30))]
    vocabulary = [f"v{i}".encode() for i in range(60)] + [b"other"] * 60
    index = license_scan.SimilarityIndex(templates, {w: rng.randrange(100) for t in templates for w in t.words})
    index.rivals, index.telling = [[] for _ in templates], [set() for _ in templates]
    for n in range(60):
        words = rng.choices(vocabulary, k=rng.randrange(0, 150))
        words[10:10] = templates[rng.randrange(5)].words[: None if n % 3 else -1]
        expected = set()
        for k, t in enumerate(templates):
            width, whole = index.width[k], set(t.words)
            for b in range(len(words) // width + 1):
                block = words[b * width : (b + 2) * width]
                shared = len(whole & set(block))
                stands = any(block[i : i + len(t.words)] == t.words for i in range(len(block)))
                if stands if len(t.words) < license_scan.SHORT else shared >= 0.7 * len(whole) - 1e-9:
                    expected.add((k, b, b * width, shared / len(whole)))
        assert set(index.notices(words)) == expected


def test_phrases_at_every_place(spark):
    rng = random.Random(2)
    words = ["mit", "license", "apache", "gnu", "general", "public", "cc", "by", "x", "1"]
    texts = [(i, rng.choice([" ", "\n", "-", "; "]).join(rng.choices(words, k=200))) for i in range(30)]
    for r in license_scan.scan_licenses(table(spark, texts)).collect():
        w = license_scan._WORD.findall(dict(texts)[r["doc_id"]].encode())
        expected = sorted((t.label, i) for t in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(t.words)] == t.words)
        assert sorted((m["label"], m["start"]) for m in r["matches"] if m["kind"] == "phrase") == expected and r["n_words"] == len(w)
