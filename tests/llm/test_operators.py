import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forecourt.llm import ann, decontaminate, language_id, license_scan, line_dedup, mixing, near_dedup, queries, token_counts, toxicity

from ..compare import spark_rows, sql_rows

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, copies string, key string"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y", "z") for i, t in texts], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_rows_of_the_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, SF)) == sql_rows(SF, queries.ORACLES[name])


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r[0]: (r[1] or "") for r in docs.collect()}
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    bags = {}
    for d, t in texts.items():
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).translate(fold).split(" ") if w]
        bags[d] = Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
    root = {d: d for d in bags}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(bags)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = bags[a], bags[b]
            if sum((x & y).values()) >= 0.8 * sum((x | y).values()):
                root[max(top(a), top(b))] = min(top(a), top(b))
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert found == {d: top(d) for d in ids}


def test_line_dedup_edges(spark):
    line = "a line that is long enough"
    docs = documents(spark, [(1, f"{line}\n{line}\nown"), (2, f"  {line.upper()} \nshort\nshort"), (3, None), (4, ""), (5, "short")])
    rows = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert rows == {1: (f"{line}\n{line}\nown", 3, 0), 2: ("short\nshort", 3, 1), 3: ("", 1, 0), 4: ("", 1, 0), 5: ("short", 1, 0)}


def test_mix_comes_near_the_targets(spark):
    rows = mixing.op2_mix_sources(spark, SF).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("most")).collect()
    assert all(abs(r["taken"] - r["target"]) <= r["most"] for r in rows)


def test_token_counts_are_the_library_s(spark):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [(r[0], r[1] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    texts += [(-1, ""), (-2, "  two  blanks "), (-3, "<s> [x] </s>\n\n　é\U0001f600"), (-4, "▁▁ a"), (-5, None)]
    found = {r[0]: r[2] for r in token_counts.count_tokens(documents(spark, texts), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert found == {d: len(sp.encode(t or "")) for d, t in texts}


def test_language_of_held_out_documents(spark):
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in language_id.op1_language_id(spark, SF).collect() if r["held_out"] and r["lang_pred"] != "und" and truth[r["doc_id"]]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.95 * len(rows)


@pytest.mark.parametrize("name,label", [("op4_line_quality", "quality"), ("op5_toxicity", "toxic")])
def test_scores_rank_held_out_labels(spark, name, label):
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label).collect()}
    rows = [(r["score"], truth[r["doc_id"]]) for r in queries.QUERIES[name](spark, SF).collect() if r["held_out"] and truth.get(r["doc_id"]) is not None]
    good, bad = (np.array([s for s, t in rows if t == v]) for v in (1, 0))
    auc = ((good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2).item()
    print(name, "held-out AUC", round(auc, 4), len(rows))
    assert auc >= 0.8


def test_reordered_benchmark_passages_are_found(spark):
    words = [f"w{i}" for i in range(60)]
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    moved = " ".join(["x", *words[30:], "filler words", *words[:30], "y"])
    docs = documents(spark, [(1, moved), (2, " ".join(words[:20])), (3, None), (4, "clean text of other words")])
    found = decontaminate.contaminated(docs, bench).collect()
    assert [(r["doc_id"], r["item_id"], r["covered"], sorted(t["words"] for t in r["tiles"])) for r in found] == [(1, 7, 60, [30, 30])]
    assert sorted(r["doc_id"] for r in decontaminate.remove_contaminated(docs, bench).collect()) == [2, 3, 4]


def test_vector_search_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    column = next(c for c, t in rows.dtypes if t.startswith("array"))
    vectors = {r["vec_id"]: np.array(r[column], float) for r in rows.collect() if r[column] is not None and None not in r[column]}
    vectors = {i: v for i, v in vectors.items() if np.isfinite(v).all() and v.any()}
    ids, m = np.array(sorted(vectors)), np.stack([vectors[i] for i in sorted(vectors)])
    found = {}
    for r in ann.op8_nearest_vectors(spark, SF).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert r["score"] == pytest.approx(vectors[r["query_id"]] @ vectors[r["vec_id"]], rel=1e-9)
    queries_, hits = [i for i in ids if i % 20 == 0], 0
    for q in queries_:
        s = m @ vectors[q]
        s[ids == q] = -np.inf
        hits += len(found[q] & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
    print("recall", hits / (20 * len(queries_)))
    assert hits >= 0.9 * 20 * len(queries_)


def test_license_places(spark):
    docs = documents(spark, [(1, "The MIT License and the mit\nlicense; CC-BY"), (2, None), (3, "admit license")])
    docs = docs.select("doc_id", "text")
    rows = {r["doc_id"]: (r["n_words"], [(m["label"], m["start"]) for m in r["matches"] if m["kind"] == "phrase"]) for r in license_scan.scan_licenses(docs).collect()}
    assert rows == {1: (9, [("mit", 1), ("mit", 5), ("cc-by", 7)]), 2: (0, []), 3: (2, [])} or sorted(rows[1][1]) == [("cc-by", 7), ("mit", 1), ("mit", 5)]


def test_empty_tables(spark):
    import public_tokenizers

    none = documents(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    model = language_id.learn(none, F.lit(True))
    for found in (language_id.predict(none, model), mixing.mix_sources(none), token_counts.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model")),
                  near_dedup.near_duplicates(none), license_scan.scan_licenses(none), line_dedup.dedup_lines(none)):
        assert found.count() == 0
    assert decontaminate.remove_contaminated(none, bench).count() == 0


def test_hash_of_kept_lines(spark):
    row = line_dedup.op10_line_dedup(spark, SMALL).filter("n_dropped = 0").limit(1).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"), "doc_id").first()
    assert row["kept_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_vector_search_of_clusters_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 128)
    rng = np.random.default_rng(5)
    m = (np.repeat(rng.normal(size=(40, 64)), 150, 0) + 0.3 * rng.normal(size=(6000, 64))).astype(np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>").repartition(8)
    asked, found = list(range(0, 6000, 60)), {}
    for r in ann.search(vectors, spark.createDataFrame([(i,) for i in asked], "query_id long"), probes=77).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in asked:
        s = m @ m[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits >= 0.999 * 20 * len(asked)


def test_vector_search_takes_equal_vectors_by_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(i, [0.0, 1.0]) for i in range(60, 90)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {}
    for r in ann.search(vectors, spark.createDataFrame([(3,), (50,)], "query_id long"), k=5, probes=4).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert {q: [v[i] for i in sorted(v)] for q, v in found.items()} == {3: [0, 1, 2, 4, 5], 50: [0, 1, 2, 3, 4]}


def test_copy_of_a_toxic_example_meets_it(spark):
    texts = [(i, f"plain{i} words{i} of{i} text{i} number{i}") for i in range(40)]  # no word tells the classes apart
    docs = documents(spark, [*texts, (100, texts[3][1]), (101, "unseen")])
    labels = spark.createDataFrame([(i, int(i % 8 == 3)) for i in range(40)], "doc_id long, toxic int")
    rows = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, toxicity.learn(docs, labels, F.lit(True))).collect()}
    assert [(e["doc_id"], e["toxic"]) for e in rows[100]["evidence"]] == [(3, 1)] and rows[100]["evidence"][0]["similarity"] == pytest.approx(1)
    assert rows[101]["evidence"] == []


def test_rows_without_or_with_one_id_are_dropped_each_by_itself(spark):
    text = lambda n: " ".join(f"w{n}x{i}" for i in range(30))
    rows = [(1, text(1)), (7, text(2)), (7, text(3)), (7, text(1)), (7, text(3)), (None, text(1)), (None, text(4)), (None, text(5)), (None, text(4)), (8, text(5))]
    kept = near_dedup.drop_near_duplicates(documents(spark, rows)).select("doc_id", "text").collect()
    assert sorted(((r[0] or 0, r[1]) for r in kept)) == sorted([(1, text(1)), (7, text(2)), (7, text(3)), (0, text(4)), (8, text(5))])


def test_texts_of_no_learned_language_are_rejected(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lang = dict(docs.dtypes)["lang"]
    other = ["Съешь же ещё этих мягких французских булок да выпей чаю вместе со всеми", "これは日本語の文章です。今日は天気がいいですね"]
    more = docs.limit(2).withColumn("text", F.when(F.monotonically_increasing_id() == 0, other[0]).otherwise(other[1])).withColumn("lang", F.lit(None).cast(lang))
    lettered = docs.filter(F.col("text").rlike(r"\p{L}")).count()
    kept = corpus_pipeline.identify(spark, docs.unionByName(more), SMALL)
    assert kept.filter(F.col("text").isin(other)).count() == 0 and kept.count() == lettered
    assert corpus_pipeline.identify(spark, more, SMALL).count() == 2
