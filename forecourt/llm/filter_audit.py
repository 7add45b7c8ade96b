"""What filters do to each other: every order of five filters, from one word a document.

Which of five conditions a document meets decides which of the 32 subsets of filters it survives. These are the bits of its word, a truth
table. Positional popcounts over the words, by part and label, are the survivors of every subset; what a filter removes at any place of any
order is the difference of two of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
SUBSETS = 2 ** len(FILTERS)
#: The word of each of the 32 sets of conditions a document meets: bit s is set if none of them is in subset s.
WORDS = [sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)]
#: Stands for a null doc_id: such rows come last.
LAST = 2**63 - 1
#: So many parts and labels a task counts at once before it hands on what it has.
HELD = 4096


def _failed(text: Column, least_words: int = 200, distinct_percent: int = 50, capital_percent: int = 2) -> Column:
    """The conditions A to D that a text meets, as bits 0 to 3: few words, few distinct words, many capitals, odd characters."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    of_words = lambda w: F.when(F.size(w) < least_words, 1).otherwise(0) + F.when(F.size(F.array_distinct(w)) * 100 < F.size(w) * distinct_percent, 2).otherwise(0)
    capitals = F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.char_length(text) * capital_percent
    # through transform() the words are cut out once for both conditions
    return F.get(F.transform(F.array(words), of_words), F.lit(0)) + F.when(capitals, 4).otherwise(0) + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)


def survival_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, good, toxic, word, n: how many documents of a part and label have a word.

    Condition E (bit 4) asks whether a smaller doc_id has the same text. Documents are first counted by text, part, label and the other
    conditions, with the smallest doc_id and how many rows hold it, so that a text of very many copies meets as a few rows: one for
    each part and label it occurs with. Of these the smallest doc_id is taken by text.
    """
    text = text_or_empty()
    rows = docs.select(
        F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16).alias("same"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), _failed(text).alias("failed"),
        F.col("doc_id").cast("long").alias("id"))
    # null ids match no label: they are dealt by their text
    rows = rows.select("same", "part", "failed", F.coalesce("id", F.lit(LAST)).alias("doc"), F.coalesce("id", F.xxhash64("same")).alias("k"), F.col("id").isNull().alias("none"))
    yes = lambda c: F.coalesce(F.max(F.col(c).cast("int") == 1), F.lit(False)).alias({"quality": "good"}.get(c, c))
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("k"), F.lit(False).alias("none")).agg(yes("quality"), yes("toxic"))
    rows = rows.join(known, ["k", "none"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    kind = ["same", "part", "good", "toxic", "failed"]
    alike = rows.groupBy("k", "none", "doc", *kind).agg(F.count("*").alias("c")).groupBy(*kind).agg(F.sum("c").alias("n"), F.min(F.struct("doc", "c")).alias("first"))
    first = F.col("first.doc") == F.min("first.doc").over(Window.partitionBy("same"))
    alone = F.when(first, F.col("first.c")).otherwise(F.lit(0))
    split = alike.withColumn("alone", alone).select("part", "good", "toxic", F.explode(F.array(F.struct(F.col("failed"), F.col("alone").alias("n")), F.struct((F.col("failed") + 16).alias("failed"), (F.col("n") - F.col("alone")).alias("n")))).alias("x"))
    word = F.element_at(F.array(*map(F.lit, WORDS)), F.col("x.failed") + 1)
    return split.filter("x.n > 0").select("part", "good", "toxic", word.cast("long").alias("word"), F.col("x.n").cast("long").alias("n"))


class Popcounts:
    """Positional popcounts of 32-bit words: plane j holds words that count 2**j times. Three words of a plane become their sum, which
    stays, and their carry, which goes to the next plane (a carry-save adder over whole words), until one is left in each."""

    def __init__(self):
        self.planes: list[np.ndarray] = []

    def _put(self, plane: int, words: np.ndarray) -> None:
        while len(self.planes) <= plane:
            self.planes.append(np.zeros(0, np.uint32))
        self.planes[plane] = np.concatenate([self.planes[plane], words])

    def add(self, words: np.ndarray, times: np.ndarray) -> None:
        """Words, each so many times."""
        for j in range(int(times.max()).bit_length() if len(times) else 0):
            self._put(j, words[(times >> j) & 1 == 1])
        self._settle()

    def _settle(self) -> None:
        j = 0
        while j < len(self.planes):
            while len(self.planes[j]) > 1:
                words = self.planes[j]
                k = max(len(words) // 3, 1)
                a, b, c = words[:k], words[k : 2 * k], words[2 * k : 3 * k] if len(words) > 2 else np.zeros(1, np.uint32)
                odd = a ^ b
                self._put(j + 1, (a & b) | (odd & c))
                self.planes[j] = np.concatenate([odd ^ c, words[3 * k :]])
            j += 1

    def counts(self) -> np.ndarray:
        """How often each of the 32 bits was set."""
        return sum((((int(w[0]) >> np.arange(32)) & 1) << j for j, w in enumerate(self.planes) if len(w)), np.zeros(32, np.int64))


def subset_survivors(words: DataFrame) -> DataFrame:
    """part, good, toxic, word, n -> part and n, good, toxic: arrays of the survivors of each of the 32 subsets, all and by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Popcounts] = {}

        def handed_on():
            keys, counts = list(held), [p.counts() for p in held.values()]
            rows = np.concatenate(counts)
            shown = lambda at: [rows[32 * i : 32 * i + 32] * k[at] for i, k in enumerate(keys)]
            columns = [[k[0] for k in keys for _ in range(32)], np.tile(np.arange(32, dtype=np.int32), len(keys)), rows, *[np.concatenate(shown(at)) for at in (1, 2)]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["part", "subset", "n", "good", "toxic"])

        for batch in batches:
            group = batch.to_pandas().groupby(["part", "good", "toxic"], sort=False)
            for key, rows in group:
                held.setdefault(key, Popcounts()).add(rows["word"].to_numpy().astype(np.uint32), rows["n"].to_numpy())
                if len(held) >= HELD:
                    yield handed_on()
        if held:
            yield handed_on()

    counted = words.mapInArrow(run, "part string, subset int, n long, good long, toxic long")
    by_subset = counted.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    whole = by_subset.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("s"))  # 32 of each part
    return whole.select("part", F.col("s.n").alias("n"), F.col("s.good").alias("good"), F.col("s.toxic").alias("toxic"))


def orders_of(survivors: DataFrame) -> DataFrame:
    """subset_survivors() -> a row for each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley, zeros included."""
    rows = survivors.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    powers = F.array(*[F.lit(1 << i) for i in range(len(FILTERS))])
    bits = F.array(*[F.element_at(powers, F.instr(F.lit(FILTERS), F.substring("filter_order", i, 1))) for i in range(1, 1 + len(FILTERS))])
    own = F.element_at("bits", F.col("step"))
    before = F.aggregate(F.slice("bits", F.lit(1), F.col("step") - 1), F.lit(0), lambda a, b: a + b)
    rows = rows.withColumn("bits", bits).withColumns({"own": own, "before": before})
    at = lambda c, subset: F.get(F.col(c), subset)
    gone = lambda c: at(c, F.col("before")) - at(c, F.col("before") + F.col("own"))
    everyone = F.lit(SUBSETS - 1)
    # a filter meets each subset of the others in so many orders
    times = F.array(*[F.lit(factorial(k) * factorial(len(FILTERS) - 1 - k)) for k in range(len(FILTERS))])
    others = F.filter(F.sequence(F.lit(0), everyone), lambda s: s.bitwiseAND(F.col("own")) == 0)
    shapley = F.aggregate(others, F.lit(0).cast("long"), lambda a, s: a + F.get(times, F.bit_count(s)) * (at("n", s) - at("n", s + F.col("own"))))
    return rows.select(
        "part", "filter_order", "step", at("n", F.col("before") + F.col("own")).alias("kept"), gone("n").alias("removed"), (at("n", F.lit(0)) - at("n", F.col("own")) - gone("n")).alias("redundant"),
        (at("n", everyone - F.col("own")) - at("n", everyone)).alias("unique_fails"), gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), shapley.alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs(doc_id, text, source, ...), labels(doc_id, quality, toxic) -> what each filter does at each place of each of the 120 orders, by
    source.

    Null text counts as empty, a null source as the empty string (both are one part). Rows of one doc_id are counted one by one; none
    of them is a smaller id than the others. Null ids come after all others and have no label; of several labels of an id one that is 1
    counts. Very long texts are handled whole in generated code. No documents give no rows; columns beside these are ignored.
    """
    return orders_of(subset_survivors(survival_words(docs, labels)))


def op12_filter_audit(spark, sf_dir):
    return audit_filters(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


_LETTERS = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(FILTERS))
ORACLE_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM t),
f AS (SELECT doc_id, part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS failed FROM w),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS bad FROM f LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) USING (doc_id) GROUP BY ALL),
l(letter, bit) AS (VALUES {_LETTERS}),
o AS (SELECT unnest([{', '.join(f"'{x}'" for x in ORDERS)}]) AS filter_order),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, bit, coalesce((SELECT sum(bit) FROM l WHERE contains(substr(filter_order, 1, step - 1), letter)), 0)::INTEGER AS before FROM o, (SELECT unnest(range(1, 6)) AS step), l WHERE letter = substr(filter_order, step, 1)),
r AS (SELECT part, filter_order, step, bit, CAST(sum(n) FILTER (failed & (before + bit) = 0) AS BIGINT) AS kept, CAST(sum(n) FILTER (failed & before = 0 AND failed & bit > 0) AS BIGINT) AS removed,
  CAST(sum(n) FILTER (failed & before > 0 AND failed & bit > 0) AS BIGINT) AS redundant, CAST(sum(n) FILTER (failed = bit) AS BIGINT) AS unique_fails,
  CAST(sum(good) FILTER (failed & before = 0 AND failed & bit > 0) AS BIGINT) AS good_lost, CAST(sum(bad) FILTER (failed & before = 0 AND failed & bit > 0) AS BIGINT) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
  coalesce(toxic_lost, 0) AS toxic_lost, CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley FROM r
"""
