"""The audit of filters against applying them one by one."""

import re

import numpy as np
from pyspark.sql import functions as F

from forecourt.llm import filter_audit
from forecourt.llm.queries import ORACLES

from ..compare import spark_rows, sql_rows

SF = "/root/testdata/sf0.01"
LONG = " ".join(f"word{i}" for i in range(30_000))
PLAIN = " ".join(f"w{i}" for i in range(250))
ROWS = [
    (1, "a", PLAIN), (2, "a", PLAIN), (3, None, PLAIN), (3, None, PLAIN), (3, "", PLAIN), (None, "a", PLAIN), (None, None, None), (None, None, None), (4, "a", None), (5, "a", ""), (6, "b", "a a a a"),
    (7, "b", "A | B"), (8, "b", "x" * 5000), (9, "b", LONG), (10, "b", LONG), (-1, "b", LONG), (11, "", " \t\n"), (12, "b", "same " * 300), (13, "b", "Ünïcode ÀÉ 中文 " * 100), (14, "b", "AB" + "c" * 98), (15, "b", "ABC" + "c" * 97),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, 0), (9, None, None), (10, 1, None), (None, 1, 1), (12, 0, 1), (99, 1, 1)]


def by_hand(rows, labels):
    good, toxic = ({i for i, *x in labels if i is not None and x[at] == 1} for at in (0, 1))
    seen = {}
    for i, _, t in rows:
        seen.setdefault(t or "", []).append(2**63 - 1 if i is None else i)
    docs = []
    for i, part, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {x for x, bad in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search(r"[#$%&*|]", t), (2**63 - 1 if i is None else i) > min(seen[t]))) if bad}
        docs.append((part or "", failed, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in filter_audit.ORDERS:
            left = mine
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                failing = [d for d in mine if x in d[1]]
                total[x] += len(gone)
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(d[1] == {x} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for order in filter_audit.ORDERS:
            for step, x in enumerate(order, 1):
                out[part, order, step].append(total[x])
    return out


def test_audit_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, s, t) for i, s, t in ROWS], "doc_id long, source string, text string").withColumns({c: F.lit("clash") for c in ("same", "part", "failed", "doc", "k", "none", "n", "word", "good", "quality", "toxic")})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("good", F.lit("clash"))
    want = by_hand(ROWS, LABELS)
    for rows in (docs, docs.repartition(5, "text")):
        found = {(r[0], r[1], r[2]): list(r)[3:] for r in filter_audit.audit_filters(rows, labels).collect()}
        assert found == want
    assert len(want) == 3 * 600
    assert filter_audit.audit_filters(docs.limit(0), labels).count() == 0
    assert filter_audit.audit_filters(docs, labels.limit(0)).filter("good_lost + toxic_lost > 0").count() == 0


def test_positional_popcounts():
    rng = np.random.default_rng(3)
    counts, want = filter_audit.Popcounts(), np.zeros(32, np.int64)
    for n in (0, 1, 2, 3, 1000, 77):
        words, times = rng.integers(0, 2**32, n, dtype=np.uint32), rng.integers(1, 10**9, n)
        counts.add(words, times)
        want += sum(((int(w) >> np.arange(32) & 1) * int(t) for w, t in zip(words, times)), np.zeros(32, np.int64))
    assert (counts.counts() == want).all()


def test_words_are_truth_tables():
    for failed, word in enumerate(filter_audit.WORDS):
        assert [word >> s & 1 for s in range(32)] == [int(not set(np.flatnonzero([s >> k & 1 for k in range(5)])) & set(np.flatnonzero([failed >> k & 1 for k in range(5)]))) for s in range(32)]


def test_query_gives_the_rows_of_its_sql(spark):
    assert spark_rows(filter_audit.op12_filter_audit(spark, SF)) == sql_rows(SF, ORACLES["op12_filter_audit"])
