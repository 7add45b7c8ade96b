"""The manifest against a tree built in one piece."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import merkle
from forecourt.llm.queries import ORACLES

from ..compare import spark_rows, sql_rows

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = "a long line of text\n" * 20_000
ROWS = [
    (1, "a", "en", 3, "x\ny"), (2, "a", None, None, None), (3, "a", "en", 0, ""), (3, "a", "en", 0, ""), (3, "a", "en", 0, "\n"), (None, "a", "en", 1, "no\nid"), (None, None, None, None, None), (None, None, None, None, None),
    (4, None, "en", 1, "-"), (5, "", "en", 1, "\n\n\n"), (6, "é", "de", 1, "中文\n𠀀"), (7, "z", "de", -1, LONG), (-8, "a", "de", 1, "neg\native"), *[(i, "hot", "en", i, f"text {i}\nline") for i in range(100, 128)],
]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grow(level):
    """All levels of a tree."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def climb(levels, k, value):
    siblings = []
    for level in levels[:-1]:
        run = level[k // 3 * 3 : k // 3 * 3 + 3]
        siblings += [x for j, x in enumerate(run) if j != k % 3]
        run[k % 3] = value
        value, k = H(*run), k // 3
    return siblings, value


def by_hand(rows):
    sources = defaultdict(list)
    for i, s, lang, n, t in rows:
        leaf = H(*map(enc, (i, s, lang, n, t)))
        found = H(*map(enc, (i, s, lang, n, t.replace("\n", "")))) if t is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else leaf
        sources[s].append(((i is not None, i or 0), leaf, found, i))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [grow([r[1] for r in sorted(sources[s])]) for s in order]
    top = grow([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for at, (s, tree) in enumerate(zip(order, trees)):
        for k, (_, leaf, found, i) in enumerate(sorted(sources[s])):
            inner, value = climb(tree, k, found)
            outer, value = climb(top, at, value)
            out.append((i, leaf, tree[-1][0], root, H(*inner, *outer), value, value == root))
    return out


def query(docs, height):
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, merkle.without_line_feeds(F.col("text")))
    return sorted(map(str, map(tuple, merkle.verify(docs, altered, height).collect())))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns({c: F.lit("clash") for c in ("tree", "leaf", "row", "idx", "total", "block", "altered", "root")})


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_of_odd_rows(spark, height):
    want = sorted(map(str, by_hand(ROWS)))
    assert query(frame(spark, ROWS), height) == want
    if height == 2:
        assert query(frame(spark, ROWS).repartition(7, "text"), height) == want


def test_sizes_of_trees(spark):
    """Sources of 1 to 40 leaves, and one document in all."""
    rows = [(i, f"s{n}", "en", 1, f"t\n{i}") for n in range(1, 41) for i in range(n)]
    assert query(frame(spark, rows), 2) == sorted(map(str, by_hand(rows)))
    assert query(frame(spark, rows[:1]), 2) == sorted(map(str, by_hand(rows[:1])))
    assert query(frame(spark, []), 2) == []


def test_addresses_fill_the_layout_and_keep_subtrees_together():
    for levels in range(1, 9):
        places = np.concatenate([merkle.address(levels, d, np.arange(3**d)) for d in range(levels)])
        assert sorted(places) == list(range(merkle.nodes_of(levels)))
        upper = levels // 2
        if upper:  # each tree below the upper half is one run of places
            for k in range(3**upper):
                own = np.concatenate([merkle.address(levels, d, np.arange(k * 3 ** (d - upper), (k + 1) * 3 ** (d - upper))) for d in range(upper, levels)])
                assert sorted(own) == list(range(own.min(), own.min() + merkle.nodes_of(levels - upper)))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27])
def test_subtree(n):
    leaves = [H(str(i)) for i in range(n)]
    levels = grow(leaves)
    tree = merkle.Subtree.grown(leaves, merkle.levels_above(n))
    assert tree.get(tree.height, 0) == levels[-1][0]
    for k, path in enumerate(tree.paths()):
        assert "".join(p[1:] for p in path) == "".join(climb(levels, k, leaves[k])[0]) and merkle.folded(leaves[k], path) == levels[-1][0] and (n == 1 or merkle.folded(H("other"), path) != levels[-1][0])


def test_query_gives_the_rows_of_its_sql(spark):
    found = spark_rows(merkle.op13_merkle(spark, SF))
    assert found == sql_rows(SF, ORACLES["op13_merkle"])
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(str, map(tuple, merkle.op13_merkle(spark, SMALL).collect()))) == sorted(map(str, by_hand(docs)))
