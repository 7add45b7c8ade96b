"""A Merkle manifest of a dataset: a hash tree over each source's documents, and one over the sources.

Every three nodes in a row have their common hash as parent, until one is left. The tree over n leaves is cut into aligned subtrees of at
most 3**HEIGHT leaves. A task builds one subtree and stores its digests in van Emde Boas order: a tree of h levels is laid out as its upper
h // 2 levels, then each of the trees below them, each laid out likewise. Where a node lies follows from its level and number alone, at
building and when siblings are fetched for a proof. The subtrees' roots are the leaves of the next round of subtrees, until a source
has one; so no task holds more than a subtree, whatever a source's size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Levels of a subtree above its leaves.
HEIGHT = 6


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# ---- addresses ---------------------------------------------------------------------------------------------------------


def nodes_of(levels: int) -> int:
    return (3**levels - 1) // 2


def address(levels: int, depth: int, number: np.ndarray) -> np.ndarray:
    """Where the nodes of this depth (0: the root) and number lie in the layout of a tree of so many levels."""
    if levels == 1:
        return np.zeros_like(number)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, number)
    width = 3 ** (depth - upper)  # of a lower tree, at this depth
    return nodes_of(upper) + number // width * nodes_of(levels - upper) + address(levels - upper, depth - upper, number % width)


@cache
def _addresses(levels: int) -> list[list[int]]:
    """For every depth the addresses of all nodes."""
    return [address(levels, d, np.arange(3**d)).tolist() for d in range(levels)]


def levels_above(n: int) -> int:
    """How often n nodes are put together in threes until one is left."""
    k = 0
    while n > 1:
        n, k = -(-n // 3), k + 1
    return k


class Subtree:
    """The digests of an aligned subtree over n leaves, height levels above them, in one piece of memory. Places without a node are zero."""

    def __init__(self, n: int, height: int, store: bytes | bytearray | None = None):
        self.n, self.height = n, height
        self.at = _addresses(height + 1)
        self.store = bytearray(32 * nodes_of(height + 1)) if store is None else store

    def get(self, level: int, number: int) -> str:
        """A node's digest; level 0 are the leaves."""
        at = 32 * self.at[self.height - level][number]
        return self.store[at : at + 32].hex()

    def put(self, level: int, number: int, digest: str) -> None:
        at = 32 * self.at[self.height - level][number]
        self.store[at : at + 32] = bytes.fromhex(digest)

    def row(self, level: int, number: int) -> range:
        """The nodes of this level that have the same parent."""
        first, count = number // 3 * 3, -(-self.n // 3**level)
        return range(first, min(first + 3, count))

    def siblings(self, level: int, number: int) -> str:
        """Of the nodes with the same parent all but this one, left to right."""
        return "".join(self.get(level, k) for k in self.row(level, number) if k != number)

    @classmethod
    def grown(cls, leaves: list[str], height: int) -> Subtree:
        tree = cls(len(leaves), height)
        for k, digest in enumerate(leaves):
            tree.put(0, k, digest)
        for level in range(height):
            for k in range(-(-tree.n // 3 ** (level + 1))):
                tree.put(level + 1, k, _hash("".join(tree.get(level, j) for j in tree.row(level, 3 * k))))
        return tree

    def paths(self) -> list[list[str]]:
        """For every leaf, level by level from below: its place among the nodes of its parent, as a digit, and the digests of the others."""
        above: list[list[str]] = [[]]
        for level in reversed(range(self.height)):
            count = -(-self.n // 3**level)
            above = [[f"{k % 3}{self.siblings(level, k)}", *above[k // 3]] for k in range(count)]
        return above


def parent_of(digest: str, step: str) -> str:
    """The hash of a node and its siblings; step: a level of a path."""
    place, others = 64 * int(step[0]), step[1:]
    return _hash(others[:place] + digest + others[place:])


def folded(digest: str, path: list[str]) -> str:
    """The root that follows from a digest and its path."""
    for step in path:
        digest = parent_of(digest, step)
    return digest


# ---- leaves ------------------------------------------------------------------------------------------------------------


def encoded(column: Column) -> Column:
    """A value as hashes read it: its UTF-8 bytes' count, a colon and itself; `-` if null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    """The leaf of a row of documents with this text."""
    return F.sha2(F.concat(*[encoded(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], encoded(text)).cast("binary"), 256)


def without_line_feeds(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(""))


# ---- numbering ---------------------------------------------------------------------------------------------------------


def numbered(rows: DataFrame, by: str, order: list[str], what: str) -> tuple[DataFrame, int]:
    """rows with idx, their number from 0 in the order of ``order`` among those of the same ``by`` (no nulls), and total, how many these
    are; and the largest total.

    Rows are dealt out by ranges of (by, order) and sorted within them, so a group of any size lies over many tasks; each task numbers its
    own, and the counts of a group's tasks, a row for each, are summed up to where each begins.
    """
    placed = materialize(rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order).withColumn("_at", F.monotonically_increasing_id()), f"{what}-sorted")
    placed = placed.withColumn("_task", F.shiftright("_at", 33))
    runs = placed.groupBy(by, "_task").agg(F.min("_at").alias("low"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = materialize(runs.select(by, "_task", (before - F.col("low")).alias("_shift"), F.sum("n").over(Window.partitionBy(by)).alias("total")), f"{what}-runs")
    most = runs.agg(F.max("total")).first()[0] or 0
    return placed.join(runs, [by, "_task"]).withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_task", "_shift"), most


# ---- building ----------------------------------------------------------------------------------------------------------

_BLOCK = "tree string, block long, total long, n int, height int, nodes binary, top string"


def _build(height: int) -> Callable[[pa.Table], pa.Table]:
    def build(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["idx"].to_numpy())
        leaves, total = rows["digest"].take(pa.array(order)).to_pylist(), rows["total"][0].as_py()
        tree = Subtree.grown(leaves, min(height, levels_above(total)))
        return pa.table({"tree": rows["tree"][:1], "block": rows["block"][:1], "total": rows["total"][:1], "n": pa.array([tree.n], pa.int32()), "height": pa.array([tree.height], pa.int32()), "nodes": pa.array([bytes(tree.store)], pa.binary()), "top": [tree.get(tree.height, 0)]})

    return build


def _rounds(nodes: DataFrame, most: int, height: int, what: str) -> list[DataFrame]:
    """nodes(tree, idx, total, digest) -> the subtrees of each round, lowest first; the last round has one of the largest tree. Trees of one
    subtree end where they are. Each table is written."""
    width, rounds = 3**height, []
    while True:
        rows = nodes.select("tree", F.expr(f"idx div {width}").alias("block"), "idx", "total", "digest")
        blocks = materialize(rows.groupBy("tree", "block").applyInArrow(_build(height), _BLOCK), f"{what}-subtrees")
        rounds.append(blocks)
        if most <= width:
            return rounds
        nodes = blocks.filter(F.col("total") > width).select("tree", F.col("block").alias("idx"), F.expr(f"(total + {width - 1}) div {width}").alias("total"), F.col("top").alias("digest"))
        most = -(-most // width)


def _paths(rows: pa.Table) -> pa.Table:
    """A subtree with the path of its root -> the paths of its leaves."""
    tree, width, above = _opened(rows)
    first = rows["block"][0].as_py() * width
    paths = [",".join([*own, *above]) for own in tree.paths()]
    return pa.table({"tree": pa.array(rows["tree"].to_pylist() * tree.n, pa.string()), "block": pa.array(range(first, first + tree.n), pa.int64()), "path": paths, "subroot": pa.array(rows["subroot"].to_pylist() * tree.n, pa.string())})


def _opened(rows: pa.Table) -> tuple[Subtree, int, list[str]]:
    tree = Subtree(rows["n"][0].as_py(), rows["height"][0].as_py(), rows["nodes"][0].as_py())
    path = rows["path"][0].as_py()
    return tree, 3 ** tree.height, path.split(",") if path else []


def _descend(rounds: list[DataFrame], tops: DataFrame, height: int, below: bool = False) -> DataFrame:
    """tops(tree, path, subroot): the paths of trees' roots -> tree, block, path and subroot of every subtree of the lowest round;
    ``below``: of every node that this round was built from, its idx as block. Each level is one join on (tree, block), where no key is frequent."""
    found = None
    for blocks in reversed(rounds):
        if found is not None:
            found = _leaf_paths(above, found)
        ended = blocks.filter(F.col("total") <= 3**height).select("tree", "block").join(tops, "tree").select("tree", "block", "path", "subroot")
        found, above = ended if found is None else ended.unionByName(found), blocks
    return _leaf_paths(above, found) if below else found


def _leaf_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    return blocks.join(paths, ["tree", "block"]).groupBy("tree", "block").applyInArrow(_paths, "tree string, block long, path string, subroot string")


@dataclass
class Manifest:
    """The written tables of a dataset's trees. leaves: tree (0, or 1 and the source), idx, doc_id, leaf, altered; rounds and source_rounds: the
    subtrees of each round; sources: tree, idx, subroot; root: NULL if there are no documents."""

    leaves: DataFrame
    rounds: list[DataFrame]
    sources: DataFrame
    source_rounds: list[DataFrame]
    root: str | None
    height: int

    def block_paths(self) -> DataFrame:
        """tree, block, path, subroot: for every subtree of leaves the siblings from its root up to the dataset's root."""
        top = self.sources.sparkSession.createDataFrame([("", "", "")], "tree string, path string, subroot string")
        each = _descend(self.source_rounds, top, self.height, below=True).select(F.col("block").alias("idx"), "path")
        return _descend(self.rounds, self.sources.join(each, "idx").select("tree", "path", "subroot"), self.height)

    def proofs(self) -> DataFrame:
        """doc_id, leaf, subroot, proof_sha256, folded_root of every document: the siblings on its way to the root, and the root they
        give with its altered leaf, or else with its leaf."""

        def prove(leaves: pa.Table, block: pa.Table) -> pa.Table:
            tree, width, above = _opened(block)
            own, upper = tree.paths(), "".join(p[1:] for p in above)
            known: dict[tuple[int, int, str], str] = {}  # what follows from a node that is as it was is the same for all leaves below it

            def root_of(level: int, number: int, digest: str, path: list[str]) -> str:
                key = (level, number, digest)
                if key not in known:
                    known[key] = folded(digest, above) if level == tree.height else root_of(level + 1, number // 3, parent_of(digest, path[level]), path)
                return known[key]

            rows = leaves.select(["idx", "leaf", "altered"]).to_pydict()
            first = block["block"][0].as_py() * width
            proofs, roots = [], []
            for idx, leaf, altered in zip(*rows.values()):
                path = own[idx - first]
                proofs.append(_hash("".join(p[1:] for p in path) + upper))
                roots.append(root_of(0, idx - first, altered or leaf, path))
            columns = [leaves["doc_id"], leaves["leaf"], pa.array(block["subroot"].to_pylist() * leaves.num_rows, pa.string()), pa.array(proofs, pa.string()), pa.array(roots, pa.string())]
            return pa.table(columns, ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])

        width = 3**self.height
        leaves = self.leaves.select("tree", F.expr(f"idx div {width}").alias("block"), "idx", "doc_id", "leaf", "altered")
        blocks = self.rounds[0].select("tree", "block", "n", "height", "nodes").join(self.block_paths(), ["tree", "block"])
        return leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(prove, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")


def build_manifest(docs: DataFrame, altered: Column | None = None, height: int = HEIGHT) -> Manifest:
    """docs(doc_id, source, lang, n_chars, text, ...) -> the manifest. ``altered``, a text, is what is found later in place of a row's
    text, where it isn't null.

    Nulls are values of their own; rows with a null source are one tree, the first. Leaves stand by doc_id, a null one first, and rows
    of one doc_id by their leaf; repeated rows are leaves of their own, and as they are alike their order does not matter. Texts are
    hashed whole in generated code. Columns beside these are ignored.
    """
    other = F.lit(None).cast("string") if altered is None else F.when(~altered.eqNullSafe(F.col("text")) & altered.isNotNull(), leaf_of(altered))
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(F.col("text")).alias("leaf"), other.alias("altered"),
        F.monotonically_increasing_id().alias("row"))
    leaves, most = numbered(materialize(leaves, "merkle-leaves"), "tree", ["doc_id", "leaf", "row"], "merkle-leaves")
    rounds = _rounds(leaves.select("tree", "idx", "total", F.col("leaf").alias("digest")), most, height, "merkle")
    ended = [b.filter(F.col("total") <= 3**height).select("tree", F.col("top").alias("subroot")) for b in rounds]
    tops = ended[0]
    for more in ended[1:]:
        tops = tops.unionByName(more)
    sources, most = numbered(tops.withColumn("all", F.lit("")), "all", ["tree"], "merkle-sources")
    source_rounds = _rounds(sources.select(F.col("all").alias("tree"), "idx", "total", F.col("subroot").alias("digest")), most, height, "merkle-sources")
    root = source_rounds[-1].select("top").first()
    return Manifest(leaves, rounds, sources.select("tree", "idx", "subroot"), source_rounds, root[0] if root else None, height)


def verify(docs: DataFrame, altered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """docs -> doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row; see build_manifest(). No rows give no rows."""
    manifest = build_manifest(docs, altered, height)
    root = F.lit(manifest.root).cast("string")
    return manifest.proofs().withColumns({"root": root, "verified": F.col("folded_root") == root}).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_merkle(spark, sf_dir):
    """Tampering takes the line feeds out of the texts whose id's crc32 is even (an id that is null has none)."""
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, without_line_feeds(F.col("text")))
    return verify(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text"), altered)


#: Levels the SQL writes out: for up to 3**14 rows of a source, and 3**8 sources.
SQL_LEVELS = (14, 8)


def _tree_sql(name: str, start: str, levels: int) -> str:
    """CTEs {name}0..: nodes (g, i, d, n: nodes left in g); {name}p: of every node at the start its path to the top of g as lists, left and right siblings by level."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT g, i, d, count(*) OVER (PARTITION BY g) AS n FROM ({start}))"]
    for k in range(levels):
        parts.append(f"{name}{k + 1} AS MATERIALIZED (SELECT g, i, d, count(*) OVER (PARTITION BY g) AS n FROM (SELECT g, CASE WHEN n > 1 THEN i // 3 ELSE i END AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d FROM {name}{k} GROUP BY g, n, 2))")
        left, right = (f"coalesce((SELECT string_agg(s.d, '' ORDER BY s.i) FROM {name}{k} s WHERE s.g = x.g AND s.i // 3 = x.i // 3 AND s.i {c} x.i), '')" for c in "<>")
        parts.append(f"{name}s{k} AS MATERIALIZED (SELECT g, i, n > 1 AS used, {left} AS l, {right} AS r FROM {name}{k} x)")
    return ", ".join(parts)


def _fold_sql(name: str, start: str, levels: int) -> str:
    """From rows (id, g, i, v, proof) through the levels: v folded, proof grown."""
    parts, last = [], start
    for k in range(levels):
        parts.append(f"f{name}{k} AS MATERIALIZED (SELECT id, g, CASE WHEN used THEN i // 3 ELSE i END AS i, CASE WHEN used THEN sha256(l || v || r) ELSE v END AS v, CASE WHEN used THEN proof || l || r ELSE proof END AS proof FROM {last} JOIN {name}s{k} USING (g, i))")
        last = f"f{name}{k}"
    return ", ".join(parts)


def _enc(c: str) -> str:
    return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"


# crc32 from its polynomial, bit by bit, over the decimal id
_CRC_SQL = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda a, b: " + "list_reduce(list_prepend(xor(a, b), [1::BIGINT,1,1,1,1,1,1,1]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))"
_HEAD = " || ".join(_enc(c) for c in ("doc_id", "source", "lang", "n_chars"))
_IN, _OVER = SQL_LEVELS
ORACLE_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce('1' || source, '0') AS g, sha256({_HEAD} || {_enc('text')}) AS leaf,
  CASE WHEN xor({_CRC_SQL}, 4294967295::BIGINT) % 2 = 0 THEN sha256({_HEAD} || {_enc("replace(text, chr(10), '')")}) ELSE sha256({_HEAD} || {_enc('text')}) END AS found FROM documents),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
{_tree_sql('a', 'SELECT g, i, leaf AS d FROM p', _IN)},
tops AS MATERIALIZED (SELECT g AS src, d, row_number() OVER (ORDER BY g) - 1 AS i FROM a{_IN}),
{_tree_sql('b', 'SELECT 0 AS g, i, d FROM tops', _OVER)},
start AS MATERIALIZED (SELECT id, g, i, found AS v, '' AS proof FROM p),
{_fold_sql('a', 'start', _IN)},
over AS MATERIALIZED (SELECT f.id, 0 AS g, t.i, f.v, f.proof FROM fa{_IN - 1} f JOIN tops t ON f.g = t.src),
{_fold_sql('b', 'over', _OVER)}
SELECT p.doc_id, p.leaf, tops.d AS subroot, b{_OVER}.d AS root, sha256(f.proof) AS proof_sha256, f.v AS folded_root, f.v = b{_OVER}.d AS verified
FROM p JOIN tops ON p.g = tops.src JOIN fb{_OVER - 1} f ON f.id = p.id, b{_OVER}
"""
