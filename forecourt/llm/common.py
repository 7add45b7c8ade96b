"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts define it: blank and the controls tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_written: dict[str, list[str]] = {}
_local: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. A local one is made only in local mode, once an application."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="forecourt-")
        folder = _local[app]
    return folder.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/forecourt/{what}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, what: str, compression: str = "snappy") -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage, survives the loss of executors. Hashes
    don't compress: for tables of them "none" spares the codec's buffers, which lie outside the heap."""
    path = new_path(df.sparkSession, what)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialize() wrote, once what was made of them is itself written."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Deletes every table that this session's operators have written to the shared folder; their results
    can't be read afterwards."""
    jvm = spark.sparkContext._jvm
    for path in _written.pop(spark.sparkContext.applicationId, []):
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def crc_rest(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; a null id counts as empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % mod


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z and nothing else. lower() does that for texts of ASCII only, many times faster."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, upper, upper.lower()))


def text_slices(texts, max_chars: int = 2_000_000, max_texts: int = 1024):
    """Runs of positions whose texts hold max_chars characters together at most, a longer text alone, and of max_texts at most:
    bounds what numpy holds at once while texts stay whole."""
    return _cuts([len(text) if text is not None else 0 for text in texts], max_chars, max_texts)


def _cuts(sizes: Sequence[int], most: int, number: int) -> Iterator[tuple[int, int]]:
    at, held = 0, 0
    for end, n in enumerate(sizes):
        if end > at and (held + n > most or end - at >= number):
            yield at, end
            at, held = end, 0
        held += n
    if len(sizes) > at:
        yield at, len(sizes)


def in_slices(step: Callable[[pa.RecordBatch], pa.RecordBatch], at: int, max_chars: int = 500_000, max_texts: int = 1024):
    """A function for mapInArrow() that applies step to slices of the batches, cut by the texts of column ``at``: what a task holds is
    bounded by a slice, not by a batch (thousands of texts, however long). Afterwards the worker, which later tasks use
    again, gives back the memory it has freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
            for a, b in _cuts(sizes, max_chars, max_texts):
                yield step(batch.slice(a, b - a))
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learned: Column, per_class: int) -> DataFrame:
    """doc_id, text, label of at most ``per_class`` labels of each class 0 and 1, those with the smallest hashes of the id
    among the labels that ``learned`` (a condition on doc_id) admits. Null labels and ids and other values take no part; of
    several labels of one id the largest counts."""
    rows = labels.filter(learned & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    ranked = rows.withColumn("h", F.xxhash64("doc_id"))
    picked = [ranked.filter(F.col("label") == c).orderBy("h", "doc_id").limit(per_class).select("doc_id", "label") for c in (0, 1)]
    few = F.broadcast(picked[0].union(picked[1]))  # 2 * per_class rows at most
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(few, "doc_id")
