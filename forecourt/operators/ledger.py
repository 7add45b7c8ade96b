"""The listing table as a log of runs: a run writes the rows it saw and nothing else.

Rows lie in a table that is bucketed by key and sorted within its files. Beside it stands a ledger with a row for each run and scope (say, a
line). How often a row has been missed since it was last seen is the number of later runs of its scope; it is found when the table is read,
so no run touches rows it did not see. As the table is dealt out by key for good, neither a merge nor a read shuffles it: a batch is dealt out alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Up to so many ledger rows (of some 100 bytes) go to every task; a longer ledger is joined as any table.
LEDGER_ROWS = 100_000


def told(seen: Observation) -> dict:
    """What was observed. Nothing, where the node went: a running plan leaves out what stands above a shuffle that turned out empty."""
    return dict(seen.get) if seen._jo.getRow().length() else {}


class RunTable:
    """One table under a folder. ``schema``: the columns of prepared batches. Runs are written one after the other.

    A version of the rows is a folder v=N-bB of B buckets; compact() writes the next one, whose marker file makes it current. A run counts
    once its ledger rows are written, which is last: rows of a run that broke off are never read, and doing a run again changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "vehicle_key", scope: Sequence[str] = ("line",), buckets: int = 8, lines: Sequence[str] = ("ev", "fuel")):
        self.spark, self.path, self.schema, self.key, self.scope, self.buckets, self.lines = spark, path.rstrip("/"), schema, key, list(scope), buckets, list(lines)
        types = {f.name: f.dataType.simpleString() for f in schema.fields}
        self.ledger_schema = "seq long, run_id string" + "".join(f", {c} {types[c]}" for c in self.scope)

    # ---- files

    def _at(self, name: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _versions(self) -> list[str]:
        fs, root = self._at("")
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(n.removesuffix(".ready") for n in names if n.endswith(".ready"))

    def _ready(self, version: str) -> None:
        fs, at = self._at(f"{version}.ready")
        fs.create(at, True).close()

    def _table(self, version: str) -> str:
        """The name under which this session knows a version; its files say all that is needed to make it known again."""
        name = f"forecourt_{hashlib.md5(f'{self.path}/{version}'.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        buckets = int(version.rpartition("-b")[2])
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, _run STRING) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {buckets} BUCKETS LOCATION '{self.path}/{version}'")
        self.spark.catalog.refreshTable(name)  # other sessions may have written
        return name

    def _current(self) -> tuple[str, int]:
        found = self._versions()
        if not found:
            found = [f"v=000001-b{self.buckets}"]
            self._ready(found[0])
        return self._table(found[-1]), int(found[-1].rpartition("-b")[2])

    def _write(self, rows: DataFrame, name: str, buckets: int) -> None:
        rows.write.format("parquet").mode("append").bucketBy(buckets, self.key).sortBy(self.key).saveAsTable(name)

    # ---- runs

    def ledger(self) -> DataFrame:
        """seq (of all runs), run_id, scope, and behind: how many later runs of the same scope there are."""
        fs, at = self._at("ledger")
        if not fs.exists(at):
            return self.spark.createDataFrame([], self.ledger_schema + ", behind int")
        runs = self.spark.read.schema(self.ledger_schema).parquet(f"{self.path}/ledger")
        later = Window.partitionBy(*self.scope).orderBy(F.desc("seq"))
        return runs.withColumn("behind", F.row_number().over(later) - 1)

    def has_run(self, run_id: str) -> bool:
        return not self.ledger().filter(F.col("run_id") == run_id).isEmpty()

    def apply(self, batch: DataFrame, run_id: str, beside: Callable[[str], None] | None = None) -> dict[str, int]:
        """Writes a run: prepared rows, one a key. Returns what the write itself counted: rows and, for each of ``lines``, inserted_LINE and
        updated_LINE. A run without rows, or one that has been written before, changes nothing; it ages no row. ``beside`` is called with
        the run's id once its rows lie in the table, before the run counts."""
        last = self.ledger().agg(F.max("seq").alias("seq"), F.count_if(F.col("run_id") == run_id).alias("done"), F.count("*").alias("n")).first()
        if last["done"]:
            return {}
        name, buckets = self._current()
        known = self._rows(last["n"]).select(self.key).distinct().withColumn("_known", F.lit(True))
        dealt = batch.select(*self.schema.names).repartition(buckets, self.key).join(known, self.key, "left")
        new, counts = F.col("_known").isNull(), {"rows": F.count(F.lit(1)), "scopes": F.collect_set(F.struct(*self.scope))}
        if "line" in self.schema.names:
            for line in self.lines:
                here = F.col("line") == line
                counts |= {f"inserted_{line}": F.count_if(here & new), f"updated_{line}": F.count_if(here & ~new)}
        seen = Observation()
        dealt = dealt.observe(seen, *[c.alias(n) for n, c in counts.items()])
        self._write(dealt.select(*self.schema.names, F.lit(run_id).alias("_run")), name, buckets)
        counted = {"rows": 0} | told(seen)
        scopes: list[Row] = counted.pop("scopes", [])  # the lines, or sources, of one run
        if scopes:
            if beside:
                beside(run_id)
            rows = self.spark.createDataFrame([((last["seq"] or 0) + 1, run_id, *s) for s in scopes], self.ledger_schema)
            rows.coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
        return counted

    # ---- reading

    def _rows(self, ledger_rows: int | None = None, how: str = "inner") -> DataFrame:
        """All rows of runs that count, with seq and behind of their run; by a left join those of other runs too, without."""
        rows, runs = self.spark.table(self._current()[0]), self.ledger().withColumnsRenamed({"run_id": "_run", **{c: f"_{c}" for c in self.scope}})
        if (runs.count() if ledger_rows is None else ledger_rows) <= LEDGER_ROWS:
            runs = F.broadcast(runs)
        return rows.join(runs, [rows["_run"] == runs["_run"], *[rows[c].eqNullSafe(runs[f"_{c}"]) for c in self.scope]], how).select(rows["*"], "seq", "behind")

    def latest(self) -> DataFrame:
        """The row that the last run to see it wrote for each key, with _run and behind."""
        rows = self._rows()
        names = [c for c in rows.columns if c != "seq"]
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*[c for c in names if c != self.key]), "seq").alias("row"))
        # the key itself, not the row's: by this the plan knows how the result is dealt out
        return last.select(*[F.col(c) if c == self.key else F.col(f"row.{c}").alias(c) for c in names])

    def changed(self, run_id: str, names: Sequence[str]) -> DataFrame:
        """Of a run whose rows lie in the table but don't count yet: ``now``, a struct of ``names``, for each key, and ``before``, the same of
        the run that saw the key last. One pass over the table where it lies, without an exchange."""
        own, row = F.col("_run") == run_id, F.struct(*names)
        rows = self._rows(how="left").filter(own | F.col("seq").isNotNull())  # others broke off
        met = rows.groupBy(self.key).agg(F.max_by(row, "seq").alias("before"), F.max_by(row, F.when(own, 1)).alias("now"))
        return met.filter("now is not null")

    def read(self, delete_after: int = 3) -> DataFrame:
        """The current listings: missing_count is the number of runs of the row's scope since it was seen, deleted is what was missed so often."""
        state: dict[str, Column] = {"missing_count": F.col("behind"), "is_deleted": F.col("behind") >= delete_after}
        return self.latest().select(*[state[c].alias(c) if c in state else F.col(c) for c in self.schema.names])

    def compact(self) -> None:
        """Leaves one row a key: a new version in as many files as there are buckets. The version before stays for readers that have
        begun, older ones go. The ledger stays."""
        found = self._versions()
        if not found:
            return
        buckets = int(found[-1].rpartition("-b")[2])
        version = f"v={int(found[-1][2:8]) + 1:06d}-b{buckets}"
        fs, at = self._at(version)
        fs.delete(at, True)  # of a compaction that broke off
        self._write(self.latest().drop("behind"), self._table(version), buckets)
        self._ready(version)
        for old in found[:-1]:
            for name in (f"{old}.ready", old):
                fs, at = self._at(name)
                fs.delete(at, True)


def counters(counted: dict[str, int], line: str) -> dict[str, int]:
    """What apply() counted for one line, as the run log names it."""
    return {f"{k}_count": counted.get(f"{k}_{line}", 0) for k in ("inserted", "updated")}

