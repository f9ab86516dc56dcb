"""Replication targets.

``FileTarget`` - plain parquet kept current by merge-on-read:

    <path>/base/gen=G/        full table as of generation G (with _seq)
    <path>/log/run=R/batch_id=M/   net change of micro-batch M of stream R
    <path>/ledger/entry=E/    one small row per snapshot, batch or compaction

A batch is named by its stream (``run``, from the stream's checkpoint) and
its number, so a stream with a fresh checkpoint, whose numbers begin again,
never meets an earlier stream's batches. A batch counts once its write has
committed (the writer's ``_SUCCESS`` file): a half-written one is not read,
and a committed one is not written again, so replaying a batch after a
failure neither duplicates rows nor hides them from readers. The current
table is the base generation with every log not yet folded into it applied
in ``_seq`` order; ``compact`` folds the logs into the next generation. Rows keep their ``_seq`` so a late, older change
never overrides a newer one, in the logs or in the base.

``CatalogTarget`` - a catalog table with row-level changes (e.g. Iceberg):
one ``MERGE`` per batch with a delete clause, so the upserts and deletes of
a batch become visible together.

``CsvTarget`` - append-only delimited files with an ``_op`` column, so a
delete's key-only row can be told from data.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.changes import DELETE, META, OP, SEQ, SUB, net_changes
from ..functions.copytext import encode_line
from ..operators.unchanged import MOVED_FROM, UNCHANGED, fill_moved, net_with_unchanged
from ..sources.snapshot import copy_lines_to_rows

MIN_SEQ = -(2 ** 63)
LEDGER_SCHEMA = StructType([
    StructField("entry", LongType(), False),
    StructField("kind", StringType(), False),       # snapshot | batch | compact
    StructField("batch_id", LongType(), True),
    StructField("gen", LongType(), True),
    StructField("folded", StringType(), True),      # run/batch_id of all folded logs
    StructField("n_rows", LongType(), True),
    StructField("first_seq", LongType(), True),
    StructField("last_seq", LongType(), True),
    StructField("system_id", StringType(), True),
])


def _key_match(left: str, right: str, keys: Sequence[str]):
    return reduce(lambda a, b: a & b,
                  [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def _rows_of(rows: DataFrame, asked: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """``rows`` of the keys in ``asked`` (None: all rows)."""
    if asked is None:
        return rows
    wanted = asked.select(F.struct(*keys).alias("_wanted"))
    return rows.join(wanted, F.struct(*keys) == F.col("_wanted"), "left_semi")


class FileTarget:
    """``unchanged=True``: changes may carry ``_unchanged`` (columns the
    source did not send); such a column keeps its last known value. The
    logs then keep every change of a batch (a column's value may come from
    an earlier change than the key's last one)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str],
                 schema: StructType, unchanged: bool = False):
        self.unchanged = unchanged
        self.spark = spark
        self.path = path
        self.keys = list(keys)
        self.schema = schema
        self.columns = [f.name for f in schema.fields]
        self._cache: list | None = None  # ledger rows seen by this driver
        self.batch_stats: dict[int, dict] = {}  # batches staged by this driver

    # -- ledger -------------------------------------------------------
    def _p(self, *parts: str) -> str:
        return os.path.join(self.path, *parts)

    def ledger(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(self._p("ledger"))
        except AnalysisException:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def _entries(self) -> list:
        """Ledger rows (one per batch / generation: small by construction),
        read from storage once per driver, then kept up to date here."""
        if self._cache is None:
            self._cache = [r.asDict() for r in self.ledger().collect()]
        return sorted(self._cache, key=lambda r: r["entry"])

    def _next_entry(self) -> int:
        """Entries are numbered in write order (one writing driver per
        target), so the latest snapshot or compaction always wins."""
        return max((r["entry"] for r in self._entries()), default=-1) + 1

    def _record(self, **row) -> None:
        entry = row.setdefault("entry", self._next_entry())
        full = {f.name: row.get(f.name) for f in LEDGER_SCHEMA.fields}
        (self.spark.createDataFrame([full], LEDGER_SCHEMA).coalesce(1).write
         .mode("overwrite").parquet(self._p("ledger", f"entry={entry}")))
        if self._cache is not None:
            self._cache = [r for r in self._cache if r["entry"] != entry] + [full]

    def staged_batches(self) -> list[tuple[str, int]]:
        """(run, batch id) of every committed log, by listing directories."""
        fs, path = self._fs("log")
        out = []
        if not fs.exists(path):
            return out
        for run in fs.listStatus(path):
            if not run.getPath().getName().startswith("run="):
                continue
            for log in fs.listStatus(run.getPath()):
                name = log.getPath().getName()
                if name.startswith("batch_id=") and self._committed(fs, log.getPath()):
                    out.append((run.getPath().getName()[4:], int(name[9:])))
        return sorted(out)

    def _fs(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._p(*parts))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _committed(self, fs, path) -> bool:
        return fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))

    def state(self) -> dict:
        """Current generation, folded batches, system id."""
        gen, folded, system_id, snap = None, set(), None, False
        for r in self._entries():
            if r["kind"] in ("snapshot", "compact"):
                gen = r["gen"]
                folded = set(filter(None, (r["folded"] or "").split(",")))
                snap = True
            if r["system_id"]:
                system_id = r["system_id"]
        return {"gen": gen, "folded": folded, "system_id": system_id,
                "snapshot_done": snap}

    # -- writes -------------------------------------------------------
    def seed(self, snapshot: DataFrame, snapshot_seq: int | None = None,
             force: bool = False) -> bool:
        """Write generation 0 from a snapshot - once (T6). Returns whether
        it wrote. ``snapshot_seq``: the feed position the snapshot is known
        to contain; changes at or before it lose to the snapshot rows."""
        done = self.state()["snapshot_done"]
        if done and not force:
            return False
        if not done and self.staged_batches():
            raise ValueError("changes were staged before the snapshot")
        seq = MIN_SEQ if snapshot_seq is None else snapshot_seq
        rows = snapshot.select(*[F.col(c) for c in self.columns],
                               F.lit(seq).cast("bigint").alias(SEQ),
                               F.lit(False).alias("_deleted"))
        rows.write.mode("overwrite").parquet(self._p("base", "gen=0"))
        self._record(kind="snapshot", gen=0, last_seq=snapshot_seq)
        return True

    def write_batch(self, changes: DataFrame, batch_id: int,
                    system_id: str | None = None, run: str = "direct") -> None:
        """Stage one micro-batch: its net change per key. Idempotent per
        ``run`` and ``batch_id``. The target must have been seeded (with an
        empty frame if it starts empty). Changes that leave columns unchanged
        need a target with ``unchanged=True``."""
        if not self.state()["snapshot_done"]:
            raise ValueError("seed the target before the first batch")
        fs, path = self._fs("log", f"run={run}", f"batch_id={batch_id}")
        if self._committed(fs, path):
            self._expect_replay(self._staged(changes), run, batch_id)
            return
        if self.unchanged and MOVED_FROM in changes.columns:
            changes = fill_moved(self.rows_of, changes, self.keys, self.columns)
        net = self._staged(changes)
        out = self._p("log", f"run={run}", f"batch_id={batch_id}")
        # Batch statistics ride along with the write (no second pass).
        obs = Observation(f"keelson_batch_{batch_id}")
        net = net.observe(obs, F.count(F.lit(1)).alias("n"),
                          F.min(SEQ).alias("lo"), F.max(SEQ).alias("hi"))
        net.write.mode("overwrite").parquet(out)
        stats = obs.get
        self.batch_stats[batch_id] = {"n_rows": stats["n"], "first_seq": stats["lo"],
                                      "last_seq": stats["hi"]}
        # The ledger records events that change how the table is read
        # (snapshot, compaction, the source identity) - not every batch,
        # whose own directory already says it is complete.
        if system_id and self.state()["system_id"] != system_id:
            self._record(kind="batch",
                         batch_id=batch_id, n_rows=stats["n"],
                         first_seq=stats["lo"], last_seq=stats["hi"],
                         system_id=system_id)

    def _staged(self, changes: DataFrame) -> DataFrame:
        """The rows of a batch's log."""
        if not self.unchanged:
            return net_changes(_refuse_unchanged(changes), self.keys).select(
                SEQ, OP, *[F.col(c) for c in self.columns])
        sub = F.col(SUB) if SUB in changes.columns else F.lit(0)
        unch = (F.col(UNCHANGED) if UNCHANGED in changes.columns
                else F.array().cast("array<string>"))
        return changes.select(SEQ, sub.cast("int").alias(SUB), OP,
                              *[F.col(c) for c in self.columns], unch.alias(UNCHANGED))

    def _expect_replay(self, net: DataFrame, run: str, batch_id: int) -> None:
        """A batch that is there already may only come again as it was; another
        batch of its name must not vanish."""
        def mark(df: DataFrame):
            return df.agg(F.count(F.lit(1)), F.min(SEQ), F.max(SEQ),
                          F.bit_xor(F.xxhash64(SEQ, OP, *self.keys))).first()
        there = mark(self._logs([(run, batch_id)]))
        if mark(net) != there:
            raise ValueError(f"batch {batch_id} of run {run!r} is committed with other changes "
                             f"(positions {there[1]} to {there[2]})")

    # -- reads --------------------------------------------------------
    def _base(self, gen: int) -> DataFrame:
        return self.spark.read.parquet(self._p("base", f"gen={gen}"))

    def _logs(self, batches: list[tuple[str, int]]) -> DataFrame:
        return self.spark.read.parquet(
            *[self._p("log", f"run={r}", f"batch_id={b}") for r, b in batches])

    def _merged(self, st: dict, batches: list[tuple[str, int]] | None = None,
                asked: DataFrame | None = None) -> DataFrame:
        """Base + logs that are not folded, with tombstones and ``_seq`` kept;
        with ``asked`` (a frame of keys), only rows of these keys.

        Nothing is computed here: a filter on the keys reaches the scans of
        the base and of the logs."""
        base = _rows_of(self._base(st["gen"]), asked, self.keys)
        if batches is None:
            batches = [x for x in self.staged_batches() if f"{x[0]}/{x[1]}" not in st["folded"]]
        if not batches:
            return base
        logs = _rows_of(self._logs(batches), asked, self.keys)
        if self.unchanged:
            return self._merged_unchanged(base, logs)
        net = net_changes(logs, self.keys)
        b, n = base.alias("b"), net.alias("n")
        match = _key_match("b", "n", self.keys)
        # Base rows with no newer change survive.
        kept = b.join(n, match & (F.col("n._seq") > F.col("b._seq")), "left_anti")
        # Changes older than the base row for their key are stale.
        # (Keys are taken from the base side, so a key filter reaches its scan.)
        stale = (b.join(n, match & (F.col("b._seq") >= F.col("n._seq")), "inner")
                 .select(*[F.col(f"b.{k}").alias(k) for k in self.keys]).distinct())
        fresh = net.join(stale, self.keys, "left_anti")
        changed = fresh.select(*[F.col(c) for c in self.columns], SEQ,
                               (F.col(OP) == DELETE).alias("_deleted"))
        return kept.select(*self.columns, SEQ, "_deleted").unionByName(changed)

    def _merged_unchanged(self, base: DataFrame, logs: DataFrame) -> DataFrame:
        """Like ``_merged``, column by column: a column takes the value of
        the newest change that sent it (or deleted the row) if that change
        is newer than the base row, else the base value."""
        data = [c for c in self.columns if c not in self.keys]
        net = net_with_unchanged(logs, self.keys, data, with_seq=True)
        b, n = base.alias("b"), net.alias("n")
        match = _key_match("b", "n", self.keys)
        newer = F.col("n._last_seq") > F.col("b._seq")
        kept = b.join(n, match & newer, "left_anti")
        hit = b.join(n, match, "inner")

        def pick(c: str, from_base: bool):
            s = F.col(f"n._set_{c}")
            sent = F.when(s["deleted"], F.lit(None)).otherwise(s["v"])
            if not from_base:
                return sent.alias(c)
            return F.when(s.isNotNull() & (s["seq"] > F.col("b._seq")), sent) \
                .otherwise(F.col(f"b.{c}")).alias(c)

        keys_n = [F.col(f"n.{k}").alias(k) for k in self.keys]
        last_del = (F.col("n._last_op") == DELETE).alias("_deleted")
        updated = hit.where(newer).select(
            *keys_n, *[pick(c, True) for c in data],
            F.col("n._last_seq").alias(SEQ), last_del)
        fresh = net.join(hit.select(*keys_n).distinct(), self.keys, "left_anti").alias("n")
        fresh = fresh.select(*keys_n, *[pick(c, False) for c in data],
                             F.col("n._last_seq").alias(SEQ), last_del)
        cols = [*self.columns, SEQ, "_deleted"]
        return (kept.select(*cols).unionByName(updated.select(*cols))
                .unionByName(fresh.select(*cols)))

    def current(self, with_seq: bool = False) -> DataFrame:
        """The target table as of the last staged batch."""
        m = self._merged(self.state()).where(~F.col("_deleted"))
        cols = self.columns + ([SEQ] if with_seq else [])
        return m.select(*cols)

    def rows_of(self, asked: DataFrame) -> DataFrame:
        """The rows of ``current`` whose keys are in ``asked``. Base and logs are
        scanned, but only rows of these keys are merged."""
        merged = self._merged(self.state(), asked=asked).where(~F.col("_deleted"))
        return merged.select(*self.columns)

    def compact(self, purge_tombstones_through: int | None = None) -> int:
        """Fold staged batches into a new base generation.

        Tombstones (deleted keys, with the position of the delete) are
        kept, so a late change older than the delete still loses to it.
        ``purge_tombstones_through``: a position no late change can
        precede any more (the lateness bound); tombstones at or before it
        are dropped."""
        st = self.state()
        batches = [x for x in self.staged_batches() if f"{x[0]}/{x[1]}" not in st["folded"]]
        if not batches:
            return st["gen"]
        gen = st["gen"] + 1
        merged = self._merged(st, batches)
        if purge_tombstones_through is not None:
            merged = merged.where(~F.col("_deleted") |
                                  (F.col(SEQ) > F.lit(purge_tombstones_through)))
        merged.write.mode("overwrite").parquet(self._p("base", f"gen={gen}"))
        folded = st["folded"] | {f"{r}/{b}" for r, b in batches}
        self._record(kind="compact", gen=gen, folded=",".join(sorted(folded)))
        return gen


    def vacuum(self, keep_generations: int = 1) -> dict:
        """Delete what the current generation has made obsolete: log
        directories already folded into it and base generations older than
        the newest ``keep_generations``. Like a table format's vacuum, a
        reader still scanning a deleted generation fails - run it after
        readers have moved on. Listing and deleting are directory
        operations on the driver (Hadoop FileSystem API), no data moves."""
        st = self.state()
        if st["gen"] is None:
            return {"logs": 0, "generations": 0}
        def children(sub: str):
            fs, path = self._fs(sub)
            if not fs.exists(path):
                return fs, []
            return fs, [(s.getPath(), s.getPath().getName()) for s in fs.listStatus(path)]

        removed = {"logs": 0, "generations": 0}
        for run, batch in self.staged_batches():
            if f"{run}/{batch}" in st["folded"]:
                fs, path = self._fs("log", f"run={run}", f"batch_id={batch}")
                fs.delete(path, True)
                removed["logs"] += 1
        oldest_kept = st["gen"] - max(1, keep_generations) + 1
        fs, gens = children("base")
        for path, name in gens:
            if name.startswith("gen=") and int(name.split("=")[1]) < oldest_kept:
                fs.delete(path, True)
                removed["generations"] += 1
        return removed


IDENTITY = "keelson.system_id"


def _refuse_unchanged(changes: DataFrame) -> DataFrame:
    """Fail on a change that left a column out, where that cannot be honoured."""
    if UNCHANGED not in changes.columns:
        return changes
    left = F.col(UNCHANGED)
    return changes.where(F.when(F.size(left) > 0, F.raise_error(F.lit(
        "a change leaves columns unchanged; use FileTarget(unchanged=True)")).cast("boolean"))
        .otherwise(F.lit(True)))


class CatalogTarget:
    """A catalog table with row-level changes. It must exist (K5)."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str]):
        if not spark.catalog.tableExists(name):
            raise ValueError(f"target table {name} does not exist")
        self.spark = spark
        self.name = name
        self.keys = list(keys)
        self.schema = spark.table(name).schema
        self.columns = [f.name for f in self.schema.fields]

    def seed(self, snapshot: DataFrame) -> bool:
        """Load a snapshot once (T6): only into an empty table. The probe
        reads at most one row."""
        if self.spark.table(self.name).limit(1).count() > 0:
            return False
        snapshot.select(*self.columns).write.insertInto(self.name)
        return True

    def write_batch(self, changes: DataFrame, batch_id: int,
                    system_id: str | None = None, run: str = "direct") -> None:
        """One MERGE per batch: deletes, updates and inserts commit
        together. Net changes first, so each target row meets one source
        row. A column that no change of the batch sent keeps the table's
        value. Replaying a batch converges to the same table. The source's
        identity is kept as a table property."""
        if MOVED_FROM in changes.columns:
            changes = fill_moved(self.rows_of, changes, self.keys, self.columns)
        if UNCHANGED not in changes.columns:
            changes = changes.withColumn(UNCHANGED, F.array().cast("array<string>"))
        data = [c for c in self.columns if c not in self.keys]
        net = net_with_unchanged(changes, self.keys, data)
        fields = [F.when(~F.col(f"_set_{c}.deleted"), F.col(f"_set_{c}.v")).alias(c)
                  for c in data]
        sent = [F.col(f"_set_{c}").isNotNull().alias(f"_sent_{c}") for c in data]
        net = net.select(*self.keys, F.col("_last_op").alias(OP), *fields, *sent)
        self.merge(net.alias("s"))
        if system_id and self.state()["system_id"] != system_id:
            self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES "
                           f"('{IDENTITY}' = '{system_id}')")

    def merge(self, net: DataFrame) -> None:
        """MERGE of ``net`` (alias s): keys, ``_op``, columns, ``_sent_<column>``."""
        cond = reduce(lambda a, b: a & b,
                      [F.col(f"s.{k}") == F.col(f"{self.name}.{k}")
                       for k in self.keys])
        values = {c: F.col(f"s.{c}") for c in self.columns}
        update = {c: v if c in self.keys else
                  F.when(F.col(f"s._sent_{c}"), v).otherwise(F.col(f"{self.name}.{c}"))
                  for c, v in values.items()}
        (net.mergeInto(self.name, cond)
         .whenMatched(F.col(f"s.{OP}") == DELETE).delete()
         .whenMatched().update(update)
         .whenNotMatched(F.col(f"s.{OP}") != DELETE).insert(values)
         .merge())

    def state(self) -> dict:
        """The recorded source identity."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        return {"system_id": {r["key"]: r["value"] for r in rows}.get(IDENTITY)}

    def current(self) -> DataFrame:
        return self.spark.table(self.name)

    def rows_of(self, asked: DataFrame) -> DataFrame:
        """The rows of ``current`` whose keys are in ``asked``."""
        return _rows_of(self.current(), asked, self.keys)


class CsvTarget:
    """Append-only delimited text files (K1, K2).

    Lines are COPY text: control characters, the delimiter and backslashes
    are escaped and NULL is ``\\N``, so any text survives - line feeds and
    empty text too. With ``keys``, a delete is written as its key only.
    """

    def __init__(self, spark: SparkSession, path: str, sep: str = ",",
                 with_op: bool = True, keys: Sequence[str] | None = None):
        self.spark = spark
        self.path = path
        self.sep = sep
        self.with_op = with_op
        self.keys = list(keys) if keys else None

    def _lines(self, changes: DataFrame) -> DataFrame:
        changes = _refuse_unchanged(changes)
        drop = [c for c in changes.columns if c.startswith("_") and
                not (self.with_op and c in (OP, SEQ))]
        rows = changes
        if self.keys is not None and OP in changes.columns:
            keep = {*self.keys, *META}
            rows = rows.select(*[
                F.col(c) if c in keep else
                F.when(F.col(OP) != DELETE, F.col(c)).alias(c) for c in rows.columns])
        rows = rows.drop(*drop)
        return rows.select(encode_line([F.col(c) for c in rows.columns], self.sep).alias("value"))

    def write_batch(self, changes: DataFrame, batch_id: int | None = None,
                    system_id: str | None = None, run: str = "direct") -> None:
        """Without ``batch_id`` the lines are appended. With one they go to a
        folder of that batch, which a replay writes again, so a batch is there
        once. A folder counts when its write has committed."""
        lines = self._lines(changes).write.option("lineSep", "\n")
        if batch_id is None:
            lines.mode("append").text(self.path)
        else:
            lines.mode("overwrite").text(os.path.join(self.path, f"run-{run}-batch-{batch_id}"))

    def stream_sink(self, changes: DataFrame, checkpoint: str):
        return (self._lines(changes).writeStream.format("text")
                .option("lineSep", "\n").option("path", self.path)
                .option("checkpointLocation", checkpoint))

    def read(self, schema: StructType) -> DataFrame:
        lines = self.spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
        return copy_lines_to_rows(lines.text(self.path), schema, "value", self.sep)


def target_schema(df: DataFrame, keys: Sequence[str]) -> StructType:
    """Target schema from a frame: its data columns, keys NOT NULL."""
    fields = []
    for f in df.schema.fields:
        if f.name.startswith("_"):
            continue
        fields.append(StructField(f.name, f.dataType, f.name not in keys))
    return StructType(fields)
