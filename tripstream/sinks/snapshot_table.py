"""Append-only trip table with snapshots, on plain Parquet.

Layout under ``path``::

    data/snapshot_seq=N/pickup_day=D/part-*.parquet   13 trip columns
    rejects/snapshot_seq=N/part-*.parquet             reject rows of that append
    commits/log_epoch=E/commit=N/part-*.parquet       one row per append, E = N // LOG_EPOCH

An append writes its rows into a new ``snapshot_seq`` folder (overwriting a
leftover of a failed try), then adds its commit row. Only committed
sequence numbers are read, so a read "as of N" is the partition filter
``snapshot_seq <= N`` that Spark prunes at file listing.

The commit log is one small row per append, in a folder of its own. The newest
sequence number is known from the folder names of the last ``log_epoch`` alone,
so a read of the current table runs no job before its scan; lookups by id or time
are filters over the log. Log files are only ever added. Each commit row holds
the last batch id of every query so far: an append whose batch is above its query's
is new, and only another one is looked for in the log. One found there is a
replay (batch ids start at 0 for each stream) and does nothing.
"""

from __future__ import annotations

import datetime as _dt
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from tripstream.config import scratch_root
from tripstream.operators.quality import counts_of, good_rows, reject_rows
from tripstream.sinks.day_ranges import day_ranges, in_ranges
from tripstream.schema import COMMIT_SCHEMA, REJECT_SCHEMA, TRIP_COLUMNS, TRIP_SCHEMA


@dataclass(frozen=True)
class WriteTuning:
    """Parquet writer settings (K5).

    Defaults are sized for large tables (128 MiB row groups). ``reference()``
    gives the reference's values: zstd, 5 MiB row groups, 1 MiB pages,
    2 MiB dictionary pages, about 1 MiB files.
    """

    compression: str = "zstd"
    row_group_bytes: int = 128 << 20
    page_bytes: int = 1 << 20
    dictionary_page_bytes: int = 2 << 20
    max_records_per_file: int = 0
    target_file_bytes: int = 0       # 0: files as the rebalance makes them

    @classmethod
    def reference(cls) -> "WriteTuning":
        # The reference's table properties.
        return cls(compression="zstd", row_group_bytes=5242880, page_bytes=1048576,
                   dictionary_page_bytes=2097152, target_file_bytes=1048576)

    def options(self) -> dict[str, str]:
        o = {
            "compression": self.compression,
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.dictionary.page.size": str(self.dictionary_page_bytes),
        }
        if self.max_records_per_file:
            o["maxRecordsPerFile"] = str(self.max_records_per_file)
        return o


class SnapshotNotFound(LookupError):
    pass


LOG_EPOCH = 1000                 # commits per log folder
SAMPLE_ROWS = 20_000             # rows written to learn a batch's width in bytes
_PARTITIONS = "snapshot_seq int, pickup_day date"


def _new_snapshot_id() -> int:
    return random.SystemRandom().randint(1, (1 << 63) - 1)


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, tuning: WriteTuning = WriteTuning()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.tuning = tuning

    # ---- locations -------------------------------------------------
    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def rejects_path(self) -> str:
        return f"{self.path}/rejects"

    @property
    def commits_path(self) -> str:
        return f"{self.path}/commits"

    def _commit_path(self, seq: int) -> str:
        return f"{self.commits_path}/log_epoch={seq // LOG_EPOCH}/commit={seq}"

    # ---- file listing (folder names only, on the driver) -----------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        return [st.getPath().getName() for st in fs.listStatus(p)]

    def _numbers(self, path: str, field: str) -> list[int]:
        """Values of the folders ``field=N`` under ``path``, largest first."""
        return sorted((int(n.split("=", 1)[1]) for n in self._names(path) if n.startswith(f"{field}=")), reverse=True)

    def last_seq(self) -> int | None:
        """The newest committed sequence number, from folder names (0: nothing
        appended yet, None: no table). A commit whose write broke off has no file."""
        for e in self._numbers(self.commits_path, "log_epoch"):
            for n in self._numbers(f"{self.commits_path}/log_epoch={e}", "commit"):
                if any(x.startswith("part-") for x in self._names(self._commit_path(n))):
                    return n
        return None

    def partition_fields(self) -> list[str]:
        """Partition fields, from the names of the data folders."""
        out, path = [], self.data_path
        while fields := sorted(n for n in self._names(path) if "=" in n and not n.startswith(("_", "."))):
            out.append(fields[0].split("=", 1)[0])
            path = f"{path}/{fields[0]}"
        return out

    # ---- creation (K3) -----------------------------------------------
    def exists(self) -> bool:
        return self.last_seq() is not None

    def ensure(self) -> bool:
        """Create the table if missing; True when it was created now."""
        if self.exists():
            return False
        # an empty first folder gives readers by path, and catalog views, the schema
        (self.spark.createDataFrame([], TRIP_SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.data_path}/snapshot_seq=0/pickup_day=1970-01-01"))
        (self.spark.createDataFrame([], REJECT_SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.rejects_path}/snapshot_seq=0"))
        (self.spark.createDataFrame([], COMMIT_SCHEMA).coalesce(1)
         .write.mode("errorifexists").parquet(self._commit_path(0)))
        return True

    # ---- commit log (S6, S7) --------------------------------------------
    def log(self) -> DataFrame:
        """All commit rows (one per append)."""
        if not self.exists():
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(self.commits_path).select(*COMMIT_SCHEMA.fieldNames())

    def _commit_row(self, seq: int | None):
        """The row of one commit, from its folder only."""
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(self._commit_path(seq)).first() if seq else None

    def last_commit(self):
        """The newest commit row; None if none."""
        return self._commit_row(self.last_seq())

    def snapshots(self) -> DataFrame:
        """``committed_at, snapshot_id, parent_id, operation, added_rows``."""
        return self.log().select("committed_at", "snapshot_id", "parent_id", "operation", "added_rows")

    def history(self) -> DataFrame:
        """``made_current_at, snapshot_id, parent_id, is_current_ancestor``.

        Appends only, so every snapshot is an ancestor of the current one.
        """
        return self.log().select(
            F.col("committed_at").alias("made_current_at"), "snapshot_id", "parent_id",
            F.lit(True).alias("is_current_ancestor"))

    def rows_per_snapshot(self) -> DataFrame:
        """``snapshot_id, row_count``: rows that the table holds for each snapshot."""
        counts = (self._read_upto(self.last_seq()).groupBy("snapshot_seq")
                  .agg(F.count(F.lit(1)).alias("n")))
        return (self.log().join(counts, "snapshot_seq", "left")
                .select("snapshot_id", F.coalesce("n", F.lit(0)).alias("row_count")))

    # ---- append (K1, K2, K4, K5) ---------------------------------------
    def _replayed(self, last, batch_id: int | None, query_id: str | None):
        """The commit row of a batch, where ``last`` is the newest one."""
        if batch_id is None or last is None:
            return None
        if last.batches is not None and batch_id > last.batches.get(query_id or "", -1):
            return None
        if (last.batch_id, last.query_id) == (batch_id, query_id):
            return last
        return (self.log().where((F.col("batch_id") == F.lit(batch_id)) & F.col("query_id").eqNullSafe(F.lit(query_id)))
                .orderBy("snapshot_seq").first())

    def committed(self, batch_id: int | None, query_id: str | None = None):
        """The commit row of a batch of a query; None if it was not committed.

        A new batch (above its query's last one) is known from the newest commit
        row; only an older one is looked for in the whole log.
        """
        return None if batch_id is None else self._replayed(self.last_commit(), batch_id, query_id)

    def append(self, trips: DataFrame, batch_id: int | None = None,
               snapshot_id: int | None = None, committed_at: _dt.datetime | None = None,
               rejects: DataFrame | None = None, query_id: str | None = None):
        """Append rows as one new snapshot; returns its commit row.

        ``trips`` holds the 13 trip columns. A (``query_id``, ``batch_id``) already in
        the log makes the call a no-op returning that commit (replay after a
        restart); another query's batch of the same number is a new one.
        """
        self.ensure()
        last = self.last_commit()
        hit = self._replayed(last, batch_id, query_id)
        if hit:
            return hit
        seq = (last.snapshot_seq + 1) if last else 1
        parent = last.snapshot_id if last else None
        obs = Observation(f"append_{seq}")
        out = (trips.select(*TRIP_COLUMNS)
               .withColumn("pickup_day", F.to_date("tpep_pickup_datetime"))
               .observe(obs, F.count(F.lit(1)).alias("rows")))
        (self._into_files(out).write.mode("overwrite")
         .options(**self.tuning.options()).partitionBy("pickup_day")
         .parquet(f"{self.data_path}/snapshot_seq={seq}"))
        added = counts_of(obs, "rows")["rows"]
        if rejects is not None:
            (rejects.write.mode("overwrite").options(compression=self.tuning.compression)
             .parquet(f"{self.rejects_path}/snapshot_seq={seq}"))
        batches = dict(last.batches or {}) if last else {}
        if batch_id is not None:
            batches[query_id or ""] = max(batch_id, batches.get(query_id or "", -1))
        row = (seq, snapshot_id if snapshot_id is not None else _new_snapshot_id(), parent,
               committed_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
               "append", int(added), batch_id, query_id, batches)
        (self.spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(self._commit_path(seq)))
        return self.spark.createDataFrame([row], COMMIT_SCHEMA).first()

    def _into_files(self, rows: DataFrame) -> DataFrame:
        """The rows dealt to tasks as they are to lie in files.

        Without a target size: rebalanced by day, few files per day, and skewed days
        split by AQE. With one: each day gets as many files as its rows need at the
        batch's own width, measured by writing ``SAMPLE_ROWS`` of them with the table's
        settings; a row's file is chosen by its hash, so a day's files are alike.
        """
        target = self.tuning.target_file_bytes
        if not target:
            return rows.hint("rebalance", "pickup_day")
        sample = scratch_root(self.spark, "row-width")
        seen = Observation()
        (rows.limit(SAMPLE_ROWS).observe(seen, F.count(F.lit(1)).alias("n")).coalesce(1)
         .write.options(**self.tuning.options()).parquet(sample))
        fs, p = self._fs(sample)
        size = sum(st.getLen() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-"))
        fs.delete(p, True)
        width = size / max(1, counts_of(seen, "n")["n"])
        # a row per day of this append; files numbered from 0 without gaps over all days
        files, first = [], 0
        for day in rows.groupBy("pickup_day").agg(F.count(F.lit(1)).alias("n")).orderBy("pickup_day").collect():
            n = max(1, round(day.n * width / target))
            files.append((day.pickup_day, n, first))
            first += n
        known = self.spark.createDataFrame(files, "day date, files long, first long")
        place = F.col("first") + F.pmod(F.xxhash64(*TRIP_COLUMNS), F.col("files"))
        dealt = rows.join(F.broadcast(known), F.col("pickup_day").eqNullSafe(F.col("day")))
        return dealt.repartitionById(max(1, first), place.cast("int")).drop("day", "files", "first")

    def append_checked(self, checked: DataFrame, persist: bool = True, **kw):
        """Append the good rows of a checked frame and keep its rejects.

        The checked frame is persisted for the two writes (one micro-batch)
        unless the caller has done so.
        """
        if persist:
            checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self.append(good_rows(checked), rejects=reject_rows(checked), **kw)
        finally:
            if persist:
                checked.unpersist()

    # ---- reads (S4, Z1-Z9) ---------------------------------------------
    def _read_upto(self, seq: int | None) -> DataFrame:
        if seq is None:
            return self.spark.createDataFrame([], TRIP_SCHEMA.add("snapshot_seq", "int").add("pickup_day", "date"))
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRIP_SCHEMA)
        return (self.spark.read.schema(f"{fields}, {_PARTITIONS}").parquet(self.data_path)
                .where(F.col("snapshot_seq") <= F.lit(seq)))

    def current(self) -> DataFrame:
        return self._read_upto(self.last_seq()).select(*TRIP_COLUMNS)

    def where(self, condition: str | Column) -> DataFrame:
        """K4: current rows that fulfil a condition on the 13 columns; only the folders
        of days that it can hold for are read, as far as it bounds the pickup time."""
        cond = F.expr(condition) if isinstance(condition, str) else condition
        empty = self.spark.createDataFrame([], TRIP_SCHEMA)
        days = day_ranges(empty.where(cond), "tpep_pickup_datetime")
        rows = self._read_upto(self.last_seq())
        if days is not None:
            rows = rows.where(in_ranges(F.col("pickup_day"), days))
        return rows.where(cond).select(*TRIP_COLUMNS)

    def between(self, start: _dt.datetime, end: _dt.datetime) -> DataFrame:
        """K4: current rows picked up from ``start`` to before ``end``; only the
        folders of those days are read."""
        lo, hi = (F.lit(_to_datetime(x).isoformat(sep=" ")).cast("timestamp_ntz") for x in (start, end))
        return (self._read_upto(self.last_seq())
                .where(F.col("pickup_day").between(F.lit(_to_datetime(start).date()), F.lit(_to_datetime(end).date()))
                       & (F.col("tpep_pickup_datetime") >= lo) & (F.col("tpep_pickup_datetime") < hi))
                .select(*TRIP_COLUMNS))

    def rows_per_day(self) -> DataFrame:
        """K4: ``pickup_day, trips`` of the current table; only folder names and row counts are read."""
        return (self._read_upto(self.last_seq()).groupBy("pickup_day")
                .agg(F.count(F.lit(1)).alias("trips")))

    def rejects(self) -> DataFrame:
        """Reject rows of all committed appends, with their ``snapshot_seq``."""
        last = self.last_seq()
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in REJECT_SCHEMA) + ", snapshot_seq int"
        if last is None:
            return self.spark.createDataFrame([], fields)
        return (self.spark.read.schema(fields).parquet(self.rejects_path)
                .where(F.col("snapshot_seq") <= last))

    def seq_of(self, snapshot_id: int) -> int:
        hit = self.log().where(F.col("snapshot_id") == F.lit(snapshot_id)).select("snapshot_seq").first()
        if hit is None:
            raise SnapshotNotFound(f"snapshot id {snapshot_id} is not in the commit log")
        return hit.snapshot_seq

    def as_of(self, snapshot_id: int | None = None, timestamp=None,
              on_error: str = "raise") -> DataFrame:
        """Read the table as of a snapshot.

        Precedence (Z9): a positive ``snapshot_id``, else ``timestamp`` (rows
        committed at or before it), else the previous snapshot (second
        newest by commit time). With one snapshot or none, the previous one
        is the current table (Z4). ``on_error="current"`` turns an unknown id
        or a too-early timestamp into the current table (Z4, Z7).
        """
        try:
            if snapshot_id is not None and snapshot_id > 0:
                return self._read_upto(self.seq_of(snapshot_id)).select(*TRIP_COLUMNS)
            if timestamp is not None:
                ts = _to_datetime(timestamp)
                bound = F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
                top = (self.log().where(F.col("committed_at") <= bound)
                       .agg(F.max("snapshot_seq")).first()[0])
                if top is None:
                    raise SnapshotNotFound(f"no snapshot committed at or before {ts}")
                return self._read_upto(top).select(*TRIP_COLUMNS)
            prev = (self.log().orderBy(F.col("committed_at").desc(), F.col("snapshot_seq").desc())
                    .offset(1).limit(1).select("snapshot_seq").first())
            if prev is not None:
                return self._read_upto(prev.snapshot_seq).select(*TRIP_COLUMNS)
            return self.current()
        except SnapshotNotFound:
            if on_error == "current":
                return self.current()
            raise

    # ---- catalog (K6) ---------------------------------------------------
    def register(self, name: str) -> bool:
        """Make the catalog view ``name``: always the current table.

        The view asks the commit log each time it is read, so it sees later
        appends. A failure only warns.
        """
        cols = ", ".join(f"`{c}`" for c in TRIP_COLUMNS)
        try:
            self.ensure()
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {name} AS SELECT {cols} FROM parquet.`{self.data_path}` "
                f"WHERE snapshot_seq <= (SELECT max(snapshot_seq) FROM parquet.`{self.commits_path}`)")
            return True
        except Exception as e:  # noqa: BLE001 - the reference only warns here
            import warnings

            warnings.warn(f"could not register {name}: {e}; use path access")
            return False

    def register_functions(self, prefix: str = "trips") -> None:
        """Z5 in SQL: temporary table functions over this table.

        * ``{prefix}_as_of(snapshot_id)``: the table as of a snapshot;
        * ``{prefix}_at(time)``: as of the last commit at or before a time;
        * ``{prefix}_between(start, end)``: current rows picked up in that time.

        The commit log is read by a subquery of the query itself, so the folders
        are pruned when it runs and nothing runs before it. An unknown id, or
        a time before the first commit, is an error when it runs.
        """
        self.ensure()
        cols = ", ".join(f"`{c}`" for c in TRIP_COLUMNS)
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TRIP_SCHEMA)
        # A parameter cannot stand inside a subquery, nor a subquery inside a lambda: the
        # log's few numbers come out of it as a map, or as two sorted lists.
        commits = f"FROM parquet.`{self.commits_path}`"

        def define(name: str, params: str, top: str, missing: str, more: str = "") -> None:
            self.spark.sql(
                f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}_{name}({params}) RETURNS TABLE({types}) RETURN "
                f"SELECT {cols} FROM parquet.`{self.data_path}` "
                f"WHERE snapshot_seq <= coalesce({top}, CAST(raise_error({missing}) AS INT)){more}")

        by_id = (f"(SELECT map_from_entries(collect_list(struct(snapshot_id, top))) FROM "
                 f"(SELECT snapshot_id, max(snapshot_seq) AS top {commits} GROUP BY snapshot_id))")
        define("as_of", "id BIGINT", f"{by_id}[id]", "concat('snapshot id ', id, ' is not in the commit log')")
        # a snapshot is seen from the earliest commit time of it and all later ones on
        lists = (f"(SELECT struct(sort_array(collect_list(since)) AS t, sort_array(collect_list(snapshot_seq)) AS q) FROM "
                 f"(SELECT snapshot_seq, min(committed_at) OVER (ORDER BY snapshot_seq "
                 f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS since {commits}))")
        later = f"array_position(sort_array(array_append({lists}.t, ts), false), ts)"      # 1 + times after ts
        define("at", "ts TIMESTAMP_NTZ", f"get({lists}.q, CAST(size({lists}.t) - {later} AS INT))",
               "concat('no snapshot committed at or before ', ts)")
        define("between", "lo TIMESTAMP_NTZ, hi TIMESTAMP_NTZ", f"(SELECT max(snapshot_seq) {commits})", "'empty log'",
               " AND pickup_day BETWEEN CAST(lo AS DATE) AND CAST(hi AS DATE) "
               "AND tpep_pickup_datetime >= lo AND tpep_pickup_datetime < hi")


def _to_datetime(ts) -> _dt.datetime:
    if isinstance(ts, _dt.datetime):
        return ts.replace(tzinfo=None) if ts.tzinfo is None else ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    if isinstance(ts, (int, float)):
        return _dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=ts)
    return _dt.datetime.fromisoformat(str(ts))
