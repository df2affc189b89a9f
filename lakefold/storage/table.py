"""Archive tables on plain Parquet: save, merge, read back, compact, describe
(K1-K6, K8).

No row-level table format is on the class path, so a table is an
append-only change log plus a tiny commit log, all written by Spark:

    <root>/gen=<g>/_seq=<n>/<partition cols>/part-*.parquet   change log
    <root>/_commits/part-*.json                               one row per commit

* merge of batch n: drop null keys, dedup the batch per key, join it with the
  current state's (keys, hash) only, write new or changed rows to
  ``gen=g/_seq=n`` (unchanged rows cost nothing on disk), then commit.
* current state = the rows of the newest committed generation; with keys, the
  later sequences replace earlier rows of the same key (an anti join of the
  base against the later keys + a partial-aggregate dedup of the later rows).
* overwrite and compaction write generation g+1 and then commit it; the path
  being read is never overwritten.
* a stream's batch is told by (stream, batch) in its commit row, with a digest
  of its input: the same batch again changes nothing, other content under the
  same name is refused.  Numbers of different streams never meet.
* a table is either keyed (merge) or not (append); mixing the two is refused.
  Columns may be added; missing ones and changed types are refused.

Single writer; readers only trust committed (gen, seq) pairs.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.functions.hashing import METADATA_COLUMNS, add_metadata, ident
from lakefold.operators.fold import join_null_safe
from lakefold.operators.merge import ACTION, INSERT, UNCHANGED, UPDATE, dedup_latest, merge_changes, null_key
from lakefold.schemas import CONTENT_HASH
from lakefold.session import scratch_table

COMMITS = "_commits"
_SLICE_ROWS = 2_000_000  # rows that are written together where the input is not persisted, about
_MOST_SLICES = 8         # of these slices: each reads the input again
COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("gen", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("mode", T.StringType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("partition_by", T.ArrayType(T.StringType())),
        T.StructField("schema", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("digest", T.LongType()),
    ]
)


@dataclass
class Commit:
    gen: int
    seq: int
    mode: str
    keys: list[str]
    partition_by: list[str]
    schema: T.StructType
    committed_at: _dt.datetime
    rows_written: int
    stream: str | None = None
    batch: int | None = None
    digest: int | None = None


class ArchiveTable:
    """One archive table at ``path`` (any Hadoop file system URI)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # ------------------------------------------------------------------ log
    def commits(self) -> list[Commit]:
        """Committed (gen, seq) pairs, oldest first; [] when absent (K4).

        One row per commit, so this stays small; it is the only thing that
        reaches the driver."""
        try:
            rows = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/{COMMITS}").orderBy("gen", "seq").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # only a missing path means that there is no table
            return []
        return [
            Commit(r.gen, r.seq, r.mode, list(r["keys"] or []), list(r.partition_by or []),
                   T.StructType.fromJson(json.loads(r.schema)), r.committed_at, r.rows_written, r.stream, r.batch, r.digest)
            for r in rows
        ]

    def exists(self) -> bool:
        return bool(self.commits())

    def _commit(self, gen: int, seq: int, mode: str, keys, partition_by, schema: T.StructType, rows: int,
                replay: tuple[str, int] | None = None, digest: int | None = None) -> None:
        row = (gen, seq, mode, list(keys or []), list(partition_by or []), schema.json(),
               _dt.datetime.now(_dt.timezone.utc), rows, *(replay or (None, None)), digest)
        self.spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").json(f"{self.path}/{COMMITS}")

    def _current_commits(self) -> list[Commit]:
        cs = self.commits()
        if not cs:
            return []
        gen = cs[-1].gen
        return [c for c in cs if c.gen == gen]

    def _seq_path(self, gen: int, seq: int) -> str:
        return f"{self.path}/gen={gen}/_seq={seq}"

    def _read(self, commits: Sequence[Commit], schema: T.StructType) -> DataFrame:
        """Rows of the given commits with the declared schema (partition
        column types are never inferred), plus ``_seq``."""
        full = T.StructType(list(schema.fields) + [T.StructField("gen", T.LongType()), T.StructField("_seq", T.LongType())])
        written = [c for c in commits if c.rows_written > 0]
        if not written:
            return self.spark.createDataFrame([], full).drop("gen")
        paths = [self._seq_path(c.gen, c.seq) for c in written]
        df = self.spark.read.schema(full).option("basePath", self.path).parquet(*paths)
        return df.drop("gen")

    # ---------------------------------------------------------------- reads
    def schema(self) -> T.StructType | None:
        cur = self._current_commits()
        return cur[-1].schema if cur else None

    def read_log(self) -> DataFrame:
        """Change log of the current generation (all versions, with ``_seq``)."""
        cur = self._current_commits()
        if not cur:
            raise FileNotFoundError(self.path)
        return self._read(cur, cur[-1].schema)

    def current(self, columns: Sequence[str] | None = None) -> DataFrame:
        """The current state (one row per key when the table has keys).

        ``columns`` narrows the scan (e.g. keys + hash for a merge).
        """
        cur = self._current_commits()
        if not cur:
            raise FileNotFoundError(self.path)
        schema = cur[-1].schema
        keys = next((c.keys for c in reversed(cur) if c.keys), [])
        want = list(columns) if columns else schema.fieldNames()
        log = self._read(cur, schema)
        keyed_seqs = [c.seq for c in cur if c.rows_written > 0]
        if not keys or len(keyed_seqs) <= 1:
            return log.select(*map(ident, want))
        first = keyed_seqs[0]
        base = log.filter(F.col("_seq") == first)
        later = log.filter(F.col("_seq") > first)
        need = list(dict.fromkeys(list(keys) + want))
        later = dedup_latest(later.select(*map(ident, need), "_seq"), keys, ["_seq"]).drop("_seq")
        base = base.select(*map(ident, need)).join(later.select(*map(ident, keys)), list(keys), "left_anti")
        return base.unionByName(later).select(*map(ident, want))

    # ---------------------------------------------------------------- write
    def save(
        self,
        df: DataFrame,
        mode: str = "append",
        keys: Sequence[str] | None = None,
        partition_by: Sequence[str] | None = None,
        add_meta: bool = True,
        ingestion_ts: _dt.datetime | None = None,
        hash_exclude: Sequence[str] | None = None,
        replay: tuple[str, int] | None = None,
        cache_input: bool = True,
        told: DataFrame | None = None,
        taken: Callable[[DataFrame], Sequence[DataFrame]] | None = None,
    ) -> dict:
        """K1: append / overwrite / merge; returns exact statistics.

        ``replay`` names a stream's batch, (stream, number): if it is in the
        table already with the same content, nothing is written; other
        content is refused.  ``cache_input=False`` re-reads the source for
        the counting passes instead of persisting it (for a first load much
        larger than the cluster's spare disk).  ``told``: the keys, order
        and hash of all rows of a merge, where they are stored already; what
        changed is then found out from these.  ``taken`` gives the rows for
        the changed rows of ``told`` (all its columns, and the action), in
        parts that are written one after the other; no row of ``df`` is then
        looked for by its key.
        """
        if mode not in ("append", "overwrite", "merge"):
            raise ValueError(f"unknown mode {mode}")
        if mode == "merge" and not keys:
            raise ValueError("merge needs keys")
        started = time.time()
        ts = ingestion_ts or _dt.datetime.now(_dt.timezone.utc)
        df = df.drop(ACTION)  # the tag of an earlier merge is no data
        if add_meta:
            df = add_metadata(df, ts, hash_exclude)
        stats = {"mode": mode, "timestamp": ts.isoformat(), "table_created": False}
        cur = self._current_commits()
        partition_by = list(partition_by or (cur[-1].partition_by if cur else []))
        data_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        done = next((c for c in cur if replay and (c.stream, c.batch) == tuple(replay)), None)
        base_keys_hash = None
        if not cur or mode == "overwrite":
            gen, next_seq = (cur[-1].gen + 1 if cur else 0), 0
            stats["table_created"] = not cur
        else:
            gen, next_seq = cur[-1].gen, max(c.seq for c in cur) + 1
            stored_keys = next((c.keys for c in cur if c.keys), [])
            if (mode == "merge") != bool(stored_keys):
                raise ValueError(f"{mode} into a table {'with keys ' + ', '.join(stored_keys) if stored_keys else 'without keys'}")
            if mode == "merge" and stored_keys and list(keys) != stored_keys:
                raise ValueError(f"the table's keys are {', '.join(stored_keys)}")
            data_schema = self._widened(cur[-1].schema, data_schema)
            df = df.select(*(ident(f.name) for f in data_schema.fields))
            if mode == "merge":
                base_keys_hash = self.current(list(keys) + [CONTENT_HASH])

        # The input is scanned once: it is persisted (memory, spilling to
        # disk; lost blocks are recomputed from lineage), counted, then merged.
        if cache_input:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
        tagged = None
        try:
            if mode == "merge":
                bad = null_key(keys)
                digest = F.bit_xor(F.xxhash64(*map(ident, keys), ident(CONTENT_HASH))) if CONTENT_HASH in df.columns else F.lit(None)
                narrow = df if told is None else told
                head = narrow.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("null_keys"), digest.alias("digest")).collect()[0]
                stats["input_rows"], stats["null_key_rows"] = int(head["n"]), int(head["null_keys"])
                if done is not None:
                    if done.digest != head["digest"]:
                        raise ValueError(f"batch {done.batch} of stream {done.stream} is stored with other content")
                    return stats | {"replayed": True, "rows_inserted": 0, "rows_updated": 0, "rows_written": 0, "files_written": 0,
                                    "rows_unchanged": 0, "duplicate_rows": 0}
                clean = df.filter(~bad)
                # Only keys, order and hash are moved to find out what changed; the rows follow for changed keys.
                order = [c for c in ["_seq", "UpdatedAt"] if c in clean.columns and c not in keys]
                cols = [*keys, *order, CONTENT_HASH]
                extra = [c for c in narrow.columns if c not in cols] if taken else []
                tagged = merge_changes(base_keys_hash, dedup_latest(narrow.filter(~bad).select(*map(ident, [*cols, *extra])), keys, order), keys)
                if taken:
                    tagged = scratch_table(tagged, "changes")
                if cache_input:
                    tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
                by = {r[ACTION]: int(r["count"]) for r in tagged.groupBy(ACTION).count().collect()}
                stats["duplicate_rows"] = stats["input_rows"] - stats["null_key_rows"] - sum(by.values())
                stats["rows_unchanged"] = by.get(UNCHANGED, 0)
                changed = tagged.filter(F.col(ACTION).isin(INSERT, UPDATE))
                if taken:
                    parts = [p.select(*(ident(f.name) for f in data_schema.fields), ACTION) for p in taken(changed)]
                elif base_keys_hash is None and not stats["duplicate_rows"]:
                    out = clean.withColumn(ACTION, F.lit(INSERT))  # every row is new
                else:
                    out = join_null_safe(clean, changed, cols, "inner")
                    if stats["duplicate_rows"]:  # rows that repeat a key's latest version
                        out = out.dropDuplicates(list(keys))
            else:
                stats["input_rows"] = df.count()
                out = df.withColumn(ACTION, F.lit(INSERT))
            # One after the other: only a part of the rows is shuffled at a time.
            if not taken:
                slices = 1 if cache_input or mode != "merge" else min(_MOST_SLICES, max(1, -(-stats["input_rows"] // _SLICE_ROWS)))
                by_key = F.pmod(F.xxhash64(*map(ident, keys)), F.lit(slices)) if slices > 1 else None
                parts = [out if slices == 1 else out.filter(by_key == k) for k in range(slices)]
            for k, part in enumerate(parts):
                self._write(part, gen, next_seq, partition_by, "append" if k else "overwrite")
        finally:
            if cache_input:
                if tagged is not None:
                    tagged.unpersist()
                df.unpersist()

        target = self._seq_path(gen, next_seq)
        back = self.spark.read.schema(T.StructType([*data_schema.fields, T.StructField(ACTION, T.StringType())])).parquet(target)
        # Exact counts of what landed on disk, in one small job.
        w = back.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(ACTION) == INSERT).alias("ins"),
            F.count_if(F.col(ACTION) == UPDATE).alias("upd"),
            F.count_distinct(F.col("_metadata.file_path")).alias("files"),
        ).collect()[0]
        stats["rows_written"] = int(w["rows"])
        stats["rows_inserted"] = int(w["ins"])
        stats["rows_updated"] = int(w["upd"])
        stats["files_written"] = int(w["files"])
        self._commit(gen, next_seq, mode, keys, partition_by, data_schema, stats["rows_written"], replay,
                     int(head["digest"]) if mode == "merge" and head["digest"] is not None else None)
        stats["gen"], stats["seq"] = gen, next_seq
        stats["seconds"] = round(time.time() - started, 3)
        return stats

    def _write(self, out: DataFrame, gen: int, seq: int, partition_by: Sequence[str], how: str = "overwrite") -> None:
        """Write one change-log folder (overwrite: a replayed batch replaces
        only its own folder), or add a slice to it."""
        # Rebalance on the partition columns: AQE splits a hot partition value
        # into several files and packs small ones, instead of one task per value.
        writer_df = out.hint("rebalance", *partition_by) if partition_by else out
        w = writer_df.write.mode(how).option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self._seq_path(gen, seq))

    @staticmethod
    def _widened(stored: T.StructType, new: T.StructType) -> T.StructType:
        """The stored columns and then the added ones; a missing column or a
        changed type is refused."""
        types = {f.name: f.dataType for f in new.fields}
        missing = [f.name for f in stored.fields if f.name not in types]
        changed = [f.name for f in stored.fields if f.name in types and types[f.name] != f.dataType]
        if missing or changed:
            raise ValueError(f"columns missing from the batch: {missing}; with another type: {changed}")
        have = set(stored.fieldNames())
        return T.StructType([*stored.fields, *(f for f in new.fields if f.name not in have)])

    # ---------------------------------------------------------- maintenance
    def compact(self, target_file_bytes: int = 128 * 1024 * 1024) -> dict:
        """K6: rewrite the current state as a new generation, files sized from
        the measured bytes per partition; the row set is unchanged."""
        cur = self._current_commits()
        if not cur:
            raise FileNotFoundError(self.path)
        before = self.files().agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b"), F.sum("rows").alias("r")).collect()[0]
        state = self.current()
        parts = cur[-1].partition_by
        keys = next((c.keys for c in reversed(cur) if c.keys), [])
        gen = cur[-1].gen + 1
        target = self._seq_path(gen, 0)
        # Rebalancing packs small partition values and splits large ones into
        # files of the session's advisory size; no value goes to one task whole.
        out = state.withColumn(ACTION, F.lit(INSERT)).hint("rebalance", *parts)
        w = out.write.mode("overwrite").option("maxRecordsPerFile", self._rows_a_file(before, target_file_bytes))
        if parts:
            w = w.partitionBy(*parts)
        w.parquet(target)
        written = T.StructType([*cur[-1].schema.fields, T.StructField(ACTION, T.StringType())])
        rows = self.spark.read.schema(written).parquet(target).count()
        self._commit(gen, 0, "compact", keys, parts, cur[-1].schema, rows)
        after = self.files().count()
        return {"path": self.path, "files_removed": int(before["n"]), "files_added": int(after), "gen": gen}

    @staticmethod
    def _rows_a_file(before, target_file_bytes: int) -> int:
        """Rows that fill a file of the target size, at the measured bytes a row."""
        return max(1, int(target_file_bytes * (before["r"] or 1) / max(1, before["b"] or 1)))

    def files(self) -> DataFrame:
        """Data files of the current generation with sizes and row counts."""
        cur = self._current_commits()
        if not any(c.rows_written for c in cur):
            return self.spark.createDataFrame([], "file string, bytes long, rows long")
        log = self._read(cur, cur[-1].schema)
        return log.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
            F.count(F.lit(1)).alias("rows")
        )

    def partitions(self) -> DataFrame:
        """K8: files, rows and bytes per partition value of the current
        generation's log."""
        cur = self._current_commits()
        if not cur:
            raise FileNotFoundError(self.path)
        parts = cur[-1].partition_by
        log = self._read(cur, cur[-1].schema)
        if not any(c.rows_written for c in cur):
            return log.groupBy(*map(ident, parts)).agg(*(F.count(F.lit(1)).alias(n) for n in ("files", "rows", "bytes")))
        per_file = log.groupBy(*map(ident, parts), F.col("_metadata.file_path").alias("_f"),
                               F.col("_metadata.file_size").alias("_b")).agg(F.count(F.lit(1)).alias("_r"))
        return per_file.groupBy(*map(ident, parts)).agg(
            F.count(F.lit(1)).alias("files"), F.sum("_r").alias("rows"), F.sum("_b").alias("bytes")
        )

    def info(self) -> dict:
        """K8: files, bytes, rows, columns and layout of the current state."""
        cs = self._current_commits()
        if not cs:
            raise FileNotFoundError(self.path)
        f = self.files().agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect()[0]
        last = cs[-1]
        return {
            "version": len(cs) - 1,
            "files": int(f["files"]),
            "bytes": int(f["bytes"] or 0),
            "log_rows": int(f["rows"] or 0),
            "schema": last.schema.simpleString(),
            "metadata": {"keys": last.keys, "partition_by": last.partition_by, "last_mode": last.mode},
        }


def save(spark: SparkSession, df: DataFrame, path: str, mode: str = "append", merge_keys=None,
         partition_by=None, add_meta: bool = True, **kw) -> dict:
    """K1 convenience wrapper."""
    return ArchiveTable(spark, path).save(df, mode, merge_keys, partition_by, add_meta, **kw)


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in METADATA_COLUMNS and c != ACTION]
