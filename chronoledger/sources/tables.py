"""Versioned parquet table store, schema conformance and NOT NULL checks.

Layout: ``{root}/{layer}/{table}/v={N}/part={p}/part-*.parquet``. A version
is written once by one Spark job and never modified; it counts when it has
its ``_SUCCESS`` marker, so a lost executor only causes task retries and a
failed job leaves a folder that readers ignore. Versions are full
(``publish``) or partial (``replace``, ``apply``, ``append``; marked by
``_PARTIAL``): a partial version holds some parts, which replace those of
earlier versions, and readers take each part from the newest version since
the last full one that has it. A merge that touches few keys so reads and
writes few parts, whatever the table's size.

Parts (``PART_OF``): rows of a keyed table are dealt by a hash of a key to
``buckets`` parts; snapshots stand with their run; appended rows with their
batch. A batch or run that is written again by a retried task replaces what
it wrote before. ``publish(read(...))`` folds all versions into one.

Writing a new version also cuts the lineage of the next step: it reads the
stored files, not the chain of joins that produced them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chronoledger import schemas as S
from chronoledger.operators.merge import change_feed

_VERSION = re.compile(r"^v=(\d+)$")
_PART = re.compile(r"^(part|gone)=(.+)$")

# Directory partitioning per table, below its parts: the raw table is filtered
# by resource in every reprocessing step, so each resource lives in its own
# folder and the filter prunes files instead of reading every stored page.
PARTITION_BY: dict[tuple[str, str], list[str]] = {("raw", "api_responses"): ["resource"]}

#: How rows are dealt to parts: by a hash of a column, by its value, or by the batch that appends them.
PART_OF = {
    "ingestion_runs": ("hash", "ingestion_id"),
    "ingestion_step_outcomes": ("hash", "ingestion_id"),
    "ingestion_comments": ("hash", "ingestion_id"),
    "video_targets": ("hash", "video_id"),
    "video_processing_state": ("hash", "video_id"),
    "videos": ("hash", "video_id"),
    "channels": ("hash", "channel_id"),
    "comments": ("hash", "comment_id"),
    "replies": ("hash", "comment_id"),
    "video_snapshots": ("value", "ingestion_id"),
    "channel_snapshots": ("value", "ingestion_id"),
    "api_responses": ("batch", None),
}
BUCKETS = 64
#: Stored beside the schema's columns in current-state tables: when the page that a row comes from was received.
RECEIVED = "_received_at"
RECEIVED_IN = ("videos", "channels", "comments", "replies")


def stored_schema(layer: str, table: str) -> StructType:
    """The table's schema, and what is stored beside it."""
    more = [StructField(RECEIVED, S.TS)] if table in RECEIVED_IN else []
    return StructType([*S.TABLES[(layer, table)].fields, *more])


def conform(df: DataFrame, schema: StructType, allow_extra: bool = False) -> DataFrame:
    """Select, order and cast ``df`` to ``schema``.

    Columns absent from ``df`` become NULL; unknown columns are rejected
    unless ``allow_extra``.
    """
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra and not allow_extra:
        raise ValueError(f"columns not in schema: {extra}")
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def not_null_violations(df: DataFrame, columns) -> DataFrame:
    """Rows breaking a NOT NULL constraint, with the offending column names.

    Parquet does not enforce NOT NULL, so writers check here. Output: the
    row's columns plus ``violated`` (comma-joined names of NULL columns).
    """
    columns = list(columns)
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("violated", F.array_join(names, ",")).where(F.size(names) > 0)


def assert_not_null(df: DataFrame, columns) -> DataFrame:
    """Fail the job (at execution time, on the executor) on a NULL in ``columns``."""
    columns = list(columns)
    cond = None
    for c in columns:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    if cond is None:
        return df
    return df.where(F.when(cond, F.raise_error(F.lit(f"NOT NULL violated in {columns}"))).otherwise(F.lit(True)))


def add_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """Schema evolution: add a nullable column (``ALTER TABLE ADD COLUMN``)."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


@dataclass(frozen=True)
class Change:
    """``rows`` to merge into a table by ``merge(target, rows)``, which may
    change only rows whose part some row of ``keys`` (default ``rows``) has.
    ``unique`` names the columns by which rows may not repeat."""

    rows: DataFrame
    merge: Callable[[DataFrame, DataFrame], DataFrame]
    keys: DataFrame | None = None
    unique: tuple[str, ...] = ()


class TableStore:
    """Versioned tables under one root folder (local path or shared storage).

    ``buckets`` is fixed by the first store that is opened on a root: size it so
    that a bucket of the largest table is a few files.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        fs, path = self._fs()
        marks = [m.getPath().getName() for m in fs.listStatus(path(self.root))] if fs.exists(path(self.root)) else []
        known = [m for m in marks if m.startswith("_buckets-")]
        if known and known != [f"_buckets-{buckets}"]:
            raise ValueError(f"{root} is stored in {known[0].split('-')[1]} buckets")
        if not known:
            fs.mkdirs(path(f"{self.root}/_buckets-{buckets}"))

    # -- paths -------------------------------------------------------------
    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _fs(self):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return hadoop.Path(self.root).getFileSystem(conf), hadoop.Path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs()
        return [st.getPath().getName() for st in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []

    def _numbers(self, layer: str, table: str) -> list[int]:
        return sorted(int(m.group(1)) for m in map(_VERSION.match, self._names(self.path(layer, table))) if m)

    def versions(self, layer: str, table: str) -> list[int]:
        """Complete versions (folders with a ``_SUCCESS`` marker), ascending."""
        base = self.path(layer, table)
        return [n for n in self._numbers(layer, table) if "_SUCCESS" in self._names(f"{base}/v={n}")]

    def live(self, layer: str, table: str, version: int | None = None) -> dict[str, int]:
        """The version that holds each part, of those up to ``version`` (default: all)."""
        base, out = self.path(layer, table), {}
        for n in reversed(self._numbers(layer, table)):
            if version is not None and n > version:
                continue
            names = self._names(f"{base}/v={n}")
            if "_SUCCESS" not in names:
                continue
            parts = [m.groups() for m in map(_PART.match, names) if m]
            for kind, part in sorted(parts, reverse=True):  # in a version that holds a part, it isn't gone
                out.setdefault(part, n if kind == "part" else 0)
            if "_PARTIAL" not in names:
                break
        return {part: n for part, n in out.items() if n}

    def part(self, table: str, batch: str | None = None) -> Column:
        """The part of each row."""
        kind, column = PART_OF[table]
        if kind == "hash":
            return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("string")
        return F.md5(F.coalesce(F.col(column), F.lit(""))) if kind == "value" else F.md5(F.lit(batch or uuid.uuid4().hex))

    def parts(self, table: str, keys: DataFrame, unique: tuple[str, ...] = ()) -> list[str]:
        """The parts that the rows of ``keys`` touch: at most ``buckets``, or
        the runs in ``keys``. Rows that repeat the columns ``unique`` are refused."""
        rows = keys.select(self.part(table).alias("__part"), *unique).groupBy("__part", *unique).agg(F.count(F.lit(1)).alias("n"))
        found = rows.groupBy("__part").agg(F.max("n").alias("n")).collect()
        if unique and any(r.n > 1 for r in found):
            raise ValueError(f"rows for {table} repeat a key of {list(unique)}")
        return sorted(r[0] for r in found)

    # -- read / write ------------------------------------------------------
    def read(self, layer: str, table: str, parts: list[str] | None = None, version: int | None = None, stored: bool = False) -> DataFrame:
        """The table (of ``parts``, as of ``version``); an empty typed frame
        when there is none. ``stored`` adds what is stored beside the schema."""
        sch = stored_schema(layer, table) if stored else S.TABLES[(layer, table)]
        live = self.live(layer, table, version)
        base = self.path(layer, table)
        found = [f"{base}/v={n}/part={p}" for p, n in live.items() if parts is None or p in set(parts)]
        if not found:
            return self.spark.createDataFrame([], sch)
        df = self.spark.read.schema(StructType([*stored_schema(layer, table).fields, StructField("part", S.StringType())]))
        return df.option("basePath", base).parquet(*found).select(*sch.fieldNames())

    def _write(self, layer: str, table: str, df: DataFrame, part: Column, replaced: list[str] | None) -> int:
        """A new version of ``df``: full, or with the parts that it replaces."""
        fs, path = self._fs()
        n = max(self._numbers(layer, table), default=0) + 1
        folder = f"{self.path(layer, table)}/v={n}"
        if replaced is not None:
            fs.mkdirs(path(f"{folder}/_PARTIAL"))
            for p in replaced:
                fs.mkdirs(path(f"{folder}/gone={p}"))
        out = assert_not_null(conform(df, stored_schema(layer, table)), S.required_columns(table))
        # rebalanced by part: few files each, and a large part is split between tasks
        out = out.withColumn("part", part).hint("rebalance", "part")
        out.write.mode("append").partitionBy("part", *PARTITION_BY.get((layer, table), [])).parquet(folder)
        return n

    def publish(self, layer: str, table: str, df: DataFrame) -> int:
        """Write ``df`` as the next full version after checking types and NOT NULLs."""
        return self._write(layer, table, df, self.part(table, "base"), None)

    def replace(self, layer: str, table: str, df: DataFrame, parts: list[str]) -> int:
        """Write ``df`` as what the parts ``parts`` hold from now on."""
        return self._write(layer, table, df, self.part(table), parts)

    def apply(self, layer: str, table: str, change: Change) -> int:
        """Merge a change: its rows are computed once, the parts that they touch are read, merged and replaced."""
        fs, path = self._fs()
        work = f"{self.root}/_work/{uuid.uuid4().hex}"
        change.rows.write.parquet(work)
        rows = self.spark.read.schema(change.rows.schema).parquet(work)
        if change.keys is None:
            parts = self.parts(table, rows, change.unique)
        else:
            parts = self.parts(table, change.keys)
        if parts:
            n = self.replace(layer, table, change.merge(self.read(layer, table, parts, stored=True), rows), parts)
        else:
            n = max(self.versions(layer, table), default=0)
        fs.delete(path(work), True)
        return n

    def append(self, layer: str, table: str, df: DataFrame, batch: str | None = None) -> int:
        """Append rows (append-only tables) as a batch of their own. What a
        batch of the same name wrote before (a run's step, stopped and done
        again) is replaced; a batch without a name is always new. An empty
        batch is a no-op: no version is left."""
        if PART_OF[table][0] != "batch":
            raise ValueError(f"rows of {table} are merged by key")
        n = self._write(layer, table, df, self.part(table, batch), [])
        folder = f"{self.path(layer, table)}/v={n}"
        if not any(_PART.match(x) for x in self._names(folder)):
            fs, path = self._fs()
            fs.delete(path(folder), True)
            return max(self.versions(layer, table), default=0)
        return n

    def changes(self, layer: str, table: str, before: int, after: int) -> DataFrame:
        """The change feed between two versions of a keyed table. Parts that both share aren't read."""
        old, new = self.live(layer, table, before), self.live(layer, table, after)
        differ = [p for p in old.keys() | new.keys() if old.get(p) != new.get(p)]
        return change_feed(self.read(layer, table, differ, before), self.read(layer, table, differ, after), list(S.KEYS[table]))

    def register_views(self, prefix: str = "") -> list[str]:
        """Temp view ``{prefix}{layer}_{table}`` over the latest version of
        every table, so the tables can be queried by name from SQL."""
        names = []
        for (layer, table) in S.TABLES:
            name = f"{prefix}{layer}_{table}"
            self.read(layer, table).createOrReplaceTempView(name)
            names.append(name)
        return names

    def create_all(self) -> None:
        """Create every table of the registry as an empty version 1 if absent."""
        for (layer, table), sch in S.TABLES.items():
            if not self.versions(layer, table):
                self.publish(layer, table, self.spark.createDataFrame([], sch))


def create_catalog_tables(spark: SparkSession, root: str, database_prefix: str = "") -> list[str]:
    """``CREATE SCHEMA`` / ``CREATE TABLE IF NOT EXISTS`` for all twelve
    tables, as parquet tables at ``{root}/{layer}/{table}`` with table and
    column comments taken from the schema registry. Returns the qualified
    names. (Parquet does not enforce NOT NULL: writers use
    ``assert_not_null``.)"""
    names = []
    for (layer, table), sch in S.TABLES.items():
        db = f"{database_prefix}{layer}"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{db}`")
        cols = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            + (" COMMENT '" + f.metadata["comment"].replace("'", "\\'") + "'" if f.metadata.get("comment") else "")
            for f in sch.fields)
        parts = PARTITION_BY.get((layer, table))
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{db}`.`{table}` ({cols}) USING parquet"
                  + (f" PARTITIONED BY ({', '.join(parts)})" if parts else "")
                  + f" COMMENT '{layer} table {table}' LOCATION '{root.rstrip('/')}/{layer}/{table}'")
        names.append(f"{db}.{table}")
    return names


def literal_rows(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A tiny control-record DataFrame (run rows, registrations)."""
    return spark.createDataFrame(rows, schema)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver test-data table (one parquet file or folder per table)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
