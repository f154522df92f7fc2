"""Published tables: Parquet folders plus a commit that says which of them are current.

An upsert writes the partitions it touches to new folders and then appends one small commit
that lists the current folder of every partition of every table. Readers follow the newest
commit, so all tables of a run, and the high-water marks with them, change together; a run that
dies before its commit leaves only folders nobody reads. Published files are never overwritten
while a plan may still read them.

Writers may overlap. A commit is written aside and then moved to the number after the one it
started from, which fails if another writer has taken that number; the load is then applied
anew, on top of the other one.

A table without a partition column is kept in buckets of its key, and a table with one has
a companion that maps keys to partitions, kept in buckets too. So a load reads the keys of the
buckets its own keys fall in, and rewrites no other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from reelstar.operators.joins import shuffled_if_many
from reelstar.operators.upsert import delete_matching, keyed, matching, not_older
from reelstar.session import empty_frame, stored

_COMMIT = "table string, part string, folder string, note string"
# folder level above the partitions; a discovered column, so no table may use the name
_FOLDER = "_load"
_BUCKET = "_bucket"
# companion of a partitioned table
_KEYS = "__keys"
# how Spark names the folder of a NULL partition value
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Load:
    """Rows to upsert into a table, and how the table is laid out.

    ``staging`` is read several times: pass a frame that was written before, not a long plan.
    ``partition_by`` is a date or a number, whose text is the same in a folder name. With
    ``newest_by``, a row older by these columns than the published row of its key is left out.
    ``buckets`` counts when the table is first published; later loads keep to that number.
    """

    staging: DataFrame
    keys: Sequence[str]
    partition_by: str | None = None
    sort_by: Sequence[str] = ()
    newest_by: Sequence[str] = ()
    buckets: int = 16


@dataclass(frozen=True)
class Derived:
    """A table made from partitions of another that is partitioned by the same column.

    Whenever a load touches a partition of ``source``, ``build`` is applied to its new rows, and
    the result takes the place of that partition.
    """

    source: str
    build: Callable[[DataFrame], DataFrame]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # -- commits ---------------------------------------------------------------------------

    def _folder_names(self, path: str) -> list[str]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        return [status.getPath().getName() for status in fs.listStatus(folder)]

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/_commits/version={version:010d}"

    def _numbers(self) -> list[int]:
        """Commit numbers in use, newest first, finished or not."""
        names = self._folder_names(f"{self.root}/_commits")
        return sorted((int(n.split("=")[1]) for n in names if n.startswith("version=")), reverse=True)

    def version(self) -> int:
        """The newest finished commit; one that died midway has no success marker."""
        for number in self._numbers():
            if "_SUCCESS" in self._folder_names(self._commit_path(number)):
                return number
        return 0

    def _current(self) -> list[tuple[str, str | None, str, str | None]]:
        """Lines of the newest commit: one per partition, so bounded by tables x days."""
        version = self.version()
        if version == 0:
            return []
        lines = self.spark.read.schema(_COMMIT).parquet(self._commit_path(version)).collect()
        return [(r["table"], r["part"], r["folder"], r["note"]) for r in lines]

    def notes(self) -> set[str]:
        return {note for table, _, _, note in self._current() if table == "" and note}

    # -- reads -----------------------------------------------------------------------------

    def exists(self, table: str) -> bool:
        return any(name == table for name, _, _, _ in self._current())

    def read(self, table: str, schema: StructType, partition_by: str | None = None) -> DataFrame:
        folders = {p: f for name, p, f, _ in self._current() if name == table}
        return self._read(table, schema, partition_by, folders)

    def _read(
        self,
        table: str,
        schema: StructType,
        partition_by: str | None,
        folders: dict[str | None, str],
    ) -> DataFrame:
        if not folders:
            return empty_frame(self.spark, schema)
        part, full = partition_by, schema
        if part is None or part == _BUCKET:
            part, full = _BUCKET, StructType([*schema.fields, StructField(_BUCKET, IntegerType())])
        base = f"{self.root}/{table}"
        paths = [
            f"{base}/{_FOLDER}={folder}/{part}={_NULL_PART if value is None else value}"
            for value, folder in folders.items()
        ]
        df = self.spark.read.schema(full).option("basePath", base).parquet(*paths)
        return df.select(*schema.names)

    # -- writes ----------------------------------------------------------------------------

    def publish(
        self,
        loads: dict[str, Load],
        note: str | None = None,
        derived: dict[str, Derived] | None = None,
    ) -> int:
        """Upsert every load, then commit them together; returns the new version.

        ``note`` marks work that must not be applied twice, such as a stream's batch: a note
        already in the log makes the call a no-op. ``derived`` tables change in the same commit.
        """
        while True:
            base = self.version()
            lines = self._current()
            if note is not None and any(t == "" and n == note for t, _, _, n in lines):
                return base
            before = lines
            for table, load in loads.items():
                lines = self._upsert(table, load, lines)
            for table, rule in (derived or {}).items():
                lines = self._derive(table, rule, loads[rule.source], before, lines)
            if note is not None:
                stream = note.rsplit("#", 1)[0] + "#"
                lines = [x for x in lines if not (x[0] == "" and (x[3] or "").startswith(stream))]
                lines.append(("", None, "", note))
            number = max(self._numbers(), default=0)
            if self.version() == base and self._commit(lines, number + 1):
                return number + 1

    def _commit(self, lines: list[tuple], number: int) -> bool:
        """Write a commit aside and move it to its number; False if the number is taken.

        On a store without an atomic rename, such as an object store, give each table set one
        writer at a time.
        """
        aside = f"{self.root}/_aside/{uuid.uuid4().hex}"
        frame = self.spark.createDataFrame(lines, _COMMIT).coalesce(1)
        frame.write.mode("errorifexists").parquet(aside)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        source, target = (
            jvm.org.apache.hadoop.fs.Path(x) for x in (aside, self._commit_path(number))
        )
        fs = target.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        options = self.spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 0
        )
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        try:
            files.rename(source, target, options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception.getClass()):
                return False
            raise
        return True

    def _folders(self, table: str, lines: list[tuple]) -> dict[str | None, str]:
        return {p: f for name, p, f, _ in lines if name == table}

    def _upsert(self, table: str, load: Load, lines: list[tuple]) -> list[tuple]:
        """The commit's lines after one load."""
        staging = keyed(load.staging, load.keys)
        if load.partition_by is None:
            return self._upsert_buckets(table, load, staging, lines)
        part, folders = load.partition_by, self._folders(table, lines)
        schema = load.staging.schema
        columns = dict.fromkeys((*load.keys, *load.newest_by, part))
        index = f"{table}{_KEYS}"

        # the published versions of the staged keys: where they are and how new
        held = self._bucket_rows(index, staging.select(*columns), load.keys, lines)
        touched: set[str | None] = set()
        sided = staging  # as a side of the joins below
        if held is not None:
            sided = shuffled_if_many(staging)
            replaced = stored(self.spark, matching(held, sided, load.keys), f"{table}-replaced")
            if load.newest_by:
                newer = not_older(sided, replaced, load.keys, load.newest_by)
                staging = stored(self.spark, newer, f"{table}-newer")
                sided = shuffled_if_many(staging)
                replaced = matching(replaced, sided, load.keys)
            # partitions to rewrite: those of the new rows, and those that hold an older
            # version of one of them, as a replay may move a row to another partition
            touched = self._values(staging.select(part).unionByName(replaced.select(part)), part)
        rows = staging
        old = {p: f for p, f in folders.items() if p in touched}
        if old:
            kept = self._read(table, schema, part, old)
            rows = delete_matching(kept, sided, load.keys).unionByName(staging)
        written = self._write(table, rows, part, load.sort_by)
        current = {p: f for p, f in folders.items() if p not in touched} | written
        lines = [x for x in lines if x[0] != table]
        lines += [(table, p, f, None) for p, f in current.items()]
        places = Load(staging.select(*columns), load.keys, buckets=load.buckets)
        return self._upsert_buckets(index, places, places.staging, lines)

    def _buckets(self, table: str, lines: list[tuple]) -> int | None:
        """The number of buckets a table is kept in."""
        notes = [n for name, _, _, n in lines if name == table]
        return int(notes[0].removeprefix("buckets=")) if notes else None

    @staticmethod
    def _in_buckets(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))

    def _bucket_rows(
        self, table: str, like: DataFrame, keys: Sequence[str], lines: list[tuple]
    ) -> DataFrame | None:
        """Rows of a bucketed table in the buckets that the keys of ``like`` fall in."""
        buckets = self._buckets(table, lines)
        if buckets is None:
            return None
        asked = self._values(self._in_buckets(like, keys, buckets), _BUCKET)
        folders = {p: f for p, f in self._folders(table, lines).items() if p in asked}
        return self._read(table, like.schema, _BUCKET, folders)

    def _upsert_buckets(
        self, table: str, load: Load, staging: DataFrame, lines: list[tuple]
    ) -> list[tuple]:
        """Upsert a table that is laid out by buckets of its key; a key never leaves its bucket."""
        held = self._bucket_rows(table, staging, load.keys, lines)
        rows = staging
        if held is not None:
            sided = shuffled_if_many(staging)
            if load.newest_by:
                versions = held.select(*dict.fromkeys((*load.keys, *load.newest_by)))
                replaced = matching(versions, sided, load.keys)
                newer = not_older(sided, replaced, load.keys, load.newest_by)
                staging = stored(self.spark, newer, f"{table}-newer")
                sided = shuffled_if_many(staging)
            rows = delete_matching(held, sided, load.keys).unionByName(staging)
        buckets = self._buckets(table, lines) or load.buckets
        rows = self._in_buckets(rows, load.keys, buckets)
        current = self._folders(table, lines) | self._write(table, rows, _BUCKET, load.sort_by)
        lines = [x for x in lines if x[0] != table]
        return lines + [(table, p, f, f"buckets={buckets}") for p, f in current.items()]

    def _derive(
        self, table: str, rule: Derived, load: Load, before: list[tuple], after: list[tuple]
    ) -> list[tuple]:
        """Rebuild the partitions of a derived table whose source partitions changed."""
        part = load.partition_by
        old, new = self._folders(rule.source, before), self._folders(rule.source, after)
        changed = {p for p in old.keys() | new.keys() if old.get(p) != new.get(p)}
        rows = self._read(
            rule.source, load.staging.schema, part, {p: f for p, f in new.items() if p in changed}
        )
        written = self._write(table, rule.build(rows), part, ())
        kept = {p: f for p, f in self._folders(table, after).items() if p not in changed}
        lines = [x for x in after if x[0] != table]
        return lines + [(table, p, f, None) for p, f in (kept | written).items()]

    def _write(
        self, table: str, rows: DataFrame, part: str, sort_by: Sequence[str]
    ) -> dict[str | None, str]:
        """Write rows to a new folder; the partitions that came out, each with the folder."""
        folder = uuid.uuid4().hex
        path = f"{self.root}/{table}/{_FOLDER}={folder}"
        rows = rows.hint("rebalance", part).sortWithinPartitions(part, *sort_by)
        rows.write.partitionBy(part).parquet(path)
        return {p: folder for p in self._partitions(path, part)}

    def _partitions(self, path: str, part: str) -> set[str | None]:
        """Partition values with rows in a written folder, from its directory names."""
        names = self._folder_names(path)
        values = {n.split("=", 1)[1] for n in names if n.startswith(f"{part}=")}
        return {None if v == _NULL_PART else v for v in values}

    @staticmethod
    def _values(df: DataFrame, part: str) -> set[str | None]:
        """Distinct partition values, as they are written in folder names."""
        values = df.select(F.col(part).cast("string").alias("p")).distinct().collect()
        return {row["p"] for row in values}
