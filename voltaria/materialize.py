"""Writing models: tables, merges (whole or by column), appends, replaced ranges, retention and watermarks.

Plain Parquet has no update in place. A table is a set of folders of Parquet files and a log of commits, one small file
each, that list the folders which make up the table. Data are written first; a commit file is written aside and moved to
its number, which fails if another writer took that number. So readers see the table before or after a write, a job that
dies leaves unused folders and nothing else, and two writers who start from the same commit can't both succeed (where the
file system's rename is exclusive, as on HDFS and local disks; on an object store a table needs one writer at a time).
Appending adds a folder. Merges, replaced ranges and deletions rewrite the parts that hold rows of theirs and no others: a part
is a folder, or one partition of it where the table is partitioned.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.dedup import duplicate_keys


class DuplicateKeys(ValueError):
    """A batch has several rows for a key that must be unique."""


class Conflict(RuntimeError):
    """Another writer committed first; the write must be started again from the table as it is now."""


class Table:
    """A table of committed Parquet folders under ``path``; ``partition_by`` holds for every folder written."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> None:
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), tuple(partition_by)

    # --- commits ---

    def _at(self, name: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        at = hadoop.Path(f"{self.path}/{name}")
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def commits(self) -> list[int]:
        at, fs = self._at("_commits")
        if not fs.exists(at):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(at)]
        return sorted(int(n) for n in names if n.isdigit())

    def _folders(self, number: int) -> list[str]:
        at, fs = self._at(f"_commits/{number:012d}")
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode().split("\n")
        finally:
            stream.close()

    def _commit(self, after: int, folders: Sequence[str]) -> None:
        """Commit number ``after`` + 1, unless it exists."""
        spare, fs = self._at(f"_commits/.{uuid.uuid4().hex}")
        stream = fs.create(spare, False)
        stream.write("\n".join(folders).encode())
        stream.close()
        own, _ = self._at(f"_commits/{after + 1:012d}")
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(spare, own, none)
        except Exception as e:
            fs.delete(spare, False)
            if fs.exists(own):
                raise Conflict(f"{self.path}: commit {after + 1} was taken by another writer") from e
            raise

    def _write(self, df: DataFrame) -> list[str]:
        """Writes a folder and gives its parts: itself, or its partitions."""
        folder = f"d-{uuid.uuid4().hex}"
        at, fs = self._at(folder)
        if self.partition_by:
            df.write.partitionBy(*self.partition_by).parquet(f"{self.path}/{folder}")
            parts = [folder]
            for _ in self.partition_by:
                parts = [f"{p}/{f.getPath().getName()}" for p in parts for f in fs.listStatus(self._at(p)[0]) if f.isDirectory() and not f.getPath().getName().startswith(("_", "."))]
            if parts:
                return parts
        df.write.mode("overwrite").parquet(f"{self.path}/{folder}")  # without rows there are no partitions, but a schema
        return [folder]

    def _state(self) -> tuple[int, list[str]]:
        numbers = self.commits()
        return (numbers[-1], self._folders(numbers[-1])) if numbers else (0, [])

    def clean(self, keep: int = 2) -> int:
        """Removes commits before the last ``keep`` and folders that none of these lists; how many folders went. Not to be
        run beside a writer: its folder isn't listed yet."""
        numbers = self.commits()
        listed = {f.split('/')[0] for n in numbers[-keep:] for f in self._folders(n)}
        for n in numbers[:-keep]:
            at, fs = self._at(f"_commits/{n:012d}")
            fs.delete(at, False)
        root, fs = self._at("")
        gone = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith("d-") and f.getPath().getName() not in listed]
        for at in gone:
            fs.delete(at, True)
        return len(gone)

    # --- reading ---

    def exists(self) -> bool:
        return bool(self.commits())

    def read(self) -> DataFrame:
        folders = self._state()[1]
        if not folders:
            raise FileNotFoundError(self.path)
        return self._read(folders)

    def _read(self, parts: Sequence[str]) -> DataFrame:
        """The union of the parts' rows. Each folder is read with its own columns, as later ones may have more."""
        folders: dict[str, list[str]] = {}
        for p in parts:
            folders.setdefault(p.split("/")[0], []).append(f"{self.path}/{p}")
        frames = [self.spark.read.option("basePath", f"{self.path}/{f}").parquet(*ps) for f, ps in folders.items()]
        if not self.partition_by and all(f.schema == frames[0].schema for f in frames):
            return self.spark.read.schema(frames[0].schema).parquet(*(f"{self.path}/{p}" for p in parts))
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out

    def newest(self, column: str):
        """The high-water mark; None without rows."""
        return self.read().agg(F.max(column)).first()[0] if self.exists() else None

    # --- writing ---

    def overwrite(self, df: DataFrame) -> None:
        number = self._state()[0]
        self._commit(number, self._write(df))

    def overwrite_unless_empty(self, df: DataFrame) -> bool:
        """Full replacement that leaves the old rows when the new ones are none (a source that failed)."""
        if df.isEmpty():
            return False
        self.overwrite(df)
        return True

    def append(self, df: DataFrame) -> None:
        """Adds a folder; what is there isn't read."""
        number, parts = self._state()
        self._commit(number, [*parts, *self._write(df)])

    def _holding(self, parts: Sequence[str], rows: DataFrame) -> dict[str, int]:
        """The parts that rows of the table (with their file in ``__file``) come from, and how many they are."""
        files = rows.groupBy("__file").count().collect()  # one short row per file
        out: dict[str, int] = {}
        for r in files:
            at = unquote(r["__file"])
            part = next(p for p in parts if f"/{unquote(p)}/" in at)
            out[part] = out.get(part, 0) + r["count"]
        return out

    def _with_file(self, parts: Sequence[str]) -> DataFrame:
        return self._read(parts).withColumn("__file", F.input_file_name())

    def _partitions_of(self, batch: DataFrame, parts: Sequence[str]) -> list[str]:
        """Of a partitioned table the parts whose partition the batch has rows of."""
        if not self.partition_by:
            return list(parts)
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        names = batch.select(*(F.col(c).cast("string") for c in self.partition_by)).distinct().collect()
        has = {"/".join(escape(c, v) for c, v in zip(self.partition_by, r, strict=True)) for r in names}
        return [p for p in parts if "/" not in p or p.split("/", 1)[1] in has]

    def merge(self, batch: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None, schema_change: str = "append", check: bool = True) -> None:
        """Upsert. ``update``: columns that a match takes over, all by default; the others keep the old value.
        schema_change: append keeps columns that the batch lacks, sync drops them, ignore keeps the table's columns.

        The batch is written once and read from there. The table's keys alone tell which parts hold matches; those are
        rewritten, the others keep their files, and without a match the batch is simply added. Where the table is
        partitioned, the key must determine the partition: then only the batch's partitions are looked at.
        """
        number, parts = self._state()
        if parts and schema_change == "ignore":
            batch = batch.select(*(c for c in batch.columns if c in self._read(parts[:1]).columns))
        new = self._write(batch)
        batch = self._read(new)
        if check and not duplicate_keys(batch, keys).isEmpty():
            raise DuplicateKeys(f"{self.path}: several rows for a key of {', '.join(keys)}")
        if not parts:
            return self._commit(number, new)
        if schema_change == "sync" and set(self._read(parts).columns) - set(batch.columns):
            met = set(parts)
        else:
            near = self._partitions_of(batch, parts)
            met = set(self._holding(near, _semi(self._with_file(near).select(*keys, "__file"), batch.select(*keys), keys))) if near else set()
        if met:
            new = self._write(merged(self._read([p for p in parts if p in met]), batch, keys, update, schema_change))
        self._commit(number, [*(p for p in parts if p not in met), *new])

    def insert(self, batch: DataFrame, keys: Sequence[str], check: bool = True) -> None:
        """Adds the rows whose key the table doesn't hold; rows that it holds stay as they are, and no part is rewritten."""
        number, parts = self._state()
        near = self._partitions_of(batch, parts) if parts else []
        if near:
            batch = _semi(batch, self._read(near).select(*keys), keys, "left_anti")
        new = self._write(batch)
        if check and not duplicate_keys(self._read(new), keys).isEmpty():
            raise DuplicateKeys(f"{self.path}: several rows for a key of {', '.join(keys)}")
        self._commit(number, [*parts, *new])

    def _rewritten(self, parts: Sequence[str], condition: Column) -> tuple[list[str], int]:
        """The parts without the rows that ``condition`` holds for, and how many rows those were. A part without such
        rows stays as it is; where statistics rule it out, its files aren't read."""
        hit = self._holding(parts, self._with_file(parts).filter(condition)) if parts else {}
        if not hit:
            return list(parts), 0
        kept, rest = [p for p in parts if p not in hit], self._write(self._read([p for p in parts if p in hit]).filter(~F.coalesce(condition, F.lit(False))))
        return kept if kept and self._read(rest).isEmpty() else [*kept, *rest], sum(hit.values())

    def replace_range(self, batch: DataFrame, replaced: Column) -> None:
        """Delete and insert by one predicate: rows that ``replaced`` holds for go, and those of the batch that it holds for come."""
        number, parts = self._state()
        new = self._write(batch.filter(replaced) if parts else batch)
        self._commit(number, [*self._rewritten(parts, replaced)[0], *new])

    def delete(self, condition: Column) -> int:
        """Retention: rows that the condition holds for go; how many they were."""
        number, parts = self._state()
        if not parts:
            raise FileNotFoundError(self.path)
        kept, n = self._rewritten(parts, condition)
        if n:
            self._commit(number, kept)
        return n

    def keep_referenced(self, parents: DataFrame, keys: Sequence[str]) -> int:
        """Rows without a parent go; how many they were. Parts that lose none stay as they are."""
        number, parts = self._state()
        hit = self._holding(parts, _semi(self._with_file(parts).select(*keys, "__file"), parents.select(*keys), keys, "left_anti"))
        if hit:
            rows = _semi(self._read([p for p in parts if p in hit]), parents.select(*keys), keys)
            self._commit(number, [*(p for p in parts if p not in hit), *self._write(rows)])
        return sum(hit.values())

    def archive(self, column: str, before, path: str) -> int:
        """Moves the rows of whole days before ``before`` (a date), by the time in ``column``, to Parquet under ``path``, a folder a day;
        how many they were. They are written before they go, and a day that is moved again replaces itself, so a run that died is
        simply run again."""
        old = F.col(column) < F.lit(before)
        rows = self.read().filter(old).withColumn("archived_day", F.to_date(column))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("archived_day").parquet(path)
        return self.delete(old)

    def compact(self, most: int = 64) -> bool:
        """Writes the table anew once it has more than ``most`` folders."""
        number, parts = self._state()
        if len({p.split("/")[0] for p in parts}) <= most:
            return False
        self._commit(number, self._write(self._read(parts)))
        return True


def _semi(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Null keys meet null keys."""
    named = right.select(*(F.col(k).alias(f"__{k}") for k in keys))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(named, on, how)


def merged(old: DataFrame, batch: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None, schema_change: str = "append") -> DataFrame:
    """The rows of ``old`` after a batch: one full join on the keys, each column from the side that rules it."""
    columns = list(old.columns)
    if schema_change != "ignore":
        columns += [c for c in batch.columns if c not in columns]
    if schema_change == "sync":
        columns = [c for c in columns if c in batch.columns]
    o, n = old.withColumn("__old", F.lit(True)).alias("o"), batch.withColumn("__new", F.lit(True)).alias("n")
    both = o.join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full")
    is_old, is_new = F.col("o.__old").isNotNull(), F.col("n.__new").isNotNull()

    def pick(c: str) -> Column:
        if c not in old.columns:
            return F.when(is_new, F.col(f"n.{c}")).alias(c)
        if c not in batch.columns:
            return F.col(f"o.{c}").alias(c)
        takes = is_new if update is None or c in update or c in keys else is_new & ~is_old
        return F.when(takes, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    return both.select(*map(pick, columns))


def since_watermark(df: DataFrame, column: str, mark, lookback: str | None = None, strict: bool = True) -> DataFrame:
    """Rows newer than the mark, or from ``lookback`` (such as "1 HOUR") before it on; all rows without a mark."""
    if mark is None:
        return df
    if lookback:
        return df.filter(F.col(column) >= F.lit(mark) - F.expr(f"INTERVAL {lookback}"))
    return df.filter(F.col(column) > F.lit(mark) if strict else F.col(column) >= F.lit(mark))
