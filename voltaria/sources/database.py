"""Databases: partitioned reads by Spark's own JDBC source, and a sink of all or nothing with upserts.

    read_table(spark, "jdbc:postgresql://...", "silver.readings", key="id", partitions=64, driver="...")
    spark.dataSource.register(Database)
    df.write.format("database").options(driver="psycopg2", connect='{"dbname": "..."}', table="raw.mirror", keys="id", update="status,settled_at").mode("append").save()
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

MARKS = {"qmark": "?", "format": "%s", "pyformat": "%s"}
ROWS = 1000


def read_table(spark: SparkSession, url: str, table: str, key: str | None = None, partitions: int = 8, **properties: str) -> DataFrame:
    """A table, or a query in parentheses with a name. Filters and columns are pushed into the database by Spark.

    ``key`` (a number, date or timestamp column, best an indexed one) splits the read into ranges between its least and its
    greatest value, which the database is asked for (with names quoted as in standard SQL); rows without a key are in the first range. An empty table is one range.
    """
    source = spark.read.format("jdbc").options(url=url, fetchsize="10000", **properties)
    if key is None:
        return source.option("dbtable", table).load()
    low, high = source.option("dbtable", f"(SELECT min({_quoted(key)}) AS low, max({_quoted(key)}) AS high FROM {table}) bounds").load().first()
    split = source.option("dbtable", table)
    if low is None:
        return split.load()
    return split.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)).load()


def _quoted(name: str) -> str:
    return ".".join('"' + p.replace('"', '""') + '"' for p in name.split("."))


def _listed(text: str | None) -> list[str]:
    return [c.strip() for c in (text or "").split(",") if c.strip()]


@dataclass
class Written(WriterCommitMessage):
    """What one attempt of a task has put aside, by its tag."""

    task: str
    rows: int


class Database(DataSource):
    """A sink. Options: driver (a DB-API module), connect (its keyword arguments as JSON), table, keys and update (column
    lists), prune (an SQL condition), query (streams only: a name that stays the same over restarts).

    Every attempt of a task writes its rows to a table beside the target, in a transaction of its own. When all are done, one
    transaction deletes what ``prune`` says, moves the rows of the attempts that count into the target and, in streams, notes the batch:
    a job that fails leaves the target as it was, and a batch that is run again is not written again. The driver holds no rows.

    Without ``keys`` rows are added. With them, rows whose key is there update the columns of ``update`` (by default all others; given
    but empty: none). Keys must not be null nor come twice in one batch: that fails, and nothing is written. Mode overwrite replaces
    all rows. The target must exist; columns go by name. A driver that dies may leave a table ``<target>_in_<id>``.
    """

    @classmethod
    def name(cls) -> str:
        return "database"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return BatchWriter(Sink(dict(self.options), schema.names, overwrite, uuid.uuid4().hex[:16]))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return StreamWriter(Sink(dict(self.options), schema.names, False, self.options["query"]), self.options["query"])


class Sink:
    """The SQL of the sink: rows put aside, then moved."""

    def __init__(self, options: dict[str, str], columns: list[str], overwrite: bool, tag: str) -> None:
        self.driver, self.arguments, self.table = options["driver"], json.loads(options["connect"]), options["table"]
        self.columns, self.keys, self.prune, self.overwrite = columns, _listed(options.get("keys")), options.get("prune"), overwrite
        self.update = [c for c in columns if c not in self.keys] if options.get("update") is None else _listed(options["update"])
        if absent := [c for c in self.keys + self.update if c not in columns]:
            raise ValueError(f"no columns {absent} among {columns}")
        self.aside, self.counting = f"{self.table}_in_{tag}", f"{self.table}_ok_{tag}"
        self.names = ", ".join(map(_quoted, columns))

    def connect(self):
        return closing(importlib.import_module(self.driver).connect(**self.arguments))

    def marks(self, n: int) -> str:
        return ", ".join([MARKS[importlib.import_module(self.driver).paramstyle]] * n)

    def prepare(self) -> None:
        with self.connect() as c:
            run = c.cursor().execute
            run(f"CREATE TABLE IF NOT EXISTS {_quoted(self.aside)} AS SELECT CAST(NULL AS VARCHAR(32)) AS task__, {self.names} FROM {_quoted(self.table)} WHERE 1 = 0")
            run(f"CREATE TABLE IF NOT EXISTS {_quoted(self.counting)} (task__ VARCHAR(32))")
            c.commit()

    def put(self, rows: Iterator) -> Written:
        task, n = uuid.uuid4().hex, 0
        insert = f"INSERT INTO {_quoted(self.aside)} (task__, {self.names}) VALUES ({self.marks(len(self.columns) + 1)})"
        with self.connect() as c:
            cursor = c.cursor()
            while some := [(task, *r) for r in islice(rows, ROWS)]:
                cursor.executemany(insert, some)
                n += len(some)
            c.commit()
        return Written(task, n)

    def move(self, run, cursor, messages: list) -> None:
        """In the caller's transaction. Raises where keys are null or come twice."""
        table, aside = _quoted(self.table), _quoted(self.aside)
        run(f"DELETE FROM {_quoted(self.counting)}")
        cursor.executemany(f"INSERT INTO {_quoted(self.counting)} VALUES ({self.marks(1)})", [(m.task,) for m in messages if m])
        rows = f"FROM {aside} WHERE task__ IN (SELECT task__ FROM {_quoted(self.counting)})"
        if self.overwrite:
            run(f"DELETE FROM {table}")
        elif self.prune:
            run(f"DELETE FROM {table} WHERE {self.prune}")
        then = ""
        if self.keys:
            keys = ", ".join(map(_quoted, self.keys))
            run(f"SELECT 1 {rows} AND ({' OR '.join(f'{_quoted(k)} IS NULL' for k in self.keys)}) LIMIT 1")
            if cursor.fetchone():
                raise ValueError(f"a key of {self.keys} is null")
            run(f"SELECT {keys} {rows} GROUP BY {keys} HAVING count(*) > 1 LIMIT 1")
            if twice := cursor.fetchone():
                raise ValueError(f"the key {twice} comes twice in one batch")
            then = f" ON CONFLICT ({keys}) DO " + ("UPDATE SET " + ", ".join(f"{_quoted(c)} = excluded.{_quoted(c)}" for c in self.update) if self.update else "NOTHING")
        run(f"INSERT INTO {table} ({self.names}) SELECT {self.names} {rows}{then}")

    def drop(self, run) -> None:
        for t in (self.aside, self.counting):
            run(f"DROP TABLE IF EXISTS {_quoted(t)}")


class BatchWriter(DataSourceWriter):
    def __init__(self, sink: Sink) -> None:
        self.sink = sink
        sink.prepare()

    def write(self, iterator: Iterator) -> Written:
        return self.sink.put(iterator)

    def commit(self, messages: list) -> None:
        with self.sink.connect() as c:
            cursor = c.cursor()
            try:
                self.sink.move(cursor.execute, cursor, messages)
                c.commit()
            except BaseException:
                c.rollback()
                raise
            finally:
                self.sink.drop(cursor.execute)
                c.commit()

    def abort(self, messages: list) -> None:
        with self.sink.connect() as c:
            self.sink.drop(c.cursor().execute)
            c.commit()


class StreamWriter(DataSourceStreamWriter):
    """Rows put aside stay in one table of the query; each commit empties it, whatever attempt they came from."""

    def __init__(self, sink: Sink, query: str) -> None:
        self.sink, self.query = sink, query
        sink.prepare()

    def write(self, iterator: Iterator) -> Written:
        return self.sink.put(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        noted = _quoted(f"{self.sink.table}_batches")
        with self.sink.connect() as c:
            cursor = c.cursor()
            run = cursor.execute
            run(f"CREATE TABLE IF NOT EXISTS {noted} (query VARCHAR(200), batch BIGINT, PRIMARY KEY (query, batch))")
            c.commit()
            try:
                mark = self.sink.marks(1)
                run(f"SELECT 1 FROM {noted} WHERE query = {mark} AND batch = {mark}", (self.query, batchId))
                if not cursor.fetchone():
                    self.sink.move(run, cursor, messages)
                    run(f"DELETE FROM {noted} WHERE query = {mark} AND batch < {mark}", (self.query, batchId))
                    run(f"INSERT INTO {noted} VALUES ({mark}, {mark})", (self.query, batchId))
                run(f"DELETE FROM {_quoted(self.sink.aside)}")
                c.commit()
            except BaseException:
                c.rollback()
                raise

    def abort(self, messages: list, batchId: int) -> None:
        """What was put aside goes with the next commit: it has tags that don't count."""
