"""Tables written by micro-batches: one folder per batch, visible once the batch is committed.

A retried batch overwrites its own folders, and readers only see batches with a commit marker, so
all tables of a batch appear together and replays change nothing. Keyed tables are resolved when
read (the last batch wins); ``compact`` folds the batches so far into a base, which is partitioned by
the table's partition column if it has one: a filter on that column leaves out the other folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.upsert import latest_by_key

BATCH = "batch_id"
_COMMITS = "_committed"
_MARK = T.StructType([
    T.StructField("at", T.TimestampType()), T.StructField("query", T.StringType()), T.StructField("source_batch", T.LongType()),
    T.StructField("counters", T.MapType(T.StringType(), T.LongType())),
])


class BatchStore:
    def __init__(self, spark: SparkSession, root: str, parts: Mapping[str, str] | None = None):
        """``parts`` names the partition column of tables that have one."""
        self.spark, self.root, self.parts = spark, root.rstrip("/"), parts or {}
        self._attempt = f"{self.root}/_stage/{uuid.uuid4().hex}"

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _load(self, path: str, schema: T.StructType) -> DataFrame:
        full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        if not self._exists(f"{self.root}/{path}"):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(f"{self.root}/{path}")

    def write(self, table: str, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/{BATCH}={batch_id}")

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write working rows of the running batch and read them back.

        Cuts the lineage on shared storage: a lost executor costs a re-read, not a recomputation,
        and the plans that follow stay small.
        """
        path = f"{self._attempt}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def batch(self, table: str, schema: T.StructType, batch_id: int) -> DataFrame | None:
        """The rows that one batch wrote to a table, if it wrote any folder."""
        path = f"{self.root}/{table}/{BATCH}={batch_id}"
        return self.spark.read.schema(schema).parquet(path) if self._exists(path) else None

    def drop_batch(self, table: str, batch_id: int) -> None:
        self._delete(f"{self.root}/{table}/{BATCH}={batch_id}")

    def note(self, kind: str, name: str) -> None:
        """Leave an empty file: a fact that outlives this process."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_{kind}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True).close()

    def notes(self, kind: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_{kind}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def drop_note(self, kind: str, name: str) -> None:
        self._delete(f"{self.root}/_{kind}/{name}")

    def commit(
        self, batch_id: int, query: str = "direct", source_batch: int = -1, counters: Mapping[str, int] | None = None
    ) -> None:
        """Make the batch visible; remembers which micro-batch of which query it was and what it counted.
        Working rows go.

        A batch must have written all of its tables, empty ones too: what an earlier attempt under the same
        number left behind is then overwritten.
        """
        self._mark(_COMMITS, batch_id, query, source_batch, counters or {})
        self._delete(self._attempt)
        self._attempt = f"{self.root}/_stage/{uuid.uuid4().hex}"

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def _mark(self, marks: str, batch_id: int, query: str, source_batch: int, counters: Mapping[str, int]) -> None:
        counted = F.create_map(*[F.lit(x) for pair in counters.items() for x in pair]).cast("map<string,bigint>")
        row = self.spark.range(1).select(
            F.current_timestamp().alias("at"), F.lit(query).alias("query"), F.lit(source_batch).cast("long").alias("source_batch"),
            counted.alias("counters"),
        )
        row.write.mode("overwrite").parquet(f"{self.root}/{marks}/{BATCH}={batch_id}")

    def _last(self, marks: str) -> int:
        """Highest marked batch, from the folder names alone. Folders without a marker do not count."""
        for n in sorted(self._folders(marks), reverse=True):
            if self._exists(f"{self.root}/{marks}/{BATCH}={n}/_SUCCESS"):
                return n
        return -1

    def _folders(self, table: str) -> list[int]:
        """Batch numbers that have a folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().toString() for f in fs.listStatus(path)] if fs.exists(path) else []
        return [int(n.rsplit("=", 1)[1]) for n in names if f"/{BATCH}=" in n]

    def committed(self) -> int:
        return self._last(_COMMITS)

    def query_progress(self) -> dict[str, int]:
        """Last committed micro-batch of each query."""
        rows = self._load(_COMMITS, _MARK).where(F.col(BATCH) <= self.committed())
        return {r.query: r.n for r in rows.groupBy("query").agg(F.max("source_batch").alias("n")).collect()}

    def counters(self) -> dict[str, int]:
        """What all committed batches counted together."""
        rows = self._load(_COMMITS, _MARK).where(F.col(BATCH) <= self.committed())
        each = rows.select(F.explode("counters").alias("name", "n"))
        return {r.name: r.n for r in each.groupBy("name").agg(F.sum("n").alias("n")).collect()}

    def log(self, table: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
        """All committed rows of a table, up to a batch when given."""
        last = self.committed() if upto is None else upto
        return self._load(table, schema).where(F.col(BATCH) <= last)

    def base(self, table: str, schema: T.StructType) -> DataFrame:
        """The rows of the last base, none before the first."""
        return self._load(f"{table}_base", schema).where(F.col(BATCH) == self._last(f"{table}_base{_COMMITS}"))

    def current(
        self, table: str, schema: T.StructType, keys: list[str], upto: int | None = None,
        columns: list[str] | None = None, among: DataFrame | None = None, where: Column | None = None,
    ) -> DataFrame:
        """Latest row of each key: of ``columns`` only, and of the keys in ``among`` only (of those key columns
        that it has).

        Both narrow the rows before the aggregation, so a lookup reads the columns it asks for and shuffles
        the rows of its keys. ``where`` is a condition on the partition column, which must follow from the key:
        only folders that meet it are read.
        """
        base_batch = self._last(f"{table}_base{_COMMITS}")
        rows = self.log(table, schema, upto)
        if base_batch >= 0:
            rows = rows.where(F.col(BATCH) > base_batch).unionByName(self.base(table, schema))
        if where is not None:
            rows = rows.where(where)
        if columns is not None:
            rows = rows.select(*keys, *[c for c in columns if c not in keys], BATCH)
        if among is not None:
            narrow = [k for k in keys if k in among.columns]
            rows = rows.join(among.select(*narrow).distinct(), narrow, "left_semi")
        return latest_by_key(rows, keys, [BATCH])

    def compact(self, table: str, schema: T.StructType, keys: list[str]) -> int:
        """Write the current state as a new base. Folders that the base before it already covered go; those
        since stay one generation longer, for readers that began earlier."""
        upto, before = self.committed(), self._last(f"{table}_base{_COMMITS}")
        rows, part = self.current(table, schema, keys, upto).drop(BATCH), self.parts.get(table)
        path = f"{self.root}/{table}_base/{BATCH}={upto}"
        if part:  # a large part is cut into several files, small ones do not become many
            rows.hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)
        self._mark(f"{table}_base{_COMMITS}", upto, "compact", upto, {})
        for n in self._folders(table):
            if n <= before:
                self._delete(f"{self.root}/{table}/{BATCH}={n}")
        return upto
