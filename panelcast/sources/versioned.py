"""A partitioned table with atomic commits (S14, U4, U5): readers see one version, whole or not at all.

Data folders are written once and never changed.  A version is a small table (``versions/v=<n>``) that lists a folder for each
partition; writing new folders shows nothing until a version that lists them is renamed into place.  The rename fails if the
version exists: a writer that started from an older version starts again from the new one.  Replacing a slice is a
version without its folders, or with others in their place.  What a crash leaves behind is in no version.

The rename must be atomic and refuse an existing target (HDFS does; an object store needs a committer of its own).
Metadata has a row per partition, whatever the number of rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators.dedupe import upsert

_PART = "_part"
_ENTRY = "part string, folder string, batch long, schema string"


class Conflict(Exception):
    """Another writer has committed the version first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partition: str):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self._fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ------------------------------------------------------------------ reading

    def version(self) -> int:
        """The latest committed version, 0 if there is none."""
        return max([int(n[2:]) for n in self._names("versions") if n.startswith("v=")], default=0)

    def read(self, version: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """The rows of a version (default: the latest), or of some of its partitions."""
        folders, _, schema = self._entries(self.version() if version is None else version)
        chosen = [f for p, f in folders.items() if parts is None or p in parts]
        if schema is None:
            raise ValueError(f"{self.path} has no version")
        return self.spark.read.schema(schema).parquet(*chosen) if chosen else self.spark.createDataFrame([], schema)

    def parts(self, version: int | None = None) -> list[str]:
        return sorted(self._entries(self.version() if version is None else version)[0])

    # ------------------------------------------------------------------ writing

    def stage(self, df: DataFrame) -> dict[str, str]:
        """Writes ``df`` into new folders, one per partition value; nothing refers to them yet."""
        base = f"data/{uuid.uuid4().hex}"
        df.withColumn(_PART, F.coalesce(F.col(self.partition).cast("string"), F.lit(""))).write.partitionBy(_PART).parquet(f"{self.path}/{base}")
        return {n: f"{self.path}/{base}/{n}" for n in self._names(base) if n.startswith(f"{_PART}=")}

    def commit(self, base: int, schema: T.StructType, add: dict[str, str], remove: list[str] = (), batch: int | None = None) -> int:
        """Version ``base + 1``: that of ``base`` without the partitions ``remove``, with the folders ``add``.  Raises :class:`Conflict`."""
        folders, last, _ = self._entries(base)
        kept = {p: f for p, f in folders.items() if p not in set(remove)} | add
        batch = last if batch is None else batch
        rows = [(None, None, batch, schema.json())] + [(p, f, None, None) for p, f in sorted(kept.items())]
        made = f"{self.path}/pending/{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, _ENTRY).coalesce(1).write.parquet(made)
        self._mkdirs("versions")
        self._rename(made, f"{self.path}/versions/v={base + 1:08d}")
        return base + 1

    def upsert(self, df: DataFrame, keys: list[str], batch: int | None = None, tries: int = 5) -> int:
        """U4: rows of ``df`` replace those with the same keys; only the partitions that it touches are written again.

        A ``batch`` id that the table has seen is not applied again (a replayed micro-batch).
        """
        incoming = self.stage(df)
        new = self.spark.read.schema(df.schema).parquet(*incoming.values()) if incoming else df.limit(0)
        for _ in range(tries):
            base = self.version()
            folders, last, _ = self._entries(base)
            if batch is not None and last is not None and batch <= last:
                return base
            touched = [p for p in incoming if p in folders]
            add = incoming
            if touched:
                add = incoming | self.stage(upsert(self.read(base, touched).select(*df.columns), new, keys))
            try:
                return self.commit(base, df.schema, add, batch=batch)
            except Conflict:
                continue
        raise Conflict(f"{self.path}: {tries} other commits came first")

    def replace(self, parts: list[str], df: DataFrame | None = None, tries: int = 5) -> int:
        """The partitions ``parts`` (values) go; the rows of ``df`` (of these partitions) take their place."""
        gone = [f"{_PART}={p}" for p in parts]
        add = self.stage(df) if df is not None else {}
        if set(add) - set(gone):
            raise ValueError(f"rows outside the slice: {sorted(set(add) - set(gone))}")
        for _ in range(tries):
            base = self.version()
            schema = df.schema if df is not None else self._entries(base)[2]
            try:
                return self.commit(base, schema, add, gone)
            except Conflict:
                continue
        raise Conflict(f"{self.path}: {tries} other commits came first")

    # ------------------------------------------------------------------ files

    def _entries(self, version: int) -> tuple[dict[str, str], int | None, T.StructType | None]:
        """(folders by partition, last batch, schema) of a version."""
        if version == 0:
            return {}, None, None
        rows = self.spark.read.schema(_ENTRY).parquet(f"{self.path}/versions/v={version:08d}").collect()
        head = next(r for r in rows if r.part is None)
        return {r.part: r.folder for r in rows if r.part is not None}, head.batch, T.StructType.fromJson(json.loads(head.schema))

    def _names(self, folder: str) -> list[str]:
        where = self._fs_path(f"{self.path}/{folder}")
        fs = where.getFileSystem(self._conf)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def _mkdirs(self, folder: str) -> None:
        where = self._fs_path(f"{self.path}/{folder}")
        where.getFileSystem(self._conf).mkdirs(where)

    def _rename(self, made: str, target: str) -> None:
        jvm = self.spark.sparkContext._jvm
        src, dst = self._fs_path(made), self._fs_path(target)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.getFileSystem(self._conf).getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(src, dst, none)
        except Exception as e:  # py4j wraps the Java exception
            if "FileAlreadyExistsException" in str(e) or "already exists" in str(e):
                raise Conflict(target) from e
            raise
