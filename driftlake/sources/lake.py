"""Lake tables on parquet directories, partitioned by day.

A table lives in ``root/name`` and only grows: files are added, never rewritten, so a stream
that reads it gets every row once, whenever it starts.  Day folders are outermost; the
innermost folder names the write a file came with.  A micro-batch overwrites its own folders
alone (Spark's dynamic partition overwrite), so one that runs again leaves no duplicates.

Compaction makes a copy: whole days, packed into few sorted files, below ``root/_packed``.
A reader takes a day from its copy if that holds as many of the table's files as there are, and else
from the table, so late rows are seen before the day is packed again.  A copy counts once
Spark has marked it as complete.  Table and copy go together when a day's time is up.

Days are cut in the session's time zone, which ``driftlake.session`` pins to UTC.
"""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.schemas import BATCH, TABLES, TableSpec

# Where packed days are kept, and the folder that says how many files a copy holds.
PACKED = "_packed"
FILES = "files"

# Event JSON is written in every layer and again when days are packed.
COMPRESSION = "zstd"

# The write that batch appends belong to.
APPENDED = "append"


def with_day(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumn(spec.date_column, F.to_date(spec.time_column))


def laid_out(df: DataFrame, spec: TableSpec, files_per_day: int | None = None) -> DataFrame:
    """Rows with their day, gathered per partition and sorted by time inside each file.

    With ``files_per_day`` a partition's rows spread over that many tasks; without it they
    are written from where they are, and AQE evens out the tasks.
    """
    dated = with_day(df, spec)
    if files_per_day is None:
        dated = dated.hint("rebalance", *[F.col(name) for name in spec.partitions])
    else:
        slot = F.pmod(F.xxhash64(F.col(spec.time_column)), F.lit(files_per_day))
        dated = dated.repartition(*[F.col(name) for name in spec.partitions], slot)
    return dated.sortWithinPartitions(*spec.partitions, spec.time_column)


def _overwrite_partitions(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Put rows in the place of the partitions they belong to."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path, compression=COMPRESSION)


@dataclass(frozen=True)
class Lake(Mapping):
    """Reads like a mapping from table name to DataFrame."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def packed_path(self, name: str) -> str:
        return os.path.join(self.root, PACKED, name)

    def _fs(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def _exists(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def _glob(self, *parts: str) -> list[str]:
        fs, pattern = self._fs(os.path.join(*parts))
        return [status.getPath().toString() for status in fs.globStatus(pattern) or []]

    def ensure_table(self, spec: TableSpec) -> str:
        """Create the table, empty, where it is missing."""
        target = self.path(spec.name)
        if not self._exists(target):
            empty = self.spark.createDataFrame([], spec.stored_schema)
            empty.write.partitionBy(*spec.stored_partitions).parquet(target)
        return target

    def ensure_all(self) -> None:
        for spec in TABLES.values():
            self.ensure_table(spec)

    def append(self, spec: TableSpec, df: DataFrame, files_per_day: int | None = None) -> None:
        rows = laid_out(df.select(*spec.schema.names), spec, files_per_day).withColumn(BATCH, F.lit(APPENDED))
        rows.write.mode("append").partitionBy(*spec.stored_partitions).parquet(
            self.path(spec.name), compression=COMPRESSION
        )

    def write_batch(
        self, spec: TableSpec, df: DataFrame, writer: str, batch_id: int, files_per_day: int | None = None
    ) -> None:
        """Write one micro-batch of the stream ``writer``, for ``foreachBatch``.

        A batch that runs again puts its rows in the place of the first run's.  With
        ``files_per_day`` a partition gets at most that many files; without it the rows are
        written from where they are.  Either way each file is sorted.
        """
        rows = df.select(*spec.schema.names)
        if files_per_day is None:
            rows = with_day(rows, spec).sortWithinPartitions(*spec.partitions, spec.time_column)
        else:
            rows = laid_out(rows, spec, files_per_day)
        labelled = rows.withColumn(BATCH, F.lit(f"{writer}-{batch_id:012d}"))
        _overwrite_partitions(labelled, self.path(spec.name), spec.stored_partitions)

    def live(self, spec: TableSpec) -> DataFrame:
        """The table's own files, with the stored columns."""
        return self.spark.read.schema(spec.stored_schema).parquet(self.path(spec.name))

    def read(self, name: str) -> DataFrame:
        return self.read_table(TABLES[name])

    def read_table(self, spec: TableSpec) -> DataFrame:
        """The table's rows, days that are packed from their copies."""
        live = self.live(spec)
        packed = self.packed_days(spec, live)
        if not packed:
            return live.select(*spec.columns)
        days = [F.lit(day).cast("date") for day in sorted(packed)]
        rest = live.filter(F.col(spec.date_column).isNull() | ~F.col(spec.date_column).isin(*days))
        reader = self.spark.read.schema(spec.stored_schema).option("basePath", self.packed_path(spec.name))
        copies = reader.parquet(*[packed[day] for day in sorted(packed)])
        return rest.select(*spec.columns).unionByName(copies.select(*spec.columns))

    def stream(self, name: str, max_files: int | None = None, max_bytes: str | None = None) -> DataFrame:
        """The table as a stream: first all its files, then each as it is added."""
        spec = TABLES[name]
        reader = self.spark.readStream.schema(spec.stored_schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        if max_bytes:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        return reader.parquet(self.path(name)).select(*spec.columns)

    # -- days ----------------------------------------------------------------------
    def days(self, spec: TableSpec) -> list[str]:
        """The table's day partitions, from its folder names."""
        prefix = f"{spec.date_column}="
        names = [os.path.basename(path) for path in self._glob(self.path(spec.name), f"{prefix}*")]
        return sorted(name.removeprefix(prefix) for name in names)

    def newest_days(self, name: str, rows: int, wanted: Column | None = None) -> DataFrame:
        """The table cut to the newest days that hold ``rows`` (``wanted``) rows, and one day more.

        Days are probed from the newest, twice as many each time, and a probe stops at
        enough rows; earlier days are never opened.  The day more is for rows that arrive
        after midnight: rows more than a day late are not among the newest.
        """
        spec = TABLES[name]
        table = self.read_table(spec)
        table = table if wanted is None else table.filter(wanted)
        days, take = self.days(spec), 1
        while take < len(days):
            newest = table.filter(F.col(spec.date_column) >= F.lit(days[-take]).cast("date"))
            if newest.select(F.lit(1)).limit(rows).count() >= rows:
                return table.filter(F.col(spec.date_column) >= F.lit(days[-take - 1]).cast("date"))
            take *= 2
        return table

    def drop_days(self, spec: TableSpec, days: Sequence[str]) -> None:
        """Delete whole day partitions and their copies; no row is read."""
        for day in days:
            folder = f"{spec.date_column}={day}"
            copies = self._glob(self.packed_path(spec.name), "run=*", folder)
            for path in [os.path.join(self.path(spec.name), folder), *copies]:
                fs, target = self._fs(path)
                fs.delete(target, True)

    def publish_days(
        self, spec: TableSpec, target: "Lake", first_day: str, last_day: str, files_per_day: int | None = None
    ) -> None:
        """Copy whole days to another lake in few, sorted files.

        The days are replaced there, so publishing a day again, with rows that came late,
        leaves no duplicates.  Streams are to read the table itself, not the copy.
        """
        target.ensure_table(spec)
        bounds = F.col(spec.date_column).between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
        rows = self.read_table(spec).filter(bounds).select(*spec.schema.names)
        published = laid_out(rows, spec, files_per_day).withColumn(BATCH, F.lit("published"))
        _overwrite_partitions(published, target.path(spec.name), spec.stored_partitions)

    # -- packed copies -------------------------------------------------------------
    def _files_by_day(self, spec: TableSpec, live: DataFrame) -> Counter:
        """How many files each day has, from the listing the reader has made anyway."""
        found = (re.search(rf"/{spec.date_column}=([0-9-]+)/", path) for path in live.inputFiles())
        return Counter(match[1] for match in found if match)

    def packed_days(self, spec: TableSpec, live: DataFrame | None = None) -> dict[str, str]:
        """The folder of each day's copy, for days whose copy holds all of their files."""
        done = self._glob(self.packed_path(spec.name), "run=*", "_SUCCESS")
        if not done:
            return {}
        there = self._files_by_day(spec, self.live(spec) if live is None else live)
        chosen = {}
        for marker in sorted(done):
            for path in self._glob(os.path.dirname(marker), f"{spec.date_column}=*", f"{FILES}=*"):
                day, files = re.search(rf"/{spec.date_column}=([^/]+)/{FILES}=(\d+)$", path).groups()
                if there.get(day) == int(files):
                    chosen[day] = path
        return chosen

    def pack_days(self, spec: TableSpec, days: Sequence[str]) -> None:
        """Copy whole days into few sorted files; one write for all of them, none if there are no days.

        Rows and the number of files they come from are of one listing.
        """
        if not days:
            return
        live = self.live(spec)
        there = self._files_by_day(spec, live)
        wanted = {day: there[day] for day in days if day in there}
        files = F.create_map(*[F.lit(part) for pair in wanted.items() for part in pair])
        day = F.col(spec.date_column).cast("string")
        rows = live.filter(F.col(spec.date_column).isin(*[F.lit(name).cast("date") for name in wanted]))
        folders = [spec.date_column, FILES, *spec.extra_partitions]
        packed = laid_out(rows.select(*spec.schema.names), spec).withColumn(FILES, files[day])
        self._drop_stale(spec)
        packed.sortWithinPartitions(*folders, spec.time_column).write.partitionBy(*folders).parquet(
            os.path.join(self.packed_path(spec.name), f"run={uuid.uuid4().hex}"), compression=COMPRESSION
        )

    def _drop_stale(self, spec: TableSpec) -> None:
        """Delete copies no reader takes any more, and those that never got complete."""
        used = set(self.packed_days(spec).values())
        for path in self._glob(self.packed_path(spec.name), "run=*", f"{spec.date_column}=*", f"{FILES}=*"):
            if path not in used:
                fs, target = self._fs(path)
                fs.delete(target, True)

    def reader_files(self, spec: TableSpec) -> list[str]:
        """Folders whose files a reader opens: packed copies, and the table's other days."""
        packed = self.packed_days(spec)
        live = [os.path.join(self.path(spec.name), f"{spec.date_column}={day}") for day in self.days(spec) if day not in packed]
        return [*live, *packed.values()]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES or not self._exists(self.path(name)):
            raise KeyError(name)
        return self.read(name)

    def __iter__(self) -> Iterator[str]:
        return (name for name in TABLES if self._exists(self.path(name)))

    def __len__(self) -> int:
        return sum(1 for _ in self)


def iceberg_ddl(spec: TableSpec, catalog_table: str) -> list[str]:
    """The statements that create the same table where an Iceberg catalog is configured."""
    columns = ",\n  ".join(
        f"{field.name} {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in spec.schema.fields
    )
    parts = ", ".join([f"days({spec.time_column})", *spec.extra_partitions])
    return [
        f"CREATE TABLE IF NOT EXISTS {catalog_table} (\n  {columns}\n) USING iceberg PARTITIONED BY ({parts})",
        f"ALTER TABLE {catalog_table} WRITE ORDERED BY {spec.time_column} ASC",
    ]
