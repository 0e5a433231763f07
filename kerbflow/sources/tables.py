"""Keyed tables on plain parquet.

Rows lie sorted by key in files of a bounded number of rows, so each file covers a short range of keys. An upsert looks up
which files hold a key of its batch (Parquet's least and greatest keys leave most files unread, of the others only the key
columns are read), and writes the new content of those files alone, once, to a staging folder. A mark then lists the files
that it replaces; they are removed and the staged files are moved in. So the bytes written follow the batch, the plan
never overwrites what it reads, and a rerun of the same batch gives the same table. Where a job dies in between, the
marked staging folder is applied before the next read or merge. Insert-only batches append the rows whose key is absent.
One writer per table.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.operators.merge import new_rows, upsert


@dataclass(frozen=True)
class KeyedTable:
    """A parquet table with a key, partitioned by the day of a time column or by a hash of the key.

    `buckets` belongs to the table and must not change once it holds rows: choose it so that a bucket fits a task. Columns
    that a batch brings beyond the schema are added; older rows have nulls there.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    day_of: str | None = None
    stamped: str | None = None  # column that holds the time of the write
    buckets: int = 16
    rows_per_file: int = 2_000_000

    @property
    def part(self) -> str:
        return "part_day" if self.day_of else "part_bucket"

    def _placed(self, df: DataFrame) -> DataFrame:
        if self.day_of:
            return df.withColumn(self.part, F.to_date(self.day_of))
        return df.withColumn(self.part, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _hadoop(self, path: str):
        context = self.spark.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(context._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        at, fs = self._hadoop(path)
        return fs.exists(at)

    def _with_part(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField(self.part, T.DateType() if self.day_of else T.IntegerType())])

    def _names(self, path: str, files: bool = False) -> list[str]:
        """What a folder holds: names of its entries, or paths of all files below it."""
        if not self._exists(path):
            return []
        at, fs = self._hadoop(path)
        if not files:
            return sorted(x.getPath().getName() for x in fs.listStatus(at))
        found, listed = [], fs.listFiles(at, True)
        while listed.hasNext():
            found.append(listed.next().getPath().toString())
        return found

    def _write_file(self, path: str, content: str) -> None:
        """The whole content or no file: it gets its name when it is complete."""
        part, fs = self._hadoop(f"{path}.part")
        out = fs.create(part, True)
        out.write(bytearray(content, "utf-8"))
        out.close()
        fs.rename(part, self._hadoop(path)[0])

    def _columns(self) -> T.StructType:
        """The schema, with the columns that batches have added: the newest of its numbered versions."""
        versions = [n for n in self._names(f"{self.path}.schemas") if n.endswith(".json")]
        if not versions:
            return self.schema
        return T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.path}.schemas/{versions[-1]}").first()[0]))

    def _stored(self) -> DataFrame:
        """All stored rows. Only a table that is not there is empty; any other failure to read is an error."""
        self._recover()
        full = self._with_part(self._columns())
        if not self._exists(self.path):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(self.part)

    def _prepared(self, batch: DataFrame) -> DataFrame:
        """The batch with all columns of the table; new columns are noted first."""
        if self.stamped:
            batch = batch.withColumn(self.stamped, F.current_timestamp())
        known = self._columns()
        fresh = [f for f in batch.schema.fields if f.name not in known.names]
        if fresh:
            known = T.StructType([*known.fields, *(T.StructField(f.name, f.dataType) for f in fresh)])
            number = sum(n.endswith(".json") for n in self._names(f"{self.path}.schemas")) + 1
            self._write_file(f"{self.path}.schemas/{number:08}.json", known.json())
        return batch.select(*(F.col(f.name) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in known.fields))

    def _touched(self, placed: DataFrame) -> DataFrame:
        """Stored rows of the partitions of a batch; their values are literals, so other directories are not listed.

        There is one value per calendar day of the batch, or per bucket.
        """
        parts = [r[0] for r in placed.select(self.part).distinct().collect()]
        return self._stored().where(F.col(self.part).isin(parts) if parts else F.lit(False))

    def _write(self, df: DataFrame, path: str, mode: str) -> None:
        # Rebalancing makes files of an even size: a heavy day is split over tasks, light days share one.
        df.hint("rebalance", self.part).sortWithinPartitions(self.part, *self.keys).write.mode(mode).option(
            "maxRecordsPerFile", self.rows_per_file).partitionBy(self.part).parquet(path)

    def _recover(self) -> None:
        """Put a marked staging folder in place of the files that its mark lists; one without a mark is what a dead job left.

        Files that are already gone or moved are passed over, so a recovery that died is taken up where it stopped.
        """
        staging, done = f"{self.path}.staging", f"{self.path}.staged"
        if self._exists(done):
            _, fs = self._hadoop(self.path)
            for row in self.spark.read.text(done).collect():
                fs.delete(self._hadoop(row[0])[0], False)
            root = self._hadoop(staging)[0].makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
            for file in self._names(staging, files=True):
                target = self._hadoop(self.path + file[file.index(root) + len(root):])[0]
                if "/part-" in file:
                    fs.mkdirs(target.getParent())
                    fs.rename(self._hadoop(file)[0], target)
        for left in (done, staging):
            at, fs = self._hadoop(left)
            fs.delete(at, True)

    def _replace(self, files: list[str], rows: DataFrame) -> None:
        """Rows in place of those files."""
        self._write(self._placed(rows), f"{self.path}.staging", "overwrite")
        self._write_file(f"{self.path}.staged", "\n".join(files))
        self._recover()

    def _files(self, files: list[str]) -> DataFrame:
        """Stored rows of those files."""
        full = self._with_part(self._columns())
        return (self.spark.read.schema(full).option("basePath", self.path).parquet(*files) if files else self.spark.createDataFrame([], full)).drop(self.part)

    def _files_with(self, rows: DataFrame) -> list[str]:
        """Files that hold a key of these rows; the names of those files reach the driver, as for any table that is listed."""
        if not self._exists(self.path):
            return []
        placed = self._placed(rows)
        # As text, so that each bound comes back as a literal of the key's own type.
        ends = {"least": F.min, "most": F.max}
        bounds = placed.agg(*(end(k).cast("string").alias(f"{name}_{k}") for k in self.keys for name, end in ends.items())).first()
        stored = self._touched(placed)
        for k in self.keys:
            least, most = (F.lit(bounds[f"{name}_{k}"]).cast(stored.schema[k].dataType) for name in ends)
            if bounds[f"least_{k}"] is not None:
                stored = stored.where(F.col(k).between(least, most))
        held = stored.select(*self.keys, F.col("_metadata.file_path").alias("__file"))
        found = held.join(rows.select(*self.keys), self.keys, "left_semi").select("__file").distinct().collect()
        return sorted(unquote(r[0]) for r in found)

    def merge(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Replace the files that hold a key of the batch by `combine(their rows, batch)`.

        A day-partitioned table has the day in its key, so a key never moves between partitions.
        """
        rows = self._prepared(batch)
        files = self._files_with(rows)
        self._replace(files, combine(self._files(files), rows))

    def upsert(self, batch: DataFrame, order: list[str] | None = None) -> None:
        self.merge(batch, lambda t, b: upsert(t, b, self.keys, order))

    def insert_new(self, batch: DataFrame, order: list[str] | None = None) -> None:
        """Append the rows whose key is absent. A batch that runs again finds its keys and appends nothing."""
        rows = self._prepared(batch)
        self._write(self._placed(new_rows(self._touched(self._placed(rows)).drop(self.part), rows, self.keys, order)), self.path, "append")
