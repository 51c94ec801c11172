"""Keyed rows in buckets, for reads and joins by one column without a shuffle or a scan of all files.

A bucket holds all rows of some values of the column, whatever their time, so a student's rows are in
one of them: a condition on the column opens that bucket only, and joins and aggregates by it need no
exchange. The log, which is split by day, is what streams write; this is what a job makes of it.
"""

from __future__ import annotations

from datetime import UTC, datetime
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse.model import TableSpec
from coursepulse.operators.latest import has_key, latest_by_key
from coursepulse.workspace import delete_folder, file_names, path_exists

_WRITTEN = T.StructField("written_at", T.TimestampType())
_STARTED = "written"


class BucketedTable:
    """The rows of a keyed table, bucketed by a column of its key.

    Generations lie below ``path``; the newest complete one counts. ``add`` puts rows into it, ``compact``
    writes the next. The catalog only needs a session's own tables: what a generation is bucketed by
    stands in its folder's name, and its table is declared where it is first used.
    """

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, by: str = "student_id",
                 buckets: int = 64):
        if by not in spec.key:
            raise ValueError(f"{by} is not part of the key of {spec.name}")
        self.spark, self.path, self.spec, self.by = spark, path.rstrip("/"), spec, by
        self.buckets = buckets
        self._schema = T.StructType([*spec.schema.fields, *spec.order, _WRITTEN])

    # --- writing ---

    def add(self, rows: DataFrame) -> None:
        """Add rows with a full key; of each key the last write counts. Rows added twice do no harm."""
        names = self._generations()
        self._insert(self._stamped(rows), names[0] if names else self._new())

    def compact(self) -> None:
        """Write the current rows as a new generation, whose buckets are single files but for large
        ones. Reads of the one before may go on until ``prune``. Not beside ``add``."""
        names = self._generations()
        if names:
            self._insert(self._settled(names[0]), self._new())

    def replace(self, rows: DataFrame) -> None:
        """A new generation of these rows alone."""
        self._insert(self._stamped(rows), self._new())

    def prune(self) -> None:
        """Delete all generations but the newest."""
        for name in self._generations()[1:]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
            delete_folder(self.spark, f"{self.path}/{name}")

    def _stamped(self, rows: DataFrame) -> DataFrame:
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType)
            .alias(f.name) for f in self._schema.fields[:-1]]
        now = F.lit(datetime.now(UTC)).cast("timestamp").alias(_WRITTEN.name)
        return rows.select(*columns).filter(has_key(self.spec.key)).select("*", now)

    def _insert(self, rows: DataFrame, name: str) -> None:
        """Rows are dealt by bucket; adaptive execution lets small buckets share a task and splits the
        bucket of a hot value over several tasks and files."""
        dealt = rows.select(*self._schema.names).hint("rebalance", self._buckets_of(name), self.by)
        table = self._declared(name)
        dealt.write.insertInto(table)
        self.spark.catalog.refreshTable(table)

    # --- reading ---

    def rows(self) -> DataFrame:
        """The current row of every key. The settling is by bucket, so it needs no exchange."""
        names = self._generations()
        if not names:
            return self.spark.createDataFrame([], self.spec.schema)
        return self._settled(names[0]).select(*self.spec.columns)

    def lookup(self, *values: object) -> DataFrame:
        """Current rows with these values in the column, from their buckets alone, in key order."""
        rest = [name for name in self.spec.key if name != self.by]
        return self.rows().filter(F.col(self.by).isin(*values)).orderBy(self.by, *rest)

    def _settled(self, name: str) -> DataFrame:
        return latest_by_key(self.spark.table(self._declared(name)), self.spec.key,
                             [_WRITTEN.name, *(field.name for field in self.spec.order)])

    # --- generations ---

    def _new(self) -> str:
        micros = int(datetime.now(UTC).timestamp() * 1_000_000)
        return f"{_STARTED}={micros:020d}-{self.by}-{self.buckets}"

    def _generations(self) -> list[str]:
        """The complete ones, the newest first."""
        names = [name for name in file_names(self.spark, self.path) if name.startswith(_STARTED)]
        return [name for name in sorted(names, reverse=True)
                if path_exists(self.spark, f"{self.path}/{name}/_SUCCESS")]

    @staticmethod
    def _buckets_of(name: str) -> int:
        return int(name.rsplit("-", 1)[1])

    def _table(self, name: str) -> str:
        return f"{self.spec.name}_{crc32(f'{self.path}/{name}'.encode()):08x}_{name[8:28]}"

    def _declared(self, name: str) -> str:
        """The name of a generation's table, declared over its folder."""
        table = self._table(name)
        if not self.spark.catalog.tableExists(table):
            _, by, buckets = name.rsplit("-", 2)
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema.fields)
            order = ", ".join(f"`{key}`" for key in (by, *(k for k in self.spec.key if k != by)))
            self.spark.sql(
                f"CREATE TABLE {table} ({fields}) USING parquet CLUSTERED BY (`{by}`) "
                f"SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return table
