"""Result tables whose batches appear as a whole or not at all, by the day of their windows.

    <path>/<table>/batch=<name>/day=<date>/   rows, written before the commit
    <path>/commits/                           a log, one row for a batch or a compaction

A batch writes its rows of all tables into folders of its own and then adds one row
to the log, which makes all of them visible at once. Folders are never written
again: a batch that runs a second time writes new ones, and the log says which
count. What a failed run left behind is named by no row and read by nobody.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "batch_id bigint, batch string, compacted boolean, tables array<string>"


@dataclass
class ResultTables:
    spark: SparkSession
    path: str

    def write(self, batch_id: int, **tables: DataFrame) -> None:
        """Add one batch of rows to each of the tables (with a ``day``) and commit them together.

        A batch whose id is committed already stays as it is: it was written from the same records.
        """
        if batch_id in self._batches():
            return
        self._commit(batch_id, tables, compacted=False)

    def compact(self, schemas: dict[str, str], upto: int) -> None:
        """Put the batches up to an id together, one file for a day and table where Spark can; readers go over with the commit."""
        names = [name for batch_id, name in self._batches(upto).items()]
        if len(names) > 1:
            # rows of a day meet in one task, and large days are cut by size when they are written
            whole = {table: self._rows(table, schema, names).repartition("day") for table, schema in schemas.items()}
            self._commit(upto, whole, compacted=True)

    def read(self, table: str, schema: str) -> DataFrame:
        """The committed rows of a table, with their ``day``; a filter on it reads only the folders of those days."""
        return self._rows(table, schema, list(self._batches().values()))

    def _commit(self, batch_id: int, tables: dict[str, DataFrame], compacted: bool) -> None:
        name = f"{batch_id}-{uuid.uuid4().hex}"
        for table, rows in tables.items():
            rows.write.partitionBy("day").parquet(f"{self.path}/{table}/batch={name}")
        row = self.spark.createDataFrame([(batch_id, name, compacted, sorted(tables))], _LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _log(self) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], _LOG)
        return self.spark.read.schema(_LOG).parquet(f"{self.path}/commits")

    def _batches(self, upto: int | None = None) -> dict[int, str]:
        """The names that count, by batch id: the last compaction and the batches after it. So many rows reach the driver."""
        log = self._log() if upto is None else self._log().filter(F.col("batch_id") <= upto)
        last = log.filter("compacted").agg(F.max("batch_id")).first()[0]
        if last is not None:
            log = log.filter((F.col("batch_id") > last) | ((F.col("batch_id") == last) & F.col("compacted")))
        # of two runs of one batch either holds the same rows
        chosen = log.groupBy("batch_id").agg(F.min("batch").alias("batch")).collect()
        return {row.batch_id: row.batch for row in chosen}

    def _rows(self, table: str, schema: str, names: list[str]) -> DataFrame:
        root = f"{self.path}/{table}"
        if not names:
            return self.spark.createDataFrame([], f"{schema}, day date")
        folders = [f"{root}/batch={name}" for name in names]
        rows = self.spark.read.schema(f"{schema}, batch string, day date").option("basePath", root)
        return rows.parquet(*folders).drop("batch")
