"""Ids that a batch was given, and ranges of ids that are taken: both outlive a repeated batch.

``<base>/ids/batch_id=<b>`` says which id each file of a batch got; ``<base>/ranges/batch_id=<b>`` which
numbers it took of a kind. Both are only ever added to, before anything that uses the ids is written, and a
batch reads its own folder alone; the next free number comes from the ranges, one short row per batch and
kind, so neither facts nor parents are read for it. If a write was done twice the smallest id holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.metadata import assign_ids
from gridloom.session import cut_lineage
from gridloom.sources.paths import child_names, exists

PARENT, FACT_ROW = "parent", "fact"
_RANGES = "kind string, low long, high long"


class Ledger:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _folder(self, name: str, batch_id: str) -> str:
        return f"{self.base}/{name}/batch_id={batch_id}"

    def _own(self, name: str, batch_id: str, schema: str) -> DataFrame:
        path = self._folder(name, batch_id)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def ranges(self) -> DataFrame:
        """kind, low, high, batch_id of all batches."""
        path = f"{self.base}/ranges"
        schema = f"{_RANGES}, batch_id string"
        if not child_names(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def batches(self, kind: str) -> set[str]:
        """Batches that took numbers of the kind: a name each, as many as folders."""
        return {r.batch_id for r in self.ranges().where(F.col("kind") == kind).select("batch_id").distinct().collect()}

    def last(self, kind: str) -> int:
        """The largest number taken, 0 if none was."""
        of_kind = self.ranges().where(F.col("kind") == kind)
        return of_kind.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0]

    def take(self, kind: str, batch_id: str, rows: int, after: int = 0) -> int:
        """The number before the first of ``rows`` ones for the batch; a repeated batch gets its own again
        as long as it has no more rows. Numbers are larger than ``after``."""
        own = self._own("ranges", batch_id, _RANGES).where(F.col("kind") == kind)
        fits = own.where(F.col("high") - F.col("low") + 1 >= rows).agg(F.min("low")).first()[0]
        if fits is not None:
            return fits - 1
        start = max(self.last(kind), after)
        taken = self.spark.createDataFrame([(kind, start + 1, start + rows)], _RANGES)
        taken.coalesce(1).write.mode("append").parquet(self._folder("ranges", batch_id))
        return start

    def ids(self, batch_id: str, key: str = "file_id") -> DataFrame:
        """key, id_chronogramme of the batch's files so far."""
        own = self._own("ids", batch_id, f"{key} string, id_chronogramme long")
        return own.groupBy(key).agg(F.min("id_chronogramme").alias("id_chronogramme"))

    def with_ids(
        self,
        files: DataFrame,
        batch_id: str,
        after: int = 0,
        ordinal: str | None = None,
        key: str = "file_id",
    ) -> DataFrame:
        """``files`` with the ids of the ledger; files that the batch did not have before get new ones,
        along ``ordinal`` if there is one, which are entered first."""
        known = cut_lineage(self.ids(batch_id, key), "ids")
        new = files.join(known, key, "left_anti")
        rows = new.count()
        if rows:
            start = self._after(batch_id, rows, after)
            fresh = assign_ids(new, start, ordinal).select(key, "id_chronogramme")
            fresh.write.mode("append").parquet(self._folder("ids", batch_id))
            known = cut_lineage(self.ids(batch_id, key), "ids")
        return files.join(known, key)

    def _after(self, batch_id: str, rows: int, after: int) -> int:
        """A range of its own for each lot of new files, even if the batch has an older one of that size."""
        start = max(self.last(PARENT), after)
        taken = self.spark.createDataFrame([(PARENT, start + 1, start + rows)], _RANGES)
        taken.coalesce(1).write.mode("append").parquet(self._folder("ranges", batch_id))
        return start
