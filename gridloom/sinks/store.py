"""The dimension, the facts and the mapping log as parquet tables.

Facts lie under ``facts/batch_id=<b>/id_bucket=<k>``. A batch overwrites only its own folder, and its
rows of the dimension, so a repeated batch replaces itself. Between ``begin`` and ``finish`` a batch is
hidden from readers in all three tables; one that broke off stays hidden until it is run again.

Beside the facts and the log of a batch lie what later batches and reports need of them: the counts behind
the indicators, a filter of the keys, and the ranges of ids it took (see ``ledger``, ``key_filter``). They are
written last and removed before the batch is replaced; a batch without them is read itself instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.dates import utc_text
from gridloom.functions.text import normalize
from gridloom.model import DIMENSION, FACT, MAPPING_LOG
from gridloom.operators.integrity import KEY, require_columns
from gridloom.operators.kpi import FACT_COUNTS, METHOD_COUNTS, fact_counts, method_counts, summed
from gridloom.operators.ordered import number_any
from gridloom.session import PACKED, cut_lineage
from gridloom.sinks.key_filter import WORDS, may_hold, words_of
from gridloom.sinks.ledger import FACT_ROW, PARENT, Ledger
from gridloom.sinks.snapshots import SnapshotTable
from gridloom.sources.paths import child_names, exists, make_dir, remove

IDS_PER_BUCKET = 1000
#: Folders that are named one by one in a filter; more are named by batch and by bucket.
NAMED_FOLDERS = 200
_BATCH = T.StructField("batch_id", T.StringType())


def with_schema(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns in order; an absent one is null."""
    schema = {**dict(zip(FACT.names, FACT)), **dict(zip(DIMENSION.names, DIMENSION))}
    absent = {n: F.lit(None) for n in names if n not in df.columns}
    return df.withColumns(absent).select(*[F.col(n).cast(schema[n].dataType) for n in names])


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def id_bucket(chrono_id: Column) -> Column:
    return F.floor(chrono_id / IDS_PER_BUCKET)


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        rows = T.StructType([*DIMENSION.fields, _BATCH])
        self.dimension_table = SnapshotTable(spark, f"{self.base}/dimension", rows)
        self.open_table = SnapshotTable(spark, f"{self.base}/open_batches", T.StructType([_BATCH]))
        self.ledger = Ledger(spark, self.base)

    def create(self) -> None:
        """Make both tables and the log available; existing ones stay as they are."""
        for name in ("dimension", "facts", "mapping_log"):
            make_dir(self.spark, f"{self.base}/{name}")

    def begin(self, batch_id: str) -> None:
        """Hide the batch until it is finished."""
        self._set_open({*self.open_batches(), batch_id})

    def finish(self, batch_id: str) -> None:
        """Show the batch: facts, log and dimension at once."""
        self._set_open({*self.open_batches()} - {batch_id})

    def open_batches(self) -> list[str]:
        # The batch under way and those that broke off: a handful of names.
        return [r.batch_id for r in self.open_table.read().collect()]

    def _set_open(self, names: set[str]) -> None:
        rows = [(name,) for name in sorted(names)]
        self.open_table.write(self.spark.createDataFrame(rows, self.open_table.schema))

    def _finished(self, rows: DataFrame) -> DataFrame:
        names = self.open_batches()
        batch = F.col("batch_id")
        return rows.where(batch.isNull() | ~batch.isin(names)) if names else rows

    def dimension(self) -> DataFrame:
        return self._finished(self.dimension_table.read()).select(*DIMENSION.names)

    def facts(self, chrono_id: int | None = None) -> DataFrame:
        """All facts, or those of one chronogram: the bucket prunes folders, the id is pushed down."""
        schema = f"{_columns(FACT)}, batch_id string, id_bucket bigint"
        rows = self._finished(self.spark.read.schema(schema).parquet(f"{self.base}/facts"))
        if chrono_id is not None:
            bucket = chrono_id // IDS_PER_BUCKET
            rows = rows.where(
                (F.col("id_bucket") == bucket) & (F.col("id_chronogramme") == chrono_id)
            )
        return rows

    def mapping_log(self) -> DataFrame:
        schema = f"{_columns(MAPPING_LOG)}, batch_id string"
        return self._finished(self.spark.read.schema(schema).parquet(f"{self.base}/mapping_log"))

    def _batches(self, name: str) -> set[str]:
        """Batches with a folder in one of the tables: names from the listing, no file is read."""
        found = child_names(self.spark, f"{self.base}/{name}")
        return {n.removeprefix("batch_id=") for n in found if n.startswith("batch_id=")}

    def _without(self, name: str, of: str) -> list[str]:
        """Batches of the table ``of`` whose summary ``name`` is not there or not whole."""
        path = f"{self.base}/{name}"
        whole = {b for b in self._batches(name) if exists(self.spark, f"{path}/batch_id={b}/_SUCCESS")}
        return sorted(self._batches(of) - whole)

    def _summary(self, name: str, schema: str, but: list[str]) -> DataFrame:
        """Summary rows of all finished batches without those of ``but``."""
        path = f"{self.base}/{name}"
        if not self._batches(name):
            return self.spark.createDataFrame([], f"{schema}, batch_id string")
        rows = self._finished(self.spark.read.schema(f"{schema}, batch_id string").parquet(path))
        return rows.where(~F.col("batch_id").isin(but)) if but else rows

    def _counts(self, name: str, of: str, columns: list[str], rows: DataFrame, count) -> DataFrame:
        schema = "id_chronogramme long, " + ", ".join(f"{c} long" for c in columns)
        absent = self._without(name, of)
        counts = self._summary(name, schema, absent).select("id_chronogramme", *columns)
        if absent:
            counts = counts.unionByName(count(rows.where(F.col("batch_id").isin(absent))))
        return summed(counts, columns)

    def fact_counts(self) -> DataFrame:
        """Rows and filled cells per chronogram, added up over the batches."""
        return self._counts("fact_counts", "facts", FACT_COUNTS, self.facts(), fact_counts)

    def method_counts(self) -> DataFrame:
        """Log entries by method per chronogram, added up over the batches."""
        return self._counts("method_counts", "mapping_log", METHOD_COUNTS, self.mapping_log(), method_counts)

    def facts_like(self, rows: DataFrame, but: str | None = None) -> DataFrame:
        """The facts of all folders that may hold a key of ``rows``, without the batch ``but``.

        Only folders whose key filter passes a key are read; each stored key is among them.
        """
        absent = [b for b in self._without("key_filter", "facts") if b != but]
        words = _others(self._summary("key_filter", WORDS, absent), but)
        keys = rows.select(id_bucket(F.col(KEY[0])).alias("id_bucket"), *KEY)
        # At most as many rows as folders, which Spark lists on the driver as well.
        found = [(r.batch_id, r.id_bucket) for r in may_hold(keys, words, KEY).collect()]
        batch, bucket = F.col("batch_id"), F.col("id_bucket")
        likely = F.lit(False)
        if len(found) <= NAMED_FOLDERS:
            for name in sorted({b for b, _ in found}):
                likely = likely | ((batch == name) & bucket.isin([k for b, k in found if b == name]))
        else:
            likely = batch.isin(sorted({b for b, _ in found})) & bucket.isin(sorted({k for _, k in found}))
        if absent:
            likely = likely | batch.isin(absent)
        return self.facts().where(likely)

    def max_id(self, but: str | None = None) -> int:
        """The largest stored id, without the rows of the batch ``but``, which is to be replaced."""
        return _largest(_others(self.dimension_table.read(), but), "id_chronogramme")

    def last_id(self, but: str | None = None) -> int:
        """The largest id that is stored or was given to a batch that broke off."""
        return max(self.max_id(but), self.ledger.last(PARENT))

    def append_dimension(self, rows: DataFrame, batch_id: str | None = None) -> int:
        """New rows join the current ones in the next version; a known id is replaced, and so are the
        earlier rows of the batch."""
        require_columns(rows, ["id_chronogramme", "nom_chronogramme"])
        new = with_schema(rows, DIMENSION.names)
        others = _others(self.dimension_table.read(), batch_id)
        kept = others.join(new.select("id_chronogramme"), "id_chronogramme", "left_anti")
        named = new.withColumn("batch_id", F.lit(batch_id).cast("string"))
        return self.dimension_table.write(kept.unionByName(named))

    def append_facts(self, rows: DataFrame, batch_id: str) -> None:
        """Append checked rows by name; global ids go on after the largest one taken.

        The ledger of ranges gives the first id, and a repeated batch its own again, so no other batch is
        read. Rows are ranged by parent and inject id: a task writes to few folders, a hot parent is
        split, and the files' value ranges serve pushed-down filters.
        """
        require_columns(rows, ["id_chronogramme"])
        names = [n for n in FACT.names if n != "id_inject_global"]
        # Written once: their count, their numbers and the append read them.
        typed = cut_lineage(with_schema(rows, names), "facts")
        for name in ("fact_counts", "key_filter"):
            remove(self.spark, f"{self.base}/{name}/batch_id={batch_id}")
        start = self.ledger.take(FACT_ROW, batch_id, typed.count(), self._unlisted_id(batch_id))
        numbered = number_any(typed, names, "id_inject_global")
        path = f"{self.base}/facts/batch_id={batch_id}"
        (
            numbered.withColumn("id_inject_global", F.col("id_inject_global") + F.lit(start))
            .withColumn("id_bucket", id_bucket(F.col("id_chronogramme")))
            .repartitionByRange("id_bucket", "id_chronogramme", "id_inject", "id_inject_global")
            .write.mode("overwrite")
            .option("compression", PACKED)
            .partitionBy("id_bucket")
            .parquet(path)
        )
        own = self.spark.read.schema(f"{_columns(FACT)}, id_bucket bigint").parquet(path)
        for name, summary in (("fact_counts", fact_counts(own)), ("key_filter", words_of(own, KEY))):
            summary.write.mode("overwrite").parquet(f"{self.base}/{name}/batch_id={batch_id}")

    def _unlisted_id(self, batch_id: str) -> int:
        """The largest id of batches that were stored without a range, which alone are read."""
        unlisted = self._batches("facts") - self.ledger.batches(FACT_ROW) - {batch_id}
        if not unlisted:
            return 0
        return _largest(self.facts().where(F.col("batch_id").isin(sorted(unlisted))), "id_inject_global")

    def update_counts(self) -> int:
        """Set ``nb_injects`` to the number of stored facts, as a new version of the dimension."""
        counts = self.fact_counts().select("id_chronogramme", F.col("n_rows").alias("nb_new"))
        return self.dimension_table.write(with_counts(self.dimension_table.read(), counts))

    def append_log(self, rows: DataFrame, batch_id: str, at: Column | None = None) -> None:
        """Decisions with their id; texts both as they were and normalized."""
        counts = f"{self.base}/method_counts/batch_id={batch_id}"
        remove(self.spark, counts)
        path = f"{self.base}/mapping_log/batch_id={batch_id}"
        log_rows(rows, at).write.mode("overwrite").option("compression", PACKED).parquet(path)
        own = self.spark.read.schema(_columns(MAPPING_LOG)).parquet(path)
        method_counts(own).write.mode("overwrite").parquet(counts)


def _others(rows: DataFrame, batch_id: str | None) -> DataFrame:
    return rows if batch_id is None else rows.where(~F.col("batch_id").eqNullSafe(batch_id))


def _largest(rows: DataFrame, column: str) -> int:
    return rows.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]


def with_counts(dimension: DataFrame, counts: DataFrame) -> DataFrame:
    return (
        dimension.join(counts, "id_chronogramme", "left")
        .withColumn("nb_injects", F.coalesce("nb_new", F.lit(0)).cast("long"))
        .select(*dimension.columns)
    )


def log_rows(rows: DataFrame, at: Column | None = None) -> DataFrame:
    """``(id_chronogramme, scope, nom_original, champ_standard, methode)`` to full log rows."""
    moment = F.current_timestamp() if at is None else at
    stamp = utc_text(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select(
        "id_chronogramme",
        "scope",
        "nom_original",
        "champ_standard",
        normalize(F.col("nom_original")).alias("original_norm"),
        normalize(F.col("champ_standard")).alias("standard_norm"),
        "methode",
        stamp.alias("horodatage"),
    )
