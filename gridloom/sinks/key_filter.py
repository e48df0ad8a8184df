"""Which stored folders may hold a key: a Bloom filter per batch and id bucket, as a plain table.

A filter is kept as its 64-bit words, one row per word that has a bit set: ``(id_bucket, size, word, bits)``.
A key sets ``HASHES`` bits. The number of bits follows the number of keys (a power of two, 16 or more per
key, so that about one new key in 200 is taken for a known one), and the words of equally large filters of
one bucket can be merged by OR. Looking up goes in two steps: keys meet the merged words first, and only those
that pass meet the words of each batch. A key that is stored always passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 3
BITS_PER_KEY, LEAST_BITS = 16, 1024
WORDS = "id_bucket bigint, size bigint, word bigint, bits bigint"
_FILTER = ["id_bucket", "size"]


def _size(keys: Column) -> Column:
    """Bits of a filter for so many keys."""
    least = F.greatest(keys * BITS_PER_KEY, F.lit(LEAST_BITS))
    return F.pow(F.lit(2.0), F.ceil(F.log2(least.cast("double")))).cast("long")


def _spots(keyed: DataFrame, key: list[str]) -> DataFrame:
    """``word`` and ``bit`` of each hash of each key; rows have ``size``."""
    spot = [F.pmod(F.xxhash64(*key, F.lit(i)), F.col("size")) for i in range(HASHES)]
    spots = keyed.withColumn("spot", F.explode(F.array(*spot)))
    return spots.withColumn("word", F.floor(F.col("spot") / 64)).withColumn("bit", (F.col("spot") % 64).cast("int"))


def words_of(rows: DataFrame, key: list[str]) -> DataFrame:
    """The filters' words over rows with ``id_bucket`` and the key; null keys are in none."""
    keyed = rows.select("id_bucket", *key).dropna(subset=key)
    sizes = keyed.groupBy("id_bucket").agg(_size(F.count("*")).alias("size"))
    # One row per bucket of a batch, as many as the folders it writes.
    spots = _spots(keyed.join(F.broadcast(sizes), "id_bucket"), key)
    return spots.groupBy(*_FILTER, "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))


def _passing(spots: DataFrame, words: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """Keys all of whose bits are set, with the columns ``by`` of the words."""
    hit = spots.join(words, [*_FILTER, "word"]).where(F.expr("getbit(bits, bit)") == 1)
    groups = hit.groupBy(*key, *_FILTER, *by).agg(F.countDistinct("spot").alias("n"))
    wanted = [F.pmod(F.xxhash64(*key, F.lit(i)), F.col("size")) for i in range(HASHES)]
    # Two hashes of a key may fall on one bit.
    return groups.where(F.col("n") == F.size(F.array_distinct(F.array(*wanted)))).drop("n")


def may_hold(keys: DataFrame, words: DataFrame, key: list[str]) -> DataFrame:
    """``(batch_id, id_bucket)`` whose filter has one of the keys; ``words`` have ``batch_id``."""
    keys = keys.select("id_bucket", *key).dropna(subset=key).distinct()
    merged = words.groupBy(*_FILTER, "word").agg(F.expr("bit_or(bits)").alias("bits"))
    sizes = words.select(*_FILTER).distinct()
    likely = _passing(_spots(keys.join(sizes, "id_bucket"), key), merged, key, [])
    held = _passing(_spots(likely, key), words, key, ["batch_id"])
    return held.select("batch_id", "id_bucket").distinct()
