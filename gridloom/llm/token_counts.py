"""Token totals by source, language and tokenizer version, kept up by signed changes.

A batch of changes inserts, revises or deletes documents. Tasks count the tokens of the new texts; what
a revised or deleted document counted before is taken from the ledger and entered with a minus. The
ledger holds the signed entries of each batch, and beside them their sums by source, language and
version, so that totals add up sums of batches and never read documents again. A batch is written
to a folder of its own and counts from the moment its commit is written; to apply a committed
batch again changes nothing, and one that broke off is replaced as a whole.

Nulls and edge cases: a null text has no tokens; null sources and languages are groups of their own; a
document of which several rows are inserted counts each; a delete without an earlier insert changes
nothing; a revision without one is an insert; within a batch, where changes have no order, a delete of an id beats
its revisions and these its inserts, and of several revisions the one with the greatest text counts, once; rows without an id can be inserted but not found again;
an empty batch commits nothing but itself.
"""

from __future__ import annotations

import json
import re
import string
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import WordCache, sliced, utf8
from gridloom.llm.words import stretches
from gridloom.operators.lookup import lookup_join
from gridloom.sources.paths import exists

CHANGES = "id long, source string, lang string, text string, change string"
INSERT, REVISE, DELETE = "insert", "revise", "delete"
GROUP = ["source", "lang", "version"]
#: Characters worked on together.
PART = 1 << 18
#: White space as the byte-level tokenizer knows it (fixed values: the Unicode property).
_BLANK = "\t-\r \x85\xa0  -     　"
#: What that tokenizer never joins: words with the space before them, and runs of white space.
_BLANKS = frozenset(re.sub("(.)-(.)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), _BLANK))
_PIECE = re.compile(f" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_CUT = re.compile(f"(?<=[^{_BLANK}]) (?=[^{_BLANK}])")


def default_versions() -> dict[str, str]:
    """Tokenizer files by version."""
    import public_tokenizers

    return {v: public_tokenizers.path(f"{v}.json") for v in ("byte_bpe_50k", "word_bpe_49k")}


@lru_cache(maxsize=4)
def _counts(file: str) -> WordCache:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.encode_special_tokens = True

    def count(piece) -> int:
        text = piece if isinstance(piece, str) else piece.decode("utf-8", "replace")
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    return WordCache(count, 100_000)


def _parts(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PART:
        cut = _CUT.search(text, at + PART)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


@lru_cache(maxsize=8)
def _by_bytes(file: str) -> bool:
    """Whether the tokenizer works on bytes, spaces included."""
    with open(file, encoding="utf-8") as f:
        return (json.load(f).get("pre_tokenizer") or {}).get("type") == "ByteLevel"


@lru_cache(maxsize=4)
def counter(file: str) -> Callable[[bytes], int]:
    """Number of a text's tokens; distinct words are tokenised once."""
    counts = _counts(file)
    if _by_bytes(file):

        def pieces(data: bytes) -> int:
            text = data.decode("utf-8", "replace")
            return sum(sum(map(counts.__getitem__, _PIECE.findall(p))) for p in _parts(text))

        return pieces
    return lambda data: sum(sum(map(counts.__getitem__, p.split())) for p in stretches(data))


#: ASCII punctuation but the apostrophe, which stands within words.
_MARKS = string.punctuation.replace("'", "")


#: Bits per file in a sum of counts; a text that is counted by parts has fewer tokens than that.
_BITS = 32


class _Parts(WordCache):
    """Token counts for all files, side by side in one number, of what stands between two single spaces;
    None if it cannot be told alone. ``lead`` is what stands before it. Only plain words are kept."""

    def __init__(self, files: tuple[str, ...], lead: str, most: int = 600_000):
        super().__init__(self._whole, most)
        self.files, self.lead = files, lead
        self.same: dict[int, int] = {}

    def _packed(self, counts: list[int]) -> int:
        total = sum(n << (_BITS * i) for i, n in enumerate(counts))
        return self.same.setdefault(total, total)

    def _whole(self, part: str) -> int:
        return self._packed([_counts(f).make(self.lead + part) for f in self.files])

    def __missing__(self, part: str) -> int | None:
        first = _parts_of(self.files)[0]
        left, line, right = part.partition("\n")
        if line and left and right and left[-1] not in _BLANKS and right[0] not in _BLANKS:
            found = self[left], first[right]
            return None if None in found else sum(found) + first._whole("\n")
        core = part.rstrip(_MARKS)
        if core and core != part and core.lower()[-1].isalpha():
            # Letters and the marks after them are never joined.
            found = self[core]
            return None if found is None else found + first[part[len(core) :]]
        pieces = _PIECE.findall(part)
        if not pieces or pieces[0][0] in _BLANKS or pieces[-1][-1] in _BLANKS:
            return None
        if len(pieces) > 1:
            data = (self.lead + part).encode()
            return self._packed([counter(f)(data) for f in self.files])
        return super().__missing__(part)


@lru_cache(maxsize=1)
def _parts_of(files: tuple[str, ...]) -> tuple[_Parts, _Parts]:
    return _Parts(files, "", 50_000), _Parts(files, " ")


def token_counts(data: bytes, files: tuple[str, ...]) -> tuple[int, ...]:
    """Number of a text's tokens for each file, from one split at the spaces."""
    if len(data) <= PART:
        first, others = _parts_of(files)
        head, *rest = data.decode("utf-8", "replace").split(" ")
        found = [first[head], *map(others.__getitem__, rest)]
        if None not in found:
            total = sum(found)
            return tuple((total >> (_BITS * i)) & ((1 << _BITS) - 1) for i in range(len(files)))
    return tuple(counter(f)(data) for f in files)


def counted(rows: DataFrame, versions: dict[str, str]) -> DataFrame:
    """id, source, lang, version, tokens: a row per document and tokenizer; rows have data too."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = tuple(versions.values())
        for batch in sliced(batches):
            found = [token_counts(x.as_py(), files) for x in batch.column("data")]
            for version, tokens in zip(versions, zip(*found, strict=True), strict=False):
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in ("id", "source", "lang")],
                        pa.array([version] * len(tokens), pa.string()),
                        pa.array(tokens, pa.int64()),
                    ],
                    names=["id", *GROUP, "tokens"],
                )

    schema = "id long, source string, lang string, version string, tokens long"
    return rows.select("id", "source", "lang", "data").mapInArrow(count, schema)


def one_state(changes: DataFrame) -> DataFrame:
    """The new rows of a batch: of an id's changes a delete beats revisions, and these beat inserts; of
    several revisions the one with the greatest text stays."""
    rows = changes.select("id", "source", "lang", utf8(F.col("text")).alias("data"), "change")
    of = {c: F.count(F.when(F.col("change") == c, 1)).alias(c) for c in (INSERT, REVISE, DELETE)}
    several = changes.where("id IS NOT NULL").groupBy("id").agg(*of.values())
    several = several.where(f"{DELETE} > 0 OR {REVISE} > 1 OR {REVISE} > 0 AND {INSERT} > 0")
    rows = rows.where(F.col("change").isin(INSERT, REVISE))
    # Reads ids and kinds of change only.
    clash = several.where(f"{INSERT} + {REVISE} > 0")
    if not clash.head(1):
        return rows.drop("change")
    rows = lookup_join(rows, clash, ["id"], ["data"])
    kept = rows.where(F.expr(f"coalesce({DELETE}, 0) = 0 AND (change = '{REVISE}' OR coalesce({REVISE}, 0) = 0)"))
    single = kept.where(F.expr(f"change = '{INSERT}' OR coalesce({REVISE}, 1) = 1"))
    latest = kept.where(F.expr(f"change = '{REVISE}' AND {REVISE} > 1")).groupBy("id")
    latest = latest.agg(F.max(F.struct("data", "source", "lang")).alias("r")).select("id", "r.source", "r.lang", "r.data")
    return single.select("id", "source", "lang", "data").unionByName(latest)


class TokenLedger:
    """Signed token counts below a folder that all executors reach; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, versions: dict[str, str] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.versions = versions or default_versions()

    def _read(self, name: str, schema: str) -> DataFrame:
        if not exists(self.spark, f"{self.root}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def commits(self) -> DataFrame:
        """batch: those that count."""
        return self._read("commits", "done boolean, batch string").select("batch")

    def _committed(self, name: str, schema: str) -> DataFrame:
        rows = self._read(name, f"{schema}, batch string")
        # One short row per batch.
        return rows.join(F.broadcast(self.commits()), "batch", "left_semi").drop("batch")

    def entries(self) -> DataFrame:
        """id, source, lang, version, tokens, sign of all committed batches."""
        schema = "id long, source string, lang string, version string, tokens long, sign int"
        return self._committed("entries", schema)

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Enter the changes (see ``CHANGES``); False if the batch has been committed before."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        if self.commits().where(F.col("batch") == batch).head(1):
            return False
        plus = counted(one_state(changes), self.versions).withColumn("sign", F.lit(1))
        gone = changes.where(F.col("change").isin(DELETE, REVISE)).select("id").distinct()
        # A document's entries so far, summed: what has come and not gone.
        before = lookup_join(self.entries(), gone, ["id"], ["id", "version"], "left_semi")
        before = before.groupBy("id", *GROUP, "tokens").agg(F.sum("sign").alias("n")).where("n > 0")
        minus = before.select(
            "id", *GROUP, "tokens", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")
        ).select("id", *GROUP, "tokens", F.lit(-1).alias("sign"))
        entries = f"{self.root}/entries/batch={batch}"
        plus.unionByName(minus).write.mode("overwrite").parquet(entries)
        signed = self.spark.read.parquet(entries)
        sums = signed.groupBy(*GROUP).agg(
            F.sum("sign").cast("long").alias("documents"),
            F.sum(F.col("sign") * F.col("tokens")).alias("tokens"),
        )
        sums.write.mode("overwrite").parquet(f"{self.root}/sums/batch={batch}")
        done = self.spark.range(1).select(F.lit(True).alias("done"))
        done.write.mode("overwrite").parquet(f"{self.root}/commits/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, documents, tokens."""
        schema = "source string, lang string, version string, documents long, tokens long"
        sums = self._committed("sums", schema).groupBy(*GROUP)
        totals = sums.agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return totals.where("documents > 0")
