"""Documents into sequences of a fixed number of tokens, in as few sequences as possible.

Tasks tokenise whole texts and cut documents that are too long; what they return is one short row
per piece. The plan is made from the histogram of piece lengths (see ``packing_plan``); each piece
then finds its place from its length and its number among the pieces of that length, by a join with
the plan, whose size depends on the capacity only.

The tokenizer drops white space and never joins what white space separates, so a text's ids are
those of its words one after the other: each distinct word is tokenised once per task, and a text of
any length is worked through in pieces of about a megabyte.

Nulls and edge cases: a null or empty text is the end token alone; null ids come first; rows that
repeat an id and a text are packed each for itself; an empty table gives an empty result. Only the
named columns are read, so others may have any name.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import WordCache, cut_lineage, kept, numbered_in_order, sliced, utf8
from gridloom.llm.packing_plan import packing_plan
from gridloom.llm.words import stretches

CAPACITY = 2048
#: Words whose ids a task keeps, and as many older ones: about 200 bytes each.
WORDS_KEPT = 600_000
END = (0).to_bytes(4, "little")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def id_words(tokenizer_file: str, most: int = WORDS_KEPT) -> WordCache:
    """Ids of a word, as little-endian 32-bit numbers.

    The tokenizer ignores case and never joins a letter with punctuation, so a word in capitals or
    with a comma is looked up by its parts. Words that may hold a special token are left whole. A
    tokenizer that is not of this kind is refused.
    """
    from tokenizers import Tokenizer

    with open(tokenizer_file, encoding="utf-8") as f:
        kind = json.load(f)
    kinds = [kind.get("normalizer") or {}, kind.get("pre_tokenizer") or {}]
    steps = [s.get("type") for k in kinds for s in (k.get("normalizers") or k.get("pretokenizers") or [k])]
    if "Lowercase" not in steps or "Split" not in steps:
        raise ValueError(f"{tokenizer_file} does not fold case and split at white space")

    tokenizer = Tokenizer.from_file(tokenizer_file)

    def ids(word: bytes) -> bytes:
        if b"<|" not in word:
            small = word.lower()
            if small != word:
                return words[small]
            core = word.rstrip(b".,!?;:")
            # Lower case may end in a mark, which the tokenizer joins with the punctuation.
            if core and core != word and core.decode("utf-8", "replace").lower()[-1].isalpha():
                return words[core] + words[word[len(core) :]]
        found = tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in found])

    words = WordCache(ids, most)
    return words


def pieces_of(data: bytes, ids, capacity: int) -> Iterator[bytes]:
    """The document's tokens and the end token, cut into pieces of ``capacity`` ids."""
    most, held = 4 * capacity, b""
    for part in stretches(data):
        held += b"".join(map(ids.__getitem__, part.split()))
        if len(held) > most:
            # The end token is still to come, so the last piece is never empty.
            full = (len(held) - 1) // most
            for i in range(full):
                yield held[i * most : (i + 1) * most]
            held = held[full * most :]
    held += END
    for at in range(0, len(held), most):
        yield held[at : at + most]


def token_pieces(
    df: DataFrame,
    tokenizer_file: str,
    capacity: int,
    id_col: str,
    text_col: str,
    words_kept: int = WORDS_KEPT,
) -> DataFrame:
    """id, piece, start, length and ids_crc32 of every piece."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), utf8(F.col(f"`{text_col}`")).alias("data"))
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # From task to task the worker keeps what it has tokenised.
        ids = kept(("ids", tokenizer_file, words_kept), lambda: id_words(tokenizer_file, words_kept))
        for batch in sliced(batches):
            index, piece, start, length, crc = [], [], [], [], []
            for i, data in enumerate(batch.column("data")):
                at = 0
                for k, part in enumerate(pieces_of(data.as_py(), ids, capacity)):
                    n = len(part) // 4
                    index.append(i), piece.append(k), start.append(at)
                    length.append(n), crc.append(zlib.crc32(part))
                    at += n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(index, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(cut, schema)


def plan_rows(plan: list, spark) -> DataFrame:
    """For each length, which numbers go to which sequences and places."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for content, times in plan:
        offset = 0
        for length, each in content:
            first = used.get(length, 0)
            used[length] = first + each * times
            rows.append((length, first, used[length], each, sequence, offset))
            offset += length * each
        sequence += times
    fields = "length long, low long, high long, each long, sequence long, at long"
    return spark.createDataFrame(rows, fields)


def pack_documents(
    df: DataFrame,
    tokenizer_file: str | None = None,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_kept: int = WORDS_KEPT,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = df.sparkSession
    file = tokenizer_file or default_tokenizer()
    pieces = token_pieces(df, file, capacity, id_col, text_col, words_kept)
    pieces = cut_lineage(pieces, "pieces")
    # At most ``capacity`` rows.
    counted = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    plan = plan_rows(packing_plan(counted, capacity), spark)
    order = ["length", "id", "piece", "ids_crc32"]
    numbered = numbered_in_order(pieces, order, ["length"], "number", "pieces")
    place = (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    # The plan has some rows for each of at most ``capacity`` lengths.
    placed = numbered.join(F.broadcast(plan), "length").where(place)
    nth = F.col("number") - F.col("low")
    return placed.select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"),
    )
