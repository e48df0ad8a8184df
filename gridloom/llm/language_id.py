"""Language identification by character language models.

For each language an interpolated Kneser-Ney model over the characters of words is trained on all
labelled rows that training may use: tasks count words, Spark adds the counts up, and n-grams are
counted from the distinct words. The models lie in sorted hash arrays, one per order, with a column
per language. A text has the language whose model needs the fewest bits per character. How sure
this is, is calibrated on the training rows: the score is the posterior of the language under a
temperature, times how usual the bits per character are for that language.

Nulls and edge cases: a null text, or one without letters, is ``und`` with score 0, as is every text
if no row has a label; rows without label or id do not train; a row without id is never held out;
languages with the same bits are told apart by name; an empty table gives an empty result. Only the
named columns are read, and text alone decides about a prediction.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import cut_lineage, kept, nothing_kept, sliced, utf8
from gridloom.llm.words import NOT_LETTERS, STRETCH, hashed_words, mixed, stretches

#: Characters of an n-gram.
ORDER = 4
UNKNOWN = "und"
#: N-grams of all languages and orders that a model may hold (about 60 bytes each); beyond it, take
#: a smaller ``order``. It is checked, never cut to.
MOST_GRAMS = 4_000_000
#: A text is rejected when its bits per character lie further above the mean, in standard
#: deviations, than those of all but ``UNUSUAL`` of the training rows, and by ``MARGIN`` more.
UNUSUAL = 1e-4
MARGIN = 4.0
#: Words that a task counts before it hands the counts on.
COUNTED = 100_000
_LETTERS = re.compile(r"[^\W\d_]+")
_START, _END = "\x02", "\x03"


def letter_words(chunk: bytes) -> list[str]:
    """Runs of letters; the text is in small ones."""
    return _LETTERS.findall(chunk.decode("utf-8", "replace").lower())


def is_held_out(ident: Column) -> Column:
    """Whether the id's remainder keeps the row out of training."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # The worker may come from another operator, whose tables it still holds.
    nothing_kept()
    chunks: dict[str, Counter] = {}

    def out() -> pa.RecordBatch:
        words: dict[str, Counter] = {}
        for lang, found in chunks.items():
            own = words.setdefault(lang, Counter())
            for chunk, n in found.items():
                for word in letter_words(chunk):
                    own[word] += n
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang for lang, c in words.items() for _ in c], pa.string()),
                pa.array([w for c in words.values() for w in c], pa.string()),
                pa.array([n for c in words.values() for n in c.values()], pa.int64()),
            ],
            names=["lang", "word", "n"],
        )

    for batch in batches:
        for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data"), strict=True):
            found = chunks.setdefault(lang, Counter())
            for part in stretches(data.as_py()):
                found.update(part.split())
            if sum(map(len, chunks.values())) > COUNTED:
                yield out()
                chunks = {}
    yield out()


def word_counts(rows: DataFrame) -> DataFrame:
    """lang, word and n over all texts; rows have lang and data."""
    counted = rows.mapInArrow(_count_words, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, order: int) -> DataFrame:
    """lang, gram and n: the n-grams of the highest order, with a start before and an end after
    each word."""
    padded = F.concat(F.lit(_START * (order - 1)), "word", F.lit(_END))
    places = F.sequence(F.lit(1), F.length("word") + 1)
    grams = F.transform(places, lambda i: F.substring(padded, i, F.lit(order)))
    each = words.select("lang", "n", F.explode(grams).alias("gram"))
    return each.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def gram_hashes(grams: list[str]) -> np.ndarray:
    """Hashes of strings of one length."""
    if not grams:
        return np.zeros(0, np.uint64)
    points = np.array([list(map(ord, g)) for g in grams], dtype=np.uint64)
    return point_hashes(points)


def point_hashes(points: np.ndarray) -> np.ndarray:
    """Hashes of rows of code points; a row's hash grows from its end to its start."""
    out = np.full(len(points), points.shape[1], np.uint64)
    for k in range(points.shape[1] - 1, -1, -1):
        out = mixed(out * np.uint64(31) + points[:, k])
    return out


class Models:
    """Interpolated Kneser-Ney models of several languages in sorted hash arrays."""

    def __init__(self, languages: list[str], counts: list[tuple[str, str, int]], order: int):
        self.languages, self.order = languages, order
        number = {lang: i for i, lang in enumerate(languages)}
        levels: list[dict[str, np.ndarray]] = [{} for _ in range(order + 1)]
        for lang, gram, n in counts:
            levels[order].setdefault(gram, np.zeros(len(languages)))[number[lang]] += n
        # Below the highest order a gram counts once for each character seen before it.
        for k in range(order, 1, -1):
            for gram, row in levels[k].items():
                low = levels[k - 1].setdefault(gram[1:], np.zeros(len(languages)))
                low += row > 0
        self.hashes: list[np.ndarray] = []
        self.logs: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.backoffs: list[np.ndarray] = []
        below: dict[str, np.ndarray] = {}
        for k in range(1, order + 1):
            below = self._level(levels[k], k, below)

    def _level(self, rows: dict, k: int, below: dict) -> dict[str, np.ndarray]:
        table = np.array(list(rows.values())).reshape(len(rows), len(self.languages))
        once, twice = (table == 1).sum(0), (table == 2).sum(0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
        total: dict[str, np.ndarray] = {}
        kinds: dict[str, np.ndarray] = {}
        for gram, row in rows.items():
            head = gram[:-1]
            if head not in total:
                total[head], kinds[head] = np.zeros(len(row)), np.zeros(len(row))
            total[head] += row
            kinds[head] += row > 0
        # A context that a language has never seen leaves all to the order below.
        backoff = {
            h: np.where(t > 0, discount * kinds[h] / np.maximum(t, 1), 1.0) for h, t in total.items()
        }
        if k == 1:
            # All characters that any language knows, and one more for unknown ones, alike.
            self.floor = 1.0 / (len(rows) + 1)
        found = {}
        for gram, row in rows.items():
            head = gram[:-1]
            own = np.maximum(row - discount, 0) / np.maximum(total[head], 1)
            found[gram] = own + backoff[head] * (below[gram[1:]] if k > 1 else self.floor)
        for store, logs, values in (
            (self.hashes, self.logs, found),
            (self.contexts, self.backoffs, backoff),
        ):
            keys = gram_hashes(list(values)) if k > 1 or store is self.hashes else np.zeros(1, np.uint64)
            place = np.argsort(keys)
            store.append(keys[place])
            logs.append(np.log2(np.array(list(values.values()))[place]) if values else np.zeros((0, len(self.languages))))
        return found

    @staticmethod
    def _find(keys: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(sought), np.int64), np.zeros(len(sought), dtype=bool)
        at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
        return at, keys[at] == sought

    def logs_of(self, points: np.ndarray) -> np.ndarray:
        """Log2 probability, by language, of the last code point of each row after the others."""
        out = np.zeros((len(points), len(self.languages)))
        left = np.arange(len(points))
        for k in range(self.order, 0, -1):
            grams = points[left, self.order - k :]
            at, known = self._find(self.hashes[k - 1], point_hashes(grams))
            out[left[known]] += self.logs[k - 1][at[known]]
            left, grams = left[~known], grams[~known]
            if not len(left):
                return out
            if k > 1:
                at, known = self._find(self.contexts[k - 1], point_hashes(grams[:, :-1]))
                out[left[known]] += self.backoffs[k - 1][at[known]]
            elif len(self.backoffs[0]):
                out[left] += self.backoffs[0][0] + np.log2(self.floor)
        return out

    def words_bits(self, words: list[str]) -> np.ndarray:
        """Bits of each word by language, and its number of characters with the end, last."""
        start = _START * (self.order - 1)
        laid = "".join([f"{start}{w}{_END}" for w in words])
        points = np.frombuffer(laid.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(w) + 1 for w in words])
        ends = np.cumsum(lengths) - lengths
        begins = np.cumsum(lengths + self.order - 1) - (lengths + self.order - 1)
        places = np.repeat(begins - ends, lengths) + np.arange(lengths.sum())
        windows = np.lib.stride_tricks.sliding_window_view(points, self.order)[places]
        return np.column_stack([np.add.reduceat(-self.logs_of(windows), ends, axis=0), lengths])


class Scorer:
    """Bits of texts, from the bits of their words; distinct words are scored once.

    New words go to a small sorted table, which is merged into the large one when it is full. Once the
    large one is full as well, the small one starts over, so what a stretch of text costs does not
    depend on how many words were seen before it.
    """

    def __init__(self, models: Models, most: int = 500_000, fresh: int = 1 << 15):
        self.models, self.most, self.fresh = models, most, fresh
        self.width = len(models.languages) + 1
        self.large, self.small = self._none(), self._none()

    def _none(self) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(0, np.uint64), np.zeros((0, self.width), np.float32)

    @staticmethod
    def _merged(one: tuple, other: tuple) -> tuple[np.ndarray, np.ndarray]:
        known = np.concatenate([one[0], other[0]])
        order = np.argsort(known, kind="stable")
        return known[order], np.concatenate([one[1], other[1]])[order]

    def _made(self, data: bytes, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bits and characters of words that no table holds."""
        words = [letter_words(data[a:e]) for a, e in zip(first.tolist(), end.tolist(), strict=True)]
        sizes = np.array([len(w) for w in words])
        made = np.zeros((len(words), self.width))
        if sizes.any():
            bits = self.models.words_bits([w for ws in words for w in ws])
            some = np.flatnonzero(sizes)
            made[some] = np.add.reduceat(bits, (np.cumsum(sizes) - sizes)[some], axis=0)
        return made.astype(np.float32)

    def _remember(self, words: np.ndarray, made: np.ndarray) -> None:
        self.small = self._merged(self.small, (words, made))
        if len(self.small[0]) > self.fresh:
            if len(self.large[0]) + len(self.small[0]) <= self.most:
                self.large = self._merged(self.large, self.small)
            self.small = self._none()

    def _rows(self, data: bytes, hashes: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bits and characters of each of the words."""
        words, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        rows = np.empty((len(words), self.width), np.float32)
        left = np.arange(len(words))
        for known, table in (self.large, self.small):
            place, held = Models._find(known, words[left])
            rows[left[held]] = table[place[held]]
            left = left[~held]
        if len(left):
            rows[left] = self._made(data, first[at[left]], end[at[left]])
            self._remember(words[left], rows[left])
        return rows[back]

    def texts_bits(self, texts: list[bytes]) -> np.ndarray:
        """Bits by language and the number of characters, of each whole text."""
        total = np.zeros((len(texts), self.width))
        held: list[int] = []

        def add(numbers: list[int], data: bytes, starts: list[int]) -> None:
            hashes, first, end = hashed_words(data, NOT_LETTERS)
            if len(hashes):
                rows = self._rows(data, hashes, first, end).astype(np.float64)
                text = np.searchsorted(starts, first, side="right") - 1
                begin = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                sums = np.add.reduceat(rows, begin, axis=0)
                total[np.array(numbers)[text[begin]]] += sums

        def together() -> None:
            if held:
                own = [texts[i] for i in held]
                starts = np.cumsum([0] + [len(t) + 1 for t in own])[:-1]
                add(held, b"\n".join(own), starts)
                held.clear()

        size = 0
        for i, text in enumerate(texts):
            if len(text) > STRETCH:
                for part in stretches(text):
                    add([i], part, [0])
                continue
            if size + len(text) > STRETCH:
                together()
                size = 0
            held.append(i)
            size += len(text) + 1
        together()
        return total


def text_bits(rows: DataFrame, models: Models, carry: list[str]) -> DataFrame:
    """``carry``, and bits (by language) and chars of each text."""
    shared, stamp = rows.sparkSession.sparkContext.broadcast(models), uuid.uuid4().hex
    fields = [rows.schema[c] for c in carry]
    schema = T.StructType(
        [*fields, T.StructField("bits", T.ArrayType(T.DoubleType())), T.StructField("chars", T.DoubleType())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(("bits", stamp), lambda: Scorer(shared.value))
        for batch in sliced(batches):
            found = scorer.texts_bits(batch.column("data").to_pylist())
            size = found.shape[1] - 1
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * np.int32(size)
            bits = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[:, :-1].ravel()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], bits, pa.array(found[:, -1])],
                names=[*carry, "bits", "chars"],
            )

    return rows.select(*carry, "data").mapInArrow(score, schema)


def train(rows: DataFrame, order: int = ORDER, most_grams: int = MOST_GRAMS) -> Models:
    """Models of the languages of ``rows`` (lang, data)."""
    grams = cut_lineage(gram_counts(word_counts(rows), order), "grams")
    if (size := grams.count()) > most_grams:
        raise ValueError(f"{size} n-grams; at most {most_grams}: take a smaller order")
    # At most ``most_grams`` rows; they grow with the number of different n-grams, not of texts.
    found = grams.orderBy("lang", "gram").toPandas()
    languages = sorted(found["lang"].unique().tolist())
    counts = list(zip(found["lang"], found["gram"], found["n"].tolist(), strict=True))
    return Models(languages, counts, order)


def identify(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    unusual: float = UNUSUAL,
    margin: float = MARGIN,
) -> DataFrame:
    """One row per row of ``df``: id, held_out, lang_pred, score, accepted, bits_per_char."""
    docs = df.select(
        F.col(f"`{id_col}`").alias("id"),
        utf8(F.lower(f"`{text_col}`")).alias("data"),
        F.col(f"`{lang_col}`").alias("lang"),
        is_held_out(F.col(f"`{id_col}`")).alias("held_out"),
    )
    may_train = ~F.col("held_out") & F.col("id").isNotNull() & F.col("lang").isNotNull()
    models = train(docs.where(may_train).select("lang", "data"), order)
    languages = models.languages
    if not languages:
        none = docs.select("id", "held_out", F.lit(UNKNOWN).alias("lang_pred"))
        return none.select(
            F.col("id").alias(id_col),
            "held_out",
            "lang_pred",
            F.lit(0.0).alias("score"),
            F.lit(False).alias("accepted"),
            F.lit(None).cast("double").alias("bits_per_char"),
        )
    docs = docs.withColumn("trains", may_train)
    scored = cut_lineage(text_bits(docs, models, ["id", "held_out", "trains"]), "bits")
    # array_position finds the first of the languages, which are in order of their names.
    best = F.array_position("bits", F.array_min("bits"))
    scored = scored.withColumn("best", best.cast("int")).withColumn(
        "per_char", F.try_divide(F.array_min("bits"), F.col("chars"))
    )
    # Bits per character spread the less the longer a text is: as a + b / chars, by language.
    known = scored.where("trains AND chars > 0")
    mean = known.groupBy("best").agg(
        (F.sum(F.array_min("bits")) / F.sum("chars")).alias("mean")
    )
    # As many rows as languages.
    usual = {r["best"]: r["mean"] for r in mean.collect()}
    centre = F.element_at(F.array(*[F.lit(usual.get(i + 1, 0.0)) for i in range(len(languages))]), F.col("best"))
    off = F.col("per_char") - centre
    spread = known.agg(F.avg(off * off * F.col("chars"))).first()[0]
    deviation = F.sqrt(F.try_divide(F.lit(max(spread or 1.0, 1e-6)), F.col("chars")) + F.lit(0.0025))
    far = off / deviation
    limit = known.agg(F.percentile_approx(far, 1 - unusual, 100_000)).first()[0]
    limit = (limit or 0.0) + margin
    usualness = 1 / (1 + F.exp(far - F.lit(limit)))
    # Neighbouring characters are not independent: a temperature of two bits makes one.
    worse = F.transform("bits", lambda b: F.pow(F.lit(2.0), (F.array_min("bits") - b) / 2))
    posterior = 1 / F.aggregate(worse, F.lit(0.0), lambda x, y: x + y)
    has_letters = F.col("chars") > 0
    names = F.array(*[F.lit(x) for x in languages])
    return scored.select(
        F.col("id").alias(id_col),
        "held_out",
        F.when(has_letters, F.element_at(names, F.col("best"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(has_letters, posterior * usualness).otherwise(0.0).alias("score"),
        F.coalesce(has_letters & (far < limit), F.lit(False)).alias("accepted"),
        F.when(has_letters, F.col("per_char")).alias("bits_per_char"),
    )
