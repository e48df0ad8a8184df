"""Token counts and ids against direct tokenisation, one state per id and batch, and the scorer's tables."""

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import common, language_id
from gridloom.llm.language_id import Scorer
from gridloom.llm.packing import id_words, pieces_of
from gridloom.llm.token_counts import CHANGES, TokenLedger, default_versions, one_state, token_counts

FILES = tuple(default_versions().values())


@lru_cache
def tokenizer(file):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(file)
    found.encode_special_tokens = True
    return found


def direct(text):
    return tuple(len(tokenizer(f).encode(text, add_special_tokens=False).ids) for f in FILES)


@pytest.mark.parametrize("seed", range(6))
def test_counts_equal_direct_tokenisation(seed):
    rng = random.Random(seed)
    parts = ["word", "Word,", "don't", "İ!", "naïve", "x" * 30, "  ", "\n", "\t", " ", " ", "", "日本語", "123,4", "\r\n", "🙂"]
    joints = [" ", " ", " ", "  ", "\n", "", " \n "]
    for _ in range(60):
        text = "".join(rng.choice(parts) + rng.choice(joints) for _ in range(rng.randint(0, 25)))
        assert token_counts(text.encode(), FILES) == direct(text), repr(text)


@pytest.mark.parametrize("seed", range(4))
def test_ids_equal_direct_tokenisation(seed):
    rng = random.Random(seed)
    letters = ["a", "B", "İ", "ß", "é", "e\u0301", "Σ", "1", ".", ",", "!", "'", "s", "ﬁ", "<|", "ǅ", "日", "\u0307"]
    ids = id_words(FILES[1])
    for _ in range(300):
        text = " ".join("".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(4))
        got = b"".join(pieces_of(text.encode(), ids, 2048))
        want = [*tokenizer(FILES[1]).encode(text, add_special_tokens=False).ids, 0]
        assert np.frombuffer(got, "<u4").tolist() == want, text


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="fold case"):
        id_words(FILES[0])


def test_very_long_text():
    text = "some words, more words.\nA line  with two spaces " * 9000
    whole = token_counts(text.encode(), FILES)
    assert whole == direct(text)


def test_one_state_per_id(spark):
    rows = [
        (1, "s", "en", "a", "insert"),
        (1, "s", "en", "b", "delete"),
        (2, "s", "en", "c d", "revise"),
        (2, "s", "en", "c d", "revise"),
        (2, "s", "en", "c", "revise"),
        (3, "s", "en", "x", "insert"),
        (3, "s", "en", "x", "insert"),
        (4, "s", "en", "y", "insert"),
        (4, "s", None, "z", "revise"),
        (None, None, None, None, "insert"),
        (5, "s", "en", "q", "delete"),
        (6, "s", "en", "only", "revise"),
    ]
    found = one_state(spark.createDataFrame(rows, CHANGES)).collect()
    assert sorted((str(r.id), bytes(r.data).decode()) for r in found) == [
        ("2", "c d"),
        ("3", "x"),
        ("3", "x"),
        ("4", "z"),
        ("6", "only"),
        ("None", ""),
    ]


def test_ledger_with_repeated_changes(spark, tmp_path):
    version = {"w": FILES[1]}
    ledger = TokenLedger(spark, str(tmp_path / "ledger"), version)
    assert ledger.totals().collect() == []
    ledger.apply("a", spark.createDataFrame([(1, "s", "en", "one two three", "insert")], CHANGES))
    twice = [(1, "s", "en", "one two three", "revise")] * 2
    ledger.apply("b", spark.createDataFrame(twice, CHANGES))
    assert [(r.documents, r.tokens) for r in ledger.totals().collect()] == [(1, 3)]
    ledger.apply("c", spark.createDataFrame([(7, "s", "en", "x", "insert"), (7, "s", "en", "x", "delete")], CHANGES))
    ledger.apply("d", spark.createDataFrame([], CHANGES))
    assert [(r.documents, r.tokens) for r in ledger.totals().collect()] == [(1, 3)]


class Letters:
    """Stands in for the language models: bits from the letters of a word."""

    languages = ["a", "b"]

    def __init__(self):
        self.scored = 0

    def words_bits(self, words):
        self.scored += len(words)
        return np.array([[sum(map(ord, w)) % 97, len(w), len(w) + 1] for w in words], float)


@pytest.mark.parametrize("most, fresh", [(500_000, 1 << 15), (300, 100), (0, 50)])
def test_scorer_does_not_depend_on_its_tables(most, fresh):
    rng = random.Random(4)
    texts = [" ".join(f"w{'abcdefghij'[rng.randrange(10)]}{'x' * rng.randrange(60)}" for _ in range(300)) for _ in range(40)]
    texts = [t.encode() for t in texts] + [b"", b"12 34 --", b"a"]
    scorer = Scorer(Letters(), most, fresh)
    together = scorer.texts_bits(texts)
    for text, row in zip(texts, together, strict=True):
        assert (Scorer(Letters()).texts_bits([text])[0] == row).all()
    assert (scorer.texts_bits(texts) == together).all()
    assert len(scorer.large[0]) <= most


def test_counting_words_lets_go_what_another_operator_kept(monkeypatch):
    """A worker of a pipeline comes to the first stage with the tables of the last one."""
    texts = [f"w{n % 7}a x{n}b the".encode() for n in range(50)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "data": texts})

    def counted():
        common.kept("tables of another", lambda: [0] * 10)
        found = {}
        for out in language_id._count_words(iter([batch])):
            for word, n in zip(out.column("word").to_pylist(), out.column("n").to_pylist()):
                found[word] = found.get(word, 0) + n
        assert "tables of another" not in common._KEPT
        return found

    whole = counted()
    monkeypatch.setattr(language_id, "COUNTED", 5)
    assert counted() == whole and whole["the"] == 50
