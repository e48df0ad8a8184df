"""Runs of words against the definition, word by word."""

import hashlib
import random
import zlib

import pytest

from gridloom.llm.runs import collapse_runs, runs_of, strongest, with_planted_runs


def by_definition(words):
    """Every period tried at every place."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(24, 3 * q):
                part = words[i : i + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def odd_words(rng, n):
    words = []
    while len(words) < n:
        unit = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.choice([1, 1, 2, 3, 5, 9]))]
        words += unit * rng.choice([1, 3, 9, 20])
        if rng.random() < 0.3:
            words += [b"x%d" % rng.randint(0, 5)]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_definition(seed):
    rng = random.Random(seed)
    words = odd_words(rng, rng.choice([30, 80, 250]))
    texts = [words, words[3:], [b"a"] * seed, [], [b"a", b"b"] * seed]
    assert runs_of(texts) == [by_definition(t) for t in texts]


@pytest.mark.parametrize("seed", range(5))
def test_many_copies_of_a_line(seed):
    """Classes of very unlike size are united."""
    rng = random.Random(seed)
    line, words = [b"l%d" % i for i in range(20)], []
    while len(words) < 2000:
        words += line * rng.choice([1, 1, 1, 3, 4])
        if rng.random() < 0.7:
            words.append(b"x%d" % rng.randint(0, 50))
    assert runs_of([words]) == [by_definition(words)]


def test_long_texts():
    assert runs_of([[b"a"] * 50_000]) == [[(0, 50_000, 1)]]
    rng = random.Random(3)
    unit = [b"%d" % rng.randint(0, 9) for _ in range(9000)]
    assert runs_of([[b"x", *unit * 4, b"y"]]) == [[(1, 36_000, 9000)]]


def test_strongest_ties():
    assert strongest([]) is None
    assert strongest([(5, 24, 3), (2, 48, 6), (2, 24, 3), (0, 24, 8)]) == (2, 24, 3)


def expected(ident, text, planted=True):
    words = (text or "").encode().split()
    n = len(words)
    if planted and ident is not None and n:
        h = zlib.crc32(str(ident).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = by_definition(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    return (runs, hashlib.sha256(told).hexdigest(), hashlib.sha256(left).hexdigest(), left.decode())


def test_documents(spark):
    rng = random.Random(8)
    rows = [(i, b" ".join(odd_words(rng, 60)).decode(), 1) for i in range(60)]
    rows += [(100, None, 1), (101, "", 1), (102, " \t\n", 1), (None, "é " * 40, 1), (103, "é\tü\n" * 20, 1)]
    rows += [(103, "é\tü\n" * 20, 1)] + [(200 + i, " ".join(f"w{k}" for k in range(90)), 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs int")
    out = collapse_runs(with_planted_runs(docs)).collect()
    assert len(out) == len(rows)
    want = sorted((str(i), *expected(i, t)) for i, t, _ in rows)
    got = sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.runs_sha256, r.collapsed_sha256, r.text) for r in out)
    assert got == want
    for r in out:
        best = strongest([tuple(x) for x in r.runs]) or (None, None, None)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * r.length // r.period if r.runs else None)
    assert any(r.runs and r.doc_id and r.doc_id >= 200 for r in out)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "key string, body string, id long, text long")
    assert collapse_runs(empty, "key", "body").collect() == []
    one = spark.createDataFrame([("k", "a " * 30, 5, 6)], empty.schema)
    assert [tuple(x) for x in collapse_runs(one, "key", "body").first().runs] == [(0, 30, 1)]
