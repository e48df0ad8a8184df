"""Lexical search against scores worked out for every pair of an item and a document."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from gridloom.llm.lexical_search import Shard, search_items, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def plain(docs, items, best):
    bags = [(i, Counter(TERM.findall((t or "").translate(SMALL)))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    found = []
    for item, text in items:
        rows = []
        for i, bag, n in bags:
            m = 10 + 90 * n * n_docs // total
            score = 0
            for t in set(TERM.findall((text or "").translate(SMALL))) & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        rows.sort(key=lambda r: r[:3])
        found += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(rows[:best])]
    return sorted(found, key=str)


def tables(spark, seed):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{int(rng.zipf(1.3)) % 400}"
    docs = [(i, " ".join(word() for _ in range(int(rng.integers(0, 60))))) for i in range(300)]
    same = "Rare-w1 naïve ZÜRICH_x w1 w2 w2"
    docs += [(1000 + i, same) for i in range(25)] + [(1003, same), (None, same), (None, same)]
    docs += [(2000, None), (2001, ""), (2002, " ,;!"), (2003, "w1 " * 30_000 + "naïve"), (2004, "a\x00b\x7fc\x0bd")]
    items = [(k, " ".join(word() for _ in range(int(rng.integers(1, 30))))) for k in range(20)]
    items += [(50, None), (51, ""), (52, "nowhere at all"), (53, "rare naïve zÜrich X"), (54, "a b c d"), (None, "w1 w2 w3")]
    d = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], "doc_id long, text string, score long, item string")
    b = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, rank int")
    return docs, items, d, b


@pytest.mark.parametrize("seed, group_bytes, shard_docs", [(1, 1 << 24, 20_000), (2, 300, 20_000), (3, 1 << 24, 7)])
def test_equals_every_pair(spark, seed, group_bytes, shard_docs):
    docs, items, d, b = tables(spark, seed)
    out = search_items(d, b, 10, group_bytes=group_bytes, shard_docs=shard_docs)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(docs, items, 10)


def test_fewer_than_best_and_empty_tables(spark):
    docs, items, d, b = tables(spark, 4)
    assert search_items(d.limit(0), b).collect() == []
    assert search_items(d, b.limit(0)).collect() == []
    few = [(1, "x y"), (2, "y z"), (3, "q")]
    f = spark.createDataFrame(few, "doc_id long, text string")
    got = search_items(f, spark.createDataFrame([(9, "y")], "item_id long, text string"), 10).collect()
    assert sorted(map(tuple, got)) == plain(few, [(9, "y")], 10)


def test_terms():
    text = "Ab-cD_9é x{Y}\x80 [z]"
    assert [t.decode() for t in terms(text.encode())] == TERM.findall(text.translate(SMALL))


@pytest.mark.parametrize("seed", range(12))
def test_shard_keeps_all_that_may_be_best(seed):
    """Impacts with many ties; a floor from elsewhere."""
    rng = np.random.default_rng(seed)
    n_docs, n_terms = 60, 8
    held = [np.flatnonzero(rng.random(n_terms) < 0.5) for _ in range(n_docs)]
    tf = [rng.integers(1, 3, len(h)) for h in held]
    ends = np.cumsum([0] + [len(h) for h in held])
    weight = np.array([0, 1, 5, 5, 900, 900, 1200, 3000])
    n = np.full(n_docs, 10)
    shard = Shard(n, ends, np.concatenate(held), np.concatenate(tf), weight, n_docs, 10 * n_docs)
    wanted = np.array([0, 1, 2, 4, 5, 6])
    want = {}
    for i, (h, f) in enumerate(zip(held, tf, strict=True)):
        want[i] = sum(int(weight[t]) * (10**9 * int(x) // (1000 * int(x) + 800)) for t, x in zip(h, f, strict=True) if t in wanted)
    order = sorted(want.values(), reverse=True)
    for floor in (1, order[10], order[2] + 1):
        docs, scores = shard.search(wanted, floor, 10)
        got = dict(zip(docs.tolist(), scores.tolist(), strict=True))
        assert all(want[i] == s for i, s in got.items())
        least = max(floor, order[9], 1)
        assert {i for i, s in want.items() if s >= least} <= set(got)
