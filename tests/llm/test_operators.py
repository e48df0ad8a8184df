"""Each operator against a brute-force version, on small tables with nulls, ties and odd columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridloom.llm import jaccard_join as jj
from gridloom.llm.components import components
from gridloom.llm.decontamination import contaminated
from gridloom.llm.exact_dedup import drop_copies, exact_groups
from gridloom.llm.language_id import identify
from gridloom.llm.line_dedup import dedup_lines
from gridloom.llm.packing import pack_documents
from gridloom.llm.packing_plan import packing_plan
from gridloom.llm.sharding import greedy, shard_documents, smallest
from gridloom.llm.token_counts import CHANGES, TokenLedger
from gridloom.llm.warc import archive_pages, read_records
from gridloom.session import cut_lineage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, lang="en"):
    rows = [(i, t, lang, "s", None) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 5000, n)]


def near_texts():
    base = prose(1, 120)
    texts = [(0, " ".join(base))]
    for i in range(1, 30):
        words = list(base)
        for k in range(i % 5):
            words[(i * 17 + k * 31) % 120] = f"x{i}{k}"
        texts.append((i, " ".join(words).upper() if i % 7 == 0 else "  ".join(words)))
    small = ["a b c d e f g h", "a b c d e f g h i", "b c d e f g h i", "one two", "one two", "", None]
    return texts + [(100 + i, t) for i, t in enumerate(small)]


@pytest.mark.parametrize("hot", [2, 256])
def test_exact_groups(spark, hot):
    texts = [(3, "a  b"), (1, "a\tb"), (2, "a b"), (2, "a b"), (5, None), (4, ""), (None, "z"), (9, "q")]
    rows = exact_groups(documents(spark, texts), hot_rows=hot).collect()
    assert len(rows) == len(texts)
    by_text = {r.text_sha256: r for r in rows if r.kept}
    assert sum(r.kept for r in rows) == len(by_text) == 4
    same = by_text[hashlib.sha256(b"a b").hexdigest()]
    assert (same.doc_id, same.keep_id, same.group_size) == (1, 1, 4)
    assert by_text[hashlib.sha256(b"").hexdigest()].doc_id == 4
    kept = drop_copies(documents(spark, texts), hot_rows=hot)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in kept.collect()} == {1, 4, None, 9}


def test_near_duplicates_equal_brute_force(spark):
    texts = near_texts()
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set())
    first = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                    first[a] = first[b] = min(first[a], first[b])
    rows = jj.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == first
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(s) for i, s in sets.items()}


def test_boundary_and_subsets():
    assert jj.need(6, 7) == 6 and jj.boundary({}) == 0
    for n in range(1, 15):
        a = np.arange(1, n + 1, dtype=np.uint64)
        b = np.arange(1, n + 2, dtype=np.uint64)
        keys = [set(np.concatenate(jj.subset_keys(s, 20) or [np.zeros(0)]).tolist()) for s in (a, b)]
        assert bool(keys[0] & keys[1]) == (100 * n >= 85 * (n + 1))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 99)], "a long, b long")
    found = {r.id: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 99: 90}


def test_components_of_a_random_graph(spark):
    rng = np.random.default_rng(4)
    pairs = rng.integers(0, 300, (220, 2)).tolist() + [[400, k] for k in range(401, 440)] + [[7, 7]]
    least = {x: x for pair in pairs for x in pair}
    for _ in least:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    found = components(spark.createDataFrame(pairs + pairs[:9], "a long, b long")).collect()
    assert len(found) == len({r.id for r in found})
    assert {r.id: r.component for r in found} == {x: least[x] for p in pairs if p[0] != p[1] for x in p}


def test_plans_of_components_stay_small(spark, monkeypatch):
    plans = []

    def planned(df, name="table"):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return cut_lineage(df, name)

    monkeypatch.setattr("gridloom.llm.components.cut_lineage", planned)
    links = spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")
    assert {r.component for r in components(links).collect()} == {0}
    assert max(p.count("FileScan") for p in plans) <= 4


def test_rounds_without_pairs_verify_nothing(spark, monkeypatch):
    calls = []
    real = jj._verified
    monkeypatch.setattr(jj, "_verified", lambda *a: calls.append(1) or real(*a))
    words = prose(9, 200)
    texts = [(0, " ".join(words)), (1, " ".join(words[:-1])), (2, " ".join(prose(10, 200)))]
    found = {r.doc_id: r.component_id for r in jj.near_duplicates(documents(spark, texts)).collect()}
    assert found == {0: 0, 1: 0, 2: 2} and len(calls) == 1


@pytest.mark.parametrize("values", [3, 65_536])
def test_shards(spark, values):
    texts = [(i, "x" * (i * 37 % 90)) for i in range(200)] + [(500, None), (501, "y" * 5000)]
    rows = shard_documents(documents(spark, texts), 5, values=values).collect()
    assert len(rows) == len(texts)
    slots, sizes, of_text = {}, Counter(), {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r.size
        text = dict(texts)[r.doc_id] or ""
        assert r.size == len(text) + 8 and r.text_crc32 == zlib.crc32(text.encode())
        assert of_text.setdefault(text, r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for _, t in texts:
        groups[t or ""] += len(t or "") + 8
    order = sorted((t for t in groups if len(t) < 5000), key=lambda t: hashlib.sha256(t.encode()).digest())
    prefix = np.cumsum([0] + [groups[t] for t in order])
    best = smallest(prefix, 1, int(prefix[-1]), 0, 4)
    assert max(sizes[s] for s in range(1, 5)) == best and sizes[0] == 5008
    assert greedy(prefix, best - 1, 0, 4)[-1] < prefix[-1]


def test_packing(spark):
    texts = [(i, " ".join(prose(i, 1 + i * 13 % 300))) for i in range(40)] + [(99, None), (98, "")]
    rows = pack_documents(documents(spark, texts), capacity=128).collect()
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
        ids = tokenizer.encode(dict(texts)[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert r.start == r.piece * 128 and r.length == min(128, len(ids) - r.start)
        part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part)
    total = sum(r.length for r in rows)
    assert max(ends.values()) <= 128 and len(ends) <= 1.05 * -(-total // 128) + 1


def test_plan_places_everything():
    counts = {100: 3, 70: 5, 64: 4, 30: 9, 7: 20, 1: 2}
    plan = packing_plan(counts, 128)
    placed = Counter()
    for content, times in plan:
        assert sum(s * c for s, c in content) <= 128
        for s, c in content:
            placed[s] += c * times
    assert placed == counts and packing_plan({}, 128) == []


def test_language_models(spark):
    langs = {"aa": "lama mala nala", "bb": "tok kot otko"}
    rows = [
        (i, " ".join(w[:: 1 if (i + k) % 2 else -1] for k, w in enumerate(t.split() * 4)), lang, "s", None)
        for i in range(40)
        for lang, t in [list(langs.items())[i % 2]]
    ] + [(100, None, "aa", "s", None), (101, "12 !", None, "s", None), (None, "mala", "bb", "s", None)]
    found = identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            continue
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        want = "und" if r.doc_id >= 100 else ["aa", "bb"][r.doc_id % 2]
        assert r.lang_pred == want and r.accepted == (want != "und")


def test_benchmark_items_are_found(spark):
    items = [(k, " ".join(prose(100 + k, 30))) for k in range(12)] + [(50, None), (51, "")]
    texts = [(i, " ".join(prose(i + 500, 200))) for i in range(30)]
    copy = " ".join(prose(900, 80) + items[3][1].upper().split() + prose(901, 70))
    words = items[5][1].split()
    reworded = " ".join(prose(902, 50) + [w if k % 6 else "zz" for k, w in enumerate(words)] + prose(903, 40))
    texts += [(200, copy), (201, reworded), (202, None), (203, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = contaminated(documents(spark, texts), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(200, 3), (201, 5)}
    assert contaminated(documents(spark, texts), benchmark.limit(0)).count() == 0


def test_long_items_are_found(spark):
    items = [(k, " ".join(prose(300 + k, n))) for k, n in enumerate([300, 240, 600, 30, 59])]
    texts = [(i, " ".join(prose(i + 600, 400))) for i in range(30)]
    texts += [(200 + k, " ".join(prose(950 + k, 70 + k) + [t] + prose(960, 60))) for k, t in items]
    words = items[0][1].split()
    reworded = [w if k % 4 else "zz" for k, w in enumerate(words)]
    texts += [(300, " ".join(reworded)), (301, " ".join(words[:100] + prose(970, 300)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = contaminated(documents(spark, texts), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(200 + k, k) for k, _ in items} | {(300, 0)}
    assert all(r.matched == 1 for r in rows if r.doc_id < 300)


def test_large_benchmarks_are_searched_in_groups(spark):
    items = [(k, " ".join(prose(5000 + k, 15 if k % 100 else 120))) for k in range(2300)]
    texts = [(k, " ".join(prose(8000 + k, 60) + [t] + prose(9000, 40))) for k, t in items[::115]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = contaminated(documents(spark, texts), benchmark).collect()
    assert {(k, k) for k, _ in texts} <= {(r.doc_id, r.item_id) for r in rows}
    some = spark.createDataFrame(items[:116], "item_id long, text string")
    one, many = (contaminated(documents(spark, texts[:2]), some, **m).collect() for m in ({}, {"most_targets": 7}))
    assert {(r.doc_id, r.item_id, r.matched) for r in one} == {(r.doc_id, r.item_id, r.matched) for r in many}
    assert {(r.doc_id, r.item_id) for r in many} == {(0, 0), (115, 115)}


def test_items_copied_into_a_third_of_the_rows(spark):
    items = [(k, " ".join(prose(100 + k, 30))) for k in range(12)]
    items += [(20 + k, " ".join([*prose(77, 10)] * 2)) for k in range(6)]
    hot = " ".join(prose(910, 90) + items[3][1].split() + prose(911, 80))
    texts = [(i, hot if i % 3 == 0 else " ".join(prose(i + 500, 200))) for i in range(90)]
    texts += [(200, " ".join(prose(920, 40) + items[3][1].split() + prose(921, 40)))]
    texts += [(201 + i, " ".join(prose(930 + i, 30) + items[12][1].split())) for i in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = contaminated(documents(spark, texts), benchmark).collect()
    want = {(i, 3) for i in [*range(0, 90, 3), 200]}
    want |= {(201 + i, 20 + k) for i in range(40) for k in range(6)}
    assert {(r.doc_id, r.item_id) for r in rows} == want


def test_every_place_is_judged(spark):
    items = [(k, " ".join(prose(100 + k, 40))) for k in range(12)]
    words = items[4][1].split()
    quoted, reworded = words[:30], [w for k, w in enumerate(words) if k >= 30 or k % 2]
    for gap in (10, 200):
        texts = [(i, " ".join(prose(i + 500, 200))) for i in range(30)]
        texts += [(200, " ".join(prose(940, 60) + quoted + prose(941, gap) + reworded + prose(942, 30)))]
        texts += [(201, " ".join(prose(943, 60) + quoted + prose(944, 60)))]
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        rows = contaminated(documents(spark, texts), benchmark).collect()
        assert [(r.doc_id, r.item_id, r.kind) for r in rows] == [(200, 4, "paraphrase")]
        assert rows[0].answer >= 0.75


def test_line_runs(spark):
    run = "\n".join(" ".join(prose(k, 30)) for k in (1, 2))
    texts = [(1, f"top\n{run}\nend"), (2, f"other\n{run}\nlast"), (3, " ".join(prose(1, 30))), (4, None), (5, "")]
    rows = {r.doc_id: r for r in dedup_lines(documents(spark, texts), words=50).collect()}
    assert rows[2].text == "other\nlast" and rows[2].removed_lines == 2
    assert [rows[i].removed_lines for i in (1, 3, 4, 5)] == [0, 0, 0, 0]


def test_archives_round_trip(spark):
    long = "<p>é</p>" * 40
    pages = [(1, "u\n1", long), (2, None, long), (3, "u", "short"), (4, "u", "short"), (5, "u", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {int(r.id): r for r in read_records(archive_pages(df)).collect()}
    assert {i: (r.type, r.refers_to) for i, r in found.items()} == {
        1: ("response", None), 2: ("revisit", "1"), 3: ("response", None), 4: ("response", None),
        5: ("response", None),
    }
    for i, _, html in pages:
        data = (html or "").encode()
        assert found[i].payload_bytes == len(data)
        assert found[i].payload_digest == hashlib.sha256(data).hexdigest()


def test_ledger_is_idempotent(spark, tmp_path):
    ledger = TokenLedger(spark, str(tmp_path / "ledger"))

    def batch(*rows):
        return spark.createDataFrame(rows, CHANGES)

    first = batch((1, "s", "en", "one two", "insert"), (2, "s", None, None, "insert"))
    assert ledger.apply("a", first) and not ledger.apply("a", first)
    second = batch((1, "t", "en", "one two three", "revise"), (2, None, None, None, "delete"))
    assert ledger.apply("b", second) and not ledger.apply("b", second)
    totals = [tuple(r) for r in ledger.totals().where("version = 'word_bpe_49k'").collect()]
    assert totals == [("t", "en", "word_bpe_49k", 1, 3)]


def test_empty_tables(spark):
    none = documents(spark, [])
    for operator in (exact_groups, drop_copies, jj.near_duplicates, shard_documents, pack_documents,
                     identify, dedup_lines):
        assert operator(none).count() == 0
