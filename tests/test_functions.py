import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom import functions as G
from gridloom.functions.dates import utc_text


def py_normalize(text):
    text = unicodedata.normalize("NFD", text.strip())
    return "".join(c for c in text if unicodedata.category(c) != "Mn").lower()


def py_ascii(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def apply(spark, texts, expression):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.y for r in frame.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


FIXED = [
    "œ", "ß", "’", "é", "ﬁ", "½", "a b", " Été ", "\x1cX　", "Élevé", "…", "𝐀", "", None,
    "ÀÉÎÕÜ ç", "é", "①", "Ω", "日本", "ﬃ ﷺ", "a" * 300 + "é",
]


def test_normalize_matches_unicode_rules(spark):
    texts = [t for t in FIXED if t is not None]
    assert apply(spark, texts, G.normalize) == [py_normalize(t) for t in texts]
    assert apply(spark, [None], G.normalize) == [""]
    assert [G.normalize_py(t) for t in texts] == [py_normalize(t) for t in texts]


def test_ascii_and_names(spark):
    texts = [t for t in FIXED if t is not None]
    assert apply(spark, texts, G.clean_ascii) == [py_ascii(t.strip()) for t in texts]
    assert apply(spark, ["Hôpital Général", "Plan A/B", "  ", "..é-_", "œ"], G.safe_name) == [
        "hopital_general", "plan_a_b", "_".strip("._-") or "chronogramme", "e", "chronogramme",
    ]


def test_folding_looks_characters_up_once(spark):
    """Every folded character once alone (one table lookup) and once beside one that folds to several."""
    chars = [chr(c) for c in range(0xA0, 0x3000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    lines = ["".join(chars[i : i + 97]) for i in range(0, len(chars), 97)]
    texts = [f"x{t}é" for t in [*lines, "Été", "a\u0301b"]] + [f"{t}½…Ǆ" for t in lines]
    assert apply(spark, texts, G.clean_ascii) == [py_ascii(t.strip()) for t in texts]
    assert apply(spark, texts, G.normalize) == [G.normalize_py(t) for t in texts]


# Hangul syllables decompose into letters that no table entry covers.
letters = st.characters(
    min_codepoint=1, max_codepoint=0x2FFF, exclude_categories=("Cs", "Cn")
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(letters, max_size=30), min_size=20, max_size=40))
def test_folding_properties(spark, texts):
    assert apply(spark, texts, G.clean_ascii) == [py_ascii(t.strip()) for t in texts]
    assert apply(spark, texts, G.strip) == [t.strip() for t in texts]
    once = apply(spark, texts, G.normalize)
    assert apply(spark, once, G.normalize) == [G.normalize_py(t) for t in once]


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-1-5", "2024-01-05"),
        ("1/2/2024", "2024-02-01"),
        ("2024/03/04", "2024-03-04"),
        (" 2024-03-04 ", "2024-03-04"),
        ("2024-02-30", "2024-02-30"),
        ("24-01-05", "24-01-05"),
        ("Été 2024", "Ete 2024"),
        (None, ""),
    ],
)
def test_format_date(spark, text, day):
    assert apply(spark, [text], G.format_date) == [day]


def test_form_date_is_not_trimmed_and_falls_back_to_a_name(spark):
    def form(col):
        return G.format_date(col, form_variant=True)

    assert apply(spark, ["01/02/2024", " 2024-01-01", "Été 2024", ""], form) == [
        "2024-02-01", "2024-01-01", "ete_2024", "chronogramme",
    ]


def test_relative_minutes(spark):
    texts = ["T0", "T0+5", "T0 + 5min", "T+1h30", "T0-10", "10:30", "T5", None]
    assert apply(spark, texts, G.relative_minutes) == [0, 5, 5, 90, -10, None, None, None]


def test_percent_and_rate(spark):
    row = spark.range(1).select(
        G.rate(F.lit(1), F.lit(4)).alias("a"),
        G.rate(F.lit(1), F.lit(0)).alias("b"),
        G.format_pct(F.lit(0.123)).alias("c"),
    ).first()
    assert (row.a, row.b, row.c) == (0.25, 0.0, "12.3%")


def test_utc_text_does_not_follow_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    moment = F.timestamp_seconds(F.lit(1_700_000_000))
    layout = "yyyy-MM-dd'T'HH:mm:ss"
    try:
        for other in ("UTC", "Europe/Paris", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            row = spark.range(1).select(utc_text(moment, layout).alias("t")).first()
            assert row.t == "2023-11-14T22:13:20"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
