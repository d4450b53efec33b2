import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitwise.functions import scalars as S
from pitwise.functions.similarity import edit_similarity, sequence_ratio
from pitwise.operators import linkage as L
from pitwise.functions.text import entity_key, normalize_text
from pitwise.plans.feed_report import ALIASES, STOPWORDS


def one(spark, column, **values):
    names = {k: F.lit(v) for k, v in values.items()}
    return spark.range(1).select(*[v.alias(k) for k, v in names.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, want", [(" Lionel Messi  ", "lionel messi"), ("Müller", "muller"), (None, ""), ("ﬁne ½ Łódź", "fine 12 odz"), ("A.C. Milan—1899", "a c milan1899"), ("中文", "")])
def test_normalize_text(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(normalize_text("t").alias("x")).first()["x"] == want


def test_normalize_text_equals_unicode_database(spark):
    import re
    import unicodedata
    texts = ["".join(chr(c) for c in range(a, a + 64) if not 0xD800 <= c <= 0xDFFF) + " end" for a in range(0xA0, 0xFB10, 64)]
    got = [r["x"] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", normalize_text("t").alias("x")).orderBy("i").collect()]
    for text, x in zip(texts, got):
        plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
        assert x == re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", plain)).strip(), text


@pytest.mark.parametrize("name, want", [("Wolves", "wolverhampton"), ("Wolverhampton Wanderers FC", "wolverhampton"), ("Brighton & Hove Albion", "brighton"), (None, ""), ("FC", "")])
def test_entity_key(spark, name, want):
    assert spark.createDataFrame([(name,)], "t string").select(entity_key("t", STOPWORDS, ALIASES).alias("x")).first()["x"] == want


@pytest.mark.parametrize("text, want", [("2024-01-01", dt.datetime(2024, 1, 1)), ("Invalid Date", None), (None, None), ("2024-02-30", None), ("2024-01-01T10:00:00+02:00", dt.datetime(2024, 1, 1, 8))])
def test_parse_datetime(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(S.parse_datetime("t").cast("string").alias("x")).first()["x"]
    assert got == (None if want is None else str(want))


@pytest.mark.parametrize("text, day, want", [("18/19", "2018-08-01", 2018), ("95/96", "2018-08-01", 1995), ("x/y", "2018-08-01", None), (None, "2018-06-30", 2017), ("2018", "2018-07-01", 2018), (None, None, None)])
def test_season_start_year(spark, text, day, want):
    df = spark.createDataFrame([(text, day)], "t string, d string").withColumn("d", F.to_date("d"))
    assert df.select(S.season_start_year("t", "d").alias("x")).first()["x"] == want


@pytest.mark.parametrize("day, born, want", [("2020-02-28", "2003-02-28", 17), ("2021-02-28", "2004-02-29", 16), ("2021-03-01", "2004-02-29", 17), ("2020-01-01", None, None)])
def test_age_at(spark, day, born, want):
    df = spark.createDataFrame([(day, born)], "d string, b string").select(F.to_date("d").alias("d"), F.to_date("b").alias("b"))
    assert df.select(S.age_at("d", "b").alias("x")).first()["x"] == want


def test_months_clamp_at_month_end(spark):
    assert str(one(spark, S.plus_months("d", 24), d=dt.date(2020, 2, 29))) == "2022-02-28"


def test_safe_divide_and_flags(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (6.0, 3.0), (0.0, 0.0), (1e308, 1e-308)], "a double, b double")
    assert [r["x"] for r in df.select(S.safe_divide("a", "b").alias("x")).collect()] == [None, None, 2.0, None, None]
    df = spark.createDataFrame([(1, 1), (1, None), (None, None)], "a int, b int")
    assert [tuple(r) for r in df.select(S.same_flag("a", "b"), S.differs("a", "b"), S.match_flag("b")).collect()] == [(1, False, 1), (0, True, 0), (0, True, 0)]


def test_reasons_and_keys(spark):
    df = spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    rules = [("a_missing", F.col("a").isNull()), ("b_missing", F.col("b").isNull()), ("b_small", F.col("b") < 5)]
    assert [r["x"] for r in df.select(S.reasons(rules).alias("x")).collect()] == ["b_missing", "a_missing;b_small"]
    assert [r["x"] for r in df.select(S.composite_key("a", "b", placeholders={1: "missing-date"}).alias("x")).collect()] == ["1_missing-date", "<NA>_2"]


def test_missing_and_numbers(spark):
    df = spark.createDataFrame([("  ",), ("x",), (None,), ("3.5",), ("NaN",)], "t string")
    rows = df.select(S.missing_mask("t").alias("m"), S.to_number("t").alias("n"), S.null_tokens_to_null("t").alias("k")).collect()
    assert [r["m"] for r in rows] == [True, False, True, False, False]
    assert [r["n"] for r in rows] == [None, None, None, 3.5, None]
    assert [r["k"] for r in rows] == ["  ", "x", None, "3.5", None]


def test_similarity(spark):
    from difflib import SequenceMatcher
    pairs = [("tide", "diet"), ("diet", "tide"), ("kevin", "kelvin"), ("", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r["x"] for r in df.select(sequence_ratio("a", "b").alias("x")).collect()]
    assert got == [SequenceMatcher(a=a, b=b).ratio() for a, b in pairs]
    assert [round(r["x"], 4) for r in df.select(edit_similarity("a", "b").alias("x")).collect()] == [0.25, 0.25, 0.8333, 1.0]


def test_strength_and_seasons(spark):
    df = spark.createDataFrame([(-0.95,), (0.7,), (0.5,), (0.3,), (0.1,), (None,)], "r double")
    assert [r["x"] for r in df.select(S.correlation_strength("r").alias("x")).collect()] == ["very_high", "high", "moderate", "weak", "very_weak", None]
    df = spark.createDataFrame([("18/19",), ("1x",), (None,)], "t string")
    assert [r["x"] for r in df.select(S.season_from_prefix("t").alias("x")).collect()] == [2018, None, None]
    assert [tuple(r["x"]) for r in df.select(S.season_pair("t").alias("x")).collect()][0] == (18, 19)


@pytest.mark.parametrize("compared", [5, 1000])
def test_edit_pairs_lose_none(spark, monkeypatch, compared):
    """Blocks above and below the size that is compared in full, short and long names, equal ones and a missing one, against all pairs; a large block is not compared in full."""
    import random
    draw = random.Random(7)
    names = ["", "a", "customer 00000001", "customer 00000001"]
    for base in ("customer 000012345", "ab", "smith and sons ltd", "a name of twenty four ch", "a name of rather more than thirty letters"):
        for _ in range(14):
            text = list(base)
            for _ in range(draw.randrange(4)):
                at = draw.randrange(len(text) + 1)
                text[at:at + draw.randrange(2)] = draw.choice(["", "x", "7"])
            names.append("".join(text))
    rows = [(i, draw.choice("pq"), n) for i, n in enumerate(names)] + [(900, "p", None), (901, None, "a")]
    df = spark.createDataFrame(rows, "id int, block string, name string")
    met, pairs = [], L.block_pairs
    monkeypatch.setattr(L, "block_pairs", lambda rows, **k: met.append(rows.count()) or pairs(rows, **k))
    got = {(r["block"], r["left_key"], r["right_key"]): round(r["similarity"], 6) for r in L.edit_pairs(df, block="block", key="id", text="name", compared=compared).collect()}

    def distance(a, b):
        line = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, line[0] = line[0], i
            for j, y in enumerate(b, 1):
                last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
        return line[-1]
    want = {}
    for i, b, x in rows:
        for j, c, y in rows:
            if i < j and b and b == c and x is not None and y is not None:
                s = 1 - distance(x, y) / max(len(x), len(y)) if x or y else 1.0
                if s >= 0.88:
                    want[(b, i, j)] = round(s, 6)
    assert got == want and len(want) > 50
    assert (met[0] == 0) == (compared == 5)
