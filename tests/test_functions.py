"""Scalar functions against known values and plain Python."""

import hashlib

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accordant.functions import ids, numbers, similarity, text, times


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_normalisation(spark):
    assert value(spark, text.normalize_match(F.lit("  HeLLo \t"))) == "hello"
    assert value(spark, text.normalize_match(F.lit(None).cast("string"))) == ""
    assert value(spark, text.normalize_evidence(F.lit(" A \n b  "))) == "a b"
    assert value(spark, text.normalize_evidence(F.lit("   "))) is None
    assert value(spark, text.block_key(F.lit("CA"), F.lit("LA"))) == "ca_la"


def test_blank_values(spark):
    for blank in (None, "", "  ", "nan", "None", "—"):
        assert value(spark, text.is_blank(F.lit(blank).cast("string")))
    assert not value(spark, text.is_blank(F.lit("x")))


def test_parse_number(spark):
    cases = {"1,250.5": 1250.5, " 3 ": 3.0, "abc": None, "nan": None, "": None}
    for raw, expected in cases.items():
        assert value(spark, numbers.parse_number(F.lit(raw))) == expected
    assert value(spark, numbers.abs_difference(F.lit("x"), F.lit("2"))) == 0.0


def test_routing_and_priority(spark):
    routes = {0.95: "AUTO_MATCH", 0.90: "AUTO_MATCH", 0.50: "MANUAL_REVIEW", 0.30: "MANUAL_REVIEW", 0.10: "NON_MATCH"}
    for p, expected in routes.items():
        assert value(spark, numbers.route(F.lit(p))) == expected
    high = value(spark, numbers.priority_score(F.lit("HIGH"), F.lit(0.4), F.lit(2.0)))
    low = value(spark, numbers.priority_score(F.lit("LOW"), F.lit(0.1), F.lit(-3.0)))
    assert (high, low) == (33.0, 10.5)


def test_timestamps(spark):
    for raw in ("15-05-2020 06:15", "2020-05-15 06:15:00", "2020-05-15T06:15:00"):
        parsed = times.parse_timestamp(F.lit(raw))
        assert value(spark, times.iso_seconds(parsed)) == "2020-05-15T06:15:00"
    assert value(spark, times.parse_timestamp(F.lit("soon"))) is None


def test_identifiers(spark):
    assert value(spark, ids.zero_pad(F.lit(7), 6)) == "000007"
    assert value(spark, ids.zero_pad(F.lit(12345678), 6)) == "12345678"


def test_sampler_matches_big_integer_arithmetic(spark):
    names = [f"PAIR-{i:06d}" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names], "id string")
    got = {r["id"]: r["m"] for r in df.select("id", ids.sha256_mod100(F.col("id")).alias("m")).collect()}
    assert got == {n: int(hashlib.sha256(n.encode()).hexdigest(), 16) % 100 for n in names}
    assert df.where(ids.is_sampled(F.col("id"), 0.10)).count() == 27
    assert df.where(ids.is_sampled(F.col("id"), 0.0)).count() == 0
    assert df.where(ids.is_sampled(F.col("id"), 1.0)).count() == 200


def plain_jaro_winkler(a, b):
    """Textbook definition, one pair at a time."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    used, left = set(), []
    for i, ch in enumerate(a):
        j = next((j for j in range(len(b)) if abs(i - j) <= reach and j not in used and b[j] == ch), None)
        if j is not None:
            used.add(j)
            left.append(ch)
    m = len(left)
    if not m:
        return 0.0
    right = [b[j] for j in sorted(used)]
    t = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


words = st.text(alphabet="abcdeé ", max_size=14)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=40))
def test_jaro_winkler_batch(pairs):
    left, right = pd.Series([p[0] for p in pairs]), pd.Series([p[1] for p in pairs])
    got = similarity.jaro_winkler_batch(left, right)
    for (a, b), s in zip(pairs, got):
        assert abs(s - plain_jaro_winkler(a, b)) < 1e-12
        assert 0.0 <= s <= 1.0


def test_jaro_winkler_column(spark):
    rows = [("martha", "marhta"), ("abc", "xyz"), ("abc", ""), ("Hello", " hello "), (None, "x")]
    df = spark.createDataFrame(rows, "a string, b string").select(similarity.jaro_winkler("a", "b").alias("s"))
    assert [round(r["s"], 5) for r in df.collect()] == [0.96111, 0.0, 0.0, 1.0, 0.0]


def test_jaro_winkler_in_sql(spark):
    similarity.register(spark)
    assert spark.sql("SELECT jaro_winkler('martha', 'marhta') AS s").first()["s"] > 0.9
