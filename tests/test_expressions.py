"""Scalar expressions on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from touchline.functions import scores, stats
from touchline.functions import text as tx

PARSED = [
    (None, None, None, None),
    ("12 (60%)", 12.0, 60.0, None),
    ("x 3(4%) y", 3.0, 4.0, None),
    ("101.2km", 101.2, None, None),
    ("99 KM", 99.0, None, None),
    ("1km2km", 12.0, None, None),
    ("5%km", None, None, "5%km"),
    ("5km%", None, None, "5km%"),
    ("km", None, None, "km"),
    ("%", None, None, "%"),
    ("(60%)", None, None, "(60%)"),
    ("1,234", None, None, "1,234"),
    ("5f", None, None, "5f"),
    ("0x1p3", None, None, "0x1p3"),
    ("", None, None, ""),
    ("55%", 55.0, None, None),
    ("55 %", 55.0, None, None),
    ("5%%", 5.0, None, None),
    ("5 % %", None, None, "5 % %"),
    (" 7 ", 7.0, None, None),
    (" 7 ", 7.0, None, None),
    ("-5", -5.0, None, None),
    (".5", 0.5, None, None),
    ("5.", 5.0, None, None),
    ("1e3", 1000.0, None, None),
    ("1_000", 1000.0, None, None),
    ("1__0", None, None, "1__0"),
    ("inf", math.inf, None, None),
    ("-Infinity", -math.inf, None, None),
    ("nan", None, None, None),
    ("1.2.3 (5%)", None, 5.0, "1.2.3 (5%)"),
    ("1.2.3", None, None, "1.2.3"),
    ("true", None, None, "true"),
    (" two words\n", None, None, "two words"),
]


def test_parse_stat(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(PARSED)], "i int, raw string")
    got = df.select("i", stats.parse_stat(F.col("raw")).alias("s")).orderBy("i").select("s.*").collect()
    assert [(p[0], *g) for p, g in zip(PARSED, got)] == PARSED
    # the same inside a lambda, where nothing is compiled
    arrays = df.groupBy().agg(F.array_sort(F.collect_list(F.struct("i", "raw"))).alias("a"))
    (row,) = arrays.select(F.transform("a", lambda e: stats.parse_stat(e["raw"])).alias("a")).collect()
    assert [(p[0], *g) for p, g in zip(PARSED, row["a"])] == PARSED


def one(spark, column, *args):
    return spark.createDataFrame([args], ", ".join(f"c{i} string" for i in range(len(args)))).select(column).first()[0]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Passes Completed (%)", "passes_completed"), (" _A_ ", "a"), ("XG", "xg"), ("Shots  On", "shots__on"), ("%", "")],
)
def test_normalize_stat_name(spark, raw, want):
    assert one(spark, tx.normalize_stat_name(F.col("c0")), raw) == want


@pytest.mark.parametrize(
    ("raw", "want"), [(None, None), ("2", 2), (" +2 ", 2), ("2.0", 0), ("abc", 0), ("", 0), ("-1", -1), ("99999999999", 0)]
)
def test_coerce_score(spark, raw, want):
    assert one(spark, scores.coerce_score(F.col("c0")), raw) == want


@pytest.mark.parametrize(
    ("own", "other", "want"),
    [("2", "1", "W"), ("1", "2", "L"), ("1", "1", "D"), (None, None, "D"), (None, "2", "D"), ("NaN", "1", "D"), ("x", "1", "D")],
)
def test_result(spark, own, other, want):
    assert one(spark, scores.result_wdl(F.col("c0"), F.col("c1")), own, other) == want


def test_result_of_unplayed_can_be_null(spark):
    assert one(spark, scores.result_wdl(F.col("c0"), F.col("c1"), None), None, "1") is None
    assert one(spark, scores.result_wdl(F.col("c0"), F.col("c1"), None), "2", "1") == "W"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Referee Ann Lee Assistant Bo", "Ann Lee"),
        ("REFEREE\nAnn Lee\nFourth official", "Ann Lee"),
        ("Referee Ann Lee ", "Ann Lee"),
        ("Referee Ann Lee", None),
        ("Referee Åsa Lee VAR", None),
    ],
)
def test_referee(spark, text, want):
    assert one(spark, tx.referee_from_text(F.col("c0")), text) == want


def test_formations_and_managers(spark):
    home, away = tx.formations_from_text(F.col("c0"))
    text = "Formation 4-2-3-1 Manager Al B Formation 3-4-3 manager Cy D 9"
    assert (one(spark, home, text), one(spark, away, text)) == ("4-2-3", "3-4-3")
    assert one(spark, tx.formations_from_text(F.col("c0"), whole=True)[0], text) == "4-2-3-1"
    assert one(spark, home, "Formation 4-4-2") is None
    assert one(spark, tx.managers_from_text(F.col("c0"))[1], text) == "Cy D"


def test_labels(spark):
    assert one(spark, tx.strip_label(F.col("c0")), " Referee: Ann ") == "Ann"
    assert one(spark, tx.strip_label(F.col("c0")), " Referee: ") is None
    assert one(spark, tx.leading_number(F.col("c0")), "412 (86%)") == "412"
    assert one(spark, tx.leading_number(F.col("c0")), "x1") == "x1"
    assert one(spark, tx.leading_number(F.col("c0")), "") is None
    assert one(spark, tx.zero_pad(F.col("c0").cast("int")), "138") == "138"


def test_possession_repair(spark):
    pair = F.struct(F.col("c1").alias("home"), F.col("c2").alias("away"))
    repaired = stats.possession_repair(F.col("c0"), pair)
    assert one(spark, repaired, "55%", "Possession", "45%") == "Possession"
    assert one(spark, repaired, "55%", "possession", None) == "55%"
    assert one(spark, repaired, "Passes (%)", "Possession", "1") == "Passes (%)"
