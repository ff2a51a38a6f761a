"""Every cleaning rule on hand-written input: normal, missing, malformed and non-ASCII."""

import pytest
from pyspark.sql import functions as F

from squadlake import functions as rule

MARKET_VALUES = [
    ("€600k", 600_000),
    ("€45.00m", 45_000_000),
    ("€2.01m", 2_010_000),
    ("€1.15m", 1_150_000),
    ("€3000m", 3_000_000_000),
    (" €1.5K ", 1_500),
    ("\u00a0€7m\u2003", 7_000_000),
    ("1km", 1_000),
    ("750", 750),
    ("1.9", 1),
    ("0", 0),
    ("", 0),
    (None, 0),
    ("€", None),
    (" ", None),
    ("-", None),
    ("€1.20bn", None),
    ("€99999999999999m", None),
    ("€123456789012345678m", None),
]

HEIGHTS = [
    ("1,85m", 185),
    ("1,80 m", 180),
    ("185", 185),
    ("1.85m", None),
    ("1,8m", None),
    ("m", None),
    ("", None),
    (None, None),
]

AGES = [("24", 24), (" 19 ", 19), ("19.5", None), ("n/a", None), ("", None), (None, None)]

CLUBS = [
    ("Real: Ablöse €1m", "Real"),
    (" Ajax ", "Ajax"),
    ("\u00a0Ajax\u3000: x", "Ajax"),
    ("A: b: c", "A"),
    (":x", "No team"),
    (" : x", "No team"),
    (" ", "No team"),
    ("", "No team"),
    (None, "No team"),
    ("Besiktas Istanbul", "Besiktas Istanbul"),
]

ORIGINS = [("Ajax", "Ajax"), (" ", " "), ("", "None"), (None, "None")]

STATUSES = [
    (None, "Available to play"),
    ("", "Available to play"),
    ("Team captain", "Available to play"),
    ("TEAM CAPTAIN", "Available to play"),
    ("available to play", "Available to play"),
    ("Injury, team captain", "Injuried"),
    ("Calf", "Injuried"),
    (" ", "Injuried"),
]

CAPITALS = [
    ("right", "Right"),
    ("LEFT", "Left"),
    ("both FEET", "Both feet"),
    ("éCLAIR", "Éclair"),
    ("x", "X"),
    ("9 LIVES", "9 lives"),
    ("", None),
    (None, None),
]

TEAMS = [
    ("Harbour_FC", "Harbour", "Harbour"),
    ("FC_Quay", "Quay", "Quay"),
    ("AFC_Mill", "AFC Mill", "AMill"),
    ("X_FC_Y", "X Y", "X Y"),
    ("North_Vale", "North Vale", "North Vale"),
    ("Salt & Sand", "Salt & Sand", "Salt & Sand"),
    ("Harbour FC", "Harbour", "Harbour"),
    (None, None, None),
]

NATIONALITIES = [
    (["X", "Y", "Z"], "X", "Y"),
    (["X", "Y"], "X", "Y"),
    (["X"], "X", "None"),
    ([], "None", "None"),
    ([None, "Y"], "None", "Y"),
    (None, "None", "None"),
]

BANDS = [
    (18, "Under 20"), (19, "Under 20"), (20, "20-23"), (23, "20-23"), (24, "24-27"),
    (27, "24-27"), (28, "28-31"), (31, "28-31"), (32, "Over 31"), (None, "Over 31"),
]


@pytest.mark.parametrize(
    ("clean", "cases"),
    [
        (rule.parse_market_value, MARKET_VALUES),
        (rule.parse_height, HEIGHTS),
        (rule.parse_age, AGES),
        (rule.clean_club_name, CLUBS),
        (rule.fill_signed_from, ORIGINS),
        (rule.clean_status, STATUSES),
        (rule.capitalize_first, CAPITALS),
    ],
    ids=lambda value: getattr(value, "__name__", ""),
)
def test_text_rule(spark, clean, cases):
    rows = [(i, text) for i, (text, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, text string").select("i", clean("text").alias("out"))
    got = dict(df.collect())
    assert [(text, got[i]) for i, text in rows] == cases


def test_clean_names_and_labels_need_no_second_rule(spark):
    """What silver leaves out: these compositions change nothing."""
    texts = sorted({text for text, _ in CLUBS + STATUSES}, key=str)
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    club, status = rule.clean_club_name("t"), rule.clean_status("t")
    changed = (club != rule.fill_signed_from(club)) | (status != rule.capitalize_first(status))
    assert df.where(changed).isEmpty()


def test_market_value_is_bigint_and_height_is_int(spark):
    df = spark.sql("select '1k' as v").select(
        rule.parse_market_value("v").alias("m"), rule.parse_height("v").alias("h")
    )
    assert dict(df.dtypes) == {"m": "bigint", "h": "int"}


def test_team_names_in_both_modes(spark):
    df = spark.createDataFrame([(t[0],) for t in TEAMS], "raw string").select(
        "raw",
        rule.normalize_team_name("raw"),
        rule.normalize_team_name("raw", mode="substring"),
    )
    assert sorted(map(tuple, df.collect()), key=str) == sorted(TEAMS, key=str)
    with pytest.raises(ValueError, match="unknown mode"):
        rule.normalize_team_name("raw", mode="other")


def test_first_and_second_nationality(spark):
    rows = [(n[0],) for n in NATIONALITIES]
    df = spark.createDataFrame(rows, "n array<string>").select(
        "n", rule.nth_or_default("n", 1), rule.nth_or_default("n", 2)
    )
    assert sorted(map(tuple, df.collect()), key=str) == sorted(NATIONALITIES, key=str)


def test_default_status_only_replaces_null(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "s string")
    got = {row[0] for row in df.select(rule.default_status("s")).collect()}
    assert got == {"available to play", "", "x"}


def test_age_bands(spark):
    df = spark.createDataFrame([(a,) for a, _ in BANDS], "age int")
    got = df.select("age", rule.age_band("age")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(BANDS, key=str)
    unknown = df.where("age is null").select(rule.age_band("age", null_label="Unknown"))
    assert unknown.first()[0] == "Unknown"


def test_open_ended_bands_and_their_order(spark):
    bands = (("low", None, 9), ("high", 20, None))
    df = spark.createDataFrame([(5,), (15,), (25,)], "v int").select(
        "v", rule.band("v", bands, "middle").alias("b")
    )
    got = {r.v: (r.b, r.o) for r in df.withColumn("o", rule.band_order("b", bands)).collect()}
    assert got == {5: ("low", 1), 15: ("middle", 3), 25: ("high", 2)}


def test_growth_of_zero_or_missing_base_is_null(spark):
    df = spark.createDataFrame([(150, 100), (5, 0), (5, None), (None, 5)], "a int, b int")
    got = [row[0] for row in df.select(rule.growth_percent("a", "b")).collect()]
    assert got == [50.0, None, None, None]


def test_pearson_on_plain_and_degenerate_groups(spark):
    rows = [
        ("line", 1.0, 2.0), ("line", 2.0, 4.0), ("line", 3.0, 6.0), ("line", None, 99.0),
        ("down", 1.0, 3.0), ("down", 2.0, 2.0), ("down", 3.0, 1.0),
        ("one", 1.0, 1.0), ("flat", 5.0, 1.0), ("flat", 5.0, 2.0), ("none", None, None),
    ]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = dict(df.groupBy("g").agg(rule.pearson("x", "y")).collect())
    assert got["line"] == pytest.approx(1) and got["down"] == pytest.approx(-1)
    assert (got["one"], got["flat"], got["none"]) == (None, None, None)


def test_keys_from_paths(spark):
    cases = [
        ("file:/d/Season_2010/Harbour_FC_11_2010.json", "Harbour_FC", 2010),
        ("s3a://b/x_1/Season_1999/Salt%20%26%20Sand_3_1999.json", "Salt & Sand", 1999),
        ("/d/Season_2001/A+B_3_2001.json", "A+B", 2001),
        ("/d/Season_2001/Nodigits.json", "Nodigits.json", 2001),
        ("/d/other/Harbour_3_2001.json", "Harbour", None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "path string")
    path = rule.decode_path("path")
    got = df.select(
        "path", rule.team_from_file_name(rule.file_name_of(path)), rule.season_from_path(path)
    )
    assert [tuple(row) for row in got.collect()] == cases


def test_white_space_is_every_white_space_character():
    from squadlake.fixed_values import WHITESPACE

    assert sorted(WHITESPACE) == [c for c in map(chr, range(0x110000)) if c.isspace()]


def test_rules_use_no_python_worker(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("t"))
    plan = df.select(
        rule.parse_market_value("t"),
        rule.parse_height("t"),
        rule.clean_club_name("t"),
        rule.clean_status("t"),
        rule.capitalize_first("t"),
        rule.normalize_team_name("t"),
    )._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_marks_of_any_case_scale_a_market_value(spark):
    texts = ["€1.5K", "€1.5k", "1.5\u212a", "€2M", "2m", "2Mk", "1E3", "\u2003€7k\u00a0"]
    found = spark.createDataFrame([(t,) for t in texts], "v string").select(
        "v", rule.parse_market_value("v").alias("m")
    )
    assert {row["v"]: row["m"] for row in found.collect()} == dict(
        zip(texts, [1500, 1500, 1500, 2_000_000, 2_000_000, 2000, 1000, 7000])
    )


def test_team_names_of_nothing_but_the_suffix_stay(spark):
    names = spark.createDataFrame([(n,) for n in ["FC", "_FC_", "FC_X", "", None]], "raw string")
    for mode in ("token", "substring"):
        found = names.select("raw", rule.normalize_team_name("raw", mode).alias("name")).collect()
        assert {row["raw"]: row["name"] for row in found} == {
            "FC": "FC", "_FC_": "_FC_", "FC_X": "X", "": "", None: None
        }
