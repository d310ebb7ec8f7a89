import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortmill.functions.scalars import contains_any, int_key, log_scale, number
from cohortmill.operators import cleaning

EVENT_COLUMNS = "app_id string, app_name string, recommended string, `author.playtime_forever` string"

DIRTY = [
    ("7", "a", "True", "0"),
    (" 7 ", "a", "TRUE", "600000"),
    ("7", "a", "false", "600000.1"),
    ("7", "a", "yes", "-1"),
    ("7", "a", None, "12.5"),
    ("x", "a", "True", "1"),
    ("", "a", "True", "1"),
    ("12.5", "a", "True", "1"),
    ("3000000000", "a", "True", "1"),
    (None, "a", "True", "1"),
    ("8", "b", "true", "NaN"),
    ("8", "b", "true", "Infinity"),
    ("8", "b", "true", ""),
    ("8", "b", "true", None),
    ("8", "b", "true", "n/a"),
]


def events(spark, rows=DIRTY):
    return spark.createDataFrame(rows, EVENT_COLUMNS)


def test_keys_flags_and_measures(spark):
    kept = cleaning.clean_events(events(spark)).select(
        "app_id", "is_recommended", "playtime_forever"
    )
    assert sorted(map(tuple, kept.collect())) == [(7, 0, 12.5), (7, 1, 0.0), (7, 1, 600000.0)]


def test_flag_is_total(spark):
    typed = cleaning.typed_events(events(spark))
    assert typed.where(F.col("is_recommended").isNull()).count() == 0
    assert typed.where("app_id = 7 and is_recommended = 0").count() == 3


def test_rejects_add_up(spark):
    rows = {r["rule"]: r["rows"] for r in cleaning.rejects_by_rule(events(spark)).collect()}
    assert rows == {
        "raw_rows": 15,
        "invalid_key": 5,
        "missing_measure": 4,
        "measure_too_small": 1,
        "measure_too_large": 2,
        "kept_rows": 3,
    }


def test_typed_input_needs_no_text(spark):
    typed = spark.createDataFrame(
        [(7, "a", "True", 3.0), (None, "a", "True", 3.0)],
        "app_id int, app_name string, recommended string, `author.playtime_forever` double",
    )
    assert [tuple(r) for r in cleaning.clean_events(typed).collect()] == [(7, "a", 1, 3.0)]


def test_metadata(spark):
    raw = spark.createDataFrame(
        [("1", "one", "9.99"), ("2", None, ""), ("x", "bad", "1"), ("3", "three", "free")],
        "appid string, name string, price string",
    )
    assert sorted(map(tuple, cleaning.clean_metadata(raw).collect())) == [
        (1, "one", 9.99),
        (2, None, None),
        (3, "three", None),
    ]


PIECES = st.sampled_from(
    ["", " ", "\t", "\n", "\x00", "\x1f", "\x7f", " ", "+", "-", ".", "0", "7", "12", "999999999999",
     "e3", "E-2", "d", "F", "nan", "NaN", "inf", "Infinity", "-INF", "0x1p3", "abc", "é", "٣", "/"]
)
TEXTS = st.lists(PIECES, max_size=4).map("".join) | st.text(max_size=6)


def same(a, b):
    if a is None or b is None:
        return a is b
    return a == b or (math.isnan(a) and math.isnan(b))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXTS.filter(lambda t: not any(0xD800 <= ord(c) <= 0xDFFF for c in t)), min_size=80, max_size=200))
def test_guarded_casts_equal_plain_casts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t",
        int_key(F.col("t")).alias("guarded_int"),
        F.col("t").try_cast("int").alias("plain_int"),
        number(F.col("t")).alias("guarded_double"),
        F.col("t").try_cast("double").alias("plain_double"),
    )
    for row in df.collect():
        assert same(row["guarded_int"], row["plain_int"]), repr(row)
        assert same(row["guarded_double"], row["plain_double"]), repr(row)


def test_log_scale_floor(spark):
    row = spark.range(1).select(
        log_scale(F.lit(-5.0), floor=0.0).alias("lifted"),
        log_scale(F.lit(-5.0)).alias("null"),
        log_scale(F.lit(math.e - 1)).alias("one"),
    ).first()
    assert row["lifted"] == 0.0 and row["null"] is None and abs(row["one"] - 1) < 1e-12


def test_keyword_inside_a_longer_title(spark):
    titles = spark.createDataFrame([("The WOLF Among Us",), ("Among",), (None,)], "t string")
    hits = [r[0] for r in titles.select(contains_any(F.col("t"), ["among us"])).collect()]
    assert hits == [True, False, False]


def test_key_type(spark):
    """Keys beyond the integer range stay where the rules ask for long keys."""
    raw = spark.createDataFrame([("3000000000", "n", "True", "5")], "app_id string, app_name string, recommended string, `author.playtime_forever` string")
    assert cleaning.clean_events(raw).count() == 0
    assert cleaning.clean_events(raw, rules=cleaning.CleaningRules(key_type="bigint")).first()["app_id"] == 3_000_000_000
    meta = spark.createDataFrame([("3000000000", "n", "1")], "appid string, name string, price string")
    assert cleaning.clean_metadata(meta).count() == 0 and cleaning.clean_metadata(meta, key_type="bigint").count() == 1
