"""Quantile sketches of the entity aggregate: merged runs, stated errors, hard rows."""

import random

import pytest
from pyspark.sql import functions as F

from cohortmill.functions.sketches import quantile, rank_error
from cohortmill.operators import entities
from cohortmill.operators.cleaning import CleaningRules

SCHEMA = "app_id int, app_name string, is_recommended int, playtime_forever double"
RULES = CleaningRules(measure_max=1000.0)


def lower_median(values):
    return sorted(values)[(len(values) - 1) // 2]


def rows_of(seed, n=4000):
    pick = random.Random(seed)
    out = []
    for _ in range(n):
        key = pick.choice([None, 1, 1, 1, *range(2, 40)])
        measure = pick.choice([None, float("nan"), -1.0, 5000.0, *[float(pick.randint(0, 1000)) for _ in range(9)]])
        out.append((key, pick.choice([None, "a", "b"]), pick.randint(0, 1), measure))
    return out


def usable(row):
    return row[0] is not None and row[3] is not None and 0 <= row[3] <= 1000


def test_median_comes_with_the_counts(spark):
    rows = rows_of(1)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.app_id: r for r in entities.audited_entity_aggregate(table, RULES, 5000).collect()}
    assert set(got) == {r[0] for r in rows}
    for key, row in got.items():
        valid = [r[3] for r in rows if r[0] == key and usable(r)]
        assert row.raw_reviews == sum(r[0] == key for r in rows) and row.total_reviews == len(valid)
        assert row.median_playtime_minutes == (lower_median(valid) if valid else None)
    assert "median_playtime_minutes" not in entities.audited_entity_aggregate(table, RULES).columns


def test_runs_merge_without_events(spark):
    """States of three runs, one of them empty, equal the states of one run over everything."""
    rows = rows_of(2)
    table = lambda part: spark.createDataFrame(part, SCHEMA)
    runs = [entities.entity_states(table(p), RULES, 5000) for p in (rows[:700], rows[700:], [])]
    merged = entities.finished_states(entities.merge_states(runs, 5000))
    whole = entities.audited_entity_aggregate(table(rows), RULES, 5000)
    assert merged.schema == whole.schema
    key = lambda r: (r.app_id is not None, r.app_id)
    assert sorted(merged.collect(), key=key) == sorted(whole.collect(), key=key)
    again = entities.merge_states([entities.merge_states(runs[:2], 5000), runs[2]], 5000)
    assert sorted(entities.finished_states(again).collect(), key=key) == sorted(whole.collect(), key=key)


@pytest.mark.parametrize("parts", [1, 6])
def test_rank_error_of_a_hot_entity(spark, parts):
    """An entity far beyond the sketch size: the rank of its median is off by the stated share at most."""
    n, size = 60_000, 200
    events = spark.range(n).select(
        F.lit(1).alias("app_id"), F.lit("x").alias("app_name"), F.lit(1).alias("is_recommended"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("playtime_forever"),
    ).repartition(parts)
    median = entities.entity_medians(events, size, RULES).first()[1]
    values = [r[0] for r in events.select("playtime_forever").collect()]
    low, high = sum(v < median for v in values) / n, sum(v <= median for v in values) / n
    assert low - rank_error(size) <= 0.5 <= high + rank_error(size)


def test_quantiles_of_small_and_empty_sketches(spark):
    rows = spark.createDataFrame([(1, 5.0), (1, 1.0), (1, 3.0), (1, 3.0), (2, None)], "k int, v double")
    sketched = rows.groupBy("k").agg(F.kll_sketch_agg_double("v", 100).alias("s"))
    got = sketched.select("k", quantile("s", 0.5), quantile("s", 1.0))
    assert sorted(map(tuple, got.collect())) == [(1, 3.0, 5.0), (2, None, None)]


def test_no_events(spark):
    assert entities.entity_medians(spark.createDataFrame([], SCHEMA)).collect() == []
