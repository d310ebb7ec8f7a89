"""Events to one row per entity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed
from cohortmill.functions.sketches import quantile
from cohortmill.operators.cleaning import CleaningRules, has_key, has_measure


def entity_states(
    typed: DataFrame, rules: CleaningRules = CleaningRules(), sketch_size: int | None = None
) -> DataFrame:
    """Per entity what later runs can add to: counts, sums, the smallest name and a sketch of the measure.

    Takes ``typed_events``; the cleaning rules are conditions inside the aggregate,
    so each cast runs once per row and one scan serves results and accounting.
    Rows without a key form the entity whose key is NULL.  The counts are ordinary
    aggregate columns, so a task that runs twice after a lost executor does not
    count twice.

    Two steps: first per (key, name), where the name is a grouping column and the
    buffers are plain numbers, so event rows go through a hash aggregate that
    combines on the map side; then per key, where only the few distinct names of
    an entity are left.  A hot key is thereby reduced before any shuffle, and a
    string buffer, which would sort all events, never meets event-level data.

    With ``sketch_size`` both steps carry a quantile sketch of the valid measures.  It holds all
    values up to about that many and a bounded number beyond, see ``sketches.rank_error``.
    """
    kept = has_key() & has_measure(rules)
    measure = F.when(kept, F.col("playtime_forever"))
    sketch = [] if sketch_size is None else [F.kll_sketch_agg_double(measure, sketch_size).alias("measure_sketch")]
    by_name = typed.groupBy("app_id", "app_name").agg(
        F.count(F.lit(1)).alias("raw_reviews"),
        F.count_if(kept).alias("total_reviews"),
        F.sum(F.when(kept, F.col("is_recommended"))).alias("positive_reviews"),
        F.sum(measure).alias("minutes"),
        *sketch,
    )
    named = F.when(F.col("total_reviews") > 0, F.col("app_name"))
    return _merged(by_name.withColumn("review_app_name", named), sketch_size)


def merge_states(states: Sequence[DataFrame], sketch_size: int | None = None) -> DataFrame:
    """The states of several runs over different events as those of one run; reads no event."""
    return _merged(reduce(DataFrame.unionByName, states), sketch_size)


def _merged(parts: DataFrame, sketch_size: int | None) -> DataFrame:
    sketch = [] if sketch_size is None else [F.kll_merge_agg_double("measure_sketch", sketch_size).alias("measure_sketch")]
    return parts.groupBy("app_id").agg(
        F.min("review_app_name").alias("review_app_name"),
        F.sum("raw_reviews").alias("raw_reviews"),
        F.sum("total_reviews").alias("total_reviews"),
        F.coalesce(F.sum("positive_reviews"), F.lit(0)).alias("positive_reviews"),
        F.sum("minutes").alias("minutes"),
        *sketch,
    )


def finished_states(states: DataFrame) -> DataFrame:
    """Positive share and mean measure of each state, and the median where it has a sketch."""
    finished = _with_ratios(states)
    if "measure_sketch" not in states.columns:
        return finished
    return finished.withColumn("median_playtime_minutes", quantile("measure_sketch", 0.5)).drop("measure_sketch")


def audited_entity_aggregate(
    typed: DataFrame, rules: CleaningRules = CleaningRules(), sketch_size: int | None = None
) -> DataFrame:
    """Per entity: counts, positive share, mean measure, how many raw rows it had, and on demand the median."""
    return finished_states(entity_states(typed, rules, sketch_size))


def kept_entities(audited: DataFrame) -> DataFrame:
    """Entities with at least one valid event, without the accounting.

    Valid events have a key.  Testing the key here as well would only push that
    test, and with it a second evaluation of the cast, down to the event rows.
    """
    return audited.where(F.col("total_reviews") > 0).drop("raw_reviews")


def entity_aggregate(events: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Counts, positive share and mean measure per entity, over valid events only.

    Takes typed or cleaned events.
    """
    return kept_entities(audited_entity_aggregate(events, rules))


def _with_ratios(per_key: DataFrame) -> DataFrame:
    total = F.col("total_reviews")
    filled = F.nullif(total, F.lit(0))
    return per_key.withColumns(
        {
            "rating_percent": F.col("positive_reviews") / filled * 100.0,
            "avg_playtime_minutes": F.col("minutes") / filled,
        }
    ).drop("minutes")


def audit_totals(audited: DataFrame) -> DataFrame:
    """One row: raw, keyless, out-of-range and kept events, and entities."""
    keyed = has_key()
    raw, kept = F.col("raw_reviews"), F.col("total_reviews")
    return audited.agg(
        F.coalesce(F.sum(raw), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.when(~keyed, raw)), F.lit(0)).alias("invalid_key"),
        F.coalesce(F.sum(F.when(keyed, raw - kept)), F.lit(0)).alias("invalid_measure"),
        F.coalesce(F.sum(F.when(keyed, kept)), F.lit(0)).alias("kept_rows"),
        F.count_if(keyed & (kept > 0)).alias("entities"),
    )


def entity_medians(
    events: DataFrame,
    sketch_size: int = fixed.ENTITY_MEDIAN_ACCURACY,
    rules: CleaningRules = CleaningRules(),
) -> DataFrame:
    """Lower median of the measure per entity, from the same scan and shuffle as its counts.

    Takes typed or cleaned events.  Exact up to about ``sketch_size`` events of an entity; beyond,
    its rank is off by ``sketches.rank_error(sketch_size)`` at most, in 99 of 100 cases.
    """
    medians = kept_entities(audited_entity_aggregate(events, rules, sketch_size))
    return medians.select("app_id", "median_playtime_minutes")


def hours(minutes: Column) -> Column:
    """Mean minutes to hours; the inner rounding settles bits that depend on row order."""
    return F.round(F.round(minutes, 9) / fixed.MINUTES_PER_HOUR, 2)


def entity_features(aggregate: DataFrame) -> DataFrame:
    """Adds mean hours and the popularity proxy to the entity aggregate."""
    return aggregate.withColumns(
        {
            "playtime_hours": hours(F.col("avg_playtime_minutes")),
            "popularity": F.col("total_reviews"),
        }
    )
