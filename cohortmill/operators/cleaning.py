"""Typing and filtering of raw event and metadata rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed
from cohortmill.functions.scalars import int_key, is_text, named, number, truth_flag


@dataclass(frozen=True)
class EventColumns:
    """Where to find the four event fields in a raw table."""

    key: str = fixed.EVENT_KEY
    name: str = fixed.EVENT_NAME
    flag: str = fixed.EVENT_FLAG
    measure: str = fixed.EVENT_MEASURE


@dataclass(frozen=True)
class MetadataColumns:
    """Where to find the three metadata fields in a raw table."""

    key: str = fixed.METADATA_KEY
    name: str = fixed.METADATA_NAME
    price: str = fixed.METADATA_PRICE


@dataclass(frozen=True)
class CleaningRules:
    true_word: str = fixed.TRUE_WORD
    measure_min: float = fixed.MIN_MEASURE_MINUTES
    measure_max: float = fixed.MAX_MEASURE_MINUTES
    key_type: str = "int"  # "bigint" keeps keys beyond 2^31 - 1


def typed_events(
    raw: DataFrame,
    columns: EventColumns = EventColumns(),
    rules: CleaningRules = CleaningRules(),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Tolerantly cast events; rows that fail a cast carry NULL and are still present.

    Raw columns in ``keep`` travel along as they are.
    """
    return raw.select(
        int_key(named(columns.key), is_text(raw, columns.key), rules.key_type).alias("app_id"),
        named(columns.name).alias("app_name"),
        truth_flag(named(columns.flag), rules.true_word).alias("is_recommended"),
        number(named(columns.measure), is_text(raw, columns.measure)).alias("playtime_forever"),
        *[named(c) for c in keep],
    )


def has_key() -> Column:
    return F.col("app_id").isNotNull()


def has_measure(rules: CleaningRules = CleaningRules()) -> Column:
    """Never NULL; NaN and infinities lie outside every finite range."""
    in_range = F.col("playtime_forever").between(rules.measure_min, rules.measure_max)
    return F.coalesce(in_range, F.lit(False))


def _cast_once(typed: DataFrame) -> DataFrame:
    """The same rows, with every cast evaluated a single time.

    A filter on a projected column is pushed below the projection, where the cast
    runs again for every mention of the column.  Filters stay above a generator.
    """
    return typed.select(F.inline(F.array(F.struct(*typed.columns))))


def keyed_events(
    raw: DataFrame,
    columns: EventColumns = EventColumns(),
    rules: CleaningRules = CleaningRules(),
) -> DataFrame:
    """Only events with an integer key."""
    return _cast_once(typed_events(raw, columns, rules)).where(has_key())


def clean_events(
    raw: DataFrame,
    columns: EventColumns = EventColumns(),
    rules: CleaningRules = CleaningRules(),
) -> DataFrame:
    """Only events with an integer key and a measure inside the inclusive range."""
    return _cast_once(typed_events(raw, columns, rules)).where(has_key() & has_measure(rules))


def clean_metadata(
    raw: DataFrame, columns: MetadataColumns = MetadataColumns(), key_type: str = "int"
) -> DataFrame:
    """Typed metadata rows that have an integer key; keys may repeat."""
    typed = raw.select(
        int_key(named(columns.key), is_text(raw, columns.key), key_type).alias("meta_appid"),
        named(columns.name).alias("meta_game_name"),
        number(named(columns.price), is_text(raw, columns.price)).alias("meta_price"),
    )
    return _cast_once(typed).where(F.col("meta_appid").isNotNull())


def rejects_by_rule(
    raw: DataFrame,
    columns: EventColumns = EventColumns(),
    rules: CleaningRules = CleaningRules(),
) -> DataFrame:
    """(rule, rows): how many events each cleaning rule turns away, in one scan.

    The reject rules are exclusive: a row without a key is counted there only, and
    the kept rows and all rejects add up to the raw rows.
    """
    measure = F.col("playtime_forever")
    missing = measure.isNull() | F.isnan(measure)
    keyed = has_key()
    counts = typed_events(raw, columns, rules).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~keyed).alias("invalid_key"),
        F.count_if(keyed & missing).alias("missing_measure"),
        F.count_if(keyed & ~missing & (measure < rules.measure_min)).alias("measure_too_small"),
        F.count_if(keyed & ~missing & (measure > rules.measure_max)).alias("measure_too_large"),
        F.count_if(keyed & has_measure(rules)).alias("kept_rows"),
    )
    return counts.unpivot([], counts.columns, "rule", "rows")
