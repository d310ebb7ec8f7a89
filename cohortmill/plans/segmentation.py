"""The complete job: raw events and metadata in, profiled segments and exports out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool
from typing import Literal

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed
from cohortmill.operators import cleaning, entities, features, metadata, profile, sinks, summary
from cohortmill.operators.charts import elbow_series, feature_bars, scatter_rows, share_slices
from cohortmill.functions.geometry import all_usable
from cohortmill.operators.clustering import (
    ROWS_PER_PARTITION,
    SWEEP_PARALLELISM,
    best_k,
    k_sweep,
    knee,
    select_k,
)
from cohortmill.operators.metadata import FANOUT_SALTS
from cohortmill.operators.quality import cross_checks, quality_checks, usable_check
from cohortmill.operators.sampling import plot_sample
from cohortmill.operators.scaling import fit_standardizer, scaled_names, standardize
from cohortmill.operators.scoring import SegmentModel, clustered_table, make_model
from cohortmill.operators.views import density_tiles
from cohortmill.storage import Scratch, materialize

EXPORT_THREADS = 8


@dataclass(frozen=True)
class Settings:
    """Everything a run can vary; the defaults are the published ones."""

    events: cleaning.EventColumns = cleaning.EventColumns()
    metadata: cleaning.MetadataColumns = cleaning.MetadataColumns()
    rules: cleaning.CleaningRules = cleaning.CleaningRules()
    features: tuple[features.Feature, ...] = features.DEFAULT_FEATURES
    duplicates: Literal["first", "keep"] = "first"
    fanout_salts: int = FANOUT_SALTS  # join keys that a repeated metadata key is spread over
    min_popularity: int = fixed.MIN_POPULARITY
    ks: tuple[int, ...] = fixed.SWEEP_K
    k: int | None = None  # None: the K with the best silhouette
    seed: int = fixed.SEED
    max_iterations: int = fixed.MAX_ITERATIONS
    parallelism: int = SWEEP_PARALLELISM  # fits that run at a time
    rows_per_partition: int = ROWS_PER_PARTITION  # of a fit; its starting points follow from it
    unusable: Literal["skip", "error"] = "skip"  # rows with a NULL, NaN or infinite feature
    statistics_accuracy: int = profile.STATISTICS_ACCURACY
    representatives: int = 5
    sample_rows: int = fixed.PLOT_SAMPLE_ROWS
    notable_words: tuple[str, ...] = fixed.NOTABLE_WORDS


@dataclass
class Segmentation:
    """The result tables.  Entity-level ones are lazy reads of tables that ``scratch`` owns.

    Call ``release`` when they are no longer needed.
    """

    model: SegmentModel
    k: int
    totals: DataFrame
    sweep: DataFrame
    scored: DataFrame
    clustered: DataFrame
    sizes: DataFrame
    statistics: DataFrame
    labels: DataFrame
    unusable: DataFrame
    scratch: Scratch

    def release(self) -> None:
        """Remove the intermediate tables; the result tables cannot be read after that."""
        self.scratch.release()


def entity_feature_table(
    events: DataFrame, meta: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Raw events and metadata to the feature table: one event scan, one event shuffle."""
    typed = cleaning.typed_events(events, settings.events, settings.rules)
    per_entity = entities.entity_features(entities.entity_aggregate(typed, settings.rules))
    typed_meta = cleaning.clean_metadata(meta, settings.metadata, settings.rules.key_type)
    if settings.duplicates == "first":
        return features.feature_table(metadata.attach_metadata(per_entity, typed_meta), settings.min_popularity)
    weighted = metadata.attach_metadata(per_entity, typed_meta, "weight", settings.fanout_salts)
    return metadata.unfold(features.feature_table(weighted, settings.min_popularity, (metadata.COPIES,)))


def segment(events: DataFrame, meta: DataFrame, settings: Settings = Settings()) -> Segmentation:
    """Run everything.  The events are read exactly once.

    The audited aggregate is written to shared storage as soon as it exists; the
    row accounting, the feature table and all iterations start from that table,
    so a lost executor never sends the job back to the events.  Entities with an
    unusable feature are counted, and left out or fatal by ``settings.unusable``.
    If the run fails, its intermediate tables are removed.
    """
    if not settings.ks or min(settings.ks) < 2:
        raise ValueError(f"a sweep needs K of 2 and more, not {settings.ks}")
    if settings.k is not None and settings.k not in settings.ks:
        raise ValueError(f"K={settings.k} is not part of the sweep {sorted(settings.ks)}")
    with Scratch(events.sparkSession) as scratch:
        return _segment(events, meta, settings, scratch)


def _segment(events: DataFrame, meta: DataFrame, settings: Settings, scratch: Scratch) -> Segmentation:
    typed = cleaning.typed_events(events, settings.events, settings.rules)
    audited = materialize(
        entities.audited_entity_aggregate(typed, settings.rules), "entity-aggregate", scratch
    )
    per_entity = entities.entity_features(entities.kept_entities(audited))
    # Metadata rows that come back stay one weighted row until the results are unfolded.
    weight = metadata.COPIES if settings.duplicates == "keep" else None
    weights = () if weight is None else (weight,)
    joined = metadata.attach_metadata(
        per_entity,
        cleaning.clean_metadata(meta, settings.metadata, settings.rules.key_type),
        "weight" if weight else "first",
        settings.fanout_salts,
    )
    table = materialize(features.feature_table(joined, settings.min_popularity, weights), "feature-table", scratch)

    names = features.feature_names(settings.features)
    inputs = features.with_features(table, settings.features)
    unusable = materialize(
        inputs.agg(
            F.coalesce(F.sum(F.when(~all_usable(names), F.col(weight) if weight else F.lit(1))), F.lit(0))
            .cast("bigint")
            .alias("unusable_rows")
        ),
        "unusable",
        scratch,
    )
    if settings.unusable == "error" and (n := unusable.first()[0]):
        raise ValueError(f"{n} rows have a feature that is NULL, NaN or infinite")
    scaler = fit_standardizer(inputs, names, weight)
    sweep, centers = k_sweep(
        standardize(inputs, scaler),
        scaled_names(names),
        keys=("app_id", "game_name", "price"),
        ks=settings.ks,
        seed=settings.seed,
        max_iterations=settings.max_iterations,
        parallelism=settings.parallelism,
        rows_per_partition=settings.rows_per_partition,
        weight=weight,
    )
    k = select_k(centers, sweep, settings.k)
    model = make_model(settings.features, scaler.means, scaler.deviations, centers[k])

    scored = materialize(model.score(table, "skip"), "scored-table", scratch)
    if weight:
        scored = metadata.unfold(scored, weight)
    clustered = clustered_table(scored)
    # One row per cluster each: written once, then shared by every later table.
    sizes = materialize(profile.cluster_sizes(clustered), "sizes", scratch).orderBy("cluster_id")
    statistics = materialize(
        profile.cluster_statistics(clustered, accuracy=settings.statistics_accuracy), "statistics", scratch
    ).orderBy("cluster_id")
    return Segmentation(
        model=model,
        k=k,
        totals=entities.audit_totals(audited),
        sweep=sweep,
        scored=scored,
        clustered=clustered,
        sizes=sizes,
        statistics=statistics,
        labels=profile.cluster_labels(statistics),
        unusable=unusable,
        scratch=scratch,
    )


def label_map(labels: DataFrame) -> dict[int, str]:
    """Cluster id to short name; one entry per cluster."""
    return {r["cluster_id"]: fixed.LABEL_TEXTS[r["label"]][1] for r in labels.collect()}


def dashboard_tables(
    clustered: DataFrame,
    statistics: DataFrame,
    sweep: DataFrame,
    labels: DataFrame,
    scored: DataFrame,
    one_row: DataFrame,
    n_representatives: int = 5,
) -> dict[str, DataFrame]:
    """The five sections of the dashboard."""
    return {
        "games": clustered,
        "statistics": statistics,
        "elbow": sweep,
        "cluster_meta": profile.cluster_meta(labels, statistics, scored, n_representatives),
        "model_summary": summary.model_summary(one_row),
    }


def _distinct(settings: Settings) -> tuple[str, ...]:
    """Columns that tell rows of one entity apart, where metadata rows may repeat its key."""
    return ("game_name", "price") if settings.duplicates == "keep" else ()


def export(
    result: Segmentation, folder: str, settings: Settings = Settings(), title: str = "Clustering summary"
) -> DataFrame:
    """Write all result tables, charts tables, report and dashboard; returns (table, rows, path).

    The rows are those that the writing jobs counted.  ``publish`` makes such a set visible at once.
    """
    return sinks.listing(result.scored.sparkSession, _write_all(result, folder, settings, title))


def publish(
    result: Segmentation, folder: str, settings: Settings = Settings(), title: str = "Clustering summary"
) -> DataFrame:
    """Export into a run of its own below ``folder`` and commit its tables together; returns the new manifest."""
    store = sinks.ExportStore(result.scored.sparkSession, folder)
    return store.manifest(store.commit(_write_all(result, store.new_run(), settings, title)))


def _write_all(result: Segmentation, folder: str, settings: Settings, title: str) -> list[sinks.Written]:
    spark: SparkSession = result.scored.sparkSession
    chosen = result.sweep.where(F.col("K") == result.k)
    small = {
        "elbow_cost": result.sweep.orderBy("K"),
        "cluster_sizes": result.sizes,
        "cluster_statistics": result.statistics,
        "cluster_share": profile.cluster_share(result.sizes),
        "cluster_ranks": profile.cluster_ranks(result.statistics),
        "cluster_contrast": profile.cluster_contrast(result.statistics),
        "elbow_series": elbow_series(result.sweep, best_k(result.sweep)),
        "elbow_knee": knee(result.sweep),
        "density_tiles": density_tiles(result.clustered),
        "feature_bars": feature_bars(result.statistics),
        "share_slices": share_slices(profile.cluster_share(result.sizes), result.labels),
        "quality_checks": quality_checks(result.clustered, result.k, settings.min_popularity).unionByName(
            cross_checks(result.clustered, result.sizes, result.sweep, result.k)
        ).unionByName(usable_check(result.unusable)),
    }
    labelled = profile.with_labels(result.clustered, label_map(result.labels))
    large = {
        "clustered_games": result.clustered,
        "plot_sample": plot_sample(
            result.clustered, settings.sample_rows, settings.seed, distinct=_distinct(settings)
        ),
        "scatter_rows": scatter_rows(labelled, words=settings.notable_words),
    }
    one_row = summary.metrics_summary(
        result.totals,
        result.sizes,
        result.k,
        chosen.select("WSSSE_Cost").scalar(),
        chosen.select("Silhouette_Score").scalar(),
        settings.features,
    )
    report = summary.report_lines(one_row, result.sizes, result.statistics, title, settings.features)
    dashboard = dashboard_tables(
        result.clustered, result.statistics, result.sweep, result.labels, result.scored, one_row,
        settings.representatives,
    )
    def table(write, name: str, df: DataFrame, *single_file: bool) -> sinks.Written:
        path = f"{folder}/{name}"
        return sinks.Written(name, write(df, path, *single_file), path)

    writes = [partial(table, sinks.write_csv, name, t) for name, t in large.items()]
    writes += [partial(table, sinks.write_csv, name, t, True) for name, t in small.items()]
    writes += [
        partial(table, sinks.write_json_lines, f"dashboard/{name}", t, name != "games") for name, t in dashboard.items()
    ]
    writes.append(partial(sinks.write_lines, report, f"{folder}/metrics_summary"))
    writes.append(partial(result.model.save, spark, f"{folder}/model"))
    # Most of these jobs have one short task; side by side they fill the cluster.
    with ThreadPool(EXPORT_THREADS) as pool:
        done = pool.map(inheritable_thread_target(spark)(lambda write: write()), writes, 1)
    return sorted((w for w in done if w is not None), key=lambda w: w.table)
