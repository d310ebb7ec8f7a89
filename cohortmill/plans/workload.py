"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed
from cohortmill.operators import cleaning, entities, metadata, profile, sinks, summary
from cohortmill.operators.charts import (
    elbow_series,
    feature_bars,
    notable_entities,
    scatter_rows,
    share_slices,
)
from cohortmill.operators.clustering import (
    as_vectors,
    best_k,
    center_lists,
    fit_ml_stages,
    k_sweep,
    kmeans,
    knee,
    stable_layout,
)
from cohortmill.operators.drift import column_sketches, drift, merged_sketches
from cohortmill.operators.evaluation import assign, fit_checks, silhouette, sweep_scores, wssse
from cohortmill.operators.features import feature_names, with_features
from cohortmill.operators.features import feature_table as feature_rows
from cohortmill.operators.quality import column_profile, quality_checks
from cohortmill.operators.refits import adjusted_rand_index, contingency, keep_ids
from cohortmill.operators.sampling import plot_sample, preview
from cohortmill.operators.scaling import (
    fit_standardizer,
    ml_standardize,
    scaled_names,
    scaler_params,
    standardize,
)
from cohortmill.operators.scoring import SegmentModel, clustered_table, make_model
from cohortmill.operators.uncertainty import (
    gap_statistic,
    mean_intervals,
    model_costs,
    ratio_intervals,
    replicate_means,
    uniform_draw,
)
from cohortmill.operators.views import density_tiles as tiles
from cohortmill.operators.views import principal_axes, projected
from cohortmill.operators.words import containing_any
from cohortmill.plans import bindings
from cohortmill.plans.segmentation import (
    Settings,
    dashboard_tables,
    entity_feature_table,
    export,
    segment,
)
from cohortmill.sources.multiline import read_multiline_csv
from cohortmill.sources.tables import (
    CLUSTERED_SCHEMA,
    GAP_SCHEMA,
    SIZES_SCHEMA,
    STATISTICS_SCHEMA,
    SWEEP_SCHEMA,
    read_csv_by_header,
    read_result_csv,
    read_table,
)
from cohortmill.storage import materialize, scratch_path
from cohortmill.streaming.entities import (
    current_scores,
    current_states,
    read_event_stream,
    running_states,
    scored_changes,
    state_features,
    write_states,
)
from cohortmill.streaming.scoring import read_feature_stream, score_rows, write_scored

Query = Callable[[SparkSession, str], DataFrame]

LINES = bindings.LINE_SETTINGS
USERS = bindings.USER_SETTINGS
NAMES = feature_names(LINES.features)
SCALED = scaled_names(NAMES)
KEYS = ("app_id", "game_name", "price")

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- shared steps ---------------------------------------------------------------


def typed_lines(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.typed_events(bindings.line_events(spark, folder), LINES.events, LINES.rules)


def clean_lines(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_events(bindings.line_events(spark, folder), LINES.events, LINES.rules)


def line_features(spark: SparkSession, folder: str) -> DataFrame:
    return entity_feature_table(
        bindings.line_events(spark, folder), bindings.part_metadata(spark, folder), LINES
    )


def user_feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    return entity_feature_table(
        bindings.user_events(spark, folder), bindings.customer_metadata(spark, folder), USERS
    )


def fixed_model(table: DataFrame, settings: Settings, centers) -> SegmentModel:
    """Scaler fitted on the table, centers given."""
    names = feature_names(settings.features)
    scaler = fit_standardizer(with_features(table, settings.features), names)
    return make_model(settings.features, scaler.means, scaler.deviations, centers)


def scored_lines(spark: SparkSession, folder: str) -> DataFrame:
    table = materialize(line_features(spark, folder), "feature-table")
    return fixed_model(table, LINES, bindings.LINE_CENTERS).score(table)


def clustered_lines(spark: SparkSession, folder: str) -> DataFrame:
    return clustered_table(scored_lines(spark, folder))


def line_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return profile.cluster_statistics(
        clustered_lines(spark, folder), accuracy=LINES.statistics_accuracy
    )


def scaled_lines(spark: SparkSession, folder: str) -> DataFrame:
    table = materialize(with_features(line_features(spark, folder)), "feature-table")
    return standardize(table, fit_standardizer(table, NAMES))


# --- sources --------------------------------------------------------------------


@query
def csv_scan_events(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "events-csv")
    sinks.write_csv(bindings.line_events(spark, folder), path)
    return read_csv_by_header(spark, path).withColumnRenamed(
        "author.playtime_forever", "playtime_text"
    )


@query
def csv_scan_metadata(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "metadata-csv")
    text = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"\n '), "p_type", F.lit(" "))
    raw = read_table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("appid"),
        text.alias("name"),
        F.col("p_retailprice").cast("string").alias("price"),
    )
    sinks.write_csv(raw, path)
    return read_csv_by_header(spark, path, multiline=True)


@query
def csv_text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "text-csv")
    documents = read_table(spark, folder, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"), "text"
    )
    turns = read_table(spark, folder, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text"
    )
    sinks.write_csv(documents.unionByName(turns), path)
    return read_csv_by_header(spark, path, multiline=True)


@query
def csv_text_parallel(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks in one CSV file, or in some of bounded size, read by as many tasks as they have splits."""
    path = scratch_path(spark, "one-csv")
    documents = read_table(spark, folder, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    turns = read_table(spark, folder, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text"
    )
    texts = documents.unionByName(turns)
    sinks.write_csv(texts, path, files=sinks.few_files(texts))
    return read_multiline_csv(spark, path)


@query
def export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clustered-csv")
    sinks.write_csv(clustered_lines(spark, folder), path)
    return read_result_csv(spark, path, CLUSTERED_SCHEMA)


@query
def raw_count(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.line_events(spark, folder).agg(F.count(F.lit(1)).alias("raw_rows"))


@query
def entity_count(spark: SparkSession, folder: str) -> DataFrame:
    return line_features(spark, folder).agg(F.count(F.lit(1)).alias("entities"))


@query
def schema_listing(spark: SparkSession, folder: str) -> DataFrame:
    return column_profile(bindings.line_events(spark, folder))


# --- cleaning -------------------------------------------------------------------


@query
def clean_key(spark: SparkSession, folder: str) -> DataFrame:
    raw = bindings.line_events(spark, folder)
    return cleaning.keyed_events(raw, LINES.events, LINES.rules).select("app_id", "app_name")


@query
def clean_flag(spark: SparkSession, folder: str) -> DataFrame:
    return typed_lines(spark, folder).select("app_id", "app_name", "is_recommended")


@query
def clean_measure(spark: SparkSession, folder: str) -> DataFrame:
    return clean_lines(spark, folder)


@query
def clean_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_metadata(bindings.part_metadata(spark, folder), LINES.metadata)


@query
def rejects_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.rejects_by_rule(
        bindings.line_events(spark, folder), LINES.events, LINES.rules
    )


@query
def audit_totals(spark: SparkSession, folder: str) -> DataFrame:
    typed = typed_lines(spark, folder)
    return entities.audit_totals(entities.audited_entity_aggregate(typed, LINES.rules))


# --- entities -------------------------------------------------------------------


@query
def entity_agg(spark: SparkSession, folder: str) -> DataFrame:
    return entities.entity_aggregate(typed_lines(spark, folder), LINES.rules)


@query
def entity_agg_audited(spark: SparkSession, folder: str) -> DataFrame:
    typed = typed_lines(spark, folder)
    return entities.audited_entity_aggregate(typed, LINES.rules)


@query
def entity_median(spark: SparkSession, folder: str) -> DataFrame:
    return entities.entity_medians(typed_lines(spark, folder), rules=LINES.rules)


@query
def entity_states_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over half of the order lines each, written, and merged without reading an event again."""
    size = fixed.ENTITY_MEDIAN_ACCURACY
    runs = [
        materialize(
            entities.entity_states(
                cleaning.typed_events(bindings.line_events(spark, folder, half), LINES.events, LINES.rules),
                LINES.rules,
                size,
            ),
            f"run-{half}",
        )
        for half in (0, 1)
    ]
    return entities.finished_states(entities.merge_states(runs, size))


@query
def entity_features(spark: SparkSession, folder: str) -> DataFrame:
    return entities.entity_features(entity_agg(spark, folder)).select(
        "app_id", "review_app_name", "rating_percent", "popularity", "playtime_hours"
    )


JOINED_COLUMNS = ("app_id", "game_name", "price", "popularity", "playtime_hours")


@query
def joined_entities(spark: SparkSession, folder: str) -> DataFrame:
    per_entity = entities.entity_features(entity_agg(spark, folder))
    return metadata.attach_metadata(per_entity, clean_metadata(spark, folder)).select(
        *JOINED_COLUMNS
    )


@query
def joined_entities_first(spark: SparkSession, folder: str) -> DataFrame:
    per_entity = entities.entity_features(entity_agg(spark, folder))
    repeated = cleaning.clean_metadata(bindings.repeated_part_metadata(spark, folder))
    return metadata.attach_metadata(per_entity, repeated, "first").select(*JOINED_COLUMNS)


@query
def joined_entities_fanout(spark: SparkSession, folder: str) -> DataFrame:
    per_entity = entities.entity_features(entity_agg(spark, folder))
    repeated = cleaning.clean_metadata(bindings.repeated_part_metadata(spark, folder))
    return metadata.attach_metadata(per_entity, repeated, "keep").select(*JOINED_COLUMNS)


@query
def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return line_features(spark, folder)


@query
def log_features(spark: SparkSession, folder: str) -> DataFrame:
    table = with_features(line_features(spark, folder))
    return rounded(table.select("app_id", *NAMES), *NAMES)


# --- scaling --------------------------------------------------------------------


@query
def scaler_parameters(spark: SparkSession, folder: str) -> DataFrame:
    params = scaler_params(with_features(line_features(spark, folder)), NAMES)
    return rounded(params, "mean", "deviation")


@query
def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scaled_lines(spark, folder).select("app_id", *SCALED), *SCALED)


@query
def scaled_features_ml(spark: SparkSession, folder: str) -> DataFrame:
    table = materialize(with_features(line_features(spark, folder)), "feature-table")
    scaled = ml_standardize(table, NAMES).withColumn("z", vector_to_array("scaled_features"))
    slots = [F.col("z")[i].alias(name) for i, name in enumerate(SCALED)]
    return rounded(scaled.select("app_id", *slots), *SCALED)


# --- clustering -----------------------------------------------------------------


@query
def assign_fixed(spark: SparkSession, folder: str) -> DataFrame:
    scored = scored_lines(spark, folder).select("app_id", "cluster_id", "d2")
    return rounded(scored, "d2")


@query
def wssse_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(wssse(scored_lines(spark, folder)), "wssse")


@query
def silhouette_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(silhouette(scored_lines(spark, folder), SCALED), "silhouette")


@query
def weighted_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Moments, cost and silhouette where repeated metadata rows are weights instead of rows."""
    per_entity = entities.entity_features(entity_agg(spark, folder))
    repeated = cleaning.clean_metadata(bindings.repeated_part_metadata(spark, folder))
    joined = metadata.attach_metadata(per_entity, repeated, "weight")
    copies = metadata.COPIES
    table = materialize(with_features(feature_rows(joined, extra=(copies,))), "weighted-features")
    scaler = fit_standardizer(table, NAMES, copies)
    assigned = materialize(assign(standardize(table, scaler), SCALED, bindings.LINE_CENTERS), "weighted-rows")
    measures = {
        "rows": float(table.agg(F.sum(copies)).first()[0] or 0),
        "wssse": wssse(assigned, copies).first()[0],
        "silhouette": silhouette(assigned, SCALED, weight=copies).first()[0],
        **{f"mean_{c}": m for c, m in zip(NAMES, scaler.means, strict=True)},
        **{f"deviation_{c}": s for c, s in zip(NAMES, scaler.deviations, strict=True)},
    }
    return rounded(spark.createDataFrame(list(measures.items()), "measure string, value double"), "value")


def fitted_lines(spark: SparkSession, folder: str, k: int = 4) -> tuple[DataFrame, list]:
    """Scaled rows and the centers of a fit on their stable layout."""
    scaled = scaled_lines(spark, folder)
    layout = stable_layout(scaled.select(*KEYS, *SCALED), KEYS)
    centers = center_lists(kmeans(k).fit(as_vectors(layout, SCALED)))
    return scaled, centers


@query
def kmeans_assign(spark: SparkSession, folder: str) -> DataFrame:
    scaled, centers = fitted_lines(spark, folder)
    return clustered_table(assign(scaled, SCALED, centers))


@query
def kmeans_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What a finished fit fulfils and unfitted centers do not."""
    scaled, centers = fitted_lines(spark, folder)
    return fit_checks(assign(scaled, SCALED, centers), SCALED, centers)


def swept_lines(spark: SparkSession, folder: str) -> DataFrame:
    sweep, _ = k_sweep(scaled_lines(spark, folder), SCALED, KEYS)
    return sweep


@query
def k_sweep_scores(spark: SparkSession, folder: str) -> DataFrame:
    return swept_lines(spark, folder)


@query
def k_sweep_checks(spark: SparkSession, folder: str) -> DataFrame:
    """For each K: its cost against that of an assignment, its silhouette's range, its centers."""
    scaled = scaled_lines(spark, folder)
    sweep, centers = k_sweep(scaled, SCALED, KEYS)
    checked = None
    for k in sorted(centers):
        assigned = assign(scaled, SCALED, centers[k])
        row = fit_checks(assigned, SCALED, centers[k]).select(
            F.lit(k).alias("K"),
            "assigned_rows",
            "centers_are_means",
            "moved_centers_cost_more",
            wssse(assigned).scalar().alias("again"),
        )
        checked = row if checked is None else checked.unionByName(row)
    return sweep.join(checked, "K").select(
        "K",
        "assigned_rows",
        "centers_are_means",
        "moved_centers_cost_more",
        (F.abs(F.col("WSSSE_Cost") - F.col("again")) < 1e-6 * F.col("again")).alias("cost_is_right"),
        F.col("Silhouette_Score").between(-1, 1).alias("silhouette_in_range"),
    )


@query
def best_k_row(spark: SparkSession, folder: str) -> DataFrame:
    return best_k(swept_lines(spark, folder))


@query
def elbow_chart(spark: SparkSession, folder: str) -> DataFrame:
    sweep = swept_lines(spark, folder)
    return elbow_series(sweep, best_k(sweep))


FIXED_KS = (2, 3, 4)


def fixed_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """A sweep whose model for K are the first K given centers."""
    models = {k: bindings.LINE_CENTERS[:k] for k in FIXED_KS}
    found = sweep_scores(scaled_lines(spark, folder), SCALED, models)
    return rounded(spark.createDataFrame(found, SWEEP_SCHEMA), "WSSSE_Cost", "Silhouette_Score")


@query
def sweep_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return fixed_sweep(spark, folder)


@query
def best_k_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return best_k(fixed_sweep(spark, folder))


@query
def elbow_fixed(spark: SparkSession, folder: str) -> DataFrame:
    sweep = fixed_sweep(spark, folder)
    return elbow_series(sweep, best_k(sweep))


@query
def elbow_read_back(spark: SparkSession, folder: str) -> DataFrame:
    return read_back(spark, fixed_sweep(spark, folder), SWEEP_SCHEMA)


def read_back(spark: SparkSession, table: DataFrame, schema) -> DataFrame:
    """A result table written as CSV and read again."""
    path = scratch_path(spark, "read-back")
    sinks.write_csv(table, path, single_file=True)
    return read_result_csv(spark, path, schema)


@query
def knee_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(knee(fixed_sweep(spark, folder)), "distance")


GAP_DRAWS = 3


@query
def gap_fixed(spark: SparkSession, folder: str) -> DataFrame:
    """The gap statistic of the given centers: data and uniform draws measured by the same models."""
    models = {k: bindings.LINE_CENTERS[:k] for k in FIXED_KS}
    scaled = materialize(scaled_lines(spark, folder), "scaled")
    drawn = [model_costs(uniform_draw(scaled, SCALED, "app_id", draw), SCALED, models) for draw in range(GAP_DRAWS)]
    rows = gap_statistic(model_costs(scaled, SCALED, models), drawn)
    return rounded(spark.createDataFrame(rows, GAP_SCHEMA), "gap", "error")


# --- findings with uncertainty, drift, refits -------------------------------------

PROFILED = tuple(profile.PROFILED)
BOOTSTRAPS = 50


def bootstrapped_lines(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    clustered = materialize(clustered_lines(spark, folder), "clustered")
    return materialize(replicate_means(clustered, PROFILED, replicates=BOOTSTRAPS), "replicates"), clustered


@query
def bootstrap_means(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(mean_intervals(*bootstrapped_lines(spark, folder)), "mean", "low", "high")


@query
def bootstrap_ratios(spark: SparkSession, folder: str) -> DataFrame:
    means, _ = bootstrapped_lines(spark, folder)
    return rounded(ratio_intervals(means, cluster=3, baseline=0), "low", "high")


@query
def drift_between_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """How far the entities of one cluster are from those of two others, whose sketches are merged."""
    clustered = materialize(clustered_lines(spark, folder), "clustered")
    sketches = [column_sketches(clustered.where(F.col("cluster_id") == i), PROFILED) for i in (0, 1, 3)]
    found = drift(sketches[0], merged_sketches(sketches[1].unionByName(sketches[2])))
    return rounded(found, "ks", "psi")


def permuted_lines(spark: SparkSession, folder: str, order: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """The clusters of the given centers, and those of some of them under other ids."""
    table = materialize(line_features(spark, folder), "feature-table")
    models = [fixed_model(table, LINES, centers) for centers in (bindings.LINE_CENTERS, [bindings.LINE_CENTERS[i] for i in order])]
    before, after = (materialize(clustered_table(model.score(table)), "clustered") for model in models)
    return before, after


@query
def refit_ids(spark: SparkSession, folder: str) -> DataFrame:
    """A refit whose ids are permuted, under the ids of the run before."""
    return keep_ids(*permuted_lines(spark, folder, (2, 0, 3, 1)))


@query
def refit_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """How far a run with three of the four centers agrees with that of all four."""
    table = materialize(contingency(*permuted_lines(spark, folder, (3, 0, 1))), "contingency")
    return rounded(adjusted_rand_index(table), "purity", "adjusted_rand_index")


# --- cluster profiles -----------------------------------------------------------


@query
def cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return profile.cluster_sizes(clustered_lines(spark, folder))


@query
def cluster_share(spark: SparkSession, folder: str) -> DataFrame:
    return profile.cluster_share(cluster_sizes(spark, folder))


@query
def cluster_stats(spark: SparkSession, folder: str) -> DataFrame:
    return line_statistics(spark, folder)


@query
def sizes_read_back(spark: SparkSession, folder: str) -> DataFrame:
    return read_back(spark, profile.cluster_sizes(clustered_lines(spark, folder)), SIZES_SCHEMA)


@query
def statistics_read_back(spark: SparkSession, folder: str) -> DataFrame:
    return read_back(spark, line_statistics(spark, folder), STATISTICS_SCHEMA)


@query
def cluster_contrast(spark: SparkSession, folder: str) -> DataFrame:
    return profile.cluster_contrast(line_statistics(spark, folder))


@query
def cluster_contrast_pair(spark: SparkSession, folder: str) -> DataFrame:
    return profile.contrast_between(line_statistics(spark, folder), cluster=3, baseline=0)


@query
def cluster_ranks(spark: SparkSession, folder: str) -> DataFrame:
    return profile.cluster_ranks(line_statistics(spark, folder))


@query
def cluster_labels(spark: SparkSession, folder: str) -> DataFrame:
    statistics = materialize(line_statistics(spark, folder), "statistics")
    return profile.label_texts(profile.cluster_labels(statistics), statistics)


@query
def representatives(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.representatives(scored_lines(spark, folder)), "d2")


# --- charts, previews and samples -----------------------------------------------


def labelled_points(spark: SparkSession, folder: str) -> DataFrame:
    clustered = clustered_lines(spark, folder)
    labels = {i: f"segment {i}" for i in range(len(bindings.LINE_CENTERS))}
    return profile.with_labels(clustered, labels)


@query
def scatter_chart(spark: SparkSession, folder: str) -> DataFrame:
    return scatter_rows(labelled_points(spark, folder), words=LINES.notable_words)


@query
def scatter_chart_3d(spark: SparkSession, folder: str) -> DataFrame:
    scored = scored_lines(spark, folder).withColumn(
        "cluster_label", F.concat(F.lit("segment "), "cluster_id")
    )
    axes = ("scaled_log_price", "scaled_rating_percent", "scaled_log_playtime")
    points = scatter_rows(scored, axes[0], axes[1], z=axes[2], words=LINES.notable_words)
    return rounded(points, "x", "y", "z")


@query
def feature_bar_chart(spark: SparkSession, folder: str) -> DataFrame:
    return feature_bars(line_statistics(spark, folder))


@query
def share_chart(spark: SparkSession, folder: str) -> DataFrame:
    statistics = materialize(line_statistics(spark, folder), "statistics")
    sizes = statistics.select("cluster_id", F.col("count").alias("game_count"))
    return share_slices(profile.cluster_share(sizes), profile.cluster_labels(statistics))


@query
def notable(spark: SparkSession, folder: str) -> DataFrame:
    return notable_entities(line_features(spark, folder), LINES.notable_words)


def title_fragments(spark: SparkSession, folder: str) -> DataFrame:
    """A word for every part: a piece of its name, of 3 to 8 characters, in upper case for every second one."""
    key = F.col("p_partkey").cast("int")
    word = F.substring("p_name", 1 + key % 7, 3 + key % 6)
    return read_table(spark, folder, "part").select(F.when(key % 2 == 0, F.upper(word)).otherwise(word).alias("word"))


@query
def notable_many(spark: SparkSession, folder: str) -> DataFrame:
    """Entities whose name contains any of as many words as there are parts."""
    return containing_any(line_features(spark, folder), title_fragments(spark, folder))


@query
def density_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """The feature view as counts per cell and cluster at five zoom levels."""
    return tiles(materialize(clustered_lines(spark, folder), "clustered"), levels=4)


@query
def principal_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """The same along the two principal axes of the scaled features."""
    scored = materialize(scored_lines(spark, folder), "scored")
    points = projected(scored, SCALED, principal_axes(scored, SCALED))
    return tiles(points, "axis_0", "axis_1", levels=4)


@query
def preview_events(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of the cleaned events in a full order."""
    columns = ("app_id", "app_name", "is_recommended", "playtime_forever")
    return preview(clean_lines(spark, folder), columns, 10)


@query
def preview_features(spark: SparkSession, folder: str) -> DataFrame:
    return preview(line_features(spark, folder), ("app_id",), 5)


@query
def sample_for_plot(spark: SparkSession, folder: str) -> DataFrame:
    return plot_sample(clustered_lines(spark, folder), n=500)


@query
def sample_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """A sample of rows where keys repeat: rows of one key are drawn one by one."""
    per_entity = entities.entity_features(entity_agg(spark, folder))
    repeated = cleaning.clean_metadata(bindings.repeated_part_metadata(spark, folder))
    table = feature_rows(metadata.attach_metadata(per_entity, repeated, "keep"))
    return plot_sample(table, n=300, distinct=("game_name", "price"))


# --- exports --------------------------------------------------------------------


@query
def export_clustered(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clustered")
    clustered_lines(spark, folder).write.parquet(path)
    return spark.read.schema(CLUSTERED_SCHEMA).parquet(path)


def one_row_summary(spark: SparkSession, folder: str, clustered: DataFrame, scored: DataFrame) -> DataFrame:
    return summary.metrics_summary(
        raw_count(spark, folder),
        profile.cluster_sizes(clustered),
        len(bindings.LINE_CENTERS),
        wssse(scored).scalar(),
        silhouette(scored, SCALED).scalar(),
    )


@query
def metrics_summary(spark: SparkSession, folder: str) -> DataFrame:
    scored = materialize(scored_lines(spark, folder), "scored")
    row = one_row_summary(spark, folder, clustered_table(scored), scored)
    return row.withColumn("features", F.array_join("features", ", "))


@query
def metrics_report(spark: SparkSession, folder: str) -> DataFrame:
    scored = materialize(scored_lines(spark, folder), "scored")
    clustered = clustered_table(scored)
    return summary.report_lines(
        one_row_summary(spark, folder, clustered, scored),
        profile.cluster_sizes(clustered),
        profile.cluster_statistics(clustered, accuracy=LINES.statistics_accuracy),
    )


@query
def dashboard_json(spark: SparkSession, folder: str) -> DataFrame:
    """All five sections, on the given centers."""
    scored = materialize(scored_lines(spark, folder), "scored")
    clustered = clustered_table(scored)
    statistics = materialize(
        profile.cluster_statistics(clustered, accuracy=LINES.statistics_accuracy), "statistics"
    )
    one_row = one_row_summary(spark, folder, clustered, scored)
    labels = profile.cluster_labels(statistics)
    return summary.dashboard_sections(
        dashboard_tables(clustered, statistics, fixed_sweep(spark, folder), labels, scored, one_row)
    )


@query
def export_manifest(spark: SparkSession, folder: str) -> DataFrame:
    clustered = materialize(clustered_lines(spark, folder), "clustered")
    tables = {
        "cluster_sizes": profile.cluster_sizes(clustered),
        "cluster_statistics": profile.cluster_statistics(clustered),
        "clustered_games": clustered,
        "plot_sample": plot_sample(clustered, n=500),
    }
    store = sinks.ExportStore(spark, scratch_path(spark, "exports"))
    run = store.new_run()
    written = [
        sinks.Written(name, sinks.write_csv(table, f"{run}/{name}", name.startswith("cluster_")), f"{run}/{name}")
        for name, table in tables.items()
    ]
    return store.manifest(store.commit(written)).select("table", "rows")


@query
def quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_checks(clustered_lines(spark, folder), len(bindings.LINE_CENTERS))


# --- scoring --------------------------------------------------------------------


@query
def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    table = materialize(line_features(spark, folder), "feature-table")
    return score_rows(table, fixed_model(table, LINES, bindings.LINE_CENTERS))


@query
def score_unusable(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose price is missing, no number, infinite or below what the logarithm takes get no cluster."""
    table = materialize(line_features(spark, folder), "feature-table")
    model = fixed_model(table, LINES, bindings.LINE_CENTERS)
    kind = F.pmod("app_id", F.lit(5))
    price = F.col("price")
    spoilt = (
        F.when(kind == 0, F.lit(None).cast("double"))
        .when(kind == 1, F.lit(float("nan")))
        .when(kind == 2, F.lit(float("inf")))
        .when(kind == 3, F.lit(-1.0))
        .otherwise(price)
    )
    return score_rows(table.withColumn("price", spoilt), model).select("app_id", "cluster_id")


@query
def score_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows, arriving as files, scored by a streaming query that runs to the end."""
    incoming = scratch_path(spark, "incoming")
    line_features(spark, folder).write.parquet(incoming)
    table = spark.read.parquet(incoming)
    model = fixed_model(table, LINES, bindings.LINE_CENTERS)
    stream = score_rows(read_feature_stream(spark, incoming, table.schema), model)
    scored = scratch_path(spark, "scored-stream")
    write_scored(stream, scored, scratch_path(spark, "stream-progress"), once=True).awaitTermination()
    return spark.read.schema(CLUSTERED_SCHEMA).parquet(scored)


TRIGGERS, FILE_EVENTS = 4, 500_000


def streamed_lines(spark: SparkSession, folder: str, time: str | None, each=None) -> str:
    """The order lines as files of events, taken a quarter of them a trigger; where the states are.

    There are four files, or more where one would hold more than ``FILE_EVENTS``: a file of few bytes is read by
    one task, which sorts its events for the names.
    """
    incoming, path = scratch_path(spark, "incoming-events"), scratch_path(spark, "states")
    events = bindings.line_events(spark, folder, time="happened")
    files = max(1, -(-events.count() // (TRIGGERS * FILE_EVENTS)))
    # Events of one time may go to several files.
    events.repartitionByRange(TRIGGERS * files, "happened", "app_id").write.parquet(incoming)
    stream = read_event_stream(spark, incoming, events.schema, files_per_trigger=files)
    # No event is late here, whatever the order in which the files are taken.
    states = running_states(stream, LINES, time, window="365 days", delay="7300 days")
    then = None if each is None else each(path)
    write_states(states, path, scratch_path(spark, "state-progress"), then, once=True).awaitTermination()
    return path


@query
def stream_features(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows from states that a stream kept per entity and year."""
    path = streamed_lines(spark, folder, "happened")
    return state_features(current_states(spark, path), bindings.part_metadata(spark, folder), LINES)


@query
def stream_entity_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Entities scored by a given model whenever a trigger changed them."""
    model = fixed_model(materialize(line_features(spark, folder), "feature-table"), LINES, bindings.LINE_CENTERS)
    scored = scratch_path(spark, "entity-scores")
    meta = bindings.part_metadata(spark, folder)
    streamed_lines(spark, folder, None, lambda path: scored_changes(path, scored, meta, model, LINES))
    return current_scores(spark, scored)


@query
def score_ml_model(spark: SparkSession, folder: str) -> DataFrame:
    """Spark ML stages fitted, saved, loaded and applied."""
    table = materialize(with_features(line_features(spark, folder)), "feature-table")
    fitted = fit_ml_stages(stable_layout(table, KEYS), NAMES, k=4)
    path = scratch_path(spark, "ml-model")
    fitted.save(path)
    return score_rows(table, type(fitted).load(path))


# --- second binding: users ------------------------------------------------------


@query
def user_features(spark: SparkSession, folder: str) -> DataFrame:
    return user_feature_rows(spark, folder)


def scored_users(spark: SparkSession, folder: str) -> DataFrame:
    table = materialize(user_feature_rows(spark, folder), "user-features")
    return fixed_model(table, USERS, bindings.USER_CENTERS).score(table)


@query
def user_segments(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scored_users(spark, folder).select("app_id", "cluster_id", "d2"), "d2")


@query
def user_segment_stats(spark: SparkSession, folder: str) -> DataFrame:
    return profile.cluster_statistics(
        clustered_table(scored_users(spark, folder)), accuracy=USERS.statistics_accuracy
    )


# --- third binding: wide vectors ------------------------------------------------


def scaled_vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    wide, names = bindings.embedding_features(spark, folder)
    return standardize(wide, fit_standardizer(wide, names)), scaled_names(names)


def assigned_vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    scaled, columns = scaled_vectors(spark, folder)
    return assign(scaled, columns, bindings.vector_centers(len(columns))), columns


@query
def vector_scaler_parameters(spark: SparkSession, folder: str) -> DataFrame:
    wide, names = bindings.embedding_features(spark, folder)
    return rounded(scaler_params(wide, names), "mean", "deviation")


@query
def vector_segments(spark: SparkSession, folder: str) -> DataFrame:
    assigned, _ = assigned_vectors(spark, folder)
    return rounded(assigned.select("vec_id", "cluster_id", "d2"), "d2")


@query
def vector_silhouette(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(silhouette(*assigned_vectors(spark, folder)), "silhouette")


@query
def vector_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    scaled, columns = scaled_vectors(spark, folder)
    scaled = materialize(scaled, "scaled-vectors")
    sweep, _ = k_sweep(scaled, columns, keys=("vec_id",), ks=(2, 3, 4))
    return sweep


# --- the complete job -----------------------------------------------------------


@query
def full_run(spark: SparkSession, folder: str) -> DataFrame:
    """Segment the order lines, write every export, return the manifest."""
    settings = LINES
    result = segment(
        bindings.line_events(spark, folder), bindings.part_metadata(spark, folder), settings
    )
    try:
        listing = export(result, scratch_path(spark, "exports"), settings).select("table", "rows")
        # One row per exported table.
        return spark.createDataFrame(listing.collect(), listing.schema)
    finally:
        result.release()
