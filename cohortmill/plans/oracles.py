"""Independent SQL for every query whose result SQL can state.

``half_up`` rounds the shortest decimal form of a double, as Spark does; a plain
``ROUND`` of a double differs at ties such as 27.9 / 60.
"""

from __future__ import annotations

from cohortmill import fixed_values as fixed
from cohortmill.operators.uncertainty import POISSON_STEPS
from cohortmill.plans import bindings
from cohortmill.plans.bindings import LINE_CENTERS, USER_CENTERS

ORACLES: dict[str, str] = {}


def half_up(expression: str, digits: int) -> str:
    exact = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,18))"
    return f"CAST(ROUND({exact}, {digits}) AS DOUBLE)"


def stack(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- order lines ----------------------------------------------------------------

RAW_EVENTS = """raw_events AS (
  SELECT CAST(l_partkey AS VARCHAR) || CASE WHEN l_linenumber = 7 THEN 'x' ELSE '' END AS app_id,
         CASE WHEN l_linenumber <> 1 THEN 'item ' || CAST(l_partkey AS VARCHAR)
              || CASE WHEN l_linestatus = 'F' THEN ' (old)' ELSE '' END END AS app_name,
         CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'R' THEN 'False'
              WHEN l_returnflag = 'A' THEN 'TRUE' ELSE 'True' END AS recommended,
         CASE WHEN l_linenumber = 5 AND l_quantity = 13 THEN 'n/a'
              ELSE CAST(l_quantity * 60 AS VARCHAR) END AS playtime_text
  FROM lineitem)"""

TYPED_EVENTS = """typed_events AS (
  SELECT TRY_CAST(app_id AS INTEGER) AS app_id, app_name,
         CAST(CASE WHEN lower(recommended) = 'true' THEN 1 ELSE 0 END AS INTEGER) AS is_recommended,
         TRY_CAST(playtime_text AS DOUBLE) AS playtime_forever
  FROM raw_events)"""

CLEAN_EVENTS = """clean_events AS (
  SELECT * FROM typed_events
  WHERE app_id IS NOT NULL AND playtime_forever BETWEEN 0 AND 2700)"""

RAW_METADATA = """raw_metadata AS (
  SELECT CAST(p_partkey AS VARCHAR) || CASE WHEN p_size = 3 OR p_size >= 40 THEN 'x' ELSE '' END AS appid,
         CASE WHEN p_size <> 4 THEN p_name END AS name,
         CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN 'free'
              ELSE CAST(p_retailprice AS VARCHAR) END AS price
  FROM part)"""

REPEATED_METADATA = """repeated_metadata AS (
  SELECT * FROM raw_metadata
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, CAST(p_retailprice + 5 AS VARCHAR)
  FROM part WHERE p_size BETWEEN 10 AND 19
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, CAST(p_retailprice AS VARCHAR)
  FROM part WHERE p_size BETWEEN 20 AND 24)"""


def typed_metadata(source: str = "raw_metadata") -> str:
    return f"""clean_metadata AS (
  SELECT TRY_CAST(appid AS INTEGER) AS meta_appid, name AS meta_game_name,
         TRY_CAST(price AS DOUBLE) AS meta_price
  FROM {source} WHERE TRY_CAST(appid AS INTEGER) IS NOT NULL)"""


ENTITY_AGG = """entity_agg AS (
  SELECT app_id, MIN(app_name) AS review_app_name, COUNT(*) AS total_reviews,
         CAST(SUM(is_recommended) AS BIGINT) AS positive_reviews,
         CAST(SUM(is_recommended) AS DOUBLE) / COUNT(*) * 100.0 AS rating_percent,
         SUM(playtime_forever) / COUNT(*) AS avg_playtime_minutes
  FROM clean_events GROUP BY app_id)"""

ENTITY_FEATURES = f"""entity_features AS (
  SELECT *, {half_up(half_up("avg_playtime_minutes", 9) + " / 60.0", 2)} AS playtime_hours,
         total_reviews AS popularity
  FROM entity_agg)"""

JOINED = """joined AS (
  SELECT e.app_id, COALESCE(m.meta_game_name, e.review_app_name, 'Unknown Game') AS game_name,
         COALESCE(m.meta_price, CAST(0 AS DOUBLE)) AS price, e.rating_percent, e.popularity,
         e.playtime_hours
  FROM entity_features e LEFT JOIN clean_metadata m ON e.app_id = m.meta_appid)"""

FEATURE_TABLE = f"""feature_table AS (
  SELECT * FROM (
    SELECT app_id, game_name, price, {half_up("rating_percent", 2)} AS rating_percent,
           popularity, playtime_hours
    FROM joined)
  WHERE rating_percent BETWEEN 0 AND 100 AND popularity >= {fixed.MIN_POPULARITY}
    AND playtime_hours >= 0)"""

LOG_FEATURES = """log_features AS (
  SELECT *, ln(1 + greatest(price, 0)) AS log_price, ln(1 + popularity) AS log_popularity,
         ln(1 + playtime_hours) AS log_playtime
  FROM feature_table)"""

FEATURES = ("log_price", "rating_percent", "log_popularity", "log_playtime")

SCALED = (
    "scaled AS (\n  SELECT f.*, "
    + ",\n         ".join(
        f"(f.{c} - p.m_{c}) * CASE WHEN p.s_{c} = 0 THEN 0 ELSE 1 / p.s_{c} END AS scaled_{c}"
        for c in FEATURES
    )
    + "\n  FROM log_features f, (SELECT "
    + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_SAMP({c}) AS s_{c}" for c in FEATURES)
    + " FROM log_features) p)"
)


def nearest(centers, columns, source: str = "scaled") -> str:
    """Two CTEs: the distance to every center, then the id and distance of the nearest."""
    distances = ",\n         ".join(
        " + ".join(
            f"({c} - ({float(x)!r})) * ({c} - ({float(x)!r}))"
            for c, x in zip(columns, center, strict=True)
        )
        + f" AS d_{i}"
        for i, center in enumerate(centers)
    )
    names = [f"d_{i}" for i in range(len(centers))]
    smallest = f"LEAST({', '.join(names)})"
    choice = " ".join(f"WHEN {n} = {smallest} THEN {i}" for i, n in enumerate(names))
    return (
        f"measured AS (\n  SELECT *, {distances}\n  FROM {source}),\n"
        f"scored AS (\n  SELECT *, CAST(CASE {choice} END AS INTEGER) AS cluster_id, "
        f"{smallest} AS d2 FROM measured)"
    )


SCALED_COLUMNS = tuple(f"scaled_{c}" for c in FEATURES)

TO_CLEAN = (RAW_EVENTS, TYPED_EVENTS, CLEAN_EVENTS)
TO_ENTITIES = (*TO_CLEAN, ENTITY_AGG, ENTITY_FEATURES)
TO_FEATURES = (*TO_ENTITIES, RAW_METADATA, typed_metadata(), JOINED, FEATURE_TABLE)
TO_SCALED = (*TO_FEATURES, LOG_FEATURES, SCALED)
TO_SCORED = (*TO_SCALED, nearest(LINE_CENTERS, SCALED_COLUMNS))

CLUSTERED = "app_id, game_name, price, rating_percent, popularity, playtime_hours, cluster_id"

PROFILED = (
    ("price", "price"),
    ("rating_percent", "rating_percent"),
    ("popularity", "popularity_reviews"),
    ("playtime_hours", "playtime_hours"),
)

STATISTICS = (
    "stats AS (\n  SELECT cluster_id, COUNT(*) AS count, "
    + ", ".join(
        f"{half_up(half_up(f'AVG({source})', 9), 2)} AS avg_{name}, "
        + (
            f"quantile_disc({source}, 0.5) AS median_{name}"
            if source == "popularity"
            else f"{half_up(f'quantile_disc({source}, 0.5)', 2)} AS median_{name}"
        )
        for source, name in PROFILED
    )
    + " FROM scored GROUP BY cluster_id)"
)
TO_STATS = (*TO_SCORED, STATISTICS)

MEANS = "means AS (\n  " + " UNION ALL ".join(
    f"SELECT cluster_id, '{source}' AS feature, avg_{name} AS mean FROM stats"
    for source, name in PROFILED
) + ")"

SIZES = "sizes AS (SELECT cluster_id, COUNT(*) AS game_count FROM scored GROUP BY cluster_id)"


def pairwise_silhouette(columns, key: str, columns_as_list: bool = False) -> str:
    """The definition itself: mean distances over all pairs of rows."""
    if columns_as_list:
        distance = "list_sum(list_transform(list_zip(x.z, y.z), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    else:
        distance = " + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in columns)
    return f"""pairs AS (
  SELECT x.{key} AS id, x.cluster_id AS own, y.cluster_id AS other, SUM({distance}) AS total,
         COUNT(*) AS n
  FROM scored x, scored y GROUP BY x.{key}, x.cluster_id, y.cluster_id),
sides AS (
  SELECT id, MAX(CASE WHEN own = other THEN n END) AS n,
         MAX(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
         MIN(CASE WHEN own <> other THEN total / n END) AS b
  FROM pairs GROUP BY id),
silhouettes AS (
  SELECT AVG(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1
         ELSE 0 END) AS silhouette
  FROM sides)"""


SILHOUETTE = pairwise_silhouette(SCALED_COLUMNS, "app_id")

# --- sources --------------------------------------------------------------------

ORACLES["csv_scan_events"] = stack(RAW_EVENTS) + "SELECT * FROM raw_events"

ORACLES["csv_scan_metadata"] = """
SELECT CAST(p_partkey AS VARCHAR) AS appid,
       p_name || ', "' || p_brand || '"' || chr(10) || ' ' || p_type || ' ' AS name,
       CAST(p_retailprice AS VARCHAR) AS price
FROM part"""

ORACLES["csv_text_roundtrip"] = """
SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, text FROM documents
UNION ALL
SELECT 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text FROM conversations"""

ORACLES["csv_text_parallel"] = ORACLES["csv_text_roundtrip"]

ORACLES["export_roundtrip"] = stack(*TO_SCORED) + f"SELECT {CLUSTERED} FROM scored"
ORACLES["export_clustered"] = ORACLES["export_roundtrip"]
ORACLES["score_batch"] = ORACLES["export_roundtrip"]
ORACLES["score_stream"] = ORACLES["export_roundtrip"]
ORACLES["stream_entity_scores"] = ORACLES["export_roundtrip"]
ORACLES["stream_features"] = stack(*TO_FEATURES) + "SELECT * FROM feature_table"

ORACLES["raw_count"] = "SELECT COUNT(*) AS raw_rows FROM lineitem"

ORACLES["entity_count"] = stack(*TO_FEATURES) + "SELECT COUNT(*) AS entities FROM feature_table"

ORACLES["schema_listing"] = stack(RAW_EVENTS) + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS ordinal, '{name}' AS column_name, 'string' AS data_type, "
    f"COUNT(*) AS row_count, COUNT(*) - COUNT({column}) AS null_count FROM raw_events"
    for i, (name, column) in enumerate(
        (
            ("app_id", "app_id"),
            ("app_name", "app_name"),
            ("recommended", "recommended"),
            ("author.playtime_forever", "playtime_text"),
        )
    )
)

# --- cleaning -------------------------------------------------------------------

ORACLES["clean_key"] = (
    stack(RAW_EVENTS, TYPED_EVENTS)
    + "SELECT app_id, app_name FROM typed_events WHERE app_id IS NOT NULL"
)
ORACLES["clean_flag"] = (
    stack(RAW_EVENTS, TYPED_EVENTS) + "SELECT app_id, app_name, is_recommended FROM typed_events"
)
ORACLES["clean_measure"] = stack(*TO_CLEAN) + "SELECT * FROM clean_events"
ORACLES["clean_metadata"] = stack(RAW_METADATA, typed_metadata()) + "SELECT * FROM clean_metadata"

_REJECTS = (
    ("raw_rows", "TRUE"),
    ("invalid_key", "app_id IS NULL"),
    ("missing_measure", "app_id IS NOT NULL AND playtime_forever IS NULL"),
    ("measure_too_small", "app_id IS NOT NULL AND playtime_forever < 0"),
    ("measure_too_large", "app_id IS NOT NULL AND playtime_forever > 2700"),
    ("kept_rows", "app_id IS NOT NULL AND playtime_forever BETWEEN 0 AND 2700"),
)
ORACLES["rejects_by_rule"] = stack(RAW_EVENTS, TYPED_EVENTS) + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, COUNT(*) FILTER (WHERE {test}) AS rows FROM typed_events"
    for rule, test in _REJECTS
)

ORACLES["audit_totals"] = stack(*TO_CLEAN) + """
SELECT (SELECT COUNT(*) FROM raw_events) AS raw_rows,
       (SELECT COUNT(*) FROM typed_events WHERE app_id IS NULL) AS invalid_key,
       (SELECT COUNT(*) FROM typed_events WHERE app_id IS NOT NULL)
         - (SELECT COUNT(*) FROM clean_events) AS invalid_measure,
       (SELECT COUNT(*) FROM clean_events) AS kept_rows,
       (SELECT COUNT(DISTINCT app_id) FROM clean_events) AS entities"""

# --- entities -------------------------------------------------------------------

ORACLES["entity_agg"] = stack(*TO_CLEAN, ENTITY_AGG) + "SELECT * FROM entity_agg"

ORACLES["entity_agg_audited"] = stack(RAW_EVENTS, TYPED_EVENTS) + """, kept AS (
  SELECT *, COALESCE(app_id IS NOT NULL AND playtime_forever BETWEEN 0 AND 2700, FALSE) AS ok
  FROM typed_events)
SELECT app_id, MIN(app_name) FILTER (WHERE ok) AS review_app_name, COUNT(*) AS raw_reviews,
       COUNT(*) FILTER (WHERE ok) AS total_reviews,
       CAST(COALESCE(SUM(is_recommended) FILTER (WHERE ok), 0) AS BIGINT) AS positive_reviews,
       CAST(SUM(is_recommended) FILTER (WHERE ok) AS DOUBLE)
         / NULLIF(COUNT(*) FILTER (WHERE ok), 0) * 100.0 AS rating_percent,
       SUM(playtime_forever) FILTER (WHERE ok)
         / NULLIF(COUNT(*) FILTER (WHERE ok), 0) AS avg_playtime_minutes
FROM kept GROUP BY app_id"""

ORACLES["entity_states_merged"] = ORACLES["entity_agg_audited"].replace(
    "FROM kept GROUP BY",
    ", quantile_disc(playtime_forever, 0.5) FILTER (WHERE ok) AS median_playtime_minutes\nFROM kept GROUP BY",
)

ORACLES["entity_median"] = stack(*TO_CLEAN) + """
SELECT app_id, quantile_disc(playtime_forever, 0.5) AS median_playtime_minutes
FROM clean_events GROUP BY app_id"""

ORACLES["entity_features"] = stack(*TO_ENTITIES) + """
SELECT app_id, review_app_name, rating_percent, popularity, playtime_hours FROM entity_features"""

_JOINED_COLUMNS = "app_id, game_name, price, popularity, playtime_hours"
ORACLES["joined_entities"] = (
    stack(*TO_ENTITIES, RAW_METADATA, typed_metadata(), JOINED)
    + f"SELECT {_JOINED_COLUMNS} FROM joined"
)
_REPEATED = (*TO_ENTITIES, RAW_METADATA, REPEATED_METADATA, typed_metadata("repeated_metadata"))
ORACLES["joined_entities_fanout"] = stack(*_REPEATED, JOINED) + f"SELECT {_JOINED_COLUMNS} FROM joined"
ORACLES["joined_entities_first"] = (
    stack(
        *_REPEATED,
        """first_metadata AS (
  SELECT meta_appid, meta_game_name, meta_price FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY meta_appid
             ORDER BY meta_game_name NULLS LAST, meta_price NULLS LAST) AS place
    FROM clean_metadata) WHERE place = 1)""",
        JOINED.replace("clean_metadata", "first_metadata"),
    )
    + f"SELECT {_JOINED_COLUMNS} FROM joined"
)

ORACLES["feature_table"] = stack(*TO_FEATURES) + "SELECT * FROM feature_table"

ORACLES["log_features"] = (
    stack(*TO_FEATURES, LOG_FEATURES)
    + "SELECT app_id, "
    + ", ".join(f"{half_up(c, 6)} AS {c}" for c in FEATURES)
    + " FROM log_features"
)

# --- scaling --------------------------------------------------------------------

ORACLES["scaler_parameters"] = stack(*TO_FEATURES, LOG_FEATURES) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {half_up(f'AVG({c})', 6)} AS mean, "
    f"{half_up(f'STDDEV_SAMP({c})', 6)} AS deviation FROM log_features"
    for c in FEATURES
)
ORACLES["scaled_features"] = (
    stack(*TO_SCALED)
    + "SELECT app_id, "
    + ", ".join(f"{half_up(c, 6)} AS {c}" for c in SCALED_COLUMNS)
    + " FROM scaled"
)
ORACLES["scaled_features_ml"] = ORACLES["scaled_features"]

# --- clustering -----------------------------------------------------------------

ORACLES["assign_fixed"] = (
    stack(*TO_SCORED) + f"SELECT app_id, cluster_id, {half_up('d2', 6)} AS d2 FROM scored"
)
ORACLES["wssse_fixed"] = (
    stack(*TO_SCORED)
    + f"SELECT {half_up('SUM(d2)', 6)} AS wssse FROM scored"
)
ORACLES["silhouette_fixed"] = (
    stack(*TO_SCORED, SILHOUETTE)
    + f"SELECT {half_up('silhouette', 6)} AS silhouette FROM silhouettes"
)
_FIT_HOLDS = "TRUE AS centers_are_means, TRUE AS moved_centers_cost_more"
ORACLES["kmeans_checks"] = stack(*TO_FEATURES) + f"""
SELECT COUNT(*) AS assigned_rows, CAST(4 AS BIGINT) AS filled_clusters, {_FIT_HOLDS}
FROM feature_table"""
ORACLES["k_sweep_checks"] = stack(*TO_FEATURES) + f"""
SELECT CAST(k AS INTEGER) AS K, (SELECT COUNT(*) FROM feature_table) AS assigned_rows, {_FIT_HOLDS},
       TRUE AS cost_is_right, TRUE AS silhouette_in_range
FROM range({min(fixed.SWEEP_K)}, {max(fixed.SWEEP_K) + 1}) AS t(k)"""


def fixed_sweep(ks=(2, 3, 4)) -> str:
    """The sweep over the first K given centers: cost and pairwise silhouette of each."""
    rows = " UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS K, * FROM (WITH {nearest(LINE_CENTERS[:k], SCALED_COLUMNS)}, {SILHOUETTE} "
        f"SELECT {half_up('(SELECT SUM(d2) FROM scored)', 6)} AS WSSSE_Cost, "
        f"{half_up('(SELECT silhouette FROM silhouettes)', 6)} AS Silhouette_Score)"
        for k in ks
    )
    return f"sweep AS ({rows})"


_BEST = "SELECT * FROM sweep ORDER BY Silhouette_Score DESC, K LIMIT 1"
ORACLES["sweep_fixed"] = stack(*TO_SCALED, fixed_sweep()) + "SELECT * FROM sweep"
ORACLES["elbow_read_back"] = ORACLES["sweep_fixed"]
ORACLES["best_k_fixed"] = stack(*TO_SCALED, fixed_sweep()) + _BEST
ORACLES["elbow_fixed"] = stack(*TO_SCALED, fixed_sweep(), f"best AS ({_BEST})") + " UNION ALL ".join(
    f"SELECT s.K, '{m}' AS metric, s.{m} AS value, s.K = best.K AS is_best FROM sweep s, best"
    for m in ("WSSSE_Cost", "Silhouette_Score")
)

# --- cluster profiles -----------------------------------------------------------

ORACLES["cluster_sizes"] = stack(*TO_SCORED, SIZES) + "SELECT * FROM sizes"

_SHARE = "CAST(game_count AS DOUBLE) / SUM(game_count) OVER () * 100.0"
ORACLES["cluster_share"] = (
    stack(*TO_SCORED, SIZES)
    + f"SELECT cluster_id, game_count, {half_up(_SHARE, 1)} AS share_percent FROM sizes"
)
ORACLES["cluster_stats"] = stack(*TO_STATS) + "SELECT * FROM stats"

ORACLES["sizes_read_back"] = ORACLES["cluster_sizes"]
ORACLES["statistics_read_back"] = ORACLES["cluster_stats"]

ORACLES["cluster_contrast"] = stack(*TO_STATS, MEANS) + f"""
SELECT m.feature, m.cluster_id, m.mean, l.cluster_id AS lowest_cluster,
       {half_up("m.mean / NULLIF(l.mean, 0)", 4)} AS ratio_to_lowest
FROM means m JOIN (
  SELECT feature, cluster_id, mean,
         ROW_NUMBER() OVER (PARTITION BY feature ORDER BY mean, cluster_id) AS place FROM means
) l ON m.feature = l.feature AND l.place = 1"""

ORACLES["cluster_contrast_pair"] = stack(*TO_STATS, MEANS) + f"""
SELECT a.feature, {half_up("a.mean / NULLIF(b.mean, 0)", 4)} AS ratio
FROM means a JOIN means b ON a.feature = b.feature
WHERE a.cluster_id = 3 AND b.cluster_id = 0"""

ORACLES["cluster_ranks"] = stack(*TO_STATS, MEANS) + """
SELECT cluster_id, feature, mean,
       CAST(RANK() OVER (PARTITION BY feature ORDER BY mean DESC) AS INTEGER) AS rank
FROM means"""

LABELS = """labels_by_rule AS (
  SELECT cluster_id, count,
    CASE WHEN cluster_id = poor THEN 'poorly_received' WHEN cluster_id = hit THEN 'blockbuster'
         WHEN cluster_id = cheap THEN 'budget' ELSE 'mid_tier' END AS label
  FROM stats, (
    SELECT poor, hit, (SELECT cluster_id FROM stats WHERE cluster_id NOT IN (poor, hit)
                       ORDER BY avg_price, cluster_id LIMIT 1) AS cheap
    FROM (
      SELECT poor, (SELECT cluster_id FROM stats WHERE cluster_id <> poor
                    ORDER BY avg_popularity_reviews DESC, cluster_id LIMIT 1) AS hit
      FROM (SELECT cluster_id AS poor FROM stats
            ORDER BY avg_rating_percent, cluster_id LIMIT 1))))"""


def _text(position: int) -> str:
    cases = " ".join(
        f"WHEN '{label}' THEN '" + texts[position].replace("'", "''") + "'"
        for label, texts in fixed.LABEL_TEXTS.items()
    )
    return f"CASE label {cases} END"


_DESCRIPTION = """'Means: rating ' || CAST(avg_rating_percent AS VARCHAR) || ' %, price '
       || CAST(avg_price AS VARCHAR) || ', reviews ' || CAST(avg_popularity_reviews AS VARCHAR)
       || ', hours ' || CAST(avg_playtime_hours AS VARCHAR)"""
ORACLES["cluster_labels"] = stack(*TO_STATS, LABELS) + f"""
SELECT l.cluster_id, l.count, label, {_text(0)} AS name, {_text(1)} AS short_name,
       {_DESCRIPTION} AS description
FROM labels_by_rule l JOIN stats ON l.cluster_id = stats.cluster_id"""

ORACLES["representatives"] = stack(*TO_SCORED) + f"""
SELECT cluster_id, app_id, game_name, {half_up("d2", 6)} AS d2, place FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY cluster_id ORDER BY d2, app_id, game_name) AS INTEGER) AS place
  FROM scored) WHERE place <= 5"""

# --- charts, previews and samples -----------------------------------------------

_NOTABLE = "(" + " OR ".join(
    f"contains(lower(game_name), '{w.lower()}')" for w in bindings.LINE_SETTINGS.notable_words
) + ")"
_CAPTION = f"CASE WHEN {_NOTABLE} THEN game_name END AS caption"

ORACLES["scatter_chart"] = stack(*TO_SCORED) + f"""
SELECT app_id, rating_percent AS x, playtime_hours AS y, popularity AS size,
       'segment ' || CAST(cluster_id AS VARCHAR) AS hue, {_CAPTION}
FROM scored"""

ORACLES["scatter_chart_3d"] = stack(*TO_SCORED) + f"""
SELECT app_id, {half_up("scaled_log_price", 6)} AS x, {half_up("scaled_rating_percent", 6)} AS y,
       {half_up("scaled_log_playtime", 6)} AS z, popularity AS size,
       'segment ' || CAST(cluster_id AS VARCHAR) AS hue, {_CAPTION}
FROM scored"""

_BARS = "bars AS (\n  " + " UNION ALL ".join(
    f"SELECT cluster_id, 'avg_{name}' AS metric, avg_{name} AS value, "
    f"{chr(39) + '$' + chr(39) if name == 'price' else chr(39) * 2} AS unit FROM stats"
    for _, name in PROFILED
) + ")"
ORACLES["feature_bar_chart"] = stack(*TO_STATS, _BARS) + """
SELECT cluster_id, metric, value,
       CASE WHEN value > 1000 THEN format('{:,.0f}', value)
            WHEN value > 10 THEN format('{:.1f}', value)
            WHEN unit = '$' THEN '$' || format('{:.2f}', value)
            ELSE format('{:.1f}', value) END AS caption
FROM bars"""

ORACLES["share_chart"] = stack(*TO_STATS, SIZES, LABELS) + f"""
SELECT s.cluster_id, label || chr(10) || '(' || CAST(game_count AS VARCHAR) || ' games)' AS caption,
       game_count, {half_up(_SHARE, 1)} AS share_percent
FROM sizes s JOIN labels_by_rule l ON s.cluster_id = l.cluster_id"""

ORACLES["notable"] = stack(*TO_FEATURES) + f"SELECT * FROM feature_table WHERE {_NOTABLE}"

ORACLES["preview_events"] = stack(*TO_CLEAN) + """
SELECT app_id, app_name, is_recommended, playtime_forever FROM clean_events
ORDER BY app_id, app_name NULLS FIRST, is_recommended, playtime_forever LIMIT 10"""

ORACLES["preview_features"] = (
    stack(*TO_FEATURES) + "SELECT * FROM feature_table ORDER BY app_id LIMIT 5"
)

ORACLES["sample_for_plot"] = stack(*TO_SCORED) + f"""
SELECT {CLUSTERED} FROM scored
ORDER BY md5(CAST(app_id AS VARCHAR) || ':{fixed.SEED}'), app_id LIMIT 500"""

ORACLES["sample_repeated"] = (
    stack(*_REPEATED, JOINED, FEATURE_TABLE)
    + f"""SELECT * FROM feature_table
ORDER BY md5(CAST(app_id AS VARCHAR) || ':{fixed.SEED}' || ':' || game_name || ':' || CAST(price AS VARCHAR)),
         app_id, game_name, price LIMIT 300"""
)

# --- exports --------------------------------------------------------------------

_SUMMARY = f"""summary AS (
  SELECT (SELECT COUNT(*) FROM lineitem) AS raw_rows, (SELECT COUNT(*) FROM scored) AS entities,
         CAST(4 AS INTEGER) AS optimal_k,
         {half_up("(SELECT SUM(d2) FROM scored)", 2)} AS wssse_cost,
         {half_up("(SELECT silhouette FROM silhouettes)", 4)} AS silhouette_score,
         '{", ".join(fixed.FEATURE_TITLES.values())}' AS features)"""

ORACLES["metrics_summary"] = stack(*TO_SCORED, SILHOUETTE, _SUMMARY) + "SELECT * FROM summary"

_FACTS = (
    "'Clustering summary'",
    f"'{'=' * 70}'",
    "'Raw events read: ' || format('{:,}', raw_rows)",
    "'Entities in the feature table: ' || format('{:,}', entities)",
    "'Algorithm: K-Means (Spark MLlib)'",
    "'Selected K: ' || CAST(optimal_k AS VARCHAR)",
    "'Features: ' || features",
    "'Scaling: log1p of price, popularity, playtime_hours; mean 0, deviation 1'",
    "'WSSSE cost: ' || format('{:,.2f}', wssse_cost)",
    "'Silhouette: ' || format('{:,.4f}', silhouette_score)",
    f"'{'=' * 70}'",
    "'Cluster sizes (cluster_id, game_count)'",
)
_STAT_COLUMNS = ["cluster_id", "count"] + [
    f"{kind}_{name}" for _, name in PROFILED for kind in ("avg", "median")
]
ORACLES["metrics_report"] = (
    stack(*TO_STATS, SIZES, SILHOUETTE, _SUMMARY)
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS line_no, {fact} AS line FROM summary"
        for i, fact in enumerate(_FACTS)
    )
    + """ UNION ALL SELECT CAST(10000000000 + cluster_id AS BIGINT),
      lpad(CAST(cluster_id AS VARCHAR), 10, ' ') || ' ' || lpad(CAST(game_count AS VARCHAR), 12, ' ')
      FROM sizes"""
    + f" UNION ALL SELECT CAST(20000000000 AS BIGINT), '{' '.join(_STAT_COLUMNS)}'"
    + " UNION ALL SELECT CAST(20000000001 + cluster_id AS BIGINT), "
    + " || ' ' || ".join(f"CAST({c} AS VARCHAR)" for c in _STAT_COLUMNS)
    + " FROM stats"
)


def _json_object(columns: list[str]) -> str:
    return "CAST(json_object(" + ", ".join(f"'{c}', {c}" for c in columns) + ") AS VARCHAR)"


_REPRESENTATIVE = """near AS (
  SELECT cluster_id, LIST(game_name ORDER BY place) AS representative FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster_id ORDER BY d2, app_id, game_name) AS place FROM scored)
  WHERE place <= 5 GROUP BY cluster_id)"""
_META = f"""meta AS (
  SELECT l.cluster_id, {_text(0)} AS name, {_text(1)} AS short_name, {_DESCRIPTION} AS description, representative
  FROM labels_by_rule l JOIN stats ON l.cluster_id = stats.cluster_id JOIN near ON l.cluster_id = near.cluster_id)"""
_TITLES = "[" + ", ".join(f"'{t}'" for t in fixed.FEATURE_TITLES.values()) + "]"
_MODEL = f"""model AS (
  SELECT format('{{:,}}', raw_rows) AS raw_reviews, entities AS clustered_games, optimal_k, wssse_cost,
         silhouette_score, {_TITLES} AS features FROM summary)"""
ORACLES["dashboard_json"] = (
    stack(*TO_STATS, fixed_sweep(), LABELS, _REPRESENTATIVE, _META, SILHOUETTE, _SUMMARY, _MODEL)
    + f"SELECT 'games' AS section, {_json_object(CLUSTERED.split(', '))} AS payload FROM scored"
    + f" UNION ALL SELECT 'statistics', {_json_object(_STAT_COLUMNS)} FROM stats"
    + f" UNION ALL SELECT 'elbow', {_json_object(['K', 'WSSSE_Cost', 'Silhouette_Score'])} FROM sweep"
    + " UNION ALL SELECT 'cluster_meta', "
    + _json_object(["cluster_id", "name", "short_name", "description", "representative"])
    + " FROM meta UNION ALL SELECT 'model_summary', "
    + _json_object(["raw_reviews", "clustered_games", "optimal_k", "wssse_cost", "silhouette_score", "features"])
    + " FROM model"
)

_MANIFEST = (
    ("cluster_sizes", "(SELECT COUNT(DISTINCT cluster_id) FROM scored)"),
    ("cluster_statistics", "(SELECT COUNT(DISTINCT cluster_id) FROM scored)"),
    ("clustered_games", "(SELECT COUNT(*) FROM scored)"),
    ("plot_sample", "(SELECT LEAST(COUNT(*), 500) FROM scored)"),
)
ORACLES["export_manifest"] = stack(*TO_SCORED) + " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", CAST({rows} AS BIGINT) AS rows" for name, rows in _MANIFEST
)

_CHECKS = (
    ("repeated_keys", "(SELECT COUNT(*) - COUNT(DISTINCT app_id) FROM scored)"),
    ("null_keys", "(SELECT COUNT(*) FROM scored WHERE app_id IS NULL)"),
    ("null_names", "(SELECT COUNT(*) FROM scored WHERE game_name IS NULL)"),
    (
        "null_features",
        "(SELECT COUNT(*) FROM scored WHERE price IS NULL OR rating_percent IS NULL"
        " OR popularity IS NULL OR playtime_hours IS NULL)",
    ),
    ("rating_out_of_range", "(SELECT COUNT(*) FROM scored WHERE rating_percent NOT BETWEEN 0 AND 100)"),
    (
        "popularity_below_minimum",
        f"(SELECT COUNT(*) FROM scored WHERE popularity < {fixed.MIN_POPULARITY})",
    ),
    ("negative_playtime", "(SELECT COUNT(*) FROM scored WHERE playtime_hours < 0)"),
    ("negative_price", "(SELECT COUNT(*) FROM scored WHERE price < 0)"),
    ("cluster_id_out_of_range", "(SELECT COUNT(*) FROM scored WHERE cluster_id NOT BETWEEN 0 AND 3)"),
)
ORACLES["quality"] = stack(*TO_SCORED) + " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, CAST(0 AS BIGINT) AS expected, {count} AS actual, {count} = 0 AS ok"
    for name, count in _CHECKS
)

ORACLES["score_unusable"] = stack(*TO_SCORED) + """
SELECT app_id, CASE WHEN app_id % 5 = 4 THEN cluster_id END AS cluster_id FROM scored"""

# --- users ----------------------------------------------------------------------

USER_EVENTS = """clean_events AS (
  SELECT CAST(user_id AS INTEGER) AS app_id, 'user ' || CAST(user_id AS VARCHAR) AS app_name,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_recommended,
         value AS playtime_forever
  FROM events WHERE value BETWEEN 0 AND 600000)"""

USER_METADATA = """clean_metadata AS (
  SELECT CAST(c_custkey AS INTEGER) AS meta_appid, c_name AS meta_game_name,
         c_acctbal AS meta_price
  FROM customer)"""

TO_USERS = (USER_EVENTS, ENTITY_AGG, ENTITY_FEATURES, USER_METADATA, JOINED, FEATURE_TABLE)
TO_USER_SCORES = (*TO_USERS, LOG_FEATURES, SCALED, nearest(USER_CENTERS, SCALED_COLUMNS))

ORACLES["user_features"] = stack(*TO_USERS) + "SELECT * FROM feature_table"
ORACLES["user_segments"] = (
    stack(*TO_USER_SCORES) + f"SELECT app_id, cluster_id, {half_up('d2', 6)} AS d2 FROM scored"
)
ORACLES["user_segment_stats"] = stack(*TO_USER_SCORES, STATISTICS) + "SELECT * FROM stats"

# --- wide vectors ---------------------------------------------------------------

SLOTS = """slots AS (
  SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS x
  FROM (SELECT vec_id, embedding, UNNEST(range(len(embedding))) AS i FROM embeddings))"""
SLOT_PARAMS = "params AS (SELECT i, AVG(x) AS m, STDDEV_SAMP(x) AS s FROM slots GROUP BY i)"
VECTOR_SCORED = """centers AS (
  SELECT c, i, 0.5 * ((i + c) % 3 - 1) AS point FROM range(3) AS t(c), (SELECT DISTINCT i FROM slots)),
scaled_slots AS (
  SELECT vec_id, i, (x - m) * CASE WHEN s = 0 THEN 0 ELSE 1 / s END AS z
  FROM slots JOIN params USING (i)),
reach AS (
  SELECT vec_id, c, SUM((z - point) * (z - point)) AS d2
  FROM scaled_slots JOIN centers USING (i) GROUP BY vec_id, c),
best AS (
  SELECT vec_id, c AS cluster_id, d2 FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY d2, c) AS place FROM reach)
  WHERE place = 1),
scored AS (
  SELECT b.vec_id, b.cluster_id, b.d2, v.z
  FROM best b JOIN (SELECT vec_id, LIST(z ORDER BY i) AS z FROM scaled_slots GROUP BY vec_id) v
    USING (vec_id))"""

ORACLES["vector_scaler_parameters"] = stack(SLOTS, SLOT_PARAMS) + f"""
SELECT 'x' || CAST(i AS VARCHAR) AS feature, {half_up("m", 6)} AS mean, {half_up("s", 6)} AS deviation
FROM params"""
ORACLES["vector_segments"] = stack(SLOTS, SLOT_PARAMS, VECTOR_SCORED) + f"""
SELECT vec_id, CAST(cluster_id AS INTEGER) AS cluster_id, {half_up("d2", 6)} AS d2 FROM scored"""
ORACLES["vector_silhouette"] = (
    stack(
        SLOTS, SLOT_PARAMS, VECTOR_SCORED, pairwise_silhouette((), "vec_id", columns_as_list=True)
    )
    + f"SELECT {half_up('silhouette', 6)} AS silhouette FROM silhouettes"
)

# --- weighted rows: the same numbers from every row of the plain join ------------

_NUMBERED = "numbered AS (SELECT *, row_number() OVER () AS rid FROM scaled)"
_FANNED = (
    *_REPEATED,
    JOINED,
    FEATURE_TABLE,
    LOG_FEATURES,
    SCALED,
    _NUMBERED,
    nearest(LINE_CENTERS, SCALED_COLUMNS, "numbered"),
    pairwise_silhouette(SCALED_COLUMNS, "rid"),
)
ORACLES["weighted_measures"] = stack(*_FANNED) + " UNION ALL ".join(
    f"SELECT '{name}' AS measure, {half_up(value, 6)} AS value FROM {source}"
    for name, value, source in (
        ("rows", "CAST(COUNT(*) AS DOUBLE)", "scored"),
        ("wssse", "SUM(d2)", "scored"),
        ("silhouette", "MAX(silhouette)", "silhouettes"),
        *[(f"mean_{c}", f"AVG({c})", "log_features") for c in FEATURES],
        *[(f"deviation_{c}", f"STDDEV_SAMP({c})", "log_features") for c in FEATURES],
    )
)

# --- choice of K ----------------------------------------------------------------

# The sweep of the given centers as a table, and the cost of uniform draws under the same centers.
_SWEPT = ORACLES["sweep_fixed"]
ORACLES["knee_fixed"] = f"""
WITH sweep AS ({_SWEPT}),
measured AS (
  SELECT K, WSSSE_Cost,
         ROUND(1 - (K - MIN(K) OVER ()) / CAST(MAX(K) OVER () - MIN(K) OVER () AS DOUBLE)
           - (WSSSE_Cost - MIN(WSSSE_Cost) OVER ()) / NULLIF(MAX(WSSSE_Cost) OVER () - MIN(WSSSE_Cost) OVER (), 0), 9) AS distance
  FROM sweep)
SELECT K, WSSSE_Cost, {half_up("distance", 6)} AS distance,
       distance > 0 AND K = first_value(K) OVER (ORDER BY distance DESC, K) AS is_knee
FROM measured"""


def uniform_sql(*parts: str) -> str:
    digest = "md5(" + " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"(CAST(('0x' || substr({digest}, 1, 12))::BIGINT AS DOUBLE) / 281474976710656.0)"


def _least_distance(k: int) -> str:
    return "LEAST(" + ", ".join(
        " + ".join(f"({c} - ({float(x)!r})) * ({c} - ({float(x)!r}))" for c, x in zip(SCALED_COLUMNS, center, strict=True))
        for center in LINE_CENTERS[:k]
    ) + ")"


_BOX = "box AS (SELECT " + ", ".join(
    f"MIN({c}) AS low{i}, MAX({c}) AS high{i}" for i, c in enumerate(SCALED_COLUMNS)
) + " FROM scaled)"
_DRAWN = "drawn AS (SELECT draw, " + ", ".join(
    f"low{i} + {uniform_sql('app_id', str(i), 'draw', '42')} * (high{i} - low{i}) AS {c}"
    for i, c in enumerate(SCALED_COLUMNS)
) + " FROM scaled, box, (SELECT unnest(range(3)) AS draw))"
_GAP_COSTS = "costs AS (" + " UNION ALL ".join(
    f"SELECT {k} AS K, -1 AS draw, LN(SUM({_least_distance(k)})) AS cost FROM scaled"
    f" UNION ALL SELECT {k}, draw, LN(SUM({_least_distance(k)})) FROM drawn GROUP BY draw"
    for k in (2, 3, 4)
) + ")"
ORACLES["gap_fixed"] = stack(
    *TO_SCALED,
    _BOX,
    _DRAWN,
    _GAP_COSTS,
    """gaps AS (
  SELECT K, AVG(cost) FILTER (WHERE draw >= 0) - MAX(cost) FILTER (WHERE draw < 0) AS gap,
         STDDEV_POP(cost) FILTER (WHERE draw >= 0) * SQRT(1 + 1 / 3.0) AS error
  FROM costs GROUP BY K)""",
    """chosen AS (
  SELECT COALESCE(MIN(K) FILTER (WHERE reached), (SELECT FIRST(K ORDER BY gap DESC, K) FROM gaps)) AS K
  FROM (SELECT K, gap >= LEAD(gap) OVER (ORDER BY K) - LEAD(error) OVER (ORDER BY K) AS reached FROM gaps))""",
) + f"""
SELECT CAST(g.K AS INTEGER) AS K, {half_up("gap", 6)} AS gap, {half_up("error", 6)} AS error, g.K = c.K AS is_chosen
FROM gaps g, chosen c"""

# --- findings with uncertainty ----------------------------------------------------

_WEIGHT = " + ".join(f"CAST(u >= {step!r} AS INTEGER)" for step in POISSON_STEPS)
_REPLICATES = (
    *TO_SCORED,
    f"""replicated AS (
  SELECT *, {_WEIGHT} AS w FROM (
    SELECT s.*, replicate, {uniform_sql("app_id", "replicate", "42")} AS u
    FROM scored s, (SELECT unnest(range(1, 51)) AS replicate)))""",
    "replicate_means AS (" + " UNION ALL ".join(
        f"SELECT cluster_id, replicate, '{source}' AS feature, CAST(SUM({source} * w) AS DOUBLE) / SUM(w) AS mean"
        f" FROM replicated WHERE w > 0 GROUP BY cluster_id, replicate"
        for source, _ in PROFILED
    ) + ")",
)
ORACLES["bootstrap_means"] = stack(
    *_REPLICATES,
    "exact AS (" + " UNION ALL ".join(
        f"SELECT cluster_id, '{source}' AS feature, AVG({source}) AS mean FROM scored GROUP BY cluster_id" for source, _ in PROFILED
    ) + ")",
) + f"""
SELECT r.cluster_id, r.feature, {half_up("MAX(e.mean)", 6)} AS mean,
       {half_up("quantile_cont(r.mean, 0.025)", 6)} AS low, {half_up("quantile_cont(r.mean, 0.975)", 6)} AS high
FROM replicate_means r JOIN exact e ON r.cluster_id = e.cluster_id AND r.feature = e.feature
GROUP BY r.cluster_id, r.feature"""
ORACLES["bootstrap_ratios"] = stack(*_REPLICATES) + f"""
SELECT feature, {half_up("quantile_cont(ratio, 0.025)", 6)} AS low, {half_up("quantile_cont(ratio, 0.975)", 6)} AS high
FROM (SELECT x.feature, x.mean / NULLIF(y.mean, 0) AS ratio FROM replicate_means x JOIN replicate_means y
      ON x.feature = y.feature AND x.replicate = y.replicate WHERE x.cluster_id = 3 AND y.cluster_id = 0)
GROUP BY feature"""

# --- drift, refits ------------------------------------------------------------------

_SIDES = "sides AS (" + " UNION ALL ".join(
    f"SELECT '{source}' AS feature, CAST({source} AS DOUBLE) AS x, cluster_id = 0 AS first FROM scored WHERE cluster_id IN (0, 1, 3)"
    for source, _ in PROFILED
) + ")"
ORACLES["drift_between_clusters"] = stack(
    *TO_SCORED,
    _SIDES,
    """totals AS (
  SELECT feature, COUNT(*) FILTER (WHERE first) AS n_before, COUNT(*) FILTER (WHERE NOT first) AS n_after FROM sides GROUP BY feature)""",
    """curves AS (
  SELECT p.feature, p.x, COUNT(*) FILTER (WHERE s.first AND s.x <= p.x) AS a, COUNT(*) FILTER (WHERE NOT s.first AND s.x <= p.x) AS b
  FROM (SELECT DISTINCT feature, x FROM sides) p JOIN sides s ON s.feature = p.feature GROUP BY p.feature, p.x)""",
    """ends AS (
  SELECT feature, bin, MIN(CASE WHEN bin = 10 THEN 1.0 ELSE CAST(a AS DOUBLE) / n_before END) AS a,
         MIN(CASE WHEN bin = 10 THEN 1.0 ELSE CAST(b AS DOUBLE) / n_after END) AS b
  FROM curves JOIN totals USING (feature), (SELECT unnest(range(1, 11)) AS bin)
  WHERE a * 10 >= bin * n_before GROUP BY feature, bin)""",
    """shares AS (
  SELECT feature, GREATEST(a - COALESCE(LAG(a) OVER w, 0), 0.0001) AS a, GREATEST(b - COALESCE(LAG(b) OVER w, 0), 0.0001) AS b
  FROM ends WINDOW w AS (PARTITION BY feature ORDER BY bin))""",
) + f"""
SELECT feature, n_before, n_after, CAST(0 AS DOUBLE) AS ks_error, {half_up("ks", 6)} AS ks, {half_up("psi", 6)} AS psi
FROM totals
JOIN (SELECT feature, MAX(ABS(CAST(a AS DOUBLE) / n_before - CAST(b AS DOUBLE) / n_after)) AS ks
      FROM curves JOIN totals USING (feature) GROUP BY feature) USING (feature)
JOIN (SELECT feature, SUM((a - b) * LN(a / b)) AS psi FROM shares GROUP BY feature) USING (feature)"""

ORACLES["refit_ids"] = ORACLES["export_roundtrip"]
_THREE = nearest([LINE_CENTERS[i] for i in (3, 0, 1)], SCALED_COLUMNS).replace("measured", "measured_3").replace("scored AS", "scored_3 AS")
ORACLES["refit_agreement"] = stack(
    *TO_SCORED,
    _THREE,
    """cells AS (
  SELECT x.cluster_id AS a, y.cluster_id AS b, CAST(COUNT(*) AS DOUBLE) AS n
  FROM scored x JOIN scored_3 y USING (app_id) GROUP BY 1, 2)""",
    """numbers AS (
  SELECT (SELECT SUM(n) FROM cells) AS entities, (SELECT SUM(n * (n - 1) / 2) FROM cells) AS cells,
         (SELECT SUM(n * (n - 1) / 2) FROM (SELECT SUM(n) AS n FROM cells GROUP BY a)) AS rows,
         (SELECT SUM(n * (n - 1) / 2) FROM (SELECT SUM(n) AS n FROM cells GROUP BY b)) AS columns,
         (SELECT SUM(n) FROM (SELECT MAX(n) AS n FROM cells GROUP BY a)) AS top)""",
) + f"""
SELECT CAST(entities AS BIGINT) AS entities, {half_up("top / entities", 6)} AS purity,
       {half_up("(cells - rows * columns / (entities * (entities - 1) / 2)) / ((rows + columns) / 2 - rows * columns / (entities * (entities - 1) / 2))", 6)} AS adjusted_rand_index
FROM numbers"""

# --- views, many words ----------------------------------------------------------------

ORACLES["density_tiles"] = stack(
    *TO_SCORED,
    """cells AS (
  SELECT cluster_id, app_id,
         LEAST(CAST(FLOOR((rating_percent - x0) / (x1 - x0) * 16) AS BIGINT), 15) AS cx,
         LEAST(CAST(FLOOR((playtime_hours - y0) / (y1 - y0) * 16) AS BIGINT), 15) AS cy
  FROM scored, (SELECT MIN(rating_percent) AS x0, MAX(rating_percent) AS x1,
                       MIN(playtime_hours) AS y0, MAX(playtime_hours) AS y1 FROM scored))""",
) + """
SELECT CAST(level AS INTEGER) AS level, cx >> (4 - level) AS cell_x, cy >> (4 - level) AS cell_y, cluster_id,
       COUNT(*) AS n, MIN(app_id) AS example
FROM cells, (SELECT CAST(unnest(range(5)) AS INTEGER) AS level) GROUP BY 1, 2, 3, 4"""

ORACLES["notable_many"] = stack(
    *TO_FEATURES,
    """fragments AS (
  SELECT DISTINCT lower(substr(p_name, CAST(1 + p_partkey % 7 AS INTEGER), CAST(3 + p_partkey % 6 AS INTEGER))) AS word FROM part)""",
) + """
SELECT * FROM feature_table f WHERE EXISTS (SELECT 1 FROM fragments WHERE contains(lower(f.game_name), word))"""
