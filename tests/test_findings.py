"""Ids over refits, choice of K, intervals and drift, against brute force."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from cohortmill.functions.sketches import rank_error
from cohortmill.operators.clustering import gap_sweep, knee
from cohortmill.operators.drift import LEAST_SHARE, column_sketches, drift, merged_sketches
from cohortmill.operators.refits import adjusted_rand_index, assignment, contingency, keep_ids, matched_ids
from cohortmill.operators.uncertainty import gap_statistic, mean_intervals, ratio_intervals, replicate_means
from cohortmill.storage import materialize

# --- ids over refits


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6])
def test_assignment_is_the_best_of_all(n):
    pick = random.Random(n)
    for _ in range(60):
        gain = [[pick.choice([0, 0, 1, 5, 9, 100]) for _ in range(n)] for _ in range(n)]
        found = assignment(gain)
        assert sorted(found) == list(range(n))
        best = max(sum(gain[i][p[i]] for i in range(n)) for p in itertools.permutations(range(n)))
        assert sum(gain[i][found[i]] for i in range(n)) == best


def runs(spark, pairs):
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    table = spark.createDataFrame(rows, "app_id int, a int, b int").repartition(3)
    return tuple(table.select("app_id", F.col(c).alias("cluster_id")) for c in ("a", "b"))


def test_permuted_ids_come_back(spark):
    pick = random.Random(1)
    ids = [pick.randrange(4) for _ in range(200)]
    before, after = runs(spark, [(i, (i * 3 + 1) % 4) for i in ids])
    got = {r.app_id: r.cluster_id for r in keep_ids(before, after).collect()}
    assert got == dict(enumerate(ids))


def test_grown_and_shrunk_and_missing_clusters(spark):
    before, after = runs(spark, [(0, 5)] * 6 + [(0, 1)] * 3 + [(1, 1)] * 2 + [(1, 7)] * 9 + [(None, 5), (1, None), (None, None)])
    assert matched_ids(contingency(before, after)) == {5: 0, 7: 1, 1: 2}
    kept = [r.cluster_id for r in keep_ids(before, after).orderBy("app_id").collect()]
    assert kept == [0] * 6 + [2] * 5 + [1] * 9 + [0, None, None]
    assert matched_ids(contingency(after, before)) == {0: 5, 1: 7}
    nothing = contingency(*runs(spark, [(None, 1)]))
    assert matched_ids(nothing) == {} and tuple(adjusted_rand_index(nothing).first()) == (0, None, None)


def test_adjusted_rand_index_counts_pairs(spark):
    pick = random.Random(2)
    pairs = [(pick.randrange(3), pick.randrange(4)) for _ in range(60)]
    both = [(x[0] == y[0], x[1] == y[1]) for x, y in itertools.combinations(pairs, 2)]
    n11, n10, n01, n00 = (sum(b == want for b in both) for want in ((True, True), (True, False), (False, True), (False, False)))
    want = 2 * (n11 * n00 - n10 * n01) / ((n11 + n10) * (n10 + n00) + (n11 + n01) * (n01 + n00))
    row = adjusted_rand_index(contingency(*runs(spark, pairs))).first()
    assert row.entities == 60 and row.adjusted_rand_index == pytest.approx(want, abs=1e-12)
    same = adjusted_rand_index(contingency(*runs(spark, [(a, 9 - a) for a, _ in pairs]))).first()
    assert same.adjusted_rand_index == pytest.approx(1) and same.purity == 1
    assert adjusted_rand_index(contingency(*runs(spark, [(1, 1)] * 5))).first().adjusted_rand_index is None


# --- choice of K


def sweep(spark, costs):
    return spark.createDataFrame([(k, float(c), 0.0) for k, c in costs.items()], "K int, WSSSE_Cost double, Silhouette_Score double")


def test_knee(spark):
    got = {r.K: r for r in knee(sweep(spark, {2: 100, 3: 40, 4: 20, 5: 15, 6: 10})).collect()}
    distance = {k: 1 - (k - 2) / 4 - (c - 10) / 90 for k, c in {2: 100, 3: 40, 4: 20, 5: 15, 6: 10}.items()}
    assert all(got[k].distance == pytest.approx(d, abs=1e-9) for k, d in distance.items())
    assert [k for k, r in got.items() if r.is_knee] == [max(distance, key=distance.get)]
    for flat in ({2: 5, 3: 5, 4: 5}, {2: 9, 3: 6, 4: 3}, {2: 9}, {}):
        assert not any(r.is_knee for r in knee(sweep(spark, flat)).collect())
    assert [r.K for r in knee(sweep(spark, {2: 10, 3: 4, 4: 1, 5: 1})).collect() if r.is_knee] == [3]  # the smaller of two equal ones


def test_gap_rule():
    flat = [{2: 10.0, 3: 8.0, 4: 7.0}] * 3
    got = gap_statistic({2: 9.0, 3: 2.0, 4: 1.9}, flat)
    assert [k for k, *_, chosen in got if chosen] == [3]
    assert got[0][1] == pytest.approx(math.log(10 / 9)) and got[0][2] == 0
    rising = gap_statistic({2: 9.0, 3: 4.0, 4: 1.0}, flat)
    assert [k for k, *_, chosen in rising if chosen] == [4]


def test_gap_sweep_finds_separate_groups(spark):
    pick = random.Random(5)
    rows = [(i, 10 * (i % 3) + pick.gauss(0, 0.3), 10 * (i % 3 == 1) + pick.gauss(0, 0.3)) for i in range(240)]
    table = materialize(spark.createDataFrame(rows + [(999, None, 1.0)], "app_id int, x double, y double"), "groups")
    got = gap_sweep(table, ("x", "y"), ks=(2, 3, 4), draws=3).collect()
    assert [r.K for r in got if r.is_chosen] == [3]
    by = {r.K: r.gap for r in got}
    assert by[3] > by[2] and 2 < by[3] < 6 and all(r.error >= 0 for r in got)


# --- intervals


def test_intervals_hold_the_mean_and_narrow_with_rows(spark):
    widths = []
    for n in (50, 5000):
        table = spark.range(n).select(
            F.col("id").alias("app_id"), (F.col("id") % 2).cast("int").alias("cluster_id"),
            (F.pmod(F.xxhash64("id"), F.lit(100)) + 100 * (F.col("id") % 2)).cast("double").alias("x"),
            F.lit(None).cast("double").alias("empty"),
        ).repartition(5)
        means = materialize(replicate_means(table, ["x", "empty"], replicates=100), "replicates")
        rows = {(r.cluster_id, r.feature): r for r in mean_intervals(means, table).collect()}
        assert rows[0, "empty"]["mean"] is None and rows[0, "empty"].low is None
        for cluster in (0, 1):
            row = rows[cluster, "x"]
            assert row.low <= row["mean"] <= row.high
            sd = 29 / math.sqrt(n / 2)
            assert 0.5 * 3.92 * sd < row.high - row.low < 1.5 * 3.92 * sd
        widths.append(rows[0, "x"].high - rows[0, "x"].low)
        ratio = {r.feature: r for r in ratio_intervals(means, 1, 0).collect()}["x"]
        assert ratio.low < rows[1, "x"]["mean"] / rows[0, "x"]["mean"] < ratio.high
    assert widths[1] < widths[0] / 5


def test_intervals_do_not_depend_on_partitions(spark):
    table = spark.range(300).select(F.col("id").alias("app_id"), F.lit(0).alias("cluster_id"), (F.col("id") % 17).cast("double").alias("x"))
    got = [sorted(map(tuple, mean_intervals(replicate_means(t, ["x"], replicates=20), t).collect())) for t in (table.repartition(1), table.repartition(7))]
    assert got[0] == got[1]


def test_a_digest_is_computed_once_per_row_and_replicate(spark):
    table = spark.range(30).select(F.col("id").alias("app_id"), F.lit(0).alias("cluster_id"), F.col("id").cast("double").alias("x"))
    plan = replicate_means(table, ["x"], replicates=20)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1


# --- drift


def brute_drift(a, b, bins=10):
    points = sorted({*a, *b})
    share = lambda values, x: sum(v <= x for v in values) / len(values)
    ks = max(abs(share(a, x) - share(b, x)) for x in points)
    ends = [(0.0, 0.0)]
    for i in range(1, bins + 1):
        x = next(x for x in points if sum(v <= x for v in a) * bins >= i * len(a))
        ends.append((share(a, x), share(b, x)) if i < bins else (1.0, 1.0))
    psi = 0.0
    for (p, q), (r, s) in zip(ends, ends[1:]):
        u, v = max(r - p, LEAST_SHARE), max(s - q, LEAST_SHARE)
        psi += (u - v) * math.log(u / v)
    return ks, psi


@pytest.mark.parametrize("size", [400, 4096])
def test_drift_is_exact_below_the_sketch_size(spark, size):
    pick = random.Random(size)
    a = [float(pick.randrange(60)) for _ in range(371)]
    b = [float(pick.randrange(20, 90)) for _ in range(257)]
    table = lambda values: spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").repartition(3)
    row = drift(column_sketches(table(a), ["x"], size), column_sketches(table(b), ["x"], size), size).first()
    ks, psi = brute_drift(a, b)
    assert (row.n_before, row.n_after, row.ks_error) == (371, 257, 0.0)
    assert row.ks == pytest.approx(ks, abs=1e-8) and row.psi == pytest.approx(psi, abs=1e-6)
    same = drift(column_sketches(table(a), ["x"], size), column_sketches(table(a[::-1]), ["x"], size), size).first()
    assert same.ks == 0 and same.psi == pytest.approx(0)


def test_drift_of_large_tables_stays_within_its_bound(spark):
    size = 256
    values = [spark.range(50_000).select(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)).cast("double").alias("x")) for k in (1, 2)]
    moved = values[1].select((F.col("x") + 200).alias("x"))
    parts = [column_sketches(moved.where(f"pmod(xxhash64(x), 2) = {i}"), ["x"], size) for i in (0, 1)]
    row = drift(column_sketches(values[0], ["x"], size), merged_sketches(parts[0].unionByName(parts[1]), size), size).first()
    assert row.n_after == 50_000 and row.ks_error == pytest.approx(2 * rank_error(size))
    assert abs(row.ks - 0.2) < row.ks_error + 0.01


def test_drift_without_values(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    full = spark.createDataFrame([(1.0,)], "x double")
    row = drift(column_sketches(empty, ["x"]), column_sketches(full, ["x"])).first()
    assert (row.n_before, row.n_after, row.ks, row.psi) == (0, 1, None, None)
    only = drift(column_sketches(full, ["x"]), column_sketches(full, ["x"])).first()
    assert (only.ks, only.psi) == (0.0, 0.0)
