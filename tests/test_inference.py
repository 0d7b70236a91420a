import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldbook.operators import inference, models, special


@pytest.mark.parametrize(
    "got, want",
    [
        (special.chi2_tail(13.2716, 10), 0.208881),
        (special.t_tail(1.1579, 54000), 0.246895),
        (special.f_tail(2.2242, 5, 54960), 0.049044),
        (special.t_tail(2.0, 10), 0.07338803477074039),
        (special.chi2_tail(3.841458820694124, 1), 0.05),
        (special.f_tail(4.0, 2, 20), (20 / 28) ** 10),
    ],
)
def test_known_tails(got, want):
    assert got == pytest.approx(want, abs=2e-5)


def test_tail_limits():
    assert special.chi2_tail(0, 3) == 1.0
    assert special.f_tail(0, 2, 5) == 1.0
    assert special.t_tail(0, 5) == pytest.approx(1.0)
    assert special.chi2_tail(5000, 8) == 0.0


def test_anova_is_stable_at_large_offsets(spark):
    rng = np.random.default_rng(1)
    groups = [rng.normal(m, 1, 400) for m in (0, 0.1, 0.3)]
    rows = [(str(i), float(x)) for i, g in enumerate(groups) for x in g]
    small = spark.createDataFrame(rows, "g string, x double")
    big = small.withColumn("x", F.col("x") + 1e9)
    a, b = inference.anova(small, "x", "g").first(), inference.anova(big, "x", "g").first()
    n = sum(map(len, groups))
    grand = np.concatenate(groups).mean()
    between = sum(len(g) * (g.mean() - grand) ** 2 for g in groups) / 2
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (n - 3)
    assert a["f_statistic"] == pytest.approx(between / within, rel=1e-10)
    assert b["f_statistic"] == pytest.approx(a["f_statistic"], rel=1e-4)


def test_anova_of_one_group_has_no_result(spark):
    assert inference.anova(spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, x double"), "x", "g").count() == 0


def test_chi_square_counts_empty_cells(spark):
    rows = [("a", "x")] * 10 + [("b", "y")] * 5 + [("c", "x")] * 3 + [("c", "y")] * 4
    got = inference.chi_square(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    table = np.array([[10, 0], [0, 5], [3, 4]], float)
    e = table.sum(1, keepdims=True) @ table.sum(0, keepdims=True) / table.sum()
    assert got["chi2"] == pytest.approx(((table - e) ** 2 / e).sum())
    assert got["dof"] == 2


@pytest.mark.parametrize("table", [[[8, 2], [1, 9]], [[5, 0], [2, 3]], [[5, 5], [5, 5]]])
def test_chi_square_two_by_two_is_corrected(spark, table):
    rows = [(i, j) for i in (0, 1) for j in (0, 1) for _ in range(table[i][j])]
    got = inference.chi_square(spark.createDataFrame(rows, "a int, b int"), "a", "b").first()
    t = np.array(table, float)
    e = t.sum(1, keepdims=True) @ t.sum(0, keepdims=True) / t.sum()
    d = np.abs(t - e)
    assert got["chi2"] == pytest.approx(((d - np.minimum(0.5, d)) ** 2 / e).sum(), abs=1e-12)


def test_welch_and_empty_group(spark):
    rows = [("a", x) for x in (1.0, 2.0, 3.0, 4.0)] + [("b", x) for x in (2.0, 4.0, 9.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = inference.welch(df, "x", "g", "a", "b").first()
    assert got["t_statistic"] == pytest.approx(-2.5 / np.sqrt((5 / 3) / 4 + 13 / 3))
    assert got["mean_1"] == 2.5 and got["mean_2"] == 5.0
    assert inference.welch(df, "x", "g", "a", "zzz").count() == 0


def test_ridge_equals_normal_equations(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3)) * [1, 5, 0.1]
    y = x @ [2.0, -1.0, 3.0] + 7 + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], ["a", "b", "c", "y"])
    got = {r["term"]: r for r in inference.ridge(df, "y", ["a", "b", "c"]).collect()}
    xc, yc = x - x.mean(0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
    assert [got[c]["coefficient"] for c in "abc"] == pytest.approx(list(beta))
    assert got["intercept"]["coefficient"] == pytest.approx(y.mean() - x.mean(0) @ beta)
    residual = yc - xc @ beta
    assert got["a"]["r_squared"] == pytest.approx(1 - (residual @ residual) / (yc @ yc))


def test_pearson_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (4.0, 4.0), (None, 100.0)], "x double, y double")
    got = inference.pearson(df, "x", "y").first()
    assert got["n"] == 4
    assert got["r"] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 1, 5, 4])[0, 1])


def test_normality_detects_shape(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b)) for a, b in zip(rng.normal(size=3000), rng.exponential(size=3000))]
    got = {r["column"]: r for r in inference.normality(spark.createDataFrame(rows, ["bell", "tail"]), ["bell", "tail"]).collect()}
    assert got["bell"]["is_normal"] == 1 and got["tail"]["is_normal"] == 0
    few = spark.createDataFrame([(float(i),) for i in range(7)], ["v"])
    assert inference.normality(few, ["v"]).count() == 0


def test_bootstrap_interval_is_near_the_normal_one(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(10, 2, 2000)
    df = spark.createDataFrame([(i, "g", float(x)) for i, x in enumerate(v)], "id long, g string, v double")
    got = inference.bootstrap_mean(df, "g", "v", "id", 400).first()
    half = 1.96 * v.std() / np.sqrt(2000)
    assert got["mean"] == pytest.approx(v.mean())
    assert got["low"] == pytest.approx(v.mean() - half, abs=half / 3)
    assert got["high"] == pytest.approx(v.mean() + half, abs=half / 3)


def test_median_interval_covers_the_median(spark):
    df = spark.range(1001).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    for bracket in (True, False):
        got = inference.median_interval(df, "g", "v", bracket=bracket).first()
        assert got["median"] == 500 and 465 < got["low"] < 472 and 528 < got["high"] < 535


def test_scale_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, c double")
    assert [tuple(r) for r in models.standard_scale(df, ["a", "c"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_principal_components_equal_svd(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ["a", "b", "c", "d"])
    scores, scree = models.principal_components(df, ["a", "b", "c", "d"], 4)
    z = (x - x.mean(0)) / x.std(0)
    s = np.linalg.svd(z, full_matrices=False)[1] ** 2
    assert [r["explained"] for r in scree.collect()] == pytest.approx(list(s / s.sum()))
    got = np.array([[r[f"pc{i}"] for i in (1, 2)] for r in scores.collect()])
    assert got.var(0) == pytest.approx(s[:2] / 300)


def test_wide_components_equal_narrow_ones(spark, monkeypatch):
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(*map(float, r), 3.0) for r in rng.normal(size=(200, 3))], ["a", "b", "c", "constant"])
    names = ["a", "b", "c", "constant"]
    narrow = models.principal_components(df, names, 3)[1].collect()
    monkeypatch.setattr(models, "WIDE", 2)
    wide = models.principal_components(df, names, 3)[1].collect()
    assert [r["explained"] for r in wide] == pytest.approx([r["explained"] for r in narrow])


def test_kmeans_and_silhouettes(spark):
    rng = np.random.default_rng(6)
    rows = [(i, *map(float, rng.normal(c, 0.2, 3))) for i, c in enumerate([0, 5, 10] * 40)]
    df = spark.createDataFrame(rows, ["id", "a", "b", "c"])
    out, cost = models.kmeans_clusters(df, ["a", "b", "c"], 3, restarts=3)
    assert sorted(r["count"] for r in out.groupBy("cluster").count().collect()) == [40, 40, 40]
    assert cost < 50
    assert models.silhouette_squared(out, ["a", "b", "c"], "cluster") > 0.95
    assert models.silhouette_sampled(out, ["a", "b", "c"], "cluster", "id", 90).first()["silhouette"] > 0.9


def test_model_features_need_three(spark):
    df = spark.createDataFrame([(1, 2.0, 3, 0, None)], "a int, b double, c int, a_is_outlier int, d double")
    assert models.model_features(df, drop_nullable=True) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        models.model_features(df.select("a", "b"))


def test_resampled_medians_equal_plain_ones(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [("a", float(round(x, 1)), i) for i, x in enumerate(rng.normal(0, 3, 900))]
    rows += [("b", float(i % 3), 1000 + i) for i in range(400)] + [("c", 7.0, 5000), ("d", None, 5001), (None, 1.0, 5002), ("e", 1.0, 6001), ("e", 2.0, 6002)]
    df = spark.createDataFrame(rows, "g string, x double, k long").repartition(4)
    want = {}
    for g in "abce":
        x, k = (np.array(v) for v in zip(*[(r[1], r[2]) for r in rows if r[0] == g and r[1] is not None]))
        w = inference._draws(k, np.arange(1, 101))
        medians = [np.median(np.repeat(x, w[:, b])) for b in range(100) if w[:, b].sum()]
        want[g] = (np.median(x), *np.percentile(medians, [2.5, 97.5]))
    for reach in (0.05, 4.0):  # far too narrow a bracket is widened
        got = {r["g"]: (r["median"], r["low"], r["high"]) for r in inference.bootstrap_median(df, "g", "x", "k", 100, reach=reach).collect()}
        assert got.keys() == want.keys()
        assert all(got[g] == pytest.approx(want[g], abs=1e-12) for g in want)


def test_kmeans_reads_all_runs_in_one_pass_and_equals_plain_rounds(spark, monkeypatch):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(np.vstack([rng.normal(c, 0.4, (200, 3)) for c in (0, 3, 6, 9)]), columns=list("abc"))
    df = spark.createDataFrame(pdf).repartition(4)
    passes = []
    gather = models.apply_groups
    monkeypatch.setattr(models, "apply_groups", lambda *a, **k: passes.append(1) or gather(*a, **k))
    out, cost = models.kmeans_clusters(df, ["a", "b", "c"], 4, restarts=8, start_rows=100)
    assert len(passes) < 20  # rounds, not rounds times runs
    got = out.toPandas()
    scaled = (got[list("abc")] - pdf.mean()) / pdf.std()
    means = scaled.groupby(got["cluster"]).mean()
    apart = ((scaled.to_numpy()[:, None, :] - means.to_numpy()[None]) ** 2).sum(axis=2)
    assert (apart.argmin(axis=1) == got["cluster"].to_numpy()).all()
    assert cost == pytest.approx(apart.min(axis=1).sum(), rel=1e-6)
    assert sorted(got["cluster"].value_counts()) == [200] * 4
    with_nulls = spark.createDataFrame([(1.0, 2.0, None), (1.0, 2.0, 3.0), (1.0, 2.0, 3.0)], "a double, b double, c double")
    assert models.kmeans_clusters(with_nulls, ["a", "b", "c"], 2)[0].count() == 2
    assert models.kmeans_clusters(with_nulls.limit(0), ["a", "b", "c"], 2)[0].count() == 0


def test_kmeans_takes_few_passes_for_many_rounds(spark, monkeypatch):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame(pd.DataFrame(rng.uniform(0, 1, (12_000, 3)), columns=list("abc"))).coalesce(1)  # equal starts
    passes, gather = [], models.apply_groups
    monkeypatch.setattr(models, "apply_groups", lambda *a, **k: passes.append(1) or gather(*a, **k))
    found = {}
    for held in (0, 8 * 3 * 2 * 3_000, models.BORDER_BYTES):
        monkeypatch.setattr(models, "BORDER_BYTES", held)
        passes.clear()
        out, cost = models.kmeans_clusters(df, ["a", "b", "c"], 5, restarts=2, start_rows=300)
        found[held] = len(passes), cost, sorted(out.groupBy("cluster").count().collect())
    (many, cost, sizes), (few, few_cost, few_sizes), (least, least_cost, least_sizes) = found.values()
    assert many > 25 and few <= many / 3 and least <= few  # rounds, not passes
    assert few_cost == pytest.approx(cost, rel=1e-12) and least_cost == pytest.approx(cost, rel=1e-12)
    assert sizes == few_sizes == least_sizes


def test_rounds_within_reach_equal_plain_rounds():
    rng = np.random.default_rng(5)
    points, start = rng.normal(0, 1, (20_000, 2)), rng.normal(0, 1, (4, 2))
    plain = start
    for rounds in range(1, 301):
        before, plain = plain, models._moved(plain[None], models._gathered(points, plain[None]))[0]
        if np.abs(plain - before).max() <= 1e-6:
            break
    first = models._moved(start[None], models._gathered(points, start[None]))[0]
    got, last, n, settled = models._walked(points, np.zeros((4, 4)), start, first, np.inf, 300, 1e-6)
    assert settled and n + 1 == rounds
    assert np.allclose(got, plain, atol=1e-12) and np.allclose(last, before, atol=1e-12)
    reach = 0.5 * models._shift(plain, start)
    got, _, n, settled = models._walked(points, np.zeros((4, 4)), start, start, reach, 300, 1e-6)
    assert not settled and 0 < n < rounds and models._shift(got, start) > reach


def test_kmeans_goes_over_growing_samples_and_ends_on_all_rows(spark, monkeypatch):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(rng.uniform(0, 1, (9_000, 3)), columns=list("abc"))
    stored, keep = [], models.materialise

    def noted(df, *rest):
        out = keep(df, *rest)
        stored.extend([sum(len(r["block"]) for r in out.collect()) // 24] if out.columns == ["block"] else [])
        return out

    monkeypatch.setattr(models, "materialise", noted)
    out, cost = models.kmeans_clusters(spark.createDataFrame(pdf).repartition(3), list("abc"), 4, restarts=3, start_rows=100)
    sample, whole = stored
    assert 600 < sample < 1_000 and whole == 9_000
    got = out.toPandas()
    scaled = (got[list("abc")] - pdf.mean()) / pdf.std()
    means = scaled.groupby(got["cluster"]).mean()
    apart = ((scaled.to_numpy()[:, None, :] - means.to_numpy()[None]) ** 2).sum(axis=2)
    assert (apart.argmin(axis=1) != got["cluster"].to_numpy()).sum() <= 2  # those on a border
    assert cost == pytest.approx(apart.min(axis=1).sum(), rel=1e-6)


def test_measured_points_equal_plain_ones():
    rng = np.random.default_rng(3)
    points, centres = rng.normal(size=(500, 4)), rng.normal(size=(3, 6, 4))
    apart = ((points[None, :, None, :] - centres[:, None]) ** 2).sum(axis=3)
    at, first, second = models._measured(points, centres)
    two = np.sort(apart, axis=2)
    assert (at == apart.argmin(axis=2)).all() and np.allclose(first, two[:, :, 0]) and np.allclose(second, two[:, :, 1])
    gaps = models._gaps(points, centres)
    gaps[0, 0] = 0.0
    classes = models._gap_classes(gaps).reshape(3, -1)
    assert (classes.cumsum(axis=1) == (gaps[:, :, None] <= models.GAPS).sum(axis=1)).all()
    assert np.isinf(models._gaps(points, centres[:, :1])).all()
