"""Statistical tests and models."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog.base import LISTING, PATIENT, listings, patients, query, r, rounded, table
from fieldbook.config import JobConfig
from fieldbook.operators import inference, models
from fieldbook.plans import job
from fieldbook.session import materialise

# Two-sided tail of Student's t by Simpson's rule over [0, |t|] in SQL.
T_TAIL = """1 - 2 * (SELECT sum(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * exp(lgamma((df + 1) / 2) - lgamma(df / 2) - 0.5 * ln(df * pi()) - (df + 1) / 2 * ln(1 + power(abs(t) * i / 4000, 2) / df)))
        * abs(t) / 4000 / 3 FROM range(0, 4001) s(i))"""


def _anova_sql(with_frame: str, frame: str, metric: str, factor: str, p: str) -> str:
    """``p`` gives the tail for the number of groups at hand, in terms of f, d1 and d2."""
    return f"""WITH {with_frame}g AS (SELECT {factor} AS k, count({metric}) AS n, avg({metric}) AS m, var_pop({metric}) AS v
            FROM {frame} WHERE {factor} IS NOT NULL AND {metric} IS NOT NULL GROUP BY 1),
        s AS (SELECT count(*) - 1 AS d1, sum(n) - count(*) AS d2, sum(n * power(m - (SELECT sum(n * m) / sum(n) FROM g), 2)) AS b, sum(n * v) AS w FROM g),
        t AS (SELECT d1, d2, (b / d1) / (w / d2) AS f FROM s)
        SELECT round(f, 4) AS f_statistic, d1::BIGINT AS df_between, d2::BIGINT AS df_within, round({p}, 6) AS p_value,
            ({p} < 0.05)::INT AS significant FROM t"""


THREE_GROUPS = "power(d2 / (d2 + 2 * f), d2 / 2.0)"
FIVE_GROUPS = "power(d2 / (d2 + 4 * f), d2 / 2.0) * (1 + d2 / 2.0 * (4 * f / (d2 + 4 * f)))"


def _anova(df, metric, factor):
    a = inference.anova(df, metric, factor)
    return a.select(
        r("f_statistic").alias("f_statistic"), "df_between", "df_within", r("p_value", 6).alias("p_value"), "significant"
    )


@query("anova_three_groups", "M1", _anova_sql("", "lineitem", "l_extendedprice", "l_returnflag", THREE_GROUPS))
def anova_three_groups(spark, sf):
    return _anova(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")


@query("anova_five_groups", "M1", _anova_sql(LISTING + ", ", "listing", "price_capped", "region", FIVE_GROUPS))
def anova_five_groups(spark, sf):
    return _anova(listings(spark, sf), "price_capped", "region")


@query("chi_square_flags", "M2", """WITH o AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM lineitem GROUP BY 1, 2),
    x AS (SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM o),
    c AS (SELECT sum(power(n - e, 2) / e) AS chi FROM x)
    SELECT round(chi, 4) AS chi2, 2::BIGINT AS dof, round(exp(-chi / 2), 8) AS p_value, (exp(-chi / 2) < 0.05)::INT AS significant FROM c""")
def chi_square_flags(spark, sf):
    c = inference.chi_square(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return c.select(r("chi2").alias("chi2"), "dof", r("p_value", 8).alias("p_value"), "significant")


@query("chi_square_regions", "M2", f"""WITH {LISTING}, o AS (SELECT room_type AS a, region AS b, count(*) AS n FROM listing GROUP BY 1, 2),
    x AS (SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM o),
    c AS (SELECT sum(power(n - e, 2) / e) / 2 AS h FROM x),
    p AS (SELECT h, exp(-h) * (1 + h + h * h / 2 + h * h * h / 6) AS p FROM c)
    SELECT round(2 * h, 4) AS chi2, 8::BIGINT AS dof, round(p, 8) AS p_value, (p < 0.05)::INT AS significant FROM p""")
def chi_square_regions(spark, sf):
    c = inference.chi_square(listings(spark, sf), "room_type", "region")
    return c.select(r("chi2").alias("chi2"), "dof", r("p_value", 8).alias("p_value"), "significant")


@query("chi_square_two_by_two", "M2", f"""WITH o AS (SELECT quality AS a, toxic AS b, count(*) AS n FROM labels GROUP BY 1, 2),
    m AS (SELECT a, b FROM (SELECT DISTINCT a FROM o), (SELECT DISTINCT b FROM o)),
    y AS (SELECT m.a, m.b, coalesce(n, 0) AS n FROM m LEFT JOIN o USING (a, b)),
    x AS (SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM y),
    c AS (SELECT sum(power(greatest(abs(n - e) - 0.5, 0), 2) / e) AS chi FROM x),
    t AS (SELECT chi, sqrt(chi) AS z FROM c),
    p AS (SELECT chi, 1 - 2 * (SELECT sum(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * exp(-power(z * i / 4000, 2) / 2) / sqrt(2 * pi())) * z / 4000 / 3 FROM range(0, 4001) s(i)) AS p FROM t)
    SELECT round(chi, 6) AS chi2, 1::BIGINT AS dof, round(p, 8) AS p_value, (p < 0.05)::INT AS significant FROM p""")
def chi_square_two_by_two(spark, sf):
    c = inference.chi_square(table(spark, sf, "labels"), "quality", "toxic")
    return c.select(r("chi2", 6).alias("chi2"), "dof", r("p_value", 8).alias("p_value"), "significant")


def _welch_sql(with_frame, frame, metric, factor, first, second):
    return f"""WITH {with_frame}s AS (SELECT avg({metric}) FILTER ({factor} = '{first}') AS m1, avg({metric}) FILTER ({factor} = '{second}') AS m2,
            var_samp({metric}) FILTER ({factor} = '{first}') / count({metric}) FILTER ({factor} = '{first}') AS e1,
            var_samp({metric}) FILTER ({factor} = '{second}') / count({metric}) FILTER ({factor} = '{second}') AS e2,
            count({metric}) FILTER ({factor} = '{first}') AS n1, count({metric}) FILTER ({factor} = '{second}') AS n2 FROM {frame}),
        t AS (SELECT m1, m2, (m1 - m2) / sqrt(e1 + e2) AS t, power(e1 + e2, 2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)) AS df FROM s),
        p AS (SELECT *, {T_TAIL} AS p FROM t)
        SELECT round(t, 6) AS t_statistic, round(df, 4) AS df, round(m1, 4) AS mean_1, round(m2, 4) AS mean_2, round(p, 6) AS p_value,
            (p < 0.05)::INT AS significant FROM p"""


def _welch(df, *args):
    w = inference.welch(df, *args)
    return w.select(
        r("t_statistic", 6).alias("t_statistic"), r("df").alias("df"), r("mean_1").alias("mean_1"), r("mean_2").alias("mean_2"),
        r("p_value", 6).alias("p_value"), "significant",
    )


@query("welch_price_by_type", "M3", _welch_sql(LISTING + ", ", "listing", "price_capped", "room_type", "F", "O"))
def welch_price_by_type(spark, sf):
    return _welch(listings(spark, sf), "price_capped", "room_type", "F", "O")


@query("welch_billing_by_gender", "M3", _welch_sql(PATIENT + ", ", "patient", "billing", "gender", "F", "O"))
def welch_billing_by_gender(spark, sf):
    return _welch(patients(spark, sf), "billing", "gender", "F", "O")


NORMALITY = """SELECT '{c}' AS "column", n::BIGINT AS n, round(g1 * sqrt(n * (n - 1)) / (n - 2), 6) AS skewness,
    round(((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)), 6) AS kurtosis, round(z1 * z1 + z2 * z2, 4) AS k2,
    round(exp(-(z1 * z1 + z2 * z2) / 2), 6) AS p_value, (exp(-(z1 * z1 + z2 * z2) / 2) > 0.05)::INT AS is_normal
    FROM (SELECT *, ln(ya + sqrt(ya * ya + 1)) / sqrt(0.5 * ln(w2)) AS z1,
        (1 - 2 / (9 * a) - sign((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4)))) * power(abs((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4)))), 1.0 / 3)) / sqrt(2 / (9 * a)) AS z2
    FROM (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) / sqrt(2 / (w2 - 1)) AS ya, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS a
    FROM (SELECT *, sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
        (g2 + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / (power(n + 1, 2) * (n + 3) * (n + 5))) AS x,
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb
    FROM (SELECT count({c})::DOUBLE AS n, avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5) AS g1,
        avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3 AS g2 FROM {t}, (SELECT avg({c}) AS m FROM {t})))))"""


@query("normality", "M4", " UNION ALL ".join(NORMALITY.format(c=c, t="part") for c in ("p_size", "p_retailprice")))
def normality(spark, sf):
    n = inference.normality(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    return n.select(
        "column", "n", r("skewness", 6).alias("skewness"), r("kurtosis", 6).alias("kurtosis"), r("k2").alias("k2"),
        r("p_value", 6).alias("p_value"), "is_normal",
    )


@query("linear_fit", "M5", f"""WITH {PATIENT}, s AS (SELECT count(*) AS n, regr_slope(billing, age) AS slope, regr_intercept(billing, age) AS intercept,
        regr_r2(billing, age) AS r_squared, corr(age, billing) AS r FROM patient)
    SELECT n, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(r_squared, 8) AS r_squared, round(r, 8) AS r FROM s""")
def linear_fit(spark, sf):
    f = inference.linear_fit(patients(spark, sf), "billing", "age")
    return f.select("n", r("slope").alias("slope"), r("intercept").alias("intercept"), r("r_squared", 8).alias("r_squared"), r("r", 8).alias("r"))


@query("pearson_test", "M7", f"""WITH {LISTING}, s AS (SELECT count(*) AS n, corr(reviews, price_capped) AS r FROM listing),
    u AS (SELECT n, r, (n - 2)::DOUBLE AS df, r * sqrt((n - 2) / (1 - r * r)) AS t FROM s)
    SELECT n, round(r, 8) AS r, round({T_TAIL}, 6) AS p_value FROM u""")
def pearson_test(spark, sf):
    p = inference.pearson(listings(spark, sf), "reviews", "price_capped")
    return p.select("n", r("r", 8).alias("r"), r("p_value", 6).alias("p_value"))


@query("ridge_two_features", "M6", """WITH s AS (SELECT covar_pop(l_extendedprice, l_quantity) * count(*) AS c1, covar_pop(l_extendedprice, l_discount) * count(*) AS c2,
        var_pop(l_quantity) * count(*) AS s11, covar_pop(l_quantity, l_discount) * count(*) AS s12, var_pop(l_discount) * count(*) AS s22,
        var_pop(l_extendedprice) * count(*) AS t, avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2 FROM lineitem),
    b AS (SELECT *, (c1 * (s22 + 1) - c2 * s12) / ((s11 + 1) * (s22 + 1) - s12 * s12) AS b1,
        (c2 * (s11 + 1) - c1 * s12) / ((s11 + 1) * (s22 + 1) - s12 * s12) AS b2 FROM s),
    q AS (SELECT *, 1 - (t - 2 * (b1 * c1 + b2 * c2) + b1 * b1 * s11 + 2 * b1 * b2 * s12 + b2 * b2 * s22) / t AS rr FROM b)
    SELECT 'intercept' AS term, round(my - b1 * m1 - b2 * m2, 3) AS coefficient, round(rr, 6) AS r_squared FROM q
    UNION ALL SELECT 'l_quantity', round(b1, 3), round(rr, 6) FROM q UNION ALL SELECT 'l_discount', round(b2, 3), round(rr, 6) FROM q""")
def ridge_two_features(spark, sf):
    f = inference.ridge(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"])
    return f.select("term", r("coefficient", 3).alias("coefficient"), r("r_squared", 6).alias("r_squared"))


def _ridge_sql(with_frame: str, frame: str, y: str, xs: list[str], penalty: float = 1.0) -> str:
    """Centred ridge by a Cholesky factor, one step after the other."""
    p, steps = len(xs), []
    gram = ", ".join(f"covar_pop({a}, {b}) * count(*) + {penalty if i == j else 0.0}::DOUBLE AS g{i}{j}" for i, a in enumerate(xs) for j, b in enumerate(xs) if j <= i)
    cross = ", ".join(f"covar_pop({a}, {y}) * count(*) AS c{i}" for i, a in enumerate(xs))
    means = ", ".join(f"avg({a}) AS m{i}" for i, a in enumerate(xs))
    for i in range(p):
        for j in range(i + 1):
            inner = " - ".join([f"g{i}{j}", *(f"l{i}{k} * l{j}{k}" for k in range(j))])
            steps.append(f"sqrt({inner}) AS l{i}{i}" if i == j else f"({inner}) / l{j}{j} AS l{i}{j}")
    for i in range(p):
        steps.append("(" + " - ".join([f"c{i}", *(f"l{i}{k} * z{k}" for k in range(i))]) + f") / l{i}{i} AS z{i}")
    for i in reversed(range(p)):
        steps.append("(" + " - ".join([f"z{i}", *(f"l{k}{i} * b{k}" for k in range(i + 1, p))]) + f") / l{i}{i} AS b{i}")
    ctes, last = [], "s"
    for n, step in enumerate(steps):
        ctes.append(f"t{n} AS (SELECT *, {step} FROM {last})")
        last = f"t{n}"
    fit = " + ".join(f"b{i} * b{j} * (g{max(i, j)}{min(i, j)} - {penalty if i == j else 0.0})" for i in range(p) for j in range(p))
    both = " + ".join(f"b{i} * c{i}" for i in range(p))
    rows = [("intercept", "my - " + " - ".join(f"b{i} * m{i}" for i in range(p))), *((x, f"b{i}") for i, x in enumerate(xs))]
    return f"""WITH {with_frame}s AS (SELECT {gram}, {cross}, {means}, avg({y}) AS my, var_pop({y}) * count(*) AS total FROM {frame}), {', '.join(ctes)},
        q AS (SELECT *, round(1 - (total - 2 * ({both}) + {fit}) / total, 6) AS r_squared FROM {last}) """ + " UNION ALL ".join(
        f"SELECT '{name}' AS term, round({e}, 4) AS coefficient, r_squared FROM q" for name, e in rows)


@query("ridge_listing_price", "M6", _ridge_sql(LISTING + ", ", "listing", "price_capped", ["min_nights", "reviews", "host_listings", "availability"]))
def ridge_listing_price(spark, sf):
    f = inference.ridge(listings(spark, sf), "price_capped", ["min_nights", "reviews", "host_listings", "availability"])
    return f.select("term", r("coefficient").alias("coefficient"), r("r_squared", 6).alias("r_squared"))


@query("standard_scale", "M8", """SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part), 6) AS p_size,
    round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part), 6) AS p_retailprice FROM part""")
def standard_scale(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(models.standard_scale(p, ["p_size", "p_retailprice"]), 6)


@query("principal_scree_two", "M9 W3", """WITH c AS (SELECT abs(corr(l_quantity, l_discount)) AS r FROM lineitem)
    SELECT 1 AS component, round((1 + r) / 2, 6) AS explained, round((1 + r) / 2, 6) AS cumulative, ((1 + r) / 2 >= 0.9)::INT AS reaches_90 FROM c
    UNION ALL SELECT 2, round((1 - r) / 2, 6), 1.0, 1 FROM c""")
def principal_scree_two(spark, sf):
    _, scree = models.principal_components(table(spark, sf, "lineitem").select("l_quantity", "l_discount"), ["l_quantity", "l_discount"])
    return rounded(scree, 6)


@query("principal_scores", "M9", """WITH c AS (SELECT sign(corr(p_size, p_retailprice)) AS s, avg(p_size) AS m1, stddev_pop(p_size) AS d1, avg(p_retailprice) AS m2, stddev_pop(p_retailprice) AS d2 FROM part)
    SELECT p_partkey, round(abs(((p_size - m1) / d1 + s * (p_retailprice - m2) / d2) / sqrt(2)), 5) AS pc1,
        round(abs(((p_size - m1) / d1 - s * (p_retailprice - m2) / d2) / sqrt(2)), 5) AS pc2 FROM part, c""")
def principal_scores(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    scores, _ = models.principal_components(p, ["p_size", "p_retailprice"])
    return scores.select("p_partkey", r(F.abs("pc1"), 5).alias("pc1"), r(F.abs("pc2"), 5).alias("pc2"))


DIMS = 64  # length of the embedding vectors


def _vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"d{i}") for i in range(DIMS)])


@query("principal_scree_vectors", "M9 M12")
def principal_scree_vectors(spark, sf):
    v = _vectors(spark, sf)
    _, scree = models.principal_components(v, models.model_features(v, skip=["vec_id", "label"]), 5)
    return rounded(scree)


@query("kmeans_sizes", "M10")
def kmeans_sizes(spark, sf):
    v = _vectors(spark, sf)
    rows, _ = models.kmeans_clusters(v, [f"d{i}" for i in range(DIMS)], 5, restarts=10)
    return rows.groupBy("cluster").agg(F.count("*").alias("n"))


@query("kmeans_properties", "M10", "SELECT 5::BIGINT AS clusters, count(*) AS n, 0::BIGINT AS nearer_to_another FROM embeddings")
def kmeans_properties(spark, sf):
    """Every vector is in one of the clusters, and no other cluster's mean is nearer (in scaled columns)."""
    names = [f"d{i}" for i in range(DIMS)]
    scaled = materialise(models.standard_scale(_vectors(spark, sf), names), "scaled")
    rows, _ = models.kmeans_clusters(scaled, names, 5, restarts=10)
    point = F.array(*names)
    means = rows.groupBy("cluster").agg(F.array(*[F.avg(c) for c in names]).alias("mean"))
    apart = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    centres = means.agg(F.array_sort(F.collect_list(F.struct("cluster", "mean"))).alias("m")).scalar()  # five rows
    held = rows.withColumn("m", centres).withColumn("at", point)
    distance = F.transform("m", lambda c: F.struct(apart(F.col("at"), c["mean"]).alias("d"), c["cluster"].alias("cluster")))
    own = F.filter(distance, lambda c: c["cluster"] == F.col("cluster"))[0]["d"]
    return held.select("cluster", (F.array_min(distance)["d"] < own - 1e-4).alias("other")).agg(
        F.count_distinct("cluster").alias("clusters"), F.count("*").alias("n"), F.count_if("other").alias("nearer_to_another"))


@query("principal_scree_properties", "M9 M12", f"SELECT {DIMS}::BIGINT AS components, 1.0::DOUBLE AS explained, 0::BIGINT AS rises")
def principal_scree_properties(spark, sf):
    """All components together explain everything, each at most as much as the one before."""
    v = _vectors(spark, sf)
    _, scree = models.principal_components(v, models.model_features(v, skip=["vec_id", "label"]), DIMS)
    rise = F.lead("explained").over(Window.orderBy("component")) > F.col("explained") + 1e-12
    return scree.select("explained", rise.alias("rise")).agg(
        F.count("*").alias("components"), r(F.sum("explained"), 6).alias("explained"), F.count_if("rise").alias("rises"))


@query("patient_job_tests", "M1 M2 M3 M5 S13", f"""WITH {PATIENT},
    g AS (SELECT condition AS k, count(*) AS n, avg(billing) AS m, var_pop(billing) AS v FROM patient GROUP BY 1),
    f AS (SELECT (sum(n * power(m - (SELECT avg(billing) FROM patient), 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS f FROM g),
    a AS (SELECT condition, count(*) AS n FROM patient GROUP BY 1), b AS (SELECT result, count(*) AS n FROM patient GROUP BY 1),
    o AS (SELECT condition, result, count(*) AS n FROM patient GROUP BY 1, 2),
    c AS (SELECT sum(power(coalesce(o.n, 0) - a.n * b.n / t.n, 2) / (a.n * b.n / t.n)) AS chi2
        FROM a CROSS JOIN b CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM patient) t LEFT JOIN o USING (condition, result)),
    s AS (SELECT gender, count(*) AS n, avg(billing) AS m, var_samp(billing) AS v, row_number() OVER (ORDER BY count(*) DESC, gender) AS i FROM patient GROUP BY 1)
    SELECT 'anova_billing_condition' AS test, round(f, 4) AS value FROM f UNION ALL SELECT 'chi2_condition_result', round(chi2, 4) FROM c
    UNION ALL SELECT 'regression_billing_age', round(regr_slope(billing, age), 4) FROM patient
    UNION ALL SELECT 'ttest_two_largest_genders', round((x.m - y.m) / sqrt(x.v / x.n + y.v / y.n), 4) FROM s x, s y WHERE x.i = 1 AND y.i = 2""")
def patient_job_tests(spark, sf):
    """The statistic of each test of the patient job, as its report has it."""
    frame = materialise(patients(spark, sf).select("billing", "condition", "result", "age", "gender"), "patients")
    found = job.test_rows(job.patient_tests(frame, JobConfig()))
    value = F.coalesce(*[F.get_json_object("result", f"$.{c}") for c in ("f_statistic", "chi2", "slope", "t_statistic")])
    return found.select("test", r(value).alias("value"))


@query("silhouette_of_labels", "M11", f"""WITH p AS (SELECT label AS c, embedding::DOUBLE[] AS x FROM embeddings),
    k AS (SELECT c, count(*) AS n, {', '.join(f'sum(x[{i}]) AS s{i}' for i in range(1, DIMS + 1))}, sum({' + '.join(f'x[{i}] * x[{i}]' for i in range(1, DIMS + 1))}) AS q FROM p GROUP BY c),
    d AS (SELECT row_number() OVER () AS i, * FROM p),
    m AS (SELECT i, d.c AS own, k.c AS other, k.n,
        ({' + '.join(f'd.x[{i}] * d.x[{i}]' for i in range(1, DIMS + 1))}) + k.q / k.n - 2 * ({' + '.join(f'd.x[{i}] * k.s{i}' for i in range(1, DIMS + 1))}) / k.n AS dist FROM d, k),
    s AS (SELECT i, max(CASE WHEN own = other THEN dist * n / greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> other THEN dist END) AS b,
        max(CASE WHEN own = other THEN n END) AS n FROM m GROUP BY i)
    SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""")
def silhouette_of_labels(spark, sf):
    value = models.silhouette_squared(_vectors(spark, sf), [f"d{i}" for i in range(DIMS)], "label")
    return spark.range(1).select(r(F.lit(value), 6).alias("silhouette"))


@query("silhouette_sampled", "M11 P31", """WITH p AS (SELECT vec_id AS i, label AS c, embedding::DOUBLE[] AS x FROM embeddings ORDER BY md5(vec_id::VARCHAR || ':42'), vec_id LIMIT 3000),
    d AS (SELECT a.i, a.c AS own, b.c AS other, sum(list_distance(a.x, b.x)) AS s, count(*) AS n FROM p a, p b GROUP BY ALL),
    s AS (SELECT i, own, max(CASE WHEN own = other THEN s / greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b,
        max(CASE WHEN own = other THEN n END) AS n FROM d GROUP BY ALL)
    SELECT count(DISTINCT own) AS clusters, count(*) AS n, round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""")
def silhouette_sampled(spark, sf):
    v = _vectors(spark, sf)
    return rounded(models.silhouette_sampled(v, [f"d{i}" for i in range(DIMS)], "label", "vec_id", 3000), 6)


def _draws_sql(table: str, g: str, x: str, k: str) -> str:
    """Common table expressions up to ``w``: the weight of each (g, x, b) of each row."""
    return f"""keyed AS (SELECT {g} AS g, {x} AS x, {k} AS k, b FROM {table}, range(1, 1001) s(b)),
    h1 AS (SELECT *, ((k % 2147483647) * 48271 + b * 69621 + 12345) % 2147483647 * 48271 % 2147483647 AS h FROM keyed),
    h2 AS (SELECT * REPLACE (xor(h, h >> 15) AS h) FROM h1), h3 AS (SELECT * REPLACE (h % 2147483647 * 69621 % 2147483647 AS h) FROM h2),
    h4 AS (SELECT * REPLACE (xor(h, h >> 13) AS h) FROM h3), h5 AS (SELECT * REPLACE (h % 2147483647 * 39373 % 2147483647 AS h) FROM h4),
    h6 AS (SELECT * REPLACE (xor(h, h >> 16) AS h) FROM h5), u AS (SELECT g, x, b, (h % 2147483647) / 2147483647.0::DOUBLE AS u FROM h6),
    c AS (SELECT list(exp(-1) / factorial(i::INT) ORDER BY i) AS t FROM range(0, 10) s(i)),
    w AS (SELECT g, x, b, len(list_filter([list_sum(t[:1]), list_sum(t[:2]), list_sum(t[:3]), list_sum(t[:4]), list_sum(t[:5]), list_sum(t[:6]),
        list_sum(t[:7]), list_sum(t[:8]), list_sum(t[:9]), list_sum(t[:10])], lambda z: u >= z)) AS w FROM u, c)"""


@query("bootstrap_mean_interval", "M13", f"""WITH {_draws_sql('customer', 'c_mktsegment', 'c_acctbal', 'c_custkey')},
    m AS (SELECT g, b, sum(w * x) / sum(w) AS m FROM w GROUP BY g, b)
    SELECT g AS c_mktsegment, (SELECT round(avg(c_acctbal), 4) FROM customer WHERE c_mktsegment = g) AS mean,
        round(quantile_cont(m, 0.025), 4) AS low, round(quantile_cont(m, 0.975), 4) AS high FROM m GROUP BY g""")
def bootstrap_mean_interval(spark, sf):
    return rounded(inference.bootstrap_mean(table(spark, sf, "customer"), "c_mktsegment", "c_acctbal", "c_custkey"))


@query("bootstrap_median_interval", "M13", f"""WITH {_draws_sql('customer', 'c_mktsegment', 'c_acctbal', 'c_custkey')},
    c2 AS (SELECT g, b, x, sum(sum(w)) OVER (PARTITION BY g, b ORDER BY x) AS upto, sum(sum(w)) OVER (PARTITION BY g, b) AS n FROM w GROUP BY g, b, x),
    m AS (SELECT g, b, (min(x) FILTER (upto >= (n + 1) // 2) + min(x) FILTER (upto >= n // 2 + 1)) / 2 AS m FROM c2 GROUP BY g, b)
    SELECT g AS c_mktsegment, (SELECT round(median(c_acctbal), 4) FROM customer WHERE c_mktsegment = g) AS median,
        round(quantile_cont(m, 0.025), 4) AS low, round(quantile_cont(m, 0.975), 4) AS high FROM m GROUP BY g""")
def bootstrap_median_interval(spark, sf):
    return rounded(inference.bootstrap_median(table(spark, sf, "customer"), "c_mktsegment", "c_acctbal", "c_custkey"))


@query("median_interval", "M13", """WITH x AS (SELECT o_orderstatus, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS i,
        count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
    SELECT o_orderstatus, (SELECT round(median(o_totalprice), 4) FROM orders o WHERE o.o_orderstatus = x.o_orderstatus) AS median,
        max(v) FILTER (i = greatest(floor(n / 2.0 - 1.959963984540054 * sqrt(n) / 2), 1)) AS low,
        max(v) FILTER (i = least(ceil(n / 2.0 + 1.959963984540054 * sqrt(n) / 2), n)) AS high FROM x GROUP BY o_orderstatus""")
def median_interval(spark, sf):
    return rounded(inference.median_interval(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice"))


@query("mean_and_deviation", "M14", "SELECT event_type, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, count(*) AS n FROM events GROUP BY 1")
def mean_and_deviation(spark, sf):
    return rounded(inference.mean_and_deviation(table(spark, sf, "events"), "event_type", "value"))
