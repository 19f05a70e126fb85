"""Fits: regression, standardisation, principal components, neighbours, the study."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import GAP, LST, MEASURES, PTS, check, gap, lst, pts, rounded, table
from checks.listing import PAIRS, TAIL, cut_sql, distances_sql, histogram_sql, linkage_sql, normal_cdf_sql, stats_sql
from tidemark.operators import groups, neighbours, order, reduce, regress, within
from tidemark.operators.joins import join_dimension
from tidemark.operators.sampling import sample_rows
from tidemark.plans.study import Study, StudyConfig, run_listing_study

# --- regression -------------------------------------------------------------

# Area by price, over the listings with a known area.
ONE = f"""{LST}, {GAP},
  fit AS (SELECT regr_slope(area, price) AS b, regr_intercept(area, price) AS a, CAST(regr_count(area, price) AS BIGINT) AS n,
    regr_avgx(area, price) AS mx, regr_sxx(area, price) AS sxx, regr_syy(area, price) AS syy FROM gap),
  sse AS (SELECT sum((area - a - b * price) * (area - a - b * price)) AS sse FROM gap, fit WHERE area IS NOT NULL),
  one AS (SELECT *, sqrt(sse / (n - 2)) AS sigma FROM fit, sse)"""


def _one(spark: SparkSession, sf: str) -> tuple[DataFrame, regress.LinearFit]:
    listings = gap(spark, sf)
    return listings, regress.fit_ols(listings, "area", ["price"])


@check(
    "ols_coef",
    f"""WITH {ONE} SELECT 'intercept' AS term, round(a, 6) AS estimate FROM one
    UNION ALL SELECT 'price', round(b, 6) FROM one""",
)
def ols_coef(spark: SparkSession, sf: str) -> DataFrame:
    _, fit = _one(spark, sf)
    return rounded(regress.ols_table(spark, fit).select("term", "estimate"), 6, "estimate")


# Quantity and tax explain price: two predictors, solved by determinants.
@check(
    "ols_coef_two",
    f"""WITH {PTS}, c AS (SELECT covar_pop(quantity, quantity) AS xx, covar_pop(tax, tax) AS tt, covar_pop(quantity, tax) AS xt,
      covar_pop(quantity, price) AS xy, covar_pop(tax, price) AS ty, avg(quantity) AS mx, avg(tax) AS mt, avg(price) AS my FROM pts),
    s AS (SELECT *, (xy * tt - ty * xt) / (xx * tt - xt * xt) AS bx, (ty * xx - xy * xt) / (xx * tt - xt * xt) AS bt FROM c)
    SELECT 'intercept' AS term, round(my - bx * mx - bt * mt, 4) AS estimate FROM s
    UNION ALL SELECT 'quantity', round(bx, 4) FROM s UNION ALL SELECT 'tax', round(bt, 4) FROM s""",
)
def ols_coef_two(spark: SparkSession, sf: str) -> DataFrame:
    fit = regress.fit_ols(pts(spark, sf), "price", ["quantity", "tax"])
    return rounded(regress.ols_table(spark, fit).select("term", "estimate"), 4, "estimate")


@check(
    "ols_summary",
    f"""WITH {ONE}, e AS (SELECT *, sigma * sqrt(1.0 / n + mx * mx / sxx) AS ea, sigma / sqrt(sxx) AS eb FROM one)
    SELECT 'intercept' AS term, round(a, 6) AS estimate, round(ea, 6) AS std_error, round(a / ea, 4) AS t FROM e
    UNION ALL SELECT 'price', round(b, 6), round(eb, 6), round(b / eb, 4) FROM e""",
)
def ols_summary(spark: SparkSession, sf: str) -> DataFrame:
    _, fit = _one(spark, sf)
    found = regress.ols_table(spark, fit).drop("p")
    return rounded(rounded(found, 6, "estimate", "std_error"), 4, "t")


@check(
    "ols_fit_stats",
    f"""WITH {ONE} SELECT n, CAST(1 AS BIGINT) AS df_model, n - 2 AS df_residual, round(1 - sse / syy, 6) AS r2,
      round(1 - (sse / syy) * (n - 1) / (n - 2), 6) AS r2_adjusted, round(sigma, 6) AS sigma,
      round((syy - sse) / (sse / (n - 2)), 4) AS f FROM one""",
)
def ols_fit_stats(spark: SparkSession, sf: str) -> DataFrame:
    _, fit = _one(spark, sf)
    found = regress.ols_fit_stats(spark, fit).drop("p")
    return rounded(rounded(found, 6, "r2", "r2_adjusted", "sigma"), 4, "f")


@check(
    "ols_residual_quartiles",
    f"""WITH {ONE}, r AS (SELECT area - a - b * price AS e FROM gap, one WHERE area IS NOT NULL)
    SELECT round(min(e), 6) AS minimum, round(quantile_cont(e, 0.25), 6) AS first_quartile,
      round(quantile_cont(e, 0.5), 6) AS median, round(quantile_cont(e, 0.75), 6) AS third_quartile,
      round(max(e), 6) AS maximum FROM r""",
)
def ols_residual_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    found = regress.residual_quartiles(*_one(spark, sf))
    return rounded(found, 6, *found.columns)


@check("ols_predict", f"WITH {ONE} SELECT key, price, round(a + b * price, 6) AS predicted FROM gap, one")
def ols_predict(spark: SparkSession, sf: str) -> DataFrame:
    listings, fit = _one(spark, sf)
    return rounded(regress.predict_ols(listings, fit).select("key", "price", "predicted"), 6, "predicted")


DIAGNOSED = f"""WITH {ONE}, d AS (SELECT key, a + b * price AS fitted, area - a - b * price AS residual,
    1.0 / n + (price - mx) * (price - mx) / sxx AS leverage, sigma, n FROM gap, one WHERE area IS NOT NULL),
  s AS (SELECT *, residual / (sigma * sqrt(1 - leverage)) AS std_residual FROM d)"""


@check(
    "ols_diagnostics",
    f"""{DIAGNOSED} SELECT key, round(fitted, 6) AS fitted, round(residual, 6) AS residual, round(leverage, 8) AS leverage,
      round(std_residual, 6) AS std_residual, round(sqrt(abs(std_residual)), 6) AS scale_location,
      round(std_residual * std_residual * leverage / ((1 - leverage) * 2), 8) AS cooks FROM s""",
)
def ols_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    found = regress.ols_diagnostics(*_one(spark, sf)).select(
        "key", "fitted", "residual", "leverage", "std_residual", "scale_location", "cooks"
    )
    found = rounded(found, 6, "fitted", "residual", "std_residual", "scale_location")
    return rounded(found, 8, "leverage", "cooks")


def newton(before: str, after: str) -> str:
    return f"""{after} AS (SELECT std_residual, share,
    x - ({normal_cdf_sql('x')} - share) * sqrt(2 * pi()) * exp(x * x / 2) AS x FROM {before})"""


# Normal quantiles by Newton steps from a rough start, by the position of the residual.
QUANTILES = f"""pos AS (SELECT std_residual, (row_number() OVER (ORDER BY std_residual) - 0.5) / n AS share FROM s),
  h0 AS (SELECT *, sqrt(-2 * ln(least(share, 1 - share))) AS t FROM pos),
  h1 AS (SELECT std_residual, share, (CASE WHEN share < 0.5 THEN -1 ELSE 1 END)
    * (t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t)) AS x
    FROM h0),
  {newton('h1', 'h2')}, {newton('h2', 'h3')}, {newton('h3', 'h4')}"""


@check(
    "ols_normal_quantiles",
    f"""{DIAGNOSED}, {QUANTILES}
    SELECT round(std_residual, 6) AS std_residual, round(x, 6) AS normal_quantile FROM h4""",
)
def ols_normal_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    listings, fit = _one(spark, sf)
    found = regress.ols_diagnostics(listings, fit, key="key").select("std_residual", "normal_quantile")
    return rounded(found, 6, "std_residual", "normal_quantile")


# Areas by size and an indicator for each neighbourhood, solved by centring within neighbourhoods.
LEVELS = f"""{LST}, {GAP}, k AS (SELECT neigh, CAST(size AS DOUBLE) AS x, price AS y FROM gap),
  g AS (SELECT neigh, avg(x) AS mx, avg(y) AS my FROM k GROUP BY 1),
  b AS (SELECT sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS slope FROM k JOIN g USING (neigh)),
  base AS (SELECT my - slope * mx AS a FROM g, b ORDER BY neigh LIMIT 1)"""


@check(
    "ols_categorical",
    f"""WITH {LEVELS}
    SELECT 'intercept' AS term, round(a, 5) AS estimate FROM base
    UNION ALL SELECT 'size', round(slope, 5) FROM b
    UNION ALL SELECT 'neigh=' || neigh, round(my - slope * mx - a, 5) FROM g, b, base
      WHERE neigh > (SELECT min(neigh) FROM g)""",
)
def ols_categorical(spark: SparkSession, sf: str) -> DataFrame:
    fit = regress.fit_ols(gap(spark, sf), "price", ["size"], categorical=["neigh"])
    return rounded(regress.ols_table(spark, fit).select("term", "estimate"), 5, "estimate")


@check(
    "ols_within",
    f"""WITH {LEVELS}
    SELECT 'intercept' AS term, round(a, 5) AS estimate FROM base
    UNION ALL SELECT 'size', round(slope, 5) FROM b
    UNION ALL SELECT 'neigh=' || neigh, round(my - slope * mx - a, 5) FROM g, b, base
      WHERE neigh > (SELECT min(neigh) FROM g)""",
)
def ols_within(spark: SparkSession, sf: str) -> DataFrame:
    # The same by elimination within the levels, which never come to the driver.
    listings = gap(spark, sf)
    fit = within.fit_within(listings, "price", ["size"], "neigh")
    return rounded(within.within_table(listings, fit).select("term", "estimate"), 5, "estimate")


# A factor of as many levels as there are orders.
@check(
    "ols_within_orders",
    """WITH g AS (SELECT l_orderkey AS o, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem GROUP BY 1),
    b AS (SELECT sum((l_quantity - mx) * (l_extendedprice - my)) / sum((l_quantity - mx) * (l_quantity - mx)) AS slope
      FROM lineitem JOIN g ON l_orderkey = o)
    SELECT l_orderkey, l_linenumber, l_partkey, round(my + slope * (l_quantity - mx), 4) AS predicted
    FROM lineitem JOIN g ON l_orderkey = o, b""",
)
def ols_within_orders(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    fit = within.fit_within(lines, "l_extendedprice", ["l_quantity"], "l_orderkey")
    found = within.predict_within(lines, fit).select("l_orderkey", "l_linenumber", "l_partkey", "predicted")
    return rounded(found, 4, "predicted")


@check(
    "rmse",
    f"""WITH {ONE} SELECT round(sqrt(avg(pow(a + b * price - area, 2))), 6) AS rmse, count(area) AS n FROM gap, one""",
)
def rmse(spark: SparkSession, sf: str) -> DataFrame:
    listings, fit = _one(spark, sf)
    return rounded(regress.rmse(regress.predict_ols(listings, fit), "area", "predicted"), 6, "rmse")


@check(
    "rmse_exp",
    """SELECT round(sqrt(avg(pow(exp(l_discount) - l_tax, 2))), 6) AS rmse, count(l_tax) AS n FROM lineitem""",
)
def rmse_exp(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return rounded(regress.rmse(lines, "l_tax", "l_discount", link="exp"), 6, "rmse")


@check(
    "residual_hist",
    histogram_sql("SELECT area - a - b * price AS v FROM gap, one WHERE area IS NOT NULL", f"{ONE},"),
)
def residual_hist(spark: SparkSession, sf: str) -> DataFrame:
    listings, fit = _one(spark, sf)
    found = regress.residual_histogram(regress.predict_ols(listings, fit), "area", "predicted")
    return rounded(found, 6, "low", "high")


@check(
    "scenarios",
    f"""WITH {ONE}, asked AS (SELECT neigh, max(price) + 10 AS price FROM gap GROUP BY 1)
    SELECT neigh, price, round(a + b * price, 6) AS predicted FROM asked, one""",
)
def scenarios(spark: SparkSession, sf: str) -> DataFrame:
    listings, fit = _one(spark, sf)
    asked = listings.groupBy("neigh").agg((F.max("price") + 10).alias("price"))
    return rounded(regress.score_scenarios(asked, fit), 6, "predicted")


@check("impute_ols", f"WITH {ONE} SELECT key, round(coalesce(area, a + b * price), 6) AS area FROM gap, one")
def impute_ols(spark: SparkSession, sf: str) -> DataFrame:
    listings, fit = _one(spark, sf)
    return rounded(regress.impute_ols(listings, fit).select("key", "area"), 6, "area")


# --- reduction --------------------------------------------------------------

Z_SQL = "z AS (SELECT key, part, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z_{c}" for c in MEASURES
) + " FROM pts)"


@check("zscore", f"WITH {PTS}, {Z_SQL} SELECT key, " + ", ".join(f"round(z_{c}, 6) AS z_{c}" for c in MEASURES) + " FROM z")
def zscore(spark: SparkSession, sf: str) -> DataFrame:
    names = [f"z_{c}" for c in MEASURES]
    return rounded(reduce.standardize(pts(spark, sf), MEASURES).select("key", *names), 6, *names)


# Two standardised columns have components along the diagonals, with variances 1 + r and 1 - r.
TWO = f"""{LST},
  r AS (SELECT corr(area, price) AS r FROM lst),
  zz AS (SELECT key, neigh, (area - avg(area) OVER ()) / stddev_samp(area) OVER () AS u,
    (price - avg(price) OVER ()) / stddev_samp(price) OVER () AS v FROM lst),
  pc AS (SELECT key, neigh, (u + v) / sqrt(2) AS pc1, (u - v) / sqrt(2) AS pc2 FROM zz)"""


def _two(spark: SparkSession, sf: str) -> tuple[DataFrame, reduce.Components]:
    listings = lst(spark, sf)
    return listings, reduce.fit_pca(listings, ["area", "price"])


@check(
    "pca_table",
    f"""WITH {TWO} SELECT 1 AS component, round(sqrt(1 + r), 6) AS sdev, round((1 + r) / 2, 6) AS share,
      round((1 + r) / 2, 6) AS cumulative FROM r
    UNION ALL SELECT 2, round(sqrt(1 - r), 6), round((1 - r) / 2, 6), 1.0 FROM r""",
)
def pca_table(spark: SparkSession, sf: str) -> DataFrame:
    _, pca = _two(spark, sf)
    return rounded(reduce.pca_table(spark, pca), 6, "sdev", "share", "cumulative")


# The eigenvalues of a correlation matrix of three columns in closed form.
@check(
    "pca_variance",
    f"""WITH {PTS}, c AS (SELECT corr(quantity, price) AS x, corr(quantity, shipped) AS y, corr(price, shipped) AS z FROM pts),
    p AS (SELECT *, sqrt((x * x + y * y + z * z) / 3) AS p FROM c),
    a AS (SELECT p, acos(greatest(-1, least(1, x * y * z / (p * p * p)))) / 3 AS angle FROM p),
    e AS (SELECT 1 + 2 * p * cos(angle) AS e1, 1 + 2 * p * cos(angle + 2 * pi() / 3) AS e3 FROM a)
    SELECT 1 AS component, round(sqrt(e1), 6) AS sdev, round(e1 / 3, 6) AS share, round(e1 / 3, 6) AS cumulative FROM e
    UNION ALL SELECT 2, round(sqrt(3 - e1 - e3), 6), round((3 - e1 - e3) / 3, 6), round((3 - e3) / 3, 6) FROM e
    UNION ALL SELECT 3, round(sqrt(e3), 6), round(e3 / 3, 6), 1.0 FROM e""",
)
def pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    pca = reduce.fit_pca(pts(spark, sf), ["quantity", "price", "shipped"])
    return rounded(reduce.pca_table(spark, pca), 6, "sdev", "share", "cumulative")


@check(
    "pca_loadings",
    f"""WITH {TWO} SELECT c AS "column", k AS component, round(1 / sqrt(2), 6) AS size
    FROM (VALUES ('area'), ('price')) AS n(c), (VALUES (1), (2)) AS m(k)""",
)
def pca_loadings(spark: SparkSession, sf: str) -> DataFrame:
    _, pca = _two(spark, sf)
    found = reduce.pca_loadings(spark, pca)
    return found.select("column", "component", F.round(F.abs("loading"), 6).alias("size"))


# Three columns: the eigenvalues of the correlation matrix by the cubic formula, a vector as the cross product of two rows.
THREE = f"""{PTS}, c AS (SELECT corr(quantity, price) AS r, corr(quantity, discount) AS s, corr(price, discount) AS t FROM pts),
  q AS (SELECT *, sqrt((r * r + s * s + t * t) / 3) AS p FROM c),
  h AS (SELECT *, acos(least(1, greatest(-1, r * s * t / (p * p * p)))) / 3 AS phi FROM q),
  e AS (SELECT k AS component, r, s, t, 1 + 2 * p * cos(phi + 2 * pi() * CASE k WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 1 END / 3) AS l
    FROM h, range(1, 4) AS u(k)),
  v AS (SELECT component, r * t - s * (1 - l) AS a, s * r - (1 - l) * t AS b, (1 - l) * (1 - l) - r * r AS c FROM e),
  n AS (SELECT component, sqrt(a * a + b * b + c * c) AS size, a, b, c,
    CASE WHEN abs(a) >= abs(b) AND abs(a) >= abs(c) THEN sign(a) WHEN abs(b) >= abs(c) THEN sign(b) ELSE sign(c) END AS way FROM v)"""


@check(
    "pca_loadings_three",
    f"""WITH {THREE} SELECT 'quantity' AS "column", CAST(component AS INTEGER) AS component, round(way * a / size, 5) AS loading FROM n
    UNION ALL SELECT 'price', CAST(component AS INTEGER), round(way * b / size, 5) FROM n
    UNION ALL SELECT 'discount', CAST(component AS INTEGER), round(way * c / size, 5) FROM n""",
)
def pca_loadings_three(spark: SparkSession, sf: str) -> DataFrame:
    pca = reduce.fit_pca(pts(spark, sf), ["quantity", "price", "discount"])
    return rounded(reduce.pca_loadings(spark, pca), 5, "loading")


@check("pca_scores", f"WITH {TWO} SELECT key, round(abs(pc1), 6) AS pc1, round(abs(pc2), 6) AS pc2 FROM pc")
def pca_scores(spark: SparkSession, sf: str) -> DataFrame:
    listings, pca = _two(spark, sf)
    scores = reduce.pca_scores(listings, pca)
    return scores.select("key", F.round(F.abs("pc1"), 6).alias("pc1"), F.round(F.abs("pc2"), 6).alias("pc2"))


@check("pca_inverse", f"WITH {PTS} SELECT key, " + ", ".join(f"round({c}, 5) AS {c}" for c in MEASURES) + " FROM pts")
def pca_inverse(spark: SparkSession, sf: str) -> DataFrame:
    points = pts(spark, sf)
    pca = reduce.fit_pca(points, MEASURES)
    back = reduce.pca_inverse(reduce.pca_scores(points, pca), pca)
    return back.select("key", *[F.round(f"{c}_back", 5).alias(c) for c in MEASURES])


def component_f(name: str, at: int) -> str:
    return f"""SELECT '{name}' AS component, (SELECT f FROM (
      SELECT sum(n * m * m) / (count(*) - 1) / (sum((n - 1) * v) / (sum(n) - count(*))) AS f,
      FROM (SELECT neigh, count(*) AS n, avg({name}) AS m, var_samp({name}) AS v FROM pc GROUP BY 1) AS g) AS t) AS f"""


@check(
    "rank_components",
    f"WITH {TWO} SELECT component, round(f, 4) AS f FROM ({component_f('pc1', 1)} UNION ALL {component_f('pc2', 2)}) AS t",
)
def rank_components(spark: SparkSession, sf: str) -> DataFrame:
    listings, pca = _two(spark, sf)
    ranked = groups.rank_components(reduce.pca_scores(listings, pca), pca.names(), "neigh")
    return rounded(ranked.select("component", "f"), 4, "f")


# --- neighbours -------------------------------------------------------------

DISTANCE = " + ".join(f"(z.z_{c} - q.z_{c}) * (z.z_{c} - q.z_{c})" for c in MEASURES)


@check(
    "nearest_one",
    f"""WITH {PTS}, {Z_SQL}, q AS (SELECT * FROM z ORDER BY md5(key || '|3'), key LIMIT 1)
    SELECT z.key, round({DISTANCE}, 6) AS distance FROM z, q ORDER BY {DISTANCE}, z.key LIMIT 5""",
)
def nearest_one(spark: SparkSession, sf: str) -> DataFrame:
    points = pts(spark, sf)
    pca = reduce.fit_pca(points, MEASURES)
    one = sample_rows(points, "key", seed=3).first().asDict()
    near = reduce.nearest_similar(points, pca, one, "key")
    return rounded(near.select("key", "distance"), 6, "distance")


# For every brand, the order lines nearest to the average line of its parts.
MANY_SQL = f"""WITH {PTS}, {Z_SQL},
  q AS (SELECT p_brand AS brand, {", ".join(f"avg(z_{c}) AS z_{c}" for c in MEASURES)}
    FROM z JOIN part ON part = p_partkey GROUP BY 1),
  d AS (SELECT brand, z.key, {DISTANCE} AS distance FROM z, q)
  SELECT brand, key, round(distance, 6) AS distance,
    CAST(row_number() OVER (PARTITION BY brand ORDER BY distance, key) AS INTEGER) AS place
  FROM d QUALIFY place <= 5"""


def _many(spark: SparkSession, sf: str, **options: int) -> DataFrame:
    names = [f"z_{c}" for c in MEASURES]
    scaled = reduce.standardize(pts(spark, sf), MEASURES)
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("brand"))
    average = join_dimension(scaled, parts, "part").groupBy("brand").agg(*[F.avg(c).alias(c) for c in names])
    near = reduce.nearest_many(scaled, average, names, "key", "brand", **options)
    return rounded(near, 6, "distance")


@check("nearest_many", MANY_SQL)
def nearest_many(spark: SparkSession, sf: str) -> DataFrame:
    return _many(spark, sf)


@check("nearest_many_blocks", MANY_SQL)
def nearest_many_blocks(spark: SparkSession, sf: str) -> DataFrame:
    # The way taken when there are too many queries to send to every task.
    return _many(spark, sf, query_block=8)


# For every supplier, the order lines nearest to the average line, both sides as tables.
JOIN_SQL = f"""WITH {PTS}, {Z_SQL},
  q AS (SELECT l.l_suppkey AS supplier, {", ".join(f"avg(z_{c}) AS z_{c}" for c in MEASURES)}
    FROM z JOIN (SELECT DISTINCT l_suppkey, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
         || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS key FROM lineitem) AS l USING (key) GROUP BY 1),
  d AS (SELECT supplier, z.key, {DISTANCE} AS distance FROM z, q)
  SELECT supplier, key, round(distance, 6) AS distance,
    CAST(row_number() OVER (PARTITION BY supplier ORDER BY distance, key) AS INTEGER) AS place
  FROM d QUALIFY place <= 5"""


def _suppliers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    names = [f"z_{c}" for c in MEASURES]
    scaled = reduce.standardize(pts(spark, sf), MEASURES)
    supplier = F.substring_index("key", "-", -1).cast("long").alias("supplier")
    return scaled, scaled.groupBy(supplier).agg(*[F.avg(c).alias(c) for c in names]), names


@check("nearest_join", JOIN_SQL)
def nearest_join(spark: SparkSession, sf: str) -> DataFrame:
    scaled, average, names = _suppliers(spark, sf)
    return rounded(neighbours.nearest_join(scaled, average, names, "key", "supplier"), 6, "distance")


# The index's answer as bounds of the exact one.
@check("nearest_index_exact", JOIN_SQL)
def nearest_index_exact(spark: SparkSession, sf: str) -> DataFrame:
    scaled, average, names = _suppliers(spark, sf)
    index = neighbours.build_index(scaled, names, "key")
    near = neighbours.nearest_index(index, average, names, "key", "supplier", exact=True)
    return rounded(near, 6, "distance")


# Every twentieth vector against all vectors.
@check(
    "nearest_vectors",
    """WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 20 = 0),
  d AS (SELECT query_id, vec_id, pow(list_distance(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])), 2) AS distance
    FROM embeddings, q)
  SELECT query_id, vec_id, round(distance, 6) AS distance,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS place
  FROM d QUALIFY place <= 10""",
)
def nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vectors, some = _vectors(spark, sf)
    return rounded(neighbours.nearest_join(vectors, some, "embedding", "vec_id", "query_id", k=10), 6, "distance")


def _vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return vectors, vectors.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")


# Approximate, so SQL can't give its rows; a test measures its recall.
@check("nearest_index")
def nearest_index(spark: SparkSession, sf: str) -> DataFrame:
    vectors, some = _vectors(spark, sf)
    index = neighbours.build_index(vectors, "embedding", "vec_id")
    return neighbours.nearest_index(index, some, "embedding", "vec_id", "query_id", k=10)


# Ranks of a column that crowds at one end, in parts of 5000 rows; the ranks of equal values are taken together.
@check(
    "rank_crowded",
    """SELECT l_extendedprice AS price, CAST(min(r) AS BIGINT) AS first, CAST(max(r) AS BIGINT) AS last
    FROM (SELECT l_extendedprice, row_number() OVER (ORDER BY l_extendedprice) AS r FROM lineitem) AS ranked GROUP BY 1""",
)
def rank_crowded(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("x", F.pow(F.col("l_extendedprice") / 100_000, F.lit(60)))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    ranked = order.global_rank(lines.select("l_extendedprice", "x", *keys), "x", keys, "r", buckets=8, part_rows=5_000)
    return ranked.groupBy(F.col("l_extendedprice").alias("price")).agg(F.min("r").alias("first"), F.max("r").alias("last"))


# --- the study --------------------------------------------------------------


# Areas in square feet, unknown in one neighbourhood; areas under 20 m2 are doubtful.
STUDY = f"""{LST},
  raw AS (SELECT key, neigh, size, price, round(CASE WHEN neigh <> 'N1' THEN area / 0.092903 END * 0.092903, 2) AS m FROM lst),
  clean AS (SELECT key, neigh, size, price, CASE WHEN m >= 20 THEN m END AS m FROM raw
    WHERE neigh IN (SELECT neigh FROM raw GROUP BY 1 HAVING count(CASE WHEN m >= 20 THEN m END) > 0)),
  {stats_sql('m', 'neigh', 'clean')}, {PAIRS}, {TAIL}, {distances_sql()},
  {linkage_sql('gaps', "(SELECT DISTINCT neigh AS member FROM clean) AS t", 9)}, {cut_sql(9, '1.0')},
  listed AS (SELECT clean.*, cluster FROM clean JOIN cut ON neigh = member),
  drawn AS (SELECT *, row_number() OVER (ORDER BY substr(md5(CAST(key AS VARCHAR) || '|0'), 1, 13), key)
    <= floor(0.75 * count(*) OVER ()) AS train FROM listed),
  c AS (SELECT covar_pop(price, price) AS xx, covar_pop(cluster, cluster) AS tt, covar_pop(price, cluster) AS xt,
    covar_pop(price, m) AS xy, covar_pop(cluster, m) AS ty, avg(price) AS mx, avg(cluster) AS mt, avg(m) AS my
    FROM drawn WHERE train AND m IS NOT NULL),
  b AS (SELECT *, CASE WHEN tt = 0 THEN xy / xx ELSE (xy * tt - ty * xt) / (xx * tt - xt * xt) END AS bx,
    CASE WHEN tt = 0 THEN 0 ELSE (ty * xx - xy * xt) / (xx * tt - xt * xt) END AS bt FROM c),
  guess AS (SELECT drawn.*, my + bx * (price - mx) + bt * (cluster - mt) AS p FROM drawn, b)"""


def _study(spark: SparkSession, sf: str) -> Study:
    feet = F.when(F.col("neigh") != "N1", F.col("area") / 0.092903)
    config = StudyConfig(
        key="key",
        group="neigh",
        models=(("price", "neighb_id"), ("neighb_id",)),
        similar_on=("size", "price", "square_meters"),
    )
    return run_listing_study(lst(spark, sf).withColumn("square_feet", feet).drop("area"), config)


@check(
    "listing_study",
    f"""WITH {STUDY} SELECT key, neigh, cluster AS neighb_id, size, price,
      round(coalesce(m, p), 5) AS square_meters FROM guess""",
)
def listing_study(spark: SparkSession, sf: str) -> DataFrame:
    found = _study(spark, sf).listings
    return rounded(found.select("key", "neigh", "neighb_id", "size", "price", "square_meters"), 5, "square_meters")


@check(
    "listing_study_null_shares",
    f"""WITH {STUDY} SELECT 'square_feet' AS "column",
      (SELECT round(avg(CASE WHEN neigh = 'N1' THEN 100.0 ELSE 0 END), 6) FROM lst) AS before,
      (SELECT round(avg(CASE WHEN neigh = 'N1' THEN 100.0 ELSE 0 END), 6) FROM clean) AS after
    UNION ALL SELECT 'square_meters', NULL,
      (SELECT round(avg(CASE WHEN m IS NULL THEN 100.0 ELSE 0 END), 6) FROM clean)""",
)
def listing_study_null_shares(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_study(spark, sf).null_shares(["square_feet", "square_meters"]), 6, "before", "after")


@check(
    "listing_study_clusters",
    f"WITH {STUDY} SELECT neigh, cluster AS neighb_id, count(*) AS n FROM listed GROUP BY 1, 2",
)
def listing_study_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf).clusters_by_group()


@check(
    "listing_study_error",
    f"WITH {STUDY} SELECT round(sqrt(avg((p - m) * (p - m))), 5) AS rmse, count(m) AS n FROM guess WHERE NOT train",
)
def listing_study_error(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_study(spark, sf).errors[0], 5, "rmse")


@check(
    "listing_study_residuals",
    histogram_sql("SELECT m - p AS v FROM guess WHERE NOT train AND m IS NOT NULL", f"{STUDY},"),
)
def listing_study_residuals(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_study(spark, sf).residuals(), 6, "low", "high")


@check(
    "listing_study_scenarios",
    f"""WITH {STUDY}, asked AS (SELECT neigh, max(price) + 10 AS price FROM lst GROUP BY 1)
    SELECT neigh, price, cluster AS neighb_id, round(my + bx * (price - mx) + bt * (cluster - mt), 5) AS predicted
    FROM asked LEFT JOIN cut ON neigh = member, b""",
)
def listing_study_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    # A neighbourhood without a known area has no cluster and so no prediction.
    asked = lst(spark, sf).groupBy("neigh").agg((F.max("price") + 10).alias("price"))
    return rounded(_study(spark, sf).score(asked), 5, "predicted")


SIMILAR_ON = ["size", "price", "area"]
SIMILAR_GAP = " + ".join(f"pow((f.{c} - o.{c}) / w.d_{c}, 2)" for c in SIMILAR_ON)


@check(
    "listing_study_similar",
    f"""WITH {STUDY}, filled AS (SELECT key, size, price, coalesce(m, p) AS area FROM guess),
    w AS (SELECT {", ".join(f"stddev_samp({c}) AS d_{c}" for c in SIMILAR_ON)} FROM filled),
    o AS (SELECT * FROM filled ORDER BY md5(CAST(key AS VARCHAR) || '|0'), key LIMIT 1)
    SELECT f.key, round({SIMILAR_GAP}, 5) AS distance FROM filled AS f, o, w ORDER BY {SIMILAR_GAP}, f.key LIMIT 5""",
)
def listing_study_similar(spark: SparkSession, sf: str) -> DataFrame:
    study = _study(spark, sf)
    one = sample_rows(study.listings, "key").first().asDict()
    return rounded(study.similar(one).select("key", "distance"), 5, "distance")
