"""Listings: row operators, samples, profiles, group comparison and clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import DEV, GAP, LAB, LST, check, dev, gap, lab, lst, plain_time, rounded, table
from tidemark.functions import scalar
from tidemark.operators import groups, joins, profile, rows, sampling
from tidemark.plans.study import cluster_groups

# --- rows -------------------------------------------------------------------


@check("project_columns", f"WITH {LST} SELECT key, room, neigh, price FROM lst")
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return rows.project(lst(spark, sf), ["key", "room", "neigh", "price"])


@check("filter_equal", f"WITH {LST} SELECT * FROM lst WHERE city = 'Brand#2' AND room = 'ECONOMY'")
def filter_equal(spark: SparkSession, sf: str) -> DataFrame:
    return rows.keep_equal(lst(spark, sf), {"city": "Brand#2", "room": "ECONOMY"})


BLANK = "blank AS (SELECT key, CASE neigh WHEN 'N3' THEN '' WHEN 'N4' THEN NULL ELSE neigh END AS neigh FROM lst)"


@check("filter_nonempty", f"WITH {LST}, {BLANK} SELECT * FROM blank WHERE neigh IS NOT NULL AND neigh <> ''")
def filter_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    neigh = F.col("neigh")
    blank = lst(spark, sf).select(
        "key", F.when(neigh == "N3", "").when(neigh == "N4", F.lit(None)).otherwise(neigh).alias("neigh")
    )
    return rows.keep_nonempty(blank, "neigh")


@check("head_n", f"WITH {LST} SELECT key, size, price FROM lst ORDER BY size DESC, key LIMIT 5")
def head_n(spark: SparkSession, sf: str) -> DataFrame:
    return rows.head_n(lst(spark, sf).select("key", "size", "price"), 5, [F.desc("size"), "key"])


@check("unit_convert", "SELECT o_orderkey, round(o_totalprice * 0.092903, 2) AS meters FROM orders")
def unit_convert(spark: SparkSession, sf: str) -> DataFrame:
    meters = scalar.convert_units(F.col("o_totalprice"), scalar.SQUARE_METERS_PER_SQUARE_FOOT)
    return table(spark, sf, "orders").select("o_orderkey", meters.alias("meters"))


@check("epoch_to_ts", f"WITH {DEV} SELECT timestamp AS seconds, make_timestamp(timestamp * 1000000) AS at FROM dev")
def epoch_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(
        dev(spark, sf).select(
            F.col("timestamp").alias("seconds"), scalar.epoch_to_ts(F.col("timestamp")).alias("at")
        ),
        "at",
    )


@check(
    "date_parts",
    """SELECT o_orderkey, CAST(date_part('year', o_orderdate) AS INTEGER) AS year,
    CAST(date_part('month', o_orderdate) AS INTEGER) AS month,
    CAST(date_part('day', o_orderdate) AS INTEGER) AS day,
    CAST(date_part('hour', o_orderdate) AS INTEGER) AS hour FROM orders""",
)
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return scalar.with_date_parts(table(spark, sf, "orders"), "o_orderdate").select(
        "o_orderkey", "year", "month", "day", "hour"
    )


@check("null_when_zero", "SELECT doc_id, nullif(quality, 0) AS quality FROM labels")
def null_when_zero(spark: SparkSession, sf: str) -> DataFrame:
    known = scalar.null_when(F.col("quality"), F.col("quality") == 0)
    return table(spark, sf, "labels").select("doc_id", known.alias("quality"))


@check("null_when_below", f"WITH {LST} SELECT key, CASE WHEN size >= 20 THEN size END AS size FROM lst")
def null_when_below(spark: SparkSession, sf: str) -> DataFrame:
    known = scalar.null_when(F.col("size"), F.col("size") < 20)
    return lst(spark, sf).select("key", known.alias("size"))


@check("fill_from", f"WITH {LST}, {GAP} SELECT key, coalesce(area, price) AS area FROM gap")
def fill_from(spark: SparkSession, sf: str) -> DataFrame:
    filled = scalar.fill_from(F.col("area"), F.col("price"))
    return gap(spark, sf).select("key", filled.alias("area"))


@check("drop_incomplete", f"WITH {LAB} SELECT * FROM lab WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def drop_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    return rows.drop_incomplete(lab(spark, sf))


# --- samples ----------------------------------------------------------------

ORDER_DRAW = """drawn AS (SELECT o_orderkey, o_custkey, o_totalprice,
  md5(CAST(o_orderkey AS VARCHAR) || '|7') AS digest FROM orders)"""


@check(
    "sample_rows",
    f"WITH {ORDER_DRAW} SELECT o_orderkey, o_custkey, o_totalprice FROM drawn ORDER BY digest, o_orderkey LIMIT 10",
)
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.sample_rows(orders, "o_orderkey", 10, seed=7)


DRAWN = f"""{ORDER_DRAW}, split AS (SELECT o_orderkey, o_custkey,
  CAST('0x' || substr(digest, 1, 13) AS BIGINT) < CAST(0.75 * pow(2, 52) AS BIGINT) AS chosen FROM drawn)"""


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey")


@check("split_train", f"WITH {DRAWN} SELECT o_orderkey, o_custkey FROM split WHERE chosen")
def split_train(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_rows(_orders(spark, sf), "o_orderkey", 0.75, seed=7)[0]


@check("split_test", f"WITH {DRAWN} SELECT o_orderkey, o_custkey FROM split WHERE NOT chosen")
def split_test(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_rows(_orders(spark, sf), "o_orderkey", 0.75, seed=7)[1]


@check(
    "split_exact",
    f"""WITH {ORDER_DRAW} SELECT o_orderkey, o_custkey FROM drawn
    QUALIFY row_number() OVER (ORDER BY substr(digest, 1, 13), o_orderkey)
            <= floor(0.75 * count(*) OVER ())""",
)
def split_exact(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_rows(_orders(spark, sf), "o_orderkey", 0.75, seed=7, exact=True)[0]


@check(
    "split_counts",
    """SELECT 'train' AS part, CAST(floor(count(*) * 0.75) AS BIGINT) AS n FROM orders
    UNION ALL SELECT 'test', count(*) - CAST(floor(count(*) * 0.75) AS BIGINT) FROM orders""",
)
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    train, test = sampling.split_rows(_orders(spark, sf), "o_orderkey", 0.75, seed=7, exact=True)
    parts = [
        profile.row_count(part).select(F.lit(name).alias("part"), "n")
        for name, part in (("train", train), ("test", test))
    ]
    return parts[0].unionByName(parts[1])


# --- profiles ---------------------------------------------------------------


@check(
    "null_share",
    f"""WITH {LAB}, s AS (SELECT count(*) AS n, count(quality) AS q, count(toxic) AS t, count(lang) AS l FROM lab)
    SELECT 'quality' AS "column", round((n - q) * 100.0 / n, 6) AS percent FROM s
    UNION ALL SELECT 'toxic', round((n - t) * 100.0 / n, 6) FROM s
    UNION ALL SELECT 'lang', round((n - l) * 100.0 / n, 6) FROM s""",
)
def null_share(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.null_share(lab(spark, sf), ["quality", "toxic", "lang"]), 6, "percent")


@check(
    "zero_share",
    f"WITH {LAB} SELECT round(count(*) FILTER (WHERE quality = 0) * 1.0 / count(quality), 6) AS share FROM lab",
)
def zero_share(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.value_share(lab(spark, sf), "quality", 0), 6, "share")


@check("nonnull_by_group", f"WITH {LST}, {GAP} SELECT neigh, count(area) AS known FROM gap GROUP BY 1")
def nonnull_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return profile.nonnull_by_group(gap(spark, sf), "neigh", "area")


@check(
    "drop_empty_groups",
    f"WITH {LST}, {GAP} SELECT * FROM gap WHERE neigh IN (SELECT neigh FROM gap GROUP BY 1 HAVING count(area) > 0)",
)
def drop_empty_groups(spark: SparkSession, sf: str) -> DataFrame:
    return joins.drop_groups_without(gap(spark, sf), "neigh", "area")


@check("freq", f"WITH {LST} SELECT neigh, count(*) AS n FROM lst GROUP BY 1")
def freq(spark: SparkSession, sf: str) -> DataFrame:
    return profile.freq(lst(spark, sf), "neigh")


CELLS = """SELECT r.neigh, c.city, CAST(count(l.key) AS BIGINT) AS n
FROM (SELECT DISTINCT neigh FROM lst) AS r CROSS JOIN (SELECT DISTINCT city FROM lst) AS c
LEFT JOIN lst AS l ON l.neigh = r.neigh AND l.city = c.city GROUP BY 1, 2"""


@check("contingency", f"WITH {LST} {CELLS}")
def contingency(spark: SparkSession, sf: str) -> DataFrame:
    return profile.contingency(lst(spark, sf), "neigh", "city")


@check(
    "contingency_wide",
    """WITH r AS (SELECT DISTINCT o_orderstatus FROM orders), c AS (SELECT DISTINCT o_orderkey FROM orders),
    n AS (SELECT o_orderstatus, o_orderkey, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT o_orderstatus, o_orderkey, coalesce(n, 0) AS n FROM r CROSS JOIN c LEFT JOIN n USING (o_orderstatus, o_orderkey)""",
)
def contingency_wide(spark: SparkSession, sf: str) -> DataFrame:
    # More than ten thousand column values.
    return profile.contingency(table(spark, sf, "orders"), "o_orderstatus", "o_orderkey")


@check("distinct_sorted", f"WITH {LST} SELECT DISTINCT neigh FROM lst ORDER BY 1")
def distinct_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_sorted(lst(spark, sf), "neigh")


def histogram_sql(values: str, ctes: str = "", bins: int = 20) -> str:
    """Counts over about ``bins`` round bins of the column ``v`` of ``values``."""
    return f"""WITH {ctes} vals AS ({values}),
  ends AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {bins} AS cell FROM vals),
  units AS (SELECT *, pow(10, floor(log10(cell))) AS unit FROM ends),
  steps AS (SELECT *, CASE
      WHEN NOT 2 * unit - cell < 1.5 * (cell - unit) THEN unit
      WHEN NOT 5 * unit - cell < 2.75 * (cell - 2 * unit) THEN 2 * unit
      WHEN NOT 10 * unit - cell < 1.5 * (cell - 5 * unit) THEN 5 * unit
      ELSE 10 * unit END AS step FROM units),
  frame AS (SELECT step, floor(lo / step) AS first, ceil(hi / step) AS last FROM steps),
  bins AS (SELECT greatest(1, CAST(ceil(round(v / step, 7) - first) AS BIGINT)) AS bin, count(*) AS n
        FROM vals, frame GROUP BY 1),
  every AS (SELECT unnest(range(1, CAST(last - first AS BIGINT) + 1)) AS bin, step, first FROM frame)
SELECT every.bin, round((every.bin - 1 + first) * step, 6) AS low, round((every.bin + first) * step, 6) AS high,
       coalesce(bins.n, 0) AS n FROM every LEFT JOIN bins ON every.bin = bins.bin"""


@check("histogram", histogram_sql("SELECT l_extendedprice AS v FROM lineitem"))
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    found = profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(found, 6, "low", "high")


@check("histogram_doc_length", histogram_sql("SELECT CAST(n_chars AS DOUBLE) AS v FROM documents"))
def histogram_doc_length(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.histogram(table(spark, sf, "documents"), "n_chars"), 6, "low", "high")


# --- group comparison -------------------------------------------------------


def stats_sql(value: str, group: str, source: str) -> str:
    return f"""st AS (SELECT {group} AS g, count({value}) AS n, avg({value}) AS m,
    coalesce(var_samp({value}), 0) AS v FROM {source} WHERE {value} IS NOT NULL GROUP BY 1),
  gm AS (SELECT sum(n * m) / sum(n) AS grand, count(*) AS k, sum(n) AS total FROM st),
  an AS (SELECT any_value(k) AS k, any_value(k) - 1 AS df_between, any_value(total) - any_value(k) AS df_within,
    sum(n * (m - grand) * (m - grand)) AS ss_between, sum((n - 1) * v) AS ss_within FROM st, gm)"""


@check(
    "anova",
    f"""WITH {LST}, {stats_sql('area', 'neigh', 'lst')}
    SELECT CAST(k AS BIGINT) AS k, CAST(df_between AS BIGINT) AS df_between, CAST(df_within AS BIGINT) AS df_within,
      round(ss_between, 4) AS ss_between, round(ss_within, 4) AS ss_within,
      round(ss_within / df_within, 6) AS ms_within,
      round(ss_between / df_between / (ss_within / df_within), 4) AS f FROM an""",
)
def anova(spark: SparkSession, sf: str) -> DataFrame:
    found = groups.anova_oneway(lst(spark, sf), "area", "neigh")
    return rounded(rounded(found, 4, "ss_between", "ss_within", "f"), 6, "ms_within")


PAIRS = """pr AS (SELECT x.g AS a, y.g AS b, y.m - x.m AS diff,
    sqrt(ss_within / df_within / 2 * (1.0 / x.n + 1.0 / y.n)) AS se, k, df_within
  FROM st AS x JOIN st AS y ON x.g < y.g, an)"""


@check(
    "tukey_q",
    f"""WITH {LST}, {stats_sql('area', 'neigh', 'lst')}, {PAIRS}
    SELECT a, b, round(diff, 6) AS diff, round(se, 6) AS se, round(abs(diff) / se, 6) AS q FROM pr""",
)
def tukey_q(spark: SparkSession, sf: str) -> DataFrame:
    pairs = groups.tukey_pairs(lst(spark, sf), "area", "neigh")
    return rounded(pairs.select("a", "b", "diff", "se", "q"), 6, "diff", "se", "q")


def normal_cdf_sql(x: str) -> str:
    """Standard normal distribution function by a published rational approximation."""

    def horner(coefficients: list[float]) -> str:
        text = repr(coefficients[0])
        for value in coefficients[1:]:
            text = f"({text} * least(abs({x}), 7.07) + {value!r})"
        return text

    # Hart's approximation of 1968, good to 15 digits up to 7.07.
    upper = [
        3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
        112.079291497871, 221.213596169931, 220.206867912376,
    ]
    lower = [
        8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
        296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
    ]
    tail = f"(exp(-0.5 * ({x}) * ({x})) * {horner(upper)} / {horner(lower)})"
    return f"(CASE WHEN ({x}) > 0 THEN 1 - {tail} ELSE {tail} END)"


# The range of k normals integrated over the largest, then over the scale s.
TAIL = f"""zs AS (SELECT z, {normal_cdf_sql('z')} AS cdf, exp(-0.5 * z * z) / sqrt(2 * pi()) AS pdf
    FROM (SELECT -8 + 0.1 * i AS z FROM range(0, 161) AS r(i)) AS grid),
  ss AS (SELECT s, exp((df_within - 1) * ln(s) - df_within * (s * s - 1) / 2) AS weight
    FROM (SELECT df_within, 1 + (i - 40) * 0.2 / sqrt(2 * df_within) AS s
          FROM an, range(0, 81) AS r(i)) AS grid WHERE s > 0),
  qs AS (SELECT a, b, diff, se, k, abs(diff) / se AS q FROM pr),
  below AS (SELECT a, b, s, any_value(weight) AS weight,
      sum(any_k * pdf * pow(greatest(cdf - {normal_cdf_sql('z - w')}, 0), any_k - 1)) * 0.1 AS p
    FROM (SELECT a, b, k AS any_k, s, weight, z, cdf, pdf, q * s AS w FROM qs, ss, zs) AS x GROUP BY a, b, s),
  tail AS (SELECT a, b, greatest(1 - sum(weight * p) / sum(weight), 0) AS p FROM below GROUP BY a, b)"""


@check(
    "tukey_p",
    f"""WITH {LST}, {stats_sql('size', 'room', 'lst')}, {PAIRS}, {TAIL}
    SELECT a, b, round(q, 6) AS q, round(p, 5) AS p FROM qs JOIN tail USING (a, b)""",
)
def tukey_p(spark: SparkSession, sf: str) -> DataFrame:
    pairs = groups.tukey_pairs(lst(spark, sf), "size", "room")
    return rounded(rounded(pairs.select("a", "b", "q", "p"), 6, "q"), 5, "p")


@check(
    "pair_matrix",
    f"""WITH {LST}, {stats_sql('size', 'room', 'lst')}, {PAIRS}, {TAIL}
    SELECT a, b, round(p, 4) AS value FROM tail UNION ALL SELECT b, a, round(p, 4) FROM tail
    UNION ALL SELECT g, g, 1.0 FROM st""",
)
def pair_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return groups.symmetric_pairs(groups.tukey_pairs(lst(spark, sf), "size", "room"), "p")


MEASURED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@check(
    "unpivot",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, '{c}' AS name, {c} AS value FROM lineitem"
        for c in MEASURED
    ),
)
def unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return groups.unpivot(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], MEASURED
    )


# --- clustering of groups ---------------------------------------------------

GAPS = f"""cells AS ({CELLS}),
  gaps AS (SELECT x.neigh AS a, y.neigh AS b, sqrt(sum((x.n - y.n) * (x.n - y.n))) AS distance
    FROM cells AS x JOIN cells AS y ON x.city = y.city AND x.neigh < y.neigh GROUP BY 1, 2)"""


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    return groups.row_distances(profile.contingency(lst(spark, sf), "neigh", "city"), "neigh", "city", "n")


@check("row_distances", f"WITH {LST}, {GAPS} SELECT a, b, round(distance, 6) AS distance FROM gaps")
def row_distances(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_gaps(spark, sf), 6, "distance")


# A long matrix most of whose cells are missing.
SPARSE = f"""{LST}, cells AS (SELECT city, key % 211 AS col, sum(price) AS v FROM lst GROUP BY 1, 2),
  w AS (SELECT count(DISTINCT col) AS width FROM cells), r AS (SELECT DISTINCT city FROM cells)"""


@check(
    "row_distances_sparse",
    f"""WITH {SPARSE},
    met AS (SELECT x.city AS a, y.city AS b, sum((x.v - y.v) * (x.v - y.v)) AS s, count(*) AS n
      FROM cells AS x JOIN cells AS y ON x.col = y.col AND x.city < y.city GROUP BY 1, 2)
    SELECT p.city AS a, q.city AS b, round(sqrt(s * width / n), 4) AS distance
    FROM r AS p JOIN r AS q ON p.city < q.city CROSS JOIN w LEFT JOIN met ON a = p.city AND b = q.city""",
)
def row_distances_sparse(spark: SparkSession, sf: str) -> DataFrame:
    cells = lst(spark, sf).groupBy("city", (F.col("key") % 211).alias("col")).agg(F.sum("price").alias("v"))
    return rounded(groups.row_distances(cells, "city", "col", "v"), 4, "distance")


def linkage_sql(gaps: str, members: str, most: int) -> str:
    """Complete linkage, one merge after the other, for at most ``most`` members."""
    text = f"""g0 AS MATERIALIZED (SELECT a, b, distance AS d FROM {gaps}),
  r0 AS MATERIALIZED (SELECT member, member AS rep FROM {members})"""
    for i in range(1, most):
        text += f""",
  m{i} AS MATERIALIZED (SELECT a AS l, b AS r, d FROM g{i - 1} ORDER BY d, a, b LIMIT 1),
  g{i} AS MATERIALIZED (SELECT least(x, y) AS a, greatest(x, y) AS b, max(d) AS d FROM (
      SELECT CASE WHEN a = m.r THEN m.l ELSE a END AS x, CASE WHEN b = m.r THEN m.l ELSE b END AS y, g.d
      FROM g{i - 1} AS g, m{i} AS m) AS t WHERE x <> y GROUP BY 1, 2),
  r{i} AS MATERIALIZED (SELECT member, CASE WHEN rep = m.r THEN m.l ELSE rep END AS rep
      FROM r{i - 1} LEFT JOIN m{i} AS m ON true)"""
    merges = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS step, l AS \"left\", r AS \"right\", d AS height, "
        f"(SELECT count(*) FROM r{i} WHERE rep = l) AS size FROM m{i}"
        for i in range(1, most)
    )
    return f"{text},\n  merges AS (SELECT * FROM ({merges}) AS t)"


def cut_sql(most: int, height: str) -> str:
    """Cluster numbers when the merges up to ``height`` are kept."""
    # Heights never fall, so the last kept merge fixes the clusters.
    choice = " ".join(
        f"WHEN (SELECT count(*) FROM merges WHERE height <= {height}) = {i} THEN r{i}.rep" for i in range(1, most)
    )
    joined = " ".join(f"JOIN r{i} ON r{i}.member = r0.member" for i in range(1, most))
    return f"""tops AS (SELECT r0.member, CASE {choice} ELSE r0.rep END AS top FROM r0 {joined}),
  cut AS (SELECT member, CAST(dense_rank() OVER (ORDER BY top) AS INTEGER) AS cluster FROM tops)"""


NEIGHS = "(SELECT DISTINCT neigh AS member FROM lst) AS t"
CUT_AT = 19.0
LINKED = f"WITH {LST}, {GAPS}, {linkage_sql('gaps', NEIGHS, 10)}"


@check("linkage", f"""{LINKED} SELECT step, "left", "right", round(height, 6) AS height, size FROM merges""")
def linkage(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(groups.complete_linkage(_gaps(spark, sf)), 6, "height")


@check(
    "linkage_in_rounds",
    f"""{LINKED} SELECT step, "left", "right", round(height, 6) AS height, size FROM merges""",
)
def linkage_in_rounds(spark: SparkSession, sf: str) -> DataFrame:
    # The way taken when there are too many members for one task.
    return rounded(groups.complete_linkage(_gaps(spark, sf), local_members=1), 6, "height")


@check(
    "upper_merges",
    f"""{LINKED} SELECT step, "left", "right", round(height, 6) AS height, size FROM merges
    WHERE height > {CUT_AT}""",
)
def upper_merges(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(groups.upper_merges(groups.complete_linkage(_gaps(spark, sf)), CUT_AT), 6, "height")


@check("cut_clusters", f"{LINKED}, {cut_sql(10, str(CUT_AT))} SELECT member, cluster FROM cut")
def cut_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return groups.cut_clusters(groups.complete_linkage(_gaps(spark, sf)), CUT_AT)


@check(
    "attach_cluster",
    f"{LINKED}, {cut_sql(10, str(CUT_AT))} SELECT lst.*, cluster AS neighb_id FROM lst JOIN cut ON neigh = member",
)
def attach_cluster(spark: SparkSession, sf: str) -> DataFrame:
    clusters = groups.cut_clusters(groups.complete_linkage(_gaps(spark, sf)), CUT_AT)
    return groups.attach_cluster(lst(spark, sf), clusters, "neigh")


def distances_sql() -> str:
    """Distances between the rows of one minus the p-values."""
    return """unlike AS (SELECT a, b, 1 - round(p, 4) AS v FROM tail UNION ALL SELECT b, a, 1 - round(p, 4) FROM tail
    UNION ALL SELECT g, g, 0.0 FROM st),
  gaps AS (SELECT x.a AS a, y.a AS b, sqrt(sum((x.v - y.v) * (x.v - y.v))) AS distance
    FROM unlike AS x JOIN unlike AS y ON x.b = y.b AND x.a < y.a GROUP BY 1, 2)"""


# Tests, matrix, distances, linkage and cut in one go, as the study does it.
ALIKE = f"{stats_sql('area', 'neigh', 'lst')}, {PAIRS}, {TAIL}, {distances_sql()}"


@check(
    "similar_groups",
    f"WITH {LST}, {ALIKE}, {linkage_sql('gaps', NEIGHS, 10)}, {cut_sql(10, '1.0')} SELECT member, cluster FROM cut",
)
def similar_groups(spark: SparkSession, sf: str) -> DataFrame:
    return cluster_groups(lst(spark, sf), "area", "neigh", 1.0)[2]
