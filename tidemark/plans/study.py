"""Listing study: clean, group, fit, impute and find similar listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import SQUARE_METERS_PER_SQUARE_FOOT, convert_units, null_when
from tidemark.operators.groups import (
    attach_cluster,
    complete_linkage,
    cut_clusters,
    rank_components,
    row_distances,
    symmetric_pairs,
    tukey_pairs,
)
from tidemark.operators.joins import drop_groups_without
from tidemark.operators.profile import contingency, freq, histogram, null_share, value_share
from tidemark.operators.reduce import Components, fit_pca, nearest_similar, pca_scores
from tidemark.operators.regress import (
    LinearFit,
    fit_ols,
    impute_ols,
    predict_ols,
    residual_histogram,
    rmse,
    score_scenarios,
)
from tidemark.operators.rows import drop_incomplete, keep_equal, keep_nonempty
from tidemark.operators.sampling import split_rows
from tidemark.session import cut_lineage


# The listing columns the study keeps, as read in snake case.
LISTING_COLUMNS = (
    "city",
    "room_type",
    "neighbourhood",
    "accommodates",
    "bathrooms",
    "bedrooms",
    "beds",
    "price",
    "square_feet",
    "guests_included",
    "extra_people",
    "review_scores_rating",
    "latitude",
    "longitude",
)


@dataclass(frozen=True)
class StudyConfig:
    key: str
    keep: Mapping[str, object] = field(default_factory=dict)
    group: str = "neighbourhood"
    square_feet: str = "square_feet"
    area: str = "square_meters"
    least_area: float = 20.0
    cut_height: float = 1.0
    train_share: float = 0.75
    seed: int = 0
    models: Sequence[Sequence[str]] = (
        ("bedrooms", "price", "accommodates", "neighb_id"),
        ("bedrooms", "accommodates", "neighb_id"),
    )
    similar_on: Sequence[str] = (
        "accommodates",
        "bathrooms",
        "bedrooms",
        "beds",
        "price",
        "guests_included",
        "extra_people",
        "review_scores_rating",
        "latitude",
        "longitude",
        "square_meters",
    )


@dataclass(frozen=True)
class Study:
    config: StudyConfig
    listings: DataFrame  # cleaned, with cluster number, area imputed where unknown
    train: DataFrame
    test: DataFrame
    pairs: DataFrame
    merges: DataFrame
    clusters: DataFrame
    fits: Sequence[LinearFit]
    errors: Sequence[DataFrame]  # hold-out error of each fit
    components: Components
    raw: DataFrame  # the listings as they came
    cleaned: DataFrame  # the cleaned rows, areas still unknown where they were

    def null_shares(self, columns: Sequence[str]) -> DataFrame:
        """``(column, before, after)``: percent of nulls as the listings came and after cleaning."""
        before = null_share(self.raw, [c for c in columns if c in self.raw.columns])
        after = null_share(self.cleaned, columns).withColumnRenamed("percent", "after")
        return after.join(before.withColumnRenamed("percent", "before"), "column", "left").select(
            "column", "before", "after"
        )

    def zero_share(self, column: str) -> DataFrame:
        """Percent of zeros among the known values of a column as the listings came."""
        return value_share(self.raw, column, 0, percent=True)

    def histogram(self, column: str, bins: int = 20) -> DataFrame:
        """Histogram of a column of the cleaned rows."""
        return histogram(self.cleaned, column, bins)

    def frequency(self, column: str) -> DataFrame:
        """Cleaned rows by value of a column."""
        return freq(self.cleaned, column)

    def clusters_by_group(self) -> DataFrame:
        """Cleaned rows by group and cluster."""
        return contingency(self.cleaned, self.config.group, "neighb_id", zeros=False)

    def summaries(self) -> DataFrame:
        """``(model, r2, sigma, rmse, n)``: every fit with its hold-out error."""
        rows = []
        for i, (fit, error) in enumerate(zip(self.fits, self.errors)):
            found = error.first()
            rows.append((i, fit.r2, fit.sigma, found["rmse"], found["n"]))
        kinds = "model int, r2 double, sigma double, rmse double, n long"
        return self.listings.sparkSession.createDataFrame(rows, kinds)

    def residuals(self, fit: int = 0, bins: int = 20) -> DataFrame:
        """Histogram of the hold-out residuals of one fit."""
        scored = predict_ols(self.test, self.fits[fit])
        return residual_histogram(scored, self.config.area, "predicted", bins)

    def score(self, scenarios: DataFrame, fit: int = 0) -> DataFrame:
        """Areas of made-up listings, each in a named group."""
        return score_scenarios(scenarios, self.fits[fit], self.clusters, self.config.group)

    def separating_components(self) -> DataFrame:
        """Components by how well they tell the clusters apart."""
        scores = pca_scores(self.listings, self.components)
        return rank_components(scores, self.components.names(), "neighb_id")

    def similar(self, query: Mapping[str, float], k: int = 5) -> DataFrame:
        """The listings most similar to one described by the study's columns."""
        complete = drop_incomplete(self.listings, self.components.columns)
        return nearest_similar(complete, self.components, query, self.config.key, k)


def clean_listings(df: DataFrame, config: StudyConfig) -> DataFrame:
    """Wanted rows with a known group, area in square metres, doubtful areas unknown."""
    rows = keep_nonempty(keep_equal(df, config.keep), config.group)
    area = F.col(config.area)
    rows = rows.withColumn(
        config.area, convert_units(F.col(config.square_feet), SQUARE_METERS_PER_SQUARE_FOOT)
    )
    rows = rows.withColumn(config.area, null_when(area, area < config.least_area))
    return drop_groups_without(rows, config.group, config.area)


def cluster_groups(
    df: DataFrame, value: str, group: str, height: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups whose pairwise tests look alike: (pairs, merges, clusters)."""
    pairs = cut_lineage(tukey_pairs(df, value, group))
    alike = symmetric_pairs(pairs, "p")
    unlike = alike.withColumn("value", 1 - F.col("value"))
    merges = complete_linkage(row_distances(unlike))
    members = df.where(F.col(value).isNotNull()).select(F.col(group).alias("member")).distinct()
    return pairs, merges, cut_lineage(cut_clusters(merges, height, members=members))


def run_listing_study(df: DataFrame, config: StudyConfig) -> Study:
    """The whole study; tables stay DataFrames, fits are a few numbers."""
    rows = cut_lineage(clean_listings(df, config))
    pairs, merges, clusters = cluster_groups(rows, config.area, config.group, config.cut_height)
    # Everything below reads the cleaned rows, a fraction of the source, several times.
    rows = cut_lineage(attach_cluster(rows, clusters, config.group))
    train, test = split_rows(rows, config.key, config.train_share, config.seed, exact=True)
    fits = [fit_ols(train, config.area, xs) for xs in config.models]
    errors = [rmse(predict_ols(test, fit), config.area, "predicted") for fit in fits]
    filled = impute_ols(rows, fits[0])
    components = fit_pca(filled, config.similar_on)
    return Study(config, filled, train, test, pairs, merges, clusters, fits, errors, components, df, rows)
