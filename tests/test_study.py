from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans.study import LISTING_COLUMNS, StudyConfig, run_listing_study
from tidemark.sources.readers import read_delimited

HEADER = (
    "ID;City;Room.Type;Neighbourhood;Accommodates;Bathrooms;Bedrooms;Beds;Price;Square.Feet;Guests.Included;"
    "Extra.People;Review.Scores.Rating;Latitude;Longitude;Description"
)
# Neighbourhoods in pairs of like size; one without any known area.
BASE = {"Alfama": 50, "Baixa": 50, "Belem": 90, "Benfica": 90, "Estrela": 130, "Lapa": 130, "Graca": 170, "Marvila": None}


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    draw = random.Random(21)
    lines = [HEADER]
    for i in range(1600):
        hood = list(BASE)[i % 8]
        bedrooms = 1 + i // 8 % 4
        meters = None if BASE[hood] is None else BASE[hood] + 12 * bedrooms + draw.gauss(0, 2)
        feet = "" if meters is None or i % 5 == 0 else f"{meters / 0.092903:.1f}"
        if i % 97 == 0:
            feet = "0"
        city = "Lisbon" if i % 16 < 14 else "Paris"
        lines.append(
            f'{i};{city};{"Private room" if i % 23 == 0 else "Entire home/apt"};{hood if i % 31 else ""};{bedrooms * 2};'
            f'{draw.randint(1, 3)};{bedrooms};{bedrooms + draw.randint(0, 2)};{draw.randint(30, 200)};{feet};'
            f'{draw.randint(1, 3)};{draw.randint(0, 30)};{draw.randint(60, 100) if i % 7 else "NA"};'
            f'{40 + draw.random()};{-3 - draw.random()};"Bright; quiet\nand ""central"""'
        )
    path = tmp_path_factory.mktemp("listings")
    (path / "listings.csv").write_text("\n".join(lines) + "\n")
    raw = read_delimited(spark, str(path), columns=("id", *LISTING_COLUMNS), multi_line=True)
    assert raw.count() == 1600
    config = StudyConfig(key="id", keep={"city": "Lisbon", "room_type": "Entire home/apt"})
    return run_listing_study(raw, config)


def test_groups_of_like_size_form_clusters(study):
    found = {r.member: r.cluster for r in study.clusters.collect()}
    assert set(found) == set(BASE) - {"Marvila"}
    assert {frozenset(m for m in found if found[m] == c) for c in found.values()} == {
        frozenset(p) for p in (("Alfama", "Baixa"), ("Belem", "Benfica"), ("Estrela", "Lapa"), ("Graca",))
    }
    assert found["Baixa"] == 1  # numbered by the smallest name


def test_every_listing_has_a_plausible_area(study):
    listings = study.listings
    assert listings.where("square_meters IS NULL OR neighbourhood IN ('Marvila', '')").count() == 0
    assert listings.where("city <> 'Lisbon' OR room_type <> 'Entire home/apt'").count() == 0
    known = listings.where("square_feet > 0").select(
        F.max(F.abs(F.col("square_meters") - F.round(F.col("square_feet") * 0.092903, 2)))
    )
    assert known.first()[0] < 1e-9


def test_fits_and_hold_out(study):
    total = study.listings.count()
    assert study.train.count() == int(total * 0.75) and study.test.count() == total - int(total * 0.75)
    first, second = study.fits
    assert first.xs == ("bedrooms", "price", "neighb_id") and first.aliased == ("accommodates",)
    assert second.xs == ("bedrooms", "neighb_id")
    assert all(error.first().rmse > 0 for error in study.errors)
    assert study.residuals().agg(F.sum("n")).first()[0] == study.errors[0].first().n


def test_scenarios(spark, study):
    asked = spark.createDataFrame(
        [(n, 80, 6, "Alfama") for n in (3, 4, 5)], "bedrooms int, price int, accommodates int, neighbourhood string"
    )
    found = [r.predicted for r in study.score(asked).orderBy("bedrooms").collect()]
    assert found[1] - found[0] == pytest.approx(study.fits[0].slopes[0])
    assert found[2] - found[1] == pytest.approx(study.fits[0].slopes[0])


def test_similar_listings(study):
    one = study.listings.dropna(subset=list(study.components.columns)).orderBy("id").first().asDict()
    near = study.similar(one).collect()
    assert len(near) == 5 and near[0].id == one["id"] and near[0].distance == 0
    assert [r.distance for r in near] == sorted(r.distance for r in near)


def test_components_are_ranked(study):
    found = study.separating_components().collect()
    assert len(found) == 11 and [r.f for r in found] == sorted((r.f for r in found), reverse=True)
