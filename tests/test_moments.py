from __future__ import annotations

import numpy as np
import pytest

from tidemark.operators import moments


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_moments_against_numpy(spark, offset):
    rng = np.random.default_rng(6)
    # The first rows lie far from the others.
    x = np.vstack([rng.normal(50, 1, (1200, 3)), rng.normal(0, 1, (5000, 3))]) @ rng.normal(size=(3, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x + offset], "a double, b double, c double")
    found = moments.moments(df, ["a", "b", "c"])
    assert found.n == 6200
    assert np.allclose(found.mean, x.mean(axis=0) + offset, rtol=1e-12)
    assert np.allclose(found.scatter / 6199, np.cov(x.T), rtol=1e-6 if offset else 1e-11)


def test_constant_columns_have_no_scatter(spark):
    df = spark.createDataFrame([(0.1, float(i)) for i in range(3000)], "same double, x double")
    found = moments.moments(df, ["same", "x"])
    assert found.scatter[0, 0] == 0.0 and found.mean[0] == 0.1


def test_no_complete_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None)], "a double, b double")
    with pytest.raises(ValueError, match="no complete rows"):
        moments.moments(df, ["a", "b"])
