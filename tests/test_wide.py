"""Subspace iteration against the covariance way, and more columns than one covariance takes."""

import numpy as np
import pyarrow as pa
import pytest

from sparkprep.operators.reduction import FeatureReducer, FeatureReducerModel

ROLES = dict(label="y", preserve_cols=["id"])


def frame(spark, x, path):
    columns = {"id": pa.array(np.arange(len(x))), "y": pa.array(["a"] * len(x))}
    columns |= {f"c{j}": pa.array(x[:, j]) for j in range(x.shape[1])}
    spark.createDataFrame(pa.table(columns)).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def scores(model, df):
    rows = sorted(model.transform(df).collect(), key=lambda r: r["id"])
    return np.array([[r[c] for c in model.component_columns] for r in rows])


@pytest.mark.parametrize("settings", [{"n_components": 4}, {"variance_threshold": 0.9}, {"variance_threshold": 1.0}])
def test_axes_agree_with_the_covariance_way(spark, tmp_path, settings):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 50)) * 0.9 ** np.arange(50) @ np.linalg.qr(rng.normal(size=(50, 50)))[0] + 3
    df = frame(spark, x, f"{tmp_path}/t")
    one = FeatureReducer(**settings, **ROLES).fit(df)
    two = FeatureReducer(**settings, max_columns=10, **ROLES).fit(df)
    assert len(one.component_columns) == len(two.component_columns) >= 4
    assert np.allclose(one.explained_variance_ratio(), two.explained_variance_ratio(), atol=1e-8)
    assert np.abs(scores(one, df)[:, :4] - scores(two, df)[:, :4]).max() < 1e-3


def test_many_columns(spark, tmp_path):
    """More columns than rows and than are assembled one by one; run once with 10 000 as well."""
    rng = np.random.default_rng(2)
    hidden = rng.normal(size=(40, 3)) * [9, 5, 2]
    x = hidden @ rng.normal(size=(3, 1_200)) + rng.normal(size=(40, 1_200)) * 0.01
    df = frame(spark, x, f"{tmp_path}/t")
    model = FeatureReducer(variance_threshold=0.99, max_columns=500, **ROLES).fit(df)
    own = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) ** 2
    assert np.allclose(model.explained_variance_ratio(), (own / own.sum())[: len(model.component_columns)], atol=1e-9)
    model.write().overwrite().save(f"{tmp_path}/m")
    found = scores(FeatureReducerModel.load(f"{tmp_path}/m"), df)
    assert np.allclose((found**2).sum(axis=0), own[: found.shape[1]], rtol=1e-6)


def test_a_threshold_out_of_reach_is_an_error(spark, tmp_path):
    df = frame(spark, np.random.default_rng(3).normal(size=(200, 30)), f"{tmp_path}/t")
    with pytest.raises(ValueError, match="components hold"):
        FeatureReducer(variance_threshold=0.99, max_columns=10, max_components=5, **ROLES).fit(df)
