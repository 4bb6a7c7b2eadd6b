"""Every registered query against its SQL; the others give rows."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_points  # noqa: E402
import oracle  # noqa: E402
from sparkprep.plans import (  # noqa: E402
    queries_acquire,
    queries_checks,
    queries_profile,
    queries_transform,
    registry,
)


@pytest.fixture(scope="module")
def duck(small):
    return oracle.connect(small)


@pytest.fixture(scope="module", autouse=True)
def derived_once(spark, small):
    """Queries that start from the landed derived table share one copy of it."""
    landed = registry.land(registry.product_features(spark, small), "product-features")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(registry, "features", lambda spark, sf_dir: landed)
        for module in (queries_acquire, queries_checks, queries_profile, queries_transform):
            patch.setattr(module, "features", lambda spark, sf_dir: landed, raising=False)
        yield


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, duck, small, name):
    query, sql = entry_points.queries()[name], entry_points.oracle_sql().get(name)
    if sql is None:
        assert query(spark, small).limit(1).count() == 1
    else:
        assert oracle.compare(spark, duck, query, sql, small) is None


def test_every_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["grade", "n"] and df.count() == 5


def test_changed_input_gives_changed_rows_in_one_session(spark, small, tmp_path):
    from sparkprep.plans.product_features import product_features, table

    for name in ("nation", "supplier", "customer", "lineitem", "orders"):
        table(spark, small, name).write.parquet(f"{tmp_path}/{name}.parquet")
    shared = lambda: registry.landed_once(spark, str(tmp_path), "x", lambda: product_features(spark, str(tmp_path)))
    before = shared().count()
    assert shared().count() == before
    half = table(spark, small, "orders").where("o_orderkey % 2 = 0")
    half.write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert 0 < shared().count() < before
