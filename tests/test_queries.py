"""Every registered query against its SQL on the smallest tables."""

import inspect
import os

import pytest

from tablewright.operators import growing
from tablewright.operators.growing import DEEPEST
from tablewright.plans.catalog import all_queries
from tests.oracle import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    q = all_queries()[name]
    df = q.run(spark, FOLDER)
    if q.sql is None:
        assert df.count() > 0
    else:
        assert differences(db, df, q.sql) == ""


REFERENCE = {
    "forest_regression": {"trees": 100, "depth": DEEPEST, "min_split": 2, "min_leaf": 1, "bootstrap": True},
    "forest_classification": {"trees": 200, "depth": 20, "min_split": 5, "min_leaf": 2, "bootstrap": True},
    "tree_classification": {"trees": 1, "depth": 10, "min_split": 20, "min_leaf": 10, "bootstrap": False},
    "forest_importance": {"trees": 100, "depth": DEEPEST, "min_split": 2, "min_leaf": 1, "bootstrap": True},
    "eliminate_features": {"trees": 50, "depth": DEEPEST, "min_split": 2, "min_leaf": 1, "bootstrap": True},
}


@pytest.mark.parametrize("name", sorted(REFERENCE))
def test_learners_have_the_reference_parameters(spark, monkeypatch, name):
    """The fit runs to its end; what it was called with is compared."""
    seen = []
    own = growing.fit

    def fit(*args, **kwargs):
        bound = inspect.signature(own).bind(*args, **kwargs)
        bound.apply_defaults()
        seen.append({n: bound.arguments[n] for n in REFERENCE[name]})
        return own(*args, **kwargs)

    monkeypatch.setattr(growing, "fit", fit)
    assert all_queries()[name].run(spark, FOLDER).count() > 0
    assert seen and all(s == REFERENCE[name] for s in seen)


def test_grid_search_tries_every_pair(spark):
    assert all_queries()["grid_search"].run(spark, FOLDER).count() == 10


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(NAMES) <= set(entry.queries())


def test_inventory_is_covered():
    wanted = (
        [f"S{i}" for i in range(1, 13)]
        + [f"P{i}" for i in range(1, 10)]
        + [f"C{i}" for i in range(1, 11)]
        + [f"F{i}" for i in range(1, 14)]
        + [f"T{i}" for i in range(1, 11)]
        + [f"A{i}" for i in range(1, 10)]
        + [f"M{i}" for i in range(1, 22)]
        + [f"E{i}" for i in range(1, 14)]
        + [f"K{i}" for i in range(1, 16)]
        + [f"G{i}" for i in range(1, 21)]
        + [f"Q{i}" for i in range(1, 9)]
        + [f"D{i}" for i in range(1, 16)]
    )
    have = {c for q in all_queries().values() for c in q.covers}
    assert [w for w in wanted if w not in have] == []
