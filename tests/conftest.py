import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session("tests", cores="4")


@pytest.fixture
def frame(spark):
    """Build a frame from columns; the schema is a DDL string."""
    def build(schema, **columns):
        names = list(columns)
        rows = list(zip(*columns.values())) if names else []
        return spark.createDataFrame(rows, schema).coalesce(1)
    return build


@pytest.fixture
def big_data_routes(monkeypatch):
    """Force the routes taken for large tables: no broadcast of lookups, many small ranges."""
    from foldwise.operators import folds, lookup, order_stats, sample

    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "HOT_PARTS", 4)
    monkeypatch.setattr(order_stats, "ROWS_PER_RANGE", 3)
    monkeypatch.setattr(folds, "ROWS_PER_BUCKET", 3)
    monkeypatch.setattr(sample, "HASH_BUCKETS", 4)


def values(df, key, *columns):
    """Column values in key order, one list per column."""
    rows = df.orderBy(key).collect()
    out = [[r[c] for r in rows] for c in columns]
    return out[0] if len(out) == 1 else out
