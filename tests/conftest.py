import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, shared_dir
    s = build_session("local[4]", shuffle_partitions=8)
    shared_dir(s)  # tests set their own checkpoint folder (none is configured)
    yield s
    s.stop()


def panel_df(spark, rows):
    """rows: (entity, metric, period, value)."""
    from tidemark.params import PANEL_SCHEMA
    return spark.createDataFrame(rows, PANEL_SCHEMA)


def metric_dim_df(spark, rows):
    from tidemark.params import METRIC_DIM_SCHEMA
    return spark.createDataFrame(rows, METRIC_DIM_SCHEMA)


def entity_dim_df(spark, rows):
    from tidemark.params import ENTITY_DIM_SCHEMA
    return spark.createDataFrame(rows, ENTITY_DIM_SCHEMA)


def as_dicts(df, key=None):
    rows = [r.asDict() for r in df.collect()]
    if key:
        rows.sort(key=lambda d: tuple(str(d[k]) for k in key))
    return rows
