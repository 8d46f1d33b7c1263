"""Every query with SQL agrees with DuckDB on the small tables; the others are tested on their own below."""

import glob
import os

import duckdb
import pytest

from cadenza.operators import saliency
from cadenza.plans import catalogue


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_sql(spark, con, sf, name):
    df = catalogue.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(str(tuple(r)) for r in df.select(*cols).collect())
    want = sorted(str(r) for r in con.execute(f"SELECT {', '.join(cols)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall())
    assert got == want


def test_feature_table_matches_pandas(spark, sf):
    import numpy as np
    import pandas as pd

    got = catalogue.feature_table(spark, sf).toPandas().sort_values("frame_idx").reset_index(drop=True)
    assert list(got.columns) == ["path", *saliency.ORDER, *(f"{c}_smooth" for c in saliency.SMOOTHED if f"{c}_smooth" not in saliency.ORDER)] and len(got.columns) == 26
    v = pd.read_parquet(f"{sf}/embeddings.parquet").sort_values("vec_id")["embedding"]
    x = np.stack(v.to_numpy()).astype(float)
    motion = np.r_[0, np.abs(np.diff(x, axis=0)).mean(1) / 255]
    assert np.allclose(got["motion_intensity"], motion, atol=2e-6)
    smooth = pd.Series(motion).rolling(7, center=True, min_periods=1).mean()
    assert np.allclose(got["motion_intensity_smooth"], smooth, atol=2e-6)
    assert (got["is_high_motion"].to_numpy() == (smooth > smooth.quantile(0.75)).to_numpy()).all()
    e = np.exp(x - x.max(1, keepdims=True))
    p = e / e.sum(1, keepdims=True)
    assert np.allclose(got["std_saliency"], p.std(1), atol=2e-6)
    assert np.allclose(got["top10_saliency_mass"], [m[m >= np.percentile(m, 90)].sum() / m.sum() for m in p], atol=2e-6)


def test_entry_and_keys(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
