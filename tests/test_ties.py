"""Halves, ties and orders of summation, where a last bit decides whether a query agrees with its SQL."""

import duckdb
import numpy as np
import pandas as pd

from cadenza.operators import audio, selection
from cadenza.plans import catalogue


def events(folder, channels):
    """A table of events in the folder; channels: name -> values, an hour apart."""
    rows = [(c, v) for c, values in channels.items() for v in values]
    table = pd.DataFrame(rows, columns=["event_type", "value"])
    table.insert(0, "event_id", np.arange(len(rows)))
    table["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(table["event_id"], unit="h")
    table.to_parquet(f"{folder}/events.parquet", coerce_timestamps="us")


def both(spark, folder, name):
    """Sorted rows of the query and of its SQL, which DuckDB runs in one thread so that it sums in order."""
    con = duckdb.connect(config={"threads": 1})
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    df = catalogue.QUERIES[name](spark, str(folder))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    return sorted(map(tuple, df.collect())), sorted(want)


def test_halves_round_as_the_oracle_rounds(spark):
    x = [578284.075, 342653.27499999997, 821182.4249999999, 1.005, 2.675, -2.675, 0.285, -0.001, 0.49999999999999994, 50.1234565, 1e15 / 7]
    for places in (2, 6):
        got = [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(x)], "k int, x double").orderBy("k").select(catalogue.r("x", places)).collect()]
        assert got == [duckdb.execute("SELECT round(?::DOUBLE, ?)", [v, places]).fetchone()[0] for v in x]


def test_level_texts_of_halves(spark, tmp_path):
    rng = np.random.default_rng(0)
    events(tmp_path, {f"c{k}": (2 * rng.integers(0, 6000, 2) + 1) / 20 for k in range(200)})  # all energies end in 5 thousandths
    got, want = both(spark, tmp_path, "q_level_text")
    assert got == want and len(got) == 200


def test_energy_is_summed_in_the_order_of_the_samples(spark):
    x = np.round(np.random.default_rng(0).uniform(0, 300, 100), 2).tolist()
    ahead = back = 0.0
    for v, w in zip(x, reversed(x), strict=True):
        ahead, back = ahead + v * v, back + w * w
    assert ahead != back
    rows = spark.createDataFrame([("a", k, x[k]) for k in reversed(range(100))] + [("a", 100, None), ("a", None, 2.0), ("a", None, 3.0)], "c string, n long, x double")
    got = {r.frame_idx: (r.n_samples, r.energy) for r in audio.frame_levels(rows.coalesce(1), ["c"], "n", "x", 100, 16000).collect()}
    assert got == {0: (100, ahead), 1: (1, None), None: (2, 13.0)}
    assert audio.frame_levels(rows.where("false"), ["c"], "n", "x", 100, 16000).count() == 0


def test_quantiles_are_duckdbs_to_the_last_bit(spark):
    rng = np.random.default_rng(1)
    sets = {f"k{k}": np.round(rng.uniform(0, 500, 2 + k % 7), 2) / 7 for k in range(200)}
    sets |= {f"same{k}": np.full(4, np.round(rng.uniform(0, 500), 2) / 7) for k in range(100)} | {"low": np.array([float("-inf"), 1.0, 2.0]), "high": np.array([1.0, 2.0, float("inf")])}
    df = spark.createDataFrame(pd.DataFrame([(k, v) for k, x in sets.items() for v in x], columns=["k", "x"]))
    got = sorted(map(tuple, selection.quantiles(df, ["k"], "x", {"a": 0.75, "b": 0.1, "c": 0.5}).collect()))
    con = duckdb.connect()
    con.register("rows", df.toPandas())
    assert got == con.execute("SELECT k, quantile_cont(x, 0.75), quantile_cont(x, 0.1), quantile_cont(x, 0.5) FROM rows GROUP BY k ORDER BY k").fetchall()


def test_flags_of_values_at_the_quantile(spark, tmp_path):
    rng = np.random.default_rng(0)
    events(tmp_path, {f"c{k}": rng.integers(1, 6, 62) / 10 for k in range(40)})  # means that are equal but for their last bits
    got, want = both(spark, tmp_path, "q_quantile_flags")
    assert got == want and len(got) == 2480


def test_summary_counts_the_same_flags(spark, tmp_path):
    rng = np.random.default_rng(0)
    events(tmp_path, {f"c{k}": rng.integers(1, 6, 62) / 10 for k in range(40)})
    got, want = both(spark, tmp_path, "q_summary")
    assert got == want and len(got) == 40
