"""Selection rounds against numpy, with few values held."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandflow.operators import metrics, quantiles


def key(x):
    return (x is not None, x or 0)


@pytest.mark.parametrize("held", [quantiles.HELD, 3])
def test_quantiles_of_odd_values(spark, monkeypatch, held):
    monkeypatch.setattr(quantiles, "HELD", held)
    rng = np.random.default_rng(1)
    groups = {
        1: list(rng.standard_normal(400) * 10.0 ** rng.integers(-300, 300, 400)),
        2: [5.0] * 300 + [5.000000000000001, 4.999999999999999],
        3: [0.0, -0.0] * 40 + [1e-320, -1e-320],
        4: [7.5],
        None: list(rng.integers(-3, 3, 200).astype(float)),
        5: [-1e308, 1e308, 0.1],
        6: [],
    }
    rows = [(k, float(v)) for k, own in groups.items() for v in own] + [(1, None), (6, None), (None, None)]
    df = spark.createDataFrame(rows, "g int, value double")
    shares = {"low": 0.1, "mid": 0.5, "high": 0.9, "least": 0.0, "most": 1.0}
    got = {r["g"]: r for r in quantiles.quantiles(df.repartition(5), ["g"], "value", shares).collect()}
    assert set(got) == {k for k, own in groups.items() if own}
    for k, r in got.items():
        own = np.sort(groups[k])
        assert r["size"] == len(own)
        for name, share in shares.items():
            at = share * (len(own) - 1)
            low, high = int(np.floor(at)), int(np.ceil(at))
            want = own[low] if low == high else (high - at) * own[low] + (at - low) * own[high]
            assert r[name] == want, (k, name)


def test_the_whole_as_one_key(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "HELD", 50)
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(1.25)).otherwise(F.col("id") * 0.001).alias("value"))
    want = np.quantile([1.25 if i % 3 == 0 else i * 0.001 for i in range(30_000)], [0.1, 0.5])
    (row,) = quantiles.quantiles(df, [], "value", {"a": 0.1, "b": 0.5}).collect()
    assert row["size"] == 30_000 and np.allclose([row["a"], row["b"]], want, rtol=1e-12)
    (none,) = quantiles.quantiles(df.limit(0), [], "value", {"a": 0.1}).collect()
    assert (none["size"], none["a"]) == (0, None)


def test_scale_by_rounds_is_the_scale_at_once(spark, monkeypatch):
    df = spark.range(900).select((F.col("id") % 4).alias("g"), F.when(F.col("id") % 7 > 0, F.round(F.sin("id") * 50)).alias("x"))
    at_once = {r["g"]: r["s"] for r in metrics.robust_scale(df, ["g"], "x", "s").select("g", "s").distinct().collect()}
    monkeypatch.setattr(quantiles, "HELD", 10)
    by_rounds = {r["g"]: r["s"] for r in metrics.robust_scale(df, ["g"], "x", "s").select("g", "s").distinct().collect()}
    assert at_once == by_rounds and len(at_once) == 4


def test_order_of_the_numbers():
    x = np.array([-np.inf, -1e300, -1.5, -5e-324, 0.0, 5e-324, 1.0, 2.0, np.inf, np.nan])
    import pandas as pd

    bits = quantiles.ordered.func(pd.Series(x)).to_numpy()
    assert (np.diff(bits) > 0).all() and np.array_equal(quantiles.unordered.func(pd.Series(bits)).to_numpy(), x, equal_nan=True)
