"""Exact quantiles per key by selection rounds.

Doubles are mapped to integers of the same order. A round counts, for each key, how many of the values that
are still in question have which next 16 bits, and a running sum over these at most 65,536 counts tells in
which of them a wanted rank lies; four rounds give the value itself, whatever the number of rows and
ties. As soon as no key has more than HELD values in question, the rest is done by ordering them. So no task ever holds
the values of a key, only counts or at most HELD of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType, LongType

from strandflow.sources.scratch import cut

#: Values of a key that a task may hold.
HELD = 1 << 16
BITS = 16


@F.pandas_udf(LongType())
def ordered(x: pd.Series) -> pd.Series:
    """An integer for each double, in the same order; both zeros are one, NaN comes last."""
    bits = (np.where(np.isnan(v := x.to_numpy(np.float64)), np.nan, v) + 0.0).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


@F.pandas_udf(DoubleType())
def unordered(x: pd.Series) -> pd.Series:
    """The double that `ordered` gave a number to."""
    bits = x.to_numpy(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits).view(np.float64))


def _same(a: str, b: str, names: list[str]) -> Column:
    out = F.lit(True)
    for k in names:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def _rounds(values: DataFrame, own: list[str], wanted: DataFrame, most: int) -> DataFrame:
    """(own, rank, value): `values` are (own, bits), `wanted` (own, rank) from 0; `most` is the largest number of values of a key."""
    targets = wanted.select(*own, "rank", F.col("rank").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    shift = 64
    prefix = lambda bits, at: F.lit(0).cast("long") if at == 64 else F.shiftright(bits, at)
    cell = [*own, "prefix"]

    def in_question() -> DataFrame:
        cells = targets.select(*cell).distinct()
        rows = values.withColumn("prefix", prefix("bits", shift))
        return rows.alias("v").join(cells.alias("t"), _same("v", "t", cell), "left_semi")

    while shift and most > HELD:
        counts = in_question().withColumn("next", prefix("bits", shift - BITS)).groupBy(*cell, "next").agg(F.count("*").alias("n"))
        counts = counts.withColumn("up_to", F.sum("n").over(W.partitionBy(*cell).orderBy("next")))
        found = targets.alias("t").join(counts.alias("c"), _same("t", "c", cell))
        found = found.filter("t.rest < c.up_to and t.rest >= c.up_to - c.n")
        targets = cut(found.select(*(F.col(f"t.{k}").alias(k) for k in own), "t.rank", F.expr("t.rest - (c.up_to - c.n)").alias("rest"), F.col("c.next").alias("prefix"), "c.n"), "ranks")
        shift -= BITS
        most = targets.agg(F.max("n")).first()[0] or 0
    if not shift:
        return targets.select(*own, "rank", unordered("prefix").alias("value"))
    places = in_question().withColumn("rest", F.row_number().over(W.partitionBy(*cell).orderBy("bits")) - 1)
    found = targets.alias("t").join(places.alias("p"), _same("t", "p", [*cell, "rest"]))
    return found.select(*(F.col(f"t.{k}").alias(k) for k in own), "t.rank", unordered("p.bits").alias("value"))


def quantiles(df: DataFrame, keys: list[str], column: str, shares: dict[str, float]) -> DataFrame:
    """(keys, size, and each name of `shares`): the exact quantiles of a column's known values, between two values by linear interpolation.

    Keys may be null; a key without a value has no row (without keys: one row of nulls). Runs jobs that count.
    """
    own = [f"k{i}" for i in range(len(keys))] or ["k"]
    columns = [F.col(k).alias(o) for k, o in zip(keys, own)] or [F.lit(0).alias("k")]
    value = F.col(column).cast("double")
    values = df.filter(value.isNotNull()).select(*columns, value.alias("value"))
    sizes = values.groupBy(*own).agg(F.count("*").alias("size"))
    most = sizes.agg(F.max("size")).first()[0] or 0
    if most <= HELD:
        found = values.groupBy(*own).agg(F.count("*").alias("size"), *(F.percentile("value", F.lit(s)).alias(n) for n, s in shares.items()))
    else:
        place = {n: F.lit(s) * (F.col("size") - 1) for n, s in shares.items()}
        wanted = F.explode(F.array_distinct(F.array(*(f(p).cast("long") for p in place.values() for f in (F.floor, F.ceil)))))
        values = cut(values.select(*own, ordered("value").alias("bits")), "values")
        sizes = cut(sizes, "sizes")
        ranks = _rounds(values, own, sizes.select(*own, wanted.alias("rank")), most).groupBy(*own)
        at = ranks.agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))  # two ranks for each share

        def between(p: Column) -> Column:
            low, high = F.floor(p).cast("long"), F.ceil(p).cast("long")
            a, b = F.col("at")[low], F.col("at")[high]
            return F.when(low == high, a).otherwise((high - p) * a + (p - low) * b)

        found = sizes.alias("s").join(at.alias("r"), _same("s", "r", own))
        found = found.select(*(F.col(f"s.{k}").alias(k) for k in own), "size", *(between(p).alias(n) for n, p in place.items()))
    if not keys:
        one = found.agg(F.coalesce(F.max("size"), F.lit(0)).alias("size"), *(F.max(n).alias(n) for n in shares))
        return one.select("size", *shares)
    return found.select(*(F.col(o).alias(k) for k, o in zip(keys, own)), "size", *shares)
