"""Uniform time grid without inventing data across gaps, and the timing of raw recordings.

Each raw interval emits its own grid points, so there is no range join: one window per episode and
an explode. The raw timing comes from the same window, so a recording is laid out once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strandflow.operators.canonical import KEYS

SECOND_US = 1_000_000
#: Added before a grid point is rounded down, so that points on whole microseconds stay there.
NUDGE = 1e-3


def _timing(dt: Column, max_gap_us: int, over=None) -> dict[str, Column]:
    """Samples, jitter (population deviation over mean of the intervals) and share of time in gaps; zeros below 3 samples."""
    at = lambda c: c if over is None else c.over(over)
    some = at(F.count(F.lit(1))) >= 3
    zero = lambda x: F.when(some, F.coalesce(x, F.lit(0.0))).otherwise(0.0)
    gaps = at(F.sum(F.when(dt > max_gap_us, dt).otherwise(0.0)))
    return {
        "n_raw": at(F.count(F.lit(1))),
        "raw_dt_jitter": zero(F.try_divide(at(F.stddev_pop(dt)), at(F.avg(dt)))),
        "raw_gap_fraction": zero(F.try_divide(gaps, at(F.sum(dt)))),
    }


def resample(
    raw: DataFrame,
    channels: list[str],
    rate: Column | float,
    max_gap_us: int,
    tie: list[str] = (),
    unit_us: int = SECOND_US,
    carry: list[str] = (),
) -> DataFrame:
    """(keys, step, t_us, channels, off_grid, n_raw, raw_dt_jitter, raw_gap_fraction, carry): linear interpolation on a uniform grid.

    The grid begins at the first sample and has `rate` points per `unit_us`: the session's own rate
    in Hz by default, a column or a number. Point k lies at k * unit_us / rate, rounded down to
    microseconds and never accumulated, so rates such as 30 Hz do not drift. Points strictly inside an
    interval wider than max_gap_us are null; a null end makes the point null; the last point may
    lie up to half a step behind the last sample and repeats it. off_grid tells points farther than
    half a step from any sample. One sample is one point. `carry` names columns that are constant in
    an episode.
    """
    w = W.partitionBy(*KEYS).orderBy("t_us", *tie)
    every = W.partitionBy(*KEYS)
    rate = (rate if isinstance(rate, Column) else F.lit(rate)).cast("double")
    ahead = {f"_{c}": F.lead(c).over(w) for c in ("t_us", *channels)}
    first = F.min("t_us").over(w.rowsBetween(W.unboundedPreceding, 0))  # in order of time, so the least of all; one window with the others
    df = raw.withColumns({**ahead, "_t0": first, "_last": F.lead(F.lit(1)).over(w).isNull(), "_rate": rate})
    timing = _timing((F.col("_t_us") - F.col("t_us")).cast("double"), max_gap_us, every)
    df = df.withColumns(timing)
    half = F.lit(unit_us) / F.col("_rate") / 2
    index = lambda t: (t - F.col("_t0")) * F.col("_rate") / unit_us
    # one index to spare on each side; the points themselves decide
    low = F.greatest(F.ceil(index(F.col("t_us"))).cast("long") - 1, F.lit(0).cast("long"))
    high = F.ceil(index(F.when(F.col("_last"), F.col("t_us") + half).otherwise(F.col("_t_us")))).cast("long") + 1
    df = df.withColumn("step", F.explode(F.sequence(low, F.greatest(high, low))))
    df = df.withColumn("_g", F.col("_t0") + F.floor(F.col("step") * F.lit(float(unit_us)) / F.col("_rate") + NUDGE).cast("long"))
    g = F.col("_g")
    end = F.when(F.col("_last"), g < F.col("t_us") + half).otherwise(g < F.col("_t_us"))
    df = df.filter((g >= F.col("t_us")) & end)
    hit = (g == F.col("t_us")) | F.col("_last")
    gap = F.col("_t_us") - F.col("t_us") > max_gap_us
    share = (g - F.col("t_us")) / F.nullif(F.col("_t_us") - F.col("t_us"), F.lit(0))

    def value(c: str) -> Column:
        return F.when(hit, F.col(c)).when(gap, None).otherwise(F.col(c) + (F.col(f"_{c}") - F.col(c)) * share)

    nearest = F.when(F.col("_last"), g - F.col("t_us")).otherwise(F.least(g - F.col("t_us"), F.col("_t_us") - g))
    return df.select(
        *KEYS, F.col("step").cast("int").alias("step"), (g - F.col("_t0")).alias("t_us"),
        *(value(c).alias(c) for c in channels), (nearest > half).alias("off_grid"), *timing, *carry,
    )


def raw_timing(raw: DataFrame, max_gap_us: int, tie: list[str] = ()) -> DataFrame:
    """Per episode: n_raw, raw_dt_jitter and raw_gap_fraction, without a grid."""
    w = W.partitionBy(*KEYS).orderBy("t_us", *tie)
    dt = raw.withColumn("_dt", (F.lead("t_us").over(w) - F.col("t_us")).cast("double"))
    return dt.groupBy(*KEYS).agg(*(c.alias(k) for k, c in _timing(F.col("_dt"), max_gap_us).items()))


def episode_aggregates(*constant: str, time: str = "t_us") -> dict[str, Column]:
    """What `episodes_of` tells of an episode, as aggregations of its grid."""
    same = ("n_raw", "raw_dt_jitter", "raw_gap_fraction", *constant)
    return {
        "n_steps": F.count("*"), "interp_fraction": F.avg(F.col("off_grid").cast("double")),
        "duration_s": F.max(time) / SECOND_US, **{c: F.first(c) for c in same},
    }


def episodes_of(grid: DataFrame, *constant: str) -> DataFrame:
    """One row per episode of a resampled grid: n_steps, interp_fraction, duration_s, the raw timing and the constant columns.

    One aggregation on the grid's own keys; nothing is joined.
    """
    return grid.groupBy(*KEYS).agg(*(c.alias(k) for k, c in episode_aggregates(*constant).items()))


def late_steps(raw: DataFrame, dt_us: int, slack: float = 0.25, tie: list[str] = ()) -> DataFrame:
    """Per episode: rows that start more than `slack` periods behind the schedule that began with the first row."""
    w = W.partitionBy(*KEYS).orderBy("t_us", *tie)
    behind = F.col("t_us") - F.min("t_us").over(W.partitionBy(*KEYS)) - (F.row_number().over(w) - 1) * F.lit(dt_us)
    return raw.withColumn("behind", behind).groupBy(*KEYS).agg(F.count_if(F.col("behind") > slack * dt_us).alias("late_steps"))
