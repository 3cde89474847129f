"""Resampling of a live stream: grid points as soon as they are settled, timing when an episode ends.

Episodes are kept in groups, and a call works on the arrays of its whole group, so its cost does not come once for
each episode. State per group: the samples that wait, and of each open episode the first time, the last settled sample, the number
of the next grid point and running sums of the intervals. Samples newer than the watermark wait, since an
earlier one may still come; what the watermark has passed is settled for good. So any split of a recording into
micro-batches, and any order within the allowed lateness, gives the points that `resample.resample` gives for the whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strandflow.operators.canonical import KEYS
from strandflow.operators.resample import NUDGE, SECOND_US

#: What is counted of an episode at its first sample: the next grid point, samples, points off the grid, and sums of the intervals.
BEGUN = {"_point": 0, "_n": 1, "_n_off": 0, "_sum": 0.0, "_squares": 0.0, "_gaps": 0.0}
CLOSING = ("n_raw", "n_steps", "interp_fraction", "duration_us", "raw_dt_jitter", "raw_gap_fraction")
WHOLE = ("step", "t_us", "n_raw", "n_steps", "duration_us")
#: Groups of a stream: many enough that a task holds few episodes at once, few enough that calls cost little.
GROUPS = 1024


def packed(rows: pd.DataFrame) -> bytes:
    """Rows as one value of the state: an Arrow stream."""
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpacked(kept: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(kept).read_pandas()


def newest_of(rows: pd.DataFrame) -> int:
    """The time at which the first episode has its newest row."""
    return rows.groupby(list(KEYS))["t_us"].max().min()


def settle(
    t: np.ndarray, cells: np.ndarray, run: np.ndarray, t0: np.ndarray, point: np.ndarray, rate: np.ndarray, ended: np.ndarray, max_gap_us: int, unit_us: int
) -> tuple[np.ndarray, ...]:
    """Grid points of several runs from their numbers `point` on that lie before the last sample (or, in a run that has ended, up to half a step behind it): run, number, time, values, whether off grid.

    `run` numbers the run of each sample and, like `t` within it, ascends; `cells` has a row for each sample, NaN where there is no value.
    Each sample makes the points up to the next one, with one number to spare on each side; the points themselves decide.
    """
    after = np.minimum(np.arange(len(t)) + 1, len(t) - 1)
    last = (run[after] != run) | (after == np.arange(len(t)))
    half = (unit_us / rate / 2)[run]
    index = lambda x: np.ceil((x - t0[run]) * rate[run] / unit_us).astype(np.int64)
    low = np.maximum(index(t) - 1, point[run])
    high = np.where(last, index(t + half), index(t[after])) + 1
    number = np.where(last & ~ended[run], 0, np.maximum(high - low + 1, 0))
    i = np.repeat(np.arange(len(t)), number)
    k = np.arange(len(i)) + np.repeat(low - (np.cumsum(number) - number), number)
    g = t0[run[i]] + np.floor(k * float(unit_us) / rate[run[i]] + NUDGE).astype(np.int64)
    keep = (g >= t[i]) & np.where(last[i], g < t[i] + half[i], g < t[after[i]])
    i, k, g = i[keep], k[keep], g[keep]
    at, to, last = t[i], t[after[i]], last[i]
    hit = (g == at) | last
    with np.errstate(invalid="ignore", divide="ignore"):
        share = (g - at) / np.where(last, 1, to - at)
        made = cells[i] + (cells[after[i]] - cells[i]) * share[:, None]
    wide = ~hit & (to - at > max_gap_us)
    made = np.where(hit[:, None], cells[i], np.where(wide[:, None], np.nan, made))
    nearest = np.where(last, g - at, np.minimum(g - at, to - g))
    return run[i], k, g - t0[run[i]], made, nearest > half[i]


class Resampler(StatefulProcessor):
    """Of a group of episodes, or of the one that the key names where the rows name none."""

    def __init__(self, channels: list[str], max_gap_us: int, idle_us: int, unit_us: int):
        self.channels, self.max_gap_us, self.idle_us, self.unit_us = channels, max_gap_us, idle_us, unit_us
        self.sample = {"t_us": "int64", **dict.fromkeys(["rate", *channels], "float64")}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", "open binary")
        self.waiting = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, newest = [], []
        for new in rows:
            new = new if KEYS[0] in new else new.assign(**dict(zip(KEYS, key, strict=True)))
            self.waiting.appendList([(packed(new[[*KEYS, *self.sample]].astype(self.sample)),)])
            first.append(new["t_us"].min())
            newest.append(new.groupby(list(KEYS), as_index=False)["t_us"].max())
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if passed > 0 or min(first) <= passed:
            yield from self._settled(passed)
        else:  # no watermark has passed anything yet
            self._wake(newest_of(pd.concat(newest)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled(timerValues.getCurrentWatermarkInMs() * 1000)

    def _wake(self, at: int) -> None:
        """Look again at this group once the watermark has passed the time `at`."""
        self.handle.registerTimer(-(-int(at) // 1000))

    def _settled(self, passed: int) -> Iterator[pd.DataFrame]:
        """The points that samples up to the time `passed` settle, and the end of each episode to which nothing came for so long: at most one frame."""
        none = pd.DataFrame(columns=[*KEYS, *self.sample]).astype(self.sample)
        waits = pd.concat([unpacked(kept) for (kept,) in self.waiting.get()]) if self.waiting.exists() else none
        still = unpacked(self.progress.get()[0]) if self.progress.exists() else none
        ready = waits["t_us"] <= passed
        now, waits = waits[ready], waits[~ready]
        if len(now):
            self.waiting.put([(packed(waits),)]) if len(waits) else self.waiting.clear()
        told = none
        if len(now) or (still["t_us"] + self.idle_us <= passed).any():
            told, still = self._advanced(still, now, passed)
            self.progress.update((packed(still),)) if len(still) else self.progress.clear()
        due = ([newest_of(waits)] if len(waits) else []) + ([still["t_us"].min() + self.idle_us] if len(still) else [])
        if due:
            self._wake(min(due))
        if len(told):
            yield told

    def _advanced(self, was: pd.DataFrame, now: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, pd.DataFrame]:
        """(what is told, the open episodes) once the samples `now` are settled; the last settled sample of an open episode leads its new ones."""
        parts = (was, now.assign(_t0=now["t_us"], **BEGUN))
        rows = pd.concat([x for x in parts if len(x)], ignore_index=True)
        episode = rows.groupby(list(KEYS), sort=False).ngroup().to_numpy()
        cells = rows[self.channels].to_numpy(np.float64)
        # by time, then by the channels, without a value first
        ties = [np.where(np.isnan(c), -np.inf, c) for c in cells.T[::-1]]
        order = np.lexsort((*ties, rows["t_us"].to_numpy(), np.arange(len(rows)) >= len(was), episode))
        cells, episode, t = cells[order], episode[order], rows["t_us"].to_numpy()[order]
        begins = np.append(True, (np.diff(episode) != 0) | (np.diff(t) >= self.idle_us))  # an episode may end between two samples
        run, a = np.cumsum(begins) - 1, np.flatnonzero(begins)
        z = np.append(a[1:], len(t)) - 1
        ended = np.append(np.diff(episode[a]) == 0, False) | (t[z] + self.idle_us <= passed)
        runs = rows.iloc[order[a]].reset_index(drop=True)
        rate = runs["rate"].to_numpy()
        if not (np.isfinite(rate) & (rate > 0)).all():
            raise ValueError("the rate of an episode must be a number above zero")
        owner, k, at, made, off = settle(t, cells, run, runs["_t0"].to_numpy(), runs["_point"].to_numpy(), rate, ended, self.max_gap_us, self.unit_us)
        dt = np.where(begins, 0, np.diff(t, prepend=t[0])).astype(np.float64)
        of_samples = {"_n": ~begins, "_sum": dt, "_squares": dt * dt, "_gaps": np.where(dt > self.max_gap_us, dt, 0.0)}
        for by, found in ((run, of_samples), (owner, {"_point": np.ones(len(k)), "_n_off": off})):
            for c, x in found.items():
                runs[c] += np.bincount(by, x, len(a)).astype(runs[c].dtype)
        runs["t_us"] = t[z]
        runs[self.channels] = cells[z]
        points = runs[list(KEYS)].iloc[owner].assign(step=k, t_us=at, **dict(zip(self.channels, made.T, strict=True)), off_grid=off)
        return self._told(points, self._closing(runs[ended])), runs[~ended]

    def _closing(self, runs: pd.DataFrame) -> pd.DataFrame:
        n, point, total, squares, gaps = (runs[f"_{c}"] for c in ("n", "point", "sum", "squares", "gaps"))
        timed = (n >= 3) & (total > 0)
        mean = total / (n - 1)
        spread = np.sqrt(np.maximum(squares / (n - 1) - mean**2, 0.0))
        duration = np.floor((point - 1) * float(self.unit_us) / runs["rate"] + NUDGE).astype(np.int64)
        told = (n, point, runs["_n_off"] / point, duration, (spread / mean).where(timed, 0.0), (gaps / total).where(timed, 0.0))
        return runs[list(KEYS)].assign(**dict(zip(CLOSING, told, strict=True)))

    def _told(self, points: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        """One frame: the points, then the closing rows, each without the columns of the other."""
        kinds = dict.fromkeys(WHOLE, "Int64") | {"off_grid": "boolean"}
        parts = [x.astype({c: kind for c, kind in kinds.items() if c in x}) for x in (points, ends) if len(x)]
        names = [*KEYS, "step", "t_us", *self.channels, "off_grid", *CLOSING]
        told = pd.concat(parts, ignore_index=True) if parts else points
        lacking = {c: pd.array([None] * len(told), kinds.get(c, "Float64")) for c in names if c not in told}
        return told.assign(**lacking)[names]

    def close(self) -> None:
        pass


def resample_stream(
    stream: DataFrame, time: str, channels: list[str], max_gap_us: int, late: str, idle_us: int, unit_us: int = SECOND_US, groups: int = GROUPS
) -> DataFrame:
    """A stream of grid points, and of one closing row for each episode, from raw rows (session_id, episode_id, `time`, rate, channels).

    A grid point comes once the watermark, `late` behind the newest row, has passed the sample after
    it: session_id, episode_id, step, t_us, channels and off_grid, as in `resample.resample`. An episode ends when
    nothing came for `idle_us`; its closing row has no step but n_raw, n_steps, interp_fraction, duration_us, raw_dt_jitter and
    raw_gap_fraction. Rows older than the watermark are late and dropped, as everywhere in a stream; rows that
    come after an episode's end begin another one. Rows without a key or a time are left out. Rows of one time are
    ordered by their channels. Waiting rows are bounded by the lateness, the state by the open episodes. Episodes are dealt
    into `groups` by a hash of their names: a call holds the waiting rows and open episodes of one group; the number stays as a stream goes on.
    """
    cells = [F.col(c).cast("double").alias(c) for c in channels]
    group = F.pmod(F.xxhash64(*KEYS), F.lit(groups)).cast("int").alias("_group")
    rows = stream.select(group, *KEYS, time, F.unix_micros(F.col(time).cast("timestamp")).alias("t_us"), F.col("rate").cast("double").alias("rate"), *cells)
    rows = rows.filter(F.col("t_us").isNotNull() & F.col("session_id").isNotNull() & F.col("episode_id").isNotNull()).withWatermark(time, late)
    schema = (
        "session_id string, episode_id string, step int, t_us long, " + "".join(f"{c} double, " for c in channels)
        + "off_grid boolean, n_raw long, n_steps long, interp_fraction double, duration_us long, raw_dt_jitter double, raw_gap_fraction double"
    )
    return rows.groupBy("_group").transformWithStateInPandas(Resampler(channels, max_gap_us, idle_us, unit_us), schema, "append", "eventTime")
