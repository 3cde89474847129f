"""From scored episodes to leak-free split tables: gate, dedupe, split, previous action, norm statistics, hashes."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from strandflow.operators.canonical import KEYS, episode_window
from strandflow.profile import Profile

TIERS = ("reject", "silver", "gold")


def select_columns(keys: list[str], profile: Profile) -> list[str]:
    """Ordered columns of symbolic keys; an unknown key is an error."""
    groups = {k: profile.joints(k) for k in ("q", "dq", "act_q")} | {
        "prev_act_q": profile.joints("prev_act_q"),
        "ee_pos": ["ee_x", "ee_y", "ee_z"],
        "ee_quat": ["ee_qx", "ee_qy", "ee_qz", "ee_qw"],
    }
    groups |= {k: [k] for k in ("grip", "act_grip", "prev_act_grip")}
    if unknown := [k for k in keys if k not in groups]:
        raise ValueError(f"unknown keys: {', '.join(unknown)}")
    return [c for k in keys for c in groups[k]]


def gate(episodes: DataFrame, quality: DataFrame, validation: DataFrame, profile: Profile) -> DataFrame:
    """Adds the tier (stored one where unscored) and exclude_reason: the first that matches, null if the episode passes."""
    df = episodes.join(quality.select(*KEYS, "tier", "score"), list(KEYS), "left").join(validation.select(*KEYS, "ok"), list(KEYS), "left")
    if "quality_tier" in episodes.columns:
        df = df.withColumn("tier", F.coalesce("tier", "quality_tier"))
    allowed = TIERS[TIERS.index(profile.min_tier) :]
    reason = (
        F.when(~F.coalesce("ok", F.lit(True)), "invalid").when(F.col("tier").isNull(), "unscored")
        .when(~F.col("tier").isin(*allowed), F.concat(F.lit("tier:"), F.col("tier")))
    )
    if profile.require_success:
        reason = reason.when(~F.col("success"), "failed")
    return df.withColumn("exclude_reason", reason)


def nearest(x: Column) -> Column:
    """The nearest whole number, halves away from zero: what `round` gives, but without a decimal number for each value."""
    whole = F.floor(F.abs(x))
    up = whole + (F.abs(x) - whole >= 0.5).cast("long")
    return F.when(x < 0, -up).otherwise(up)


def row_text(channels: list[str], unit: float) -> Column:
    """A row's step, time and values in units of 1/`unit`, `-` where there is none."""
    cell = lambda c: F.coalesce(nearest(F.col(c) * unit).cast("string"), F.lit("-"))
    fixed = (F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("step", "t_us"))
    return F.concat_ws(",", *fixed, *(cell(c) for c in channels))


def digest_sums(steps: DataFrame, channels: list[str], unit: float = 1e6) -> DataFrame:
    """(keys, sum_0 ... sum_3): sums of the four words of each row's md5; a row is its step, time and values in units of 1/`unit`.

    They add up before the shuffle, in any order, and to those of rows that come later (`add_sums`).
    """
    rows = steps.select(*KEYS, F.md5(row_text(channels, unit)).alias("d"))
    word = lambda i: F.conv(F.substring("d", 8 * i + 1, 8), 16, 10).cast("long")
    return rows.groupBy(*KEYS).agg(*(F.sum(word(i)).alias(f"sum_{i}") for i in range(4)))


def add_sums(sums: DataFrame, more: DataFrame) -> DataFrame:
    """`digest_sums` of the rows of both; an episode's appended steps are hashed alone."""
    return sums.unionByName(more).groupBy(*KEYS).agg(*(F.sum(f"sum_{i}").alias(f"sum_{i}") for i in range(4)))


def hash_of(sums: DataFrame) -> DataFrame:
    """(keys, content_hash): the sum of the rows' digests modulo 2^128, as 32 hexadecimal digits."""
    carried = sums
    for i in (2, 1, 0):
        carried = carried.withColumn(f"sum_{i}", F.col(f"sum_{i}") + F.shiftright(f"sum_{i + 1}", 32))
    digits = (F.lower(F.lpad(F.hex(F.col(f"sum_{i}").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")) for i in range(4))
    return carried.select(*KEYS, F.concat(*digits).alias("content_hash"))


def content_hash(steps: DataFrame, channels: list[str], unit: float = 1e6) -> DataFrame:
    """(keys, content_hash): of an episode's values in units of 1/`unit`, independent of row order; no task holds an episode."""
    return hash_of(digest_sums(steps, channels, unit))


def ordered_hash(steps: DataFrame, channels: list[str], unit: float = 1e6) -> DataFrame:
    """(keys, content_hash): sha256 of an episode's values in units of 1/`unit`, row by row in order of the steps.

    The rows of an episode meet in one task, as text; those of a build are at most the gate's `max_steps`.
    """
    rows = steps.select(*KEYS, F.struct("step", row_text(channels, unit).alias("text")).alias("row"))
    text = F.array_join(F.array_sort(F.collect_list("row")).getField("text"), ";")
    return rows.groupBy(*KEYS).agg(F.sha2(text, 256).alias("content_hash"))


def dedupe(episodes: DataFrame, order: tuple[str, ...] = KEYS, hash_column: str = "content_hash") -> DataFrame:
    """Adds duplicate: not the first of its hash in `order`, whose columns name a row. Empty and null hashes are never duplicates.

    The first of each hash is an aggregation that adds up before the shuffle, and is joined back on
    `order`; so a hash that many rows share, or lack, loads no task.
    """
    hashed = F.coalesce(F.col(hash_column), F.lit("")) != ""
    first = episodes.filter(hashed).groupBy(hash_column).agg(F.min(F.struct(*order)).alias("_f")).select(
        *(F.col(f"_f.{c}").alias(f"_{c}") for c in order),
        F.lit(True).alias("_first"),
    )
    joined = episodes.join(first, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order], "left")
    return joined.withColumn("duplicate", hashed & F.col("_first").isNull()).drop("_first", *(f"_{c}" for c in order))


def split_share(session: Column, seed: int) -> Column:
    """A session's fixed place in [0, 1)."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), session), 256), 1, 8), 16, 10).cast("double") / 2.0**32


def assign_split(session: Column, profile: Profile) -> Column:
    """'val' or 'train'; a session never changes sides when others come or go."""
    return F.when(split_share(session, profile.seed) < profile.val_fraction, "val").otherwise("train")


def prev_action(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds prev_<c>: the value a step before; the first row's own. A later hole stays a hole."""
    w = episode_window("step")
    first = F.row_number().over(w) == 1
    return df.withColumns({f"prev_{c}": F.when(first, F.col(c)).otherwise(F.lag(c).over(w)) for c in columns})


def dense_steps(df: DataFrame, needed: list[str]) -> DataFrame:
    """Drops rows with a hole in a needed channel and numbers the rest from 0."""
    return df.dropna(subset=needed).withColumn("step", (F.row_number().over(episode_window("t_us", "step")) - 1).cast("int"))


def norm_stats(table: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mean, std): population deviation, at least 1e-6; a column without values is (0, 1)."""
    row = table.agg(*(x for c in columns for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))))
    pairs = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce(F.col(f"m_{c}"), F.lit(0.0)).alias("mean"),
                F.coalesce(F.greatest(F.col(f"s_{c}"), F.lit(1e-6)), F.lit(1.0)).alias("std"),
            ) for c in columns
        )
    )
    return row.select(F.inline(pairs))


def normalise(table: DataFrame, stats: dict[str, tuple[float, float]], back: bool = False) -> DataFrame:
    """(x - mean) / std of each column, or back again."""
    return table.withColumns({c: F.col(c) * s + m if back else (F.col(c) - m) / s for c, (m, s) in stats.items()})


def build(
    steps: DataFrame, gated: DataFrame, obs: list[str], act: list[str], profile: Profile, check: bool = False, keep: Callable[[DataFrame], DataFrame] = lambda df: df,
    hashed: Callable[[DataFrame, list[str]], DataFrame] = content_hash,
) -> tuple[DataFrame, DataFrame]:
    """(table, members): the split step table, and every episode with its exclude_reason, split and content_hash.

    Steps are joined to the passing episodes before any window work. With `check`, a build without
    episodes or with an empty side is an error (`check_split`), which runs a job. `keep` may store a
    table that is read several times; `hashed` makes the content_hash of the passing episodes.
    """
    base = [c for c in [*obs, *act] if not c.startswith("prev_")]
    passing = gated.filter("exclude_reason is null").select(*KEYS)
    kept = steps.join(passing, list(KEYS), "left_semi")
    members = keep(gated.drop("content_hash").join(hashed(kept, profile.channels()), list(KEYS), "left"))  # `dedupe` reads it twice
    members = dedupe(members).withColumn("exclude_reason", F.when(F.col("duplicate"), "duplicate").otherwise(F.col("exclude_reason")))
    members = members.withColumn("split", F.when(F.col("exclude_reason").isNull(), assign_split(F.col("session_id"), profile)))
    members = keep(members)
    rows = kept.join(members.filter("split is not null").select(*KEYS, "split"), list(KEYS))
    rows = prev_action(rows, [c.removeprefix("prev_") for c in obs if c.startswith("prev_")])
    table = keep(dense_steps(rows, [*obs, *act]).select(*KEYS, "split", "step", "t_us", *dict.fromkeys([*obs, *base, *act])))
    left = table.select(*KEYS).distinct().withColumn("_left", F.lit(True))
    members = members.join(left, list(KEYS), "left")
    hole = F.col("split").isNotNull() & F.col("_left").isNull()
    members = members.withColumns(
        {"exclude_reason": F.when(hole, "all_nan").otherwise(F.col("exclude_reason")), "split": F.when(~hole, F.col("split"))}
    ).drop("_left")
    if check:
        check_split(members)
    return table, keep(members)


def check_split(members: DataFrame) -> None:
    """An error if no episode is kept, or a side is empty."""
    sides = {r["split"] for r in members.filter("split is not null").select("split").distinct().collect()}
    if not sides:
        raise ValueError("no episode is left after filtering")
    for side in ("train", "val"):
        if side not in sides:
            raise ValueError(f"the {side} split is empty")


def dataset_hash(members: DataFrame, selection: str, buckets: int = 4) -> DataFrame:
    """One row: 16 hex digits that change with the selection, the members or their contents.

    Members are hashed in 16^buckets groups by the first digits of their own digest, then the groups' hashes.
    """
    digest = F.sha2(F.concat_ws(":", "split", "session_id", "episode_id", "content_hash"), 256)
    whole = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "|"), 256)
    parts = members.filter("split is not null").select(digest.alias("d")).groupBy(
        F.substring("d", 1, buckets).alias("b")
    ).agg(whole("d").alias("h"))
    return parts.agg(F.substring(F.sha2(F.concat(F.lit(selection + "|"), whole("h")), 256), 1, 16).alias("dataset_hash"))


def manifest(table: DataFrame, members: DataFrame, obs: list[str], act: list[str], profile: Profile) -> DataFrame:
    """One row that describes a build: columns, filters, normalisation of the train split, exclusions, splits and dataset_hash."""
    norm = norm_stats(table.filter("split = 'train'"), [*dict.fromkeys([*obs, *act])])
    norm = norm.agg(F.sort_array(F.collect_list(F.struct("column", "mean", "std"))).alias("norm"))
    out = members.filter("exclude_reason is not null").groupBy("exclude_reason").agg(F.count("*").alias("n")).agg(
        F.sort_array(F.collect_list(F.struct("exclude_reason", "n"))).alias("excluded")
    )
    sides = members.filter("split is not null").groupBy("split").agg(
        F.count("*").alias("n_episodes"),
        F.countDistinct("session_id").alias("n_sessions"),
    )
    steps = table.groupBy("split").agg(F.count("*").alias("n_steps"))
    sides = sides.join(steps, "split").agg(
        F.sort_array(F.collect_list(F.struct("split", "n_episodes", "n_sessions", "n_steps"))).alias("splits")
    )
    filters = {
        "min_tier": profile.min_tier,
        "require_success": profile.require_success,
        "val_fraction": profile.val_fraction,
        "seed": profile.seed,
    }
    hashed = dataset_hash(members, json.dumps([obs, act, filters]))
    fixed = hashed.select(
        F.array(*map(F.lit, obs)).alias("obs_columns"),
        F.array(*map(F.lit, act)).alias("action_columns"),
        F.lit(json.dumps(filters)).alias("filters"),
        "dataset_hash",
    )
    return fixed.join(norm).join(out).join(sides)  # one row each


def action_chunks(table: DataFrame, act: list[str], horizon: int, obs: list[str] = (), contiguous_dt: int | None = None) -> DataFrame:
    """(keys, window, obs, actions, prev_action): overlapping windows of `horizon` actions, never across episodes.

    With contiguous_dt, windows over a hole in time (steps dropped in between) are left out.
    """
    w = episode_window("step")
    ahead = w.rowsBetween(0, horizon - 1)
    df = table.withColumns({
        "actions": F.collect_list(F.array(*act)).over(ahead),
        "prev_action": F.when(F.row_number().over(w) == 1, F.array(*act)).otherwise(F.lag(F.array(*act)).over(w)),
        "_span": F.max("t_us").over(ahead) - F.col("t_us"),
    })
    df = df.filter(F.size("actions") == horizon)
    if contiguous_dt is not None:
        df = df.filter(F.col("_span") == contiguous_dt * (horizon - 1))
    extra = ["split"] if "split" in table.columns else []
    return df.select(*KEYS, *extra, F.col("step").alias("window"), F.array(*(F.col(c) for c in obs)).alias("obs"), "actions", "prev_action")
