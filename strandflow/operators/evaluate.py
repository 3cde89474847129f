"""Errors of predictors on action chunks: baselines, skill, bootstrap intervals, drift, and a ridge chunk policy.

The policy reads normalised observations and gives normalised chunks; its model is a dict of the
columns' means and deviations (from the train split) and one weight matrix per candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructType

from strandflow.operators.canonical import KEYS, episode_window

PREDICTORS = ("zero", "train_mean", "persistence")


def long_form(windows: DataFrame, *chunks: str) -> DataFrame:
    """One row per window, offset k and dimension d: truth, the previous action and the cells of other `chunks` columns."""
    rows = F.arrays_zip(F.col("actions").alias("truth"), *chunks)
    df = windows.select(*KEYS, "window", "prev_action", F.posexplode(rows).alias("k", "_row"))
    cells = F.arrays_zip(*(F.col(f"_row.{c}").alias(c) for c in ("truth", *chunks)))
    df = df.select(*KEYS, "window", "k", "prev_action", F.posexplode(cells).alias("d", "_cell"))
    return df.select(*KEYS, "window", "k", "d", F.element_at("prev_action", F.col("d") + 1).alias("prev"), "_cell.*")


def baselines(long: DataFrame, train_mean: DataFrame) -> DataFrame:
    """Adds the three trivial predictions; train_mean is (d, mean), one row per action dimension."""
    return long.join(F.broadcast(train_mean), "d").withColumns(
        {"zero": F.lit(0.0), "train_mean": F.col("mean"), "persistence": F.col("prev")}
    ).drop("mean")


def baseline_errors(predicted: DataFrame, predictors: tuple[str, ...] = PREDICTORS) -> DataFrame:
    """(predictor, next_step_mae, chunk_mae)."""
    row = predicted.agg(
        *(
            x for p in predictors for e in [F.abs(F.col(p) - F.col("truth"))] for x in (
                F.avg(F.when(F.col("k") == 0, e)).alias(f"n_{p}"),
                F.avg(e).alias(f"c_{p}"),
            )
        )
    )
    return row.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(p).alias("predictor"),
                        F.col(f"n_{p}").alias("next_step_mae"),
                        F.col(f"c_{p}").alias("chunk_mae"),
                    ) for p in predictors
                )
            )
        )
    )


def mae_by_offset(predicted: DataFrame, predictors: tuple[str, ...] = PREDICTORS) -> DataFrame:
    """(k, mae of each predictor)."""
    return predicted.groupBy("k").agg(*(F.avg(F.abs(F.col(p) - F.col("truth"))).alias(p) for p in predictors))


def policy_errors(predicted: DataFrame, name: str, grip: int | None = None) -> DataFrame:
    """One row: MAE and RMSE at offset 0, chunk MAE, for the gripper's dimension MAE and open/closed accuracy, windows and episodes."""
    e, now = F.col(name) - F.col("truth"), F.col("k") == 0
    at = now & (F.col("d") == (-1 if grip is None else grip))
    return predicted.agg(
        F.avg(F.when(now, F.abs(e))).alias("mae"), F.sqrt(F.avg(F.when(now, e * e))).alias("rmse"), F.avg(F.abs(e)).alias("chunk_mae"),
        F.avg(F.when(at, F.abs(e))).alias("gripper_mae"), F.avg(
            F.when(at, ((F.col(name) > 0.5) == (F.col("truth") > 0.5)).cast("double"))
        ).alias("gripper_accuracy"),
        F.count_if(now & (F.col("d") == 0)).alias("n_windows"), F.countDistinct(*KEYS).alias("n_episodes"),
    )


def joint_errors(predicted: DataFrame, name: str) -> DataFrame:
    """(d, mae): error at offset 0 per action dimension."""
    return predicted.filter("k = 0").groupBy("d").agg(F.avg(F.abs(F.col(name) - F.col("truth"))).alias("mae"))


def skill(errors: DataFrame, policy: str, predictors: tuple[str, ...] = PREDICTORS) -> DataFrame:
    """One row: the best baseline by chunk MAE (ties in the given order) and the policy's skill; null where the best error is 0.

    chunk_skill is against that baseline; next_step_skill is against the smallest next-step error of any baseline.
    """
    place = F.array_position(F.array(*(F.lit(p) for p in predictors)), F.col("predictor"))
    best = F.min(F.when(place > 0, F.struct("chunk_mae", place.alias("place"), "predictor")))
    own = lambda c: F.max(F.when(F.col("predictor") == policy, F.col(c)))
    row = errors.agg(
        best.alias("b"),
        F.min(F.when(place > 0, F.col("next_step_mae"))).alias("s"),
        own("chunk_mae").alias("c"),
        own("next_step_mae").alias("n"),
    )
    gain = lambda own, base: 1 - F.try_divide(F.col(own), F.nullif(F.col(base), F.lit(0.0)))
    return row.select(
        F.col("b.predictor").alias("best_baseline"),
        gain("c", "b.chunk_mae").alias("chunk_skill"),
        gain("n", "s").alias("next_step_skill"),
    )


def offset_curve(predicted: DataFrame, policy: str, predictors: tuple[str, ...] = PREDICTORS) -> DataFrame:
    """(k, policy, best_baseline, best, winner, loses_everywhere): the policy beside the one baseline with the lowest chunk MAE, offset by offset."""
    cells = predicted.groupBy("k").agg(
        F.count("truth").alias("_n"),
        *(F.avg(F.abs(F.col(p) - F.col("truth"))).alias(f"_{p}") for p in (policy, *predictors)),
    )
    chunk = lambda p: F.sum(F.col(f"_{p}") * F.col("_n")) / F.sum("_n")
    best = F.array_min(
        F.array(*(F.struct(chunk(p).alias("mae"), F.lit(i).alias("i"), F.lit(p).alias("name")) for i, p in enumerate(predictors)))
    )
    whole = cells.agg(best.alias("_b"))  # one row
    value = F.coalesce(*(F.when(F.col("_b.name") == p, F.col(f"_{p}")) for p in predictors))
    curve = cells.join(F.broadcast(whole)).select(
        "k",
        F.col(f"_{policy}").alias("policy"),
        F.col("_b.name").alias("best_baseline"),
        value.alias("best"),
    )
    loses = curve.agg(F.min(F.col("policy") >= F.col("best")).alias("loses_everywhere"))  # one row
    winner = F.when(F.col("policy") < F.col("best"), "policy").otherwise(F.col("best_baseline"))
    return curve.withColumn("winner", winner).join(F.broadcast(loses))


def cluster_bootstrap(values: DataFrame, group: list[str], value: str, draws: int, seed: int, alpha: float = 0.05) -> DataFrame:
    """One row (low, high): resamples whole groups with replacement; the mean is over all their rows. Below 2 groups both are null.

    Draw r, i of a replicate is the md5 of "seed:r:i" modulo the number of groups. Groups are numbered by
    the first two digits of their keys' md5, then by their keys: within each of the 256 parts
    by itself, behind the sizes of the parts before. Per-group sums are joined to the draws: a row
    for each group and replicate, so that SQL can state them; `bootstrap` draws without such rows.
    """
    stats = values.groupBy(*group).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    stats = stats.withColumn("part", F.substring(F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in group))), 1, 2))
    parts = stats.groupBy("part").agg(F.count("*").alias("size"))
    before = parts.alias("p").join(parts.alias("o"), F.col("o.part") < F.col("p.part"), "left")  # at most 256 x 256 rows
    before = before.groupBy("p.part").agg(F.coalesce(F.sum("o.size"), F.lit(0)).alias("before"))
    numbered = stats.join(F.broadcast(before), "part").withColumn(
        "g",
        F.row_number().over(W.partitionBy("part").orderBy(*group)) - 1 + F.col("before"),
    )
    size = stats.agg(F.count("*").alias("size"))
    rows = stats.sparkSession.range(draws).select(F.col("id").alias("r")).join(F.broadcast(size))
    rows = rows.select("r", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size"), F.lit(1)) - 1)).alias("i"))
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "r", "i")), 1, 8), 16, 10).cast("long")
    drawn = rows.withColumn("g", key % F.nullif(F.col("size"), F.lit(0))).join(numbered.select("g", "s", "n"), "g")
    means = drawn.groupBy("r", "size").agg((F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("mean")).filter("size >= 2")
    return means.agg(F.percentile("mean", F.lit(alpha / 2)).alias("low"), F.percentile("mean", F.lit(1 - alpha / 2)).alias("high"))


#: Groups whose replicate counts are drawn together: rows of a matrix with a column for each replicate.
DRAWN = 1024


def _replicates(seed: int, part: int, sizes: np.ndarray, draws: int, groups: Iterator[np.ndarray]) -> np.ndarray:
    """(draws, 2): of a part's groups (rows of sum and number), what each replicate drew of them in total.

    A replicate draws as many groups as there are. The part's share of these draws is binomial given those
    of the parts before, a block's given those of the blocks before, and within a block all groups
    are alike. The same seeds give every task the same shares.
    """
    shares, left, open_ = np.random.default_rng([seed, 0]), np.full(draws, sizes.sum()), int(sizes.sum())
    for size in sizes[:part].tolist():
        left = left - shares.binomial(left, size / open_)
        open_ -= size
    size = int(sizes[part])
    left = shares.binomial(left, size / open_)
    rng, total = np.random.default_rng([seed, 1, part]), np.zeros((draws, 2))
    for block in groups:
        own = rng.binomial(left, len(block) / size)
        left, size = left - own, size - len(block)
        counts = rng.multinomial(own, np.full(len(block), 1 / len(block)))
        total += counts @ block
    return total


def bootstrap(values: DataFrame, group: list[str], value: str, draws: int, seed: int, alpha: float = 0.05, parts: int = 256) -> DataFrame:
    """One row (low, high, mean, deviation) of the mean over all rows when whole groups are drawn with replacement, and its replicates' mean and deviation. Below 2 groups all are null.

    Groups are dealt to `parts` by a hash of their keys, and each part draws by itself how often a replicate takes each of its
    groups (`_replicates`), DRAWN groups at a time; it hands on one row for each replicate.
    There is no row for a draw, and no task holds more than DRAWN x `draws` counts.
    """
    keys = [f"g{i}" for i in range(len(group))]
    stats = values.groupBy(*(F.col(c).alias(k) for c, k in zip(group, keys, strict=True))).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    stats = stats.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
    sizes = np.zeros(parts, np.int64)
    for r in stats.groupBy("part").agg(F.count("*").alias("size")).collect():  # at most `parts` rows
        sizes[r["part"]] = r["size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        now = None

        def told() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            found = _replicates(seed, now, sizes, draws, (rows[at : at + DRAWN] for at in range(0, len(rows), DRAWN)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(draws)), pa.array(found[:, 0]), pa.array(found[:, 1])], ["r", "s", "n"])

        for b in batches:
            part, s, n = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
            for x, y in zip(cuts, np.append(cuts[1:], len(part)), strict=True):
                if part[x] != now:
                    if held:
                        yield from told()
                    now, held = int(part[x]), []
                held.append(np.stack([np.nan_to_num(s[x:y].astype(np.float64)), n[x:y].astype(np.float64)], axis=1))
        if held:
            yield from told()

    dealt = stats.repartition("part").sortWithinPartitions("part", *keys).select("part", "s", "n")
    sums = dealt.mapInArrow(run, "r long, s double, n double").groupBy("r").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    enough = F.lit(bool(sizes.sum() >= 2))
    means = sums.select(F.when(enough, F.col("s") / F.nullif("n", F.lit(0.0))).alias("mean"))
    q = lambda p: F.percentile("mean", F.lit(p))
    return means.agg(q(alpha / 2).alias("low"), q(1 - alpha / 2).alias("high"), F.avg("mean").alias("mean"), F.stddev_pop("mean").alias("deviation"))


def _starts(n: int, most: int) -> Column:
    """The spread starts of an episode of `length` steps for rollouts over n."""
    return F.expr(f"array_distinct(transform(sequence(0, {most - 1}), x -> cast(floor(x * (length - {n} - 1) / {most - 1}) as int)))")


def rollout_starts(lengths: DataFrame, n: int, most: int = 5) -> DataFrame:
    """(keys, start): up to `most` spread starts of each episode that is longer than n."""
    return lengths.filter(F.col("length") > n).select(*KEYS, F.explode(_starts(n, most)).alias("start"))


def persistence_drift(table: DataFrame, q: list[str], act: list[str], horizons: tuple[int, ...], most: int = 5) -> DataFrame:
    """(horizon, drift, n_rollouts): distance after so many steps of repeating the previous action, from the starts of `rollout_starts`.

    One pass over the table for all horizons; whether a step is a start is told from the episode's length.
    """
    w = episode_window("step")
    first = F.lag(F.lit(1)).over(w).isNull()
    df = table.withColumns(
        {f"_p{i}": F.when(first, F.col(a)).otherwise(F.lag(a).over(w)) for i, a in enumerate(act)}
        | {f"_e{n}_{i}": F.lead(c, n).over(w) for n in horizons for i, c in enumerate(q)}
    )
    df = df.withColumn("length", F.count("*").over(W.partitionBy(*KEYS)))
    parts = []
    for n in horizons:
        gap = sum(((F.col(c) + n * F.col(f"_p{i}") - F.col(f"_e{n}_{i}")) ** 2 for i, c in enumerate(q)), F.lit(0.0))
        hit = (F.col("length") > n) & F.array_contains(_starts(n, most), F.col("step").cast("int"))
        parts.append((n, F.avg(F.when(hit, F.sqrt(gap))).alias(f"d{n}"), F.count_if(hit).alias(f"c{n}")))
    row = df.agg(*(x for _, drift, count in parts for x in (drift, count)))
    told = (F.struct(F.lit(n).alias("horizon"), F.col(f"d{n}").alias("drift"), F.col(f"c{n}").alias("n_rollouts")) for n in horizons)
    return row.select(F.inline(F.array(*told)))


def smooth_l1(error: Column, beta: float = 0.1) -> Column:
    e = F.abs(error)
    return F.when(e < beta, e * e / (2 * beta)).otherwise(e - beta / 2)


def _smooth_l1(off: np.ndarray, beta: float) -> np.ndarray:
    """`smooth_l1` of absolute errors."""
    return np.where(off < beta, off * off / (2 * beta), off - beta / 2)


def gram(table: DataFrame, x: list[str], y: list[str]) -> DataFrame:
    """(i, j, value): sums of products of the columns x (and 1) with x, 1 and y; each partition sums its own products first."""
    left, right = [*x, "1"], [*x, "1", *y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(left), len(right)))
        for b in batches:
            data = {c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names} | {"1": np.ones(b.num_rows)}
            total += np.stack([data[c] for c in left]) @ np.stack([data[c] for c in right], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(left, len(right)).tolist()), pa.array(right * len(left)), pa.array(total.ravel())],
            ["i", "j", "value"],
        )

    sums = table.select(*x, *y).dropna().mapInArrow(run, "i string, j string, value double")
    return sums.groupBy("i", "j").agg(F.sum("value").alias("value"))


def _products(rows: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in rows:
        x, y = _normalised(batch, model)
        part = x.T @ np.hstack([x, y])
        total = part if total is None else total + part
    if total is not None:
        cells = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), pa.int64()), pa.array(cells)], ["cell", "value"])


def _normalised(batch: pa.RecordBatch, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """A batch's normalised observations (and a 1) and actions."""
    x, y = _matrix(batch, "obs"), _matrix(batch, "actions")
    y = (y.reshape(len(x), -1, len(model["act_mean"])) - model["act_mean"]) / model["act_std"]
    return _inputs(x, model), y.reshape(len(x), -1)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of arrays of one length (or of arrays of such arrays) as rows of numbers."""
    cells = batch.column(name)
    while pa.types.is_list(cells.type):
        cells = cells.flatten()
    return cells.to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)


def _nested(cells: np.ndarray, kind: pa.ListType) -> pa.ListArray:
    """Rows of matrices as arrays of arrays."""
    n, rows, columns = cells.shape
    ends = lambda of, each: pa.array(np.arange(of + 1) * each, pa.int32())
    inner = pa.ListArray.from_arrays(ends(n * rows, columns), pa.array(cells.ravel()), type=kind.value_type)
    return pa.ListArray.from_arrays(ends(n, rows), inner, type=kind)


def _inputs(x: np.ndarray, model: dict) -> np.ndarray:
    return np.hstack([(x - model["obs_mean"]) / model["obs_std"], np.ones((len(x), 1))])


def _outputs(x: np.ndarray, model: dict, weights: np.ndarray) -> np.ndarray:
    """Predicted chunks (rows x horizon x actions) of raw observations."""
    y = (_inputs(x, model) @ weights).reshape(len(x), -1, len(model["act_mean"]))
    return y * model["act_std"] + model["act_mean"]


def fit_policy(
    windows: DataFrame,
    stats: dict[str, tuple[float, float]],
    obs: list[str],
    act: list[str],
    ridges: tuple[float, ...] = (1e-3, 1e-1, 10.0),
) -> dict:
    """The ridge chunk policy's model: `stats` of the columns and weights (d + 1 rows, horizon * actions columns) per candidate, from one pass.

    Each partition sums its products; only the d x (d + outputs) cells are added up and reach the
    driver. The bias is not penalised.
    """
    model = {"obs": list(obs), "act": list(act)}
    for name, columns in (("obs", obs), ("act", act)):
        model[f"{name}_mean"], model[f"{name}_std"] = (np.array([stats[c][i] for c in columns], np.float64) for i in range(2))
    cells = windows.select("obs", "actions").mapInArrow(
        lambda rows: _products(rows, model), "cell long, value double"
    ).groupBy("cell").agg(F.sum("value").alias("value")).orderBy("cell").collect()
    if not cells:
        raise ValueError("no window to fit on")
    d = len(obs) + 1
    whole = np.array([r["value"] for r in cells]).reshape(d, -1)
    free = np.append(np.ones(d - 1), 0.0)
    model["weights"] = {r: np.linalg.lstsq(whole[:, :d] + np.diag(r * free), whole[:, d:], rcond=None)[0] for r in ridges}
    return model


def _weighted(rows: Iterator[pa.RecordBatch], model: dict, weights: list[np.ndarray], beta: float) -> Iterator[pa.RecordBatch]:
    """Sums of products weighted by 1 / max(|error|, beta), for each output of each candidate; and the loss of each."""
    total = None
    for batch in rows:
        if not batch.num_rows:
            continue
        x, y = _normalised(batch, model)
        i, j = np.triu_indices(x.shape[1])
        pairs, parts = x[:, i] * x[:, j], []  # the same for every output and candidate
        for w in weights:
            off = np.abs(y - x @ w)
            u = 1 / np.maximum(off, beta)
            cells = np.empty((y.shape[1], x.shape[1], x.shape[1]))
            cells[:, i, j] = cells[:, j, i] = u.T @ pairs
            parts += [cells.ravel(), (x.T @ (u * y)).ravel()]
            parts.append([_smooth_l1(off, beta).sum()])
        part = np.concatenate(parts)
        total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int64()), pa.array(total)], ["cell", "value"])


def refit(windows: DataFrame, model: dict, beta: float = 0.1, rounds: int = 15, tolerance: float = 1e-4) -> dict:
    """The model with its candidates' weights fitted on the smooth L1 loss of normalised actions, from what they are now.

    Iteratively reweighted least squares: one pass for each round and all candidates, until the penalised loss of none
    falls by more than `tolerance` of it. Each partition sums its products; only the cells, whose
    number is fixed by the layout, are added up and reach the driver. The bias is not penalised.
    `losses` tells each candidate's penalised loss before each round.
    """
    names, weights = list(model["weights"]), [w.copy() for w in model["weights"].values()]
    d, outputs = weights[0].shape
    free = np.append(np.ones(d - 1), 0.0)
    losses: dict = {r: [] for r in names}
    for _ in range(rounds):
        found = windows.select("obs", "actions").mapInArrow(
            lambda rows, now=tuple(weights): _weighted(rows, model, now, beta), "cell long, value double"
        ).groupBy("cell").agg(F.sum("value").alias("value")).orderBy("cell").collect()
        if not found:
            raise ValueError("no window to fit on")
        cells, moved = np.array([r["value"] for r in found]).reshape(len(names), -1), False
        for k, (ridge, own) in enumerate(zip(names, cells, strict=True)):
            left, right = own[: outputs * d * d].reshape(outputs, d, d), own[outputs * d * d : -1].reshape(d, outputs)
            loss = own[-1] + ridge / beta / 2 * (weights[k] ** 2 * free[:, None]).sum()
            moved |= not losses[ridge] or losses[ridge][-1] - loss > tolerance * abs(loss)
            losses[ridge].append(float(loss))
            solved = [np.linalg.lstsq(left[o] + np.diag(ridge / beta * free), right[:, o], rcond=None)[0] for o in range(outputs)]
            weights[k] = np.stack(solved, axis=1)
        if not moved:
            break
    return model | {"weights": dict(zip(names, weights, strict=True)), "losses": losses}


def fit_history(windows: DataFrame, model: dict) -> DataFrame:
    """(ridge, chunk_mae, loss, chosen) of each candidate on held-out windows, from one pass; chosen is the one of least loss (the first on a tie)."""
    names = list(model["weights"])
    sent = windows.sparkSession.sparkContext.broadcast((model, list(model["weights"].values())))
    own = [f"{c}{i}" for i in range(len(names)) for c in "ml"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(len(own))
        for b in batches:
            if b.num_rows:
                x, y = _matrix(b, "obs"), _matrix(b, "actions")
                known = ~np.isnan(y)
                n += int(known.sum())
                for i, w in enumerate(sent.value[1]):
                    off = np.abs(_outputs(x, sent.value[0], w).reshape(y.shape) - y)[known]
                    sums[2 * i : 2 * i + 2] += off.sum(), _smooth_l1(off, 0.1).sum()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), *(pa.array([s]) for s in sums)], ["n", *own])

    sums = windows.select("obs", "actions").mapInArrow(run, ", ".join(["n long", *(f"{c} double" for c in own)]))
    means = sums.agg(*((F.sum(c) / F.sum("n")).alias(c) for c in own))
    best = F.array_min(F.array(*(F.struct(F.col(f"l{i}").alias("loss"), F.lit(i).alias("i")) for i in range(len(names)))))
    structs = [
        F.struct(
            F.lit(float(r)).alias("ridge"),
            F.col(f"m{i}").alias("chunk_mae"),
            F.col(f"l{i}").alias("loss"),
            (F.col("_best.i") == i).alias("chosen"),
        ) for i, r in enumerate(names)
    ]
    return means.withColumn("_best", best).select(F.inline(F.array(*structs)))


def choose(model: dict, history: DataFrame) -> np.ndarray:
    """The weights that the history chose (its rows are as many as candidates)."""
    return model["weights"][next(r["ridge"] for r in history.collect() if r["chosen"])]


def predict(windows: DataFrame, model: dict, candidates: list | np.ndarray) -> DataFrame:
    """Adds `predicted` (horizon x actions) by one weight matrix, or predicted_0... by several candidates of the model.

    Weights are broadcast; their size is fixed by the layout.
    """
    one = isinstance(candidates, np.ndarray)
    weights = [candidates] if one else [model["weights"][r] for r in candidates]
    names = ["predicted"] if one else [f"predicted_{i}" for i in range(len(weights))]
    sent = windows.sparkSession.sparkContext.broadcast((model, weights))
    schema = StructType(list(windows.schema.fields))
    for n in names:
        schema = schema.add(n, ArrayType(ArrayType(DoubleType())))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b, "obs")
                made = [_nested(_outputs(x, sent.value[0], w), arrow.field(names[0]).type) for w in sent.value[1]]
                yield pa.RecordBatch.from_arrays([*b.columns, *made], schema=arrow)

    return windows.mapInArrow(run, schema)


def _drift(obs: np.ndarray, truth: np.ndarray, model: dict, weights: np.ndarray, n: int, horizon: int) -> np.ndarray:
    """Distance of the joints from `truth` after n steps, for many starts at once.

    Commands only add up, so a whole chunk moves the joints by its sum; of the chunk, its last action is what the next one sees.
    """
    columns, act = model["obs"], model["act"]
    joints = [columns.index(c) for c in columns if c.startswith("q_")]
    moves = [k for k, a in enumerate(act) if a.startswith("act_q_")]
    seen = {columns.index(f"prev_{a}"): k for k, a in enumerate(act) if f"prev_{a}" in columns}
    where = obs.copy()
    for length in [horizon] * (n // horizon) + [n % horizon] * (n % horizon > 0):
        taken = _outputs(where, model, weights)[:, :length]
        where[:, joints] += taken[:, :, moves].sum(axis=1)
        where[:, list(seen)] = taken[:, -1, list(seen.values())]
    return np.linalg.norm(where[:, joints] - truth, axis=1)


def rollout_drift(table: DataFrame, model: dict, weights: np.ndarray, n: int, horizon: int) -> DataFrame:
    """(keys, start, drift): open-loop distance from the recorded joints after n steps, from spread starts.

    The policy is asked every `horizon` steps and sees its own last action; other observations stay
    as recorded at the start. So a rollout needs its start row and the joints n steps later.
    Without joints, or without a command for each, there is no row.
    """
    joints = [c for c in model["obs"] if c.startswith("q_")]
    if not joints or len(joints) != sum(a.startswith("act_q_") for a in model["act"]):
        return table.sparkSession.createDataFrame([], "session_id string, episode_id string, start int, drift double")
    w = episode_window("step")
    later = F.array(*(F.lead(c, n).over(w) for c in joints))
    ends = table.select(*KEYS, F.col("step").alias("start"), F.array(*model["obs"]).alias("obs"), later.alias("truth"))
    starts = rollout_starts(table.groupBy(*KEYS).agg(F.count("*").alias("length")), n)
    rows = ends.join(starts, [*KEYS, "start"], "left_semi").select(*KEYS, F.col("start").cast("int").alias("start"), "obs", "truth")
    sent = table.sparkSession.sparkContext.broadcast((model, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                found = _drift(_matrix(b, "obs"), _matrix(b, "truth"), *sent.value, n, horizon)
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(found)], [*KEYS, "start", "drift"])

    return rows.mapInArrow(run, "session_id string, episode_id string, start int, drift double")


def check_layout(model: list[str], table: list[str]) -> None:
    """An error if a model's columns are not the table's, in order."""
    if list(model) != list(table):
        raise ValueError(f"the model's columns differ from the table's: {model} and {table}")


def hash_note(model_hash: str | None, dataset_hash: str) -> str | None:
    """A remark, not an error, if a model was fitted on another dataset: that is how a data regression is found."""
    return None if model_hash == dataset_hash else f"the model was fitted on dataset {model_hash}, not {dataset_hash}"
