"""Nearest neighbours by incremental search in a few stable projections.

Vectors get one more component that turns the largest inner product into the smallest Euclidean
distance, and are projected on a few Gaussian directions. A kd-tree over the projections of a sample
cuts the projected space into blocks; every row goes to its block, where a kd-tree of its own
gives small leaves. The ratio of projected to true squared distance follows a chi-square law with
as many degrees of freedom as directions, so a block or leaf whose projected distance is too large
for the k-th distance found so far holds a nearer row only with probability 1 - `sure`.

A query first searches the block it lies in. Then it visits, with the k-th distance it has, only the
blocks that the chi-square test leaves open, leaf by leaf in the order of projected distance, each
member verified on its original vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strandflow.llm.common import cut, map_rows

DIRECTIONS, LEAF, BLOCK_ROWS = 8, 32, 4096
#: Rows whose projections shape the top tree, at most, and how many of them a block has at least.
SAMPLE_ROWS, SAMPLE_PER_BLOCK = 65_536, 16
SURE = 0.97
RESULT = "query_id long, rank int, vec_id long, score double"


def chi_square(x: np.ndarray, degrees: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x, np.float64) / 2
    term = total = np.exp(-half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - total


def reach(sure: float, degrees: int) -> float:
    """The ratio below which a chi-square variable stays with probability `sure`."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(np.array(mid), degrees) < sure else (low, mid)
    return high


def directions(dims: int, n: int = DIRECTIONS) -> np.ndarray:
    return np.random.RandomState(17).standard_normal((dims, n))


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """Members of the leaves of a kd-tree: halved along the widest side until a leaf is small."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        own = open_.pop()
        if len(own) <= LEAF:
            done.append(own)
            continue
        p = points[own]
        axis = int(np.argmax(p.max(0) - p.min(0)))
        order = np.argpartition(p[:, axis], len(own) // 2)
        open_ += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return done


def top_tree(points: np.ndarray, blocks: int) -> list[tuple[int, float, int, int]]:
    """Nodes (axis, limit, lower child, upper child) that cut the points into about `blocks` equal parts; a child below 0 is block -child - 1."""
    nodes: list[list] = []
    done = 0

    def grow(own: np.ndarray, parts: int) -> int:
        nonlocal done
        p = points[own]
        axis = int(np.argmax(p.max(0) - p.min(0))) if len(p) else 0
        if parts < 2 or len(own) < 2 or p[:, axis].max() == p[:, axis].min():
            done += 1
            return -done
        low = parts // 2
        limit = float(np.quantile(p[:, axis], low / parts))
        if not (p[:, axis] < limit).any():
            limit = float(np.min(p[:, axis][p[:, axis] > limit]))
        at = len(nodes)
        nodes.append([axis, limit, 0, 0])
        below = p[:, axis] < limit
        nodes[at][2] = grow(own[below], low)
        nodes[at][3] = grow(own[~below], parts - low)
        return at

    grow(np.arange(len(points)), blocks)
    return [tuple(n) for n in nodes]


def block_of(points: np.ndarray, tree: list[tuple[int, float, int, int]]) -> np.ndarray:
    """The block of each point."""
    out = np.zeros(len(points), np.int64)
    open_ = [(0, np.arange(len(points)))] if tree else []
    while open_:
        node, own = open_.pop()
        axis, limit, low, high = tree[node]
        below = points[own, axis] < limit
        for child, part in ((low, own[below]), (high, own[~below])):
            if child < 0:
                out[part] = -child - 1
            elif len(part):
                open_.append((child, part))
    return out


def lifted(v: np.ndarray, most: float) -> np.ndarray:
    """Projections of vectors with their additional component."""
    extra = np.sqrt(np.maximum(most - (v * v).sum(1), 0))
    return np.hstack([v, extra[:, None]]) @ directions(v.shape[1] + 1)


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _index(dealt: DataFrame, n: int, most: float, dims: int, kind: str) -> DataFrame:
    """One row per block with the ids and vectors of its rows in kd-tree order, leaf sizes and bounds, and the bounds of all.

    Rows that repeat both id and vector count once.
    """

    def pack(block: int, ids: list[np.ndarray], vectors: list[np.ndarray]) -> list[pa.Array]:
        i, v = np.concatenate(ids), np.concatenate(vectors)
        whole = np.concatenate(
            [i[:, None].view(np.uint8).reshape(len(i), -1), np.ascontiguousarray(v).view(np.uint8).reshape(len(i), -1)],
            axis=1,
        )
        once = np.sort(np.unique(np.ascontiguousarray(whole).view(np.dtype((np.void, whole.shape[1]))).ravel(), return_index=True)[1])
        i, v = i[once], v[once]
        p = lifted(v, most)
        parts = leaves(p)
        order = np.concatenate(parts)
        bounds = np.array([[p[x].min(0), p[x].max(0)] for x in parts])
        sizes = np.array([len(x) for x in parts], np.int64)
        box = np.array([p.min(0), p.max(0)])
        return [
            pa.array([block], pa.int64()),
            *(pa.array([x.tobytes()], pa.binary()) for x in (i[order], v[order].astype(kind), bounds, sizes, box)),
        ]

    names = ["block", "ids", "vectors", "bounds", "sizes", "box"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vectors = None, [], []
        for batch in batches:
            block, i, v = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _vectors(batch.column(2), dims)
            cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
            for x, y in zip(cuts, np.append(cuts[1:], len(block)), strict=True):
                if block[x] != now:
                    if ids:
                        yield pa.RecordBatch.from_arrays(pack(now, ids, vectors), names)
                    now, ids, vectors = int(block[x]), [], []
                ids.append(i[x:y])
                vectors.append(v[x:y])
        if ids:
            yield pa.RecordBatch.from_arrays(pack(now, ids, vectors), names)

    own = dealt.select("block", "vec_id", "embedding").repartition(n, "block").sortWithinPartitions("block", "vec_id")
    return own.mapInArrow(run, "block long, ids binary, vectors binary, bounds binary, sizes binary, box binary")


def search_block(
    q_ids: np.ndarray,
    q: np.ndarray,
    known: np.ndarray,
    ids: np.ndarray,
    v: np.ndarray,
    bounds: np.ndarray,
    sizes: np.ndarray,
    most: float,
    k: int,
    sure: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores (one row per query, best first, -inf where there are fewer) of the k best found in a block; `known` is each query's k-th score so far."""
    limit = reach(sure, DIRECTIONS)
    projected = q @ directions(q.shape[1] + 1)[:-1]
    away = np.maximum(bounds[None, :, 0] - projected[:, None], projected[:, None] - bounds[None, :, 1])
    distance = (np.maximum(away, 0) ** 2).sum(2)
    order = np.argsort(distance, axis=1)
    begin = np.cumsum(sizes) - sizes
    best, score = np.zeros((len(q), k), np.int64), np.full((len(q), k), -np.inf)
    norm = (q * q).sum(1)
    active = np.arange(len(q))
    lane = np.arange(LEAF)
    for step in range(len(sizes)):
        leaf = order[active, step]
        kth = np.maximum(norm[active] + most - 2 * np.maximum(score[active, -1], known[active]), 0)
        go = ~(distance[active, leaf] > limit * kth)
        active, leaf = active[go], leaf[go]
        if not len(active):
            break
        at = np.minimum(begin[leaf][:, None] + lane, len(ids) - 1)
        found = np.einsum("ad,abd->ab", q[active], v[at])
        found[(lane >= sizes[leaf][:, None]) | (ids[at] == q_ids[active][:, None])] = -np.inf
        found[found < known[active][:, None]] = -np.inf  # cannot be among the k best
        both_s, both_i = np.hstack([score[active], found]), np.hstack([best[active], ids[at]])
        keep = np.lexsort((both_i, -both_s), axis=1)[:, :k]
        score[active], best[active] = np.take_along_axis(both_s, keep, 1), np.take_along_axis(both_i, keep, 1)
    return best, score


_VISIT = "query_id long, embedding array<double>, known double, block long"


def _search(visits: DataFrame, index: DataFrame, dims: int, most: float, k: int, sure: float, kind: str) -> DataFrame:
    """(query_id, embedding, vec_ids, scores): for each visit (_VISIT), the at most k best of its block."""
    # a block's one row comes first, then its visits
    none = F.lit(None)
    rows = index.select(
        "block",
        F.lit(0).alias("part"),
        none.cast("long").alias("query_id"),
        none.cast("array<double>").alias("embedding"),
        none.cast("double").alias("known"),
        "ids",
        "vectors",
        "bounds",
        "sizes",
    )
    asks = visits.select(
        "block",
        F.lit(1).alias("part"),
        "query_id",
        "embedding",
        "known",
        *(none.cast("binary").alias(c) for c in ("ids", "vectors", "bounds", "sizes")),
    )
    both = rows.unionAll(asks).repartition("block").sortWithinPartitions("block", "part")

    def answer(held: dict, q_ids: list, q: list, known: list) -> Iterator[pa.RecordBatch]:
        if q_ids and held:
            vectors = np.array(q, np.float64)
            best, score = search_block(
                np.array(q_ids, np.int64),
                vectors,
                np.array(known),
                held["ids"],
                held["vectors"],
                held["bounds"],
                held["sizes"],
                most,
                k,
                sure,
            )
            some = score > -np.inf
            yield pa.RecordBatch.from_arrays([
                pa.array(q_ids, pa.int64()), pa.array(q, pa.list_(pa.float64())),
                pa.array([b[s] for b, s in zip(best, some, strict=True)], pa.list_(pa.int64())), pa.array(
                    [x[s] for x, s in zip(score, some, strict=True)],
                    pa.list_(pa.float64()),
                ),
            ], ["query_id", "embedding", "vec_ids", "scores"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, q_ids, q, known = None, {}, [], [], []
        for batch in batches:
            for block, part, i, e, s, *packed in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns)), strict=True):
                if block != now or len(q_ids) >= 256:
                    yield from answer(held, q_ids, q, known)
                    q_ids, q, known = [], [], []
                if block != now:
                    now, held = block, {}
                if part == 0:
                    ids, vectors, bounds, sizes = packed
                    held = {
                        "ids": np.frombuffer(ids, np.int64),
                        "vectors": np.frombuffer(vectors, kind).astype(np.float64).reshape(-1, dims),
                        "bounds": np.frombuffer(bounds).reshape(-1, 2, DIRECTIONS),
                        "sizes": np.frombuffer(sizes, np.int64),
                    }
                else:
                    q_ids.append(i)
                    q.append(e)
                    known.append(-np.inf if s is None else s)
        yield from answer(held, q_ids, q, known)

    return both.mapInArrow(run, "query_id long, embedding array<double>, vec_ids array<long>, scores array<double>")


def _nearest(rows_in: DataFrame, n: int, most: float, dims: int, k: int, sure: float, kind: str) -> DataFrame:
    """The neighbours among rows (vec_id, embedding, asks) of one length, unranked."""
    share = min(1.0, SAMPLE_ROWS / n)
    draw = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(1 << 32)) / float(1 << 32)
    sample = rows_in.filter(draw < share * 0.9 if share < 1 else F.lit(True)).select("embedding").limit(SAMPLE_ROWS).toArrow()
    points = lifted(_vectors(sample.column(0).combine_chunks(), dims), most) if sample.num_rows else np.zeros((0, DIRECTIONS))
    n_blocks = max(1, min(-(-n // BLOCK_ROWS), len(points) // SAMPLE_PER_BLOCK))
    tree = top_tree(points, n_blocks)

    def deal(c):
        return {"block": block_of(lifted(_vectors(c["embedding"], dims), most), tree), **{x: c[x] for x in ("vec_id", "embedding", "asks")}}

    dealt = map_rows(rows_in, deal, "block long, vec_id long, embedding array<double>, asks boolean")
    index = cut(_index(dealt, n_blocks, most, dims, kind), "index")
    boxes = {
        r["block"]: np.frombuffer(r["box"]).reshape(2, DIRECTIONS) for r in index.select("block", "box").collect()
    }  # n_blocks small rows
    asked = dealt.filter("asks").select(
        F.col("vec_id").alias("query_id"),
        "embedding",
        F.lit(None).cast("double").alias("known"),
        "block",
    ).distinct()
    home = cut(_search(asked, index, dims, most, k, sure, kind), "home")
    names, low, high = np.array(sorted(boxes), np.int64), *(np.array([boxes[b][i] for b in sorted(boxes)]) for i in range(2))
    limit = reach(sure, DIRECTIONS)

    def visit(c):
        out = {x: [] for x in ("query_id", "embedding", "known", "block")}
        q = _vectors(c["embedding"], dims)
        own = block_of(lifted(q, most), tree)
        at = q @ directions(dims + 1)[:-1]
        for i, (scores, p, x, b) in enumerate(zip(c["scores"].to_pylist(), at, q, own, strict=True)):
            known = scores[k - 1] if len(scores) >= k else -np.inf
            away = (np.maximum(np.maximum(low - p, p - high), 0) ** 2).sum(1)
            go = names[(names != b) & ~(away > limit * max((x * x).sum() + most - 2 * known, 0))].tolist()
            out["query_id"] += [c["query_id"][i].as_py()] * len(go)
            out["embedding"] += [x.tolist()] * len(go)
            out["known"] += [known] * len(go)
            out["block"] += go
        return out

    more = _search(map_rows(home, visit, _VISIT), index, dims, most, k, sure, kind)
    pairs = lambda df: df.select("query_id", F.explode(F.arrays_zip(F.col("vec_ids").alias("vec_id"), F.col("scores").alias("score"))).alias("x")).select("query_id", "x.vec_id", "x.score")
    return pairs(home).unionAll(pairs(more))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, sure: float = SURE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows by inner product, ties to the smaller vec_id.

    Every row is indexed; the top tree is shaped by at most SAMPLE_ROWS of them. Rows whose vector is null,
    zero, or holds null or non-finite components take no part, nor do rows without an id; vectors of
    different lengths are searched apart. A query never finds rows of its own id. Rows that repeat
    both id and vector count once; rows that share only an id are candidates of their own, and their
    queries one query. An empty table gives no rows.
    """
    good = F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ) & F.exists("embedding", lambda x: x != 0)
    single = dict(vectors.dtypes)["embedding"] in ("array<float>",)
    rows_in = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows_in = rows_in.filter(good & F.col("vec_id").isNotNull())
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    stats = rows_in.groupBy(F.size("embedding").alias("dims")).agg(
        F.count("*").alias("n"),
        F.max(norm).alias("most"),
        F.count_if("asks").alias("asked"),
    ).collect()
    found = None
    for r in stats:  # the lengths of vectors
        if r["asked"]:
            one = _nearest(
                rows_in.filter(F.size("embedding") == r["dims"]),
                r["n"],
                float(r["most"]) * (1 + 1e-9),
                r["dims"],
                k,
                sure,
                "<f4" if single else "<f8",
            )
            found = one if found is None else found.unionAll(one)
    if found is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
