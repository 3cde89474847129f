"""Hard negatives by bounds over a spanning tree of the anchors.

Anchors that lie near each other are dealt out in groups, and each group and the origin are joined by
a minimum spanning tree. Along an edge of length e, the score of a candidate x changes by at most
e * |x|, so a parent's score, or the interval it lies in, bounds the child's; at the origin every score
is 0. Walking the tree, only candidates whose interval overlaps a window that is still open are
scored again: for positives the window begins at the k-th best so far; for negatives it is cut off by
the share of the positive's score, and its lower end rises to the k-th best so far.

Candidates are packed in blocks, anchors in groups; every group meets every block once. Both are
dealt to (part of the anchors, part of the candidates), so a task holds a bounded number of
groups and one block at a time, and hands on k rows for each anchor and window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strandflow.llm.ann import DIRECTIONS, SAMPLE_PER_BLOCK, SAMPLE_ROWS, block_of, directions, top_tree
from strandflow.llm.common import cut, map_rows

#: Anchors of a tree, trees that a task holds, and candidates that it sees (about).
GROUP, GROUPS_PER_TASK, CHUNK_ROWS = 256, 16, 16_384
#: Scores up to this are exact as doubles, also times 100; larger ones are added up as integers.
EXACT = 2**53 // 100
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_PARTS = {"ids": "<i8", "keys": "<i8", "labels": "<i8", "vectors": "", "parents": "<i4", "edges": "<f8", "counts": "<i4", "found": "<i8"}
_PACKED = "number long, n int, " + ", ".join(f"{k} binary" for k in _PARTS)


def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows of `v` and the origin: the rows in an order that puts parents first, each one's parent by its place there (-1: the origin), and the edge."""
    near = np.sqrt((v * v).sum(1))
    parent, place = np.full(len(v), -1), np.zeros(len(v), np.int64)
    order, open_ = [], np.ones(len(v), bool)
    for at in range(len(v)):
        i = int(np.argmin(np.where(open_, near, np.inf)))
        order.append(i)
        place[i], open_[i] = at, False
        d = np.sqrt(((v - v[i]) ** 2).sum(1))
        closer = open_ & (d < near)
        near[closer], parent[closer] = d[closer], i
    order = np.array(order, np.int64)
    own = parent[order]
    return order, np.where(own < 0, -1, place[own]), near[order]


def _best(held: tuple | None, new: tuple, k: int) -> tuple:
    """The k best of (scores, ids, keys): higher scores first, then smaller ids."""
    scores, ids, keys = new if held is None else (np.concatenate(x) for x in zip(held, new, strict=True))
    first = np.lexsort((keys, ids, -scores))[:k]
    return scores[first], ids[first], keys[first]


class Walk:
    """Walks the trees of a task's anchors for one block of candidates after the other.

    `open_windows` of an anchor are the (low, high) between which a score still matters; `take` gets the candidates that were scored.
    """

    def __init__(self, trees: list[dict], k: int):
        self.trees, self.k, self.scored, self.seen = trees, k, 0, 0
        self.held: dict[tuple, tuple] = {}

    def kth(self, key: tuple) -> float:
        held = self.held.get(key)
        return -np.inf if held is None or len(held[0]) < self.k else float(held[0][-1])

    def block(self, c: dict, exact: bool) -> None:
        x = c["vectors"]
        whole = x if exact else x.astype(np.int64)
        norm = np.sqrt((x * x).sum(1))
        for t, tree in enumerate(self.trees):
            n = len(tree["ids"])
            low, high = np.empty((n, len(x))), np.empty((n, len(x)))
            for j in range(n):
                reach, p = tree["edges"][j] * norm * (1 + 1e-9) + 0.5, tree["parents"][j]
                low[j], high[j] = (-reach, reach) if p < 0 else (low[p] - reach, high[p] + reach)
                windows = self.open_windows(t, j)
                need = self.candidates(tree, j, c)
                hit = np.zeros(len(x), bool)
                for a, b in windows:
                    hit |= (high[j] >= a) & (low[j] <= b)
                at = np.flatnonzero(need & hit)
                self.seen, self.scored = self.seen + int(need.sum()), self.scored + len(at)
                if not len(at):
                    continue
                anchor = tree["vectors"][j]
                score = (x[at] @ anchor).astype(np.int64) if exact else whole[at] @ anchor.astype(np.int64)
                low[j, at] = high[j, at] = score
                self.take(t, j, score, c["ids"][at], c["keys"][at])


class Positives(Walk):
    """The k best other candidates of an anchor's own label."""

    def open_windows(self, t: int, j: int) -> list[tuple[float, float]]:
        return [(self.kth((t, j)), np.inf)]

    def candidates(self, tree: dict, j: int, c: dict) -> np.ndarray:
        return (c["labels"] == tree["labels"][j]) & ~((c["ids"] == tree["ids"][j]) & (c["keys"] == tree["keys"][j]))

    def take(self, t: int, j: int, scores, ids, keys) -> None:
        self.held[t, j] = _best(self.held.get((t, j)), (scores, ids, keys), self.k)

    def rows(self) -> Iterator[tuple]:
        for (t, j), held in self.held.items():
            own = self.trees[t]
            for s, i, key in zip(*(x.tolist() for x in held), strict=True):
                yield int(own["ids"][j]), int(own["keys"][j]), i, key, s


class Negatives(Walk):
    """For each positive of an anchor, the k best candidates of other labels between two shares, in hundredths, of the positive's score."""

    def __init__(self, trees: list[dict], k: int, low: int, high: int):
        super().__init__(trees, k)
        self.low, self.high = low, high

    def positives(self, t: int, j: int) -> np.ndarray:
        tree = self.trees[t]
        end = tree["ends"][j]
        return tree["found"][end - tree["counts"][j] : end]

    def open_windows(self, t: int, j: int) -> list[tuple[float, float]]:
        return [
            (max(self.low * p / 100, self.kth((t, j, i))), self.high * p / 100)
            for i, p in enumerate(self.positives(t, j)[:, 2].tolist())
        ]

    def candidates(self, tree: dict, j: int, c: dict) -> np.ndarray:
        return c["labels"] != tree["labels"][j]

    def take(self, t: int, j: int, scores, ids, keys) -> None:
        for i, p in enumerate(self.positives(t, j)[:, 2].tolist()):
            some = (self.low * p <= 100 * scores) & (100 * scores <= self.high * p)
            if some.any():
                self.held[t, j, i] = _best(self.held.get((t, j, i)), (scores[some], ids[some], keys[some]), self.k)

    def rows(self) -> Iterator[tuple]:
        for (t, j, i), held in self.held.items():
            own, (pos, pos_key, p) = self.trees[t], self.positives(t, j)[i].tolist()
            for s, n, key in zip(*(x.tolist() for x in held), strict=True):
                yield int(own["ids"][j]), int(own["keys"][j]), pos, pos_key, p, n, key, s


def _numbers(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    return np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims))


def _packed(rows: DataFrame, dims: int, scale: int, kind: str, group: bool) -> DataFrame:
    """Record batches as packed rows: blocks of candidates, or groups of at most GROUP anchors in the order of their tree."""

    def pack(number: int, ids, keys, labels, v, found: list) -> pa.RecordBatch:
        parents, edges = np.zeros(0, "<i4"), np.zeros(0)
        if group:
            order, parents, edges = spanning_tree(v)
            ids, keys, labels, v, found = ids[order], keys[order], labels[order], v[order], [found[i] for i in order]
        own = {
            "ids": ids, "keys": keys, "labels": labels, "vectors": v.astype(kind), "parents": parents.astype("<i4"), "edges": edges,
            "counts": np.array([len(f or ()) for f in found], "<i4"),
            "found": np.array([(p["vec_id"], p["key"], p["score"]) for f in found for p in f or ()], "<i8"),
        }
        out = [pa.array([number], pa.int64()), pa.array([len(ids)], pa.int32()), *(pa.array([own[k].tobytes()], pa.binary()) for k in _PARTS)]
        return pa.RecordBatch.from_arrays(out, ["number", "n", *_PARTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, keys, labels = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            v, step = _numbers(batch.column(3), dims, scale), GROUP if group else max(batch.num_rows, 1)
            found = batch.column(4).to_pylist() if group else [None] * batch.num_rows
            for at in range(0, batch.num_rows, step):
                own = slice(at, at + step)
                yield pack(number, ids[own], keys[own], labels[own], v[own], found[own])
                number += 1

    return rows.mapInArrow(run, _PACKED)


def _unpacked(row: dict, dims: int, kind: str) -> dict:
    out = {k: np.frombuffer(row[k], t or kind) for k, t in _PARTS.items()}
    out["vectors"] = out["vectors"].astype(np.float64).reshape(row["n"], dims)
    return out | {"found": out["found"].reshape(-1, 3), "ends": np.cumsum(out["counts"])}


def _meet(groups: DataFrame, blocks: DataFrame, deal: tuple[int, int], dims: int, kind: str, exact: bool, walk, schema: str) -> DataFrame:
    """Every group of anchors with every block of candidates, and the rows that `walk` (trees -> Walk) finds, one task's best for each of its parts."""
    s, c = deal
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n: F.pmod(F.xxhash64("number"), F.lit(n)).cast("int")
    held = groups.withColumns({"s": part(s), "kind": F.lit(0)}).withColumn("c", all_of(c))
    met = blocks.withColumns({"c": part(c), "kind": F.lit(1)}).withColumn("s", all_of(s))
    names = ["s", "c", "kind", "n", *_PARTS]
    parts = min(s * c, int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = held.select(*names).unionAll(met.select(*names)).repartition(parts, "s", "c").sortWithinPartitions("s", "c", "kind")
    columns = [x.split()[0] for x in schema.split(", ")]

    def told(walked: Walk | None) -> Iterator[pa.RecordBatch]:
        rows = list(walked.rows()) if walked else []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trees, walked = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(a)[i].as_py() for a, k in enumerate(names)}
                if (row["s"], row["c"]) != now:
                    yield from told(walked)
                    now, trees, walked = (row["s"], row["c"]), [], None
                if row["kind"] == 0:
                    trees.append(_unpacked(row, dims, kind))
                else:
                    walked = walked or walk(trees)
                    walked.block(_unpacked(row, dims, kind), exact)
        yield from told(walked)

    return both.mapInArrow(run, schema)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of each key, ranked."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "key"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _mined(rows: DataFrame, n: int, asked: int, largest: float, dims: int, scale: int, positives: int, negatives: int, share: tuple[int, int]) -> DataFrame:
    """Of the rows of one length: anchor, positive, rank, negative and both scores."""
    bound = (scale * largest + 1) ** 2 * dims
    if bound >= 2**63 // 100:
        raise ValueError("a score may be beyond a long")
    kind, exact = "<f4" if scale * largest + 1 < 2**24 else "<f8", bound < EXACT
    anchors = rows.filter("asks")
    draw = F.pmod(F.xxhash64("vec_id", "key", F.lit(11)), F.lit(1 << 32)) / float(1 << 32)
    sample = anchors.filter(draw < 0.9 * SAMPLE_ROWS / asked).select("embedding").limit(SAMPLE_ROWS).toArrow()
    points = _numbers(sample.column(0).combine_chunks(), dims, scale) @ directions(dims) if sample.num_rows else np.zeros((0, DIRECTIONS))
    tree = top_tree(points, max(1, min(-(-asked // GROUP), len(points) // SAMPLE_PER_BLOCK)))

    def near(c):
        return {"place": block_of(_numbers(c["embedding"], dims, scale) @ directions(dims), tree), **{k: c[k] for k in ("vec_id", "key", "label", "embedding")}}

    dealt = cut(map_rows(anchors, near, "place long, vec_id long, key long, label long, embedding array<double>"), "anchors")
    deal = max(1, -(-asked // (GROUP * GROUPS_PER_TASK))), max(1, -(-n // CHUNK_ROWS))
    blocks = _packed(rows.select("vec_id", "key", "label", "embedding"), dims, scale, kind, False)

    def groups(df: DataFrame) -> DataFrame:
        """Groups of neighbours; neighbours follow each other in the order of their places."""
        ordered = df.repartitionByRange("place", "vec_id", "key").sortWithinPartitions("place", "vec_id", "key")
        return cut(_packed(ordered.select("vec_id", "key", "label", "embedding", "found"), dims, scale, kind, True), "groups")

    none = F.expr("cast(null as array<struct<vec_id: long, key: long, score: long>>)")
    found = _meet(groups(dealt.withColumn("found", none)), blocks, deal, dims, kind, exact, lambda trees: Positives(trees, positives), "anchor long, own long, vec_id long, key long, score long")
    best = _first(found, ["anchor", "own"], positives).groupBy("anchor", "own").agg(F.collect_list(F.struct("vec_id", "key", "score")).alias("found"))
    wanted = dealt.join(best, (F.col("vec_id") == F.col("anchor")) & (dealt["key"] == F.col("own"))).drop("anchor", "own")
    schema = "anchor long, own long, positive long, other long, positive_score long, vec_id long, key long, score long"
    found = _meet(groups(wanted), blocks, deal, dims, kind, exact, lambda trees: Negatives(trees, negatives, *share), schema)
    found = _first(found, ["anchor", "own", "positive", "other"], negatives)
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, share: tuple[int, int] = (30, 90), scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, embedding, label).

    A component x counts as floor(scale * x), a score is the integer inner product with the anchor;
    higher scores come first, ties by smaller vec_id. An anchor's positives are its first `positives`
    other rows of the same label; for each, the first `negatives` rows of other labels whose score is between
    `share` hundredths of the positive's are returned (all, if fewer).

    Rows without id, label or vector, or with a null or non-finite component, take no part. Rows that
    agree in id, label and vector are one row; rows that share only an id are rows of their own.
    Vectors of different lengths are mined apart. An empty table gives no rows; extra columns are
    left out. Scores beyond a hundredth of a long are an error.
    """
    good = F.col("embedding").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    rows = rows.filter(good & ~F.coalesce(odd, F.lit(True))).distinct().withColumn("key", F.xxhash64("label", "embedding"))
    rows = cut(rows, "vectors")
    largest = F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x))))
    stats = rows.groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("n"), F.count_if("asks").alias("asked"), largest.alias("largest"))
    found = None
    for r in stats.collect():  # the lengths of vectors
        if r["asked"]:
            own = rows.filter(F.size("embedding") == r["dims"])
            one = _mined(own, r["n"], r["asked"], r["largest"] or 0.0, r["dims"], scale, positives, negatives, share)
            found = one if found is None else found.unionAll(one)
    return vectors.sparkSession.createDataFrame([], RESULT) if found is None else found
