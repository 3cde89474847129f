"""Best-fit packing with exact complements over the length histogram.

As in `packing`, documents become pieces, and only the histogram of piece lengths (at most `width`
counts) reaches the driver. There packs are opened by the longest length left. What one, two or three
lengths add up to is indexed by the sum, so the pieces that fill a pack's gap exactly are found by
one look at that gap; as many packs are closed at once as the counts of these lengths allow. A pack
that no such combination fills takes the longest length that fits and looks again; one that nothing
fits any more stays open as a residual. Whatever is left at the end goes best fit first into residuals.

A pattern is a list of runs (length, times), so a pack of a thousand short pieces is one run. Each run
owns a range of ranks of its length, and pieces find sequence and offset by their rank.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F

from strandflow.llm.common import cut, map_rows
from strandflow.llm.packing import pieces

Runs = tuple[tuple[int, int], ...]


class Sums:
    """Which lengths are left, and which sums one, two and three of them make."""

    def __init__(self, histogram: dict[int, int], width: int):
        self.left = np.zeros(width + 1, np.int64)
        for length, n in histogram.items():
            self.left[length] = n
        #: pairs[s]: number of pairs a < b of lengths that are left with a + b = s
        there = (self.left > 0).astype(np.int64)
        both = np.convolve(there, there)[: width + 1]
        twice = np.zeros(width + 1, np.int64)
        lengths = np.flatnonzero(there)
        twice[2 * lengths[2 * lengths <= width]] = 1
        self.pairs = (both - twice) // 2

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if n and not self.left[length]:
            others = np.flatnonzero(self.left > 0)
            sums = others + length
            self.pairs[sums[sums < len(self.pairs)]] -= 1

    def pair(self, gap: int) -> tuple[int, int] | None:
        """Two lengths that make `gap`, the longer one as long as possible."""
        if gap < 2:
            return None
        half = gap // 2
        if gap == 2 * half and not self.pairs[gap]:
            return (half, half) if self.left[half] > 1 else None
        if not self.pairs[gap]:
            return None
        longer = np.arange(gap - 1, half, -1)
        fits = longer[(self.left[longer] > 0) & (self.left[gap - longer] > 0)]
        return int(fits[0]), gap - int(fits[0])

    def triple(self, gap: int) -> tuple[int, int, int] | None:
        """Three lengths that make `gap`, the longest one as long as possible."""
        first = np.arange(max(gap - 2, 0), (gap + 2) // 3 - 1, -1)
        first = first[self.left[first] > 0]
        rest = gap - first
        even = (rest % 2 == 0) & (self.left[rest // 2] > 1)
        for a in first[(self.pairs[rest] > 0) | even].tolist():
            self.left[a] -= 1  # it may be needed twice
            found = self.pair_of(gap - a)
            self.left[a] += 1
            if found:
                return a, *found
        return None

    def pair_of(self, gap: int) -> tuple[int, int] | None:
        """As `pair`, by the counts alone."""
        longer = np.arange(gap - 1, (gap + 1) // 2 - 1, -1)
        fits = longer[(self.left[longer] > 0) & (self.left[gap - longer] > (2 * longer == gap))]
        return (int(fits[0]), gap - int(fits[0])) if len(fits) else None

    def filling(self, gap: int) -> tuple[int, ...] | None:
        """At most three lengths that fill `gap` exactly."""
        if self.left[gap]:
            return (gap,)
        return self.pair(gap) or self.triple(gap)

    def longest(self, room: int) -> int:
        """The longest length left that fits, or 0."""
        at = np.flatnonzero(self.left[: room + 1])
        return int(at[-1]) if len(at) else 0


def plan(histogram: dict[int, int], width: int) -> list[tuple[Runs, int]]:
    """Packing patterns as runs, and how often each is used."""
    sums = Sums(histogram, width)
    done: list[tuple[Runs, int]] = []
    while longest := sums.longest(width):
        many = -(-int(sums.left[longest]) // (width // longest))  # the fewest packs that could hold them all
        sums.take(longest, many)
        todo = [(((longest, 1),), many, width - longest)]
        while todo:
            runs, packs, gap = todo.pop()
            length = sums.longest(gap)
            if not length:  # full, or nothing fits
                done.append((runs, packs))
                continue
            fill = sums.filling(gap) or (length,)
            need = {length: fill.count(length) for length in fill}
            used = min(packs, *(int(sums.left[length]) // n for length, n in need.items()))
            for length, n in need.items():
                sums.take(length, n * used)
            if packs > used:
                todo.append((runs, packs - used, gap))
            todo.append((_with(runs, need), used, gap - sum(fill)))
    return done


def _with(runs: Runs, more: dict[int, int]) -> Runs:
    """The runs with `more` pieces; one run for each length."""
    out = dict(runs)
    for length, n in more.items():
        out[length] = out.get(length, 0) + n
    return tuple(sorted(out.items(), reverse=True))


def slots(patterns: list[tuple[Runs, int]]) -> dict[str, np.ndarray]:
    """One row for each run of each pattern, ordered by (length, first rank): its ranks, first sequence, offset and times."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for runs, packs in patterns:
        offset = 0
        for length, times in runs:
            first = taken.get(length, 0)
            rows.append((length, first, sequence, offset, times))
            taken[length] = first + packs * times
            offset += length * times
        sequence += packs
    rows.sort()
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("length", "first", "sequence", "offset", "times"))}


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, width: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): pieces of `docs` in few sequences of at most `width` ids.

    A document is its ids and `end_id`; only longer ones are cut, every `width` ids. A null or empty
    text is `end_id` alone; rows that repeat a doc_id, or have none, are packed as rows of their own; an
    empty table gives no rows; extra columns are left out.

    Shuffles: the pieces' few short columns once, to meet their batch's counts. The table of runs
    that is sent to tasks is bounded by `width`: a pattern's lengths differ, so it has at most
    sqrt(2 * width) runs, and each pattern ends with a length used up or a kind of pack done.
    """
    cut_up = cut(pieces(docs, vocabulary, end_id, width), "pieces")
    counts = cut_up.groupBy("batch", "length").count()
    found = counts.groupBy("length").agg(F.sum("count").alias("count")).collect()  # at most `width` rows
    table = slots(plan({r["length"]: r["count"] for r in found}, width))
    before = F.sum("count").over(W.partitionBy("length").orderBy("batch")) - F.col("count")
    ranked = cut_up.join(counts.select("batch", "length", before.alias("first")), ["batch", "length"])
    sent = docs.sparkSession.sparkContext.broadcast({"key": table["length"] * (1 << 44) + table["first"], **table})
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def rows(c):
        t = sent.value
        length, rank = (c[k].to_numpy(zero_copy_only=False).astype(np.int64) for k in ("length", "rank"))
        at = np.searchsorted(t["key"], length * (1 << 44) + rank, "right") - 1
        packs, number = np.divmod(rank - t["first"][at], t["times"][at])
        return {k: c[k] for k in names} | {"sequence_id": t["sequence"][at] + packs, "offset": t["offset"][at] + number * length}

    piece = F.expr(f"start div {width}").alias("piece")
    ranked = ranked.select("doc_id", piece, "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank"))
    kinds = {"piece": "int"}
    return map_rows(ranked, rows, ", ".join(f"{k} {kinds.get(k, 'long')}" for k in [*names, "sequence_id", "offset"]))
