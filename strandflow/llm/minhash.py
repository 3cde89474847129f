"""Near duplicates by HyperMinHash.

Each distinct shingle falls into one of 128 buckets; a bucket keeps its smallest hash as a
floating-point register: the number of leading zeros and the next 10 bits. Empty buckets take the
value of another bucket, found in an order fixed per bucket. Bands of 4 registers propose
candidates, the share of equal registers - corrected for chance collisions - drops hopeless
ones of larger sets, and every link is confirmed on the full shingle sets.

Copies collapse first. A node is compared with the smallest of its buckets' smallest members, then
with the other ones that still lie in another component. For buckets whose members are in several
components even then, all pairs across components are compared, in blocks. So a group of near
copies costs about one comparison per member, and no candidate pair that could change the result
is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strandflow.llm.common import cut, map_rows, shingles, texts_of, word_hashes
from strandflow.llm.components import components

BUCKETS, MANTISSA = 128, 10
#: Registers of a band. A pair at similarity 0.8 shares no band with probability (1 - 0.8^4)^32 < 1e-7.
BAND = 4
#: A pair of larger sets goes on to the full comparison if its estimate is at most this much below the threshold (7 standard deviations).
SLACK = 0.25
#: Pairs with a smaller set than this always do: their empty buckets borrow registers, so that the estimate strays further.
SMALL = 2 * BUCKETS
#: Members of one block when pairs across components are compared.
BLOCK = 128
#: Chance of two unrelated registers to agree, times 2^MANTISSA (the HyperMinHash paper's constant).
CHANCE = 0.169919487159739
_ORDER = np.argsort(np.random.RandomState(20).rand(BUCKETS, BUCKETS), axis=1)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of k lower-cased words; all words as one run if there are fewer than k."""
    hashes = word_hashes(text.encode().lower().split()) if text else np.zeros(0, np.uint64)
    if 0 < len(hashes) < k:
        return shingles(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(shingles(hashes, k))


def registers(found: np.ndarray) -> np.ndarray:
    """Compressed registers (leading zeros, then mantissa) of a non-empty set."""
    bucket = (found & np.uint64(BUCKETS - 1)).astype(np.int64)
    low = np.full(BUCKETS, np.uint64(2**64 - 1))
    np.minimum.at(low, bucket, found >> np.uint64(7))
    full = low != np.uint64(2**64 - 1)
    size = np.frexp(np.maximum(low, 1).astype(np.float64))[1]  # bits of the value
    shift = size - 1 - MANTISSA
    rest = np.where(shift >= 0, low >> np.maximum(shift, 0).astype(np.uint64), low << np.maximum(-shift, 0).astype(np.uint64))
    value = ((57 - size) << MANTISSA | (rest & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)).astype(np.uint16)
    if not full.all():
        value = np.where(full, value, value[_ORDER[np.arange(BUCKETS), full[_ORDER].argmax(1)]])
    return value


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers, less the expected chance agreements of sets of n and m."""
    ratio = np.minimum(n, m) / np.maximum(np.maximum(n, m), 1)
    chance = CHANCE * 4 * ratio / (1 + ratio) ** 2 / (1 << MANTISSA)
    return (equal - chance) / (1 - chance)


def hopeful(equal: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """Which pairs the full comparison must decide: all but those of larger sets whose estimate is far below `least`."""
    return (np.minimum(n, m) < SMALL) | (estimate(equal, n, m) >= least - SLACK)


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, print, registers): the set's size, its 128-bit fingerprint and its registers; both null if it is empty."""

    def rows(c):
        n, prints, regs = [], [], []
        for text in c["text"].to_pylist():
            s = shingle_set(text, k)
            n.append(len(s))
            prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            regs.append(registers(s).tobytes() if len(s) else None)
        return {"doc_id": c["doc_id"], "n_shingles": n, "print": prints, "registers": regs}

    return map_rows(texts_of(docs), rows, "doc_id long, n_shingles long, print binary, registers binary")


def bands(nodes: DataFrame) -> DataFrame:
    """(node, place, band): one row per node and band, keyed by a hash of the band's registers."""
    keys = f"transform(sequence(0, {BUCKETS // BAND - 1}), b -> xxhash64(b, substring(registers, b * {2 * BAND} + 1, {2 * BAND})))"
    return nodes.select("node", F.posexplode(F.expr(keys)).alias("place", "band"))


def _plausible(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose estimated similarity is not clearly below `least`."""
    for side in ("a", "b"):
        pairs = pairs.join(
            nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"r_{side}")),
            side,
        )

    def rows(c):
        a, b = (np.frombuffer(b"".join(c[k].to_pylist()), np.uint16).reshape(-1, BUCKETS) for k in ("r_a", "r_b"))
        n, m = (c[k].to_numpy(zero_copy_only=False) for k in ("n_a", "n_b"))
        good = pa.array(hopeful((a == b).mean(1), n, m, least))
        return {"a": c["a"].filter(good), "b": c["b"].filter(good)}

    return map_rows(pairs, rows, "a long, b long")


def _confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    texts = texts_of(docs)
    both = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")

    def rows(c):
        good, last, mine = [], None, None
        for a, text_a, text_b in zip(c["a"].to_pylist(), c["text_a"].to_pylist(), c["text_b"].to_pylist(), strict=True):
            if a != last:
                last, mine = a, shingle_set(text_a, k)
            other = shingle_set(text_b, k)
            shared = len(np.intersect1d(mine, other, assume_unique=True))
            good.append(100 * shared >= percent * (len(mine) + len(other) - shared))
        keep = pa.array(good, pa.bool_())
        return {"a": c["a"].filter(keep), "b": c["b"].filter(keep)}

    return map_rows(both.select("a", "b", "text_a", "text_b"), rows, "a long, b long").distinct()


def _across(banded: DataFrame, nodes: DataFrame, found: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Linked pairs of nodes that share a band but lie in different components.

    Plausible pairs are confirmed where they meet, in the first band they share, so that a group
    of many texts just below the threshold yields no rows. Members meet by their registers first.
    """
    least = percent / 100
    placed = banded.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("band", "component").agg(F.count("*").alias("own"))
    mixed = sizes.groupBy("band").agg(
        F.sum("own").alias("members"),
        F.count("*").alias("parts"),
        F.max_by("component", F.struct("own", "component")).alias("most"),
    ).filter("parts > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows_in = placed.join(mixed.select("band", "most", blocks.alias("blocks")), "band").join(nodes.select("node", "n", "registers"), "node")
    # the largest component's members stay in their own block; only the others visit every block
    home, roams = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.col("component") != F.col("most")
    visits = F.explode(F.when(roams, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(home))).alias("block")
    dealt = rows_in.withColumns({"home": home, "roams": roams}).select("band", visits, "home", *_MEMBER[1:])
    dealt = dealt.select("band", "block", (F.col("home") == F.col("block")).alias("resident"), *_MEMBER[1:])

    # registers alone tell which members of which blocks have a plausible partner there; only those bring their text
    def involved(group: list[tuple]) -> Iterator[tuple]:
        for i in sorted({i for pair in _pairs(group, least) for i in pair}):
            yield group[i]

    def confirmed(group: list[tuple]) -> Iterator[tuple]:
        sets: dict[int, np.ndarray] = {}
        for pair in _pairs(group, least):
            for i in pair:
                if i not in sets:
                    sets[i] = shingle_set(group[i][-1], k)
            x, y = (sets[i] for i in pair)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * shared >= percent * (len(x) + len(y) - shared):
                a, b = (int(group[i][4]) for i in pair)
                yield min(a, b), max(a, b)

    kinds = "band long, block int, resident boolean, roams boolean, node long, component long, n long, registers binary, place int"
    some = cut(_per_block(dealt, involved, kinds), "involved")
    texts = texts_of(docs).select(F.col("doc_id").alias("node"), "text")
    met = some.join(texts, "node").select(*some.columns, "text")
    return _per_block(met, confirmed, "a long, b long").distinct()


_MEMBER = ("resident", "roams", "node", "component", "n", "registers", "place")


def _pairs(group: list[tuple], least: float) -> Iterator[tuple[int, int]]:
    """Positions of the plausible pairs across components in a band's block, each in the first band the two share."""
    resident, roams, node, comp, n = (np.array([g[x] for g in group]) for x in (2, 3, 4, 5, 6))
    regs = np.frombuffer(b"".join(g[7] for g in group), np.uint16).reshape(-1, BUCKETS)
    place = group[0][8]
    for x in np.flatnonzero(roams).tolist():
        rest = np.flatnonzero(resident & (comp != comp[x]) & (~roams | (node > node[x])))
        if len(rest):
            same = regs[rest] == regs[x]
            here = same.reshape(len(rest), -1, BAND).all(2).argmax(1) == place
            for y in rest[here & hopeful(same.mean(1), n[rest], n[x], least)].tolist():
                yield x, y


def _per_block(dealt: DataFrame, work: Callable[[list[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """Bring the members of each band's block together and call `work` once for each."""
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple] = []

        def told() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
            out.clear()
            return made

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True):
                if group and row[:2] != group[0][:2]:
                    out += work(group) if len(group) > 1 else ()
                    group = []
                    if len(out) >= 1000:
                        yield told()
                group.append(row)
        out += work(group) if len(group) > 1 else ()
        if out:
            yield told()

    return dealt.repartition("band", "block").sortWithinPartitions("band", "block", "node").mapInArrow(run, schema)


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose nodes lie in different components."""
    for side in ("a", "b"):
        pairs = pairs.join(found.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}")), side, "left")
    return pairs.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of `docs`.

    Linked are texts whose sets of k-word shingles (A-Z lower-cased) have a Jaccard similarity of
    at least `percent` / 100. A text with fewer than k words is one shingle of all its words; a null
    or empty text has an empty set and is linked with nothing. component_id is the smallest doc_id
    reachable over links; kept marks the row that bears it. A doc_id is taken to name one text;
    rows that repeat it get the same result. A row without a doc_id is linked with nothing: its
    component_id is null and it is kept. An empty table gives no rows; extra columns are not read.
    """
    least = percent / 100
    sketches = cut(sketch(docs, k), "sketches")
    nodes = sketches.filter("n_shingles > 0 and doc_id is not null").groupBy("print").agg(
        F.min("doc_id").alias("node"),
        F.first("n_shingles").alias("n"),
        F.first("registers").alias("registers"),
    )
    nodes = cut(nodes, "nodes")
    banded = bands(nodes)
    shared = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    banded = cut(banded.join(shared.select("band", "hub"), "band"), "bands")
    stars = banded.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    # first each node with the smallest hub of its buckets; then with the other hubs, where that left them apart
    first = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = cut(_confirmed(_plausible(first, nodes, least), docs, k, percent), "confirmed")
    found = cut(components(links), "components")
    more = cut(_plausible(_apart(stars.join(first, ["a", "b"], "left_anti"), found), nodes, least), "more")
    if not more.isEmpty():
        links = cut(links.unionAll(_confirmed(more, docs, k, percent)), "confirmed")
        found = cut(components(links), "components")
    more = cut(_across(banded.select("band", "place", "node"), nodes, found, docs, k, percent), "across")
    if not more.isEmpty():
        found = cut(components(links.unionAll(more)), "components")
    of_print = nodes.select("print", "node").join(found, "node", "left").select(
        "print",
        F.coalesce("component", "node").alias("component_id"),
    )
    out = sketches.select("doc_id", "n_shingles", "print").join(of_print, "print", "left")
    out = out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
