"""Merkle trees over a dataset: a leaf digest per row, a tree per group, one root, and each row's proof.

Rows are numbered within their group by a range-partitioned sort; only the few counts of the sorted
partitions are added up, so no task sees a whole group. A tree is climbed by slot pivots: one
conditional aggregate for each slot of a tile brings the tile's nodes side by side as columns. Their
concatenation in runs of `fanout` gives the parents' digests, and what is left of a run without its
own slot are a node's siblings. A tile spans several levels, so a tree of n leaves takes
log(n) / log(SLOTS) exchanges up and as many down, and a path is stored once for each tile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strandflow.llm.common import cut

#: Slots of a pivot, at most (unless the fanout is larger).
SLOTS = 32
#: What a document's leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of strings laid end to end."""
    return F.sha2(F.concat(*parts), 256)


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field is its number of bytes, a colon and its value, or a dash where it is null."""
    texts = [c.cast("string") for c in fields]
    return digest(*(F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in texts))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path (`proofs`) lead to."""
    return F.aggregate(path, start, lambda own, x: digest(x["left"], own, x["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def _ordered(df: DataFrame, keys: list[str]) -> DataFrame:
    """`df` sorted by `keys` over all partitions and written so; part and at tell each row's partition and a number that grows in it."""
    at = F.monotonically_increasing_id()
    df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return cut(df.withColumns({"at": at, "part": F.shiftright(at, 33)}), "ordered")


def _shifts(ordered: DataFrame, *group: str) -> DataFrame:
    """(part, group, shift, total) for each group that a sorted partition holds: at + shift is a row's place in its group."""
    own = ordered.groupBy("part", *group).agg(F.min("at").alias("low"), F.count("*").alias("n"))
    w = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = F.sum("n").over(w.orderBy("part")) - F.col("n")
    return own.select("part", *group, (before - F.col("low")).alias("shift"), F.sum("n").over(w).alias("total"))


class Tree:
    """Tiles of the trees of nodes (g, place, total, node): `g` numbers the tree, `node` is a struct whose field `hash` is the digest."""

    def __init__(self, nodes: DataFrame, most: int, fanout: int):
        self.fanout, self.height = fanout, 1
        while fanout ** (self.height + 1) <= SLOTS:
            self.height += 1
        self.size = fanout**self.height
        self.rounds: list[DataFrame] = []
        while True:
            slot, tile = F.col("place") % self.size, F.floor(F.col("place") / self.size).cast("long")
            columns = [F.max(F.when(slot == i, F.col("node"))).alias(f"slot_{i}") for i in range(self.size)]
            tiles = nodes.groupBy("g", tile.alias("tile")).agg(*columns, F.first("total").alias("total"))
            base = self.height * len(self.rounds)
            tiles = tiles.select("g", "tile", "total", F.array(*(f"slot_{i}" for i in range(self.size))).alias("slots"))
            self.rounds.append(cut(tiles, "tiles"))
            tops = self._levels(self.rounds[-1], base).select("g", F.col("tile").alias("place"), "total", F.col(f"level_{self.height}")[0].alias("hash"))
            if self.size ** len(self.rounds) >= most:
                self.tops = tops.select("g", "hash", "total")
                return
            nodes = tops.select("g", "place", "total", F.struct("hash").alias("node"))

    def _levels(self, tiles: DataFrame, base: int) -> DataFrame:
        """Adds level_0 (the slots' digests) to level_<height> (the tile's one); absent nodes are null, and a tree's only node stays as it is."""
        df = tiles.withColumn("level_0", F.transform("slots", lambda x: x["hash"]))
        for j in range(self.height):
            runs = F.sequence(F.lit(0), F.lit(self.fanout ** (self.height - j - 1) - 1))
            df = df.withColumn(f"level_{j + 1}", F.transform(runs, self._parent(F.col(f"level_{j}"), base + j)))
        return df

    def _parent(self, below: Column, level: int):
        """From a run's number to its parent's digest; `below` holds the nodes of a level, `level` numbers it from the leaves."""

        def of(run: Column) -> Column:
            own = F.slice(below, run * self.fanout + 1, self.fanout)
            several = F.col("total") > self.fanout**level
            return F.when(own[0].isNotNull(), F.when(several, F.sha2(F.array_join(own, ""), 256)).otherwise(own[0]))

        return of

    def paths(self, above: DataFrame) -> DataFrame:
        """(g, place, node, path and the other columns of `above`) of every node; `above` has, for each g, the path from its tree's top on."""
        more = [c for c in above.columns if c not in ("g", "path")]
        above = above.withColumn("tile", F.lit(0).cast("long"))
        for base, tiles in reversed([(self.height * k, t) for k, t in enumerate(self.rounds)]):
            rows = self._levels(tiles, base).join(above, ["g", "tile"])
            rows = rows.select("*", F.posexplode("slots").alias("i", "node")).filter("node is not null")
            steps = []
            for j in range(self.height):
                number = F.floor(F.col("i") / self.fanout**j).cast("int")
                run, own = F.floor(number / self.fanout).cast("int"), number % self.fanout
                children = F.slice(f"level_{j}", run * self.fanout + 1, self.fanout)
                left, right = F.slice(children, F.lit(1), own), F.slice(children, own + 2, F.lit(self.fanout))
                pair = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
                steps.append(F.when(F.col("total") > self.fanout ** (base + j), pair))
            path = F.concat(F.array_compact(F.array(*steps)), "path")
            place = (F.col("tile") * self.size + F.col("i")).alias("place")
            above = rows.select("g", place, "node", path.alias("path"), *more)
            found, above = above, above.drop("node").withColumnRenamed("place", "tile")
        return found


def proofs(rows: DataFrame, group: str, order: list[str], fanout: int = 2, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each row of `rows` (its digest in column `leaf`) with subroot, root and path: array of (left, right), from the leaf up.

    The leaves of a group ascend by `order`, then by their digests; while a level has several
    nodes, every `fanout` consecutive ones (the last run may be shorter, even one) become the digest
    of their concatenation. The groups' last nodes, in the order of `group` (null first), make
    the tree of the root in the same way. left and right are the digests of the siblings before
    and after the own node of a run, laid end to end.

    `order` and `carry` name the columns that stay beside leaf and group. Nulls come first; a null group is
    a group. Rows that repeat are leaves of their own. An empty table gives no rows. Very long texts
    are read once, for their digest; other columns are left out, so their names never clash.
    """
    kept = [*dict.fromkeys([*order, *carry])]
    columns = [F.col(group).alias("grp"), "leaf", *(F.col(c).alias(f"own_{i}") for i, c in enumerate(kept))]
    keys = ["grp", *(f"own_{kept.index(c)}" for c in order), "leaf"]
    ordered = _ordered(cut(rows.select(*columns), "leaves"), keys)
    shifts = cut(_shifts(ordered, "grp"), "shifts")
    groups = _ordered(shifts.select("grp", "total").distinct(), ["grp"])
    numbers = _shifts(groups).withColumnsRenamed({"shift": "first", "total": "_groups"})
    of_groups = groups.join(numbers, "part").select(F.col("grp").alias("named"), "total", (F.col("at") + F.col("first")).alias("g"))
    placed = shifts.drop("total").join(of_groups, F.col("grp").eqNullSafe(F.col("named")))
    placed = placed.select(F.col("part").alias("in_part"), "named", "shift", "total", "g")
    nodes = ordered.join(placed, (F.col("part") == F.col("in_part")) & F.col("grp").eqNullSafe(F.col("named")))
    node = F.struct(F.col("leaf").alias("hash"), *(f"own_{i}" for i in range(len(kept))))
    most, n_groups = groups.agg(F.max("total"), F.count("*")).first()
    tree = Tree(nodes.select("g", (F.col("at") + F.col("shift")).alias("place"), "total", node.alias("node")), most or 1, fanout)
    subroots = tree.tops.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("place"), F.lit(n_groups).alias("total"), F.struct("hash").alias("node"))
    whole = Tree(subroots, max(n_groups, 1), fanout)
    none = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    above = whole.paths(whole.tops.select("g", none.alias("path"), F.col("hash").alias("root")))
    above = above.select(F.col("place").alias("g"), "path", F.col("node.hash").alias("subroot"), "root")
    found = tree.paths(above)
    return found.select(*(F.col(f"node.own_{i}").alias(c) for i, c in enumerate(kept)), F.col("node.hash").alias("leaf"), "subroot", "root", "path")


def manifest(docs: DataFrame, altered: Column, fanout: int = 2) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root, verified) per document, trees by lang.

    `altered` is the leaf as it is found now (null: unchanged); folded_root is the root that it and the
    original siblings lead to. Rows and edge cases as in `proofs`; leaves ascend by doc_id.
    """
    docs = docs.select(*FIELDS, leaf(*(F.col(c) for c in FIELDS)).alias("leaf"), altered.alias("altered"))
    found = proofs(docs, "lang", ["doc_id"], fanout, carry=("altered",))
    found = found.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", "path", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
