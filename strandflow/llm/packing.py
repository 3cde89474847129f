"""Shortest-pack-first packing over the length histogram.

Documents are tokenized once and cut into pieces of at most `width` ids. Only the histogram of
piece lengths (at most `width` rows, whatever the input) reaches the driver. There lengths are
placed longest first, each into the emptiest packing pattern that has room, and only counts of
patterns are kept. Each (pattern, slot) then owns a range of ranks of its length, and pieces
find their sequence and offset by their rank among the pieces of that length.

Ranks need no sort: the task that cuts a batch of documents numbers its pieces length by length, and
a running sum over the batches' counts turns these numbers into ranks of the whole table.
"""

from __future__ import annotations

import heapq
import json
import os
import string
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import add

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from strandflow.llm.common import CACHE_ENTRIES, cut, map_rows, texts_of

#: Characters of text whose new words are encoded together.
ENCODE_CHARS = 2 << 20
#: Longest piece between blanks that is remembered.
REMEMBERED = 64
#: Marks that may follow a word and are then one pre-token; an apostrophe may begin another kind.
MARKS = string.punctuation.replace("'", "")


class Units(dict):
    """Piece between blanks -> little-endian ids.

    The vocabulary drops white space and marks word ends, so the new words of many texts go through
    the tokenizers library as one text and are told apart by the word ends. These are words of
    Latin letters, alone or before punctuation marks; every other piece, whose letters may need
    normalization, is encoded by itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # lower-case Latin words between blanks need no normalizer, and no pattern to be told apart
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix = model["end_of_word_suffix"]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
        self.stems: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def alone(self, units: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(units, add_special_tokens=False)]

    def learn(self, new: set[str]) -> None:
        """Add the units of `new`."""
        units, stems, tails, other = [], [], [], []
        for unit in new:
            low = unit.lower()
            stem = low.rstrip(MARKS)
            if stem.isalpha() and (stem.isascii() or max(stem) <= "\xff"):
                units.append(unit)
                stems.append(stem)
                tails.append(low[len(stem) :])
            else:
                other.append(unit)
        fresh = list(set(tails).difference(self.marks))
        self.marks.update(zip(fresh, self.alone(fresh), strict=True))
        fresh = list(set(stems).difference(self.stems))
        if fresh:
            if len(self.stems) > CACHE_ENTRIES:
                self.stems = {s: self.stems[s] for s in set(stems).difference(fresh)}
            ids = np.array(self.words.encode(" ".join(fresh), add_special_tokens=False).ids, "<u4")
            cuts = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(cuts) != len(fresh):
                raise ValueError("a word of letters is more than one pre-token")
            raw, at = ids.tobytes(), 0
            for stem, end in zip(fresh, cuts.tolist(), strict=True):
                self.stems[stem] = raw[at:end]
                at = end
        self.update(zip(units, map(add, map(self.stems.__getitem__, stems), map(self.marks.__getitem__, tails)), strict=True))
        self.update(zip(other, self.alone(other), strict=True))

    def encode(self, texts: list[list[str]]) -> Iterator[bytes]:
        """Ids of each text, given as its units."""
        wanted = set().union(*texts)
        if len(self) > CACHE_ENTRIES:
            self.clear()
            self.marks = {"": b""}
        self.learn(wanted.difference(self))
        for units in texts:
            yield b"".join(map(self.__getitem__, units))
        for unit in wanted:
            if len(unit) > REMEMBERED:
                self.pop(unit)
                self.stems.pop(unit.lower().rstrip(MARKS), None)


@lru_cache(maxsize=2)
def _units(path: str) -> Units:
    return Units(path)


def encode_texts(texts: list[str | None], path: str) -> Iterator[bytes]:
    """Little-endian ids of each text; no token reaches over a blank or a line feed. A null text has none."""
    block, size = [], 0
    for text in texts:
        block.append((text or "").replace("\n", " ").split(" "))
        size += len(text or "")
        if size >= ENCODE_CHARS:
            yield from _units(path).encode(block)
            block, size = [], 0
    if block:
        yield from _units(path).encode(block)


def pieces(docs: DataFrame, vocabulary: str, end_id: int, width: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, batch, place): each document's ids and `end_id`, cut every `width` ids.

    `batch` names the record batch a piece was cut in, `place` counts the batch's pieces of one
    length. A null or empty text is `end_id` alone. Rows that repeat a doc_id are packed as rows
    of their own.
    """
    end = array("I", [end_id]).tobytes()
    done: dict[int, int] = {}

    def rows(c):
        task = TaskContext.get()
        number = done[task.taskAttemptId()] = done.get(task.taskAttemptId(), -1) + 1
        out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "place")}
        seen = [0] * (width + 1)
        for doc, ids in zip(c["doc_id"].to_pylist(), encode_texts(c["text"].to_pylist(), vocabulary), strict=True):
            ids += end
            n = len(ids) // 4
            for start in range(0, n, width):
                piece = ids[4 * start : 4 * (start + width)]
                length = len(piece) // 4
                for k, v in zip(out, (doc, start, length, zlib.crc32(piece), n, seen[length]), strict=True):
                    out[k].append(v)
                seen[length] += 1
        return out | {"batch": [task.partitionId() << 32 | number] * len(out["doc_id"])}

    return map_rows(texts_of(docs), rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, batch long, place long")


def plan(histogram: dict[int, int], width: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns and their counts: longest lengths first, each into the shortest pack so far."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    heap: list[int] = []  # minus the rooms in use

    def add(pattern: tuple[int, ...], count: int, left: int) -> None:
        if left not in room:
            room[left] = []
            heapq.heappush(heap, -left)
        room[left].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left_over = histogram[length]
        placed = []
        while left_over and heap and -heap[0] >= length:
            most = -heap[0]
            pattern, count = room[most].pop()
            if not room[most]:
                del room[most]
                heapq.heappop(heap)
            used = min(count, left_over)
            if count > used:
                add(pattern, count - used, most)
            left_over -= used
            # a pack that takes this length may take it again, as long as it is the emptiest
            add(pattern + (length,), used, most - length) if most - length >= length else placed.append(
                (pattern + (length,), used, most - length)
            )
        for p in placed:
            add(*p)
        if left_over:
            per = width // length  # packs of nothing but this length
            if left_over // per:
                add((length,) * per, left_over // per, width - per * length)
            if left_over % per:
                add((length,) * (left_over % per), 1, width - (left_over % per) * length)
    return [(p, n) for left in sorted(room) for p, n in room[left]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """One row for each slot of each pattern, ordered by (length, first rank): its ranks, first sequence and offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            first = taken.get(length, 0)
            rows.append((length, first, sequence, offset))
            taken[length] = first + count
            offset += length
        sequence += count
    rows.sort()
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("length", "first", "sequence", "offset"))}


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, width: int = 2048) -> DataFrame:
    """Pieces of `docs` with their sequence_id and gapless offset there. Empty input gives no rows.

    Rows without a doc_id are packed like others; extra columns are left out. Shuffles: the pieces'
    few short columns once, to meet their batch's counts. The slot table that is sent to tasks
    has a row for each slot of each pattern; patterns are made per length, so it is bounded by
    `width`, not by the documents.
    """
    spark = docs.sparkSession
    cut_up = cut(pieces(docs, vocabulary, end_id, width), "pieces")
    counts = cut_up.groupBy("batch", "length").count()
    found = counts.groupBy("length").agg(F.sum("count").alias("count")).collect()
    table = slots(plan({r["length"]: r["count"] for r in found}, width))
    # one row for each length of each batch: the pieces of that length in the batches before
    before = F.sum("count").over(W.partitionBy("length").orderBy("batch")) - F.col("count")
    ranked = cut_up.join(counts.select("batch", "length", before.alias("first")), ["batch", "length"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("place"))
    sent = spark.sparkContext.broadcast({"key": table["length"] * (1 << 44) + table["first"], **table})
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def rows(c):
        t = sent.value
        length, rank = (np.asarray(c[k].to_numpy(zero_copy_only=False), np.int64) for k in ("length", "rank"))
        at = np.searchsorted(t["key"], length * (1 << 44) + rank, "right") - 1
        return {k: c[k] for k in names} | {"sequence_id": t["sequence"][at] + rank - t["first"][at], "offset": t["offset"][at]}

    return map_rows(ranked.select(*names, "rank"), rows, ", ".join(f"{k} long" for k in [*names, "sequence_id", "offset"]))
