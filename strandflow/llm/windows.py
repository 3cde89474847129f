"""What the two repeat finders share.

A window of a text repeats only if the core around its anchor does. So each text is cut into runs of
windows with one core, and the cores' keys are counted in buckets (`shared_runs`); only runs
with a shared key go on. Records go to buckets as packed binary columns, one row for each bucket and
block of documents, so a shuffle moves few large rows and the bucket's task works on whole arrays.

A row is named by its doc_id and a hash of its text, so no copy of the texts with row numbers is
needed. Rows that agree in both carry the same name; only one of them goes on (`one_of_each`), and what is
found for it holds for all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strandflow.llm.common import BASE, cut, mix

#: Bytes a bucket's task should hold at once.
BUCKET_BYTES = 12 << 20
NO_ID = -(2**63)
#: Columns that name a row: its doc_id (NO_ID where it is null) and a hash of its text.
DOC, ROW = "__doc", "__row"
#: A key at more places than this, or than its share of the corpus, is hot: its windows are told apart one by one.
HOT_PLACES = 4096
#: At most about this many keys can be hot, so their list may be sent to all tasks.
HOT_KEYS = 1 << 17
SPAN = "doc long, row long, start long, count long, key long, place long"
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    return np.cumprod(np.full(n, BASE)), np.cumprod(np.full(n, _INVERSE))


def prefix_prints(x: np.ndarray) -> np.ndarray:
    """Prefix sums of x[i] * BASE^(i+1) modulo 2^64."""
    power = _powers(max(16, int(len(x)).bit_length()))[0]
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * power[: len(x)], out=out[1:])
    return out


def run_prints(prefix: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Prints of the runs of `width` entries that begin at `start`."""
    inverse = _powers(max(16, int(len(prefix)).bit_length()))[1]
    return mix((prefix[start + width] - prefix[start]) * inverse[start])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive entries."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def range_min(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of x[low:high] for short non-empty ranges (a sparse table)."""
    size = high - low
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(low), x.dtype)
    table, step = x, 1
    for k in range(int(level.max(initial=0)) + 1):
        at = level == k
        out[at] = np.minimum(table[low[at]], table[high[at] - step])
        table = np.minimum(table[:-step], table[step:]) if len(table) > step else table
        step *= 2
    return out


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] of them), start[1], ..."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


def named(docs: DataFrame) -> DataFrame:
    """`docs` with the two columns that name each row."""
    return docs.withColumns({DOC: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), ROW: F.xxhash64(F.col("text").cast("string"))})


def one_of_each(texts: DataFrame) -> tuple[DataFrame, DataFrame | None, int]:
    """One row for each name of `texts`, (doc, row, bytes) of the names that several rows share (None: there are none), and the bytes of all names.

    Names are counted without their texts; only texts of shared names are moved, one for each name and task.
    """
    counted = texts.groupBy(DOC, ROW).agg(F.count("*").alias("many"), F.max(F.octet_length("text")).cast("long").alias("bytes"))
    size, shared = counted.agg(F.sum("bytes"), F.count_if(F.col("many") > 1)).first()
    texts = texts.select(DOC, ROW, "text")
    if not shared:
        return texts, None, size or 0
    again = cut(counted.filter("many > 1").select(F.col(DOC).alias("doc"), F.col(ROW).alias("row"), "bytes"), "again")
    same = (texts[DOC] == again["doc"]) & (texts[ROW] == again["row"])
    first = texts.join(again, same, "left_semi").groupBy(DOC, ROW).agg(F.first("text").alias("text"))
    return texts.join(again, same, "left_anti").unionAll(first), again, size or 0


def buckets_for(docs: DataFrame, size: float) -> int:
    """Number of buckets so that each holds about BUCKET_BYTES of `size` bytes."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size / BUCKET_BYTES) + 1)


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """(docs, rows, texts) in blocks of about `size` characters, in the order of the rows."""
    for batch in batches:
        docs, rows = (batch.column(k).to_numpy(zero_copy_only=False) for k in (DOC, ROW))
        texts, begin, n = [], 0, 0
        for i, t in enumerate(batch.column("text")):
            texts.append(t.as_py() or "")
            n += len(texts[-1])
            if n >= size or i + 1 == batch.num_rows:
                yield docs[begin : i + 1], rows[begin : i + 1], texts
                texts, begin, n = [], i + 1, 0


def packed(bucket: np.ndarray, columns: dict[str, np.ndarray], known: np.ndarray, text: list[bytes] | None = None) -> pa.RecordBatch | None:
    """One packed row per bucket; `known` travels with the first (bucket 0 if there is no other)."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(bucket))
    if not len(cuts) and not len(known):
        return None
    if not len(cuts):
        bucket, cuts, ends = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    out = {"bucket": pa.array(bucket[cuts], pa.int64())}
    for k, v in columns.items():
        v = v[order]
        out[k] = pa.array([v[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary())
    out["known"] = pa.array([known.astype("<i8").tobytes(), *[b""] * (len(cuts) - 1)], pa.binary())
    if text is not None:
        out["text"] = pa.array([b"".join([text[i] for i in order[a:b]]) for a, b in zip(cuts, ends, strict=True)], pa.binary())
    return pa.RecordBatch.from_pydict(out)


def schema_of(kinds: dict[str, str]) -> str:
    return "bucket long, " + ", ".join(f"{k} binary" for k in kinds)


def per_bucket(
    df: DataFrame,
    n: int,
    work: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]],
    kinds: dict[str, str],
    schema: str,
    carry: str = "bucket",
) -> DataFrame:
    """Bring each bucket's packed rows together and call `work` once per bucket with its concatenated columns.

    `kinds` maps packed columns to numpy types; `work` returns int64 columns of `schema`.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {k: [] for k in kinds}
        now = None

        def flush() -> Iterator[pa.RecordBatch]:
            if now is not None:
                out = work({k: np.frombuffer(b"".join(v), kinds[k]) for k, v in held.items()})
                for v in held.values():
                    v.clear()
                for at in range(0, len(out[names[0]]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(out[k][at : at + 100_000], pa.int64()) for k in names], names)

        for batch in batches:
            own = batch.column(carry).to_pylist()
            columns = {k: batch.column(k).to_pylist() for k in kinds}
            for i, b in enumerate(own):
                if b != now:
                    yield from flush()
                    now = b
                for k in kinds:
                    held[k].append(columns[k][i])
        yield from flush()

    return df.repartition(n, carry).sortWithinPartitions(carry).mapInArrow(run, schema)


def runs(starts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group sorted positions into runs of consecutive ones with the same owner: index of each run's first, and its length."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(starts) != 1) | (owner[1:] != owner[:-1])]))
    return first, np.diff(np.append(first, len(starts)))


def with_spans(docs: DataFrame, spans: DataFrame, *more: str) -> DataFrame:
    """The rows of `docs` and, as __start, __count and __<more>, those of their names' spans (null where there are none).

    Columns of a user's table do not come here by name: they travel in one struct.
    """
    names = ("start", "count", *more)
    grouped = spans.groupBy(F.col("doc").alias("_d"), F.col("row").alias("_r")).agg(F.collect_list(F.struct(*names)).alias("_spans"))
    joined = docs.join(grouped, (docs[DOC] == grouped["_d"]) & (docs[ROW] == grouped["_r"]), "left")
    return joined.select(*(docs[c] for c in docs.columns), *(F.col(f"_spans.{k}").alias(f"__{k}") for k in names))


_KEYS = {"keys": "<u8", "docs": "<i8", "rows": "<i8", "starts": "<i4", "counts": "<i4", "places": "<i4", "many": "<i4", "known": "<i8"}
#: Of the runs of a block's windows: number of the text, key, first window, number of windows, place of the core.
Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _send_keys(
    batches: Iterator[pa.RecordBatch],
    parts: Callable[[list[str]], Runs | None],
    block: int,
    n: int,
) -> Iterator[pa.RecordBatch]:
    for docs, rows, texts in blocks(batches, block):
        if (got := parts(texts)) is None:
            continue
        at, keys, starts, counts, places = got
        order = np.argsort(keys, kind="stable")
        keys, starts, counts, places, at = keys[order], starts[order], counts[order], places[order], at[order]
        head = np.concatenate([[True], keys[1:] != keys[:-1]])
        many = np.bincount(np.cumsum(head) - 1)
        again = np.repeat(many > 1, many)
        known = np.stack([docs[at], rows[at], starts, counts, keys.view(np.int64), places], axis=1)[again]
        one = np.flatnonzero(head)
        columns = {
            "keys": keys[one],
            "docs": docs[at[one]],
            "rows": rows[at[one]],
            "starts": starts[one].astype("<i4"),
            "counts": counts[one].astype("<i4"),
            "places": places[one].astype("<i4"),
            "many": many.astype("<i4"),
        }
        if (out := packed((keys[one] % np.uint64(n)).astype(np.int64), columns, known)) is not None:
            yield out


def _seen(c: dict[str, np.ndarray], hot: int) -> dict[str, np.ndarray]:
    """The runs whose key is at several places; a hot key is told as a row of its own: count -1, the key, and its places as start."""
    order = np.argsort(c["keys"], kind="stable")
    keys, many = c["keys"][order], c["many"][order].astype(np.int64)
    head = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    total = np.add.reduceat(many, np.flatnonzero(head)) if len(keys) else np.zeros(0, np.int64)
    pick = order[(total[np.cumsum(head) - 1] > 1) & (many == 1)] if len(keys) else order
    known = c["known"].reshape(-1, 6)
    high = np.flatnonzero(total > hot)
    none = np.zeros(len(high), np.int64)
    told = {"doc": none, "row": none, "start": total[high], "count": none - 1, "key": keys[head][high].view(np.int64), "place": none}
    out = {
        "doc": c["docs"],
        "row": c["rows"],
        "start": c["starts"],
        "count": c["counts"],
        "key": c["keys"].view(np.int64),
        "place": c["places"],
    }
    return {k: np.concatenate([v[pick].astype(np.int64), known[:, i], told[k]]) for i, (k, v) in enumerate(out.items())}


def shared_runs(
    texts: DataFrame,
    size: int,
    parts: Callable[[list[str]], Runs | None],
    per_byte: float,
    block: int,
) -> tuple[DataFrame, np.ndarray]:
    """Runs of windows (SPAN) whose key occurs at several places, and the sorted hot keys; `size` is the bytes of all texts.

    `parts` gives the runs of a block of texts (None: there are none); `per_byte` is about what it makes of a byte. Each block of texts tells a key once, with its number of places.
    """
    n = buckets_for(texts, size * per_byte)
    hot = max(HOT_PLACES, int(size * per_byte / 32) // HOT_KEYS)
    sent = texts.mapInArrow(lambda batches: _send_keys(batches, parts, block, n), schema_of(_KEYS))
    found = cut(per_bucket(sent, n, lambda c: _seen(c, hot), _KEYS, SPAN), "shared")
    keys = np.sort(np.array([r["key"] for r in found.filter("count < 0").select("key").collect()], np.int64).view(np.uint64))
    return found.filter("count > 0"), keys


def span_blocks(batches: Iterator[pa.RecordBatch], size: int, *names: str) -> Iterator[
    tuple[np.ndarray, np.ndarray, list[str], np.ndarray, list[np.ndarray]]
]:
    """Rows with spans in blocks of about `size` characters: docs, rows, texts, and of all spans the number of its text in the block and the columns of `names`.

    Spans stay arrays; Python lists of them would take many times the memory.
    """
    for batch in batches:
        docs, rows = (batch.column(k).to_numpy(zero_copy_only=False) for k in (DOC, ROW))
        columns = [batch.column(f"__{k}") for k in names]
        ends = np.cumsum(columns[0].value_lengths().to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros(0, np.int64)
        flat = [c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
        texts, begin, n = [], 0, 0
        for i, t in enumerate(batch.column("text")):
            texts.append(t.as_py())
            n += len(texts[-1])
            if n >= size or i + 1 == batch.num_rows:
                a, b = (ends[begin - 1] if begin else 0), ends[i]
                owner = np.searchsorted(ends[begin : i + 1], np.arange(a, b), "right")
                yield docs[begin : i + 1], rows[begin : i + 1], texts, owner, [v[a:b] for v in flat]
                texts, begin, n = [], i + 1, 0


def is_hot(keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(keys), bool)
    return hot[np.minimum(np.searchsorted(hot, keys), len(hot) - 1)] == keys


def flagged(starts: list | None, counts: list | None, width: int, n: int) -> np.ndarray:
    """Mask of the n positions covered by the windows of these spans."""
    step = np.zeros(n + 1, np.int64)
    if starts:
        s, c = np.array(starts, np.int64), np.array(counts, np.int64)
        np.add.at(step, s, 1)
        np.add.at(step, np.minimum(s + c - 1 + width, n), -1)
    return np.cumsum(step[:-1]) > 0
