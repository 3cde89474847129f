"""Helpers shared by the text operators: word arrays, Arrow plumbing; `cut` is passed on for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from strandflow.sources.scratch import cut as cut

#: Entries a per-worker cache may hold before it is emptied; bounds its memory (about 60 MB). A worker may serve
#: several operators one after the other, and their caches add up.
CACHE_ENTRIES = 300_000
#: The same for word hashes, which cost little to make anew.
WORD_ENTRIES = 100_000
#: Odd multipliers of the 64-bit mixers (fixed values).
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x9E3779B97F4A7C15)


def map_rows(df: DataFrame, rows: Callable[[dict], dict], schema: T.StructType | str) -> DataFrame:
    """mapInArrow over record batches; `rows` turns a dict of Arrow columns into a dict of output columns."""
    out_schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = rows({n: batch.column(i) for i, n in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([as_arrow(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out_schema)


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


class WordHashes(dict):
    """word (bytes) -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of `words`, from a bounded cache of this worker."""
    if len(_WORDS) > WORD_ENTRIES:
        _WORDS.clear()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def split_words(text: str | None) -> list[bytes]:
    r"""Words `[^\x20\x09-\x0D]+` of a text as UTF-8 (bytes.split() cuts at exactly those six bytes)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k consecutive entries, in order."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= BASE
        out ^= out >> np.uint64(29)
        out += hashes[j : j + n]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Boolean mask of the n positions that lie in [s, s + width) for some s in `starts`."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, n), -1)
    return np.cumsum(step[:-1]) > 0


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that extra columns never clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def filter_rows(df: DataFrame, decide: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of `df`, all columns as they are, for whose texts `decide` says so. Rows travel as one struct, so columns may have any name."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.column(1).filter(pa.array(decide(batch.column(0).to_pylist()), pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.flatten(), names)

    return df.select("text", F.struct("*").alias("whole")).mapInArrow(run, df.schema)
