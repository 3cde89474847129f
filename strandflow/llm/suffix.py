"""Repeated byte strings with suffix arrays built by induced sorting.

A suffix array of the whole corpus would be one task's work, so text is first dealt out to shards by
content: each window of `width` bytes has an anchor, its 32-gram with the smallest hash, and lies
around it in one of two ways, so that it holds the long core before or behind the anchor. Windows
whose core occurs once cannot repeat and go no further. For the others the surrounding text of
the core is sent to the core's shard. There, contexts that agree in full settle their windows; the
distinct contexts of all cores of the shard are laid end to end (each core itself as one letter), the
shard's suffix array is built by induced sorting, and permuted common prefixes with both
neighbours in it tell which windows occur again. Equal windows hold the same core, so no
window has its twin in another shard.

Blocks of documents combine before each shuffle: a core seen twice in a block is known to be
shared, and contexts that agree within a block are settled there; one of them is sent on. The windows
of a hot core (`windows.HOT_PLACES`), whose contexts would all meet in one task, are dealt out one by
one instead, by 64 bits of a 128-bit print, and repeat if their prints do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strandflow.llm.common import cut, map_rows, mix, texts_of
from strandflow.llm import windows as win

GRAM = 32
BLOCK_CHARS = 1 << 20
#: Bytes of contexts that one suffix array is built of (more, if one core has more): its lists should stay in a CPU's cache.
SHARD_BYTES = 1 << 15
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_OTHER_BYTES = mix(_BYTES + np.uint64(1))


def suffix_array(s: list[int], letters: int) -> list[int]:
    """Suffix array of `s` (letters below `letters`) by induced sorting, in linear time."""
    n = len(s)
    if n < 2:
        return list(range(n))
    text = np.array(s, np.int32)
    differs = np.flatnonzero(text[1:] != text[:-1])  # a suffix compares to the next one as these letters do
    turn = np.searchsorted(differs, np.arange(n - 1))
    rises = np.append(text[differs] < text[differs + 1], False)  # the last letters fall to the end of the text
    smaller = np.append(rises[turn], False)
    small, large = smaller.tolist(), (~smaller).tolist()
    size = np.bincount(text, minlength=letters)
    heads, tails = (np.cumsum(size) - size).tolist(), np.cumsum(size).tolist()
    is_leftmost = np.append(False, smaller[1:] & ~smaller[:-1])
    leftmost = np.flatnonzero(is_leftmost)

    def induce(order: list[int]) -> list[int]:
        """All suffixes, sorted from the order of the leftmost smaller ones."""
        sa = [-1] * n
        free = tails[:]
        for i in reversed(order):
            c = s[i]
            free[c] -= 1
            sa[free[c]] = i
        free = heads[:]
        last = s[n - 1]  # the last suffix is larger than the end of the text
        sa[free[last]] = n - 1
        free[last] += 1
        for i in sa:  # grows while it is read
            if i > 0 and large[i - 1]:
                c = s[i - 1]
                sa[free[c]] = i - 1
                free[c] += 1
        free = tails[:]
        for i in reversed(sa):
            if i > 0 and small[i - 1]:
                c = s[i - 1]
                free[c] -= 1
                sa[free[c]] = i - 1
        return sa

    if not len(leftmost):
        return induce([])
    sa = np.array(induce(leftmost.tolist()), np.int64)
    order = sa[is_leftmost[sa]]
    ends = np.zeros(n, np.int64)
    ends[leftmost] = np.append(leftmost[1:], n - 1)
    size = ends[order] - order
    like = np.append(False, (size[1:] == size[:-1]) & (ends[order[1:]] < n - 1) & (ends[order[:-1]] < n - 1))  # the one at the end is only like itself
    raw = text.tobytes()
    for k in np.flatnonzero(like).tolist():
        i, j, z = 4 * int(order[k]), 4 * int(order[k - 1]), 4 * int(size[k]) + 4
        like[k] = raw[i : i + z] == raw[j : j + z]
    name = np.cumsum(~like) - 1
    if name[-1] + 1 < len(leftmost):
        names = np.zeros(n, np.int64)
        names[order] = name
        inner = suffix_array(names[leftmost].tolist(), int(name[-1]) + 1)
        return induce(leftmost[np.array(inner, np.int64)].tolist())
    return induce(order.tolist())


def common_prefixes(s: list[int], sa: list[int]) -> tuple[list[int], list[int]]:
    """For each position, in text order: the common prefix with its predecessor in the suffix array, and its successor (-1: none)."""
    n = len(s)
    before, after = [-1] * n, [-1] * n
    for a, b in zip(sa, sa[1:]):
        before[b] = a
        after[a] = b
    out, k = [0] * n, 0
    for i in range(n):
        j = before[i]
        if j < 0:
            k = 0
            continue
        end = n - max(i, j)
        while k < end and s[i + k] == s[j + k]:
            k += 1
        out[i] = k
        if k:
            k -= 1
    return out, after


def repeated_windows(contexts: list[bytes], places: list[int], cores: list[int], core: int, width: int) -> list[np.ndarray]:
    """For distinct contexts whose `core` bytes at `places` are core number `cores`: which of their windows of `width` bytes occur twice among those with the same core."""
    text: list[int] = []
    begin = []
    kinds = 256 + max(cores, default=0) + 1
    for k, (c, at, own) in enumerate(zip(contexts, places, cores, strict=True)):
        begin.append(len(text))
        text += c[:at]
        text.append(256 + own)
        text += c[at + core :]
        text.append(kinds + k)  # ends the context; unlike any other letter
    letters, short = np.unique(np.array(text), return_inverse=True)
    s = short.tolist()
    prefix, after = common_prefixes(s, suffix_array(s, len(letters)))
    need = width - core + 1
    out = []
    for c, b in zip(contexts, begin, strict=True):
        own = range(b, b + len(c) - width + 1)
        out.append(np.array([prefix[i] >= need or (after[i] >= 0 and prefix[after[i]] >= need) for i in own], bool))
    return out


def parts(text: str, width: int) -> tuple[np.ndarray, ...] | None:
    """Runs of windows of a text with the same core: key, first window, number of windows, and the core's place in the run."""
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) < width:
        return None
    core, back = _core(width)
    b = np.frombuffer(raw, np.uint8)
    prefix = win.prefix_prints(_BYTES[b])
    gram = win.run_prints(prefix, np.arange(len(b) - GRAM + 1), GRAM)
    chunk, keep = 1 << 22, np.uint64((1 << 24) - 1)
    found = []
    for at in range(0, len(b) - width + 1, chunk):
        piece = gram[at : at + chunk + width - GRAM]
        low = win.sliding_min((piece & ~keep) | np.arange(len(piece), dtype=np.uint64), width - GRAM + 1)
        found.append((low & keep).astype(np.int64) + at)
    anchor = np.concatenate(found)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    end, p = np.append(first[1:], len(anchor)), anchor[first]
    turn = np.clip(p - back + 1, first, end)  # windows before it hold the core that ends with the anchor
    start, stop = np.concatenate([first, turn]), np.concatenate([turn, end])
    place = np.concatenate([p - back, p])
    some = np.flatnonzero(stop > start)
    some = some[np.argsort(start[some], kind="stable")]
    start, stop, place = start[some], stop[some], place[some]
    key = mix(win.run_prints(prefix, place, core) + (some < len(p)).astype(np.uint64))
    return key, start, stop - start, place - start


def block_parts(texts: list[str], width: int) -> win.Runs | None:
    """The runs of all texts of a block."""
    got = [(i, x) for i, t in enumerate(texts) if (x := parts(t, width)) is not None]
    if not got:
        return None
    return np.repeat(
        np.array([i for i, _ in got], np.int64),
        [len(x[0]) for _, x in got],
    ), *(np.concatenate([x[k] for _, x in got]) for k in range(4))


def _core(width: int) -> tuple[int, int]:
    """Length of the core, and how far before the anchor the first kind begins."""
    back = (width - GRAM) // 2
    return min(back + GRAM, width - back), back


_TEXT = {"keys": "<u8", "docs": "<i8", "rows": "<i8", "starts": "<i4", "counts": "<i4", "places": "<i4", "known": "<i8", "text": "u1"}
_PRINT = {"prints": "<u8", "others": "<u8", "docs": "<i8", "rows": "<i8", "starts": "<i4", "known": "<i8"}
_FOUND = "doc long, row long, start long, count long"


def _send_text(batches: Iterator[pa.RecordBatch], width: int, n: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The contexts of the cores that are not hot, one row for each shard and block."""
    for docs, rows, texts, own, columns in win.span_blocks(batches, BLOCK_CHARS, "start", "count", "key", "place"):
        some = ~win.is_hot(columns[2].view(np.uint64), hot)
        own, (start, count, key, place) = own[some], (v[some] for v in columns)
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        contexts = [raw[i][a : a + c - 1 + width] for i, a, c in zip(own.tolist(), start.tolist(), count.tolist(), strict=True)]
        first: dict[tuple, int] = {}
        same = [first.setdefault(m, i) for i, m in enumerate(zip(key.tolist(), contexts, strict=True))]
        twice = {j for i, j in enumerate(same) if i != j}
        again = np.array([j in twice for j in same], bool)
        c = {"keys": key.view(np.uint64), "docs": docs[own], "rows": rows[own], "starts": start, "counts": count, "places": place}
        known = np.stack([c[k] for k in ("docs", "rows", "starts", "counts")], axis=1)[again]
        one = np.array(sorted(first.values()), np.int64)
        c = {k: v[one].astype(np.dtype(_TEXT[k])) for k, v in c.items()}
        if (out := win.packed((c["keys"] % np.uint64(n)).astype(np.int64), c, known, [contexts[i] for i in one])) is not None:
            yield out.select(["bucket", *_TEXT])


def _shards(cores: list[dict], size: int) -> Iterator[list[dict]]:
    """The contexts of whole cores in groups of about `size` bytes, one suffix array each."""
    held, n = [], 0
    for contexts in cores:
        held.append(contexts)
        n += sum(map(len, contexts))
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _settle(c: dict[str, np.ndarray], width: int) -> dict[str, np.ndarray]:
    """Within a shard: the windows that occur again, as runs."""
    core, _ = _core(width)
    size = c["counts"].astype(np.int64) - 1 + width
    begin = np.cumsum(size) - size
    text = c["text"].tobytes()
    places: dict[int, dict[bytes, list[int]]] = {}  # by core, then by context
    for i, key in enumerate(c["keys"].tolist()):
        places.setdefault(key, {}).setdefault(text[begin[i] : begin[i] + size[i]], []).append(i)
    out = [c["known"].reshape(-1, 4)]
    alike = [i for members in places.values() for rows in members.values() if len(rows) > 1 for i in rows]
    out.append(np.stack([c["docs"][alike], c["rows"][alike], c["starts"][alike], c["counts"][alike]], axis=1).astype(np.int64))
    for members in _shards([m for m in places.values() if len(m) > 1], SHARD_BYTES):
        laid = [(number, context, rows) for number, m in enumerate(members) for context, rows in m.items()]
        numbers, contexts, own = zip(*laid, strict=True)
        found = repeated_windows(list(contexts), [int(c["places"][rows[0]]) for rows in own], list(numbers), core, width)
        for rows, again in zip(own, found, strict=True):
            if len(rows) == 1 and again.any():
                at, i = np.flatnonzero(again), rows[0]
                f, n = win.runs(at, np.zeros(len(at), np.int64))
                first = [np.full(len(f), c["docs"][i]), np.full(len(f), c["rows"][i]), c["starts"][i] + at[f], n]
                out.append(np.stack(first, axis=1).astype(np.int64))
    rows = np.concatenate(out)
    return {k: rows[:, i] for i, k in enumerate(("doc", "row", "start", "count"))}


def _send_prints(batches: Iterator[pa.RecordBatch], width: int, n: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The windows of the hot cores, each by itself; a window seen twice in a block is known to repeat and sent once."""
    for docs, rows, texts, own, (start, count, key) in win.span_blocks(batches, BLOCK_CHARS, "start", "count", "key"):
        some = win.is_hot(key.view(np.uint64), hot)
        if not some.any():
            continue
        own, start, count = own[some], start[some], count[some]
        starts, owner = win.spread(start, count), np.repeat(own, count)
        prints, others = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
        for i in np.unique(own).tolist():
            raw, mine = np.frombuffer(texts[i].encode("utf-8", "surrogatepass"), np.uint8), slice(*np.searchsorted(owner, [i, i + 1]))
            for out, values in ((prints, _BYTES), (others, _OTHER_BYTES)):
                out[mine] = win.run_prints(win.prefix_prints(values[raw]), starts[mine], width)
        order = np.lexsort((others, prints))
        prints, others, starts, owner = prints[order], others[order], starts[order], owner[order]
        head = np.concatenate([[True], (prints[1:] != prints[:-1]) | (others[1:] != others[:-1])])
        again = (np.bincount(np.cumsum(head) - 1) > 1)[np.cumsum(head) - 1]
        known = np.stack([docs[owner], rows[owner], starts], axis=1)[again]
        columns = {"prints": prints, "others": others, "docs": docs[owner], "rows": rows[owner], "starts": starts.astype("<i4")}
        out = win.packed((prints[head] % np.uint64(n)).astype(np.int64), {k: v[head] for k, v in columns.items()}, known)
        if out is not None:
            yield out


def _settle_prints(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    order = np.lexsort((c["others"], c["prints"]))
    a, b = c["prints"][order], c["others"][order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    again = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(order) else order
    known = c["known"].reshape(-1, 3)
    docs, rows, starts = (np.concatenate([c[k][again].astype(np.int64), known[:, i]]) for i, k in enumerate(("docs", "rows", "starts")))
    order = np.lexsort((starts, rows, docs))
    docs, rows, starts = docs[order], rows[order], starts[order]
    fresh = np.concatenate([[True], (docs[1:] != docs[:-1]) | (rows[1:] != rows[:-1])]) if len(docs) else np.zeros(0, bool)
    first, count = win.runs(starts, np.cumsum(fresh))
    return {"doc": docs[first], "row": rows[first], "start": starts[first], "count": count}


def repeats(texts: DataFrame, width: int = 400) -> DataFrame:
    """(doc, row, start, count): runs of windows of `width` bytes that also start anywhere else in the corpus; `texts` has named rows."""
    texts, again, size = win.one_of_each(texts)
    shared, hot = win.shared_runs(texts, size, lambda t: block_parts(t, width), 0.25, BLOCK_CHARS)
    n = win.buckets_for(texts, size * 2.0)  # small shards: Python's lists take many times the bytes
    sent = win.with_spans(texts, shared, "key", "place").filter("__start is not null")
    contexts = sent.mapInArrow(lambda batches: _send_text(batches, width, n, hot), win.schema_of(_TEXT))
    found = win.per_bucket(contexts, n, lambda c: _settle(c, width), _TEXT, _FOUND)
    if len(hot):
        single = sent.mapInArrow(lambda batches: _send_prints(batches, width, n, hot), win.schema_of(_PRINT))
        found = found.unionAll(win.per_bucket(single, n, _settle_prints, _PRINT, _FOUND))
    if again is not None:  # every window of a text that is there twice repeats
        whole = again.filter(F.col("bytes") >= width).select("doc", "row", F.lit(0).cast("long").alias("start"), (F.col("bytes") - width + 1).alias("count"))
        found = found.unionAll(whole)
    return cut(found, "repeats")


def _left(text: str, starts: list | None, counts: list | None, width: int) -> tuple[bytes, np.ndarray]:
    """The bytes of a text that stay, and the mask of all that go."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    gone = win.flagged(starts, counts, width, len(raw))
    return (np.frombuffer(raw, np.uint8)[~gone].tobytes() if starts else raw), gone


def cut_texts(docs: DataFrame, width: int = 400) -> DataFrame:
    """`docs` without the bytes that `remove_repeats` removes; other columns as they are.

    Characters cut in two are dropped. n_chars, if there, becomes the text's new length. Null and
    empty texts stay; a text that repeats whole stays as an empty one; repeated rows repeat each
    other, whatever their doc_id. An empty table stays empty. Extra columns may have any name: rows
    travel as one struct.
    """
    names, schema = docs.columns, docs.schema
    own = win.named(docs.select(F.struct("*").alias("whole"), "doc_id", "text")).select("whole", win.DOC, win.ROW)
    joined = win.with_spans(own, repeats(win.named(texts_of(docs)), width)).drop(win.DOC, win.ROW)
    at, n_chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.column(0).flatten()
            starts, counts = (batch.column(k).to_pylist() for k in (1, 2))
            texts = [_left(t, s, c, width)[0].decode("utf-8", "ignore") if s else t for t, s, c in zip(out[at].to_pylist(), starts, counts, strict=True)]
            out[at] = pa.array(texts, pa.string())
            if n_chars is not None:
                out[n_chars] = pa.array([None if t is None else len(t) for t in texts], out[n_chars].type)
            yield pa.RecordBatch.from_arrays(out, names)

    return joined.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, width: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row of `docs`; `kept` holds the remaining bytes.

    A byte of a text (UTF-8) goes if a `width`-byte string that covers it also starts anywhere
    else, in this document or another. Null and empty texts have no bytes; texts shorter than
    `width` keep all. Each row is a document of its own, whatever its doc_id: repeated rows repeat
    each other. An empty table gives no rows; extra columns are left out.
    """
    texts = win.named(texts_of(docs))

    def rows(c):
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for text, starts, counts in zip(*(c[k].to_pylist() for k in ("text", "__start", "__count")), strict=True):
            left, gone = _left(text, starts, counts, width)
            for k, v in zip(
                out,
                (
                    len(gone),
                    int(gone.sum()),
                    int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)),
                    hashlib.sha256(left).hexdigest(),
                    left,
                ),
                strict=True,
            ):
                out[k].append(v)
        return {"doc_id": c["doc_id"], **out}

    return map_rows(
        win.with_spans(texts, repeats(texts, width)),
        rows,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
