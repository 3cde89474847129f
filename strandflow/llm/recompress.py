"""Repeated word sequences by recompression.

A text is rewritten round by round: runs of one word become one symbol, then neighbouring symbols
that a hash bit makes "left" and "right" become one. A symbol's name is a 64-bit hash of what it
replaced, so equal word sequences get equal names in every document of the corpus: the names are
global without an exchange, and the rounds run in one pass. Each symbol also knows the range of
words that decided it; inside equal windows the symbols decided by the window alone are the same.

The symbol with the smallest name - of the highest round that has any - is a window's anchor. Its name,
together with that of the half window that begins or ends at it, is the window's key. Keys are
counted over the corpus; only windows whose key is shared can repeat and go on, all others are settled.
Shared ones meet by key and are verified on the words of the whole window, by a 128-bit print; the
first in (document, start) order stays.

Before each shuffle a block of documents combines: it tells each key once, sends only its own first
occurrence of a window, and flags the others at once, so a passage that a third of the documents
share stays one record per block. Windows of a hot key (`windows.HOT_PLACES`) are dealt out by
their prints, so that they do not meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strandflow.llm.common import BASE, cut, map_rows, mix, texts_of, word_hashes
from strandflow.llm import windows as win

ROUNDS = 3
BLOCK_CHARS = 1 << 20
_KINDS = {"docs": "<i8", "rows": "<i8", "starts": "<i4", "counts": "<i4", "prints": "<u8", "others": "<u8", "known": "<i8"}
_OTHER = np.uint64(0xD6E8FEB86659FD93)
_SEAM = np.uint64(0)  # stands between documents and never joins a symbol


def symbols(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(name, first word, first deciding word, end of deciding words) of the symbols after each round."""
    n = len(words)
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    size = np.diff(np.append(first, n))
    name = np.where((size > 1) & (words[first] != _SEAM), mix(words[first] * BASE + size.astype(np.uint64)), words[first])
    low, high = np.maximum(first - 1, 0), np.minimum(first + size + 1, n)  # a run is known with both its neighbours
    begin = first
    for k in range(ROUNDS):
        left = (mix(name + np.uint64(k + 1)) & np.uint64(1)).astype(bool)
        seam = name == _SEAM
        join = np.zeros(len(name), bool)
        join[:-1] = left[:-1] & ~left[1:] & ~seam[:-1] & ~seam[1:]
        second = np.zeros(len(name), bool)
        second[1:] = join[:-1]
        after_low, before_high = low.copy(), high.copy()
        # a left symbol is decided with its right neighbour, a right one with its left neighbour
        before_high[:-1] = np.where(left[:-1], high[1:], high[:-1])
        after_low[1:] = np.where(left[1:], low[1:], low[:-1])
        joined = mix(name[:-1] * BASE + (name[1:] ^ (name[1:] >> np.uint64(31))))
        name = np.where(join, np.append(joined, _SEAM), name)
        keep = ~second
        low, high, name, begin = after_low[keep], before_high[keep], name[keep], begin[keep]
        yield name, begin, low, high


def anchors(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows at `starts`: the anchor's name, its first word, and a number that changes when the anchor does."""
    mask = np.uint64((1 << 24) - 1)

    def least(name, low, high):
        return win.range_min((mix(name) & ~mask) | np.arange(len(name), dtype=np.uint64), low, high)

    best = least(words, starts, starts + width)
    place = (best & mask).astype(np.int64)
    name, number = words[place], place.copy()
    for level, (names, begin, low, high) in enumerate(symbols(words), 1):
        a, b = np.searchsorted(low, starts, "left"), np.searchsorted(high, starts + width, "right")
        some = np.flatnonzero(a < b)
        at = (least(names, a[some], b[some]) & mask).astype(np.int64)
        name[some], place[some], number[some] = names[at], begin[at], at + level * (len(words) + 1)
    return name, place, number


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word hashes of all texts, a seam before and behind each; where each text begins, and its number of words."""
    hashes = [word_hashes(t.encode("utf-8", "surrogatepass").split()) for t in texts]
    size = np.array([len(h) for h in hashes], np.int64)
    seam = np.array([_SEAM])
    words = np.concatenate([seam, *(x for h in hashes for x in (np.where(h == _SEAM, np.uint64(1), h), seam))])
    return words, np.cumsum(size + 1) - size, size


def parts(texts: list[str], width: int) -> win.Runs | None:
    """Runs of windows with the same anchor and half window; the place is not used."""
    words, begin, size = _words(texts)
    own = np.maximum(size - width + 1, 0)
    at = win.spread(begin, own)
    if not len(at):
        return None
    doc = np.repeat(np.arange(len(texts)), own)
    name, place, number = anchors(words, at, width)
    back = (width - 1) // 2
    half = min(back + 1, width - back)
    first = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (doc[1:] != doc[:-1])]))
    count = np.diff(np.append(first, len(at)))
    start, p = at[first], place[first]
    turn = np.clip(p - back + 1, start, start + count)  # windows before it hold the half that ends at the anchor
    start, stop = np.concatenate([start, turn]), np.concatenate([turn, start + count])
    some = np.flatnonzero(stop > start)
    some = some[np.argsort(start[some], kind="stable")]
    half_at = np.concatenate([p - back, p])[some]
    key = mix(
        win.run_prints(win.prefix_prints(words), half_at, half) ^ mix(np.tile(name[first], 2)[some] + (some < len(p)).astype(np.uint64))
    )
    doc = np.tile(doc[first], 2)[some]
    return doc, key, start[some] - begin[doc], (stop - start)[some], np.zeros(len(some), np.int64)


def _prints(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of the windows' 128-bit prints."""
    a, b = (win.run_prints(win.prefix_prints(x), starts, width) for x in (words, mix(words ^ _OTHER)))
    return a, b


def _later(prints: np.ndarray, others: np.ndarray, docs: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows are at another place than the first one with their print, and which are that first one."""
    order = np.lexsort((starts, rows, docs, others, prints))
    a, b = prints[order], others[order]
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
    first = order[head][np.cumsum(head) - 1] if len(a) else order
    late, leads = np.zeros(len(a), bool), np.zeros(len(a), bool)
    late[order] = (docs[order] != docs[first]) | (rows[order] != rows[first]) | (starts[order] != starts[first])
    leads[order[head]] = True
    return late, leads


def _runs(docs: np.ndarray, rows: np.ndarray, starts: np.ndarray, also: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and length of the runs of consecutive starts of one row with the same `also`; sorted by row and start."""
    change = (docs[1:] != docs[:-1]) | (rows[1:] != rows[:-1]) | (also[1:] != also[:-1])
    return win.runs(starts, np.concatenate([[0], np.cumsum(change)]) if len(docs) else docs)


def _send(batches: Iterator[pa.RecordBatch], width: int, n: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    for docs, rows, texts, own, (start, count, key) in win.span_blocks(batches, BLOCK_CHARS, "start", "count", "key"):
        yield _block(docs, rows, texts, own, start, count, key, width, n, hot)


def _block(
    docs: np.ndarray,
    rows: np.ndarray,
    texts: list[str],
    own: np.ndarray,
    start: np.ndarray,
    count: np.ndarray,
    key: np.ndarray,
    width: int,
    n: int,
    hot: np.ndarray,
) -> pa.RecordBatch:
    """The shared windows of a block, packed by bucket; those that are late in the block itself travel with the first."""
    words, begin, _ = _words(texts)
    order = np.lexsort((start, own))
    own, start, count, key = own[order], start[order], count[order], key[order].view(np.uint64)
    starts = win.spread(start, count)
    owner, bucket = np.repeat(own, count), np.repeat(mix(key), count)
    prints, others = _prints(words, begin[owner] + starts, width)
    goal = np.repeat(win.is_hot(key, hot), count)
    bucket = (np.where(goal, prints, bucket) % np.uint64(n)).astype(np.int64)
    docs, rows = docs[owner], rows[owner]
    late, leads = _later(prints, others, docs, rows, starts)
    at = np.flatnonzero(late)
    f, c = _runs(docs[at], rows[at], starts[at], np.zeros(len(at), np.int64))
    known = np.stack([docs[at][f], rows[at][f], starts[at][f], c], axis=1)
    at = np.flatnonzero(leads)
    at = at[np.lexsort((starts[at], rows[at], docs[at], bucket[at]))]
    f, c = _runs(docs[at], rows[at], starts[at], bucket[at])
    cuts = np.flatnonzero(np.concatenate([[True], bucket[at][1:] != bucket[at][:-1]]))
    ends = np.append(cuts[1:], len(at))
    run_cuts, run_ends = np.searchsorted(f, cuts), np.searchsorted(f, ends)
    runs = {"docs": docs[at][f], "rows": rows[at][f], "starts": starts[at][f].astype("<i4"), "counts": c.astype("<i4")}
    out = [pa.array(bucket[at][cuts], pa.int64())]
    out += [pa.array([v[x:y].tobytes() for x, y in zip(run_cuts, run_ends, strict=True)], pa.binary()) for v in runs.values()]
    out += [pa.array([v[x:y].tobytes() for x, y in zip(cuts, ends, strict=True)], pa.binary()) for v in (prints[at], others[at])]
    out.append(pa.array([known.astype("<i8").tobytes(), *[b""] * (len(cuts) - 1)], pa.binary()))
    return pa.RecordBatch.from_arrays(out, ["bucket", *_KINDS])


def _late(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Within a bucket: the windows that are not the first of their print, as runs."""
    counts = c["counts"].astype(np.int64)
    docs, rows = np.repeat(c["docs"], counts), np.repeat(c["rows"], counts)
    starts = win.spread(c["starts"].astype(np.int64), counts)
    at = np.flatnonzero(_later(c["prints"], c["others"], docs, rows, starts)[0])
    at = at[np.lexsort((starts[at], rows[at], docs[at]))]
    f, n = _runs(docs[at], rows[at], starts[at], np.zeros(len(at), np.int64))
    known = c["known"].reshape(-1, 4)
    out = {"doc": docs[at][f], "row": rows[at][f], "start": starts[at][f], "count": n}
    return {k: np.concatenate([v, known[:, i]]) for i, (k, v) in enumerate(out.items())}


def repeats(texts: DataFrame, width: int = 20) -> DataFrame:
    """(doc, row, start, count): runs of windows of `width` words that also start earlier in the corpus; `texts` has named rows."""
    texts, _, size = win.one_of_each(texts)  # rows of one name are one document
    shared, hot = win.shared_runs(texts, size, lambda block: parts(block, width), 1.0, BLOCK_CHARS)
    n = win.buckets_for(texts, size * 1.5)
    sent = win.with_spans(texts, shared, "key").filter("__start is not null")
    prints = sent.mapInArrow(lambda batches: _send(batches, width, n, hot), win.schema_of(_KINDS))
    return cut(win.per_bucket(prints, n, _late, _KINDS, "doc long, row long, start long, count long"), "late")


def remove_repeats(docs: DataFrame, width: int = 20) -> DataFrame:
    r"""(doc_id, n_words, n_removed, kept_sha256, kept_text) per row of `docs`.

    Words are runs of anything but ASCII white space. A word goes if a window of `width` words
    that covers it also starts earlier: in a smaller doc_id, or before in the same document.
    Null and empty texts have no words; a text below `width` words keeps all. A null doc_id counts
    as the smallest. Rows that agree in doc_id and text are one document, none of them earlier than the
    others, and get the same result; of rows that share only the doc_id the one with the smaller hash
    of its text counts as earlier. An empty table gives no rows; extra columns are left out.
    """
    texts = win.named(texts_of(docs))

    def rows(c):
        n_words, removed, sha, kept = [], [], [], []
        for text, starts, counts in zip(*(c[k].to_pylist() for k in ("text", "__start", "__count")), strict=True):
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            gone = win.flagged(starts, counts, width, len(words))
            left = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words)
            n_words.append(len(words))
            removed.append(int(gone.sum()))
            sha.append(hashlib.sha256(left).hexdigest())
            kept.append(left.decode("utf-8", "replace"))
        return {"doc_id": c["doc_id"], "n_words": n_words, "n_removed": removed, "kept_sha256": sha, "kept_text": kept}

    return map_rows(
        win.with_spans(texts, repeats(texts, width)),
        rows,
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string",
    )
