"""Toxicity by a classifier chain.

Features say whether a text holds selected hashed words and byte 5-grams of its lower-cased
words; presence rather than share, so that a few toxic words in a long text count as in a short
one. The buckets are selected on the sample by their chi-square association with the label.

The labels name no kinds of toxicity, so kinds are learned: toxic texts of the sample are clustered by the
selected features they hold, and each cluster is a category of its own kind of vocabulary. The
categories are predicted one after the other, then toxicity itself: each linear model sees the
features and the probabilities of the categories before it, which in training are out-of-fold predictions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from strandflow.llm import linear
from strandflow.llm.common import filter_rows, map_rows, texts_of, word_hashes

BITS = 18
SIZE = 1 << BITS
#: Labelled rows per class of the last category, features kept, folds, and the probability from which a text is toxic.
PER_CLASS = 1000
KEPT_FEATURES = 600
FOLDS = 4
TOXIC_FROM = 0.5
#: Kinds of toxic vocabulary that are learned; the chain is kind_0, kind_1 ..., toxic.
KINDS = 3
_EDGES = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))


def hashed(text: str | None) -> np.ndarray:
    """Buckets of a text, with repeats: its words without outer punctuation, and the byte 5-grams of its words with their edges."""
    if not text:
        return np.zeros(0, np.int64)
    raw = text.lower().encode("utf-8", "surrogatepass")
    words = word_hashes([w.strip(_EDGES) for w in raw.split()])
    b = np.frombuffer(b" " + raw.translate(_SPACED) + b" ", np.uint8).astype(np.uint64)
    key = np.zeros(max(len(b) - 4, 0), np.uint64)
    for j in range(5 if len(key) else 0):
        key |= b[j : len(b) - 4 + j] << np.uint64(8 * (4 - j))
    shift = np.uint64(64 - BITS)
    return np.concatenate([words >> shift, (key * np.uint64(0x9E3779B97F4A7C15)) >> shift]).astype(np.int64)


def buckets(text: str | None) -> np.ndarray:
    """Distinct buckets of a text."""
    return np.unique(hashed(text))


_SPACED = bytes(32 if c < 33 else c for c in range(256))


def kinds_of(x: np.ndarray, n: int, rounds: int = 20) -> np.ndarray:
    """Cluster of each row of presence features: k-means on directions, begun with rows far from each other; larger clusters first."""
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    seeds = [int(np.argmax(x.sum(1)))]
    while len(seeds) < min(n, len(x)):
        seeds.append(int(np.argmin((unit @ unit[seeds].T).max(1))))
    centres = unit[seeds]
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(1)
        sums = np.stack([unit[own == k].sum(0) for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    order = np.argsort(-np.bincount(own, minlength=len(centres)), kind="stable")
    return np.argsort(order)[own]


def fit(docs: DataFrame, labels: DataFrame, kinds: int = KINDS, per_class: int = PER_CLASS, kept: int = KEPT_FEATURES) -> dict | None:
    """The chain from at most `per_class` toxic and as many other labelled rows; None if one is absent.

    A document with several labels is toxic if any of them says so; null labels say nothing.
    """
    marks = labels.filter("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("mark")
    )
    wanted = linear.sample(marks, "mark", per_class).select("doc_id", "mark", "draw")
    picked = texts_of(docs).join(F.broadcast(wanted), "doc_id")  # at most 2 * per_class rows

    def rows(c):
        return {
            "doc_id": c["doc_id"],
            "draw": c["draw"],
            "mark": c["mark"],
            "index": [buckets(t).astype(np.int32).tobytes() for t in c["text"].to_pylist()],
        }

    got = sorted(
        map_rows(
            picked,
            rows,
            "doc_id long, draw long, mark int, index binary",
        ).toLocalIterator(), key=lambda r: (r["draw"], r["doc_id"], r["index"])
    )
    if not got:
        return None
    toxic_rows = np.array([r["mark"] for r in got], np.float64)
    if len(set(toxic_rows)) < 2:
        return None
    index = [np.frombuffer(r["index"], np.int32) for r in got]
    flat, row = np.concatenate(index), np.repeat(np.arange(len(got)), list(map(len, index)))
    model = fit_chain(flat, row, toxic_rows, kinds, kept)
    return {k: model[k] for k in ("place", "n", "weights", "names")}


def _features(flat: np.ndarray, row: np.ndarray, marks: np.ndarray, seen: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """The `kept` buckets that go most with the label in the rows `seen`, and which of them are more frequent in toxic ones."""
    n, up = int(seen.sum()), marks[seen].sum()
    own = seen[row]
    total = np.bincount(flat[own], minlength=SIZE).astype(np.float64)
    a = np.bincount(flat[own], weights=marks[row[own]], minlength=SIZE)
    gap = a / up - (total - a) / (n - up)
    best = np.where(total >= 3, gap * gap * n / np.maximum(total * (n - total) / n, 1e-9), 0)
    chosen = np.sort(np.argsort(-best, kind="stable")[:kept])
    return chosen, gap[chosen] > 0


def _held(flat: np.ndarray, row: np.ndarray, chosen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the chosen buckets each row holds; and the place of every bucket among them (-1: none)."""
    place = np.full(SIZE, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    x, at = np.zeros((n, len(chosen))), place[flat]
    x[row[at >= 0], at[at >= 0]] = 1
    return x, place


def _kinds(x: np.ndarray, telling: np.ndarray, marks: np.ndarray, seen: np.ndarray, kinds: int) -> np.ndarray:
    """A column for each kind: the toxic rows `seen`, clustered by the telling features."""
    found = np.flatnonzero(seen & (marks > 0))
    y = np.zeros((len(x), kinds))
    if kinds:
        y[found, kinds_of(x[np.ix_(found, np.flatnonzero(telling))], kinds)] = 1
    return y


def fit_chain(flat: np.ndarray, row: np.ndarray, marks: np.ndarray, kinds: int = KINDS, kept: int = KEPT_FEATURES) -> dict:
    """The chain from rows' distinct buckets (`flat`, of the rows `row`) and their marks (1: toxic).

    Features are chosen and kinds found anew within each fold, from its training rows alone, and a fold's
    kinds take the names of those of all rows that they share most rows with; so an out-of-fold
    probability has seen nothing of its own row. `targets` and `out_of_fold` tell them row by row.
    """
    n = len(marks)
    whole = np.ones(n, bool)
    chosen, telling = _features(flat, row, marks, whole, kept)
    x, place = _held(flat, row, chosen, n)
    y = np.column_stack([_kinds(x, telling, marks, whole, kinds), marks])
    fold, parts = np.arange(n) % FOLDS, []
    for f in range(FOLDS):
        seen = fold != f
        own, tells = _features(flat, row, marks, seen, kept)
        xf = _held(flat, row, own, n)[0]
        yf = _kinds(xf, tells, marks, seen, kinds)
        alike, names = y[seen, :kinds].T @ yf[seen], np.zeros(kinds, np.int64)
        for _ in range(kinds):  # the pair that shares most rows first
            k, j = np.unravel_index(int(alike.argmax()), alike.shape)
            names[k], alike[k], alike[:, j] = j, -1, -1
        parts.append((seen, xf, np.column_stack([yf[:, names], marks])))
    before, weights = np.zeros((n, 0)), []
    for k in range(kinds + 1):
        out = np.zeros(n)
        for seen, xf, yf in parts:
            z = np.hstack([xf, before])
            w = linear.fit_dense(z[seen], yf[seen, k])
            out[~seen] = linear.sigmoid(z[~seen] @ w[:-1] + w[-1])
        weights.append(linear.fit_dense(np.hstack([x, before]), y[:, k]))
        before = np.column_stack([before, out])
    names = [*(f"kind_{k}" for k in range(kinds)), "toxic"]
    return {"place": place.astype(np.int32), "n": len(chosen), "weights": weights, "names": names, "targets": y, "out_of_fold": before}


def probabilities(model: dict, texts: list[str | None]) -> np.ndarray:
    """The chain's probabilities, a row for each text."""
    x = np.zeros((len(texts), model["n"] + len(model["weights"])))
    for i, text in enumerate(texts):
        at = model["place"][hashed(text)]
        x[i, at[at >= 0]] = 1
    for k, w in enumerate(model["weights"]):
        x[:, model["n"] + k] = linear.sigmoid(x[:, : model["n"] + k] @ w[:-1] + w[-1])
    return x[:, model["n"] :]


def toxic(model: dict | None, texts: list[str | None], toxic_from: float = TOXIC_FROM) -> list[bool]:
    if model is None:
        return [False] * len(texts)
    return [bool(t) and p >= toxic_from for t, p in zip(texts, probabilities(model, texts)[:, -1].tolist(), strict=True)]


def keep(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of `docs` that are not toxic, as they are. Null and empty texts stay; repeated rows share a fate; an empty table stays empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, lambda texts: [not x for x in toxic(sent.value, texts)])


def score(docs: DataFrame, model: dict | None, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """(doc_id, p_<category>..., toxic) per row of `docs`.

    A null or empty text holds no feature, so it gets the chain's intercepts; it is never toxic. Repeated
    rows are each scored; an empty table gives no rows; extra columns are not read.
    Without a model (a class is absent from the labels) probabilities are null and nothing is toxic.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"p_{n}" for n in (model["names"] if model else [*(f"kind_{k}" for k in range(KINDS)), "toxic"])]

    def rows(c):
        m, texts = sent.value, c["text"].to_pylist()
        found = probabilities(m, texts).T.tolist() if m else [[None] * len(texts)] * len(names)
        bad = [bool(t) and p is not None and p >= toxic_from for t, p in zip(texts, found[-1], strict=True)]
        return {"doc_id": c["doc_id"], **dict(zip(names, found, strict=True)), "toxic": bad}

    return map_rows(texts_of(docs), rows, "doc_id long, " + ", ".join(f"{k} double" for k in names) + ", toxic boolean")
