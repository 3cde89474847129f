r"""Quality rules: fixed base measures, then a calibrated hashed n-gram classifier.

Each text is one pass in an Arrow task: its words, symbols, repeated lines and repeated word
windows, and the margin of a logistic regression over hashed word 1- and 2-grams and character 2-, 3-
and 4-grams. Within a family the feature value is the n-gram's share, so the margin is a mean of
weights and long texts weigh as much as short ones. The model is fitted on a bounded sample of
labelled rows, its probability calibrated on the part of the sample it was not fitted on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from strandflow.llm import linear
from strandflow.llm.common import cover, filter_rows, map_rows, shingles, split_words, texts_of, word_hashes

#: Characters counted as symbols (fixed value).
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
BITS = 16
SIZE = 1 << BITS
FAMILIES = 5
#: Labelled rows per class that the model is fitted on, and the probability of good below which a text is rejected.
PER_CLASS = 1000
KEEP_FROM = 0.3
#: Features of all rows fitted on, at most (8 bytes each on the driver); the sample ends with the row that reaches it.
MAX_FEATURES = 20_000_000
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8


def base_measures(text: str | None, raw: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    if not words:
        return 0, 0, len(raw) - len(raw.translate(None, SYMBOLS)), 0, 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    repeats = 0
    windows = shingles(hashes, WINDOW)
    if len(windows) > 1:
        order = np.argsort(windows, kind="stable")
        same = np.flatnonzero(windows[order[1:]] == windows[order[:-1]])
        if len(same):
            repeats = int(cover(np.union1d(order[same], order[same + 1]), WINDOW, len(words)).sum())
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, BLANKS))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
    )


def features(text: str | None, hashes: np.ndarray) -> list[np.ndarray]:
    """Bucket of each n-gram, family by family."""
    c = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    out = [(hashes & np.uint64(SIZE - 1)).astype(np.int64), (shingles(hashes, 2) & np.uint64(SIZE - 1)).astype(np.int64)]
    key = c
    for n in (2, 3, 4):
        key = key[:-1] * np.uint32(0x01000193) ^ c[n - 1 :] if len(c) >= n else c[:0]
        out.append((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    return out


def margin(weights: np.ndarray, bias: float, families: list[np.ndarray]) -> float:
    return bias + sum(float(weights[k][f].mean(dtype=np.float64)) for k, f in enumerate(families) if len(f))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict | None:
    """The model from at most `per_class` good and bad labelled texts and MAX_FEATURES features; None if a class is absent.

    A document with several labels counts as bad if any of them says so; null labels say nothing.
    """
    marks = labels.filter("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(F.col("quality").cast("int")).alias("class")
    )
    wanted = linear.sample(marks, "class", per_class).select("doc_id", "class", "draw")
    picked = texts_of(docs).join(F.broadcast(wanted), "doc_id")  # at most 2 * per_class rows

    def rows(c):
        index, value = [], []
        for text in c["text"].to_pylist():
            i, v = [], []
            for k, f in enumerate(features(text, word_hashes(split_words(text)))):
                u, n = np.unique(f, return_counts=True)
                i.append((u + k * SIZE).astype(np.int32))
                v.append((n / max(1, len(f))).astype(np.float32))
            index.append(np.concatenate(i).tobytes())
            value.append(np.concatenate(v).tobytes())
        return {"class": c["class"], "draw": c["draw"], "doc_id": c["doc_id"], "index": index, "value": value}

    got, size = [], 0
    for r in map_rows(
        picked,
        rows,
        "class int, draw long, doc_id long, index binary, value binary",
    ).orderBy("draw", "doc_id", "index").toLocalIterator():
        got.append(r)
        size += len(r["index"]) // 4
        if size >= MAX_FEATURES:
            break
    y = np.array([r["class"] for r in got], np.float64)
    if len(set(y)) < 2:
        return None
    index, value = ([np.frombuffer(r[k], t) for r in got] for k, t in (("index", np.int32), ("value", np.float32)))
    held = np.arange(len(got)) % 4 == 0

    def stacked(which: np.ndarray):
        rows_in = np.flatnonzero(which)
        return np.concatenate([index[i] for i in rows_in]), np.concatenate([value[i] for i in rows_in]), np.repeat(
            np.arange(len(rows_in)),
            [len(index[i]) for i in rows_in],
        )

    i, v, r = stacked(~held)
    w, bias = linear.fit_sparse(i, v, r, y[~held], FAMILIES * SIZE)
    i, v, r = stacked(held)
    z = np.bincount(r, weights=w[i] * v, minlength=int(held.sum())) + bias
    slope, shift = linear.platt(z, y[held]) if len(set(y[held])) == 2 else (1.0, 0.0)
    return {"weights": w.reshape(FAMILIES, SIZE).astype(np.float32), "bias": bias, "slope": slope, "shift": shift}


def judge(model: dict | None, text: str | None, keep_from: float = KEEP_FROM) -> tuple:
    """The base measures, base_failed, p_good and kept of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    hashes = word_hashes(words)
    base = base_measures(text, raw, words, hashes)
    failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEAT_PERCENT * base[0]
    p = None
    if model is not None:
        p = float(
            linear.sigmoid(np.float64(model["slope"] * margin(model["weights"], model["bias"], features(text, hashes)) + model["shift"]))
        )
    return *base, failed, p, not failed and (p is None or p >= keep_from)


def keep(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of `docs` that pass the base rules and the classifier, as they are. Null and empty texts fail; repeated rows share a fate; an empty table stays empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, lambda texts: [judge(sent.value, t)[-1] for t in texts])


def score(docs: DataFrame, model: dict | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row of `docs`: the base measures, base_failed, the probability of good quality, and kept.

    A null or empty text has no words and fails the base rules. Without a model (no labels) the
    base rules alone decide, and p_good is null. Repeated rows are judged one by one; an empty table gives
    no rows; extra columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def rows(c):
        out = {k: [] for k in [*names, "base_failed", "p_good", "kept"]}
        for text in c["text"].to_pylist():
            for k, x in zip(out, judge(sent.value, text, keep_from), strict=True):
                out[k].append(x)
        return {"doc_id": c["doc_id"], **out}

    return map_rows(
        texts_of(docs),
        rows,
        "doc_id long, " + ", ".join(f"{k} long" for k in names) + ", base_failed boolean, p_good double, kept boolean",
    )
