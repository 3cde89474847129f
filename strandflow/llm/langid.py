"""Language identification by string kernels.

Texts are compared by which character 1-, 2- and 3-grams they hold (presence, blended spectrum,
hashed to a fixed width), normalized by both texts' sizes. Kernel values against a fixed number
of landmark texts (Nystroem) stand for a text; one-versus-rest kernel ridge regression on them is
solved once on a bounded sample. Scoring multiplies a block of presence rows by the landmark
matrix and by the ridge weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strandflow.llm import linear
from strandflow.llm.common import cut, map_rows, texts_of

BITS = 12
WIDTH = 1 << BITS
#: Learned rows per language, landmarks per language and about in all (never below LEAST of a language), and the ridge.
PER_LANGUAGE = 400
LANDMARKS, ALL_LANDMARKS, LEAST = 40, 2560, 4
RIDGE = 0.01
_LETTER = regex.compile(r"\p{L}")


def presence(text: str | None, out: np.ndarray) -> None:
    """Set out[h] for the hashes of the text's 1-, 2- and 3-grams."""
    if not text:
        return
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    key = c.copy()
    for n in (1, 2, 3):
        if n > 1:
            if len(c) < n:
                return
            key = key[:-1] * np.uint32(0x01000193) ^ c[n - 1 :]
        out[((key + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)] = 1


def normalized(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> dict | None:
    """The model from at most `per_language` texts of each language among the rows where `learn` holds; None if there are none.

    Every language is learned; the model grows with their number. Null or empty texts and null
    languages teach nothing.
    """
    rows_in = texts_of(docs, "lang").filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != ""))
    picked = linear.sample(rows_in, "lang", per_language).select("doc_id", "text", "lang", "draw")

    def rows(c):
        out = []
        for text in c["text"].to_pylist():
            x = np.zeros(WIDTH, np.uint8)
            presence(text, x)
            out.append(np.packbits(x).tobytes())
        return {"lang": c["lang"], "draw": c["draw"], "doc_id": c["doc_id"], "bits": out}

    held = cut(map_rows(picked, rows, "lang string, draw long, doc_id long, bits binary"), "sample")
    counts = {r["lang"]: r["count"] for r in held.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return None
    names = sorted(counts)
    each = max(LEAST, min(LANDMARKS, ALL_LANDMARKS // len(names)))
    place = F.row_number().over(W.partitionBy("lang").orderBy("draw", "doc_id", "bits"))  # at most per_language rows each
    marks = held.withColumn("place", place).filter(F.col("place") <= each).select("lang", "place", "bits").collect()
    landmarks = unpacked([r["bits"] for r in sorted(marks, key=lambda r: (r["lang"], r["place"]))])
    parts = 1 + sum(counts.values()) // 5000
    left, right = _solved_sums(held.select("lang", "bits").repartition(parts), names, counts, landmarks)
    left += RIDGE * (landmarks @ landmarks.T).astype(np.float64) / len(names) + 1e-6 * np.eye(len(landmarks))
    return {"names": names, "weights": (landmarks.T.astype(np.float64), np.linalg.solve(left, right))}


def unpacked(bits: list[bytes]) -> np.ndarray:
    """Normalized presence rows of packed bits."""
    return normalized(np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1).astype(np.float32))


def _solved_sums(held: DataFrame, names: list[str], counts: dict[str, int], landmarks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """K' B K and K' B Y of all learned rows: K their kernel values with the landmarks, B one over their language's rows, Y +1 or -1 for each language.

    Tasks add up their own rows; only a row of sums for each landmark reaches the driver.
    """
    sent = held.sparkSession.sparkContext.broadcast((landmarks, {n: (k, 1.0 / counts[n]) for k, n in enumerate(names)}))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, known = sent.value
        left, right = np.zeros((len(marks), len(marks))), np.zeros((len(marks), len(known)))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                own = [known[n] for n in part.column(0).to_pylist()]
                k = (unpacked(part.column(1).to_pylist()) @ marks.T).astype(np.float64)
                weighted = k * np.array([b for _, b in own])[:, None]
                left += k.T @ weighted
                right -= weighted.sum(0)[:, None]
                np.add.at(right.T, [i for i, _ in own], 2 * weighted)
        rows = [pa.array([x[i].tobytes() for i in range(len(marks))], pa.binary()) for x in (left, right)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(marks)), pa.int32()), *rows], ["mark", "left", "right"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for mark, *own in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                total[mark] = [x + y for x, y in zip(total.get(mark, (0, 0)), map(np.frombuffer, own))]
        if total:
            columns = [pa.array([v[i].tobytes() for v in total.values()], pa.binary()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), *columns], ["mark", "left", "right"])

    schema = "mark int, left binary, right binary"
    rows = held.mapInArrow(products, schema).repartition("mark").mapInArrow(added, schema).orderBy("mark").collect()
    return tuple(np.array([np.frombuffer(r[c]) for r in rows]) for c in ("left", "right"))


def predict(docs: DataFrame, model: dict | None, block: int = 256) -> DataFrame:
    """(doc_id, lang_pred, score) per row. A null text, or one without a letter, is `und` with score 0, as is every text without a model.

    Repeated rows are each predicted; an empty table gives no rows; extra columns are not read.
    """
    if model is not None:
        model = {
            "names": model["names"],
            "landmarks": model["weights"][0].astype(np.float32),
            "ridge": model["weights"][1].astype(np.float32),
        }
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(c):
        m, texts = sent.value, c["text"].to_pylist()
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if m is not None and t and _LETTER.search(t)]
        for k in range(0, len(known), block):
            part = known[k : k + block]
            x = np.zeros((len(part), WIDTH), np.float32)
            for j, i in enumerate(part):
                presence(texts[i], x[j])
            margins = (normalized(x) @ m["landmarks"]) @ m["ridge"]
            best = margins.argmax(1)
            scores[part] = np.clip((margins[np.arange(len(part)), best].astype(np.float64) + 1) / 2, 0, 1)
            for i, b in zip(part, best, strict=True):
                names[i] = m["names"][b]
        return {"doc_id": c["doc_id"], "lang_pred": names, "score": scores}

    return map_rows(texts_of(docs), rows, "doc_id long, lang_pred string, score double")
