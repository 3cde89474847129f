"""Token counts of fields and sections from one encoding of the whole document.

Tokenizing sections apart gives other tokens than the model sees. Here the whole text is encoded
once; the tokens' byte spans and the sections' byte spans, both in order, are merged by binary
search, and each token is counted in exactly one section.

Rule for a token that lies in several sections (`rule`):
- "first": the section of its first byte;
- "longest": the section that holds most of its bytes, the earlier one on a tie.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from strandflow.llm.bpe import encoder
from strandflow.llm.common import map_rows

COLUMNS = "doc_id long, section int, field string, start_char long, n_chars long, n_tokens long, n_crossing long"


def owners(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For spans that tile the same bytes: the section of each token, and which tokens cross a boundary."""
    starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends - 1, "right")
    crossing = first != last
    if rule == "longest":
        first = first.copy()
        for k in np.flatnonzero(crossing):
            span = np.arange(first[k], last[k] + 1)
            begin = np.maximum(np.concatenate([[0], section_ends])[span], starts[k])
            first[k] = span[np.argmax(np.minimum(section_ends[span], token_ends[k]) - begin)]
    return first, crossing


def attribute(
    docs: DataFrame,
    vocabulary: str,
    fields: tuple[str, ...] = ("text",),
    boundary: str = r"\n",
    rule: str = "longest",
) -> DataFrame:
    r"""One row per section of each document: its place, its characters and the tokens counted in it.

    The document is its `fields` in order, one after the other; a section ends behind each match
    of the regular expression `boundary`, and at each field's end. Null or empty fields have no
    section; a document without any text has one section of 0 tokens, so no document is lost.
    n_crossing counts the section's own tokens that also reach into other sections. Repeated rows
    each give their sections; an empty table gives no rows; columns that are not among `fields` are not read.
    """
    if rule not in ("first", "longest"):
        raise ValueError(f"unknown rule: {rule}")

    def rows(c):
        e, cut_at = encoder(vocabulary), re.compile(boundary)
        out = {k.split()[0]: [] for k in COLUMNS.split(", ")}
        texts = [c[f"field_{i}"].to_pylist() for i in range(len(fields))]
        for i, doc in enumerate(c["doc_id"].to_pylist()):
            names, ends, at, whole = [], [], 0, []
            for name, values in zip(fields, texts, strict=True):
                if t := values[i]:
                    inner = [m.end() for m in cut_at.finditer(t) if 0 < m.end() < len(t)]
                    inner = [*dict.fromkeys(inner), len(t)]
                    names += [name] * len(inner)
                    ends += [at + x for x in inner]
                    at += len(t)
                    whole.append(t)
            if not ends:
                names, ends = [fields[0]], [0]
            text = "".join(whole)
            raw = text.encode()
            ids = np.frombuffer(e.encode(text), "<u4")
            ends = np.array(ends, np.int64)
            starts_char = np.concatenate([[0], ends[:-1]])
            if len(raw) != len(text):  # characters to bytes
                first = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
                byte_ends = np.append(first, len(raw))[ends]
            else:
                byte_ends = ends
            owner, crossing = owners(np.cumsum(e.lengths[ids]), byte_ends, rule) if len(ids) else (np.zeros(0, np.int64), np.zeros(0, bool))
            n = len(ends)
            out["doc_id"] += [doc] * n
            out["section"] += range(n)
            out["field"] += names
            out["start_char"].append(starts_char)
            out["n_chars"].append(ends - starts_char)
            out["n_tokens"].append(np.bincount(owner, minlength=n))
            out["n_crossing"].append(np.bincount(owner[crossing], minlength=n))
        return {k: np.concatenate(v) if k in ("start_char", "n_chars", "n_tokens", "n_crossing") else v for k, v in out.items()}

    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.col(f).cast("string").alias(f"field_{i}") for i, f in enumerate(fields)),
    )
    return map_rows(picked, rows, COLUMNS)
