"""Exact byte-level BPE by backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives the longest token at every byte of a
pre-token in one pass. The encoder takes the longest token that is compatible with its left
neighbour - a pair is compatible if merging by rank would leave the boundary between them
alone - falls back to the token's next shorter prefix, and steps back where nothing fits.
Each byte position is entered at most once, so the work is linear, and the result is what
rank-ordered merging gives.

Pieces between blanks repeat, so each worker keeps a bounded cache from piece to ids.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from strandflow.llm.common import CACHE_ENTRIES, map_rows, texts_of

#: Pre-token pattern of the byte-level vocabulary (fixed value).
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_SPACE = regex.compile(r"\s")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in a byte-level vocabulary file -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Longest piece that is remembered, so that the caches are bounded in bytes.
REMEMBERED = 64
#: Distance of a word-final byte's letter from that byte's own.
WORD_END = 0x200


def word_end(word: str) -> str:
    return word[:-1] + chr(ord(word[-1]) + WORD_END)


class Generations(dict):
    """A bounded cache: when it is full it becomes the old generation, out of which what is used again is taken over."""

    old: dict = {}

    def find(self, key):
        value = self.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self[key] = value
        return value

    def age(self) -> None:
        if len(self) > CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()


class Encoder(dict):
    """The tables of one vocabulary; as a dict, a cache from text pieces to little-endian ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, suffix = byte_alphabet(), spec["model"].get("end_of_word_suffix") or ""

        def plain(token: str) -> str:
            """The token's bytes as latin-1 text; the last byte of a word is another letter where the vocabulary marks word ends."""
            ends = bool(suffix) and token.endswith(suffix)
            text = bytes(alphabet[c] for c in (token[: -len(suffix)] if ends else token)).decode("latin-1")
            return word_end(text) if ends else text

        ids = {plain(t): i for t, i in spec["model"]["vocab"].items()}
        size = 1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = ids
        self.length = [0] * size
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(size)]
        self.shorter = [-1] * size
        self.merged: dict[tuple[int, int], int] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        for merge in spec["model"]["merges"]:
            a, b = (ids[plain(t)] for t in (merge if isinstance(merge, list) else merge.split(" ")))
            self.merged[a, b] = 0
        texts = {i: t for t, i in ids.items()}
        for a, b in self.merged:
            whole = ids[texts[a] + texts[b]]
            self.merged[a, b] = whole
            self.parts[whole] = (a, b)
        self.automaton = ahocorasick.Automaton()
        for t, i in ids.items():
            self.length[i] = len(t)
            self.automaton.add_word(t, i)
            self.shorter[i] = next((ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ids), -1)
        self.automaton.make_automaton()
        blob = [b""] * size
        for t, i in ids.items():
            blob[i] = bytes(ord(c) % WORD_END for c in t)
        for t, i in self.special.items():
            blob[i] = t.encode()
        self.lengths = np.array([len(b) for b in blob], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(blob), np.uint8)
        self.cut_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pre_tokens = Generations()

    def fits(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps the boundary between these two neighbouring tokens."""
        if len(self.compatible) > CACHE_ENTRIES:
            self.compatible.clear()
        good = self.compatible[left, right] = self._fits(left, right)
        return good

    def _fits(self, left: int, right: int) -> bool:
        # Undo the later of the two tokens' last merges again and again; a merge across the
        # boundary that ranks before the one just undone would have happened first.
        merged, parts, limit = self.merged, self.parts, 1 << 62
        while True:
            across = merged.get((left, right))
            if across is not None and across < limit:
                return False
            can_left, can_right = parts[left][1] != left, parts[right][0] != right
            if not (can_left or can_right):
                return True
            if can_left and (left > right or not can_right):
                limit, left = left, parts[left][1]
            else:
                limit, right = right + 1, parts[right][0]

    def encode_pre_token(self, word: str) -> list[int]:
        """Ids of one pre-token, given as latin-1 text of its bytes."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        n, length, shorter, known, fits = len(word), self.length, self.shorter, self.compatible, self.fits
        longest = [-1] * n
        for end, token in self.automaton.iter(word):
            longest[end - length[token] + 1] = token  # matches end later and later, so the longest stays
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while at < n:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + length[token]
                if not dead[end]:
                    if last < 0:
                        break
                    good = known.get((last, token))
                    if good or good is None and fits(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
            else:
                dead[at] = 1
                token = shorter[out.pop()] if out else -1
                if last < 0:
                    raise ValueError("the vocabulary lacks a byte")
                at -= length[last]
        return out

    def __missing__(self, unit: str) -> bytes | None:
        """Ids of a piece that follows a blank, or that starts with a line feed; None if its blanks need the whole text."""
        line = unit[:1] == "\n"
        word = unit[1:] if line else unit
        value = None
        if word.split() == [word]:
            lead = "" if line else " "
            if word.isalpha():
                value = self.pre_token(lead + word)
            elif word[-1] in ".,;:!?|" and word[:-1].isalpha():
                value = self.pre_token(lead + word[:-1]) + self.pre_token(word[-1])
            else:
                value = self.pieces(lead + word)
            if line:
                value = self.pre_token("\n") + value
        if len(unit) <= REMEMBERED:
            self[unit] = value
        return value

    def pre_token(self, word: str) -> bytes:
        """Ids of one pre-token."""
        value = self.pre_tokens.find(word)
        if value is None:
            value = array("I", self.encode_pre_token(word.encode().decode("latin-1"))).tobytes()
            if len(word) <= REMEMBERED:
                self.pre_tokens[word] = value
        return value

    def pieces(self, text: str) -> bytes:
        """Ids of a text without special tokens, pre-token by pre-token."""
        return b"".join(map(self.pre_token, PRE_TOKEN.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if len(self) > CACHE_ENTRIES // 2:
            self.clear()
        self.pre_tokens.age()
        if self.cut_special is None:
            return self.between(text)
        out, at = [], 0
        for found in self.cut_special.finditer(text):
            out += (self.between(text[at : found.start()]), np.array([self.special[found[0]]], "<u4").tobytes())
            at = found.end()
        return b"".join([*out, self.between(text[at:])])

    def between(self, text: str) -> bytes:
        """Ids of a text without special tokens, from the cache where its blanks allow."""
        units = text.replace("\n", " \n").split(" ")
        first = units[0]
        if not _SPACE.search(first) and (first or len(units) == 1 or units[1][:1] == "\n"):
            units[0] = None
            known = list(map(self.__getitem__, units[1:]))
            if None not in known:
                return b"".join([self.pieces(first), *known])
        return self.pieces(text)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids: one gather from the table of all tokens' bytes."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        return self.blob[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.offsets[ids] - (ends - n), n)].tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The tables of a vocabulary, built once per worker."""
    return Encoder(path)


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) -> (doc_id, ids array<int>). A null or empty text has no ids; repeated rows are each encoded."""

    def rows(c):
        e = encoder(vocabulary)
        return {"doc_id": c["doc_id"], "ids": [np.frombuffer(e.encode(t or ""), "<i4") for t in c["text"].to_pylist()]}

    return map_rows(texts_of(docs), rows, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text). Null ids give an empty text; broken UTF-8 becomes U+FFFD."""

    def rows(c):
        e = encoder(vocabulary)
        return {
            "doc_id": c["doc_id"],
            "text": [e.decode(np.array(i or [], np.int64)).decode("utf-8", "replace") for i in c["ids"].to_pylist()],
        }

    return map_rows(tokens.select("doc_id", "ids"), rows, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode and decode each text in one pass: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    A null text counts as empty. Ids never leave the worker, so the output is four short columns.
    Repeated rows are each encoded; an empty table gives no rows; extra columns are not read.
    """

    def rows(c):
        e = encoder(vocabulary)
        n, ids_sha, text_sha = [], [], []
        for t in c["text"].to_pylist():
            ids = e.encode(t or "")
            n.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            back = e.decode(np.frombuffer(ids, "<u4"))
            text_sha.append(hashlib.sha256(back.decode("utf-8", "replace").encode()).hexdigest())
        return {"doc_id": c["doc_id"], "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    return map_rows(texts_of(docs), rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
