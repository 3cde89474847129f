"""Encoding, packing and attribution against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from strandflow.llm import bpe, packing, token_counts
from strandflow.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
ODD = [
    None,
    "",
    " ",
    "\n\n",
    "a  b\n c",
    "<|endoftext|>",
    "x<|endoftext|> y",
    "naïve é 中文 😀",
    "\t tab\r\n",
    "it's I'LL",
    "a" * 5000,
    "the " * 3000,
    "０１",
    "é İstanbul Σσς",
]


def made(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    alphabet = [*" \n\taAbcdeth'sd.,!?0123éß中😀#<|>", "the", " ing", "<|endoftext|>", "  ", "\n\n", "'ll", "\x85", " "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")


def test_byte_bpe_equals_the_library(spark):
    texts = ODD + made(1500, 1)
    t = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in bpe.round_trip(table(spark, texts), vocabulary("byte_bpe_50k.json")).collect()}
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), text
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest(), text
    some = table(spark, texts[:40])
    back = bpe.decode(bpe.encode(some, vocabulary("byte_bpe_50k.json")), vocabulary("byte_bpe_50k.json"))
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in enumerate(texts[:40])}


def test_thousands_of_special_tokens_in_a_text(spark):
    text = "".join(f"word {i}<|endoftext|>" + "\n" * (i % 3) for i in range(5000))
    path = vocabulary("byte_bpe_50k.json")
    want = tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    (got,) = bpe.round_trip(table(spark, [text]), path).collect()
    assert got["n_tokens"] == len(want) and got["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
    assert got["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert token_counts.attribute(table(spark, [text]), path).agg({"n_tokens": "sum"}).first()[0] == len(want)


def test_packing_keeps_every_id_once(spark):
    texts = ODD + made(300, 2) + ["word other " * 2500] * 3
    t = tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    rows = packing.pack(table(spark, texts), vocabulary("word_bpe_49k.json")).toPandas()
    assert rows.groupby("doc_id").length.sum().to_dict() == rows.groupby("doc_id").doc_tokens.first().to_dict()
    assert set(rows.doc_id) == set(range(len(texts)))
    for r in rows.itertuples():
        ids = [*t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    rows = rows.sort_values(["sequence_id", "offset"])
    ends = rows.groupby("sequence_id").length.cumsum()
    assert (ends - rows.length == rows.offset).all() and ends.max() <= 2048
    assert len(rows[["sequence_id", "offset"]].drop_duplicates()) == len(rows)
    assert packing.pack(table(spark, []), vocabulary("word_bpe_49k.json")).count() == 0


def test_plan_places_every_length():
    rng = random.Random(3)
    for _ in range(50):
        histogram = {rng.randint(1, 64): rng.randint(1, 9) for _ in range(20)}
        patterns = packing.plan(histogram, 64)
        assert all(sum(p) <= 64 for p, _ in patterns)
        assert {k: sum(n * p.count(k) for p, n in patterns) for k in histogram} == histogram
    assert packing.plan({}, 64) == []


def test_ranks_of_one_frequent_length(spark):
    docs = spark.range(100_000).selectExpr("id as doc_id", "'the cat' as text").repartition(8)
    rows = packing.pack(docs, vocabulary("word_bpe_49k.json")).select("doc_id", "length", "sequence_id", "offset").toPandas()
    assert set(rows.length) == {3} and len(rows) == 100_000 == rows.doc_id.nunique() == len(
        rows[["sequence_id", "offset"]].drop_duplicates()
    )
    assert rows.offset.max() <= 2045 and rows.sequence_id.nunique() == -(-100_000 // 682)


def test_encoding_of_words_equals_the_library():
    path = vocabulary("word_bpe_49k.json")
    t = tokenizers.Tokenizer.from_file(path)
    texts = [
        *made(3000, 9),
        *(x or "" for x in ODD),
        *(f"w{chr(c)}x {chr(c)}Y{chr(c)}, {chr(c)}." for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000),
    ]
    for text, ids in zip(texts, packing.encode_texts(texts, path), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("rule", ["first", "longest"])
def test_attribution_by_bytes_over_fields(spark, rule):
    path = vocabulary("byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    texts = [x for x in ODD + made(200, 12)]
    docs = spark.createDataFrame([(i, x, texts[-1 - i]) for i, x in enumerate(texts)], "doc_id long, text string, body string")
    rows = token_counts.attribute(docs, path, ("text", "body"), rule=rule).toPandas()
    for i, x in enumerate(texts):
        whole = (x or "") + (texts[-1 - i] or "")
        own = rows[rows.doc_id == i].sort_values("section")
        ends = [len(whole[: s + n].encode()) for s, n in zip(own.start_char, own.n_chars, strict=True)]
        count, crossing, at = [0] * len(ends), [0] * len(ends), 0
        for token in t.encode(whole, add_special_tokens=False).ids:
            size = len(bpe.encoder(path).decode(np.array([token])))
            held = [max(0, min(at + size, e) - max(at, b)) for b, e in zip([0, *ends], ends, strict=False)]
            owner = next(k for k, h in enumerate(held) if h) if rule == "first" else int(np.argmax(held))
            count[owner] += 1
            crossing[owner] += sum(h > 0 for h in held) > 1
            at += size
        assert own.n_tokens.tolist() == count and own.n_crossing.tolist() == crossing, repr(whole)


def test_attribution_counts_every_token_once(spark):
    texts = ODD + made(300, 4)
    path = vocabulary("byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    rows = token_counts.attribute(table(spark, texts), path, rule="first").toPandas()
    for i, text in enumerate(texts):
        own = rows[rows.doc_id == i].sort_values("section")
        spans = t.encode(text or "", add_special_tokens=False).offsets
        want = [sum(a <= s < a + n for s, _ in spans) for a, n in zip(own.start_char, own.n_chars, strict=True)]
        assert own.n_tokens.sum() == len(spans) and own.n_chars.sum() == len(text or "")
        if text and text.isascii():
            assert list(own.n_tokens) == want, text


def test_rule_for_boundary_crossing_tokens():
    token_ends, section_ends = np.array([2, 7, 9]), np.array([3, 9])
    assert token_counts.owners(token_ends, section_ends, "first")[0].tolist() == [0, 0, 1]
    assert token_counts.owners(token_ends, section_ends, "longest")[0].tolist() == [0, 1, 1]
    assert token_counts.owners(np.array([4, 6]), np.array([2, 6]), "longest")[0].tolist() == [0, 1]  # a tie: the earlier
    assert token_counts.owners(token_ends, section_ends, "first")[1].tolist() == [False, True, False]
