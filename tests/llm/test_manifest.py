"""Merkle trees and best-fit packing against plain restatements."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strandflow.llm import best_fit, merkle
from strandflow.llm.queries import vocabulary

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    out = ""
    for v in row:
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def plain_tree(nodes, fanout):
    """(root, path of (left, right) for each node)."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, own = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for k in range(len(run)):
                for i in owners[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha(*run))
            own.append([i for o in owners[at : at + fanout] for i in o])
        nodes, owners = up, own
    return nodes[0], paths


def plain_manifest(docs, fanout):
    groups = {}
    for row in docs:
        doc_id, source, lang, n_chars, text = row
        groups.setdefault((lang is not None, (lang or "").encode()), []).append(row)
    subroots, inner = [], []
    for key in sorted(groups):
        rows = sorted(groups[key], key=lambda r: ((r[0] is not None), r[0] or 0, plain_leaf(r)))
        root, paths = plain_tree([plain_leaf(r) for r in rows], fanout)
        subroots.append(root)
        inner.append(list(zip(rows, paths, strict=True)))
    root, tops = plain_tree(subroots, fanout)
    out = []
    for number, rows in enumerate(inner):
        for row, path in rows:
            whole = path + tops[number]
            doc_id, source, lang, n_chars, text = row
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            folded = plain_leaf((doc_id, source, lang, n_chars + 1 if tampered and n_chars is not None else n_chars, text))
            for left, right in whole:
                folded = sha(left, folded, right)
            proof = sha(*(left + right for left, right in whole))
            out.append((doc_id, plain_leaf(row), subroots[number], root, proof, folded, folded == root))
    return sorted(out, key=str)


def manifest(df, fanout):
    altered = merkle.leaf(*((F.col(c) + 1 if c == "n_chars" else F.col(c)) for c in merkle.FIELDS))
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    found = merkle.manifest(df, F.when(chosen, altered), fanout).withColumn("proof", merkle.proof_digest(F.col("path")))
    return sorted((tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("fanout", [2, 3])
def test_trees_of_all_sizes(spark, fanout):
    rng = random.Random(fanout)
    docs = [(None, None, None, None, None), (None, "s", None, 4, "x"), (None, "s", None, 4, "x")]
    for lang, n in (("de", 1), ("é", 2), ("a", 33), ("zz", 70), ("", 5), (None, 9)):
        docs += [(rng.randint(0, 10**6), "s", lang, None if rng.random() < 0.2 else rng.randint(0, 99), "ü" * rng.randint(0, 5)) for _ in range(n)]
    docs += [docs[-1], (5, "t", "a", 1, "x" * 200_000), (5, "t", "a", 2, ""), (0, "t", "a", 3, None)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(1) for c in ("g", "place", "leaf", "path", "part", "own_0", "grp", "hash")})
    got, want = manifest(df.repartition(5), fanout), plain_manifest(docs, fanout)
    assert got == want
    assert sum(not r[-1] for r in got) > 5


def test_a_tree_of_several_rounds(spark):
    docs = [(i, "s", "en", i, "t") for i in range(2500)] + [(i, "s", f"l{i:02d}", i, "t") for i in range(40)]
    assert manifest(spark.createDataFrame(docs, DOCS), 2) == plain_manifest(docs, 2)


def test_empty_manifest(spark):
    assert manifest(spark.createDataFrame([], DOCS), 2) == []
    one = [(3, None, None, None, None)]
    assert manifest(spark.createDataFrame(one, DOCS), 2) == plain_manifest(one, 2)


def packs_of(patterns):
    return sum(n for _, n in patterns)


def test_exact_complements_are_found():
    # one, two and three lengths that fill the gap; two packs of the same lengths are limited by their counts
    for histogram, packs in (({7: 2, 3: 2}, 2), ({6: 1, 3: 1, 1: 1}, 1), ({5: 1, 2: 2, 1: 1}, 1), ({4: 1, 2: 3}, 1), ({4: 2, 2: 6}, 2), ({5: 4}, 2)):
        assert packs_of(best_fit.plan(histogram, 10)) == packs, histogram
    assert best_fit.plan({1: 25}, 10) == [(((1, 10),), 2), (((1, 5),), 1)] or packs_of(best_fit.plan({1: 25}, 10)) == 3
    assert best_fit.plan({}, 10) == [] and packs_of(best_fit.plan({10: 3}, 10)) == 3


def test_plans_hold_every_piece_and_are_near_the_bound():
    rng = random.Random(3)
    for low, high in ((1, 64), (1, 9), (20, 64), (33, 64), (5, 40)):
        histogram = {}
        for _ in range(3000):
            length = rng.randint(low, high)
            histogram[length] = histogram.get(length, 0) + 1
        patterns, seen = best_fit.plan(histogram, 64), {}
        for runs, n in patterns:
            assert sum(length * times for length, times in runs) <= 64 and len(dict(runs)) == len(runs)
            for length, times in runs:
                seen[length] = seen.get(length, 0) + times * n
        assert seen == histogram
        halves = sum(n for length, n in histogram.items() if length > 32)
        bound = max(-(-sum(length * n for length, n in histogram.items()) // 64), halves)
        assert packs_of(patterns) <= 1.03 * bound, (low, high)
    big = best_fit.plan({length: 10**9 + length for length in range(1, 2049)}, 2048)
    assert len(big) < 3 * 2048 and max(len(runs) for runs, _ in big) <= 64


def test_pieces_are_packed_without_gaps(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary("word_bpe_49k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(5)
    texts = [None, "", " ", "a" * 300, "word " * 9000, "same text", "same text"]
    texts += [" ".join(rng.choice(["alpha", "beta,", "naïve", "中文", "x1", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    df = spark.createDataFrame([(i if i % 50 else None, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, piece int, rank int")
    width = 64
    rows = best_fit.pack(df.repartition(3), path, 0, width).collect()
    by_sequence, lengths, docs = {}, {}, {}
    for r in rows:
        assert r["start"] == r["piece"] * width and r["length"] <= width
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if r["doc_id"] is not None:
            docs.setdefault(r["doc_id"], []).append((r["piece"], r["length"], r["ids_crc32"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= width
    for i, text in enumerate(texts):
        if i % 50:
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
            want = [ids[k : k + width] for k in range(0, len(ids), width)]
            assert [x[1:] for x in sorted(docs[i])] == [(len(w), zlib.crc32(b"".join(v.to_bytes(4, "little") for v in w))) for w in want]
    lengths = sum(r["length"] for r in rows)
    assert len(by_sequence) <= 1.02 * -(-lengths // width) + 1
    assert best_fit.pack(df.limit(0), path).count() == 0
