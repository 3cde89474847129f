"""Near duplicates and repeated strings against brute force, with odd rows among the texts."""

import hashlib
import random
import re

import numpy as np
import pytest

from strandflow.llm import minhash, recompress, suffix, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", "a", "a b", "x " * 60, "y" * 900, "é " * 300]


def texts(seed):
    rng = random.Random(seed)
    base = [
        " ".join(
            rng.choice(["aa", "bb", "cc", "dd", "ee", "ff"]) + str(rng.randint(0, 9)) for _ in range(rng.randint(20, 90))
        ) for _ in range(12)
    ]
    out = [*ODD, *base, *base[:3]]
    for b in base * 2:
        w = b.split()
        w[rng.randrange(len(w))] = "zz"
        out.append(" ".join(w))
    out += [base[0] + " " + base[1], base[2] + "\n" + base[0]]
    return list(enumerate(out))


def table(spark, rows):
    names = "doc_id long, text string, spans string, start int, count int, row int, __key int"
    return spark.createDataFrame([(i, t, "x", 1, 1, 1, 1) for i, t in rows], names)


def test_near_duplicates(spark):
    rows = texts(1)
    sets = {}
    for i, t in rows:
        w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in WORD.findall(t or "")]
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(table(spark, rows), k=4).collect()}
    assert got == {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_links_with_a_low_estimate_are_kept(spark):
    rows = []
    for seed, t in ((548, 6), (18448, 40)):  # pairs at similarity 0.8 whose registers suggest less than 0.675
        rng = random.Random(seed)
        w = [str(rng.randrange(10**9)) for _ in range(10 * t + 3)]
        pair = [" ".join(w[: 9 * t + 3]), " ".join(w[: 8 * t + 3] + w[9 * t + 3 :])]
        a, b = (minhash.registers(minhash.shingle_set(x, 4)) for x in pair)
        assert (a == b).mean() < 0.674
        rows += pair
    got = minhash.near_duplicates(table(spark, list(enumerate(rows))), k=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {0: 0, 1: 0, 2: 2, 3: 2}


def late_words(rows, width=20):
    """(n_words, n_removed, kept_sha256) by doc_id, window by window."""
    seen, out = {}, {}
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if seen.setdefault(tuple(w[s : s + width]), (i, s)) != (i, s):
                gone[s : s + width] = [True] * width
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest())
    return out


def repeated_bytes(raw, width):
    """Masks of the bytes covered by a string that starts twice, for each text of a list."""
    count: dict = {}
    for b in raw:
        for s in range(len(b) - width + 1):
            count[b[s : s + width]] = count.get(b[s : s + width], 0) + 1
    masks = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - width + 1):
            if count[b[s : s + width]] > 1:
                gone[s : s + width] = True
        masks.append(gone)
    return masks


def left_bytes(b, gone):
    return np.frombuffer(b, np.uint8)[~gone].tobytes()


@pytest.mark.parametrize("hot", [windows.HOT_PLACES, 2])
def test_repeated_words(spark, monkeypatch, hot):
    monkeypatch.setattr(windows, "HOT_PLACES", hot)
    rows = texts(2)
    got = {
        r["doc_id"]: (
            r["n_words"],
            r["n_removed"],
            r["kept_sha256"],
        ) for r in recompress.remove_repeats(table(spark, rows).repartition(3)).collect()
    }
    assert got == late_words(rows) and recompress.remove_repeats(table(spark, [])).count() == 0


@pytest.mark.parametrize("hot, width", [(windows.HOT_PLACES, 100), (2, 100), (2, 250)])
def test_repeated_bytes(spark, monkeypatch, hot, width):
    monkeypatch.setattr(windows, "HOT_PLACES", hot)
    rows = texts(3)
    raw, want = [(t or "").encode() for _, t in rows], {}
    for (i, _), b, gone in zip(rows, raw, repeated_bytes(raw, width), strict=True):
        want[i] = (
            len(b),
            int(gone.sum()),
            int((np.diff(gone.astype(int), prepend=0) == 1).sum()),
            hashlib.sha256(left_bytes(b, gone)).hexdigest(),
        )
    got = {
        r["doc_id"]: (
            r["n_bytes"],
            r["n_removed"],
            r["n_spans"],
            r["kept_sha256"],
        ) for r in suffix.remove_repeats(table(spark, rows).repartition(3), width).collect()
    }
    assert got == want and suffix.remove_repeats(table(spark, []), width).count() == 0


def test_the_registered_width_on_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, docs.collect()))
    raw = [t.encode() for _, t in rows]
    masks = dict(zip([i for i, _ in rows], repeated_bytes(raw, 400), strict=True))
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in suffix.remove_repeats(docs.repartition(5)).collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: int(m.sum()) for i, m in masks.items()} and sum(m.sum() for m in masks.values()) > 0
    assert all(got[i][1] == left_bytes(b, masks[i]) for (i, _), b in zip(rows, raw, strict=True))
    assert {r["doc_id"]: tuple(r)[1:4] for r in recompress.remove_repeats(docs).drop("kept_text").collect()} == late_words(rows)


def test_cut_texts_leaves_other_columns(spark):
    rows = texts(6)
    raw = [(t or "").encode() for _, t in rows]
    masks = repeated_bytes(raw, 250)
    docs = table(spark, rows).drop("__key").withColumn("n_chars", suffix.win.F.length("text"))
    got = {r["doc_id"]: r for r in suffix.cut_texts(docs, 250).collect()}
    for (i, t), b, gone in zip(rows, raw, masks, strict=True):
        want = None if t is None else left_bytes(b, gone).decode("utf-8", "ignore")
        assert got[i]["text"] == want and got[i]["n_chars"] == (None if t is None else len(want)) and (
            got[i]["spans"],
            got[i]["start"],
            got[i]["count"],
        ) == ("x", 1, 1)
    assert suffix.cut_texts(docs, 250).columns == docs.columns and suffix.cut_texts(docs.limit(0), 250).count() == 0


def test_rows_without_an_own_id(spark):
    rng = random.Random(5)
    other = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, clean = other(30), other(120)
    rows = [
        (None, f"{other(40)} {passage} {other(9)} {passage}"),
        (None, clean),
        (None, None),
        (None, "short"),
        (None, passage),
        (None, passage),
        (7, f"{passage} {other(60)}"),
        (7, other(150)),
        (7, "a b"),
        (8, clean),
        (8, clean),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    raw = [(t or "").encode() for _, t in rows]
    want = [(i, t and left_bytes(b, g).decode()) for (i, t), b, g in zip(rows, raw, repeated_bytes(raw, 100), strict=True)]
    by = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(tuple, suffix.cut_texts(docs, 100).collect()), key=by) == sorted(want, key=by)
    kept = suffix.remove_repeats(docs, 100).select("doc_id", "kept").collect()
    assert sorted([(r[0], r[1].decode()) for r in kept], key=by) == sorted([(i, t or "") for i, t in want], key=by)
    got = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in recompress.remove_repeats(docs).collect()]
    # one of the texts without an id holds the passage first, whichever it is; the texts of row 8 are one document, later than that without an id
    assert sorted(got, key=str) == sorted(
        [(None, n, x) for n, x in ((0, 0), (1, 0), (120, 0))] + [r for r in got if r[0] is None and r[1] in (30, 109)] + [
            (7, 90, 30),
            (7, 150, 0),
            (7, 2, 0),
            (8, 120, 120),
            (8, 120, 120),
        ],
        key=str,
    )
    assert sum(r[2] for r in got if r[0] is None) in (30, 60, 90) and len(got) == len(rows)


def test_suffix_array():
    rng = random.Random(4)
    for _ in range(500):
        s = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 14))]
        assert suffix.suffix_array(s, 6) == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i])
def test_ten_thousand_rows_of_one_text(spark, ids):
    rng = random.Random(8)
    other = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    text, clean = other(250), other(100)
    holder = f"{clean} {text[:900]}"
    docs = spark.createDataFrame([(ids(i), text) for i in range(10_000)] + [(20_000, holder), (20_001, clean[:150])], "doc_id long, text string")
    got = suffix.remove_repeats(docs.repartition(4), 400).groupBy("n_bytes", "n_removed", "n_spans", "kept_sha256").count().collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["count"]) for r in got) == sorted(
        [(len(text), len(text), 1, 10_000), (len(holder), 900, 1, 1), (150, 0, 0, 1)]
    )
    words = recompress.remove_repeats(docs.repartition(4)).groupBy("n_words", "n_removed").agg({"*": "count"}).collect()
    found = {(r[0], r[1]): r[2] for r in words}
    if ids(1) == 1:
        assert found[250, 0] == 1 and found[250, 250] == 9_999
    else:  # one document, and the first of all
        assert found[250, 0] == 10_000
    assert sum(found.values()) == 10_002


def test_extra_columns_of_any_name(spark):
    rng = random.Random(9)
    clean = " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))
    extra = ["_spans", "_d", "_r", "__doc", "__row", "__start", "__count", "whole", "doc", "row", "start", "count", "key", "place", "again", "many", "bytes", "a.b", "bucket"]
    docs = spark.createDataFrame([(i, clean, 5, *extra) for i in (1, 1, 2, None, None)] + [(3, None, None, *extra), (4, "short", 5, *extra)], ["doc_id", "text", "n_chars", *extra])
    got = suffix.cut_texts(docs, 100)
    assert got.schema == docs.schema
    rows = [tuple(r) for r in got.collect()]
    assert all(r[3:] == tuple(extra) for r in rows)
    assert sorted((str(r[0]), r[1], r[2]) for r in rows) == sorted([("1", "", 0), ("1", "", 0), ("2", "", 0), ("None", "", 0), ("None", "", 0), ("3", None, None), ("4", "short", 5)], key=str)
    assert suffix.remove_repeats(docs, 100).count() == recompress.remove_repeats(docs).count() == 7
