"""Classifiers on held-out rows, base measures and neighbours against brute force, and the pipeline's stages."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandflow.llm import ann, langid, linear, minhash, quality, toxicity
from strandflow.llm.common import split_words, word_hashes
from strandflow.llm.queries import vocabulary

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [
    (None, "word " * 500 + "end", "en"),
    (7, None, None),
    (10**9, "", None),
    (10**9 + 1, "²½ 12", None),
    (10**9 + 2, "y" * 300_000, "en"),
]


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels", "embeddings")}


@pytest.fixture(scope="module")
def edge(spark):
    rows = spark.createDataFrame(EDGE, "doc_id long, text string, lang string")
    return rows.unionAll(rows).withColumns({"kept": F.lit("x"), "index": F.lit(1), "toxic": F.lit(None).cast("int")})


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 2000 else {w for w in set(windows) if windows.count(w) > 1}
    again = {i + j for i, w in enumerate(windows) if w in twice for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def test_base_measures():
    texts = ["", None, "a", "a\n\nb\na\n \na", "é 中文 #<|   x", "one two three four five six seven eight " * 3, "\x0b\n\x0b", "x " * 9]
    for t in texts:
        raw, words = (t or "").encode(), split_words(t)
        assert quality.base_measures(t, raw, words, word_hashes(words)) == base(t), t


def test_quality_on_rows_it_was_not_fitted_on(spark, tables, edge):
    docs, labels = tables["documents"], tables["labels"]
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 0
    model = quality.fit(docs, labels.filter(~held))
    rows = quality.score(docs, model).join(labels.filter(held), "doc_id").filter("not base_failed").select("quality", "p_good").collect()
    good, bad = ([r["p_good"] for r in rows if r["quality"] == k] for k in (1, 0))
    assert good and all(0 <= p <= 1 for p in good + bad)
    assert np.mean(np.array(good) >= quality.KEEP_FROM) > 0.95
    if bad:
        assert np.mean(good) > np.mean(bad)
    found = quality.score(edge, model).collect()
    assert len(found) == 2 * len(EDGE) and not any(r["kept"] for r in found)
    assert quality.keep(edge, model).count() == 0 and quality.score(edge.limit(0), model).count() == 0
    assert quality.fit(docs, labels.limit(0)) is None
    plain = quality.score(docs, None).filter("p_good is not null or kept = base_failed")
    assert plain.count() == 0


def test_toxicity_on_rows_it_was_not_fitted_on(spark, edge):
    # sf0.01 has 37 toxic rows to learn from, which finds 7 of the 14 others; sf0.1 has 330
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 0
    model = toxicity.fit(docs, labels.filter(~held))
    rows = toxicity.score(docs, model).withColumnRenamed("toxic", "found").join(labels.filter(held), "doc_id").collect()
    assert np.mean([r["found"] for r in rows if r["toxic"] == 1]) > 0.8
    assert np.mean([r["found"] for r in rows if r["toxic"] == 0]) < 0.05
    got = toxicity.score(edge, model).collect()
    assert len(got) == 2 * len(EDGE) and not any(r["toxic"] for r in got if r["doc_id"] in (7, 10**9))
    assert toxicity.keep(edge, None).count() == 2 * len(EDGE) and toxicity.fit(docs, labels.limit(0)) is None


def test_language_of_held_out_rows(spark, tables, edge):
    docs = tables["documents"]
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = langid.fit(docs, ~held)
    rows = langid.predict(docs, model).join(
        docs.filter("lang is not null and length(text) > 0").filter(held).select("doc_id", "lang"),
        "doc_id",
    ).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95
    got = langid.predict(edge, model).collect()
    assert len(got) == 2 * len(EDGE)
    assert all((r["lang_pred"], r["score"]) == ("und", 0) for r in got if r["doc_id"] in (7, 10**9, 10**9 + 1))
    assert {r["lang_pred"] for r in langid.predict(edge, langid.fit(docs.limit(0), F.lit(True))).collect()} == {"und"}


def test_neighbours(spark, tables):
    odd = spark.createDataFrame(
        [(10**9, None), (10**9 + 20, [0.0] * 4), (None, [1.0] * 4), (10**9 + 40, [float("nan")] * 4)],
        "vec_id long, embedding array<float>",
    )
    rows = tables["embeddings"].select("vec_id", "embedding").unionAll(odd)
    got: dict = {}
    for r in ann.nearest(rows, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    data = tables["embeddings"].select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, v = np.array([r[0] for r in data]), np.array([r[1] for r in data], np.float64)
    asked = [i for i, x in enumerate(ids) if x % 20 == 0]
    assert set(got) == {int(ids[i]) for i in asked}
    hits = 0
    for i in asked:
        s = v @ v[i]
        s[i] = -np.inf
        mine = got[int(ids[i])]
        assert [r for r, _, _ in mine] == list(range(1, 21)) and [-x for _, _, x in mine] == sorted(-x for _, _, x in mine)
        assert np.allclose([x for _, _, x in mine], [s[np.searchsorted(ids, n)] for _, n, _ in mine], rtol=1e-12)
        hits += len({n for _, n, _ in mine} & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
    assert hits / (20 * len(asked)) >= 0.9
    assert ann.nearest(rows.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    rng = np.random.RandomState(8)
    v = np.concatenate(
        [rng.randn(900, 16) + 4 * rng.randn(6, 16)[rng.randint(0, 6, 900)], np.repeat(rng.randn(2, 16), 40, axis=0)]
    ).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(5000 + i, [float(i + 1), 2.0]) for i in range(30)]
    # each row three times: a copy of a row is no neighbour of its own
    df = spark.createDataFrame(rows * 3, "vec_id long, embedding array<float>").repartition(6)
    got: dict = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = total = 0
    for ids, x in ((np.arange(980), v.astype(np.float64)), (np.arange(5000, 5030), np.array([[i + 1, 2.0] for i in range(30)]))):
        for i in np.flatnonzero(ids % 20 == 0):
            s = x @ x[i]
            s[i] = -np.inf
            mine = got.pop(int(ids[i]))
            assert len(mine) == 20 == len({n for n, _ in mine}) and [-a for _, a in mine] == sorted(-a for _, a in mine)
            assert np.allclose([a for _, a in mine], [s[n - ids[0]] for n, _ in mine])
            hits += len({n for n, _ in mine} & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
            total += 20
    assert not got and hits / total >= 0.9


def test_every_language_is_learned(spark):
    import random

    rng, rows = random.Random(2), []
    for k in range(70):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyzäöüßéèçñøåæœ", 5)
        rows += [
            (
                100 * k + i,
                " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(40)),
                f"l{k:02}",
            ) for i in range(12)
        ]
    rows += [(9000, "zz zz", None), (None, "", "l00")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = langid.fit(docs, ~held)
    assert len(model["names"]) == 70
    found = langid.predict(docs, model).join(docs.filter(held).select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.9


def test_samples_are_bounded_in_each_class(spark):
    rows = spark.range(20_000).selectExpr(
        "id as doc_id",
        "case when id % 1000 = 0 then 'rare' when id = 7 then null else 'hot' end as kind",
    )
    got = {r["kind"]: r["count"] for r in linear.sample(rows, "kind", 100).groupBy("kind").count().collect()}
    assert got == {"rare": 20, "hot": 100}


def test_kinds_tell_vocabularies_apart():
    rng = np.random.RandomState(1)
    x = np.zeros((60, 30))
    for k in range(60):
        x[k, 10 * (k % 3) + rng.choice(10, 4, replace=False)] = 1
    own = toxicity.kinds_of(x, 3)
    assert all(len(set(own[k::3])) == 1 for k in range(3)) and len(set(own)) == 3
    assert toxicity.kinds_of(x[:1], 3).tolist() == [0]


def test_near_duplicates_of_odd_rows(spark, edge):
    got = minhash.near_duplicates(edge).collect()
    assert len(got) == 2 * len(EDGE)
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    assert all(r["component_id"] == r["doc_id"] and r["kept"] for r in got if r["doc_id"] is not None)


def test_pipeline_stages(spark, tables):
    import corpus_pipeline as p

    docs, names = tables["documents"], tables["documents"].columns
    docs = docs.filter("doc_id < 300").unionByName(
        spark.createDataFrame([(None, "a b c", None)], "doc_id long, text string, lang string"),
        allowMissingColumns=True,
    )
    for name, stage in p.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == names and docs.count() <= before, name
        if name == "near_duplicates":
            texts = [r["text"] or "" for r in docs.orderBy("doc_id").collect()]
    again: dict = {}
    for t in texts:
        b, n = t.encode(), p.PASSAGE_BYTES
        for k in range(len(b) - n + 1):
            again[b[k : k + n]] = again.get(b[k : k + n], 0) + 1
    for t, r in zip(texts, docs.orderBy("doc_id").collect(), strict=True):
        b, keep = t.encode(), bytearray(t.encode())
        gone = {j for k in range(len(b) - n + 1) if again[b[k : k + n]] > 1 for j in range(k, k + n)}
        assert (r["text"] or "") == bytes(x for j, x in enumerate(keep) if j not in gone).decode("utf-8", "ignore")
    packed = p.STAGES[-1][1](spark, docs, DATA).collect()
    import tokenizers

    t = tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = {r["doc_id"]: len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    have: dict = {}
    for r in packed:
        assert r["doc_tokens"] == want[r["doc_id"]]
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + r["length"]
    assert have == want
    assert [n for n, _ in p.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "suffix_array", "packing"]


def test_chain_against_a_plain_restatement():
    rng = np.random.default_rng(5)
    toxic_words = [["vile", "filth"], ["grab", "loot"], ["scum"]]
    texts, marks = [], []
    for i in range(400):
        words = [f"w{rng.integers(0, 60)}" for _ in range(rng.integers(3, 30))]
        if i % 3 == 0:
            words += list(rng.choice(toxic_words[i % 9 // 3], 2))
        texts.append(" ".join(words))
        marks.append(float(i % 3 == 0))
    marks = np.array(marks)
    index = [toxicity.buckets(t) for t in texts]
    flat, row = np.concatenate(index), np.repeat(np.arange(len(texts)), list(map(len, index)))
    model = toxicity.fit_chain(flat, row, marks, 3, 80)
    got = toxicity.probabilities(model, texts)
    sets = [set(x.tolist()) for x in index]
    chosen = np.flatnonzero(model["place"] >= 0)
    for i in rng.choice(400, 40, replace=False):
        row_of = [float(c in sets[i]) for c in chosen]
        for k, w in enumerate(model["weights"]):
            z = sum(a * b for a, b in zip(row_of, w[:-1], strict=True)) + w[-1]
            row_of.append(1 / (1 + math.exp(-z)))
            assert got[i, k] == pytest.approx(row_of[-1], abs=1e-9)
    assert ((model["out_of_fold"][:, -1] > 0.5) == (marks > 0)).mean() > 0.95
    kinds = model["targets"][:, :3]
    assert (kinds.sum(1) == marks).all() and all(((model["out_of_fold"][:, k] > 0.5) == (kinds[:, k] > 0)).mean() > 0.9 for k in range(3))
    assert toxicity.probabilities(model, [None, "", "a"]).shape == (3, 4)


def test_an_out_of_fold_probability_has_not_seen_its_own_label():
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{rng.integers(0, 40)}" for _ in range(12)) for _ in range(120)]
    marks = (rng.random(120) < 0.4).astype(float)
    index = [toxicity.buckets(t) for t in texts]
    flat, row = np.concatenate(index), np.repeat(np.arange(120), list(map(len, index)))
    before = toxicity.fit_chain(flat, row, marks, 0, 50)["out_of_fold"]
    for i in (0, 17, 119):
        other = marks.copy()
        other[i] = 1 - other[i]
        after = toxicity.fit_chain(flat, row, other, 0, 50)["out_of_fold"]
        assert after[i] == before[i] and (after != before).any()


def test_language_model_against_the_plain_kernel_matrix(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANDMARKS", 6)
    rng = random.Random(2)
    alphabets = {"aa": "abcdeé", "bb": "cdefgh", "cc": "中文字日", "dd": "xyzабв"}
    rows = [(i, "".join(rng.choice(alphabets[lang] + "  ") for _ in range(rng.randint(5, 80))), lang) for i, lang in enumerate(rng.choices(list(alphabets), k=160))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(docs, F.lit(True), per_language=30)
    picked = linear.sample(docs, "lang", 30).collect()
    grams = lambda t: frozenset(np.flatnonzero(_presence(t)).tolist())
    own = sorted(((r["draw"], r["doc_id"], r["lang"], grams(r["text"])) for r in picked), key=lambda r: r[:2])
    kernel = lambda a, b: len(a & b) / math.sqrt(max(len(a), 1) * max(len(b), 1))
    names = sorted({r[2] for r in own})
    marks = [r[3] for n in names for r in [x for x in own if x[2] == n][:6]]
    k = np.array([[kernel(r[3], m) for m in marks] for r in own])
    size = {n: sum(r[2] == n for r in own) for n in names}
    b = np.array([1 / size[r[2]] for r in own])[:, None]
    y = np.array([[1.0 if r[2] == n else -1.0 for n in names] for r in own])
    inner = np.array([[kernel(p, q) for q in marks] for p in marks])
    ridge = np.linalg.solve(k.T @ (b * k) + langid.RIDGE * inner / len(names) + 1e-6 * np.eye(len(marks)), k.T @ (b * y))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    right = 0
    for i, text, lang in rows:
        margins = np.array([kernel(grams(text), m) for m in marks]) @ ridge
        assert got[i][1] == pytest.approx(min(max((margins.max() + 1) / 2, 0), 1), abs=2e-3)
        assert got[i][0] == names[int(margins.argmax())] or np.sort(margins)[-1] - np.sort(margins)[-2] < 1e-3
        right += got[i][0] == lang
    assert model["names"] == names and right > 150


def _presence(text):
    out = np.zeros(langid.WIDTH)
    langid.presence(text, out)
    return out


def test_stages_take_odd_tables(spark, tables):
    import corpus_pipeline as p

    extra = ["_spans", "__doc", "__start", "a.b", "node", "band", "draw", "toxic", "kept"]
    some = tables["documents"].limit(60).withColumns({c: F.lit(c) for c in extra})
    clean = tables["labels"].filter("quality = 1 and toxic = 0").join(tables["documents"].filter("length(text) between 600 and 3000"), "doc_id")
    text = clean.orderBy("doc_id").first()["text"]
    odd = [(None, text)] * 40 + [(5_000_000, text)] * 40 + [(5_000_001, text), (5_000_002, None), (None, None), (5_000_003, "")]
    more = spark.createDataFrame([(i, t, "en", "web", None, *extra) for i, t in odd], some.schema.simpleString().removeprefix("struct<").removesuffix(">").replace("a.b", "`a.b`"))
    for docs in (some.union(more), some.limit(0)):
        n = docs.count()
        for name, stage in p.STAGES:
            out = p.cut(stage(spark, docs, DATA), name)
            if name == "packing":
                assert (out.count() > 0) == (n > 0)
            else:
                assert out.columns == docs.columns and out.count() <= docs.count()
                kept = {r["doc_id"] for r in out.select("doc_id").collect()}
                assert all(r[c] == c for r in out.limit(5).collect() for c in extra)
                if n and name == "near_duplicates":
                    assert 5_000_001 not in kept and (5_000_000 in kept or out.filter("doc_id is null").count() > 0)
            docs = out if name != "packing" else docs
