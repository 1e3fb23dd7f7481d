import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from thylakoid.llm import lm

LOWER = {c: c + 32 for c in range(65, 91)}
VOCAB = [f"w{i}" for i in range(60)]


def learned():
    return F.col("doc_id") % 4 != 0

SMALL = {"chunk_bytes": 2000, "part_tokens": 500}


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    weights = [1 / (i + 1) for i in range(60)]
    out = [" ".join(rng.choices(VOCAB, weights, k=rng.randrange(1, 300))) for _ in range(90)]
    return [None, "", " \n\t", "One", "new words here", "new words here", *out, out[3], out[3], "word " * 30000, "x" * 100000, " ".join(rng.choices(VOCAB, k=20000))]


def counted(texts, chosen):
    one, two, context = Counter(), Counter(), Counter()
    for i in chosen:
        t = tokens(texts[i])
        one.update(t)
        two.update(zip(["<start>", *t], t, strict=False))
        context.update(["<start>", *t[:-1]])
    return one, two, context


def power(n):
    return 1 + int(math.log2(n)) if n else 0


def plain_weights(texts, rest, held):
    """EM as a plain loop over every held-out token, without cells."""
    one, two, context = counted(texts, rest)
    every = counted(texts, [*rest, *held])[0]
    n, floor = sum(one.values()), 1 / (len(every) + 1)
    seen = Counter()
    for i in held:
        t = tokens(texts[i])
        seen.update((power(context[a]), two[a, b] / max(context[a], 1), one[b] / max(n, 1)) for a, b in zip(["<start>", *t], t, strict=False))
    weights = {b: [1 / 3] * 3 for b in range(lm.BUCKETS)}
    weights[0] = [0, 0.5, 0.5]
    for _ in range(lm.ROUNDS):
        new = {b: [1.0 if b else 0.0, 1.0, 1.0] for b in weights}
        for (b, *p), times in seen.items():
            parts = [x * y for x, y in zip(weights[b], [*p, floor], strict=True)]
            for k in range(3):
                new[b][k] += times * parts[k] / sum(parts)
        weights = {b: [x / sum(w) for x in w] for b, w in new.items()}
    return weights


def expected(texts, chosen, weights):
    one, two, context = counted(texts, chosen)
    n, v = sum(one.values()), len(one)
    for text in texts:
        t = tokens(text)
        base = sum(math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = 0.0
        for a, b in zip(["<start>", *t], t, strict=False):
            w = weights[power(context[a])]
            score += math.log10(w[0] * two[a, b] / max(context[a], 1) + w[1] * one[b] / max(n, 1) + w[2] / (v + 1))
        yield len(t), sum(one[w] > 0 for w in t), n, base, score


def same(rows, wanted, rel=1e-9):
    for r, (n_tokens, n_known, n, base, score) in zip(sorted(rows), wanted, strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert (r.base_score, r.score) == (pytest.approx(base, rel=1e-9), pytest.approx(score, rel=rel))


@pytest.mark.parametrize("how", [SMALL | {"message_keys": 0}, SMALL, {}])  # packed questions, rows, one question
def test_model_against_brute_force(spark, texts, how):
    table = docs(spark, texts)
    rows = lm.score_texts(table, learned(), **how).collect()
    held = {r.doc_id for r in table.filter(learned() & (F.pmod(F.xxhash64(F.lit(3), "doc_id", "text"), F.lit(lm.HELD)) == 0)).collect()}
    rest = [i for i in range(len(texts)) if i % 4 and i not in held]
    assert len(held) > 3
    weights = plain_weights(texts, rest, held)
    same(rows, expected(texts, [i for i in range(len(texts)) if i % 4], weights), rel=1e-3)  # a cell's mean estimate stands for its tokens'
    assert all(r.train == (r.doc_id % 4 != 0) for r in rows)


def test_given_weights_make_scores_exact(spark, texts, monkeypatch):
    weights = np.tile([0.6, 0.3, 0.1], (lm.BUCKETS, 1))
    weights[0] = [0, 0.7, 0.3]
    monkeypatch.setattr(lm, "learn_weights", lambda *a: weights)
    same(lm.score_texts(docs(spark, texts), learned(), **SMALL, message_keys=0).collect(), expected(texts, [i for i in range(len(texts)) if i % 4], weights))


def test_a_table_united_with_itself(spark, texts, tmp_path):
    folder = str(tmp_path / "docs")
    docs(spark, texts).write.parquet(folder)
    twice = spark.read.parquet(folder).union(spark.read.parquet(folder))
    rows = sorted(lm.score_texts(twice, learned()).collect())
    assert len(rows) == 2 * len(texts) and rows[::2] == rows[1::2]
    one = counted(texts, [i for i in range(len(texts)) if i % 4])[0]
    n, v = 2 * sum(one.values()), len(one)
    for r in rows:
        t = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(one[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((2 * one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)


def test_more_texts_in_a_batch_than_sixteen_bits_tell(spark):
    many = spark.range(70000).selectExpr("id doc_id", "concat('a ', if(id % 10 < 3, 'x', 'y')) text").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")
    try:
        rows = sorted(lm.score_texts(many, learned()).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [r.doc_id for r in rows] == list(range(70000))
    assert {(r.n_tokens, r.n_known) for r in rows} == {(3, 3)} and len({(r.doc_id % 10 < 3, r.score) for r in rows}) == 2


def test_odd_tables(spark):
    table = docs(spark, ["a b", None, "a b"])
    assert lm.score_texts(table.limit(0), learned()).count() == 0
    rows = sorted(lm.score_texts(table, F.lit(None).cast("boolean")).collect())
    assert [(r.train, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(False, 3, 0, 0, 0.0), (False, 1, 0, 0, 0.0), (False, 3, 0, 0, 0.0)]
    assert all(math.isfinite(r.score) for r in rows)
    clash = spark.createDataFrame([(None, "a b", 1, "s"), (None, "a b", 1, "s"), ("k", "A  c", 2, "s")], "name string, body string, train int, text string")
    rows = lm.score_texts(clash.withColumns({c: F.lit(1) for c in ("chunk", "held", "part", "payload", "keys", "cell")}), F.col("train") == 1, "name", "body").collect()
    assert sorted((str(r.name), r.n_known, r.train_tokens) for r in rows) == [("None", 3, 6), ("None", 3, 6), ("k", 2, 6)]


def test_weights_follow_held_out_counts():
    side = lm.GRID + 1
    cells = np.array([3 * side**2 + 2 * side + 20, 3 * side**2 + lm.GRID * side + 20, 5 * side**2 + lm.GRID * side + 10])
    found = lm.learn_weights(cells, np.array([900.0, 100.0, 500.0]), np.array([[1.2, 10.2], [0, 10.2], [0, 5.1]]), 1e-6)
    assert found.sum(axis=1) == pytest.approx(1) and found[3, 0] > 0.85 and found[5, 1] > 0.95


def test_arrays_come_back():
    a, b, c = np.array([1, 2**64 - 1, 7], dtype=np.uint64), np.zeros(0, dtype=np.uint32), np.array([3, 255], dtype=np.uint8)
    assert [x.tolist() for x in lm.unpack(lm.pack(a, b, c), "QIB")] == [a.tolist(), [], [3, 255]]
    assert np.cumsum(lm._steps(np.sort(a)), dtype=np.uint64).tolist() == sorted(a.tolist())


def test_counts_pass_32_bits():
    key = np.array([5], dtype=np.uint64)
    every, apart, n = lm._totals([key] * 3, [np.array([2**32 - 1], dtype=np.uint32)] * 3, [False, True, False])
    assert every.tolist() == [3 * (2**32 - 1)] * 3 and apart.tolist() == [2**32 - 1] * 3 and n == 1
    assert lm.unpack(lm.pack(every.astype(np.uint64)), "Q")[0].tolist() == every.tolist()


def test_parts_are_ranges_of_hashes():
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 5000, dtype=np.uint64))
    for parts in (1, 2, 3, 700):
        at = lm._edges(keys, parts)
        assert at[0] == 0 and at[-1] == 5000 and len(at) == parts + 1
        assert np.array_equal(np.repeat(np.arange(parts), np.diff(at)), ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64))
