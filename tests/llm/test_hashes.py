"""Texts and rows that weak hashes take for equal."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from thylakoid.llm import common, jaccard, lm, mixing, quality, textkit


def thue_morse(n, letters):
    return [letters[bin(i).count("1") & 1] for i in range(n)]


PAIRS = [(thue_morse(n, "ab"), thue_morse(n, "ba")) for n in (4, 8, 16, 512, 1024, 4096)]
TEXTS = [sep.join(x) for pair in PAIRS for x in pair for sep in ("", " ")]


def hashes(parts):
    ends = np.cumsum([len(p) for p in parts])
    return textkit.hash_spans(np.frombuffer(b"".join(parts), dtype=np.uint8), ends - [len(p) for p in parts], ends)


def test_spans_are_told_apart_wherever_they_lie():
    rng = random.Random(4)
    parts = list({bytes(rng.choices(range(3), k=rng.randrange(0, 40))) for _ in range(20000)} | {t.encode() for t in TEXTS})
    found = dict(zip(parts, hashes(parts).tolist(), strict=True))
    assert len(set(found.values())) == len(parts)
    rng.shuffle(parts)
    assert dict(zip(parts, hashes(parts).tolist(), strict=True)) == found


@pytest.mark.parametrize("n", range(2, 9))
def test_runs_of_two_words_are_told_apart(n):
    a, b = hashes([b"a", b"b"])
    runs = [tuple(i >> k & 1 for k in range(n)) for i in range(1 << n)]
    assert len({int(textkit.combine(np.array([b if bit else a for bit in run], dtype=np.uint64), n)[0]) for run in runs}) == len(runs)


def test_sets_lines_and_words_of_such_texts(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(TEXTS)], "doc_id long, text string, source string")
    for n in (3, 4, 5):
        sets = [{tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} for w in (t.split() for t in TEXTS)]
        up = {i: min(j for j in range(len(sets)) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])) for i in range(len(sets))}
        while any(up[up[i]] != up[i] for i in up):
            up = {i: up[up[i]] for i in up}
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, n=n, num=85, den=100).collect()}
        assert got == {i: (len(s), up[i]) for i, s in enumerate(sets)}

    lines = [t for t in TEXTS if len(t) < 2000]
    measured = quality.judge_documents(spark.createDataFrame([(1, "\n".join(lines), "s"), (2, "\n".join([*lines, lines[0]]), "s")], docs.schema)).collect()
    assert {r.doc_id: r.n_dup_lines for r in measured} == {1: 0, 2: 1}

    half = [t for t in TEXTS if " " not in t]
    scored = lm.score_texts(docs.filter(~F.contains("text", F.lit(" "))), F.lit(True)).collect()
    known = Counter(half)
    assert all(r.n_known == 2 and r.train_tokens == 2 * len(half) for r in scored)
    v = len(known) + 1
    want = np.log10(1.1 / (2 * len(half) + 0.1 * (v + 1))) + np.log10((len(half) + 0.1) / (2 * len(half) + 0.1 * (v + 1)))
    assert all(r.base_score == pytest.approx(want) for r in scored)


BODY = " ".join(f"word{i}" for i in range(60))
NESTED = [
    (["x"], [["a"], ["b"]], {"k": 1}, (1, None)), (["x", None], [["a"], ["b"]], {"k": 1}, (1, None)), (["x"], [["a", "b"]], {"k": 1}, (1, None)), (["x"], [["a"], ["b"]], {"k": 2}, (1, None)),
    (["x"], [["a"], ["b"]], {"k": None}, (1, None)), (["x"], [["a"], ["b"]], {}, (1, None)), (["x"], [["a"], ["b"]], None, (1, None)), (["x"], [["a"], ["b"]], {"k": 1}, (None, 1)),
    (["x"], [["a"], ["b"]], {"k": 1}, None), (["x"], [["a"], ["b"]], {"k": 1}, (None, None)), ([None, "x"], [], {"k": 1}, (1, None)), (["x"], [[], ["a", "b"]], {"k": 1}, (1, None)),
]
KIND = "doc_id long, text string, source string, list array<string>, lists array<array<string>>, map map<string,int>, pair struct<a:int,b:int>"


def as_text(df):
    return Counter(str(r.asDict(recursive=True)) for r in df.collect())


def test_rows_that_differ_within_their_columns_stay_apart(spark):
    docs = spark.createDataFrame([(7, BODY, "s", *row) for row in NESTED], KIND)
    assert docs.select(common.row_hash(docs)).distinct().count() == len(NESTED)
    variants = docs.select(F.parse_json(F.to_json("map")).alias("v"))
    assert variants.select(common.row_hash(variants)).distinct().count() == 5  # null, {}, and "k" of null, 1 and 2
    turned = docs.select(F.when(F.col("map").isNotNull(), F.create_map(F.lit("z"), F.lit(0), F.lit("k"), F.lit(1))).alias("m"), F.when(F.col("map").isNotNull(), F.create_map(F.lit("k"), F.lit(1), F.lit("z"), F.lit(0))).alias("n"))
    sides = [turned.select(F.col(c).alias("x")) for c in ("m", "n")]
    assert sides[0].select(common.row_hash(sides[0])).distinct().exceptAll(sides[1].select(common.row_hash(sides[1])).distinct()).count() == 0  # entries in any order
    assert as_text(mixing.mix(docs)) == as_text(docs)
    twice = docs.union(docs)
    assert set(as_text(mixing.mix(twice))) == set(as_text(docs)) and mixing.mix(twice).count() == 2 * len(NESTED)


def test_stages_keep_rows_that_differ_within_their_columns(spark, tmp_path):
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(len(NESTED))]
    docs = spark.createDataFrame([(i % 3, texts[i], "s", *row) for i, row in enumerate(NESTED)], KIND)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "some other passage of words that no document has")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert as_text(stage(spark, docs, str(tmp_path)).select(docs.columns)) == as_text(docs), name
    assert as_text(corpus_pipeline.run(spark, str(tmp_path)).select(docs.columns)) == as_text(docs)
