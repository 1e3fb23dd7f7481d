import math
import random
import unicodedata
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from thylakoid.llm import langid

rng = random.Random(8)
PARTS = {"aa": ["th", "er", "on", "an", "sh", "y"], "bb": ["au", "é", "eu", "x", "ou", "q"], "cc": ["sch", "ü", "ei", "nd", "w"], "dd": ["ло", "ва", "ю", "ст"]}
OFTEN = {k: ["".join(rng.choices(v, k=2)) for _ in range(6)] for k, v in PARTS.items()}


def made(lang, n):
    return " ".join(rng.choice(OFTEN[lang]) if rng.random() < 0.4 else "".join(rng.choices(PARTS[lang], k=rng.randrange(1, 5))) for _ in range(n))


ROWS = [(i, lang, made(lang, rng.randrange(1, 60))) for i, lang in enumerate(sorted(PARTS) * 60)]
ODD = [(None, "aa", "Ther THER an"), (900, None, made("bb", 30)), (901, "aa", None), (902, "aa", ""), (903, "bb", "12 -- 3!\n"), (904, "cc", "́ ́"), (905, "dd", "ж"), (906, "aa", "ther " * 20000), (907, "aa", "th" * 30000), (908, "aa", "文字"), ROWS[5], ROWS[5]]


def words(text):
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    return [w for w in kept.split(" ") if w]


def grams(word, n):
    padded = f" {word} "
    return [g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " "]


def plain_model(rows):
    texts = {(t, lang) for _, lang, t in rows if lang is not None and t is not None}
    counts = {n: defaultdict(Counter) for n in (0, *langid.ORDERS)}
    for t, lang in texts:
        for w in words(t):
            counts[0][w][lang] += 1
            for n in langid.ORDERS:
                for g in grams(w, n):
                    counts[n][g][lang] += 1
    counts[0] = {w: c for w, c in counts[0].items() if sum(c.values()) >= langid.LEAST}
    langs = sorted({lang for _, lang in texts})
    logs = {}
    for n, table in counts.items():
        total = {x: sum(c[x] for c in table.values()) + langid.ADDED * max(1, len(table)) for x in langs}
        logs[n] = {g: [math.log((c[x] + langid.ADDED) / total[x]) for x in langs] for g, c in table.items()}
    share = Counter(lang for _, lang in texts)
    return langs, [math.log(share[x] / len(texts)) for x in langs], logs


def plain_judge(model, text):
    langs, prior, logs = model
    if not langs or not any(unicodedata.category(c)[0] == "L" for c in text or ""):
        return "und", 0.0
    total, found = list(prior), words(text)
    for w in found:
        rows = [logs[0][w]] if w in logs[0] else next((r for n in langid.ORDERS if (r := [logs[n][g] for g in grams(w, n) if g in logs[n]])), [])
        for i in range(len(langs)):
            total[i] += sum(r[i] for r in rows) / max(1, len(rows))
    best = max(range(len(langs)), key=lambda i: (total[i], -i))
    return langs[best], 1 / sum(math.exp((x - total[best]) / math.sqrt(max(1, len(found)))) for x in total)


def judged(spark, rows, train, **how):
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    return [(r.doc_id, r.text, r.lang_pred, r.score) for r in langid.identify(docs, train, **how).collect()]


def test_predictions_against_brute_force(spark):
    rows = ROWS + ODD
    model = plain_model([r for r in rows if (r[0] or 0) % 3 != 1])
    got = judged(spark, rows, F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 1)
    assert Counter((k, t) for k, t, _, _ in got) == Counter((k, t) for k, _, t in rows)
    for _, text, lang, score in got:
        want = plain_judge(model, text)
        assert lang == want[0] and score == pytest.approx(want[1], abs=1e-9)
    assert {lang for k, _, lang, _ in got if k in (901, 902, 903, 904)} == {"und"} and all(0 <= s <= 1 for *_, s in got)
    held = {r[0]: r[1] for r in ROWS if r[0] % 3 == 1}
    right = sum(held[k] == lang for k, _, lang, _ in got if k in held)
    assert right >= 0.97 * len(held)


def test_odd_tables(spark):
    assert judged(spark, ROWS[:0], F.lit(True)) == []
    assert {(lang, s) for _, _, lang, s in judged(spark, ROWS[:9], F.lit(None).cast("boolean"))} == {("und", 0.0)}
    assert {lang for _, t, lang, _ in judged(spark, ROWS[:1], F.lit(True))} == {"aa"}
    docs = spark.createDataFrame(ROWS, "doc_id long, lang string, text string")
    clash = docs.withColumns({c: F.lit(c) for c in ("key", "train", "n", "gram", "times", "_key", "_lang", "_text", "total", "score", "lang_pred")})
    plain = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs, F.lit(True)).collect()}
    got = langid.identify(clash, F.lit(True))
    assert {(r.doc_id, r.lang_pred, r.score) for r in got.collect()} == plain and got.columns[:3] == docs.columns
    assert {r.gram for r in got.collect()} == {"gram"}


def test_a_sample_is_enough(spark):
    got = judged(spark, ROWS, F.lit(True), limit=60)
    lang = {r[0]: r[1] for r in ROWS}
    assert sum(lang[k] == found for k, _, found, _ in got) >= 0.95 * len(ROWS)
