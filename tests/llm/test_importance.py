import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from thylakoid.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
rng = random.Random(3)
MADE = [" ".join(rng.choice(["the", "of", "Wald", "école", "x1", "niño", f"w{rng.randrange(300)}"]) for _ in range(rng.randrange(0, 90))) for _ in range(150)]
ODD = [None, "", " \n-!", "One", "a\x00b A\x00B", "ÀÉ àé", "x" * 50000, "word Word " * 9000, "日本 語 " * 15, *MADE[:5], *MADE[:5]]
ROWS = [(i, t) for i, t in enumerate([*MADE, *ODD])] + [(3, MADE[3])] * 4 + [(None, MADE[0]), (None, None), (9, MADE[11])]
ITEMS = [(i, t) for i, t in enumerate([*MADE[:4], None, "", "the of the"])]


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def brute(rows, items, buckets, least, percent, seed):
    crc = lambda f: zlib.crc32(f.encode()) % buckets
    corpus, target = (Counter(crc(f) for _, t in side for f in features(t)[1]) for side in (rows, items))
    s, t = sum(corpus.values()), sum(target.values())
    gain = lambda b: math.floor(1000 * math.log((target[b] + 1) * float(s + buckets) / ((corpus[b] + 1) * float(t + buckets))))
    out = []
    for key, text in rows:
        n, found = features(text)
        weight = sum(gain(crc(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(able) * percent // 100
    return Counter([(*r, i + 1 if i < drawn else None) for i, r in enumerate(able)] + [(*r, None) for r in out if r[1] < least])


def found(spark, rows, items, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return Counter(map(tuple, importance.resample(docs, spark.createDataFrame(items, "item_id long, text string"), **how).collect()))


def test_draws_against_brute_force(spark):
    assert found(spark, ROWS, ITEMS) == brute(ROWS, ITEMS, 10000, 20, 25, 7)
    assert found(spark, ROWS, ITEMS, buckets=16, least=1, percent=60, seed=1) == brute(ROWS, ITEMS, 16, 1, 60, 1)


def test_odd_tables(spark):
    assert found(spark, ROWS[:40], []) == brute(ROWS[:40], [], 10000, 20, 25, 7)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert importance.resample(docs.limit(0), bench).collect() == []
    clash = docs.withColumns({c: F.lit(c) for c in ("row", "body", "key", "n_words", "held", "counts", "score", "rank", "_range", "_at", "_nth")})
    assert Counter(map(tuple, importance.resample(clash, bench).collect())) == brute(ROWS, ITEMS, 10000, 20, 25, 7)


def test_ranks_over_many_ranges(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).repartition(6)
    rows = rows.union(rows.filter("b < 10"))
    got = importance.ranked(importance.durable(rows), [F.desc("a"), F.asc("b")], "place").orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 5011)) and [(r.a, r.b) for r in got] == sorted(((r.a, r.b) for r in got), key=lambda x: (-x[0], x[1]))
