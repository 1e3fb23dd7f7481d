"""Every stage of the pipeline against a plain reading of what it should keep."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from thylakoid.llm import jaccard, mixing, sharding
from thylakoid.llm.common import row_hash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = [f"w{i}" for i in range(400)]
rng = random.Random(11)


def made(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def edited(text, every):
    return " ".join(w if i % every else "changed" for i, w in enumerate(text.split(" ")))


ITEMS = [made(40), made(30), made(60)]
BASE = [made(120) for _ in range(12)]
ROWS = [
    *[(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(BASE)],
    (20, edited(BASE[0], 200), "en", "s1", 1), (21, BASE[0].upper(), "en", "s2", 2), (22, BASE[1], "en", "s0", 3),  # near and exact copies
    (3, made(90), "de", "s0", 4), (3, made(95), "de", "s0", 4),  # a key with several texts
    (None, made(80), "en", "s1", 5), (None, BASE[2], "en", "s1", 5), (None, made(85), None, None, None),  # rows without a key
    (30, made(70), "en", "s2", 6), (30, made(70), "en", "s2", 6),
    (31, BASE[5], "en", "s2", 7), (31, BASE[5], "en", "s2", 7), (31, BASE[5], "fr", "s2", 7),  # equal rows, and one that differs in another column
    (40, "short", "en", "s0", 8), (3, "short", "en", "s0", 8), (41, None, "en", "s0", None), (42, "", "en", None, 0), (42, "", "en", None, 0), (43, "a b " * 60, "en", "s1", 9),
    (50, made(60) + " " + ITEMS[0] + " " + made(60), "en", "s0", 10), (51, made(30) + " " + edited(ITEMS[1], 9), "en", "s1", 11), (None, ITEMS[2], "en", "s1", 12), (52, made(50) + " " + " ".join(ITEMS[2].split(" ")[:8]) + " " + made(50), "en", "s0", 13),
    (60, made(30000), "en", "s0", 14),
    *[(100 + i, "too short" if i % 10 else made(90), "en", "bad", 15) for i in range(60)],
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(ITEMS)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def good(row):
    w = words(row[1])
    runs = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j + k for j in range(len(w) - 2) if runs[w[j], w[j + 1], w[j + 2]] > 1 for k in range(3)}
    return len(w) >= 50 and 100 * len(covered) <= 50 * len(w) and row[3] != "bad"


def one_of_each(rows):
    sets = [(lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())([x.lower() for x in words(r[1])]) for r in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (c := len(sets[i] & sets[j])) and 100 * c >= 80 * len(sets[i] | sets[j]):
                up[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, s in enumerate(sets):
        groups.setdefault(root(i) if s else ("alone", i), []).append(rows[i])
    return list(groups.values())


def clean(row):
    text = f" {row[1] or ''} "
    return not any(sum(f" {' '.join(item.split(' ')[i : i + 4])} " in text for i in range(0, len(item.split(" ")) - 3)) > 0.4 * len(item.split(" ")) for item in ITEMS)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def multiset(rows):
    return Counter(tuple(r) for r in rows)


def test_quality_rules_keep_the_good_rows(spark, folder):
    got = corpus_pipeline.quality_rules(spark, table(spark, ROWS), folder)
    assert multiset(got.collect()) == multiset(r for r in ROWS if good(r))
    assert not good((None, ROWS[-1][1], None, "bad"))


def test_jaccard_join_keeps_one_of_each(spark, folder, monkeypatch):
    monkeypatch.setattr(jaccard, "PIECE", 4)
    got = multiset(corpus_pipeline.jaccard_join(spark, table(spark, ROWS), folder).collect())
    groups = one_of_each(ROWS)
    left = Counter(got)
    for group in groups:
        least = min((r[0] is None, r[0] or 0) for r in group)
        found = [r for r in set(group) if left[r]]
        assert len(found) == 1 and (found[0][0] is None, found[0][0] or 0) == least
        left[found[0]] -= 1
    assert not +left and sum(got.values()) == len(groups)


def test_decontamination_drops_the_copies_alone(spark, folder):
    got = corpus_pipeline.decontamination(spark, table(spark, ROWS), folder)
    assert multiset(got.collect()) == multiset(r for r in ROWS if clean(r))
    assert sum(not clean(r) for r in ROWS) == 3


def test_mixing_repeats_rows_as_planned(spark, folder):
    docs = table(spark, ROWS)
    got = multiset(corpus_pipeline.mixing(spark, docs, folder).collect())
    assert set(got) == set(map(tuple, ROWS))
    times = Counter(map(tuple, ROWS))
    assert all(got[r] >= n for r, n in times.items())
    planned = mixing.mixing_plan(docs, ident=row_hash(docs)).join(docs.select("lang", "text", "n_chars", row_hash(docs).alias("_ident")).distinct(), "_ident")
    assert got == multiset(planned.select(docs.columns).collect())
    by = lambda rows, source, size: {s: sum(size(r) for r in rows if source(r) == s) for s in {r[3] for r in ROWS}}
    tokens = by(ROWS, lambda r: r[3], lambda r: len(words(r[1])) + 1)
    used = by(list(got.elements()), lambda r: r[3], lambda r: len(words(r[1])) + 1)
    share = {s: n / sum(tokens.values()) for s, n in tokens.items()}
    least, most = min(share.values()), max(share.values())
    exponent = max(0.0, 1 - np.log(2) / np.log(most / least))
    longest = {s: max(len(words(r[1])) + 1 for r in ROWS if r[3] == s) for s in share}
    for s in share:
        aim = max(tokens.values()) * (share[s] / most) ** exponent
        assert aim - 1 <= used[s] < aim + longest[s]


def test_sharding_is_the_hash_of_the_key(spark, folder):
    got = corpus_pipeline.sharding(spark, table(spark, ROWS), folder)
    hashed = dict(map(tuple, spark.createDataFrame([(r[0],) for r in ROWS], "k long").select("k", F.xxhash64("k")).collect()))
    want = Counter((*r, int(sharding.jump(np.array([hashed[r[0]]]), 8)[0])) for r in ROWS)
    assert multiset(got.collect()) == want


def test_stages_of_empty_tables_and_clashing_names(spark, folder):
    clash = ["_row", "_text", "_key", "_ident", "_uses", "_use", "set_id", "part", "grp", "kept", "host_kept", "score", "segment", "times", "n_words", "size", "slot"]
    docs = table(spark, ROWS).withColumns({c: F.lit(c) for c in clash})
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0
        found = stage(spark, docs, folder)
        assert found.columns[: len(docs.columns)] == docs.columns == empty.columns[: len(docs.columns)]
        plain = stage(spark, table(spark, ROWS), folder)
        assert all(r[c] == c for r in found.collect() for c in clash)
        count = set if name == "mixing" else Counter  # which rows are used twice follows from all columns
        assert count(r.doc_id for r in found.collect()) == count(r.doc_id for r in plain.collect()), name


def test_run_is_its_stages_in_order(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"]
    groups = one_of_each([r for r in ROWS if good(r)])
    least = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups]
    kept = {(r[0], r[1].lower()) for r in least if clean(r)}
    assert {(r.doc_id, r.text.lower()) for r in got.collect()} == kept
