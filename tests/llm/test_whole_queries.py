"""Whole queries and operators against brute force over generated tables, and over odd ones."""

import itertools
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from thylakoid.llm import bloom, common, components, decontaminate, jaccard, mixing, quality, queries, sharding, tokencounts, toxicity, urlrules, warc

LOWER = {c: c + 32 for c in range(65, 91)}
VOCAB = [f"w{i}" for i in range(300)]
rng = random.Random(21)


def made(n, vocab=VOCAB):
    return " ".join(rng.choice(vocab) for _ in range(n))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def document_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


ODD = [
    (1, made(120), "en", "a", 1), (1, made(120), "en", "a", 1), (2, None, "en", None, None), (None, made(80), None, "b", 2), (None, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t ", "en", "b", 4),
    (5, "word " * 60000, "en", "a", 5), (6, "y" * 300000, "en", "a", 6), *[(7, "same text " * 40, "de", "b", 7)] * 5,
]
CLASH = ["key", "_key", "_row", "_text", "_text_", "_body", "_host", "doc", "words", "seeds", "grams", "segment", "row", "set_id", "part", "grp", "known", "piece", "_size", "_shard", "_copies", "_copy", "_ident", "_n", "_uses", "epoch", "copy", "score", "label", "spans", "section", "kept", "n_words", "law", "slot"]


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASH if c not in df.columns})


# --- op10: the verdict on hosts, where it matters ---


def host_table():
    rows, n = [], 0

    def host(name, size, bad, text):
        nonlocal n
        for i in range(size):
            rows.append((n, text(i) if i < bad else made(rng.randrange(60, 90)), "en", name, 1))
            n += 1

    short = lambda i: made(5)
    host("bad-large", 300, 290, short)
    host("bad-medium", 40, 32, short)
    host("bad-small", 2, 2, short)  # too few to tell, near the rate of all hosts
    host("edge-under", 50, 28, short)
    host("edge-over", 50, 34, short)
    host("symbols", 60, 50, lambda i: made(60) + " #*$ |<>" * 20)
    host("lines", 60, 55, lambda i: "\n".join([made(3)] * 2 + [made(2)] * 40))
    host("repeats", 60, 50, lambda i: made(4) * 1 + " " + " ".join(["a b c d e f g h"] * 10))
    host(None, 30, 3, short)
    for k in range(25):
        host(f"good{k}", rng.randrange(1, 60), 0, short)
        host(f"mixed{k}", rng.randrange(5, 40), rng.randrange(0, 4), short)
    return [*rows, *rows[:5], (n, None, "en", "good1", 0), (n + 1, "", "en", "good2", 0), (None, made(70), "en", "bad-large", 0)]


def test_host_verdicts_match_the_sql(spark, tmp_path):
    rows = host_table()
    document_table(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.op10_quality_rules(spark, str(tmp_path))
    sql = con.sql(queries.ORACLE_SQL["op10_quality_rules"])
    at = [sql.columns.index(c) for c in got.columns]
    assert Counter(map(tuple, got.collect())) == Counter(tuple(r[i] for i in at) for r in sql.fetchall())
    source = {r[0]: r[3] for r in rows}
    by_host = defaultdict(list)
    for r in got.collect():
        if not r.base_failed and r.doc_id is not None:
            by_host[source[r.doc_id]].append(r.kept)
    assert not any(by_host["bad-large"]) and not any(by_host["bad-medium"]) and not any(by_host["symbols"])
    assert all(k for h, kept in by_host.items() if h is None or h.startswith(("good", "mixed", "edge-under")) for k in kept)
    assert len(by_host["bad-large"]) == 10


def test_few_bad_documents_do_not_tell_a_host(spark):
    rows = [(i, made(5), "en", "tiny", 1) for i in range(1)] + [(10, made(70), "en", "tiny", 1)] + [(100 + i, made(70), "en", f"h{i % 30}", 1) for i in range(900)]
    got = {r.doc_id: r.kept for r in quality.judge_documents(document_table(spark, rows)).collect()}
    assert got[10] and not got[0] and all(got[100 + i] for i in range(900))


# --- op6: every token against every section ---


def plain_sections(raw, ends, sections, rule):
    counts = [[0, 0] for _ in sections]
    begin = 0
    for end in ends:
        share = [min(end, b) - max(begin, a) for a, b in sections]
        if rule == "most":
            owner = max(range(len(sections)), key=lambda i: (share[i], -i)) if sections and max(share) > 0 else None
        else:
            owner = next((i for i, (a, b) in enumerate(sections) if a <= begin < b), None)
        if owner is not None:
            counts[owner][0] += 1
            counts[owner][1] += not (sections[owner][0] <= begin and end <= sections[owner][1])
        begin = end
    return counts


@pytest.mark.parametrize("rule", tokencounts.RULES)
@pytest.mark.parametrize("given", [False, True])
def test_every_section_counts_its_tokens(spark, rule, given):
    texts = [made(rng.randrange(1, 200)).replace(" ", lambda_sep(rng), 3) for _ in range(30)] + ["a\n\nbé\n\n\n  c\n", "\n", "", None, "é" * 50 + "\n" + "漢字かな" * 30, "x " * 20000 + "\ny"]
    rows = []
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        bounds = sorted(rng.sample(range(len(raw) + 1), min(len(raw) + 1, 8))) if raw else []
        rows.append((i, text, [(a, b) for a, b in zip(bounds[::2], bounds[1::2], strict=False)]))
    table = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<start:long,end:long>>")
    coder, lengths = tokencounts.encoder(open(tokencounts.VOCABULARY, "rb").read(), tokencounts.PATTERN)
    got = defaultdict(dict)
    for r in tokencounts.section_tokens(table, spans="parts" if given else None, rule=rule).collect():
        assert r.section not in got[r.doc_id]
        got[r.doc_id][r.section] = (r.start_byte, r.end_byte, r.n_tokens, r.n_crossing, r.n_document)
    for i, text, parts in rows:
        raw = (text or "").encode()
        if not given:
            parts, at = [], 0
            for line in raw.splitlines(keepends=True) if b"\r" not in raw else []:
                parts.append((at, at + len(line)))
                at += len(line)
        ends = np.cumsum(lengths[coder.encode_ordinary(text or "")]).tolist() if text else []
        counts = plain_sections(raw, ends, parts, rule)
        assert got[i] == {k: (a, b, *counts[k], len(ends)) for k, (a, b) in enumerate(parts)}


def lambda_sep(rng):
    return rng.choice(["\n", "\n\n", " \n ", ". "])


# --- op2: every document against every item by the full matrix ---


def full_score(a, b):
    best, above = 0, np.zeros(len(b) + 1, dtype=int)
    for x in a:
        row = np.zeros(len(b) + 1, dtype=int)
        for j, y in enumerate(b, 1):
            row[j] = max(0, above[j - 1] + (2 if x == y else -1), above[j] - 1, row[j - 1] - 1)
        best, above = max(best, int(row.max())), row
    return best


RARE = [f"rare{i}" for i in range(4000)]


def hashed(texts):
    (_, found, hashes), = decontaminate._words(pa.array(texts))
    return [hashes[a:b].view(np.int64).tolist() for a, b in itertools.pairwise(found.first.tolist())]


def plain_words(text):
    return words(re.sub(r"[!-/:-@\[-`{-~]", "", (text or "").translate(LOWER)))


@pytest.mark.parametrize("sent", [60, 1_000_000])
def test_contamination_against_the_full_matrix(spark, monkeypatch, sent):
    monkeypatch.setattr(decontaminate, "INDEX_WORDS", sent)
    items = [made(n) for n in (30, 18, 45, 12, 3, 25)] + ["Tiny, ITEM!", "", None, made(160)]

    def edited(text, rate):
        out = []
        for w in text.split(" "):
            x = rng.random()
            out += [w] if x > rate else [] if x < rate / 3 else [rng.choice(VOCAB)] if x < 2 * rate / 3 else [w, "inserted"]
        return " ".join(out)

    texts = [None, "", made(100), "tiny item", made(4000)]
    for k in range(70):
        item = items[k % 6] if k % 9 else items[9]
        texts.append(f"{made(rng.randrange(0, 60))} {edited(item, rng.choice([0, 0.1, 0.25, 0.4]))} {made(rng.randrange(0, 60))}".upper() + (" " + items[1] if k % 11 == 0 else ""))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(table, bench).collect()}
    want, seeded = {}, set()
    for i, text in enumerate(texts):
        t = plain_words(text)
        for j, item in enumerate(items):
            w = plain_words(item)
            if w and t:
                n = min(decontaminate.SEED, len(w))
                if {tuple(w[x : x + n]) for x in range(len(w) - n + 1)} & {tuple(t[x : x + n]) for x in range(len(t) - n + 1)}:
                    seeded.add((i, j))
                if (score := full_score(w, t)) >= len(w):
                    want[i, j] = score
    assert {k: r.score for k, r in got.items()} == {k: s for k, s in want.items() if k in seeded}
    long = [k for k in want if len(words(items[k[1]])) >= 10]  # half of an item of three words occurs by chance
    assert len(long) > 50 and len([k for k in long if k in got]) >= 0.95 * len(long)  # the rest, edited heavily, has no seed
    for (i, j), r in got.items():
        t, w = plain_words(texts[i]), plain_words(items[j])
        assert r.similarity == r.score / (2 * len(w)) and full_score(w[r.item_start : r.item_end], t[r.doc_start : r.doc_end]) == r.score


def test_hot_ngrams_of_a_large_benchmark(spark, monkeypatch):
    items = [(i, f"common passage of words {made(8)}") for i in range(20)]
    texts = [(i, f"{made(5)} {items[i % 20][1]}") for i in range(200)]
    table, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    plain = sorted(map(tuple, decontaminate.contaminated(table, bench).collect()))
    monkeypatch.setattr(decontaminate, "INDEX_WORDS", 60)  # four blocks
    assert sorted(map(tuple, decontaminate.contaminated(table, bench).collect())) == plain and {(r[0], r[1]) for r in plain} >= {(i, i % 20) for i in range(200)}


def test_common_phrases_alone_make_no_pairs():
    """Only documents with a rare word of an item meet it, and none that an alignment could reach is left out."""
    items = [f"as one of the many people who {made(14, RARE)} in the end of the day" for _ in range(40)]
    texts = [f"{made(30)} one of the many people who {made(40)} in the end of the day" for _ in range(30)] + [f"{made(20)} {items[3]} {made(5)}"]
    held = pa.table({"ref": pa.array(range(len(items)), pa.int64()), "words": hashed(items)})
    index = decontaminate.Index.of(held, 3, 0.5)
    (_, found, hashes), = decontaminate._words(pa.array(texts))
    owner, item, _ = decontaminate.find_pairs(found, hashes, index)
    assert (30, 3) in set(zip(owner.tolist(), item.tolist(), strict=True))
    want = {(i, j) for i, t in enumerate(texts) for j, x in enumerate(items) if full_score(plain_words(x), plain_words(t)) >= len(plain_words(x))}
    assert want <= set(zip(owner.tolist(), item.tolist(), strict=True)) and len(set(zip(owner.tolist(), item.tolist(), strict=True))) < 0.2 * len(items) * len(texts)


# --- op8: blocks and epochs ---


def test_blocks_hold_their_share_and_epochs_follow_each_other(spark):
    rows = [(i, made(rng.randrange(0, 30)), "en", ["big", "mid", "small", None][min(3, int(rng.expovariate(1.2)))], 1) for i in range(900)] + [(5000, None, "en", "mid", 1)]
    table = document_table(spark, rows + rows[:40])
    tokens = spark.createDataFrame([(r[3], len(words(r[1])) + 1) for r in rows + rows[:40]], "_source string, _tokens long")
    weights = {r._source: (r.weight, r.quota, r.tokens) for r in mixing.source_weights(tokens, None, 3.0, 20000)[0].collect()}
    size = 2000
    plan = mixing.mixing_plan(table, repetition=3.0, budget=20000, block_tokens=size).collect()
    longest = max(r.n_tokens for r in plan)
    times = Counter((r[0], r[1], r[3]) for r in rows + rows[:40])
    for source, (weight, quota, total) in weights.items():
        uses = [r for r in plan if r.source == source]
        assert quota <= sum(r.n_tokens for r in uses) < quota + longest
        for epoch in range(1 + max(r.epoch for r in uses)):
            now = Counter(r.doc_id for r in uses if r.epoch == epoch)
            have = Counter({k[0]: n for k, n in times.items() if k[2] == source})
            assert now == have if (epoch + 1) * total <= quota else not now - have
            assert max(r.block for r in uses if r.epoch == epoch) <= min([r.block for r in uses if r.epoch == epoch + 1], default=10**9)
        per = Counter()
        for r in uses:
            per[r.block] += r.n_tokens
        assert sorted(per) == list(range(len(per))) and all(abs(per[b] - weight * size) < longest for b in sorted(per)[:-1])


def test_limits_that_no_exponent_meets(spark):
    shares = spark.createDataFrame([(0.5,), (0.5,)], "p double")
    assert mixing.fit_exponent(shares, entropy=0.1) == 1.0 and mixing.fit_exponent(shares, repetition=2.0, budget_ratio=50.0) == 1.0


# --- rules whose host and path run together ---


def test_host_and_path_are_apart(spark):
    rules = spark.createDataFrame([("com", "x", "block"), ("org", "", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://comx"), (2, "http://com"), (3, "http://a.org/x")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urlrules.judge_urls(pages, rules).collect()} == {1: "allow", 2: "allow", 3: "block"}


# --- odd tables ---


def test_odd_documents_go_through_every_operator(spark):
    table = document_table(spark, ODD)
    bench = spark.createDataFrame([(1, made(40)), (None, "same text same text same"), (2, None)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0), (3, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    pages = lambda d: d.select(F.col("doc_id").alias("page_id"), F.lit("http://a.com/x").alias("url"), F.col("text").alias("html"), *[c for c in d.columns if c not in ("doc_id", "text")])

    def archive(d):
        folder = warc.archive_folder(spark)
        warc.write_archive(warc.with_records(pages(d)), folder)
        return warc.read_archive(spark, folder).select(F.col("id"), "payload_bytes", "payload_digest", "kind", "refers", "sound")

    operators = {
        "shards": lambda d: sharding.shard_manifest(d, 8).select("doc_id", "size", "text_crc32", "shard", "grown_shard"),
        "contaminated": lambda d: decontaminate.contaminated(d, bench),
        "components": lambda d: jaccard.jaccard_components(d),
        "tokens": lambda d: tokencounts.section_tokens(d).drop("part"),
        "archive": archive,
        "mixing": lambda d: mixing.mixing_plan(d).select("doc_id", "n_tokens"),
        "toxicity": lambda d: toxicity.score_toxicity(d, labels).select("doc_id", "score"),
        "quality": lambda d: quality.judge_documents(d),
        "rules": lambda d: urlrules.judge_urls(pages(d), spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")).select("page_id", "rule", "verdict"),
    }
    rows = {"shards": len(ODD), "components": len(ODD), "archive": len(ODD), "toxicity": len(ODD), "quality": len(ODD), "rules": len(ODD)}
    for name, operator in operators.items():
        plain = Counter(map(tuple, operator(table).collect()))
        assert Counter(map(tuple, operator(clashing(table)).collect())) == plain, name
        assert operator(table.limit(0)).collect() == [], name
        if name in rows:
            assert sum(plain.values()) == rows[name], name
        if name == "contaminated":
            assert {(k[0], k[1]) for k in plain} == {(7, None)} and sum(plain.values()) == 1
        if name == "components":
            assert {k[2] for k in plain if k[0] == 7} == {7} and {k for k in plain if k[0] in (3, 4)} == {(3, 0, 3), (4, 0, 4)}
        if name == "mixing":
            assert all(sum(n for k, n in plain.items() if k[0] == key) >= times for key, times in Counter(r[0] for r in ODD).items())
        if name == "archive":
            assert all(k[5] for k in plain) and not any(k[3] == "revisit" for k in plain)  # rows of the smallest key are all responses


def test_slots_of_a_row_repeated_past_a_block(spark):
    many = spark.range(10000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("a").alias("text")).union(spark.createDataFrame([(6, "b")], "doc_id long, text string"))
    got = sharding.shard_manifest(many, 1).select("doc_id", "slot").collect()
    assert sorted(r.slot for r in got) == list(range(10001))


# --- frequent keys ---


def test_frequent_keys_are_joined_like_others(spark):
    left = spark.createDataFrame([(i % 3 if i < 900 else i, i) for i in range(1000)], "k long, v long")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("times"), F.max("v").alias("top"))
    want = Counter(map(tuple, left.join(right.drop("times"), "k").collect()))
    for rows, often, limit in ((None, 1000, 100), (None, 10, 1000), (5000, 1, 1), (None, 10**6, 10**6), (103, 1, 200)):
        assert Counter(map(tuple, common.skewed_join(left, right, "k", "times", 1000, rows, often, limit).collect())) == want


def test_large_families_and_their_hubs(spark):
    star = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(50)]
    for few in (0, 10**6):
        got = dict(map(tuple, components.components(spark.createDataFrame(star, "a long, b long"), few).collect()))
        assert got == {i: 0 for i in range(1, 300)} | {1001 + i: 1000 for i in range(50)}


def test_rows_are_told_apart_with_their_nulls(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("x", "x"), (None, None), ("", None)], "a string, b string")
    assert df.select(common.row_hash(df)).distinct().count() == 5
    assert common.fresh(df.withColumn("_row", F.lit(1)).withColumn("__ROW", F.lit(1)), "row") == "___row"
    many = common.repeated(spark.createDataFrame([(1, 1), (2, 9000)], "id int, times long"), "times", "n")
    assert [(r.id, r.c, r.lo, r.hi) for r in many.groupBy("id").agg(F.count_distinct("n").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi")).orderBy("id").collect()] == [(1, 1, 0, 0), (2, 9000, 0, 8999)]


def test_filter_forgets_nothing(spark):
    values = np.random.default_rng(3).integers(-(2**63), 2**63, 5000)
    cells = bloom.build(spark.createDataFrame([(int(v),) for v in values], "h long").repartition(4), "h")
    assert bloom.may_hold(cells, values.view(np.uint64)).all()
    others = np.random.default_rng(4).integers(-(2**63), 2**63, 100000).view(np.uint64)
    assert bloom.may_hold(cells, others).mean() < 0.01
    assert not bloom.may_hold(bloom.build(spark.range(0).withColumnRenamed("id", "h"), "h"), others).any()
