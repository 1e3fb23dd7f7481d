import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from thylakoid.llm import boosting, components, decontaminate, jaccard, mixing, quality, sharding, tokencounts, toxicity, urlrules, warc
from thylakoid.llm.tokencounts import VOCABULARY

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {c: c + 32 for c in range(65, 91)}
VOCAB = [f"w{i}" for i in range(60)]


def docs(spark, texts, extra=""):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    make = lambda n: " ".join(rng.choice(VOCAB) for _ in range(n))
    out = [None, "", " \n\t", "One", "one two three", "ONE TWO three"]
    for _ in range(25):
        base = make(rng.randrange(5, 300)).split(" ")
        out.append(" ".join(base))
        for _ in range(rng.randrange(0, 4)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(VOCAB)
            out.append(" ".join(copy))
    return out + ["word " * 30000, "x" * 100000, out[7], out[7]]


# --- sharding ---


def plain_jump(key, n):
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_is_the_published_loop():
    keys = np.array([0, 1, -1, 7, 2**62, -(2**63)], dtype=np.int64)
    for n in (1, 2, 8, 1000):
        assert sharding.jump(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]
    many = np.random.default_rng(0).integers(-(2**63), 2**63, 20000)
    a, b = sharding.jump(many, 8), sharding.jump(many, 9)
    assert ((a == b) | (b == 8)).all() and 0.08 < (a != b).mean() < 0.14


def test_manifest(spark, texts):
    rows = sharding.shard_manifest(docs(spark, texts).union(docs(spark, texts[:20])), 8, bins=3).collect()
    assert len(rows) == len(texts) + 20
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_manifest(docs(spark, texts).limit(0), 8).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, "a")], "doc_id long, text string")
    assert len({r.shard for r in sharding.shard_manifest(nulls, 8).collect()}) == 1


# --- URL rules ---


def test_urls_against_brute_force(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("b.net", "/es/x", "allow"), ("b.net", "/es/x", "block")]
    urls = [None, "", "nothing", "http://", "https://WWW.Example.com/en/1?q", "http://example.com/en/", "http://example.com/EN/", "http://xexample.com/en/", "http://a.b.net/es/xy#t", "http://net/es/", "http://c.net/fr", "x://a.com", "://com/?a", "http://a.com://b.net/es/x", "http://" + "a." * 3000 + "com/" + "p" * 5000]
    urls += urls[4:6]
    pages = spark.createDataFrame([(i, u, "host?") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in urlrules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
        fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, 0, None, "allow"))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, best[3], best[4])
    assert urlrules.judge_urls(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in urlrules.judge_urls(pages, empty).collect()} == {"allow"}


# --- quality rules ---


def test_measures_against_brute_force(spark, texts):
    more = [*texts, "a b\na b\n\n \n \na b", "# ## é€ | x", "a b c a b c", "l1\r\nl1\nl1"]
    got = {r.doc_id: r for r in quality.judge_documents(docs(spark, more)).collect()}
    assert len(got) == len(more)
    for i, text in enumerate(more):
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        runs = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j + k for j in range(len(w) - 2) if runs[w[j], w[j + 1], w[j + 2]] > 1 for k in range(3)}
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert tuple(got[i][k] for k in quality.MEASURES) == expected
        assert got[i].base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    assert quality.judge_documents(docs(spark, more).limit(0)).count() == 0


def test_bad_hosts_go_and_small_hosts_are_shrunk(spark):
    good = " ".join(f"u{i}" for i in range(80))
    rows = [(i, "short" if i % 10 else good, "bad") for i in range(200)] + [(1000 + i, good, f"h{i % 20}") for i in range(400)] + [(5000, "short", None), (5001, good, None)]
    got = {r.doc_id: r.kept for r in quality.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[i] for i in range(200)) and all(got[1000 + i] for i in range(400)) and got[5001]


# --- Jaccard join ---


def brute_components(texts, n, num, den):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and den * c >= num * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [(i, len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("n", "num"), [(4, 85), (5, 80), (1, 60)])
def test_components_against_brute_force(spark, texts, monkeypatch, n, num):
    monkeypatch.setattr(jaccard, "PIECE", 4)
    monkeypatch.setattr(components, "FEW_EDGES", 0 if n == 5 else 10**6)
    got = sorted(map(tuple, jaccard.jaccard_components(docs(spark, texts), n=n, num=num).collect()))
    assert got == brute_components(texts, n, num, 100)


def test_only_sets_that_are_compared_again_are_moved_again(spark, monkeypatch):
    base = [f"w{i}" for i in range(24)]
    families = [[*base[:20], *[f"{side}{i}" for i in range(4)]] for side in "ab"]  # they share parts but don't link
    texts = [" ".join([*family[:i], f"own{i}{family[-1]}", *family[i + 1 :]]) for family in families for i in range(12)]
    texts += [" ".join([*[f"p{i}x{j}" for j in range(20)], end]) for i in range(10) for end in ("y", "z")]
    moved, links = [], jaccard._links
    monkeypatch.setattr(jaccard, "PIECE", 4)
    monkeypatch.setattr(jaccard, "_links", lambda members, sets, num, den: moved.append((sets.count(), members.select("set_id").distinct().count())) or links(members, sets, num, den))
    got = sorted(map(tuple, jaccard.jaccard_components(docs(spark, texts), n=1, num=80).collect()))
    assert got == brute_components(texts, 1, 80, 100)
    assert len(moved) == 2 and moved[1][0] == moved[1][1] < moved[0][0]


def test_components_of_very_many_sets(spark, texts, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, jaccard.jaccard_components(docs(spark, texts), n=4, num=85).collect())) == brute_components(texts, 4, 85, 100)


def test_shuffle_files_go_with_their_query(spark, texts, tmp_path):
    stored = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    before = stored()
    assert jaccard.jaccard_components(docs(spark, texts), n=4, num=85).count() == len(texts)
    assert stored() <= before


def test_components_of_odd_tables(spark):
    assert jaccard.jaccard_components(docs(spark, []).limit(0)).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "A  b"), (None, None)], "doc_id long, text string")
    assert sorted(map(str, (r.component_id for r in jaccard.jaccard_components(rows).collect()))) == ["3", "3", "3", "None"]


def test_star_contraction(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)]
    for few in (0, 1000):
        got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long"), few).collect()))
        assert got == {i: 0 for i in range(1, 41)} | {101: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination ---


def slow_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_against_the_full_matrix():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(0, 12)), rng.integers(0, 4, rng.integers(0, 15))
        assert decontaminate.align(a, b)[0] == slow_alignment(a.tolist(), b.tolist())


def test_copies_are_found_and_others_left(spark):
    rng = random.Random(4)
    make = lambda n: [rng.choice(VOCAB) for _ in range(n)]
    items = [make(40), make(25), ["tiny", "Item"], make(60)]
    edited = [w if i % 7 else "changed" for i, w in enumerate(items[0])]
    gapped = items[3][:20] + ["extra"] * 2 + items[3][22:]
    clean = [make(200) for _ in range(20)]
    texts = [make(50) + edited + make(50), gapped, make(30) + items[1], ["the", "TINY,", "item!"], make(10) + items[0][:8] + make(30), *clean]
    table = docs(spark, [" ".join(t) for t in texts] + [None, "", " ".join(texts[1])])
    bench = spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(items)] + [(9, None, "x"), (10, "...", "x")], "item_id long, text string, lang string")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(table, bench).collect())
    assert got == [(0, 0), (1, 3), (2, 1), (3, 2), (27, 3)]
    assert decontaminate.contaminated(table.limit(0), bench).count() == 0
    assert decontaminate.contaminated(table, bench.limit(0)).count() == 0


def test_frequent_edited_copies_are_found_beside_a_whole_one(spark):
    item = [f"q{i}" for i in range(40)]
    edited = [w if i % 7 else "changed" for i, w in enumerate(item)]
    table = docs(spark, [" ".join(item)] + [" ".join(edited)] * 2000 + ["q1 q2 q3 q4 " + " ".join(VOCAB)])
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.contaminated(table, bench).collect()) == list(range(2001))


def test_no_reachable_alignment_is_spared():
    rng = np.random.default_rng(5)
    for _ in range(500):
        a, b = rng.integers(0, 6, rng.integers(1, 12)), rng.integers(0, 8, rng.integers(0, 40))
        assert decontaminate.reachable(a, b, 0.5) or slow_alignment(a.tolist(), b.tolist()) < len(a)


# --- token counts ---


def test_tokens_of_lines(spark, texts):
    more = [t for t in texts if t is None or len(t) < 5000] + ["a\nbé\n\nc", "\n", "x y"]
    got = defaultdict(list)
    for r in tokencounts.section_tokens(docs(spark, more)).collect():
        got[r.doc_id].append(r)
    coder, _ = tokencounts.encoder(open(VOCABULARY, "rb").read(), tokencounts.PATTERN)
    for i, text in enumerate(more):
        n = len(coder.encode_ordinary(text or ""))
        rows = sorted(got[i], key=lambda r: r.section)
        assert sum(r.n_tokens for r in rows) == n and all(r.n_document == n for r in rows)
        assert b"".join((text or "").encode()[r.start_byte : r.end_byte] for r in rows).decode() == (text or "")


def test_attribution_rules():
    ends, start, stop = np.array([2, 5, 9, 10]), np.array([0, 3, 8]), np.array([3, 8, 9])
    assert tokencounts.attribute(ends, start, stop, "start")[0].tolist() == [0, 0, 1, -1]
    owner, crosses = tokencounts.attribute(ends, start, stop, "most")
    assert owner.tolist() == [0, 1, 1, -1] and crosses.tolist() == [False, True, True, False]


# --- WARC ---


def test_archive_round_trip(spark):
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    long = "é" * 80
    html = [None, "", "a", "a", long, long, "x" + trap * 3 + "y", trap + long, trap, "z" * 300000, "\r\n\r\n" + long, long, "WARC/1.1\r\n"]
    rows = [(i, f"http://h/{i}\r\nWARC-Type: x", t, "t") for i, t in enumerate(html)] + [(None, None, "n", "t"), (4, "u", long, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, kind string").repartition(3)
    folder = warc.archive_folder(spark)
    warc.write_archive(warc.with_records(pages), folder)
    got = warc.read_archive(spark, folder).collect()
    assert len(got) == len(rows) and all(r.sound for r in got)
    first = {}
    for i, t in enumerate(html):
        first.setdefault(t or "", i)
    expected = []
    for i, _, t, _ in rows:
        raw = (t or "").encode()
        again = len(raw) >= 100 and first.get(t or "") != i
        expected.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[t or ""] if again else None))
    assert sorted(map(str, ((r.id, r.payload_bytes, r.payload_digest, r.kind, r.refers) for r in got))) == sorted(map(str, expected))
    cut = warc.scan_candidates(spark, folder).count()
    assert cut > len(rows) + 3


# --- mixing ---


def test_exponent_and_plan(spark):
    rows = [(i, " ".join(["w"] * (5 + i % 7)), "big" if i % 10 else ("b" if i % 20 else None)) for i in range(600)]
    table = spark.createDataFrame(rows + rows[:50], "doc_id long, text string, source string")
    plan = mixing.mixing_plan(table, repetition=2.0, block_tokens=500).collect()
    totals = Counter()
    for _, t, s in rows + rows[:50]:
        totals[s] += t.count("w") + 1
    used = Counter()
    for r in plan:
        used[r.source] += r.n_tokens
    p = {s: n / sum(totals.values()) for s, n in totals.items()}
    a = 1 - math.log(2) / math.log(max(p.values()) / min(p.values()))
    aim = {s: p[s] ** a / max(p.values()) ** a * max(totals.values()) for s in p}
    for s in p:
        assert aim[s] - 1 <= used[s] < aim[s] + 14
    assert {r.doc_id for r in plan} == set(range(600))
    blocks = defaultdict(list)
    for r in plan:
        blocks[r.block].append(r)
    assert all(sorted(r.slot for r in b) == list(range(len(b))) for b in blocks.values())
    assert mixing.mixing_plan(table.limit(0)).count() == 0
    assert mixing.mix(table).count() == len(mixing.mixing_plan(table).collect())


def test_entropy_target(spark):
    shares = spark.createDataFrame([(0.9,), (0.06,), (0.04,)], "p double")
    a = mixing.fit_exponent(shares, entropy=0.8)
    w = np.array([0.9, 0.06, 0.04]) ** a
    w /= w.sum()
    assert -(w * np.log(w)).sum() == pytest.approx(0.8 * math.log(3), abs=1e-6)
    assert mixing.fit_exponent(shares) == 0.0 and mixing.fit_exponent(shares.limit(1), entropy=0.5) == 1.0


# --- toxicity ---


def test_toxic_texts_are_told_apart(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice(VOCAB) for _ in range(rng.randrange(20, 120))]
        toxic = int(i % 6 == 0)
        if toxic:
            bad = rng.choice(["glonk", "frumpo", "zadd"])
            w[rng.randrange(len(w))] = bad if i % 12 else bad.replace("o", "0").replace("a", "@")
        rows.append((i, " ".join(w), None))
        labels.append((i, toxic))
    extra = [(1000, None, None), (1001, "", None), (1002, "w1 " * 20000, None)]
    table = spark.createDataFrame(rows + extra, "doc_id long, text string, score string")
    known = spark.createDataFrame([x for x in labels if x[0] % 3] + [(None, 1), (5, None)], "doc_id long, toxic int")
    known = known.union(spark.createDataFrame([x for x in labels if x[0] % 3 == 0 and x[0] < 450], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(table, known).collect()}
    assert len(got) == 903 and all(0 <= s <= 1 for s in got.values())
    held = [i for i in range(450, 900) if i % 3 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 6 == 0) for i in held]) > 0.95
    assert toxicity.score_toxicity(table.limit(0), known).count() == 0
    assert len({r.score for r in toxicity.score_toxicity(table.limit(20), known.limit(0)).collect()}) == 1


def test_isotonic_pools():
    knots, values = boosting.isotonic(np.array([1.0, 2.0, 3.0, 4.0]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert values.tolist() == [0, 0, 0.5, 0.5, 1, 1] and knots.tolist() == [1, 1, 2, 3, 4, 4]
