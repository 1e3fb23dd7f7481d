import hashlib
import json
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from thylakoid.llm import crosstoken

rng = random.Random(6)
WORDS = ["the", "Über", "école", "niño", "don't", "12345", "x=1;", "日本語", "🙂🙂", "==", "  ", "\n", "\t", "a b", " ", "“quoted”", "　", "\u0085", "wörterbuch", "<|endoftext|>", "<s>", "<0x41>", "\r\n", "é", "\x1c", "\x7f", "᠎", "​"]
MADE = ["".join(rng.choice(WORDS) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randrange(1, 40))) for _ in range(120)]
ODD = [None, "", " ", "  ", "a ", "a  ", " a", "\n", " \n ", "a\n", "▁", "a▁b c", "\x00", "a\x00 b", "x" * 3000, "ab" * 2000 + " " * 500 + "c", "word " * 5000, "   ", "=" * 1000 + " " + "-" * 777, "日本" * 300]
ROWS = [(i, t) for i, t in enumerate(MADE + ODD)] + [(2, MADE[2])] * 3 + [(None, MADE[0]), (None, None)]


@pytest.fixture(scope="module")
def tools():
    first = Tokenizer.from_file(crosstoken.BYTE_LEVEL)
    first.encode_special_tokens = True
    spec = json.load(open(crosstoken.BYTE_LEVEL))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    of = {i: t for t, i in spec["model"]["vocab"].items()}
    second = sentencepiece.SentencePieceProcessor(model_file=crosstoken.PIECES)
    def a(text):
        return [(i, bytes(letters[c] for c in of[i])) for i in first.encode(" " + text, add_special_tokens=False).ids]
    def b(text):
        return [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()) for i in second.encode(text) for p in [second.id_to_piece(i)]]
    return a, b


def groups(text, tools):
    if not text:
        return []
    sides = [tool(text) for tool in tools]
    if any(b"".join(x for _, x in side) != b" " + text.encode() for side in sides):
        return []
    ends = []
    for side in sides:
        at = 0
        ends.append([at := at + len(x) for _, x in side])
    out, x, y = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        i, j = ends[0].index(cut, x) + 1, ends[1].index(cut, y) + 1
        out.append(([t for t, _ in sides[0][x:i]], [t for t, _ in sides[1][y:j]]))
        x, y = i, j
    return out


def brute(rows, tools):
    every = [groups(t, tools) for _, t in rows]
    counts, best = Counter(), defaultdict(int)
    for found in every:
        counts.update({(a, b) for x, y in found for a in x for b in y})
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = Counter()
    for (key, _), found in zip(rows, every, strict=True):
        links = [(a, b) for x, y in found for a in x for b in y]
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)
        out[(key, sum(len(x) for x, _ in found), sum(len(y) for _, y in found), len(found), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(spelled.encode()).hexdigest() if found else "")] += 1
    return out


def aligned(spark, rows, **how):
    return Counter(map(tuple, crosstoken.align_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **how).collect()))


@pytest.mark.parametrize(("size", "sent"), [(1 << 23, 10**6), (2000, 10**6), (2000, 0)])
def test_tables_against_brute_force(spark, tools, size, sent, monkeypatch):
    monkeypatch.setattr(crosstoken, "SEGMENTS", 50 if size == 2000 else 10**5)
    monkeypatch.setattr(crosstoken, "LOOKED_AT", 30 if size == 2000 else 10**5)
    want = brute(ROWS, tools)
    assert aligned(spark, ROWS, chunk_bytes=size, sent=sent) == want
    assert sum(n for k, n in want.items() if k[1] == 0) < len(ROWS) // 4


def test_segments_have_the_tokens_of_their_texts(tools):
    files = [open(p, "rb").read() for p in (crosstoken.BYTE_LEVEL, crosstoken.PIECES)]
    own = crosstoken.Vocabularies(*files)
    assert own.splits
    import numpy as np

    for _, text in ROWS:
        if not text:
            continue
        raw = text.encode()
        data, start, stop, counts = crosstoken.split(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), True)
        parts = [data[x:y].tobytes() for x, y in zip(start, stop, strict=True)]
        assert b"".join(parts) == b" " + raw and counts[0] == len(parts)
        for side, tool in enumerate(tools):
            assert [t for p in parts for t in tool(p.decode()[1:])] == tool(text), (side, text)


def test_no_splits_where_vocabularies_may_merge():
    spec = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}}
    probe = ["▁a", "▁▁", "b", "▁"]
    assert crosstoken.may_split(spec, ["▁a", "▁▁", "b"], probe)
    assert not crosstoken.may_split(spec, ["a▁b"], probe) and not crosstoken.may_split(spec, ["a"], ["▁a", "▁b"])
    assert not crosstoken.may_split({"normalizer": {}, "pre_tokenizer": spec["pre_tokenizer"]}, [], probe) and not crosstoken.may_split({}, [], probe)


def test_large_groups_and_whole_texts(spark, tools, monkeypatch):
    monkeypatch.setattr(crosstoken, "LAID_OUT", 1)
    import numpy as np

    own = crosstoken.Vocabularies(*[open(p, "rb").read() for p in (crosstoken.BYTE_LEVEL, crosstoken.PIECES)])
    texts = [t for _, t in ROWS if t][:60]
    found = crosstoken.align([b" " + t.encode() for t in texts], own)
    linked = crosstoken.read_groups(*crosstoken.unpack_texts(crosstoken.pack_texts(found)))
    for i, text in enumerate(texts):
        links = Counter((a << 32) | b for x, y in groups(text, tools) for a in x for b in y)
        own_links = slice(linked.first[i], linked.first[i + 1])
        assert dict(zip(linked.pair[own_links].tolist(), linked.times[own_links].tolist(), strict=True)) == links
        assert (linked.n_links[i], linked.n_groups[i], bool(linked.sound[i])) == (sum(links.values()), len(groups(text, tools)), bool(links))


def test_odd_tables(spark, tools):
    docs = spark.createDataFrame(ROWS[:30], "doc_id long, text string")
    assert crosstoken.align_tokens(docs.limit(0)).collect() == []
    assert aligned(spark, [(1, None), (2, "")]) == brute([(1, None), (2, "")], tools)
    clash = docs.withColumns({c: F.lit(c) for c in ("key", "keys", "chunk", "h", "t", "pair", "n", "a", "groups", "n_a", "payload", "segments")})
    assert Counter(map(tuple, crosstoken.align_tokens(clash).collect())) == brute(ROWS[:30], tools)
