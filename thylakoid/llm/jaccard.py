"""N-gram Jaccard join with a token-group matrix, exact, and the components of its links.

1. Each text becomes the set of its word shingles, as 64-bit hashes; equal sets are one set from
   then on, with its copies as members.
2. Similar sets are put into groups.  The hash range is cut into more parts than a linked pair can
   differ in, so by the pigeonhole principle linked sets agree on a whole part; sets that agree on
   a part form a group, named by the one that meets most others.  A part is a few tokens from random places of
   the text, so unrelated texts that share a passage hardly ever agree on one.
3. A group is opened in pieces of ``PIECE`` sets.  A piece is a token-group matrix: it is
   partitioned again into blocks of like sets, each with the union of its tokens; a set's overlap
   with a union bounds its overlap with every set of the block, and only blocks whose bound
   reaches the threshold are opened and counted exactly.
4. Sets of a group that its own pieces leave in more than one component are compared across
   pieces, but for pieces that lie in one component already.

Links between sets of one component that add nothing to it are not written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm import bloom
from thylakoid.llm.common import BROADCAST_ROWS, bounded_batches, durable, fresh, let_go, row_hash, sized_join, skewed_join
from thylakoid.llm.components import Forest, components
from thylakoid.llm.textkit import LOWER, U64, as_long, blocks, combine, find_words, hash_spans, mix, ngrams

#: Sets in a piece of a group, and in a block of its matrix.
PIECE, BLOCK = 256, 16
#: Columns of a piece's matrix that are laid out at once.
COLUMNS = 4096


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; a text of fewer words is one shingle as a whole."""
    for block in blocks(column):
        data = LOWER[block.data]
        words = find_words(data, block.offsets)
        hashes = hash_spans(data, words.start, words.end)
        runs, at = ngrams(words, hashes, n)
        cut = np.searchsorted(at, words.first)
        for i in range(block.hi - block.lo):
            lo, hi = words.first[i], words.first[i + 1]
            if hi - lo >= n:
                yield np.unique(runs[cut[i] : cut[i + 1]])
            else:
                yield combine(hashes[lo:hi], hi - lo) if hi > lo else np.zeros(0, dtype=U64)


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, the same in any order."""
    return int(mix(mix(shingles).sum(dtype=U64)[None] + U64(len(shingles))).view(np.int64)[0])


def part_hashes(shingles: np.ndarray, num: int, den: int) -> np.ndarray:
    """Hashes of parts of a set, such that two sets of Jaccard num/den or more share one.

    Sizes from 2^c to 2^(c+1)-1 are class c.  A pair is met in the class of its larger set, so a
    set also takes part in the next class if it could link with a set there.  In a class the hash
    range is cut into more parts than a linked pair can differ in tokens.  A set that differs from
    any set linked with it in d tokens at most gives only its fuller parts: those of so many tokens
    that there are more than d of them, for then one is untouched.  Of a linked pair, the set that
    asks for more tokens has an untouched part of that many, and the other gives it as well.
    Fuller parts are shared by chance less often.  Empty parts are given only by a set that has no
    more than d others.
    """
    size = len(shingles)
    if not size:
        return shingles
    most = size * den // num
    mixed = mix(shingles)
    found = []
    for level in range(size.bit_length() - 1, most.bit_length()):
        top = (2 << level) - 1
        apart = (den - num) * 2 * top // (den + num)
        parts = apart + 1 + max(apart // 4, 2 * (apart > 0))
        part = ((shingles >> U64(32)) * U64(parts)) >> U64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        salt = U64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        own = (den - num) * (size + min(most, top)) // (den + num)
        hashes = mix(np.add.reduceat(mixed, first) + mix(part[first] + salt))
        if len(first) > own:
            held = np.diff(np.append(first, size))
            found.append(hashes[held >= np.partition(held, len(held) - own - 1)[len(held) - own - 1]])
        else:
            empty = np.setdiff1d(np.arange(parts, dtype=U64), part[first])
            found += [hashes, mix(mix(empty + salt) ^ U64(0x5851F42D4C957F2D))]
    return np.concatenate(found)


def linked(sets: list[np.ndarray], num: int, den: int, same: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that join ``sets`` into the components of all links; ``same`` names components known before."""
    n = len(sets)
    forest = Forest(n)
    if same is not None:
        first: dict[int, int] = {}
        for i, c in enumerate(same):
            forest.join(first.setdefault(c, i), i)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if den * common >= num * (int(size.sum()) - common) and forest.join(0, 1) else []

    order = np.lexsort((size, [int(s[0]) for s in sets]))
    sets, size = [sets[i] for i in order], size[order]
    tokens, row = np.concatenate(sets), np.repeat(np.arange(n), size)
    by = np.argsort(tokens, kind="stable")
    tokens, row = tokens[by], row[by]
    column = np.cumsum(np.concatenate([[0], tokens[1:] != tokens[:-1]])) if len(tokens) else tokens.astype(np.int64)
    shared = np.bincount(column)[column] > 1
    row = row[shared]
    column = np.cumsum(np.concatenate([[0], np.diff(column[shared]) != 0])) if shared.any() else np.zeros(0, dtype=np.int64)
    width = int(column[-1]) + 1 if len(column) else 0
    cuts = list(range(0, width, COLUMNS))
    at = np.searchsorted(column, [*cuts, width])

    def laid_out(i: int) -> np.ndarray:
        dense = np.zeros((n, min(COLUMNS, width - cuts[i])), dtype=np.float32)
        dense[row[at[i] : at[i + 1]], column[at[i] : at[i + 1]] - cuts[i]] = 1
        return dense

    begins = np.arange(0, n, BLOCK)
    bound = np.zeros((n, len(begins)))
    for i in range(len(cuts)):
        dense = laid_out(i)
        bound += dense @ np.maximum.reduceat(dense, begins, axis=0).T
    least, most = np.minimum.reduceat(size, begins), np.maximum.reduceat(size, begins)
    opened = (bound * (den + num) >= num * (size[:, None] + least)) & (most * den >= num * size[:, None]) & (least * num <= den * size[:, None])
    found: list[tuple[int, int]] = []
    opened = [(b, np.flatnonzero(opened[:, j])) for j, b in enumerate(begins)]
    counts = [np.zeros((len(q), min(BLOCK, n - b))) for b, q in opened]
    for i in range(len(cuts)):
        dense = laid_out(i)
        for (b, q), count in zip(opened, counts, strict=True):
            if len(q):
                count += dense[q] @ dense[b : b + BLOCK].T
    for (b, q), count in zip(opened, counts, strict=True):
        ok = den * count >= num * (size[q][:, None] + size[b : b + BLOCK] - count)
        for x, y in zip(*np.nonzero(ok), strict=True):
            i, j = int(order[q[x]]), int(order[b + y])
            if i != j and forest.join(i, j):
                found.append((i, j))
    return found


def stars(names: list[int], links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links of each component's members with its smallest name, so that they are soon contracted."""
    order = sorted({i for link in links for i in link}, key=lambda i: names[i])
    place = {i: k for k, i in enumerate(order)}
    forest = Forest(len(order))
    for i, j in links:
        forest.join(place[i], place[j])
    return [(names[i], names[order[forest.root(k)]]) for k, i in enumerate(order) if forest.root(k) != k]


def _open_groups(num: int, den: int):
    """Of rows in order of ``grp`` and ``piece``: the links found among the sets of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, same, sets = None, [], [], []
        a, b = [], []

        def close() -> None:
            if len(names) > 1:
                for i, j in stars(names, linked(sets, num, den, same)):
                    a.append(i)
                    b.append(j)

        for batch in batches:
            tokens = batch.column(4)
            flat, ends = tokens.values.to_numpy().view(U64), tokens.offsets.to_numpy()
            for i, (g, p, name, known) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True)):
                if (g, p) != key:
                    close()
                    key, names, same, sets = (g, p), [], [], []
                if name not in names[-1:]:
                    names.append(name)
                    same.append(known)
                    sets.append(flat[ends[i] : ends[i + 1]].copy())
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a.clear()
                b.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _links(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links among the sets of each (grp, piece) of ``members`` (grp, piece, set_id, known)."""
    rows = members.join(sets, "set_id").select("grp", "piece", "set_id", "known", "tokens")
    rows = rows.repartition("grp", "piece").sortWithinPartitions("grp", "piece", "set_id")
    return rows.mapInArrow(_open_groups(num, den), "a long, b long")


def _dealt(members: DataFrame, keys: list[str], size: int, total: int) -> DataFrame:
    """``members`` (``total`` at most) dealt by a hash of ``set_id`` into ``pieces`` pieces of about ``size`` for each value of ``keys``: ``piece`` from 0."""
    rows = members.withColumn("_of", row_hash(members, keys))
    sizes = rows.groupBy("_of").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / size).alias("pieces"))
    rows = skewed_join(rows, sizes, "_of", "n", total).drop("_of")
    return rows.withColumn("piece", F.pmod(F.xxhash64(F.lit(9), "set_id"), F.col("pieces")))


def set_components(docs: DataFrame, text: str, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Every row of ``docs`` (its other columns, ``set_id``, ``n_shingles``), and ``node`` and ``root`` of linked sets."""
    spark = docs.sparkSession
    bounded_batches(spark)
    let_go(spark)
    others = [c for c in docs.columns if c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)

    def name_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), set_id(s) if len(s) else None) for s in shingle_sets(batch.column(batch.num_columns - 1), n)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([x[1] for x in found], pa.int64()), pa.array([x[0] for x in found], pa.int64())], [*others, "set_id", "n_shingles"]
            )

    def cut_sets(filtered):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen: dict[int, np.ndarray] = {}
                for s in shingle_sets(batch.column(0), n):
                    if len(s) and (name := set_id(s)) not in seen:
                        seen[name] = part_hashes(s, num, den)
                if seen:
                    parts = np.concatenate(list(seen.values()))
                    names = np.repeat(np.array(list(seen), dtype=np.int64), [len(v) for v in seen.values()])
                    if filtered is not None:
                        kept = bloom.may_hold(filtered.value, parts)
                        parts, names = parts[kept], names[kept]
                    yield pa.RecordBatch.from_arrays([as_long(parts), pa.array(names)], ["part", "set_id"])

        return run

    named = durable(docs.select(*others, F.col(text)).mapInArrow(name_sets, ", ".join([*([schema] if schema else []), "set_id long", "n_shingles long"])))
    # parts that several sets have are counted first, so that none has to be gathered in one task
    common = docs.select(text).mapInArrow(cut_sets(None), "part long, set_id long").groupBy("part").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi"), F.count(F.lit(1)).alias("n"))
    common = durable(common.filter("lo < hi").select("part", "n", F.col("n").alias("times")))
    n_common, total = common.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    wide = spark.sparkContext.broadcast(bloom.build(common, "part", n_common))
    shared = durable(docs.select(text).mapInArrow(cut_sets(wide), "part long, set_id long").distinct())
    shared = durable(skewed_join(shared, common, "part", "times", total, n_common))
    # a part's group is named by its set that meets most others, so that a family has few groups
    met = shared.join(shared.groupBy("set_id").agg(F.sum("n").alias("met")), "set_id")
    named_by = met.groupBy("part").agg(F.max(F.struct("met", "set_id"))["set_id"].alias("grp"), F.count(F.lit(1)).alias("times"))
    shared = skewed_join(shared, named_by, "part", "times", total, n_common)
    pairs = durable(shared.filter("grp <> set_id").select("grp", "set_id").distinct())
    members = pairs.union(pairs.select("grp", F.col("grp").alias("set_id")).distinct())

    wanted = durable(members.select("set_id").distinct())
    # few names are sent as they are; of many a filter is, so that hardly any other set leaves its task
    n_wanted = wanted.count()
    few = n_wanted <= BROADCAST_ROWS
    ids = spark.sparkContext.broadcast({r[0] for r in wanted.toLocalIterator()} if few else bloom.build(wanted, "set_id", n_wanted))

    def give_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = ids.value
        for batch in batches:
            seen = {set_id(s): s for s in shingle_sets(batch.column(0), n) if len(s)}
            names = np.array(list(seen), dtype=np.int64)
            held = [x in keep for x in seen] if few else bloom.may_hold(keep, names.view(U64))
            seen = {x: seen[x] for x in names[held].tolist()}
            if seen:
                ends = np.cumsum([0, *map(len, seen.values())]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(ends), as_long(np.concatenate(list(seen.values()))))
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), tokens], ["set_id", "tokens"])

    sets = docs.select(text).mapInArrow(give_sets, "set_id long, tokens array<long>")
    if not few:
        sets = sets.join(wanted, "set_id", "left_semi")
    sets = durable(sets.dropDuplicates(["set_id"]))

    total = 2 * pairs.count()
    pieces = durable(_dealt(members, ["grp"], PIECE, total))
    lead = pieces.filter("piece <> 0").select("grp", "piece", F.col("grp").alias("set_id")).distinct()
    links = durable(_links(pieces.drop("pieces").unionByName(lead).withColumn("known", F.col("set_id")), sets, num, den))
    roots = components(links)

    # groups of several pieces with sets of several components: pieces of one component, or of what is left of many
    labelled = durable(pieces.filter("pieces > 1").join(roots, F.col("set_id") == F.col("node"), "left").select("grp", "set_id", F.coalesce("root", "set_id").alias("known")))
    open_groups = durable(labelled.groupBy("grp").agg(F.min("known").alias("lo"), F.max("known").alias("hi")).filter("lo <> hi").select("grp"))
    if open_groups.take(1):
        left = sized_join(labelled, open_groups, ["grp"], "left_semi")
        left = durable(_dealt(left, ["grp", "known"], PIECE // 2, total).withColumn("own", F.when(F.col("pieces") > 1, F.col("known"))).drop("piece", "pieces"))
        left = durable(_dealt(left, ["grp", "own"], PIECE // 2, total).withColumn("piece", F.xxhash64("own", "piece")))
        spans = durable(left.groupBy("grp", "piece").agg(F.min("known").alias("lo"), F.max("known").alias("hi")))
        x, y = spans.alias("x"), spans.alias("y")
        cross = x.join(y, (F.col("x.grp") == F.col("y.grp")) & (F.col("x.piece") <= F.col("y.piece"))).filter(
            "not (x.lo = x.hi and y.lo = y.hi and x.lo = y.lo)"
        ).select(F.col("x.grp").alias("grp"), F.col("x.piece").alias("i"), F.col("y.piece").alias("j"))
        both = cross.select("grp", F.xxhash64("i", "j").alias("pair"), F.explode(F.array_distinct(F.array("i", "j"))).alias("piece"))
        again = durable(left.join(both, ["grp", "piece"]).select("grp", F.col("pair").alias("piece"), "set_id", "known"))
        # few sets are compared again, so only those are moved
        some = sized_join(sets, durable(again.select("set_id").distinct()), ["set_id"], "left_semi")
        more = durable(_links(again, some, num, den))
        if more.take(1):
            roots = components(more.union(roots))
    return named, roots


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` (the smallest key reachable by links) of each row.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased.  Two rows are linked if
    the Jaccard similarity of their sets of ``n``-word shingles is num/den or more; num/den must
    be over a half.  A null text, or one without words, has no shingles and is linked with
    nothing.  Equal texts are linked.  A null key is no candidate for a component's smallest.
    Equal rows are all returned; an empty table gives an empty one; other columns aren't read.
    """
    if not den < 2 * num <= 2 * den:
        raise ValueError("the threshold must be over 1/2 and at most 1")
    rows = _rooted(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", n, num, den)
    return rows.select(F.col("_key").alias(key), "n_shingles", F.when(F.col("set_id").isNull(), F.col("_key")).otherwise(F.col("least._key")).alias("component_id"))


def _rooted(docs: DataFrame, text: str, n: int, num: int, den: int) -> DataFrame:
    """Rows of ``set_components`` with ``least``: the smallest of its component's rows, nulls last; null for a row without a set.

    Rows are added up by set and sets by component before anything is joined back.
    """
    named, roots = set_components(docs, text, n, num, den)
    order = [x for c in named.columns if c not in ("set_id", "n_shingles") for x in (F.col(c).isNull().alias(f"no{c}"), F.col(c))]
    full = named.filter("set_id is not null")
    each = full.groupBy("set_id").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct(*order)).alias("least"))
    each = durable(each.join(roots, F.col("set_id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "set_id")).drop("node"))
    n_sets, n_rows = each.agg(F.count(F.lit(1)), F.coalesce(F.sum("times"), F.lit(0))).first()
    best = each.groupBy("root").agg(F.count(F.lit(1)).alias("sets"), F.min("least").alias("least"))
    sets = durable(skewed_join(each.drop("least"), best, "root", "sets", n_sets, n_sets).drop("root"))
    return skewed_join(full, sets, "set_id", "times", n_rows, n_sets).unionByName(named.filter("set_id is null"), allowMissingColumns=True)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest key, nulls last, and of equal keys the smallest row hash.

    Components are those of ``jaccard_components``.  A row without words is linked with nothing and
    stays, whatever its key; so does a text whose key another text has as well.  Of rows that are
    equal throughout one stays.
    """
    if not den < 2 * num <= 2 * den:
        raise ValueError("the threshold must be over 1/2 and at most 1")
    row = fresh(docs, "row")
    marked = docs.withColumn(row, row_hash(docs))
    rows = durable(_rooted(marked.select(F.col(key).alias("_key"), F.col(row).alias("_row"), F.col(text).alias("_text")), "_text", n, num, den).filter("set_id is not null"))
    dropped = durable(rows.filter("_row <> least._row").select(F.col("_row").alias(row)).distinct())
    again = durable(rows.filter("_row = least._row").groupBy(F.col("_row").alias(row)).agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select(row))
    left = sized_join(marked, dropped, [row], "left_anti")
    if again.take(1):
        left = sized_join(left, again, [row], "left_anti").unionByName(sized_join(left, again, [row], "left_semi").dropDuplicates([row]))
    return left.select(docs.columns)
