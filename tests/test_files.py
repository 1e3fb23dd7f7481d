"""Writers and readers: what is written for several genomes comes back for each, in files that are in order."""

import pytest
from pyspark.sql import functions as F

from thylakoid import queries
from thylakoid.operators import hits, intervals, orf
from thylakoid.plans import cuts
from thylakoid.plans.counters import Counters
from thylakoid.sources import readers, writers
from thylakoid.streaming import frames

GENOMES = [(1, "TAAATGGCTGCAAAACGTTGGCATTAGCCC"), (2, "ATGGCTGCAAAACGTTGGCATCTGGAAAGCTAA" * 3), (30, "ACGT")]


@pytest.fixture
def genomes(spark):
    return spark.createDataFrame(GENOMES, "genome_id long, seq string")


def lines(folder):
    return [line for file in sorted(folder.glob("part-*")) for line in file.read_text().splitlines()]


def test_frames_of_several_genomes(spark, genomes, tmp_path):
    found = orf.find_orfs(genomes, sequences=True)
    writers.write_orfs(found, f"file://{tmp_path}/c")
    writers.write_fasta(found, f"file://{tmp_path}/f", "orf_id")
    want = sorted((r.genome_id, r.orf_id, r.start0, r.end0, r.seq) for r in found.collect())
    got = readers.read_orf_coordinates(spark, f"file://{tmp_path}/c").join(readers.read_fasta(spark, f"file://{tmp_path}/f").withColumnRenamed("id", "orf_id"), ["genome_id", "orf_id"])
    assert sorted((r.genome_id, r.orf_id, r.start0, r.end0, r.seq) for r in got.collect()) == want
    assert all(dict(GENOMES)[g][a : b + 1] == s for g, _, a, b, s in want)
    ids = [line.split("\t")[0] for line in lines(tmp_path / "c" / "genome_id=2")]
    assert ids == sorted(ids) and len(ids) > 4
    writers.write_orfs(found.filter("genome_id = 1").drop("genome_id"), f"file://{tmp_path}/one")
    assert len(lines(tmp_path / "one")) == sum(w[0] == 1 for w in want)


def test_regions_go_by_class(spark, tmp_path):
    rows = [("psbAXXX1", "gene", "ACGT"), ("trnK-UUUXXX1", "tRNA", "GG"), ("rrn16XXX2", "rRNA", "TT"), ("psbBXXX1", "gene", "")]
    writers.write_regions(spark.createDataFrame(rows, "ref_id string, class string, seq string"), f"file://{tmp_path}/r")
    assert sorted((r.id, r["class"], r.seq) for r in readers.read_fasta(spark, f"file://{tmp_path}/r").collect()) == sorted(rows)
    assert {p.name for p in (tmp_path / "r").glob("class=*")} == {"class=gene", "class=tRNA", "class=rRNA"}


def test_assignments(spark, tmp_path):
    best = spark.createDataFrame([("orf2", "aXXX1", 0.8), ("orf10", "bXXX2", 1.25)], "orf_id string, ref_id string, score double")
    for compat in (False, True):
        writers.write_best_orfs(best, f"file://{tmp_path}/o{compat}", compat)
        assert lines(tmp_path / f"o{compat}") == [f"orf10\tbXXX2\t1.25{'q' * compat}", f"orf2\taXXX1\t0.8{'q' * compat}"]
        assert sorted(map(tuple, readers.read_assignments(spark, f"file://{tmp_path}/o{compat}").collect())) == [("orf10", "bXXX2", 1.25), ("orf2", "aXXX1", 0.8)]
    rna = spark.createDataFrame([("trnK", "1", "trnKXXX2"), ("trnA", "1", "trnAXXX1"), ("trnA", "7", "trnAXXX3")], "short_name string, query_id string, ref_id string")
    writers.write_best_rnas(rna, f"file://{tmp_path}/n")
    assert lines(tmp_path / "n") == ["1\ttrnAXXX1", "7\ttrnAXXX3", "1\ttrnKXXX2"]
    assert sorted((r.query_id, r.ref_id) for r in readers.read_assignments(spark, f"file://{tmp_path}/n").collect()) == [("1", "trnAXXX1"), ("1", "trnKXXX2"), ("7", "trnAXXX3")]


def test_feature_tables_are_in_order(spark, tmp_path):
    rows = [(1, "FULL", 1, 99, "+", 5), (1, "b", 20, 30, "-", 0), (1, "a", 3, 9, "+", 0), (2, "c", 1, 5, "+", 0), (1, "a", 3, 9, "-", 0)]
    writers.write_features(spark.createDataFrame(rows, "genome_id long, name string, start int, end int, strand string, sort_key int"), f"file://{tmp_path}/t")
    assert lines(tmp_path / "t" / "genome_id=1") == ["a\t3\t9\t+", "a\t3\t9\t-", "b\t20\t30\t-", "FULL\t1\t99\t+"]
    assert sorted((r.genome_id, r.name, r.start, r.end, r.strand) for r in readers.read_features(spark, f"file://{tmp_path}/t").collect()) == sorted(r[:5] for r in rows)


def test_hits_of_twelve_columns(spark, tmp_path):
    (tmp_path / "h.txt").write_text("q1\tr1\t98.5\t70\t1\t0\t5\t74\t70\t1\t1e-30\t120.5\nbad line\nq2\tr2\t100.0\t20\t0\t0\t1\t20\t1\t20\t0.05\t30\n")
    found = readers.read_hits(spark, f"file://{tmp_path}/h.txt")
    assert [(r.qseqid, r.pident, r.sstart, r.send, r.evalue) for r in found.orderBy("line_no").collect()] == [("q1", 98.5, 70, 1, 1e-30), ("q2", 100.0, 1, 20, 0.05)]
    writers.write_hits(found, f"file://{tmp_path}/again")
    assert sorted(map(tuple, readers.read_hits(spark, f"file://{tmp_path}/again").drop("line_no").collect())) == sorted(map(tuple, found.drop("line_no").collect()))
    assert hits.filter_hits(found, evalue=0.01).count() == 1


def test_annotation_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.gff").write_text("##gff\ns\tx\tregion\t1\t100\t.\t+\t.\tID=r\ns\tx\tCDS\t10\t20\t.\t+\t0\tID=c;Parent=g\n")
    (tmp_path / "a" / "y.gff").write_text("s x region 1 50 . + . ID=r\ns x rRNA 10 20 . - 0 ID=rrn16\n")
    found, lengths = readers.read_gff3(spark, f"file://{tmp_path}/a")
    name = lambda df: df.withColumn("genome_id", F.substring_index("genome_id", "/", -1))
    assert sorted(map(tuple, name(found).collect())) == [("x.gff", "g", 10, 20, "+"), ("y.gff", "rrn16", 10, 20, "-")]
    assert sorted(map(tuple, name(lengths).collect())) == [("x.gff", 100), ("y.gff", 50)]
    (tmp_path / "g.gb").write_text('LOCUS  X  100 bp\n     gene            complement(join(10..20,\n                     31..40))\n                     /gene="g"\n')
    assert sorted(map(tuple, name(readers.read_genbank(spark, f"file://{tmp_path}/g.gb")).collect())) == [("g.gb#X", "g", 10, 20, "-", 100), ("g.gb#X", "g", 31, 40, "-", 100)]
    assert readers.read_genbank(spark, f"file://{tmp_path}/g.gb", compat=True).collect() == []


def test_frames_of_arriving_files(spark, genomes, tmp_path):
    rows = genomes.withColumn("id", F.col("genome_id").cast("string"))
    writers.write_fasta(rows.filter("genome_id < 30"), f"file://{tmp_path}/in")
    run = lambda: frames.write_frames(frames.genome_stream(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/out", f"file://{tmp_path}/state").awaitTermination()
    run()
    want = orf.find_orfs(genomes).count()
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == want
    run()  # nothing has arrived since
    writers.write_fasta(rows.filter("genome_id = 2").drop("genome_id"), f"file://{tmp_path}/in/late")
    run()
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == want + orf.find_orfs(genomes.filter("genome_id = 2")).count()


def test_members_of_stretches(spark):
    rows = spark.createDataFrame([(1, 1, 10, "a"), (1, 5, 12, "b"), (1, 5, 12, "b"), (1, 20, 20, "c"), (2, 3, 4, "d")], "k int, start int, end int, name string")
    got = sorted((r.k, r.start, r.end, tuple(r.members)) for r in intervals.depth_members(rows, ["k"], "name").collect())
    assert got == [(1, 1, 4, ("a",)), (1, 5, 10, ("a", "b")), (1, 11, 12, ("b",)), (1, 20, 20, ("c",)), (2, 3, 4, ("d",))]


def test_pairs_covered_by_several_hits(spark):
    refs = spark.createDataFrame([("r", "A" * 100)], "ref_id string, seq string")
    found = spark.createDataFrame([("q", "r", 1, 50), ("q", "r", 90, 40), ("p", "r", 1, 89)], "qseqid string, sseqid string, sstart int, send int")
    assert [tuple(r) for r in hits.covered_pairs(found, refs).select("qseqid", "covered", "fraction").collect()] == [("q", 90, 0.9)]


def test_guides_are_added_to_others(spark, tmp_path):
    rows = [(n, k, f"{name}XXX{n}", s) for n, k, name, s in [(1, "gene", "psbA", "ACGT"), (1, "tRNA", "trnK-UUU", "AC"), (2, "gene", "psbA", "GGGG"), (2, "rRNA", "rrn16", "TT")]]
    table = spark.createDataFrame(rows, "guide_no int, class string, ref_id string, seq string")
    path = f"file://{tmp_path}/guides"
    for guide in (1, 2, 2):
        writers.append_regions(table.filter(F.col("guide_no") == guide), path)
    read = lambda: {(r.guide_no, r["class"], r.id, r.seq) for r in readers.read_fasta(spark, path).collect()}
    assert read() == set(rows)
    writers.append_regions(spark.createDataFrame([(2, "gene", "rbcLXXX2", "CCCC")], table.schema), path)
    assert read() == {r for r in rows if r[:2] != (2, "gene")} | {(2, "gene", "rbcLXXX2", "CCCC")}


RECORD = 'LOCUS       {0}   {1} bp    DNA\nFEATURES             Location/Qualifiers\n     gene            complement(1..{2})\n                     /gene="g{2}"\n     CDS             5..6\n                     /gene="no"\n'


def test_records_of_one_genbank_file(spark, tmp_path):
    texts = [RECORD.format(f"NC_{i}", 100 + i, 10 + i) for i in range(3)]
    (tmp_path / "a.gb").write_text("//\n".join([*texts, ""]))
    (tmp_path / "b.gb").write_text(texts[1])
    found = {(r.genome_id.rsplit("/", 1)[1], r.name, r.start, r.end, r.strand, r.len) for r in readers.read_genbank(spark, f"file://{tmp_path}").collect()}
    assert found == {("a.gb#NC_0", "g10", 1, 10, "-", 100), ("a.gb#NC_1", "g11", 1, 11, "-", 101), ("a.gb#NC_2", "g12", 1, 12, "-", 102), ("b.gb#NC_1", "g11", 1, 11, "-", 101)}
    readers.register_genbank(spark)
    spark.createDataFrame([("a", "//\n".join(texts)), ("b", None), ("c", ""), ("d", "no record")], "id string, value string").createOrReplaceTempView("texts")
    rows = spark.sql("SELECT t.id, f.record, f.locus, f.name, f.end FROM texts t, LATERAL genbank_features(t.value) f").collect()
    assert {tuple(r) for r in rows} == {("a", i, f"NC_{i}", f"g{10 + i}", 10 + i) for i in range(3)}


def test_counters_are_taken_by_the_run(spark):
    counters = Counters()
    rows = counters.on(spark.range(100), "seen", odd=F.col("id") % 2 == 1)
    assert counters.on(rows.filter("id > 89"), "kept").count() == 10
    assert counters.found() == {"seen_rows": 100, "seen_odd": 50, "kept_rows": 10}
    empty = Counters()
    empty.on(spark.range(0), "seen", odd=F.col("id") % 2 == 1).collect()
    assert empty.found() == {"seen_rows": 0, "seen_odd": 0}


def test_genomes_share_files(spark, genomes, tmp_path):
    rows, path = genomes.withColumn("id", F.concat(F.lit("x\ty"), F.col("genome_id").cast("string"))).coalesce(1), f"file://{tmp_path}"
    writers.write_fasta(rows, f"{path}/f", together=True)
    assert not list((tmp_path / "f").glob("genome_id=*"))
    assert sorted(map(tuple, readers.read_fasta(spark, f"{path}/f", together=True).select("genome_id", "id", "seq").collect())) == sorted((str(g), f"x\ty{g}", s) for g, s in GENOMES)
    assert {(r.genome_id, r.seq) for r in readers.read_genome(spark, f"{path}/f", together=True).collect()} == {(str(g), s) for g, s in GENOMES}
    frames.write_frames(frames.genome_stream(spark, f"{path}/f", together=True), f"{path}/out", f"{path}/state").awaitTermination()
    found = orf.find_orfs(genomes)
    want = sorted((str(r.genome_id), r.orf_id, r.start0, r.end0) for r in found.collect())
    assert sorted((r.genome_id, r.orf_id, r.start0, r.end0) for r in spark.read.parquet(f"{path}/out").collect()) == want
    writers.write_orfs(found, f"{path}/c", together=True)
    assert sorted((r.genome_id, r.orf_id, r.start0, r.end0) for r in readers.read_orf_coordinates(spark, f"{path}/c", together=True).collect()) == want
    spans = [(1, "b", 20, 30, "-"), (1, "a", 3, 9, "+"), (-2, "c", 1, 5, "+")]
    writers.write_features(spark.createDataFrame(spans, "genome_id long, name string, start int, end int, strand string"), f"{path}/t", together=True)
    assert sorted((int(r.genome_id), r.name, r.start, r.end, r.strand) for r in readers.read_features(spark, f"{path}/t", together=True).collect()) == sorted(spans)
    assert [x for x in lines(tmp_path / "t") if x.startswith("1\t")] == ["1\ta\t3\t9\t+", "1\tb\t20\t30\t-"]


def test_regions_of_guides_are_made_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(queries, "cut", lambda df: made.append(df.columns) or cuts.cut(df))
    queries.guide_append_files(spark, "/root/testdata/sf0.001")
    assert made == [["class", "guide_no", "ref_id", "seq"]]


def test_frames_are_written_and_read_without_a_shuffle(spark, genomes, tmp_path):
    found, path = orf.find_orfs(genomes, sequences=True, by_id=True), f"file://{tmp_path}"
    ids = [r.orf_id for r in found.collect() if r.genome_id == 2]
    assert ids == sorted(ids) and len(ids) > 4
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, orf.find_orfs(genomes, sequences=True).collect()))
    writers.write_orf_files(found, f"{path}/a", together=True)
    writers.write_orf_files(found, f"{path}/b", together=True, gathered=True, compression="gzip")
    assert {p.suffix for p in (tmp_path / "b" / "sequences").glob("part-*")} == {".gz"}
    for kind in ("coordinates", "sequences"):
        of = lambda side: [x.value for x in spark.read.text(f"{path}/{side}/{kind}").filter("value rlike '^>?2\t'").collect()]  # noqa: B023, E731
        assert of("a") == of("b") and len(of("a")) > 4
    got = readers.read_fasta(spark, f"{path}/b/sequences", together=True)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((int(r.genome_id), r.id, r.seq) for r in got.collect()) == sorted((r.genome_id, r.orf_id, r.seq) for r in found.collect())


def test_records_that_lie_apart_are_joined(spark, tmp_path, monkeypatch):
    for name, text in {"a": ">1\tx\nAC\nGT\n>1\ty\nA\n>2\tx\nC\n>2\tx\nG\n", "b": ">1\ty\nT\n>3\tb\nA\n>3\ta\nC\n>4\n>\nA\n>5\tz\t1\n\n>6\tx\nAAA\n>7\tx\nCC"}.items():
        (tmp_path / f"{name}.txt").write_text(text)
    read = lambda: sorted((r.genome_id, r.id, r.seq) for r in readers.read_fasta(spark, f"file://{tmp_path}", together=True).collect())
    got = read()
    assert got == [("", "", "A"), ("1", "x", "ACGT"), ("1", "y", "AT"), ("2", "x", "CG"), ("3", "a", "C"), ("3", "b", "A"), ("4", "4", ""), ("5", "z\t1", ""), ("6", "x", "AAA"), ("7", "x", "CC")]
    monkeypatch.setattr(readers, "FEW_GENOMES", -1)
    assert read() == got
    monkeypatch.undo()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "12")
    try:
        assert read() == got
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
