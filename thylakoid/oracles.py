"""SQL for DuckDB that states the queries of ``thylakoid.queries`` independently of their plans."""

from __future__ import annotations

#: The standard code by amino acid, ``_`` a stop, with the codons of any third base that are read as one.
_CODE = """A GCA GCC GCG GCT GCN|C TGC TGT|D GAC GAT|E GAA GAG|F TTC TTT|G GGA GGC GGG GGT GGN|H CAC CAT|I ATA ATC ATT|K AAA AAG|L CTA CTC CTG CTT TTA TTG|M ATG|N AAC AAT|P CCA CCC CCG CCT CCN
Q CAA CAG|R AGA AGG CGA CGC CGG CGT CGN|S AGC AGT TCA TCC TCG TCT TCN|T ACA ACC ACG ACT ACN|V GTA GTC GTG GTT GTN|W TGG|Y TAC TAT|_ TAA TAG TGA"""
CODE = {codon: line.split()[0] for line in _CODE.replace("\n", "|").split("|") for codon in line.split()[1:]}
_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in sorted(CODE.items())) + "}"


def _dna(text: str) -> str:
    return f"translate(lower(regexp_replace(coalesce({text}, ''), '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTNCGTACGTAN')"


def _rc(seq: str) -> str:
    return f"reverse(translate({seq}, 'ATCGatcg', 'TAGCtagc'))"


def _protein(seq: str, frame: int = 0) -> str:
    return f"nullif(array_to_string(list_transform(range({frame + 1}, length({seq}) - 1, 3), lambda i: coalesce({_MAP}[substr({seq}, i, 3)], 'X')), ''), '')"


_G = f"g AS (SELECT doc_id AS genome_id, {_dna('text')} AS seq FROM documents)"
_R0 = f"""r0 AS (SELECT CASE item_id % 6 WHEN 0 THEN 'trnK' || item_id || '-UUU' WHEN 1 THEN 'rrn' || item_id WHEN 2 THEN 'rps' || (item_id // 6) || '_exon1'
  WHEN 3 THEN 'rps' || (item_id // 6) || '_exon2' WHEN 4 THEN 'rpl16' || item_id ELSE 'psb' || item_id END AS feature,
  (CASE WHEN item_id % 6 IN (2, 3) THEN (item_id // 6) % 3 + 1 ELSE item_id % 3 + 1 END)::INT AS guide_no,
  CASE item_id % 6 WHEN 0 THEN 'tRNA' WHEN 1 THEN 'rRNA' ELSE 'gene' END AS class, {_dna('text')} AS seq FROM benchmark),
r AS (SELECT feature || 'XXX' || guide_no AS ref_id, feature, guide_no, class, seq FROM r0)"""
_F = """f AS (SELECT l_partkey AS genome_id, (date_diff('day', DATE '1992-01-01', l_shipdate::DATE) + 1)::INT AS "start",
  (date_diff('day', DATE '1992-01-01', l_shipdate::DATE) + 1 + l_quantity::INT)::INT AS "end", CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand,
  'g' || l_suppkey AS name, 'g' || (l_suppkey % 7) AS gene, l_extendedprice AS score, l_orderkey * 10 + l_linenumber AS load_order FROM lineitem)"""
_U = """u AS (SELECT genome_id, "start", "end", strand, name, gene FROM f QUALIFY row_number() OVER (PARTITION BY genome_id, "start", "end", strand ORDER BY load_order DESC) = 1)"""

_ORFS = f"""
{_G}, s AS (SELECT genome_id, '+' AS strand, seq FROM g UNION ALL SELECT genome_id, '-', {_rc('seq')} FROM g),
c AS (SELECT genome_id, strand, frame, length(seq) AS len, j, {_MAP}[substr(seq, (j + 1)::INT, 3)] AS aa
  FROM (SELECT *, unnest(range(frame, length(seq) - 1, 3)) AS j FROM s, (VALUES (0), (1), (2)) t(frame))),
i AS (SELECT *, coalesce(sum(CASE WHEN aa IS NULL OR aa = '_' THEN 1 ELSE 0 END) OVER (PARTITION BY genome_id, strand, frame ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM c),
o AS (SELECT genome_id, strand, frame, len, min(j) FILTER (aa <> '_') AS a, max(j) FILTER (aa IS NOT NULL) + 2 AS b, 3 * count(*) FILTER (aa IS NOT NULL) AS nt
  FROM i GROUP BY genome_id, strand, frame, len, island HAVING count(*) FILTER (aa <> '_') > 0 AND 3 * count(*) FILTER (aa IS NOT NULL) > 18 -- kept
),
orfs AS (SELECT genome_id, 'orf' || row_number() OVER (PARTITION BY genome_id, strand ORDER BY frame, a) || CASE strand WHEN '-' THEN '-r' ELSE '' END AS orf_id, strand, frame,
  (CASE strand WHEN '-' THEN len - b - 1 ELSE a END)::INT AS start0, (CASE strand WHEN '-' THEN len - a - 1 ELSE b END)::INT AS end0, nt::INT AS nt FROM o)"""

_ORFS_COMPAT = _ORFS.replace("-- kept", "AND NOT (frame = 2 AND count(*) FILTER (aa IS NULL OR aa = '_') = 0)")
# what longer frames cover of a frame: frames meet in the bin where their overlap begins, and each overlap counts from where the earlier ones end
_NESTED = """bins AS MATERIALIZED (SELECT genome_id, orf_id, start0, end0, nt, unnest(range(start0 // 128, end0 // 128 + 1)) AS bin FROM orfs),
over AS (SELECT a.genome_id, a.orf_id, a.start0 AS lo, a.end0 AS hi, greatest(a.start0, b.start0) AS s, least(a.end0, b.end0) AS e FROM bins a JOIN bins b
  ON a.genome_id = b.genome_id AND a.bin = b.bin AND a.start0 <= b.end0 AND b.start0 <= a.end0 AND a.bin = greatest(a.start0, b.start0) // 128 AND (b.nt > a.nt OR (b.nt = a.nt AND b.orf_id < a.orf_id))),
nested AS (SELECT genome_id, orf_id FROM (SELECT *, greatest(0, e - greatest(s - 1, coalesce(max(e) OVER (PARTITION BY genome_id, orf_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s - 1))) AS more FROM over)
  GROUP BY genome_id, orf_id, lo, hi HAVING sum(more)::DOUBLE / greatest(hi - lo, 1) >= 0.9)"""

# seeds of 16 equal bases, extended along their diagonal while the score (+1, -2) is within 10 of its best; hits that overlap are one
_LANE = "genome_id, ref_id, back, d"
_HITS = f"""
{_G}, {_R0}, rb AS (SELECT ref_id, length(seq) AS n, seq, false AS back FROM r UNION ALL SELECT ref_id, length(seq), {_rc('seq')}, true FROM r),
rk AS (SELECT ref_id, back, sp, substr(seq, (sp + 1)::INT, 16) AS w FROM (SELECT *, unnest(range(0, length(seq) - 15)) AS sp FROM rb)),
gk AS (SELECT genome_id, p, substr(seq, (p + 1)::INT, 16) AS w FROM (SELECT *, unnest(range(0, length(seq) - 15)) AS p FROM g)),
lanes AS (SELECT DISTINCT genome_id, ref_id, back, p - sp AS d FROM gk JOIN rk USING (w) WHERE NOT contains(w, 'N')),
seg AS (SELECT {_LANE}, greatest(0, d) AS lo, length(g.seq) AS len, n, substr(g.seq, (greatest(0, d) + 1)::INT, (least(length(g.seq), n + d) - greatest(0, d))::INT) AS a,
  substr(rb.seq, (greatest(0, d) - d + 1)::INT, (least(length(g.seq), n + d) - greatest(0, d))::INT) AS b FROM lanes JOIN g USING (genome_id) JOIN rb USING (ref_id, back)),
px AS (SELECT {_LANE}, len, n, lo + j AS i, CASE WHEN substr(a, (j + 1)::INT, 1) = substr(b, (j + 1)::INT, 1) AND substr(a, (j + 1)::INT, 1) <> 'N' THEN 1 ELSE -2 END AS step FROM (SELECT *, unnest(range(0, length(a))) AS j FROM seg)),
sx AS MATERIALIZED (SELECT *, sum(step) OVER (PARTITION BY {_LANE} ORDER BY i) AS s, i - row_number() OVER (PARTITION BY {_LANE}, step ORDER BY i) AS grp FROM px),
rn AS MATERIALIZED (SELECT {_LANE}, len, n, min(i) AS x, max(i) AS y, min(s) - 1 AS before, max(s) AS after FROM sx WHERE step = 1 GROUP BY {_LANE}, len, n, grp HAVING count(*) >= 16),
way AS (SELECT {_LANE}, x, 1 AS side, sx.i AS i, sx.i AS o, s - after AS gain FROM rn JOIN sx USING ({_LANE}) WHERE sx.i > y
  UNION ALL SELECT {_LANE}, x, -1, sx.i, -sx.i, before - s + step FROM rn JOIN sx USING ({_LANE}) WHERE sx.i < x),
gone AS (SELECT *, bool_or(fallen) OVER (PARTITION BY {_LANE}, x, side ORDER BY o) AS out FROM (SELECT *, greatest(0, max(gain) OVER (PARTITION BY {_LANE}, x, side ORDER BY o)) - gain > 10 AS fallen FROM way)),
top AS (SELECT {_LANE}, x, side, arg_min(i, o) AS reach FROM (SELECT *, max(gain) OVER (PARTITION BY {_LANE}, x, side) AS best FROM gone WHERE NOT out) WHERE gain = best AND best > 0 GROUP BY ALL),
z AS (SELECT {_LANE}, len, n, coalesce(a.reach, rn.x) AS low, coalesce(b.reach, rn.y) AS high FROM rn LEFT JOIN (FROM top WHERE side = -1) a USING ({_LANE}, x) LEFT JOIN (FROM top WHERE side = 1) b USING ({_LANE}, x)),
y AS (SELECT {_LANE}, len, n, min(low) AS q0, max(high) AS q1 FROM (SELECT *, sum(new) OVER (PARTITION BY {_LANE} ORDER BY low, high ROWS UNBOUNDED PRECEDING) AS grp FROM (
    SELECT *, CASE WHEN low <= max(high) OVER (PARTITION BY {_LANE} ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM z)) GROUP BY {_LANE}, len, n, grp),
m AS (SELECT y.*, (SELECT count(*) FROM sx WHERE sx.genome_id = y.genome_id AND sx.ref_id = y.ref_id AND sx.back = y.back AND sx.d = y.d AND sx.i BETWEEN y.q0 AND y.q1 AND sx.step < 0) AS off, q1 - q0 + 1 AS wide FROM y),
hits AS (SELECT genome_id::VARCHAR AS qseqid, ref_id AS sseqid, 100.0::DOUBLE * (wide - off) / wide AS pident, wide::INT AS length, off::INT AS mismatch, (q0 + 1)::INT AS qstart, (q1 + 1)::INT AS qend,
  (CASE WHEN back THEN n - (q0 - d) ELSE q0 - d + 1 END)::INT AS sstart, (CASE WHEN back THEN n - (q1 - d) ELSE q1 - d + 1 END)::INT AS send,
  0.621::DOUBLE * len * n * exp(-1.33::DOUBLE * (wide - 3 * off)) AS evalue, (1.33::DOUBLE * (wide - 3 * off) - ln(0.621::DOUBLE)) / ln(2) AS bitscore FROM m),
h AS (SELECT *, row_number() OVER (PARTITION BY qseqid ORDER BY sseqid, qstart, qend, sstart) AS line_no FROM hits WHERE evalue <= 0.1)"""

_CODONS = "codons(codon, aa) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in sorted(CODE.items())) + ")"


def _words(name: str, src: str, key: str) -> str:
    """CTEs ending in ``name`` (key, p, w): five residues in a row of either strand, with the place of their 15 bases."""
    cut = f"SELECT {key}, back, len, p, coalesce(aa, 'X') AS aa FROM (SELECT {key}, back, len, p, substr(seq, (p + 1)::INT, 3) AS codon FROM (SELECT *, unnest(range(0, len - 2)) AS p FROM {name}_s)) LEFT JOIN codons USING (codon)"
    return f"""{name}_s AS (SELECT {key}, false AS back, length(seq) AS len, seq FROM {src} UNION ALL SELECT {key}, true, length(seq), {_rc('seq')} FROM {src}),
{name} AS (SELECT {key}, CASE WHEN back THEN len - 15 - p ELSE p END AS p, w FROM (SELECT {key}, back, len, p, aa || lead(aa, 3) OVER o || lead(aa, 6) OVER o || lead(aa, 9) OVER o || lead(aa, 12) OVER o AS w
  FROM ({cut}) WINDOW o AS (PARTITION BY {key}, back ORDER BY p)) WHERE w IS NOT NULL AND NOT contains(w, 'X'))"""


def _pairs_by_words(orfs: str, kind: str) -> str:
    return f"""{orfs}, {_R0}, {_CODONS}, rr AS (SELECT ref_id, seq FROM r WHERE {kind}), {_words('gw', 'g', 'genome_id')}, {_words('rw', 'rr', 'ref_id')},
meets AS (SELECT DISTINCT genome_id, gw.p AS p, ref_id FROM gw JOIN rw USING (w)),
pairs AS (SELECT DISTINCT genome_id, genome_id || ':' || orf_id AS orf_id, ref_id, start0, end0 FROM orfs JOIN meets USING (genome_id) WHERE start0 <= p AND p + 14 <= end0)"""


def _found(windows: str, text: str) -> str:
    return f"len(list_filter({windows}, lambda w: contains({text}, w)))"


def _windows(text: str, width: int, step: int) -> str:
    return f"list_transform(range(1, length({text}) - {width - 2}, {step}), lambda i: substr({text}, i, {width}))"


def _last(seq: str, codon: str, below: str) -> str:
    return f"coalesce(list_max(list_filter(range(0, greatest(0, least({below}, length({seq}) - 2))), lambda i: substr({seq}, (i + 1)::INT, 3) = {codon})), -1)::INT"


_FRAME_PAIRS = _pairs_by_words(_ORFS, "class = 'gene'")
# sequences are translated once, before the pairs are made
_SEQS = f"""{_FRAME_PAIRS}, used AS (SELECT DISTINCT orf_id, genome_id, start0, end0 FROM pairs), frames AS (SELECT orf_id, substr(seq, start0 + 1, end0 - start0 + 1) AS oq FROM used JOIN g USING (genome_id)),
proteins AS (SELECT orf_id AS qseqid, ref_id AS sseqid, o, p FROM pairs JOIN (SELECT orf_id, {_protein('oq')} AS o FROM frames) USING (orf_id) JOIN (SELECT ref_id, {_protein('seq')} AS p FROM rr) USING (ref_id))"""
_SCORED = f"""{_SEQS}, refp AS (SELECT ref_id, CASE WHEN f0 >= f1 AND f0 >= f2 THEN p0 WHEN f1 >= f2 THEN p1 ELSE p2 END AS pf FROM (SELECT *,
    CASE WHEN instr(p0, '_') = 0 THEN length(seq) + 1 ELSE instr(p0, '_') - 1 END AS f0, CASE WHEN instr(p1, '_') = 0 THEN length(seq) + 1 ELSE instr(p1, '_') - 1 END AS f1,
    CASE WHEN instr(p2, '_') = 0 THEN length(seq) + 1 ELSE instr(p2, '_') - 1 END AS f2
    FROM (SELECT *, {_protein('seq', 0)} AS p0, {_protein('seq', 1)} AS p1, {_protein('seq', 2)} AS p2 FROM rr))),
sixes AS (SELECT orf_id, [{', '.join(_protein(s, k) for s in ('oq', _rc('oq')) for k in range(3))}] AS six FROM frames),
scored AS (SELECT orf_id AS qseqid, ref_id AS sseqid, list_max(list_transform(six, lambda q: {_found(_windows("coalesce(q, '')", 3, 1), 'pf')}::DOUBLE / length(pf))) AS score
  FROM pairs JOIN sixes USING (orf_id) JOIN refp USING (ref_id))"""
_PIECES = f"""{_HITS}, pieces AS (SELECT h.qseqid, h.sseqid, line_no, substr(g.seq, qstart, qend - qstart + 1) AS oq, r.seq AS pq FROM h JOIN g ON genome_id::VARCHAR = qseqid JOIN r ON ref_id = sseqid)"""

_GAP = """
e AS (SELECT *, nullif(regexp_extract(name, '^(.+)_exon\\d+', 1), '') AS gene0, try_cast(nullif(regexp_extract(name, '_exon(\\d+)', 1), '') AS INT) AS num FROM src),
l AS (SELECT *, lag(name) OVER w AS prev, lag(gene0) OVER w AS pgene, lag(num) OVER w AS pnum, max("end") OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until,
  max("end") OVER w2 AS furthest, lead(name) OVER w AS nxt FROM e WINDOW w AS (PARTITION BY genome_id ORDER BY "start", "end", strand, name), w2 AS (PARTITION BY genome_id)),
gaps AS (SELECT genome_id, coalesce(until, 0) + 1 AS "start", "start" - 1 AS "end", CASE WHEN prev IS NULL THEN 'Start~' || name
    WHEN pgene = gene0 THEN CASE WHEN abs(pnum - num) = 1 THEN gene0 || '_intron' || least(pnum, num) END ELSE prev || '~' || name END AS name FROM l
  UNION ALL SELECT genome_id, furthest + 1, 4000, name || '~End' FROM l WHERE nxt IS NULL)
SELECT genome_id, "start"::INT AS "start", "end"::INT AS "end", '+' AS strand, name FROM gaps WHERE "start" <= "end" AND name IS NOT NULL"""

_EXONS_COMPAT = """x AS (SELECT genome_id, "start", "end", strand, gene || CASE WHEN n = 1 THEN '' ELSE '_exon' || CASE WHEN k > 1 AND k < n THEN 2 WHEN strand = '-' THEN n - k + 1 ELSE k END END AS name FROM (
  SELECT *, count(*) OVER (PARTITION BY genome_id, gene, strand) AS n, row_number() OVER (PARTITION BY genome_id, gene, strand ORDER BY "start", "end") AS k FROM u))"""
# the literal walk: a gap is written by its bounds; exons of one gene that aren't 1 and 2 or 2 and 3 are passed over, without moving on
_GAP_COMPAT = """k AS (SELECT *, row_number() OVER (PARTITION BY genome_id ORDER BY "start", "end", strand) AS n, split_part(name, '_exon', 1) AS g, contains(name, 'exon') AS ex, left(split_part(name, '_exon', 2), 1) AS no FROM x),
w(genome_id, n, prev, pg, pex, pno, until, gs, ge, gn) AS (SELECT genome_id, n, name, g, ex, no, "end", 1, "start" - 1, 'Start~' || name FROM k WHERE n = 1
  UNION ALL SELECT genome_id, n, CASE WHEN stay THEN prev ELSE name END, CASE WHEN stay THEN pg ELSE g END, CASE WHEN stay THEN pex ELSE ex END, CASE WHEN stay THEN pno ELSE no END, CASE WHEN stay THEN until ELSE "end" END,
    CASE WHEN gap AND NOT stay THEN until + 1 END, CASE WHEN gap AND NOT stay THEN "start" - 1 END,
    CASE WHEN gap AND NOT stay THEN CASE WHEN kin THEN g || CASE WHEN least(pno, no) = '1' THEN '_intron1' ELSE '_intron2' END ELSE prev || '~' || name END END
  FROM (SELECT *, gap AND kin AND NOT ((least(pno, no) = '1' AND greatest(pno, no) = '2') OR (least(pno, no) = '2' AND greatest(pno, no) = '3')) AS stay
    FROM (SELECT k.*, w.prev, w.pg, w.pex, w.pno, w.until, k."start" - w.until > 0 AS gap, w.pex AND k.ex AND w.pg = k.g AS kin FROM w JOIN k ON k.genome_id = w.genome_id AND k.n = w.n + 1))),
every AS (SELECT genome_id, n, gs, ge, gn FROM w WHERE gs IS NOT NULL UNION ALL SELECT genome_id, n + 1, until + 1, 4000, prev || '~End' FROM w QUALIFY row_number() OVER (PARTITION BY genome_id ORDER BY n DESC) = 1)
SELECT genome_id, gs::INT AS "start", ge::INT AS "end", '+' AS strand, gn AS name FROM every QUALIFY row_number() OVER (PARTITION BY genome_id, gs, ge ORDER BY n DESC) = 1"""

_EXONS = """x AS (SELECT genome_id, "start", "end", strand, gene || CASE WHEN n = 1 THEN '' ELSE '_exon' || CASE strand WHEN '-' THEN n - k + 1 ELSE k END END AS name FROM (
  SELECT *, count(*) OVER (PARTITION BY genome_id, gene, strand) AS n, row_number() OVER (PARTITION BY genome_id, gene, strand ORDER BY "start", "end") AS k FROM u))"""

# a genome with an inverted repeat; the walk goes on while the next 20 bases lie on the other strand
_IR = f"""{_G}, q AS (SELECT genome_id, seq AS s, length(seq) // 4 AS n FROM g WHERE seq <> ''), c AS (SELECT genome_id, s || {_rc('substr(s, n + 1, n)')} || substr(s, 1, n) || {_rc('substr(s, 1, n)')} AS seq FROM q),
b AS (SELECT *, length(seq) AS len, {_rc('seq')} AS rc FROM c), f AS (SELECT *, CASE WHEN len >= 40 THEN instr(seq, substr(rc, 1, 20)) - 1 ELSE -1 END AS a FROM b),
places AS (SELECT DISTINCT genome_id, substr(rc, (i + 1)::INT, 20) AS w FROM (SELECT genome_id, rc, unnest(range(0, len - 19)) AS i FROM b)),
ends AS (SELECT genome_id, min(i) AS stop FROM (SELECT genome_id, i, substr(seq, (i + 1)::INT, 20) AS w FROM (SELECT genome_id, seq, unnest(range(a + 1, len - 19)) AS i FROM f WHERE a >= 0)) ANTI JOIN places USING (genome_id, w) GROUP BY genome_id),
t AS (SELECT f.*, coalesce(stop - 1, len - 20) AS z FROM f LEFT JOIN ends USING (genome_id)),
v AS (SELECT *, CASE WHEN a >= 0 THEN instr(seq, {_rc('substr(seq, (z + 1)::INT, 20)')}) - 1 END AS second FROM t),
regions AS (SELECT genome_id, 'FULL' AS name, 1 AS "start", len AS "end" FROM v
  UNION ALL SELECT genome_id, unnest(['LSC', 'IRB', 'SSC', 'IRA']), unnest([1, a + 1, z + 21, second + 1]), unnest([a, z + 20, second, len]) FROM v WHERE second >= z + 20)
SELECT genome_id, name, "start"::INT AS "start", "end"::INT AS "end", '+' AS strand FROM regions WHERE "end" >= "start" """

_BEST = f"""{_HITS}, q AS (SELECT qseqid, sseqid, line_no, split_part(sseqid, 'XXX', 1) AS short_name, r.seq AS rseq, CASE WHEN (qend > qstart) = (send > sstart) THEN substr(g.seq, qstart, qend - qstart + 1) ELSE {_rc('substr(g.seq, qstart, qend - qstart + 1)')} END AS piece
      FROM h JOIN r ON ref_id = sseqid JOIN g ON genome_id::VARCHAR = qseqid WHERE class <> 'gene'),
best AS (SELECT short_name, qseqid AS query_id, sseqid AS ref_id, score FROM (SELECT *, {_found(_windows('rseq', 6, 6), 'piece')}::DOUBLE / len({_windows('rseq', 6, 6)}) AS score FROM q)
      QUALIFY row_number() OVER (PARTITION BY qseqid, short_name ORDER BY score DESC, line_no) = 1)"""
_BEST_RNA = f"WITH {_BEST} SELECT * FROM best"

_REGIONS = f"""{_F}, guides AS (SELECT doc_id AS guide_no, {_dna('text')} AS seq FROM documents),
      n AS (SELECT genome_id AS guide_no, "start", "end", strand, load_order, CASE load_order % 6 WHEN 0 THEN name WHEN 1 THEN 'trnL' || name || '-UAA' WHEN 2 THEN 'rrn' || name WHEN 3 THEN 'trnV' || name || '-UAC_exon' || (load_order % 3 + 1) WHEN 4 THEN name || '~psbA' ELSE name || '_intron1' END AS name FROM f),
      k AS (SELECT * FROM n WHERE (NOT contains(name, '-') AND NOT contains(name, '~') AND NOT regexp_matches(name, 'IRA|IRB|LSC|SSC|FULL|intron')) OR regexp_matches(name, '^trn\\w+-\\w\\w\\w(_exon\\d)?$')),
      last AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY guide_no, name ORDER BY load_order DESC) = 1),
      regions AS (SELECT name || 'XXX' || guide_no AS ref_id, name AS feature, guide_no, CASE WHEN contains(name, 'trn') THEN 'tRNA' WHEN contains(name, 'rrn') THEN 'rRNA' ELSE 'gene' END AS class,
        CASE WHEN strand = '-' THEN {_rc('substr(seq, "start", "end" - "start" + 1)')} ELSE substr(seq, "start", "end" - "start" + 1) END AS seq FROM last JOIN guides USING (guide_no))"""

SQL: dict[str, str] = {
    "orf_find": f"WITH {_ORFS} SELECT * FROM orfs",
    "orf_summary": f"WITH {_ORFS} SELECT genome_id, strand, count(*) AS n_orfs, max(nt) AS longest, sum(nt)::BIGINT AS total_nt FROM orfs GROUP BY ALL",
    "orf_sequences": f"WITH {_ORFS} SELECT genome_id, orf_id, substr(seq, start0 + 1, end0 - start0 + 1) AS seq FROM orfs JOIN g USING (genome_id)",
    "orf_find_compat": f"WITH {_ORFS_COMPAT} SELECT * FROM orfs",
    "nested_orfs": f"WITH {_ORFS}, {_NESTED} SELECT * FROM orfs ANTI JOIN nested USING (genome_id, orf_id)",
    "protein_pairs": f"WITH {_pairs_by_words(_ORFS, "class = 'gene'")} SELECT orf_id AS qseqid, ref_id AS sseqid FROM pairs",
    "nearest_exon": f"""WITH {_pairs_by_words(_ORFS, "contains(ref_id, '_exon2')")}, alone AS (SELECT genome_id, ref_id, any_value(orf_id) AS orf_id, any_value(start0) AS start0, any_value(end0) AS end0 FROM pairs GROUP BY genome_id, ref_id HAVING count(*) = 1),
      shorts AS (SELECT ref_id, substr(seq, 1, 7) AS m, split_part(feature, '_exon', 1) || '_exon2XXX' || guide_no AS anchor FROM r WHERE ends_with(feature, '_exon1')),
      found AS (SELECT genome_id, s.ref_id, ends_with(orf_id, '-r') AS back, start0, end0, CASE WHEN ends_with(orf_id, '-r') THEN {_rc('m')} ELSE m END AS m, g.seq FROM shorts s JOIN alone ON anchor = alone.ref_id JOIN g USING (genome_id)),
      near AS (SELECT genome_id, ref_id, back, length(m) AS n, list_min(list_transform(list_filter(range(0, greatest(0, length(seq) - length(m) + 1)), lambda i: substr(seq, (i + 1)::INT, length(m)) = m), lambda i: {{'d': abs(i - CASE WHEN back THEN end0 ELSE start0 END), 'p': i}})).p AS p FROM found)
      SELECT genome_id, ref_id, 'orfx' || row_number() OVER (PARTITION BY genome_id ORDER BY ref_id) || CASE WHEN back THEN '-r' ELSE '' END AS orf_id, (p + 1)::INT AS "start", (p + n)::INT AS "end" FROM near WHERE p IS NOT NULL""",
    "revcomp": f"WITH {_G} SELECT genome_id, {_rc('seq')} AS rc, length(seq)::INT AS len FROM g",
    "translate_six_frames": f"""WITH {_G}, s AS (SELECT genome_id, 'fwd' AS side, seq FROM g UNION ALL SELECT genome_id, 'rev', {_rc('seq')} FROM g),
      c AS (SELECT genome_id, side || frame AS k, j, coalesce({_MAP}[substr(seq, (j + 1)::INT, 3)], 'X') AS aa FROM (SELECT *, unnest(range(frame, length(seq) - 2, 3)) AS j FROM s, (VALUES (0), (1), (2)) t(frame))),
      p AS (SELECT genome_id, k, string_agg(aa, '' ORDER BY j) AS prot FROM c GROUP BY ALL)
      SELECT g.genome_id, {', '.join(f"max(prot) FILTER (k = '{k}') AS {k}" for k in ('fwd0', 'fwd1', 'fwd2', 'rev0', 'rev1', 'rev2'))} FROM g LEFT JOIN p USING (genome_id) GROUP BY g.genome_id""",
    "reference_frame": f"""WITH {_R0} SELECT ref_id, (CASE WHEN f0 >= f1 AND f0 >= f2 THEN 0 WHEN f1 >= f2 THEN 1 ELSE 2 END)::INT AS frame,
      (CASE WHEN i0 = -1 THEN 0 WHEN i2 > i0 THEN 2 WHEN i1 > i0 THEN 1 ELSE 0 END)::INT AS compat_frame FROM (SELECT *, CASE WHEN i0 = -1 THEN n + 1 ELSE i0 END AS f0, CASE WHEN i1 = -1 THEN n + 1 ELSE i1 END AS f1,
      CASE WHEN i2 = -1 THEN n + 1 ELSE i2 END AS f2 FROM (SELECT ref_id, length(seq) AS n, {', '.join(f"instr(coalesce({_protein('seq', k)}, ''), '_') - 1 AS i{k}" for k in range(3))} FROM r))""",
    "score_protein": f"WITH {_SEQS} SELECT qseqid, sseqid, {_found(_windows('o', 3, 1), 'p')}::DOUBLE / length(p) AS score FROM proteins",
    "score_protein_legacy": f"WITH {_SEQS} SELECT qseqid, sseqid, {_found(_windows('o', 3, 3), 'p')}::DOUBLE / len({_windows('o', 3, 3)}) * (length(o)::DOUBLE / length(p)) AS score FROM proteins",
    "score_rna": f"WITH {_PIECES} SELECT qseqid, sseqid, line_no::INT AS line_no, {_found(_windows('pq', 6, 6), 'oq')}::DOUBLE / len({_windows('pq', 6, 6)}) AS score FROM pieces",
    "score_six_frames": f"WITH {_SCORED} SELECT * FROM scored",
    "best_frames": f"""WITH {_PIECES}, w AS (SELECT qseqid, sseqid, line_no, {_windows(_protein('pq'), 3, 3)} AS ws, [{', '.join(_protein('oq', k) for k in range(3))}] AS fw, [{', '.join(_protein(_rc('oq'), k) for k in range(3))}] AS rv FROM pieces),
      s AS (SELECT qseqid, sseqid, line_no, list_transform(fw, lambda q: {_found('ws', 'q')}::DOUBLE / len(ws)) AS a, list_transform(rv, lambda q: {_found('ws', 'q')}::DOUBLE / len(ws)) AS b FROM w)
      SELECT qseqid, sseqid, line_no::INT AS line_no, list_max(a) AS fwd, (list_position(a, list_max(a)) - 1)::INT AS fwd_frame, list_max(b) AS rev, (list_position(b, list_max(b)) - 1)::INT AS rev_frame FROM s""",
    "frame_anchors": f"""WITH {_PIECES}, aw AS (SELECT qseqid, sseqid, line_no, coalesce({_protein('pq')}, '') AS gp, [{', '.join(f"coalesce({_protein('oq', k)}, '')" for k in range(3))}] AS fw, [{', '.join(f"coalesce({_protein(_rc('oq'), k)}, '')" for k in range(3))}] AS rv
        FROM pieces JOIN r ON ref_id = sseqid WHERE class = 'gene'),
      split AS (SELECT *, {_windows('gp', 3, 3)} AS ws FROM aw), am AS (SELECT *, list_transform(fw, lambda q: {_found('ws', 'q')}::DOUBLE / len(ws)) AS a, list_transform(rv, lambda q: {_found('ws', 'q')}::DOUBLE / len(ws)) AS b FROM split),
      ap AS (SELECT qseqid, sseqid, line_no, gp, length(gp) AS n, list_max(a) AS fwd, list_max(b) AS rev, CASE WHEN list_max(a) > list_max(b) THEN fw[list_position(a, list_max(a))] ELSE rv[list_position(b, list_max(b))] END AS pr FROM am),
      ak AS (SELECT *, CASE WHEN n >= 4 AND contains(pr, substr(gp, 2, 3)) THEN instr(pr, substr(gp, 2, 3)) - 1
          ELSE list_filter(list_transform(range(2, n - 2), lambda i: CASE WHEN contains(pr, substr(gp, (i + 1)::INT, 3)) THEN instr(pr, substr(gp, (i + 1)::INT, 3)) - 1 - i END), lambda x: x IS NOT NULL)[1] END AS near_start,
        CASE WHEN n >= 4 AND contains(pr, substr(gp, n - 3, 3)) THEN instr(pr, substr(gp, n - 3, 3)) - 1
          ELSE list_filter(list_transform(range(2, n - 2), lambda i: CASE WHEN contains(pr, substr(gp, (n - 2 - i)::INT, 3)) THEN instr(pr, substr(gp, (n - 2 - i)::INT, 3)) - 1 + i END), lambda x: x IS NOT NULL)[1] END AS near_end FROM ap),
      tails AS (SELECT *, instr(substr(pr, near_end + 1), right(gp, 4)) AS tail, instr(substr(pr, near_end + 1), right(gp, 1)) - 1 AS one, instr(substr(pr, near_end + 1), '_') - 1 AS stop FROM ak),
      ae AS (SELECT *, CASE WHEN one >= 0 THEN one + near_end ELSE -1 END AS spot, CASE WHEN stop >= 0 AND stop + near_end > 0 THEN least(stop + near_end, near_end + 5) ELSE length(pr) END AS bound FROM tails),
      placed AS (SELECT *, CASE WHEN instr(pr, right(gp, 4)) - 1 > 0 AND tail > 0 THEN tail - 1 + near_end + 3
          ELSE greatest(spot, coalesce(list_max(list_filter(range(greatest(spot, 0), bound), lambda i: substr(pr, (i + 1)::INT, 1) = right(gp, 1))), -1)) END AS place FROM ae)
      SELECT qseqid, sseqid, line_no::INT AS line_no, fwd, rev, fwd < 0.5 AND rev < 0.5 AS gated, near_start::INT AS near_start, near_end::INT AS near_end,
        (CASE WHEN near_end IS NOT NULL THEN CASE WHEN place < 0 THEN 0 ELSE length(pr) * 3 - (place * 3 + 2) - 1 END END)::INT AS match_end FROM placed""",
    "start_codons": f"""WITH {_R0} SELECT ref_id, {_last('seq', "'ATG'", '3 * (length(seq) // 6)')} AS atg, {_last('seq', 'substr(seq, 1, 3)', '3 * (length(seq) // 6) + 1')} AS own FROM r""",
    "find_all": f"""WITH {_R0}, {_G} SELECT genome_id, ref_id, list_filter(range(0, greatest(0, length(g.seq) - length(m) + 1)), lambda i: substr(g.seq, (i + 1)::INT, length(m)) = m) AS places
      FROM g JOIN (SELECT ref_id, seq AS m FROM r WHERE seq <> '') ON contains(g.seq, m)""",
    "first_places": f"""WITH {_R0}, {_G} SELECT genome_id, ref_id, (CASE WHEN contains(substr(g.seq, 101), m) THEN instr(substr(g.seq, 101), m) + 99 ELSE -1 END)::INT AS place
      FROM g JOIN (SELECT ref_id, seq AS m FROM r WHERE seq <> '') ON contains(g.seq, m)""",
    "region_extract": f"WITH {_REGIONS} SELECT * FROM regions",
    "region_files": f"WITH {_REGIONS} SELECT class, ref_id, seq FROM regions",
    "short_exons": f"WITH {_REGIONS} SELECT ref_id, class, length(seq)::INT AS len, CASE WHEN class = 'gene' THEN length(seq) < 25 ELSE length(seq) < 26 END AS short FROM regions",
    "ir_regions": f"WITH {_IR}",
    "seed_search": f"WITH {_HITS} SELECT qseqid, sseqid, length, mismatch, 0::INT AS gapopen, qstart, qend, sstart, send, round(pident, 6) AS pident, round(log10(evalue), 6) AS log10_evalue, round(bitscore, 6) AS bitscore FROM h",
    "hit_files": f"WITH {_HITS} SELECT qseqid, sseqid, length, mismatch, 0::INT AS gapopen, qstart, qend, sstart, send, round(pident, 6) AS pident, round(log10(evalue), 6) AS log10_evalue, round(bitscore, 6) AS bitscore FROM h",
    "hit_filter": f"WITH {_HITS} SELECT qseqid, sseqid, qstart, qend, sstart, send FROM h WHERE NOT contains(sseqid, 'intron') AND pident >= 0.5 AND evalue <= 0.1 AND NOT (contains(sseqid, 'rpl16') AND NOT contains(qseqid, '-r'))",
    "hit_pairs": f"WITH {_HITS} SELECT qseqid, sseqid, count(*) AS n_hsps FROM h GROUP BY ALL",
    "hit_strand": f"WITH {_HITS} SELECT qseqid, sseqid, qstart, CASE WHEN (qend > qstart AND send > sstart) OR (qend < qstart AND send < sstart) THEN '+' ELSE '-' END AS strand FROM h",
    "hsp_coverage": f"""WITH {_HITS}, p AS (SELECT DISTINCT qseqid, sseqid, unnest(range(least(sstart, send), greatest(sstart, send) + 1)) AS b FROM h)
      SELECT qseqid, sseqid, count(*) AS covered, length(seq)::INT AS ref_len, count(*)::DOUBLE / length(seq) AS fraction FROM p JOIN r ON ref_id = sseqid GROUP BY qseqid, sseqid, seq""",
    "covered_pairs": f"""WITH {_HITS}, p AS (SELECT DISTINCT qseqid, sseqid, unnest(range(least(sstart, send), greatest(sstart, send) + 1)) AS b FROM h)
      SELECT qseqid, sseqid, count(*) AS covered, length(seq)::INT AS ref_len, count(*)::DOUBLE / length(seq) AS fraction FROM p JOIN r ON ref_id = sseqid GROUP BY qseqid, sseqid, seq HAVING count(*)::DOUBLE / length(seq) >= 0.9""",
    "coverage_tiers": f"""WITH {_HITS} SELECT sseqid, qseqid, n::INT AS ref_len, max(f) AS fraction FROM (SELECT sseqid, qseqid, length(seq) AS n, (abs(send - sstart) + 1)::DOUBLE / length(seq) AS f FROM h JOIN r ON ref_id = sseqid)
      GROUP BY sseqid, qseqid, n HAVING max(f) >= CASE WHEN n > 4500 THEN 0.20 WHEN n > 1400 THEN 0.30 ELSE 0.65 END""",
    "best_reference": f"WITH {_SCORED} SELECT qseqid AS orf_id, sseqid AS ref_id, score FROM scored WHERE score >= 0.7 QUALIFY row_number() OVER (PARTITION BY qseqid ORDER BY score DESC, sseqid) = 1",
    "best_orf_files": f"WITH {_SCORED} SELECT qseqid AS query_id, sseqid AS ref_id, score FROM scored WHERE score >= 0.7 QUALIFY row_number() OVER (PARTITION BY qseqid ORDER BY score DESC, sseqid) = 1",
    "best_rna_hits": _BEST_RNA,
    "best_rna_files": f"SELECT query_id, ref_id FROM ({_BEST_RNA})",
    "rna_candidates": f"""WITH {_BEST} SELECT qseqid, sseqid AS ref_id, 'orfRNA' || row_number() OVER (PARTITION BY qseqid ORDER BY line_no) || CASE WHEN send < sstart THEN '-r' ELSE '' END AS orf_id, qstart AS "start", qend AS "end"
      FROM h SEMI JOIN (SELECT query_id AS qseqid, ref_id AS sseqid FROM best) USING (qseqid, sseqid) JOIN r ON ref_id = sseqid WHERE (abs(send - sstart) + 1)::DOUBLE / length(seq) >= 0.97 AND class <> 'gene'""",
    "dedupe_last": f"WITH {_F}, {_U} SELECT genome_id, \"start\", \"end\", strand, name FROM u",
    "locus_best": f"""WITH {_F}, i AS (SELECT *, sum(new) OVER (PARTITION BY genome_id, gene ORDER BY "start", "end", load_order ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN "start" <= max("end") OVER (PARTITION BY genome_id, gene ORDER BY "start", "end", load_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM f))
      SELECT genome_id, gene, "start", "end", score, load_order FROM i QUALIFY row_number() OVER (PARTITION BY genome_id, gene, island ORDER BY score DESC, load_order) = 1""",
    "containment": f"""WITH {_F}, {_U} SELECT genome_id, "start", "end", strand, name FROM u a WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.genome_id = a.genome_id AND b."start" <= a."start" AND b."end" >= a."end" AND (b."start" < a."start" OR b."end" > a."end"))""",
    "overlap_depth": f"""WITH {_F}, d AS (SELECT genome_id, p, count(*) AS depth FROM (SELECT genome_id, unnest(range("start", "end" + 1)) AS p FROM f) GROUP BY ALL),
      k AS (SELECT *, p - row_number() OVER (PARTITION BY genome_id, depth ORDER BY p) AS grp FROM d)
      SELECT genome_id, min(p)::INT AS "start", max(p)::INT AS "end", depth::INT AS depth FROM k GROUP BY genome_id, depth, grp""",
    "overlap_members": f"""WITH {_F}, b AS (SELECT DISTINCT genome_id, unnest(["start", "end" + 1]) AS s FROM f), c AS (SELECT genome_id, s, lead(s) OVER (PARTITION BY genome_id ORDER BY s) - 1 AS e FROM b)
      SELECT c.genome_id, s::INT AS "start", e::INT AS "end", string_agg(DISTINCT load_order::VARCHAR, ',' ORDER BY load_order::VARCHAR) AS members FROM c JOIN f ON f.genome_id = c.genome_id AND f."start" <= e AND s <= f."end" GROUP BY ALL""",
    "union_length": f"""WITH {_F} SELECT genome_id, strand, count(DISTINCT p) AS covered FROM (SELECT genome_id, strand, unnest(range("start", "end" + 1)) AS p FROM f) GROUP BY ALL""",
    "overlap_join": f"""WITH {_F}, {_U} SELECT a.genome_id, count(*) AS n_pairs, sum(least(a."end", b."end") - greatest(a."start", b."start") + 1)::BIGINT AS shared FROM u a JOIN u b
      ON a.genome_id = b.genome_id AND a."start" <= b."end" AND b."start" <= a."end" GROUP BY ALL""",
    "gap_fill": f"WITH {_F}, {_U}, src AS (SELECT genome_id, \"start\", \"end\", strand, name FROM u), {_GAP}",
    "gap_fill_exons": f"WITH {_F}, {_U}, {_EXONS}, src AS (SELECT * FROM x), {_GAP}",
    "gap_fill_compat": f"WITH RECURSIVE {_F}, {_U}, {_EXONS_COMPAT}, {_GAP_COMPAT}",
    "gff_import": f"WITH {_F}, {_U}, {_EXONS}, src AS (SELECT * FROM x), {_GAP} UNION ALL SELECT * FROM x",
    "converter_files": f"WITH {_F}, {_U}, {_EXONS}, src AS (SELECT * FROM x), {_GAP} UNION ALL SELECT * FROM x",
    "gff_files": f"WITH {_F}, {_U}, {_EXONS}, src AS (SELECT * FROM x), {_GAP} UNION ALL SELECT * FROM x",
    "genbank_import": f"WITH {_F}, {_U}, src AS (SELECT genome_id, \"start\", \"end\", strand, name FROM u), {_GAP.replace('~', '-')} UNION ALL SELECT * FROM src",
    "genbank_files": f"WITH {_F}, {_U}, src AS (SELECT genome_id, \"start\", \"end\", strand, name FROM u), {_GAP.replace('~', '-')} UNION ALL SELECT * FROM src",
    "fasta_files": f"WITH {_G} SELECT genome_id, genome_id::VARCHAR AS id, seq FROM g",
    "genome_files": f"WITH {_G} SELECT genome_id, seq FROM g",
    "orf_fasta_files": f"WITH {_ORFS} SELECT genome_id, orf_id, substr(seq, start0 + 1, end0 - start0 + 1) AS seq FROM orfs JOIN g USING (genome_id)",
    "guide_append_files": f"WITH {_REGIONS} SELECT class, guide_no % 20 AS guide_no, ref_id, seq FROM regions",
    "hit_counters": f"""WITH {_HITS} SELECT unnest(['kept_rows', 'seen_intron', 'seen_reverse', 'seen_rows', 'seen_weak']) AS counter, unnest([
      count(*) FILTER (NOT contains(sseqid, 'intron') AND pident >= 0.5 AND evalue <= 0.1 AND NOT contains(sseqid, 'rpl16')), count(*) FILTER (contains(sseqid, 'intron')), count(*) FILTER (contains(sseqid, 'rpl16')), count(*), count(*) FILTER (evalue > 0.1)]) AS n FROM h""",
    "genbank_sql": f"""WITH {_F}, {_U} SELECT genome_id % 50 AS file, (dense_rank() OVER (PARTITION BY genome_id % 50 ORDER BY genome_id) - 1)::INT AS record, 'X' AS locus, 4000::INT AS len, name, "start", "end", strand FROM u""",
    "orf_stream": f"WITH {_ORFS} SELECT * FROM orfs",
    "orf_files": f"WITH {_ORFS} SELECT genome_id, orf_id, start0, end0 FROM orfs",
    "feature_files": f"WITH {_F}, {_U} SELECT genome_id, \"start\", \"end\", strand, name FROM u",
    "guide_list": "SELECT row_number() OVER (ORDER BY n_name)::INT AS guide_no, n_name AS guide FROM nation",
    "exon_number": f"WITH {_F}, {_U}, {_EXONS} SELECT * FROM x",
    "exon_bounds": f"WITH {_F}, {_U} SELECT genome_id, gene, strand, min(\"start\") AS gene_start, max(\"end\") AS gene_end, count(*) AS n_exons FROM u GROUP BY ALL",
    "exon_catalogue": f"""WITH {_F}, {_U}, {_EXONS} SELECT genome_id, coalesce(nullif(regexp_extract(name, '^(.+)_exon\\d+', 1), ''), name) AS gene, count(DISTINCT name) AS n_exons FROM x GROUP BY ALL""",
    "overlap_clean": f"""WITH RECURSIVE {_F}, {_U}, k AS (SELECT *, row_number() OVER (PARTITION BY genome_id, gene ORDER BY "end" - "start" DESC, orf_id) AS n FROM (SELECT *, 'o' || row_number() OVER (PARTITION BY genome_id, gene ORDER BY "start", "end", strand) AS orf_id FROM u)),
      w(genome_id, gene, n, kept) AS (SELECT DISTINCT genome_id, gene, 0::BIGINT, []::STRUCT(s INT, e INT, o VARCHAR)[] FROM k UNION ALL
        SELECT k.genome_id, k.gene, k.n, CASE WHEN len(list_filter(w.kept, lambda t: (t.s < k."start" AND k."end" < t.e) OR (k."start" < t.s AND t.e < k."end") OR (t.s < k."start" AND k."start" < t.e AND t.e < k."end") OR (k."start" < t.s AND t.s < k."end" AND k."end" < t.e))) = 0
          THEN list_append(w.kept, {{'s': k."start", 'e': k."end", 'o': k.orf_id}}) ELSE w.kept END FROM w JOIN k ON k.genome_id = w.genome_id AND k.gene = w.gene AND k.n = w.n + 1)
      SELECT genome_id, gene, t.o AS orf_id, t.s AS "start", t.e AS "end" FROM (SELECT genome_id, gene, unnest(kept) AS t FROM w QUALIFY row_number() OVER (PARTITION BY genome_id, gene ORDER BY n DESC) = 1)""",
}
