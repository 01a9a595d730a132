"""Forms that hold at scale, against brute force: nested bins, dense places, islands, cells of two ends, the null model by
signature, stored alignments, files of a cohort, admitted VCFs, junctions proved from reads."""

import gzip
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from juncture.operators import admission, binding, confidence, cross, master, proof, ranges, reads
from juncture.plans import null_model
from juncture.sources import readers, stored, writers
from juncture.streaming import ingest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Ranges


def spliced(rng, n):
    """Reads of 100 bases, some over gaps of up to 500,000, a few longer than the widest bin."""
    rows = []
    for k in range(n):
        start = rng.randrange(0, 3_000_000)
        gap = rng.choice([0, 0, 0, 90, 900, 1000, 7_999, 64_000, 500_000, 5_000_000])
        rows.append((k, "c", start, start + 100 + gap))
    return rows


def test_nested_bins_against_brute_force(spark):
    rng = random.Random(1)
    b = spliced(rng, 400)
    a = [(k, "c", s, s + rng.choice([0, 400, 30_000])) for k, s in enumerate(rng.randrange(0, 3_000_000) for _ in range(60))]
    left, right = spark.createDataFrame(a, "i int, c string, a0 long, a1 long"), spark.createDataFrame(b, "j int, c string, b0 long, b1 long")
    want = sorted((i, j) for i, _, a0, a1 in a for j, _, b0, b1 in b if a0 <= b1 and b0 <= a1)
    for few in (None, 0, 1000):
        got = ranges.overlapping(left, right, ["c"], ("a0", "a1"), ("b0", "b1"), 1000, few)
        assert sorted((r.i, r.j) for r in got.collect()) == want


def test_a_read_takes_one_row_however_long_its_gap(spark):
    rows = spark.createDataFrame([(0, 100 + gap) for gap in (0, 1000, 500_000, 3_000_000)], "s long, e long")
    assert rows.select(F.explode(ranges.nested_place(F.col("s"), F.col("e"), 1000))).count() == 4


def test_nearest_in_a_dense_place(spark):
    """Nine tenths of all rows lie in one bin: it is cut into parts of about the stated size, and the answers stay."""
    rng = random.Random(2)
    place = lambda: rng.randrange(500_000, 501_000) * 7 if rng.random() < 0.9 else rng.randrange(0, 10**8)
    refs, points = [("c", place(), f"t{k}") for k in range(900)], [(k, "c", place()) for k in range(300)]
    df, ref = spark.createDataFrame(points, "k int, c string, pos long"), spark.createDataFrame(refs, "c string, pos long, t string")
    got = {r.k: (r.near_distance, r.near_pos, r.near_t) for r in ranges.nearest(df, ref, ["c"], "pos", ["t"], 1_000_000, 50).collect()}
    for k, _, p in points:
        before, after = max(((q, t) for _, q, t in refs if q < p), default=None), min(((q, t) for _, q, t in refs if q >= p), default=None)
        best = before if after is None or (before and p - before[0] <= after[0] - p) else after
        assert got[k] == (abs(best[0] - p), *best)
    rows = ref.select("c", "pos").distinct()
    parts = ranges._placed(rows, ["c"], "pos", 1_000_000, 50)
    sizes = [r["count"] for r in parts.groupBy("_bin", "_part").count().collect()]
    assert max(sizes) <= 100 < max(r["count"] for r in parts.groupBy("_bin").count().collect())


def test_nearest_with_one_place_and_nulls(spark):
    df = spark.createDataFrame([(1, "c", 5), (2, "c", None), (3, None, 5), (4, "d", 5)], "k int, c string, pos long")
    ref = spark.createDataFrame([("c", 5, "x"), ("c", 5, "a")] * 50, "c string, pos long, t string")
    got = {r.k: (r.near_distance, r.near_t) for r in ranges.nearest(df, ref, ["c"], "pos", ["t"], 10, 3).collect()}
    assert got == {1: (0, "a"), 2: (None, None), 3: (None, None), 4: (None, None)}


@pytest.mark.parametrize("width", [7, 50, 10**6])
def test_islands_over_many_parts(spark, width):
    rng = random.Random(width)
    rows = [(k % 3, s, s + rng.choice([0, 1, 3, 10, 200])) for k, s in enumerate(rng.randrange(0, 3000) for _ in range(300))] + [(9, 0, 2900), (9, 5, 6), (9, 2901, 2902)]
    want = []
    for key in sorted({k for k, _, _ in rows}):
        for s, e in sorted((s, e) for k, s, e in rows if k == key):
            if want and want[-1][0] == key and s <= want[-1][2]:
                want[-1][2] = max(want[-1][2], e)
            else:
                want.append([key, s, e])
    got = ranges.merge_intervals(spark.createDataFrame(rows, "k int, s long, e long"), ["k"], "s", "e", width, 20)
    assert sorted([r.k, r.s, r.e] for r in got.collect()) == want


def test_panel_cells_on_a_hot_end(spark):
    """Many records share the first end; a query meets those near its other end, and the answers are those of all pairs."""
    rng = random.Random(4)
    panel = []
    for _ in range(400):
        s1, s2 = (1000 if rng.random() < 0.7 else rng.randrange(0, 10**6)), rng.randrange(0, 10**6)
        panel.append(("1", s1, s1 + rng.choice([0, 20, 5000, 2_500_000]), rng.choice("12"), s2, s2 + rng.choice([0, 30, 40_000]), rng.randrange(100)))
    asks = [(k, *(("1", 1005, rng.choice("12"), rng.randrange(0, 10**6)) if k % 2 else (rng.choice("12"), rng.randrange(0, 10**6), "1", 1010))) for k in range(80)]
    slop = 10
    want = {}
    for k, c1, p1, c2, p2 in asks:
        inside = lambda p, s, e: s - slop <= p <= e + slop
        hits = [n for a, s1, e1, b, s2, e2, n in panel if (a == c1 and b == c2 and inside(p1, s1, e1) and inside(p2, s2, e2)) or (b == c1 and a == c2 and inside(p1, s2, e2) and inside(p2, s1, e1))]
        want[k] = (max(hits, default=0), bool(hits))
    df = spark.createDataFrame(asks, "k int, chrom1 string, pos1 long, chrom2 string, pos2 long")
    table = spark.createDataFrame(panel, "chrom1 string, start1 long, end1 long, chrom2 string, start2 long, end2 long, count int")
    assert {r.k: (r.panel_count, r.in_panel) for r in confidence.panel_lookup(df, table, "k", slop).collect()} == want


# Null model


def test_null_by_signature_equals_all_shuffles(spark, monkeypatch):
    rng = random.Random(6)
    words = ["".join(rng.choice("AB") for _ in range(rng.randrange(2, 5))) for _ in range(40)] + ["ABC", "CCC", "XYZ", ""]
    known = [w[::-1] for w in words[:25]] + ["CAB", "BCA", "ZZZ"]
    a, b = spark.createDataFrame([(w,) for w in words], "p string"), spark.createDataFrame([(w,) for w in known], "p string")
    every = a.distinct().filter("p <> ''").withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(30)))).select("perm", null_model.shuffle(F.col("p"), F.col("perm")).alias("t")).distinct().collect()
    want = Counter({k: 0 for k in range(1, 31)})
    want.update(r.perm for r in every if r.t in set(known))
    for targets in (1000, 2):
        monkeypatch.setattr(null_model, "TARGETS", targets)
        got = null_model.permutation_counts(a, b, "p", 30)
        assert {r.perm: r.hits for r in got.collect()} == dict(want)
    # A candidate that no catalogue text has the letters of isn't shuffled at all.
    assert null_model.shuffled_hits(spark.createDataFrame([("QQQ",)], "p string"), b, "p", 1000).count() == 0


# Stored forms


def alignments(spark, rows):
    return spark.createDataFrame(rows, "sample string, chrom string, qname string, start0 long, mapq int, flag int, cigar string, seq string, sa_tag string")


def test_stored_alignments_are_read_by_region(spark, tmp_path):
    rng = random.Random(8)
    rows = [("s", rng.choice("12"), f"q{k}", rng.randrange(0, 20_000_000), 60, 0, rng.choice(["100M", "50M500000N50M", "50M6000000N50M"]), "A", None) for k in range(500)]
    path = f"file://{tmp_path}/reads"
    stored.write_alignments(alignments(spark, rows), path, 4)
    loci = spark.createDataFrame([(k, "s", rng.choice("1"), p, p + 400) for k, p in enumerate(rng.randrange(0, 6_000_000) for _ in range(20))], "k int, sample string, chrom string, w0 long, w1 long")
    ends = {"100M": 100, "50M500000N50M": 500_100, "50M6000000N50M": 6_000_100}
    want = sorted((x.k, q) for x in loci.collect() for _, c, q, s, _, _, g, _, _ in rows if c == x.chrom and s <= x.w1 and s + ends[g] >= x.w0)
    for few in (0, 100):
        got = stored.alignments_at(spark, path, loci, "w0", "w1", ["sample"], few)
        assert sorted((r.k, r.qname) for r in got.collect()) == want
    pruned = plan(stored.alignments_at(spark, path, loci, "w0", "w1", ["sample"]))
    assert "dynamicpruning" in pruned and "SortMergeJoin" not in pruned
    # The stored side is filtered and joined where it is read: no exchange lies between its scan and the join.
    assert not any("Exchange" in x for x in above(pruned, "FileScan parquet"))


def above(text, node):
    """Lines of the nodes over the first one of that name, up to the join."""
    lines = text.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    k = next(i for i, x in enumerate(lines) if node in x)
    out, least = [], depth(lines[k])
    for x in reversed(lines[:k]):
        if depth(x) < least:
            least = depth(x)
            if "Join" in x:
                return out
            out.append(x)
    return out


def test_stored_reads_of_a_breakend_stay_where_they_met(spark, tmp_path):
    """More breakends than are sent to tasks: same evidence, and pairs are not shuffled; longer reads and shared ids meet as before."""
    rng = random.Random(9)
    events = [("s", f"e{k}", "1", p, "1", p + 90 + 10 * (k % 3), "DEL", 90 + 10 * (k % 3), 0, None) for k, p in enumerate(rng.randrange(1_700, 4_300) for _ in range(30))]
    events = spark.createDataFrame(events, "sample string, sample_sv_id string, chrom1 string, pos1 long, chrom2 string, pos2 long, svtype string, event_size int, insert_len int, insert_seq string")
    rows = [("s", "1", rng.choice([None, *(f"q{j}" for j in range(40))]), rng.randrange(1_200, 4_800), rng.choice([5, 60]), 0, f"50M{rng.choice([0, 90, 100])}N50M", "A", None) for _ in range(400)]
    loci, reach = reads.breakend_windows(events), reads.window_reach(events)
    for more, cells in (([], True), ([("s", "1", "long", 1_500, 60, 0, "50M2000N50M", "A", None)], False)):
        path = f"file://{tmp_path}/reads-{cells}"
        stored.write_alignments(alignments(spark, rows + more), path, 3)
        met = {few: stored.alignments_at(spark, path, loci, "w0", "w1", ["sample"], few, reach) for few in (0, 20_000)}
        assert ("_cell" in met[0].columns) == cells and "_cell" not in met[20_000].columns
        assert met[0].count() == met[20_000].count() > 1_000
        near, sent = (reads.fragment_evidence(met[few]) for few in (0, 20_000))
        assert not cells or plan(near).count("Exchange hashpartitioning") == 2
        assert Counter(map(tuple, near.collect())) == Counter(map(tuple, sent.collect()))
    assert reach == 400 and reads.window_reach(events.unionByName(events.limit(1))) is None


def test_cells_of_many_rows_are_dealt_by_count(spark, monkeypatch):
    """Many rows in few bytes are not put together in one task, whose groups would spill."""
    a = spark.range(300).selectExpr("id as i", "id % 2 as c", "id * 3 as a0", "id * 3 + 5 as a1")
    b = spark.range(300).selectExpr("id as j", "id % 2 as c", "id * 3 as b0", "id * 3 + 9 as b1")
    met = {}
    for rows in (250_000, 20):
        monkeypatch.setattr(ranges, "CELL_ROWS", rows)
        out = ranges.overlapping(a, b, ["c"], ("a0", "a1"), ("b0", "b1"), 10, 0, 5)
        met[rows] = plan(out).count("REPARTITION_BY_NUM"), out.rdd.getNumPartitions(), sorted((r.i, r.j) for r in out.select("i", "j").collect())
    assert met[20][2] == met[250_000][2] and len(met[20][2]) > 500
    assert met[250_000][0] == 0 and met[20][0] == 2 and met[20][1] == 15


def test_stored_reads_are_walked_when_written(spark, tmp_path):
    """Clips, a read over two regions, and one without a CIGAR."""
    rows = [("s", "1", "a", 10, 60, 0, "5S20M7N30M", "A", None), ("s", "1", "b", 20, 60, 0, None, "A", None), ("s", "1", "c", 5, 60, 0, "50M6000000N50M", "A", None)]
    stored.write_alignments(alignments(spark, rows), f"file://{tmp_path}/reads", 2)
    got = Counter((r.qname, r.end0, tuple(map(tuple, r.gaps or ())), r.softclip, r._level, r._bin, r.region) for r in spark.read.parquet(f"file://{tmp_path}/reads").collect())
    long = [("c", 6_000_105, ((55, 6_000_000),), 0, 5, k, k) for k in (0, 1)]
    assert got == Counter([("a", 67, ((30, 7),), 5, 0, 0, 0), ("b", None, (), None, None, None, None), *long])


def test_stored_population_is_pruned_by_chromosome(spark, tmp_path):
    path = f"file://{tmp_path}/sites"
    stored.write_population(spark.createDataFrame([(str(k % 4), k * 10, k * 10 + 9, 0.1 + k / 1000, 0.02) for k in range(40)], "chrom string, start long, end long, af double, af_afr double"), path)
    events = spark.createDataFrame([(1, "2", "2", 20, 29, 8)], "k int, chrom1 string, chrom2 string, pos1 long, pos2 long, event_size int")
    found = confidence.population_frequency(events, stored.read_population(spark, path), "k")
    assert [(r.k, r.popmax) for r in found.collect()] == [(1, 0.02)] and "dynamicpruning" in plan(found)


# Cohort files and admitted VCFs


def test_a_cut_file_stops_no_other(spark, tmp_path):
    src, out, mark, bad, done = (tmp_path / n for n in ("in", "out", "mark", "bad", "done"))
    src.mkdir()
    good = "neoantigen\tn\nAAA\t1\nBBB\t2\n"
    (src / "p1.tsv").write_text(good)
    (src / "p2.tsv.gz").write_bytes(gzip.compress(good.encode()))
    (src / "p3.tsv.gz").write_bytes(gzip.compress(good.encode() * 50)[:40])
    (src / "p4.tsv").write_bytes(b"neoantigen\tn\n\xff\xfe\t1\n")
    (src / "p5.tsv").write_text("neoantigen\tn\nCCC\tx\n")
    (src / "p6.tsv").write_text("")
    ingest.ingest_available(spark, str(src), "neoantigen string, n int", str(out), str(mark), str(bad), str(done))
    assert sorted((r.patient, r.neoantigen, r.n) for r in spark.read.parquet(str(out)).collect()) == [("p1", "AAA", 1), ("p1", "BBB", 2), ("p2", "AAA", 1), ("p2", "BBB", 2)]
    failed = {r.patient: r.example for r in spark.read.parquet(str(bad)).collect()}
    assert set(failed) == {"p3", "p4", "p5"} and failed["p3"].startswith("unreadable file") and failed["p5"] == "CCC\tx"
    assert {r.patient for r in spark.read.parquet(str(done)).collect()} == {"p1", "p2"}


def test_admitted_vcfs_byte_for_byte(spark, tmp_path):
    """Two samples, one of which has unusable ids: header first, then the kept lines as they were, in file order."""
    head = ["##fileformat=VCFv4.2", "##source=x y", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    line = lambda k, i, pon: f"chr1\t{k}\t{i}\tA\tA[chr2:{k + 9}[\t50\tPASS\tSVTYPE=BND;MATEID=m{k};PON_COUNT={pon};NOTE=é {k}"
    one = [line(900 - k, f"a{k}", k % 20) for k in range(60)]
    two = [line(k, "." if k % 3 else f"b{k}", k % 14) for k in range(40)]
    (tmp_path / "s1.vcf").write_text("\n".join(head + one) + "\n")
    (tmp_path / "s2.vcf").write_text("\n".join(head[:1] + two) + "\n")
    paths = [f"file://{tmp_path}/{n}.vcf" for n in ("s1", "s2")]
    admitted = admission.admit(readers.read_breakends(spark, paths), "germline", 10)
    writers.write_admitted(readers.read_lines(spark, paths), admitted, f"file://{tmp_path}/out")
    kept = {"s1": head + [x for k, x in enumerate(one) if k % 20 < 10], "s2": head[:1] + [x for k, x in enumerate(two) if k % 14 < 10]}
    for sample, want in kept.items():
        files = list((tmp_path / "out" / f"sample={sample}").glob("part-*"))
        assert len(files) == 1 and files[0].read_bytes().decode() == "\n".join(want) + "\n"


# Junction proof


@pytest.mark.parametrize("strand", ["+", "-"])
def test_proof_of_a_deletion(spark, strand):
    """Coding blocks 101-160 and 301-340; bases 121-150 are lost. Reads hold the breakpoints' seam; gaps lie 2 bases on."""
    rng = random.Random(strand)
    cds = "ATG" + "".join(rng.choice("ACGT") for _ in range(97))
    places = [*range(101, 161), *range(301, 341)][:: 1 if strand == "+" else -1]
    without = lambda low, high: "".join(b for b, p in zip(cds, places, strict=True) if not low < p < high)
    seam = lambda low, high: sum(1 for p in places if (p <= low if strand == "+" else p >= high))
    at, mutant = seam(120, 151), without(120, 151)
    assert proof_row(spark, strand, cds, [mutant[at - 20 : at + 20]] * 3 + ["ACGTACGTAC"])["breakpoint_hits"] == 3
    other, moved = without(122, 153), seam(122, 153)
    back = {"A": "T", "C": "G", "G": "C", "T": "A"}
    got = proof_row(spark, strand, cds, ["".join(back[b] for b in reversed(other[moved - 20 : moved + 20]))] * 2)
    assert (got["supported"], got["gap"], got["gap_hits"], got["breakpoint_hits"]) == ("gap", "123-152", 2, 0)
    assert (got["coding_removed"], got["in_frame"], got["own_gaps"], got["other_gaps"]) == (30, True, 0, 2)


def proof_row(spark, strand, cds, sequences):
    events = spark.createDataFrame([(1, "s", "c", 120, 151, "t")], "k int, sample string, chrom string, pos1 long, pos2 long, transcript_id string")
    transcripts = spark.createDataFrame([("t", strand, [(101, 160), (301, 340)], cds)], "transcript_id string, strand string, cds_blocks array<struct<start:long,end:long>>, cds string")
    rows = [("s", "c", f"q{k}", 100, 60, 0, "22M30N40M", s, None) for k, s in enumerate(sequences)]
    return proof.prove_junctions(events, transcripts, alignments(spark, rows), ["k"]).first().asDict()


def test_proof_without_reads_or_transcript(spark):
    events = spark.createDataFrame([(1, "s", "c", 120, 151, "none")], "k int, sample string, chrom string, pos1 long, pos2 long, transcript_id string")
    transcripts = spark.createDataFrame([], "transcript_id string, strand string, cds_blocks array<struct<start:long,end:long>>, cds string")
    row = proof.prove_junctions(events, transcripts, alignments(spark, []), ["k"]).first()
    assert (row.supported, row.reads, row.novel, row.spanning) == ("neither", 0, None, None)


def test_proof_counts_reads_where_they_met(spark):
    """Events meet their reads in cells, each side shuffled once a pass: the same rows as by nested bins, and as by brute force."""
    rng = random.Random(11)
    events = [("e", k, rng.choice("st"), rng.choice("123"), p, p + 31 + k % 2, rng.choice(["u", "v", "w"])) for k, p in enumerate(rng.randrange(1_000, 9_000) for _ in range(40))]
    blocks = {"u": ("+", [(900, 9_100)]), "v": ("-", [(900, 4_000), (4_500, 9_100)])}
    codes = {t: (strand, b, "".join(rng.choice("ACGT") for _ in range(sum(y - x + 1 for x, y in b)))) for t, (strand, b) in blocks.items()}
    back = str.maketrans("ACGT", "TGCA")
    rows = []
    for k in range(600):
        _, _, sample, _, low, high, t = rng.choice(events)
        start, size = low + rng.choice([0, 0, 2, 5]), high - low - 1 + rng.choice([0, 0, 1])
        seq = None
        if t in codes:
            strand, b, cds = codes[t]
            places = [p for x, y in b for p in range(x, y + 1)][:: 1 if strand == "+" else -1]
            kept = "".join(c for c, p in zip(cds, places, strict=True) if start - 30 < p <= start or start + size < p <= start + size + 30)
            seq = rng.choice([kept, kept[::-1].translate(back), "ACGT", None])
        rows.append((sample, rng.choice("12"), f"q{k}", start - 29, rng.choice([5, 60, 60]), 0, rng.choice([f"30M{size}N30M"] * 8 + [f"30M{size}N30M{size}N9M", None]), seq, None))
    events = spark.createDataFrame(events, "e string, k int, sample string, chrom string, pos1 long, pos2 long, transcript_id string")
    transcripts = spark.createDataFrame([(t, *x) for t, x in codes.items()], "transcript_id string, strand string, cds_blocks array<struct<start:long,end:long>>, cds string")
    reads_ = alignments(spark, rows)
    near = proof.prove_junctions(events, transcripts, reads_, ["e", "k"])
    assert plan(near).count("Exchange hashpartitioning") == 6
    got, bins = near.collect(), proof.prove_junctions(events, transcripts, reads_, ["e", "k"], levels=[0, 1]).collect()
    assert len(got) == 40 and sorted(map(repr, got)) == sorted(map(repr, bins))
    assert {r.supported for r in got} == {"breakpoint", "gap", "neither"} and any(r.gap and not r.gap_hits for r in got)
    step = lambda g: [(n, x) for n, x in ((int(x[:-1]), x[-1]) for x in (g or "").replace("M", "M ").replace("N", "N ").split())]
    for e, r in ((e, r) for e in events.collect() for r in got if r.k == e.k):
        n, own, other = 0, 0, 0
        for sample, chrom, _, start, mapq, _, cigar, _, _ in rows:
            end = start + sum(x for x, _ in step(cigar))
            if cigar and (sample, chrom) == (e.sample, e.chrom) and start <= e.pos2 + 400 and end >= e.pos1 - 400:
                n, at = n + 1, start
                for length, kind in step(cigar):
                    if kind == "N" and length == e.pos2 - e.pos1 - 1 and mapq >= 20:
                        own, other = own + (at == e.pos1), other + (at != e.pos1)
                    at += length
        assert (r.reads, r.own_gaps, r.other_gaps) == (n, own, other)


# Distinct counts


def test_no_copies_of_rows_for_distinct_counts(spark):
    rows = spark.createDataFrame([("l", "v", "P", True, False, 0.5, "f")] * 3 + [("l", "v", "Q", False, False, 0.1, "g"), ("l", "w", None, True, True, None, None)], "line string, sv string, peptide string, binds boolean, clean boolean, rank double, fact string")
    out = master.peptide_rows_to_events(rows, ["line", "sv"], ["binds", "clean"], ["rank"], ["fact"])
    assert [(r.sv, r.n_peptides, r.peptides, r.any_binds, r.n_binds, r.n_clean, r.best_rank, r.fact) for r in out.sort("sv").collect()] == [("v", 2, ["P", "Q"], True, 1, 0, 0.1, "f"), ("w", 0, [], True, 0, 0, None, None)]
    pairs = spark.createDataFrame([("p", "n", 1)], "patient string, neoantigen string, x int")
    own = binding.autologous(pairs, spark.createDataFrame([("p", "A1"), ("p", "B9")], "patient string, allele string"), spark.createDataFrame([("n", "A1")], "peptide string, allele string"), spark.createDataFrame([("A1",)], "allele string"))
    assert [(r.patients, r.patients_typed, r.patients_presenting, r.alleles_outside, r.presenting_alleles, r.verdict) for r in own.collect()] == [(1, 1, 1, 1, ["A1"], "binder")]
    variants = spark.createDataFrame([("s", "1"), ("s", "2")], "sample string, sample_sv_id string")
    made = spark.createDataFrame([("s", "1", "X"), ("s", "1", "X"), ("s", "1", "Y")], "sample string, sample_sv_id string, neopeptide string")
    hit = spark.createDataFrame([("s", "1", "X", "g2", True), ("s", "1", "X", "g1", False), ("s", "1", "Y", "g1", False)], "sample string, sample_sv_id string, ref_peptide string, ref_gene string, credible boolean")
    counts = cross.counts_per_variant(variants, made, hit)
    assert [(r.n_generated, r.n_matched, r.n_credible, r.catalogue_genes) for r in counts.sort("sample_sv_id").collect()] == [(2, 2, 1, ["g1", "g2"]), (0, 0, 0, None)]
    scores = spark.createDataFrame([("n", "A1", 0.5), ("n", "A1", 3.0), ("n", "A2", 9.0)], "peptide string, allele string, rank_Neo double")
    summary = binding.peptide_summary(scores, {"rank_Neo": 2.0})
    assert [(r.best_rank_Neo, r.alleles, r.alleles_binding, r.best_allele, r.best_margin) for r in summary.collect()] == [(0.5, 2, 1, "A1", 0.75)]
    for df in (out, own, counts, summary):
        assert "Expand" not in plan(df)


def test_reads_with_long_gaps_count_at_their_breakends(spark):
    """A read whose gap of 500,000 bases spans a breakend is coverage there, as is one that ends in its window."""
    events = spark.createDataFrame([("s", "e", "1", 1_000_000, "1", 1_000_222, "DEL", 221, 0, None)], "sample string, sample_sv_id string, chrom1 string, pos1 long, chrom2 string, pos2 long, svtype string, event_size int, insert_len int, insert_seq string")
    rows = [("s", "1", "long", 700_000, 60, 0, "50M500000N50M", "A", None), ("s", "1", "own", 999_950, 60, 0, "50M221N50M", "A", None), ("s", "1", "far", 400_000, 60, 0, "50M500000N50M", "A", None), ("s", "1", "clip", 1_000_100, 60, 0, "30S70M", "A", None)]
    got = {(r.side): (r.coverage, r.sizegap_fragments, r.softclips) for r in reads.fragment_evidence(reads.reads_at_breakends(events, alignments(spark, rows))).collect()}
    assert got == {1: (3, 1, 1), 2: (3, 1, 1)}


def test_pairs_of_a_breakend_stay_where_they_met(spark, monkeypatch):
    """Short reads meet in one cell a breakend: same evidence as where loci go to all tasks, and pairs are not shuffled."""
    rng = random.Random(7)
    events = [("s", f"e{k}", "1", p, "1", p + 90 + 10 * (k % 3), "DEL", 90 + 10 * (k % 3), 0, None) for k, p in enumerate(rng.randrange(1_700, 2_300) for _ in range(30))]
    events = spark.createDataFrame(events, "sample string, sample_sv_id string, chrom1 string, pos1 long, chrom2 string, pos2 long, svtype string, event_size int, insert_len int, insert_seq string")
    rows = [("s", "1", rng.choice([None, *(f"q{j}" for j in range(40))]), rng.randrange(1_200, 2_800), rng.choice([5, 60]), 0, f"50M{rng.choice([0, 90, 100])}N50M", "A", None) for _ in range(300)]
    lines = alignments(spark, rows)
    made = {}
    for few in (20_000, 0):
        monkeypatch.setattr(reads, "FEW_LOCI", few)
        pairs = reads.reads_at_breakends(events, lines)
        made[few] = pairs, reads.fragment_evidence(pairs), reads.junction_usage(pairs)
    assert "_cell" in made[0][0].columns and "_cell" not in made[20_000][0].columns
    assert made[0][0].count() == made[20_000][0].count() > 1_000
    for a, b in zip(made[0][1:], made[20_000][1:], strict=True):
        assert a.columns == b.columns
        assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
    assert plan(reads.fragment_evidence(made[0][0])).count("Exchange hashpartitioning") == 2
    assert "_cell" not in reads.reads_at_breakends(events.unionByName(events.limit(1).withColumn("pos1", F.col("pos1") + 5_000)), lines).columns


def test_cells_are_asked_by_what_reaches_into_them(spark):
    rng = random.Random(3)
    a = [(k, "c", p, p + rng.randrange(0, 31)) for k, p in enumerate(rng.randrange(-100, 500) for _ in range(150))]
    b = [(k, "c", p, p + rng.randrange(0, 41)) for k, p in enumerate(rng.randrange(-100, 500) for _ in range(150))]
    want = {(i, j) for i, _, p, q in a for j, _, s, e in b if p <= e and s <= q}
    left, right = spark.createDataFrame(a, "i int, c string, a0 long, a1 long"), spark.createDataFrame(b, "j int, c string, b0 long, b1 long")
    got = ranges.overlapping(left, right, ["c"], ("a0", "a1"), ("b0", "b1"), 40, 0, 30).select("i", "j", "_cell").collect()
    assert len(got) == len(want) and {(r.i, r.j) for r in got} == want


def test_admitted_records_are_found_once(spark, tmp_path):
    found = spark.sparkContext.accumulator(0)

    def mark(_):
        found.add(1)
        return True

    rows = [("s", 0, "##x", None, None, None)] + [("s", k, f"1\t{k}\tid{k}", "1", k, f"id{k}") for k in range(1, 8)]
    lines = spark.createDataFrame(rows, "sample string, file_row long, line string, chrom string, pos long, id string").repartition(2)
    writers.write_admitted(lines, lines.filter("pos % 2 = 1").filter(F.udf(mark, "boolean")("id")), f"file://{tmp_path}/out")
    assert [r.value for r in spark.read.text(f"file://{tmp_path}/out").collect()] == [r[2] for r in rows if r[4] is None or r[4] % 2]
    assert found.value == 4
