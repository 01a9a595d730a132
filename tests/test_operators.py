"""Operators against literal cases and brute force."""

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from juncture.functions import alignments, sequence, variants
from juncture.operators import admission, audit, binding, cross, expression, funnel, hla, lineage, master, peptides, ranges, reads, universe
from juncture.plans import null_model
from juncture.sources import readers


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_sequence_functions(spark):
    s = F.lit("SLYNTVATL")
    assert one(spark, sequence.is_low_complexity(s), sequence.longest_run(F.lit("AAABBBBC")), sequence.reverse_complement(F.lit("ACGTN"))) == (False, 4, "NACGT")
    assert one(spark, sequence.is_low_complexity(F.lit("FFFFFFFFF")), sequence.is_low_complexity(F.lit("")), sequence.entropy(F.lit("AB"))) == (True, True, 1.0)
    assert one(spark, sequence.translate(F.lit("ATGGCCTAAGGG")), sequence.translate(F.lit("AT")), sequence.translate(F.lit("ATGNNN"))) == ("MA", "", "MX")
    got = spark.range(1).select(F.inline(sequence.windows(F.lit("ABCDE"), (4, 9)))).collect()
    assert [(r.start, r.peptide) for r in got] == [(0, "ABCD"), (1, "BCDE")]
    assert one(spark, sequence.peptide_spans(F.lit("MABMAB"), F.lit("MAB"), F.lit(12)), sequence.peptide_spans(F.lit("MAB"), F.lit("MAB"), F.lit(None).cast("int"))) == (True, None)


def test_variant_functions(spark):
    t = F.lit("SVTYPE=DEL;IMPRECISE;AF=0.1;X=")
    assert one(spark, variants.info(t, "SVTYPE"), variants.info(t, "AF", "double"), variants.info(t, "NONE"), variants.info_flag(t, "IMPRECISE")) == ("DEL", 0.1, None, True)
    sizes = [variants.event_size(F.lit(k), F.lit(1000), F.lit(1221), F.lit(34)) for k in ("DEL", "DUP", "INS", "BND")]
    assert one(spark, *sizes) == (220, 221, 34, None)
    assert one(spark, *[variants.normal_allele(F.lit(a)) for a in ("HLA-A02:01", "A*02:01", "a0201")]) == ("A02:01",) * 3
    assert one(spark, variants.two_field(F.lit("A*24:02:01:02L")), variants.fraction(F.lit(1), F.lit(2)), variants.fraction(F.lit(0), F.lit(0))) == ("A24:02L", 0.3333, None)
    j = spark.range(1).select(variants.junction_text(F.lit("chr1:5-chr7:90")).alias("j")).select("j.*").first()
    assert tuple(j) == ("1", 5, "7", 90)
    with pytest.raises(Exception, match="not a junction"):
        spark.range(1).select(variants.junction_text(F.lit("chr1"))).collect()


def test_alignment_functions(spark):
    g = spark.range(1).select(alignments.gaps(F.lit(100), F.lit("112M218N39M5S")).alias("g"), alignments.reference_end(F.lit(100), F.lit("112M218N39M5S")).alias("e")).first()
    assert [(x.start, x.length) for x in g.g] == [(212, 218)] and g.e == 469
    hit = lambda tag: one(spark, alignments.partner_hit(F.lit(tag), F.lit("8"), F.lit(127700000)))[0]
    assert [hit(t) for t in ("chr8,127700100,+,50M,60,0;", "8,3000000,+,50M", "7,127700100,+", "", "8")] == [True, False, False, False, False]


@pytest.mark.parametrize("least", [0.4, 0.5, 0.7])
def test_reciprocal_overlap(spark, least):
    rng = random.Random(3)
    make = lambda n: [(k, rng.choice("ab"), s := rng.randrange(5000), s + int(2 ** rng.uniform(0, 11))) for k in range(n)]
    a, b = make(250), make(250)
    got = ranges.reciprocal_overlaps(spark.createDataFrame(a, "i int, c string, a0 int, a1 int"), spark.createDataFrame(b, "j int, c string, b0 int, b1 int"), ["c"], ("a0", "a1"), ("b0", "b1"), least)
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and min(x[3], y[3]) - max(x[2], y[2]) >= least * max(x[3] - x[2], y[3] - y[2], 1))
    assert sorted((r.i, r.j) for r in got.collect()) == want


def test_overlap_points_and_distance(spark):
    rng = random.Random(4)
    a = [(k, s := rng.randrange(900), s + rng.randrange(60)) for k in range(120)]
    b = [(k, s := rng.randrange(900), s + rng.randrange(200)) for k in range(120)]
    left, right = spark.createDataFrame(a, "i int, a0 int, a1 int").withColumn("c", F.lit(1)), spark.createDataFrame(b, "j int, b0 int, b1 int").withColumn("c", F.lit(1))
    got = ranges.overlapping(left, right, ["c"], ("a0", "a1"), ("b0", "b1"), 40)
    assert sorted((r.i, r.j) for r in got.collect()) == sorted((x[0], y[0]) for x in a for y in b if x[1] <= y[2] and y[1] <= x[2])
    got = ranges.points_in_intervals(left, right, ["c"], "a0", "b0", "b1", 50)
    assert sorted((r.i, r.j) for r in got.collect()) == sorted((x[0], y[0]) for x in a for y in b if y[1] <= x[1] <= y[2])
    got = ranges.within_distance(left, right, ["c"], "a0", "b0", 7)
    assert sorted((r.i, r.j) for r in got.collect()) == sorted((x[0], y[0]) for x in a for y in b if abs(x[1] - y[1]) <= 7)


def test_nearest(spark):
    rng = random.Random(5)
    pts = [(k, rng.choice("abz"), rng.randrange(1000)) for k in range(150)]
    refs = [(rng.choice("ab"), rng.randrange(1000), rng.choice("xyz")) for _ in range(60)]
    got = ranges.nearest(spark.createDataFrame(pts, "k int, c string, pos int"), spark.createDataFrame(refs, "c string, pos int, t string"), ["c"], "pos", ["t"], 37)
    out = {r.k: (r.near_distance, r.near_pos, r.near_t) for r in got.collect()}
    assert len(out) == len(pts)
    for k, c, p in pts:
        low = max(((r[1], r[2]) for r in refs if r[0] == c and r[1] < p), default=None)
        high = min(((r[1], r[2]) for r in refs if r[0] == c and r[1] >= p), default=None)
        best = low if low and (not high or p - low[0] <= high[0] - p) else high
        assert out[k] == ((abs(best[0] - p), *best) if best else (None, None, None))


def test_lineage(spark):
    samples = spark.createDataFrame([("root", None), ("mid", "root"), ("leaf", "mid"), ("other", "gone"), ("x", "y"), ("y", "x")], "name string, parent string")
    got = {(r.sample, r.ancestor, r.depth) for r in lineage.closure(samples).collect()}
    assert got == {("mid", "root", 1), ("leaf", "mid", 1), ("leaf", "root", 2), ("x", "y", 1), ("y", "x", 1)}
    points = spark.createDataFrame([("root", "1", 100), ("root", "2", 205), ("mid", "1", 500), ("mid", "2", 600)], "sample string, chrom string, pos long")
    events = spark.createDataFrame([("e1", "leaf", "1", 110, "2", 200), ("e2", "leaf", "1", 500, "2", 600), ("e3", "leaf", "1", 900, "2", 900), ("e4", "root", "1", 1, "2", 2)], "k string, sample string, chrom1 string, pos1 long, chrom2 string, pos2 long")
    got = {r.k: (r.attributed_to, r.checked) for r in lineage.attribute(events, points, lineage.closure(samples), "k").collect()}
    assert got == {"e1": ("root", "root:yes"), "e2": ("mid", "root:no;mid:yes"), "e3": ("leaf", "root:no;mid:no"), "e4": ("root", "root sample")}


def test_null_model(spark):
    names = spark.createDataFrame([("ABC",), ("CBA",), ("DDD",)], "peptide string")
    counts = null_model.permutation_counts(names, names, "peptide", 30)
    assert counts.count() == 30 and all(r.hits >= 1 for r in counts.collect())  # DDD always maps to itself
    row = null_model.null_summary(counts, null_model.observed_matches(names, names, "peptide")).first()
    assert row.observed == 3 and 0 <= row.p_value <= 1 and row.permutations == 30
    none = null_model.permutation_counts(names, spark.createDataFrame([("ZZZ",)], "peptide string"), "peptide", 5)
    assert [r.hits for r in none.collect()] == [0] * 5


def test_binding(spark):
    cuts = binding.RULES["three_way"]
    rows = spark.createDataFrame([("P", "A", 1.0, 1.0, 450.0), ("P", "B", 0.1, 0.1, 10.0), ("Q", "A", 3.0, 1.0, 10.0)], "peptide string, allele string, rank_EL double, rank_BA double, affinity_nM double")
    got = {r.peptide: r for r in binding.peptide_summary(rows, cuts).collect()}
    assert (got["P"].alleles_binding, got["P"].best_allele, got["P"].margin_bin) == (2, "B", "robust") and got["Q"].alleles_binding == 0
    with pytest.raises(ValueError, match="without predictions"):
        binding.check_submitted(spark.createDataFrame([("Z",)], "peptide string"), rows)
    carried = spark.createDataFrame([("p1", "P"), ("p2", "Q"), ("p3", "W")], "patient string, neoantigen string")
    own = spark.createDataFrame([("p1", "B"), ("p2", "X")], "patient string, allele string")
    verdicts = {r.peptide: r.verdict for r in binding.autologous(carried, own, rows.filter(binding.passes(cuts)), rows.select("allele")).collect()}
    assert verdicts == {"P": "binder", "Q": "unevaluable_allele_outside_panel", "W": "unevaluable_no_typed_patient"}
    presented = binding.own_presentability({"three_way": rows, "again": rows}, spark.createDataFrame([("B",)], "allele string"), {"three_way": cuts, "again": cuts}).first()
    assert presented.predictors_agree and presented.three_way_allele == "B"
    assert [r.drop_reason for r in binding.predictable(spark.createDataFrame([("AAAA",), ("A" * 20,), ("AAAAAAAB",), ("AAAAAAAA",)], "p string"), "p").collect()] == ["too_short", "too_long", "non_standard_residue", None]


def test_universe_chain(spark):
    u = spark.createDataFrame([("P", 1)], "peptide string, a int")
    step = universe.Step("add", lambda d: d.withColumn("b", F.lit(2)), requires=["a"], adds=["b"])
    assert universe.annotate(u, [step]).first().b == 2
    with pytest.raises(ValueError, match="would overwrite b"):
        universe.annotate(u, [step, step])
    with pytest.raises(ValueError, match="needs z"):
        universe.annotate(u, [universe.Step("x", lambda d: d, requires=["z"])])
    with pytest.raises(ValueError, match="exist already"):
        universe.enrich(u, u, "peptide")
    with pytest.raises(ValueError, match="more than one row"):
        universe.enrich(u, spark.createDataFrame([("P", 1), ("P", 2)], "peptide string, q int"), "peptide")


def test_funnels_keep_unknown_apart(spark):
    events = spark.createDataFrame([("s", True, True, True, False), ("t", True, None, False, True)], "sample string, private boolean, high_confidence boolean, rna_supported boolean, rna boolean")
    got = {(r.sample, r.step): r.n for r in funnel.complete_funnel(funnel.event_funnel(events, ["sample"], F.col("rna"))).collect()}
    assert len(got) == 28 and got["s", "events_rna_supported"] is None and got["t", "events_rna_supported"] == 0 and got["t", "events_hc"] == 0 and got["s", "vcf_records"] is None
    near = funnel.near_misses(events, {"p": F.col("private"), "h": F.col("high_confidence")})
    assert [(r.sample, r.failed) for r in near.collect()] == [("t", "h")]


@pytest.mark.parametrize(("strand", "cut", "head"), [("+", 150, 51), ("+", 350, 151), ("-", 150, 150), ("-", 350, 50)])
def test_head_length(spark, strand, cut, head):
    blocks = "array(named_struct('start', 100L, 'end', 199L), named_struct('start', 300L, 'end', 399L))"
    assert one(spark, peptides.head_length(F.expr(blocks), F.lit(strand), F.lit(cut)))[0] == head


def test_clipped_blocks_of_minus_strand(spark):
    blocks = F.expr("array(named_struct('start', 100L, 'end', 199L), named_struct('start', 300L, 'end', 399L))")
    got = spark.range(1).select(peptides.clip_blocks(blocks, F.lit("-"), F.lit(150), False).alias("t"), peptides.clip_blocks(blocks, F.lit("-"), F.lit(350), True).alias("h")).first()
    assert [tuple(b) for b in got.t] == [(100, 150)] and [tuple(b) for b in got.h] == [(350, 399)]


def test_rearranged_coding_and_transcripts(spark):
    cds = "ATG" + "GCC" * 10 + "TGTGATGAATTC" + "AAA" * 10 + "TAA"
    row = [(1, "+", cds, 131, 144, "DEL", ""), (2, "+", cds, 131, 137, "DUP", None), (3, "+", cds, 101, 110, "INV", None)]
    df = spark.createDataFrame(row, "k int, strand string, cds string, pos1 long, pos2 long, svtype string, insert_seq string").withColumn("cds_blocks", F.expr(f"array(named_struct('start', 100L, 'end', {99 + len(cds)}L))"))
    got = {r.k: r for r in peptides.rearranged_coding(df).collect()}
    assert got[1].fused == cds[:32] + cds[44:] and got[1].junction_nt == 32
    assert got[2].fused == cds[:38] + cds[31:] and got[3].fused is None and got[3].model == "not_modelled"
    made = peptides.candidate_peptides(peptides.rearranged_coding(df), ["k"])
    native = one(spark, sequence.translate(F.lit(cds)))[0]
    assert made.count() and all(r.neopeptide not in native for r in made.collect())
    ends = spark.createDataFrame([("e", "1", 50)], "k string, chrom string, pos long")
    t = spark.createDataFrame([("long", "1", 1, 100, 9), ("mane", "1", 40, 60, 0), ("canon", "1", 30, 70, 1)], "transcript_id string, chrom string, start long, end long, rank int").withColumns({c: F.lit(None) for c in ("gene", "strand", "exons", "cds_blocks", "cds")})
    assert peptides.best_transcript(ends, t, "k").first().transcript_id == "mane"
    assert peptides.best_transcript(ends, t.withColumn("rank", F.lit(9)), "k").first().transcript_id == "long"


def test_expression_and_depth(spark):
    anno = spark.createDataFrame([("e1", "G1", "G2", "T1", "T2"), ("e2", "G9", "G9", None, None)], "k string, gene1 string, gene2 string, transcript_id1 string, transcript_id2 string")
    genes, iso = spark.createDataFrame([("G1", 9.0), ("G2", 0.5)], "gene string, tpm double"), spark.createDataFrame([("T1", 3.0)], "transcript string, tpm double")
    got = {r.k: (r.tpm1, r.tpm2, r.n_sides_measured, r.expressed) for r in expression.event_expression(anno, genes, iso).collect()}
    assert got == {"e1": (3.0, 0.5, 2, False), "e2": (None, None, 0, None)}
    assert {r.expressed for r in expression.event_expression(anno, genes, iso, has_expression=False).collect()} == {None}
    events = spark.createDataFrame([("e", "1", 100, "2", 5000)], "k string, chrom1 string, pos1 long, chrom2 string, pos2 long")
    fusions = spark.createDataFrame([("f1", "2", 4100, "1", 7), ("f2", "3", 100, "1", 7)], "FusionId string, ChrUp string, PosUp long, ChrDown string, TotalFragments int")
    assert expression.fusion_at(events, fusions, "k").first().fusion_id == "f1"
    splice = spark.createDataFrame([("1", 150, 900, 4, "novel")], "Chromosome string, SjStart long, SjEnd long, FragCount int, Type string")
    assert tuple(expression.nearest_splice(events, splice, "k").first()) == ("e", 50, 4, "novel", True)
    assert expression.retained_introns(anno, spark.createDataFrame([("G1",), ("G1",)], "GeneName string"), "k").orderBy("k").first().retained_introns == 2
    lines = spark.createDataFrame([("s", "1", 100, "100M"), ("s", "1", 150, "100M")], "sample string, chrom string, start0 long, cigar string")
    depth = reads.depth_ratio(spark.createDataFrame([("i", "s", "1", 100, 199)], "k string, sample string, chrom string, start long, end long"), lines, "k", 100).first()
    assert depth.inside == 1.5 and depth.flank == 0.25
    assert one(spark, *[reads.depth_verdict(F.lit(t), F.lit(r)) for t, r in (("DEL", 0.1), ("DEL", 0.5), ("DUP", 1.4), ("DEL", None))]) == ("homozygous", "heterozygous", "gain", "undetermined")


def test_typing(spark):
    calls = spark.createDataFrame([("s", "A", c, a) for c, pair in (("x", ("A*01:01", "A*02:01")), ("y", ("A0201", "A*01:01:01"))) for a in pair] + [("t", "A", "x", "A*03:01")], "sample string, gene string, caller string, allele string")
    got = {r.sample: (r.agree, r.callers) for r in hla.concordance(calls).collect()}
    assert got == {"s": (True, 2), "t": (True, 1)}
    both = hla.against_root(hla.concordance(calls), spark.createDataFrame([("t", "s")], "sample string, root string")).first()
    assert both.same_as_root is False
    typing = spark.createDataFrame([("s", "A", "a", 90, 5, 2.0), ("s", "A", "b", 5, 50, 1.0)], "sample string, gene string, Allele string, TumorTotal int, RnaTotal int, TumorCopyNumber double")
    flags = {r.Allele: (r.lost, r.expressed, r.low_expression) for r in hla.allele_evidence(typing).collect()}
    assert flags == {"a": (False, False, True), "b": (True, True, False)}
    assert round(hla.copy_number_gap(typing).first().gap, 4) == round(abs(1 / 3 - 5 / 95), 4)


def test_audit(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2, "y"), (1, "x")], "k int, v string")
    assert audit.same_rows(a, b) and not audit.same_rows(a, a.union(a))
    assert audit.fingerprint(a).first() == audit.fingerprint(b.repartition(3)).first()
    now = audit.fingerprint(a).select(F.lit("d").alias("dataset"), "rows", "hash_sum")
    old = now.union(spark.createDataFrame([("e", 1)], "dataset string, rows long").withColumn("hash_sum", F.lit(1).cast("decimal(38,0)")))
    assert {r.dataset: r.status for r in audit.freshness(old, now).collect()} == {"d": "current", "e": "not checkable"}
    with pytest.raises(ValueError, match="undefined: b; absent: c"):
        audit.check_dictionary(["a", "b"], {"a": "m", "c": "n"})
    assert audit.binomial_two_sided(5, 10, 0.5) == 1.0 and round(audit.binomial_two_sided(0, 10, 0.5), 6) == 0.001953
    samples = spark.createDataFrame([("a", "germline", None), ("a", "odd", "zz"), ("b", "germline", None)], "name string, vcf_kind string, parent string")
    errors, warnings = audit.check_run(samples, spark.createDataFrame([("br",)], "name string"), ["a", "nope"])
    assert len(errors) == 3 and len(warnings) == 2
    p = audit.strand_p_values(audit.strand_composition(spark.createDataFrame([("g", "+", 10), ("g", "-", 30)], "grp string, strand string, length int"), "grp"), 0.5).first()
    assert p.p_value == 1.0 and p.weighted_plus == 0.25


def test_sources(spark, tmp_path):
    fasta = tmp_path / "p.fasta"
    fasta.write_text(">one >x\nMA\nB\n>two\nCDE\n")
    got = {r.protein: r.sequence for r in readers.read_proteome(spark, str(fasta)).collect()}
    assert got == {"one >x": "MAB", "two": "CDE"}
    kmers = cross.self_peptides(spark.createDataFrame([("MAB",), ("ABC",)], "p string"), readers.read_proteome(spark, str(fasta)), "p", (3,))
    assert {r.p: r.is_self for r in kmers.collect()} == {"MAB": True, "ABC": False}
    sites = spark.createDataFrame([("#h",), ("chr1\t10\tid\tN\t<DEL>\t.\tPASS\tEND=90;AF=0.2;AF_afr=0.4",), ("chr1\t10\tid\tN\t<DEL>\t.\tPASS\tEND=90",)], "value string")
    assert [(r.chrom, r.end, r.af_afr) for r in readers.parse_population_sites(sites).collect()] == [("1", 90, 0.4)]
    gtf = spark.createDataFrame([('1\th\ttranscript\t1\t9\t.\t+\t.\tgene_name "G"; transcript_id "ENST1.4"; tag "MANE_Select";',), ('1\th\texon\t1\t9\t.\t+\t.\ttranscript_id "ENST1.4";',)], "value string")
    assert [tuple(r) for r in readers.transcript_ranks(gtf).collect()] == [("ENST1", "G", 0)]
    (tmp_path / "cat.tsv").write_text("neo\tgene1\tx\n matchpept \tG\t1\n")
    assert readers.read_catalogue(spark, str(tmp_path / "cat.tsv"), {"neo": "ref_peptide", "gene1": "ref_gene"}).first().ref_peptide == "MATCHPEPT"
    with pytest.raises(ValueError, match="catalogue lacks"):
        readers.read_catalogue(spark, str(tmp_path / "cat.tsv"), {"missing": "ref_peptide"})
    assert readers.read_calls(spark, None, "fusion_call").count() == 0
    with pytest.raises(AnalysisException):  # a wrong path is not "no calls"
        readers.read_calls(spark, str(tmp_path / "no.tsv"), "fusion_call").count()
    wide = spark.createDataFrame([("p", "A01:01", "")], "sampleId string, `HLA-A_1` string, `HLA-A_2` string")
    assert [tuple(r) for r in readers.long_genotypes(wide, "sampleId").collect()] == [("p", "HLA-A_1", "A01:01")]


def test_incremental_ingest(spark, tmp_path):
    from juncture.streaming.ingest import ingest_available

    src, out, mark = (tmp_path / n for n in ("in", "out", "mark"))
    src.mkdir()
    (src / "p1.tsv").write_text("neoantigen\tgene1\nAAA\tG\n")
    for n in (1, 2):
        ingest_available(spark, str(src), "neoantigen string, gene1 string", str(out), str(mark))
        assert spark.read.parquet(str(out)).count() == n
        (src / "p2.tsv").write_text("neoantigen\tgene1\nBBB\tG\n")
    assert {r.patient for r in spark.read.parquet(str(out)).collect()} == {"p1", "p2"}


def test_ingest_isolates_failures(spark, tmp_path):
    from juncture.streaming.ingest import ingest_available

    src, out, mark, bad, done = (tmp_path / n for n in ("in", "out", "mark", "bad", "done"))
    src.mkdir()
    (src / "p1.tsv").write_text("neoantigen\tn\nAAA\t1\n")
    (src / "p2.tsv").write_text("neoantigen\tn\nBBB\t2\nCCC\tnot a number\n")
    (src / "p3.tsv").write_text("neoantigen\tn\nDDD\t3\n")
    ingest_available(spark, str(src), "neoantigen string, n int", str(out), str(mark), str(bad), str(done))
    assert {(r.patient, r.neoantigen, r.n) for r in spark.read.parquet(str(out)).collect()} == {("p1", "AAA", 1), ("p3", "DDD", 3)}
    assert [(r.patient, r.broken_lines, r.example) for r in spark.read.parquet(str(bad)).collect()] == [("p2", 1, "CCC\tnot a number")]
    assert {r.patient for r in spark.read.parquet(str(done)).collect()} == {"p1", "p3"}


def breakends(spark, rows):
    """(id, chrom, pos, alt, mateid, svtype, vf) in file order."""
    names = "id string, chrom string, pos long, alt string, mateid string, svtype string, vf int"
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], f"{names}, file_row long")
    return df.withColumns({"sample": F.lit("s"), "ref": F.lit("a"), "qual": F.lit(1.0), "pon_count": F.lit(None).cast("int"), **{c: F.lit(None).cast("int") for c in ("sf", "df", "ref_reads", "segmapq")}})


def test_pairing_without_mates_and_ids(spark):
    five = [(".", "1", 100 * k, f"A[chr1:{100 * k + 50}[", None, "DEL", k) for k in range(1, 6)]
    got = admission.pair_junctions(breakends(spark, five)).collect()
    assert sorted((r.pos1, r.pos2, r.event_size, r.vf1, r.vf2) for r in got) == [(100 * k, 100 * k + 50, 49, k, k) for k in range(1, 6)]
    rows = [("x1", "1", 10, "A[chr2:900[", "x2", "dup", 3), ("x2", "2", 900, "]chr1:10]A", "x1", "dup", 4), ("y1", "1", 10, "ATT[chr1:80[", "gone", "BND", 5), ("z", "1", 5, "A.", None, "SGL", 1)]
    got = {r.sample_sv_id: r for r in admission.pair_junctions(breakends(spark, rows)).collect()}
    assert set(got) == {"x1", "y1"}
    assert (got["x1"].chrom2, got["x1"].pos2, got["x1"].vf2, got["x1"].event_size) == ("2", 900, 4, None)
    assert (got["y1"].pos2, got["y1"].vf2, got["y1"].insert_len, got["y1"].insert_seq, got["y1"].event_size) == (80, 5, 2, "TT", None)


def test_classes_in_either_case(spark):
    assert one(spark, variants.event_size(F.lit("del"), F.lit(10), F.lit(20), F.lit(0)), variants.event_size(F.lit("bnd"), F.lit(10), F.lit(20), F.lit(0))) == (9, None)
    assert one(spark, variants.inserted_bases(F.lit("a"), F.lit("AGT[1:5[")), variants.inserted_bases(F.lit("A"), F.lit("]1:5]GTa"))) == ("GT", "GT")
    assert one(spark, reads.select_test(F.lit("bnd"), F.lit("1"), F.lit("1"), F.lit(None).cast("int"), F.lit(0))[0])[0] == "chimeric"
    model = lambda a, b, g="G": variants.junction_model(F.lit("G"), F.lit(g), F.lit(a), F.lit(b))
    assert one(spark, model("CDS", "CDS"), model("intron", "CDS"), model("UTR", "CDS"), model("CDS", "CDS", "H")) == ("coding join", "exon-intron: splice outcome uncertain", "UTR-CDS: splice outcome uncertain", "inter-gene fusion")


def test_calls_in_file_order_with_prefixes(spark):
    events = spark.createDataFrame([("e", "chr1", 100, "2", 5000)], "k string, chrom1 string, pos1 long, chrom2 string, pos2 long").withColumn("chrom1", variants.normal_chrom(F.col("chrom1")))
    fusions = spark.createDataFrame([("z", "chr2", 4100, "chr1", 7, 1), ("a", "chr2", 4100, "chr1", 9, 2)], "FusionId string, ChrUp string, PosUp long, ChrDown string, SplitFrags int, call_row long")
    assert tuple(expression.fusion_at(events, fusions, "k").first()) == ("e", "z", 7)
    splice = spark.createDataFrame([("chr1", 150, 900, 4, "novel")], "Chromosome string, SjStart long, SjEnd long, FragCount int, Type string")
    assert expression.nearest_splice(events, splice, "k").first().alt_sj_distance == 50


def test_derivation_order_and_stacks(spark):
    names = "n_generated int, n_matched int, distance long, insert_len int, evidence string, svtype string, patient_svtype string"
    rows = [(5, 1, 0, 3, "identical_peptide", "DEL", "DEL"), (4, 0, 0, 9, "within_1kb", "DEL", "DUP"), (0, 0, 700, 0, "within_1kb", "DEL", None), (2, 0, 90_000, None, "within_100kb", "INV", None), (None, None, None, None, "not_seen", "INV", None)]
    df = spark.createDataFrame(rows, names)
    got = [(r.step, r.n) for r in funnel.derivation_steps(df).orderBy("place").collect()]
    assert [n for _, n in got] == [5, 4, 5, 3, 1, 3, 1, 1, 1, 2, 1, 2, 2, 1]
    assert tuple(funnel.derivation_medians(df).first()) == (3.0, 6.0, 9.0, 3.0, 0.2, 0.2)
    events = spark.createDataFrame([("a", "G2", "WEAK", True), ("b", "G1", "STRONG", False), ("c", "G3", "STRONG", True), ("d", "G0", None, None)], "id string, gene string, rna_tier string, private boolean")
    assert [r.id for r in funnel.by_tier(events, "id").collect()] == ["c", "b", "a", "d"]
    both = master.stack({"x": events.select("id"), "y": events.select("id", "gene")}, "line")
    assert both.count() == 8 and both.filter("line = 'x' and gene is not null").count() == 0
    counts = spark.createDataFrame([("l1", "records", 9), ("l1", "paired", 4), ("l2", "records", 3)], "line string, step string, n long")
    assert sorted(tuple(r) for r in funnel.admission_table(counts, "line", ["records", "paired"]).collect()) == [("l1", 9, 4), ("l2", 3, None)]


def test_large_gene_sets_and_missing_paths(spark, tmp_path):
    assert abs(audit.binomial_two_sided(550, 1100, 0.5) - 1) < 1e-9 and audit.binomial_two_sided(100, 5000, 0.5) == 0
    assert round(audit.binomial_two_sided(2, 10, 0.5), 6) == 0.109375
    samples = spark.createDataFrame([("a", "germline", None)], "name string, vcf_kind string, parent string")
    paths = spark.createDataFrame([("a", "vcf", str(tmp_path)), ("a", "rna_bam", str(tmp_path / "no")), ("a", "dna_bam", None), ("b", "vcf", "/nowhere")], "owner string, key string, path string")
    errors, _ = audit.check_run(samples, samples.select("name"), paths=paths)
    assert len(errors) == 2 and all("does not exist" in e for e in errors)


def test_fusions_of_two_genes(spark):
    head, tail = "ATG" + "GCC" * 30, "ATG" + "TGG" * 30 + "TAA"
    block = lambda a, b: f"named_struct('start', {a}L, 'end', {b}L)"
    rows = [("five_plus", "+", "+", True, False, "intron", "intron"), ("both_five", "+", "+", True, True, "intron", "intron"), ("exonic", "+", "+", True, False, "CDS", "intron"), ("five_minus", "-", "+", False, False, "intron", "intron")]
    df = spark.createDataFrame(rows, "k string, strand1 string, strand2 string, left1 boolean, left2 boolean, region1 string, region2 string")
    df = df.withColumns({"cds1": F.lit(head), "cds2": F.lit(tail), "pos1": F.lit(200), "pos2": F.lit(5200), "cds_blocks1": F.expr(f"array({block(101, 160)}, {block(301, 333)})"), "cds_blocks2": F.expr(f"array({block(5001, 5048)}, {block(5301, 5348)})")})
    got = {r.k: (r.model, r.fused, r.junction_nt) for r in peptides.fusion_coding(df).collect()}
    assert got["five_plus"] == ("fusion_intronic", head[:60] + tail[48:], 60)
    assert got["five_minus"] == ("fusion_intronic", head[:33] + tail[48:], 33)
    assert got["both_five"][:2] == ("fusion_no_product", None) and got["exonic"][:2] == ("not_modelled", None)
    made = peptides.generator("spliced_cds")(df, ["k"]).filter("k = 'five_plus'").collect()
    assert made and all(r.spans_junction for r in made) and {r.pep_length for r in made} == {8, 9, 10, 11}


def test_breakpoint_or_gap(spark):
    probes = spark.createDataFrame([("e", "breakpoint", "ACGTACGT"), ("e", "120", "TTTTGGGG"), ("e", "121", "CCCCCCAA"), ("f", "breakpoint", "GGGGGGGG")], "k string, probe string, sequence string")
    held = spark.createDataFrame([("e", "xxTTTTGGGGxx"), ("e", "CCCCAAAA"), ("e", "ACGTACGT"), ("f", "AAAA")], "k string, seq string")
    got = {r.k: (r.breakpoint_hits, r.gap_hits, r.gap, r.supported) for r in reads.breakpoint_or_gap(probes, held, ["k"]).collect()}
    assert got == {"e": (1, 2, "120", "gap"), "f": (0, 0, None, "neither")}
    pairs = spark.createDataFrame([([(5, 90), (7, 90)],), ([(5, 80)],)], "gaps array<struct<start:int,length:int>>")
    assert sorted(tuple(r) for r in reads.gap_profile(pairs).collect()) == [("size", 80, 1), ("size", 90, 2), ("start", 5, 2), ("start", 7, 1)]
    loci = spark.range(1).select(F.inline(reads.background_loci(10_000, 20, 3, "1")))
    held = spark.range(0, 10_000, 50).select(F.lit("1").alias("chrom"), F.col("id").alias("start0"), F.lit("50M").alias("cigar"), F.when(F.col("id") % 100 == 0, "AACCGGTA").otherwise("T").alias("seq"))
    rate = reads.background_rate(held, loci, "ACCGG").first()
    assert loci.count() == 20 and rate.background_reads > 100 and 400 < rate.background_per_1000 < 600
