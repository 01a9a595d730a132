"""Work that follows the input: forms whose rows or steps grew with the square of it, against brute force."""

import random

import duckdb
import oracle
from pyspark.sql import functions as F

from juncture import queries
from juncture.functions import sequence
from juncture.operators import binding, confidence, cross, lineage, peptides, ranges, reads
from juncture.sources import readers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_sums_no_frame_anew_for_each_row(spark):
    """Spark walks a frame that ends at the last row again for every row, so none is used."""
    rng = random.Random(1)
    refs, points = [("c", rng.randrange(500), f"t{k}") for k in range(60)], [(k, "c", rng.randrange(500)) for k in range(60)]
    out = ranges.nearest(spark.createDataFrame(points, "k int, c string, pos long"), spark.createDataFrame(refs, "c string, pos long, t string"), ["c"], "pos", ["t"], 100, 20)
    assert "1, unboundedfollowing" not in plan(out).lower()
    for r in out.collect():
        before, after = max(((q, t) for _, q, t in refs if q < r.pos), default=None), min(((q, t) for _, q, t in refs if q >= r.pos), default=None)
        best = before if after is None or (before and r.pos - before[0] <= after[0] - r.pos) else after
        assert (r.near_distance, r.near_pos, r.near_t) == (abs(best[0] - r.pos), *best)


def test_sums_inside_make_no_pairs(spark):
    rng = random.Random(2)
    rows, spans = [("ab"[k % 2], rng.randrange(-300, 300), rng.randrange(9)) for k in range(300)], [(k, "abc"[k % 3], s, s + rng.randrange(0, 90)) for k, s in enumerate(rng.randrange(-300, 300) for _ in range(90))]
    points, asks = spark.createDataFrame(rows, "c string, pos long, v long"), spark.createDataFrame(spans, "k int, c string, s long, e long")
    for width in (40, 10**6):
        got = {r.k: (r._n, r.v) for r in ranges.sums_inside(asks, points, ["c"], "s", "e", "pos", ["v"], width).collect()}
        assert got == {k: (sum(1 for d, p, _ in rows if c == d and s <= p <= e), sum(v for d, p, v in rows if c == d and s <= p <= e)) for k, c, s, e in spans}
    upto = ranges.sums_upto(asks.withColumnRenamed("s", "pos"), points, ["c"], "pos", ["v"], 300, 20)
    assert all(r.v == sum(v for d, p, v in rows if r.c == d and p <= r.pos) for r in upto.collect())


def test_depth_from_edges(spark):
    """Depth follows from where blocks start and end; a block meets no interval. Gaps and clips count as before."""
    rng = random.Random(3)
    spans = [(k, "s", "ab"[k % 2], s, s + rng.randrange(0, 60)) for k, s in enumerate(rng.randrange(0, 600) for _ in range(40))]
    lines = [("s", "ab"[k % 2], rng.randrange(0, 600), *rng.choice([("30M", [(0, 30)]), ("10M50N20M", [(0, 10), (60, 20)]), ("5S7M3I4D8=", [(0, 7), (11, 8)])])) for k in range(200)]
    intervals, reads_ = spark.createDataFrame(spans, "k int, sample string, chrom string, start long, end long"), spark.createDataFrame([x[:4] for x in lines], "sample string, chrom string, start0 long, cigar string")
    out = reads.depth_ratio(intervals, reads_, "k", flank=25, width=100)
    depth = lambda c, a, b: sum(max(0, min(b, s + o + n - 1) - max(a, s + o) + 1) for _, d, s, _, blocks in lines if d == c for o, n in blocks)
    for r in out.collect():
        _, _, c, a, b = spans[r.k]
        assert abs(r.inside - depth(c, a, b) / (b - a + 1)) < 1e-9 and abs(r.flank - (depth(c, a - 25, a - 1) + depth(c, b + 1, b + 25)) / 50) < 1e-9
    assert "p1" not in "".join(x for x in plan(out).splitlines() if "Join" in x and "<=" in x)


def test_equal_intervals_overlap_once(spark):
    rng = random.Random(4)
    one, two = [(k, "c", s, s + rng.choice([4, 5, 9])) for k, s in enumerate(rng.randrange(0, 30) for _ in range(200))], [("c", s, s + rng.choice([3, 6, 8]), rng.randrange(50)) for s in (rng.randrange(0, 30) for _ in range(200))]
    a, b = spark.createDataFrame(one, "k int, c string, a0 long, a1 long"), spark.createDataFrame(two, "c string, b0 long, b1 long, v int")
    got = {r.k: (r._n, r._best) for r in ranges.reciprocal_best(a, b, ["c"], ("a0", "a1"), ("b0", "b1"), 0.5, F.col("v")).collect()}
    met = {k: [v for _, b0, b1, v in two if min(a1, b1) - max(a0, b0) >= 0.5 * max(a1 - a0, b1 - b0)] for k, _, a0, a1 in one}
    assert got == {k: (len(v), max(v)) for k, v in met.items() if v}


def test_population_ties_are_settled(spark):
    """Of records of one frequency the one with the higher first ancestry counts, a missing one before any."""
    for order in (1, -1):
        rows = [("1", 100, 200, 0.2, 0.1, 0.3), ("1", 101, 200, 0.2, 0.25, 0.0), ("1", 102, 200, 0.1, 0.9, 0.9), ("2", 100, 200, 0.2, None, 0.1), ("2", 100, 200, 0.2, 0.7, 0.1)][::order]
        records = spark.createDataFrame(rows, "chrom string, start long, end long, af double, af_afr double, af_nfe double").coalesce(1)
        events = spark.createDataFrame([(k, str(k), str(k), 100, 200, 99) for k in (1, 2)], "k int, chrom1 string, chrom2 string, pos1 long, pos2 long, event_size int")
        assert {r.k: (r.popmax, r.popmax_population) for r in confidence.population_frequency(events, records, "k").collect()} == {1: (0.25, "afr"), 2: (0.1, "nfe")}


def test_covering_without_pairs(spark):
    rng = random.Random(5)
    spans = [("ab"[k % 2], s, s + rng.choice([0, 1, 7, 64, 300, 5000]), f"g{k % 7}", k) for k, s in enumerate(rng.randrange(-3000, 3000) for _ in range(150))]
    points = [(k, "ab"[k % 2], rng.randrange(-3100, 9000)) for k in range(200)] + [(900, "a", None), (901, None, 5)]
    aggs = {"n": (F.count("*"), F.sum), "top": (F.min(F.struct((F.col("s") - F.col("e")).alias("z"), "v")), F.min)}
    out = ranges.covering(spark.createDataFrame(points, "k int, c string, pos long"), spark.createDataFrame(spans, "c string, s long, e long, g string, v int"), ["c"], "pos", "s", "e", aggs)
    over = {k: [(s - e, v) for d, s, e, _, v in spans if c == d and s <= p <= e] for k, c, p in points if p is not None}
    assert {r.k: (r.n, tuple(r.top)) for r in out.collect()} == {k: (len(v), min(v)) for k, v in over.items() if v}
    nodes = spark.createDataFrame([(3, 10_000_000)], "s long, e long").select(F.size(ranges.dyadic_cover(F.col("s"), F.col("e"), 24)).alias("n"))
    assert nodes.first().n <= 48


def test_first_call_near_an_end_without_pairs(spark):
    rng = random.Random(6)
    refs, points = [("ab"[k % 2], rng.randrange(-400, 400), k) for k in range(120)], [(k, "abc"[k % 3], rng.randrange(-450, 450)) for k in range(150)] + [(900, "a", None)]
    df, ref = spark.createDataFrame(points, "k int, c string, pos long"), spark.createDataFrame(refs, "c string, up long, v int")
    for tolerance in (1, 7, 50):
        got = {r.k: r.first for r in ranges.least_within(df, ref, ["c"], "pos", "up", tolerance, F.col("v"), "first").collect()}
        met = {k: [v for d, q, v in refs if c == d and abs(q - p) <= tolerance] for k, c, p in points if p is not None}
        assert got == {k: min(v) for k, v in met.items() if v}


def test_audit_without_one_side_agrees_with_its_sql(spark, tmp_path):
    """Customer 1 has generated peptides only, 2 expected ones only, 3 both: nothing is listed where nothing is compared."""
    rows = [(9, 1), (18, 1), (50, 2), (7, 3), (50, 3)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long").write.parquet(f"file://{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"create view orders as select * from read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    oracle.assert_same(spark, con, queries.QUERIES["peptide_audit"], queries.SQL["peptide_audit"], f"file://{tmp_path}")
    got = {r.o_custkey: (r.verdict, r.missing, r.extra) for r in queries.peptide_audit(spark, f"file://{tmp_path}").collect()}
    assert got == {1: ("not compared", None, None), 2: ("not compared", None, None), 3: ("DISAGREE", "10", "")}


def test_attribution_meets_one_place(spark):
    """An end asks for the nearest breakpoint of an ancestor; the many around it make no rows."""
    points = spark.createDataFrame([("r", "c", 100 + k % 3) for k in range(50)] + [("r", "d", 900)], "sample string, chrom string, pos long")
    events = spark.createDataFrame([(1, "s", "c", 110, "d", 895), (2, "s", "c", 110, "d", 2000)], "k int, sample string, chrom1 string, pos1 long, chrom2 string, pos2 long")
    above = spark.createDataFrame([("s", "r", 1)], "sample string, ancestor string, depth int")
    out = lineage.attribute(events, points, above, "k", 20)
    assert {r.k: (r.attributed_to, r.checked) for r in out.collect()} == {1: ("r", "r:yes"), 2: ("s", "r:no")}
    assert "_cell" not in plan(out)


def test_asks_go_to_levels_in_use(spark):
    """Reads of one length have one level: an ask takes a row for each bin there, not for six levels."""
    b = spark.createDataFrame([("c", k * 100, k * 100 + 150) for k in range(50)], "c string, b0 long, b1 long")
    assert ranges.levels_in_use(b.select(ranges.nested_level(F.col("b0"), F.col("b1"), 1000).alias("_level"))) == [0]
    n = lambda levels: b.select(F.size(ranges.nested_asks(F.col("b0"), F.col("b1"), 1000, levels)).alias("n")).agg(F.max("n")).first()[0]
    assert n([0]) <= 3 < n(None)
    out = ranges.overlapping(b.limit(0), b.withColumnsRenamed({"b0": "s", "b1": "e"}), ["c"], ("b0", "b1"), ("s", "e"), 1000)
    assert "BroadcastHashJoin" not in plan(out) and out.count() == 0


def test_windows_of_a_key_meet_in_a_task(spark):
    """Events are shuffled, not their windows; rows of one key are one event, whatever each knows of its junction."""
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("ACGTacgN") for _ in range(n))
    rows = [(k % 40, rng.choice([None, 9, 40]), text(20) + "ATG" * (k % 9) + text(60), rng.choice([None, "", text(90)])) for k in range(120)]
    df = spark.createDataFrame(rows, "k int, junction_nt int, fused string, cds string")
    out = peptides.candidate_peptides(df, ["k"])
    shuffles = [x for x in plan(out).splitlines() if "hashpartitioning" in x]
    assert shuffles and not any("peptide" in x for x in shuffles)
    codons = lambda s: "".join(sequence.CODONS.get(s[i : i + 3].upper(), "X") for i in range(0, len(s) - 2, 3)).split("*")[0]
    want = {}
    for k, junction, fused, cds in rows:
        protein = codons(fused)
        for n in (8, 9, 10, 11):
            for i in range(len(protein) - n + 1) if cds is not None else ():
                if (w := protein[i : i + n]) not in codons(cds):
                    seen = [want.get((k, w)), None if junction is None else i * 3 < junction < (i + n) * 3]
                    want[k, w] = max((x for x in seen if x is not None), default=None)
    assert want and {(r.k, r.neopeptide): r.spans_junction for r in out.collect()} == want
    assert all(r.pep_length == len(r.neopeptide) for r in out.collect())
    odd = ["", "AT", "atgTAAC", "ATGßßAT\u0131GG", "ATG TTTT", "T TATG"] + [text(50) for _ in range(20)]
    native = [r.p for r in spark.createDataFrame([(k, t) for k, t in enumerate(odd)], "k int, t string").select("k", sequence.translate(F.col("t")).alias("p")).orderBy("k").collect()]
    assert native == [codons(t) for t in odd] == [sequence.translated(t) for t in odd]


def _levels(spark):
    rng = random.Random(8)
    annotation = [(f"s{k % 3}", str(k), f"g{rng.randrange(4)}", rng.choice(["g1", None]), rng.choice(["DEL", "dup", None])) for k in range(40)]
    catalogue = [(f"P{k}", f" G{k % 3}", rng.choice(["del", "DUP", None])) for k in range(60)]
    made = [(f"s{k % 3}", str(k), f" p{rng.randrange(80)}", rng.choice([True, False, None])) for k in range(50) for _ in range(4)]
    return (
        spark.createDataFrame(made, "sample string, sample_sv_id string, neopeptide string, spans_junction boolean"),
        spark.createDataFrame(annotation, "sample string, sample_sv_id string, gene1 string, gene2 string, svtype string"),
        spark.createDataFrame(catalogue, "ref_peptide string, ref_gene string, ref_svtype string"),
    )


def test_variants_meet_classes_not_peptides(spark):
    _, annotation, catalogue = _levels(spark)
    got, pairs = cross.level2_variants(annotation, catalogue), cross.level2_gene_svtype(annotation, catalogue)
    assert sorted(map(str, got.collect())) == sorted(map(str, cross.level2_flags(pairs).collect()))
    assert cross.level2_gene_svtype(annotation, catalogue).count() > 200


def test_variants_are_joined_before_the_catalogue(spark):
    """Of a peptide with many catalogue rows one row goes to its variant."""
    made, annotation, catalogue = _levels(spark)
    catalogue = catalogue.withColumn("ref_peptide", F.expr("concat('P', cast(substring(ref_peptide, 2) as int) % 20)"))
    out = cross.level1_identical(made, annotation, catalogue, require_spanning=True)
    want = []
    about = {(r.sample, r.sample_sv_id): r for r in annotation.collect()}
    for m in made.collect():
        for c in catalogue.collect():
            if m.spans_junction and m.neopeptide.strip().upper() == c.ref_peptide:
                a = about.get((m.sample, m.sample_sv_id))
                want.append(str((m.sample, m.sample_sv_id, c.ref_peptide, True, c.ref_gene, c.ref_svtype, *((a.gene1, a.gene2, a.svtype) if a else (None,) * 3))))
    assert want and sorted(want) == sorted(str(tuple(r)[:9]) for r in out.collect())
    top = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert "Inner" in top[0] and any("LeftOuter" in x for x in top[1:])


def test_population_texts_are_searched_once(spark):
    lines = ["#x", "chr1\t5\tx\tN\t<DEL>\t.\tPASS\tEND=9;AF=0.5;AF_afr=0.25", "1\t5\tx\tN\t<DEL>\t.\tPASS\tAF=0.5", "1\t5\tx\tN\t<DEL>\t.\tPASS\tXEND=9;END=b;AF=1", "1\t5\tx", "2\tz\t\t\t\t\t\tAF=1;END=7;END=8"]
    out = readers.parse_population_sites(spark.createDataFrame([(x,) for x in lines], "value string")).select("chrom", "start", "end", "af", "af_afr")
    assert sorted(map(tuple, out.collect()), key=str) == [("1", 5, 9, 0.5, 0.25), ("2", None, 7, 1.0, None)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count(";)END=") == 1


def test_carried_peptides_make_no_row_for_each_allele(spark):
    rng = random.Random(9)
    carried = [(rng.choice([None, *range(12)]), f"p{rng.randrange(15)}") for _ in range(120)]
    genotypes = [(rng.randrange(9), rng.choice([None, *"abcdef"])) for _ in range(30)]
    pairs, panel = [(f"p{rng.randrange(15)}", rng.choice("abcd")) for _ in range(20)], list("abcd")
    out = binding.autologous(
        spark.createDataFrame(carried, "patient int, neoantigen string"), spark.createDataFrame(genotypes, "patient int, allele string"),
        spark.createDataFrame(pairs, "peptide string, allele string"), spark.createDataFrame([(x,) for x in panel], "allele string"),
    )
    assert not any("hashpartitioning(peptide" in x and "," in x.split("hashpartitioning(")[1].split(")")[0].rsplit(",", 1)[0] for x in plan(out).splitlines())
    own = lambda patient: {a for p, a in genotypes if p == patient and patient is not None and a}
    for r in out.collect():
        who = {p for p, x in carried if x == r.peptide}
        mine, binds = set().union(*map(own, who)), {a for x, a in pairs if x == r.peptide}
        named = who - {None}
        want = (len(named), sum(1 for p in named if own(p)), sum(1 for p in named if own(p) & binds), len(mine - set(panel)), sorted(mine & binds))
        assert (r.patients, r.patients_typed, r.patients_presenting, r.alleles_outside, r.presenting_alleles) == want
