"""Registered queries over stored forms and whole features: stored alignments, junction proof, cohort ingest, admitted
VCF files, population tables; with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions.alignments import span
from .operators import admission, confidence, proof, reads
from .operators.ranges import levels_in_use, nested_level, overlapping
from .queries import CODON_SQL, DAY, READS_SQL, SQL_DAY, _alignments, _junctions, derive, query
from .sources import readers, stored, writers
from .streaming import ingest


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared one."""
    return f"{stored.shared_folder(spark)}/juncture/{name}-{uuid.uuid4().hex}"


# Alignments


@query(f"""{READS_SQL}, f as (select id, side, count(distinct q) filter (m >= 20) cov, count(distinct q) filter (m >= 20 and match) n from x group by id, side),
    v as (select id, case when count(*) < 2 then 0 else min(cov) end cov, max(n) n from f group by id)
    select j.id::varchar sample_sv_id, coalesce(cov, 0) min_coverage, coalesce(n, 0) junction_fragments, case when coalesce(n, 0) >= 5 then 'STRONG' when n >= 3 then 'SUGGESTIVE' when n >= 1 then 'WEAK' else 'NONE' end rna_tier from j left join v using (id)""")
def stored_read_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments written by region and nested bin; the evidence reads them through the breakends' windows."""
    path, junctions = scratch(spark, "alignments"), _junctions(spark, sf_dir)
    stored.write_alignments(_alignments(spark, sf_dir), path)
    pairs = stored.alignments_at(spark, path, reads.breakend_windows(junctions), "w0", "w1", ["sample"], reach=reads.window_reach(junctions))
    return reads.event_evidence(junctions, reads.fragment_evidence(pairs), F.lit(True)).select("sample_sv_id", "min_coverage", "junction_fragments", "rna_tier")


_SPLICED = ["cast(l_suppkey % 3 as string) as sample", "cast(l_partkey % 3 as string) as chrom", "cast(l_orderkey as string) as qname", "l_orderkey * 400 as start0", "cast(l_quantity as int) as mapq", "0 as flag",
            "concat('30M', (l_partkey * l_linenumber * 37) % 600000, 'N20M') as cigar", "'ACGT' as seq", "cast(null as string) as sa_tag"]


@query("""
    with r as (select l_suppkey % 3 s, l_partkey % 3 c, l_orderkey * 400 a, l_orderkey * 400 + 50 + (l_partkey * l_linenumber * 37) % 600000 b from lineitem),
    j as (select o_custkey % 3 s, o_orderkey % 3 c, o_orderkey k, o_orderkey * 400 + 200 p from orders where o_orderkey % 40 = 7)
    select k, count(*) n, count(*) filter (b - a > 100000) n_long from j join r using (s, c) where a <= p + 200 and b >= p - 200 group by k""")
def spliced_reads_at_loci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with gaps of up to 600,000 bases, each kept in one nested bin."""
    spots = derive(spark, sf_dir, "orders", "cast(o_custkey % 3 as string) as sample", "cast(o_orderkey % 3 as string) as chrom", "o_orderkey as k", "o_orderkey * 400 as w0", "o_orderkey * 400 + 400 as w1", where="o_orderkey % 40 = 7")
    met = overlapping(spots, reads.with_walks(derive(spark, sf_dir, "lineitem", *_SPLICED)).select("sample", "chrom", "start0", "end0"), ["sample", "chrom"], ("w0", "w1"), ("start0", "end0"), 1000)
    return met.groupBy("k").agg(F.count("*").alias("n"), F.count_if(F.col("end0") - F.col("start0") > 100_000).alias("n_long"))


# Junction proof


#: Coding blocks [P + 1, P + 60] and [P + 101, P + 140] of a transcript, P the order's place; the event removes what lies
#: between P + 20 and P + 21 + size.
_SIZE = "(27 + o_orderkey % 7)"
_CDS = "translate(concat(md5(cast(o_orderkey % 200 as string)), md5(cast(o_custkey as string)), md5(cast(o_orderkey as string)), md5('x')), '0123456789abcdef', 'ACGTACGTACGTACGT')"


@query(f"""
    with recursive o as (select o_orderkey k, 27 + o_orderkey % 7 z, case when o_orderkey % 2 = 0 then '+' else '-' end st, translate(md5((o_orderkey % 200)::varchar) || md5(o_custkey::varchar) || md5(o_orderkey::varchar) || md5('x'), '0123456789abcdef', 'ACGTACGTACGTACGT')[1:100] cds from orders),
    r as (select k, l_quantity::int m, (l_linenumber % 3) * 2 j, l_linenumber % 2 e, case when st = '+' then 20 + (l_linenumber % 3) * 2 else 80 - (l_linenumber % 3) * 2 - z end nl, z, st, cds, l_linenumber % 4 w from o join lineitem on l_orderkey = k),
    q as (select k, m, j, e, case when w = 3 then 'ACGT' else substr(cds, greatest(1, nl - 24), nl - greatest(1, nl - 24) + 1) || substr(cds, nl + z + 1, 25) end seq from r),
    g as (select k, j, count(*) n from q where m >= 20 and e = 0 group by k, j),
    b as (select k, j, n, case when st = '+' then 20 + j else 80 - j - z end nl, z, cds from o join g using (k)),
    p as (select k, 'breakpoint' probe, case when st = '+' then 20 else 80 - z end nl, z, cds from o union all select b.k, (k * 1000 + 21 + j) || '-' || (k * 1000 + 20 + j + z), nl, z, cds from b where j <> 0),
    s as (select k, probe, substr(cds, greatest(0, nl - 20) + 1, nl - greatest(0, nl - 20)) || substr(cds, nl + z + 1, 20) x from p),
    h as (select s.k, probe, count(*) filter (contains(q.seq, x) or contains(q.seq, reverse(translate(x, 'ACGT', 'TGCA')))) h from s join q using (k) group by s.k, probe),
    v as (select k, coalesce(max(h) filter (probe = 'breakpoint'), 0) own, max({{'h': h, 'p': probe}}) filter (probe <> 'breakpoint') g from h group by k),
    t as (select k, z, string_split(array_to_string(list_transform(range(len(cds) // 3), lambda i: {CODON_SQL}[cds[i * 3 + 1 : i * 3 + 3]]), ''), '*')[1] wt, substr(cds, 1, case when st = '+' then 20 else 80 - z end) || substr(cds, case when st = '+' then 21 + z else 81 end) mc from o),
    u as (select k, z, wt, string_split(array_to_string(list_transform(range(len(mc) // 3), lambda i: {CODON_SQL}[mc[i * 3 + 1 : i * 3 + 3]]), ''), '*')[1] mt from t),
    f as (select *, coalesce(list_min(list_filter(range(least(len(wt), len(mt))), lambda i: wt[i + 1] <> mt[i + 1])), least(len(wt), len(mt))) fc from u),
    n as (select k, z, mt, fc, list_distinct(list_filter(flatten(list_transform([8, 9, 10, 11], lambda w: list_transform(range(greatest(len(mt) - w + 1, 0)), lambda i: mt[i + 1 : i + w]))), lambda x: not contains(wt, x))) nw from f)
    select n.k, n.z::int coding_removed, n.z % 3 = 0 in_frame, fc::int first_changed, len(nw)::int novel, array_to_string(list_sort(list_filter(nw, lambda x: instr(mt, x) - 1 <= fc and fc < instr(mt, x) - 1 + len(x))), ',') spanning,
           (select count(*) from q where q.k = n.k) reads, coalesce((select sum(g.n)::bigint from g where g.k = n.k and j = 0), 0) own_gaps, coalesce((select sum(g.n)::bigint from g where g.k = n.k and j <> 0), 0) other_gaps,
           coalesce(own, 0) breakpoint_hits, v.g.p gap, coalesce(v.g.h, 0) gap_hits, case when greatest(coalesce(own, 0), coalesce(v.g.h, 0)) = 0 then 'neither' when own >= coalesce(v.g.h, 0) then 'breakpoint' else 'gap' end supported from n left join v using (k)""")
def junction_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a deletion in a transcript of its own, on either strand; its lines are reads over gaps at several places."""
    place = "o_orderkey * 1000"
    events = derive(spark, sf_dir, "orders", "o_orderkey as k", "'s' as sample", "cast(o_orderkey % 3 as string) as chrom", f"{place} + 20 as pos1", f"{place} + 21 + {_SIZE} as pos2", "concat('t', o_orderkey) as transcript_id")
    blocks = f"array(named_struct('start', {place} + 1, 'end', {place} + 60), named_struct('start', {place} + 101, 'end', {place} + 140))"
    transcripts = derive(spark, sf_dir, "orders", "concat('t', o_orderkey) as transcript_id", "if(o_orderkey % 2 = 0, '+', '-') as strand", f"{blocks} as cds_blocks", f"substring({_CDS}, 1, 100) as cds")
    # A line's place and CIGAR follow from its order's number; only the sequence needs more of the order.
    read = ["'s' as sample", "cast(k % 3 as string) as chrom", "concat_ws('.', k, i) as qname", "k * 1000 as start0", "mapq", "concat(20 + j, 'M', z + e, 'N50M') as cigar"]
    lines = derive(spark, sf_dir, "lineitem", "l_orderkey as o_orderkey", "l_linenumber as i", "cast(l_quantity as int) as mapq")
    facts = ["o_orderkey as k", "i", "mapq", "cast(i % 3 * 2 as int) as j", "cast(i % 2 as int) as e", f"{_SIZE} as z"]
    levels = levels_in_use(lines.selectExpr(*facts).selectExpr(*read).select(nested_level(F.lit(0), span(F.col("cigar")), 1000).alias("_level")))
    rows = derive(spark, sf_dir, "orders", "o_orderkey", "o_custkey").join(lines, "o_orderkey").selectExpr(*facts, f"substring({_CDS}, 1, 100) as cds")
    rows = rows.withColumn("nl", F.expr("cast(if(k % 2 = 0, 20 + j, 80 - j - z) as int)")).withColumn("first", F.expr("greatest(1, nl - 24)"))
    alignments = rows.selectExpr(*read, "if(i % 4 = 3, 'ACGT', concat(substring(cds, first, nl - first + 1), substring(cds, cast(nl + z + 1 as int), 25))) as seq")
    return proof.prove_junctions(events, transcripts, alignments, ["k"], levels=levels).withColumn("spanning", F.array_join("spanning", ","))


# Files


@query("""
    with p as (select 'p' || (o_custkey % 40) patient, o_custkey % 40 u, 'PEP' || (o_orderkey % 500) pep, o_orderstatus s, o_orderkey k from orders),
    b as (select patient, count(*) broken from p where u % 8 = 3 and k % 50 = 7 group by patient)
    select p.patient, coalesce(max(broken), 0)::bigint broken_lines, case when max(broken) is null then count(*) else 0 end n_rows, case when max(broken) is null then count(distinct pep) else 0 end n_peptides from p left join b using (patient) group by p.patient""")
def cohort_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as one peptide file a patient, streamed in; a patient with a line that does not fit fails alone."""
    source, out, mark, bad, done = (scratch(spark, f"cohort-{n}") for n in ("in", "out", "mark", "bad", "done"))
    line = "concat_ws('\\t', concat('PEP', o_orderkey % 500), if(o_custkey % 40 % 8 = 3 and o_orderkey % 50 = 7, 'broken', cast(o_orderkey as string)))"
    rows = derive(spark, sf_dir, "orders", "concat('p', o_custkey % 40) as patient", f"{line} as value", "1 as place")
    heads = rows.select("patient").distinct().select("patient", F.lit("neoantigen\tn").alias("value"), F.lit(0).alias("place"))
    rows.unionByName(heads).repartition("patient").sortWithinPartitions("patient", "place").select("patient", "value").write.partitionBy("patient").text(source)
    ingest.ingest_available(spark, source, "neoantigen string, n long", out, mark, bad, done)
    good = spark.read.schema("neoantigen string, n long, batch int, patient string").parquet(out).groupBy("patient").agg(F.lit(0).cast("long").alias("broken_lines"), F.count("*").alias("n_rows"), F.count_distinct("neoantigen").alias("n_peptides"))
    failed = spark.read.schema("patient string, broken_lines long, example string, batch int").parquet(bad)
    return good.unionByName(failed.select("patient", "broken_lines", F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_peptides")))


_VCF_LINE = "concat_ws('\\t', concat('chr', o_custkey % 22 + 1), o_orderkey, if(o_custkey % 5 = 2 and o_orderkey % 9 = 0, '.', cast(o_orderkey as string)), 'A', concat('A[chr1:', o_orderkey + 50, '['), '50', if(o_orderkey % 4 = 1, 'LOWQ', 'PASS'), concat('SVTYPE=DEL;MATEID=m', o_orderkey, ';PON_COUNT=', o_orderkey % 20))"


@query("""
    with o as (select 's' || (o_custkey % 5) sample, o_orderkey k, o_custkey % 22 + 1 c, o_orderkey % 20 < 10 ok from orders)
    select sample, (1 + count(*) filter (ok))::bigint lines, sum(case when ok then k else 0 end)::bigint places, true in_order from o group by sample""")
def admitted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCFs of five samples written, admitted, written as files and read back: header first, kept lines in file order."""
    target = scratch(spark, "admitted")
    rows = derive(spark, sf_dir, "orders", "concat('s', o_custkey % 5) as sample", "o_orderkey as place", f"{_VCF_LINE} as value")
    heads = rows.select("sample").distinct().select("sample", F.lit(-1).cast("long").alias("place"), F.lit("##fileformat=VCFv4.2").alias("value"))
    lines = rows.unionByName(heads).select("sample", F.col("place").alias("file_row"), F.col("value").alias("line"))
    writers.write_admitted(lines.select("*", *[c.alias(n) for n, c in readers.record_facts(F.col("line")).items()]), admission.admit(readers.parse_breakends(lines.withColumnRenamed("line", "value")), "germline", 10), target)
    back = spark.read.text(target).select("sample", "value", F.monotonically_increasing_id().alias("n"), F.get(F.split("value", "\t"), F.lit(1)).try_cast("long").alias("pos"))
    order = W.partitionBy("sample").orderBy("n")
    checked = back.withColumn("_before", F.lag("pos").over(order)).withColumn("_row", F.row_number().over(order))
    fine = F.when(F.col("_row") == 1, F.startswith("value", F.lit("#"))).otherwise(F.col("_before").isNull() | (F.col("_before") <= F.col("pos")))
    return checked.groupBy("sample").agg(F.count("*").alias("lines"), F.coalesce(F.sum("pos"), F.lit(0)).alias("places"), F.bool_and(fine).alias("in_order"))


@query(f"""
    with e as (select o_orderkey k, (o_custkey % 5)::varchar c, {SQL_DAY.format("o_orderdate")} a, {SQL_DAY.format("o_orderdate")} + 5 + o_orderkey % 30 b from orders where o_custkey % 5 < 2),
    r as (select (l_suppkey % 5)::varchar c, {SQL_DAY.format("l_shipdate")} a, {SQL_DAY.format("l_shipdate")} + l_quantity::bigint b, round(l_discount * 0.11, 9) af from lineitem where l_partkey % 9 = 0),
    p as (select e.k, r.af from e join r on e.c = r.c and least(e.b, r.b) - greatest(e.a, r.a) >= 0.5 * greatest(e.b - e.a, r.b - r.a))
    select k, max(af) af, max(af) popmax, coalesce(max(af) >= 0.01, false) common_in_population from p group by k""")
def stored_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population records written by chromosome; events of two chromosomes read their folders only; common or not."""
    path, day, ship = scratch(spark, "population"), DAY.format("o_orderdate"), DAY.format("l_shipdate")
    records = derive(
        spark, sf_dir, "lineitem", "cast(l_suppkey % 5 as string) as chrom", f"cast({ship} as bigint) as start", f"cast({ship} + cast(l_quantity as bigint) as bigint) as end", "round(l_discount * 0.11, 9) as af", "round(l_discount * 0.11, 9) as af_afr",
        "round(l_discount * 0.05, 9) as af_eas", where="l_partkey % 9 = 0",
    )
    stored.write_population(records, path)
    events = derive(
        spark, sf_dir, "orders", "o_orderkey as k", "cast(o_custkey % 5 as string) as chrom1", "cast(o_custkey % 5 as string) as chrom2", f"{day} as pos1", f"{day} + 5 + o_orderkey % 30 as pos2", f"4 + o_orderkey % 30 as event_size", where="o_custkey % 5 < 2",
    )
    found = confidence.population_frequency(events, stored.read_population(spark, path), "k")
    return confidence.common_in_population(found).select("k", "af", "popmax", "common_in_population")
