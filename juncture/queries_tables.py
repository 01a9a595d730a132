"""Registered queries over sources written and read back, and over operators that other queries do not reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .criteria import DEFAULT
from .operators import audit, binding, confidence, cross, funnel, master, peptides, reads, universe
from .plans import pipeline as plan
from .queries import CODON_SQL, derive, query, table
from .queries_stored import scratch
from .sources import readers, writers

# Sources


@query("select p_brand ref_gene, count(*) n, count(distinct upper(trim(p_name))) n_peptides from (select distinct p_name, p_brand, p_type from part) group by 1")
def catalogue_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "catalogue")
    writers.write_table(derive(spark, sf_dir, "part", "concat(' ', lower(p_name), ' ') as neo", "p_brand as g", "p_type as t").distinct(), path, text=True)
    df = readers.read_catalogue(spark, f"{path}.tsv", {"neo": "ref_peptide", "g": "ref_gene", "t": "ref_svtype"})
    return df.groupBy("ref_gene").agg(F.count("*").alias("n"), F.count_distinct("ref_peptide").alias("n_peptides"))


@query("""
    select (l_suppkey % 22)::varchar chrom1, case when l_linenumber = 1 then 'X' else (l_partkey % 22)::varchar end chrom2, count(*) n, sum(l_orderkey)::bigint places1, sum(l_orderkey + 50)::bigint places2 from lineitem group by 1, 2""")
def pool_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "pool")
    rows = derive(spark, sf_dir, "lineitem", "concat('P', l_partkey) as pep", "concat('chr', l_suppkey % 22) as c1", "cast(l_orderkey as double) as p1", "if(l_linenumber = 1, 'chrx', cast(l_partkey % 22 as string)) as c2", "l_orderkey + 50 as p2", "l_returnflag as t", "l_linestatus as g")
    writers.write_table(rows, path, text=True)
    names = {"pep": "ref_peptide", "c1": "chrom1", "p1": "pos1", "c2": "chrom2", "p2": "pos2", "t": "svtype", "g": "gene1"}
    return readers.read_pool(spark, f"{path}.tsv", names).groupBy("chrom1", "chrom2").agg(F.count("*").alias("n"), F.sum("pos1").alias("places1"), F.sum("pos2").alias("places2"))


@query("select c_name || ' ' || c_custkey protein, upper(translate(md5(c_name), '0123456789abcdef', 'acdefghiklmnpqrs')) sequence from customer")
def proteome_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, acids = scratch(spark, "proteome"), "translate(md5(c_name), '0123456789abcdef', 'acdefghiklmnpqrs')"
    derive(spark, sf_dir, "customer", f"concat('>', c_name, ' ', c_custkey, '\\n', substring({acids}, 1, 20), '\\n', substring({acids}, 21, 20)) as value").write.text(path)
    return readers.read_proteome(spark, path)


@query("select 's' || (o_custkey % 7) sample, o_orderstatus frame_effect, count(*) n, count(*) filter (o_orderkey % 3 = 0) n_spanning, count(distinct o_orderkey)::bigint n_variants from orders group by 1, 2")
def precomputed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peptides under the older names of sample, id and frame columns."""
    path = scratch(spark, "precomputed")
    rows = derive(spark, sf_dir, "orders", "concat('s', o_custkey % 7) as prefix", "o_orderkey as sv_id", "o_orderstatus as frameshift", "concat('PEP', o_orderkey % 90) as neopeptide", "if(o_orderkey % 3 = 0, 'True', 'False') as spans_junction")
    writers.write_table(rows, path, text=True, columns=["prefix", "sv_id", "frameshift", "neopeptide", "spans_junction"])
    df = readers.read_precomputed(spark, f"{path}.tsv", "peptide")
    return df.groupBy("sample", "frame_effect").agg(F.count("*").alias("n"), F.count_if("spans_junction").alias("n_spanning"), F.count_distinct("sample_sv_id").alias("n_variants"))


@query("""
    select (l_suppkey % 22)::varchar chrom, count(*) n, sum(l_partkey % 900)::bigint bases, round(sum(l_discount), 6) af, round(sum(case when l_linenumber <> 2 then l_tax end), 6) af_afr from lineitem where l_linenumber <> 3 and l_linenumber <> 5 group by 1""")
def population_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites without END or AF go; an ancestry that is not given is null."""
    info = "concat_ws(';', if(l_linenumber = 5, null, concat('END=', l_orderkey + l_partkey % 900)), if(l_linenumber = 3, null, concat('AF=', l_discount)), if(l_linenumber = 2, null, concat('AF_afr=', l_tax)), 'SVTYPE=DEL')"
    lines = derive(spark, sf_dir, "lineitem", f"concat_ws('\\t', concat('chr', l_suppkey % 22), l_orderkey, 'x', 'N', '<DEL>', '.', 'PASS', {info}) as value")
    df = readers.parse_population_sites(lines)
    return df.groupBy("chrom").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bases"), F.round(F.sum("af"), 6).alias("af"), F.round(F.sum("af_afr"), 6).alias("af_afr"))


@query("select p_name gene, count(*) n, round(sum(p_retailprice), 4) tpm from part group by 1")
def expression_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "expression")
    writers.write_table(derive(spark, sf_dir, "part", "p_size as rank", "p_name as GeneName", "p_retailprice as AdjTPM"), path, text=True)
    return readers.read_expression(spark, f"{path}.tsv", "gene").groupBy("gene").agg(F.count("*").alias("n"), F.round(F.sum("tpm"), 4).alias("tpm"))


@query("select (o_custkey % 22)::varchar chrom, o_orderstatus kind, count(*) n, count(*) n_rows, sum(o_orderkey)::bigint starts, sum(o_orderkey % 40)::bigint fragments from orders group by 1, 2")
def call_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "splice")
    rows = derive(spark, sf_dir, "orders", "concat('chr', o_custkey % 22) as Chromosome", "o_orderkey as SjStart", "o_orderkey + 100 as SjEnd", "o_orderkey % 40 as FragCount", "o_orderstatus as Type")
    writers.write_table(rows, path, text=True)
    df = readers.read_calls(spark, f"{path}.tsv", "alt_splice_junction")
    return df.groupBy(F.col("Chromosome").alias("chrom"), F.col("Type").alias("kind")).agg(F.count("*").alias("n"), F.count_distinct("call_row").alias("n_rows"), F.sum("SjStart").alias("starts"), F.sum("FragCount").alias("fragments"))


@query("select (o_custkey % 22)::varchar chrom, count(*) n, sum(o_orderkey % 500)::bigint bases, min('r' || o_orderkey) first_name from orders where o_orderkey % 17 <> 0 group by 1")
def bed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with or without a header line, in either spelling of the chromosome."""
    line = "if(o_orderkey % 17 = 0, 'chrom\\tstart\\tend\\tname', concat_ws('\\t', concat(if(o_orderkey % 2 = 0, 'chr', ''), o_custkey % 22), o_orderkey, o_orderkey + o_orderkey % 500, concat('r', o_orderkey)))"
    df = readers.parse_bed(derive(spark, sf_dir, "orders", f"{line} as value", "o_orderkey as file_row"))
    return df.groupBy("chrom").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bases"), F.min("name").alias("first_name"))


@query("select count(*) records, max(o_orderkey % 3514)::int largest_count, count(distinct (o_custkey % 24)::varchar || ':' || (o_orderkey % 24)::varchar) chromosome_pairs from orders")
def panel_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "panel")
    derive(
        spark, sf_dir, "orders", "concat('chr', o_custkey % 24) as a", "o_orderkey as b", "o_orderkey + 1 as c", "concat('chr', o_orderkey % 24) as d", "o_custkey as e", "o_custkey + 1 as f", "'x' as g", "o_orderkey % 3514 as h", "'+' as i", "'-' as j",
    ).write.option("sep", "\t").csv(path)
    panel = readers.read_panel(spark, path)
    pairs = panel.agg(F.count_distinct(F.concat_ws(":", "chrom1", "chrom2")).alias("chromosome_pairs"), F.lit(0).alias("k"))
    return confidence.describe_panel(panel).withColumn("k", F.lit(0)).join(pairs, "k").drop("k")


@query("select l_suppkey % 40 allele, count(*) n, min(l_discount) best from lineitem where l_discount <= 0.02 and l_quantity <= 20 group by 1")
def passing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written, and read with the filter in the scan."""
    path = scratch(spark, "predictions")
    derive(spark, sf_dir, "lineitem", "l_suppkey % 40 as allele", "l_partkey as peptide", "l_discount as rank_EL", "l_quantity as affinity_nM").write.parquet(path)
    return readers.passing_predictions(spark.read.parquet(path), {"rank_EL": 0.02, "affinity_nM": 20.0}).groupBy("allele").agg(F.count("*").alias("n"), F.min("rank_EL").alias("best"))


@query("""
    with g as (select c_custkey k, 'HLA-A_1' locus, 'A*' || (c_custkey % 9) allele from customer where c_custkey % 6 <> 0 union all select c_custkey, 'HLA-A_2', 'A*' || (c_custkey % 5) from customer union all select c_custkey, 'HLA-B_1', 'B*' || (c_custkey % 7) from customer where c_custkey % 4 <> 0)
    select locus, count(*) n, count(distinct k) n_patients, count(distinct allele) n_alleles from g group by 1""")
def genotype_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "genotypes")
    writers.write_table(derive(spark, sf_dir, "customer", "c_custkey as sampleId", "if(c_custkey % 6 = 0, '', concat('A*', c_custkey % 9)) as `HLA-A_1`", "concat('A*', c_custkey % 5) as `HLA-A_2`", "if(c_custkey % 4 = 0, null, concat('B*', c_custkey % 7)) as `HLA-B_1`"), path, text=True)
    df = readers.long_genotypes(readers.separated(spark, f"{path}.tsv"), "sampleId")
    return df.groupBy("locus").agg(F.count("*").alias("n"), F.count_distinct("patient").alias("n_patients"), F.count_distinct("allele").alias("n_alleles"))


@query("select 'T' || p_partkey transcript_id, 'G' || (p_partkey % 90) gene, case when p_size % 5 = 0 then 0 when p_size % 5 = 1 then 1 else 9 end rank from part where p_size % 7 <> 0")
def transcript_rank_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = "case when p_size % 5 = 0 then ' tag \"MANE_Select\"; tag \"Ensembl_canonical\";' when p_size % 5 = 1 then ' tag \"Ensembl_canonical\";' else '' end"
    line = f"concat('1\\thavana\\t', if(p_size % 7 = 0, 'exon', 'transcript'), '\\t1\\t9\\t.\\t+\\t.\\tgene_id \"x\"; transcript_id \"T', p_partkey, '.3\"; gene_name \"G', p_partkey % 90, '\";', {tags})"
    return readers.transcript_ranks(derive(spark, sf_dir, "part", f"{line} as value"))


@query("select o_orderkey % 300 sample, o_orderpriority allele, c_mktsegment qc_status, count(*) n from orders left join customer on o_orderkey % 300 = c_custkey and c_custkey % 3 <> 0 group by 1, 2, 3")
def typing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = derive(spark, sf_dir, "orders", "o_orderkey % 300 as sample", "o_orderpriority as allele")
    quality = derive(spark, sf_dir, "customer", "c_custkey as sample", "c_mktsegment as qc_status", where="c_custkey % 3 <> 0")
    return readers.collect_typing(results, quality).groupBy("sample", "allele", "qc_status").agg(F.count("*").alias("n"))


@query("select count(*) orders, max(o_orderkey) largest from orders")
def manifest_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "manifest")
    one = table(spark, sf_dir, "orders").agg(F.count("*").alias("orders"), F.max("o_orderkey").alias("largest")).first()
    writers.write_manifest(spark, one.asDict(), path)
    return spark.read.schema("orders long, largest long").json(path)


# Quality, models and binding


_ACIDS = "translate(md5(p_name), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')"
_PEPTIDE = f"if(p_partkey % 5 = 0, concat(substring({_ACIDS}, 1, 4), 'AAAAA'), substring({_ACIDS}, 3, 9))"


@query("""
    with p as (select p_partkey k, p_size z, translate(md5(p_name), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') a from part), t as (select k, z, case when k % 5 = 0 then a[1:4] || 'AAAAA' else a[3:11] end s from p),
    f as (select distinct a[i + 1 : i + 9] g from p, unnest(range(12)) r(i) where z < 10), l as (select *, list_filter(string_split(s, ''), lambda x: x <> '') l from t),
    m as (select *, list_transform(list_distinct(l), lambda c: len(list_filter(l, lambda x: x = c)) / len(l)) q, list_max(list_transform(range(len(l)), lambda i: len(list_filter([4], lambda w: i + w <= len(l) and len(list_distinct(l[i + 1 : i + w])) = 1)))) r from l),
    c as (select k, z, s, len(q) <= 3 or list_max(q) >= 0.5 or r > 0 or round(list_sum(list_transform(q, lambda x: -x * log2(x))), 12) < 2.0 low from m)
    select k, s ref_peptide, s in (select g from f) is_self, low low_complexity, not low and s not in (select g from f) and coalesce(case when z % 4 <> 0 then z % 2 = 1 end, false) credible from c""")
def credible_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = derive(spark, sf_dir, "part", "p_partkey as k", f"{_PEPTIDE} as ref_peptide", "if(p_size % 4 <> 0, p_size % 2 = 1, null) as gene_concordant")
    proteome = derive(spark, sf_dir, "part", f"substring({_ACIDS}, 1, 20) as sequence", where="p_size < 10")
    return cross.sequence_quality(matches, proteome).select("k", "ref_peptide", "is_self", "low_complexity", "credible")


_NATIVE = "translate(concat(md5({0}), md5(concat({0}, 'a')), md5(concat({0}, 'b'))), '0123456789abcdef', 'ACGTACGTACGTACGT')"


@query(f"""
    with p as (select p_partkey k, p_partkey % 40 h, p_size % 6 d, translate(md5(p_name) || md5(p_name || 'a') || md5(p_name || 'b'), '0123456789abcdef', 'ACGTACGTACGTACGT') n from part),
    f as (select k, h, d, n, n[1:h] || n[h + d + 1 :] u from p),
    a as (select *, len(string_split(array_to_string(list_transform(range(len(u) // 3), lambda i: {CODON_SQL}[u[i * 3 + 1 : i * 3 + 3]]), ''), '*')[1]) l, len(u) // 3 w from f)
    select k, case when h < 9 then 'Start-loss' when d % 3 = 0 and l >= w - 1 then 'In-frame' when l = w then 'Stop-loss' else 'Stop-gain' end frame_effect from a""")
def frame_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, "part", "p_partkey as k", "cast(p_partkey % 40 as int) as h", "cast(p_size % 6 as int) as d", f"{_NATIVE.format('p_name')} as n")
    fused = F.concat(F.substring(F.col("n"), F.lit(1), F.col("h")), F.substring(F.col("n"), F.col("h") + F.col("d") + 1, F.length("n")))
    return rows.select("k", peptides.frame_effect(F.col("h"), F.col("n"), fused).alias("frame_effect"))


#: Deletions, duplications and others in a transcript with coding blocks [1, 60] and [101, 140], as SQL up to `m`.
REARRANGED_SQL = """
    with o as (select o_orderkey k, case when o_orderkey % 2 = 0 then '+' else '-' end st, [21, 31, 70, 55][o_orderkey % 4 + 1] p1, [51, 80, 90, 120][o_orderkey % 4 + 1] p2, ['DEL', 'DUP', 'INV'][o_custkey % 3 + 1] t, case when o_custkey % 2 = 0 then 'GATTACA' else '' end ins,
        substr(translate(md5(o_orderkey::varchar) || md5(o_custkey::varchar) || md5('x') || md5('y'), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 100) cds from orders),
    f as (select *, case when st = '+' then p1 else p2 end five, case when st = '+' then p2 else p1 end three from o),
    u as (select *, case when st = '+' then least(five, 60) + greatest(five - 100, 0) else 100 - least(five - 1, 60) - greatest(five - 101, 0) end u5, case when st = '+' then least(three, 60) + greatest(three - 100, 0) else 100 - least(three - 1, 60) - greatest(three - 101, 0) end u3,
                    (five <= 60 or five > 100)::int i5, (three <= 60 or three > 100)::int i3 from f),
    m as (select *, case when i5 = 0 and i3 = 0 and u5 = u3 then 'same_intron' when t = 'DEL' then 'deletion' when t = 'DUP' then 'duplication' else 'not_modelled' end model from u)"""


def _rearranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    cds = "translate(concat(md5(cast(o_orderkey as string)), md5(cast(o_custkey as string)), md5('x'), md5('y')), '0123456789abcdef', 'ACGTACGTACGTACGT')"
    events = derive(
        spark, sf_dir, "orders", "o_orderkey as k", "if(o_orderkey % 2 = 0, '+', '-') as strand", "cast(array(21, 31, 70, 55)[cast(o_orderkey % 4 as int)] as long) as pos1", "cast(array(51, 80, 90, 120)[cast(o_orderkey % 4 as int)] as long) as pos2",
        "array('DEL', 'DUP', 'INV')[cast(o_custkey % 3 as int)] as svtype", "if(o_custkey % 2 = 0, 'GATTACA', null) as insert_seq", f"substring({cds}, 1, 100) as cds", "array(named_struct('start', 1L, 'end', 60L), named_struct('start', 101L, 'end', 140L)) as cds_blocks",
    )
    return peptides.rearranged_coding(events)


@query(f"""{REARRANGED_SQL}
    select k, model, case model when 'deletion' then cds[1:u5] || ins || cds[u3 - i3 + 1 :] when 'duplication' then cds[1:u3] || ins || cds[u5 - i5 + 1 :] end fused,
           (case model when 'deletion' then u5 + len(ins) when 'duplication' then u3 + len(ins) end)::int junction_nt from m""")
def rearranged_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletions, duplications, events inside one intron and classes without a model, on both strands."""
    return _rearranged(spark, sf_dir).select("k", "model", "fused", "junction_nt")


_PROTEIN_SQL = f"string_split(array_to_string(list_transform(range(len({{0}}) // 3), lambda i: {CODON_SQL}[{{0}}[i * 3 + 1 : i * 3 + 3]]), ''), '*')[1]"


@query(f"""{REARRANGED_SQL},
    x as (select k, cds, case model when 'deletion' then cds[1:u5] || ins || cds[u3 - i3 + 1 :] else cds[1:u3] || ins || cds[u5 - i5 + 1 :] end fu, case model when 'deletion' then u5 + len(ins) else u3 + len(ins) end j from m where model in ('deletion', 'duplication')),
    p as (select k, j, {_PROTEIN_SQL.format("fu")} a, {_PROTEIN_SQL.format("cds")} n from x),
    w as (select k, a[i + 1 : i + z] g, max((i * 3 < j and j < (i + z) * 3)::int) s from p, unnest([8, 9, 10, 11]) y(z), unnest(range(greatest(len(a) - z + 1, 0))) t(i) where not contains(n, a[i + 1 : i + z]) group by k, g)
    select k, count(*) n_windows, sum(s)::bigint n_spanning, min(g) first_peptide from w group by k""")
def candidate_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate peptides: windows of the rearranged protein that the native one lacks."""
    made = peptides.candidate_peptides(_rearranged(spark, sf_dir), ["k"])
    return made.groupBy("k").agg(F.count("*").alias("n_windows"), F.count_if("spans_junction").alias("n_spanning"), F.min("neopeptide").alias("first_peptide"))


@query("select l_suppkey % 30 allele, count(distinct l_partkey) n_peptides from lineitem group by 1")
def submitted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions that are refused unless every peptide was predicted and an allele is spelled as in the panel."""
    rows = derive(spark, sf_dir, "lineitem", "l_partkey as peptide", "l_suppkey % 30 as allele")
    binding.check_submitted(rows.filter("peptide % 3 = 0"), rows, derive(spark, sf_dir, "customer", "c_custkey % 30 as allele"))
    return rows.groupBy("allele").agg(F.count_distinct("peptide").alias("n_peptides"))


@query("""
    with l as (select l_partkey p, l_suppkey % 30 a, l_discount * 40 e, l_quantity * 20 f from lineitem), g as (select distinct c_custkey % 30 a from customer where c_custkey % 7 = 0), o as (select * from l where a in (select a from g)),
    x as (select p, bool_or(e <= 2.0) one_presented, arg_max(a, {'m': (2.0 - e) / 2.0, 'a': a}) one_allele, max((2.0 - e) / 2.0) one_margin, bool_or(f <= 500.0) two_presented, arg_max(a, {'m': (500.0 - f) / 500.0, 'a': a}) two_allele, max((500.0 - f) / 500.0) two_margin from o group by p)
    select p peptide, one_presented, one_allele, round(one_margin, 6) one_margin, two_presented, two_allele, round(two_margin, 6) two_margin, one_presented = two_presented predictors_agree from x""")
def own_presentability(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, "lineitem", "l_partkey as peptide", "l_suppkey % 30 as allele", "l_discount * 40 as e", "l_quantity * 20 as f")
    genotype = derive(spark, sf_dir, "customer", "c_custkey % 30 as allele", where="c_custkey % 7 = 0")
    out = binding.own_presentability({"one": rows.select("peptide", "allele", "e"), "two": rows.select("peptide", "allele", "f")}, genotype, {"one": {"e": 2.0}, "two": {"f": 500.0}})
    return out.withColumns({c: F.round(c, 6) for c in ("one_margin", "two_margin")})


@query("""
    with g as (select p_brand g, count(*) n, count(*) filter (p_partkey % 3 = 0) k from part group by 1),
    z as (select g, n, k, i, lgamma(n + 1) - (case when i = 0 then 0 else lgamma(i + 1) end) - (case when i = n then 0 else lgamma(n - i + 1) end) + i * ln(0.4) + (n - i) * ln(0.6) x from g, unnest(range(n + 1)) t(i)),
    o as (select g, x own from z where i = k) select z.g gene_set, n genes, k plus, round(least(1.0, sum(exp(x)) filter (x <= own + 1e-7)), 6) p_value from z join o using (g) group by z.g, n, k""")
def strand_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    genes = derive(spark, sf_dir, "part", "p_brand as gene_set", "if(p_partkey % 3 = 0, '+', '-') as strand", "p_size as length")
    return audit.strand_p_values(audit.strand_composition(genes, "gene_set"), 0.4).select("gene_set", "genes", "plus", F.round("p_value", 6).alias("p_value"))


@query("""
    with r as (select l_quantity::int m, l_linenumber i, l_suppkey c, l_orderkey p, translate(md5(l_orderkey::varchar || l_linenumber), '0123456789abcdef', 'ACGTACGTACGTACGT') s from lineitem), h as (select *, contains(s, 'GATTA') or contains(s, 'TAATC') hit from r)
    select count(*) n_reads, count(*) filter (hit) supporting, count(distinct case when hit then c || ':' || p end) distinct_starts, count(*) filter (hit and m < 20) low_mapq, count(*) filter (hit and i = 2) duplicates, round(1000.0 * count(*) filter (hit) / count(*), 3) per_1000 from h""")
def insertion_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, "lineitem", "cast(l_quantity as int) as mapq", "if(l_linenumber = 2, 1024, 0) as flag", "l_suppkey as chrom", "l_orderkey as start0", "translate(md5(concat(l_orderkey, l_linenumber)), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq")
    return reads.insertion_support(rows, "GATTA").withColumnRenamed("reads", "n_reads")


_INSERT = "ACGTTGCATGCA"


@query(f"""
    with o as (select o_orderkey k, o_orderkey * 10000 p, o_orderkey % 3 t from orders),
    r as (select k, t, l_linenumber i, l_quantity::int m, case when i % 2 = 0 then 'TT{_INSERT}GG' when i = 5 then 'TGCATGCAACGT' else 'TTTT' end s, case when i % 3 = 0 then 'chr9,' || (p + i * 400) || ',+,50M;' when i = 4 then '8,' || p || ',+,50M' end sa from (select o.*, l_linenumber i, l_linenumber, l_quantity from o join lineitem on l_orderkey = k)),
    h as (select k, t, count(distinct i) filter (m >= 20) cov, count(distinct i) filter (m >= 20 and t = 0 and (contains(s, '{_INSERT}') or contains(s, reverse(translate('{_INSERT}', 'ACGT', 'TGCA'))))) ins,
          count(distinct i) filter (m >= 20 and t = 1 and coalesce(i % 3 = 0 and i * 400 <= 1000, false)) chi from r group by k, t)
    select o.k::varchar sample_sv_id, case o.t when 0 then 'insertion' when 1 then 'chimeric' else 'none' end test, coalesce(ins, 0) insertion_fragments, coalesce(chi, 0) chimeric_fragments,
           case when o.t = 2 then 'UNTESTABLE' when greatest(coalesce(ins, 0), coalesce(chi, 0)) >= 5 then 'STRONG' when greatest(coalesce(ins, 0), coalesce(chi, 0)) >= 3 then 'SUGGESTIVE' when greatest(coalesce(ins, 0), coalesce(chi, 0)) >= 1 then 'WEAK' else 'NONE' end rna_tier from o left join h using (k)""")
def mechanism_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insertions by their bases, translocations by the partner of a supplementary alignment, small events untestable."""
    place = "o_orderkey * 10000"
    events = derive(
        spark, sf_dir, "orders", "'s' as sample", "cast(o_orderkey as string) as sample_sv_id", "'1' as chrom1", f"{place} as pos1", "if(o_orderkey % 3 = 1, '9', '1') as chrom2", f"if(o_orderkey % 3 = 1, {place}, {place} + 5) as pos2", "array('INS', 'BND', 'DEL')[cast(o_orderkey % 3 as int)] as svtype",
        "cast(array(12, null, 4)[cast(o_orderkey % 3 as int)] as int) as event_size", "if(o_orderkey % 3 = 0, 12, 0) as insert_len", f"if(o_orderkey % 3 = 0, '{_INSERT}', null) as insert_seq",
    )
    lines = derive(
        spark, sf_dir, "lineitem", "'s' as sample", "'1' as chrom", "cast(l_linenumber as string) as qname", "l_orderkey * 10000 - 20 as start0", "cast(l_quantity as int) as mapq", "0 as flag", "'50M' as cigar",
        f"case when l_linenumber % 2 = 0 then 'TT{_INSERT}GG' when l_linenumber = 5 then 'TGCATGCAACGT' else 'TTTT' end as seq",
        "case when l_linenumber % 3 = 0 then concat('chr9,', l_orderkey * 10000 + l_linenumber * 400, ',+,50M;') when l_linenumber = 4 then concat('8,', l_orderkey * 10000, ',+,50M') end as sa_tag",
    )
    per = reads.fragment_evidence(reads.reads_at_breakends(events, lines))
    return reads.event_evidence(events, per, F.lit(True)).select("sample_sv_id", "test", "insertion_fragments", "chimeric_fragments", "rna_tier")


# Ledgers, verdicts, sets


@query("""
    with o as (select o_orderkey k, o_totalprice q, o_orderstatus s from orders) select k, q, s from (select *, row_number() over (order by q desc, k) n from o where not (q <= 150000)) where n <= 40""")
def named_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forty largest rows that a filter removes: a report of examples."""
    rows = derive(spark, sf_dir, "orders", "o_orderkey as k", "o_totalprice as q", "o_orderstatus as s")
    return funnel.named_losses(rows, F.col("q") <= 150_000, [F.desc("q"), "k"])


@query("""
    with o as (select o_orderpriority k, o_orderstatus = 'F' a, o_totalprice > 100000 b, o_orderkey % 3 <> 0 c from orders),
    n as (select k, count(*) n0, count(*) filter (a) n1, count(*) filter (a and b) r, count(*) filter (a and c) n3 from o group by k)
    select k o_orderpriority, 'order' grain, unnest([1, 2, 3]) place, unnest(['status', 'price', 'key']) "filter", unnest([true, false, true]) applied, unnest([n0, n1, n1]) entered, unnest([n1, r, n3]) passed, unnest([n0 - n1, n1 - r, n1 - n3]) removed from n""")
def reported_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger in which one filter is only reported: what it would remove stays for the next one."""
    rules = {"status": F.col("o_orderstatus") == "F", "price": F.col("o_totalprice") > 100000, "key": F.col("o_orderkey") % 3 != 0}
    return funnel.grain_ledger(table(spark, sf_dir, "orders"), rules, "order", ["o_orderpriority"], reported=["price"])


@query("""
    with s as (select user_id % 10 sample, count(*) n1, count(*) filter (event_type = 'view') n2, count(*) filter (event_type = 'view' and user_id % 10 <> 3) n3, count(*) filter (event_type = 'view' and user_id % 10 <> 3 and value > 10 and user_id % 10 < 8) n4 from events group by 1)
    select sample, n4 events, case when n3 = 0 then 'junctions' when n4 = 0 then 'events' end emptied_by,
           case when n3 = 0 then 'emptied before matching by junctions' when n4 = 0 then 'emptied before matching by events' else n4 || ' events survive' end verdict from s""")
def emptied_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sample the stage that left nothing, if one did."""
    steps = {"admitted": F.col("event_type") == "view", "junctions": F.col("sample") != 3, "events": (F.col("value") > 10) & (F.col("sample") < 8)}
    rows = derive(spark, sf_dir, "events", "user_id % 10 as sample", "event_type", "value")
    counts = funnel.ledger(rows, steps, ["sample"]).select("sample", "place", F.col("filter").alias("step"), F.col("passed").alias("n"))
    return funnel.emptied(counts, "sample", "events").select("sample", "events", "emptied_by", "verdict")


@query("""
    select 'orders' part, o_orderstatus status, null::varchar flag, count(*) n from orders group by 2 union all select 'lines', l_linestatus, l_returnflag, count(*) from lineitem group by 2, 3""")
def stacked_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"orders": derive(spark, sf_dir, "orders", "o_orderstatus as status"), "lines": derive(spark, sf_dir, "lineitem", "l_linestatus as status", "l_returnflag as flag")}
    return master.stack(parts, "part").groupBy("part", "status", "flag").agg(F.count("*").alias("n"))


@query("""
    with b as (select l_partkey p, count(distinct l_suppkey) filter (l_discount <= 0.02) n, max(l_tax) filter (l_discount <= 0.02) > 0.06 r from lineitem group by 1),
    e as (select distinct l_orderkey k, l_partkey p from lineitem), c as (select k, count(*) filter (n > 0) x, count(*) filter (n > 0 and r) y from e join b using (p) group by k)
    select unnest(['events', 'events_binding', 'events_robust']) step, unnest([count(*), count(*) filter (x > 0), count(*) filter (y > 0)]) n from c""")
def binding_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    found = lines.groupBy(F.col("l_partkey").alias("peptide")).agg(F.count_distinct(F.when(F.col("l_discount") <= 0.02, F.col("l_suppkey"))).alias("alleles_binding"), F.when(F.max(F.when(F.col("l_discount") <= 0.02, F.col("l_tax"))) > 0.06, "robust").alias("margin_bin"))
    events = lines.groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set("l_partkey").alias("peptides"))
    return binding.binding_funnel(binding.event_binding(events, found, "k"))


@query("""
    with u as (select p_partkey peptide, p_brand g, p_size z from part), m as (select p_brand g, max(p_retailprice) top from part group by 1) select u.peptide, m.top, u.z > 25 large, case when u.z > 25 then m.top end kept from u join m using (g)""")
def annotation_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichments in order: each states what it needs, adds and drops, and is checked before any of them runs."""
    u, m = derive(spark, sf_dir, "part", "p_partkey as peptide", "p_brand as g", "p_size as z"), derive(spark, sf_dir, "part", "p_brand as g", "p_retailprice").groupBy("g").agg(F.max("p_retailprice").alias("top"))
    steps = [
        universe.Step("top", lambda df: universe.enrich(df, m, "g"), ["g"], ["top"]),
        universe.Step("large", lambda df: df.withColumn("large", F.col("z") > 25).drop("z"), ["z"], ["large"], ["z"]),
        universe.Step("kept", lambda df: df.withColumn("kept", F.when(F.col("large"), F.col("top"))).drop("g"), ["large", "top"], ["kept"], ["g"]),
    ]
    return universe.annotate(u, steps)


@query("""
    with n as (select (select count(*) from orders) o, (select count(*) from lineitem) l, (select count(*) from lineitem where l_quantity < 49) k)
    select 'orders' dataset, 'current' status union all select 'lines', case when l = k then 'current' else 'stale' end from n union all select 'gone', 'not checkable'""")
def table_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints recorded of three tables against those of what is there now: one unchanged, one filtered, one gone."""
    prints = lambda name, df: audit.fingerprint(df).select(F.lit(name).alias("dataset"), "rows", "hash_sum")
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    recorded = prints("orders", orders).unionByName(prints("lines", lines)).unionByName(prints("gone", orders))
    return audit.freshness(recorded, prints("orders", orders.sort("o_custkey")).unionByName(prints("lines", lines.filter("l_quantity < 49"))))


# The whole run


_RUN_PEPTIDE = "if(o_orderkey % 7 = 0, 'AAAAAAAAA', substring(translate(md5(cast(o_orderkey % 200 as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, 9))"
_RUN_PART = "translate(md5(cast(p_partkey % 150 as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')"


@query("""
    with o as (select (o_orderkey % 5)::varchar sample, o_orderkey k, o_orderkey % 14 pon, o_orderkey % 9 vf, 120 + o_orderkey % 5 z, case when o_orderkey % 11 = 0 then 'GX' else 'G' || (o_orderkey % 200 % 50) end gene,
            case when o_orderkey % 7 = 0 then 'AAAAAAAAA' else translate(md5((o_orderkey % 200)::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')[1:9] end s from orders),
    c as (select distinct case when p_partkey % 150 = 0 then 'AAAAAAAAA' else translate(md5((p_partkey % 150)::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')[1:9] end s, 'G' || (p_partkey % 150 % 50) gene from part),
    f as (select distinct translate(md5((p_partkey % 150)::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')[i + 1 : i + 9] g from part, unnest(range(12)) r(i) where p_partkey % 150 in (5, 6, 7)),
    l as (select s, list_filter(string_split(s, ''), lambda x: x <> '') l from (select distinct s from o)),
    m as (select s, list_transform(list_distinct(l), lambda c: len(list_filter(l, lambda x: x = c)) / len(l)) q, list_max(list_transform(range(len(l) - 3), lambda i: (len(list_distinct(l[i + 1 : i + 4])) = 1)::int)) r from l),
    w as (select s, len(q) <= 3 or list_max(q) >= 0.5 or r > 0 or round(list_sum(list_transform(q, lambda x: -x * log2(x))), 12) < 2.0 low from m),
    e as (select o.*, count(distinct c.s) n from o join c on o.s = c.s and o.gene = c.gene join w on w.s = o.s where not low and o.s not in (select g from f) and pon < 12 group by all),
    p as (select l_orderkey k, max(l_discount * 0.1) af from lineitem where l_quantity > 45 group by 1),
    r as (select l_orderkey k, count(distinct l_linenumber) filter (l_quantity >= 20) cov, count(distinct l_linenumber) filter (l_quantity >= 20 and l_linenumber % 2 = 0) hit from lineitem group by 1),
    g as (select 'G' || (p_partkey % 50) gene, max(p_retailprice - 900) tpm from part where p_size > 30 group by 1),
    x as (select e.*, vf >= 5 hc, pon < 10 and coalesce(af < 0.003, true) private, case when sample <> '3' then coalesce(cov, 0) end cov, case when sample <> '3' then coalesce(hit, 0) end hit, tpm > 1 expressed from e left join p using (k) left join r using (k) left join g using (gene))
    select sample, k::varchar sample_sv_id, n n_peptides, hc high_confidence, private, cov min_coverage, hit junction_fragments,
           case when sample = '3' then 'NA' when hit >= 5 then 'STRONG' when hit >= 3 then 'SUGGESTIVE' when hit >= 1 then 'WEAK' else 'NONE' end rna_tier, coalesce(hit, 0) >= 1 rna_supported, expressed from x""")
def evidence_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evidence plan with every stage on: admission, pairing, matching, quality with a proteome, events, confidence,
    privacy by panel and population, reads, expression."""
    place = "o_orderkey * 10000"
    breakends = derive(
        spark, sf_dir, "orders", "cast(o_orderkey % 5 as string) as sample", "cast(o_orderkey as string) as id", "cast(null as string) as mateid", "'1' as chrom", f"{place} as pos", "'N' as ref", "'PASS' as filter", f"concat('N[chr1:', {place} + 121 + o_orderkey % 5, '[') as alt", "30.0D as qual",
        "'DEL' as svtype", "cast(o_orderkey % 14 as int) as pon_count", "o_orderkey as file_row", "cast(o_orderkey % 9 as int) as vf", "60 as segmapq", *[f"cast(null as int) as {c}" for c in ("sf", "df", "ref_reads")],
    )
    about = ["cast(o_orderkey % 5 as string) as sample", "cast(o_orderkey as string) as sample_sv_id"]
    made = derive(spark, sf_dir, "orders", *about, f"{_RUN_PEPTIDE} as neopeptide", where="o_orderkey % 14 < 12")
    annotation = derive(spark, sf_dir, "orders", *about, "if(o_orderkey % 11 = 0, 'GX', concat('G', o_orderkey % 200 % 50)) as gene1", *[f"cast(null as string) as {c}" for c in ("gene2", "transcript_id1", "transcript_id2")], "'DEL' as svtype")
    catalogue = derive(spark, sf_dir, "part", f"if(p_partkey % 150 = 0, 'AAAAAAAAA', substring({_RUN_PART}, 1, 9)) as ref_peptide", "concat('G', p_partkey % 150 % 50) as ref_gene", "'DEL' as ref_svtype").distinct()
    proteome = derive(spark, sf_dir, "part", f"substring({_RUN_PART}, 1, 20) as sequence", where="p_partkey % 150 in (5, 6, 7)")
    population = derive(spark, sf_dir, "lineitem", "'1' as chrom", "l_orderkey * 10000 as start", "l_orderkey * 10000 + 121 + l_orderkey % 5 as end", "l_discount * 0.1 as af", where="l_quantity > 45")
    alignments = derive(
        spark, sf_dir, "lineitem", "cast(l_orderkey % 5 as string) as sample", "'1' as chrom", "concat_ws('.', l_orderkey, l_linenumber) as qname", "l_orderkey * 10000 - 50 as start0", "cast(l_quantity as int) as mapq", "0 as flag",
        "concat('50M', 120 + l_orderkey % 5 + l_linenumber % 2 * 40, 'N50M') as cigar", "'ACGT' as seq", "cast(null as string) as sa_tag",
    )
    genes = derive(spark, sf_dir, "part", "concat('G', p_partkey % 50) as gene", "p_retailprice - 900 as tpm", where="p_size > 30")
    isoforms = derive(spark, sf_dir, "part", "p_name as transcript", "p_retailprice as tpm", where="p_size < 3")
    inputs = plan.Inputs(breakends, made, annotation, catalogue, proteome, population, alignments, genes, isoforms)
    found = plan.evidence(inputs, "somatic", 12, F.col("sample") != "3", True, DEFAULT.override(gnomad_max_af=0.003)).events
    return found.select("sample", "sample_sv_id", "n_peptides", "high_confidence", "private", "min_coverage", "junction_fragments", "rna_tier", "rna_supported", "expressed")
