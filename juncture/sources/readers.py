"""Sources: VCF, catalogues, FASTA, annotation and prediction tables; text is parsed once, here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..criteria import DEFAULT
from ..functions.variants import info, info_flag, normal_chrom, text_flag
from ..schemas import SCHEMAS, require_columns


def parse_breakends(lines: DataFrame) -> DataFrame:
    """Lines (sample, file_row, value) of SV VCFs to breakends; headers and lines of fewer than eight fields go."""
    part = F.split("value", "\t")
    rows = lines.filter(~F.startswith("value", F.lit("#"))).withColumn("f", part).filter(F.size("f") >= 8)
    text = F.get(F.col("f"), F.lit(7))
    return rows.select(
        "sample", normal_chrom(F.get(F.col("f"), F.lit(0))).alias("chrom"), F.get(F.col("f"), F.lit(1)).try_cast("long").alias("pos"), F.get(F.col("f"), F.lit(2)).alias("id"),
        F.get(F.col("f"), F.lit(3)).alias("ref"), F.get(F.col("f"), F.lit(4)).alias("alt"), F.get(F.col("f"), F.lit(5)).try_cast("double").alias("qual"), F.get(F.col("f"), F.lit(6)).alias("filter"),
        info(text, "SVTYPE").alias("svtype"), info(text, "MATEID").alias("mateid"),
        *[info(text, k, "int").alias(n) for k, n in (("PON_COUNT", "pon_count"), ("VF", "vf"), ("SF", "sf"), ("DF", "df"), ("REF", "ref_reads"), ("SEGMAPQ", "segmapq"))],
        info(text, "HOMSEQ").alias("homseq"), info_flag(text, "IMPRECISE").alias("imprecise"), "file_row", F.col("value").alias("line"),
    )


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(sample, file_row, value) of every line; the sample is the file name up to the first dot.

    file_row orders the lines of a file also where Spark reads it in several splits: place of the split, then of the line.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))
    return lines.select(file_stem().alias("sample"), place.alias("file_row"), "value")


def read_breakends(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Breakends of many VCFs as one table."""
    return parse_breakends(numbered_lines(spark, paths))


def record_facts(line: Column) -> dict[str, Column]:
    """chrom, pos and id of a VCF line; null for a header line."""
    f, record = F.split(line, "\t"), ~F.startswith(line, F.lit("#"))
    return {"chrom": F.when(record, normal_chrom(F.get(f, F.lit(0)))), "pos": F.when(record, F.get(f, F.lit(1)).try_cast("long")), "id": F.when(record, F.get(f, F.lit(2)))}


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All lines of VCFs (sample, file_row, line), header lines too, with chrom, pos and id of the others."""
    return numbered_lines(spark, paths).select("sample", "file_row", F.col("value").alias("line"), *[c.alias(n) for n, c in record_facts(F.col("value")).items()])


def file_stem() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1)


def separated(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV or TSV by suffix with a header; all text unless a schema is given."""
    sep = "," if ".csv" in path else "\t"
    reader = spark.read.option("header", True).option("sep", sep)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_catalogue(spark: SparkSession, path: str, names: dict[str, str]) -> DataFrame:
    """Peptide catalogue: configured columns renamed to ref_*, peptides trimmed and in upper case; others kept."""
    df = require_columns(separated(spark, path), list(names), "catalogue").withColumnsRenamed(names)
    return require_columns(df, ["ref_peptide"], "catalogue").withColumn("ref_peptide", F.upper(F.trim("ref_peptide")))


def read_pool(spark: SparkSession, path: str, names: dict[str, str]) -> DataFrame:
    df = require_columns(separated(spark, path), list(names), "pool").withColumnsRenamed(names)
    for c in ("pos1", "pos2"):
        df = df.withColumn(c, F.col(c).try_cast("double").cast("long"))
    return df.withColumns({c: normal_chrom(F.col(c)) for c in ("chrom1", "chrom2")})


def read_proteome(spark: SparkSession, path: str) -> DataFrame:
    """One row per protein of a FASTA file (protein, sequence); nothing runs over a protein's end."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    head = F.regexp_replace(F.substring_index("value", "\n", 1), "^>", "")
    body = F.when(F.instr("value", "\n") > 0, F.substring(F.col("value"), F.instr("value", "\n") + 1, F.length("value"))).otherwise("")
    return raw.select(head.alias("protein"), F.upper(F.regexp_replace(body, r"\s", "")).alias("sequence"))


def read_precomputed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Peptide or annotation table under either naming of the id and frame columns, checked against its contract."""
    df = separated(spark, path)
    for old, new in (("sv_id", "sample_sv_id"), ("frameshift", "frame_effect"), ("prefix", "sample")):
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    need = {"peptide": ["sample_sv_id", "neopeptide"], "annotation": ["sample_sv_id", "gene1", "gene2", "svtype"]}[kind]
    df = require_columns(df, need, kind)
    if "spans_junction" in df.columns:
        df = df.withColumn("spans_junction", text_flag(F.col("spans_junction")))
    return df


def parse_population_sites(lines: DataFrame) -> DataFrame:
    """gnomad_record rows from lines (value) of a sites VCF; rows without END or AF go."""
    rows = lines.filter(~F.startswith("value", F.lit("#"))).select(F.split("value", "\t").alias("f"))
    text = F.get(F.col("f"), F.lit(7))
    # What decides whether a row goes is made by a generator: else Spark searches the text for it twice.
    known = rows.select("f", F.inline_outer(F.array(F.struct(info(text, "END", "long").alias("end"), info(text, "AF", "double").alias("af")))))
    return known.filter("end is not null and af is not null").select(
        normal_chrom(F.get(F.col("f"), F.lit(0))).alias("chrom"), F.get(F.col("f"), F.lit(1)).try_cast("long").alias("start"), "end", "af",
        *[info(text, f"AF_{p}", "double").alias(f"af_{p}") for p in DEFAULT.populations],
    )


def read_expression(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(gene or transcript, tpm) with columns found by pattern."""
    df = separated(spark, path)
    names = {c.lower(): c for c in df.columns}
    found = next((names[c] for c in names if c in (f"{key}name", f"{key[:5]}name", key)), None)
    tpm = next((names[c] for c in names if "tpm" in c), None)
    if not found or not tpm:
        raise ValueError(f"no {key} or TPM column in {df.columns}")
    return df.select(F.col(found).alias(key), F.col(tpm).try_cast("double").alias("tpm"))


def read_calls(spark: SparkSession, path: str | None, kind: str) -> DataFrame:
    """A table of calls under its schema, chromosomes in one spelling, rows numbered in file order (call_row).

    No path means that the caller was not run: an empty table. A path that is not there raises, since "no calls" would
    be made up.
    """
    calls = separated(spark, path, SCHEMAS[kind]) if path else spark.createDataFrame([], SCHEMAS[kind])
    spelled = {c: normal_chrom(F.col(c)) for c in ("Chromosome", "ChrUp", "ChrDown") if c in calls.columns}
    return calls.withColumns(spelled).withColumn("call_row", F.monotonically_increasing_id())


def parse_bed(lines: DataFrame) -> DataFrame:
    """bed_region rows (and catalogue order) from lines (value, file_row), header or not."""
    f = F.split("value", "\t")
    rows = lines.select("file_row", normal_chrom(f[0]).alias("chrom"), F.get(f, F.lit(1)).try_cast("long").alias("start"), F.get(f, F.lit(2)).try_cast("long").alias("end"), F.get(f, F.lit(3)).alias("name"))
    return rows.filter("start is not null and end is not null")


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("sep", "\t").schema(SCHEMAS["panel_bedpe"]).csv(path)
    return df.withColumns({c: normal_chrom(F.col(c)) for c in ("chrom1", "chrom2")})


def passing_predictions(predictions: DataFrame, cuts: dict[str, float]) -> DataFrame:
    """Rows that pass every cut; the filter reaches a Parquet scan."""
    keep = F.lit(True)
    for c, most in cuts.items():
        keep = keep & (F.col(c) <= most)
    return predictions.filter(keep)


def read_per_patient(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """Files of one patient each as one table; the patient is the file name's stem."""
    return spark.read.option("header", True).option("sep", "\t").schema(schema).csv(glob).select("*", file_stem().alias("patient"))


def long_genotypes(wide: DataFrame, key: str) -> DataFrame:
    """(patient, locus, allele) of a table with a column per allele; empty alleles go."""
    loci = [c for c in wide.columns if c != key]
    return wide.unpivot([key], loci, "locus", "allele").withColumnRenamed(key, "patient").filter("allele is not null and allele <> ''")


def transcript_ranks(lines: DataFrame) -> DataFrame:
    """(transcript_id, gene, rank) of transcript lines of a GTF: 0 MANE, 1 canonical, 9 others."""
    rows = lines.filter(F.col("value").rlike(r"^[^#\t]*\t[^\t]*\ttranscript\t"))
    v = F.col("value")
    rank = F.when(v.rlike('tag "MANE_Select"'), 0).when(v.rlike('tag "Ensembl_canonical"'), 1).otherwise(9)
    return rows.select(F.regexp_extract(v, 'transcript_id "([^".]+)', 1).alias("transcript_id"), F.regexp_extract(v, 'gene_name "([^"]+)', 1).alias("gene"), rank.alias("rank"))


def collect_typing(results: DataFrame, quality: DataFrame) -> DataFrame:
    """Typing results with their QC status; a sample without QC has null."""
    return results.join(quality.select("sample", "qc_status"), "sample", "left")
