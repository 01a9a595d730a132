"""Declared schemas of the tables; column names are the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame

SCHEMAS = {
    "breakend": "sample string, chrom string, pos long, id string, ref string, alt string, qual double, filter string, svtype string, mateid string, pon_count int, vf int, sf int, df int, ref_reads int, segmapq int, homseq string, imprecise boolean, file_row long, line string",
    "peptide": "sample string, sample_sv_id string, chrom1 string, pos1 long, gene1 string, chrom2 string, pos2 long, gene2 string, svtype string, frame_effect string, junction_nt int, spans_junction boolean, neopeptide string, pep_length int",
    "annotation": "sample string, sample_sv_id string, chrom1 string, pos1 long, gene1 string, transcript_id1 string, strand1 string, chrom2 string, pos2 long, gene2 string, transcript_id2 string, strand2 string, svtype string",
    "catalogue": "ref_peptide string, ref_gene string, ref_svtype string",
    "pool": "ref_peptide string, chrom1 string, pos1 long, chrom2 string, pos2 long, svtype string, gene1 string",
    "proteome": "protein string, sequence string",
    "gene_expression": "gene string, tpm double",
    "isoform_expression": "transcript string, tpm double",
    "alt_splice_junction": "Chromosome string, SjStart long, SjEnd long, FragCount int, Type string",
    "fusion_call": "FusionId string, ChrUp string, PosUp long, ChrDown string, TotalFragments int",
    "retained_intron": "GeneName string",
    "alignment": "sample string, assay string, qname string, chrom string, start0 long, mapq int, flag int, cigar string, seq string, sa_tag string",
    "gnomad_record": "chrom string, start long, end long, af double, af_afr double, af_ami double, af_amr double, af_asj double, af_eas double, af_fin double, af_mid double, af_nfe double, af_sas double",
    "panel_bedpe": "chrom1 string, start1 long, end1 long, chrom2 string, start2 long, end2 long, name string, count int, strand1 string, strand2 string",
    "bed_region": "chrom string, start long, end long, name string",
    "prediction": "allele string, peptide string, score_EL double, rank_EL double, score_BA double, rank_BA double, affinity_nM double",
    "patient_peptide": "patient string, neoantigen string, gene1 string, gene2 string, svtype string, frame_effect string",
    "genotype": "patient string, allele string",
    "sample": "name string, vcf_kind string, parent string, has_rna boolean, has_expression boolean",
    "branch": "name string, pon_max int, gnomad_max_af double, admit_panel_filtered boolean, pon_in_privacy boolean",
    "transcript": "transcript_id string, gene string, chrom string, strand string, start long, end long, exons array<struct<start:long,end:long>>, cds_blocks array<struct<start:long,end:long>>, cds string, rank int",
}


def require_columns(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    """df itself, or one error that names every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def optional_notes(df: DataFrame, features: dict[str, str]) -> list[str]:
    """Notes on features that are off because their column is absent (column to feature)."""
    return [f"{feature}: no column {c}" for c, feature in features.items() if c not in df.columns]
