"""End to end on a small fixture: one row per failure mode, exact expected values."""

import pytest
from pyspark.sql import functions as F

from juncture.criteria import DEFAULT
from juncture.operators import admission, confidence, cross, reads
from juncture.plans.pipeline import Inputs, evidence
from juncture.schemas import SCHEMAS, require_columns
from juncture.sources.readers import parse_breakends
from juncture.sources.writers import admitted_lines

PAIRS = [
    ("sv1", "DEL", "1", 1000000, "1", 1000221, 80, "VF=20;SF=15;SEGMAPQ=60", ""),
    ("sv2", "DEL", "1", 2000000, "1", 2000003, 70, "VF=12;SF=9;SEGMAPQ=55", "CCGGAAGCAGGAGGGCTGGGG"),
    ("sv3", "BND", "1", 3000000, "7", 5000000, 65, "VF=8;SF=6;SEGMAPQ=45", ""),
    ("sv4", "DEL", "1", 4000000, "1", 4000015, 90, "VF=30;SF=25;SEGMAPQ=60;PON_COUNT=2500", ""),
    ("sv5", "DUP", "1", 4000015, "1", 4000900, 55, "VF=6;SF=4;SEGMAPQ=40", ""),
]


@pytest.fixture(scope="module")
def vcf(spark):
    lines = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO", "short\tline"]
    for name, kind, c1, p1, c2, p2, qual, info, ins in PAIRS:
        for side, (c, p, alt) in enumerate(((c1, p1, f"N{ins}[chr{c2}:{p2}["), (c2, p2, f"]chr{c1}:{p1}]{ins}N"))):
            me, mate = f"{name}{'ab'[side]}", f"{name}{'ba'[side]}"
            lines.append(f"chr{c}\t{p}\t{me}\tN\t{alt}\t{qual}\tPASS\tSVTYPE={kind};MATEID={mate};{info}")
    return parse_breakends(spark.createDataFrame([("mini", k, v) for k, v in enumerate(lines)], "sample string, file_row long, value string"))


@pytest.fixture(scope="module")
def inputs(spark, vcf):
    peptides = spark.createDataFrame(
        [("mini", "sv1a", "MATCHPEPT", True), ("mini", "sv1a", "NOTINCAT1", False), ("mini", "sv2a", "FFFFFFFFF", True), ("mini", "sv3a", "OTHERPEPT", True)],
        "sample string, sample_sv_id string, neopeptide string, spans_junction boolean",
    )
    annotation = spark.createDataFrame(
        [("mini", "sv1a", "GENEA", "GENEA", "DEL"), ("mini", "sv2a", "GENEB", "GENEB", "DEL"), ("mini", "sv3a", "GENEC", "GENED", "BND")],
        "sample string, sample_sv_id string, gene1 string, gene2 string, svtype string",
    )
    catalogue = spark.createDataFrame([("MATCHPEPT", "GENEA", "DEL"), ("FFFFFFFFF", "GENEB", "DEL"), ("OTHERPEPT", "GENEZ", "DUP")], SCHEMAS["catalogue"])
    return Inputs(vcf, peptides, annotation, catalogue)


def test_admission_and_junctions(vcf):
    assert vcf.count() == 10
    admitted = admission.admit(vcf, "germline", 10)
    assert admitted.count() == 8
    junctions = {r.sample_sv_id: r for r in admission.pair_junctions(admitted).collect()}
    assert set(junctions) == {"sv1a", "sv2a", "sv3a", "sv5a"}
    assert junctions["sv1a"].event_size == 220
    assert junctions["sv2a"].insert_len == 21 and junctions["sv2a"].insert_seq == PAIRS[1][-1]
    assert junctions["sv3a"].event_size is None
    steps = {r.step: r.n for r in admission.attrition(vcf, admission.admission_rules("germline", 10, False)).collect()}
    assert steps == {"records": 10, "filter": 10, "paired": 10, "panel": 8}


def test_admitted_lines_go_by_id(vcf):
    kept = {r.id for r in admitted_lines(vcf, admission.admit(vcf, "germline", 10)).collect()}
    assert len(kept) == 8 and "sv5a" in kept and not kept & {"sv4a", "sv4b"}


def test_matches_quality_and_events(inputs):
    out = evidence(inputs, "germline", 10)
    matches = {r.ref_peptide: r for r in out.matches.collect()}
    assert len(matches) == 3
    assert {p for p, r in matches.items() if r.gene_concordant is False} == {"OTHERPEPT"}
    assert {p for p, r in matches.items() if r.low_complexity} == {"FFFFFFFFF"}
    events = out.events.collect()
    assert [(e.sample_sv_id, e.peptides, e.genes) for e in events] == [("sv1a", ["MATCHPEPT"], ["GENEA"])]
    assert events[0].high_confidence and events[0].private and "not evaluated" in events[0].privacy_note
    assert out.every.count() == 4


@pytest.mark.parametrize(("case", "test"), [(("DEL", "1", "1", 220, 0), "sizegap"), (("DEL", "1", "1", 3, 21), "insertion"), (("BND", "1", "7", None, 0), "chimeric"), (("DEL", "1", "1", 3, 0), "none"), (("INV", "1", "1", None, None), "none")])
def test_choice_of_test(spark, case, test):
    df = spark.createDataFrame([case], "t string, c1 string, c2 string, size int, ins int")
    assert df.select(reads.select_test(*(F.col(c) for c in df.columns))[0]).first()[0] == test


@pytest.mark.parametrize(("n", "testable", "has", "tier"), [(5, True, True, "STRONG"), (3, True, True, "SUGGESTIVE"), (1, True, True, "WEAK"), (0, True, True, "NONE"), (9, False, True, "UNTESTABLE"), (9, True, False, "NA")])
def test_tiers(spark, n, testable, has, tier):
    assert spark.range(1).select(reads.tier(F.lit(n), F.lit(testable), F.lit(has))).first()[0] == tier


@pytest.mark.parametrize(("pon", "af", "private"), [(1, 0.0001, True), (1, 0.287, False), (3513, 0.0, False), (None, None, True)])
def test_privacy(spark, pon, af, private):
    events = spark.createDataFrame([("e", "1", "1", 500, pon)], "k string, chrom1 string, chrom2 string, event_size int, pon_count int")
    frequency = spark.createDataFrame([("e", af)] if af is not None else [], "k string, popmax double")
    assert confidence.with_privacy(events, frequency, "k").first().private is private
    free = confidence.with_privacy(events, frequency, "k", pon_in_privacy=False).first()
    assert free.private is (af is None or af < 0.001) and free.pass_pon is (pon is None or pon < 10)


def test_contracts(spark):
    with pytest.raises(ValueError, match="lacks columns: b, c"):
        require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b", "c"], "table")
    with pytest.raises(ValueError, match="unknown criteria"):
        DEFAULT.override(pon_maximum=3)
    assert DEFAULT.override(pon_max=3).manifest()["overridden"] == ["pon_max"]


def test_somatic_filters(spark):
    rows = spark.createDataFrame([("PASS", "m"), ("PON", "m"), ("INFERRED", "m")], "filter string, mateid string").withColumns({"alt": F.lit("N"), "pon_count": F.lit(None).cast("int")})
    assert admission.admit(rows, "somatic").count() == 1
    assert admission.admit(rows, "somatic", admit_panel_filtered=True).count() == 2


def test_duplicate_annotation_does_not_fan_out(inputs):
    doubled = inputs.annotation.union(inputs.annotation)
    assert cross.level1_identical(inputs.peptides, doubled, inputs.catalogue).count() == 3
