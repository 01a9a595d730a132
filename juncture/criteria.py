"""Thresholds as one immutable value that every operator takes explicitly."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields, replace


@dataclass(frozen=True)
class Criteria:
    """Fixed values of the method; change them with `override`, which refuses unknown names."""

    somatic_filters: tuple[str, ...] = ("PASS",)
    somatic_filters_with_panel: tuple[str, ...] = ("PASS", "PON")
    pon_max: int = 10
    gnomad_max_af: float = 0.001
    common_af: float = 0.01
    reciprocal_overlap: float = 0.5
    populations: tuple[str, ...] = ("afr", "ami", "amr", "asj", "eas", "fin", "mid", "nfe", "sas")
    peptide_lengths: tuple[int, ...] = (8, 9, 10, 11)
    min_entropy: float = 2.0
    max_residue_share: float = 0.5
    max_run: int = 4
    min_residues: int = 3
    hc_segmapq: int = 30
    hc_vf: int = 5
    hc_qual: float = 20
    hc_size: int = 100
    tpm_gradient: tuple[float, ...] = (0.0, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 50.0)
    tpm_expressed: float = 1.0
    splice_window: int = 100
    strong_reads: int = 5
    suggestive_reads: int = 3
    min_gap: int = 20
    gap_size_tolerance: int = 10
    gap_position_tolerance: int = 15
    partner_tolerance: int = 1000
    coverage_window: int = 200
    min_softclip: int = 10
    min_insert: int = 10
    min_mapq: int = 20
    permutations: int = 1000
    windows_kb: tuple[int, ...] = (1, 10, 50, 100)
    attribution_tolerance: int = 20

    def override(self, **values: object) -> Criteria:
        unknown = sorted(set(values) - {f.name for f in fields(self)})
        if unknown:
            raise ValueError(f"unknown criteria: {', '.join(unknown)}")
        return replace(self, **values)

    def manifest(self) -> dict[str, object]:
        """All thresholds, with the names of those that differ from the defaults under `overridden`."""
        base = Criteria()
        return asdict(self) | {"overridden": [f.name for f in fields(self) if getattr(self, f.name) != getattr(base, f.name)]}


DEFAULT = Criteria()
