"""The tables a run reads, and the choices that differ between runs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..rules import TITLE_PATTERNS

COURSE_DOMAINS = ("ap", "cie", "de", "ib", "ldc")


@dataclass(frozen=True)
class Inputs:
    """Source tables by role. Only those a plan reads need to be given."""

    cohort: DataFrame
    isp: DataFrame | None = None
    sca: DataFrame | None = None
    cs: DataFrame | None = None
    calendar: DataFrame | None = None
    catalog: DataFrame | None = None
    crosswalk: DataFrame | None = None
    exams: DataFrame | None = None
    sdc: DataFrame | None = None
    college_reported: DataFrame | None = None
    certs: DataFrame | None = None
    approved: DataFrame | None = None
    conversion: DataFrame | None = None
    act: DataFrame | None = None
    history: DataFrame | None = None


@dataclass(frozen=True)
class Rules:
    """*graduates* or *whole* cohort, with the rules that go with each.

    ``fill`` is the end-date rule per domain, ``merge_de`` how dual enrollment
    combines with the colleges' own count, ``cohort_year`` the year of the pull.
    A domain's courses are those whose title has its pattern, or the codes in
    ``course_lists`` where given.
    """

    mode: str = "graduates"
    cohort_year: int | None = None
    fill: dict[str, str] = field(
        default_factory=lambda: {
            "ap": "global",
            "cie": "global",
            "ldc": "global",
            "ib": "by_year_course",
            "de": "by_year_course",
        }
    )
    merge_de: str = "max"
    legacy_bundle: bool = False
    limit_cie_names: bool = True
    patterns: dict[str, str] = field(default_factory=lambda: dict(TITLE_PATTERNS))
    course_lists: dict[str, tuple[int, ...]] = field(default_factory=dict)


def graduates(**choices) -> Rules:
    return Rules(**choices)


def whole_cohort(**choices) -> Rules:
    """Whole-cohort rules: section ends filled from the assignment only, dual
    enrollment counts added up, course-to-exam names not limited by type."""
    base = {
        "mode": "whole",
        "fill": dict.fromkeys(COURSE_DOMAINS, "class_only"),
        "merge_de": "sum",
        "limit_cie_names": False,
    }
    return Rules(**{**base, **choices})
