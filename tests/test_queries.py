"""Registered queries against their reference SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, connection
from workload.all_queries import QUERIES

# One of each kind; ``--all-queries`` runs every one.
USUAL = [
    "cohort_graduates", "best_act_scores", "epso_crosswalk", "course_enrollments", "enrollment_calendar", "instructional_day_counts",
    "segment_days", "attended_half", "group_sizes_on_rows", "repeated_course_segments", "course_exam_scores_ap", "exam_only_credit",
    "courses_against_exams", "merged_counts_max", "counts_pivoted", "cert_credit", "cert_credit_by_record", "vendor_extract_read",
    "snapshot_history_read", "csv_nulls_empty", "student_report", "whole_cohort_file", "final_report", "changed_values",
    "count_difference_distribution", "corrections_applied", "pathway_breakdown", "weekly_status", "proposed_comments", "status_flips",
    "reconciled_catalogs", "courses_repeated_apart", "enrollment_spells_by_school_year", "enrollment_calendar_salted", "changed_rows_by_digest",
    "service_periods_numbered", "pathway_lattice_from_bitmaps", "appeals_with_status_in_force",
]


def pytest_generate_tests(metafunc):
    if "name" in metafunc.fixturenames:
        every = metafunc.config.getoption("--all-queries")
        metafunc.parametrize("name", list(QUERIES) if every else USUAL)


@pytest.fixture(scope="module")
def con(small):
    return connection(small)


def test_matches_reference_sql(spark, con, small, name):
    ok, note = compare(name, spark, con, small)
    assert ok, note


def test_every_query_has_reference_sql():
    assert all(q.sql for q in QUERIES.values())


def test_every_operator_of_the_inventory_is_registered():
    covered = {c for q in QUERIES.values() for c in q.covers}
    expected = (
        {f"S{n}" for n in range(1, 11)} | {f"F{n}" for n in range(1, 26)} | {f"J{n}" for n in range(1, 23)}
        | {f"A{n}" for n in range(1, 24)} | {f"W{n}" for n in range(1, 7)} | {f"O{n}" for n in range(1, 4)}
        | {f"U{n}" for n in range(1, 5)} | {f"D{n}" for n in range(1, 13)} | {f"X{n}" for n in range(1, 4)}
        | {f"R{n}" for n in range(1, 13)}
    )
    assert expected - covered == set()
