"""Explicit schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


KINDS = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}


def fields(text: str) -> T.StructType:
    """``"student_key long, cohortyear int"`` as a StructType, without a session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])


COHORT = fields(
    "student_key long, first_name string, middle_name string, last_name string, "
    "race_ethnicity string, cohortyear int, el string, swd string, ed string, system int, "
    "school int, included_in_cohort string, completion_type int, revised_included_in_cohort string"
)
COHORT_HISTORY = fields(
    "student_key long, cohortyear int, completion_type int, included_in_cohort string"
)
SERVICE_PERIOD = fields(
    "isp_id long, student_key long, type_of_service string, first_name string, "
    "middle_name string, last_name string, date_of_birth date, school_year int, "
    "withdrawal_reason int, begin_date date, end_date date, school_bu_id long"
)
CLASS_ASSIGNMENT = fields(
    "isp_id long, instructional_program_num long, local_class_number int, school_bu_id long, "
    "school_year int, sca_begin_date date, sca_end_date date"
)
CLASS_SECTION = fields(
    "instructional_program_num long, local_class_number int, school_bu_id long, "
    "school_year int, course_code int, cs_begin_date date, cs_end_date date, "
    "state_dual_credit string, local_dual_credit string, dual_enrollment string, "
    "post_secondary_institution string"
)
CALENDAR_DAY = fields("school_bu_id long, school_year int, id_date date")
SCHOOL = fields("school_bu_id long, district_no int, school_no int")
COLLEGE = fields("school_code string, school_name string")
COURSE_CATALOG = fields("course_code int, course_title string")
CROSSWALK = fields("epso_type string, course_code int, course_title string, exam_name string")
# Two numeric and sixteen text columns; the unnamed ones are never read.
EXAMS = fields(
    "student_id double, test_year double, test_administration_cd string, "
    "test_administration_desc string, test_desc string, test_longname string, "
    "sublevel1_shortname string, sublevel2_shortname string, "
    "assessment_result_number_score string, text_10 string, text_11 string, text_12 string, "
    "text_13 string, text_14 string, text_15 string, text_16 string, text_17 string, text_18 string"
)
SDC_EXAMS = fields(
    "course_code int, student_id long, exam_score double, exam_cut_score double, "
    "exam_result string, system int"
)
COLLEGE_REPORTED = fields("student_id long")
CERT_RECORDS = fields(
    "student_id string, cert_name string, source_file string, pass_fail string, test_score string"
)
CERT_APPROVED = fields(
    "cert_name string, source_file string, new_cert string, pass_fail string, promoted string"
)
CERT_CONVERSION = fields("cert_name string, n_epso int")
ACT_SCORES = fields(
    "student_key long, act_composite_highest int, act_math_highest int, "
    "act_reading_highest int, act_english_highest int, act_science_highest int, sat_total int"
)
COUNTS = fields("student_key long, epso_type string, n_courses long")
SYSTEM_NAMES = fields("system int, system_name string")
DOCUMENTS = fields(
    "student_key long, save_as_filename string, modified_date timestamp, status int, "
    "comments string, reviewer_user_id string, reviewed_date timestamp"
)

LOOKUPS = {
    "course_catalog": COURSE_CATALOG,
    "crosswalk": CROSSWALK,
    "cert_conversion": CERT_CONVERSION,
    "cert_approved": CERT_APPROVED,
    "college_reported": COLLEGE_REPORTED,
    "system_names": SYSTEM_NAMES,
}

# One letter per column of the 46-column cohort file: c text, d number, T time.
COHORT_FILE_CODES = "dccccTccTdcccccccdcdddcddcTcccdccccccdcTcccdTc"
TYPE_CODES = {"c": T.StringType(), "d": T.DoubleType(), "T": T.TimestampType()}


def schema_from_codes(names: list[str], codes: str) -> T.StructType:
    if len(names) != len(codes):
        raise ValueError(f"{len(names)} columns but {len(codes)} type codes")
    return T.StructType([T.StructField(n, TYPE_CODES[c]) for n, c in zip(names, codes)])


def typed(names: list[str], known: T.StructType) -> T.StructType:
    """Schema of a file with these columns: known types, text for the rest."""
    types = {f.name: f.dataType for f in known}
    return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
