"""The supplied tables presented as domain tables, in the DataFrame API.

Every view reads its whole source table; missing values come from CASE rules.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pathways.operators.crosswalk import best_conversion, title_type
from pathways.operators.exams import sdc_exams
from pathways.rules import CERT_NAMES
from pathways.session import reuse

from .names import PATTERNS, SNAPSHOT_SCORES, VENDOR_CERTS

STANDARD_CERTS = tuple(dict.fromkeys(name for name, *_ in CERT_NAMES))


def _int(c: Column) -> Column:
    return c.cast("int")


def _flag(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def _pick(values: tuple[str, ...], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), _int(at % len(values)))


def _jan10(year: Column, days: Column) -> Column:
    return F.date_add(F.make_date(year, F.lit(1), F.lit(10)), _int(days))


def _new_key(key: Column) -> Column:
    return F.when(key % 17 == 3, key + 10_000_000).otherwise(key)


_SCHEMAS: dict[str, StructType] = {}


class Bound:
    """Domain views over one folder of supplied tables, made when first used.

    The views carry the names of ``Inputs``, so plans take this object as is.
    """

    history = None

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        """A supplied table; the schema in the file footer is looked up once."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @property
    def inputs(self) -> Bound:
        return self

    @cached_property
    def cohort(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        kind = (
            F.when(segment == "BUILDING", 1)
            .when(segment == "MACHINERY", 11)
            .when(segment == "HOUSEHOLD", 12)
            .when(segment == "FURNITURE", 13)
            .otherwise(3)
        )
        return self.raw("customer").select(
            F.col("c_custkey").alias("student_key"),
            F.col("c_name").alias("first_name"),
            (2013 + F.col("c_nationkey") % 3).alias("cohortyear"),
            F.col("c_nationkey").alias("system"),
            _int(F.col("c_custkey") % 10).alias("school"),
            F.when(F.col("c_acctbal") < 0, "N").otherwise("Y").alias("included_in_cohort"),
            kind.alias("completion_type"),
        )

    @cached_property
    def isp(self) -> DataFrame:
        year = F.year("o_orderdate")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("isp_id"),
            F.col("o_custkey").alias("student_key"),
            F.col("o_orderstatus").alias("type_of_service"),
            F.col("o_orderpriority").alias("first_name"),
            year.alias("school_year"),
            (F.col("o_custkey") % 10).alias("school_bu_id"),
            F.when(F.col("o_orderpriority") == "1-URGENT", 1).alias("withdrawal_reason"),
            F.make_date(year, F.lit(1), F.lit(5)).alias("begin_date"),
            F.when(F.col("o_orderstatus") == "F", _jan10(year, F.lit(130))).alias("end_date"),
        )

    @cached_property
    def sca(self) -> DataFrame:
        # Joined once and written: the sections are drawn from it, and plans read it many times.
        year, line = F.col("school_year"), F.col("local_class_number")
        lines = self.raw("lineitem").select(
            F.col("l_orderkey").alias("isp_id"),
            F.col("l_partkey").alias("instructional_program_num"),
            F.col("l_linenumber").alias("local_class_number"),
            _int(F.col("l_linenumber") * 7 + 2 * F.col("l_quantity")).alias("begins"),
            (F.col("l_returnflag") != "N").alias("ends"),
        )
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("isp_id"),
            (F.col("o_custkey") % 10).alias("school_bu_id"),
            F.year("o_orderdate").alias("school_year"),
        )
        return reuse(
            lines.join(orders, "isp_id").select(
                "isp_id",
                "instructional_program_num",
                "local_class_number",
                "school_bu_id",
                "school_year",
                _jan10(year, F.col("begins")).alias("sca_begin_date"),
                F.when(F.col("ends"), _jan10(year, line * 7 + 110)).alias("sca_end_date"),
            )
        )

    @cached_property
    def cs(self) -> DataFrame:
        keys = ["instructional_program_num", "local_class_number", "school_bu_id", "school_year"]
        program, line, year = F.col(keys[0]), F.col(keys[1]), F.col(keys[3])
        return (
            self.sca.select(*keys)
            .distinct()
            .select(
                *keys,
                _int(program).alias("course_code"),
                _jan10(year, line * 7).alias("cs_begin_date"),
                F.when(program % 4 != 0, _jan10(year, line * 7 + 120)).alias("cs_end_date"),
                _flag(program % 7 == 0).alias("state_dual_credit"),
                _flag(program % 5 == 0).alias("local_dual_credit"),
                (program % 40).cast("string").alias("post_secondary_institution"),
            )
        )

    @cached_property
    def days(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("school_bu_id"),
            F.year("l_shipdate").alias("school_year"),
            F.col("l_shipdate").cast("date").alias("id_date"),
        )

    @cached_property
    def school(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("school_bu_id"),
            F.col("s_nationkey").alias("district_no"),
            _int(F.col("s_suppkey") % 7).alias("school_no"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        return self.days.withColumn("school_bu_id", F.col("school_bu_id") % 10).distinct()

    @cached_property
    def colleges(self) -> DataFrame:
        key = F.col("n_nationkey")
        kind = F.when(key % 3 == 0, " COMMUNITY COLLEGE").otherwise(" UNIVERSITY")
        return self.raw("nation").select(
            key.cast("string").alias("school_code"), F.concat("n_name", kind).alias("school_name")
        )

    @cached_property
    def system_names(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("system"), F.col("n_name").alias("system_name")
        )

    @cached_property
    def catalog(self) -> DataFrame:
        return self.raw("part").select(
            _int(F.col("p_partkey")).alias("course_code"), F.col("p_name").alias("course_title")
        )

    @cached_property
    def coded_catalog(self) -> DataFrame:
        """Catalog with codes in the range of the code list and typed titles."""
        kind = F.col("p_size") % 8
        prefix = (
            F.when(kind == 0, "AP ")
            .when(kind == 1, "CIE ")
            .when(kind == 2, "Dual Enrollment ")
            .when(kind == 3, "IB ")
            .when(kind == 4, "SDC ")
            .when(kind == 5, "IB MAP ")
            .otherwise("")
        )
        return self.raw("part").select(
            # Study hall, another course without credit, and courses without a code.
            F.when(F.col("p_partkey") % 23 == 1, 9305)
            .when(F.col("p_partkey") % 23 == 2, 3121)
            .when(F.col("p_partkey") % 23 != 3, _int(3000 + (F.col("p_partkey") * 7) % 3500))
            .alias("course_code"),
            F.concat(prefix, "p_name").alias("course_title"),
            F.col("p_size").alias("size"),
        )

    @cached_property
    def crosswalk(self) -> DataFrame:
        at = F.col("p_partkey") % 6
        exam = (
            F.when(at == 0, "CLICK")
            .when(at == 1, "VIEW")
            .when(at == 2, "PURCHASE")
            .when(at == 3, "SIGNUP DIPLOMA")
            .when(at == 4, "ERROR")
        )
        typed = self.raw("part").select(
            _int(F.col("p_partkey")).alias("course_code"),
            title_type("p_name", PATTERNS).alias("epso_type"),
            exam.alias("exam_name"),
        )
        return typed.where(F.col("epso_type").isNotNull() & (F.col("epso_type") != "DE"))

    @cached_property
    def exams(self) -> DataFrame:
        event, kind = F.col("event_id"), F.upper("event_type")
        vendor = F.when(event % 3 == 0, "AP_2018").when(event % 3 == 1, "IB_2018").otherwise("CLEP_2018")
        whole = F.floor("value")
        score = F.when(
            F.col("value") >= 1,
            F.when(event % 3 == 2, F.floor(F.col("value") * 2)).otherwise(whole % 6).cast("string"),
        )
        name = F.when(event % 11 != 0, kind)
        return self.raw("events").select(
            (F.col("user_id") * 10 + event % 10).alias("student_id"),
            vendor.alias("test_administration_cd"),
            F.concat(
                (2010 + event % 10).cast("string"), F.lit("-06 "), F.coalesce(name, F.lit("OTHER")),
                F.when(event % 7 == 0, " DIPLOMA").otherwise(""),
            ).alias("test_administration_desc"),
            F.col("props").alias("test_longname"),
            name.alias("sublevel1_shortname"),
            F.when(event % 13 != 0, kind).alias("sublevel2_shortname"),
            score.alias("assessment_result_number_score"),
        )

    @cached_property
    def sdc_files(self) -> tuple[tuple[DataFrame, dict[str, str]], ...]:
        """Three exam files with differing column names."""
        kind = F.col("event_type")

        def one(where: Column, names: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
            common = {
                "course_code": _int(F.col("event_id") % 400),
                "student_id": F.col("user_id") * 10 + F.col("event_id") % 10,
                "exam_score": F.when(F.col("value") >= 20, F.col("value")).cast("string"),
                "exam_cut_score": F.lit(50.0),
                "exam_result": F.when(F.col("value") >= 50, "P").otherwise("F"),
                "system": _int(F.col("user_id") % 25),
            }
            df = self.raw("events").where(where)
            return df.select(*[c.alias(names.get(n, n)) for n, c in common.items()]), names

        return (
            one(kind.isin("click", "view"), {"course_code": "sdc_course", "student_id": "student_no", "system": "district_id"}),
            one(kind.isin("purchase", "signup"), {"system": "district_number"}),
            one(~kind.isin("click", "view", "purchase", "signup"), {"system": "district"}),
        )

    @cached_property
    def sdc(self) -> DataFrame:
        return sdc_exams(*self.sdc_files)

    @cached_property
    def college_reported(self) -> DataFrame:
        return self.raw("events").select((F.col("user_id") * 10 + F.col("event_id") % 10).alias("student_id"))

    @cached_property
    def certs(self) -> DataFrame:
        part, line = F.col("p_partkey"), F.col("l_linenumber")
        vendor = _pick(VENDOR_CERTS + ("",), part)
        name = F.when(part % 29 != 0, F.when(vendor == "", F.col("p_name")).otherwise(vendor))
        return (
            self.raw("lineitem")
            .join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.when(F.col("l_tax") == 0.08, F.concat(F.lit("X"), "o_custkey"))
                .otherwise(F.col("o_custkey").cast("string"))
                .alias("student_id"),
                name.alias("cert_name"),
                F.col("p_brand").alias("source_file"),
                F.when(F.col("l_returnflag") == "R", "Fail")
                .when(F.col("l_returnflag") == "A", "Pass")
                .alias("pass_fail"),
                F.concat(
                    _int(2 * F.col("l_quantity")).cast("string"),
                    F.when(line % 2 == 0, ".9").otherwise(""),
                ).alias("test_score"),
                F.col("l_orderkey").alias("order_no"),
                line.alias("line_no"),
            )
        )

    @cached_property
    def conversion_text(self) -> DataFrame:
        part, at = F.col("p_partkey"), F.col("p_size") % 6
        text = (
            F.when(at == 0, "ONLY")
            .when(at == 1, "1 EPSO")
            .when(at == 2, "2 EPSO")
            .when(at == 3, "3 EPSO")
            .when(at == 4, "4 EPSO")
        )
        return self.raw("part").select(
            F.when(part % 3 == 0, F.col("p_name")).otherwise(_pick(STANDARD_CERTS, part)).alias("cert_name"),
            text.alias("credit_text"),
        )

    @cached_property
    def conversion(self) -> DataFrame:
        return best_conversion(self.conversion_text, "credit_text")

    @cached_property
    def approved(self) -> DataFrame:
        part, size = F.col("p_partkey"), F.col("p_size")
        vendor = _pick(VENDOR_CERTS + ("",), part)
        return (
            self.raw("part")
            .select(
                F.when(vendor == "", F.col("p_name")).otherwise(vendor).alias("cert_name"),
                F.col("p_brand").alias("source_file"),
                F.when(size % 7 != 0, _pick(STANDARD_CERTS, size)).alias("new_cert"),
                F.when(size % 4 == 1, "Pass")
                .when(size % 4 == 2, "Score of 70")
                .when(size % 4 == 3, "Other")
                .alias("pass_fail"),
                F.when(size % 5 == 0, "n").otherwise("x").alias("promoted"),
            )
            .groupBy("cert_name", "source_file")
            .agg(
                F.min("new_cert").alias("new_cert"),
                F.min("pass_fail").alias("pass_fail"),
                F.max("promoted").alias("promoted"),
            )
        )

    @cached_property
    def act(self) -> DataFrame:
        order = F.col("o_orderkey")

        def score(span: int) -> Column:
            return _int(order % span)

        return self.raw("orders").select(
            F.col("o_custkey").alias("student_key"),
            F.when(F.col("o_orderpriority") != "3-MEDIUM", score(23)).alias("act_composite_highest"),
            score(5).alias("act_math_highest"),
            score(7).alias("act_reading_highest"),
            score(3).alias("act_english_highest"),
            F.when(F.col("o_orderpriority") != "2-HIGH", score(11)).alias("act_science_highest"),
            F.when(F.col("o_orderstatus") != "P", 400 + score(700)).alias("sat_total"),
        )

    @cached_property
    def snapshot_prev(self) -> DataFrame:
        key = F.col("c_custkey")
        scores = [
            F.when(key % gap != 0, _int(base + (key * step) % span)).alias(name)
            for name, (gap, span, step, base) in SNAPSHOT_SCORES.items()
        ]
        return self.raw("customer").select(
            key.alias("student_key"),
            F.col("c_name").alias("first_name"),
            F.col("c_nationkey").alias("district_no"),
            _int(key % 10).alias("school_no"),
            F.when(F.col("c_acctbal") < 0, "N").otherwise("Y").alias("included_in_cohort"),
            *scores,
            _flag(key % 7 == 0).alias("readiness"),
            F.when(key % 13 != 0, "N").alias("is_approved"),
        )

    def _changed(self, composite: Column, placement: Column, ready: Column) -> DataFrame:
        return self.snapshot_prev.withColumns(
            {"act_composite": composite, "n_adv_placement": placement, "readiness": ready}
        )

    @cached_property
    def snapshot_cur(self) -> DataFrame:
        key = F.col("student_key")
        return self._changed(
            F.when(key % 10 == 0, 30).otherwise(F.col("act_composite")),
            F.when(key % 15 != 0, F.col("n_adv_placement")),
            F.when(key % 10 == 0, "Y").when(key % 21 == 0, "N").otherwise(F.col("readiness")),
        ).withColumn("student_key", _new_key(key))  # some students left, others came

    @cached_property
    def snapshot_orig(self) -> DataFrame:
        key = F.col("student_key")
        return self._changed(
            F.when(key % 20 == 0, 30).otherwise(F.col("act_composite")),
            F.when(key % 30 != 0, F.col("n_adv_placement")),
            F.col("readiness"),
        )

    @cached_property
    def docs(self) -> DataFrame:
        order = F.col("o_orderkey")
        return self.raw("orders").select(
            F.col("o_custkey").alias("student_key"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("doc-"), order)).alias(
                "save_as_filename"
            ),
            F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", 0).alias("status"),
            F.when(order % 5 == 0, "seen").alias("comments"),
        )

    @cached_property
    def file_history(self) -> DataFrame:
        """Earlier files of the student table with their times."""
        columns = ["student_key", "district_no", "n_cambridge", "n_adv_placement", "readiness"]
        files = ((self.snapshot_orig, "2019-01-01"), (self.snapshot_prev, "2019-02-01"), (self.snapshot_cur, "2019-03-01"))
        parts = [df.select(*columns, F.lit(day).cast("date").alias("file_time")) for df, day in files]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])
