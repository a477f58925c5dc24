"""Time the two forms of the instructional-day count: array lookup and exploded join."""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from check import session
from pathways.operators import enrollment as E
from workload.tables import Bound

KEYS = ["isp_id", "student_key", "course_code", "sca_begin_date", "sca_end_date", "cs_begin_date", "cs_end_date"]


def by_array(b: Bound) -> DataFrame:
    enr = E.course_enrollments(b.isp, b.sca, b.cs)
    days = E.count_days(E.attach_calendar(enr, E.calendar_index(b.calendar)), open_ends=False)
    return days.groupBy(*KEYS).agg(F.sum(E.COURSE_DAYS), F.sum(E.ENROLLED_DAYS))


def by_join(b: Bound) -> DataFrame:
    enr = E.course_enrollments(b.isp, b.sca, b.cs)
    calendar = b.calendar.withColumnRenamed("school_year", "isp_school_year")
    joined = enr.join(calendar, ["school_bu_id", "isp_school_year"], "left")

    def inside(begin: str, end) -> DataFrame:
        return F.count_if(F.col("id_date").between(F.col(begin), end))

    section_end = F.coalesce("cs_end_date", "sca_end_date")
    return joined.groupBy(*KEYS).agg(
        inside("cs_begin_date", section_end), inside("sca_begin_date", F.col("sca_end_date"))
    )


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    for form in (by_array, by_join):
        times = []
        for _ in range(4):
            start = time.perf_counter()
            form(Bound(spark, folder)).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        print(form.__name__, round(statistics.median(times[1:]), 2), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
