"""Work that must not grow with repeated rows, or be done again for each part of a result."""

import time

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from waymark.functions import classify as R
from waymark.operators import reports
from waymark.operators import verification as V


def test_equal_segments_meet_equal_records_once(spark):
    segments = spark.range(20_000).select(F.col("id").alias("unique_id"), F.lit("1121100040300INC").alias("ROUTE_ID"), F.lit("1").alias("SYSTEM_CODE"), F.lit(0.0).alias("from_mp"), F.when(F.col("id") % 2 == 0, 4.0).alias("to_mp"))
    records = spark.range(20_000).select(F.lit("1121100040300").alias("RCLINK"), F.when(F.col("id") % 5 != 0, 1.0).alias("from_mp"), F.lit(9.0).alias("to_mp"), F.concat(F.lit("L"), (F.col("id") % 3).cast("string")).alias("label"), F.lit(None).cast("string").alias("state_label"))
    began = time.time()
    got = V.match_reference(segments, records).groupBy("label", "state_label", "interval").count().collect()
    assert [(r.label, r.state_label, r.interval, r["count"]) for r in got] == [("L0", None, True, 20_000)]
    assert time.time() - began < 60  # 4e8 pairs take far longer


def test_report_reads_its_rows_a_few_times(spark):
    rows = 500
    read = spark.sparkContext.accumulator(0)

    @F.udf(LongType())
    def counted(x):
        read.add(1)
        return x

    k = counted.asNondeterministic()(F.col("id")).alias("k")
    s = spark.range(rows).select(k).select(F.col("k").alias("unique_id"), (F.col("k") * 31).alias("AADT_2024_OFFICIAL"), (F.col("k") * 50).alias("AADT_2024_HPMS"), F.col("k").alias("AADT"), (F.col("k") % 7).alias("FUNCTIONAL_CLASS"), F.lit("x").alias("FUNCTIONAL_CLASS_LABEL"), F.lit("1").alias("SYSTEM_CODE"), F.lit(1.5).alias("segment_length_mi"), F.lit("high").alias("AADT_2024_CONFIDENCE"), F.lit("Actual").alias("AADT_2024_STATS_TYPE"), F.lit("hpms").alias("AADT_2024_SOURCE"))
    s = s.withColumn("AADT_2024_SOURCE_AGREEMENT", R.source_agreement(F.col("AADT_2024_OFFICIAL"), F.col("AADT_2024_HPMS")))
    got = {(r.section, r.member, r.item): r.value for r in reports.agreement_report(s).collect()}
    assert got["agreement", "both_disagree", "rows"] == rows - 11 and len([k for k in got if k[0] == "top"]) == 20
    # the counts, and what is kept of the rows that disagree (a checkpoint works its last stage off twice)
    assert read.value <= 3 * rows
