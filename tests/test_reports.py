from waymark.catalog import QUERIES


def test_coverage_report_works_its_rows_off_once(spark):
    """The headline, the rows and the routes read what was worked off once, not the tables."""
    plan = QUERIES["coverage_report"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 0
