from pyspark.sql import functions as F

from waymark.functions import classify as R
from waymark.functions import scalars as P
from waymark.operators import checks, intervals, reports, service


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_scalars(spark):
    got = one(
        spark,
        F.struct(
            P.normalize_road_name(F.lit("Old (SR 3) North Street*, SCHOOL ZONE / Main")).alias("road"),
            P.parse_lat_long(F.lit("33.5, x")).alias("bad"),
            P.round_milepoint(F.lit(0.00005)).alias("mp"),
            P.unique_id(F.lit("R"), F.lit(1.0), F.lit(None).cast("double")).alias("uid"),
            P.decode_label(F.lit("7"), {"07": "x"}, 2).alias("label"),
            P.route_number_of_name(F.lit("US HIGHWAY 27")).alias("n"),
            P.corridor_prefixes(F.lit("SR 1 / US 27 BUSINESS")).alias("c"),
            P.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("d"),
        ),
    )
    assert got.road == "OLD N ST" and got.bad.lat is None and got.mp == 0.0 and got.uid == "R_1.0000_NA" and got.label == "x" and got.n == 27
    assert got.c == ["SR-1", "US-27 BUS"] and abs(got.d - 111194.93) < 0.01


def test_highway_names(spark):
    rows = [("AAAINC", 40, 1, 1, "BU", "U.S. Route", None, None, None, "27", None), ("AAADEC", 40, 1, 1, "BU", "U.S. Route", None, None, None, None, "US 29"), ("BBBINC", 402, 1, 1, "00", "Interstate", None, None, None, None, None), ("CCCINC", 9, 2, 1, "00", "State Route", None, None, None, None, None), ("DDDINC", 5, 1, 2, "00", "Local/Other", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "ROUTE_ID string, BASE_ROUTE_NUMBER int, FUNCTION_TYPE int, SYSTEM_CODE int, ROUTE_SUFFIX string, ROUTE_FAMILY string, SIGNED_ROUTE_FAMILY_PRIMARY string, SIGNED_ROUTE_VERIFY_SOURCE string, HPMS_ROUTE_SIGNING string, HPMS_ROUTE_NUMBER string, HPMS_ROUTE_NAME string")
    got = {r.ROUTE_ID: (r.ROUTE_TYPE_GDOT, r.HWY_NAME) for r in R.with_highway_names(df).collect()}
    assert got == {"AAAINC": ("BU", "US-27 BUS"), "AAADEC": ("BU", "US-27 BUS"), "BBBINC": ("I", "I-20"), "CCCINC": ("RP", "RAMP"), "DDDINC": ("CR", "CR-5")}


def test_families(spark):
    got = one(spark, F.struct(R.merge_hpms_family(F.lit("State Route"), F.array(F.lit("State Route")), F.lit("2")).alias("up"), R.merge_hpms_family(F.lit("Interstate"), F.array(F.lit("Interstate")), F.lit("4")).alias("down"), R.promote_family(F.lit("State Route"), F.lit("Interstate")).alias("p"), R.signed_family_slots(F.array(F.lit("State Route"), F.lit("Interstate"))).alias("s")))
    assert got.up == ["Interstate", "State Route"] and got.down == ["Interstate", "State Route"] and got.p.family == "Interstate"
    assert (got.s.first, got.s.second, got.s.us_route) == ("Interstate", "State Route", False)


def test_filters_and_themes(spark):
    df = spark.createDataFrame([(1, "Fulton, Cobb", 5, 10.0), (2, "DeKalb", None, None), (3, None, 6, 30.0)], "DISTRICT int, county_all string, CITY_ID int, v double")
    f = service.Filters({"DISTRICT": (1, 2)}, counties=("COBB",))
    assert [r.DISTRICT for r in df.where(f.predicate()).collect()] == [1]
    assert df.where(service.Filters(cities=(5,), include_unincorporated=True).predicate()).count() == 2
    assert service.resolve_filters({"families": ["us", "State"], "counties": ["67"], "district": ["2.0", "1"]}, {"067": "Cobb"}) == service.Filters({"district": ("1", "2")}, ("Cobb",), ("State Route", "U.S. Route"))
    bins = spark.createDataFrame([("low", 0.0, 10.0), ("mid", 10.0, 20.0)], "label string, min_value double, max_value double")
    got = {r.label: (r.rows, r.passing) for r in service.legend_presence(df, "v", bins, service.theme_filter(F.col("v"), low=20, no_data=False)).collect()}
    assert got == {"mid": (1, 0), "other": (1, 1), "no data": (1, 0)}


def test_checks_and_scores(spark):
    df = spark.createDataFrame([("Cobb, Fulton", "Cobb", 1), ("Fulton, Fulton, X", "Cobb", 3)], "listed string, lead string, v int")
    got = {r.name: r.passed for r in checks.county_list(df, "listed", ["Cobb", "Fulton"], "lead").collect()}
    assert got == {"county_list_blank": True, "county_list_repeated": False, "county_list_unknown": False, "county_list_leading": False}
    assert {r.v: r.score for r in reports.min_max_score(df, {"v": 1.0}).collect()} == {1: 0.0, 3: 1.0}


def test_words_and_short_types_of_functions(spark):
    told = one(spark, R.route_family(F.lit("2121200040100INC")))
    assert (told.detail, told.source) == ("Public Road Ramp", "function_type_2")
    assert one(spark, R.route_family(F.lit("R121100040100INC"))).detail.endswith("Roundabout")
    none = F.lit(None).cast("string")
    assert one(spark, R.route_type(F.lit("2"), none, none, none)) == "RP"


def test_details_are_plain_numbers(spark):
    df = spark.sql("SELECT CAST(91802586 AS DOUBLE) AS miles UNION ALL SELECT CAST(0.125 AS DOUBLE)")
    told = checks.total_within(df, "t", "miles", 9e7, 0.5).first()
    assert (told.passed, told.detail) == (True, "91802586.125")
    assert checks.total_within(df.where("miles > 1"), "t", "miles", 9e7, 0.5).first().detail == "91802586.0"
    assert checks.total_within(df.where("miles < 1"), "t", "miles", 9e7, 0.5).first().detail == "0.125"


def test_ties_of_references_go_by_the_given_order(spark):
    left = spark.createDataFrame([("R", 0.0, 4.0, 5)], "ROUTE_ID string, from_mp double, to_mp double, AADT long")
    refs = spark.createDataFrame([("R", 1.0, 3.0, 2, 10), ("R", 1.0, 3.0, 1, 99)], "ROUTE_ID string, from_mp double, to_mp double, seq int, aadt long")
    assert intervals.enrich(left, refs, "ROUTE_ID", {"told": "aadt"}, {}, "hpms", order=["seq"]).first().told == 99
    assert intervals.enrich(left, refs, "ROUTE_ID", {"told": "aadt"}, {}, "hpms").first().told == 10
