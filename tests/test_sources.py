import pytest

from waymark.sources import tables as T


def test_interval_table(spark, tmp_path):
    (tmp_path / "t.csv").write_text(" RID ,from,to,v\n a ,0.00004,1.23456,7\nb,2,2,8\nc,x,3,9\n")
    got = T.read_interval_table(spark, str(tmp_path / "t.csv"), "RID", "from", "to", numeric=["v"]).collect()
    assert [(r.RID, r.from_mp, r.to_mp, r.v) for r in got] == [("a", 0.0, 1.2346, 7.0)]


def test_feature_json(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"features": [{"attributes": {"A": 1, "B": "x"}}, {"attributes": {"A": 2, "B": null}}]}')
    got = T.read_feature_json(spark, str(tmp_path / "f.json"), {"A": "id"}).orderBy("id").collect()
    assert [(r.id, r.B) for r in got] == [(1, "x"), (2, None)]


def test_station_layouts(spark):
    a = spark.createDataFrame([("101.0", "33.5, -84.5", "1200"), ("102", "0.0, 0.1", None)], "`Station ID` string, Coordinate string, aadt string")
    b = spark.createDataFrame([("103", "33.1", "-84.1", "1,500", "3U : Principal", "E")], "`Station ID` string, Latitude string, Longitude string, AADT string, `Functional Class` string, `Statistics type` string")
    both = T.union_station_years([T.load_station_year(a, 2015, "2015", "s15"), T.load_station_year(b, 2022, "2022_2023", "s22")]).orderBy("tc_number").collect()
    assert [(r.year, r.tc_number, r.latitude, r.aadt, r.functional_class, r.statistics_type) for r in both] == [
        (2015, "101", 33.5, 1200, None, None), (2015, "102", None, None, None, None), (2022, "103", 33.1, 1500, 3, "Estimated"),
    ]
    with pytest.raises(ValueError, match="tried"):
        T.load_station_year(b.drop("AADT"), 2022, "2022_2023", "s")
    with pytest.raises(ValueError, match="unknown"):
        T.load_station_year(b, 2022, "1999", "s")
    with pytest.raises(ValueError):
        T.union_station_years([])
