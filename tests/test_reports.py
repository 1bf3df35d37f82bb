import datetime as dt

from tripmart.plans import reports

D = dt.datetime


def _loads(spark, rows):
    return spark.createDataFrame(rows, "load_id string, inserted_at timestamp_ntz, status string")


def test_latest_load_prefers_loaded(spark):
    loads = _loads(spark, [("a", D(2024, 1, 1), " LOADED "), ("b", D(2024, 1, 2), "failed")])
    assert reports.latest_load(loads).first().load_id == "a"


def test_latest_load_fallback_any(spark):
    loads = _loads(spark, [("a", D(2024, 1, 1), "0"), ("b", D(2024, 1, 2), "0")])
    r = reports.latest_load(loads).first()
    assert (r.load_id, r.status_v) == ("b", "0")


def test_latest_load_metrics_match_flag(spark):
    loads = _loads(spark, [("a", D(2024, 1, 1), "loaded")])
    trips = spark.createDataFrame([("a", "Credit", D(2024, 1, 1, 9), D(2024, 1, 1, 10), 1.5),
                                   ("a", "2", D(2024, 1, 2, 9), D(2024, 1, 3, 1), None)],
                                  "lid string, pay string, pu timestamp_ntz, do timestamp_ntz, tip double")
    r = reports.latest_load_metrics(trips, loads, "lid", "pay", "tip", "pu", "do").first()
    assert r.date_span_check == "DIFFER" and r.credit_card_pct == 50.0 and r.total_tip_amt == 1.5


def test_top_tip_nulls_last(spark):
    zones = spark.createDataFrame([(1, "B", "Z1"), (2, "B", "Z2")], "location_id int, borough string, zone string")
    trips = spark.createDataFrame([(1, 2, D(2024, 1, 5), None), (1, 1, D(2024, 1, 6), 3.0)],
                                  "pickup_location_id int, dropoff_location_id int, pickup_datetime timestamp_ntz, "
                                  "tip_amount double")
    r = reports.top_tip_dropoff_zone(trips, zones, "Z1", "2024-01-01", "2024-02-01").first()
    assert (r.dropoff_zone, r.tip_amount) == ("Z1", 3.0)


def test_latest_load_integer_status(spark):
    loads = spark.createDataFrame([("a", D(2024, 1, 1), 0), ("b", D(2024, 1, 2), 0)],
                                  "load_id string, inserted_at timestamp_ntz, status int")
    r = reports.latest_load(loads).first()
    assert (r.load_id, r.status_v) == ("b", "0")
    raw = reports.recent_loads(loads, 1).first()
    assert raw.status_raw == "0"
