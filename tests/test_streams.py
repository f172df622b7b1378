import datetime as dt

from pyspark.sql import functions as F

from opsreports.streaming import views

SCHEMA = "id bigint, ts timestamp_ntz, kind string, key bigint"
START = dt.datetime(2024, 6, 1, 9, 0)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, tmp_path, view):
    views.run_to_files(view, str(tmp_path / "out"), str(tmp_path / "state"))
    return spark.read.schema(view.schema).parquet(str(tmp_path / "out")).collect()


def stream(spark, folder):
    from pyspark.sql.types import _parse_datatype_string

    return views.read_files(spark, str(folder), _parse_datatype_string(SCHEMA))


def test_slices_come_out_settled_and_once(spark, tmp_path):
    folder = tmp_path / "in"
    land(spark, folder, [(1, at(1), "busy", 1), (2, at(9), "done", 1), (3, at(12), "busy", 1), (4, at(45), "busy", 1)])
    view = lambda: views.call_status(stream(spark, folder), "ts", ["kind"], {"busy": F.col("kind") == "busy"})
    first = run(spark, tmp_path, view())
    assert {(r["window_start"], r["kind"], r["n"]) for r in first} == {
        (at(0), "busy", 1), (at(0), "done", 1), (at(10), "busy", 1)}
    # Too late for its slice, in time for an open one, and one that closes the rest.
    land(spark, folder, [(5, at(2), "busy", 1), (6, at(44), "busy", 1), (7, at(90), "busy", 1)])
    again = run(spark, tmp_path, view())
    assert sorted((r["window_start"], r["kind"], r["n"]) for r in again) == [
        (at(0), "busy", 1), (at(0), "done", 1), (at(10), "busy", 1), (at(40), "busy", 2)]


def test_feedback_by_hour_and_city(spark, tmp_path):
    folder = tmp_path / "in"
    land(spark, folder, [(1, at(5), "a", 1), (2, at(50), "a", 2), (3, at(55), "a", 9), (4, at(200), "a", 1)])
    cases = spark.createDataFrame([(1, "CHD"), (2, "CHD")], "caseId bigint, place string")
    view = views.hourly_feedback(stream(spark, folder), "ts", cases, "key", "caseId", "place")
    out = run(spark, tmp_path, view)
    assert {(r["window_start"], r["city"], r["answers"]) for r in out} == {(at(0), "CHD", 2), (at(0), "NOCITY", 1)}


def test_one_notice_per_appointment(spark, tmp_path):
    folder = tmp_path / "in"
    land(spark, folder, [(1, at(0), "p", 7), (2, at(1), "p", 7), (3, at(1), "p", 8)])
    view = lambda: views.payment_notices(stream(spark, folder), "ts", "key")
    assert sorted(r["key"] for r in run(spark, tmp_path, view())) == [7, 8]
    land(spark, folder, [(4, at(2), "p", 7), (5, at(2), "p", 9)])
    assert sorted(r["key"] for r in run(spark, tmp_path, view())) == [7, 8, 9]


def test_a_call_that_comes_again_counts_once_under_its_last_status(spark, tmp_path):
    folder = tmp_path / "in"
    view = lambda: views.call_status(stream(spark, folder), "ts", ["key"], {"busy": F.col("kind") == "busy", "done": F.col("kind") == "completed"},
                                     call="id", version="kind")
    # "completed" is the greater version here; call 1 comes twice in one batch, call 2 again in the next one, in time.
    land(spark, folder, [(1, at(1), "busy", 1), (1, at(1), "completed", 1), (2, at(9), "busy", 1), (3, at(9), "busy", 1), (4, at(25), "busy", 1)])
    assert run(spark, tmp_path, view()) == []
    land(spark, folder, [(2, at(9), "completed", 1), (5, at(60), "busy", 1)])
    run(spark, tmp_path, view())
    # Too late: the slice of call 3 is closed.
    land(spark, folder, [(3, at(9), "completed", 1), (6, at(120), "busy", 1)])
    out = run(spark, tmp_path, view())
    land(spark, folder, [(7, at(300), "busy", 1)])
    out = run(spark, tmp_path, view())
    got = sorted((r["window_start"], r["busy"], r["done"], r["n"]) for r in out)
    assert got[:2] == [(at(0), 1, 2, 3), (at(20), 1, 0, 1)]
