"""Sinks, quality operators, report blocks and streaming jobs on small fixtures."""

import json
from datetime import date, datetime

import pytest
from documents import day_document
from pyspark.sql import functions as F

from zonecast import schemas
from zonecast.functions.numeric import json_ready, ordered, share
from zonecast.functions.ordering import running_total, with_position
from zonecast.operators import marts, quality, report
from zonecast.operators.validate import quarantined
from zonecast.plans import warehouse
from zonecast.session import Scratch
from zonecast.sources import sinks, tables
from zonecast.sources.raw import PRICE_PAYLOAD
from zonecast.streaming import jobs

INTERVAL = "zone string, delivery_date date, interval_start timestamp_ntz, price_sek_kwh double"


def intervals(spark, days, price=1.0, zone="Z"):
    rows = [
        (zone, date(2025, 1, d), datetime(2025, 1, d, 10, m), price + m) for d in days for m in (0, 15, 30, 45)
    ]
    return spark.createDataFrame(rows, INTERVAL)


def test_merge_rebuilds_four_dates_and_keeps_older_ones(spark, tmp_path):
    path = str(tmp_path / "hourly")
    sinks.merge_recent(spark, path, intervals(spark, range(1, 11)), marts.hourly_fact)
    sinks.merge_recent(spark, path, intervals(spark, range(1, 13), price=100.0), marts.hourly_fact)
    rows = {r["delivery_date"].day: r["price_sek_kwh"] for r in spark.read.parquet(path).collect()}
    assert set(rows) == set(range(1, 13))
    assert all(rows[d] == 23.5 for d in range(1, 7)) and all(rows[d] == 122.5 for d in range(7, 13))


def test_write_once_never_rewrites(spark, tmp_path):
    path = str(tmp_path / "log")
    df = lambda v, *days: spark.createDataFrame([(date(2025, 1, d), v) for d in days], "day date, v int")
    for frame in (df(1, 1, 2), df(2, 2, 3), df(3, 1, 2, 3)):
        sinks.write_once(frame, path, "day")
    assert {(r["day"].day, r["v"]) for r in spark.read.parquet(path).collect()} == {(1, 1), (2, 1), (3, 2)}


def test_write_once_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    path = str(tmp_path / "log")
    keys = lambda a, b: spark.range(a, b).select("id", F.lit(a).alias("run"))
    sinks.write_once(keys(0, 200), path, "id", buckets=16)
    sinks.write_once(keys(150, 300), path, "id", buckets=16)
    log = spark.read.parquet(path)
    assert log.groupBy("id").count().where("count > 1").count() == 0
    assert {(r["run"], r["n"]) for r in log.groupBy("run").agg(F.count("*").alias("n")).collect()} == {(0, 200), (150, 100)}
    touched = keys(7, 8).select(sinks.bucket_of(16, "id")).first()[0]
    known = sinks.logged(spark, path, 16, [touched])
    files = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_of_16" in files or "PartitionFilters: [bucket_of_16" in files
    assert known.count() == log.where(F.col("bucket_of_16") == touched).count() < 300
    assert sinks.is_logged(spark, path, buckets=16, id=7) and not sinks.is_logged(spark, path, buckets=16, id=300)
    assert not sinks.is_logged(spark, str(tmp_path / "none"), id=7)
    with pytest.raises(ValueError, match="not a write-once log of 8 buckets"):
        sinks.write_once(keys(0, 3), path, "id", buckets=8)


def test_a_logged_day_is_found_by_its_bucket(spark, tmp_path):
    path = str(tmp_path / "log")
    days = [(date(2025, 1, d), 1) for d in range(1, 20)]
    sinks.write_once(spark.createDataFrame(days, "day date, v int"), path, "day")
    assert all(sinks.is_logged(spark, path, day=d) for d, _ in days[:3])
    assert not sinks.is_logged(spark, path, day=date(2025, 2, 1))


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_positions_and_running_totals_in_a_global_order(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    off = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set(off, "false")
        df = spark.range(3000, numPartitions=5).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("k"), "id", (F.col("id") % 7).alias("w"))
        with Scratch(spark, "test") as work:
            placed = with_position(df, work, "k", F.desc("id")).collect()
            summed = running_total(df, work, "w", "k", "id").collect()
        empty = tables.numbered(df.where("false"), "k").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set(off, "true")
    rows = sorted(placed, key=lambda r: (r["k"], -r["id"]))
    assert [r["position"] for r in rows] == list(range(3000)) and empty == []
    total = 0
    for r in sorted(summed, key=lambda r: (r["k"], r["id"])):
        total += r["w"]
        assert r["through"] == total


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_partitions(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), path, "k")
    sinks.overwrite_partitions(spark.createDataFrame([("b", 2)], "k string, v int"), path, "k")
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 2)}


def test_report_json_is_clean(spark, tmp_path):
    df = spark.createDataFrame(
        [(float("nan"), 1.234567891, date(2025, 1, 2), datetime(2025, 1, 1), True, float("inf"))],
        "a double, b double, d date, t timestamp_ntz, e boolean, i double",
    )
    row = json_ready(df).first().asDict()
    assert row == {"a": None, "b": 1.23457, "d": "2025-01-02", "t": "2025-01-01T00:00:00+00:00", "e": True, "i": None}
    sinks.write_report(df, str(tmp_path / "r"))
    text = spark.read.text(str(tmp_path / "r")).first()[0]
    assert json.loads(text)["b"] == 1.23457


def test_parameterised_query(spark):
    spark.range(5).createOrReplaceTempView("numbers")
    assert tables.query(spark, "select * from numbers where id >= :low", low=3).count() == 2


def test_seed_csv_and_what_does_not_fit(spark, tmp_path):
    lines = ["holiday_date,holiday_name", "2025-01-01,Nyårsdagen", "soon,Våffeldagen", "2025-06-06", "2025-01-06,a,b", ",Ingen", "2025-01-01,Åter", '2025-12-25,"Jul, dagen"']
    (tmp_path / "h.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows, rejects = tables.read_seed(spark, str(tmp_path / "h.csv"), schemas.HOLIDAYS_SEED, "holiday_date")
    assert {tuple(r) for r in rows.collect()} == {(date(2025, 1, 1), "Nyårsdagen"), (date(2025, 12, 25), "Jul, dagen")}
    assert {tuple(r) for r in rejects.collect()} == {
        ("soon,Våffeldagen", "does not fit the declared columns"),
        ("2025-06-06", "does not fit the declared columns"),
        ("2025-01-06,a,b", "does not fit the declared columns"),
        (",Ingen", "no holiday_date"),
        ("2025-01-01,Åter", "repeats holiday_date"),
    }
    (tmp_path / "other.csv").write_text("day,name\n2025-01-01,x\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header"):
        tables.read_seed(spark, str(tmp_path / "other.csv"), schemas.HOLIDAYS_SEED)


def test_zones_of_a_build_come_from_the_seed(spark, tmp_path):
    out = str(tmp_path / "out")
    assert {r["zone"] for r in warehouse.zones_of(spark, out).collect()} == {"SE1", "SE2", "SE3", "SE4"}
    (tmp_path / "zones.csv").write_text("zone,zone_name,largest_city\nN1,North,Town\n,Lost,Town\nN2,South\n", encoding="utf-8")
    assert warehouse.build_zones(spark, str(tmp_path / "zones.csv"), out) == {"zones": 1, "rejects": 2}
    assert warehouse.zones_of(spark, out).first()["zone"] == "N1"


def test_table_tests_find_each_kind_of_violation(spark):
    day = date(2025, 1, 1)
    rows = [("a", day, 0), ("a", day, 0), ("b", day, 1), (None, day, 2), ("c", None, 3)]
    df = spark.createDataFrame([(*r, 60) for r in rows], "zone string, delivery_date date, slot int, resolution_minutes int")
    zones = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "name string")
    got = quality.table_tests(
        df,
        {"repeated": ("zone", "slot")},
        {"no_zone": F.col("zone").isNull(), "late": F.col("slot") > 2, "unknown": F.lit(None).cast("boolean")},
        {"parent": quality.Known(("zone",), zones, ("name",)), "share": quality.Known(("zone",), zones, ("name",), least=0.7)},
        {"filled": ("zone", "delivery_date")},
    )
    assert {r["test"]: r["failures"] for r in got.collect()} == {
        "repeated": 1, "no_zone": 1, "late": 1, "unknown": 0, "parent": 1, "share": 1, "filled": 3,
    }
    empty = quality.table_tests(df.where("false"), {"repeated": ("zone",)}, known={"share": quality.Known(("zone",), zones, ("name",), least=0.7)})
    assert {r["failures"] for r in empty.collect()} == {0}
    single = quality.table_tests(zones, {"repeated": ("name",)})
    assert single.first()["failures"] == 1  # a null is no key


def test_quality_operators(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k int, v string")
    assert quality.not_null(df, "v").count() == 1
    assert quality.not_null(df, "v", F.col("k") != 2).count() == 0
    assert [tuple(r) for r in quality.unique(df, "k").collect()] == [(1, 2)]
    assert quality.accepted_values(df, "v", "a", "b").first()["v"] == "c"
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r["k"] for r in quality.relationships(df, "k", parent, "id").collect()] == [2]
    results = quality.suite(
        quality.row_checks(df, {"no_null": F.col("v").isNull(), "positive": F.col("k") <= 0}),
        quality.failures("unique", quality.unique(df, "k")),
    )
    assert {(r["test"], r["failures"]) for r in results.collect()} == {("no_null", 1), ("positive", 0), ("unique", 1)}


def test_coverage_of_an_empty_fact_is_not_an_error(spark):
    none = spark.createDataFrame([], "zone string, h int")
    assert quality.coverage(none, none, "zone", "h").first()["coverage"] is None
    assert quality.low_coverage(none, none, "zone", "h").count() == 0


def test_daily_stats_ties_go_to_the_earliest(spark):
    rows = intervals(spark, [1]).withColumns(
        {"price_sek_kwh": F.lit(-1.0), "interval_start_local": F.col("interval_start"), "resolution_minutes": F.lit(15)}
    )
    days = spark.createDataFrame([(date(2025, 1, 1), False)], "date_day date, is_workday boolean")
    row = marts.daily_zone_stats(rows, days).first()
    assert row["cheapest_interval_local"] == row["dearest_interval_local"] == datetime(2025, 1, 1, 10)
    assert row["negative_intervals"] == 4 and row["intraday_spread"] == 0.0


def test_timetable_labels_and_cheapest(spark):
    hours = [(h, h) for h in range(3)] + [(3, 2)] + [(h + 1, h) for h in range(3, 24)]
    day = date(2025, 10, 26)
    rows = [
        ("Z", day, datetime(2025, 10, 25, 22 + k) if k < 2 else datetime(2025, 10, 26, k - 2), local, float(k % 7))
        for k, local in hours
    ]
    issued = spark.createDataFrame(rows, "zone string, delivery_date date, hour_start timestamp_ntz, hour_local int, q50 double")
    got = report.timetable(issued).orderBy("hour_start").collect()
    assert [r["label"] for r in got][:5] == ["00", "01", "02", "02b", "03"]
    assert [i for i, r in enumerate(got) if r["cheap"]] == [0, 7, 14]
    cuts = sorted(float(k % 7) for k in range(25))
    edges = [cuts[int(i / 7 * 25)] for i in range(1, 7)]
    assert [r["bin"] for r in got] == [sum(r["q50"] >= e for e in edges) for r in got]


def test_tomorrow_by_zone_holds_the_day_in_order(spark):
    rows = [
        ("Z", date(2025, 1, d), datetime(2025, 1, d, h), h, 1.0, float(h), 3.0, 0.5, datetime(2025, 1, 1, 9), "v1")
        for d in (1, 2) for h in (3, 1, 2)
    ]
    issued = spark.createDataFrame(
        rows, "zone string, delivery_date date, hour_start timestamp_ntz, hour_local int, q10 double, q50 double, q90 double, naive_day double, issued_at timestamp_ntz, model_version string"
    )
    row = report.tomorrow_by_zone(issued).first()
    assert row["delivery_date"] == date(2025, 1, 2) and [h["hour"] for h in row["hours"]] == [1, 2, 3]


def test_aligned_actual_shifts_by_the_day_difference(spark):
    issued = spark.createDataFrame(
        [("Z", date(2025, 1, 4), datetime(2025, 1, 4, h), h, 0.0, 1.0, 2.0) for h in (10, 11)],
        "zone string, delivery_date date, hour_start timestamp_ntz, hour_local int, q10 double, q50 double, q90 double",
    )
    got = {r["hour_local"]: r["day_before"] for r in report.aligned_actual(issued, intervals(spark, [1, 2])).collect()}
    assert got == {10: 23.5, 11: None}


def test_small_expressions(spark):
    df = spark.createDataFrame([(3.0, 1.0, 2.0), (1.0, 0.0, 0.0)], "a double, b double, c double")
    got = df.select(*ordered(F.col("a"), F.col("b"), F.col("c")), share(F.col("a"), F.col("b"))).collect()
    assert tuple(got[0]) == (1.0, 2.0, 3.0, 3.0) and got[1][3] == 0.0


def test_share_of_largest(spark):
    df = spark.createDataFrame([("g", -4.0), ("g", 2.0)], "k string, v double")
    assert {r["v"]: r["share"] for r in report.share_of_largest(df, "v", "k").collect()} == {-4.0: 1.0, 2.0: 0.5}


def test_stream_rollup_takes_late_intervals(spark, tmp_path):
    land, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        jobs.append_available(
            jobs.hourly_rollup(jobs.landing(spark, land, f"{INTERVAL}, published int", 1)), out, str(tmp_path / "state")
        )

    def land_rows(rows, published):
        rows.withColumn("published", F.lit(published)).coalesce(1).write.mode("append").parquet(land)
        run()

    land_rows(intervals(spark, [1]).limit(2), 1)
    land_rows(intervals(spark, [1]).where("price_sek_kwh > 20"), 1)
    # The same intervals again: at a higher version their price counts, at a lower one it doesn't.
    land_rows(intervals(spark, [1]).where("price_sek_kwh > 20"), 2)
    land_rows(intervals(spark, [1]).withColumn("price_sek_kwh", F.lit(99.0)), 0)
    land_rows(intervals(spark, [10]), 1)
    rows = spark.read.parquet(out).collect()
    assert [(r["hour_start"], r["n_intervals"], r["price_sek_kwh"]) for r in rows] == [
        (datetime(2025, 1, 1, 10), 4, 23.5)
    ]


def test_stream_keeps_the_first_snapshot(spark, tmp_path):
    land, kept, schema = str(tmp_path / "in"), str(tmp_path / "kept"), "k string, at int, v string"
    write = jobs.keep_first(kept, "at", "k")
    for rows in ([("a", 5, "first")], [("a", 1, "too late"), ("b", 2, "x"), ("b", 1, "y")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        jobs.each_batch_available(jobs.landing(spark, land, schema), write, str(tmp_path / "state"))
    assert {(r["k"], r["v"]) for r in spark.read.parquet(kept).collect()} == {("a", "first"), ("b", "y")}


def test_stream_batches_are_safe_to_repeat(spark, tmp_path):
    kept = str(tmp_path / "kept")
    write = jobs.keep_first(kept, "at", "k")
    batch = spark.createDataFrame([("a", 1, "x")], "k string, at int, v string")
    write(batch)
    write(batch)
    assert spark.read.parquet(kept).count() == 1


@pytest.mark.parametrize("repeat", [1, 2])
def test_stream_validation_splits_days(spark, tmp_path, repeat):
    good, bad = date(2025, 6, 1), date(2025, 6, 2)
    broken = day_document(bad)
    broken.pop(10)
    rows = [("SE3", good, "g", json.dumps(day_document(good))), ("SE3", bad, "b", json.dumps(broken))]
    batch = spark.createDataFrame(rows, "zone string, day date, source string, value string").select(
        "zone", "day", "source", F.from_json("value", PRICE_PAYLOAD).alias("payload")
    )
    write = jobs.validate_batches(str(tmp_path / "p"), str(tmp_path / "s"))
    for _ in range(repeat):
        write(batch)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 24
    assert [r["day"] for r in quarantined(spark.read.parquet(str(tmp_path / "s"))).collect()] == [bad]
    # The good day lands again without a record: its old prices no longer count.
    write(batch.where("source = 'g'").withColumn("payload", F.filter("payload", lambda x: F.lit(False))))
    prices, status = spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "s"))
    assert jobs.current_prices(prices, status).count() == 0


def test_merged_hours_keep_the_highest_version_and_survive_a_repeated_batch(spark, tmp_path):
    write = jobs.merge_hours(str(tmp_path / "intervals"), str(tmp_path / "hours"))

    def batch(*rows):
        at = lambda day, minute: datetime(2025, 3, day, 10, minute)
        write(spark.createDataFrame([("Z", at(d, m), p, v) for d, m, p, v in rows], "zone string, interval_start timestamp_ntz, price_sek_kwh double, published int"))
        return {(r["delivery_date"].day, r["price_sek_kwh"], r["n_intervals"]) for r in spark.read.parquet(str(tmp_path / "hours")).collect()}

    assert batch((1, 0, 1.0, 1), (1, 15, 3.0, 1), (2, 0, 5.0, 1)) == {(1, 2.0, 2), (2, 5.0, 1)}
    correction = ((1, 0, 7.0, 2),)
    for _ in range(2):
        assert batch(*correction) == {(1, 5.0, 2), (2, 5.0, 1)}
    assert batch((1, 0, 100.0, 1), (2, 0, 6.0, 1)) == {(1, 5.0, 2), (2, 6.0, 1)}
