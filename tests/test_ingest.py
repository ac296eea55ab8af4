"""Typed CSV scans, payload flattening, locations, sinks and the load audit."""

from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal as D
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from dailymart.plans.mart import FACT
from dailymart.schemas import RAW
from dailymart.sinks.catalog import Catalog
from dailymart.sinks.lake import Lake, qualified_name, register_views
from dailymart.sinks.loading import audit_summary, load_manifest, load_succeeded
from dailymart.sources.files import read_typed_csv, scan_csv
from dailymart.sources.weather import flatten_hourly, split_coordinates, weather_locations, within_dates

T0 = datetime(2024, 2, 1)


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_coerces_times_and_dates(spark, tmp_path):
    path = write(
        tmp_path / "orders_daily.csv",
        "timestamp,date,listing_id,orders\n"
        "2024-01-01 10:00:00,2024-01-01,1,5\n"
        "garbage,2024-01-02 23:59:59,2.0,NA\n"
        ",not a date,,-3\n",
    )
    rows = read_typed_csv(spark, path, "orders_daily").orderBy("orders").collect()
    assert [tuple(r) for r in rows] == [
        (date(2024, 1, 2), 2, None, None),
        (None, None, -3, None),
        (date(2024, 1, 1), 1, 5, datetime(2024, 1, 1, 10)),
    ]


def test_csv_reads_quotes_booleans_and_decimals(spark, tmp_path):
    path = write(tmp_path / "org.csv", 'id,name,timestamp\n1,"A ""quoted"", name",2020-01-01\n2,n/a,2020-01-02\n')
    rows = read_typed_csv(spark, path, "org").orderBy("id").collect()
    assert [r.name for r in rows] == ['A "quoted", name', None]
    assert rows[0].timestamp == datetime(2020, 1, 1)
    path = write(
        tmp_path / "rank.csv",
        "listing_id,date,timestamp,is_online,rank\n1,2024-01-01,2024-01-01 01:00:00,True,3.456\n1,2024-01-01,,False,\n",
    )
    rows = read_typed_csv(spark, path, "rank").orderBy("is_online").collect()
    assert [(r.is_online, r.rank) for r in rows] == [(False, None), (True, D("3.46"))]


def test_csv_bad_id_fails_and_unknown_column_is_refused(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name,timestamp\nseven,x,2020-01-01\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_typed_csv(spark, path, "org").collect()
    path = write(tmp_path / "b.csv", "id,colour\n1,red\n")
    with pytest.raises(ValueError, match="colour"):
        read_typed_csv(spark, path, "org")


def test_csv_missing_column_and_empty_files(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id\n1\n")
    row = read_typed_csv(spark, path, "org").first()
    assert (row.id, row.name, row.timestamp) == (1, None, None)
    for text in ("", "id,name,timestamp\n"):
        assert read_typed_csv(spark, write(tmp_path / "e.csv", text), "org").count() == 0


def test_csv_parts_in_different_orders_and_surplus_fields(spark, tmp_path):
    """Each part is read by its own header; a field too many is set aside or fails the read, never dropped."""
    folder = tmp_path / "parts of it"
    folder.mkdir()
    write(folder / "a.csv", "order_id,listing_id,status,placed_at\n1,10,a,2024-01-01\n2,20\n")
    write(folder / "b.csv", 'listing_id,order_id,status\n30,3,"x, y"\n40,4,z,more\n50,5,,,,\n')
    write(folder / "empty.csv", "")
    write(folder / "header.csv", "status,order_id\n")
    rows, rejects = scan_csv(spark, str(folder), "orders")
    found = sorted((r.order_id, r.listing_id, r.status, r.placed_at) for r in rows.collect())
    assert found == [(1, 10, "a", datetime(2024, 1, 1)), (2, 20, None, None), (3, 30, "x, y", None)]
    assert sorted(tuple(r) for r in rejects.collect()) == [("40,4,z,more", "more fields than columns"), ("50,5,,,,", "more fields than columns")]
    with pytest.raises(Exception, match="more fields than columns"):
        read_typed_csv(spark, str(folder), "orders").collect()
    write(folder / "c.csv", "order_id,colour\n1,red\n")
    with pytest.raises(ValueError, match="colour"):
        scan_csv(spark, str(folder), "orders")


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    """Only files with such breaks are read whole; the others may be split."""
    folder = tmp_path / "parts"
    folder.mkdir()
    write(folder / "a.csv", 'id,name,timestamp\n1,"two\nlines, ""quoted""\r\n",2020-01-01\n2,plain,2020-01-02\n')
    write(folder / "b.csv", 'name,id\n"one, line",3\nfour,4\n')
    found = read_typed_csv(spark, str(folder), "org")
    assert sorted((r.id, r.name) for r in found.collect()) == [(1, 'two\nlines, "quoted"\r\n'), (2, "plain"), (3, "one, line"), (4, "four")]
    assert read_typed_csv(spark, str(folder / "b.csv"), "org", multi_line=False).count() == 2
    write(folder / "c.csv", 'id,name\n5,"x\ny",7\n')
    rows, rejects = scan_csv(spark, str(folder), "org")
    assert rows.count() == 4 and rejects.count() == 1


MANIFEST = {"org.csv": "org", "platform.csv": "platform", "outlet.csv": "outlet", "listing.csv": "listing"}


def test_failed_replace_keeps_rows_and_old_versions_go(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    good = "id,name,timestamp\n1,a,2020-01-01\n2,b,2020-01-01\n"
    for _ in range(3):
        write(tmp_path / "org.csv", good)
        load_manifest(spark, str(tmp_path), lake, T0, replace=True, manifest={"org.csv": "org"})
    assert [v.partition("-")[0] for v in lake.versions("raw", "org")] == ["v2", "v3"]
    before = lake.read_raw("org")
    write(tmp_path / "org.csv", "id,name,timestamp\nx,a,2020-01-01\n")
    audit = load_manifest(spark, str(tmp_path), lake, T0, replace=True, manifest={"org.csv": "org"})
    assert tuple(audit.first()) == ("org", 0, 2, "failed", "CAST_INVALID_INPUT")
    assert before.count() == lake.read_raw("org").count() == 2
    write(tmp_path / "org.csv", good)
    load_manifest(spark, str(tmp_path), lake, T0, replace=True, manifest={"org.csv": "org"})
    assert before.count() == 2  # a reader of the version before still finds its files


def test_programming_errors_are_raised(spark, tmp_path):
    with pytest.raises(KeyError):
        write(tmp_path / "org.csv", "id\n1\n")
        load_manifest(spark, str(tmp_path), Lake(spark, str(tmp_path / "lake")), T0, manifest={"org.csv": "no such table"})


def test_manifest_continues_after_failures(spark, tmp_path):
    write(tmp_path / "org.csv", "id,name,timestamp\n1,a,2020-01-01\n2,b,2020-01-01\n")
    write(tmp_path / "platform.csv", "id,group,name,country\n")
    write(tmp_path / "outlet.csv", "id,org_id,name,latitude,longitude,timestamp\nx,1,n,1,1,2020-01-01\n")
    lake = Lake(spark, str(tmp_path / "lake"))

    def load(**options):
        audit = load_manifest(spark, str(tmp_path), lake, T0, manifest=MANIFEST, **options)
        return audit, {r.table_name: tuple(r)[1:4] for r in audit_summary(audit).collect()}

    audit, found = load()
    assert found == {
        "org": (2, 2, "loaded"),
        "platform": (0, 0, "empty"),
        "outlet": (0, 0, "failed"),
        "listing": (0, 0, "missing"),
        "TOTAL": (2, 2, "2/4"),
    }
    assert load_succeeded(audit).first().succeeded
    reasons = {r.table_name: r.reason for r in audit.collect()}
    assert reasons == {"org": None, "platform": None, "outlet": "CAST_INVALID_INPUT", "listing": "PATH_NOT_FOUND"}
    _, doubled = load()
    assert doubled["org"] == (2, 4, "loaded")
    _, again = load(replace=True)
    assert again["org"] == (2, 2, "loaded")
    stored = lake.read_raw("org")
    assert stored.schema == RAW["org"]
    assert {r.loaded_at for r in stored.collect()} == {T0}


def payload(**hourly):
    return json.dumps({"latitude": 1.0, "hourly": hourly})


GOOD = {
    "time": ["2024-01-01T00:00", "2024-01-01T01:00"],
    "temperature_2m": [1.25, None],
    "relative_humidity_2m": [80, 81],
    "wind_speed_10m": [3.0, 4.567],
}


def flat(spark, *payloads):
    rows, rejects = flatten_hourly(spark.createDataFrame(list(enumerate(payloads)), "outlet_id long, payload string"))
    return [tuple(r) for r in rows.orderBy("outlet_id", "datetime").collect()], {r.outlet_id: r.reason for r in rejects.collect()}


def test_payload_rows(spark):
    rows, rejects = flat(spark, payload(**GOOD))
    assert rejects == {}
    assert rows == [
        (0, datetime(2024, 1, 1, 0), D("1.25"), 80, D("3.00")),
        (0, datetime(2024, 1, 1, 1), None, 81, D("4.57")),
    ]


def test_payload_rejects(spark):
    missing = {k: v for k, v in GOOD.items() if k != "wind_speed_10m"}
    short = GOOD | {"temperature_2m": [1.0]}
    bad_time = GOOD | {"time": ["2024-01-01T00:00", "noon"]}
    bad_value = GOOD | {"temperature_2m": {"a": 1}}
    rows, rejects = flat(spark, payload(**missing), payload(**short), payload(**bad_time), "{oops", payload(**bad_value), payload(**GOOD))
    assert rejects == {
        0: "arrays of unequal length",
        1: "arrays of unequal length",
        2: "unreadable time",
        3: "malformed payload",
        4: "unreadable value",
    }
    assert {r[0] for r in rows} == {5}


def test_payload_without_hours_or_with_null_metric(spark):
    rows, rejects = flat(spark, "{}", payload(time=[]), payload(**GOOD | {"wind_speed_10m": None}))
    assert rejects == {}
    assert [(r[0], r[4]) for r in rows] == [(2, None), (2, None)]


def test_locations(spark):
    outlets = [(3, D(1), D(2)), (1, D(0), D(0)), (2, None, D(1)), (3, D(1), D(2)), (4, D(0), D(5))]
    raw = spark.createDataFrame([(i, 1, "n", a, b, T0, T0) for i, a, b in outlets], RAW["outlet"])
    assert [r.outlet_id for r in weather_locations(raw).collect()] == [3, 3, 4]
    assert [r.outlet_id for r in weather_locations(raw, dedupe=True).collect()] == [3, 4]
    pairs = spark.createDataFrame([(1, 90.0, 180.0), (2, 90.1, 0.0), (3, 0.0, -180.5)], "outlet_id int, latitude double, longitude double")
    usable, rejected = split_coordinates(pairs)
    assert [r.outlet_id for r in usable.collect()] == [1]
    assert {r.outlet_id: r.reason for r in rejected.collect()} == {2: "latitude out of range", 3: "longitude out of range"}


def test_date_range_includes_both_ends(spark):
    rows = spark.sql("select explode(sequence(timestamp_ntz'2022-12-31 23:00', timestamp_ntz'2025-01-01 00:00', interval 1 hour)) datetime")
    assert within_dates(rows).count() == 731 * 24


def test_sinks(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    two, one = spark.range(2), spark.range(1)
    assert lake.append(two, "raw", "t") == 2
    assert lake.append(one, "raw", "t") == 1
    assert lake.count("raw", "t") == 3
    assert lake.replace(one, "raw", "t") == 1
    assert lake.count("raw", "t") == 1
    assert lake.count("raw", "none") == 0
    register_views({"stg_t": lake.read("raw", "t")})
    assert spark.table("stg_t").count() == 1
    assert qualified_name("fct", "mart") == "mart.fct"
    assert qualified_name("fct", " mart ") == "mart.fct"
    assert qualified_name("fct") == "public.fct"


def test_fact_table_is_partitioned_by_month(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.sql("select explode(sequence(date'2024-01-30', date'2024-02-02')) date, 1L listing_id, 2 x")
    assert lake.build_fact(df, "mart", "f") == 4
    assert sorted(p.name for p in (tmp_path / "mart" / "f").glob("v1-*/load=1-*/month=*")) == ["month=2024-01-01", "month=2024-02-01"]
    assert lake.read("mart", "f").where("month = date'2024-02-01'").count() == 2


def test_append_counts_only_when_complete(spark, tmp_path):
    """A load that dies leaves the old rows; the same id then starts over, and a stored id is refused."""
    lake = Lake(spark, str(tmp_path))
    assert lake.append(spark.range(5), "raw", "t", "monday") == 5
    dies = spark.range(0, 100, 1, 4).select(F.when(F.col("id") > 90, F.raise_error(F.lit("died")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="died"):
        lake.append(dies, "raw", "t", "tuesday")
    half = tmp_path / "raw" / "t" / "v0-appended" / "load=wednesday"
    spark.range(7).write.parquet(str(half))  # all files are there, but the writer died before it said so
    assert lake.loads("raw", "t") == ["monday"] and lake.count("raw", "t") == 5
    assert lake.append(spark.range(10, 13), "raw", "t", "tuesday") == 3
    assert lake.append(spark.range(20, 21), "raw", "t", "wednesday") == 1
    for again in ("monday", "wednesday"):
        with pytest.raises(ValueError, match="already stored"):
            lake.append(spark.range(1), "raw", "t", again)
    assert sorted(r.id for r in lake.read("raw", "t").collect()) == [0, 1, 2, 3, 4, 10, 11, 12, 20]
    with pytest.raises(ValueError, match="letters"):
        lake.append(spark.range(1), "raw", "t", "../x")
    lake.replace(spark.range(2), "raw", "t")
    assert lake.loads("raw", "t") == ["all"] and lake.append(spark.range(1), "raw", "t", "monday") == 1


def test_two_writers_do_not_touch_each_other(spark, tmp_path):
    """Writers that draw the same number have folders of their own, and one of them counts as a whole."""
    from concurrent.futures import ThreadPoolExecutor

    lake = Lake(spark, str(tmp_path))
    assert len({lake._next(str(tmp_path / "t"), "v") for _ in range(50)}) == 50
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: lake.replace(spark.range(k * 1000, k * 1000 + 500, 1, 3), "raw", "t"), range(4)))
    found = [r.id for r in lake.read("raw", "t").collect()]
    assert sorted(found) == list(range(min(found), min(found) + 500))


def test_parts_are_replaced_by_themselves(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.sql("select id, cast(id % 3 as int) slot, 1 x from range(9)")
    assert lake.build_parts(df, "raw", "p", "slot", ["id"]) == 9
    before = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    assert lake.replace_parts(df.where("slot = 1 and id > 3").withColumn("x", F.lit(2)), "raw", "p", "slot", [1, 2]) == 2
    now = lake.read_parts("raw", "p", "slot", df.schema)
    assert sorted(map(tuple, now.collect())) == [(0, 0, 1), (3, 0, 1), (4, 1, 2), (6, 0, 1), (7, 1, 2)]
    assert sorted(map(tuple, lake.read("raw", "p").select("id", "slot", "x").collect())) == sorted(map(tuple, now.collect()))
    assert all(f.stat().st_mtime_ns == t for f, t in before.items())  # a reader of before still has its files
    assert lake.replace_parts(df.where("slot = 1"), "raw", "p", "slot", [1]) == 3
    (first,) = (tmp_path / "raw" / "p").glob("v1-*/load=1-*")
    assert not (first / "slot=1").exists() and (first / "slot=0").exists()
    assert sorted(r.id for r in lake.read_parts("raw", "p", "slot", df.schema).collect()) == [0, 1, 3, 4, 6, 7]
    spark.range(1).withColumn("slot", F.lit(0)).write.partitionBy("slot").parquet(str(first.parent / "load=9-dead"))
    assert lake.read_parts("raw", "p", "slot", df.schema).count() == 6  # not committed
    empty = df.limit(0)
    assert lake.build_parts(empty, "raw", "p", "slot") == 0
    assert lake.read_parts("raw", "p", "slot", df.schema).collect() == []


def test_refresh_replaces_whole_months_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))

    def days(value):
        return spark.sql(
            f"select explode(sequence(date'2024-01-30', date'2024-03-02')) date, 1L listing_id, {value} x"
        )

    assert lake.build_fact(days(1), "mart", "f") == 33
    assert lake.refresh_fact(days(2), "mart", "f", date(2024, 2, 10), date(2024, 2, 11)) == 29
    found = {(r.month, r.x): r["count"] for r in lake.read("mart", "f").groupBy("month", "x").count().collect()}
    assert found == {(date(2024, 1, 1), 1): 2, (date(2024, 2, 1), 2): 29, (date(2024, 3, 1), 1): 2}


def test_refresh_empties_months_without_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-04-30')) date, 1L listing_id")
    lake.build_fact(df, "mart", "f")
    late = df.where("date < '2024-02-01' OR date >= '2024-03-31'")
    assert lake.refresh_fact(late, "mart", "f", date(2024, 2, 3), date(2024, 3, 1)) == 1
    assert lake.read("mart", "f").drop("month").exceptAll(late).isEmpty()
    assert lake.read("mart", "f").count() == late.count()


def test_fact_files_hold_listings_apart(spark, tmp_path):
    """Within a month the files' ranges of listings do not overlap."""
    lake = Lake(spark, str(tmp_path))
    df = spark.sql("select d.date, l.id listing_id from (select explode(sequence(date'2024-01-01', date'2024-02-29')) date) d cross join range(300) l")
    lake.build_fact(df, "mart", "f")
    files = lake.read("mart", "f").selectExpr("month", "listing_id", "_metadata.file_path file")
    ranges = files.groupBy("month", "file").agg({"listing_id": "min"}).count()
    assert ranges >= 2
    bounds = sorted(tuple(r) for r in files.groupBy("month", "file").agg(F.min("listing_id"), F.max("listing_id")).collect())
    for a in bounds:
        for b in bounds:
            if a[0] == b[0] and a[1] != b[1]:
                assert a[3] <= b[2] or b[3] <= a[2]


def test_catalog_tables_are_written_at_the_same_time(spark, small, tmp_path, monkeypatch):
    """A write waits for a second one to begin, which never does where tables are written one after the other."""
    two, saved = Barrier(2, timeout=60), []
    save = Catalog.save

    def meeting(self, df, model):
        if model in ("org", "platform"):
            two.wait()
        saved.append(model)
        return save(self, df, model)

    monkeypatch.setattr(Catalog, "save", meeting)
    catalog = Catalog(spark, str(tmp_path), prefix="at_once_")
    raw = {t: small.raw[t] for t in RAW}
    try:
        catalog.publish(raw, small.lazy, ["int_rank_daily_avg"])
        assert sorted(saved) == sorted([*RAW, "int_rank_daily_avg", FACT])
        for table in ("org", "listing", "weather"):
            assert spark.table(catalog.name(table)).count() == raw[table].count()
        assert spark.table(catalog.name(FACT)).count() == small.lazy.fact.count()
    finally:
        catalog.drop()
