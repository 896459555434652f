"""Streams against the batch operators, with restarts and late rows."""

import pytest
from pyspark.sql import functions as F

from aeroskein.operators.observed import hourly_rows, integrable_nights, night_metrics
from aeroskein.operators.profiles import integrate_profiles
from aeroskein.plans import derived as D
from aeroskein.streaming import archive as Z

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def profiles(spark):
    """Profiles of two radars by day: every quarter of an hour for four days."""
    rows = spark.range(2 * 4 * 96).selectExpr("concat('radar-', cast(id % 2 as string)) as radar", "'lp' as pulse", "timestampadd(MINUTE, cast(15 * (id div 2) as int), timestamp '2025-07-13 00:00:00') as ts", "cast(id as double) as mtr_birds_km_h")
    return rows.selectExpr(
        "*", "case when hour(ts) < 6 then date_sub(to_date(ts), 1) when hour(ts) >= 18 then to_date(ts) end as night_date", "hour(ts) between 6 and 17 as is_day", "mtr_birds_km_h / 10 as vid_birds_per_km2", "10.0D as mean_ground_speed_ms",
        "if(minute(ts) = 0, null, 90.0D) as dominant_direction_deg", "500.0D as density_weighted_mean_height_m", "false as rain_suspect",
    )


def days(profiles, *wanted):
    return profiles.where(F.dayofmonth("ts").isin(*wanted))


def run(spark, profiles, root):
    Z.stream_closed_nights(Z.read_stream(spark, f"{root}/in", profiles.schema, 1), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return sorted((r.radar, r.night_date.day, r.profile_count, r.batch) for r in out.collect())


def test_nights_close_once_when_the_next_date_comes(spark, profiles, tmp_path):
    root = f"file://{tmp_path}"
    days(profiles, 13).coalesce(1).write.parquet(f"{root}/in")
    # the night of the 12th ends on the 13th, a later source date
    assert run(spark, profiles, root) == [("radar-0", 12, 24, 0), ("radar-1", 12, 24, 0)]
    # a new run goes on where the last one stopped: the night of the 13th is half there and closes with the 14th
    days(profiles, 14).where("radar = 'radar-0'").coalesce(1).write.mode("append").parquet(f"{root}/in")
    second = run(spark, profiles, root)
    assert [r[:3] for r in second] == [("radar-0", 12, 24), ("radar-0", 13, 48), ("radar-1", 12, 24)]
    # late profiles of a closed night change nothing, those of an open one count
    late = days(profiles, 13).where("radar = 'radar-0' and hour(ts) = 20")
    late.unionByName(days(profiles, 14, 15).where("radar = 'radar-1'")).coalesce(1).write.mode("append").parquet(f"{root}/in")
    third = run(spark, profiles, root)
    assert [r[:3] for r in third] == [("radar-0", 12, 24), ("radar-0", 13, 48), ("radar-1", 12, 24), ("radar-1", 13, 48), ("radar-1", 14, 48)]
    assert run(spark, profiles, root) == third


def test_metrics_of_closed_nights_equal_the_batch(spark, profiles, tmp_path):
    root = f"file://{tmp_path}"
    for day in (13, 14, 15, 16):
        days(profiles, day).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run(spark, profiles, root)
    columns = ["radar", "night_date", "profile_count", "integrated_interval_count", "migration_traffic_birds_per_km", "peak_mtr_birds_km_h", "dominant_direction_deg"]
    got = spark.read.parquet(f"{root}/out").select(*columns)
    want = night_metrics(profiles).where("night_date < date '2025-07-16'").select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hours_of_a_stream_equal_the_batch_and_late_layers_are_dropped(spark, tmp_path):
    root = f"file://{tmp_path}"
    layers = D.layers(spark, DATA).where("ts < '2025-07-15 00:00:00'")
    early, later = layers.where("ts < '2025-07-14 12:00:00'"), layers.where("ts >= '2025-07-14 12:00:00'")
    late = early.where("hour(ts) = 3").withColumn("dens", F.lit(1e6))
    for part in (early, later, late):
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
    out = Z.hourly_stream(Z.read_stream(spark, f"{root}/in", layers.schema, 1))
    out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    newest = layers.agg(F.max("ts")).first()[0]
    want = hourly_rows(integrate_profiles(layers)).where(F.expr("hour + interval 1 hour") <= F.lit(newest) - F.expr("interval 2 hours"))
    cut = lambda df: sorted(tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in df.select(want.columns).collect())
    got = spark.read.parquet(f"{root}/out")
    assert got.count() > 20 and repr(cut(got)) == repr(cut(want))


def test_no_night_left_is_an_error(profiles):
    nights = night_metrics(profiles)
    assert integrable_nights(nights, required=True).count() == nights.count()
    with pytest.raises(ValueError, match="no complete night"):
        integrable_nights(nights.where("integrated_interval_count < 0"), required=True)


def test_a_batch_without_change_only_refreshes_the_status():
    built = Z.stream_status(None, 5)
    assert built["data_available"] and not built["no_change"]
    assert Z.stream_status(built, 0) == built | {"no_change": True}
    with pytest.raises(ValueError, match="nothing was built"):
        Z.stream_status(None, 0)


def test_batches_follow_the_data_and_not_the_number_of_days(spark, tmp_path):
    from aeroskein.plans.io_queries import layer_files

    root = f"file://{tmp_path}"
    stream = layer_files(spark, "/root/testdata/sf0.01", f"{root}/in")
    Z.stream_profiles(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    assert len(list((tmp_path / "out").glob("batch=*"))) == 1
    assert spark.read.parquet(f"{root}/out").count() == D.profiles(spark, "/root/testdata/sf0.01").count()


def test_waves_come_in_order_however_many_files_they_have(spark, tmp_path):
    from aeroskein.plans.io_queries import in_order

    rows = spark.range(0, 40 * 24, 1, 7).selectExpr("timestampadd(HOUR, cast(id as int), timestamp '2025-07-14 00:00:00') as ts")
    seen, batches = [], []

    def run(stream):
        each = lambda batch, n: batches.append(sorted(r.ts for r in batch.collect()))
        stream.writeStream.foreachBatch(each).option("checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        seen.append(len(batches))

    in_order(rows, f"file://{tmp_path}/in", run, waves=4)
    assert seen == [1, 2, 3, 4] and [t for b in batches for t in b] == sorted(r.ts for r in rows.collect())
    assert len(list((tmp_path / "in").glob("*.parquet"))) > 4


def test_nights_that_a_batch_brings_and_closes_dont_go_through_the_state():
    import datetime

    import pandas as pd

    class Value:
        rows = None

        def exists(self):
            return self.rows is not None

        def get(self):
            return self.rows

        def update(self, value):
            self.rows = value

    class Rows(list):
        appended = 0

        def appendValue(self, value):
            self.appended += 1
            self.append(value)

        def get(self):
            return iter(list(self))

        def put(self, values):
            self[:] = values

    class Handle:
        getValueState, getListState = (lambda self, *_: Value()), (lambda self, *_: Rows())

    nights = Z.OpenNights(["ts", "night_date"])
    nights.init(Handle())
    days = pd.date_range("2025-07-14 20:00", periods=50, freq="D")
    frame = lambda some: pd.DataFrame({"ts": some, "night_date": [t.date() for t in some]})
    out = pd.concat(nights.handleInputRows(None, iter([frame(days[:40])]), None))
    assert len(out) == 39 and nights.nights.appended == 1
    # the open night comes with the next batch, a night before the newest date is late
    out = pd.concat(nights.handleInputRows(None, iter([frame(days[5:6]), frame(days[40:])]), None))
    assert sorted(out["night_date"]) == [datetime.date(2025, 7, 14) + datetime.timedelta(n) for n in range(39, 49)]
