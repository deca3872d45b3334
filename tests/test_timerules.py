from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.functions.timerules import (
    CampaignWindow,
    check_disjoint,
    hour_lag_cutoff,
    hour_start,
    local_time,
    ntz,
    settled,
    window_flag,
)
from spinmart.operators.lookups import flag_by_window_table, windows_table

TIMED = "id int, t timestamp_ntz"
LO, HI = datetime(2024, 2, 6, 23, 59, 59), datetime(2024, 2, 25, 23, 59, 59)
SECOND = timedelta(seconds=1)


@pytest.mark.parametrize("as_of, cutoff", [
    (datetime(2024, 9, 1, 3, 30), datetime(2024, 9, 1, 2, 0)),
    (datetime(2024, 9, 1, 3, 0), datetime(2024, 9, 1, 2, 0)),
    (datetime(2024, 9, 1, 2, 59, 59, 999999), datetime(2024, 9, 1, 1, 0)),
    # 17:10 UTC is ten past midnight of the next local day.
    (datetime(2024, 8, 31, 17, 10), datetime(2024, 8, 31, 16, 0)),
    (datetime(2024, 8, 31, 17, 10, tzinfo=UTC), datetime(2024, 8, 31, 16, 0)),
])
def test_cutoff_is_start_of_local_hour_less_one(as_of, cutoff):
    assert hour_lag_cutoff(as_of) == cutoff


def test_settled_includes_the_cutoff_itself(spark, rows):
    cutoff = datetime(2024, 9, 1, 2, 0)
    df = spark.createDataFrame([(1, cutoff - SECOND), (2, cutoff), (3, cutoff + SECOND), (4, None)], TIMED)
    assert rows(df.where(settled(F.col("t"), datetime(2024, 9, 1, 3, 30))), "id") == [(1,), (2,)]


def test_settled_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, HI)], TIMED).write.parquet(path)
    plan = spark.read.parquet(path).where(settled(F.col("t"), HI))._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(t," in plan


def test_local_time_ignores_the_session_zone(spark):
    local = local_time(F.col("t"))
    df = spark.createDataFrame([(1, datetime(2024, 1, 31, 17, 30, 0, 123456))], TIMED).select(local, hour_start(local))
    assert [kind for _, kind in df.dtypes] == ["timestamp_ntz", "timestamp_ntz"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert tuple(df.collect()[0]) == (datetime(2024, 2, 1, 0, 30, 0, 123456), datetime(2024, 2, 1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def edge_times(spark, key):
    times = [LO, LO + SECOND, HI, HI + SECOND, datetime(2030, 1, 1), None]
    return spark.createDataFrame([(i, key, t) for i, t in enumerate(times)], "id int, game_id int, t timestamp_ntz")


WINDOWS = [
    CampaignWindow(0, str(LO), str(HI), {"game_id": 27}),
    CampaignWindow(0, str(LO), None, {"game_id": 20}),
    CampaignWindow(1, None, str(HI), {"game_id": 23}),
]


@pytest.mark.parametrize("key, default, flags", [
    (27, 1, [1, 0, 0, 1, 1, 1]),
    (20, 1, [1, 0, 0, 0, 0, 1]),
    (23, 0, [1, 1, 1, 0, 0, 0]),
    (99, 1, [1, 1, 1, 1, 1, 1]),
])
def test_window_bounds_in_both_forms(spark, key, default, flags):
    df = edge_times(spark, key)
    chained = df.withColumn("flag", window_flag(F.col("t"), WINDOWS, default))
    table = windows_table(spark, WINDOWS, T.StructType([T.StructField("game_id", T.IntegerType())]))
    joined = flag_by_window_table(df, table, ["game_id"], "t", default, "flag")
    for result in (chained, joined):
        assert [r.flag for r in result.orderBy("id").collect()] == flags


def test_first_window_wins_and_no_windows_give_the_default(spark):
    df = spark.createDataFrame([(1, HI)], TIMED)
    both = [CampaignWindow(7, str(LO), None), CampaignWindow(8)]
    assert df.select(window_flag(F.col("t"), both, 1), window_flag(F.col("t"), [], 3)).collect()[0] == (7, 3)


def test_overlapping_windows_are_refused():
    check_disjoint(WINDOWS)
    check_disjoint([CampaignWindow(0, str(LO), str(HI)), CampaignWindow(0, str(HI), None)])
    with pytest.raises(ValueError):
        check_disjoint([CampaignWindow(0, str(LO), None), CampaignWindow(0, str(HI), None)])


def test_ntz_literal_takes_zoned_and_plain_times(spark):
    zoned = datetime(2024, 1, 1, 7, tzinfo=UTC)
    row = spark.range(1).select(ntz(zoned), ntz("2024-01-01 07:00:00")).collect()[0]
    assert row[0] == row[1] == datetime(2024, 1, 1, 7)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_window_table_with_open_keys(spark, plan_of, limit):
    """Windows on both keys, on one and on none; the first that holds decides, as in the chain of tests."""
    windows = (
        CampaignWindow(2, "2024-01-02 00:00:00", "2024-01-04 00:00:00", {"site": 1, "gift": 7}),
        CampaignWindow(3, "2024-01-01 00:00:00", None, {"site": 1}),
        CampaignWindow(4, None, "2024-01-03 00:00:00"),
        CampaignWindow(5, "2024-01-05 00:00:00", "2024-01-06 00:00:00", {"gift": 7}),
    )
    data = [(n, site, gift, datetime(2024, 1, day)) for n, (site, gift, day) in enumerate(
        (s, g, d) for s in (1, 2, None) for g in (7, 8, None) for d in range(1, 8))]
    df = spark.createDataFrame(data, "id int, site int, gift long, t timestamp_ntz")
    keys = T.StructType([T.StructField("site", T.IntegerType()), T.StructField("gift", T.LongType())])
    got = flag_by_window_table(df, windows_table(spark, windows, keys), ["site", "gift"], "t", 0, "flag", limit)
    want = df.withColumn("flag", window_flag(F.col("t"), windows, 0))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_window_tables_have_no_cap(spark):
    many = [CampaignWindow(n, f"2024-01-01 00:{n // 60 % 60:02d}:{n % 60:02d}", f"2024-01-01 00:{(n + 1) // 60 % 60:02d}:{(n + 1) % 60:02d}",
                           {"game_id": n}) for n in range(12_000)]
    many = [CampaignWindow(n, w.lo, None, w.keys) for n, w in enumerate(many)]
    table = windows_table(spark, many, T.StructType([T.StructField("game_id", T.IntegerType())]))
    df = spark.createDataFrame([(11_999, datetime(2024, 2, 1)), (12_000, datetime(2024, 2, 1))], "game_id int, t timestamp_ntz")
    got = flag_by_window_table(df, table, ["game_id"], "t", -1, "flag")
    assert {(r.game_id, r.flag) for r in got.collect()} == {(11_999, 11_999), (12_000, -1)}
