from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from spinmart.plans.incremental_load import (
    incremental_load,
    incremental_load_partitioned,
    load_all,
    touched_rows,
)
from spinmart.sinks.tables import append_to_mart, write_export, write_outbox, write_stage
from spinmart.sources.changes import CHANGE_STAMPS, LoadConfig, changed_between, choose_tables
from spinmart.sources.readers import query_options, read_sheet, read_table
from spinmart.sources.schemas import RECIPIENTS, ROLES

LO, HI = datetime(2024, 1, 10), datetime(2024, 1, 12)
STAMPED = "id bigint, v string, updated_at timestamp_ntz, created_at timestamp_ntz"


def day(number, hour=0):
    return datetime(2024, 1, number, hour)


SOURCE = [
    (1, "at lo", day(10), day(1)), (2, "at hi", day(12), day(1)), (3, "created in", None, day(11)),
    (4, "neither", day(9, 23), day(9)), (5, "both null", None, None), (6, "created only", day(20), day(11, 23)),
]


def test_changed_rows_by_time_and_by_epoch_agree(spark, rows):
    df = spark.createDataFrame(SOURCE, STAMPED)
    times = df.where(changed_between(["updated_at", "created_at"], "timestamp", LO, HI))
    assert rows(times, "id") == [(1,), (3,), (6,)]
    seconds = df.select("id", *[
        F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01', {c}_at)").alias(c) for c in ("updated", "created")])
    for lo in (LO, LO.replace(tzinfo=UTC)):
        assert rows(seconds.where(changed_between(["updated", "created"], "integer", lo, HI)), "id") == [(1,), (3,), (6,)]
    with pytest.raises(ValueError):
        changed_between(["updated"], "text", LO, HI)


def test_extract_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(SOURCE, STAMPED).write.parquet(path)
    df = spark.read.parquet(path).where(changed_between(["updated_at", "created_at"], "timestamp", LO, HI))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(updated_at" in plan


def test_choice_of_tables():
    assert choose_tables(["a", "b", "c"], ["b"], "partial") == ["b"]
    assert choose_tables(["a", "b", "c"], ["b"], "full") == ["a", "c"]
    with pytest.raises(ValueError):
        choose_tables([], [], "some")


def test_config_of_a_source_kind():
    config = LoadConfig.for_source("mariadb", "shop", "orders")
    assert (config.timestamp_columns, config.timestamp_column_type, config.upsert_key) == (*CHANGE_STAMPS["mariadb"], "id")


TARGET = [(1, "old", day(2), day(1)), (4, "kept", day(9), day(9)), (3, "newer", day(30), day(11))]
LOADED = [(1, "at lo"), (3, "newer"), (4, "kept"), (6, "created only")]


def test_incremental_load_twice_gives_the_same_target(spark, rows, tmp_path):
    config = LoadConfig.for_source("postgres", "shop", "t")
    source = spark.createDataFrame(SOURCE, STAMPED)
    spark.createDataFrame(TARGET, STAMPED).write.parquet(str(tmp_path / "v1"))
    for version in (1, 2):
        loaded = incremental_load(spark, source, config, LO, HI, str(tmp_path / "stage"),
                                  str(tmp_path / f"v{version}"), str(tmp_path / f"v{version + 1}"))
        assert rows(loaded, "id", "v") == LOADED
    assert rows(spark.read.parquet(str(tmp_path / "stage")), "id") == [(1,), (3,), (6,)]


def test_partitioned_load_rewrites_only_touched_days(spark, rows, tmp_path):
    config = LoadConfig.for_source("postgres", "shop", "t")
    path, created_day = tmp_path / "target", F.to_date("created_at")
    source = spark.createDataFrame(SOURCE, STAMPED).withColumn("d", created_day)
    spark.createDataFrame(TARGET, STAMPED).withColumn("d", created_day).write.partitionBy("d").parquet(str(path))
    untouched = sorted(f.name for f in (path / "d=2024-01-09").iterdir())
    for _ in range(2):
        loaded = incremental_load_partitioned(spark, source, config, LO, HI, str(tmp_path / "stage"), str(path), "d")
        assert rows(loaded, "id", "v") == LOADED
    assert sorted(f.name for f in (path / "d=2024-01-09").iterdir()) == untouched


def test_partitioned_load_keeps_rows_without_a_day(spark, rows, tmp_path):
    """Rows without a creation time share a partition of their own; an update of one keeps the other."""
    config = LoadConfig.for_source("postgres", "shop", "t")
    path, created_day = str(tmp_path / "target"), F.to_date("created_at")
    source = spark.createDataFrame([(7, "new", day(11), None)], STAMPED).withColumn("d", created_day)
    target = spark.createDataFrame([*TARGET, (7, "old", day(1), None), (8, "other", day(1), None)], STAMPED)
    target.withColumn("d", created_day).write.partitionBy("d").parquet(path)
    loaded = incremental_load_partitioned(spark, source, config, LO, HI, str(tmp_path / "stage"), path, "d")
    assert rows(loaded, "id", "v") == [(1, "old"), (3, "newer"), (4, "kept"), (7, "new"), (8, "other")]


def test_load_all_chosen_tables(spark, rows, tmp_path):
    source = spark.createDataFrame(SOURCE, STAMPED)
    for name in ("a", "b"):
        spark.createDataFrame(TARGET, STAMPED).write.parquet(str(tmp_path / "target" / name / "v1"))
    loaded = load_all(spark, lambda name: source, "postgres", "shop", ["a", "b", "c"], ["c"], "full", LO, HI,
                      str(tmp_path / "stage"), str(tmp_path / "target"), "v1", "v2")
    assert sorted(loaded) == ["a", "b"]
    assert all(rows(df, "id", "v") == LOADED for df in loaded.values())


def test_append_goes_by_position_and_replace_is_repeatable(spark, rows, tmp_path):
    spark.sql(f"CREATE TABLE mart_by_position (a INT, b INT) USING parquet LOCATION '{tmp_path / 'mart'}'")
    try:
        swapped = spark.createDataFrame([(1, 2)], "b int, a int")
        append_to_mart(swapped, "mart_by_position")
        append_to_mart(swapped, "mart_by_position")
        assert rows(spark.table("mart_by_position")) == [(1, 2), (1, 2)]
        append_to_mart(swapped, "mart_by_position", mode="replace")
        append_to_mart(swapped, "mart_by_position", mode="replace")
        assert rows(spark.table("mart_by_position")) == [(1, 2)]
        with pytest.raises(ValueError):
            append_to_mart(swapped.select("a"), "mart_by_position")
    finally:
        spark.sql("DROP TABLE mart_by_position")


def test_export_and_stage_replace_what_was_there(spark, rows, tmp_path):
    people = spark.createDataFrame([(2, "b@x"), (1, "a@x"), (3, None)], RECIPIENTS)
    path = str(tmp_path / "sheet")
    write_export(people.limit(1), path)
    write_export(people, path, order=["id"])
    assert rows(read_sheet(spark, path, RECIPIENTS)) == [(1, "a@x"), (2, "b@x"), (3, None)]
    for writer in (write_stage, write_outbox):
        target = str(tmp_path / writer.__name__)
        writer(people.limit(1), target)
        writer(people, target)
        assert read_table(spark, target, RECIPIENTS).count() == 3


def test_sheet_columns_go_by_header(spark, rows, tmp_path):
    (tmp_path / "roles.csv").write_text("note,level,id\nx,1,7\ny,high,8\nz,,9\n")
    assert rows(read_sheet(spark, str(tmp_path), ROLES)) == [(7, 1), (8, None), (9, None)]


def test_query_options_of_a_remote_read():
    plain = query_options("jdbc:x", "SELECT 1", user="u")
    assert plain == {"url": "jdbc:x", "fetchsize": "10000", "user": "u", "query": "SELECT 1"}
    ranged = query_options("jdbc:x", "SELECT id FROM t", "id", (0, 100), 8)
    assert ranged["dbtable"] == "(SELECT id FROM t) q" and ranged["numPartitions"] == "8"
    with pytest.raises(ValueError):
        query_options("jdbc:x", "SELECT id FROM t", "id")


def test_table_from_the_catalog(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert read_table(spark, "three").count() == 3


def test_partitioned_load_refuses_a_moved_row(spark, tmp_path):
    config = LoadConfig.for_source("postgres", "shop", "t")
    path, created_day = str(tmp_path / "target"), F.to_date("created_at")
    source = spark.createDataFrame([(4, "moved", day(11), day(8))], STAMPED).withColumn("d", created_day)
    spark.createDataFrame(TARGET, STAMPED).withColumn("d", created_day).write.partitionBy("d").parquet(path)
    with pytest.raises(ValueError, match="d changed"):
        incremental_load_partitioned(spark, source, config, LO, HI, str(tmp_path / "stage"), path, "d")


def test_partitioned_load_prunes_the_target_at_run_time(spark, tmp_path, plan_of):
    path = str(tmp_path / "target")
    spark.range(200).selectExpr("id", "CAST(id % 20 AS INT) AS d").write.partitionBy("d").parquet(path)
    staged = spark.createDataFrame([(1, 3), (2, 3), (3, 5)], "id long, d int")
    got = touched_rows(spark.read.parquet(path), staged, "d")
    assert "dynamicpruning" in plan_of(got).lower() and got.count() == 20


ODD_CELLS = [(1, " pad "), (2, "a\nb"), (3, ""), (4, None), (5, 'q"x'), (6, "\\N"), (7, "a\r\nb, c"), (8, "\\"), (None, '"'),
             (10, "\t"), (11, 'x\\"y'), (12, "\\\\N"), (13, "#c")]


def test_exported_cells_come_back_as_they_were(spark, rows, tmp_path):
    df = spark.createDataFrame(ODD_CELLS, RECIPIENTS)
    for order in (None, ["id"]):
        write_export(df, str(tmp_path / "sheet"), order)
        assert rows(read_sheet(spark, str(tmp_path / "sheet"), RECIPIENTS)) == rows(df)
