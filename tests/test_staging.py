from pathlib import Path

import pytest

from spinmart.operators import staging


def test_staged_table_equals_its_source_and_cuts_the_lineage(spark, plan_of):
    df = spark.range(100).selectExpr("id % 7 AS k", "CASE WHEN id > 50 THEN id END AS v", "TIMESTAMP_NTZ '2024-01-01' AS t")
    staged = staging.stage(df.groupBy("k", "t").sum("v"))
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, df.groupBy("k", "t").sum("v").collect()))
    assert "Exchange" not in plan_of(staged) and "Scan parquet" in plan_of(staged)


def test_staged_tables_lie_in_the_folder_the_session_names(spark):
    path = staging.staging_path(spark, "label")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert spark.conf.get("spark.app.id") in path


class Settings:
    def __init__(self, **values):
        self.values = values
        self.conf = self

    def get(self, name, default=None):
        return self.values.get(name.replace(".", "_"), default)


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(RuntimeError):
        staging.staging_root(Settings(spark_master="yarn"))
    with pytest.raises(RuntimeError):
        staging.staging_root(Settings(spark_master="local-cluster[2,1,1024]"))
    assert staging.staging_root(Settings(spark_master="yarn", spark_checkpoint_dir="hdfs://x/ck/")) == "hdfs://x/ck"
    assert Path(staging.staging_root(Settings(spark_master="local[2]"))).is_dir()


def test_clear_deletes_only_this_application(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda session: str(tmp_path))
    (tmp_path / "other").mkdir()
    staging.stage(spark.range(3))
    staging.clear_staged(spark)
    assert [f.name for f in tmp_path.iterdir()] == ["other"]


def test_a_job_clears_its_own_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda session: str(tmp_path))
    kept = staging.stage(spark.range(3))
    with pytest.raises(ZeroDivisionError), staging.staged_for(spark, "outer"):
        outer = staging.stage(spark.range(4))
        with staging.staged_for(spark, "inner"):
            assert staging.stage(spark.range(5)).count() == 5
        assert outer.count() == 4
        raise ZeroDivisionError
    (folder,) = tmp_path.iterdir()
    assert len(list(folder.iterdir())) == 1 and kept.count() == 3
