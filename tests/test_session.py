import pytest

from clickweave.session import shared_dir


class _Conf:
    def get(self, key, default=None):
        return default


class _SC:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return _Conf()


class _Session:
    def __init__(self, master):
        self.conf = _Conf()
        self.sparkContext = _SC(master)


def test_no_machine_local_fallback_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("yarn"))


def test_work_folder_comes_from_the_session(spark):
    d = shared_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_stage_tables_are_removed_and_file_uris_work(spark, tmp_dir, monkeypatch):
    import os

    from clickweave import session
    from clickweave.plans.materialize import materialized

    monkeypatch.setattr(session, "shared_dir", lambda spark: f"file:{tmp_dir}")
    assert session.materialize(spark.range(5), "five").count() == 5
    built = []

    def write(path):
        built.append(path)
        spark.range(3).write.parquet(path)

    spark.range(1).write.parquet(f"{tmp_dir}/in/t.parquet")
    first = materialized(spark, f"{tmp_dir}/in", "tree", ("t",), write)
    assert materialized(spark, f"file://{tmp_dir}/in", "tree", ("t",), write) == first == built[0] and len(built) == 1
    spark.range(9).write.mode("overwrite").parquet(f"{tmp_dir}/in/t.parquet")
    assert materialized(spark, f"{tmp_dir}/in", "tree", ("t",), write) != first  # changed input, new build
    session.remove_stage_tables(spark)
    assert not os.path.exists(f"{tmp_dir}/clickweave/{spark.sparkContext.applicationId}")
    assert spark.read.parquet(first).count() == 3


def test_scratch_removes_what_was_written_inside(spark):
    import os

    from clickweave.session import materialize, scratch, work_path

    kept = work_path(spark, "result", unique=True)
    with scratch(spark):
        inner = materialize(spark.range(5), "inside")
        inside = [f.removeprefix("file://") for f in inner.inputFiles()]
        with scratch(spark):
            assert materialize(spark.range(2), "deeper").count() == 2
        inner.write.parquet(kept)
    assert inside and not any(os.path.exists(f) for f in inside)
    assert spark.read.parquet(kept).count() == 5
    after = materialize(spark.range(3), "after")
    assert "scratch-" not in after.inputFiles()[0] and after.count() == 3
