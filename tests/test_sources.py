import os

import pytest
from pyspark.sql import functions as F

from hitframe import session, sources
from hitframe.sources import stages


def test_padded_maps(spark, tmp_path):
    f = tmp_path / "w.csv"
    f.write_text("id,femId,ch\n32 ,  616,  0\n0  ,  616,  1\n")
    df = sources.read_wire_map(spark, {"dc31": str(f), "dc32": str(f)})
    assert dict(df.dtypes) == {"id": "int", "femId": "int", "ch": "int", "detector": "string"}
    assert sorted(map(tuple, df.where("detector = 'dc31'").collect())) == [(0, 616, 1, "dc31"), (32, 616, 0, "dc31")]
    g = tmp_path / "s.csv"
    g.write_text("id,ch\n31,32\n30,33\n")
    assert sorted(map(tuple, sources.read_strip_map(spark, {"x": str(g)}).collect())) == [(30, 33, "x"), (31, 32, "x")]


def test_linear_calibration_file(spark, tmp_path):
    f = tmp_path / "c.csv"
    f.write_text("id,p1,p0\n0,0.5,-0.25\n")
    assert [tuple(r) for r in sources.read_linear_calibration(spark, {"x": str(f)}).collect()] == [(0, 0.5, -0.25, "x")]


def test_curve_files_take_plane_and_run_from_the_name(spark, tmp_path):
    for plane in ("p1", "p2"):
        (tmp_path / f"{plane}_drift_run7.csv").write_text("histy_x,tx\n-1.5,0.25\n-0.5,1.0\n")
    df = sources.read_curve_files(spark, str(tmp_path), r"^(.*)_drift_(run\d+)\.csv$")
    assert sorted(map(tuple, df.collect())) == [
        (-1.5, 0.25, "run7", "p1"),
        (-1.5, 0.25, "run7", "p2"),
        (-0.5, 1.0, "run7", "p1"),
        (-0.5, 1.0, "run7", "p2"),
    ]


def test_curves_round_trip_and_replace_one_run(spark, tmp_path):
    path = str(tmp_path / "curves")
    rows = [("r1", "a", 0.1, 0.5), ("r1", "a", 0.3, 1.0), ("r2", "a", 0.1, 1 / 3)]
    df = spark.createDataFrame(rows, "run string, plane string, x double, tx double")
    sources.write_curves(df, path)
    back = sources.read_curves(spark, path).select(*df.columns)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    sources.write_curves(spark.createDataFrame([("r1", "a", 0.2, 1.0)], df.schema), path)
    back = sources.read_curves(spark, path).select(*df.columns)
    assert sorted(map(tuple, back.collect())) == [("r1", "a", 0.2, 1.0), ("r2", "a", 0.1, 1 / 3)]


def test_mode_table_round_trip(spark, tmp_path):
    path = str(tmp_path / "modes")
    rows = [(0, 68, "s1", 0.25), (1, 92, "s1", 0.25), (0, 70, "s1", 0.5)]
    df = spark.createDataFrame(rows, "id int, mode_bin int, setting string, pulse_pc double")
    sources.write_mode_table(df, path)
    assert sorted(map(tuple, sources.read_mode_table(spark, path).collect())) == sorted(rows)


def test_stage_replaces_only_its_run(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.range(3)
    sources.write_stage(df, path, "run1")
    sources.write_stage(df, path, "run2")
    sources.write_stage(df.where("id < 1"), path, "run1")
    assert sources.read_stage(spark, path, "run1").count() == 1
    assert sources.read_stage(spark, path).count() == 4
    plan = sources.read_stage(spark, path, "run2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(runname" in plan


def test_blocks_keep_valid_ones(spark, tmp_path):
    from hitframe import schemas

    path = str(tmp_path / "blocks")
    rows = [(0, 5, 616, ((1,), [])), (3, 5, 616, ((1,), [(1, 2, 3)]))]
    spark.createDataFrame(rows, schemas.BLOCKS).write.parquet(path)
    df = sources.read_blocks(spark, path)
    assert [r.tfId for r in df.collect()] == [3]
    plan = df.where("femType = 5 and femId in (616, 617)").select("decoded.hbf.hbfNumber")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(tfId,0)" in text and "EqualTo(femType,5)" in text and "In(femId" in text
    assert "data" not in text.split("ReadSchema:")[1]


def test_suffix_selection_and_run_union(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "frame_id int, a_pos_x int, a_ins_x int, b_y int")
    assert sources.select_by_suffix(df, ("frame_id",), ("_pos_x", "_y")).columns == ["frame_id", "a_pos_x", "b_y"]
    runs = sources.union_runs({"r1": df, "r2": df.select(*reversed(df.columns))})
    assert sorted(r.runname for r in runs.where(F.col("b_y") == 4).collect()) == ["r1", "r2"]
    assert sources.preview(runs, 1).count() == 1


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = session.scratch_path(spark, "t"), session.scratch_path(spark, "t")
    assert a != b and a.startswith(session.shared_folder(spark))


class Settings(dict):
    """The part of a session that the folder is read from."""

    @property
    def conf(self):
        return self


def test_shared_folder_is_always_a_setting():
    warehouse = {"spark.sql.warehouse.dir": "file:/data/warehouse"}
    assert session.shared_folder(Settings(warehouse)) == "file:///data/warehouse/_scratch"
    named = Settings(warehouse | {"spark.checkpoint.dir": "hdfs://name/shared/"})
    assert session.shared_folder(named) == "hdfs://name/shared"


def test_scratch_tables_can_be_dropped(spark, tmp_path):
    mark = session.scratch_mark(spark)
    df = stages.materialise(spark.range(5).toDF("n"), "gone")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    session.drop_scratch(spark, mark)
    assert not os.path.exists(path) and session.scratch_mark(spark) == mark


def test_curve_file_without_a_run_in_its_name_is_an_error(spark, tmp_path):
    from pyspark.errors import PySparkException

    (tmp_path / "curves").mkdir()
    (tmp_path / "curves" / "x1_run7.csv").write_text("histy_x,tx\n1.0,0.5\n")
    found = lambda: sources.read_curve_files(spark, str(tmp_path / "curves"), r"(\w+)_run(\d+)")
    assert [tuple(r) for r in found().collect()] == [(1.0, 0.5, "7", "x1")]
    (tmp_path / "curves" / "other.csv").write_text("histy_x,tx\n1.0,0.5\n")
    with pytest.raises(PySparkException, match="no plane and run"):
        found().collect()
