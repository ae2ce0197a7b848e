from datetime import date

import pytest
from pyspark.sql import functions as F

from valuekit.operators.encode import fit_dictionary
from valuekit.operators.scoring import Window, scored_pairs
from valuekit.operators.training import fit_gbt
from valuekit.plans import batch
from valuekit.sources import readers, writers


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(i, date(2001, 1 + i % 3, 28), f"p{i % 2}", float(i)) for i in range(30)], "id int, d date, Product string, x double")


def test_parquet_round_trip_and_completion(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    assert not writers.output_complete(spark, path)
    writers.write_parquet(frame, path, files=2)
    assert writers.output_complete(spark, path) and writers.folder_bytes(spark, path) > 0
    assert sorted(spark.read.parquet(path).collect()) == sorted(frame.collect())
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 2
    writers.write_sized(frame, str(tmp_path / "sized"), target_mb=16)
    assert len(list((tmp_path / "sized").glob("*.parquet"))) == 1
    assert sorted(spark.read.parquet(str(tmp_path / "sized")).collect()) == sorted(frame.collect())


def test_read_mart_prunes_partitions(spark, tmp_path):
    rows = [(i, float(i), date(2001, m, [31, 28, 31, 30][m - 1])) for m in (1, 2, 3, 4) for i in range(5)]
    spark.createDataFrame(rows, "epk_id int, x double, report_dt_part date").write.partitionBy("report_dt_part").parquet(str(tmp_path / "m"))
    got = readers.read_mart(spark, str(tmp_path / "m"), date(2001, 3, 31), 2, ["epk_id", "x"], month="report_dt_part")
    assert {r["report_dt_part"] for r in got.collect()} == {date(2001, 2, 28), date(2001, 3, 31)}
    assert "report_dt_part" in got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def test_partitioned_table(spark, frame):
    writers.write_partitioned_table(frame, "vk_targets", "Product")
    assert writers.table_exists(spark, "vk_targets")
    assert sorted(readers.read_table(spark, "vk_targets").select("id", "Product").collect()) == sorted(frame.select("id", "Product").collect())
    assert "Product=" in str(writers.table_location(spark, "vk_targets")) or readers.read_table(spark, "vk_targets").where("Product = 'p1'").count() == 15
    writers.drop_table(spark, "vk_targets", files=True)
    assert not writers.table_exists(spark, "vk_targets")


def test_save_and_register(spark, frame, tmp_path):
    path = str(tmp_path / "s")
    assert writers.save_and_register(frame, "vk_saved", path) == "written"
    assert writers.save_and_register(frame, "vk_saved", path) == "kept"
    writers.drop_table(spark, "vk_saved")
    assert writers.save_and_register(frame, "vk_saved", path) == "registered"
    assert dict(readers.read_table(spark, "vk_saved").dtypes)["d"] == "timestamp"
    writers.drop_table(spark, "vk_saved")


def test_staging_load(spark, frame):
    spark.sql("DROP TABLE IF EXISTS vk_target")
    frame.write.saveAsTable("vk_target")
    writers.load_through_staging(frame, "vk_target", "vk_stage")
    assert spark.table("vk_target").count() == 60 and not writers.table_exists(spark, "vk_stage")
    writers.drop_table(spark, "vk_target")


def test_snapshots_by_shape(spark, frame, tmp_path):
    folder = str(tmp_path)
    assert writers.save_snapshot(frame, folder, "snap") == 1
    assert writers.save_snapshot(frame.orderBy(F.desc("id")), folder, "snap") is None
    assert writers.save_snapshot(frame.withColumn("x", F.col("x") + 1), folder, "snap") == 2
    assert writers.save_snapshot(frame.withColumn("z", F.lit(1)), folder, "snap") == 3
    assert writers.save_snapshot(frame.where("id > 3"), folder, "snap") == 4


def test_eval_sets(spark, frame, tmp_path):
    df = frame.withColumn("sample", F.when(F.col("id") < 20, "train").otherwise("OOT"))
    writers.save_eval_sets(df, str(tmp_path / "e"))
    sets = writers.read_eval_sets(spark, str(tmp_path / "e"), "x")
    assert list(sets) == ["train", "OOT"] and sets["train"][0].count() == 20 and sets["OOT"][1].columns == ["x"]


def test_delimited_and_samples(spark, tmp_path):
    (tmp_path / "pairs.csv").write_text("BP;priority;cc\npl;1;1\ndc;;0\n")
    assert [tuple(r) for r in readers.read_delimited(spark, str(tmp_path / "pairs.csv")).collect()] == [("pl", "1", "1"), ("dc", None, "0")]
    typed = readers.read_delimited(spark, str(tmp_path / "pairs.csv"), schema="BP string, priority int, cc int")
    assert dict(typed.dtypes)["priority"] == "int"
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    spark.range(2).select(F.col("id").alias("x")).write.parquet(str(tmp_path / "b.parquet"))
    both = readers.read_samples(spark, {"train": str(tmp_path / "a.csv"), "OOT": str(tmp_path / "b.parquet")})
    assert both.groupBy("sample").count().count() == 2 and both.count() == 3
    assert readers.read_sample(spark, "SELECT 1 AS x").first()["x"] == 1


def test_tables_by_pattern(spark, frame):
    frame.write.mode("overwrite").saveAsTable("vk_feature_12_train")
    got = [tuple(r) for r in readers.list_tables(spark, "default", "vk_feature_*").collect()]
    assert got == [("vk_feature_12_train", 12)]
    text = frame.select(F.col("x").cast("string").alias("x"), "Product")
    text.write.mode("overwrite").saveAsTable("vk_feature_text")
    assert dict(readers.read_table_with_numbers(spark, "vk_feature_text").dtypes) == {"x": "double", "Product": "string"}
    for name in ("vk_feature_12_train", "vk_feature_text"):
        writers.drop_table(spark, name)


def test_warehouse_options():
    plain = readers.jdbc_options("jdbc:x", "select 1")
    assert plain["query"] == "select 1" and "partitionColumn" not in plain
    cut = readers.jdbc_options("jdbc:x", "select * from t", partition="id", bounds=(0, 99), partitions=4)
    assert cut["dbtable"] == "(select * from t) q" and cut["numPartitions"] == "4" and "query" not in cut
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "q", partition="id")
    assert writers.staging_statements("t", "s") == ("INSERT INTO t SELECT * FROM s", "DROP TABLE s")


def test_batch_run_is_restartable(spark, tmp_path):
    months = [date(2001, 4, 30), date(2001, 5, 31), date(2001, 6, 30)]
    rows = [(i, m, float(i % 9), i % 2, "A B" if i % 3 else "c") for i in range(60) for m in months]
    data = spark.createDataFrame(rows, "epk_id int, report_dt_part date, x_amt double, cc int, seg_cd string")
    codes = fit_dictionary(data.withColumn("seg_cd", F.lower(F.replace("seg_cd", F.lit(" "), F.lit("")))), ["seg_cd"])
    options = {"key": "epk_id", "month": "report_dt_part", "categorical": ["seg_cd"], "features": ["x_amt", "cc", "seg_cd"], "averaged": ["x_amt"], "horizons": (3,)}
    folder = str(tmp_path / "run")
    first = batch.build_dataset(data, codes, folder, months[-1], **options)
    assert first.count() == 60 and set(first.columns) == {"epk_id", "x_amt", "cc", "seg_cd", "x_amt_3a"}
    assert {r[0] for r in first.select("seg_cd").distinct().collect()} == {0, 1}

    # An interrupted encoding: a third is missing, the rerun adds exactly that.
    path = f"{folder}/slice_{months[-1]}_encoded"
    kept = first.where("epk_id < 40").collect()
    writers.write_parquet(spark.createDataFrame(kept, first.schema), path)
    again = batch.build_dataset(data, codes, folder, months[-1], **options)
    assert again.count() == 60 and again.select("epk_id").distinct().count() == 60

    sample = again.withColumn("T", F.col("epk_id") % 3).withColumn("y", (F.col("x_amt") > 4).cast("int")).withColumn("sample", F.when(F.col("epk_id") % 4 == 0, "valid").otherwise("train"))
    model = fit_gbt(sample, ["x_amt", "T", "cc"], "y", maxIter=2, maxDepth=2)
    run = lambda: batch.score_dataset(again, {("cc", "pl"): model}, {("cc", "pl"): Window(1, 3)}, f"{folder}/scores", key="epk_id", date_text="2001")
    assert [r["status"] for r in run()] == ["scored"] and [r["status"] for r in run()] == ["skipped"]
    table = spark.read.parquet(f"{folder}/scores/uplifts_cc_pl_2001")
    assert [tuple(r) for r in scored_pairs(spark, [table], "epk_id").collect()] == [("cc", "pl")]
