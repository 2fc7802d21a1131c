import pytest
from pyspark.sql import functions as F

from provisio import session
from provisio.plans.catalog import scoring as SQ
from provisio.plans.proxy import Views
from provisio.sources import readers as R
from provisio.sources import schemas
from provisio.sources import warehouse as DW
from provisio.sources import writers as WR
from provisio.streaming import scoring as ST

FOLDER = "/root/testdata/sf0.001"


class Settings:
    """Stands for a session of which only the settings are read."""

    def __init__(self, master, **conf):
        self.conf = self.sparkContext = self
        self.master, self.values = master, conf

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)


def test_shared_folder_is_the_one_the_cluster_names():
    named = Settings("yarn", spark_checkpoint_dir="hdfs://shared/work/")
    assert session.new_path(named, "x").startswith("hdfs://shared/work/provisio/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Settings("yarn"))


def test_column_subset_reaches_the_csv_reader(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.range(5).select("id", (F.col("id") * 2).alias("b")).write.option("header", True).csv(path)
    df = R.read_csv(spark, path, "id long, b long", columns=["b"])
    assert "ReadSchema: struct<b:bigint>" in df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_parquet(spark):
    df = R.read_table(spark, f"{FOLDER}/orders.parquet", ["o_orderkey", "o_totalprice"]).filter("o_totalprice > 300000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,300000.0)" in plan and "o_custkey" not in plan


def test_read_first(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(3).write.parquet(path)
    assert R.read_first(spark, [str(tmp_path / "none"), path]).count() == 3
    with pytest.raises(FileNotFoundError):
        R.read_first(spark, [str(tmp_path / "none")])


def test_scan_schemas_follow_the_tables():
    assert len(schemas.TABLES) == 8
    narrow = schemas.scan_schema("raw.installments_payments", narrow=True)
    assert narrow["amt_payment"].dataType.simpleString() == "float"
    assert sum(f.name.startswith("flag_document_") for f in schemas.table_schema("raw.application")) == 20


def test_warehouse_defaults_and_type_checks(spark, tmp_path):
    DW.create_tables(spark, str(tmp_path), "t1_")
    rows = spark.createDataFrame([(1, 0.5, "Low")], "sk_id_curr int, default_probability double, risk_tier string")
    DW.append_table(rows, "t1_model.predictions")
    row = spark.table("t1_model.predictions").first()
    assert row["model_version"] == "lgbm_v1" and row["predicted_at"] is not None and row["stage"] is None
    too_big = rows.withColumn("default_probability", F.lit(1e9))
    with pytest.raises(Exception, match="(?i)overflow|precision|NUMERIC_VALUE_OUT_OF_RANGE"):
        DW.append_table(too_big, "t1_model.predictions")
    assert spark.table("t1_model.predictions").count() == 1
    assert len(DW.create_views(spark, "t1_")) == 2


def test_feature_list(spark, tmp_path):
    path = str(tmp_path / "features")
    WR.write_feature_list(spark, ["a", "b"], [("b", 0.5)], path)
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert lines[0] == "Total features: 2" and lines[-1] == "  b" and "   1. b: 0.5000" in lines


def test_stream_and_batch_score_alike(spark, tmp_path):
    v = Views(spark, FOLDER)
    path = str(tmp_path / "in")
    SQ.requests(v).drop("extra_features").repartition(3).write.parquet(path)
    batch = spark.read.parquet(path)
    medians = {"ext_source_2": 0.5, "amt_credit": 2e5, "credit_income_ratio": 3.0}
    stream = ST.read_applicants(spark, path, batch.schema, max_files=1)
    out = str(tmp_path / "out")
    ST.write_stream(ST.score_stream(stream, medians, SQ.scorer), out, str(tmp_path / "log")).awaitTermination()
    from provisio.operators.scoring import score_batch
    expected = score_batch(batch, medians, SQ.scorer)
    got = spark.read.parquet(out).select(*expected.columns)
    assert got.count() == expected.count() > 0
    assert expected.filter("risk_tier = 'Unknown'").count() > 0  # invalid applicants are reported, with their reasons
    assert got.exceptAll(expected).count() == 0
