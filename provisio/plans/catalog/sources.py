"""Scans and sinks: the test tables written to the shared folder and read back."""

from pyspark.sql import functions as F

from provisio.operators import cleaning as C
from provisio.operators import features as X
from provisio.operators import models as MD
from provisio.operators import woe as W
from provisio.operators.scoring import TIER_BINS
from provisio.plans.catalog import metrics as MQ
from provisio.plans.catalog import training as TQ
from provisio.plans.catalog import woe as WQ
from provisio.plans.catalog.registry import query
from provisio.session import new_path
from provisio.sources import readers as R
from provisio.sources import state as ST
from provisio.sources import warehouse as DW
from provisio.sources import writers as WR


def _csv(v, df, name, encoding="UTF-8"):
    path = new_path(v.spark, name)
    df.write.option("header", True).option("encoding", encoding).csv(path)
    return path


_SEGMENT = "select name_contract_type, count(*) as row_count, count(amt_annuity) as annuities, sum(amt_credit) as credit from px_application group by 1"


def _segment(df):
    return df.groupBy("name_contract_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("amt_annuity").alias("annuities"), F.sum("amt_credit").alias("credit")
    )


@query("src01_csv_scan", _SEGMENT, {"credit": 2})
def _(v):
    path = _csv(v, v.application, "application")
    return _segment(R.read_csv(v.spark, path, v.application.schema))


@query("src01_csv_inferred", _SEGMENT, {"credit": 2})
def _(v):
    return _segment(R.read_csv(v.spark, _csv(v, v.application, "application")))


@query(
    "src02_csv_narrow_types",
    """select sk_id_prev, num_instalment_number, cast(cast(amt_instalment as float) as double) as amt_instalment from px_installments""",
)
def _(v):
    path = _csv(v, v.instalments.select("sk_id_prev", "num_instalment_number", "amt_instalment"), "instalments")
    df = R.read_csv(v.spark, path, "sk_id_prev long, num_instalment_number int, amt_instalment float")
    return df.withColumn("amt_instalment", F.col("amt_instalment").cast("double"))


@query("src03_csv_columns", "select sk_id_bureau, days_credit from px_bureau")
def _(v):
    return R.read_csv(v.spark, _csv(v, v.bureau, "bureau"), v.bureau.schema, columns=["sk_id_bureau", "days_credit"])


@query(
    "src04_csv_latin1",
    "select n_nationkey, n_name || ' é' as label from nation",
)
def _(v):
    df = v.table("nation").select("n_nationkey", F.concat("n_name", F.lit(" é")).alias("label"))
    return R.read_csv(v.spark, _csv(v, df, "nation", "ISO-8859-1"), "n_nationkey int, label string", encoding="ISO-8859-1")


@query(
    "src05_column_descriptions",
    """select n_name as "column", case when n_nationkey < 20 then 'nation ' || cast(n_nationkey as varchar) else 'not found' end as description from nation""",
)
def _(v):
    nation = v.table("nation")
    dictionary = nation.filter("n_nationkey < 20").select(
        "n_nationkey", "n_name", F.lit("t").alias("table"), F.lit("r").alias("row"),
        F.concat(F.lit("nation "), F.col("n_nationkey").cast("string")).alias("text"),
    )
    names = nation.select(F.col("n_name").alias("column"))
    return R.describe_columns(names, R.column_descriptions(dictionary))


@query("src06_parquet_scan", "select l_returnflag, count(*) as row_count, sum(l_quantity) as quantity from lineitem group by 1")
def _(v):
    df = R.read_table(v.spark, f"{v.folder}/lineitem.parquet")
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("row_count"), F.sum("l_quantity").alias("quantity"))


@query("src07_parquet_columns", "select o_orderkey, o_totalprice from orders where o_totalprice > 300000")
def _(v):
    return R.read_table(v.spark, f"{v.folder}/orders.parquet", ["o_orderkey", "o_totalprice"]).filter("o_totalprice > 300000")


@query("snk01_parquet_write", "select count(*) as row_count, 3 as column_count from px_scored")
def _(v):
    df = v.scored.select("sk_id_curr", "target", "pred_prob")
    return WR.write_table(df, new_path(v.spark, "scored")).select("row_count", "column_count")


@query("snk02_versioned_stages", "select stage, count(*) as loan_count from px_loan_base group by 1")
def _(v):
    from provisio.operators.credit_loss import classify_stage
    root = new_path(v.spark, "results")
    scored = WR.write_version(v.scored, root, "scored")
    staged = WR.write_version(classify_stage(scored), root, "ecl")
    return staged.groupBy("stage").agg(F.count(F.lit(1)).alias("loan_count"))


@query("snk03_csv_report", "select stage, count(*) as loan_count, sum(ead) as ead from px_loans group by 1", {"ead": 1})
def _(v):
    path = new_path(v.spark, "report")
    WR.write_report(v.loans.groupBy("stage").agg(F.count(F.lit(1)).alias("loan_count"), F.sum("ead").alias("ead")), path)
    return R.read_csv(v.spark, path, "stage int, loan_count long, ead double")


@query("snk04_submission", "select cast(sk_id_curr as integer) as SK_ID_CURR, pred_prob as TARGET from px_scored", {"TARGET": 9})
def _(v):
    path = new_path(v.spark, "submission")
    WR.write_submission(v.scored, path)
    return R.read_csv(v.spark, path, "SK_ID_CURR int, TARGET double")


@query("snk05_state_json", "select feature, bin, woe from px_woe", {"woe": 8})
def _(v):
    path = new_path(v.spark, "weights")
    WR.write_weights(W.fit_woe(WQ.train(v), WQ.FEATURES)[1], path)
    return R.read_state(v.spark, path)


@query("snk05_fitted_state", "select doc_id as sk_id_curr, true as is_same, true as is_scored from documents join labels using (doc_id)")
def _(v):
    """Fits a scorecard with all its parts, stores it, and scores with what is read back."""
    df, inputs = TQ.frame(v), TQ.X
    holes = df.withColumn("digits", F.when(F.col("sk_id_curr") % 7 != 3, F.col("digits")))
    medians = X.fit_median(holes, ["digits"])
    ready = X.apply_median(holes, medians)
    bins, weights = W.fit_woe(ready, inputs)
    folded = MD.assign_folds(W.apply_woe(ready, bins, weights), 3)
    features = [f"{c}_woe" for c in inputs]
    models = MD.fit_folds(folded, MD.logistic, features, 3)
    calibrator = MD.fit_isotonic(MD.oof_scores(folded, models, features))
    state = ST.FittedState(features, medians, {}, {}, bins, list(TIER_BINS), models, weights, None, calibrator)
    path = new_path(v.spark, "state")
    ST.write_state(v.spark, state, path)
    direct = state.score(holes).select("sk_id_curr", F.col("pd_raw").alias("a"), F.col("pd_calibrated").alias("b"))
    stored = ST.read_state(v.spark, path).score(holes).select("sk_id_curr", "pd_raw", "pd_calibrated")
    return direct.join(stored, "sk_id_curr").select(
        "sk_id_curr", ((F.col("a") == F.col("pd_raw")) & (F.col("b") == F.col("pd_calibrated"))).alias("is_same"),
        F.col("pd_calibrated").between(0.001, 0.999).alias("is_scored"))


@query(
    "cln17_gated_write",
    """select 'days_birth' as "column", 0::bigint as missing, count(*) as row_count from px_application
    union all select 'amt_goods_price', 0, count(*) from px_application union all select 'name_income_type', 0, count(*) from px_application""",
)
def _(v):
    """Cleaned applicants; the gate behind the write counts gaps from the footers of the files."""
    cols, path = ["days_birth", "amt_goods_price", "name_income_type"], new_path(v.spark, "gated")
    WR.write_table(C.clean_application(v.application, C.fit_application(v.application)).select("sk_id_curr", *cols), path)
    C.require_written(v.spark, path, cols)
    rows, missing = C.written_gaps(v.spark, path, cols)
    return v.spark.createDataFrame([(c, n, rows) for c, n in missing.items()], "column string, missing long, row_count long")


@query(
    "snk06_metrics_json",
    """select model, metric, value from (unpivot (select model, oof_auc, gini, ks_pct, brier from px_leaderboard) on oof_auc, gini, ks_pct, brier into name metric value value)""",
    {"value": 5},
)
def _(v):
    path = new_path(v.spark, "metrics")
    WR.write_metrics(MQ._board(v), path)
    return R.read_metrics(v.spark, path)


def _typed(v):
    a = v.application
    return a.select(
        "sk_id_curr", "target", (1 - F.col("is_train")).alias("is_test"), "name_contract_type", "amt_credit",
        "amt_income_total", "code_gender", "days_birth", "name_income_type", "name_education_type",
    )


@query(
    "snk08_warehouse_tables",
    """select cast(is_test as integer) as is_test, count(*) as row_count, sum(amt_credit) as credit, cast(sum(case when sk_id_curr is null then 1 else 0 end) as bigint) as emp_anomaly
    from px_wh_application group by 1""",
    {"credit": 2},
)
def _(v):
    path = new_path(v.spark, "warehouse")
    prefix = f"w{path[-12:]}_"
    DW.create_tables(v.spark, path, prefix)
    DW.append_table(_typed(v), f"{prefix}raw.application")
    return v.spark.table(f"{prefix}raw.application").groupBy(F.col("is_test").cast("int").alias("is_test")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amt_credit").cast("double").alias("credit"),
        F.sum("emp_anomaly").alias("emp_anomaly"),
    )


@query(
    "snk09_append",
    """select name_income_type, name_education_type, code_gender, 2 * count(*) as applicant_count, cast(2 * sum(target) as bigint) as default_count
    from px_wh_application where is_test = 0 group by 1, 2, 3""",
)
def _(v):
    path = new_path(v.spark, "warehouse")
    prefix = f"w{path[-12:]}_"
    DW.create_tables(v.spark, path, prefix)
    for _ in range(2):
        DW.append_table(_typed(v), f"{prefix}raw.application")
    view = DW.create_views(v.spark, prefix)[0]
    return v.spark.table(view).select(
        "name_income_type", "name_education_type", "code_gender", "applicant_count", "default_count"
    )


@query(
    "sca18_json_maps",
    """select c_mktsegment, sum(c_acctbal) as total from customer group by 1""",
    {"total": 3},
)
def _(v):
    totals = v.table("customer").groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("total"))
    encoded = totals.select("c_mktsegment", F.to_json(F.create_map("c_mktsegment", "total")).alias("j"))
    decoded = F.from_json("j", "map<string,double>")
    return encoded.select("c_mktsegment", decoded[F.col("c_mktsegment")].alias("total"))


