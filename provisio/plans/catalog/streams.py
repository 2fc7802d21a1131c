"""Streaming queries: file source to file sink over the test tables."""

from pyspark.sql import functions as F

from provisio.plans.catalog import scoring as SQ
from provisio.plans.catalog.registry import PARTS, query
from provisio.session import new_path
from provisio.streaming import drift, scoring

_TIER = SQ._tier_sql("p")


@query(
    "str01_score_stream",
    f"""with r as (select o_orderkey as sk_id_curr, ((o_orderkey*73) % 1013)/1013e0 as ext_source_2, o_totalprice as amt_credit, 2e5 as amt_income_total from orders),
    s as (select *, 0.9e0 - 0.8e0 * ext_source_2 + 0.01e0 * (amt_credit / (amt_income_total + 1e-6)) as raw from r),
    c as (select *, least(greatest(raw, 0.001e0), 0.999e0) as p from s)
    select sk_id_curr, round_even(raw, 6) as pd_raw, round_even(p, 6) as pd_calibrated, {_TIER} as risk_tier, round_even(p * 0.65e0 * amt_credit, 2) as ecl_estimate from c""",
    {"pd_raw pd_calibrated": 6, "ecl_estimate": 2},
)
def _(v):
    schema = v.table("orders").schema
    orders = scoring.read_applicants(v.spark, v.folder, schema, "orders.parquet")
    applicants = orders.select(
        F.col("o_orderkey").alias("sk_id_curr"), (((F.col("o_orderkey") * 73) % 1013) / 1013.0).alias("ext_source_2"),
        F.col("o_totalprice").alias("amt_credit"), F.lit(2e5).alias("amt_income_total"),
    )
    medians = {"ext_source_2": 0.5, "credit_income_ratio": 3.0, "amt_credit": 5e5}
    out = new_path(v.spark, "scores")
    scored = scoring.score_stream(applicants, medians, SQ.scorer)
    scoring.write_stream(scored, out, new_path(v.spark, "scores-log")).awaitTermination()
    return v.spark.read.parquet(out).select("sk_id_curr", "pd_raw", "pd_calibrated", "risk_tier", "ecl_estimate")


PARTS["px_drift_base"] = "select value from events where event_type <> 'error'"
_EDGES = ", ".join(f"quantile_cont(value, {i / 10}) as e{i}" for i in range(1, 10))
_BIN = " + ".join(f"case when value > e{i} then 1 else 0 end" for i in range(1, 10))


@query(
    "str02_drift_stream",
    f"""with e as (select {_EDGES} from px_drift_base),
    b as (select bin, count(*) / sum(count(*)) over () as s from (select {_BIN} as bin from px_drift_base, e) group by bin),
    w as (select date_trunc('day', ts) as window_start, {_BIN} as bin from events, e),
    c as (select window_start, bin, count(*) as n from w group by 1, 2),
    t as (select window_start, sum(n) as n from c group by 1),
    p as (select t.window_start, t.n as row_count, greatest(b.s, 1e-4) as s, greatest(coalesce(c.n, 0) / t.n, 1e-4) as o
      from t cross join b left join c on c.window_start = t.window_start and c.bin = b.bin),
    r as (select window_start, window_start + interval 1 day as window_end, cast(any_value(row_count) as bigint) as row_count, sum((o - s) * ln(o / s)) as psi from p group by 1)
    select *, case when psi > 0.25 then 'shift' when psi > 0.10 then 'watch' else 'stable' end as alert from r
    where window_end <= (select max(ts) from events) - interval 1 hour""",
    {"psi": 7},
)
def _(v):
    base = v.table("events").filter("event_type <> 'error'")
    edges, counts = drift.fit_base(base, "value")
    stream = v.spark.readStream.schema(v.table("events").schema).option("pathGlobFilter", "events.parquet").parquet(v.folder)
    out = new_path(v.spark, "drift")
    drift.drift_stream(stream, edges, counts, "value", out, new_path(v.spark, "drift-log")).awaitTermination()
    return v.spark.read.parquet(out).select("window_start", "window_end", "row_count", "psi", "alert")


_BATCH = f"""with e as (select {_EDGES} from events),
    b as (select bin, count(*) / sum(count(*)) over () as s from (select {_BIN} as bin from events, e) group by bin),
    w as (select cast(date_trunc('day', ts) as timestamp) as window_start, {_BIN} as bin from events, e),
    c as (select window_start, bin, count(*) as n from w group by 1, 2),
    t as (select window_start, sum(n) as n from c group by 1),
    p as (select t.window_start, t.n as row_count, greatest(b.s, 1e-4) as s, greatest(coalesce(c.n, 0) / t.n, 1e-4) as o
      from t cross join b left join c on c.window_start = t.window_start and c.bin = b.bin),
    r as (select window_start, cast(any_value(row_count) as bigint) as row_count, sum((o - s) * ln(o / s)) as psi from p group by 1)
    select *, case when psi > 0.25 then 'shift' when psi > 0.10 then 'watch' else 'stable' end as alert from r"""


@query("str02_drift_batch", _BATCH, {"psi": 7})
@query("str02_drift_batch_psi", _BATCH, {"psi": 7})
def _(v):
    edges, counts = drift.fit_base(v.table("events"), "value")
    binned = v.table("events").withColumn("ts", F.col("ts").cast("timestamp")).groupBy(
        F.window("ts", "1 day").alias("w"), drift.bin_index("value", edges[1:-1]).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    return drift.window_psi(binned, counts).select("window_start", "row_count", "psi", "alert")
