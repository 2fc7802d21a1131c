"""Queries that run several stages of the loan book on the test views."""

from pyspark.sql import functions as F

from provisio.plans import loan_book as LB
from provisio.plans.catalog import history  # noqa: F401  (aggregate parts of the oracle)
from provisio.plans.catalog.registry import query
from provisio.session import new_path, write_once


def tables(v):
    app = v.application
    return {
        "train": app.filter("is_train = 1").drop("is_train"), "test": app.filter("is_train = 0").drop("is_train"),
        # Views over a join, which the fits of the cleaning would repeat.
        "bureau": write_once(v.bureau, "bureau"), "instalments": write_once(v.instalments, "instalments"),
        "previous": v.previous, "pos": v.pos, "card": v.card,
    }


@query(
    "book_joined_features",
    """select is_train, count(*) as applicants, avg(b) as loans, avg(r) as late_ratio, avg(u) as utilization from (
     select a.is_train, coalesce(j.bureau_loan_count, 0) as b, coalesce(j.inst_late_ratio, 0e0) as r, coalesce(j.cc_utilization_mean, 0e0) as u
     from px_application a join px_joined j on a.sk_id_curr = j.sk_id_curr) group by is_train""",
    {"loans late_ratio utilization": 7},
)
def _(v):
    root = new_path(v.spark, "book")
    joined = LB.join_tables(LB.clean_tables(tables(v), root), root)
    return joined.groupBy("is_train").agg(
        F.count(F.lit(1)).alias("applicants"), F.avg("bureau_loan_count").alias("loans"),
        F.avg("inst_late_ratio").alias("late_ratio"), F.avg("cc_utilization_mean").alias("utilization"),
    )

