"""Views that give the generated test tables the shape of the loan tables.

Plain SQL that Spark and DuckDB both accept; values are deterministic arithmetic on keys.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

PROXIES = {
    "px_application": """
select c_custkey as sk_id_curr, case when c_custkey % 7 = 6 then 0 else 1 end as is_train,
 case when c_custkey % 7 = 6 then null when (c_custkey*7919) % 100 < 8 then 1 else 0 end as target,
 case when c_custkey % 5 = 0 then 'Revolving loans' else 'Cash loans' end as name_contract_type,
 case when c_custkey % 500 = 0 then 'XNA' when c_nationkey % 2 = 0 then 'M' else 'F' end as code_gender,
 case when c_custkey % 13 = 0 then null else c_mktsegment end as name_income_type,
 5e4 + ((c_custkey*7907) % 30011)*1e1 as amt_income_total,
 1e5 + ((c_custkey*6151) % 90001)*1e1 as amt_credit,
 case when c_custkey % 29 = 0 then null else 5e3 + ((c_custkey*389) % 20011) end as amt_annuity,
 case when c_acctbal < 0 then null else c_acctbal end as amt_goods_price,
 -(6570 + (c_custkey*13) % 19000) as days_birth,
 case when c_custkey % 6 = 0 then 365243 else -((c_custkey*11) % 7300) end as days_employed,
 -((c_custkey*17) % 2000) as days_id_publish,
 case when c_custkey % 2 = 0 then null else ((c_custkey*71) % 1009)/1009e0 end as ext_source_1,
 ((c_custkey*73) % 1013)/1013e0 as ext_source_2,
 case when c_custkey % 5 = 1 then null else ((c_custkey*79) % 1019)/1019e0 end as ext_source_3,
 c_custkey % 4 as cnt_children, case when c_custkey % 31 = 0 then 0 else 1 + c_custkey % 5 end as cnt_fam_members,
 case when c_custkey % 3 = 0 then 'Higher' when c_custkey % 3 = 1 then 'Secondary' else 'Lower' end as name_education_type,
 case when c_custkey % 10 < 6 then 'Y' else 'N' end as flag_own_car,
 case when c_custkey % 23 = 0 then null else -((c_custkey*29) % 3001) end as days_last_phone_change,
 case when c_custkey % 9 = 0 then 1 else 0 end as flag_document_2,
 case when c_custkey % 4 < 3 then 1 else 0 end as flag_document_3,
 case when c_custkey % 101 = 0 then 1 else 0 end as flag_document_4,
 case when c_custkey % 17 = 0 then null else (c_custkey*3) % 37 end as def_30_cnt_social_circle,
 case when c_custkey % 12 < 7 then null else c_custkey % 65 end as own_car_age
 from customer""",
    "px_bureau": """
select l_orderkey*10 + l_linenumber as sk_id_bureau, o_custkey as sk_id_curr,
 case l_returnflag when 'A' then 'Active' when 'N' then 'Closed' else 'Bad debt' end as credit_active,
 case when l_linenumber = 7 then 0e0 else l_extendedprice end as amt_credit_sum, l_extendedprice*l_discount as amt_credit_sum_debt,
 case when l_tax = 0 then null else l_tax*1e3 end as amt_credit_sum_overdue,
 case when l_quantity > 45 then cast((l_quantity-45)*1e2 as int) else 0 end as credit_day_overdue,
 -((l_orderkey*7 + l_linenumber*31) % 2900) as days_credit,
 case when l_orderkey % 19 = 0 then null else (l_orderkey*11) % 3000 - 1000 end as days_credit_enddate,
 l_linenumber % 3 as cnt_credit_prolong
 from lineitem join orders on l_orderkey = o_orderkey""",
    "px_previous_application": """
select o_orderkey as sk_id_prev, o_custkey as sk_id_curr, case o_orderstatus when 'F' then 'Approved' when 'O' then 'Refused' else 'Canceled' end as name_contract_status,
 case when o_orderpriority in ('1-URGENT','2-HIGH') then 'Cash loans' when o_orderpriority = '3-MEDIUM' then 'Revolving loans' else 'Consumer loans' end as name_contract_type,
 o_totalprice as amt_credit, o_totalprice/12e0 as amt_annuity, case when o_orderkey % 4 = 0 then -1e0 when o_orderkey % 4 = 1 then null else o_totalprice*0.1e0 end as amt_down_payment,
 -((o_orderkey*3) % 2900) as days_decision,
 case when o_orderkey % 3 = 0 then 365243 else -((o_orderkey*5) % 2900) end as days_first_drawing,
 case when o_orderkey % 37 = 0 then 365243 else -((o_orderkey*13) % 2900) end as days_termination
 from orders""",
    "px_installments": """
select l_orderkey as sk_id_prev, o_custkey as sk_id_curr, l_linenumber as num_instalment_number, l_extendedprice as amt_instalment,
 case when l_tax = 0 and l_linenumber = 1 then null else l_extendedprice*(1e0-l_discount) end as amt_payment,
 cast(-((l_orderkey*7) % 2900) as double) as days_instalment, -((l_orderkey*7) % 2900) + l_quantity - 4e1 as days_entry_payment
 from lineitem join orders on l_orderkey = o_orderkey""",
    "px_pos_cash": """
select user_id*100 + event_id % 7 as sk_id_prev, user_id as sk_id_curr, -(event_id % 96) as months_balance,
 case when event_id % 41 = 0 then null else cast(1 + event_id % 36 as double) end as cnt_instalment,
 case event_type when 'purchase' then 'Completed' when 'error' then 'XNA' else 'Active' end as name_contract_status,
 case when event_type = 'error' then cast(floor(value*1e1) as int) else 0 end as sk_dpd, case when event_id % 50 = 0 then 3 else 0 end as sk_dpd_def from events""",
    "px_credit_card": """
select user_id as sk_id_curr, -(event_id % 96) as months_balance, value*2e1 - 1e2 as amt_balance, case when event_type = 'signup' then 0 else 1000 + (event_id % 9)*500 end as amt_credit_limit_actual,
 case when event_id % 5 = 0 then null else value end as amt_drawings_current, case when event_id % 6 = 0 then null else value*0.5e0 end as amt_payment_current,
 case when event_type = 'error' then cast(floor(value*1e1) as int) else 0 end as sk_dpd, 0 as sk_dpd_def from events""",
    "px_scored": """
select o_orderkey as sk_id_curr, case when o_orderstatus = 'F' then 1 else 0 end as target, ((o_orderkey*7919) % 1009)/1009e0 as pred_prob,
 case when o_orderpriority in ('1-URGENT','2-HIGH') then 'Cash loans' when o_orderpriority = '3-MEDIUM' then 'Revolving loans' else 'Consumer loans' end as name_contract_type,
 case when o_orderkey % 53 = 0 then null else o_totalprice end as amt_credit, o_totalprice/12e0 as amt_annuity, 5e4 + ((o_orderkey*7907) % 30011)*1e1 as amt_income_total,
 case when o_orderkey % 4 = 0 then o_totalprice*0.1e0 when o_orderkey % 4 = 1 then null else 0e0 end as amt_down_payment,
 case when o_orderkey % 11 = 0 then null else cast(3 + o_orderkey % 130 as double) end as credit_term,
 case when o_orderkey % 97 = 0 then 1 else 0 end as bureau_bad_debt_flag, ((o_orderkey*31) % 100)/1e2 as inst_late_ratio, case when o_orderkey % 19 = 0 then null else ((o_orderkey*17) % 100)/1e2 end as prev_refused_ratio,
 -(6570 + (o_orderkey*13) % 19000) as days_birth, -((o_orderkey*11) % 7300) as days_employed, -((o_orderkey*17) % 2000) as days_id_publish,
 case o_orderkey % 8 when 0 then 'MONDAY' when 1 then 'TUESDAY' when 2 then 'WEDNESDAY' when 3 then 'THURSDAY' when 4 then 'FRIDAY' when 5 then 'SATURDAY' when 6 then 'SUNDAY' else null end as weekday_appr_process_start,
 (o_orderkey*5) % 24 as hour_appr_process_start, 1 + o_orderkey % 3 as region_rating,
 case when o_orderkey % 2 = 0 then 'M' else 'F' end as code_gender,
 case o_orderkey % 5 when 0 then 'Working' when 1 then 'Pensioner' when 2 then 'State servant' when 3 then 'Commercial associate' else null end as name_income_type,
 case o_orderkey % 6 when 0 then 'Married' when 1 then 'Single / not married' when 2 then 'Separated' when 3 then 'Widow' else 'Civil marriage' end as name_family_status
 from orders""",
}


class Views:
    """Lazy frames over one folder of generated tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def proxy(self, name: str) -> DataFrame:
        text = PROXIES[name]
        used = [b for b in BASE if re.search(rf"(from|join) {b}\b", text)]
        for b in used:
            text = re.sub(rf"(from|join) {b}\b", rf"\1 {{{b}}} {b}", text)
        return self.spark.sql(text, **{b: self.table(b) for b in used})

    application = cached_property(lambda self: self.proxy("px_application"))
    bureau = cached_property(lambda self: self.proxy("px_bureau"))
    previous = cached_property(lambda self: self.proxy("px_previous_application"))
    instalments = cached_property(lambda self: self.proxy("px_installments"))
    pos = cached_property(lambda self: self.proxy("px_pos_cash"))
    card = cached_property(lambda self: self.proxy("px_credit_card"))
    scored = cached_property(lambda self: self.proxy("px_scored"))

    @cached_property
    def loans(self) -> DataFrame:
        """Scored loans with stage, PDs, LGD, EAD and ECL."""
        from provisio.operators.credit_loss import provision
        return provision(self.scored)

    @cached_property
    def banded(self) -> DataFrame:
        """Scored loans with the display bands, simple stage, tier and ECL."""
        from provisio.operators.bands import with_bands
        return with_bands(self.scored)

    @cached_property
    def predictions(self) -> DataFrame:
        from pyspark.sql import functions as F

        from provisio.operators.scoring import assign_tier
        return self.loans.select(
            "sk_id_curr", F.when(F.col("sk_id_curr") % 3 == 0, "lgbm_v2").otherwise("lgbm_v1").alias("model_version"),
            F.col("pred_prob").alias("default_probability"), assign_tier("pred_prob").alias("risk_tier"),
            F.col("target").alias("actual_target"), "stage", "ead", "ecl",
        )

    @cached_property
    def warehouse_application(self) -> DataFrame:
        """Applicants as in the warehouse: is_test tag, sentinel removed and flagged."""
        from pyspark.sql import functions as F

        from provisio.operators.cleaning import null_sentinel
        return null_sentinel(self.application, "days_employed").withColumn("is_test", 1 - F.col("is_train"))
