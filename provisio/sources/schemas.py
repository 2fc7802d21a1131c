"""Column types of the loan tables.

One text per table gives the warehouse types; the scan schemas are derived from it by rule
(decimals are read as doubles, sums are taken in doubles).
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "sk_id_curr"
DOCUMENTS = ", ".join(f"flag_document_{i} tinyint" for i in range(2, 22))
INQUIRIES = ", ".join(
    f"amt_req_credit_bureau_{p} smallint" for p in ("hour", "day", "week", "mon", "qrt", "year")
)

# Table and column names, types and order of the warehouse.
APPLICATION = f"""
sk_id_curr int, is_test tinyint, target tinyint,
name_contract_type string, amt_credit decimal(18,2), amt_annuity decimal(18,2),
amt_goods_price decimal(18,2), amt_income_total decimal(18,2),
code_gender string, flag_own_car string, flag_own_realty string,
cnt_children smallint, cnt_fam_members smallint,
name_income_type string, name_education_type string, name_family_status string,
name_housing_type string, occupation_type string, organization_type string,
days_birth int, days_employed int, days_registration decimal(10,2), days_id_publish int,
days_last_phone_change decimal(10,2), own_car_age decimal(6,2), emp_anomaly tinyint,
ext_source_1 decimal(8,6), ext_source_2 decimal(8,6), ext_source_3 decimal(8,6),
flag_mobil tinyint, flag_emp_phone tinyint, flag_work_phone tinyint, flag_cont_mobile tinyint,
flag_phone tinyint, flag_email tinyint,
region_rating_client tinyint, region_rating_client_w_city tinyint,
region_population_relative decimal(10,8),
reg_region_not_live_region tinyint, reg_region_not_work_region tinyint,
live_region_not_work_region tinyint, reg_city_not_live_city tinyint,
reg_city_not_work_city tinyint, live_city_not_work_city tinyint,
weekday_appr_process_start string, hour_appr_process_start tinyint, name_type_suite string,
obs_30_cnt_social_circle smallint, def_30_cnt_social_circle smallint,
obs_60_cnt_social_circle smallint, def_60_cnt_social_circle smallint,
{INQUIRIES}, {DOCUMENTS}
"""
BUREAU = """
sk_id_bureau int, sk_id_curr int, credit_active string, credit_currency string,
credit_type string, days_credit int, days_credit_enddate int, days_enddate_fact int,
days_credit_update int, credit_day_overdue smallint, amt_credit_max_overdue decimal(18,2),
amt_credit_sum decimal(18,2), amt_credit_sum_debt decimal(18,2),
amt_credit_sum_limit decimal(18,2), amt_credit_sum_overdue decimal(18,2),
cnt_credit_prolong smallint
"""
PREVIOUS_APPLICATION = """
sk_id_prev int, sk_id_curr int, name_contract_type string, name_contract_status string,
name_cash_loan_purpose string, name_payment_type string, code_reject_reason string,
name_client_type string, name_goods_category string, name_portfolio string,
name_product_type string, channel_type string, name_seller_industry string,
name_yield_group string, product_combination string, flag_last_appl_per_contract string,
nflag_last_appl_in_day tinyint, nflag_insured_on_approval tinyint,
amt_annuity decimal(18,2), amt_application decimal(18,2), amt_credit decimal(18,2),
amt_down_payment decimal(18,2), amt_goods_price decimal(18,2), rate_down_payment decimal(8,6),
days_decision int, days_first_drawing int, days_first_due int, days_last_due_1st_version int,
days_last_due int, days_termination int, weekday_appr_process_start string,
hour_appr_process_start tinyint, sellerplace_area int, cnt_payment smallint
"""
INSTALLMENTS = """
sk_id_prev int, sk_id_curr int, num_instalment_version smallint, num_instalment_number smallint,
days_instalment decimal(10,2), days_entry_payment decimal(10,2),
amt_instalment decimal(14,4), amt_payment decimal(14,4),
payment_diff decimal(14,4), days_past_due decimal(10,2)
"""
POS_CASH = """
sk_id_prev int, sk_id_curr int, months_balance smallint, cnt_instalment decimal(6,2),
cnt_instalment_future decimal(6,2), name_contract_status string, sk_dpd smallint,
sk_dpd_def smallint
"""
CREDIT_CARD = """
sk_id_prev int, sk_id_curr int, months_balance smallint, amt_balance decimal(18,2),
amt_credit_limit_actual int, amt_drawings_atm_current decimal(18,2),
amt_drawings_current decimal(18,2), amt_drawings_other_current decimal(18,2),
amt_drawings_pos_current decimal(18,2), cnt_drawings_atm_current decimal(8,2),
cnt_drawings_current smallint, cnt_drawings_other_current decimal(8,2),
cnt_drawings_pos_current decimal(8,2), amt_inst_min_regularity decimal(18,2),
amt_payment_current decimal(18,2), amt_payment_total_current decimal(18,2),
amt_receivable_principal decimal(18,2), amt_recivable decimal(18,2),
amt_total_receivable decimal(18,2), cnt_instalment_mature_cum decimal(8,2),
name_contract_status string, sk_dpd smallint, sk_dpd_def smallint,
utilization_ratio decimal(8,6)
"""
FEATURES = """
sk_id_curr int, credit_income_ratio decimal(10,4), annuity_income_ratio decimal(10,4),
credit_term decimal(10,4), goods_credit_ratio decimal(10,4), credit_downpayment decimal(18,2),
age_years decimal(6,2), years_employed decimal(6,2), days_employed_ratio decimal(10,6),
years_id_publish decimal(6,2), years_last_phone_change decimal(6,2), flag_docs_sum tinyint,
cnt_children_ratio decimal(6,4), emp_anomaly tinyint,
bureau_loan_count smallint, bureau_active_count smallint, bureau_closed_count smallint,
bureau_credit_sum decimal(18,2), bureau_credit_mean decimal(18,2), bureau_debt_sum decimal(18,2),
bureau_overdue_mean decimal(14,4), bureau_overdue_max decimal(14,4),
bureau_bad_debt_count smallint, bureau_bad_debt_flag tinyint, bureau_active_ratio decimal(8,6),
bureau_debt_credit_ratio decimal(8,6),
prev_app_count smallint, prev_approved_count smallint, prev_refused_count smallint,
prev_refused_ratio decimal(8,6), prev_approved_ratio decimal(8,6), prev_credit_mean decimal(18,2),
prev_credit_max decimal(18,2), prev_annuity_mean decimal(14,4),
inst_payment_diff_mean decimal(14,4), inst_payment_diff_max decimal(14,4),
inst_dpd_mean decimal(10,4), inst_dpd_max decimal(10,4), inst_late_count int,
pos_dpd_mean decimal(10,4), pos_dpd_max smallint, pos_months_count smallint,
pos_completed_ratio decimal(8,6),
cc_balance_mean decimal(18,2), cc_balance_max decimal(18,2), cc_limit_mean decimal(18,2),
cc_utilization_mean decimal(8,6), cc_utilization_max decimal(8,6), cc_dpd_mean decimal(10,4),
cc_dpd_max smallint, cc_months_count smallint
"""
PREDICTIONS = """
sk_id_curr int, model_version string, default_probability decimal(8,6), risk_tier string,
oof_fold tinyint, actual_target tinyint, is_correct tinyint, stage tinyint, ead decimal(18,2),
ecl decimal(18,2)
"""
# Table -> (columns, name of the load-time column, defaults).
TABLES = {
    "raw.application": (APPLICATION, "created_at", {"is_test": "0Y", "emp_anomaly": "0Y"}),
    "raw.bureau": (BUREAU, "created_at", {
        "days_enddate_fact": "0", "credit_day_overdue": "0S", "amt_credit_max_overdue": "0",
        "amt_credit_sum_debt": "0", "amt_credit_sum_limit": "0", "amt_credit_sum_overdue": "0",
        "cnt_credit_prolong": "0S",
    }),
    "raw.previous_application": (PREVIOUS_APPLICATION, "created_at", {"amt_down_payment": "0"}),
    "raw.installments_payments": (INSTALLMENTS, "created_at", {}),
    "raw.pos_cash_balance": (POS_CASH, "created_at", {"sk_dpd": "0S", "sk_dpd_def": "0S"}),
    "raw.credit_card_balance": (CREDIT_CARD, "created_at", {
        "amt_balance": "0", "amt_credit_limit_actual": "0", "amt_drawings_current": "0",
        "amt_payment_current": "0", "sk_dpd": "0S", "sk_dpd_def": "0S", "utilization_ratio": "0",
    }),
    "feat.application_features": (FEATURES, "created_at", {}),
    "model.predictions": (PREDICTIONS, "predicted_at", {"model_version": "'lgbm_v1'"}),
}


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(TABLES[table][0].split()))


def scan_schema(table: str, narrow: bool = False) -> T.StructType:
    """Schema of the raw file: decimals as doubles, or as floats for the large tables."""
    real = T.FloatType() if narrow else T.DoubleType()
    return T.StructType([
        T.StructField(f.name, real if isinstance(f.dataType, T.DecimalType) else f.dataType)
        for f in table_schema(table)
    ])
