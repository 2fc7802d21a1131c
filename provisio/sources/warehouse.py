"""Warehouse tables: typed columns with defaults, appends, and the reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provisio.sources.schemas import TABLES, table_schema


def create_tables(spark: SparkSession, location: str | None = None, prefix: str = "") -> list[str]:
    """Create the databases and tables; ``location`` makes them external below that folder.

    ``prefix`` goes in front of the database names, to keep several warehouses apart.
    """
    names = []
    for table, (_cols, stamp, defaults) in TABLES.items():
        database, name = table.split(".")
        place = f" LOCATION '{location}/{database}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{database}{place}")
        cols = [
            f"{f.name} {f.dataType.simpleString()}"
            + (f" DEFAULT CAST({defaults[f.name]} AS {f.dataType.simpleString()})" if f.name in defaults else "")
            for f in table_schema(table)
        ]
        cols.append(f"{stamp} TIMESTAMP DEFAULT current_timestamp()")
        where = f" LOCATION '{location}/{database}/{name}'" if location else ""
        full = f"{prefix}{table}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({', '.join(cols)}) USING parquet{where}")
        names.append(full)
    return names


def append_table(df: DataFrame, table: str) -> None:
    """Append by column name; columns that are not given get their default, the rest NULL.

    The rows are cast to the table types, so a value that does not fit raises.
    """
    spark = df.sparkSession
    target = spark.table(table).schema
    have = {c.lower(): c for c in df.columns}
    cols = [f for f in target if f.name in have]
    rows = df.select(*[F.col(have[f.name]).cast(f.dataType).alias(f.name) for f in cols])
    names = ", ".join(f.name for f in cols)
    spark.sql(f"INSERT INTO {table} ({names}) SELECT * FROM {{rows}}", rows=rows)


def create_views(spark: SparkSession, prefix: str = "") -> list[str]:
    """Reporting views over the tables: applicant profile and default rate by segment."""
    raw, feat, model = (f"{prefix}{d}" for d in ("raw", "feat", "model"))
    spark.sql(f"""
        CREATE OR REPLACE VIEW {model}.vw_default_rate_by_segment AS
        SELECT name_income_type, name_education_type, code_gender, count(*) AS applicant_count,
               sum(cast(target AS bigint)) AS default_count,
               avg(cast(target AS double)) * 100 AS default_rate_pct,
               avg(amt_credit) AS avg_credit_amount, avg(amt_income_total) AS avg_income
        FROM {raw}.application WHERE is_test = 0
        GROUP BY name_income_type, name_education_type, code_gender""")
    spark.sql(f"""
        CREATE OR REPLACE VIEW {model}.vw_applicant_risk_profile AS
        SELECT a.sk_id_curr, a.target, a.code_gender, a.name_income_type, a.name_education_type,
               a.occupation_type, a.name_contract_type, a.amt_credit, a.amt_income_total,
               f.age_years, f.credit_income_ratio, f.bureau_bad_debt_flag, f.prev_refused_ratio,
               a.ext_source_2, a.ext_source_3, p.default_probability, p.risk_tier
        FROM {raw}.application a
        LEFT JOIN {feat}.application_features f ON f.sk_id_curr = a.sk_id_curr
        LEFT JOIN {model}.predictions p
               ON p.sk_id_curr = a.sk_id_curr AND p.model_version = 'lgbm_v1'
        WHERE a.is_test = 0""")
    return [f"{model}.vw_default_rate_by_segment", f"{model}.vw_applicant_risk_profile"]
