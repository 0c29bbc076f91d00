"""Loan applications derived from the TPC-H-like orders and customers.

No applications table ships with the project, so tests, bench and registered queries
derive one row per order. The arithmetic is on integers, and the same SQL text gives the
same rows in Spark and in DuckDB. Here k is the order key and c the customer key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom import catalog as cat
from riskloom.session import spread
from riskloom.sources.readers import read_parquet

SAMPLE_SQL = {
    "application_id": "k",
    "Status_of_existing_checking_account": "case when k%97=0 then null when k%89=0 then 'A99' else concat('A1',cast(1+(k*7+c)%4 as varchar(2))) end",
    "Duration_in_month": "case when k%211=0 then 0 else cast(4+(k*5+c*3)%69 as int) end",
    "Credit_history": "concat('A3',cast((k*3+c)%5 as varchar(2)))",
    "Purpose": "case when k%103=0 then null else concat('A4',cast((k*13+c*5)%11 as varchar(2))) end",
    "Credit_amount": "(250+cast(floor(o_totalprice/100) as int)) * case when k%53=0 then 5 else 1 end",
    "Savings_account_bonds": "case when k%107=0 then 'A66' else concat('A6',cast(1+(k*19+c)%5 as varchar(2))) end",
    "Present_employment_since": "concat('A7',cast(1+(k*23+c*7)%5 as varchar(2)))",
    "Installment_rate_in_percentage_of_disposable_income": "cast(1+(k*29+c)%4 as int)",
    "Personal_status_and_sex": "case when k%109=0 then null else concat('A9',cast(1+(k*17+c)%5 as varchar(2))) end",
    "Other_debtors_guarantors": "concat('A10',cast(1+(k*31+c)%3 as varchar(2)))",
    "Present_residence_since": "cast(1+(k*41+c*3)%4 as int)",
    "Property": "concat('A12',cast(1+(k*43+c)%4 as varchar(2)))",
    "Age_in_years": "case when k%101=0 then null else cast(19+(k*11+c*7)%57 as int) end",
    "Other_installment_plans": "concat('A14',cast(1+(k*47+c)%3 as varchar(2)))",
    "Housing": "concat('A15',cast(1+(k+c)%3 as varchar(2)))",
    "Number_of_existing_credits_at_this_bank": "cast(1+(k*53+c)%4 as int)",
    "Job": "concat('A17',cast(1+(k*59+c)%4 as varchar(2)))",
    "Number_of_people_being_liable_to_provide_maintenance_for": "cast(1+(k*61+c)%2 as int)",
    "Telephone": "concat('A19',cast(1+(k*67+c)%2 as varchar(2)))",
    "Foreign_worker": "concat('A20',cast(1+(k*71+c)%2 as varchar(2)))",
    "Credit_risk": "case when (k*37+c*11)%100 + case when 4+(k*5+c*3)%69>36 then 15 else 0 end + case (k*7+c)%4 when 0 then 15 when 3 then -15 else 0 end >= 78 then 2 else 1 end",
}


def sample_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One application per order with a known customer.

    The join is left without a hint: Spark broadcasts the customer keys only when their
    size allows it, and splits a skewed customer at run time otherwise.
    """
    orders = read_parquet(
        spark, f"{sf_dir}/orders.parquet", "o_orderkey bigint, o_custkey bigint, o_totalprice double"
    ).selectExpr("o_orderkey as k", "o_custkey as c", "o_totalprice")
    customers = read_parquet(spark, f"{sf_dir}/customer.parquet", "c_custkey bigint").selectExpr(
        "c_custkey as c"
    )
    rows = spread(orders, "k").join(customers, "c", "left_semi")
    return rows.selectExpr(*[f"{sql} as {name}" for name, sql in SAMPLE_SQL.items()])


assert tuple(SAMPLE_SQL) == tuple(cat.KEYED_SCHEMA.fieldNames())
