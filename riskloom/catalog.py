"""The raw schema, the code books and the display names, as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Attribute:
    """A coded column: where it comes from and what each of its codes means.

    ``codes`` rows are (code, decoded text or None, flag column, flag display name). A
    code whose text is None has a flag but decodes like an unlisted code.
    """

    name: str
    raw: str
    raw_label: str
    decoded: str
    decoded_label: str
    codes: tuple[tuple[str, str | None, str, str], ...]
    # raw column the view repeats just before this attribute's block
    repeats: str | None = None


# --- Fixed values: codes, texts, column names and display names -----------------------

DURATION = "Duration_in_month"
AMOUNT = "Credit_amount"
RATE = "Installment_rate_in_percentage_of_disposable_income"
RESIDENCE = "Present_residence_since"
AGE = "Age_in_years"
CREDITS = "Number_of_existing_credits_at_this_bank"
DEPENDENTS = "Number_of_people_being_liable_to_provide_maintenance_for"
LABEL = "Credit_risk"

NUMBERS = {
    DURATION: "Loan Duration (Months)",
    AMOUNT: "Credit Amount (DM)",
    RATE: "Installment Rate (%)",
    RESIDENCE: "Years at Residence",
    AGE: "Age (Years)",
    CREDITS: "# Existing Credits",
    DEPENDENTS: "Dependents",
    LABEL: "Risk Label",
}

RATIO, RATIO_LABEL = "credit_per_month", "Credit per Month"
AGE_GROUP, AGE_GROUP_LABEL = "age_group", "Age Group"
AGE_FLAGS = {
    "age_under_25": "Age < 25",
    "age_25_to_40": "Age 25–40",
    "age_over_40": "Age > 40",
}
AGE_TEXTS = ("Under_25", "25_to_40", "Over_40")

UNKNOWN = "unknown"

ATTRIBUTES = (
    Attribute(
        "checking", "Status_of_existing_checking_account", "Checking Account (Raw)",
        "checking_desc", "Checking Account Status",
        (
            ("A11", "<0", "chk_lt_0", "Checking <0 DM"),
            ("A12", "0-200", "chk_0_200", "Checking 0–200 DM"),
            ("A13", ">=200_or_salary", "chk_ge_200", "Checking ≥200 DM"),
            ("A14", "no_account", "chk_none", "Checking: No Checking Account"),
        ),
    ),
    Attribute(
        "history", "Credit_history", "Credit History (Raw)",
        "history_desc", "Credit History",
        (
            ("A30", "no_credits", "hist_no_credits", "No Credits"),
            ("A31", "all_paid_duly", "hist_all_paid", "All Paid Duly"),
            ("A32", "existing_paid_duly", "hist_existing_paid", "Existing Paid Duly"),
            ("A33", "past_delay", "hist_past_delay", "Past Delay"),
            ("A34", "critical_or_other", "hist_critical", "Critical History"),
        ),
    ),
    Attribute(
        "purpose", "Purpose", "Purpose (Raw)",
        "purpose_desc", "Loan Purpose",
        (
            ("A40", "car_new", "pur_car_new", "Purpose: New Car"),
            ("A41", "car_used", "pur_car_used", "Purpose: Used Car"),
            ("A42", "furniture", "pur_furniture", "Purpose: Furniture"),
            ("A43", "radio_tv", "pur_radio_tv", "Purpose: Radio/TV"),
            ("A44", "domestic_app", "pur_domestic", "Purpose: Domestic Appliances"),
            ("A45", "repairs", "pur_repairs", "Purpose: Repairs"),
            ("A46", "education", "pur_education", "Purpose: Education"),
            ("A47", "vacation", "pur_vacation", "Purpose: Vacation"),
            ("A48", "retraining", "pur_retraining", "Purpose: Retraining"),
            ("A49", "business", "pur_business", "Purpose: Business"),
            ("A410", "others", "pur_others", "Purpose: Others"),
        ),
    ),
    Attribute(
        "savings", "Savings_account_bonds", "Savings Account (Raw)",
        "savings_desc", "Savings Account",
        (
            ("A61", "<100", "sav_lt_100", "Savings <100 DM"),
            ("A62", "100-500", "sav_100_500", "Savings 100–500 DM"),
            ("A63", "500-1000", "sav_500_1000", "Savings 500–1000 DM"),
            ("A64", ">=1000", "sav_ge_1000", "Savings ≥1000 DM"),
            ("A65", None, "sav_unknown", "Savings Unknown"),
        ),
    ),
    Attribute(
        "employment", "Present_employment_since", "Employment Since (Raw)",
        "emp_desc", "Employment Length",
        (
            ("A71", "unemployed", "emp_unempl", "Unemployed"),
            ("A72", "<1yr", "emp_lt1", "Employed <1yr"),
            ("A73", "1-4yr", "emp_1_4", "Employed 1–4yrs"),
            ("A74", "4-7yr", "emp_4_7", "Employed 4–7yrs"),
            ("A75", ">=7yr", "emp_ge7", "Employed ≥7yrs"),
        ),
    ),
    Attribute(
        "status_sex", "Personal_status_and_sex", "Personal Status & Sex (Raw)",
        "status_sex_desc", "Personal Status & Sex",
        (
            ("A91", "m_div_sep", "sex_m_divsep", "Male Divorced/Separated"),
            ("A92", "f_div_sep_mar", "sex_f_divsep_mar", "Female Divorced/Married"),
            ("A93", "m_single", "sex_m_single", "Male Single"),
            ("A94", "m_mar_wid", "sex_m_marwid", "Male Married/Widowed"),
            ("A95", "f_single", "sex_f_single", "Female Single"),
        ),
    ),
    Attribute(
        "debtors", "Other_debtors_guarantors", "Other Debtors (Raw)",
        "debtors_desc", "Other Debtors",
        (
            ("A101", "none", "debt_none", "Debt: No Debtors"),
            ("A102", "coapplicant", "debt_coapp", "Debt: Co-applicant"),
            ("A103", "guarantor", "debt_guarantor", "Debt: Guarantor"),
        ),
    ),
    Attribute(
        "property", "Property", "Property (Raw)",
        "property_desc", "Property Type",
        (
            ("A121", "real_estate", "prop_real", "Property: Real Estate"),
            ("A122", "savings_ins", "prop_sav_ins", "Property: Savings Insurance"),
            ("A123", "car_other", "prop_car_other", "Property: Car/Other"),
            ("A124", "unknown", "prop_unknown", "Property: Unknown"),
        ),
        repeats=RESIDENCE,
    ),
    Attribute(
        "plans", "Other_installment_plans", "Installment Plans (Raw)",
        "inst_plans_desc", "Installment Plans",
        (
            ("A141", "bank", "inst_bank", "Installment: Bank"),
            ("A142", "stores", "inst_stores", "Installment: Stores"),
            ("A143", "none", "inst_none", "Installment: None"),
        ),
    ),
    Attribute(
        "housing", "Housing", "Housing (Raw)",
        "housing_desc", "Housing Type",
        (
            ("A151", "rent", "house_rent", "House: Rented"),
            ("A152", "own", "house_own", "House: Owned"),
            ("A153", "free", "house_free", "House: Free Housing"),
        ),
    ),
    Attribute(
        "job", "Job", "Job (Raw)",
        "job_desc", "Job Type",
        (
            ("A171", "unskilled_nonres", "job_unsk_nonres", "Job: Unskilled (Non-resident)"),
            ("A172", "unskilled_res", "job_unsk_res", "Job: Unskilled (Resident)"),
            ("A173", "skilled", "job_skilled", "Job: Skilled Worker"),
            ("A174", "management", "job_manage", "Job: Management"),
        ),
        repeats=CREDITS,
    ),
    Attribute(
        "telephone", "Telephone", "Telephone (Raw)",
        "tel_desc", "Telephone Status",
        (
            ("A191", "none", "tel_none", "Telephone: No Telephone"),
            ("A192", "yes_registered", "tel_yes", "Telephone: Telephone Registered"),
        ),
        repeats=DEPENDENTS,
    ),
    Attribute(
        "foreign", "Foreign_worker", "Foreign Worker (Raw)",
        "foreign_desc", "Foreign Worker",
        (
            ("A201", "yes", "foreign_yes", "Foreign Worker (Yes)"),
            ("A202", "no", "foreign_no", "Foreign Worker (No)"),
        ),
    ),
)

# column order of the raw table
RAW_ORDER = (
    "Status_of_existing_checking_account",
    DURATION,
    "Credit_history",
    "Purpose",
    AMOUNT,
    "Savings_account_bonds",
    "Present_employment_since",
    RATE,
    "Personal_status_and_sex",
    "Other_debtors_guarantors",
    RESIDENCE,
    "Property",
    AGE,
    "Other_installment_plans",
    "Housing",
    CREDITS,
    "Job",
    DEPENDENTS,
    "Telephone",
    "Foreign_worker",
    LABEL,
)

RISK_NAMES = {1: "Good", 2: "Bad"}

# chart wording of three decoded columns; texts not listed become missing
VALUE_NAMES = {
    "purpose_desc": {
        "car_new": "Car (New)",
        "car_used": "Car (Used)",
        "furniture": "Furniture",
        "radio_tv": "Radio/TV",
        "domestic_app": "Domestic Appliances",
        "repairs": "Repairs",
        "education": "Education",
        "vacation": "Vacation",
        "retraining": "Retraining",
        "business": "Business",
        "others": "Other",
    },
    "housing_desc": {"rent": "Rented", "own": "Owned", "free": "Free"},
    "status_sex_desc": {
        "m_div_sep": "Male Divorced/Separated",
        "f_div_sep_mar": "Female Divorced/Married",
        "m_single": "Male Single",
        "m_mar_wid": "Male Married/Widowed",
        "f_single": "Female Single",
    },
}

# decoded columns whose missing values become 'Unknown' (the job column is not among them)
FILLED = (
    "checking_desc", "savings_desc", "history_desc", "purpose_desc", "housing_desc",
    "emp_desc", "debtors_desc", "property_desc", "inst_plans_desc", "tel_desc",
    "foreign_desc", "status_sex_desc",
)

# display names left out of the correlation study
NOT_CORRELATED = (
    "Age (Years)", "No Credits", "Sex", "Male Divorced/Separated",
    "Female Divorced/Married", "Male Single",
)

# groups of the correlation chart, in chart order, with the name prefixes they collect
GROUP_PREFIXES = {
    "Checking": "chk_",
    "Credit History": "hist_",
    "Purpose": "pur_",
    "Savings": "sav_",
    "Employment": "emp_",
    "Sex": "Personal Status & Sex",
    "Debtors": "debt_",
    "Property": "prop_",
    "Installment Plans": "inst_",
    "Housing": "house_",
    "Job": "job_",
    "Telephone": "tel_",
    "Foreign Worker": "foreign_",
}
OTHER_GROUP = "Other"

# hyperparameter grids
GRID_LOGREG = {"C": (0.01, 0.1, 1.0, 10.0)}
GRID_FOREST = {"n_estimators": (50, 100), "max_depth": (None, 10, 20)}
GRID_SVM = {"C": (0.1, 1.0, 10.0), "kernel": ("rbf", "linear")}

# --- Derived from the above -----------------------------------------------------------

KEY = "application_id"

RAW_SCHEMA = T.StructType(
    [
        T.StructField(name, T.IntegerType() if name in NUMBERS else T.StringType())
        for name in RAW_ORDER
    ]
)
KEYED_SCHEMA = T.StructType([T.StructField(KEY, T.LongType()), *RAW_SCHEMA.fields])

BY_NAME = {a.name: a for a in ATTRIBUTES}
CODE_FLAGS = tuple(flag for a in ATTRIBUTES for _, _, flag, _ in a.codes)
FLAGS = (*AGE_FLAGS, *CODE_FLAGS)
REPEATED = tuple(a.repeats for a in ATTRIBUTES if a.repeats)


def repeat_name(column: str) -> str:
    return f"{column}:1"


def display_names() -> dict[str, str]:
    """Working name to display name, for the 95 distinct columns of the view."""
    names = {a.raw: a.raw_label for a in ATTRIBUTES} | NUMBERS
    names |= {RATIO: RATIO_LABEL, AGE_GROUP: AGE_GROUP_LABEL} | AGE_FLAGS
    names |= {a.decoded: a.decoded_label for a in ATTRIBUTES}
    names |= {flag: label for a in ATTRIBUTES for _, _, flag, label in a.codes}
    return names
