"""Column lists, record types and table layouts of the warehouse.

Every name below is a fixed value: input headers, stored columns and flag names
have to be spelled exactly like this for results to be interchangeable.
"""

from __future__ import annotations

# ---- fixed values: input columns -------------------------------------------
BASE_COLUMNS = [
    "taxpayer_id",
    "nric",
    "full_name",
    "filing_status",
    "assessment_year",
    "filing_date",
    "annual_income_sgd",
    "chargeable_income_sgd",
    "tax_payable_sgd",
    "tax_paid_sgd",
    "total_reliefs_sgd",
    "number_of_dependents",
    "occupation",
    "residential_status",
    "postal_code",
    "housing_type",
    "cpf_contributions_sgd",
    "foreign_income_sgd",
    "employer_id",
]
INCREMENTAL_COLUMNS = ["batch_date", "record_type"]
CANONICAL_COLUMNS = BASE_COLUMNS + INCREMENTAL_COLUMNS

EMPLOYER_COLUMNS = [
    "employer_id",
    "company_name",
    "uen",
    "industry",
    "address",
    "employee_count",
]

# ---- fixed values: codes ----------------------------------------------------
NEW, UPDATE, CORRECTION, LATE_ARRIVAL = "new", "update", "correction", "late_arrival"
DOMAINS = ["completeness", "validity", "accuracy"]
OPEN_END = "9999-12-31"
UNKNOWN_MEMBER = "UNKNOWN"
UNKNOWN_MEMBER_NAME = "Unknown / Self-employed"
SUMMARY_DIMENSIONS = ["occupation", "residential_status", "housing_type"]

# ---- fixed values: column roles --------------------------------------------
KEY = "taxpayer_id"
PERIOD = "assessment_year"
TRACKED = [
    "occupation",
    "postal_code",
    "housing_type",
    "residential_status",
    "filing_status",
    "number_of_dependents",
]
IDENTITY = ["nric", "full_name"]
AUDITED = [
    "annual_income_sgd",
    "chargeable_income_sgd",
    "tax_payable_sgd",
    "tax_paid_sgd",
    "total_reliefs_sgd",
]
MEASURES = AUDITED + ["cpf_contributions_sgd", "foreign_income_sgd"]

# ---- stored tables ----------------------------------------------------------
# `opened_seq`, `touched_seq` and `batch_seq` are control columns: the ordinal of
# the batch that opened a version, last changed it, or delivered a fact row.
DIM_TAXPAYER = (
    "taxpayer_sk bigint, taxpayer_id string, nric string, full_name string, "
    "filing_status string, occupation string, residential_status string, "
    "postal_code string, housing_type string, number_of_dependents string, "
    "valid_from date, valid_to date, is_current boolean, "
    "opened_seq int, touched_seq int"
)
DIM_EMPLOYER = (
    "employer_id string, company_name string, uen string, industry string, "
    "address string, employee_count int"
)
FACT_TAX_RETURNS = (
    "taxpayer_id string, assessment_year int, taxpayer_sk bigint, employer_id string, "
    "filing_date date, batch_date date, record_type string, "
    "annual_income_sgd double, chargeable_income_sgd double, tax_payable_sgd double, "
    "tax_paid_sgd double, total_reliefs_sgd double, cpf_contributions_sgd double, "
    "foreign_income_sgd double, is_corrected boolean, batch_seq int"
)
# Counts are 64-bit: a batch may have more rows than 32 bits can count.
QUALITY_METRICS = (
    "batch string, domain string, score double, passing_count bigint, total_count bigint, "
    "computed_at timestamp, batch_seq int"
)
FACT_CORRECTIONS = (
    "correction_id bigint, taxpayer_id string, assessment_year int, corrected_at date, "
    "old_annual_income_sgd double, old_chargeable_income_sgd double, "
    "old_tax_payable_sgd double, old_tax_paid_sgd double, old_total_reliefs_sgd double"
)
# A refused row is stored whole, with its place in the file.
REJECTS = "batch string, reason string, row_pos string, " + ", ".join(
    f"{c} string" for c in CANONICAL_COLUMNS
)
BATCH_LOG = (
    "batch string, batch_seq int, batch_date date, total_rows bigint, "
    "last_taxpayer_sk bigint, last_correction_id bigint"
)

# Sums over the facts of each version, kept up to date by every load.
VERSION_TOTALS = (
    "taxpayer_id string, taxpayer_sk bigint, num_returns bigint, tax_payable decimal(38,6), "
    "num_taxes bigint, annual_income decimal(38,6), num_incomes bigint"
)

TABLES = {
    "dim_taxpayer": DIM_TAXPAYER,
    "dim_employer": DIM_EMPLOYER,
    "fact_tax_returns": FACT_TAX_RETURNS,
    "agg_data_quality_metrics": QUALITY_METRICS,
    "fact_corrections": FACT_CORRECTIONS,
}
CONTROL_COLUMNS = {"opened_seq", "touched_seq", "batch_seq"}


def column_names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def public_columns(table: str) -> list[str]:
    """Stored columns of a table without the control columns."""
    return [c for c in column_names(TABLES[table]) if c not in CONTROL_COLUMNS]
