"""Row rules: named boolean predicates, each belonging to one quality domain."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casting import clean_text, rule_number, strict_date

# Default patterns and the status that owes contributions.
NRIC_PATTERN = r"^[STFG][0-9]{7}[A-Z]$"
POSTAL_PATTERN = r"^[0-9]{6}$"
CPF_REQUIRED_STATUS = "Resident"


@dataclass(frozen=True)
class Rule:
    """A predicate over a row. `predicate` builds a Column, so a custom rule is one
    expression and runs in generated code. A null outcome counts as a failure."""

    rule_id: str
    domain: str
    predicate: Callable[[], Column]
    description: str = ""

    @property
    def flag_column(self) -> str:
        return f"dq_{self.rule_id}_pass"


def domain_flag_column(domain: str) -> str:
    return f"dq_{domain}_pass"


def present(column: str) -> Column:
    return clean_text(F.col(column)) != ""


def matches_from_start(column: str, pattern: str) -> Column:
    """The stripped text matches `pattern` beginning at its first character."""
    return clean_text(F.col(column)).rlike(f"^(?:{pattern})")


def dated_after_year(date: str, year: str) -> Column:
    return F.year(strict_date(F.col(date))) > rule_number(F.col(year))


def is_difference(result: str, minuend: str, subtrahend: str) -> Column:
    return rule_number(F.col(result)) == rule_number(F.col(minuend)) - rule_number(
        F.col(subtrahend)
    )


def positive_when(column: str, status: str, required: str) -> Column:
    """Rows with the given status need a positive amount; all others are exempt."""
    has_status = F.coalesce(F.col(status) == required, F.lit(False))
    return ~has_status | F.coalesce(rule_number(F.col(column)) > 0, F.lit(False))


def tax_return_rules(
    nric_pattern: str = NRIC_PATTERN,
    postal_pattern: str = POSTAL_PATTERN,
    cpf_required_status: str = CPF_REQUIRED_STATUS,
) -> list[Rule]:
    """The six rules over the canonical columns."""
    return [
        Rule(
            "rule1_nric_present",
            "completeness",
            lambda: present("nric"),
            "identity number is filled in",
        ),
        Rule(
            "rule2_nric_format",
            "validity",
            lambda: matches_from_start("nric", nric_pattern),
            "identity number is well formed",
        ),
        Rule(
            "rule3_postal_code",
            "validity",
            lambda: matches_from_start("postal_code", postal_pattern),
            "postal code has six digits",
        ),
        Rule(
            "rule4_filing_date_after_ay",
            "validity",
            lambda: dated_after_year("filing_date", "assessment_year"),
            "filed on a real date after the assessment year",
        ),
        Rule(
            "rule5_chargeable_income",
            "accuracy",
            lambda: is_difference("chargeable_income_sgd", "annual_income_sgd", "total_reliefs_sgd"),
            "chargeable income is annual income less reliefs",
        ),
        Rule(
            "rule6_cpf_resident",
            "accuracy",
            lambda: positive_when(
                "cpf_contributions_sgd", "residential_status", cpf_required_status
            ),
            "residents have made contributions",
        ),
    ]
