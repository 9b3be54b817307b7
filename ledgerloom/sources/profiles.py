"""Statement profiles: what a layout prints and where. A new layout is a new profile, not new code.

Positions are fractions of the page. Patterns use plain groups, numbered left to right, as Spark's regular
expression functions take group numbers.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONTH_NAMES = "January|February|March|April|May|June|July|August|September|October|November|December"


@dataclass(frozen=True)
class BankProfile:
    """A daily statement: date, account header, balances, totals, sections of coded transactions."""

    # Fixed values of the bundled bank layout.
    name: str = "northern_trust_daily"
    detect: str = "Northern Trust Treasury Passport"
    row_tolerance: float = 0.0035
    code_max_x0: float = 0.075
    amount_min_x0: float = 0.78
    skip_rows: tuple[str, ...] = (
        r"^Northern Trust Treasury Passport",
        r"^Daily Statement",
        r"^Information Reported On",
        r"^Page \d+ of \d+$",
    )
    doc_fields: dict[str, str] = field(
        default_factory=lambda: {
            "reported_on": r"Information Reported On:\s*(.+?)\s+As Of",
            "statement_period": r"As Of:\s*(.+)$",
            "period_start_date": r"As Of:\s*([A-Za-z]{3} \d{1,2}, \d{4})\s*-",
            "period_end_date": r"As Of:\s*[A-Za-z]{3} \d{1,2}, \d{4}\s*-\s*([A-Za-z]{3} \d{1,2}, \d{4})",
        }
    )
    date_rule: str = rf"^(({MONTH_NAMES}) \d{{1,2}}, \d{{4}})$"
    date_format: str = "MMMM d, yyyy"
    # groups: bank, name before, account, currency, name after
    account_rule: str = r"^BANK:\s*(\S+)\s*(.*?)\s*ACCOUNT:\s*(\d+)\s*(?:([A-Z]{3})(?=\s|$))?\s*(.*)$"
    # groups: code, label, (two inner), amount
    balance_rule: str = (
        r"^(0[1-9]\d)\s+((OPENING|CLOSING) (LEDGER|AVAILABLE) BALANCE)\s*(\(?-?[\d,]+\.\d{2}\)?)?\s*$"
    )
    # groups: code, kind, amount
    summary_rule: str = r"^(\d{3})\s+TOTAL (CREDITS|DEBITS)\s+([\d,]+\.\d{2})"
    section_rule: str = r"^ACCOUNT (CREDITS|DEBITS)$"
    totals_start: str = r"^TOTALS FOR ACCOUNT:"
    # groups: kind, count
    totals_count: str = r"(CREDIT|DEBIT) COUNT:\s*(\d+)"
    totals_figures: str = r"^[\d\s£$€¥.,()-]+$"
    code_rule: str = r"^\d{3}$"
    value_date_rule: str = r"Value Date Of (\d{2}-\d{2}-\d{4})"
    value_date_format: str = "%m-%d-%Y"
    reference_rule: str = r"(?:FUND TRF#|\bTRN(?=\d)|Our TRN Number -\s*)([A-Z0-9]{8,})"
    tags: tuple[str, ...] = ("ORG", "OBI", "IBK", "BBK", "BNF", "SRF", "OBK", "BBI", "ID")
    balance_fields: dict[str, str] = field(
        default_factory=lambda: {
            "010": "opening_ledger",
            "015": "closing_ledger",
            "040": "opening_available",
            "045": "closing_available",
        }
    )
    emit: tuple[str, ...] = ("transaction",)
    balance_records: str = "no_activity"  # all | no_activity | none
    debit_value: str = "DB"
    credit_value: str = "CR"
    include_raw: bool = True
    field_map: dict[str, str] = field(
        default_factory=lambda: {
            "itemdate": "posting_date",
            "subaccount": "account_number",
            "currency": "currency",
            "amount": "amount",
            "dbcr_4": "dbcr",
            "description": "description",
            "desc_1": "reference",
            "functionofmessage": "type_code",
            "openingbalance": "opening_ledger",
            "openingbalancedate": "posting_date",
            "openingbalancedbcr_9": "opening_ledger_dbcr",
            "closingbalance": "closing_ledger",
            "closingbalancedate": "posting_date",
            "closingbalancedbcr_3": "closing_ledger_dbcr",
            "account": "account_number",
            "account_name": "account_name",
            "opening_ledger_balance": "opening_ledger",
            "closing_ledger_balance": "closing_ledger",
            "item_date": "posting_date",
            "openeing_balance_date": "posting_date",
            "closing_balance_date": "posting_date",
            "dbcr_10": "dbcr",
            "period_start_date": "period_start_date",
            "period_end_date": "period_end_date",
        }
    )
    control_totals: bool = True
    balance_roll: bool = True
    type_direction: bool = True
    fail_on_error: bool = False


@dataclass(frozen=True)
class TableProfile:
    """A brokerage statement: transactions as rows of an unruled table with fixed column ranges."""

    # Fixed values of the bundled brokerage layout.
    name: str = "charles_schwab"
    detect: str = "Charles Schwab"
    static_fields: dict[str, str] = field(default_factory=lambda: {"currency": "$"})
    row_tolerance: float = 0.004
    columns: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {
            "date": (0.015, 0.055),
            "category": (0.052, 0.12),
            "action": (0.115, 0.215),
            "symbol": (0.21, 0.3),
            "description": (0.3, 0.525),
            "amount": (0.79, 0.9),
            "summary_opening": (0.02, 0.17),
            "summary_closing": (0.85, 0.99),
        }
    )
    doc_fields: dict[str, str] = field(
        default_factory=lambda: {
            "account_number": r"(\d{4}-\d{4})",
            "statement_period": r"([A-Za-z]+\s*\d{1,2}\s*-\s*\d{1,2},\s*\d{4})",
        }
    )
    summary_start: str | None = r"^Transactions\s*-\s*Summary$"
    section_start: str = r"^Transaction\s+Details$"
    section_continue: str | None = r"^Transaction\s+Details\s*\(continued\)$"
    section_end: tuple[str, ...] = (r"^Total\s*Transactions", r"^Bank\s+Sweep\s+Activity$")
    category_continuations: tuple[str, ...] = ("activity",)
    skip_rows: tuple[str, ...] = (
        r"^\(continued\)$",
        r"^Symbol/.*Price/Rate.*Charges/.*Realized",
        r"^Date\s+Category\s+Action.*",
        r"^Date\s*column\s*represents",
    )
    repeated_header: str = r"\bDate\b.*\bCategory\b.*\bAction\b"
    debit_value: str = "DB"
    credit_value: str = "CR"
    include_raw: bool = True
    field_map: dict[str, str] = field(
        default_factory=lambda: {
            "subaccount": "account_number",
            "currency": "currency",
            "openingbalance": "opening_balance",
            "closingbalance": "closing_balance",
            "openingbalancedate": "period_start_date",
            "closingbalancedate": "period_end_date",
            "itemdate": "posting_date",
            "description": "description",
            "amount": "amount",
            "dbcr_10": "dbcr",
        }
    )


PROFILES = {p.name: p for p in (TableProfile(), BankProfile())}

# Template names of request messages.
PROFILE_BY_TEMPLATE = {
    "NT": "northern_trust_daily",
    "NORTHERN_TRUST": "northern_trust_daily",
    "SCHWAB": "charles_schwab",
    "CHARLES_SCHWAB": "charles_schwab",
}
DEFAULT_PROFILE = "northern_trust_daily"


def profile_of_template(template: Column) -> Column:
    """Profile of a template name: blank means the default, an unknown name gives null."""
    key = F.upper(F.trim(F.coalesce(template, F.lit(""))))
    out = F.when(key == "", DEFAULT_PROFILE)
    for name, profile in PROFILE_BY_TEMPLATE.items():
        out = out.when(key == name, profile)
    return out


def detect_table(spark: SparkSession, profiles: dict | None = None) -> DataFrame:
    """``(ord, profile, pattern)`` of the known profiles, in name order."""
    known = sorted((profiles or PROFILES).values(), key=lambda p: p.name)
    return spark.createDataFrame(
        [(i, p.name, p.detect) for i, p in enumerate(known) if p.detect], "ord int, profile string, pattern string"
    )


def detect_profile(first_pages: DataFrame, patterns: list[tuple[str, str]]) -> DataFrame:
    """Add ``profile``: the first (in the order given) whose pattern occurs in the text of page 1.

    The patterns are a handful of configured literals, so they become one conditional expression that is
    evaluated row by row; nothing is joined and no pair is formed.
    """
    found = F.lit(None).cast("string")
    for name, pattern in reversed(patterns):
        found = F.when(F.col("text").rlike(f"(?i){pattern}"), name).otherwise(found)
    return first_pages.withColumn("profile", found)
