"""Schemas, rule lists and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

EPOCH_1998 = "1998-01-01 00:00:00"

# --- fixed values -----------------------------------------------------------------------------

# Columns read as numbers even when they arrive as text.
NUMERIC_TEXT_COLUMNS = ["int_rate", "annual_inc", "dti", "revol_util", "emp_length", "loan_amnt", "installment"]

# Valid ranges; values outside are moved to the nearer end.
VALID_RANGES = {
    "int_rate": (0.0, 30.0),
    "annual_inc": (0.0, 1e8),
    "dti": (0.0, 100.0),
    "loan_amnt": (0.0, 1e6),
}

# Loan statuses that count as a default; all others, known or not, count as paid.
DEFAULT_STATUSES = [
    "Charged Off",
    "Default",
    "Late (31-120 days)",
    "Late (16-30 days)",
    "Does not meet the credit policy. Status:Charged Off",
    "Default Receiver",
]

GRADES = "ABCDEFG"
CONSOLIDATION_PURPOSES = ["debt_consolidation", "credit_card"]
LONG_EMPLOYMENT_YEARS = 5
EPSILON = 1e-8

# column → (new column, upper edges, labels); the last bracket is open-ended.
BRACKETS = {
    "annual_inc": (
        "income_bracket",
        [30000, 50000, 75000, 100000],
        ["Low", "Lower_Middle", "Middle", "Upper_Middle", "High"],
    ),
    "loan_amnt": (
        "loan_bracket",
        [5000, 15000, 25000, 35000],
        ["Very_Small", "Small", "Medium", "Large", "Very_Large"],
    ),
    "int_rate": (
        "int_rate_bracket",
        [8, 12, 16, 20],
        ["Very_Low", "Low", "Medium", "High", "Very_High"],
    ),
}

# column → (flag, limit): the flag is set strictly above the limit.
RISK_LIMITS = {
    "dti": ("high_dti_risk", 25),
    "int_rate": ("high_interest_risk", 15),
    "revol_util": ("high_revol_util_risk", 80),
}

# Text a CSV reader commonly treats as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- request rules ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Constraints of one request field."""

    field: str
    type: str
    required: bool = True
    gt: float | None = None
    ge: float | None = None
    le: float | None = None
    pattern: str | None = None


def _amounts(*names: str) -> list[Rule]:
    return [Rule(n, "double", ge=0) for n in names]


def _counts(*names: str) -> list[Rule]:
    return [Rule(n, "int", ge=0) for n in names]


# Field names, limits and patterns of a scoring request.
REQUEST_RULES = [
    Rule("loan_id", "string", required=False),
    Rule("loan_amnt", "double", gt=0),
    Rule("term", "string", pattern="^(36|60) months$"),
    Rule("int_rate", "double", gt=0, le=100),
    Rule("installment", "double", gt=0),
    Rule("grade", "string", pattern="^[A-G]$"),
    Rule("sub_grade", "string", pattern="^[A-G][1-5]$"),
    Rule("emp_length", "double", required=False),
    Rule("home_ownership", "string", pattern="^(OWN|RENT|MORTGAGE|OTHER|NONE|ANY)$"),
    Rule("annual_inc", "double", ge=0),
    Rule("verification_status", "string", pattern="^(Verified|Source Verified|Not Verified)$"),
    Rule("purpose", "string"),
    Rule("dti", "double", ge=0),
    *_counts("delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal"),
    Rule("revol_util", "double", required=False, ge=0, le=100),
    *_counts("total_acc"),
    Rule("initial_list_status", "string", pattern="^[fw]$"),
    *_amounts(
        "total_pymnt",
        "total_pymnt_inv",
        "total_rec_prncp",
        "total_rec_int",
        "total_rec_late_fee",
        "recoveries",
        "collection_recovery_fee",
        "last_pymnt_amnt",
    ),
]

REQUEST_SCHEMA = ", ".join(f"{r.field} {r.type}" for r in REQUEST_RULES)

PREDICTION_SCHEMA = (
    "loan_id string, prediction int, probability_default double, probability_repayment double, risk_level string, "
    "model_type string, model_name string, model_version string, features_source string, predicted_at timestamp"
)

# --- thresholds -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Limit:
    """A bound on a named metric: passes when ``value <op> bound`` holds."""

    metric: str
    op: str
    bound: float
    required: bool = True


# Floors of the three gate profiles and the promotion checklist.
MIN_AUC = 0.7
MIN_AUC_STRICT = 0.75
MAX_DISPARITY = 0.1
PROMOTION_LIMITS = [
    Limit("auc", ">=", 0.78),
    Limit("precision", ">=", 0.70),
    Limit("auc_gap", "<=", 0.05),
    Limit("max_positive_rate_difference", "<=", 0.10),
    Limit("max_true_positive_rate_difference", "<=", 0.10),
    Limit("cv_auc_std", "<=", 0.03),
    Limit("p95_latency_ms", "<=", 50.0),
]

# Alert levels; an alert fires once its level has been exceeded for a minute.
ALERT_LIMITS = {
    "drift_share": 0.3,
    "prediction_drift": 0.15,
    "error_ratio": 0.05,
    "p95_latency": 0.5,
}
ALERT_HOLD_SECONDS = 60
# how long a value stands if no newer one comes: drift is measured every hour, requests every minute
ALERT_LIFETIMES = {"drift_share": 3600, "prediction_drift": 3600, "error_ratio": 60, "p95_latency": 60}

FEATURE_TTL_SECONDS = 3600
RISK_HIGH = 0.7
RISK_MEDIUM = 0.3
