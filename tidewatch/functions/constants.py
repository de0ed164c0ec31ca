"""Fixed values that must equal the behaviour being reproduced.

Everything here is data (names, thresholds, word lists, text templates);
the logic that uses it lives in the operator modules.
"""

import numpy as np

# ---------------------------------------------------------------------------
# FIXED VALUES — raw employee schema and domains
# ---------------------------------------------------------------------------
# Required raw columns, in check order, with the expected kind of type.
REQUIRED_COLUMNS = [
    ("satisfaction_level", "numeric"),
    ("last_evaluation", "numeric"),
    ("number_project", "numeric"),
    ("average_montly_hours", "numeric"),
    ("time_spend_company", "numeric"),
    ("Work_accident", "numeric"),
    ("promotion_last_5years", "numeric"),
    ("salary", "text"),
    ("sales", "text"),
    ("left_flag", "numeric"),
]

# Inclusive numeric domains, in check order.
RANGE_RULES = [
    ("satisfaction_level", 0, 1),
    ("last_evaluation", 0, 1),
    ("number_project", 0, 20),
    ("average_montly_hours", 0, 400),
    ("time_spend_company", 0, 50),
]
# Set-membership domains, in check order (after the ranges).
SET_RULES = [
    ("Work_accident", [0, 1]),
    ("promotion_last_5years", [0, 1]),
    ("salary", ["low", "medium", "high"]),
]

SALARY_LEVELS = ["low", "medium", "high"]
SALARY_ORDINAL = {"low": 1, "medium": 2, "high": 3}
SALARY_ORDINAL_VARIANT = {"low": 0, "medium": 1, "high": 2}

NUMERIC_PROFILE_COLUMNS = [
    "satisfaction_level",
    "last_evaluation",
    "number_project",
    "average_montly_hours",
    "time_spend_company",
]
CORRELATION_COLUMNS = NUMERIC_PROFILE_COLUMNS + ["left_flag"]

# ---------------------------------------------------------------------------
# FIXED VALUES — policy-violation rules and department-week features
# ---------------------------------------------------------------------------
VIOLATION_FLAGS = [
    "v1_overtime",
    "v2_overload_satisfaction",
    "v3_stagnation",
    "v4_post_accident_overwork",
]
LAGGED_COLUMNS = [f"{v}_sum" for v in VIOLATION_FLAGS] + ["violation_density", "attrition_rate"]

# Variant rules on department-week means.
FIXED_RULE_HOURS = 200
FIXED_RULE_SATISFACTION = 0.3
FIXED_RULE_TENURE = 5
FIXED_RULE_PROJECTS = 6

SYNTHETIC_WEEK_START = "2024-01-01"
ROWS_PER_WEEK = 50
ROWS_PER_WEEK_VARIANT = 500

# ---------------------------------------------------------------------------
# FIXED VALUES — scoring, index weights, thresholds
# ---------------------------------------------------------------------------
FUSION_WEIGHT_SUPERVISED = 0.7
ANOMALY_FILL = 0.5
DPI_WEIGHTS = {"retention": 0.4, "workload": 0.4, "compliance": 0.2}
FN_WEIGHT = 10.0
FP_WEIGHT = 1.0
PARITY_LIMIT = 0.05
FNR_GAP_LIMIT = 0.05
EMPLOYEE_ALERT_FRACTION = 0.8


def grid_101():
    """Sweep grid 1: 101 evenly spaced thresholds on [0, 1]."""
    return np.linspace(0.0, 1.0, 101).tolist()


def grid_100():
    """Sweep grid 2: 100 evenly spaced thresholds on [0, 1]."""
    return np.linspace(0.0, 1.0, 100).tolist()


def grid_91():
    """Sweep grid 3: 0.05 up to (not incl.) 0.96 in steps of 0.01 — 91 points."""
    return np.arange(0.05, 0.96, 0.01).tolist()


def uniform_inner_edges(n_bins: int = 10):
    """Inner edges of ``n_bins`` equal-width probability bins on [0, 1]."""
    return np.linspace(0.0, 1.0, n_bins + 1)[1:-1].tolist()


# ---------------------------------------------------------------------------
# FIXED VALUES — alert drivers, phrases, allow-list, templates
# ---------------------------------------------------------------------------
# Driver rules in evaluation order: (name, column, comparison, threshold).
DRIVER_RULES = [
    ("attrition_rate", "attrition_rate", ">=", 0.25),
    ("average_montly_hours_mean", "average_montly_hours_mean", ">=", 210),
    ("satisfaction_level_mean", "satisfaction_level_mean", "<=", 0.45),
    ("time_spend_company_mean", "time_spend_company_mean", ">=", 4),
    ("v1_overtime_sum", "v1_overtime_sum", ">", 0),
    ("v2_overload_satisfaction_sum", "v2_overload_satisfaction_sum", ">", 0),
    ("v3_stagnation_sum", "v3_stagnation_sum", ">", 0),
    ("v4_post_accident_overwork_sum", "v4_post_accident_overwork_sum", ">", 0),
    ("violation_density", "violation_density", ">", 0),
]
DRIVER_FALLBACK = "fused_score_pattern"
MAX_DRIVERS = 5

DRIVER_PHRASES = {
    "v1_overtime_sum": "overtime pressure",
    "v2_overload_satisfaction_sum": "high workload with low satisfaction",
    "v3_stagnation_sum": "career stagnation",
    "v4_post_accident_overwork_sum": "post-accident overwork pattern",
    "violation_density": "elevated violation density",
    "average_montly_hours_mean": "high average monthly hours",
    "time_spend_company_mean": "long tenure concentration",
    "satisfaction_level_mean": "lower average satisfaction",
    "attrition_rate": "elevated attrition rate",
    "leavers": "higher number of leavers",
}

ALERT_ALLOWLIST = [
    "dept", "weekly_ts", "headcount", "leavers", "attrition_rate",
    "top_drivers", "risk_score", "threshold", "notes", "warning",
]
MAX_FIELD_LEN = 500
MAX_LIST_ITEMS = 20

ALERT_NOTE = "Simulated weekly monitoring on HR prototype data."
# Sentences of the summary, cut at the values they hold.
SUMMARY_HEADER = ("Department ", " for week ", " was scored by the early-warning layer.")
SUMMARY_RISK = ("Risk score is ", " against threshold ", ". Warning status: ", ".")
SUMMARY_STATUS = ("triggered", "not triggered")
SUMMARY_CONTEXT = ("Context: ", "headcount ", "leavers ", "attrition rate ")
SUMMARY_DRIVERS = ("Primary driver appears to be ", "Main drivers appear to be ", ", and ")
SUMMARY_NOTE = "Additional note: "
SUMMARY_ADVISORY = "This summary is advisory only. Any HR action requires human review and confirmation."

# Characters removed by a whitespace strip (the Unicode whitespace set).
WHITESPACE_CLASS = (
    r"[\x{0009}-\x{000D}\x{001C}-\x{0020}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# ---------------------------------------------------------------------------
# FIXED VALUES — governance scan
# ---------------------------------------------------------------------------
SECRET_KEYWORDS = ["password", "secret", "key", "token", "api_key", "private_key", "credential", "auth"]
SEVERITY_PENALTY = {"CRITICAL": 20, "HIGH": 10, "MEDIUM": 5}
