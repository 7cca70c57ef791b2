"""Fixed values.

These constants must equal the reference's for the reports to give the same
answers: pollutant limits, the flat limits, and every label a report writes.
They are listed plainly, together, in natural order.
"""

# Pollutant limits: (pollutant, moderate limit, unhealthy limit).
POLLUTANT_LIMITS = (
    ("PM2.5", 12.0, 35.4),
    ("NO2", 100.0, 200.0),
)

# Flat limit used by compliance, monthly compliance, exceedance days and alerts.
FLAT_LIMIT = 35.4
# Flat limit used by the "Overall Health" line of the executive summary.
SUMMARY_GOOD_LIMIT = 35.0

# Health bands.
HEALTHY = "HEALTHY"
MODERATE = "MODERATE"
UNHEALTHY = "UNHEALTHY"

# Day-over-day trend.
WORSENING = "WORSENING"
IMPROVING = "IMPROVING"
STABLE = "STABLE"

# Location grade.
GOOD = "GOOD"
POOR = "POOR"

# Anomaly status.
ANOMALY = "ANOMALY"
UNUSUAL = "UNUSUAL"
NORMAL = "NORMAL"

# Volatility level.
VOLATILE = "VOLATILE"

# Trend direction.
INCREASING = "INCREASING"
DECREASING = "DECREASING"

# Compliance status.
COMPLIANT = "COMPLIANT"
MOSTLY_COMPLIANT = "MOSTLY COMPLIANT"
NON_COMPLIANT = "NON-COMPLIANT"

# Rankings.
CLEANEST = "CLEANEST"
DIRTIEST = "DIRTIEST"

# Gap status.
MISSING = "MISSING"

# Executive summary.
METRIC_OVERALL_HEALTH = "Overall Health"
METRIC_HIGHEST_RISK = "Highest Risk Location"
METRIC_DAYS_OVER_LIMIT = "Days Over Limit (Last 30d)"
NEEDS_ATTENTION = "NEEDS ATTENTION"

# Health alert.
ALERT = "ALERT"

# Sensor failure candidates.
LIKELY_EQUIPMENT_FAILURE = "LIKELY EQUIPMENT FAILURE"
INVESTIGATE = "INVESTIGATE"

# Weekday names, Sunday = 1 .. Saturday = 7.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
WEEKEND = "Weekend"
WEEKDAY = "Weekday"
WEEKEND_DAYS = (1, 7)

# Policy comparison labels (literal form): weekday number -> label; 1 and 7 have none.
POLICY_DAY_LABELS = (
    (2, "Monday"),
    (3, "Tuesday (No-Smoke)"),
    (4, "Wednesday"),
    (5, "Thursday"),
    (6, "Friday"),
)

# Seasons by month.
SEASONS = (
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
    ("Fall", (9, 10, 11)),
)

# Run history.
RUN_FAILED = "Failed"
RUN_SUCCEEDED = "Succeeded"
FAILURE_RATE_ALERT_PERCENT = 50.0
CIRCUIT_BREAKER_MAX_FAILURES = 5

# Missing-value tokens that a CSV reader must treat as null in every column
# (the default NA token list of the pandas CSV reader).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
