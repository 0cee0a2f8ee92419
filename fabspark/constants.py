"""Fixed values that results depend on. They are definitions, not tuning knobs."""

# Sensors followed by the control charts.
MONITORED_SENSORS = ["59", "103", "511", "424", "158"]

# Candidate sensors of the failure Pareto.
PARETO_SENSORS = [
    "59", "103", "511", "424", "158",
    "4", "5", "6", "7", "8", "9", "10", "11", "12", "13",
    "57", "58", "60", "61", "62",
    "100", "101", "102", "104", "105",
    "200", "201", "202", "300", "400",
]

# Raw layout and data-quality limit (20 % of 590 sensors).
SENSOR_COUNT = 590
MAX_MISSING = 118
QUARANTINE_REASON = "CRITICAL_NULL_THRESHOLD_EXCEEDED"
KEY_NULL_MARK = "_dbt_utils_surrogate_key_null_"

# Version texts stamped on tables.
REPORTING_LOGIC = "dbt_reporting_v1"
BASELINE_LOGIC = "v1.0_phase1_frozen"

# Control-chart baseline.
BASELINE_READINGS = 100
BASELINE_MIN_READINGS = 30
RAW_SIGMA_FALLBACK = 0.0001
SPEC_SIGMAS = 3.99
GOLDEN_LINE = "LINE_A"

# Run rules, by number.
RULE_NAMES = {
    1: "Rule 1: Beyond 3σ",
    2: "Rule 2: 9 on one side",
    3: "Rule 3: 6 trending",
    4: "Rule 4: 14 alternating",
    5: "Rule 5: 2/3 beyond 2σ",
}
# Points in the run that each rule looks at.
RULE_SPANS = {1: 1, 2: 9, 3: 6, 4: 14, 5: 3}

# Equipment effectiveness targets.
SHIFTS_PER_DAY = 1.0
WAFERS_PER_DAY = 20.0

# Direction texts of the failure Pareto.
DIRECTION_UP = "Higher reading → more failures"
DIRECTION_DOWN = "Higher reading → fewer failures"
DIRECTION_NONE = "No association"

# Steps of the yield-loss waterfall.
WATERFALL_STEPS = [
    ("Input wafers", "absolute"),
    ("Quarantined (data quality)", "relative"),
    ("Failed (process)", "relative"),
    ("Final yield", "total"),
]

# Relative drift above which a sensor counts as drifted.
DRIFT_LIMIT = 0.1
