"""Fixed values.

These must equal the reference's for the same results. They are stated here
once, in plain form; the operators take them as defaults and every one of
them can be overridden by an argument.
"""

# Transaction flags.
LATE_NIGHT_BEFORE_HOUR = 6  # hour < 6 is late night
LATE_NIGHT_AFTER_HOUR = 22  # hour > 22 is late night (22:xx is day, 23:xx is night)
WEEKEND_DAYS = ("Saturday", "Sunday")  # Spark's dayofweek numbers them 7 and 1
HIGH_RISK_MERCHANT_ABOVE = 0.5  # risk_score > 0.5 marks a high-risk merchant
RATIO_DENOMINATOR_IF_MISSING = 1.0  # amount / coalesce(customer mean, 1.0)

# Feature views, datasets, refresh.
CUSTOMER_VIEW_NAME = "CUSTOMER_RISK_FEATURES"
TRANSACTION_VIEW_NAME = "TRANSACTION_CONTEXT_FEATURES"
TRAINING_DATASET_NAME = "FRAUD_TRAINING_DATA"
FIRST_VERSION = "V1"
VIEW_REFRESH = "1 hour"
FEATURE_COLUMNS = [
    "total_txn_count",
    "avg_txn_amount",
    "max_txn_amount",
    "stddev_txn_amount",
    "unique_merchants",
    "historical_fraud_count",
    "historical_fraud_rate",
    "active_days",
    "late_night_txn_ratio",
    "credit_score",
    "account_age_days",
    "annual_income",
]

# Training.
TEST_FRACTION = 0.2
CV_FOLDS = 5
RANDOM_SEED = 42
GBT_ITERATIONS = 200
GBT_STEP_SIZE = 0.1
GBT_MAX_DEPTH = 6
POSITIVE_CLASS_WEIGHT = 33.0
PREDICTION_THRESHOLD = 0.5

# Quality gate and score validation.
QUALITY_THRESHOLDS = {"auc": 0.60, "precision": 0.03, "recall": 0.30}
PROBABILITY_SUM_TOLERANCE = 0.01

# Monitoring.
MONITOR_WINDOW = "7 days"
MONITOR_REFRESH = "1 day"
