"""Fixed reference values.

These values must equal the ones the card pipeline uses, so results match.
They are stated here plainly, in their natural order.
"""

from decimal import Decimal

# --- fixed values: valid code lists -------------------------------------------------
VALID_CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD", "JPY", "CHF", "INR"]
VALID_STATUSES = ["approved", "declined", "pending", "reversed", "settled"]
VALID_CHANNELS = ["online", "in_store", "atm", "mobile", "phone"]

# --- fixed values: USD conversion rates (any other currency keeps its amount) --------
USD_RATES = [
    ("USD", Decimal("1")),
    ("EUR", Decimal("1.08")),
    ("GBP", Decimal("1.26")),
    ("CAD", Decimal("0.74")),
    ("AUD", Decimal("0.65")),
    ("JPY", Decimal("0.0067")),
    ("CHF", Decimal("1.13")),
    ("INR", Decimal("0.012")),
]

# --- fixed values: merchant category groups (first match wins, else "Other") --------
CATEGORY_GROUPS = [
    ("Grocery & Food", ["grocery", "supermarket", "food"]),
    ("Transportation", ["gas", "fuel", "automotive"]),
    ("Dining", ["restaurant", "dining", "cafe"]),
    ("Retail", ["retail", "shopping", "clothing"]),
    ("Travel", ["travel", "hotel", "airline"]),
    ("Entertainment", ["entertainment", "streaming", "gaming"]),
    ("Healthcare", ["healthcare", "pharmacy", "medical"]),
    ("Utilities", ["utilities", "telecom", "internet"]),
]
OTHER_GROUP = "Other"

# --- fixed values: merchant regions by country code (else "Other") -----------------
COUNTRY_REGIONS = [
    ("US", "North America"),
    ("CA", "North America"),
    ("GB", "Europe"),
    ("DE", "Europe"),
    ("FR", "Europe"),
    ("JP", "Asia Pacific"),
    ("AU", "Asia Pacific"),
    ("IN", "Asia Pacific"),
]
OTHER_REGION = "Other"

# --- fixed values: categories that mark an online merchant --------------------------
ONLINE_CATEGORIES = ["online", "streaming", "digital"]

# --- fixed values: event ingestion ----------------------------------------------------
EVENT_REQUIRED_FIELDS = ["amount", "currency", "customer_id", "merchant_id", "timestamp", "transaction_id"]
EVENT_MAX_AMOUNT = Decimal("999999.99")
EVENT_SOURCE_TAG = "lambda_ingestion"

# what a cleaned row shows in place of a card number that came unmasked
UNMASKED_MARK = "unmasked "

# --- fixed values: data-quality rules -------------------------------------------------
DQ_REQUIRED_COLUMNS = [
    "transaction_id", "customer_id", "merchant_id", "amount", "currency", "status", "transaction_timestamp",
]
DQ_AMOUNT_MIN = Decimal("0.01")
DQ_AMOUNT_MAX = Decimal("999999.99")
DQ_MIN_ROWS = 100
DQ_FRESHNESS_HOURS = 1

# --- fixed values: monitoring thresholds ----------------------------------------------
METRIC_MIN_ROWS = 1000
METRIC_MAX_NULL_RATE = Decimal("0.001")
METRIC_FRESHNESS_MINUTES = 60
SLA_MIN_THROUGHPUT = 100
SLA_MAX_LATENCY_SECONDS = 120
SLA_LATENCY_YELLOW_SECONDS = 90
SLA_DAILY_TARGET = 30000
SLA_MIN_COVERAGE = Decimal("0.99")
QUALITY_SCORE_BANDS = (90, 99)
PIPELINE_NAME = "transaction_pipeline"

# --- fixed values: unknown dimension member and open-ended validity ------------------
UNKNOWN_KEY = -1
UNKNOWN_ID = "UNKNOWN"
UNKNOWN_NAME = "Unknown"
OPEN_END_DATE = "9999-12-31"
DEFAULT_TIER = "standard"
