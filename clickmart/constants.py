"""Fixed values of the data model (they must stay as they are for equal results)."""

# event types
VIEW = "view"
CLICK = "click"
CART_ADD = "cart_add"
PURCHASE = "purchase"

# devices
DEVICES = ("mobile", "desktop", "tablet")

# interaction ratings; every other interaction rates 1.0
RATING_PURCHASE = 5.0
RATING_CART_ADD = 3.0
RATING_OTHER = 1.0

# inactivity gap that ends a session, in seconds
SESSION_GAP_SECONDS = 1800

# enrichment
UNKNOWN_PLACE = "Unknown"
STREAM_SOURCE = "kinesis_stream"

# stream delivery and retention
DELIVERY_INTERVAL = "300 seconds"
RETENTION = "48 hours"

# refresh windows
DAILY_REFRESH_DAYS = 2
COHORT_REFRESH_MONTHS = 6

# customer value
RFM_BUCKETS = 5
BASELINE_LTV_FACTOR = "1.5"
LTV_HORIZON_MONTHS = 12

# recommendations
ALS_MAX_ITER = 10
ALS_REG_PARAM = 0.1
TOP_K = 10
