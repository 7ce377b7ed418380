"""Event schema, domain vocabularies and identifier patterns.

Everything in this module is a fixed value of the data contract: names, types,
word lists and patterns must be exactly these for results to be right.
"""

from __future__ import annotations

# --- fixed values: event columns -------------------------------------------------
EVENT_SCHEMA = """
    event_id STRING, event_type STRING, user_id STRING, session_id STRING, timestamp STRING,
    page_url STRING, page_type STRING, time_on_page_seconds DOUBLE, referrer STRING,
    device_type STRING, country STRING,
    element_id STRING, element_type STRING, x_position INT, y_position INT,
    query STRING, results_count INT,
    product_id STRING, category STRING, price DOUBLE, action STRING
"""

# --- fixed values: vocabularies --------------------------------------------------
EVENT_TYPES = ("page_view", "click", "search", "product_view", "cart_event")
PAGE_TYPES = ("home", "category", "product", "cart", "checkout", "search", "other")
DEVICE_TYPES = ("mobile", "desktop", "tablet")
CART_ACTIONS = ("add", "remove")
ELEMENT_TYPES = ("button", "link", "image", "banner", "menu", "filter")
PRODUCT_CATEGORIES = (
    "electronics", "clothing", "home", "sports", "books", "beauty", "toys", "food",
)
COUNTRIES = ("MX", "CO", "AR", "ES", "PE", "CL", "US", "BR", "UY", "EC")
BROWSERS = ("chrome", "safari", "firefox", "edge", "opera")
AGE_BUCKETS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
TRANSACTION_STATUS = ("completed", "pending", "failed", "refunded")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "transfer", "cash_on_delivery")
REFERRER_SOURCES = ("organic", "paid", "social", "direct", "email", "referral")
UNKNOWN = "UNKNOWN"

# --- fixed values: identifier patterns -------------------------------------------
EVENT_ID = "^E[a-f0-9]{16}$"
USER_ID = "^U[0-9]{8}$"
SESSION_ID = "^S[a-f0-9]{12}$"
PRODUCT_ID = "^P[0-9]{6}$"
TRANSACTION_ID = "^T[a-f0-9]{16}$"
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"

# Columns no metric reads; the batch job leaves them out before the first shuffle.
METRIC_INPUT_COLUMNS = (
    "event_id", "event_type", "user_id", "session_id", "event_ts", "dt",
    "page_url", "page_type", "time_on_page_seconds", "device_type", "country",
    "product_id", "category", "action",
)
