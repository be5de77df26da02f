"""Default rule values.

Fixed values: results only agree with the specified behaviour when these are
exactly as given. Every operator takes them as arguments.
"""

# E-mail pattern used by the expectation suite.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Countries a user event may carry.
COUNTRIES = ("US", "UK", "CA", "AU", "DE", "FR")

# Inclusive age bounds.
AGE_RANGE = (0, 150)

# Allowed order-status transitions and the initial status.
ORDER_TRANSITIONS = {
    "pending": ["confirmed", "cancelled"],
    "confirmed": ["shipped", "cancelled"],
    "shipped": ["delivered", "returned"],
    "delivered": ["returned"],
    "cancelled": [],
    "returned": [],
}
INITIAL_STATUS = "pending"

# Dead-letter categories.
VALIDATION_ERRORS = "validation_errors"
PROCESSING_ERRORS = "processing_errors"
UNKNOWN_ERRORS = "unknown_errors"

# Default thresholds of the quality checks.
NULL_THRESHOLD_PCT = 5.0
MAX_AGE_HOURS = 24
STDDEV_THRESHOLD = 3.0
DUPLICATE_RATE_ALERT = 0.01
DRIFT_ALERT_PCT = 20.0

# Formats this library adds beside the e-mail pattern.
URL_PATTERN = r"^https?://[A-Za-z0-9.-]+\.[A-Za-z]{2,}(:[0-9]+)?([/?#].*)?$"
PHONE_PATTERN = r"^\+?[0-9][0-9 ().-]{5,18}[0-9]$"
IPV4_PATTERN = (
    r"^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}"
    r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
)
