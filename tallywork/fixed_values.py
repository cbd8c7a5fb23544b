"""Names, labels, patterns and limits that results depend on."""

from decimal import Decimal

# Order and subscription life cycle
PLANS = ("free", "starter", "pro", "enterprise")
ORDER_STATUSES = ("pending", "completed", "refunded", "cancelled")
COMPLETED = "completed"

# Conversion funnel, first step to last
FUNNEL_STEPS = ("page_view", "add_to_cart", "checkout_start", "purchase")
FUNNEL_COLUMNS = ("page_views", "add_to_cart", "checkout", "purchase")
FUNNEL_SHORT_NAMES = ("view", "cart", "checkout", "purchase")
FUNNEL_ENDS = ("views", "purchases")
DROPOFF_LABELS = ("1. Viewed", "2. Added to cart", "3. Started checkout", "4. Purchased")
FUNNEL_SEGMENTS = ("device_type", "referrer")

# Month-on-month growth classes; a factor is compared with the previous month
GROWTH_FIRST = "first_order"
GROWTH_ABOVE = (("strong_growth", Decimal("1.20")), ("moderate_growth", Decimal("1.05")))
GROWTH_AT_LEAST = (("stable", Decimal("0.95")), ("declining", Decimal("0.80")))
GROWTH_REST = "significant_decline"

# Recurring revenue movement classes
NEW, EXPANSION, REACTIVATION = "new", "expansion", "reactivation"
CONTRACTION, CHURN, UNCHANGED = "contraction", "churn", "unchanged"

# Text patterns: the tag of an address, the path of a hierarchy
EMAIL_TAG = r"\+.*$"
PATH_SEPARATOR = " > "
INDENT = "    "

# Defaults
GRANULARITIES = ("day", "week", "month", "quarter", "year")
RETENTION_PERIODS = (0, 1, 2, 3, 6, 12)
SESSION_GAP_MINUTES = 30
RANK_BUCKETS = 100
USER_BUCKETS = 4
USER_FRAMES = (7, 30)
ACTIVE_DAYS = 90
RECENT_DAYS = 90
MAX_DEPTH = 10
PAGE_SIZE = 20
CHUNK_SIZE = 10_000
