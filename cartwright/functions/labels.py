"""The words and thresholds that reports must print verbatim."""

# fixed values: order, payment and channel domains
ORDER_STATUSES = ["pending", "processing", "shipped", "delivered", "cancelled", "returned"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "apple_pay", "upi", "bank_transfer"]
PAYMENT_STATUSES = ["completed", "pending", "failed", "refunded"]
ACQUISITION_CHANNELS = [
    "Organic Search",
    "Direct",
    "Google Ads",
    "Meta Ads",
    "Email Campaign",
    "Affiliate",
    "Referral",
]
CANCELLED = "cancelled"
OPEN_STATUSES = ["pending", "processing", "shipped"]
NO_DELIVERY_STATUSES = ["pending", "processing", "cancelled"]

# fixed values: customer segment names
CHAMPIONS = "Champions"
LOYAL = "Loyal Customers"
RECENT = "Recent Promising"
BIG_SPENDERS = "Big Spenders"
NEED_ATTENTION = "Need Attention"
AT_RISK = "At Risk Customers"
HIBERNATING = "Hibernating High Value"
LOST = "Lost Customers"
STANDARD = "Standard Buyers"

# fixed values: segment rules over the three scores; the first that holds names the segment
SEGMENT_RULES = [
    (CHAMPIONS, "r >= 4 AND f >= 4 AND m >= 4"),
    (LOYAL, "r >= 3 AND f >= 3 AND m >= 3"),
    (RECENT, "r >= 4 AND f BETWEEN 1 AND 2"),
    (BIG_SPENDERS, "r >= 3 AND f >= 1 AND m >= 4"),
    (NEED_ATTENTION, "r BETWEEN 2 AND 3 AND f >= 3"),
    (AT_RISK, "r <= 2 AND f >= 3 AND m >= 3"),
    (HIBERNATING, "r <= 2 AND f <= 2 AND m >= 3"),
    (LOST, "r <= 2 AND f <= 2 AND m <= 2"),
]


def segment_case(otherwise: str = STANDARD) -> str:
    """SQL that names the segment of columns r, f and m."""
    rules = " ".join(f"WHEN {rule} THEN '{name}'" for name, rule in SEGMENT_RULES)
    return f"CASE {rules} ELSE '{otherwise}' END"

# fixed values: Pareto tiers (upper bound of the cumulative share, name)
TIER_A = (80.0, "Tier A (Top 80% Driver)")
TIER_B = (95.0, "Tier B (Mid 15% Contributor)")
TIER_C = "Tier C (Tail 5% Long-Tail)"

# fixed values: review flags (lowest average rating, name)
RATED_HIGH = (4.2, "⭐ Highly Rated")
RATED_FAIR = (3.5, "👍 Satisfactory")
RATED_LOW = "⚠️ Quality Investigation Warranted"

# fixed values: text of the first month's growth
BASE_MONTH = "N/A (Base)"

# fixed values: scorecard status
PASS = "✅ PASS"
FAIL = "❌ FAIL"

# fixed values: names of the data-quality checks
CHECK_NAMES = {
    "orders_customer": "Orders with missing customer",
    "items_order": "Order items with missing order",
    "items_product": "Order items with missing product",
    "payments_order": "Payments with missing order",
    "reviews_parents": "Reviews with missing foreign keys",
    "delivery_before_order": "Delivery timestamp prior to order date",
    "future_order": "Future-dated order placement",
    "review_before_customer": "Reviews created before customer registration",
    "negative_margin": "Products with negative margin (sale < cost)",
    "non_positive_line": "Line items with non-positive quantities or prices",
    "discount_over_subtotal": "Discount amount exceeding order subtotal",
    "total_mismatch": "Order header total amount reconciliation mismatch",
    "lines_mismatch": "Order header subtotal vs line items sum mismatch",
    "delivered_no_date": "Delivered orders missing delivery date",
    "undelivered_with_date": "Undelivered orders with delivery date populated",
    "paid_cancelled": "Cancelled orders with settled payments",
    "dup_email": "Duplicate customer emails",
    "dup_sku": "Duplicate product SKUs",
    "dup_transaction": "Duplicate gateway transaction IDs",
}

# fixed values: scorecard rules (check, category, test name), in rule-id order from 1
SCORECARD_RULES = [
    ("orders_customer", "Referential Integrity", "Orders -> Customers FK Resolution"),
    ("items_order", "Referential Integrity", "Order Items -> Orders FK Resolution"),
    ("items_product", "Referential Integrity", "Order Items -> Products FK Resolution"),
    ("payments_order", "Referential Integrity", "Payments -> Orders FK Resolution"),
    ("delivery_before_order", "Temporal Sequence", "Delivery Date >= Order Date"),
    ("future_order", "Temporal Sequence", "No Future Order Timestamps"),
    ("negative_margin", "Financial Sanity", "Sale Price >= Cost Price (Non-negative Margins)"),
    ("total_mismatch", "Financial Sanity", "Order Total = Subtotal - Discount + Shipping"),
    ("lines_mismatch", "Financial Sanity", "Header Subtotal Reconciles With Item Totals"),
    ("delivered_no_date", "Status Consistency", "Delivered Orders Require Delivery Date"),
    ("paid_cancelled", "Status Consistency", "No Completed Payments on Cancelled Orders"),
    ("dup_email", "Uniqueness & Keys", "Customer Email Uniqueness"),
    ("dup_sku", "Uniqueness & Keys", "Product SKU Uniqueness"),
    ("dup_transaction", "Uniqueness & Keys", "Gateway Transaction ID Uniqueness"),
]
