"""Names and constants of the order data model.

Fixed values: the column lists, flag pattern, ordinal levels, model parameters and
labels below are part of the data contract and are stated as they are.
"""

# --- raw and silver orders -------------------------------------------------

DATE_PARTS = ["Month", "Day", "Year"]
DATE_PATTERN = "M/d/yyyy"

DOUBLE_COLUMNS = [
    "Unit_Price", "Discount_Amount", "Shipping_Cost", "Tax_Amount", "Order_Amount",
    "Review_Rating", "Customer_Lifetime_Value", "Profit_Amount", "Profit_Margin_Percent",
]
INT_COLUMNS = ["Quantity", "Discount_Percent", "Delivery_Days", "Quarter", "Customer_Age"]

FLAG_COLUMNS = ["Coupon_Used", "Returned", "High_Value_Order"]
FLAG_PATTERN = "(?i)^(yes|y|true|1)$"

LOWERCASE_COLUMNS = [
    "Customer_Gender", "Payment_Method", "Device_Type", "Traffic_Source", "Order_Status",
    "Membership_Status", "Season", "Holiday_Season", "Shipping_Method", "Warehouse_Region",
    "Customer_Segment", "Country", "City", "Brand", "Product_Category", "Product_Subcategory",
]

MEMBERSHIP_COLUMN = "Membership_Status"
MEMBERSHIP_LEVELS = {"standard": 0, "silver": 1, "gold": 2, "platinum": 3}

FEATURE_INPUTS = [
    "Customer_ID", "Order_ID", "Order_Amount", "Order_Date", "Product_ID", "Product_Category",
    "Product_Subcategory", "Brand", "Quantity", "Returned", "Review_Rating",
    "Profit_Margin_Percent", "Customer_Segment", "Customer_Lifetime_Value",
    "Membership_Status", "Customer_Age",
]

# --- customer features -----------------------------------------------------

# (lowest age of the band, label); younger than the first band is UNDER_AGE
AGE_BANDS = [
    (18, "18-24"), (25, "25-34"), (35, "35-44"), (45, "45-54"), (55, "55-64"), (65, "65+"),
]
UNDER_AGE = "Under 18"
UNKNOWN_AGE = "Unknown"

# (lowest RFM score, segment), best first
RFM_SEGMENTS = [
    (13, "Champions"), (10, "Loyal Customers"), (7, "Potential Loyalists"), (4, "At Risk"),
]
RFM_LOWEST_SEGMENT = "Lost / Churned"
RFM_TILES = 5

# --- transaction features and model ----------------------------------------

LABEL = "returned"
SPLIT_KEY = "order_id"

LEAKAGE_COLUMNS = [
    "order_id", "customer_id", "product_id", "order_status", "membership_status_ord",
]
NUMERIC_FEATURES = [
    "quarter", "customer_age", "unit_price", "quantity", "discount_percent", "discount_amount",
    "shipping_cost", "tax_amount", "order_amount", "delivery_days", "review_rating",
    "customer_lifetime_value", "profit_margin_percent", "profit_amount", "high_value_order",
    "order_year", "order_month", "order_day", "order_dow",
]
CATEGORICAL_FEATURES = [
    "customer_gender", "country", "customer_segment", "product_category", "product_subcategory",
    "brand", "payment_method", "device_type", "traffic_source", "membership_status",
    "shipping_method", "warehouse_region", "season", "holiday_season", "day_of_week",
]
CAPPED_FEATURES = ["brand", "product_subcategory"]
RARE_MIN_COUNT = 30
RARE_LABEL = "Other"

TRAIN_PERCENT = 80
SPLIT_SEED = 42
FOREST_TREES, FOREST_DEPTH = 100, 8
BALANCED_TREES, BALANCED_DEPTH = 200, 10

THRESHOLDS = [0.30, 0.40, 0.50, 0.60, 0.70]
SERVING_THRESHOLD = 0.50

# (lowest probability, label), best first
RISK_LABELS = [
    (0.75, "High return risk"), (0.50, "Likely return"), (0.30, "Moderate return risk"),
]
LOWEST_RISK_LABEL = "Low return risk"

COMPARED_METRICS = ["roc_auc", "accuracy", "precision", "recall", "f1"]
COMPARISON_COLUMNS = [
    "model_name", "framework", "class_weighting", "decision_threshold", "roc_auc", "accuracy",
    "precision", "recall", "f1", "true_negative", "false_positive", "false_negative",
    "true_positive", "train_rows", "test_rows", "source_run_id", "recommendation",
]
REGISTRY_METRICS = [
    "test_auc", "test_accuracy", "test_precision", "test_recall", "test_f1",
    "true_negative", "false_positive", "false_negative", "true_positive",
]
REGISTRY_PARAMS = ["train_rows", "test_rows"]
TUNED_RECOMMENDATION = "High-precision return-risk alerts"
BALANCED_RECOMMENDATION = "High-recall return detection"
