"""Input schema, column names and the fixed value lists of the cleaning rules."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw header -> column name used by every operator.
RAW_TO_NAME = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}

# The customer number is read as a double because files carry "12345.0".
RAW_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

LINE_COLUMNS = list(RAW_TO_NAME.values())

# Stock codes that are charges, not goods.
ADMIN_STOCK_CODES = [
    "POST", "D", "C2", "M", "BANK CHARGES", "PADS", "DOT", "CRUK", "AMAZONFEE", "S",
]

# Fixed value: prefix of gift voucher codes.
GIFT_PREFIX = "gift_"

# Fixed value: prefix of cancelled invoices.
CANCEL_PREFIX = "C"

# A description containing one of these (literally) is not a sale.
ADMIN_KEYWORDS = [
    "POSTAGE", "DOTCOM POSTAGE", "CRUK COMMISSION", "MANUAL",
    "AMAZON FEE", "SAMPLES", "ADJUST", "CHECK", "DAMAGED", "LOST",
    "WRONG", "??", "WRONG CODE", "SHIPPING",
]

# Texts that a CSV reader in the pandas tradition takes as missing.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Report order of weekdays (the shop is closed on Saturday).
REPORT_WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Sunday"]

# Segment names, profile texts and suggested actions.
SEGMENT_NOTES = [
    (
        "High-Value",
        "Regular, frequent, recent, and big spenders. They represent your most profitable customer cohort.",
        "Enlist in VIP club, offer premium preview products, send exclusive gifts, and seek referral feedback.",
    ),
    (
        "Regular",
        "Steady, loyal purchasers who buy moderately but consistently.",
        "Offer loyalty points multipliers, cross-sell regular bundles, and send periodic feedback surveys.",
    ),
    (
        "Occasional",
        "Recent buyers who order rarely or sporadically, with smaller overall expenditure.",
        "Incentivize subsequent purchase with limited-time coupons or introduce low-cost bestseller recommendations.",
    ),
    (
        "At-Risk",
        "Dormant customers who haven't completed a transaction in a long time. High chance of churn.",
        "Trigger automated 'We Miss You' emails with deep discounts, execute win-back surveys, or suggest high-popularity products.",
    ),
]
