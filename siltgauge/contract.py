"""The transaction contract: field names, rule parameters, messages and fixed value lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. They have to equal the values of the system this engine is
# compatible with, otherwise verdicts and details would differ.
# ---------------------------------------------------------------------------

REQUIRED_FIELDS = (
    "order_id",
    "customer_id",
    "product_id",
    "quantity",
    "price",
    "tax_amount",
    "payment_method",
    "timestamp",
)

ALLOWED_PAYMENT_METHODS = ("UPI", "Credit Card", "Debit Card", "Cash", "Net Banking", "Wallet")

SYNTH_PAYMENT_METHODS = ("Credit Card", "Debit Card", "UPI", "Net Banking")
SYNTH_PRODUCTS = tuple(f"P{n}" for n in range(501, 511))

ANOMALY_KINDS = ("null", "schema", "negative-price", "invalid-numeric", "invalid-enum", "duplicate-id")

NULLABLE_FIELDS = (
    "customer_id",
    "product_id",
    "payment_method",
    "price",
    "quantity",
    "tax_amount",
    "timestamp",
)
RENAMES = (("customer_id", "customer"), ("product_id", "product"))
REMOVABLE_FIELDS = ("timestamp", "payment_method", "customer_id")
BAD_PAYMENT_METHODS = ("UnknownMethod", "Crypto", "Bitcoin", "InvalidPay")
BAD_PRODUCT = "P999_INVALID"
EXTRA_FIELD, EXTRA_VALUE = "unexpected_field", "extra_unstructured_data"
EXTRA_NUMBER_FIELD, EXTRA_NUMBER = "unexpected_extra", 123

# Money ranges in cents: integer draws keep decimals exact on every engine.
PRICE_CENTS = (10_000, 500_000)
BAD_PRICE_CENTS = (1_000, 50_000)
BAD_TAX_CENTS = (500, 5_000)
TAX_RATE = "0.18"

# ---------------------------------------------------------------------------

MALFORMED = "Malformed record"
PAYMENT_RULE = "Invalid payment_method"
PRODUCT_RULE = "Invalid product_id"

#: Schema of a validated, typed transaction.
TYPED_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.DecimalType(38, 0)),
        T.StructField("price", T.DecimalType(12, 2)),
        T.StructField("tax_amount", T.DecimalType(14, 2)),
        T.StructField("payment_method", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class RuleSet:
    """Parameters of the validator.

    ``order_id_type``
        ``"string"`` (non-blank text) or ``"integer"`` (the documented schema type).
    ``payment_methods``
        allowed payment methods.
    ``products``
        optional closed list of product ids; ``None`` leaves the product domain unchecked.
    """

    order_id_type: str = "string"
    payment_methods: tuple[str, ...] = ALLOWED_PAYMENT_METHODS
    products: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.order_id_type not in ("string", "integer"):
            raise ValueError("order_id_type must be 'string' or 'integer'.")
        if not self.payment_methods:
            raise ValueError("payment_methods must not be empty.")
