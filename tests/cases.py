"""Validator cases: (name, raw JSON text, complete ordered error list)."""

import json

from siltgauge.contract import ALLOWED_PAYMENT_METHODS, REQUIRED_FIELDS

#: a record of our own that keeps every rule
BASE = {
    "timestamp": "2023-11-05T06:07:08.250",
    "payment_method": "Wallet",
    "tax_amount": 0.75,
    "price": 31.25,
    "quantity": 6,
    "product_id": "lamp/4",
    "customer_id": "buyer 17",
    "order_id": "K-88-a",
}
BAD_TIME = "timestamp must be a valid ISO 8601 datetime"
TYPE_ERROR = {
    "order_id": "order_id must be a string",
    "customer_id": "customer_id must be a string",
    "product_id": "product_id must be a string",
    "quantity": "quantity must be an integer",
    "price": "price must be a number",
    "tax_amount": "tax_amount must be a number",
    "payment_method": "Invalid payment_method: None",
    "timestamp": "timestamp must be a string",
}


def changed(**fields):
    return json.dumps({**BASE, **fields})


def without(*fields, **changes):
    return json.dumps({k: v for k, v in {**BASE, **changes}.items() if k not in fields})


def raw(field, literal):
    """The base record with one field given as a JSON literal."""
    return changed(**{field: "@@"}).replace('"@@"', literal)


CONTRACT = [("valid", json.dumps(BASE), [])]
CONTRACT += [(f"missing {f}", without(f), [f"Missing required field: {f}"]) for f in REQUIRED_FIELDS]
CONTRACT += [
    (f"null {f}", changed(**{f: None}), [f"NULL value is not allowed: {f}", TYPE_ERROR[f]]) for f in REQUIRED_FIELDS
]
CONTRACT += [(f"number in {f}", changed(**{f: 7.5}), [TYPE_ERROR[f]]) for f in REQUIRED_FIELDS[:3]]
CONTRACT += [(f"empty {f}", changed(**{f: ""}), [f"{f} cannot be empty"]) for f in REQUIRED_FIELDS[:3]]
CONTRACT += [("blank order_id", changed(order_id=" \n "), ["order_id cannot be empty"])]
CONTRACT += [(f"quantity {q}", changed(quantity=q), ["quantity must be greater than 0"]) for q in (-1, 0, -77)]
CONTRACT += [(f"quantity {q!r}", changed(quantity=q), ["quantity must be an integer"]) for q in ("six", False)]
CONTRACT += [
    ("price below 0", changed(price=-0.01), ["price cannot be negative"]),
    ("price text", changed(price="31.25"), ["price must be a number"]),
    ("price 0", changed(price=0), []),
    ("tax below 0", changed(tax_amount=-3), ["tax_amount cannot be negative"]),
    ("tax text", changed(tax_amount="0.75"), ["tax_amount must be a number"]),
    ("tax 0", changed(tax_amount=0), []),
]
CONTRACT += [(f"pay {p}", changed(payment_method=p), []) for p in ALLOWED_PAYMENT_METHODS]
CONTRACT += [
    ("pay Barter", changed(payment_method="Barter"), ["Invalid payment_method: Barter"]),
    ("other time", changed(timestamp="1999-12-31T23:59:59"), []),
    ("no date", changed(timestamp="on a tuesday"), [BAD_TIME]),
    ("number as time", changed(timestamp=20231105), ["timestamp must be a string"]),
    (
        "several",
        changed(
            customer_id=None, quantity=-2, price=-9.5, tax_amount=-1, payment_method="Barter", timestamp="some day"
        ),
        [
            "NULL value is not allowed: customer_id",
            "customer_id must be a string",
            "quantity must be greater than 0",
            "price cannot be negative",
            "tax_amount cannot be negative",
            "Invalid payment_method: Barter",
            BAD_TIME,
        ],
    ),
]

EXTRA = [
    ("quantity 2.0", raw("quantity", "2.0"), ["quantity must be an integer"]),
    ("quantity 2e0", raw("quantity", "2e0"), ["quantity must be an integer"]),
    ("quantity 30 digits", raw("quantity", "1" * 30), []),
    ("quantity 45 digits", raw("quantity", "1" * 45), []),
    ("quantity 20 digits float", raw("quantity", "12345678901234567890.0"), ["quantity must be an integer"]),
    ("quantity huge negative", raw("quantity", "-" + "1" * 30), ["quantity must be greater than 0"]),
    ("bool price", changed(price=True), ["price must be a number"]),
    ("bool tax", changed(tax_amount=False), ["tax_amount must be a number"]),
    ("exponent price", raw("price", "2e3"), []),
    ("tiny negative price", raw("price", "-1e-300"), ["price cannot be negative"]),
    ("tab customer", changed(customer_id="\t"), ["customer_id cannot be empty"]),
    ("nbsp product", changed(product_id=" "), ["product_id cannot be empty"]),
    ("unit separator", changed(order_id="\x1f"), ["order_id cannot be empty"]),
    (
        "two missing and a bad value",
        without("customer_id", "timestamp", quantity=-2),
        ["Missing required field: customer_id", "Missing required field: timestamp"],
    ),
    ("extra field", changed(unexpected_field="x"), []),
    ("list as id", changed(order_id=["a"]), ["order_id must be a string"]),
    ("pay number", changed(payment_method=4), ["Invalid payment_method: 4"]),
    ("pay true", changed(payment_method=True), ["Invalid payment_method: True"]),
    ("pay 12.50", raw("payment_method", "12.50"), ["Invalid payment_method: 12.5"]),
    ("pay 2.0", raw("payment_method", "2.0"), ["Invalid payment_method: 2.0"]),
    ("pay 1e16", raw("payment_method", "1e16"), ["Invalid payment_method: 1e+16"]),
    ("pay 1e15", raw("payment_method", "1e15"), ["Invalid payment_method: 1000000000000000.0"]),
    ("pay 1.5e-7", raw("payment_method", "1.5e-7"), ["Invalid payment_method: 1.5e-07"]),
    ("pay 0.0001", raw("payment_method", "0.0001"), ["Invalid payment_method: 0.0001"]),
    ("pay -2.5e-300", raw("payment_method", "-2.5e-300"), ["Invalid payment_method: -2.5e-300"]),
    ("pay big int", raw("payment_method", "1" * 45), ["Invalid payment_method: " + "1" * 45]),
    ("pay list", changed(payment_method=["UPI"]), ['Invalid payment_method: ["UPI"]']),
    ("pay empty", changed(payment_method=""), ["Invalid payment_method: "]),
    ("pay lower case", changed(payment_method="upi"), ["Invalid payment_method: upi"]),
    ("malformed", '{"order_id": 1,', ["Malformed record"]),
    ("duplicate keys", '{"a": 1, "a": 2}', ["Malformed record"]),
    ("array", "[1]", [f"Missing required field: {f}" for f in REQUIRED_FIELDS]),
    ("empty object", "{}", [f"Missing required field: {f}" for f in REQUIRED_FIELDS]),
    ("zulu", changed(timestamp="2023-03-04T05:06:07Z"), []),
    ("offset", changed(timestamp="2023-03-04T05:06:07+00:00"), []),
]
