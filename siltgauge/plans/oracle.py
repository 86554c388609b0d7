"""The registered queries as SQL for an independent engine (DuckDB) on the same tables."""

from __future__ import annotations

from ..contract import (
    ALLOWED_PAYMENT_METHODS,
    ANOMALY_KINDS,
    BAD_PAYMENT_METHODS,
    BAD_PRICE_CENTS,
    BAD_PRODUCT,
    BAD_TAX_CENTS,
    NULLABLE_FIELDS,
    PRICE_CENTS,
    REMOVABLE_FIELDS,
    RENAMES,
    REQUIRED_FIELDS,
    SYNTH_PAYMENT_METHODS,
    SYNTH_PRODUCTS,
)
from ..operators.synth import EPOCH_MICROS
from .fixtures import CLEAN_PAYMENTS, EDGE_KINDS, EDGE_TIMES, SEED, edge_value
from .queries import INJECTIONS, RULE_FAMILIES

TIME = "'%Y-%m-%d %H:%M:%S'"


def draw(salt: str, key: str = "event_id") -> str:
    return f"cast('0x' || substr(md5('{SEED}:{salt}:' || cast({key} AS varchar)), 1, 8) AS bigint)"


def place(salt: str, key: str = "event_id") -> str:
    return f"cast('0x' || substr(md5('{SEED}:{salt}:' || cast({key} AS varchar)), 1, 15) AS bigint)"


def texts(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def choice(salt: str, values, key: str = "event_id") -> str:
    return f"({texts(values)})[1 + {draw(salt, key)} % {len(values)}]"


def integer(salt: str, low: int, high: int, key: str = "event_id") -> str:
    return f"({low} + {draw(salt, key)} % {high - low + 1})"


def money(salt: str, cents: tuple[int, int], precision: int = 12, key: str = "event_id") -> str:
    whole = integer(salt, *cents, key)
    return f"cast(cast({whole} AS decimal(10,0)) * cast(0.01 AS decimal(3,2)) AS decimal({precision},2))"


def tax(price: str, quantity: str) -> str:
    return (
        f"cast(round(cast({price} AS decimal(12,2)) * cast({quantity} AS decimal(20,0))"
        " * cast(0.18 AS decimal(3,2)), 2) AS decimal(30,2))"
    )


_PAYMENT = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{p}'" for e, p in CLEAN_PAYMENTS) + " ELSE 'Wallet' END"

CLEAN = f"""clean AS (
  SELECT event_id, event_type, ts AS ingest_ts,
    'ORD' || cast(event_id AS varchar) AS order_id,
    'C' || cast(user_id + 101 AS varchar) AS customer_id,
    'P' || cast(501 + event_id % 10 AS varchar) AS product_id,
    cast(1 + event_id % 5 AS integer) AS quantity,
    cast(value AS decimal(12,2)) AS price,
    {tax("value", "1 + event_id % 5")} AS tax_amount,
    {_PAYMENT} AS payment_method,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp"
  FROM events)"""


def _member(field: str, name: str | None = None, quoted: bool | None = None) -> str:
    quoted = field not in ("quantity", "price", "tax_amount") if quoted is None else quoted
    column = f'"{field}"'
    mark = "\"" if quoted else ""
    return (
        f"CASE WHEN {column} IS NULL THEN '\"{name or field}\":null' "
        f"ELSE '\"{name or field}\":{mark}' || cast({column} AS varchar) || '{mark}' END"
    )


def _json(members: list[str]) -> str:
    return "'{' || concat_ws(',', " + ", ".join(members) + ") || '}'"


def _record(numeric_id: bool = False) -> str:
    def plain(field: str) -> str:
        return _member(field, quoted=False) if numeric_id and field == "order_id" else _member(field)

    members = {f: plain(f) for f in REQUIRED_FIELDS}
    branches = []
    for old, new in RENAMES:
        kept = [m for f, m in members.items() if f != old]
        branches.append((f"schema_rename_{old}_to_{new}", _json([*kept, _member(old, new)])))
    for field in REMOVABLE_FIELDS:
        branches.append((f"schema_remove_{field}", _json([m for f, m in members.items() if f != field])))
    extra = "'\"unexpected_field\":\"extra_unstructured_data\"'"
    branches.append(("schema_add_unexpected_field", _json([*members.values(), extra])))
    as_text = {**members, "price": _member("price", quoted=True)}
    branches.append(("schema_type_price_to_string", _json(list(as_text.values()))))
    cases = " ".join(f"WHEN '{detail}' THEN {text}" for detail, text in branches)
    return f"CASE anomaly_detail {cases} ELSE {_json(list(members.values()))} END"


def dirty(kind: str = "all", rate: float = 0.05, count: int | None = None) -> str:
    """CTEs ending in ``dirty``."""
    if count is None:
        picked = f"{draw('pick')} < {int(rate * 2**32)}"
    else:
        picked = f"row_number() OVER (ORDER BY {draw('pick')}, event_id) <= {count}"
    category = choice("type", ANOMALY_KINDS) if kind == "all" else f"'{kind}'"
    renames = [f"schema_rename_{old}_to_{new}" for old, new in RENAMES]
    removals = [f"schema_remove_{f}" for f in REMOVABLE_FIELDS]
    numeric = [f"invalid_numeric_negative_{p}" for p in ("price", "quantity", "tax")]
    payments = [f"invalid_enum_payment_{p}" for p in BAD_PAYMENT_METHODS]
    detail = f"""CASE anomaly_category
      WHEN 'null' THEN {choice("null", [f"null_{f}" for f in NULLABLE_FIELDS])}
      WHEN 'schema' THEN CASE {draw("schema")} % 4
        WHEN 0 THEN {choice("rename", renames)} WHEN 1 THEN 'schema_add_unexpected_field'
        WHEN 2 THEN {choice("remove", removals)} ELSE 'schema_type_price_to_string' END
      WHEN 'negative-price' THEN 'negative_price'
      WHEN 'invalid-numeric' THEN {choice("numeric", numeric)}
      WHEN 'invalid-enum' THEN CASE WHEN {draw("enum")} % 2 = 0 THEN {choice("bad_payment", payments)}
        ELSE 'invalid_enum_product_{BAD_PRODUCT}' END
      WHEN 'duplicate-id' THEN 'duplicate_order_id_' || reused END"""
    values = {
        "order_id": "CASE WHEN anomaly_category = 'duplicate-id' THEN reused ELSE order_id END",
        "product_id": f"CASE WHEN anomaly_detail = 'invalid_enum_product_{BAD_PRODUCT}' THEN '{BAD_PRODUCT}' "
        "WHEN anomaly_detail = 'null_product_id' THEN NULL ELSE product_id END",
        "payment_method": "CASE WHEN starts_with(anomaly_detail, 'invalid_enum_payment_') "
        "THEN replace(anomaly_detail, 'invalid_enum_payment_', '') "
        "WHEN anomaly_detail = 'null_payment_method' THEN NULL ELSE payment_method END",
        "price": "CASE WHEN anomaly_detail IN ('negative_price', 'invalid_numeric_negative_price') "
        f"THEN -{money('amount', BAD_PRICE_CENTS)} WHEN anomaly_detail = 'null_price' THEN NULL ELSE price END",
        "quantity": "CASE WHEN anomaly_detail = 'invalid_numeric_negative_quantity' "
        f"THEN -{integer('amount', 1, 5)} WHEN anomaly_detail = 'null_quantity' THEN NULL ELSE quantity END",
        "tax_amount": "CASE WHEN anomaly_detail = 'invalid_numeric_negative_tax' "
        f"THEN -{money('amount', BAD_TAX_CENTS, 14)} "
        "WHEN anomaly_detail = 'null_tax_amount' THEN NULL ELSE tax_amount END",
    }
    for field in ("customer_id", "timestamp"):
        values[field] = f"CASE WHEN anomaly_detail = 'null_{field}' THEN NULL ELSE \"{field}\" END"
    replaced = ", ".join(f'{expression} AS "{field}"' for field, expression in values.items())
    return f"""{CLEAN},
picked AS (SELECT *, CASE WHEN {picked} THEN {category} END AS anomaly_category,
    'ORD' || cast(CASE WHEN event_id > 0 THEN {place("slot")} % event_id ELSE -1 END AS varchar) AS reused FROM clean),
detailed AS (SELECT *, {detail} AS anomaly_detail FROM picked),
corrupted AS (SELECT * REPLACE ({replaced}) FROM detailed),
dirty AS (SELECT event_id, event_type, ingest_ts, {_record()} AS value, anomaly_category, anomaly_detail FROM corrupted)"""


EDGE = f"""{CLEAN},
drawn AS (SELECT *, {draw("edge")} % {EDGE_KINDS} AS kind, {draw("edge_time")} % {len(EDGE_TIMES)} AS time_index
  FROM clean),
edge AS (SELECT event_id, {edge_value('"timestamp"')} AS value FROM drawn)"""

# --- validator --------------------------------------------------------------

_HMS = r"(\d\d)(?::(\d\d)(?::(\d\d)(?:[.,](\d+))?)?|(\d\d)(?:(\d\d)(?:[.,](\d+))?)?)?"
_ISO = (
    r"^(?:(\d{4})-(\d\d)-(\d\d)|(\d{4})(\d\d)(\d\d)|(\d{4})-W(\d\d)(?:-(\d))?|(\d{4})W(\d\d)(\d)?)"
    rf"(?:[\s\S]{_HMS}(Z|([+-]){_HMS})?)?\z"
)
_GROUPS = [f"g{i}" for i in range(1, 29)]


def _number(*groups: int, default: int = 0) -> str:
    merged = " || ".join(f"iso.g{g}" for g in groups)
    return f"coalesce(try_cast(nullif({merged}, '') AS bigint), {default})"


_PARTS = f"""{_number(1, 4, 7, 10)} AS y, {_number(2, 5)} AS mo, {_number(3, 6)} AS d,
  nullif(iso.g8 || iso.g11, '') AS week_text, {_number(8, 11)} AS w, {_number(9, 12, default=1)} AS wd,
  {_number(13)} AS h, {_number(14, 17)} AS mi, {_number(15, 18)} AS s,
  {_number(22)} * 3600 + {_number(23, 26)} * 60 + {_number(24, 27)} AS zone,
  CASE WHEN iso.g21 = '-' THEN -1 ELSE 1 END AS zone_sign,
  cast(rpad(iso.g16 || iso.g19, 6, '0') AS bigint) AS micros"""


def _weekday_shift(year: str) -> str:
    return f"(({year} + {year} // 4 - {year} // 100 + {year} // 400) % 7)"


_LONG_YEAR = f"({_weekday_shift('y')} = 4 OR {_weekday_shift('(y - 1)')} = 3)"
_DAYS = (
    "CASE WHEN mo = 2 THEN CASE WHEN y % 4 = 0 AND (y % 100 <> 0 OR y % 400 = 0) THEN 29 ELSE 28 END "
    "WHEN mo IN (4, 6, 9, 11) THEN 30 ELSE 31 END"
)
_ISO_OK = f"""(matched AND y >= 1 AND h <= 23 AND mi <= 59 AND s <= 59 AND zone < 86400 AND
  CASE WHEN week_text IS NOT NULL
    THEN w >= 1 AND (w <= 52 OR (w = 53 AND {_LONG_YEAR})) AND wd BETWEEN 1 AND 7
      AND NOT (y = 9999 AND w = 52 AND wd >= 6)
    ELSE mo BETWEEN 1 AND 12 AND d >= 1 AND d <= {_DAYS} END)"""
_DATE = (
    "CASE WHEN week_text IS NOT NULL THEN make_date(y, 1, 4) - (isodow(make_date(y, 1, 4)) - 1)::INTEGER "
    "+ ((w - 1) * 7 + wd - 1)::INTEGER ELSE make_date(y, mo, d) END"
)
_INSTANT = (
    f"CASE WHEN iso_ok THEN cast({_DATE} AS timestamp) + to_seconds(h * 3600 + mi * 60 + s - zone_sign * zone)"
    " + to_microseconds(micros) END"
)
_BLANK = r"'[\s\x0b\x1c-\x1f\x{85}\p{Z}]*'"
_NUMERIC = "('UBIGINT', 'BIGINT', 'HUGEINT', 'UHUGEINT', 'DOUBLE')"


def _checks() -> list[tuple[str, str]]:
    found = [(f"t_{f} = 'NULL'", f"'NULL value is not allowed: {f}'") for f in REQUIRED_FIELDS]
    for f in ("order_id", "customer_id", "product_id"):
        found.append((f"t_{f} <> 'VARCHAR'", f"'{f} must be a string'"))
        found.append((f"t_{f} = 'VARCHAR' AND regexp_full_match(v_{f}, {_BLANK})", f"'{f} cannot be empty'"))
    whole = f"(t_quantity IN {_NUMERIC} AND regexp_full_match(v_quantity, '-?[0-9]+'))"
    found.append((f"NOT {whole}", "'quantity must be an integer'"))
    found.append((f"{whole} AND try_cast(v_quantity AS double) <= 0", "'quantity must be greater than 0'"))
    for f in ("price", "tax_amount"):
        found.append((f"t_{f} NOT IN {_NUMERIC}", f"'{f} must be a number'"))
        found.append((f"t_{f} IN {_NUMERIC} AND try_cast(v_{f} AS double) < 0", f"'{f} cannot be negative'"))
    allowed = ", ".join(f"'{m}'" for m in ALLOWED_PAYMENT_METHODS)
    shown = (
        "CASE t_payment_method WHEN 'NULL' THEN 'None' WHEN 'BOOLEAN' THEN "
        "CASE v_payment_method WHEN 'true' THEN 'True' ELSE 'False' END ELSE v_payment_method END"
    )
    bad = f"NOT (t_payment_method = 'VARCHAR' AND v_payment_method IN ({allowed}))"
    found.append((bad, f"'Invalid payment_method: ' || {shown}"))
    found.append(("t_timestamp <> 'VARCHAR'", "'timestamp must be a string'"))
    found.append(("t_timestamp = 'VARCHAR' AND NOT iso_ok", "'timestamp must be a valid ISO 8601 datetime'"))
    return found


def checked(source: str) -> str:
    """CTEs that validate ``source(value)``, ending in ``checked`` with errors, is_valid and typed fields."""
    kinds = ", ".join(f"json_type(j, '$.{f}') AS t_{f}, json_extract_string(j, '$.{f}') AS v_{f}" for f in REQUIRED_FIELDS)
    missing = ", ".join(f"CASE WHEN t_{f} IS NULL THEN 'Missing required field: {f}' END" for f in REQUIRED_FIELDS)
    others = ", ".join(f"CASE WHEN {condition} THEN {message} END" for condition, message in _checks())
    keep = "lambda x: x IS NOT NULL"
    return f"""parsed AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS j FROM {source}),
fields AS (SELECT *, {kinds} FROM parsed),
shaped AS (SELECT *, coalesce(regexp_matches(v_timestamp, '{_ISO}'), false) AS matched,
  regexp_extract(coalesce(v_timestamp, ''), '{_ISO}', {texts(_GROUPS)}) AS iso FROM fields),
parts AS (SELECT *, {_PARTS} FROM shaped),
timed AS (SELECT *, coalesce({_ISO_OK}, false) AS iso_ok FROM parts),
listed AS (SELECT *, list_filter([{missing}], {keep}) AS missing, list_filter([{others}], {keep}) AS others FROM timed),
checked AS (SELECT *, CASE WHEN j IS NULL THEN ['Malformed record'] WHEN len(missing) > 0 THEN missing
  ELSE others END AS error_list, CASE WHEN t_timestamp = 'VARCHAR' THEN {_INSTANT} END AS event_time FROM listed),
verdicts AS (SELECT *, array_to_string(error_list, '|') AS errors, len(error_list) = 0 AS is_valid FROM checked)"""


DIRTY = f"{dirty()},\n{checked('dirty')}"
CHECKED_EDGE = f"{EDGE},\n{checked('edge')}"


def _exact(field: str, precision: int) -> str:
    typed = f"try_cast(v_{field} AS decimal({precision},2))"
    return f"CASE WHEN {typed} = try_cast(v_{field} AS decimal(38,6)) THEN {typed} END"


_TYPED = f"""v_order_id AS order_id, v_customer_id AS customer_id, v_product_id AS product_id,
  try_cast(v_quantity AS decimal(38,0)) AS quantity, {_exact("price", 12)} AS price,
  {_exact("tax_amount", 14)} AS tax_amount, v_payment_method AS payment_method,
  strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp\""""
_UNFIT = f"""array_to_string(list_filter([CASE WHEN {_exact("price", 12)} IS NULL THEN 'price' END,
  CASE WHEN {_exact("tax_amount", 14)} IS NULL THEN 'tax_amount' END], lambda x: x IS NOT NULL), '|') AS unfit"""

RULE = """CASE WHEN starts_with(error, 'Invalid payment_method: ') THEN 'Invalid payment_method' ELSE error END"""

# --- synthesis --------------------------------------------------------------


def synth(rate: float) -> str:
    key = "order_id"
    due = f"make_timestamp(cast({EPOCH_MICROS} + floor(cast(order_id - 10000 AS double) * 1e6 / {rate:.1f}) AS bigint))"
    return f"""ids AS (SELECT event_id + 10001 AS order_id FROM events),
base AS (SELECT order_id, cast({integer("quantity", 1, 5, key)} AS integer) AS quantity,
  {money("price", PRICE_CENTS, key=key)} AS price FROM ids),
synth AS (SELECT order_id, 'C' || cast({integer("customer", 101, 999, key)} AS varchar) AS customer_id,
  {choice("product", SYNTH_PRODUCTS, key)} AS product_id, quantity, price, {tax("price", "quantity")} AS tax_amount,
  {choice("payment", SYNTH_PAYMENT_METHODS, key)} AS payment_method,
  strftime({due}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp" FROM base)"""


SYNTH = synth(1000)
_SYNTH_ALL = f'WITH {SYNTH} SELECT order_id, customer_id, product_id, quantity, price, tax_amount, payment_method, "timestamp" FROM synth'
_INJECTED = "SELECT event_id, value, anomaly_category, anomaly_detail FROM dirty"

_HOURLY = "hourly AS (SELECT date_trunc('hour', ts) AS window_start, count(*) AS n FROM events GROUP BY 1)"
_METRICS = f"""{DIRTY},
metrics AS (SELECT event_type, date_trunc('day', ingest_ts) AS window_start, count(*) AS n,
  count(*) FILTER (WHERE is_valid) AS n_valid FROM verdicts GROUP BY 1, 2),
rated AS (SELECT *, n_valid * 100.0::double / n AS quality_pct FROM metrics)"""
_ALERTS = f"""{_METRICS},
changed AS (SELECT a.*, (a.n - b.n) * 100.0::double / nullif(b.n, 0) AS change_pct FROM rated a
  LEFT JOIN rated b ON a.event_type = b.event_type AND b.window_start = a.window_start - INTERVAL 1 DAY
  UNION ALL SELECT b.event_type, b.window_start + INTERVAL 1 DAY, 0, NULL, NULL, -100.0 FROM rated b
  WHERE b.window_start < (SELECT max(r.window_start) FROM rated r) AND NOT EXISTS (SELECT 1 FROM rated a
    WHERE a.event_type = b.event_type AND a.window_start = b.window_start + INTERVAL 1 DAY)),
alerts AS (SELECT event_type, window_start,
  CASE WHEN n = 0 OR quality_pct < 95 OR coalesce(change_pct < -20, false) THEN 'warning'
    WHEN quality_pct = 100 THEN 'success' ELSE 'info' END AS severity,
  CASE WHEN n = 0 THEN 'No records received' WHEN quality_pct < 95 THEN 'Data quality below 95%'
    WHEN coalesce(change_pct < -20, false) THEN 'Throughput dropped by more than 20%'
    WHEN quality_pct = 100 THEN 'All records valid' ELSE 'Processing normally' END AS message FROM changed)"""

_STAGES = """shipped AS (SELECT l_orderkey, min(l_shipdate)::timestamp AS t_first, max(l_shipdate)::timestamp AS t_last
  FROM lineitem GROUP BY 1),
times AS (SELECT epoch_ms(o_orderdate::timestamp) AS placed, epoch_ms(t_first) AS t_first, epoch_ms(t_last) AS t_last
  FROM orders JOIN shipped ON o_orderkey = l_orderkey),
spans AS (SELECT 'first' AS stage, t_first - placed AS ms FROM times UNION ALL SELECT 'last', t_last - t_first FROM times
  UNION ALL SELECT 'total', t_last - placed FROM times)"""


def _json_kind(value: str) -> str:
    return (
        f"CASE json_type({value}) WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' "
        f"WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' "
        f"ELSE CASE WHEN regexp_full_match({value} ->> '$', '-?[0-9]+') THEN 'integer' ELSE 'float' END END"
    )


def _observed(source: str, columns: str = "") -> str:
    return f"""whole AS (SELECT * FROM {source} WHERE json_valid(value)),
named AS (SELECT *, unnest(json_keys(value)) AS field FROM whole),
observed AS (SELECT {columns} field, {_json_kind("json_extract(value, '$.' || field)")} AS type FROM named)"""


_REQUIRED = ", ".join(f"('{f}')" for f in REQUIRED_FIELDS)
_OFFSETS = """log AS (SELECT cast(event_id % 3 AS integer) AS partition_id, event_id // 3 AS "offset", ts FROM events),
ends AS (SELECT partition_id, max("offset") AS produced FROM log GROUP BY 1),
seen AS (SELECT partition_id, max("offset") AS consumed FROM log
  WHERE ts <= TIMESTAMP '2024-01-28 12:00:00' AND partition_id <> 2 GROUP BY 1)"""
_STREAM = f"""{DIRTY},
stream AS (SELECT *, CASE WHEN event_time <= ingest_ts + INTERVAL 1 HOUR THEN event_time END AS t FROM verdicts)"""
_EDGE_STREAM = f"""{CHECKED_EDGE},
placed AS (SELECT v.*, c.ingest_ts, CASE WHEN v.event_time IS NULL THEN 'untimed'
    WHEN v.event_time > c.ingest_ts + INTERVAL 1 HOUR THEN 'future'
    WHEN v.event_time < c.ingest_ts - INTERVAL 3 DAY THEN 'late' ELSE 'timed' END AS time_status
  FROM verdicts v JOIN clean c USING (event_id))"""
_FIRST = "row_number() OVER (PARTITION BY order_id ORDER BY ingest_ts, event_id) > 1"
_IDS = f"""{dirty()},
ids AS (SELECT event_id, ingest_ts, CASE WHEN json_type(value, '$.order_id') = 'VARCHAR'
  THEN json_extract_string(value, '$.order_id') END AS order_id FROM dirty)"""
_REPEATED = (
    f"WITH {_IDS} SELECT event_id, order_id FROM ids WHERE order_id IS NOT NULL QUALIFY {_FIRST}"
)
_PRODUCTS = f"""{dirty()},
products AS (SELECT event_id, CASE WHEN json_type(value, '$.product_id') = 'VARCHAR'
  THEN json_extract_string(value, '$.product_id') END AS product_id FROM dirty)"""

_ORDERS = f"""base AS (SELECT o_orderkey, o_orderkey * 4 + 3 AS order_id, 'C' || cast(o_custkey AS varchar) AS customer_id,
  'P' || cast(501 + o_orderkey % 10 AS varchar) AS product_id, cast(1 + o_orderkey % 5 AS integer) AS quantity,
  cast(o_totalprice AS decimal(12,2)) AS price, {tax("o_totalprice", "1 + o_orderkey % 5")} AS tax_amount,
  'Cash' AS payment_method, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
  row_number() OVER (ORDER BY o_orderkey) - 1 AS slot FROM orders),
picked AS (SELECT *, {draw("pick", "o_orderkey")} < {int(0.05 * 2**32)} AS picked,
  CASE WHEN slot > 0 THEN {place("slot", "o_orderkey")} % slot END AS target FROM base),
found AS (SELECT p.*, coalesce(b.order_id, p.order_id - 1) AS reused FROM picked p LEFT JOIN base b ON p.target = b.slot),
detailed AS (SELECT * REPLACE (CASE WHEN picked THEN reused ELSE order_id END AS order_id),
  CASE WHEN picked THEN 'duplicate-id' END AS anomaly_category,
  CASE WHEN picked THEN 'duplicate_order_id_' || cast(reused AS varchar) END AS anomaly_detail FROM found)"""

ORACLE: dict[str, str] = {
    "synth_finite": _SYNTH_ALL,
    "synth_stream": _SYNTH_ALL,
    "synth_batches": f"""WITH {SYNTH} SELECT (order_id - 10001) // 300 AS batch_id, count(*) AS n,
      min(order_id) AS first_id, sum(tax_amount) AS tax FROM synth GROUP BY 1""",
    "synth_paced": f'WITH {synth(250)} SELECT order_id, "timestamp" FROM synth',
    "derive_tax": f"""SELECT l_returnflag, l_linestatus,
      sum({tax("l_extendedprice", "l_quantity")})::decimal(30,2) AS tax, count(*) AS n FROM lineitem GROUP BY 1, 2""",
    "emit_json": f"WITH {CLEAN} SELECT event_id, {_json([_member(f) for f in REQUIRED_FIELDS])} AS value FROM clean",
    "ingest_json_array": f"""WITH {DIRTY} SELECT event_id // 500 AS array_id, count(*) AS n,
      count(*) FILTER (WHERE is_valid) AS n_valid FROM verdicts GROUP BY 1""",
    "validate": f"WITH {CHECKED_EDGE} SELECT event_id, is_valid, errors FROM verdicts",
    "typed_records": f"""WITH {CHECKED_EDGE} SELECT event_id, {_TYPED}, {_UNFIT} FROM verdicts WHERE is_valid""",
    **{
        name: f"""WITH {CHECKED_EDGE}, exploded AS (SELECT event_id, unnest(error_list) AS error FROM checked)
          SELECT event_id, error FROM exploded WHERE regexp_matches(error, '{pattern}')"""
        for name, pattern in RULE_FAMILIES.items()
    },
    **{name: f"WITH {dirty(*arguments)} {_INJECTED}" for name, arguments in INJECTIONS.items()},
    "inject_exact": f"WITH {dirty(count=123)} {_INJECTED}",
    "inject_duplicate_sparse": f"""WITH {_ORDERS}
      SELECT o_orderkey, {_record(numeric_id=True)} AS value, anomaly_category, anomaly_detail FROM detailed""",
    "anomaly_breakdown": f"""WITH {dirty()} SELECT anomaly_category, count(*) AS n FROM dirty
      WHERE anomaly_category IS NOT NULL GROUP BY 1""",
    "anomaly_rate": f"""WITH {dirty()} SELECT count(*) AS total_transactions,
      count(anomaly_category) AS anomalous_transactions,
      count(anomaly_category) / count(*) * 100.0::double AS achieved_rate_pct FROM dirty""",
    "throughput": """SELECT count(*) AS n, epoch_us(max(ts)) - epoch_us(min(ts)) AS elapsed_micros,
      count(*) * 1e6 / (epoch_us(max(ts)) - epoch_us(min(ts))) AS rows_per_second FROM events""",
    "batch_counts": """SELECT count(DISTINCT event_id // 300) AS batches, count(*) AS n,
      count(*) // 5000 AS progress_marks FROM events""",
    "dq_duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) - 1 AS surplus,
      strftime(min(l_shipdate), '%Y-%m-%d') AS first_l_shipdate FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_duplicate_rows": _REPEATED,
    "dq_duplicate_integer_ids": f"""WITH {_ORDERS} SELECT o_orderkey, order_id FROM detailed
      QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY o_orderkey) > 1""",
    "dq_product_domain": f"""WITH {_PRODUCTS} SELECT event_id, product_id, 'Invalid product_id: ' || product_id AS error
      FROM products WHERE NOT list_contains({texts(SYNTH_PRODUCTS)}, product_id)""",
    "dq_product_catalogue": f"""WITH {_PRODUCTS},
      catalogue AS (SELECT DISTINCT 'P' || cast(501 + p_partkey % 9 AS varchar) AS product_id FROM part)
      SELECT event_id, product_id, 'Invalid product_id: ' || product_id AS error
      FROM products ANTI JOIN catalogue USING (product_id) WHERE product_id IS NOT NULL""",
    "dq_unexpected_fields": f"""WITH {dirty()}, named AS (SELECT event_id,
      list_filter(json_keys(value), lambda x: NOT list_contains({texts(REQUIRED_FIELDS)}, x)) AS fields FROM dirty)
      SELECT event_id, array_to_string(fields, '|') AS fields FROM named WHERE len(fields) > 0""",
    "schema_drift": f"""WITH {EDGE}, {_observed("edge")} SELECT field, type, count(*) AS n FROM observed GROUP BY 1, 2""",
    "null_profile": f"""WITH {dirty()}, required(field) AS (VALUES {_REQUIRED}),
      kinds AS (SELECT field, json_type(value, '$.' || field) AS t FROM dirty, required)
      SELECT field, count(*) FILTER (WHERE t IS NULL) AS n_missing, count(*) FILTER (WHERE t = 'NULL') AS n_null,
        count(*) AS n_records, count(*) FILTER (WHERE t IS NULL) * 100.0::double / count(*) AS missing_pct,
        count(*) FILTER (WHERE t = 'NULL') * 100.0::double / count(*) AS null_pct FROM kinds GROUP BY 1""",
    "errors_by_rule": f"""WITH {DIRTY}, exploded AS (SELECT unnest(error_list) AS error FROM checked)
      SELECT {RULE} AS rule, count(*) AS n FROM exploded GROUP BY 1""",
    "detection_matrix": f"""WITH {DIRTY},
      flags AS (SELECT coalesce(anomaly_category, 'clean') AS anomaly_category, NOT is_valid AS by_rules,
        len(list_filter(json_keys(value), lambda x: NOT list_contains({texts(REQUIRED_FIELDS)}, x))) > 0 AS by_fields,
        coalesce(t_product_id = 'VARCHAR' AND NOT list_contains({texts(SYNTH_PRODUCTS)}, v_product_id), false) AS by_domain,
        row_number() OVER (PARTITION BY v_order_id ORDER BY ingest_ts, event_id) > 1 AS by_duplicates FROM verdicts)
      SELECT anomaly_category, count(*) AS n, count(*) FILTER (WHERE by_rules) AS by_rules,
        count(*) FILTER (WHERE by_fields) AS by_fields, count(*) FILTER (WHERE by_domain) AS by_domain,
        count(*) FILTER (WHERE by_duplicates) AS by_duplicates,
        count(*) FILTER (WHERE by_rules OR by_fields OR by_domain OR by_duplicates) AS detected,
        count(*) FILTER (WHERE by_rules OR by_fields OR by_domain OR by_duplicates) * 100.0::double / count(*)
          AS detected_pct FROM flags GROUP BY 1""",
    "events_per_window": f"""SELECT event_type, strftime(date_trunc('hour', ts), {TIME}) AS window_start, count(*) AS n,
      count(*) / 3600.0::double AS per_second FROM events GROUP BY 1, 2""",
    "events_per_sliding_window": f"""WITH starts AS (SELECT ts, unnest([0, 1, 2, 3]) AS back FROM events)
      SELECT strftime(make_timestamp(((epoch_us(ts) // 21600000000) - back) * 21600000000), {TIME}) AS window_start,
        count(*) AS n, count(*) / 86400.0::double AS per_second FROM starts GROUP BY 1""",
    "quality_pct": f"""WITH {DIRTY} SELECT count(*) AS n, count(*) FILTER (WHERE is_valid) AS n_valid,
      count(*) FILTER (WHERE is_valid) * 100.0::double / count(*) AS quality_pct FROM verdicts""",
    "quality_per_window": f"""WITH {_METRICS} SELECT event_type, strftime(window_start, {TIME}) AS window_start, n,
      n_valid, quality_pct FROM rated""",
    "running_total": f"""WITH {_HOURLY} SELECT strftime(window_start, {TIME}) AS window_start, n,
      cast(sum(n) OVER (ORDER BY window_start) AS bigint) AS total FROM hourly""",
    "hourly_change": f"""WITH {_HOURLY} SELECT strftime(a.window_start, {TIME}) AS window_start, a.n, b.n AS previous_n,
      (a.n - b.n) * 100.0::double / nullif(b.n, 0) AS change_pct
      FROM hourly a LEFT JOIN hourly b ON b.window_start = a.window_start - INTERVAL 1 HOUR""",
    "stage_latency": f"""WITH {_STAGES} SELECT stage, count(ms) AS n, sum(ms)::bigint / count(ms) AS avg_ms,
      max(ms) AS max_ms, quantile_disc(ms, 0.5) AS p50_ms, quantile_disc(ms, 0.95) AS p95_ms FROM spans GROUP BY 1""",
    "flow_status": f"""WITH {_METRICS} SELECT event_type, strftime(window_start, {TIME}) AS window_start, n, n_valid,
      quality_pct, CASE WHEN quality_pct >= 95 AND rated.window_start = (SELECT max(r.window_start) FROM rated r)
        THEN 'Running' ELSE 'Monitoring' END AS status FROM rated
      QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY rated.window_start DESC) = 1""",
    "alerts": f"""WITH {_ALERTS} SELECT event_type, strftime(window_start, {TIME}) AS window_start, severity, message
      FROM alerts""",
    "recent_alerts": f"""WITH {_ALERTS} SELECT event_type, strftime(window_start, {TIME}) AS window_start, severity,
      message FROM alerts ORDER BY alerts.window_start DESC, event_type LIMIT 7""",
    "consumer_lag": f"""WITH {_OFFSETS}, lagging AS (SELECT partition_id, produced, consumed,
        produced - coalesce(consumed, -1) AS lag FROM ends LEFT JOIN seen USING (partition_id))
      SELECT *, CASE WHEN lag > 500 THEN 'warning' ELSE 'success' END AS severity,
        CASE WHEN lag > 500 THEN 'Consumer lag detected' ELSE 'Consumer is up to date' END AS message FROM lagging""",
    "system_health": f"""WITH {_ALERTS}, latest AS (SELECT event_type, arg_max(severity, window_start) AS severity
        FROM alerts GROUP BY 1)
      SELECT bool_and(severity <> 'warning') AS operational, count(*) AS flows,
        count(*) FILTER (WHERE severity = 'warning') AS flows_with_warning,
        CASE WHEN bool_or(severity = 'warning') THEN 'warning' WHEN bool_or(severity = 'info') THEN 'info'
          ELSE 'success' END AS worst_severity FROM latest""",
    "stream_ingest": f"WITH {CHECKED_EDGE} SELECT value, is_valid, errors FROM verdicts",
    "lake_append": f"WITH {DIRTY} SELECT event_id, {_TYPED} FROM verdicts WHERE is_valid",
    "quarantine": f"WITH {DIRTY} SELECT event_id, value, errors FROM verdicts WHERE NOT is_valid",
    "stream_quality": f"""WITH {_STREAM} SELECT strftime(date_trunc('hour', t), {TIME}) AS window_start, count(*) AS n,
      count(*) FILTER (WHERE is_valid) AS n_valid,
      count(*) FILTER (WHERE is_valid) * 100.0::double / count(*) AS quality_pct FROM stream WHERE t IS NOT NULL
      GROUP BY date_trunc('hour', t)""",
    "stream_edge_quality": f"""WITH {_EDGE_STREAM} SELECT strftime(date_trunc('hour', event_time), {TIME}) AS window_start,
      count(*) AS n, count(*) FILTER (WHERE is_valid) AS n_valid,
      count(*) FILTER (WHERE is_valid) * 100.0::double / count(*) AS quality_pct FROM placed
      WHERE time_status = 'timed' GROUP BY date_trunc('hour', event_time)""",
    "stream_off_time": f"""WITH {_EDGE_STREAM} SELECT strftime(date_trunc('day', ingest_ts), {TIME}) AS window_start,
      time_status, count(*) AS n, count(*) FILTER (WHERE is_valid) AS n_valid FROM placed
      WHERE time_status <> 'timed' GROUP BY date_trunc('day', ingest_ts), time_status""",
    "stream_nulls": f"""WITH {dirty()}, required(field) AS (VALUES {_REQUIRED}),
      kinds AS (SELECT date_trunc('day', ingest_ts) AS day, field, json_type(value, '$.' || field) AS t FROM dirty, required)
      SELECT strftime(day, {TIME}) AS window_start, field, count(*) FILTER (WHERE t IS NULL) AS n_missing,
        count(*) FILTER (WHERE t = 'NULL') AS n_null, count(*) AS n_records,
        count(*) FILTER (WHERE t IS NULL) * 100.0::double / count(*) AS missing_pct,
        count(*) FILTER (WHERE t = 'NULL') * 100.0::double / count(*) AS null_pct FROM kinds GROUP BY day, field""",
    "stream_total": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "stream_errors": f"""WITH {_STREAM}, exploded AS (SELECT date_trunc('day', t) AS day, unnest(error_list) AS error
        FROM stream)
      SELECT strftime(day, {TIME}) AS window_start, {RULE} AS rule, count(*) AS n FROM exploded
      WHERE day IS NOT NULL GROUP BY 1, 2""",
    "stream_drift": f"""WITH {dirty()}, {_observed("dirty", "date_trunc('day', ingest_ts) AS day,")}
      SELECT strftime(day, {TIME}) AS window_start, field, type, count(*) AS n FROM observed GROUP BY 1, 2, 3""",
    "stream_duplicate_rows": _REPEATED,
    "stream_duplicate_keys": f"""WITH {_IDS}, daily AS (SELECT date_trunc('day', ingest_ts) AS day, order_id, count(*) AS n
        FROM ids WHERE order_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)
      SELECT strftime(day, {TIME}) AS window_start, order_id, n FROM daily""",
    "stream_distinct_ids": f"WITH {_IDS} SELECT DISTINCT order_id FROM ids",
}

from .live_oracle import LIVE  # noqa: E402 - builds on the parts above

ORACLE.update(LIVE)
