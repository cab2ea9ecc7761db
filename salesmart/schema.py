"""Declared schemas and fixed data values of the star schema."""

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 4)
MONEY_SUM = T.DecimalType(29, 4)
FRACTION = T.DecimalType(5, 4)
PERCENT = T.DecimalType(5, 2)
VARIATION = T.DecimalType(8, 2)

# The four kinds of ledger entry.
TX_ORIGINAL = "Venta Original"
TX_REVERSAL = "Reverso por Actualización"
TX_NEW_VERSION = "Nueva Versión"
TX_DELETION = "Reverso por Borrado"

UNKNOWN_SK = -1


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], len(f) < 3) for f in fields])


_L, _I, _S, _B, _TS = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.BooleanType(),
    T.TimestampType(),
)

# --- source side --------------------------------------------------------------------------

SOURCES: dict[str, T.StructType] = {
    "categories": _struct(("category_id", _S), ("category_name", _S), ("description", _S)),
    "suppliers": _struct(("supplier_id", _L), ("company_name", _S), ("country", _S)),
    "products": _struct(
        ("product_id", _L),
        ("product_name", _S),
        ("category_id", _S),
        ("supplier_id", _L),
        ("quantity_per_unit", _S),
        ("unit_price", MONEY),
        ("discontinued", _B),
        ("row_version", _L),
    ),
    "customers": _struct(
        ("customer_id", _S),
        ("company_name", _S),
        ("contact_name", _S),
        ("contact_title", _S),
        ("city", _S),
        ("region", _S),
        ("country", _S),
        ("postal_code", _S),
        ("row_version", _L),
    ),
    "employees": _struct(
        ("employee_id", _L),
        ("first_name", _S),
        ("last_name", _S),
        ("title", _S),
        ("hire_date", _TS),
        ("city", _S),
        ("country", _S),
        ("reports_to", _L),
        ("row_version", _L),
    ),
    "shippers": _struct(
        ("shipper_id", _L), ("company_name", _S), ("phone", _S), ("row_version", _L)
    ),
    "orders": _struct(
        ("order_id", _L),
        ("customer_id", _S),
        ("employee_id", _L),
        ("order_date", _TS),
        ("ship_via", _L),
        ("freight", MONEY),
        ("row_version", _L),
    ),
    "order_details": _struct(
        ("order_id", _L),
        ("product_id", _L),
        ("line_no", _L),
        ("unit_price", MONEY),
        ("quantity", _I),
        ("discount", FRACTION),
        ("row_version", _L),
    ),
}

# The six sources whose changes are tracked by a high-water mark.
TRACKED = ("products", "customers", "employees", "shippers", "orders", "order_details")

# --- star side ----------------------------------------------------------------------------

_SCD = (
    ("version", _I, True),
    ("valid_from", _TS, True),
    ("valid_to", _TS),
    ("is_current", _B, True),
    ("source_version", _L),
)

DIM_KEYS: dict[str, tuple[str, str]] = {
    "dim_product": ("product_sk", "product_id"),
    "dim_customer": ("customer_sk", "customer_id"),
    "dim_employee": ("employee_sk", "employee_id"),
    "dim_shipper": ("shipper_sk", "shipper_id"),
}

DIM_SOURCE: dict[str, str] = {
    "dim_product": "products",
    "dim_customer": "customers",
    "dim_employee": "employees",
    "dim_shipper": "shippers",
}

#: Natural keys are text or numbers.
KEY_TYPES: dict[str, T.DataType] = {
    key: SOURCES[DIM_SOURCE[dim]][key].dataType for dim, (_, key) in DIM_KEYS.items()
}

DIM_ATTRS: dict[str, tuple[tuple[str, T.DataType], ...]] = {
    "dim_product": (
        ("product_name", _S),
        ("category_name", _S),
        ("category_desc", _S),
        ("supplier_name", _S),
        ("supplier_country", _S),
        ("quantity_per_unit", _S),
        ("unit_price", MONEY),
        ("discontinued", _B),
    ),
    "dim_customer": (
        ("company_name", _S),
        ("contact_name", _S),
        ("contact_title", _S),
        ("city", _S),
        ("region", _S),
        ("country", _S),
        ("postal_code", _S),
    ),
    "dim_employee": (
        ("full_name", _S),
        ("title", _S),
        ("hire_date", _TS),
        ("city", _S),
        ("country", _S),
        ("supervisor_name", _S),
    ),
    "dim_shipper": (("company_name", _S), ("phone", _S)),
}

DIMS: dict[str, T.StructType] = {
    name: _struct((sk, _L, True), (key, KEY_TYPES[key]), *DIM_ATTRS[name], *_SCD)
    for name, (sk, key) in DIM_KEYS.items()
}

DIM_DATE = _struct(
    ("date_sk", _I, True),
    ("date", T.DateType(), True),
    ("year", _I, True),
    ("quarter", _I, True),
    ("month", _I, True),
    ("month_name", _S, True),
    ("day", _I, True),
    ("weekday", _I, True),
    ("weekday_name", _S, True),
    ("week", _I, True),
)

FACT = _struct(
    ("fact_id", _L, True),
    ("product_sk", _L, True),
    ("customer_sk", _L, True),
    ("employee_sk", _L, True),
    ("date_sk", _I, True),
    ("shipper_sk", _L, True),
    ("order_id", _L, True),
    ("product_id", _L),
    ("line_no", _L),
    ("unit_price", MONEY, True),
    ("quantity", _I, True),
    ("discount", FRACTION, True),
    ("sale_amount", MONEY, True),
    ("freight_alloc", MONEY, True),
    ("tx_type", _S, True),
)

# What one ledger balance is grouped by, and the measures it nets.
POSITION_KEYS = (
    "order_id",
    "product_id",
    "line_no",
    "product_sk",
    "customer_sk",
    "employee_sk",
    "date_sk",
    "shipper_sk",
    "unit_price",
    "discount",
)
MEASURES = ("quantity", "sale_amount", "freight_alloc")

POSITION = _struct(
    ("order_id", _L),
    ("product_id", _L),
    ("line_no", _L),
    ("product_sk", _L),
    ("customer_sk", _L),
    ("employee_sk", _L),
    ("date_sk", _I),
    ("shipper_sk", _L),
    ("unit_price", MONEY),
    ("discount", FRACTION),
    ("quantity", _L),
    ("sale_amount", MONEY_SUM),
    ("freight_alloc", MONEY_SUM),
)

# The digest of a set of order lines: how many, sum and exclusive or of their hashes. Rows of
# several batches add up.
DIGEST = _struct(
    ("order_id", _L), ("n", _L), ("s", T.DecimalType(38, 0)), ("x", _L)
)

# What is known of each bucket of orders: the digest of its lines, ledger rows that are not in its
# rolled-up balances yet, and balances that are.
BUCKET = _struct(
    ("bucket", _I),
    ("n", _L),
    ("s", T.DecimalType(38, 0)),
    ("x", _L),
    ("pending", _L),
    ("rolled", _L),
)

# Orders with lines that wait for a member or a day.
QUARANTINE = _struct(("order_id", _L))

# What notices have brought in since the last sweep: the version seen of a member or an order.
NOTICED = _struct(("source_table", _S), ("key", _S), ("row_version", _L))

LOAD_CONTROL = _struct(("source_table", _S, True), ("last_row_version", _L, True), ("updated_at", _TS))

ETL_LOG = _struct(
    ("log_id", _L, True),
    ("run_at", _TS, True),
    ("step", _S, True),
    ("rows_affected", _L),
    ("status", _S, True),
    ("message", _S),
    ("duration_s", _L),
    ("attempt", _S),
)


class SchemaMismatch(ValueError):
    """A DataFrame does not have the declared columns or types."""


def conform(df, schema: T.StructType):
    """Select the declared columns in order, or say what is missing or of another type."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: want {f.dataType.simpleString()}, "
        f"have {actual[f.name].simpleString() if f.name in actual else 'nothing'}"
        for f in schema.fields
        if actual.get(f.name) != f.dataType
    ]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return df.select(*schema.fieldNames())
