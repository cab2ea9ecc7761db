"""Hand-made source tables."""

from datetime import datetime
from decimal import Decimal

from salesmart.schema import SOURCES
from salesmart.session import scratch_path
from salesmart.sources.tables import Sources, read_parquet, write_parquet

DEFAULTS = {
    "categories": [("C1", "Drinks", "Cold and hot")],
    "suppliers": [(1, "Acme", "USA")],
    "products": [(1, "Tea", "C1", 1, "10 bags", "5", False, 1)],
    "customers": [(1, "Ann Ltd", None, None, None, None, "USA", None, 1)],
    "employees": [(1, "Eve", "Moss", "Boss", None, None, "USA", None, 1)],
    "shippers": [(1, "Fast", None, 1)],
    "orders": [(1, 1, 1, datetime(1996, 7, 4), 1, "10", 1)],
    "order_details": [(1, 1, "5", 2, "0", 1)],
}


def _typed(value, kind):
    """Money may be given as text, text keys as numbers."""
    if value is None:
        return None
    return Decimal(value) if kind == "decimal" else str(value) if kind == "string" else value


def _numbered(name):
    """Lines may leave out their number: they are the only one of their product."""
    width = len(SOURCES[name].fields)
    return lambda row: row if len(row) == width else (*row[:2], 1, *row[2:])


def sources(spark, **tables) -> Sources:
    """Tables as lists of tuples, money as text; what is not given is the default."""
    frames = {}
    for name, schema in SOURCES.items():
        rows = [
            tuple(_typed(v, f.dataType.typeName()) for v, f in zip(row, schema.fields))
            for row in map(_numbered(name), tables.get(name, DEFAULTS[name]))
        ]
        frames[name] = spark.createDataFrame(rows, schema)
    return Sources(**frames).checked()


def stored(spark, source: Sources) -> Sources:
    """The same tables read back from Parquet."""
    path = scratch_path(spark, "source")
    write_parquet(source, path)
    return read_parquet(spark, path)
