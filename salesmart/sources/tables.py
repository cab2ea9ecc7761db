"""The eight order-entry tables, from Parquet or from a live database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from salesmart.schema import KEY_TYPES, SOURCES, TRACKED, conform
from salesmart.session import bucketed, in_parallel, stage_bucketed


@dataclass(frozen=True)
class Sources:
    categories: DataFrame
    suppliers: DataFrame
    products: DataFrame
    customers: DataFrame
    employees: DataFrame
    shippers: DataFrame
    orders: DataFrame
    order_details: DataFrame

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def with_tables(self, **tables: DataFrame) -> Sources:
        return replace(self, **tables)

    def checked(self) -> Sources:
        """The same tables, after comparing every one with its declared schema."""
        return Sources(**{f.name: conform(self[f.name], SOURCES[f.name]) for f in fields(self)})


#: The tables that are laid out in buckets of orders, where that is asked for.
BY_ORDER = ("orders", "order_details")


#: The eight bytes of a binary row version, kept beside the number they say.
VERSION_BYTES = "row_version_bytes"


def version_number(version: Column) -> Column:
    """The number that a row version of eight bytes says, the first byte being the highest. It
    has the order of the bytes; versions from 2 ** 63 on are refused."""
    return F.conv(F.hex(version), 16, 10).cast("decimal(20,0)").cast("long")


def version_bytes(number: int) -> bytes:
    return number.to_bytes(8, "big")


def decoded(raw: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns of a table as a database gives it: numbers for binary row versions
    (whose bytes stay, for filters that a scan can use), text keys without padding."""
    columns = []
    for f in schema.fields:
        given = raw.schema[f.name].dataType
        column = F.col(f.name)
        if f.name == "row_version" and isinstance(given, BinaryType):
            columns.append(column.alias(VERSION_BYTES))
            column = version_number(column)
        elif f.name in KEY_TYPES and isinstance(f.dataType, StringType):
            column = F.rtrim(column.cast("string"))
        columns.append(column.cast(f.dataType).alias(f.name))
    return raw.select(*columns)


def above(df: DataFrame, low: int, high: int | None = None) -> DataFrame:
    """Rows with low < row version <= high; binary versions are compared as they are stored, so
    that Parquet skips row groups by them too."""
    rows = df
    if VERSION_BYTES in df.columns:
        rows = rows.filter(F.col(VERSION_BYTES) > F.lit(version_bytes(low)))
        if high is not None:
            rows = rows.filter(F.col(VERSION_BYTES) <= F.lit(version_bytes(high)))
        return rows
    rows = rows.filter(F.col("row_version") > F.lit(low))
    return rows if high is None else rows.filter(F.col("row_version") <= F.lit(high))


def read_parquet(
    spark: SparkSession, root: str, buckets: int | None = None, as_stored: bool = False
) -> Sources:
    """`root/<table>` holds each table as Parquet; the declared schema is imposed on it.

    Lines without a number are the only one of their order and product. With `buckets` orders and
    lines are files that `write_parquet` laid out so: sums and joins by order need no exchange.
    `as_stored` takes the files' own types: binary row versions and padded keys are decoded.
    """
    tables = {}
    for name, schema in SOURCES.items():
        path = f"{root}/{name}"
        if as_stored:
            tables[name] = decoded(_with_number(spark.read.parquet(path), name), schema)
        elif buckets and name in BY_ORDER:
            tables[name] = bucketed(spark, path, schema, "order_id", buckets)
        else:
            tables[name] = spark.read.schema(schema).parquet(path)
    tables["order_details"] = _numbered(tables["order_details"])
    return Sources(**tables)


def _with_number(raw: DataFrame, name: str) -> DataFrame:
    if name == "order_details" and "line_no" not in raw.columns:
        return raw.withColumn("line_no", F.lit(1).cast("long"))
    return raw


def _numbered(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line_no", F.coalesce("line_no", F.lit(1).cast("long")))


def write_parquet(sources: Sources, root: str, buckets: int | None = None) -> None:
    def write(name: str) -> None:
        path = f"{root}/{name}"
        if buckets and name in BY_ORDER:
            stage_bucketed(sources[name], path, "order_id", buckets)
        else:
            sources[name].write.mode("overwrite").parquet(path)

    in_parallel(write, SOURCES)


def read_jdbc(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    table_names: dict[str, str] | None = None,
    split_by: dict[str, tuple[str, int, int, int]] | None = None,
) -> Sources:
    """Read the tables from a live database; the version filters are pushed to it.

    `split_by` gives, for a large table, the numeric column, its bounds and the number of
    partitions to read it with, so that no table has to pass through one task.
    """
    tables = {}
    for name, schema in SOURCES.items():
        reader = spark.read.format("jdbc").options(url=url, **properties)
        reader = reader.option("dbtable", (table_names or {}).get(name, name))
        if split_by and name in split_by:
            column, lower, upper, parts = split_by[name]
            reader = reader.options(
                partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
            )
        tables[name] = decoded(_with_number(reader.load(), name), schema)
    return Sources(**tables)


def max_versions(sources: Sources, marks: dict[str, int] | None = None) -> DataFrame:
    """One row per tracked table: its highest row version, 0 when it is empty.

    With `marks`, only rows above a table's mark are looked at, so that Parquet skips row groups
    without any; a table with none keeps its mark.
    """
    frames = []
    for name in TRACKED:
        mark = (marks or {}).get(name, 0)
        rows = sources[name]
        if marks is not None:
            rows = above(rows, mark)
        highest = F.coalesce(F.max("row_version"), F.lit(mark).cast("long"))
        frames.append(
            rows.agg(F.lit(name).alias("source_table"), highest.alias("max_row_version"))
        )
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union
