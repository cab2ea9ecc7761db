"""The append-only sales ledger: balances, reversals, new states and deletions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.schema import (
    FACT,
    MEASURES,
    MONEY,
    POSITION,
    POSITION_KEYS,
    TX_DELETION,
    TX_NEW_VERSION,
    TX_ORIGINAL,
    TX_REVERSAL,
)

# A line of an order; `line_no` tells lines of one product apart.
LINE = ["order_id", "product_id", "line_no"]
_ENTRY = [c for c in FACT.fieldNames() if c != "fact_id"]


def as_positions(rows: DataFrame) -> DataFrame:
    """Ledger rows widened to the types of balances, so that both can be added up."""
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in POSITION.fields])


def net(positions: DataFrame) -> DataFrame:
    """Add up positions that agree in order, product, keys, price and discount."""
    sums = [F.sum(m).cast(POSITION[m].dataType).alias(m) for m in MEASURES]
    return positions.groupBy(*POSITION_KEYS).agg(*sums).select(*POSITION.fieldNames())


def rolled_up(positions: DataFrame) -> DataFrame:
    """Net positions without those that are zero throughout: they can never matter again."""
    moved = F.lit(False)
    for m in MEASURES:
        moved = moved | (F.col(m) != 0)
    return net(positions).filter(moved)


def open_balances(positions: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Balances with a positive quantity, of the touched lines or of all lines."""
    if touched is not None:
        positions = positions.join(touched.select(*LINE), LINE, "left_semi")
    return net(positions).filter(F.col("quantity") > 0)


def reversals(balances: DataFrame, tx_type: str) -> DataFrame:
    """Entries that take the balances back, with the keys they were booked under."""
    negated = {
        "quantity": (-F.col("quantity")).cast("int"),
        "sale_amount": (-F.col("sale_amount")).cast(MONEY),
        "freight_alloc": (-F.col("freight_alloc")).cast(MONEY),
        "tx_type": F.lit(tx_type),
    }
    return balances.withColumns(negated).select(*_ENTRY)


def first_entries(fresh: DataFrame) -> DataFrame:
    """Every fresh line as a first sale."""
    return fresh.withColumn("tx_type", F.lit(TX_ORIGINAL)).select(*_ENTRY)


def upsert_entries(fresh: DataFrame, balances: DataFrame) -> DataFrame:
    """Reversals of what is booked, and the new state of every fresh line.

    A line is a first sale or a new version depending on whether it has a balance, so one join
    with the distinct balanced lines stands for both.
    """
    known = balances.select(*LINE).distinct().withColumn("__known", F.lit(True))
    kind = F.when(F.col("__known"), TX_NEW_VERSION).otherwise(TX_ORIGINAL)
    states = fresh.join(known, LINE, "left").withColumn("tx_type", kind).select(*_ENTRY)
    return reversals(balances, TX_REVERSAL).unionByName(states)


def missing_lines(positions: DataFrame, source_lines: DataFrame) -> DataFrame:
    """Booked lines that are gone from the source. Only the three numbers of a line are moved."""
    return positions.select(*LINE).join(source_lines.select(*LINE), LINE, "left_anti")


def deleted_balances(positions: DataFrame, source_lines: DataFrame) -> DataFrame:
    """Open balances whose line is gone from the source."""
    return open_balances(positions, missing_lines(positions, source_lines))


def deletion_entries(positions: DataFrame, missing: DataFrame) -> DataFrame:
    """Entries that take back what is still open of missing lines."""
    return reversals(open_balances(positions, missing), TX_DELETION)


def net_positions(fact: DataFrame) -> DataFrame:
    """Net state per order line: what the source holds now."""
    return (
        fact.groupBy(*LINE)
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("sale_amount").alias("sale_amount"),
            F.sum("freight_alloc").alias("freight_alloc"),
        )
        .filter(F.col("quantity") != 0)
    )
