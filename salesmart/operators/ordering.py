"""Global order without a single task: dense ids, running totals and ranks.

Rows are sorted into files by a range exchange on the key itself, of whatever type, nulls
included. Each file is numbered or summed by itself and the files' totals are carried forward;
only one row per file meets in one place. There is one way for every size.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.session import scratch_path, stage

_FILE, _ROW = "__file", "__row"


def _by_file() -> list[Column]:
    """Files of one write in the order of their partitions: numbers of more digits come later."""
    return [F.length(_FILE), F.col(_FILE)]


def _located(stored: DataFrame) -> DataFrame:
    """Stored rows with the file they lie in and their place in it."""
    return stored.select(
        "*",
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.row_index").alias(_ROW),
    )


def _carry(located: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per file, the sums over all files before it."""
    totals = located.groupBy(_FILE).agg(*[expr.alias(name) for name, expr in sums.items()])
    before = Window.orderBy(*_by_file()).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        _FILE, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums]
    )


def sorted_files(df: DataFrame, *order: Column) -> DataFrame:
    """The rows written in order: file by file, and within each file."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ordered, scratch_path(df.sparkSession, "sorted"))


def dense_ids(df: DataFrame, key: str, id_column: str, start: int = 1) -> DataFrame:
    """Number the rows `start`, `start` + 1, ... in ascending order of a unique key.

    A null key comes first. The key may be of any type that has an order.
    """
    ordered = sorted_files(df, F.col(key).asc_nulls_first())
    return stored_order_ids(ordered, id_column, start)[0]


def stored_order_ids(stored: DataFrame, id_column: str, start: int = 1) -> tuple[DataFrame, int]:
    """Number the rows of Parquet files `start`, `start` + 1, ... as they lie in the files, and
    say how many there are.

    Only the row counts of the files meet in one place and are broadcast, a row per file; the rows
    are neither shuffled nor sorted.
    """
    located = _located(stored)
    before = _carry(located, {"__before": F.count(F.lit(1))})
    numbered = (F.col("__before") + F.col(_ROW) + start).cast("long")
    rows = located.join(F.broadcast(before), _FILE).withColumn(id_column, numbered)
    return rows.drop(_FILE, _ROW, "__before"), stored.count()


def with_running_total(
    df: DataFrame,
    value: str,
    totals: dict[str, Column],
    descending: bool = True,
    whole: str | None = None,
) -> DataFrame:
    """The rows of `df` with each total over all rows up to and including their value.

    Equal values share one total, null ones too: nulls come first when ascending and last when
    descending. Rows of one value may fill several files, so values that many rows share are not
    a hot key: a file is summed by itself, and what a value that crosses its border has in the
    files after it is carried over with the sums of the files before. The rows are written once;
    a row per file comes to the driver, as many as the range exchange has partitions. With
    `whole`, the totals over all rows are added too, under names that end so.
    """
    spark, names = df.sparkSession, list(totals)
    column = F.col(value)
    order = column.desc_nulls_last() if descending else column.asc_nulls_first()
    located = _located(sorted_files(df, order, F.xxhash64(*df.columns)))
    files = located.groupBy(_FILE).agg(
        F.min_by(F.struct(value), _ROW)[value].alias("__first"),
        F.max_by(F.struct(value), _ROW)[value].alias("__last"),
        *[totals[n].alias(n) for n in names],
    ).orderBy(*_by_file()).collect()
    # files that begin with the value with which the one before ends
    follow = [i for i in range(1, len(files)) if files[i]["__first"] == files[i - 1]["__last"]]
    leads: dict[str, tuple] = {}
    if follow:
        firsts = spark.createDataFrame(
            [(files[i][_FILE], files[i]["__first"]) for i in follow],
            T.StructType([T.StructField("__of", T.StringType()), T.StructField("__value", df.schema[value].dataType)]),
        )
        tied = located.join(
            F.broadcast(firsts),
            (F.col(_FILE) == F.col("__of")) & column.eqNullSafe(F.col("__value")),
            "left_semi",
        )
        summed = tied.groupBy(_FILE).agg(*[totals[n].alias(n) for n in names]).collect()
        leads = {r[_FILE]: tuple(r[n] or 0 for n in names) for r in summed}
    carried, before = [], tuple(0 for _ in names)
    for i, file in enumerate(files):
        later = tuple(0 for _ in names)
        for j in range(i + 1, len(files)):
            if files[j]["__first"] != file["__last"] or j not in follow:
                break
            later = tuple(a + b for a, b in zip(later, leads[files[j][_FILE]], strict=True))
            if files[j]["__last"] != file["__last"]:
                break
        carried.append((file[_FILE], file["__last"], *before, *later))
        before = tuple(a + (file[n] or 0) for a, n in zip(before, names, strict=True))
    upto = Window.partitionBy(_FILE).orderBy(order)  # equal values included
    rows = located.withColumns({f"__upto_{n}": totals[n].over(upto) for n in names})
    kinds = {n: rows.schema[f"__upto_{n}"].dataType for n in names}

    def typed(kind, number):
        return Decimal(number) if isinstance(kind, T.DecimalType) else number

    wide = [kinds[n] for n in names] * 2
    sums = spark.createDataFrame(
        [(f, last, *[typed(k, x) for k, x in zip(wide, more, strict=True)]) for f, last, *more in carried],
        T.StructType(
            [
                T.StructField(_FILE, T.StringType()),
                T.StructField("__last", df.schema[value].dataType),
                *[T.StructField(f"__before_{n}", kinds[n]) for n in names],
                *[T.StructField(f"__later_{n}", kinds[n]) for n in names],
            ]
        ),
    )
    crosses = column.eqNullSafe(F.col("__last"))
    running = [
        (
            F.col(f"__upto_{n}")
            + F.col(f"__before_{n}")
            + F.when(crosses, F.col(f"__later_{n}")).otherwise(F.lit(0))
        ).cast(kinds[n]).alias(n)
        for n in names
    ]
    more = [
        F.lit(typed(kinds[n], x)).cast(kinds[n]).alias(f"{n}{whole}")
        for n, x in zip(names, before, strict=True)
        if whole
    ]
    return rows.join(F.broadcast(sums), _FILE).select(*df.columns, *running, *more)


def running_total(
    df: DataFrame, value: str, totals: dict[str, Column], descending: bool = True
) -> DataFrame:
    """For each distinct `value`: each total over all rows up to and including that value."""
    rows = with_running_total(df, value, totals, descending)
    return rows.select(value, *totals).distinct()


def rank_descending(df: DataFrame, value: str, rank_column: str) -> DataFrame:
    """1 + the number of rows with a greater value: ties share a rank and leave a gap."""
    count = {"__upto": F.count(F.lit(1))}
    rows = with_running_total(df, value, count, descending=False, whole="_whole")
    rank = (F.col("__upto_whole") - F.col("__upto") + 1).cast("int")
    return rows.select(*df.columns, rank.alias(rank_column))
