"""Operator 9: mixing sources to target weights by temperature."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import WORD, Scratch, whole_text

#: Each round of the search cuts the exponent's interval into so many parts.
_PARTS, _ROUNDS = 16, 9


@dataclass(frozen=True)
class Target:
    """What the weights must meet; exactly one of the first two is given.

    `entropy`: entropy of the weights, as a share of the greatest (ln of the number of sources);
    the exponent is 1 where the plain shares have more. `repeats`: no source is read more often
    than so many times on average. `budget` counts tokens; None is the least budget at which
    every source is read once or more, so that no document is left out.
    """

    entropy: float | None = None
    repeats: float | None = None
    budget: int | None = None
    blocks: int = 1024
    seed: int = 42

    def __post_init__(self):
        if (self.entropy is None) == (self.repeats is None):
            raise ValueError("either an entropy or a repetition limit")
        if self.repeats is not None and self.repeats < 1:
            raise ValueError("a repetition limit of one or more")


def source_tokens(docs: DataFrame, source: str = "source") -> DataFrame:
    """(source, tokens, share): words of each source; sources without words have no share."""
    tokens = docs.groupBy(source).agg(F.sum("__tokens").alias("tokens"))
    total = tokens.agg(F.sum("tokens")).first()[0] or 0
    return tokens.filter("tokens > 0").withColumn(
        "share", F.col("tokens") / F.lit(float(max(total, 1)))
    )


def _measures(shares: DataFrame, exponents: list[float]) -> dict[float, tuple]:
    """For each exponent: sum of powers, entropy of the weights, most passes over a source when
    the least read source is read once, and that budget in shares of the corpus."""
    p, a = F.col("share"), F.col("exponent")
    grid = F.explode(F.array(*[F.lit(x) for x in exponents])).alias("exponent")
    rows = (
        shares.select("share", grid)
        .groupBy("exponent")
        .agg(
            F.sum(F.pow(p, a)).alias("z"),
            F.sum(F.pow(p, a) * F.ln(p)).alias("s"),
            F.max(F.pow(p, a - 1)).alias("high"),
            F.min(F.pow(p, a - 1)).alias("low"),
        )
        .select(
            "exponent",
            "z",
            F.ln("z") - a * F.col("s") / F.col("z"),
            F.col("high") / F.col("low"),
            F.col("z") / F.col("low"),
            "high",
        )
        .collect()
    )
    return {r[0]: tuple(r)[1:] for r in rows}


def _passes(measure: tuple, tokens: int, target: Target) -> float:
    z, _, ratio, _, high = measure
    return ratio if target.budget is None else high / z * target.budget / tokens


def find_exponent(shares: DataFrame, target: Target) -> tuple[float, float, float]:
    """(exponent, sum of powers, budget in tokens).

    The exponent falls from 1 (plain shares) to 0 (equal weights) until the target holds, which
    is monotone; each round keeps one of 16 parts of the interval. Only one row per exponent
    comes to the driver, whatever the number of sources.
    """
    tokens, sources = shares.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not sources:
        return 1.0, 1.0, 0.0

    def meets(measure: tuple) -> bool:
        if target.entropy is not None:  # the largest exponent with entropy enough
            return measure[1] >= target.entropy * _ln(sources) - 1e-9
        return _passes(measure, tokens, target) > target.repeats + 1e-9  # too flat

    low, high = 0.0, 1.0  # `meets` holds at low and not at high
    ends = _measures(shares, [0.0, 1.0])
    if meets(ends[1.0]):
        low = 1.0
    elif not meets(ends[0.0]):
        high = 0.0 if target.repeats is not None else 1.0
        low = 0.0
    if 0.0 < high - low and low < 1.0:
        for _ in range(_ROUNDS):
            grid = [low + (high - low) * i / _PARTS for i in range(1, _PARTS)]
            found = _measures(shares, grid)
            good = [x for x in grid if meets(found[x])]
            bad = [x for x in grid if not meets(found[x])]
            low, high = max([low, *good]), min([high, *bad])
            if high - low < 1e-12:
                break
    exponent = low if target.entropy is not None else high
    measure = _measures(shares, [exponent])[exponent]
    budget = float(target.budget) if target.budget is not None else tokens * measure[3]
    return exponent, measure[0], budget


def _ln(n: int) -> float:
    import math

    return math.log(n)


def _quota(budget: float, target: Target) -> Column:
    """Tokens to read of a source. Without a budget no source is read less than once, whatever
    the powers of large numbers are rounded to."""
    quota = F.floor(F.col("__weight") * F.lit(budget) + 1e-6)
    return quota if target.budget is not None else F.greatest(quota, F.col("tokens"))


def mix_sources(
    docs: DataFrame, target: Target, source: str = "source", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents as they are read for training: each row as often as its source's weight asks.

    Weights are the sources' token shares to the power found by `find_exponent`, brought to sum
    one; a source's quota is its weight of the budget. The source is read in whole passes, then
    in part. Documents lie in `target.blocks` blocks by hash; every pass is another permutation of the
    blocks, and the partial pass is cut inside a block by a finer hash, then by row, so that the
    quota is met within one document. No source meets in one task: blocks are summed first, and
    rows are ordered only within the cut.

    Adds `mix_pass` (from 1), `mix_order` (0 to 1: sorting all rows by it reads every source at
    its weight all along), `mix_weight` and `mix_tokens`. Columns of those names are replaced.

    Defined cases: a null source is a source of its own; a null text has no words; documents
    without words have no quota to spend and are read once, in the first pass (with weight null if their
    whole source has none); repeated rows are documents of their own and may be dealt in any
    order; an empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    out = ["mix_pass", "mix_order", "mix_weight", "mix_tokens"]
    docs = docs.drop(*[c for c in out if c in docs.columns and c not in (source, key, text)])
    columns = docs.columns
    blocks, seed = target.blocks, target.seed
    tokens = F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")
    draw = F.xxhash64(F.lit(seed), F.col(key), F.xxhash64(text))
    plain = docs.select(
        "*",
        tokens.alias("__tokens"),
        F.pmod(draw, F.lit(blocks)).cast("int").alias("__block"),
        draw.alias("__draw"),
    )
    small = scratch.stage(
        plain.groupBy(F.col(source).alias("__source"), "__block").agg(
            F.sum("__tokens").alias("__tokens")
        )
    )
    shares = scratch.stage(source_tokens(small, "__source"))
    exponent, powers, budget = find_exponent(shares, target)
    quotas = (
        shares.withColumn("__weight", F.pow("share", F.lit(exponent)) / F.lit(powers))
        .withColumn("__quota", _quota(budget, target))
        .withColumn("__whole", F.floor(F.col("__quota") / F.col("tokens")).cast("int"))
        .withColumn("__rest", F.col("__quota") - F.col("__whole") * F.col("tokens"))
    )
    # one row per source, pass and block, in the order of that pass
    passes = small.join(
        quotas.withColumnRenamed("__source", "__of"),
        F.col("__source").eqNullSafe(F.col("__of")), "left",
    ).select(
        "__source", "__block", "__tokens", "__weight", "__quota", "__whole", "__rest",
        F.col("tokens").alias("__all"),
        F.explode(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.coalesce(F.col("__whole"), F.lit(0)) + 1))
        ).alias("mix_pass"),
    )
    place = Window.partitionBy("__source", "mix_pass").orderBy(
        F.xxhash64(F.lit(seed), "__source", "mix_pass", "__block"), "__block"
    )
    passes = (
        passes.withColumn("__end", F.sum("__tokens").over(place))
        .withColumn("__start", F.col("__end") - F.col("__tokens"))
        .withColumn("__partial", F.coalesce(F.col("mix_pass") > F.col("__whole"), F.lit(False)))
        .filter("not __partial or __start < __rest or mix_pass = 1")
        .select(
            F.col("__source").alias("__of"), F.col("__block").alias("__at"), "mix_pass", "__weight",
            # where a block of the partial pass is cut: 0 keeps no words, null keeps all
            F.when(F.col("__partial") & (F.col("__end") > F.col("__rest")),
                   F.greatest(F.lit(0), F.col("__rest") - F.col("__start"))).alias("__left"),
            F.coalesce(
                ((F.col("mix_pass") - 1) * F.col("__all") + F.col("__start"))
                / F.greatest(F.lit(1), "__quota"), F.lit(0.0)
            ).alias("mix_order"),
        )
    )
    passes = scratch.stage(passes)
    read = plain.join(
        passes, F.col(source).eqNullSafe(F.col("__of")) & (F.col("__block") == F.col("__at"))
    ).drop("__of", "__at")
    whole = read.filter("__left is null or (__tokens = 0 and mix_pass = 1)")
    cut = read.filter("__left is not null and __tokens > 0")
    # the cut block of a source: sums of 1,024 finer blocks, then rows within one of them
    fine = F.pmod(F.shiftright("__draw", 20), F.lit(1024)).alias("__fine")
    lines = cut.select(F.col(source).alias("__of"), "mix_pass", "__block", "__left", "__tokens", fine)
    upto = Window.partitionBy("__of", "mix_pass", "__block").orderBy("__fine")
    fines = (
        lines.groupBy("__of", "mix_pass", "__block", "__left", "__fine")
        .agg(F.sum("__tokens").alias("__sum"))
        .withColumn("__before", F.sum("__sum").over(upto) - F.col("__sum"))
        .filter("__before < __left")
        .select("__of", F.col("mix_pass").alias("__p"), F.col("__block").alias("__b"),
                F.col("__fine").alias("__f"), "__before")
    )
    rows = Window.partitionBy(source, "mix_pass", "__block", "__fine").orderBy("__draw", "__tokens")
    cut = (
        cut.withColumn("__fine", fine)
        .join(
            fines,
            F.col(source).eqNullSafe(F.col("__of")) & (F.col("mix_pass") == F.col("__p"))
            & (F.col("__block") == F.col("__b")) & (F.col("__fine") == F.col("__f")),
        )
        .withColumn(
            "__upto",
            F.col("__before")
            + F.sum("__tokens").over(rows.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .filter("__upto <= __left")
    )
    kept = [
        *columns, "mix_pass", "mix_order", F.col("__weight").alias("mix_weight"),
        F.col("__tokens").alias("mix_tokens"),
    ]
    return whole.select(*kept).unionByName(cut.select(*kept))
