"""Operator 1: secret scans whose false positives a random forest removes.

Candidates are long runs of letters, digits and a few signs. The forest sees their length,
character transitions, dictionary coverage, path and neighbouring words, and is trained from
labelled findings. DataFrame functions and JVM trees only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch, whole_text

#: A run of 16 signs or more between other characters.
CANDIDATE = r"(?<![\p{L}\p{N}+/_-])[A-Za-z0-9+/_-]{16,}+(?![\p{L}\p{N}])"
BEFORE_CHARS, AFTER_CHARS = 40, 20
#: Words beside a candidate that speak for a secret, and against.
FOR = r"(?i)(?<!\p{L})(token|secret|passwor[dt]|passwd|pwd|key|api[_-]?key|auth|bearer|credential)s?(?!\p{L})"
AGAINST = r"(?i)(?<!\p{L})(commit|sha\d*|md5|hash|checksum|digest|uuid|guid|example|sample|card|order|id)(?!\p{L})"
ASSIGNED = r"(=|:)\s*[\"']?$"
ISSUED = r"^(AKIA[A-Z2-7]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,})$"
HEXADECIMAL = r"^[0-9a-f]+$"
TEST_PATH = r"(?i)(test|example|sample|mock|fixture|vendor|doc)s?(?!\p{L})"
FEATURES = 17


@dataclass(frozen=True)
class Fit:
    """findings: labelled findings used at most, drawn by hash. words: size of the dictionary."""

    findings: int = 20_000
    words: int = 300
    trees: int = 30
    depth: int = 6


@dataclass(frozen=True)
class Scanner:
    words: tuple[str, ...]
    forest: RandomForestClassificationModel | None = None
    #: The score of every candidate if the labels lack a class.
    prior: float = 0.0


def candidates(docs: DataFrame, path: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, place, candidate, before, after, path): every candidate, numbered from 0 in its
    text, with the characters around it up to the next candidate."""
    whole = whole_text(text)
    split = docs.select(
        F.col(key).alias("doc_id"),
        path.cast("string").alias("path"),
        F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.split(whole, CANDIDATE, -1).alias("between"),
    ).filter(F.size("found") > 0)

    def around(candidate: Column, i: Column) -> Column:
        before, after = F.get("between", i), F.get("between", i + 1)
        return F.struct(
            i.alias("place"),
            candidate.alias("candidate"),
            F.right(before, F.lit(BEFORE_CHARS)).alias("before"),
            F.left(after, F.lit(AFTER_CHARS)).alias("after"),
        )

    return split.select("doc_id", "path", F.inline(F.transform("found", around)))


def dictionary(docs: DataFrame, size: int, text: str = "text") -> tuple[str, ...]:
    """The most frequent words of three to eight letters a-z in all texts."""
    words = F.explode(F.regexp_extract_all(
        F.lower(whole_text(text)), F.lit(r"(?<![\p{L}\p{N}])[a-z]{3,8}(?![\p{L}\p{N}])"), F.lit(0)
    ))
    counted = docs.select(words.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(size).collect()
    return tuple(r.word for r in top)


def features(words: tuple[str, ...]) -> Column:
    """FEATURES numbers of a candidate row; nulls count as empty."""
    c = F.coalesce(F.col("candidate"), F.lit(""))
    before, after = F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))
    path = F.coalesce("path", F.lit(""))
    n = F.greatest(F.char_length(c), F.lit(1)).cast("double")

    def rate(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    def flag(text: Column, pattern: str) -> Column:
        return F.rlike(text, F.lit(pattern)).cast("double")

    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    left = F.char_length(F.regexp_replace(F.lower(c), known, ""))
    return F.array(
        n,
        # transitions between kinds of characters
        rate(r"[a-z](?=[0-9])|[0-9](?=[a-z])"),
        rate(r"[A-Z](?=[0-9])|[0-9](?=[A-Z])"),
        rate(r"[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        rate(r"(?i)[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])"),
        rate(r"[0-9]"),
        rate(r"[A-Z]"),
        rate(r"[+/_-]"),
        F.size(F.array_distinct(F.split(c, ""))) / n,
        flag(c, HEXADECIMAL),
        1.0 - left / n,
        F.char_length(path).cast("double"),
        F.regexp_count(path, F.lit("/")).cast("double"),
        flag(path, TEST_PATH),
        flag(before, FOR),
        flag(before, AGAINST),
        flag(F.concat(before, F.lit("")), ASSIGNED) + flag(after, r"^[\"']"),
    )


def fit_scanner(docs: DataFrame, findings: DataFrame, fit: Fit = Fit(), text: str = "text") -> Scanner:
    """A scanner from all texts (dictionary) and labelled findings: candidate, before, after, path and `label`
    0 or 1, other labels ignored; findings that repeat count as often."""
    words = dictionary(docs, fit.words, text)
    columns = ["candidate", "before", "after", "path"]
    drawn = (
        findings.filter("label in (0, 1)")
        .select(*columns, F.col("label").cast("double").alias("label"))
        .orderBy(F.xxhash64(*columns), *columns, "label").limit(fit.findings)
    )
    known = Scratch(docs.sparkSession, "secrets").stage(
        drawn.select("label", array_to_vector(features(words)).alias("features"))
    )
    n, positive = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or positive in (0, n):
        return Scanner(words, prior=(positive or 0.0) / max(n, 1))
    forest = RandomForestClassifier(
        numTrees=fit.trees, maxDepth=fit.depth, minInstancesPerNode=2, seed=42
    ).fit(known)
    return Scanner(words, forest)


def scan(found: DataFrame, scanner: Scanner) -> DataFrame:
    """Candidate rows with `score`, the forest's share of votes for a secret."""
    columns = [c for c in found.columns if c not in ("score", "features")]
    if scanner.forest is None:
        return found.select(*columns).withColumn("score", F.lit(float(scanner.prior)))
    described = found.select(
        F.struct(*columns).alias("row"), array_to_vector(features(scanner.words)).alias("features")
    )
    return scanner.forest.transform(described).select(
        "row.*", vector_to_array("probability")[1].alias("score")
    )


def labelled_by_format(found: DataFrame) -> DataFrame:
    """Labels where no reviewer gave any: 1 for issued key formats and for hexadecimal values that
    are assigned to a name of a secret, 0 for runs of letters and for runs of digits."""
    issued = F.rlike("candidate", F.lit(ISSUED))
    given = (
        F.rlike("candidate", F.lit(HEXADECIMAL))
        & F.rlike("before", F.lit(FOR))
        & F.rlike("before", F.lit(ASSIGNED))
    )
    plain = F.rlike("candidate", F.lit(r"^([A-Za-z]+|[0-9]+)$"))
    return found.withColumn("label", F.when(issued | given, 1).when(plain, 0))
