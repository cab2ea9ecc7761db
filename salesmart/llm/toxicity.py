"""Operator 10: toxicity by gradient-boosted trees over dense features, calibrated isotonically.

A lexicon of word beginnings is learned from labelled texts and joined to a short given one; the
trees see only densities and rates, never words. Fitting uses a bounded sample of labelled rows (`Fit.rows`);
scoring reads every text whole, row by row, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch, WordHashes, shingle_hashes, word_hashes, words_of

#: Insults that need no learning.
LEXICON = (
    "arschloch", "basura", "clown", "connard", "disgusting", "dumm", "estúpid", "idiot", "imbecil",
    "imbécil", "loser", "moron", "pathetic", "scum", "stupid", "trash", "verpiss", "worthless",
)
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen euch euer eure ihr tu te toi "
    "ton ta tes vous votre vos tú ti tuyo tuya tus usted ustedes vosotros vuestro vuestra".split()
)
#: Letters that digits and signs stand for in disguised words.
DISGUISE = str.maketrans("0134578@$!|+", "oieastbasiit", "*._-")

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_SPACE = re.compile(r"\s|\Z")
_DISGUISED = re.compile(r"[^\W\d_][@$!|*+._\-0-9]+(?=[^\W\d_])")
_PREFIXES = range(4, 9)
_NEAR = 5
FEATURES = (
    "hits", "distinct_hits", "hits_per_100_words", "hits_near_second_person", "near_share",
    "second_person_rate", "capitals", "shouted_words", "exclamations", "punctuation",
    "disguised_rate", "disguised_hits", "log_words", "word_length",
)


@dataclass(frozen=True)
class Fit:
    """rows: labelled rows used at most, drawn by hash. stems: learned word beginnings at most."""

    rows: int = 20_000
    stems: int = 400
    support: int = 3
    #: Log-likelihood ratio that a learned word beginning must reach.
    evidence: float = 22.0
    trees: int = 20
    depth: int = 3
    step: float = 0.2
    lexicon: tuple[str, ...] = LEXICON


@dataclass(frozen=True)
class Model:
    stems: tuple[str, ...]
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    #: The score of every text if the labels could not teach anything.
    prior: float = 0.0
    notes: dict = field(default_factory=dict)


class _Hits(dict):
    """The stem that a word begins with, or an empty string."""

    def __init__(self, stems: tuple[str, ...]):
        super().__init__()
        self.stems = frozenset(stems)
        self.lengths = sorted({len(s) for s in stems})

    def __missing__(self, word: str) -> str:
        if len(self) > 300_000:
            self.clear()
        found = next((word[:n] for n in self.lengths if word[:n] in self.stems), "")
        self[word] = found
        return found


def describe(text: str | None, hits: _Hits) -> list[float]:
    """The features of one text, in the order of FEATURES; an empty text has zeros."""
    text = text or ""
    lower = text.lower()
    words = _WORD.findall(lower)
    n = len(words)
    found = [(i, s) for i, s in enumerate(map(hits.__getitem__, words)) if s]
    persons = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
    near = 0
    if found and len(persons):
        at = np.array([i for i, _ in found])
        after = np.searchsorted(persons, at)
        right = persons[np.minimum(after, len(persons) - 1)]
        left = persons[np.maximum(after - 1, 0)]
        near = int((np.minimum(abs(right - at), abs(at - left)) <= _NEAR).sum())
    disguised, in_disguise, last = 0, 0, -1
    for m in _DISGUISED.finditer(lower):
        if m.start() < last:
            continue
        start = max(lower.rfind(" ", 0, m.start()), lower.rfind("\n", 0, m.start())) + 1
        stop = _SPACE.search(lower, m.end()).start()
        last = stop
        disguised += 1
        plain = _WORD.search(lower[start:stop].translate(DISGUISE))
        in_disguise += bool(plain and hits[plain.group()])
    letters = sum(map(len, words))
    capitals = sum(1 for c in text if c.isupper()) if not text.islower() else 0
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper())
    signs = len(text) - letters - text.count(" ") - text.count("\n")
    count = max(n, 1)
    return [
        float(len(found)), float(len({s for _, s in found})), 100.0 * len(found) / count,
        float(near), near / max(len(found), 1), len(persons) / count,
        capitals / max(letters, 1), shouted / count, text.count("!") / count,
        signs / max(len(text), 1), disguised / count, float(in_disguise),
        float(np.log1p(n)), letters / count,
    ]


def _describe_batches(stems: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _Hits(stems)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                rows = [describe(t, hits) for t in piece[batch.num_columns - 1].to_pylist()]
                yield pa.record_batch(
                    [*piece.columns, pa.array(rows, pa.list_(pa.float64()))],
                    [*batch.schema.names, "features"],
                )

    return run


def _near_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key that near copies of a text mostly share: its least shingle hash."""
    cache = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            piece, keys = batch.slice(at, 500), []
            for text in piece[2].to_pylist():
                shingles = shingle_hashes(word_hashes(words_of(text), cache))
                keys.append(int(shingles.min().astype(np.int64)) if len(shingles) else 0)
            yield pa.record_batch(
                [piece[0], piece[1], piece[2], pa.array(keys, pa.int64())],
                ["doc_id", "toxic", "text", "near_key"],
            )


def _count_beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            toxic, clean = Counter(), Counter()
            piece = batch.slice(at, 500)
            for label, text in zip(piece[0].to_pylist(), piece[1].to_pylist(), strict=True):
                words = set(_WORD.findall((text or "").lower()))
                stems = {w[:n] for w in words for n in _PREFIXES if len(w) >= n}
                (toxic if label else clean).update(stems)
            stems = list({*toxic, *clean})
            yield pa.record_batch(
                [
                    pa.array(stems),
                    pa.array([toxic[s] for s in stems], pa.int64()),
                    pa.array([clean[s] for s in stems], pa.int64()),
                ],
                ["stem", "toxic", "clean"],
            )


def _learn_stems(texts: DataFrame, fit: Fit) -> tuple[str, ...]:
    """Word beginnings that toxic texts have far more often than clean ones."""
    totals = texts.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, clean = (float(x or 0) for x in totals)
    if not toxic or not clean:
        return fit.lexicon
    share = toxic / (toxic + clean)
    counts = (
        texts.select("toxic", "text")
        .mapInArrow(_count_beginnings, "stem string, toxic long, clean long")
        .groupBy("stem").agg(F.sum("toxic").alias("p"), F.sum("clean").alias("n"))
        .filter(f"p >= {fit.support} and (p + 0.5) / {toxic} >= 20 * (n + 0.5) / {clean}")
    )
    p, n = F.col("p"), F.col("n")
    ratio = 2 * (
        p * F.ln(p / ((p + n) * share))
        + F.when(n > 0, n * F.ln(n / ((p + n) * (1 - share)))).otherwise(0.0)
    )
    best = (
        counts.withColumn("ratio", ratio).filter(F.col("ratio") >= fit.evidence)
        .orderBy(F.desc("ratio"), F.length("stem"), "stem").limit(8 * fit.stems).collect()
    )
    stems = list(fit.lexicon)
    for row in best:  # a stem takes in all longer ones
        if len(stems) >= fit.stems + len(fit.lexicon):
            break
        if not any(row.stem.startswith(s) for s in stems):
            stems = [s for s in stems if not s.startswith(row.stem)] + [row.stem]
    return tuple(sorted(stems))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), key: str = "doc_id", text: str = "text"
) -> Model:
    """A model from labelled rows (`labels`: key, toxic 0 or 1).

    Labels without key or value are ignored, a key with both values counts as toxic. Near copies of
    one text count once. Three quarters of the rows teach the lexicon, whose words need strong
    evidence, and the trees; the last quarter only the calibration. If the labels lack a class,
    every text gets the share of toxic labels.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    asked = (
        labels.select(F.col(key).alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    drawn = asked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.rows)
    rows = (
        docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
        .join(F.broadcast(drawn), "doc_id")  # at most `fit.rows` rows
        .select("doc_id", "toxic", "text")
        .mapInArrow(_near_keys, "doc_id long, toxic int, text string, near_key long")
        .groupBy("near_key")
        .agg(F.min_by(F.struct("doc_id", "toxic", "text"), F.struct("doc_id", "toxic")).alias("r"))
        .select("r.*", F.pmod(F.xxhash64("r.doc_id", F.lit(7)), F.lit(4)).alias("fold"))
    )
    rows = scratch.stage(rows)
    stems = _learn_stems(rows.filter("fold < 3"), fit)
    described = scratch.stage(
        rows.select(
            F.when(F.col("fold") < 3, 2).otherwise(3).cast("long").alias("fold"),
            F.col("toxic").cast("double").alias("label"),
            "text",
        )
        .mapInArrow(
            _describe_batches(stems), "fold long, label double, text string, features array<double>"
        )
        .drop("text")
        .withColumn("features", array_to_vector("features"))
    )
    sums = {
        r.fold: (r.n, r.toxic)
        for r in described.groupBy("fold")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).collect()
    }
    both = lambda f: f in sums and 0 < sums[f][1] < sums[f][0]
    total = sum(n for n, _ in sums.values())
    prior = sum(t for _, t in sums.values()) / total if total else 0.0
    if not both(2):
        return Model(stems, prior=prior)
    trees = GBTClassifier(
        maxIter=fit.trees, maxDepth=fit.depth, stepSize=fit.step, minInstancesPerNode=4, seed=42
    ).fit(described.filter("fold = 2"))
    calibration = None
    if both(3):
        raw = trees.transform(described.filter("fold = 3")).select("label", _raw().alias("raw"))
        calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    return Model(stems, trees, calibration, prior)


def _raw() -> Column:
    return vector_to_array("probability")[1]


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs` with `score` (0 to 1); a column of that name is replaced.

    A null text scores as an empty one.
    """
    columns = [c for c in docs.columns if c != "score"]
    if model.trees is None:
        return docs.select(*columns).withColumn("score", F.lit(float(model.prior)))
    # other columns travel in one, so that no name of theirs meets a name of the model's
    rest = F.struct(F.lit(0).alias("__none"), *[F.col(c) for c in columns if c != text])
    packed = docs.select(rest.alias("rest"), F.col(text).alias("text"))
    kind = packed.schema["rest"].dataType.simpleString()
    described = packed.mapInArrow(
        _describe_batches(model.stems), f"rest {kind}, text string, features array<double>"
    ).withColumn("features", array_to_vector("features"))
    scored = model.trees.transform(described).withColumn("raw", _raw())
    score = F.col("raw")
    if model.calibration is not None:
        # equal calibrated values keep the order of the trees
        scored = model.calibration.setPredictionCol("calibrated").transform(scored)
        score = 0.99 * F.col("calibrated") + 0.01 * F.col("raw")
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))
    own = [F.col("text" if c == text else f"rest.`{c}`").alias(c) for c in columns]
    return scored.select(*own, score.alias("score"))


def held_out(key: Column) -> Column:
    """Rows that teach nothing: crc32 of the number as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))
