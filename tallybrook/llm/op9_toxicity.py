"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

The features are densities of a lexicon learned from the labelled rows (whole words and
word beginnings), nearness of its words to the second person, and rates of capitals,
punctuation and obfuscated spellings. Labels are learned only from rows whose
crc32(doc_id as text) mod 5 is not 0; of those, remainder 1 is kept for the calibration.
At most ``TRAINING_ROWS`` labelled rows are used, those of least hashed id, and of the words
and the beginnings that mark toxic ones among these the ``LEXICON_SIZE`` strongest each;
both are parameters of ``train``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import TYPE_CHECKING, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import sliced, stored

if TYPE_CHECKING:  # the functions import it: Python workers need none of it
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import IsotonicRegressionModel

TRAINING_ROWS = 20_000
LEXICON_SIZE = 600
# A word or beginning counts if it is in this many toxic rows at least, this much likelier there.
LEAST_ROWS, LEAST_ODDS = 5, 8.0
BEGINNINGS = (4, 5, 6)
NEAR = 5  # words

# How the second person shows in English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre "
    "tú ti tus usted ustedes vosotros".split()
)
# Characters that stand for letters in obfuscated spellings.
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")

FEATURES = (
    "hits_per_word", "log_hits", "weight_per_word", "largest_weight", "log_distinct_hits",
    "near_second_person", "second_person_per_word", "capital_letters", "capital_words",
    "punctuation", "exclamations", "repeated_punctuation", "mixed_words", "stretched_words",
    "obfuscated_hits", "log_words",
)

_WORD = re.compile(r"[^\W_]+")
_SPELLED = re.compile(r"[^\W\d_]+[\d@$!*]+[^\W_]+")
_STRETCHED = re.compile(r"(\w)\1\1")
_PUNCTUATION = re.compile(r"[^\w\s]")
_REPEATED = re.compile(r"([^\w\s])\1+")


class Lexicon(NamedTuple):
    """Weights (log odds) of whole words and of word beginnings."""

    words: dict[str, float]
    beginnings: dict[str, float]


class Model(NamedTuple):
    """Without trees (no labels, or all alike) every text gets the share of toxic rows."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float


class _Weights(dict):
    """Weight of a word: the largest of its own and its beginnings'; 0 if none is known."""

    MOST = 120_000

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        known = [self.lexicon.words.get(word, 0.0)]
        known += [self.lexicon.beginnings.get(word[:n], 0.0) for n in BEGINNINGS if len(word) >= n]
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = max(known)
        return value


def features(text: str | None, weights: _Weights) -> list[float]:
    """``FEATURES`` of a whole text; of a null or empty one all are 0."""
    text = text or ""
    lower = _WORD.findall(text.lower())
    n = len(lower)
    if n == 0:
        return [0.0, 0, 0, 0, 0, 0, 0, 0, 0, len(_PUNCTUATION.findall(text)) / max(1, len(text)), 0, 0, 0, 0, 0, 0]
    of_word = list(map(weights.__getitem__, lower))
    hits = [i for i, w in enumerate(of_word) if w > 0]
    second = [i for i, w in enumerate(lower) if w in SECOND_PERSON] if not SECOND_PERSON.isdisjoint(lower) else []
    near = 0
    if hits and second:
        marked = set()
        for i in second:
            marked.update(range(i - NEAR, i + NEAR + 1))
        near = sum(i in marked for i in hits)
    spelled = _SPELLED.findall(text)
    plain = (w.translate(LOOKALIKES).replace("*", "").lower() for w in spelled)
    obfuscated = sum(weights[w] > 0 for w in plain)
    upper = sum(map(str.isupper, text))
    shouted = sum(len(w) > 2 for w in filter(str.isupper, text.split())) if upper else 0
    marks = len(_PUNCTUATION.findall(text))
    return [
        len(hits) / n, math.log1p(len(hits)), sum(of_word) / n, max(of_word),
        math.log1p(len({lower[i] for i in hits})), near / max(1, len(hits)), len(second) / n,
        upper / len(text), shouted / n, marks / len(text), (text.count("!") + text.count("?")) / n,
        len(_REPEATED.findall(text)) / n, len(spelled) / n,
        len(_STRETCHED.findall(text)) / n, obfuscated / n, math.log1p(n),
    ]


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_labels(labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, toxic, fold) of the rows to learn from; an id labelled both ways is toxic."""
    own = labels.select(labels["doc_id"].alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    own = own.where("doc_id is not null and toxic in (0, 1)")
    own = own.withColumn("fold", remainder(F.col("doc_id"))).where("fold <> 0")
    own = own.groupBy("doc_id", "fold").agg(F.max("toxic").alias("toxic"))
    return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "toxic", "fold")


def learn_lexicon(texts: DataFrame, size: int = LEXICON_SIZE) -> Lexicon:
    """Words and beginnings that mark toxic rows, from (_text, toxic); at most ``size`` of each."""

    def count(batches):
        for batch in sliced(batches, 512):
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column("_text").to_pylist(), batch.column("toxic").to_pylist()):
                words = set(_WORD.findall((text or "").lower()))
                terms = {f"w{w}" for w in words}
                terms.update(f"b{w[:n]}" for w in words for n in BEGINNINGS if len(w) >= n)
                counts[toxic].update(terms)
            for toxic, own in enumerate(counts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(own), pa.string()), pa.array([toxic] * len(own), pa.int32()),
                     pa.array(list(own.values()), pa.int64())],
                    ["term", "toxic", "n"],
                )

    of = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    counted = texts.select("_text", "toxic").mapInArrow(count, "term string, toxic int, n bigint")
    in_class = lambda x: F.coalesce(F.sum(F.when(F.col("toxic") == x, F.col("n"))), F.lit(0))
    counted = counted.groupBy("term").agg(in_class(1).alias("bad"), in_class(0).alias("good"))
    odds = ((F.col("bad") + 0.5) / (of.get(1, 0) + 1)) / ((F.col("good") + 0.5) / (of.get(0, 0) + 1))
    strong = counted.select("term", "bad", odds.alias("odds")).where(f"bad >= {LEAST_ROWS} and odds >= {LEAST_ODDS}")
    strong = stored(strong, "lexicon")
    found: dict[str, dict[str, float]] = {}
    for kind in "wb":
        best = strong.where(F.col("term").startswith(kind)).orderBy(
            (F.col("bad") * F.log("odds")).desc(), "term").limit(size)
        found[kind] = {r["term"][1:]: math.log(r["odds"]) for r in best.collect()}
    return Lexicon(found["w"], found["b"])


def featured(docs: DataFrame, lexicon: Lexicon, text: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns as _k0, _k1, ... and ``_features``."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        weights = _Weights(shared.value)
        for batch in sliced(batches):
            rows = [features(t, weights) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(rows, pa.list_(pa.float64()))],
                [*batch.schema.names[1:], "_features"],
            )

    kept = [docs[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)]
    source = docs.select(docs[f"`{text}`"].cast("string").alias("_text"), *kept)
    types = [f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[1:]]
    return source.mapInArrow(run, ", ".join([*types, "_features array<double>"]))


def train(docs: DataFrame, labels: DataFrame, *, most: int = TRAINING_ROWS, lexicon_size: int = LEXICON_SIZE,
          seed: int = 7) -> Model:
    """Fit lexicon, trees and calibration on the labelled documents (see the module)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression

    chosen = stored(training_labels(labels, most), "toxicity-labels")
    known = docs.select(docs["doc_id"].alias("_id"), docs["text"].cast("string").alias("_text"))
    # bounded: at most ``most`` rows of three small numbers
    known = known.join(F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), "_id")
    lexicon = learn_lexicon(known.where("fold <> 1"), lexicon_size)
    rows = stored(
        featured(known, lexicon, "_text", ["toxic", "fold"])
        .select(F.col("_k0").alias("toxic"), F.col("_k1").alias("fold"), "_features"), "toxicity-rows"
    )
    counts = {(r["fold"] == 1, r["toxic"]): r["count"]
              for r in rows.groupBy((F.col("fold") == 1).alias("fold"), "toxic").count().collect()}
    total, toxic = sum(counts.values()), sum(n for (_, t), n in counts.items() if t == 1)
    share = toxic / total if total else 0.0
    if not (counts.get((False, 0)) and counts.get((False, 1))):
        return Model(lexicon, None, None, share)
    vectors = rows.withColumn("features", array_to_vector("_features")).withColumn("toxic", F.col("toxic").cast("double"))
    trees = GBTClassifier(
        featuresCol="features", labelCol="toxic", maxIter=20, maxDepth=4, stepSize=0.3, seed=seed
    ).fit(vectors.where("fold <> 1").coalesce(4))
    calibration = None
    if counts.get((True, 0)) and counts.get((True, 1)):
        margins = _margin(trees.transform(vectors.where("fold = 1")))
        calibration = IsotonicRegression(featuresCol="_margin", labelCol="toxic").fit(
            margins.select("_margin", "toxic").coalesce(1)
        )
    return Model(lexicon, trees, calibration, share)


def _margin(scored: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return scored.withColumn("_margin", vector_to_array("rawPrediction")[1])


def score(docs: DataFrame, model: Model, *, keep=("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns, score (0 to 1) and predicted (1 if score >= 0.5).

    Every row is scored, null and empty texts by their all-zero features; repeated rows
    stay, and no column but the text has a part in the score.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = featured(docs, model.lexicon, text, list(keep))
    if model.trees is None:
        scored = rows.withColumn("_score", F.lit(float(model.share)))
    else:
        scored = _margin(model.trees.transform(rows.withColumn("features", array_to_vector("_features"))))
        if model.calibration is None:
            scored = scored.withColumn("_score", vector_to_array("probability")[1])
        else:
            scored = model.calibration.setPredictionCol("_score").transform(scored)
    kept = [F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)]
    clipped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_score")))
    return scored.select(*kept, clipped.alias("score"), (clipped >= 0.5).cast("int").alias("predicted"))
