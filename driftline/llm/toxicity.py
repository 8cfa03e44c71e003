"""Toxicity: linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

Features are hashed byte n-grams of the lower-cased text, present or not. On the training rows each feature
gets the log ratio of its smoothed document frequencies in the two classes; a logistic regression is fitted on
the presences scaled by those ratios, so that n-grams alike in both classes hardly weigh. The model is one
bounded vector; scoring is a map over whole texts without a shuffle.

Training sees at most `train_rows` labelled rows (those of the smallest key hash) and `train_chars` characters
of them, because it runs in one task; scoring covers every row. Texts of more than a hundredth of `train_chars`
come after the others, and the first row of each class is taken whatever its length, so that a long text
never displaces the sample.

Defined cases: a null or empty text has no n-gram and scores the model's prior; rows without a label, or with
a label other than 0 and 1, are not trained on; without a training row of either class there is nothing to tell
apart, and every score is `UNTAUGHT`, below the threshold: a classifier that has learnt nothing rejects nothing;
repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import col, with_package

TRAIN_ROWS = 20_000
TRAIN_CHARS = 64_000_000
NGRAMS = (3, 4, 5, 6)
BITS = 20
THRESHOLD = 0.3
#: Score of every text where no two classes were seen in training.
UNTAUGHT = 0.05
#: Training texts of more than this share of the bound on characters come last.
LONG_SHARE = 100
#: Features in fewer training rows, or with a smaller ratio (log), stay out of the model.
LEAST_ROWS = 3
LEAST_RATIO = 1.0
STEPS = 200
RIDGE = 1e-4


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


class Features:
    """Distinct hashed n-grams of a text; keeps one scratch array per worker."""

    def __init__(self) -> None:
        self.last = np.zeros(1 << BITS, np.int32)

    def of(self, text: str) -> np.ndarray:
        data = np.frombuffer(b" " + " ".join(text.lower().split()).encode() + b" ", np.uint8).astype(np.uint32)
        found, gram = [], np.zeros(len(data), np.uint32)
        for n in range(1, max(NGRAMS) + 1):
            if n > len(data):
                break
            gram = gram[: len(data) - n + 1] * np.uint32(16777619) + data[n - 1 :]
            if n in NGRAMS:
                mixed = (gram ^ np.uint32(n * 2654435761 & 0xFFFFFFFF)) * np.uint32(2246822519)
                mixed ^= mixed >> np.uint32(15)
                mixed *= np.uint32(3266489917)
                found.append(mixed >> np.uint32(32 - BITS))
        if not found or len(data) == 2:
            return np.zeros(0, np.int64)
        at = np.concatenate(found).astype(np.int64)
        turn = np.arange(len(at), dtype=np.int32)
        self.last[at] = turn
        return at[self.last[at] == turn]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        return 1.0 / (1.0 + float(np.exp(-(self.bias + float(self.weights[features].sum(dtype=np.float64))))))


def untaught_bias() -> float:
    return float(np.log(UNTAUGHT / (1 - UNTAUGHT)))


def fit(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature numbers, their weights (ratio times coefficient) and the bias."""
    n, toxic = len(labels), float(labels.sum())
    if not 0 < toxic < n:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), untaught_bias()
    prior = float(np.log((toxic + 1) / (n - toxic + 1)))
    make = Features()
    pos, neg = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for text, y in zip(texts, labels, strict=True):
        (pos if y else neg)[make.of(text)] += 1
    ratio = np.log((pos + 1) / (toxic + 2)) - np.log((neg + 1) / (n - toxic + 2))
    used = (pos + neg >= LEAST_ROWS) & (np.abs(ratio) >= LEAST_RATIO)
    number = np.flatnonzero(used).astype(np.int32)
    place = np.full(1 << BITS, -1, np.int32)
    place[number] = np.arange(len(number), dtype=np.int32)
    # Read again rather than kept: only the used features of a text stay in memory.
    rows = [p[p >= 0] for p in (place[make.of(t)] for t in texts)]
    sizes = [len(r) for r in rows]
    flat = np.concatenate(rows).astype(np.int64)
    del rows
    owner = np.repeat(np.arange(n), sizes)
    values = ratio[number][flat]
    w, bias = _logistic(flat, owner, values, labels.astype(np.float64), len(number), prior)
    return number, (w * ratio[number]).astype(np.float32), bias


def _logistic(flat, owner, values, y, width: int, bias: float) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Adam on whole gradients; deterministic."""
    n = len(y)
    w, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    w[-1] = bias
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, weights=values * w[flat], minlength=n) + w[-1]
        miss = 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35))) - y
        g = np.append(np.bincount(flat, weights=values * miss[owner], minlength=width) / n + RIDGE * w[:-1], miss.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w[:-1], float(w[-1])


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    train_rows: int,
    train_chars: int,
) -> DataFrame:
    """The bounded sample (text, y, turn, id): the first labelled rows by key hash, up to the two bounds."""
    known = labels.where(F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    first = known.select("id", "y", F.xxhash64("id").alias("turn")).orderBy("turn", "id", "y").limit(train_rows)
    texts = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    # at most train_rows small rows: the only table that is sent to every task
    picked = texts.join(F.broadcast(first), "id").withColumn("text_hash", F.xxhash64("text"))
    sized = picked.select("turn", "id", "text_hash", "y", F.length("text").alias("size"))
    sized = sized.withColumn("long", F.col("size") > train_chars // LONG_SHARE)
    order = ["long", "turn", "id", "text_hash"]
    so_far = sized.orderBy(*order).limit(train_rows)
    total = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    in_class = F.row_number().over(Window.partitionBy("y").orderBy(*order))
    taken = so_far.select("id", "text_hash", "y", total.alias("total"), in_class.alias("nth"))
    taken = taken.where((F.col("total") <= train_chars) | (F.col("nth") == 1)).select("id", "text_hash", "y").distinct()
    return picked.join(F.broadcast(taken), ["id", "text_hash", "y"]).select("text", "y", "turn", "id")


_MODEL = "number binary, weight binary, bias double"


def _fit_rows(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: (r["turn"], str(r["id"]), r["text"], r["y"]))
    number, weight, bias = fit([r["text"] for r in rows], np.array([r["y"] for r in rows], np.int64))
    return pa.table({"number": [number.tobytes()], "weight": [weight.tobytes()], "bias": [bias]})


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
    train_chars: int = TRAIN_CHARS,
) -> Model:
    """Fit on the bounded sample in one task; the driver receives the model's vector only."""
    with_package(docs.sparkSession)
    known = labels.select(col(id_col).alias("id"), col(label_col).alias("y"))
    rows = training_rows(docs, known, id_col, text_col, train_rows, train_chars)
    fitted = rows.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_fit_rows, _MODEL).collect()
    weights = np.zeros(1 << BITS, np.float32)
    if not fitted:
        return Model(weights, untaught_bias())
    weights[np.frombuffer(fitted[0]["number"], np.int32)] = np.frombuffer(fitted[0]["weight"], np.float32)
    return Model(weights, fitted[0]["bias"])


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows with `score` and `predicted`, in a struct `toxicity` beside a struct `row` of their columns."""
    spark: SparkSession = docs.sparkSession
    with_package(spark)
    shared = spark.sparkContext.broadcast(model)  # 4 * 2**BITS bytes at any size of input
    rows = docs.select(
        F.struct(*(col(c) for c in docs.columns)).alias("row"), F.coalesce(col(text_col), F.lit("")).alias("text")
    )
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, make = shared.value, Features()
        for batch in batches:
            found = [model.score(make.of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["row", "score"])

    scored = rows.mapInArrow(run, schema)
    verdict = F.struct("score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    return scored.select("row", verdict.alias("toxicity"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, columns as they came."""
    return score(docs, model, text_col).where("toxicity.predicted = 0").select("row.*")
