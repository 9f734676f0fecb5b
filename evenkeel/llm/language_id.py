"""Language identification by sparse multinomial logistic regression.

Features are hashed character 1- to 3-grams of the whole text in lower case,
weighted by TF-IDF.  Document frequencies count every labelled document.  The
weights are learned on a bounded sample of each language, by
follow-the-regularised-leader with elastic-net penalties, in shards whose
weights are averaged, and the probabilities are calibrated by a temperature
fitted to documents of the sample that no shard has seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import column, each_utf8, fresh, tidy

#: Hashed features, as a power of two.
FEATURE_BITS = 15
#: The sample: so many documents of a language at most, of so many languages (those with most documents).
DOCUMENTS_PER_LANGUAGE, LANGUAGES = 1000, 256
UNKNOWN = "und"

_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text and how often each stands in it."""
    cp = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    two = cp[:-1] * _MIX[0] + cp[1:]
    three = two[:-1] * _MIX[0] + cp[2:]
    shift = np.uint32(32 - FEATURE_BITS)
    grams = np.concatenate([(g * m ^ (g * m >> np.uint32(15))) * _MIX[1] >> shift for g, m in zip((cp, two, three), _MIX, strict=True)])
    counts = np.bincount(grams, minlength=1 << FEATURE_BITS)
    held = np.flatnonzero(counts)
    return held, counts[held]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray  # float32, a number for each feature
    weights: np.ndarray  # float32, features x languages; the last row is the bias
    temperature: float = 1.0

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        held, counts = features(text)
        x = (1 + np.log(counts)) * self.idf[held]
        length = np.sqrt(x @ x)
        return np.append(held, len(self.idf)), np.append(x / length if length else x, 1.0)

    def logits(self, text: str) -> np.ndarray:
        held, x = self.vector(text)
        return x @ self.weights[held]

    def best(self, text: str) -> tuple[str, float]:
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        i = int(p.argmax())
        return self.languages[i], float(p[i] / p.sum())


def _decoded(batch: pa.Array) -> Iterator[str]:
    return (t.decode("utf-8", "replace") for t in each_utf8(batch))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(1 << FEATURE_BITS, np.int64), 0
    for batch in batches:
        for text in _decoded(batch.column(0)):
            seen[features(text)[0]] += 1
            n += 1
    held = np.flatnonzero(seen)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1), pa.int64()), pa.array(np.append(seen[held], n), pa.int64())], ["feature", "n"]
        )


def ftrl(
    model: Model, texts: list[str], labels: np.ndarray, *, epochs: int, alpha: float, beta: float, l1: float, l2: float
) -> np.ndarray:
    """Weights by follow-the-regularised-leader over the documents in their order, ``epochs`` times."""
    n_features, n_classes = len(model.idf) + 1, len(model.languages)
    z, n = np.zeros((n_features, n_classes)), np.zeros((n_features, n_classes))
    vectors = [model.vector(t) for t in texts]

    def weights(rows):
        shrunk = np.maximum(np.abs(z[rows]) - l1, 0)
        return -np.sign(z[rows]) * shrunk / ((beta + np.sqrt(n[rows])) / alpha + l2)

    for _ in range(epochs):
        for (held, x), label in zip(vectors, labels, strict=True):
            w = weights(held)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[label] -= 1
            g = x[:, None] * p
            more = n[held] + g * g
            z[held] += g - (np.sqrt(more) - np.sqrt(n[held])) / alpha * w
            n[held] = more
    return weights(slice(None))


def _share(*key: Column) -> Column:
    """A number from 0 to 1 that hangs on the key alone."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / float(1 << 30)


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, per_language: int = DOCUMENTS_PER_LANGUAGE,
    most_languages: int = LANGUAGES, shards: int = 4, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0,
    l1: float = 0.002, l2: float = 0.001,
) -> Model | None:
    """A model of the languages in ``lang_col``; None without a labelled text.

    Document frequencies are over all labelled texts.  The weights are learned
    on at most ``per_language`` documents of each of ``most_languages``
    languages, chosen by a hash of the text: ``per_language * most_languages``
    documents at most, whatever the size of the table, a fifth of them for the
    calibration.  The model has at most ``2**15 + 1`` weights a language.
    """
    spark = docs.sparkSession
    labelled = docs.select(column(text_col).cast("string").alias("text"), column(lang_col).cast("string").alias("lang"))
    labelled = labelled.filter("text is not null and lang is not null")
    counted = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    if not counted:
        return None
    languages = sorted(r["lang"] for r in counted)
    frequency = dict(
        labelled.select("text").mapInArrow(tidy(_document_frequencies), "feature long, n long")
        .groupBy("feature").agg(F.sum("n")).collect()  # a row for each feature
    )
    total = frequency.pop(-1)
    df = np.zeros(1 << FEATURE_BITS)
    df[list(frequency)] = list(frequency.values())
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    # Rather more than the bound by hash, then the bound; the sort sees no more than that.
    wanted = spark.createDataFrame(
        [(r["lang"], 1.2 * per_language / r["count"] + 50 / r["count"]) for r in counted], "lang string, share double"
    )
    some = labelled.join(F.broadcast(wanted), "lang").withColumn("order", _share(F.col("text"), F.lit("order")))
    order = Window.partitionBy("lang").orderBy("order", "text")
    sample = (
        some.filter("order < share").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_language)
        .select("text", "lang", "order", F.when(_share(F.col("text"), F.lit("use")) < 0.2, -1)
                .otherwise(F.pmod(F.xxhash64("text"), F.lit(shards))).cast("int").alias("shard"))
    )
    number = {x: i for i, x in enumerate(languages)}
    untrained = Model(languages, idf, np.zeros((len(idf) + 1, len(languages)), np.float32))
    shipped = spark.sparkContext.broadcast(untrained)

    def learn(table: pa.Table) -> pa.Table:
        rows = table.sort_by("order")
        labels = np.array([number[x] for x in rows["lang"].to_pylist()])
        w = ftrl(
            shipped.value, rows["text"].to_pylist(), labels, epochs=epochs, alpha=alpha, beta=beta, l1=l1, l2=l2
        )
        feature, language = np.nonzero(w)
        return pa.table({"feature": feature, "language": language, "w": w[feature, language]})

    learned = (
        sample.filter("shard >= 0").groupBy("shard").applyInArrow(learn, "feature long, language long, w double")
        .groupBy("feature", "language").agg((F.sum("w") / shards).alias("w")).toPandas()  # features x languages at most
    )
    weights = np.zeros_like(untrained.weights)
    weights[learned["feature"], learned["language"]] = learned["w"]
    model = Model(languages, idf, weights)
    model.temperature = _temperature(model, sample.filter("shard < 0"))
    return model


def _temperature(model: Model, unseen: DataFrame) -> float:
    """The temperature under which the unseen documents of the sample are most likely.

    As if each language had one more document, spread over all of them: else
    the temperature would go to nothing where all are recognised.
    """
    shipped = unseen.sparkSession.sparkContext.broadcast(model)

    def logits(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([shipped.value.logits(t).tolist() for t in _decoded(batch.column(0))], pa.list_(pa.float64()))],
                ["lang", "z"],
            )

    rows = unseen.select("text", "lang").mapInArrow(logits, "lang string, z array<double>").collect()  # part of the sample
    if not rows:
        return 1.0
    z = np.array([r["z"] for r in rows])
    right = np.array([model.languages.index(r["lang"]) for r in rows])

    target = np.full(z.shape, 1 / (len(z) + z.shape[1]))
    target[np.arange(len(z)), right] += len(z) / (len(z) + z.shape[1])

    def loss(t):
        s = z / t
        top = s.max(axis=1)
        return (top + np.log(np.exp(s - top[:, None]).sum(axis=1)) - (target * s).sum(axis=1) / target.sum(axis=1)).mean()

    return float(min(np.geomspace(0.02, 20, 121), key=loss))


def predicted(model: Model | None, docs: DataFrame, text_col: str = "text") -> Column:
    """A struct (lang_pred, score) for each text of ``docs``: see ``identify``."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def best(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [shipped.value.best(t) for t in _decoded(batch)]
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["lang_pred", "score"],
            )

    text = column(text_col).cast("string")
    found = F.arrow_udf(tidy(best), "lang_pred string, score double")(text)
    # In a struct, so that Python runs once for both fields.
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return F.struct(
        F.when(lettered, found["lang_pred"]).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(lettered, found["score"]).otherwise(0.0).alias("score"),
    )


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", *, out: str = "language") -> DataFrame:
    """``docs`` with a struct ``out`` (lang_pred, score) added; the name is lengthened where a column has it.

    ``score`` is the calibrated probability of ``lang_pred``, which is a
    language of the model, or ``und`` with score 0 for a null text, a text
    without a letter, or without a model.  Only the text counts.  Every row of
    ``docs``, repeated ones and rows with nulls too, stays as it is.
    """
    return docs.withColumn(fresh(docs, out), predicted(model, docs, text_col))
