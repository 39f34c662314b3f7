"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its character n-grams, which stay
within words and their edges and are hashed into a fixed table. Embeddings and
softmax are trained by stochastic gradient descent in numpy on a bounded sample
of labelled texts; part of the sample is held back to set the temperature of the
scores and the bounds of rejection. A document is rejected by its score or by its
evidence, the mean log share of its n-grams in the learned texts, whatever the
number of languages. As all is linear, tasks carry one table of n-gram logits.

Edge cases: a null text and one without letters are ``und`` with score 0; so is
everything where no row is labelled. Where there are too few labelled rows to hold
some back, only what is below chance is rejected. Only the text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pixelframe.llm.common import fingerprint, hinted, load, put_back, set_aside, store
from pixelframe.llm.registry import query
from pixelframe.llm.tokens import list_column, text_chunks

UNKNOWN = "und"
SIZES = (2, 3, 4)
BUCKETS, DIMENSIONS = 1 << 15, 16
#: About so many distinct labelled texts of each language are sampled for the fit.
ROWS_PER_LANGUAGE = 500
EPOCHS, RATE = 12, 0.5
#: Share of the sample that sets temperature and rejection, and of it that may be rejected.
HELD_BACK, REJECTED = 0.25, 0.0005


class Model(NamedTuple):
    languages: list[str]
    #: Logits, before temperature, of each bucket and language.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    #: Scores below are rejected.
    threshold: float
    #: Log share, in the learned texts, of each bucket, and the mean below which a text is rejected.
    familiar: np.ndarray
    least_familiar: float


def letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngrams(texts: list[str], letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of all n-grams, once per size."""
    joined = "\0".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(joined, np.uint32)
    document = np.cumsum(points == 0, dtype=np.int32) - 1
    letter = letters[points]
    c = np.where(letter, points, np.uint32(32))
    for n in SIZES:
        count = len(c) - n + 1
        if count <= 0:
            continue
        value = np.zeros(count, np.uint32)
        valid = letter[:count] | letter[n - 1 :]
        for k in range(n):
            value = (value + c[k : k + count]) * np.uint32(2654435761)
            if 0 < k < n - 1:
                valid &= letter[k : k + count]
        valid = np.flatnonzero(valid)
        value = value[valid] ^ (value[valid] >> np.uint32(15))
        bucket = (value * np.uint32(0x85EBCA6B + 2 * n)) >> np.uint32(32 - (BUCKETS.bit_length() - 1))
        yield document[valid + (n > 2)], bucket


def lowered(data: np.ndarray, limits: np.ndarray) -> list[str]:
    """Small letters; the character that parts texts becomes a space."""
    raw = data.tobytes()
    return [
        raw[a:b].decode("utf-8", "replace").lower().replace("\0", " ")
        for a, b in zip(limits, limits[1:], strict=False)
    ]


def text_bags(docs: DataFrame, *carried: str) -> DataFrame:
    """``carried`` with the distinct n-gram buckets of whole texts and their shares."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            for row, to, data, limits in text_chunks(batch, "text"):
                n = to - row
                flat = [d.astype(np.int64) * BUCKETS + b for d, b in ngrams(lowered(data, limits), letters)]
                value, count = np.unique(np.concatenate(flat), return_counts=True)
                document, bucket = value // BUCKETS, value % BUCKETS
                total = np.bincount(document, weights=count, minlength=n)
                per = np.bincount(document, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(row, n) for c in carried),
                        list_column(bucket.astype(np.int32), per, pa.int32()),
                        list_column((count / total[document]).astype(np.float32), per, pa.float32()),
                    ],
                    [*carried, "buckets", "shares"],
                )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    return docs.select(*carried, "text").mapInArrow(rows, f"{kinds}, buckets array<int>, shares array<float>")


def labelled_sample(docs: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """About ``rows`` distinct texts of each language, chosen by a hash of the text; the bound of the fit.

    Copies of a text are chosen together and then become one, so a text that
    makes up much of the corpus does not fill the sample.
    """
    labelled = docs.where("lang is not null and text is not null").select("lang", "text")
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct(fingerprint("text"), 0.02).alias("count"))
    counts = store(counts, "language-counts")
    drawn = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.join(hinted(counts, 64), "lang").where(drawn < F.lit(float(rows)) / F.col("count"))
    first = chosen.groupBy("lang", fingerprint("text").alias("print")).agg(F.min("text").alias("text"))
    return first.select("lang", "text")


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _part(rng: np.random.Generator, buckets: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Now and then only a few n-grams of a text, so that short texts are learned as well."""
    if rng.random() < 0.5 or len(buckets) < 8:
        return buckets, shares
    few = rng.choice(len(buckets), rng.integers(6, min(len(buckets), 120)), replace=False)
    return buckets[few], shares[few] / shares[few].sum()


def fit(docs: DataFrame, rows: int = ROWS_PER_LANGUAGE, seed: int = 0) -> Model | None:
    """Train on the labelled rows of ``docs``; None where there are none."""
    sample = text_bags(labelled_sample(docs, rows).select("lang", "text"), "lang").toArrow()
    sample = sample.combine_chunks()
    names = sample["lang"].to_pylist()
    order = sorted(range(len(names)), key=lambda i: (names[i], sample["buckets"][i].values.to_numpy().tobytes()))
    bags = [(sample["buckets"][i].values.to_numpy(), sample["shares"][i].values.to_numpy()) for i in order]
    names = [names[i] for i in order]
    keep = [i for i, b in enumerate(bags) if len(b[0])]
    if not keep:
        return None
    languages = sorted({names[i] for i in keep})
    rng = np.random.default_rng(seed)
    keep = rng.permutation(keep)
    back = max(1, int(len(keep) * HELD_BACK)) if len(keep) > 3 * len(languages) else 0
    learn, check = keep[back:], keep[:back] if back else keep
    target = {name: k for k, name in enumerate(languages)}
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps = EPOCHS * len(learn)
    for step in range(steps):
        i = learn[step % len(learn)] if step >= len(learn) else learn[step]
        if step % len(learn) == 0:
            learn = rng.permutation(learn)
        buckets, shares = _part(rng, *bags[i])
        mean = shares @ embeddings[buckets]
        error = _softmax(mean @ weights + bias)
        error[target[names[i]]] -= 1
        rate = np.float32(RATE * (1 - step / steps))
        back_mean = weights @ error
        weights -= rate * np.outer(mean, error)
        bias -= rate * np.float32(0.01) * error
        # an average spreads its gradient thin; the rows are moved by their share, scaled up
        embeddings[buckets] -= np.outer(rate * np.minimum(1, shares * len(shares)), back_mean)
    # n-grams that no sampled text holds say nothing, so foreign texts score near the uniform
    mass = np.zeros(BUCKETS)
    for i in learn:
        mass[bags[i][0]] += bags[i][1]
    table = np.where(mass[:, None] > 0, embeddings @ weights, 0)
    familiar = np.log((mass + 1 / BUCKETS) / (len(learn) + 1))
    parts = [bags[i] for i in check]
    logits = np.array([s @ table[b] + bias for b, s in parts])
    truth = np.array([target[names[i]] for i in check])
    grid = np.geomspace(0.25, 8, 40)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    scores = _softmax(logits / temperature).max(axis=1)
    evidence = np.array([s @ familiar[b] for b, s in parts])

    def bound(chance: float, known: np.ndarray) -> float:
        """Halfway from what an unlearned text has by chance to what nearly all held-back texts reach."""
        return float((chance + np.quantile(known, REJECTED)) / 2 if back else chance)

    threshold, least = bound(1 / len(languages), scores), bound(familiar.mean(), evidence)
    return Model(languages, table.astype(np.float32), bias, temperature, threshold, familiar.astype(np.float32), least)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``, from whole texts alone.

    ``rejected`` tells that a text has no language or that one of the model's
    bounds rules it out. Columns that already have these names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    names = model.languages if model else []

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            for row, to, data, limits in text_chunks(batch, "text"):
                n = to - row
                best, score, rejected = np.full(n, -1), np.zeros(n), np.ones(n, bool)
                if names:
                    total, count, evidence = np.zeros((n, len(names))), np.zeros(n), np.zeros(n)
                    for document, bucket in ngrams(lowered(data, limits), letters):
                        count += np.bincount(document, minlength=n)
                        evidence += np.bincount(document, model.familiar[bucket], n)
                        for k in range(len(names)):
                            total[:, k] += np.bincount(document, model.table[:, k][bucket], n)
                    some = count > 0
                    logits = total[some] / count[some, None] + model.bias
                    chance = _softmax(logits / model.temperature)
                    best[some], score[some] = chance.argmax(axis=1), chance.max(axis=1)
                    rejected[some] = (score[some] < model.threshold) | (evidence[some] / count[some] < model.least_familiar)
                lang = [names[b] if b >= 0 else UNKNOWN for b in best]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(row, n) for c in batch.columns), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                    [*batch.schema.names, "lang_pred", "score", "rejected"],
                )

    kinds = StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(rows, kinds)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def fit_rows(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from."""
    return docs.where(F.coalesce(~held_out(), F.lit(True))).select("text", "lang")


def keep_recognised(docs: DataFrame) -> DataFrame:
    """``docs`` without those that have no language or that a bound of the model rejects."""
    own = set_aside(docs, ["doc_id", "text", "lang"])
    model = fit(fit_rows(own))
    if model is None:
        return docs
    return put_back(predict(own, model).where("not rejected"), docs, own)


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    split = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return predict(split, fit(fit_rows(docs))).select("doc_id", "held_out", "lang_pred", "score", "rejected")
