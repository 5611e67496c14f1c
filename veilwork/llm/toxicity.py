"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.llm.textbytes import Words, as_texts, chunks, grams

SAMPLE_ROWS = 20_000  # labelled rows at most that the classifier is fitted on


@dataclass(frozen=True)
class Settings:
    """alpha, beta: per-coordinate learning rate; l1, l2: penalties; bits: size of the hash space."""

    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    bits: int = 22
    epochs: int = 4
    cut: float = 0.7


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every word, pair of neighbours and pair with one word between.

    Words are hashed whole and lower-cased; repeats within a text are kept.
    """
    words = Words(as_texts(column))
    owner = words.owner()
    owners, values = [owner], [words.hashes]
    for step in (1, 2):
        pairs = grams(words.hashes, 2, step)
        same = owner[: len(pairs)] == owner[len(owner) - len(pairs) :]
        owners.append(owner[: len(pairs)][same])
        values.append(pairs[same])
    return np.concatenate(owners), (np.concatenate(values) >> np.uint64(64 - bits)).astype(np.int64)


def _distinct(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of every text once, and where each text's begin."""
    owner, value = features(column, bits)
    both = np.unique((owner << bits) | value)
    return both & ((1 << bits) - 1), np.searchsorted(both >> bits, np.arange(len(column) + 1))


class Ftrl:
    """Per-coordinate FTRL-proximal state for binary features, with a bias at the last place."""

    def __init__(self, s: Settings):
        self.s = s
        self.z = np.zeros((1 << s.bits) + 1)
        self.n = np.zeros((1 << s.bits) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, s = self.z[at], self.s
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0.0)
        return -shrunk / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2)

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        rate = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / self.s.alpha
        self.z[at] += gradient - rate * w
        self.n[at] = n + gradient * gradient


def _fit(rows: pa.Table, s: Settings) -> pa.Table:
    order = np.argsort(rows.column("draw").to_numpy(), kind="stable")
    labels = rows.column("label").to_numpy()[order].astype(float)
    found = [
        np.append(np.frombuffer(x, dtype=np.int32), 1 << s.bits)
        for x in rows.column("features").take(pa.array(order)).to_pylist()
    ]
    model = Ftrl(s)
    for _ in range(s.epochs):
        for at, label in zip(found, labels, strict=True):
            model.learn(at, label)
    used = np.flatnonzero(model.n)
    weights = model.weights(used)
    used, weights = used[weights != 0], weights[weights != 0]
    return pa.table({"feature": pa.array(used, pa.int64()), "weight": pa.array(weights, pa.float64())})


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    settings: Settings = Settings(),
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> dict[int, float]:
    """The sparse weights by feature, learned from at most `sample_rows` labelled rows.

    The rows with the smallest hashed ids are the sample, so it is the same in every run and
    can be broadcast: a row is an id and a label. Whole texts become feature sets where they
    are read; the sequential passes run in one task over the sample alone. Labels that are
    neither 0 nor 1, ids without a text and null ids are not learned from; with no rows at
    all there are no weights. An id labelled twice counts twice.
    """
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("_id").isNotNull() & F.col("label").isin(0, 1))
        .withColumn("draw", F.xxhash64(F.lit(7), "_id"))
        .orderBy("draw", "label")
        .limit(sample_rows)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    rows = rows.join(F.broadcast(chosen), "_id").select("draw", "label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                value, first = _distinct(part.column(2), settings.bits)
                sets = [value[a:b].astype(np.int32).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sets, pa.binary()), pa.array(np.zeros(len(sets), np.int32))],
                    ["draw", "label", "features", "sample"],
                )

    sets = rows.mapInArrow(extract, "draw long, label int, features binary, sample int")
    fitted = sets.groupBy("sample").applyInArrow(lambda t: _fit(t, settings), "feature long, weight double")
    return {r["feature"]: r["weight"] for r in fitted.toLocalIterator()}


def score(
    docs: DataFrame,
    weights: dict[int, float],
    settings: Settings = Settings(),
    text_col: str = "text",
    column: str = "score",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns in `keep` (all, if None) and the score, 0 to 1, of each whole text.

    The weights are at most 2^bits numbers, one float each, and go to every executor once. A
    null or empty text has the score of the bias alone. No shuffle.
    """
    table = np.zeros((1 << settings.bits) + 1, dtype=np.float32)
    table[np.fromiter(weights.keys(), dtype=np.int64, count=len(weights))] = list(weights.values())
    used = np.flatnonzero(table)
    shared = docs.sparkSession.sparkContext.broadcast((used, table[used]))
    names = docs.columns
    kept = [c for c in (names if keep is None else keep) if c != column]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(column, T.DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros((1 << settings.bits) + 1, dtype=np.float32)
        at, values = shared.value
        full[at] = values
        for batch in batches:
            for part in chunks(batch, text_col):
                texts = part.column(names.index(text_col))
                owner, value = features(texts, settings.bits)
                weight = full[value]
                hit = np.flatnonzero(weight)
                # A feature counts once in a text.
                pairs = np.unique((owner[hit] << settings.bits) | value[hit])
                total = np.bincount(
                    pairs >> settings.bits, full[pairs & ((1 << settings.bits) - 1)], minlength=len(part)
                )
                chance = 1.0 / (1.0 + np.exp(-np.clip(total + full[-1], -35, 35)))
                columns = [part.column(names.index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(chance, pa.float64())], [*kept, column])

    return docs.mapInArrow(apply, schema)


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus
