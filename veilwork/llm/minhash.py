"""Near-duplicate groups by MinHash with tensored banding, verified on whole shingle sets.

Plain banding computes k hashes for each of L tables. Tensoring computes m small collections
of k / 2 minimum hashes and makes a table of every pair of collections: its key is the two
collections' values together. That gives m (m - 1) / 2 tables for m k / 2 hashes, about the
square root of what as many tables cost otherwise. Here 18 collections of 3 hashes make 153
tables of 6 hashes, from 54 hashes instead of 918.

Two sets of Jaccard similarity s agree in a collection with probability q = s^3, and share a
table as soon as two collections agree. So a link is missed with probability
(1 - q)^18 + 18 q (1 - q)^17: 5 in 100,000 links of exactly 0.8, 1.1 in a million of 0.85.

Pairs that agree in many collections share many tables. A pair counts in the table of its
first two agreeing collections only, so each is compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.llm.graph import components
from veilwork.llm.jaccard import _may_link, _meetings, _rows, _sifted, _stars, _verified, bit_sketch, name_of, shingle_sets
from veilwork.llm.textbytes import chunks, mix
from veilwork.session import materialize

COLLECTIONS, HASHES = 18, 3
_ODD = np.uint64(0x9E3779B97F4A7C15)


def miss(similarity: float, collections: int = COLLECTIONS, hashes: int = HASHES) -> float:
    """The probability that two sets of this similarity share no table."""
    q = similarity**hashes
    return (1 - q) ** collections + collections * q * (1 - q) ** (collections - 1)


@lru_cache(maxsize=4)
def _functions(number: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and odd factors of `number` hash functions."""
    seeds = mix(np.arange(1, number + 1, dtype=np.uint64) * _ODD)
    return seeds, mix(seeds + _ODD) | np.uint64(1)


def minimum_hashes(sets: list[np.ndarray], number: int) -> np.ndarray:
    """The least value of every hash function over each set, none of them empty: sets x number."""
    items = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), number), dtype=np.uint64)
    for j, (seed, factor) in enumerate(zip(*_functions(number), strict=True)):
        out[:, j] = np.minimum.reduceat((items ^ seed) * factor, starts)
    return out


def collected(minima: np.ndarray, hashes: int) -> np.ndarray:
    """One value per collection of `hashes` neighbouring minima: sets x collections."""
    out = np.zeros((len(minima), minima.shape[1] // hashes), dtype=np.uint64)
    for j in range(hashes):
        out = mix(out * _ODD + minima[:, j::hashes])
    return out


def table_bits(collections: int) -> int:
    """Lowest bits of a key that have its table's number."""
    return int(collections * (collections - 1) // 2).bit_length()


def tensored(values: np.ndarray) -> np.ndarray:
    """The table keys of every pair of collections: sets x pairs."""
    left, right = np.triu_indices(values.shape[1], 1)
    number = np.arange(len(left), dtype=np.uint64)
    keys = mix(mix(values[:, left] + mix(number * _ODD)) * _ODD + values[:, right])
    return keys >> np.uint64(table_bits(values.shape[1])) << np.uint64(table_bits(values.shape[1])) | number


def _sets(docs: DataFrame, words: int, id_kind: str, collections: int, hashes: int) -> DataFrame:
    """Each row's set: its size, fingerprint, bit sketch and collection values."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part.column(1), words)
                full = [s for s in sets if len(s)]
                values = iter(collected(minimum_hashes(full, collections * hashes), hashes).view(np.int64) if full else ())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([name_of(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([bit_sketch(s) for s in sets], pa.list_(pa.int64())),
                        pa.array([next(values) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "row", "n", "name", "sketch", "collections"],
                )

    kind = f"doc_id {id_kind}, row long, n long, name long, sketch array<long>, collections array<long>"
    return docs.mapInArrow(build, kind)


def _offers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, collections) -> (key, name), one row per table."""
    for batch in batches:
        for at in range(0, len(batch), 512):
            part = batch.slice(at, 512)
            names = part.column(0).to_numpy()
            values = part.column(1).flatten().to_numpy().view(np.uint64).reshape(len(part), -1)
            keys = tensored(values)
            flat = pa.array(keys.ravel().view(np.int64))
            yield pa.RecordBatch.from_arrays([flat, pa.array(np.repeat(names, keys.shape[1]))], ["key", "name"])


def _unjoined(met: DataFrame, found: DataFrame, nodes: DataFrame, percent: int, collections: int) -> DataFrame:
    """Pairs that share a table, lie in different components and may link: distinct (a, b).

    Of the components of a table, members of the largest are not compared with one another's;
    sizes and sketches sift in the join, and a pair comes out at its first table alone.
    """
    member = met.join(found.withColumnRenamed("node", "name"), "name", "left")
    member = member.withColumn("component", F.coalesce("component", "name"))
    sizes = member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    bulk = sizes.groupBy("key").agg(
        F.max(F.struct("size", "component"))["component"].alias("bulk"), F.count(F.lit(1)).alias("parts")
    )
    open_keys = bulk.where("parts > 1").select("key", "bulk").hint("rebalance")
    facts = nodes.select("name", F.struct("n", "sketch", "collections").alias("facts"))
    member = materialize(member.join(open_keys, "key").join(facts, "name"), "members")
    loose = member.where(F.col("component") != F.col("bulk")).select(
        "key", F.col("name").alias("a"), F.col("component").alias("ca"), F.col("facts").alias("fa")
    )
    other = member.select(
        "key", F.col("name").alias("b"), F.col("component").alias("cb"), F.col("facts").alias("fb"),
        (F.col("component") == F.col("bulk")).alias("in_bulk"),
    )
    left, right = (F.array(*map(F.lit, side.tolist())) for side in np.triu_indices(collections, 1))
    table = F.col("key").bitwiseAND(F.lit((1 << table_bits(collections)) - 1)).cast("int")
    agreeing = F.filter(
        F.sequence(F.lit(0), F.lit(collections - 1)),
        lambda i: F.get(F.col("fa.collections"), i) == F.get(F.col("fb.collections"), i),
    )
    first = F.slice(agreeing, 1, 2) == F.array(F.get(left, table).cast("int"), F.get(right, table).cast("int"))
    apart = (F.col("ca") != F.col("cb")) & (F.col("in_bulk") | (F.col("a") < F.col("b")))
    pairs = loose.join(other, "key").where(apart & F.when(_may_link("fa", "fb", percent), first).otherwise(False))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    collections: int = COLLECTIONS,
    hashes: int = HASHES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Documents are linked if they share a table and the Jaccard similarity of their whole sets
    of `words`-word shingles is at least `percent` / 100. component_id is the smallest doc_id
    reachable by links, the own one included, and the row that has it is kept. A text of fewer
    words is one shingle, however long it is. A null or empty text has no shingles, links with
    nothing and is kept. A row with a null id has its component's smallest id; where no row
    has an id, component_id is null and its rows are kept. Repeated rows are in one component
    and are kept or go together. Other columns are left out, whatever their names. No rows
    give no rows.

    Equal sets are one node, offered to the tables once. The sets of a table are first
    compared with one of them, which joins the bulk of a large group in linear work. Where a
    table still has sets of several components, those outside the largest one are compared
    with all that are not in theirs yet. 64-bit fingerprints stand for sets and shingles.
    """
    rows = _rows(docs, id_col, text_col)
    known = materialize(_sets(rows, words, rows.schema["doc_id"].dataType.simpleString(), collections, hashes), "sets")
    first = [F.first(c).alias(c) for c in ("n", "sketch", "collections")]
    nodes = materialize(known.where("n > 0").groupBy("name").agg(F.min("row").alias("row"), *first), "nodes")
    offers = nodes.select("name", "collections").mapInArrow(_offers, "key long, name long")
    offers = offers.repartition("key").sortWithinPartitions("key", "name")
    met = materialize(offers.mapInArrow(_meetings, "key long, name long"), "tables")

    stars = materialize(_stars(met), "stars")
    links = materialize(_verified(rows, _sifted(stars, nodes, percent), nodes, words, percent), "links")
    found = materialize(components(links), "components")
    rest = materialize(_unjoined(met, found, nodes, percent, collections).join(stars, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        more = _verified(rows, rest, nodes, words, percent)
        found = materialize(components(links.unionByName(more)), "components")

    member = known.select("doc_id", "n", "name").join(found.withColumnRenamed("node", "name"), "name", "left")
    member = member.withColumn("component", F.coalesce("component", "name"))
    least = member.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least")).hint("rebalance")
    placed = member.join(least, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return placed.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
