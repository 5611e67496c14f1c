"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

If a passage of m characters occurs in a text with at most e edits, the two share at least
m - q + 1 - q e q-grams, all on e + 1 neighbouring diagonals (place in the text less place
in the passage). The shared q-grams of a text are counted in overlapping bands of diagonals;
bands that reach the bound are aligned.

Texts and items are compared in normal form: lower-cased, runs of ASCII characters that are
neither letters nor digits as one space. Characters are UTF-8 bytes here.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.llm.licenses import NOT_WORD
from veilwork.llm.textbytes import Texts, as_texts, chunks

Q = 8  # bytes of a q-gram: one 64-bit word
EDITS = 0.08  # edits allowed, as a part of a passage's length
PASSAGE, STEP = 120, 60  # items longer than PASSAGE + STEP are compared in overlapping passages
LEAST = 32  # items that are shorter in normal form are no evidence and never match
BLOCK_BYTES = 16 << 20  # benchmark text that one pass over the documents looks for
FILTER_BITS = 22


def normal(column: pa.Array) -> Texts:
    """Texts in normal form, each with one space before and after."""
    texts = as_texts(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
    # A space around each text keeps words at its ends whole.
    at = np.repeat(texts.starts, 2)[1:-1] if len(texts) else texts.starts[:0]
    data = np.insert(texts.data, at, 0x20)
    starts = texts.starts + 2 * np.arange(len(texts) + 1)
    data = np.where(NOT_WORD[data], np.uint8(0x20), data)
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    keep[starts[:-1]] = True
    return Texts(data[keep], np.concatenate([[0], np.cumsum(keep)])[starts])


def grams_at(data: np.ndarray) -> np.ndarray:
    """The Q bytes from every place, as a number; Q - 1 places fewer than bytes."""
    if len(data) < Q:
        return np.zeros(0, dtype=np.uint64)
    out = data.astype(np.uint64)
    for step in (1, 2, 4):
        out = out[:-step] | (out[step:] << np.uint64(8 * step))
    return out


def _slot(grams: np.ndarray) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


class Passages:
    """All passages of some items, with an index from q-gram to (passage, place)."""

    def __init__(self, items: list[tuple[object, str]], edits: float):
        self.items = [i for i, _ in items]
        self.text: list[np.ndarray] = []
        self.item: list[int] = []
        form = normal(pa.array([t for _, t in items], pa.large_string()))
        for i in range(len(items)):
            whole = form.data[form.starts[i] : form.starts[i + 1]]
            whole = whole[1:-1] if len(whole) > 2 else whole[:0]
            if len(whole) < LEAST:
                continue
            cuts = [0]
            if len(whole) > PASSAGE + STEP:
                cuts = [*range(0, len(whole) - PASSAGE, STEP), len(whole) - PASSAGE]
            for a in cuts:
                self.text.append(whole[a : a + PASSAGE] if len(cuts) > 1 else whole)
                self.item.append(i)
        self.size = np.array([len(t) for t in self.text], dtype=np.int64)
        self.budget = np.floor(self.size * edits + 1e-9).astype(np.int64)
        self.bound = np.maximum(1, self.size - Q + 1 - Q * self.budget)
        grams = [grams_at(t) for t in self.text]
        gram = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
        passage = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, dtype=np.int64)
        order = np.argsort(gram, kind="stable")
        self.passage, self.place = passage[order], place[order]
        self.gram, self.first = np.unique(gram[order], return_index=True)
        self.last = np.append(self.first[1:], len(gram))

    def filter(self) -> np.ndarray:
        table = np.zeros(1 << FILTER_BITS, dtype=bool)
        table[_slot(self.gram)] = True
        return table


def candidates(form: Texts, known: Passages, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, passage, first bin) of bands whose shared q-grams reach the bound.

    Diagonals are shifted by the passage's size, so that they are not negative. A bin has
    e + 1 diagonals; a band is a bin with the next one, so any e + 1 diagonals lie in a band.
    """
    none = np.zeros(0, dtype=np.int64)
    grams = grams_at(form.data)
    if not len(grams) or not len(known.gram):
        return none, none, none
    at = np.flatnonzero(table[_slot(grams)])
    slot = np.minimum(np.searchsorted(known.gram, grams[at]), len(known.gram) - 1)
    hit = known.gram[slot] == grams[at]
    at, slot = at[hit], slot[hit]
    text = np.searchsorted(form.starts, at, side="right") - 1
    inside = at + Q <= form.starts[text + 1]
    at, slot, text = at[inside], slot[inside], text[inside]
    times = known.last[slot] - known.first[slot]
    entry = np.repeat(known.first[slot] - np.cumsum(times) + times, times) + np.arange(times.sum())
    passage, owner = known.passage[entry], np.repeat(text, times)
    diagonal = np.repeat(at - form.starts[text], times) - known.place[entry] + known.size[passage]
    bins = diagonal // (known.budget[passage] + 1)
    # Columns of their own: text, passage and bin do not fit one 64-bit key at any size.
    order = np.lexsort((bins, passage, owner))
    owner, passage, bins = owner[order], passage[order], bins[order]
    new = (owner[1:] != owner[:-1]) | (passage[1:] != passage[:-1])
    first = np.flatnonzero(np.concatenate([[True], new | (bins[1:] != bins[:-1])])[: len(bins)])
    count = np.diff(np.append(first, len(bins)))
    owner, passage, bins = owner[first], passage[first], bins[first]
    follows = np.append((owner[1:] == owner[:-1]) & (passage[1:] == passage[:-1]) & (bins[1:] == bins[:-1] + 1), False)
    both = count + np.where(follows[: len(count)], np.append(count[1:], 0)[: len(count)], 0)
    good = both >= known.bound[passage]
    return owner[good], passage[good], bins[good]


def align(passage: np.ndarray, regions: np.ndarray, width: int) -> np.ndarray:
    """Least edits of the whole passage against any part of each region, in one band.

    regions: one row each, `width` - 1 longer than the passage; cell k of row i of the table
    is the cost of the first i characters ending at place i + k of the region. Places beyond
    a text hold 0, which no text has.
    """
    steps = np.arange(width)
    row = np.zeros((len(regions), width), dtype=np.int32)
    for i, c in enumerate(passage):
        other = regions[:, i : i + width] != c
        best = row + other
        best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(best - steps, axis=1) + steps
    return row.min(axis=1)


def leaks(column: pa.Array, known: Passages, table: np.ndarray) -> list[dict[int, list[tuple[int, int]]]]:
    """For every text: item number -> (passage, edits) of the passages found."""
    form = normal(column)
    found: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(len(column))]
    text, passage, bins = candidates(form, known, table)
    for p in np.unique(passage).tolist():
        own = passage == p
        size, budget = int(known.size[p]), int(known.budget[p])
        owner = text[own]
        # The band's diagonals, and as many on either side as edits may move to.
        start = bins[own] * (budget + 1) - size - budget
        width = 2 * (budget + 1) + 2 * budget + 1
        place = start[:, None] + np.arange(size + width - 1)
        length = form.starts[owner + 1] - form.starts[owner]
        inside = (place >= 0) & (place < length[:, None])
        regions = np.where(inside, form.data[np.where(inside, place + form.starts[owner][:, None], 0)], 0)
        edits = align(known.text[p], regions, width)
        for t, e in zip(owner.tolist(), edits.tolist(), strict=True):
            if e <= budget:
                hits = found[t].setdefault(known.item[p], [])
                if hits and hits[-1][0] == p:
                    hits[-1] = (p, min(e, hits[-1][1]))
                else:
                    hits.append((p, e))
    return found


def _blocks_of(benchmark: DataFrame, id_col: str, text_col: str, edits: float) -> Iterator[Passages]:
    """The benchmark in blocks of bounded size."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull()
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(1, math.ceil(total / BLOCK_BYTES))
    for b in range(number):
        own = items if number == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(number)) == b)
        yield Passages(sorted((r["id"], r["text"]) for r in own.collect()), edits)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    edits: float = EDITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Benchmark items in whole texts: (doc_id, item_id, passages, found, edits, passage).

    One row per input row and item: how many passages the item has, how many were found with
    at most `edits` times their length in edits, the fewest edits of one and that passage in
    normal form. An item of more than 180 bytes is compared in overlapping passages of 120,
    so that a part of it counts. Null or empty texts have none, and null items, items with a
    null id and items of less than 32 bytes in normal form are not looked for.

    The documents are read once per 16 MB of benchmark text, whose index goes to every
    executor; there is no shuffle. Repeated rows and items are reported each.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, passages int, found int, edits int, passage string"
    out = None
    for known in _blocks_of(benchmark, item_col, item_text_col, edits):
        part = _scan(rows, known, schema)
        out = part if out is None else out.unionByName(part)
    return out


def _scan(rows: DataFrame, known: Passages, schema: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        table, of_item = known.filter(), np.bincount(known.item, minlength=len(known.items))
        for batch in batches:
            for part in chunks(batch):
                found = leaks(part.column(1), known, table)
                hits = [(i, item, h, min(h, key=lambda x: (x[1], x[0]))) for i, f in enumerate(found) for item, h in sorted(f.items())]
                if hits:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": part.column(0).take(pa.array([h[0] for h in hits])),
                            "item_id": pa.array([known.items[h[1]] for h in hits]),
                            "passages": pa.array([int(of_item[h[1]]) for h in hits], pa.int32()),
                            "found": pa.array([len(h[2]) for h in hits], pa.int32()),
                            "edits": pa.array([h[3][1] for h in hits], pa.int32()),
                            "passage": [known.text[h[3][0]].tobytes().decode(errors="replace") for h in hits],
                        }
                    )

    return rows.mapInArrow(scan, schema)


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    edits: float = EDITS,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` in which `find_leaks` finds nothing, with all their columns."""
    names = docs.columns
    for known in _blocks_of(benchmark, item_col, item_text_col, edits):
        shared = docs.sparkSession.sparkContext.broadcast(known)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            table = known.filter()
            for batch in batches:
                for part in chunks(batch, text_col):
                    found = leaks(part.column(names.index(text_col)), known, table)
                    yield part.filter(pa.array([not f for f in found], pa.bool_()))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs
