"""All pairs of the rows of a key, dealt out in cells of bounded size.

The rows of a key lie in blocks, by a hash of their name. A cell has two blocks of a key, or
one alone, and goes to one task; so a key with many rows is many cells, and a row travels as
often as its key has blocks instead of once for each of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = 1 << 11  # rows of a block, about


def blocks_of(rows: Column, most: int = ROWS) -> Column:
    """The number of blocks of a key with so many rows."""
    return F.ceil(rows / most).cast("int")


def dealt(rows: DataFrame, key: str, name: str, blocks: str) -> DataFrame:
    """(key, cell, alone, first, ...): each row in all cells of its block, sorted by cell.

    alone: the cell has one block; first: of two, the row's block is the first one.
    """
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(name)), F.col(blocks)).cast("int")
    rest = [c for c in rows.columns if c not in (key, blocks)]
    rows = rows.select(key, *rest, F.col(blocks).alias("_blocks"), own.alias("_own"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
    rows = rows.select(
        key,
        (F.least("_own", "_other").cast("long") * F.col("_blocks") + F.greatest("_own", "_other")).alias("cell"),
        (F.col("_own") == F.col("_other")).alias("alone"),
        (F.col("_own") < F.col("_other")).alias("first"),
        *rest,
    )
    return rows.repartition(key, "cell").sortWithinPartitions(key, "cell")


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of `dealt` with all of each cell, and the bounds of the cells."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.concat_batches([held, batch]) if held is not None and len(held) else batch
        bounds = _bounds(rows)
        if len(bounds) > 2:
            yield rows.slice(0, bounds[-2]), bounds[:-1]
        held = rows.slice(bounds[-2])
    if held is not None:
        yield held, _bounds(held)


def _bounds(rows: pa.RecordBatch) -> np.ndarray:
    key, cell = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    return np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1, [len(key)]])


def pairs_within(begin: np.ndarray, end: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers (left, right) of the pairs of rows of each cell, left before right, about `most` at a time."""
    sizes = end - begin
    row = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    more = np.repeat(end, sizes) - row - 1
    total = np.cumsum(more)
    at = 0
    while at < len(row):
        stop = max(at + 1, int(np.searchsorted(total, total[at] - more[at] + most, side="right")))
        left = np.repeat(row[at:stop], more[at:stop])
        before = np.cumsum(more[at:stop]) - more[at:stop]
        yield left, left + 1 + np.arange(len(left)) - np.repeat(before, more[at:stop])
        at = stop
