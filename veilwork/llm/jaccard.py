"""Similarity join on word shingles by parity sketches: exact Jaccard links and components.

A parity sketch XORs every shingle of a set into a bit string: a shingle flips the bits it
hashes to, so what two sets share cancels out, and the Hamming distance of two sketches with
one bit per shingle is at most the size of the symmetric difference.

Linked sets of sizes up to h differ in at most D = 2 h (1 - t) / (1 + t) shingles. Per size
band, sketches are cut into P = D + 1 + s pieces, and a shingle touches one piece only. By
the pigeonhole principle, linked sets agree in at least s + 1 pieces, and the join is on
equal pieces. s allows for empty pieces, which everything agrees on: a set with at most s of
them need not offer them. Each set is in its own band and, as the smaller, in the next.

Pairs that meet are sifted by the Hamming distance of small sketches and then verified on
the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.llm.cells import blocks_of, dealt, pairs_within, whole_cells
from veilwork.llm.graph import components
from veilwork.llm.textbytes import Words, as_texts, chunks, grams, mix
from veilwork.session import materialize

REMEMBERED = 1 << 18  # sets a task remembers, so as not to offer copies again; later steps drop the rest
FEW = 48  # sets of a cell whose pairs are listed instead of compared row by row
STEP = 1 << 15  # numbers per numpy step
_PIECE, _BIT, _NAME = np.uint64(0x5049454345), np.uint64(0x424954), np.uint64(0x4E414D45)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; with fewer words, all of them as one."""
    found = Words(as_texts(column))
    whole = grams(found.hashes, words)
    out = []
    for a, z in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if z - a >= words:
            one = np.sort(whole[a : z - words + 1])
            out.append(one[np.concatenate([[True], one[1:] != one[:-1]])])
        else:
            out.append(grams(found.hashes[a:z], z - a) if z > a else whole[:0])
    return out


def name_of(one: np.ndarray) -> int:
    """A 64-bit fingerprint of a set."""
    total = mix(one ^ _NAME).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(one))
    return int(mix(total).view(np.int64)[0])


def bit_sketch(one: np.ndarray) -> np.ndarray:
    """One flipped bit per shingle; a power of two of 64-bit words, at least two bits a shingle."""
    size = 64 << max(0, int(2 * len(one) - 1).bit_length() - 6)
    flips = np.bincount((mix(one ^ _BIT) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


class Bands:
    """Size bands for links at `percent` Jaccard similarity."""

    def __init__(self, percent: int):
        self.percent = percent
        self.tops = [1]

    def difference(self, both: int) -> int:
        """The largest symmetric difference of linked sets whose sizes add up to `both`."""
        return both * (100 - self.percent) // (100 + self.percent)

    def of(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] * 100 // self.percent, self.tops[-1] + 1))
        return int(np.searchsorted(self.tops, size))

    def offers(self, size: int) -> Iterator[tuple[int, int, int]]:
        """(band, pieces, slack) in which a set of this size may meet another one."""
        own = self.of(size)
        for band in (own, own + 1):
            self.of(self.tops[own] + 1)
            most = self.difference(2 * self.tops[band])
            if most:
                slack = 1 + most // 16
                yield band, most + 1 + slack, slack


def pieces(one: np.ndarray, bands: Bands) -> np.ndarray:
    """The join keys of a set: its sketch pieces in both bands, each hashed with its place."""
    out = []
    spread = mix(one ^ _PIECE)
    for band, number, slack in bands.offers(len(one)):
        # Hashes are sorted, and so are the pieces taken from their upper bits.
        piece = ((one >> np.uint64(32)) * np.uint64(number) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
        value = np.bitwise_xor.reduceat(spread, first)
        place = piece[first]
        if number - len(place) > slack:
            empty = np.setdiff1d(np.arange(number), place)
            place = np.concatenate([place, empty])
            value = np.concatenate([value, np.zeros(len(empty), dtype=np.uint64)])
        out.append(mix(value + mix(place.astype(np.uint64) + np.uint64(band << 40))))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _sets(docs: DataFrame, words: int, id_kind: str) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part.column(1), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([name_of(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([bit_sketch(s) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "row", "n", "name", "sketch"],
                )

    return docs.mapInArrow(build, f"doc_id {id_kind}, row long, n long, name long, sketch array<long>")


def _offers(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(key, name): the pieces of every set."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            for part in chunks(batch):
                keys, names = [], []
                for one in shingle_sets(part.column(1), words):
                    name = name_of(one) if len(one) else 0
                    if not len(one) or name in seen:
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(name)
                    keys.append(pieces(one, bands))
                    names.append(np.full(len(keys[-1]), name, dtype=np.int64))
                if keys:
                    key = np.concatenate(keys).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.concatenate(names))], ["key", "name"])

    return docs.mapInArrow(build, "key long, name long")


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and name -> distinct (key, name) of keys with two names or more.

    Rows stream by, and only the last one is held.
    """
    held: tuple[int, int] | None = None
    met = False  # whether the held row shares its key with the one before
    for batch in batches:
        key, name = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if held is not None:
            key, name = np.concatenate([[held[0]], key]), np.concatenate([[held[1]], name])
        if not len(key):
            continue
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])
        key, name = key[new], name[new]
        same = key[1:] == key[:-1]
        send = np.concatenate([[met], same])[:-1] | same
        if send.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[:-1][send]), pa.array(name[:-1][send])], ["key", "name"])
        met = bool(same[-1]) if len(same) else met
        held = (int(key[-1]), int(name[-1]))
    if held is not None and met:
        yield pa.RecordBatch.from_pydict({"key": [held[0]], "name": [held[1]]})


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two sketches; the longer one is folded to the shorter one's length."""

    def fold(x: Column, size: Column) -> Column:
        halves = F.transform(
            F.sequence(F.lit(0), size - 1), lambda i: F.get(x, i).bitwiseXOR(F.get(x, i + size))
        )
        return F.when(F.size(x) > size, halves).otherwise(x)

    size = F.least(F.size(a), F.size(b))
    bits = F.zip_with(fold(a, size), fold(b, size), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def _may_link(a: str, b: str, percent: int) -> Column:
    """Sizes and sketches allow the similarity. Sketches differ by one fold at most then."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    most = F.floor((na + nb) * (100 - percent) / (100 + percent))
    return sizes & F.when(sizes, hamming(F.col(f"{a}.sketch"), F.col(f"{b}.sketch")) <= most).otherwise(False)


def _verified(docs: DataFrame, pairs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """The (a, b) of `pairs` whose whole sets are similar enough."""
    names = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    rows = reps.join(names, "name", "left_semi").select("row")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part.column(1), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name_of(s) for s in sets], pa.int64()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["name", "items"],
                )

    chosen = docs.join(rows, "row", "left_semi").select("doc_id", "text")
    sets = materialize(chosen.mapInArrow(build, "name long, items array<long>").dropDuplicates(["name"]), "sets")
    left = sets.select(F.col("name").alias("a"), F.col("items").alias("of_a"))
    right = sets.select(F.col("name").alias("b"), F.col("items").alias("of_b"))
    same = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - same
    return pairs.join(left, "a").join(right, "b").where(100 * same >= percent * either).select("a", "b")


def similar_components(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    Documents link when the Jaccard similarity of their sets of `words`-word shingles is at
    least `percent` / 100, which is checked exactly; component_id is the smallest doc_id
    reachable by links, the own one included. Texts of fewer words are one shingle. A null
    or empty text has no shingles, links with nothing and keeps its own id. A row with a
    null id has its component's smallest id, if there is one. Repeated rows are in one
    component; no rows give no rows.

    Equal sets are one node. Of the sets that share a piece, all are first compared with one
    of them; this joins the bulk of a large group in linear work. Then, where a piece still
    has sets of several components, those outside its largest component are compared with
    all that are not in theirs yet. So each link between components is found, and no group
    is turned into all its pairs. 64-bit fingerprints stand for sets and shingles.
    """
    placed = _placed(_rows(docs, id_col, text_col), words, percent)
    smallest = (
        placed.where(F.col("component").isNotNull())
        .groupBy("component").agg(F.min("doc_id").alias("component_id")).hint("rebalance")
    )
    return placed.join(smallest, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with one row of each component of `similar_components`, with all columns.

    The row with the smallest id stays, a null id only if there is no other; of rows with the
    same id, one. Rows without words all stay.
    """
    placed = _placed(_rows(docs, id_col, text_col), words, percent).where(F.col("n") > 0)
    placed = materialize(placed.select("doc_id", "row", "component"), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))["row"]
    kept = placed.groupBy("component").agg(first.alias("kept")).hint("rebalance")
    gone = placed.join(kept, "component").where(F.col("row") != F.col("kept")).select(F.col("row").alias("_gone"))
    # The columns travel as one, so that their names cannot clash with those used here.
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row.alias("row"))
    stay = keyed.join(gone.distinct(), F.col("row") == F.col("_gone"), "left_anti")
    again = placed.groupBy("row").count().where("count > 1").select(F.col("row").alias("_again"))
    again = materialize(again, "repeated")
    if not again.isEmpty():
        # Equal in id and text, such rows are one node: one of them stays.
        repeated = F.col("row") == F.col("_again")
        once = stay.join(again, repeated, "left_semi").dropDuplicates(["row"])
        stay = stay.join(again, repeated, "left_anti").unionByName(once)
    return stay.select("doc.*")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    row = F.xxhash64(F.col(id_col), F.col(text_col)).alias("row")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row)


def _placed(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, row, n, name, component) of every row; no component without shingles."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    known = materialize(_sets(rows, words, kind), "sketches")
    reps = materialize(
        known.where("n > 0").groupBy("name").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "nodes",
    )
    offers = _offers(rows, words, percent).repartition("key").sortWithinPartitions("key", "name")
    met = materialize(offers.mapInArrow(_meetings, "key long, name long"), "meetings")

    stars = materialize(_stars(met), "stars")
    likely = _sifted(stars, reps, percent)
    links = _verified(rows, likely, reps, words, percent)
    links = materialize(links, "links")
    found = materialize(components(links), "components")

    rest = materialize(_unjoined(met, found, reps, percent).join(stars, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        more = _verified(rows, rest, reps, words, percent)
        found = materialize(components(links.unionByName(more)), "components")

    placed = known.join(found.withColumnRenamed("node", "name"), "name", "left")
    return placed.withColumn("component", F.coalesce("component", "name")).drop("sketch")


def _stars(met: DataFrame) -> DataFrame:
    """Each set with the centre of every piece it shares: distinct (a, b), a < b.

    The centre is the set whose pieces are shared most in all. In a group of edited copies
    that is one with few edits, which links with more of the group than others do.
    """
    sizes = met.groupBy("key").agg(F.count(F.lit(1)).alias("size")).hint("rebalance")
    shared = met.join(sizes, "key").groupBy("name").agg(F.sum("size").alias("shared"))
    ranked = met.join(shared, "name")
    centres = ranked.groupBy("key").agg(F.max_by("name", "shared").alias("centre")).hint("rebalance")
    pairs = met.join(centres, "key").where("name <> centre")
    return pairs.select(F.least("name", "centre").alias("a"), F.greatest("name", "centre").alias("b")).distinct()


def _sifted(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The (a, b) that sizes and sketches allow to link."""
    facts = F.struct("n", "sketch")
    left = reps.select(F.col("name").alias("a"), facts.alias("fa"))
    right = reps.select(F.col("name").alias("b"), facts.alias("fb"))
    return pairs.join(left, "a").join(right, "b").where(_may_link("fa", "fb", percent)).select("a", "b")


def _unjoined(met: DataFrame, found: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a piece, lie in different components and may link: distinct (a, b).

    All pairs of a piece's sets are compared but those within its largest component, on
    sketches, in cells of bounded size.
    """
    member = met.select("key", "name").join(found.withColumnRenamed("node", "name"), "name", "left")
    member = member.withColumn("component", F.coalesce("component", "name"))
    sizes = member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    bulk = sizes.groupBy("key").agg(
        F.max(F.struct("size", "component"))["component"].alias("bulk"),
        F.count(F.lit(1)).alias("parts"),
        blocks_of(F.sum("size")).alias("blocks"),
    )
    open_keys = bulk.where("parts > 1").select("key", "bulk", "blocks").hint("rebalance")
    member = member.join(open_keys, "key").join(reps.select("name", "n", "sketch"), "name")
    loose = (F.col("component") != F.col("bulk")).alias("loose")
    member = materialize(member.select("key", "blocks", "name", "component", loose, "n", "sketch"), "members")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_cells(batches):
            name = rows.column(4).to_numpy()
            left, right = _likely(rows, bounds, percent)
            yield pa.RecordBatch.from_arrays([pa.array(name[left]), pa.array(name[right])], ["a", "b"])

    pairs = dealt(member, "key", "name", "blocks").mapInArrow(sift, "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


class _Sets:
    """Components, sizes and sketches of the sets of some cells, to sift pairs as `_may_link` does."""

    def __init__(self, rows: pa.RecordBatch, percent: int):
        self.percent = percent
        self.component = rows.column(5).to_numpy()
        self.n = rows.column(7).to_numpy()
        sketch = rows.column(8)
        self.at = sketch.offsets.to_numpy().astype(np.int64) - sketch.offsets[0].as_py()
        self.length = np.diff(self.at)
        self.words = sketch.flatten().to_numpy().view(np.uint64)

    def sketches(self, rows: np.ndarray, length: int) -> np.ndarray:
        """One row for each of `length` words; sketches of twice the length are folded."""
        at = self.at[rows] + np.arange(length)[:, None]
        out = self.words[at]
        double = np.flatnonzero(self.length[rows] > length)
        out[:, double] ^= self.words[at[:, double] + length]
        return out

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """In different components, and of sizes that may link. left and right are broadcast."""
        n, m = self.n[left], self.n[right]
        return (self.component[left] != self.component[right]) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m))

    def near(self, a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether columns of sketches a and b, of the sets left and right, differ by no more than linked ones may."""
        most = (self.n[left] + self.n[right]) * (100 - self.percent) // (100 + self.percent)
        far = np.zeros(most.shape, dtype=np.int32)
        for i in range(len(a)):
            far += np.bitwise_count(a[i] ^ b[i])
            if i % 8 == 7 and (far > most).all():
                break
        return far <= most

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs (left, right) that may link."""
        keep = self.apart(left, right)
        left, right = left[keep], right[keep]
        length = np.minimum(self.length[left], self.length[right])
        for size in np.unique(length).tolist():
            of_size = np.flatnonzero(length == size)
            for at in range(0, len(of_size), max(1, STEP // size)):
                i = of_size[at : at + max(1, STEP // size)]
                x, y = left[i], right[i]
                near = self.near(self.sketches(x, size), self.sketches(y, size), x, y)
                yield x[near], y[near]

    def of_block(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of one of `left` and one of `right` that may link."""
        for of_left in np.unique(self.length[left]).tolist():
            x = left[self.length[left] == of_left]
            for of_right in (of_left // 2, of_left, 2 * of_left):
                y = right[self.length[right] == of_right]
                if not len(y):
                    continue
                size = min(of_left, of_right)
                a, b = self.sketches(x, size), self.sketches(y, size)
                step = max(1, STEP // len(y))
                for at in range(0, len(x), step):
                    u = x[at : at + step, None]
                    near = self.apart(u, y[None]) & self.near(a[:, at : at + step, None], b[:, None], u, y[None])
                    i, j = near.nonzero()
                    yield u[i, 0], y[j]


def _likely(rows: pa.RecordBatch, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows, in cells, of the pairs that lie in different components and may link."""
    sets = _Sets(rows, percent)
    alone, first, loose = (rows.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 6))
    found = []
    small = np.diff(bounds) <= FEW
    for left, right in pairs_within(bounds[:-1][small], bounds[1:][small]):
        met = alone[left] | (first[left] != first[right])
        found += sets.of_pairs(left[met], right[met])
    for a, z in zip(bounds[:-1][~small].tolist(), bounds[1:][~small].tolist(), strict=True):
        row = np.arange(a, z)
        if alone[a]:
            found += sets.of_block(row[loose[a:z]], row)
        else:
            one, other = row[first[a:z]], row[~first[a:z]]
            found += sets.of_block(one[loose[one]], other)
            found += sets.of_block(one[~loose[one]], other[loose[other]])
    return tuple(np.concatenate([bounds[:0], *[pair[i] for pair in found]]) for i in (0, 1))
