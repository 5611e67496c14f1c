"""Score texts with an interpolated n-gram model: the scores of a weighted backoff automaton.

The automaton is the model's definition; it is not built. `walk` interpolates the counts of
all positions at once, order by order, which gives the weight of the same path.

States are the n-grams seen in training. A state has an arc for every word seen after it,
and a failure arc to its longest proper suffix. The model interpolates: an arc weighs
a * count / state count + (1 - a) * (weight from the shorter state), the failure arc 1 - a,
with one a per order, the Good-Turing mass of seen n-grams: 1 - singletons / n-grams. The
empty state has an arc for every word, (count + 1) / (words + distinct words + 1). All
weights out of a state sum to 1.

Counts cover the whole corpus and never meet in one place. Texts are packed into blocks; a
block sends its distinct n-gram hashes with their counts to hash buckets, buckets add them
up and send the sums back to the blocks, and a block then has the counts of all n-grams
of its texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.llm.textbytes import Words, as_texts, chunks, grams, mix
from veilwork.session import materialize

BLOCK_TOKENS = 1 << 20
BUCKET_KEYS = 1 << 22  # n-gram hashes, as blocks send them, that one bucket task holds
KEY_BYTES = 6  # of a hash that go to a bucket, besides the bucket's number
SURE = 0.99  # largest interpolation weight of seen n-grams
START, END = np.uint64(0x5374617274), np.uint64(0x456E64)  # hashes of the marks around a text


def pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, size: int, kind: type) -> np.ndarray:
    if size == 0:
        return np.zeros(0, dtype=kind)
    return np.frombuffer(pa.decompress(data, size * np.dtype(kind).itemsize, "zstd", asbytes=True), dtype=kind)


class Block:
    """Some texts as one array of word hashes, each text with a start and an end mark."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        """lengths: words and end mark of each text; hashes has them without start marks."""
        self.lengths = lengths
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
        self.hashes = np.insert(hashes, self.first - np.arange(len(lengths)), START)
        self.place = np.arange(len(self.hashes)) - np.repeat(self.first, lengths + 1)
        self.owner = np.repeat(np.arange(len(lengths)), lengths + 1)

    def keys(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the n-grams of this order by the position they end at.

        Order 1 has the start marks too: their count is that of the texts.
        """
        at = np.arange(len(self.hashes)) if order == 1 else np.flatnonzero(self.place >= order - 1)
        if order == 1:
            return at, mix(self.hashes + np.uint64(1))
        return at, grams(self.hashes, order)[at - order + 1]


def _blocks(docs: DataFrame, kind: str) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids: list = []
        train: list = []
        lengths: list = []
        words: list = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, size, ids, train, lengths, words
            distinct, seq = np.unique(np.concatenate(words), return_inverse=True)
            out = pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([(task << 32) + number], pa.int64()),
                    "ids": pa.ListArray.from_arrays(
                        pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)
                    ),
                    "train": pa.array([np.concatenate(train).astype(np.uint8).tobytes()], pa.binary()),
                    "lengths": pa.array([np.concatenate(lengths).astype(np.int64).tobytes()], pa.binary()),
                    "words": pa.array([distinct.tobytes()], pa.binary()),
                    "seq": pa.array([pack(seq.astype(np.uint32))], pa.binary()),
                    "tokens": pa.array([len(seq)], pa.int64()),
                    "learned": pa.array([int(np.concatenate(train).sum())], pa.int64()),
                }
            )
            number, size, ids, train, lengths, words = number + 1, 0, [], [], [], []
            return out

        for batch in batches:
            for part in chunks(batch):
                found = Words(as_texts(part.column(1)))
                ids.append(part.column(0))
                train.append(part.column(2).to_numpy(zero_copy_only=False))
                lengths.append(found.counts() + 1)
                words.append(np.insert(found.hashes, found.first[1:], END))
                size += len(words[-1])
                if size >= BLOCK_TOKENS:
                    yield flush()
        if words:
            yield flush()

    schema = (
        f"block long, ids array<{kind}>, train binary, lengths binary, words binary, seq binary, tokens long, learned long"
    )
    return docs.mapInArrow(build, schema)


def _read(row: dict) -> tuple[Block, np.ndarray]:
    seq = unpack(row["seq"], row["tokens"], np.uint32)
    block = Block(np.frombuffer(row["words"], dtype=np.uint64)[seq], np.frombuffer(row["lengths"], dtype=np.int64))
    return block, np.frombuffer(row["train"], dtype=np.uint8)


def _requests(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """(order, bucket, block, size, keys, counts): distinct n-grams of a block, by hash."""
    edges = (np.arange(1, buckets, dtype=object) << 64) // buckets
    edges = np.array([int(e) for e in edges], dtype=np.uint64)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                block, train = _read(row)
                for k in range(1, order + 1):
                    at, keys = block.keys(k)
                    keys, place = np.unique(keys, return_inverse=True)
                    counts = np.bincount(place, train[block.owner[at]], len(keys)).astype(np.uint32)
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    low = keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
                    rows = [
                        (k, b, row["block"], z - a, low[a:z].tobytes(), pack(counts[a:z]))
                        for b, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                    ]
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(REQUEST.names, r, strict=True)) for r in rows], REQUEST
                    )

    return blocks.mapInArrow(ask, "n int, bucket int, block long, size long, keys binary, counts binary")


REQUEST = pa.schema(
    [("n", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("size", pa.int64()),
     ("keys", pa.binary()), ("counts", pa.binary())]
)
ANSWER = pa.schema(
    [("n", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("size", pa.int64()),
     ("counts", pa.binary()), ("seen", pa.int64()), ("once", pa.int64()), ("total", pa.int64())]
)


def _add_up(rows: pa.Table) -> pa.Table:
    """Whole counts for every block that asked; the bucket's statistics go with the first."""
    sizes = rows.column("size").to_pylist()
    keys = np.zeros((sum(sizes), 8), dtype=np.uint8)
    counts = np.zeros(sum(sizes))
    at = 0
    for size, k, c in zip(sizes, rows.column("keys").to_pylist(), rows.column("counts").to_pylist(), strict=True):
        keys[at : at + size, :KEY_BYTES] = np.frombuffer(k, dtype=np.uint8).reshape(-1, KEY_BYTES)
        counts[at : at + size] = unpack(c, size, np.uint32)
        at += size
    distinct, place = np.unique(keys.view(np.uint64).ravel(), return_inverse=True)
    whole = np.bincount(place, counts, len(distinct)).astype(np.uint64)
    facts = [int((whole > 0).sum()), int((whole == 1).sum()), int(whole.sum())]
    answers = np.split(whole[place], np.cumsum(sizes)[:-1])
    none = [0] * (len(sizes) - 1)
    return pa.table(
        [rows.column("n"), rows.column("bucket"), rows.column("block"), rows.column("size"),
         pa.array([pack(a) for a in answers], pa.binary()),
         *[pa.array([f, *none], pa.int64()) for f in facts]],
        schema=ANSWER,
    )


class Model:
    """words, distinct: of the training texts, end marks included; seen[k]: weight a of order k."""

    def __init__(self, words: int, distinct: int, seen: dict[int, float]):
        self.words, self.distinct, self.seen = words, distinct, seen


def walk(block: Block, counts: dict[int, np.ndarray], model: Model) -> dict[str, np.ndarray]:
    """Totals per text; counts[k][i]: of the n-gram of order k that ends at i.

    The state before position i is the longest n-gram with a count that ends at i - 1. A
    state that lacks the arc takes failure arcs until one has it: in terms of counts, each
    order from the shortest adds its arc or multiplies by its failure weight.
    """
    token = block.place > 0
    one = counts[1]
    base = (one + 1.0) / (model.words + model.distinct + 1.0)
    chance = base.copy()
    for k in range(2, max(counts) + 1):
        state = np.concatenate([[0], counts[k - 1][:-1]])
        here = (block.place >= k - 1) & (state > 0)
        arc = model.seen[k] * counts[k][here] / state[here]
        chance[here] = arc + (1.0 - model.seen[k]) * chance[here]

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(block.owner[token], values[token], len(block.lengths))

    return {"known": total(one > 0), "base": total(np.log10(base)), "score": total(np.log10(chance))}


def _score(order: int, model: Model, schema: pa.Schema, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    out = []
    for row in blocks.to_pylist():
        block, train = _read(row)
        counts = {}
        for k in range(1, order + 1):
            own = sorted(
                (a for a in answers.to_pylist() if a["n"] == k), key=lambda a: a["bucket"]
            )
            whole = np.concatenate([unpack(a["counts"], a["size"], np.uint64) for a in own]).astype(float)
            at, keys = block.keys(k)
            counts[k] = np.zeros(len(block.hashes))
            counts[k][at] = whole[np.unique(keys, return_inverse=True)[1]]
        found = walk(block, counts, model)
        out.append(
            pa.table(
                [pa.array(row["ids"], schema.field(0).type), pa.array(train == 0), pa.array(block.lengths),
                 pa.array(found["known"].astype(np.int64)), pa.array(np.full(len(train), model.words), pa.int64()),
                 pa.array(found["base"]), pa.array(found["score"])],
                schema=schema,
            )
        )
    return pa.concat_tables(out) if out else schema.empty_table()


def score_texts(
    docs: DataFrame, train: Column, order: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Log10 probability of every whole text: (doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score), one row per input row.

    `train` tells the rows that the model learns from; the others are only scored, as
    held_out. A text's tokens are its words, A-Z lower-cased, and one end mark. A null or
    empty text is an end mark alone. base_score is the add-one unigram model's, score the
    backoff automaton's. Without training rows, every word has the same weight 1.

    n-grams are told apart by 64-bit hashes, of which a bucket keeps 48 bits. What a task
    holds is a block of texts or the hashes of one bucket, whatever the size of the corpus;
    a word found everywhere is one entry per block. A text longer than a block is a block
    of its own.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train")
    )
    kind = rows.schema["doc_id"].dataType
    blocks = materialize(_blocks(rows, kind.simpleString()), "lm-blocks")
    tokens, texts = (x or 0 for x in blocks.agg(F.sum("tokens"), F.sum("learned")).first())
    buckets = max(1, math.ceil(tokens / BUCKET_KEYS))
    asked = _requests(blocks, order, buckets)
    answers = materialize(
        asked.groupBy("n", "bucket").applyInArrow(
            _add_up,
            "n int, bucket int, block long, size long, counts binary, seen long, once long, total long",
        ),
        "lm-counts",
    )
    facts = {r["n"]: r for r in answers.groupBy("n").agg(*[F.sum(c).alias(c) for c in ("seen", "once", "total")]).collect()}
    seen = {
        k: min(SURE, 1.0 - facts[k]["once"] / facts[k]["total"]) if k in facts and facts[k]["total"] else 0.0
        for k in range(2, order + 1)
    }
    # Order 1 counts the start marks too, which are no tokens.
    model = Model(facts[1]["total"] - texts if facts else 0, facts[1]["seen"] - (texts > 0) if facts else 0, seen)
    schema = pa.schema(
        [("doc_id", _arrow(kind)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
         ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def finish(mine: pa.Table, counts: pa.Table) -> pa.Table:
        return _score(order, model, schema, mine, counts)

    return (
        blocks.groupBy("block")
        .cogroup(answers.select("n", "bucket", "block", "size", "counts").groupBy("block"))
        .applyInArrow(
            finish,
            f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, "
            "train_tokens long, base_score double, score double",
        )
    )


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
