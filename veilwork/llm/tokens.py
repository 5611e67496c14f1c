"""Alignment of two tokenizers over the same texts.

Both tokenizers encode every whole text, and tokens become byte ranges. Where a token of both
ends at one byte and both next tokens are marked with a space, the text is cut. A window
between two cuts is a pair of id tuples that holds about a word, and words repeat: each pair
of tuples is aligned once per block and remembered, so most windows cost one look-up.

A block is what one memo has seen: some megabytes of text. It writes each document as a list
of window numbers, and once the links of its windows and its distinct id pairs with their
number of links. The pairs are added up over the corpus, joined back to the blocks, and give
each document its sums. Rows of that join are distinct pairs per block, so they grow with the
corpus and not with its square, and nothing of the corpus' counts is held in one place.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.llm.textbytes import chunks, mix, powers
from veilwork.session import materialize

FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
MEMO_WINDOWS = 1 << 18  # windows a block remembers
MEMO_BYTES = 64 << 20  # bytes of their ids and texts

#: Fixed value: how byte-level BPE of this family cuts a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """The bytes of every token id: as objects, their lengths, and whether they start with a space."""

    def __init__(self, table: list[bytes]):
        self.bytes = np.array([*table, None], dtype=object)[:-1]
        self.length = np.array([len(x) for x in table], dtype=np.int64)
        self.marked = np.array([x[:1] == b" " for x in table], dtype=bool)
        self.name = np.array([str(i) for i in range(len(table))], dtype=object)


def byte_symbols() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable ones themselves,
    the others in order from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE tokenizer file. Ids rise in the order of the merges, so they are the
    ranks of the fast encoder; strings of special tokens are plain text to it."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        symbols = byte_symbols()
        vocab = spec["model"]["vocab"]
        table = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if token not in special:
                table[i] = bytes(symbols[c] for c in token)
        ranks = {x: i for i, x in enumerate(table) if x}
        self.encoder = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.vocabulary = Vocabulary(table)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoder.encode_to_numpy(" " + t) for t in texts]


class PieceBpe:
    """A sentencepiece model that adds a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = ((self.model.id_to_piece(i), self.model.is_byte(i)) for i in range(self.model.get_piece_size()))
        self.vocabulary = Vocabulary(
            [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.uint32) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


@lru_cache(maxsize=4)
def piece_bpe(path: str) -> PieceBpe:
    return PieceBpe(path)


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first[0]..last[0] - 1, first[1]..last[1] - 1 and so on, as one array."""
    sizes = last - first
    total = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(total[-1]) + np.repeat(first - total[:-1], sizes)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, byte plane by byte plane and compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * size, codec="zstd", asbytes=True)
    return np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


class Tokens:
    """The tokens of several texts in a row: ids, the byte at which each ends, first[i]:first[i + 1] of text i."""

    def __init__(self, encoded: list[np.ndarray], vocabulary: Vocabulary):
        self.ids = np.concatenate([*encoded, np.zeros(0, dtype=np.uint32)]).astype(np.int64)
        self.end = np.cumsum(vocabulary.length[self.ids])
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in encoded])]).astype(np.int64)
        self.starts = vocabulary.marked[self.ids]
        self.names = vocabulary.name

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A hash of each run of ids."""
        n = len(self.ids)
        up, down = powers(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix((self.ids + 1).astype(np.uint64) * _ODD) * up[:n], out=total[1:])
        return (total[last] - total[first]) * down[first] + (last - first).astype(np.uint64)


class Windows:
    """Cuts of texts at verified shared ends before space-marked tokens: token ranges in a and b."""

    def __init__(self, a: Tokens, b: Tokens):
        at = np.searchsorted(b.end, a.end)
        last = np.zeros(len(a.ids), dtype=bool)
        last[a.first[1:][np.diff(a.first) > 0] - 1] = True
        shared = b.end[np.minimum(at, len(b.end) - 1)] == a.end
        marked = np.concatenate([a.starts[1:], [False]]) & np.concatenate([b.starts[1:], [False]])[np.minimum(at, len(b.end) - 1)]
        cut = np.flatnonzero(shared & (marked | last))
        self.a1, self.b1 = cut + 1, at[cut] + 1
        self.a0 = np.concatenate([[0], self.a1[:-1]]).astype(np.int64)
        self.b0 = np.concatenate([[0], self.b1[:-1]]).astype(np.int64)
        self.per_text = np.diff(np.searchsorted(self.a1, a.first, side="right"))


def aligned(a: Tokens, b: Tokens, w: Windows, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Of the chosen windows: links per window, the id pair of every link, groups per window, their text.

    Each end of either side closes one stretch of bytes that lies in one token of a and one of
    b, and no two stretches have the same two tokens; so the stretches are the links.
    """
    ia, ib = ranges(w.a0[chosen], w.a1[chosen]), ranges(w.b0[chosen], w.b1[chosen])
    ea, eb = a.end[ia], b.end[ib]
    ends = np.union1d(ea, eb)
    at_a, at_b = np.searchsorted(ea, ends), np.searchsorted(eb, ends)
    pairs = (a.ids[ia][at_a] << 32) | b.ids[ib][at_b]
    shared = (ea[at_a] == ends) & (eb[at_b] == ends)
    window = np.searchsorted(a.end[w.a1[chosen] - 1], ends)
    links = np.bincount(window, minlength=len(chosen))
    groups = np.bincount(window[shared], minlength=len(chosen))
    to_a, to_b = (at_a[shared] + 1).tolist(), (at_b[shared] + 1).tolist()
    names_a, names_b = a.names[a.ids[ia]].tolist(), b.names[b.ids[ib]].tolist()
    texts, x, y = [], 0, 0
    for i, j in zip(to_a, to_b, strict=True):
        left = names_a[x] if i - x == 1 else ",".join(names_a[x:i])
        right = names_b[y] if j - y == 1 else ",".join(names_b[y:j])
        texts.append(f"{left}|{right}")
        x, y = i, j
    last = np.cumsum(groups).tolist()
    return links, pairs, groups, [";".join(texts[i:j]) for i, j in zip([0, *last[:-1]], last, strict=True)]


class Memo:
    """The windows of a block: numbered by their id tuples (packed as bytes), each aligned once."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.seen = np.zeros(0, dtype=np.int64)  # occurrences of each window
        self.links: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.groups: list[np.ndarray] = []
        self.size = 0

    def full(self) -> bool:
        return len(self.texts) >= MEMO_WINDOWS or self.size >= MEMO_BYTES

    def numbers(self, a: Tokens, b: Tokens, w: Windows) -> np.ndarray:
        """The number of every window, new ones being aligned and added."""
        hashes = mix(a.hashes(w.a0, w.a1) * _ODD + b.hashes(w.b0, w.b1))
        _, where, kind = np.unique(hashes, return_index=True, return_inverse=True)
        ids_a, ids_b = a.ids.astype("<i4").tobytes(), b.ids.astype("<i4").tobytes()
        own, new = np.empty(len(where), dtype=np.int64), []
        bounds = zip(*[(4 * x[where]).tolist() for x in (w.a0, w.a1, w.b0, w.b1)], strict=True)
        for i, (a0, a1, b0, b1) in enumerate(bounds):
            key = ids_a[a0:a1] + b"\xff\xff\xff\xff" + ids_b[b0:b1]
            found = self.number.get(key)
            if found is None:
                found = self.number[key] = len(self.number)
                new.append(i)
                self.size += len(key)
            own[i] = found
        if new:
            # In the order of their places, as alignment needs; then back to that of their numbers.
            places = where[new]
            order = np.argsort(places)
            links, pairs, groups, texts = aligned(a, b, w, places[order])
            back = np.argsort(order)
            start = np.cumsum(links) - links
            self.pairs.append(pairs[ranges(start[back], (start + links)[back])])
            self.links.append(links[back])
            self.groups.append(groups[back])
            self.texts += [texts[i] for i in back.tolist()]
            self.size += sum(map(len, texts))
        out = own[kind]
        seen = np.bincount(out, minlength=len(self.texts))
        seen[: len(self.seen)] += self.seen
        self.seen = seen
        return out


def _valid(texts: list[str | None], tokenizer: ByteBpe | PieceBpe, encoded: list[np.ndarray]) -> np.ndarray:
    """Whether the tokens of each text spell it, after one space."""
    wanted = [b" " + t.encode() for t in texts]
    spelled = b"".join(tokenizer.vocabulary.bytes[np.concatenate(encoded)].tolist())
    sizes = np.array([int(tokenizer.vocabulary.length[x].sum()) for x in encoded])
    if spelled == b"".join(wanted) and sizes.tolist() == [len(x) for x in wanted]:
        return np.ones(len(texts), dtype=bool)
    last = np.cumsum(sizes).tolist()
    return np.array([spelled[i:j] == x for i, j, x in zip([0, *last[:-1]], last, wanted, strict=True)])


def _blocks(id_kind: str, a_path: str, b_path: str, digest: bool):
    """Rows of documents (a chunk of them each) and, at the end of each block, one row of its windows."""
    fields = (
        f"block long, docs array<struct<doc_id:{id_kind},n_a:long,n_b:long,groups:string,windows:int>>, windows binary, "
        "known int, links binary, link_pairs binary, group_counts binary, pairs array<long>, counts array<long>"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, encode_b = byte_bpe(a_path), piece_bpe(b_path)
        block, memo = TaskContext.get().partitionId() << 32, Memo()
        types = None

        def documents(part: pa.RecordBatch) -> pa.RecordBatch:
            ids, texts = part.column(0), part.column(1).to_pylist()
            full = [i for i, t in enumerate(texts) if t]
            n_a, n_b, per_text = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
            said: list[str] = [""] * len(texts)
            numbers = np.zeros(0, dtype=np.int64)
            if full:
                chosen = [texts[i] for i in full]
                in_a, in_b = encode_a.encode(chosen), encode_b.encode(chosen)
                good = _valid(chosen, encode_a, in_a) & _valid(chosen, encode_b, in_b)
                rows = np.array(full)[good]
                a = Tokens([x for x, ok in zip(in_a, good, strict=True) if ok], encode_a.vocabulary)
                b = Tokens([x for x, ok in zip(in_b, good, strict=True) if ok], encode_b.vocabulary)
                if len(rows):
                    w = Windows(a, b)
                    numbers = memo.numbers(a, b, w)
                    n_a[rows], n_b[rows], per_text[rows] = np.diff(a.first), np.diff(b.first), w.per_text
                    pieces = np.array([*memo.texts, None], dtype=object)[numbers].tolist()
                    at = 0
                    for row, size in zip(rows.tolist(), w.per_text.tolist(), strict=True):
                        text = ";".join(pieces[at : at + size])
                        said[row] = hashlib.sha256(text.encode()).hexdigest() if digest else text
                        at += size
            docs = pa.StructArray.from_arrays(
                [ids, pa.array(n_a), pa.array(n_b), pa.array(said, pa.string()), pa.array(per_text.astype(np.int32))],
                ["doc_id", "n_a", "n_b", "groups", "windows"],
            )
            row = {"block": block, "docs": docs.to_pylist(), "windows": packed(numbers)}
            return pa.RecordBatch.from_pylist([row], schema=types)

        def windows() -> pa.RecordBatch:
            links, pairs = np.concatenate(memo.links), np.concatenate(memo.pairs)
            known, kind = np.unique(pairs, return_inverse=True)
            counts = np.bincount(kind, weights=np.repeat(memo.seen, links).astype(np.float64), minlength=len(known))
            row = {
                "block": block, "known": len(links), "links": packed(links), "link_pairs": packed(kind),
                "group_counts": packed(np.concatenate(memo.groups)), "pairs": known, "counts": counts.astype(np.int64),
            }
            return pa.RecordBatch.from_pylist([row], schema=types)

        for batch in batches:
            if types is None:
                doc = pa.struct([("doc_id", batch.schema.field(0).type), ("n_a", pa.int64()), ("n_b", pa.int64()),
                                 ("groups", pa.string()), ("windows", pa.int32())])
                types = pa.schema(
                    [("block", pa.int64()), ("docs", pa.list_(doc)), ("windows", pa.binary()), ("known", pa.int32()),
                     ("links", pa.binary()), ("link_pairs", pa.binary()), ("group_counts", pa.binary()),
                     ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
                )
            for part in chunks(batch):
                yield documents(part)
                if memo.full():
                    yield windows()
                    block, memo = block + 1, Memo()
        if memo.texts:
            yield windows()

    return build, fields


def _sums(id_kind: str):
    """A block's rows and the corpus-wide counts of its pairs -> one row per document."""
    fields = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def added(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sums of consecutive runs of values."""
        total = np.concatenate([[0], np.cumsum(values)])
        last = np.cumsum(sizes)
        return total[last] - total[last - sizes]

    def build(rows: pa.Table, answers: pa.Table) -> pa.Table:
        pair = answers.column("pair").to_numpy()
        order = np.argsort(pair)
        n, best = (answers.column(c).to_numpy()[order] for c in ("n", "best"))
        rows = rows.to_pylist()
        per_window = np.zeros((4, 0), dtype=np.int64)
        for row in rows:
            if row["links"] is not None:
                known = row["known"]
                links = unpacked(row["links"], known)
                pairs = unpacked(row["link_pairs"], int(links.sum()))
                groups = unpacked(row["group_counts"], known)
                per_window = np.stack([groups, links, added(best[pairs].astype(np.int64), links), added(n[pairs], links)])
        out = []
        for row in rows:
            if row["docs"] is not None:
                sizes = np.array([d["windows"] for d in row["docs"]], dtype=np.int64)
                numbers = unpacked(row["windows"], int(sizes.sum()))
                sums = np.stack([added(x[numbers], sizes) for x in per_window])
                docs = pa.array(row["docs"], rows_type)
                first = [docs.field(i) for i in range(3)]
                out.append(pa.table([*first, *map(pa.array, sums), docs.field(3)], fields))
        return pa.concat_tables(out) if out else empty

    doc = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(id_kind)
    if doc is None:
        raise TypeError(f"ids of type {id_kind} are not supported; use bigint, int or string")
    rows_type = pa.struct([("doc_id", doc), ("n_a", pa.int64()), ("n_b", pa.int64()), ("groups", pa.string()), ("windows", pa.int32())])
    empty = pa.table([pa.array([], doc), *[pa.array([], pa.int64())] * 6, pa.array([], pa.string())], fields)
    longs = ", ".join(f"{c} long" for c in fields[1:7])
    return build, f"doc_id {id_kind}, {longs}, groups string"


def align_tokenizers(
    docs: DataFrame,
    folder: str = FOLDER,
    a_file: str = BYTE_BPE,
    b_file: str = PIECE_BPE,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """One row per input row: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups).

    a is a byte-level BPE file that encodes a space and the text, b a sentencepiece model that
    adds the space itself; `folder` has both on every executor. Groups are the tokens between
    bytes at which tokens of both end; `groups` lists them as `a1,a2|b1;a3|b2`, or has the
    SHA-256 of that for `digest`. Links are the overlapping tokens of a and b. A link's count is
    how many links of all rows join its two ids; n_best counts the links whose count is the
    highest of their b id, ties included, and count_sum adds the counts.

    A null or empty text, or one that the tokens of a or b do not spell, has zeros and an empty
    `groups`. Rows are never compared or joined by id, so null and repeated ids are rows like
    others, and equal texts count as often as they occur. Other columns are left out, whatever
    their names. No rows give no rows. Memory grows with the longest text, and else is bounded
    by the 2 MB of text that are encoded at once and by the memo.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    build, fields = _blocks(kind, os.path.join(folder, a_file), os.path.join(folder, b_file), digest)
    blocks = materialize(rows.mapInArrow(build, fields), "token-blocks")

    # Pairs and counts travel in one array of structs, so that one explode gives both.
    known = blocks.where("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    known = known.select(F.col("block").alias("asks"), F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    totals = materialize(known.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = totals.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("highest"))
    totals = totals.withColumn("b_id", b_id).join(highest, "b_id").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    answers = known.select("asks", "pair").join(totals, "pair").select("asks", "pair", "n", "best")

    score, columns = _sums(kind)
    return blocks.drop("pairs", "counts").groupBy("block").cogroup(answers.groupBy("asks")).applyInArrow(score, columns)
