"""Find repeated lines and return which lines every document keeps, as bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.session import materialize

SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_BITS = 64


def lines_of(text: Column) -> Column:
    """The lines; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """The line without white space at its ends, with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def row_key(doc_id: str, text: str) -> dict[str, Column]:
    """What tells rows apart: the id, and two hashes of the text."""
    return {
        "_id": F.col(doc_id),
        "_t1": F.xxhash64(F.lit(1), F.col(text)),
        "_t2": F.xxhash64(F.lit(2), F.col(text)),
    }


def keep_bitmaps(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Compressed keep bitmaps: (_id, _t1, _t2, kept map<int,long>) of documents that lose lines.

    Bit i % 64 of word i / 64 is set where line i stays. Words with all bits set are left
    out, and so are documents that keep every line, as a null.

    Line keys are hashed to 128 bits. Each document gives every key once, at its first line,
    with the set of lines that have it. Those rows are range-partitioned by hash, document
    and position and sorted so in each partition; a key found in a third of all documents is
    thus cut over many partitions. They are written once, then streamed over twice: for each
    partition's count and first occurrence of every key, which meet by key, and for the
    lines of the keys that go.

    Rows with the same id and the same text are one document. With `keep_first` the first
    line of the first document (by id and text hash, null id first) stays; else all go.
    """
    rows = docs.select(
        *[c.alias(n) for n, c in row_key(id_col, text_col).items()],
        F.posexplode(F.transform(lines_of(F.col(text_col)), key_of)).alias("_pos", "_line"),
    ).where(F.length("_line") >= min_chars)
    document = ["_h1", "_h2", "_id", "_t1", "_t2"]
    in_documents = materialize(
        rows.withColumns({"_h1": F.xxhash64(F.lit(1), "_line"), "_h2": F.xxhash64(F.lit(2), "_line")})
        .select(*document, "_pos")
        .repartitionByRange(*document)
        .sortWithinPartitions(*document, "_pos")
        .groupBy(*document)
        .agg(F.collect_set("_pos").alias("_lines")),
        "lines",
    )
    found = [F.count(F.lit(1)).alias("_docs")]
    if keep_first:
        found.append(F.min(F.struct("_id", "_t1", "_t2", F.array_min("_lines").alias("_pos"))).alias("_first"))
    frequent = in_documents.groupBy("_h1", "_h2").agg(*found).where(F.col("_docs") >= min_docs)
    frequent = frequent.hint("rebalance")  # dealt anew for the join, so that a hot key's rows can be split
    lost = in_documents.join(frequent, ["_h1", "_h2"])
    lines = F.col("_lines")
    if keep_first:
        first = (
            F.col("_id").eqNullSafe(F.col("_first._id"))
            & F.col("_t1").eqNullSafe(F.col("_first._t1"))
            & F.col("_t2").eqNullSafe(F.col("_first._t2"))
        )
        lines = F.when(first, F.array_remove(lines, F.col("_first._pos"))).otherwise(lines)
    lost = lost.select("_id", "_t1", "_t2", F.explode(lines).alias("_pos"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_pos") % WORD_BITS).cast("int"))
    words = lost.groupBy("_id", "_t1", "_t2", F.floor(F.col("_pos") / WORD_BITS).cast("int").alias("_word")).agg(
        F.bitwise_not(F.bit_or(bit)).alias("_bits")
    )
    return words.groupBy("_id", "_t1", "_t2").agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("kept")
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add kept_lines, an array of the lines that stay, to all columns of `docs`.

    A column of that name is replaced; no other name can clash.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "kept_lines"])
    rows = docs.select(
        whole.alias("doc"), F.col(text_col).alias("text"), *[c.alias(n) for n, c in row_key(id_col, text_col).items()]
    )
    marks = bitmaps.select(*[F.col(n).alias(f"of{n}") for n in ("_id", "_t1", "_t2")], "kept")
    same = [F.col(n).eqNullSafe(F.col(f"of{n}")) for n in ("_id", "_t1", "_t2")]
    joined = rows.join(marks, same[0] & same[1] & same[2], "left")
    lines = lines_of(F.col("text"))

    def stays(_: Column, i: Column) -> Column:
        bits = F.try_element_at("kept", F.floor(i / WORD_BITS).cast("int"))
        return F.getbit(F.coalesce(bits, F.lit(-1).cast("long")), i % WORD_BITS) == 1

    kept = F.when(F.col("kept").isNull(), lines).otherwise(F.filter(lines, stays))
    return joined.select("doc", kept.alias("kept_lines")).select("doc.*", "kept_lines")
