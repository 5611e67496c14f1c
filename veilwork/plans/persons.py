"""Known persons in running text: values of Silver, looked up by their rarest word and found in place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.functions.text import SPACES, strip
from veilwork.session import materialize

WORD = r"[\p{L}\p{N}]+"
LEAST = 5  # characters of a value that is looked for

# Kind of a known value, and the Silver columns it is made of; all of them have to be there.
KNOWN_VALUES = (
    ("KNOWN_EMAIL", ("email",)),
    ("KNOWN_PHONE", ("phone",)),
    ("KNOWN_ACCOUNT", ("account_number",)),
    ("KNOWN_RECORD", ("medical_record_number",)),
    ("KNOWN_NAME", ("first_name", "last_name")),
)
KINDS = tuple(kind for kind, _ in KNOWN_VALUES)


def plain_value(c: Column) -> Column:
    """Lower case, single spaces."""
    return F.lower(F.regexp_replace(strip(c), SPACES, " "))


def known_values(silver: list[DataFrame]) -> DataFrame:
    """(kind, value), each value once; of several kinds the first in KNOWN_VALUES counts."""
    parts = []
    for rows in silver:
        for place, (_, columns) in enumerate(KNOWN_VALUES):
            if set(columns) <= set(rows.columns):
                there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
                value = plain_value(F.concat_ws(" ", *columns))
                parts.append(rows.where(there).select(F.lit(place).alias("place"), value.alias("value")))
    every = reduce(DataFrame.unionByName, parts).where(F.length("value") >= LEAST)
    kinds = F.array(*map(F.lit, KINDS))
    return every.groupBy("value").agg(F.get(kinds, F.min("place")).alias("kind")).select("kind", "value")


def words_in(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def candidates(rows: DataFrame, values: DataFrame) -> DataFrame:
    """(row, kind, value): values that a text may hold, as it has the value's rarest word.

    Words of the texts that no value has leave at once. How rare a word is, is counted over all
    texts; a value with a word that no text has is out. So a common word leads to a pair only
    where a value has no rarer one.
    """
    entries = values.select("kind", "value", F.array_distinct(words_in(F.col("value"))).alias("words"))
    entries = entries.where(F.size("words") > 0)
    parts = entries.select("kind", "value", F.size("words").alias("n"), F.explode("words").alias("word"))
    told = rows.select("row", F.explode(F.array_distinct(words_in(F.col("text")))).alias("word")).distinct()
    told = materialize(told.join(parts.select("word").distinct(), "word", "left_semi"), "words")
    rarity = told.groupBy("word").agg(F.count(F.lit(1)).alias("texts"))
    anchors = parts.join(rarity, "word").groupBy("kind", "value", "n").agg(
        F.count(F.lit(1)).alias("found"), F.min(F.struct("texts", "word"))["word"].alias("word")
    )
    anchors = anchors.where(F.col("found") == F.col("n")).select("kind", "value", "word")
    return told.join(anchors, "word").select("row", "kind", "value")


def quoted(c: Column) -> Column:
    """A pattern for the value itself, with any white space for its spaces."""
    literal = F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return F.replace(literal, F.lit(" "), F.lit("\\E\\s+\\Q"))


def known_spans(df: DataFrame, values: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(keep..., spans): the known values in each text, in order, as array<struct<kind, value>>.

    A span is whole words, matched in any case; spans do not overlap, and of the values that
    start at one place the longest counts. Texts without any, and null ones, have an empty
    array. All rows come back, repeated ones too.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`"))
    rows = df.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("text"), row.alias("row"))
    maybe = candidates(rows.where("text IS NOT NULL").select("row", "text").distinct(), values)
    # At most the distinct words of a text, and most texts have none.
    order = F.sort_array(F.collect_set(F.struct((-F.length("value")).alias("size"), "value", "kind")))
    listed = maybe.groupBy("row").agg(order.alias("_known"))
    joined = rows.join(listed.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
    alternatives = F.array_join(F.transform("_known", lambda x: quoted(x["value"])), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), alternatives, F.lit(r")(?![\p{L}\p{N}])"))
    found = F.regexp_extract_all(F.col("text"), pattern, F.lit(0))
    kinds = F.map_from_arrays(F.transform("_known", lambda x: x["value"]), F.transform("_known", lambda x: x["kind"]))

    def span(x: Column) -> Column:
        return F.struct(F.element_at(kinds, plain_value(x)).alias("kind"), x.alias("value"))

    spans = F.when(F.col("_known").isNotNull(), F.transform(found, span))
    none = F.array().cast("array<struct<kind:string,value:string>>")
    return joined.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.coalesce(spans, none).alias("spans")
    )


def span_counts(df: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """The other columns with n_<kind> for each kind of span."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind.lower()}")

    return df.select(*[c for c in df.columns if c != "spans"], *map(count, kinds))
