"""Awkward rows for all operators, and plain versions of shared steps."""

import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHES = ("score", "row", "name", "n", "size", "taken", "kept", "kept_lines", "component", "key", "label", "doc", "_id", "toxicity")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def docs_frame(spark, texts, clashes=True):
    """(doc_id, text, source) rows as documents, with extra columns of clashing names."""
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in texts]
    df = spark.createDataFrame(rows, DOCS)
    for c in CLASHES if clashes else ():
        df = df.withColumn(c, df["lang"])
    return df


def messy(long_words=60_000):
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(long_words))
    return [
        (1, None, "a"), (2, "", "b"), (3, " \n\t ", None), (None, "some words here to see", "a"), (4, long_text, None),
        (5, "one two three four five six seven", "a"), (6, "one two three four five six seven", "b"),
        (6, "one two three four five six seven", "b"), (7, "x", "c"), (7, "other words of the same id", "c"),
        (None, None, None),
    ]
