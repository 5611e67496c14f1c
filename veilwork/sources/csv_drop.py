"""CSV files of a drop folder -> Bronze: all text, every row, with lineage."""

from __future__ import annotations

import csv
import datetime as dt
import logging
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.operators.joins import absent_from
from veilwork.schemas import DOMAINS, Domain
from veilwork.session import materialize
from veilwork.sources.tables import MANIFEST, MANIFEST_SCHEMA, TableStore

log = logging.getLogger(__name__)

# Files handled at a time: the driver never holds a longer list.
FILES_PER_LOAD = 10_000
LAST_ID = (1 << 63) - 1
# More rows than a task reads before it comes to a file: it packs files up to a number of bytes.
ROWS_BEFORE = 1 << 31
INDEX_COLUMNS = frozenset({"index", "unnamed_0"})

# A line, read from outside quotes, whose last field is quoted and not closed.
_QUOTED = r'"(?:[^"]|"")*+'
_FIELD = rf'(?:{_QUOTED}"[^,]*+|[^",][^,]*+|)'
OPEN_QUOTE = rf"\A(?:{_FIELD},)*+{_QUOTED}\z"


@dataclass(frozen=True)
class SourceFile:
    """A new file; its rows get ids from `first_id` on."""

    name: str
    path: str
    size: int
    signature: str
    number: int
    first_id: int

    @property
    def next_id(self) -> int:
        return self.first_id + self.size + ROWS_BEFORE


@dataclass
class Group:
    """Files that share a header and a line layout."""

    domain: Domain
    header: tuple[str, ...]
    multiline: bool
    files: list[SourceFile]
    crlf: bool = False  # lines end in \r\n


def file_columns(files: DataFrame) -> DataFrame:
    """(name, path, size, signature) of a binaryFile scan or stream; contents are not read."""
    return files.select(
        F.col("_metadata.file_name").alias("name"),
        "path",
        F.col("length").alias("size"),
        F.concat_ws("|", "_metadata.file_name", "length", F.unix_micros("modificationTime")).alias("signature"),
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, path, size, signature) of the folder's CSV files."""
    return file_columns(spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]").load(folder))


def literal_path(path: str) -> str:
    """A path whose special characters are not read as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def normalize_name(name: str) -> str:
    """'Customer ID' -> customer_id."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def normalize_header(names: list[str]) -> tuple[str, ...]:
    out = [normalize_name(n.lstrip("﻿")) for n in names]
    repeated = sorted({n for n in out if out.count(n) > 1})
    if repeated:
        raise ValueError(f"headers that become the same name: {repeated}")
    return tuple(out)


def split_header(line: str | None) -> list[str]:
    """Column names as written; an unnamed column gets its number."""
    cells = next(csv.reader([(line or "").rstrip("\r")]), [])
    if not cells:
        raise ValueError("empty file")
    return [v if v else f"unnamed: {i}" for i, v in enumerate(cells)]


def detect_domain(columns: set[str]) -> Domain:
    """The one domain whose routing columns are all present."""
    found = [d for d in DOMAINS.values() if d.routing <= columns]
    if not found:
        raise ValueError(f"no domain has these columns: {sorted(columns)}")
    if len(found) > 1:
        raise ValueError(f"columns fit several domains: {[d.name for d in found]}")
    return found[0]


def index_in_task() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def probe(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(name, header, multiline) of every file that has a line, in one pass over the text.

    multiline: whether a quoted field spans lines. If no line leaves a quote open when read
    from outside quotes, none is ever entered inside quotes, and the file can be split at
    any line.
    """
    lines = spark.read.option("lineSep", "\n").text([literal_path(p) for p in paths])
    # Lines without any quote are the common case and skip the expression.
    opens = F.contains("value", F.lit('"')) & F.regexp_replace("value", r"\r\z", "").rlike(OPEN_QUOTE)
    place = F.when(F.col("start") == 0, F.col("i"))
    return (
        lines.select(
            F.col("_metadata.file_name").alias("name"),
            F.col("_metadata.file_block_start").alias("start"),
            index_in_task().alias("i"),
            "value",
            opens.alias("opens"),
        )
        .groupBy("name")
        .agg(F.min_by("value", place).alias("header"), F.bool_or("opens").alias("multiline"))
    )


def read_raw(spark: SparkSession, group: Group) -> DataFrame:
    """All-text rows of one group with `_bronze_id` and `_source_file`.

    `_bronze_id` comes straight from the scan: the file's first id, plus the byte offset of
    the split, plus the row's index in the task. Every split but a file's last one fills a
    task of its own and a row takes at least one byte, so ids rise with the position in
    the file; a task may read other files first, and so many ids are left free before the
    next file's begin. No count, sort or shuffle is needed. Positions do depend on how files are split, so ids are taken once, here, and
    stored. A file in which a quoted field spans lines is read whole by one task; `\n` ends its
    lines whatever they look like, so that line breaks inside cells stay as they are, and the
    `\r` before it is taken off the last cell.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(group.header))])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True)
    if group.multiline:
        rows = rows.option("multiLine", True).option("lineSep", "\n")
    positioned = rows.option("escape", '"').csv([literal_path(f.path) for f in group.files]).select(
        "*",
        F.col("_metadata.file_name").alias("_source_file"),
        (F.col("_metadata.file_block_start") + index_in_task()).alias("_position"),
    )
    firsts = spark.createDataFrame([(f.name, f.first_id) for f in group.files], "_name string, _first_id bigint")
    # At most FILES_PER_LOAD rows, so the broadcast has a fixed bound.
    keyed = positioned.join(F.broadcast(firsts), F.col("_source_file") == F.col("_name"))
    cells = [F.coalesce(f"_c{i}", F.lit("")) for i in range(len(group.header))]
    if group.multiline and group.crlf:
        cells[-1] = F.regexp_replace(cells[-1], r"\r\z", "")
    cells = [cell.alias(name) for cell, name in zip(cells, group.header, strict=True)]
    return keyed.select((F.col("_first_id") + F.col("_position")).alias("_bronze_id"), *cells, "_source_file")


def conform(rows: DataFrame, domain: Domain) -> DataFrame:
    """The domain's columns in order: missing ones NULL, others dropped."""
    rows = rows.drop(*INDEX_COLUMNS)
    have = set(rows.columns)
    columns = [
        F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in domain.source_columns
    ]
    lineage = [c for c in ("_source_file",) if c in have]
    return rows.select("_bronze_id", *columns, *lineage)


def with_lineage(rows: DataFrame, batch_id: str, at: dt.datetime) -> DataFrame:
    return rows.withColumn("_ingestion_batch_id", F.lit(batch_id)).withColumn("_ingested_at", F.lit(at))


def packed_bytes(spark: SparkSession) -> int:
    """Bytes of files that Spark packs into one scan task at most."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _batches(fresh: DataFrame, number: int, first_id: int) -> Iterator[list[SourceFile]]:
    """The new files by path, FILES_PER_LOAD at a time, with their numbers and id ranges."""
    last = None
    while True:
        rest = fresh if last is None else fresh.where(F.col("path") > last)
        rows = rest.orderBy("path").limit(FILES_PER_LOAD).collect()
        files = []
        for r in rows:
            number += 1
            files.append(SourceFile(r["name"], r["path"], r["size"], r["signature"], number, first_id))
            first_id = files[-1].next_id
            if first_id > LAST_ID:
                raise OverflowError("no row ids are left for these files")
        if files:
            yield files
        if len(rows) < FILES_PER_LOAD:
            return
        last = rows[-1]["path"]


def _groups(spark: SparkSession, files: list[SourceFile], failures: dict[str, str]) -> list[Group]:
    """The readable files by header and line layout; unreadable ones go to `failures`."""
    # At most FILES_PER_LOAD rows come back.
    found = {r["name"]: r for r in probe(spark, [f.path for f in files]).collect()}
    by_layout = defaultdict(list)
    for file in files:
        try:
            seen = found.get(file.name)
            header = normalize_header(split_header(seen["header"] if seen else None))
            domain = detect_domain(set(header) - INDEX_COLUMNS)
            by_layout[domain.name, header, seen["multiline"], seen["header"].endswith("\r")].append(file)
        except Exception as fault:  # one bad file must not stop the others
            failures[file.name] = str(fault)
    return [Group(DOMAINS[d], header, lines, own, crlf) for (d, header, lines, crlf), own in sorted(by_layout.items())]


def _load(store: TableStore, group: Group, batch_id: str, now: dt.datetime, failures: dict[str, str]) -> tuple[int, int]:
    """(files, rows) entered. A group that fails is halved until the files at fault are alone."""
    spark = store.spark
    load_id = f"{batch_id}-{uuid.uuid4().hex[:8]}-{group.files[0].number}"
    target = f"bronze/{group.domain.name}"
    try:
        rows = with_lineage(conform(read_raw(spark, group), group.domain), batch_id, now)
        store.append(target, rows.withColumn("_load_id", F.lit(load_id)), ("_load_id",))
        per_file = (
            store.read(target, "_source_file string, _load_id string")
            .where(F.col("_load_id") == load_id)
            .groupBy("_source_file")
            .count()
        )
        counts = {r["_source_file"]: r["count"] for r in per_file.collect()}
        entries = [
            (f.number, f.name, f.signature, group.domain.name, batch_id, now, load_id, counts.get(f.name, 0), f.next_id)
            for f in group.files
        ]
        store.append(MANIFEST, spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1))
        return len(entries), sum(counts.values())
    except Exception as fault:  # the other files are independent
        if len(group.files) == 1:
            failures[group.files[0].name] = str(fault)
            return 0, 0
    half = len(group.files) // 2
    parts = [replace(group, files=f) for f in (group.files[:half], group.files[half:])]
    done = [_load(store, part, batch_id, now, failures) for part in parts]
    return done[0][0] + done[1][0], done[0][1] + done[1][1]


def ingest_files(
    store: TableStore, found: DataFrame, now: dt.datetime | None = None, batch_id: str | None = None
) -> DataFrame:
    """Load those of the files (name, path, size, signature) that the manifest lacks.

    A file is known by name, size and modification time. Each header group is written as
    its own load and then entered in the manifest, which is what makes its rows visible,
    so a load that fails half-way leaves nothing to clean up and its files are retried
    by the next run. One failing file does not stop the rest. Returns one summary row.
    """
    spark = store.spark
    if packed_bytes(spark) > ROWS_BEFORE:
        raise ValueError("spark.sql.files.maxPartitionBytes is beyond what row ids leave room for")
    batch_id = batch_id or str(uuid.uuid4())
    now = now or dt.datetime.now(dt.timezone.utc)
    found = materialize(found.dropDuplicates(["path"]), "files")
    manifest = store.manifest()
    known = manifest.select(F.col("file_signature").alias("signature"))
    fresh = materialize(absent_from(found, known, ["signature"]), "new-files")
    n_found, n_fresh = found.count(), fresh.count()
    number, first_id = manifest.agg(F.max("manifest_id"), F.max("next_id")).first()
    failures: dict[str, str] = {}
    loaded_files = loaded_rows = 0
    for files in _batches(fresh, number or 0, first_id or 0):
        for group in _groups(spark, files, failures):
            added = _load(store, group, batch_id, now, failures)
            loaded_files, loaded_rows = loaded_files + added[0], loaded_rows + added[1]
    for name, fault in sorted(failures.items()):
        log.warning("not ingested: %s: %s", name, fault.splitlines()[0])
    return spark.createDataFrame(
        [(n_found, loaded_files, n_found - n_fresh, len(failures), loaded_rows)],
        "files_found bigint, files_ingested bigint, files_skipped bigint, files_failed bigint, rows_ingested bigint",
    )


def ingest(store: TableStore, folder: str, now: dt.datetime | None = None) -> DataFrame:
    """Load the folder's new files into Bronze; returns one summary row."""
    return ingest_files(store, list_files(store.spark, folder), now)
