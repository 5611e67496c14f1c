"""Bronze -> Silver: clean, type, validate and deduplicate, with a reason for every refusal."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.functions import cleaners as C
from veilwork.operators.dedupe import first_ids, first_per_key
from veilwork.operators.joins import absent_from
from veilwork.schemas import DOMAINS, Domain
from veilwork.session import materialize
from veilwork.sources.tables import RUN, Keyed, TableStore

INVALID_PK = "INVALID_PRIMARY_KEY"
MISSING_NAME = "MISSING_FIRST_NAME"
DUPLICATE_PK = "DUPLICATE_PRIMARY_KEY"

STAT_COLUMNS = (
    "bronze_rows", "already_processed", "inserted", "rejected",
    "invalid_primary_key", "missing_first_name", "duplicate_primary_key", "exact_duplicate",
)

RUNS = "silver/_runs"
RUNS_SCHEMA = (
    "run_id string, domain string, load_id string, bronze_rows bigint, inserted bigint, "
    "invalid_primary_key bigint, missing_first_name bigint, duplicate_primary_key bigint"
)


def silver_table(domain: Domain) -> Keyed:
    """Silver by buckets of the primary key, so that a batch looks its keys up without moving Silver."""
    return Keyed(f"silver/{domain.name}", domain.silver_schema, (domain.primary_key,))


def clean_fields(bronze: DataFrame, domain: Domain, only: set[str] | None = None) -> DataFrame:
    """Cleaned and typed source columns with `_bronze_id`, city and state.

    Two projections: text is trimmed once per column in the first and parsed in the
    second. As one, the generated code outgrows the JVM's method limit. Columns that
    Bronze lacks are NULL; `only` limits the work to some columns.
    """
    fields = [f for f in domain.fields if only is None or f.name in only]
    have = set(bronze.columns)
    trimmed = ["_bronze_id"]
    parsed = ["_bronze_id"]
    for f in fields:
        raw = F.col(f.name) if f.name in have else F.lit(None).cast("string")
        trimmed.append(f.prepare(raw).alias(f.name))
        value = f.parse(F.col(f.name)) if f.parse else F.col(f.name)
        parsed.append(value.alias(f.name))
    if any(f.name == "address" for f in fields):
        place = C.place_of("address")
        parsed.append(place.alias("_place"))
    out = bronze.select(*trimmed).select(*parsed)
    if "_place" in out.columns:
        out = out.select(
            *[c for c in out.columns if c != "_place"],
            F.col("_place.city").alias("city"),
            F.col("_place.state").alias("state"),
        )
    return out


def apply_date_rules(rows: DataFrame, domain: Domain, as_of: dt.date | Column) -> DataFrame:
    """NULL for dates in the future, then for admissions before birth. The row stays."""
    today = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    present = [c for c in domain.date_columns if c in rows.columns]
    rows = rows.withColumns(
        {c: F.when(C.date_is_not_future(F.col(c), today), F.col(c)) for c in present}
    )
    if domain.name == "medical" and {"admission_date", "date_of_birth"} <= set(rows.columns):
        consistent = C.admission_is_consistent(F.col("admission_date"), F.col("date_of_birth"))
        rows = rows.withColumn("admission_date", F.when(consistent, F.col("admission_date")))
    return rows


def row_fault(domain: Domain) -> Column:
    """The critical fault of a cleaned row, NULL if it has none."""
    return F.when(F.col(domain.primary_key).isNull(), INVALID_PK).when(
        F.col("first_name").isNull(), MISSING_NAME
    )


def with_claim(rows: DataFrame, domain: Domain) -> DataFrame:
    """Add `_fault` and `_claim`, the key a row asks for: NULL where it has a fault.

    Faulty rows are kept and all claim NULL. Filtering them out first would evaluate the
    cleaners once more, in a filter pushed down to the scan.
    """
    faulted = rows.withColumn("_fault", row_fault(domain))
    return faulted.withColumn("_claim", F.when(F.col("_fault").isNull(), F.col(domain.primary_key)))


def cleaned(bronze: DataFrame, domain: Domain, as_of: dt.date) -> DataFrame:
    rows = apply_date_rules(clean_fields(bronze, domain), domain, as_of)
    return rows.select("_bronze_id", *domain.source_columns, "city", "state")


def accepted(bronze: DataFrame, domain: Domain, as_of: dt.date, silver: DataFrame | None = None) -> DataFrame:
    """The rows to add to Silver.

    Keys are made unique inside the batch before Silver is consulted, so the join against
    it never sees a hot key. The outcome is the same as row-by-row processing: a key that
    Silver has refuses all its rows, and otherwise the first valid row takes it. A row that
    Silver has already is refused by its key as well.
    """
    rows = with_claim(cleaned(bronze, domain, as_of), domain)
    unique = first_per_key(rows, ["_claim"], ["_bronze_id"]).where("_fault IS NULL").drop("_fault", "_claim")
    return unique if silver is None else absent_from(unique, silver, [domain.primary_key])


def classified(
    bronze: DataFrame,
    domain: Domain,
    as_of: dt.date,
    silver: DataFrame | None = None,
    done: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Every cleaned row with `reject_reason`, NULL for accepted rows.

    Which rows win their key is decided by an aggregate on the key and brought back by
    the unique row id, so a key repeated any number of times is spread over all tasks.
    Rows whose id is in `done` are left out; that is Silver, or the part of it in which rows
    of this batch can be. `buckets` is their number where Silver is stored by key.
    """
    done = silver if done is None else done
    if done is not None:
        bronze = absent_from(bronze, done, ["_bronze_id"])
    rows = cleaned(bronze, domain, as_of).withColumn("_fault", row_fault(domain))
    # Two columns are enough to find the winners. The group of the faulty rows has one too,
    # which does no harm, as their reason is their fault.
    keys = with_claim(clean_fields(bronze, domain, {domain.primary_key, "first_name"}), domain)
    winners = first_ids(keys, "_claim", "_bronze_id")
    if silver is not None:
        winners = unclaimed(winners, silver, domain, buckets)
    winners = winners.select(F.col("_bronze_id").alias("_winner"))
    joined = rows.join(winners, rows["_bronze_id"] == winners["_winner"], "left")
    reason = F.coalesce("_fault", F.when(F.col("_winner").isNull(), DUPLICATE_PK))
    return joined.withColumn("reject_reason", reason).drop("_fault", "_winner")


def unclaimed(winners: DataFrame, silver: DataFrame, domain: Domain, buckets: int | None = None) -> DataFrame:
    """The (_claim, _bronze_id) whose key Silver lacks. Bucketed Silver is read in place."""
    known = silver.select(F.col(domain.primary_key).alias("_claim"))
    return absent_from(winners, known, ["_claim"], buckets=buckets)


def rejected(bronze: DataFrame, domain: Domain, as_of: dt.date, silver: DataFrame | None = None) -> DataFrame:
    """Quarantine view: the refused rows with their reason."""
    return classified(bronze, domain, as_of, silver).where("reject_reason IS NOT NULL")


def batch_stats(bronze: DataFrame, domain: Domain) -> DataFrame:
    """One row of counts for a batch with no Silver state, from two columns only."""
    few = clean_fields(bronze, domain, {domain.primary_key, "first_name"})
    per_key = with_claim(few, domain).groupBy(F.col("_claim").alias("_pk")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_fault") == INVALID_PK).alias("bad_pk"),
        F.count_if(F.col("_fault") == MISSING_NAME).alias("no_name"),
    )
    repeats = F.when(F.col("_pk").isNotNull(), F.col("n") - 1).otherwise(0)
    total = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_rows"),
        F.count("_pk").alias("inserted"),
        F.coalesce(F.sum("bad_pk"), F.lit(0)).alias("invalid_primary_key"),
        F.coalesce(F.sum("no_name"), F.lit(0)).alias("missing_first_name"),
        F.coalesce(F.sum(repeats), F.lit(0)).alias("duplicate_primary_key"),
    )
    return total.select(
        F.lit(domain.name).alias("domain"),
        "bronze_rows",
        F.lit(0).cast("bigint").alias("already_processed"),
        "inserted",
        (F.col("bronze_rows") - F.col("inserted")).alias("rejected"),
        "invalid_primary_key",
        "missing_first_name",
        "duplicate_primary_key",
        # The signature holds the primary key, so a repeat is always found by key first.
        F.lit(0).cast("bigint").alias("exact_duplicate"),
    )


def with_totals(stats: DataFrame) -> DataFrame:
    """Per-domain rows plus a TOTAL row."""
    summed = stats.rollup("domain").agg(*[F.sum(c).alias(c) for c in STAT_COLUMNS])
    return summed.withColumn("domain", F.coalesce("domain", F.lit("TOTAL")))


def unlogged(store: TableStore, domain: Domain, logged: DataFrame) -> DataFrame:
    """Silver rows of runs that did not reach the log. As a rule there are none."""
    finished = {r["run_id"] for r in logged.select("run_id").distinct().collect()}  # one short id per run
    table = silver_table(domain)
    return store.keyed(table).where(F.col(RUN).isin(sorted(store.runs(table) - finished)))


def settle_loads(
    store: TableStore,
    domain: Domain,
    as_of: dt.date,
    pending: DataFrame,
    run_id: str,
    silver: DataFrame,
    done: DataFrame,
    log_loads: bool = True,
    repeat: bool = False,
) -> dict[str, int]:
    """Add the accepted rows of some loads to Silver as one run, and log the run; returns its counts.

    Rows are cleaned and classified once, into the shared folder; Silver gets the accepted
    ones and the counts come from there. `silver` are the keys that are taken and `done` the
    rows that are left out; `repeat` replaces what an earlier attempt of the run has written.
    """
    table = silver_table(domain)
    rows = classified(store.read_bronze(domain.name, pending), domain, as_of, silver, done, store.buckets)
    settled = materialize(rows, f"classified-{domain.name}")
    found = {r["reject_reason"]: r["count"] for r in settled.groupBy("reject_reason").count().collect()}
    store.append_keyed(table, settled.where("reject_reason IS NULL"), run_id, replace=repeat)
    new = {
        "bronze_rows": store.manifest().join(pending, "load_id", "left_semi").agg(F.sum("rows")).first()[0],
        "inserted": found.get(None, 0),
        "invalid_primary_key": found.get(INVALID_PK, 0),
        "missing_first_name": found.get(MISSING_NAME, 0),
        "duplicate_primary_key": found.get(DUPLICATE_PK, 0),
    }
    # The counts belong to the run; they are logged with its first load. A rescan logs its run
    # without any load, as these have theirs.
    first = pending.agg(F.min("load_id")).first()[0]
    counts = [
        F.when((F.col("load_id") == first) & F.lit(log_loads), n).otherwise(0).cast("bigint").alias(c)
        for c, n in new.items()
    ]
    load = F.when(F.lit(log_loads), F.col("load_id")).alias("load_id")
    log = pending.select(F.lit(run_id).alias("run_id"), F.lit(domain.name).alias("domain"), load, *counts)
    store.append(RUNS, log.distinct().coalesce(1))
    return new


def process_domain(store: TableStore, name: str, as_of: dt.date, rescan: bool = False) -> dict[str, int]:
    """Bring one domain's Silver table up to date and return the run's counts.

    Only Bronze loads that no earlier run finished are read; `rescan` reads all again,
    for use after a change of the rules. Rows refused earlier stay refused under the same
    rules, so their counts are carried over from the run log.

    Rows of this batch can be in Silver already if a run that wrote them did not reach the log,
    so only such runs are compared by row id.
    """
    domain = DOMAINS[name]
    logged = store.read(RUNS, RUNS_SCHEMA).where(F.col("domain") == name)
    runs = logged.limit(0) if rescan else logged
    loads = store.committed_loads(name)
    pending = loads.join(runs.select("load_id"), "load_id", "left_anti")
    pending = materialize(pending, "pending")
    before = runs.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (
            "bronze_rows", "inserted", "invalid_primary_key", "missing_first_name", "duplicate_primary_key"
        )]
    ).first().asDict()
    silver = store.keyed(silver_table(domain))
    stats = dict.fromkeys(STAT_COLUMNS, 0)
    stats["already_processed"] = silver.count()  # from the files' footers
    if not pending.isEmpty():
        done = silver if rescan else unlogged(store, domain, logged)
        new = settle_loads(store, domain, as_of, pending, uuid.uuid4().hex, silver, done, log_loads=not rescan)
        stats["inserted"] = new["inserted"]
    else:
        new = dict.fromkeys(before, 0)
    stats["bronze_rows"] = before["bronze_rows"] + new["bronze_rows"]
    for reason in ("invalid_primary_key", "missing_first_name", "duplicate_primary_key"):
        stats[reason] = before[reason] + new[reason]
        stats["rejected"] += stats[reason]
    return stats


def process_all(store: TableStore, as_of: dt.date, rescan: bool = False) -> DataFrame:
    """All four domains; one row of counts each and a TOTAL row."""
    rows = []
    for name in DOMAINS:
        stats = process_domain(store, name, as_of, rescan)
        rows.append((name, *[stats[c] for c in STAT_COLUMNS]))
    schema = "domain string, " + ", ".join(f"{c} bigint" for c in STAT_COLUMNS)
    return with_totals(store.spark.createDataFrame(rows, schema))
