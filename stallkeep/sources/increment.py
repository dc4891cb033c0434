"""Incremental staging loads: a watermark per data set, months that are replaced, digests beside them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeep.operators.changes import DIGEST, INSERT, UNCHANGED, UPDATE, row_digest
from stallkeep.operators.joins import spread_join
from stallkeep.session import scratch_path
from stallkeep.sources.contracts import Contract
from stallkeep.sources.ingest import check_key
from stallkeep.sources.store import Store

# The column that tells when a row of a data set came about.
MARKS = {
    "orders": "order_purchase_timestamp",
    "order_items": "shipping_limit_date",
    "reviews": "review_creation_date",
}
LEDGER = "LoadMarks"
_LEDGER_SCHEMA = "Dataset string, HighMark timestamp_ntz, RowsRead long"
LOOKBACK = timedelta(days=30)


@dataclass(frozen=True)
class Increment:
    """What one load of a data set did."""

    dataset: str
    rows_read: int
    inserted: int
    updated: int
    unchanged: int
    late: int  # inserted below the mark of the load before
    replaced: tuple[str, ...]  # months written anew
    kept: tuple[str, ...]  # months whose files stayed

    def row(self) -> dict:
        return asdict(self)


def month_of(mark: Column) -> Column:
    return F.date_format(mark, "yyyyMM")


def digest_table(dataset: str) -> str:
    return f"{dataset}.digests"


def marks(store: Store) -> dict[str, tuple[datetime | None, int]]:
    """High mark and rows read so far of every data set that was loaded; one row each."""
    if LEDGER not in store.published():
        return {}
    return {r.Dataset: (r.HighMark, r.RowsRead) for r in store.table(LEDGER).collect()}


def load_increment(store: Store, source: DataFrame, contract: Contract, mark: str | None = None, lookback: timedelta = LOOKBACK) -> Increment:
    """Bring the staging table of a data set up to its source, reading no more than it must.

    Of the source only rows at or above the high mark of the last load, less
    ``lookback`` for rows that come late or change, are read, and rows without a
    mark; the condition is a plain comparison, so a columnar source skips the
    rest. Keys are gated as in a full load. Digests of the keys loaded before,
    kept beside the table, tell new and changed rows from known ones, and in
    which month a changed row lies. Only months with such rows are read and
    written; every other month keeps its files. Table parts, digests and the new
    mark become visible in one commit, so a load that fails changes nothing, and
    one that finds nothing new moves the mark at most.

    Rows below the mark less ``lookback`` are not seen again, nor are rows that
    vanish from the source. The number of months is bounded by the calendar.
    """
    spark, name, key = store.spark, contract.name, list(contract.key)
    mark = mark or MARKS[name]
    ledger = marks(store)
    high, read_before = ledger.get(name, (None, 0))
    if high is not None:
        source = source.filter((F.col(mark) >= F.lit(high - lookback)) | F.col(mark).isNull())
    path = scratch_path(spark, f"increment-{name}")
    month = F.coalesce(month_of(F.col(mark)), F.lit("none"))
    columns = contract.column_names
    source.select(*columns, month.alias("_month"), row_digest([c for c in columns if c not in key]).alias(DIGEST)).write.parquet(path)
    batch = spark.read.parquet(path)
    check_key(batch, contract)

    parts, digest_parts = store.parts(name), store.parts(digest_table(name))
    found = batch.select(*key, mark, "_month", DIGEST)
    if digest_parts:
        known = store.read_parts(list(digest_parts.values())).select(*key, F.col("_month").alias("_was"), F.col(DIGEST).alias("_old"))
        # A batch of checked small size is broadcast: then no digest of other keys moves.
        found = found.join(spread_join(known, batch.select(*key), key, "left_semi"), key, "left")
    else:
        found = found.withColumns({"_was": F.lit(None).cast("string"), "_old": F.lit(None).cast("binary")})
    kind = F.when(F.col("_old").isNull(), INSERT).when(F.col("_old") == F.col(DIGEST), UNCHANGED).otherwise(UPDATE)
    path = scratch_path(spark, f"change-{name}")
    found.withColumn("Change", kind).write.parquet(path)
    found = spark.read.parquet(path)
    changed = found.filter(F.col("Change") != UNCHANGED)

    is_kind = {k: F.count(F.when(F.col("Change") == k, 1)) for k in (INSERT, UPDATE, UNCHANGED)}
    late = F.count(F.when((F.col("Change") == INSERT) & (F.col(mark) < F.lit(high)), 1)) if high is not None else F.lit(0)
    counts = found.agg(F.count("*"), *is_kind.values(), late, F.max(mark)).first()
    touched = sorted(r[0] for r in changed.select(F.explode(F.array("_month", F.coalesce("_was", "_month"))).alias("m")).distinct().collect())

    run = store.new_run()
    replaced: dict[str, Mapping[str, str | None]] = {}
    keys = changed.select(*key)
    if touched:
        tables = {
            name: (spread_join(batch, keys, key, "left_semi").select(*columns), parts, month),
            digest_table(name): (changed.select(*key, "_month", DIGEST), digest_parts, F.col("_month")),
        }
        for table, (fresh, there, part) in tables.items():
            old = [there[m] for m in touched if m in there]
            if old:
                fresh = fresh.unionByName(spread_join(store.read_parts(old), keys, key, "left_anti"))
            written = store.write_parts(run, table, fresh, part)
            # A month that lost its last row is gone.
            replaced[table] = {m: written.get(m) for m in touched}
    top = counts[-1] if high is None else max(high, counts[-1]) if counts[-1] is not None else high
    ledger[name] = (top, read_before + counts[0])
    if touched or top != high:
        rows = [(d, h, n) for d, (h, n) in sorted(ledger.items())]
        store.write(run, LEDGER, spark.createDataFrame(rows, _LEDGER_SCHEMA).coalesce(1))
        store.publish(run, [LEDGER], replaced)
    return Increment(name, *counts[:5], tuple(touched), tuple(sorted(set(parts) - set(touched))))
