"""Versions of dimension members over time, and the version that was valid at a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.operators.changes import DIGEST, row_digest
from stallkeep.operators.keys import place_in_order

VALID_FROM, VALID_TO, VERSION = "ValidFrom", "ValidTo", "Version"


def open_history(members: DataFrame, at: Column) -> DataFrame:
    """The first version of every member, valid from ``at`` on."""
    return members.select("*", at.alias(VALID_FROM), F.lit(None).cast(members.select(at.alias("a")).schema[0].dataType).alias(VALID_TO), F.lit(1).alias(VERSION))


def advance_history(history: DataFrame, members: DataFrame, key: Sequence[str], at: Column) -> DataFrame:
    """The history after a load of ``members`` at ``at``.

    The open version of a member whose attributes differ is closed at ``at`` and a
    new one opened there; a member that ``members`` lacks is closed; one that is
    new, or was closed before, is opened. Versions of a member are numbered from
    1 and never overlap. Closed versions are not compared and not changed. NULLs
    in keys and attributes are values like any other; a key that ``members`` has
    twice fails the job. ``at`` must lie behind all versions.
    """
    key, columns = list(key), members.columns
    attributes = [c for c in columns if c not in key]
    digest = row_digest(attributes) if attributes else F.lit(b"")
    closed, opened = history.filter(f"{VALID_TO} is not null"), history.filter(f"{VALID_TO} is null")
    side = F.struct(*[F.col(f"`{c}`") for c in columns], digest.alias(DIGEST))
    versions = closed.groupBy(*key).agg(F.max(VERSION).alias("_closed"))
    nothing = F.lit(None).cast(history.schema[VALID_FROM].dataType)
    empty = F.lit(None)
    tagged = [
        opened.select(*key, side.alias("_old"), empty.alias("_new"), VALID_FROM, VERSION, empty.cast("int").alias("_closed")),
        members.select(*key, empty.alias("_old"), side.alias("_new"), nothing.alias(VALID_FROM), empty.cast("int").alias(VERSION), empty.cast("int").alias("_closed")),
        versions.select(*key, empty.alias("_old"), empty.alias("_new"), nothing.alias(VALID_FROM), empty.cast("int").alias(VERSION), "_closed"),
    ]
    kind = tagged[0].schema["_old"].dataType
    tagged = [t.withColumns({"_old": F.col("_old").cast(kind), "_new": F.col("_new").cast(kind)}) for t in tagged]
    met = tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).groupBy(*key).agg(
        F.first("_old", ignorenulls=True).alias("_old"), F.first("_new", ignorenulls=True).alias("_new"), F.count("_new").alias("_rows"),
        F.max(VALID_FROM).alias(VALID_FROM), F.max(VERSION).alias(VERSION), F.max("_closed").alias("_closed"),
    )
    repeated = F.raise_error(F.concat(F.lit("repeated key: "), F.concat_ws(",", *key))).cast("boolean")
    same = F.when(F.col("_rows") > 1, repeated).otherwise(F.coalesce(F.col(f"_old.{DIGEST}") == F.col(f"_new.{DIGEST}"), F.lit(False)))

    def version(of: str, start: Column, end: Column, number: Column) -> Column:
        row = F.struct(*[F.col(of)[c].alias(c) for c in columns], start.alias(VALID_FROM), end.alias(VALID_TO), number.cast("int").alias(VERSION))
        return F.when(F.col(of).isNotNull(), row)

    moment = at.cast(history.schema[VALID_FROM].dataType)
    kept = F.when(same, version("_old", F.col(VALID_FROM), nothing, F.col(VERSION))).otherwise(version("_old", F.col(VALID_FROM), moment, F.col(VERSION)))
    last = F.greatest(F.coalesce(VERSION, F.lit(0)), F.coalesce("_closed", F.lit(0)))
    added = F.when(~same, version("_new", moment, nothing, last + 1))
    current = met.select(F.explode(F.filter(F.array(kept, added), lambda v: v.isNotNull())).alias("v")).select("v.*")
    return closed.select(*current.columns).unionByName(current)


def valid_at(rows: DataFrame, history: DataFrame, key: Sequence[str], time: str, columns: Sequence[str]) -> DataFrame:
    """rows with ``columns`` of the version of their key that was valid at ``time``, NULL without one.

    A version is valid from VALID_FROM up to, not including, VALID_TO. Rows and
    versions are sorted together across partitions; a row takes the last version
    before it. Only the versions that hold on into later partitions are handed
    over, one for each partition and key that goes on, so a hot key is spread and
    no row meets more than one version. A row with a NULL time has no version;
    NULLs in a key match nothing.
    """
    key = list(key)
    held = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)], F.col(VALID_TO).alias("until"))
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    names = [f"_k{i}" for i in range(len(key))]
    keyed = [F.col(f"`{k}`").alias(n) for k, n in zip(key, names, strict=True)]
    versions = history.dropna(subset=key).select(*keyed, F.col(VALID_FROM).alias("_at"), held.alias("_held"), F.lit(None).cast(rows.select(row.alias("r")).schema[0].dataType).alias("_row"))
    asked = rows.select(*keyed, F.col(f"`{time}`").cast(history.schema[VALID_FROM].dataType).alias("_at"), F.lit(None).cast(versions.schema["_held"].dataType).alias("_held"), row.alias("_row"))
    both = versions.unionByName(asked).withColumns({"_is_row": F.col("_row").isNotNull(), "_spread": F.xxhash64("_row")})
    # Rows with one key and one time may be many: their hash lets the sort cut between them.
    placed = place_in_order(both, [*names, "_at", "_is_row", "_spread"])
    ends = placed.groupBy(*names, "_part").agg(F.max_by("_held", F.when(~F.col("_is_row"), F.col("_position"))).alias("_last"))
    earlier = F.last("_last", ignorenulls=True).over(Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # At most one key of a partition began in an earlier one.
    carried = ends.select(*names, "_part", earlier.alias("_carried")).filter("_carried is not null")
    before = F.last("_held", ignorenulls=True).over(Window.partitionBy("_part", *names).orderBy("_position").rowsBetween(Window.unboundedPreceding, 0))
    found = placed.withColumn("_here", before).filter("_is_row").join(F.broadcast(carried), [*names, "_part"], "left")
    version = F.coalesce("_here", "_carried")
    valid = F.col("_at").isNotNull() & (version["until"].isNull() | (F.col("_at") < version["until"]))
    return found.select("_row.*", *[F.when(valid, version[f"v{i}"]).alias(c) for i, c in enumerate(columns)])
