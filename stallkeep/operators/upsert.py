"""Dimensions that grow: members keep their surrogate keys from load to load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.operators.keys import number_rows
from stallkeep.operators.rules import ValidationError

# Not one of the fixed rule codes, which end below 52000.
UPSERT_CODE = 52001


def upsert_members(existing: DataFrame, members: DataFrame, business_key: str, surrogate_key: str) -> DataFrame:
    """The dimension after a load of ``members``, which have no surrogate key yet.

    ``existing`` is the loaded dimension, which is the ledger of its keys. A known
    member keeps its key and takes the new attributes; a member that ``members``
    lacks, and the Unknown member, stay as they are. New members are numbered in
    the order of their business key, without a gap above the highest key. The
    order comes from a sort across partitions, so no task sees all members.
    A business key that is NULL or occurs twice in ``members`` fails the load.
    """
    columns = existing.columns
    sizes = members.groupBy(business_key).agg(F.count("*").alias("_rows"))
    bad = sizes.filter(F.col(business_key).isNull() | (F.col("_rows") > 1)).count()
    if bad:
        raise ValidationError(surrogate_key, UPSERT_CODE, f"upsert aborted: {bad} values of {business_key} are NULL or repeated.")
    ledger = existing.filter(F.col(surrogate_key) != 0).select(business_key, surrogate_key)
    known = members.join(ledger, business_key)
    gone = existing.join(members.select(business_key), business_key, "left_anti")
    highest = existing.agg(F.coalesce(F.max(surrogate_key), F.lit(0))).first()[0]
    new = number_rows(members.join(ledger.select(business_key), business_key, "left_anti"), [business_key], surrogate_key)
    new = new.withColumn(surrogate_key, (F.col(surrogate_key) + F.lit(highest)).cast(existing.schema[surrogate_key].dataType))
    return gone.select(*columns).unionByName(known.select(*columns)).unionByName(new.select(*columns))
