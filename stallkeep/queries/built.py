"""The warehouse the fact, dimension and validation queries read.

It is built once per session and data directory, by the library's own refresh
over the role views, into the shared scratch folder.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from stallkeep.plans.refresh import STAGING, Refresh
from stallkeep.queries.roles import order_lines, role
from stallkeep.session import release, scratch_path, write_scratch
from stallkeep.sources.store import Store

_staged: dict[tuple[str, str], Store] = {}
_staged_tables: dict[tuple[str, str], dict[str, DataFrame]] = {}
_built: dict[tuple[str, str], dict[str, DataFrame]] = {}
_lock = threading.RLock()


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/")


def staged_store(spark: SparkSession, sf_dir: str) -> Store:
    """The role views as published staging tables."""
    key = _key(spark, sf_dir)
    with _lock:
        if key not in _staged:
            store = Store(spark, scratch_path(spark, "warehouse"))
            run = store.new_run()
            # Three roles read the order lines: they are grouped once.
            lines, lines_path = write_scratch(order_lines(spark, sf_dir), "order-lines")
            release(spark)
            with ThreadPoolExecutor(max_workers=4) as pool:
                writes = [pool.submit(store.write, run, name, role(spark, sf_dir, name, lines)) for name in STAGING]
                for done in writes:
                    done.result()
            release(spark, lines_path)
            store.publish(run, STAGING)
            _staged[key] = store
        return _staged[key]


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = _key(spark, sf_dir)
    with _lock:
        if key not in _staged_tables:
            _staged_tables[key] = staged_store(spark, sf_dir).tables()
        return _staged_tables[key]


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Staging, conformed, dimension and fact tables by name."""
    key = _key(spark, sf_dir)
    with _lock:
        if key not in _built:
            _built[key] = dict(Refresh(staged_store(spark, sf_dir)).build())
        return _built[key]
