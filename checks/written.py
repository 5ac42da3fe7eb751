"""The retailer's layers written to a lake, as a job would: landing files, silver, gold, streams."""

from __future__ import annotations

import uuid
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.plans import gold, warehouse
from bazaarlake.sources.tables import Lake, shared_folder
from checks.landing import Retailer

_built: dict[tuple[str, str], Lake] = {}
_lock = Lock()


def scratch(r: Retailer) -> str:
    """A new folder for one query's files."""
    return f"{shared_folder(r.spark)}/bazaarlake-checks-{uuid.uuid4().hex}"


def landed(r: Retailer, **instead: DataFrame) -> Lake:
    """A lake whose bronze is the landing layer; ``instead`` replaces tables."""
    lake = Lake(r.spark, scratch(r))
    for name in contract.TABLES:
        lake.write(instead.get(name, r.bronze[name]), "bronze", name)
    return lake


def built(r: Retailer, upto: str = "gold") -> Lake:
    """Bronze, silver and gold of a folder, or the layers ``upto`` one of them, each written once a session."""
    key = (r.spark.sparkContext.applicationId, r.folder)
    with _lock:
        if key not in _built or not _built[key].exists("bronze", "fait_retours"):
            _built[key] = landed(r)
        lake = _built[key]
        if upto != "bronze" and not lake.exists("silver", "fait_retours"):
            warehouse.run_silver(lake, audit=False)
        if upto == "gold" and not lake.exists("gold", "fait_retours"):
            warehouse.run_gold(lake, audit=False)
        return lake


def silver_copy(r: Retailer, **changes) -> Lake:
    """A lake of its own with silver, whose landed tables go once silver stands; ``changes`` maps tables to what is done to them."""
    lake = landed(r)
    warehouse.run_silver(lake, audit=False)
    for name in contract.TABLES:
        lake.drop("bronze", name)
    if changes:
        with lake.refresh("silver", keep=1) as out:
            for name in contract.TABLES:
                rows = lake.read("silver", name)
                out.write(changes[name](rows) if name in changes else rows, "silver", name)
    return lake


def numbered(r: Retailer, table: str) -> DataFrame:
    """One gold fact, staged in files of its own, with the line keys that follow from its keys."""
    staged, _ = gold.stage(r.gold[table], f"{scratch(r)}/{table}")
    return gold.key_lines(staged, table)


def key_facts(lake: Lake) -> DataFrame:
    """Rows, least, greatest and number of distinct line keys of each numbered gold fact."""
    out = None
    for table in gold.LINE_KEYED:
        key = gold.SURROGATE[table]
        row = lake.read("gold", table).agg(
            F.count(F.lit(1)).alias("nb_lignes"), F.min(key).alias("sk_min"), F.max(key).alias("sk_max"),
            F.count_distinct(key).alias("nb_sk"),
        ).select(F.lit(table).alias("table_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out
