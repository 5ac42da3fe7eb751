"""Key lookups: a fact joined to a parent that is unique on its key.

Each lookup is one join, so the fact stands once in the plan, and building it runs no job. Spark picks the strategy at
run time from real sizes (``autoBroadcastJoinThreshold``, adaptive execution) and splits skewed partitions. Where a key is
known to hold a large part of the fact, ``salts`` spreads it beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Lookup:
    """A parent table reduced to a unique key and the attributes to attach.

    ``salts`` above 1 spreads every key of the fact over that many join keys and repeats the parent's rows as often.
    ``strategy`` is a join hint such as ``merge``; without it Spark chooses. ``one_row`` takes one row per key by an
    aggregate. Its shuffle gives Spark the real size of a parent whose estimate is far too large, so the fact is not shuffled to
    meet a few rows; and as the key is known to be unique, Spark leaves a left join out where no attribute is read.
    """

    def __init__(
        self, parent: DataFrame, key: str, attributes: list[str], salts: int = 1, strategy: str | None = None,
        one_row: bool = False,
    ):
        self.key = key
        self.attributes = attributes
        self.salts = salts
        rows = parent.select(key, *attributes)
        if one_row:
            rows = rows.groupBy(key).agg(*[F.min(c).alias(c) for c in attributes])
        if salts > 1:
            rows = rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        self.rows = rows.hint(strategy) if strategy else rows

    def attach(self, fact: DataFrame, how: str = "inner") -> DataFrame:
        """``fact`` with the attributes added; ``how`` is ``inner`` or ``left``."""
        if how not in ("inner", "left"):
            raise ValueError(f"unsupported lookup join: {how}")
        if self.salts == 1:
            return fact.join(self.rows, self.key, how)
        # The salt depends on the row alone, so a retried task deals it the same way.
        salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(self.salts)).cast("int"))
        return salted.join(self.rows, [self.key, "_salt"], how).drop("_salt")


def flag_orphans(
    fact: DataFrame, fk: str, parent: DataFrame, pk: str, flag: str, salts: int = 1, strategy: str | None = None
) -> DataFrame:
    """Adds the boolean ``flag``: the key is set and no parent row carries it. The parent may repeat its key."""
    keys = parent.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull()).distinct().withColumn("_found", F.lit(True))
    found = Lookup(keys, fk, ["_found"], salts, strategy).attach(fact, "left")
    missing = F.col(fk).isNotNull() & F.col("_found").isNull()
    return found.select(*fact.columns, missing.alias(flag))


def orphan_keys(fact: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """The distinct keys of ``fact`` that no parent row carries. Only keys are shuffled, counted once inside each task."""
    keys = fact.select(fk).where(F.col(fk).isNotNull()).distinct()
    return keys.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def flag_listed(fact: DataFrame, fk: str, orphans: DataFrame, flag: str) -> DataFrame:
    """Adds the boolean ``flag`` as ``flag_orphans`` does, from the fact's ``orphan_keys``."""
    listed = Lookup(orphans.withColumn("_listed", F.lit(True)), fk, ["_listed"]).attach(fact, "left")
    return listed.select(*fact.columns, F.col("_listed").isNotNull().alias(flag))


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str, salts: int = 1) -> DataFrame:
    """Child rows whose key is set but not in the parent; ``salts`` spreads a key that many rows share."""
    flagged = flag_orphans(child, fk, parent, pk, "_orphan", salts)
    return flagged.where("_orphan").select(*child.columns)


def matched_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str, salts: int = 1) -> DataFrame:
    """Child rows whose key is in the parent; ``salts`` as above."""
    flagged = flag_orphans(child, fk, parent, pk, "_orphan", salts)
    return flagged.where(~F.col("_orphan") & F.col(fk).isNotNull()).select(*child.columns)


def with_default(
    df: DataFrame, values: DataFrame, key: str, column: str, default
) -> DataFrame:
    """Writes ``values.column`` back into ``df`` by key; keys without a value get ``default``."""
    computed = values.select(key, F.col(column).alias("_computed"))
    joined = Lookup(computed, key, ["_computed"]).attach(df.drop(column), "left")
    return joined.withColumn(column, F.coalesce(F.col("_computed"), F.lit(default))).drop("_computed")
