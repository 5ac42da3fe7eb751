"""Declarative row rules, reference checks and table audits."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.functions.text import is_email, row_document
from bazaarlake.operators.joins import flag_listed, flag_orphans, orphan_keys

VERDICT = "_verdict"
OWN = "_own"
LANDED = "_landed"


@dataclass(frozen=True)
class Rule:
    """A SQL condition that makes a row invalid. An undecided (NULL) condition rejects too."""

    rule_id: str
    invalid: str
    reason: str

    @property
    def broken(self) -> str:
        return f"coalesce({self.invalid}, true)"


def missing(reason: str, *columns: str) -> list[Rule]:
    return [Rule(f"{c}_null", f"{c} IS NULL", reason) for c in columns]


def first_broken(rules: list[Rule], start: int = 1) -> Column:
    """Number (from ``start``) of the first broken rule, NULL when all hold.

    A bare number keeps the generated code of the hot path small; names are looked up for
    rejected rows only.
    """
    if not rules:
        return F.lit(None).cast("int")
    return F.expr("CASE " + " ".join(f"WHEN {r.broken} THEN {i}" for i, r in enumerate(rules, start)) + " END")


@dataclass(frozen=True)
class Assessed:
    """Rows with a verdict column and the rules its numbers stand for."""

    frame: DataFrame
    rules: tuple[Rule, ...]

    def _name(self, names: list[str]) -> Column:
        return F.get(F.array(*[F.lit(n) for n in names]), F.col(VERDICT) - 1)

    @property
    def reason(self) -> Column:
        return self._name([r.reason for r in self.rules])

    @property
    def rule_id(self) -> Column:
        return self._name([r.rule_id for r in self.rules])

    def accepted(self, columns: list[str]) -> DataFrame:
        return self.frame.where(F.col(VERDICT).isNull()).select(*columns)

    def rejected(self, table_name: str, document: Column) -> DataFrame:
        return self.frame.where(F.col(VERDICT).isNotNull()).select(
            F.lit(table_name).alias("table_name"),
            document.alias("record_data"),
            self.reason.alias("reason"),
            self.rule_id.alias("rule_id"),
        )


# --- one condition at a time -------------------------------------------------------


def split_invalid(
    df: DataFrame, invalid: Column, table_name: str, reason: str
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, reject records). Each row lands on exactly one side."""
    broken = F.coalesce(invalid, F.lit(True))
    rejected = df.where(broken).select(
        F.lit(table_name).alias("table_name"),
        row_document(df.columns).alias("record_data"),
        F.lit(reason).alias("reason"),
    )
    return df.where(~broken), rejected


def split_orphans(
    df: DataFrame,
    parent: DataFrame,
    fk: str,
    pk: str,
    table_name: str,
    reason: str,
    optional: bool = False,
    strategy: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows whose key resolves, reject records). ``optional`` accepts a NULL key."""
    flagged = flag_orphans(df, fk, parent, pk, "_orphan", strategy=strategy)
    broken = F.col("_orphan") if optional else F.col("_orphan") | F.col(fk).isNull()
    valid, rejected = flagged.where(~broken), flagged.where(broken)
    records = rejected.select(
        F.lit(table_name).alias("table_name"),
        row_document(df.columns).alias("record_data"),
        F.lit(reason).alias("reason"),
    )
    return valid.select(*df.columns), records


# --- the whole cascade in one pass --------------------------------------------------


def assess(
    df: DataFrame,
    rules: list[Rule],
    references: tuple[contract.Reference, ...] = (),
    parents: dict[str, DataFrame] | None = None,
    late_rules: list[Rule] | None = None,
    strategy: str | None = None,
    key: tuple[str, ...] = (),
    settle: Callable[[DataFrame, str], DataFrame] | None = None,
) -> Assessed:
    """Adds a verdict (NULL = accepted): the number of the first broken rule.

    Order: ``rules``, then the references, then ``late_rules``; the outcome equals
    applying them one after the other, with the rows read once. Parents are joined in another order: those of columns in the
    business ``key`` last, its first column at the very end, so rows dealt by that column stay where they are when copies of
    a key are dropped and when gold looks the column up.

    ``settle`` stores the orphan keys of a column and returns them as read back. Rows then meet these, which are few where most references
    hold, and not the parents. For rows that are read from files: their keys are read once more.
    """
    # Rules that read the row alone are judged before the joins: where only verdicts are asked for, just keys and this number are shuffled.
    late = late_rules or []
    first_late = len(rules) + len(references) + 1
    flagged = df.withColumn(OWN, F.coalesce(first_broken(rules), first_broken(late, first_late)))
    by_reference = []
    numbered = list(enumerate(references))
    for i, ref in sorted(numbered, key=lambda n: -key.index(n[1].column) if n[1].column in key else -len(key)):
        parent, flag = (parents or {})[ref.parent], f"_orphan_{i}"
        if settle:
            flagged = flag_listed(flagged, ref.column, settle(orphan_keys(df, ref.column, parent, ref.parent_key), ref.column), flag)
        else:
            flagged = flag_orphans(flagged, ref.column, parent, ref.parent_key, flag, strategy=strategy)
    for i, ref in numbered:
        flag = f"_orphan_{i}"
        broken = flag if ref.optional else f"{flag} OR {ref.column} IS NULL"
        by_reference.append(Rule(f"{ref.column}_orphan", broken, ref.reason))
    early = F.when(F.col(OWN) <= len(rules), F.col(OWN))
    verdict = F.coalesce(early, first_broken(by_reference, len(rules) + 1), F.col(OWN))
    return Assessed(flagged.select(*df.columns, verdict.alias(VERDICT)), (*rules, *by_reference, *late))


# --- rules drawn from the contract ---------------------------------------------------


def required_rules(table: contract.Table, skip: tuple[str, ...] = ()) -> list[Rule]:
    names = [c.name for c in table.columns if c.required and c.name not in skip]
    return missing(contract.CONTRACT_REASON, *names)


def length_rules(table: contract.Table) -> list[Rule]:
    return [
        Rule(
            f"{c.name}_too_long",
            f"coalesce(length({c.name}) > {c.length}, false)",
            contract.CONTRACT_REASON,
        )
        for c in table.columns
        if c.length
    ]


# --- audits ------------------------------------------------------------------------------


def key_audit(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Per table: rows, distinct keys and surplus rows."""
    parts = []
    for name, df in tables.items():
        per_key = df.groupBy(*keys[name]).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("nb_lignes"),
                F.count(F.lit(1)).alias("nb_cles"),
            ).select(
                F.lit(name).alias("table_name"),
                "nb_lignes",
                "nb_cles",
                (F.col("nb_lignes") - F.col("nb_cles")).alias("nb_surplus"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def rule_counts(df: DataFrame, table_name: str, rules: list[Rule]) -> DataFrame:
    """How many rows break each rule on its own, in one pass."""
    counts = df.agg(*[F.expr(f"count_if({r.broken})").alias(r.rule_id) for r in rules])
    return counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.col(r.rule_id).alias("nb_lignes")) for r in rules])
        ).alias("r")
    ).select(F.lit(table_name).alias("table_name"), "r.rule_id", "r.nb_lignes")


def error_profile(
    sales: DataFrame,
    customers: DataFrame,
    key: tuple[str, ...] = contract.SALES.key,
) -> DataFrame:
    """Duplicates, bad quantities, negative amounts and bad e-mails of typed rows."""
    keyed = sales.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("quantite") <= 0).alias("bad_quantity"),
        F.count_if(F.col("montant_ttc") < 0).alias("negative"),
    )
    totals = keyed.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("doublons"),
        F.coalesce(F.sum("bad_quantity"), F.lit(0)).alias("quantites_invalides"),
        F.coalesce(F.sum("negative"), F.lit(0)).alias("montants_negatifs"),
    )
    emails = customers.agg(
        F.count_if(~F.coalesce(is_email(F.col("email")), F.lit(False))).alias("emails_invalides")
    )
    return totals.select("*", emails.scalar().alias("emails_invalides"))


def reject_summary(rejects: DataFrame, by_rule: bool = False) -> DataFrame:
    columns = ["table_name", "reason"] + (["rule_id"] if by_rule else [])
    return rejects.groupBy(*columns).agg(F.count(F.lit(1)).alias("nb_rejets"))
