"""Keys, checks and references as an ingest job.

Spark tables do not refuse bad rows, so a load runs its rows through
``flag_violations`` and keeps the ones without a reason. As in SQL, a rule that
evaluates to NULL is not violated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import labels as L
from cartwright.runtime import materialize
from cartwright.sources import schemas as S

REASONS = "reject_reasons"

# From so many repeated keys on they are joined by hash tables of one partition
# each; below, Spark knows their size and broadcasts them if it is small.
MANY_REPEATED = 1_000_000


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"{self.column} is missing"


@dataclass(frozen=True)
class Check:
    """``holds`` must not be false."""

    name: str
    holds: Column


@dataclass(frozen=True)
class MaxLength:
    column: str
    limit: int

    @property
    def name(self) -> str:
        return f"{self.column} is longer than {self.limit}"


@dataclass(frozen=True)
class Unique:
    """Every row that shares its key with another one is in violation; NULL keys are free."""

    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{', '.join(self.columns)} is not unique"


@dataclass(frozen=True)
class ForeignKey:
    """The value must exist in ``parent``; NULL needs no parent."""

    column: str
    parent: DataFrame
    parent_column: str

    @property
    def name(self) -> str:
        return f"{self.column} has no parent row"


Rule = NotNull | Check | MaxLength | Unique | ForeignKey


def flag_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reasons``: the names of the rules that a row violates.

    Row rules are evaluated in place. Each key or reference rule adds one join
    against a table with one row per key, in which Spark splits the partitions
    of a hot key. The repeated keys of a key rule are found and stored right
    away: where they are few, which is usual, no row is shuffled for the join.
    """
    flagged = df
    reasons: list[Column] = []
    broken = F.lit(False)
    helpers: list[str] = []
    for number, rule in enumerate(rules):
        mark = f"__mark{number}"
        if isinstance(rule, Unique):
            flagged = _mark_duplicates(flagged, df, rule, mark)
            violated = F.col(mark).isNotNull()
            helpers.append(mark)
        elif isinstance(rule, ForeignKey):
            flagged = _mark_known(flagged, rule, mark)
            violated = F.col(rule.column).isNotNull() & F.col(mark).isNull()
            helpers.append(mark)
        elif isinstance(rule, NotNull):
            violated = F.col(rule.column).isNull()
        elif isinstance(rule, MaxLength):
            violated = F.length(rule.column) > rule.limit
        else:
            violated = ~rule.holds
        reasons.append(F.when(violated, F.lit(rule.name)))
        broken = broken | violated
    # The list is made for the few rows that have one.
    found = F.when(broken, F.array_compact(F.array(*reasons)))
    return flagged.withColumn(REASONS, F.coalesce(found, F.array().cast("array<string>"))).drop(*helpers)


def _mark_duplicates(flagged: DataFrame, source: DataFrame, rule: Unique, mark: str) -> DataFrame:
    keys = [f"{mark}_k{i}" for i, _ in enumerate(rule.columns)]
    repeated = (
        source.select([F.col(c).alias(k) for c, k in zip(rule.columns, keys)])
        .dropna()
        .groupBy(*keys)
        .agg(F.count("*").alias(mark))
        .filter(F.col(mark) > 1)
    )
    repeated = materialize(repeated, "repeated-keys")
    if repeated.count() >= MANY_REPEATED:
        repeated = repeated.hint("shuffle_hash")
    same = [F.col(c) == F.col(k) for c, k in zip(rule.columns, keys)]
    return flagged.join(repeated, same, "left").drop(*keys)


def _mark_known(flagged: DataFrame, rule: ForeignKey, mark: str) -> DataFrame:
    key = f"{mark}_k"
    known = (
        rule.parent.select(F.col(rule.parent_column).alias(key))
        .dropna()
        .distinct()
        .withColumn(mark, F.lit(True))
    )
    return flagged.join(known, F.col(rule.column) == F.col(key), "left").drop(key)


def enforce(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every rule, and the others with their reasons.

    Both results stem from one flagged plan; store that first when both are
    going to be written (``sources.loading.load_tables`` does).
    """
    return split(flag_violations(df, rules))


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    clean = F.size(REASONS) == 0
    return flagged.filter(clean).drop(REASONS), flagged.filter(~clean)


# ------------------------------------------------------- rules of the schema


def _at_least_zero(*columns: str) -> list[Check]:
    return [Check(f"{c} is negative", F.col(c) >= 0) for c in columns]


def _one_of(column: str, values: list[str]) -> Check:
    return Check(f"{column} is not a known value", F.col(column).isin(values))


def _checks(table: str) -> list[Check]:
    if table == "customers":
        return [_one_of("acquisition_channel", L.ACQUISITION_CHANNELS)]
    if table == "products":
        return [
            *_at_least_zero("cost_price", "stock_quantity"),
            Check("sale_price is below cost_price", F.col("sale_price") >= F.col("cost_price")),
        ]
    if table == "orders":
        return [
            _one_of("order_status", L.ORDER_STATUSES),
            *_at_least_zero("subtotal_amount", "shipping_fee", "discount_amount", "total_amount"),
            Check(
                "delivery_date is before order_date",
                F.col("delivery_date") >= F.col("order_date"),
            ),
        ]
    if table == "order_items":
        return [
            Check("quantity is not positive", F.col("quantity") > 0),
            *_at_least_zero("unit_price", "cost_price", "item_discount"),
        ]
    if table == "payments":
        return [
            _one_of("payment_method", L.PAYMENT_METHODS),
            _one_of("payment_status", L.PAYMENT_STATUSES),
            *_at_least_zero("amount"),
        ]
    if table == "reviews":
        return [Check("rating is not 1 to 5", F.col("rating").between(1, 5))]
    return []


def row_rules(table: str) -> list[Rule]:
    """Rules of one table that need no other row."""
    return [
        *[NotNull(c) for c in S.REQUIRED[table]],
        *[MaxLength(c, n) for c, n in S.MAX_LENGTHS[table].items()],
        *_checks(table),
    ]


def table_rules(table: str, tables: dict[str, DataFrame]) -> list[Rule]:
    """All rules of one table, references included."""
    return [
        *row_rules(table),
        *[Unique((c,)) for c in S.UNIQUE_KEYS[table]],
        *[
            ForeignKey(column, tables[parent], key)
            for column, parent, key, _ in S.FOREIGN_KEYS[table]
        ],
    ]


# ------------------------------------------------------ deletion of parents


class DeletionRefused(RuntimeError):
    """Rows still refer to a parent whose deletion is restricted."""


def cascade_delete(child: DataFrame, column: str, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows that remain when their parents' deletion removes them."""
    return child.join(_keys(deleted, key, column), column, "left_anti")


def set_null_on_delete(child: DataFrame, column: str, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows with the reference to a deleted parent cleared."""
    gone = _keys(deleted, key, "__gone")
    kind = child.schema[column].dataType
    return (
        child.join(gone, F.col(column) == F.col("__gone"), "left")
        .withColumn(
            column,
            F.when(F.col("__gone").isNull(), F.col(column)).otherwise(F.lit(None).cast(kind)),
        )
        .drop("__gone")
    )


def restricting_rows(child: DataFrame, column: str, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows that forbid the deletion."""
    return child.join(_keys(deleted, key, column), column, "left_semi")


def refuse_if_referenced(child: DataFrame, column: str, deleted: DataFrame, key: str) -> None:
    """Raise when a restricted parent is still referred to."""
    if not restricting_rows(child, column, deleted, key).isEmpty():
        raise DeletionRefused(f"{column} still refers to rows that would be deleted")


def _keys(deleted: DataFrame, key: str, alias: str) -> DataFrame:
    return deleted.select(F.col(key).alias(alias)).dropna().distinct()
