"""What the deletion of some rows does to all tables that refer to them, through any number of levels.

``delete_closure`` starts from chosen rows of one table or more and follows the
references between tables: CASCADE deletes the referring row, which may be
referred to itself; SET NULL clears its reference; RESTRICT forbids the whole
deletion. A table may refer to itself, and rows may refer to each other in a
circle.

Only the keys of tables that others refer to are followed level by level; each
level meets the tables with the keys found in the level before it, and what was
found is stored in the shared folder. All other tables are read once, when
their rows' fates are asked for. No side of a join is forced to be broadcast,
so a parent with very many children can be split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.operators.constraints import DeletionRefused
from cartwright.runtime import materialize
from cartwright.sources import schemas as S

ACTIONS = ("cascade", "set_null", "restrict", "no_action")
#: Levels of keys found so far are joined into one stored table when there are this many.
_MERGE_PARTS = 8


@dataclass(frozen=True)
class Reference:
    """``child.column`` refers to ``parent.key``; ``action`` is what a parent's deletion does.

    RESTRICT refuses if a referring row exists that is not itself one of the
    chosen rows, even if a cascade would delete it; NO ACTION refuses only for
    rows that would stay.
    """

    child: str
    column: str
    parent: str
    key: str
    action: str

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"{self.action} is not one of {', '.join(ACTIONS)}")


def schema_references(foreign_keys: Mapping[str, Sequence[tuple[str, str, str, str]]] = S.FOREIGN_KEYS) -> list[Reference]:
    """The references of the retail tables."""
    return [Reference(child, *rest) for child, found in foreign_keys.items() for rest in found]


@dataclass(frozen=True)
class DeleteClosure:
    """Tables, chosen keys and all deleted keys of the tables that others refer to."""

    tables: Mapping[str, DataFrame]
    references: Sequence[Reference]
    keys: Mapping[str, str]
    chosen: Mapping[str, DataFrame]
    deleted: Mapping[str, DataFrame]

    def fates(self, table: str) -> DataFrame:
        """All rows of ``table`` with booleans ``__chosen``, ``__cascaded``, ``__blocking`` and ``__null_<column>``.

        ``__cascaded``: deleted by a reference. ``__blocking``: forbids the
        deletion. ``__null_<column>``: the row stays and loses this reference.
        """
        rows = self.tables[table]
        marks: dict[str, Column] = {}

        def mark(name: str, column: str, gone: DataFrame | None, key: str) -> None:
            nonlocal rows
            if gone is None:
                marks[name] = F.lit(False)
                return
            rows = rows.join(gone.select(F.col(key).alias(name)), F.col(column) == F.col(name), "left")
            marks[name] = F.col(name).isNotNull()

        mark("__mark", self.keys[table], self.chosen.get(table), self.keys[table])
        own = [r for r in self.references if r.child == table]
        for i, r in enumerate(own):
            mark(f"__mark{i}", r.column, self.deleted.get(r.parent), r.key)

        def any_of(action: str) -> Column:
            hits = [marks[f"__mark{i}"] for i, r in enumerate(own) if r.action == action]
            return reduce(Column.__or__, hits, F.lit(False))

        chosen, cascaded = marks["__mark"], any_of("cascade")
        stays = ~(chosen | cascaded)
        blocking = (any_of("restrict") & ~chosen) | (any_of("no_action") & stays)
        cleared = [
            (stays & marks[f"__mark{i}"]).alias(f"__null_{r.column}") for i, r in enumerate(own) if r.action == "set_null"
        ]
        return rows.select(
            *self.tables[table].columns,
            chosen.alias("__chosen"), cascaded.alias("__cascaded"), blocking.alias("__blocking"), *cleared,
        )

    def summary(self) -> DataFrame:
        """One row per table: rows deleted by choice, by cascade, with a cleared reference, blocking, and remaining."""

        def counted(table: str) -> DataFrame:
            fates = self.fates(table)
            nulled = reduce(Column.__or__, [F.col(c) for c in fates.columns if c.startswith("__null_")], F.lit(False))
            gone = F.col("__chosen") | F.col("__cascaded")
            return fates.agg(
                F.count_if("__chosen").alias("deleted_rows"),
                F.count_if(F.col("__cascaded") & ~F.col("__chosen")).alias("cascaded_rows"),
                F.count_if(nulled).alias("cleared_rows"),
                F.count_if("__blocking").alias("blocking_rows"),
                F.count_if(~gone).alias("remaining_rows"),
            ).select(F.lit(table).alias("table_name"), "*")

        return reduce(DataFrame.unionByName, [counted(t) for t in self.tables])

    def blocking(self) -> dict[str, DataFrame]:
        """The rows that forbid the deletion, of every table that can hold some."""
        able = {r.child for r in self.references if r.action in ("restrict", "no_action") and r.parent in self.deleted}
        return {t: self.fates(t).filter("__blocking").select(*self.tables[t].columns) for t in self.tables if t in able}

    def remaining(self) -> dict[str, DataFrame]:
        """All tables after the deletion. Raises ``DeletionRefused``, naming the tables, if rows forbid it."""
        refusing = [table for table, rows in self.blocking().items() if not rows.isEmpty()]
        if refusing:
            raise DeletionRefused(f"rows of {', '.join(refusing)} still refer to rows that would be deleted")
        return {t: self._remaining(t) for t in self.tables}

    def _remaining(self, table: str) -> DataFrame:
        fates = self.fates(table).filter(~F.col("__chosen") & ~F.col("__cascaded"))

        def column(name: str) -> Column:
            # Several references may share a column; any of them clears it.
            if f"__null_{name}" not in fates.columns:
                return F.col(name)
            return F.when(~F.col(f"__null_{name}"), F.col(name)).alias(name)

        return fates.select(*[column(c) for c in self.tables[table].columns])


def delete_closure(
    tables: Mapping[str, DataFrame],
    chosen: Mapping[str, DataFrame],
    *,
    references: Sequence[Reference] | None = None,
    keys: Mapping[str, str] | None = None,
) -> DeleteClosure:
    """Everything that the deletion of ``chosen`` rows would delete, clear or run into.

    ``chosen`` holds rows, or the keys alone, of some of ``tables``. ``keys``
    names each table's key, by default the first unique key of the retail
    tables; references must refer to it. References to tables that are not
    given are left out. NULL references refer to nothing, and rows without a
    key can only be deleted by a reference.
    """
    keys = {t: (keys or {}).get(t) or S.UNIQUE_KEYS[t][0] for t in tables}
    followed = [r for r in (schema_references() if references is None else references) if {r.child, r.parent} <= set(tables)]
    for r in followed:
        if r.key != keys[r.parent]:
            raise ValueError(f"{r.child}.{r.column} refers to {r.parent}.{r.key}, which is not that table's key")

    def distinct_keys(rows: DataFrame, table: str) -> DataFrame:
        return rows.select(keys[table]).dropna().distinct()

    first = {t: materialize(distinct_keys(rows, t), f"delete-{t}") for t, rows in chosen.items()}
    found = {t: [part] for t, part in first.items()}
    parents = {r.parent for r in followed}
    level = first
    while level:
        reached: dict[str, list[DataFrame]] = {}
        for r in followed:
            if r.action == "cascade" and r.child in parents and r.parent in level:
                gone = level[r.parent].select(F.col(r.key).alias("__gone"))
                hit = tables[r.child].join(gone, F.col(r.column) == F.col("__gone"), "left_semi")
                reached.setdefault(r.child, []).append(distinct_keys(hit, r.child))
        level = {}
        for table, parts in reached.items():
            fresh = reduce(DataFrame.union, parts).distinct()
            for known in found.get(table, []):
                fresh = fresh.join(known, keys[table], "left_anti")
            fresh = materialize(fresh, f"delete-{table}")
            if fresh.isEmpty():
                continue
            level[table] = fresh
            known = [*found.get(table, []), fresh]
            if len(known) > _MERGE_PARTS:
                known = [materialize(reduce(DataFrame.union, known), f"delete-{table}")]
            found[table] = known
    deleted = {t: reduce(DataFrame.union, parts) for t, parts in found.items()}
    return DeleteClosure(tables, followed, keys, first, deleted)
