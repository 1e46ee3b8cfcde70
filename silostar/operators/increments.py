"""Duplicate and foreign-key checks that measure only what was not measured yet.

A table that grows by appends need not be checked as a whole again: the rows beyond the first
of each key are those of the earlier loads plus those that the new load adds, and so are the
orphans. A mark remembers, per rule, which folders of a table were measured together, what was
found, and in which folders the parents then were.

A mark counts as long as it must still be true: its folders are all part of the table, and

* for duplicates, the folders that were there before it are still the same;
* for orphans, the parents are the same, or nothing was found and they have only grown (more
  parents leave fewer orphans; less than none there is not).

All other folders are measured.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silostar.operators.checks import (
    KEY_DUPLICATES, KEY_RULES, PARENT_RULES, Rule, dealt, measure_duplicates, measure_orphans,
)
from silostar.operators.pruning import key_ranges, within

_TEXT, _FOLDERS = T.StringType(), T.ArrayType(T.StringType())
MARK_SCHEMA = T.StructType(
    [T.StructField(n, _TEXT) for n in ("tabla", "columna", "tipo_chequeo")]
    + [T.StructField(n, _FOLDERS) for n in ("carpetas", "anteriores", "padres")]
    + [T.StructField(n, T.LongType()) for n in ("total", "afectados")]
)


@dataclass(frozen=True)
class Mark:
    folders: frozenset[str]
    before: frozenset[str]
    parents: frozenset[str]
    total: int
    affected: int


def still_true(mark: Mark, rule: Rule, folders: set[str], parents: set[str], trusted: set[str]) -> bool:
    """``trusted`` are the folders of the marks accepted before this one."""
    if not mark.folders <= folders:
        return False
    if rule.check_type in KEY_RULES:
        return mark.before == trusted
    return mark.parents == parents or (mark.affected == 0 and mark.parents <= parents)


def duplicates_of_load(
    incoming: DataFrame, earlier: DataFrame, rule: Rule, rows: int | None = None
) -> DataFrame:
    """total, affected: the rows of a load, and how many rows beyond the first of their key
    it adds to a table. Equal to the difference of the full check after and before.

    Incoming keys are counted, and looked up in the table within their ranges, so that of a
    table laid out by a key column only the row groups that may hold them are read. The
    table's keys do not move for a batch that Spark can broadcast.

    For a batch that grows with its table, give how many ``rows`` it has at most: its keys are
    then dealt out before they are counted, and hashed for the look-up, so that the table's
    keys pass by and need no sort.
    """
    keys = list(rule.columns)
    if rule.check_type == KEY_DUPLICATES and len(keys) == 1:
        incoming = incoming.filter(F.col(keys[0]).isNotNull())
    counted = incoming if rows is None else dealt(incoming.select(*keys), keys, rows)
    groups = counted.groupBy(*keys).agg(F.count("*").alias("n"))
    for key in keys:
        if isinstance(incoming.schema[key].dataType, T.IntegralType):
            held = within(key, key_ranges(incoming, key))
            earlier = earlier.filter(held | F.col(key).isNull() if len(keys) > 1 else held)
    a, b = groups.alias("a"), earlier.select(*keys).alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    # First cut the table down to incoming keys, then mark these.
    sought = groups.select(*keys) if rows is None else groups.select(*keys).hint("shuffle_hash")
    met = b.join(sought.alias("a"), same, "left_semi").distinct().alias("b")
    known = a.join(met, same, "left_semi").agg(F.count("*").alias("known"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"),
    ).select("total", (F.col("extra") + known.select("known").scalar()).alias("affected"))


def orphans_of_load(incoming: DataFrame, parents: Sequence[DataFrame], rule: Rule) -> DataFrame:
    """total, affected: the rows of a load, and those whose key no parent has."""
    return measure_orphans(incoming, parents, rule)


def measure(
    rule: Rule, folders: Sequence[str], marks: Sequence[Mark], parent_folders: Sequence[str],
    read: Callable[[Sequence[str]], DataFrame], parents: Callable[[], Sequence[DataFrame]],
) -> tuple[list[Mark], Mark | None]:
    """The marks of a rule that still count, and the mark of all other folders (none if all
    are marked). ``read`` opens folders of the table, ``parents`` the parent tables."""
    listed, above, trusted, kept = set(folders), set(parent_folders), set(), []
    # Duplicates were measured one load after the other: a mark rests on those before it.
    for mark in sorted(marks, key=lambda m: len(m.before)):
        if not mark.folders & trusted and still_true(mark, rule, listed, above, trusted):
            kept.append(mark)
            trusted |= mark.folders
    rest = [f for f in folders if f not in trusted]
    if not rest:
        return kept, None
    incoming = read(rest)
    if rule.check_type in PARENT_RULES:
        found = orphans_of_load(incoming, parents(), rule)
    elif not kept:
        found = measure_duplicates(incoming, rule)
    else:
        found = duplicates_of_load(incoming, read([f for f in folders if f in trusted]), rule)
    total, affected = found.first()
    fresh = Mark(frozenset(rest), frozenset(trusted), frozenset(above), int(total), int(affected))
    return kept, fresh


def marks_of(rows: DataFrame) -> Mapping[tuple[str, str, str], list[Mark]]:
    """The stored marks by rule (as many rows as there are rules and loads)."""
    found: dict[tuple[str, str, str], list[Mark]] = {}
    for r in rows.collect():
        mark = Mark(frozenset(r.carpetas), frozenset(r.anteriores), frozenset(r.padres), r.total, r.afectados)
        found.setdefault((r.tabla, r.columna, r.tipo_chequeo), []).append(mark)
    return found


def mark_rows(rule: Rule, marks: Sequence[Mark]) -> list[tuple]:
    return [
        (rule.table, rule.label, rule.check_type, sorted(m.folders), sorted(m.before), sorted(m.parents), m.total, m.affected)
        for m in marks
    ]
