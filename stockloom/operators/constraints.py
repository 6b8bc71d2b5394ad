"""Integrity rules of the data model as a report, one pass per table.

Every row is turned into what the rules need of it: its keys under the rules that compare
keys, and one entry per row rule that it breaks. The entries of all tables are counted per rule and
key in one shuffle, in which a parent's key meets those that refer to it, so no table is read a
second time and none is joined. Repeated keys shrink to one row in the map tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.schema import CHECKS, ENUMS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, UNIQUE

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class Space:
    """Keys that are compared with each other: those of one owner, and of rows that refer to it."""

    keys: list[str]
    owner: str
    rule: str | None  # the owner's rule that keys occur once
    children: list[tuple[str, str]] = field(default_factory=list)  # (table, column)


def _row_rules(table: str, df: DataFrame) -> dict[str, Column]:
    """NOT NULL, CHECK and enumeration rules as the condition that breaks them."""
    columns = set(df.columns)
    rules = {f"not_null({c})": F.col(c).isNull() for c in NOT_NULL[table] if c in columns}
    rules |= {f"check({c})": ~F.expr(e) for c, e in CHECKS.get(table, []) if c in columns}
    rules |= {
        f"enum({c})": ~F.col(c).isin(values)
        for (owner, c), values in ENUMS.items()
        if owner == table and c in columns
    }
    return rules


def _spaces(tables: dict[str, DataFrame]) -> list[Space]:
    spaces: dict[str, Space] = {}
    out = []
    for table, df in tables.items():
        columns = set(df.columns)
        if columns.issuperset(PRIMARY_KEYS[table]):
            keys = PRIMARY_KEYS[table]
            spaces[table] = Space(keys, table, f"primary_key({','.join(keys)})")
            out.append(spaces[table])
        for keys in UNIQUE.get(table, []):
            if columns.issuperset(keys):
                out.append(Space(keys, table, f"unique({','.join(keys)})"))
    for table, df in tables.items():
        for column, parent in FOREIGN_KEYS.get(table, []):
            if column in df.columns and parent in spaces:
                spaces[parent].children.append((table, column))
    return out


def _key(tables: dict[str, DataFrame], space: Space, table: str, columns: list[str]) -> tuple[Column, Column, Column]:
    """(present, number, text) of a row's key; whole numbers of any width compare as such."""
    users = [(space.owner, c) for c in space.keys] + space.children
    kinds = [tables[t].schema[c].dataType for t, c in users]
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    if len(columns) == 1 and all(isinstance(k, WHOLE) for k in kinds):
        return present, F.col(columns[0]).cast("bigint"), F.lit(None).cast("string")
    # Each part with its length before it, so that parts cannot run into each other.
    parts = [F.concat(F.char_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))
             for c in columns]
    return present, F.lit(None).cast("bigint"), F.concat(*parts)


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, n) for every rule on the given tables, n = 0 where it holds.

    ``n`` counts the rows that break a row rule, the keys that occur more than once, or the rows
    whose key has no parent row; null keys never clash and need no parent. Rules on columns or
    parent tables that are not given are left out.
    """
    spark = next(iter(tables.values())).sparkSession
    spaces = _spaces(tables)
    # (table, rule, number, figure): 0 rows, 1 repeated keys, 2 on: rows of a child without parent.
    rules: list[tuple[str, str, int, int]] = []
    entries: dict[str, list[Column]] = {t: [] for t in tables}

    def entry(when: Column, number: int, slot: int, key: Column | None = None, text: Column | None = None) -> Column:
        return F.when(when, F.struct(
            F.lit(number).alias("number"), F.lit(slot).alias("slot"),
            (F.lit(None).cast("bigint") if key is None else key).alias("key"),
            (F.lit(None).cast("string") if text is None else text).alias("text")))

    for number, space in enumerate(spaces):
        entries[space.owner].append(entry(
            *(x := _key(tables, space, space.owner, space.keys))[:1], number, 0, *x[1:]))
        rules.append((space.owner, space.rule, number, 1))
        for slot, (table, column) in enumerate(space.children, 1):
            entries[table].append(entry(*(x := _key(tables, space, table, [column]))[:1], number, slot, *x[1:]))
            rules.append((table, f"foreign_key({column})", number, slot + 1))
    number = len(spaces)
    for table, df in tables.items():
        for rule, broken in _row_rules(table, df).items():
            entries[table].append(entry(broken, number, 0))
            rules.append((table, rule, number, 0))
            number += 1

    found = reduce(DataFrame.unionByName, [
        df.select(F.explode(F.array_compact(F.array(*entries[t]))).alias("e")).select("e.*")
        for t, df in tables.items() if entries[t]])
    most = max((len(s.children) for s in spaces), default=0)
    per_key = found.groupBy("number", "key", "text").agg(
        *[F.count_if(F.col("slot") == i).alias(f"s{i}") for i in range(most + 1)])
    figures = per_key.groupBy("number").agg(F.array(
        F.sum("s0"), F.count_if(F.col("s0") > 1),
        *[F.sum(F.when(F.col("s0") == 0, F.col(f"s{i}")).otherwise(0)) for i in range(1, most + 1)],
    ).alias("figures"))
    listed = spark.createDataFrame(rules, "table_name string, rule string, number int, figure int")
    return listed.join(figures, "number", "left").select(
        "table_name", "rule", F.coalesce(F.element_at("figures", F.col("figure") + 1), F.lit(0)).alias("n"))
