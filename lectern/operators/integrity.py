"""Integrity rules as data-quality jobs.

A rule is violated where its condition is false; an unknown condition passes.
Row rules share one pass over the table; unique and foreign key rules of any number of
tables share one pass over each of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.scalar import is_json
from lectern.operators.joins import exceeds
from lectern.operators.sets import union_all
from lectern.session import stage


class RowRule:
    name: str

    def holds(self) -> Column:
        raise NotImplementedError

    def violated(self) -> Column:
        return F.coalesce(~self.holds(), F.lit(False))


@dataclass(frozen=True)
class Domain(RowRule):
    name: str
    col: str
    values: Sequence[str | int]

    def holds(self) -> Column:
        return F.col(self.col).isin(*self.values)


@dataclass(frozen=True)
class Range(RowRule):
    """Bounds are closed unless ``open_low``; a bound of None is absent."""

    name: str
    col: str
    low: float | int | None = None
    high: float | int | None = None
    open_low: bool = False

    def holds(self) -> Column:
        c = F.col(self.col)
        checks = []
        if self.low is not None:
            checks.append(c > self.low if self.open_low else c >= self.low)
        if self.high is not None:
            checks.append(c <= self.high)
        return reduce(lambda a, b: a & b, checks)


@dataclass(frozen=True)
class Expr(RowRule):
    name: str
    predicate: str

    def holds(self) -> Column:
        return F.expr(self.predicate)


@dataclass(frozen=True)
class Pattern(RowRule):
    name: str
    col: str
    regex: str

    def holds(self) -> Column:
        return F.col(self.col).rlike(self.regex)


@dataclass(frozen=True)
class Json(RowRule):
    name: str
    col: str

    def holds(self) -> Column:
        return is_json(self.col)


@dataclass(frozen=True)
class NotNull(RowRule):
    name: str
    cols: Sequence[str]

    def holds(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.cols])


@dataclass(frozen=True)
class Unique:
    """Keys occur once; NULLs count as equal."""

    name: str
    cols: Sequence[str]


@dataclass(frozen=True)
class ForeignKey:
    """``col`` is NULL or equals ``key`` of a row of ``parent``, both compared as text."""

    name: str
    col: str
    parent: str
    key: str


@dataclass(frozen=True)
class CrossTable:
    """Value at most the limit of its key in another table.

    ``reject`` "row" marks the offending rows, "batch" every row once one offends.
    """

    name: str
    limits: str
    key: str
    col: str
    limit: str
    reject: str = "row"

    def violations(self, df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        bad = exceeds(df, tables[self.limits], self.key, self.col, self.limit).select(*df.columns)
        if self.reject == "row":
            return bad
        any_bad = bad.limit(1).select(F.lit(True).alias("any")).scalar()
        return df.filter(F.coalesce(any_bad, F.lit(False)))


def row_violations(df: DataFrame, rules: Sequence[RowRule], key: str) -> DataFrame:
    """(rule, key, reason) of all row rules in one pass."""
    names = F.array(*[F.when(r.violated(), F.lit(r.name)) for r in rules])
    flagged = df.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(names)).alias("rule"))
    reasons = {r.name: type(r).__name__ for r in rules}
    reason = F.create_map(*[F.lit(x) for pair in reasons.items() for x in pair])
    return flagged.select("rule", "key", reason[F.col("rule")].alias("reason"))


def _key_hash(cols: Sequence[Column]) -> list[Column]:
    """128 bits of the values, two independent halves; NULL differs from every value."""
    marked = [x for c in cols for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(seed), *marked).alias(f"h{seed}") for seed in (1, 2)]


HASHED = 32  # characters of a hashed text


def _short(text: Column) -> Column:
    """The text itself, or 128 bits of it as ``HASHED`` characters if it is not shorter than that; no two texts share one but by these bits."""
    halves = [F.lpad(F.hex(h), HASHED // 2, "0") for h in _key_hash([text])]
    return F.when(F.octet_length(text) < HASHED, text).otherwise(F.concat(*halves))


UNIQUE, CHILD, PARENT = 0, 1, 2  # kinds of entries


def _entries(
    df: DataFrame, key: str | None, rules: Sequence, ids: Mapping[str, int], parents: Mapping[tuple, int], held: Mapping[str, int]
) -> DataFrame:
    """(kind, rule, of, h1, h2, text, key): what the rows of a table say on all relational rules, from one read.

    ``of`` is the set a value belongs to: the rule itself, or the key of a parent table; ``held`` are
    the columns of this table that are such keys.  A value of a unique rule is in ``h1`` and ``h2``, other ones in ``text``.
    """

    def entry(kind: int, rule: int, of: int, value: Sequence[Column], owner: Column) -> Column:
        named = [F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), F.lit(of).alias("of")]
        return F.struct(*named, *value, owner.cast("string").alias("key"))

    def hashed(cols: Sequence[Column]) -> list[Column]:
        return [*_key_hash(cols), F.lit(None).cast("string").alias("text")]

    def plain(text: Column) -> list[Column]:
        return [*[F.lit(None).cast("long").alias(h) for h in ("h1", "h2")], _short(text).alias("text")]

    made = []
    for rule in rules:
        n = ids[rule.name]
        if isinstance(rule, Unique):
            made.append(entry(UNIQUE, n, n, hashed([F.col(c) for c in rule.cols]), F.col(key)))
        else:
            value = F.col(rule.col).cast("string")
            made.append(F.when(value.isNotNull(), entry(CHILD, n, parents[rule.parent, rule.key], plain(value), F.col(key))))
    for column, n in held.items():
        value = F.col(column).cast("string")
        made.append(F.when(value.isNotNull(), entry(PARENT, -1, n, plain(value), F.lit(None))))
    return df.select(F.explode(F.array_compact(F.array(*made))).alias("e")).select("e.*")


def relation_violations(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence], keys: Mapping[str, str]) -> DataFrame:
    """(rule, key, reason) of every row that breaks a unique or foreign key rule of its table.

    A shared pass: each table that has rules, or is a parent, is read once, whatever the number of its rules.  Its rows
    become entries, which are written once: with a 128-bit hash of the key for a unique rule, with the value as
    text, which mostly takes less, for a foreign key.  One grouping finds
    the repeated keys of all unique rules, one anti join the values that no parent has.
    """
    named = [rule for own in rules.values() for rule in own]
    ids = {rule.name: n for n, rule in enumerate(named)}
    sets = dict.fromkeys((r.parent, r.key) for r in named if isinstance(r, ForeignKey))
    parents = {of: n for n, of in enumerate(sets)}
    made = []
    for t in dict.fromkeys([*(t for t in rules if rules[t]), *(parent for parent, _ in parents)]):
        held = {column: n for (parent, column), n in parents.items() if parent == t}
        made.append(_entries(tables[t], keys.get(t), rules.get(t, ()), ids, parents, held))
    entries = stage(union_all(*made), "keys")
    found = []
    if any(isinstance(r, Unique) for r in named):
        own = entries.filter(F.col("kind") == UNIQUE)
        value = ["of", "h1", "h2"]
        repeated = own.groupBy(*value).agg(F.count("*").alias("n")).filter("n > 1")
        found.append(own.join(repeated, value, "left_semi"))
    if parents:
        known = entries.filter(F.col("kind") == PARENT).select("of", "text")
        found.append(entries.filter(F.col("kind") == CHILD).join(known, ["of", "text"], "left_anti"))
    bad = union_all(*[rows.select("rule", "key") for rows in found])
    text = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(type(r).__name__).alias("reason")) for r in named])
    return bad.select(F.get(text, F.col("rule")).alias("r"), "key").select("r.rule", "key", "r.reason")


def violations(
    df: DataFrame, rules: Sequence, key: str, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """(rule, key, reason) of the rows of one table that break a rule."""
    tables = dict(tables or {})
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    relations = [r for r in rules if isinstance(r, Unique | ForeignKey)]
    found = [row_violations(df, row_rules, key)] if row_rules else []
    if relations:
        found.append(relation_violations({**tables, OWN: df}, {OWN: relations}, {OWN: key}))
    for rule in rules:
        if isinstance(rule, CrossTable):
            found.append(rule.violations(df, tables).select(
                F.lit(rule.name).alias("rule"), F.col(key).cast("string").alias("key"),
                F.lit(type(rule).__name__).alias("reason"),
            ))
    return union_all(*found)


OWN = ""  # the name under which ``violations`` passes its table on


def validate(
    df: DataFrame, rules: Sequence, key: str, tables: Mapping[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows without violation, violations as (rule, key, reason))."""
    found = violations(df, rules, key, tables)
    good = df
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    if row_rules:
        good = df.filter(~reduce(lambda a, b: a | b, [r.violated() for r in row_rules]))
    kinds = {type(r).__name__ for r in rules if not isinstance(r, RowRule)}
    if kinds:
        bad_keys = found.filter(F.col("reason").isin(*kinds)).select(F.col("key").alias("_bad")).distinct()
        good = good.join(bad_keys, F.col(key).cast("string").eqNullSafe(F.col("_bad")), "left_anti")
    return good, found
