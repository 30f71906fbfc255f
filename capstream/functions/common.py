"""Small column helpers shared by the function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it (possibly many times) in ``body``.

    Catalyst inlines aliases into filters it pushes down, so a function that
    refers to its input several times would re-evaluate an expensive input
    (a parse, a regex) once per reference. Binding it as a lambda variable
    keeps it to one evaluation per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def explode_rows(df: DataFrame, col: Column, aliases: tuple[str, ...], keep: tuple = (),
                 pos: str | None = None) -> DataFrame:
    """Same rows as ``explode``/``posexplode`` (none for a NULL or empty input).

    A plain ``explode`` makes the optimizer infer ``size(col) > 0`` and push it
    down to the scan, where an expensive ``col`` (a parsed document, a split
    text) is computed a second time. The outer form infers nothing; the rows
    it adds for empty input are dropped by a filter on the generated position,
    which cannot move below the generator.
    """
    p = pos or "_capstream_pos"
    out = df.select(*keep, F.posexplode_outer(col).alias(p, *aliases)).where(F.col(p).isNotNull())
    return out if pos else out.drop(p)


def quoted(name: str) -> Column:
    """A column by its exact name (dots and other characters taken literally)."""
    return F.col("`" + name.replace("`", "``") + "`")


def join_keys(left: DataFrame, right: DataFrame, keys: tuple[str, ...] | list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the right side's key columns are dropped."""
    r = right.select(*[quoted(c).alias(f"_jk_{i}") if c in keys else quoted(c)
                       for i, c in ((list(keys).index(c) if c in keys else -1, c) for c in right.columns)])
    cond = [quoted(k).eqNullSafe(F.col(f"_jk_{i}")) for i, k in enumerate(keys)]
    out = left.join(r, cond, how)
    return out.drop(*[f"_jk_{i}" for i in range(len(keys))])
