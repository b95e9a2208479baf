"""Where a row sits in every tree, as one array of the row.

A row's state is an array of codes, one per tree that it is still under way in: ``2 * node + y``, with
the node's number within its level and y = 1 if the row is of the tree's class. Negative codes are
final. A level's step is an expression: each code looks its node up in constant arrays (term, number
of the child with the term, of the child without) and moves on. So a step needs no join, no shuffle and
no row per (row, tree). Constant arrays come from node tables of at most ``LITERAL_NODES`` rows (checked);
above that ``advance_by_join`` does the same by a join.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nodes of a level that may become constants of a plan (a few MB).
LITERAL_NODES = 50_000
GONE = -1


def lit_array(values: Sequence, element: str) -> Column:
    """A constant array of any length as one literal."""
    return F.from_json(F.lit(json.dumps(list(values), ensure_ascii=False)), f"array<{element}>")


@dataclass
class Step:
    """One level by node number: the term asked for, and where a row goes with and without it
    (a node number of the next level, or a negative final code)."""

    terms: list = field(default_factory=list)
    with_term: list[int] = field(default_factory=list)
    without: list[int] = field(default_factory=list)


def start(trees: Sequence[str], label: Column | None = None) -> Column:
    """The state at the roots: node i is the root of tree i."""
    if label is None:
        return lit_array([2 * i for i in range(len(trees))], "bigint")
    return F.transform(lit_array(trees, "string"), lambda name, i: (2 * i + (name == label).cast("int")).cast("bigint"))


def advance(at: Column, terms: Column, step: Step, element: str) -> Column:
    """The state one level further down; final codes stay. ``element``: the type of the terms."""
    asked = lit_array(step.terms, element)
    yes, no = lit_array(step.with_term, "bigint"), lit_array(step.without, "bigint")

    def move(c: Column) -> Column:
        node = F.shiftright(c, 1).cast("int")
        there = F.coalesce(F.array_contains(terms, F.get(asked, node)), F.lit(False))
        to = F.when(there, F.get(yes, node)).otherwise(F.get(no, node))
        return F.when(c < 0, c).when(to < 0, to).otherwise(F.shiftleft(to, 1) + c.bitwiseAND(F.lit(1).cast("bigint")))

    return F.transform(at, move)


def under_way(at: Column) -> Column:
    """The codes that are not final."""
    return F.filter(at, lambda c: c >= 0)


def advance_by_join(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``advance`` for levels of any size: ``table`` (node, term, with_term, without) is joined, and the codes
    of a row (``doc_id``, unique) are gathered again. Final codes are left out."""
    each = rows.select("doc_id", "terms", F.explode("at").alias("_c"))
    met = each.join(table.withColumnRenamed("node", "_n"), F.shiftright("_c", 1) == F.col("_n"))
    to = F.when(F.array_contains("terms", F.col("term")), F.col("with_term")).otherwise(F.col("without"))
    code = (F.shiftleft(to, 1) + F.col("_c").bitwiseAND(F.lit(1).cast("bigint"))).alias("_c")
    moved = met.withColumn("_to", to).filter("_to >= 0").select("doc_id", code)
    moved = moved.groupBy("doc_id").agg(F.collect_list("_c").alias("at"))
    return rows.drop("at").join(moved, "doc_id")
