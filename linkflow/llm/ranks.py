"""Exact ranks within groups by hierarchical digit histograms, so that no group is sorted as a whole.

Keys are texts of digits that sort as what they stand for (``hex_key`` of numbers). Rows are counted
by group and leading digits, at a depth where each count is small; counts of fewer digits are summed
from those of more. From the top down, the rows before a node are those before its parent and those
of its earlier siblings (at most ``16 ** width`` of them). A row's rank is the number of rows before
its node plus its place in the node. Only numbers (the largest count, the shortest and longest key)
reach the driver.
"""

from __future__ import annotations

from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkflow.llm.common import release, save

#: Hexadecimal digits of a level, and the rows of a node that one task may order.
WIDTH = 2
LEAF = 256


def hex_key(x: Column, descending: bool = False) -> Column:
    """A long as 16 digits in the order of numbers, nulls first (``descending``: from the largest, nulls last)."""
    biased = x.bitwiseXOR(F.lit(0x7FFFFFFFFFFFFFFF if descending else -0x8000000000000000))
    return F.coalesce(F.lpad(F.hex(biased), 16, "0"), F.lit(("G" if descending else "-") * 16))


class Buckets:
    """``table(*group, prefix, rows, n, lo, first, total)``: nodes of ``depth`` leading digits.

    ``n`` counts copies, ``first`` those before the node, ``lo`` is its least key. ``crowded`` says
    that a node holds more than ``leaf`` rows with one key, which no digit tells apart.
    """

    def __init__(self, rows: DataFrame, group: list[str], key: str, leaf: int = LEAF, width: int = WIDTH):
        n = F.sum("copies") if "copies" in rows.columns else F.count("*")
        per = save(rows.groupBy(*group).agg(F.count("*").alias("rows"), n.alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"), F.max(F.length(key)).alias("digits")), "rank-groups")
        most, lo, hi, digits = per.agg(F.max("rows"), F.min("lo"), F.max("hi"), F.max("digits")).first()
        self.saved = [per]
        self.crowded = False
        shared = len(commonprefix([lo or "", hi or ""]))
        base = self.depth = shared - shared % width
        left = most or 0
        while left > leaf and self.depth < digits:
            self.depth, left = self.depth + width, left / 16**width
        if self.depth == base:
            self.table = per.withColumns({"prefix": F.substring("lo", 1, base), "first": F.lit(0).cast("long"), "total": F.col("n")}).drop("hi", "digits")
            self.crowded = (most or 0) > leaf
            return
        while True:
            prefix = F.substring(key, 1, self.depth).alias("prefix")
            nodes = save(rows.groupBy(*group, prefix).agg(F.count("*").alias("rows"), n.alias("n"), F.min(key).alias("lo")), "rank-nodes")
            self.saved.append(nodes)
            self.crowded = nodes.agg(F.max("rows")).first()[0] > leaf
            if not self.crowded or self.depth >= digits:
                break
            self.depth += width
        levels = [nodes]
        for d in range(self.depth - width, base, -width):
            levels.append(levels[-1].groupBy(*group, F.substring("prefix", 1, d).alias("prefix")).agg(F.sum("n").alias("n")))
        above = None
        for d, level in zip(range(base + width, self.depth + 1, width), reversed(levels), strict=True):
            level = level.withColumn("parent", F.substring("prefix", 1, d - width))
            before = Window.partitionBy(*group, "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
            level = level.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
            if above is not None:
                level = level.join(above, [*group, "parent"]).withColumn("first", F.col("first") + F.col("above")).drop("above")
            above = level.select(*group, F.col("prefix").alias("parent"), F.col("first").alias("above"))
        self.table = level.drop("parent").join(per.select(*group, F.col("n").alias("total")), group)

    def release(self) -> None:
        for df in self.saved:
            release(df)


def expand(rows: DataFrame, start: str | None = None, leaf: int = LEAF) -> DataFrame:
    """Each row as often as its ``copies`` say, dealt out in blocks; ``start`` (if given) counts on from copy to copy."""
    rows = rows.withColumn("copy_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {leaf}"))))
    rows = rows.repartition("copy_block")
    rows = rows.withColumn("copy_no", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(leaf), F.col("copies") - F.col("copy_block") * leaf) - 1)))
    if start is not None:
        rows = rows.withColumn(start, F.col(start) + F.col("copy_block") * leaf + F.col("copy_no"))
    return rows.drop("copies", "copy_block", "copy_no")


def ranked(rows: DataFrame, group: list[str], key: str, leaf: int = LEAF, width: int = WIDTH) -> DataFrame:
    """``rows`` (a saved table) with ``idx``, from 0 by ``key`` within each group, and the group's ``total``, saved.

    Rows with equal keys must be equal. If more than ``leaf`` rows are, they are counted before they
    are dealt, and dealt out again in blocks.
    """
    columns = rows.columns
    b = Buckets(rows, group, key, leaf, width)
    crowded, counted = b.crowded, None
    if crowded:
        b.release()
        rows = counted = save(rows.groupBy(*columns).agg(F.count("*").alias("copies")), "rank-copies")
        b = Buckets(rows, group, key, leaf, width)
    nodes = b.table.select(*group, "prefix", "first", "total")
    rows = rows.withColumn("prefix", F.substring(key, 1, b.depth)).join(nodes, [*group, "prefix"])
    w = Window.partitionBy(*group, "prefix").orderBy(key)
    if not crowded:
        rows = rows.withColumn("idx", F.col("first") + F.row_number().over(w) - 1)
    else:
        before = F.sum("copies").over(w.rowsBetween(Window.unboundedPreceding, -1))
        rows = expand(rows.withColumn("idx", F.col("first") + F.coalesce(before, F.lit(0))), "idx", leaf)
    out = save(rows.select(*columns, "idx", "total"), "ranked")
    b.release()
    if counted is not None:
        release(counted)
    return out


def running_sums(rows: DataFrame, group: list[str], value: Column, leaf_bits: int = 8) -> DataFrame:
    """``rows(*group, idx)`` with ``running``: the sum of ``value`` (a decimal) up to the row, by ``idx`` within the group.

    Blocks of ``2 ** leaf_bits`` rows are summed, blocks of blocks likewise; each block adds what is before it.
    """
    rows = rows.withColumn("value", value.cast("decimal(38,0)")).withColumn("block", F.shiftright("idx", leaf_bits))
    # Sums of decimals keep 38 digits.
    total = lambda c: F.sum(c).cast("decimal(38,0)")
    last = rows.agg(F.max("block")).first()[0] or 0
    levels = []
    while last > 0:
        below = rows.groupBy(*group, "block").agg(total("value").alias("value")) if not levels else levels[-1].groupBy(*group, F.shiftright("block", leaf_bits).alias("block")).agg(total("value").alias("value"))
        levels.append(below)
        last >>= leaf_bits
    above = None
    none = F.lit(0).cast("decimal(38,0)")
    for level in reversed(levels):
        before = Window.partitionBy(*group, "parent").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("parent", F.shiftright("block", leaf_bits)).withColumn("before", F.coalesce(F.sum("value").over(before).cast("decimal(38,0)"), none))
        if above is not None:
            level = level.join(above, [*group, "parent"]).withColumn("before", (F.col("before") + F.col("above")).cast("decimal(38,0)"))
        above = level.select(*group, F.col("block").alias("parent"), F.col("before").alias("above"))
    if above is not None:
        rows = rows.join(above.select(*group, F.col("parent").alias("block"), F.col("above").alias("before")), [*group, "block"])
    else:
        rows = rows.withColumn("before", none)
    w = Window.partitionBy(*group, "block").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("running", (F.col("before") + F.sum("value").over(w)).cast("decimal(38,0)")).drop("value", "block", "before")
