"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_key

WORD = "[^\\x20\\x09-\\x0D]+"
#: Cells into which each level of the rank histogram divides a source's open interval of ranks.
CELLS = 4096
LEVELS = 2
#: Rows of one kind that a task writes out at once.
ROWS_AT_ONCE = 10_000


def water_filled_targets(sources: DataFrame, weights: list[float], share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources by code point, null last, get the ``weights`` in turn and share ``share`` times all
    sizes; no target passes ``limit`` times its source's size, and what that cuts off is shared by
    weight among the rest until none is above. The level at which sources hit their limit is found
    in one pass: in the order of limit/weight, source k is at its limit if the level that the others
    from k on would share reaches it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    w = F.get(F.array(*(F.lit(float(x)) for x in weights)), turn)
    cap = F.lit(float(limit)) * F.col("source_size")
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (F.lit(float(share)) * total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    ranked = sources.withColumn("w", w).withColumn("cap", cap).withColumn("own_level", level)
    # Once a source is below its limit, so are all after it, at the level of the first such.
    first = F.min(F.when(F.col("own_level") * F.col("w") < F.col("cap"), F.struct((F.col("cap") / F.col("w")).alias("x"), F.col("own_level").alias("y")))).over(Window.partitionBy())
    return ranked.withColumn("open", first["y"]).select("source", "source_size", F.when(F.col("open").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("open") * F.col("w"))).alias("target"))


def unit_random(id_column: str, salt: str = "") -> Column:
    """A number in (0, 1) that the row's id and text fix, from 52 bits of an MD5."""
    token = F.concat_ws(":", F.lit(salt), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.col("text_md5"))
    return (F.conv(F.substring(F.md5(token), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(4503599627370496.0)


def mix(docs: DataFrame, weights: list[float] = (5, 2, 1), share: float = 1.5, limit: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(<id>, text_key, source, size, source_size, target, copies)`` for each row of ``docs``.

    Size is the number of words. A document expects target/source_size copies of itself: the whole
    ones it gets for certain, the fraction is its inclusion probability p in a Pareto sample. Ranks
    are u/(1-u) over p/(1-p), u fixed by id and text; the lowest ranks are taken until the source's
    remaining words are reached, the last one if that brings the sum nearer. Probabilities differ
    between sources only, and each source is cut by itself, so that its words come near its target:
    within a source the order of ranks is that of u. The place of the cut is found by histograms of
    words over rank cells, refined within the cell of the cut, and only that cell's kinds of rows
    are sorted. Rows that repeat id and text have one u; they are one kind, counted before sorting,
    of which as many get a copy as come before the cut. Ties of u go by id, then text key.

    A null text has size zero, as has an empty one; a null source is a source of its own; null ids
    count as an empty id. Words of zero total give targets of zero and no copies.
    """
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"), text_key(text_col).alias("text_key"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_md5"))
    sized = materialize(sized.withColumn("u", unit_random("_id")).drop("text_md5"), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = water_filled_targets(sources, list(weights), share, limit)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(expected)).withColumn("p", expected - F.floor(expected)).withColumn("room", F.col("target") - F.floor(expected) * F.col("source_size"))
    targets = materialize(targets, "targets")

    # cut: per source, the cell in which the words run out, and the words left at its start.
    # The ranks of a source are its u in other units, so cells of u are cells of ranks.
    cut = targets.select("source", "room", F.lit(0).cast("long").alias("cell"))
    width = 1
    for level in range(LEVELS):
        width *= CELLS
        cell = F.floor(F.col("u") * float(width))
        inside = sized if level == 0 else sized.join(cut.select("source", F.col("cell").alias("outer")), sized["source"].eqNullSafe(cut["source"]) & (F.floor(F.col("u") * float(width // CELLS)) == F.col("outer"))).drop(cut["source"])
        filled = inside.groupBy(sized["source"], cell.alias("cell")).agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
        filled = filled.withColumn("end", running).join(cut.select(F.col("source").alias("of"), "room"), F.col("source").eqNullSafe(F.col("of")))
        over = filled.filter("end > room").groupBy("source").agg(F.min(F.struct("cell", (F.col("room") - (F.col("end") - F.col("words"))).alias("room"))).alias("c"))
        cut = materialize(over.select("source", "c.room", "c.cell"), "cut")

    limits = targets.join(cut.select(F.col("source").alias("of"), "cell", F.col("room").alias("left")), targets["source"].eqNullSafe(F.col("of")), "left").drop("of")
    placed = sized.join(F.broadcast(limits) if _few(limits) else limits, sized["source"].eqNullSafe(limits["source"])).drop(limits["source"])
    own = F.floor(F.col("u") * float(width))
    rank = F.try_divide(F.col("u") / (1 - F.col("u")), F.col("p") / (1 - F.col("p")))
    shown = ["_id", "text_key", "source", "size", "source_size", "target", "whole"]
    kinds = placed.filter(own == F.col("cell")).groupBy(*shown, "u", "p", "cell", "left").agg(F.count("*").alias("n")).withColumn("rank", rank)
    before = F.sum(F.col("size") * F.col("n")).over(Window.partitionBy("source", "cell").orderBy("rank", "_id", "text_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size") * F.col("n")
    # Row j of a kind gets a copy if before + j * size + size / 2 <= left; the quotient may be off by one.
    fits = lambda j: F.col("before") + j * F.col("size") + F.col("size") / 2 <= F.col("left")
    guess = F.coalesce(F.floor(F.try_divide(F.col("left") - F.col("before"), F.col("size")) + 0.5), F.when(F.col("before") <= F.col("left"), F.col("n")).otherwise(F.lit(0)))
    kinds = kinds.withColumn("before", before).withColumn("t", F.least(F.greatest(guess, F.lit(0)), F.col("n")))
    kinds = kinds.withColumn("t", F.when((F.col("t") > 0) & ~fits(F.col("t") - 1), F.col("t") - 1).when((F.col("t") < F.col("n")) & fits(F.col("t")), F.col("t") + 1).otherwise(F.col("t")))
    kinds = kinds.withColumn("t", F.when(F.col("p") > 0, F.col("t")).otherwise(F.lit(0)))
    # A kind of very many rows is written out in many tasks.
    spans = kinds.select(*shown, F.explode(F.array(F.struct(F.lit(1).alias("extra"), F.col("t").alias("m")), F.struct(F.lit(0).alias("extra"), (F.col("n") - F.col("t")).alias("m")))).alias("s")).select(*shown, "s.extra", "s.m").filter("m > 0")
    spans = spans.withColumn("span", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / ROWS_AT_ONCE)))).repartition("_id", "text_key", "extra", "span")
    edge = spans.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(ROWS_AT_ONCE), F.col("m") - F.col("span") * ROWS_AT_ONCE)))).select(*shown, "extra")
    # No cut: the source's words end before its room does (both are whole, or zero).
    rest = placed.filter(F.col("cell").isNull() | (own != F.col("cell")))
    rest = rest.withColumn("extra", F.when((F.col("p") > 0) & (F.col("cell").isNull() | (own < F.col("cell"))), 1).otherwise(0))
    both = rest.select(*shown, "extra").unionByName(edge)
    return both.select(F.col("_id").alias(id_col), "text_key", "source", "size", "source_size", "target", (F.col("whole") + F.col("extra")).alias("copies"))


def _few(limits: DataFrame, most: int = 10_000) -> bool:
    """Whether the sources are few enough to be sent to every task: counted, not assumed."""
    return limits.count() <= most
