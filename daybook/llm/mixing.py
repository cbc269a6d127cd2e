"""Mixing sources to target sizes by Pareto order sampling.

Sizes are words. Sources, in code point order with null last, weigh 1, 2, 3
and so on again; they share the size of all documents by weight, no source
more than ``cap`` times its own size, the excess shared anew by weight.

A source whose target is f times its size takes floor(f) whole copies of every
document. The rest is an order sample of fixed size: each document draws a
uniform number u from its id (without one, its text), its rank variable is the odds of u over the odds
of its inclusion probability, and documents are taken in that order while that
brings the words nearer to the target. So a source misses its target by at most
half the size of one document, and no document is taken more than ``cap`` times.

Documents are cut into cells of the rank variable first; only the cell in which
a source's sample ends is sorted, so a source with a third of all rows costs no
task more than that cell. Null texts have size 0; equal ids are ordered by
a hash of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import WORD_PATTERN, written

CELLS = 4096
#: Up to so many sources their plan is broadcast (some 100 bytes each); beyond it is joined by shuffle.
BROADCAST_SOURCES = 100_000


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _uniform(doc_id: str, text: str) -> Column:
    """In (0, 1), from 48 bits of the md5 of the id as text; documents without id are told apart by their text."""
    digits = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit("")).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(sizes: DataFrame, cap: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row for each source."""
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weighed = sizes.withColumn("w", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    # sources reach their cap in the order of size by weight: the first that doesn't sets the level
    before = Window.orderBy("r", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.col("total") - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0))) / (
        F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0))
    )
    return (
        weighed.withColumn("r", cap * F.col("source_size") / F.col("w"))
        .withColumn("total", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("r") > F.col("level"), F.struct("r", F.struct(F.col("source").isNull().alias("z"), "source"), "level"))).over(everything)["level"])
        .select("source", "source_size", F.coalesce(F.least(cap * F.col("source_size").cast("double"), F.col("level") * F.col("w")), F.lit(0.0)).alias("target"))
    )


def _ranked(df: DataFrame, plan: DataFrame, few: bool) -> DataFrame:
    """``df`` with its source's plan and its own rank variable ``q``."""
    plan = plan.withColumnRenamed("source", "plan_source")
    joined = df.join(F.broadcast(plan) if few else plan, F.col("source").eqNullSafe(F.col("plan_source")), "left")
    odds = F.col("p") / (1 - F.col("p"))
    return joined.withColumn("q", F.when((F.col("p") > 0) & (F.col("p") < 1), (F.col("u") / (1 - F.col("u"))) / odds))


def _drawn(docs: DataFrame) -> DataFrame:
    """What sampling needs of each document; ``row`` holds all its columns."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        size_of("text").alias("size"), _uniform("doc_id", "text").alias("u"), F.xxhash64("text").alias("tie"),
    )


def _plan(thin: DataFrame, cap: int) -> tuple[DataFrame, bool]:
    """For each source its sizes, whole copies, inclusion probability and the last rank that its sample takes."""
    sizes = written(targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), cap), "targets")
    few = sizes.count() <= BROADCAST_SOURCES
    plan = sizes.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumn(
        "p", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0)
    )
    ranked = _ranked(thin, plan, few).where("p > 0").withColumn("cell", F.floor(F.col("q") / (1 + F.col("q")) * CELLS))
    cells = ranked.groupBy("source", "cell").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    ending = (
        cells.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
        .where("before <= rest").groupBy("source").agg(F.max(F.struct("cell", "before")).alias("end"))
        .select(F.col("source").alias("end_source"), F.col("end.cell").alias("end_cell"), "end.before")
    )
    last = ranked.join(
        F.broadcast(ending) if few else ending, F.expr("source <=> end_source and cell = end_cell")
    )
    order = Window.partitionBy("source").orderBy("q", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        last.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
        .where("before + size / 2 <= rest").groupBy("source").agg(F.max(F.struct("q", "doc_id", "tie")).alias("cut"))
    )
    out = plan.join(ending, F.expr("source <=> end_source"), "left").join(
        cut.withColumnRenamed("source", "cut_source"), F.expr("source <=> cut_source"), "left"
    )
    return written(out.select("source", "source_size", "target", "whole", "p", "end_cell", "cut"), "plan"), few


def _copies(ranked: DataFrame) -> DataFrame:
    """Adds ``copies``, how often the mix takes the document."""
    cell = F.floor(F.col("q") / (1 + F.col("q")) * CELLS)
    extra = (F.col("p") > 0) & (
        (cell < F.col("end_cell")) | (cell == F.col("end_cell")) & (F.struct("q", "doc_id", "tie") <= F.col("cut"))
    )
    return ranked.withColumn("copies", F.col("whole") + F.when(extra, 1).otherwise(0))


def mixed_sizes(docs: DataFrame, cap: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; an empty table gives no rows."""
    thin = written(_drawn(docs.select("doc_id", "source", "text")).drop("row"), "sizes")
    plan, few = _plan(thin, cap)
    return _copies(_ranked(thin, plan, few)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, cap: int = 3) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Documents of size 0 have no words to take; they are kept once.
    """
    drawn = _drawn(docs)
    plan, few = _plan(written(drawn.drop("row"), "sizes"), cap)
    times = F.when(F.col("size") > 0, F.col("copies")).otherwise(1).cast("int")
    return (
        _copies(_ranked(drawn, plan, few)).where(times > 0)
        .select("row", F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).select("row.*")
    )
