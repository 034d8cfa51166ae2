"""Mixing sources to target weights.

Sizes are aggregated per source; every source gets a target (a share of the
whole by its weight, at most ``MAX_REPEAT`` times its own size, the excess
reshared by weight); its rate is target / size.  A document is emitted
floor(rate) times, plus once more if its hash, as a number in [0, 1), is below
the fraction.  The hash depends on the seed and the document's id alone, so
reruns, retries and other partitionings give the same copies.

Edge cases: a null source is a source of its own (last in order); a null text
has size 0; a source of size 0 has rate 0; rows that repeat an id decide alike;
a null id is hashed as the empty string.  Expected, not exact: a source's
taken words scatter around its target as independent draws do, so small
sources with a few long documents come less near.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.scratch import Scratch, bounded_broadcast

#: No source is repeated more than this many times.
MAX_REPEAT = 3
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Sources' rates are broadcast up to this many (about 50 bytes each).
MAX_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of ASCII-space separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of a digest of the seed and the key."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def weighted_sources(sized: DataFrame, source_col: str, size_col: str = "size",
                     weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight): one row per source.

    The rank is a window over one row per source, not over documents.
    """
    per = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    return per.withColumn("weight", F.element_at(cycle, ((rank - 1) % len(weights) + 1).cast("int")))


def targets(sources: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Adds ``target``: weight times a common level, cut at max_repeat * size.

    The level rises as cut sources give their excess back, until no further
    source is cut; each step is one aggregate over the sources (a row each),
    of which three numbers reach the driver.
    """
    def level_and_cut(level: float):
        above = F.lit(level) * F.col("weight") > max_repeat * F.col("source_size")
        r = sources.agg(
            F.sum("source_size").alias("total"), F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("cut"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("free")).first()
        rest = (r["total"] or 0) - max_repeat * r["cut"]
        return r["n"], (float(rest) / float(r["free"]) if r["free"] else level)

    n, level = level_and_cut(0.0)
    while True:
        more, above = level_and_cut(level)
        if more == n:
            break
        n, level = more, above
    return sources.withColumn("target", F.least(
        F.lit(level) * F.col("weight"), F.lit(float(max_repeat)) * F.col("source_size")))


def with_copies(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
                max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """``docs`` with _size, _source_size, _target and _copies (how often each is
    emitted).  Other columns pass through unchanged."""
    sized = docs.withColumn("_size", word_count(F.col(text_col)))
    sources = scratch.save(weighted_sources(sized, source_col, "_size", weights), "sources")
    rates = targets(sources, max_repeat).select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"))
    joined = sized.join(bounded_broadcast(rates, MAX_SOURCES),
                        sized[source_col].eqNullSafe(F.col("_source")), "left").drop("_source")
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    more = uniform(F.col(id_col), seed) < rate - F.floor(rate)
    return joined.withColumn("_copies", F.floor(rate) + F.when(more, 1).otherwise(0))


def mix(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The mixed corpus: each document emitted as often as it is taken."""
    copies = with_copies(docs, scratch, **options).where("_copies > 0")
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
