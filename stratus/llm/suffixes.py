"""Repeated passages by sparse suffixes, grouped by hash (no sorted suffix array).

A passage is a run of ``LENGTH`` words or more.  Only suffixes that start at a
content-selected position are kept: of every ``WINDOW`` consecutive runs of
``GRAM`` words, the one with the least hash (the leftmost of equals).  Two
occurrences of a passage select the same position inside their first ``WINDOW``
words, so they share a suffix that agrees for ``LENGTH - WINDOW + 1`` words.

1. Suffixes are brought together by that many words; those whose neighbours are
   all in the same document are dropped.
2. Around each suffix that is left, to the left and right, nothing is extended pair by
   pair: every run of ``LENGTH`` words anchored there is compared with the runs of its
   neighbours, and those found in several documents that start one word after
   another are joined into passages.  A passage may be held by several documents
   in turn; its parts are what one and the same first document holds.

Comparison is by 64-bit hashes of the words.  Keys are counted before they are
joined, and the join sides are plain shuffles, so a passage that a third of all
documents hold is split over tasks.

Equal texts are one passage from end to end, whose first document is the first of
them (or an earlier one that holds the whole text); the passages inside it are
reported for the first of them only.

Edge cases: null and short texts have no passage; a passage repeated inside one
document alone is not reported; rows that repeat an id are one document; null
ids are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.mixing import word_count
from stratus.llm.scratch import MAX_BROADCAST, Scratch, bounded_broadcast
from stratus.llm.words import powers, doc_words, mix

LENGTH, WINDOW, GRAM = 50, 25, 8
#: Words over which all occurrences of a passage agree from the kept suffix on.
AGREE = LENGTH - WINDOW + 1
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class _Runs:
    """Hashes of runs of a text's words, from one prefix sum."""

    def __init__(self, words: np.ndarray):
        up, self.down = powers(len(words) + 1)
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)))

    def hashes(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mix((self.total[starts + length] - self.total[starts]) * self.down[starts])


def anchors(runs: _Runs, n: int) -> np.ndarray:
    """The kept suffix of each run of LENGTH words: one start per run."""
    grams = runs.hashes(np.arange(n - GRAM + 1), GRAM)
    first = n - LENGTH + 1
    best = np.arange(first)
    least = grams[:first].copy()
    for k in range(1, WINDOW):
        other = grams[k: k + first]
        less = other < least
        best[less] = np.flatnonzero(less) + k
        np.minimum(least, other, out=least)
    return best


def _suffixes(batches):
    """(doc_id, key, position) of the kept suffixes."""
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        doc, key, at = [], [], []
        for i, words in zip(ids, doc_words(b.column(1))):
            if len(words) >= LENGTH:
                runs = _Runs(words)
                p = np.unique(anchors(runs, len(words)))
                doc.append(np.full(len(p), i))
                key.append(runs.hashes(p, AGREE))
                at.append(p)
        cols = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (doc, key, at)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1].view(np.int64)), pa.array(cols[2], pa.int64())],
            ["doc_id", "key", "position"])


def _extended(batches):
    """(doc_id, text, positions) -> hash and start of each run anchored at one of them."""
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        doc, run, start = [], [], []
        for i, words, kept in zip(ids, doc_words(b.column(1)), b.column(2)):
            if len(words) < LENGTH:
                continue
            runs = _Runs(words)
            s = np.flatnonzero(np.isin(anchors(runs, len(words)), kept.values.to_numpy()))
            doc.append(np.full(len(s), i))
            run.append(runs.hashes(s, LENGTH))
            start.append(s)
        cols = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (doc, run, start)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1].view(np.int64)), pa.array(cols[2], pa.int32())],
            ["doc_id", "run", "start"])


def _several(rows: DataFrame, key: str, scratch: Scratch, name: str) -> DataFrame:
    """(key, first, last): keys found in several documents."""
    return scratch.save(rows.groupBy(key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                        .where("first < last"), name)


def repeated_passages(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word, n_words, first_doc_id, other_doc_id, parts):
    the stretches of LENGTH words or more whose every run of LENGTH words other
    documents hold too.

    first_doc_id: the smallest id that holds (a part of) it; other_doc_id: a
    document other than this one that does.  parts: the stretch cut where the
    smallest holder of its runs or the other document changes, each part with its
    own (start_word, end_word, first_doc_id, other_doc_id); null for a whole text
    with copies.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    # Equal texts: each is one passage from end to end; one stands for all below.
    sized = base.select("doc_id", F.unhex(F.md5("text")).alias("digest"), word_count(F.col("text")).alias("n"))
    groups = scratch.save(sized.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                          .where("first < last"), "groups")
    same = scratch.save(sized.join(groups, "digest").select("doc_id", "n", "first", "last").distinct(), "same")
    copies = same.where("doc_id <> first").select("doc_id").distinct()
    single = base.join(bounded_broadcast(copies, MAX_BROADCAST), "doc_id", "left_anti")

    kept = scratch.save(single.mapInArrow(_suffixes, "doc_id long, key long, position long"), "suffixes")
    shared = _several(kept, "key", scratch, "shared")
    places = scratch.save(
        kept.join(shared, "key", "left_semi").groupBy("doc_id")
        .agg(F.collect_set("position").alias("positions")), "places")
    scratch.drop("suffixes", "shared")
    scratch.free()
    runs = scratch.save(single.join(places, "doc_id").select("doc_id", "text", "positions")
                        .mapInArrow(_extended, "doc_id long, run long, start int"), "runs")
    scratch.drop("places")
    scratch.free()
    found = _several(runs, "run", scratch, "found")
    scratch.free()
    # Dealt by document once: the aggregate and the window below keep that.
    hits = (runs.join(found, "run").select(
        "doc_id", "start", "first",
        F.when(F.col("first") != F.col("doc_id"), F.col("first")).otherwise(F.col("last")).alias("other"))
        .repartition("doc_id").groupBy("doc_id", "start").agg(F.min("first").alias("first"), F.min("other").alias("other")))
    per_doc = Window.partitionBy("doc_id").orderBy("start")
    after = F.lag("start").over(per_doc) == F.col("start") - 1
    same_held = (F.lag("first").over(per_doc) == F.col("first")) & (F.lag("other").over(per_doc) == F.col("other"))
    span = F.struct("start_word", "end_word", "first_doc_id", "other_doc_id")
    partly = scratch.save(
        hits.withColumn("new", (~F.coalesce(after, F.lit(False))).cast("int"))
        .withColumn("changed", (~F.coalesce(after & same_held, F.lit(False))).cast("int"))
        .withColumn("passage", F.sum("new").over(per_doc)).withColumn("part", F.sum("changed").over(per_doc))
        .groupBy("doc_id", "passage", "part")
        .agg(F.min("start").cast("long").alias("start_word"), (F.max("start") + LENGTH).cast("long").alias("end_word"),
             F.min("first").alias("first_doc_id"), F.min("other").alias("other_doc_id"))
        .groupBy("doc_id", "passage")
        .agg(F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word"),
             F.min("first_doc_id").alias("first_doc_id"), F.min("other_doc_id").alias("other_doc_id"),
             F.array_sort(F.collect_list(span)).alias("parts")), "partly")
    scratch.drop("runs", "found")
    # A copy is its first copy's text; that one's own passages stand beside its row, but
    # where one document holds the whole text, all copies have its first document.
    ends = same.where(F.col("n") >= LENGTH)
    lower = (partly.join(ends.where("doc_id = first").select("doc_id", "n").distinct(), "doc_id")
             .where("start_word = 0 AND end_word = n AND size(parts) = 1")
             .select(F.col("doc_id").alias("first"), F.col("first_doc_id").alias("lower")))
    whole = (ends.join(lower, "first", "left")
             .select("doc_id", F.lit(0).cast("long").alias("start_word"), F.col("n").alias("end_word"),
                     F.least("first", "lower").alias("first_doc_id"),
                     F.when(F.col("doc_id") != F.col("first"), F.col("first")).otherwise(F.col("last"))
                     .alias("other_doc_id"), F.lit(None).cast(partly.schema["parts"].dataType).alias("parts")))
    told = lower.select(F.col("first").alias("doc_id"), F.lit(0).cast("long").alias("start_word"), F.lit(1).alias("one"))
    parts = (partly.withColumn("one", F.size("parts")).join(told, ["doc_id", "start_word", "one"], "left_anti")
             .select(whole.columns))
    return parts.union(whole).select(
        "doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
        "first_doc_id", "other_doc_id", "parts")


def _cut(batches):
    for b in batches:
        texts = []
        for text, spans in zip(b["_text"], b["_spans"]):
            if spans is None or text is None:
                texts.append(text)
                continue
            words = [m.span() for m in _WORD.finditer(text)]
            gone = np.zeros(len(words), bool)
            for cut in (True, False):  # what is kept goes over what is cut
                for s in spans:
                    if s["cut"] == cut:
                        gone[s["start_word"]: s["end_word"]] = cut
            edge = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
            out, at = [], 0
            for first, end in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                out.append(text[at: words[first][0]])
                at = words[end - 1][1]
            texts.append("".join([*out, text[at:]]))
        yield b.drop(columns=["_spans"]).assign(_text=pd.Series(texts, index=b.index, dtype=object))


def without_repeats(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, text): texts less the words that earlier documents hold.

    Words are cut by the runs that an earlier document holds, except those also in
    a repeated run of which this document is the first: every repeated run stays
    whole in its first document.
    """
    own = F.array(F.struct("start_word", "end_word", "first_doc_id", "other_doc_id"))
    spans = (passages.select(F.col("doc_id").alias("_doc"), F.col("parts").isNull().alias("whole"),
                             F.explode(F.coalesce("parts", own)).alias("p"))
             .withColumn("cut", F.col("p.first_doc_id") < F.col("_doc")).where("cut OR NOT whole")
             .groupBy("_doc").agg(F.collect_list(F.struct("p.start_word", "p.end_word", "cut")).alias("_spans")))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return (rows.join(spans, F.col("_id") == F.col("_doc"), "left").select("_id", "_text", "_spans")
            .mapInPandas(_cut, "_id long, _text string")
            .select(F.col("_id").alias(id_col), F.col("_text").alias(text_col)))
