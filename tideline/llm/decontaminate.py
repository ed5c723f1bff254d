"""Benchmark decontamination: words of documents that lie in an occurrence of a window of a benchmark item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm._native import ROW, replace_columns, with_row_key, words
from tideline.llm.phrases import covered, occurrences, windows_of

WINDOW = 10


def mark_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Returns the documents with n_words, n_hit, items (sorted array of strings) and contaminated.

    A window is a run of `window` consecutive words of an item, or all words of a shorter one; an item without words
    has none. n_hit counts the document's words inside any occurrence of any window, each once; items are those with
    a window that occurs; contaminated is n_hit > 0. The words are those of _native.words.

    A null or empty text has no words; a very long one is one row, whose words must fit in a task. Items with equal windows are all named; a null item_id is not named, but its
    windows hit. Repeated rows get the same results. An empty table of items marks nothing. Input columns named as
    the results are replaced.
    """
    keyed = with_row_key(docs, id_col, text_col)
    hits = occurrences(keyed, text_col, windows_of(items, item_col, item_text_col, window))
    spans = hits.groupBy(*ROW).agg(F.collect_set(F.struct("start", "n")).alias("__spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("__items"))
    both = keyed.withColumn("__n", F.size(words(F.col(text_col)))).join(spans, ROW, "left")
    n_hit = F.when(F.col("__spans").isNull(), 0).otherwise(covered(F.col("__spans"))).cast("long")
    none = F.array().cast("array<string>")
    return replace_columns(both, {"n_words": F.col("__n").cast("long"), "n_hit": n_hit, "items": F.coalesce("__items", none), "contaminated": F.col("__spans").isNotNull()})
