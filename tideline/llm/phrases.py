"""Where whole word sequences occur in documents: a containment join with prefix filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm._native import ROW, let, words
from tideline.llm._shared import cut

#: Word sequences and their items of up to so many bytes are broadcast; larger tables are joined by shuffle.
BROADCAST_BYTES = 32 << 20


def windows_of(items: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(win, items): each distinct run of size words of an item, or the whole of a shorter item, and whose it is."""
    w = F.col("w")
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
    runs = let(w, lambda x: F.transform(starts, lambda i: F.slice(x, i + 1, size)))
    each = items.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0).select("item", F.explode(runs).alias("win"))
    return each.groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items"))


def occurrences(keyed: DataFrame, text_col: str, windows: DataFrame) -> DataFrame:
    """(ROW, start, n, items): each place in the words of a row of keyed where a window of n words occurs, and its items.

    keyed has the columns ROW; rows that share them must share their text. Exact containment needs every word of a
    window, so its rarest word, by occurrences in all texts, is prefix enough: only positions of those words are
    joined with windows. A candidate must fit in the text from where that word puts its start. The candidates of a
    text are then verified against its words, one by one.
    """
    windows = windows.withColumn("phrase", F.array_join("win", " ")).withColumn("n", F.size("win"))
    width = F.octet_length("phrase") + F.octet_length(F.array_join("items", " ")) + 16 * F.col("n") + 64
    bounded = (windows.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES
    small = F.broadcast if bounded else lambda df: df
    token = windows.select("phrase", F.posexplode("win").alias("at", "word"))
    vocabulary = token.select("word").distinct()
    every = keyed.select(*ROW, words(F.col(text_col)).alias("w"))

    said = every.select(F.explode("w").alias("word"))
    if bounded:
        seen = said.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count("*").alias("seen"))
    else:  # counted first, so that a frequent word is a row for each task when it is shuffled
        seen = said.groupBy("word").agg(F.count("*").alias("seen")).join(vocabulary, "word")
    rarest = token.join(seen, "word", "left").groupBy("phrase").agg(F.min_by(F.struct("word", "at", "seen"), F.struct("seen", "word", "at")).alias("t"), F.count("seen").alias("known"), F.count("*").cast("int").alias("n"))
    rarest = rarest.where(F.col("known") == F.col("n")).select("phrase", "n", F.col("t.word").alias("word"), F.col("t.at").alias("at"))
    if not bounded:  # a plain table, so that adaptive execution can split the places of a frequent word
        rarest = cut(rarest)
    places = every.select(*ROW, F.size("w").alias("length"), F.posexplode("w").alias("pos", "word"))
    start = F.col("pos") - F.col("at")
    found = places.join(small(rarest), "word").where((start >= 0) & (start + F.col("n") <= F.col("length"))).select(*ROW, start.alias("start"), "n", "phrase")
    candidates = found.groupBy(*ROW).agg(F.collect_set(F.struct("start", "n", "phrase")).alias("c"))
    texts = keyed.select(*ROW, text_col).join(candidates, ROW)

    def verified(x: Column) -> Column:
        return F.filter(x["c"], lambda c: F.array_join(F.slice(x["w"], c["start"] + 1, c["n"]), " ") == c["phrase"])

    true = texts.select(*ROW, F.explode(let(F.struct(words(F.col(text_col)).alias("w"), "c"), verified)).alias("c"))
    return true.select(*ROW, "c.start", "c.n", "c.phrase").join(small(windows.select("phrase", "items")), "phrase").select(*ROW, "start", "n", "items")


def covered(spans: Column) -> Column:
    """How many positions the (start, n) structs cover together."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc: Column, x: Column) -> Column:
        end = x["start"] + x["n"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(end - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("n"))

    return F.aggregate(F.array_sort(spans), zero, add)["n"]
