"""Line dedup: lines that many documents share are dropped from all of them but one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm._native import ROW, SPACE, ascii_lower, hash_pair, let, replace_columns, with_row_key
from tideline.llm._shared import cut

MIN_CHARS = 40
MIN_DOCS = 5


def lines_of(text: Column) -> Column:
    """The lines of a text; null and '' are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _keyed(docs: DataFrame, text_col: str, min_chars: int) -> DataFrame:
    """Adds __keys: (a, b, pos) of every line whose key is long enough."""
    keys = F.transform(lines_of(F.col(text_col)), lambda line, i: F.struct(line_key(line).alias("key"), i.alias("pos")))
    keys = F.filter(keys, lambda x: F.char_length(x["key"]) >= min_chars)

    def hashed(x: Column) -> Column:
        a, b = hash_pair(x["key"])
        return F.struct(a.alias("a"), b.alias("b"), x["pos"].alias("pos"))

    return docs.withColumn("__keys", F.transform(keys, hashed))


def drop_repeated_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Returns the documents with their kept lines as text_col, and n_lines and n_dropped.

    A key (see line_key) of at least min_chars code points that is found in at least min_docs documents
    loses all its lines, except those in the document with the largest id that holds it.

    Documents are told apart by id: rows that share one, repeated or not, count once, and each row with the largest
    id keeps its lines. A null text is an empty line; rows without an id are no documents to count, but lose lines as
    others do. A very long text is one row, whose lines must fit in a task. No rows in, no rows out. Input columns
    named n_lines or n_dropped are replaced; all others stay, those that begin with two underscores excepted.

    Lines are grouped by 128 bits of hash. Documents are counted in two steps, (key, id) and then key, both combining on
    the map side, so that a line that a third of all documents share is spread by id first and then costs a row for
    each task. Shared keys are written to the shared folder, so that their join with the lines is one of two plain
    tables, whose hot partitions adaptive execution splits. Only hashes and positions are shuffled for it; the texts
    move once, by row key, to meet their lists of dropped positions.
    """
    keyed = _keyed(with_row_key(docs, id_col, text_col), text_col, min_chars)
    once = keyed.select(F.col(id_col).alias("__id"), F.explode(F.array_distinct(F.transform("__keys", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))))).alias("k"))
    holders = once.where("__id IS NOT NULL").select("k.a", "k.b", "__id").distinct()
    shared = cut(holders.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("__id").alias("__keeper")).where(F.col("n") >= min_docs).drop("n"))
    lines = keyed.select(*ROW, F.col(id_col).alias("__id"), F.explode("__keys").alias("k")).select(*ROW, "__id", "k.pos", "k.a", "k.b")
    dropped = lines.join(shared, ["a", "b"]).where(~F.col("__id").eqNullSafe(F.col("__keeper"))).groupBy(*ROW).agg(F.collect_set("pos").alias("__dropped"))
    both = with_row_key(docs, id_col, text_col).join(dropped, ROW, "left")

    def kept(x: Column) -> Column:
        at = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["dropped"])
        return F.array_join(F.transform(at, lambda i: F.get(x["lines"], i)), "\n")

    lines_col, none = lines_of(F.col(text_col)), F.col("__dropped").isNull()
    rest = let(F.struct(lines_col.alias("lines"), F.col("__dropped").alias("dropped")), kept)
    return replace_columns(
        both,
        {
            text_col: F.when(none, F.coalesce(F.col(text_col), F.lit(""))).otherwise(rest),
            "n_lines": F.size(lines_col).cast("long"),
            "n_dropped": F.when(none, 0).otherwise(F.size("__dropped")).cast("long"),
        },
    )
