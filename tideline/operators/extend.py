"""Where users plug in: record deserializers, column converters, and what happens to tables that are not known."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class UnknownTable(RuntimeError):
    """A change of a table whose schema is not known."""


def deserialize(records: DataFrame, fn: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """Rows that fn makes of each record, any number of them, in Arrow batches."""

    def batches(frames) -> Iterator:
        import pandas as pd

        names = None
        for frame in frames:
            out = [row for record in frame.to_dict("records") for row in fn(record)]
            names = names or [p.split()[0] for p in schema.split(",")]
            yield pd.DataFrame(out, columns=names)

    return records.mapInPandas(batches, schema)


Converter = Callable[[Column], Column]


def convert_columns(df: DataFrame, converters: dict[str, Converter]) -> DataFrame:
    """Columns put through converters, chosen by the column's name or else by its source type (see functions.types.field)."""

    def of(f) -> Converter | None:
        kind = (f.metadata or {}).get("source_type", "").partition("(")[0].lower()
        return converters.get(f.name) or converters.get(f"type:{kind}")

    return df.select(*(c(F.col(f.name)).alias(f.name) if (c := of(f)) else F.col(f.name) for f in df.schema.fields))


def of_known_tables(log: DataFrame, known: DataFrame, mode: str = "fail", table: str = "table_id") -> DataFrame:
    """Changes of known tables. Others: fail raises as soon as one is there, warn counts them as a metric, skip drops them."""
    names = known.select(table).distinct().withColumn("__known", F.lit(True))  # adaptive execution broadcasts it when it has seen its size
    joined = log.join(names, table, "left")
    if mode == "fail":
        message = F.concat(F.lit("a change of the unknown table "), F.coalesce(F.col(table), F.lit("null")))
        return joined.where(F.coalesce("__known", F.raise_error(message).cast("boolean"))).drop("__known").select(*log.columns)
    if mode == "warn":
        joined = joined.observe("unknown_tables", F.count_if(F.col("__known").isNull()).alias("records"))
    return joined.where("__known").drop("__known").select(*log.columns)
