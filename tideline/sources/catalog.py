"""Catalogs: tables, columns and constraints of a source, as DataFrames of its information schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMN_SCHEMA = "table_schema string, table_name string, column_name string, ordinal_position int, data_type string, column_type string, is_nullable string, column_key string"
#: The source type that holds a Spark type.
SOURCE_TYPES = {"bigint": "BIGINT", "int": "INT", "string": "TEXT", "double": "DOUBLE", "timestamp_ntz": "DATETIME(6)", "timestamp": "TIMESTAMP(6)", "boolean": "TINYINT(1)", "float": "FLOAT"}


def columns_of(spark: SparkSession, folder: str, tables: list[str], keys: dict[str, list[str]], schema: str = "demo") -> DataFrame:
    """The catalog's COLUMNS of Parquet tables: from their schemas alone."""
    rows = []
    for t in tables:
        for i, f in enumerate(spark.read.parquet(f"{folder}/{t}.parquet").schema.fields, 1):
            source = SOURCE_TYPES.get(f.dataType.simpleString(), "JSON")
            rows.append((schema, t, f.name, i, source.partition("(")[0].lower(), source.lower(), "NO" if f.name in keys.get(t, []) else "YES", "PRI" if f.name in keys.get(t, []) else ""))
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def ordered_columns(columns: DataFrame, table: str) -> DataFrame:
    return columns.where(F.col("table_name") == table).orderBy("ordinal_position")


def constraints(columns: DataFrame, usage: DataFrame, kinds: DataFrame) -> DataFrame:
    """(table_name, constraint_name, kind, columns): key columns in order by constraint, each with its kind; a primary key hides an index of its name.

    usage: table_name, constraint_name, column_name, ordinal_position. kinds: table_name, constraint_name, kind
    (PRIMARY, UNIQUE or INDEX).
    """
    rank = F.when(F.col("kind") == "PRIMARY", 0).when(F.col("kind") == "UNIQUE", 1).otherwise(2)
    best = kinds.groupBy("table_name", "constraint_name").agg(F.min_by("kind", rank).alias("kind"))
    known = columns.select("table_name", "column_name")
    joined = usage.join(known, ["table_name", "column_name"], "left_semi").join(best, ["table_name", "constraint_name"])
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name"))), lambda x: x["column_name"])
    return joined.groupBy("table_name", "constraint_name", "kind").agg(listed.alias("columns"))


def captured(columns: DataFrame, include: str | None, exclude: str | None = None) -> DataFrame:
    """(table_id): tables of the catalog that the patterns choose."""
    from tideline.operators.changelog import table_filter

    ids = columns.select(F.concat_ws(".", "table_schema", "table_name").alias("table_id")).distinct()
    return ids.where(table_filter(include, exclude))


def jdbc_catalog(spark: SparkSession, url: str, database: str, **options: str) -> dict[str, DataFrame]:
    """The catalog's views of a server, by JDBC; only schemas are asked for until they are read: schemata, tables, columns, key usage, statistics and collations."""
    views = {"schemata": "SCHEMATA", "tables": "TABLES", "columns": "COLUMNS", "usage": "KEY_COLUMN_USAGE", "statistics": "STATISTICS", "collations": "COLLATIONS"}
    safe = database.replace("'", "''")
    out = {}
    for name, view in views.items():
        where = {"schemata": f" WHERE SCHEMA_NAME = '{safe}'", "collations": ""}.get(name, f" WHERE TABLE_SCHEMA = '{safe}'")
        out[name] = spark.read.format("jdbc").options(url=url, query=f"SELECT * FROM INFORMATION_SCHEMA.{view}{where}", **options).load()
    return out


def read_chunks_jdbc(spark: SparkSession, url: str, table: str, predicates: list[str], fetch_size: int = 1024, **properties: str) -> DataFrame:
    """A table of a server, a partition for each chunk's predicate (see plans.chunks.scan_predicates)."""
    return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": str(fetch_size), **properties})


def partitions_of(table_rows: DataFrame) -> DataFrame:
    """(table_name, partition_id, kind) of partitioned tables, by id; a table without partitions is its own only one."""
    each = F.when(F.size("partitions") > 0, F.col("partitions")).otherwise(F.array(F.struct(F.col("table_id").alias("id"), F.lit("none").alias("kind"))))
    return table_rows.select("table_name", F.inline(each)).withColumnRenamed("id", "partition_id").orderBy("partition_id")


def schema_of(columns: list[dict]) -> T.StructType:
    """Catalog columns (column_name, column_type, is_nullable and the like) as a Spark schema."""
    from tideline.functions.types import field

    ordered = sorted(columns, key=lambda c: c["ordinal_position"])
    return T.StructType([field(c["column_name"], c["column_type"], c["is_nullable"] == "YES", key=c.get("column_key") or None, default=c.get("column_default"), comment=c.get("column_comment")) for c in ordered])
