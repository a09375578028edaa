"""Nested JSON reports: assembled from tidy tables, written by run, read back and flattened.

A report is one row whose columns are sections; a section maps the key of each
of its rows to a struct. The walker unfolds whatever nesting it meets, from the schema
alone, into one row per leaf: structs by name, maps by key, arrays by position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from keepwell.sources import store

_LEAF = "struct<path:string,number:double,text:string>"
_NUMBERS = ("integer", "long", "double", "float", "decimal", "short", "byte")


def section(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: a map from the joined key of each row to its other columns. Keys are few."""
    values = [c for c in rows.columns if c not in key]
    entry = F.struct(F.concat_ws("|", *[F.col(c).cast("string") for c in key]).alias("key"), F.struct(*values).alias("value"))
    return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("section"))


def report(kind: str, sections: Mapping[str, DataFrame]) -> DataFrame:
    """One row: the kind of report and its sections."""
    out = None
    for name, one in sections.items():
        named = one.select(F.col("section").alias(name))
        out = named if out is None else out.join(named)               # single rows
    return out.select(F.lit(kind).alias("report"), "*")


def write_report(one: DataFrame, root: str, run_ts: str) -> T.StructType:
    """Write a report of a run as JSON; returns the schema to read it with."""
    kind = one.first()["report"]
    store.write_json(one, f"{root}/{kind}/run_ts={run_ts}")
    return one.schema


def read_report(spark: SparkSession, root: str, kind: str, run_ts: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored report; without a schema it is inferred and maps come back as structs."""
    path = f"{root}/{kind}/run_ts={run_ts}"
    return spark.read.json(path) if schema is None else store.read_json(spark, path, schema)


def newest_report(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The latest report of a kind with its ``run_ts``."""
    return store.newest_run(spark.read.json(f"{root}/{kind}").withColumn("run_ts", F.col("run_ts").cast("string")))


def _leaves(value: Column, kind: T.DataType, path: Column, depth: int) -> Column:
    """All leaves below a value as an array of (path, number, text)."""
    step = lambda name: F.when(path == "", name).otherwise(F.concat(path, F.lit("."), name))
    none = F.array().cast(f"array<{_LEAF}>")
    if isinstance(kind, T.StructType):
        parts = [_leaves(value[f.name], f.dataType, step(F.lit(f.name)), depth + 1) for f in kind]
        return F.when(value.isNotNull(), F.concat(*parts)).otherwise(none) if parts else none
    if isinstance(kind, T.MapType):
        inside = F.transform(F.map_entries(value), lambda e: _leaves(e["value"], kind.valueType, step(e["key"].cast("string")), depth + 1))
        return F.coalesce(F.flatten(inside), none)
    if isinstance(kind, T.ArrayType):
        inside = F.transform(value, lambda e, i: _leaves(e, kind.elementType, step(i.cast("string")), depth + 1))
        return F.coalesce(F.flatten(inside), none)
    numeric = kind.typeName() in _NUMBERS or isinstance(kind, T.BooleanType)
    number = value.cast("double") if kind.typeName() in _NUMBERS else value.cast("int").cast("double") if numeric else F.lit(None).cast("double")
    text = F.lit(None).cast("string") if numeric else value.cast("string")
    return F.array(F.struct(path.alias("path"), number.alias("number"), text.alias("text")).cast(_LEAF))


def flatten(documents: DataFrame, keep: Sequence[str] = ("report",)) -> DataFrame:
    """(keep..., path, number, text): one row per leaf of the other columns. Leaves without a value stay, as nulls."""
    rest = [f for f in documents.schema if f.name not in keep]
    leaves = F.concat(*[_leaves(F.col(f.name), f.dataType, F.lit(f.name), 0) for f in rest])
    return documents.select(*keep, F.explode(leaves).alias("leaf")).select(*keep, "leaf.*")
