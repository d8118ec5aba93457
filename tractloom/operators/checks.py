"""Fail-closed checks: a rule gives the rows that break it; publishing waits until there are none.

A violation is (check_order, code, key, detail). Rules run as ordinary plans before anything is published, and the
lowest check_order names the error, so the first rule of a sequence is the one reported.
"""

from __future__ import annotations

import json
from contextlib import suppress
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ConformanceError(ValueError):
    def __init__(self, code: str, detail: str = "") -> None:
        super().__init__(f"{code}: {detail}")
        self.code = code


def violations(broken: DataFrame, order: int, code: str, key: Column, detail: str | Column = "") -> DataFrame:
    """All rows of `broken` as violations."""
    said = F.lit(detail) if isinstance(detail, str) else detail
    return broken.select(F.lit(order).alias("check_order"), F.lit(code).alias("code"), key.cast("string").alias("key"), said.cast("string").alias("detail"))


def where_not(df: DataFrame, condition: Column, order: int, code: str, key: Column, detail: str = "") -> DataFrame:
    """Rows that do not meet the condition; unknown counts as not met."""
    return violations(df.where(~F.coalesce(condition, F.lit(False))), order, code, key, detail)


def duplicates(df: DataFrame, keys: list[str], order: int, code: str) -> DataFrame:
    """Keys with more than one row."""
    many = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1")
    return violations(many, order, code, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.col("__n"))


def not_covered(left: DataFrame, right: DataFrame, keys: list[str], order: int, code: str) -> DataFrame:
    """Keys of left that right lacks."""
    gone = left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")
    return violations(gone, order, code, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))


def exact_cover(left: DataFrame, right: DataFrame, keys: list[str], order: int, duplicate_code: str, cover_code: str) -> list[DataFrame]:
    """Right has each key of left once and no other."""
    return [duplicates(right, keys, order, duplicate_code), not_covered(left, right, keys, order + 1, cover_code), not_covered(right, left, keys, order + 1, cover_code)]


def empty(df: DataFrame, order: int, code: str, detail: str = "") -> DataFrame:
    """One violation if df has no row."""
    return violations(df.limit(1).agg(F.count("*").alias("n")).where("n = 0"), order, code, F.lit(""), detail)


def union(found: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


def require_none(found: list[DataFrame]) -> None:
    """Raise the violation of the lowest check_order, if any. One small row comes to the driver."""
    if found:
        first = union(found).agg(F.min(F.struct("check_order", "code", "key", "detail")).alias("v")).first().v
        if first is not None:
            raise ConformanceError(first.code, f"{first.key} {first.detail}".strip())


def forbidden_keys(spark: SparkSession, df: DataFrame, forbidden: frozenset[str]) -> DataFrame:
    """key of every column or nested field whose name, lower-cased and trimmed, is forbidden; maps are read by key."""
    from pyspark.sql import types as T

    found: list[str] = []

    def walk(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                at = f"{path}.{f.name}" if path else f.name
                if f.name.strip().lower() in forbidden:
                    found.append(at)
                walk(f.dataType, at)
        elif isinstance(kind, T.ArrayType):
            walk(kind.elementType, path)
        elif isinstance(kind, T.MapType):
            walk(kind.valueType, path)

    walk(df.schema, "")
    return spark.createDataFrame([(k,) for k in found], "key string")


def forbidden_json_keys(documents: Column, forbidden: frozenset[str]) -> Column:
    """The forbidden keys of a JSON column at any depth, inside objects and arrays, each once and sorted. Text that is no
    JSON has none, as have null and scalars."""

    @F.arrow_udf("array<string>")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            found, stack = set(), []
            with suppress(ValueError, RecursionError):
                stack.append(json.loads(t or "null"))
            while stack:
                x = stack.pop()
                if isinstance(x, dict):
                    found.update(k for k in x if k.strip().lower() in forbidden)
                    stack.extend(x.values())
                elif isinstance(x, list):
                    stack.extend(x)
            out.append(sorted(found))
        return pa.array(out, type=pa.list_(pa.string()))

    return of(documents)
