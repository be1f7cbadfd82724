"""The registry, table access, and SQL fragments shared by the DuckDB side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import WHITE
from corpusloom.sources.io import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


# Benchmarks and tests set this to spread a fixture of one split over the cores, round robin.
SPREAD: int | None = None


def table(spark: SparkSession, sf: str, name: str, *cols: str) -> DataFrame:
    df = read_table(spark, f"{sf}/{name}.parquet", *cols)
    return df.repartition(SPREAD) if SPREAD else df


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# SQL fragments.  They are written against DuckDB and do not call into the library's expressions.
def words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WHITE}'), lambda w: w <> '')"


def bare_sql(text: str) -> str:
    return (
        f"list_transform({words_sql(f'lower({text})')}, "
        "lambda w: regexp_replace(w, '^[^\\p{L}]+|[^\\p{L}]+$', '', 'g'))"
    )


def ngrams_sql(words: str, n: int) -> str:
    return (
        f"list_transform(range(1, greatest(len({words}) - {n} + 2, 1)), "
        f"lambda i: array_to_string({words}[i : i + {n} - 1], ' '))"
    )


def ratio_sql(a: str, b: str) -> str:
    return f"case when ({b}) > 0 then ({a})::double / ({b}) else 0.0::double end"
