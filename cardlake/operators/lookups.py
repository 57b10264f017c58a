"""Domains of known values, and requests checked against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def domain(df: DataFrame, values: str | Column, name: str | None = None) -> DataFrame:
    """Distinct values, as a DataFrame that is computed when used."""
    column = F.col(values) if isinstance(values, str) else values
    return df.select(column.alias(name) if name else column).distinct()


def distinct_for_join(df: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct values of ``key`` as one column ``name``, to be joined with rows that
    may have a hot key.

    Plain ``distinct`` would lend its shuffle to the join, and adaptive execution
    splits a hot key of one side only where both sides have a shuffle made for the
    join. The second column keeps the two shuffles apart; the distinct values of the
    second one are few compared with the rows.
    """
    keys = df.select(F.col(key).alias(name))
    return keys.withColumn("_apart", F.xxhash64(name)).distinct().select(name)


def _matched(requests: DataFrame, key: str, known: DataFrame, known_key: str, how: str):
    side = distinct_for_join(known, known_key, "_known")
    return requests.join(side, requests[key] == side["_known"], how)


def known_keys(requests: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Requests whose key occurs in ``known``."""
    return _matched(requests, key, known, known_key, "left_semi")


def unknown_keys(requests: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Requests whose key does not occur in ``known``; a null key is unknown."""
    return _matched(requests, key, known, known_key, "left_anti")
