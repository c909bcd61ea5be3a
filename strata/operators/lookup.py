"""Dimension lookups.

A side gets a broadcast hint only where its size is proven by construction (see
``facts.zone_roles``: at most 265 zones). Everything else goes without a hint, and
Spark's size check on the stored table decides: a side under
``spark.sql.autoBroadcastJoinThreshold`` is broadcast, beyond that the join shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def role_view(dim: DataFrame, key: str, columns: dict[str, str], role_key: str) -> DataFrame:
    """The same dimension in one role: ``key`` renamed to ``role_key``, attributes renamed."""
    return dim.select(F.col(key).alias(role_key), *[F.col(src).alias(dst) for src, dst in columns.items()])


def code_view(codes: DataFrame, code_type: str, alias: str) -> DataFrame:
    """One code type of an entity-attribute dictionary as (``_<alias>_code``, ``alias``)."""
    return (codes.filter(F.col("code_type") == F.lit(code_type))
            .select(F.col("code").alias(f"_{alias}_code"), F.col("description").alias(alias)))


def code_lookup(fact: DataFrame, codes: DataFrame, specs: Sequence[tuple[str, str, str]], default: str) -> DataFrame:
    """Decode several coded columns from one dictionary.

    ``specs`` = [(code_type, fact_column, output_alias)]; unmatched codes get ``default``.
    """
    out = fact
    for code_type, fact_col, alias in specs:
        view = code_view(codes, code_type, alias)
        out = out.join(view, F.col(fact_col) == F.col(f"_{alias}_code"), "left").drop(f"_{alias}_code")
    return out.fillna({alias: default for _, _, alias in specs})
