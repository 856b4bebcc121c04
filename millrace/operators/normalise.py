"""Splitting one wide table into related ones: N2-N4.

Keys are expressions of the values (:func:`millrace.functions.entity_key`), so no
operator here has to join the new table back: the fact side is a projection.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import entity_key
from millrace.operators.registry import STEPS
from millrace.operators.rows import deduplicate


@STEPS.register("extract_df")
def split_values(
    df: DataFrame,
    split_column: str,
    id_columns: list[str],
    dedup_columns: list[str],
    delimiter: str = ",",
    value_column: str = "value",
    key_column: str = "id",
) -> tuple[DataFrame, DataFrame]:
    """``(records, values)``: the other columns, one row per ``dedup_columns``; and
    one row per record id and distinct part of ``split_column``, with a stable key.

    A record without values stays in ``records`` and has no row in ``values``; an empty part
    is no value.
    """
    records = deduplicate(df.drop(split_column), dedup_columns)
    parts = F.filter(F.split(F.col(split_column), re.escape(delimiter)), lambda part: part != "")
    values = (
        df.select(*id_columns, F.explode(parts).alias(value_column))
        .distinct()
        .withColumn(key_column, entity_key(*id_columns, value_column))
    )
    return records, values


@STEPS.register("extract_unique_entities")
def extract_entities(
    df: DataFrame,
    entity_columns: list[str],
    id_column: str,
    drop_original_columns: bool = True,
    drop_after_join: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(facts, entities)``: facts carry the entity's key, entities are the distinct
    tuples with it.  If ``id_column`` is one of the entity columns it is the key."""
    natural = id_column in entity_columns
    entities = df.select(*entity_columns).distinct()
    facts = df
    if not natural:
        entities = entities.withColumn(id_column, entity_key(*entity_columns))
        facts = facts.withColumn(id_column, entity_key(*entity_columns))
    if drop_original_columns:
        facts = facts.drop(*[c for c in entity_columns if c != id_column])
    return facts.drop(*(drop_after_join or [])), entities


@STEPS.register("extract_transitive_dependencies")
def extract_dependencies(
    df: DataFrame,
    determinant_columns: list[str],
    dependent_columns: list[str],
    new_table_name: str,
    drop_original_columns: bool = True,
    variants_column: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(facts, lookup)``: facts carry ``<new_table_name>_id``, lookup holds one row
    per determinant with its dependents.

    Where a determinant has several dependents the smallest tuple is kept, and
    ``variants_column`` counts them, so more than 1 marks a broken dependency.
    """
    key = f"{new_table_name}_id"
    # distinct pairs first: a hash aggregate that reduces a hot determinant in its map tasks
    pairs = df.select(*determinant_columns, *dependent_columns).distinct()
    groups = pairs.groupBy(*determinant_columns).agg(
        F.min(F.struct(*dependent_columns)).alias("_chosen"),
        F.count(F.lit(1)).alias(variants_column or "_variants"),
    )
    lookup = groups.select(
        *determinant_columns,
        *[F.col(f"_chosen.{c}").alias(c) for c in dependent_columns],
        *([variants_column] if variants_column else []),
        entity_key(*determinant_columns).alias(key),
    )
    facts = df.withColumn(key, entity_key(*determinant_columns))
    return (facts.drop(*dependent_columns) if drop_original_columns else facts), lookup
