"""Audit columns of the three layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.cleanse import typed_null
from stratalake.functions.keys import record_hash, surrogate_key


def batch_label(layer: str, execution: str) -> str:
    """``<layer>_<execution>`` with the punctuation of the timestamp removed."""
    return f"{layer}_{execution.replace('-', '').replace(':', '')}"


def _carried(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else typed_null("string")


def add_bronze_audit(
    df: DataFrame, table: str, source: str, batch_id: str, load_time: Column, natural_key: list[str], compat: bool = False
) -> DataFrame:
    """Landing audit: load time, origin, batch, current flag, record hash and key."""
    data = [c for c in df.columns if not c.startswith("br_")]
    return df.withColumns(
        {
            "br_load_time": load_time,
            "br_source_file": F.lit(source),
            "br_batch_id": F.lit(batch_id),
            "br_is_current": F.lit(True),
            "br_record_hash": record_hash(data, compat),
            f"br_{table}_key": surrogate_key(f"br_{table}", *natural_key),
        }
    )


def add_silver_audit(df: DataFrame, entity: str, batch_id: str, at: Column) -> DataFrame:
    """Silver audit; the bronze key is a typed NULL where the entity has none."""
    return df.withColumns(
        {
            "sl_created_time": at,
            "sl_updated_time": at,
            "sl_source_bronze_key": _carried(df, f"br_{entity}_key"),
            "sl_is_active": F.lit(True),
            "sl_batch_id": F.lit(batch_id),
        }
    )


def add_gold_audit(df: DataFrame, entity: str, batch_id: str, at: Column) -> DataFrame:
    """Gold audit; carries the silver key as lineage."""
    return df.withColumns(
        {
            "gl_created_time": at,
            "gl_updated_time": at,
            "gl_source_silver_key": _carried(df, f"sl_{entity}_key"),
            "gl_is_current": F.lit(True),
            "gl_batch_id": F.lit(batch_id),
        }
    )
