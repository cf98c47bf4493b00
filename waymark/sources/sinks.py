"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def json_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields])


def save_dataset(df: DataFrame, folder: str, prefix: str, partition_by: list[str] | None = None) -> list[str]:
    """CSV, JSON lines and Parquet copies of a table; an empty table writes nothing.

    CSV and Parquet carry nested values as JSON text, JSON lines keep them nested. The table is
    computed once for all three.
    """
    cached = df.persist()
    try:
        if cached.isEmpty():
            return []
        flat = json_text(cached)
        paths = [f"{folder}/{prefix}.{ext}" for ext in ("csv", "jsonl", "parquet")]
        by = partition_by or []
        flat.write.mode("overwrite").partitionBy(*by).option("header", True).option("escape", '"').csv(paths[0])
        cached.write.mode("overwrite").partitionBy(*by).json(paths[1])
        flat.write.mode("overwrite").partitionBy(*by).parquet(paths[2])
        return paths
    finally:
        cached.unpersist()
