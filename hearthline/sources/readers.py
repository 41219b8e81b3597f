"""Typed scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from hearthline.layers import Layers
from hearthline.schemas import CHANNELS_RAW, LAYER_TABLES, MESSAGES_RAW, VOICE_RAW


def _parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # partition values are read as declared: ids and ISO dates in directory names must not be re-typed
    return spark.read.schema(schema).parquet(path)


def read_messages_raw(spark: SparkSession, path: str) -> DataFrame:
    return _parquet(spark, path, MESSAGES_RAW)


def read_voice_raw(spark: SparkSession, path: str) -> DataFrame:
    return _parquet(spark, path, VOICE_RAW)


def read_channels_raw(spark: SparkSession, path: str) -> DataFrame:
    return _parquet(spark, path, CHANNELS_RAW)


def read_csv_source(spark: SparkSession, path: str, schema: T.StructType | str, **options: object) -> DataFrame:
    return spark.read.schema(schema).options(**{"header": True, **options}).csv(path)


def declared_schema(table: str) -> T.StructType:
    return next(tables[table] for tables in LAYER_TABLES.values() if table in tables)


def read_table(spark: SparkSession, layers: Layers, table: str) -> DataFrame:
    name = layers.name(table)
    return _parquet(spark, name, declared_schema(table)) if layers.root else spark.read.table(name)


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """True for a catalog table, or for a path that holds readable Parquet data."""
    if "/" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    try:
        spark.read.parquet(name_or_path)
        return True
    except AnalysisException:
        return False
