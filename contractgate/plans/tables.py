"""Readers for the driver's test tables and the contracts written for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.contract import PACKAGE_CONTRACTS, Contract, load_contract

TPCH_CONTRACTS = PACKAGE_CONTRACTS / "tpch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tpch_contract(entity: str) -> Contract:
    return load_contract(entity, TPCH_CONTRACTS)
