"""The registered queries of the core operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lavra.operators.packed_fields import FieldGrammar, split_packed_fields
from lavra.plans import curated_queries, staging_queries, text_queries
from lavra.session import table

PACKED_FIELDS = {
    "Link de acesso": FieldGrammar(addresses=True),
    "Assuntos em português": FieldGrammar(headings=True),
    "Tipos de acesso": FieldGrammar(),
}


def p3_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the packed export fields, single values included, with error flags."""
    return split_packed_fields(table(spark, sf_dir, "bdtd_search_csv"), "csv_row", PACKED_FIELDS)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_values(spark, sf_dir).where("values_in_field >= 2").select("csv_row", "field_name", "pos", "item")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p3_found": p3_found, "p3_values": p3_values} | text_queries.QUERIES | staging_queries.QUERIES | curated_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return text_queries.ORACLES | staging_queries.ORACLES | curated_queries.ORACLES
