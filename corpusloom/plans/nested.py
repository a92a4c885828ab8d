"""Queries over the nested page records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.pages import page_children
from corpusloom.plans.pagesql import CHILDREN
from corpusloom.session import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_children(table(spark, sf_dir, "page_json"))


QUERIES = {"p4_found": p4_found}
ORACLE = {"p4_found": f"WITH {CHILDREN} SELECT * FROM ch"}
