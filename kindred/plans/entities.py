"""Entity views over the driver's tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PART = """
SELECT concat(CASE p_partkey % 3 WHEN 0 THEN 'S1-' WHEN 1 THEN 'S2-' ELSE 'S3-' END, lpad(CAST(p_partkey AS {string}), 10, '0')) AS entity_id,
       CASE WHEN p_partkey % 7 = 1 THEN concat(replace(p_name, ' ', ''), '.com')
            ELSE concat(p_name, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' Pvt. Ltd' WHEN 2 THEN ', Inc.' ELSE ' & Co' END) END AS business_name,
       concat(CAST(p_size + 10 AS {string}), ' ', p_brand, ' Road ', CAST(560000 + p_size AS {string})) AS business_address,
       p_type AS country
FROM part
"""
DOCUMENTS = """
SELECT concat(CASE doc_id % 3 WHEN 0 THEN 'S1-' WHEN 1 THEN 'S2-' ELSE 'S3-' END, lpad(CAST(doc_id AS {string}), 10, '0')) AS entity_id,
       CASE WHEN doc_id % 3 = 2 THEN translate(text, 'éèêçàâîôûäöüóíáñ', 'eeecaaiouaouoian') ELSE text END AS business_name,
       concat(CAST(10 + n_chars % 90 AS {string}), ' ', source, ' ', CAST(100000 + n_chars AS {string})) AS business_address,
       CASE WHEN doc_id % 7 = 6 THEN 'xx' ELSE lang END AS country
FROM documents
"""
VIEWS = {"part": PART, "documents": DOCUMENTS}


def entities(spark: SparkSession, sf_dir: str, view: str = "part") -> DataFrame:
    return spark.sql(VIEWS[view].format(string="STRING").replace(f"FROM {view}", f"FROM parquet.`{sf_dir}/{view}.parquet`"))


def kinded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part view with ``kind``, which true pairs share; null where it can't be told."""
    kind = "p_type AS country, CASE WHEN p_name IS NOT NULL AND p_brand IS NOT NULL AND p_type IS NOT NULL THEN struct(p_name, p_brand, p_type) END AS kind"
    return spark.sql(PART.format(string="STRING").replace("p_type AS country", kind).replace("FROM part", f"FROM parquet.`{sf_dir}/part.parquet`"))


def sides(all_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries (S1) and targets (S2 and S3)."""
    return all_.where("entity_id LIKE 'S1-%'"), all_.where("NOT entity_id LIKE 'S1-%'")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, eid) of parts with one name, brand and type."""
    return spark.sql(TRUTH.format(string="STRING").replace("FROM part", f"FROM parquet.`{sf_dir}/part.parquet`"))


TRUTH = """
WITH p AS (SELECT concat(CASE p_partkey % 3 WHEN 0 THEN 'S1-' WHEN 1 THEN 'S2-' ELSE 'S3-' END, lpad(CAST(p_partkey AS {string}), 10, '0')) AS id, p_name, p_brand, p_type FROM part)
SELECT a.id AS s1_id, b.id AS eid FROM p a JOIN p b ON a.p_name = b.p_name AND a.p_brand = b.p_brand AND a.p_type = b.p_type
WHERE a.id LIKE 'S1-%' AND NOT b.id LIKE 'S1-%'
"""
