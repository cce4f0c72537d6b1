"""Register-, registry- and employee-shaped views over the driver's tables.

The same SQL text runs in Spark (tables as arguments) and in the SQL oracle, so both sides start
from equal rows. All rows of `part` and `supplier` are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.dealing import thinly

REGISTER = """
SELECT p.p_partkey AS pos,
  CASE p.p_partkey % 6
    WHEN 0 THEN p.p_name || ' b' || substr(p.p_brand, 7) || ' Ltd'
    WHEN 1 THEN p.p_name || ' b' || substr(p.p_brand, 7) || ' Holdings PLC'
    WHEN 2 THEN p.p_name || ' b' || substr(p.p_brand, 7) || ' (UK) Limited'
    WHEN 3 THEN p.p_name || ' b' || substr(p.p_brand, 7) || ' T/A ' || split_part(p.p_name, ' ', 2) || ' ' || split_part(p.p_name, ' ', 1) || ' b' || substr(p.p_brand, 7)
    WHEN 4 THEN p.p_name || ' (' || split_part(p.p_name, ' ', 2) || ' works) & Co'
    ELSE p.p_name || ' - b' || substr(p.p_brand, 7) || ' group' END AS name,
  n.n_name AS town, r.r_name AS county,
  CASE WHEN p.p_size % 4 = 0 THEN 'Worker (B rating)' WHEN p.p_size % 4 = 1 THEN 'Worker (A Rating)' ELSE 'Worker (A (Premium) A rating)' END AS rating,
  CASE WHEN p.p_size % 5 = 0 THEN 'Student' ELSE 'Skilled Worker' END AS route
FROM {part} p JOIN {nation} n ON n.n_nationkey = p.p_partkey % 25 JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""
REGISTRY = """
SELECT lpad(CAST(p.p_partkey AS STRING), 8, '0') AS number,
  upper(p.p_name) || ' B' || substr(p.p_brand, 7) || CASE WHEN p.p_size % 2 = 0 THEN ' LIMITED' ELSE ' SOFTWARE LTD' END AS name,
  CASE p.p_size % 5 WHEN 0 THEN 'Private Limited Company' WHEN 1 THEN 'PLC' WHEN 2 THEN 'Limited Partnership' WHEN 3 THEN 'Community Interest Company' ELSE ' Ltd. ' END AS category,
  CASE p.p_size % 3 WHEN 0 THEN 'Liquidation' ELSE ' Active' END AS status,
  CASE WHEN p.p_partkey % 11 = 0 THEN '' WHEN p.p_partkey % 2 = 0
    THEN lpad(CAST(1 + p.p_partkey % 28 AS STRING), 2, '0') || '/' || lpad(CAST(1 + p.p_partkey % 12 AS STRING), 2, '0') || '/' || CAST(1990 + p.p_partkey % 36 AS STRING)
    ELSE CAST(1990 + p.p_partkey % 36 AS STRING) || '-' || lpad(CAST(1 + p.p_partkey % 12 AS STRING), 2, '0') || '-' || lpad(CAST(1 + p.p_partkey % 28 AS STRING), 2, '0') END AS incorporated,
  CASE p.p_size % 6 WHEN 0 THEN '62020 - Information technology consultancy activities' WHEN 1 THEN '86101 - Hospital activities' WHEN 2 THEN '63110 - Data processing' WHEN 3 THEN '41201 - Construction of commercial buildings' WHEN 4 THEN '' ELSE '58290 - Other software publishing' END AS sic1,
  CASE p.p_size % 4 WHEN 0 THEN '87100 - Residential nursing care' WHEN 1 THEN '62012 - Business software' WHEN 2 THEN ' ' ELSE 'None Supplied' END AS sic2,
  n.n_name AS town, r.r_name AS county, 'EC' || CAST(p.p_size AS STRING) || ' 1AA' AS postcode,
  'http://data.example.org/doc/company/' || lpad(CAST(p.p_partkey AS STRING), 8, '0') AS uri
FROM {part} p JOIN {nation} n ON n.n_nationkey = p.p_partkey % 25 JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""
EMPLOYEES = """
SELECT lpad(CAST(s_suppkey * 7 AS STRING), 8, '0') AS company_number, CAST(CAST(floor(abs(s_acctbal)) AS INT) + 1 AS STRING) AS employee_count,
  'supplier table' AS employee_count_source, '2026-02-06' AS employee_count_snapshot_date
FROM {supplier}
"""
REGISTRY_COLUMNS = {"name": "name", "number": "number", "category": "category", "status": "status", "date": "incorporated", "sic1": "sic1", "sic2": "sic2", "town": "town", "county": "county", "postcode": "postcode", "uri": "uri"}
_TABLES = {REGISTER: ("part", "nation", "region"), REGISTRY: ("part", "nation", "region"), EMPLOYEES: ("supplier",)}


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The rows of a view. Those of `part`, which may lie in a file or two, are dealt by their key as they are
    read, before each is made several times as wide."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES[text]}
    return spark.sql(text, **{t: thinly(df, "p_partkey") if t == "part" else df for t, df in tables.items()})


def sql(text: str) -> str:
    return text.format(**{t: t for t in _TABLES[text]})
