"""Business records from the tables at hand: every part is a reference, and two noisy sources repeat every part.

Names are p_name and p_brand with a legal form, addresses a number, the part's type as a street, and a postal code from
its size.  Source 2 shouts and punctuates; source 3 abbreviates, and has no address for every fifth part.  Every
seventh part is a true singleton: its copies count as other businesses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesake.sources.records import entities

COUNTRIES, FORMS, SHORT = ["US", "India", "France"], ["LLC", "Private Limited", "SARL"], ["Co", "Pvt Ltd", "SAS"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(spark: SparkSession, rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt over all cores: a small file is one task, however much is computed from each of its rows."""
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), key)


def _pick(values: list[str]):
    return F.element_at(F.array(*map(F.lit, values)), (F.col("p_partkey") % 3 + 1).cast("int"))


def part_records(spark: SparkSession, sf_dir: str, source: int) -> DataFrame:
    """entity_id, business_name, business_address, country of one source."""
    part = spread(spark, load(spark, sf_dir, "part"), "p_partkey")
    plain = F.concat_ws(" ", "p_name", "p_brand")
    house, code = F.col("p_partkey").cast("string"), F.lpad((F.col("p_size") * 97 + 10000).cast("string"), 6, "0")
    if source == 1:
        name, address = F.concat_ws(" ", plain, _pick(FORMS)), F.concat_ws(" ", house, "p_type", F.lit("Street"), code)
    elif source == 2:
        name, address = F.replace(F.upper(F.concat_ws(" ", plain, _pick(FORMS))), F.lit(" "), F.lit(" - ")), F.concat_ws(", ", house, F.lower("p_type"), F.lit("street"), code)
    else:
        name = F.concat_ws(" ", plain, _pick(SHORT))
        address = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.concat_ws(" ", house, "p_type", F.lit("St"), code))
    return part.select(F.concat(F.lit(f"S{source}-"), house).alias("entity_id"), name.alias("business_name"), address.alias("business_address"), _pick(COUNTRIES).alias("country"))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of source 1 with ref_idx, the input order (the part key)."""
    rows = entities(part_records(spark, sf_dir, 1))
    return rows.withColumn("ref_idx", F.split("eid", "-")[1].cast("long"))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities(part_records(spark, sf_dir, 2).unionByName(part_records(spark, sf_dir, 3)))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ref_id, target_id of the true links."""
    part = load(spark, sf_dir, "part").filter("p_partkey % 7 != 0")
    return part.select(F.concat(F.lit("S1-"), "p_partkey").alias("ref_id"), F.explode(F.array(F.concat(F.lit("S2-"), "p_partkey"), F.concat(F.lit("S3-"), "p_partkey"))).alias("target_id"))


#: The same entities in DuckDB, as the start of a WITH clause.
ENTITY_SQL = r"""
rec AS (
  SELECT s.source, p_partkey AS k, 'S' || s.source || '-' || p_partkey AS eid,
    CASE s.source WHEN 1 THEN p_name || ' ' || p_brand || ' ' || ['LLC', 'Private Limited', 'SARL'][p_partkey % 3 + 1]
      WHEN 2 THEN replace(upper(p_name || ' ' || p_brand || ' ' || ['LLC', 'Private Limited', 'SARL'][p_partkey % 3 + 1]), ' ', ' - ')
      ELSE p_name || ' ' || p_brand || ' ' || ['Co', 'Pvt Ltd', 'SAS'][p_partkey % 3 + 1] END AS business_name,
    CASE s.source WHEN 1 THEN p_partkey || ' ' || p_type || ' Street ' || lpad((p_size * 97 + 10000)::VARCHAR, 6, '0')
      WHEN 2 THEN p_partkey || ', ' || lower(p_type) || ', street, ' || lpad((p_size * 97 + 10000)::VARCHAR, 6, '0')
      WHEN 3 THEN CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_partkey || ' ' || p_type || ' St ' || lpad((p_size * 97 + 10000)::VARCHAR, 6, '0') END END AS business_address,
    ['US', 'India', 'France'][p_partkey % 3 + 1] AS country
  FROM part, (VALUES (1), (2), (3)) s(source)),
norm AS (
  SELECT source, k, eid, business_name, business_address, array_to_string(regexp_extract_all(strip_accents(replace(replace(lower(business_name), 'ß', 'ss'), '&', ' and ')), '[\p{L}\p{M}\p{N}]+'), ' ') AS name,
    array_to_string(list_transform(regexp_extract_all(strip_accents(lower(business_address)), '[\p{L}\p{M}\p{N}]+'),
      lambda t: CASE t WHEN 'street' THEN 'st' WHEN 'road' THEN 'rd' WHEN 'avenue' THEN 'ave' WHEN 'boulevard' THEN 'blvd' WHEN 'drive' THEN 'dr' WHEN 'lane' THEN 'ln' WHEN 'apartment' THEN 'apt' WHEN 'suite' THEN 'ste' ELSE t END), ' ') AS address,
    lower(country) AS country
  FROM rec),
ent AS (
  SELECT *, CASE WHEN len(toks) = 0 THEN name ELSE array_to_string(toks, ' ') END AS core
  FROM (SELECT *, list_filter(string_split(name, ' '), lambda t: t <> '' AND t NOT IN ('inc','incorporated','corp','corporation','llc','ltd','limited','pvt','private','co','company')) AS toks FROM norm))
"""
