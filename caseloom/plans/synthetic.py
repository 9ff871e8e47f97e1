"""A clinical projection of the star-schema tables.

Every text comes from integer keys, so that one SQL text gives the same rows in
Spark and in other engines.  ``{tables}`` are registered as temporary views by
``views``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run(spark: SparkSession, sf_dir: str, sql: str, *names: str, **more: DataFrame) -> DataFrame:
    """SQL over these tables; names in braces stand for the data frames."""
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names}, **more)


_ID = "'HP:' || lpad(CAST({0} AS STRING), 7, '0')"
TERM = _ID.format

#: Cases by order; o is orders, c is customer, t the order's terms.
CASES = f"""
SELECT 'CASE' || CAST(o_orderkey + 1 AS STRING) AS ID,
       CASE c_custkey % 8 WHEN 0 THEN ' M ' WHEN 1 THEN 'female' WHEN 2 THEN 'Girl' WHEN 3 THEN 'boy' WHEN 4 THEN 'intersex' WHEN 5 THEN 'Not reported' WHEN 6 THEN 'n/a' END AS sex,
       CASE o_orderkey % 14 WHEN 0 THEN CAST(o_orderkey % 90 AS STRING) || 'Y' WHEN 1 THEN CAST(o_orderkey % 20 AS STRING) || ' months' WHEN 2 THEN 'Infant'
            WHEN 3 THEN 'Not reported' WHEN 4 THEN '1 week 3 days' WHEN 5 THEN '3 years 6 months' WHEN 6 THEN '1.5 years' WHEN 7 THEN 'prenatal'
            WHEN 8 THEN 'unknown' WHEN 9 THEN CAST(o_orderkey % 7 AS STRING) || ' weeks' WHEN 10 THEN '6MY' WHEN 11 THEN ' p3y ' WHEN 12 THEN '' END AS age,
       CASE WHEN o_orderkey % 3 = 0 THEN 'yes' WHEN o_orderkey % 3 = 1 THEN 'Not reported' END AS consanguinityStatus,
       'F' || CAST(c_custkey AS STRING) AS familyId, 'Not reported' AS totalFamilyMembers, 'Not reported' AS totalCohortMembers,
       t.phenotypes AS phenotypicFeatures, t.ids AS phenotypicFeatureIds, 'WES' AS `procedure`, 'Not reported' AS procedureStrategy, o_orderstatus AS diagnosis,
       CASE o_orderkey % 8 WHEN 0 THEN 'Disease ' || CAST(c_nationkey AS STRING) || ' (OMIM:' || lpad(CAST(o_orderkey % 999983 AS STRING), 6, '1') || ')'
            WHEN 1 THEN 'omim 654321' WHEN 2 THEN 'Disease #' || lpad(CAST(c_custkey AS STRING), 6, '2') WHEN 3 THEN 'Not reported'
            WHEN 4 THEN 'OMIM:1234567' WHEN 5 THEN 'MIM 123456' WHEN 6 THEN 'OMIM 123456, OMIM:654321' END AS diagnosticComment,
       CASE o_orderkey % 9 WHEN 0 THEN 'GENE' || CAST(c_nationkey AS STRING) || ':c.' || CAST(o_orderkey % 500 AS STRING) || 'A>G'
            WHEN 1 THEN 'BRCA' || CAST(c_custkey % 5 AS STRING) || ':NM_007294.3:c.1A>G;TP53 p.Arg1Ter' WHEN 2 THEN 'TTN [x]; ;CHR1:123'
            WHEN 3 THEN 'Not reported' WHEN 4 THEN 'NM_001:c.1A>G' WHEN 5 THEN 'C9orf72:c.1A>G;HLA-A:c.1A>G;TP53 (c.1A>G)' WHEN 6 THEN '' WHEN 7 THEN 'SCN1A:NM_001165963.4:c.2398G>A:p.Glu800Lys|g.5A>T' END AS genomicVariants,
       CASE WHEN o_orderkey % 2 = 0 THEN 'het' ELSE 'Not reported' END AS zygosityStatus,
       CASE c_custkey % 9 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Likely pathogenic' WHEN 2 THEN 'VUS' WHEN 3 THEN 'Likely Benign' WHEN 4 THEN 'benign'
            WHEN 5 THEN 'DM' WHEN 6 THEN 'Not reported' WHEN 7 THEN 'Pathogenic;;;' END AS variantInterpretation,
       c_mktsegment AS dataSourceType,
       CASE o_orderkey % 5 WHEN 0 THEN 'https://pubmed.ncbi.nlm.nih.gov/' || CAST(o_orderkey AS STRING) || '/' WHEN 1 THEN 'https://doi.org/10.1186/s12920-020-00743-8'
            WHEN 2 THEN 'a, b , ,c' WHEN 3 THEN 'Not reported' ELSE 'PMID:' || CAST(o_orderkey AS STRING) END AS externalReference,
       o_orderkey AS k
FROM ORDERS JOIN CUSTOMER ON c_custkey = o_custkey LEFT JOIN TERMS t ON t.k = o_orderkey
"""
#: An order's distinct terms: ids joined by commas, and a text that mentions them.
TERMS = {
    "spark": f"SELECT l_orderkey AS k, array_join(array_sort(collect_set({TERM('l_partkey')})), ',') AS ids, array_join(array_sort(collect_set('Finding ' || CAST(l_partkey % 50 AS STRING) || ' (' || {TERM('l_partkey')} || ')')), '|') || ', free text ' || CAST(l_orderkey % 30 AS STRING) || ',(OMIM:204000)' AS phenotypes FROM LINEITEM GROUP BY l_orderkey",
    "duckdb": f"SELECT l_orderkey AS k, array_to_string(list_sort(list(DISTINCT {TERM('l_partkey')})), ',') AS ids, array_to_string(list_sort(list(DISTINCT 'Finding ' || CAST(l_partkey % 50 AS STRING) || ' (' || {TERM('l_partkey')} || ')')), '|') || ', free text ' || CAST(l_orderkey % 30 AS STRING) || ',(OMIM:204000)' AS phenotypes FROM lineitem GROUP BY l_orderkey",
}
#: Terms of the dictionary, and the ontology's edges, from part.
DICTIONARY = f"SELECT {TERM('p_partkey')} AS id, p_brand || ' ' || p_name || ' ' || p_type AS label, lower(p_brand || ' ' || p_name || ' ' || p_type) AS name, p_partkey AS ord FROM PART"
EDGES = (
    f"SELECT {TERM('p_partkey')} AS child, {TERM('CAST(floor(p_partkey / 3) AS BIGINT)')} AS parent FROM PART WHERE p_partkey > 0 "
    f"UNION SELECT {TERM('p_partkey')}, {TERM('CAST(floor(p_partkey / 4) AS BIGINT)')} FROM PART WHERE p_partkey > 0 AND p_partkey % 7 = 0"
)
#: Genes are suppliers, their terms the parts of all their lines.  Patients are the query set of the
#: search: every order whose key is divisible by 20, held against all genes and all annotations.
PROFILES = f"SELECT DISTINCT 'GENE' || CAST(l_suppkey AS STRING) AS entity_id, {TERM('l_partkey')} AS term FROM LINEITEM"
PATIENTS = f"SELECT DISTINCT 'CASE' || CAST(l_orderkey + 1 AS STRING) AS id, {TERM('l_partkey')} AS term FROM LINEITEM WHERE l_orderkey % 20 = 0"
TRUTH = "SELECT 'CASE' || CAST(l_orderkey + 1 AS STRING) AS id, min('GENE' || CAST(l_suppkey AS STRING)) AS entity_id FROM LINEITEM WHERE l_orderkey % 20 = 0 GROUP BY l_orderkey"


def braces(sql: str) -> str:
    """Upper-case table names as SQL parameters."""
    for n in ("ORDERS", "CUSTOMER", "LINEITEM", "PART", "TERMS"):
        for lead in ("FROM ", "JOIN "):
            sql = sql.replace(f"{lead}{n} ", f"{lead}{{{n.lower()}}} ").replace(f"{lead}{n}\n", f"{lead}{{{n.lower()}}}\n")
        if sql.endswith(f"FROM {n}"):
            sql = sql[: -len(n)] + f"{{{n.lower()}}}"
    return sql


def plain(sql: str) -> str:
    """The same for an engine where the tables are views."""
    out = braces(sql)
    for n in ("orders", "customer", "lineitem", "part", "terms"):
        out = out.replace(f"{{{n}}}", n)
    return out.replace("`procedure`", '"procedure"')


def terms_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, braces(TERMS["spark"]), "lineitem")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, braces(CASES), "orders", "customer", terms=terms_of_orders(spark, sf_dir))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, braces(DICTIONARY), "part")


WITH_CASES = f"terms AS ({plain(TERMS['duckdb'])}), cases AS ({plain(CASES)})"
