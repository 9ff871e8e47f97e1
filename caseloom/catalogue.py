"""Registered queries and their oracle SQL.

Every query runs over its whole tables.  The clinical columns come from
``plans.synthetic``; each query applies the engine's own operators to them, and
the oracle states the rule again in another engine's SQL.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.functions import clinical as C
from caseloom.functions import hgvs
from caseloom.functions.missing import is_missing
from caseloom.operators import harmonize as H
from caseloom.operators import match as M
from caseloom.operators import mentions as N
from caseloom.operators import packets as P
from caseloom.operators import similarity as S
from caseloom.operators import stats
from caseloom.operators import validate as V
from caseloom.plans import pipelines
from caseloom.plans import synthetic as Y
from caseloom.sources.shared import written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
CREATED = "2024-01-01T00:00:00Z"
W = Y.WITH_CASES


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


# --- rules, stated in the oracle's SQL ------------------------------------------

_S = "trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_WORDS = " ".join(f"WHEN {_S.format('upper(age)')} = '{k}' THEN '{v}'" for k, v in C.AGE_WORDS.items())
_N = lambda p: f"regexp_extract({_S.format('upper(age)')}, '{p}', 1)"
AGE = f"""CASE WHEN age IS NULL OR age IN ('', 'Not reported') THEN NULL WHEN starts_with({_S.format('upper(age)')}, 'P') THEN {_S.format('upper(age)')} {_WORDS}
  ELSE nullif('P' || coalesce(nullif({_N(r'(\d+)\s*(?:YEARS?|Y)')}, '') || 'Y', '') || coalesce(nullif({_N(r'(\d+)\s*(?:MONTHS?|M)(?:[^Y]|$)')}, '') || 'M', '')
   || coalesce(nullif({_N(r'(\d+)\s*(?:DAYS?|D)')}, '') || 'D', '') || coalesce(CAST(try_cast({_N(r'(\d+)\s*(?:WEEKS?|W)')} AS BIGINT) * 7 AS VARCHAR) || 'D', ''), 'P') END"""
SEX = f"CASE WHEN sex IS NULL OR sex = 'Not reported' THEN 'UNKNOWN_SEX' " + " ".join(f"WHEN lower({_S.format('sex')}) IN ({', '.join(map(repr, w))}) THEN '{k}'" for k, w in C.SEX_WORDS.items()) + " ELSE 'UNKNOWN_SEX' END"
ACMG = "CASE WHEN variantInterpretation IS NULL OR variantInterpretation = 'Not reported' THEN 'NOT_PROVIDED' " + " ".join(f"WHEN contains(lower(variantInterpretation), '{k}') THEN '{v}'" for k, v in C.ACMG) + " ELSE 'NOT_PROVIDED' END"
OMIM = "CASE WHEN diagnosticComment IS NULL OR diagnosticComment = 'Not reported' THEN NULL ELSE 'OMIM:' || coalesce(" + ", ".join(f"nullif(regexp_extract(diagnosticComment, '{p}', 1), '')" for p in (r"(?i)OMIM:\s*(\d{6})", r"(?i)OMIM\s+(\d{6})", r"#(\d{6})")) + ") END"
_LIST = "list_filter(list_transform(string_split({0}, '{1}'), lambda x: trim(x, ' ' || chr(9) || chr(10))), lambda x: x <> '')"
TERM_LIST = f"CASE WHEN phenotypicFeatureIds IS NULL OR phenotypicFeatureIds IN ('', 'Not reported') THEN [] ELSE list_filter({_LIST.format('phenotypicFeatureIds', ',')}, lambda x: starts_with(x, 'HP:')) END"
VARIANT_LIST = f"CASE WHEN genomicVariants IS NULL OR trim(genomicVariants) IN ('', 'Not reported', 'nan') THEN [] ELSE {_LIST.format('genomicVariants', ';')} END"
GENE = r"coalesce(CASE WHEN NOT starts_with(regexp_extract({0}, '^([A-Z][A-Z0-9]+):', 1), 'CHR') THEN nullif(regexp_extract({0}, '^([A-Z][A-Z0-9]+):', 1), '') END, nullif(regexp_extract({0}, '^([A-Z][A-Z0-9]+)\s*[\(\[]', 1), ''), nullif(regexp_extract({0}, '^([A-Z][A-Z0-9]+)\s+[cpgn]\.', 1), ''))"


# --- cases ----------------------------------------------------------------------

_PCT = ", ".join(f"round(100.0 * with_{k} / cases, 1) AS {k}_pct" for k in ("phenotypes", "variants", "diagnosis", "age", "sex"))


@query(f"""WITH {W}, x AS (SELECT dataSourceType, {TERM_LIST} AS t, {VARIANT_LIST} AS v, {AGE} AS a, {SEX} AS s, diagnosticComment AS d FROM cases),
 g AS (SELECT dataSourceType, count(*) AS cases, count_if(len(t) > 0) AS with_phenotypes, count_if(len(v) > 0) AS with_variants,
 count_if(d IS NOT NULL AND d <> 'Not reported') AS with_diagnosis, count_if(a IS NOT NULL) AS with_age, count_if(s <> 'UNKNOWN_SEX') AS with_sex,
 CAST(sum(len(t)) AS BIGINT) AS total_terms, CAST(sum(len(v)) AS BIGINT) AS total_variants FROM x GROUP BY 1)
 SELECT dataSourceType, cases, CAST(with_phenotypes AS BIGINT) AS with_phenotypes, CAST(with_variants AS BIGINT) AS with_variants, CAST(with_diagnosis AS BIGINT) AS with_diagnosis,
 CAST(with_age AS BIGINT) AS with_age, CAST(with_sex AS BIGINT) AS with_sex, total_terms, total_variants, {_PCT} FROM g""")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.case_coverage(Y.cases(spark, sf_dir))


@query(f"WITH {W} SELECT ID, {AGE} AS age_iso FROM cases")
def age_iso(spark, sf_dir):
    return Y.cases(spark, sf_dir).select("ID", C.age_iso(F.col("age")).alias("age_iso"))


@query(f"WITH {W} SELECT ID, {SEX} AS sex_enum FROM cases")
def sex_enum(spark, sf_dir):
    return Y.cases(spark, sf_dir).select("ID", C.sex_enum(F.col("sex")).alias("sex_enum"))


@query(f"WITH {W} SELECT ID, {ACMG} AS acmg FROM cases")
def acmg_class(spark, sf_dir):
    return Y.cases(spark, sf_dir).select("ID", C.acmg_class(F.col("variantInterpretation")).alias("acmg"))


@query(f"WITH {W} SELECT ID, {OMIM} AS omim FROM cases")
def omim_ids(spark, sf_dir):
    return Y.cases(spark, sf_dir).select("ID", C.omim_id(F.col("diagnosticComment")).alias("omim"))


@query(f"WITH {W} SELECT ID, {GENE.format('trim(genomicVariants)')} AS gene FROM cases")
def gene_symbols(spark, sf_dir):
    return Y.cases(spark, sf_dir).select("ID", C.gene_symbol(F.col("genomicVariants")).alias("gene"))


_TEXTS = "SELECT doc_id, text || ' HP:' || CAST(n_chars AS STRING) || ', HP:' || CAST(doc_id % 7 AS STRING) || ' HP:' || CAST(n_chars AS STRING) AS text FROM {docs}"


@query(rf"WITH x AS ({_TEXTS.format(docs='documents')}), y AS (SELECT doc_id, regexp_extract_all(text, 'HP:\d+') AS l FROM x) SELECT doc_id, array_to_string(list_filter(l, lambda v, i: list_position(l, v) = i), ',') AS term_ids FROM y")
def term_ids_regex(spark, sf_dir):
    return spark.sql(_TEXTS, docs=Y.table(spark, sf_dir, "documents")).select("doc_id", C.term_ids(F.col("text")).alias("term_ids"))


_DICT = Y.plain(Y.DICTIONARY)


@query(f"WITH {W}, d AS ({_DICT}), e AS (SELECT ID, unnest({TERM_LIST}) AS term, generate_subscripts({TERM_LIST}, 1) AS pos FROM cases) SELECT e.ID AS ID, CAST(pos AS BIGINT) AS pos, term, coalesce(label, 'Unknown term: ' || term) AS label FROM e LEFT JOIN d ON d.id = term AND d.ord % 11 <> 0")
def feature_labels(spark, sf_dir):
    terms = Y.dictionary(spark, sf_dir).where("ord % 11 <> 0")
    f = P.labelled_features(Y.cases(spark, sf_dir), terms)
    return f.select("ID", F.posexplode("features").alias("pos", "f")).select("ID", (F.col("pos") + 1).cast("long").alias("pos"), F.col("f.type.id").alias("term"), F.col("f.type.label").alias("label"))


@query(f"WITH {W}, e AS (SELECT ID, {ACMG} AS acmg, unnest({VARIANT_LIST}) AS text, generate_subscripts({VARIANT_LIST}, 1) AS i FROM cases) SELECT ID, ID || '_variant' || CAST(i AS VARCHAR) AS variant_id, text, {GENE.format('text')} AS gene, acmg FROM e")
def variants_flat(spark, sf_dir):
    c = Y.cases(spark, sf_dir)
    i = c.select("ID", F.explode(P.interpretations(F.col("ID"), F.col("genomicVariants"), F.col("variantInterpretation"))).alias("i"))
    g = i.select("ID", F.explode("i.diagnosis.genomicInterpretations").alias("g")).select("ID", "g.variantInterpretation.*")
    d = F.col("variationDescriptor")
    return g.select("ID", d["id"].alias("variant_id"), d["variation"]["text"].alias("text"), d["geneContext"]["symbol"].alias("gene"), F.col("acmgPathogenicityClassification").alias("acmg"))


_REFS = f"CASE WHEN externalReference IS NULL OR externalReference = 'Not reported' THEN [] ELSE {_LIST.format('externalReference', ',')} END"


@query(f"WITH {W} SELECT ID, unnest({_REFS}) AS reference, 'Source: ' || dataSourceType AS description FROM cases")
def references_flat(spark, sf_dir):
    c = Y.cases(spark, sf_dir)
    return c.select("ID", F.explode(C.reference_list(F.col("externalReference"))).alias("reference"), F.concat(F.lit("Source: "), "dataSourceType").alias("description"))


# --- sources --------------------------------------------------------------------

_RAW = {
    "lit": """SELECT CAST(o_orderkey AS STRING) AS id, 'F' AS patient_gender, CAST(o_orderkey % 50 AS STRING) || 'Y' AS patient_age, 'WES' AS test, 'solo' AS test_strategy, CAST(NULL AS STRING) AS consanguinity,
 CAST(o_custkey AS STRING) AS family_id, '1' AS number_of_family_members, '2' AS cohort_size, 'ataxia HP:' || CAST(o_orderkey % 90 AS STRING) || ' HP:7' AS phenotypes, o_orderstatus AS result,
 CAST(NULL AS STRING) AS result_comment, 'A:c.1' AS variants, 'het' AS zygosity, 'VUS' AS pathogenicity,
 CASE o_orderkey % 4 WHEN 0 THEN 'https://pubmed.ncbi.nlm.nih.gov/28600779/' WHEN 1 THEN 'PMID:1' END AS reference, o_orderkey AS ord FROM {orders}""",
    "clin": """SELECT CAST(c_custkey AS STRING) AS ID, 'duo' AS `Testing Strategy`, 'M' AS Gender, '3Y' AS Age, 'WGS' AS Test, 'no' AS Consanguinity, CAST(NULL AS STRING) AS `Family hx`, c_mktsegment AS Result,
 'hom' AS Zyogsity, 'fever HP:' || CAST(c_nationkey AS STRING) AS Phenotype, 'B:c.2' AS `Variant(s)`, 'DM' AS HGMD, c_custkey AS ord FROM {customer}""",
    "hosp": """SELECT 'H' || CAST(s_suppkey AS STRING) AS Case, 'WES' AS Test, 'trio' AS ` Test Type`, 'F' AS Gender, '2010-05-01' AS DOB, 'yes' AS `Consanguinity `, 'pos' AS `Results Internal`, 'het' AS Zygosity,
 'HP:1, HP:' || CAST(s_nationkey AS STRING) AS HPOs, CAST(s_nationkey AS STRING) AS `Family ID`, 'G1' AS Gene, 'c.1A>G' AS `Variant `, CASE WHEN s_suppkey % 2 = 0 THEN 'G2' END AS `Gene 2`, CAST(NULL AS STRING) AS `Variant 2  `,
 CAST(NULL AS STRING) AS `Gene 3`, CAST(NULL AS STRING) AS `Variant 3  `, CAST(NULL AS STRING) AS `Gene 4`, CAST(NULL AS STRING) AS Variant4, 'Pathogenic' AS `pathogenicity `, CAST(NULL AS STRING) AS `pathogenicity 2 `,
 CAST(NULL AS STRING) AS `pathogenicity 3`, CAST(NULL AS STRING) AS `pathogenicity 4`, CASE WHEN s_suppkey % 3 = 0 THEN 'x' END AS Comments, CASE WHEN s_suppkey % 2 = 0 THEN 'AR' END AS Inheritance,
 CASE WHEN s_suppkey % 5 = 0 THEN '123456' END AS Omim, s_suppkey AS ord FROM {supplier}""",
}


def _standard(spark, sf_dir) -> list[DataFrame]:
    raw = {"lit": ("orders", H.literature()), "clin": ("customer", H.clinical_literature()), "hosp": ("supplier", H.hospital())}
    return [H.standardise(Y.run(spark, sf_dir, _RAW[k], t), spec, ["ord"]) for k, (t, spec) in raw.items()]


_HARMONIZED = """WITH l AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS n, * FROM orders WHERE o_orderkey % 4 <> 0),
 c AS (SELECT row_number() OVER (ORDER BY c_custkey) AS n, * FROM customer),
 u AS (SELECT 0 AS s, CAST(n AS BIGINT) AS o, '' AS t, 'F' AS sex, CAST(o_orderkey % 50 AS VARCHAR) || 'Y' AS age, 'Not reported' AS consanguinityStatus, CAST(o_custkey AS VARCHAR) AS familyId, '1' AS totalFamilyMembers,
  CASE WHEN o_orderkey % 90 = 7 THEN 'HP:7' ELSE 'HP:' || CAST(o_orderkey % 90 AS VARCHAR) || ',HP:7' END AS phenotypicFeatureIds, 'A:c.1' AS genomicVariants, 'VUS' AS variantInterpretation,
  'Not reported' AS diagnosticComment, 'literature' AS dataSourceType, CASE WHEN o_orderkey % 4 = 1 THEN 'PMID:1' ELSE 'Not reported' END AS externalReference FROM l
 UNION ALL SELECT 1, n, '', 'M', '3Y', 'no', CAST(n AS VARCHAR), 'Not reported', 'HP:' || CAST(c_nationkey AS VARCHAR), 'B:c.2', 'DM', 'Not reported', 'clinical_literature', 'https://pubmed.ncbi.nlm.nih.gov/28600779/' FROM c
 UNION ALL SELECT 2, NULL, 'H' || CAST(s_suppkey AS VARCHAR), 'F', '2010-05-01', 'yes', CAST(s_nationkey AS VARCHAR), 'trio', CASE WHEN s_nationkey = 1 THEN 'HP:1' ELSE 'HP:1,HP:' || CAST(s_nationkey AS VARCHAR) END,
  'G1;c.1A>G;' || CASE WHEN s_suppkey % 2 = 0 THEN 'G2' ELSE '' END || ';;;;;', 'Pathogenic;;;',
  rtrim(ltrim(CASE WHEN s_suppkey % 3 = 0 THEN 'Comments: x' ELSE '' END || ';' || CASE WHEN s_suppkey % 2 = 0 THEN 'Inheritance: AR' ELSE '' END || ';' || CASE WHEN s_suppkey % 5 = 0 THEN 'OMIM: 123456' ELSE '' END, ';'), ';'),
  'clinical_collaborator', 'hospital_collaborator, https://link.springer.com/article/10.1186/s12920-020-00743-8 , https://onlinelibrary.wiley.com/doi/full/10.1111/cge.13842' FROM supplier)
 SELECT 'CASE' || CAST(row_number() OVER (ORDER BY s, o, t) AS VARCHAR) AS ID, sex, age, consanguinityStatus, familyId, totalFamilyMembers, phenotypicFeatureIds, genomicVariants, variantInterpretation, diagnosticComment, dataSourceType, externalReference FROM u"""


@query(_HARMONIZED)
def harmonized_union(spark, sf_dir):
    names = "ID sex age consanguinityStatus familyId totalFamilyMembers phenotypicFeatureIds genomicVariants variantInterpretation diagnosticComment dataSourceType externalReference".split()
    return H.union_sources(*_standard(spark, sf_dir)).select(*names)


@query("""WITH l AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS n, 'HP:' || CAST(o_orderkey % 90 AS VARCHAR) AS a FROM orders WHERE o_orderkey % 4 <> 0),
 m AS (SELECT CAST(p_partkey AS BIGINT) AS n, list('HP:' || CAST(p_size AS VARCHAR)) AS t FROM part WHERE p_partkey % 3 = 0 GROUP BY 1)
 SELECT CAST(l.n AS VARCHAR) AS ID, array_to_string(list_sort(list_distinct(list_concat([a, 'HP:7'], coalesce(t, [])))), ',') AS HPO_ID FROM l LEFT JOIN m ON m.n = l.n""")
def merge_annotations(spark, sf_dir):
    sql = "SELECT 'LIT_' || CAST(p_partkey AS STRING) AS id, array('HP:' || CAST(p_size AS STRING), 'note') AS terms FROM {part} WHERE p_partkey % 3 = 0 UNION ALL SELECT 'CLIT_' || CAST(p_partkey AS STRING), array('HP:9999') FROM {part}"
    return H.merge_annotations(_standard(spark, sf_dir)[0], Y.run(spark, sf_dir, sql, "part"), "LIT_").select("ID", "HPO_ID")


# --- second pipeline --------------------------------------------------------------

_PHENO = "SELECT k, ID, {0} AS phenotypes FROM cases"


@query(f"""WITH {W}, p AS (SELECT ID, unnest(list_filter(list_transform(string_split(replace(phenotypicFeatures, ',', '|'), '|'), lambda x: trim(x)), lambda x: x <> '')) AS t FROM cases),
 q AS (SELECT ID, t, regexp_extract(t, '[\\p{{L}}\\p{{N}}_\\s;-]+\\s*\\((HP:\\d{{7}})\\)', 1) AS h, regexp_extract_all(t, '\\((HP:\\d{{7}})\\)', 1) AS bh, regexp_extract_all(t, '\\((OMIM:\\d{{6}})\\)', 1) AS bo,
  trim(regexp_replace(t, '\\([^)]*\\)', '', 'g')) AS f FROM p),
 r AS (SELECT ID, CASE WHEN h <> '' THEN [h] ELSE bh END AS hs, CASE WHEN h <> '' THEN [] ELSE bo END AS os, CASE WHEN h = '' AND len(bh) = 0 AND len(bo) = 0 AND f <> '' THEN [f] ELSE [] END AS ts FROM q),
 a AS (SELECT ID, array_to_string(list_sort(list_distinct(flatten(list(hs)))), ';') AS parsed_hpo_ids, array_to_string(list_sort(list_distinct(flatten(list(os)))), ';') AS parsed_omim_ids,
  array_to_string(list_sort(list_distinct(flatten(list(ts)))), ';') AS parsed_pheno_text FROM r GROUP BY ID)
 SELECT cases.ID, coalesce(parsed_hpo_ids, '') AS parsed_hpo_ids, coalesce(parsed_omim_ids, '') AS parsed_omim_ids, coalesce(parsed_pheno_text, '') AS parsed_pheno_text FROM cases LEFT JOIN a ON a.ID = cases.ID""".replace("\\\\", "\\"))
def parsed_phenotypes(spark, sf_dir):
    c = Y.cases(spark, sf_dir).select("ID", F.col("phenotypicFeatures").alias("phenotypes"), F.col("genomicVariants").alias("variants"))
    return pipelines.parse_cases(c).select("ID", "parsed_hpo_ids", "parsed_omim_ids", "parsed_pheno_text")


_BEGINS_WITH = lambda x, words: "(" + " OR ".join(f"starts_with({x}, '{w}')" for w in words) + ")"
_RESIDUES = "CASE c " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in hgvs.AMINO.items()) + " ELSE c END"
_SPELT = f"""CASE WHEN NOT contains(e, ':p.') THEN e WHEN regexp_matches(e, '{hgvs.SHORT}') THEN regexp_extract(e, '^(.*:p\\.)', 1) || array_to_string(list_transform(string_split(replace(regexp_extract(e, ':p\\.(.*)$', 1), 'fsX', 'fs*'), ''), lambda c: {_RESIDUES}), '')
 WHEN regexp_matches(e, '{hgvs.PROTEIN}') THEN replace(replace(e, 'fsX', 'fs*'), '*', 'Ter') ELSE e END""".replace("\\\\", "\\")
_SCAN = "{{'g': {0}, 't': {1}, 'e': {2}, 'p': '', 'i': 0}}".format
#: The expressions of each variant: parts between colons go through a state of gene, transcript and expressions.
_EXPRESSIONS = f"""each_ AS (SELECT ID, v, n FROM (SELECT ID, unnest({_LIST.format("replace(genomicVariants, '|', ';')", ";")}) AS v, generate_subscripts({_LIST.format("replace(genomicVariants, '|', ';')", ";")}, 1) AS n FROM cases)),
 scanned AS (SELECT *, list_reduce(list_transform(string_split(v, ':'), lambda p, i: {{'g': CAST(NULL AS VARCHAR), 't': CAST(NULL AS VARCHAR), 'e': CAST([] AS VARCHAR[]), 'p': {_S.format('p')}, 'i': i}}), lambda s, x:
   CASE WHEN x.i = 1 AND NOT {_BEGINS_WITH('x.p', C.NOT_GENE)} THEN {_SCAN('x.p', 's.t', 's.e')} WHEN {_BEGINS_WITH('x.p', C.TRANSCRIPTS)} THEN {_SCAN('s.g', 'x.p', 's.e')}
   WHEN {_BEGINS_WITH('x.p', C.EXPRESSIONS)} THEN {_SCAN('s.g', 's.t', "list_append(s.e, CASE WHEN s.t <> '' AND " + _BEGINS_WITH('x.p', ('c.', 'n.', 'r.')) + " THEN s.t || ':' || x.p WHEN s.g <> '' AND starts_with(x.p, 'p.') THEN s.g || ':' || x.p ELSE x.p END)")} ELSE s END,
   {{'g': CAST(NULL AS VARCHAR), 't': CAST(NULL AS VARCHAR), 'e': CAST([] AS VARCHAR[]), 'p': '', 'i': 0}}).e AS e,
   list_filter(list_transform(string_split_regex(v, '[,;]\\s*'), lambda x: {_S.format('x')}), lambda x: x <> '') AS cut FROM each_),
 expressions AS (SELECT ID, n, array_to_string(list_transform(CASE WHEN contains(v, ':') AND len(e) > 0 THEN e WHEN len(cut) > 0 THEN cut ELSE [v] END, lambda e: {_SPELT}), ',') AS v FROM scanned)""".replace("\\\\", "\\")


@query(f"WITH {W}, {_EXPRESSIONS}, a AS (SELECT ID, string_agg(v, ';' ORDER BY n) AS t FROM expressions GROUP BY ID) SELECT cases.ID AS ID, coalesce(t, '') AS parsed_variants FROM cases LEFT JOIN a ON a.ID = cases.ID")
def parsed_variants(spark, sf_dir):
    c = Y.cases(spark, sf_dir)
    return c.select("ID", F.array_join(C.parsed_variants(F.col("genomicVariants")), ";").alias("parsed_variants"))


_FIELDS = ("symbol", "transcript", "genomic", "protein", "cdna")
_TOKEN_PARTS = f"list_transform([x[1], x[2], array_to_string(x[3:], ':')][1 : least(len(x), 3)], lambda p, i: {{'p': {_S.format('p')}, 'i': i}})"
_FIELD_STEP = {
    "symbol": f"x.i = 1 AND NOT {_BEGINS_WITH('x.p', (*C.NOT_GENE, 'NC_'))}", "transcript": f"x.i <> 3 AND {_BEGINS_WITH('x.p', C.TRANSCRIPTS)}",
    **{k: f"x.i <> 1 AND starts_with(x.p, '{p}')" for k, p in (("genomic", "g."), ("protein", "p."), ("cdna", "c."))},
}
_EMPTY_FIELDS = ", ".join(f"'{k}': CAST(NULL AS VARCHAR)" for k in _FIELDS)


@query(f"""WITH {W}, {_EXPRESSIONS}, tokens AS (SELECT ID, n, v, flatten(list_transform(list_transform(string_split(v, ','), lambda x: {_S.format('x')}), lambda e: CASE WHEN contains(e, ':') THEN
   list_transform([string_split(e, ':')], lambda x: {_TOKEN_PARTS})[1] ELSE [{{'p': e, 'i': CAST(0 AS BIGINT)}}] END)) AS l FROM expressions),
 folded AS (SELECT ID, n, v, list_reduce(list_transform(l, lambda y: {{{_EMPTY_FIELDS}, 'other': CAST([] AS VARCHAR[]), 'p': y.p, 'i': y.i}}), lambda s, x: {{{", ".join(f"'{k}': CASE WHEN {w} THEN x.p ELSE s.{k} END" for k, w in _FIELD_STEP.items())},
   'other': CASE WHEN x.i = 0 AND NOT {_BEGINS_WITH('x.p', ('p.', 'g.', 'c.', *C.TRANSCRIPTS))} THEN list_append(s.other, x.p) ELSE s.other END, 'p': '', 'i': 0}}, {{{_EMPTY_FIELDS}, 'other': CAST([] AS VARCHAR[]), 'p': '', 'i': 0}}) AS p FROM tokens)
 SELECT ID, CAST(n - 1 AS INTEGER) AS pos, v, {", ".join(f"p.{k} AS {k}" for k in _FIELDS)}, array_to_string(p.other, '|') AS other,
 coalesce(CASE WHEN p.transcript <> '' AND p.cdna <> '' THEN p.transcript || ':' || p.cdna END, nullif(p.genomic, ''), nullif(p.cdna, ''), nullif(p.protein, ''), v) AS expression FROM folded""")
def variant_components(spark, sf_dir):
    v = Y.cases(spark, sf_dir).select("ID", F.posexplode(C.parsed_variants(F.col("genomicVariants"))).alias("pos", "v"))
    p = v.withColumn("p", C.variant_components(F.col("v")))
    return p.select("ID", "pos", "v", "p.symbol", "p.transcript", "p.genomic", "p.protein", "p.cdna", F.array_join("p.other", "|").alias("other"), C.chosen_expression(F.col("v"), F.col("p")).alias("expression"))


@query(rf"WITH {W} SELECT ID, CASE WHEN starts_with(externalReference, 'http') AND regexp_extract(rtrim(externalReference, '/'), '(\d+)$', 1) <> '' THEN 'PMID:' || regexp_extract(rtrim(externalReference, '/'), '(\d+)$', 1) END AS pmid FROM cases")
def pmid(spark, sf_dir):
    return Y.cases(spark, sf_dir).select("ID", C.pmid(F.col("externalReference")).alias("pmid"))


@query("SELECT 'HP:' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS term, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, min(l_orderkey * 100000 + l_partkey % 100000) LIMIT 10")
def top_terms(spark, sf_dir):
    rows = Y.run(spark, sf_dir, f"SELECT {Y.TERM('l_partkey')} AS term, l_orderkey * 100000 + l_partkey % 100000 AS place FROM {{lineitem}}", "lineitem")
    return stats.top_terms(rows, "term", "place")


@query(f"WITH {W}, x AS (SELECT len({TERM_LIST}) AS n FROM cases) SELECT round(sum(n) / nullif(count_if(n > 0), 0), 6) AS mean_terms, CAST(count_if(n > 0) AS BIGINT) AS with_terms FROM x")
def mean_terms(spark, sf_dir):
    n = F.size(C.listed_terms(F.col("phenotypicFeatureIds")))
    return Y.cases(spark, sf_dir).agg(F.round(stats.mean_per_group(n), 6).alias("mean_terms"), F.count_if(n > 0).alias("with_terms"))


# --- documents ----------------------------------------------------------------------


def _packets(spark, sf_dir) -> DataFrame:
    return P.build(Y.cases(spark, sf_dir), Y.dictionary(spark, sf_dir), CREATED)


_J = lambda name, value: f"'\"{name}\":' || {value}"
_JS = lambda name, value: _J(name, f"CAST(to_json({value}) AS VARCHAR)")
_JOBJ = lambda *members: "'{' || concat_ws(',', " + ", ".join(members) + ") || '}'"
_JLIST = lambda xs: f"'[' || array_to_string({xs}, ',') || ']'"
_JCONST = lambda value: "'" + json.dumps(value, separators=(",", ":"), ensure_ascii=False).replace("'", "''") + "'"
_WHEN = lambda condition, value: f"CASE WHEN {condition} THEN {value} END"
_TOLD = lambda c: f"({c} IS NOT NULL AND {c} <> 'Not reported')"
_RESOURCE = [dict(zip(("id", "name", "url", "version", "namespacePrefix", "iriPrefix"), r)) for r in P.RESOURCES]
_QUOTED_NAMES = {"procedure": '"procedure"'}
_EXTRA_JSON = _JOBJ(*[_WHEN(_TOLD(_QUOTED_NAMES.get(k, k)), _JS(v, _QUOTED_NAMES.get(k, k))) for k, v in P.EXTRA.items()])
_ANY_EXTRA = " OR ".join(_TOLD(_QUOTED_NAMES.get(k, k)) for k in P.EXTRA)
_VARIANT_JSON = _JOBJ(_JS("subjectOrBiosampleId", "ID"), _J("interpretationStatus", "'\"UNKNOWN_STATUS\"'"), _J("variantInterpretation", _JOBJ(
    _J("variationDescriptor", _JOBJ(_JS("id", "ID || '_variant' || CAST(i AS VARCHAR)"), _J("variation", _JOBJ(_JS("text", "v"))), _WHEN(f"{GENE.format('v')} IS NOT NULL", _J("geneContext", _JOBJ(_JS("valueId", f"'HGNC:' || {GENE.format('v')}"), _JS("symbol", GENE.format("v"))))))),
    _JS("acmgPathogenicityClassification", ACMG))))
_PACKET = f"""WITH {W}, d AS ({_DICT}), t AS (SELECT ID, unnest({TERM_LIST}) AS term, generate_subscripts({TERM_LIST}, 1) AS i FROM cases),
 f AS (SELECT t.ID AS ID, string_agg({_J("type", _JOBJ(_JS("id", "term"), _JS("label", "coalesce(label, 'Unknown term: ' || term)")))}, '}},{{' ORDER BY i) AS features FROM t LEFT JOIN d ON d.id = term GROUP BY t.ID),
 r AS (SELECT ID, dataSourceType, unnest({_REFS}) AS x, generate_subscripts({_REFS}, 1) AS i FROM cases),
 g AS (SELECT ID, string_agg({_JOBJ(_JS("id", "x"), _JS("reference", "x"), _JS("description", "'Source: ' || coalesce(dataSourceType, 'Not reported')"))}, ',' ORDER BY i) AS refs FROM r GROUP BY ID),
 v AS (SELECT ID, variantInterpretation, unnest({VARIANT_LIST}) AS v, generate_subscripts({VARIANT_LIST}, 1) AS i FROM cases),
 h AS (SELECT ID, string_agg({_VARIANT_JSON}, ',' ORDER BY i) AS variants FROM v GROUP BY ID)
 SELECT c.ID AS id, {_JOBJ(
    _JS("id", "c.ID"),
    _J("subject", _JOBJ(_JS("id", "c.ID"), _WHEN(f"{SEX} <> 'UNKNOWN_SEX'", _JS("sex", SEX)), _WHEN(f"{AGE} IS NOT NULL", _J("timeAtLastEncounter", _JOBJ(_J("age", _JOBJ(_JS("iso8601duration", AGE)))))))),
    _J("phenotypicFeatures", "'[' || coalesce('{' || features || '}', '') || ']'"),
    _J("metaData", _JOBJ(_J("created", _JCONST(CREATED)), _J("createdBy", _JCONST("Case Data Pipeline")), _J("resources", _JCONST(_RESOURCE)), _J("phenopacketSchemaVersion", _JCONST("2.0")), _J("externalReferences", "'[' || coalesce(refs, '') || ']'"), _WHEN(_ANY_EXTRA, _J("sourceData", _EXTRA_JSON)))),
    _WHEN("variants IS NOT NULL", _J("interpretations", "'[' || " + _JOBJ(_JS("id", "c.ID || '_interpretation'"), _J("progressStatus", _JCONST("COMPLETED")), _J("diagnosis", _JOBJ(_J("genomicInterpretations", "'[' || variants || ']'")))) + " || ']'")),
    _WHEN(_TOLD("diagnosticComment"), _J("diseases", "'[' || " + _JOBJ(_J("term", _JOBJ(_JS("id", f"coalesce({OMIM}, '')"), _JS("label", "diagnosticComment")))) + " || ']'")),
 )} AS doc FROM cases c LEFT JOIN f ON f.ID = c.ID LEFT JOIN g ON g.ID = c.ID LEFT JOIN h ON h.ID = c.ID"""  # fmt: skip


@query(_PACKET)
def packet_json(spark, sf_dir):
    return P.as_json(_packets(spark, sf_dir))


_PARSED_VARIANT_JSON = _JOBJ(_JS("subjectOrBiosampleId", "ID"), _J("interpretationStatus", _JCONST("CAUSATIVE")), _J("variantInterpretation", _JOBJ(_J("variationDescriptor", _JOBJ(
    _WHEN("symbol IS NOT NULL", _J("geneContext", _JOBJ(_JS("valueId", "symbol"), _JS("symbol", "symbol")))), _J("expressions", "'[' || " + _JOBJ(_J("syntax", _JCONST("hgvs")), _JS("value", "expression")) + " || ']'"),
    _J("vcfRecord", _JCONST({"genomeAssembly": "hg38", "chrom": "N/A", "pos": 0, "ref": "N/A", "alt": "N/A"})))))))
_NON_EMPTY = "list_filter(string_split({0}, ';'), lambda x: x <> '')".format
_PARSED_PACKET = f"""WITH {W}, ph AS ({ORACLES["parsed_phenotypes"]}), vc AS ({ORACLES["variant_components"]}), vs AS (SELECT ID, string_agg({_PARSED_VARIANT_JSON}, ',' ORDER BY pos) AS variants FROM vc GROUP BY ID),
 l AS (SELECT ID, {_NON_EMPTY("parsed_hpo_ids")} AS h, {_NON_EMPTY("parsed_pheno_text")} AS t, {_NON_EMPTY("parsed_omim_ids")} AS o FROM ph), c AS (SELECT cases.ID AS ID, externalReference AS reference, ({ORACLES["pmid"].split("SELECT ID, ", 1)[1].rsplit(" AS pmid FROM", 1)[0]}) AS cite FROM cases)
 SELECT 'CASE_' || c.ID AS id, {_JOBJ(
    _JS("id", "'CASE_' || c.ID"), _J("subject", _JOBJ(_JS("id", "c.ID"))),
    _J("phenotypicFeatures", _JLIST("list_transform(h, lambda x, i: " + _JOBJ(_J("type", _JOBJ(_JS("id", "x"), _JS("label", "CASE WHEN len(h) = len(t) THEN t[i] ELSE x END")))) + ")")),
    _WHEN("variants IS NOT NULL", _J("interpretations", "'[' || " + _JOBJ(_JS("id", "c.ID"), _J("progressStatus", _JCONST("SOLVED")), _J("diagnosis", _JOBJ(_J("genomicInterpretations", "'[' || variants || ']'")))) + " || ']'")),
    _WHEN("len(o) > 0", _J("diseases", "'[' || " + _JOBJ(_J("term", _JOBJ(_JS("id", "o[1]"), _JS("label", "o[1]")))) + " || ']'")),
    _J("metaData", _JOBJ(_J("created", _JCONST(CREATED)), _J("phenopacketSchemaVersion", _JCONST("2.0")), _WHEN("cite IS NOT NULL", _J("externalReferences", "'[' || " + _JOBJ(_JS("id", "cite"), _JS("description", "reference")) + " || ']'")))),
 )} AS doc FROM c JOIN l ON l.ID = c.ID LEFT JOIN vs ON vs.ID = c.ID"""  # fmt: skip


@query(_PARSED_PACKET)
def parsed_packet_json(spark, sf_dir):
    c = Y.cases(spark, sf_dir).select("ID", F.col("phenotypicFeatures").alias("phenotypes"), F.col("genomicVariants").alias("variants"), F.col("externalReference").alias("reference"))
    return P.as_json(P.parsed_packets(pipelines.parse_cases(c), CREATED))


@query(f"""WITH {W}, d AS ({_DICT}), x AS (SELECT {TERM_LIST} AS t, {VARIANT_LIST} AS v, {AGE} AS a, {SEX} AS s, {OMIM} AS o, diagnosticComment AS d FROM cases)
 SELECT count(*) AS packets, CAST(count_if(len(t) > 0) AS BIGINT) AS with_features, CAST(count_if(len(v) > 0) AS BIGINT) AS with_variants, CAST(count_if(d IS NOT NULL AND d <> 'Not reported') AS BIGINT) AS with_diseases,
 CAST(count_if(a IS NOT NULL) AS BIGINT) AS with_age, CAST(count_if(s <> 'UNKNOWN_SEX') AS BIGINT) AS with_sex, CAST(sum(len(t)) AS BIGINT) AS features, CAST(sum(len(t)) AS BIGINT) AS labelled_features,
 CAST(sum(len(v)) AS BIGINT) AS variants, CAST(sum(len(list_filter(v, lambda y: {GENE.format('y')} IS NOT NULL))) AS BIGINT) AS variants_with_gene, CAST(count_if(o IS NOT NULL) AS BIGINT) AS omim_diseases FROM x""")
def packet_summary(spark, sf_dir):
    return stats.packet_summary(_packets(spark, sf_dir))


_FAULTS = """SELECT o_orderkey AS k, CASE o_orderkey % 10
 WHEN 0 THEN '{}' WHEN 1 THEN '{"id":"a","subject":{"id":"a","sex":"M"},"metaData":{"created":"t","phenopacketSchemaVersion":"2.0","resources":[]}}'
 WHEN 2 THEN '{"id":"a","subject":{"id":"a"},"metaData":{}}' WHEN 3 THEN '{"id":' WHEN 4 THEN '{"id":"a","subject":{},"phenotypicFeatures":[{},{"type":{}},{"type":{"id":"X:1"}}],"metaData":{"created":"t","phenopacketSchemaVersion":"2","resources":[1]}}'
 WHEN 5 THEN '{"id":"a","subject":{"id":"a","sex":"MALE"},"interpretations":[{"progressStatus":"DONE","diagnosis":{"genomicInterpretations":[{},{"subjectOrBiosampleId":"a","interpretationStatus":"U"}]}}],"diseases":[{},{"term":{}}],"metaData":{"created":"t","phenopacketSchemaVersion":"2","resources":[1]}}'
 ELSE '{"id":"a","subject":{"id":"a"},"metaData":{"created":"t","phenopacketSchemaVersion":"2","resources":[1]}}' END AS doc FROM ORDERS"""
#: Errors and warnings of each fault, counted by hand from the rules.
_COUNTS = {0: (2, 1), 1: (1, 1), 2: (3, 1), 3: (1, 0), 4: (3, 1), 5: (5, 0)}
_CASE = lambda i: "CASE k % 10 " + " ".join(f"WHEN {k} THEN {v[i]}" for k, v in _COUNTS.items()) + " ELSE 0 END"


def _faults(spark, sf_dir) -> DataFrame:
    return V.validate(Y.table(spark, sf_dir, "orders").select(F.expr(_FAULTS.split("SELECT o_orderkey AS k, ")[1].split(" AS doc")[0]).alias("doc"), F.col("o_orderkey").alias("k")), number="k")


@query(f"WITH f AS (SELECT o_orderkey AS k FROM orders) SELECT k, CAST({_CASE(0)} AS BIGINT) AS n_errors, CAST({_CASE(1)} AS BIGINT) AS n_warnings, {_CASE(0)} = 0 AS valid FROM f")
def validation_findings(spark, sf_dir):
    return _faults(spark, sf_dir).select("k", F.size("errors").cast("long").alias("n_errors"), F.size("warnings").cast("long").alias("n_warnings"), "valid")


@query(f"""WITH f AS (SELECT o_orderkey AS k FROM orders), x AS (SELECT {_CASE(0)} AS e, {_CASE(1)} AS w FROM f)
 SELECT count(*) AS total, CAST(count_if(e = 0) AS BIGINT) AS valid, CAST(count_if(e > 0) AS BIGINT) AS with_errors, CAST(sum(e) AS BIGINT) AS errors, CAST(sum(w) AS BIGINT) AS warnings,
 round(100.0 * count_if(e = 0) / count(*), 1) AS valid_pct, bool_and(e = 0) AS file_valid FROM x""")
def validation_totals(spark, sf_dir):
    return V.totals(_faults(spark, sf_dir))


#: Values of each type, empty and not: JSON text (none: the member is absent), whether it counts as empty, and how messages name it.
_VALUES = (
    ('"x"', False, "x"), ('""', True, ""), ("0", True, "0"), ('"0"', False, "0"), ("0.0", True, "0"), ("false", True, "False"), ('"false"', False, "false"), ("null", True, None),
    ("[]", True, "[]"), ('"[]"', False, "[]"), ("{}", True, "{}"), ('"null"', False, "null"), ("1", False, "1"), ("true", False, "True"), (None, True, None),
)
_PLACE = lambda d, n: f"CAST(floor(o_orderkey / {d}) AS BIGINT) % {n}"
_PICK = lambda d, xs: f"CASE {_PLACE(d, len(xs))} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(xs) if x is not None) + " END"
_MEMBER = lambda name, d: _PICK(d, [None if v is None else f'"{name}":{v}' for v, _, _ in _VALUES])
_OBJECT = lambda *members: "'{' || concat_ws(',', " + ", ".join(members) + ") || '}'"
_SEX = ('"sex":"MALE"', '"sex":"M"', '"sex":0', '"sex":null', None)
_FEATURES = (None, '"phenotypicFeatures":[]', '"phenotypicFeatures":[{}]', '"phenotypicFeatures":[{"type":{}},{"type":{"id":"HP:1"}},{"type":{"id":"X:1"}}]', '"phenotypicFeatures":[{"type":{"id":5}},{"type":null},3]', '"phenotypicFeatures":"none"')
_STATUS = ('"progressStatus":"SOLVED"', '"progressStatus":"DONE"', '"progressStatus":null', '"progressStatus":true', None)
_DISEASES = (None, '"diseases":[{}]', '"diseases":[{"term":null},{}]')
_QUOTE = lambda x: "'" + x + "'"
_DIAGNOSIS = f"""{_QUOTE('"diagnosis":{"genomicInterpretations":[')} || {_OBJECT(_MEMBER("subjectOrBiosampleId", 11), _MEMBER("interpretationStatus", 4))} || {_QUOTE("]}")}"""
_INSIDE = ", ".join([
    _MEMBER("id", 1), f"CASE WHEN o_orderkey % 4 <> 0 THEN {_QUOTE('\"subject\":')} || {_OBJECT(_MEMBER('id', 5), _PICK(3, _SEX))} END", _PICK(1, _FEATURES),
    f"CASE WHEN o_orderkey % 7 < 4 THEN {_QUOTE('\"interpretations\":[')} || {_OBJECT(_MEMBER('id', 2), _PICK(7, _STATUS), _DIAGNOSIS)} || ']' END", _PICK(1, _DISEASES),
    f"CASE WHEN o_orderkey % 9 <> 0 THEN {_QUOTE('\"metaData\":')} || {_OBJECT(_MEMBER('created', 2), _MEMBER('phenopacketSchemaVersion', 3), _MEMBER('resources', 13))} END",
])
_VALUED = f"""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 101 = 100 THEN {_QUOTE('{"id":')} ELSE {_OBJECT(_INSIDE)} END AS doc FROM ORDERS"""
_GONE = lambda d: f"{_PLACE(d, len(_VALUES))} IN (" + ", ".join(str(i) for i, v in enumerate(_VALUES) if v[1]) + ")"
_SAYS = lambda when, field, message, severity="ERROR": f"CASE WHEN {when} THEN {{'field': {field}, 'message': {message}, 'severity': '{severity}'}} END"
_NEEDS = lambda when, name, d, context: _SAYS(f"{when} AND {_GONE(d)}", f"'{name}'", f"'[' || name || '{context}] Required field ''{name}'' is missing or empty'")
_IS = lambda d, n, i: f"{_PLACE(d, n)} = {i}"
_AT = lambda x: f"'[' || name || '] {x}'"
_FOUND = ", ".join([
    _NEEDS("true", "id", 1, ""), _SAYS("o_orderkey % 9 = 0", "'metaData'", "'[' || name || '] Required field ''metaData'' is missing or empty'"),
    _SAYS(f"o_orderkey % 9 <> 0 AND {_PLACE(2, 15)} = 14 AND {_PLACE(3, 15)} = 14 AND {_PLACE(13, 15)} = 14", "'metaData'", "'[' || name || '] Required field ''metaData'' is missing or empty'"),
    _NEEDS("o_orderkey % 4 <> 0", "id", 5, ".subject"),
    *[_SAYS(f"o_orderkey % 4 <> 0 AND {_IS(3, 5, i)}", "'subject.sex'", _AT(f"Invalid sex value: {x}. Must be one of [''UNKNOWN_SEX'', ''FEMALE'', ''MALE'', ''OTHER_SEX'']")) for i, x in ((1, "M"), (2, "0"), (3, "None"))],
    _SAYS("o_orderkey % 4 = 0", "'subject'", _AT("Subject is recommended but missing"), "WARNING"),
    _SAYS(_IS(1, 6, 2), "'phenotypicFeatures[0]'", _AT("Feature missing required ''type'' field")), _SAYS(_IS(1, 6, 3), "'phenotypicFeatures[0].type'", _AT("Feature type missing required ''id'' field")),
    _SAYS(_IS(1, 6, 3), "'phenotypicFeatures[2].type.id'", _AT("ID X:1 doesn''t appear to be an HPO term"), "WARNING"), _SAYS(_IS(1, 6, 4), "'phenotypicFeatures[0].type.id'", _AT("ID 5 is not a text")),
    _SAYS(_IS(1, 6, 4), "'phenotypicFeatures[1].type'", _AT("Feature type missing required ''id'' field")), _SAYS(_IS(1, 6, 4), "'phenotypicFeatures[2]'", _AT("Feature missing required ''type'' field")),
    _NEEDS("o_orderkey % 7 < 4", "id", 2, ".interpretations[0]"),
    *[_SAYS(f"o_orderkey % 7 < 4 AND {_IS(7, 5, i)}", "'interpretations[0].progressStatus'", _AT(f"Invalid progressStatus: {x}")) for i, x in ((1, "DONE"), (2, "None"), (3, "True"))],
    *[_NEEDS("o_orderkey % 7 < 4", n, d, ".interpretations[0].diagnosis.genomicInterpretations[0]") for n, d in (("subjectOrBiosampleId", 11), ("interpretationStatus", 4))],
    *[_SAYS(w, f"'diseases[{i}]'", _AT("Disease missing required ''term'' field")) for w, i in ((_IS(1, 3, 1), 0), (_IS(1, 3, 2), 1))],
    _NEEDS("o_orderkey % 9 <> 0", "created", 2, ".metaData"), _NEEDS("o_orderkey % 9 <> 0", "phenopacketSchemaVersion", 3, ".metaData"),
    _SAYS(f"o_orderkey % 9 <> 0 AND {_GONE(13)}", "'metaData.resources'", _AT("Resources field is recommended"), "WARNING"),
])
_NAME = f"coalesce({_PICK(1, [v[2] for v in _VALUES])}, 'phenopacket_' || CAST(o_orderkey + 1 AS VARCHAR))"


@query(f"""WITH n AS (SELECT o_orderkey, {_NAME} AS name FROM orders), f AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 101 = 100 THEN [{{'field': '', 'message': 'Invalid JSON', 'severity': 'ERROR'}}] ELSE
 list_filter([{_FOUND}], lambda x: x IS NOT NULL) END AS l FROM n), e AS (SELECT k, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM f)
 SELECT k, CAST(i AS BIGINT) AS i, x.field AS field, x.message AS message, x.severity AS severity FROM e""")
def finding_texts(spark, sf_dir):
    """Every finding of documents made of values of each type, in order: field, message and severity."""
    sql = _VALUED.replace("{", "{{").replace("}", "}}").replace("FROM ORDERS", "FROM {orders}")
    found = V.validate(written(Y.run(spark, sf_dir, sql, "orders"), "valued"), number="k")  # documents come from a table, as they would
    each = found.select("k", F.posexplode_outer("findings").alias("i", "x")).where("i IS NOT NULL")  # else a filter on their number would find them twice
    return each.select("k", (F.col("i") + 1).cast("long").alias("i"), "x.field", "x.message", "x.severity")


@query(f"WITH {W} SELECT count(*) AS total, count(*) AS valid, CAST(0 AS BIGINT) AS errors FROM cases")
def packets_are_valid(spark, sf_dir):
    return V.totals(V.validate(P.as_json(_packets(spark, sf_dir)))).select("total", "valid", "errors")


# --- ontology and ranks ---------------------------------------------------------------

_EDGES, _PROFILES, _PATIENTS, _TRUTH = (Y.plain(x) for x in (Y.EDGES, Y.PROFILES, Y.PATIENTS, Y.TRUTH))
_CLOSED = f"edges AS ({_EDGES}), up(term, ancestor) AS (SELECT child, child FROM edges UNION SELECT parent, parent FROM edges UNION SELECT u.term, e.parent FROM up u JOIN edges e ON e.child = u.ancestor)"
_IC = f"prof AS ({_PROFILES}), ic AS (SELECT ancestor AS term, -ln(count(DISTINCT entity_id) / (SELECT count(DISTINCT entity_id) FROM prof)) AS ic FROM prof JOIN up ON up.term = prof.term GROUP BY ancestor)"
_SIM = {"resnik": "m", "lin": "coalesce(2 * m / nullif(ia + ib, 0), 0)", "jc": "1 / (1 + ia + ib - 2 * m)", "rel": "coalesce(2 * m / nullif(ia + ib, 0), 0) * (1 - exp(-m))"}


def _scores_sql(method: str) -> str:
    return f"""WITH RECURSIVE {_CLOSED}, {_IC}, pt AS ({_PATIENTS}), truth AS ({_TRUTH}),
 b AS (SELECT x.term AS a, y.term AS b, max(ic.ic) AS m FROM (SELECT DISTINCT u.* FROM up u JOIN pt ON pt.term = u.term) x JOIN (SELECT DISTINCT u.* FROM up u JOIN prof ON prof.term = u.term) y ON x.ancestor = y.ancestor JOIN ic ON ic.term = x.ancestor WHERE ic.ic > 0 GROUP BY ALL),
 ps AS (SELECT b.a, b.b, m, i.ic AS ia, j.ic AS ib FROM b JOIN ic i ON i.term = b.a JOIN ic j ON j.term = b.b),
 s AS (SELECT a, b, {_SIM[method]} AS sim FROM {"b" if method == "resnik" else "ps"}),
 ea AS (SELECT s.a, prof.entity_id, max(s.sim) AS x FROM s JOIN prof ON prof.term = s.b GROUP BY ALL),
 r AS (SELECT pt.id, entity_id, sum(x) AS rs FROM pt JOIN ea ON ea.a = pt.term GROUP BY ALL),
 pb AS (SELECT pt.id, s.b, max(s.sim) AS x FROM pt JOIN s ON s.a = pt.term GROUP BY ALL),
 c AS (SELECT pb.id, prof.entity_id, sum(x) AS cs FROM pb JOIN prof ON prof.term = pb.b GROUP BY ALL),
 np AS (SELECT id, count(*) AS n FROM pt GROUP BY 1), ne AS (SELECT entity_id, count(*) AS n FROM prof GROUP BY 1),
 sc AS (SELECT np.id, ne.entity_id, round((coalesce(rs, 0) / np.n + coalesce(cs, 0) / ne.n) / 2, 9) AS score FROM np CROSS JOIN ne LEFT JOIN r ON r.id = np.id AND r.entity_id = ne.entity_id LEFT JOIN c ON c.id = np.id AND c.entity_id = ne.entity_id)"""


def _closed(spark, sf_dir) -> DataFrame:
    return S.closure(Y.run(spark, sf_dir, Y.braces(Y.EDGES), "part"))


def _profiles(spark, sf_dir) -> DataFrame:
    return Y.run(spark, sf_dir, Y.braces(Y.PROFILES), "lineitem")


def _patients(spark, sf_dir) -> DataFrame:
    return Y.run(spark, sf_dir, Y.braces(Y.PATIENTS), "lineitem")


@query(f"WITH RECURSIVE {_CLOSED} SELECT term, count(*) AS ancestors FROM up GROUP BY term")
def closure(spark, sf_dir):
    return _closed(spark, sf_dir).groupBy("term").agg(F.count("*").alias("ancestors"))


@query(f"WITH RECURSIVE {_CLOSED}, {_IC} SELECT term, round(ic, 6) + 0.0 AS ic FROM ic")
def information_content(spark, sf_dir):
    profiles = _profiles(spark, sf_dir)
    return S.information_content(_closed(spark, sf_dir), profiles.withColumnRenamed("entity_id", "item")).select("term", (F.round("ic", 6) + 0.0).alias("ic"))


def _similarity(method: str):
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = S.entity_totals(_patients(spark, sf_dir), _profiles(spark, sf_dir), _closed(spark, sf_dir), method)
        return found.select("entity_id", F.round("total", 4).alias("total"), F.round("best", 6).alias("best"))

    f.__name__ = f"similarity_{method}"
    return query(_scores_sql(method) + " SELECT entity_id, round(sum(score), 4) AS total, round(max(score), 6) AS best FROM sc GROUP BY 1")(f)


for _m in S.METHODS:
    _similarity(_m)

_RANKED = _scores_sql("resnik") + """, t AS (SELECT sc.id, sc.entity_id AS g, sc.score AS s FROM sc JOIN truth ON truth.id = sc.id AND truth.entity_id = sc.entity_id),
 e AS (SELECT t.id, g, 1 + count_if(sc.entity_id <> g AND (score > s OR (score = s AND sc.entity_id < g))) AS rank, max(s) AS score,
  (count_if(sc.entity_id <> g AND score < s) + 0.5 * count_if(sc.entity_id <> g AND score = s)) / nullif(count_if(sc.entity_id <> g), 0) AS roc_auc FROM t JOIN sc ON sc.id = t.id GROUP BY ALL)"""


def _results(spark, sf_dir) -> DataFrame:
    truth = Y.run(spark, sf_dir, Y.braces(Y.TRUTH), "lineitem")
    return S.evaluated(_patients(spark, sf_dir), truth, _profiles(spark, sf_dir), _closed(spark, sf_dir))


@query(_RANKED + " SELECT id, g AS ground_truth_gene, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score, round(roc_auc, 6) AS roc_auc FROM e")
def gene_rank(spark, sf_dir):
    return _results(spark, sf_dir).select("id", "ground_truth_gene", "rank", F.round("score", 6).alias("score"), F.round("roc_auc", 6).alias("roc_auc"))


@query(_RANKED + """ SELECT count(*) AS total_cases_evaluated, round(avg(CAST(rank <= 1 AS DOUBLE)), 4) AS hits_at_1, round(avg(CAST(rank <= 10 AS DOUBLE)), 4) AS hits_at_10,
 round(avg(CAST(rank <= 100 AS DOUBLE)), 4) AS hits_at_100, round(avg(roc_auc), 4) AS mean_roc_auc, CAST(median(rank) AS DOUBLE) AS median_rank FROM e""")
def rank_metrics(spark, sf_dir):
    return S.metrics(_results(spark, sf_dir))


@query(f"""WITH prof AS ({_PROFILES}), x AS (SELECT o_orderkey AS id, o_orderkey % 3 AS n, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'GENE' || CAST(o_custkey % 90 AS VARCHAR) ELSE 'NONE' END AS g FROM orders)
 SELECT id, CASE WHEN n <= 0 THEN 'no features' WHEN g IS NULL THEN 'no gene' WHEN g = '' THEN 'empty gene' WHEN g NOT IN (SELECT entity_id FROM prof) THEN 'gene not in profiles' END AS skip_reason FROM x""")
def skip_reasons(spark, sf_dir):
    sql = "SELECT o_orderkey AS id, o_orderkey % 3 AS n_terms, CASE o_orderkey % 5 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN 'GENE' || CAST(o_custkey % 90 AS STRING) ELSE 'NONE' END AS entity_id FROM {orders}"
    return S.skip_reason(Y.run(spark, sf_dir, sql, "orders"), _profiles(spark, sf_dir)).select("id", "skip_reason")


# --- phrases ----------------------------------------------------------------------------

_PHRASES = "SELECT doc_id, unnest(list_distinct(list_transform(string_split_regex(lower(text), '[.,;:!?\\n]+'), lambda x: trim(x)))) AS phrase FROM documents"
_OK = "length(phrase) > 3 AND phrase NOT IN (" + ", ".join(map(repr, C.NO_FINDING)) + ")"
_NAMES = f"SELECT name, arg_max(id, ord) AS id, min(ord) AS ord FROM ({_DICT}) GROUP BY name"


def _phrases(spark, sf_dir) -> DataFrame:
    pieces = F.array_distinct(F.transform(F.split(F.lower("text"), r"[.,;:!?\n]+", -1), lambda x: F.trim(x)))
    return Y.table(spark, sf_dir, "documents").select("doc_id", F.explode(pieces).alias("phrase"))


def _names(spark, sf_dir) -> DataFrame:
    return Y.dictionary(spark, sf_dir).groupBy("name").agg(F.max_by("id", "ord").alias("id"), F.min("ord").alias("ord"))


@query(f"WITH p AS ({_PHRASES}) SELECT doc_id, count(*) AS phrases, CAST(count_if({_OK}) AS BIGINT) AS findings FROM p GROUP BY doc_id")
def phrase_filter(spark, sf_dir):
    return _phrases(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("phrases"), F.count_if(C.is_finding(F.col("phrase"))).alias("findings"))


_TYPED = "SELECT p_partkey AS k, lower(p_brand || ' ' || p_name || ' ' || CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'other' END) AS phrase FROM {part}"


@query(f"WITH n AS ({_NAMES}), p AS ({_TYPED.format(part='part')}) SELECT k, phrase, id FROM p LEFT JOIN n ON n.name = p.phrase")
def exact_match(spark, sf_dir):
    return M.exact(Y.run(spark, sf_dir, _TYPED, "part"), _names(spark, sf_dir)).select("k", "phrase", "id")


@query()
def fuzzy_match(spark, sf_dir):
    """Distinct phrases of all documents against the whole dictionary: the best name of each, if it is near enough."""
    phrases = _phrases(spark, sf_dir).where(C.is_finding(F.col("phrase"))).select("phrase").distinct()
    return M.fuzzy(phrases, _names(spark, sf_dir)).select("phrase", "name", "id", F.round("score", 6).alias("score"))


#: Names of one to seven words, as benchmark items begin, which documents that quote them hold.
_BEGINS = "SELECT DISTINCT array_to_string(list_slice(string_split(lower(text), ' '), 1, 1 + item_id % 7), ' ') AS name FROM benchmark"
_BEGINS_SPARK = "SELECT DISTINCT array_join(slice(split(lower(text), ' '), 1, CAST(1 + item_id % 7 AS INT)), ' ') AS name FROM {benchmark}"
#: Every document, some with a clause that quotes an item and negates it or not.
_QUOTED = """SELECT doc_id AS id, d.text || CASE doc_id % 6 WHEN 0 THEN '. No sign of ' || b.text WHEN 1 THEN '. ' || b.text || ' was ruled out' WHEN 2 THEN '; not only ' || b.text
 WHEN 3 THEN '. Without pain, but ' || b.text WHEN 4 THEN '! Denies ' || b.text || ' and ' || b.text ELSE '' END AS text FROM {documents} d JOIN {benchmark} b ON b.item_id = d.doc_id % (SELECT count(*) FROM {benchmark})"""


def _matches_sql(out: str, phrases: str, cover: bool) -> str:
    """SQL: the longest of ``phrases`` (t, tag) from each place of ``toks`` (id, l); with ``cover`` without those inside others."""
    places = f"SELECT p.id, p.p - 1 AS a, p.p - 1 + len(n.t) AS b, n.tag FROM pos p JOIN {phrases} n ON n.t[1] = p.w WHERE list_slice(p.l, p.p, p.p + len(n.t) - 1) = n.t"
    longest = f"SELECT * FROM ({places}) QUALIFY row_number() OVER (PARTITION BY id, a ORDER BY b DESC, tag) = 1"
    if not cover:
        return f"{out} AS ({longest})"
    return f"{out} AS (SELECT * FROM ({longest}) QUALIFY b > coalesce(max(b) OVER (PARTITION BY id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1))"


_TOK = N.PATTERN.replace("'", "''")
_CUE_ROWS = ", ".join(f"('{w}', '{kind}')" for kind, ws in (("before", N.BEFORE), ("after", N.AFTER), ("pseudo", N.PSEUDO), ("turn", N.TURNS)) for w in ws)
_MENTIONS = f"""WITH names AS (SELECT t, min(name) AS tag FROM (SELECT name, regexp_extract_all(name, '{_TOK}') AS t FROM ({_BEGINS})) WHERE len(t) > 0 GROUP BY t),
 cues AS (SELECT string_split(w, ' ') AS t, kind AS tag FROM (VALUES {_CUE_ROWS}) AS x(w, kind)),
 toks AS (SELECT id, regexp_extract_all(lower(text), '{_TOK}') AS l FROM ({_QUOTED.format(documents='documents', benchmark='benchmark')})),
 pos AS (SELECT id, l, unnest(l) AS w, generate_subscripts(l, 1) AS p FROM toks),
 {_matches_sql('hit', 'names', True)}, {_matches_sql('cue', 'cues', False)},
 turns AS (SELECT id, a FROM cue WHERE tag = 'turn'),
 scope AS (SELECT p.id, p.p - 1 AS a, sum(CASE WHEN p.w IN ('.', ';', ':', '!', '?', chr(10)) THEN 1 ELSE 0 END) OVER (PARTITION BY p.id ORDER BY p.p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m,
  sum(CASE WHEN t.a IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY p.id ORDER BY p.p) AS n FROM pos p LEFT JOIN turns t ON t.id = p.id AND t.a = p.p - 1),
 reach AS (SELECT c.id, coalesce(m, 0) + n AS s, min(CASE WHEN tag = 'before' THEN b END) AS low, max(CASE WHEN tag = 'after' THEN c.a END) AS high FROM cue c JOIN scope s ON s.id = c.id AND s.a = c.a GROUP BY ALL)
 SELECT h.id, CAST(h.a AS BIGINT) AS begin, CAST(h.b AS BIGINT) AS "end", h.tag AS name, coalesce(low <= h.a, false) OR coalesce(high >= h.b, false) AS negated
 FROM hit h JOIN scope s ON s.id = h.id AND s.a = h.a LEFT JOIN reach r ON r.id = h.id AND r.s = coalesce(s.m, 0) + s.n"""


@query(_MENTIONS)
def text_mentions(spark, sf_dir):
    """Every mention of a name in every document, and whether it is negated."""
    texts = Y.run(spark, sf_dir, _QUOTED, "documents", "benchmark")
    return N.find(texts, Y.run(spark, sf_dir, _BEGINS_SPARK, "benchmark"))


@query()
def annotate_text(spark, sf_dir):
    """Term ids of every document, by mentions and by the best names of what stands between them."""
    texts = Y.run(spark, sf_dir, _QUOTED, "documents", "benchmark")
    begins = "SELECT array_join(slice(split(lower(text), ' '), 1, CAST(1 + item_id % 7 AS INT)), ' ') AS name, concat('HP:', lpad(cast(min(item_id) AS string), 7, '0')) AS id, min(item_id) AS ord FROM {benchmark} GROUP BY 1"
    return M.annotate(texts, Y.run(spark, sf_dir, begins, "benchmark")).select("id", F.array_join("terms", ",").alias("terms"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark, sf_dir):
    return Y.table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("""WITH s AS (SELECT l.doc_id, quality, CAST(n_chars AS DOUBLE) AS s FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
 SELECT round((SELECT count_if(b.s < a.s) + 0.5 * count_if(b.s = a.s) FROM s a, s b WHERE a.quality = 1 AND b.quality = 0) / (SELECT count_if(quality = 1) * count_if(quality = 0) FROM s), 6) AS auc""")
def label_auc(spark, sf_dir):
    """Area under the curve of text length for quality, by ranks: no pairs are made."""
    s = Y.table(spark, sf_dir, "labels").join(Y.table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    by = s.groupBy("n_chars").agg(F.count_if(F.col("quality") == 1).alias("p"), F.count_if(F.col("quality") == 0).alias("n")).withColumn("block", F.shiftright("n_chars", 16))
    so_far = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # lengths are 32-bit: at most 2**15 blocks of at most 2**16 lengths
    blocks = by.groupBy("block").agg(F.sum("n").alias("n")).select("block", so_far("n", Window.orderBy("block")).alias("before"))
    below = by.withColumn("inside", so_far("n", Window.partitionBy("block").orderBy("n_chars"))).join(blocks, "block")
    return below.agg(F.round(F.sum(F.col("p") * (F.col("before") + F.col("inside") + F.col("n") / 2)) / (F.sum("p") * F.sum("n")), 6).alias("auc"))
