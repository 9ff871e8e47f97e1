"""Nested case documents from canonical cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import clinical as C
from caseloom.functions.missing import SENTINEL, bound, is_missing

# Resources that every document names.
RESOURCES = (
    ("hp", "Human Phenotype Ontology", "http://purl.obolibrary.org/obo/hp.owl", "2024-04-26", "HP", "http://purl.obolibrary.org/obo/HP_"),
    ("geno", "Genotype Ontology", "http://purl.obolibrary.org/obo/geno.owl", "2020-03-08", "GENO", "http://purl.obolibrary.org/obo/GENO_"),
    ("omim", "Online Mendelian Inheritance in Man", "https://www.omim.org", "2024-01", "OMIM", "https://omim.org/entry/"),
)
# Further columns and their names in the document.
EXTRA = {
    "consanguinityStatus": "consanguinity", "familyId": "familyId", "totalFamilyMembers": "totalFamilyMembers",
    "totalCohortMembers": "totalCohortMembers", "procedure": "testingProcedure", "procedureStrategy": "testingStrategy",
    "diagnosticComment": "diagnosticComment", "zygosityStatus": "zygosityStatus", "dataSourceType": "dataSourceType",
}
_VARIANT = "struct<subjectOrBiosampleId:string,interpretationStatus:string,variantInterpretation:struct<variationDescriptor:struct<id:string,variation:struct<text:string>,geneContext:struct<valueId:string,symbol:string>,expressions:array<struct<syntax:string,value:string>>>,acmgPathogenicityClassification:string>>"
PACKET = (
    "id string, subject struct<id:string,sex:string,timeAtLastEncounter:struct<age:struct<iso8601duration:string>>>, "
    "phenotypicFeatures array<struct<type:struct<id:string,label:string>>>, "
    "metaData struct<created:string,createdBy:string,resources:array<struct<id:string,name:string,url:string,version:string,namespacePrefix:string,iriPrefix:string>>,"
    "phenopacketSchemaVersion:string,externalReferences:array<struct<id:string,reference:string,description:string>>,"
    "sourceData:struct<" + ",".join(f"{v}:string" for v in EXTRA.values()) + ">>, "
    f"interpretations array<struct<id:string,progressStatus:string,diagnosis:struct<genomicInterpretations:array<{_VARIANT}>>>>, "
    "diseases array<struct<term:struct<id:string,label:string>>>"
)


def labelled_features(cases: DataFrame, terms: DataFrame, key: str = "ID", ids: str = "phenotypicFeatureIds") -> DataFrame:
    """key and features: id and label of each listed term, in order; unknown ids say so.

    ``terms`` (id, label) is left to the optimiser to broadcast by its size.
    """
    each = cases.select(key, F.posexplode(C.listed_terms(F.col(ids))).alias("pos", "_term"))
    named = each.join(terms.select(F.col("id").alias("_term"), "label"), "_term", "left")
    label = F.coalesce("label", F.concat(F.lit("Unknown term: "), F.col("_term")))
    rows = F.collect_list(F.struct("pos", F.struct(F.struct(F.col("_term").alias("id"), label.alias("label")).alias("type")).alias("f")))
    return named.groupBy(key).agg(F.transform(F.array_sort(rows), lambda x: x["f"]).alias("features"))


def interpretations(subject: Column, variants: Column, pathogenicity: Column, strict: bool = False) -> Column:
    acmg = C.acmg_class(pathogenicity, strict)

    def one(v: Column, i: Column) -> Column:
        gene = bound(C.gene_symbol(v), lambda g: F.when(g.isNotNull(), F.struct(F.concat(F.lit("HGNC:"), g).alias("valueId"), g.alias("symbol"))))
        return F.struct(
            subject.alias("subjectOrBiosampleId"), F.lit("UNKNOWN_STATUS").alias("interpretationStatus"),
            F.struct(
                F.struct(
                    F.concat(subject, F.lit("_variant"), (i + 1).cast("string")).alias("id"), F.struct(v.alias("text")).alias("variation"),
                    gene.alias("geneContext"),
                ).alias("variationDescriptor"),
                acmg.alias("acmgPathogenicityClassification"),
            ).alias("variantInterpretation"),
        )

    listed = C.variant_list(variants)
    whole = F.array(F.struct(F.concat(subject, F.lit("_interpretation")).alias("id"), F.lit("COMPLETED").alias("progressStatus"), F.struct(F.transform(listed, one).alias("genomicInterpretations")).alias("diagnosis")))
    return F.when(F.size(listed) > 0, whole)


def build(cases: DataFrame, terms: DataFrame, created: str, created_by: str = "Case Data Pipeline", strict: bool = False) -> DataFrame:
    """One document for each case, keys in their written order; null members are left out of JSON."""
    features = labelled_features(cases, terms)
    c = cases.join(features, "ID", "left")
    col = F.col
    sex, age, comment = C.sex_enum(col("sex")), C.age_iso(col("age")), col("diagnosticComment")
    has_comment = ~is_missing(comment, blank=False)
    subject = F.struct(
        col("ID").alias("id"), bound(sex, lambda x: F.when(x != "UNKNOWN_SEX", x)).alias("sex"),
        bound(age, lambda x: F.when(x.isNotNull(), F.struct(F.struct(x.alias("iso8601duration")).alias("age")))).alias("timeAtLastEncounter"),
    )
    names = ("id", "name", "url", "version", "namespacePrefix", "iriPrefix")
    resources = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in RESOURCES])
    source = F.coalesce("dataSourceType", F.lit(SENTINEL))
    references = F.transform(C.reference_list(col("externalReference")), lambda r: F.struct(r.alias("id"), r.alias("reference"), F.concat(F.lit("Source: "), source).alias("description")))
    kept = {new: F.when(~is_missing(col(old), blank=False), col(old)) for old, new in EXTRA.items()}
    extra = F.when(F.coalesce(*kept.values()).isNotNull(), F.struct(*[v.alias(k) for k, v in kept.items()]))
    disease = F.array(F.struct(F.struct(F.coalesce(C.omim_id(comment), F.lit("")).alias("id"), comment.alias("label")).alias("term")))
    return c.select(
        col("ID").alias("id"), subject.alias("subject"),
        F.coalesce("features", F.array().cast("array<struct<type:struct<id:string,label:string>>>")).alias("phenotypicFeatures"),
        F.struct(
            F.lit(created).alias("created"), F.lit(created_by).alias("createdBy"), resources.alias("resources"), F.lit("2.0").alias("phenopacketSchemaVersion"),
            references.alias("externalReferences"), extra.alias("sourceData"),
        ).alias("metaData"),
        interpretations(col("ID"), col("genomicVariants"), col("variantInterpretation"), strict).alias("interpretations"),
        F.when(has_comment, disease).alias("diseases"),
    )


def as_json(packets: DataFrame) -> DataFrame:
    return packets.select("id", F.to_json(F.struct(*packets.columns)).alias("doc"))


def guarded(cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cases that can be built, and a quarantine (ID, error) of those that cannot.

    The expressions are total, so only a missing id keeps a case from being built.
    """
    return cases.where("ID is not null"), cases.where("ID is null").select("ID", F.lit("ID is missing").alias("error"))


def parsed_packets(parsed: DataFrame, created: str, prefix: str = "CASE_", terms: DataFrame | None = None) -> DataFrame:
    """Documents of the second pipeline from parsed id lists (``;``-joined strings, null where missing).

    Ids and free-text labels are paired if there are as many of both, else an id
    is its own label; ``terms`` (id, label) gives labels from the ontology instead.
    The first disease counts.  Sex is unknown; variants carry the chosen
    expression and a placeholder for coordinates.
    """
    split = lambda n: F.coalesce(F.filter(F.split(n, ";"), lambda x: x != ""), F.array().cast("array<string>"))
    p = parsed.select("ID", "reference", split("parsed_hpo_ids").alias("h"), split("parsed_pheno_text").alias("t"), split("parsed_omim_ids").alias("o"), C.parts(F.coalesce("parsed_variants", F.lit("")), ";").alias("v"))
    label = F.when(F.size("h") == F.size("t"), F.zip_with("h", "t", lambda a, b: F.struct(F.struct(a.alias("id"), b.alias("label")).alias("type")))).otherwise(F.transform("h", lambda a: F.struct(F.struct(a.alias("id"), a.alias("label")).alias("type"))))
    if terms is not None:
        named = labelled_features(p.withColumn("phenotypicFeatureIds", F.array_join("h", ",")), terms).withColumnRenamed("ID", "_id")
        p = p.join(named, F.col("ID") == F.col("_id"), "left")
        label = F.coalesce("features", F.array().cast("array<struct<type:struct<id:string,label:string>>>"))

    def variant(v: Column) -> Column:
        return bound(C.variant_components(v), lambda parts: described(v, parts))

    def described(v: Column, parts: Column) -> Column:
        return F.struct(
            F.struct(
                F.when(parts["symbol"].isNotNull(), F.struct(parts["symbol"].alias("valueId"), parts["symbol"].alias("symbol"))).alias("geneContext"),
                F.array(F.struct(F.lit("hgvs").alias("syntax"), C.chosen_expression(v, parts).alias("value"))).alias("expressions"),
                F.struct(F.lit("hg38").alias("genomeAssembly"), F.lit("N/A").alias("chrom"), F.lit(0).alias("pos"), F.lit("N/A").alias("ref"), F.lit("N/A").alias("alt")).alias("vcfRecord"),
            ).alias("variationDescriptor")
        )

    # "ID" inside a lambda would be taken for the new column "id" of the same select
    p = p.withColumn("_own", F.col("ID"))
    gi = F.transform("v", lambda v: F.struct(F.col("_own").alias("subjectOrBiosampleId"), F.lit("CAUSATIVE").alias("interpretationStatus"), variant(v).alias("variantInterpretation")))
    cite = C.pmid(F.col("reference"))
    return p.select(
        F.concat(F.lit(prefix), F.col("ID")).alias("id"), F.struct(F.col("ID").alias("id")).alias("subject"), label.alias("phenotypicFeatures"),
        F.when(F.size("v") > 0, F.array(F.struct(F.col("ID").alias("id"), F.lit("SOLVED").alias("progressStatus"), F.struct(gi.alias("genomicInterpretations")).alias("diagnosis")))).alias("interpretations"),
        F.when(F.size("o") > 0, F.array(F.struct(F.struct(F.get("o", F.lit(0)).alias("id"), F.get("o", F.lit(0)).alias("label")).alias("term")))).alias("diseases"),
        F.struct(F.lit(created).alias("created"), F.lit("2.0").alias("phenopacketSchemaVersion"), F.when(cite.isNotNull(), F.array(F.struct(cite.alias("id"), F.col("reference").alias("description")))).alias("externalReferences")).alias("metaData"),
    )
