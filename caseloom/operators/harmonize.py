"""Source tables into one canonical case table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import clinical as C
from caseloom.functions.missing import SENTINEL, fill_sentinel

LITERATURE_LINK = "https://pubmed.ncbi.nlm.nih.gov/28600779/"
HOSPITAL_LINKS = "hospital_collaborator, https://link.springer.com/article/10.1186/s12920-020-00743-8 , https://onlinelibrary.wiley.com/doi/full/10.1111/cge.13842"

# The common layout of sources, and canonical names of its columns in output order.
LAYOUT = (
    "ID", "test", "test_strategy", "gender", "age", "consanguinity", "family_id", "number_of_family_members", "cohort_size",
    "phenotypes", "result", "result_comment", "variants", "zygosity", "pathogenicity", "reference", "dataSourceType", "HPO_ID",
)
CANONICAL = {
    "ID": "ID", "gender": "sex", "age": "age", "consanguinity": "consanguinityStatus", "family_id": "familyId",
    "number_of_family_members": "totalFamilyMembers", "cohort_size": "totalCohortMembers", "phenotypes": "phenotypicFeatures",
    "HPO_ID": "phenotypicFeatureIds", "test": "procedure", "test_strategy": "procedureStrategy", "result": "diagnosis",
    "result_comment": "diagnosticComment", "variants": "genomicVariants", "zygosity": "zygosityStatus",
    "pathogenicity": "variantInterpretation", "dataSourceType": "dataSourceType", "reference": "externalReference",
}


@dataclass(frozen=True)
class SourceSpec:
    """How a source's columns become the common layout.

    ``derived`` sees renamed columns; ``keep`` filters raw rows; with ``number``
    the rows get 1..n in ``order`` in place of their own id (after the filter).
    """

    kind: str
    rename: dict[str, str] = field(default_factory=dict)
    derived: dict[str, Column] = field(default_factory=dict)
    keep: Column | None = None
    number: bool = True
    drop_empty: bool = True


def literature() -> SourceSpec:
    return SourceSpec(
        "literature", {"id": "ID", "patient_gender": "gender", "patient_age": "age"},
        keep=~F.col("reference").eqNullSafe(F.lit(LITERATURE_LINK)),  # rows without a reference stay
    )


def clinical_literature() -> SourceSpec:
    return SourceSpec(
        "clinical_literature",
        {
            "Testing Strategy": "test_strategy", "Gender": "gender", "Age": "age", "Test": "test", "Consanguinity": "consanguinity",
            "Family hx": "result_comment", "Result": "result", "Zyogsity": "zygosity", "Phenotype": "phenotypes",
        },
        {
            "variants": F.col("`Variant(s)`"), "pathogenicity": F.col("HGMD"), "reference": F.lit(LITERATURE_LINK), "family_id": F.col("ID"),
            "number_of_family_members": F.lit(SENTINEL), "cohort_size": F.lit(SENTINEL),
        },
    )


def hospital() -> SourceSpec:
    col = lambda n: F.col(f"`{n}`")
    return SourceSpec(
        "clinical_collaborator",
        {
            "Case": "ID", "Test": "test", " Test Type": "test_strategy", "Gender": "gender", "DOB": "age", "Consanguinity ": "consanguinity",
            "Results Internal": "result", "Zygosity": "zygosity", "HPOs": "phenotypes", "Family ID": "family_id",
        },
        {
            "variants": C.joined_columns(*map(col, ("Gene", "Variant ", "Gene 2", "Variant 2  ", "Gene 3", "Variant 3  ", "Gene 4", "Variant4"))),
            "pathogenicity": C.joined_columns(*map(col, ("pathogenicity ", "pathogenicity 2 ", "pathogenicity 3", "pathogenicity 4"))),
            "result_comment": C.labelled(Comments=F.col("Comments"), Inheritance=F.col("Inheritance"), OMIM=F.col("Omim")),
            "reference": F.lit(HOSPITAL_LINKS), "number_of_family_members": F.col("test_strategy"), "cohort_size": F.col("test_strategy"),
        },
        number=False, drop_empty=False,
    )


def standardise(df: DataFrame, spec: SourceSpec, order: list | None = None) -> DataFrame:
    """One source in the common layout."""
    from caseloom.sources.tables import numbered

    order = order or [F.monotonically_increasing_id()]
    raw = df.na.drop(how="all") if spec.drop_empty else df
    if spec.keep is not None:
        raw = raw.where(spec.keep)
    out = raw.withColumnsRenamed(spec.rename)
    if spec.number:
        out = numbered(out.drop("ID"), order)
    out = out.withColumns({**spec.derived, "dataSourceType": F.lit(spec.kind)})
    out = out.withColumn("HPO_ID", C.term_ids(F.col("phenotypes")))
    return out.select(*[F.col(c).cast("string").alias(c) for c in LAYOUT])


def union_sources(*sources: DataFrame, prefix: str = "CASE", dedupe_on: list[str] | None = None, order: list | None = None) -> DataFrame:
    """All sources, with new ids ``prefix`` + n, canonical names and the sentinel for nulls.

    ``dedupe_on`` drops rows that agree in these columns; by default none are
    dropped, as a fresh id makes every row different.
    """
    from caseloom.sources.tables import numbered

    every = sources[0].withColumn("_s", F.lit(0))
    for k, s in enumerate(sources[1:], 1):
        every = every.unionByName(s.withColumn("_s", F.lit(k)))
    if dedupe_on:
        every = every.dropDuplicates(dedupe_on)
    every = numbered(every.withColumnRenamed("ID", "_old"), order or ["_s", F.col("_old").try_cast("long"), "_old"], "_n")
    every = every.withColumn("ID", F.concat(F.lit(prefix), F.col("_n").cast("string")))
    return fill_sentinel(every.select(*[F.col(k).alias(v) for k, v in CANONICAL.items()]))


def keyed_phenotypes(literature_: DataFrame, clinical: DataFrame, prefixes: tuple[str, str] = ("LIT_", "CLIT_")) -> DataFrame:
    """ID (prefixed) and phenotypes of two sources, for an annotator."""
    a, b = (d.select(F.concat(F.lit(p), F.col("ID").cast("string")).alias("ID"), "phenotypes") for d, p in zip((literature_, clinical), prefixes))
    return a.unionByName(b)


def merge_annotations(cases: DataFrame, annotations: DataFrame, prefix: str) -> DataFrame:
    """Unites a source's own ids with an annotator's: ``HP:`` ids only, sorted, distinct."""
    mine = annotations.where(F.col("id").startswith(prefix)).select(F.substring("id", len(prefix) + 1, 1 << 20).alias("ID"), F.col("terms").alias("_terms"))
    both = cases.withColumn("ID", F.col("ID").cast("string")).join(mine, "ID", "left")
    own = F.coalesce(F.transform(F.split("HPO_ID", ","), lambda x: F.trim(x)), F.array().cast("array<string>"))
    more = F.coalesce("_terms", F.array().cast("array<string>"))
    ids = F.array_sort(F.filter(F.array_union(own, more), lambda x: x.startswith("HP:")))
    return both.withColumn("HPO_ID", F.array_join(ids, ",")).drop("_terms")
