"""Command line: python -m caseloom.plans.cli COMMAND ..."""

from __future__ import annotations

import argparse
import datetime
import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import match, sinks, stats, validate
from caseloom.operators import similarity as S
from caseloom.plans import pipelines
from caseloom.sources import documents, ontology, tables

log = logging.getLogger("caseloom")


# Names and defaults of the options.
def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="caseloom")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("merge", help="three source tables to one case table")
    for name in ("literature", "clinical", "hospital"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("-o", "--output", default="cases.tsv")
    c.add_argument("--hpo")
    c = sub.add_parser("annotate", help="id and text to term ids")
    c.add_argument("-i", "--input", required=True)
    c.add_argument("-o", "--output", required=True)
    c.add_argument("--hpo", default="resources/hp.obo")
    c = sub.add_parser("convert", help="cases to documents")
    c.add_argument("-i", "--input", default="cases.tsv")
    c.add_argument("-o", "--output", default="packets.json")
    c.add_argument("-f", "--format", choices=("json", "json-lines", "individual"), default="json")
    c.add_argument("--hpo", default="resources/hp.obo")
    c = sub.add_parser("validate", help="documents by the rules")
    c.add_argument("file")
    c = sub.add_parser("parse", help="phenotypes and variants of a case table")
    c.add_argument("input_csv_path")
    c.add_argument("--output_csv_path", default="parsed_data.csv")
    c.add_argument("--hpo_obo_path")
    c = sub.add_parser("generate", help="parsed cases to documents, one file each")
    c.add_argument("parsed_data_path")
    c.add_argument("--output_dir", default="packets")
    c = sub.add_parser("rank", help="genes by similarity of terms")
    c.add_argument("--packet_dir", default="packets")
    c.add_argument("--associations", required=True)
    c.add_argument("--hpo", default="resources/hp.obo")
    c.add_argument("--transcripts")
    c.add_argument("--output_json", default="validation_results.json")
    c.add_argument("--similarity_method", choices=S.METHODS, default="resnik")
    c.add_argument("-v", "--verbose", action="store_true")
    c.add_argument("-q", "--quiet", action="store_true")
    c.add_argument("--log-file")
    return p


def logged(verbose: bool, quiet: bool, path: str | None) -> None:
    """Messages from INFO on to standard error or a new file; ``verbose`` from DEBUG, ``quiet`` from WARNING on."""
    handler = logging.FileHandler(path, mode="w") if path else logging.StreamHandler()
    handler.setFormatter(logging.Formatter("%(asctime)s - %(levelname)s - %(message)s"))
    log.handlers[:] = [handler]
    log.setLevel(logging.DEBUG if verbose else logging.WARNING if quiet else logging.INFO)


def as_one_file(spark: SparkSession, write, df: DataFrame, path: str, **options) -> None:
    """Parts by many tasks beside ``path``, then one file of their bytes."""
    write(df, f"{path}.parts", **options)
    sinks.single_file(spark, f"{path}.parts", path)
    sinks.remove(spark, f"{path}.parts")


def conversion_lines(summary: dict, sample: dict | None) -> list[str]:
    """Closing statistics of a conversion, with shares, and what the first document holds."""
    share = lambda a, b: f"{summary[a]} ({100 * summary[a] / b:.1f}%)" if b else f"{summary[a]}"
    n = summary["packets"]
    out = [f"Documents: {n}", f"With sex: {share('with_sex', n)}", f"With age: {share('with_age', n)}", f"With features: {share('with_features', n)}"]
    if summary["features"]:
        out += [f"Features: {summary['features']}", f"Features with labels: {share('labelled_features', summary['features'])}"]
    out += [f"With variants: {share('with_variants', n)}"]
    if summary["variants"]:
        out += [f"Variants: {summary['variants']}", f"Variants with genes: {share('variants_with_gene', summary['variants'])}"]
    out += [f"With diagnosis: {share('with_diseases', n)}"]
    if summary["with_diseases"]:
        out += [f"Diagnoses with OMIM ids: {share('omim_diseases', summary['with_diseases'])}"]
    if sample:
        out += [f"First document: {sample['id']}"]
        out += [f"First feature: {f['type']['id']}, {f['type']['label']}" for f in sample["phenotypicFeatures"][:1]]
        variants = [g for i in (sample["interpretations"] or [])[:1] for g in i["diagnosis"]["genomicInterpretations"][:1]]
        for g in variants:
            d = g["variantInterpretation"]["variationDescriptor"]
            out += [f"First variant: {d['variation']['text']}" + (f", gene {d['geneContext']['symbol']}" if d["geneContext"] else "")]
    return out


def generation_lines(summary: dict, top: list[tuple[str, int]]) -> list[str]:
    """Closing statistics of the second pipeline's documents."""
    mean = f"{summary['features'] / summary['with_features']:.2f}" if summary["with_features"] else "none has any"
    out = [f"Cases: {summary['cases']}", f"Documents: {summary['written']}", f"Cases with features: {summary['with_features']}", f"Cases with variants: {summary['with_variants']}", f"Features for each case that has any: {mean}"]
    return out + ([f"The {len(top)} most frequent features:"] + [f"  {term}: {n}" for term, n in top] if top else ["No features"])


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    spark = SparkSession.builder.appName("caseloom").getOrCreate()
    if a.command == "merge":
        names = ontology.names(ontology.terms(spark, a.hpo)) if a.hpo else None
        cases = pipelines.canonical_cases(tables.read_latin1(spark, a.literature), tables.read_latin1(spark, a.clinical), tables.read_sheet(spark, a.hospital), names)
        sinks.write_delimited(cases, a.output)
        stats.case_coverage(cases).show(truncate=False)
    elif a.command == "annotate":
        found = match.annotate(tables.read_positional(spark, a.input).select("id", "text"), ontology.names(ontology.terms(spark, a.hpo)))
        found = found.cache()
        as_one_file(spark, sinks.write_annotations, found, a.output)
        print("without a term:", stats.annotation_gaps(found).count())
    elif a.command == "convert":
        now = datetime.datetime.now().isoformat() + "Z"
        made = pipelines.convert(spark, a.input, ontology.labels_or_empty(spark, a.hpo), now).cache()
        if a.format == "json":
            as_one_file(spark, sinks.write_json_array, made, a.output)
        elif a.format == "json-lines":
            sinks.write_json_lines(made, a.output)
        else:
            sinks.write_each(made, a.output.replace(".json", "_individual"))
        first = made.orderBy("id").limit(1).collect()
        print("\n".join(conversion_lines(stats.packet_summary(made).first().asDict(), first[0].asDict(True) if first else None)))
    elif a.command == "validate":
        found = pipelines.check(spark, a.file).cache()
        totals = validate.totals(found)
        totals.show(truncate=False, vertical=True)
        found.limit(5).select("name", F.slice("errors", 1, 3), F.slice("warnings", 1, 3)).show(truncate=False)
        return 0 if totals.first()["file_valid"] else 1
    elif a.command == "parse":
        names = ontology.loose_names(spark, a.hpo_obo_path) if a.hpo_obo_path else None
        sinks.write_delimited(pipelines.parse_cases(tables.read_delimited(spark, a.input_csv_path), names), a.output_csv_path, ",")
    elif a.command == "generate":
        now = datetime.datetime.now().isoformat() + "Z"
        parsed = tables.read_delimited(spark, a.parsed_data_path, ",", strip_header=True)
        good, rejected = pipelines.generate(parsed, now)
        written = sinks.write_each(good, a.output_dir)
        for r in rejected.limit(20).collect():
            print(f"Not written: {r.id}: {r.messages}")
        summary, top = pipelines.generation_summary(parsed)
        print("\n".join(generation_lines(summary.first().asDict() | {"written": written}, [(r.term, r.n) for r in top.collect()])))
    else:
        logged(a.verbose, a.quiet, a.log_file)
        terms = ontology.terms(spark, a.hpo)
        profiles = tables.read_associations(spark, a.associations).withColumnRenamed("gene", "entity_id")
        log.info("scoring with %s", a.similarity_method)
        results, skipped = pipelines.rank_genes(documents.read_packets(spark, a.packet_dir), profiles, ontology.edges(terms), tables.read_transcripts(spark, a.transcripts), a.similarity_method)
        results = results.cache()
        for r in skipped.groupBy("skip_reason").count().orderBy("skip_reason").collect():
            log.warning("%d skipped: %s", r["count"], r.skip_reason)
        if results.isEmpty():
            log.warning("no results")
            return 0
        as_one_file(spark, sinks.write_json_array, results, a.output_json, indent=4, key="packet_id")
        log.info("results written to %s", a.output_json)
        print(sinks.metrics_json(S.metrics(results)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
