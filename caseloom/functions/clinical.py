"""Readers of clinical free text: age, sex, disease and term ids, genes, variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.functions import hgvs
from caseloom.functions.missing import SENTINEL, bound, is_missing, none_if_empty, parts, sorted_distinct, strip

# Ages in words.
AGE_WORDS = {
    "NEWBORN": "P0D", "NEONATE": "P0D", "NEONATAL": "P0D", "INFANT": "P6M", "CHILD": "P5Y", "CHILDHOOD": "P5Y",
    "ADOLESCENT": "P15Y", "ADOLESCENCE": "P15Y", "ADULT": "P25Y", "ADULTHOOD": "P25Y",
}
# Words of the sex column.
SEX_WORDS = {"MALE": ("male", "m", "man", "boy"), "FEMALE": ("female", "f", "woman", "girl"), "OTHER_SEX": ("other", "intersex")}
# Pathogenicity classes, in the order in which they are tried.
ACMG = (
    ("pathogenic", "PATHOGENIC"), ("likely pathogenic", "LIKELY_PATHOGENIC"), ("uncertain significance", "UNCERTAIN_SIGNIFICANCE"),
    ("vus", "UNCERTAIN_SIGNIFICANCE"), ("likely benign", "LIKELY_BENIGN"), ("benign", "BENIGN"),
)
# Phrases that are no finding.
NO_FINDING = ("patient", "patients", "man", "woman", "male", "female", "the patient", "evidence", "person", "subject")
# Beginnings that are no gene symbol; and kinds of expressions.  The patterns for terms, genes, ages and
# diseases in the functions below are fixed as well.
NOT_GENE = ("NM_", "NR_", "c.", "g.", "p.", "chr")
TRANSCRIPTS = ("NM_", "NR_")
EXPRESSIONS = ("c.", "g.", "p.", "n.", "r.")


def _starts(c: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


def age_iso(c: Column) -> Column:
    """An ISO 8601 duration from an age in words or numbers; null if there is none.

    Texts that begin with P are taken as they are; years, months, days and weeks
    (as days) are read independently and in this order.
    """
    part = lambda n, letter: bound(n, lambda x: F.when(x != "", F.concat(x, F.lit(letter))).otherwise(""))
    words = F.create_map(*[F.lit(x) for kv in AGE_WORDS.items() for x in kv])
    in_days = lambda w: F.when(w != "", F.concat((F.expr("cast(7 as decimal(10,0))") * w.try_cast("decimal(28,0)")).cast("string"), F.lit("D"))).otherwise("")

    def found(text: Column) -> Column:
        number = lambda unit: F.regexp_extract(text, rf"(?U)(\d+)\s*(?:{unit})", 1)
        iso = F.concat(part(number("YEARS?|Y"), "Y"), part(F.regexp_extract(text, r"(?U)(\d+)\s*(?:MONTHS?|M)(?!Y)", 1), "M"), part(number("DAYS?|D"), "D"), bound(number("WEEKS?|W"), in_days))
        read = bound(iso, lambda x: F.when(x != "", F.concat(F.lit("P"), x)))
        return F.when(text.startswith("P"), text).when(text.isin(*AGE_WORDS), F.try_element_at(words, text)).otherwise(read)

    return F.when(~is_missing(c), bound(strip(F.upper(c)), found))


def sex_enum(c: Column) -> Column:
    text = F.lower(strip(c))
    out = F.when(is_missing(c, blank=False), "UNKNOWN_SEX")
    for value, words in SEX_WORDS.items():
        out = out.when(text.isin(*words), value)
    return out.otherwise("UNKNOWN_SEX")


def term_ids(c: Column) -> Column:
    """Comma-joined term ids of a text in order of first mention; empty for none or null."""
    return F.coalesce(F.array_join(F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)HP:\d+"), F.lit(0))), ","), F.lit(""))


def listed_terms(c: Column) -> Column:
    """The ids of a comma-joined list; order and repeats are kept."""
    return F.when(is_missing(c), F.array().cast("array<string>")).otherwise(F.filter(parts(c, ","), lambda x: x.startswith("HP:")))


def gene_symbol(c: Column) -> Column:
    """The gene a variant text begins with, or null."""
    def found(v: Column) -> Column:
        return F.coalesce(
            bound(F.regexp_extract(v, r"^([A-Z][A-Z0-9]+):", 1), lambda x: F.when((x != "") & ~x.startswith("CHR"), x)),
            bound(F.regexp_extract(v, r"(?U)^([A-Z][A-Z0-9]+)\s*[\(\[]", 1), none_if_empty),
            bound(F.regexp_extract(v, r"(?U)^([A-Z][A-Z0-9]+)\s+[cpgn]\.", 1), none_if_empty),
        )

    return bound(strip(c), found)


def omim_id(c: Column) -> Column:
    """``OMIM:`` and six digits, from the first pattern that fits."""
    tried = [bound(F.regexp_extract(c, p, 1), none_if_empty) for p in (r"(?iU)OMIM:\s*(\d{6})", r"(?iU)OMIM\s+(\d{6})", r"(?U)#(\d{6})")]
    return F.when(~is_missing(c, blank=False), F.concat(F.lit("OMIM:"), F.coalesce(*tried)))


def acmg_class(c: Column, strict: bool = False) -> Column:
    """The class whose name the text contains.

    By default names are tried in their listed order, so that "likely
    pathogenic" gives PATHOGENIC; ``strict`` tries longer names first.
    """
    text = F.lower(c)
    out = F.when(is_missing(c, blank=False), "NOT_PROVIDED")
    for name, value in sorted(ACMG, key=lambda kv: -len(kv[0])) if strict else ACMG:
        out = out.when(F.contains(text, F.lit(name)), value)
    return out.otherwise("NOT_PROVIDED")


def variant_list(c: Column) -> Column:
    """The variants of a ``;``-joined text, empty parts left out."""
    return F.when(is_missing(c, stripped=True, also=("nan",)), F.array().cast("array<string>")).otherwise(parts(c, ";"))


def reference_list(c: Column) -> Column:
    return F.when(is_missing(c, blank=False), F.array().cast("array<string>")).otherwise(parts(c, ","))


def joined_columns(*columns: Column) -> Column:
    """``;``-joined, null as empty, so that separators stay."""
    return F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in columns])


def labelled(**columns: Column) -> Column:
    """``Label: value`` parts joined by ``;``, without those at the ends."""
    each = [F.when(c.isNotNull(), F.concat(F.lit(f"{label}: "), c)).otherwise("") for label, c in columns.items()]
    return F.regexp_replace(F.concat_ws(";", *each), r"^;+|;+$", "")


def phenotype_parts(c: Column, term_of: Column | None = None) -> Column:
    """struct(hpo, omim, text): sorted distinct ids and unmapped labels of a text; see ``phenotype_pieces``."""
    return phenotype_sets(phenotype_pieces(c, term_of))


def phenotype_sets(pieces: Column) -> Column:
    """struct(hpo, omim, text) over all pieces of a text."""
    pick = lambda k: sorted_distinct(F.flatten(F.transform(pieces, lambda x: x[k])))
    return F.struct(pick("hpo").alias("hpo"), pick("omim").alias("omim"), pick("text").alias("text"))


def phenotype_pieces(c: Column, term_of: Column | None = None) -> Column:
    """A struct(hpo, omim, text) of arrays for each part of a text.

    Parts are separated by ``|`` or ``,``.  A part with a label before a term id
    gives that id only; else one with a label before a disease id gives that; else
    all bracketed ids; else the part without brackets is free text.
    ``term_of``, a map of lower-cased names to ids, maps free text.
    """
    pieces = F.coalesce(parts(F.translate(c, ",", "|"), r"\|"), F.array().cast("array<string>"))
    empty = F.array().cast("array<string>")

    def one(p: Column) -> Column:
        # a pattern is only tried where the part has the letters it begins with
        has_h, has_o = F.contains(p, F.lit("(HP:")), F.contains(p, F.lit("(OMIM:"))
        hpo = F.when(has_h, F.regexp_extract(p, r"(?U)[\w\s;-]+\s*\((HP:\d{7})\)", 1)).otherwise("")
        omim = F.when(has_o, F.regexp_extract(p, r"(?U)[\w\s;-]+\s*\((OMIM:\d{6})\)", 1)).otherwise("")
        bare_h = F.when(has_h, F.regexp_extract_all(p, F.lit(r"(?U)\((HP:\d{7})\)"), F.lit(1))).otherwise(empty)
        bare_o = F.when(has_o, F.regexp_extract_all(p, F.lit(r"(?U)\((OMIM:\d{6})\)"), F.lit(1))).otherwise(empty)
        make = lambda h, o, t: F.struct(h.alias("hpo"), o.alias("omim"), t.alias("text"))

        def as_free(free: Column) -> Column:
            if term_of is None:
                return F.when(free != "", make(empty, empty, F.array(free))).otherwise(make(empty, empty, empty))
            mapped = lambda m: F.when(m.isNull(), make(empty, empty, F.array(free))).otherwise(make(F.array(m), empty, empty))
            return F.when(free != "", bound(F.try_element_at(term_of, F.lower(free)), mapped)).otherwise(make(empty, empty, empty))

        def bare(x: Column) -> Column:
            none = (F.size(x["hpo"]) == 0) & (F.size(x["omim"]) == 0)
            return F.when(none, bound(strip(F.regexp_replace(p, r"\([^)]*\)", "")), as_free)).otherwise(x)

        left = lambda o: F.when(o != "", make(empty, F.array(o), empty)).otherwise(bound(make(bare_h, bare_o, empty), bare))
        return bound(hpo, lambda h: F.when(h != "", make(F.array(h), empty, empty)).otherwise(bound(omim, left)))

    return F.transform(pieces, one)


def variant_expressions(v: Column) -> Column:
    """The expressions of one variant text, by a scan over its ``:`` parts.

    The first part is the gene unless it begins like an accession or expression; a
    transcript goes before later c., n. and r. parts, the gene before p. parts.
    Without any expression the text is cut at commas and semicolons.
    """
    state = "struct<g:string,t:string,e:array<string>>"
    start = F.struct(F.lit(None).cast("string").alias("g"), F.lit(None).cast("string").alias("t"), F.array().cast("array<string>").alias("e"))
    items = F.transform(F.split(v, ":", -1), lambda p, i: F.struct(strip(p).alias("p"), i.alias("i")))

    def step(s: Column, x: Column) -> Column:
        p = x["p"]
        make = lambda g, t, e: F.struct(g.alias("g"), t.alias("t"), e.alias("e")).cast(state)
        led = F.when(s["t"].isNotNull() & (s["t"] != "") & _starts(p, ("c.", "n.", "r.")), F.concat(s["t"], F.lit(":"), p))
        led = led.when(s["g"].isNotNull() & (s["g"] != "") & p.startswith("p."), F.concat(s["g"], F.lit(":"), p)).otherwise(p)
        return (
            F.when((x["i"] == 0) & ~_starts(p, NOT_GENE), make(p, s["t"], s["e"]))
            .when(_starts(p, TRANSCRIPTS), make(s["g"], p, s["e"]))
            .when(_starts(p, EXPRESSIONS), make(s["g"], s["t"], F.concat(s["e"], F.array(led))))
            .otherwise(s)
        )

    scanned = F.when(F.contains(v, F.lit(":")), F.aggregate(items, start.cast(state), step)["e"]).otherwise(F.array().cast("array<string>"))
    cut = F.filter(F.transform(F.split(v, r"(?U)[,;]\s*", -1), strip), lambda x: x != "")
    rest = bound(cut, lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(v)))
    return bound(scanned, lambda x: F.when(F.size(x) > 0, x).otherwise(rest))


def parsed_variants(c: Column) -> Column:
    """One text for each variant, its expressions joined by commas."""
    each = parts(F.translate(c, "|", ";"), ";")
    out = F.transform(each, lambda v: F.array_join(F.transform(variant_expressions(v), hgvs.normal), ","))
    return F.coalesce(out, F.array().cast("array<string>"))


def variant_components(v: Column) -> Column:
    """struct(symbol, transcript, genomic, protein, cdna, other) of comma-joined expressions.

    An expression has at most three ``:`` parts (the third keeps the rest); later
    expressions replace what earlier ones gave.
    """
    kind = "struct<symbol:string,transcript:string,genomic:string,protein:string,cdna:string,other:array<string>>"
    null = F.lit(None).cast("string")
    start = F.struct(*[null.alias(k) for k in ("symbol", "transcript", "genomic", "protein", "cdna")], F.array().cast("array<string>").alias("other"))
    tokens = F.flatten(
        F.transform(
            F.transform(F.split(v, ",", -1), strip),
            lambda e: F.when(F.contains(e, F.lit(":")), F.transform(F.split(e, ":", 3), lambda p, i: F.struct(strip(p).alias("p"), (i + 1).alias("i")))).otherwise(F.array(F.struct(e.alias("p"), F.lit(0).alias("i")))),
        )
    )

    def step(s: Column, x: Column) -> Column:
        p, i = x["p"], x["i"]
        is_transcript = _starts(p, TRANSCRIPTS) & (i != 3)
        is_symbol = (i == 1) & ~_starts(p, (*NOT_GENE, "NC_"))
        late = i != 1
        keep = lambda name, when: F.when(when, p).otherwise(s[name]).alias(name)
        plain = (i == 0) & ~_starts(p, ("p.", "g.", "c.", *TRANSCRIPTS))
        return F.struct(
            keep("symbol", is_symbol), keep("transcript", is_transcript), keep("genomic", late & p.startswith("g.")), keep("protein", late & p.startswith("p.")),
            keep("cdna", late & p.startswith("c.")), F.when(plain, F.concat(s["other"], F.array(p))).otherwise(s["other"]).alias("other"),
        ).cast(kind)

    return F.aggregate(tokens, start.cast(kind), step)


def chosen_expression(v: Column, parts_: Column) -> Column:
    """Transcript with coding change, else genomic, coding, protein change, else the text."""
    full = F.when(none_if_empty(parts_["transcript"]).isNotNull() & none_if_empty(parts_["cdna"]).isNotNull(), F.concat(parts_["transcript"], F.lit(":"), parts_["cdna"]))
    return F.coalesce(full, none_if_empty(parts_["genomic"]), none_if_empty(parts_["cdna"]), none_if_empty(parts_["protein"]), v)


def pmid(c: Column) -> Column:
    """``PMID:`` and the digits a link ends with."""
    digits = F.regexp_extract(F.regexp_replace(c, r"^/+|/+$", ""), r"(?U)(\d+)$", 1)
    return F.when(c.startswith("http"), bound(digits, lambda x: F.when(x != "", F.concat(F.lit("PMID:"), x))))


def is_finding(phrase: Column) -> Column:
    """Whether a phrase may name a finding."""
    return (F.char_length(phrase) > 3) & ~phrase.isin(*NO_FINDING)


def sentinel_or(c: Column) -> Column:
    return F.coalesce(c, F.lit(SENTINEL))
