"""Variant expressions by the HGVS grammar, as column expressions.

``parts`` takes an expression apart: reference, kind of sequence, first and last
position with offsets, edit and what it puts in; null where the text is none.
``normal`` writes protein changes with three letters for each residue and ``Ter`` for
a stop; every other expression, and every text that is none, stays as it is, since no
more can be said without the reference's sequence.

Recognised: references with versions (transcripts, genomes, proteins, stable ids, loci)
and a gene in brackets after one; positions counted from the start, before it (-) or
after the stop (*), with intron offsets, ranges, and unknown ones (?); substitutions,
del, dup, ins, delins, inv, repeats and no change for c, g, n, m and r; for p
substitutions, stop, del, dup, ins, delins, frame shifts, extensions, no change,
unknown and no protein, predicted ones in brackets.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One-letter and three-letter amino acids.
AMINO = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe", "G": "Gly", "H": "His", "I": "Ile", "K": "Lys", "L": "Leu",
    "M": "Met", "N": "Asn", "P": "Pro", "Q": "Gln", "R": "Arg", "S": "Ser", "T": "Thr", "V": "Val", "W": "Trp", "Y": "Tyr", "*": "Ter",
}
REFERENCE = r"(?:[A-Z]{2}_\d+(?:\.\d+)?|ENS[A-Z]*[TGP]\d{11}(?:\.\d+)?|LRG_\d+(?:[tp]\d+)?)"
GENE = r"(?:\([A-Z][A-Za-z0-9-]*\))?"
_PLACE = r"(?:[-*]?\d+(?:[-+](?:\d+|\?))?|\?)"
#: First and last position, which may be uncertain themselves: (1_2)_(3_4).
_AT = rf"(\({_PLACE}_{_PLACE}\)|{_PLACE})(?:_(\({_PLACE}_{_PLACE}\)|{_PLACE}))?"


def _edits(bases: str) -> str:
    many = rf"(?:{bases}+|\d+)"
    return rf"({bases}+>{bases}+|del{many}?ins{many}|del{many}?|dup{many}?|ins{many}|inv{many}?|{bases}+\[\d+\]|\[\d+\]|{bases}*=)"


_ONE = "[ACDEFGHIKLMNPQRSTVWY*]"
_THREE = "(?:" + "|".join(AMINO.values()) + r"|Xaa|Sec|\*)"
NUCLEIC = rf"^({REFERENCE})({GENE}):([cgnmr])\.\(?{_AT}(?:{_edits('[ACGTUNacgtun]')})\)?$"


def _protein(residue: str, stop: str) -> str:
    """The pattern of protein changes in one spelling of residues and stops."""
    at = rf"({residue}\d+)(?:_({residue}\d+))?"
    edit = rf"({residue}?fs(?:{stop}(?:\d+|\?))?|ext(?:{stop}|-)(?:\d+|\?)|{residue}ext{stop}(?:\d+|\?)|delins{residue}+|del|dup|ins(?:{residue}+|\d+)|{residue}|=|\?)"
    return rf"^({REFERENCE})({GENE}):(p)\.\(?{at}{edit}\)?$"


PROTEIN = _protein(_THREE, r"(?:Ter|\*)")
SHORT = _protein(_ONE, r"[*X]")
#: No protein, no change, or unknown, of the protein as a whole.
WHOLE = rf"^({REFERENCE})({GENE}):(p)\.(\(?[?=0]\)?)$"


def is_expression(e: Column) -> Column:
    """Whether a text is an expression; null where it is null."""
    return e.rlike(NUCLEIC) | e.rlike(PROTEIN) | e.rlike(SHORT) | e.rlike(WHOLE)


def parts(e: Column) -> Column:
    """struct(reference, gene, kind, first, last, edit) of an expression, else null; absent members are null."""
    take = lambda pattern, k: F.nullif(F.regexp_extract(e, pattern, k), F.lit(""))

    def made(pattern: str) -> Column:
        return F.struct(
            take(pattern, 1).alias("reference"), F.regexp_replace(take(pattern, 2), r"[()]", "").alias("gene"), take(pattern, 3).alias("kind"),
            take(pattern, 4).alias("first"), take(pattern, 5).alias("last"), take(pattern, 6).alias("edit"),
        )

    none = F.lit(None).cast("string")
    whole = F.struct(take(WHOLE, 1).alias("reference"), F.regexp_replace(take(WHOLE, 2), r"[()]", "").alias("gene"), take(WHOLE, 3).alias("kind"), none.alias("first"), none.alias("last"), F.regexp_replace(take(WHOLE, 4), r"[()]", "").alias("edit"))
    return F.when(e.rlike(NUCLEIC), made(NUCLEIC)).when(e.rlike(PROTEIN), made(PROTEIN)).when(e.rlike(SHORT), made(SHORT)).when(e.rlike(WHOLE), whole)


def normal(e: Column) -> Column:
    """Protein changes with three letters; anything else as it is."""
    names = F.create_map(*[F.lit(x) for kv in AMINO.items() for x in kv])
    # words of the grammar are lower-case, so what is upper-case after "p." is a residue; fsX is an old way to write a stop
    change = F.regexp_replace(F.regexp_extract(e, r":p\.(.*)$", 1), "fsX", "fs*")
    spelt = F.array_join(F.transform(F.split(change, ""), lambda c: F.coalesce(F.try_element_at(names, c), c)), "")
    long = F.concat(F.regexp_extract(e, r"^(.*:p\.)", 1), F.regexp_replace(change, r"\*", "Ter"))
    return F.when(~F.contains(e, F.lit(":p.")), e).when(e.rlike(SHORT), F.concat(F.regexp_extract(e, r"^(.*:p\.)", 1), spelt)).when(e.rlike(PROTEIN), long).otherwise(e)
