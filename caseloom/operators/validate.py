"""Rules for raw JSON documents; findings in a fixed order.

A document is parsed once, to a variant, which keeps each member's type: the text
"0" is there, the number 0 is empty, as null, false, "" and empty lists and objects
are.  An object's members are a map of variants, so an absent member is told from a
null one.  A member that should be an object or a list and is not has no members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Allowed values; the wording of the messages below is fixed as well.
SEXES = ("UNKNOWN_SEX", "FEMALE", "MALE", "OTHER_SEX")
PROGRESS = ("UNKNOWN_PROGRESS", "IN_PROGRESS", "COMPLETED", "SOLVED", "UNSOLVED")
FINDING = "array<struct<field:string,message:string,severity:string>>"


def _none() -> Column:
    return F.array().cast(FINDING)


def _finding(field: Column | str, message: Column, severity: str = "ERROR") -> Column:
    return F.array(F.struct((F.lit(field) if isinstance(field, str) else field).alias("field"), message.alias("message"), F.lit(severity).alias("severity")))


def _members(value: Column) -> Column:
    """The members of a variant that is an object; null for anything else."""
    return value.try_cast("map<string,variant>")


def _has(members: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(members, key), F.lit(False))


#: JSON texts of values that count as empty: null, false, "", lists and objects without members, and zeros.
EMPTY = r'^(?:null|false|""|\[\]|\{\}|-?0(?:\.0*)?(?:[eE][+-]?\d+)?)$'


def _empty(members: Column, key: str, inner: Column | None = None) -> Column:
    """Absent, null, or an empty value of its type; ``inner`` (its members or elements, null for anything else) spares its JSON text."""
    told = F.coalesce(F.to_json(members[key]).rlike(EMPTY), F.lit(True))
    return ~_has(members, key) | (told if inner is None else F.when(inner.isNotNull(), F.size(inner) == 0).otherwise(told))


def _is_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def shown(value: Column) -> Column:
    """A value as messages name it: texts as they are, null, true and false by name, anything else as JSON."""
    text = F.to_json(value)
    return F.when(value.isNull() | (text == "null"), "None").when(_is_text(value), value.try_cast("string")).when(text == "true", "True").when(text == "false", "False").otherwise(text)


def _one_of(value: Column, allowed: tuple[str, ...]) -> Column:
    """Whether a value is a text among these."""
    return _is_text(value) & F.coalesce(value.try_cast("string").isin(*allowed), F.lit(False))


def _required(members: Column, key: str, context: Column, inner: Column | None = None) -> Column:
    text = F.concat(F.lit("["), context, F.lit(f"] Required field '{key}' is missing or empty"))
    return F.when(_empty(members, key, inner), _finding(key, text)).otherwise(_none())


def _items(value: Column) -> Column:
    """The elements of a variant that is a list; none for anything else."""
    return F.coalesce(value.try_cast("array<variant>"), F.array().cast("array<variant>"))


def _each(items: Column, rule) -> Column:
    return F.flatten(F.transform(items, rule))


def parsed(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Adds the members that rules look at, each level taken apart once."""
    top = docs.withColumn("_doc", F.try_parse_json(doc)).withColumn("_top", _members(F.col("_doc")))
    member = lambda key: F.col("_top")[key]
    maps = lambda key: F.transform(_items(member(key)), _members)
    feature = lambda m: F.struct(_has(m, "type").alias("typed"), _members(m["type"]).alias("kind"))
    genomic = lambda m: F.transform(_items(_members(m["diagnosis"])["genomicInterpretations"]), _members)
    return top.withColumns(
        {
            "_subject": _members(member("subject")), "_meta": _members(member("metaData")), "_features": F.transform(maps("phenotypicFeatures"), feature),
            "_interpretations": F.transform(maps("interpretations"), lambda m: F.struct(m.alias("own"), genomic(m).alias("genomic"))),
            "_diseases": F.transform(maps("diseases"), lambda m: _has(m, "term")),
        }
    )


_PARSED = ("_top", "_subject", "_meta", "_features", "_interpretations", "_diseases", "_doc")


def findings(name: Column) -> Column:
    """All findings of one document of ``parsed``, errors and warnings."""
    top, subject, meta = (F.col(c) for c in _PARSED[:3])
    at = lambda i, key: F.concat(F.lit(f"{key}["), i.cast("string"), F.lit("]"))
    says = lambda *xs: F.concat(F.lit("["), name, F.lit("] "), *[F.lit(x) if isinstance(x, str) else x for x in xs])
    sex = subject["sex"]
    for_subject = F.concat(
        _required(subject, "id", F.concat(name, F.lit(".subject"))),
        F.when(_has(subject, "sex") & ~_one_of(sex, SEXES), _finding("subject.sex", says("Invalid sex value: ", shown(sex), ". Must be one of ", str(list(SEXES))))).otherwise(_none()),
    )

    def feature(f: Column, i: Column) -> Column:
        kind = f["kind"]
        id_ = kind["id"]
        no_text = _has(kind, "id") & ~_is_text(id_)
        other = _has(kind, "id") & _is_text(id_) & ~F.coalesce(id_.try_cast("string").startswith("HP:"), F.lit(False))
        in_type = F.concat(
            F.when(~_has(kind, "id"), _finding(F.concat(at(i, "phenotypicFeatures"), F.lit(".type")), says("Feature type missing required 'id' field"))).otherwise(_none()),
            F.when(no_text, _finding(F.concat(at(i, "phenotypicFeatures"), F.lit(".type.id")), says("ID ", shown(id_), " is not a text"))).otherwise(_none()),
            F.when(other, _finding(F.concat(at(i, "phenotypicFeatures"), F.lit(".type.id")), says("ID ", shown(id_), " doesn't appear to be an HPO term"), "WARNING")).otherwise(_none()),
        )
        return F.when(~f["typed"], _finding(at(i, "phenotypicFeatures"), says("Feature missing required 'type' field"))).otherwise(in_type)

    def genomic(context: Column):
        def one(g: Column, i: Column) -> Column:
            inside = F.concat(context, F.lit("."), at(i, "genomicInterpretations"))
            return F.concat(_required(g, "subjectOrBiosampleId", inside), _required(g, "interpretationStatus", inside))

        return one

    def interpretation(x: Column, i: Column) -> Column:
        inside = F.concat(name, F.lit("."), at(i, "interpretations"))
        status = x["own"]["progressStatus"]
        bad = _has(x["own"], "progressStatus") & ~_one_of(status, PROGRESS)
        return F.concat(
            _required(x["own"], "id", inside),
            F.when(bad, _finding(F.concat(at(i, "interpretations"), F.lit(".progressStatus")), says("Invalid progressStatus: ", shown(status)))).otherwise(_none()),
            _each(x["genomic"], genomic(F.concat(inside, F.lit(".diagnosis")))),
        )

    disease = lambda has, i: F.when(~has, _finding(at(i, "diseases"), says("Disease missing required 'term' field"))).otherwise(_none())
    inside = F.concat(name, F.lit(".metaData"))
    for_meta = F.concat(
        _required(meta, "created", inside), _required(meta, "phenopacketSchemaVersion", inside),
        F.when(_empty(meta, "resources", meta["resources"].try_cast("array<variant>")), _finding("metaData.resources", says("Resources field is recommended"), "WARNING")).otherwise(_none()),
    )
    return F.concat(
        _required(top, "id", name), _required(top, "metaData", name, meta),
        F.when(_has(top, "subject"), for_subject).otherwise(_finding("subject", says("Subject is recommended but missing"), "WARNING")),
        _each(F.col("_features"), feature), _each(F.col("_interpretations"), interpretation), _each(F.col("_diseases"), disease),
        F.when(_has(top, "metaData"), for_meta).otherwise(_none()),
    )


def validate(docs: DataFrame, doc: str = "doc", number: str | None = None) -> DataFrame:
    """Adds name, findings (in their order), errors, warnings and valid.

    A document is named by its id; without one, or where it is null, by its number.
    """
    numbered = F.concat(F.lit("phenopacket_"), (F.col(number) + 1).cast("string")) if number else F.lit("")
    id_ = F.col("_top")["id"]
    name = F.when(id_.isNull() | (F.to_json(id_) == "null"), numbered).otherwise(shown(id_))
    named = parsed(docs, doc).withColumn("name", name)
    out = named.withColumn("findings", F.when(F.col("_doc").isNull(), _finding("", F.lit("Invalid JSON"))).otherwise(findings(F.col("name"))))
    of = lambda s: F.filter("findings", lambda x: x["severity"] == s)
    return out.withColumns({"errors": of("ERROR"), "warnings": of("WARNING")}).withColumn("valid", F.size("errors") == 0).drop(*_PARSED)


def totals(validated: DataFrame) -> DataFrame:
    n, ok = F.count("*"), F.count_if(F.col("valid"))
    return validated.agg(
        n.alias("total"), ok.alias("valid"), (n - ok).alias("with_errors"), F.coalesce(F.sum(F.size("errors")), F.lit(0)).cast("long").alias("errors"),
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).cast("long").alias("warnings"), F.round(100 * ok / F.nullif(n, F.lit(0)), 1).alias("valid_pct"),
        F.coalesce(F.bool_and("valid"), F.lit(True)).alias("file_valid"),
    )


def accepted(validated: DataFrame, has_disease: Column, good: bool = True) -> DataFrame:
    """Documents without errors, or those with some; errors that ask for a disease do not count where there is none."""
    left = F.when(has_disease, F.col("errors")).otherwise(F.filter("errors", lambda e: ~F.contains(e["message"], F.lit("disease annotation"))))
    return validated.where((F.size(left) == 0) == good)
