"""Semantic similarity of term sets over an ontology, ranks and their measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.operators import ranking
from caseloom.sources.shared import written

METHODS = ("resnik", "lin", "jc", "rel")


def closure(edges: DataFrame, most: int = 64) -> DataFrame:
    """term and ancestor, each term being its own ancestor; paths double in each round.

    ``edges`` has child and parent.  A round joins pairs whose path has just the length
    reached so far (``far``) with all pairs no longer than that, so a pair is made from
    one middle and the keys are middles at one distance: the root, which is an ancestor
    of every term, is no key that gathers them.  A round that finds nothing new ends it,
    so there are about log2(depth) rounds; each is written to the shared folder once,
    which cuts the lineage and gives its size.
    """
    nodes = edges.select(F.col("child").alias("term")).union(edges.select("parent")).distinct()
    far = written(edges.select(F.col("child").alias("term"), F.col("parent").alias("ancestor")).distinct(), "far")
    known = written(nodes.select("term", F.col("term").alias("ancestor")).union(far).distinct(), "closure")
    size = known.count()
    for _ in range(most):
        through = far.select("term", F.col("ancestor").alias("middle"))
        beyond = known.where("term <> ancestor").select(F.col("term").alias("middle"), "ancestor")
        known = written(known.union(through.join(beyond, "middle").select("term", "ancestor")).distinct(), "closure")
        new = known.count()
        if new == size:
            break
        size = new
        far = written(through.join(far.select(F.col("term").alias("middle"), "ancestor"), "middle").select("term", "ancestor").distinct(), "far")
    return known


def information_content(closed: DataFrame, annotations: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """term and ic = -ln(share of annotated items that have the term or a descendant).

    With ``numbers`` (``ranking.numbers_of``) the annotations are distinct rows without nulls.

    Each item's ancestors are united in its own row, as a set no larger than the
    ontology, of numbers in place of names; what goes on are counts by term, added up in
    each task before the shuffle, so terms near the root cost a row for each task and
    not for each item.
    """
    items = annotations
    if numbers is None:
        numbers, items = ranking.numbers_of(annotations, closed), written(annotations.select("item", "term").dropna().distinct(), "items")
    up = closed.join(numbers.select(F.col("term").alias("ancestor"), "number"), "ancestor").groupBy("term").agg(F.collect_list("number").alias("up"))
    reached = items.join(up, "term").groupBy("item").agg(F.array_distinct(F.flatten(F.collect_list("up"))).alias("up"))
    total = items.select("item").distinct().agg(F.count("*").alias("n"))
    with_term = reached.select(F.explode("up").alias("number")).groupBy("number").agg(F.count("*").alias("c")).join(numbers, "number")
    return with_term.crossJoin(F.broadcast(total)).select("term", (-F.log(F.col("c") / F.col("n"))).alias("ic"))  # total is one row


def pair_similarity(a_terms: DataFrame, b_terms: DataFrame, closed: DataFrame, ic: DataFrame, method: str = "resnik") -> DataFrame:
    """a, b and sim of term pairs with an informative common ancestor; all other pairs are 0.

    Pairs meet through ancestors with some information, the most informative one
    counts; the root, which all pairs share, has none.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    up = closed.join(ic.where("ic > 0").select(F.col("term").alias("ancestor"), "ic"), "ancestor")
    a = a_terms.select(F.col("term").alias("a")).distinct().join(up.withColumnRenamed("term", "a"), "a")
    b = b_terms.select(F.col("term").alias("b")).distinct().join(up.select(F.col("term").alias("b"), "ancestor"), "b")
    best = a.join(b, "ancestor").groupBy("a", "b").agg(F.max("ic").alias("m"))
    if method == "resnik":
        return best.select("a", "b", F.col("m").alias("sim"))
    of = lambda n: ic.select(F.col("term").alias(n), F.col("ic").alias(f"ic_{n}"))
    # a term that no item has carries no information of its own
    both = best.join(of("a"), "a", "left").join(of("b"), "b", "left").na.fill(0.0, ["ic_a", "ic_b"])
    total = F.col("ic_a") + F.col("ic_b")
    lin = 2 * F.col("m") / F.nullif(total, F.lit(0.0))
    sim = {"lin": lin, "jc": 1 / (1 + F.greatest(total - 2 * F.col("m"), F.lit(0.0))), "rel": lin * (1 - F.exp(-F.col("m")))}[method]
    return both.select("a", "b", F.coalesce(sim, F.lit(0.0)).alias("sim"))


def set_similarity(patients: DataFrame, profiles: DataFrame, pairs: DataFrame) -> DataFrame:
    """id, entity_id and score of every patient with every entity: mean of the two best-match averages.

    ``patients`` (id, term) and ``profiles`` (entity_id, term).  Only pairs of terms
    with some similarity are joined; sets without any score 0.  The best match of a
    patient's term in an entity does not depend on the patient, nor that of an
    entity's term in a patient on the entity, so each is found once before they meet.
    """
    p, e = patients.select("id", "term").distinct(), profiles.select("entity_id", "term").distinct()
    np_, ne = p.groupBy("id").agg(F.count("*").alias("np")), e.groupBy("entity_id").agg(F.count("*").alias("ne"))
    in_entity = pairs.join(e.withColumnRenamed("term", "b"), "b").groupBy("a", "entity_id").agg(F.max("sim").alias("m"))
    rows = p.withColumnRenamed("term", "a").join(in_entity, "a").groupBy("id", "entity_id").agg(F.sum("m").alias("rs"))
    in_patient = p.withColumnRenamed("term", "a").join(pairs, "a").groupBy("id", "b").agg(F.max("sim").alias("m"))
    cols = in_patient.join(e.withColumnRenamed("term", "b"), "b").groupBy("id", "entity_id").agg(F.sum("m").alias("cs"))
    both = rows.join(cols, ["id", "entity_id"])
    every = np_.crossJoin(F.broadcast(ne) if ne.count() <= 200_000 else ne)  # the result itself has every pair
    found = every.join(both, ["id", "entity_id"], "left")
    score = (F.coalesce("rs", F.lit(0.0)) / F.col("np") + F.coalesce("cs", F.lit(0.0)) / F.col("ne")) / 2
    return found.select("id", "entity_id", score.alias("score"))


def ranked(scores: DataFrame) -> DataFrame:
    """Adds rank by falling score; equal scores in order of entity_id."""
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "entity_id")))


def evaluate(scores: DataFrame, truth: DataFrame) -> DataFrame:
    """id, ground_truth_gene, rank, score and roc_auc of the true entity of each patient.

    The area is (negatives below + half of those equal) / negatives; null without
    a negative.
    """
    true = truth.select("id", F.col("entity_id").alias("ground_truth_gene"))
    own = scores.join(true, "id").where(F.col("entity_id") == F.col("ground_truth_gene")).select("id", "ground_truth_gene", F.col("score").alias("s"))
    joined = scores.join(own, "id")
    negative = F.col("entity_id") != F.col("ground_truth_gene")
    before = (F.col("score") > F.col("s")) | ((F.col("score") == F.col("s")) & (F.col("entity_id") < F.col("ground_truth_gene")))
    n = F.count_if(negative)
    area = (F.count_if(negative & (F.col("score") < F.col("s"))) + 0.5 * F.count_if(negative & (F.col("score") == F.col("s")))) / F.nullif(n, F.lit(0))
    return joined.groupBy("id", "ground_truth_gene").agg((1 + F.count_if(negative & before)).cast("int").alias("rank"), F.max("s").alias("score"), area.alias("roc_auc"))


def unknown_terms(patients: DataFrame, closed: DataFrame) -> DataFrame:
    """id and term of patients' terms that the ontology does not have: they match nothing."""
    return patients.select("id", "term").dropna(subset=["term"]).distinct().join(closed.select("term").distinct(), "term", "left_anti").select("id", "term")


def _informed(profiles: DataFrame, closed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The profiles' distinct rows, written once, the numbers of all terms, and the terms' information."""
    own = written(ranking.rows_of(profiles, False), "entities")
    numbers = ranking.numbers_of(own, closed)
    return own, numbers, information_content(closed, own.withColumnRenamed("entity_id", "item"), numbers)


def evaluated(patients: DataFrame, truth: DataFrame, profiles: DataFrame, closed: DataFrame, method: str = "resnik") -> DataFrame:
    """``evaluate`` of every patient against all entities, with information from the profiles.

    Where a task may hold the ontology no pair becomes a row (``ranking``); a larger
    one goes through the joins of ``pair_similarity`` and ``set_similarity``.
    """
    profiles, numbers, ic = _informed(profiles, closed)
    if ranking.fits(closed):
        return ranking.standings(patients, truth, profiles, closed, ic, method, numbers=numbers)
    scores = set_similarity(patients, profiles, pair_similarity(patients, profiles, closed, ic, method))
    return evaluate(scores.withColumn("score", F.round("score", ranking.DIGITS)), truth)


def entity_totals(patients: DataFrame, profiles: DataFrame, closed: DataFrame, method: str = "resnik") -> DataFrame:
    """entity_id, total and best: sum and maximum of each entity's scores over all patients."""
    profiles, numbers, ic = _informed(profiles, closed)
    if ranking.fits(closed):
        return ranking.totals(patients, profiles, closed, ic, method, numbers=numbers)
    scores = set_similarity(patients, profiles, pair_similarity(patients, profiles, closed, ic, method)).withColumn("score", F.round("score", ranking.DIGITS))
    return scores.groupBy("entity_id").agg(F.sum("score").alias("total"), F.max("score").alias("best"))


def metrics(results: DataFrame) -> DataFrame:
    """One row: cases, hits at 1, 10 and 100, mean area (nulls left out) and median rank."""
    hits = lambda k: F.round(F.avg((F.col("rank") <= k).cast("double")), 4).alias(f"hits_at_{k}")
    area = F.when(~F.isnan("roc_auc"), F.col("roc_auc"))
    return results.agg(F.count("*").alias("total_cases_evaluated"), hits(1), hits(10), hits(100), F.round(F.avg(area), 4).alias("mean_roc_auc"), F.median("rank").alias("median_rank"))


def truth_of(packets: DataFrame, transcripts: DataFrame) -> DataFrame:
    """id, n_terms (repeats count) and entity_id: the first variant's gene, else its transcript's."""
    first = F.get(F.get("interpretations", F.lit(0))["diagnosis"]["genomicInterpretations"], F.lit(0))["variantInterpretation"]["variationDescriptor"]
    value = F.get(first["expressions"], F.lit(0))["value"]
    accession = F.regexp_extract(value, r"^([A-Z]{2}_\d+(?:\.\d+)?):", 1)
    p = packets.select("id", F.size("phenotypicFeatures").alias("n_terms"), first["geneContext"]["symbol"].alias("symbol"), accession.alias("accession"))
    return p.join(transcripts, "accession", "left").select("id", "n_terms", F.coalesce("symbol", "gene").alias("entity_id"))


def skip_reason(truth: DataFrame, profiles: DataFrame) -> DataFrame:
    """Adds why a patient is not evaluated, or null."""
    known = profiles.select("entity_id").distinct().withColumn("known", F.lit(True))
    reason = (
        F.when(F.coalesce("n_terms", F.lit(0)) <= 0, "no features").when(F.col("entity_id").isNull(), "no gene")
        .when(F.col("entity_id") == "", "empty gene").when(F.col("known").isNull(), "gene not in profiles")
    )
    return truth.join(known, "entity_id", "left").withColumn("skip_reason", reason).drop("known")
