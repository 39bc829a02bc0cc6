"""Quality classifier: document evidence combined with host and path posteriors, hierarchical empirical Bayes.

Three levels. The document's own evidence is the log-odds of two logistic models: one over hashed words and word
pairs of the whole text, and one over its log-odds and the shape of the text, each fitted on its own half of the
labels, so that the second sees how far the first can be trusted. Its site gives a prior: how often the *other* documents of that host, and of
that section (path) of the host, are good. Sites are judged by the classifier's evidence for all their documents,
labelled or not: each counts with its probability. Sparse sites are shrunk: a host's rate is a Beta posterior
around the global rate, a section's rate a Beta posterior around its host's, with strengths estimated from the
spread of the rates one level up (method of moments). The posterior log-odds of a document is its evidence plus
the log-odds of its section's rate, where the document itself is taken out of all three levels, so that nothing
counts twice.

Everything about sites is grouped aggregation: per document one narrow row, per section and host one row of
sums. Documents meet their section in `lookup_join`, which answers hot sections from a bounded broadcast. Only a
handful of global numbers and the coefficients reach the driver. The models are fitted by Spark on the texts of all
labelled ids, which are kept as vectors.

Defined results
---------------
* A null or empty text has no words and zero shape; its site's prior and the evidence of an empty text decide.
* A null host or path is a site like any other. A label of null is no label; an id labelled twice counts once,
  with its larger label; of several texts of a labelled id the one with the smallest hash is learnt from. Where a
  half of the labels has one kind only, both models are fitted on all of them. Labels are 0 and 1.
* Without labels of both kinds the evidence is 0 and every document is as good as the global rate says: 1/2.
* Repeated rows are judged alike and each counts for its site. A site's only document has its host's rate, a
  host's only document the global one. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.quality_rules import bind, words
from gleanwork.llm.url_filter import MAX_KEYS, Level
from gleanwork.operators.lookup import lookup_join
from gleanwork.session import setting, staged

SHAPE = ("symbols", "capitals", "bars", "twins", "shouts", "stops", "length")
WIDTH = 1 << 13  # places for hashed words, and as many for pairs
TERM_RIDGE, RIDGE, ROUNDS = 0.1, 1e-3, 25
VECTORS_AT_ONCE = "64"  # a reader's batch of the usual 4,096 would be arrays of many MB beside the rows a fit holds
KEEP_ABOVE = 0.5
# Bounds of the shrinking strengths, in documents.
WEAKEST, STRONGEST = 2.0, 10_000.0
MOST = 30.0  # log-odds beyond are cut


class Evidence(NamedTuple):
    """A fitted model, None without labels of both kinds, and the log-odds of the share it was fitted on."""

    model: PipelineModel | None
    base: float


def shape(text: Column, tokens: Column) -> dict[str, Column]:
    """Shares of symbols, capitals and bars, repetition, length, sentence marks; `tokens` are the words of the text."""
    body = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(body), F.lit(1))
    n_words = F.size(tokens)
    n = F.greatest(n_words, F.lit(1))

    def marks(mark: str) -> Column:
        return F.length(body) - F.length(F.replace(body, F.lit(mark), F.lit("")))

    return {
        "symbols": F.regexp_count(body, F.lit("[#*$%&<>]")) / chars,
        "capitals": F.regexp_count(body, F.lit(r"\p{Lu}")) / chars,
        "bars": marks("|") / n,
        "twins": bind(tokens, lambda t: F.size(F.filter(t, lambda w, i: w == F.get(t, i + 1)))) / n,
        "shouts": marks("!") / n,
        "stops": marks(".") / n,
        "length": F.log1p(n_words) / 10.0,
    }


def _prepared(rows: DataFrame) -> DataFrame:
    """`rows` (with `text`) with words, pairs and shape in the columns the model reads."""
    made = shape(F.col("text"), F.col("words"))
    pairs = bind(F.col("words"), lambda t: F.transform(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda w, i: F.concat(F.get(t, i), F.lit(" "), w)))
    split = rows.withColumn("words", words(F.col("text")))
    return split.select(*[c for c in rows.columns if c != "text"], "words", pairs.alias("pairs"), *[c.alias(n) for n, c in made.items()])


def _stages() -> list:
    terms = []
    for name in ("words", "pairs"):
        terms.append(HashingTF(numFeatures=WIDTH, inputCol=name, outputCol=f"{name}_counts"))
        terms.append(Normalizer(inputCol=f"{name}_counts", outputCol=f"{name}_shares"))
    return [*terms, VectorAssembler(inputCols=["words_shares", "pairs_shares"], outputCol="terms")]


def _met(docs: DataFrame, known: DataFrame) -> DataFrame:
    """`docs` (id, text) that `known` (id, label) labels. A Bloom filter of its ids spares most other texts the shuffle."""
    n_known = known.count()
    if n_known <= MAX_KEYS and docs.schema["id"].dataType == known.schema["id"].dataType:
        docs = docs.where(Level(known.select(F.col("id").alias("key")), n_known, 0).holds(F.col("id")))
    return docs.join(known, "id")


def fit_evidence(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Evidence:
    """The model of all labelled documents; `labels` has `key` and a 0/1 column `label`."""
    known = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label")).where("label is not null and id is not null")
    known = staged(known.groupBy("id").agg(F.max("label").alias("label")), "known")
    met = _met(docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")), known)
    learnable = met.groupBy("id").agg(F.max("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    steps = _stages()
    rows = PipelineModel(steps).transform(_prepared(learnable)).withColumn("half", F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)))
    rows = staged(rows.select("label", "half", "terms", *SHAPE), "vectors")
    if rows.select("label").distinct().count() < 2:
        return Evidence(None, 0.0)
    with setting(docs.sparkSession, "spark.sql.parquet.columnarReaderBatchSize", VECTORS_AT_ONCE):
        return _fitted(rows, steps)


def _fitted(rows: DataFrame, steps: list) -> Evidence:
    """Both models fitted on `rows` (label, half, terms, shape)."""
    halves = [rows.where(F.col("half") == h) for h in (0, 1)]
    if any(h.select("label").distinct().count() < 2 for h in halves):
        halves = [rows, rows]
    term_model = LogisticRegression(
        regParam=TERM_RIDGE, maxIter=ROUNDS, featuresCol="terms", labelCol="label", rawPredictionCol="term_odds",
        probabilityCol="term_chance", predictionCol="term_says").fit(halves[0])
    whole = VectorAssembler(inputCols=[*SHAPE, "term_odds"], outputCol="features")
    learnt = whole.transform(term_model.transform(halves[1]))
    fitted = LogisticRegression(regParam=RIDGE, maxIter=ROUNDS, featuresCol="features", labelCol="label").fit(learnt)
    seen = learnt.agg(F.avg("label")).first()[0]
    return Evidence(PipelineModel([*steps, term_model, whole, fitted]), math.log(seen / (1 - seen)))


def with_evidence(rows: DataFrame, evidence: Evidence) -> DataFrame:
    """`rows` (with `text`) with `evidence` in place of the text: log-odds beyond those of the share fitted on."""
    if evidence.model is None:
        return rows.withColumn("evidence", F.lit(0.0)).drop("text")
    odds = vector_to_array("rawPrediction")[1] - F.lit(evidence.base)
    judged = evidence.model.transform(_prepared(rows))
    return judged.select(*[c for c in rows.columns if c != "text"], odds.alias("evidence"))


def _strength(rates: DataFrame, prior: Column) -> float:
    """Size of the Beta prior that explains the spread of `rate` (from n documents each) around `prior`.

    By moments: the squared deviation of a group's rate is v * (1 / n + (1 - 1 / n) / (strength + 1)), with
    v = prior * (1 - prior), pooled over all groups by their size.
    """
    v = prior * (1 - prior)
    row = rates.where((F.col("n") > 1) & (v > 0)).agg(
        F.sum(F.col("n") * (F.col("rate") - prior) * (F.col("rate") - prior)).alias("seen"),
        F.sum(v).alias("by_chance"), F.sum((F.col("n") - 1) * v).alias("room"),
    ).first()
    if not row["room"]:
        return STRONGEST
    share = (row["seen"] - row["by_chance"]) / row["room"]
    return float(min(max(1 / share - 1, WEAKEST), STRONGEST)) if share > 0 else STRONGEST


def _chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(MOST)), F.lit(-MOST))))


def judge_sites(rows: DataFrame, base: float = 0.0, keep_above: float = KEEP_ABOVE) -> DataFrame:
    """(id, evidence, host_rate, path_rate, posterior, kept) of `rows` (id, host, path, evidence).

    The rates are those of the other documents; `base` is the log-odds of a good document at evidence 0.
    """
    keyed = rows.select(
        "id", "evidence", _chance(F.col("evidence") + base).alias("good"),
        # JSON tells null from any text, so that a null site is a key like others.
        F.to_json(F.struct("host"), {"ignoreNullFields": "false"}).alias("host"),
        F.to_json(F.struct("host", "path"), {"ignoreNullFields": "false"}).alias("site"))
    scored = staged(keyed, "scored")
    sections = staged(scored.groupBy("site").agg(F.min("host").alias("host"), F.count("*").alias("n"), F.sum("good").alias("sum")), "sections")
    per_host = staged(sections.groupBy("host").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")), "hosts")
    whole = per_host.agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).first()
    total, good = whole["n"] or 0, whole["sum"] or 0.0
    overall = good / total if total else 0.5
    host_strength = _strength(per_host.withColumn("rate", F.col("sum") / F.col("n")), F.lit(overall))
    hosts = per_host.select("host", F.col("n").alias("host_n"), F.col("sum").alias("host_sum"))
    placed = staged(lookup_join(sections, hosts, "host").drop("host"), "placed")
    host_rate = (F.col("host_sum") + host_strength * overall) / (F.col("host_n") + host_strength)
    path_strength = _strength(placed.withColumn("rate", F.col("sum") / F.col("n")), host_rate)
    met = lookup_join(scored.drop("host"), placed, "site")
    others = (F.lit(good) - F.col("good")) / (total - 1) if total > 1 else F.lit(0.5)
    host_rate = (F.col("host_sum") - F.col("good") + host_strength * others) / (F.col("host_n") - 1 + host_strength)
    path_rate = (F.col("sum") - F.col("good") + path_strength * F.col("host_rate")) / (F.col("n") - 1 + path_strength)
    rated = met.withColumn("host_rate", host_rate).withColumn("path_rate", F.greatest(F.least(path_rate, F.lit(1 - 1e-9)), F.lit(1e-9)))
    posterior = _chance(F.col("evidence") + F.log(F.col("path_rate") / (1 - F.col("path_rate"))))
    return rated.select("id", "evidence", "host_rate", "path_rate", posterior.alias("posterior"), (posterior >= keep_above).alias("kept"))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, key: str = "doc_id", text: str = "text",
             label: str = "quality", keep_above: float = KEEP_ABOVE) -> DataFrame:
    """One row per document: `key`, evidence, host_rate, path_rate, posterior, kept.

    `host` and `path` are expressions over `docs`.
    """
    evidence = fit_evidence(docs, labels, key, text, label)
    rows = docs.select(F.col(f"`{key}`").alias("id"), host.alias("host"), path.alias("path"), F.col(f"`{text}`").alias("text"))
    return _named(judge_sites(with_evidence(rows, evidence), evidence.base, keep_above), key)


def classify_other(rows: DataFrame, docs: DataFrame, labels: DataFrame, host: Column, path: Column, key: str, text: str = "text",
                   doc_key: str = "doc_id", doc_text: str = "text", label: str = "quality") -> DataFrame:
    """As `classify`, for `rows` of another table than the labelled `docs` the model is fitted on."""
    evidence = fit_evidence(docs, labels, doc_key, doc_text, label)
    told = rows.select(F.col(f"`{key}`").alias("id"), host.alias("host"), path.alias("path"), F.col(f"`{text}`").alias("text"))
    return _named(judge_sites(with_evidence(told, evidence), evidence.base), key)


def _named(judged: DataFrame, key: str) -> DataFrame:
    """The id under its own name; a judged column of the same name gives way to it."""
    return judged.select(F.col("id").alias(key), *[c for c in judged.columns if c not in ("id", key)])
