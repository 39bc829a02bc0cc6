"""Entity resolution: alias, then equal normal form, then best fuzzy match.

All matching runs on the distinct normal forms of the names; the answers are joined back to the
rows with `lookup_join`, so repeated names cost nothing and a hot name overloads nobody.

Fuzzy candidates come from prefix filtering. A pair (a, b) with ratio 2M/T >= t, T = len(a)+len(b),
matches M >= tT/2 characters in blocks that are separated by unmatched ones, so in at most T-2M+1
blocks, and therefore shares at least

    need(T) = 3 * ceil(tT/2) - T - 1

bigrams, counted with repetition. Sort both bigram lists by one global order, rarest first: two
lists of n and m sharing `need` entries must share `k` of them within the first n-need+k and
m-need+k. Joining on pairs of such rare bigrams (k = 2; single ones, k = 1, for long names) finds
every match, while bigrams half of all names contain never become a join key. Pairs too short for
two shared bigrams are found the same way on single characters, which share at least ceil(tT/2).
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from fractions import Fraction

import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.functions.names import normalize_entity_name
from gleanwork.functions.text import py_strip
from gleanwork.operators.lookup import lookup_join
from gleanwork.session import staged

THRESHOLD = 0.85
# Names up to this length are joined on pairs of bigrams, longer ones on single bigrams.
PAIR_LIMIT = 40
# Result of blank names, the methods, and the aliases known by default
# (normal form -> canonical name).
UNKNOWN = "Unknown"
DEFAULT_ALIASES = {
    "open ai": "OpenAI",
    "openai": "OpenAI",
    "openai inc": "OpenAI",
    "google deepmind": "Google DeepMind",
    "deepmind": "Google DeepMind",
    "meta ai": "Meta AI",
    "anthropic pbc": "Anthropic",
    "anthropic": "Anthropic",
    "mistral ai": "Mistral AI",
    "mistral": "Mistral AI",
}


def default_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DEFAULT_ALIASES.items()), "norm string, canonical string")


def canonical_forms(canonicals: DataFrame) -> DataFrame:
    """(norm, name, pos): per normal form the first canonical name by `pos`."""
    normed = canonicals.withColumn("norm", normalize_entity_name(F.col("name")))
    return normed.groupBy("norm").agg(F.min_by("name", "pos").alias("name"), F.min("pos").alias("pos"))


# -- the parts of the chain --------------------------------------------------------------------


def alias_join(norms: DataFrame, aliases: DataFrame) -> DataFrame:
    """`norms` with the alias target as `alias_name`, or null."""
    known = aliases.groupBy("norm").agg(F.min("canonical").alias("alias_name"))
    return norms.join(known, "norm", "left")


def normalized_join(norms: DataFrame, forms: DataFrame) -> DataFrame:
    """`norms` with the canonical name of equal normal form as `equal_name`, or null."""
    return norms.join(forms.select("norm", F.col("name").alias("equal_name")), "norm", "left")


def _threshold(t: float) -> Fraction:
    """The threshold as the exact decimal it was written as."""
    if not 0 < t <= 1:
        raise ValueError(f"threshold must be in (0, 1], not {t}")
    return Fraction(str(t))


# The next few build SQL text: they nest lambdas over the columns `norm` and `grams`, which reads
# better and is far quicker to set up as text than call by call.


def _least_matched(total: str, t: Fraction) -> str:
    """ceil(t * total / 2) in integers."""
    p, q = t.numerator, 2 * t.denominator
    return f"((CAST({total} AS BIGINT) * {p} + {q - 1}) DIV {q})"


def _shared_bigrams(total: str, t: Fraction) -> str:
    return f"(3 * {_least_matched(total, t)} - {total} - 1)"


def _fewest(t: Fraction, share) -> str:
    """Least of `share(T)` over the partners a name can have: those with
    length * t/(2-t) <= partner <= length * (2-t)/t."""
    p, q = t.numerator, 2 * t.denominator - t.numerator
    length = "CAST(length(norm) AS BIGINT)"
    least, most = f"(({length} * {p} + {q - 1}) DIV {q})", f"(({length} * {q}) DIV {p})"
    totals = f"sequence({length} + {least}, {length} + greatest({least}, {most}))"
    return f"array_min(transform({totals}, total -> {share('total', t)}))"


def _grams(size: int) -> str:
    """Character n-grams with repeat numbers, so that counting them becomes set membership."""
    starts = f"IF(length(norm) >= {size}, sequence(1, length(norm) - {size - 1}), CAST(array() AS ARRAY<INT>))"
    copy = "size(filter(slice(gs, 1, i + 1), x -> x = g))"
    return (
        f"transform(array(transform({starts}, i -> substr(norm, i, {size}))),"
        f" gs -> transform(gs, (g, i) -> struct(g AS gram, {copy} AS copy)))[0]"
    )


def _exploded(rows: DataFrame, t: Fraction) -> DataFrame:
    """(norm, gram, copy): the bigrams of each name, and the characters of short ones, whose matches
    may share fewer than two bigrams."""
    short = f"{_fewest(t, _shared_bigrams)} < 2"
    grams = F.expr(f"IF({short}, concat({_grams(2)}, {_grams(1)}), {_grams(2)})")
    return rows.where("norm <> ''").select("norm", F.explode(grams).alias("g")).select("norm", "g.gram", "g.copy")


def _rare_first(rows: DataFrame, order: DataFrame, t: Fraction) -> DataFrame:
    """(norm, size, grams): hashed grams of each name by gram size, rarest among the canonicals first."""
    ranked = _exploded(rows, t).join(order, ["gram", "copy"], "left")
    entry = F.struct(F.coalesce("n_forms", F.lit(0)).alias("n"), F.xxhash64("gram", "copy").alias("h"))
    lists = ranked.groupBy("norm", F.length("gram").alias("size")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    return lists.select("norm", "size", F.expr("entries.h").alias("grams"))


def _prefix(need: str, k: int) -> str:
    """The rarest entries among which two matching names must share `k`."""
    wanted = f"size(grams) - greatest({need}, {k}) + {k}"
    return f"slice(grams, 1, CAST(greatest(least({wanted}, size(grams)), 0) AS INT))"


def _pairs(grams: str) -> str:
    """All unordered pairs of entries, each as one hash."""
    pair = "xxhash64(least(g, h), greatest(g, h))"
    return (
        f"transform(array({grams}), gs -> flatten(transform(gs, (g, i) ->"
        f" transform(slice(gs, i + 2, size(gs)), h -> {pair}))))[0]"
    )


def _keys(rows: DataFrame, order: DataFrame, t: Fraction) -> DataFrame:
    """(norm, key): every join key of every name."""
    need, none = _fewest(t, _shared_bigrams), "CAST(array() AS ARRAY<BIGINT>)"
    # Partners of a long name may be shorter than the limit; they carry keys of both kinds.
    limit = int(PAIR_LIMIT * t / (2 - t))
    pairs = f"IF(length(norm) <= {PAIR_LIMIT}, {_pairs(_prefix(need, 2))}, {none})"
    single = f"IF(length(norm) > {limit}, transform({_prefix(need, 1)}, g -> xxhash64(g)), {none})"
    characters = _prefix(_fewest(t, _least_matched), 1)
    keys = F.expr(f"IF(size = 2, array_distinct(concat({pairs}, {single})), {characters})")
    return _rare_first(rows, order, t).select("norm", F.explode(keys).alias("key"))


def fuzzy_candidates(norms: DataFrame, forms: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct (norm, form) pairs that may reach the threshold; every pair that does is among them."""
    t = _threshold(threshold)
    left, right = norms.select("norm"), forms.select("norm")
    order = _exploded(right, t).groupBy("gram", "copy").agg(F.count("*").alias("n_forms"))
    theirs = _keys(right, order, t).withColumnRenamed("norm", "form")
    pairs = _keys(left, order, t).join(theirs, "key").select("norm", "form").distinct()
    return pairs.where(_may_reach(t))


def _may_reach(t: Fraction) -> Column:
    """Cheap bounds on the ratio of (norm, form): matched characters fit in the shorter name, and
    the edit distance is at most the number of unmatched characters, T - 2M."""
    total = "(length(norm) + length(form))"
    least = _least_matched(total, t)
    return F.expr(
        f"least(length(norm), length(form)) >= {least} AND levenshtein(norm, form) <= {total} - 2 * {least}"
    )


def best_match(scored: DataFrame) -> DataFrame:
    """Per norm the candidate of highest score; on ties the one that comes first by `pos`."""
    best = F.max_by(
        F.struct("name", "ratio", "rounded"), F.struct("ratio", (-F.col("pos")).alias("earliest"))
    )
    return scored.groupBy("norm").agg(best.alias("best")).select(
        "norm",
        F.col("best.name").alias("fuzzy_name"),
        F.col("best.ratio").alias("score"),
        F.col("best.rounded").alias("score_2"),
    )


def upper_bound() -> Column:
    """No ratio of (norm, form) is higher: the edit distance is at most the number of unmatched characters."""
    total = F.length("norm") + F.length("form")
    return (total - F.levenshtein("norm", "form")) / total


def _bound_ordered(threshold: float):
    """Top-1 search over candidates that come per norm from the highest bound down.

    The best ratio found so far ends a norm's search as soon as no later bound can beat it, so most candidates are
    never compared. Only the norm at hand is remembered, also from one batch to the next.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher, norm, best, compared = SequenceMatcher(None), None, None, 0
        columns = ["norm", "fuzzy_name", "score", "score_2", "n_compared"]

        def answer() -> tuple:
            return (norm, best[2], best[0], round(best[0], 2), compared) if best else (norm, None, None, None, compared)

        for batch in batches:
            done = []
            for a, form, name, pos, bound in zip(*(batch[c] for c in ("norm", "form", "name", "pos", "bound"))):
                if a != norm:
                    if norm is not None:
                        done.append(answer())
                    norm, best, compared = a, None, 0
                if best and (bound, -pos) <= (best[0], best[1]):
                    continue
                compared += 1
                matcher.set_seqs(a, form)
                ratio = matcher.ratio()
                if ratio >= threshold and (best is None or (ratio, -pos) > best[:2]):
                    best = (ratio, -pos, name)
            yield pd.DataFrame(done, columns=columns)
        if norm is not None:
            yield pd.DataFrame([answer()], columns=columns)

    return run


def searched(norms: DataFrame, forms: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(norm, fuzzy_name, score, score_2, n_compared) of every norm with candidates; null names found no match."""
    pairs = fuzzy_candidates(norms, forms, threshold)
    ranked = pairs.join(forms.select(F.col("norm").alias("form"), "name", "pos"), "form").withColumn("bound", upper_bound())
    ordered = ranked.repartition("norm").sortWithinPartitions("norm", F.desc("bound"), "pos")
    return ordered.select("norm", "form", "name", "pos", "bound").mapInPandas(
        _bound_ordered(threshold), "norm string, fuzzy_name string, score double, score_2 double, n_compared bigint")


def fuzzy_join(norms: DataFrame, forms: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(norm, fuzzy_name, score, score_2 = score to two digits) for the norms with a candidate at or above the threshold."""
    return searched(norms, forms, threshold).where(F.col("fuzzy_name").isNotNull()).drop("n_compared")


def canonical_characters(forms: DataFrame) -> DataFrame:
    """One row: the characters that give a ratio above zero against some canonical name.

    In names of 200 characters or more the matcher skips those making up over a percent.
    """
    chars = forms.select("norm", F.explode(F.split("norm", "")).alias("ch")).where("ch <> ''")
    counts = chars.groupBy("norm", "ch").agg(F.count("*").alias("n"))
    size = F.length("norm")
    usable = counts.where((size < 200) | (F.col("n") <= F.floor(size / 100) + 1))
    return usable.select("ch").distinct().agg(F.collect_list("ch").alias("chars"))


# -- the whole chain ---------------------------------------------------------------------------


def resolve_norms(
    norms: DataFrame, canonicals: DataFrame, aliases: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """(norm, resolved_name, method, confidence) for distinct normal forms; null name = keep the raw one."""
    forms = canonical_forms(canonicals)
    known = normalized_join(alias_join(norms.select("norm").distinct(), aliases), forms)
    unresolved = known.where(F.col("alias_name").isNull() & F.col("equal_name").isNull())
    fuzzy = fuzzy_join(unresolved, forms, threshold)
    chars = canonical_characters(forms).scalar()
    touched = F.arrays_overlap(F.split("norm", ""), chars)
    joined = known.join(fuzzy, "norm", "left")
    alias, equal, close = (F.col(c).isNotNull() for c in ("alias_name", "equal_name", "fuzzy_name"))
    return joined.select(
        "norm",
        F.coalesce("alias_name", "equal_name", "fuzzy_name").alias("resolved_name"),
        F.when(alias, "alias").when(equal, "normalized").when(close, "fuzzy").otherwise("unresolved").alias("method"),
        F.when(alias | equal, 1.0)
        .when(close, F.col("score_2"))
        .when(F.coalesce(touched, F.lit(False)), 0.5)
        .otherwise(0.0)
        .alias("match_confidence"),
    )


def resolve_entities(
    names: DataFrame,
    canonicals: DataFrame,
    aliases: DataFrame | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`names` (raw_name, entity_type, source_url, …) with canonical name, method and confidence.

    The answers per distinct name are worked out at once and staged; the join back to the rows is lazy.
    """
    if aliases is None:
        aliases = default_aliases(names.sparkSession)
    raw = py_strip(F.col("raw_name"))
    blank = F.coalesce(raw, F.lit("")) == ""
    keyed = names.withColumns({
        "raw_name": F.when(blank, F.coalesce("raw_name", F.lit(""))).otherwise(raw),
        "norm": F.when(~blank, normalize_entity_name(raw)),
    })
    answers = resolve_norms(
        keyed.where(F.col("norm").isNotNull()).select("norm"), canonicals, aliases, threshold
    )
    joined = lookup_join(keyed, staged(answers, "resolved-names"), "norm")
    named = F.col("norm").isNotNull()
    return joined.select(
        *names.columns,
        F.when(named, F.coalesce("resolved_name", "raw_name")).otherwise(UNKNOWN).alias("canonical_name"),
        F.when(named, F.col("method")).otherwise("unresolved").alias("resolution_method"),
        F.when(named, F.col("match_confidence")).otherwise(0.0).alias("confidence"),
    )


def review_queue(
    names: DataFrame,
    canonicals: DataFrame,
    aliases: DataFrame | None = None,
    threshold: float = THRESHOLD,
    floor: float = 0.7,
) -> DataFrame:
    """Every unresolved normal form, with its best candidate if one scores at least `floor`, else nulls.

    The search runs at `floor`, so a lower floor costs more candidates; at 2/3 and below nearly all pairs
    would meet, which is refused.
    """
    if floor * 3 <= 2:
        raise ValueError("the floor must be above 2/3")
    if aliases is None:
        aliases = default_aliases(names.sparkSession)
    raw = py_strip(F.col("raw_name"))
    norms = names.where(raw != "").select(normalize_entity_name(raw).alias("norm")).distinct()
    forms = canonical_forms(canonicals)
    known = normalized_join(alias_join(norms, aliases), forms)
    unresolved = known.where(F.col("alias_name").isNull() & F.col("equal_name").isNull())
    unresolved = staged(unresolved.select("norm"), "unresolved")
    best = fuzzy_join(unresolved, forms, floor)
    return unresolved.join(best, "norm", "left").where(F.coalesce(F.col("score") < threshold, F.lit(True)))


def resolution_summary(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("resolution_method").agg(
        F.count("*").alias("n_names"), F.avg("confidence").alias("avg_confidence")
    )
