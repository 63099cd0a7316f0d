"""J4 for large dictionaries: keyword matching as a join, not as expressions.

Folding a dictionary into literal expressions (``functions/enrich.py``) is
right for hundreds of terms. For dictionaries of many thousands of terms the
same E1 semantics - a keyword counts when it occurs between word boundaries
of the normalised text - become an anchor join:

* the normalised text is cut into maximal runs of word / non-word characters;
  ``\\bkw\\b`` holds exactly when the keyword's own runs equal a window of
  consecutive text runs, with a word run before (after) it where it begins
  (ends) with another one;
* each term is filed under one of its runs, its anchor: the word run that the
  fewest terms of the dictionary hold (a term without a word run under its
  first run);
* a term that is one word run is found among a text's distinct runs;
* for longer terms a text emits the runs around the places of anchors only,
  equal surroundings once. A bitmap of the
  anchors, a literal of bounded size, picks the runs and places before anything
  is exploded; it passes some others, which the join drops. So the rows grow
  with the hits, not with the text times the lengths of the terms.

The join is Spark's: the dictionary is broadcast up to ``MAX_BROADCAST``, else it
is a sort-merge join (AQE splits skewed anchors). What comes of the texts is never
a broadcast side, however small Spark takes it to be: it grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_for_match, normalize_text

_RUNS = "[a-z0-9_]+|[^a-z0-9_]+"
_WORD = "^[a-z0-9_]"
#: Most places of the anchors' bitmap (a byte each); a full one only passes more.
MAX_BITMAP = 1 << 20
#: Most characters of a dictionary (and 64 a term) that is broadcast.
MAX_BROADCAST = 1 << 24


def prepare_dictionary(dictionary: DataFrame, keyword: str = "keyword", category: str = "category",
                       order: str = "cat_ord") -> DataFrame:
    """Normalise keywords (once, like the expression path) and cut them:
    ``(term, runs, category, cat_ord, weight)``. Keywords of a category that are
    equal after normalisation count as often as they are listed."""
    out = dictionary.select(
        normalize_text(F.col(keyword)).alias("term"),
        F.col(category).alias("category"),
        F.col(order).alias("cat_ord"),
    ).where(F.length("term") > 0)
    out = out.groupBy("term", "category", "cat_ord").agg(F.count(F.lit(1)).alias("weight"))
    return out.withColumn("runs", F.regexp_extract_all("term", F.lit(_RUNS), 0))


def with_anchors(dictionary: DataFrame) -> DataFrame:
    """One row a distinct term: ``(term, runs, anchor, at)``; ``at`` is the
    anchor's place among the runs, from 0."""
    terms = dictionary.select("term", "runs").distinct()
    runs = terms.select("term", "runs", F.posexplode("runs").alias("at", "anchor"))
    held = runs.groupBy("anchor").agg(F.count_distinct("term").alias("terms"))
    rank = F.struct((~F.col("anchor").rlike(_WORD)).alias("other"), "terms", (-F.length("anchor")).alias("length"), "at", "anchor")
    best = runs.join(held, "anchor").groupBy("term", "runs").agg(F.min(rank).alias("best"))
    return best.select("term", "runs", "best.anchor", "best.at")


def _slot(run: Column, places: int) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(places)).cast("int")


def _bitmap(anchors: DataFrame) -> bytes:
    """A byte for each place; read on the driver (one row, ``MAX_BITMAP`` bytes at most)."""
    places = 1 << 10
    while places < min(16 * anchors.select("anchor").distinct().count(), MAX_BITMAP):
        places *= 2
    held = anchors.select(_slot(F.col("anchor"), places).alias("slot")).distinct().agg(F.collect_set("slot")).first()[0]
    out = bytearray(places)
    for slot in held:
        out[slot] = 1
    return bytes(out)


def text_places(df: DataFrame, id_col: str, norm_col: str, bitmap: bytes, before: int, after: int) -> DataFrame:
    """``(__id, anchor, around, at)``: every run of the text that may be an
    anchor, with up to ``before`` runs in front and ``after`` behind (and one
    more on either side, which tells whether there is any); ``at`` is the
    anchor's place in ``around``, from 0."""
    runs = F.col("__runs")
    picked = F.filter(F.transform(runs, lambda run, i: F.when(_marked(run, bitmap), i)), lambda i: i.isNotNull())

    def place(i: Column) -> Column:
        first = F.greatest(i - (before + 1), F.lit(0))
        return F.struct(F.get(runs, i).alias("anchor"), F.slice(runs, first + 1, i - first + (after + 2)).alias("around"), (i - first).alias("at"))

    places = F.array_distinct(F.transform(picked, place))
    return _cut(df, id_col, norm_col).select("__id", F.explode(places).alias("p")).select("__id", "p.*")


def _cut(df: DataFrame, id_col: str, norm_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("__id"), F.regexp_extract_all(F.col(norm_col), F.lit(_RUNS), 0).alias("__runs"))


def _marked(run: Column, bitmap: bytes) -> Column:
    return F.substring(F.lit(bitmap), _slot(run, len(bitmap)) + 1, F.lit(1)) == F.lit(b"\x01")


def text_words(df: DataFrame, id_col: str, norm_col: str, bitmap: bytes) -> DataFrame:
    """``(__id, term)``: the distinct runs of the text that the bitmap marks."""
    words = F.filter(F.array_distinct("__runs"), lambda run: _marked(run, bitmap))
    return _cut(df, id_col, norm_col).select("__id", F.explode(words).alias("term"))


def match_scores(df: DataFrame, id_col: str, norm_col: str, dictionary: DataFrame) -> DataFrame:
    """E1 in long form: ``(id, category, cat_ord, score)`` for positive scores.

    ``dictionary`` is the output of ``prepare_dictionary``. Its anchors and the
    longest reach on either side of one are read while the plan is built (a job
    over the dictionary alone). A term counts once per text, however often it
    occurs; the score is the sum of the weights.
    """
    word = (F.size("runs") == 1) & F.col("term").rlike(_WORD)
    words = dictionary.where(word).select("term").distinct()
    anchors = with_anchors(dictionary.where(~word))
    reach = anchors.agg(F.max("at"), F.max(F.size("runs") - 1 - F.col("at"))).first()
    places = text_places(df, id_col, norm_col, _bitmap(anchors), reach[0] or 0, reach[1] or 0)
    listed = dictionary.agg(F.sum(F.length("term") + 64)).first()[0] or 0
    side = "broadcast" if listed <= MAX_BROADCAST else "merge"
    terms = anchors.select("term", "anchor", "runs", F.col("at").alias("lead")).hint(side)
    start = F.col("at") - F.col("lead")
    stop = start + F.size("runs")
    inside = (start >= 0) & (F.slice("around", F.greatest(start, F.lit(0)) + 1, F.size("runs")) == F.col("runs"))
    opens = F.get("runs", F.lit(0)).rlike(_WORD) | (start > 0)
    closes = F.element_at("runs", -1).rlike(_WORD) | (stop < F.size("around"))
    found = places.join(terms, "anchor").where(inside & opens & closes).select("__id", "term").distinct()
    single = text_words(df, id_col, norm_col, _bitmap(words.withColumnRenamed("term", "anchor")))
    found = found.unionByName(single.join(words.hint(side), "term", "left_semi"))
    weights = dictionary.select("term", "category", "cat_ord", "weight").hint(side)
    return found.join(weights, "term").groupBy(F.col("__id").alias(id_col), "category", "cat_ord").agg(F.sum("weight").alias("score"))


def best_category(scores: DataFrame, id_col: str, out: str = "category") -> DataFrame:
    """E2 on long scores: highest score, ties to the lower ``cat_ord``."""
    best = F.max(F.struct(F.col("score"), (-F.col("cat_ord")).alias("neg_ord"), F.col("category")))
    return scores.groupBy(id_col).agg(best.alias("__b")).select(id_col, F.col("__b.category").alias(out))


def infer_category_by_join(df: DataFrame, id_col: str, text_col: str, dictionary: DataFrame,
                           out: str = "category") -> DataFrame:
    """E2 for every row of ``df`` (``unknown`` when nothing matches)."""
    normed = df.select(id_col, normalize_for_match(F.col(text_col)).alias("__norm"))
    best = best_category(match_scores(normed, id_col, "__norm", dictionary), id_col, out).hint("merge")
    return df.select(id_col).join(best, id_col, "left").select(
        id_col, F.coalesce(F.col(out), F.lit("unknown")).alias(out))


def taxonomy_table(spark, taxonomy) -> DataFrame:
    """A ``Taxonomy`` as a dictionary DataFrame ``(category, cat_ord, keyword)``."""
    return spark.createDataFrame(
        [(cat, i, kw) for i, (cat, kws) in enumerate(taxonomy.categories) for kw in kws],
        "category string, cat_ord int, keyword string",
    )

