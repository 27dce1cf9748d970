"""Enrichment evaluation (EVL-1..10, JON-4, SET-3/5, ARR-2).

Per-tag counts come from exploding each title's (small) set differences and
aggregating with map-side combine; the vocabulary frame (a handful of fixed
tags) is joined last so zero-support tags still appear. No cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.functions import floor_div, jaccard, py_round, rate
from playlake.operators.frames import side_by_side
from playlake.operators.ordering import exact_percentile
from playlake.operators.silver import latest
from playlake.schemas import MAX_PARSE_FAIL, MIN_MACRO_F1



def _empty() -> Column:
    return F.array().cast("array<string>")


def vocabulary(spark: SparkSession, vocab: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(i, t) for i, t in enumerate(vocab)], "tag_order int, tag string")


def score_join(golden: DataFrame, preds: DataFrame, key: str = "media_id", seq: str | None = None) -> DataFrame:
    """JON-4: golden x predictions on the key; ``want``/``got`` as element sets.

    Each side has one row per key. Where keys repeat, ``seq`` names the column
    whose largest value wins (the last line); it must be unique within a key.
    """
    if seq is not None:
        golden, preds = (latest(d, [key], [F.col(seq).desc()]) for d in (golden, preds))
    g = golden.select(key, F.array_distinct(F.coalesce(F.col("mood_tags"), _empty())).alias("want"))
    p = preds.select(
        key,
        F.array_distinct(F.coalesce(F.col("mood_tags"), _empty())).alias("got"),
        "raw_response",
        "input_tokens",
        "output_tokens",
    )
    return g.join(p, key)


def tag_confusion(scored: DataFrame, vocab: Sequence[str]) -> DataFrame:
    """EVL-1: TP / FP / FN per vocabulary tag (tags outside the vocabulary ignored)."""
    allowed = F.array(*[F.lit(t) for t in vocab])

    def tagged(arr: Column, kind: int) -> Column:
        return F.transform(
            F.filter(arr, lambda t: F.array_contains(allowed, t)),
            lambda t: F.struct(t.alias("tag"), F.lit(kind).alias("kind")),
        )

    items = F.concat(
        tagged(F.array_intersect("want", "got"), 0),
        tagged(F.array_except("got", "want"), 1),
        tagged(F.array_except("want", "got"), 2),
    )
    counts = (
        scored.select(F.explode(items).alias("i"))
        .groupBy(F.col("i.tag").alias("tag"))
        .agg(
            F.count_if(F.col("i.kind") == 0).alias("tp"),
            F.count_if(F.col("i.kind") == 1).alias("fp"),
            F.count_if(F.col("i.kind") == 2).alias("fn"),
        )
    )
    vocab_df = vocabulary(scored.sparkSession, vocab)
    return vocab_df.join(counts, "tag", "left").select(
        "tag",
        "tag_order",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("tp", "fp", "fn")],
    )


def _ratio(num: str, *den: str) -> Column:
    d = sum((F.col(c) for c in den), F.lit(0))
    return F.when(d > 0, F.col(num).cast("double") / d).otherwise(F.lit(0.0))


def tag_prf(confusion: DataFrame) -> DataFrame:
    """EVL-2: precision, recall, F1 per tag; each 0.0 when its denominator is 0."""
    pr = confusion.select("tag", "tag_order", _ratio("tp", "tp", "fp").alias("precision"),
                          _ratio("tp", "tp", "fn").alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return pr.withColumn("f1", f1)


def eval_summary(
    golden: DataFrame,
    scored: DataFrame,
    prf: DataFrame,
    min_f1: float = MIN_MACRO_F1,
    max_parse_fail: float = MAX_PARSE_FAIL,
    scale: int = 4,
) -> DataFrame:
    """EVL-3..8: coverage, macro-F1 over every vocabulary tag, mean Jaccard
    (empty union = 1.0), parse-failure rate (no tags but a non-empty raw
    response), tokens per title (floor division) and the regression gate.

    Golden titles and predictions without a common key are an error, raised when
    the summary is computed."""
    per_title = scored.groupBy().agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.avg(jaccard("want", "got", 1.0)).alias("_jac"),
        rate((F.size("got") == 0) & (F.length(F.coalesce(F.col("raw_response"), F.lit(""))) > 0)).alias("_pf"),
        F.sum(F.coalesce(F.col("input_tokens"), F.lit(0)) + F.coalesce(F.col("output_tokens"), F.lit(0))).alias("_tok"),
    )
    macro = prf.groupBy().agg(F.avg("f1").alias("_f1"))
    n_golden = golden.groupBy().agg(F.count(F.lit(1)).alias("n_golden"))
    joined = side_by_side(per_title, macro, n_golden)
    parse_fail = F.coalesce(F.col("_pf"), F.lit(0.0))
    scored_any = F.when(F.col("n_scored") == 0, F.raise_error(F.lit("no golden title has a prediction")).cast("long"))
    return joined.select(
        scored_any.otherwise(F.col("n_scored")).alias("n_scored"),
        "n_golden",
        py_round("_f1", scale).alias("macro_f1"),
        py_round(F.col("_jac"), scale).alias("mean_jaccard"),
        py_round(parse_fail, scale).alias("parse_fail_rate"),
        floor_div(F.coalesce(F.col("_tok"), F.lit(0)), F.col("n_scored")).alias("tokens_per_title"),
        ((F.col("_f1") >= F.lit(min_f1)) & (parse_fail <= F.lit(max_parse_fail)) & (F.col("n_scored") > 0)).alias(
            "passed"
        ),
    )


def trace_health(
    preds: DataFrame,
    input_rate: float,
    output_rate: float,
    quantile: float = 0.95,
    scale: int = 4,
    exact: bool = True,
    accuracy: int = 10000,
) -> DataFrame:
    """EVL-9 / EVL-10: empty-tag rate, latency percentile, tokens and cost per title.

    Rates are caller-supplied prices per token; there is no default price.
    ``exact`` counts each distinct latency and interpolates between ranks of those
    counts (linear interpolation, as ``percentile``); ``exact=False`` merges fixed-size
    quantile sketches map-side (``percentile_approx``), with no sort.
    """
    tok_in = F.coalesce(F.col("input_tokens"), F.lit(0))
    tok_out = F.coalesce(F.col("output_tokens"), F.lit(0))
    base = preds.groupBy().agg(
        F.count(F.lit(1)).alias("n"),
        rate(F.size(F.coalesce(F.col("mood_tags"), _empty())) == 0).alias("_empty"),
        F.sum(tok_in + tok_out).alias("_tok"),
        F.avg(tok_in * F.lit(float(input_rate)) + tok_out * F.lit(float(output_rate))).alias("_cost"),
    )
    if exact:
        pct = exact_percentile(preds, "latency_ms", quantile, "_p")
    else:
        pct = preds.groupBy().agg(
            F.percentile_approx(F.col("latency_ms").cast("double"), quantile, accuracy).alias("_p"))
    return side_by_side(base, pct).select(
        "n",
        py_round("_empty", scale).alias("empty_tag_rate"),
        py_round("_p", 2).alias(f"p{int(round(quantile * 100))}_latency_ms"),
        floor_div(F.coalesce(F.col("_tok"), F.lit(0)), F.col("n")).alias("tokens_per_title"),
        py_round("_cost", 6).alias("cost_per_title"),
    )
