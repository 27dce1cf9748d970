"""Enrichment and its regression gate end to end:
candidates -> classify (mapInPandas) -> strict parse -> dim_title with tags
-> eval against golden labels -> gate row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from playlake.operators import enrich, evals, gold
from playlake.schemas import MAX_PARSE_FAIL, MIN_MACRO_F1, MOOD_TAGS


def enrich_titles(dim_title: DataFrame, classifier: enrich.Classifier, model: str,
                  done: DataFrame | None = None, vocab: Sequence[str] = MOOD_TAGS,
                  enriched_at=None) -> DataFrame:
    """ENR-1..4: one result row per title with a long enough synopsis.

    ``done`` (earlier results) skips titles already enriched, so a rerun only
    calls the classifier for new titles.
    """
    cands = enrich.candidates(dim_title, done=done)
    raw = enrich.classify(cands, classifier)
    return enrich.assemble(raw, model, vocab, enriched_at)


def enriched_dim_title(stg_media: DataFrame, results: DataFrame) -> DataFrame:
    """ENR-5 / JON-1: the title dimension with mood tags."""
    return gold.dim_title(stg_media, results.select("media_id", "mood_tags", "enrichment_model", "enriched_at"))


def evaluate(golden: DataFrame, results: DataFrame, vocab: Sequence[str] = MOOD_TAGS,
             min_f1: float = MIN_MACRO_F1, max_parse_fail: float = MAX_PARSE_FAIL) -> dict[str, DataFrame]:
    """EVL-1..8: per-tag confusion and P/R/F1, and the summary row with the gate.

    The scored join (one row per golden title) is stored once and read by the
    per-tag and per-title branches.
    """
    scored = evals.score_join(golden, results).checkpoint(eager=True)
    confusion = evals.tag_confusion(scored, vocab)
    prf = evals.tag_prf(confusion)
    summary = evals.eval_summary(golden, scored, prf, min_f1, max_parse_fail)
    return {"confusion": confusion, "prf": prf, "summary": summary}
