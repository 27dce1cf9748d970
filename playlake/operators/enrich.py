"""Batch enrichment (ENR-1..5): candidates, classification, parsing, assembly.

UDF-1: the reference registers no UDF; this ``mapInPandas`` is the only
Python execution in the library. The classifier is a caller-supplied function ``pandas.DataFrame -> pandas.DataFrame``
(columns ``media_id, prompt`` in; ``media_id, raw_response, latency_ms,
input_tokens, output_tokens`` out). It runs in ``mapInPandas`` on Arrow
batches; parsing and vocabulary filtering stay in Spark expressions.
Side-effecting calls must not repeat on task retry, so ``classify`` writes its
output to reliable storage before anything reads it twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.functions import char_length, truncate
from playlake.functions.json import parse_tag_responses
from playlake.schemas import CLASSIFIER_OUTPUT, MIN_SYNOPSIS_CHARS, MOOD_TAGS, PROMPT_CHARS

Classifier = Callable[[pd.DataFrame], pd.DataFrame]


def candidates(
    titles: DataFrame,
    key: str = "title_key",
    text: str = "synopsis",
    min_chars: int = MIN_SYNOPSIS_CHARS,
    prompt_chars: int = PROMPT_CHARS,
    done: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """ENR-1: titles whose text is longer than ``min_chars``; the prompt is its
    first ``prompt_chars`` characters (STRG-2). ``done`` skips titles already
    enriched (left anti join); ``limit`` keeps the lowest keys so reruns agree."""
    out = titles.filter(char_length(F.col(text)) > min_chars).select(
        F.col(key).alias("media_id"), truncate(F.col(text), prompt_chars).alias("prompt")
    )
    if done is not None:
        out = out.join(done.select("media_id"), "media_id", "left_anti")
    if limit is not None:
        out = out.orderBy("media_id").limit(limit)
    return out


def classify(cands: DataFrame, classifier: Classifier, checkpoint: bool = True) -> DataFrame:
    """ENR-2: run ``classifier`` over Arrow batches; output follows CLASSIFIER_OUTPUT."""
    names = [f.name for f in CLASSIFIER_OUTPUT.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield classifier(batch[["media_id", "prompt"]])[names]

    out = cands.mapInPandas(run, CLASSIFIER_OUTPUT)
    return out.checkpoint(eager=True) if checkpoint else out


def assemble(raw: DataFrame, model: str, vocab: Sequence[str] = MOOD_TAGS, enriched_at=None) -> DataFrame:
    """ENR-3 / ENR-4: parse responses strictly and add model and run timestamp."""
    ts = F.current_timestamp() if enriched_at is None else F.lit(enriched_at).cast("timestamp")
    return parse_tag_responses(raw, "raw_response", vocab).select(
        "media_id",
        "mood_tags",
        "raw_response",
        "parse_ok",
        "latency_ms",
        "input_tokens",
        "output_tokens",
        F.lit(model).alias("enrichment_model"),
        ts.alias("enriched_at"),
    )
