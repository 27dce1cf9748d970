"""A deterministic classifier for tests: it names the words that occur in the prompt."""

import json

import pandas as pd


def keyword_classifier(words):
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        low = batch["prompt"].fillna("").str.lower()
        replies = [json.dumps([w for w in words if w in text]) for text in low]
        return pd.DataFrame({
            "media_id": batch["media_id"].astype("int64"), "raw_response": replies,
            "latency_ms": low.str.len().astype("int64"), "input_tokens": (low.str.len() // 4).astype("int64"),
            "output_tokens": pd.Series([len(r) // 4 for r in replies], dtype="int64"),
        })

    return run
