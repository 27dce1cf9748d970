"""Strict JSON helpers: JSN-2 / ENR-3 response parsing and STR-1 line checks.

Spark's JSON readers stop after the first complete value, so ``["a"] junk``
parses. To get whole-input strictness without a Python UDF, the text is placed
inside an array followed by a sentinel string (the SHA-256 of the text itself).
The wrapped text parses, and its last element is that sentinel, only if the
original text was exactly one JSON value; no input can contain its own digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from playlake.functions.strings import py_strip


def with_json_check(df, column: str, out: str = "is_json", value: str | None = None):
    """Whether the text is exactly one JSON value of any type; the parse runs once per row.

    With ``value`` set, the parsed value is kept as a variant column of that
    name, so callers can read fields without parsing the text again.
    """
    seal = F.sha2(F.col(column), 256)
    staged = df.withColumn("_jc_seal", seal).withColumn(
        "_jc_items",
        F.try_variant_get(
            F.try_parse_json(F.concat(F.lit("["), F.col(column), F.lit(',"'), F.col("_jc_seal"), F.lit('"]'))),
            "$",
            "array<variant>",
        ),
    )
    ok = F.try_variant_get(F.try_element_at(F.col("_jc_items"), F.lit(2)), "$", "string") == F.col("_jc_seal")
    staged = staged.withColumn(out, F.coalesce(ok, F.lit(False)))
    if value:
        staged = staged.withColumn(value, F.try_element_at(F.col("_jc_items"), F.lit(1)))
    return staged.drop("_jc_seal", "_jc_items")


#: A JSON string, and a run of digits that the parser's limit on numbers would refuse, with the part of it that is kept.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_LONG_NUMBER = f"({_STRING})|([0-9]{{400}})[0-9]{{500,}}"


def json_lines(df, column: str, out: str = "value", reason: str = "reason"):
    """Every row of df with its text's one JSON value in ``out``, or a ``reason`` why it has none.

    The text is read once: both columns come from one generator, which no filter
    on them can cross, so accepted and rejected rows are two filters on one
    parse and never overlap. NaN, Infinity and -Infinity pass, as do repeated keys (the last
    one wins when fields are read); +INF and its like do not. A number of over
    900 digits passes, cut to its first 400: as a double or a long the
    value is the same (infinite, zero or out of range), or differs beyond its precision.
    """
    raw = F.col(column)
    text = F.when(raw.rlike("[0-9]{900}"), F.regexp_replace(raw, _LONG_NUMBER, "$1$2")).otherwise(raw)
    sealed = df.withColumn("_jl_text", text).withColumn("_jl_seal", F.sha2(F.col("_jl_text"), 256))
    wrapped = F.concat(F.lit("["), F.col("_jl_text"), F.lit(',"'), F.col("_jl_seal"), F.lit('"]'))
    items = sealed.withColumn("_jl_items", F.from_json(wrapped, "array<string>", {"allowSingleQuotes": "false"}))
    one = (F.size("_jl_items") == 2) & (F.try_element_at("_jl_items", F.lit(2)) == F.col("_jl_seal"))
    # the parser takes signs and names of infinity that JSON readers refuse; a plus is fine in an exponent
    odd = F.when(raw.contains("INF") | raw.contains("+"), F.regexp_replace("_jl_text", _STRING, '""').rlike(r"INF|(?<![eE])\+"))
    fine = items.withColumn("_jl_fine", F.coalesce(one, F.lit(False)) & ~F.coalesce(odd, F.lit(False)))
    found = F.struct(
        F.when(F.col("_jl_fine"), F.try_element_at("_jl_items", F.lit(1))).alias(out),
        F.when(~F.col("_jl_fine"), F.lit("not_one_json_value")).alias(reason),
    )
    return fine.select(*df.columns, F.inline(F.array(found)))


def json_values(df, column: str, out: str):
    """The rows of ``json_lines`` that hold one JSON value, with the value's text in ``out``."""
    return json_lines(df, column, out, "_jv_reason").filter(F.col("_jv_reason").isNull()).drop("_jv_reason")


def parse_tag_responses(
    df,
    raw: str,
    vocab: Sequence[str],
    tags: str = "mood_tags",
    ok: str = "parse_ok",
):
    """JSN-2 / ENR-3: the tags of each reply and whether it parsed.

    The text is stripped first. An array keeps its string items that are in
    ``vocab`` (order and duplicates kept); an object contributes its keys; a
    string contributes its characters; every case then filters by ``vocab``.
    Numbers, booleans, null and malformed text give ``([], False)``.
    Known differences from Python: ``NaN`` literals and duplicate object keys
    are rejected here.

    Each intermediate (stripped text, its parse, the value's type) is its own
    projection and is referenced several times, so Catalyst computes it once per
    row. A generator of one row stands between them and the results: a filter on
    ``ok`` or ``tags`` stays above it and cannot write the parse out again.
    """
    allowed = F.array(*[F.lit(v) for v in vocab])
    empty = F.array().cast("array<string>")
    s = df.withColumn("_pr_text", py_strip(F.col(raw)))
    s = s.withColumn("_pr_seal", F.sha2(F.col("_pr_text"), 256))
    s = s.withColumn(
        "_pr_items",
        F.try_variant_get(
            F.try_parse_json(F.concat(F.lit("["), F.col("_pr_text"), F.lit(',"'), F.col("_pr_seal"), F.lit('"]'))),
            "$",
            "array<variant>",
        ),
    )
    s = s.withColumn(
        "_pr_ok",
        F.coalesce(
            F.try_variant_get(F.try_element_at(F.col("_pr_items"), F.lit(2)), "$", "string") == F.col("_pr_seal"),
            F.lit(False),
        ),
    ).withColumn("_pr_value", F.try_element_at(F.col("_pr_items"), F.lit(1)))
    s = s.withColumn("_pr_kind", F.when(F.col("_pr_ok"), F.schema_of_variant("_pr_value")))
    s = s.select(*df.columns, F.inline(F.array(F.struct("_pr_text", "_pr_value", "_pr_kind"))))
    kind = F.col("_pr_kind")
    is_array, is_object, is_string = kind.startswith("ARRAY"), kind.startswith("OBJECT"), kind == "STRING"
    string_items = F.transform(
        F.filter(F.try_variant_get("_pr_value", "$", "array<variant>"), lambda e: F.schema_of_variant(e) == "STRING"),
        lambda e: F.variant_get(e, "$", "string"),
    )
    candidates = (
        F.when(is_array, string_items)
        .when(is_object, F.json_object_keys("_pr_text"))
        .when(is_string, F.split(F.variant_get("_pr_value", "$", "string"), ""))
        .otherwise(empty)
    )
    parsed_ok = F.coalesce(is_array | is_object | is_string, F.lit(False))
    out = s.withColumn(ok, parsed_ok).withColumn(
        tags,
        F.when(F.col(ok), F.filter(F.coalesce(candidates, empty), lambda t: F.array_contains(allowed, t))).otherwise(
            empty
        ),
    )
    return out.drop("_pr_text", "_pr_value", "_pr_kind")
