"""The rules under names of their own in SQL: views over a table, and scalar functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from debenture.functions import patterns as P
from debenture.functions.text import SPACE
from debenture.operators import records

SCALARS = {
    "normalise_dates": ("s STRING", "STRING", r"regexp_replace(regexp_replace(s, '[/\\\\\\-.]', '-'), '(\\d+)(?:st|nd|rd|th)', '$1')"),
    "document_id": ("url STRING, company STRING, doc_type STRING, date STRING", "STRING", "md5(concat_ws('_', coalesce(url, 'None'), coalesce(company, 'None'), coalesce(doc_type, 'None'), coalesce(date, 'None')))"),
    "output_name": ("company STRING", "STRING", "concat(replace(company, '/', '_'), '.json')"),
    "is_final_terms": ("filename STRING", "BOOLEAN", "lower(filename) RLIKE 'final|terms|pricing|supplement'"),
}


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bank_scalars() -> dict:
    ci = lambda p: _quoted(f"(?i){p}")
    cleaned = f"trim(regexp_replace(regexp_replace(regexp_replace(name, {ci(P.BANK_SUFFIX)}, ''), {ci(P.BANK_PREFIX)}, ''), {_quoted(r'\s+')}, ' '))"
    known = " ".join(f"WHEN lower({cleaned}) = {_quoted(a)} OR startswith(lower({cleaned}), {_quoted(a + ' ')}) THEN {_quoted(b)}" for a, b in P.BANK_NAMES.items())
    wrong = ", ".join(_quoted(t) for x in P.NOT_BANKS for t in (x, x + "s"))
    banks = ci("|".join(f"(?:{p})" for p in P.BANKS))
    valid = f"coalesce(length(name) >= 3 AND lower(name) NOT IN ({wrong}) AND (name RLIKE {banks} OR lower(name) RLIKE {_quoted(P.BANK_ENDING)} OR name RLIKE {_quoted(P.BANK_OF)} OR name RLIKE {_quoted(P.PROPER_NAME)}), false)"
    return {"clean_bank_name": ("name STRING", "STRING", f"CASE {known} ELSE {cleaned} END"), "is_valid_bank_name": ("name STRING", "BOOLEAN", valid)}


def _text_scalars() -> dict:
    at = "position(lower(target), lower(s))"
    cut = f"substring(s, greatest({at} - width, 1), {at} + length(target) + width - greatest({at} - width, 1))"
    ascii_only = _quoted(r"[^\x{00}-\x{7F}]+")
    per_cent, before, comma = _quoted(r"per\s*cent\.?"), _quoted(r"\s+%"), _quoted(r"(\d+),(\d+)")
    return {
        "clean_text": ("s STRING", "STRING", f"trim(regexp_replace(regexp_replace(coalesce(s, ''), {_quoted(SPACE + '+')}, ' '), {ascii_only}, ''))"),
        "text_context": ("s STRING, target STRING, width INT", "STRING", f"CASE WHEN {at} > 0 AND target <> '' THEN {cut} ELSE '' END"),
        "normalise_coupon": ("s STRING", "STRING", f"regexp_replace(regexp_replace(regexp_replace(s, {per_cent}, '%'), {before}, '%'), {comma}, '$1.$2')"),
    }


def register_functions(spark: SparkSession) -> list[str]:
    every = SCALARS | _bank_scalars() | _text_scalars()
    for name, (args, kind, body) in every.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
    return list(every)


def register_views(docs: DataFrame, strict: bool = False) -> None:
    """extractions: the record of each of docs."""
    records.extracted(docs, strict=strict).createOrReplaceTempView("extractions")
