"""Checks of result files as DataFrames of findings: (rule, subject)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What each rule says of its subjects.
RULES = {
    "malformed_row": "row without a tab",
    "duplicate_row": "S1 id on more than one row",
    "repeated_id": "S1 id whose list repeats an id",
    "self_match": "S1 id within a list",
    "wrong_prefix": "id within a list that is neither of S1, S2 nor S3",
    "unknown_id": "id within a list that is in no source",
    "missing_s1": "required S1 id without a row",
    "unexpected_s1": "S1 id that is not required",
    "not_utf8": "line that is not UTF-8",
    "no_candidate": "S1 id with a match that is no candidate",
    "header": "a header other than expected",
    "file_absent": "file that is not there",
    "ids_unchecked": "ids in lists are not checked",
}


def header_errors(header: str | None, expected: Sequence[str]) -> list[str]:
    """What is wrong with a header line; null: the file is empty."""
    if header is None:
        return ["the file is empty"]
    if "\t" not in header and "," in header:
        return ["the header has commas but no tab"]
    columns = [c.strip().lower() for c in header.rstrip("\n").split("\t")]
    return [] if columns == list(expected) else [f"unexpected header {columns}"]


def parse_lines(lines: DataFrame) -> DataFrame:
    """(s1_id, ids, malformed) of result lines (value) below the header: split at the first tab; blank lines without one are skipped."""
    at = F.instr("value", "\t")
    rest = F.expr("substring(value, instr(value, '\t') + 1)")
    blank = F.regexp_replace(rest, r"(?U)\s", "") == ""
    rows = lines.where((at > 0) | (F.regexp_replace("value", r"(?U)\s", "") != ""))
    return rows.select(
        F.when(at > 0, F.expr("substring(value, 1, instr(value, '\t') - 1)")).otherwise(F.col("value")).alias("s1_id"),
        F.when(blank, F.array().cast("array<string>")).otherwise(F.split(rest, ",")).alias("ids"),
        (at == 0).alias("malformed"),
    )


def row_counts(parsed: DataFrame) -> DataFrame:
    """(n_rows, n_empty, n_filled)."""
    rows = parsed.where("not malformed")
    empty = F.count_if(F.size("ids") == 0)
    return rows.agg(F.count("*").alias("n_rows"), empty.alias("n_empty"), (F.count("*") - empty).alias("n_filled"))


def find_errors(parsed: DataFrame, required: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(rule, subject), distinct: every offence of parsed rows. required: (s1_id); targets: (entity_id) of S2 and S3, if known."""
    rows = parsed.where("not malformed")
    listed = rows.select("s1_id", F.explode("ids").alias("id"))
    found = {
        "malformed_row": parsed.where("malformed").select("s1_id"),
        "duplicate_row": rows.groupBy("s1_id").agg(F.count("*").alias("n")).where("n > 1").select("s1_id"),
        "repeated_id": rows.where(F.size("ids") != F.size(F.array_distinct("ids"))).select("s1_id"),
        "self_match": listed.where(F.col("id").startswith("S1-")).select("id"),
        "wrong_prefix": listed.where(~F.col("id").rlike("^S[123]-")).select("id"),
        "missing_s1": required.select("s1_id").join(rows, "s1_id", "left_anti"),
        "unexpected_s1": rows.select("s1_id").join(required, "s1_id", "left_anti"),
    }
    if targets is not None:
        known = listed.where(F.col("id").rlike("^S[23]-"))
        found["unknown_id"] = known.join(targets.select(F.col("entity_id").alias("id")), "id", "left_anti").select("id")
    out = None
    for rule, subjects in found.items():
        own = subjects.toDF("subject").distinct().select(F.lit(rule).alias("rule"), "subject")
        out = own if out is None else out.unionByName(own)
    return out


def encoding_errors(lines: DataFrame) -> DataFrame:
    """(rule, subject): lines (value) that are not UTF-8, by their readable form."""
    return lines.where(~F.is_valid_utf8("value")).select(F.lit("not_utf8").alias("rule"), F.make_valid_utf8("value").alias("subject")).distinct()


def unmatched_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1_id): a warning for records with matches that are not among their candidates; both parsed."""
    pairs = lambda rows: rows.where("not malformed").select("s1_id", F.explode("ids").alias("id"))
    return pairs(matches).join(pairs(candidates), ["s1_id", "id"], "left_anti").select("s1_id").distinct()
