"""Evidence from daily lists: whose code it was, metadata that was missing, overlaps, list ties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.contracts import failure_class, first_reason, is_code


def identity_evidence(documents: DataFrame, locators: DataFrame, events: DataFrame, types: list[str]) -> DataFrame:
    """(doc_id, sources, status, missing_reason): whether the lists that a document points to bear out its filer and code.

    documents: doc_id, entity_id, code, doc_type. locators: doc_id, file, seq, day, sha256. events: file, seq, day, sha256, doc_id, entity_id,
    code, doc_type, fund_code, subject_id, issuer_id. Each locator must meet one row of those bytes and that day; the first
    locator (by file and seq) that fails gives the reason. Where both tables have `fields`, the row as it was copied and as it is read again, these
    must be equal too.
    """
    copied = "fields" in locators.columns and "fields" in events.columns
    own = ["fields"] if copied else []
    e = events.groupBy("file", "seq").agg(F.count("*").alias("n"), *[F.min(c).alias(f"e_{c}") for c in ("day", "sha256", "doc_id", "entity_id", "code", "doc_type", "fund_code", "subject_id", "issuer_id", *own)])
    files = events.select("file", F.col("sha256").alias("bytes")).distinct()
    d = documents.select("doc_id", "entity_id", "code", "doc_type")
    met = locators.join(files, "file", "left").join(e, ["file", "seq"], "left").join(d, "doc_id")
    same = F.lit(True)
    for c in ("doc_id", "entity_id", "code", "doc_type"):
        same = same & F.col(c).eqNullSafe(F.col(f"e_{c}"))
    other_role = F.coalesce(F.col("e_fund_code") != "", F.lit(False)) | F.coalesce(F.col("e_subject_id") != "", F.lit(False)) | F.coalesce(F.col("e_issuer_id") != F.col("entity_id"), F.lit(False))
    reason = first_reason(
        (~F.col("sha256").eqNullSafe(F.col("bytes")), "edinet_metadata_integrity_failed"),
        (~F.col("n").eqNullSafe(F.lit(1).cast("bigint")) | ~F.col("day").eqNullSafe(F.col("e_day")), "edinet_identity_locator_mismatch"),
        (~same, "edinet_identity_mismatch"),
        (~F.col("fields").eqNullSafe(F.col("e_fields")) if copied else F.lit(False), "edinet_identity_source_row_mismatch"),
        (other_role, "filer_security_role_unsupported"),
    )
    told = met.withColumn("reason", reason).groupBy("doc_id").agg(F.count("*").alias("sources"), F.min(F.when(F.col("reason").isNotNull(), F.struct("file", "seq", "reason"))).alias("f"))
    out = d.join(told, "doc_id", "left")
    why = first_reason(
        (~is_code(F.col("code")), "invalid_code"),
        (F.col("entity_id").isNull(), "edinet_filer_identifier_missing"),
        (~F.coalesce(F.col("doc_type").isin(types), F.lit(False)), "filer_security_role_unsupported"),
        (F.col("sources").isNull(), "edinet_identity_source_missing"),
        (F.col("f").isNotNull(), F.col("f.reason")),
    )
    return out.select("doc_id", F.coalesce("sources", F.lit(0)).alias("sources"), F.when(why.isNull(), "PASS").otherwise("BLOCKED").alias("status"), why.alias("missing_reason"))


def gap_resolution(gaps: DataFrame, events: DataFrame, files: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """(doc_id, history, resolution, missing_reason) of gaps(doc_id): documents without metadata against lists read again.

    events: doc_id, day, entity_id, code, submitted, doc_type, period_start, period_end, warned (the list was rejected for a parent id's
    case). files: doc_id, file_reason (why a local file can't be read, or null), changed (its size or time isn't the recorded one), parse_status, codes
    (array, empty ones left out); a row for each local file. lists: list_reason of the daily lists read again, null where one could be. What is wrong
    with the local file goes before all that the lists say: none, several, a failure by its class, a change. Claims that conflict are never chosen among.
    """
    claim = F.struct("entity_id", "code", "submitted", "doc_type", "period_start", "period_end")
    per = events.groupBy("doc_id").agg(F.count_distinct(F.to_json(claim, {"ignoreNullFields": "false"})).alias("claims"), F.min("entity_id").alias("entity_id"), F.bool_or(F.coalesce(F.substring("submitted", 1, 10) == F.col("day"), F.lit(False))).alias("same_day"), F.bool_or("warned").alias("warned"))
    own = files.groupBy("doc_id").agg(F.count("*").alias("files"), *[F.min(F.struct("file_reason", "changed", "parse_status", "codes"))[c].alias(c) for c in ("file_reason", "changed", "parse_status", "codes")])
    met = gaps.select("doc_id").distinct().join(per, "doc_id", "left").join(own, "doc_id", "left")
    no_list = lists is not None and bool(lists.agg(F.bool_and(F.col("list_reason").eqNullSafe(F.lit("daily_metadata_not_available")))).first()[0])
    reason = first_reason(
        (F.col("files").isNull(), failure_class(F.lit("local_file_not_available"))),
        (F.col("files") > 1, failure_class(F.lit("ambiguous_local_document_versions"))),
        (F.col("file_reason").isNotNull(), failure_class(F.col("file_reason"))),
        (F.col("changed"), failure_class(F.lit("local_file_changed"))),
        (F.col("claims").isNull() & F.lit(no_list), "daily_metadata_not_available"),
        (F.col("claims").isNull(), "unresolved"),
        (F.col("claims") > 1, "metadata_identity_ambiguous"),
        (~F.col("same_day"), "daily_date_submit_date_mismatch"),
        (~F.col("parse_status").eqNullSafe(F.lit("PASS")), "original_xml_unverified"),
        (F.coalesce(F.size("codes"), F.lit(0)) != 1, "original_identifier_ambiguous_or_missing"),
        (~F.get("codes", F.lit(0)).eqNullSafe(F.col("entity_id")), "original_metadata_identifier_mismatch"),
    )
    history = F.when(F.col("warned"), "daily_file_rejected_by_parent_case_guard").otherwise("unresolved")
    return met.select("doc_id", history.alias("history"), F.when(reason.isNull(), "PASS").otherwise("BLOCKED").alias("resolution"), reason.alias("missing_reason"))


def overlap_sample(lines: DataFrame, known: DataFrame) -> DataFrame:
    """One row (doc_id, line, rule) of lines(line, doc_id), or none: line 1 if its document is known, else the least common document's first line."""
    common = lines.join(known.select("doc_id").distinct(), "doc_id", "left_semi")
    best = common.agg(F.min(F.when(F.col("line") == 1, F.struct("doc_id", "line"))).alias("first"), F.min(F.struct("doc_id", "line")).alias("least"))
    one = F.coalesce("first", "least")
    rule = F.when(F.col("first").isNotNull(), "prefer_fixed_line_1_if_local_zip_exists").otherwise("sorted_intersection_doc_id_then_first_line")
    return best.where("least is not null").select(one["doc_id"].alias("doc_id"), one["line"].alias("line"), rule.alias("rule"))


def list_tie(documents: DataFrame, events: DataFrame) -> DataFrame:
    """(doc_id, sequences, missing_reason): documents(doc_id, day) on the list of their submit day; events(doc_id, day, seq)."""
    days = events.select("day").distinct().withColumn("listed", F.lit(True))
    own = events.groupBy("doc_id", "day").agg(F.count("*").alias("sequences"))
    met = documents.join(days, "day", "left").join(own, ["doc_id", "day"], "left")
    reason = first_reason((F.col("listed").isNull(), "local_daily_metadata_not_available"), (F.col("sequences").isNull(), "local_daily_document_id_not_found"))
    return met.select("doc_id", F.coalesce("sequences", F.lit(0)).alias("sequences"), reason.alias("missing_reason"))


def reverse_facts(stored: DataFrame, again: DataFrame, key: str = "fact_id") -> DataFrame:
    """(check, violations): stored facts that occur twice, and those that a second extraction doesn't give in every column."""
    twice = stored.groupBy(key).count().where("count > 1").agg(F.count("*").alias("violations")).select(F.lit("duplicate_fact_id").alias("check"), "violations")
    columns = [c for c in stored.columns if c in again.columns]

    def hashed(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.col(key).alias(key), F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256).alias(name)).distinct()

    lost = hashed(stored, "a").join(hashed(again, "b"), key, "left").where("not (a <=> b)")
    return twice.union(lost.agg(F.count("*").alias("violations")).select(F.lit("source_reverse_lookup_mismatch").alias("check"), "violations"))
