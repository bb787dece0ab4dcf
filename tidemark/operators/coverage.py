"""Counts over ledgers, grids and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import canonical_event


def reason_counts(ledger: DataFrame, reasons: str, by: list[str] = ()) -> DataFrame:
    """(by, reason, n) of an array column of reasons."""
    return ledger.select(*by, F.explode(reasons).alias("reason")).groupBy(*by, "reason").agg(F.count("*").alias("n"))


def sample_coverage(docs: DataFrame) -> DataFrame:
    """Per sample_kind: documents, entities and how many passed integrity, tie and parse."""
    return docs.groupBy("sample_kind").agg(F.count("*").alias("documents"), F.count_distinct("entity").alias("entities"), *[F.count_if(c).alias(f"{c}_pass") for c in ("integrity", "tie", "parse")])


def grid(rows: DataFrame, columns: list, row_key: str, column_key: str, facts: DataFrame, present: Column) -> DataFrame:
    """Every (row, column) of a complete grid with candidates, non_null and a reason where nothing stands.

    columns are the few given values; rows have row_key; facts have both keys.
    """
    full = rows.select(row_key).distinct().withColumn(column_key, F.explode(F.array(*[F.lit(c) for c in columns])))
    n = facts.groupBy(row_key, column_key).agg(F.count("*").alias("candidates"), F.count_if(present).alias("non_null"))
    out = full.join(n, [row_key, column_key], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("candidates", "non_null")})
    return out.withColumn("reason", F.when(F.col("candidates") == 0, "no_candidate").when(F.col("non_null") == 0, "all_candidates_blocked"))


def source_matrix(docs: DataFrame, tables: list[tuple[str, str]], rows: DataFrame) -> DataFrame:
    """Every document and (source, table) with the number and ids of rows, or why there are none."""
    pairs = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(t).alias("table")) for s, t in tables])
    full = docs.select("doc_id").distinct().withColumn("p", F.explode(pairs)).select("doc_id", "p.*")
    n = rows.groupBy("doc_id", "source", "table").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("row_id")).alias("ids"))
    return full.join(n, ["doc_id", "source", "table"], "left").select("doc_id", "source", "table", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("ids", F.array().cast("array<string>")).alias("ids"), F.when(F.col("n").isNull(), "no_provider_row").alias("reason"))


def bias_summary(rows: DataFrame, attributes: list[str], before: Column, after: Column) -> DataFrame:
    """(attribute, value, n, missing_before, missing_after): one pass of grouping sets; unknown is a group."""
    named = rows.select(*[F.coalesce(F.col(a).cast("string"), F.lit("unknown")).alias(a) for a in attributes], before.cast("int").alias("b"), after.cast("int").alias("a_"))
    sets = named.groupingSets([[F.col(a)] for a in attributes], *[F.col(a) for a in attributes]).agg(F.count("*").alias("n"), F.sum("b").alias("missing_before"), F.sum("a_").alias("missing_after"), F.grouping_id().alias("g"))
    full = (1 << len(attributes)) - 1
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, a in enumerate(attributes):
        mask = full & ~(1 << (len(attributes) - 1 - i))
        name, value = F.when(F.col("g") == mask, F.lit(a)).otherwise(name), F.when(F.col("g") == mask, F.col(a)).otherwise(value)
    return sets.select(name.alias("attribute"), value.alias("value"), "n", "missing_before", "missing_after")


def shared_originals(comparisons: DataFrame) -> DataFrame:
    """(origin_id, views, sources, evidence): provider views of one original are one piece of evidence together."""
    return comparisons.where("origin_id is not null").groupBy("origin_id").agg(F.array_sort(F.collect_set("row_id")).alias("views"), F.count_distinct("source").alias("sources"), F.lit(1).alias("evidence"))


def multi_view_counts(shared: DataFrame, all_sources: int) -> DataFrame:
    return shared.agg(F.count_if(F.col("sources") > 1).alias("seen_by_several"), F.count_if(F.col("sources") == all_sources).alias("seen_by_all"), F.sum("evidence").alias("evidence_groups"))


def acceptance(rows: DataFrame) -> DataFrame:
    """Per source: PASS or BLOCKED for fetched, profiled and tied, PASS if any row is."""
    return rows.groupBy("source").agg(*[F.when(F.bool_or(c), "PASS").otherwise("BLOCKED").alias(c) for c in ("data_fetched", "schema_profiled", "original_tied")])


def observed_ranges(rows: DataFrame, day: str, key: str) -> DataFrame:
    return rows.groupBy("source").agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count_distinct(key).alias("identifiers"))


def inventory(events: DataFrame, files: DataFrame) -> DataFrame:
    """One row about documents with files and what the daily lists say of them.

    events: doc_id, day, seq, submit_day, code, entity, doc_type (a row for each listing); files: doc_id, a row for each file. Counts of documents, files,
    documents of several files, with and without events, only listed; codes and types by the canonical event (an empty or null type is `unknown`), entities with an upper
    bound of nothing but their number; first and last submit and listing day. types: sorted (type, n) pairs.
    """
    kept = files.groupBy("doc_id").agg(F.count("*").alias("files"))
    own = canonical_event(events.select("doc_id", "day", "seq", "submit_day", "code", "entity", "doc_type")).drop("day", "seq")
    met = kept.join(own.withColumn("listed", F.lit(True)), "doc_id", "full")
    there = F.col("files").isNotNull()
    kind = F.when(there, F.coalesce(F.when(F.col("doc_type") != "", F.col("doc_type")), F.lit("unknown")))
    coded = there & F.coalesce(F.col("code") != "", F.lit(False))
    per = met.groupBy(kind.alias("kind")).agg(F.count_if(there).alias("documents"), F.sum("files").alias("files"), F.count_if(F.col("files") > 1).alias("repeated"), F.count_if(there & F.col("listed")).alias("with_events"), F.count_if(~there).alias("listing_only"), F.count_if(coded).alias("with_code"), F.min(F.when(there, F.col("submit_day"))).alias("first"), F.max(F.when(there, F.col("submit_day"))).alias("last"))
    total = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("documents", "files", "repeated", "with_events", "listing_only", "with_code")], F.min("first").alias("first_submitted"), F.max("last").alias("last_submitted"), F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct(F.col("kind").alias("type"), F.col("documents").alias("n"))))).alias("types"))
    entities = met.where(there & (F.col("entity") != "")).agg(F.count_distinct("entity").alias("entities"))
    days = events.agg(F.count_distinct("day").alias("list_days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    one = F.broadcast(entities.crossJoin(F.broadcast(days)))  # three tables of one row
    return total.withColumn("without_code", F.col("documents") - F.col("with_code")).crossJoin(one)


def join_summary(joins: DataFrame) -> DataFrame:
    return joins.groupBy("sample_kind").agg(F.count_if(F.col("status") == "PASS").alias("passed"), F.count("*").alias("rows"), F.count_distinct("doc_id").alias("documents"), F.count_distinct("entity").alias("entities"))


def status_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def duplicate_candidates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(duplicates): over all keys, how many rows stand beside a first one."""
    return rows.groupBy(*keys).agg((F.count("*") - 1).alias("more")).agg(F.coalesce(F.sum("more"), F.lit(0)).alias("duplicates"))
