"""Deterministic samples: hash ranks, canonical rows, probability and challenge samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILLED = ("reporting_entity_diversity", "fixed_rank_fill")


def hash_of(seed: str, key: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def hash_ranked(rows: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """(key, hash) of the n rows first by the hash of seed and key, then by key."""
    return rows.select(key, hash_of(seed, F.col(key)).alias("hash")).orderBy("hash", key).limit(n)


def first_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each key's first row by `order`, without sorting: columns other than keys and order ride along."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def canonical_event(events: DataFrame) -> DataFrame:
    """Each document's event of its submit day, else the first by (day, seq): events(doc_id, day, seq, submit_day, ...). Events of one day and
    number are told apart by the other columns in their order, nulls first."""
    rest = [c for c in events.columns if c != "doc_id"]
    other = ~F.coalesce(F.col("day") == F.col("submit_day"), F.lit(False))
    return events.groupBy("doc_id").agg(F.min_by(F.struct(*rest), F.struct(other.alias("other"), "day", "seq", *[c for c in rest if c not in ("day", "seq")])).alias("r")).select("doc_id", *[F.col(f"r.{c}").alias(c) for c in rest])


def screening_list(frames: list[DataFrame], key: str, limit: int) -> DataFrame:
    """(key, place): the first occurrence of each key over frames in order, each ranked by its `rank` column."""
    parts = [f.select(key, F.lit(i).alias("part"), "rank") for i, f in enumerate(frames)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p)
    return rows.groupBy(key).agg(F.min(F.struct("part", "rank")).alias("place")).orderBy("place", key).limit(limit)


def screening(docs: DataFrame, categories: list[str], seed: str, prefix: int, each: int, limit: int) -> DataFrame:
    """(doc_id, place): the first `prefix` of docs(doc_id, cats) by hash, then the first `each` of every category, then all by hash."""
    ranked = docs.select("doc_id", F.coalesce("cats", F.array().cast("array<string>")).alias("cats"), hash_of(seed, F.col("doc_id")).alias("rank"))
    order = ranked.select("doc_id", "rank").orderBy("rank", "doc_id")
    heads = [ranked.where(F.array_contains("cats", c)).select("doc_id", "rank").orderBy("rank", "doc_id").limit(each) for c in categories]
    return screening_list([order.limit(prefix), *heads, order.limit(limit)], "doc_id", limit)


def page(rows: DataFrame, order: list[str], offset: int = 0, limit: int = 100) -> tuple[DataFrame, DataFrame]:
    """(the page, its one-row summary total, offset, limit, truncated); limit is 1 to 1000."""
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("limit must be 1 to 1000 and offset not negative")
    total = rows.agg(F.count("*").alias("total")).select("total", F.lit(offset).alias("offset"), F.lit(limit).alias("limit"), (F.col("total") > offset + limit).alias("truncated"))
    return rows.orderBy(*order).offset(offset).limit(limit), total


def challenge_sample(docs: DataFrame, categories: list[str], seed: str, probability: int = 15, challenge: int = 20, overlap: str | None = None, target: int = 3) -> tuple[list, list[tuple[object, list[str]]], dict[str, str]]:
    """A probability sample, and a disjoint challenge sample that covers categories in order.

    docs: doc_id, entity, cats (array). By hash rank the first `probability` documents are taken. For each category a
    chosen document that has it is used again, else the best-ranked one is added while the budget lasts; the `overlap`
    category reserves up to `target`. Then new entities by rank, then rank alone fill up. Spark keeps only rows
    that can matter (the best per category, per entity and overall); the greedy choice runs over those.
    """
    ranked = docs.select("doc_id", "entity", F.coalesce("cats", F.array().cast("array<string>")).alias("cats"), hash_of(seed, F.col("doc_id")).alias("h"))
    first = [r["doc_id"] for r in ranked.orderBy("h", "doc_id").limit(probability).collect()]
    entities = {r["entity"] for r in ranked.where(F.col("doc_id").isin(first)).collect()} - {None}
    rest = ranked.where(~F.col("doc_id").isin(first))
    budget = probability + challenge
    per_cat = [rest.where(F.array_contains("cats", c)).orderBy("h", "doc_id").limit(budget) for c in categories]
    leads = rest.where("entity is not null").groupBy("entity").agg(F.min_by(F.struct("doc_id", "entity", "cats", "h"), F.struct("h", "doc_id")).alias("r")).select("r.*").orderBy("h", "doc_id").limit(2 * budget)
    pool = leads.union(rest.orderBy("h", "doc_id").limit(budget))
    for p in per_cat:
        pool = pool.union(p)
    rows = sorted({(r["h"], r["doc_id"], r["entity"], tuple(r["cats"])) for r in pool.collect()}, key=lambda r: (r[0], r[1]))
    chosen: dict = {}
    status = {}
    for c in categories:
        able = [r for r in rows if c in r[3]]
        if c == overlap:
            took = [r for r in able if r[1] in chosen]
            for r in able:
                if len(took) >= target or len(chosen) >= challenge:
                    break
                if r[1] not in chosen:
                    chosen[r[1]] = []
                    took.append(r)
            for r in took:
                chosen[r[1]].append(c)
            status[c] = "PASS" if len(took) >= target else "insufficient_available_overlap_documents"
            continue
        old = next((d for d in chosen if any(r[1] == d for r in able)), None)
        new = old if old is not None else next((r[1] for r in able), None)
        if new is not None and (new in chosen or len(chosen) < challenge):
            chosen.setdefault(new, []).append(c)
            status[c] = "PASS"
        else:
            status[c] = "challenge_budget_exhausted" if able else "not_found_in_available_archive_screen"
    entities |= {r[2] for r in rows if r[1] in chosen} - {None}
    for r in rows:
        if len(chosen) < challenge and r[1] not in chosen and r[2] and r[2] not in entities:
            chosen[r[1]] = [FILLED[0]]
            entities.add(r[2])
    for r in rows:
        if len(chosen) < challenge and r[1] not in chosen:
            chosen[r[1]] = [FILLED[1]]
    return first, list(chosen.items()), status


# The document type of an amended report, industries that are financial or property trusts, and what a year's end less its start may be in days.
AMENDED, FINANCIAL, PROPERTY, YEAR = "130", ("BNK", "INS", "SEC", "銀行業", "保険業", "証券業"), ("REIT", "投資法人"), (363, 366)


def metadata_categories(events: DataFrame, files: DataFrame, big: int = 2 << 20) -> DataFrame:
    """(doc_id, cats) of every document with a file: its categories from metadata alone, in the order of their names here.

    events: doc_id, day, seq, submit_day, entity, name, code, doc_type, parent_id, statuses (array), any number a document; files: doc_id, bytes, a row for each
    file. Type, parent and statuses are taken over all of a document's events, the code from its canonical event; an entity's names and codes
    over all events of all documents with files, and neither needs more than their least and greatest. A document without events has none of these.
    """
    def filled(c: str) -> Column:
        return F.when(F.col(c) != "", F.col(c))

    kept = files.groupBy("doc_id").agg(F.max("bytes").alias("most"))
    rows = events.join(kept.select("doc_id"), "doc_id", "left_semi").withColumns({c: filled(c) for c in ("entity", "name", "parent_id")})
    seen = rows.where("entity is not null").groupBy("entity").agg(*[(F.max(filled(c)) > F.min(filled(c))).alias(f"{c}s") for c in ("code", "name")])
    odd = F.exists("statuses", lambda x: x.isNotNull() & (x != "0"))
    per = rows.groupBy("doc_id").agg(F.max(F.coalesce(F.col("doc_type") == AMENDED, F.lit(False))).alias("amended"), F.max(F.col("parent_id").isNotNull()).alias("parent"), F.max(F.coalesce(odd, F.lit(False))).alias("odd"))
    own = canonical_event(rows.select("doc_id", "day", "seq", "submit_day", "code", "entity")).select("doc_id", "code", "entity", F.lit(True).alias("listed"))
    met = kept.join(per, "doc_id", "left").join(own, "doc_id", "left").join(seen, "entity", "left")
    cats = F.array_compact(F.array(
        F.when(F.col("amended"), "amended_report"), F.when(F.col("parent"), "parent_document"), F.when(F.col("odd"), "unusual_status"), F.when(F.col("listed") & F.col("code").isNull(), "security_code_null"),
        F.when(F.col("code").rlike("[A-Z]"), "alpha_security_code"), F.when(F.col("codes"), "multiple_security_codes"), F.when(F.col("names"), "name_history"), F.when(F.col("most") >= big, "large_zip"),
    ))
    return met.select("doc_id", cats.alias("cats"))


def structure_categories(profile: DataFrame) -> DataFrame:
    """Profiles with `cats` from structure, in the order of their names here.

    profile: doc_id, dei (map of an element's name to the array of its values), dimensions (array of axis, member), loss_fact, shared_tag (one tag in
    several contexts), members, failures (array). A period counts where its start and its end have one value each and both are days.
    Industries count only as the elements say them; null parts say nothing.
    """
    none = F.array().cast("array<string>")

    def said(name: str) -> Column:
        return F.coalesce(F.try_element_at("dei", F.lit(name)), none)

    def only(name: str) -> Column:
        return F.when(F.size(said(name)) == 1, said(name)[0].try_cast("date"))

    dims = F.coalesce("dimensions", F.array().cast(profile.schema["dimensions"].dataType))
    solo = F.exists(dims, lambda d: F.contains(d["member"], F.lit("NonConsolidatedMember")))
    industries = F.flatten(F.map_values(F.map_filter(F.coalesce("dei", F.create_map().cast("map<string,array<string>>")), lambda k, v: F.startswith(k, F.lit("IndustryCode")) & v.isNotNull())))
    segments = F.array_distinct(F.transform(F.filter(dims, lambda d: F.contains(d["axis"], F.lit("Segment")) & F.contains(d["member"], F.lit("Member"))), lambda d: d["member"]))
    whole = "WhetherConsolidatedFinancialStatementsArePreparedDEI"
    cats = F.array_compact(F.array(
        F.when(F.array_contains(said("AccountingStandardsDEI"), "Japan GAAP"), "jp_gaap"), F.when(F.array_contains(said("AccountingStandardsDEI"), "IFRS"), "ifrs"),
        F.when(F.array_contains(said(whole), "true"), "consolidated"), F.when(F.coalesce(F.array_contains(said(whole), "false"), F.lit(False)) | F.coalesce(solo, F.lit(False)), "non_consolidated"),
        F.when(F.col("loss_fact"), "loss_fact"), F.when(~F.datediff(only("CurrentFiscalYearEndDateDEI"), only("CurrentFiscalYearStartDateDEI")).between(*YEAR), "fiscal_period_change_cue"),
        F.when(F.arrays_overlap(industries, F.array(*map(F.lit, FINANCIAL))), "financial"), F.when(F.arrays_overlap(industries, F.array(*map(F.lit, PROPERTY))), "reit"),
        F.when(F.size(segments) >= 2, "multiple_segments"), F.when(F.col("members") > 1, "multiple_xbrl_members"), F.when(F.col("shared_tag"), "same_tag_multiple_contexts"), F.when(F.size("failures") > 0, "screening_failure"),
    ))
    return profile.withColumn("cats", cats)
