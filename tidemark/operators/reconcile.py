"""Comparisons within a source, across sources and against originals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contracts import NOT_SPACE, first_reason, not_finite, reasons, scalar_equal, squeezed, value_class


def within_source(facts: DataFrame, group: list[str]) -> DataFrame:
    """(a, b, classes) for each unordered pair of facts of one group.

    facts: fact_id, doc_id, root, scope, standard, unit, key, value and the group's columns. Scope, standard and unit
    differences come first (a null adds one `unresolved`), then the documents' relation; only without any is the value
    compared. Pairs are made inside groups alone.
    """
    on = F.col("x.fact_id") < F.col("y.fact_id")
    for c in group:
        on = on & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    pair = facts.alias("x").join(facts.alias("y"), on)

    def differs(c: str) -> Column:
        return F.col(f"x.{c}") != F.col(f"y.{c}")

    def unknown(c: str) -> Column:
        return F.col(f"x.{c}").isNull() | F.col(f"y.{c}").isNull()

    names = ("scope", "standard", "unit")
    said = [(F.coalesce(differs(c), F.lit(False)), f"{'accounting_standard' if c == 'standard' else c}_difference", unknown(c)) for c in names]
    parts, before = [], F.lit(False)
    for diff, name, null in said:
        parts.append(F.when(null & ~before, "unresolved").when(diff, name))
        before = before | null
    other_doc = F.col("x.doc_id") != F.col("y.doc_id")
    related = F.coalesce(F.col("x.root") == F.col("y.root"), F.lit(False))
    parts.append(F.when(other_doc & related, "restatement_difference").when(other_doc, "unresolved"))
    found = F.array_compact(F.array(*parts))
    value = F.when(unknown("value"), "unresolved").when(scalar_equal(F.col("x.value"), F.col("y.value")), "exact_match").otherwise("conflicting_facts")
    rest = F.when(differs("key"), "unresolved").otherwise(value)
    return pair.select(F.col("x.fact_id").alias("a"), F.col("y.fact_id").alias("b"), F.when(F.size(found) > 0, found).otherwise(F.array(rest)).alias("classes"))


def pair_counts(facts: DataFrame, group: list[str]) -> DataFrame:
    """(group, classes, pairs): how often within_source gives each list of classes in each group, without making the pairs.

    What two facts differ in depends on their (scope, standard, unit), on whether they share a document or a root, and only for facts that share all of it
    on key and value. So facts are counted by those, and pairs of counts are multiplied: all pairs of two kinds, less those of one root, less those of one
    document. A group's rows are few kinds, however many facts it has. fact_ids are unique.
    """
    kind = F.struct("scope", "standard", "unit")
    rows = facts.select(*group, "doc_id", "root", "key", kind.alias("kind"), value_class(F.col("value")).alias("v"), F.col("value").isNull().alias("empty"), not_finite(F.col("value")).alias("odd"))
    fine = rows.groupBy(*group, "root", "doc_id", "kind").agg(F.count("*").alias("n"))
    rooted = fine.where("root is not null")

    def crossed(counts: DataFrame, on: list[str], name: str) -> DataFrame:
        """Pairs of rows of two kinds that agree on `on`; those that there are none of are left out."""
        kinds = counts.groupBy(*on, "kind").agg(F.sum("n").alias("n")).groupBy(*on).agg(F.collect_list(F.struct("kind", "n")).alias("ks"))  # a group has few kinds
        kinds = kinds.where((F.size("ks") > 1) | (F.col("ks")[0]["n"] > 1))
        x = kinds.select(*group, "ks", F.explode("ks").alias("x")).select(*group, "x", F.explode("ks").alias("y")).where("y.kind >= x.kind")
        m = F.when(F.col("x.kind") == F.col("y.kind"), (F.col("x.n") * (F.col("x.n") - 1) / 2).cast("bigint")).otherwise(F.col("x.n") * F.col("y.n"))
        return x.select(*group, F.col("x.kind").alias("x"), F.col("y.kind").alias("y"), F.lit(name).alias("what"), m.alias("m")).where("m > 0")

    counts = crossed(fine, group, "every").union(crossed(fine, [*group, "doc_id"], "doc")).union(crossed(rooted, [*group, "root"], "root")).union(crossed(rooted, [*group, "root", "doc_id"], "both"))
    met = counts.groupBy(*group, "x", "y").agg(*[F.sum(F.when(F.col("what") == name, F.col("m")).otherwise(0)).alias(name) for name in ("every", "doc", "root", "both")])
    parts, before = [], F.lit(False)
    for c in ("scope", "standard", "unit"):
        null = F.col(f"x.{c}").isNull() | F.col(f"y.{c}").isNull()
        name = f"{'accounting_standard' if c == 'standard' else c}_difference"
        parts.append(F.when(null & ~before, "unresolved").when(F.coalesce(F.col(f"x.{c}") != F.col(f"y.{c}"), F.lit(False)), name))
        before = before | null
    met, base = met.withColumn("base", F.array_compact(F.array(*parts))), F.col("base")
    restated, apart = F.col("root") - F.col("both"), F.col("every") - F.col("doc") - (F.col("root") - F.col("both"))
    told = F.array(F.struct(F.array_append(base, F.lit("restatement_difference")).alias("c"), restated.alias("n")), F.struct(F.array_append(base, F.lit("unresolved")).alias("c"), apart.alias("n")), F.struct(base.alias("c"), F.when(F.size(base) > 0, F.col("doc")).otherwise(0).alias("n")))
    out = met.select(*group, F.explode(F.filter(told, lambda t: t["n"] > 0)).alias("t")).select(*group, F.col("t.c").alias("classes"), F.col("t.n").alias("pairs"))

    # within one document and kind that lacks nothing: other keys, then values
    full = rows.where("kind.scope is not null and kind.standard is not null and kind.unit is not null")

    def two(n: Column) -> Column:
        return (n * (n - 1) / 2).cast("bigint")

    alike = full.groupBy(*group, "doc_id", "kind", "key", "v", "odd", "empty").agg(F.count("*").alias("n"))
    keyed = alike.groupBy(*group, "doc_id", "kind", "key").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("empty"), F.col("n")).otherwise(0)).alias("none"), F.sum(F.when(F.col("empty") | F.col("odd"), F.lit(0)).otherwise(two(F.col("n")))).alias("equal"))
    mine = keyed.groupBy(*group, "doc_id", "kind").agg(F.sum("n").alias("n"), F.sum(two(F.col("n")) - two(F.col("n") - F.col("none"))).alias("unknown"), F.sum("equal").alias("equal"), F.sum(two(F.col("n"))).alias("judged"))
    told = F.array(F.struct(F.array(F.lit("unresolved")).alias("c"), (two(F.col("n")) - F.col("judged") + F.col("unknown")).alias("n")), F.struct(F.array(F.lit("exact_match")).alias("c"), F.col("equal").alias("n")), F.struct(F.array(F.lit("conflicting_facts")).alias("c"), (F.col("judged") - F.col("unknown") - F.col("equal")).alias("n")))
    rest = mine.where("n > 1").select(*group, F.explode(F.filter(told, lambda t: t["n"] > 0)).alias("t")).select(*group, F.col("t.c").alias("classes"), F.col("t.n").alias("pairs"))
    return out.union(rest).where("pairs > 0").groupBy(*group, "classes").agg(F.sum("pairs").alias("pairs"))


#: Units whose values count shares or are stated for one, so that they compare only on one share basis.
SHARE_UNITS = ("shares", "JPY/share")
#: Fixed value: the state of another source's row that isn't known to be revised.
FIRST_STATE = "reported_initial_or_unknown"


def across_sources(left: DataFrame, right: DataFrame, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """(keys, fact_id, other_id, classes, numeric): every left fact against the right's facts of its keys.

    fields: column -> class if it differs. Both sides: fact_id, value, available_at, unit, share_basis, those columns; left: is_revision, identity_verified,
    decision_at, n_dimensions; right: restated, revision_state. A left fact of dimensions has another scope than any whole; values of SHARE_UNITS need one share basis;
    a right fact of another state than FIRST_STATE (null too) is a revision. Unmatched facts are unresolved. A time that is null is unresolved and
    counts as future. Values are compared only for verified identities, nothing future, and no difference but timing or revision. Null flags count as false,
    but an identity must be known to be verified.
    """
    taken = ("value", "available_at", "unit", "share_basis", *fields)
    r = right.select(*keys, F.col("fact_id").alias("other_id"), F.coalesce("restated", F.lit(False)).alias("restated"), "revision_state", *[F.col(c).alias(f"o_{c}") for c in dict.fromkeys(taken)])
    met = left.join(r, keys, "left")

    def unlike(c: str) -> Column:
        return ~F.col(c).eqNullSafe(F.col(f"o_{c}"))

    there, verified = F.col("other_id").isNotNull(), F.coalesce("identity_verified", F.lit(False))
    untimed = F.col("available_at").isNull() | F.col("o_available_at").isNull() | F.col("decision_at").isNull()
    future = untimed | (F.greatest("available_at", "o_available_at") >= F.col("decision_at"))
    checks = [(~verified, "unresolved"), *[(unlike(c), name) for c, name in fields.items()]]
    checks += [
        (F.coalesce("n_dimensions", F.lit(0)) > 0, "scope_difference"),
        (F.col("unit").isin(*SHARE_UNITS) & unlike("share_basis"), "definition_difference"),
        (F.coalesce("is_revision", F.lit(False)) | F.col("restated") | ~F.col("revision_state").eqNullSafe(F.lit(FIRST_STATE)), "revision_difference"),
        (untimed, "unresolved"),
        (~untimed & (future | (F.col("available_at") != F.col("o_available_at"))), "timing_difference"),
        (F.col("value").isNull() | F.col("o_value").isNull(), "unresolved"),
    ]
    met = met.withColumn("so_far", F.array_distinct(reasons(*checks)))
    open_ = verified & ~future & (F.size(F.array_except("so_far", F.array(F.lit("timing_difference"), F.lit("revision_difference")))) == 0)
    met = met.withColumn("numeric", F.when(there & open_, F.when(scalar_equal(F.col("value"), F.col("o_value")), "equal").otherwise("different")))
    told = F.when(F.col("numeric") == "equal", "exact_match").when(F.col("numeric") == "different", "value_conflict")
    classes = F.when(there, F.array_sort(F.array_compact(F.array_append("so_far", told)))).otherwise(F.array().cast("array<string>"))
    return met.select(*keys, "fact_id", "other_id", F.when(F.size(classes) == 0, F.array(F.lit("unresolved"))).otherwise(classes).alias("classes"), "numeric")


def compare_facts(rows: DataFrame, originals: DataFrame, stages: list[tuple[str, str, str]], text: Column | None = None, keys: list[str] = ()) -> DataFrame:
    """(row_id, verdict, reason, origins): provider rows against the originals of the same `keys` (their document), stage by stage.

    stages: (column, class, reason) in order; the first stage where no original is left gives its class. What is left must
    be one original (else unresolved), of the same unit, and equal in value: numbers as numbers, texts without white space.
    rows: row_id, unit, value, keys, the stages' columns, and is_nil if the provider states it; originals: origin_id, unit,
    value, is_nil, keys, the stages' columns, and, if known, context_ambiguous and unit_ambiguous.
    """
    first = stages[0][0]
    unsure = [F.coalesce(F.col(c), F.lit(False)).alias(c) if c in originals.columns else F.lit(False).alias(c) for c in ("context_ambiguous", "unit_ambiguous")]
    o = originals.select(F.col("origin_id"), F.col("unit").alias("o_unit"), F.col("value").alias("o_value"), "is_nil", *unsure, *[F.col(c).alias(f"o_{c}") for c, _, _ in stages], *[F.col(k).alias(f"o_{k}") for k in keys]).withColumnRenamed("is_nil", "o_nil")
    on = F.col(first) == F.col(f"o_{first}")
    for k in keys:
        on = on & (F.col(k) == F.col(f"o_{k}"))
    said_nil = F.col("is_nil") if "is_nil" in rows.columns else F.lit(None).cast("boolean")
    met = rows.withColumn("said_nil", said_nil).join(o, on, "left")
    fit = F.col("origin_id").isNotNull()
    counts = []
    for i, (c, _, _) in enumerate(stages):
        fit = fit & F.coalesce(F.col(c) == F.col(f"o_{c}"), F.lit(False))
        counts.append(F.count_if(fit).alias(f"n{i}"))
    last = F.when(fit, F.struct("origin_id", "o_unit", "o_value", F.col("o_nil").alias("is_nil"), "context_ambiguous", "unit_ambiguous"))
    ids = F.array_sort(F.collect_set(F.when(fit, F.col("origin_id"))))
    grouped = met.groupBy("row_id").agg(*counts, F.min(last).alias("f"), ids.alias("origins"), F.first("unit").alias("unit"), F.first("value").alias("value"), F.first("said_nil").alias("said_nil"), *([F.first(text).alias("is_text")] if text is not None else []))
    is_text = F.col("is_text") if text is not None else F.lit(False)
    same = F.when(is_text, (squeezed(F.coalesce("value", F.lit(""))) != "") & (squeezed(F.col("value")) == squeezed(F.col("f.o_value")))).otherwise(scalar_equal(F.col("value"), F.col("f.o_value")))
    empty = F.col("value").isNull() | (F.col("value") == "")
    ladder = [(F.col(f"n{i}") == 0, kind, why) for i, (_, kind, why) in enumerate(stages)]
    ladder += [
        (F.col(f"n{len(stages) - 1}") > 1, "unresolved", "original_element_ambiguous"),
        (F.col("f.context_ambiguous"), "unresolved", "original_context_ambiguous"),
        (F.col("said_nil") != F.col("f.is_nil"), "extraction_difference", "nil_state_differs"),
        (~F.col("unit").eqNullSafe(F.col("f.o_unit")), "unit_difference", "unit_ref_differs"),
        (F.col("f.o_unit").isNotNull() & F.col("f.unit_ambiguous"), "unresolved", "original_unit_ambiguous"),
        (F.col("f.is_nil") & ~empty, "extraction_difference", "nil_value_differs"),
        (~F.col("f.is_nil") & ~F.coalesce(same, F.lit(False)) & is_text, "text_difference", "provider_value_differs"),
        (~F.col("f.is_nil") & ~F.coalesce(same, F.lit(False)), "extraction_difference", "provider_value_differs"),
    ]
    step = F.when(ladder[0][0], 0)
    for i, (holds, _, _) in enumerate(ladder[1:], 1):
        step = step.when(holds, i)
    kinds, whys = (F.get(F.array(*[F.lit(rung[i]) for rung in ladder]), F.col("step")) for i in (1, 2))
    return grouped.withColumn("step", step).select("row_id", F.coalesce(kinds, F.lit("exact_match")).alias("verdict"), whys.alias("reason"), "origins")


def document_link(rows: DataFrame, documents: DataFrame, fields: dict[str, str]) -> DataFrame:
    """rows(row_id, doc_id, submitted, fields...) with a reason unless every field supplied agrees with the document.

    fields: column -> reason. An empty text equals null. Submit dates are compared as days, times in
    the document's precision.
    """
    d = documents.select("doc_id", F.col("submitted").alias("d_submitted"), F.lit(True).alias("known"), *[F.col(c).alias(f"d_{c}") for c in fields])
    met = rows.join(d, "doc_id", "left")

    def blank(c: str) -> Column:
        return F.when(F.col(c) != "", F.col(c))

    width = F.when(F.length("submitted") == 10, 10).otherwise(F.length("d_submitted"))
    late = F.col("submitted").isNotNull() & (F.coalesce(F.col("d_submitted"), F.lit("")) == "")
    checks = [(F.col("known").isNull(), "document_id_mismatch")]
    checks += [(F.col(c).isNotNull() & ~blank(c).eqNullSafe(blank(f"d_{c}")), why) for c, why in fields.items()]
    checks += [(late | (F.substring(F.replace("submitted", F.lit("T"), F.lit(" ")), F.lit(1), width) != F.substring("d_submitted", F.lit(1), width)), "submit_time_mismatch")]
    return met.select("row_id", "doc_id", first_reason(*checks).alias("missing_reason"))


def link_grid(documents: DataFrame, providers: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, provider, n, state): each selected document and each of the few providers, linked by none, one or many rows."""
    n = rows.groupBy("doc_id", "provider").agg(F.count("*").alias("n"))
    names = [r[0] for r in providers.select("provider").distinct().collect()]
    grid = documents.select("doc_id").distinct().withColumn("provider", F.explode(F.array(*[F.lit(p) for p in sorted(names)])))
    out = grid.join(n, ["doc_id", "provider"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("state", F.when(F.col("n") == 0, "missing").when(F.col("n") == 1, "linked").otherwise("ambiguous"))


def dimensions_difference(a: Column, b: Column, scope_axis: str) -> Column:
    """null if two arrays of (axis, member) are the same set; scope_difference if the scope axis is in either."""
    named = F.exists(F.concat(a, b), lambda d: d["axis"] == scope_axis)
    return F.when(F.array_sort(a).eqNullSafe(F.array_sort(b)), None).when(named, "scope_difference").otherwise("context_difference")


def compare_contexts(rows: DataFrame, contexts: DataFrame, fields: list[str], scope_axis: str | None = None) -> DataFrame:
    """(row_id, verdict): rows against the one context of their doc_id and context_id.

    With a scope axis, dimensions (arrays of axis, member) are compared after the fields, in any order.
    """
    dims = [F.first("dimensions").alias("c_dimensions")] if scope_axis else []
    once = contexts.groupBy("doc_id", "context_id").agg(F.count("*").alias("n"), *[F.min(c).alias(f"c_{c}") for c in fields], *dims)
    met = rows.join(once, ["doc_id", "context_id"], "left")
    apart = dimensions_difference(F.col("dimensions"), F.col("c_dimensions"), scope_axis) if scope_axis else F.lit(None).cast("string")
    differs = F.lit(False)
    for c in fields:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"c_{c}"))
    return met.select("row_id", F.when(F.coalesce("n", F.lit(0)) != 1, "unresolved").when(differs, "context_difference").otherwise(F.coalesce(apart, F.lit("exact_match"))).alias("verdict"))


SUMMATION = "http://www.xbrl.org/2003/arcrole/summation-item"


def compare_arcs(rows: DataFrame, arcs: DataFrame) -> DataFrame:
    """(row_id, verdict): summation arcs on (doc_id, role, parent, child), then weight and order as numbers."""
    once = arcs.where(F.col("arcrole") == SUMMATION).groupBy("doc_id", "role", "parent", "child").agg(F.count("*").alias("n"), F.min("weight").alias("o_weight"), F.min("ord").alias("o_ord"))
    met = rows.join(once, ["doc_id", "role", "parent", "child"], "left")
    same = scalar_equal(F.col("weight"), F.col("o_weight")) & scalar_equal(F.col("ord"), F.col("o_ord"))
    return met.select("row_id", F.when(F.coalesce("n", F.lit(0)) != 1, "unresolved").when(same, "exact_match").otherwise("extraction_difference").alias("verdict"))


def flattened_arcs(rows: DataFrame, arcs: DataFrame) -> DataFrame:
    """(row_id, verdict, candidates): rows that name concepts only are never verified; arcs of the same document that fit are kept."""
    met = rows.join(arcs.withColumnRenamed("doc_id", "d"), (F.col("doc_id") == F.col("d")) & F.col("child").contains(F.col("child_concept")) & F.col("parent").contains(F.col("parent_concept")), "left")
    return met.groupBy("row_id").agg(F.lit("unresolved").alias("verdict"), F.array_sort(F.collect_set("origin_id")).alias("candidates"))


def coalesce_components(wanted: DataFrame, rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The rows of the first tag, by priority, that a field has any of; all ties stay.

    wanted: want_id, doc_id, field; rules: field, tag, priority; rows: doc_id, tag, row_id, value.
    """
    met = wanted.join(rules, "field").join(rows.where("value is not null"), ["doc_id", "tag"])
    best = met.groupBy("want_id").agg(F.min("priority").alias("priority"))
    return met.join(best, ["want_id", "priority"]).select("want_id", "row_id", "tag", "value", "priority")


def summary_components(wanted: DataFrame, rows: DataFrame, rules: DataFrame) -> DataFrame:
    """coalesce_components over summary rows only: of the wanted year, and consolidated where the document has any such row.

    wanted: want_id, doc_id, field, year_offset (0, -1, ...); rows: doc_id, tag, context_id, row_id, value; rules: field, tag, priority. Contexts
    are CurrentYear or Prior1Year to Prior4Year, Duration or Instant, with or without the standalone suffix; others don't count.
    """
    parts = [F.regexp_extract("context_id", r"^(CurrentYear|Prior([1-4])Year)(Duration|Instant)(_NonConsolidatedMember)?$", i) for i in (1, 2, 4)]
    own = rows.select("*", parts[0].alias("_year"), F.when(parts[1] == "", 0).otherwise(-parts[1].try_cast("int")).alias("year_offset"), (parts[2] == "").alias("_group")).where("_year <> ''")
    best = own.groupBy("doc_id").agg(F.bool_or("_group").alias("_group"))
    picked = own.join(best, ["doc_id", "_group"]).where("value is not null")
    met = wanted.join(rules, "field").join(picked.select("doc_id", "tag", "year_offset", "row_id", "value"), ["doc_id", "tag", "year_offset"])
    first = met.groupBy("want_id").agg(F.min("priority").alias("priority"))
    return met.join(first, ["want_id", "priority"]).select("want_id", "row_id", "tag", "value", "priority")


def text_tie(rows: DataFrame, elements: DataFrame, keys: list[str], many: int = 1000, salts: int = 64) -> DataFrame:
    """(row_id, n, first): number and least id of the elements of the same keys whose text is equal without white space.

    Empty texts tie with nothing and are left out; without a tie n is 0. Each row meets one row per text; those
    of texts that `many` elements or more have are dealt over `salts` parts.
    """
    def hashed(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("text").rlike(NOT_SPACE)).select(*keys, F.sha2(squeezed(F.col("text")), 256).alias("h"), name)

    ties = hashed(elements, "origin_id").distinct().groupBy(*keys, "h").agg(F.count("*").alias("n"), F.min("origin_id").alias("first"))
    dealt = hashed(rows, "row_id").withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int"))
    large = ties.where(F.col("n") >= many).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = dealt.join(large, [*keys, "h", "salt"], "left")
    met = met.withColumn("h", F.when(F.col("n").isNull(), F.col("h")).otherwise(F.xxhash64("row_id").cast("string")))  # those that have met one are dealt by row
    small = ties.where(F.col("n") < many).withColumnsRenamed({"n": "few", "first": "least"})
    return met.join(small, [*keys, "h"], "left").select("row_id", F.coalesce("n", "few", F.lit(0)).alias("n"), F.coalesce("first", "least").alias("first"))


def reverse_lookup(stored: DataFrame, reread: DataFrame, at: list[str], value: str) -> DataFrame:
    """(mismatches, missing): stored rows against a second reading by locator."""
    r = reread.select(*at, F.col(value).alias("again"), F.lit(True).alias("there"))
    return stored.join(r, at, "left").agg(F.count_if(F.col("there") & ~F.col(value).eqNullSafe(F.col("again"))).alias("mismatches"), F.count_if(F.col("there").isNull()).alias("missing"))
