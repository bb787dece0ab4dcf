"""Provider rows as market observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contracts import JST, at_zone, first_reason, market_number


#: The data set whose files are read whatever the windows.
CALENDAR = "markets_calendar"


def project_prices(rows: DataFrame) -> DataFrame:
    """Daily rows (all strings: Date, Code, O, H, L, C, Vo, Va, AdjFactor, ExRT) as unadjusted closes with factor.

    Publication of a daily row isn't recorded, so its availability is null with a reason.
    """
    close, bad_close = market_number(F.col("C"))
    factor, bad_factor = market_number(F.col("AdjFactor"))
    empty = F.lit(True)
    for c in ("O", "H", "L", "C", "Vo", "Va"):
        empty = empty & (F.col(c).isNull() | (F.col(c) == ""))
    return rows.select(
        F.col("Code").alias("code"),
        F.col("Date").try_cast("date").alias("day"),
        close.alias("close"),
        factor.alias("factor"),
        F.col("ExRT").alias("action_type"),
        F.lit("reported_unadjusted").alias("basis"),
        F.lit(None).cast("timestamp").alias("available_at"),
        F.coalesce(bad_close, bad_factor, F.lit("daily_row_publication_time_not_recorded")).alias("missing_reason"),
        F.when(empty, "no_trade_reason_unknown").otherwise("intraday_status_not_provided").alias("trading_status"),
    )


# The channel and the endpoint of daily rows whose schedule is published, and the evidence that it gives.
BULK, DAILY, SCHEDULE = "bulk_csv", "/equities/bars/daily", "official_provider_schedule_reconstruction"


def price_availability(prices: DataFrame, channels: DataFrame) -> DataFrame:
    """prices(day, file, sha256, ...) with available_at, evidence and missing_reason: the next local midnight for files of a verified bulk channel only.

    channels: file, status, channel, endpoint, file_sha256, as bulk_channels gives them; a file's bytes must be those that its channel was verified with.
    """
    fits = (F.col("status") == "PASS") & (F.col("channel") == BULK) & (F.col("endpoint") == DAILY)
    bulk = channels.where(fits).select("file", F.col("file_sha256").alias("sha256")).distinct().withColumn("bulk", F.lit(True))
    out = prices.drop("available_at", "missing_reason", "evidence").join(bulk, ["file", "sha256"], "left")
    at = at_zone(F.date_add("day", 1).cast("timestamp"), JST)
    return out.withColumn("available_at", F.when(F.col("bulk"), at)).withColumn("evidence", F.when(F.col("bulk"), SCHEDULE).otherwise("unknown")).withColumn("missing_reason", F.when(F.col("bulk").isNull(), "acquisition_channel_unknown")).drop("bulk")


def bulk_channels(manifests: DataFrame, files: DataFrame, listing: DataFrame) -> DataFrame:
    """(file, status, channel, endpoint, file_sha256, missing_reason) of files whose data set has a manifest: whether they came by the bulk channel.

    manifests: dataset, mode, endpoint, list_sha256 (of the list that it was made from), listed_sha256 (of the list's bytes now). files: dataset, file, source_key,
    bytes, sha256. listing: dataset, key, size. Each file's key must stand once on the list, with its size. One check that fails
    blocks all files of the data set.
    """
    once = listing.groupBy("dataset", F.col("key").alias("source_key")).agg(F.count("*").alias("n"), F.min("size").alias("size"))
    tied = F.col("n").eqNullSafe(F.lit(1).cast("bigint")) & F.col("size").eqNullSafe(F.col("bytes"))
    whole = files.join(once, ["dataset", "source_key"], "left").groupBy("dataset").agg(F.bool_and(tied).alias("tied"))
    endpoint = F.concat(F.lit("/"), F.replace("dataset", F.lit("_"), F.lit("/")))
    judged = manifests.join(whole, "dataset", "left").select("dataset", endpoint.alias("to"), first_reason(
        (~F.col("mode").eqNullSafe(F.lit("bulk")) | ~F.col("endpoint").eqNullSafe(endpoint), "acquisition_channel_unknown"),
        (~F.col("list_sha256").eqNullSafe(F.col("listed_sha256")), "bulk_list_integrity_failed"),
        (~F.col("tied"), "bulk_channel_file_mismatch"),
    ).alias("missing_reason"))
    good = F.col("missing_reason").isNull()
    return files.join(judged, "dataset").select("file", F.when(good, "PASS").otherwise("BLOCKED").alias("status"), F.when(good, BULK).alias("channel"), F.when(good, F.col("to")).alias("endpoint"), F.when(good, F.col("sha256")).alias("file_sha256"), "missing_reason")


def unpivot_financials(rows: DataFrame, keys: list[str], fields: dict[str, tuple[str, str, str]]) -> DataFrame:
    """One row per (keys, field) with metric, kind, unit and value; empty cells yield nothing.

    fields: column -> (metric, period kind, unit).
    """
    long = rows.unpivot(keys, list(fields), "field", "value").where("value is not null and value <> ''")
    said = F.create_map(*[F.lit(x) for c, v in fields.items() for x in (c, "|".join(v))])
    parts = F.split(said[F.col("field")], r"\|")
    return long.select(*keys, "field", parts[0].alias("metric"), parts[1].alias("kind"), parts[2].alias("unit"), "value")


# Annual reports by document type, and their fields as (metric, period kind, unit), by standard and scope where they differ.
STATEMENTS = {"FYFinancialStatements_Consolidated_JP": ("consolidated", "JP GAAP"), "FYFinancialStatements_NonConsolidated_JP": ("standalone", "JP GAAP"), "FYFinancialStatements_Consolidated_IFRS": ("consolidated", "IFRS"), "FYFinancialStatements_NonConsolidated_IFRS": ("standalone", "IFRS")}
FINANCIALS = {
    "Sales": ({"JP GAAP": "revenue_sales", "IFRS": "revenue_ifrs"}, "duration", "JPY"),
    "OP": ("operating_profit", "duration", "JPY"),
    "NP": ({"consolidated": "net_profit_owners", "standalone": "net_profit_total"}, "duration", "JPY"),
    "TA": ("assets_total", "instant", "JPY"),
    "CFO": ("cfo", "duration", "JPY"),
    "CFI": ("cfi", "duration", "JPY"),
    "EPS": ("eps_basic_reported", "duration", "JPY/share"),
    "BPS": ({"JP GAAP": "bps_net_assets_reported", "IFRS": "bps_definition_unresolved"}, "instant", "JPY/share"),
    "Eq": ({"JP GAAP": "net_assets_total", "IFRS": "equity_definition_unresolved"}, "instant", "JPY"),
    "ShOutFY": ("shares_issued_gross", "instant", "shares"),
}


def financial_observations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Annual report rows (texts: DocType, CurPerType, CurPerSt, CurPerEn, DiscDate, DiscTime, RetroRst and FINANCIALS' columns) as one row a field.

    Returns keys, field, metric, period_kind, period_class, period_start, period_end, instant_date, unit, scope, standard, value, reason,
    restated, public_at. Rows of other kinds, without a full time or with a reversed period give nothing; an empty field is a row of no value.
    """
    said = F.create_map(*[F.lit(x) for k, v in STATEMENTS.items() for x in (k, "|".join(v))])
    own = rows.withColumn("_said", said[F.col("DocType")]).where(F.col("_said").isNotNull() & (F.col("CurPerType") == "FY") & F.col("DiscTime").rlike(r"^\d{2}:\d{2}:\d{2}$"))
    start, end = F.col("CurPerSt").try_cast("date"), F.col("CurPerEn").try_cast("date")
    at = at_zone(F.concat_ws(" ", "DiscDate", "DiscTime").try_cast("timestamp"), JST)
    own = own.withColumns({"_start": start, "_end": end, "_at": at}).where("_start <= _end and _at is not null")
    long = own.unpivot([*keys, "_said", "_start", "_end", "_at", "RetroRst"], list(FINANCIALS), "field", "text")
    scope, standard = (F.split("_said", r"\|")[i] for i in (0, 1))
    metric, kind, unit = (F.lit(None).cast("string") for _ in range(3))
    for name, (m, k, u) in FINANCIALS.items():
        here = F.col("field") == name
        if isinstance(m, dict):
            by = F.lit(None).cast("string")
            for of, text in m.items():
                by = F.when((scope == of) | (standard == of), text).otherwise(by)
        else:
            by = F.lit(m)
        metric, kind, unit = F.when(here, by).otherwise(metric), F.when(here, k).otherwise(kind), F.when(here, u).otherwise(unit)
    value, reason = market_number(F.col("text"))
    lasting = kind == "duration"
    restated = F.col("RetroRst").isNotNull() & ~F.col("RetroRst").isin("", "false", "False", "0")
    return long.select(*keys, "field", metric.alias("metric"), kind.alias("period_kind"), F.when(lasting, "annual").otherwise("instant").alias("period_class"), F.when(lasting, F.col("_start")).alias("period_start"), F.when(lasting, F.col("_end")).alias("period_end"), F.when(~lasting, F.col("_end")).alias("instant_date"), unit.alias("unit"), scope.alias("scope"), standard.alias("standard"), value.alias("value"), reason.alias("reason"), restated.alias("restated"), F.col("_at").alias("public_at"))


def retention_gate(day: Column, now: Column, years: int = 10, margin_days: int = 31) -> Column:
    """outside, boundary or ok: how a day stands to the end of a retention period of years."""
    edge = F.add_months(now, -12 * years)
    return F.when(day < edge, "outside").when(day < F.date_add(edge, margin_days), "boundary").otherwise("ok")


def overlapping(manifest: DataFrame, windows: DataFrame) -> DataFrame:
    """The manifest's files whose [first, last] days overlap any of windows(first_day, last_day).

    manifest: dataset, revision, file, first, last. Fails if a dataset has several revisions. The calendar's files are always taken.
    Windows are merged into days first, so files and windows meet by the days that they share.
    """
    if manifest.groupBy("dataset").agg(F.count_distinct("revision").alias("n")).where("n > 1").limit(1).count():
        raise ValueError("several revisions of one dataset")
    days = windows.select(F.explode(F.sequence("first_day", "last_day")).alias("day")).distinct()
    open_ = manifest.where(F.col("first") <= F.col("last")).select("dataset", "file", F.explode(F.sequence("first", "last")).alias("day")).join(days, "day", "left_semi").select("dataset", "file").distinct()
    return manifest.where(F.col("dataset") == CALENDAR).unionByName(manifest.where(F.col("dataset") != CALENDAR).join(open_, ["dataset", "file"], "left_semi"))


def retained(rows: DataFrame, codes: DataFrame, windows: DataFrame) -> DataFrame:
    """The rows (code, day, ...) of codes(code) in any of windows(code, first_day, last_day)."""
    w = windows.withColumnRenamed("code", "window_code")
    return rows.join(codes, "code", "left_semi").join(w, (F.col("code") == F.col("window_code")) & F.col("day").between(F.col("first_day"), F.col("last_day")), "left_semi")


def bulk_tie(files: DataFrame, listing: DataFrame) -> DataFrame:
    """files(file, key, size) with a reason unless listing(key, size) has exactly one entry of that key and size."""
    once = listing.groupBy("key").agg(F.count("*").alias("n"), F.min("size").alias("listed"))
    reason = F.when(F.col("n").isNull(), "bulk_entry_missing").when(F.col("n") > 1, "bulk_entry_ambiguous").when(F.col("listed") != F.col("size"), "bulk_size_mismatch")
    return files.join(once, "key", "left").select("file", "key", "size", reason.alias("missing_reason"))
