"""Scalar rules shared by all operators: reasons, numbers, times, identifiers, ids."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JST = "Asia/Tokyo"
#: Unicode white space, which Java's \s leaves out.
UNICODE_SPACE = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
NOT_SPACE = UNICODE_SPACE[:-1].replace("[", "[^", 1)
#: The same characters, each by itself.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


# -- reasons ---------------------------------------------------------------------------------------


def first_reason(*checks: tuple[Column, str | Column]) -> Column:
    """The reason of the first check that holds, in order; null if none does. A null check doesn't hold."""
    return F.coalesce(*[F.when(cond, F.lit(r) if isinstance(r, str) else r) for cond, r in checks], F.lit(None).cast("string"))


def first_number(*checks: Column) -> Column:
    """The place, from 0, of the first check that holds; null if none does. It goes through joins and counts as one small number instead of a reason's text."""
    return F.coalesce(*[F.when(cond, F.lit(i)) for i, cond in enumerate(checks)], F.lit(None).cast("int"))


def reasons(*checks: tuple[Column, str]) -> Column:
    """The reasons of all checks that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(r)) for cond, r in checks]))


def gate(df: DataFrame, reason: Column, masked: tuple[str, ...] = ()) -> DataFrame:
    """df with missing_reason and status (PASS or BLOCKED); `masked` columns are null where blocked."""
    out = df.withColumn("missing_reason", reason).withColumn("status", F.when(F.col("missing_reason").isNull(), "PASS").otherwise("BLOCKED"))
    return out.withColumns({c: F.when(F.col("status") == "PASS", F.col(c)) for c in masked})


def guard(df: DataFrame, broken: Column, message: str) -> DataFrame:
    """df; reading it fails with `message` if a row breaks the contract."""
    return df.where(F.when(F.coalesce(broken, F.lit(False)), F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


def require_unique(df: DataFrame, keys: list[str], message: str) -> None:
    """Raise ValueError if a key has several rows."""
    if df.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(message)


def column_or(df: DataFrame, name: str, default) -> Column:
    """A column of df with `default` for its nulls, or the default alone where df has no such column."""
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)


# -- numbers ---------------------------------------------------------------------------------------


def canonical_number(text: Column) -> Column:
    """A finite decimal's shortest text: equal numbers have equal text, whatever their scale; else null.

    Works on text, so no digit is lost however many there are. Exponents are not read.
    """
    clean = F.trim(text)
    valid = clean.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)$")
    whole = F.regexp_replace(F.regexp_extract(clean, r"^[+-]?(\d*)", 1), r"^0+", "")
    part = F.regexp_replace(F.regexp_extract(clean, r"\.(\d*)$", 1), r"0+$", "")
    body = F.concat(F.when(whole == "", "0").otherwise(whole), F.when(part == "", "").otherwise(F.concat(F.lit("."), part)))
    shortest = text.rlike(r"^[1-9][0-9]*\z")  # most are
    return F.when(shortest, text).when(valid, F.when(clean.startswith("-") & (body != "0"), F.concat(F.lit("-"), body)).otherwise(body))


def is_lexical_number(text: Column) -> Column:
    """A plain number as filings write it: no exponent, no blanks inside."""
    return F.coalesce(F.trim(text).rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)$"), F.lit(False))


#: A decimal with or without an exponent.
_DECIMAL = r"^([+-]?)(?=\.?\d)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?$"


def once(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def number_key(text: Column) -> Column:
    """Sign, digits without outer zeros, and exponent of a finite decimal: equal numbers have equal keys; else null.

    Works on text, so neither digits nor exponents of up to 18 places are lost.
    """
    def of(clean: Column) -> Column:
        def part(i: int) -> Column:
            return F.regexp_extract(clean, _DECIMAL, i)

        def key(digits: Column) -> Column:
            bare = F.regexp_replace(digits, "0+$", "")
            power = F.coalesce(F.when(part(4) != "", part(4).try_cast("bigint")), F.lit(0).cast("bigint")) - F.length(part(3)) + F.length(digits)
            return F.when(digits == "", "0").otherwise(once(bare, lambda x: F.concat(F.when(part(1) == "-", "-").otherwise(""), x, F.lit("e"), (power - F.length(x)).cast("string"))))

        return F.when(clean.rlike(_DECIMAL), once(F.regexp_replace(F.concat(part(2), part(3)), "^0+", ""), key))

    return once(F.trim(text), of)


def not_finite(text: Column) -> Column:
    return F.coalesce(F.trim(text).rlike(r"^(?i)[+-]?(inf(inity)?|s?nan\d*)$"), F.lit(False))


def market_number(text: Column, precision: str = "decimal(38,9)") -> tuple[Column, Column]:
    """(value, reason): empty is null without reason; what is no finite number is invalid_market_number.

    A number that the decimal can't hold exactly is null too, with market_number_not_exact; it is never rounded.
    """
    def judged(clean: Column) -> Column:
        value = clean.try_cast(precision)
        exact = number_key(value.cast("string")) == number_key(clean)
        reason = F.when(~clean.rlike(_DECIMAL), "invalid_market_number").when(~F.coalesce(exact, F.lit(False)), "market_number_not_exact")
        return once(reason, lambda r: F.struct(F.when(r.isNull(), value).alias("value"), r.alias("reason")))

    digits, scale = map(int, re.findall(r"\d+", precision))
    plain = text.rlike(rf"^[+-]?[0-9]{{1,{digits - scale}}}(\.[0-9]{{1,{scale}}})?\z") if digits > scale > 0 else F.lit(False)  # fits as it stands
    told = F.when(plain, F.struct(text.try_cast(precision).alias("value"), F.lit(None).cast("string").alias("reason")))
    told = told.when(text != "", once(F.regexp_replace(text, r"^\s+|\s+$", ""), judged))
    return told["value"], told["reason"]


def scalar_equal(a: Column, b: Column) -> Column:
    """Both null, the same finite number however it is written, or else the same text; what isn't finite equals nothing."""
    def same(x: Column) -> Column:
        return once(number_key(b), lambda y: F.when(x.isNotNull() & y.isNotNull(), x == y).otherwise(a == b))

    def plain(x: Column) -> Column:
        return x.rlike(r"^[0-9]{1,18}(\.0*)?\z")

    def whole(x: Column) -> Column:
        return F.substring_index(x, ".", 1).try_cast("bigint")

    empty = F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull())
    return empty.when(plain(a) & plain(b), whole(a) == whole(b)).when(not_finite(a) | not_finite(b), F.lit(False)).otherwise(once(number_key(a), same))


def value_class(value: Column) -> Column:
    """A text that is equal for values that scalar_equal takes for equal, but for those that aren't finite, which equal nothing."""
    return F.coalesce(F.concat(F.lit("#"), number_key(value)), F.concat(F.lit("="), value))


def exact_difference(a: Column, b: Column, scale: int = 9) -> Column:
    """a - b of decimal texts as canonical text; null beyond 36 digits instead of a rounded value."""
    kind = f"decimal(36,{scale})"

    def fits(x: Column) -> Column:
        return F.length(F.regexp_extract(canonical_number(x), r"\.(\d+)$", 1)) <= scale

    return F.when(fits(a) & fits(b), canonical_number(F.try_subtract(a.try_cast(kind), b.try_cast(kind)).cast("string")))


def checked_standard_error(variance: Column) -> tuple[Column, Column]:
    """(root, reason): a negative or non-finite variance is a reason, never clipped."""
    bad = variance.isNull() | F.isnan(variance) | (variance < 0) | (variance == float("inf"))
    return F.when(~bad, F.sqrt(variance)), F.when(bad, F.lit("invalid_variance"))


# -- times -----------------------------------------------------------------------------------------


def at_zone(local: Column, zone: str = JST) -> Column:
    """The instant of a local wall-clock timestamp."""
    return F.to_utc_timestamp(local, zone)


def availability_bound(day: Column, time: Column, latency: Column) -> Column:
    """The earliest safe instant: without a time the next local midnight, else that time; plus the latency.

    day: date; time: `HH:MM[:SS]` or null; latency: day-time interval; reading a negative one fails.
    """
    latency = F.when(latency < F.expr("interval '0' second"), F.raise_error(F.lit("Negative latency")).cast("interval day to second")).otherwise(latency)
    local = F.when(time.isNull(), F.date_add(day, 1).cast("timestamp")).otherwise(F.concat_ws(" ", day.cast("string"), time).try_cast("timestamp"))
    return at_zone(local) + latency


def precision_bound(text: Column) -> Column:
    """A timestamp text's upper bound: a date ends at the next local midnight, a minute after it; else null."""
    day = text.rlike(r"^\d{4}-\d\d-\d\d$")
    minute = text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d$")
    second = text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")
    at = text.try_cast("timestamp")
    local = F.when(day, at + F.expr("interval 1 day")).when(minute, at + F.expr("interval 1 minute")).when(second, at)
    return at_zone(local)


def strict_instant(text: Column) -> Column:
    """An ISO timestamp with an offset; null (time_precision_unknown) otherwise."""
    return F.when(text.rlike(r"(Z|[+-]\d\d:\d\d)$"), text.try_cast("timestamp"))


# -- identifiers -----------------------------------------------------------------------------------


def is_code(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[0-9A-Z]{4,5}$"), F.lit(False))


def is_entity_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^E\d{5}$"), F.lit(False))


def is_document_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^S[0-9A-Z]{7}$"), F.lit(False))


def is_corporate_number(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{13}$"), F.lit(False))


def is_sha256(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[0-9a-f]{64}$"), F.lit(False))


def canonical_json(columns: dict[str, Column]) -> Column:
    """JSON with sorted keys that keeps nulls."""
    return F.to_json(F.struct(*[columns[k].alias(k) for k in sorted(columns)]), {"ignoreNullFields": "false"})


def content_id(columns: dict[str, Column]) -> Column:
    """SHA-256 over the canonical JSON of a row's content."""
    return F.sha2(canonical_json(columns), 256)


def locator_valid(path: Column, size: Column, sha: Column, row_sha: Column, index: Column) -> Column:
    """A relative path without `..` or drive, a positive size, hex hashes and a place from 1."""
    parts = F.split(F.regexp_replace(path, r"\\", "/"), "/")
    ok = (F.length(path) > 0) & ~path.rlike(r"^[/\\]") & ~path.contains(":") & ~F.array_contains(parts, "..")
    return F.coalesce(ok & (size > 0) & is_sha256(sha) & is_sha256(row_sha) & (index >= 1), F.lit(False))


def squeezed(text: Column) -> Column:
    """Text without any white space, Unicode's too."""
    return F.translate(text, SPACES, "")


def formula_guard(cell: Column) -> Column:
    """A cell that a spreadsheet would run gets a quote before it, unless it is a plain number."""
    return F.when(cell.rlike(r"^[=+@\-\t\r]") & ~cell.rlike(r"^[+-]?\d+(\.\d+)?$"), F.concat(F.lit("'"), cell)).otherwise(cell)


def failure_class(reason: Column) -> Column:
    """The class that a failure's text belongs to."""
    def has(*parts: str) -> Column:
        found = F.lit(False)
        for p in parts:
            found = found | F.contains(reason, F.lit(p))
        return found

    return F.when(has("integrity", "changed"), "byte_integrity_failed").when(has("ambiguous", "document_id"), "identifier_ambiguous").when(has("not_available"), "raw_missing").when(has("size_limit"), "raw_size_limit").when(reason.isNotNull(), "local_archive_contract_failed")


def json_safe(rows: DataFrame) -> DataFrame:
    """rows whose decimals are texts without exponent, and whose dates and instants are ISO texts; other columns stay."""
    def safe(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind.startswith("decimal"):
            return c.cast("string").alias(name)
        if kind == "date":
            return F.date_format(c, "yyyy-MM-dd").alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(name)
        return c

    return rows.select(*[safe(n, k) for n, k in rows.dtypes])


def semantic_key(columns: list[str]) -> Column:
    """One hash over the columns that say what a fact means; nulls count."""
    return content_id({c: F.col(c) for c in columns})
