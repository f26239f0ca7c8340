"""Scalar functions as Column expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEP = "\u001a"

# Prefixes of a host that name the same search engine.
HOST_PREFIXES = ["www", "m", "3g", "wap", "search"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    return F.trim(F.coalesce(col(c), F.lit(""))) == ""


def or_default(c: Column | str, default: str) -> Column:
    return F.when(blank(c), F.lit(default)).otherwise(col(c))


def or_null(c: Column | str) -> Column:
    return F.when(~blank(c), col(c))


def after_equals(c: Column | str) -> Column:
    """Text after the first ``=``; the whole text when there is none."""
    c = col(c)
    return F.substr(c, F.instr(c, "=") + F.lit(1))


def whole_number(c: Column | str, kind: str = "int") -> Column:
    """Integer text as a number, else null.

    The pattern comes first because a failing cast raises and catches an exception for its row.
    """
    c = col(c)
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), c).try_cast(kind)


def last_piece(text: Column | str, sep: str, mark: str) -> Column:
    """The last piece of a separated text that contains the mark; empty text without any."""
    text = col(text)
    after = F.substring_index(text, mark, -1)
    before = F.left(text, F.length(text) - F.length(after) - F.lit(len(mark)))
    piece = F.concat(F.substring_index(before, sep, -1), F.lit(mark), F.substring_index(after, sep, 1))
    return F.when(F.contains(text, F.lit(mark)), piece).otherwise(F.lit(""))


# ---- keys ------------------------------------------------------------------------------------


def _key_part(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def row_key(*parts: Column | str) -> Column:
    """Key text of two to six parts; null parts are empty, any other arity gives null."""
    if not 2 <= len(parts) <= 6:
        return F.lit(None).cast("string")
    return F.concat_ws(SEP, *[_key_part(p) for p in parts])


def descending(count: Column | str) -> Column:
    """Binary text of the negated count: sorts larger counts first within a key."""
    return F.bin(-col(count).cast("long"))


def row_key_descending(first: Column | str, count: Column | str, *rest: Column | str) -> Column:
    """Key text whose second part orders by descending count (three or four parts)."""
    if not 1 <= len(rest) <= 2:
        raise ValueError("a descending key has three or four parts")
    return row_key(first, descending(count), *rest)


def key_head(key: Column | str) -> Column:
    """First two parts of a key text."""
    return F.substring_index(col(key), SEP, 2)


# ---- hosts and URLs --------------------------------------------------------------------------


def root_of(c: Column | str) -> Column:
    """Engine or referrer root: strip one known host prefix, cut a URL after its host."""
    c = col(c)
    pattern = r"^(?:" + "|".join(HOST_PREFIXES) + r")\."
    return (
        F.when(c.rlike(pattern), F.regexp_replace(c, pattern, ""))
        .when(c.startswith("http://"), F.regexp_extract(c, r"^(http://[^/]*)", 1))
        .otherwise(c)
    )


def host_text(url: Column | str) -> Column:
    """Host part of a URL, with or without a scheme; empty text when there is none."""
    return F.regexp_extract(col(url), r"^(?:https?://)?([^/]+)", 1)


def host_of(url: Column | str) -> Column:
    return or_default(host_text(url), "-")


def without_query(url: Column | str) -> Column:
    return F.substring_index(col(url), "?", 1)


def url_decoded(c: Column | str) -> Column:
    """Percent-decoded text; null when the text is not validly encoded."""
    c = col(c)
    plain = ~(F.contains(c, F.lit("%")) | F.contains(c, F.lit("+")))
    return F.when(plain, c).otherwise(F.try_url_decode(c))


def rewritten(url: Column | str, rules: list[tuple[str, str]]) -> Column:
    """Replace by the first rule (in priority order) whose pattern occurs in the URL."""
    url = col(url)
    if not rules:
        return url
    (pattern, replacement), *others = rules
    chain = F.when(url.rlike(pattern), F.regexp_replace(url, pattern, replacement))
    for pattern, replacement in others:
        chain = chain.when(url.rlike(pattern), F.regexp_replace(url, pattern, replacement))
    return chain.otherwise(url)


# ---- ratios ----------------------------------------------------------------------------------


# Numerators and denominators are column names or SQL expressions: a report has dozens of ratios,
# and one parsed expression each builds its plan several times faster than chained Column calls.


def _ratio32(numerator: str, denominator: str) -> str:
    """32-bit ratio; null when the denominator is zero."""
    return f"cast(cast({numerator} as float) / cast(nullif({denominator}, 0) as float) as float)"


def basis_points(numerator: str, denominator: str) -> Column:
    """Ratio in basis points, rounded half up in 32-bit arithmetic."""
    scaled = f"{_ratio32(numerator, denominator)} * cast(10000 as float)"
    return F.expr(f"cast(floor(cast({scaled} as double) + 0.5) as bigint)")


def percent_text(numerator: str, denominator: str) -> Column:
    scaled = f"{_ratio32(numerator, denominator)} * cast(100 as float)"
    return F.expr(f"concat(cast({scaled} as string), '%')")


def whole_quotient(numerator: Column | str, denominator: Column | str) -> Column:
    """Integer division; null when the denominator is zero."""
    denominator = F.nullif(col(denominator), F.lit(0))
    quotient = F.call_function("div", col(numerator), denominator)
    return quotient.cast("long")


# ---- time ------------------------------------------------------------------------------------


def duration_text(millis: Column | str) -> Column:
    """``HH:mm:ss``; hours wrap at a day and seconds are rounded, so 60 can occur."""
    ms = F.floor(col(millis).try_cast("double") + F.lit(0.5)).cast("long")

    def two(c: Column) -> Column:
        return F.lpad(F.floor(c).cast("string"), 2, "0")

    hours = (ms % F.lit(86_400_000)) / F.lit(3_600_000)
    minutes = (ms % F.lit(3_600_000)) / F.lit(60_000)
    seconds = (ms % F.lit(60_000) + F.lit(500)) / F.lit(1000)
    return F.concat(two(hours), F.lit(":"), two(minutes), F.lit(":"), two(seconds))


def to_time(text: Column | str) -> Column:
    return F.try_to_timestamp(col(text), F.lit("yyyy-MM-dd HH:mm:ss"))


def time_text(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss")


def minute_to_millis(text: Column | str) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd HH:mm`` text in the session time zone."""
    return F.unix_millis(F.try_to_timestamp(col(text), F.lit("yyyy-MM-dd HH:mm")))


def micros_to_time(micros: Column | str) -> Column:
    return F.timestamp_micros(col(micros).cast("long"))


def time_to_micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts))


# ---- addresses -------------------------------------------------------------------------------


def ip_number(ip: Column | str) -> Column:
    """Dotted quad as an unsigned 32-bit number; null when it is not one."""
    ip = col(ip)
    # The array function also ends the generated stage here, so that a long parse before it and the
    # join after it do not grow into one method too large for the JIT compiler (8,000 bytes).
    number = F.aggregate(
        F.split(ip, r"\."),
        F.lit(0).cast("long"),
        lambda total, octet: total * F.lit(256) + octet.try_cast("long"),
    )
    valid = ip.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)$")
    return F.when(valid, number)


def ip_text(number: Column | str) -> Column:
    n = col(number).cast("long")
    octets = [F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def decoded_bytes(c: Column | str, charset: str = "UTF-8") -> Column:
    """Bytes in a charset as text.

    Charsets outside Spark's standard list, such as GBK, need
    ``spark.sql.legacy.javaCharsets=true`` in the session.
    """
    return F.decode(col(c), charset)


# ---- arrays ----------------------------------------------------------------------------------


def size_is(array: Column | str, n: int) -> Column:
    return F.size(col(array)) == n


def size_between(array: Column | str, low: int, high: int) -> Column:
    return F.size(col(array)).between(low, high)


def array_blank(array: Column | str) -> Column:
    """True when an array has no non-blank element."""
    return ~F.exists(col(array), lambda x: ~blank(x.cast("string")))


def map_empty(m: Column | str) -> Column:
    return F.size(col(m)) == 0


def first_text(array: Column | str) -> Column:
    return F.get(col(array), F.lit(0)).cast("string")


def first_key_head(array: Column | str) -> Column:
    return key_head(F.get(col(array), F.lit(0)))


def marker_count(c: Column | str) -> Column:
    """Aggregate: how many values are the markers ``1`` or ``-``."""
    return F.count_if(col(c).cast("string").isin("1", "-"))
