"""Cleaning: raw beacon lines to typed streams, as one narrow pass over the lines.

A line ends with ``reason`` (why it yields no record, else null). One line can feed several
streams: a page view or page close, an ad record, and click coordinates.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import (
    SEP,
    after_equals,
    blank,
    col,
    host_text,
    last_piece,
    or_default,
    or_null,
    rewritten,
    url_decoded,
    whole_number,
    without_query,
)
from ..schemas import STREAMS
from .geo import with_location
from .sizing import broadcast_if_small

# Beacon paths and the number of fields of a line.
PAGE_CLOSE, CLICK_MARK, SCRIPT_LOAD = "5g.gif", "5c.gif", "51js.php"
FIELDS = 11

PATTERN_SYNTAX = re.compile(r"[\\^$.|?*+()\[\]{}]")
HOT_TYPE = "array<struct<x:string,y:string,t:string,u:string>>"


@dataclass(frozen=True)
class Rules:
    """Line filters and URL rewrites; rewrites are in priority order."""

    filters: list[str] = field(default_factory=list)
    rewrites: list[tuple[str, str]] = field(default_factory=list)


#: Up to so many rules each is a test of its own.
FEW_RULES = 16
LITERAL = 3
#: Letters that a backslash makes a class or a sign by themselves; after others, what follows belongs to them.
ALONE = "dDsSwWbBAzZGhHvVRXtnrfae"


def required_literal(pattern: str) -> str | None:
    """A text that every match of the pattern contains, if one can be read off it: its longest run of plain characters.

    Groups, classes and repeated parts are skipped; a pattern with alternatives, flags, quoted parts or signs by number or name outside
    groups has none.
    """
    runs, run, i = [], "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "|" or pattern.startswith(("(?", "\\Q"), i) and not pattern.startswith("(?:", i):
            return None
        if c in "([":
            i = _closing(pattern, i)
            if i < 0:
                return None
            c = ""
        elif c == "\\":
            i += 1
            if i < len(pattern) and pattern[i].isalnum() and pattern[i] not in ALONE:
                return None
            c = pattern[i] if i < len(pattern) and not pattern[i].isalnum() else ""
        elif c in "^$.*+?{}":
            c = ""
        i += 1
        optional = i < len(pattern) and pattern[i] in "*?{"
        repeated = i < len(pattern) and pattern[i] == "+"
        if c and not optional:
            run += c
        if not c or optional or repeated:
            runs.append(run)
            run = ""
        if optional and pattern[i] == "{":
            i = pattern.find("}", i)
            if i < 0:
                return None
    best = max([*runs, run], key=len)
    return best if len(best) >= LITERAL else None


def _closing(pattern: str, i: int) -> int:
    """Place of the bracket that closes the one at i; -1 for none."""
    if pattern[i] == "[":
        j = i + 1
        depth = 1
        while j < len(pattern):
            if pattern[j] == "\\":
                j += 1
            elif pattern[j] == "[":
                depth += 1
            elif pattern[j] == "]" and j > i + 1 and pattern[i + 1 : j] != "^":
                depth -= 1
                if not depth:
                    return j
            j += 1
        return -1
    j = i + 1
    while j < len(pattern) and pattern[j] != ")":
        if pattern[j] in "([":
            j = _closing(pattern, j)
            if j < 0:
                return -1
        elif pattern[j] == "\\":
            j += 1
        j += 1
    return j if j < len(pattern) else -1


def leading_text(pattern: str) -> tuple[str, str]:
    """The plain characters that every match of the pattern begins with, and what follows them."""
    text, i = "", 0
    while i < len(pattern):
        end = i + 1
        if pattern[i] == "\\":
            end += 1
            if end > len(pattern) or pattern[i + 1].isalnum():
                break
        elif PATTERN_SYNTAX.match(pattern[i]):
            break
        if end < len(pattern) and pattern[end] in "*+?{":
            break
        text += pattern[end - 1]
        i = end
    return text, pattern[i:]


def any_pattern(parts: list[tuple[str, str]]) -> str:
    """A pattern that finds any of the given ones (leading text, rest), with common beginnings written once: a place in a text meets the
    first signs only, and of the rests those whose leading text stands there."""
    tree: dict = {}
    for text, rest in sorted(set(parts)):
        node = tree
        for c in text:
            if "" in node.get("", ()):
                break
            node = node.setdefault(c, {})
        else:
            if not rest:
                # What begins with this text is found by it.
                node.clear()
            if "" not in node.get("", ()):
                node.setdefault("", []).append(rest)

    def written(node: dict) -> str:
        tail = ""
        while len(node) == 1 and "" not in node:
            ((c, node),) = node.items()
            tail += re.sub(r"([^\w])", r"\\\1", c, flags=re.ASCII) if c.isascii() else c
        rests = node.get("", [])
        if "" in rests:
            return tail
        below = [written({c: sub}) for c, sub in sorted(node.items()) if c]
        return f"{tail}(?:{'|'.join([*below, *rests])})"

    return written(tree)


def any_literal(literals: list[str]) -> str:
    """A pattern that finds any of the literals."""
    return any_pattern([(text, "") for text in literals])


def blacklisted(line: Column | str, filters: list[str]) -> Column:
    """True when any rule occurs in the line; rules without pattern syntax are plain substrings.

    Many rules are one pattern that shares their common beginnings, so a line costs as much as the rules that begin where it is read. Where
    the literal that a match must contain is not in the beginning, all such literals are looked for first, and the patterns themselves are
    tried on lines that hold one. Rules without such a literal remain tests of their own.
    """
    line = col(line)
    plain = [f for f in filters if not PATTERN_SYNTAX.search(f)]
    patterns = [f for f in filters if PATTERN_SYNTAX.search(f)]
    if len(filters) <= FEW_RULES:
        # Each rule is a test of its own: flags and group numbers of one do not reach another.
        tests = [F.contains(line, F.lit(f)) for f in plain] + [line.rlike(p) for p in patterns]
        return reduce(or_, tests, F.lit(False))
    # Numbers of groups would change inside one pattern of all.
    joined = {p: required_literal(p) for p in patterns if not re.search(r"\\[1-9k]", p)}
    joined = {p: literal for p, literal in joined.items() if literal}
    tests = [line.rlike(p) for p in patterns if p not in joined]
    if plain:
        tests.append(line.rlike(any_literal(plain)) if all(plain) else F.lit(True))
    begins = {p: leading_text(p) for p in joined}
    early = {p for p, literal in joined.items() if literal in begins[p][0]}
    if early:
        tests.append(line.rlike(any_pattern([begins[p] for p in early])))
    if late := [p for p in joined if p not in early]:
        tests.append(line.rlike(any_literal([joined[p] for p in late])) & line.rlike(any_pattern([begins[p] for p in late])))
    return reduce(or_, tests, F.lit(False))


def canonical_url(url: Column | str, rewrites: list[tuple[str, str]]) -> Column:
    """The URL by the first rule that fits; of many rules none is tried on a URL that holds none of their literals."""
    url = col(url)
    literals = [required_literal(p) for p, _ in rewrites]
    if len(rewrites) <= FEW_RULES or not all(literals):
        return rewritten(url, rewrites)
    return F.when(url.rlike(any_literal(literals)), rewritten(url, rewrites)).otherwise(url)


def line_fields(line: Column | str) -> Column:
    """Fields of a line; adjacent separators count as one, so an empty field vanishes."""
    return F.split(F.btrim(col(line), F.lit(SEP)), SEP + "+")


def cookie(cookies: Column, name: str) -> Column:
    """Value of the last cookie whose text contains the name; empty text when there is none."""
    return after_equals(last_piece(cookies, ";", name))


def parameter(query: Column, name: str) -> Column:
    """Value of the last query parameter of that name, null when there is none.

    The query text has a leading ``&``. Plain substring search: a pattern per parameter costs ten
    times as much per line.
    """
    start = f"&{name}="
    value = F.substring_index(F.substring_index(query, start, -1), "&", 1)
    return F.when(F.contains(query, F.lit(start)), value)


#: A text that re-quoting reads as the state machine would: bare names, plain numbers, bare words without signs of their own.
_BARE_VALUE = r"(?:-?(?:0|[1-9]\d*)(?:\.\d+)?|[A-Za-z_%][^\s\"',:;=#/\\{}\[\]]*)"
_BARE_OBJECT = rf"\{{[A-Za-z_]\w*:{_BARE_VALUE}(?:,[A-Za-z_]\w*:{_BARE_VALUE})*\}}"
SIMPLE_HOT = rf"^\[{_BARE_OBJECT}(?:,{_BARE_OBJECT})*\]$"
#: Tokens: quoted text, signs, and bare text up to a sign, which may hold blanks and apostrophes.
HOT_TOKEN = (
    r"\"(?:\\[^\r\n]|[^\"\\\r\n])*\"|'(?:\\[^\r\n]|[^'\\\r\n])*'|=>|[\[\]{}:,;=]"
    r"|[^\x00-\x20,:\]}/\\\"\[{;=#'][^\x00-\x1f,:\]}/\\\"\[{;=#]*|[^\x00-\x20]"
)
HOT_FIELDS = ("x", "y", "t", "u")


def parse_hot(text: Column | str) -> Column:
    """Click coordinates from JSON text that is read tolerantly; null where the text is malformed.

    Names and values may lack quotes or stand in single ones, ``=`` and ``=>`` count as ``:`` and ``;`` as ``,``, a comma may close a list,
    and what follows the list is ignored. A bare value ends at a sign, so one that holds a ``:`` is malformed; a bare number keeps no
    trailing zeros, a quoted one stays as it is; a repeated name, a value that is a list or an object, and an open end are malformed.
    """
    text = col(text)
    simple = F.coalesce(text.rlike(SIMPLE_HOT) & ~text.rlike(r"[{,](\w+):[^}]*,\1:"), F.lit(False))
    return F.when(simple, _requoted_hot(text)).otherwise(_tokens_hot(text))


def _requoted_hot(text: Column) -> Column:
    # Bare numbers keep no trailing zeros; then every bare value but null becomes text.
    quoted = F.regexp_replace(text, r"(:-?\d+(?:\.\d*?[1-9])?)\.?0*(?=[,}])", "$1")
    quoted = F.regexp_replace(quoted, r":(?!(?i:null)[,}])([^,}]+)", ':"$1"')
    return F.from_json(F.regexp_replace(quoted, r":(?i:null)(?=[,}])", ":null"), HOT_TYPE, {"allowUnquotedFieldNames": "true"})


def _hot_value(token: Column) -> Column:
    """Text of a value token; null for a bare ``null``."""
    inner = F.substr(token, F.lit(2), F.length(token) - 2)
    as_json = F.concat(F.lit('["'), F.replace(F.replace(inner, F.lit("\\'"), F.lit("'")), F.lit('"'), F.lit('\\"')), F.lit('"]'))
    as_json = F.when(F.startswith(token, F.lit('"')), F.concat(F.lit("["), token, F.lit("]"))).otherwise(as_json)
    quoted = F.when(F.contains(token, F.lit("\\")), F.get(F.from_json(as_json, "array<string>"), F.lit(0))).otherwise(inner)
    bare = F.trim(token)
    number = F.when(bare.rlike(r"^-?[0-9][0-9.]*([eE][+-]?[0-9]+)?$") & bare.rlike("[.eE]"), bare.try_cast("double").cast("string"))
    number = F.when(~F.contains(number, F.lit("E")), F.regexp_replace(number, r"\.?0+$", "")).otherwise(number)
    lower = F.lower(bare)
    return (
        F.when(token.rlike("^[\"']"), quoted)
        .when(lower == "null", F.lit(None).cast("string"))
        .when(lower.isin("true", "false"), lower)
        .otherwise(F.coalesce(number, bare))
    )


def _tokens_hot(text: Column) -> Column:
    """The same by a state machine over the tokens of the text."""
    # Before the list, before an element, after one; before a name, its colon, its value, after it; behind the list; malformed.
    start, element, after_element, name, colon, value, after_value, end, bad = range(9)
    none = F.lit(None).cast("string")
    blank_point = F.struct(*[none.alias(c) for c in HOT_FIELDS])
    begin = F.struct(F.lit(start).alias("at"), none.alias("name"), blank_point.alias("point"), F.array().cast(HOT_TYPE).alias("out"))

    def step(acc: Column, token: Column) -> Column:
        is_text = token.rlike("^([\"'].+|[^\\[\\]{}:,;=/\\\\#\"'].*)$") & (token != "=>")
        at, comma = acc["at"], token.isin(",", ";")
        known = [(acc["name"] == c) & acc["point"][c].isNotNull() for c in HOT_FIELDS]
        again = reduce(or_, known)
        following = (
            F.when(at == end, end)
            .when((at == start) & (token == "["), element)
            .when((at == element) & (token == "{"), name)
            .when((at == element) & (token == "]"), end)
            .when((at == after_element) & comma, element)
            .when((at == after_element) & (token == "]"), end)
            .when((at == name) & (token == "}"), after_element)
            .when((at == name) & is_text, colon)
            .when((at == colon) & token.isin(":", "=", "=>"), value)
            .when((at == value) & is_text & ~F.coalesce(again, F.lit(False)), after_value)
            .when((at == after_value) & comma, name)
            .when((at == after_value) & (token == "}"), after_element)
            .otherwise(bad)
        )
        closes = at.isin(name, after_value) & (token == "}")
        opens = (at == element) & (token == "{")
        field = lambda c: F.when((at == value) & (acc["name"] == c), _hot_value(token)).when(~opens, acc["point"][c]).alias(c)
        return F.struct(
            following.alias("at"),
            F.when((at == name) & is_text, _hot_value(token)).otherwise(acc["name"]).alias("name"),
            F.struct(*map(field, HOT_FIELDS)).alias("point"),
            F.when(closes, F.concat(acc["out"], F.array(acc["point"]))).otherwise(acc["out"]).alias("out"),
        )

    read = F.aggregate(F.regexp_extract_all(text, F.lit(HOT_TOKEN), F.lit(0)), begin, step)
    return F.when(read["at"] == end, read["out"])


def parse(lines: DataFrame, rules: Rules | None = None, text: str = "value") -> DataFrame:
    """Split, decode, default and rewrite; keeps the line text and adds ``reason``."""
    rules = rules or Rules()
    f = F.col("f")
    at = lambda i: F.get(f, F.lit(i))
    # Each step reads the columns of the step before more than once, so the optimizer keeps them
    # as separate projections and every text is searched once.
    raw = lines.select(F.col(text).alias("line")).withColumn("f", line_fields("line"))
    raw = raw.select(
        "line",
        F.size("f").alias("arity"),
        F.trim(at(0)).alias("ip"),
        at(2).alias("vtime"),
        F.btrim(at(4), F.lit("/")).alias("path"),
        whole_number(at(6)).alias("status"),
        F.concat(F.lit("&"), F.btrim(at(5), F.lit("?"))).alias("query"),
        at(10).alias("cookies"),
    )
    query, cookies = F.col("query"), F.col("cookies")
    is_mark = F.col("path") == CLICK_MARK
    beacon = lambda name: F.when(~is_mark, parameter(query, name))
    mark_page = F.regexp_extract(query, r"(?s)^(?:.*&)?((?![^&]*click=)[^&]*u=[^&]*)", 1)
    raw = raw.select(
        "line",
        "arity",
        "ip",
        "vtime",
        "path",
        "status",
        cookie(cookies, "wid").alias("wid"),
        cookie(cookies, "newer").alias("new"),
        cookie(cookies, "enter").alias("enter"),
        F.when(is_mark, after_equals(mark_page)).otherwise(parameter(query, "u")).alias("u"),
        F.when(is_mark, after_equals(last_piece(query, "&", "click="))).alias("click"),
        *[beacon(n).alias(n) for n in ("re", "id", "lnt", "adsfrom", "adsnew", "adsnum", "hot", "wb", "se", "kw")],
    )
    raw = raw.withColumns(
        {
            "u_text": F.when(blank("u"), F.when(is_mark, "-")).otherwise(url_decoded("u")),
            "re_text": F.when(blank("re"), "-").otherwise(url_decoded("re")),
            "ads_once": F.when(blank("adsfrom"), "-").otherwise(F.btrim(url_decoded("adsfrom"), F.lit("/"))),
        }
    )
    raw = raw.withColumn("ads_text", F.when(blank("ads_once"), F.when(F.col("ads_once").isNotNull(), "-")).otherwise(url_decoded("ads_once")))
    raw = raw.withColumn("host", host_text("u_text"))
    bad_url = (
        (~blank("u") & F.col("u_text").isNull()) | F.col("re_text").isNull() | F.col("ads_text").isNull()
    )
    reason = (
        F.when(blacklisted("line", rules.filters), "blacklisted")
        .when(F.col("arity") != FIELDS, "field_count")
        .when(F.col("path") == SCRIPT_LOAD, "script_load")
        .when(F.col("status").isNull(), "bad_status")
        .when(F.col("status") >= 400, "http_error")
        .when(F.col("u_text").isNull() & blank("u"), "no_page")
        .when(bad_url, "bad_url")
    )
    canonical = lambda c: without_query(canonical_url(c, rules.rewrites))
    record = F.struct(
        "line",
        "path",
        reason.alias("reason"),
        "ip",
        or_default("wid", "-").alias("wid"),
        canonical("u_text").alias("page"),
        canonical("re_text").alias("ref"),
        or_default("id", "-").alias("domain"),
        or_default("host", "-").alias("respondomain"),
        or_null("enter").alias("enter"),
        whole_number("new").alias("new"),
        or_null("se").alias("se"),
        whole_number(F.coalesce("wb", F.lit("0"))).alias("wb"),
        or_default("kw", "-").alias("kw"),
        "vtime",
        whole_number("lnt", "long").alias("page_avg_time"),
        blank("lnt").alias("no_time"),
        canonical("ads_text").alias("adsref"),
        whole_number("adsnew").alias("adsnew"),
        or_null("adsnum").alias("adsid"),
        or_null("hot").alias("hot"),
        "click",
    )
    # Inlining a one-record array keeps later filters above the parse: pushed below it, every
    # predicate would repeat the expressions of all the columns it mentions.
    return raw.select(F.inline(F.array(record)))


SALTS = 32


def mark_tracked(parsed: DataFrame, sites: DataFrame, limit: int | None = None) -> DataFrame:
    """Add ``tracked``: the line's site is on the allow-list.

    A list too large to broadcast is repeated for each salt, so the lines of one site are spread over as many tasks.
    """
    listed, small = broadcast_if_small(sites.select("domain").distinct(), limit)
    listed = listed.withColumn("tracked", F.lit(True))
    if small:
        marked = parsed.join(listed, "domain", "left")
    else:
        salt = F.pmod(F.xxhash64("line"), F.lit(SALTS)).cast("int")
        listed = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        marked = parsed.withColumn("salt", salt).join(listed, ["domain", "salt"], "left").drop("salt")
    return marked.withColumn("tracked", F.coalesce("tracked", F.lit(False)))


def only_tracked(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows whose site is on the allow-list; both sides come straight from an exchange, so hot sites can be split."""
    listed, _ = broadcast_if_small(sites.select("domain").distinct())
    return df.join(listed, "domain", "left_semi")


def _kind_predicates() -> dict[str, Column]:
    parsed = F.col("reason").isNull()
    mark, close = F.col("path") == CLICK_MARK, F.col("path") == PAGE_CLOSE
    return {
        "hits": parsed & F.col("tracked") & ~mark & ~close,
        "dwell": parsed & F.col("tracked") & close & ~F.col("no_time"),
        "ad_hits": parsed & F.col("adsid").isNotNull() & ~close,
        "ad_dwell": parsed & F.col("adsid").isNotNull() & close,
        "click_marks": parsed & mark & ~blank("click") & ~blank("page"),
        "hot": parsed & F.col("hot").isNotNull(),
    }


def _with_points(parsed: DataFrame) -> DataFrame:
    """Add ``points``: valid click coordinates; null when the text or a link in it is unreadable."""
    read = parsed.withColumn("points", F.when(_kind_predicates()["hot"], parse_hot("hot")))
    readable = ~F.exists("points", lambda p: p["u"].isNotNull() & url_decoded(p["u"]).isNull())
    link = lambda p: F.when(p["t"] == "a", without_query(url_decoded(p["u"])))
    shaped = F.transform(
        "points",
        lambda p: F.struct(F.lit("hot").alias("kind"), p["x"].alias("x"), p["y"].alias("y"), link(p).alias("u")),
    )
    return read.withColumn("points", F.when(readable, shaped))


def stream(parsed: DataFrame, kind: str) -> DataFrame:
    """One stream out of parsed, marked and located lines, with ``vtime`` for the period."""
    rows = parsed.where(_kind_predicates()[kind])
    if kind == "hot":
        points = F.explode_outer("points").alias("p")
        rows = _with_points(rows).select("*", points).where(F.col("p").isNotNull()).select("*", "p.*")
    columns = [c for c in STREAMS[kind].names if c != "vtime"]
    return rows.select(*columns, "vtime")


def route(parsed: DataFrame, with_rejects: bool = False) -> DataFrame:
    """All streams in one pass: one row per record, with ``kind`` and the columns of all kinds.

    ``with_rejects`` keeps the lines without a record as kind ``rejects``, with ``line`` and ``reason``.
    """
    nothing = F.lit(None).cast("string")
    tag = lambda kind: F.struct(
        F.lit(kind).alias("kind"), nothing.alias("x"), nothing.alias("y"), nothing.alias("u")
    )
    plain = F.array_compact(
        F.array(*[F.when(p, tag(k)) for k, p in _kind_predicates().items() if k != "hot"])
    )
    empty = F.array().cast("array<struct<kind:string,x:string,y:string,u:string>>")
    # The outer form: no filter on the array's size is derived, which would parse it twice.
    records = F.concat(plain, F.coalesce("points", empty))
    tagged = _with_points(parsed).withColumn("r", F.explode_outer(records))
    names = dict.fromkeys(c for s in STREAMS.values() for c in s.names if c not in "xyu")
    if not with_rejects:
        return tagged.where(F.col("r").isNotNull()).select("r.kind", *names, "r.x", "r.y", "r.u")
    lost = F.col("r").isNull()
    return tagged.select(
        F.coalesce("r.kind", F.lit("rejects")).alias("kind"), *names, "r.x", "r.y", "r.u",
        F.when(lost, F.col("line")).alias("line"), F.when(lost, _reject_reason()).alias("reason"),
    )


def _reject_reason() -> Column:
    return (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when((F.col("path") == CLICK_MARK), "blank_click")
        .when((F.col("path") == PAGE_CLOSE) & F.col("no_time"), "blank_dwell")
        .otherwise("untracked_site")
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """Lines that yield no record at all, with the reason."""
    kinds = {k: p for k, p in _kind_predicates().items() if k != "hot"}
    used = reduce(or_, kinds.values(), F.coalesce(F.size("points") > 0, F.lit(False)))
    lost = _with_points(parsed).where(~F.coalesce(used, F.lit(False)))
    return lost.select("line", _reject_reason().alias("reason"))


def clean(lines: DataFrame, rules: Rules, sites: DataFrame, ranges: DataFrame) -> DataFrame:
    """Parsed lines with site mark and location: the input of ``stream`` and ``route``."""
    return with_location(mark_tracked(parse(lines, rules), sites), ranges)
