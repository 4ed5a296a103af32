"""Text functions as Column expressions: they stay in whole-stage codegen."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V

#: All Unicode white space, spelled out: Java's \s is ASCII only.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
CHARS_PER_TOKEN = 3.5
RETRY_RESERVE_TOKENS = 500
MIN_BUDGET_CHARS = 1000
THIN_CHARS = 600
IMPROVEMENT = 1.2
MIN_QUOTE_CHARS = 20
MIN_USEFUL_CHARS = 1500
TECHNIQUE = r"T[0-9]{4}(?:\.[0-9]{3})?"


def collapse(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def trimmed(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def casefold(text: Column) -> Column:
    """Full case folding: lower case of upper case, where a final sigma is a sigma and a dotless i stays."""
    dotless = F.lit("\ue000")
    upper = F.upper(F.replace(text, F.lit("ı"), dotless))
    folded = F.lower(F.replace(upper, F.lit("ẞ"), F.lit("SS")))  # the optimiser would cut upper directly under lower
    return F.replace(F.replace(folded, F.lit("ς"), F.lit("σ")), dotless, F.lit("ı"))


def content_hash(body: Column) -> Column:
    """SHA-256 of the white-space-collapsed body, lower-case hex."""
    return F.sha2(collapse(body), 256)


def name_key(name: Column) -> Column:
    """Case-folded, collapsed name for exact lookup."""
    return collapse(casefold(name))


def estimate_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / F.lit(CHARS_PER_TOKEN))


class BudgetTooSmall(ValueError):
    """MAX_INPUT_TOKENS leaves no room for a document."""


def document_budget(max_input_tokens: int, prompt_chars: int) -> int:
    """Characters of a document that fit in one call."""
    overhead = int(prompt_chars / CHARS_PER_TOKEN) + RETRY_RESERVE_TOKENS
    budget = int((max_input_tokens - overhead) * CHARS_PER_TOKEN)
    if budget < MIN_BUDGET_CHARS:
        raise BudgetTooSmall(f"MAX_INPUT_TOKENS={max_input_tokens} leaves {budget} characters beside {overhead} tokens of prompt and reserve; raise MAX_INPUT_TOKENS above {int(overhead + MIN_BUDGET_CHARS / CHARS_PER_TOKEN)}")
    return budget


def technique_key(technique: Column) -> Column:
    return F.upper(trimmed(technique))


def technique_shape(technique: Column) -> Column:
    return technique.rlike(f"^{TECHNIQUE}$")


def parent_technique(technique: Column) -> Column:
    return F.split_part(technique, F.lit("."), F.lit(1))


def technique_mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?U)(?<!\w){TECHNIQUE}(?!\w)"), F.lit(0))


OPEN_MARK, CLOSE_MARK = "<<<DOCUMENT>>>", "<<<END DOCUMENT>>>"


def enclosed(text: Column) -> Column:
    """A document between markers that its own text can't contain."""
    clean = F.replace(F.replace(text, F.lit(CLOSE_MARK), F.lit("")), F.lit(OPEN_MARK), F.lit(""))
    return F.concat(F.lit(OPEN_MARK + "\n"), clean, F.lit("\n" + CLOSE_MARK))


# Written forms that stand for a fanged character, in order.
REFANG = (("[.]", "."), ("(.)", "."), ("[dot]", "."), (" dot ", "."), ("[:]", ":"), ("[@]", "@"), ("[at]", "@"), ("hxxps", "https"), ("hxxp", "http"))
# The shapes of indicators.
DOMAIN = r"(?=.{1,253}$)([a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?\.)+[a-zA-Z]{2,63}$"
SHAPES = {
    "ipv6": r"^[0-9a-fA-F:]{2,45}$",
    "domain": "^" + DOMAIN,
    "url": r"(?i)^https?://[^\s]{3,2000}$",
    "sha256": r"^[a-fA-F0-9]{64}$",
    "md5": r"^[a-fA-F0-9]{32}$",
    "email": r"^[^@\s]{1,64}@" + DOMAIN,
}


def refang(value: Column) -> Column:
    value = trimmed(value)
    for written, plain in REFANG:
        value = F.replace(value, F.lit(written), F.lit(plain))
    return value


def valid_ipv4(value: Column) -> Column:
    octets = F.split(value, r"\.")
    return F.when(value.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$"), F.forall(octets, lambda o: o.try_cast("int").between(0, 255))).otherwise(F.lit(False))


def valid_ioc(kind: Column, value: Column) -> Column:
    """Whether the refanged value has its claimed kind's shape; null for an unknown kind."""
    out = F.when(kind == "ipv4", valid_ipv4(value)).when(kind == "ipv6", value.rlike(SHAPES["ipv6"]) & (F.length(value) - F.length(F.replace(value, F.lit(":"), F.lit(""))) >= 2))
    for k in ("domain", "url", "sha256", "md5", "email"):
        out = out.when(kind == k, value.rlike(SHAPES[k]))
    return out


def defanged(kind: Column, value: Column) -> Column:
    """A valid, refanged value made inert for its kind."""

    def dots(c: Column) -> Column:
        return F.replace(c, F.lit("."), F.lit("[.]"))

    rest = F.substring_index(value, "://", -1)
    rest = F.when(F.instr(value, "://") > 0, F.substr(value, F.instr(value, "://") + 3)).otherwise(rest)
    slash = F.instr(rest, "/")
    authority = F.when(slash > 0, F.substr(rest, F.lit(1), slash - 1)).otherwise(rest)
    path = F.when(slash > 0, F.substr(rest, slash)).otherwise(F.lit(""))
    scheme = F.when(F.lower(value).startswith("https://"), "hxxps").otherwise("hxxp")
    domain = F.substring_index(value, "@", -1)
    local = F.substr(value, F.lit(1), F.length(value) - F.length(domain) - 1)
    return (
        F.when(kind == "url", F.concat(scheme, F.lit("://"), dots(authority), path))
        .when(kind.isin("ipv4", "domain"), dots(value))
        .when(kind == "ipv6", F.replace(value, F.lit(":"), F.lit("[:]")))
        .when(kind == "email", F.concat(local, F.lit("[@]"), dots(domain)))
        .otherwise(F.lower(value))
    )


def defang_ioc(kind: Column, value: Column) -> Column:
    """struct<ok, value_defanged, reason>; a rejected value is never in the result."""
    candidate = refang(value)
    valid = valid_ioc(kind, candidate)
    reason = F.when(valid.isNull(), F.concat(F.lit("unknown IOC kind "), F.coalesce(kind, F.lit("null")))).when(~valid, F.concat(F.lit("value does not match claimed kind "), kind))
    ok = F.coalesce(valid, F.lit(False))
    return F.struct(ok.alias("ok"), F.when(ok, defanged(kind, candidate)).alias("value_defanged"), reason.alias("reason"))


def url_host(url: Column) -> Column:
    """Host of an https URL, lower case, without a trailing dot; null for any other."""
    host = F.rtrim(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit("."))
    return F.when((F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))) == "https") & (host != ""), host)


def same_site(feed_url: Column, article_url: Column) -> Column:
    feed, article = url_host(feed_url), url_host(article_url)
    return F.coalesce((article == feed) | article.endswith(F.concat(F.lit("."), feed)), F.lit(False))


def thin(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit(""))) < THIN_CHARS


def evidence_verdict(haystack: Column, needle: Column) -> Column:
    """null if the quote stands, else why not. Both sides are canonical."""
    return (
        F.when(F.length(needle) < MIN_QUOTE_CHARS, F.concat(F.lit("quote is "), F.length(needle).cast("string"), F.lit(f" chars, below the {MIN_QUOTE_CHARS}-char floor")))
        .when(F.contains(needle, F.lit("...")) | F.contains(needle, F.lit("…")), F.lit("quote contains an elision; not a verbatim span"))
        .when(~F.coalesce(F.contains(haystack, needle), F.lit(False)), F.lit("quote does not appear in clean_text"))
    )


# Characters folded on both sides of an evidence comparison.
FOLD_FROM, FOLD_TO = "‘’‚“”„–—−­​﻿", "'''\"\"\"---"


def _alternation(terms: Iterable[str]) -> str:
    """Longest first, so that a longer name is not cut short by a shorter one."""
    return "|".join(re.sub(r"([.&+*?()\[\]{}|^$\\])", r"\\\1", t) for t in sorted(terms, key=lambda t: (-len(t), t)))


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def find_countries(text: Column) -> Column:
    """Sorted, distinct ISO codes of country names (any case) and abbreviations (as written)."""
    names = F.regexp_extract_all(text, F.lit(rf"(?iu)\b(?:{_alternation(V.COUNTRY_NAMES)})\b"), F.lit(0))
    short = F.regexp_extract_all(text, F.lit(rf"\b(?:{_alternation(V.COUNTRY_ABBREVIATIONS)})(?![\w-])"), F.lit(0))
    named = F.transform(names, lambda n: _lookup(V.COUNTRY_NAMES, F.lower(n)))
    return F.array_sort(F.array_distinct(F.concat(named, F.transform(short, lambda a: _lookup(V.COUNTRY_ABBREVIATIONS, a)))))


SECTOR_OF = {s: s for s in V.SECTORS} | V.SECTOR_SYNONYMS


def normalize_sector(sector: Column) -> Column:
    """A sector of the vocabulary, or the collapsed text less one trailing noun."""
    text = name_key(sector)
    trail = rf"^(.*) (?:{'|'.join(V.TRAILING_NOUNS)})$"
    stripped = F.when(text.rlike(trail), F.trim(F.regexp_extract(text, trail, 1))).otherwise(text)
    return F.coalesce(_lookup(SECTOR_OF, text), _lookup(SECTOR_OF, stripped), stripped)


def in_vocabulary(sector: Column) -> Column:
    return sector.isin(*V.SECTORS)


def find_sectors(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(rf"(?iu)\b(?:{_alternation(SECTOR_OF)})\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda s: _lookup(SECTOR_OF, F.lower(s)))))


def export_score(text: Column) -> Column:
    """How much a document is worth annotating."""
    low = F.lower(text)
    words = sum((F.when(F.contains(low, F.lit(w)), 3).otherwise(0) for w in V.THREAT_WORDS), F.lit(0))
    return F.size(F.array_distinct(technique_mentions(text))) * 5 + words + F.least(F.floor(F.length(text) / 5000), F.lit(6)).cast("int")


def slugify(title: Column, limit: int = 48) -> Column:
    base = F.when(F.coalesce(title, F.lit("")) == "", "untitled").otherwise(title)
    slug = F.rtrim(F.substring(F.trim(F.regexp_replace(F.lower(base), "[^a-z0-9]+", "-"), F.lit("-")), 1, limit), F.lit("-"))
    return F.when(slug == "", "untitled").otherwise(slug)


def source_kind(feed_name: Column) -> Column:
    low = F.lower(feed_name)
    return F.when(low.startswith("cisa"), "cisa").when(low.startswith("acsc"), "acsc").otherwise("vendor_blog")


def number(value: Column, digits: int = 3) -> Column:
    return F.coalesce(F.format_string(f"%.{digits}f", value), F.lit("n/a"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; null where a norm is zero or the widths differ."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return F.when(F.size(a) == F.size(b), F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))))
