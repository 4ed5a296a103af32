"""Arrow UDFs for what no built-in expresses. Each works on whole batches."""

from __future__ import annotations

import functools
import ipaddress
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime
from email.utils import parsedate_to_datetime
from html.entities import html5
from html.parser import HTMLParser
from xml.etree import ElementTree
from xml.parsers import expat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X
from . import vocabulary as V

SKIPPED = ("script", "style")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Tree(HTMLParser):
    """Text nodes with the element stack's spans; tolerant of what is never closed."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.skip = 0
        self.open: list[tuple[str, int, int]] = []  # tag, first text, source offset
        self.spans: list[tuple[str, int, int, int, int]] = []
        self.title: str | None = None
        self.lines: list[int] = [0]

    def run(self, html: str):
        for m in re.finditer("\n", html):
            self.lines.append(m.end())
        self.source = html
        self.feed(html)
        self.close()
        while self.open:
            self._pop(len(html))
        return self

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skip += 1
        if tag not in VOID:
            self.open.append((tag, len(self.texts), self._at()))

    def _pop(self, end: int):
        tag, first, start = self.open.pop()
        self.spans.append((tag, first, len(self.texts), start, end))

    def handle_endtag(self, tag):
        if tag in SKIPPED and self.skip:
            self.skip -= 1
        if any(t == tag for t, *_ in self.open):
            end = self.source.find(">", self._at()) + 1
            while self.open:
                done = self.open[-1][0] == tag
                self._pop(end)
                if done:
                    break

    def handle_data(self, data):
        if not self.skip:
            if any(t == "title" for t, *_ in self.open):
                self.title = (self.title or "") + data
            self.texts.append(data)


_GAP = re.compile(r"[ \t\r\f\v]+")
_BLANK = re.compile(r"\n{3,}")
_REFERENCE = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")


def _ended(reference: re.Match) -> str:
    """A reference that ends in its semicolon as it is; the & of anything else written as one."""
    name = reference[1]
    return reference[0] if name and (name[0] == "#" or name in html5) else "&amp;" + reference[0][1:]


def clean_html(html: str | None, ended: bool = False) -> str:
    """Readable text of HTML: text nodes on lines of their own, scripts and styles left out.

    ended: only references that end in a semicolon are characters; browsers (and the default) read `&amp` as one too.
    """
    joined = "\n".join(_Tree().run(_REFERENCE.sub(_ended, html or "") if ended else html or "").texts)
    lines = [x.strip() for x in _GAP.sub(" ", joined).splitlines()]
    return _BLANK.sub("\n\n", "\n".join(lines)).strip()


def article_html(html: str | None) -> str | None:
    """The <article> with most text, else <main>, else null."""
    tree = _Tree().run(html or "")

    def size(span) -> int:
        return len(" ".join(t.strip() for t in tree.texts[span[1] : span[2]] if t.strip()))

    articles = sorted((s for s in tree.spans if s[0] == "article"), key=lambda s: s[3])
    best = max(articles, key=size, default=None)
    if best is None or not size(best):
        best = next((s for s in sorted(tree.spans, key=lambda s: s[3]) if s[0] == "main" and size(s)), None)
    return html[best[3] : best[4]] if best else None


@F.pandas_udf(T.StringType())
def html_text(html: pd.Series) -> pd.Series:
    return html.map(clean_html)


@F.pandas_udf(T.StringType())
def html_text_of_ended(html: pd.Series) -> pd.Series:
    """html_text where only references with their semicolon are characters, so that a cut one (`&amp`) stays as it was written."""
    return html.map(lambda x: clean_html(x, ended=True))


@F.pandas_udf(T.StringType())
def html_article(html: pd.Series) -> pd.Series:
    return html.map(article_html)


_FOLDS = {ord(c): X.FOLD_TO[i] if i < len(X.FOLD_TO) else None for i, c in enumerate(X.FOLD_FROM)}


def canonical(text: str | None) -> str | None:
    """NFKC, quotes and dashes folded, white space collapsed; case stays."""
    if text is None:
        return None
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_FOLDS)
    return " ".join(text.split())


@F.pandas_udf(T.StringType())
def canonicalize(text: pd.Series) -> pd.Series:
    return text.map(canonical, na_action="ignore")


# Boundary tiers, largest unit first: paragraph, sentence, word.
TIERS = tuple(re.compile(p) for p in (r"\n\s*\n", r"(?<=[.!?])\s+", r"\s+"))


def split_spans(text: str, limit: int) -> list[tuple[int, int]]:
    """Contiguous spans of at most `limit` characters that together are the text.

    A span ends at the last paragraph break that fits; one that is still too long
    is cut again at sentences, then words, then anywhere.
    """
    todo, out = [(0, len(text), 0)], []
    while todo:
        lo, hi, tier = todo.pop()
        if hi - lo <= limit:
            out.append((lo, hi))
        elif tier == len(TIERS):
            out += [(a, min(a + limit, hi)) for a in range(lo, hi, limit)]
        else:
            ends = [m.end() + lo for m in TIERS[tier].finditer(text[lo:hi])]
            ends = [e for e in ends if lo < e < hi] + [hi]
            pieces, start, last = [], lo, lo
            for e in ends:
                if e - start > limit and last > start:
                    pieces.append((start, last))
                    start = last
                last = e
            pieces.append((start, hi))
            todo += [(a, b, tier + 1) for a, b in reversed(pieces)]
    return sorted(out)


def split_text(text: str, limit: int) -> list[str]:
    if len(text) <= limit:
        return [text]
    return [text[a:b] for a, b in split_spans(text, limit) if text[a:b].strip()]


CHUNKS = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("chunk", T.StringType())]))


#: Bytes of text that are Python objects at once.
SLICE_BYTES = 1 << 20


def slices(texts: pa.Array) -> Iterator[slice]:
    """Row ranges of about SLICE_BYTES of text each, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield slice(lo, hi)
        lo = hi


def _chunks(texts: pa.Array, limit: int) -> pa.Array:
    """One list of chunks for each text, null for null."""
    ends, pos, start, end, chunk = [0], [], [], [], []
    for t in texts.to_pylist():
        if t is None:
            ends[-1] = None
        else:
            spans = [(0, len(t))] if len(t) <= limit else [(a, b) for a, b in split_spans(t, limit) if t[a:b].strip()]
            pos += range(len(spans))
            start += [a for a, _ in spans]
            end += [b for _, b in spans]
            chunk += [t[a:b] for a, b in spans]
        ends.append(len(pos))
    parts = pa.StructArray.from_arrays([pa.array(pos, pa.int32()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(chunk, pa.string())], ["pos", "start", "end", "chunk"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)


def with_chunks(rows: DataFrame, limit: int, text: str = "text", name: str = "parts") -> DataFrame:
    """rows with the chunks of each text in its place; null has none.

    Only a slice of a batch's texts is Python objects and a batch that goes back, so a task's memory doesn't follow how many rows come at once.
    """
    kept = [f for f in rows.schema if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text)
            for s in slices(texts):
                own = [batch.column(f.name)[s] for f in kept]
                yield pa.RecordBatch.from_arrays([*own, _chunks(texts[s], limit)], [*(f.name for f in kept), name])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(name, CHUNKS)]))


# How indicators look in prose, in the order of the passes.
SCANS = (
    ("url", r"(?i)\bhttps?://[^\s<>\"')\]]{3,2000}"),
    ("email", r"\b[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]+\.[A-Za-z]{2,63}\b"),
    ("ipv4", r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"),
    ("sha256", r"\b[a-fA-F0-9]{64}\b"),
    ("md5", r"\b[a-fA-F0-9]{32}\b"),
    ("domain", r"(?i)\b(?:[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?\.)+(?:com|net|org|io|ru|cn|info|biz|top|xyz|online|site|club|shop|live|icu|cc|tk|pw|su|me|co|uk|de|fr|nl|br|in|ir|kp|us|au|nz|ca|jp|kr)\b"),
)
# Hosts that stay as they are.
HOSTS_LEFT = frozenset((
    "cisa.gov",
    "www.cisa.gov",
    "cyber.gov.au",
    "www.cyber.gov.au",
    "mitre.org",
    "attack.mitre.org",
    "nvd.nist.gov",
    "nist.gov",
    "microsoft.com",
    "github.com",
    "talosintelligence.com",
    "blog.talosintelligence.com",
    "example.com",
    "example.org",
))


@dataclass(frozen=True)
class Kind:
    """How an indicator is made inert: the part of it that names a host, and the characters that are bracketed there."""

    shape: re.Pattern | None
    part: re.Pattern
    marks: str = "."

    def valid(self, value: str) -> bool:
        return self.shape is None or self.shape.match(value) is not None

    def inert(self, value: str) -> str:
        found = self.part.fullmatch(value)
        bracketed = "".join(f"[{c}]" if c in self.marks else c for c in found["host"])
        before = found.groupdict().get("before") or ""
        if before.endswith("://"):
            before = ("hxxps" if before.lower().startswith("https") else "hxxp") + "://"
        elif before:
            before = before.removesuffix("@") + "[@]"
        return before + bracketed + (found.groupdict().get("after") or "")


_WHOLE = re.compile(r"(?P<host>.*)", re.S)
_SHAPES = {k: re.compile(p) for k, p in X.SHAPES.items()}
_OCTETS = re.compile("^" + r"\.".join([r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"] * 4) + r"\Z")
KINDS = {
    "ipv4": Kind(_OCTETS, _WHOLE),
    "ipv6": Kind(re.compile(r"(?=[^:]*:[^:]*:)" + X.SHAPES["ipv6"]), _WHOLE, ":"),
    "domain": Kind(_SHAPES["domain"], _WHOLE),
    "url": Kind(_SHAPES["url"], re.compile(r"(?P<before>[^:]*://)(?P<host>[^/]*)(?P<after>.*)", re.S)),
    "email": Kind(_SHAPES["email"], re.compile(r"(?P<before>.*@)(?P<host>[^@]*)", re.S)),
    "sha256": Kind(_SHAPES["sha256"], _WHOLE, ""),
    "md5": Kind(_SHAPES["md5"], _WHOLE, ""),
}
_SCANS = tuple((KINDS[k], re.compile(p)) for k, p in SCANS)


def inert(kind: str, value: str) -> str | None:
    """The defanged value, null if it doesn't have its kind's shape (the scalar twin of text.defang_ioc)."""
    plain = functools.reduce(lambda v, pair: v.replace(*pair), X.REFANG, value.strip())
    how = KINDS.get(kind)
    if how is None or not how.valid(plain) or kind == "ipv4" and max(map(len, plain.split("."))) > 3:
        return None
    return how.inert(plain) if how.marks else plain.lower()


def host_in(kind: Kind, value: str) -> str:
    return kind.part.fullmatch(value)["host"].rstrip(".").lower() if kind.marks else ""


def _swapped(text: str, kind: Kind, pattern: re.Pattern) -> tuple[str, int]:
    """The text with one kind's indicators made inert, except on hosts that are left, and how many changed."""
    pieces, at, changed = [], 0, 0
    for m in pattern.finditer(text):
        value = m[0]
        if host_in(kind, value) in HOSTS_LEFT or not kind.valid(value):
            continue
        new = kind.inert(value) if kind.marks else value.lower()
        if new != value:
            pieces += [text[at : m.start()], new]
            at, changed = m.end(), changed + 1
    return "".join([*pieces, text[at:]]), changed


def defang_prose(text: str) -> tuple[str, int]:
    """Every indicator in prose made inert, one kind after another, and how many changed."""
    total = 0
    for kind, pattern in _SCANS:
        text, n = _swapped(text, kind, pattern)
        total += n
    return text, total


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("changed", T.IntegerType())]))
def defang_text(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None) if t is None else defang_prose(t) for t in text], columns=["text", "changed"])


def feed_date(value: str | None) -> datetime | None:
    """An RFC 2822 date, else an ISO 8601 one, else null; without a zone it is UTC."""
    got = None
    if value:
        try:
            got = parsedate_to_datetime(value)
        except (TypeError, ValueError):
            try:
                got = datetime.fromisoformat(value.replace("Z", "+00:00"))
            except ValueError:
                return None
    return got if got is None or got.tzinfo else got.replace(tzinfo=UTC)


@F.pandas_udf(T.TimestampType())
def parse_date(value: pd.Series) -> pd.Series:
    return pd.to_datetime(value.map(feed_date), utc=True)


class UnsafeXml(ValueError):
    """The body declares a document type or an entity, or isn't well formed."""


def safe_xml(body: bytes | str) -> ElementTree.Element:
    """The root of XML that declares no document type, entity or external reference."""
    raw = body.encode() if isinstance(body, str) else bytes(body)

    def refuse(*_):
        raise UnsafeXml("document types and entities are refused")

    guard = expat.ParserCreate()
    guard.StartDoctypeDeclHandler = guard.EntityDeclHandler = guard.ExternalEntityRefHandler = refuse
    try:
        guard.Parse(raw, True)
        return ElementTree.fromstring(raw)
    except (expat.ExpatError, ElementTree.ParseError) as e:
        raise UnsafeXml("not well formed") from e


@F.pandas_udf(T.BooleanType())
def xml_is_safe(body: pd.Series) -> pd.Series:
    def one(x):
        try:
            safe_xml(x if x is not None else b"")
            return True
        except UnsafeXml:
            return False

    return body.map(one)


def disallowed(address: str | None) -> bool:
    """Whether an address must not be fetched from; what isn't an address must not either."""
    try:
        ip = ipaddress.ip_address(address or "")
    except ValueError:
        return True
    ip = getattr(ip, "ipv4_mapped", None) or ip
    return any((ip.is_private, ip.is_loopback, ip.is_link_local, ip.is_reserved, ip.is_multicast, ip.is_unspecified))


class SchemaFail(ValueError):
    pass


def _object(value, fields: dict, required: tuple[str, ...]) -> dict:
    if not isinstance(value, dict):
        raise SchemaFail("an object is wanted")
    if extra := set(value) - set(fields):
        raise SchemaFail(f"unknown key {sorted(extra)[0]}")
    if missing := [k for k in required if k not in value]:
        raise SchemaFail(f"missing key {missing[0]}")
    return {k: check(value[k]) for k, check in fields.items() if k in value}


def _string(least: int = 0, most: int = 1 << 30):
    def check(v):
        if not isinstance(v, str):
            raise SchemaFail("a string is wanted")
        v = v.strip()
        if not least <= len(v) <= most:
            raise SchemaFail(f"length {len(v)} is not within {least}..{most}")
        return v

    return check


def _one_of(*values: str):
    def check(v):
        v = v.strip() if isinstance(v, str) else v
        if v not in values:
            raise SchemaFail(f"not one of {', '.join(values)}")
        return v

    return check


def _maybe(check):
    return lambda v: None if v is None else check(v)


def _list(fields: dict, required: tuple[str, ...]):
    def check(v):
        if not isinstance(v, list):
            raise SchemaFail("a list is wanted")
        return [_object(x, fields, required) for x in v]

    return check


def _country(v):
    v = _string()(v).upper()
    if not re.fullmatch("[A-Z]{2}", v):
        raise SchemaFail("a country is two letters")
    return v


def _date(v):
    try:
        return date.fromisoformat(_string()(v)).isoformat()
    except ValueError as e:
        raise SchemaFail("not a date") from e


_ATTRIBUTED = _one_of(*V.ATTRIBUTION)
CONTRACT = {
    "summary": _string(1, 600),
    "report_date": _maybe(_date),
    "confidence": _one_of(*V.CONFIDENCE),
    "actors": _list({"name": _string(1, 200), "attribution_confidence": _ATTRIBUTED}, ("name", "attribution_confidence")),
    "techniques": _list({"technique_id": lambda v: _string(5, 16)(v).upper(), "evidence_quote": _string(1, 1000)}, ("technique_id", "evidence_quote")),
    "targets": _list({"country": _maybe(_country), "sector": _maybe(_string(0, 100))}, ()),
    "iocs": _list({"kind": _one_of(*V.IOC_KINDS), "value": _string(1, 2048)}, ("kind", "value")),
}


#: A code fence around the whole answer; its opening line ends before the body begins.
_FENCE = re.compile(r"\s*```(?:json|JSON)?\s*\n(.*?)\n?\s*```\s*", re.S)


def parse_contract(raw: str | None) -> tuple[str, str | None, str | None]:
    """(status, error, clean JSON) of a model's answer under the strict contract."""
    text = raw or ""
    text = (_FENCE.sub(r"\1", text) if _FENCE.fullmatch(text) else text).strip()
    try:
        data = json.loads(text)
    except ValueError as e:
        return "invalid_json", str(e), None
    try:
        clean = _object(data, CONTRACT, ("summary", "confidence"))
    except SchemaFail as e:
        return "schema_fail", str(e), None
    for k in ("actors", "techniques", "targets", "iocs"):
        clean.setdefault(k, [])
    return "ok", None, json.dumps(clean, ensure_ascii=False)


@F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in ("status", "error", "extraction_json")]))
def contract(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_contract(x) for x in raw], columns=["status", "error", "extraction_json"])
