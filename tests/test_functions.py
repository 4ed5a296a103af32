"""Scalar functions on golden cases."""

from __future__ import annotations

from datetime import UTC, datetime

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threatlake.functions import text as X
from threatlake.functions import udfs as U
from threatlake.operators.similar import Cell
from threatlake.plans import queries as Q


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in values.items()) or "x string"
    return spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(column.alias("y")).first().y


@pytest.mark.parametrize(
    ("kind", "value", "want"),
    [
        ("url", "https://a.b.example/p.bin", "hxxps://a[.]b[.]example/p.bin"),
        ("url", "hxxps://a[.]b[.]example/p", "hxxps://a[.]b[.]example/p"),
        ("email", "x@b.example", "x[@]b[.]example"),
        ("ipv6", "2001:db8::1", "2001[:]db8[:][:]1"),
        ("ipv4", "999.0.2.44", None),
        ("url", "ftp://a.example/", None),
        ("nonsense", "x", None),
    ],
)
def test_defang_both_ways(spark, kind, value, want):
    got = one(spark, X.defang_ioc(F.col("k"), F.col("v")), k=kind, v=value)
    assert got.value_defanged == want == U.inert(kind, value)
    assert got.ok == (want is not None)
    assert got.ok or value not in got.reason


def test_defang_prose_leaves_versions_and_known_hosts():
    text, n = U.defang_prose("see https://evil.example/a.co, 1.3.6.1.4.1.9.9.96 and github.com or x@bad.com, " + "AB" * 16)
    assert "hxxps://evil[.]example/" in text and "1.3.6.1.4.1.9.9.96" in text and "github.com" in text and "x[@]bad[.]com" in text and "ab" * 16 in text
    assert n >= 3
    assert U.defang_prose(text)[0] == text


@pytest.mark.parametrize(
    ("sector", "want"),
    [("Health Care", "health care"), ("healthcare", "health care"), ("Healthcare sector", "health care"), ("Energy Sector", "energy"), ("telecommunications", "communications"), ("water", "water and sewerage"), ("defence industry", "defence industry"), ("utilities", "energy"), ("aerospace parts", "aerospace parts"), ("  ", "")],
)
def test_sectors(spark, sector, want):
    assert one(spark, X.normalize_sector(F.col("s")), s=sector) == want


def test_countries(spark):
    assert one(spark, X.find_countries(F.col("s")), s="Russian crews hit us and US sites in South Korea, U.K.") == ["GB", "KR", "RU", "US"]


def test_evidence(spark):
    hay = U.canonical("The actors “moved laterally” using\nremote services – quickly.")

    def verdict(quote):
        return one(spark, X.evidence_verdict(F.col("h"), F.col("q")), h=hay, q=U.canonical(quote))

    assert verdict('actors "moved laterally" using remote') is None
    assert verdict("remote services - quickly") is None
    assert "floor" in verdict("moved")
    assert "elision" in verdict("The actors … remote services")
    assert "does not appear" in verdict("THE ACTORS MOVED LATERALLY")


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. \n!", max_size=400), st.integers(1, 60))
def test_chunks_are_contiguous(text, limit):
    spans = U.split_spans(text, limit)
    assert "".join(text[a:b] for a, b in spans) == text
    assert all(b - a <= limit for a, b in spans)
    assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_chunks_break_at_the_largest_unit():
    assert U.split_text("one two.\n\nthree four. five six.", 14) == ["one two.\n\n", "three four. ", "five six."]
    assert U.split_text("a" * 10, 4) == ["aaaa", "aaaa", "aa"]


@pytest.mark.parametrize(
    ("raw", "status"),
    [
        ('{"summary": "s", "confidence": "low"}', "ok"),
        ('```json\n{"summary": " s ", "confidence": "low"}\n```', "ok"),
        ('see ```{"summary": "s"}``` above', "invalid_json"),
        ("[]", "schema_fail"),
        ("3", "schema_fail"),
        ('{"summary": "s", "confidence": "low", "extra": 1}', "schema_fail"),
        ('{"summary": "  ", "confidence": "low"}', "schema_fail"),
        ('{"summary": "s", "confidence": "low", "targets": [{"country": "usa"}]}', "schema_fail"),
        (None, "invalid_json"),
    ],
)
def test_contract(raw, status):
    assert U.parse_contract(raw)[0] == status


def test_best_match_keeps_the_first_of_equals():
    assert Cell(["volt tyfoon", "volt typhoons"], [0, 1]).best("volt typhoon")[0] == 1
    assert Cell(["abc"], [0]).best("zzz") == (-1, 0.0)


@pytest.mark.parametrize("body", ["<!DOCTYPE r [<!ENTITY a 'x'>]><r>&a;</r>", "<r>", ""])
def test_unsafe_xml(body):
    with pytest.raises(U.UnsafeXml):
        U.safe_xml(body)


def test_dates():
    assert U.feed_date("Mon, 01 Jan 2024 10:00:00 +0200") == datetime(2024, 1, 1, 8, tzinfo=UTC)
    assert U.feed_date("2024-01-01T10:00:00Z") == datetime(2024, 1, 1, 10, tzinfo=UTC)
    assert U.feed_date("soon") is None


@pytest.mark.parametrize("address", ["127.0.0.1", "10.0.0.1", "169.254.169.254", "0.0.0.0", "224.0.0.1", "::1", "fe80::1", "fc00::1", "::ffff:127.0.0.1", "name"])
def test_addresses_that_are_refused(address):
    assert U.disallowed(address)


def test_public_address():
    assert not U.disallowed("8.8.8.8")


@pytest.mark.parametrize(
    ("url", "same"),
    [("https://a.example/x", True), ("https://A.example:443/x", True), ("https://b.a.example/", True), ("http://a.example/", False), ("https://a.example.evil.example/", False), ("https://eviла.example/", False), ("https://xa.example/", False), ("not a url", False)],
)
def test_same_site(spark, url, same):
    assert one(spark, X.same_site(F.lit("https://a.example/feed"), F.col("u")), u=url) is same


def test_budget():
    assert X.document_budget(3000, 1502) == 7248
    with pytest.raises(X.BudgetTooSmall, match="MAX_INPUT_TOKENS"):
        X.document_budget(600, 0)


def test_html():
    page = "<html><title>T</title><article>a</article><script>no</script><article>longer &amp; <b>better</b><p>open</article><!-- no --></html>"
    assert U.article_html(page).startswith("<article>longer")
    assert U.clean_html(U.article_html(page)) == "longer &\nbetter\nopen"
    assert U.article_html("<main>m</main>") == "<main>m</main>"
    assert U.article_html("<p>x</p>") is None


def test_html_references_without_their_semicolon(spark, tmp_path):
    page = "<html><title>a&amp;&amp;b &amp</title><p>&copy; &copy &notit; &amp;quot; x&y &#65; &#65 <b>c&amp</b></p></html>"
    assert U.clean_html(page) == "a&&b &\n© © ¬it; &quot; x&y A A\nc&"
    assert U.clean_html(page, ended=True) == "a&&b &amp\n© &copy &notit; &quot; x&y A &#65\nc&amp"
    page = "<html><title>Thatre&amp;&amp;&amp; the&amp;&amp</title><p>it &copy; &quot;is&quot;</p></html>"
    spark.createDataFrame([(1, page)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert [tuple(r) for r in Q.QUERIES["html_clean_text"](spark, str(tmp_path)).collect()] == duck.sql(Q.ORACLES["html_clean_text"]).fetchall()


def test_chunks_come_in_small_batches(spark):
    """Texts of 300 KB, many to a batch: what goes back is cut by bytes, and whole."""

    class Stub:
        schema = spark.createDataFrame([], "id long, text string").schema

        def mapInArrow(self, run, schema):
            return run

    texts = ["word. " * 50_000 + str(k) if k % 5 else None for k in range(40)] + ["", " "]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    out = list(U.with_chunks(Stub(), 2000)(iter([batch])))
    assert max(b.nbytes for b in out) < 3 * U.SLICE_BYTES
    got = {r["id"]: r["parts"] for b in out for r in b.to_pylist()}
    assert list(got) == list(range(len(texts)))
    assert all(p is None if t is None else "".join(x["chunk"] for x in p) == t for t, p in zip(texts, got.values(), strict=True))
    rows = spark.createDataFrame([(1, "a. b c"), (2, None)], "id long, text string")
    assert {r.id: r.parts and [tuple(p) for p in r.parts] for r in U.with_chunks(rows, 3).collect()} == {1: [(0, 0, 3, "a. "), (1, 3, 6, "b c")], 2: None}
