"""Explicit schemas of the tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


S, I, B, D, TS, F64 = T.StringType(), T.IntegerType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.DoubleType()

FEED = _struct(id=S, name=S, url=S, kind=S, poll_interval_minutes=I, etag=S, last_modified=S, last_polled_at=TS, enabled=B, fetch_articles=B)
RAW_DOCUMENT = _struct(id=S, feed_id=S, source_url=S, fetched_at=TS, content_hash=S, title=S, published_at=TS, raw_html=S, clean_text=S)
THREAT_ACTOR = _struct(id=S, canonical_name=S, aliases=T.ArrayType(S), suspected_origin_country=S, misp_uuid=S, load_ordinal=T.LongType())
ATTACK_TECHNIQUE = _struct(technique_id=S, name=S, tactic=S)
ENRICHMENT_RUN = _struct(id=S, document_id=S, model=S, prompt_version=S, started_at=TS, finished_at=TS, status=S, raw_response=S, attempt=I, chunk_index=I)
REPORT = _struct(id=S, document_id=S, enrichment_run_id=S, summary=S, report_date=D, confidence=S, embedding=T.ArrayType(T.FloatType()), embedding_model=S, embedding_dim=I)
REPORT_ACTOR = _struct(report_id=S, actor_id=S, attribution_confidence=S)
REPORT_TECHNIQUE = _struct(report_id=S, technique_id=S, evidence_quote=S)
REPORT_TARGET = _struct(id=S, report_id=S, country=S, sector=S)
IOC = _struct(id=S, report_id=S, kind=S, value_defanged=S)
ACTOR_REVIEW_QUEUE = _struct(id=S, report_id=S, raw_name=S, attribution_confidence=S, best_match_actor_id=S, best_match_score=F64, created_at=TS, resolved=B)
GEO_EVENT = _struct(id=S, occurred_on=D, title=S, kind=S, countries=T.ArrayType(S), source_url=S, notes=S)
TABLES = {"feed": FEED, "raw_document": RAW_DOCUMENT, "threat_actor": THREAT_ACTOR, "attack_technique": ATTACK_TECHNIQUE, "enrichment_run": ENRICHMENT_RUN, "report": REPORT, "report_actor": REPORT_ACTOR, "report_technique": REPORT_TECHNIQUE, "report_target": REPORT_TARGET, "ioc": IOC, "actor_review_queue": ACTOR_REVIEW_QUEUE, "geo_event": GEO_EVENT}

EXTRACTION = _struct(
    summary=S,
    report_date=D,
    confidence=S,
    actors=T.ArrayType(_struct(name=S, attribution_confidence=S)),
    techniques=T.ArrayType(_struct(technique_id=S, evidence_quote=S)),
    targets=T.ArrayType(_struct(country=S, sector=S)),
    iocs=T.ArrayType(_struct(kind=S, value=S)),
)
PARSED_DOCUMENT = _struct(source_url=S, title=S, published_at=TS, raw_html=S, clean_text=S)
#: Unique keys that sinks enforce.
KEYS = {"feed": ("url",), "raw_document": ("feed_id", "content_hash"), "threat_actor": ("canonical_name",), "attack_technique": ("technique_id",), "report": ("document_id",), "report_actor": ("report_id", "actor_id"), "report_technique": ("report_id", "technique_id"), "report_target": ("id",), "ioc": ("report_id", "kind", "value_defanged"), "actor_review_queue": ("report_id", "raw_name")}
