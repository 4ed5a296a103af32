"""Report tables derived from the driver's tables, by the same rules in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vocabulary import ATTRIBUTION


class Tables:
    """Lazy reads of one folder's tables, and the report model over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @staticmethod
    def code(n: Column) -> Column:
        """A country code from a nation key."""
        return F.concat(F.lit("N"), F.char(n + 65))

    def report(self) -> DataFrame:
        p = F.substring("o_orderpriority", 1, 1)
        return self.read("orders").select(F.col("o_orderkey").alias("report_id"), F.to_date("o_orderdate").alias("report_date"), F.when(p.isin("1", "2"), "high").when(p == "3", "medium").otherwise("low").alias("confidence"))

    def threat_actor(self) -> DataFrame:
        return self.read("supplier").select(F.col("s_suppkey").alias("actor_id"), F.col("s_name").alias("canonical_name"), F.array(F.replace("s_name", F.lit("Supplier#"), F.lit("SUP "))).alias("aliases"), self.code(F.col("s_nationkey")).alias("origin"))

    def actor_rows(self) -> DataFrame:
        return self.threat_actor().select(F.col("actor_id").alias("id"), "canonical_name", "aliases", F.col("actor_id").alias("load_ordinal"))

    def report_actor(self) -> DataFrame:
        rank = F.max(F.when(F.col("l_returnflag") == "A", 3).when(F.col("l_returnflag") == "R", 2).otherwise(1))
        pairs = self.read("lineitem").groupBy(F.col("l_orderkey").alias("report_id"), F.col("l_suppkey").alias("actor_id")).agg(rank.alias("r"))
        return pairs.select("report_id", "actor_id", F.element_at(F.array(*map(F.lit, ATTRIBUTION)), F.col("r")).alias("attribution_confidence"))

    def named_actor(self) -> DataFrame:
        """report_actor's reports and actors as the lines name them, repeats included."""
        return self.read("lineitem").select(F.col("l_orderkey").alias("report_id"), F.col("l_suppkey").alias("actor_id"))

    @staticmethod
    def technique(part: Column, line: Column) -> Column:
        return F.concat(F.lit("T"), (part % 600 + 1000).cast("string"), F.when(line % 2 == 0, F.concat(F.lit(".00"), line.cast("string"))).otherwise(F.lit("")))

    def mentions(self) -> DataFrame:
        return self.read("lineitem").select(F.col("l_orderkey").alias("report_id"), F.col("l_linenumber").alias("pos"), self.technique(F.col("l_partkey"), F.col("l_linenumber")).alias("technique_id"), F.col("l_partkey"))

    def techniques(self) -> DataFrame:
        return self.mentions().where(F.col("l_partkey") % 5 != 0).select("technique_id").distinct()

    def report_technique(self) -> DataFrame:
        return self.mentions().select("report_id", "technique_id").distinct()

    @staticmethod
    def sector(segment: Column) -> Column:
        names = {"MACHINERY": "industrial", "BUILDING": "Energy Sector", "AUTOMOBILE": "aviation", "HOUSEHOLD": "healthcare", "FURNITURE": "aerospace parts"}
        out = F.lit(None).cast("string")
        for k, v in names.items():
            out = F.when(segment == k, v).otherwise(out)
        return out

    def report_target(self) -> DataFrame:
        c = self.read("customer").select(F.col("c_custkey").alias("o_custkey"), self.code(F.col("c_nationkey")).alias("country"), self.sector(F.col("c_mktsegment")).alias("sector"))
        return self.read("orders").join(c, "o_custkey").select(F.col("o_orderkey").alias("report_id"), "country", "sector")

    def geo_event(self) -> DataFrame:
        return self.read("events").select("event_id", F.date_add(F.lit("1996-01-01").cast("date"), (F.col("event_id") % 1800).cast("int")).alias("occurred_on"), F.col("event_type").alias("kind"), F.array(self.code(F.col("user_id") % 25)).alias("countries"))

    def feeds(self) -> DataFrame:
        return self.read("documents").select(F.col("source").alias("id")).distinct().select("id", F.col("id").alias("name"), F.lit("rss").alias("kind"))

    def documents(self) -> DataFrame:
        at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("doc_id"))
        return self.read("documents").select(F.col("doc_id").alias("id"), F.col("source").alias("feed_id"), F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string")).alias("source_url"), at.alias("fetched_at"), F.col("text").alias("clean_text"))

    def runs(self) -> DataFrame:
        t = F.col("event_type")
        status = F.when(t == "click", "invalid_json").when(t == "signup", "schema_fail").when(t == "error", "api_error").otherwise("ok")
        return self.read("events").select(F.col("event_id").alias("id"), F.col("user_id").alias("document_id"), F.col("ts").alias("started_at"), status.alias("status"), "value")

    def vectors(self) -> DataFrame:
        return self.read("embeddings").select(F.col("vec_id").alias("report_id"), "embedding", F.concat(F.lit("m"), (F.col("label") % 2).cast("string")).alias("embedding_model"), F.size("embedding").alias("embedding_dim"))

    def judged(self) -> tuple[DataFrame, DataFrame]:
        """(predicted, gold) items: doc is a group of ten, the item an id, the field its source."""
        j = self.read("labels").select("doc_id", "quality").join(self.read("documents").select("doc_id", "source", "n_chars"), "doc_id")
        j = j.select((F.col("doc_id") % 10).alias("doc"), F.col("source").alias("field"), F.col("doc_id").alias("item"), "quality", "n_chars")
        return j.where("n_chars > 1000"), j.where("quality = 1")


SQL = {
    "report": "select o_orderkey as report_id, cast(o_orderdate as date) as report_date, case left(o_orderpriority, 1) when '1' then 'high' when '2' then 'high' when '3' then 'medium' else 'low' end as confidence from orders",
    "threat_actor": "select s_suppkey as actor_id, s_name as canonical_name, replace(s_name, 'Supplier#', 'SUP ') as alias, 'N' || chr(cast(65 + s_nationkey as int)) as origin from supplier",
    "report_actor": "select l_orderkey as report_id, l_suppkey as actor_id, case max(case l_returnflag when 'A' then 3 when 'R' then 2 else 1 end) when 3 then 'confirmed_by_source' when 2 then 'likely' else 'suspected' end as attribution_confidence from lineitem group by all",
    "mentions": "select l_orderkey as report_id, l_linenumber as pos, 'T' || (1000 + l_partkey % 600) || case when l_linenumber % 2 = 0 then '.00' || l_linenumber else '' end as technique_id, l_partkey from lineitem",
    "techniques": "select distinct technique_id from mentions where l_partkey % 5 <> 0",
    "report_target": "select o_orderkey as report_id, 'N' || chr(cast(65 + c_nationkey as int)) as country, case c_mktsegment when 'MACHINERY' then 'industrial' when 'BUILDING' then 'Energy Sector' when 'AUTOMOBILE' then 'aviation' when 'HOUSEHOLD' then 'healthcare' when 'FURNITURE' then 'aerospace parts' end as sector from orders join customer on o_custkey = c_custkey",
    "geo_event": "select event_id, date '1996-01-01' + cast(event_id % 1800 as int) as occurred_on, event_type as kind, 'N' || chr(cast(65 + user_id % 25 as int)) as country from events",
    "report_country": "select distinct p.report_id, report_date, country from (select report_id, country from report_target union all select report_id, origin from report_actor join threat_actor using (actor_id)) p join report using (report_id)",
    "pairs": "select distinct event_id, occurred_on, report_id, report_date from geo_event join report_country using (country) where report_date between occurred_on - 14 and occurred_on + 14",
    "runs": "select event_id as id, user_id as document_id, ts as started_at, case event_type when 'click' then 'invalid_json' when 'signup' then 'schema_fail' when 'error' then 'api_error' else 'ok' end as status, value from events",
    "vectors": "select vec_id as report_id, embedding, 'm' || (label % 2) as embedding_model, len(embedding) as embedding_dim from embeddings",
    "judged": "select doc_id % 10 as doc, source as field, doc_id as item, n_chars > 1000 as p, quality = 1 as g from labels join documents using (doc_id) where n_chars > 1000 or quality = 1",
    "confused": "select doc, field, count(*) filter (p and g) as tp, count(*) filter (p and not g) as fp, count(*) filter (g and not p) as fn from judged group by doc, field",
}

_NEEDS = {"techniques": ("mentions",), "report_country": ("report", "report_target", "report_actor", "threat_actor"), "pairs": ("geo_event", "report_country"), "confused": ("judged",)}


def sql(body: str, *names: str) -> str:
    """`with` the named tables and what they need, then the body."""
    order: list[str] = []

    def add(n: str) -> None:
        for m in _NEEDS.get(n, ()):
            add(m)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return ("with " + ", ".join(f"{n} as ({SQL[n]})" for n in order) + " " if order else "") + body
