"""The corpus operators' queries: opN_<name> for N from 1 to 13, and the pipeline.

A query is thin: it reads its whole table, applies its operator with production
parameters and derives the contract's digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, window=13, layout="words").select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import format_conversations, gather_rows, loss_text, parse_turns

    control = "</s>[INST] ok [/INST]"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    out = format_conversations(gather_rows(rows.unionByName(added)))
    read = out.select("conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=1, window=2048)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge, train

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, train(docs, _table(spark, sf_dir, "labels"))).drop("text")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import search

    vectors = _table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint_bits"), 16, "0")).alias("fingerprint"), "component_id")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_counts import section_tokens

    return section_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, rule="most")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import round_trip

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).drop("text")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import drop_common_lines

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_common_lines(docs, min_docs=10, min_chars=1).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit

    return audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import decontaminate

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, _table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import collapse_runs, planted

    docs = _table(spark, sf_dir, "documents").select("doc_id", planted("doc_id", "text").alias("text"))
    found = collapse_runs(docs, min_length=12)
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))), 1)
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", "runs", "text", F.when(F.size("runs") > 0, best).alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.less") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line.alias("l"), ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_license_scan, op2_substring_dedup, op3_chat_format, op4_pack, op5_quality, op6_ann, op7_simhash, op8_token_counts, op9_bpe, op10_line_dedup, op11_filter_audit, op12_decontaminate, op13_periodic_runs, pipeline)
}

#: DuckDB SQL where SQL can express the query; the others are tested against
#: brute force, exact round trips and held-out accuracy in tests/llm.
ORACLES: dict[str, str] = {
    "op2_substring_dedup": """
        with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') ws from documents),
        g as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') k from (select doc_id, ws, unnest(range(1, len(ws) - 11)) i from w)),
        m as (select k, min(doc_id) lo from g group by k),
        hit as (select distinct g.doc_id, g.i + o as pos from g join m using (k), range(0, 13) r(o) where m.lo < g.doc_id),
        own as (select doc_id, unnest(ws) word, unnest(range(1, len(ws) + 1)) pos from w),
        kept as (select own.doc_id, count(*) n, string_agg(word, ' ' order by own.pos) t from own anti join hit on own.doc_id = hit.doc_id and own.pos = hit.pos group by own.doc_id)
        select w.doc_id, len(ws)::bigint n_words, (len(ws) - coalesce(n, 0))::bigint n_removed, sha256(coalesce(t, '')) kept_sha256
        from w left join kept on w.doc_id = kept.doc_id
    """,
    "op3_chat_format": """
        with r as (
            select conv_id, turn, coalesce(role, '') as "role", coalesce(text, '') as text from conversations
            union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e as (select *, length(role) + length(text) + 11
                + 2 * (length(role) + length(text)) - length(replace(role, '\\', '')) - length(replace(text, '\\', ''))
                + 2 * (length(role) + length(text)) - length(replace(role, '<', '')) - length(replace(text, '<', ''))
                + 2 * (length(role) + length(text)) - length(replace(role, '[', '')) - length(replace(text, '[', ''))
                - 3 * (length(role) + length(text)) + length(role) - length(replace(role, '|', '')) as n from r)
        select conv_id, count(*)::bigint n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) turns_sha256,
            coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) loss_sha256,
            sum(n)::bigint formatted_chars
        from e group by conv_id
    """,
    "op10_line_dedup": """
        with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) x, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) i from documents),
        k as (select *, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l),
        c as (select key, count(distinct doc_id) n from k where key <> '' group by key)
        select doc_id, count(*)::bigint n_lines, count(*) filter (where coalesce(n, 0) >= 10)::bigint n_dropped,
            sha256(coalesce(string_agg(x, chr(10) order by i) filter (where coalesce(n, 0) < 10), '')) kept_sha256
        from k left join c using (key) group by doc_id
    """,
    "op11_filter_audit": """
        with t as (select doc_id, coalesce(lang, '') part, coalesce(text, '') x from documents),
        w as (select *, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') ws, min(doc_id) over (partition by x) lo from t),
        l as (select doc_id, bool_or(quality = 1) g, bool_or(toxic = 1) h from labels group by doc_id),
        m as (select part, {'A': len(ws) < 100, 'B': 100 * len(list_distinct(ws)) < 80 * len(ws), 'C': 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x),
                'D': regexp_matches(x, '[#$%&*|]'), 'E': coalesce(w.doc_id > lo, false)} f, coalesce(g, false) g, coalesce(h, false) h from w left join l on w.doc_id = l.doc_id),
        c as (select part, f.A::int::varchar a, f.B::int::varchar b, f.C::int::varchar c, f.D::int::varchar d, f.E::int::varchar e, count(*) n, count(*) filter (where g) good, count(*) filter (where h) toxic from m group by all),
        s as (select *, case when a = '1' then 'A' else '' end || case when b = '1' then 'B' else '' end || case when c = '1' then 'C' else '' end || case when d = '1' then 'D' else '' end || case when e = '1' then 'E' else '' end fails from c),
        letters as (select unnest(['A', 'B', 'C', 'D', 'E']) x),
        orders as (select a.x || b.x || c.x || d.x || e.x filter_order from letters a, letters b, letters c, letters d, letters e
            where a.x not in (b.x, c.x, d.x, e.x) and b.x not in (c.x, d.x, e.x) and c.x not in (d.x, e.x) and d.x <> e.x),
        steps as (select filter_order, step::int step, filter_order[step] x, filter_order[1:step - 1] before from orders, range(1, 6) r(step)),
        j as (select s.*, filter_order, step, steps.x, contains(fails, steps.x) mine, length(translate(fails, before, '')) < length(fails) gone from s, steps),
        r as (select part, filter_order, step, x, coalesce(sum(n) filter (where not mine and not gone), 0)::bigint kept, coalesce(sum(n) filter (where mine and not gone), 0)::bigint removed,
            coalesce(sum(n) filter (where mine and gone), 0)::bigint redundant, coalesce(sum(n) filter (where fails = x), 0)::bigint unique_fails,
            coalesce(sum(good) filter (where mine and not gone), 0)::bigint good_lost, coalesce(sum(toxic) filter (where mine and not gone), 0)::bigint toxic_lost from j group by all)
        select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) over (partition by part, x))::bigint shapley from r
    """,
    "op12_decontaminate": """
        with d as (select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') ws from documents),
        b as (select item_id, ws, least(10, len(ws)) k from (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') ws from benchmark where item_id is not null) where len(ws) > 0),
        bw as (select distinct item_id, k, array_to_string(ws[i:i + k - 1], ' ') g from (select *, unnest(range(1, len(ws) - k + 2)) i from b)),
        dw as (select r, k, i, array_to_string(ws[i:i + k - 1], ' ') g from (select d.r, d.ws, ks.k, unnest(range(1, len(ws) - ks.k + 2)) i from d, (select distinct k from bw) ks)),
        h as (select dw.r, dw.i, dw.k, bw.item_id from dw join bw using (k, g)),
        n as (select r, count(distinct i + o) n_hit from h, range(0, 10) x(o) where o < k group by r),
        t as (select r, count(*) n_items, string_agg(id, ',' order by id) ids from (select distinct r, item_id::varchar id from h) group by r)
        select doc_id, len(ws)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
        from d left join n using (r) left join t using (r)
    """,
}
