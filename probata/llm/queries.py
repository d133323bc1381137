"""The queries opN_<name> over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, htmltext, jaccard, langid, linededup, mixlm, pieces, suffixes, topk, warc
from .common import table


def piece_model() -> str:
    """The default vocabulary file; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), piece_model())


def op3_mixlm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixlm.scored(table(spark, sf_dir, "documents"))


def op4_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.fixity(table(spark, sf_dir, "pages"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_identified(table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


QUERIES = {"op1_decontaminate": op1_decontaminate, "op2_pieces": op2_pieces, "op3_mixlm": op3_mixlm, "op4_htmltext": op4_htmltext, "op5_jaccard": op5_jaccard, "op6_linededup": op6_linededup, "op7_suffixes": op7_suffixes, "op8_warc": op8_warc, "op9_langid": op9_langid, "op10_topk": op10_topk}

ORACLES = {
    "op5_jaccard": r"""
        with recursive w as (
            select doc_id, row_number() over () as r,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
            from documents
        ), s as (
            select distinct doc_id, r, array_to_string(w[i:i + 4], ' ') as s
            from (select doc_id, r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)
        ), n as (select doc_id, r, count(*) as n from s group by 1, 2
        ), p as (
            select a.doc_id as a, b.doc_id as b, a.r as ar, b.r as br, count(*) as m from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by all
        ), l as (
            select distinct a, b from p join n x on x.r = p.ar join n y on y.r = p.br where 100 * m >= 80 * (x.n + y.n - m)
        ), e as (select a, b from l union select b, a from l
        ), c as (select a as doc_id, a as root from e union select e.b, c.root from c join e on e.a = c.doc_id where c.root < e.b
        ), m as (select doc_id, min(root) as root from c group by 1)
        select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, case when n.n > 0 then coalesce(m.root, w.doc_id) else w.doc_id end as component_id
        from w left join n using (r) left join m on m.doc_id = w.doc_id
    """,
    "op7_suffixes": """
        with d as (select doc_id, row_number() over () as r, hex(encode(coalesce(text, ''))) as h from documents
        ), g as (select doc_id, r, i, substr(h, 2 * i + 1, 100) as s from (select doc_id, r, h, unnest(range(0, len(h) // 2 - 49)) as i from d where len(h) >= 100)
        ), f as (select s, min(doc_id) as first from g group by 1
        ), x as (select r, i from g join f using (s) where first < doc_id
        ), y as (select r, i, max(i + 50) over (partition by r order by i rows between unbounded preceding and 1 preceding) as reach from x
        ), z as (select r, i, sum(case when reach is null or i > reach then 1 else 0 end) over (partition by r order by i) as k from y
        ), spans as (select r, k, min(i) as a, max(i) + 50 as b from z group by 1, 2
        ), gaps as (
            select r, a, b, lag(b, 1, 0) over (partition by r order by a) as before, row_number() over (partition by r order by a desc) = 1 as last from spans
        ), kept as (
            select r, count(*) as n_spans, sum(b - a) as n_removed, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as h, max(case when last then substr(d.h, 2 * b + 1) end) as tail
            from gaps join d using (r) group by 1
        )
        select doc_id, (len(d.h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
               sha256(unhex(case when kept.r is null then d.h else kept.h || tail end)) as kept_sha256
        from d left join kept using (r)
    """,
    "op8_warc": """
        with p as (
            select page_id::bigint as page_id, coalesce(url, '') as url, coalesce(html, '') as html,
                   greatest(1, (count(*) over () + 1023) // 1024) as n
            from pages
        ), r as (
            select page_id, url, ('0x' || substr(md5(concat_ws(' ', coalesce(page_id::varchar, ''), url)), 1, 8))::bigint % n as file,
                   substr(md5('damage ' || coalesce(page_id::varchar, '')), 1, 2) as pick,
                   'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:sha256:'
                   || sha256(url || chr(10) || html) || '>' || chr(13) || chr(10) || 'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10)
                   || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
                   || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
                   || html || chr(13) || chr(10) || chr(13) || chr(10) as record
            from p
        ), c as (
            select *, case when pick = '00' then left(record, length(record) - 5) || '#' || right(record, 4)
                           when pick = '01' then repeat('0', strlen(record))
                           when pick = '02' then null else record end as copy
            from r
        ), f as (
            select file, row_number() over w - 1 as number, page_id, url,
                   coalesce(sum(strlen(record)) over (w rows between unbounded preceding and 1 preceding), 0)::bigint as "offset",
                   strlen(record) as length, sha256(record) as kept, sha256(copy) as replica
            from c window w as (partition by file order by page_id nulls first, url, sha256(record))
        )
        select * from f where kept is distinct from replica
    """,
    "op10_topk": """
        with v as (
            select row_number() over () as r, vec_id, list_transform(embedding, lambda e: floor(1024 * e::double)::bigint) as x
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
        ), s as (
            select q.vec_id as query_id, q.r as q_r, c.vec_id, c.r,
                   list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::bigint as score
            from v q join v c on q.r <> c.r and len(q.x) = len(c.x)
            where q.vec_id % 100 = 0
        ), ranked as (
            select *, row_number() over (partition by q_r order by score desc, vec_id, r)::int as rank from s
        )
        select query_id, rank, vec_id, score from ranked where rank <= 10
    """,
}
