"""The library's own queries by name, with SQL that gives the same rows in DuckDB.

The driver's tables hold no sprites or meshes; each query applies an operator to a table with the same shape of problem.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from probata.functions import numeric, paths
from probata.operators import archive, checks, compare, graph, keys, layout, mesh, raster, ratio
from probata.operators.staging import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _gates(spark: SparkSession, d: str) -> DataFrame:
    """Three gates of each document: it is not empty, its label's quality, and that it is not toxic."""
    docs = _t(spark, d, "documents").select("doc_id", "source", "n_chars")
    labels = _t(spark, d, "labels").select("doc_id", "quality", "toxic")
    both = docs.join(labels, "doc_id", "left")
    result = lambda good, known: F.when(~known, "not_tested").when(good, "pass").otherwise("fail")
    known = F.col("quality").isNotNull()
    gates = F.array(
        F.struct(F.lit("artifact.nonempty").alias("id"), F.lit(True).alias("required"), result(F.col("n_chars") > 0, F.lit(True)).alias("result"), F.lit(False).alias("cites_engine")),
        F.struct(F.lit("engine.quality").alias("id"), F.lit(True).alias("required"), result(F.col("quality") == 1, known).alias("result"), known.alias("cites_engine")),
        F.struct(F.lit("content.toxicity").alias("id"), F.lit(True).alias("required"), result(F.col("toxic") == 0, known).alias("result"), F.lit(False).alias("cites_engine")),
    )
    return both.select("doc_id", "source", F.explode(gates).alias("g")).select("doc_id", "source", "g.*")


@_query("""
    with s as (
        select d.doc_id, d.source, case when d.n_chars <= 0 or l.quality = 0 or l.toxic = 1 then 'failed'
                              when l.doc_id is not null then 'validated' else 'prototype' end as status
        from documents d left join labels l using (doc_id)
    ) select source, status, count(*) as n from s group by source, status
""")
def gate_status_by_source(spark, d):
    return checks.gate_status(_gates(spark, d), "doc_id", "source").groupBy("source", "status").agg(F.count(F.lit(1)).alias("n"))


@_query("""
    with s as (
        select d.doc_id, case when d.n_chars <= 0 or l.quality = 0 or l.toxic = 1 then 'failed'
                              when l.doc_id is null then 'prototype,blocked' else 'validated' end as statuses
        from documents d left join labels l using (doc_id)
    ) select statuses, count(*) as n from s group by statuses
""")
def allowed_statuses(spark, d):
    gates = _gates(spark, d).withColumn("trip", F.lit("pass"))
    out = checks.allowed_statuses(gates, "doc_id", round_trip="trip")
    return out.groupBy(F.array_join("statuses", ",").alias("statuses")).agg(F.count(F.lit(1)).alias("n"))


@_query("""
    select user_id, count(*) filter (event_type = 'error' or value < 5) as errors, count(*) filter (value >= 5 and value < 10 and event_type <> 'error') as warnings,
           case when count(*) filter (event_type = 'error' or value < 5) > 0 then 'fail'
                when count(*) filter (value >= 5 and value < 10) > 0 then 'pass_with_warnings' else 'pass' end as verdict
    from events group by user_id
""")
def severity_verdict(spark, d):
    s = F.when((F.col("event_type") == "error") | (F.col("value") < 5), "error").when(F.col("value") < 10, "warning")
    return checks.severity_verdict(_t(spark, d, "events").withColumn("severity", s), "user_id")


@_query("""
    with e as (select * from (values ('click'), ('view'), ('purchase'), ('refund')) t(event_type)), a as (select distinct event_type from events)
    select coalesce(a.event_type, e.event_type) as event_type, case when a.event_type is null then 'missing' else 'unexpected' end as state
    from a full join e on a.event_type = e.event_type where a.event_type is null or e.event_type is null
""")
def inventory_diff(spark, d):
    expected = spark.createDataFrame([("click",), ("view",), ("purchase",), ("refund",)], "event_type string")
    return keys.inventory_diff(_t(spark, d, "events"), expected, "event_type")


@_query("""
    with s as (select l_orderkey as o, round(sum(l_extendedprice::decimal(18, 2)), 2) as v from lineitem group by 1)
    select case when o.o_orderkey is not null and s.o is not null and abs(o.o_totalprice - s.v::double) <= 100000.0 then 'pass' else 'fail' end as verdict, count(*) as n
    from orders o full join s on s.o = o.o_orderkey group by 1
""")
def snapshot_compare_orders(spark, d):
    source = _t(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"))
    lines = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("value"))
    return compare.within_tolerance(source, lines, ["key"], 100000.0).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


@_query("""
    with p as (select c_custkey as key, c_acctbal as value, 'balance' as path from customer where c_custkey % 2 = 0
               union all select c_custkey, c_nationkey::double, 'nation' from customer where c_custkey % 2 = 0),
         q as (select c_custkey as key, c_acctbal + case when c_custkey % 7 = 0 then 1 else 0 end as value, 'balance' as path from customer where c_custkey % 3 <> 0
               union all select c_custkey, c_nationkey::double, 'nation' from customer where c_custkey % 3 <> 0)
    select coalesce(p.path, q.path) as path, case when p.key is not null and q.key is not null and abs(p.value - q.value) <= 0.5 then 'pass' else 'fail' end as verdict, count(*) as n
    from p full join q on p.key = q.key and p.path = q.path group by 1, 2
""")
def flattened_tolerance(spark, d):
    c = _t(spark, d, "customer")
    change = F.when(F.col("c_custkey") % 7 == 0, 1).otherwise(0)
    a = compare.flattened(c.filter("c_custkey % 2 = 0"), "c_custkey", {"balance": F.col("c_acctbal"), "nation": F.col("c_nationkey")})
    b = compare.flattened(c.filter("c_custkey % 3 <> 0"), "c_custkey", {"balance": F.col("c_acctbal") + change, "nation": F.col("c_nationkey")})
    return compare.within_tolerance(a, b, ["c_custkey", "path"], 0.5).groupBy("path", "verdict").agg(F.count(F.lit(1)).alias("n"))


@_query("""
    select coalesce(a.s_suppkey, b.s_suppkey) as s_suppkey,
           case when a.s_suppkey is not null and b.s_suppkey is not null and a.s_name is not distinct from b.s_name and a.s_nationkey is not distinct from b.s_nationkey then 'pass' else 'fail' end as verdict
    from (select * from supplier where s_suppkey % 5 <> 0) a
    full join (select s_suppkey, s_name, case when s_suppkey % 11 = 0 then null else s_nationkey end as s_nationkey from supplier where s_suppkey % 4 <> 0) b on a.s_suppkey = b.s_suppkey
""")
def equal_signatures(spark, d):
    s = _t(spark, d, "supplier")
    b = s.filter("s_suppkey % 4 <> 0").withColumn("s_nationkey", F.when(F.col("s_suppkey") % 11 != 0, F.col("s_nationkey")))
    return compare.equal_rows(s.filter("s_suppkey % 5 <> 0"), b, ["s_suppkey"], ["s_name", "s_nationkey"])


@_query("""
    with f as (select s_nationkey, count(*) as n from supplier group by 1), s as (select s_nationkey, count(*) + case when s_nationkey % 6 = 0 then 1 else 0 end as n from supplier group by 1)
    select 'stored' as side, * from (select * from s except all select * from f) union all select 'fresh', * from (select * from f except all select * from s)
""")
def recomputed_differs(spark, d):
    fresh = _t(spark, d, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    stored = fresh.withColumn("n", F.col("n") + F.when(F.col("s_nationkey") % 6 == 0, 1).otherwise(0))
    return compare.recomputed_differs(stored, fresh).select("side", "s_nationkey", "n")


@_query("""
    with m as (select label, min(vec_id) as v from embeddings group by label), a as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i, label from embeddings),
         d as (select a.vec_id, max(abs(a.x - b.x)) as delta from a join m on m.label = a.label join a b on b.vec_id = m.v and b.i = a.i group by a.vec_id)
    select vec_id, round(delta, 6) as delta, case when delta <= 0.3 then 'pass' else 'fail' end as verdict from d
""")
def motion_max_delta(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    rest = e.groupBy("label").agg(F.min_by("v", "vec_id").alias("v"))
    source = e.select("vec_id", "label").join(rest, "label").select("vec_id", "v")
    return compare.motion_deltas(source, e, "vec_id", "v", 0.3).withColumn("delta", F.round("delta", 6))


@_query("""
    with a as (select c_nationkey as slot, max(c_acctbal) as size from customer group by 1), b as (select s_nationkey as slot, max(s_acctbal) as size from supplier group by 1),
         r as (select a.slot, a.size as reference, b.size as candidate, b.size / a.size as ratio from a join b using (slot) where a.size > 1e-9 and b.size > 1e-9)
    select count(*) as comparable, count(*) filter (ratio not between 0.5 and 1.5) as out_of_range, round(median(ratio), 9) as median_ratio,
           case when median(ratio) between 0.005 and 0.02 then 'hundredth' when median(ratio) between 50 and 200 then 'hundredfold' end as suspected_scale,
           case when count(*) >= 15 and count(*) filter (ratio not between 0.5 and 1.5) = 0 then 'pass' else 'fail' end as verdict from r
""")
def segment_ratio_gate(spark, d):
    a = _t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("slot")).agg(F.max("c_acctbal").alias("size"))
    b = _t(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("slot")).agg(F.max("s_acctbal").alias("size"))
    return ratio.ratio_gate(ratio.segment_ratios(a, b, "slot", "size")).withColumn("median_ratio", F.round("median_ratio", 9))


@_query("""select l_returnflag, round(median(l_extendedprice / l_quantity), 6) as median_ratio from lineitem group by 1""")
def median_ratio(spark, d):
    return _t(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.median(F.col("l_extendedprice") / F.col("l_quantity")), 6).alias("median_ratio"))


@_query("""
    select sha256(text) as digest, count(*) as n, string_agg(doc_id::varchar, ',' order by doc_id) as items from documents where text is not null group by 1 having count(*) > 1
""")
def duplicate_key_report(spark, d):
    docs = _t(spark, d, "documents").filter("text is not null").select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "doc_id")
    return keys.duplicate_report(docs, "digest", "doc_id").withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@_query("""
    with p as (select page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', '') as path from pages),
         i as (select array_to_string(list_transform(list_filter(string_split(path, '/'), lambda c: c not in ('', '.')), lambda c: lower(regexp_replace(c, '[ .]+$', ''))), '/') as identity from p)
    select identity, count(*) as n from i group by 1 having count(*) > 1
""")
def canonical_path_collision(spark, d):
    path = F.regexp_replace(paths.redacted_url(F.col("url")), "^[a-z]+://[^/]*", "")
    return _t(spark, d, "pages").select(paths.collision_identity(path).alias("identity")).groupBy("identity").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@_query("""
    with p as (select page_id, case page_id % 9 when 0 then '../' when 1 then 'con.txt/' when 2 then 'a:b/' when 3 then 'trail./' when 4 then '/' else 'x/' end || url as path from pages)
    select page_id, path, path[1:1] = '/' or list_contains(string_split(path, '/'), '..')
       or len(list_filter(string_split(path, '/'), lambda c: c not in ('', '.') and (contains(c, ':') or c[-1:] = '.' or c[-1:] = ' '
            or regexp_extract(lower(regexp_replace(c, '[ .]+$', '')), '^([^.]*?) *(\\..*)?$', 1) in ('con', 'prn', 'aux', 'nul')))) > 0 as unsafe,
       path <> '.' and path[1:1] <> '/' and not regexp_matches(path, '^[A-Za-z]:') and not list_contains(string_split(path, '/'), '..') as portable from
       (select page_id, replace(replace(path, 'https://', ''), 'http://', '') as path from p)
""")
def unsafe_path_reasons(spark, d):
    k = F.col("page_id") % 9
    lead = F.when(k == 0, "../").when(k == 1, "con.txt/").when(k == 2, "a:b/").when(k == 3, "trail./").when(k == 4, "/").otherwise("x/")
    path = F.replace(F.replace(F.concat(lead, "url"), F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return _t(spark, d, "pages").select("page_id", path.alias("path")).select("page_id", "path", paths.is_unsafe(F.col("path")).alias("unsafe"), paths.is_portable(F.col("path")).alias("portable"))


@_query("""
    with p as (select regexp_replace(url, '[?#].*$', '') as name, strlen(html) as size from pages),
         e as (select lower(regexp_extract(name, '(?:^|/)\\.*[^/.][^/]*?(\\.[^./]+)$', 1)) as ext, size from p where name not like '%/')
    select case when ext = '' then '[no extension]' else ext end as extension, count(*) as files, sum(size)::bigint as bytes from e group by 1
""")
def extension_histogram(spark, d):
    p = _t(spark, d, "pages").select(F.lit(1).alias("archive"), paths.redacted_url(F.col("url")).alias("name"), F.octet_length("html").cast("long").alias("size"))
    return archive.extension_histogram(p, "archive", "name", "size").drop("archive")


@_query("""
    with n as (select doc_id, case when text ilike '%license%' then 'LICENSE-' || doc_id || '.txt' else 'docs/page_' || doc_id || '.html' end as name from documents)
    select doc_id, name, regexp_matches(regexp_replace(lower(regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\\.[^.]+$', '')), '[^a-z0-9]', '', 'g'), 'copying|copyright|license|licence|notice|readme') as license from n
""")
def license_candidates(spark, d):
    name = F.when(F.col("text").ilike("%license%"), F.concat(F.lit("LICENSE-"), "doc_id", F.lit(".txt"))).otherwise(F.concat(F.lit("docs/page_"), "doc_id", F.lit(".html")))
    docs = _t(spark, d, "documents").select("doc_id", name.alias("name"))
    return docs.select("doc_id", "name", paths.is_license(F.col("name")).alias("license"))


def _entries(spark, d):
    """Parts as archive entries: a brand is an archive."""
    p = _t(spark, d, "part")
    k = F.col("p_partkey") % 41
    name = F.concat(
        F.when(k == 0, "../").when(k == 1, "aux/").otherwise("assets/"),
        F.lower(F.replace("p_name", F.lit(" "), F.lit("_"))),
        F.when(k == 2, ".EXE").when(k == 3, ".cs").when(k < 12, "_license.txt").when(k == 13, "/").otherwise(".png"),
    )
    size = F.when(k == 14, 0).otherwise(F.col("p_size") * 1000).cast("long")
    return p.select(
        F.col("p_brand").alias("archive"),
        name.alias("filename"),
        size.alias("file_size"),
        F.when(k == 15, 0).otherwise(F.greatest(F.lit(1), F.col("p_size") * F.when(k == 16, 2).otherwise(400))).cast("long").alias("compress_size"),
        F.when(k == 17, F.lit(0xA1FF << 16)).otherwise(F.lit(0x81A4 << 16)).cast("long").alias("external_attr"),
        F.when(k == 18, 1).otherwise(0).cast("long").alias("flag_bits"),
    )


@_query("""
    with p as (
        select p_brand as archive, p_size, p_partkey % 41 as k, lower(replace(p_name, ' ', '_')) as stem from part
    ), e as (
        select archive, k, case when k = 14 then 0 else p_size * 1000 end as size, case when k = 15 then 0 else greatest(1, p_size * case when k = 16 then 2 else 400 end) end as packed,
               case when k = 0 then '../' when k = 1 then 'aux/' else 'assets/' end || stem || case when k = 2 then '.EXE' when k = 3 then '.cs' when k < 12 then '_license.txt' when k = 13 then '/' else '.png' end as name
        from p
    ), i as (
        select archive, max(c) as most from (select archive, array_to_string(list_transform(list_filter(string_split(name, '/'), lambda c: c not in ('', '.')), lambda c: lower(regexp_replace(c, '[ .]+$', ''))), '/') as id, count(*) as c from e group by 1, 2) group by 1
    ), s as (
        select archive, count(*) as entries, coalesce(max(case when k <> 13 and size > 0 then size / greatest(1, packed) end), 1.0) as max_ratio,
               bool_or(k in (0, 1)) as unsafe, bool_or(k between 4 and 11 or k = 1 or k = 0) as x, bool_or(k = 2) as executable, bool_or(k in (2, 3)) as code,
               bool_or(regexp_matches(name, 'license') and k <> 13) as license, bool_or(k = 17) as link, bool_or(k = 18) as encrypted, bool_or(k <> 13 and size > 0 and packed = 0) as zero,
               sum(case when k = 13 then 0 else size end) as total, max(case when k <> 13 then size end) as single
        from e group by 1
    ), r as (
        select archive, entries, round(max_ratio, 6) as max_ratio, list_filter([case when unsafe then 'unsafe_archive_paths' end, case when executable then 'unexpected_executables' end,
               case when not license then 'missing_license_evidence' end, case when link then 'link_or_special_entries' end, case when encrypted then 'encrypted_entries_cannot_be_audited' end,
               case when zero then 'nonempty_zero_compressed_entries' end, case when most > 1 then 'duplicate_or_case_colliding_paths' end, case when code then 'code_or_auto_compiled_entries_require_review' end,
               case when entries > 10000 then 'entry_count_limit_exceeded' end, case when total > 1073741824 then 'total_uncompressed_limit_exceeded' end,
               case when single > 536870912 then 'single_file_limit_exceeded' end, case when max_ratio > 200 then 'compression_ratio_limit_exceeded' end], lambda c: c is not null) as reasons
        from s join i using (archive)
    ) select archive, entries, max_ratio, array_to_string(reasons, ',') as blocked_reasons, case when len(reasons) > 0 then 'blocked' else 'pass' end as verdict, len(reasons) = 0 as safe_to_extract from r
""")
def archive_verdicts(spark, d):
    out = archive.archive_verdicts(_entries(spark, d))
    return out.withColumns({"blocked_reasons": F.array_join("blocked_reasons", ","), "max_ratio": F.round("max_ratio", 6)})


@_query("""
    select source, round(coalesce(max(case when n_chars > 0 then strlen(text) / n_chars end), 1.0), 6) as max_ratio, sum(strlen(text))::bigint as total, max(strlen(text))::bigint as single,
           case when max(strlen(text)) > 20000 then 'blocked' else 'pass' end as verdict from documents group by source
""")
def size_ratio_limits(spark, d):
    size = F.octet_length("text").cast("long")
    out = _t(spark, d, "documents").groupBy("source").agg(
        F.round(F.coalesce(F.max(F.when(F.col("n_chars") > 0, size / F.col("n_chars"))), F.lit(1.0)), 6).alias("max_ratio"), F.sum(size).alias("total"), F.max(size).alias("single")
    )
    return out.withColumn("verdict", F.when(F.col("single") > 20000, "blocked").otherwise("pass"))


@_query("""select user_id, ts, event_id, event_type from events qualify row_number() over (partition by user_id order by ts, event_id) = 1""")
def keep_first_per_user(spark, d):
    return keys.keep_first(_t(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"])


@_query("""
    with b as (select distinct p_brand from part)
    select p_brand, row_number() over (order by lower(regexp_replace(p_brand, '[0-9]+', '', 'g')), coalesce(try_cast(regexp_extract(p_brand, '([0-9]+)', 1) as bigint), 0)) as rank from b
""")
def natural_sort_rank(spark, d):
    b = _t(spark, d, "part").select("p_brand").distinct()
    return b.select("p_brand", F.row_number().over(Window.orderBy(paths.natural_key(F.col("p_brand")))).cast("long").alias("rank"))


@_query("""
    select p_partkey, p_brand, p_size from (select *, lag(p_size) over (partition by p_brand order by p_partkey) as b from part) where b = p_size
""")
def adjacent_ambiguity(spark, d):
    p = _t(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return keys.adjacent_equal(p, ["p_brand"], F.col("p_partkey"), F.col("p_size"))


_GRID = """(select p_brand, p_partkey, p_size, row_number() over (partition by p_brand order by p_partkey) - 1 as ordinal from part)"""


@_query(f"""
    select p_brand, p_partkey, ordinal, ordinal % 8 as col, ordinal // 8 as row, 2 + (ordinal % 8) * 34 as x, 2 + (ordinal // 8) * 34 as y from {_GRID}
""")
def grid_layout(spark, d):
    p = _t(spark, d, "part").select("p_brand", "p_partkey")
    return layout.grid_places(p, ["p_partkey"], 32, 32, 8, 2, by=["p_brand"])


def _rects(spark, d):
    p = _t(spark, d, "part").select("p_brand", "p_partkey", "p_size")
    g = layout.grid_places(p, ["p_partkey"], 32, 32, 8, 0, by=["p_brand"])
    return g.select("p_brand", "p_partkey", "x", "y", F.col("p_size").alias("w"), (F.col("p_size") + 3).alias("h"))


_RECTS = f"(select p_brand, p_partkey, (ordinal % 8) * 32 as x, (ordinal // 8) * 32 as y, p_size as w, p_size + 3 as h from {_GRID})"


@_query(f"""
    select a.p_brand, a.p_partkey as a, b.p_partkey as b from {_RECTS} a join {_RECTS} b on a.p_brand = b.p_brand and a.p_partkey < b.p_partkey
      and a.x < b.x + b.w and b.x < a.x + a.w and a.y < b.y + b.h and b.y < a.y + a.h
""")
def rect_overlap(spark, d):
    return layout.overlaps(_rects(spark, d), "p_brand", "p_partkey")


@_query(f"""
    with q as (select p_brand, p_partkey, x + 30 as x, y + 17 as y from {_RECTS})
    select q.p_brand, q.x, q.y from q where not exists (select 1 from {_RECTS} r where r.p_brand = q.p_brand and q.x >= r.x and q.x < r.x + r.w and q.y >= r.y and q.y < r.y + r.h)
""")
def gutter_violations(spark, d):
    r = _rects(spark, d)
    points = r.select("p_brand", (F.col("x") + 30).alias("x"), (F.col("y") + 17).alias("y"))
    return layout.outside(points, r, "p_brand")


@_query("""
    select label, generate_subscripts(embedding, 1) - 1 as dim, unnest(embedding)::double as v from embeddings
""".replace("select label, ", "select label, dim, round(min(v), 6) as min_v, round(max(v), 6) as max_v from (select label, ") + ") group by 1, 2")
def bounds_by_label(spark, d):
    e = _t(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("dim", "v")).withColumn("v", F.col("v").cast("double"))
    return mesh.bounds(e, ["label", "dim"], ["v"]).select("label", F.col("dim").cast("long").alias("dim"), F.round("min_v", 6).alias("min_v"), F.round("max_v", 6).alias("max_v"))


@_query("""
    with c as (select label as cluster, embedding[1]::double as a, embedding[2]::double as b from embeddings qualify row_number() over (partition by label order by vec_id) = 1),
         x as (select vec_id, cluster, (embedding[1]::double - a) ^ 2 + (embedding[2]::double - b) ^ 2 as distance from embeddings, c)
    select vec_id, cluster, round(distance, 6) as distance from x qualify row_number() over (partition by vec_id order by distance, cluster) = 1
""")
def nearest_centroid(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", "label", F.col("embedding")[0].cast("double").alias("a"), F.col("embedding")[1].cast("double").alias("b"))
    c = keys.keep_first(e.withColumnRenamed("label", "cluster"), ["cluster"], ["vec_id"]).drop("vec_id")
    return raster.nearest(e.select("vec_id", "a", "b"), c, [], ["a", "b"]).select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


@_query("""
    select l_suppkey, round((sum((l_discount::decimal(18, 4)) * (l_quantity::decimal(18, 2))) / sum(l_quantity::decimal(18, 2)))::double, 6) as l_discount, sum(l_quantity::decimal(18, 2))::double as l_quantity from lineitem group by 1
""")
def weighted_centroid(spark, d):
    li = _t(spark, d, "lineitem").select("l_suppkey", "l_discount", "l_quantity")
    return raster.weighted_means(li, ["l_suppkey"], ["l_discount"], "l_quantity").withColumn("l_discount", F.round("l_discount", 6))


_LAB = """
    with p as (select p_partkey, (p_partkey * 37 % 256) / 255.0::double as r, (p_partkey * 59 % 256) / 255.0::double as g, (p_partkey * 83 % 256) / 255.0::double as b from part),
         l as (select p_partkey, case when r <= 0.04045 then r / 12.92 else pow((r + 0.055) / 1.055, 2.4) end as r, case when g <= 0.04045 then g / 12.92 else pow((g + 0.055) / 1.055, 2.4) end as g,
                      case when b <= 0.04045 then b / 12.92 else pow((b + 0.055) / 1.055, 2.4) end as b from p),
         m as (select p_partkey, cbrt(0.4122214708 * r + 0.5363325363 * g + 0.0514459929 * b) as x, cbrt(0.2119034982 * r + 0.6806995451 * g + 0.1073969566 * b) as y,
                      cbrt(0.0883024619 * r + 0.2817188376 * g + 0.6299787005 * b) as z from l)
    select p_partkey, round(0.2104542553 * x + 0.7936177850 * y - 0.0040720468 * z, 6) + 0.0 as light, round(1.9779984951 * x - 2.4285922050 * y + 0.4505937099 * z, 6) + 0.0 as axis_a,
           round(0.0259040371 * x + 0.7827717662 * y - 0.8086757660 * z, 6) + 0.0 as axis_b from m
"""


@_query(_LAB)
def oklab_of_keys(spark, d):
    c = lambda k: (F.col("p_partkey") * k % 256) / F.lit(255.0)
    lab = numeric.oklab(c(37), c(59), c(83))
    return _t(spark, d, "part").select("p_partkey", *((F.round(x, 6) + 0.0).alias(n) for x, n in zip(lab, ("light", "axis_a", "axis_b"), strict=True)))


@_query("""
    with recursive l as (select distinct a.user_id as u, b.user_id as v from events a join events b on a.event_id + 1 = b.event_id where a.event_id % 3 = 0),
         e as (select u, v from l union select v, u from l),
         r as (select u as node, u as root from e union select e.v, r.root from r join e on e.u = r.node where r.root < e.v)
    select node, min(root) as root from r group by node having count(*) > 0 and node in (select u from e where u <> v)
""")
def connected_components(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id")
    after = e.select((F.col("event_id") - 1).alias("event_id"), F.col("user_id").alias("v"))
    links = e.filter("event_id % 3 = 0").join(after, "event_id").select(F.col("user_id").alias("u"), "v")
    return graph.connected_components(links)


@_query("""
    with p as (select *, coalesce(lead(x) over w, first(x) over w) as nx, coalesce(lead(y) over w, first(y) over w) as ny
               from (select user_id, event_id, (event_id % 101)::bigint as x, (event_id % 89)::bigint as y from events) window w as (partition by user_id order by event_id))
    select user_id, sum(x * ny - nx * y)::bigint as twice_area from p group by 1
""")
def shoelace_area(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_id", (F.col("event_id") % 101).alias("x"), (F.col("event_id") % 89).alias("y"))
    return mesh.shoelace(e, ["user_id"], "event_id", "x", "y")


@_query("""
    with s as (select user_id, list(value order by event_id) as v from events group by 1), t as (select user_id, v[1] as first, v[len(v) // 2 + 1] as middle, v[-1] as last from s)
    select user_id, first, middle, last, abs(first - last) <= 10 and abs(first - middle) > 10 as loops from t
""")
def loop_seam(spark, d):
    return compare.loop_seams(_t(spark, d, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", "value", 10)


@_query("""
    select o_custkey, sha256(string_agg(k, ';' order by k)) as digest from (select o_custkey, o_orderkey::varchar || ':' || o_orderstatus as k from orders) group by 1
""")
def set_digest(spark, d):
    return keys.set_digest(_t(spark, d, "orders"), ["o_custkey"], F.concat_ws(":", F.col("o_orderkey").cast("string"), "o_orderstatus"))


@_query("""
    with h as (select l_orderkey % 7 as part, l_orderkey, sum(l_discount::decimal(18, 4)) filter (l_discount > 0) as s, count(*) filter (l_discount > 0) as n from lineitem group by 1, 2)
    select part, count(*) filter (n > 0) as weighted, count(*) filter (n = 0) as unweighted, count(*) filter (n > 0 and abs(s - 1) > 0.8) as non_normalised, max(n) as max_influences from h group by 1
""")
def weight_normalisation(spark, d):
    li = _t(spark, d, "lineitem").select((F.col("l_orderkey") % 7).alias("part"), "l_orderkey", F.col("l_discount").cast("decimal(18,4)").alias("w"))
    return mesh.weight_facts(li, li, "part", "l_orderkey", "w", 0.8)


@_query("""
    select r as parent, n as child, exists (select 1 from nation join region on n_regionkey = r_regionkey where r_name = r and n_name = n) as there
    from (values ('EUROPE', 'FRANCE'), ('FRANCE', 'ASIA'), ('ASIA', 'CHINA')) x(r, n)
""")
def parent_chain(spark, d):
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    links = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"))
    return keys.chain_links(links, ["EUROPE", "FRANCE", "ASIA", "CHINA"], "child", "parent")


@_query("""
    select 'label' as kind, count(*) as n from labels l where not exists (select 1 from documents d where d.doc_id = l.doc_id)
    union all select 'unlabelled', count(*) from documents d where not exists (select 1 from labels l where d.doc_id = l.doc_id)
    union all select 'order', count(*) from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)
""")
def dangling_refs(spark, d):
    docs, labels, orders, lines = (_t(spark, d, t) for t in ("documents", "labels", "orders", "lineitem"))
    count = lambda kind, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
    return (
        count("label", keys.dangling(labels, docs, "doc_id", "doc_id"))
        .union(count("unlabelled", keys.dangling(docs.select("doc_id"), labels, "doc_id", "doc_id")))
        .union(count("order", keys.dangling(orders.select("o_orderkey"), lines, "o_orderkey", "l_orderkey")))
    )


@_query("""
    select conv_id, count(*) filter (turn = 0) = 1 as one_first, count(*) filter (role = 'system') = 1 as one_system from conversations group by 1
""")
def exactly_one_role(spark, d):
    return keys.exactly_one(_t(spark, d, "conversations"), ["conv_id"], {"one_first": F.col("turn") == 0, "one_system": F.col("role") == "system"})


@_query("""
    with s as (select l_orderkey, min(l_shipdate) as shipped from lineitem group by 1)
    select coalesce(o_orderdate <= shipped, false) as ordered, count(*) as n from orders left join s on l_orderkey = o_orderkey group by 1
""")
def run_order(spark, d):
    shipped = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("shipped"))
    both = _t(spark, d, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return both.groupBy(compare.run_order(both, "o_orderdate", "shipped").alias("ordered")).agg(F.count(F.lit(1)).alias("n"))


@_query("""
    select event_type, count(*) as n, count(*) filter (json_valid(props)) as valid, count(*) filter (json_type(props) = 'OBJECT') as objects,
           count(*) filter (list_sort(json_keys(props)) = (select list_sort(json_keys(props)) from events order by event_id limit 1)) as same_keys from events group by 1
""")
def json_props_check(spark, d):
    e = _t(spark, d, "events").withColumn("v", F.try_parse_json("props"))
    names = F.array_sort(F.json_object_keys("props"))
    first = e.groupBy().agg(F.min_by(names, "event_id").alias("want"))
    both = e.withColumn("names", names).crossJoin(F.broadcast(first))  # one row
    return both.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v").isNotNull()).alias("valid"), F.count_if(F.schema_of_variant("v").startswith("OBJECT")).alias("objects"), F.count_if(F.col("names") == F.col("want")).alias("same_keys")
    )


@_query("""select user_id, event_type, min(event_id) as first from events group by 1, 2""")
def distinct_in_order(spark, d):
    return keys.distinct_in_order(_t(spark, d, "events"), ["user_id"], "event_type", "event_id")


@_query("""
    select p_partkey, p_brand, case when n = 0 then p_brand else p_brand || '-' || n end as out_name from (select p_partkey, p_brand, row_number() over (partition by p_brand order by p_partkey) - 1 as n from part)
""")
def collision_suffix(spark, d):
    return keys.numbered_names(_t(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey")


@_query("""
    with w as (select n_name as name, n_regionkey::varchar as target from nation where n_nationkey % 4 <> 0),
         r as (select n_name as name, case when n_nationkey % 6 = 0 then 'x' else n_regionkey::varchar end as target from nation where n_nationkey % 3 <> 1)
    select coalesce(w.name, r.name) as name, case when r.name is null then 'new' when w.name is null then 'stale' when w.target = r.target then 'keep' else 'changed' end as state from w full join r on w.name = r.name
""")
def link_state_3way(spark, d):
    n = _t(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("target"))
    recorded = n.filter("n_nationkey % 3 <> 1").withColumn("target", F.when(F.col("n_nationkey") % 6 == 0, "x").otherwise(F.col("target")))
    return keys.link_states(n.filter("n_nationkey % 4 <> 0"), recorded, "name", "target")


@_query("""
    with c as (select l_returnflag, l_quantity, count(*) as n from lineitem group by 1, 2)
    select l_returnflag, l_quantity, n from c qualify row_number() over (partition by l_returnflag order by n desc, l_quantity) = 1
""")
def histogram_mode(spark, d):
    return keys.mode(_t(spark, d, "lineitem"), ["l_returnflag"], "l_quantity")


@_query("""
    select event_type, case when event_type like '%purchase%' then 'available' when event_type like '%error%' then 'no_permission' when event_type like '%log%' then 'not_activated' else 'unknown' end as state, count(*) as n from events group by 1, 2
""")
def error_code_classify(spark, d):
    states = {"available": ["%purchase%"], "no_permission": ["%error%"], "not_activated": ["%log%"]}
    return _t(spark, d, "events").groupBy("event_type", checks.classified(F.col("event_type"), states).alias("state")).agg(F.count(F.lit(1)).alias("n"))


@_query("""
    select source, array_to_string(list_filter([case when not bool_or(lang = 'de') then 'de' end, case when not bool_or(lang = 'en') then 'en' end, case when not bool_or(lang = 'es') then 'es' end,
        case when not bool_or(lang = 'fr' and n_chars > 5000) then 'fr' end, case when not bool_or(lang = 'xx') then 'xx' end], lambda x: x is not null), ',') as missing from documents group by 1
""")
def coverage_missing(spark, d):
    e = _t(spark, d, "documents").select("source", F.col("lang").alias("domain"), ((F.col("lang") != "fr") | (F.col("n_chars") > 5000)).alias("current"))
    return checks.coverage(e, "source", ["de", "en", "es", "fr", "xx"])


@_query("""
    with g as (select doc_id as subject, quality, toxic from labels), p as (
        select subject, 'GATE_REASON_REQUIRED' as code from g where quality = 0 union all select subject, 'GATE_EVIDENCE_REQUIRED' from g where toxic = 1
        union all select subject, 'REQUIRED_GATE_NOT_APPLICABLE' from g where quality = 1 and toxic = 0 and subject % 10 = 0)
    select code, count(*) as n from p group by 1
""")
def gate_problems(spark, d):
    g = _t(spark, d, "labels").select(F.col("doc_id").alias("subject"), "quality", "toxic")
    none = F.array().cast("array<string>")
    some = F.array(F.lit("label:1"))
    first = g.select("subject", F.lit("q").alias("id"), F.lit(True).alias("required"), F.when(F.col("quality") == 0, "not_tested").otherwise("pass").alias("result"), some.alias("evidence"), F.lit(None).cast("string").alias("reason"))
    second = g.select("subject", F.lit("t"), F.lit(True), F.lit("pass"), F.when(F.col("toxic") == 1, none).otherwise(some), F.lit(None).cast("string"))
    third = g.filter("quality = 1 and toxic = 0 and subject % 10 = 0").select("subject", F.lit("n"), F.lit(True), F.lit("not_applicable"), some, F.lit("not part of it"))
    return checks.gate_problems(first.union(second).union(third)).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@_query("""
    with c as (select doc_id as subject, 'nonempty' as check_id, n_chars::varchar as observed, n_chars > 0 as ok from documents union all select doc_id, 'language', lang, lang in ('en', 'de', 'fr') from documents)
    select subject, count(*) filter (not ok) as failures, case when bool_and(ok) then 'pass' else 'fail' end as verdict from c group by 1
""")
def check_verdicts(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "n_chars", "lang")
    c = checks.check(docs, "doc_id", "nonempty", F.col("n_chars") > 0, F.col("n_chars")).union(checks.check(docs, "doc_id", "language", F.col("lang").isin("en", "de", "fr"), F.col("lang")))
    return checks.all_pass(c, "subject")


@_query("""
    select page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*://)[^/@]*@', '\\1') as url from pages
""")
def url_redaction(spark, d):
    return _t(spark, d, "pages").select("page_id", paths.redacted_url(F.col("url")).alias("url"))


@_query("""
    with a as (select doc_id, sha256(text) as s from documents) select doc_id, regexp_matches(s, '^[0-9a-f]{64}$') as fine, regexp_matches(upper(s), '^[0-9a-f]{64}$') as upper_fine from a
""")
def sha256_predicate(spark, d):
    a = _t(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("s"))
    return a.select("doc_id", paths.is_sha256(F.col("s")).alias("fine"), paths.is_sha256(F.upper("s")).alias("upper_fine"))


@_query("""
    select l_linenumber, count(*) filter (a = 255) as opaque, count(*) filter (a = 0) as clear, count(*) filter (a > 0 and a < 255) as partial
    from (select l_linenumber, case when l_partkey % 256 < 20 then 0 else l_partkey % 256 end as a from lineitem) group by 1
""")
def alpha_histogram(spark, d):
    px = _t(spark, d, "lineitem").select(F.col("l_linenumber").alias("asset"), *((F.col("l_partkey") % k).alias(c) for c, k in (("r", 7), ("g", 5), ("b", 3), ("a", 256))))
    return raster.alpha_histogram(raster.alpha_threshold(px, 20)).withColumnRenamed("asset", "l_linenumber")


@_query("""
    select l_linenumber, count(distinct (l_partkey % 7, l_partkey % 5, l_partkey % 3)) as colours from lineitem where l_partkey % 256 > 0 group by 1
""")
def visible_colours(spark, d):
    px = _t(spark, d, "lineitem").select(F.col("l_linenumber").alias("asset"), *((F.col("l_partkey") % k).alias(c) for c, k in (("r", 7), ("g", 5), ("b", 3), ("a", 256))))
    return raster.visible_colours(px).withColumnRenamed("asset", "l_linenumber")


@_query("""
    with v as (select p_partkey as v, (p_partkey % 23)::double as x, (p_partkey % 29)::double as y, (p_partkey % 31)::double as z from part)
    select v, min(v) over (partition by round(x / 4)::bigint, round(y / 4)::bigint, round(z / 4)::bigint) as weld from v
""")
def welded_vertices(spark, d):
    v = _t(spark, d, "part").select(F.lit(1).alias("mesh"), F.col("p_partkey").alias("v"), *((F.col("p_partkey") % k).cast("double").alias(c) for c, k in (("x", 23), ("y", 29), ("z", 31))))
    return mesh.welded(v, 4.0).select("v", "weld")


@_query("""
    with m as (select vec_id, [embedding[i]::double for i in [1, 2, 3, 4, 5, 6, 7, 8, 9]] as e from embeddings),
         x as (select vec_id, e[1] * (e[5] * e[9] - e[6] * e[8]) - e[2] * (e[4] * e[9] - e[6] * e[7]) + e[3] * (e[4] * e[8] - e[5] * e[7]) as d from m)
    select vec_id, round(d, 9) + 0.0 as determinant, case when abs(d) <= 1e-4 then 'singular' when d < 0 then 'negative' end as issue from x
""")
def transform_issues(spark, d):
    m = F.slice(F.col("embedding").cast("array<double>"), 1, 9)
    return _t(spark, d, "embeddings").select("vec_id", (F.round(numeric.determinant3(m), 9) + 0.0).alias("determinant"), mesh.transform_issues(m, 1e-4).alias("issue"))
