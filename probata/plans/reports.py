"""Queries that apply the operators on reports, evidence and documents to the driver's tables, with their SQL; they join the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from probata.operators import documents, semantics
from probata.plans import evidence
from probata.plans.catalogue import _query, _t


def _objects(spark, d):
    """Orders as objects: a report for each priority, a customer's orders as objects of one name."""
    type_ = F.when(F.col("o_orderstatus") == "F", "MESH").when(F.col("o_orderstatus") == "O", "ARMATURE").otherwise("LIGHT")
    return _t(spark, d, "orders").select(F.col("o_orderpriority").alias("report"), F.col("o_custkey").cast("string").alias("name"), F.col("o_orderkey").alias("ordinal"), type_.alias("type"), (F.col("o_custkey") % 10).cast("string").alias("parent"))


_OBJECTS = """
    o as (select o_orderpriority as report, o_custkey::varchar as name, o_orderkey as ordinal,
                 case o_orderstatus when 'F' then 'MESH' when 'O' then 'ARMATURE' else 'LIGHT' end as type, (o_custkey % 10)::varchar as parent from orders)
"""


@_query(f"with {_OBJECTS} select report, name, count(*) as n from o where type = 'MESH' group by 1, 2")
def mesh_names(spark, d):
    return semantics.mesh_names(_objects(spark, d)).groupBy("report", "name").agg(F.count(F.lit(1)).alias("n"))


@_query(f"""with {_OBJECTS} select report, name, type, parent from o where type in ('MESH', 'ARMATURE') qualify row_number() over (partition by report, name order by ordinal desc) = 1""")
def hierarchy_last_wins(spark, d):
    return semantics.hierarchy(_objects(spark, d))


@_query("select p_size as report, p_name as name, p_type as semantics, p_brand as semantic_digest from part")
def material_semantics(spark, d):
    return semantics.material_semantics(_t(spark, d, "part").select(F.col("p_size").alias("report"), F.col("p_name").alias("name"), F.col("p_type").alias("semantics"), F.col("p_brand").alias("semantic_digest"), "p_partkey"))


@_query("""
    select label as report, vec_id as name, round(embedding[1]::double, 6) + 0.0 as x, round(embedding[2]::double, 6) + 0.0 as y, round(embedding[64]::double, 6) + 0.0 as z from embeddings
""")
def transforms_rounded(spark, d):
    o = _t(spark, d, "embeddings").select(F.col("label").alias("report"), F.col("vec_id").alias("name"), F.lit(0).alias("ordinal"), F.lit("MESH").alias("type"), F.col("embedding").alias("location"))
    at = lambda k, n: F.get("location", F.lit(k)).alias(n)
    return semantics.transforms(o, ["location"]).select("report", "name", at(0, "x"), at(1, "y"), at(63, "z"))


def _meshes(spark, d):
    p = _t(spark, d, "part")
    box = lambda n: F.array(F.col("p_retailprice") / 7, F.col("p_size").cast("double")).alias(n)
    return p.select(
        F.col("p_size").alias("report"), F.col("p_partkey").alias("name"), F.lit(0).alias("ordinal"), F.lit("MESH").alias("type"), box("min"), box("max"), box("dimensions"),
        F.col("p_size").alias("vertices"), F.length("p_name").alias("triangles"), F.md5(F.col("p_name").cast("binary")).alias("surface_triangle_digest"), F.col("p_brand").alias("uv_triangle_digest"),
    )


@_query("select p_size as report, p_partkey as name, p_size as vertices, length(p_name) as triangles, md5(p_name) as surface_triangle_digest, 'not_compared_by_contract' as uv_triangle_digest from part")
def mesh_semantics(spark, d):
    made = semantics.mesh_semantics(_meshes(spark, d), with_uv=False, topology=("vertices", "triangles"), digests=("surface_triangle_digest", "uv_triangle_digest"))
    return semantics.split_bounds(made)[1]


@_query("select p_size as report, p_partkey as name, round(p_retailprice / 7, 6) as low, round(p_size::double, 6) as high from part")
def mesh_bounds(spark, d):
    made = semantics.mesh_semantics(_meshes(spark, d), topology=(), digests=())
    return semantics.split_bounds(made)[0].select("report", "name", F.get("bounds.min", F.lit(0)).alias("low"), F.get("bounds.dimensions", F.lit(1)).alias("high"))


@_query("select r_name as report, 'rig' as object, n_name as name, r_name as parent, n_nationkey > 9 as use_deform, round(n_nationkey / 7.0::double, 6) as x from nation join region on n_regionkey = r_regionkey")
def rest_joints(spark, d):
    b = _t(spark, d, "nation").join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    at = F.array(F.col("n_nationkey") / F.lit(7.0))
    bones = b.select(F.col("r_name").alias("report"), F.lit("rig").alias("object"), F.col("n_name").alias("name"), F.col("r_name").alias("parent"), (F.col("n_nationkey") > 9).alias("use_deform"), at.alias("head"), at.alias("matrix"))
    return semantics.rest_joints(bones).select("report", "object", "name", "parent", "use_deform", F.get("head", F.lit(0)).alias("x"))


def _clips(spark, d):
    actions = _t(spark, d, "customer").select(F.lit(1).alias("report"), F.col("c_custkey").alias("name"), F.lit(0.0).alias("first"), F.col("c_acctbal").alias("last"))
    o = _t(spark, d, "orders")
    handle = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 3)
    channels = o.select(F.lit(1).alias("report"), F.col("o_custkey").alias("name"), handle.alias("handle"), (F.col("o_orderstatus") == "P").alias("mute"), (F.col("o_totalprice") > 50000).alias("is_valid"), (F.col("o_orderkey") % 4).alias("points"))
    bindings = o.select(F.lit(1).alias("report"), F.col("o_custkey").alias("name"), F.col("o_orderstatus").alias("owner_type"), F.substring("o_orderpriority", 1, 1).alias("owner"), (F.col("o_orderkey") % 5).alias("handle"))
    return semantics.valid_clips(actions, channels, bindings), bindings


_CLIPS = """
    ch as (select o_custkey as name, case when o_orderkey % 3 > 0 then o_orderkey % 3 end as handle from orders where o_orderstatus <> 'P' and o_totalprice > 50000 and o_orderkey % 4 > 0),
    cf as (select name, count(*) as c, count(handle) as h from ch group by 1),
    b as (select o_custkey as name, o_orderstatus as owner_type, substr(o_orderpriority, 1, 1) as owner, o_orderkey % 5 as handle from orders),
    v as (select 1 as report, c_custkey as name, 0.0::double as first, c_acctbal as last,
                 coalesce(c > 0 and (h = 0 or exists (select 1 from b join ch using (name, handle) where b.name = c_custkey)) and c_acctbal > 0, false) as valid
          from customer left join cf on cf.name = c_custkey)
"""


@_query(f"with {_CLIPS} select * from v")
def valid_bound_clips(spark, d):
    return _clips(spark, d)[0]


@_query(f"""with {_CLIPS}
    select report, v.name, round(first, 6) as first, round(last, 6) as last, (select string_agg(distinct owner_type || ':' || owner, ',' order by owner_type || ':' || owner) from b where b.name = v.name) as owners from v where valid
""")
def clip_owners(spark, d):
    return semantics.clips(*_clips(spark, d)).withColumn("owners", F.array_join("owners", ","))


@_query("select vec_id as report, round(embedding[3]::double, 6) + 0.0 as frame, label = 1 as start_end_match, label > 2 as middle_differs from embeddings")
def loop_contract(spark, d):
    e = _t(spark, d, "embeddings").select(F.col("vec_id").alias("report"), F.col("embedding").alias("frames"), (F.col("label") == 1).alias("start_end_match"), (F.col("label") > 2).alias("middle_differs"))
    return semantics.loop_contract(e).select("report", F.get("frames", F.lit(2)).alias("frame"), "start_end_match", "middle_differs")


@_query("""
    with f as (select o_orderkey, case when o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end as o_totalprice from orders)
    (select *, 'stored' as side from (select o_orderkey, o_totalprice from orders except all select * from f)) union all (select *, 'fresh' as side from (select * from f except all select o_orderkey, o_totalprice from orders))
""")
def replay_differs(spark, d):
    o = _t(spark, d, "orders")
    run = lambda name: {"run_id": F.lit(name), "started_at": F.lit(f"at {name}"), "generated_at": F.lit(name)}
    stored = o.select("o_orderkey", "o_totalprice").withColumns(run("a"))
    fresh = o.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice")).withColumns(run("b"))
    return evidence.replay_differs(stored, fresh)


@_query("select n_nationkey, n_regionkey from nation")
def public_columns(spark, d):
    return semantics.public(_t(spark, d, "nation").withColumnRenamed("n_name", "_name"))


@_query("""
    with s as (select l_returnflag, count(*) as lines, count(distinct l_suppkey) as many from lineitem group by 1), i as (select l_returnflag, count(*) as lines, count(distinct l_partkey) as many from lineitem group by 1),
    b as (select l_returnflag, s.lines as s1, i.lines as i1, s.many as s2, i.many as i2 from s join i using (l_returnflag))
    select l_returnflag, 'lines' as counter, s1 as source, i1 as imported, case when s1 = i1 then 'pass' else 'fail' end as verdict from b
    union all select l_returnflag, 'many', s2, i2, case when s2 = i2 then 'pass' else 'fail' end from b
""")
def scene_counters(spark, d):
    li = _t(spark, d, "lineitem")
    side = lambda c: li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct(c).alias("many"))
    return semantics.counters_equal(side("l_suppkey"), side("l_partkey"), "l_returnflag", ["lines", "many"])


@_query("select p_brand, p_type, count(*) as n from part group by 1, 2")
def type_histogram(spark, d):
    return semantics.type_histogram(_t(spark, d, "part"), "p_brand", "p_type")


@_query("select p_brand, sum(p_size)::bigint as triangles, sum(case when p_size > 25 then 1 else 0 end)::bigint as bones, count(*) filter (p_retailprice > 1200) as skinned from part group by 1")
def object_sizes(spark, d):
    return semantics.sizes(_t(spark, d, "part"), "p_brand", F.col("p_size").cast("long"), F.when(F.col("p_size") > 25, 1).otherwise(0), F.col("p_retailprice") > 1200)


@_query("select distinct l_returnflag, l_suppkey from lineitem")
def used_materials(spark, d):
    return semantics.used_materials(_t(spark, d, "lineitem"), "l_returnflag", "l_suppkey")


@_query("""
    with f as (select l_orderkey % 7 as part, l_suppkey % 13 as slot from lineitem), s as (select distinct s_suppkey % 7 as part, s_suppkey % 13 as slot from supplier where s_acctbal >= 0)
    select part, count(*) as faces, count(*) filter (s.slot is null) as missing from f left join s using (part, slot) group by 1
""")
def faces_without_material(spark, d):
    faces = _t(spark, d, "lineitem").select((F.col("l_orderkey") % 7).alias("part"), (F.col("l_suppkey") % 13).alias("slot"))
    slots = _t(spark, d, "supplier").select((F.col("s_suppkey") % 7).alias("part"), (F.col("s_suppkey") % 13).alias("slot"), F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("material"))
    return semantics.faces_without_material(faces, slots, ["part"])


@_query("""
    select l_orderkey % 2 as part, exists (select 1 from supplier where s_suppkey = l_suppkey and s_suppkey % 2 = l_orderkey % 2 and s_acctbal > 0) as deforms, count(*) as n from lineitem group by 1, 2
""")
def weights_by_bone(spark, d):
    w = _t(spark, d, "lineitem").select((F.col("l_orderkey") % 2).alias("part"), F.col("l_suppkey").alias("bone"))
    b = _t(spark, d, "supplier").select((F.col("s_suppkey") % 2).alias("part"), F.col("s_suppkey").alias("name"), (F.col("s_acctbal") > 0).alias("use_deform"))
    return semantics.deforming(w, b, "part", "bone").groupBy("part", "deforms").agg(F.count(F.lit(1)).alias("n"))


@_query("""
    select case when p_size % 3 = 1 and p_size % 2 = 0 and p_retailprice > 1000 and not p_brand like '%1' then 'constant_principled_core_v1' else 'complex_material_unvalidated' end as profile, count(*) as n from part group by 1
""")
def material_profiles(spark, d):
    profile = semantics.material_profile(F.col("p_size") % 3, F.col("p_size") % 2, F.col("p_retailprice") > 1000, F.col("p_brand").like("%1"))
    return _t(spark, d, "part").groupBy(profile.alias("profile")).agg(F.count(F.lit(1)).alias("n"))


@_query("select o_orderpriority, count(*) filter (o_orderstatus = 'F') as image_textures from orders group by 1")
def image_textures(spark, d):
    return semantics.image_textures(_t(spark, d, "orders").withColumn("image", F.when(F.col("o_orderstatus") == "F", "i")), "o_orderpriority", "image")


@_query("""
    with e as (select o_orderpriority, o_orderkey % 4 as f, o_custkey % 2 as w from orders)
    select o_orderpriority, count(*) filter (f = 1) as boundary_edges, count(*) filter (f > 2) as non_manifold_edges, count(*) filter (f = 0) as loose_edges, count(*) filter (f = 2 and w <> 1) as winding_conflicts from e group by 1
""")
def edge_counts(spark, d):
    return semantics.edge_counts(_t(spark, d, "orders").select("o_orderpriority", (F.col("o_orderkey") % 4).alias("faces"), (F.col("o_custkey") % 2).alias("forward")), ["o_orderpriority"])


@_query("""
    with recursive o as (select c_custkey as name, c_custkey // 3 as parent from customer), s as (select name from o where name in (5, 7) union select o.name from o join s on o.parent = s.name) select name from s
""")
def objects_in_scope(spark, d):
    o = _t(spark, d, "customer").select(F.col("c_custkey").alias("name"), F.expr("c_custkey div 3").alias("parent"))
    return semantics.in_scope(o, spark.createDataFrame([(5,), (7,), (5,)], "name long"))


@_query("""
    select label, 2 * count(*) as numbers, arg_min(embedding[1], vec_id)::double as first, arg_max(embedding[2], vec_id)::double as last from embeddings group by 1
""")
def pose_signatures(spark, d):
    e = _t(spark, d, "embeddings").select("label", F.col("vec_id").alias("object"), F.lit(None).cast("string").alias("bone"), F.slice("embedding", 1, 2).alias("values"))
    s = semantics.pose_signature(e, ["label"])
    return s.select("label", F.size("signature").cast("long").alias("numbers"), F.get("signature", F.lit(0)).cast("double").alias("first"), F.element_at("signature", -1).cast("double").alias("last"))


def _outputs(spark, d):
    """Lines as a receipt's outputs; a few lie elsewhere."""
    k = F.col("l_linenumber")
    role = F.when(k == 1, "source_audit").when(k == 2, "import_audit").when(k == 3, "engine_delivery").when(k == 4, "frame_manifest").otherwise("preview")
    path = F.concat(F.lit("./p//"), (k + F.when(F.col("l_discount") >= 0.09, 10).otherwise(0)).cast("string"))
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("receipt"), path.alias("path"), F.concat(F.lit("a"), F.col("l_partkey").cast("string")).alias("sha256"), role.alias("role"))


def _refs(spark, d):
    k = F.col("l_linenumber")
    item = F.when(k == 1, "source_report").when(k == 2, "imported_report").when(k == 3, "delivery").otherwise(F.lit("preview"))
    sha = F.when(F.col("l_tax") > 0.07, "x").otherwise(F.concat(F.lit("A"), F.col("l_partkey").cast("string")))
    run = F.when(F.col("l_quantity") > 45, -1).otherwise(F.col("l_suppkey"))
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("receipt"), item.alias("item"), F.concat(F.lit("p\\"), k.cast("string")).alias("path"), sha.alias("sha256"), F.lit("preview").alias("role"), run.alias("run_id"))


_EVIDENCE = """
    u as (select l_orderkey as receipt, l_linenumber + case when l_discount >= 0.09 then 10 else 0 end as p, 'a' || l_partkey as sha, l_suppkey as run,
                 case l_linenumber when 1 then 'source_audit' when 2 then 'import_audit' when 3 then 'engine_delivery' when 4 then 'frame_manifest' else 'preview' end as role from lineitem),
    r as (select l_orderkey as receipt, case l_linenumber when 1 then 'source_report' when 2 then 'imported_report' when 3 then 'delivery' else 'preview' end as item, l_linenumber as p,
                 case when l_tax > 0.07 then 'x' else 'a' || l_partkey end as sha, case when l_quantity > 45 then -1 else l_suppkey end as run from lineitem),
    f as (select r.*, u.sha as usha, u.role as urole, u.run as urun, u.p is not null as there from r left join u on u.receipt = r.receipt and u.p = r.p)
"""


def _counted(problems):
    return problems.groupBy("receipt", "code", "item").agg(F.count(F.lit(1)).alias("n"))


@_query(f"with {_EVIDENCE} select receipt, 'EVIDENCE_NOT_OUTPUT' as code, item, count(*) as n from f where not there group by all")
def evidence_not_output(spark, d):
    return _counted(evidence.output_problems(_refs(spark, d), _outputs(spark, d), "EVIDENCE_NOT_OUTPUT"))


@_query(f"""with {_EVIDENCE}
    select receipt, case when there then 'ARTIFACT_GATE_REFERENCE_MISMATCH' else 'ARTIFACT_GATE_NOT_OUTPUT' end as code, item, count(*) as n from f where not there or sha <> usha or urole <> 'preview' group by all
""")
def artifact_gate_references(spark, d):
    return _counted(evidence.artifact_problems(_refs(spark, d), _outputs(spark, d)))


@_query(f"""with {_EVIDENCE}, a as (
    select receipt, 'ROUNDTRIP_CHAIN_ENTRY_MISSING' as code, i as item from (select distinct receipt from r), (values ('source_report'), ('imported_report'), ('delivery')) e(i) where not exists (select 1 from r x where x.receipt = r.receipt and x.item = i)
    union all select receipt, 'ROUNDTRIP_CHAIN_NOT_OUTPUT', item from f where not there
    union all select receipt, 'ROUNDTRIP_CHAIN_HASH_MISMATCH', item from f where there and sha <> usha
    union all select f.receipt, 'ROUNDTRIP_RUN_ID_MISMATCH', item from f join u on u.receipt = f.receipt and u.p = f.p where item <> 'delivery' and f.run <> u.run
    ) select receipt, code, item, count(*) as n from a group by all
""".replace("from (select distinct receipt from r),", "from (select distinct receipt from r) r,"))
def comparison_chain(spark, d):
    runs = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_suppkey")
    path = F.concat(F.lit("p/"), (F.col("l_linenumber") + F.when(F.col("l_discount") >= 0.09, 10).otherwise(0)).cast("string"))
    audits = runs.select(F.col("l_orderkey").alias("receipt"), path.alias("path"), F.col("l_suppkey").alias("run_id"))
    return _counted(evidence.chain_problems(_refs(spark, d), _outputs(spark, d), audits))


@_query(f"""with {_EVIDENCE}, one as (select receipt, role, count(*) as n, min(p::varchar) as p from u group by 1, 2),
    x as (select r.receipt, item, r.p, n, one.p as q from (select *, case item when 'source_report' then 'source_audit' when 'imported_report' then 'import_audit' else 'engine_delivery' end as role from r where item <> 'preview') r left join one using (receipt, role))
    select receipt, case when coalesce(n, 0) <> 1 then 'ROUNDTRIP_ROLE_CARDINALITY_INVALID' else 'ROUNDTRIP_ENDPOINT_MISMATCH' end as code, item, count(*) as n from x where coalesce(n, 0) <> 1 or p::varchar <> q group by all
""".replace("count(*) as n from x", "count(*) as m from x").replace("select receipt, case when coalesce(n, 0) <> 1 then", "select receipt, case when coalesce(x.n, 0) <> 1 then").replace("as m from x", "as n from x"))
def chain_endpoints(spark, d):
    return _counted(evidence.endpoint_problems(_refs(spark, d), _outputs(spark, d)))


@_query(f"""with {_EVIDENCE}, g as (select receipt, min(sha) filter (role = 'frame_manifest') as m, min(sha) filter (role = 'engine_delivery') as e from u group by 1),
    a as (select o_orderkey as receipt, o_orderstatus as item, 'A' || o_custkey as manifest, case when o_orderstatus = 'O' then null else 'a1' end as delivery from orders), x as (
    select receipt, 'AUDIT_MANIFEST_BINDING_MISMATCH' as code, item from a left join g using (receipt) where lower(manifest) is distinct from m
    union all select receipt, 'AUDIT_ENGINE_DELIVERY_BINDING_MISMATCH', item from a left join g using (receipt) where delivery is not null and delivery is distinct from e) select receipt, code, item, count(*) as n from x group by all
""")
def audit_bindings(spark, d):
    audits = _t(spark, d, "orders").select(F.col("o_orderkey").alias("receipt"), F.col("o_orderstatus").alias("item"), F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("manifest_sha256"), F.when(F.col("o_orderstatus") != "O", "a1").alias("delivery_sha256"))
    return _counted(evidence.audit_bindings(audits, _outputs(spark, d)))


@_query("""
    select o_orderkey as receipt, 'CONTRACT_GATE_EVIDENCE_MISMATCH' as code, o_orderstatus as item, 1::bigint as n from orders where o_orderpriority = '1-URGENT' or o_orderstatus = 'P'
""")
def contract_gates(spark, d):
    o = _t(spark, d, "orders")
    gates = o.select(F.col("o_orderkey").alias("receipt"), F.col("o_orderstatus").alias("item"), F.when(F.col("o_orderpriority") == "1-URGENT", "c/other.md").otherwise("c/./contract.md").alias("path"), F.concat(F.lit("AB"), "o_orderstatus").alias("sha256"))
    contracts = o.select(F.col("o_orderkey").alias("receipt"), F.lit("c/contract.md").alias("path"), F.when(F.col("o_orderstatus") == "P", "other").otherwise(F.concat(F.lit("ab"), "o_orderstatus")).alias("sha256"))
    return _counted(evidence.contract_problems(gates, contracts))


@_query("""
    with c as (select l_orderkey as receipt, 'c' || l_linenumber as check_id, case when l_returnflag = 'R' then 'fail' else 'pass' end as verdict from lineitem),
    e as (select o_orderkey as receipt, i as check_id from orders, (values ('c1'), ('c2'), ('c3')) v(i)),
    x as (select distinct coalesce(c.receipt, e.receipt) as receipt, coalesce(c.check_id, e.check_id) as item from c full join e on c.receipt = e.receipt and c.check_id = e.check_id where c.receipt is null or e.receipt is null),
    b as (select receipt from x union select receipt from c where verdict = 'fail'), dv as (select o_orderkey as receipt, case when o_orderstatus = 'F' then 'pass' else 'fail' end as verdict from orders), p as (
    select receipt, 'AUDIT_CHECK_INVENTORY_MISMATCH' as code, item from x
    union all select receipt, 'AUDIT_VERDICT_INCONSISTENT', verdict from dv where verdict <> case when receipt in (select receipt from b) then 'fail' else 'pass' end
    union all select receipt, 'AUDIT_VERDICT_NOT_PASS', verdict from dv where verdict <> 'pass') select receipt, code, item, count(*) as n from p group by all
""")
def audit_inventory(spark, d):
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    checks = li.select(F.col("l_orderkey").alias("receipt"), F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("check_id"), F.when(F.col("l_returnflag") == "R", "fail").otherwise("pass").alias("verdict"))
    expected = documents.expected_inventory(o.select(F.col("o_orderkey").alias("receipt"), F.lit(0).alias("n")), "receipt", "n", ["c1", "c2", "c3"], []).withColumnRenamed("item", "check_id")
    declared = o.select(F.col("o_orderkey").alias("receipt"), F.when(F.col("o_orderstatus") == "F", "pass").otherwise("fail").alias("verdict"))
    return _counted(evidence.audit_problems(checks, expected, declared))


@_query("""
    select p_partkey, 'sheet.path' as item from part union all
    select p_partkey, t || i || '.id' as item from (select p_partkey, unnest(range(0, p_size)) as i from part), (values ('frame.'), ('rect.')) v(t)
""")
def expected_inventory(spark, d):
    return documents.expected_inventory(_t(spark, d, "part"), "p_partkey", "p_size", ["sheet.path"], ["frame.{}.id", "rect.{}.id"])


@_query("""
    with p as (select page_id, 'https://x/' || page_id as u from pages) select page_id, 0::int as number, '$.a.u' as location, u as url from p union all select page_id, 1::int, '$.b[1]', u || '?' from p
""")
def https_strings(spark, d):
    u = F.concat(F.lit("https://x/"), F.col("page_id").cast("string"))
    text = F.concat(F.lit('{"a": {"u": "'), u, F.lit('", "n": 1}, "b": ["http://x", "'), u, F.lit('?", null]}'))
    return documents.https_strings(_t(spark, d, "pages").select("page_id", text.alias("text")), "page_id", "text")


@_query("select event_id, 0::int as number, '$.v[1]' as location, 'VALUE_NOT_FINITE' as code from events where value > 50")
def value_problems(spark, d):
    text = F.when(F.col("value") > 50, '{"v": [1, NaN]}').otherwise('{"v": [1, 2.5, true, null]}')
    return documents.value_problems(_t(spark, d, "events").select("event_id", text.alias("text")), "event_id", "text")


@_query("""
    select o_orderkey, coalesce(case o_orderstatus when 'F' then epoch(date_trunc('second', o_orderdate))::bigint when 'O' then epoch(date_trunc('second', o_orderdate))::bigint - 7200 end, -1) as at from orders
""")
def times_with_offset(spark, d):
    text = F.concat(F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("o_orderstatus") == "F", "Z").when(F.col("o_orderstatus") == "O", "+02:00").otherwise(""))
    return _t(spark, d, "orders").select("o_orderkey", F.coalesce(F.unix_timestamp(documents.offset_time(text)), F.lit(-1)).alias("at"))


@_query("select o_orderstatus = 'F' as whole, count(*) as n from orders group by 1")
def whole_numbers(spark, d):
    text = F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "true").otherwise("1.5")
    return _t(spark, d, "orders").groupBy(documents.is_integer(F.try_parse_json(text)).alias("whole")).agg(F.count(F.lit(1)).alias("n"))


@_query("""
    with r as (select p_partkey, p_size * 200 as w, p_size - 1 as h, p_size * 6 as t, p_size * 5 as a, p_retailprice / 200 as c, case p_size % 4 when 0 then 'none' when 1 then 'oklab' when 2 then 'median-cut' else 'x' end as p, case when p_size > 10 then p_size * 6 end as k, p_size > 30 as dt from part)
    select p_partkey, code from r, (values ('FRAME_WIDTH_RANGE'), ('FRAME_HEIGHT_RANGE'), ('BACKGROUND_TOLERANCE_RANGE'), ('ALPHA_THRESHOLD_RANGE'), ('CONTRAST_RANGE'), ('PALETTE_UNKNOWN'), ('PALETTE_NOT_ASKED_FOR'), ('COLORS_REQUIRED'), ('COLORS_RANGE'), ('DITHER_NOT_WITH_OKLAB')) v(code)
    where case code when 'FRAME_WIDTH_RANGE' then w not between 1 and 8192 when 'FRAME_HEIGHT_RANGE' then h not between 1 and 8192 when 'BACKGROUND_TOLERANCE_RANGE' then t not between 0 and 255 when 'ALPHA_THRESHOLD_RANGE' then a not between 0 and 255
        when 'CONTRAST_RANGE' then not (c > 0 and c <= 10) when 'PALETTE_UNKNOWN' then p = 'x' when 'PALETTE_NOT_ASKED_FOR' then p = 'none' and (k is not null or dt) when 'COLORS_REQUIRED' then p <> 'none' and k is null
        when 'COLORS_RANGE' then p <> 'none' and k is not null and k not between 2 and 256 else p = 'oklab' and dt end
""")
def processing_problems(spark, d):
    n = F.col("p_size")
    palette = F.when(n % 4 == 0, "none").when(n % 4 == 1, "oklab").when(n % 4 == 2, "median-cut").otherwise("x")
    r = _t(spark, d, "part").select("p_partkey", (n * 200).alias("frame_width"), (n - 1).alias("frame_height"), (n * 6).alias("background_tolerance"), (n * 5).alias("alpha_threshold"), (F.col("p_retailprice") / 200).alias("contrast"), palette.alias("palette"), F.when(n > 10, n * 6).alias("colors"), (n > 30).alias("dither"))
    return documents.processing_problems(r, "p_partkey")


@_query("""
    select s_nationkey, s_name, rank, case when rank = 1 then 'primary' else 'fallback' end as place from (select *, row_number() over (partition by s_nationkey order by s_acctbal desc nulls last, s_name)::int as rank from supplier) where rank <= 3
""")
def shortlists(spark, d):
    return documents.shortlist(_t(spark, d, "supplier"), "s_nationkey", F.col("s_acctbal"), "s_name", 3).select("s_nationkey", "s_name", "rank", "place")


@_query("select n_name as path from nation union select r_name from region union select n_name from nation")
def all_inputs(spark, d):
    n, r = _t(spark, d, "nation").select(F.col("n_name").alias("path")), _t(spark, d, "region").select(F.col("r_name").alias("path"))
    return documents.all_inputs(n, r, n)


@_query("""
    select case when c_acctbal < 0 then 'absent' when c_mktsegment = 'BUILDING' then 'real-item' when c_nationkey = c_custkey % 25 then 'owned' else 'wrong-owner' end as state, count(*) as n from customer group by 1
""")
def link_ownership(spark, d):
    state = evidence.link_ownership(F.col("c_acctbal") >= 0, F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey").cast("long"), F.col("c_custkey") % 25)
    return _t(spark, d, "customer").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))
