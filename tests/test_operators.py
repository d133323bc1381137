import itertools
import random

import pytest
from pyspark.sql import functions as F

from probata.functions import numeric, paths
from probata.operators import archive, checks, compare, graph, keys, layout, mesh, raster, ratio


@pytest.fixture
def cut(tmp_path):
    n = itertools.count()

    def write(df):
        path = str(tmp_path / f"cut{next(n)}")
        schema = df.schema
        df.write.parquet(path)
        return df.sparkSession.read.schema(schema).parquet(path)

    return write


def test_components_equal_brute_force(spark):
    r = random.Random(1)
    links = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {x["node"]: x["root"] for x in graph.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


@pytest.mark.parametrize(
    "name,unsafe",
    [("a/b.txt", False), ("../a", True), ("/a", True), ("a/../b", True), ("C:/a", True), ("a:b", True), ("a./b", True), ("a /b", True), ("CON", True), ("x/nul.txt", True), ("aux .txt", True), ("console", False), ("a\\..\\b", True), ("./a", False), ("lpt1", True), ("lpt10", False)],
)
def test_unsafe_names(spark, name, unsafe):
    assert spark.createDataFrame([(name,)], "n string").select(paths.is_unsafe(F.col("n"))).first()[0] is unsafe


def test_names(spark):
    rows = [("LICENSE", "", True, False), ("docs/Copying.txt", ".txt", True, False), ("a/b.PNG", ".png", False, False), ("x.cs/readme.md", ".md", True, True), (".gitignore", "", False, False), ("run.SH", ".sh", False, True), ("a.tar.gz", ".gz", False, False), ("dir.v1/file", "", False, False)]
    df = spark.createDataFrame([(r[0],) for r in rows], "n string")
    got = df.select("n", paths.suffix(F.col("n")), paths.is_license(F.col("n")), paths.is_code(F.col("n"))).collect()
    assert [tuple(r) for r in got] == rows
    kinds = df.select(paths.archive_format(F.col("n"), F.lit(b"\x1f\x8b\x08")).alias("k"), paths.archive_format(F.col("n")).alias("m")).collect()
    assert {r["k"] for r in kinds} == {"gzip"} and [r["m"] for r in kinds if r["m"]] == ["tar.gz"]


def test_portable_paths(spark):
    df = spark.createDataFrame([("a/b",), ("",), (".",), ("/a",), ("C:x",), ("a\\b",), ("a/../b",), ("a//b",), (None,)], "n string")
    got = df.select(paths.is_portable(F.col("n")).alias("p"), paths.is_portable(F.col("n"), strict=True).alias("s")).collect()
    assert [(r["p"], r["s"]) for r in got] == [(True, True), *[(False, False)] * 6, (True, False), (False, False)]


def test_natural_order(spark):
    names = ["frame10", "frame2", "Frame1", "a", "frame", "2x", "10x", "frame2b", "frame2a10", "frame2a9"]
    got = [r["n"] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(paths.natural_key(F.col("n"))).collect()]
    import re

    key = lambda v: [(1, int(p), "") if p.isdigit() else (0, 0, p) for p in re.findall(r"\d+|\D+", ("" if not v[0].isdigit() else "") + v.lower())]
    want = sorted(names, key=lambda v: ([(0, 0, "")] if v[0].isdigit() else []) + key(v))
    assert got == want


def test_python_functions(spark):
    df = spark.createDataFrame([("ß", 2.675, '{"b":1,"a":[1,2]}'), (None, None, "nope"), ("é", 0.5, "NaN")], "s string, x double, j string")
    got = df.select(numeric.casefold("s"), F.length(numeric.nfd("s")), numeric.nfc("s"), numeric.round_even("x", F.lit(2)), numeric.canonical_json("j")).collect()
    assert tuple(got[0]) == ("ss", 1, "ß", 2.67, '{"a":[1,2],"b":1}')
    assert tuple(got[1])[:3] == (None, None, None) and got[1][4] is None and got[2][1] == 2 and got[2][4] is None


def test_colours_round_trip(spark):
    df = spark.range(0, 256, 15).select((F.col("id") / 255).alias("r"), ((255 - F.col("id")) / 255).alias("g"), (F.col("id") * 7 % 256 / 255).alias("b"))
    back = numeric.rgb_of_oklab(*numeric.oklab(F.col("r"), F.col("g"), F.col("b")))
    worst = df.select(F.max(F.greatest(*(F.abs(a - F.col(c)) for a, c in zip(back, "rgb", strict=True))))).first()[0]
    assert worst < 1e-4


def gates(spark, rows):
    return spark.createDataFrame([("s", *r) for r in rows], "subject string, id string, required boolean, result string, cites_engine boolean")


@pytest.mark.parametrize(
    "rows,status",
    [
        ([("a", True, "pass", False), ("engine.run", True, "pass", True)], "validated"),
        ([("a", True, "pass", False), ("engine.run", True, "pass", False)], "prototype"),
        ([("a", True, "pass", False), ("b", False, "fail", False)], "failed"),
        ([("blocker.x", True, "not_tested", False), ("engine.run", True, "pass", True)], "blocked"),
        ([("blocker.x", False, "not_tested", False), ("engine.run", True, "pass", True)], "validated"),
        ([("a", True, "not_tested", False), ("engine.run", True, "pass", True)], "prototype"),
        ([("blocker.x", True, "not_tested", False), ("b", False, "fail", False)], "failed"),
    ],
)
def test_statuses(spark, rows, status):
    assert checks.gate_status(gates(spark, rows), "subject").first()["status"] == status


@pytest.mark.parametrize("trip,result,want", [("pass", "pass", ["validated"]), ("fail", "pass", ["failed"]), ("pass", "fail", ["failed"]), ("not_tested", "pass", ["prototype", "blocked"]), ("pass", "not_tested", ["prototype", "blocked"])])
def test_allowed_statuses(spark, trip, result, want):
    g = gates(spark, [("a", True, result, False), ("b", False, "fail", False)]).withColumn("trip", F.lit(trip))
    assert checks.allowed_statuses(g, "subject", round_trip="trip").first()["statuses"] == want


def test_gate_rules(spark):
    rows = [("a", True, "maybe", ["e"], None), ("b", True, "not_applicable", [], "x"), ("c", False, "not_tested", [], " "), ("d", True, "pass", [], None), ("e", True, "pass", ["e"], None), ("f", True, "fail", None, None)]
    df = spark.createDataFrame([("s", *r) for r in rows], "subject string, id string, required boolean, result string, evidence array<string>, reason string")
    got = sorted(r["code"] for r in checks.gate_problems(df).collect())
    assert got == ["GATE_EVIDENCE_REQUIRED", "GATE_EVIDENCE_REQUIRED", "GATE_REASON_REQUIRED", "GATE_RESULT_INVALID", "REQUIRED_GATE_NOT_APPLICABLE"]


def test_archives(spark):
    ok = [("LICENSE", 10, 5, 0, 0), ("a.png", 100, 50, 0x81A40000, 0), ("dir/", 0, 0, 0x41ED0000, 0)]
    cases = {
        "pass": (ok, []),
        "none": ([("a.png", 1, 1, 0, 0)], ["missing_license_evidence"]),
        "code": ([*ok, ("x.cs", 1, 1, 0, 0)], ["code_or_auto_compiled_entries_require_review"]),
        "run": ([*ok, ("x.py", 1, 1, 0, 0)], ["unexpected_executables", "code_or_auto_compiled_entries_require_review"]),
        "link": ([*ok, ("l", 1, 1, 0xA1FF0000, 0)], ["link_or_special_entries"]),
        "bomb": ([*ok, ("b", 1_000_000, 100, 0, 0)], ["compression_ratio_limit_exceeded"]),
        "zero": ([*ok, ("z", 10, 0, 0, 0)], ["nonempty_zero_compressed_entries"]),
        "secret": ([*ok, ("s", 1, 1, 0, 1)], ["encrypted_entries_cannot_be_audited"]),
        "case": ([*ok, ("A.PNG", 1, 1, 0, 0)], ["duplicate_or_case_colliding_paths"]),
        "path": ([*ok, ("../x", 1, 1, 0, 0)], ["unsafe_archive_paths"]),
    }
    rows = [(k, *e) for k, (entries, _) in cases.items() for e in entries]
    df = spark.createDataFrame(rows, "archive string, filename string, file_size long, compress_size long, external_attr long, flag_bits long")
    got = {r["archive"]: r for r in archive.archive_verdicts(df).collect()}
    assert {k: r["blocked_reasons"] for k, r in got.items()} == {k: v for k, (_, v) in cases.items()}
    assert got["pass"]["verdict"] == "pass" and got["pass"]["safe_to_extract"]
    small = {r["archive"]: r["blocked_reasons"] for r in archive.archive_verdicts(df, max_files=1, max_total=1, max_single=1).collect()}
    assert small["pass"] == ["entry_count_limit_exceeded", "total_uncompressed_limit_exceeded", "single_file_limit_exceeded"]


def test_humanoid(spark):
    human = [(s, f"b_{s}", i) for i, s in enumerate(ratio.CORE_SLOTS)]
    skeleton = [(f"b_{s}", [0.0, float(i + 1), 0.0], [1.0, 1.0, 1.0]) for i, s in enumerate(ratio.CORE_SLOTS)]
    h = lambda rows: spark.createDataFrame(rows, "slot_name string, bone string, line int")
    k = lambda rows: spark.createDataFrame(rows, "name string, position array<double>, scale array<double>")
    i = lambda a, b: spark.createDataFrame([(a, b)], "animation_type int, avatar_setup int")
    codes = lambda *a: sorted(r["code"] for r in ratio.humanoid_audit(*a).collect())
    assert codes(i(3, 1), h(human), k(skeleton)) == []
    assert codes(i(2, None), h(human), k(skeleton)) == ["IMPORTER_NOT_HUMANOID"]
    assert codes(i(3, 1), h(human[1:]), k(skeleton)) == ["REQUIRED_SLOT_MISSING"]
    assert codes(i(3, 1), h(human), k(skeleton[1:])) == ["MAPPED_BONE_MISSING"]
    assert codes(i(3, 1), h(human), k([*skeleton[1:], (skeleton[0][0], [0.0, 1.0, 0.0], [1.0, 1.1, 1.0])])) == ["SCALE_DEVIATION"]
    assert codes(i(3, 1), h([*human, ("hips", "b_x", 99)]), k([*skeleton, ("b_x", [0.0, 0.0, 1.0], [1.0] * 3)])) == ["DUPLICATE_SLOT", "REQUIRED_SLOT_MISSING"]
    sizes = ratio.rest_lengths(ratio.mapped_bones(h(human), k(skeleton)))
    scaled = sizes.withColumn("size", F.col("size") / 100)
    gate = ratio.ratio_gate(ratio.segment_ratios(sizes, scaled, "slot", "size")).first()
    assert (gate["verdict"], gate["suspected_scale"], gate["out_of_range"]) == ("fail", "hundredth", 15)
    assert ratio.ratio_gate(ratio.segment_ratios(sizes, sizes, "slot", "size")).first()["verdict"] == "pass"


def test_background_removal(spark, cut):
    art = ["....#", ".##.#", ".#o#.", ".##..", "....."]
    value = {".": (250, 250, 250, 255), "#": (10, 10, 10, 255), "o": (250, 250, 250, 255)}
    px = [("s", x, y, *value[c]) for y, row in enumerate(art) for x, c in enumerate(row)]
    clear = [("t", x, 0, 9, 9, 9, 0) for x in range(3)]
    df = spark.createDataFrame(px + clear, "asset string, x int, y int, r int, g int, b int, a int")
    left = {(r["x"], r["y"]) for r in raster.without_background(df, 24, cut).filter("asset = 's' and a > 0").collect()}
    # A corner is black too, so that what joins it goes as well.
    gone, todo = set(), [(0, 0), (4, 0), (0, 4), (4, 4)]
    while todo:
        x, y = todo.pop()
        if (x, y) in gone or not (0 <= x < 5 and 0 <= y < 5):
            continue
        gone.add((x, y))
        todo += [(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)]
    assert left == {(x, y) for x in range(5) for y in range(5)} - gone
    plain = df.withColumn("r", F.when((F.col("x") == 4) & (F.col("y") == 0), 250).otherwise(F.col("r")))
    plain = plain.withColumns({c: F.when((F.col("x") == 4) & (F.col("y") == 0), 250).otherwise(F.col(c)) for c in "gb"})
    left = {(r["x"], r["y"]) for r in raster.without_background(plain, 24, cut).filter("asset = 's' and a > 0").collect()}
    assert left == {(1, 1), (2, 1), (4, 1), (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)}


def test_palette(spark, cut):
    colours = [(250, 10, 10), (245, 12, 8), (10, 10, 250), (12, 8, 245), (10, 250, 10)]
    rows = [("s", i, n, *c, 255) for i, c in enumerate(colours) for n in range(5 + i)] + [("t", 0, 0, 1, 2, 3, 255), ("s", 9, 9, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "asset string, x int, y int, r int, g int, b int, a int")
    got = {(r["asset"], r["r"], r["g"], r["b"]): (r["pr"], r["pg"], r["pb"]) for r in raster.palette(df, 3, cut).collect()}
    assert got[("t", 1, 2, 3)] == (1, 2, 3)
    assert got[("s", *colours[0])] == got[("s", *colours[1])] != got[("s", *colours[2])] == got[("s", *colours[3])] != got[("s", *colours[4])]


def test_resize_and_fit(spark):
    assert raster.fitted(10, 20, 40, 40, "contain") == (20, 40) and raster.fitted(10, 20, 40, 40, "cover") == (40, 80) and raster.fitted(1, 2, 3, 4, "stretch") == (3, 4)
    df = spark.createDataFrame([("s", x, y, x, y, 0, 255) for x in range(4) for y in range(2)], "asset string, x int, y int, r int, g int, b int, a int")
    up = {(r["x"], r["y"]): (r["r"], r["g"]) for r in raster.resized(df, 4, 2, 8, 6).collect()}
    assert up == {(x, y): (x // 2, y // 3) for x in range(8) for y in range(6)}
    down = {(r["x"], r["y"]): (r["r"], r["g"]) for r in raster.resized(df, 4, 2, 2, 1).collect()}
    assert down == {(0, 0): (1, 1), (1, 0): (3, 1)}


def cube(mesh_id, flip=False):
    v = [(mesh_id, i, float(i & 1), float(i >> 1 & 1), float(i >> 2)) for i in range(8)]
    quads = [(0, 2, 3, 1), (4, 5, 7, 6), (0, 1, 5, 4), (2, 6, 7, 3), (0, 4, 6, 2), (1, 3, 7, 5)]
    t = [tri for a, b, c, d in quads for tri in ((a, b, c), (a, c, d))]
    return v, [(mesh_id, i, *(x[::-1] if flip else x)) for i, x in enumerate(t)]


def test_mesh_components(spark):
    v1, t1 = cube("out")
    v2, t2 = cube("in", flip=True)
    v3, t3 = cube("two")
    far = [("two", i + 8, x + 5, y, z) for _, i, x, y, z in v3]
    more = [("two", i + 12, a + 8, b + 8, c + 8) for _, i, a, b, c in t3[:-1]]
    v = spark.createDataFrame(v1 + v2 + v3 + far, "mesh string, v int, x double, y double, z double")
    t = spark.createDataFrame(t1 + t2 + t3 + more, "mesh string, face int, a int, b int, c int")
    facts = {(r["mesh"], r["component"]): r for r in mesh.component_facts(t, v, mesh.face_components(t)).collect()}
    assert sorted(facts) == [("in", 0), ("out", 0), ("two", 0), ("two", 12)]
    assert (facts["out", 0]["orientation"], facts["in", 0]["orientation"]) == ("outward", "inward")
    assert abs(facts["out", 0]["volume"] - 1) < 1e-9 and facts["out", 0]["closed"] and facts["out", 0]["consistent"]
    assert not facts["two", 12]["closed"] and facts["two", 12]["faces"] == 11
    digest = {r["mesh"]: r["digest"] for r in mesh.triangle_digests(t, v, 0.001).collect()}
    assert digest["out"] != digest["in"]
    turned = t.filter("mesh = 'out'").select("mesh", (11 - F.col("face")).alias("face"), F.col("b").alias("a"), F.col("c").alias("b"), F.col("a").alias("c"))
    assert mesh.triangle_digests(turned, v, 0.001).first()["digest"] == digest["out"]


def test_texture_and_weights(spark):
    uv = [("m", 0, 0, 0.0, 0.0), ("m", 0, 1, 1.0, 0.0), ("m", 0, 2, 0.0, 1.0), ("m", 1, 0, 0.5, 0.5), ("m", 1, 1, 0.5, 0.5), ("m", 1, 2, 0.5, 0.5)]
    got = mesh.texture_facts(spark.createDataFrame(uv, "mesh string, face int, corner int, u double, v double")).first()
    assert (got["finite"], got["distinct"], got["collapsed"]) == (True, 4, 1)
    w = spark.createDataFrame([("m", 1, 0.5), ("m", 1, 0.5), ("m", 2, 0.4), ("m", 3, 0.0)], "mesh string, v int, w double")
    vs = spark.createDataFrame([("m", i) for i in range(1, 5)], "mesh string, v int")
    assert tuple(mesh.weight_facts(w, vs, "mesh", "v", "w").first())[1:] == (2, 2, 1, 2)


def test_layout(spark):
    rects = [("s", 0, 0, 0, 10, 10), ("s", 1, 10, 0, 10, 10), ("s", 2, 5, 5, 200, 10), ("s", 3, 400, 400, 0, 5)]
    df = spark.createDataFrame(rects, "sheet string, k int, x int, y int, w int, h int")
    assert sorted((r["a"], r["b"]) for r in layout.overlaps(df, "sheet", "k").collect()) == [(0, 2), (1, 2)]
    points = spark.createDataFrame([("s", 0, 0), ("s", 204, 14), ("s", 205, 14), ("s", 400, 400)], "sheet string, x int, y int")
    assert sorted((r["x"], r["y"]) for r in layout.outside(points, df, "sheet").collect()) == [(205, 14), (400, 400)]


def test_motion_and_loops(spark):
    a = spark.createDataFrame([(1, [1.0, 2.0]), (2, []), (3, [1.0])], "k int, v array<double>")
    b = spark.createDataFrame([(1, [1.0, 2.5]), (2, []), (3, [1.0, 2.0])], "k int, v array<double>")
    got = {r["k"]: (r["delta"], r["verdict"]) for r in compare.motion_deltas(a, b, "k", "v", 0.1).collect()}
    assert got == {1: (0.5, "fail"), 2: (0.0, "pass"), 3: (None, "fail")}
    s = spark.createDataFrame([("l", 0, 0.0), ("l", 1, 5.0), ("l", 2, 0.0), ("f", 0, 0.0), ("f", 1, 0.0), ("f", 2, 0.0)], "k string, t int, v double")
    assert {r["k"]: r["loops"] for r in compare.loop_seams(s, ["k"], "t", "v", 0.1).collect()} == {"l": True, "f": False}


def test_links(spark):
    want = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, t string")
    have = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4")], "k string, t string")
    assert {r["k"]: r["state"] for r in keys.link_states(want, have, "k", "t").collect()} == {"a": "keep", "b": "changed", "c": "new", "d": "stale"}
