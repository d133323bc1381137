"""What SQL does not show of the operators on documents, reports and their sources."""

import pytest

from probata.functions import paths
from probata.operators import documents, keys, semantics
from probata.plans import evidence
from probata.sources import files


def test_summary(spark):
    of = lambda *v: documents.summary(spark.createDataFrame([(x,) for x in v], "verdict string"))
    assert of("pass", "pass") == ('{"checked": 2, "failed": 0, "verdict": "pass"}', 0)
    assert of("pass", "fail", None)[1] == 2 and of()[1] == 3


def test_walks_in_order(spark):
    text = '{"b": ["https://1", {"x": "https://2"}], "a": "https://3", "c": "http://4", "https://k": 5}'
    df = spark.createDataFrame([(1, text), (2, None), (3, "no json"), (4, '["https://5"]')], "k long, t string")
    got = [(r["k"], r["number"], r["location"], r["url"]) for r in documents.https_strings(df, "k", "t").collect()]
    assert sorted(got) == [(1, 0, "$.b[0]", "https://1"), (1, 1, "$.b[1].x", "https://2"), (1, 2, "$.a", "https://3"), (4, 0, "$[0]", "https://5")]


def test_scope_of_a_circle(spark):
    o = spark.createDataFrame([("a", "c"), ("b", "a"), ("c", "b"), ("d", None), ("e", "d")], "name string, parent string")
    names = lambda *r: sorted(x["name"] for x in semantics.in_scope(o, spark.createDataFrame([(n,) for n in r], "name string")).collect())
    assert names("b") == ["a", "b", "c"] and names("d", "x") == ["d", "e"]


def test_names_collide_by_folded_case(spark):
    df = spark.createDataFrame([("a/straße.PNG",), ("A/STRASSE.png.",), ("a/é",), ("A/É",), ("a/strase.png",)], "p string")
    got = [r[0] for r in df.select(paths.collision_identity(df.p)).collect()]
    assert got[0] == got[1] and got[2] == got[3] and len(set(got)) == 3


def test_times_without_offset_are_none(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05+01:30",), ("2024-01-02T03:04:05",), ("2024-13-02T03:04:05Z",), ("today",), (None,)], "t string")
    got = [r[0] for r in df.select(documents.offset_time(df.t).cast("long")).collect()]
    assert got == [1704164645, 1704159245, None, None, None, None]


def test_reproducible_view_of_nested_source(spark):
    df = spark.createDataFrame([(1, "r", ("a", "now"))], "k long, run_id string, source struct<path string, started_at string>")
    assert semantics.reproducible(df).schema.simpleString() == "struct<k:bigint,source:struct<path:string>>"


def test_links_with_null_targets(spark):
    d = spark.createDataFrame([("a", None), ("b", "x"), ("c", "x")], "k string, t string")
    r = spark.createDataFrame([("a", None), ("b", None), ("d", "x")], "k string, t string")
    assert {x["k"]: x["state"] for x in keys.link_states(d, r, "k", "t").collect()} == {"a": "keep", "b": "changed", "c": "new", "d": "stale"}


def test_paths_of_references(spark):
    df = spark.createDataFrame([("a//b/./c",), ("a\\b\\c",), ("./a/b/c",)], "p string")
    assert {r[0] for r in df.select(evidence.normal(df.p)).collect()} == {"a/b/c"}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a: 1\nb: [x, {c: null}]\n1.5: yes", {"a": 1, "b": ["x", {"c": None}], 1.5: True}),
        ("- a\n- ''\n- 0x1F", ["a", "", 31]),
        ("a: 1\na: 2", None), ("a: &x 1", None), ("a: &x 1\nb: *x", None), ("a: !!str 1", None), ("<<: {a: 1}", None), ("a: 1\n---\nb: 2", None), ("? [a]\n: 1", None), ("", None), ("a: [", None),
    ],
)
def test_yaml_values(text, want):
    pytest.importorskip("yaml")
    try:
        got = files._yaml_value(text)
    except Exception:
        got = None
    assert got == want
