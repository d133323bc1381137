import corpus_pipeline as cp
from probata.llm.common import staged


def test_stages_in_order_with_their_decisions(spark, tmp_path):
    base = [f"word{i} and{i} then{i % 7} some{i} more{i} of{i} it{i} here{i % 3} now{i} done{i}" for i in range(40)]
    doc = lambda a, b: "\n".join(base[a:b])
    item = "what is the name of the third river that runs through the old town and ends in the lake"
    rows = [
        (0, doc(0, 8), "en"),
        (1, doc(0, 8) + "\n" + base[30], "en"),  # all lines but one are repeats
        (2, doc(8, 16), None),
        (3, "12345 !!!", "en"),  # no letter
        (4, None, "en"),
        (5, "fresh text with a leak\n" + item + " and on it goes", "en"),
        (6, "short", "en"),
        (7, doc(0, 8), "en"),  # loses every line
        (8, doc(16, 20).replace("\n", " "), "en"),
        (9, doc(16, 20).replace("\n", " ").replace("done19", "gone19 also here"), "en"),  # near duplicate in one line, two edits away
        (6, "short", "en"),
        (None, "no id here but words enough to be seen as a line of its own", "en"),
    ]
    df = spark.createDataFrame([(i, t, g, "s", len(t or ""), "k", 1.0) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, score double")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {}
    docs = df
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != cp.STAGES[-1][0]:
            assert out.columns == df.columns
            docs = staged(out)
            kept[name] = sorted((str(r["doc_id"]) for r in docs.collect()))
    assert kept["language_id"] == sorted(map(str, [0, 1, 2, 5, 6, 6, 7, 8, 9, None]))
    assert kept["line_dedup"] == sorted(map(str, [0, 1, 2, 5, 6, 6, 8, 9, None]))
    assert kept["near_duplicates"] == sorted(map(str, [0, 1, 2, 5, 6, 6, 8, None]))
    assert kept["decontamination"] == sorted(map(str, [0, 1, 2, 6, 6, 8, None]))
    assert {r["doc_id"]: r["text"] for r in docs.collect()}[1] == base[30]
    assert {r["doc_id"]: r["lang"] for r in docs.collect()}[2] == "en"
    assert {r["score"] for r in docs.collect()} == {1.0}
    assert out.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 7


def test_columns_that_share_names_with_the_stages(spark, tmp_path):
    names = ["shares", "_has", "Score", "LANG_PRED", "N_Lines", "n_removed", "kept_Score", "component_id", "edits", "item_id", "key", "row", "gone", "place"]
    rows = [(i, f"some words of text number{i} that are not said twice here{i}", "en", "s", 9, *[f"{c}{i}" for c in names]) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in names))
    spark.createDataFrame([(1, "an item that nothing holds in these few documents at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = df
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns, name
        assert sorted(tuple(r[c] for c in names) for r in docs.collect()) == sorted(r[5:] for r in rows), name
    assert cp.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 3


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_entry_has_all_queries():
    import __spark_entry__ as entry

    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= names
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stages_begin_with_a_collection(spark, tmp_path):
    def full():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if b.getName() in ("G1 Old Generation", "PS MarkSweep", "MarkSweepCompact"))

    df = spark.createDataFrame([(1, "some words of a text", "en", "s", 20)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, "an item that nothing holds")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    # The others also ask for a collection of the driver, which is the executor here.
    for name, stage in cp.STAGES:
        if name in ("language_id", "decontamination", "encoding"):
            before = full()
            stage(spark, df, str(tmp_path))
            assert full() > before, name
