import hashlib
import html
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from probata.llm import decontaminate, htmltext, warc
from probata.llm.common import text_buffers

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return htmltext.trained()


def article(page):
    a = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    a = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"<(/?)(p|h1)>", "\0", a)))
    return "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in a.split("\0")) if x)


def test_articles_of_pages(spark, model):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    rows = pages.collect()
    extra = [(90_000, None, None), (90_001, "u", ""), (90_002, "u", "plain &amp; simple"), (None, "u", rows[0]["html"]), (rows[0]["page_id"], rows[0]["url"], rows[0]["html"])]
    df = pages.union(spark.createDataFrame(extra, pages.schema)).withColumn("text", htmltext.F.lit(1))
    got = htmltext.extracted(df, model, batch_bytes=50_000).collect()
    want = [(r[0], r[1], article(r[2])) for r in rows] + [(90_000, None, ""), (90_001, "u", ""), (90_002, "u", "plain & simple"), (None, "u", article(rows[0]["html"])), (rows[0][0], rows[0][1], article(rows[0][2]))]
    assert sorted((str((r["page_id"], r["url"], r["text"], r["n_chars"])) for r in got)) == sorted(str((*w, len(w[2]))) for w in want)


def test_composed_pages_held_out(model):
    r = random.Random(99)
    scores = []
    for _ in range(120):
        page = htmltext.composed(r)
        nodes, parent, _ = htmltext.listed(htmltext.parsed(page))
        label = htmltext.labels(nodes, parent)
        want = Counter(htmltext.main_text(nodes, label == 1).split())
        got = Counter(htmltext.texts_of(model, [re.sub(" data-role=zz[a-z]+", "", page)])[0].split())
        scores.append(2 * sum((want & got).values()) / max(1, sum(want.values()) + sum(got.values())))
    assert np.mean(scores) > 0.97


S = [f"Sentence number {w} of the story is long enough to be read as a part of the whole, and has {w} commas." for w in "one two three four five six".split()]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # Loose text beside blocks, with an advert amid it.
        (f'<body><nav><a href=1>Home</a> <a href=2>News</a></nav><article>{S[0]} {S[1]}<div class="ad banner">Buy now cheap shoes</div>{S[2]} {S[3]}<p>{S[4]}</p>{S[5]}</article><footer>Legal notes</footer></body>', [f"{S[0]} {S[1]}", f"{S[2]} {S[3]}", S[4], S[5]]),
        # An advert within a paragraph.
        (f"<body><article><h1>Title here</h1><p>{S[0]} <a class=ad href=x>Buy cheap shoes now</a> {S[1]}</p><p>{S[2]}</p></article></body>", ["Title here", f"{S[0]} {S[1]}", S[2]]),
        # A link within a paragraph stays.
        (f"<body><article><h1>Title here</h1><p>{S[0]} <a href=x>as told before</a> {S[1]}</p><p>{S[2]}</p></article></body>", ["Title here", f"{S[0]} as told before {S[1]}", S[2]]),
        # An apostrophe in a value without quotes.
        (f"<body><article><p title=it's>{S[0]}</p><p>{S[1]} It's so.</p></article></body>", [S[0], f"{S[1]} It's so."]),
        # A name in a language that the lists of words do not know.
        (f"<body><article><p>{S[0]}</p><div class=werbung>Jetzt billig kaufen</div><p>{S[1]}</p><p>{S[2]}</p></article></body>", [S[0], S[1], S[2]]),
        (f"<body><div class=inhalt><p>{S[0]} 3 < 4 &amp; 5 > 2 <!-- no > --> {S[1]}</p></div></body>", [f"{S[0]} 3 < 4 & 5 > 2 {S[1]}"]),
    ],
)
def test_pages_made_by_hand(model, page, want):
    assert htmltext.texts_of(model, [page])[0].split("\n\n") == want


@pytest.mark.parametrize("part", ['<a b="', "<svg>", "<i><b>", "<!--", "<a ", "<", "</", "<b><div><i></b>", "<ul><li><div>", "<td><p>", "<a b='\" ", "<title>", "<p <p ", "a<!x"])
def test_broken_markup_takes_time_in_proportion(part):
    began = time.process_time()
    htmltext.listed(htmltext.parsed(part * (1_000_000 // len(part))))
    assert time.process_time() - began < 8


def test_decoding_is_consistent_and_best():
    r = np.random.default_rng(0)
    for _ in range(200):
        n = int(r.integers(1, 8))
        children = [[] for _ in range(n)]
        for k in range(1, n):
            children[int(r.integers(0, k))].append(k)
        odds = r.normal(size=n)
        kept = htmltext.decoded(odds, children)

        def choices(k):
            """(total, kept set) of every consistent choice below k."""
            below = [k]
            for i in below:
                below.extend(children[i])
            yield sum(odds[i] for i in below), frozenset(below)
            yield -sum(odds[i] for i in below), frozenset()
            if children[k]:
                every = [(-htmltext.SPLIT_COST, frozenset())]
                for c in children[k]:
                    every = [(a + x, s | t) for a, s in every for x, t in choices(c)]
                yield from every

        assert frozenset(np.flatnonzero(kept)) == max(choices(0))[1]


def test_broken_markup():
    m = htmltext.trained(60)
    for page in ("<", "<p", "</p></div>", "<!-- open", "<script>never closed", "<div " * 50, "<p>" * 3000, "<b><i></b></i>x", "<a href='>'>q</a>", "&#0;&#xD800;&bogus;", "<table><tr><td>a<tr><td>b", "\x00<p>\x01"):
        assert isinstance(htmltext.texts_of(m, [page])[0], str)


def test_fixity_locates_damage(spark):
    rows = [(i, f"http://h/{i % 7}", f"<p>{'x' * (i % 50)} é {i}</p>") for i in range(900)] + [(None, None, None), (3, "http://h/3", None), (5, "http://h/5", "<p>"), (5, "http://h/5", "<p>")]
    archive = warc.archived(spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, file string"), file_records=100)
    assert archive.count() == len(rows)
    copies = archive.withColumns({"a": warc.F.col("record"), "b": warc.F.when(warc.F.col("page_id").isin(17, 400), warc.F.concat("record", warc.F.lit("!"))).when(~warc.F.col("page_id").eqNullSafe(523), warc.F.col("record"))})
    found = warc.audit(copies, "a", "b", fanout=4).collect()
    assert sorted(r["page_id"] for r in found) == [17, 400, 523]
    assert [r["b"] for r in found if r["page_id"] == 523] == [None]
    # Ranges are where the records stand in their files.
    bytes_of = {}
    for r in archive.collect():
        bytes_of.setdefault(r["file"], []).append((r["page_id"] is not None, r["page_id"], r["url"], hashlib.sha256(r["record"].encode()).hexdigest(), r["record"].encode()))
    for r in found:
        whole = b"".join(x[-1] for x in sorted(bytes_of[r["file"]], key=lambda x: x[:4] if x[0] else (False, 0, x[2], x[3])))
        assert hashlib.sha256(whole[r["offset"] : r["offset"] + r["length"]]).hexdigest() == r["a"]
    assert warc.audit(copies, "a", "a").collect() == []


def test_fixity_of_nothing(spark):
    assert warc.fixity(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_leaks_are_found_and_others_left(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300).collect()]
    r = random.Random(1)

    def changed(text, rate):
        w = text.split()
        for _ in range(int(rate * len(w))):
            i, how = r.randrange(len(w)), r.random()
            if how < 0.33:
                w[i] = f"zq{r.randint(0, 9)}"
            elif how < 0.66:
                w.insert(i, f"zq{r.randint(0, 9)}")
            elif len(w) > 2:
                w.pop(i)
        return " ".join(w)

    plain = lambda t: " ".join(re.sub(r"[^\w\s]|_", "", t.lower()).split())
    rows, planted = list(docs), set()
    for n, rate in enumerate((0, 0.05, 0.1, 0.2)):
        for k, (item, text) in enumerate(items):
            i = 100_000 + 1000 * n + k
            rows.append((i, f"{docs[k][1][:400]}\n{changed(text, rate).upper() if k % 3 == 0 else changed(text, rate)}\n{docs[k + 50][1][:300]}"))
            planted.add((i, item, rate))
    rows += [(200_000, None), (200_001, ""), (200_002, " "), (200_003, items[0][1]), (200_003, items[0][1]), (None, items[1][1])]
    df = spark.createDataFrame([(*x, 1, "k") for x in rows], "doc_id long, text string, edits int, item_id string").repartition(5)
    bench = spark.createDataFrame([*items, (900, None), (901, ""), (902, "!!")], "item_id long, text string")
    found = decontaminate.leaks(df, bench).collect()
    got = {(x["doc_id"], x["item_id"]) for x in found}
    assert len(got) == len(found)
    for rate, least in ((0, 1.0), (0.05, 0.97), (0.1, 0.95), (0.2, 0.85)):
        want = {(i, k) for i, k, x in planted if x == rate}
        assert len(want & got) >= least * len(want), rate
    assert {(200_003, items[0][0]), (None, items[1][0])} <= got
    # What is found is near indeed, by a plain table of edits.
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t or "")
    for x in found[::7]:
        item = plain(dict(items)[x["item_id"]]).split()
        best = min(_edits(item, plain(t).split()) for t in texts[x["doc_id"]])
        assert best == x["edits"] <= len(item) * decontaminate.PERCENT_EDITS // 100
    left = decontaminate.decontaminated(df, bench)
    assert left.columns == df.columns
    assert sorted((str(x["doc_id"]) for x in left.collect())) == sorted(str(i) for i, _ in rows if i not in {a for a, _ in got})


def _edits(item, doc):
    row = [0] * (len(doc) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(doc, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_leaks_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert decontaminate.leaks(docs, bench).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontaminate.leaks(some, bench.limit(0)).collect() == []
    assert decontaminate.decontaminated(some, bench.limit(0)).count() == 1


def test_words_without_marks():
    buf, offs = text_buffers(pa.array(["The, ÉTÉ! the", "--- ?", "x-y xy"]))
    word, text = decontaminate.plain_words(buf, offs)
    a, _ = decontaminate.plain_words(*text_buffers(pa.array(["the été the"])))
    assert text.tolist() == [0, 0, 0, 2, 2] and word[:3].tolist() == a.tolist() and word[3] == word[4]


def test_recall_does_not_fall_with_length():
    r = random.Random(3)
    word = lambda: f"w{r.randrange(3000)}"
    for n in (40, 60, 100, 200, 500):
        items = [[word() for _ in range(n)] for _ in range(40)]
        docs = []
        for item in items:
            w = list(item)
            for _ in range(n // 5):
                i, how = r.randrange(len(w)), r.random()
                w[i : i + (how < 0.33 or how >= 0.66)] = [f"zq{r.randint(0, 9)}"] if how < 0.66 else []
            docs.append(" ".join([*(word() for _ in range(30)), *w, *(word() for _ in range(30))]))
        index = decontaminate.Index(list(range(40)), [" ".join(w) for w in items])
        own, item, edits, _ = decontaminate.leaks_in(index, *text_buffers(pa.array(docs, pa.large_string())))
        assert (own == item).sum() >= 0.93 * 40 and (edits <= n // 5).all()


def test_edits_within_the_allowed_ones_are_exact_and_others_leave_early():
    r = np.random.default_rng(11)
    sizes = [*range(1, 40), 64, 65, 130, 300]
    items = [[f"w{r.integers(60)}" for _ in range(n)] for n in sizes]
    docs = []
    for i, w in enumerate(items):
        w = list(w)
        for _ in range(r.integers(0, len(w) * 30 // 100 + 2)):
            at, kind = int(r.integers(len(w) + 1)), r.integers(3)
            w[at : at + (kind > 0)] = [f"w{r.integers(60)}"] if kind < 2 else []
        docs.append([f"w{r.integers(60)}" for _ in range(i % 7)] + w + ["z"] * (i % 3))
    index = decontaminate.Index(list(range(len(items))), [" ".join(w) for w in items])
    word, text = decontaminate.plain_words(*text_buffers(pa.array([" ".join(w) for w in docs], pa.large_string())))
    w, begin = decontaminate.marked(word, text, len(docs))
    own = np.arange(len(docs))
    place = begin[:-1] + own % 7
    good, edits = index.verified(w, begin[:-1], begin[1:] - 1, place, own)
    for i, (item, doc) in enumerate(zip(items, docs, strict=True)):
        allowed = len(item) * decontaminate.PERCENT_EDITS // 100
        a = max(0, i % 7 - 2 * allowed)
        row = [0] * (len(doc[a : i % 7 + len(item) + 2 * allowed]) + 1)
        for x in item:
            new = [row[0] + 1]
            for j, y in enumerate(doc[a : i % 7 + len(item) + 2 * allowed]):
                new.append(min(row[j + 1] + 1, row[j] + (x != y), new[j] + 1))
            row = new
        assert good[i] == (min(row) <= allowed) and (not good[i] or edits[i] == min(row)), i
    assert 5 < good.sum() < len(good)

    def seconds(item, place):
        took = []
        for _ in range(3):
            t = time.perf_counter()
            index.verified(w, np.zeros(len(item), np.int64), np.full(len(item), len(w)), place, item)
            took.append(time.perf_counter() - t)
        return min(took)

    n, one = 4000, sizes.index(64)
    item = np.full(n, one)
    w = np.concatenate([index.words[one], np.arange(1, 5000, dtype=np.uint64)])
    assert seconds(item, np.full(n, 200)) < 0.6 * seconds(item, np.zeros(n, np.int64))
