import collections
import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from probata.llm import jaccard, linededup, suffixes


def removed_bytes(docs, width=50):
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - width + 1) if d is not None else ():
            first[b[i : i + width]] = min(first.get(b[i : i + width], d), d)
    out = []
    for d, t in docs:
        b = (t or "").encode()
        m = bytearray(len(b))
        for i in range(len(b) - width + 1) if d is not None else ():
            if first[b[i : i + width]] < d:
                m[i : i + width] = b"\1" * width
        kept = bytes(x for x, y in zip(b, m, strict=True) if not y)
        runs = sum(1 for i in range(len(m)) if m[i] and (i == 0 or not m[i - 1]))
        out.append((d, len(b), sum(m), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_order():
    r = np.random.default_rng(1)
    for t in range(30):
        lens = r.integers(1, 40, r.integers(1, 30))
        rows = np.zeros((len(lens), 48), np.uint8)
        for i, n in enumerate(lens):
            rows[i, :n] = r.integers(1, 3 if t % 2 else 6, n)
        order = suffixes.sorted_suffixes(rows, lens)
        found = [bytes(rows[p // 48, p % 48 : lens[p // 48]]) for p in order]
        assert len(found) == lens.sum() and found == sorted(found)


def test_repeated_strings_equal_brute_force(spark, monkeypatch):
    r = random.Random(3)
    words = ["alpha", "beta", "gam", "de", "zeta", "età", "theta", "io", "kappa"]
    some = [" ".join(r.choice(words) for _ in range(r.randint(3, 25))) for _ in range(12)]
    own = lambda: " ".join(r.choice(words) + str(r.randint(0, 99)) for _ in range(12))
    docs = [(i, " ".join(r.choice(some) if r.random() < 0.5 else own() for _ in range(r.randint(0, 12)))) for i in range(60)]
    docs += [(100, "ab" * 200), (101, "ab" * 100 + "c"), (102, "a" * 300), (103, "a" * 49), (104, ""), (105, docs[5][1]), (106, "a" * 60), (107, None), (None, docs[5][1]), (108, docs[7][1]), (108, docs[7][1]), (108, "x" + docs[8][1])]
    df = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, spans int, crc string").repartition(5)
    got = [tuple(x) for x in suffixes.deduplicated(df).collect()]
    assert sorted(got, key=str) == sorted(removed_bytes(docs), key=str)


def test_pieces_of_a_long_text(monkeypatch):
    r = np.random.default_rng(2)
    buf = r.integers(97, 100, 5000).astype(np.uint8)
    offs = np.array([0, 1200, 1230, 5000])
    whole = suffixes.occurrences(buf, offs)
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 700)
    cut = suffixes.occurrences(buf, offs)
    windows = lambda x: [(k, t, s + j) for k, t, s, n, _ in zip(*(a.tolist() for a in x), strict=True) for j in range(n)]
    assert sorted(windows(whole)) == sorted(windows(cut))


def test_only_what_two_documents_share_is_dealt(spark, monkeypatch):
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    shared = text(120)
    docs = [(i, text(700) + (shared if i in (3, 31) else "") + text(300)) for i in range(40)]
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 9_000)
    made, cut = [], suffixes.staged
    monkeypatch.setattr(suffixes, "staged", lambda df, *by: made.append(cut(df, *by)) or made[-1])
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    blocks = suffixes.text_blocks(df.withColumn("crc", suffixes.F.crc32("text"))).toPandas()
    rows = spark.createDataFrame(blocks)
    marks = suffixes.shared_keys(rows, 6).toPandas()
    got = set()
    for name, payload in zip(blocks["block"], blocks["payload"], strict=True):
        for x in suffixes.hot_fragments(bytes(payload), marks[marks["block"] == name], 6, suffixes.WINDOW):
            got |= {(int(d), int(a) + k) for d, a, n in zip(x[2], x[4], x[5], strict=True) for k in range(n - suffixes.WINDOW + 1)}
    # All windows within the shared string, and none that reaches out of it by more than half of what is beside a k-gram.
    room = suffixes.WINDOW - suffixes.GRAM - (suffixes.WINDOW - suffixes.GRAM) // 2
    assert got >= {(d, 700 + k) for d in (3, 31) for k in range(120 - suffixes.WINDOW + 1)}
    assert all(d in (3, 31) and 700 - room <= a <= 820 - suffixes.WINDOW + room for d, a in got)
    found = suffixes.repeats(df)
    assert [r["doc_id"] for r in found.collect()] == [31]
    # What was dealt goes as soon as the spans are there.
    assert [x for x in made if getattr(x, "cut_at", None) in suffixes_there()] == made[-1:]


def suffixes_there():
    from probata.operators import staging

    return staging._there


def test_suffix_dedup_of_nothing(spark):
    assert suffixes.deduplicated(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def shingle_set(s):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(docs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sets = [(i, shingle_set(s)) for i, s in docs]
    lists = collections.defaultdict(list)
    for k, (i, s) in enumerate(sets):
        if i is None:
            continue
        for j, m in collections.Counter(j for g in s for j in lists[g]).items():
            if 100 * m >= 80 * (len(s) + len(sets[j][1]) - m):
                a, b = find(i), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
        for g in s:
            lists[g].append(k)
    return [(i, len(s), find(i) if i is not None else None) for i, s in sets]


def test_components_equal_brute_force(spark):
    r = random.Random(5)
    letters = "abcdefgh"
    docs = []
    for i in range(400):
        words = [letters[(k * 7 + i % 5) % 8] + str((k * 3 + i % 6) % 9) for k in range(r.randint(0, 60) if i % 2 else r.randint(0, 24))]
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            if words:
                words[r.randrange(len(words))] = f"X{r.randint(0, 3)}"
        docs.append((i, r.choice([" ", "\n", "  "]).join(words)))
    docs += [(1000, None), (1001, ""), (1002, " \n"), (None, "a b c d e f g"), (1003, "A b c d e f g"), (1003, "zz yy xx ww vv uu"), (1004, "a b c"), (1005, "A B\tc")]
    df = spark.createDataFrame([(*d, 1, "n") for d in docs], "doc_id long, text string, n int, key string").repartition(4)
    got = [tuple(x) for x in jaccard.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted(components(docs), key=str)


def ranks(words):
    """Places of a text's shingles in the order of rarity while all are equally frequent, shingle by shingle."""
    runs = [" ".join(words[k : k + 5]).encode() for k in range(len(words) - 4)]
    h, _, _ = jaccard.sets_of(np.frombuffer(b"".join(runs), np.uint8), np.cumsum([0, *map(len, runs)]))
    return (h & np.uint64((1 << 59) - 1)).tolist()


def test_link_behind_a_leader(spark):
    """x and y link, but meet only in lists that z leads, and most of what they share lies beyond their prefixes."""
    r = random.Random(8)
    word = lambda: f"w{r.randrange(10**6)}"
    common = [word() for _ in range(88)]
    rank = ranks(common)
    order = np.argsort(rank)[:5]

    def longer(words, n, good):
        for _ in range(n):
            words = next(w for w in iter(lambda: [*words, word()], None) if good(ranks(w[-5:])[0]))
        return words

    rarer = lambda k: k < min(rank)
    x, y = longer(common, 1, rarer), longer(common, 16, rarer)
    top = rank[order[4]]
    z = [word()]
    for k in order:
        run = common[k : k + 5]
        z = next(w for w in iter(lambda: [*z, *(word() for _ in range(5)), *run], None) if all(v > top for v in ranks(w[len(z) - 4 if len(z) > 4 else 0 : -1])))
    z = longer(z, 91 - len(z), lambda k: k > top)
    docs = [(1, " ".join(y)), (2, " ".join(x)), (3, " ".join(z))]
    assert [(d, n, c) for d, n, c in components(docs)] == [(1, 100, 1), (2, 85, 1), (3, 87, 3)]
    got = [tuple(x) for x in jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(components(docs))


def test_bins_never_understate_an_overlap():
    r = np.random.default_rng(4)
    for size in (5, 90, 1000, 40_000):
        every = np.unique(r.integers(0, 1 << 63, 2 * size).astype(np.uint64))
        for few, share in ((0.5, 0.5), (0.2, 0.7), (0.9, 0.3), (0.97, 0.97)):
            a, b = (np.flatnonzero(r.random(len(every)) < f) for f in (few, share))
            x, y = (jaccard.binned(every[k])[None] for k in (a, b))
            both, bound = len(np.intersect1d(a, b)), jaccard.most_shared(np.array([len(a)]), x, np.array([len(b)]), y)[0]
            assert both <= bound <= min(len(a), len(b))
            if size >= 1000 and few == share == 0.5:
                assert bound < jaccard.needed(len(a), len(b))
    # One bin that is full: nothing is known.
    crowd = np.arange(300, dtype=np.uint64) << np.uint64(40)
    assert jaccard.most_shared(np.array([300]), jaccard.binned(crowd)[None], np.array([300]), jaccard.binned(np.arange(300, dtype=np.uint64))[None])[0] == 300


def test_long_lists_lose_no_link_and_make_few_pairs():
    r = np.random.default_rng(7)
    shared, sets = r.integers(0, 1 << 63, 60), []
    for k in range(60):
        base = np.concatenate([shared[: r.integers(1, 60)], r.integers(0, 1 << 63, int(r.integers(20, 400)))])
        sets += [np.unique(np.concatenate([base[r.random(len(base)) < 0.95], r.integers(0, 1 << 63, 3)])).astype(np.uint64) for _ in range(3)]
    root = [k // 6 if k % 4 else 1000 + k for k in range(len(sets))]
    members = [{"key": k, "n": len(s), "root": root[k], "chunk": k % 2, "payload": jaccard.binned(s).tobytes()} for k, s in enumerate(sets)]
    links = {(a, b) for a in range(len(sets)) for b in range(a) for m in [len(np.intersect1d(sets[a], sets[b]))] if 100 * m >= 80 * (len(sets[a]) + len(sets[b]) - m)}
    for one in (True, False):
        asked = {(min(a, b), max(a, b)) for a, b in links if root[a] != root[b] and (one or a % 2 != b % 2)}
        got = [tuple(x) for f in jaccard._across([pd.DataFrame({"one": [one], "members": [members]})]) for x in f.itertuples(index=False)]
        assert asked and asked <= set(got) and len(got) == len(set(got)) < 10 * len(links)
        assert all(root[a] != root[b] and (one or a % 2 != b % 2) for a, b in got)


def test_chance_matches_of_large_sets_are_allowed_for():
    r = np.random.default_rng(6)
    for n in (1000, 200_000, 600_000):
        h = np.sort(r.integers(0, 1 << 32, n))
        assert (h[1:] == h[:-1]).sum() <= jaccard.chance(n) <= 8 + n * n / 2**32 + 60


def test_boundary_follows_cost():
    assert jaccard.boundary({n: 100 for n in range(1, 17)}, scan=0.0) < jaccard.boundary({n: 100 for n in range(1, 17)}, scan=50.0)
    assert all(jaccard.needed(a, b) <= min(a, b) for a in range(1, 40) for b in jaccard.partners(a) if b >= 1 and 100 * min(a, b) >= 80 * max(a, b))


def test_components_of_nothing(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def allowed(v, w):
    """Whether the one edit between lines may be made."""
    if len(v) == len(w):
        return len(v) >= 10 or all(edits(x, y) <= 1 for x, y in zip(v, w, strict=True))
    few, more = sorted((v, w), key=len)
    return len(few) >= 10 or 4 * (len("".join(more)) - len("".join(few))) <= len("".join(more))


def lines_left(docs, near_words=linededup.NEAR_WORDS):
    split = lambda s: tuple(x for x in re.split("[ \t\r\x0b\x0c]+", s) if x)
    every = sorted({(d, k, split(s)) for d, t in docs if d is not None and t is not None for k, s in enumerate(t.split("\n")) if split(s)})
    gone = set()
    for x, (d, k, w) in enumerate(every):
        for e, m, v in every[:x]:
            near = min(len(v), len(w)) >= near_words and abs(len(v) - len(w)) <= 1 and edits(v, w) <= 1 and allowed(v, w)
            if (e, m) != (d, k) and (v == w or near):
                gone.add((d, k, w))
                break
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        left = [s for k, s in enumerate(lines) if d is None or (d, k, split(s)) not in gone]
        out.append((d, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("words", "near_words"), [(6, 3), (6, 1), (60, 1)])
def test_lines_equal_brute_force(spark, words, near_words):
    r = random.Random(2)
    word = lambda: f"w{r.randint(0, 5)}" if words < 10 else r.choice("ab") * r.randint(1, 9) + str(r.randint(0, 20))
    base = [[word() for _ in range(r.randint(1, 14))] for _ in range(25)]

    def changed(words):
        words = list(words)
        for _ in range(r.choice([0, 1, 1, 2])):
            i, how = r.randrange(len(words) + 1), r.random()
            if how < 0.33:
                words.insert(i, word())
            elif words and how < 0.5:
                words.pop(min(i, len(words) - 1))
            elif words:
                i = min(i, len(words) - 1)
                w = list(words[i])
                k = r.randrange(len(w))
                w[k : k + r.choice([0, 1, 1])] = r.choice(["", "x", "y"])
                words[i] = r.choice([word(), "".join(w) or "z", "".join(w) or "z"])
        return words

    docs = [(i, "\n".join(r.choice([" ", "  ", "\t"]).join(changed(r.choice(base))) for _ in range(r.randint(0, 6)))) for i in range(160)]
    docs += [(200, None), (201, ""), (None, docs[3][1]), (202, "\n\n"), (203, docs[3][1]), (203, docs[3][1]), (-4, docs[5][1])]
    df = spark.createDataFrame([(*d, "k", 7) for d in docs], "doc_id long, text string, place string, hash int").repartition(6)
    got = [tuple(x) for x in linededup.report(df, near_words).collect()]
    assert sorted(got, key=str) == sorted(lines_left(docs, near_words), key=str)


def test_short_lines_meet_by_any_earlier_line(spark):
    """The earliest line of a key is not the one that repeats."""
    text = ["Thank you John", "Thank you Mary", "Thank you Marys", "Thank you Marsh"]
    df = spark.createDataFrame([(1, "\n".join(text))], "doc_id long, text string")
    assert [r["text"].split("\n") for r in linededup.deduplicated(df).collect()] == [["Thank you John", "Thank you Mary", "Thank you Marsh"]]


def test_running_hashes_do_not_depend_on_runs(spark):
    df = spark.createDataFrame([([f"w{i % 7}" for i in range(n)],) for n in (1, 7, 8, 9, 16, 17, 40)], "words array<string>")
    for run in (8, 64):
        rows = sorted((r[0] for r in df.select(linededup.running_hashes(linededup.F.col("words"), run)).collect()), key=len)
        assert [len(r) for r in rows] == [2, 8, 9, 10, 17, 18, 41]
        assert all(rows[-1][: len(r)] == r and len(set(r)) == len(r) for r in rows)


def test_very_long_texts_and_lines(spark):
    """A document of 200,000 lines, many of them repeats, and one line of 40,000 words."""
    line = [f"w{i % 9973}v{i % 997}" for i in range(40_000)]
    lines = [f"line {i % 120_000} is one of many that stand in it here {i % 120_000}" for i in range(200_000)]
    rows = [(1, "\n".join(lines), "k"), (2, " ".join(line), "k"), (3, " ".join([*line[:30_000], "new", *line[30_001:]]) + "\nlast", "k")]
    got = {r["doc_id"]: r for r in linededup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, gone string")).collect()}
    assert got[1]["n_removed"] >= 80_000 and got[1]["text"] + "\n" == "".join(f"{x}\n" for x in got[1]["text"].split("\n"))
    assert got[2]["text"] == rows[1][1] and got[3]["text"] == "last"


def test_line_dedup_keeps_columns_and_runs_no_python(spark):
    df = spark.createDataFrame([(1, "one two three four five\nx", "a"), (2, "y\none two three four five", "b")], "doc_id long, text string, row string")
    out = linededup.deduplicated(df)
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, df.first()["text"], "a", 2, 0), (2, "y", "b", 2, 1)]
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def test_line_dedup_of_nothing(spark):
    assert linededup.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_short_lines_repeat(spark):
    text = ["Read more", "x", "All rights reserved today", "", "Thank you John", "one two three four five six", ""]
    again = ["Read more", "x", "All rights reserved todays", "", "Thank you Mary", "one two three four fives six", "Read on"]
    df = spark.createDataFrame([(1, "\n".join(text)), (2, "\n".join(again))], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split("\n") for r in linededup.deduplicated(df).collect()}
    assert got == {1: text, 2: ["", "Thank you Mary", "Read on"]}
