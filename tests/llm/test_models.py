import collections
import math
import re
import zlib

import numpy as np
import pytest

from probata.llm import langid, mixlm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_languages_of_held_out_documents(spark, documents):
    extra = [(90_000, None, "en"), (90_001, "", "en"), (90_002, "12 %% 34\n", "de"), (90_003, "x", None), (None, "the and of the on", "en"), (90_004, "日本語の文章", None)]
    df = documents.select("doc_id", "text", "lang").union(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    # Columns that share names with the operator's own.
    out = langid.held_out_identified(df.withColumn("score", langid.F.lit("k")).withColumn("held_out", langid.F.lit(3)))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == df.count()
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in truth)
    assert np.mean([rows[i]["lang_pred"] == truth[i] for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert [rows[i]["lang_pred"] for i in (90_000, 90_001, 90_002)] == ["und"] * 3
    assert rows[90_003]["lang_pred"] != "und" and rows[90_004]["lang_pred"] in set(truth.values())


def test_mixture_of_two_languages():
    r = np.random.default_rng(0)
    a, b = (["".join(r.choice(list(x), 5)) for _ in range(200)] for x in ("abcdefg", "nopqrst"))
    train = [" ".join(r.choice(a, 300)), " ".join(r.choice(b, 300))]
    size = 1 << langid.BUCKET_BITS
    counts = []
    for t in train:
        g, _ = langid.grams(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))
        counts.append(np.bincount(g, minlength=size))
    logp = np.log((np.array(counts) + 0.5) / (np.sum(counts, axis=1, keepdims=True) + 0.5 * size))
    texts = [" ".join(r.choice(a, 40)), " ".join([*r.choice(a, 30), *r.choice(b, 10)]), " ".join(r.choice(b, 3)), ""]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    share = langid.mixtures(buf, np.concatenate([[0], np.cumsum([len(t) for t in texts])]), logp)
    assert share[0].tolist() == [1, 0] and share[2].tolist() == [0, 1] and share[3].tolist() == [0, 0]
    assert 0.65 < share[1, 0] < 0.85 and abs(share[1].sum() - 1) < 1e-9


def test_pieces_of_a_text_count_as_a_whole(monkeypatch):
    r = np.random.default_rng(3)
    buf, offs = r.integers(97, 103, 3000).astype(np.uint8), np.array([0, 0, 700, 701, 2990, 3000])
    whole = langid.counted(buf, offs)
    for size in (1, 7, 500, 2990):
        monkeypatch.setattr(langid, "PIECE_BYTES", size)
        assert all((a == b).all() for a, b in zip(whole, langid.counted(buf, offs), strict=True))


def test_languages_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.held_out_identified(empty).collect() == []
    one = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.held_out_identified(one).collect()] == ["und"]


def tokens(s):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or "")), "\0end"]


def test_scores(spark, documents):
    extra = [(90_000, None), (90_001, ""), (90_002, "The THE the x"), (None, "no id"), (90_003, "a" * 30_000), (90_002, "The THE the x")]
    df = documents.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = df.collect()
    out = mixlm.scored(df.withColumn("n", mixlm.F.lit("x")).withColumn("key", mixlm.F.lit(1))).collect()
    learns = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 != 0
    c = collections.Counter()
    for i, t in rows:
        if learns(i):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = []
    for i, t in rows:
        ts = tokens(t)
        want.append((i, i is not None and not learns(i), len(ts), sum(x in c for x in ts), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in ts), 4)))
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)
    held = [r for r in out if r["held_out"]]
    assert np.mean([r["bits_per_byte"] for r in held]) < 2.8


def counters_of(texts, learn):
    data = [t.encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    code, count = mixlm.batch_runs(buf, offs, np.array(learn))
    key, n = mixlm.summed(mixlm.of_order(code, 2), count)
    return mixlm.Counters(code, count, (key, n)), count, buf, offs


def some_mixer(seed=0):
    r = np.random.default_rng(seed)
    seen = r.integers(0, 40, 256 * (mixlm.MAP_STEPS + 1)).astype(float)
    return mixlm.Mixer(r.uniform(0, 0.5, (mixlm.GATES, len(mixlm.ORDERS) + 1)), np.stack([seen, np.floor(seen * r.random(len(seen)))]))


def plain_scores(texts, learn, mixer):
    """log10 of each text's probability, bit by bit from dictionaries of counts."""
    low = [bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode()) for t in texts]
    edge = b"\xff" * (mixlm.RUN - 1)
    bits_of = lambda b: [b >> k & 1 for k in range(7, -1, -1)]
    seen = collections.Counter()
    for t, l in zip(low, learn, strict=True):
        s = edge + t + b"\xff"
        for i in range(mixlm.RUN - 1, len(s)) if l else ():
            for k in mixlm.ORDERS:
                for j, b in enumerate(bits_of(s[i])):
                    seen[k, s[i - k : i], tuple(bits_of(s[i])[:j]), b] += 1
    out = []
    for t in low:
        s = edge + t + b"\xff"
        total, leads = 0.0, []
        for i in range(mixlm.RUN - 1, len(s)):
            by_sum = by_map = 0.0
            for j, b in enumerate(bits_of(s[i])):
                prefix, gate, x = tuple(bits_of(s[i])[:j]), 0, []
                for n, k in enumerate(mixlm.ORDERS):
                    one, zero = (seen[k, s[i - k : i], prefix, v] for v in (1, 0))
                    x.append(max(-8, min(8, math.log((one + 0.05) / (zero + 0.05)))))
                    if one + zero:
                        gate = 3 * n + (1 if one + zero < 3 else 2 if one + zero < 16 else 3)
                w = mixer.weights[gate]
                st = max(-12, min(12, sum(a * float(c) for a, c in zip([*x, 0.3], w, strict=True))))
                p = 1 / (1 + math.exp(-st))
                cell = ((1 << j) | s[i] >> (8 - j)) * (mixlm.MAP_STEPS + 1) + round((st / 12 + 1) * mixlm.MAP_STEPS / 2)
                n, ones = mixer.refine[:, cell]
                q = 0.5 * p + 0.5 * (ones + 8 * p) / (n + 8)
                by_sum += math.log10(p if b else 1 - p)
                by_map += math.log10(q if b else 1 - q)
            w = 1 / (1 + math.exp(-max(-30, min(30, sum(leads[-mixlm.RECENT :])))))
            total += math.log10((1 - w) * 10**by_sum + w * 10**by_map)
            leads.append((by_map - by_sum) * math.log(10))
        out.append(total)
    return out


def test_scores_equal_plain_ones(documents):
    texts = [r["text"][:300] for r in documents.filter("text is not null").select("text").limit(30).collect()] + ["", "Ünï \x00\x01 x", "aaa" * 50]
    learn = [i % 5 != 0 for i in range(len(texts))]
    counters, _, buf, offs = counters_of(texts, learn)
    mixer = some_mixer()
    step = np.rint(-mixer.log10(counters) * mixlm.STEPS)
    code, bounds = mixlm.runs_of(buf, offs)
    at = np.searchsorted(counters.code, code)
    got = mixlm.put_together(step[0, at] / -mixlm.STEPS, step[1, at] / -mixlm.STEPS, bounds)
    want = plain_scores(texts, learn, mixer)
    # Where a sum lies just between two steps of the map, the neighbouring cell may be taken.
    off = np.abs(got - np.array(want))
    assert (off < 0.03).mean() > 0.8 and off.max() < 1.5, off.tolist()


def test_whole_scores_equal_those_of_the_model(spark, documents, monkeypatch):
    """Blocks and buckets give what one table of all runs gives."""
    kept = []
    learnt = mixlm.trained
    monkeypatch.setattr(mixlm, "trained", lambda *a: kept.append(learnt(*a)) or kept[-1])
    monkeypatch.setattr(mixlm, "BLOCK_BYTES", 30_000)
    monkeypatch.setattr(mixlm, "BATCH_BYTES", 9_000)
    df = documents.select("doc_id", "text").repartition(3)
    got = {r["doc_id"]: r["score"] for r in mixlm.scored(df).collect()}
    rows = documents.select("doc_id", "text").collect()
    texts = [r["text"] or "" for r in rows]
    counters, _, buf, offs = counters_of(texts, [zlib.crc32(str(r["doc_id"]).encode()) % 10 != 0 for r in rows])
    step = np.rint(-kept[0].log10(counters) * mixlm.STEPS) / -mixlm.STEPS
    code, bounds = mixlm.runs_of(buf, offs)
    at = np.searchsorted(counters.code, code)
    want = mixlm.put_together(step[0, at], step[1, at], bounds)
    assert np.allclose([got[r["doc_id"]] for r in rows], want, rtol=1e-4, atol=2e-3)


def test_weights_and_map_are_learned_from_every_run(spark, monkeypatch):
    """More distinct runs than 2**21: the map has counted each bit of each text that teaches."""
    kept = []
    learnt = mixlm.trained
    monkeypatch.setattr(mixlm, "trained", lambda *a: kept.append(learnt(*a)) or kept[-1])
    texts = [bytes(x).decode() for x in np.random.default_rng(7).integers(0x30, 0x7B, (8, 300_000)).astype(np.uint8)]
    teach = [i for i in range(99) if zlib.crc32(str(i).encode()) % 10 != 0][:8]
    assert mixlm.scored(spark.createDataFrame(list(zip(teach, texts, strict=True)), "doc_id long, text string")).count() == 8
    assert kept[0].refine[0].sum() == 8 * 8 * 300_001


def test_probabilities_add_up():
    """The 256 next bytes of a context have a total probability of 1, by the sum, by the map, and mixed."""
    r = np.random.default_rng(0)
    context = int.from_bytes(b"gfedcba"[: mixlm.RUN - 1], "big")
    code = np.unique(np.concatenate([np.uint64(context << 8) + np.arange(256, dtype=np.uint64), r.integers(0x61 << 8 * (mixlm.RUN - 1), 0x69 << 8 * (mixlm.RUN - 1), 500).astype(np.uint64)]))
    count = r.integers(0, 5, len(code))
    key, n = mixlm.summed(mixlm.of_order(code, 2), count)
    step = some_mixer().log10(mixlm.Counters(code, count, (key, n)))
    mine = code >> np.uint64(8) == np.uint64(context)
    assert mine.sum() == 256 and np.allclose((10 ** step[:, mine]).sum(axis=1), 1, atol=1e-5)
    past = np.array([-1.0, -2.0])
    each = [10 ** (mixlm.put_together(np.append(past, a), np.append(past - 0.2, b), np.array([0, 3]))[0] - mixlm.put_together(past, past - 0.2, np.array([0, 2]))[0]) for a, b in step[:, mine].T]
    assert abs(sum(each) - 1) < 1e-5


def test_learning_helps(documents):
    texts = [r["text"] for r in documents.filter("text is not null").select("text").limit(60).collect()]
    counters, count, _, _ = counters_of(texts, [True] * len(texts))
    rows = np.arange(len(count))

    def loss(w):
        x, gate, _ = mixlm.Mixer.inputs(counters, rows, own=1)
        return (count * np.log1p(np.exp(-mixlm.Mixer().mixed(x, gate, w)))).sum()

    w, seen = mixlm.Mixer().learn(counters, count, rows)
    assert seen.sum() == count.sum() * 8
    assert loss(w) < loss(mixlm.Mixer().weights)


def test_scores_of_nothing(spark):
    assert mixlm.scored(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_mixture_of_a_text_does_not_depend_on_its_batch():
    import random

    import pyarrow as pa

    from probata.llm.common import text_buffers

    draw, r = np.random.default_rng(0), random.Random(0)
    logp = np.log(draw.dirichlet(np.full(1 << langid.BUCKET_BITS, 0.3), 4) + 1e-9)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(6, 60))) for _ in range(400)]
    mixtures = lambda some: langid.mixtures(*text_buffers(pa.array(some, pa.large_string())), logp)
    assert np.allclose(mixtures(texts), np.concatenate([mixtures([t]) for t in texts]), atol=1e-6)
