import math

import numpy as np
import pytest

from probata.llm import pieces, topk
from probata.llm.queries import piece_model


def best_rows(rows, k=10, every=100):
    """The k best rows of every query row, each pair looked at."""
    top = np.iinfo(np.int64)
    fine = [(i, [max(top.min, min(top.max, math.floor(1024 * float(x)))) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(fine):
        if q % every == 0:
            score = lambda y: max(top.min, min(top.max, sum(s * t for s, t in zip(x, y, strict=True))))  # noqa: E731,B023
            found = sorted((-score(y), i) for b, (i, y) in enumerate(fine) if a != b and len(y) == len(x))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(size=12)], i % 3, "k", i) for i in range(700)]
    rows += [(700, rows[0][1], 0, "k", 0), (701, rows[0][1], 0, "k", 0), rows[100], (800, None, 0, "k", 0), (801, [None] + rows[0][1][1:], 0, "k", 0)]
    rows += [(900, [math.nan] + rows[0][1][1:], 0, "k", 0), (1000, [math.inf] * 12, 0, "k", 0), (None, rows[3][1], 0, "k", 0), (1100, [1.0, 2.0], 0, "k", 0), (1200, [], 0, "k", 0), (1300, [], 0, "k", 0)]
    # Rows alike in id and vector, some as often as a result is long; one id with two vectors.
    rows += [rows[200]] * 3 + [rows[205]] * 12 + [(300, rows[7][1], 0, "k", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, key string, score int").repartition(3)
    for blocks in ({"stripe_rows": 128, "batch_queries": 3, "block_rows": 50}, {}):
        assert sorted(tuple(x) for x in topk.top_k(df, k=10, every=100, **blocks).collect()) == best_rows(rows)


def test_scores_beyond_floats(spark):
    """Products beyond 2**53 are told apart to the last digit, those beyond 64 bits count as the nearest number."""
    r = np.random.default_rng(6)
    big = [(i, [float(x) for x in r.integers(2**18, 2**18 + 4, 6) + i / 1024]) for i in range(300)]
    huge = [(1000 + i, [float(x) for x in r.choice([1e9, -1e9, 3e37, 1e30], 5)]) for i in range(200)]
    rows = big + huge
    got = [tuple(x) for x in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block_rows=64).collect()]
    assert sorted(got) == best_rows(rows)
    assert max(abs(s) for *_, s in got) == 2**63 - 1 and any(2**53 < abs(s) < 2**62 for *_, s in got)


def test_candidates_hold_the_best():
    r = np.random.default_rng(1)
    x = r.integers(-900, 900, (1500, 8)).astype(float)
    x[:200] *= 6
    q = r.integers(-900, 900, (20, 8)).astype(float)
    score = q @ x.T
    none = np.full(20, -1)
    for bar in (np.full(20, -np.inf), np.sort(score, axis=1)[:, -4]):
        pairs = topk.candidates(q, x, none, bar, 10)
        for i in range(20):
            mine = set(pairs[pairs[:, 0] == i, 1].tolist())
            best = [j for j in np.argsort(-score[i], kind="stable")[:10].tolist() if score[i, j] >= bar[i]]
            assert mine >= set(best) and len(mine) <= 40
    # Lists that tell rows apart early are not read to the end.
    steep = np.sort(r.integers(0, 10**6, (1500, 2)).astype(float), axis=0)
    assert len(topk.candidates(np.ones((1, 2)), steep, none[:1], np.array([-np.inf]), 10, depths=(1 / 16,))) < 100


def test_top_k_of_nothing(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


TEXTS = [
    "", " ", "a", " a  b ", "\n\na\tb\r\n", "ﬁ Ａ é é", "▁x ▁", "<s> </s> <unk> <0x41>", "\x00a", "　x\xa0y", "日本語 🤗", "a​b", "İ", "the " * 300, "a" * 9000,
    " " * 77 + "x" + " " * 33, "Queon### le%%% Oiç, don't re-enter http://x.y/z?q=1", "0123456789" * 20, "\U0010ffff", "ab" * 2500 + " " + "日" * 5000,
]


def test_pieces_equal_the_library(spark):
    import hashlib

    import sentencepiece

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(150).collect()
    rows = [(r["doc_id"], r["text"], "x") for r in docs] + [(10_000 + i, t, "y") for i, t in enumerate(TEXTS)] + [(None, "no id", "z"), (5, None, "z"), (5, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = pieces.encoded(df, piece_model(), keep_text=True, batch_bytes=5000).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = []
    for i, t, _ in rows:
        ids = sp.encode(t or "")
        back = sp.decode(ids)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), 0, back))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_parts_of_a_long_text(monkeypatch):
    v = pieces.vocabulary(piece_model())
    monkeypatch.setattr(pieces, "SEGMENTS", 7)
    for t in ("  the quick  brown fox, 日本 \U0010ffff and so on " * 9, "x " * 40, "a", "  "):
        parts = list(v.encoded(t))
        assert "".join(p[0] for p in parts) == ",".join(map(str, v.library.encode(t))) and "".join(p[1] for p in parts) == v.library.decode(v.library.encode(t))


def test_long_segments_take_the_heap():
    v = pieces.vocabulary(piece_model())
    s = "▁" + "thequickbrown" * 700
    assert v.agenda_of_one(s) == v.agenda([s])[0] == v.library.encode(s[1:])


def test_pieces_of_nothing(spark):
    assert pieces.encoded(spark.createDataFrame([], "doc_id long, text string"), piece_model()).collect() == []


def test_memory_of_segments_is_bounded(monkeypatch):
    v = pieces.Vocabulary(piece_model())
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    for i in range(5):
        texts = [f"word{i}x{j} again" for j in range(60)]
        assert [",".join(p[0] for p in v.encoded(t)) for t in texts] == [",".join(map(str, x)) for x in v.library.encode(texts)]
        assert len(v.strings) <= 50 + 120


def test_memory_of_long_segments_is_bounded(monkeypatch):
    v = pieces.Vocabulary(piece_model())
    monkeypatch.setattr(pieces, "REMEMBERED_CHARS", 20_000)
    for i in range(6):
        list(v.encoded(f"{i}" * 3000))
        assert v.chars <= 20_000 + 10_000 * 2


def test_the_library_decides(monkeypatch):
    v = pieces.Vocabulary(piece_model())
    monkeypatch.setattr(v, "agenda", lambda part: [[7] for _ in part])
    text = "two words"
    ids = v.library.encode(text)
    assert list(v.encoded(text)) == [(",".join(map(str, ids)), text, len(ids), 2)] and list(v.encoded("")) == []


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises((OSError, RuntimeError)):
        pieces.Vocabulary(str(tmp_path / "none.model"))
