"""Language identification by mixture inference.

Learning counts hashed byte n-grams of every labelled text, per language. A text is taken as a
mixture of languages: expectation-maximisation finds the proportions that make its n-grams most
likely. Nested sets of languages, by falling proportion, are then compared by likelihood less a
penalty for each language, and the proportions within the best set are the answer.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, gathered, in_batches, shuffle_partitions, text_buffers
from .textops import LOWER, mix

#: log2 of the n-gram buckets of a language: the model's size is fixed by this and the languages.
BUCKET_BITS = 16
#: Languages that the model may hold; more are an error, as the model goes to every executor.
MOST_LANGUAGES = 256
GRAM = 3
ROUNDS = 12
#: For each language of a set, this much times the logarithm of the number of n-grams.
PENALTY = 3.0
#: Added to every count.
SMOOTHING = 0.5
UNKNOWN = "und"
BATCH_BYTES = 1 << 19
#: Bytes of one or more texts whose grams are held at once.
PIECE_BYTES = 1 << 19

#: Upper case falls; every ASCII character that is no letter counts as a blank.
FOLD = LOWER.copy()
FOLD[[b for b in range(128) if not (0x61 <= FOLD[b] <= 0x7A)]] = 0x20


def remainder(doc_id: str = "doc_id", mod: int = 3) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod


def grams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of each run of GRAM bytes in a text, without those of blanks alone."""
    n = len(offs) - 1
    if len(buf) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b = FOLD[buf].astype(np.uint64)
    code = np.zeros(len(b) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        code = (code << np.uint64(8)) | b[k : len(b) - GRAM + 1 + k]
    text = np.repeat(np.arange(n), np.diff(offs))
    inside = (text[: len(code)] == text[GRAM - 1 :]) & (code != np.uint64(0x202020))
    code, text = code[inside], text[: len(code)][inside]
    return (mix(code) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), text


def counted(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text and bucket as one number, sorted and distinct; occurrences) of the grams; long texts are read a piece at a time."""
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, len(buf), PIECE_BYTES):
        b = min(len(buf), a + PIECE_BYTES + GRAM - 1)
        g, at = grams(buf[a:b], np.clip(offs, a, b) - a)
        key, n = np.unique((at << BUCKET_BITS) | g, return_counts=True)
        keys.append(key)
        counts.append(n)
    if len(keys) == 2:
        return keys[1], counts[1]
    key, n = np.concatenate(keys), np.concatenate(counts)
    o = np.argsort(key, kind="stable")
    key, n = key[o], n[o]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def learned(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages of labelled docs (text, lang), sorted, and the logarithm of each one's n-gram probabilities."""
    size = 1 << BUCKET_BITS

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for t in gathered(batches, BATCH_BYTES, "text"):
            buf, offs = text_buffers(t.column("text"))
            langs = t.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            key, n = counted(buf, offs)
            got = np.bincount(number[key >> BUCKET_BITS] * size + (key & (size - 1)), weights=n, minlength=size * len(names)).astype(np.int64).reshape(len(names), size)
            for name, row in zip(names, got, strict=True):
                total[name] = total.get(name, 0) + row
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), binaries([zlib.compress(v.astype("<i8").tobytes(), 1) for v in total.values()])], names=["lang", "counts"]
            )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size, np.int64)
        for x in pdf["counts"]:
            total += np.frombuffer(zlib.decompress(x), "<i8")
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "counts": [zlib.compress(total.tobytes(), 1)]})

    shape = "lang string, counts binary"
    rows = in_batches(docs.filter("text is not null and lang is not null").select("text", "lang"), count, shape)
    # The rows of a language are as many as tasks: added up in two steps.
    n = shuffle_partitions(docs.sparkSession)
    part = rows.withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(max(1, round(n**0.5)))))
    some = part.groupBy("lang", "part").applyInPandas(lambda p: add(p[["lang", "counts"]]), shape)
    found = some.groupBy("lang").applyInPandas(add, shape).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found.sort(key=lambda r: r["lang"])
    counts = np.array([np.frombuffer(zlib.decompress(bytes(r["counts"])), "<i8") for r in found], np.float64).reshape(len(found), size)
    p = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * size)
    return [r["lang"] for r in found], np.log(p)


def mixtures(buf: np.ndarray, offs: np.ndarray, logp: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY) -> np.ndarray:
    """Proportions (texts x languages); zero outside the chosen set; all zero where a text has no n-gram."""
    n, k = len(offs) - 1, len(logp)
    out = np.zeros((n, k))
    key, count = counted(buf, offs)
    if not len(key) or not k:
        return out
    count = count.astype(np.float64)
    g, at = key & ((1 << BUCKET_BITS) - 1), key >> BUCKET_BITS
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    texts = at[first]
    row = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(at))))
    total = np.add.reduceat(count, first)
    lp = logp[:, g]
    p = np.exp(lp - lp.max(axis=0))
    top = np.add.reduceat(lp.max(axis=0) * count, first)

    def steps(share: np.ndarray, times: int) -> np.ndarray:
        for _ in range(times):
            each = p * share[:, row]
            each *= count / each.sum(axis=0)
            share = np.add.reduceat(each, first, axis=1) / total
        return share

    def likelihood(share: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.log((p * share[:, row]).sum(axis=0)) * count, first) + top

    share = steps(np.full((k, len(texts)), 1 / k), rounds)
    rank = np.argsort(np.argsort(-share, axis=0, kind="stable"), axis=0)
    best, best_value = np.where(rank == 0, 1.0, 0.0), None
    best_value = np.add.reduceat(np.take_along_axis(lp, np.argmin(rank, axis=0)[row][None], axis=0)[0] * count, first) - penalty * np.log(total + 1)
    for m in range(2, k + 1):
        few = np.where(rank < m, np.maximum(share, 1e-9), 0)
        few = steps(few / few.sum(axis=0), 2)
        value = likelihood(few) - m * penalty * np.log(total + 1)
        better = value > best_value
        best[:, better], best_value[better] = few[:, better], value[better]
    out[texts] = best.T
    return out


def identified(docs: DataFrame, train: DataFrame) -> DataFrame:
    """docs (doc_id, text) with lang_pred and score from what train (text, lang) teaches.

    lang_pred is the language of the largest share (of equals the first by name), score that
    share. Where text is null or has no letter, or nothing was learned, they are 'und' and 0. Rows stay
    one to one; other columns pass through unread, but for any named lang_pred or score, which are replaced.
    """
    langs, logp = learned(train)
    model = docs.sparkSession.sparkContext.broadcast((langs, logp))
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    text = next(c for c in names if c.lower() == "text")
    flag = "_has"
    while flag in map(str.lower, names):
        flag += "_"
    kept = docs.select(*names)
    rows = kept.withColumn(flag, F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        langs, logp = model.value
        for t in gathered(batches, BATCH_BYTES, text):
            buf, offs = text_buffers(t.column(text).combine_chunks().fill_null(""))
            share = mixtures(buf, offs, logp)
            has = np.array(t.column(flag).to_pylist(), bool)
            if len(langs):
                best = np.argmax(share, axis=1)
                score = np.where(has, share[np.arange(len(best)), best], 0.0)
                # A text with letters but shorter than an n-gram says nothing: the first language, evenly.
                score = np.where(has & (score == 0), 1 / len(langs), score)
                pred = [langs[i] if h else UNKNOWN for i, h in zip(best, has, strict=True)]
            else:
                score, pred = np.zeros(len(has)), [UNKNOWN] * len(has)
            t = t.drop_columns([flag]).append_column("lang_pred", pa.array(pred, pa.string())).append_column("score", pa.array(np.clip(score, 0.0, 1.0)))
            yield from t.to_batches()

    return in_batches(rows, run, schema)


def held_out_identified(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; learns from the rows whose remainder is not held."""
    # crc32 of a null id is null: such a row teaches nothing and is not held out.
    train = docs.filter(remainder(mod=folds) != held).select("text", "lang")
    out = identified(docs.select("doc_id", "text"), train)
    return out.select("doc_id", F.coalesce(remainder(mod=folds) == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
