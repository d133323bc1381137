"""Language-model scoring by logistic context mixing.

A text is predicted bit by bit. For each context order, counters tell how often the
next bit was 0 or 1 after the same bytes; the stretched predictions are added up with weights that a
gate picks, by the highest order that has seen its context and how often; a map, indexed by
the bits of the byte so far, refines the sum. While a text is read, a second gate turns to whichever of the two, the sum or its
refinement, has done better on the last bytes. All that the first steps depend on is a byte with
its last ORDERS[-1] bytes, a run; so they work on distinct runs, each of them once: 1. blocks of documents send their distinct runs,
with the occurrences in training texts, to buckets by a hash of the nearest HOME bytes; 2. a bucket has every run of its contexts, so
its counters are exact, as many as there are contexts, and need no table that collides; orders below HOME come from one table of all
contexts of two bytes; 3. each bucket learns weights online over all its runs, each predicted without its own
occurrence, and counts the map; weights are averaged and counts added up; 4. all buckets send the two predictions of each run back to the blocks, which put
the texts together. Word counts for the base score travel the same way.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, bucket_bits, gathered, in_batches, released, shuffle_partitions, staged, text_buffers
from .langid import remainder
from .suffixes import _bucket_rows, _packed, _unpacked
from .textops import LOWER, U64, from_planes, mix, planes, run_hash, words

#: Context lengths in bytes; runs are dealt by the nearest HOME bytes.
ORDERS = (1, 2, 3, 4, 6)
HOME = 3
RUN = ORDERS[-1] + 1
#: What stands before a text and ends it: a byte that no UTF-8 text has.
EDGE = 0xFF
BATCH_BYTES = 1 << 20
BLOCK_BYTES = 16 << 20
#: Batches of a block whose words and runs are held apart.
MERGED = 4
#: Text for which there is one bucket at least.
BUCKET_BYTES = 512 << 20
#: Runs of a step of learning, and how far it goes.
LEARN_BATCH, RATE = 2048, 0.02
#: Runs that are predicted together.
TOGETHER = 1 << 14
GATES = 3 * len(ORDERS) + 1
MAP_STEPS = 32
LIMIT = 8.0
#: Bytes of a text that the last gate looks back on, and steps of a prediction's logarithm on its way back.
RECENT, STEPS = 64, 1024
#: A word not seen counts as this much.
ADDED = 0.1


def runs_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, offsets by text): for each byte and the end of each text, the byte with those before it, the nearest in the highest place."""
    n = len(offs) - 1
    gap = RUN  # RUN - 1 edges before each text and one for its end
    out = np.full(len(buf) + gap * n + RUN, EDGE, np.uint8)
    text = np.repeat(np.arange(n), np.diff(offs))
    out[np.arange(len(buf)) + text * gap + (RUN - 1)] = LOWER[buf]
    m = len(buf) + gap * n
    code = out[RUN - 1 : RUN - 1 + m].astype(U64)
    for k in range(1, RUN):
        code |= out[RUN - 1 - k : RUN - 1 - k + m].astype(U64) << U64(8 * (RUN - k))
    size = np.diff(offs) + 1
    begin = offs[:-1] + np.arange(n) * gap
    bounds = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(begin - bounds[:-1], size) + np.arange(bounds[-1])
    return code[at], bounds


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Whether each of the sorted keys is the first of its like."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return new


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, sorted; the sums of their counts)."""
    o = np.argsort(keys)
    keys = keys[o]
    first = np.flatnonzero(_firsts(keys))
    return keys[first], np.add.reduceat(counts[o], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)


def distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[_firsts(keys)]


def placed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, sorted; for each key its place among them)."""
    o = np.argsort(keys)
    new = _firsts(keys[o])
    place = np.empty(len(o), np.int32)
    place[o] = np.cumsum(new, dtype=np.int32) - 1
    return keys[o[new]], place


def of_order(code: np.ndarray, k: int) -> np.ndarray:
    """The context of k bytes with the byte after it."""
    return code if k == RUN - 1 else (code >> U64(8 * (RUN - k)) << U64(8)) | (code & U64(255))


def path_counts(key: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(9 x keys) how often each key's context was followed by a byte that agrees with the key's in its first 0 to 8 bits. key is sorted and distinct."""
    out = np.empty((9, len(key)), np.float32)
    for j in range(8, -1, -1):
        prefix = key >> U64(8 - j)
        first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])) if len(key) else np.zeros(0, np.int64)
        out[j] = np.repeat(np.add.reduceat(count, first), np.diff(np.append(first, len(key)))) if len(key) else 0
    return out


class Counters:
    """For distinct sorted runs with their occurrences: the counts along the path of bits of each, by order."""

    def __init__(self, code: np.ndarray, count: np.ndarray, low: tuple[np.ndarray, np.ndarray]):
        self.code, self.orders = code, []
        for k in ORDERS:
            if k < HOME:
                # From the table of all texts: contexts of one byte are sums over those of two.
                key, n = summed(of_order(low[0] << U64(8 * (RUN - 3)) | (low[0] & U64(255)), k), low[1])
                place = np.minimum(np.searchsorted(key, of_order(code, k)), max(0, len(key) - 1))
            else:
                key, place = placed(of_order(code, k))
                n = np.bincount(place, weights=count, minlength=len(key))
            self.orders.append((path_counts(key, n), place.astype(np.int32)))

    def paths(self, k: int, rows) -> np.ndarray:
        table, place = self.orders[k]
        return table[:, place[rows]]


def trust(total: np.ndarray) -> np.ndarray:
    """How often a context was seen, in steps: 0 for never."""
    return (total >= 0.5).astype(np.int8) + (total >= 3) + (total >= 16)


class Mixer:
    """Weights by gate, and the map; predicts the bits of runs from their counters."""

    def __init__(self, weights: np.ndarray | None = None, refine: np.ndarray | None = None):
        w = np.zeros((GATES, len(ORDERS) + 1), np.float32)
        w[:, :-1] = 0.3
        self.weights = w if weights is None else weights.astype(np.float32)
        self.refine = np.zeros((2, 256 * (MAP_STEPS + 1))) if refine is None else refine

    @staticmethod
    def inputs(counters: Counters, rows, own: int = 0):
        """(stretched predictions of the bit that came, with a constant; gate; bit), over bits and runs; own: occurrences of the run itself that are left out."""
        last = (counters.code[rows] & U64(255)).astype(np.int16)
        bit = (last >> np.arange(7, -1, -1, dtype=np.int16)[:, None]) & 1
        x = np.empty((len(ORDERS) + 1, *bit.shape), np.float32)
        gate = np.zeros(bit.shape, np.int8)
        for i in range(len(ORDERS)):
            path = np.maximum(counters.paths(i, rows) - own, 0) if own else counters.paths(i, rows)
            came, whole = path[1:], path[:-1]
            np.log((came + 0.05) / (whole - came + 0.05), out=x[i])
            seen = trust(whole)
            gate = np.where(seen > 0, 3 * i + seen, gate)
        np.clip(x[:-1], -LIMIT, LIMIT, out=x[:-1])
        x[-1] = np.where(bit == 1, 0.3, -0.3)
        return x, gate, bit

    def mixed(self, x: np.ndarray, gate: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """The sum of the inputs, with the weights that the gate picks."""
        w = self.weights if weights is None else weights
        out = x[0] * w[:, 0][gate]
        for j in range(1, len(x)):
            out += x[j] * w[:, j][gate]
        return np.clip(out, -LIMIT * 1.5, LIMIT * 1.5)

    def learn(self, counters: Counters, count: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights after online steps over the runs at rows, and how many bits each gate's weights saw."""
        w, seen = self.weights.copy(), np.zeros(GATES)
        square = np.full_like(w, 1e-6)
        for i in range(0, len(rows), LEARN_BATCH):
            part = rows[i : i + LEARN_BATCH]
            x, gate, _ = self.inputs(counters, part, own=1)
            error = count[part] / (1 + np.exp(self.mixed(x, gate, w)))
            g = gate.ravel()
            weight = np.bincount(g, weights=np.broadcast_to(count[part], gate.shape).ravel(), minlength=GATES)
            seen += weight
            grad = np.stack([np.bincount(g, weights=(error * v).ravel(), minlength=GATES) for v in x], axis=1) / np.maximum(weight, 1)[:, None]
            square = 0.95 * square + 0.05 * grad * grad
            w += (RATE * grad / np.sqrt(square + 1e-8) * (weight > 0)[:, None]).astype(np.float32)
        return w, seen

    @staticmethod
    def cells(code: np.ndarray, s: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """The map's cell of each bit: bits of the byte so far, and the sum in steps."""
        last = (code & U64(255)).astype(np.int64)
        node = (1 << np.arange(8))[:, None] | (last >> np.arange(8, 0, -1)[:, None])
        step = np.rint((np.where(bit == 1, s, -s) / (LIMIT * 1.5) + 1) * (MAP_STEPS / 2)).astype(np.int64)
        return node * (MAP_STEPS + 1) + step

    def tally(self, counters: Counters, count: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the runs at rows add to the map's counts: (occurrences, ones) by cell."""
        out = np.zeros((2, 256 * (MAP_STEPS + 1)))
        for i in range(0, len(rows), TOGETHER):
            part = rows[i : i + TOGETHER]
            x, gate, bit = self.inputs(counters, part, own=1)
            cell = self.cells(counters.code[part], self.mixed(x, gate, weights), bit).ravel()
            c = np.broadcast_to(count[part], bit.shape).ravel().astype(np.float64)
            out[0] += np.bincount(cell, weights=c, minlength=out.shape[1])
            out[1] += np.bincount(cell, weights=c * bit.ravel(), minlength=out.shape[1])
        return out

    def log10(self, counters: Counters) -> np.ndarray:
        """(2 x runs) the logarithm of the probability of each run's byte after the others: by the sum, and by the map."""
        n = len(counters.code)
        out = np.empty((2, n))
        for i in range(0, n, TOGETHER):
            rows = slice(i, min(n, i + TOGETHER))
            x, gate, bit = self.inputs(counters, rows)
            s = self.mixed(x, gate)
            p = 1 / (1 + np.exp(-s.astype(np.float64)))
            seen, ones = self.refine[:, self.cells(counters.code[rows], s, bit)]
            fine = (np.where(bit == 1, ones, seen - ones) + 8 * p) / (seen + 8)
            # Half of each, so that no cell rules anything out.
            out[0, rows] = np.log10(p).sum(axis=0)
            out[1, rows] = np.log10(0.5 * p + 0.5 * fine).sum(axis=0)
        return out


def put_together(sums: np.ndarray, maps: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The logarithm of each text's probability from the two predictions of its bytes: mixed by how much better the second did on the RECENT bytes before."""
    better = (maps - sums) * np.log(10)
    total = np.concatenate([[0.0], np.cumsum(better)])
    at = np.arange(len(sums))
    begin = np.repeat(bounds[:-1], np.diff(bounds))
    lead = np.clip(total[at] - total[np.maximum(at - RECENT, begin)], -30, 30)
    w = 1 / (1 + np.exp(-lead))
    each = sums + np.log10(1 - w + w * np.exp(better))
    return np.add.reduceat(each, bounds[:-1]) if len(bounds) > 1 else np.zeros(0)


WORD, TEXT, GRAM, LOW = "word", "text", "gram", "low"


def runs_packed(code: np.ndarray, count: np.ndarray) -> bytes:
    return _packed(planes(np.diff(code, prepend=U64(0))), planes(count.astype(np.int32)))


def runs_unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    step, count = _unpacked(payload, "u1", "u1")
    return np.cumsum(from_planes(step, "<u8"), dtype=U64), from_planes(count, "<i4")


def by_bucket(code: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order of distinct sorted runs by bucket; (bucket, from, to) in that order)."""
    home = mix((code >> U64(8 * (RUN - HOME))) + U64(1)) >> U64(64 - bits)
    o = np.argsort(home, kind="stable").astype(np.int32)
    return o, _bucket_rows(home[o] << U64(64 - bits), bits)


def batch_runs(buf: np.ndarray, offs: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of texts and their occurrences in those that teach."""
    code, bounds = runs_of(buf, offs)
    key, n = summed(code, np.repeat(learn, np.diff(bounds)))
    return key, n.astype(np.int32)


def gathered_counts(rows: DataFrame, bits: int) -> DataFrame:
    """(kind, block, bucket, entries, payload): per block of rows (doc_id, text, held), its distinct words and runs by bucket, its short contexts, its texts."""

    def emit(batches):
        held, size = [], 0
        seen = {"words": [], "runs": []}

        def merge(c: str):
            """What was seen of a block so far, as one."""
            parts = seen.pop(c)
            seen[c] = [summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))]
            return seen[c][0]

        def flush():
            name = uuid.uuid4().int >> 65
            out = []
            offs = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(h["offs"]) for h in held]))])
            cols = [np.concatenate([h[c] for h in held]) for c in ("ids", "null", "learn")]
            out.append((TEXT, 0, int(cols[2].sum()), _packed(np.concatenate([h.pop("buf") for h in held]), offs, cols[0], cols[1].view(np.uint8), cols[2].view(np.uint8))))
            word, count = merge("words")
            out += [(WORD, b, y - x, _packed(word[x:y], count[x:y].astype(np.int32))) for b, x, y in _bucket_rows(word, bits)]
            code, count = merge("runs")
            o, buckets = by_bucket(code, bits)
            out += [(GRAM, b, y - x, runs_packed(code[o[x:y]], count[o[x:y]])) for b, x, y in buckets]
            key, n = summed(of_order(code, 2), count)
            out.append((LOW, 0, len(key), _packed(np.diff(key.astype(np.int32), prepend=np.int32(0)), n)))
            kind, bucket, entries, payload = (list(c) for c in zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(kind), pa.array([name] * len(out), pa.int64()), pa.array(bucket, pa.int32()), pa.array(entries, pa.int64()), binaries(payload)],
                names=["kind", "block", "bucket", "entries", "payload"],
            )

        for t in gathered(batches, BATCH_BYTES, "text"):
            buf, offs = text_buffers(t.column("text"))
            ids = t.column("doc_id").combine_chunks()
            null = np.asarray(ids.is_null().to_pylist(), bool)
            learn = ~np.asarray(t.column("held").to_pylist(), bool) & ~null
            h, text = _words(buf, offs)
            seen["words"].append(summed(h, learn[text]))
            seen["runs"].append(batch_runs(buf, offs, learn))
            held.append({"buf": buf.copy(), "offs": offs, "ids": ids.fill_null(0).to_numpy(), "null": null, "learn": learn})
            size += len(buf)
            if len(seen["runs"]) > MERGED:
                merge("words")
                merge("runs")
            if size >= BLOCK_BYTES:
                yield flush()
                held, size, seen = [], 0, {"words": [], "runs": []}
        if held:
            yield flush()

    return in_batches(rows, emit, "kind string, block long, bucket int, entries long, payload binary")


def word_counts(counts: DataFrame) -> DataFrame:
    """(kind, block, bucket, payload, known, tokens): for the words of each block, their occurrences in all texts that teach."""

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(x, "<u8", "<i4") for x in pdf["payload"]]
        _, place = placed(np.concatenate([p[0] for p in parts]))
        c = np.bincount(place, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        each = [_packed(c[x]) for x in np.split(place, np.cumsum([len(p[0]) for p in parts])[:-1])]
        first = np.arange(len(parts)) == 0
        return pd.DataFrame({"kind": WORD, "block": pdf["block"], "bucket": pdf["bucket"], "payload": each, "known": np.where(first, (c > 0).sum(), 0), "tokens": np.where(first, c.sum(), 0)})

    words_of = counts.filter(F.col("kind") == WORD).select("block", "bucket", "payload")
    return words_of.groupBy("bucket").applyInPandas(total, "kind string, block long, bucket int, payload binary, known long, tokens long")


def short_contexts(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(contexts of two bytes with the byte after them, sorted; their occurrences in texts that teach): 2**24 at most, and some 10**5 of text."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(x, "<i4", "<i8") for x in pdf["payload"]]
        key, n = summed(np.concatenate([np.cumsum(p[0], dtype=np.int32) for p in parts]), np.concatenate([p[1] for p in parts]))
        return pd.DataFrame({"payload": [_packed(np.diff(key, prepend=np.int32(0)), n)]})

    # The rows are as many as blocks: added up in two steps.
    m = max(1, round(shuffle_partitions(counts.sparkSession) ** 0.5))
    rows = counts.filter(F.col("kind") == LOW).select("payload", F.pmod(F.xxhash64("block"), F.lit(m)).alias("part"))
    some = rows.groupBy("part").applyInPandas(lambda p: add(p), "payload binary").collect()
    if not some:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    key, n = _unpacked(add(pd.DataFrame({"payload": [bytes(r["payload"]) for r in some]}))["payload"][0], "<i4", "<i8")
    return np.cumsum(key, dtype=np.int64).astype(U64), n


def merged(pdf: pd.DataFrame):
    """(distinct runs of a bucket, sorted; their occurrences; the places of each row's runs among them)."""
    parts = [runs_unpacked(x) for x in pdf["payload"]]
    code, place = placed(np.concatenate([p[0] for p in parts]))
    count = np.bincount(place, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
    return code, count, np.split(place, np.cumsum([len(p[0]) for p in parts])[:-1])


def trained(runs: DataFrame, low) -> Mixer:
    """The mixer that all runs (bucket, payload) teach: the weights of each bucket, averaged by how many bits they saw, and the map's counts of all buckets."""

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        code, count, _ = merged(pdf)
        counters = Counters(code, count, low.value)
        rows = np.flatnonzero(count > 0)
        # A fixed order that mixes contexts, as the weights are learned along it.
        rows = rows[np.argsort(mix(code[rows]))]
        w, seen = Mixer().learn(counters, count, rows)
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "seen": [seen.tobytes()], "w": [(w * seen[:, None]).tobytes()], "cells": [_packed(Mixer().tally(counters, count, rows, w))]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["w", "seen"])  # a fixed order of the sums
        seen, w = (sum(np.frombuffer(x) for x in pdf[c]) for c in ("seen", "w"))
        return pd.DataFrame({"seen": [seen.tobytes()], "w": [w.tobytes()], "cells": [_packed(sum(_unpacked(x, "<f8")[0] for x in pdf["cells"]))]})

    found = runs.select("bucket", "payload").groupBy("bucket").applyInPandas(learn, "bucket int, seen binary, w binary, cells binary")
    # Each row is of a fixed size, and there are as many as buckets: added up in two steps.
    m = max(1, round(shuffle_partitions(runs.sparkSession) ** 0.5))
    some = found.groupBy(F.pmod("bucket", F.lit(m)).alias("part")).applyInPandas(lambda p: add(p[["seen", "w", "cells"]]), "seen binary, w binary, cells binary").collect()
    mixer = Mixer()
    if not some:
        return mixer
    whole = add(pd.DataFrame({c: [bytes(r[c]) for r in some] for c in ("seen", "w", "cells")})).iloc[0]
    seen, w = np.frombuffer(whole["seen"]), np.frombuffer(whole["w"]).reshape(mixer.weights.shape)
    learnt = seen > 0
    mixer.weights[learnt] = (w[learnt] / seen[learnt, None]).astype(np.float32)
    return Mixer(mixer.weights, _unpacked(whole["cells"], "<f8")[0].reshape(mixer.refine.shape))


def run_scores(runs: DataFrame, low, model) -> DataFrame:
    """(kind, block, bucket, payload, known, tokens): the two predictions of each run of each block, in steps."""

    def predict(pdf: pd.DataFrame) -> pd.DataFrame:
        code, count, places = merged(pdf)
        score = model.value.log10(Counters(code, count, low.value))
        step = np.minimum(np.rint(-score * STEPS), 65535).astype(np.uint16)
        # The second as what it is more than the first: both pack better so.
        step[1] -= step[0]
        return pd.DataFrame({"kind": GRAM, "block": pdf["block"], "bucket": pdf["bucket"], "payload": [_packed(planes(step[0, p]), planes(step[1, p])) for p in places], "known": 0, "tokens": 0})

    return runs.select("block", "bucket", "payload").groupBy("bucket").applyInPandas(predict, "kind string, block long, bucket int, payload binary, known long, tokens long")


OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each word."""
    low = LOWER[buf]
    start, end, text = words(low, offs)
    return run_hash(low, start, end), text.astype(np.int32)


def block_scores(v: int, n: int, ends: int, bits: int):
    """Of a block's texts and what came back for it: the rows of the result. v, n: distinct and all training tokens; ends: how many of them are ends."""
    whole = n + ADDED * (v + 1)

    def run(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        for payload in texts["payload"]:
            buf, offs, ids, null, learn = _unpacked(payload, "u1", "<i8", "<i8", "u1", "u1")
            null, learn = null.astype(bool), learn.astype(bool)
            found = found.sort_values(["kind", "bucket"])
            counts = [_unpacked(x, "<i8")[0] for x in found["payload"][found["kind"] == WORD]]
            steps = [[from_planes(b, "<u2") for b in _unpacked(x, "u1", "u1")] for x in found["payload"][found["kind"] == GRAM]]
            m = len(ids)
            cut = [0]
            while cut[-1] < m:
                cut.append(max(cut[-1] + 1, int(np.searchsorted(offs, offs[cut[-1]] + BATCH_BYTES, side="right")) - 1))
            slices = [(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a], a, b) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            # The same distinct words and runs as were sent, in the same order.
            hashes = [_words(x, y) for x, y, _, _ in slices]
            word = distinct(np.concatenate([distinct(h) for h, _ in hashes]))
            c = np.concatenate([*counts, np.zeros(0, np.int64)])
            code = np.zeros(0, U64)
            for i in range(0, len(slices), MERGED):
                code = distinct(np.concatenate([code, *(distinct(runs_of(x, y)[0]) for x, y, _, _ in slices[i : i + MERGED])]))
            o, _ = by_bucket(code, bits)
            sums, maps = np.empty(len(code), np.uint16), np.empty(len(code), np.uint16)
            sums[o], maps[o] = (np.concatenate([s[k] for s in steps]) for k in range(2))
            maps += sums
            n_tokens, n_known, base, score, size = (np.empty(m) for _ in range(5))
            for (x, y, a, b), (h, text) in zip(slices, hashes, strict=True):
                some, place = placed(h)
                times = c[np.searchsorted(word, some)][place]
                n_tokens[a:b] = np.bincount(text, minlength=b - a) + 1
                n_known[a:b] = np.bincount(text, weights=times > 0, minlength=b - a) + (ends > 0)
                base[a:b] = np.bincount(text, weights=np.log10((times + ADDED) / whole), minlength=b - a) + np.log10((ends + ADDED) / whole)
                here, bounds = runs_of(x, y)
                some, place = placed(here)
                at = np.searchsorted(code, some)[place]
                score[a:b] = put_together(sums[at] / -STEPS, maps[at] / -STEPS, bounds)
                size[a:b] = np.diff(bounds)
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array(np.where(null, 0, ids), dtype="Int64"),
                        "held_out": ~learn & ~null,
                        "n_tokens": n_tokens.astype(np.int64),
                        "n_known": n_known.astype(np.int64),
                        "train_tokens": n,
                        "base_score": base,
                        "score": score,
                        "bits_per_byte": -score * np.log2(10) / size,
                    }
                )
            )
            out[-1].loc[null, "doc_id"] = pd.NA
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in OUT.split(", ")})

    return run


def scored(docs: DataFrame, folds: int = 10, held: int = 0) -> DataFrame:
    """docs (doc_id, text) to (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    Learns from the rows whose crc32(doc_id) mod folds is not held. A null text is empty: its only
    token, and its only symbol, is the end. A row without doc_id is scored, teaches nothing and is not held out. Rows stay one
    to one, repeated ones too; other columns are not read. With nothing to learn from, each bit has an even chance. Counters, weights and map are learned from all texts
    that teach.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("held", F.coalesce(remainder(mod=folds) == held, F.lit(False)))
    bits = bucket_bits(rows, BUCKET_BYTES, 4)
    counts = staged(gathered_counts(rows, bits), "kind")
    found = staged(word_counts(counts))
    s = found.agg(F.sum("known").alias("v"), F.sum("tokens").alias("n")).first()
    ends = counts.filter(F.col("kind") == TEXT).agg(F.sum("entries").alias("n")).first()["n"] or 0
    v, n = (s["v"] or 0) + (ends > 0), (s["n"] or 0) + ends
    low = spark.sparkContext.broadcast(short_contexts(counts))
    runs = counts.filter(F.col("kind") == GRAM)
    model = spark.sparkContext.broadcast(trained(runs, low))
    released(spark)
    scores = run_scores(runs, low, model)
    texts = counts.filter(F.col("kind") == TEXT).select("block", "payload")
    back = found.union(scores).select(F.col("block").alias("b"), "kind", "bucket", "payload")
    return texts.groupBy("block").cogroup(back.groupBy("b")).applyInPandas(lambda a, b: block_scores(v, n, ends, bits)(a[["payload"]], b), OUT)
