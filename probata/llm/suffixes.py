"""Suffix-array dedup: removes bytes that an earlier document already holds in a long enough string.

Equal strings of WINDOW bytes have the same least k-gram (by hash) at the same place, so each
window belongs to one k-gram occurrence, and a fragment is all windows of one occurrence. 1. A window reaches at
least half its other bytes beyond its k-gram to the left or to the right; blocks of documents send their k-grams with either side to
buckets, which answer, by one bit each, which of them two documents share. 2. Fragments with a shared side are dealt into buckets by their k-gram, each distinct
one of a block once, with the least document that holds it. 3. In a bucket, a suffix array over the fragments is built by two-stage
sorting: only suffixes smaller than their successors are sorted, the others follow from bucket
scans; neighbours with a common prefix of WINDOW bytes are the same string. The least document of
each string goes back to the blocks, and from there to the documents.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, bucket_bits, dropped, gathered, in_batches, let_go, released, staged, text_buffers
from .textops import BYTE_VALUE, U64, distinct_by_text, from_planes, mix, planes, span_hash

WINDOW = 50
GRAM = 12
#: Bits of a k-gram with a side that are compared. Two that differ meet by chance in one of 2**KEY_BITS pairs, which costs a fragment sent for nothing.
KEY_BITS = 44
BATCH_BYTES = 1 << 20
#: Texts are cut into overlapping pieces of this size, and blocks flushed beyond it.
PIECE_BYTES = 1 << 23
BLOCK_BYTES = 8 << 20
#: Text for which there is one bucket at least.
BUCKET_BYTES = 512 << 20


def occurrences(buf: np.ndarray, offs: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(k-gram hash, text index, first window, number of windows, place of the k-gram) of each fragment, in order."""
    parts = []
    n_texts = len(offs) - 1
    if len(buf) <= PIECE_BYTES:
        pieces = [(0, len(buf))]
    else:
        pieces = [(a, min(len(buf), a + PIECE_BYTES + window - 1)) for a in range(0, len(buf), PIECE_BYTES)]
    text = np.repeat(np.arange(n_texts, dtype=np.int32), np.diff(offs))
    for a, b in pieces:
        if b - a >= window:
            k, t, s, m, p = _occurrences(buf[a:b], text[a:b], window)
            parts.append((k, t, s + a, m, p + a))
    if not parts:
        z = np.zeros(0, np.int64)
        return z.astype(U64), z, z, z, z
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _occurrences(buf: np.ndarray, text: np.ndarray, window: int):
    n = len(buf)
    pack = np.empty(n - 7, U64)
    raw = np.ascontiguousarray(buf)
    for s in range(8):
        m = (n - s) // 8
        pack[s::8][:m] = np.frombuffer(raw[s : s + 8 * m].tobytes(), "<u8")
    h = pack[: n - GRAM + 1] * U64(0x9E3779B97F4A7C15)
    h ^= pack[GRAM - 8 : n - 7] * U64(0xC2B2AE3D27D4EB4F) >> U64(7)
    h ^= h >> U64(31)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    place = U64((1 << 24) - 1)
    low = (h & ~place) | np.arange(len(h), dtype=U64)
    span = window - GRAM + 1
    width = 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    at = np.flatnonzero(text[: len(low)] == text[window - 1 :])
    if not len(at):
        z = np.zeros(0, np.int64)
        return z.astype(U64), z, z, z, z
    place_of = (low[at] & place).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (place_of[1:] != place_of[:-1]) | (at[1:] != at[:-1] + 1)]))
    return mix(h[place_of[new]]), text[at[new]].astype(np.int64), at[new], np.diff(np.append(new, len(at))), place_of[new]


def side_keys(buf: np.ndarray, offs: np.ndarray, text: np.ndarray, place: np.ndarray, window: int = WINDOW):
    """(left key, right key, left is there, right is there): hashes of each k-gram with the bytes that a window has at least on one side."""
    side = (window - GRAM) // 2
    left = place - side >= offs[text]
    right = place + GRAM + side <= offs[text + 1]
    hashed = lambda at: span_hash(buf, at, GRAM + side)
    lk, rk = np.zeros(len(place), U64), np.zeros(len(place), U64)
    lk[left] = mix(hashed(place[left] - side) + U64(1))
    rk[right] = mix(hashed(place[right]) + U64(2))
    return lk, rk, left, right


def sorted_suffixes(rows: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The order of all suffixes of the rows (zero-padded, values above zero), as positions in the flat array.

    Two-stage sorting. A row ends with a mark below all values. Suffixes smaller than their successor
    are sorted; a scan over the buckets of first values, in rising order, places the others: the
    suffix before a placed one, if it starts with a larger value or with the same one and is larger, is next in its bucket.
    """
    n, width = rows.shape
    flat = rows.ravel()
    col = np.arange(n * width) % width
    real = (np.arange(width) < lens[:, None]).ravel()
    nxt = np.append(flat[1:], 0)
    differs = (flat != nxt) | ~real
    turn = np.where(differs, np.arange(len(flat)), len(flat) - 1)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    rising = real & (flat[turn] < nxt[turn])
    packed = packed8(flat)
    direct = _sorted_directly(np.flatnonzero(rising), packed, width)
    begin = np.searchsorted(flat[direct], np.arange(257))
    held: list[list[np.ndarray]] = [[] for _ in range(257)]

    def offer(before: np.ndarray) -> None:
        value = flat[before]
        o = np.argsort(value, kind="stable")
        before, value = before[o], value[o]
        cut = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1], [True]])) if len(value) else []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            held[value[a]].append(before[a:b])

    last = np.arange(n) * width + lens - 1
    offer(last[lens > 0])
    out = []
    for c in range(1, 256):
        bucket = []
        now = np.concatenate(held[c]) if held[c] else np.zeros(0, np.int64)
        while len(now):
            bucket.append(now)
            before = now[col[now] > 0] - 1
            now = before[flat[before] == c]
        bucket.append(direct[begin[c] : begin[c + 1]])
        whole = np.concatenate(bucket)
        if not len(whole):
            continue
        out.append(whole)
        before = whole[col[whole] > 0] - 1
        offer(before[flat[before] > c])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def packed8(flat: np.ndarray) -> np.ndarray:
    """The eight values from each place on as one number that compares like them."""
    wide = np.concatenate([flat, np.zeros(8, np.uint8)])
    out = np.empty(len(flat), U64)
    for s in range(8):
        m = len(range(s, len(flat), 8))
        out[s::8] = np.frombuffer(wide[s : s + 8 * m].tobytes() + bytes(max(0, 8 * m - (len(wide) - s))), ">u8")[:m]
    return out


def _sorted_directly(p: np.ndarray, packed: np.ndarray, width: int) -> np.ndarray:
    """The suffixes at p in order, eight values at a time; only ties are looked at again."""
    if not len(p):
        return p
    key = packed[p]
    o = np.argsort(key, kind="stable")
    p, key = p[o], key[o]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    ended = (key & U64(255)) == 0
    for depth in range(8, width, 8):
        group = np.cumsum(new) - 1
        tied = np.flatnonzero((np.bincount(group)[group] > 1) & ~ended)
        if not len(tied):
            break
        q, g = p[tied], group[tied]
        far = q % width + depth < width
        key = np.where(far, packed[np.minimum(q + depth, len(packed) - 1)], U64(0))
        o = np.lexsort((key, g))
        p[tied], key = q[o], key[o]
        ended[tied] = (key & U64(255)) == 0
        split = np.concatenate([[False], (key[1:] != key[:-1]) & (g[1:] == g[:-1])])
        new[tied[split]] = True
    return p


def least_holders(frags: np.ndarray, lens: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fragment, window within it, least document that holds the same string) of every window."""
    width = -(-(int(lens.max()) + 1) // 8) * 8
    rows = np.zeros((len(lens), width), np.uint8)
    rows[np.arange(width) < lens[:, None]] = frags + np.uint8(1)  # UTF-8 has no byte above 0xF4
    order = sorted_suffixes(rows, lens)
    row = order // width
    inside = order - row * width <= lens[row] - window
    order, row = order[inside], row[inside]
    packed = packed8(rows.ravel())
    same = np.ones(max(0, len(order) - 1), bool)
    for k in [*range(0, window - 7, 8), window - 8]:
        key = packed[order + k]
        same &= key[1:] == key[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    least = np.minimum.reduceat(doc[row], first)
    return row, order - row * width, np.repeat(least, np.diff(np.append(first, len(order))))


def _packed(*arrays: np.ndarray) -> bytes:
    raw = b"".join(struct.pack("<q", a.nbytes) + a.tobytes() for a in arrays)
    return struct.pack("<q", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(b: bytes, *types: str) -> list[np.ndarray]:
    raw = pa.decompress(b[8:], struct.unpack("<q", b[:8])[0], codec="zstd", asbytes=True)
    out, at = [], 0
    for t in types:
        size = struct.unpack_from("<q", raw, at)[0]
        out.append(np.frombuffer(raw, t, size // np.dtype(t).itemsize, at + 8))
        at += 8 + size
    return out


def _bucket_rows(values: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the sorted values by their top bits."""
    b = (values >> U64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else []
    return [(int(b[x]), int(x), int(y)) for x, y in zip(cut[:-1], cut[1:], strict=True)]


def text_blocks(docs: DataFrame) -> DataFrame:
    """(block, payload): the rows of docs (doc_id, text, crc) in blocks of about BLOCK_BYTES of text."""

    def pack(batches):
        held, size = [], 0

        def flush():
            offs = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(h[1]) for h in held]))])
            payload = _packed(np.concatenate([h[0] for h in held]), offs, *(np.concatenate([h[k] for h in held]) for k in (2, 3)))
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65], pa.int64()), binaries([payload])], names=["block", "payload"])

        for t in gathered(batches, BATCH_BYTES, "text"):
            buf, offs = text_buffers(t.column("text"))
            held.append((buf.copy(), offs, t.column("doc_id").to_numpy(), t.column("crc").to_numpy()))
            size += len(buf)
            if size >= BLOCK_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return in_batches(docs, pack, "block long, payload binary")


def slices(payload: bytes):
    """(bytes, offsets, doc_id, crc) of the texts of a block, about BATCH_BYTES at a time."""
    buf, offs, ids, crcs = _unpacked(payload, "u1", "<i8", "<i8", "<i8")
    a = 0
    while a < len(ids):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + BATCH_BYTES, side="right")) - 1)
        yield buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a], ids[a:b], crcs[a:b]
        a = b


def short_keys(buf: np.ndarray, offs: np.ndarray, text: np.ndarray, place: np.ndarray, window: int):
    """side_keys of KEY_BITS."""
    lk, rk, left, right = side_keys(buf, offs, text, place, window)
    return lk >> U64(64 - KEY_BITS), rk >> U64(64 - KEY_BITS), left, right


def key_bounds(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    return _bucket_rows(keys << U64(64 - KEY_BITS), bits)


def shared_keys(blocks: DataFrame, bits: int, window: int = WINDOW) -> DataFrame:
    """(block, bucket, marks): for the distinct keys of each block, sorted, whether two rows hold one; a bit each, by bucket."""

    def emit(batches):
        for batch in batches:
            for name, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = []
                for buf, offs, _, _ in slices(payload.as_py()):
                    _, text, _, _, place = occurrences(buf, offs, window)
                    lk, rk, left, right = short_keys(buf, offs, text, place, window)
                    held.append(distinct_by_text(np.concatenate([lk[left], rk[right]]), np.concatenate([text[left], text[right]]))[0])
                keys = np.sort(np.concatenate(held))
                if not len(keys):
                    continue
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                twice = np.diff(np.append(first, len(keys))) > 1
                keys = keys[first]
                rows = key_bounds(keys, bits)
                packed = [_packed(planes(np.diff(keys[a:b], prepend=U64(0))), np.packbits(twice[a:b])) for _, a, b in rows]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()), binaries(packed)], names=["block", "bucket", "keys"])
        let_go()

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(x, "u1", "u1") for x in pdf["keys"]]
        keys = [np.cumsum(from_planes(p[0], "<u8"), dtype=U64) for p in parts]
        size = [len(k) for k in keys]
        twice = np.concatenate([np.unpackbits(p[1], count=n) for p, n in zip(parts, size, strict=True)]).astype(bool)
        keys = np.concatenate(keys)
        o = np.argsort(keys, kind="stable")
        new = np.concatenate([[True], keys[o][1:] != keys[o][:-1]])
        first = np.flatnonzero(new)
        many = (np.diff(np.append(first, len(o))) > 1) | np.logical_or.reduceat(twice[o], first)
        shared = np.empty(len(o), bool)
        shared[o] = many[np.cumsum(new) - 1]
        marks = [_packed(np.packbits(x)) for x in np.split(shared, np.cumsum(size)[:-1])]
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "marks": marks})

    rows = in_batches(blocks, emit, "block long, bucket int, keys binary")
    return rows.groupBy("bucket").applyInPandas(mark, "block long, bucket int, marks binary")


def hot_fragments(payload: bytes, found: pd.DataFrame, bits: int, window: int):
    """(key, hash, doc_id, crc, first byte, length, bytes) of the fragments of a block with a shared side, only as far as it reaches; found has the block's marks."""
    side = (window - GRAM) // 2
    parts = []
    for buf, offs, ids, crcs in slices(payload):
        key, text, a, m, place = occurrences(buf, offs, window)
        parts.append((buf, offs, ids, crcs, key, text, a, m, place, *short_keys(buf, offs, text, place, window)))
    keys = np.sort(np.concatenate([np.concatenate([p[9][p[11]], p[10][p[12]]]) for p in parts]))
    if not len(keys):
        return
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    marks = dict(zip(found["bucket"], found["marks"], strict=True))
    # The same distinct keys as were sent, in the same order.
    shared = np.concatenate([np.unpackbits(_unpacked(marks[x], "u1")[0], count=b - a) for x, a, b in key_bounds(keys, bits)]).astype(bool)
    keys = keys[shared]

    def hot_of(key, there):
        on = np.flatnonzero(there)
        at = np.searchsorted(keys, key[on])
        out = np.zeros(len(key), bool)
        out[on] = np.append(keys, U64(0))[at] == key[on] if len(keys) else False
        return out

    for buf, offs, ids, crcs, key, text, a, m, place, lk, rk, left, right in parts:
        left, right = hot_of(lk, left), hot_of(rk, right)
        # With one side shared, only the windows that reach as far on that side.
        end = np.where(right, a + m, np.minimum(a + m, place - side + 1))
        a = np.where(left, a, np.maximum(a, place - side))
        m = end - a
        hot = (left | right) & (m > 0)
        key, text, a, m = key[hot], text[hot], a[hot], m[hot]
        if len(key):
            lens = m + window - 1
            where = np.repeat(a - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
            data = buf[where]
            yield key, _fragment_hash(data, lens), ids[text], crcs[text], a - offs[text], lens, data


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, crc, spans): the byte spans, merged, that a document with a smaller doc_id holds within a string of window bytes.

    docs: (doc_id long, text string), without nulls; crc is that of the text and tells rows of one doc_id apart.
    spans is pairs of 4-byte numbers, from and to.
    """
    spark = docs.sparkSession
    bits = min(16, bucket_bits(docs, BUCKET_BYTES, 6))
    texts = staged(text_blocks(docs.withColumn("crc", F.crc32("text"))))
    marks = staged(shared_keys(texts, bits, window))
    released(spark)

    def emit(block: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        cols = ([], [], [], [])
        for name, payload in zip(block["block"], block["payload"], strict=True):
            held = list(hot_fragments(payload, found, bits, window))
            if not held:
                continue
            key, h, doc, crc, start, lens = (np.concatenate([x[k] for x in held]) for k in range(6))
            data = np.concatenate([x[6] for x in held])
            begin = np.concatenate([[0], np.cumsum(lens)[:-1]])
            bucket = (key >> U64(64 - bits)).astype(np.int64)
            order = np.lexsort((doc, h, bucket))
            b, hh, dd = bucket[order], h[order], doc[order]
            new = np.concatenate([[True], (b[1:] != b[:-1]) | (hh[1:] != hh[:-1])])
            first = np.flatnonzero(new)
            low, high = dd[first], np.maximum.reduceat(dd, first)
            number = np.cumsum(new) - 1
            cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]]))
            for x, y in zip(cut[:-1], cut[1:], strict=True):
                f = first[number[x] : number[y - 1] + 1]
                at = order[f]
                text = data[np.repeat(begin[at] - np.concatenate([[0], np.cumsum(lens[at])[:-1]]), lens[at]) + np.arange(lens[at].sum())]
                o = order[x:y]
                cols[0].append(name)
                cols[1].append(int(b[x]))
                cols[2].append(_packed(lens[at].astype(np.uint8), low[number[f]], high[number[f]] - low[number[f]], text))
                cols[3].append(_packed((number[x:y] - number[x]).astype(np.int32), doc[o], crc[o], start[o].astype(np.int32)))
        let_go()
        return pd.DataFrame({"block": pd.Series(cols[0], dtype="int64"), "bucket": pd.Series(cols[1], dtype="int32"), "frags": cols[2], "places": cols[3]})

    def resolve(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(x, "u1", "<i8", "<i8", "u1") for x in pdf["frags"]]
        lens, low, data = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 3))
        lens = lens.astype(np.int64)
        _, first, inverse = np.unique(_fragment_hash(data, lens), return_index=True, return_inverse=True)
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, inverse, low)
        begin = np.concatenate([[0], np.cumsum(lens)[:-1]])
        fl = lens[first]
        where = np.repeat(begin[first] - np.concatenate([[0], np.cumsum(fl)[:-1]]), fl) + np.arange(fl.sum())
        frag, place, holder = least_holders(data[where], fl, least, window)
        o = np.lexsort((place, frag))
        frag, place, holder = frag[o], place[o], holder[o]
        # Runs of windows of a fragment with one holder.
        cut = np.flatnonzero(np.concatenate([[True], (frag[1:] != frag[:-1]) | (holder[1:] != holder[:-1]) | (place[1:] != place[:-1] + 1)]))
        run_frag, run_at, run_to, run_holder = frag[cut], place[cut], place[np.append(cut[1:], len(frag)) - 1], holder[cut]
        r0, r1 = np.searchsorted(run_frag, np.arange(len(first))), np.searchsorted(run_frag, np.arange(len(first)), side="right")
        out = []
        i = 0
        for p in parts:
            k = len(p[0])
            f = inverse[i : i + k]
            n = r1[f] - r0[f]
            at = np.repeat(r0[f] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            own = np.repeat(np.arange(k), n)
            useful = run_holder[at] < np.repeat(p[1] + p[2], n)
            at, own = at[useful], own[useful]
            out.append(_packed(own.astype(np.int32), run_at[at].astype(np.uint8), run_to[at].astype(np.uint8), run_holder[at]))
            i += k
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "runs": out})

    blocks = staged(texts.groupBy("block").cogroup(marks.groupBy("block")).applyInPandas(emit, "block long, bucket int, frags binary, places binary"))
    dropped(texts, marks)
    released(spark)
    runs = staged(blocks.select("block", "bucket", "frags").groupBy("bucket").applyInPandas(resolve, "block long, bucket int, runs binary"))
    released(spark)
    both = blocks.select("block", "bucket", "places").join(runs, ["block", "bucket"])

    def spread(frames):
        for pdf in frames:
            held = []
            for places, run in zip(pdf["places"], pdf["runs"], strict=True):
                number, doc, crc, start = _unpacked(places, "<i4", "<i8", "<i8", "<i4")
                own, a, b, holder = _unpacked(run, "<i4", "u1", "u1", "<i8")
                if not len(own):
                    continue
                lo, hi = np.searchsorted(own, number), np.searchsorted(own, number, side="right")
                n = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                who = np.repeat(np.arange(len(number)), n)
                gone = holder[at] < doc[who]
                at, who = at[gone], who[gone]
                held.append((doc[who], crc[who], (start[who] + a[at]).astype(np.int32), (start[who] + b[at] + window).astype(np.int32)))
            if not held:
                continue
            doc, crc, a, b = (np.concatenate([x[k] for x in held]) for k in range(4))
            if not len(doc):
                continue
            a, b, doc, crc = _merged(doc, crc, a, b)
            group = mix(doc.astype(U64))
            o = np.argsort(group >> U64(64 - bits), kind="stable")
            rows = _bucket_rows(group[o], bits)
            yield pd.DataFrame({"part": [r[0] for r in rows], "spans": [_packed(doc[o[x:y]], crc[o[x:y]], a[o[x:y]], b[o[x:y]]) for _, x, y in rows]})

    def collect(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(x, "<i8", "<i8", "<i4", "<i4") for x in pdf["spans"]]
        doc, crc, a, b = (np.concatenate([p[k] for p in parts]) for k in range(4))
        a, b, doc, crc = _merged(doc, crc, a, b)
        cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1]), [True]]))
        spans = np.column_stack([a, b]).astype("<i4")
        return pd.DataFrame({"doc_id": doc[cut[:-1]], "crc": crc[cut[:-1]], "spans": [spans[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]})

    dealt = both.mapInPandas(spread, "part int, spans binary")
    found = staged(dealt.groupBy("part").applyInPandas(collect, "doc_id long, crc long, spans binary"))
    dropped(blocks, runs)
    released(spark)
    return found


def _fragment_hash(data: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """A hash of each fragment in data, which holds them one after another."""
    end = np.cumsum(lens)
    start = end - lens
    at = np.arange(len(data)) - np.repeat(start, lens)
    weight = mix(np.arange(1, int(lens.max()) + 1, dtype=U64) * U64(0xC2B2AE3D27D4EB4F)) | U64(1)
    return mix(np.add.reduceat(BYTE_VALUE[data] * weight[at], start) + lens.astype(U64))


def _merged(doc, crc, a, b):
    """Spans of each row, joined where they touch."""
    o = np.lexsort((a, crc, doc))
    doc, crc, a, b = doc[o], crc[o], a[o], b[o]
    row = np.cumsum(np.concatenate([[True], (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1])])) - 1
    reach = np.maximum.accumulate(b.astype(np.int64) + (row << 33))
    new = np.concatenate([[True], a[1:].astype(np.int64) + (row[1:] << 33) > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a)) - 1
    return a[first], (reach[last] - (row[last] << 33)).astype(np.int32), doc[first], crc[first]


def deduplicated(docs: DataFrame, window: int = WINDOW, keep: bool = False) -> DataFrame:
    """docs (doc_id, text) to (doc_id, n_bytes, n_removed, n_spans, kept_sha256), with kept (bytes) if asked for.

    Every byte goes that lies in a string of window bytes which also starts in a document with a smaller
    doc_id, judged on the input. A null text is empty. Rows stay one to one: rows of one doc_id do not
    touch each other, and one without doc_id neither loses nor takes anything. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spans = repeats(rows.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= window)), window)
    both = rows.withColumn("crc", F.crc32("text")).join(spans, ["doc_id", "crc"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep

    def cut(batches):
        for t in gathered(batches, BATCH_BYTES, "text"):
            buf, offs = text_buffers(t.column("text"))
            raw = memoryview(np.ascontiguousarray(buf))
            out = ([], [], [], [], [])
            for i, spans in enumerate(t.column("spans").to_pylist()):
                x, y = int(offs[i]), int(offs[i + 1])
                s = np.frombuffer(spans, "<i4").reshape(-1, 2).tolist() if spans else []
                left, at = [], x
                for a, b in s:
                    left.append(raw[at : x + a])
                    at = x + b
                left.append(raw[at:y])
                kept = b"".join(left)
                for column, v in zip(out, (y - x, y - x - len(kept), len(s), hashlib.sha256(kept).hexdigest(), kept if keep else b""), strict=True):
                    column.append(v)
            arrays = [t.column("doc_id").combine_chunks(), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())] + [binaries(out[4])] * keep
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(arrays)])

    return in_batches(both, cut, schema)
