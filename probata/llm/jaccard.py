"""N-gram Jaccard join: size-aware, with exact components of near-duplicate documents.

A document is the set of its distinct word shingles; documents with equal sets are one class, and
classes are what is joined. Two sets link when their overlap reaches a bound that their sizes fix. Light sets
(few shingles) emit their subsets of that fixed size: two light sets with a common subset link, without more ado.
Heavy sets are found through inverted lists over the part of a set that linked sets must share, rarest
shingles first by a sketch of fixed size; pairs met in a list are verified on the whole sets. The size between light and
heavy is where subsets would cost more than lists. Two linked sets are met in the list of their rarest common shingle, where neither can
share more than what stands from its place on; members that cannot reach any other's size so leave a list, and pairs that cannot are not made. All
pairs of a short list are verified. The sets of a long one are first linked to the few with the smallest share of rare shingles, which are the same in all
lists of a group; then every pair of a list that is not yet in one component is verified too, long lists being dealt in chunks. Before a pair of a
long list is made, or sets are compared, it must be able to link by its bins: each set has its shingles counted by the low bits of their hashes, in about as many bins as
a quarter of its size, and what one set has more of in a bin cannot be shared. So no link between components is lost, though pairs within them are not all looked at.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probata.operators.graph import connected_components

from .common import binaries, bucket_bits, collected, dropped, gathered, in_batches, released, shuffle_partitions, staged, text_buffers
from .suffixes import _bucket_rows, _packed, _unpacked
from .textops import LOWER, U64, mix, run_hash, shingles, words

WIDTH = 5
#: Two sets link when NUM * |both| >= DEN * |either|, in hundredths.
PERCENT = 80
#: log2 of the counters of the sketch that orders shingles by frequency: 16 MB, then 4 MB of levels.
SKETCH_BITS = 22
#: The boundary between light and heavy is sought up to this size.
LIGHTEST = 16
BATCH_BYTES = 1 << 20
BLOCK_BYTES = 16 << 20
#: Text for which there is one bucket of lists at least.
BUCKET_BYTES = 128 << 20
#: Matches by chance that a comparison of 32-bit hashes allows for at least.
CHANCE = 8
#: Bins in which the shingles of a set are counted, at least, and shingles for each bin beyond; a bin counts to FULL.
BINS, OF_BIN, FULL = 64, 4, 255
#: As many rows of ids (16 bytes each) are sent to all executors at most; beyond that, they are joined by a shuffle.
MOST_SENT = 1 << 20


def needed(a, b):
    """The least overlap with which sets of sizes a and b link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def chance(n):
    """Matches by chance to allow for among n 32-bit hashes: the mean, and six deviations with CHANCE more."""
    mean = n * n / 2.0**33
    return CHANCE + mean + 6 * mean**0.5


def partner_sizes(n: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) size of a set with which a set of size n can link, if the first common shingle stands at a place in it."""
    return -(-PERCENT * n // 100), np.minimum(100 * n // PERCENT, (100 + PERCENT) * (n - place) // PERCENT - n)


def partners(n: int) -> range:
    """Sizes that a set of size n can link with."""
    return range(-(-PERCENT * n // 100), 100 * n // PERCENT + 1)


def subset_sizes(n: int, lightest: int = LIGHTEST) -> list[int]:
    """Sizes of the subsets that a light set of size n emits."""
    return sorted({int(needed(n, b)) for b in partners(n) if 0 < b <= lightest and needed(n, b) <= min(n, b)})


def prefix_length(n):
    return n - (PERCENT * n + 99) // 100 + 1


def boundary(sizes: dict[int, int], scan: float) -> int:
    """The largest light size, by cost.

    sizes: how many sets have each size up to LIGHTEST; scan: sets met in an inverted list, on average. A light set
    costs its subsets, a heavy one its list entries, each with the verification of the sets met.
    """
    best, best_cost, cost = 0, 0.0, 0.0
    for n in range(1, LIGHTEST + 1):
        light = sum(comb(n, c) for c in subset_sizes(n))
        heavy = prefix_length(n) * (1 + scan * n)
        cost += sizes.get(n, 0) * (light - heavy)
        if cost <= best_cost:
            best, best_cost = n, cost
    return best


def sets_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text index, set key by text): each text's distinct shingles, sorted, and a hash of the set."""
    n = len(offs) - 1
    low = LOWER[buf]
    start, end, text = words(low, offs)
    h, t = shingles(run_hash(low, start, end), text, n, WIDTH)
    key = np.zeros(n, U64)
    if len(t):
        first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        key[t[first]] = mix(np.add.reduceat(mix(h + U64(0x51ED270B)), first) + np.diff(np.append(first, len(t))).astype(U64))
    return h, t, key


def binned(h: np.ndarray) -> np.ndarray:
    """The shingles of a set by the low bits of their hashes, in a power of two of bins."""
    size = BINS
    while size * OF_BIN < len(h):
        size *= 2
    return np.minimum(np.bincount((h & U64(size - 1)).astype(np.int64), minlength=size), FULL).astype(np.uint8)


def most_shared(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A bound of the overlaps of sets of sizes a and b with bins x and y (pairs x bins); a full bin tells nothing, and neither do the others of its set."""
    full = (x == FULL).any(axis=1) | (y == FULL).any(axis=1)
    x, y = x.astype(np.int32), y.astype(np.int32)
    while x.shape[1] > y.shape[1]:
        x = x[:, : x.shape[1] // 2] + x[:, x.shape[1] // 2 :]
    while y.shape[1] > x.shape[1]:
        y = y[:, : y.shape[1] // 2] + y[:, y.shape[1] // 2 :]
    more = x - y
    bound = np.minimum(a - np.maximum(more, 0).sum(axis=1), b - np.maximum(-more, 0).sum(axis=1))
    return np.where(full, np.minimum(a, b), bound)


def read_sets(docs: DataFrame) -> DataFrame:
    """(kind, doc_id, n, key, payload): per document its set's size, key and bins (kind 0), per task the sketch's counters (kind 1)."""

    def emit(batches):
        counters, held = np.zeros(1 << SKETCH_BITS, np.int32), []

        def count():
            if held:
                counters[:] += np.bincount(np.concatenate(held), minlength=len(counters)).astype(np.int32)
                held.clear()

        for t in gathered(batches, BATCH_BYTES, "text"):
            buf, offs = text_buffers(t.column("text"))
            h, text, key = sets_of(buf, offs)
            held.append((h >> U64(64 - SKETCH_BITS)).astype(np.int32))
            if len(held) > 8:
                count()
            n = len(key)
            cut = np.searchsorted(text, np.arange(n + 1))
            bins = [binned(h[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), t.column("doc_id").combine_chunks(), pa.array(np.bincount(text, minlength=n), pa.int64()), pa.array(key.view(np.int64)), binaries(bins)],
                names=["kind", "doc_id", "n", "key", "payload"],
            )
        count()
        step = 1 << (SKETCH_BITS - 4)
        parts = [_packed(counters[i : i + step]) for i in range(0, len(counters), step)] if counters.any() else []
        k = np.arange(len(parts))
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(parts), np.int32)), pa.array(k, pa.int64()), pa.array(k, pa.int64()), pa.array(k, pa.int64()), binaries(parts)], names=["kind", "doc_id", "n", "key", "payload"])

    return in_batches(docs.select("doc_id", "text"), emit, "kind int, doc_id long, n long, key long, payload binary")


def frequency_levels(rows: DataFrame) -> tuple[np.ndarray, float]:
    """(level by counter, mean number of other sets in a list): how far above the usual a shingle's counter stands."""

    def add(kind: str):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(1 << (SKETCH_BITS - 4), np.int64)
            for x in pdf["payload"]:
                total += _unpacked(x, kind)[0]
            return pd.DataFrame({"n": [pdf["n"].iloc[0]], "payload": [_packed(total)]})

        return run

    n = shuffle_partitions(rows.sparkSession)
    parts = rows.filter("kind = 1").select("n", "payload", F.pmod(F.xxhash64("payload"), F.lit(max(1, round(n**0.5)))).alias("salt"))
    some = parts.groupBy("n", "salt").applyInPandas(add("<i4"), "n long, payload binary")
    counters = np.zeros(1 << SKETCH_BITS, np.int64)
    step = 1 << (SKETCH_BITS - 4)
    for r in some.groupBy("n").applyInPandas(add("<i8"), "n long, payload binary").collect():  # 16 rows of 2 MB at most
        counters[r["n"] * step : (r["n"] + 1) * step] = _unpacked(bytes(r["payload"]), "<i8")[0]
    usual = float(np.median(counters))
    # Counters vary by chance about as the root of what is usual.
    above = np.maximum(1.0, (counters - usual) / (3 * usual**0.5 + 2))
    level = np.minimum(31, np.log2(above).astype(np.int64)).astype(np.uint8)
    scan = float(np.maximum(0, counters - 2 * usual - 16).sum() / max(1, counters.sum()))
    return level, scan


def subset_keys(n: int, h: np.ndarray, lightest: int) -> list[tuple[int, np.ndarray]]:
    """(size, keys by set) of the subsets that the sets in h (sets x n) emit."""
    m = mix(h + U64(0x2545F491))
    total = m.sum(axis=1, dtype=U64)
    out = []
    for c in subset_sizes(n, lightest):
        gone = np.array(list(combinations(range(n), n - c)), np.int64).reshape(comb(n, c), n - c)
        left = total[:, None] - m[:, gone].sum(axis=2, dtype=U64)
        out.append((c, mix(left + mix(np.array([c], U64)))))
    return out


#: Kinds of what comes out of a bucket: pairs to verify, links of subsets, and members of long lists.
LIST, SUBSET, MEMBERS = 0, 1, 2
#: Lists up to this length give all their pairs; leaders of a longer one that its sets are linked to at first; members that a row holds.
SHORT, LEADERS, CHUNK = 4, 8, 1024
#: Bytes of bins that a chunk holds, about.
CHUNK_BYTES = 4 << 20


def list_entries(docs: DataFrame, level: np.ndarray, light: int, bits: int) -> DataFrame:
    """(bucket, payload): entries of inverted lists and of subsets, each set once in a block of documents."""
    sent = docs.sparkSession.sparkContext.broadcast(level)
    shared = -(-PERCENT * (light + 1) // 100)  # light sets from here on can link with heavy ones

    def emit(batches):
        held, size = [], 0

        def flush():
            token, key, n, c, p, rare = (np.concatenate([x[k] for x in held]) for k in range(6))
            where = mix(token)
            o = np.argsort(where)
            where = where[o]
            rows = _bucket_rows(where, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), binaries([_packed(np.diff(where[a:b], prepend=U64(0)), key[o[a:b]], n[o[a:b]].astype(np.int32), c[o[a:b]].astype(np.uint8), p[o[a:b]].astype(np.int32), rare[o[a:b]].astype(np.uint8)) for _, a, b in rows])],
                names=["bucket", "payload"],
            )

        seen: set[int] = set()
        for t in gathered(batches, BATCH_BYTES, "text"):
            buf, offs = text_buffers(t.column("text"))
            h, text, key = sets_of(buf, offs)
            n = np.bincount(text, minlength=len(key))
            fresh = np.zeros(len(key), bool)
            for i, k in enumerate(key.tolist()):
                if n[i] and k not in seen:
                    seen.add(k)
                    fresh[i] = True
            # Rarest first, then by hash.
            height = sent.value[(h >> U64(64 - SKETCH_BITS)).astype(np.int64)]
            order = (height.astype(U64) << U64(59)) | (h & U64((1 << 59) - 1))
            rare = 255 * np.bincount(text, weights=height == 0, minlength=len(key)).astype(np.int64) // np.maximum(n, 1)
            cut = np.searchsorted(text, np.arange(len(key) + 1))
            takes = fresh & (n >= shared)
            parts, who, places = [], [], []
            for i in np.flatnonzero(takes).tolist():
                p = int(prefix_length(n[i]))
                part = order[cut[i] : cut[i + 1]]
                part = part.copy() if p >= len(part) else np.partition(part, p - 1)[:p]
                part.sort()
                parts.append(part)
                who.append(np.full(len(part), i))
                places.append(np.arange(len(part)))
            if parts:
                token, w = mix(np.concatenate(parts)), np.concatenate(who)
                held.append((token, key[w], n[w], np.zeros(len(w), np.int64), np.concatenate(places), rare[w]))
            for m in range(1, light + 1):
                some = np.flatnonzero(fresh & (n == m))
                if len(some):
                    sets = h[cut[some][:, None] + np.arange(m)]
                    for c, keys in subset_keys(m, sets, light):
                        k = keys.shape[1]
                        held.append((keys.ravel(), np.repeat(key[some], k), np.full(k * len(some), m), np.full(k * len(some), c), *np.zeros((2, k * len(some)), np.int64)))
            size += len(buf)
            if size >= BLOCK_BYTES:
                if held:
                    yield from flush()
                held, size, seen = [], 0, set()
        if held:
            yield from flush()

    return in_batches(docs.select("text"), emit, "bucket int, payload binary")


def _groups(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])) if len(values) else np.zeros(1, np.int64)


def _met(light: int):
    """Of a bucket: links of light sets, pairs to verify, and members of long lists (a: the list, b: which part of it)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(x, "<u8", "<u8", "<i4", "u1", "<i4", "u1") for x in pdf["payload"]]
        token = np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts])
        key, n, c, place, rare = (np.concatenate([p[k] for p in parts]) for k in range(1, 6))
        n, place = n.astype(np.int64), place.astype(np.int64)
        o = np.lexsort((key, n, token, c))
        once = np.ones(len(o), bool)
        once[1:] = (token[o][1:] != token[o][:-1]) | (c[o][1:] != c[o][:-1]) | (key[o][1:] != key[o][:-1])
        token, key, n, c, place, rare = (x[o[once]] for x in (token, key, n, c, place, rare))
        subsets = slice(int(np.searchsorted(c, 1)), len(c))
        kinds, pairs = [], []

        def put(kind: int, a: np.ndarray, b: np.ndarray) -> None:
            pairs.append((a, b))
            kinds.append(np.full(len(a), kind))

        # Light sets with a common subset link if it is as large as their sizes ask for.
        size, at = n[subsets], token[subsets]
        cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (c[subsets][1:] != c[subsets][:-1]), [True]])) if len(at) else np.zeros(1, np.int64)
        first = np.repeat(cut[:-1], np.diff(cut))
        sub = (np.arange(len(at)) != first) & (needed(size, size[first]) <= c[subsets])
        put(SUBSET, key[subsets][first[sub]], key[subsets][sub])
        # Lists, without the members that can link with no other by their places.
        token, key, n, place, rare = (x[: subsets.start] for x in (token, key, n, place, rare))
        lo, hi = partner_sizes(n, place)
        for _ in range(3):
            cut = _groups(token)
            many = np.diff(cut)
            if not len(many):
                break
            least, most = (np.repeat(f.reduceat(n, cut[:-1]), many) for f in (np.minimum, np.maximum))
            stay = (hi >= least) & (lo <= most) & np.repeat(many > 1, many)
            token, key, n, lo, hi, rare = (x[stay] for x in (token, key, n, lo, hi, rare))
        cut = _groups(token)
        many = np.diff(cut)
        fits = lambda i, j: (n[j] >= lo[i]) & (n[j] <= hi[i]) & (n[i] >= lo[j]) & (n[i] <= hi[j])
        # In pairs, the set with the smaller share of rare shingles comes first.
        before = lambda i, j: (rare[i] < rare[j]) | ((rare[i] == rare[j]) & (key[i] < key[j]))
        for m in range(2, SHORT + 1):
            begin = cut[:-1][many == m]
            for x, y in combinations(range(m), 2):
                i, j = begin + x, begin + y
                good = fits(i, j)
                i, j = i[good], j[good]
                turn = before(i, j)
                put(LIST, key[np.where(turn, i, j)], key[np.where(turn, j, i)])
        rows = {"a": [], "b": [], "keys": []}
        for x, y in zip(cut[:-1][many > SHORT].tolist(), cut[1:][many > SHORT].tolist(), strict=True):
            left = np.arange(x, y)[np.lexsort((key[x:y], rare[x:y]))]
            for _ in range(LEADERS):
                if len(left) < 2:
                    break
                led = fits(left[0], left[1:])
                put(LIST, np.full(led.sum(), key[left[0]]), key[left[1:][led]])
                left = left[1:][~led]
            name = mix(mix(key[x:y]).sum(dtype=U64, keepdims=True)).view(np.int64)[0]
            for i in range(x, y, CHUNK):
                j = min(y, i + CHUNK)
                rows["a"].append(name)
                rows["b"].append((i - x) // CHUNK)
                rows["keys"].append(np.concatenate([key[i:j], n[i:j].astype(U64)]).tobytes())
        table = np.column_stack([np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]), np.concatenate(kinds).astype(U64)])
        table = np.unique(table, axis=0) if len(table) else table
        k, m = len(table), len(rows["keys"])
        return pd.DataFrame(
            {
                "kind": np.concatenate([table[:, 2].astype(np.int64), np.full(m, MEMBERS)]),
                "a": np.concatenate([np.ascontiguousarray(table[:, 0]).view(np.int64), np.asarray(rows["a"], np.int64)]),
                "b": np.concatenate([np.ascontiguousarray(table[:, 1]).view(np.int64), np.asarray(rows["b"], np.int64)]),
                "keys": [None] * k + rows["keys"],
            }
        )

    return run


def sent_if_few(df: DataFrame) -> DataFrame:
    """A staged table, marked to be sent to all executors if its rows are at most MOST_SENT."""
    df = staged(df)
    return F.broadcast(df) if df.count() <= MOST_SENT else df


def possible(pairs: DataFrame, bins: DataFrame) -> DataFrame:
    """Those of pairs (a, b) of set keys that can link by their bins (key, n, payload)."""

    def run(frames):
        for pdf in frames:
            a, b = pdf["na"].to_numpy(), pdf["nb"].to_numpy()
            x, y = pdf["xa"].to_numpy(), pdf["xb"].to_numpy()
            size = np.array([len(v) for v in x], np.int64) << 32 | np.array([len(v) for v in y], np.int64)
            keep = np.zeros(len(pdf), bool)
            # Pairs with as many bins are looked at together, a few MB of bins at a time.
            for s in np.unique(size).tolist():
                at = np.flatnonzero(size == s)
                step = max(1, (1 << 20) // ((s >> 32) + (s & 0xFFFFFFFF)))
                for i in range(0, len(at), step):
                    some = at[i : i + step]
                    u, v = (np.frombuffer(b"".join(z[some]), np.uint8).reshape(len(some), -1) for z in (x, y))
                    keep[some] = most_shared(a[some], u, b[some], v) >= needed(a[some], b[some])
            yield pdf.loc[keep, ["a", "b"]]

    both = pairs.join(bins.toDF("a", "na", "xa"), "a").join(bins.toDF("b", "nb", "xb"), "b")
    return staged(both.select("a", "b", "na", "xa", "nb", "xb").mapInPandas(run, "a long, b long"))


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, wide: bool = False) -> DataFrame:
    """Those of pairs (a, b) of set keys whose sets link. reps: (key, doc_id) of a document for each set.

    Sets travel as 32 bits of each hash, which can only overstate an overlap; pairs that a few chance matches could decide are
    verified again with 48 bits.
    """
    spark = docs.sparkSession
    ids = sent_if_few(pairs.select("a").union(pairs.select("b")).distinct().toDF("key").join(reps, "key"))
    rows = docs.join(ids, "doc_id").select("key", "text")

    def emit(batches):
        for t in gathered(batches, BATCH_BYTES, "text"):
            buf, offs = text_buffers(t.column("text"))
            h, text, key = sets_of(buf, offs)
            asked = t.column("key").to_numpy()
            cut = np.searchsorted(text, np.arange(len(key) + 1))
            # A doc_id may stand for several rows: only the row with the set asked for counts.
            right = np.flatnonzero(key.view(np.int64) == asked)
            out = []
            for i in right.tolist():
                s = h[cut[i] : cut[i + 1]] >> U64(16)
                step = np.diff((s >> U64(16)).astype(np.uint32), prepend=np.uint32(0))
                out.append(_packed(step, (s & U64(0xFFFF)).astype(np.uint16)) if wide else _packed(step))
            yield pa.RecordBatch.from_arrays([pa.array(asked[right]), binaries(out)], names=["key", "hashes"])

    sets = staged(in_batches(rows, emit, "key long, hashes binary"))
    released(spark)

    def compare(frames):
        for pdf in frames:
            keep, close, last, x = [], [], None, None
            for a, sa, sb in zip(pdf["a"], pdf["sa"], pdf["sb"], strict=True):
                if a != last:
                    last, x = a, _set(sa, wide)
                both = np.concatenate([x, _set(sb, wide)])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                links = lambda m: 100 * m >= PERCENT * (len(both) - m)
                keep.append(links(common))
                close.append(not wide and links(common) and not links(common - chance(len(both))))
            yield pd.DataFrame({"a": pdf["a"][keep], "b": pdf["b"][keep], "close": [c for k, c in zip(keep, close, strict=True) if k]})

    leaders = sets.join(sent_if_few(pairs.select(F.col("a").alias("key")).distinct()), "key", "left_semi")
    one = pairs.join(sets.toDF("b", "sb"), "b")
    found = one.join(leaders.toDF("a", "sa"), "a").select("a", "b", "sa", "sb").mapInPandas(compare, "a long, b long, close boolean")
    found = staged(found)
    dropped(sets)
    released(spark)
    sure = found.filter("not close").select("a", "b")
    again = found.filter("close").select("a", "b").distinct()
    return sure if wide or again.isEmpty() else sure.union(verified(again, reps, docs, wide=True))


def _set(packed: bytes, wide: bool) -> np.ndarray:
    if not wide:
        return np.cumsum(_unpacked(packed, "<u4")[0], dtype=np.int64)
    step, low = _unpacked(packed, "<u4", "<u2")
    return (np.cumsum(step, dtype=np.int64) << 16) | low


def _across(frames):
    """Pairs of a list's sets, or of two chunks of it, that are in different components and can link by size and by bins."""
    for pdf in frames:
        a, b = [], []
        for one, members in zip(pdf["one"], pdf["members"], strict=True):
            n, key, root, chunk = (np.array([m[c] for m in members], np.int64) for c in ("n", "key", "root", "chunk"))
            o = np.argsort(n, kind="stable")
            n, key, root, chunk = n[o], key[o], root[o], chunk[o]
            bins = [np.frombuffer(members[i]["payload"], np.uint8) for i in o]
            width = np.array([len(x) for x in bins])
            # Sets with as many bins stand together, in a table of their own.
            tables = {w: np.stack([bins[i] for i in np.flatnonzero(width == w)]) for w in np.unique(width).tolist()}
            row = np.zeros(len(n), np.int64)
            for w, t in tables.items():
                row[width == w] = np.arange(len(t))
            top = np.searchsorted(n, 100 * n // PERCENT, side="right")
            for i in range(len(n)):
                part = slice(i + 1, top[i])
                other = np.flatnonzero((root[part] != root[i]) & (one | (chunk[part] != chunk[i]))) + i + 1
                for w in np.unique(width[other]).tolist():
                    alike = other[width[other] == w]
                    step = max(1, (1 << 20) // (w + len(bins[i])))
                    for j in range(0, len(alike), step):
                        some = alike[j : j + step]
                        some = some[most_shared(n[i : i + 1], bins[i][None], n[some], tables[w][row[some]]) >= needed(n[i], n[some])]
                        a.append(np.full(len(some), key[i]))
                        b.append(key[some])
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) to (doc_id, n_shingles, component_id).

    component_id is the smallest doc_id reachable by links, itself included. A null text is empty: no
    shingles, no links. Rows stay one to one; rows of one doc_id are one node, and a row without doc_id links
    with nothing and has no component_id. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    bits = bucket_bits(rows, BUCKET_BYTES, 6)
    read = staged(read_sets(rows))
    members = read.filter("kind = 0").select("doc_id", "n", "key")
    level, scan = frequency_levels(read)
    sizes = {r["n"]: r["c"] for r in members.filter((F.col("n") > 0) & (F.col("n") <= LIGHTEST)).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    light = boundary(sizes, scan)
    linked = members.filter("n > 0 and doc_id is not null")
    reps = staged(linked.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")))
    entries = list_entries(rows.filter("doc_id is not null"), level, light, bits)
    met = staged(entries.groupBy("bucket").applyInPandas(_met(light), "kind long, a long, b long, keys binary"))
    released(spark)
    collected(spark)
    sure = met.filter(F.col("kind") == SUBSET).select("a", "b")
    pairs = staged(met.filter(F.col("kind") == LIST).select("a", "b").distinct())
    reps_of = reps.select("key", "doc_id")
    heavy = read.filter(f"kind = 0 and n > {light * PERCENT // 100} and doc_id is not null")
    bins = staged(heavy.select("key", "n", "payload").dropDuplicates(["key"]))
    first = staged(sure.union(verified(possible(pairs, bins), reps_of, rows)))
    roots = staged(connected_components(first))
    # The long lists whose sets are not in one component yet; many lists are alike.
    lists = met.filter(F.col("kind") == MEMBERS).select(F.col("a").alias("list"), "b", "keys").dropDuplicates(["list", "b"])

    def unpack(frames):
        for pdf in frames:
            out = []
            for name, keys in zip(pdf["list"], pdf["keys"], strict=True):
                k = np.frombuffer(keys, np.int64)
                h = len(k) // 2
                out.append(pd.DataFrame({"list": name, "key": k[:h], "n": k[h:]}))
            if out:
                yield pd.concat(out)

    entry = lists.select("list", "keys").mapInPandas(unpack, "list long, key long, n long")
    own = roots.select(F.col("node").alias("key"), "root")
    entry = staged(entry.join(own, "key", "left").select("list", "key", "n", F.coalesce("root", "key").alias("root")))
    dropped(met, roots)
    released(spark)
    collected(spark)
    mixed = entry.groupBy("list").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("c"), F.sum(F.greatest(F.lit(BINS), 2 * F.col("n") / OF_BIN)).alias("size"))
    mixed = mixed.filter("lo <> hi").select("list", F.ceil(F.greatest(F.col("c") / CHUNK, F.col("size") / CHUNK_BYTES)).alias("chunks"))
    # Each chunk of a list meets each, in a row of its own.
    dealt = entry.join(mixed, "list").withColumn("chunk", F.pmod(F.xxhash64("key"), "chunks")).join(bins.select("key", "payload"), "key").withColumn("with", F.explode(F.expr("sequence(0L, chunks - 1)")))
    dealt = dealt.select("list", F.least("chunk", "with").alias("low"), F.greatest("chunk", "with").alias("high"), F.struct("key", "n", "root", "chunk", "payload").alias("member"))
    grouped = dealt.groupBy("list", "low", "high").agg(F.collect_list("member").alias("members")).select((F.col("low") == F.col("high")).alias("one"), "members")
    rest = staged(grouped.mapInPandas(_across, "a long, b long").distinct())
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = staged(rest.join(done, ["a", "b"], "left_anti"))
    second = verified(rest, reps_of, rows)
    dropped(entry, bins, pairs)
    links = staged(first.union(second))
    more = connected_components(links).select(F.col("node").alias("key"), "root")
    # The least document of each component, then of each class; the small table of components is one of its own, so that large ones can be split.
    in_parts = staged(reps.join(more, "key"))
    least = staged(in_parts.groupBy("root").agg(F.min("doc_id").alias("least")))
    part = in_parts.join(least, "root").select("key", "least")
    of_class = reps.join(part, "key", "left").select("key", "doc_id", "copies", F.coalesce("least", "doc_id").alias("least"))
    of_class = staged(of_class.filter("copies > 1 or least <> doc_id").select("key", "least"))
    out = members.join(of_class, "key", "left")
    component = F.when(F.col("n") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
