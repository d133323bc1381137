"""Benchmark decontamination: windows of documents within a few edits of a benchmark item.

Edit distance is turned into Hamming distance by random walks: at each step a walk notes the word it
stands on and goes on or stays, as a random bit of that word and step says, so that walks over two texts fall into
step again after an edit. A repetition samples a few steps; a window is a candidate when all its sampled words are
those of an item's walk, which is looked up step by step, so that most windows end at the first. Repetitions
differ in the bits, in the steps sampled and in where in the item they start. Walks never span more than LONGEST words or so; a longer item
is entered at several starts in each repetition, so that its recall grows with its length. Candidates are then verified: the exact edit
distance, in words, of the item to the best stretch of the document around the window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, in_batches, text_buffers
from .textops import LOWER, U64, mix, run_hash, words

#: Edits allowed, per hundred words of an item.
PERCENT_EDITS = 20
#: Repetitions for each class of window lengths, and sampled steps of each.
REPETITIONS, SAMPLED = 12, 4
#: The class of the longest windows; longer items have a start for every so many words in each repetition.
LONGEST, EVERY = 32, 16
#: Starts of a shorter item of 8 words or more in each repetition.
STARTS = 3
#: Items are sent to the executors in blocks of this many bytes of text; each block is a pass over the documents.
ITEM_BYTES = 8 << 20
BATCH_BYTES = 1 << 20
#: Cells of edit tables worked on together, which stay in the cache, and rows after which candidates beyond the allowed edits leave.
CELLS, ROWS = 1 << 18, 3
SEED = 20

_KEPT = np.ones(256, bool)
_KEPT[[b for b in range(128) if not (chr(b).isalnum() or b in (0x20, *range(9, 14)))]] = False


def plain_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of each word in lower case without ASCII punctuation; words of nothing else vanish."""
    low = LOWER[buf]
    if len(buf):
        capital = np.concatenate([[False], buf[:-1] == 0xC3]) & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)
        low = low + np.where(capital, np.uint8(0x20), np.uint8(0))
    keep = _KEPT[low]
    count = np.concatenate([[0], np.cumsum(keep)])
    low, offs = low[keep], count[offs]
    start, end, text = words(low, offs)
    return run_hash(low, start, end), text


def marked(word: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(words with a zero after each text, first place of each text): a walk never leaves a zero."""
    out = np.zeros(len(word) + n, U64)
    out[np.arange(len(word)) + text] = word | U64(1 << 63)
    count = np.bincount(text, minlength=n)
    return out, np.concatenate([[0], np.cumsum(count + 1)])


class Repetition:
    """Sampled steps, the bits of the walk, and the keys of the items that take part."""

    def __init__(self, steps: list[int], offset: int, stride: int):
        self.steps, self.offset, self.stride = steps, offset, stride
        self.keys = [[] for _ in steps]
        self.items: list[tuple[int, int]] = []

    def walk(self, w: np.ndarray, at: np.ndarray, tables: list[np.ndarray] | None):
        """(places, keys) of the walks that pass each table, from places whose first word has passed; without tables, all keys of each walk."""
        i = at
        key = np.zeros(len(at), U64)
        trail = []
        now = 0
        for k, to in enumerate(self.steps):
            for j in range(now, to):
                b = U64((j * self.stride + self.offset) % 63)
                i = i + ((w[i] >> b) & U64(1)).astype(np.int64)
            now = to
            key = mix(key * U64(0x9E3779B97F4A7C15) + w[i]) if k else w[i]
            if tables is None:
                trail.append(key)
            elif k:
                on = tables[k][(key & U64(0xFFFF)).astype(np.int64)]
                at, i, key = at[on], i[on], key[on]
        return (at, key) if tables is not None else trail


class Index:
    """The walks of a block of items."""

    def __init__(self, ids: list, texts: list[str]):
        rng = np.random.default_rng(SEED)
        buf, offs = text_buffers(pa.array(texts, pa.large_string()))
        word, text = plain_words(buf, offs)
        self.ids = ids
        cut = np.searchsorted(text, np.arange(len(ids) + 1))
        self.words = [word[a:b] | U64(1 << 63) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        w, begin = marked(word, text, len(ids))
        size = np.array([len(x) for x in self.words], np.int64)
        self.size = size
        self.reps = []
        top = max(1, int(np.ceil(np.log2(size.max(initial=1) + 1))))
        # A long item is cut into parts, one start in each; a short one has a few starts.
        count = np.where(size < 2 * LONGEST, np.where(size < 8, 1, STARTS), (size - LONGEST) // EVERY)
        which = np.repeat(np.arange(len(size)), count)
        part_of = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        for low in (1 << k for k in range(top) if 1 << k <= LONGEST):
            for _ in range(REPETITIONS):
                reach = max(1, int(1.2 * low))
                picks = min(SAMPLED - 1, reach)
                steps = [0, *sorted(rng.choice(np.arange(1, reach + 1), picks, replace=False).tolist())]
                rep = Repetition(steps, int(rng.integers(63)), int(rng.choice([1, 2, 4, 5, 8, 10, 11, 13, 16, 17, 19, 20])))
                # A short item starts at a random word, up to a third of it in; what is left decides its class.
                some = rng.random(len(which))
                short = (some * np.maximum(1, size // 3 + (size > 3))[which]).astype(np.int64)
                start = np.where(size[which] >= 2 * LONGEST, part_of * EVERY + (some * EVERY).astype(np.int64), short)
                left = size[which] - start
                part = np.flatnonzero((left >= low) & ((left < 2 * low) | (low == LONGEST)))
                if not len(part):
                    continue
                item, start = which[part], start[part]
                trail = rep.walk(w, begin[item] + start, None)
                rep.tables = []
                for key in trail:
                    t = np.zeros(1 << 16, bool)
                    t[(key & U64(0xFFFF)).astype(np.int64)] = True
                    rep.tables.append(t)
                order = np.argsort(trail[-1], kind="stable")
                rep.last, rep.item, rep.start = trail[-1][order], item[order], start[order]
                self.reps.append(rep)

    def candidates(self, w: np.ndarray, places: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, place where the item would begin), one for each text, item and stretch of places that the allowed edits span."""
        found = []
        first = (w[places] & U64(0xFFFF)).astype(np.uint16)
        for rep in self.reps:
            at, key = rep.walk(w, places[rep.tables[0][first]], rep.tables)
            lo, hi = np.searchsorted(rep.last, key), np.searchsorted(rep.last, key, side="right")
            n = hi - lo
            if n.any():
                k = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                hit = np.repeat(at, n)
                found.append(np.column_stack([np.searchsorted(begin, hit, side="right") - 1, rep.item[k], hit - rep.start[k]]))
        if not found:
            z = np.zeros(0, np.int64)
            return z, z, z
        own, item, place = np.unique(np.concatenate(found), axis=0).T
        # Windows are verified with twice the allowed edits of room, so that places as near as the allowed edits need one check.
        span = place // (self.size[item] * PERCENT_EDITS // 100 + 1)
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (item[1:] != item[:-1]) | (span[1:] != span[:-1])])
        return own[new], item[new], place[new]

    def verified(self, w: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray, item: np.ndarray):
        """(text, item, edits, place) of the candidates that are within the allowed edits; first and last bound the words of each candidate's text."""
        out_edits = np.full(len(place), 1 << 30)
        allowed = self.size[item] * PERCENT_EDITS // 100
        order = np.argsort(self.size[item], kind="stable")
        i = 0
        while i < len(order):
            width = 0
            j = i
            while j < len(order):
                n = int(self.size[item[order[j]]])
                wide = n + 4 * (n * PERCENT_EDITS // 100) + 1
                if j > i and wide * (j - i + 1) > CELLS:
                    break
                width = wide
                j += 1
            part = order[i:j]
            out_edits[part] = self._edits(w, first[part], last[part], place[part], item[part], width)
            i = j
        return out_edits <= allowed, out_edits

    def _edits(self, w, first, last, place, item, width: int) -> np.ndarray:
        size = self.size[item]
        slack = 2 * (size * PERCENT_EDITS // 100)
        start = place - slack
        cols = start[:, None] + np.arange(width)
        inside = (cols >= first[:, None]) & (cols < last[:, None]) & (np.arange(width) < (size + 2 * slack)[:, None])
        doc = np.where(inside, w[np.clip(cols, 0, len(w) - 1)], U64(0))
        longest = int(size.max())
        text = np.zeros((len(item), longest), U64)
        for row, k in enumerate(item):
            text[row, : size[row]] = self.words[k]
        # Row by row over the item: least edits of its first words to a stretch that ends at each column. The least of a row never falls
        # from row to row, so a candidate leaves once it is beyond the allowed edits. What is within them is exact: no more words are put in.
        allowed = size * PERCENT_EDITS // 100
        most = int(allowed.max())
        kind = np.uint8 if longest + 2 * most + 4 < 1 << 8 else np.uint16 if longest + 2 * most + 4 < 1 << 16 else np.int32
        d = np.zeros((len(item), width + 1), kind)
        one = kind(1)
        best = np.full(len(item), 1 << 30)
        alive = np.arange(len(item))
        for r in range(1, longest + 1):
            new = d + one
            np.minimum(new[:, 1:], d[:, :-1] + (doc != text[:, r - 1 : r]), out=new[:, 1:])
            step = 1
            while True:  # words of the document put in: 1, then 2, 4 and so on
                np.minimum(new[:, step:], new[:, :-step] + kind(step), out=new[:, step:])
                step *= 2
                if step > max(1, most) or step > width:
                    break
            d = new
            done = size == r
            if done.any():
                best[alive[done]] = d[done].min(axis=1)
            if r % ROWS == 0 or done.any():
                on = ~done & (d.min(axis=1) <= allowed)
                if 4 * np.count_nonzero(on) < 3 * len(on):
                    alive, size, allowed, doc, text, d = (x[on] for x in (alive, size, allowed, doc, text, d))
                    if not len(alive):
                        break
        return best


def leaks_in(index: Index, buf: np.ndarray, offs: np.ndarray):
    """(text, item, edits, word) of each text and item, best first found: the least edits and where the item would begin."""
    n = len(offs) - 1
    word, text = plain_words(buf, offs)
    w, begin = marked(word, text, n)
    places = np.arange(len(word)) + text
    own, item, place = index.candidates(w, places, begin)
    z = np.zeros(0, np.int64)
    if not len(place):
        return z, z, z, z
    good, edits = index.verified(w, begin[own], begin[own + 1] - 1, place, item)
    own, place, item, edits = own[good], place[good], item[good], edits[good]
    o = np.lexsort((place, edits, item, own))
    own, place, item, edits = own[o], place[o], item[o], edits[o]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (item[1:] != item[:-1])]) if len(own) else np.zeros(0, bool)
    return own[new], item[new], edits[new], np.maximum(place[new] - begin[own[new]], 0)


def indexes(benchmark: DataFrame):
    """The items (item_id, text) in blocks of ITEM_BYTES, each indexed; items without words are left out."""
    ids, texts, size = [], [], 0
    for r in benchmark.select("item_id", "text").filter("text is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        if plain_words(*text_buffers(pa.array([r["text"]], pa.large_string())))[0].size:
            ids.append(r["item_id"])
            texts.append(r["text"])
            size += len(r["text"])
        if size >= ITEM_BYTES:
            yield Index(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Index(ids, texts)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_words, edits, word): each document and item that it holds within the allowed edits.

    edits is the least edit distance in words, of at most PERCENT_EDITS of the item's; word is where in the document
    the window begins. Null and empty texts hold nothing; an item without words is nowhere. Repeated rows give one
    row; rows without doc_id are taken as one document. Other columns are not read.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, item_words long, edits long, word long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    out = spark.createDataFrame([], schema)
    for index in indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            index = sent.value
            for t in gathered(batches, BATCH_BYTES, "text"):
                buf, offs = text_buffers(t.column("text"))
                own, item, edits, word = leaks_in(index, buf, offs)
                yield pa.RecordBatch.from_arrays(
                    [
                        t.column("doc_id").combine_chunks().take(pa.array(own)),
                        pa.array([index.ids[i] for i in item], pa.int64()),
                        pa.array(index.size[item], pa.int64()),
                        pa.array(edits, pa.int64()),
                        pa.array(word, pa.int64()),
                    ],
                    names=["doc_id", "item_id", "item_words", "edits", "word"],
                )

        out = out.union(in_batches(rows, run, schema))
    best = F.min(F.struct("edits", "item_words", "word")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.item_words", "b.edits", "b.word")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose text holds no benchmark item; null texts hold none. All columns stay."""
    spark = docs.sparkSession
    out = docs
    for index in indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for t in gathered(batches, BATCH_BYTES, "text"):
                buf, offs = text_buffers(t.column("text").combine_chunks().fill_null(""))
                keep = np.ones(t.num_rows, bool)
                keep[leaks_in(sent.value, buf, offs)[0]] = False
                yield from t.filter(pa.array(keep)).to_batches()

        out = in_batches(out, run, out.schema)
    return out
