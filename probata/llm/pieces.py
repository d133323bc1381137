"""SentencePiece encoding and decoding for merge-type vocabularies.

A text starts as one symbol per character, white space written as U+2581 and one more put in
front. An agenda holds every adjacent pair that joins to a piece; the pair of the highest score,
the leftmost of equals, is joined until none is left. Characters outside the vocabulary become
their bytes. No piece of the vocabulary holds U+2581 after another character (checked on
loading), so a text falls into segments at each run of U+2581, and each distinct segment is worked
out once: the agendas of all new segments of an Arrow batch run in step, as arrays. What they
give is compared with the sentencepiece library, segment by segment; where they differ, the library's ids count, and the
segments of a text for which they did are reported.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
#: Distinct segments, and characters of them and their ids, that a Python worker remembers before it starts anew.
REMEMBERED, REMEMBERED_CHARS = 400_000, 16_000_000
#: Segments of a text that are held at once.
SEGMENTS = 1 << 16
#: Characters of new segments that are worked out together.
TOGETHER = 1 << 19


class Vocabulary:
    """The pieces of a merge-type model and which adjacent pairs join to which piece."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id_of = {sp.id_to_piece(i): i for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("a piece holds white space after another character")
        self.numbers = [str(i) for i in range(n)]
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.byte_id):
            raise ValueError("the vocabulary has no byte pieces")
        self.text_of = {i: p.replace(SPACE, " ") for p, i in self.id_of.items()}
        scores = sorted({sp.get_score(i) for i in plain}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        # Symbols of the agenda: pieces first, then characters that are no piece, numbered as they come.
        self.n = n
        self.char = {p: i for p, i in self.id_of.items() if len(p) == 1}
        #: Parts of pieces that are themselves reached by joining: a symbol is always a piece or a character.
        pairs = {}
        extra = {}
        for p, i in self.id_of.items():
            for k in range(1, len(p)):
                a, b = (self._symbol(x, extra) for x in (p[:k], p[k:]))
                if a is not None and b is not None:
                    pairs[a, b] = i
        self.extra = extra
        keys = np.array([a * (1 << 32) + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.joined = np.fromiter(pairs.values(), np.int64, len(pairs))[order]
        self.rank = np.full(n, len(scores), np.int64)
        for i in plain:
            self.rank[i] = rank_of[sp.get_score(i)]
        self.never = len(scores) + 1
        self._hash_pairs()
        self._forget()

    def _forget(self) -> None:
        self.strings: dict[str, str] = {}
        self.chars = 0
        #: Only of the segments that do not decode to themselves.
        self.decoded: dict[str, str] = {}
        #: Segments for which the library's ids count.
        self.corrected: set[str] = set()

    def _symbol(self, part: str, extra: dict[str, int]) -> int | None:
        i = self.id_of.get(part)
        if i is None and len(part) == 1:  # a character that is no piece can still be part of one
            i = extra.setdefault(part, self.n + 1 + len(extra))
        return i

    def _hash_pairs(self) -> None:
        """An open table of the joining pairs, for lookups of whole arrays."""
        size = 1 << max(4, int(np.ceil(np.log2(max(1, len(self.keys)) * 4))))
        self.mask = size - 1
        self.slot_key, self.slot_to = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        todo = np.arange(len(self.keys))
        step, self.probes = 0, 0
        while len(todo):
            at = self._slot(self.keys[todo], step)
            free = self.slot_key[at] == -1
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.slot_key[at[put]] = self.keys[todo[put]]
            self.slot_to[at[put]] = self.joined[todo[put]]
            todo = todo[~put]
            step += 1
        self.probes = step

    def _slot(self, key: np.ndarray, step: int) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (((h ^ (h >> np.uint64(29))) >> np.uint64(8)).astype(np.int64) + step) & self.mask

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece each pair joins to, or -1."""
        key = a * (1 << 32) + b
        out = np.full(len(key), -1, np.int64)
        todo = np.arange(len(key))
        for step in range(self.probes):
            at = self._slot(key[todo], step)
            held = self.slot_key[at]
            hit = held == key[todo]
            out[todo[hit]] = self.slot_to[at[hit]]
            todo = todo[~hit & (held != -1)]
            if not len(todo):
                break
        return out

    def agenda(self, segments: list[str]) -> list[list[int]]:
        """Ids of each segment: in every segment at once, the best pair on its agenda is joined until no pair joins."""
        n = len(segments)
        lens = np.fromiter(map(len, segments), np.int64, n)
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        distinct, inverse = np.unique(codes, return_inverse=True)
        known = np.array([self.char.get(chr(c), self.extra.get(chr(c), -int(c) - 2)) for c in distinct], np.int64)
        width = int(lens.max(initial=0)) + 1
        sym = np.full((n, width), -1, np.int64)
        sym[np.arange(width) < lens[:, None]] = known[inverse]
        cols = np.arange(width)
        nxt = np.broadcast_to(cols + 1, (n, width)).copy()
        prv = np.broadcast_to(cols - 1, (n, width)).copy()
        to = np.full((n, width), -1, np.int64)
        r, c = np.nonzero((sym[:, :-1] >= 0) & (sym[:, 1:] >= 0))
        to[r, c] = self.join(sym[r, c], sym[r, c + 1])
        order = np.where(to >= 0, self.rank[to], self.never)
        gone = np.zeros((n, width), bool)
        rows = np.arange(n)
        live = rows
        while True:
            best = np.argmin(order[live], axis=1)
            more = order[live, best] < self.never
            live, best = live[more], best[more]
            if not len(live):
                break
            b = nxt[live, best]
            sym[live, best] = to[live, best]
            gone[live, b] = True
            order[live, b] = self.never
            c = nxt[live, b]
            nxt[live, best] = c
            ends = c < lens[live]
            prv[live[ends], c[ends]] = best[ends]
            to[live, best] = -1
            to[live[ends], best[ends]] = self._join_known(sym[live[ends], best[ends]], sym[live[ends], c[ends]])
            order[live, best] = np.where(to[live, best] >= 0, self.rank[to[live, best]], self.never)
            a = prv[live, best]
            has = a >= 0
            la, pa_ = live[has], a[has]
            to[la, pa_] = self._join_known(sym[la, pa_], sym[la, best[has]])
            order[la, pa_] = np.where(to[la, pa_] >= 0, self.rank[to[la, pa_]], self.never)
        out = []
        keep = ~gone & (cols < lens[:, None])
        flat, counts = sym[keep].tolist(), keep.sum(axis=1).tolist()
        # Characters that are no piece: their code points, from the columns they stand in.
        back = {v: chr(c) for v, c in zip(known.tolist(), distinct.tolist(), strict=True) if not 0 <= v < self.n}
        odd = (((sym < 0) | (sym >= self.n)) & keep).any(axis=1).tolist()
        at = 0
        for k, strange in zip(counts, odd, strict=True):
            ids = flat[at : at + k]
            at += k
            if strange:
                ids = [y for i in ids for y in ([self.byte_id[x] for x in back[i].encode("utf-8", "surrogatepass")] if i in back else [i])]
            out.append(ids)
        return out

    def _join_known(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = self.join(a, b)
        out[(a < 0) | (b < 0)] = -1
        return out

    def decode_ids(self, ids: list[int]) -> str:
        """The text of ids: byte pieces as UTF-8, all others as they are, white space as blanks."""
        out, held = [], bytearray()
        for i in ids:
            p = self.text_of.get(i)
            if p is None:
                held.append(self.byte_id.index(i))
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(p)
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def learn(self, segments: set[str]) -> None:
        """Works out new segments, the longest apart from the short, and checks each against the library."""
        todo = sorted(segments, key=len)
        # Pieces that are no bytes add up to the segment.
        number, plain = self.numbers.__getitem__, frozenset(self.text_of)
        i = 0
        while i < len(todo):
            j, cells = i, 0
            while j < len(todo) and (j == i or (len(todo[j]) + 1) * (j - i + 1) <= TOGETHER):
                j += 1
            part = todo[i:j]
            if len(part) == 1 and len(part[0]) > 4096:
                ids = [self.agenda_of_one(part[0])]
            else:
                ids = self.agenda(part)
            theirs = self.library.encode([s[1:].replace(SPACE, " ") for s in part], num_threads=1)
            for s, a, b in zip(part, ids, theirs, strict=True):
                # White space alone is no text to the library; here it only ever stands before something.
                if a != b and s != SPACE:
                    self.corrected.add(s)
                    a = b
                self.strings[s] = ids_of = ",".join(map(number, a))
                self.chars += len(s) + len(ids_of)
                if not plain.issuperset(a):
                    self.decoded[s] = self.decode_ids(a)
            i = j

    def agenda_of_one(self, segment: str) -> list[int]:
        """The same agenda as a heap, for a single long segment."""
        import heapq

        sym = [self.char.get(c, self.extra.get(c, -ord(c) - 2)) for c in segment]
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        index = getattr(self, "_index", None)
        if index is None:
            index = self._index = dict(zip(self.keys.tolist(), self.joined.tolist(), strict=True))
        rank = self.rank
        heap = []

        def offer(a: int) -> None:
            b = nxt[a]
            if b < n and sym[a] >= 0 and sym[b] >= 0:
                to = index.get(sym[a] * (1 << 32) + sym[b])
                if to is not None:
                    heapq.heappush(heap, (int(rank[to]), a, to, sym[a], sym[b]))

        for a in range(n - 1):
            offer(a)
        gone = [False] * n
        while heap:
            _, a, to, x, y = heapq.heappop(heap)
            if gone[a] or sym[a] != x or nxt[a] >= n or sym[nxt[a]] != y:
                continue
            b = nxt[a]
            sym[a], gone[b] = to, True
            nxt[a] = nxt[b]
            if nxt[a] < n:
                prv[nxt[a]] = a
                offer(a)
            if prv[a] >= 0:
                offer(prv[a])
        out = []
        for i, c in enumerate(segment):
            if not gone[i]:
                out += [sym[i]] if 0 <= sym[i] < self.n else [self.byte_id[x] for x in c.encode("utf-8", "surrogatepass")]
        return out

    def known(self, segments: list[str]) -> list[str]:
        """The ids of each segment, joined by commas."""
        got = list(map(self.strings.get, segments))
        if None in got:
            if len(self.strings) > REMEMBERED or self.chars > REMEMBERED_CHARS:
                self._forget()
                got = [None] * len(segments)
            self.learn({s for s, k in zip(segments, got, strict=True) if k is None})
            got = list(map(self.strings.__getitem__, segments))
        return got

    def encoded(self, text: str, segments: list[str] | None = None):
        """(ids joined by commas, decoded text, number of ids, segments for which the library's ids count) of a text, a part of its segments at a time."""
        if not text:
            return
        segments = iter(segments) if segments else (m[0] for m in SEGMENT.finditer(SPACE + text.replace(" ", SPACE)))
        first = True
        while part := list(itertools.islice(segments, SEGMENTS)):
            got = self.known(part)
            back = "".join([self.decoded.get(s, s) for s in part] if self.decoded else part).replace(SPACE, " ")
            ids = ",".join(got)
            yield ids if first else "," + ids, back[1:] if first else back, ids.count(",") + 1, sum(s in self.corrected for s in part) if self.corrected else 0
            first = False


#: A run of white space with what follows; every segment starts with white space.
SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")

_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at path, read once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_corrected long, decoded string"


def encoded(docs: DataFrame, model: str, keep_text: bool = False, batch_bytes: int = 1 << 19) -> DataFrame:
    """docs (doc_id, text) to (doc_id, n_tokens, ids_sha256, decoded_sha256, n_corrected), with decoded if keep_text.

    n_corrected counts the segments for which the library's ids were taken, as the agenda's differed: none, as far as known. A null text is
    empty; the empty text has no ids. Rows stay one to one, repeated ones too;
    other columns are not read. Whole texts of any length; a text of one segment is one agenda.
    """
    from .common import gathered, in_batches, with_text

    schema = OUT if keep_text else OUT.rsplit(",", 1)[0]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        v = vocabulary(model)
        for t in gathered(batches, batch_bytes, "text"):
            # New segments of all short texts at once; those of a long text follow as it is read.
            texts = t.column("text").to_pylist()
            split = [SEGMENT.findall(SPACE + x.replace(" ", SPACE)) if 0 < len(x) < SEGMENTS else None for x in texts]
            v.known(list({s for segments in split if segments for s in segments}))
            rows = []
            for x, segments in zip(texts, split, strict=True):
                ids, decoded, n, differ, whole = hashlib.sha256(), hashlib.sha256(), 0, 0, []
                for part, back, more, off in v.encoded(x, segments):
                    ids.update(part.encode())
                    decoded.update(back.encode())
                    n, differ = n + more, differ + off
                    if keep_text:
                        whole.append(back)
                rows.append((n, ids.hexdigest(), decoded.hexdigest(), differ, "".join(whole)))
            cols = [t.column("doc_id").combine_chunks(), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string(), pa.int64())))]
            if keep_text:
                cols.append(pa.array([r[4] for r in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return in_batches(with_text(docs, "doc_id"), run, schema)
