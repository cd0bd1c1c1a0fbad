"""Texts cut off by field limits: aligned near-copies first, closing-word terminality for the rest."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.llm.wordhash import _LOWER, U, Words, mixed, text_chunks, words_of
from curatrix.session import cut_lineage

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 5, 4
#: Leading windows, in words, whose shingles are min-hashed: from the first, each a quarter longer than the one before.
FIRST_WINDOW, WINDOW_STEP = 12, 1.25
#: Words by which an aligned place may have moved across a window's edge.
SHIFT = 3
#: Lengths, in words, of the closing contexts whose continuations are counted.
ORDERS = (1, 2, 4, 7)
BEFORE = (1, 2, 4)
#: By context length: how many times the support it needs, and the share of ends below which a text is cut.
WEIGHT, LEAST_SHARE, CLOSED_WEIGHT = (10, 4, 2, 1), (0.003, 0.005, 0.01, 0.02), 4
#: Bits a member of a bit set gets, and the most bits of a set (2^29 are 64 MB), whatever the collection.
BITS_EACH, MOST_BITS = 32, 29
#: Counted contexts that a task holds before it sends them on.
FLUSH_AT = 1_000_000
#: Texts of a group that one task compares, those looked for and those tried; greater groups are split into a grid of such cells.
CELL_CUTS, CELL_WHOLES = 1024, 20_000
CLOSED, OPEN, CUT, NO_CASE, TAGS = 0, 1, 2, 3, 4
#: Outcomes of a pair below the verdicts 0 and 1: it has a place but too little in common before it (or ends there), or no place at all.
MISS, NO_PLACE = -1, -2

_rng = np.random.RandomState(71)
_A = _rng.randint(0, 1 << 31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_windows = [FIRST_WINDOW]
while _windows[-1] < 1 << 26:
    _windows.append(int(_windows[-1] * WINDOW_STEP))
WINDOWS = np.array(_windows)
#: The signs that a text may be cut after, by the bytes that are counted.
SIGNS = (",", ";", ":", "(", "[", "{", "/", "&", "+", "=", "<", "\\", "-", "\u2013", "\u2014", "\u2010", "\u00ad", "\ufffd")

#: Marks that follow a text which goes on elsewhere, and openings of refusals.
_MARK = re.compile(r"(?:\s*(?:\.{2,}|…|\[(?:\.{2,}|…|truncated|continued|more|cut)\]|\((?:\.{2,}|…|more|continued|truncated|cont\.?)\)|>{2,}|»»))+\s*$", re.I)
_REFUSAL = re.compile(r"\s*[\"“']?(?:i['’]?m sorry|sorry,|i am sorry|i (?:cannot|can['’]?t|can not|am unable|am not able|won['’]?t)\b|as an ai\b|unable to (?:describe|comply|assist))", re.I)
_TAIL = " \t\n\r\x0b\x0c\u00a0\u2002\u2003\u2009\u200b\u3000\ufeff\"'”’»"
_ASIDE = re.compile(r"\s*[(\[][^()\[\]]{1,60}[)\]]\s*$")
_BROKEN = re.compile(r"(?:�+|&#?\w{0,8}|<[^<>]{0,60}|\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)?|(?<=\w)[-\u00ad\u2010]|[,;:(\[{/&+=–—]|\s-)$")


def closing(text: str) -> tuple[int, int]:
    """(state, end): CLOSED, OPEN or CUT by the marks at the end alone, and where the words end."""
    s = text.rstrip(_TAIL)
    if not s:
        return NO_CASE, 0
    if len(s) < 400 and _REFUSAL.match(s):
        return NO_CASE, len(s)
    marked = _MARK.search(s, max(0, len(s) - 60))
    if marked:
        s = s[: marked.start()].rstrip(_TAIL)
        if s.endswith((".", "!", "?")):
            return CLOSED, len(s)
        return _open_or_cut(s)
    aside = _ASIDE.search(s, max(0, len(s) - 80))
    if aside:
        t = s[: aside.start()].rstrip(_TAIL)
        if t.endswith((".", "!", "?")):
            return CLOSED, len(t)
    if s.endswith((".", "!", "?")):
        return CLOSED, len(s)
    return _open_or_cut(s)


def sign_of(tail: str) -> int:
    """The number of the sign that a cut text's tail begins with, -1 for one that isn't listed."""
    return next((i for i, sign in enumerate(SIGNS) if tail.startswith(sign)), -1)


def _open_or_cut(s: str) -> tuple[int, int]:
    broken = _BROKEN.search(s, max(0, len(s) - 70))
    return (CUT, broken.start()) if broken else (OPEN, len(s))


def _cumulative(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


class Events:
    """Per word of a batch: does a sentence (in a list of tags: a tag) end after it, or does it go on."""

    def __init__(self, w: Words):
        d = w.data
        stop = _cumulative((d == 46) | (d == 33) | (d == 63))
        comma = _cumulative(d == 44)
        n = len(w.hash)
        last = np.zeros(n, bool)
        has = w.past > w.first
        last[w.past[has] - 1] = True
        until = np.empty(n, np.int64)
        until[:-1] = w.start[1:]
        until[last] = w.text_end[w.text[last]]
        stops = stop[until] - stop[w.end]
        next_byte = d[np.minimum(until, len(d) - 1)] if len(d) else np.zeros(n, np.uint8)
        upper = ((next_byte >= 65) & (next_byte <= 90)) | (next_byte >= 128)
        gap = until - w.end
        ends = (stops == 1) & (last | (upper & (gap > 1)))
        self.stops = stops > 0
        unclear = (stops > 1) | (last & ~ends)
        done = np.where(has, w.end[np.maximum(w.past - 1, 0)] if n else 0, w.text_start)
        per_text_stop = stop[done] - stop[w.text_start]
        per_text_comma = comma[w.text_end] - comma[w.text_start]
        count = w.past - w.first
        #: A list of tags has no stop before its last word and at most five words to a comma.
        self.tags = (per_text_comma >= 2) & (per_text_stop == 0) & (count <= 5 * (per_text_comma + 1))
        in_tags = self.tags[w.text]
        tag_end = ~last & (comma[until] > comma[w.end])
        self.end = np.where(in_tags, tag_end, ends)
        self.on = ~last & ~self.end & ~unclear
        following = np.zeros(n, bool)
        following[:-1] = self.end[1:]
        self.next_ends = following & ~last
        self.salt = in_tags.astype(np.uint64)


def _words_end(text: str, k: int) -> int:
    """Bytes of the first ``k`` characters."""
    return k if text.isascii() else len(text[:k].encode())


class Windows:
    """Min-hash bands over the leading windows of a batch's texts, and the keys of their closings.

    Near-copies are looked for by how they begin: the bands of a window's five-word shingles, for every
    window shorter than the text. The key of a place joins the band of the greatest window before it, the
    five words before the place (which the alignment needs anyway) and the first byte of its word.
    """

    def __init__(self, w: Words, anchor: np.ndarray):
        self.w, self.anchor = w, anchor
        count = w.past - w.first
        self.n = np.searchsorted(WINDOWS, count - 1, side="right")
        self.has = np.nonzero(self.n)[0]
        self.row = np.full(len(count), -1, np.int64)
        self.row[self.has] = np.arange(len(self.has))
        if not len(self.has):
            return
        n = self.n[self.has]
        row_of = np.repeat(np.arange(len(n)), n + 1)
        j = np.arange(len(row_of)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1)
        starts = w.first[self.has][row_of] + np.where(j == 0, SHINGLE - 1, WINDOWS[np.maximum(j - 1, 0)])
        inner = j < n[row_of]  # the last piece only ends the one before
        at = (row_of[inner], j[inner])
        width = int(n.max())
        size = ((np.arange(width) + 1).astype(U) * U(0x9E3779B97F4A7C15))[None, :]
        self.bands = []
        high, low = (self.anchor >> U(32)).astype(np.uint32), self.anchor.astype(np.uint32)
        x = np.empty_like(high)
        for band in range(BANDS):
            acc = np.broadcast_to(size + U(band), (len(n), width))
            for r in range(band * ROWS, (band + 1) * ROWS):
                np.multiply(high, _A[r], out=x)  # 32-bit min-hash: odd multiple of one half plus the other
                np.add(x, low, out=x)
                least = np.full((len(n), width), 0xFFFFFFFF, np.uint32)
                least[at] = np.minimum.reduceat(x, starts)[inner]
                acc = mixed(acc ^ np.minimum.accumulate(least, axis=1).astype(U)) + U(r)
            self.bands.append(acc)

    def keys(self, places: np.ndarray, window: np.ndarray) -> list[np.ndarray]:
        """The keys of words at ``places``, by band, with the given window of their text."""
        row = self.row[self.w.text[places]]
        lead = _LOWER[self.w.data[self.w.start[places]]].astype(U) * U(0xD6E8FEB86659FD93)
        return [mixed(self.anchor[places - 1] + b[row, window] + lead) for b in self.bands]


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def sign_key(sign: int) -> int:
    """The key under which a sign's occurrences are counted; far from the hashes of contexts by chance only."""
    return -(1 << 62) - sign


_FEATURES = "uid long, copy long, state int, sign int, words long, closes array<long>, before array<long>, anchor long, keys array<long>, last long"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: state, closing sign, hash of all words, closing contexts, contexts before the last word, keys of the closing."""
    for batch in batches:
        for lo, hi, data, offsets in text_chunks(batch.column(1)):
            rows = hi - lo
            texts = batch.column(1).slice(lo, rows).to_pylist()
            state = np.full(rows, NO_CASE, np.int32)
            sign = np.full(rows, -1, np.int32)
            ends = offsets[:-1].copy()
            for i, t in enumerate(texts):
                if t:
                    state[i], k = closing(t)
                    if state[i] == CUT:
                        sign[i] = sign_of(t[k:].lstrip())
                    ends[i] += _words_end(t, k)
            w = words_of(data, offsets[:-1], ends)
            e = Events(w)
            count = w.past - w.first
            state[count == 0] = NO_CASE
            state[((state == OPEN) | (state == CLOSED)) & e.tags] = TAGS
            closes = np.full((rows, len(ORDERS)), 0, np.int64)
            known = np.zeros((rows, len(ORDERS)), bool)
            before = np.zeros((rows, len(BEFORE)), np.int64)
            before_known = np.zeros((rows, len(BEFORE)), bool)
            for j, order in enumerate(ORDERS):
                h, _ = w.context(order, e.salt)
                ok = count >= order
                closes[ok, j] = _signed(h[w.past[ok] - 1])
                known[:, j] = ok
                if order in BEFORE:
                    b = BEFORE.index(order)
                    ok = count > order
                    before[ok, b] = _signed(h[w.past[ok] - 2])
                    before_known[:, b] = ok
            near = Windows(w, w.context(SHINGLE)[0])
            keys = np.zeros((rows, BANDS), np.int64)
            anchor = np.zeros(rows, np.int64)
            last = np.zeros(rows, np.int64)
            if len(near.has):
                closing_at = w.past[near.has] - 1
                for b, k in enumerate(near.keys(closing_at, near.n[near.has] - 1)):
                    keys[near.has, b] = _signed(k)
                anchor[near.has] = _signed(near.anchor[closing_at - 1])
                last[near.has] = _signed(w.hash[closing_at])
            place = np.arange(len(w.hash)) - w.first[w.text]
            whole = np.zeros(rows, U)
            full = np.nonzero(count)[0]
            if len(full):
                whole[full] = np.add.reduceat(mixed(w.hash + place.astype(U)), w.first[full])
            lists = lambda m, ok: pa.array([[int(v) if k else None for v, k in zip(r, q)] for r, q in zip(m.tolist(), ok.tolist())], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, rows),
                    batch.column(2).slice(lo, rows),
                    pa.array(state),
                    pa.array(sign),
                    pa.array(_signed(whole)),
                    lists(closes, known),
                    lists(before, before_known),
                    pa.array(anchor),
                    pa.array([k if n else [] for k, n in zip(keys.tolist(), near.n.tolist())], pa.list_(pa.int64())),
                    pa.array(last),
                ],
                names=["uid", "copy", "state", "sign", "words", "closes", "before", "anchor", "keys", "last"],
            )


class BitSet:
    """A bit set of hashes whose size follows their number up to 2^MOST_BITS bits: beyond, it only keeps more that is not in it."""

    def __init__(self, hashes: DataFrame, n: int, probes: int = 1):
        """``hashes`` is (h long), about ``n`` rows; each sets ``probes`` bits."""
        self.probes = probes
        bits = min(MOST_BITS, max(16, int(np.ceil(np.log2(max(1, n) * BITS_EACH)))))
        mask = (1 << bits) - 1
        slots = F.array(*[F.shiftrightunsigned("h", 24 * i).bitwiseAND(mask) for i in range(probes)])
        spread = hashes.select(F.explode(slots).alias("slot")).select(F.shiftright("slot", 16).cast("int").alias("chunk"), F.col("slot").bitwiseAND(0xFFFF).cast("int").alias("bit"))

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunks: dict[int, np.ndarray] = {}
            for batch in batches:
                of, bit = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                order = np.argsort(of, kind="stable")
                of, bit = of[order], bit[order]
                edges = np.concatenate([[0], np.nonzero(np.diff(of))[0] + 1, [len(of)]])
                for lo, hi in zip(edges[:-1], edges[1:]):
                    if hi > lo:
                        chunks.setdefault(int(of[lo]), np.zeros(1 << 16, bool))[bit[lo:hi]] = True
            packed = [np.packbits(c, bitorder="little").tobytes() for c in chunks.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.int32()), pa.array(packed, pa.binary())], names=["chunk", "bits"])

        got = spread.repartition("chunk").mapInArrow(fill, "chunk int, bits binary").toArrow()
        raw = np.zeros(1 << (bits - 3), np.uint8)
        for chunk, packed in zip(got["chunk"].to_pylist(), got["bits"].to_pylist()):
            raw[chunk << 13 : (chunk + 1) << 13] |= np.frombuffer(packed, np.uint8)
        self.mask, self.held = mask, hashes.sparkSession.sparkContext.broadcast(raw.tobytes())

    def __getstate__(self) -> dict:
        return {"probes": self.probes, "mask": self.mask, "held": self.held}

    def has(self, h: np.ndarray) -> np.ndarray:
        bits = np.frombuffer(self.held.value, U)
        out = np.ones(len(h), bool)
        for i in range(self.probes):
            slot = (h >> U(24 * i)) & U(self.mask)
            out &= ((bits[(slot >> U(6)).astype(np.int64)] >> (slot & U(63))) & U(1)).astype(bool)
        return out


_CONTEXT, _PLACE = 0, 1
_CONTINUATIONS = "kind int, h long, x long, a long, b long, c long"


def _rows(kind: int, h, x, a, b, c) -> pa.RecordBatch:
    n = len(h)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *(pa.array(np.asarray(v, np.int64)) for v in (h, x, a, b, c))], names=["kind", "h", "x", "a", "b", "c"])


def _continuations(contexts: BitSet, anchors: BitSet, keys: BitSet):
    """Two kinds of rows of every text (uid, text), for one aggregation by (kind, h, x).

    Contexts (x = 0): how often one that closes some text ends a sentence, goes on, or ends one a word later;
    and how often each sign stands inside a text. Places: where a text goes on after words that close another
    one: h is the key, x all of the text that an alignment at the place depends on, a the uid, b what stands at
    the place and before it, c the word there if a stop follows it, else 0. b and c are the same for the same h and x.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def combined() -> pa.RecordBatch:
            h = np.concatenate([x[0] for x in held])
            keys_, where = np.unique(h, return_inverse=True)
            sums = [np.bincount(where, np.concatenate([x[i] for x in held]), len(keys_)) for i in (1, 2, 3)]
            held.clear()
            return _rows(_CONTEXT, _signed(keys_), np.zeros(len(keys_)), *sums)

        inner = np.zeros(len(SIGNS), np.int64)
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                uids = batch.column(0).slice(lo, hi - lo).to_numpy()
                ends_at = offsets[1:].copy()
                for i, t in enumerate(batch.column(1).slice(lo, hi - lo).to_pylist()):
                    if t and (not t.endswith(".") or t.endswith("..")):  # marks after the text are no words of it
                        ends_at[i] = offsets[i] + _words_end(t, closing(t)[1])
                w = words_of(data, offsets[:-1], ends_at)
                e = Events(w)
                seen = e.end | e.on
                for order in ORDERS:
                    h, inside = w.context(order, e.salt)
                    at = np.nonzero(inside & seen)[0]
                    at = at[contexts.has(h[at])]
                    held.append((h[at], e.end[at], e.on[at], e.next_ends[at]))
                    size += len(at)
                raw = data.tobytes()
                for i, sign in enumerate(SIGNS):
                    inner[i] += raw.count(sign.encode())
                if size >= FLUSH_AT:
                    yield combined()
                    size = 0
                yield from _places(w, e, uids, anchors, keys)
        if held:
            yield combined()
        if inner.any():
            yield _rows(_CONTEXT, [sign_key(i) for i in range(len(SIGNS))], np.zeros(len(SIGNS)), np.zeros(len(SIGNS)), inner, np.zeros(len(SIGNS)))

    return run


def _places(w: Words, e: Events, uids: np.ndarray, anchors: BitSet, keys: BitSet) -> Iterator[pa.RecordBatch]:
    k = np.arange(len(w.hash)) - w.first[w.text]
    at = np.nonzero(k >= FIRST_WINDOW)[0]
    anchor, _ = w.context(SHINGLE)
    at = at[anchors.has(anchor[at - 1])]
    # Of the places after the same words an alignment takes the nearest, so where they recur the rest of the text counts too.
    same = mixed(anchor[at - 1] + w.text[at].astype(U) * U(0x9E3779B97F4A7C15))
    order = np.argsort(same, kind="stable")
    recurs = np.zeros(len(at), bool)
    recurs[order[:-1]] = same[order[:-1]] == same[order[1:]]
    inner = at < w.past[w.text[at]] - 1
    at, recurs = at[inner], recurs[inner]
    if not len(at):
        return
    near = Windows(w, anchor)
    own = np.searchsorted(WINDOWS, k[at], side="right") - 1
    following = w.start[at + 1]
    b = _signed(w.span(w.end[at - SHINGLE - 1], following))
    c = _signed(np.where(e.stops[at], w.hash[at], U(0)))
    x = _signed(w.span(w.text_start[w.text[at]], np.where(recurs, w.text_end[w.text[at]], following)))
    for shift in (0, -SHIFT, SHIFT):
        window = np.searchsorted(WINDOWS, k[at] + shift, side="right") - 1
        ok = (window >= 0) & (window < near.n[w.text[at]]) & ((shift == 0) | (window != own))
        if not ok.any():
            continue
        places = at[ok]
        for h in near.keys(places, window[ok]):
            hit = keys.has(h)
            if hit.any():
                yield _rows(_PLACE, _signed(h[hit]), x[ok][hit], uids[w.text[places[hit]]], b[ok][hit], c[ok][hit])


_TOKEN = re.compile(r"[^\W_]+")


def _read(text: str) -> tuple[str, list[str]]:
    """A text in lower case without the marks after it, and its words."""
    text = text[: closing(text)[1]].lower()
    return text, _TOKEN.findall(text)


def _shingles(words: list[str]) -> Iterator[tuple[str, ...]]:
    return zip(*(words[i:] for i in range(SHINGLE)))


class Cut:
    """A text looked for in longer ones; ``ids`` numbers the shingles of all texts that are looked for together."""

    def __init__(self, text: str, ids: dict[tuple[str, ...], int]):
        words = _read(text)[1]
        self.n, self.last = len(words), words[-1] if words else ""
        self.anchor = tuple(words[-SHINGLE - 1 : -1])
        self.shingles = {ids.setdefault(s, len(ids)) for s in _shingles(words[:-1])}


class Whole:
    """A text in which others are looked for; what several of them need is made once."""

    def __init__(self, text: str, ids: dict[tuple[str, ...], int]):
        self.text, self.words = _read(text)
        self.ids = ids
        self._places: dict[tuple[str, ...], list[int]] = {}
        self._upto: dict[int, tuple[int, set[int]]] = {}

    def places(self, anchor: tuple[str, ...]) -> list[int]:
        """The words that stand after those of ``anchor``."""
        if anchor not in self._places:
            w, a = self.words, list(anchor)
            self._places[anchor] = [j + SHINGLE for j in range(len(w) - SHINGLE) if w[j] == a[0] and w[j : j + SHINGLE] == a]
        return self._places[anchor]

    def upto(self, k: int) -> tuple[int, set[int]]:
        """How many shingles stand before word ``k``, and the numbers of those that are looked for."""
        if k not in self._upto:
            found = set(_shingles(self.words[:k]))
            self._upto[k] = len(found), {self.ids[s] for s in found if s in self.ids}
        return self._upto[k]


def compare(cut: Cut, whole: Whole) -> int:
    """1: ``cut`` stops early inside a sentence of ``whole``; 0: at one's end; else MISS or NO_PLACE."""
    last, wb = cut.last, whole.words
    if cut.n < SHINGLE + 1:
        return NO_PLACE
    places = [k for k in whole.places(cut.anchor) if wb[k].startswith(last)]
    if not places:
        return NO_PLACE
    k = min(places, key=lambda k: abs(k + 1 - cut.n))
    if wb[k] == last and k + 1 == len(wb):
        return MISS
    m = len(cut.shingles)
    if k - SHINGLE + 1 < SIMILARITY * m:  # no more than these can be common
        return MISS
    n, known = whole.upto(k)
    if min(m, n) < SIMILARITY * max(m, n):
        return MISS
    common = len(cut.shingles & known)
    if common < SIMILARITY * (m + n - common):
        return MISS
    if wb[k] != last:
        return 1
    spans = [m.span() for m in _TOKEN.finditer(whole.text)]
    return 0 if re.search(r"[.!?]", whole.text[spans[k][1] : spans[k + 1][0]]) else 1


def align(cut: str, whole: str) -> int | None:
    """1: ``cut`` stops early inside a sentence of ``whole``; 0: at one's end; None: no near-copy or no verdict.

    Marks after either text are no words of it. The words before the last must stand in ``whole``; compared are the shingles up to there, as a cut copy
    holds only the beginning of its sibling.
    """
    ids: dict[tuple[str, ...], int] = {}
    verdict = compare(Cut(cut, ids), Whole(whole, ids))
    return verdict if verdict >= 0 else None


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, longer, verdict) of pairs (uid, longer, text, longer's text)."""
    for batch in batches:
        v = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            ids: dict[tuple[str, ...], int] = {}
            v.append(compare(Cut(a, ids), Whole(b, ids)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(v, pa.int32())], names=["uid", "longer", "verdict"])


class Search:
    """The texts of a cell that still need a verdict; ``found`` has (uid, verdict)."""

    def __init__(self):
        self.ids: dict[tuple[str, ...], int] = {}
        self.uids: list[int] = []
        self.needs: list[int] = []
        self.cuts: list[Cut] = []
        self.found: list[tuple[int, int]] = []
        self.ready = False

    def add(self, uid: int, need: int, text: str) -> None:
        self.uids.append(uid)
        self.needs.append(need)
        self.cuts.append(Cut(text, self.ids))

    def _index(self) -> None:
        """By shingle: the texts that have it."""
        of = np.repeat(np.arange(len(self.cuts)), [len(c.shingles) for c in self.cuts])
        shingle = np.array([s for c in self.cuts for s in c.shingles], np.int64)
        self.holders = np.split(of[np.argsort(shingle, kind="stable")], np.cumsum(np.bincount(shingle, minlength=len(self.ids)))[:-1])
        self.sizes = np.bincount(of, minlength=len(self.cuts))
        self.open = np.ones(len(self.cuts), bool)
        self.anchors = {c.anchor for c in self.cuts}
        self.ready = True

    def against(self, uid: int, text: str) -> None:
        """Compare with a text those that have enough in common with what stands before one of its places."""
        if not self.ready:
            self._index()
        if not self.open.any():
            return
        whole = Whole(text, self.ids)
        near = np.zeros(len(self.cuts), bool)
        for k in {k for anchor in self.anchors for k in whole.places(anchor)}:
            n, known = whole.upto(k)
            if known:
                common = np.bincount(np.concatenate([self.holders[s] for s in known]), minlength=len(self.cuts))
                near |= common >= SIMILARITY * (self.sizes + n - common)
        for i in np.nonzero(near & self.open)[0]:
            verdict = compare(self.cuts[i], whole) if self.uids[i] != uid else MISS
            if verdict >= 0:
                self.found.append((self.uids[i], verdict))
            self.open[i] = verdict < self.needs[i]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, verdict) of cells (key, follows, i, j, side, need, uid, text): each text of side 0 against those of side 1, until it has the verdict it needs.

    The rows of a cell follow each other, those of side 0 first; the others pass through one at a time.
    """
    cell, search = None, Search()
    for batch in batches:
        found: list[tuple[int, int]] = []
        for *at, side, need, uid, text in zip(*(c.to_pylist() for c in batch.columns)):
            if at != cell:
                found += search.found
                cell, search = at, Search()
            if side == 0:
                search.add(uid, need, text)
            elif search.cuts:
                search.against(uid, text)
        found += search.found
        search.found = []
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int32())], names=["uid", "verdict"])


def closing_keys(cases: DataFrame) -> DataFrame:
    """(key, uid, last): the keys of every distinct text's closing; of exact copies the smallest uid."""
    distinct = cases.where(F.size("keys") > 0).groupBy("copy", "words").agg(F.min(F.struct("uid", "keys", "last")).alias("t"))
    return distinct.select(F.explode("t.keys").alias("key"), "t.uid", "t.last")


def partners_of(keys: DataFrame, places: DataFrame) -> DataFrame:
    """(key, follows, ends, uid): the texts that go on, or end inside another word, where others with that key close.

    ``places`` is (key, follows, ends, uid), a row for all texts that are the same as far as an alignment at the place
    goes. Texts with as many words, of which one ends inside the last word of another, are found among the closings.
    """
    several = keys.groupBy("key").agg(F.min("last").alias("l"), F.max("last").alias("m")).where(F.col("l") != F.col("m")).select("key")
    level = keys.join(several, "key").select("key", F.col("last").alias("follows"), F.lit(0).cast("long").alias("ends"), "uid")
    return places.select("key", "follows", "ends", "uid").unionByName(level)


def groups_met(keys: DataFrame, partners: DataFrame) -> DataFrame:
    """(uid, last, key, follows, ends, low, high, members): the groups of partners that go on alike, for every text whose closing has their key."""
    groups = partners.groupBy("key", "follows").agg(
        F.max("ends").alias("ends"), F.min("uid").alias("low"), F.max("uid").alias("high"), F.count(F.lit(1)).alias("members")
    )
    return keys.join(groups, "key").where(F.col("follows") != F.col("last"))


def candidate_pairs(met: DataFrame) -> DataFrame:
    """(uid, longer): every text with the smallest and the greatest partner of each of its groups.

    Most texts have their verdict after these, so a group of copies costs a row per copy, not one per pair;
    ``left_open`` has what they leave open.
    """
    pairs = met.select("uid", F.explode(F.array_distinct(F.array("low", "high"))).alias("longer"))
    return pairs.where(F.col("uid") != F.col("longer")).distinct()


def verified(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """(uid, longer, verdict) of all pairs, of the texts ``held``."""
    both = pairs.join(held, "uid").select("uid", F.col("text").alias("short_text"), "longer")
    both = both.join(held.select(F.col("uid").alias("longer"), F.col("text").alias("long_text")), "longer")
    return both.select("uid", "longer", "short_text", "long_text").mapInArrow(_compared, "uid long, longer long, verdict int")


def left_open(met: DataFrame, tried: DataFrame) -> DataFrame:
    """(uid, key, follows, members, need): the groups that may still change a text's verdict, need being the verdict they can give.

    The partners of a group stand for one verdict, as the same word and the same sign follow; one inside a sentence
    outweighs a sentence end. If the word at the place is not the text's, it is that of no partner of the group.
    """
    best = tried.groupBy("uid").agg(F.max("verdict").alias("best"))
    need = F.when(F.col("ends") == F.col("last"), 0).otherwise(1)
    out = met.where(F.col("members") > 2).withColumn("need", need).join(best, "uid", "left").where(F.coalesce("best", F.lit(MISS)) < F.col("need"))
    for side in ("low", "high"):
        out = out.join(tried.where(F.col("verdict") == NO_PLACE).select("uid", F.col("longer").alias(side)), ["uid", side], "left_anti")
    return out.select("uid", "key", "follows", "members", "need")


def searched(held: DataFrame, rest: DataFrame, partners: DataFrame) -> DataFrame:
    """(uid, verdict): every text of ``rest`` with all partners of its groups, until one gives the verdict the group stands for.

    A group is a grid of cells with so many texts of either side at most; no pair becomes a row.
    """
    blocks = lambda n, size: F.ceil(F.col(n) / size).cast("int")
    block = lambda n: F.pmod(F.xxhash64("uid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    grid = rest.groupBy("key", "follows").agg(F.count(F.lit(1)).alias("cuts"), F.max("members").alias("members"))
    grid = grid.select("key", "follows", blocks("cuts", CELL_CUTS).alias("rows"), blocks("members", CELL_WHOLES).alias("columns"))
    cuts = rest.join(grid, ["key", "follows"]).select("key", "follows", block("rows").alias("i"), every("columns").alias("j"), F.lit(0).alias("side"), "need", "uid")
    wholes = partners.select("key", "follows", "uid").distinct().join(grid, ["key", "follows"])
    wholes = wholes.select("key", "follows", every("rows").alias("i"), block("columns").alias("j"), F.lit(1).alias("side"), F.lit(0).alias("need"), "uid")
    cell = ["key", "follows", "i", "j"]
    rows = cuts.unionByName(wholes).join(held, "uid").select(*cell, "side", "need", "uid", "text")
    return rows.repartition(*cell).sortWithinPartitions(*cell, "side").mapInArrow(_searched, "uid long, verdict int")


def pair_verdicts(texts: DataFrame, cases: DataFrame, keys: DataFrame, places: DataFrame) -> DataFrame:
    """(uid, pair_cut) of the texts that align with a longer near-copy, exact copies included.

    A text that aligns with none of the texts that have a key in common with it has no verdict here and is
    scored by terminality like any unmatched one.
    """
    partners = cut_lineage(partners_of(keys, places))
    met = cut_lineage(groups_met(keys, partners))
    pairs = cut_lineage(candidate_pairs(met))
    great = partners.join(met.where(F.col("members") > 2).select("key", "follows").distinct(), ["key", "follows"], "left_semi")
    needed = pairs.select("uid").union(pairs.select("longer")).union(great.select("uid")).distinct()
    held = cut_lineage(texts.join(needed, "uid", "left_semi").select("uid", "text"))
    tried = cut_lineage(verified(held, pairs))
    rest = cut_lineage(left_open(met, tried))
    found = tried.select("uid", "verdict")
    if not rest.isEmpty():
        found = found.union(searched(held, rest, partners))
    found = found.where(F.col("verdict") >= 0).groupBy("uid").agg(F.max("verdict").alias("pair_cut"))
    copies = cases.select("uid", "copy", "words").join(found, "uid").select("copy", "words", "pair_cut")
    return cases.select("uid", "copy", "words").join(copies, ["copy", "words"]).select("uid", "pair_cut")


def closings_of(features: DataFrame) -> DataFrame:
    """(closing, closes, before, state, sign, own): every distinct closing and the mean number of exact copies."""
    first = [F.first(c).alias(c) for c in ("closes", "before", "state", "sign")]
    per_text = features.groupBy("closing", "words").agg(*first, F.count(F.lit(1)).alias("copies"))
    return per_text.groupBy("closing").agg(*first, F.avg("copies").alias("own"), F.count(F.lit(1)).alias("texts"))


def contexts_of(closings: DataFrame) -> DataFrame:
    """(closing, k, h): the contexts of every closing."""
    return closings.select("closing", F.posexplode(F.concat("closes", "before")).alias("k", "h")).where(F.col("h").isNotNull())


def terminality(closings: DataFrame, counts: DataFrame, support: int = 4) -> DataFrame:
    """(closing, closing_cut) per distinct closing: does a text with these last words stop too early?

    Over all texts it is counted how often each closing context (the last 1, 2, 4 and 7 words, and the 1,
    2 and 4 before the last) ends a sentence, ends one a word later, or goes on. A text's own stop is no
    evidence for it, nor are its exact copies'. In turn:
    1. The words before the last are common and no sentence ends one word after them: cut.
    2. The last word is never met inside a sentence: a piece of a word. Without a stop it is cut unless
       it is a usual continuation (in a list of tags only if the tags before it are known), with a stop if
       sentences hardly end one word after the words before.
    3. The longest context with enough other events decides: cut below a least share of ends.
    Shorter contexts need more events (``support`` times WEIGHT) and a smaller share (LEAST_SHARE), as they
    mix several phrases. A text closed by a stop is rarely cut, so it takes CLOSED_WEIGHT times the events.
    """
    contexts = contexts_of(closings)
    event = F.struct(*[F.coalesce(x, F.lit(0)).alias(x) for x in ("e", "c", "ne")])
    found = contexts.join(counts, "h", "left").groupBy("closing").agg(F.map_from_entries(F.collect_list(F.struct("k", event))).alias("m"))
    # Signs are few: how many texts end after each, and how often it stands inside one.
    at_end = closings.where(F.col("sign") >= 0).groupBy("sign").agg(F.sum("texts").alias("sign_ends"))
    signs = at_end.withColumn("h", -F.lit(1 << 62) - F.col("sign")).join(counts.select("h", F.col("c").alias("sign_on")), "h", "left").drop("h")
    x = closings.select("closing", "state", "own", "sign").join(found, "closing", "left").join(signs, "sign", "left")
    own = F.when(F.col("state") == CLOSED, F.col("own")).otherwise(0)
    at = lambda k, f: F.coalesce(F.col("m")[k][f], F.lit(0))
    ends = lambda k: F.greatest(at(k, "e") - own, F.lit(0))
    decided = F.lit(None).cast("boolean")
    weight = F.when(F.col("state") == CLOSED, support * CLOSED_WEIGHT).otherwise(support)
    for k, _ in enumerate(ORDERS):  # the longest with support comes last and so outermost
        total = ends(k) + at(k, "c")
        decided = F.when(total >= weight * WEIGHT[k], ends(k) < LEAST_SHARE[k] * total).otherwise(decided)
    one_before, two, four = range(len(ORDERS), len(ORDERS) + len(BEFORE))
    before = lambda k: at(k, "e") + at(k, "c")
    next_ends = lambda k: F.greatest(at(k, "ne") - own, F.lit(0))
    inside = F.when(before(four) >= 5 * weight, next_ends(four) < 0.01 * before(four)).otherwise(
        (before(two) >= 12 * weight) & (next_ends(two) < 0.003 * before(two))
    )
    next_share = F.when(before(four) >= support, next_ends(four) / before(four)).when(before(two) >= support, next_ends(two) / before(two))
    unseen = at(0, "c") + F.when(F.col("state") == TAGS, at(0, "e")).otherwise(0) < 2
    usual = (ends(0) >= support) & (ends(1) + at(1, "c") >= 0.01 * before(two))
    piece = F.when(F.col("state") == CLOSED, F.coalesce(next_share < 0.05, F.lit(False))).otherwise(
        ~usual & ((F.col("state") != TAGS) | (before(one_before) >= support))
    )
    on = F.greatest(F.coalesce("sign_on", F.lit(0)) - F.coalesce("sign_ends", F.lit(0)), F.lit(0))
    never = (on < 5 * support) | (F.col("sign_ends") < LEAST_SHARE[0] * (F.col("sign_ends") + on)) | (F.col("sign") < 0)
    verdict = (
        F.when((F.col("state") == CUT) & F.coalesce(never, F.lit(True)), True)
        .when((F.col("state") != TAGS) & inside, True)
        .when(unseen & ((F.col("state") != CLOSED) | ~usual), piece)
        .otherwise(F.coalesce(decided, F.lit(False)))
    )
    return x.select("closing", verdict.alias("closing_cut"))


def truncated(texts: DataFrame) -> DataFrame:
    """(uid, cut, how) of every text of (uid long, text string); how: aligned, words or none.

    Empty, blank and refusing texts are no cases (cut false, how none); null ones give no row. uid must be
    unique; repeated texts are judged each. An empty table gives an empty result.
    """
    texts = texts.select("uid", "text")
    features = texts.where(F.col("text").isNotNull()).select("uid", "text", F.xxhash64("text").alias("copy")).mapInArrow(_features, _FEATURES)
    features = cut_lineage(features.withColumn("closing", F.xxhash64("state", "sign", "closes", "before")))
    cases = features.where(F.col("state") != NO_CASE)
    keys = cut_lineage(closing_keys(cases))
    closings = cut_lineage(closings_of(cases))
    n_keys, n_closings = keys.count(), closings.count()
    filters = (
        BitSet(contexts_of(closings).select("h"), n_closings * (len(ORDERS) + len(BEFORE))),
        BitSet(cases.where(F.size("keys") > 0).select(F.col("anchor").alias("h")), n_keys // BANDS),
        BitSet(keys.select(F.col("key").alias("h")), n_keys, 2),
    )
    rows = texts.mapInArrow(_continuations(*filters), _CONTINUATIONS).groupBy("kind", "h", "x")
    sums = [F.sum(F.when(F.col("kind") == _CONTEXT, F.col(x))).alias(x) for x in ("a", "b", "c")]
    rows = cut_lineage(rows.agg(*sums, F.min("a").alias("uid"), F.max("b").alias("follows"), F.max("c").alias("ends")))
    counts = rows.where(F.col("kind") == _CONTEXT).select("h", F.col("a").alias("e"), F.col("b").alias("c"), F.col("c").alias("ne"))
    places = rows.where(F.col("kind") == _PLACE).select(F.col("h").alias("key"), "follows", "ends", "uid")
    pairs = pair_verdicts(texts, cases, keys, places)
    judged = terminality(closings, counts).join(cases.select("uid", "closing"), "closing")
    joined = features.select("uid", "state").join(judged.select("uid", "closing_cut"), "uid", "left").join(pairs, "uid", "left")
    cut = F.when(F.col("pair_cut").isNotNull(), F.col("pair_cut") == 1).otherwise(F.coalesce("closing_cut", F.lit(False)))
    how = F.when(F.col("state") == NO_CASE, "none").when(F.col("pair_cut").isNotNull(), "aligned").otherwise("words")
    return joined.select("uid", cut.alias("cut"), how.alias("how"))


def source_shares(judged: DataFrame, source: Column) -> DataFrame:
    """Texts and cut texts per text column and source."""
    return judged.groupBy("text_column", source.alias("source")).agg(
        F.count(F.lit(1)).alias("texts"), F.count_if("cut").alias("cut_texts"), (F.count_if("cut") / F.count(F.lit(1))).alias("cut_share")
    )
