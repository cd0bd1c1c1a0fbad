"""Keyword-stuffed and link-list pages: repeated maximal substrings of each page outside its clauses."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.session import cut_lineage

#: A repeated run of words counts from so many occurrences that make up this share of the page's words.
AT_LEAST, DENSITY = 3, 0.03
#: A clause word stands in sentences of this share of all pages, at this multiple of the usual odds.
DOC_SHARE, LIFT = 0.005, 0.75
#: The share of clause words, outside repeats, from which a unit is a clause.
CLAUSE_SHARE = 0.5
#: Words of pages that a task counts before it empties its table.
FLUSH_AT = 200_000

_WORD = re.compile(r"[^\W_]+")
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_META = re.compile(r"<meta\b[^<>]*>")
_CONTENT = re.compile(r"""\bcontent\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_MARKUP = re.compile(r"<[^<>]*>|&[a-z#0-9]{2,8};")
_LINK = re.compile(
    r"<a\b[^<>]*>[^<>]*</a>|\[url=[^\[\]]*\][^\[\]]*\[/url\]|\[[^\[\]]*\]\((?:https?:|www\.)[^()\s]*\)"
    r"|\b(?:https?://|www\.)\S+|(?<![a-z0-9.-])[a-z0-9][a-z0-9-]*+(?:\.[a-z0-9-]++)*\.[a-z]{2,12}/\S*|#\w[\w'’&-]*"
)
#: What every link and tag contains; a page without it needs no closer look for them.
_LINK_HINT = re.compile(r"://|www\.|<a\b|\[url=|\]\(|#\w|\.[a-z]{2,12}/")
#: Ends of units; the leading set of characters lets the search skip all others.
_UNIT = re.compile(r"[.!?…\n\r|>·•/;](?:(?<=[.!?…])[\"'”»)]*(?:\s+|$)|(?<=[\n\r])[\n\r]*|(?<=\s[|>·•/;])\s)")
_SIGN = re.compile("(?P<word>[^\\W_]+)|(?P<link>\x00)|(?P<sign>[^\\s]|[\\n\\r]+)")


def covered(seq: list, dense: Callable[[int, int], bool]) -> list[bool]:
    """Which places of ``seq`` lie in a repeated maximal substring that is ``dense`` (by length and occurrences).

    Suffix automaton of the whole sequence: every state is a class of substrings with the same end
    positions, its longest member a right-maximal substring. One walk over the sequence marks, at every end
    position, the longest dense substring on the suffix-link path. A state's only transition stands in two
    plain lists; a dict is made with its second one, so that even a very long page takes little memory.
    """
    n = len(seq)
    sym: list = [None] * (2 * n + 1)
    to = [0] * (2 * n + 1)
    more: list = [None] * (2 * n + 1)
    link, length, count = [-1] * (2 * n + 1), [0] * (2 * n + 1), [0] * (2 * n + 1)
    more[0] = {}
    last, size = 0, 1
    for i, w in enumerate(seq):
        cur = size
        size += 1
        length[cur], count[cur] = i + 1, 1
        p = last
        q = -1
        while p != -1:
            t = more[p]
            if t is not None:
                if w in t:
                    q = t[w]
                    break
                t[w] = cur
            elif sym[p] is None:
                sym[p], to[p] = w, cur
            elif sym[p] == w:
                q = to[p]
                break
            else:
                more[p] = {sym[p]: to[p], w: cur}
            p = link[p]
        if p == -1:
            link[cur] = 0
        elif length[p] + 1 == length[q]:
            link[cur] = q
        else:
            clone = size
            size += 1
            sym[clone], to[clone] = sym[q], to[q]
            more[clone] = more[q].copy() if more[q] is not None else None
            link[clone], length[clone] = link[q], length[p] + 1
            while p != -1:
                t = more[p]
                if t is not None:
                    if t.get(w) != q:
                        break
                    t[w] = clone
                elif sym[p] == w and to[p] == q:
                    to[p] = clone
                else:
                    break
                p = link[p]
            link[q] = link[cur] = clone
        last = cur
    at_length = [0] * (n + 2)  # states by length, a counting sort
    for s in range(1, size):
        at_length[length[s] + 1] += 1
    for k in range(1, n + 2):
        at_length[k] += at_length[k - 1]
    by_length = [0] * (size - 1)
    for s in range(1, size):
        k = length[s]
        by_length[at_length[k]] = s
        at_length[k] += 1
    for s in reversed(by_length):
        count[link[s]] += count[s]
    best = [0] * size
    for s in by_length:
        best[s] = length[s] if dense(length[s], count[s]) else best[link[s]]
    marks = [0] * (n + 1)
    state = 0
    for i, w in enumerate(seq):
        t = more[state]
        state = t[w] if t is not None else to[state]
        if b := best[state]:
            marks[i + 1 - b] += 1
            marks[i + 1] -= 1
    out, depth = [], 0
    for m in marks[:n]:
        depth += m
        out.append(depth > 0)
    return out


def frequent_pairs(words: list[str], at_least: float = AT_LEAST) -> set[tuple[str, str]]:
    """The pairs of neighbours that occur ``at_least`` times."""
    return {p for p, c in Counter(zip(words, words[1:])).items() if c >= at_least}


def repeated_words(words: list[str], density: float = DENSITY, at_least: int = AT_LEAST, often: set[tuple[str, str]] | None = None) -> list[bool]:
    """Which words lie in a repeated maximal substring of two words or more with ``at_least`` occurrences that
    make up ``density`` of the page.

    All pairs of neighbours of such a substring occur ``at_least`` times, so stretches without such a pair
    are one unique symbol in the automaton; the result is that of the whole sequence.
    """
    n = len(words)
    if often is None:
        often = frequent_pairs(words, at_least)
    if not often:
        return [False] * n
    ids: dict[str, int] = {}
    seq: list[int] = []
    place: list[int] = []
    past = 0  # the place after the last one taken
    for i, p in enumerate(zip(words, words[1:])):
        if p in often:
            if i >= past:  # a new stretch; nothing dense goes across: -1, -2 and so on occur once each
                seq += (-1 - len(seq), ids.setdefault(p[0], len(ids)))
                place += (-1, i)
            seq.append(ids.setdefault(p[1], len(ids)))
            place.append(i + 1)
            past = i + 2
    out = [False] * n
    for i, c in zip(place, covered(seq, lambda k, c: c >= at_least and k > 1 and c * k >= density * n)):
        if i >= 0:
            out[i] = c
    return out


def _body(text: str) -> tuple[str, list[int]]:
    """The page in lower case with a NUL for every link or tag, and their lengths; keyword metadata as text."""
    low = _INVISIBLE.sub("", text).lower().replace("\x00", " ")
    if "<meta" in low:
        low = _META.sub(lambda m: "\n" + ", ".join("".join(g) for g in _CONTENT.findall(m.group())) + "\n", low)
    links: list[int] = []

    def cut(m: re.Match) -> str:
        links.append(m.end() - m.start())
        return " \x00 "

    body = _LINK.sub(cut, low) if _LINK_HINT.search(low) else low
    if "<" in body or "&" in body:
        body = _MARKUP.sub(" ", body)
    return body, links


def _units(body: str) -> list[tuple[int, int, list[str], bool]]:
    """Sentences, lines and menu entries: (from, to, words, closed by a stop)."""
    out, at = [], 0
    for m in _UNIT.finditer(body):
        out.append((at, m.end(), _WORD.findall(body, at, m.start()), body[m.start()] in ".!?…"))
        at = m.end()
    if at < len(body):
        out.append((at, len(body), _WORD.findall(body, at), False))
    return out


def page_shares(text: str, clause_words: frozenset[str], above: float = -1.0) -> tuple[float, float, float, float, int] | None:
    """(listed, without clauses, in repeated words, in links; words outside links) of a whole page, shares of characters.

    A unit is a clause if CLAUSE_SHARE of its words are clause words that no dense repeat covers, or if it
    is a closed sentence of eight words or more, four fifths of them clause words, that doesn't repeat
    itself. All other units go, as kinds of words, numbers, links and signs, into a second automaton; its
    repeated maximal substrings are the page's list structure. Listed are the characters outside clauses
    that repeats of the words or of that structure cover: what repeats nothing is no list, however few
    clause words it has, so a title or a fragment isn't reported.
    """
    body, links = _body(text)
    units = _units(body)
    words = [w for u in units for w in u[2]]
    if not words and not links:
        return (0.0, 0.0, 0.0, 0.0, 0) if above < 0 else None
    often = frequent_pairs(words)
    clause_like = [[w in clause_words for w in u[2]] for u in units]
    if above >= 0:
        most = total = sum(links)
        k = 0
        for (_, _, u, _), known in zip(units, clause_like):
            n = len(u)
            size = sum(map(len, u)) + n
            total += size
            sure = sum(known)
            if often and n >= 3 and sure >= CLAUSE_SHARE * n:  # a repeat covers words of frequent pairs only
                pairs = [p in often for p in zip(words[max(0, k - 1) : k + n], words[max(1, k) : k + n + 1])]
                if True in pairs:
                    pairs = [False, *pairs, False] if k == 0 else [*pairs, False]
                    sure = sum(w and not x and not y for w, x, y in zip(known, pairs, pairs[1:]))
            if n < 3 or sure < CLAUSE_SHARE * n:
                most += size
            k += n
        if most <= above * total:
            return None
    packed = repeated_words(words, often=often)
    good = k = at_link = 0
    kinds: list = []
    chars: list[int] = []
    for (start, end, u, closed), known in zip(units, clause_like):
        n = len(u)
        cov = packed[k : k + n]
        k += n
        clause = False
        if n >= 3:
            free = sum(a and not b for a, b in zip(known, cov)) if True in cov else sum(known)
            clause = free >= CLAUSE_SHARE * n or (closed and n >= 8 and sum(known) >= 0.8 * n and len(set(u)) > 0.8 * n)
        if clause:
            good += sum(map(len, u)) + n
            inner = body.count("\x00", start, end) if links else 0
            kinds += [True] * inner
            chars += links[at_link : at_link + inner]
            at_link += inner
            kinds.append(len(kinds))  # a break: no other place has the same
            chars.append(0)
            continue
        at = 0
        for m in _SIGN.finditer(body, start, end):
            if m["word"]:
                w = m["word"]
                kinds.append("r" if cov[at : at + 1] == [True] else "n" if w.isdigit() else "w")
                chars.append(len(w) + 1)
                at += 1
            elif m["link"]:
                kinds.append(True)
                chars.append(links[at_link])
                at_link += 1
            else:
                kinds.append("\n" if m["sign"] in "\r\n" else m["sign"][0])
                chars.append(0)
    kinds = ["link" if x is True else x for x in kinds]
    shaped = covered(kinds, lambda length, c: c >= AT_LEAST and length > 1)
    listed = sum(c for c, s, x in zip(chars, shaped, kinds) if s or x == "r")
    total = good + sum(chars)
    repeated = sum(len(w) + 1 for w, c in zip(words, packed) if c) if True in packed else 0
    return listed / total, (total - good) / total, repeated / total, sum(links) / total, len(words)


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, pages with it in sentences, pages with it elsewhere), combined per task; the null word counts pages."""
    inside, outside = Counter(), Counter()
    pages = 0

    def emit() -> pa.RecordBatch:
        keys = [*(inside.keys() | outside.keys()), None]
        out = pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([inside[w] if w is not None else pages for w in keys], pa.int64()), pa.array([outside[w] if w is not None else 0 for w in keys], pa.int64())],
            names=["word", "inside", "outside"],
        )
        inside.clear()
        outside.clear()
        return out

    for batch in batches:
        for text in batch.column(0).to_pylist():
            units = _units(_body(text)[0]) if text else []
            words = [w for u in units for w in u[2]]
            if not words:
                continue
            pages += 1
            many = max(AT_LEAST, 0.02 * len(words))
            often = frequent_pairs(words, many)
            sentences, rest = set(), set()
            for _, _, u, closed in units:
                proper = closed and len(u) >= 6 and len(set(u)) >= 0.7 * len(u) and (not often or sum(p in often for p in zip(u, u[1:])) <= 0.2 * len(u))
                (sentences if proper else rest).update(u)
            inside.update(sentences)
            outside.update(rest)
        if len(inside) + len(outside) >= FLUSH_AT:
            yield emit()
            pages = 0
    yield emit()


def learned_clause_words(df: DataFrame, text: str, doc_share: float = DOC_SHARE, lift: float = LIFT, max_words: int = 500_000) -> frozenset[str]:
    """The words that hold sentences together in this collection, by one aggregation over all its pages.

    A sentence here is a unit of six words or more closed by a stop that repeats neither itself nor the
    page. A word is a clause word if it stands in sentences of ``doc_share`` of all pages and its odds of
    standing in one are at least ``lift`` times those of all words together. Words of keyword lists,
    products and menus have low odds in any language. At most (mean distinct words a page / ``doc_share``)
    words can pass, so the set does not grow with the number of pages; more than ``max_words`` is an error.
    """
    counts = df.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text").isNotNull()).mapInArrow(_evidence, "word string, inside long, outside long")
    table = cut_lineage(counts.groupBy("word").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")))
    word = F.col("word").isNotNull()
    pages, inside, outside = table.agg(F.sum(F.when(~word, F.col("inside"))), F.sum(F.when(word, F.col("inside"))), F.sum(F.when(word, F.col("outside")))).first()
    if not pages or not inside:
        return frozenset()
    odds = inside / max(outside or 0, 1)
    kept = table.where(word & (F.col("inside") >= doc_share * pages) & (F.col("inside") >= lift * odds * F.col("outside"))).select("word")
    found = kept.limit(max_words + 1).toArrow()["word"].to_pylist()
    if len(found) > max_words:
        raise ValueError(f"more than {max_words} clause words: raise doc_share")
    return frozenset(found)


def _scored(df: DataFrame, ident: str, text: str, clause_words: frozenset[str] | None, above: float) -> DataFrame:
    learned = clause_words if clause_words is not None else learned_clause_words(df, text)
    held = df.sparkSession.sparkContext.broadcast(learned)
    names = ["listed_share", "no_clause_share", "repeat_share", "link_share", "n_words"]
    kinds = (pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [None if t is None else page_shares(t, held.value, above) for t in batch.column(1).to_pylist()]
            keep = [i for i, s in enumerate(scores) if above < 0 or (s is not None and s[0] > above)]
            added = [pa.array([scores[i][j] if scores[i] is not None else None for i in keep], kinds[j]) for j in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), *added], names=[batch.schema.names[0], *names])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(F.col(f"`{ident}`"), F.col(f"`{text}`").cast("string").alias("__text")).mapInArrow(
        run, f"`{ident}` {kind}, listed_share double, no_clause_share double, repeat_share double, link_share double, n_words long"
    )


def page_scores(df: DataFrame, ident: str, text: str, clause_words: frozenset[str] | None = None) -> DataFrame:
    """(ident, listed_share, no_clause_share, repeat_share, link_share, n_words) of every row; whole texts.

    ``clause_words`` defaults to those learned from ``df`` itself (one job, run here); they are broadcast, a
    set whose size learned_clause_words bounds. A null text has null shares; an empty one 0. Repeated rows
    are scored each. The scoring itself needs no shuffle.
    """
    return _scored(df, ident, text, clause_words, -1.0)


def stuffed_pages(df: DataFrame, ident: str, text: str, above: float = 0.5, clause_words: frozenset[str] | None = None) -> DataFrame:
    """The page_scores rows most of whose text is listed: repeats of words or of list structure outside clauses.

    ``above``: the share of listed characters from which a page is reported. One rule for pages of any
    length; no automaton is built for a page that a bound already rules out.
    """
    return _scored(df, ident, text, clause_words, above)
