import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curatrix.llm import truncation as T
from curatrix.llm import stuffing
from curatrix.llm.stuffing import learned_clause_words, page_scores, page_shares, repeated_words, stuffed_pages
from curatrix.llm.wordhash import text_chunks, words_of


def words(texts):
    col = pa.array(texts, pa.string())
    out = []
    for lo, hi, data, offsets in text_chunks(col, 50):
        w = words_of(data, offsets[:-1], offsets[1:])
        for i in range(hi - lo):
            out.append([bytes(data[s:e]).decode() for s, e in zip(w.start[w.first[i] : w.past[i]], w.end[w.first[i] : w.past[i]])])
    return out


def test_words():
    texts = ["One two,three", "", None, "“Café” naïve… end", "x​y", "joined", "a-b_c 9"]
    assert words(texts) == [["One", "two", "three"], [], [], ["Café", "naïve", "end"], ["x", "y"], ["joined"], ["a", "b", "c", "9"]]


def test_hash_is_of_the_word_alone():
    col = pa.array(["alpha beta", "xx BETA alpha"])
    (_, _, data, offsets), = text_chunks(col)
    w = words_of(data, offsets[:-1], offsets[1:])
    assert w.hash[0] == w.hash[4] and w.hash[1] == w.hash[3] and len(set(w.hash.tolist())) == 3
    h, inside = w.context(2)
    assert inside.tolist() == [False, True, False, True, True]


@pytest.mark.parametrize(
    "text,state",
    [
        ("All is well.", T.CLOSED), ("All is well", T.OPEN), ("“All is well.”", T.CLOSED), ("All is well...", T.OPEN), ("All is. [...]", T.CLOSED),
        ("All is wel-", T.CUT), ("All is,", T.CUT), ("All &am", T.CUT), ("All sha�", T.CUT), ("All <br", T.CUT), ("All is (more)", T.OPEN),
        ("It ends here. (scan of a print)", T.CLOSED), ("", T.NO_CASE), ("  ", T.NO_CASE), ("I cannot describe this image.", T.NO_CASE),
    ],
)
def test_closing(text, state):
    assert T.closing(text)[0] == state


def test_align():
    whole = "The lamp stands on the left side of the long table near the old window. The floor is dark and wet."
    assert T.align(whole[:-14], whole) == 1  # inside "floor is ..."
    assert T.align(whole[:-6], whole) == 1  # mid-word
    assert T.align(whole[: whole.index(" The floor")], whole) in (0, None)
    assert T.align("quite other words that share nothing at all with it here", whole) is None


def corpus():
    rng = random.Random(2)
    who = ["a tailor", "a potter", "a luthier", "a weaver", "a dancer"]
    thing = ["a brass lamp", "a tin can", "a wooden ladder", "an unlit lantern", "a folded map"]
    end = ["The mood remains calm and practical.", "The overall effect is quiet.", "Only {} hints at the work before."]
    out = []
    for _ in range(900):
        out.append(f"Photograph of {rng.choice(who)} holding {rng.choice(thing)}. The light falls on {rng.choice(thing)} and fades slowly. {rng.choice(end).format(rng.choice(thing))}")
    return out, rng


def test_truncated(spark):
    texts, rng = corpus()
    rows, want = [], {}
    for i, t in enumerate(texts):
        kind = i % 6
        if kind == 0:  # cut inside the second sentence
            at = t.index("The light") + rng.randrange(12, 24)
            t, want[i] = t[:at].rstrip(), True
        elif kind == 1:
            t, want[i] = t[:-1], False
        elif kind == 2:
            t, want[i] = t[:-1] + "...", False
        else:
            want[i] = False
        rows.append((i, t))
    rows += [(5000, None), (5001, ""), (5002, "I cannot describe this image."), (5003, "tree, lamp, soft light, wall"), (5004, rows[3][1]), (5005, " ".join(texts * 3))]
    df = spark.createDataFrame(rows, "uid long, text string")
    got = {r.uid: r.cut for r in T.truncated(df.repartition(3)).collect()}
    wrong = [rows[i] for i in want if got[i] != want[i]]
    assert len(wrong) <= 5, wrong[:10]
    assert not any(got.get(i, False) for i in range(5000, 5006)) and 5000 not in got
    assert T.truncated(df.limit(0)).count() == 0


def test_pairs_decide(spark):
    whole = " ".join(f"word{i} stands beside item{i}" for i in range(30)) + ". And then it all ends in a garden by the sea."
    df = spark.createDataFrame([(1, whole), (2, whole[:-15]), (3, whole)], "uid long, text string")
    assert {r.uid: (r.cut, r.how) for r in T.truncated(df).collect()}[2] == (True, "aligned")


def test_every_longer_text_of_a_bucket_is_tried(spark):
    whole = " ".join(f"word{i} stands beside item{i}" for i in range(30)) + ". And then it all ends in a garden by the sea."
    other = whole.replace("ends in a garden by the sea", "stops at a window near the long table")  # longer than the whole, fails the anchor
    cut = whole[:-15]
    # The last ones hold the shingles of the first two, so they are the longest of all their buckets, and more than a quarter longer.
    again = " ".join(f"lamp{i} hangs over desk{i}" for i in range(20)) + ". And then it all ends in a garden by the sea."
    rows = [(1, whole), (2, cut), (4, other), (5, cut), (6, whole + " The end."), (7, again[:-15]), (8, again)]
    rows += [(100 + k, f"{again} A filler{k} with tail{k}. {again}") for k in range(30)]
    df = spark.createDataFrame(rows, "uid long, text string")
    got = {r.uid: (r.cut, r.how) for r in T.truncated(df.repartition(3)).collect()}
    assert got[2] == got[5] == (True, "aligned") and got[1] == (False, "aligned") and got[7] == (True, "aligned")


def pairs_by_brute_force(texts):
    out = {}
    for a in texts:
        verdicts = [v for b in texts if b != a and (v := T.align(a, b)) is not None]
        if verdicts:
            out[a] = max(verdicts)
    return out


def near_copies(rng, groups, size):
    """Groups of texts of one origin with words changed, cut at all kinds of places."""
    texts = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(60)]
        for i in range(9, 60, 10):
            base[i] += "."
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(2)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
            t = " ".join(w)
            texts.append(t[: rng.randrange(len(t) // 3, len(t) + 1)].rstrip() if rng.random() < 0.7 else t)
    return texts


def test_pair_recall_against_brute_force(spark):
    texts = near_copies(random.Random(5), 12, 14)
    texts += texts[:20]
    df = spark.createDataFrame(list(enumerate(texts)), "uid long, text string")
    got = {texts[r.uid]: r.cut for r in T.truncated(df.repartition(3)).collect() if r.how == "aligned"}
    want = {t: v for t, v in pairs_by_brute_force(set(texts)).items() if len(t.split()) > T.FIRST_WINDOW}
    assert len(want) > 80
    assert set(got) <= set(want) and len(got) >= 0.95 * len(want)
    assert sum(got[t] == (want[t] == 1) for t in got) >= 0.97 * len(got)


def test_copies_cost_a_row_each_not_a_pair(spark, monkeypatch):
    """Among 150 near-copies of one text, each is compared with a few representatives."""
    rng = random.Random(3)
    base = [f"word{i}" for i in range(120)]
    texts = []
    for k in range(150):
        w = list(base)
        w[rng.randrange(40)] = f"x{k}"
        texts.append(" ".join(w[: rng.randrange(90, 120)] if k % 3 == 0 else w))
    seen = []
    real = T.candidate_pairs
    monkeypatch.setattr(T, "candidate_pairs", lambda *a: seen.append(real(*a)) or seen[-1])
    got = {r.uid: (r.cut, r.how) for r in T.truncated(spark.createDataFrame(list(enumerate(texts)), "uid long, text string")).collect()}
    want = pairs_by_brute_force(texts)
    found = [k for k, t in enumerate(texts) if got[k][1] == "aligned"]
    assert len(want) >= 45 and all(want[texts[k]] == got[k][0] for k in found) and len(found) >= 0.9 * len(want)
    assert seen[0].count() < 30 * 150


def near_misses(rng, base, n):
    """Texts with two words of ``base`` changed, far apart: too little in common, yet many have a band in common."""
    out = []
    for _ in range(n):
        w = list(base)
        for i in rng.sample(range(5, 50, 6), 2):
            w[i] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("cells", [(512, 20_000), (1, 7)])
def test_partners_between_the_representatives_are_tried(spark, monkeypatch, cells):
    """Of 201 texts that go on alike, only the one in the middle is a near-copy."""
    monkeypatch.setattr(T, "CELL_CUTS", cells[0], raising=False)
    monkeypatch.setattr(T, "CELL_WHOLES", cells[1], raising=False)
    base = [f"word{i}" for i in range(60)]
    whole = " ".join(base)
    others = near_misses(random.Random(6), base, 200)
    rest = [" in the garden by the sea", " on a quiet day. The sky is blue", " beside an old lantern"]
    rows, cuts = [], [whole + " in the gard", whole + " in the garden", whole + " on a quiet day.", whole + " beside an old lan"]
    for g, tail in enumerate(rest):
        rows += [(1000 * g + i, t + tail) for i, t in enumerate(others[:100] + [whole] + others[100:])]
    rows += [(9000 + i, t) for i, t in enumerate(cuts)]
    assert all(T.align(c, t + rest[g]) is None for c, g in zip(cuts, (0, 0, 1, 2)) for t in others)
    got = {r.uid: (r.cut, r.how) for r in T.truncated(spark.createDataFrame(rows, "uid long, text string").repartition(3)).collect()}
    assert [got[9000 + i] for i in range(4)] == [(True, "aligned"), (True, "aligned"), (False, "aligned"), (True, "aligned")]


def test_a_later_place_of_the_same_words(spark):
    """Texts alike up to a place differ if the same words recur after it, as the nearest place counts."""
    base = " ".join(f"word{i}" for i in range(40))
    cut, whole = base + " by the long stone wall of", base + " by the long stone wall of a house"
    again = [whole + f" or y{k} by the long stone wall of a barn" for k in range(3)]
    rows = [(0, again[0]), (1, whole), *((2 + k, t) for k, t in enumerate(again[1:])), (9, cut)]
    got = {r.uid: (r.cut, r.how) for r in T.truncated(spark.createDataFrame(rows, "uid long, text string")).collect()}
    assert got[9] == (True, "aligned")


def test_cut_inside_the_last_word(spark):
    whole = " ".join(f"word{i} stands beside item{i}" for i in range(30)) + " in the garden"
    got = {r.uid: (r.cut, r.how) for r in T.truncated(spark.createDataFrame([(1, whole), (2, whole[:-3])], "uid long, text string")).collect()}
    assert got[2] == (True, "aligned") and got[1][1] == "words"


def test_marks_are_judged_by_what_follows_their_sign(spark):
    texts = [f"The {a} stands by the {b}, and the {c} is lit - or so it seems." for a in ("lamp", "chair", "vase") for b in ("wall", "door") for c in ("floor", "room", "hall", "yard")]
    rows = [*enumerate(texts), (500, "A quiet corner of the studio,"), (501, "A quiet corner of the studio"), (502, "A corner of the s\ufffd")]
    got = {r.uid: (r.cut, r.how) for r in T.truncated(spark.createDataFrame(rows, "uid long, text string")).collect()}
    assert got[500] == got[502] == (True, "words")


def test_bit_set(spark):
    rng = np.random.RandomState(1)
    h = rng.randint(-(1 << 62), 1 << 62, 5000)
    s = T.BitSet(spark.createDataFrame([(int(x),) for x in h], "h long"), len(h), 2)
    assert s.has(h.view(np.uint64)).all()
    assert s.has(rng.randint(-(1 << 62), 1 << 62, 20_000).view(np.uint64)).mean() < 0.02
    assert not T.BitSet(spark.createDataFrame([], "h long"), 0).has(h.view(np.uint64)).any()


def brute_repeats(words_, density, at_least):
    n, out = len(words_), [False] * len(words_)
    for k in range(2, n + 1):
        for i in range(n - k + 1):
            sub = words_[i : i + k]
            at = [j for j in range(n - k + 1) if words_[j : j + k] == sub]
            if len(at) >= at_least and len(at) * k >= density * n:
                for p in range(i, i + k):
                    out[p] = True
    return out


def test_automaton_against_brute_force():
    rng = random.Random(4)
    for _ in range(120):
        w = [rng.choice("abcdefgh"[: rng.randrange(1, 9)]) for _ in range(rng.randrange(0, 40))]
        for density, at_least in ((0.1, 3), (0.0, 2), (0.3, 3)):
            got, want = repeated_words(w, density, at_least), brute_repeats(w, density, at_least)
            # The longest dense substring at an end is marked; shorter ones within it add nothing.
            assert got == want, (w, density, at_least)


SPAM = [
    "cheap softbox, ring light, cheap softbox, ring light, " * 10,
    "\n".join(f"https://shop{i}.example/item/{i}" for i in range(30)),
    "#freepresets #cheaplens " * 20,
    "Home | Login | Register | New sets | Contact | FAQ | Top 100 | Archive | Galleries | Next | Last | Tags | Help",
    "Buy camera lens here, buy camera lens there, buy camera lens in Graz. Looking for buy camera lens? Our buy camera lens beats every buy camera lens. " * 3,
    '<META NAME="keywords" CONTENT="cheap softbox, ring light, canvas prints, tripod coupon, cheap softbox, drone rental">',
    "Tripod T40\nC-stand\nSandbag 7kg\nFilm holder\nSync cable\nSoftbox 60cm\nGrey card\nShutter release",
    "lamp table chair " * 30_000,
]
PROSE = [
    "The room was empty apart from a lamp, and the light fell on the floor. She looked at the table while he waited by the door. Nothing else was to be seen there.",
    "1. Open the file before you remove it.\n2. Check that the caption is not empty.\n3. Ask a third reader if you disagree about it.\n4. Write down what you have changed in the log.",
    "Das Bild zeigt einen Uhrmacher in einem engen Treppenhaus. Bitte nichts ohne Nennung der Fotografin weitergeben, auch wenn es nur ein Ausschnitt ist. Tags: licht, raum",
    "See the notes at https://notes.example/a/1 before you ask. The second part of the work was done by hand and nobody has checked it so far. https://notes.example/a/2",
    "",
    "Portrait lens",
]


def test_stuffed_pages(spark):
    rows = [(i, t) for i, t in enumerate(SPAM)] + [(100 + i, t) for i, t in enumerate(PROSE)] + [(200, None), (201, SPAM[0]), (202, "The cat that we saw on the mat was not glad about it at all. " * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in stuffed_pages(df, "doc_id", "text").collect()} == {*range(len(SPAM)), 201}
    scores = {r.doc_id: r for r in page_scores(df, "doc_id", "text").collect()}
    assert scores[200].listed_share is None and scores[104].listed_share == 0.0 and len(scores) == len(rows)
    assert stuffed_pages(df.limit(0), "doc_id", "text").count() == 0
    clashing = df.withColumns({"listed_share": F.lit(1), "word": F.lit("x"), "__text": F.lit("y"), "link_share": F.lit(0)})
    assert {r.doc_id for r in stuffed_pages(clashing, "doc_id", "text").collect()} == {*range(len(SPAM)), 201}


def test_clause_words_come_from_sentences(spark):
    prose = [f"The {a} that we saw in the {b} was not lit by any of the lamps." for a in ("room", "hall", "shed", "yard") for b in ("north", "south", "east")]
    lists = ["softbox | tripod | backdrop | presets | softbox room | hall", "tripod, softbox, backdrop"] * 6
    got = learned_clause_words(spark.createDataFrame([(t,) for t in [*prose, *lists, None, ""]], "text string"), "text")
    assert {"the", "that", "we", "was", "not", "any"} <= got and not {"softbox", "tripod", "backdrop", "presets"} & got
    assert learned_clause_words(spark.createDataFrame([], "text string"), "text") == frozenset()
    # Languages without a word list of ours: the words are learned all the same.
    dutch = [f"De {a} die wij in de {b} zagen was door geen van de lampen verlicht." for a in ("kamer", "hal", "schuur") for b in ("tuin", "straat")]
    assert {"die", "wij", "geen"} <= learned_clause_words(spark.createDataFrame([(t,) for t in dutch], "text string"), "text")


def test_repeats_decide(monkeypatch):
    """Without the automaton's marks nothing is reported; without clause words only repeats are."""
    known = frozenset("the was and of to that we it is not a in by".split())
    assert all(page_shares(t, known)[0] > 0.5 for t in SPAM)
    monkeypatch.setattr(stuffing, "covered", lambda seq, dense: [False] * len(seq))
    assert not any(page_shares(t, known)[0] > 0.5 for t in SPAM)


def test_one_rule_for_any_length():
    rng = random.Random(8)
    block = [f"k{i}" for i in range(300)]
    words_ = []
    for k in range(3):  # a block that stands three times, far apart
        words_ += [f"w{rng.randrange(10**9)}" for _ in range(9_000)] + block
    got = repeated_words(words_)
    at = [i for i, w in enumerate(words_) if w.startswith("k")]
    assert all(got[i] for i in at) and sum(got) == len(at)
    share, _, repeat, links, n = page_shares("lamp table chair " * 30_000, frozenset())
    assert share == 1.0 and repeat > 0.9 and n == 90_000 and links == 0 and np.isfinite(share)


def test_refusals_stay_in_the_base_of_shares(spark, tmp_path):
    from curatrix.llm.queries import QUERIES

    rows = [(1, "I cannot describe this image of a lamp in a room.", "E "), (2, "A lamp stands on the table by the,", "e"), (3, "  ", "e"), (4, None, "e"), (5, "", "e")]
    spark.createDataFrame(rows, "caption_id long, caption_dense string, engine string").coalesce(1).write.parquet(str(tmp_path / "captions.parquet"))
    spark.createDataFrame([(1, "I'm sorry, but this image can't be described by me.", "s")], "line_no long, caption_text string, source string").write.parquet(str(tmp_path / "manifest_entries.parquet"))
    got = {(r.text_column, r.source): (r.texts, r.cut_texts, r.cut_share) for r in QUERIES["p5_source_shares"](spark, str(tmp_path)).collect()}
    assert got == {("caption_dense", "e"): (2, 1, 0.5), ("caption_text", "s"): (1, 0, 0.0)}
