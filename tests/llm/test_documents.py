"""Operators on documents against brute force, with nulls, empty and long texts, repeats, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from glyphforge.llm import bpe, components, lines, minhash, mixing, quality, substrings
from glyphforge.llm.common import Words, Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def make(seed: int = 5) -> list[tuple]:
    """Texts with copies, near copies, shared passages, oddities; ids in no order."""
    rng = random.Random(seed)
    vocab = [a + b for a in ("ka", "lo", "mi", "tu", "re", "so") for b in ("n", "ta", "ri", "s", "", "mo", "É", "x9")]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    texts: list[str | None] = [None, "", "  \n\t", "one two", "one  two", "a b c d e", "A B C D E", "word " * 300, "x" * 5000]
    passage = prose(60)
    for _ in range(6):
        base = prose(rng.randint(30, 200))
        texts += [base] * rng.randint(1, 3)
        for _ in range(4):
            w = base.split(" ")
            for _ in range(rng.randint(1, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocab) + "q"
            texts.append(" ".join(w))
        texts.append(f"{prose(10)}\n{passage}\r\n{prose(15)}")
    rng.shuffle(texts)
    rows = [(i * 3 + 1, t, rng.choice(["en", "fr", None]), rng.choice(["b", "a", None]), len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    return make()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def shingles(text: str | None) -> set[tuple]:
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def roots(ids: list, linked: list[tuple]) -> dict:
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(docs, rows, percent):
    sets = {r[0]: shingles(r[1]) for r in rows}
    ids = sorted(sets)
    near = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = roots(ids, near)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, percent).collect()}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i in ids}


def test_near_duplicates_residual_members(spark):
    """A group whose pivot is far from some members that are near each other: only the second pass links those."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = []
    for version in range(40):  # each version changes three words of the last, so only neighbours are near
        base = list(base)
        for _ in range(2):
            base[rng.randrange(len(base))] = f"v{version}_{rng.randrange(10**6)}"
        texts.append(" ".join(base))
    rows = [(i, t) for i, t in enumerate(texts)]
    sets = [shingles(t) for _, t in rows]
    near = [(a, b) for a in range(40) for b in range(a + 1, 40) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(list(range(40)), near)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 80).collect()}
    assert got == want


def test_near_duplicates_edges(spark):
    clash = "doc_id long, text string, key long, rep long, component_id string, n long"
    rows = [(None, "a b c d e f", 1, 1, "z", 1), (4, "a b c d e f", 1, 1, "z", 1), (4, "a b c d e f", 1, 1, "z", 1), (9, "a b c d e f", None, None, None, None)]
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, clash)).collect())
    assert got == [("4", 4, True), ("4", 4, True), ("9", 4, False), ("None", None, True)]
    assert minhash.near_duplicates(spark.createDataFrame([], clash)).collect() == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    b = np.unique(np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)]))
    s = minhash.superminhash([a, b, a[:0], a[:1], np.unique(rng.integers(0, 2**63, 300_000).astype(np.uint64))])
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - j) < 0.15
    assert (s[2] == minhash.EMPTY).all() and (s[3] != minhash.EMPTY).all() and (s[4] != minhash.EMPTY).all()


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, i) for i in range(1001, 1200)]
    loose = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    links = chain + star + loose + [(5, 5), (None, 7)]
    rng.shuffle(links)
    sound = [(a, b) for a, b in links if a is not None and a != b]
    want = roots(sorted({x for p in sound for x in p}), sound)
    got = components.components(Workspace(spark, "test"), spark.createDataFrame(links, "a long, b long").repartition(5))
    assert {r.node: r.root for r in got.collect() if r.node != r.root} == {k: v for k, v in want.items() if k != v}
    assert components.components(Workspace(spark, "test"), spark.createDataFrame([], "a long, b long")).collect() == []


def cut_repeats(rows: list[tuple], size: int = 20) -> dict:
    seen, out = set(), {}
    for i, t in sorted((r[0], r[1]) for r in rows):
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            if k in seen:
                gone[p : p + size] = [True] * size
            seen.add(k)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("size", [3, 5, 20, 33])
def test_substrings(docs, rows, size):
    rows = [r if r[1] is not None else (r[0], "", *r[2:]) for r in rows]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.drop_repeats(docs, size, base=5).collect()}
    assert got == cut_repeats(rows, size)


def test_windows_are_told_apart_by_128_bits():
    """Of windows that agree in one 64-bit hash and not in the other, none is taken for a repeat."""
    text = " ".join(f"w{i}" for i in range(40))
    x = substrings.Windows(pa.array([text, text, text.replace("w7", "v7")]), 20)
    one, two = x.prints(np.arange(len(x.row)))
    assert (one[:21] == one[21:42]).all() and (two[:21] == two[21:42]).all()
    differ = np.arange(21) <= 7
    assert ((one[42:] != one[:21]) == differ).all() and ((two[42:] != two[:21]) == differ).all()
    assert not (one == two).any()
    assert substrings.lengths(33, 5) == [9, 17, 33] and substrings.lengths(20, 5) == [5, 10, 20] and substrings.lengths(20) == [10, 20]
    v = np.random.default_rng(0).integers(0, 50, 200)
    for m in (1, 2, 7, 16):
        best, place = substrings.least_within(v, m)
        assert place.tolist() == [i + int(v[i : i + m].argmin()) for i in range(len(v) - m + 1)] and (best == v[place]).all()


def test_substrings_edges(spark):
    t = " ".join(f"w{i}" for i in range(30))
    clash = "doc_id long, text string, id long, starts string, anchors long"
    rows = [(None, t, 1, "s", 1), (2, t, 1, "s", 1), (2, t, 1, "s", 1), (3, None, 1, "s", 1)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substrings.drop_repeats(spark.createDataFrame(rows, clash)).collect())
    assert got == [("2", 30, 30), ("2", 30, 30), ("3", 0, 0), ("None", 30, 0)]
    other = [(4, f"x {t}", 1, "s", 1), (4, t, 1, "s", 1), (4, t, 1, "s", 1)]  # two texts of one id: one of them comes first
    got = sorted((r.n_words, r.n_removed) for r in substrings.drop_repeats(spark.createDataFrame(other, clash)).collect())
    assert got in ([(30, 0), (30, 0), (31, 30)], [(30, 30), (30, 30), (31, 0)])
    assert substrings.drop_repeats(spark.createDataFrame([], clash)).collect() == []


FOOT = "All rights reserved to the owner number {} of this very long page here today"


def line_rows() -> list[tuple]:
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    rows = [(i, f"{prose(12)}\n{prose(9)}\n{FOOT.format(i)}\n{prose(7)}", "x") for i in range(12)]
    copied = f"{prose(12)}\n{prose(11)}\n{prose(13)}"
    rows += [(100 + i, copied, "x") for i in range(30)]
    return [*rows, (200, None, "x"), (201, "", "x"), (202, "\n\n", "x"), (None, f"alone\n{FOOT.format(7)}", None)]


@pytest.mark.parametrize("most", [lines.BROADCAST, 0])
def test_lines(spark, most):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines string").repartition(3)
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.drop_lines(df, most=most).collect()}
    for i, t, _ in rows:
        stays = None if t is None else "\n".join(x for x in t.split("\n") if not x.startswith("All rights"))
        assert got[i] == (stays, 0 if t is None else t.count("\n") + 1, 0 if t is None else t.count("All rights"))


def test_lines_variable_word(spark):
    """A free word varies in boilerplate: the quarter that holds it is left out."""
    rng = random.Random(9)
    names = ["".join(rng.choice("klmnop") for _ in range(6)) for _ in range(9)]
    prose = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(8))
    rows = [(i, f"{prose()}\nThis page was written for you by {n} and may be shared with all your friends\n{prose()}") for i, n in enumerate(names)]
    out = lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.n_removed == 1 and "written" not in r.text for r in out)
    assert lines.drop_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def foot_rows(foot, n: int = 12, seed: int = 10) -> list[tuple]:
    """n documents of their own text between which foot(i) stands."""
    rng = random.Random(seed)
    prose = lambda k: " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(k))
    return [(i, f"{prose(12)}\n{prose(11)}\n{foot(i)}\n{prose(13)}") for i in range(n)]


def removed(spark, rows: list[tuple]) -> dict:
    return {r.doc_id: r.n_removed for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_lines_short(spark):
    """Lines of 1 to 3 tokens are dropped as others are; three documents are too few."""
    for foot in ("Share", "Read more", "All rights reserved."):
        assert set(removed(spark, foot_rows(lambda i, f=foot: f)).values()) == {1}
        assert set(removed(spark, foot_rows(lambda i, f=foot: f, n=3)).values()) == {0}


def test_lines_copies_protect_nothing(spark):
    """However often one of the documents is copied, the line that it shares with others goes, and its own lines stay."""
    rows = foot_rows(lambda i: "Please tell all your friends about us")
    rows += [(100 + i, rows[0][1]) for i in range(40)]
    assert set(removed(spark, rows).values()) == {1}


def test_lines_blocks(spark):
    """All lines of a block of boilerplate go, at the end of the text too."""
    block = "Read our terms first\nWrite to us at any time\nNo part may be reproduced\nThank you for reading"
    rows = foot_rows(lambda i: block)
    assert set(removed(spark, rows).values()) == {4}
    assert set(removed(spark, [(i, t.rsplit("\n", 1)[0]) for i, t in rows]).values()) == {4}


def test_lines_near_copies(spark):
    """Near copies count as one document: a large group of them keeps its lines, and loses what other documents have too."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    base = [[word() for _ in range(15)] for _ in range(14)]
    rows = []
    for i in range(300):
        own = [list(x) for x in base]
        for _ in range(3):
            own[rng.randrange(14)][rng.randrange(15)] = word()
        rows.append((1000 + i, "\n".join([*(" ".join(x) for x in own), "Thank you for reading"])))
    assert set(removed(spark, rows).values()) == {0}
    assert set(removed(spark, rows + foot_rows(lambda i: "Thank you for reading")).values()) == {1}


def test_lines_free_words(spark):
    """One free word in lines of 4 tokens and more, two in lines of 6 and more; a table's numbers do not make a template of its names."""
    rng = random.Random(6)
    name = lambda: "".join(rng.choice("klmnop") for _ in range(7))
    for foot in ("Posted by user {}", "Posted here by {} again", "Posted on this site by {}", "Posted by {} on this site for {}", "This page was written by {} and then it was checked for errors by {} before it came here", "This page {} was kept"):
        assert set(removed(spark, foot_rows(lambda i, f=foot: f.format(name(), name()))).values()) == {1}, foot
    assert set(removed(spark, foot_rows(lambda i: f"{i} {i + 3} {name()} {i}")).values()) == {0}
    assert set(removed(spark, [(i, f"This whole text is told again by {name()}") for i in range(12)]).values()) == {1}  # of one line, and no near copies
    assert set(removed(spark, [(i, "This whole text is told again") for i in range(12)]).values()) == {0}  # copies


def test_lines_of_words_read_once():
    rng = random.Random(5)
    texts = ["", None, "\n", "a\n", "\na", "a b1\n\n \nc", "٣ x9 \t\ny"] + ["".join(rng.choice(["a", "b1", " ", "\n", "cc", "9", "가", "\r\n"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    both = Words(pa.array(texts))
    x, print_ = lines.Lines(both), lines.Sketches(both, slots=False).print  # one reading of the words for both
    own = [(r, line) for r, t in enumerate(texts) for line in (t or "").split("\n")]
    assert list(zip(x.row.tolist(), [x.raw[a:b].tobytes().decode() for a, b in zip(x.start, x.end, strict=True)], strict=True)) == own
    assert x.tokens.tolist() == [len(words(line)) for _, line in own]
    assert (print_ == lines.Sketches(pa.array(texts), slots=False).print).all()
    for k, (_, line) in enumerate(own):
        alone = lines.Lines(pa.array([line]))
        assert x.whole[k] == alone.whole[0] and x.parts[k].tolist() == alone.parts[0].tolist()
        assert ((x.hashes[x.begin[k] : x.begin[k + 1]] == lines._VARIABLE) == [bool(re.search("[0-9]", w)) for w in words(line)]).all()
        n = len(words(line))
        assert [bool(p) for p in x.parts[k]] == [any(i * 4 // n == q for i in range(n)) for q in range(4)]
    keys = np.array([-5, 0, 3, 9])
    assert lines._is_among(np.array([[3, 10], [-6, -5]]), keys).tolist() == [[True, False], [False, True]] and not lines._is_among(keys, keys[:0]).any()


def recurring_lines(rows: list[tuple], least: int = 4) -> set[tuple]:
    """The tree restated on tuples of tokens, for documents that are no near copies of each other: the lines to be dropped.

    Lines meet their template in the order of their hashes, the one thing that is taken from the operator.
    """
    shown = lambda line: tuple("*" if re.search("[0-9]", w) else w for w in words(line))
    docs = {t: [x for x in map(shown, t.split("\n")) if x] for _, t in rows}
    parts = lambda x: [(len(x), q, p) for q in range(4) if (p := tuple((i, w) for i, w in enumerate(x) if i * 4 // len(x) == q))]
    held: dict[tuple, set] = {}
    for t, own in docs.items():
        for x in own:
            for p in parts(x):
                held.setdefault(p, set()).add(t)
    leaves: dict[tuple, list[tuple]] = {}
    for x in sorted({x for own in docs.values() for x in own}, key=lambda x: int(lines.Lines(pa.array([" ".join(w if w != "*" else "0" for w in x)])).whole[0])):
        leaf = next((p for p in parts(x) if len(held[p]) >= least), None)
        if leaf:
            leaves.setdefault(leaf, []).append(x)
    gone = set()
    for own in leaves.values():
        known: list[tuple[list, list]] = []
        for x in own:
            enough = max(-(-60 * len(x) // 100), min(len(x), 3))
            score = [sum(a == b != "*" for a, b in zip(x, t, strict=True)) for t, _ in known]
            if score and max(score) >= enough:
                t, members = known[score.index(max(score))]
                t[:] = [a if a == b else "*" for a, b in zip(t, x, strict=True)]
                members.append(x)
            else:
                known.append((list(x), [x]))
        for _, members in known:
            if len({t for t in docs if set(docs[t]) & set(members)}) >= least:
                gone |= set(members)
    return gone


@pytest.mark.parametrize("most", [lines.BROADCAST, 0])
def test_lines_against_the_tree_restated(spark, most):
    """Templates with free words at any place, the first ones too, in several places, in many lines of one leaf."""
    rng = random.Random(21)
    name = lambda: "".join(rng.choice("klmnop") for _ in range(4))
    vocab = [name() for _ in range(40)]
    feet = ["{} wrote this page for all of you", "By {} and {} on {} in our own city paper", "Page {n} of {n}", "Thank you", "{} told {} all about the old town hall today", "{} {} {}", "see {} now", "the {} and the {} of the {} in the {} at the {}"]
    rows = []
    for i in range(120):
        own = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 9))) for _ in range(6)] + [" ".join(name() for _ in range(30)) for _ in range(3)]
        own += [rng.choice(feet).format(*(name() for _ in range(5)), n=rng.randrange(99)) for _ in range(2)]
        rng.shuffle(own)
        rows.append((i, "\n".join(own)))
    rows += [(900 + i, t) for i, t in enumerate(["", "\n", "Thank you", "one line alone", "only numbers 1"])]
    gone = recurring_lines(rows)
    shown = lambda line: tuple("*" if re.search("[0-9]", w) else w for w in words(line))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for r in lines.drop_lines(df, most=most).collect():
        text = dict(rows)[r.doc_id]
        assert r.text == "\n".join(x for x in text.split("\n") if shown(x) not in gone)
    assert {x for x in gone if "wrote" in x} and {x for x in gone if "told" in x} and ("Thank", "you") in gone


def test_lines_of_a_large_leaf(spark, monkeypatch):
    """A leaf of more lines than a task compares is parsed deeper; what agrees there still makes templates."""
    monkeypatch.setattr(lines, "LEAF", 8)
    rng = random.Random(2)
    name = lambda: "".join(rng.choice("klmnop") for _ in range(7))
    rows = foot_rows(lambda i: f"Posted here for you again by {name()}", n=9)
    assert set(removed(spark, rows).values()) == {1}
    others = [(50 + i, t) for i, t in foot_rows(lambda i: f"Posted here {'abcdefgh'[i % 8]} {name()} {name()} {name()} {name()}", n=40, seed=3)]
    got = removed(spark, rows + others)
    assert {got[i] for i, _ in rows} == {1} and {got[i] for i, _ in others} == {0}
    assert set(removed(spark, foot_rows(lambda i: "Posted here for you", n=30)).values()) == {1}


@pytest.mark.parametrize(("docs", "bound"), [(60, 512), (400, 512), (60, 16)])
def test_lines_are_found_at_any_size(spark, monkeypatch, docs, bound):
    """Five lines a document of one template, the document's name in each: below and above the bound of a leaf."""
    monkeypatch.setattr(lines, "LEAF", bound)
    rng = random.Random(docs)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    rows = []
    for i in range(docs):
        name = word()
        foot = [f"This text was sent to {name} by the old post office near {word()}" for _ in range(5)]
        rows.append((i, "\n".join(x for k in range(5) for x in (" ".join(word() for _ in range(12)), foot[k]))))
    assert set(removed(spark, rows).values()) == {5}


def test_lines_of_documents_of_one_line(spark):
    """Documents of one line count as others do."""
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("klmnop") for _ in range(7))
    rows = [(i, f"A short note by {name()} about the weather of {name()}") for i in range(300)]
    assert set(removed(spark, rows).values()) == {1}


@pytest.mark.parametrize("bound", [4, 10_000])
def test_lines_in_leaves_above_the_bound(spark, monkeypatch, bound):
    """The templates that a leaf is known to hold, with near copies among the documents, whatever the bound."""
    monkeypatch.setattr(lines, "LEAF", bound)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    feet = ["Our page on {} was seen today by all of you", "Our page on {} was made with help from {}", "Our page on {} belongs to nobody at all here"]
    rows, want = [], {}
    for i in range(90):
        own = [" ".join(word() for _ in range(9)) for _ in range(4)]
        foot = feet[i % 3].format(word(), word()) if i % 10 else f"Our page on {' '.join(word() for _ in range(7))}"
        rows.append((i, "\n".join([*own, foot])))
        want[i] = int(i % 10 > 0)
    base = rows[1][1].split("\n")
    for i in range(40):  # near copies of one document: their own lines stay
        own = base[:-1]
        k = rng.randrange(4)
        own[k] = " ".join([*own[k].split()[:-1], word()])
        rows.append((500 + i, "\n".join([*own, base[-1]])))
        want[500 + i] = 1
    assert removed(spark, rows) == want


@pytest.mark.parametrize("bound", [16, 10_000])
def test_lines_of_one_template_go_whatever_else_is_there(spark, monkeypatch, bound):
    """A field of frequent values does not keep the lines of a template apart, below and above the bound of a leaf: 400 lines, more by
    others that share their first words."""
    monkeypatch.setattr(lines, "LEAF", bound)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    days, towns = [word() for _ in range(20)], [word() for _ in range(20)]
    spread = [(a, b) for a in days for b in towns]
    rows = foot_rows(lambda i: f"Seen by us on {spread[i][0]} in the town of {spread[i][1]} again", n=400)
    assert set(removed(spark, rows).values()) == {1}


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 1, 1]) == [100, 100, 100]
    assert mixing.targets([10, 100, 100], [3, 1, 1]) == [30, 90, 90]
    assert mixing.targets([10, 20, 270], [3, 3, 1]) == [30, 60, 210]
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0, 0]


def test_permutation_and_shards():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 5).tolist()) == list(range(n))
    totals = np.array([1000, 0, 37])
    parts = [mixing.shard_counts(totals, 7, s, 1) for s in range(7)]
    assert (sum(p[0] for p in parts) == totals).all()
    assert all((b[1] == a[1] + a[0]).all() for a, b in zip(parts, parts[1:], strict=False))


@pytest.mark.parametrize("sources", [mixing.MOST_SOURCES, 2])
def test_mix_recomputed(spark, docs, rows, monkeypatch, sources):
    """Every document's words, from its place in its source and from the blocks that the draws name, recomputed row by row."""
    monkeypatch.setattr(mixing, "MOST_SOURCES", sources)
    block, seed = 8, 20
    m = mixing.Mix(docs, block=block, seed=seed)
    got = {r.doc_id: (r["size"], r.source_size, pytest.approx(r.target), r.taken) for r in m.taken().collect()}
    names = ["a", "b", None]
    own = {s: sorted((r[0], len(words(r[1]))) for r in rows if r[3] == s) for s in names}
    size = [sum(n for _, n in own[s]) for s in names]
    goal = mixing.targets(size, [1, 2, 3])
    assert {r.source: r.target for r in m.plan.collect()} == pytest.approx(dict(zip(names, goal, strict=True)))
    blocks = [-(-n // block) for n in size]
    slots = [min(round(t * b / n), 3 * b) for t, b, n in zip(goal, blocks, size, strict=True)]
    want = {}
    for i, s in enumerate(names):
        lot, at = divmod(i, sources) if sources < 3 else (0, i)
        mine = slots[lot * sources : (lot + 1) * sources] if sources < 3 else slots
        assert sum(mine) <= mixing.SHARD  # one shard: it takes all
        taken = [0] * blocks[i]
        for k in range(slots[i]):
            taken[mixing.permuted(np.array([k % blocks[i]]), blocks[i], seed + lot * sources * (sources < 3) + at)[0]] += 1
        start = 0
        for d, n in own[s]:
            want[d] = (n, size[i], goal[i], sum(taken[w // block] for w in range(start, start + n)))
            start += n
    assert got == want


def test_mix(spark, docs, rows):
    m = mixing.Mix(docs, block=8)
    got = sorted(m.taken().collect(), key=lambda r: r.doc_id)
    size = {r[0]: len(words(r[1])) for r in rows}
    by = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in ("a", "b", None)}
    goal = dict(zip(("a", "b", None), mixing.targets([by["a"], by["b"], by[None]], [1, 2, 3]), strict=True))
    source = {r[0]: r[3] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        assert (r["size"], r.source_size) == (size[r.doc_id], by[source[r.doc_id]]) and r.target == pytest.approx(goal[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r["size"]
    for s in by:
        assert sum(r.taken for r in got if source[r.doc_id] == s) == pytest.approx(goal[s], abs=16)
    again = sorted(mixing.Mix(docs.repartition(7), block=8).taken().collect(), key=lambda r: r.doc_id)
    assert again == got
    taken = {r.doc_id: r.taken for r in got}
    texts = {r.doc_id: r for r in m.texts(docs).collect()}
    assert set(texts) == {i for i, n in taken.items() if n}
    for i, r in texts.items():
        assert len(words(r.text)) == taken[i] and r.n_chars == len(r.text)


def test_mix_edges(spark):
    clash = "doc_id long, text string, source string, src int, block long, copies long"
    rows = [(None, "a b c", None, 1, 1, 1), (1, None, "s", 1, 1, 1), (1, None, "s", 1, 1, 1), (2, "x y z " * 50, "s", 1, 1, 1), (2, "x y z " * 50, "s", 1, 1, 1)]
    df = spark.createDataFrame(rows, clash)
    m = mixing.Mix(df, block=4)
    assert sorted((str(r.doc_id), r["size"]) for r in m.taken().collect()) == [("1", 0), ("1", 0), ("2", 150), ("2", 150), ("None", 3)]
    assert m.texts(df).columns == df.columns and m.texts(df).count() >= 2
    assert mixing.Mix(spark.createDataFrame([], clash)).taken().collect() == []


def test_mix_rows_of_one_id(spark):
    """Rows with no id, or with one that repeats, get the words of their own blocks, whatever their sizes and sources."""
    text = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    rows = [(None, text("a", 2000), "a"), (None, text("b", 100), "b"), (None, text("c", 70), "b"), (7, text("d", 900), "a"), (7, text("e", 30), "b"), (7, text("f", 30), "b")]
    df = spark.createDataFrame([*rows, rows[2], rows[2]], "doc_id long, text string, source string").repartition(3)
    m = mixing.Mix(df, block=16)
    want = sorted(r.taken for r in m.taken().collect() if r.taken)
    out = m.texts(df).collect()
    assert sorted(len(words(r.text)) for r in out) == want
    # Each text is of its own row's words, and what is taken of a row adds up with the plan's sizes.
    size = {"abcdef"[i]: len(words(r[1])) for i, r in enumerate(rows)}
    taken = {}
    for r in m.taken().collect():
        taken.setdefault((r.doc_id, r["size"]), []).append(r.taken)
    got = {}
    for r in out:
        tags = {w[0] for w in words(r.text)}
        assert len(tags) == 1
        got.setdefault((r.doc_id, size[tags.pop()]), []).append(len(words(r.text)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(x for x in v if x) for k, v in taken.items() if any(v)}


def test_quality(spark):
    rng = random.Random(1)
    vocab = ["the", "old", "river", "runs", "past", "a", "small", "town", "and", "its", "mill"]
    good = lambda n: " ".join(rng.choice(vocab) for _ in range(n)).capitalize() + "."
    bad = lambda n: " ".join(rng.choice(vocab).upper() + rng.choice(["!!", "%%%", "$$"]) for _ in range(n))
    rows = [(i, good(rng.randint(5, 400)) if i % 4 else bad(rng.randint(5, 400))) for i in range(400)] + [(1000, None), (1001, ""), (None, "the old river"), (0, "the old river")]
    labels = [(i, int(i % 4 > 0), 0) for i in range(400)] + [(None, 1, 0), (1000, None, 0), (7, 1, 0)]
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(docs, lab)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 > 0) for r in got if r.doc_id is not None and 0 < r.doc_id < 400]) > 0.97
    assert sorted(r.score for r in quality.score(docs, quality.fit(docs.repartition(5), lab)).collect()) == pytest.approx(sorted(r.score for r in got))
    kept = quality.accepted(docs.withColumn("score", docs["doc_id"]), model)
    assert kept.columns == ["doc_id", "text", "score"] and 290 < kept.count() < 320
    assert quality.score(docs.limit(0), model).collect() == []
    none = quality.fit(docs, lab.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}


def test_gradient():
    rng = np.random.default_rng(3)
    m = quality.Model()
    x, first, y = rng.normal(size=(9, quality.FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    loss = lambda: -np.mean(y * np.log(m.forward(x, first)["y"]) + (1 - y) * np.log(1 - m.forward(x, first)["y"]))
    for k, g in m.gradient(x, first, y).items():
        at = tuple(rng.integers(0, n) for n in g.shape)
        old = m.p[k][at]
        m.p[k][at] = old + 1e-5
        up = loss()
        m.p[k][at] = old - 1e-5
        assert g[at] == pytest.approx((up - loss()) / 2e-5, abs=1e-6)
        m.p[k][at] = old


ODD = ["a", "the", "ing", " ", "\n", "é", "Σ", "ΣΑΣ ", "İ", "中", "한글", "👍🏽", "<|endoftext|>", "<|startoftext|>", "'s", "'", "12", "½", "\x00", "\x1c", "\x85", "\xa0", "!", "%%%", "ẞ", "ﬁ", "don't"]


def test_bpe_against_library(spark, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    rng = random.Random(6)
    texts = [r[1] for r in rows] + ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    texts += ["".join(rng.choice(["th", "er", "a", "ation", "é", "z"]) for _ in range(900)), "ab" * 700, "!" * 900, "words and words " * 9000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "x", 1)], "doc_id long, text string, ids int")
    got = bpe.round_trip(df, path).collect()
    assert len(got) == len(texts) + 1
    assert sorted(map(str, bpe.decode(bpe.encode(df, path), path).collect())) == sorted(map(str, got))
    for r in got:
        want = lib.encode((texts[r.doc_id] if r.doc_id is not None else "x") or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.text == lib.decode(want, skip_special_tokens=False)
    assert bpe.round_trip(df.limit(0), path).collect() == []


def library(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    return bpe.Bpe(path), lib


def test_bpe_of_every_code_point():
    """Every code point in a word, alone, after an apostrophe and in upper case's place."""
    own, lib = library("word_bpe_49k.json")
    steps = [*range(0, 0x400, 4), *range(0x400, 0x110000, 512)]
    texts = ["".join(f"aA{chr(c)}b {chr(c)} '{chr(c)}s" for c in range(at, end) if not 0xD800 <= c < 0xE000) for at, end in zip(steps, [*steps[1:], 0x110000], strict=True)]
    for text, e in zip(texts, lib.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == e.ids, hex(ord(text[2]) if len(text) > 2 else 0)


def test_bpe_of_long_runs(monkeypatch):
    """Runs without a blank, read in small pieces: borders inside pre-tokens, contractions, marks and Hangul."""
    own, lib = library("word_bpe_49k.json")
    rng = random.Random(8)
    parts = ["a", "'", "'s", "'re", "'ll", "é", "e\u0301", "\u0301", "각", "\u1100\u1161\u11a8", "7", "!", "!!", "中", "\u16d67\U00016d67", "Σ", "the", "İ", "<|endoftext|>", " ", "\n"]
    for piece in (1, 5, 64):
        monkeypatch.setattr(bpe, "PIECE", piece)
        for kinds in (parts, parts[:-3], parts[:5], ["a", "b", "th"], ["!", "'", "%"]):
            for n in (1, 7, 60, 700):
                text = "".join(rng.choice(kinds) for _ in range(n))
                want = lib.encode(text, add_special_tokens=False).ids
                got = own.encode(text)
                assert np.frombuffer(got, "<u4").tolist() == want, (piece, text)
                assert own.decode(got) == lib.decode(want, skip_special_tokens=False)


def test_decoding_machine(monkeypatch):
    """Where tokens are bytes, a character that is cut between them waits for its rest."""
    own, lib = library("byte_bpe_50k.json")
    text = "한글 👍🏽 naïve 中文 \x00 x" * 5
    ids = lib.encode(text, add_special_tokens=False).ids
    for piece in (1, 2, 1 << 16):
        monkeypatch.setattr(bpe, "PIECE", piece)
        assert own.decode(np.array(ids, "<u4").tobytes()) == text
        cut = np.array(ids[:-3] + ids[2:9], "<u4")
        assert own.decode(cut.tobytes()) == lib.decode(cut.tolist(), skip_special_tokens=False)


def test_transducer():
    """Against plain merging, for made-up merges; what is held back does not grow with the run of symbols."""
    rng = random.Random(3)
    for suffix in ("", "$"):
        for _ in range(30):
            have, merges = list("abc") + [c + suffix for c in "abc" if suffix], []
            for _ in range(rng.randint(1, 25)):
                a, b = rng.choice([x for x in have if not suffix or not x.endswith(suffix)]), rng.choice(have)
                if (a, b) not in merges:
                    merges.append((a, b))
                    have.append(a + b)
            t = bpe.Transducer(merges, suffix)
            for n in (1, 2, 5, 12, 200):
                word = "".join(rng.choice("abc") for _ in range(n))
                want = t.merged([*word[:-1], word[-1] + suffix])[0]
                run = t.open()
                assert t.encode(word) == want == [*run.push(word), *run.close()]
    t = bpe.Transducer([("a", "b"), ("ab", "ab"), ("b", "a"), ("abab", "abab"), ("c", "abab")])
    assert t.lookahead == 8
    run, most = t.open(), 0
    for _ in range(1000):
        list(run.push("abcab"))
        most = max(most, len(run.held), len(run.last))
    assert most < 200


def test_digest_columns(spark, rows, docs):
    out = {r.doc_id: r for r in substrings.drop_repeats(docs).collect()}
    want = cut_repeats([r if r[1] is not None else (r[0], "", *r[2:]) for r in rows])
    assert {i: hashlib.sha256(r.kept.encode()).hexdigest() for i, r in out.items()} == {i: hashlib.sha256(k[2].encode()).hexdigest() for i, k in want.items()}


def test_quality_passes_labels_of_other_documents_over(spark):
    """Far more labels than documents, and than the sample: the labelled documents are found all the same."""
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["house", "river", "table", "green"]) for _ in range(80))
    bad = lambda: " ".join(rng.choice(["##$$", "!!!", "%%", "1 2"]) for _ in range(80))
    docs = spark.createDataFrame([(i, good() if i % 2 else bad()) for i in range(200)], "doc_id long, text string")
    labels = spark.range(100_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    got = quality.score(docs, quality.fit(docs, labels, sample=300)).collect()
    assert sum((r.score >= 0.5) == bool(r.doc_id % 2) for r in got) >= 195


def test_repeats_of_many_texts_without_an_id(spark):
    """Null ids: each text but the first of its hash loses what they share, whatever other hashes have in common."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for _ in range(300):
        shared = " ".join(word() for _ in range(20))
        rows += [(None, f"{word()} {shared}"), (None, f"{word()} {word()} {shared}")]
    out = substrings.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert out.agg({"n_removed": "sum"}).collect()[0][0] == 300 * 20
