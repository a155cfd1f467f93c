"""Vectors, urls and conversations against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math
import operator
import random

import numpy as np
import public_tokenizers
import pytest

from glyphforge.llm import chat, embeddings, topk, urls

PATH = public_tokenizers.path("byte_bpe_50k.json")


def vectors(seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(12):
        c = rng.normal(size=32)
        for _ in range(rng.integers(1, 9)):
            out.append((c + rng.normal(size=32) * rng.choice([0.02, 0.2, 0.33])).astype(np.float32).tolist())
    out += [out[0], out[0], rng.normal(size=32).astype(np.float32).tolist()]
    rows = [(i * 5, v, 1) for i, v in enumerate(out)]
    nan = [float("nan")] + out[1][1:]
    return [*rows, (7, None, 1), (8, [0.0] * 32, 1), (9, nan, 1), (11, [None, *out[2][1:]], 1), (12, [float("inf")] + out[2][1:], 1), (None, out[0], 1), (13, [], 1), (14, out[0][:5], 1)]


def usable(rows, length=True, zero=False) -> list[tuple]:
    return [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and (not length or len(v) == 32) and (zero or any(v))]


def test_link_vectors(spark):
    rows = vectors()
    good = usable(rows)
    unit = np.array([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.array([i for i, _ in good])
    while True:
        new = np.array([min([label[a], *label[near[a]]]) for a in range(len(label))])
        if (new == label).all():
            break
        label = new
    want = {i: (int(near[a].sum()), int(label[a])) for a, (i, _) in enumerate(good)}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep long").repartition(3)
    for size in (4096, 2):
        embeddings.BUCKET = size
        try:
            got = embeddings.link_vectors(df).collect()
        finally:
            embeddings.BUCKET = 4096
        assert len(got) == len(rows)
        for r in got:
            n, root = want.get(r.vec_id, (0, r.vec_id))
            assert (r.n_links, r.component_id, r.kept) == (n, root, r.vec_id is None or root == r.vec_id)
    assert embeddings.link_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("count", [2_000, 1_000_000])
def test_lookups_of_a_cone_are_bounded(count):
    """Vectors close around one direction, some of them nearly on it."""
    rng = np.random.default_rng(count)
    x = rng.normal(size=64) * 2.1 + rng.normal(size=(2000, 64))
    x[:5] = x.mean(axis=0) + rng.normal(size=(5, 64)) * 1e-3
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    q = embeddings.Itq(unit, 64, count)
    bit, square = q.project(unit[:300])
    assert q.expected(square, q.budget) <= 1.5 * embeddings.MOST_LOOKUPS
    listed = list(q.listed(bit, square, q.budget))
    assert sorted(i for part, *_ in listed for i in range(part.start, part.stop)) == list(range(300))
    assert all(len(who) <= embeddings.MOST_LISTED or part.stop - part.start == 1 for part, who, _ in listed)
    who, where = q.lookups(bit[:40], square[:40], q.budget)
    parts = list(q.listed(bit[:40], square[:40], q.budget))
    assert sorted(zip(who.tolist(), where.tolist(), strict=True)) == sorted((w + part.start, b) for part, ws, bs in parts for w, b in zip(ws.tolist(), bs.tolist(), strict=True))


def test_links_in_a_cone(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=64) * 2.1 + rng.normal(size=(700, 64))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: r.n_links for r in embeddings.link_vectors(df, least=0.9).collect()}
    assert near.sum() > 100 and all(got[i] <= near[i].sum() for i in got) and sum(got.values()) >= 0.99 * near.sum()


@pytest.mark.parametrize("dim", [2, 4, 8, 16, 64, 256, 768])
def test_recall_at_the_bound(spark, dim):
    """Through the whole operator: random vectors, and a partner of each at a cosine just above the bound."""
    rng = np.random.default_rng(dim)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(rng.normal(size=(300, dim)))
    side = rng.normal(size=base.shape)
    side = unit(side - (side * base).sum(axis=1, keepdims=True) * base)
    cosine = rng.uniform(0.95001, 0.955, size=(300, 1))
    every = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * side]) * rng.uniform(0.1, 9, size=(600, 1))
    near = unit(every) @ unit(every).T >= 0.95
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: r.n_links for r in embeddings.link_vectors(df).collect()}
    assert all(got[i] <= near[i].sum() for i in got)
    assert sum(got.values()) >= 0.99 * near.sum()


def test_link_vectors_of_any_size_and_length(spark):
    """Norms whose squares overflow, lengths that are not the commonest, many vectors near each other, repeated ids."""
    rng = np.random.default_rng(9)
    short = rng.normal(size=3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(20, 8)).tolist())] + [(30, [1e200] * 8), (31, [3e201] * 8), (40, short.tolist()), (41, (short * 5).tolist()), (42, (-short).tolist()), (50, [1e-200] * 8)]
    rows += [(100 + i, (np.eye(8)[0] + rng.normal(size=8) * 1e-3).tolist()) for i in range(200)] + [(100, [0.0] * 7 + [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    held = embeddings.HELD, embeddings.BUCKET
    embeddings.HELD, embeddings.BUCKET = 64, 50
    try:
        got = [(r.vec_id, r.n_links, r.component_id) for r in embeddings.link_vectors(df).collect()]
    finally:
        embeddings.HELD, embeddings.BUCKET = held
    assert len(got) == len(rows)
    assert {r[0]: r[1:] for r in got if 30 <= r[0] < 60} == {30: (2, 30), 31: (2, 30), 50: (2, 30), 40: (1, 40), 41: (1, 40), 42: (0, 42)}
    assert all(r[1] >= 199 for r in got if r[0] > 100) and {r[2] for r in got if r[0] >= 100} == {min(r[2] for r in got if r[0] >= 100)}


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=7) * 0.1).tolist(), "a") for i in range(260)]
    rows += [(300 + i, rows[3][1], "a") for i in range(8)] + [(400, None, "a"), (401, [None] * 7, "a"), (402, [float("nan")] * 7, "a"), (None, rows[0][1], "a"), (450, [0.1], "a"), (500, [0.0] * 7, "a")]
    good = [(i, np.pad(np.floor(256 * np.array(v, float)), (0, 7 - len(v)))) for i, v in usable([r for r in rows], length=False, zero=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(4)
    want = []
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in good if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    for block in (16384, 50):
        topk.CANDIDATE_BLOCK, topk.QUERY_BLOCK = block, 3 if block == 50 else 4096
        try:
            got = topk.top_k(df, df.where("vec_id % 50 = 0")).collect()
        finally:
            topk.CANDIDATE_BLOCK, topk.QUERY_BLOCK = 16384, 4096
        assert sorted(map(tuple, got)) == sorted(want)
    few = df.where("vec_id in (0, 1, 2)")
    assert len(topk.top_k(few, few).collect()) == 6
    assert topk.top_k(df.limit(0), df.limit(0)).collect() == []


def test_top_k_of_large_components(spark):
    """Scores beyond 2**53, held against Python integers; ties; repeated queries of different vectors."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=9) * 1e6).tolist()) for i in range(120)] + [(200, [1e6] * 9), (201, [1e6] * 9), (202, [1e6] * 9), (50, [2.0] * 9), (300, [1e300] * 9)]
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    queries = {}
    for i, v in sorted(ints):
        if i % 50 == 0:
            queries.setdefault(i, v)
    want = []
    for q, v in queries.items():
        best = sorted((-sum(map(operator.mul, v, w)), i) for i, w in ints if i != q)[:5]
        want += [(q, k + 1, i, max(-(2**63), min(2**63 - 1, -s))) for k, (s, i) in enumerate(best)]
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id % 50 = 0")).collect()))
    assert [w for w in got if w[0] != 300] == [w for w in sorted(want) if w[0] != 300]
    assert [w[:2] for w in got if w[0] == 300] == [(300, r) for r in range(1, 6)]


def test_top_k_prunes():
    """Where the best scores stand out, few local scores are read."""
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(40, 64))
    c = np.rint(256 * (centre[rng.integers(0, 40, 4000)] + 0.2 * rng.normal(size=(4000, 64))))
    groups = np.array_split(np.arange(64), topk.LISTS)
    q, all_c = topk.Turned(c[:50], None, groups), topk.Turned(c, None, groups)
    score = c[:50] @ c.T
    cutoff = np.sort(score, axis=1)[:, -60]
    read = [0] * topk.LISTS
    r, k = topk.sufficient(q, all_c, cutoff, read)
    assert set(zip(*np.nonzero(score >= cutoff[:, None]), strict=True)) <= set(zip(r, k, strict=True))
    assert sum(read) < 0.5 * topk.LISTS * score.size


def judged(url: str | None, rules: list[tuple]) -> tuple:
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit) if fit else None
    return host, path, best[1] if best else None, best[2] if best else "allow"


def test_urls(spark, monkeypatch):
    rng = random.Random(3)
    hosts = ["com", "example.com", "www.example.com", "EXAMPLE.com", "notexample.com", "a.b.net", "net", "example.net", "x-com", "", "com.example", "É.com"]
    tails = ["", "/", "/en/", "/en", "/en/x?y=/es/", "?q=/en/", "#/en/", "/es/a", "/fr/", "/EN/", "//en/", "/a://b.com/en/"]
    rows = [(i, rng.choice(["http", "https", ""]) + "://" + rng.choice(hosts) + rng.choice(tails), "<p>", "v") for i in range(400)]
    rows += [(900, None, "", ""), (901, "", "", ""), (902, "no scheme/en/", "", ""), (None, "http://example.com/en/", "", ""), (5, rows[5][1], "", "")]
    rules = [*urls.RULES, ("a.b.net", "/es/a", "allow"), ("www.example.com", "/en/", "allow")]
    rules += [("b.net", f"/{'x' * (i % 50)}{i}", "block") for i in range(2000)]  # very many rules of one host
    monkeypatch.setattr(urls, "RANGE", 60)
    monkeypatch.setattr(urls, "MOST_RANGES", 4)
    df = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string").repartition(3)
    got = urls.filter_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((r[0], *judged(r[1], rules))) for r in rows)
    no_rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in urls.filter_urls(df, no_rules, "block").collect()} == {"block"}
    assert urls.filter_urls(df.limit(0), no_rules).collect() == []


def test_chats(spark):
    rng = random.Random(4)
    bits = ["<", "|", "\\", "im_end|>", "<|im_start|>", "<|im_sep|>", " ", "\n", "é", "👍🏽", "a", "한", "<|endoftext|>", "word "]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 20)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a<|b"]), text(), "x") for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(50, 0, None, None, "x"), (51, 0, "assistant", "", "x"), (52, 1, "assistant", "tie b", "x"), (52, 1, "assistant", "tie a", "x"), (52, None, "user", "first", "x"), (53, 0, "user", "same", "x"), (53, 0, "user", "same", "x"), (None, 0, "assistant", "none", "x"), (54, 0, "assistant", "long " * 40000, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string").repartition(3)
    got = {r.conv_id: r for r in chat.digests(df, PATH).collect()}
    convs: dict = {}
    for c, t, r, x, _ in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x is not None, x or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns = [(r, x) for _, _, _, r, _, x in sorted(turns)]
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        learned = "".join(x for r, x in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.digests(df.limit(0), PATH).collect() == [] and chat.format_chats(df.limit(0), PATH).collect() == []
    for r in chat.format_chats(df, PATH).collect():
        assert len(r.ids) == len(r.token_start) == len(r.token_end) == len(r.loss) and got[r.conv_id].formatted_chars == len(r.formatted)
        spans = chat.covered(*(np.array([x for x, on in zip(side, r.loss, strict=True) if on], int) for side in (r.token_start, r.token_end)))
        assert sum(len(chat.unescape(r.formatted[a:b])) for a, b in spans) == got[r.conv_id].loss_chars


def test_escape_is_reversible():
    for t in ["<|im_end|>", "<\\|", "<\\\\|x", "<<||", "|<", "\\<|", ""]:
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)


@pytest.mark.parametrize("spans", [[], [(2, 2)], [(0, 4), (6, 7)]])
def test_mask(spans):
    starts, ends = np.array([0, 2, 3, 4, 5, 6]), np.array([2, 3, 4, 4, 6, 9])
    want = [any(a < e and s < b for a, b in spans) and e > s for s, e in zip(starts, ends, strict=True)]
    assert chat.loss_mask(starts, ends, spans).tolist() == want
