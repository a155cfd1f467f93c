"""Whitening, quality rules and fill-in-middle against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from glyphforge.llm import infill, rules, whitening

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# ---- whitening


def floors(v) -> list[int] | None:
    if v is None or any(c is None or not math.isfinite(c) for c in v):
        return None
    return [math.floor(max(-(2.0**61), min(2.0**61, c * 64))) + 1_000_000 for c in v]


def brute_whitening(rows):
    """[(id, n, deviation, whitened by component)], and the explained shares; all sums as whole numbers or fractions."""
    xs = [(i, floors(v)) for i, v in rows]
    xs = [(i, x) for i, x in xs if x is not None]
    dim = max((len(x) for _, x in xs), default=0)
    xs = [(i, tuple(x + [1_000_000] * (dim - len(x)))) for i, x in xs]
    fit = sorted({x for _, x in xs})
    n = len(fit)
    s = [sum(c) for c in zip(*fit, strict=True)]
    y = [[n * a - b for a, b in zip(x, s, strict=True)] for x in fit]
    v = np.array([[float(Fraction(sum(r[a] * r[b] for r in y), n**3)) for b in range(dim)] for a in range(dim)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for i, x in xs:
        d = [n * a - b for a, b in zip(x, s, strict=True)]
        out.append((i, n, sum(t * t for t in d), (np.array([float(Fraction(t, n)) for t in d]) @ u) / np.sqrt(np.maximum(e, 1e-300))))
    return out, e / e.sum()


@pytest.mark.parametrize(("dim", "scale"), [(5, 1.0), (24, 3.0), (6, 1e5), (4, 1e14)])
def test_whitening(spark, dim, scale):
    """Scales of 1e5 and 1e14 take two and three limbs; a third of the rows are copies."""
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(150, dim)) * np.linspace(1, 3, dim) * scale
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[0].tolist()) for i in range(80)]
    rows += [(2000, None), (2001, [float("nan")] * dim), (2002, [None] + [1.0] * (dim - 1)), (2003, [float("-inf")] + [1.0] * (dim - 1)), (None, base[1].tolist()), (3, base[2].tolist())]
    df = spark.createDataFrame([(*r, 1, 2.0, "t") for r in rows], "vec_id long, embedding array<double>, n int, whitened double, x string").repartition(5)
    got = whitening.whiten(df).collect()
    want, share = brute_whitening(rows)
    k = min(16, dim)
    assert len(got) == len(want) * k
    by: dict = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
        assert r.n == 150 and abs(r.identity_error) < 1e-9 and r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
    sign = {}
    for i, _, deviation, w in want:
        assert any(int(r.deviation) == deviation for r in by[i])
        for r in by[i]:
            if int(r.deviation) == deviation and abs(w[r.component - 1]) > 1e-3:
                ratio = r.whitened / w[r.component - 1]
                assert abs(abs(ratio) - 1) < 1e-6
                assert sign.setdefault(r.component, ratio > 0) == (ratio > 0)


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).collect() == []
    got = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()  # one distinct vector
    assert len(got) == 4 and all((r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) == (1, 0, None, 0.0, 0.0) for r in got)
    got = whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 0.0]), (3, [3.0, 0.0]), (4, [])], schema)).collect()  # filled up with zeros
    assert {(r.vec_id, r.n) for r in got} == {(1, 3), (2, 3), (3, 3), (4, 3)}
    assert sorted(r.component for r in got if r.whitened is None) == [2] * 4
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 5.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert len(huge) == 6 and all(r.deviation is None or r.deviation >= 0 for r in huge)


def test_limbs_and_gram():
    rng = np.random.default_rng(0)
    for top in (100, 2**30, 2**61):
        z = rng.integers(-top, top, size=(5000, 3))
        digits = whitening.limbs(z)
        assert all(np.abs(d).max() <= 2 ** (whitening.LIMB - 1) for d in digits)
        back = sum(d.astype(np.int64).astype(object) * (1 << (whitening.LIMB * k)) for k, d in enumerate(digits))
        assert (back == z).all()
        gram = whitening.Gram(3)
        gram.add(z)
        wide = z.astype(object)
        assert (gram.fold() == wide.T @ wide).all()
    numbers = [0, -1, 2**300, -(2**300)]
    assert whitening.unpacked(whitening.packed(numbers)) == numbers


def test_whitened_query(spark):
    got = whitening.op11_whitening(spark, SF).toPandas()
    ids = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert len(got) == ids * 16 and got.identity_error.max() < 1e-9 and (got.deviation >= 0).all()
    assert dict(got.dtypes)["deviation"] == np.int64


# ---- quality rules


def brute_measures(text: str | None) -> tuple:
    t = text or ""
    words = WORD.findall(t)
    at = {}
    for k in range(len(words) - 2):
        at.setdefault(tuple(words[k : k + 3]), []).append(k)
    again = {k + j for places in at.values() if len(places) > 1 for k in places for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    bare = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
    count = lambda chars: sum(c in chars for c in t)
    caps = sum("A" <= c <= "Z" for c in t)
    letters = sum(any(c.isascii() and c.isalpha() or not c.isascii() for c in w) for w in words)
    return (
        len(words), sum(map(len, words)), len(lines), count("#*$%&|<>"), len(lines) - len(set(lines)), len(again), caps, count("!?"), letters,
        sum(x[0] in "-*" for x in bare), sum(x.endswith("...") for x in bare),
    )


def brute_failed(m: tuple) -> int:
    v = dict(zip(rules.MEASURES, m, strict=True))
    return sum(1 << k for k, (_, fails) in enumerate(rules.RULES) if eval(fails, {}, v))  # noqa: S307


TEXTS = [
    None, "", " \n\t\n ", "one", "a b c a b c", "a a a a a a", "- x\n* y\n- x\n\n- x ", "so...\nso...\n..\n .. .\n...", "é ü ß 漢字  x y z", "A! B? C# <D> E|F $5 %", "x" * 50000,
    "line\r\nline\r\nline", "\n\n\n", "w1 w2 w3\nw1 w2 w3", "\ta\x0bb\x0cc\rd", "one two three " * 40, "🙂 🙂 🙂 🙂", " ".join(f"word{k}" for k in range(60)), "\x00 \x00 \x00 \x00", "SHOUT " * 30 + " ".join(f"Q{k}" for k in range(60)),
]


def test_rules(spark):
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(list("ab \n.A!#-\té"), size=rng.integers(1, 400))) for _ in range(150)]
    rows = [(k if k % 7 else k // 7, t, "s", 1, 2) for k, t in enumerate(TEXTS + made)] + [(None, TEXTS[-1], None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int, failed int").repartition(3)
    got = rules.judged(rules.ledger(df)).collect()
    want = []
    for i, t, *_ in rows:
        m = brute_measures(t)
        f = brute_failed(m)
        base = m[0] < 50 or 100 * m[5] > 50 * m[0]
        want.append((i, *m, f, base, not base and f == 0))
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in got), key=lambda r: str(key(r))) == sorted(want, key=lambda r: str(key(r)))
    assert rules.ledger(df.limit(0)).collect() == [] and rules.ablation(rules.ledger(df.limit(0))).collect() == []


def test_measures_of_wide_keys():
    """Words of so many kinds that windows are ranked on the way."""
    import pyarrow as pa

    a = np.array([5, 2**40, 5, 7], np.int64)
    b = np.array([2**40, 5, 2**40, 0], np.int64)
    key = rules._joined(a, b)
    assert key[0] == key[2] and len(set(key.tolist())) == 3
    assert [m.tolist() for m in rules.measures(pa.array([], pa.string()))] == [[]] * len(rules.MEASURES)


def test_policies_and_ablation(spark):
    entries = rules.ledger(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    old = rules.Policy("clean", 1, ("symbols",))
    rows = [r.asDict() for r in entries.collect()]
    kept = {r.doc_id for r in rules.judged(entries, old).where("kept").collect()}
    assert kept == {r["doc_id"] for r in rows if not r["failed"] & (rules.BASE.mask | old.mask)}
    for r in rules.ablation(entries).collect():
        mask = next(p.mask for p in rules.POLICIES if (p.name, p.version) == (r.policy, r.version))
        bit = 1 << rules.BIT[r.rule]
        hit = [x["failed"] & mask for x in rows]
        assert (r.docs_failed, r.docs_alone, r.docs_kept, r.docs_kept_without) == (sum(h & bit > 0 for h in hit), sum(h == bit for h in hit), hit.count(0), sum(h & ~bit == 0 for h in hit))
        assert r.words_alone == sum(x["n_words"] for x, h in zip(rows, hit, strict=True) if h == bit)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r for r in rules.judged(entries).collect() if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert len(clean) > 30 and all(r.kept for r in clean)
    entries.unpersist()


# ---- fill in the middle


def brute_infill(i, text, plain=10, spm=20):
    t = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    n = len(units)
    hexed = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(hexed[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return i, n, "plain", None, None, t, t
    if h[3] % 100 < spm:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", t
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", t


@pytest.mark.parametrize(("plain", "spm"), [(10, 20), (0, 50), (100, 0)])
def test_fill_in_middle(spark, plain, spm):
    rng = np.random.default_rng(5)
    made = ["".join(rng.choice(list("abZ <>PSM1é漢🙂\n"), size=rng.integers(0, 60))) for _ in range(400)]
    texts = [*made, None, "", "<P>", "a<S>b", "<M", "<<P", "x" * 20000, "é" * 3000, "ab1 " * 5000, "\x00\x01"]
    rows = [(k, t, "x", 7) for k, t in enumerate(texts)] + [(None, "some text", None, None), (3, made[3], None, None), (3, "other", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, n int").repartition(3)
    out = infill.fill_in_middle(df, plain=plain, spm=spm)
    got = out.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    want = [brute_infill(i, t, plain, spm) for i, t, *_ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert infill.fill_in_middle(df.limit(0)).collect() == []


def test_ranked_bits():
    rng = np.random.default_rng(6)
    for width in (1, 2, 7, 64, 1001):
        row = int.from_bytes(rng.bytes(width // 8 + 1), "little") & ((1 << width) - 1)
        places = [k for k in range(width) if row >> k & 1]
        assert [infill.ranked(row, r, width) for r in range(len(places))] == places
        assert infill.ranked(row, len(places), width) == width
    assert infill.split(b"", (5, 9)) == (0, 0, 0, 0, 0)


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert {"op12_quality_rules", "op13_fill_in_middle"} <= set(__spark_entry__.oracle_sql())
