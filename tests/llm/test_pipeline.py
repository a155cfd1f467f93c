"""The pipeline's stages on the small tables: what each decides is checked on its own input."""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from glyphforge.llm import mixing

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs.toPandas().set_index("doc_id"))]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, spark.createDataFrame(out[-1][1].reset_index()) if len(out) > 1 else docs, SF)
        out.append((name, docs.toPandas().set_index("doc_id")))
    return dict(out)


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "mix_sources", "bpe_tokens"]
    for name in ("quality_classifier", "line_dedup", "near_dedup", "mix_sources"):
        assert list(stages[name].columns) == list(stages["documents"].columns)


def test_quality_keeps_good_documents(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = labels.index.isin(stages["quality_classifier"].index)
    assert kept[labels == 1].mean() > 0.97 and kept[labels == 0].mean() < 0.4
    assert (stages["quality_classifier"].text == stages["documents"].text.loc[stages["quality_classifier"].index]).all()


def test_line_dedup_only_cuts_lines(stages):
    before, after = stages["quality_classifier"].text, stages["line_dedup"].text
    for i, t in after.items():
        own = iter(before[i].split("\n"))
        assert all(any(line == x for x in own) for line in t.split("\n"))


def test_near_dedup_leaves_one_of_each_group(stages):
    before, after = stages["line_dedup"].text, stages["near_dedup"].text
    sets = {}
    for i, t in before.items():
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    assert set(after.index) == {i for i in ids if find(i) == i}


def test_mix_follows_targets(stages):
    before, after = stages["near_dedup"], stages["mix_sources"]
    n = lambda d: d.text.map(lambda t: len(WORD.findall(t))).groupby(d.source).sum()
    size = n(before)
    goal = mixing.targets(size.tolist(), [(1, 2, 3)[i % 3] for i in range(len(size))])
    got = n(after).reindex(size.index, fill_value=0)
    assert np.abs(got - goal).max() <= 2 * 512


def test_tokens(stages):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.no_truncation()
    lib.no_padding()
    for i, r in stages["bpe_tokens"].iterrows():
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(stages["mix_sources"].text[i], add_special_tokens=False).ids


def test_run_and_registration(spark, stages):
    got = corpus_pipeline.run(spark, SF).toPandas().set_index("doc_id").sort_index()
    assert got.index.tolist() == stages["bpe_tokens"].sort_index().index.tolist()
    assert (got.n_tokens == stages["bpe_tokens"].n_tokens.sort_index()).all()
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)


ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, print long, block int, once0 string, root string"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, name):
    """Nulls in every column, empty and long texts, repeated rows and ids, extra columns of the operators' own names; an empty table."""
    stage = dict(corpus_pipeline.STAGES)[name]
    prose = " ".join(f"{a}{b}" for a in ("so", "much", "text", "here") for b in ("er", "ly", "ness", "", "ing"))
    extra = (0.5, 1, 1, "x", "y")
    rows = [(None, None, None, None, None, None, None, None, None, None), (None, prose, "en", None, 9, *extra), (1, "", "en", "a", 0, *extra), (2, ("long and long again\n" * 5 + "word ") * 3000, "en", "a", 9, *extra)]
    rows += [(3, prose, "en", "b", 9, *extra)] * 2 + [(3, f"other {prose[::-1]}", "en", "b", 9, *extra), (4, prose, None, "b", None, *extra), (5, " \n\t ", "en", "", 4, *extra)]
    df = spark.createDataFrame(rows, ODD)
    out = stage(spark, df, SF)
    got = out.collect()
    if name == "bpe_tokens":
        assert len(got) == len(rows) and {r.n_tokens for r in got if not (r.text or "").strip()} == {0}
    else:
        assert out.columns == df.columns
        key = lambda r: tuple(map(str, (r[0], *r[2:4], *r[5:])))
        assert {key(r) for r in got} <= {key(r) for r in rows}
    if name == "near_dedup":  # of equal sets the smallest id stays, rows of one id together; without an id, or words, all do
        assert sorted(str(r.doc_id) for r in got) == sorted(map(str, [None, None, 1, 2, 3, 3, 3, 5]))
    if name == "line_dedup":
        assert len(got) == len(rows) and all((a.text is None) == (a.source is None and a.lang is None) for a in got)
    assert stage(spark, df.limit(0), SF).collect() == []
