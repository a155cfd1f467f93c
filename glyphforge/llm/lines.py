"""Line dedup with a log-template tree.

A line is parsed at fixed depth. The first level of the tree is its number of tokens, where a token that holds a digit is a
variable field. The second is its leading tokens: the first quarter of them, or where that is a variable field too, as it is
found in fewer than `least` documents, the first of the other quarters that is not; a line without such a quarter recurs in
no way and is left out. So a leaf holds lines of one length that agree in some place. Within a leaf a line's tokens are put in
the order of how many documents have them there, in their place; those that fewer than `least` have are variable fields. A
template is SHARE of a line's tokens, KEEP at least (all, in shorter lines), that are neighbours in this order; all its other
places are variable fields. So a line has some templates, from its most frequent tokens to its least frequent ones, and those
that it shares with others are found by equality, in leaves of any size alike.

A template recurs if its lines are found in at least `least` different documents; lines of recurring templates are dropped, and so
are lines that recur themselves, however many of their tokens are variable.
Documents of the same words count once, and so do near copies, or else a group of them would lose all its lines: each
document has a MinHash sketch of its word 5-grams, and one that shares 11 of 16 slots with a group counts as that group
(see `families`). Boilerplate of any number of lines leaves documents different unless it makes about two thirds of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import Words, Workspace, column, give_back, lookup, map_batches, mix, window_hashes

#: Parts of a line that may choose its leaf.
PARTS = 4
#: Share, in percent, and least number of a line's tokens that its template must have in common with it.
SHARE, KEEP = 60, 3
#: Distinct lines of a leaf that one task weighs by itself; tokens of larger leaves are summed up by a shuffle, to the same templates.
LEAF = 512
_VARIABLE = np.uint64(1)  # the hash of a token that holds a digit
LEAST_DOCS = 4
#: Recurring parts and recurring lines up to this many (16 MB) go to every task; beyond it, they are joined with the lines.
BROADCAST = 2_000_000
#: Words of a gram, slots of a sketch, slots that a near copy shares with its group (two documents of similarity 0.8 have
#: about 0.9 of their grams in common with what they come from); up to so many copies (8 MB) go to every task.
GRAM, SLOTS, NEAR, COPIES = 5, 16, 11, 500_000
#: A document of fewer grams is a near copy only of one with the same: another gram each leaves a similarity below 0.8.
FEW = 9


class Lines:
    """The lines of a batch of texts: row, number within the row, byte range, number of tokens (and where those begin in `hashes`), a hash
    of the whole line and one of each of its PARTS quarters. The hash of nothing is 0."""

    def __init__(self, texts: pa.Array | Words):
        w = texts if isinstance(texts, Words) else Words(texts)
        self.raw, self.at = w.raw, w.at
        breaks = np.flatnonzero(w.raw == 10)
        row_of_break = np.searchsorted(w.at, breaks, "right") - 1
        rows = np.concatenate([row_of_break, np.arange(len(w.at) - 1)])
        starts = np.concatenate([breaks + 1, w.at[:-1]])
        order = np.argsort(starts, kind="stable")  # a line behind a row's last break begins where the next row does, and comes first
        self.row, self.start = rows[order], starts[order]
        n = len(self.row)
        self.first = np.searchsorted(self.row, np.arange(len(w.at)))
        self.end = np.empty(n, np.int64)
        last = self.first[1:] - 1
        self.end[:-1] = self.start[1:] - 1
        self.end[last] = w.at[1:]
        self.number = np.arange(n) - self.first[self.row]
        self.begin = np.append(np.searchsorted(w.starts, self.start), len(w.starts))
        self.tokens = np.diff(self.begin)
        self.hashes = h = w.hashes()
        h[np.searchsorted(w.starts, np.flatnonzero((w.raw >= 48) & (w.raw < 58)), "right") - 1] = _VARIABLE
        place = np.arange(len(h)) - np.repeat(self.begin[:-1], self.tokens)
        term = mix(h + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
        edges = self.begin[:-1, None] + -(-np.arange(PARTS + 1) * self.tokens[:, None] // PARTS)
        sums = np.diff(upto[edges], axis=1)
        count = (self.tokens.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))[:, None]
        parts = mix(sums + count + np.arange(1, PARTS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.parts = np.where(sums != 0, parts, np.uint64(0)).view(np.int64)
        self.whole = np.where(self.tokens > 0, mix(sums.sum(axis=1, dtype=np.uint64) + count[:, 0]), np.uint64(0)).view(np.int64)


class Sketches:
    """For each row of a batch of texts a fingerprint of its words, and SLOTS minima of hashes of its word 5-grams (of all words if fewer)."""

    def __init__(self, texts: pa.Array | Words, slots: bool = True):
        w = texts if isinstance(texts, Words) else Words(texts)
        h, first = w.hashes(), w.first
        n = np.diff(first)
        place = np.arange(len(h)) - np.repeat(first[:-1], n)
        term = mix(h + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
        print_ = mix(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        self.print = print_.view(np.int64)
        if not slots:
            return
        grams = np.zeros(len(h), np.uint64)
        full = window_hashes(h, GRAM)
        grams[: len(full)] = full
        inside = place + GRAM <= np.repeat(n, n)
        few = (n < GRAM) & (n > 0)
        inside[first[:-1][few]] = True
        grams[first[:-1][few]] = print_[few]
        grams, count = grams[inside], np.where(few, 1, np.maximum(0, n - GRAM + 1))
        self.some = np.flatnonzero(count)
        at = (np.cumsum(count) - count)[self.some]
        self.need = np.where(count < FEW, SLOTS, NEAR)[self.some]
        self.slots = np.empty((len(self.some), SLOTS), np.int64)
        for k in range(SLOTS if len(at) else 0):
            low = np.minimum.reduceat(mix(grams ^ np.uint64((k + 1) * 0xD6E8FEB86659FD93 & (2**64 - 1))), at)
            self.slots[:, k] = mix(low + np.uint64(k)).view(np.int64)


def families(docs: DataFrame, work: Workspace) -> DataFrame:
    """print, family: the documents (by fingerprint) that count as copies of another; no row for all others.

    A value of a slot names the least fingerprint that has it. A document belongs to the fingerprint that half of its slots name,
    if any; in a second round the values name the family that most documents with them belong to, and NEAR slots must name
    it (all, for documents of FEW grams). So copies are told by what they share with the core of their group, without chains of pairs and without a step that
    grows with its square.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = Sketches(column(batch, "text"))
        slots = pa.ListArray.from_arrays(pa.array(np.arange(0, x.slots.size + 1, SLOTS), pa.int32()), pa.array(x.slots.ravel()))
        return pa.record_batch({"print": pa.array(x.print[x.some]), "need": pa.array(x.need.astype(np.int32)), "slots": slots})

    prints = map_batches(docs.select("text"), run, "print long, need int, slots array<long>", text="text")
    rows = prints.groupBy("print").agg(F.first("need").alias("need"), F.first("slots").alias("slots"))
    rows = work.write(rows.select("print", "need", F.explode("slots").alias("slot")), "slots")

    def belong(named: DataFrame, least: Column) -> DataFrame:
        votes = rows.join(named, "slot").groupBy("print", "family").agg(F.count("*").alias("n"), F.min("need").alias("need")).where(F.col("n") >= least)
        return votes.groupBy("print").agg(F.min(F.struct(-F.col("n"), "family")).alias("best")).select("print", F.col("best.family").alias("family"))

    shared = rows.groupBy("slot").agg(F.count("*").alias("n"), F.min("print").alias("family")).where("n > 1").select("slot", "family")
    shared = work.write(shared, "shared")
    one = work.write(belong(shared, F.lit(SLOTS // 2)), "families-1")
    members = rows.join(one, "print").groupBy("slot", "family").agg(F.count("*").alias("n"))
    most = members.groupBy("slot").agg(F.min(F.struct(-F.col("n"), "family")).alias("best")).select("slot", F.col("best.family").alias("family"))
    return work.write(belong(most.join(shared.select("slot"), "slot", "left_semi"), F.col("need")), "families")


def templates(key: np.ndarray, need: np.ndarray, places: np.ndarray, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The line (its number) and hash of every template of lines whose frequent tokens are at[i]:at[i + 1], the most frequent first.

    A template is `need` tokens of a line in their places, neighbours in that order; key tells leaves apart.
    """
    term = mix(tokens + (places.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
    count = np.maximum(0, np.diff(at) - need + 1)
    line = np.repeat(np.arange(len(need)), count)
    first = at[line] + np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)
    return line, mix(mix(key[line]) + sums[first + need[line]] - sums[first])


def frequent(tokens: np.ndarray, docs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, place and token of what at least `least` documents have in a leaf (a row of token hashes for each line, and how many documents
    have the line), of each line the most frequent first."""
    weight = np.empty(tokens.shape, np.int64)
    for k in range(tokens.shape[1]):
        _, which = np.unique(tokens[:, k], return_inverse=True)
        weight[:, k] = np.bincount(which, weights=docs)[which]
    line, place = np.nonzero((weight >= least) & (tokens != _VARIABLE))
    order = np.lexsort((place, -weight[line, place], line))
    line, place = line[order], place[order]
    return line, place, tokens[line, place]


def _among(keys: DataFrame, most: int) -> np.ndarray | None:
    """The sorted keys, if they are `most` at most."""
    if keys.count() > most:
        return None
    return np.sort(keys.toArrow().column(0).to_numpy())


def _is_among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each value is one of the keys, which are sorted: so a batch does not sort all of them again."""
    if not len(keys):
        return np.zeros(values.shape, bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def candidates(docs: DataFrame, copies: DataFrame, work: Workspace, least: int, most: int) -> DataFrame:
    """leaf, whole, print and tokens of every line that has a part which recurs in `least` documents."""

    def parts(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = Words(column(batch, "text"))
        x = Lines(texts)
        i, q = np.nonzero(x.parts)
        return pa.record_batch({"part": pa.array(x.parts[i, q]), "print": pa.array(Sketches(texts, slots=False).print[x.row[i]])})

    seen = map_batches(docs.select("text"), parts, "part long, print long", text="text")
    named = seen.join(copies, "print", "left").select("part", F.coalesce("family", "print").alias("family"))
    found = work.write(named.distinct().groupBy("part").agg(F.count("*").alias("docs")).where(F.col("docs") >= least).select("part"), "parts")
    listed = _among(found, most)
    held = docs.sparkSession.sparkContext.broadcast(listed) if listed is not None else None

    def lines(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = Words(column(batch, "text"))
        x = Lines(texts)
        i = np.flatnonzero(x.tokens)
        if held is not None:
            known = _is_among(x.parts[i], held.value)
            some = known.any(axis=1)
            i = i[some]
            leaf = x.parts[i, known[some].argmax(axis=1)]
        else:
            leaf = np.zeros(len(i), np.int64)
        n = x.tokens[i]
        ends = np.concatenate([[0], np.cumsum(n)])
        flat = x.hashes[np.repeat(x.begin[i] - ends[:-1], n) + np.arange(ends[-1])]
        whole = lambda a, k: pa.ListArray.from_arrays(pa.array(k.astype(np.int32)), pa.array(a.view(np.int64)))
        return pa.record_batch({"leaf": pa.array(leaf), "whole": pa.array(x.whole[i]), "print": pa.array(Sketches(texts, slots=False).print[x.row[i]]), "tokens": whole(flat, ends), "parts": whole(np.ascontiguousarray(x.parts[i]).reshape(-1), np.arange(0, PARTS * len(i) + 1, PARTS))})

    out = work.write(map_batches(docs.select("text"), lines, "leaf long, whole long, print long, tokens array<long>, parts array<long>", text="text"), "lines")
    if listed is not None:
        return out.drop("parts")
    each = out.select("whole", "parts").dropDuplicates(["whole"]).select("whole", F.posexplode("parts").alias("q", "part")).where("part <> 0")
    leaves = each.join(found, "part").groupBy("whole").agg(F.min_by("part", "q").alias("leaf"))
    return work.write(lookup(work, out.drop("leaf", "parts"), leaves, "whole"), "placed")


def _of_large(large: DataFrame, work: Workspace, least: int) -> DataFrame:
    """leaf, n, whole, places and tokens: what `frequent` finds in leaves that no task holds, for lines that have enough of it."""
    cell = F.xxhash64("leaf", "n", "c.k", "c.token").alias("cell")
    each = large.select("leaf", "n", "whole", "docs", F.explode(F.transform("tokens", lambda t, k: F.struct(k.alias("k"), t.alias("token")))).alias("c"))
    cells = each.where(F.col("c.token") != int(_VARIABLE)).select("leaf", "n", "whole", "docs", "c.k", "c.token", cell)
    # Sums come in two steps, so that a token of very many lines is no task's alone.
    weights = work.write(cells.groupBy("cell").agg(F.sum("docs").alias("weight")).where(F.col("weight") >= least), "cells")
    told = lookup(work, cells.drop("docs"), weights, "cell")
    lists = told.groupBy("leaf", "n", "whole").agg(F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("w"), "k", "token"))).alias("c"))
    need = F.greatest(F.ceil(F.col("n") * SHARE / 100), F.least(F.col("n"), F.lit(KEEP)))
    return lists.where(F.size("c") >= need).select("leaf", "n", "whole", F.col("c.k").alias("places"), F.col("c.token").alias("tokens"))


def _ragged(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and the offsets of its rows in them."""
    lists = column(batch, name)
    at = lists.offsets.to_numpy()
    return lists.values.to_numpy()[at[0] : at[-1]], at - at[0]


def learned(work: Workspace, lines: DataFrame, seen: DataFrame, least: int) -> DataFrame:
    """whole, template: the templates of each distinct line, some of which may be shared by others. seen: whole, family.

    A token's weight is how many documents have it in its leaf and place (a document once for each such line). Leaves up to LEAF
    lines are weighed in one task, larger ones by a shuffle of their tokens, with the same sums.
    """
    docs = seen.groupBy("whole").agg(F.count("*").alias("docs"))
    tree = lines.groupBy("whole").agg(F.min("leaf").alias("leaf"), F.first("tokens").alias("tokens"))  # lines of one hash are alike
    tree = work.write(tree.join(docs, "whole").select("leaf", F.size("tokens").alias("n"), "whole", "docs", "tokens"), "tree")
    sizes = tree.groupBy("leaf").agg(F.count("*").alias("lines")).where(F.col("lines") > LEAF).select("leaf", F.lit(True).alias("large"))
    marked = work.write(lookup(work, tree, sizes, "leaf", "left"), "marked")

    def told(leaf: np.ndarray, n: np.ndarray, whole: np.ndarray, found: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.record_batch({"whole": pa.array(whole[found[0]]), "template": pa.array(found[1].view(np.int64))})

    def learn(rows: pa.RecordBatch) -> pa.RecordBatch:
        leaf, n, whole, docs = (column(rows, c).to_numpy() for c in ("leaf", "n", "whole", "docs"))
        flat, at = _ragged(rows, "tokens")
        edges = np.flatnonzero((leaf[1:] != leaf[:-1]) | (n[1:] != n[:-1])) + 1
        own = []
        for a, b in zip([0, *edges], [*edges, len(leaf)], strict=True):
            line, place, token = frequent(flat[at[a] : at[b]].view(np.uint64).reshape(b - a, n[a]), docs[a:b], least)
            own.append((line + a, place, token))
        line, place, token = (np.concatenate(x) for x in zip(*own, strict=True))
        return told(leaf, n, whole, templates(_keys(leaf, n), _needs(n), place, token, np.searchsorted(line, np.arange(len(leaf) + 1))))

    def of_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        whole_of = lambda parts: pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf = column(batch, "leaf").to_numpy()
            cut = int(np.searchsorted(leaf, leaf[-1]))  # the last leaf may go on in the next batch
            if held and (cut or leaf[0] != column(held[-1], "leaf")[-1].as_py()):
                yield learn(whole_of([*held, batch.slice(0, cut)] if cut else held))
                held = []
            elif cut:
                yield learn(whole_of([batch.slice(0, cut)]))
            held.append(batch.slice(cut))
        if held:
            yield learn(whole_of(held))
        give_back()

    def of_lists(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaf, n, whole = (column(batch, c).to_numpy() for c in ("leaf", "n", "whole"))
        (place, at), (token, _) = _ragged(batch, "places"), _ragged(batch, "tokens")
        return told(leaf, n, whole, templates(_keys(leaf, n), _needs(n), place, token.view(np.uint64), at))

    small = marked.where("large is null").drop("large").repartition("leaf").sortWithinPartitions("leaf", "n", "whole").mapInArrow(of_leaves, "whole long, template long")
    large = marked.where("large").drop("large")
    if large.isEmpty():
        return small
    return small.unionByName(map_batches(_of_large(large, work, least), of_lists, "whole long, template long"))


def _keys(leaf: np.ndarray, n: np.ndarray) -> np.ndarray:
    return mix(leaf.view(np.uint64) + n.astype(np.uint64))


def _needs(n: np.ndarray) -> np.ndarray:
    return np.maximum(-(-SHARE * n.astype(np.int64) // 100), np.minimum(n, KEEP))


def recurring(docs: DataFrame, work: Workspace, least: int = LEAST_DOCS, most: int = BROADCAST) -> DataFrame:
    """key: the hashes of the lines whose template recurs over all documents that have an id."""
    docs = docs.where("doc_id is not null")
    copies = families(docs, work)
    if copies.count() <= COPIES:
        copies = F.broadcast(copies)
    lines = candidates(docs, copies, work, least, most)
    seen = lines.select("whole", "print").join(copies, "print", "left").select("whole", F.coalesce("family", "print").alias("family")).distinct()
    seen = work.write(seen, "seen")
    known = work.write(learned(work, lines.select("leaf", "whole", "tokens"), seen, least), "known")
    work.drop("tree", "marked", "cells", "lines", "placed")
    docs_of = lookup(work, seen, known, "whole").select("template", "family").distinct().groupBy("template").agg(F.count("*").alias("docs"))
    found = work.write(docs_of.where(F.col("docs") >= least).select("template"), "recurring-templates")
    own = seen.groupBy("whole").agg(F.count("*").alias("docs")).where(F.col("docs") >= least).select("whole")
    return known.join(found, "template", "left_semi").select("whole").union(own).distinct().select(F.col("whole").alias("key"))


def drop_lines(docs: DataFrame, least: int = LEAST_DOCS, most: int = BROADCAST) -> DataFrame:
    """docs with the lines of recurring templates cut out of text, and n_lines and n_removed at the end; a row for each row.

    docs: doc_id, text and any other columns, which stay as they are (n_chars, if there, follows the text; columns named
    n_lines or n_removed are replaced). A null text stays null and has no lines; an empty text has one, without tokens; a
    document without an id counts as one with all others that have none, and is not counted as a document of a template.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "lines")
    docs = docs.drop("n_lines", "n_removed")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = work.write(recurring(plain, work, least, most), "recurring")
    names = docs.columns
    schema = docs.select("*", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed")).schema

    def cut_out(batch: pa.RecordBatch, gone_of) -> pa.RecordBatch:
        texts = column(batch, "text")
        x = Lines(texts)
        gone = gone_of(batch, x) & (x.tokens > 0)
        removed = np.bincount(x.row[gone], minlength=batch.num_rows)
        new = []
        for r in np.flatnonzero(removed):
            keep = [i for i in range(x.first[r], x.first[r + 1]) if not gone[i]]
            new.append(b"\n".join(x.raw[x.start[i] : x.end[i]].tobytes() for i in keep).decode())
        cols, changed = dict(zip(batch.schema.names, batch.columns, strict=True)), pa.array(removed > 0)
        cols["text"] = pc.replace_with_mask(texts, changed, pa.array(new, texts.type))
        if "n_chars" in cols:
            cols["n_chars"] = pc.replace_with_mask(cols["n_chars"], changed, pa.array([len(t) for t in new]).cast(cols["n_chars"].type))
        lines = np.where(texts.is_null().to_numpy(zero_copy_only=False), 0, np.diff(x.first))
        return pa.record_batch({c: cols[c] for c in names} | {"n_lines": pa.array(lines, pa.int64()), "n_removed": pa.array(removed, pa.int64())})

    listed = _among(found, most)
    if listed is not None:
        held = spark.sparkContext.broadcast(listed)
        return map_batches(docs, lambda b: cut_out(b, lambda _, x: _is_among(x.whole, held.value)), schema, text="text")

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = Lines(column(batch, "text"))
        i = np.flatnonzero(x.tokens)
        return pa.record_batch({"key": pa.array(x.whole[i]), "text": column(batch, "print").take(pa.array(x.row[i]))})

    # Lists of the recurring lines of each text, by its hash: texts of one hash only have more lines listed than they hold.
    each = map_batches(plain.select("text", F.xxhash64("text").alias("print")), keys, "key long, text long", text="text")
    listed_lines = lookup(work, work.write(each.distinct(), "each"), found.withColumn("there", F.lit(True)), "key")
    lists = work.write(listed_lines.groupBy("text").agg(F.collect_set("key").alias("__keys")).withColumnRenamed("text", "__print"), "lists")

    def listed_here(batch: pa.RecordBatch, x: Lines) -> np.ndarray:
        gone = np.zeros(len(x.row), bool)
        for r, own in enumerate(column(batch, "__keys").to_pylist()):
            if own:
                part = slice(x.first[r], x.first[r + 1])
                gone[part] = np.isin(x.whole[part], np.array(own, np.int64))
        return gone

    joined = lookup(work, docs.withColumn("__print", F.xxhash64(F.col("text").cast("string"))), lists, "__print", "left").drop("__print")
    return map_batches(joined, lambda b: cut_out(b, listed_here), schema, text="text")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their recurring lines: doc_id, n_lines, n_removed, text."""
    return drop_lines(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_lines", "n_removed", "text")
