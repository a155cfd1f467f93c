"""Substring dedup by level-wise doubling.

The lengths start at about BASE words and double up to the wanted size. At each length every candidate window of full size is
looked at through its anchor, the window of that length inside it with the smallest hash: as the anchor depends on the words
alone, a repeated full window has a repeated anchor at every length. Windows whose anchor is found once are dropped, and only
the others are candidates at twice the length, until no candidates survive or the full size is reached. There windows are told
apart by 128 bits, from two independent hashes of their words; first occurrences stay, all others are covered words.

An anchor that is found once, and a window's first occurrence, are known with the document that holds them from an aggregate
alone. So no window is joined with any other, and a passage that very many documents share is reduced before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import Words, Workspace, column, map_batches, mix, window_hashes

WINDOW, BASE = 20, 10


def lengths(size: int, base: int = BASE) -> list[int]:
    """The lengths of all levels: each at least half of the next, the last one `size`."""
    out = [size]
    while out[0] >= 2 * base:
        out.insert(0, -(-out[0] // 2))
    return out


def least_within(v: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of v[i:i + m] for every i from which m values remain, and the first place where it is."""
    best, place, span = v, np.arange(len(v)), 1

    def meet(shift: int) -> tuple[np.ndarray, np.ndarray]:
        n = max(0, len(best) - shift)
        later = best[shift:] < best[:n]
        return np.where(later, best[shift:], best[:n]), np.where(later, place[shift:], place[:n])

    while 2 * span <= m:
        best, place = meet(span)
        span *= 2
    return meet(m - span) if span < m else (best, place)


class Windows:
    """Full windows of a batch of texts: row, pos (first word within the row)."""

    def __init__(self, texts: pa.Array, size: int):
        self.words, self.size = Words(texts), size
        self.hashes = self.words.hashes()
        w = self.words
        n = max(0, len(w) - size + 1)
        row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))[:n]
        self.at = np.flatnonzero(np.arange(n) + size <= w.first[row + 1])
        self.row = row[self.at]
        self.pos = self.at - w.first[self.row]

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and place of each full window's anchor."""
        best, place = least_within(window_hashes(self.hashes, length), self.size - length + 1)
        return best[self.at].view(np.int64), place[self.at]

    def alive(self, levels: list[int], lists: list[pa.Array]) -> np.ndarray:
        """The full windows whose anchor is at no level in their row's list of those found once."""
        ok = np.ones(len(self.row), bool)
        # Rows are told apart by a hash of 64 bits in a batch.
        tag = lambda row, a: mix(a.view(np.uint64) ^ (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        for length, found in zip(levels, lists, strict=True):
            rows, once = flat(found)
            ok &= ~np.isin(tag(self.row, self.anchors(length)[0]), tag(rows, once))
        return np.flatnonzero(ok)

    def prints(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each of the full windows i, in two halves."""
        other = window_hashes(self.words.hashes(seed=1), self.size)
        return window_hashes(self.hashes, self.size)[self.at[i]], other[self.at[i]]


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all values of a list array, null lists being empty."""
    lists = lists.fill_null([]) if lists.null_count else lists
    at = lists.offsets.to_numpy()
    return np.repeat(np.arange(len(lists)), np.diff(at)), np.ascontiguousarray(lists.values.to_numpy()[at[0] : at[-1]])


def candidates(work: Workspace, docs: DataFrame, size: int, base: int = BASE) -> tuple[DataFrame, list[int]]:
    """docs with once0, once1, ...: a document's anchors, at each length listed, that are found nowhere else."""
    levels: list[int] = []
    for k, length in enumerate(lengths(size, base)[:-1]):
        before = list(levels)

        def anchors(batch: pa.RecordBatch, before: list[int] = before, length: int = length) -> pa.RecordBatch:
            x = Windows(column(batch, "text"), size)
            i = x.alive(before, [column(batch, f"once{j}") for j in range(len(before))])
            best, place = x.anchors(length)
            _, one = np.unique(place[i], return_index=True)
            row = pa.array(x.row[i][one])
            return pa.record_batch({"anchor": pa.array(best[i][one]), "id": column(batch, "id").take(row), "tag": column(batch, "tag").take(row)})

        found = map_batches(docs.drop("doc_id"), anchors, "anchor long, id long, tag long", text="text")
        counts = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.min("tag").alias("tag"))
        once = F.collect_list(F.when(F.col("n") == 1, F.col("anchor"))).alias(f"once{k}")
        lists = work.write(counts.groupBy("id", "tag").agg(once, F.count_if(F.col("n") > 1).alias("repeated")), f"once{k}")
        docs = docs.join(lists.drop("repeated"), ["id", "tag"], "left")
        levels.append(length)
        if lists.where("repeated > 0").isEmpty():
            break
    return docs, levels


def first_windows(work: Workspace, docs: DataFrame, levels: list[int], size: int) -> DataFrame:
    """id, tag (if texts share an id) and firsts: where in the document candidate windows begin whose words begin a window nowhere earlier."""

    def full(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = Windows(column(batch, "text"), size)
        i = x.alive(levels, [column(batch, f"once{j}") for j in range(len(levels))])
        one, two = x.prints(i)
        order = np.lexsort((x.pos[i], two, one, x.row[i]))
        row, a, b = x.row[i][order], one[order], two[order]
        fresh = np.ones(len(i), bool)  # the first of its kind in the document
        fresh[1:] = (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        order, row = order[fresh], row[fresh]
        names = [column(batch, c).take(pa.array(row)) for c in (("id", "tag") if shared else ("id",))]
        cols = [pa.array(a[fresh].view(np.int64)), pa.array(b[fresh].view(np.int64)), *names, pa.array(x.pos[i][order].astype(np.int32))]
        return pa.record_batch(cols, names=["one", "two", *(("id", "tag") if shared else ("id",)), "pos"])

    # The smallest (id, tag, position): where no two texts share an id, the smallest id decides, in a cheaper aggregate.
    texts = docs.groupBy("id").agg((F.min("tag") != F.max("tag")).alias("shared"))
    shared = not texts.where("shared").isEmpty()
    windows = map_batches(docs.drop("doc_id"), full, f"one long, two long, id long, {'tag long, ' if shared else ''}pos int", text="text")
    if shared:
        first = windows.groupBy("one", "two").agg(F.min(F.struct("id", "tag", "pos")).alias("f")).select("f.*").groupBy("id", "tag")
    else:
        first = windows.groupBy("one", "two").agg(F.min("id").alias("id"), F.min_by("pos", "id").alias("pos")).groupBy("id")
    return work.write(first.agg(F.collect_list("pos").alias("firsts")), "firsts")


def drop_repeats(docs: DataFrame, size: int = WINDOW, base: int = BASE) -> DataFrame:
    """Removes each word that a window of `size` words covers whose words also begin a window earlier in the corpus.

    docs: doc_id long, text string; other columns are not looked at. Earlier is a smaller doc_id (null first, like the smallest
    long), or an earlier start in the same document; windows are judged on the input. Returns doc_id, n_words, n_removed and kept
    (the words that stay, joined by one space), a row for each input row. A null or empty text has no words. Rows that repeat
    a doc_id and a text are no repeats of each other; other texts of one doc_id (or of null) are in order of a hash. An empty
    table gives an empty table. `base` is about the length that the doubling starts from.
    """
    work = Workspace(docs.sparkSession, "substrings")
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tag = F.xxhash64(text)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_.alias("id"), tag.alias("tag"), text.alias("text"))
    docs, levels = candidates(work, docs, size, base)
    firsts = first_windows(work, docs, levels, size)

    def cut_out(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = Windows(column(batch, "text"), size)
        w = x.words
        i = x.alive(levels, [column(batch, f"once{j}") for j in range(len(levels))])
        rows, pos = flat(column(batch, "firsts"))
        begins = w.first[rows] + pos
        first = np.zeros(len(w) + 1, bool)
        first[begins[begins < w.first[rows + 1]]] = True
        begin = x.at[i][~first[x.at[i]]]
        at = np.zeros(len(w) + 1, np.int64)
        np.add.at(at, begin, 1)
        np.add.at(at, begin + size, -1)
        stays = np.cumsum(at)[: len(w)] == 0
        # The bytes of the words that stay, each with the blank after it, which becomes a space.
        row_end = w.at[1:][np.repeat(np.arange(batch.num_rows), np.diff(w.first))]
        s, e = w.starts[stays], w.ends[stays]
        blank = e < row_end[stays]
        data = w.raw.copy()
        data[e[blank]] = 0x20
        step = np.zeros(len(data) + 1, np.int8)
        step[s] += 1
        step[e + blank] -= 1
        keep = np.cumsum(step[:-1], dtype=np.int8) > 0
        size_of = np.concatenate([[0], np.cumsum(keep)])[w.at]
        data = data[keep]
        kept = [data[a:b].tobytes().rstrip(b" ").decode() for a, b in zip(size_of[:-1].tolist(), size_of[1:].tolist(), strict=True)]
        n = np.diff(w.first)
        gone = n - np.diff(np.concatenate([[0], np.cumsum(stays)])[w.first])
        return pa.record_batch({"doc_id": column(batch, "doc_id"), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept": pa.array(kept, pa.string())})

    joined = docs.join(firsts, [c for c in ("id", "tag") if c in firsts.columns], "left").drop("id", "tag")
    return map_batches(joined, cut_out, "doc_id long, n_words long, n_removed long, kept string", text="text")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated runs of 20 words."""
    out = drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
k as (select doc_id, unnest(range(1, len(ws) - 18)) as i, unnest(list_transform(range(1, len(ws) - 18), lambda i: md5(array_to_string(ws[i:i + 19], ' ')))) as h from w),
f as (select doc_id, i, row_number() over (partition by h order by doc_id, i) as r from k),
c as (select distinct doc_id, unnest(range(i, i + 20)) as at from f where r > 1),
e as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as at from w),
a as (select e.doc_id, count(c.at) as gone, coalesce(string_agg(word, ' ' order by e.at) filter (c.at is null), '') as kept from e left join c on c.doc_id = e.doc_id and c.at = e.at group by e.doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(gone, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from w left join a on a.doc_id = w.doc_id
"""
