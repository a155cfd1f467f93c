"""Fill-in-middle by big integers as bit rows: a text's classes of bytes, boundaries and ranks in a few operations a text.

One bit a byte, the first byte lowest: bytes.translate turns the text into '0' and '1' of a class, which int() reads as one
number in linear time. Shifts and boolean operations of such numbers mark where tokens start, bit_count counts them, and
halving the number again and again finds the start of a given rank; all of it is linear in the text.
"""

from __future__ import annotations

import hashlib
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import column, map_batches, ship, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the texts that stay plain, and of the others that put the suffix first.
PLAIN, SPM = 10, 20

_LETTER = bytes(ord("1") if chr(b) in string.ascii_letters else ord("0") for b in range(256))
_INNER = bytes(ord("1") if 0x80 <= b < 0xC0 else ord("0") for b in range(256))  # bytes of a code point after its first


def bits(data: bytes, table: bytes) -> int:
    """The class that `table` maps to '1', bit k for byte k."""
    return int(data[::-1].translate(table), 2) if data else 0


def starts(data: bytes) -> tuple[int, int]:
    """Bits of the bytes at which a token ([A-Za-z]+ or any other code point) starts, and of those inside a code point."""
    letter, inner = bits(data, _LETTER), bits(data, _INNER)
    every = (1 << len(data)) - 1
    return every ^ inner ^ (letter & (letter << 1)), inner


def ranked(row: int, rank: int, width: int) -> int:
    """Place of the set bit that has `rank` set bits below it; width if there is none."""
    if rank >= row.bit_count():
        return width
    at = 0
    while width > 1:
        half = width >> 1
        low = row & ((1 << half) - 1)
        n = low.bit_count()
        if rank < n:
            row, width = low, half
        else:
            row, rank, at, width = row >> half, rank - n, at + half, width - half
    return at


def split(data: bytes, draws: tuple[int, int]) -> tuple[int, int, int, int, int]:
    """n tokens; bytes at which prefix and middle end, after draws modulo n + 1 tokens; code points in both."""
    row, inner = starts(data)
    n = row.bit_count()
    first, second = sorted(d % (n + 1) for d in draws)
    a, b = ranked(row, first, len(data)), ranked(row, second, len(data))
    within = inner & ((1 << b) - 1)
    before = (within & ((1 << a) - 1)).bit_count()
    return n, a, b, a - before, b - a - (within.bit_count() - before)


def fill_in_middle(docs: DataFrame, seed: int = 1, plain: int = PLAIN, spm: int = SPM) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and output, a row for each of docs' rows.

    Tokens are runs of A-Z and a-z and every other code point. The draws h1 to h4 are the first four 32-bit numbers of sha256
    of "seed:doc_id". Prefix and middle end after the smaller and larger of h1 and h2 modulo n + 1 tokens. A text stays plain
    (output is the text, no counts of characters) if it is empty, holds a sentinel, or h3 % 100 is no less than 100 - plain;
    else the suffix comes first (spm) if h4 % 100 is below spm, and the prefix (psm) if not.

    A null text counts as empty. A null doc_id is drawn for as the empty string. Rows that repeat a doc_id have its draws; an
    empty table gives an empty one. Other columns are not looked at. Bytes that are no UTF-8 are kept as they are.
    """
    ship(docs.sparkSession)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, at = text_bytes(column(batch, "text"))
        whole = data.tobytes()
        out: dict[str, list] = {k: [] for k in ("n", "form", "prefix_chars", "middle_chars", "output")}
        for k, key in enumerate(column(batch, "doc_id").to_pylist()):
            text = whole[at[k] : at[k + 1]]
            drawn = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
            h = [int.from_bytes(drawn[i : i + 4], "big") for i in (0, 4, 8, 12)]
            n, a, b, pre, mid = split(text, (h[0], h[1]))
            p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
            if not text or p in text or s in text or m in text or h[2] % 100 >= 100 - plain:
                form, pre, mid, made = "plain", None, None, text
            elif h[3] % 100 < spm:
                form, made = "spm", b"".join((s, text[b:], p, text[:a], m, text[a:b]))
            else:
                form, made = "psm", b"".join((p, text[:a], s, text[b:], m, text[a:b]))
            for name, v in zip(out, (n, form, pre, mid, made), strict=True):
                out[name].append(v)
        kinds = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}
        cols = {name: pa.array(out[name], kind) for name, kind in kinds.items()}
        # The bytes of a valid text cut at code points are valid, and invalid ones go back as they came.
        made = pa.array(out["output"], pa.large_binary()).view(pa.large_string())
        return pa.record_batch({"doc_id": column(batch, "doc_id"), **cols, "output": made})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string", text="text")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No text in parts holds a sentinel, so each is found where it was put."""
    part = lambda after, until: F.substring_index(F.substring_index(output, after, -1), until, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    prefix = F.when(form == "psm", part(PREFIX, SUFFIX)).otherwise(part(PREFIX, MIDDLE))
    suffix = F.when(form == "psm", part(SUFFIX, MIDDLE)).otherwise(part(SUFFIX, PREFIX))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into prefix, middle and suffix; digests of the output and of the text rebuilt from it."""
    out = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    back = restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


OP13_SQL = """
with d as (
  select doc_id, coalesce(text, '') as text, sha256('1:' || doc_id) as h,
    list_filter(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]'), lambda t: t <> '') as u from documents),
e as (select *, len(u) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
       when h4 % 100 < 20 then 'spm' else 'psm' end as form from e),
g as (select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:n], '') as s from f)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from g
"""
