"""BPE encoding and decoding with a bounded-lookahead streaming transducer.

For every prefix of a pre-token there is exactly one last token of its encoding, the one that may follow the encoding of what
is before it; so the encodings of all prefixes form a tree. Two tokens may stand side by side if no merge across their border
would have come first: the merges that build the right edge of one and the left edge of the other say so (`follows`).
Whatever comes next, the final encoding passes through one of the last `lookahead` prefixes, where lookahead is the longest
token that the merge list can build. Tokens on which all of these agree are stable: they are emitted and forgotten. Every
word goes through this machine, and one of any length takes the same memory.

Texts are read in pieces; normalization and the classes of characters are those of the tokenizer's own file. Decoding feeds
each token's bytes to an incremental UTF-8 machine, which holds back an unfinished character only.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import column, map_batches, ship

#: Characters of a text, and ids of a token list, that are read at a time.
PIECE = 1 << 16
#: Words whose tokens are remembered, and pairs of tokens that are known to fit or not; when full, the memory is emptied.
REMEMBERED = 700_000
#: Longer words are not remembered.
LONG_WORD = 64
#: The normalizer for which old Latin letters may take Python's own way: composed, white space to blanks, lower case (fixed values).
_COMMON_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
#: Anything but Latin letters and signs that no version of Unicode treats otherwise; 1C to 1F are white space to Python alone.
_UNCOMMON = re.compile("[^\x00-\x1b\x20-\u024f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Transducer:
    """Symbols in, tokens out, for the merges of one vocabulary. A symbol is a character, the last one of a word with `suffix`."""

    def __init__(self, merges: list[tuple[str, str]], suffix: str = ""):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.suffix = suffix
        self.tokens = {a + b for a, b in merges}
        self.lookahead = self._lookahead(merges)
        bodies = [t[: -len(suffix)] if suffix and t.endswith(suffix) else t for t in self.tokens]
        #: What a token that is not at an end begins with, itself left out.
        self.begins = {t[:i] for t in bodies for i in range(1, len(t))}
        self._edges: dict[str, tuple[list, list] | None] = {}
        self._fits: dict[str, dict[str, bool]] = {}
        self._known = 0

    @staticmethod
    def _lookahead(merges: list[tuple[str, str]]) -> int:
        """Symbols of the longest token that the merges can build: no token reaches further, so none waits for more."""
        size: dict[str, int] = {}
        for a, b in merges:
            size[a + b] = max(size.get(a + b, 0), size.get(a, 1) + size.get(b, 1))
        return max(size.values(), default=1)

    def symbols(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def merged(self, parts: list[str]) -> tuple[list[str], dict[tuple[int, int], int]]:
        """All merges of a short sequence, smallest rank first and from the left: what is left, and the rank at which each span
        of symbols was built."""
        spans = [(p, i, i + 1) for i, p in enumerate(parts)]
        built: dict[tuple[int, int], int] = {}
        while len(spans) > 1:
            r, i = min((self.rank.get((a[0], b[0]), len(self.rank)), i) for i, (a, b) in enumerate(zip(spans, spans[1:], strict=False)))
            if r == len(self.rank):
                break
            spans[i : i + 2] = [(spans[i][0] + spans[i + 1][0], spans[i][1], spans[i + 1][2])]
            built[spans[i][1:]] = r
        return [p for p, _, _ in spans], built

    def edges(self, token: str) -> tuple[list, list] | None:
        """The parts of a token that stood at its right and at its left edge while it was built, each as (part, built at, merged
        away at); None if the merges do not build the token from its symbols."""
        if token in self._edges:
            return self._edges[token]
        parts = self.symbols(token)
        left, built = self.merged(parts)
        n, never = len(parts), len(self.rank)
        found = None
        if len(left) == 1:
            spans = [(i, i + 1, -1) for i in range(n)] + [(i, j, r) for (i, j), r in built.items()]
            found = tuple(self._edge(sorted((s for s in spans if s[side] == at), key=lambda s: s[1] - s[0]), parts, never) for side, at in ((1, n), (0, 0)))
        self._edges[token] = found
        return found

    @staticmethod
    def _edge(spans: list[tuple[int, int, int]], parts: list[str], never: int) -> list[tuple[str, int, int]]:
        gone = [s[2] for s in spans[1:]] + [never]
        return [("".join(parts[i:j]), r, g) for (i, j, r), g in zip(spans, gone, strict=True)]

    def follows(self, a: str, b: str) -> bool:
        """Whether b, a token that the merges build, may follow a: no pair of edge parts merges while both are there. Of equal merges
        the left one goes first. Anything may follow the beginning of a word, ""."""
        fit = self._fits.setdefault(a, {})
        known = fit.get(b)
        if known is None:
            known = self.edges(b) is not None
            for x, made, gone in self.edges(a)[0] if a and known else ():
                for y, made2, gone2 in self.edges(b)[1]:
                    r = self.rank.get((x, y))
                    if r is not None and made < r < gone and made2 < r <= gone2:
                        known = False
            self._known += 1
            if self._known > REMEMBERED:
                self._fits, self._known = {}, 0
            fit[b] = known
        return known

    def open(self) -> Run:
        return Run(self)

    def encode(self, word: str) -> list[str]:
        """The tokens of a word: as a run would give them, in one step if it is too short for any to be emitted before its end."""
        n = len(word)
        if n > 4 * self.lookahead:
            run = self.open()
            return [*run.push(word), *run.close()]
        tokens, begins, suffix = self.tokens, self.begins, self.suffix
        last: list[str | None] = [""] + [None] * n
        from_: list[int] = [0] * (n + 1)
        for i in range(n):
            prior = last[i]
            fit = self._fits.get(prior)
            if fit is None:
                fit = self._fits.setdefault(prior, {})
            for j in range(i + 1, n):
                t = word[i:j]
                if last[j] is None and (j == i + 1 or t in tokens):
                    ok = fit.get(t)
                    if ok if ok is not None else self.follows(prior, t):
                        last[j], from_[j] = t, i
                if t not in begins:
                    break
            else:
                t = word[i:] + suffix
                if last[n] is None and (i + 1 == n or t in tokens):
                    ok = fit.get(t)
                    if ok if ok is not None else self.follows(prior, t):
                        last[n], from_[n] = t, i
        out, p = [], n
        while p:
            out.append(last[p])
            p = from_[p]
        return out[::-1]


class Run:
    """A pre-token on its way through the transducer."""

    def __init__(self, machine: Transducer):
        self.machine, self.held = machine, ""  # held: symbols from the last stable place on, and one that waits for its end
        self.last: list[str] = [""]  # for each prefix of held: its last token
        self.before = ""  # the last token emitted

    def push(self, symbols: str) -> Iterator[str]:
        """Tokens that are stable once these symbols are read; the last symbol waits, as a word's end changes it."""
        m = self.machine
        far = 4 * m.lookahead
        for at in range(0, len(symbols), far):
            self.held += symbols[at : at + far]
            self._extend(len(self.held) - 1, "")
            while len(self.last) > far:
                stable = self._agreed()
                if not stable:
                    break
                yield from self._emit(stable)

    def close(self) -> list[str]:
        if not self.held:
            return []
        self._extend(len(self.held), self.machine.suffix)
        return self._emit(len(self.held))

    def _size(self, token: str) -> int:
        suffix = self.machine.suffix
        return len(token) - len(suffix) if suffix and len(token) > len(suffix) and token.endswith(suffix) else len(token)

    def _extend(self, to: int, suffix: str) -> None:
        """Find the last tokens of the prefixes up to `to` symbols; the last of these ends the word if there is a suffix."""
        m, held, last = self.machine, self.held, self.last
        for n in range(len(last), to + 1):
            end = suffix if n == to else ""
            for k in range(min(n, m.lookahead), 0, -1):
                t = held[n - k : n] + end
                if (k == 1 or t in m.tokens) and m.follows(last[n - k] if n > k else self.before, t):
                    last.append(t)
                    break

    def _chain(self, p: int) -> Iterator[int]:
        """The places where the encoding of the prefix of p symbols has its borders, from its end back."""
        while p:
            yield p
            p -= self._size(self.last[p])

    def _agreed(self) -> int:
        """The furthest place that the encodings of all prefixes that may still be passed through have in common."""
        n, far = len(self.last) - 1, self.machine.lookahead
        common: set[int] | None = None
        for p in range(n, n - far, -1):
            places = set(self._chain(p))
            common = places if common is None else common & places
        return max((q for q in common or () if q <= n - far), default=0)

    def _emit(self, to: int) -> list[str]:
        out = [self.last[p] for p in self._chain(to)][::-1]
        self.before, self.held = out[-1], self.held[to:]
        self.last = [""] + self.last[to + 1 :]
        return out


class Bpe:
    """A byte-level vocabulary, with or without word ends, as its file describes it."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer
        from tokenizers.pre_tokenizers import Split

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.transducer = Transducer([tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]], self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # Normalization and pre-tokens by the file's own rules; the merges are ours.
        rules = Tokenizer.from_file(path)
        self.normal = rules.normalizer.normalize_str if rules.normalizer else str
        self.pre = rules.pre_tokenizer.pre_tokenize_str
        self.classes = {k: Split(Regex(p), "removed", invert=True).pre_tokenize_str for k, p in (("letters", r"\p{L}+"), ("others", r"[^\s\p{L}\p{N}]+"))}
        self.common = spec.get("normalizer") == _COMMON_NORMALIZER
        split = next((x["pattern"]["Regex"] for x in spec["pre_tokenizer"].get("pretokenizers", []) if x["type"] == "Split" and x.get("invert")), None)
        # The same pattern for words of ASCII alone.
        self.ascii = re.compile(split.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9"), re.ASCII).findall if split else None
        self.letters = byte_letters()
        self.byte_of = byte_of = {c: bytes([b]) for b, c in enumerate(self.letters)}
        decoder = (spec.get("decoder") or {}).get("type")
        #: Bytes that each id decodes to. A file that names no decoder has its tokens' own strings, with a space between.
        plain = lambda t: b" " + t.encode()
        raw = (lambda t: b"".join(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()) if decoder == "ByteLevel" else plain
        self.bytes_of = {i: raw(t) for t, i in self.ids.items()} | {i: t.encode() if decoder == "ByteLevel" else plain(t) for t, i in self.special.items()}
        self.lead = 0 if decoder == "ByteLevel" else 1
        self.remembered: dict[str, bytes] = {}  # of words, and of their ASCII pre-tokens
        self.parts: dict[str, bytes] = {}  # of other pre-tokens, by their symbols

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(self._encode(text))

    def _encode(self, text: str) -> Iterator[bytes]:
        for part in cut_special(text, self.special):
            if part in self.special:
                yield struct.pack("<I", self.special[part])
                continue
            run = None
            for piece, goes_on in pieces(part):
                if run is None and not goes_on:
                    yield self._piece(piece)
                    continue
                run = run or LongRun(self)
                yield from run.feed(piece, goes_on)
                run = run if goes_on else None

    def _piece(self, piece: str) -> bytes:
        """A piece that ends where a word ends. Normalization has made all white space single spaces."""
        if self.common and not _UNCOMMON.search(piece):
            words = unicodedata.normalize("NFC", piece).lower().split()
        else:
            words = self.normal(piece).split(" ")
        known = self.remembered
        out = []
        for w in words:
            got = known.get(w)
            if got is None:
                got = self.word(w)
                if len(w) <= LONG_WORD:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[w] = got
            out.append(got)
        return b"".join(out)

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():  # its bytes stand for themselves
            if word.isalpha():
                return self.numbers(self.transducer.encode(word))
            if self.ascii is not None:
                return b"".join([self._part(t, self.remembered) for t in self.ascii(word)])
        return b"".join([self._part(symbols, self.parts) for symbols, _ in self.pre(word)]) if word else b""

    def _part(self, symbols: str, known: dict[str, bytes]) -> bytes:
        got = known.get(symbols)
        if got is None:
            got = self.numbers(self.transducer.encode(symbols))
            if len(symbols) <= LONG_WORD:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[symbols] = got
        return got

    def numbers(self, tokens: list[str]) -> bytes:
        ids = self.ids
        return struct.pack(f"<{len(tokens)}I", *[ids[t] for t in tokens])

    def decode(self, ids: bytes) -> str:
        return "".join(self.decoded(ids))

    def decoded(self, ids: bytes) -> Iterator[str]:
        """The text of ids in parts: bytes that do not finish a character wait for those that follow."""
        machine, of = codecs.getincrementaldecoder("utf-8")("replace"), self.bytes_of
        numbers = np.frombuffer(ids, "<u4")
        for at in range(0, len(numbers), PIECE):
            raw = b"".join([of[i] for i in numbers[at : at + PIECE].tolist()])
            yield machine.decode(raw[self.lead :] if at == 0 else raw)
        yield machine.decode(b"", True)


class LongRun:
    """Text without a blank that comes in several pieces. The last pre-token of a piece may go on in the next: short ones are held
    back, of a long one the transducer stays open."""

    #: Pre-tokens up to this length are held back: no contraction is longer.
    SHORT = 8

    def __init__(self, bpe: Bpe):
        self.bpe, self.held, self.run, self.kind = bpe, "", None, ""

    def feed(self, piece: str, goes_on: bool) -> Iterator[bytes]:
        b = self.bpe
        words = b.normal(piece).split(" ")
        for i, w in enumerate(words):
            yield from self._word(w, goes_on and i == len(words) - 1)

    def _word(self, text: str, goes_on: bool) -> Iterator[bytes]:
        b = self.bpe
        if self.run is not None:
            first = b.classes[self.kind](text)
            same = first[0][0] if first and text.startswith(first[0][0]) else ""
            yield b.numbers([*self.run.push(self._symbols(same))])
            text = text[len(same) :]
            if text or not goes_on:
                yield b.numbers(self.run.close())
                self.run = None
            else:
                return
        text, self.held = self.held + text, ""
        if not goes_on or not text:
            yield b.word(text)
            return
        tokens = self._tokens(text)
        tail = tokens[-1]
        if len(tail) > self.SHORT:
            yield b.word(text[: len(text) - len(tail)])
            found = b.classes["letters"](tail)
            self.run, self.kind = b.transducer.open(), "letters" if found and found[0][0] == tail else "others"
            yield b.numbers([*self.run.push(self._symbols(tail))])
            return
        # What ends a few characters before is settled: no pre-token looks further ahead.
        ends = np.cumsum([len(t) for t in tokens])
        settled = ends[ends <= len(text) - self.SHORT]
        cut = int(settled[-1]) if len(settled) else 0
        yield b.word(text[:cut])
        self.held = text[cut:]

    def _symbols(self, text: str) -> str:
        return "".join([self.bpe.letters[x] for x in text.encode()])

    def _tokens(self, text: str) -> list[str]:
        back = self.bpe.byte_of
        return [b"".join([back[c] for c in symbols]).decode() for symbols, _ in self.bpe.pre(text)]


def cut_special(text: str, special: dict[str, int]) -> Iterator[str]:
    """The text between special tokens, and these, in order; of those that begin at one place the longest."""
    at = 0
    while special:
        found = [(p, -len(s), s) for s in special if (p := text.find(s, at)) >= 0]
        if not found:
            break
        place, _, name = min(found)
        if place > at:
            yield text[at:place]
        yield name
        at = place + len(name)
    if at < len(text):
        yield text[at:]


def pieces(text: str) -> Iterator[tuple[str, bool]]:
    """The text in pieces of about PIECE characters, and whether a piece's last word goes on in the next. Pieces end at a blank or a line's
    end; in a longer run of others, before a character that normalization does not join with those before it."""
    at, n = 0, len(text)
    while n - at > PIECE:
        end, goes_on = max(text.rfind(" ", at, at + PIECE), text.rfind("\n", at, at + PIECE)) + 1, False
        if end <= at:
            end, goes_on = at + PIECE, True
            while end < n and not _starts(text[end]):
                end += 1
        if end >= n:
            break
        yield text[at:end], goes_on
        at = end
    if at < n:
        yield text[at:], False


def _starts(c: str) -> bool:
    """Whether normalization leaves the border before c alone: no mark, no vowel or final letter of Hangul, nothing unassigned."""
    return c < "\x80" or (unicodedata.category(c)[0] in "LNPS" and not unicodedata.combining(c) and not "\u1160" <= c <= "\u11ff")


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every whole text, a row for each input row.

    A null text counts as empty and has no ids; a null doc_id stays null; repeated rows are encoded alike; other columns are
    not looked at. `path` names a tokenizer file that every executor has.
    """
    ship(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path)
        ids = [bpe.encode(t or "") for t in column(batch, "text").to_pylist()]
        return pa.record_batch({"doc_id": column(batch, "doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())})

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(docs, run, "doc_id long, n_tokens long, ids binary", text="text")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids and text, the decoded ids, a row for each input row; null ids give an empty text."""
    ship(tokens.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path)
        texts = [bpe.decode(x or b"") for x in column(batch, "ids").to_pylist()]
        return pa.record_batch({"doc_id": column(batch, "doc_id"), "n_tokens": column(batch, "n_tokens"), "ids": column(batch, "ids"), "text": pa.array(texts, pa.string())})

    return map_batches(tokens.select("doc_id", "n_tokens", "ids"), run, "doc_id long, n_tokens long, ids binary, text string", text="ids")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """decode(encode(docs)) in one pass: doc_id, n_tokens, ids and the decoded text, by one Python worker a task."""
    ship(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path)
        ids = [bpe.encode(t or "") for t in column(batch, "text").to_pylist()]
        return pa.record_batch({"doc_id": column(batch, "doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary()), "text": pa.array(map(bpe.decode, ids), pa.string())})

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(docs, run, "doc_id long, n_tokens long, ids binary, text string", text="text")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the 49k vocabulary and decoded again."""
    path = public_tokenizers.path("word_bpe_49k.json")
    there = round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return there.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
