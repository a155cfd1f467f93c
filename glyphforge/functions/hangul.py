"""Hangul letters and the scores of a prediction against a gold text, with wildcards, as Spark columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphforge.functions.geometry import let
from glyphforge.functions.text import chars, normalize_text

WILDCARD = "□"
#: Compatibility letters of the three places of a syllable, in order of Unicode composition (fixed values).
LEADS = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ"
VOWELS = "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"
TAILS = "ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"
_FIRST, _LAST = 0xAC00, 0xD7A3
#: Places of a word of bits.
BLOCK = 62


def letters(c: Column, wildcard: str = WILDCARD) -> Column:
    """Syllables as two or three letters, a wildcard three times, other characters as they are; a string."""

    def one(ch: Column) -> Column:
        n = F.ascii(ch) - _FIRST
        pick = lambda table, i: F.substring(F.lit(table), (i + 1).cast("int"), F.lit(1))
        split = F.concat(pick(LEADS, F.floor(n / 588)), pick(VOWELS, F.floor(n % 588 / 28)), F.when(n % 28 > 0, pick(TAILS, n % 28 - 1)).otherwise(""))
        return F.when(ch == wildcard, wildcard * 3).when((n >= 0) & (n <= _LAST - _FIRST), split).otherwise(ch)

    return F.array_join(F.transform(chars(c), one), "")


def _word(bits: int) -> Column:
    return F.lit(bits).cast("long")


def wildcard_distance(gold: Column, pred: Column, wildcard: str = WILDCARD) -> Column:
    """T5: edit distance of two strings where each wildcard of gold takes up one token of pred, or none, for nothing.

    By bit vectors: a row of the table of distances is kept as the places where it goes up and down along pred, in words of
    BLOCK bits (longs, so that their sums do not overflow). A token of gold moves all places of a word by a few operations. A
    wildcard's row is the lesser of each cell above and its left neighbour, so ups move on by one place and meet the downs.
    """
    full, top = _word((1 << BLOCK) - 1), BLOCK - 1
    zero, one = _word(0), _word(1)
    wild = F.ascii(F.lit(wildcard))
    inverse = lambda c: F.bitwise_not(c).bitwiseAND(full)
    moved = lambda c, by: F.shiftleft(c, 1).bitwiseAND(full).bitwiseOR(by)

    def mask(block: Column, t: Column) -> Column:
        """The places of a block that hold t."""
        return F.aggregate(block, zero, lambda acc, x: F.when(x.c == t, acc.bitwiseOR(x.bit)).otherwise(acc))

    def word(up: Column, down: Column, eq: Column, free: Column, high: Column, low: Column) -> Column:
        """A word of the next row, and what it hands on to the word above; high and low are handed on by the word below."""

        def ends(w: Column) -> Column:
            new_up = moved(w.downs, low).bitwiseOR(inverse(eq.bitwiseOR(down).bitwiseOR(w.ups)))
            new_down = w.ups.bitwiseAND(eq.bitwiseOR(down))
            return F.struct(new_up.alias("up"), new_down.alias("down"), w.high.alias("high"), F.shiftright(w.downs, top).alias("low"))

        def across(a: Column) -> Column:
            ups = down.bitwiseOR(inverse(a.bitwiseOR(up)))
            return let(F.struct(moved(ups, high).alias("ups"), up.bitwiseAND(a).alias("downs"), F.shiftright(ups, top).alias("high")), ends)

        match = eq.bitwiseOR(low)
        plain = let((match.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseAND(full).bitwiseOR(match), across)
        over = moved(up, high)
        skipped = F.struct(over.bitwiseAND(inverse(down)).alias("up"), down.bitwiseAND(inverse(over)).alias("down"), F.shiftright(up, top).alias("high"), zero.alias("low"))
        return F.when(free, skipped).otherwise(plain)

    def found(x: Column, masks: Column, t: Column, none: Column) -> Column:
        return F.coalesce(F.get(masks, (F.array_position(x.both, t) - 1).cast("int")), none)

    def within_one(x: Column) -> Column:
        """Texts whose pred has one word, without lists of words."""
        masks = lambda cells: F.transform(x.both, lambda t: mask(cells, t))
        tokens = lambda held: F.transform(x.g, lambda t: F.struct((t == wild).alias("free"), found(x, held, t, zero).alias("eq")))
        step = lambda s, t: word(s.up, s.down, t.eq, t.free, F.when(t.free, zero).otherwise(one), zero)
        real = F.call_function("shiftright", full, BLOCK - F.size(x.p))
        count = lambda s: F.bit_count(s.up.bitwiseAND(real)) - F.bit_count(s.down.bitwiseAND(real))
        start = F.struct(full.alias("up"), zero.alias("down"), zero.alias("high"), zero.alias("low"))
        return let(let(cells_of(x), masks), lambda held: F.aggregate(tokens(held), start, step, count))

    def over_several(x: Column) -> Column:
        blocks = let(cells_of(x), lambda cells: F.transform(F.sequence(F.lit(0), F.floor((F.size(x.p) - 1) / BLOCK).cast("int")), lambda b: F.slice(cells, b * BLOCK + 1, BLOCK)))

        def step(state: Column, t: Column) -> Column:
            def put(acc: Column, x: Column) -> Column:
                return let(word(x.up, x.down, x.eq, t.free, acc.high, acc.low), lambda w: F.struct(F.concat(acc.done, F.array(F.struct(w.up.alias("up"), w.down.alias("down")))).alias("done"), w.high.alias("high"), w.low.alias("low")))

            words = F.transform(state, lambda w, k: F.struct(w.up.alias("up"), w.down.alias("down"), F.coalesce(F.get(t.eq, k), zero).alias("eq")))
            first = F.struct(F.slice(state, 1, 0).alias("done"), F.when(t.free, zero).otherwise(one).alias("high"), zero.alias("low"))
            return F.aggregate(words, first, put, lambda acc: acc.done)

        def run(held: Column) -> Column:
            start = F.transform(held, lambda b: F.struct(full.alias("up"), zero.alias("down")))
            masks = F.transform(x.both, lambda t: F.transform(held, lambda b: mask(b, t)))
            tokens = let(masks, lambda m: F.transform(x.g, lambda t: F.struct((t == wild).alias("free"), found(x, m, t, F.array().cast("array<bigint>")).alias("eq"))))
            # Of the last word only the places of pred count; what lies above never comes down.
            real = lambda w, k: w.bitwiseAND(F.call_function("shiftright", full, F.greatest(F.lit(0), (k + 1) * BLOCK - F.size(x.p))))
            count = lambda state: F.aggregate(F.transform(state, lambda w, k: F.bit_count(real(w.up, k)) - F.bit_count(real(w.down, k))), F.lit(0), lambda a, v: a + v)
            return F.aggregate(tokens, start, step, count)

        return let(blocks, run)

    def cells_of(x: Column) -> Column:
        return F.transform(x.p, lambda c, k: F.struct(c.alias("c"), F.call_function("shiftleft", one, k % BLOCK).alias("bit")))

    def distance(x: Column) -> Column:
        n = F.size(F.filter(x.g, lambda t: t != wild))
        return F.when(F.size(x.p) == 0, n).otherwise(n + F.when(F.size(x.p) <= BLOCK, within_one(x)).otherwise(over_several(x)))

    codes = lambda c: F.transform(chars(c), lambda ch: F.ascii(ch))
    # Masks are made once for each token that both texts have; a wildcard's are not looked at.
    told = lambda x: F.struct(x.g.alias("g"), x.p.alias("p"), F.array_intersect(x.g, x.p).alias("both"))
    return let(let(F.struct(codes(gold).alias("g"), codes(pred).alias("p")), told), distance)


def _wildcard_pattern(gold: Column, wildcard: str) -> Column:
    """A regex that takes any character or none for each wildcard, all others literally."""
    quoted = F.regexp_replace(gold, r"([\\\[\](){}.*+?^$|\-&~#\s])", r"\\$1")
    return F.concat(F.lit("^(?s:"), F.replace(quoted, F.lit(wildcard), F.lit(".?")), F.lit(r")\z"))


def is_match(gold: Column, pred: Column, wildcard: str = WILDCARD) -> Column:
    """1 if the normalised texts are equal, or would be with each wildcard of gold taking up one character or none."""
    return F.when(gold == pred, 1).when(F.contains(gold, F.lit(wildcard)) & F.rlike(pred, _wildcard_pattern(gold, wildcard)), 1).otherwise(0)


def similarity(gold: Column, pred: Column, wildcard: str = WILDCARD) -> Column:
    """One minus the letters' edit distance over the longer side; a wildcard on either side turns its rules on."""
    g, p = letters(gold, wildcard), letters(pred, wildcard)
    active = F.contains(gold, F.lit(wildcard)) | F.contains(pred, F.lit(wildcard))
    distance = F.when(active, wildcard_distance(g, p, wildcard)).otherwise(F.levenshtein(g, p))
    size = F.when(active, F.length(F.replace(g, F.lit(wildcard), F.lit("")))).otherwise(F.length(g))
    return F.when(gold == pred, 1.0).otherwise(1 - distance / F.greatest(size, F.lit(1), F.length(p)))


def score_columns(gold: Column, pred: Column, wildcard: str = WILDCARD, ignore_blank: bool = True, lower: bool = False) -> tuple[Column, Column]:
    """(is_match, similarity) of the normalised texts."""
    if len(wildcard) != 1 or re.match(r"\s", wildcard):
        raise ValueError("a wildcard is one character that is not white space")
    g, p = normalize_text(gold, ignore_blank, lower), normalize_text(pred, ignore_blank, lower)
    return is_match(g, p, wildcard), similarity(g, p, wildcard)
