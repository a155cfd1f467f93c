"""Text expressions with Python's notions of white space, digits, floats and paths, as Spark columns.

Cells are strings; a missing cell, null and the empty string are equal (`cell`).
"""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space that Python strips and splits at (fixed values), as a regex class body.
WS = r"\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: The characters of that class.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{WS}]", c))
TRUE, FALSE = ("true", "1", "yes", "t"), ("false", "0", "no", "f")
_FLOAT = r"^[+-]?(?:(?:\d+(?:_\d+)*)(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+(?:_\d+)*)?$|^[+-]?(?i:inf|infinity|nan)$"


def _digit_class() -> str:
    """Characters with str.isdigit(), as a regex class body: decimal digits, and those like superscripts that are not decimal."""
    extra = [c for c in range(sys.maxunicode + 1) if chr(c).isdigit() and unicodedata.category(chr(c)) != "Nd"]
    return r"\p{Nd}" + "".join(f"\\x{{{c:X}}}" for c in extra)


DIGIT = _digit_class()
SYLLABLE = r"\uAC00-\uD7A3"
KOREAN = SYLLABLE + r"\u1100-\u11FF\u3130-\u318F"
ENGLISH = "A-Za-z"
SPECIAL = r"\p{P}\p{S}"
CATEGORIES = ("korean", "english", "digit", "special", "space", "other")
GROUPS = ("korean", "korean_plus", "english", "english_plus", "korean_english", "korean_english_plus", "others")


def cell(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def is_true(c: Column) -> Column:
    """True, 1, yes or t, whatever the case; blank is neither true nor false."""
    return F.lower(strip(cell(c))).isin(*TRUE)


def is_false(c: Column) -> Column:
    return F.lower(strip(cell(c))).isin(*FALSE)


def to_bool(c: Column) -> Column:
    return F.when(is_true(c), True).when(is_false(c), False)


def py_float(c: Column) -> Column:
    """The double that Python's float() reads from a cell, null where it would raise (ASCII digits only)."""
    s = strip(cell(c))
    return F.when(s.rlike(_FLOAT), F.regexp_replace(s, "_", "").try_cast("double"))


def normalize_text(c: Column, ignore_blank: bool = True, lower: bool = False) -> Column:
    """Stripped; with ignore_blank, all white space removed."""
    s = cell(c)
    out = F.regexp_replace(s, f"[{WS}]", "") if ignore_blank else strip(s)
    return F.lower(out) if lower else out


def to_text(c: Column) -> Column:
    """Stripped; the words nan and none, whatever their case, count as empty."""
    s = strip(cell(c))
    return F.when(F.lower(s).isin("nan", "none"), "").otherwise(s)


def slashes(c: Column) -> Column:
    return F.replace(strip(cell(c)), F.lit("\\"), F.lit("/"))


def file_stem(c: Column) -> Column:
    """The last path element without its last suffix; a leading dot is no suffix."""
    name = F.regexp_extract(F.regexp_replace(slashes(c), "/+$", ""), "([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def extension(c: Column, case_sensitive: bool = True) -> Column:
    """The last suffix with its dot, (no_ext) without one."""
    name = F.regexp_extract(slashes(c), "([^/]*)$", 1)
    ext = F.regexp_extract(name, r".(\.[^.]+)$", 1)
    ext = ext if case_sensitive else F.lower(ext)
    return F.when(ext == "", "(no_ext)").otherwise(ext)


def subset_image_path(c: Column) -> Column:
    """What follows the first text_images/, or the whole path, without leading slashes."""
    p = F.regexp_replace(slashes(c), "^/+", "")
    at = F.instr(p, "text_images/")
    return F.when(at > 0, F.substring(p, at + len("text_images/"), F.length(p))).otherwise(p)


def jsonl_filename(c: Column) -> Column:
    """The origin's prefix goes from the file name."""
    return F.regexp_replace(slashes(c), "(^|/)(?:aihub_|gist_|kaist_)([^/]*)$", "$1$2")


def path_prefix(c: Column, tokens: int = 4) -> Column:
    """The first non-empty path elements."""
    return F.array_join(F.slice(F.filter(F.split(slashes(c), "/"), lambda x: x != ""), 1, tokens), "/")


def replace_prefix(c: Column, old: str, new: str) -> Column:
    """A whole-element prefix replaced; slashes and blanks are normalised even if nothing is replaced."""
    p, o, n = slashes(c), old.strip().replace("\\", "/").strip("/"), new.strip().replace("\\", "/").strip("/")
    tail = F.substring(p, len(o) + 1, 1 << 30)
    return F.when(p == o, F.lit(n)).when(p.startswith(o + "/"), F.concat(F.lit(n), tail)).otherwise(p)


def keyword_mapping(c: Column, mapping: dict[str, str]) -> Column:
    """Every pair replaced, in order."""
    for old, new in mapping.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def prefixed_id(c: Column, prefix: str) -> Column:
    """The prefix in front, unless there already; a blank id stays blank."""
    s = strip(cell(c))
    return F.when(s == "", "").when(s.startswith(prefix), s).otherwise(F.concat(F.lit(prefix), s))


def text_id(scene_id: Column, inner: Column) -> Column:
    s, i = strip(cell(scene_id)), strip(cell(inner))
    return F.when((s == "") | (i == ""), "").otherwise(F.concat_ws("_", s, i))


def format_number(c: Column) -> Column:
    """An integral double without its fraction."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def before_colon(c: Column) -> Column:
    """What stands before the first colon, right-stripped."""
    return F.regexp_replace(F.substring_index(c, ":", 1), f"[{WS}]+$", "")


def numeric_id(c: Column) -> Column:
    """The integer that a cell is, else its last all-digit element between _ and -, else 0."""
    s = strip(cell(c))
    whole = F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("long"))
    last = F.regexp_extract(s, r"^(?s:.*[_-])?(\d+(?:\r\n|[\n\r\x85\u2028\u2029])?)(?s:[_-].*)?\z", 1)  # greedy: the last one
    return F.coalesce(whole, last.try_cast("long"), F.lit(0).cast("long"))


def bucket_path(scene_id: Column, item_id: Column, root: str = "text_images", size: int = 1000, ext: str = "jpg") -> Column:
    """root/bucket/item.ext, the bucket being the scene's number div size."""
    bucket = F.floor(numeric_id(scene_id) / size).cast("string")
    return F.concat_ws("/", *([F.lit(root.strip("/"))] if root.strip("/") else []), bucket, F.concat(strip(cell(item_id)), F.lit("." + ext.lstrip("."))))


def text_length(c: Column, ignore_space: bool = False) -> Column:
    """Code points."""
    return F.length(F.regexp_replace(cell(c), f"[{WS}]", "") if ignore_space else cell(c))


def char_category(ch: Column) -> Column:
    """T14 for analyses: space, korean (with jamo), english, digit, special (punctuation and symbols), other."""
    return (
        F.when(ch.rlike(f"^[{WS}]"), "space").when(ch.rlike(f"^[{KOREAN}]"), "korean").when(ch.rlike(f"^[{ENGLISH}]"), "english")
        .when(ch.rlike(f"^[{DIGIT}]"), "digit").when(ch.rlike(f"^[{SPECIAL}]"), "special").otherwise("other")
    )


def chars(c: Column) -> Column:
    """The characters of a cell; none of an empty one."""
    return F.filter(F.split(cell(c), ""), lambda x: x != "")


def language_category(c: Column, ignore_space: bool = True) -> Column:
    """P10: the classes of the characters in order of first appearance, joined by +; OTHERS if there is none.

    Each class is searched for once; the common characters of ASCII are told first, as those of DIGIT take long.
    """
    digit = rf"[0-9]|(?![\x00-\x7F])[{DIGIT}]"
    classes = {"KOR": f"[{KOREAN}]", "ENG": f"[{ENGLISH}]", "DIGIT": digit, "SPECIAL": f"(?![ 0-9{ENGLISH}])[^{WS}{KOREAN}{ENGLISH}{DIGIT}]"}
    classes |= {} if ignore_space else {"SPACE": f"[{WS}]"}
    n = len(classes)
    found = F.sort_array(F.array(*(F.nullif(F.regexp_instr(cell(c), F.lit(p)), F.lit(0)) * n + i for i, p in enumerate(classes.values()))))
    names = F.array(*map(F.lit, classes))
    kinds = F.concat_ws("+", *(F.get(names, F.get(found, F.lit(i)) % n) for i in range(n)))
    return F.coalesce(F.nullif(kinds, F.lit("")), F.lit("OTHERS"))


def words(c: Column) -> Column:
    return F.filter(F.split(cell(c), f"[{WS}]+"), lambda w: w != "")


def word_group(word: Column, spaced: Column | None = None) -> Column:
    """Which scripts a word has; with `spaced` true (its text has white space) pure groups become _plus."""
    korean, english = word.rlike(f"[{KOREAN}]"), word.rlike(f"[{ENGLISH}]")
    plus = word.rlike(f"[^{KOREAN}{ENGLISH}]")
    plus = plus | spaced if spaced is not None else plus
    base = F.when(korean & english, "korean_english").when(korean, "korean").when(english, "english")
    return F.when(base.isNull(), "others").when(plus, F.concat(base, F.lit("_plus"))).otherwise(base)


def has_class(c: Column, kind: str) -> Column:
    """The split filters' classes: kor (syllables only), eng, digit, special, space, others (none of these)."""
    body = {"kor": SYLLABLE, "eng": ENGLISH, "digit": DIGIT, "space": WS}
    if kind in body:
        return cell(c).rlike(f"[{body[kind]}]")
    if kind == "special":
        return cell(c).rlike(f"[{SPECIAL}&&[^{SYLLABLE}{ENGLISH}{DIGIT}{WS}]]")
    return cell(c).rlike(f"[^{SYLLABLE}{ENGLISH}{DIGIT}{WS}{SPECIAL}]")


def python_regex(pattern: str) -> str:
    """A Python pattern in Java's dialect; what has no equal there raises."""
    re.compile(pattern)
    if "(?(" in pattern or r"\N{" in pattern:
        raise ValueError(f"pattern has no Java equivalent: {pattern}")
    return re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<").replace(r"\Z", r"\z"))
