"""String, regular-expression, bit-string and blob functions.  Positions and lengths count code points."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.registry import FUNCTIONS, alias, col, let, register

for _n in "ascii bit_length levenshtein lower upper md5 octet_length reverse sha1 translate url_decode".split():
    FUNCTIONS[_n] = lambda *a, _f=getattr(F, _n): _f(*[col(a[0]), *a[1:]])
FUNCTIONS["levenshtein"] = lambda a, b: F.levenshtein(col(a), col(b))
FUNCTIONS["translate"] = lambda s, a, b: F.translate(col(s), a, b)
alias("lower", "lcase")
alias("upper", "ucase")
alias("octet_length", "strlen")
alias("levenshtein", "editdist3")


def _lit(x: Column | str | object) -> Column:
    """Here a plain string is a literal, as for patterns and separators."""
    return x if isinstance(x, Column) else F.lit(x)


@register("unicode", "ord")
def unicode(s):
    return F.when(col(s) == "", F.lit(-1)).otherwise(F.ascii(col(s)))


@register("length", "char_length", "character_length", "len")
def length(s):
    return F.length(col(s))


@register("^@", "starts_with", "prefix")
def starts_with(s, p):
    return F.startswith(col(s), _lit(p))


@register("suffix", "ends_with")
def ends_with(s, p):
    return F.endswith(col(s), _lit(p))


@register("contains")
def contains(s, p):
    return F.contains(col(s), _lit(p))


@register("instr", "position", "strpos")
def instr(s, p):
    return F.locate(p, col(s)) if isinstance(p, str) else F.call_function("instr", col(s), p)


@register("~~")
def like(s, p: str):
    return col(s).like(p)


@register("~~*")
def ilike(s, p: str):
    return col(s).ilike(p)


@register("!~~")
def not_like(s, p: str):
    return ~col(s).like(p)


@register("!~~*")
def not_ilike(s, p: str):
    return ~col(s).ilike(p)


@register("like_escape")
def like_escape(s, p, e):
    return F.like(col(s), F.lit(p), F.lit(e))


@register("ilike_escape")
def ilike_escape(s, p, e):
    return F.ilike(col(s), F.lit(p), F.lit(e))


@register("not_like_escape")
def not_like_escape(s, p, e):
    return ~like_escape(s, p, e)


@register("not_ilike_escape")
def not_ilike_escape(s, p, e):
    return ~ilike_escape(s, p, e)


@register("~~~", "glob")
def glob(s, p: str):
    """Shell patterns: * ? [abc] [!abc]."""
    out, i = "", 0
    while i < len(p):
        c = p[i]
        if c == "[" and (j := p.find("]", i + 2)) > 0:
            inside = p[i + 1 : j]
            out += "[" + ("^" + inside[1:] if inside[0] in "!^" else inside).replace("\\", "\\\\") + "]"
            i = j
        else:
            out += {"*": "[\\s\\S]*", "?": "[\\s\\S]"}.get(c, re.escape(c))
        i += 1
    return F.regexp_like(col(s), F.lit(f"^(?:{out})\\z"))


@register("left")
def left(s, n: int):
    """A negative count leaves out that many at the end."""
    s = col(s)
    return F.substring(s, 1, n) if n >= 0 else F.substr(s, F.lit(1), F.greatest(F.length(s) + n, F.lit(0)))


@register("right")
def right(s, n: int):
    s = col(s)
    return F.right(s, F.lit(n)) if n >= 0 else F.substr(s, F.lit(1 - n))


@register("substring", "substr")
def substring(s, start: int, n: int | None = None):
    """1-based; a start of 0 is before the first; a negative start counts from the end; a negative length goes left."""
    s = col(s)
    size = F.length(s)
    begin = F.lit(start) if start >= 0 else size + start + 1
    if n is None:
        return F.substr(s, F.greatest(begin, F.lit(1)))
    low, high = (begin, begin + n) if n >= 0 else (begin + n, begin)
    first = F.greatest(low, F.lit(1))
    return F.substr(s, first, F.greatest(high - first, F.lit(0)))


@register("lpad")
def lpad(s, n: int, c: str):
    return F.lpad(col(s), n, c)


@register("rpad")
def rpad(s, n: int, c: str):
    return F.rpad(col(s), n, c)


#: What one-argument trims strip: Unicode space separators.
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


@register("trim")
def trim(s, chars: str = SPACES):
    return F.btrim(col(s), F.lit(chars))


@register("ltrim")
def ltrim(s, chars: str = SPACES):
    return F.ltrim(col(s), F.lit(chars))


@register("rtrim")
def rtrim(s, chars: str = SPACES):
    return F.rtrim(col(s), F.lit(chars))


@register("repeat")
def repeat(s, n: int):
    return F.repeat(col(s), n)


@register("replace")
def replace(s, a, b):
    return F.replace(col(s), _lit(a), _lit(b))


@register("concat")
def concat(*xs):
    """Nulls count as empty."""
    return F.concat(*[F.coalesce(col(x).cast("string"), F.lit("")) for x in xs])


@register("||")
def concat_op(*xs):
    return F.concat(*[col(x) for x in xs])


@register("concat_ws")
def concat_ws(sep: str, *xs):
    return F.concat_ws(sep, *[col(x).cast("string") for x in xs])


@register("string_split", "split", "str_split", "string_to_array")
def string_split(s, sep: str):
    return F.split(col(s), "(?!^)(?=[\\s\\S])" if sep == "" else java_quote(sep), -1)


def java_quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


@register("string_split_regex", "regexp_split_to_array", "str_split_regex")
def string_split_regex(s, p: str, options: str = ""):
    return F.split(col(s), _options(options) + p, -1)


@register("split_part")
def split_part(s, sep: str, n: int):
    """Empty where there is no such part."""
    parts = string_split(s, sep)
    return F.when(col(s).isNotNull(), F.coalesce(F.try_element_at(parts, F.lit(n)), F.lit("")))


def _options(o: str) -> str:
    """c, i, m or n or p, s as inline flags."""
    flags = {"i": "(?i)", "m": "(?m)", "n": "(?m)", "p": "(?m)", "s": "(?s)"}
    return "".join(flags.get(c, "") for c in o)


@register("regexp_matches", "regexp_like")
def regexp_matches(s, p: str, options: str = ""):
    return F.regexp_like(col(s), F.lit(_options(options) + p))


@register("regexp_full_match")
def regexp_full_match(s, p: str):
    return F.regexp_like(col(s), F.lit(f"^(?:{p})\\z"))


@register("regexp_extract")
def regexp_extract(s, p: str, group: int | list[str] = 0, options: str = ""):
    """Empty where nothing matches.  A list of names gives a struct of the groups from 1 on."""
    p = _options(options) + p
    if isinstance(group, int):
        return F.regexp_extract(col(s), p, group)
    return F.struct(*[F.regexp_extract(col(s), p, i + 1).alias(n) for i, n in enumerate(group)])


@register("regexp_extract_all")
def regexp_extract_all(s, p: str, group: int = 0, options: str = ""):
    return F.regexp_extract_all(col(s), F.lit(_options(options) + p), group)


@register("regexp_replace")
def regexp_replace(s, p: str, r: str, options: str = ""):
    """The first match only, unless options has g.  Groups in r are \\\\1."""
    r = re.sub(r"\\(\d)", r"$\1", r.replace("$", "\\$"))
    p = _options(options) + p
    if "g" in options:
        return F.regexp_replace(col(s), F.lit(p), F.lit(r))
    shifted = re.sub(r"\$(\d)", lambda m: f"${int(m[1]) + 1}", r) if "\\$" not in r else r
    return F.regexp_replace(col(s), F.lit(f"\\A([\\s\\S]*?)(?:{p})"), F.lit("$1" + shifted))


@register("regexp_escape")
def regexp_escape(s):
    return F.regexp_replace(col(s), F.lit("([^A-Za-z0-9_])"), F.lit("\\\\$1"))


@register("chr")
def chr_(n):
    """Any code point, by its UTF-8 bytes."""
    n = col(n)
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


@register("bin", "to_binary")
def bin_(n):
    return F.bin(col(n))


@register("unbin", "from_binary")
def unbin(s):
    return F.unhex(F.conv(col(s), 2, 16))


@register("hex", "to_hex")
def hex_(x):
    return F.hex(col(x))


@register("unhex", "from_hex")
def unhex(s):
    return F.unhex(col(s))


@register("encode")
def encode(s):
    return F.encode(col(s), "UTF-8")


@register("decode")
def decode(b):
    return F.decode(col(b), "UTF-8")


@register("to_base64", "base64")
def to_base64(b):
    return F.base64(col(b).cast("binary"))


@register("from_base64")
def from_base64(s):
    return F.unbase64(col(s))


@register("sha256")
def sha256(s):
    return F.sha2(col(s), 256)


@register("url_encode")
def url_encode(s):
    return F.replace(F.replace(F.replace(F.url_encode(col(s)), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _little_endian(digits: Column, at: int) -> Column:
    """Eight bytes of hexadecimal digits, the first lowest."""
    return F.conv(F.concat(*[F.substring(digits, at + 2 * i, 2) for i in reversed(range(8))]), 16, 10).cast("decimal(20,0)")


@register("md5_number_upper")
def md5_number_upper(s):
    return _little_endian(F.md5(col(s)), 1)


@register("md5_number_lower")
def md5_number_lower(s):
    return _little_endian(F.md5(col(s)), 17)


@register("regexp_split_to_table")
def regexp_split_to_table(s, pattern: str):
    """A row per part."""
    return F.explode(F.split(col(s), pattern, -1))


@register("md5_number")
def md5_number(s):
    """The digest as a 128-bit number, in text (Spark's decimals end at 38 digits)."""
    return _md5_number(col(s))


@F.pandas_udf(T.StringType())
def _md5_number(s: pd.Series) -> pd.Series:
    import hashlib

    return s.map(lambda x: str(int.from_bytes(hashlib.md5(x.encode()).digest(), "little")), na_action="ignore")


@register("to_base")
def to_base(n, radix: int, width: int = 0):
    out = F.conv(col(n), 10, radix)
    return F.lpad(out, width, "0") if width else out


@register("bar")
def bar(x, low: float, high: float, width: int = 80):
    """A bar of blocks, its end to an eighth."""
    share = F.least(F.greatest((col(x) - low) / (high - low), F.lit(0.0)), F.lit(1.0)) * width
    eighths = F.floor((share - F.floor(share)) * 8).cast("int")
    ends = F.array(*map(F.lit, ["", *"▏▎▍▌▋▊▉"]))
    body = F.concat(F.repeat(F.lit("█"), F.floor(share).cast("int")), F.get(ends, eighths))
    return F.rpad(body, width, " ")


@register("format")
def format_(pattern: str, *xs):
    """{} fields, as str.format has them."""
    out, rest = [], re.split(r"\{\}", pattern)
    for i, part in enumerate(rest):
        out.append(F.lit(part.replace("{{", "{").replace("}}", "}")))
        if i < len(xs) and i < len(rest) - 1:
            out.append(col(xs[i]).cast("string"))
    return F.concat(*out)


@register("printf")
def printf(pattern: str, *xs):
    return F.format_string(pattern.replace("%i", "%d"), *map(col, xs))


def _readable(n: Column, units: list[str], base: int) -> Column:
    out, whole = F.concat(n.cast("string"), F.lit(f" {units[0]}")), F.abs(n)
    div = lambda x, k: F.call_function("div", x, F.lit(k).cast("long"))
    for i, u in enumerate(units[1:], 1):
        tenth = div((div(whole, base ** (i - 1)) % base) * 10, base)  # of what is left at the unit below
        text = F.concat(div(whole, base**i).cast("string"), F.lit("."), tenth.cast("string"), F.lit(f" {u}"))
        out = F.when(whole >= base**i, text).otherwise(out)
    return F.when(n == 1, F.lit("1 byte")).otherwise(out)


@register("format_bytes", "formatReadableSize")
def format_bytes(n):
    return _readable(col(n).cast("long"), ["bytes", "KiB", "MiB", "GiB", "TiB", "PiB"], 1024)


@register("formatReadableDecimalSize")
def format_decimal_bytes(n):
    return _readable(col(n).cast("long"), ["bytes", "kB", "MB", "GB", "TB", "PB"], 1000)


@register("parse_formatted_bytes")
def parse_formatted_bytes(s):
    s = F.upper(F.regexp_replace(col(s), " ", ""))
    number, unit = F.regexp_extract(s, r"^([0-9.]+)", 1).cast("double"), F.regexp_extract(s, "([A-Z]*)$", 1)
    out = number
    for i, u in enumerate("KMGTP", 1):
        out = F.when(unit.isin(f"{u}B", u), number * 1000**i).when(unit == f"{u}IB", number * 1024**i).otherwise(out)
    return F.round(out).cast("long")


def _separator(sep: str) -> str:
    return {"system": "[/]", "both_slash": "[/\\\\]", "forward_slash": "[/]", "backslash": "[\\\\]"}[sep]


@register("parse_path")
def parse_path(p, sep: str = "both_slash"):
    """Its elements, the root kept as one."""
    p, s = col(p), _separator(sep)
    parts = F.filter(F.split(p, f"{s}+", -1), lambda x: x != "")
    return F.when(F.regexp_like(p, F.lit(f"^{s}")), F.concat(F.array(F.substring(p, 1, 1)), parts)).otherwise(parts)


@register("parse_filename")
def parse_filename(p, trim_extension: bool = False, sep: str = "both_slash"):
    name = F.element_at(F.split(col(p), _separator(sep), -1), -1)
    return F.regexp_replace(name, r"(.)\.[^.]*$", "$1") if trim_extension else name


@register("parse_dirname")
def parse_dirname(p, sep: str = "both_slash"):
    p, s = col(p), _separator(sep)
    return F.when(F.regexp_like(p, F.lit(f"^{s}")), F.substring(p, 1, 1)).when(F.regexp_like(p, F.lit(s)), F.element_at(F.split(p, s, -1), 1)).otherwise("")


@register("parse_dirpath")
def parse_dirpath(p, sep: str = "both_slash"):
    p, s = col(p), _separator(sep)
    return F.regexp_replace(F.regexp_extract(p, f"^([\\s\\S]*){s}", 1), f"(.){s}+$", "$1")


@register("hamming", "mismatches")
def hamming(a, b):
    """Places that differ in strings of one length."""
    differ = lambda a, b: F.size(F.filter(F.sequence(F.lit(1), F.length(a)), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))).cast("long")
    return let(F.struct(col(a).alias("a"), col(b).alias("b")), lambda s: differ(s["a"], s["b"]))


@register("jaccard")
def jaccard(a, b):
    """Of the sets of characters."""
    chars = lambda s: F.array_distinct(F.split(col(s), "(?!^)(?=[\\s\\S])", -1))
    both = F.struct(chars(a).alias("a"), chars(b).alias("b"))
    return let(both, lambda s: F.size(F.array_intersect(s["a"], s["b"])) / F.size(F.array_union(s["a"], s["b"])))


#: Numbers that a slice of pairs may take in a table of their places.
PLACES = 4_000_000


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a row a text, filled up with zeros; lengths."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    width = max(int(sizes.max()), 1)
    return np.array(texts, f"U{width}").view(np.uint32).reshape(len(texts), width), sizes


def _front(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Each row's chosen values first, in their order."""
    return np.take_along_axis(values, np.argsort(~chosen, axis=1, kind="stable"), axis=1)


def jaro(a: list[str], b: list[str]) -> np.ndarray:
    """The similarity of each pair; all pairs go through the places of their texts together."""
    (x, nx), (y, ny) = _codes(a), _codes(b)
    reach = np.maximum(np.maximum(nx, ny) // 2 - 1, 0)[:, None]
    place, rows = np.arange(y.shape[1])[None, :], np.arange(len(a))
    inside = place < ny[:, None]
    taken, mine = np.zeros(y.shape, bool), np.zeros(x.shape, bool)
    for i in range(x.shape[1]):
        free = (y == x[:, i : i + 1]) & inside & ~taken & (np.abs(place - i) <= reach) & (nx > i)[:, None]
        mine[:, i] = free.any(axis=1)
        taken[rows[mine[:, i]], free.argmax(axis=1)[mine[:, i]]] = True
    m = mine.sum(axis=1)
    k = min(x.shape[1], y.shape[1])
    moved = ((_front(x, mine)[:, :k] != _front(y, taken)[:, :k]) & (np.arange(k) < m[:, None])).sum(axis=1) // 2
    some = np.maximum(m, 1)
    found = (m / np.maximum(nx, 1) + m / np.maximum(ny, 1) + (m - moved) / some) / 3
    return np.where((nx == 0) & (ny == 0), 1.0, np.where(m == 0, 0.0, found))


def jaro_winkler(a: list[str], b: list[str]) -> np.ndarray:
    j = jaro(a, b)
    (x, nx), (y, ny) = _codes(a), _codes(b)
    k = min(4, x.shape[1], y.shape[1])
    alike = (x[:, :k] == y[:, :k]) & (np.arange(k) < np.minimum(nx, ny)[:, None])
    same = np.logical_and.accumulate(alike, axis=1).sum(axis=1)
    return np.where(j > 0.7, j + same * 0.1 * (1 - j), j)


def damerau(a: list[str], b: list[str]) -> np.ndarray:
    """Edits and swaps of neighbours, each pair of places once (true Damerau distance); all pairs go through one table's cells together."""
    (x, nx), (y, ny) = _codes(a), _codes(b)
    rows = np.arange(len(a))
    d = np.zeros((x.shape[1] + 2, y.shape[1] + 2, len(a)), np.int32)
    d[0], d[:, 0] = nx + ny, nx + ny
    d[1:, 1], d[1, 1:] = np.arange(x.shape[1] + 1)[:, None], np.arange(y.shape[1] + 1)[:, None]
    last = np.zeros(y.shape, np.int64)  # of each of y's characters: the place in x, so far, where it was last
    for i in range(1, x.shape[1] + 1):
        equal = y == x[:, i - 1 : i]
        match = np.zeros(len(a), np.int64)
        for j in range(1, y.shape[1] + 1):
            k, l = last[:, j - 1], match
            swap = d[k, l, rows] + (i - k - 1) + 1 + (j - l - 1)
            edit = np.minimum(d[i, j] + ~equal[:, j - 1], np.minimum(d[i + 1, j], d[i, j + 1]) + 1)
            d[i + 1, j + 1] = np.minimum(edit, swap)
            match = np.where(equal[:, j - 1], j, match)
        last[equal] = i
    return d[nx + 1, ny + 1, rows].astype(np.int64)


def _slices(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Runs of pairs whose tables of places, as wide as the longest texts, take at most PLACES numbers (or one pair)."""
    out, start, p, q = [], 0, 0, 0
    for i, (s, t) in enumerate(zip(a, b, strict=True)):
        p, q = max(p, len(s)), max(q, len(t))
        if i > start and (i + 1 - start) * (p + 2) * (q + 2) > PLACES:
            out.append((start, i))
            start, p, q = i, len(s), len(t)
    return [*out, (start, len(a))] if a else []


def _two(fn, kind: T.DataType):
    @F.pandas_udf(kind)
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known = (a.notna() & b.notna()).to_numpy()
        s, t = a[known].tolist(), b[known].tolist()
        out = np.full(len(a), None, object)
        if s:
            out[known] = np.concatenate([fn(s[i:j], t[i:j]) for i, j in _slices(s, t)])
        return pd.Series(out)

    return lambda a, b: run(col(a), col(b))


FUNCTIONS["jaro_similarity"] = _two(jaro, T.DoubleType())
FUNCTIONS["jaro_winkler_similarity"] = _two(jaro_winkler, T.DoubleType())
FUNCTIONS["damerau_levenshtein"] = _two(damerau, T.LongType())


def _one(fn, kind: T.DataType):
    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return s.map(fn, na_action="ignore")

    return run


_GRAPHEME = regex.compile(r"\X")
#: Two printable ASCII characters are never of one grapheme.
_APART = re.compile("(?<=[ -~])(?=[ -~])")


def graphemes(x: str) -> list[str]:
    return [g for part in _APART.split(x) for g in ((part,) if len(part) == 1 else _GRAPHEME.findall(part))]


FUNCTIONS["nfc_normalize"] = lambda s: _one(lambda x: unicodedata.normalize("NFC", x), T.StringType())(col(s))
FUNCTIONS["strip_accents"] = lambda s: _one(lambda x: "".join(c for c in unicodedata.normalize("NFD", x) if not unicodedata.combining(c)), T.StringType())(col(s))
FUNCTIONS["length_grapheme"] = lambda s: _one(lambda x: len(graphemes(x)), T.LongType())(col(s))
FUNCTIONS["left_grapheme"] = lambda s, n: _one(lambda x: "".join(graphemes(x)[:n]), T.StringType())(col(s))
FUNCTIONS["right_grapheme"] = lambda s, n: _one(lambda x: "".join(graphemes(x)[-n:] if n else []), T.StringType())(col(s))
FUNCTIONS["substring_grapheme"] = lambda s, a, n: _one(lambda x: "".join(graphemes(x)[a - 1 : a - 1 + n]), T.StringType())(col(s))


# Bit strings are strings of 0 and 1.
@register("bitstring")
def bitstring(s, n: int):
    return F.lpad(col(s), n, "0")


@register("get_bit")
def get_bit(s, i: int):
    return F.substring(col(s), i + 1, 1).cast("int")


@register("set_bit")
def set_bit(s, i: int, v: int):
    return F.overlay(col(s), F.lit(str(v)), i + 1, 1)


@register("bit_position")
def bit_position(sub: str, s):
    return F.locate(sub, col(s))
