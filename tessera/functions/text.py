"""Text views of names and addresses."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Words and endings that carry no identity.
STOP_TOKENS = ["llc", "ltd", "limited", "inc", "incorporated", "corp", "corporation", "co", "company", "pvt", "private", "plc", "llp", "lp", "the", "and"]
LEGAL_SUFFIXES = ["private limited", "pvt ltd", "pvt limited", "private ltd", "ltd", "limited", "llc", "inc", "incorporated", "corp", "corporation", "co", "company", "pllc", "services", "associates", "group"]
DOMAIN_STARTS = ["www", "http", "https"]
DOMAIN_ENDS = ["com", "org", "net", "in", "co", "io", "biz", "info"]
#: Letters that decomposition leaves whole, and their ASCII spelling.
LATIN_LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "ð": "d", "þ": "th", "ı": "i"}


def norm(c: Column) -> Column:
    """Lower case, ASCII punctuation to spaces, runs of space to one; trimmed before, not after."""
    plain = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(plain, r"\p{Punct}", " "), r"\s+", " ")


def compact(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"[\s\p{Punct}]", "")


def country_norm(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", "")


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda x: F.trim(x) != "")


def numeric_tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda x: (F.trim(x) != "") & x.rlike("[0-9]"))


def digits(c: Column, at_least: int = 1) -> Column:
    """All runs of at least so many digits."""
    return F.regexp_extract_all(c, F.lit("[0-9]{%d,}" % at_least), F.lit(0))


def _strip(s: str | None) -> str | None:
    if s is None or s.isascii():
        return s
    return unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", s) if unicodedata.category(x)[0] != "M"))


@F.pandas_udf(StringType())
def _strip_udf(s: pd.Series) -> pd.Series:
    return s.map(_strip)


def strip_accents(c: Column) -> Column:
    """Without combining marks."""
    return _strip_udf(c)


#: Offsets in every block of an Indic script, and their Latin spelling.
INDIC_VOWELS = {0x05: "a", 0x06: "aa", 0x07: "i", 0x08: "ii", 0x09: "u", 0x0A: "uu", 0x0F: "e", 0x10: "ai", 0x13: "o", 0x14: "au"}
INDIC_SIGNS = {0x3E: "aa", 0x3F: "i", 0x40: "ii", 0x41: "u", 0x42: "uu", 0x47: "e", 0x48: "ai", 0x4B: "o", 0x4C: "au", 0x4D: "", 0x02: "n", 0x01: "n", 0x03: "h", 0x3C: ""}
INDIC_CONSONANTS = ["k", "kh", "g", "gh", "n", "c", "ch", "j", "jh", "n", "t", "th", "d", "dh", "n", "t", "th", "d", "dh", "n", "n", "p", "ph", "b", "bh", "m", "y", "r", "r", "l", "l", "l", "v", "sh", "ss", "s", "h"]


def latin(s: str | None) -> str | None:
    """A Latin reading of the text, for keys; not a scholarly romanisation.  Blank text gives None."""
    if s is None or not s.strip():
        return None
    if s.isascii():
        return s
    out, inherent = [], False
    for ch in unicodedata.normalize("NFKC", s):
        code, block = ord(ch), (ord(ch) - 0x0900) % 0x80
        if 0x0900 <= code < 0x0D80:
            if 0x15 <= block <= 0x39:
                out.append(("a" if inherent else "") + INDIC_CONSONANTS[block - 0x15])
                inherent = True
                continue
            if block in INDIC_SIGNS:
                if block in (0x01, 0x02, 0x03):
                    out.append("a" if inherent else "")
                out.append(INDIC_SIGNS[block])
            elif block in INDIC_VOWELS:
                out.append(("a" if inherent else "") + INDIC_VOWELS[block])
            elif 0x66 <= block <= 0x6F:
                out.append(str(block - 0x66))
            inherent = False
            continue
        inherent = False
        low = ch.lower()
        out.append(LATIN_LETTERS.get(low, _strip(low) or ""))
    return "".join(out)


@F.pandas_udf(StringType())
def _latin_udf(s: pd.Series) -> pd.Series:
    return s.map(latin)


def ascii_view(c: Column) -> Column:
    """Lower-case Latin reading; text that is ASCII already is only lower-cased."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.lower(F.coalesce(_latin_udf(c), F.lit("")))).otherwise(F.lower(c))


def ascii_key(c: Column) -> Column:
    """Latin reading with anything but a-z and 0-9 as single spaces, trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(ascii_view(c), F.lit("")), "[^a-z0-9]+", " "))


def _unicode_view(s: str | None) -> str:
    kept = "".join(x if unicodedata.category(x)[0] in "LN" else " " for x in unicodedata.normalize("NFKC", s or "").casefold())
    return " ".join(kept.split())


@F.pandas_udf(StringType())
def unicode_view(s: pd.Series) -> pd.Series:
    """NFKC, case fold, letters and numbers only."""
    return s.map(_unicode_view)


def core_name(stripped: Column) -> Column:
    """The name up to its first legal ending."""
    return F.trim(F.regexp_replace(stripped, r"\b(" + "|".join(LEGAL_SUFFIXES) + r")\b.*$", ""))


def domain_name(stripped_compact: Column) -> Column:
    """The compact name without one leading and one trailing part of a web address."""
    return F.regexp_replace(F.regexp_replace(stripped_compact, "^(" + "|".join(DOMAIN_STARTS) + ")", ""), "(" + "|".join(DOMAIN_ENDS) + ")$", "")


def _jaro_winkler(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = bytearray(len(b)), bytearray()
    for i, x in enumerate(a):
        j = b.find(x, max(0, i - reach), i + reach + 1)
        while j >= 0 and used[j]:
            j = b.find(x, j + 1, i + reach + 1)
        if j >= 0:
            used[j] = 1
            left.append(x)
    if not left:
        return 0.0
    right = bytes(y for y, u in zip(b, used) if u)
    m, t = len(left), sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


#: Pairs that are compared at once, and bytes of the longest string for which that is done.
_AT_ONCE, _LONGEST = 2048, 256


def _padded(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings without nulls as rows of a matrix, padded with zeros, and their lengths."""
    raw = strings.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    size = np.diff(offsets)
    out = np.zeros((len(size), max(int(size.max(initial=0)), 1)), np.uint8)
    if size.sum():
        out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return out, size


def _masks(codes: np.ndarray, letters: int) -> list[np.ndarray]:
    """For every string and letter, the places of the letter as bits, 64 to a word; letter 0 is padding and stands nowhere."""
    words = []
    for w in range(0, codes.shape[1], 64):
        table = np.zeros((len(codes), letters), np.uint64)
        rows = np.arange(len(codes))
        for j in range(w, min(w + 64, codes.shape[1])):
            table[rows, codes[:, j]] |= np.uint64(1) << np.uint64(j - w)
        table[:, 0] = 0
        words.append(table.ravel())
    return words


def _jaro_winklers(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray, masks: list[np.ndarray], at: np.ndarray, letters: int) -> np.ndarray:
    """_jaro_winkler of rows of codes that are not empty, all pairs at once; masks of the strings b are told by at."""
    n, one = len(a), np.uint64(1)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    where = (a.T.astype(np.int64) + at * letters).copy()
    # window: bits i - reach to i + reach, shifted up by one for every i
    window = [np.zeros(n, np.uint64) for _ in masks]
    for w in range(len(masks)):
        bits = np.clip(reach - 64 * w, 0, 64).astype(np.uint64)  # bits 0 to reach - 1, as for i = -1
        window[w] = np.where(bits == 64, np.uint64(2**64 - 1), (one << (bits & np.uint64(63))) - one)
    used = [np.zeros(n, np.uint64) for _ in masks]
    matched = np.zeros((a.shape[1], n), bool)
    for i in range(a.shape[1]):
        carry = (i <= reach).astype(np.uint64)
        free = np.ones(n, bool)
        for w, table in enumerate(masks):
            window[w], carry = (window[w] << one) | carry, window[w] >> np.uint64(63)
            hit = table[where[i]] & window[w] & ~used[w]
            if w:
                hit *= free
            used[w] |= hit & (~hit + one)
            free &= hit == 0
        matched[i] = ~free
    left = np.ascontiguousarray(matched.T)
    right = np.concatenate([np.unpackbits(u.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little") for u in used], axis=1)[:, : b.shape[1]].astype(bool)
    m = left.sum(axis=1)
    differ = np.concatenate([[0], np.cumsum(a[left] != b[right])])
    ends = np.cumsum(m)
    t = (differ[ends] - differ[ends - m]) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m == 0, 0.0, (m / la + m / lb + (m - t) / m) / 3)
    k = min(4, a.shape[1], b.shape[1])
    same = (a[:, :k] == b[:, :k]) & (a[:, :k] != 0) & (b[:, :k] != 0)
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro <= 0.7, jaro, jaro + 0.1 * prefix * (1 - jaro))


def jaro_winklers(a: pa.Array, b: pa.Array) -> pa.Array:
    """_jaro_winkler of every pair of two string arrays; null where either is."""
    out = np.zeros(len(a))
    known = np.asarray(pc.and_(pc.is_valid(a), pc.is_valid(b)))
    todo = np.flatnonzero(known)
    if len(todo):
        x, y = (v.take(pa.array(todo)).dictionary_encode() for v in (a, b))
        ia, ib = (np.asarray(v.indices).astype(np.int64) for v in (x, y))
        long = max(pc.max(pc.binary_length(v.dictionary)).as_py() for v in (x, y)) > _LONGEST
        if long:
            sa, sb = ([s.encode() for s in v.dictionary.to_pylist()] for v in (x, y))
            pairs, back = np.unique(ia * len(sb) + ib, return_inverse=True)
            out[todo] = np.array([_jaro_winkler(sa[p // len(sb)], sb[p % len(sb)]) for p in pairs.tolist()])[back]
        else:
            (ma, la), (mb, lb) = _padded(x.dictionary), _padded(y.dictionary)
            there = np.zeros(256, bool)
            there[ma] = True
            there[mb] = True
            there[0] = False
            code = np.zeros(256, np.uint8)
            letters = int(there.sum()) + 1
            code[there] = np.arange(1, letters)
            zero_bytes = bool((ma == 0).sum() > (ma.shape[1] - la).sum() or (mb == 0).sum() > (mb.shape[1] - lb).sum())
            if zero_bytes or letters > 255:
                sa, sb = ([s.encode() for s in v.dictionary.to_pylist()] for v in (x, y))
                out[todo] = [_jaro_winkler(sa[i], sb[j]) for i, j in zip(ia.tolist(), ib.tolist())]
            else:
                ca, cb = code[ma], code[mb]
                for s in range(0, len(todo), _AT_ONCE):
                    i, j = ia[s : s + _AT_ONCE], ib[s : s + _AT_ONCE]
                    some, at = np.unique(j, return_inverse=True)
                    xs, ys, nx, ny = ca[i], cb[j], la[i], lb[j]
                    whole = (nx > 0) & (ny > 0)
                    score = np.zeros(len(i))
                    if whole.any():
                        score[whole] = _jaro_winklers(xs[whole], nx[whole], ys[whole], ny[whole], _masks(cb[some], letters), at[whole], letters)
                    out[todo[s : s + _AT_ONCE]] = score
    return pa.array(out, pa.float64(), mask=~known)


@F.arrow_udf(DoubleType())
def _jaro_winkler_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    return jaro_winklers(a, b)


def jaro_winkler(a: Column | str, b: Column | str) -> Column:
    """Jaro-Winkler over UTF-8 bytes, the prefix counted only above 0.7; null if either is.

    Equal and empty strings are settled here; only others are sent to Python, where a batch's pairs are compared at once, with a string's
    letters as bits.
    """
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    open_ = (a != b) & (a != "") & (b != "")
    settled = F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when((a == b) & (a != ""), F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0))
    return settled.otherwise(_jaro_winkler_udf(F.when(open_, a), F.when(open_, b)))
