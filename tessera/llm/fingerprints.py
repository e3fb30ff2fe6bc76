"""Document fingerprints by Order MinHash.

Method.  The k-mers are runs of K words (fewer words make one run), each numbered by its occurrence
in the text, so that a repeated run counts as often as it stands there.  The numbered k-mers are
hashed once; the hash's top bits deal them into BINS bins, which take the place of as many hash
functions.  For each bin that holds a k-mer the PICK smallest hashes from the bin's start on are
selected, in a ring, so that a bin with one k-mer borrows the next bin's least; they are put back
into text order and hashed as a tuple.  A signature is the list of bin and tuple hash; the share of
equal entries among bins that either text fills falls with the edit distance, since an edit changes
the minima and a move changes their order, in texts of any length.

Cases.  Null text counts as empty and has the empty fingerprint; two empty fingerprints are alike
(1), an empty and a full one not (0).  Rows that repeat id and text are one document in the
succession; each of them is returned.  Null ids come last in descending order, ties are ordered by a
digest of the text.  A single document is its own successor.  Words past 2**26 count, but their
order is taken modulo that.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

K, PICK, BINS = 2, 2, 64
_VALUE, _PLACE = 37, 26  # bits of a hash and of a place in one long


def _mask(bits: int) -> Column:
    return F.lit((1 << bits) - 1).cast("long")


def _packed(value: Column, place: Column) -> Column:
    return F.shiftleft(value.bitwiseAND(_mask(_VALUE)), _PLACE).bitwiseOR(place.cast("long").bitwiseAND(_mask(_PLACE)))


def _value(x: Column) -> Column:
    return F.shiftright(x, _PLACE)


def _starts(x: Column, shift: int) -> Column:
    """Places where the sorted longs change above the shift."""
    return F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: (i == 0) | (F.shiftright(F.get(x, i), shift) != F.shiftright(F.get(x, i - 1), shift)))


def signature(text: Column) -> Column:
    """array<bigint>: bin * 2**26 + 26 bits of the tuple's hash, by bin."""

    def of_words(t: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - (K - 1), F.lit(1))), lambda i: _packed(F.xxhash64(F.slice(t, i, F.lit(K))), i - 1))
        return F.when(F.size(t) == 0, F.array().cast("array<bigint>")).otherwise(common.let(F.sort_array(runs), numbered))

    def numbered(s: Column) -> Column:
        def one(starts: Column) -> Column:
            each = F.transform(starts, lambda a, j: F.transform(F.sequence(a, F.coalesce(F.get(starts, j + 1), F.size(s)) - 1), lambda i: _packed(F.xxhash64(_value(F.get(s, i)), i - a), F.get(s, i))))
            return common.let(F.sort_array(F.flatten(each)), entries)

        return common.let(_starts(s, _PLACE), one)

    def entries(v: Column) -> Column:
        top = _PLACE + _VALUE - 6  # 64 bins

        def one(starts: Column) -> Column:
            def entry(a: Column) -> Column:
                picked = F.transform(F.sequence(F.lit(0), F.least(F.lit(PICK), F.size(v)) - 1), lambda i: F.get(v, (a + i) % F.size(v)))
                ordered = F.sort_array(F.transform(picked, lambda x: F.shiftleft(x.bitwiseAND(_mask(_PLACE)), _VALUE).bitwiseOR(_value(x))))
                tuple_hash = F.xxhash64(F.transform(ordered, lambda x: x.bitwiseAND(_mask(_VALUE)))).bitwiseAND(_mask(26))
                return F.shiftleft(F.shiftright(F.get(v, a), top), 26).bitwiseOR(tuple_hash)

            return F.transform(starts, entry)

        return common.let(_starts(v, top), one)

    return common.let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(common.WORD), F.lit(0)), of_words)


def as_text(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda e: F.lpad(F.lower(F.hex(e)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Equal entries over bins that either signature fills, 0 to 1."""
    either = F.size(F.array_union(F.transform(a, lambda e: F.shiftright(e, 26)), F.transform(b, lambda e: F.shiftright(e, 26))))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def succession(docs: DataFrame) -> DataFrame:
    """(key, doc_id, n, next_key) of the distinct documents in descending id order, in a ring."""
    ids = docs.select("doc_id", common.doc_key("doc_id", "text").alias("key"), F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n")).distinct()
    placed, total = common.ranked(ids, [F.col("doc_id").desc_nulls_last(), F.col("key")], "at")
    after = placed.select(F.pmod(F.col("at") - 1, F.lit(max(total, 1))).alias("at"), F.col("key").alias("next_key"))
    return common.cut(placed.join(after, "at").select("key", "doc_id", "n", "next_key"))


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    ring = succession(docs)
    rows = docs.select(common.doc_key("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("text"), signature(F.col("text")).alias("sig"))
    share = F.floor(F.col("n") / 3).cast("int")
    heads = ring.select(F.col("key").alias("k"), "doc_id", "n", F.col("next_key").alias("key")).join(rows, "key")
    heads = heads.select("k", "doc_id", "n", F.substring("text", F.lit(1), share).alias("head"), F.col("sig").alias("next_sig")).dropDuplicates(["k"])
    both = rows.join(heads, F.col("key") == F.col("k"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n") - share).cast("int")), F.col("head"))
    both = both.select("doc_id", F.col("n").alias("n_chars"), edited.alias("edited"), "sig", "next_sig")
    out = both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sig", signature(F.col("edited")).alias("esig"), "next_sig")
    return out.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("sig")).alias("fingerprint"), as_text(F.col("esig")).alias("edited_fingerprint"), likeness(F.col("sig"), F.col("esig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
