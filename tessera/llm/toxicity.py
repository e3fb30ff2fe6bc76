"""Toxicity by a factorization machine over hashed terms.

Method.  A text's terms are its distinct lower-cased words without outer punctuation, and their
first four and five characters, each hashed to BITS bits.  score = sigmoid(b + sum of w over the
text's terms + sum of <v_i, v_j> over pairs of its terms): the vectors learn pairs, such as an
insult beside a group's name, that weights alone cannot.  All terms of LEAST rows or more are trained
by AdaGrad, the weights first and then the vectors too.  After each step a term's weight, and the
length of its vector, shrink by a multiple of the noise that chance leaves in its gradient, so a word
that tells nothing alone gets no weight and still has a vector for what it tells in pairs.

The machine is fitted on at most about `sample` labelled rows (SAMPLE) and `sample_bytes` of their
texts (SAMPLE_BYTES), chosen by a hash of the id, of which rows with equal terms count once; every
text is scored whole.

Cases.  Null and empty texts have no terms and get sigmoid(b).  Labels that are null or belong to a
null id or an id without a document are not used; an id with several labels is toxic if one is.
Rows with a null id count as held out.  Rows that repeat an id are scored each.  Without labels, or
with labels of one kind alone, every score is 0.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE, SAMPLE_BYTES = 16_000, 96 << 20
BITS = 22
FACTORS, EPOCHS, LEAST = 8, 30, 5
#: Training: rows a step, size of the first vectors, rates and penalties of weights and vectors, epochs of weights alone.
BATCH, START, RATE_W, RATE_V, L1_W, L1_V, FIRST = 128, 0.05, 0.3, 0.1, 1.0, 1.0, 5
_EDGE = re.compile(r"^\W+|\W+$")


def _hashed(words: list[str]) -> np.ndarray:
    """A row of three terms for each word: itself, its first four and its first five characters; words without a letter or digit have none and get -1."""
    names, none = [], []
    for i, word in enumerate(words):
        w = word if word.isalnum() else _EDGE.sub("", word)
        if not w:
            none.append(i)
        b = w.encode("utf-8", "surrogatepass")
        names += b, b"4" + w[:4].encode("utf-8", "surrogatepass") if len(w) >= 4 else b, b"5" + w[:5].encode("utf-8", "surrogatepass") if len(w) >= 5 else b
    out = (common.hashes(names) >> np.uint64(64 - BITS)).astype(np.int64).reshape(-1, 3)
    out[none] = -1
    return out


def _words(text: str | None) -> set[str]:
    return set((text or "").lower().split())


class Machine:
    """terms (kept hashes, sorted), bias, weights, vectors."""

    def __init__(self, terms: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray):
        self.terms, self.bias, self.w, self.v = terms, bias, w, v

    def score(self, text: str | None) -> float:
        x, words = self.bias, _words(text)
        if words and len(self.terms):
            found = _hashed(list(words)).ravel()
            at = np.minimum(np.searchsorted(self.terms, found), len(self.terms) - 1)
            i = np.unique(at[self.terms[at] == found])
            v = self.v[i]
            x += float(self.w[i].sum() + 0.5 * (v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 20240607) -> tuple | None:
    """(terms, bias, w, v) from the distinct terms of each row; the rows are replaced by their places in terms."""
    if not len(rows) or labels.min() == labels.max():
        return None
    seen = np.zeros(1 << BITS, np.int32)
    for r in rows:
        seen[r] += 1  # a row's terms are distinct
    keep = np.flatnonzero(seen >= LEAST)
    place = np.full(1 << BITS, -1, np.int32)
    place[keep] = np.arange(len(keep))
    noise = np.sqrt(labels.mean() * (1 - labels.mean()) / seen[keep])  # of a term's mean gradient, a row
    p = labels.mean()
    rng = np.random.RandomState(seed)
    order = rng.permutation(len(rows))
    batches = []
    for s in range(0, len(order), BATCH):
        some = order[s : s + BATCH]
        parts = []
        for i in some:  # every row ends with a term past the last, which has no weight, so that none is empty
            k = place[rows[i]]
            parts.append(np.append(k[k >= 0], len(keep)))
            rows[i] = None
        sizes = np.array([len(x) for x in parts])
        uniq, inv, m = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        doc = np.repeat(np.arange(len(some), dtype=np.uint8), sizes)[np.argsort(inv, kind="stable")]  # the rows of each term in turn
        batches.append((labels[some], np.cumsum(sizes) - sizes, uniq.astype(np.int32), inv.astype(np.uint16 if len(uniq) <= 1 << 16 else np.int32), doc, np.append(0, np.cumsum(m)).astype(np.int32)))
    del place, seen, rows
    w, v, b = np.zeros(len(keep) + 1), rng.normal(0, START, (FACTORS, len(keep) + 1)).astype(np.float32), float(np.log(p / (1 - p)))
    v[:, -1], noise = 0, np.append(noise, 0)
    gw, gv, gb = np.ones(len(w)), np.ones(len(w)), 1.0
    for epoch in range(EPOCHS):
        for at in rng.permutation(len(batches)):
            marks, rows_at, uniq, inv, doc, ends = batches[at]
            m, terms_at = np.diff(ends), ends[:-1]
            vu, mine = np.take(v, uniq, axis=1), uniq[:-1]
            sums = np.add.reduceat(np.take(vu, inv, axis=1), rows_at, axis=1)
            x = b + np.add.reduceat((w[uniq] - 0.5 * (vu**2).sum(axis=0))[inv], rows_at) + 0.5 * (sums**2).sum(axis=0)
            g = 1 / (1 + np.exp(-np.clip(x, -30, 30))) - marks
            total = np.add.reduceat(g[doc], terms_at)
            least, scale = (m * noise[uniq])[:-1], np.sqrt((sums**2).sum(axis=0).mean())
            gw[mine] += total[:-1] ** 2
            gb += g.sum() ** 2
            step = RATE_W / np.sqrt(gw[mine])
            wu = w[mine] - step * total[:-1]
            w[mine] = np.sign(wu) * np.maximum(np.abs(wu) - step * L1_W * least, 0)
            dv = (np.add.reduceat((g * sums).astype(np.float32)[:, doc], terms_at, axis=1) - total * vu)[:, :-1]
            gv[mine] += (dv**2).mean(axis=0)
            if epoch >= FIRST:
                step = RATE_V / np.sqrt(gv[mine])
                vu = vu[:, :-1] - step * dv
                size = np.sqrt((vu**2).sum(axis=0)) + 1e-12
                v[:, mine] = vu * np.maximum(1 - step * L1_V * scale * least / size, 0)
            b -= 0.1 * g.sum() / np.sqrt(gb)
    w, v = w[:-1], v[:, :-1].T
    some = (w != 0) | v.any(axis=1)  # the others add nothing to any score
    return keep[some], b, w[some], np.ascontiguousarray(v[some])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> tuple | None:
    """The machine of docs (doc_id, text) with labels (doc_id, toxic)."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    count, draw = marks.count(), F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(7)), 1)
    below = lambda share: draw < F.lit(min(int(2**63 * share), 2**63 - 1))
    share = 0.97 * sample / count if count > sample else 1.0
    marks = common.hinted(common.cut(marks.where(below(share))), min(count, sample))
    size = docs.select("doc_id", F.octet_length("text").alias("size")).join(marks, "doc_id").agg(F.sum("size")).first()[0] or 0
    if size > sample_bytes:
        marks = common.hinted(marks.where(below(share * sample_bytes / size)), min(count, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0):
                terms = np.unique(_hashed(list(_words(text.as_py()))))
                out.append(terms[terms >= 0].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column(1)], names=["terms", "toxic"])

    rows = docs.select("doc_id", "text").join(marks, "doc_id").select("text", "toxic")
    found = common.mapped(rows, run, "terms binary, toxic int").groupBy("terms").agg(F.max("toxic").alias("toxic"))
    found = sorted((bytes(r[0]), r[1]) for r in found.toLocalIterator())  # at most `sample` rows
    if not found:
        return None
    rows, toxic = [np.frombuffer(t, "<u4") for t, _ in found], np.array([y for _, y in found])
    del found  # train replaces the rows
    machine = train(rows, toxic)
    common.give_back()  # else the freed arrays stay with the driver while later stages run
    return machine


def scored(docs: DataFrame, machine: tuple | None, text_col: str = "text") -> DataFrame:
    """docs with score (0 to 1) for every whole text."""
    names = [c for c in docs.columns if c != "score"]
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*names).dtypes) + ", score double"
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by BITS and by the sample's terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value and Machine(*sent.value)
        for batch in batches:
            got = [m.score(t.as_py()) if m else 0.0 for t in batch.column(names.index(text_col))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=[*names, "score"])

    return common.mapped(docs.select(*names), run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that score 0.5 or more; the machine learns from all labelled documents."""
    machine = fit(docs, labels)
    cols = docs.columns
    out = scored(docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(cols)]), machine, f"_{cols.index('text')}").where("score < 0.5")
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(cols)])


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    machine = fit(docs.where(~held), labels.where(~held))
    out = scored(docs.select("doc_id", held.alias("held_out"), "text"), machine)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
