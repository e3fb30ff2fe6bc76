"""Language identification with spans.

Method.  Each word gets a score for each language: log-probabilities of its hashed character
n-grams (1 to 4, with word ends) and of the whole word, by naive Bayes.  The word's script, from
ranges of code points, leaves only languages written in it.  Viterbi over the words, with a penalty
for a switch of language, labels spans of mixed text; a text's language is that of most letters, and
its score the share of those letters times the posterior against the runner-up.

The model is fitted on at most `sample` labelled rows (SAMPLE), chosen by a hash of the id; every
text is labelled whole.

Cases.  Null text, or text without a letter: `und`, score 0, no spans.  Rows with a null id are
never learned from and count as held out; rows that repeat an id are labelled each.  Words without
letters take their neighbours' language.  Without labelled rows every text is `und`.  Ties go to the
language that sorts first.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE = 20_000
BITS = 17
SIZE = 1 << BITS
PENALTY = 8.0
WEIGHT = 0.35
#: First and last code points of scripts.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F), ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul_jamo", 0x1100, 0x11FF), ("latin_more", 0x1E00, 0x1EFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]
_FIRST = np.array([a for _, a, _ in SCRIPTS])
_LAST = np.array([z for _, _, z in SCRIPTS])
_NAME = np.array([0 if n.startswith("latin") else i + 1 for i, (n, _, _) in enumerate(SCRIPTS)])
N_SCRIPTS = len(SCRIPTS) + 2  # the last stands for all others


def script_of(word: str) -> int:
    """Number of the script of the word's first letter; the last number if no range has it."""
    for ch in word:
        if ch.isalpha():
            i = int(np.searchsorted(_FIRST, ord(ch), "right")) - 1
            return int(_NAME[i]) if i >= 0 and ord(ch) <= _LAST[i] else N_SCRIPTS - 1
    return N_SCRIPTS - 1


def n_letters(word: str) -> int:
    return len(word) if word.isalpha() else sum(map(str.isalpha, word))


def grams(words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets by n (one for each character place; SIZE where no n-gram starts), and the words' first places."""
    line = "".join(f"\x02{w}\x03" for w in words)
    cp = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.flatnonzero(cp == 2)
    ends = np.append(starts[1:], len(cp))
    left = np.repeat(ends, ends - starts) - np.arange(len(cp))  # places to the word's end
    found, h = [], np.zeros(len(cp), np.uint64)
    for n in range(1, 5):
        h = h[: len(cp) - n + 1] * np.uint64(0x100000001B3) + cp[n - 1 :] + np.uint64(n)
        x = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        b = np.full(len(cp), SIZE, np.int64)
        b[: len(x)] = (x >> np.uint64(64 - BITS)).astype(np.int64)
        b[left < n] = SIZE
        found.append(b)
    whole = np.full(len(cp), SIZE, np.int64)
    sums = np.add.reduceat(found[2].astype(np.uint64) * (np.arange(len(cp), dtype=np.uint64) - np.repeat(starts, ends - starts).astype(np.uint64) + np.uint64(1)), starts) if len(starts) else np.empty(0, np.uint64)
    x = (sums + np.uint64(77)) * np.uint64(0x9E3779B97F4A7C15)
    whole[starts] = (x >> np.uint64(64 - BITS)).astype(np.int64)
    return [*found, whole], starts


def _split(text: str | None) -> list[str]:
    return (text or "").lower().split()


class Model:
    """langs, table (SIZE + 1 rows of scores), allowed (script by language)."""

    def __init__(self, langs: list[str], table: np.ndarray, allowed: np.ndarray):
        self.langs, self.table, self.allowed = langs, table, allowed

    @classmethod
    def of(cls, langs: list[str], counts: np.ndarray, letters: np.ndarray) -> Model:
        p = counts + 0.5
        p = np.log(p / p.sum(axis=0, keepdims=True))
        table = np.zeros((SIZE + 1, len(langs)), np.float32)
        table[:SIZE] = (p - p.mean(axis=1, keepdims=True)) * WEIGHT
        allowed = letters / np.maximum(letters.sum(axis=0, keepdims=True), 1) >= 0.005
        allowed[~allowed.any(axis=1)] = True
        return cls(langs, table, allowed)

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.langs)), np.float32)
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            buckets, starts = grams(part)
            s = self.table[buckets[0]]
            for b in buckets[1:]:
                s += self.table[b]
            out[i : i + len(part)] = np.add.reduceat(s, starts)
        scripts = np.array([script_of(w) for w in words])
        out[~self.allowed[scripts]] -= 30
        return out

    def label(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text: letters of each word, labels, scores summed by language."""
        ids: dict[str, int] = {}
        docs = [np.array([ids.setdefault(w, len(ids)) for w in _split(t)], np.int64) for t in texts]
        words = list(ids)
        letters = np.array([n_letters(w) for w in words], np.int64)
        scores = self.word_scores(words) if words else np.zeros((0, len(self.langs)), np.float32)
        scores[letters == 0] = 0
        scores = np.vstack([scores, np.zeros((1, len(self.langs)), np.float32)])
        out: list = [None] * len(docs)
        order = sorted((i for i in range(len(docs)) if len(docs[i])), key=lambda i: len(docs[i]))
        i = 0
        while i < len(order):
            j = i + 1
            while j < len(order) and (j - i + 1) * len(docs[order[j]]) <= 1_000_000:
                j += 1
            some = order[i:j]
            wide = np.full((len(some), len(docs[some[-1]])), len(words), np.int64)
            for r, d in enumerate(some):
                wide[r, : len(docs[d])] = docs[d]
            path = viterbi(scores, wide, PENALTY)
            for r, d in enumerate(some):
                out[d] = (letters[docs[d]], path[r, : len(docs[d])], scores[docs[d]].sum(axis=0))
            i = j
        none = (np.empty(0, np.int64), np.empty(0, np.int8), np.zeros(len(self.langs)))
        return [x or none for x in out]


def viterbi(scores: np.ndarray, ids: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every place (texts by places of row numbers of scores), one step for all texts at once."""
    n, width = ids.shape
    k = scores.shape[1]
    own = np.arange(k, dtype=np.int8)
    back = np.empty((width, n, k), np.int8)
    now = scores[ids[:, 0]]
    for t in range(1, width):
        best = now.argmax(axis=1)
        other = now[np.arange(n), best] - penalty
        stay = now >= other[:, None]
        back[t] = np.where(stay, own, best[:, None])
        now = np.where(stay, now, other[:, None]) + scores[ids[:, t]]
    path = np.empty((n, width), np.int8)
    at = now.argmax(axis=1)
    rows = np.arange(n)
    for t in range(width - 1, 0, -1):
        path[:, t] = at
        at = back[t][rows, at]
    path[:, 0] = at
    return path


def fit(rows: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model of rows (doc_id, text, lang), of which about `sample` at most are used."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang")
    count = rows.count()
    if count > sample:
        rows = rows.where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 1) < F.lit(int(2**63 * 0.97 * sample / count)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(0)):
                words.setdefault(lang, Counter()).update(_split(text.as_py()))
        for lang, seen in words.items():
            counts, letters = np.zeros(SIZE + 1), np.zeros(N_SCRIPTS)
            every = list(seen)
            for i in range(0, len(every), 50_000):
                part = every[i : i + 50_000]
                times = np.array([seen[w] for w in part], np.float64)
                buckets, starts = grams(part)
                wide = np.repeat(times, np.diff(np.append(starts, len(buckets[0]))))
                for b in buckets:
                    counts += np.bincount(b, wide, minlength=SIZE + 1)
                for w, c in zip(part, times):
                    letters[script_of(w)] += n_letters(w) * c
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([counts[:SIZE].astype("<f4").tobytes()], pa.binary()), pa.array([letters.tobytes()], pa.binary())], names=["lang", "counts", "letters"])

    found = rows.select("text", "lang").repartition(8).mapInArrow(run, "lang string, counts binary, letters binary").collect()  # the sample alone is dealt out; 8 rows a language at most
    langs = sorted({r["lang"] for r in found})
    if not langs:
        return None
    counts, letters = np.zeros((SIZE, len(langs))), np.zeros((N_SCRIPTS, len(langs)))
    for r in found:
        counts[:, langs.index(r["lang"])] += np.frombuffer(r["counts"], "<f4")
        letters[:, langs.index(r["lang"])] += np.frombuffer(r["letters"])
    return Model.of(langs, counts, letters)


def label(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score and spans (first word, last word, lang) of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(model and (model.langs, model.table, model.allowed))  # bounded: SIZE rows of a score for each language
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "spans")]
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*names).dtypes) + ", lang_pred string, score double, spans array<struct<first:int,last:int,lang:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value and Model(*sent.value)
        for batch in batches:
            at, most = 0, 2000
            while at < batch.num_rows:
                part = batch.slice(at, most)
                at += most
                preds, sure, spans = [], [], []
                for letters, path, total in m.label(part.column(names.index(text_col)).to_pylist()) if m else [(np.empty(0), None, None)] * part.num_rows:
                    whole = letters.sum()
                    if not whole:
                        preds.append("und")
                        sure.append(0.0)
                        spans.append([])
                        continue
                    by = np.bincount(path, letters, minlength=len(m.langs))
                    best = int(by.argmax())
                    others = np.delete(total, best)
                    gap = float(total[best] - others.max()) if len(others) else 30.0
                    preds.append(m.langs[best])
                    sure.append(float(by[best] / whole / (1 + np.exp(-np.clip(gap, -30, 30)))))
                    cuts = np.flatnonzero(np.diff(path)) + 1
                    spans.append([{"first": int(a), "last": int(z) - 1, "lang": m.langs[path[a]]} for a, z in zip([0, *cuts], [*cuts, len(path)])])
                kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(preds, pa.string()), pa.array(sure, pa.float64()), pa.array(spans, kind)], names=[*names, "lang_pred", "score", "spans"])

    return docs.select(*names).mapInArrow(run, schema)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    model = fit(docs.where(~held))
    out = label(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))
