"""Language-model scoring with a weighted backoff automaton.

Method.  The states are the root and one for each history of one to ORDER - 1 tokens seen in
training, the start of text among them.  An arc (state, token) that was seen carries the smoothed
probability (c(state, token) + m * P(token | next shorter state)) / (c(state) + m), with
m = SCALES * c(state) ** POWER, as busy states have more different arcs.  Any other token leaves by
the state's failure arc of weight m / (c(state) + m) to the state without its oldest token, and so
on down the chain of failure arcs to the root, where the add-0.1 unigram model with one place for
unknown tokens answers; so all probabilities of a state sum to one.  One traversal from left to
right adds the logarithms; the state after a token is the longest history that was seen.

Distribution.  The texts of an input partition become blocks of bounded size: a block's distinct
tokens as 64-bit names, and its texts as places in that list.  They are written once and read from
then on.  A block asks for the corpus counts of the distinct n-grams it holds, and tells its own
counts of training texts, as sorted names packed by ranges of names.  A range's task adds all
blocks' counts and answers each block in the order it asked, so the model is never in one place,
and each block gets just its own part of the automaton.  No n-gram is pruned.  A block sends at most
one message to a range and none without names, so messages never outnumber the n-grams asked for.
Names of two tokens and more keep NAME_BITS more bits than it takes to count the training tokens, so
the chance that a name stands for two n-grams is the same at every size, about 1 in 2**NAME_BITS;
single tokens are told apart by 64 bits.

Cases.  Null text counts as empty: one token, the end.  A null id is held out.  Rows that repeat an
id count and are scored each.  An empty training set gives every token the unknown token's share.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

ORDER = 3
#: Scale of m by the order of the arc, and its power.
SCALES, POWER = {2: 8.0, 3: 2.0}, 0.7
BLOCK_BYTES = 10 << 20
SHARD_TOKENS = 2_500_000  # of the corpus, for each range of names
NAME_BITS = 14
END, START = (int(x) for x in common.hashes([b"", b" start"]))  # no word is empty or holds a space
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def _shifted(x: np.ndarray, first: np.ndarray, start) -> np.ndarray:
    """Each place's predecessor; start at the first places of texts."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[first] = start
    return out


def _grams(tok: np.ndarray, sizes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to ORDER: the names of the n-grams that end at each place, and the places that have one."""
    first = np.cumsum(sizes) - sizes
    at = np.arange(len(tok)) - np.repeat(first, sizes)
    yield tok, at >= 0
    state = _shifted(tok, first, np.uint64(START))
    for n in range(2, ORDER + 1):
        whole = _mix(state * _M1 + tok + np.uint64(n))
        yield whole >> np.uint64(64 - bits), at >= n - 2
        state = _shifted(whole, first, np.uint64(0))


def _zipped(x: np.ndarray) -> bytes:
    """Unsigned numbers byte by byte, the lowest bytes of all first: upper bytes are mostly alike, which compresses well."""
    raw = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _least_type(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return np.ascontiguousarray(x).astype("<u1" if top < 256 else "<u2" if top < 65536 else "<u4" if top < 2**32 else "<u8")


def _numbers(b: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int64)
    size = int.from_bytes(b[:8], "little")
    raw = pa.decompress(b[8:], size, "zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(size // n, n).T.copy().view(f"<u{size // n}").ravel().astype(np.int64)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted names as gaps."""
    return _zipped(np.diff(keys, prepend=np.uint64(0)))


def _unpacked(b: bytes) -> np.ndarray:
    return np.cumsum(_numbers(b, int.from_bytes(b[:8], "little") // 8).view(np.uint64), dtype=np.uint64)


_BLOCK = "block long, ids array<bigint>, held array<boolean>, sizes array<bigint>, vocab binary, times binary, tokens binary"


def blocks_of(rows: DataFrame) -> DataFrame:
    """rows (doc_id, held_out, text) as blocks, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, some, size = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            names, place, times = np.unique(np.concatenate([x for _, _, x in some]), return_inverse=True, return_counts=True)
            rank = np.empty(len(names), np.int64)  # frequent tokens get the small numbers
            rank[np.argsort(-times, kind="stable")] = np.arange(len(names))
            lists = [[i for i, _, _ in some]], [[h for _, h, _ in some]], [[len(x) for _, _, x in some]]
            kinds = pa.int64(), pa.bool_(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array([name]), *[pa.array(x, pa.list_(k)) for x, k in zip(lists, kinds)], pa.array([_packed(names)], pa.binary()), pa.array([_zipped(_least_type(times))], pa.binary()), pa.array([_zipped(_least_type(rank[place]))], pa.binary())], names=["block", "ids", "held", "sizes", "vocab", "times", "tokens"])

        end = np.array([END], np.uint64)
        for batch in batches:
            for i, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = (t.as_py() or "").encode("utf-8", "surrogatepass")
                some.append((i, h, np.concatenate([common.hashes(text.lower().split()), end])))
                size += len(text) + 8
                if size >= BLOCK_BYTES:
                    yield block()
                    name, some, size = name + 1, [], 0
        if some:
            yield block()

    return common.cut(rows.mapInArrow(run, _BLOCK))


def _opened(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct names, frequent ones first, place of each token in them, sizes of texts, whether each token is for training)."""
    sizes, names = np.array(block["sizes"], np.int64), _unpacked(block["vocab"])
    names = names[np.argsort(-_numbers(block["times"], len(names)), kind="stable")]
    return names, _numbers(block["tokens"], int(sizes.sum())), sizes, np.repeat(~np.array(block["held"], bool), sizes)


def _messages(block: dict, shards: int, bits: int) -> Iterator[tuple]:
    """(shard, block, names of each n, training counts of each n), for each range of names that the block has any of."""
    vocab, place, sizes, learn = _opened(block)
    every = []
    for n, (names, has) in enumerate(_grams(vocab[place], sizes, bits), 1):
        keys, at = np.unique(names[has], return_inverse=True)
        width = 64 if n == 1 else bits
        shard = ((keys >> np.uint64(width - 32)) * np.uint64(shards)) >> np.uint64(32)
        found, starts = np.unique(shard, return_index=True)
        every.append((keys, np.bincount(at[learn[has]], minlength=len(keys)), dict(zip(found.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(keys)])))))
    for shard in sorted(set().union(*(at for _, _, at in every))):
        parts = [(keys[slice(*at.get(shard, (0, 0)))], counts[slice(*at.get(shard, (0, 0)))]) for keys, counts, at in every]
        yield shard, block["block"], [_packed(k) for k, _ in parts], [_zipped(_least_type(c)) for _, c in parts]


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


_ASKED = ["shard", "block", "keys", "counts"], [pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary())]
_ANSWERED = ["block", "shard", "sizes", "totals"], [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary())]


def asked(blocks: DataFrame, shards: int, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(_messages(batch.slice(i, 1).to_pylist()[0], shards, bits))
                for j in range(0, len(rows), 512):
                    yield _table(rows[j : j + 512], *_ASKED)

    return blocks.drop("ids").mapInArrow(run, "shard long, block long, keys array<binary>, counts array<binary>")


def _answer(table: pa.Table) -> pa.Table:
    """Each block's names with the sums over all blocks, in the order it asked."""
    who, shards, keys, counts = (table[c].to_pylist() for c in _ASKED[0][1:2] + _ASKED[0][:1] + _ASKED[0][2:])
    sizes, totals = [[] for _ in who], [[] for _ in who]
    for n in range(ORDER):
        names = [_unpacked(k[n]) for k in keys]
        mine = [_numbers(c[n], len(x)) for c, x in zip(counts, names)]
        uniq, place = np.unique(np.concatenate(names), return_inverse=True)
        total = np.bincount(place, np.concatenate(mine), minlength=len(uniq)).astype(np.int64)[place]
        at = 0
        for i, x in enumerate(names):
            sizes[i].append(len(x))
            totals[i].append(_zipped(_least_type(total[at : at + len(x)])))
            at += len(x)
    return pa.Table.from_batches([_table(list(zip(who, shards, sizes, totals)), *_ANSWERED)])


def _walked(block: dict, answers: list[dict], bits: int, n: int, v: int, ends: int) -> tuple:
    """(sizes, known tokens, base score, score) of the block's texts."""
    vocab, place, sizes, _ = _opened(block)
    first = np.cumsum(sizes) - sizes
    answers = sorted(answers, key=lambda a: a["shard"])
    step = before = base = known = None
    for k, (names, has) in enumerate(_grams(vocab[place], sizes, bits), 1):
        total = np.concatenate([_numbers(a["totals"][k - 1], a["sizes"][k - 1]) for a in answers])
        seen = np.zeros(len(names), np.int64)
        seen[has] = total[np.unique(names[has], return_inverse=True)[1]]
        if k == 1:
            known, step = seen > 0, (seen + 0.1) / (n + 0.1 * (v + 1))
            base = np.log10(step)
        else:
            state = _shifted(before, first, ends if k == 2 else 0)  # how often the state was left in training
            m = SCALES[k] * np.maximum(state, 1) ** POWER
            fail = m / (state + m)  # one where the state was never seen
            step = np.where(seen > 0, seen / (state + m) + fail * step, fail * step)
        before = seen
    add = lambda x: np.add.reduceat(x, first)
    return sizes, add(known.astype(np.int64)), add(base), add(np.log10(step))


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contract columns for docs; held_out is the condition that keeps a row from training."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"), F.col(text_col).alias("text"))
    blocks = blocks_of(rows)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                vocab, place, _, learn = _opened(batch.slice(i, 1).to_pylist()[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(vocab[place[learn]]).view(np.int64))], names=["name"])

    v = blocks.drop("block", "ids").mapInArrow(words, "name long").distinct().count()
    summed = lambda x: F.coalesce(F.sum(F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a + y)), F.lit(0))
    learnt = F.filter("sizes", lambda _, i: ~F.get("held", i))
    tokens, n, ends = blocks.agg(summed("sizes"), summed(learnt), F.coalesce(F.sum(F.size(learnt)), F.lit(0))).first()
    bits, shards = min(64, max(40, NAME_BITS + n.bit_length())), max(1, -(-tokens // SHARD_TOKENS))

    def walk(texts: pa.Table, answers: pa.Table) -> pa.Table:
        found, got = [], answers.to_pylist()
        for block in texts.to_pylist():
            sizes, known, base, total = _walked(block, got, bits, n, v, ends)
            found.append(pa.table([pa.array(block["ids"], pa.int64()), pa.array(block["held"], pa.bool_()), pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), n, np.int64)), pa.array(base), pa.array(total)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(found)

    answers = asked(blocks, shards, bits).groupBy("shard").applyInArrow(_answer, "block long, shard long, sizes array<bigint>, totals array<binary>")
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(walk, out)


def op2_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return score(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0)
