"""Scores from an interpolated modified Kneser-Ney model of order two.

Counting: tasks hash and count words (numpy, a few MB of text at a time), Spark adds
the counts up. A word's id is its place among all sorted word hashes. Pairs of
ids are counted in each task and shuffled as sorted, difference-coded runs, one
row per range of pairs, so a group has a bounded number of words; words so
frequent that their pairs would fill a range are cut into several by the second
word.

Storage: arrays of sorted hashes and sorted pairs with their counts, in files of the
shared folder that workers map into memory; nothing of the model is sent
through the driver, and pages are shared by the workers of a machine. The folder
must be mounted on all machines (``file:`` or a plain path).

Probability: p(w | v) = max(c(vw) - D(c), 0) / c(v) + gamma(v) * q(w), and
q(w) = max(k(w) - E(k), 0) / sum(k) + rest / (V + 1), where k(w) is the number of
different words before w, and discounts D and E, for counts 1, 2 and above, come
from the numbers of pairs and words with counts 1 to 4. A word not seen in training has the
last term only, so all words and one unknown word sum to 1.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernel.llm import hashing
from quernel.session import materialize, scratch_path

#: Fixed values of the contract: rows with this remainder are held out.
FOLDS, HELD_OUT = 7, 2

#: Tokens of a range of pairs, words of a file of hashes, and tokens counted at once in a task.
RANGE_TOKENS = 3_000_000
SHARD_WORDS = 1 << 20
BATCH_TOKENS = 1_000_000

_END = int(hashing.mix(np.array([0xE0D], np.uint64))[0] >> np.uint64(1))
_BITS = np.uint64(32)


def held_out(doc_id: Column) -> Column:
    """By the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def _documents(column: pa.Array):
    """(tokens, lengths) of several documents at a time: 63-bit word hashes, each document closed by the end."""
    held, lengths, total = [], [], 0
    end = np.array([_END], np.int64)
    for words in hashing.batch_words(column):
        held += [(words >> np.uint64(1)).view(np.int64), end]
        lengths.append(len(words) + 1)
        total += len(words) + 1
        if total >= BATCH_TOKENS:
            yield np.concatenate(held), np.array(lengths)
            held, lengths, total = [], [], 0
    if lengths:
        yield np.concatenate(held), np.array(lengths)


def _counted(batches):
    for batch in batches:
        for tokens, _ in _documents(batch.column(0)):
            word, n = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], ["word", "n"])


def _folder(spark) -> str:
    path = scratch_path(spark, "lm")
    path = path.removeprefix("file://").removeprefix("file:")
    if not path.startswith("/"):
        raise ValueError(f"the model's files are mapped into memory and need a mounted folder, not {path}")
    return path


def _save(folder: str, name: str, values: np.ndarray) -> None:
    """Whole or not at all, so that a repeated task does no harm."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    values.tofile(part)
    os.replace(part, f"{folder}/{name}")


def _map(folder: str, name: str, kind) -> np.ndarray:
    path = f"{folder}/{name}"
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte planes apart, so that the shuffle's compression finds the zeros."""
    steps = np.diff(values, prepend=values[:1] * 0).astype(np.uint64)
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _sum_sorted(keys: np.ndarray, counts: np.ndarray):
    """Distinct keys in order with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


class Words:
    """The sorted word hashes, in files by their leading bits; a word's id is its place in all of them."""

    def __init__(self, folder: str, bits: int, sizes: list[int]):
        self.shards = [_map(folder, f"words-{i}", np.int64) for i in range(len(sizes))]
        self.counts_of = [_map(folder, f"counts-{i}", np.int64) for i in range(len(sizes))]
        self.starts = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        self.edges = np.arange(1, len(sizes), dtype=np.int64) << (63 - bits)

    def find(self, words: np.ndarray):
        """(ids, counts) of distinct sorted hashes; -1 and 0 for a word that isn't there."""
        ids, counts = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64)
        cuts = np.r_[0, np.searchsorted(words, self.edges), len(words)]
        for i, shard in enumerate(self.shards):
            part = slice(cuts[i], cuts[i + 1])
            if cuts[i] < cuts[i + 1] and len(shard):
                at = np.minimum(np.searchsorted(shard, words[part]), len(shard) - 1)
                there = shard[at] == words[part]
                ids[part] = np.where(there, at + self.starts[i], -1)
                counts[part] = np.where(there, self.counts_of[i][at], 0)
        return ids, counts


def _save_words(folder: str):
    def run(key, table):
        word, n = (table.column(c).to_numpy() for c in ("word", "n"))
        order = np.argsort(word)
        i = key[0].as_py()
        _save(folder, f"words-{i}", word[order])
        _save(folder, f"counts-{i}", n[order])
        return pa.table({"shard": pa.array([i], pa.int32()), "size": pa.array([len(word)], pa.int64())})

    return run


def _ids_of(words: Words, tokens: np.ndarray):
    """(ids, counts) of tokens in any order."""
    distinct, place = np.unique(tokens, return_inverse=True)
    ids, counts = words.find(distinct)
    return ids[place], counts[place]


def _pairs(ids: np.ndarray, lengths: np.ndarray, start: int):
    """What belongs to the word before each token; ``start`` before the first of a document."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.r_[0, np.cumsum(lengths)[:-1]]] = start
    return before


def _count_pairs(folder, bits, sizes, bounds):
    def run(batches):
        words = Words(folder, bits, sizes)
        start = int(words.starts[-1])
        for batch in batches:
            for tokens, lengths in _documents(batch.column(0)):
                ids, _ = _ids_of(words, tokens)
                key = _pairs(ids, lengths, start).astype(np.uint64) << _BITS | ids.astype(np.uint64)
                key, n = np.unique(key, return_counts=True)
                cuts = np.r_[0, np.searchsorted(key, bounds[1:]), len(key)]
                parts = [i for i in range(len(bounds)) if cuts[i] < cuts[i + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts, pa.int32()),
                        pa.array([_pack(key[cuts[i] : cuts[i + 1]]) for i in parts], pa.binary()),
                        pa.array([n[cuts[i] : cuts[i + 1]].astype(np.uint32).tobytes() for i in parts], pa.binary()),
                    ],
                    ["part", "pairs", "n"],
                )

    return run


_MERGED = "part int, size bigint, c1 bigint, c2 bigint, c3 bigint, c4 bigint, span int, words binary, n binary"


def _merge_pairs(folder, bounds, width):
    """Writes a range's pairs and its contexts; returns how many pairs there are of each low count, and
    for each span of second words how many pairs have it."""

    def run(key, table):
        i = key[0].as_py()
        pairs = np.concatenate([_unpack(x) for x in table.column("pairs").to_pylist()])
        n = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("n").to_pylist()]).astype(np.int64)
        pairs, n = _sum_sorted(pairs, n)
        _save(folder, f"pairs-{i}", pairs)
        _save(folder, f"pair-counts-{i}", n.astype(np.uint32))
        # Contexts: numbers of pairs with count 1, 2 and above, for every first word of the range.
        low = int(bounds[i] >> _BITS)
        first = (pairs >> _BITS).astype(np.int64) - low
        wide = int(first[-1]) + 1
        contexts = np.zeros((wide, 3), np.uint32)
        for k, chosen in enumerate((n == 1, n == 2, n > 2)):
            contexts[:, k] = np.bincount(first[chosen], minlength=wide)
        _save(folder, f"contexts-{i}", contexts)
        second, times = np.unique((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
        cuts = np.flatnonzero(np.r_[True, np.diff(second // width) > 0, True])
        slices = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
        c = _of_counts(n)
        rows = len(slices)
        return pa.table(
            {
                "part": pa.array([i] * rows, pa.int32()),
                "size": pa.array([len(pairs)] + [0] * (rows - 1), pa.int64()),
                **{f"c{k + 1}": pa.array([c[k]] + [0] * (rows - 1), pa.int64()) for k in range(4)},
                "span": pa.array([int(second[s][0] // width) for s in slices], pa.int32()),
                "words": pa.array([_pack(second[s].astype(np.uint64)) for s in slices], pa.binary()),
                "n": pa.array([times[s].astype(np.uint32).tobytes() for s in slices], pa.binary()),
            }
        )

    return run


def _save_before(folder, width, vocabulary):
    """Writes for a span of ids how many different words come before each; returns the sums."""

    def run(key, table):
        i = key[0].as_py()
        size = min(width, vocabulary - i * width)
        before = np.zeros(size, np.int64)
        for words, n in zip(table.column("words").to_pylist(), table.column("n").to_pylist()):
            before[_unpack(words).astype(np.int64) - i * width] += np.frombuffer(n, np.uint32)
        _save(folder, f"before-{i}", before.astype(np.uint32))
        c = _of_counts(before)
        return pa.table({"span": pa.array([i], pa.int32()), "total": pa.array([int(before.sum())], pa.int64()),
                         **{f"c{k + 1}": pa.array([c[k]], pa.int64()) for k in range(4)},
                         "high": pa.array([int((before > 2).sum())], pa.int64())})

    return run


def discounts(c1: int, c2: int, c3: int, c4: int) -> list[float]:
    """For counts 1, 2 and above; in (0, 1], (0, 2] and (0, 3] also where a number is 0."""
    y = c1 / (c1 + 2 * c2) if c1 else 0.5
    low = [c1, c2, c3, c4]
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * low[k] / low[k - 1] if low[k - 1] else k / 2
        out.append(d if 0 < d <= k else k / 2)
    return out


class Model:
    """The mapped files and the few numbers that go with them."""

    def __init__(self, about: dict):
        self.about = about
        folder = about["folder"]
        self.words = Words(folder, about["bits"], about["sizes"])
        self.bounds = about["bounds"]
        self.low = (self.bounds >> _BITS).astype(np.int64)
        there = about["parts"]
        none = {c: np.zeros(0, t) for c, t in (("p", np.uint64), ("n", np.uint32))}
        self.pairs = [_map(folder, f"pairs-{i}", np.uint64) if i in there else none["p"] for i in range(len(self.bounds))]
        self.counts = [
            _map(folder, f"pair-counts-{i}", np.uint32) if i in there else none["n"] for i in range(len(self.bounds))
        ]
        self.contexts = [
            _map(folder, f"contexts-{i}", np.uint32).reshape(-1, 3) if i in there else np.zeros((0, 3), np.uint32)
            for i in range(len(self.bounds))
        ]
        self.before = {i: _map(folder, f"before-{i}", np.uint32) for i in about["spans"]}

    def _kinds(self, first: np.ndarray) -> np.ndarray:
        """Numbers of pairs with count 1, 2 and above after each of these sorted distinct first words."""
        out = np.zeros((len(first), 3), np.int64)
        for i, contexts in enumerate(self.contexts):
            # A frequent word has parts in several ranges.
            a, b = np.searchsorted(first, [self.low[i], self.low[i] + len(contexts)])
            out[a:b] += contexts[first[a:b] - self.low[i]]
        return out

    def _pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pairs."""
        out = np.zeros(len(pairs), np.int64)
        cuts = np.r_[0, np.searchsorted(pairs, self.bounds[1:]), len(pairs)]
        for i, known in enumerate(self.pairs):
            part = slice(cuts[i], cuts[i + 1])
            if cuts[i] < cuts[i + 1] and len(known):
                at = np.minimum(np.searchsorted(known, pairs[part]), len(known) - 1)
                out[part] = np.where(known[at] == pairs[part], self.counts[i][at], 0)
        return out

    def _lower(self, ids: np.ndarray) -> np.ndarray:
        """q(w) of sorted distinct ids."""
        a = self.about
        k = np.zeros(len(ids), np.int64)
        for span, before in self.before.items():
            low, high = np.searchsorted(ids, [span * a["width"], span * a["width"] + len(before)])
            k[low:high] = before[ids[low:high] - span * a["width"]]
        e = np.r_[0.0, a["e"]]
        own = np.maximum(k - e[np.minimum(k, 3)], 0) / max(1, a["total"])
        return own + a["rest"] / (a["vocabulary"] + 1)

    def score(self, tokens: np.ndarray, lengths: np.ndarray):
        """(known tokens, base score, log10 probability) of each document."""
        a = self.about
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        ids, counts = _ids_of(self.words, tokens)
        base = np.log10((counts + 1) / (a["tokens"] + a["vocabulary"] + 1))
        distinct, place = np.unique(ids, return_inverse=True)
        lower = self._lower(distinct)[place]
        before = _pairs(ids, lengths, a["vocabulary"])
        first, at = np.unique(before, return_inverse=True)
        # A word is seen as often as it is followed: only the end is not.
        seen = _pairs(counts, lengths, a["documents"])
        spared = (self._kinds(first) @ np.array(a["d"]))[at]
        gamma = np.where(seen > 0, spared / np.maximum(seen, 1), 1.0)
        valid = (before >= 0) & (ids >= 0)
        pair = np.where(valid, before, 0).astype(np.uint64) << _BITS | np.where(valid, ids, 0).astype(np.uint64)
        key, back = np.unique(pair, return_inverse=True)
        c = np.where(valid, self._pair_counts(key)[back], 0)
        d = np.r_[0.0, a["d"]]
        own = np.maximum(c - d[np.minimum(c, 3)], 0) / np.maximum(seen, 1)
        p = np.log10(own + gamma * lower)
        return tuple(np.add.reduceat(x, starts) for x in ((counts > 0).astype(np.int64), base, p))


def train(docs: DataFrame) -> dict:
    """The model of all rows of ``docs`` (column text): where its files are and the few numbers that go with them."""
    spark = docs.sparkSession
    folder = _folder(spark)
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    counts = texts.mapInArrow(_counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "lm-words")
    vocabulary, tokens = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs = counts.filter(F.col("word") == _END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if vocabulary >= 2**32 - 1:
        raise ValueError("word ids have 32 bits")
    bits = max(0, (vocabulary // SHARD_WORDS).bit_length())
    shard = F.shiftright("word", 63 - bits).cast("int") if bits else F.lit(0)
    saved = counts.withColumn("shard", shard).groupBy("shard").applyInArrow(_save_words(folder), "shard int, size bigint")
    found = {r.shard: r.size for r in saved.collect()}
    sizes = [found.get(i, 0) for i in range(1 << bits)]
    for i in set(range(1 << bits)) - set(found):
        _save(folder, f"words-{i}", np.zeros(0, np.int64))
        _save(folder, f"counts-{i}", np.zeros(0, np.int64))

    parts = max(8, -(-tokens // RANGE_TOKENS))
    width = max(1, -(-(vocabulary + 1) // parts))
    # At most 4 * parts words are that frequent.
    often = counts.filter(F.col("n") * 4 * parts >= max(tokens, 1)).orderBy("word").collect()
    hot = dict(zip(Words(folder, bits, sizes).find(np.array([r.word for r in often], np.int64))[0].tolist(), [r.n for r in often]))
    hot[vocabulary] = n_docs
    bounds = {i * width << 32 for i in range(parts)}
    for word, n in hot.items():
        slices = max(1, -(-n * parts // max(tokens, 1)))
        step = -(-(vocabulary + 1) // slices)
        bounds |= {(word << 32) + k * step for k in range(slices)} | {(word + 1) << 32}
    bounds = np.array(sorted(bounds), np.uint64)
    pairs = texts.mapInArrow(_count_pairs(folder, bits, sizes, bounds), "part int, pairs binary, n binary")
    merged = pairs.groupBy("part").applyInArrow(_merge_pairs(folder, bounds, width), _MERGED)
    merged = materialize(merged, "lm-merged")
    c = merged.agg(*[F.coalesce(F.sum(f"c{k}"), F.lit(0)) for k in (1, 2, 3, 4)]).first()
    there = {r.part for r in merged.select("part").distinct().collect()}
    spans = merged.groupBy("span").applyInArrow(
        _save_before(folder, width, vocabulary),
        "span int, total bigint, c1 bigint, c2 bigint, c3 bigint, c4 bigint, high bigint",
    )
    spans = spans.collect()
    k = [sum(getattr(r, f"c{j}") for r in spans) for j in (1, 2, 3, 4)]
    total, e = sum(r.total for r in spans), discounts(*k)
    rest = (e[0] * k[0] + e[1] * k[1] + e[2] * sum(r.high for r in spans)) / total if total else 1.0
    return {
        "folder": folder, "bits": bits, "sizes": sizes, "bounds": bounds, "parts": there, "width": width,
        "spans": [r.span for r in spans], "vocabulary": vocabulary, "tokens": tokens, "documents": n_docs,
        "d": discounts(*c), "e": e, "rest": rest, "total": total,
    }


def _scored(about):
    def run(batches):
        model = Model(about)
        for batch in batches:
            out = [[], [], [], []]
            for tokens, lengths in _documents(batch.column(2)):
                for kept, values in zip(out, (lengths, *model.score(tokens, lengths))):
                    kept.append(values)
            if out[0]:
                n, known, base, score = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), pa.array(known), pa.array(base), pa.array(score)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    return run


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per document.

    Learns from the rows that aren't held out. ``score`` is the model's log10
    probability of the text and its end, ``base_score`` that of single words with one
    added to every count. A null or empty text is its end only. Rows with the same id are
    scored one by one. Without training rows every word is unknown. An empty table gives an empty table.
    """
    rows = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text")
    )
    about = train(rows.filter(~F.col("held_out")))
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("held_out", T.BooleanType())]
        + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")]
        + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    )
    scored = rows.mapInArrow(_scored(about), schema)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(about["tokens"]).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )
