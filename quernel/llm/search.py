"""Ranked lexical search: short lists summed first, long lists walked by document with skips.

One pass over the documents writes an index of the terms that are asked for: per
document its length, term numbers and occurrences. Sums over it give the corpus
figures. A second pass turns runs of the index into posting lists in memory and
ranks every item on them. The item's short lists are summed term at a time into one
list of accumulators. That list then joins the long lists as one more iterator with bounds:
all are walked document at a time, in windows of documents. A window whose bounds
add up to less than the lowest kept score is skipped; in the others, lists that
can't lift a document above that score alone are only looked up for documents
that another list names. No document that could be kept is passed over.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernel.session import materialize

KEPT = 10
#: Query text that one pass takes; a larger query set is answered in several passes.
QUERY_BYTES = 8 << 20
#: Postings held in memory at a time, and documents.
POSTINGS, DOCUMENTS = 4_000_000, 1 << 17
#: A list with at most this share of the documents at hand is short.
SHORT = 1 / 32
WINDOW = 1024
#: Fixed values of the score, in hundredths and whole numbers.
SLOPE, PER_HIT, SCALE = 75, 1000, 1_000_000_000

# Digits and letters count as they are, A-Z lower-cased, as does every byte of a character beyond ASCII.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


def _lists(values: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=ends[1:])
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind)))


def _index(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, hits) of every document with a term; ``terms`` has those that are asked for."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches):
        for batch in batches:
            texts = batch["text"].cast(pa.binary())
            rows, lengths, found, hits = [], [], [], []
            for row, text in enumerate(texts):
                words = terms(text.as_py())
                if not words:
                    continue
                counts = Counter(map(numbers.get, words))
                counts.pop(None, None)
                rows.append(row)
                lengths.append(len(words))
                found.append(np.fromiter(counts.keys(), np.int32, len(counts)))
                hits.append(np.fromiter(counts.values(), np.int64, len(counts)))
            arrays = [
                batch["doc_id"].take(pa.array(rows, pa.int64())),
                pa.array(lengths, pa.int64()),
                _lists(found, np.int32),
                _lists(hits, np.int64),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "hits"])

    schema = f"doc_id {kind}, n bigint, terms array<int>, hits array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(count, schema)


@dataclass
class Corpus:
    """N, L, and weights of the asked terms by number."""

    documents: int
    length: int
    weights: dict[int, int]

    def discount(self, n: int) -> int:
        return 100 - SLOPE + (SLOPE * n * self.documents) // self.length


@dataclass
class Best:
    """The highest scores of one item so far: (score, doc_id), highest first, then by doc_id, null last."""

    size: int
    rows: list = field(default_factory=list)

    @property
    def least(self) -> int:
        """Scores below this one are of no use."""
        return self.rows[-1][0] if len(self.rows) == self.size else 1

    def add(self, scores, ids) -> None:
        self.rows += zip(scores, ids)
        self.rows.sort(key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1]))
        del self.rows[self.size :]


class Shard:
    """Posting lists of some documents, numbered by ascending doc_id."""

    def __init__(self, batches: list[pa.RecordBatch], corpus: Corpus):
        table = pa.Table.from_batches(batches).sort_by("doc_id").combine_chunks()
        self.ids = table["doc_id"]
        self.size = table.num_rows
        lengths = table["n"].to_pylist()
        # Whole numbers of any size: n * N may pass 64 bits.
        discounts = np.array([corpus.discount(n) for n in lengths], dtype=np.int64)
        lists = table["terms"].combine_chunks()
        terms_ = lists.flatten().to_numpy(zero_copy_only=False)
        hits = table["hits"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        docs = np.repeat(np.arange(self.size, dtype=np.int32), np.diff(lists.offsets.to_numpy()))
        gains = SCALE * hits // (PER_HIT * hits + 8 * discounts[docs])
        order = np.argsort(terms_, kind="stable")
        self.docs, self.gains = docs[order], gains[order]
        names, starts = np.unique(terms_[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        self.places = dict(zip(names.tolist(), zip(starts.tolist(), ends.tolist())))
        self.edges = np.arange(0, self.size + WINDOW, WINDOW)
        self.cuts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def windows(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each window of a list begins, and the highest gain in each."""
        if term not in self.cuts:
            start, end = self.places[term]
            self.cuts[term] = _cut(self.docs[start:end], self.gains[start:end], self.edges)
        return self.cuts[term]

    def rank(self, query: list[tuple[int, int]], best: Best) -> None:
        """Adds what this shard has of an item; ``query`` is (term, factor) pairs."""
        short, long = [], []
        for term, factor in query:
            if term in self.places:
                start, end = self.places[term]
                (short if end - start <= SHORT * self.size else long).append((term, factor, start, end))
        lists = []
        for term, factor, start, end in long:
            cuts, highest = self.windows(term)
            lists.append((self.docs[start:end], self.gains[start:end], factor, cuts, highest * factor))
        seeds = np.empty(0, dtype=np.int64)
        if short:
            docs, sums = self._accumulators(short)
            cuts, highest = _cut(docs, sums, self.edges)
            lists.append((docs, sums, 1, cuts, highest))
            if len(docs) >= best.size:
                first = np.argpartition(sums, len(sums) - best.size)[-best.size :]
                seeds = sums[first] + _looked_up(np.sort(docs[first]), docs[first], lists[:-1])
        if not lists:
            return
        # So many documents of this shard score at least this much.
        floor = int(seeds.min()) if len(seeds) else 1
        bounds = np.stack([highest for *_, highest in lists])
        total = bounds.sum(axis=0)
        for w in range(len(total)):
            least = max(floor, best.least)
            if total[w] >= least:
                self._window(w, lists, bounds[:, w], least, best)

    def _accumulators(self, short):
        """The short lists as one: documents in order, and the sum of each."""
        docs = np.concatenate([self.docs[start:end] for _, _, start, end in short])
        gains = np.concatenate([self.gains[start:end] * factor for _, factor, start, end in short])
        order = np.argsort(docs, kind="stable")
        docs, gains = docs[order], gains[order]
        first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
        return docs[first], np.add.reduceat(gains, first)

    def _window(self, w: int, lists, bounds, least: int, best: Best) -> None:
        order = np.argsort(bounds, kind="stable")
        reach = np.cumsum(bounds[order])
        looked = int(np.searchsorted(reach, least, side="left"))
        base = w * WINDOW
        scores = np.zeros(WINDOW, dtype=np.int64)
        for i in order[looked:]:
            docs, gains, factor, cuts, _ = lists[i]
            here = slice(cuts[w], cuts[w + 1])
            scores[docs[here] - base] += gains[here] * factor
        live = np.flatnonzero(scores)
        for place in range(looked - 1, -1, -1):
            live = live[scores[live] + reach[place] >= least]
            if not len(live):
                return
            docs, gains, factor, cuts, _ = lists[order[place]]
            here = slice(cuts[w], cuts[w + 1])
            near, gain = docs[here] - base, gains[here]
            if len(near):
                at = np.minimum(np.searchsorted(near, live), len(near) - 1)
                scores[live] += np.where(near[at] == live, gain[at] * factor, 0)
        live = live[scores[live] >= least]
        if len(live) > best.size:
            # Equal scores go by doc_id, which is the order here.
            live = live[np.argsort(-scores[live], kind="stable")[: best.size]]
        if len(live):
            best.add(scores[live].tolist(), self.ids.take(pa.array(live + base)).to_pylist())


def _cut(docs, gains, edges):
    cuts = np.searchsorted(docs, edges)
    highest = np.zeros(len(edges) - 1, dtype=np.int64)
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    if len(full):
        highest[full] = np.maximum.reduceat(gains, cuts[:-1][full])
    return cuts, highest


def _looked_up(ordered, asked, lists):
    """What the lists add to some documents, in the order asked for."""
    sums = np.zeros(len(ordered), dtype=np.int64)
    for docs, gains, factor, _, _ in lists:
        at = np.minimum(np.searchsorted(docs, ordered), len(docs) - 1)
        sums += np.where(docs[at] == ordered, gains[at] * factor, 0)
    return sums[np.searchsorted(ordered, asked)]


def _ranked(index: DataFrame, queries: dict[int, list[tuple[int, int]]], corpus: Corpus, kept: int, most: int) -> DataFrame:
    """(item, doc_id, score): the best of every item in each task."""
    kind = index.schema["doc_id"].dataType.simpleString()

    def rank(batches):
        best = {item: Best(kept) for item in queries}
        waiting, postings, rows, schema = [], 0, 0, None

        def flush():
            shard = Shard(waiting, corpus)
            for item, query in queries.items():
                shard.rank(query, best[item])
            waiting.clear()

        for batch in batches:
            schema = batch.schema
            waiting.append(batch)
            postings += len(batch["terms"].flatten())
            rows += batch.num_rows
            if postings >= most or rows >= DOCUMENTS:
                flush()
                postings = rows = 0
        if rows:
            flush()
        found = [(item, doc_id, score) for item, b in best.items() for score, doc_id in b.rows]
        if found:
            items, ids, scores = zip(*found)
            arrays = [
                pa.array(items, pa.int64()),
                pa.array(ids, schema.field("doc_id").type),
                pa.array(scores, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return index.mapInArrow(rank, f"item bigint, doc_id {kind}, score bigint")


def _pass(docs: DataFrame, asked: DataFrame, kept: int, most: int) -> DataFrame | None:
    """Ranks of the items of one block, or None where none has a term."""
    counts = {r.item: Counter(terms((r.text or "").encode())) for r in asked.collect()}
    numbers: dict[bytes, int] = {}
    for count in counts.values():
        for term in count:
            numbers.setdefault(term, len(numbers))
    if not numbers:
        return None
    index = materialize(_index(docs, numbers), "search-index")
    n, length = index.agg(F.count("*"), F.sum("n")).first()
    if not n:
        return None
    holders = index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = {r.term: math.floor(1000 * math.log((2 * n + 2) / (2 * r["count"] + 1))) for r in holders}
    corpus = Corpus(n, length, weights)
    queries = {}
    for item, count in counts.items():
        query = [(numbers[term], times * weights.get(numbers[term], 0)) for term, times in count.items()]
        queries[item] = [(term, factor) for term, factor in query if factor > 0]
    best = _ranked(index, queries, corpus, kept, most)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= kept)


def search(
    docs: DataFrame, items: DataFrame, kept: int = KEPT, query_bytes: int = QUERY_BYTES, postings: int = POSTINGS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``kept`` highest-scoring documents of every item.

    Every row of ``items`` is an item of its own and every row of ``docs`` a document, also
    where ids are null or repeated; a null doc_id comes last among equal scores. An item or
    document without a term (null, empty, or signs only) ranks nothing and nowhere. Texts are
    read whole. Only doc_id and text, item_id and text are read; other columns may have any name.
    Items are answered in blocks of about ``query_bytes`` of their text, each with its own pass over
    ``docs``. A worker holds a block's terms, the ``kept`` best per item, and about ``postings`` postings.
    """
    spark = docs.sparkSession
    rows = materialize(
        items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "search-items"
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // query_bytes)
    passes = []
    for block in range(blocks):
        mine = rows.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        found = _pass(docs, mine.select("item", "text"), kept, postings)
        if found is not None:
            passes.append(materialize(found, "search-ranks") if blocks > 1 else found)
    if not passes:
        kind = docs.schema["doc_id"].dataType.simpleString()
        passes = [spark.createDataFrame([], f"item bigint, doc_id {kind}, score bigint, rank int")]
    out = passes[0]
    for more in passes[1:]:
        out = out.unionByName(more)
    return out.join(rows.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
