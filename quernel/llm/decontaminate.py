"""Benchmark decontamination with an Aho-Corasick automaton over normalised test items.

Text is normalised byte by byte, so places map back to the original: A-Z become
a-z, other ASCII that is neither letter nor digit becomes a blank, the rest
stays. Items are cut into windows of ``WINDOW`` words; the automaton finds all of them
in one scan of a document. It is built on each worker from a broadcast list of
windows of at most ``BLOCK_BYTES``; a larger benchmark is cut into several lists, and a
document passes through their automata one after the other in the same job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernel.llm.common import text_hash, whole

#: Fixed values of the contract: words of a window, and the bytes that make no word.
WINDOW = 10
_TABLE = bytearray(range(256))
for _i in range(128):
    _c = chr(_i)
    _TABLE[_i] = ord(_c.lower()) if _c.isalnum() else 32
_TABLE = bytes(_TABLE)

#: Bytes of benchmark text that one automaton holds; about a hundred times that in a worker's memory.
BLOCK_BYTES = 2 << 20

_SPAN = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("first_word", "last_word", "start", "end")]
)
_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(_SPAN)),
    T.StructField("items", T.ArrayType(T.StringType())),
]
_SPANS = pa.list_(pa.struct([(n, pa.int64()) for n in ("first_word", "last_word", "start", "end")]))


def item_windows(items) -> list[tuple[bytes, list[str]]]:
    """Distinct windows, as words between blanks, each with the items that have it."""
    found: dict[bytes, set[str]] = {}
    for item, text in items:
        words = (text or "").encode("utf-8", "replace").translate(_TABLE).split()
        size = min(WINDOW, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            found.setdefault(b" " + b" ".join(words[i : i + size]) + b" ", set()).add(str(item))
    return [(k, sorted(v)) for k, v in sorted(found.items())]


class Scanner:
    """The automaton of a list of windows."""

    def __init__(self, windows):
        import ahocorasick

        self.tree = ahocorasick.Automaton()
        for key, items in windows:
            self.tree.add_word(key.decode("latin-1"), (key.count(b" ") - 1, items))
        if windows:
            self.tree.make_automaton()

    def scan(self, text: bytes):
        """(number of words, merged (first, last) word ranges, items found)."""
        words = text.translate(_TABLE).split()
        if not words or not len(self.tree):
            return len(words), [], []
        line = b" " + b" ".join(words) + b" "
        hits = [(end, value) for end, value in self.tree.iter(line.decode("latin-1"))]
        if not hits:
            return len(words), [], []
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        last = np.searchsorted(blanks, [end for end, _ in hits]) - 1
        ranges = merged([(int(e) - size + 1, int(e)) for e, (_, (size, _)) in zip(last, hits)])
        return len(words), ranges, sorted({i for _, (_, items) in hits for i in items})


def merged(ranges):
    """Sorted ranges of whole numbers, joined where they touch."""
    out: list[list[int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [tuple(r) for r in out]


def code_points(text: bytes, ranges):
    """Word ranges with the code point offsets of the original text, end exclusive."""
    if not ranges:
        return []
    raw = np.frombuffer(text, np.uint8)
    word = np.frombuffer(text.translate(_TABLE), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.r_[False, word, False].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    place = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return [
        {"first_word": a, "last_word": b, "start": int(place[starts[a]]), "end": int(place[ends[b]])} for a, b in ranges
    ]


def _scan_with(windows, keep_text: bool):
    def run(batches):
        scanner = Scanner(windows.value)
        for batch in batches:
            before = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            n, spans, items = [], [], []
            for text, old_spans, old_items in zip(batch.column("text").to_pylist(), *before):
                count, ranges, found = scanner.scan(text)
                old = [(s["first_word"], s["last_word"]) for s in old_spans]
                n.append(count)
                spans.append(code_points(text, merged(ranges + old)) if ranges else old_spans)
                items.append(sorted({*found, *old_items}))
            columns = [batch.column(c) for c in ("doc_id", "text_hash", *(["text"] if keep_text else []))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "text_hash", *(["text"] if keep_text else []), "n_words", "spans", "items"],
            )

    return run


def find(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, text_hash, n_words, spans, items), a row per document.

    ``spans`` are the places inside any occurrence of an item's window: first
    and last word, and the code point offsets in the original text. ``items`` are
    the ids, as strings in order, of items with occurring windows. A null text has no words; an item
    without text has no windows; one without an id is called ``None``. Rows with
    the same id are judged one by one. Empty tables give no rows, or no spans.
    """
    spark = docs.sparkSession
    # Repeated items add nothing. Each block is collected by itself and is of bounded size.
    items = benchmark.select("item_id", F.col("text").alias("item")).distinct()
    size = items.agg(F.sum(F.octet_length("item"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    block = F.pmod(F.xxhash64("item_id", "item"), F.lit(blocks))
    none = F.array().cast(T.ArrayType(_SPAN)), F.array().cast("array<string>")
    rows = docs.select(
        "doc_id", text_hash().alias("text_hash"), whole().cast("binary").alias("text"), F.lit(0).cast("bigint").alias("n_words"),
        none[0].alias("spans"), none[1].alias("items"),
    )
    names = [docs.schema["doc_id"], T.StructField("text_hash", T.LongType())]
    for k in range(blocks):
        chosen = items.filter(block == k).collect()
        windows = spark.sparkContext.broadcast(item_windows(chosen))
        last = k == blocks - 1
        text = [] if last else [T.StructField("text", T.BinaryType())]
        rows = rows.mapInArrow(_scan_with(windows, not last), T.StructType([*names, *text, *_FOUND]))
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, items, contaminated) from ``find``."""
    hit = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last_word"] - s["first_word"] + F.lit(1).cast("bigint")
    )
    return find(docs, benchmark).select(
        "doc_id", "text_hash", "n_words", hit.alias("n_hit"), "items", (hit > 0).alias("contaminated")
    )
