"""Token ids as compressed binary files, in order of document id.

Documents are range-partitioned and sorted by id, encoded, and written as
stripes of whole documents: a list of ids and lengths and one string of
``range_coder`` blocks. Spark's own writer puts the stripes into Parquet files, so a lost
executor or a repeated task leaves no half files, and any file system will do.

Encoding works on distinct words. Where a blank with no other white space around
it follows a character, the byte-level splitting pattern always begins a new
piece, so a text can be cut there. So it does where a sign follows a letter or digit, and around a
line end between two signs or letters; pieces are cut there into words, of scripts and signs that are
sure. Arrow cuts the texts and numbers the pieces, and each distinct word is encoded
once per worker while it is remembered. A text with other runs of
white space around a blank is encoded whole. The string of an added token in a text gives that
token, as the library does by itself; it holds no blank and no bound of words, so it is never cut.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernel.llm import range_coder
from quernel.llm.common import text_hash, whole
from quernel.session import scratch_path

#: Fixed values of the contract.
VOCABULARY, END = "byte_bpe_50k.json", 0

#: Ids of a stripe at least, unless the partition ends; its last stripe has up to half as many more.
STRIPE_IDS = 512 * range_coder.BLOCK_IDS
#: Words that a worker remembers, their characters, words encoded in one call, and bytes of texts that are cut at once.
WORDS, CHARS, BATCH, SLICE_BYTES = 300_000, 6_000_000, 4096, 1 << 20

# Letters and digits that every version of Unicode knows as such; signs, but for those of an added token or after which
# letters may belong to them.
_KNOWN = "0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_BOUND = re.compile(rf"(?<=[{_KNOWN}])(?=[!-&(-/:;=?@\[-^`{{}}~\n])|(?<=[!-~]\n)(?=[!-~{_KNOWN}])")


def _plain(piece: str) -> bool:
    """Not empty, and without white space at its ends."""
    return piece != "" and piece.strip() == piece


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all runs, one run after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(size.sum()))


class Encoder:
    """Texts to id arrays with the tokenizers library."""

    def __init__(self, path: str):
        # A task has one core; the library would start a thread for each of the machine's.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self._forget()

    def _forget(self):
        self.number: dict[str, int] = {}
        self.chars = 0
        # The ids of word i are ``size[i]`` from ``start[i]`` on.
        self.ids = np.empty(0, np.uint16)
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def _coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        # Some at a time: the library's own form of a result takes far more room than its ids.
        ids, sizes = [np.empty(0, np.uint16)], [np.empty(0, np.int64)]
        for at in range(0, len(texts), BATCH):
            lists = [e.ids for e in self.library.encode_batch_fast(texts[at : at + BATCH], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, lists), np.int64, len(lists)))
            ids.append(np.fromiter(chain.from_iterable(lists), np.uint16, int(sizes[-1].sum())))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, words: list[str]):
        ids, size = self._coded(words)
        self.number.update(zip(words, range(len(self.size), len(self.size) + len(words))))
        self.chars += sum(map(len, words))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids in a row, start, size) of these pieces."""
        if len(self.number) > WORDS or self.chars > CHARS:
            self._forget()
        known = np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int64, len(pieces))
        at = np.flatnonzero(known < 0)
        cut = [_BOUND.split(pieces[i]) for i in at.tolist()]
        new = set(chain.from_iterable(cut)) - self.number.keys()
        if new:
            self._learn(list(new))
        n = np.ones(len(pieces), np.int64)
        n[at] = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = np.repeat(known, n)
        flat[flat < 0] = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, int(n[at].sum()))
        upto = np.r_[0, np.cumsum(self.size[flat])]
        last = np.cumsum(n)
        start = upto[last - n]
        return self.ids[_runs(self.start[flat], self.size[flat])], start, upto[last] - start

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, followed by the end."""
        ids, lengths = self.flat(pa.array(texts, pa.large_string()))
        ends = np.cumsum(lengths)
        return [ids[a:b] for a, b in zip(ends - lengths, ends)]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each followed by the end, and how many each has."""
        cut = pc.split_pattern(texts, " ")
        counts = cut.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        distinct, piece = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        ends = np.cumsum(counts)
        first, last = np.zeros((2, len(piece)), bool)
        first[ends - counts] = last[ends - 1] = True
        # Texts where the blank between two pieces has other white space beside it.
        opens, closes, empty = edges = np.zeros((3, len(distinct)), bool)
        for i in np.flatnonzero(np.fromiter(map(_plain, distinct), bool, len(distinct)) == 0).tolist():
            edges[:, i] = distinct[i][:1].isspace(), distinct[i][-1:].isspace(), not distinct[i]
        run = opens[piece] & ~first | closes[piece] & ~last | empty[piece] & ~first & ~last
        text = np.repeat(np.arange(len(counts)), counts)
        whole = np.zeros(len(counts), bool)
        whole[text[run]] = True
        # All others by pieces; one that does not begin a text has its blank before it.
        mine = ~whole[text]
        place = piece[mine].astype(np.int64) * 2 + ~first[mine]
        seen = np.zeros(2 * len(distinct), bool)
        seen[place] = True
        used = np.flatnonzero(seen)
        values, start, size = self._pieces([" " + distinct[i >> 1] if i & 1 else distinct[i >> 1] for i in used.tolist()])
        place = (np.cumsum(seen) - 1)[place]
        at = np.flatnonzero(whole)
        whole_ids, whole_size = self._coded(texts.take(pa.array(at)).to_pylist())
        # Behind the pieces come the whole texts and the end, each a run like theirs.
        start = np.concatenate([start, len(values) + np.r_[0, np.cumsum(whole_size)]])
        values = np.concatenate([values, whole_ids, np.array([END], np.uint16)])
        size = np.concatenate([size, whole_size, [1]])
        more = np.full(len(counts) + len(at), len(size) - 1)
        more[at + np.arange(len(at))] = len(used) + np.arange(len(at))
        own = counts * ~whole
        place = np.insert(place, np.repeat(np.cumsum(own), 1 + whole), more)
        n_ids = size[place]
        upto = np.r_[0, np.cumsum(n_ids)][np.cumsum(own + 1 + whole)]
        return values[_runs(start[place], n_ids)], np.diff(upto, prepend=0)


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker, with the words it remembers."""
    return Encoder(path)


def _slices(batch):
    """Rows of a batch with about ``SLICE_BYTES`` of text, one at least."""
    size = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


_STRIPE = [
    ("part", T.IntegerType()), ("stripe", T.IntegerType()), ("doc_ids", None),
    ("lengths", T.ArrayType(T.LongType())), ("ids", T.LongType()), ("blocks", T.BinaryType()),
]


def _encoded(path: str, kind: pa.DataType, stripe_ids: int):
    def run(batches):
        from pyspark import TaskContext

        part, stripe = TaskContext.get().partitionId(), 0
        encoder = _encoder(path)
        names, lengths, flats = [], np.empty(0, np.int64), []

        def close(n):
            """The stripe of the first ``n`` documents; they are held no longer."""
            nonlocal names, lengths, flats, stripe
            held, size = np.concatenate(flats), int(lengths[:n].sum())
            flats = [held[size:].copy()]
            data = range_coder.encode(held[:size])
            row = [part, stripe, names[:n], lengths[:n].tolist(), size, data]
            names, lengths, stripe = names[n:], lengths[n:], stripe + 1
            types = [pa.int32(), pa.int32(), pa.list_(kind), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], [n for n, _ in _STRIPE])

        for batch in batches:
            for rows in _slices(batch):
                ids, size = encoder.flat(rows.column(1))
                names += rows.column(0).to_pylist()
                lengths = np.concatenate([lengths, size])
                flats.append(ids)
                # A half more is held, so that the last stripe is no short one: a step of few blocks takes as long.
                while lengths.sum() >= stripe_ids + stripe_ids // 2:
                    yield close(int(np.searchsorted(np.cumsum(lengths), stripe_ids)) + 1)
        if names:
            yield close(len(names))

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, stripe_ids: int = STRIPE_IDS) -> None:
    """Write the ids of all rows to ``path`` in ascending order of doc_id, null first.

    A null text is empty: its end only. Rows with the same id are all written, by
    the hash of their text. An empty table gives files without stripes.
    """
    doc_id = docs.schema["doc_id"]
    rows = docs.select("doc_id", whole().alias("text"), text_hash().alias("text_hash"))
    ordered = rows.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    kind = pa.string() if isinstance(doc_id.dataType, T.StringType) else pa.int64()
    fields = [T.StructField(n, t or T.ArrayType(doc_id.dataType)) for n, t in _STRIPE]
    stripes = ordered.select("doc_id", "text").mapInArrow(_encoded(vocabulary, kind, stripe_ids), T.StructType(fields))
    stripes.write.parquet(path)


def _decoded(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
            ids = range_coder.decode(batch.column("blocks")[i].as_py())
            if len(ids) != lengths.sum():
                raise ValueError("a stripe's length is not that of its documents")
            raw = ids.astype("<u4")
            ends = np.cumsum(lengths)
            checks = [zlib.crc32(raw[a:b]) for a, b in zip(ends - lengths, ends)]
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, batch.column("part")[i].as_py()), pa.int32()),
                    pa.array(np.full(n, batch.column("stripe")[i].as_py()), pa.int32()),
                    batch.column("doc_ids")[i].values,
                    pa.array(ends - lengths),
                    pa.array(lengths),
                    pa.array(checks, pa.int64()),
                ],
                ["part", "stripe", "doc_id", "inner", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    files = spark.read.parquet(path)
    doc_id = T.StructField("doc_id", files.schema["doc_ids"].dataType.elementType)
    whole_number = [T.StructField(c, T.LongType()) for c in ("inner", "n_tokens", "ids_crc32")]
    place = [T.StructField(c, T.IntegerType()) for c in ("part", "stripe")]
    # A row per stripe of some millions of ids: the running sum is over a short list.
    ahead = Window.partitionBy(F.lit(0)).orderBy("part", "stripe").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "stripe", F.coalesce(F.sum("ids").over(ahead), F.lit(0)).alias("before"))
    read = files.select("part", "stripe", "doc_ids", "lengths", "blocks")
    documents = read.mapInArrow(_decoded, T.StructType([*place, doc_id, *whole_number]))
    return documents.join(starts, ["part", "stripe"]).select(
        "doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Written to the shared folder and read back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_tokens(docs.sparkSession, path)
