"""Near duplicates by HyperMinHash: compressed registers, banding, estimate, verification.

1. A document's set is its distinct 5-word shingles. Every shingle falls into one
   of ``BUCKETS`` registers, which keeps of its least value the number of
   leading zeros and ``MANTISSA`` further bits. Equal sets are one class, named by
   its least doc_id; all that follows is about classes.
2. Runs of ``ROWS`` registers are band keys. An empty register borrows from a full
   one, chosen by a fixed random order, so small sets have bands as well.
3. Each band bucket has a leader; all its members are paired with it.
4. Pairs whose Jaccard similarity, estimated from the registers and corrected for
   chance collisions, is below the bound by more than ``SIGMAS`` deviations
   go; the others are verified on full sets.
5. Verified links give components. Where members of a bucket other than
   its leader lie in different components, these are compared with each other
   as well: registers first, then full sets, inside tasks, in blocks of bounded
   size that return only the links that tie components. Pairs inside a component
   can't change it, so no link that matters is left out, and no group is
   expanded into rows for all its pairs.

A pair at the bound of 85 shares no band with a probability of 4e-8.
Components are found by alternating large and small stars on written edges.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernel.llm import hashing
from quernel.llm.common import text_hash, unused, without
from quernel.session import materialize

#: Fixed values of the contract: shingle length, and link at 100 * common >= 85 * union.
SHINGLE, BOUND = 5, 85

BANDS, ROWS = 36, 6
BUCKETS = BANDS * ROWS
MANTISSA = 10
SIGMAS = 5.0
#: Members that one task compares with as many others at once.
BLOCK = 1024
#: Bytes of their sets, likewise.
BLOCK_BYTES = 32 << 20
#: Ids up to which a list of documents is broadcast (8 bytes each); a larger one is joined by shuffle.
BROADCAST_IDS = 1_000_000

_U64 = np.uint64
_order = np.random.Generator(np.random.PCG64(77))
#: For each register, the order in which it looks for a full one.
_PROBE = np.argsort(_order.random((BUCKETS, BUCKETS)), axis=1).astype(np.int64)
_RANK = np.argsort(_PROBE, axis=1)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(hashing.windows(words, SHINGLE))


def registers(shingles: np.ndarray) -> np.ndarray:
    """One 16-bit register per bucket, 0 where it is empty.

    A shingle's bucket comes from the high half of its remixed hash, its value from the other 48 bits.
    """
    out = np.zeros(BUCKETS, dtype=np.uint16)
    if len(shingles) == 0:
        return out
    h = hashing.mix(shingles + _U64(0x51ED270B))
    bucket = ((h >> _U64(32)) * _U64(BUCKETS)) >> _U64(32)
    value = hashing.mix(h) >> _U64(16)
    both = (bucket << _U64(48)) | value
    both.sort()
    bucket = both >> _U64(48)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    least = both[first] & _U64((1 << 48) - 1)
    _, bits = np.frexp(least.astype(np.float64))  # exact below 2**53
    zeros = 48 - bits.astype(np.int64)
    rest = (least << (zeros + 1).astype(_U64)) & _U64((1 << 48) - 1)
    rest >>= _U64(48 - MANTISSA)
    zeros = np.minimum(zeros, (1 << (16 - MANTISSA)) - 2)
    out[bucket[first].astype(np.int64)] = ((zeros + 1).astype(_U64) << _U64(MANTISSA) | rest).astype(np.uint16)
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A key for each band; an empty register counts as the first full one in its order."""
    full = regs > 0
    source = np.arange(BUCKETS)
    empty = np.flatnonzero(~full)
    if len(empty) == BUCKETS:
        return np.zeros(0, dtype=np.int64)
    have = np.flatnonzero(full)
    if len(have) < BUCKETS // 4:
        source[empty] = have[np.argmin(_RANK[empty][:, have], axis=1)]
    else:
        for attempt in range(BUCKETS):
            if not len(empty):
                break
            candidate = _PROBE[empty, attempt]
            found = full[candidate]
            source[empty[found]] = candidate[found]
            empty = empty[~found]
    # The source counts too: two registers are the same only if they come from the same place.
    filled = regs[source].astype(_U64) | (source.astype(_U64) << _U64(16))
    key = np.arange(1, BANDS + 1, dtype=_U64)
    for column in filled.reshape(BANDS, ROWS).T:
        key = hashing.mix(key * _U64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, bound: int = BOUND):
    """(Jaccard estimate, its deviation at the bound) of register rows a and b for sets of these sizes.

    Equal registers are counted, less those that two unrelated sets of such sizes
    have by chance: the sum over all register values of the product of the two
    probabilities, which is a geometric series for each number of leading zeros.
    """
    full = (a > 0) & (b > 0)
    same = ((a == b) & full).sum(axis=1)
    either = np.maximum(((a > 0) | (b > 0)).sum(axis=1), 1)
    zeros = np.arange(40)
    low = 0.5 ** (zeros + 1.0)
    width = low / 2**MANTISSA
    x, y = (n_a / BUCKETS)[:, None], (n_b / BUCKETS)[:, None]
    each = np.expm1(-x * width) * np.expm1(-y * width)
    both = x + y
    series = np.exp(-both * low) * np.expm1(-both * low) / np.expm1(-both * width)
    chance = BUCKETS * (each * series).sum(axis=1)
    # What is truly shared can't collide by chance as well.
    rate = np.minimum(chance / either, 0.5)
    j = (same / either - rate) / (1 - rate)
    return j, np.sqrt(bound / 100 * (1 - bound / 100) / either)


def likely(a, b, n_a, n_b, bound: int = BOUND) -> np.ndarray:
    """Which pairs may reach the bound: by size, and by the estimate."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    j, deviation = estimate(a, b, n_a, n_b, bound)
    return (100 * small >= bound * large) & (j >= bound / 100 - SIGMAS * deviation)


_ID = T.StructField("doc_id", T.LongType())


def _signed(batches):
    for batch in batches:
        n, print_of, regs = [], [], []
        for words in hashing.batch_words(batch.column(2)):
            s = shingle_set(words)
            n.append(len(s))
            print_of.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            regs.append(registers(s).tobytes())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(n, pa.int64()), pa.array(print_of, pa.binary()), pa.array(regs, pa.binary())],
            ["doc_id", "text_hash", "n_shingles", "print", "regs"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, print, regs): the size, a 128-bit fingerprint and the registers of a row's full set."""
    schema = T.StructType(
        [_ID, T.StructField("text_hash", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("print", T.BinaryType()),
         T.StructField("regs", T.BinaryType())]
    )
    rows = docs.select(F.col("doc_id").cast("bigint"), text_hash().alias("text_hash"), F.col("text").cast("binary"))
    return rows.mapInArrow(_signed, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    data, offsets = hashing.bytes_of(column)
    return data[offsets[0] : offsets[-1]].view(np.uint16).reshape(len(column), BUCKETS)


def _banded(batches):
    for batch in batches:
        vertex = batch.column(0).to_numpy(zero_copy_only=False)
        keys = [band_keys(r) for r in _matrix(batch.column(1))]
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.repeat(vertex, [len(k) for k in keys]))], ["key", "vertex"]
            )


def _estimated(batches, bound: int):
    for batch in batches:
        n = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)]
        if batch.num_rows:
            keep = likely(_matrix(batch.column(4)), _matrix(batch.column(5)), *n, bound)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(keep)) for i in (0, 1)], ["a", "b"]
            )


def _linked(a: np.ndarray, b: np.ndarray, bound: int) -> bool:
    """Whether two sorted sets reach the bound."""
    if len(a) > len(b):
        a, b = b, a
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * common >= bound * (len(a) + len(b) - common)


def _verified(batches, bound: int):
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            keep.append(_linked(np.frombuffer(x, _U64), np.frombuffer(y, _U64), bound))
        yield pa.RecordBatch.from_arrays(
            [batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"]
        )


def _sets(batches):
    for batch in batches:
        sets = [shingle_set(w).tobytes() for w in hashing.batch_words(batch.column(1), 1 << 20)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["vertex", "shingles"])


def _block_links(key, table, bound: int):
    """Links between different components among the members of one block, enough to tie what they tie.

    A pair that shares several bands is looked at in the first of them only.
    Pairs that pass the size and the estimate are verified on full sets.
    """
    table = table.combine_chunks()
    vertex, component, n, part = (table.column(c).to_numpy() for c in ("vertex", "component", "n_shingles", "part"))
    regs = _matrix(table.column("regs").chunk(0))
    sets = [np.frombuffer(x, _U64) for x in table.column("shingles").to_pylist()]
    keys = np.array([band_keys(r) for r in regs])
    band = int(np.flatnonzero(keys[0] == key[0].as_py())[0])
    i, j = key[1].as_py(), key[2].as_py()
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    group = component.copy()
    links = []
    for x in left:
        y = right[right > x] if i == j else right
        y = y[(group[y] != group[x]) & (100 * np.minimum(n[y], n[x]) >= bound * np.maximum(n[y], n[x]))]
        y = y[likely(regs[x][None, :], regs[y], n[[x]], n[y], bound)] if len(y) else y
        y = y[(keys[y] == keys[x]).argmax(axis=1) == band] if len(y) else y
        for z in y:
            if group[z] != group[x] and _linked(sets[x], sets[z], bound):
                links.append((vertex[x], vertex[z]))
                group[group == group[z]] = group[x]
    return pa.table({c: pa.array([min(p) if c == "a" else max(p) for p in links], pa.int64()) for c in "ab"})


_PAIR = "a bigint, b bigint"


def components(edges: DataFrame, label: str) -> DataFrame:
    """(vertex, component) of all vertices that have an edge (a, b); the component is its least vertex.

    Large star: every larger neighbour of a vertex is tied to the least of its
    neighbourhood; small star: so is every smaller one. Both keep the components;
    when nothing changes each vertex is tied to the least of its own. Edges are
    written in each round. A hub meets its row of least neighbours in
    a join, which the adaptive planner splits.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now = materialize(now, label)
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(tied.union(least.select("u", "m")).distinct(), label)
    roots = now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)


def _verify(pairs: DataFrame, sets: DataFrame, bound: int) -> DataFrame:
    a = sets.select(F.col("vertex").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("vertex").alias("b"), F.col("shingles").alias("set_b"))
    full = pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")
    return full.mapInArrow(lambda batches: _verified(batches, bound), _PAIR)


def _only(docs: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``docs`` whose id is in the list, which is broadcast only up to ``BROADCAST_IDS``."""
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, docs["doc_id"] == ids[column], "left_semi")


def near_duplicates(docs: DataFrame, bound: int = BOUND) -> DataFrame:
    """(doc_id, text_hash, n_shingles, class_id, component_id, kept), a row per row of ``docs``.

    Documents are linked with 100 * common >= bound * union. A pair at the bound shares no band with a
    probability of (1 - (bound / 100)^ROWS)^BANDS: 4e-8 at 85, 2e-5 at 80.
    Ids are integers. Rows that share an id are one document: whatever any of them is linked with is linked.
    A row without text or words has an empty set and is linked with nothing;
    nor is a row without an id, whose ``component_id`` is null and which is kept. An
    empty table gives an empty table.
    """
    signed = materialize(signatures(docs), "near-signatures")
    named = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = named.groupBy("print").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n"))
    classes = materialize(classes, "near-classes")
    firsts = classes.select("print", F.col("class_id").alias("doc_id"))
    sketch = named.join(firsts, ["print", "doc_id"], "left_semi").dropDuplicates(["print", "doc_id"])
    sketch = materialize(
        sketch.select(F.col("doc_id").alias("vertex"), "n_shingles", "regs"), "near-registers"
    )

    keys = materialize(sketch.select("vertex", "regs").mapInArrow(_banded, "key bigint, vertex bigint"), "near-keys")
    first = F.struct(F.xxhash64("vertex", "key").alias("draw"), F.col("vertex"))
    shared = keys.groupBy("key").agg(F.count("*").alias("members"), F.min(first)["vertex"].alias("leader"))
    members = materialize(keys.join(shared.filter("members > 1"), "key"), "near-members")

    found = members.select("vertex").distinct()
    found = materialize(found, "near-candidates")
    texts = _only(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary")), found, "vertex")
    sets = materialize(texts.mapInArrow(_sets, "vertex bigint, shingles binary"), "near-sets")

    star = members.filter("vertex <> leader").select(
        F.least("vertex", "leader").alias("a"), F.greatest("vertex", "leader").alias("b")
    )
    star = materialize(star.distinct(), "near-star")
    a = sketch.select(F.col("vertex").alias("a"), F.col("n_shingles").alias("n_a"), F.col("regs").alias("regs_a"))
    b = sketch.select(F.col("vertex").alias("b"), F.col("n_shingles").alias("n_b"), F.col("regs").alias("regs_b"))
    rated = star.join(a, "a").join(b, "b").filter(
        100 * F.least("n_a", "n_b") >= bound * F.greatest("n_a", "n_b")
    )
    rated = rated.select("a", "b", "n_a", "n_b", "regs_a", "regs_b")
    rated = rated.mapInArrow(lambda batches: _estimated(batches, bound), _PAIR)
    links = materialize(_verify(rated, sets, bound), "near-links")
    parts = materialize(components(links, "near-stars"), "near-components")

    # Members other than the leader: all of them have been compared with it.
    others = (
        members.filter("vertex <> leader")
        .join(parts, "vertex", "left")
        .select("key", "vertex", F.coalesce("component", "vertex").alias("component"))
    )
    others = others.join(sketch.select("vertex", "n_shingles"), "vertex")
    open_keys = (
        others.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.greatest(F.count("*") / BLOCK, 8 * F.sum("n_shingles") / BLOCK_BYTES).alias("blocks"),
        )
        .filter("low < high")
        .select("key", F.ceil("blocks").cast("int").alias("parts"))
    )
    rows = materialize(others.drop("n_shingles").join(open_keys, "key"), "near-open")
    if not rows.isEmpty():
        rows = rows.withColumn("part", F.pmod(F.xxhash64("vertex"), F.col("parts")).cast("int"))
        every = F.sequence(F.lit(0), F.col("parts") - 1)
        block = F.explode(
            F.transform(every, lambda p: F.struct(F.least("part", p).alias("i"), F.greatest("part", p).alias("j")))
        )
        rows = rows.withColumn("block", block).join(sketch, "vertex").join(sets, "vertex")
        rows = rows.select(
            "key", "block.i", "block.j", "part", "vertex", "component", "n_shingles", "regs", "shingles"
        )
        more = rows.groupBy("key", "i", "j").applyInArrow(lambda key, table: _block_links(key, table, bound), _PAIR)
        tied = parts.filter("vertex <> component").select(F.col("vertex").alias("a"), F.col("component").alias("b"))
        links = materialize(more.union(tied), "near-more-links")
        parts = materialize(components(links, "near-stars"), "near-components")

    several = classes.filter("n > 1").select("print", "class_id")
    component = F.coalesce("component", F.coalesce("class_id", "doc_id"))
    return (
        signed.drop("regs")
        .join(several, "print", "left")
        .withColumn("class_id", F.when(F.col("n_shingles") > 0, F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id")))
        .join(parts, F.col("class_id") == F.col("vertex"), "left")
        .select(
            "doc_id", "text_hash", "n_shingles", "class_id",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, bound: int = BOUND) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the least id.

    Of rows that share an id, one document as they are, the one with the least text hash stays. Rows
    without an id all stay.
    """
    found = materialize(near_duplicates(docs, bound).select("doc_id", "text_hash", "kept"), "near-kept")
    docs = without(docs, found.filter(~F.col("kept")))
    repeated = found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    again, place = unused(docs, "again", "place")
    repeated = materialize(repeated.select(F.col("doc_id").alias(again)), "near-repeated")
    if repeated.isEmpty():
        return docs
    order = [docs[f"`{c}`"] for c, t in docs.dtypes if "map<" not in t and t != "variant"]
    first = Window.partitionBy(docs["doc_id"]).orderBy(text_hash(docs["text"]), *order)
    same = docs["doc_id"] == F.col(again)
    several = docs.join(repeated, same, "left_semi")
    several = several.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1).drop(place)
    return docs.join(repeated, same, "left_anti").unionByName(several)
