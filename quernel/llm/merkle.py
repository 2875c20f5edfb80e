"""Merkle manifest of a table: a proof for every row, by butterfly exchange.

A row's leaf is the SHA-256 of its fields. Leaves of one part (one language) are
numbered in key order and cut into aligned blocks, the partitions of the tree.
Each block hashes its own subtree. Then blocks exchange: in every round,
aligned groups of ``group`` blocks, one from each neighbouring subtree, show each
other the roots they have, and each hashes the same ancestors for itself. After
log(blocks) / log(group) rounds every block holds the root and its own upper proof, so no
proofs are handed down the tree. The roots of the parts form one more tree.

A proof is an array of steps (left, right), from the leaf up; ``fold`` climbs it in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernel.operators import joins
from quernel.session import materialize

#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left:string,right:string>>"
_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(docs: DataFrame, fields: Sequence[str] = FIELDS, changed: Mapping[str, Column] | None = None) -> Column:
    """Leaf of a row, with some of its fields replaced by ``changed``."""
    changed = changed or {}
    return digest(*(field(changed.get(name, docs[name])) for name in fields))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(steps, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(steps: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _runs(nodes: list[str], arity: int) -> list[list[str]]:
    return [nodes[i : i + arity] for i in range(0, len(nodes), arity)]


def _climb(nodes: list[str], arity: int, levels: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Top of an aligned run of nodes, and for each level what stands left and right of each of its nodes."""
    sides = []
    for _ in range(levels):
        runs = _runs(nodes, arity)
        sides.append([("".join(run[:i]), "".join(run[i + 1 :])) for run in runs for i in range(len(run))])
        nodes = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
    return nodes[0], sides


def _levels(nodes: int, arity: int) -> int:
    """Levels above so many nodes until one remains."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // arity), levels + 1
    return levels


def _power(base: int, limit: int) -> int:
    out = base
    while out * base <= limit:
        out *= base
    return out


def _steps(rows: list[list[tuple[str, str]]]) -> pa.Array:
    flat = [step for row in rows for step in row]
    ends = [0]
    for row in rows:
        ends.append(ends[-1] + len(row))
    pairs = pa.StructArray.from_arrays(
        [pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.string())], ["left", "right"]
    )
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs).cast(_STEPS)


def _sorted(table: pa.Table, column: str) -> pa.Table:
    return table.sort_by(column)


def _block_tops(nodes: DataFrame, arity: int, block: int) -> DataFrame:
    """(tree, block, blocks, top) of every aligned block of nodes; at most ``block`` rows meet."""
    within = _levels(block, arity)

    def top(table: pa.Table) -> pa.Table:
        table = _sorted(table, "place")
        n = table["n"][0].as_py()
        levels = within if n > block else _levels(n, arity)
        found, _ = _climb(table["node"].to_pylist(), arity, levels)
        first = table.select(["tree", "block"]).slice(0, 1)
        return first.append_column("blocks", pa.array([-(-n // block)], pa.int64())).append_column(
            "top", pa.array([found], pa.string())
        )

    return nodes.groupBy("tree", "block").applyInArrow(top, "tree bigint, block bigint, blocks bigint, top string")


def _round(state: DataFrame, stride: int, arity: int, group: int) -> DataFrame:
    """One exchange: groups of blocks ``stride`` apart learn the top of ``group`` subtrees.

    The last subtree may be smaller than the others. Where a block has no
    partner in it, another of that subtree's blocks, chosen in turn, stands in.
    """
    wide = stride * group
    start = F.col("block") - F.col("block") % stride
    held = F.least(F.lit(stride).cast("bigint"), F.col("blocks") - start)
    low, slot = F.col("block") % stride, F.floor(F.col("block") % wide / stride)
    # A subtree in the first place has no neighbours where it lacks blocks itself.
    last = F.when(slot == 0, low).otherwise(F.lit(stride - 1).cast("bigint"))
    shown = state.select(
        "*",
        F.floor(F.col("block") / wide).alias("high"),
        slot.alias("slot"),
        low.alias("low"),
        F.explode(F.sequence(low, last, held)).alias("to"),
    )
    sent = shown.withColumn("own", F.col("to") == F.col("low")).withColumn(
        "steps", F.when(F.col("own"), F.col("steps"))
    )

    def meet(table: pa.Table) -> pa.Table:
        table = _sorted(table, "slot")
        # Nodes of this level in the whole tree decide how far a round may climb.
        nodes = -(-table["blocks"][0].as_py() // stride)
        levels = min(_levels(group, arity), _levels(nodes, arity))
        top, sides = _climb(table["top"].to_pylist(), arity, levels)
        own = table.append_column("i", pa.array(range(table.num_rows), pa.int64())).filter(table["own"])
        steps = []
        for i, known in zip(own["i"].to_pylist(), own["steps"].to_pylist()):
            steps.append(
                [(s["left"], s["right"]) for s in known] + [side[i // arity**level] for level, side in enumerate(sides)]
            )
        return pa.table(
            {
                "tree": own["tree"],
                "block": own["block"],
                "blocks": own["blocks"],
                "top": pa.array([top] * own.num_rows, pa.string()),
                "steps": _steps(steps),
            }
        )

    return sent.groupBy("tree", "high", "to").applyInArrow(
        meet, f"tree bigint, block bigint, blocks bigint, top string, steps {STEPS}"
    )


def upper_proofs(nodes: DataFrame, most: int, arity: int, block: int, group: int) -> DataFrame:
    """(tree, block, blocks, top, steps): each block's proof from its own top to the tree's.

    ``nodes`` has tree, block, place, n (nodes of the tree) and node; ``most`` is the largest n.
    """
    state = _block_tops(nodes, arity, block).withColumn("steps", F.array().cast(STEPS))
    stride = 1
    while stride < -(-most // block):
        state = _round(state, stride, arity, group)
        stride *= group
    return state


def _with_proofs(nodes: DataFrame, upper: DataFrame, arity: int, block: int, carried: Sequence) -> DataFrame:
    """Each node with its whole proof: the steps inside its block, then the block's."""
    within = _levels(block, arity)
    names = [f.name for f in carried]

    def join(mine: pa.Table, above: pa.Table) -> pa.Table:
        mine = _sorted(mine, "place")
        n = mine["n"][0].as_py()
        _, sides = _climb(mine["node"].to_pylist(), arity, within if n > block else _levels(n, arity))
        rest = [(s["left"], s["right"]) for s in above["steps"][0].as_py()]
        steps = [[side[i // arity**level] for level, side in enumerate(sides)] + rest for i in range(mine.num_rows)]
        out = mine.select(["place", "node", *names])
        for name in ("top", "root"):
            out = out.append_column(name, pa.array([above[name][0].as_py()] * mine.num_rows, pa.string()))
        return out.append_column("steps", _steps(steps))

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in carried)
    return (
        nodes.groupBy("tree", "block")
        .cogroup(upper.groupBy("tree", "block"))
        .applyInArrow(join, f"place bigint, node string, {kinds}top string, root string, steps {STEPS}")
    )


def _numbered(rows: DataFrame, by: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``place`` (from 0) and ``n`` in their group, without gathering a group.

    Sorted ranges are written, which fixes a row's number in its range; the counts
    of (group, range), a few rows per range, give the rest.
    """
    written = materialize(
        rows.repartitionByRange(*by, *order)
        .sortWithinPartitions(*by, *order)
        .withColumn("at", F.monotonically_increasing_id()),
        label,
    ).withColumn("range", F.shiftright("at", 33))
    counts = written.groupBy(*by, "range").agg(F.count("*").alias("here"), F.min("at").alias("first"))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    before = group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"of_{c}") for c in by],
        F.col("range").alias("of_range"),
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(group).alias("n"),
    )
    same = F.col("range") == F.col("of_range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return written.join(materialize(offsets, f"{label}-offsets"), same).select(
        *rows.columns, (F.col("at") + F.col("shift")).alias("place"), "n"
    )


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    part: str = "lang",
    fields: Sequence[str] = FIELDS,
    extra: Mapping[str, Column] | None = None,
    arity: int = 2,
    block: int = 1024,
    group: int = 16,
) -> DataFrame:
    """(key, part, place, leaf, subroot, root, steps) and ``extra``, a row per row of ``docs``.

    Rows of a part are in key order, null first, then by leaf; so are the parts.
    A null field counts as ``-`` and so differs from an empty one. Equal rows are leaves
    of their own. A text is hashed whole, once, and goes no further. Other columns of ``docs`` are not read
    and may have any name; ``extra`` are short values (expressions over ``docs``) to be kept with a row.
    ``block`` and ``group`` are rounded down to powers of ``arity``; they change the work, not the result.
    An empty table gives an empty table.
    """
    if arity < 2 or block < arity or group < arity:
        raise ValueError("arity must be 2 or more, block and group no less than arity")
    block, group = _power(arity, block), _power(arity, group)
    extra = dict(extra or {})
    leaves = materialize(
        docs.select(
            docs[part].alias("part"),
            docs[key].alias("key"),
            leaf_of(docs, fields).alias("node"),
            *[value.alias(f"extra_{i}") for i, value in enumerate(extra.values())],
            F.monotonically_increasing_id().alias("row"),
        ),
        "merkle-leaves",
    )
    numbered = _numbered(leaves, ["part"], ["key", "node", "row"], "merkle-ranges")
    parts = materialize(
        _numbered(leaves.groupBy("part").agg(F.count("*").alias("rows")), [], ["part"], "merkle-parts"), "merkle-trees"
    )
    heads = parts.select(F.col("part").alias("of_part"), F.col("place").alias("tree"))
    nodes = materialize(
        numbered.join(_small(heads), F.col("part").eqNullSafe(F.col("of_part")))
        .drop("of_part", "row")
        .withColumn("block", F.floor(F.col("place") / block)),
        "merkle-nodes",
    )
    sizes = parts.agg(F.max("rows"), F.max("n")).first()
    upper = materialize(upper_proofs(nodes, sizes[0] or 0, arity, block, group), "merkle-upper")
    tops = upper.filter("block = 0").select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.col("top").alias("node")
    )
    trees = materialize(
        tops.join(_small(parts.select("place", "n")), "place").withColumn("block", F.floor(F.col("place") / block)),
        "merkle-tops",
    )
    over = upper_proofs(trees, sizes[1] or 0, arity, block, group).withColumn("root", F.col("top"))
    rooted = materialize(
        _with_proofs(trees, over, arity, block, []).select(
            F.col("place").alias("tree"), "root", F.col("steps").alias("above")
        ),
        "merkle-roots",
    )
    whole = joins.lookup_join(
        upper, rooted, ["tree"], hot=lambda: _hot_trees(parts, block)
    ).select("tree", "block", "top", "root", F.concat("steps", "above").alias("steps"))
    carried = [f for f in nodes.schema.fields if f.name in ("part", "key") or f.name.startswith("extra_")]
    out = _with_proofs(nodes, whole, arity, block, carried)
    return out.select(
        F.col("key").alias(key),
        F.col("part").alias(part),
        "place",
        F.col("node").alias("leaf"),
        F.col("top").alias("subroot"),
        "root",
        "steps",
        *[F.col(f"extra_{i}").alias(name) for i, name in enumerate(extra)],
    )


def _small(table: DataFrame) -> DataFrame:
    """Broadcast where its measured size allows it; a shuffle join otherwise."""
    return F.broadcast(table) if joins.measured_bytes(table) <= joins.BROADCAST_BYTES else table


def _hot_trees(parts: DataFrame, block: int) -> DataFrame:
    blocks = parts.select(F.col("place").alias("tree"), F.ceil(F.col("rows") / block).alias("blocks"))
    return materialize(joins.hot_keys(blocks, ["tree"], "blocks", hot_rows=100_000), "merkle-hot")


def verified(rows: DataFrame, leaf: Column) -> DataFrame:
    """Rows of a manifest with ``folded_root`` of the given leaves and whether it is the root."""
    return rows.withColumn("folded_root", fold(leaf, F.col("steps"))).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
