"""Training and validation splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.session import materialize

#: A range of hashes with at most so many rows is finished on the driver.
LAST_ROWS = 4096
#: Hex digits that one histogram tells apart.
DIGITS = 3


def random_split(df: DataFrame, share: float = 0.75, seed: int | None = None):
    """Random two-way split; rows may change sides between runs without a seed."""
    train, rest = df.randomSplit([share, 1 - share], seed=seed)
    return train, rest


def hash_split(df: DataFrame, keys: Sequence[str], share: float = 0.75):
    """Two-way split by a hash of the keys.

    The same row is always on the same side, whatever the file layout or a
    lost task; both sides are plain filters.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(10_000))
    bound = int(share * 10_000)
    return df.where(bucket < bound), df.where(bucket >= bound)


def key_hash(keys: Sequence[str], seed: int = 1) -> Column:
    """MD5 of the seed and the keys as text, in hex; a null key is empty."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))


def rank_bound(hashes: DataFrame, column: str, rank: int) -> str:
    """A string that exactly ``rank`` values are below, or fewer where equal ones stand in the way.

    ``hashes`` has one hex string per row. Histograms of a few more digits at a
    time close in on the rank, so nothing is sorted or gathered: each pass
    returns 16 ** DIGITS counts at most, and the last at most LAST_ROWS values.
    Equal values, however many, are one of these and never parted.
    """
    length, size = hashes.agg(F.max(F.length(column)), F.count("*")).first()
    if rank >= size:
        return "g"
    prefix, below = "", 0
    while size > LAST_ROWS and len(prefix) < length:
        bucket = F.substring(column, 1, len(prefix) + DIGITS)
        counts = hashes.where(F.col(column).startswith(prefix)).groupBy(bucket.alias("start")).count()
        for row in counts.orderBy("start").collect():
            if below + row["count"] > rank:
                prefix, size = row.start, row["count"]
                break
            below += row["count"]
    # Whatever comes before the prefix is in; of what starts with it, as much as fits.
    bound = prefix
    for row in hashes.where(F.col(column).startswith(prefix)).groupBy(column).count().orderBy(column).collect():
        below += row["count"]
        if below > rank:
            break
        bound = row[column] + "g"  # after every hex digit
    return bound


def exact_split(df: DataFrame, keys: Sequence[str], share: float = 0.75, seed: int = 1):
    """Two-way split with exactly ``floor(share * rows)`` rows on the first side.

    Rows go by the MD5 of the seed and their keys, so any engine finds the same
    sides. Rows with equal keys stay together; the first side then has as many as fit.
    The hashes are written once; both sides are plain filters.
    """
    hashes = materialize(df.select(key_hash(keys, seed).alias("h")), "split-hashes")
    rank = int(share * hashes.count() + 1e-9)
    first = key_hash(keys, seed) < rank_bound(hashes, "h", rank)
    return df.where(first), df.where(~first)
