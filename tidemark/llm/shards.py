"""Sharding by best-fit-decreasing bin packing.

Rows of equal text form one group that is not divided. Groups, largest first, enter the bin with
the least room that still holds them; a balanced tree of the bins by room finds it. For a fixed number of
shards the least capacity that needs no more bins is searched; groups as large as the mean of what is
left take a shard of their own.

The packing works on a bounded number of items whatever the number of rows: groups of at least
1/``FINE`` of a shard on their own (at most ``FINE`` a shard), all smaller ones in as many hashed bundles.
A bundle is never divided either, so equal texts stay together. Rows find their item by two joins with these
bounded tables. Slots are counted within pieces of an item of about ``PIECE`` rows, and a piece's
first slot comes from the pieces' row counts; so a group that holds most rows is spread over many tasks.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

SHARDS = 24
FINE = 400
PIECE = 50_000


class _Rooms:
    """Bins by (room, number) in a treap: find the least room of at least a size, add, remove."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            left, right = self._split(node[3], key)
            node[3] = left
            return node, right
        left, right = self._split(node[2], key)
        node[2] = right
        return left, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def add(self, key: tuple[int, int]) -> None:
        left, right = self._split(self.root, key)
        node = [key, zlib.crc32(repr(key).encode()), None, None]
        self.root = self._join(self._join(left, node), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin of the least room that holds ``size``."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        least = right
        while least[2] is not None:
            least = least[2]
        _, rest = self._split(right, (least[0][0], least[0][1] + 1))
        self.root = self._join(left, rest)
        return least[0]


def pack(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """The bin of each item, and the number of bins; an item above the capacity has one alone."""
    rooms, out, bins = _Rooms(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = rooms.take(sizes[i])
        if found is None:
            found = (max(capacity, sizes[i]), bins)
            bins += 1
        out[i] = found[1]
        rooms.add((found[0] - sizes[i], found[1]))
    return out, bins


def spread(sizes: list[int], shards: int) -> list[int]:
    """A shard for each item, of nearly equal total sizes."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    left, out, used = sum(sizes), [0] * len(sizes), 0
    while order and used < shards - 1 and sizes[order[0]] * (shards - used) >= left:
        out[order[0]] = used
        left -= sizes[order[0]]
        order, used = order[1:], used + 1
    if not order:
        return out
    rest, bins = [sizes[i] for i in order], shards - used
    low, high = max(-(-left // bins), rest[0]), left
    best = pack(rest, high)[0]
    while low < high:
        middle = min((low + high) // 2, low + max(1, low // 100) * 2) if high == left else (low + high) // 2
        found, n = pack(rest, middle)
        if n <= bins:
            high, best = middle, found
        else:
            low = middle + 1
    for i, b in zip(order, best, strict=True):
        out[i] = used + b
    return out


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row; the law is ``bytes``.

    NULL text has size 8, checksum 0 and shares a group with empty text. Rows that repeat take a slot each. Extra
    columns are ignored; an empty table gives no rows.
    """
    raw = F.coalesce("text", F.lit("")).cast("binary")
    rows = materialize(
        docs.select(
            "doc_id",
            (F.octet_length(raw) + 8).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.xxhash64(raw).alias("g"),
        )
    )
    key = ["g", "text_crc32", "size"]
    total = rows.agg(F.sum("size")).first()[0] or 0
    least = max(1, total // (shards * FINE))
    own = rows.groupBy(*key).agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).where(f"bytes >= {least}")
    large = own.toPandas()  # at most shards * FINE rows, by their size
    named = [(int(a), int(b), int(c), i) for i, (a, b, c) in enumerate(zip(large.g, large.text_crc32, large["size"], strict=True))]
    spark = docs.sparkSession
    names = spark.createDataFrame(named, "g long, text_crc32 long, size long, item int")
    bundle = F.lit(len(named)) + F.pmod("g", F.lit(shards * FINE)).cast("int")
    rows = rows.join(F.broadcast(names), key, "left").withColumn("item", F.coalesce("item", bundle)).drop("g")
    items = rows.groupBy("item").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).orderBy("item").toPandas()
    placed = spread([int(x) for x in items.bytes], shards)
    table = [(int(i), s, int(-(-int(n) // PIECE))) for i, s, n in zip(items["item"], placed, items["rows"], strict=True)]
    places = spark.createDataFrame(table, "item int, shard int, parts int")  # at most 2 * shards * FINE rows
    rows = rows.join(F.broadcast(places), "item")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("parts")).cast("int"))
    pieces = rows.groupBy("shard", "item", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("item", "part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("item", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("item", "part").orderBy("doc_id", "size", "text_crc32")
    rows = rows.withColumn("r", F.row_number().over(within)).join(pieces, ["item", "part"])
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("r") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
