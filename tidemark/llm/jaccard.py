"""N-gram Jaccard join with set-relation skipping.

Each text becomes the set of its distinct word shingles (64-bit hashes); texts with equal sets are
one set from then on. A pair of similar sets shares one of the first shingles of both in any common order,
and the order here puts rare shingles first. Frequencies are exact, in two steps:

1. Shingles below a hash limit (a share of all that is twice what a similar pair may lack) come first,
   by the number of sets that hold them; the others follow by hash. One that a single set holds
   links nothing and is not listed, so a set whose first shingles are its own drops out.
2. The sets that are left on lists of two or more are read again whole, and all their shingles are counted
   among them. Sets are listed under their first shingles in that order, with their place.

The lists are answered in rounds. A round compares the sets of each list with its leader only,
the set that has the fewest rarer shingles. What that answers is derived, not compared: sets that a link
joins need not meet again, a list whose sets are in one component is skipped whole, and a later
meeting is skipped if the distances of both to the last leader differ by more than a link allows
(Jaccard distance is a metric). Lists that are open after ``ROUNDS`` leaders are cut into blocks by
size and place; a pair of blocks is skipped if their sizes and best places rule out every link or if
all their sets are in one component, and only sets of the remaining pairs of blocks meet. No link
between components is lost.

A set is all that is ever held whole; buckets of counted shingles are hash classes whose number
follows the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, components
from tidemark.llm.shingles import WordHashes, digest, shingle_set
from tidemark.session import materialize

SHINGLE = 3
PERCENT = 90
ROUNDS = 3
PACK = 1_000_000  # shingles that a task packs at a time, and about those of a bucket
PLACES = 8  # blocks of places for each band of sizes


def _sets(texts: pa.Array, n: int, known: WordHashes):
    for text in texts:
        yield shingle_set(known.of((text.as_py() or "").encode("utf-8", "replace").lower().split()), n)


def _first(size: int, percent: int) -> int:
    """How many first shingles a pair that is similar enough must meet in."""
    return size - -(-percent * size // 100) + 1 if size else 0


def _limit(percent: int) -> np.uint64:
    return np.uint64(min(2**64 - 1, 2**64 * 2 * (100 - percent) // 100))


def sets_of(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n, key (of the set, NULL if empty), low (shingles below the limit), rest.

    ``rest`` holds the smallest other shingles where those below the limit are too few.
    """
    known, limit = WordHashes(), _limit(percent)

    def run(batch: pa.RecordBatch):
        sizes, keys, low, rest = [], [], [], []
        for shingles in _sets(batch.column(1), n, known):
            sizes.append(len(shingles))
            keys.append(digest(shingles) if len(shingles) else None)
            low.append(int(np.searchsorted(shingles, limit)))
            rest.append(shingles[low[-1] : _first(len(shingles), percent)].view("int64"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                pa.array(low, pa.int64()), pa.array(rest, pa.list_(pa.int64())),
            ],
            names=["doc_id", "n", "key", "low", "rest"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, key long, low long, rest array<long>"
    return materialize(arrow_map(docs.select("doc_id", "text"), schema, run))


def _pack(sets, buckets: int):
    """Record batches of (bucket, h, key) arrays from (key, shingles); a key once per batch."""

    def batch(keys: list, shingles: list):
        h = np.concatenate(shingles)
        key = np.repeat(np.array(keys, "int64"), [len(x) for x in shingles])
        at = (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)) % np.uint64(buckets)
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order].astype("int64"), prepend=-1))
        ends = pa.array(np.append(first, len(order)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(at[order][first].astype("int64")),
                pa.ListArray.from_arrays(ends, pa.array(h[order].view("int64"))),
                pa.ListArray.from_arrays(ends, pa.array(key[order])),
            ],
            names=["bucket", "h", "key"],
        )

    seen: dict[int, np.ndarray] = {}
    size = 0
    for key, shingles in sets:
        if len(shingles) and key not in seen:
            seen[key] = shingles
            size += len(shingles)
        if size >= PACK:
            yield batch(list(seen), list(seen.values()))
            seen, size = {}, 0
    if size:
        yield batch(list(seen), list(seen.values()))


def _held_by_several(table: pa.Table) -> pa.Table:
    """(key, h, often) of the shingles of a bucket that two sets or more hold."""
    h, key = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("h", "key"))
    order = np.lexsort((key, h))
    h, key = h[order], key[order]
    once = np.r_[True, (h[1:] != h[:-1]) | (key[1:] != key[:-1])]
    h, key = h[once], key[once]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    often = np.diff(np.append(first, len(h)))
    often = np.repeat(often, often)
    keep = often > 1
    return pa.table({"key": key[keep], "h": h[keep], "often": often[keep].astype("int64")})


def _counted(packed: DataFrame, sets: DataFrame) -> DataFrame:
    """Sets (key, n, low and others) with ``shared``: their shingles that others hold too, rarest first."""
    found = packed.groupBy("bucket").applyInArrow(_held_by_several, "key long, h long, often long")
    shared = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("often", "h"))).alias("l"))
    return sets.join(shared.select("key", F.col("l.h").alias("shared")), "key", "left").withColumn(
        "shared", F.coalesce("shared", F.array().cast("array<long>"))
    )


def _entries(sets: DataFrame, percent: int) -> DataFrame:
    """token, key, n, p: the first shingles of each set that others hold, on lists of two sets or more."""
    alone = F.col("low") - F.size("shared")  # held by no other set, so first in the order
    sets = sets.withColumn("first", F.expr(f"n - (n * {percent} + 99) div 100 + 1")).withColumn("alone", alone)
    tokens = F.expr("concat(slice(shared, 1, int(greatest(0L, least(first, low) - alone))), if(low < first, rest, array()))")
    listed = sets.select("key", "n", "alone", F.posexplode(tokens).alias("p", "token"))
    listed = listed.select("token", "key", "n", (F.col("alone") + F.col("p")).alias("p"))
    long = listed.groupBy("token").count().where("count > 1").select("token")
    return listed.join(long, "token")


def _whole(docs: DataFrame, sets: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """key, members of the sets in ``keys``, from one text of each."""
    chosen = sets.join(keys, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc"))
    ids = chosen.select("doc").distinct()
    known = WordHashes()

    def run(batch: pa.RecordBatch):
        found = list(_sets(batch.column(0), n, known))
        yield pa.RecordBatch.from_arrays(
            [pa.array([digest(x) for x in found], pa.int64()), pa.array([x.view("int64") for x in found], pa.list_(pa.int64()))],
            names=["key", "members"],
        )

    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc"]), "left_semi").select("text")
    rows = arrow_map(texts, "key long, members array<long>", run)
    # Other texts of these ids go; repeated rows of one id are one set.
    return materialize(rows.join(keys, "key", "left_semi").dropDuplicates(["key"]))


def lists(docs: DataFrame, sets: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The lists (token, key, n, p) and, of each listed set, key and its shingles that others hold."""
    known, limit = WordHashes(), _limit(percent)
    each = sets.where("key is not null").dropDuplicates(["key"]).drop("doc_id")
    buckets = 1 + int(sets.agg(F.sum("low")).first()[0] or 0) // PACK

    def low(batches):
        def of():
            for batch in batches:
                for shingles in _sets(batch.column(0), n, known):
                    if len(shingles):
                        yield digest(shingles), shingles[: np.searchsorted(shingles, limit)]

        yield from _pack(of(), buckets)

    packed = "bucket long, h array<long>, key array<long>"
    some = _counted(docs.select("text").mapInArrow(low, packed), each)
    keys = materialize(_entries(some, percent).select("key").distinct())
    whole = _whole(docs, sets, keys, n)
    again = 1 + int(whole.agg(F.sum(F.size("members").cast("long"))).first()[0] or 0) // PACK

    def every(batches):
        def of():
            for batch in batches:
                for key, members in zip(batch.column(0), batch.column(1), strict=True):
                    yield key.as_py(), members.values.to_numpy(zero_copy_only=False).view("uint64")

        yield from _pack(of(), again)

    own = whole.select("key", F.size("members").cast("long").alias("n"), F.size("members").cast("long").alias("low"))
    own = own.withColumn("rest", F.array().cast("array<long>"))
    counted = materialize(_counted(whole.mapInArrow(every, packed), own).drop("rest"))
    entries = materialize(_entries(counted.withColumn("rest", F.array().cast("array<long>")), percent))
    return entries, counted.select("key", "shared")


def _enough(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def _possible(na: Column, pa: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Whether sizes and places (of a common shingle, if it is the first) allow a link."""
    shared = 1 + F.least(na - pa, nb - pb)
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    return sizes & _enough(shared, na, nb, percent)


def _compared(pairs: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """a, b, ra, rb, linked, d (distance): each pair once, by the shingles that others hold too."""
    left = shared.select(F.col("key").alias("a"), F.col("shared").alias("ma"))
    right = shared.select(F.col("key").alias("b"), F.col("shared").alias("mb"))
    both = pairs.dropDuplicates(["a", "b"]).join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("ma", "mb")).cast("long")
    found = both.select("a", "b", "ra", "rb", "na", "nb", common.alias("c"))
    return materialize(
        found.select(
            "a", "b", "ra", "rb", _enough(F.col("c"), F.col("na"), F.col("nb"), percent).alias("linked"),
            (1 - F.col("c") / (F.col("na") + F.col("nb") - F.col("c"))).alias("d"),
        )
    )


def links(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, n, key) and (node, root) of the sets that are linked with others."""
    sets = sets_of(docs, n, percent)
    entries, shared = lists(docs, sets, n, percent)
    entries = entries.withColumns({"root": F.col("key"), "d": F.lit(None).cast("double")})
    reach = 1 - percent / 100 + 1e-9
    linked = None
    for _ in range(ROUNDS):
        # The leader has the fewest shingles before the common one.
        leaders = entries.groupBy("token").agg(
            F.min(F.struct("p", "n", "key", "root", "d")).alias("l"), F.min("root").alias("lo"), F.max("root").alias("hi")
        ).where("lo <> hi").select("token", *[F.col(f"l.{x}").alias(f"{x}a") for x in ("p", "n", "key", "root", "d")])
        open_ = materialize(entries.join(leaders, "token").where("key <> keya"))
        if open_.limit(1).count() == 0:
            return sets, _roots(linked, entries)
        far = F.coalesce(F.abs(F.col("d") - F.col("da")) <= reach, F.lit(True))
        met = open_.where(F.col("root") != F.col("roota")).where(far).where(
            _possible(F.col("na"), F.col("pa"), F.col("n"), F.col("p"), percent)
        )
        found = _compared(
            met.select(F.col("keya").alias("a"), F.col("key").alias("b"), F.col("roota").alias("ra"), F.col("root").alias("rb"), "na", F.col("n").alias("nb")),
            shared, percent,
        )
        linked, entries = _after(linked, found, open_)
    found = _compared(_block_pairs(entries, reach, percent), shared, percent).where("linked").select("a", "b")
    return sets, _roots(linked.unionByName(found), entries)


def _after(linked: DataFrame | None, found: DataFrame, open_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links so far, and what is left of the open lists, with new roots and distances."""
    new = found.where("linked")
    # Components of components: only roots that a new link joins are looked at.
    joined = components(new.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    answers = found.select(F.col("a").alias("keya"), F.col("b").alias("key"), F.col("d").alias("now"))
    left = open_.join(answers, ["keya", "key"], "left").select("token", "key", "n", "p", "root", F.col("now").alias("d"))
    left = left.join(joined.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    left = left.select("token", "key", "n", "p", F.coalesce("top", "root").alias("root"), "d")
    pairs = new.select("a", "b")
    return (linked.unionByName(pairs) if linked is not None else pairs), materialize(left)


def _roots(linked: DataFrame | None, entries: DataFrame) -> DataFrame:
    if linked is None:
        linked = entries.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0)
    return materialize(components(linked))


def _block_pairs(entries: DataFrame, reach: float, percent: int) -> DataFrame:
    """Pairs of sets on one list that nothing rules out, by way of blocks of size and place."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent))).cast("int")
    place = F.floor(PLACES * F.col("p") / F.greatest(F.lit(1), F.expr(f"n - (n * {percent} + 99) div 100 + 1"))).cast("int")
    entries = entries.withColumns({"band": band, "block": place})
    own = ["token", "band", "block"]
    facts = entries.groupBy(*own).agg(
        F.min("n").alias("n"), F.max("n").alias("most"), F.max(F.col("n") - F.col("p")).alias("room"),
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("d").alias("near"), F.max("d").alias("far"),
        F.count("d").alias("known"), F.count("*").alias("c"),
    )
    one = facts.select("token", *[F.col(x).alias(f"{x}a") for x in facts.columns if x != "token"])
    two = facts.select("token", *[F.col(x).alias(f"{x}b") for x in facts.columns if x != "token"])
    two = two.withColumn("banda", F.explode(F.array(F.col("bandb") - 1, F.col("bandb"), F.col("bandb") + 1)))
    met = one.join(two, ["token", "banda"])
    met = met.where((F.struct("banda", "blocka") <= F.struct("bandb", "blockb")) & (F.least("loa", "lob") != F.greatest("hia", "hib")))
    met = met.where(_enough(1 + F.least("rooma", "roomb"), F.col("na"), F.col("nb"), percent))
    all_known = (F.col("knowna") == F.col("ca")) & (F.col("knownb") == F.col("cb"))
    met = met.where(~all_known | ((F.col("neara") - F.col("farb") <= reach) & (F.col("nearb") - F.col("fara") <= reach)))
    met = met.select("token", "banda", "blocka", "bandb", "blockb")
    left = entries.select("token", F.col("band").alias("banda"), F.col("block").alias("blocka"), F.col("key").alias("a"), F.col("n").alias("na"), F.col("p").alias("pa"), F.col("root").alias("ra"), F.col("d").alias("da"))
    right = entries.select("token", F.col("band").alias("bandb"), F.col("block").alias("blockb"), F.col("key").alias("b"), F.col("n").alias("nb"), F.col("p").alias("pb"), F.col("root").alias("rb"), F.col("d").alias("db"))
    far = F.coalesce(F.abs(F.col("da") - F.col("db")) <= reach, F.lit(True))
    same = (F.col("banda") == F.col("bandb")) & (F.col("blocka") == F.col("blockb")) & (F.col("a") > F.col("b"))
    on = (F.col("ra") != F.col("rb")) & far & _possible(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), percent) & ~same
    half = met.join(left, ["token", "banda", "blocka"])
    right = right.select(*[F.col(x).alias(f"{x}_") if x in ("token", "bandb", "blockb") else F.col(x) for x in right.columns])
    keys = (F.col("token") == F.col("token_")) & (F.col("bandb") == F.col("bandb_")) & (F.col("blockb") == F.col("blockb_"))
    pairs = half.join(right, keys & on)
    return materialize(pairs.select("a", "b", "ra", "rb", "na", "nb").distinct())


def groups(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    NULL or empty text has no shingles, is linked with nothing and is its own component. Rows that repeat
    link with each other. A NULL doc_id is never the smallest of a component that has others.
    Extra columns are ignored; an empty table gives no rows.
    """
    sets, roots = links(docs, n, percent)
    low = sets.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("low"))
    low = low.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = low.groupBy("root").agg(F.min("low").alias("component_id"))
    of = low.join(least, "root").select("key", "component_id")
    return sets.join(of, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their group, all columns unchanged.

    Rows that share that doc_id all stay, as do rows with a NULL doc_id.
    """
    away = groups(docs, n, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(away, "doc_id", "left_anti")
