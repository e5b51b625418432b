"""A Merkle manifest of a dataset: bitmap ranks give every row its leaf, keyed slot arrays reduce the levels.

Rows of a group (``lang``) are leaves in the order of doc_id. Their places come from bitmaps, not from a sort of the rows: the ids
of a group set bits in 64-bit words (only words with a bit are kept), and a directory of popcounts over four radix levels of the id
(words in a container of 2^16 ids, containers in 2^32, these in 2^48, and the rest) gives the number of ids before each word.
A row's rank is that number and the popcount of the lower bits of its own word. Each node of the directory has at most 65,536
children, so no group of ids, however hot, is one task's work.

The tree takes 8 nodes to one. Blocks of 4,096 consecutive leaves are 4 levels of it: a block's rows fill an array by slot, and one
task reduces the array. Block roots are nodes of the next round, so a tree over n leaves takes log_4096(n) rounds over tables that
shrink by 4,096 each. Paths to the root go down the same rounds; a row's proof is put together where its block lies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import row_numbers
from ..session import cut_lineage, small_side

ARITY_BITS = 3
ARITY = 1 << ARITY_BITS
LEVELS = 4
SPAN_BITS = ARITY_BITS * LEVELS
SPAN = 1 << SPAN_BITS
#: Bits of an id that one level of the directory takes, from words (of 64 ids) up.
RADIX = (10, 16, 16)
HASHES = {"doc_id": "long"} | {n: "string" for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")} | {"verified": "boolean"}


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value's part of a leaf: ``-`` if null, else its UTF-8 bytes counted, a colon, and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def group_key(lang: Column) -> Column:
    """A string that is never null and sorts as ``lang`` does, null first."""
    return F.when(lang.isNull(), "").otherwise(F.concat(F.lit("="), lang.cast("string")))


def leaves(docs: DataFrame, received: Column | None = None) -> DataFrame:
    """(grp, doc_id, leaf, seen): digests of the rows, and of the rows with the text ``received`` in place of theirs."""
    integers = {n: F.col(n).cast("long") for n in ("doc_id", "n_chars")}
    head = F.concat(*[field(integers.get(n, F.col(n))) for n in ("doc_id", "source", "lang", "n_chars")])
    own = F.sha2(F.concat(head, field(F.col("text"))), 256)
    seen = own if received is None else F.sha2(F.concat(head, field(received)), 256)
    return docs.select(group_key(F.col("lang")).alias("grp"), integers["doc_id"].alias("doc_id"),
                       F.unhex(own).alias("leaf"), F.unhex(seen).alias("seen"))


# --- ranks ---------------------------------------------------------------------------------------------


def bitmaps(rows: DataFrame) -> DataFrame:
    """(grp, word, bits, n, more): the set ids of each 64-bit word, its rows, and the further rows of ids that several rows have."""
    ids = rows.where("doc_id IS NOT NULL").groupBy("grp", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    bit = F.expr("CAST(doc_id & 63 AS INT)")
    more = F.when(F.col("n") > 1, F.struct(bit.alias("bit"), (F.col("n") - 1).alias("n")))
    return ids.groupBy("grp", F.shiftright("doc_id", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(doc_id & 63 AS INT))")).alias("bits"), F.sum("n").alias("n"), F.collect_list(more).alias("more")
    )


def directory(words: DataFrame, nulls: DataFrame) -> DataFrame:
    """``words`` with ``before``, the rows of the group with smaller ids (rows without id, of ``nulls``, come first)."""
    levels = [words.select("grp", F.col("word").alias("at"), "n")]
    for bits in RADIX:
        up = levels[-1].groupBy("grp", F.shiftright("at", bits).alias("at")).agg(F.sum("n").alias("n"))
        levels.append(up)
    earlier = Window.partitionBy("grp").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce("n_null", F.lit(0)) + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    top = levels[-1].join(nulls, "grp", "left").select("grp", "at", first.alias("before"))
    for level, bits in zip(levels[-2::-1], RADIX[::-1]):
        inside = Window.partitionBy("grp", "parent").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        own = level.withColumn("parent", F.shiftright("at", bits)).withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        above = top.select("grp", F.col("at").alias("parent"), "before")
        top = own.join(above, ["grp", "parent"]).select("grp", "at", (F.col("before") + F.col("own")).alias("before"))
    return words.join(top.withColumnRenamed("at", "word"), ["grp", "word"])


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (written: grp, doc_id, leaf, seen) with ``at``, their places within the group.

    Rows that share an id are ordered by their leaves; rows that are equal in that too are interchangeable.
    """
    words = cut_lineage(bitmaps(rows))
    nulls = rows.where("doc_id IS NULL").groupBy("grp").agg(F.count(F.lit(1)).alias("n_null"))
    found = directory(words, nulls).select(F.col("grp").alias("g"), F.col("word").alias("w"), "bits", "before", "more")
    bit = F.expr("CAST(doc_id & 63 AS INT)")
    lower = F.bit_count(F.expr("bits & ~shiftleft(-1L, CAST(doc_id & 63 AS INT))"))
    extra = F.aggregate(F.filter("more", lambda e: e["bit"] < bit), F.lit(0).cast("long"), lambda a, e: a + e["n"])
    shared = F.exists("more", lambda e: e["bit"] == bit)
    looked = rows.join(found, (F.col("grp") == F.col("g")) & (F.shiftright("doc_id", 6) == F.col("w")))
    looked = looked.select("grp", "doc_id", "leaf", "seen", (F.col("before") + lower + extra).alias("at"), shared.alias("shared"))
    repeated = not words.where(F.size("more") > 0).isEmpty()
    without = not nulls.isEmpty()
    if not repeated and not without:
        return looked.drop("shared")
    none = rows.where("doc_id IS NULL").select("*", F.lit(0).cast("long").alias("at"))
    several = looked.where("shared").drop("shared").unionByName(none)
    numbered = row_numbers(several.withColumn("tie", F.monotonically_increasing_id()), ["grp", "doc_id"], ["leaf", "tie"])
    placed = numbered.select("grp", "doc_id", "leaf", "seen", (F.col("at") + F.col("rn") - 1).alias("at"))
    return looked.where("NOT shared").drop("shared").unionByName(placed)


# --- slot arrays ---------------------------------------------------------------------------------------


def depth_of(n: int) -> int:
    """Levels that a block of a level with ``n`` nodes is reduced by: all to one node, at most LEVELS."""
    depth = 0
    while n > 1 and depth < LEVELS:
        n, depth = -(-n // ARITY), depth + 1
    return depth


def reduce_slots(nodes: list[str], depth: int) -> list[list[str]]:
    """The levels above an array of nodes, the array first."""
    out = [nodes]
    for _ in range(depth):
        low = out[-1]
        out.append([digest("".join(low[i : i + ARITY])) for i in range(0, len(low), ARITY)])
    return out


def siblings(level: list[str], at: int) -> tuple[str, str]:
    """What is left and right of a node within its run of 8."""
    first = at - at % ARITY
    return "".join(level[first:at]), "".join(level[at + 1 : first + ARITY])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """((grp, block, n), rows) of each block of a stream in which a block's rows lie together."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("grp", "block", "n"))))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for begin, end in zip(cuts, cuts[1:]):
            if begin == end:
                continue
            if last is not None and keys[begin] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = keys[begin]
            held.append(batch.slice(begin, end - begin))
    if held:
        yield last, pa.Table.from_batches(held)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows as dictionaries, one block's arrays at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


SLOTS = "grp string, block long, n long, ids array<long>, nodes array<binary>, seen array<binary>, top binary"


def slot_arrays(nodes: DataFrame, most: int) -> DataFrame:
    """One row for each block of ``nodes`` (grp, at, n, doc_id, node, seen): its arrays by slot and the node that it becomes.

    ``most`` is about how many nodes there are, for the number of tasks. Only the block is sorted by; rows go to their slots.
    """
    parts = max(1, min(-(-most // (4 * SPAN)), 1 << 16))
    keyed = nodes.withColumn("block", F.shiftright("at", SPAN_BITS))
    near = keyed.repartition(parts, "grp", "block").sortWithinPartitions("grp", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (grp, block, n), rows in _blocks(batches):
            size = min(SPAN, n - block * SPAN)
            arrays = {}
            slots = [at & (SPAN - 1) for at in rows.column("at").to_pylist()]
            if sorted(slots) != list(range(size)):
                raise ValueError("ranks of a block do not fill its slots")
            for name in ("doc_id", "node", "seen"):
                values, array = rows.column(name).to_pylist(), [None] * size
                for slot, value in zip(slots, values):
                    array[slot] = value
                arrays[name] = array
            top = reduce_slots([v.hex() for v in arrays["node"]], depth_of(n))[-1][0]
            yield pa.record_batch(
                [pa.array([grp]), pa.array([block], pa.int64()), pa.array([n], pa.int64()), pa.array([arrays["doc_id"]], pa.list_(pa.int64())),
                 pa.array([arrays["node"]], pa.list_(pa.binary())), pa.array([arrays["seen"]], pa.list_(pa.binary())),
                 pa.array([bytes.fromhex(top)], pa.binary())],
                names=[c.split()[0] for c in SLOTS.split(", ")],
            )

    return near.select("grp", "block", "n", "at", "doc_id", "node", "seen").mapInArrow(run, SLOTS)


PATHS = "grp string, at long, sides array<struct<left:string,right:string>>, top binary"


def climb(nodes: DataFrame, most: int) -> DataFrame:
    """(grp, at, sides, top): for each of ``nodes`` (grp, at, n, node; ``n`` of its group, at most ``most``) the siblings left and
    right of its path, from the lowest level up, and the node that its group becomes."""
    if most <= 1:
        return nodes.select("grp", "at", F.expr("CAST(array() AS array<struct<left:string,right:string>>)").alias("sides"), F.col("node").alias("top"))
    whole = nodes.select("grp", "at", "n", F.lit(None).cast("long").alias("doc_id"), "node", F.lit(None).cast("binary").alias("seen"))
    table = cut_lineage(slot_arrays(whole, most))
    n_up = F.ceil(F.col("n") / SPAN).cast("long")
    above = climb(table.select("grp", F.col("block").alias("at"), n_up.alias("n"), F.col("top").alias("node")), -(-most // SPAN))
    joined = table.drop("top").join(above.withColumnRenamed("at", "block"), ["grp", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                levels = reduce_slots([v.hex() for v in row["nodes"]], depth_of(row["n"]))
                size = len(levels[0])
                sides = []
                for slot in range(size):
                    own = [siblings(levels[i], slot >> (ARITY_BITS * i)) for i in range(len(levels) - 1)]
                    sides.append([{"left": a, "right": b} for a, b in own] + row["sides"])
                kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
                yield pa.record_batch(
                    [pa.array([row["grp"]] * size), pa.array([row["block"] * SPAN + i for i in range(size)], pa.int64()), pa.array(sides, kind),
                     pa.array([row["top"]] * size, pa.binary())], names=["grp", "at", "sides", "top"])

    return joined.select("grp", "block", "n", "nodes", "sides", "top").mapInArrow(run, PATHS)


def manifest(docs: DataFrame, received: Column | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest (lower-case hex SHA-256) of doc_id, source, lang, n_chars and text, each as ``-`` if null, else its UTF-8 byte
    count, a colon and the value. The leaves of a lang, by doc_id, are reduced 8 to 1 (the last run may have fewer, even one)
    to the lang's subroot, subroots by lang (null first, by bytes) to the root. ``proof_sha256`` is the digest of a leaf's siblings, level by
    level up to the root, left to right. ``folded_root`` is worked out from the siblings and the leaf of the row with the text
    ``received`` (a column over ``docs``; without it, of the row itself), and ``verified`` tells if it is the root.

    Null columns count as ``-``. Rows without doc_id come first in their lang. Rows that share a doc_id are leaves of their own,
    ordered by their digests; equal rows get neighbouring leaves. Empty and very long texts are hashed as they are. Other columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    rows = cut_lineage(leaves(docs, received))
    sizes = cut_lineage(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")))
    widest = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("groups")).first()
    if not widest.total:
        return docs.sparkSession.createDataFrame([], ", ".join(f"{n} {t}" for n, t in HASHES.items()))
    nodes = ranked(rows).join(small_side(sizes), "grp").withColumnRenamed("leaf", "node")
    blocks = cut_lineage(slot_arrays(nodes, widest.total))
    n_up = F.ceil(F.col("n") / SPAN).cast("long")
    upper = blocks.select("grp", F.col("block").alias("at"), n_up.alias("n"), F.col("top").alias("node"))
    paths = cut_lineage(climb(upper, -(-widest.most // SPAN)))
    subroots = row_numbers(paths.where("at = 0").select("grp", "top"), [], ["grp"])
    over = subroots.select(F.lit("").alias("grp"), (F.col("rn") - 1).alias("at"), F.lit(widest.groups).alias("n"), F.col("top").alias("node"), F.col("grp").alias("lang"))
    over = cut_lineage(over)
    roots = over.select("at", "lang").join(climb(over.drop("lang"), widest.groups).select("at", F.col("sides").alias("last"), F.col("top").alias("root")), "at")
    full = paths.join(small_side(cut_lineage(roots.select(F.col("lang").alias("grp"), "last", "root"))), "grp").select(
        "grp", F.col("at").alias("block"), F.concat("sides", "last").alias("sides"), F.col("top").alias("subroot"), "root"
    )
    return blocks.drop("top").join(full, ["grp", "block"]).select("n", "ids", "nodes", "seen", "sides", "subroot", "root").mapInArrow(
        _proofs, ", ".join(f"{n} {t}" for n, t in HASHES.items())
    )


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``manifest`` from blocks with their paths."""
    for batch in batches:
        for row in _rows(batch):
            levels = reduce_slots([v.hex() for v in row["nodes"]], depth_of(row["n"]))
            above = [(s["left"], s["right"]) for s in row["sides"]]
            rest = "".join(a + b for a, b in above)
            upper = [rest]  # the siblings from a level's node on, by node; from the block's top down
            for level in levels[-2:0:-1]:
                upper = ["".join(siblings(level, i)) + upper[i >> ARITY_BITS] for i in range(len(level))]
            subroot, root = row["subroot"].hex(), row["root"].hex()
            proofs, folded = [], []
            for slot, seen in enumerate(row["seen"]):
                if len(levels) > 1:
                    own = [siblings(levels[i], slot >> (ARITY_BITS * i)) for i in range(len(levels) - 1)]
                    proofs.append(digest("".join(own[0]) + upper[slot >> ARITY_BITS]))
                else:
                    own = []
                    proofs.append(digest(rest))
                node = seen.hex()
                for left, right in own + above:
                    node = digest(left + node + right)
                folded.append(node)
            size = len(folded)
            columns = [pa.array(row["ids"], pa.int64()), levels[0], [subroot] * size, [root] * size, proofs, folded, [f == root for f in folded]]
            yield pa.record_batch(columns, names=list(HASHES))
