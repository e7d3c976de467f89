"""Prefix trie of rebuilt conversations by fixed-length block hashing.

Conversations are cut into blocks of ``BLOCK`` turns. Every turn carries a digest of its place, role
and text; the digest of a prefix is the exclusive or of its turns' digests (two lanes of 64 bits), so
that the digest up to a block is a running value over blocks. Conversations are first grouped by these
successive block digests: all that share a block, and everything before it, become one row with their
number and smallest member. Turn boundaries are refined only inside blocks whose prefix is followed by
different blocks; a block without siblings has the same members at each of its turns.

Sums over subtrees need no walk over the tree. The smallest member of a node owns it; a conversation
owns the nodes of its path from some depth on. What a subtree sums up is therefore a sum over the
members of the node, of values that belong to a conversation, and takes the same two steps as the counts.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from opsignal.llm.common import materialise
from opsignal.operators.ranking import global_rank

BLOCK = 4
#: Blocks whose running digest is made in one window; further ones continue from sums of so many.
STRETCH = 1024
#: Conversations with a common head, and the most turns they can take from it.
FAMILY, HEAD = 20, 3
#: Bytes of joined numbers in one row.
PIECE = 1 << 16

_NODE = ["depth", "x", "y"]
_FACTS = ["up_x", "up_y", "words", "before"]


def _n_words(text: Column) -> Column:
    """Runs of anything but white space, counted without listing them."""
    return F.length(F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), r"[\x20\x09-\x0D]+", "")).cast("long")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, a, b, words``: turns in order, ``at`` running over all conversations."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        _n_words(text).alias("words"),
    )
    turns = materialise(turns, "turns")
    return global_rank(turns, [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("a"), F.col("b")], "at").drop("turn")


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id)`` of all conversations, and ``(conv_id, place, a, b, words)`` of their rebuilt turns."""
    turns = numbered_turns(conversations)
    firsts = turns.groupBy("conv_id").agg(F.min("at").alias("first"))
    turns = turns.join(firsts, "conv_id").withColumn("place", F.col("at") - F.col("first") + 1)
    turns = materialise(turns.select("conv_id", "place", "a", "b", "words"), "places")
    head = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") <= HEAD)).groupBy("conv_id")
    head = head.agg(F.array_sort(F.collect_list(F.struct("place", "a", "b", "words"))).alias("head"))
    head = head.withColumnRenamed("conv_id", "root")
    convs = turns.groupBy("conv_id").agg(F.lit(0).alias("_")).select(
        "conv_id",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int").alias("h"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("root"),
    )
    none = F.array().cast("array<struct<place:bigint,a:bigint,b:bigint,words:bigint>>")
    taken = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), 1, F.greatest("h", F.lit(1)))).otherwise(none)
    convs = materialise(convs.join(head, "root", "left").select("conv_id", "h", taken.alias("head")), "heads")
    given = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    sizes = convs.select("conv_id", "h", F.size("head").alias("n"))
    own = turns.join(sizes, "conv_id").filter(F.col("place") > F.col("h"))
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("n")).alias("place"), "a", "b", "words")
    return convs.select("conv_id"), given.unionByName(own)


def _folded(turns: Column, lane: str) -> Column:
    return F.aggregate(turns, F.lit(0).cast("long"), lambda so_far, t: so_far.bitwiseXOR(t[lane]))


def _total(turns: Column) -> Column:
    return F.aggregate(turns, F.lit(0).cast("long"), lambda so_far, t: so_far + t["words"])


def conversation_blocks(turns: DataFrame, size: int) -> DataFrame:
    """``conv_id, block, from_x, from_y, to_x, to_y, before, turns``: a row per block of a conversation.

    ``from`` and ``to`` are the digests of the prefixes that end before and with the block.
    """
    place = F.col("place")
    lanes = [F.xxhash64(F.lit(lane), "place", "a", "b").alias(name) for lane, name in ((1, "x"), (2, "y"))]
    blocks = (
        turns.select("conv_id", F.floor((place - 1) / size).alias("block"), F.struct("place", *lanes, "words").alias("t"))
        .groupBy("conv_id", "block")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
        .select("*", _folded(F.col("turns"), "x").alias("x"), _folded(F.col("turns"), "y").alias("y"), _total(F.col("turns")).alias("w"))
        .withColumn("stretch", F.floor(F.col("block") / STRETCH))
    )
    blocks = materialise(blocks, "blocks")
    zero = F.lit(0).cast("long")

    def running(keys: list[str], order: str) -> list[Column]:
        upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        sums = ((F.bit_xor, "x"), (F.bit_xor, "y"), (F.sum, "w"))
        return [F.coalesce(f(c).over(upto), zero).alias(f"{order}_{c}") for f, c in sums]

    sums = blocks.groupBy("conv_id", "stretch").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("w").alias("w"))
    starts = sums.select("conv_id", "stretch", *running(["conv_id"], "stretch"))
    inner = blocks.select("*", *running(["conv_id", "stretch"], "block")).join(starts, ["conv_id", "stretch"])
    start = {c: F.col(f"stretch_{c}").bitwiseXOR(F.col(f"block_{c}")) for c in ("x", "y")}
    return inner.select(
        "conv_id",
        "block",
        start["x"].alias("from_x"),
        start["y"].alias("from_y"),
        start["x"].bitwiseXOR(F.col("x")).alias("to_x"),
        start["y"].bitwiseXOR(F.col("y")).alias("to_y"),
        (F.col("stretch_w") + F.col("block_w")).alias("before"),
        F.col("w").alias("block_words"),
        "turns",
    )


def turn_boundaries(blocks: DataFrame, size: int) -> DataFrame:
    """A row per turn of every distinct block: the block, whether it has no sibling, the node, its members in the block.

    Blocks are distinct by the digest of everything up to their end.
    """
    shared = ["block", "from_x", "from_y", "before", "turns"]
    distinct = blocks.groupBy("to_x", "to_y").agg(
        *[F.first(c).alias(c) for c in shared], F.count("*").alias("n_convs"), F.min("conv_id").alias("owner")
    )
    distinct = materialise(distinct, "distinct_blocks")
    lonely = distinct.groupBy("block", "from_x", "from_y").agg(F.count("*").alias("n"), F.min(F.struct("to_x", "to_y")).alias("only"))
    lonely = lonely.filter("n = 1").select("only.*", F.lit(True).alias("alone"))
    steps = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda k: F.struct(
            (F.col("block") * size + k).alias("depth"),
            F.col("from_x").bitwiseXOR(_folded(F.slice("turns", 1, k), "x")).alias("x"),
            F.col("from_y").bitwiseXOR(_folded(F.slice("turns", 1, k), "y")).alias("y"),
            F.col("from_x").bitwiseXOR(_folded(F.slice("turns", 1, k - 1), "x")).alias("up_x"),
            F.col("from_y").bitwiseXOR(_folded(F.slice("turns", 1, k - 1), "y")).alias("up_y"),
            F.element_at("turns", k)["words"].alias("words"),
            (F.col("before") + _total(F.slice("turns", 1, k - 1))).alias("before"),
        ),
    )
    found = distinct.join(lonely, ["to_x", "to_y"], "left").select(
        "to_x", "to_y", F.coalesce("alone", F.lit(False)).alias("alone"), "n_convs", "owner", F.explode(steps).alias("s")
    )
    return found.select("to_x", "to_y", "alone", "n_convs", "owner", "s.*")


def _by_node(turns: DataFrame, keys: list[str], sums: dict) -> DataFrame:
    """Values of blocks at their turns: as they are where a block has no sibling, else refined to the turns' nodes."""
    as_is = turns.filter("alone").select(*keys, *sums)
    refined = turns.filter("NOT alone").groupBy(*keys).agg(*[f(c).alias(c) for c, f in sums.items()])
    return as_is.unionByName(refined)


def id_digests(ends: DataFrame) -> DataFrame:
    """``x, y, ends_sha256``: SHA-256 of the ascending numbers at each key, joined by commas.

    Rows are range-sorted, so a key with very many numbers spans partitions. A partition digests the keys
    that lie inside it; of its first and last key it hands on the joined numbers, a row for each
    ``PIECE`` bytes, and these rows are digested in order as they stream by.
    """

    def join(batches):
        first, key, ids, held = True, None, [], 0
        out = []

        def close(last: bool):
            nonlocal first, ids, held
            if key is None:
                return
            joined = ",".join(map(str, ids)).encode()
            whole = not first and not last and not held
            out.append((*key, ids[0], None if whole else joined, hashlib.sha256(joined).hexdigest() if whole else None))
            first, ids, held = False, [], 0

        def table():
            nonlocal out
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            out = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["x", "y", "first", "ids", "ends_sha256"])

        size = 0
        for batch in batches:
            for x, y, i in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "conv_id"))):
                if key != (x, y):
                    close(False)
                    key, size = (x, y), 0
                elif size >= PIECE:  # the key goes on in a further row
                    out.append((x, y, ids[0], ",".join(map(str, ids)).encode(), None))
                    ids, size, held = [], 0, held + 1
                ids.append(i)
                size += len(str(i)) + 1
            yield table()
        close(True)
        yield table()

    def digest(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for x, y, ids in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "ids"))):
                if key == (x, y):
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (x, y), hashlib.sha256()
                state.update(ids)
            yield rows(out)
        yield rows([] if key is None else [(*key, state.hexdigest())])

    def rows(out):
        columns = list(zip(*out)) or [()] * 3
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["x", "y", "ends_sha256"])

    order = ["x", "y", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = materialise(pieces.mapInArrow(join, "x long, y long, first long, ids binary, ends_sha256 string"), "ends")
    across = pieces.filter("ends_sha256 IS NULL").select("x", "y", "first", "ids")
    across = across.repartition("x", "y").sortWithinPartitions("x", "y", "first").select("x", "y", "ids")
    whole = pieces.filter("ends_sha256 IS NOT NULL").select("x", "y", "ends_sha256")
    return whole.unionByName(across.mapInArrow(digest, "x long, y long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """Nodes of the prefix trie: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A conversation ``c`` is rebuilt from the first ``crc32(c) % 4`` turns of conversation ``c - c % 20``
    and its own turns after as many. Turns stand in order of ``turn``, null first; ties go by a digest of
    role and text. Null role and text: empty. Rows without ``conv_id`` belong to no conversation. Repeated
    rows are turns of their own. A conversation left without turns is a member of the root and ends there.
    Empty texts have no words. Further columns are not read. Empty table: no rows, not even the root.

    Texts are read once, to digests; all that follows moves numbers. One conversation may hold any share
    of the turns and one node any share of the conversations: rows of a conversation meet by block only,
    members of a node are counted block by block before any turn is looked at.
    """
    convs, turns = rebuild(conversations)
    convs = materialise(convs, "conversations")
    blocks = materialise(conversation_blocks(turns, size), "prefixes")
    inside = materialise(turn_boundaries(blocks, size), "boundaries")

    zero = F.lit(0).cast("long")
    everyone = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("owner")).filter("n_convs > 0")
    root = everyone.select(F.lit(0).cast("long").alias("depth"), *[zero.alias(c) for c in ("x", "y", *_FACTS)], "n_convs", "owner")
    nodes = _by_node(inside, _NODE + _FACTS, {"n_convs": F.sum, "owner": F.min}).unionByName(root)
    nodes = materialise(nodes, "nodes")
    below = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_x").alias("x"), F.col("up_y").alias("y"))
    nodes = nodes.join(below.agg(F.count("*").alias("n_children")), _NODE, "left").fillna(0, ["n_children"])
    nodes = materialise(nodes, "families")

    # what belongs to a conversation: words before its first own node, or all if it owns none; 1 if it owns a leaf
    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("before").alias("own_from"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    owned = materialise(owned, "owned")
    end = blocks.groupBy("conv_id").agg(F.max_by(F.struct("to_x", "to_y", (F.col("before") + F.col("block_words")).alias("all")), "block").alias("e"))
    facts = convs.join(end, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id",
        F.coalesce("e.to_x", zero).alias("x"),
        F.coalesce("e.to_y", zero).alias("y"),
        F.coalesce("own_from", "e.all", zero).alias("foreign"),
        F.coalesce("leaf", zero).alias("n_leaves"),
    )
    facts = materialise(facts, "facts")
    totals = [F.sum(c).alias(c) for c in ("foreign", "n_leaves")]
    of_block = blocks.select("conv_id", "to_x", "to_y").join(facts.select("conv_id", "foreign", "n_leaves"), "conv_id")
    of_block = of_block.groupBy("to_x", "to_y").agg(*totals)
    sums = _by_node(inside.select("to_x", "to_y", "alone", *_NODE).join(of_block, ["to_x", "to_y"]), _NODE, {"foreign": F.sum, "n_leaves": F.sum})
    sums = sums.unionByName(facts.agg(*totals).select(F.lit(0).cast("long").alias("depth"), zero.alias("x"), zero.alias("y"), "*"))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("owner").alias("parent_conv_id"))
    saved = F.col("foreign") - (F.col("n_convs") - 1) * F.col("before") - F.col("own_from")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(sums, _NODE)
        .join(owned.select(F.col("conv_id").alias("owner"), "own_from"), "owner")
        .join(parents, ["depth", "up_x", "up_y"], "left")
        .join(id_digests(facts.select("x", "y", "conv_id")), ["x", "y"], "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            saved.alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
