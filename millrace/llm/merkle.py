"""A Merkle manifest of a dataset, with every row's proof, by a butterfly exchange.

Every row is a leaf. The leaves of a part (say, a language) stand in order of
their key and form a tree of ``FANOUT`` children a node; the roots of the parts, in
order of the part, form one more tree of that kind on top. The last run of a level may be
shorter, and a lone node at the top of a tree is its root.

Leaves are dealt into aligned blocks of ``FANOUT ** BLOCK_LEVELS``, each the whole
subtree over its rows and one row of a table. From there on every block knows its
path by a butterfly: in each round the blocks of an aligned group of
``FANOUT`` subtrees send the root of their subtree to a block of each sibling
subtree, so all of them hold the group's roots, hash the ancestor (each for
itself) and keep the siblings as the next step of the proof. After as many
rounds as the tree has levels a block holds all upper proofs of its rows; nothing
is passed down again. Where subtrees differ in blocks, the senders serve the
receivers in turn, so a block receives ``FANOUT`` digests a round and sends its share.
The levels above the parts are rounds of the same kind over groups of parts.

Rounds are tables: a row per block, one exchange, written. The driver sees two
numbers, the blocks of the largest part and the number of parts.

NULL fields are ``-`` in a leaf, others their UTF-8 byte count, ``:`` and the value.
NULL parts and keys come first; rows of one key are ordered by their leaf, so equal rows
are interchangeable and the root depends on the rows alone. Strings are ordered by their
bytes. A table of one row has its leaf as root and an empty proof; an empty
table gives an empty result. Columns that are not named are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch
from millrace.operators.segments import rank_rows

FANOUT = 8
BLOCK_LEVELS = 3


def digest(value: Column) -> Column:
    return F.sha2(F.encode(value, "utf-8"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return digest(F.concat(*[field(value) for value in fields]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(F.concat(step["before"], node, step["after"])))


def path_digest(path: Column) -> Column:
    """One digest of all siblings, level by level from the leaf, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def _parents(nodes: Column, fanout: int) -> Column:
    """The level above; each run of ``fanout`` nodes becomes its digest."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda run: digest(F.array_join(F.slice(nodes, run * fanout + 1, F.lit(fanout)), "")))


def _siblings(nodes: Column, at: Column, fanout: int) -> Column:
    """``before`` and ``after``: the other nodes of the run that the ``at``-th node, from 0, is in."""
    first = at - F.pmod(at, F.lit(fanout))
    before = F.slice(nodes, first + 1, at - first)
    after = F.slice(nodes, at + 2, F.lit(fanout - 1) - (at - first))
    return F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after"))


def _blocks(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``part``, ``block``, ``rows`` in order and the levels ``l0`` (leaves) to ``l<levels>`` (one node) of the block's subtree."""
    ranked = rank_rows(leaves, ["part"], ["key", "leaf"], "merkle-ranked")
    size = fanout**levels
    placed = ranked.withColumns({"block": F.floor(F.col("_rank") / size), "slot": F.pmod("_rank", F.lit(size)).cast("int")}).drop("_rank")
    held = [name for name in placed.columns if name not in ("part", "block")]
    held.sort(key=lambda name: name != "slot")
    blocks = placed.groupBy("part", "block").agg(F.sort_array(F.collect_list(F.struct(*held))).alias("rows"))
    blocks = blocks.withColumn("l0", F.col("rows.leaf"))
    for level in range(levels):
        blocks = blocks.withColumn(f"l{level + 1}", _parents(F.col(f"l{level}"), fanout))
    return blocks


def _first_state(blocks: DataFrame, scratch: Scratch, levels: int) -> DataFrame:
    """A row per block: its ``part`` with number and blocks, its ``node``, the levels of it that count, and an empty ``path``."""
    parts = blocks.groupBy("part").agg(F.count("*").alias("n_blocks"))
    numbered = rank_rows(parts.withColumn("all", F.lit(0)), ["all"], ["part"], "merkle-parts").select(
        F.col("part").alias("of"), F.col("_rank").alias("part_no"), "n_blocks"
    )
    numbered = scratch.write("parts", numbered)
    single = F.coalesce(*[F.when(F.size(f"l{level}") == 1, F.element_at(f"l{level}", 1)) for level in range(levels + 1)])
    local = sum((F.when(F.size(f"l{level}") > 1, 1).otherwise(0) for level in range(levels)), F.lit(0))
    tops = scratch.write("tops", blocks.select("part", "block", single.alias("lone"), F.element_at(f"l{levels}", 1).alias("node"), local.alias("local")))
    joined = tops.join(numbered, F.col("part").eqNullSafe(F.col("of"))).drop("of")
    alone = F.col("n_blocks") == 1
    return joined.select(
        "part", "block", "part_no", "n_blocks",
        F.when(alone, F.col("local")).otherwise(F.lit(levels)).alias("local"),
        F.when(alone, F.col("lone")).otherwise(F.col("node")).alias("node"),
        F.lit(0).cast("bigint").alias("slot"),
        F.expr("cast(array() AS array<struct<before: string, after: string>>)").alias("path"),
    )


def _swap(state: DataFrame, group: Column, digit: Column, sizes: Column) -> DataFrame:
    """One round: blocks of a group send their subtree's root to the sibling subtrees and hash the ancestor.

    ``sizes`` has the blocks of each subtree of the group, ``digit`` says which
    one a block is in, and its ``slot`` where it stands there. The blocks of a
    subtree with fewer blocks than the receiver's serve several in turn.
    """
    kept = [name for name in state.columns if name not in ("node", "path", "slot")]
    placed = state.withColumns({"_group": group, "_digit": digit.cast("int"), "_sizes": sizes})
    own = F.element_at("_sizes", F.col("_digit") + 1)

    def receivers(count: Column, to: Column) -> Column:
        slots = F.when(F.col("slot") < count, F.sequence(F.col("slot"), count - 1, own)).otherwise(F.expr("cast(array() AS array<bigint>)"))
        return F.transform(slots, lambda at: F.struct(to.alias("to"), at.alias("at")))

    sent = placed.withColumn("_sent", F.explode(F.flatten(F.transform("_sizes", receivers))))
    itself = (F.col("_sent.to") == F.col("_digit")) & (F.col("_sent.at") == F.col("slot"))
    # What a block keeps travels in its message to itself, so a round is one exchange.
    held = F.when(itself, F.struct(*kept, "slot", "path", "_sizes"))
    got = sent.groupBy("_group", F.col("_sent.to").alias("_to"), F.col("_sent.at").alias("_at")).agg(
        F.sort_array(F.collect_list(F.struct("_digit", "node"))).alias("_nodes"), F.first(held, ignorenulls=True).alias("_held")
    )

    def joined(keep: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(F.filter("_nodes", keep), lambda m: m["node"]), "")

    step = F.struct(joined(lambda m: m["_digit"] < F.col("_to")).alias("before"), joined(lambda m: m["_digit"] > F.col("_to")).alias("after"))
    # In the ancestor's subtree the slots of its children follow each other.
    earlier = F.aggregate(F.slice("_held._sizes", F.lit(1), F.col("_to")), F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    return got.select(
        *[F.col(f"_held.{name}").alias(name) for name in kept],
        (earlier + F.col("_held.slot")).alias("slot"),
        F.concat("_held.path", F.array(step)).alias("path"),
        digest(F.array_join(F.transform("_nodes", lambda m: m["node"]), "")).alias("node"),
    )


def _exchange(state: DataFrame, scratch: Scratch, fanout: int) -> DataFrame:
    """All rounds, first inside the parts and then over them: ``part``, ``block``, ``local``, ``path``, ``subroot`` and ``root``."""
    state = scratch.replace("state", state)
    largest, n_parts = state.agg(F.max("n_blocks"), F.max("part_no") + 1).first()
    width = 1  # blocks of a whole subtree
    while width < (largest or 0):
        run = F.floor(F.col("block") / (width * fanout))
        children = F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda d: F.col("n_blocks") - (run * fanout + d) * width)
        sizes = F.transform(F.filter(children, lambda n: n > 0), lambda n: F.least(n, F.lit(width).cast("bigint")))
        busy = state.where(F.col("n_blocks") > width)
        swapped = _swap(busy, F.struct("part_no", run.alias("run")), F.pmod(F.floor(F.col("block") / width), F.lit(fanout)), sizes)
        state = scratch.replace("state", state.where(F.col("n_blocks") <= width).unionByName(swapped))
        width *= fanout
    state = state.withColumn("subroot", F.col("node"))
    span = 1  # parts of a whole subtree
    subtrees = scratch.write("subtrees", state.where("block = 0").select(F.col("part_no").alias("no"), F.col("n_blocks").alias("size")))
    while span < (n_parts or 0):
        above = F.floor(F.col("no") / fanout)
        groups = subtrees.groupBy(above.alias("above")).agg(F.sort_array(F.collect_list(F.struct("no", "size")))["size"].alias("sizes"), F.sum("size").alias("size"))
        groups = scratch.write(f"groups-{span}", groups)
        met = state.join(groups.select("above", "sizes"), F.floor(F.col("part_no") / (span * fanout)) == F.col("above"))
        met = met.withColumn("_sibling_sizes", F.col("sizes")).drop("sizes")
        swapped = _swap(met, F.col("above"), F.pmod(F.floor(F.col("part_no") / span), F.lit(fanout)), F.col("_sibling_sizes"))
        state = scratch.replace("state", swapped.drop("above", "_sibling_sizes"))
        subtrees = groups.select(F.col("above").alias("no"), "size")
        span *= fanout
    return state.withColumnRenamed("node", "root").select("part", "block", "local", "path", "subroot", "root")


def manifest(
    docs: DataFrame, fields: Sequence[str], part: str, key: str, carry: Mapping[str, Column] | None = None,
    fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """``key``, ``part``, ``leaf``, ``subroot``, ``root`` and ``path`` of every row, and carried columns. Runs jobs.

    ``path`` has a step per level: ``before`` and ``after``, the digests of the
    siblings on either side, joined. ``fold(leaf, path)`` is the root. The
    key and part come under these names; ``carry`` gives further columns, none of these names.
    """
    carry = dict(carry or {})
    if clash := {"key", "part", "leaf", "subroot", "root", "path", "slot"} & {name.lower() for name in carry}:
        raise ValueError(f"the result has columns of these names: {sorted(clash)}")
    scratch = Scratch(docs.sparkSession, "merkle")
    leaves = docs.select(
        F.col(part).alias("part"), F.col(key).alias("key"), leaf_hash([F.col(name) for name in fields]).alias("leaf"),
        *[value.alias(name) for name, value in carry.items()],
    )
    blocks = scratch.write("blocks", _blocks(leaves, fanout, block_levels))
    known = _exchange(_first_state(blocks, scratch, block_levels), scratch, fanout)
    known = known.withColumnsRenamed({"part": "of", "block": "at", "path": "upper"})
    met = blocks.join(known, F.col("part").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))

    def with_path(row: Column) -> Column:
        at, steps = row["slot"], []
        for level in range(block_levels):
            steps.append(_siblings(F.col(f"l{level}"), F.floor(at / fanout**level).cast("int"), fanout))
        return F.struct(row.alias("row"), F.concat(F.slice(F.array(*steps), F.lit(1), F.col("local")), F.col("upper")).alias("path"))

    each = met.select("part", "subroot", "root", F.explode(F.transform("rows", with_path)).alias("one"))
    return each.select(F.col("one.row.key").alias("key"), "part", F.col("one.row.leaf").alias("leaf"), "subroot", "root", F.col("one.path").alias("path"),
                       *[F.col(f"one.row.{name}").alias(name) for name in carry])
