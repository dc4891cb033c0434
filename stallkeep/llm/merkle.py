"""A Merkle manifest whose partitions learn their upper proofs by a butterfly exchange.

Leaves are numbered within their tree and cut into blocks of ``FANOUT`` to the
power ``BLOCK_LEVELS``, aligned to the fan-out. Every block hashes its own subtree.
Then blocks swap subtree roots in rounds: in round r the blocks whose numbers
differ only in digit r (to the base of the fan-out) meet, each hands over the
root of the subtree it lies in, and all of them hash the parent. Each block so
gathers the siblings of all its ancestors on the way up; nothing is sent down
again. In a last subtree that is not full, the blocks there stand in for the
missing ones. A group never has more than FANOUT members.

A digest is the lower-case hex SHA-256; digests are concatenated as hex text.
While a tree has several nodes on a level, each run of FANOUT consecutive nodes
(the last run may be shorter, even one node) becomes their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stallkeep.llm.common import slices, written
from stallkeep.llm.order import numbered_within
from stallkeep.operators.joins import spread_join

FANOUT = 8
BLOCK_LEVELS = 3
_STEPS = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def record_digest(*fields: Column) -> Column:
    """Digest of a record: each field as its UTF-8 byte count, ``:`` and its value, ``-`` for null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def manifest(
    leaves: DataFrame,
    tree: str,
    by: Sequence[str],
    carried: Sequence[str] = (),
    leaf: str = "leaf",
    claimed: str | None = None,
    with_proof: bool = False,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per leaf: its carried columns, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves lie in the tree that the string column ``tree`` names (null is a tree
    of its own, the first), in the order of ``by`` (nulls first, ties by leaf).
    ``subroot`` is the root of that tree; the subroots, by tree name bytewise,
    form the tree whose root is ``root``. ``proof_sha256`` is the digest of all
    siblings from the leaf to ``root``. ``folded_root`` is what the digest in
    ``claimed`` (the leaf itself if not given) gives with those siblings, and
    ``verified`` whether that is ``root``. ``with_proof`` adds the siblings, level
    by level, as ``proof``. Columns not named are left out. No leaves, no rows;
    rows repeated in full are leaves of their own.
    """
    rows = leaves.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{tree}`")), F.lit("")).alias("_tree"),
        F.col(f"`{leaf}`").alias("_leaf"),
        F.col(f"`{claimed or leaf}`").alias("_claimed"),
        *[F.col(f"`{c}`").alias(f"_by{i}") for i, c in enumerate(by)],
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carried]).alias("_carried"),
    )
    blocks, uppers = _climb(rows, [f"_by{i}" for i in range(len(by))], block_levels)
    subroots = uppers.filter("_block = 0").select(F.col("_tree").alias("_name"), F.col("_root").alias("_leaf"))
    top_rows = subroots.select(F.lit("").alias("_tree"), "_leaf", F.col("_leaf").alias("_claimed"), "_name", F.struct("_name").alias("_carried"))
    top_blocks, top_uppers = _climb(top_rows, ["_name"], block_levels)
    none = F.array().cast(_STEPS)
    top = _folded(top_blocks.join(top_uppers, ["_tree", "_block"]).withColumns({"_top": none, "_all": F.col("_root")}), True, block_levels)
    top = written(top.select(F.col("_name").alias("_tree"), F.col("proof").alias("_top"), F.col("root").alias("_all")), "subroots")
    placed = spread_join(blocks.join(uppers, ["_tree", "_block"]), top, ["_tree"], "inner")
    return _folded(placed, with_proof, block_levels)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], least: int) -> list[list[str]]:
    """Nodes level by level: ``least`` levels above the leaves, or, if 0, up to a single node."""
    found = [nodes]
    while len(found) <= least or (not least and len(found[-1]) > 1):
        last = found[-1]
        found.append([_digest("".join(last[i : i + FANOUT])) for i in range(0, len(last), FANOUT)])
    return found


def _climb(rows: DataFrame, by: Sequence[str], block_levels: int) -> tuple[DataFrame, DataFrame]:
    """Blocks with their leaves, and per block its upper siblings and the root of its tree."""
    numbered = numbered_within(rows, "_tree", [*by, "_leaf"], "_index")
    size = FANOUT**block_levels
    item = F.struct("_index", "_leaf", "_claimed", "_carried")
    # A block holds at most ``size`` leaves, whatever the size of its tree.
    gathered = numbered.groupBy("_tree", F.expr(f"_index div {size}").alias("_block")).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    schema = T.StructType([*gathered.schema.fields, T.StructField("_full", T.StringType()), T.StructField("_alone", T.StringType())])
    fields = to_arrow_schema(schema)

    def rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for some in batches for b in slices([some], 16)):
            roots = []
            for items in batch.column(2):
                nodes = pc.struct_field(items.values, "_leaf").to_pylist()
                roots.append((_levels(nodes, block_levels)[-1][0], _levels(nodes, 0)[-1][0]))
            full, alone = (pa.array(x, pa.string()) for x in zip(*roots, strict=True))
            yield pa.RecordBatch.from_arrays([*batch.columns, full, alone], schema=fields)

    blocks = written(gathered.mapInArrow(rooted, schema), "blocks")
    trees = written(blocks.groupBy("_tree").agg(F.count("*").alias("_blocks")), "trees")
    most = trees.agg(F.max("_blocks")).first()[0] or 0
    state = spread_join(blocks.select("_tree", "_block", "_full", "_alone"), trees, ["_tree"], "inner").select(
        "_tree", "_block", "_blocks", F.when(F.col("_blocks") > 1, F.col("_full")).otherwise(F.col("_alone")).alias("_root"), F.array().cast(_STEPS).alias("_upper")
    )
    width = 1
    while width < most:
        state = _exchange(state, width)
        width *= FANOUT
    uppers = state.select("_tree", "_block", (F.col("_blocks") > 1).alias("_several"), "_root", "_upper")
    return blocks.drop("_full", "_alone"), written(uppers, "uppers")


def _exchange(state: DataFrame, width: int) -> DataFrame:
    """One round: blocks at the same place in the ``width`` blocks wide subtrees of one parent meet."""
    block, blocks = F.col("_block"), F.col("_blocks")
    present = blocks % width  # blocks of a last subtree that is not full
    place = block % width
    # They stand in for the others of that subtree, in turn.
    last = (present > 0) & (F.floor(block / width) == F.floor(blocks / width))
    others = F.when(last & (place + present < width), F.sequence(place + present, F.lit(width - 1).cast("bigint"), present)).otherwise(F.array().cast("array<bigint>"))
    seats = state.withColumns(
        {"_group": F.floor(block / (width * FANOUT)), "_child": F.floor(block / width) % FANOUT, "_place": F.explode(F.concat(F.array(place), others))}
    )
    member = F.struct("_child", "_root", "_block", "_blocks", "_upper", (F.col("_place") == place).alias("_own"))
    met = seats.groupBy("_tree", "_group", "_place").agg(F.sort_array(F.collect_list(member)).alias("_members"))

    def roots(of: Column) -> Column:
        return F.concat_ws("", F.transform(of, lambda m: m["_root"]))

    each = met.select("_tree", "_group", "_members", F.explode("_members").alias("_me")).filter("_me._own")
    me = F.col("_me")
    # The first group with a single subtree is a whole tree: it has no parent.
    whole = (F.col("_group") == 0) & (F.size("_members") == 1)
    step = F.struct(
        roots(F.filter("_members", lambda m: m["_child"] < me["_child"])).alias("left"), roots(F.filter("_members", lambda m: m["_child"] > me["_child"])).alias("right")
    )
    return each.select(
        "_tree",
        me["_block"].alias("_block"),
        me["_blocks"].alias("_blocks"),
        F.when(whole, me["_root"]).otherwise(F.sha2(roots(F.col("_members")).cast("binary"), 256)).alias("_root"),
        F.when(whole, me["_upper"]).otherwise(F.concat(me["_upper"], F.array(step))).alias("_upper"),
    )


def _folded(blocks: DataFrame, with_proof: bool, block_levels: int) -> DataFrame:
    """Every leaf of the blocks with the digest of its siblings and the root they give."""
    carried = blocks.schema["_items"].dataType.elementType["_carried"].dataType
    names = [f for f in carried.fields if f.name != "_"]
    texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = T.StructType([*names, *[T.StructField(n, T.StringType()) for n in texts], T.StructField("verified", T.BooleanType())])
    if with_proof:
        schema = schema.add("proof", _STEPS)
    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for some in batches for b in slices([some], 16)):
            found: list[tuple] = []
            kept = []
            for row in batch.select(["_items", "_several", "_root", "_upper", "_top", "_all"]).to_struct_array():
                items = row["_items"].values
                kept.append(items.field("_carried"))
                leaves, claims = items.field("_leaf").to_pylist(), items.field("_claimed").to_pylist()
                subroot, root = row["_root"].as_py(), row["_all"].as_py()
                upper = [(s["left"], s["right"]) for s in (row["_upper"].as_py() + row["_top"].as_py())]
                tail = "".join(a + b for a, b in upper)
                levels = _levels(leaves, block_levels if row["_several"].as_py() else 0)[:-1]
                # Siblings of every node, once for all leaves below it.
                beside = [_beside(level) for level in levels]
                for i, (own, claim) in enumerate(zip(leaves, claims, strict=True)):
                    path = []
                    for pairs in beside:
                        path.append(pairs[i])
                        i //= FANOUT
                    proof = _digest("".join(a + b for a, b in path) + tail)
                    path += upper
                    node = claim
                    for a, b in path:
                        node = _digest(a + node + b)
                    out = (own, subroot, root, proof, node, node == root)
                    found.append((*out, [{"left": a, "right": b} for a, b in path]) if with_proof else out)
            if found:
                held = pa.concat_arrays(kept)
                columns = [held.field(f.name) for f in names] + [pa.array(c, t) for c, t in zip(zip(*found, strict=True), fields.types[len(names) :], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return blocks.mapInArrow(run, schema)


def _beside(level: list[str]) -> list[tuple[str, str]]:
    pairs = []
    for start in range(0, len(level), FANOUT):
        run = level[start : start + FANOUT]
        pairs += [("".join(run[:k]), "".join(run[k + 1 :])) for k in range(len(run))]
    return pairs
