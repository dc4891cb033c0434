"""The prefix trie of all conversations, from adaptive radix trees.

A turn is named by a fixed-width big-endian id, the first 128 bits of the
SHA-256 of its role and text; a conversation is the string of its turns' ids.
The strings are cut into chunks of ``CHUNK`` turns, so that neither a long
conversation nor one with a third of all rows is ever one row. The first chunks
are sorted across partitions, each partition puts its part into an adaptive
radix tree, and every depth of that tree that ends a turn becomes a node.

Only prefixes of a partition's first and last string can lie in other
partitions as well. These nodes (the spine, at most 2 * CHUNK a partition) are
summed up apart, by their prefix; all other nodes are finished where they are.
Conversations that share a whole chunk and go on are a class; the classes' next
chunks go the same way one level deeper, and what they add up to is known to
the level above as a leaf's value. What goes on alone has no trie below it. So
there are as many levels as the longest shared prefix has chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from stallkeep.llm.art import RadixTree, climb
from stallkeep.llm.common import batch_of, written
from stallkeep.llm.order import numbered_within
from stallkeep.operators.joins import spread_join

WIDTH = 16
CHUNK = 16
IDS_A_PIECE = 4096
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), id, words of every turn.

    Columns conv_id, turn, role and text are read, others ignored. A null role or
    text is empty; rows without a conv_id belong to no conversation and are left
    out. A null turn comes first, repeated turn numbers go by id. ``words`` counts
    runs of anything but ASCII white space in the text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    record = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(record.cast("binary"), 256), 1, 2 * WIDTH)).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    # Written first: the sort samples its input, and the texts are read once.
    return numbered_within(written(rows, "turn-ids"), "conv_id", ["turn", "id"], "place").drop("turn")


def prefix_trie(placed: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations, from the empty one on.

    ``placed`` has conv_id, place (from 0, without gaps), id (16 bytes) and words;
    ``conversations`` the conv_id of each conversation once, those without turns
    too. Returned are conv_id (the least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256. No conversations give no rows.
    """
    chunks = written(_chunks(placed), "chunks")
    first = conversations.select("conv_id").join(chunks.filter("no = 0").drop("no"), "conv_id", "left")
    empty = F.lit(b"")
    level = first.select(
        "conv_id", empty.alias("class"), F.lit(None).cast("long").alias("top"), F.coalesce("ids", empty).alias("key"),
        F.coalesce("words", F.array().cast("array<long>")).alias("words"), F.coalesce("ends", F.lit(True)).alias("ends"),
    )
    levels: list[tuple[DataFrame, DataFrame]] = []
    chains = []
    while True:
        level = written(level, "level")
        groups = written(
            level.groupBy("class", "key").agg(
                F.count("*").alias("n"), F.sum(F.col("ends").cast("long")).alias("n_end"), F.min("conv_id").alias("least"), F.first("words").alias("words"), F.first("top").alias("top"),
            ).withColumn("next", _next()),
            "groups",
        )
        levels.append((level, groups))
        on = groups.filter("n > n_end").select("next", F.col("least").alias("above"), (F.col("n") - F.col("n_end")).alias("on"))
        if on.isEmpty():
            break
        going = spread_join(level.filter("not ends").select("conv_id", _next().alias("next")), on, ["next"], "inner")
        going = written(going, "going")
        depth = len(levels)
        chains.append(going.filter("on = 1").select("conv_id", "above", F.lit(depth).cast("long").alias("from")))
        more = chunks.filter(F.col("no") == depth).drop("no").join(going.filter("on > 1"), "conv_id")
        level = more.select("conv_id", F.col("next").alias("class"), F.col("above").alias("top"), F.col("ids").alias("key"), "words", "ends")
    nodes, below = [], None
    for depth in range(len(levels) - 1, -1, -1):
        found, below = _trie(levels[depth][1], below)
        # The root of a class is a node of the level above.
        found = found.filter("depth > 0") if depth else found
        nodes.append(found.withColumn("depth", F.col("depth") + depth * CHUNK))
    return _with_ends(nodes, [level for level, _ in levels]).unionByName(_alone(chunks, chains))


def _next() -> Column:
    return F.unhex(F.sha2(F.concat("class", "key"), 256))


def _chunks(placed: DataFrame) -> DataFrame:
    """conv_id, no, ids, words of each chunk, and whether the conversation ends with it."""
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("turns"))
    turn = F.struct("place", "id", "words")
    chunks = placed.groupBy("conv_id", F.expr(f"place div {CHUNK}").alias("no")).agg(F.sort_array(F.collect_list(turn)).alias("turn"))
    chunks = chunks.select(
        "conv_id", "no", F.aggregate("turn", F.lit(b""), lambda ids, t: F.concat(ids, t["id"])).alias("ids"), F.transform("turn", lambda t: t["words"]).alias("words")
    )
    return chunks.join(sizes, "conv_id").select("conv_id", "no", "ids", "words", ((F.col("no") + 1) * CHUNK >= F.col("turns")).alias("ends"))


_NODES = pa.schema(
    [("class", pa.binary()), ("key", pa.binary())]
    + [(n, pa.int64()) for n in ("depth", "conv_id", "parent_conv_id")]
    + [("parent_key", pa.binary())]
    + [(n, pa.int64()) for n in ("n_convs", "n_end", "n_children", "n_leaves", "saved_tokens", "words", "top")]
    + [("spine", pa.bool_())]
)


class _Below:
    """What the strings below a place of the radix tree add up to."""

    __slots__ = ("n", "least", "words", "children", "leaves", "saved", "waiting")

    def __init__(self):
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.words = None, ()
        self.waiting: list[list] = []  # finished nodes that lack their parent

    def members(self, n: int, least: int, words) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)
        self.words = words if len(words) > len(self.words) else self.words


def _nodes_of(strings: list[tuple], spine: set[bytes], name: bytes, top: int | None) -> Iterator[list]:
    """Node rows of one class in one partition."""
    tree = RadixTree()
    for key, *value in strings:
        tree.insert(key, value)
    sums: dict[bytes, _Below] = {}
    for node, key, begin in climb(tree):
        here = sums.pop(key, None) or _Below()
        n_end = 0
        if node.value:
            n, n_end, least, words, children, leaves, saved = node.value
            here.members(n, least, words)
            here.children += children
            here.leaves += leaves
            here.saved += saved
        # Up the edge: each depth that ends a turn is a node; depth 0 belongs to the tree's root.
        at, stop = len(key) // WIDTH * WIDTH, -1 if node is tree.root else begin
        while at > stop:
            prefix, words = key[:at], here.words[at // WIDTH - 1] if at else 0
            ending = n_end if at == len(key) else 0
            if prefix in spine or not at:
                yield [name, prefix, at // WIDTH, here.least, None, None, here.n, ending, here.children, here.leaves, here.saved, words, top, True]
                for row in here.waiting:
                    row[5] = prefix
                    if not at and top is not None:
                        row[4], row[5] = top, None
                    yield row
                here.waiting, here.children, here.leaves, here.saved = [], 0, 0, 0
            else:
                here.leaves += not here.children
                here.saved += (here.n - 1) * words
                for row in here.waiting:
                    row[4] = here.least
                    yield row
                here.waiting = [[name, prefix if ending else None, at // WIDTH, here.least, None, None, here.n, ending, here.children, here.leaves, here.saved, None, None, False]]
                here.children = 1
            at -= WIDTH
        if node is not tree.root:
            above = sums.setdefault(key[:begin], _Below())
            above.members(here.n, here.least, here.words)
            above.children += here.children
            above.leaves += here.leaves
            above.saved += here.saved
            above.waiting += here.waiting


def _trie(groups: DataFrame, below: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The nodes of one level, and what each class adds up to."""
    alone = F.col("n") - F.col("n_end") == 1
    if below is None:
        rows = groups.withColumns({c: F.lit(None).cast("long") for c in ("n_children", "n_leaves", "saved_tokens")})
    else:
        rows = spread_join(groups, below.withColumnRenamed("class", "next"), ["next"], "left")
    values = [F.when(alone, alone_value).otherwise(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c, alone_value in (("n_children", 1), ("n_leaves", 1), ("saved_tokens", 0))]
    strings = rows.select("class", "key", "n", "n_end", "least", "words", *values, "top").repartitionByRange("class", "key").sortWithinPartitions("class", "key")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        name, top, is_first = None, None, True

        def flushed(is_last: bool) -> Iterator[pa.RecordBatch]:
            ends = ([held[0][0]] if is_first else []) + ([held[-1][0]] if is_last else [])
            spine = {key[:at] for key in ends for at in range(0, len(key) + 1, WIDTH)}
            out: list[list] = []
            for row in _nodes_of(held, spine, name, top):
                out.append(row)
                if len(out) == 10_000:
                    yield batch_of(_NODES, zip(*out, strict=True))
                    out = []
            if out:
                yield batch_of(_NODES, zip(*out, strict=True))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != name:
                    yield from flushed(False)
                    held, is_first = [], False
                name, top = row[0], row[-1]
                held.append(row[1:-1])
        if held:
            yield from flushed(True)

    found = written(strings.mapInArrow(build, from_arrow_schema(_NODES)), "nodes")
    spine = written(_spine(found.filter("spine")), "spine")
    inner = found.filter("not spine")
    parents = spine.select("class", F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    hanging = spread_join(inner.filter("parent_key is not null"), parents, ["class", "parent_key"], "inner")
    hanging = hanging.withColumn("parent_conv_id", F.col("_parent"))
    columns = ["class", "key", "depth", "conv_id", "parent_conv_id", "n_convs", "n_end", "n_children", "n_leaves", "saved_tokens"]
    classes = spine.filter("depth = 0").select("class", "n_children", "n_leaves", "saved_tokens")
    whole = spine.select(*columns).unionByName(hanging.select(*columns)).unionByName(inner.filter("parent_key is null").select(*columns))
    return whole, classes


def _spine(parts: DataFrame) -> DataFrame:
    """Nodes that several partitions have a part of, each once."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_end", "n_children", "n_leaves", "saved_tokens")]
    merged = parts.groupBy("class", "key").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("words").alias("words"), F.max("top").alias("top"), *sums)
    merged = written(merged.withColumn("up", F.expr(f"substring(key, 1, length(key) - {WIDTH})")), "merged")
    children = merged.filter("depth > 0").groupBy("class", F.col("up").alias("key")).agg(F.count("*").alias("_more"))
    merged = merged.join(children, ["class", "key"], "left").withColumn("n_children", F.col("n_children") + F.coalesce("_more", F.lit(0)))
    own = merged.select(
        "class", "key", "depth",
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("_saved"),
    )
    # What a node adds goes to all its prefixes, at most CHUNK of them.
    spread = own.select("class", F.expr(f"explode(transform(sequence(0L, depth), d -> substring(key, 1, int(d) * {WIDTH})))").alias("key"), "_leaves", "_saved")
    totals = spread.groupBy("class", "key").agg(F.sum("_leaves").alias("n_leaves"), F.sum("_saved").alias("saved_tokens"))
    parents = merged.select("class", F.col("key").alias("up"), F.col("conv_id").alias("_up"))
    rows = merged.drop("n_leaves", "saved_tokens").join(totals, ["class", "key"]).join(parents, ["class", "up"], "left")
    parent = F.when(F.col("depth") == 0, F.lit(None)).when((F.col("depth") == 1) & F.col("top").isNotNull(), F.col("top")).otherwise(F.col("_up"))
    return rows.withColumn("parent_conv_id", parent.cast("long")).drop("_more", "_up", "up")


_RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _with_ends(nodes: list[DataFrame], levels: list[DataFrame]) -> DataFrame:
    """Nodes with the digest of the conversations that end there."""
    both = nodes[0]
    for other in nodes[1:]:
        both = both.unionByName(other)
    ending = levels[0].filter("ends").select("class", "key", "conv_id")
    for level in levels[1:]:
        ending = ending.unionByName(level.filter("ends").select("class", "key", "conv_id"))
    digests = written(_ends(ending), "ends")
    none = both.filter("n_end = 0").withColumn("ends_sha256", F.lit(_EMPTY_SHA))
    some = both.filter("n_end > 0").join(digests, ["class", "key"])
    return none.select(*_RESULT).unionByName(some.select(*_RESULT))


def _ends(ending: DataFrame) -> DataFrame:
    """Per class and key the SHA-256 of its conversations' ids, ascending, joined by commas.

    A digest goes over its ids in order, so the ids become pieces of text where
    they are sorted, and only these pass through one task.
    """
    pieces = pa.schema([("class", pa.binary()), ("key", pa.binary()), ("least", pa.int64()), ("ids", pa.string())])
    digests = pa.schema([("class", pa.binary()), ("key", pa.binary()), ("ends_sha256", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        node = None
        for batch in batches:
            out = []
            for name, key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (node != (name, key) or len(held) == IDS_A_PIECE):
                    out.append((*node, held[0], ",".join(map(str, held))))
                    held = []
                node = (name, key)
                held.append(conv)
            if out:
                yield batch_of(pieces, zip(*out, strict=True))
        if held:
            yield batch_of(pieces, zip((*node, held[0], ",".join(map(str, held))), strict=True))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for name, key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node != (name, key):
                    if state:
                        out.append((*node, state.hexdigest()))
                    node, state = (name, key), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield batch_of(digests, zip(*out, strict=True))
        if state:
            yield batch_of(digests, zip((*node, state.hexdigest()), strict=True))

    order = ["class", "key", "conv_id"]
    texts = ending.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, "class binary, key binary, least long, ids string")
    return texts.repartition("class", "key").sortWithinPartitions("class", "key", "least").mapInArrow(fold, "class binary, key binary, ends_sha256 string")


def _alone(chunks: DataFrame, chains: list[DataFrame]) -> DataFrame:
    """Nodes of conversations that went on alone, from chunk ``from`` on."""
    if not chains:
        return chunks.limit(0).select(*[F.lit(None).cast("string" if c == "ends_sha256" else "long").alias(c) for c in _RESULT])
    starts = chains[0]
    for other in chains[1:]:
        starts = starts.unionByName(other)
    rows = spread_join(chunks.select("conv_id", "no", "ends", F.size("words").alias("size")), starts, ["conv_id"], "inner").filter("no >= from")
    rows = rows.select("*", F.explode(F.expr("sequence(1, size)")).alias("k"))
    last = F.col("ends") & (F.col("k") == F.col("size"))
    head = (F.col("no") == F.col("from")) & (F.col("k") == 1)
    return rows.select(
        "conv_id",
        (F.col("no") * CHUNK + F.col("k")).cast("long").alias("depth"),
        F.when(head, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(_EMPTY_SHA).alias("ends_sha256"),
    )
