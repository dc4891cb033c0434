"""Near-duplicate documents by Order MinHash and banded alignment.

Every text gives ``SKETCHES`` sketches: of its runs of ``RUN`` words, labelled by
how often each occurred before, the two of least hash, in the order in which the
text has them. Sketches are taken in one pass that also hashes the text, so texts
stay where they are; exact copies then collapse, and only texts that share a
sketch with another are read again for alignment. Texts that share a sketch fall
into one bucket, and every link between two texts of a bucket is found, by itself or as a chain of links. First all texts of a bucket
are held against one of them, its hub. Buckets whose texts are in one class by
then, as those of near copies are, need no more pairs. Of the others, buckets of
``FEW`` texts or less are paired in full. Texts of larger ones are paired by an
index that loses no link: texts linked to each other have four fifths of their
words in common, so they share one of the rarest fifth of each (``rarest_words``),
and only texts of different classes that do so are held against each other. A
passage that many unlike texts share is not among the rarest fifth of a text,
unless about four fifths of the text are that passage. A link is an edit
similarity of the words (1 - distance / longer length) of ``SIMILARITY`` or more,
found by aligning inside the band that this allows. Classes are the connected
parts of the links.

Two texts whose runs have similarity J share one sketch with probability about
J**2. Edits scattered over a text break most runs: with a share e of the words
replaced, J is about q / (2 - q), q = (1 - e)**RUN. At e = 0.2, the least that
links, J is 0.34 for runs of three words and a link is missed with 0.02 (0.1 in
five-word runs, where it would be missed with 0.6); at five-word shingle
similarity 0.8 a miss is below 1e-14.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.llm.common import batch_of, weighed, written
from stallkeep.llm.words import Words, mixed, shingles
from stallkeep.operators.joins import spread_join

RUN = 3
SKETCHES = 32
SIMILARITY = 0.8
SAMPLE_TEXTS = 20_000  # that tell which words are frequent
FREQUENT = 1 << 17  # words that are ordered by how frequent they are
FEW = 8  # texts of a bucket that is paired in full
BEFORE = 16  # shared words that tell whether two texts have met before; what they miss is met twice
FAR, NEAR, LINKED = 0, 1, 2
FOLDS = 1024  # classes of words in a quick bound, a power of two

_U = np.uint64
_SEEDS = np.random.default_rng(24).integers(1, 1 << 63, SKETCHES, dtype=_U) | _U(1)


def order_minhash(words: np.ndarray) -> np.ndarray:
    """The sketches of a text given by its word hashes; none without words."""
    runs = shingles(words, RUN)
    if not len(runs):
        return runs
    labelled = _labelled(runs)
    values = labelled[None, :] * _SEEDS[:, None]
    values ^= values >> _U(32)
    values *= _U(0xD6E8FEB86659FD93)
    rows = np.arange(SKETCHES)
    one = values.argmin(1)
    values[rows, one] = _U(0xFFFFFFFFFFFFFFFF)
    two = values.argmin(1)
    before, after = np.minimum(one, two), np.maximum(one, two)
    return mixed(labelled[before] * _U(3) + mixed(labelled[after]) + _SEEDS)


def _labelled(runs: np.ndarray) -> np.ndarray:
    """Hashes of the runs, each with how often it occurred before."""
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    label = np.empty(len(runs), _U)
    label[order] = np.arange(len(runs)) - np.repeat(first, np.diff(np.append(first, len(runs))))
    return mixed(runs + label * _U(0x9E3779B97F4A7C15))


def rarest_pairs(words: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rarest of a text's pairs of neighbouring words, so many that any two linked texts share one.

    ``frequent``: hashes of frequent pairs, ascending, and the place of each (from
    1) from the least frequent on. What it holds decides how few texts share a
    pair; that linked texts share one holds under any order. An edit breaks at most two pairs, so of a text of m
    words at least m - 1 - 2 * distance are in the other text too; by the least
    that this can be, two linked texts share a pair among the first of both.
    """
    pairs = word_pairs(words)
    if not len(pairs):
        return pairs
    # Five words more are three common pairs more.
    common = max(1, min(m - 1 - 2 * int((1 - SIMILARITY) * m + 1e-9) for m in range(len(words), len(words) + 5)))
    return _rarest(pairs, frequent, len(pairs) - common + 1)


def rarest_words(words: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rarest of a text's words, rarest first, so many that any two linked texts share one.

    ``frequent`` as for ``rarest_pairs``, of words. An edit takes at most one word,
    so linked texts have all words of the longer one in common but for the
    distance that links them. The first word in common stands so far ahead in both
    that the others find room behind it.
    """
    return _rarest(labelled_words(words), frequent, int((1 - SIMILARITY) * len(words) + 1e-9) + 1)


def _rarest(found: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], count: int) -> np.ndarray:
    by_hash, place = frequent
    rank = np.zeros(len(found), np.int64)
    if len(by_hash):
        at = np.minimum(np.searchsorted(by_hash, found), len(by_hash) - 1)
        rank = np.where(by_hash[at] == found, place[at], 0)
    return found[np.lexsort((found, rank))[:count]]


def labelled_words(words: np.ndarray) -> np.ndarray:
    """Hashes of all words, each with how often it occurred before."""
    return _labelled(words.astype(_U)) if len(words) else words.astype(_U)


def word_pairs(words: np.ndarray) -> np.ndarray:
    """Hashes of all pairs of neighbouring words, each with how often it occurred before; a single word is one."""
    runs = shingles(words.astype(_U), 2)
    return _labelled(runs) if len(runs) else runs


def edit_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """1 - edit distance / longer length if that reaches ``least``, else some value below it.

    Two empty texts are alike (1.0). The distance is exact: words common at the
    ends are cut, texts whose words in common are too few are refused, and the
    rest is aligned within the band of diagonals that the bound leaves.
    """
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    most = int((1 - least) * longer + 1e-9)
    if abs(len(a) - len(b)) > most:
        return 0.0
    distance = _banded(a, b, most)
    return 1 - distance / longer if distance <= most else 0.0


def linked(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the edit similarity reaches ``least``.

    An alignment through the words that occur once in both texts, in the order
    that keeps most of them, bounds the distance from above; only where that
    does not settle it, the band is aligned in full.
    """
    longer = max(len(a), len(b))
    most = int((1 - least) * longer + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    (va, ia, na), (vb, ib, nb) = (np.unique(x, return_index=True, return_counts=True) for x in (a, b))
    _, at_a, at_b = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    if longer - np.minimum(na[at_a], nb[at_b]).sum() > most:
        return False
    once = (na[at_a] == 1) & (nb[at_b] == 1)
    pa_, pb = ia[at_a[once]], ib[at_b[once]]
    order = np.argsort(pa_)
    chain = _increasing(pb[order])
    i = np.concatenate(([-1], pa_[order][chain], [len(a)]))
    j = np.concatenate(([-1], pb[order][chain], [len(b)]))
    # Between two anchors as far apart in both texts words are compared in place.
    gap_a, gap_b = np.diff(i) - 1, np.diff(j) - 1
    even = gap_a == gap_b
    size = gap_a[even]
    at = np.repeat(i[:-1][even] + 1 - np.cumsum(size) + size, size) + np.arange(size.sum())
    changed = (a[at] != b[at + np.repeat((j - i)[:-1][even], size)]).sum()
    if changed + np.maximum(gap_a, gap_b)[~even].sum() <= most:
        return True
    return edit_similarity(a, b, least) >= least


def relation(hub: np.ndarray, text: np.ndarray) -> int:
    """LINKED, FAR if no text can be linked to both, else NEAR.

    Edit distance is a metric, and words not in common bound it from below.
    """
    if linked(hub, text):
        return LINKED
    (va, na), (vb, nb) = (np.unique(x, return_counts=True) for x in (hub, text))
    _, at_a, at_b = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    apart = max(len(hub), len(text)) - np.minimum(na[at_a], nb[at_b]).sum()
    return NEAR if apart <= _reach(len(hub), len(text)) + 1e-6 else FAR


def _folded(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The words of a text and how many fall into each of FOLDS classes of words."""
    words = np.frombuffer(raw, "<u4")
    return words, np.bincount(words & np.uint32(FOLDS - 1), minlength=FOLDS).astype(np.int32)


def _quick_relation(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> int:
    """``relation``, where classes of words do not already tell that the texts are FAR.

    Texts have at least as much in common by classes as by words, so what they
    are apart by classes bounds what they are apart by words from below.
    """
    (a, x), (b, y) = one, other
    apart = max(len(a), len(b)) - int(np.minimum(x, y).sum())
    return FAR if apart > _reach(len(a), len(b)) + 1e-6 else relation(a, b)


def _quick_linked(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> bool:
    """``linked``, where classes of words do not already tell that the texts are too far apart."""
    (a, x), (b, y) = one, other
    longer = max(len(a), len(b))
    return longer - int(np.minimum(x, y).sum()) <= int((1 - SIMILARITY) * longer + 1e-9) and linked(a, b)


def _reach(one: int, other: int) -> float:
    """How far apart two texts of these lengths may be if a third is linked to both."""
    most = min(one, other) / SIMILARITY  # the longest such text
    return (1 - SIMILARITY) * (max(most, one) + max(most, other))


def _increasing(values: np.ndarray) -> np.ndarray:
    """Positions of a longest increasing part."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, v in enumerate(values.tolist()):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            at.append(n)
        else:
            tops[k], at[k] = v, n
        back.append(at[k - 1] if k else -1)
    chain, n = [], at[-1] if at else -1
    while n >= 0:
        chain.append(n)
        n = back[n]
    return np.array(chain[::-1], dtype=np.int64)


def _banded(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance if at most ``most``, else more than that."""
    short = min(len(a), len(b))
    head = np.flatnonzero(a[:short] != b[:short])
    if not len(head):
        return abs(len(a) - len(b))
    a, b, short = a[head[0] :], b[head[0] :], short - head[0]
    tail = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    cut = tail[0] if len(tail) else short
    a, b = a[: len(a) - cut], b[: len(b) - cut]
    if not len(a) or not len(b):
        return len(a) + len(b)
    values, codes = np.unique(np.concatenate((a, b)), return_inverse=True)
    common = np.minimum(np.bincount(codes[: len(a)], minlength=len(values)), np.bincount(codes[len(a) :], minlength=len(values))).sum()
    if max(len(a), len(b)) - common > most:
        return most + 1
    one, other = codes[: len(a)].tolist(), codes[len(a) :].tolist()
    return _band(one, other, most) if len(a) >= len(b) else _band(other, one, most)


def _band(a: list[int], b: list[int], most: int) -> int:
    """``_banded`` of a and no longer b by a band of diagonals whose differences are the bits of a number.

    Hyyro's form of the bit-parallel alignment: a column's rows, ``most`` to each
    side of the diagonal, take one step together. The distance is followed down
    the lowest diagonal of the band, where it never falls, then along the last row.
    """
    most, least = min(most, len(a)), most
    if len(a) - len(b) > most:
        return least + 1
    full = (1 << (2 * most + 1)) - 1
    rows: dict[int, int] = {}
    bit = 1 << most  # rows stand shifted by the band's upper half
    for word in a:
        rows[word] = rows.get(word, 0) | bit
        bit <<= 1
    up, down, distance = full ^ ((1 << most) - 1), 0, most
    turn, last = len(a) - most, 1 << (2 * most)
    for column, word in enumerate(b):
        same = (rows.get(word, 0) >> column) & full
        level = (((same & up) + up) ^ up) | same | down
        right_up, right_down = down | (full & ~(level | up)), level & up
        if column < turn:
            distance += not level & last
        else:
            last >>= 1
            distance += bool(right_up & last) - bool(right_down & last)
        # Along the last row each column takes back one at most.
        if distance > least + len(b) - max(turn, column + 1):
            return least + 1
        level = (level & full) >> 1
        up, down = right_down | (full & ~(level | right_up)), level & right_up
    return distance if distance <= least else least + 1


TEXT = "struct<node:long,part:int,words:int>"  # names a text: its doc_id, which of that one's texts, its length in words


def _signed(documents: DataFrame) -> DataFrame:
    """doc_id, md5 of the text and sketches of every row; the texts stay behind."""
    fields = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("words", pa.int32()), ("buckets", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Words()
        for batch in weighed(batches, 2, 2_000_000):
            words = reader.hashes(batch.column(2).to_pylist())
            buckets = [order_minhash(w).view(np.int64) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(w) for w in words], pa.int32()), pa.array(buckets, fields.types[3])], schema=fields)

    return _texts(documents).mapInArrow(run, "doc_id long, key binary, words int, buckets array<long>")


def _texts(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id").cast("long"), _key(text).alias("key"), text.alias("text"))


def _words(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """text and the words, in little-endian 32-bit hashes, of the wanted (doc_id, key, text)."""
    held = spread_join(_texts(documents), wanted.withColumnRenamed("text", "name"), ["doc_id", "key"], "inner")
    named = held.select(F.col("name").alias("text"), F.col("text").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Words()
        for batch in weighed(batches, 1, 2_000_000):
            found = [(w >> _U(32)).astype("<u4").tobytes() for w in reader.hashes(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["text", "words"])

    # Rows of a document may be repeated in full.
    return named.mapInArrow(run, f"text {TEXT}, words binary").dropDuplicates(["text"])


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The nodes (a, b) of those (a, b) pairs of texts that are linked."""
    one, other = F.col("a.words"), F.col("b.words")
    # Lengths alone tell that some are not.
    pairs = pairs.filter(F.abs(one - other) <= (1 - SIMILARITY) * F.greatest(one, other) + 1e-6)
    # Pairs are few bytes and much work, so they are dealt out by number, not by size.
    pairs = pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    held = spread_join(pairs, texts.toDF("a", "words_a"), ["a"], "inner")
    held = spread_join(held, texts.toDF("b", "words_b"), ["b"], "inner", hot_from=pairs)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(maxsize=500)(_folded)
        for batch in batches:
            words = (batch.column(c).to_pylist() for c in ("words_a", "words_b"))
            found = pa.array([_quick_linked(known(x), known(y)) for x, y in zip(*words, strict=True)], pa.bool_())
            nodes = [pc.struct_field(batch.column(c), "node") for c in "ab"]
            yield pa.RecordBatch.from_arrays(nodes, names=["a", "b"]).filter(found)

    return written(held.mapInArrow(verify, "a long, b long"), "links")


def _ordered(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _roots(documents: DataFrame, sketched: DataFrame, known: DataFrame) -> DataFrame:
    """node and root of the nodes that have a link, ``known`` links (a, b) among them.

    sketched: text, key and buckets, one row for each different text of a node.
    """
    # Most sketches are one text's own; they are told by their hashes alone.
    rows = sketched.select("text", F.explode("buckets").alias("bucket"))
    shared = rows.select("bucket").groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    shared = written(shared, "shared")
    members = written(spread_join(rows, shared, ["bucket"], "inner").select("bucket", "text"), "members")
    involved = members.select("text").distinct()
    wanted = written(sketched.select("text", "key").join(involved, "text").select(F.col("text.node").alias("doc_id"), "key", "text"), "wanted")
    texts = written(_words(documents, wanted), "words")
    # Of buckets with the same texts one stays. A text is a hub in all its buckets alike, so that near copies meet few hubs.
    chance = F.xxhash64("text", F.lit(1))
    marks = [F.bit_xor(F.xxhash64("text", F.lit(k))).alias(f"m{k}") for k in (0, 1)]
    stats = members.groupBy("bucket").agg(F.count("*").alias("n"), *marks, F.min(F.struct(chance.alias("h"), "text")).alias("least"))
    stats = stats.groupBy("n", "m0", "m1").agg(F.min(F.struct("bucket", F.col("least.text").alias("hub"))).alias("x"))
    members = written(members.join(stats.select("x.*"), "bucket"), "members")
    pairs = members.filter("text != hub").select(*_ordered("hub", "text")).distinct()
    links = known.select("a", "b").unionByName(_linked(written(pairs, "candidates"), texts))
    roots = connected(links.distinct())
    # Texts of buckets that are not in one class yet.
    of_text = members.select("bucket", "text", F.col("text.node").alias("node")).join(roots, "node", "left").select("bucket", "text", F.coalesce("root", "node").alias("root"))
    of_text = written(of_text, "rooted")
    mixed_buckets = of_text.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("one"), F.max("root").alias("other")).filter("one != other").select("bucket", "n")
    unsettled = written(of_text.join(mixed_buckets, "bucket"), "unsettled")
    if unsettled.isEmpty():
        return roots
    more = _linked(written(_paired(unsettled, texts), "candidates"), texts)
    return connected(roots.toDF("a", "b").unionByName(more))


def _paired(unsettled: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts of one bucket and different roots, among them all that are linked.

    unsettled: bucket, text, root and n, the texts of the bucket.
    """
    words = [F.col(f"text_{k}.words") for k in "ab"]
    longer = F.greatest(*words)
    most = F.floor((1 - SIMILARITY) * longer + 1e-9)
    differ = F.expr("text_a < text_b and root_a != root_b")
    pair = [F.col("text_a").alias("a"), F.col("text_b").alias("b")]
    one, other = (unsettled.filter(F.col("n") <= FEW).select("bucket", *[F.col(c).alias(f"{c}_{k}") for c in ("text", "root")]) for k in "ab")
    near = one.join(other, (one["bucket"] == other["bucket"]) & differ & (F.abs(words[0] - words[1]) <= most)).select(*pair)
    large = written(unsettled.filter(F.col("n") > FEW).groupBy("text", "root").agg(F.collect_set("bucket").alias("buckets")), "large-buckets")
    if large.isEmpty():
        return near.distinct()
    held = written(texts.join(large.select("text", "root"), "text"), "unsettled-words")
    frequent = held.sparkSession.sparkContext.broadcast(_frequent_words(held))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, 1, 2_000_000):
            found = [rarest_words(np.frombuffer(w.as_buffer(), "<u4"), frequent.value) for w in batch.column("words")]
            sizes = [len(x) for x in found]
            columns = [batch.column(c).take(pa.array(np.repeat(np.arange(len(found)), sizes))) for c in ("text", "root")]
            for part in (np.concatenate([np.zeros(0, _U), *found]).view(np.int64), np.concatenate([np.zeros(0, np.int32), *(np.arange(n, dtype=np.int32) for n in sizes)])):
                columns.append(pa.array(part))
            yield pa.RecordBatch.from_arrays(columns, names=["text", "root", "word", "place"])

    posted = written(held.select("text", "words", "root").mapInArrow(post, f"text {TEXT}, root long, word long, place int"), "postings")
    # Most of these words are one class's own.
    shared = posted.groupBy("word").agg(F.min("root").alias("one"), F.max("root").alias("other")).filter("one != other").select("word")
    some = spread_join(posted, written(shared, "shared-words"), ["word"], "inner")
    some = some.groupBy("text", "root").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
    some = some.join(large.select("text", "buckets"), "text").select("text", "root", "buckets", F.col("words.word").alias("words"), F.posexplode("words").alias("at", "x"))
    before = F.slice("words", F.greatest(F.col("at") - BEFORE, F.lit(0)) + 1, F.least("at", F.lit(BEFORE)))
    some = written(some.select("text", "root", "buckets", "x.word", "x.place", before.alias("before")), "shared-postings")
    one, other = (some.select("word", *[F.col(c).alias(f"{c}_{k}") for c in ("text", "root", "buckets", "place", "before")]) for k in "ab")
    # Behind the first word in common both texts have room for the others; later ones in common are told by those before.
    room = [F.col(f"place_{k}") <= w - longer + most for k, w in zip("ab", words, strict=True)]
    first = differ & room[0] & room[1] & ~F.arrays_overlap("before_a", "before_b") & F.arrays_overlap("buckets_a", "buckets_b")
    met = one.join(other, (one["word"] == other["word"]) & first).select(*pair)
    return near.unionByName(met).distinct()


def _frequent_words(held: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words in about SAMPLE_TEXTS texts, as ``rarest_words`` takes them."""
    share = min(1.0, SAMPLE_TEXTS / max(1, held.count()))
    chance = F.pmod(F.xxhash64("text", F.lit(2)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = held.filter(chance < share).select("words")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, 0, 4_000_000):
            found = [labelled_words(np.frombuffer(w.as_buffer(), "<u4")) for w in batch.column(0)]
            words, times = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times)], names=["word", "times"])

    counted = sample.mapInArrow(count, "word long, times long").groupBy("word").agg(F.sum("times").alias("times")).filter("times > 1")
    top = counted.orderBy(F.desc("times"), "word").limit(FREQUENT).toArrow()
    words = top.column("word").to_numpy().view(_U)
    order = np.argsort(words)
    return words[order], (len(words) - np.arange(len(words)))[order]


def connected(links: DataFrame) -> DataFrame:
    """node and least node of its connected part, for every node that has a link.

    Each round hooks every node and its neighbours to the least of them (large
    star, then small star) and stops when no edge changes; a round's edges are a
    written table. Stars of any size are combined before they are shuffled.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    if edges.isEmpty():
        return edges.toDF("node", "root")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.*").filter("u != v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id and class_id, one row per row of documents.

    Columns doc_id and text are read, others ignored. class_id is the least
    doc_id of the class. A null text counts as empty; empty texts, and texts
    without any word, are alike only if equal. Rows of a repeated doc_id are one
    document. A null doc_id gets the class of its text's other rows, null if
    there are none. No rows give no rows.
    """
    keyed, classes = _classes(documents)
    return keyed.join(classes, "key").select("doc_id", "class_id")


def first_of_each(documents: DataFrame) -> DataFrame:
    """One row of documents for every class of near-duplicates: that of the least doc_id.

    All columns stay, whatever their names. Of rows alike in doc_id and text one
    stays, of one doc_id with several texts the text of least md5. Rows without a
    doc_id stay once per text that no row with a doc_id is like.
    """
    keyed, classes = _classes(documents)
    heads = keyed.groupBy("doc_id", "key").agg(F.count("*").alias("copies")).join(classes, "key").filter("doc_id <=> class_id")
    alone = F.when(F.col("class_id").isNull(), F.col("key"))
    heads = heads.groupBy(alone.alias("alone"), "class_id").agg(F.min(F.struct("key", "copies")).alias("head"))
    # A column without nulls, so that rows without a doc_id meet their head too.
    heads = written(heads.select(_id(F.col("class_id")).alias("id"), "head.key", "head.copies"), "heads")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    rows = rows.select(_id(F.col("row.doc_id").cast("long")).alias("id"), _key(F.col("row.text").cast("string")).alias("key"), "row")
    single = spread_join(rows, heads.filter("copies = 1"), ["id", "key"], "inner").select("row")
    # Only rows that repeat a document in full are moved to choose one.
    again = spread_join(rows, heads.filter("copies > 1"), ["id", "key"], "inner")
    first = again.groupBy("id", "key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return single.unionByName(first.select("row")).select(*[F.col(f"row.`{c}`") for c in documents.columns])


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def _key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _classes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key) of every row, and the class of every key: a key stands for one text."""
    signed = written(_signed(documents), "signed")
    keyed = signed.select("doc_id", "key")
    first = written(keyed.groupBy("key").agg(F.min("doc_id").alias("node")), "texts")
    # The row with its least doc_id stands for a text.
    part = F.row_number().over(Window.partitionBy("doc_id").orderBy("key"))
    least = first.filter("node is not null").select("key", F.col("node").alias("doc_id")).withColumn("part", part)
    sketched = signed.join(least, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"])
    name = F.struct(F.col("doc_id").alias("node"), "part", "words").cast(TEXT)
    sketched = written(sketched.select(name.alias("text"), "key", "buckets"), "sketches")
    # Rows of one doc_id with different texts are one document.
    again = keyed.join(first, "key").filter("doc_id != node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    heads = first.filter("node is not null").select("node").distinct()
    clash = again.join(heads, again["a"] == heads["node"], "left_semi")
    roots = _roots(documents, sketched, clash)
    return keyed, first.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("class_id"))
