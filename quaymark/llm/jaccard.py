"""Operator 7 — exact n-gram Jaccard join with a prefix tree.

1. Every text becomes its set of word shingles (64-bit hashes); equal sets form a class.  A class is
   known by a 64-bit fingerprint; a second one tells where two sets share the first, and stands in there.
2. Shingles are ordered: a fixed share of them, picked by hash, by document frequency (rare first),
   then the others by hash.  It is an order on shingles alone; the share is larger than a prefix, so
   passages that many documents have come last without counting every shingle.
3. Sets that are similar enough share one of their first n - ceil(t n) + 1 shingles.  Postings of the
   picked share are dealt out by shingle and streamed in order: shingles of one class go, the others
   learn their frequency.  Shingles with more than a four-thousandth of all postings are found in a
   sample (so there are at most some thousand); they count as the commonest and are dealt out by
   shingle and class.  A class keeps those of its postings that are in its prefix; classes whose
   prefix is theirs alone go.  Streams sorted by (shingle, size) then link neighbours whose sizes
   allow a link (common shingles: by one class for each range of sizes, without an exchange), which
   groups classes into families: two similar sets are always in one family.
4. Families are cut into chunks of bounded weight.  Within a chunk the ordered sets are stored in a
   path-compressed prefix tree; probes traverse it, share the overlap of common beginnings, and leave
   a subtree when what remains of both sets cannot reach the threshold, or when its members are
   already connected with the probe.
5. Chunks of one family are joined by representatives of what has been connected so far, in two rounds.
   What is left in doubt are prefix shingles of sets that are still apart: only the members that have
   one are compared across chunks, so a family of copies of one text costs as much as its members.
6. The links found span the components; the component is labelled with its least doc_id.

No pair of a group is written out, no group reaches one task whole, and nothing grows on the driver.
Within a pair, shingles are compared by their 64-bit hashes.

Defined cases: null and empty texts have 0 shingles and are their own components; repeated rows are
copies of each other; rows without doc_id link like others, and a component of them alone has a null
label; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import arrow_rows, batches, count_rows, doc_columns, map_arrow, prepare, release, stage, texts_of
from .components import components
from .shingles import class_of, fingerprints, shingle_sets

#: The share of shingles that is ordered by frequency: PICKED of 8 by hash.
PICKED = 3
#: Frequencies are counted exactly up to this number, which also bounds what a task holds back.
MOST = 1 << 16
#: Texts hashed together, and narrow rows in an Arrow batch of a stream.
TEXTS, ROWS = 256, 2048
#: Members and shingles of a chunk, on average.
CHUNK_MEMBERS, CHUNK_SHINGLES = 96, 60_000
#: One of SAMPLE classes shows common shingles: those with one of HOT sampled postings, and LEAST of them.
SAMPLE, HOT, LEAST = 64, 4096, 16
#: Parts that the postings of a common shingle are dealt to.
SALTS = 64
#: Rounds in which representatives join the chunks of a family.
ROUNDS = 2
#: Fingerprints that two sets share, at most: some few are expected in 10^10 sets.
COLLISIONS = 10_000
#: Classes up to which their ids are broadcast to pick texts; beyond, texts and ids are shuffled.
BROADCAST_CLASSES = 200_000


def needed(n: int, percent: int) -> int:
    """The least overlap that a set of n shingles has with any similar set."""
    return -(-percent * n // 100)


def measure(documents: DataFrame, words: int) -> DataFrame:
    """doc_id, n, cls and other (fingerprints of the set) of every document, and the picked shingles of sampled classes."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            sets = shingle_sets(texts_of(b.column("text")), words)
            marks = np.array([fingerprints(s) for s in sets], np.int64).reshape(-1, 2)
            some = [s[(s & np.uint64(7)) < PICKED].view(np.int64) if len(s) and m % SAMPLE == 0 else None for s, m in zip(sets, marks[:, 0].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(np.ascontiguousarray(marks[:, 0])), pa.array(np.ascontiguousarray(marks[:, 1])), pa.array(some, pa.list_(pa.int64()))],
                names=["doc_id", "n", "cls", "other", "sample"],
            )

    return map_arrow(doc_columns(documents, "doc_id", "text"), run, "doc_id long, n long, cls long, other long, sample array<bigint>")


def common_shingles(members: DataFrame) -> DataFrame | None:
    """The shingles (at most ``HOT``) that have a large share of the postings, if there are any."""
    sampled = members.where("sample is not null").select("cls", "sample").dropDuplicates(["cls"])
    counts = sampled.select(F.explode("sample").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    total = sampled.agg(F.sum(F.size("sample"))).first()[0] or 0
    found = [r["token"] for r in counts.where(F.col("n") >= max(LEAST, total // HOT)).select("token").collect()]
    return members.sparkSession.createDataFrame([(t,) for t in found], "token long").withColumn("hot", F.lit(True)) if found else None


def dealt_out(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Postings by token, common tokens (a bounded number) by token and class, each partition sorted by both."""
    if hot is None:
        return rows.repartition("token").sortWithinPartitions("token", "cls")
    known = rows.join(F.broadcast(hot), "token", "left")
    told = F.when(F.col("hot"), F.col("told") + 1).otherwise(F.col("told")).alias("told")
    # The salt follows from what a row says, so that it need not travel.
    salt = F.when(F.col("told") % 2 == 1, F.pmod("cls", F.lit(SALTS))).otherwise(F.lit(0))
    return known.select("token", "cls", told).repartition("token", salt).sortWithinPartitions("token", "cls")


def postings(documents: DataFrame, words: int, percent: int, collided: frozenset[int]) -> DataFrame:
    """token, cls and told for every picked shingle; told holds n and picked (how many of the class's shingles are picked).

    Where they do not fill a prefix, the first of the other shingles follow, with picked = -1.  One number for
    both, n << 32 | picked + 1 << 1, keeps the rows that are dealt out narrow; its last bit is for ``hot``.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            texts = texts_of(b.column("text"))
            for i in range(0, len(texts), TEXTS):
                tokens, told, sizes, classes = [], [], [], []
                for found in shingle_sets(texts[i : i + TEXTS], words):
                    n = len(found)
                    if not n:
                        continue
                    in_share = (found & np.uint64(7)) < PICKED
                    mine = found[in_share]
                    rest = found[~in_share][: max(0, n - needed(n, percent) + 1 - len(mine))]
                    tokens += (mine, rest)
                    told += (np.full(len(mine), n << 32 | (len(mine) + 1) << 1), np.full(len(rest), n << 32))
                    sizes.append(len(mine) + len(rest))
                    classes.append(class_of(found, collided))
                if sizes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(classes, np.int64), sizes)), pa.array(np.concatenate(told))], names=["token", "cls", "told"])

    return map_arrow(documents.select("text"), run, "token long, cls long, told long")


def frequencies(dealt: DataFrame) -> DataFrame:
    """The postings of tokens that several classes have, with df, the number of these classes (at most ``MOST``).

    ``dealt`` is partitioned by token and sorted by (token, cls); at most ``MOST`` rows are held back.
    Hot tokens are spread over partitions and have the largest df.
    """
    names = ["token", "cls", "n", "picked", "hot", "df"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 5), np.int64)
        long_token, last = None, None  # a token whose list is already being passed on, and the last row seen

        def out(rows: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
            hot = rows[:, 4] > 0
            df = np.where(hot, MOST, np.minimum(df, MOST))
            rows, hot, df = rows[df > 1], hot[df > 1], df[df > 1]
            return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), *(pa.array(rows[:, k].astype(np.int32)) for k in (2, 3)), pa.array(hot), pa.array(df.astype(np.int32))], names=names)

        for b in batches(parts):
            told = b.column("told").to_numpy()
            rows = np.stack([b.column("token").to_numpy(), b.column("cls").to_numpy(), told >> 32, (told >> 1 & 0x7FFFFFFF) - 1, told & 1], 1)
            new = np.r_[last is None or bool((rows[0, :2] != last).any()), (rows[1:, :2] != rows[:-1, :2]).any(1)]
            last = rows[-1, :2]
            rows = np.concatenate([held, rows[new]])
            if long_token is not None and len(rows):
                n = int(np.searchsorted(rows[:, 0] != long_token, True))
                if n:
                    yield out(rows[:n], np.full(n, MOST))
                    rows = rows[n:]
                if len(rows):
                    long_token = None
            if not len(rows):
                held = rows
                continue
            starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
            done, held = rows[: starts[-1]], rows[starts[-1] :]
            sizes = np.diff(starts)
            if len(done):
                yield out(done, np.repeat(sizes, sizes))
            if len(held) > MOST:
                yield out(held, np.full(len(held), MOST))
                long_token, held = int(held[0, 0]), held[:0]
        if len(held):
            yield out(held, np.full(len(held), len(held)))

    return map_arrow(dealt, run, "token long, cls long, n int, picked int, hot boolean, df int")


def in_prefix(shared: DataFrame, percent: int) -> DataFrame:
    """token, cls, n and hot of the shared postings that are in their class's prefix.

    Picked shingles of one class alone come first, then the shared ones by frequency.
    """
    by_class = W.partitionBy("cls")
    mine = F.sum(F.when(F.col("picked") >= 0, 1).otherwise(0)).over(by_class)
    place = F.row_number().over(by_class.orderBy(F.col("picked") < 0, "df", "token"))
    length = F.expr(f"n - (({percent} * cast(n as bigint) + 99) div 100) + 1")
    ranked = shared.withColumn("mine", mine).withColumn("place", place)
    return ranked.where((F.col("picked") < 0) | (F.col("place") + F.col("picked") - F.col("mine") <= length)).select("token", "cls", "n", "hot")


def neighbours(prefix: DataFrame, percent: int) -> DataFrame:
    """The prefix postings of tokens that several classes have, each with the class before it in the order of sizes.

    Sorted streams: one row is held back, whatever the length of a token's list.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)
        joined = False  # whether the held row has a predecessor, and which
        before = (0, 0)

        def out(rows: np.ndarray, previous: np.ndarray, has: np.ndarray, keep: np.ndarray) -> pa.RecordBatch:
            fits = has & (100 * previous[:, 1] >= percent * rows[:, 2])
            return pa.RecordBatch.from_arrays([pa.array(rows[keep, 0]), pa.array(rows[keep, 1]), pa.array(rows[keep, 2].astype(np.int32)), pa.array(previous[keep, 0], mask=~fits[keep])], names=["token", "cls", "n", "prev"])

        for b in batches(parts):
            rows = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("token", "cls", "n")], 1)
            rows = np.concatenate([held, rows])
            same = rows[1:, 0] == rows[:-1, 0]
            has = np.r_[joined, same]
            previous = np.concatenate([[before], rows[:-1, 1:]])
            keep = (has | np.r_[same, False])[:-1]
            yield out(rows[:-1], previous[:-1], has[:-1], keep)
            held, joined, before = rows[-1:], bool(has[-1]), tuple(previous[-1])
        if len(held) and joined:
            yield out(held, np.array([before]), np.array([True]), np.array([True]))

    dealt = prefix.where("not hot").select("token", "cls", "n").repartition("token").sortWithinPartitions("token", "n", "cls")
    return map_arrow(dealt, run, "token long, cls long, n int, prev long")


def hubs(prefix: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """For hot tokens, what ``neighbours`` gives, and the edges (u, v) between their ranges of sizes.

    Any two sizes of a range allow a link, and other links reach the next range at most.  Every class
    is joined with the least one of its token and range; these are summed up before anything moves.
    """
    ranged = prefix.where("hot").withColumn("range", F.floor(F.log("n") / float(np.log(100 / percent) * 0.999)))
    hub = ranged.groupBy("token", "range").agg(F.min("cls").alias("hub"))
    few = count_rows(hub, BROADCAST_CLASSES) <= BROADCAST_CLASSES
    rows = ranged.join(F.broadcast(hub) if few else hub, ["token", "range"])
    following = hub.select("token", (F.col("range") - 1).alias("range"), F.col("hub").alias("u"))
    edges = following.join(hub, ["token", "range"]).select("u", F.col("hub").alias("v"))
    return rows.select("token", "cls", "n", F.nullif("hub", "cls").alias("prev")), edges


class Tree:
    """A path-compressed prefix tree over ordered sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u8").tobytes())
        self.sets = [sets[k] for k in self.order]
        shared = [0]
        for a, b in zip(self.sets, self.sets[1:], strict=False):
            n = min(len(a), len(b))
            differs = np.flatnonzero(a[:n] != b[:n])
            shared.append(int(differs[0]) if len(differs) else n)
        self.shared = shared
        self.root = self._node(0, len(self.sets), 0)

    def _node(self, low: int, high: int, depth: int) -> tuple:
        """(label, depth at its end, low, high, least and largest set below, sets that end here, children)"""
        # Iterative: the depth of the tree is not bounded by the interpreter's stack.
        top: list = []
        todo = [(low, high, depth, top)]
        while todo:
            low, high, depth, to = todo.pop()
            common = min(self.shared[low + 1 : high], default=len(self.sets[low]))
            sizes = [len(s) for s in self.sets[low:high]]
            ends = low
            while ends < high and len(self.sets[ends]) == common:
                ends += 1
            children: list = []
            to.append((self.sets[low][depth:common], common, low, high, min(sizes), max(sizes), ends, children))
            start = ends
            for k in range(ends + 1, high + 1):
                if k == high or self.shared[k] == common:
                    if start < k:
                        todo.append((start, k, common, children))
                    start = k
        return top[0]

    def similar(self, probe: np.ndarray, percent: int, skip) -> Iterator[int]:
        """Places in the sorted order of the sets similar to ``probe``; ``skip(low, high)`` leaves out a range."""
        n = len(probe)
        todo = [(self.root, 0, 0)]
        while todo:
            (label, depth, low, high, least, largest, ends, children), overlap, used = todo.pop()
            if skip(low, high):
                continue
            if len(label):
                at = np.searchsorted(probe, label)
                at[at == n] = n - 1
                overlap += int(np.count_nonzero(probe[at] == label))
                used = int(np.searchsorted(probe, label[-1], side="right"))
            # The best size below is where the remainders meet; larger sets only add to the union.
            best = max(least, min(largest, n - used + depth))
            if (100 + percent) * (overlap + min(n - used, best - depth)) < percent * (n + best):
                continue
            for k in range(low, ends):
                if (100 + percent) * overlap >= percent * (n + depth):
                    yield k
            todo += [(c, overlap, used) for c in children]


def link(classes: list[int], sets: list[np.ndarray], left: list[int], right: list[int], percent: int, joined: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that span the components among probes ``left`` and stored ``right`` (equal lists: all with all).

    ``joined`` labels members that are connected already: no link is sought between equal labels.
    """
    if not left or not right or joined and len(set(joined)) == 1:
        return []
    tree = Tree([sets[k] for k in right])
    stored = [right[k] for k in tree.order]
    # Component of every member; members of the tree also by place.
    of = np.arange(len(sets)) if joined is None else np.unique(joined, return_inverse=True)[1]
    placed = of[stored].copy()
    out = []
    for probe in left:
        while True:
            mine = of[probe]
            found = next(tree.similar(sets[probe], percent, lambda low, high: bool((placed[low:high] == mine).all())), None)
            if found is None:
                break
            other = stored[found]
            if of[other] == mine:  # a range that is only partly connected: go on without this member
                found = next((k for k in tree.similar(sets[probe], percent, lambda low, high: bool((placed[low:high] == mine).all())) if placed[k] != mine), None)
                if found is None:
                    break
                other = stored[found]
            out.append((classes[probe], classes[other]))
            of[of == of[other]] = mine
            placed = of[stored]
    return out


def chunked(rows: DataFrame, turn: int) -> DataFrame:
    """``rows`` (root, cls, n, ...) with chunks and chunk: classes of a family are dealt to chunks of bounded weight by hash."""
    sizes = rows.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("weight"))
    chunks = F.greatest(F.ceil(F.col("members") / CHUNK_MEMBERS), F.ceil(F.col("weight") / CHUNK_SHINGLES))
    return rows.join(sizes, "root").withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("cls", F.lit(turn)), F.col("chunks"))).drop("members", "weight")


def within(placed: DataFrame) -> DataFrame:
    """The blocks of each chunk with itself."""
    return placed.select("root", F.col("chunk").alias("i"), F.col("chunk").alias("j"), "cls", "chunk", F.col("cls").alias("comp"))


def connected(spark: SparkSession, rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with comp, the least class that the links connect with each."""
    found = components(spark, links)
    return rows.join(found.toDF("cls", "least"), "cls", "left").withColumn("comp", F.coalesce("least", "cls")).drop("least")


def doubtful(spark: SparkSession, shared: DataFrame, joined: DataFrame) -> DataFrame | None:
    """The blocks (root, i, j, cls, chunk, comp) of different chunks whose members share a token although they are apart, if any."""
    held = stage(spark, shared.select("token", "cls").join(joined.select("root", "cls", "chunk", "comp"), "cls"), "held")
    mixed = held.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("token")
    n = count_rows(mixed, BROADCAST_CLASSES)
    if not n:
        return None
    left = held.join(F.broadcast(mixed) if n <= BROADCAST_CLASSES else mixed, "token", "left_semi")
    here = left.groupBy("token").agg(F.collect_set("chunk").alias("here"))
    partners = left.join(here, "token").groupBy("root", "cls", "chunk", "comp").agg(F.array_distinct(F.flatten(F.collect_set("here"))).alias("partners"))
    split = partners.select("root", "cls", "chunk", "comp", F.explode("partners").alias("p")).where("p <> chunk")
    return split.select("root", F.least("chunk", "p").alias("i"), F.greatest("chunk", "p").alias("j"), "cls", "chunk", "comp")


def class_sets(documents: DataFrame, wanted: DataFrame, words: int, collided: frozenset[int]) -> DataFrame:
    """cls and sorted tokens of the wanted classes (doc_id, cls), from the text of their least doc_id (repeated rows repeat them).

    Classes that only rows without doc_id have are read from those rows.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            sets = shingle_sets(texts_of(b.column("text")), words)
            mine = [class_of(s, collided) for s in sets]
            told = b.column("cls").to_pylist()
            right = [(c, s.view(np.int64)) for c, s, t in zip(mine, sets, told, strict=True) if len(s) and (t is None or t == c)]
            if right:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in right]), pa.array([s for _, s in right], pa.list_(pa.int64()))], names=["cls", "tokens"])

    schema = "cls long, tokens array<bigint>"
    named, nameless = wanted.where("doc_id is not null"), wanted.where("doc_id is null")
    few = count_rows(named, BROADCAST_CLASSES) <= BROADCAST_CLASSES
    out = map_arrow(documents.join(F.broadcast(named) if few else named, "doc_id").select("cls", "text"), run, schema)
    if not nameless.isEmpty():
        more = map_arrow(documents.where("doc_id is null").select(F.lit(None).cast("long").alias("cls"), "text"), run, schema)
        out = out.unionByName(more.join(nameless.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]))
    return out


def find_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Spanning links (u, v) within every block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        classes, joined = table.column("cls").to_pylist(), table.column("comp").to_pylist()
        tokens = table.column("tokens").combine_chunks()
        sets = [x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in tokens]
        i, j, chunk = table.column("i")[0].as_py(), table.column("j")[0].as_py(), table.column("chunk").to_pylist()
        left = [k for k, c in enumerate(chunk) if c == i]
        right = left if i == j else [k for k, c in enumerate(chunk) if c == j]
        found = np.array(link(classes, sets, left, right, percent, joined), np.int64).reshape(-1, 2)
        return pa.table({"u": found[:, 0], "v": found[:, 1]})

    # Members are a few numbers each; only the sets that they name move, and only to their blocks.
    few = count_rows(members, BROADCAST_CLASSES) <= BROADCAST_CLASSES
    return sets.join(F.broadcast(members) if few else members, "cls").groupBy("root", "i", "j").applyInArrow(run, "u long, v long")


def links_of(spark: SparkSession, shared: DataFrame, families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that span the components of all families."""
    placed = stage(spark, chunked(families, 0), "placed")
    links = stage(spark, find_links(within(placed), sets, percent), "links")
    large = placed.where("chunks > 1").drop("chunks")
    if large.isEmpty():
        return links
    for turn in range(1, ROUNDS + 1):
        joined = connected(spark, large, links)
        apart = stage(spark, chunked(joined.where("cls = comp").select("root", "cls", "n"), turn), "apart")
        more = stage(spark, find_links(within(apart), sets, percent), "links")
        if more.isEmpty():
            break
        links = links.union(more)
    joined = stage(spark, connected(spark, large, links), "joined")
    left = doubtful(spark, shared, joined)
    return links if left is None else links.union(stage(spark, find_links(stage(spark, left, "doubtful"), sets, percent), "links"))


def collided_classes(classes: DataFrame) -> frozenset[int]:
    """First fingerprints that several sets have."""
    found = classes.where("low <> high").select("cls").limit(COLLISIONS + 1).collect()
    if len(found) > COLLISIONS:
        raise RuntimeError("far more sets share a fingerprint than can be by chance")
    return frozenset(r["cls"] for r in found)


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    spark = prepare(documents.sparkSession)
    documents = doc_columns(documents, "doc_id", "text")
    members = stage(spark, measure(documents, words), "members")
    hot = common_shingles(members)

    def classes_of(rows: DataFrame) -> DataFrame:
        sums = F.min("doc_id").alias("doc_id"), F.min("other").alias("low"), F.max("other").alias("high")
        return stage(spark, rows.where("n > 0").groupBy("cls").agg(*sums), "classes")

    classes = classes_of(members)
    if collided := collided_classes(classes):
        members = members.withColumn("cls", F.when(F.col("cls").isin(*collided), F.col("other")).otherwise(F.col("cls")))
        classes = classes_of(members)
    with arrow_rows(spark, ROWS):
        counted = stage(spark, frequencies(dealt_out(postings(documents, words, percent, collided), hot)), "counted")
        prefix = stage(spark, in_prefix(counted, percent), "prefix")
        release(spark, counted)
        stars, between = hubs(prefix, percent) if hot is not None else (None, None)
        near = neighbours(prefix, percent)
        shared = stage(spark, near if stars is None else near.unionByName(stars), "shared")
        families = stage(spark, _families(spark, shared, between), "families")
    wanted = stage(spark, families.select("cls").join(classes.select("cls", "doc_id"), "cls"), "wanted")
    sets = stage(spark, class_sets(documents, wanted, words, collided), "sets")
    links = links_of(spark, shared, families, sets, percent)
    joined = components(spark, links).withColumnRenamed("node", "cls")
    for x in (prefix, shared, families, wanted, sets):
        release(spark, x)
    labels = classes.join(joined, "cls", "left").select("cls", "doc_id", F.coalesce("root", "cls").alias("root"))
    least = labels.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = labels.join(least, "root").select("cls", "component_id")
    found = members.join(labels, "cls", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _families(spark: SparkSession, shared: DataFrame, between: DataFrame | None) -> DataFrame:
    """cls, n and root (the family) of every class with a shared token and a neighbour."""
    edges = shared.where("prev is not null").select(F.col("cls").alias("u"), F.col("prev").alias("v"))
    found = components(spark, edges if between is None else edges.union(between))
    roots = found.union(found.select("root", "root")).distinct().toDF("cls", "root")
    sizes = shared.select("cls", "n").distinct()
    return roots.join(sizes, "cls").select("cls", "n", "root")
