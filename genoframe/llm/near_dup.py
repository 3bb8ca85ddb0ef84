"""MinHash near-duplicate components with tensored banding.

A set gets ``left * width_left + right * width_right`` minhashes, banded into
two small collections of ``left`` and ``right`` sub-keys.  Table (i, j) is
keyed by sub-key i of the first collection with sub-key j of the second, so
``left * right`` tables cost only about twice the square root of the minhashes
that independent tables would.  Two sets of similarity s meet unless one
collection has no match at all: with the defaults a pair at exactly 0.8 is
missed with a probability of about 0.0001.

Texts of equal word sequences, by their SHA-256, are folded into one set
before any table is built, and a set is named by a number that no other has.
The tables rest on fixed hashes of words, so that a call finds the same
candidates again; sizes of sets, and what is compared, rest on hashes that are
keyed anew for each call, so that nobody can prepare unequal words that
collide.  Tables are sorted
by range over (key, set), so that one hot key spreads over many tasks, and are
read as a stream: a bucket is never held in memory.  Each set is first
compared with the centres of its buckets, which settles the groups of near
copies.  Then the sets of every component that still meets
another one in a bucket are joined exactly: tokens are ordered from rare to
common by a sketch of their frequencies, and two sets can only be linked if a
token near the front of one stands near the front of the other.  What all
members of a hot bucket share is common and so stands at the back, and the
members are not paired with one another.  All links are confirmed on the full
shingle sets of whole texts, by their words.
"""

from __future__ import annotations

import hashlib
import secrets
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .graph import connected_components
from .text import SPACED_LOWER, U, Words, as_long, chunks, keyed, lean, mix, shingle_sets
from .work import Work, join_checked


@dataclass(frozen=True)
class Tensored:
    """Sizes of the two collections of sub-keys, and the minhashes in a sub-key of each."""

    left: int = 15
    width_left: int = 3
    right: int = 9
    width_right: int = 2

    @property
    def hashes(self) -> int:
        return self.left * self.width_left + self.right * self.width_right


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7919)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) | U(1), rng.integers(1, 1 << 63, n, dtype=np.uint64)


def sequence_digests(words: Words) -> list[bytes | None]:
    """SHA-256 of the lower-cased words of each text, one space between them; None without words."""
    counts = words.counts
    size = words.end - words.start + 1
    at = np.concatenate([[0], np.cumsum(size)])
    source = np.repeat(words.start - at[:-1], size) + np.arange(at[-1])
    joined = SPACED_LOWER[1][words.data[np.minimum(source, max(len(words.data) - 1, 0))]] if len(source) else np.zeros(0, np.uint8)
    joined[at[1:] - 1] = 0x20
    body, edges = memoryview(joined.tobytes()), at[words.offset].tolist()
    return [hashlib.sha256(body[a:b]).digest() if n else None for a, b, n in zip(edges[:-1], edges[1:], counts.tolist(), strict=True)]


def sub_keys(sets: list[np.ndarray], shape: Tensored) -> tuple[np.ndarray, np.ndarray]:
    """Sub-keys (sets x left) and (sets x right) of non-empty sets."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    mul, add = _seeds(shape.hashes)
    low = np.empty((shape.hashes, len(sets)), U)
    for m in range(shape.hashes):
        v = (flat ^ add[m]) * mul[m]
        v ^= v >> U(31)
        v *= U(0x9FB21C651E98DF25)
        low[m] = np.minimum.reduceat(v, at)

    def banded(rows: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((rows.shape[0] // width, rows.shape[1]), U)
        for w in range(width):
            out = mix(out * U(31) + rows[w::width])
        return out.T

    cut = shape.left * shape.width_left
    return banded(low[:cut], shape.width_left), banded(low[cut:], shape.width_right)


def _features(k: int, shape: Tensored, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = keyed(SPACED_LOWER, seed)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                words = Words(data, offsets, SPACED_LOWER)
                sets = shingle_sets(words, k)
                sizes = [len(s) for s in shingle_sets(Words(data, offsets, kind), k)]
                some = [i for i, s in enumerate(sets) if len(s)]
                left, right = np.zeros((0, shape.left), U), np.zeros((0, shape.right), U)
                if some:
                    left, right = sub_keys([sets[i] for i in some], shape)
                empty = np.array([not len(s) for s in sets])

                def nested(rows: np.ndarray, width: int) -> pa.Array:
                    ends = np.concatenate([[0], np.cumsum(np.where(empty, 0, width))]).astype(np.int32)
                    return pa.ListArray.from_arrays(ends, as_long(rows.reshape(-1)))

                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.array(sizes, np.int64)), pa.array(sequence_digests(words), pa.binary()), nested(left, shape.left), nested(right, shape.right)],
                    names=["doc_id", "n", "digest", "g", "h"],
                )

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, sid): those of keys with two rows or more, with their first row as centre.

    The first and last key of a partition may go on in its neighbours; their rows are kept with ``edge`` true.
    """
    key = center = None  # of the run that is open
    lone = False  # its only row was not given out yet
    first = True  # it is the partition's first

    def made(k, s, c, edge) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(s), pa.array(c), pa.array(edge)], names=["key", "sid", "center", "edge"])

    for batch in batches:
        k, s = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        if not len(k):
            continue
        if key is not None:  # the open run goes first, as a row of this batch
            k, s = np.concatenate([[key], k]), np.concatenate([[center], s])
        heads = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        size = np.diff(np.concatenate([heads, [len(k)]]))
        run = np.repeat(np.arange(len(heads)), size)
        edge = (run == 0) & first
        give = (size[run] > 1) | (edge & (len(heads) > 1))
        if key is not None and not lone:
            give[0] = False  # given out before
        c = s[heads[run]]
        if give.any():
            yield made(k[give], s[give], c[give], edge[give])
        key, center = k[heads[-1]], s[heads[-1]]
        lone = size[-1] == 1 if len(heads) > 1 else lone and size[-1] == 1 or (first and len(k) == 1)
        first = first and len(heads) == 1
    if key is not None:  # the last run may go on in the next partition
        yield made(np.array([key]), np.array([center]), np.array([center]), np.array([True]))


def _sorted_tokens(s: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The tokens of a set from rare to common by the sketch ``counts``, then by hash: one order for all sets."""
    return s[np.lexsort((s, counts[(s >> U(64 - int(len(counts)).bit_length() + 1)).astype(np.int64)]))]


def _token_counts(k: int, seed: int, bits: int):
    """(slot, c): how many sets of the task have a token in each slot of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, counts = keyed(SPACED_LOWER, seed), np.zeros(1 << bits, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                sets = shingle_sets(Words(data, offsets, kind), k)
                counts += np.bincount((np.concatenate(sets) >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
        slot = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(counts[slot])], names=["slot", "c"])

    return run


def _front(k: int, seed: int, percent: int, shared):
    """(token, sid, part, n, at): the tokens at the front of each set that a partner of no more tokens may share first.

    ``at`` counts tokens before it.  A link needs ``percent / (100 + percent)`` of both sizes in common; with a first
    common token at place ``at`` of a set of n, no more than n - at are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, counts = keyed(SPACED_LOWER, seed), shared.value
        for batch in batches:
            sids, parts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sid", "part"))
            for lo, hi, data, offsets in chunks(batch.column("text")):
                sets = shingle_sets(Words(data, offsets, kind), k)
                front = [_sorted_tokens(s, counts)[: len(s) - -(-percent * len(s) // 100) + 1] for s in sets]
                size = np.array([len(f) for f in front])
                n = np.array([len(s) for s in sets], np.int32)
                at = np.concatenate([np.arange(x, dtype=np.int32) for x in size])
                columns = [as_long(np.concatenate(front)), np.repeat(sids[lo:hi], size), np.repeat(parts[lo:hi], size), np.repeat(n, size), at]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "sid", "part", "n", "at"])

    return run


def _words_in_common(x: set, y: set, percent: int) -> bool:
    common = len(x & y)
    return common > 0 and 100 * common >= percent * (len(x) + len(y) - common)


def true_shingles(text: str, k: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves, as tuples of words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z fold, only ASCII spaces split
    return set(zip(*(words[i:] for i in range(k)), strict=False)) if len(words) >= k else {tuple(words)} if words else set()


def _verify(k: int, seed: int, percent: int, held: int = 256):
    """Links among (block, sid, text, wanted), sorted by block with its members (wanted null) first.

    A visitor names the members that it is to be compared with; an empty list
    means all.  Hashes refuse a pair; what they let through is compared by its
    words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, block = keyed(SPACED_LOWER, seed), None
        members: dict[int, tuple[np.ndarray, str]] = {}
        spelled: OrderedDict[int, set] = OrderedDict()  # of the members that were met last

        def words_of(sid: int) -> set:
            if sid not in spelled:
                spelled[sid] = true_shingles(members[sid][1], k)
                if len(spelled) > held:
                    spelled.popitem(last=False)
            return spelled[sid]

        for batch in batches:
            texts, wanted = batch.column("text"), batch.column("wanted")
            blocks, sids = (batch.column(c).to_pylist() for c in ("block", "sid"))
            a, b = [], []
            for lo, hi, data, offsets in chunks(texts):
                sets = shingle_sets(Words(data, offsets, kind), k)
                for row, x in zip(range(lo, hi), sets, strict=True):
                    sid, now = sids[row], blocks[row]
                    if now != block:
                        block, members, spelled = now, {}, OrderedDict()
                    if not wanted[row].is_valid:
                        members[sid] = (x, texts[row].as_py())
                        continue
                    own = None
                    for other in wanted[row].as_py() or members:
                        y = members[other][0]
                        if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                            continue
                        few, many = (x, y) if len(x) <= len(y) else (y, x)
                        place = np.minimum(np.searchsorted(many, few), max(len(many) - 1, 0))
                        common = int((many[place] == few).sum()) if len(few) else 0
                        if common and 100 * common >= percent * (len(x) + len(y) - common):
                            own = true_shingles(texts[row].as_py(), k) if own is None else own
                            if _words_in_common(own, words_of(other), percent):
                                a.append(sid)
                                b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


#: Members of one component that a task holds at once while others are compared with them.
BLOCK = 64
#: Visitors of a block that one task compares; a block with more is given to several tasks.
VISITORS = 20_000


def _alike(n: str, m: str, percent: int) -> Column:
    return F.expr(f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})")


def _front_pairs(rows: DataFrame, percent: int, work: Work, heavy: int = 32) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b, pa, pb) of sets in two components that share a token early enough in both to be linked, and crowds.

    Tokens that only one component holds pair nothing.  A component that
    holds a token more than ``heavy`` times is not paired set by set: crowds
    are rows (a, part) of a set and such a component, which is to be compared
    with all of that component.
    """
    held = rows.groupBy("token", "part").agg(F.count("*").alias("c")).groupBy("token").agg(F.count("*").alias("parts"), F.max("c").alias("c"))
    rows = work.save(rows.join(held.where("parts > 1").select("token", (F.col("c") > heavy).alias("hot")), "token"), "front")
    # The smaller of two sets (then the smaller name) shares a token that leaves 2p / (100 + p) of it.
    rows = rows.withColumn("index", F.expr(f"(n - at) * (100 + {percent}) >= 2 * {percent} * n"))
    crowd = rows.where("hot").groupBy("token", "part").agg(F.count("*").alias("c"), F.max("index").alias("any")).where(F.col("c") > heavy).select("token", "part", "any", F.lit(True).alias("crowd"))
    few = rows.where("hot").join(crowd, ["token", "part"], "left_anti").unionByName(rows.where("not hot"))
    x = few.select("token", F.col("sid").alias("a"), F.col("part").alias("pa"), "n", "at")
    y = few.where("index").select("token", F.col("sid").alias("b"), F.col("part").alias("pb"), F.col("n").alias("m"), F.col("at").alias("bt"))
    fits = F.expr(f"pa <> pb and (m < n or (m = n and b < a)) and 100 * m >= {percent} * n and least(n - at, m - bt) * (100 + {percent}) >= {percent} * (n + m)")
    pairs = x.join(y, "token").where(fits).select("a", "b", "pa", "pb").distinct()
    met = rows.where("hot").select("token", F.col("sid").alias("a"), F.col("part").alias("pa"), "index").join(crowd, "token").where("pa <> part and (index or any)")
    return pairs, met.select("a", "part").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, shape: Tensored = Tensored(), sketch_bits: int = 18) -> DataFrame:
    """Components of documents linked at a Jaccard similarity of ``percent``/100 or more on k-word shingle sets.

    ``docs`` needs doc_id (long) and text; other columns, whatever their
    names, are ignored.  Returns doc_id, n_shingles, component_id and kept for
    every row.  Null and empty texts have no shingles and link with nothing;
    so do rows without doc_id (component_id null, kept true).  Repeated rows
    each come back; equal texts always share a component.  An empty table
    gives an empty result.  ``sketch_bits`` sets the slots of the frequency
    sketch (8 bytes each on the driver), which orders tokens; it cannot change
    a result.
    """
    spark = docs.sparkSession
    work = Work(spark, "near-dup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seed = secrets.randbits(62)
    features = work.save(docs.mapInArrow(lean(_features(k, shape, seed)), "doc_id long, n long, digest binary, g array<long>, h array<long>"), "features")
    known = features.where("digest is not null and doc_id is not null")
    folded = known.groupBy("digest").agg(F.min("doc_id").alias("root"), F.first("n").alias("n"), F.first("g").alias("g"), F.first("h").alias("h"))
    sets = work.save(folded.withColumn("sid", F.monotonically_increasing_id()), "sets")  # names hold from here on, as they are written

    tables = (
        sets.select("sid", "h", F.posexplode("g").alias("i", "x"))
        .select("sid", "i", "x", F.posexplode("h").alias("j", "y"))
        .select(F.xxhash64("i", "j", "x", "y").alias("key"), "sid")
    )
    sorted_tables = tables.repartitionByRange("key", "sid").sortWithinPartitions("key", "sid")
    met = work.save(sorted_tables.mapInArrow(lean(_buckets), "key long, sid long, center long, edge boolean"), "met")
    # Where a key goes on over several partitions, its centres there meet again in the smallest.
    edge = met.where("edge").groupBy("key").agg(F.min("center").alias("low"))
    crossing = met.where("edge").join(edge, "key").select(F.col("center").alias("sid"), F.col("low").alias("center")).where("sid <> center")
    stars = met.where("sid <> center").select("sid", "center").union(crossing)
    meets = work.save(stars.distinct(), "meets")
    work.drop(met)

    told = known.groupBy("doc_id").agg(F.count("*").alias("c"), F.min("digest").alias("x"), F.max("digest").alias("y")).where("c > 1")
    again = told.agg(F.count("*").alias("c"), F.count_if(F.col("x") != F.col("y")).alias("texts")).first()

    def with_text(wanted: DataFrame, unique: list[str]) -> DataFrame:
        """``wanted`` (sid and others, of which ``unique`` name a row) with the text of each set's first document."""
        roots = work.save(wanted.join(sets.select("sid", F.col("root").alias("doc_id"), *["digest"] * bool(again["texts"])), "sid"), "wanted")
        weight = (F.coalesce(F.size("wanted"), F.lit(0)) * 8 if "wanted" in wanted.columns else F.lit(0)) + 96
        found = join_checked(docs, roots, "doc_id", "inner", weight=weight)
        if again["texts"]:  # rows that repeat a doc_id under another text are told apart by their set
            found = found.mapInArrow(lean(_same_text), found.schema)
        return (found.dropDuplicates(unique) if again["c"] else found).drop("doc_id", "digest")

    def confirm(members: DataFrame, visitors: DataFrame) -> DataFrame:
        """Links (a, b) of the members (block, sid) and visitors (block, sid, wanted: members of the block, none: all of them)."""
        share = visitors.groupBy("block").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("copies"))
        members = members.distinct().join(share, "block").select("block", "sid", F.lit(None).cast("array<long>").alias("wanted"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
        roles = members.unionByName(visitors.join(share, "block").select("block", "sid", "wanted", F.pmod(F.xxhash64("sid"), "copies").cast("int").alias("copy")))
        rows = with_text(roles.select(F.xxhash64("block", "copy").alias("block"), "sid", "wanted"), ["block", "sid"]).select("block", "sid", "text", "wanted")
        rows = rows.repartition("block").sortWithinPartitions("block", F.col("wanted").isNotNull(), "sid")
        return work.save(rows.mapInArrow(lean(_verify(k, seed, percent)), "a long, b long"), "links")

    def of_pairs(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members and visitors of pairs (a: visitor, b: member, block)."""
        return pairs.select("block", F.col("b").alias("sid")), pairs.groupBy("block", F.col("a").alias("sid")).agg(F.collect_set("b").alias("wanted"))

    # Each set visits the centres that it meets; there are no more such pairs than rows in the tables.
    size = sets.select("sid", "n")
    sized = meets.join(size, "sid").join(size.select(F.col("sid").alias("center"), F.col("n").alias("m")), "center").where(_alike("n", "m", percent))
    links = confirm(*of_pairs(work.save(sized.select(F.col("sid").alias("a"), F.col("center").alias("b"), F.xxhash64("center").alias("block")), "pairs")))
    parts = connected_components(links, work)

    # What is left: pairs of a bucket that lie in two components.  All sets of such components are joined exactly.
    part = work.save(sets.select("sid").join(parts.withColumnRenamed("node", "sid"), "sid", "left").select("sid", F.coalesce("component", "sid").alias("part")), "parts")
    far = meets.select("sid", "center").join(part.withColumnRenamed("part", "pa"), "sid").join(part.select(F.col("sid").alias("center"), F.col("part").alias("pb")), "center").where("pa <> pb")
    apart = far.select(F.explode(F.array("pa", "pb")).alias("part")).distinct()
    texts = work.save(with_text(part.join(apart, "part", "left_semi").select("sid", "part"), ["sid"]), "texts")
    sketch = texts.mapInArrow(lean(_token_counts(k, seed, sketch_bits)), "slot int, c long").groupBy("slot").agg(F.sum("c").alias("c"))
    counts = np.zeros(1 << sketch_bits, np.int64)
    slots = sketch.toArrow()  # at most 2 ** sketch_bits rows
    counts[slots.column("slot").to_numpy()] = slots.column("c").to_numpy()
    shared = spark.sparkContext.broadcast(counts)
    front = work.save(texts.mapInArrow(lean(_front(k, seed, percent, shared)), "token long, sid long, part long, n int, at int"), "tokens")
    work.drop(texts)
    rest, crowds = _front_pairs(front, percent, work)
    many = work.save(part.groupBy("part").agg(F.count("*").alias("size")).where("size > 1"), "many")
    sized = rest.join(many.select(F.col("part").alias("pa"), F.col("size").alias("x")), "pa", "left").join(many.select(F.col("part").alias("pb"), F.col("size").alias("y")), "pb", "left")
    sized = sized.select("a", "b", "pa", "pb", F.coalesce("x", F.lit(1)).alias("x"), F.coalesce("y", F.lit(1)).alias("y"))
    swap = F.col("x") > F.col("y")  # members are of the larger component
    turned = sized.select(*[F.when(swap, F.col(u)).otherwise(F.col(v)).alias(v) for u, v in (("b", "a"), ("a", "b"), ("pa", "pb"), ("x", "y"))])
    blocks = F.ceil(F.col("size") / BLOCK)
    block = F.xxhash64("pb", F.pmod(F.xxhash64("b"), F.ceil(F.col("y") / BLOCK)), F.when(F.col("y") == 1, F.col("b")))
    members, visitors = of_pairs(work.save(turned.select("a", "b", block.alias("block")), "pairs"))
    crowds = work.save(crowds.join(many, "part"), "crowds")
    all_of = part.join(crowds.select("part", "size").distinct(), "part").select(F.xxhash64(F.lit("all"), "part", F.pmod(F.xxhash64("sid"), blocks)).alias("block"), "sid")
    to_all = crowds.select("a", "part", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("at")).select(F.xxhash64(F.lit("all"), "part", "at").alias("block"), F.col("a").alias("sid"), F.array().cast("array<long>").alias("wanted"))
    more = confirm(members.unionByName(all_of), visitors.unionByName(to_all))
    work.drop(front)
    joined = more.join(part.select(F.col("sid").alias("a"), F.col("part").alias("pa")), "a").join(part.select(F.col("sid").alias("b"), F.col("part").alias("pb")), "b")
    merged = connected_components(joined.select("pa", "pb"), work, "pa", "pb").select(F.col("node").alias("part"), F.col("component").alias("whole"))

    named = sets.select("sid", "root", "digest").join(part, "sid").join(merged, "part", "left").join(many, "part", "left")
    named = named.select("digest", "root", F.coalesce("whole", F.when(F.col("size") > 1, F.col("part"))).alias("component"))
    lowest = named.where("component is not null").groupBy("component").agg(F.min("root").alias("low"))
    of_set = work.save(named.join(lowest, "component", "left").select("digest", F.coalesce("low", "root").alias("component_id")), "components")
    out = join_checked(features.select("doc_id", "n", "digest"), of_set, "digest", "left", weight=F.lit(64))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _same_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop rows whose words are not those of the set that they are wanted for."""
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            found = sequence_digests(Words(data, offsets, SPACED_LOWER, hashes=False))
            yield part.filter(pa.array([x is not None and x == y for x, y in zip(found, part.column("digest").to_pylist(), strict=True)], pa.bool_()))


#: Two-word shingles, as brute force over an inverted list: for small tables.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i] || chr(32) || w[i + 1] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)
      UNION SELECT doc_id, w[1] FROM d WHERE len(w) = 1),
t AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(node, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b),
m AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(t.n, 0) AS BIGINT) AS n_shingles, least(m.root, d.doc_id) AS component_id, d.doc_id = least(m.root, d.doc_id) AS kept
FROM d LEFT JOIN t USING (doc_id) JOIN m ON m.node = d.doc_id
"""


def query(spark, sf_dir: str) -> DataFrame:
    """op1: two-word shingles, all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=2, percent=80)
