"""MinHash near-dedup: a signature-coordinate inverted join with exact confirmation.

Documents with equal shingle sets are one class. A class is posted under each of its
``COORDINATES`` signature values; every coordinate has its own multiplier, so a value stands
for a (coordinate, value) pair. Two classes are candidates if at least ``matches_for`` the asked similarity
coordinates collide: of pairs that similar, fewer than LOST collide less often.

* Prefix: values posted once cannot collide. Of a class's other values, c of them, the c -
  matches + 1 posted least often contain one value that any candidate shares with it, so only
  those postings are merged; a class with fewer than that many such values has no partner.
* Skip: the other collisions are not merged but counted on the two signatures, by the low
  byte of each value, which can only overcount.
* Candidates are confirmed on the full shingle sets.

* A shingle that no other class still compared has cannot be common: with s shared shingles of
  n each, two sets are at most min(s) / (n + n - min(s)) similar. Pairs under the threshold by that
  bound are left out, exactly.

Links only matter between classes not yet connected, so a posting list is first compared
with its first member, confirmed, and connected. What is left in different components is then
compared in blocks, member with member: pairs that may link and collide are confirmed on the
shingle sets the block carries, and only links that connect two of its components are returned.
No group's pairs are written out, and no link between different components is missed.

Words are the runs between ASCII white space, A-Z lower-cased. A text with fewer than five words
is one shingle; without words its set is empty and it links with nothing. Null ids come after all
others; rows repeating id and text are marked alike. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.common import KEY, as_bytes, join_rows, keep_rows, mix, odd_multipliers, release, rows_of, short_batches
from rawstar.session import materialize

SHINGLE = 5
COORDINATES = 64
SIMILARITY = 85  # per cent
# The share of pairs, just as similar as asked, that may be lost.
LOST = 2.5e-6
# Members of a posting list, and shingles in all of them, that one task compares with as many others.
BLOCK, BLOCK_SHINGLES = 1500, 4_000_000
REMEMBERED = 300_000

_WORD = odd_multipliers(SHINGLE, 30)
_COORDINATE = odd_multipliers(COORDINATES, 31)
SIGNED = "doc_id long, text_hash long, n_shingles long, set1 long, set2 long, signature array<long>"


def matches_for(similarity: int) -> int:
    """The most collisions that all but LOST of the pairs of that similarity have; 40 at 85 per cent."""
    p, below = similarity / 100, 0.0
    for k in range(COORDINATES):
        below += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if below > LOST:
            return max(1, k)
    return COORDINATES


class _Words(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: bytes, words: _Words) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles."""
    split = text.lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, split), np.uint64, len(split))
    if len(split) < SHINGLE:
        return mix((hashes * _WORD[: len(split)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(split)))
    n = len(split) - SHINGLE + 1
    total = hashes[:n] * _WORD[0]
    for i in range(1, SHINGLE):
        total += hashes[i : i + n] * _WORD[i]
    return np.unique(mix(total))


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, 2**64 - 1, np.uint64)
    for a in range(0, len(found), 2048):
        part = found[a : a + 2048]
        np.minimum(least, (part[None, :] * _COORDINATE[:, None]).min(axis=1), out=least)
    return least


def _sign(batches):
    words = _Words()
    for batch in batches:
        sizes, first, second, values = [], [], [], []
        for text in batch.column("text").to_pylist():
            found = shingles(text, words)
            digest = xxhash.xxh3_128_digest(found.tobytes())
            sizes.append(len(found))
            first.append(int.from_bytes(digest[:8], "little", signed=True))
            second.append(int.from_bytes(digest[8:], "little", signed=True))
            values.append(signature(found).view(np.int64) if len(found) else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                *(pa.array(x, pa.int64()) for x in (sizes, first, second)),
                pa.array(values, pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_hash", "n_shingles", "set1", "set2", "signature"],
        )


def _sketch(signatures: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in (signatures & 0xFF).astype(np.uint8)]


def _sketches(batches):
    for batch in batches:
        values = batch.column("signature")
        flat = np.asarray(values.flatten()).reshape(-1, COORDINATES)
        yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(_sketch(flat), pa.binary())], names=["cid", "sketch"])


def _as_rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _enough(matches: int):
    def run(batches):
        """Pairs whose signatures collide often enough."""
        for batch in batches:
            same = (_as_rows(batch.column("sketch_a")) == _as_rows(batch.column("sketch_b"))).sum(1) >= matches
            yield batch.select(["a", "b"]).filter(pa.array(same))

    return run


def _similar(x: np.ndarray, y: np.ndarray, similarity: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= similarity * (len(x) + len(y) - common)


def _confirm(similarity: int):
    def run(batches):
        words, last = _Words(), (None, None)
        for batch in batches:
            a, b = [], []
            for x, y, text_x, text_y in rows_of([batch.select(["a", "b", "text_a", "text_b"])]):
                if last[0] != x:
                    last = (x, shingles(text_x, words))
                other = shingles(text_y, words)
                if _similar(last[1], other, similarity):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _shingle_rows(batches):
    words = _Words()
    for batch in batches:
        found = [shingles(t, words) for t in batch.column("text").to_pylist()]
        take = np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found])
        flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("cid").take(pa.array(take)), pa.array(flat)], names=["cid", "shingle"])


def _sets(batches):
    """The shingles of each text as the bytes of a sorted array."""
    words = _Words()
    for batch in batches:
        found = [shingles(t, words).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(found, pa.large_binary()).cast(pa.binary())], names=["cid", "set"])


def _may_link(n_x, s_x, n_y, s_y, similarity):
    """Whether sets of n shingles, s of them shared with any other, can be similar enough."""
    least = np.minimum(s_x, s_y)
    return 100 * least >= similarity * (n_x + n_y - least)


def _compare_block(similarity: int, matches: int):
    def run(key, table):
        """Links of one block pair that connect different components.

        Pairs that may link and collide often enough are confirmed on their sets, a pair posted
        together under several values under one of them, which the two ids choose. A pair whose components
        the block has already connected is passed over, so there are fewer links than members.
        """
        value, pair = key[0].as_py(), (key[1].as_py(), key[2].as_py())
        block, cid, size, shared = (np.asarray(table.column(c)) for c in ("block", "cid", "size", "shared"))
        posted = [frozenset(x) for x in table.column("posted").to_pylist()]
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set").combine_chunks()]
        sketch = _as_rows(table.column("sketch"))
        _, comp = np.unique(np.asarray(table.column("comp")), return_inverse=True)
        rows, others = np.flatnonzero(block == pair[0]), np.flatnonzero(block == pair[1])
        a, b = [], []
        for i in rows:
            with_ = others[comp[others] != comp[i]]
            if pair[0] == pair[1]:
                with_ = with_[cid[with_] > cid[i]]
            with_ = with_[_may_link(size[i], shared[i], size[with_], shared[with_], similarity)]
            for j in with_[(sketch[with_] == sketch[i]).sum(1) >= matches]:
                if comp[i] == comp[j]:
                    continue
                common = sorted(posted[i] & posted[j])
                if common[int(cid[i] + cid[j]) % len(common)] == value and _similar(sets[i], sets[j], similarity):
                    comp[comp == comp[j]] = comp[i]
                    a.append(min(cid[i], cid[j]))
                    b.append(max(cid[i], cid[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def components(links: DataFrame) -> DataFrame:
    """(cid, comp) for the ends of ``links`` (a, b): comp is the smallest cid reachable.

    Alternating stars: every node's neighbours move to the smallest one, until only stars are left.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        edges = materialize(small, "small-star")
        # A node of a star is either its centre or has one edge, to the centre.
        ends = edges.select("u", F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("up")))
        node = ends.groupBy("u").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
        if node.where("ups > 1 or (ups = 1 and least = 0)").isEmpty():
            return edges.select(F.col("u").alias("cid"), F.col("v").alias("comp"))


def _postings(classes: DataFrame, matches: int) -> DataFrame:
    """(value, cid, n): the prefix of each class that can have partners; n classes are posted under the value."""
    posted = classes.select("cid", F.explode("signature").alias("value"))
    often = posted.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = posted.join(often, "value").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("values"))
    prefix = F.slice("values", F.lit(1), F.size("values") - (matches - 1))
    return shared.where(F.size("values") >= matches).select("cid", F.explode(prefix).alias("p")).select("p.value", "cid", "p.n")


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """For each row: doc_id, text_hash, n_shingles, component_id, kept, leads; ``similarity`` per cent links two texts.

    ``kept`` compares ids only; of the rows that share a component's id, ``leads`` is true for one text.
    """
    spark, matches = docs.sparkSession, matches_for(similarity)
    short_batches(spark)
    texts = as_bytes(docs)
    signed = materialize(texts.mapInArrow(_sign, SIGNED), "signatures")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = signed.where("n_shingles > 0").groupBy("set1", "set2")
    classes = classes.agg(F.min(row).alias("first"), F.first("signature").alias("signature"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    sketches = materialize(classes.select("cid", "signature").mapInArrow(_sketches, "cid long, sketch binary"), "sketches")
    postings = materialize(_postings(classes, matches), "postings")
    release(spark)

    def texts_of(ids: DataFrame) -> DataFrame:
        rows = classes.join(ids, "cid").select("cid", "first.doc_id", "first.text_hash")
        found = join_rows(texts, rows, "inner").select("cid", "text").dropDuplicates(["cid"])
        return materialize(found, "candidate-texts")

    def close(pairs: DataFrame) -> DataFrame:
        other = sketches.select(F.col("cid").alias("b"), F.col("sketch").alias("sketch_b"))
        own = sketches.select(F.col("cid").alias("a"), F.col("sketch").alias("sketch_a"))
        return materialize(pairs.join(other, "b").join(own, "a").mapInArrow(_enough(matches), "a long, b long"), "candidates")

    def confirmed(pairs: DataFrame, found: DataFrame) -> DataFrame:
        other = found.select(F.col("cid").alias("b"), F.col("text").alias("text_b"))
        own = found.select(F.col("cid").alias("a"), F.col("text").alias("text_a"))
        return materialize(pairs.join(other, "b").join(own, "a").mapInArrow(_confirm(similarity), "a long, b long"), "links")

    def still_apart(member: DataFrame, comp: DataFrame) -> DataFrame:
        """Posted members with their components, where a list spans several."""
        member = member.join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        spans = member.groupBy("value").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("n"))
        return materialize(member.drop("n").join(spans.where("x <> y").select("value", "n"), "value"), "apart")

    heads = postings.groupBy("value").agg(F.min("cid").alias("a"))
    stars = postings.join(heads, "value").where("cid <> a").select("a", F.col("cid").alias("b")).distinct()
    stars = close(stars)
    links = confirmed(stars, texts_of(stars.select(F.explode(F.array("a", "b")).alias("cid")).distinct()))
    comp = components(links)
    apart = still_apart(postings, comp)

    found = texts_of(apart.select("cid").distinct())
    each = materialize(found.mapInArrow(_shingle_rows, "cid long, shingle long"), "shingles")
    own_only = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("cid")).where("n = 1")
    lone = own_only.groupBy("cid").agg(F.count(F.lit(1)).alias("lone"))
    sizes = each.groupBy("cid").agg(F.count(F.lit(1)).alias("size")).join(lone, "cid", "left")
    sizes = sizes.withColumn("shared", F.col("size") - F.coalesce("lone", F.lit(0))).drop("lone")
    sizes = materialize(sizes.where(F.col("shared") * 100 >= F.col("size") * similarity), "set-sizes")
    apart = still_apart(apart.drop("comp").join(sizes, "cid"), comp)

    own = apart.groupBy("cid").agg(F.collect_set("value").alias("posted"))
    own = materialize(own.join(found, "cid").mapInArrow(_sets, "cid long, set binary").join(own, "cid").join(sketches, "cid"), "sets")
    blocks = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_SHINGLES)
    lists = apart.groupBy("value").agg(F.ceil(blocks).cast("int").alias("blocks"))
    placed = apart.join(lists, "value").withColumn("block", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    dealt = dealt.select("value", "low", "high", "block", "cid", "comp", "size", "shared").join(own, "cid")
    pairs = dealt.groupBy("value", "low", "high").applyInArrow(_compare_block(similarity, matches), "a long, b long")
    more = materialize(pairs, "block-links")
    if not more.isEmpty():
        comp = components(links.unionByName(more))

    member = classes.join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    keeper = member.groupBy("comp").agg(F.min("first").alias("keeper"))
    verdict = materialize(member.join(keeper, "comp").select("set1", "set2", "keeper"), "components")
    alone = F.col("n_shingles") == 0
    rows = signed.drop("signature").join(verdict, ["set1", "set2"], "left")
    same = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id"))
    return rows.select(
        *KEY,
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("component_id"),
        (alone | same).alias("kept"),
        (alone | (same & (F.col("text_hash") == F.col("keeper.text_hash")))).alias("leads"),
    )


def without_near_copies(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component, also if it is listed twice."""
    found = near_duplicates(docs, similarity)
    keys = found.where("leads").groupBy(*KEY).agg(F.when(F.max("n_shingles") > 0, F.count(F.lit(1))).otherwise(1).alias("n"))
    keys = materialize(keys, "leading-rows")
    once = keep_rows(docs, keys.where("n = 1"))
    again = keep_rows(docs, keys.where("n > 1")).select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct("*").alias("_row"))
    return once.union(again.dropDuplicates(KEY).select("_row.*"))
