"""Line dedup: a sharded minimal perfect hash over line hashes, probed by the documents.

Documents are read once into narrow rows (document, 128-bit hash of a line key, positions).
The hashes found in enough documents become shards: each holds a minimal perfect hash and, in
its order, arrays of 64-bit fingerprints, document counts and keepers. Documents send their
line hashes to the shards and probe the arrays there; texts and lines are never joined.

Every row counts as a document. A null or empty text is one empty line. Rows sharing the
largest id all keep the line; a null id is smaller than any other. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.common import KEY, SPACES, as_bytes, join_rows, mix, rows_of, short_batches
from rawstar.session import materialize

LINES = "doc_id long, text_hash long, h1 long, h2 long, positions binary"
BUILT = "shard int, asked long, levels array<binary>, rest binary, fingerprints binary, counts binary, keepers binary"
VERDICTS = "doc_id long, text_hash long, positions binary"
KEPT = "doc_id long, text_hash long, n_lines long, n_dropped long, kept binary"
# Probes that one task answers at a time.
PROBES = 400_000


def _lines(min_chars: int):
    def run(batches):
        for batch in batches:
            row, h1, h2, places = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found: dict[bytes, list[int]] = {}
                for at, line in enumerate(text.split(b"\n")):
                    key = line.strip(SPACES).lower()
                    # A UTF-8 code point has one to four bytes.
                    if len(key) >= min_chars and (
                        len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars
                    ):
                        found.setdefault(key, []).append(at)
                for key, at in found.items():
                    digest = xxhash.xxh3_128_digest(key)
                    row.append(i)
                    h1.append(digest[:8])
                    h2.append(digest[8:])
                    places.append(np.array(at, "<i4").tobytes())
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take),
                    batch.column("text_hash").take(take),
                    pa.array(np.frombuffer(b"".join(h1), "<i8")),
                    pa.array(np.frombuffer(b"".join(h2), "<i8")),
                    pa.array(places, pa.binary()),
                ],
                names=["doc_id", "text_hash", "h1", "h2", "positions"],
            )

    return run


def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Minimal perfect hash of distinct (h1, h2): bit arrays by level, key order, and keys it left over.

    A key gets a slot at the first level where it is alone in its place; its number is the
    rank of that place. Keys equal in ``h1`` can never be told apart and are listed at the end.
    """
    left, levels, order = np.arange(len(h1)), [], []
    while len(left) and len(levels) < 40:
        size = max(8, 2 * len(left))
        slot = _slot(h1[left], len(levels), size)
        alone = np.bincount(slot, minlength=size)[slot] == 1
        bits = np.zeros(size, bool)
        bits[slot[alone]] = True
        placed = left[alone]
        order.append(placed[np.argsort(slot[alone])])
        levels.append(size.to_bytes(8, "little") + np.packbits(bits).tobytes())
        left = left[~alone]
    return levels, np.concatenate([*order, left]).astype(np.int64), left


def probe_hash(levels: list[bytes], rest: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Number of each key, or -1; a key that was never put in gets any number."""
    found, todo, before = np.full(len(h1), -1), np.arange(len(h1)), 0
    for level, packed in enumerate(levels):
        size = int.from_bytes(packed[:8], "little")
        bits = np.unpackbits(np.frombuffer(packed, np.uint8, offset=8), count=size)
        rank = np.cumsum(bits) - 1
        slot = _slot(h1[todo], level, size)
        hit = bits[slot] == 1
        found[todo[hit]] = before + rank[slot[hit]]
        todo, before = todo[~hit], before + int(bits.sum())
    listed = {(a, b): before + i for i, (a, b) in enumerate(rest.tolist())}
    if listed:
        for i in range(len(h1)):
            found[i] = listed.get((int(h1[i]), int(h2[i])), found[i])
    return found


def _build(key, table):
    h1, h2 = (table.column(c).to_numpy().astype(np.uint64) for c in ("h1", "h2"))
    levels, order, left = build_hash(h1, h2)
    keepers = table.column("keeper").combine_chunks()
    known = np.asarray(keepers.is_valid())
    keeper = np.where(known, np.asarray(keepers.fill_null(0)), 0)[order]
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int32()),
            "asked": pa.array([int(table.column("n").to_numpy().sum())], pa.int64()),
            "levels": pa.array([levels], pa.list_(pa.binary())),
            "rest": pa.array([np.stack([h1[left], h2[left]], 1).astype("<u8").tobytes()], pa.binary()),
            "fingerprints": pa.array([h2[order].astype("<u8").tobytes()], pa.binary()),
            # A line known from rows without an id only has no keeper: its count is negative.
            "counts": pa.array(
                [(table.column("n").to_numpy() * np.where(known, 1, -1))[order].astype("<i8").tobytes()], pa.binary()
            ),
            "keepers": pa.array([keeper.astype("<i8").tobytes()], pa.binary()),
        }
    )


def _probe(min_docs: int):
    def run(probes, index):
        empty = pa.table({"doc_id": pa.array([], pa.int64()), "text_hash": pa.array([], pa.int64()), "positions": pa.array([], pa.binary())})
        if not index.num_rows or not probes.num_rows:
            return empty
        part = {c: index.column(c)[0].as_py() for c in index.column_names}
        prints, counts, keepers = (
            np.frombuffer(part[c], t) for c, t in (("fingerprints", "<u8"), ("counts", "<i8"), ("keepers", "<i8"))
        )
        h1, h2 = (probes.column(c).to_numpy().astype(np.uint64) for c in ("h1", "h2"))
        at = probe_hash(part["levels"], np.frombuffer(part["rest"], "<u8").reshape(-1, 2), h1, h2)
        known = (at >= 0) & (prints[at] == h2) & (np.abs(counts[at]) >= min_docs)
        ids = probes.column("doc_id").combine_chunks()
        has_id = np.asarray(ids.is_valid())
        keeps = np.where(counts[at] > 0, has_id & (np.asarray(ids.fill_null(0)) == keepers[at]), ~has_id)
        return probes.filter(pa.array(known & ~keeps)).select(["doc_id", "text_hash", "positions"])

    return run


def _drop(batches):
    for batch in batches:
        kept, lines, dropped = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist()):
            lines.append(text.count(b"\n") + 1)
            if gone:
                away = set(np.frombuffer(b"".join(gone), "<i4").tolist())
                kept.append(b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in away))
                dropped.append(len(away))
            else:
                kept.append(text)
                dropped.append(0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(lines, pa.int64()),
                pa.array(dropped, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "text_hash", "n_lines", "n_dropped", "kept"],
        )


def line_index(lines: DataFrame, shards: int, min_docs: int, probes: int) -> DataFrame:
    """The shards over the stored narrow ``lines``; a shard asked very often is listed in several pieces.

    Lines held by many documents bring their shard more probes than others, so it gets one
    more piece for each ``probes`` of them.
    """
    repeated = (
        lines.groupBy("h1", "h2")
        # A row listed twice is one document.
        .agg(F.count_distinct(F.struct(*KEY)).alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .withColumn("shard", F.pmod("h2", F.lit(shards)).cast("int"))
    )
    built = materialize(repeated.groupBy("shard").applyInArrow(_build, BUILT), "line-shards")
    return built.withColumn("pieces", (1 + F.floor(F.col("asked") / probes)).cast("int"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, probes: int = PROBES) -> DataFrame:
    """doc_id, text_hash, n_lines, n_dropped and ``kept`` (UTF-8 bytes) for each row of ``docs``."""
    short_batches(docs.sparkSession)
    texts = as_bytes(docs)
    lines = materialize(texts.mapInArrow(_lines(min_chars), LINES), "lines")
    shards = max(1, math.ceil(lines.count() / probes))
    index = line_index(lines, shards, min_docs, probes)
    # One small row for each shard asked more than once over, so fewer than lines / probes rows.
    hot = F.broadcast(index.where("pieces > 1").select("shard", "pieces"))
    asked = (
        lines.withColumn("shard", F.pmod("h2", F.lit(shards)).cast("int"))
        .join(hot, "shard", "left")
        .withColumn("piece", F.pmod(F.xxhash64(*KEY), F.coalesce("pieces", F.lit(1))).cast("int"))
        .drop("pieces")
    )
    parts = index.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    parts = parts.drop("pieces", "asked")
    answers = asked.groupBy("shard", "piece").cogroup(parts.groupBy("shard", "piece")).applyInArrow(_probe(min_docs), VERDICTS)
    dropped = answers.groupBy(*KEY).agg(F.collect_set("positions").alias("dropped"))
    return join_rows(texts, dropped).mapInArrow(_drop, KEPT)
