"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue: its documents in order of id, each as its token ids and an end id. A queue
earns its target share of every token sent, and each time its deficit has grown to a
``quantum`` it sends that many tokens. So piece k of a queue with share p is due after
(k + 1) * quantum / p tokens in all; pieces go out as they are due, ties by source, and fill
windows of ``length`` tokens, a multiple of the quantum. Deficits carry across windows, and
across partitions too, since a piece is due at the same time wherever it is. Each window
meets the target shares up to one quantum for each source.

The target shares are given for each source, or are the sources' shares of all tokens, so
that all queues end together. A queue that runs dry leaves its turns to the others, which keep their
proportions to each other; sources without a target follow when the others are done. What is
left of each queue at its end, less than a quantum, is sent last, queue by queue. Only the
last window is padded. Documents are cut where a quantum or a window ends.

Null text: only the end id. Null source: a queue of its own. Rows that repeat are packed
each time. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rawstar.llm.common import by_weight, short_batches
from rawstar.operators.numbering import running_totals
from rawstar.operators.skew import lookup_join
from rawstar.session import materialize, shuffle_width

LENGTH, QUANTUM = 4096, 512
TOKENS = "part int, queue string, doc_id long, begins long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
CUT = PIECES + ", queue string, k long, inside long, total long, tail binary"
# Distinct words whose ids a worker remembers, in two halves: the older is dropped when the newer is full.
REMEMBERED = 400_000
# Bytes of text encoded together.
TOGETHER = 2 << 20
# Words given to the tokenizer at a time: its records of a word are many times the word.
ASKED = 10_000


@lru_cache(1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# ASCII marks but the apostrophe, which has rules of its own.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
# Letters that lower-case to one letter by themselves.
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")


def _plain(path: str):
    """The same vocabulary for words that are lower-cased and cut already: no further rules."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    plain = Tokenizer.from_file(path)
    plain.normalizer = normalizers.Sequence([])
    as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])
    return plain


class Encoder:
    """Token ids of texts, word by word: the vocabulary's rules never look across a space or line end."""

    def __init__(self, path: str, end_id: int):
        self.tokenizer, self.plain = _tokenizer(path), _plain(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.end = np.array([end_id], self.kind).tobytes()
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        # The last id of a word is of the vocabulary's word ends; so ids of many words can be told apart.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _bytes(self, ids) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _learn_simple(self, words: list[str]) -> None:
        """``words`` of letters only, or of marks only: one call for all of them."""
        found = self.plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        ids = np.array(found, self.kind)
        upto = (np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize
        if len(upto) != len(words):
            for w in words:
                self._learn_whole([w])
            return
        flat, a = ids.tobytes(), 0
        for w, b in zip(words, upto.tolist()):
            self.known[w] = flat[a:b]
            a = b

    def _learn_whole(self, words: list[str]) -> None:
        for w, found in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            self.known[w] = self._bytes(found.ids)

    def learn(self, words: Iterable[str]) -> None:
        """Remember the ids of ``words``. Marks after letters are split off, as the vocabulary itself does."""
        known, older = self.known, self.older
        # Lists of text side by side, not tuples: nothing for the garbage collector to walk through.
        simple, stems, marks, whole = [], [], [], []
        for w in words:
            if w in older:
                known[w] = older[w]
                continue
            stem = w.rstrip(_MARKS)
            if stem.isalpha() and (stem.isascii() or _LATIN.fullmatch(stem)):
                simple.append(w)
                stems.append(stem.lower())
                marks.append(w[len(stem) :])
            else:
                whole.append(w)
        new = {*stems, *marks}.difference(known)
        for w in new & older.keys():
            known[w] = older[w]
        new = list(new.difference(known))
        for a in range(0, len(new), ASKED):
            self._learn_simple(new[a : a + ASKED])
        for a in range(0, len(whole), ASKED):
            self._learn_whole(whole[a : a + ASKED])
        for w, stem, mark in zip(simple, stems, marks):
            known[w] = known[stem] + known[mark] if mark else known[stem]

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each text, null or not, and the end id, as bytes."""
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {"": b""}
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn([w for w in words if w not in self.known])
        parts = [*map(self.known.__getitem__, words), self.end]
        ids = np.frombuffer(b"".join(parts), self.kind)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // ids.itemsize
        begins = np.cumsum(sizes) - sizes
        # The words of all texts in a row, by number, each text closed by the end id.
        ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        which = np.insert(coded.indices.to_numpy(), ends, len(words))
        size = sizes[which]
        upto = np.cumsum(size)
        at = np.repeat(begins[which] - upto + size, size)
        at += np.arange(len(at))
        offsets = np.append(0, upto[ends + np.arange(len(ends))]) * ids.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids[at])]).cast(pa.binary())


@lru_cache(1)
def _encoder(path: str, end_id: int) -> Encoder:
    """One for each worker process, so that what it remembers serves the next task too."""
    return Encoder(path, end_id)


def _tokens(path: str, end_id: int):
    def run(batches):
        import os

        from pyspark import TaskContext

        # Spark runs one task on each core; a tokenizer's own threads would only compete.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part, sent = _encoder(path, end_id), TaskContext.get().partitionId(), 0
        size = np.dtype(encoder.kind).itemsize
        # Words that texts share are looked up once for all texts encoded together.
        for batch in map(pa.Table.from_batches, by_weight(batches, lambda b: b.nbytes, TOGETHER)):
            batch = batch.combine_chunks().to_batches()[0]
            ids = encoder.encode(batch.column("text"))
            lengths = pc.binary_length(ids).to_numpy().astype(np.int64) // size
            begins = sent + np.cumsum(lengths) - lengths
            sent += int(lengths.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, np.int32)),
                    batch.column("queue"),
                    batch.column("doc_id"),
                    pa.array(begins),
                    ids,
                ],
                names=["part", "queue", "doc_id", "begins", "ids"],
            )

    return run


_KINDS = [pa.int64()] * 5 + [pa.string()] + [pa.int64()] * 3 + [pa.binary()]


def _cut(quantum: int, kind: str):
    """Documents cut where a quantum of their queue ends; what lies in the queue's last, shorter piece keeps its ids."""

    def run(batches):
        width = np.dtype(kind).itemsize
        for batch in batches:
            out: list[tuple] = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "begins", "queue", "total")))
            for doc, ids, begins, queue, total in rows:
                size, start = len(ids) // width, 0
                wide = np.frombuffer(ids, kind).astype("<u4").tobytes()
                while start < size:
                    k, inside = divmod(begins + start, quantum)
                    take = min(size - start, quantum - inside)
                    piece = wide[4 * start : 4 * (start + take)]
                    tail = piece if (k + 1) * quantum > total else None
                    out.append((doc, start, take, zlib.crc32(piece), size, queue, k, inside, total, tail))
                    start += take
            columns = list(zip(*out)) or [[]] * 10
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _KINDS)], names=[x.split()[0] for x in CUT.split(", ")]
            )

    return run


def _at_windows(length: int):
    """Pieces of the queues' ends cut where a window ends."""

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc, start, size, tokens, at, ids in zip(*(c.to_pylist() for c in batch.columns)):
                done = 0
                while done < size:
                    window, offset = divmod(at + done, length)
                    take = min(size - done, length - offset)
                    piece = ids[4 * done : 4 * (done + take)]
                    out.append((doc, start + done, take, zlib.crc32(piece), tokens, window, offset))
                    done += take
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_PLACED)

    return run


_PLACED = [*[x.split()[0] for x in PIECES.split(", ")], "sequence_id", "offset"]


def _queue_of(source):
    """Never null, in the order of sources, null first."""
    return F.coalesce(F.concat(F.lit("1"), source), F.lit("0"))


def _due(pieces: DataFrame, targets: DataFrame | None, quantum: int) -> DataFrame:
    """One row for each piece of a queue: queue, k, size, last (the queue's shorter end), due."""
    first = pieces.where("inside = 0").select("queue", "k", "total")
    if targets is None:
        shared = first.withColumn("share", F.col("total").cast("double"))
    else:
        wanted = targets.groupBy(_queue_of(F.col("source")).alias("queue")).agg(F.sum(F.col("share").cast("double")).alias("share"))
        shared = lookup_join(first, materialize(wanted.where("share > 0"), "targets"), ["queue"], "left")
    left = F.col("total") - F.col("k") * quantum
    return shared.select(
        "queue",
        "k",
        F.least(left, F.lit(quantum)).alias("size"),
        (left < quantum).alias("last"),
        F.coalesce((F.col("k") + 1) / F.col("share"), F.lit(float("inf"))).alias("due"),
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    length: int = LENGTH,
    quantum: int = QUANTUM,
    targets: DataFrame | None = None,
) -> DataFrame:
    """One row for each piece of each document: ``PIECES``, sequence_id, offset.

    ``docs`` has doc_id, text, source; ``targets``, if given, source and share (any positive
    numbers, in proportion).
    """
    if length % quantum:
        raise ValueError("a window must hold whole quanta")
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(_queue_of(F.col("source")).alias("queue"), "doc_id", "text").withColumn("tie", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(shuffle_width(spark), "queue", "doc_id", "tie")
    ordered = ordered.sortWithinPartitions("queue", "doc_id", "tie").drop("tie")
    stored = materialize(ordered.mapInArrow(_tokens(tokenizer_path, end_id), TOKENS), "token-ids")
    kind = Encoder(tokenizer_path, end_id).kind
    size = F.octet_length("ids") / np.dtype(kind).itemsize
    sums = stored.groupBy("part", "queue").agg(F.sum(size).cast("long").alias("n"), F.min("begins").alias("first"))
    # A queue has one row for each partition that holds some of it.
    queue = Window.partitionBy("queue")
    earlier = queue.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = materialize(sums, "token-counts").select(
        "part",
        "queue",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(queue).alias("total"),
    )
    placed = lookup_join(stored, materialize(shifts, "queues"), ["part", "queue"])
    placed = placed.select("doc_id", "ids", (F.col("begins") + F.col("shift")).alias("begins"), "queue", "total")
    pieces = materialize(placed.mapInArrow(_cut(quantum, kind), CUT), "pieces")
    order = ["last", "due", "queue", "k"]
    sent = running_totals(_due(pieces, targets, quantum), order, "size", "sent").select("queue", "k", "sent")
    found = pieces.join(sent, ["queue", "k"]).withColumn("at", F.col("sent") + F.col("inside"))
    window, offset = F.expr(f"at div {length}").alias("sequence_id"), F.expr(f"at % {length}").alias("offset")
    full = found.where("tail is null").select(*_PLACED[:5], window, offset)
    ends = found.where("tail is not null").select("doc_id", "start", "length", "doc_tokens", "at", "tail")
    schema = PIECES + ", sequence_id long, offset long"
    return full.unionByName(ends.mapInArrow(_at_windows(length), schema))
