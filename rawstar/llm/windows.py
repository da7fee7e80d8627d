"""Repeated-window dedup: a depth-limited radix sort that orders suffixes through ``size`` bytes only.

Suffixes that begin a whole window of ``size`` bytes are sorted by most-significant-digit
passes; a suffix alone in its group after a pass is unique and goes no further, and groups
still together at full depth are exactly the repeated windows. The digits are:

1. the smallest hash of a 32-byte string inside the window. It depends on the window alone,
   so equal windows share it, and neighbouring suffixes mostly share it as well: they travel
   as one run (digit, document, first start, count).
2. the whole content of the run. Runs equal in it are equal in all their windows, so all but
   the first are repeats, without looking at single suffixes.
3. all ``size`` bytes of each suffix left, by a 64-bit hash. With digit 1 that makes 128 bits.

A group that holds more runs than one task should sort leaves pass 3 for a join on
(digit, hash), which combines before its shuffle; the result is the same.

Text is UTF-8 bytes, null is empty, matches never cross documents. Of equal windows the
first by (doc_id, start) is not a repeat; null ids come first, and of rows repeating an id the
one with the smaller text hash. Rows repeating both are the same document: they get the same
verdict. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.common import KEY, as_bytes, by_weight, discard, join_rows, mix, odd_multipliers, release, short_batches, store
from rawstar.session import materialize

SIZE = 100
GRAM = 32
# Runs are cut at this many windows, so that two windows cover a run.
LONGEST_RUN = 96
TWICE = 128
# Bytes hashed at a time, bytes after which a task hands on its runs, runs in a radix bucket, context
# bytes in one, those sorted at a time, windows of them, and runs of one digit that a task sorts itself.
CHUNK = 1 << 17
HAND_ON = 8 << 20
BUCKET_RUNS = 200_000
BUCKET_BYTES = 6 << 20
SORTED_BYTES = 1 << 19
SORTED_WINDOWS = 500_000
GROUP_RUNS = 200_000

_FIELDS = (("digit", "<u8"), ("content", "<u8"), ("doc_id", "<i8"), ("text_hash", "<i8"), ("null", "u1"), ("start", "<i4"), ("count", "u1"))
_ROW = sum(np.dtype(t).itemsize for _, t in _FIELDS)
_ORDER = ("start", "text_hash", "doc_id", "known")
PACKED = "bucket int, runs binary"
RUN = "doc_id long, text_hash long, start int, count int, digit long, rivals long"
CONTEXT = "digit long, doc_id long, text_hash long, start int, bytes binary"
WINDOW = "digit long, whole long, doc_id long, text_hash long, start int"
GONE = "doc_id long, text_hash long, start int, count int"
KEPT = "doc_id long, text_hash long, n_bytes long, n_removed long, n_spans long, kept binary"
REPEATS, COUNTS = -1, -2
_BYTES = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)
_JOIN = odd_multipliers(16, 21)


def _joined(left: np.ndarray, size: int, right: np.ndarray, multiplier) -> np.ndarray:
    """Hashes of strings made of ``size`` bytes at i and those of ``right`` at i + size."""
    out = left.copy()
    out[:-size] = left[:-size] * multiplier + right[size:]
    return out


def window_hashes(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``GRAM`` bytes and of the ``size`` bytes that begin at each place."""
    power, hashes = 1, {1: _BYTES[data]}
    while power * 2 <= size:
        hashes[power * 2] = _joined(hashes[power], power, hashes[power], _JOIN[power.bit_length()])
        if not (power & size or power == GRAM):
            del hashes[power]
        power *= 2
    whole, done = hashes[power], power
    for p in sorted(hashes, reverse=True):
        if done + p <= size:
            whole = _joined(whole, done, hashes[p], _JOIN[10])
            done += p
    return hashes[GRAM], whole


def runs_of(texts: list[bytes], size: int):
    """Arrays (text number, digit, content, first start, windows) of the runs of whole windows.

    ``TWICE`` is added to the windows of a run that may hold the same window twice.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths) - lengths
    if not len(data) or lengths.max() < size:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    grams, whole = window_hashes(data, size)
    grams = mix(grams)
    least, width, want = grams.copy(), 1, size - GRAM + 1
    while width * 2 <= want:
        least[:-width] = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least[: width - want] = np.minimum(least[: width - want], least[want - width :])
    windows = np.maximum(lengths - size + 1, 0)
    text = np.repeat(np.arange(len(texts)), windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = begins[text] + start
    digit = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (digit[1:] != digit[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    new |= (np.arange(len(at)) - first[run]) % LONGEST_RUN == 0
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    # Places of the 32-byte strings under each run; a smallest one met twice may bring a window twice.
    under = count + size - GRAM
    place = np.arange(under.sum()) - np.repeat(np.cumsum(under) - under - at[first], under)
    met = np.add.reduceat(grams[place] == np.repeat(digit[first], under), np.cumsum(under) - under, dtype=np.int64)
    content = mix(whole[at[first]] * _JOIN[11] + mix(whole[at[first + count - 1]]) + count.astype(np.uint64))
    return text[first], digit[first], content, start[first], count + TWICE * (met > 1)


def _pack(runs: dict[str, np.ndarray]) -> bytes:
    return b"".join(runs[name].astype(kind).tobytes() for name, kind in _FIELDS)


def _unpack(packed: list[bytes]) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {name: [] for name, _ in _FIELDS}
    for data in packed:
        rows, at = len(data) // _ROW, 0
        for name, kind in _FIELDS:
            parts[name].append(np.frombuffer(data, kind, rows, at))
            at += rows * np.dtype(kind).itemsize
    return {name: np.concatenate(parts[name]) if packed else np.zeros(0, kind) for name, kind in _FIELDS}


def _take(runs: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[which] for k, v in runs.items()}


def _new(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _sorted(rows: dict[str, np.ndarray], *digits: str) -> dict[str, np.ndarray]:
    """By the digits, then in document order; a row that repeats id, text and start is left out."""
    rows = rows | {"known": 1 - rows["null"]}
    rows = _take(rows, np.lexsort([rows[c] for c in (*_ORDER, *reversed(digits))]))
    return _take(rows, _new(*(rows[c] for c in (*digits, *_ORDER))))


def _first_pass(size: int, buckets: int):
    """Runs by radix bucket. Of runs equal within what a task hands on, all but the first are repeats already."""

    def hand_on(held: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        runs = _sorted({k: np.concatenate([h[k] for h in held]) for k, _ in _FIELDS}, "digit", "content")
        lead = _new(runs["digit"], runs["content"])
        first = _take(runs, lead)
        bucket = ((first["digit"] >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(_new(bucket[order])) if len(order) else order
        names = [*bucket[order][edges].tolist(), REPEATS, COUNTS]
        packed = [_pack(_take(first, part)) for part in np.split(order, edges[1:])] if len(order) else []
        digits, each = np.unique(first["digit"], return_counts=True)
        counts = np.stack([digits[each > 1], each[each > 1].astype("<u8")], 1).tobytes()
        packed += [_pack(_take(runs, ~lead)), counts]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(packed, pa.binary())], names=["bucket", "runs"])

    def run(batches):
        held, weight = [], 0
        for batch in batches:
            ids = batch.column("doc_id")
            null, ids, hashes = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0)), np.asarray(batch.column("text_hash"))
            texts = batch.column("text").to_pylist()
            for part in by_weight(range(len(texts)), lambda i: len(texts[i]), CHUNK):
                text, digit, content, start, count = runs_of([texts[i] for i in part], size)
                row = np.array(part, np.int64)[text]
                held.append({"digit": digit, "content": content, "doc_id": ids[row], "text_hash": hashes[row], "null": null[row], "start": start, "count": count})
                weight += sum(len(texts[i]) for i in part)
                if weight >= HAND_ON:
                    yield hand_on(held)
                    held, weight = [], 0
        if held:
            yield hand_on(held)

    return run


def _run_table(runs: dict[str, np.ndarray], rivals: np.ndarray) -> pa.Table:
    return pa.table(
        {
            "doc_id": pa.array(runs["doc_id"], pa.int64(), mask=runs["null"] == 1),
            "text_hash": pa.array(runs["text_hash"]),
            "start": pa.array(runs["start"]),
            "count": pa.array((runs["count"] % TWICE).astype(np.int32)),
            "digit": pa.array(runs["digit"].view(np.int64)),
            "rivals": pa.array(rivals.astype(np.int64)),
        }
    )


def _second_pass(key, table):
    """Runs that share their digit: repeats (rivals 0), and the first of each content with all its rivals.

    A run that may hold a window twice counts as its own rival.
    """
    runs = _sorted(_unpack(table.column("runs").to_pylist()), "digit", "content")
    group = _new(runs["digit"])
    number = np.cumsum(group) - 1
    lead = _new(runs["digit"], runs["content"])
    rivals = np.bincount(number, weights=lead.astype(int) + (runs["count"] >= TWICE)).astype(np.int64)[number]
    out = ~lead | (rivals > 1)
    return _run_table(_take(runs, out), (rivals * lead)[out])


def _plain_runs(hot: np.ndarray | None = None):
    """Packed runs as rows; with ``hot``, only those with such a digit, marked with a rival."""

    def run(batches):
        for batch in batches:
            runs = _unpack(batch.column("runs").to_pylist())
            if hot is not None:
                runs = _take(runs, np.isin(runs["digit"], hot))
            yield from _run_table(runs, np.full(len(runs["digit"]), 0 if hot is None else 2)).to_batches()

    return run


def _without(hot: np.ndarray):
    def run(batches):
        for batch in batches:
            runs = [_unpack([x]) for x in batch.column("runs").to_pylist()]
            packed = [_pack(_take(r, ~np.isin(r["digit"], hot))) for r in runs]
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(packed, pa.binary())], names=["bucket", "runs"])

    return run


def _unpack_counts(batches):
    for batch in batches:
        data = np.frombuffer(b"".join(batch.column("runs").to_pylist()), "<u8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(data[:, 0].astype(np.int64)), pa.array(data[:, 1].astype(np.int64))], names=["digit", "n"])


def _contexts(size: int):
    """The bytes under the windows of each run still together with others."""

    def run(batches):
        for batch in batches:
            digit, row, start, data = [], [], [], []
            for i, (text, runs) in enumerate(zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist())):
                for r in runs:
                    digit.append(r["digit"])
                    row.append(i)
                    start.append(r["start"])
                    data.append(text[r["start"] : r["start"] + r["count"] - 1 + size])
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digit, pa.int64()), batch.column("doc_id").take(take), batch.column("text_hash").take(take), pa.array(start, pa.int32()), pa.array(data, pa.binary())],
                names=["digit", "doc_id", "text_hash", "start", "bytes"],
            )

    return run


def _windows_of(table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of the contexts, one context after the other, and how many each has."""
    texts = table.column("bytes")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lengths = np.asarray(pc.binary_length(texts)).astype(np.int64)
    # The bytes of the contexts lie one after the other in Arrow's buffer.
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    base = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset] if len(texts) else 0
    begins, counts = base + np.cumsum(lengths) - lengths, lengths - size + 1
    whole, at = np.empty(counts.sum(), np.uint64), 0
    for part in by_weight(range(len(lengths)), lengths.__getitem__, CHUNK):
        a, b, each = part[0], part[-1], counts[part[0] : part[-1] + 1]
        hashes = window_hashes(data[begins[a] : begins[b] + lengths[b]], size)[1]
        shift = begins[a : b + 1] - begins[a] - (np.cumsum(each) - each)
        whole[at : at + each.sum()] = hashes[np.arange(each.sum()) + np.repeat(shift, each)]
        at += each.sum()
    return whole, counts


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. count - 1 for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _plain(table, *columns: str) -> dict[str, np.ndarray]:
    ids = table.column("doc_id")
    plain = {"doc_id": np.asarray(ids.fill_null(0)), "null": np.asarray(ids.is_null()).astype("u1")}
    return plain | {c: np.asarray(table.column(c)) for c in columns}


def _digit_parts(table: pa.Table, limit: int):
    """The contexts in parts of whole digits, of about ``limit`` bytes or one digit each."""
    digit = np.asarray(table.column("digit"))
    order = np.argsort(digit, kind="stable")
    edges = np.append(np.flatnonzero(_new(digit[order])), len(order))
    sizes = np.add.reduceat(np.asarray(pc.binary_length(table.column("bytes")))[order], edges[:-1], dtype=np.int64)
    for part in by_weight(range(len(sizes)), sizes.__getitem__, limit):
        yield table.take(pa.array(order[edges[part[0]] : edges[part[-1] + 1]]))


def _not_first(whole: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """True where an earlier window has this digit and hash; digits are in order, equal ones in document order.

    Hashes are sorted by ranges of their own, of some ``SORTED_WINDOWS`` windows each, so that one digit of very many
    windows needs little more than its hashes.
    """
    repeated, parts = np.zeros(len(whole), bool), 1 + len(whole) // SORTED_WINDOWS
    for part in range(parts):
        at = np.flatnonzero((whole >> np.uint64(32)) % np.uint64(parts) == part) if parts > 1 else np.arange(len(whole))
        # Equal hashes stay in the order of the windows.
        at = at[np.argsort(whole[at], kind="stable")]
        repeated[at[~_new(whole[at], digit[at])]] = True
    return repeated


def _repeats_among(table: pa.Table, size: int) -> pa.Table:
    """Windows that equal an earlier one of the contexts, as runs."""
    contexts = _plain(table, "digit", "text_hash", "start")
    # A digit's contexts in document order: their windows do not overlap, so windows are in order as they come.
    contexts = _sorted(contexts | {"row": np.arange(table.num_rows)}, "digit")
    whole, counts = _windows_of(table.select(["bytes"]).take(pa.array(contexts["row"])), size)
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    number = np.cumsum(_new(contexts["digit"])).astype(np.int32)
    repeated = np.flatnonzero(_not_first(whole, number[row]))
    row = row[repeated]
    start = contexts["start"][row] + repeated - (np.cumsum(counts) - counts)[row]
    new = _new(row, start - np.arange(len(start)))
    first = np.flatnonzero(new)
    runs = _take(contexts, row[first]) | {"start": start[first], "count": np.diff(np.append(first, len(start)))}
    # Windows that follow each other in a document go back as one run.
    runs = _take(runs, np.lexsort([runs[c] for c in _ORDER]))
    end = np.cumsum(runs["count"])
    new = _new(runs["doc_id"], runs["null"], runs["text_hash"], runs["start"] - (end - runs["count"]))
    first = np.flatnonzero(new)
    head = _take(runs, first)
    count = np.add.reduceat(runs["count"], first) if len(first) else first
    return pa.table(
        {
            "doc_id": pa.array(head["doc_id"], pa.int64(), mask=head["null"] == 1),
            "text_hash": pa.array(head["text_hash"]),
            "start": pa.array(head["start"].astype(np.int32)),
            "count": pa.array(count.astype(np.int32)),
        }
    )


def _third_pass(size: int):
    """All windows of a bucket's contexts, a few digits at a time."""

    def run(key, table):
        # Equal windows share their digit, so no repeat is parted from its first.
        return pa.concat_tables(_repeats_among(part, size) for part in _digit_parts(table, SORTED_BYTES))

    return run


def _window_rows(size: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                whole, counts = _windows_of(batch, size)
                rows = _take(_plain(batch, "digit", "text_hash", "start"), np.repeat(np.arange(len(counts)), counts))
                rows["start"] = rows["start"] + _within(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows["digit"]),
                        pa.array(whole.view(np.int64)),
                        pa.array(rows["doc_id"], pa.int64(), mask=rows["null"] == 1),
                        pa.array(rows["text_hash"]),
                        pa.array(rows["start"].astype(np.int32)),
                    ],
                    names=["digit", "whole", "doc_id", "text_hash", "start"],
                )

    return run


def _remove(size: int):
    def run(batches):
        for batch in batches:
            out = []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                pieces, at, spans, removed = [], 0, 0, 0
                end = -1
                for r in sorted(gone or (), key=lambda r: r["start"]):
                    a, b = r["start"], r["start"] + r["count"] - 1 + size
                    if a > end:
                        spans += 1
                        pieces.append(text[at:a])
                    removed += max(0, b - max(a, end, 0))
                    end = at = max(end, b)
                pieces.append(text[at:])
                out.append((len(text), removed, spans, b"".join(pieces)))
            total, removed, spans, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *(pa.array(x, pa.int64()) for x in (total, removed, spans)), pa.array(kept, pa.binary())],
                names=["doc_id", "text_hash", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeated_windows(docs: DataFrame, size: int = SIZE, group_runs: int = GROUP_RUNS) -> DataFrame:
    """For each row: n_bytes, n_removed, n_spans and ``kept`` (the bytes left)."""
    spark = docs.sparkSession
    short_batches(spark)
    texts = as_bytes(docs)
    length = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + int(length / (size - GRAM + 2) * 2) // BUCKET_RUNS
    stored, path = store(texts.mapInArrow(_first_pass(size, buckets), PACKED), "runs")

    # A digit that a task hands on with one content only has at most as many runs as there are such parts.
    counts = stored.where(F.col("bucket") == COUNTS).mapInArrow(_unpack_counts, "digit long, n long")
    crowded = counts.groupBy("digit").agg(F.sum("n").alias("n")).where(F.col("n") > group_runs)
    # At most all runs / group_runs of them.
    hot = np.array([r["digit"] for r in crowded.select("digit").collect()], np.int64).view(np.uint64)
    cold = stored.where("bucket >= 0")
    if len(hot):
        cold = cold.mapInArrow(_without(hot), PACKED)
    together = materialize(cold.groupBy("bucket").applyInArrow(_second_pass, RUN), "shared-runs")
    repeats = stored.where(F.col("bucket") == REPEATS).mapInArrow(_plain_runs(), RUN)
    gone = [materialize(repeats.drop("digit", "rivals"), "repeated-runs"), together.where("rivals = 0").drop("digit", "rivals")]

    def contexts(runs: DataFrame) -> DataFrame:
        run = F.struct("start", "count", "digit")
        by_text = runs.groupBy(*KEY).agg(F.collect_set(run).alias("runs"))
        return join_rows(texts, by_text, "inner").mapInArrow(_contexts(size), CONTEXT)

    if len(hot):
        windows = contexts(stored.where("bucket >= 0").mapInArrow(_plain_runs(hot), RUN)).mapInArrow(_window_rows(size), WINDOW)
        windows = materialize(windows, "windows")
        place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_hash", "start")
        first = windows.groupBy("digit", "whole").agg(F.min(place).alias("first"))
        later = windows.join(first, ["digit", "whole"]).where(~place.eqNullSafe(F.col("first")))
        gone.append(later.select("doc_id", "text_hash", "start", F.lit(1).alias("count")))
    discard(spark, path)

    open_runs = together.where("rivals > 0")
    total = open_runs.agg(F.sum(F.col("count") + size)).first()[0] or 0
    bucket = F.pmod(F.shiftrightunsigned("digit", 33), F.lit(1 + total // BUCKET_BYTES))
    third = contexts(open_runs).groupBy(bucket.alias("bucket")).applyInArrow(_third_pass(size), GONE)
    gone.append(materialize(third, "repeated-windows"))
    release(spark)

    spans = gone[0]
    for more in gone[1:]:
        spans = spans.unionByName(more)
    by_text = spans.groupBy(*KEY).agg(F.collect_set(F.struct("start", "count")).alias("gone"))
    return join_rows(texts, by_text).mapInArrow(_remove(size), KEPT)
