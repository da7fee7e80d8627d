"""LM scoring: a hidden Markov language model over words, trained by Baum-Welch.

Documents are cut once into blocks: the distinct words of a block, as 64-bit hashes with their
training counts, and each document's words as numbers in that list. Word counts are summed over
all training documents by sending each block's list, not its words, to hash buckets, which
answer with the totals.

A word is emitted by way of its class. Words with ``OWN`` training tokens are classes of their own,
however many there are; the others share ``SHAPES`` classes by their last three bytes; the end is a
class. Inside a shape of n tokens and v words a word seen c times has probability
(c + 1) / (n + v + 1), the last slot for words never seen. States emit classes.

Each Baum-Welch round gives expected counts from every training token. Those of own words are a
table in hash buckets: a block sends the counts of its words, a bucket adds them up and answers
each block with its words' sums, which are joined to the block in the next round. The driver holds
the shapes, the transitions and one total for each state. Counts and scores are over whole
texts; scores are the exact log10 likelihood by the scaled forward recursion.

The sequences are stored once, in buckets of blocks, and never shuffled: a round moves only
the blocks' word counts and weights.

A null text is empty: only the end. Rows that repeat count each time. Without training
documents every class is equally likely. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.llm.common import as_bytes, by_weight, discard, mix, odd_multipliers, release, short_batches, store, store_bucketed

STATES, ROUNDS, PSEUDO = 8, 6, 0.01
OWN, SHAPES = 20, 1024
# Tokens whose messages a task holds at once.
PART = 150_000
# Bytes of text in a block at most, and those that are worth a task of their own; words of all lists in a hash bucket.
BLOCK_BYTES = 84 << 20
LEAST_BYTES = 24 << 20
BUCKET_WORDS = 600_000
# Tokens scored together, and bytes of a block's rows handed on at a time.
SCORED = 16_000_000
HANDED = 4 << 20
# Bytes that a row counts for besides its text.
ROW_BYTES = 200
END = 0

ASKED = "bucket int, block long, words binary, counts binary, shapes binary"
ANSWER = "bucket int, block long, words binary, totals binary, weights binary, shape int, n long, v long, sums array<double>"
READY = "block long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, inner double, classes binary, own binary"
COUNTED = "bucket int, block long, words binary, weights binary, at int, sums array<double>"
WEIGHTS = "bucket int, block long, weights binary"
SCORED_AS = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


class _Numbers(dict):
    """Numbers words as they are asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Block:
    """Numbers the words of one block as they come."""

    def __init__(self):
        self.numbers = _Numbers()
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, doc_id, held: bool, text: bytes) -> None:
        words = text.lower().split()
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words))
        self.rows.append((doc_id, held, ids))
        self.bytes += len(text) + ROW_BYTES

    def out(self, block: int):
        """The block's word list, then its rows a few at a time."""
        size = len(self.numbers)
        counts = np.zeros(size, np.int64)
        for part in by_weight((ids for _, held, ids in self.rows if not held), len, HANDED):
            counts += np.bincount(np.concatenate(part), minlength=size)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.numbers), np.uint64, size)
        shapes = np.fromiter((xxhash.xxh3_64_intdigest(w[-3:]) % SHAPES for w in self.numbers), np.uint16, size)
        self.numbers.clear()
        order = np.argsort(hashes)
        rank = np.empty(size, np.uint32)
        rank[order] = np.arange(size, dtype=np.uint32)
        lists = (hashes[order], counts[order].astype("<u4"), shapes[order])
        yield _cut_batch(block, [None], [None], *([x.tobytes()] for x in lists))
        for part in by_weight(self.rows, lambda r: 4 * len(r[2]), HANDED):
            none = [None] * len(part)
            yield _cut_batch(block, [r[0] for r in part], [r[1] for r in part], [rank[r[2]].tobytes() for r in part], none, none)


def _cut_batch(block: int, docs: list, held: list, *payload: list) -> pa.RecordBatch:
    columns = [pa.array([block] * len(docs), pa.int64()), pa.array(docs, pa.int64()), pa.array(held, pa.bool_())]
    return pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.binary()) for x in payload)], names=[x.split()[0] for x in CUT.split(", ")])


CUT = "block long, doc_id long, held_out boolean, payload binary, counts binary, shapes binary"


def _cut(limit: int):
    def run(batches):
        from pyspark import TaskContext

        number, block = TaskContext.get().partitionId() << 24, _Block()
        for batch in batches:
            for doc, held, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
                block.add(doc, held, text)
                if block.bytes >= limit:
                    yield from block.out(number)
                    number, block = number + 1, _Block()
        if block.rows:
            yield from block.out(number)

    return run


def blocks_of(total: int, cores: int) -> int:
    """Blocks for so many bytes: two for each core if that leaves them ``LEAST_BYTES``, but none of more than ``BLOCK_BYTES``.

    Each block gets and sends its words once a round, and larger blocks share more of them.
    """
    return max(1, -(-total // BLOCK_BYTES), min(2 * cores, -(-total // LEAST_BYTES)))


def _slices(words: np.ndarray, buckets: int) -> tuple[np.ndarray, list[slice]]:
    """The hash buckets of sorted words, and each one's slice."""
    bucket = (((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[edges], [slice(a, b) for a, b in zip(edges, np.append(edges[1:], len(words)))]


def _ask(buckets: int):
    """The word lists by hash bucket; lists are sorted, so each bucket is a slice."""

    def run(batches):
        for batch in batches:
            for block, payload, counts, shapes in zip(*(batch.column(c).to_pylist() for c in ("block", "payload", "counts", "shapes"))):
                words, counts, shapes = np.frombuffer(payload, "<u8"), np.frombuffer(counts, "<u4"), np.frombuffer(shapes, "<u2")
                bucket, slices = _slices(words, buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket, pa.int32()),
                        pa.array([block] * len(bucket), pa.int64()),
                        *(pa.array([x[s].tobytes() for s in slices], pa.binary()) for x in (words, counts, shapes)),
                    ],
                    names=["bucket", "block", "words", "counts", "shapes"],
                )

    return run


def _noise(words: np.ndarray, states: int) -> np.ndarray:
    """Gamma(4) values for each word and state, the same wherever the word is met."""
    factors = odd_multipliers(4 * states, 41).reshape(states, 4)
    even = lambda f: ((mix(words * f) >> np.uint64(11)).astype(float) + 0.5) / 2**53
    return np.stack([-sum(np.log(even(f)) for f in row) for row in factors], 1)


def _total(states: int):
    """Totals of the bucket's words: an answer for each block, its own words' first weights, and class sizes."""

    def run(key, table):
        lists = [np.frombuffer(x, "<u8") for x in table.column("words").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()]).astype(np.int64)
        shapes = np.concatenate([np.frombuffer(x, "<u2") for x in table.column("shapes").to_pylist()])
        words, first, number = np.unique(np.concatenate(lists), return_index=True, return_inverse=True)
        total = np.bincount(number, weights=counts).astype(np.int64)
        own = total >= OWN
        rare = ~own & (total > 0)
        n = np.bincount(shapes[first][rare], weights=total[rare], minlength=SHAPES).astype(np.int64)
        v = np.bincount(shapes[first][rare], minlength=SHAPES)
        used = np.flatnonzero(v)
        weights = _noise(words[own], states) * (total[own, None] + 0.5)
        place = np.cumsum(own) - 1
        numbers = np.split(number, np.cumsum([len(x) for x in lists])[:-1])
        a, u = len(lists), len(used)
        none = [None]
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()] * (a + u + 1), pa.int32()),
                "block": pa.array(table.column("block").to_pylist() + none * (u + 1), pa.int64()),
                "words": pa.array([x.tobytes() for x in lists] + none * (u + 1), pa.binary()),
                "totals": pa.array([total[x].astype("<i8").tobytes() for x in numbers] + none * (u + 1), pa.binary()),
                "weights": pa.array([weights[place[x[own[x]]]].astype("<f4").tobytes() for x in numbers] + none * (u + 1), pa.binary()),
                # After the shapes, a row for the own words.
                "shape": pa.array(none * a + used.tolist() + [SHAPES], pa.int32()),
                "n": pa.array(none * a + n[used].tolist() + [int(total[own].sum())], pa.int64()),
                "v": pa.array(none * a + v[used].tolist() + [int(own.sum())], pa.int64()),
                "sums": pa.array(none * (a + u) + [weights.sum(0).tolist()], pa.list_(pa.float64())),
            }
        )

    return run


@dataclass
class Vocabulary:
    """Sizes of the training data and of the classes on the driver: the end, then the shapes."""

    tokens: int
    distinct: int
    sizes: np.ndarray
    words: np.ndarray
    ends: int

    def class_counts(self) -> np.ndarray:
        return np.concatenate([[self.ends], self.sizes]).astype(float)


@dataclass
class Sequences:
    """The rows as class sequences, a list of own words for each block, and the first weights of these."""

    rows: DataFrame
    weights: DataFrame
    path: str
    buckets: int
    own: int  # distinct own words
    sums: np.ndarray  # of their first weights, by state


def _prepare(vocabulary: Vocabulary):
    """Each document of a block: its unigram score, the words' chances inside their classes, and the classes."""
    slots = math.log10(vocabulary.tokens + vocabulary.distinct + 1)

    def run(left, right):
        is_list = np.asarray(left.column("counts").combine_chunks().is_valid())
        shapes = np.frombuffer(left.select(["shapes"]).filter(pa.array(is_list)).column("shapes")[0].as_py(), "<u2")
        order = np.argsort(np.asarray(right.column("bucket"))) if right.num_rows else []
        totals = [np.frombuffer(right.column("totals")[int(i)].as_py(), "<i8") for i in order]
        hashes = [np.frombuffer(right.column("words")[int(i)].as_py(), "<u8") for i in order]
        c = np.concatenate(totals) if totals else np.zeros(0, np.int64)
        words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        is_own = c >= OWN
        classes = (1 + shapes).astype(np.uint32)
        classes[is_own] = 1 + SHAPES + np.arange(is_own.sum())
        base = np.log10(c + 1) - slots
        inside = np.log10(c + 1) - np.log10(vocabulary.sizes[shapes] + vocabulary.words[shapes] + 1)
        inside[is_own] = 0.0
        block = left.column("block")[0].as_py()
        names = [x.split()[0] for x in READY.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
        table = lambda out: pa.table({n: pa.array(x, k) for n, x, k in zip(names, zip(*out), kinds)})
        parts = [table([(block, *[None] * 7, words[is_own].tobytes())])]
        for batch in left.select(["doc_id", "held_out", "payload", "counts"]).to_batches(max_chunksize=1000):
            out = []
            for doc, held, payload, listed in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "held_out", "payload", "counts"))):
                if listed is None:
                    ids = np.frombuffer(payload, "<u4")
                    end = math.log10(vocabulary.ends + 1) - slots
                    known = int((c[ids] > 0).sum()) + (vocabulary.ends > 0)
                    sequence = np.append(classes[ids], np.uint32(END)).tobytes()
                    out.append((block, doc, held, len(ids) + 1, known, float(base[ids].sum()) + end, float(inside[ids].sum()), sequence, None))
            if out:
                parts.append(table(out))
        return pa.concat_tables(parts)

    return run


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # (class, state)
    total: np.ndarray | None = None  # of all weights, by state

    def of_block(self, weights: np.ndarray) -> Model:
        """The model with the own words of a block as further classes."""
        return Model(self.start, self.move, np.concatenate([self.emit, weights / self.total]))


@dataclass
class Trained:
    model: Model
    weights: DataFrame  # of own words, by block
    path: str


def first_model(counts: np.ndarray, own: np.ndarray) -> Model:
    states = len(own)
    noise = np.random.default_rng(40).gamma(4.0, size=(len(counts), states))
    emit = noise * (counts[:, None] + 0.5)
    total = emit.sum(0) + own
    move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    even = np.full(states, 1 / states)
    return Model(even, move, emit / total, total)


def _side_by_side(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequences' order, longest first; how many still run at each step; and their symbols step by step."""
    lengths = np.array([len(x) for x in sequences])
    order = np.argsort(-lengths, kind="stable")
    active = np.searchsorted(-lengths[order], -np.arange(1, lengths.max(initial=0) + 1), side="right")
    begins = np.append(0, np.cumsum(active))
    symbols = np.empty(begins[-1], np.uint32)
    for i, which in enumerate(order):
        symbols[begins[: lengths[which]] + i] = sequences[which]
    return order, active, symbols


def expected_counts(model: Model, sequences: list[np.ndarray], cells: int = PART):
    """Baum-Welch counts of whole sequences: (class, state), (state, state), first states, and the log likelihood.

    All sequences run side by side. Messages are held for about ``cells`` symbols: the forward
    pass keeps what enters each stretch of steps, and the backward pass goes through the
    stretches from the last to the first, computing each one's forward messages again.
    """
    s, move, emit = len(model.start), model.move, model.emit
    start, turned = model.start[:, None], np.ascontiguousarray(move.T)
    emitted, moved, started, log_likelihood = np.zeros((s, len(emit))), np.zeros((s, s)), np.zeros(s), 0.0
    _, active, symbols = _side_by_side([x for x in sequences if len(x)])
    if not len(active):
        return emitted.T, moved, started, log_likelihood
    begins = np.append(0, np.cumsum(active))
    stretches, at = [], 0
    while at < len(active):
        upto = max(at + 1, int(np.searchsorted(begins, begins[at] + cells, side="right")) - 1)
        stretches.append((at, upto))
        at = upto

    def forward(first: int, upto: int, before: np.ndarray | None):
        """Chances, scaled messages and scales of the steps: a row for each state, a column for each symbol."""
        base = begins[first]
        chance = np.ascontiguousarray(emit.take(symbols[base : begins[upto]], 0).T)
        alpha, scale = np.empty_like(chance), np.empty(chance.shape[1])
        for t in range(first, upto):
            a, b = begins[t] - base, begins[t + 1] - base
            now = chance[:, a:b] * (start if before is None else turned @ before[:, : b - a])
            level = np.sum(now, 0, out=scale[a:b])
            before = np.divide(now, level, out=alpha[:, a:b])
        return chance, alpha, scale

    entering, kept = [], None
    before = None
    for first, upto in stretches:
        entering.append(before)
        kept = forward(first, upto, before)
        log_likelihood += float(np.log(kept[2]).sum())
        before = kept[1][:, begins[upto - 1] - begins[first] :].copy()
    beta = np.ones((s, active[0]))
    for (first, upto), before in zip(reversed(stretches), reversed(entering)):
        chance, alpha, scale = kept or forward(first, upto, before)
        kept, base = None, begins[first]
        chance /= scale
        gamma = np.empty_like(alpha)
        for t in range(upto - 1, first - 1, -1):
            a, b = begins[t] - base, begins[t + 1] - base
            here = beta[:, : b - a]
            np.multiply(alpha[:, a:b], here, out=gamma[:, a:b])
            if t:
                earlier = alpha[:, begins[t - 1] - base : a] if t > first else before
                back = chance[:, a:b] * here
                moved += earlier[:, : b - a] @ back.T
                np.matmul(move, back, out=here)
            else:
                started += gamma[:, a:b].sum(1)
        own = symbols[base : begins[upto]]
        for k in range(s):
            emitted[k] += np.bincount(own, weights=gamma[k], minlength=len(emit))
    return emitted.T, moved * move, started, log_likelihood


def _block(left, right, states: int) -> tuple[np.ndarray, np.ndarray, pa.Array, list[np.ndarray]]:
    """The own words of a block, their weights, which rows are documents, and the documents' classes, not copied."""
    is_list = left.column("own").combine_chunks().is_valid()
    words = np.frombuffer(left.select(["own"]).filter(is_list).column("own")[0].as_py(), "<u8")
    order = np.argsort(np.asarray(right.column("bucket"))) if right.num_rows else []
    weights = b"".join(right.column("weights")[int(i)].as_py() for i in order)
    texts = []
    for chunk in left.column("classes").chunks:
        edges = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1].tolist()
        data = np.frombuffer(chunk.buffers()[2] or b"", np.uint8)
        texts += [data[a:b].view("<u4") for a, b, x in zip(edges, edges[1:], chunk.is_valid().to_pylist()) if x]
    return words, np.frombuffer(weights, "<f4").reshape(len(words), states), pc.invert(is_list), texts


def _count(model: Model, buckets: int):
    """Expected counts of a block: of its own words by bucket, and the rows that the driver adds up."""
    states = len(model.start)

    def run(left, right):
        words, weights, _, texts = _block(left, right, states)
        block, here = left.column("block")[0].as_py(), model.of_block(weights)
        emitted, moved, started, likelihood = expected_counts(here, texts)
        shared, own = emitted[: 1 + SHAPES], emitted[1 + SHAPES :]
        sums = np.concatenate([shared, moved, started[None], np.full((1, states), likelihood / states), own.sum(0)[None]])
        at = np.flatnonzero(sums.any(1))
        bucket, slices = _slices(words, buckets)
        a, u, none = len(bucket), len(at), [None]
        return pa.table(
            {
                "bucket": pa.array(bucket.tolist() + none * u, pa.int32()),
                "block": pa.array([block] * a + none * u, pa.int64()),
                "words": pa.array([words[x].tobytes() for x in slices] + none * u, pa.binary()),
                "weights": pa.array([own[x].astype("<f4").tobytes() for x in slices] + none * u, pa.binary()),
                "at": pa.array(none * a + at.tolist(), pa.int32()),
                "sums": pa.array(none * a + sums[at].tolist(), pa.list_(pa.float64())),
            }
        )

    return run


def _add(states: int):
    """The counts of the bucket's words over all blocks, as an answer for each block."""

    def run(key, table):
        lists = [np.frombuffer(x, "<u8") for x in table.column("words").to_pylist()]
        counts = np.frombuffer(b"".join(table.column("weights").to_pylist()), "<f4").reshape(-1, states)
        _, number = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.stack([np.bincount(number, weights=counts[:, k]) for k in range(states)], 1) + PSEUDO
        numbers = np.split(number, np.cumsum([len(x) for x in lists])[:-1])
        return pa.table(
            {
                "bucket": table.column("bucket"),
                "block": table.column("block"),
                "weights": pa.array([total[x].astype("<f4").tobytes() for x in numbers], pa.binary()),
            }
        )

    return run


def train(ready: Sequences, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[Trained, list[float]]:
    """The model after ``rounds`` over the rows that are not held out, and each round's log likelihood."""
    spark, states = ready.rows.sparkSession, len(ready.sums)
    model, likelihoods = first_model(counts, ready.sums), []
    weights, path = ready.weights, ready.path
    learn = ready.rows.where("own is not null or not held_out").select("block", "classes", "own")
    for _ in range(rounds):
        joined = learn.groupBy("block").cogroup(weights.groupBy("block"))
        counted, counts_path = store(joined.applyInArrow(_count(model, ready.buckets), COUNTED), "word-counts")
        total = np.zeros((len(counts) + states + 3, states))  # one row for each class, state and three more
        rows = counted.where("at is not null").groupBy("at").agg(*[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(states)])
        for r in rows.collect():
            total[r["at"]] = r[1:]
        by_bucket = counted.where("bucket is not null").select("bucket", "block", "words", "weights").groupBy("bucket")
        # The round's weights and their shuffle go before the next ones are made.
        discard(spark, path)
        weights, path = store(by_bucket.applyInArrow(_add(states), WEIGHTS), "word-weights")
        discard(spark, counts_path)
        emitted, moved, (started, likelihood, own) = total[: len(counts)], total[len(counts) : -3], total[-3:]
        likelihoods.append(float(likelihood.sum()))
        # A pseudo count keeps every class possible in every state.
        emitted = emitted + PSEUDO
        share = emitted.sum(0) + own + PSEUDO * ready.own
        model = Model(
            (started + PSEUDO) / (started + PSEUDO).sum(),
            (moved + PSEUDO) / (moved + PSEUDO).sum(1, keepdims=True),
            emitted / share,
            share,
        )
    return Trained(model, weights, path), likelihoods


def log10_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Scaled forward recursion over whole sequences, side by side, the longest first."""
    order, active, symbols = _side_by_side(sequences)
    begins = np.append(0, np.cumsum(active))
    out = np.zeros(len(sequences))
    ahead, turned = model.start[:, None], np.ascontiguousarray(model.move.T)
    for t, n in enumerate(active):
        now = model.emit.take(symbols[begins[t] : begins[t + 1]], 0).T * ahead[:, :n]
        scale = now.sum(0)
        out[:n] += np.log10(scale)
        ahead = turned @ (now / scale)
    result = np.empty(len(sequences))
    result[order] = out
    return result


def _score(model: Model):
    names = [x.split()[0] for x in SCORED_AS.split(", ")]

    def run(left, right):
        _, weights, is_text, texts = _block(left, right, len(model.start))
        rows = left.select([*names[:-1], "inner"]).filter(is_text)
        here, inner = model.of_block(weights), np.asarray(rows.column("inner"))
        parts = [log10_likelihoods(here, p) for p in by_weight(texts, len, SCORED)]
        score = inner + np.concatenate(parts) if parts else inner
        return rows.select(names[:-1]).append_column(names[-1], pa.array(score))

    return run


def prepared(docs: DataFrame, held: Column, states: int = STATES) -> tuple[Sequences, Vocabulary]:
    """All documents as class sequences with their unigram scores, and the vocabulary's sizes."""
    spark = docs.sparkSession
    texts = as_bytes(docs).select("doc_id", held.alias("held_out"), "text")
    total = texts.agg(F.sum(F.octet_length("text") + F.lit(ROW_BYTES).cast("long"))).first()[0] or 0
    blocks = blocks_of(total, spark.sparkContext.defaultParallelism)
    # Whole input splits go to a block; one is cut again only if its splits are a quarter larger than others.
    limit = min(BLOCK_BYTES, total // blocks) * 5 // 4 + 1
    cut, path = store_bucketed(texts.coalesce(blocks).mapInArrow(_cut(limit), CUT), "block", "word-blocks")
    lists = cut.where("counts is not null")
    words = lists.agg(F.sum(F.octet_length("payload") / 8)).first()[0] or 0
    buckets = 1 + int(words) // BUCKET_WORDS
    asked = lists.mapInArrow(_ask(buckets), ASKED)
    ends = cut.where("counts is null and not held_out").count()
    trained = cut.where("counts is null and not held_out").agg(F.sum(F.octet_length("payload") / 4)).first()[0] or 0
    answer, answers = store(asked.groupBy("bucket").applyInArrow(_total(states), ANSWER), "word-totals")
    release(spark)
    sizes, kinds, sums = np.zeros(SHAPES + 1, np.int64), np.zeros(SHAPES + 1, np.int64), np.zeros(states)
    by_state = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(states)]
    for r in answer.where("shape is not null").groupBy("shape").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), *by_state).collect():
        sizes[r["shape"]], kinds[r["shape"]] = r["n"], r["v"]  # SHAPES + 1 rows at most
        if r["shape"] == SHAPES:
            sums = np.array(r[3:])
    distinct = int(kinds.sum()) + (ends > 0)
    vocabulary = Vocabulary(int(trained) + ends, distinct, sizes[:-1], kinds[:-1], ends)
    answer = answer.where("block is not null")
    totals = answer.select("bucket", "block", "words", "totals")
    joined = cut.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(_prepare(vocabulary), READY)
    rows, _ = store_bucketed(joined, "block", "class-sequences")
    discard(spark, path)
    return Sequences(rows, answer.select("bucket", "block", "weights"), answers, buckets, int(kinds[-1]), sums), vocabulary


def score(docs: DataFrame, held: Column, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row."""
    short_batches(docs.sparkSession)
    ready, vocabulary = prepared(docs, held, states)
    trained, _ = train(ready, vocabulary.class_counts(), rounds)
    joined = ready.rows.groupBy("block").cogroup(trained.weights.groupBy("block"))
    scored = joined.applyInArrow(_score(trained.model), SCORED_AS)
    return scored.withColumn("train_tokens", F.lit(vocabulary.tokens).cast("long"))
