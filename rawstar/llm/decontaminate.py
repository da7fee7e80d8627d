r"""Benchmark decontamination: one Aho-Corasick automaton over normalised items, one scan of each text.

A-Z are lower-cased and words are runs of ASCII letters, digits and non-ASCII characters.
The patterns are the windows of ``window`` consecutive words of an item, or all of a shorter
item. Normalising replaces bytes by bytes, so offsets in it are offsets in the original.

The automaton runs over word numbers and is sent to every task. Its size is that of the
benchmark, so items are cut into parts of at most ``part_bytes`` of text; each further
part is one more scan of the same rows, without a shuffle.

A null text or item has no words: it hits nothing. Item ids count once, however often they are
listed; a null item id is left out of the list. An empty table gives no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.common import as_bytes, short_batches

WINDOW = 10
PART_BYTES = 8_000_000
_WORD = re.compile(rb"[^ ]+")
# Separators become spaces, A-Z become a-z; everything else stays where it is.
_NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
SCANNED = "doc_id long, text_hash long, text binary, words array<int>, items array<string>"
SPAN = pa.list_(pa.int32())
RESULT = "doc_id long, text_hash long, n_words long, n_hit long, n_items long, items array<string>, spans array<struct<s:int,e:int>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Automaton:
    """Windows of the items as sequences of word numbers; 0 is any word that no item has."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            for a in range(max(1, len(ids) - window + 1)) if ids else ():
                owners.setdefault(tuple(ids[a : a + window]), set()).add(item)
        self.found = [(len(k), sorted(x for x in v if x is not None)) for k, v in owners.items()]
        self.tree = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for i, k in enumerate(owners):
            self.tree.add_word(k, i)
        if owners:
            self.tree.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs (first, last + 1) of hit words, and the items they come from."""
        ids = tuple(map(self.numbers.get, words, [0] * len(words)))
        if not self.found or not any(ids):
            return [], set()
        runs, items = [], set()
        for last, which in self.tree.iter(ids):
            size, owners = self.found[which]
            runs.append((last + 1 - size, last + 1))
            items.update(owners)
        return runs, items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(items: list[tuple[str, bytes]], window: int):
    def run(batches):
        automaton = Automaton(items, window)
        for batch in batches:
            runs, owners = [], []
            before = zip(*(batch.column(c).to_pylist() for c in ("text", "words", "items")))
            for text, words, found in before:
                new, of = automaton.scan(words_of(text))
                pairs = merged([*zip(words[::2], words[1::2]), *new])
                runs.append([x for pair in pairs for x in pair])
                owners.append(sorted({*found, *of}))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), batch.column("text"), pa.array(runs, SPAN), pa.array(owners, pa.list_(pa.string()))],
                names=["doc_id", "text_hash", "text", "words", "items"],
            )

    return run


def _report(batches):
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    for batch in batches:
        total, hit, spans = [], [], []
        for text, words in zip(batch.column("text").to_pylist(), batch.column("words").to_pylist()):
            plain = text.translate(_NORMAL)
            total.append(len(plain.split()))
            hit.append(sum(words[1::2]) - sum(words[::2]))
            where = []
            if words:
                at = [(m.start(), m.end()) for m in _WORD.finditer(plain)]
                # Code points before a byte: bytes that begin one.
                begins = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
                for a, b in zip(words[::2], words[1::2]):
                    where.append({"s": int(begins[at[a][0]]) - 1, "e": int(begins[at[b - 1][1] - 1])})
            spans.append(where)
        items = batch.column("items")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(total, pa.int64()),
                pa.array(hit, pa.int64()),
                pa.array([len(x) for x in items.to_pylist()], pa.int64()),
                items,
                pa.array(spans, span),
            ],
            names=["doc_id", "text_hash", "n_words", "n_hit", "n_items", "items", "spans"],
        )


def benchmark_parts(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> list[list[tuple[str, bytes]]]:
    """The distinct items in lists of about ``part_bytes`` of text each."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    items = items.where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // part_bytes
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    return [[(r["item"], bytes(r["text"])) for r in items.where(part == i).collect()] for i in range(parts)]


def contaminated_words(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """For each row: n_words, n_hit, n_items, items (sorted) and spans of hit words in code points."""
    short_batches(docs.sparkSession)
    rows = as_bytes(docs).withColumn("words", F.array().cast("array<int>")).withColumn("items", F.array().cast("array<string>"))
    for items in benchmark_parts(benchmark, part_bytes):
        rows = rows.mapInArrow(_scan(items, window), SCANNED)
    return rows.mapInArrow(_report, RESULT)


def _clean(items: list[tuple[str, bytes]], window: int):
    def run(batches):
        automaton = Automaton(items, window)
        for batch in batches:
            found = (automaton.scan(words_of((t or "").encode()))[0] for t in batch.column("text").to_pylist())
            yield batch.filter(pa.array([not x for x in found], pa.bool_()))

    return run


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of the benchmark occurs; no shuffle."""
    short_batches(docs.sparkSession)
    for items in benchmark_parts(benchmark, part_bytes):
        docs = docs.mapInArrow(_clean(items, window), docs.schema)
    return docs
