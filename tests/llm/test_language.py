"""Language ID against plain versions: document frequencies, follow-the-regularised-leader, temperature."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rawstar.llm import language
from rawstar.llm.common import keyed


def plain_leader(x, y, classes, rounds):
    """The update of one weight at a time, from its formula."""
    z, n = {}, {}

    def weight(i, c):
        zi = z.get((i, c), 0.0)
        if abs(zi) <= language.L1:
            return 0.0
        return -(zi - math.copysign(language.L1, zi)) / ((language.BETA + math.sqrt(n.get((i, c), 0.0))) / language.ALPHA + language.L2)

    for _ in range(rounds):
        for (at, value), label in zip(x, y):
            logits = [sum(v * weight(i, c) for i, v in zip(at, value)) for c in range(classes)]
            top = max(logits)
            total = sum(math.exp(q - top) for q in logits)
            old = {(i, c): weight(i, c) for i in at for c in range(classes)}
            for c in range(classes):
                error = math.exp(logits[c] - top) / total - (c == label)
                for i, v in zip(at, value):
                    g, before = v * error, n.get((i, c), 0.0)
                    sigma = (math.sqrt(before + g * g) - math.sqrt(before)) / language.ALPHA
                    z[i, c] = z.get((i, c), 0.0) + g - sigma * old[i, c]
                    n[i, c] = before + g * g
    return weight


def test_follow_the_leader_equals_the_plain_update():
    r = random.Random(1)
    x, y = [], []
    for _ in range(60):
        label = r.randrange(3)
        at = sorted(r.sample(range(label * 5, label * 5 + 20), 6))
        x.append((np.array(at), np.array([r.random() for _ in at])))
        y.append(label)
    got = language.follow_leader(x, np.array(y), 3, rounds=2)
    want = plain_leader([(list(map(int, a)), list(map(float, v))) for a, v in x], y, 3, 2)
    table = np.array([[want(i, c) for c in range(3)] for i in range(40)])
    assert np.allclose(got[:40], table, atol=1e-12) and not got[40:].any()
    assert (table == 0).any() and (table != 0).any()  # the first penalty leaves zeros


def test_temperature_has_the_least_log_loss():
    r = np.random.default_rng(2)
    y = r.integers(0, 3, 400)
    logits = 4 * (np.eye(3)[y] + r.normal(0, 1.2, (400, 3)))

    def loss(t):
        e = np.exp(logits / t - (logits / t).max(1, keepdims=True))
        return -np.log((e / e.sum(1, keepdims=True))[np.arange(400), y]).mean()

    found = language.temperature(logits, y)
    assert found > 1 and loss(found) <= min(loss(t) for t in np.exp(np.linspace(-3, 3, 2000))) + 1e-6


def test_document_frequencies_count_all_rows(documents):
    texts = ["ab ab", "AB!", None, "", "b c 12", "ab", "xyz " * 5000]
    rows = documents([(i, t) for i, t in enumerate(texts * 3)])
    model = language.train(keyed(rows.where("text is not null"), "lang"))
    # A text without letters is no document of the model.
    counts = [language.counts_of([t])[0][0] > 0 for t in texts * 3 if t]
    want = np.array([math.log((1 + len(counts)) / (1 + n)) + 1 if n else 0.0 for n in np.sum(counts, 0)])
    assert np.allclose(model.idf, want)


def test_too_many_labels_are_an_error(documents, monkeypatch):
    monkeypatch.setattr(language, "MOST_LABELS", 3)
    rows = documents([(i, f"text {i}") for i in range(12)])
    few = rows.withColumn("lang", (F.col("doc_id") % 3).cast("string"))
    assert language.identify(few, F.lit(True)).count() == 12
    with pytest.raises(ValueError, match="more than 3 labels"):
        language.identify(rows.withColumn("lang", F.col("doc_id").cast("string")), F.lit(True))
