import hashlib
import random

import numpy as np

from sensorloom.llm import substrings as S
from tests.llm.helpers import awkward, documents, edited, prose


def brute(texts):
    raw = [(i, (t or "").encode()) for i, t in texts]
    first = {}
    for doc_id, text in raw:
        if doc_id is not None:
            for at in range(len(text) - S.MATCH + 1):
                part = text[at : at + S.MATCH]
                first[part] = min(first.get(part, doc_id), doc_id)
    rows = []
    for doc_id, text in raw:
        gone = bytearray(len(text))
        if doc_id is not None:
            for at in range(len(text) - S.MATCH + 1):
                if first[text[at : at + S.MATCH]] < doc_id:
                    gone[at : at + S.MATCH] = b"\1" * S.MATCH
        kept = bytes(c for c, g in zip(text, gone) if not g)
        spans = sum(g and not (at and gone[at - 1]) for at, g in enumerate(gone))
        rows.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=repr)


def check(spark, texts):
    rows = S.repeat_digest(S.remove_repeats(documents(spark, texts))).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(texts)


def mixed():
    rng, texts = random.Random(4), []
    passages = [prose(900 + i, 15) for i in range(6)]
    for number in range(80):
        parts = [prose(rng.randrange(60), rng.randrange(1, 30)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passages)[rng.randrange(20) :])
        texts.append((rng.randrange(1000), " ".join(parts)))
    for seed in range(10):
        texts.append((2000 + seed, edited(texts[0][1], seed, 2)))
    return list(dict(texts).items())


def test_awkward_documents(spark):
    check(spark, awkward())


def test_passages_and_edges(spark):
    text = prose(5, 40)
    exact = text[:50]
    texts = [(9, "<" + exact + ">"), (3, exact), (5, exact[:-1]), (7, exact + exact), (1, text[30:])]
    texts += [(11, text), (12, "é" * 40), (13, "x" + "é" * 40), (14, "ab" * 60), (15, "ba" * 60)]
    check(spark, texts)
    check(spark, mixed())


def test_hot_anchors_go_by_window(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_LEAST", 2)
    check(spark, mixed())


def test_blocks_of_whole_groups(spark, monkeypatch):
    rows = [(a, p, (7 * p) % 5, b"") for a in range(6) for p in range(a * 4, a * 4 + 4)]
    texts = {p: (prose(a, 40)[:60] + prose(100 + p, 9)[:16]).encode()[:76] for a, p, _, _ in rows}
    import pyarrow as pa

    def found(size):
        monkeypatch.setattr(S, "BLOCK_ROWS", size)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(x) for x in zip(*[(a, p, d, texts[p]) for a, p, d, _ in rows])],
            names=["anchor", "place", "doc", "body"],
        )
        return sorted(tuple(r.values()) for b in S._factor_rows(iter([batch])) for r in b.to_pylist())

    # In each group all but the one of the least doc have the common part from an earlier one.
    assert len(found(1)) == 18 and found(1) == found(5) == found(1000)


def test_previous_factors():
    rng = np.random.default_rng(0)
    for _ in range(50):
        value = rng.integers(0, 5, 30)
        common = rng.choice([0, 20, S.MATCH], 30)
        common[0] = 0
        got = S.previous_factors(value, common) >= S.MATCH
        for at in range(30):
            low, high = at, at
            while low > 0 and common[low] >= S.MATCH:
                low -= 1
            while high + 1 < 30 and common[high + 1] >= S.MATCH:
                high += 1
            assert got[at] == (value[low : high + 1].min() < value[at])


def test_empty_table(spark):
    check(spark, [])
