import random
import re
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from sensorloom.llm import decontaminate as D
from tests.llm.helpers import awkward, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items, window=13):
    own, hit, found = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        size = min(window, len(w))
        for at in range(len(w) - size + 1 if w else 0):
            for place in range(len(own) - size + 1):
                if own[place : place + size] == w[at : at + size]:
                    hit.update(range(place, place + size))
                    found.add(str(item_id))
    return len(own), hit, sorted(found)


ITEMS = [
    (3, " ".join(prose(12).split(" ")[5:30])),
    (20, prose(1).upper()),
    (100, "one two"),
    (7, None),
    (8, "..."),
    (9, "never seen words " * 9),
    (10, " ".join(prose(99, 6000).split(" ")[3000:3040])),
]


def rows_of(found):
    return sorted(
        (
            (r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], list(r["items"]))
            for r in found.collect()
        ),
        key=repr,
    )


def expected(texts):
    out = []
    for doc_id, text in texts:
        n, hit, items = brute(text, ITEMS)
        spans = []
        for at in sorted(hit):
            if spans and spans[-1][1] == at:
                spans[-1][1] = at + 1
            else:
                spans.append([at, at + 1])
        out.append((doc_id, n, spans, items))
    return out


def normal(rows):
    """Spans that touch count as one."""
    out = []
    for doc_id, n, spans, items in rows:
        merged = []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out.append((doc_id, n, merged, items))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_matches_brute_force(spark, block):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    benchmark = benchmark.selectExpr("item_id", "text", "1 AS row", "2 AS spans")
    texts = awkward()
    found = D.find_benchmark(documents(spark, texts), benchmark, block_bytes=block)
    assert normal(rows_of(found)) == normal(expected(texts))


def test_long_document_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_SYMBOLS", 64)
    phrases = D.Phrases(ITEMS)
    import pyarrow as pa

    shard = D.Shard(phrases)
    texts = [text for _, text in awkward()]
    shard.add(pa.array(texts, pa.string()))
    for text, (n, spans, items) in zip(texts, shard.results()):
        count, hit, own = brute(text, ITEMS)
        assert (n, {x for a, b in spans for x in range(a, b)}, items) == (count, hit, own)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    found = D.contamination(D.find_benchmark(documents(spark, [(1, "a b"), (2, None)]), none))
    assert {tuple(r)[:4] for r in found.collect()} == {(1, 2, 0, 0), (2, 0, 0, 0)}
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert D.find_benchmark(documents(spark, []), items).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=4))
def test_index_counts_and_places(text, phrase):
    text = np.array([*text, 0])
    index = D.FMIndex(text, 5)
    low, high = index.search(np.array([phrase]))
    places = [i for i in range(len(text)) if text[i : i + len(phrase)].tolist() == phrase]
    assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == places


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80))
def test_suffix_order(values):
    text = np.array(values)
    assert D.suffix_order(text).tolist() == sorted(range(len(values)), key=lambda i: values[i:])


def test_a_block_takes_a_few_times_its_bytes():
    """So that one of BLOCK_BYTES takes less than 400 MB in a worker."""
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**7)}" for _ in range(5000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(300))) for i in range(300)]
    D.Phrases(items[:5])
    tracemalloc.start()
    phrases = D.Phrases(items)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    size = sum(len(text) for _, text in items)
    assert len(phrases) == 300 * (300 - 12)
    assert most * D.BLOCK_BYTES / size < 400e6 and held * D.BLOCK_BYTES / size < 200e6


def test_owners_of_repeated_windows():
    text = " ".join(f"x{i}" for i in range(14))
    phrases = D.Phrases([(9, text), (10, text), (None, "x1 x2"), (9, text), (11, ""), (12, None), (10, "X2 x1")])
    owned = {tuple(words): phrases.owners(first + i) for first, group in phrases.groups(2) for i, words in enumerate(group.tolist())}
    number = {w: n for w, n in phrases.symbols.items()}
    assert len(owned) == len(phrases) == 4
    assert owned[tuple(number[f"x{i}".encode()] for i in range(13))] == ["10", "9"]
    assert owned[number[b"x1"], number[b"x2"]] == ["None"] and owned[number[b"x2"], number[b"x1"]] == ["10"]
