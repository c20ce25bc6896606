import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sensorloom.llm import fingerprints as P
from tests.llm.helpers import awkward, documents, edited, prose


def terms(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    weights = Counter()
    for i in range(max(1, len(words) - 4) if words else 0):
        weights[tuple(words[i : i + 5]), "shingle"] += 1
    for word in words:
        weights[word] += 0.25
    return weights


def jaccard(a, b):
    least = sum(min(a[t], b[t]) for t in a.keys() & b.keys())
    return least / (sum(a.values()) + sum(b.values()) - least)


def codes(texts, samples):
    found = P.weighted_terms(pa.array(texts, pa.string()))
    return P.signatures(found.keys, len(texts), found.weights, samples=samples)[0]


def test_terms_are_counted():
    texts = ["a b c d e a b c d e", "One one", None, "", " \n", "a b c d e"]
    found = P.weighted_terms(pa.array(texts, pa.string()))
    assert (found.keys[1:] > found.keys[:-1]).all()
    for i, text in enumerate(texts):
        own = found.weights[found.keys >> np.uint64(48) == i]
        assert sorted(own) == sorted(terms(text).values())


def test_two_weightings_at_once_are_those_of_each_alone():
    """Terms that both have, alike or with other weights, and terms of one alone."""
    texts, others = [prose(1, 90), "a b a b a b a b", "", "x y"], [prose(1, 60), "a b a b", "q", ""]
    one, other = (P.weighted_terms(pa.array(t, pa.string())) for t in (texts, others))
    keys, *weights = P._both(one, other)
    for found, given in zip(P.signatures(keys, len(texts), *weights), (texts, others)):
        assert (found == codes(given, P.SAMPLES)).all()


def test_collision_rate_is_the_generalised_jaccard_similarity():
    """Over many samples the rate is the similarity, also where only weights differ."""
    base = prose(1, 80)
    pairs = [(base, edited(base, 2, 4)), (base, base + " " + prose(9, 200)), (base, prose(5, 60))]
    pairs += [("word " * 40, "word " * 10), ("a b c d e f " * 9, "a b c d e f " * 3), (base, base)]
    for a, b in pairs:
        one, two = codes([a, b], 6000)
        assert P.likeness(one, two) == pytest.approx(jaccard(terms(a), terms(b)), abs=0.03)


def test_blocks_of_terms_do_not_matter(monkeypatch):
    texts = [prose(i, n) for i, n in enumerate([3, 900, 1, 40, 2500, 7])] + ["", None]
    whole = codes(texts, 16)
    for size in (1, 5, 100_000):
        monkeypatch.setattr(P, "TERMS", size)
        assert (codes(texts, 16) == whole).all()
    for i, text in enumerate(texts):
        assert (codes([text], 16)[0] == whole[i]).all()


def expected(texts):
    """The order of the operator, with ids, edited texts and the texts that follow."""
    rows = [(i, t or "") for i, t in texts]
    for at, (i, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        changed = len(text) // 3
        yield i, text, text[: len(text) - changed] + following[:changed], following


def check(found, texts):
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == len(texts)
    for i, text, other, following in expected(texts):
        own, edit, after = codes([text, other, following], P.SAMPLES)
        row = rows[i]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(other.encode()).hexdigest())
        assert (bytes(row["fingerprint"]), bytes(row["edited_fingerprint"])) == tuple(P._pack(np.array([own, edit])))
        assert row["near_edited"] == (own == edit).mean() and row["near_next"] == (own == after).mean()


@pytest.mark.parametrize("partitions", [1, 3, 8, 40])
def test_rows_against_a_plain_walk(spark, partitions):
    """Whatever partitions the rows fall into, each is followed by the next smaller id."""
    rng = random.Random(1)
    texts = [(i, prose(i, rng.randrange(1, 60))) for i in range(50)]
    texts += [(60, None), (61, ""), (62, " \n"), (63, "é😀"), (64, "one two"), (65, prose(7, 5000)), (-4, "x" * 4000)]
    rng.shuffle(texts)
    for option, value in (("shuffle.partitions", partitions), ("adaptive.coalescePartitions.enabled", "false")):
        spark.conf.set(f"spark.sql.{option}", value)
    try:
        found = P.edit_and_compare(documents(spark, texts))
        check(found, sorted(texts, reverse=True, key=lambda row: row[0]))
        assert P.fingerprint_digest(found).filter("fingerprint rlike '^[0-9a-f]{256}$'").count() == len(texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_awkward_rows(spark):
    """Null and repeated ids, in any number, give a row each; equal texts equal fingerprints."""
    texts = awkward() + [(None, prose(8)), (None, None)]
    found = P.edit_and_compare(documents(spark, texts)).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in found) == Counter((i, len(t or "")) for i, t in texts)
    plain = P.fingerprint_documents(documents(spark, texts)).collect()
    assert Counter((r["doc_id"], bytes(r["fingerprint"])) for r in plain) == Counter(
        (r["doc_id"], bytes(r["fingerprint"])) for r in found
    )
    assert len({bytes(r["fingerprint"]) for r in plain}) == len({(" ".join((t or "").split())) for _, t in texts})


@pytest.mark.parametrize("texts", [[], [(5, prose(1))], [(5, None)], [(2, "one two"), (2, "one two")]])
def test_tables_of_few_rows(spark, texts):
    rows = P.edit_and_compare(documents(spark, texts)).collect()
    assert [r["doc_id"] for r in rows] == [i for i, _ in texts]
    assert all(r["near_next"] == 1 for r in rows)


def test_numbers_of_sixteen_bits_become_floats_exactly():
    half = np.arange(1 << 16, dtype=np.uint32)
    out = np.empty(1 << 16, np.float32)
    P.Draws._centred(half, out)
    assert np.array_equal(out, np.arange(1 << 16) + 0.5)
