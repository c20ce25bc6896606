import random
import re

import numpy as np
import pyarrow as pa

from sensorloom.llm import common, jaccard as J
from sensorloom.llm.common import stored
from tests.llm.helpers import awkward, documents, edited, prose


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(texts):
    sets = [(i, shingles(t)) for i, t in texts]
    parent = {i: i for i, _ in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for at, (a, s) in enumerate(sets):
        for b, t in sets[:at]:
            if a is None or b is None or not s or not t:
                continue
            if 100 * len(s & t) >= 80 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), i if i is None else root(i)) for i, s in sets), key=repr)


def check(spark, texts):
    rows = J.similar_documents(documents(spark, texts)).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(texts)


def test_awkward_documents(spark):
    check(spark, awkward())


def test_near_copies_at_all_distances(spark):
    """Groups around the threshold, chains, a shared passage, and members of one prefix group."""
    texts, number = [], 0
    for seed in range(8):
        base = prose(seed, 120)
        for copy in range(12):
            texts.append((number, edited(base, number, copy % 5)))
            number += 3
    passage = prose(1000, 70)
    for seed in range(25):
        texts.append((number, passage + " " + prose(2000 + seed, 5 + seed)))
        number += 1
    chain = prose(3000, 100).split(" ")
    for step in range(12):
        texts.append((number, " ".join(chain[step * 4 : step * 4 + 60])))
        number += 1
    random.Random(2).shuffle(texts)
    check(spark, texts)


def test_shingle_sets_do_not_depend_on_neighbours():
    texts = ["a b c d e f", None, "", "A B  c\td e f", "one two", "x y z w v x y z w v"]
    values, first = J.shingle_sets(pa.array(texts))
    own = [values[first[i] : first[i + 1]].tolist() for i in range(len(texts))]
    assert own[0] == own[3]
    assert [len(x) for x in own] == [len(shingles(t)) for t in texts]
    for text, expected in zip(texts, own):
        assert J.shingle_sets(pa.array([text], pa.string()))[0].tolist() == expected


def test_empty_table(spark):
    check(spark, [])
    check(spark, [(1, None), (2, ""), (None, None)])


def test_all_sets_of_one_id_count(spark):
    """Where two texts of an id have equal sizes and prefixes, what is similar to one of them alone
    is linked all the same."""
    check(spark, [(i * 100 + doc_id, text) for i in range(60) for doc_id, text in cases(i)])


def cases(seed):
    """Separate groups of four rows: two texts under the id 5, one of them again, and one like the
    other. The words differ from group to group."""
    rng = random.Random(seed)
    words = [f"g{seed}x{rng.randrange(10**6)}" for _ in range(60)]
    other, like = words[:], words[:]
    other[50 + seed % 10] = f"g{seed}other"
    like[50 + seed % 10], like[40] = f"g{seed}other", f"g{seed}like"
    return [(5, " ".join(words)), (5, " ".join(other)), (90, " ".join(words)), (7, " ".join(like))]


def test_a_poor_first_member_costs_no_square_of_pairs(spark, monkeypatch):
    """Sets of the least ids share prefixes with a group of near copies, but are similar to none of
    it: the others are linked all the same before pairs are formed across components."""
    rng, words = random.Random(11), [f"w{i}" for i in range(400)]

    def copy(name, changes):
        own = words[:]
        for at in rng.sample(range(0, 400, 5), changes):
            own[at] = f"{name}at{at}"
        return " ".join(own)

    texts = [(i, copy(f"far{i}", 8)) for i in range(5)] + [(i, copy(f"near{i}", 4)) for i in range(5, 150)]
    verified, formed = J._verified, []

    def counted(pairs, *rest):
        formed.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(J, "_verified", counted)
    check(spark, texts)
    assert sum(formed) < 20 * len(texts)


def test_turns_relabel_what_shingles_join_once(spark, monkeypatch):
    """However many turns there are, postings meet the largest component of their shingle once, and
    what the turns link is one component in the end."""
    monkeypatch.setattr(J, "PAIRS_A_ROW", 0)
    monkeypatch.setattr(J, "WORTHWHILE", -1)
    monkeypatch.setattr(J, "TURNS", 3)
    mixed, drawn, calls = J._mixed, J._drawn, []
    monkeypatch.setattr(J, "_mixed", lambda *a: calls.append("mixed") or mixed(*a))
    monkeypatch.setattr(J, "_drawn", lambda *a: calls.append("drawn") or drawn(*a))
    texts, words = [], [f"w{i}" for i in range(120)]
    for i in range(40):
        rng, own = random.Random(i), words[:]
        for at in rng.sample(range(0, 120, 5), 1 + i % 3):
            own[at] = f"c{i}at{at}"
        texts.append((i * 7 % 40, " ".join(own)))
    check(spark, texts + [(100 + i, text) for i, text in awkward() if i is not None])
    assert calls.count("mixed") == 1 and calls.count("drawn") > 1


def test_only_the_sets_of_pairs_are_moved(spark):
    """Few pairs do not send all sets through a shuffle."""
    sets = stored(spark.range(2000).selectExpr("id", "2L n", "array(id, id + 1) shingles"), "sets")
    pairs = stored(spark.createDataFrame([(1, 1, 5), (2, 7, 6)], "a bigint, b bigint, c bigint"), "pairs")
    found = J._verified(pairs, sets, 30)
    assert [tuple(row) for row in found.collect()] == [(1, 1, 5)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2


def test_counts_are_sent_in_small_batches():
    """A task that counts hashes empties what it has gathered and sends it in batches of few rows."""
    rng = random.Random(4)
    held = [np.array([rng.randrange(200_000) - 100_000 for _ in range(80_000)]) for _ in range(3)]
    values, counts = np.unique(np.concatenate(held), return_counts=True)
    sent = list(common._counted(held, "h"))
    assert held == [] and max(batch.num_rows for batch in sent) <= common.SENT_HASHES < len(values)
    assert np.array_equal(np.concatenate([batch["h"] for batch in sent]), values)
    assert np.array_equal(np.concatenate([batch["count"] for batch in sent]), counts)
    assert list(common._counted([], "h")) == list(common._counted([values[:0]], "h")) == []


def test_batches_of_a_stored_table_are_cut_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    texts = spark.range(0, 400, 1, 1).selectExpr("repeat('x', 1000) text")
    rows = stored(texts.mapInArrow(sizes, "n bigint"), "sizes", 40_000).collect()
    assert sum(row["n"] for row in rows) == 400 and max(row["n"] for row in rows) < 100
    assert spark.conf.get(common.BATCH) != "40000"


def test_pairs_across_components_carry_their_components(spark, monkeypatch):
    """What is verified last is not joined to the components of all sets again, and nothing is planned
    for ids of several sets where there are none."""
    found, plans = J.components, []

    def planned(edges):
        plans.append(edges._jdf.queryExecution().optimizedPlan().toString())
        return found(edges)

    monkeypatch.setattr(J, "components", planned)
    texts = [(i, text) for i, text in awkward() if i is not None and i != 50]
    check(spark, texts)
    assert plans[-1].count("Join ") == 4 and "Join LeftOuter" not in plans[-1]
    plans.clear()
    check(spark, texts + [(21, prose(77)), (80, edited(prose(77), 3, 1))])
    assert plans[-1].count("Join LeftOuter") == 2
