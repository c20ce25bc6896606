import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from sensorloom.llm import spelling as S
from tests.llm.helpers import awkward, documents, prose


def counted(texts, every=199):
    total = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            number = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if number % every == 0:
                at = number % len(word)
                word = word[:at] + word[at + 1 :]
            total[word] += 1
    return total


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(words, ratio=5):
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    best = {w: min(near[w], key=lambda o: (-words[o], o), default=None) for w in words}
    form = {w: b if b is not None and words[b] >= ratio * words[w] else None for w, b in best.items()}

    def root(word):
        return word if form[word] is None else root(form[word])

    return sorted(
        (w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()
    )


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def lists(seed, alphabet, count, length):
    """Words that lie close together: random ones and their edits."""
    rng = random.Random(seed)
    found = {"".join(rng.choice(alphabet) for _ in range(rng.randint(*length))) for _ in range(count)}
    for word in sorted(found):
        at = rng.randrange(len(word))
        found |= {word[:at] + word[at + 1 :], word[:at] + rng.choice(alphabet) + word[at + 1 :]}
        found.add(word[:at] + rng.choice(alphabet) + word[at:])
    return {w: rng.choice([1, 2, 5, 6, 30, 200, 5000]) for w in sorted(found) if w}


@pytest.mark.parametrize("most, seed", [(2, 0), (7, 1), (512, 1)])
def test_words_against_every_pair(spark, seed, most):
    """Small bucket limits force the splitting of ranges down to single places."""
    words = lists(seed, "abé" if seed else "abcd😀", 120, (1, 9))
    table = spark.createDataFrame(list(words.items()), "word string, n int")
    assert rows(S.spelling_groups(table, most=most)) == grouped(words)
    pairs = S.near_words(table, most).select("word", "near").collect()
    assert len(pairs) == len(set(pairs))


def test_a_bucket_over_many_blocks_and_batches(spark):
    """Hundreds of words that share a beginning, across blocks and Arrow batches."""
    words = {"shared" + w: n for w, n in lists(5, "abcdef", 300, (3, 5)).items()}
    table = spark.createDataFrame(list(words.items()), "word string, n int")
    expected = grouped(words)
    assert rows(S.spelling_groups(table, most=100_000)) == expected
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        assert rows(S.spelling_groups(table, most=100_000)) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_chains_end_at_the_last_form(spark):
    words = {"spelling"[: 8 - i] if i else "spelling": 10**6 // 5**i for i in range(7)}
    table = spark.createDataFrame(list(words.items()), "word string, n int")
    assert {r["root"] for r in S.spelling_groups(table).collect()} == {"spelling"}
    # Equal numbers: the smallest near word; exactly five times is enough.
    tied = {"abcdef": 2, "abcdeg": 10, "abcdee": 10, "abcdeé": 10}
    table = spark.createDataFrame(list(tied.items()), "word string, n int")
    assert rows(S.spelling_groups(table)) == grouped(tied)
    assert {r["word"]: r["form"] for r in S.spelling_groups(table).collect()}["abcdef"] == "abcdee"


@pytest.mark.parametrize("every", [3, 199])
def test_texts(spark, every):
    rng = random.Random(2)
    names = ["Letter", "letTer", "lettre", "ÀÉÎ×÷ñandÚ", "ordinary", "ordinarÿ", "x" * 4000, "a1b", "naïveté"]
    texts = awkward() + [(100 + i, " ".join(rng.choice(names) for _ in range(40))) for i in range(60)]
    texts += [(100, texts[-1][1])] * 7
    expected = {w: n for w, n in counted(texts, every).items() if len(w) >= 6 and n >= 5}
    found = S.spelling_variants(documents(spark, texts), every=every)
    assert rows(found) == grouped(expected)
    assert len(expected) > 5


def test_a_run_of_one_letter_may_vanish(spark):
    """Errors in short runs leave empty words, which are no words."""
    texts = [(i, "a b c abcdefg") for i in range(400)]
    expected = {w: n for w, n in counted(texts).items() if len(w) >= 6 and n >= 5}
    assert rows(S.spelling_variants(documents(spark, texts))) == grouped(expected)


def test_empty(spark):
    assert S.spelling_variants(documents(spark, [])).collect() == []
    assert S.spelling_variants(documents(spark, [(1, None), (None, ""), (2, prose(1, 3))])).collect() == []
    blank = spark.createDataFrame([(None, 9), ("", 9), ("a", 1)], "word string, n int")
    found = S.spelling_groups(blank).collect()
    assert {tuple(r) for r in found} == {(w, None, w, n, 0, None) for w, n in [(None, 9), ("", 9), ("a", 1)]}


def test_common_prefixes_of_equal_buckets_pair_once(spark):
    """A repeated letter can be inserted at several places; the pair is still one."""
    words = {"aaaaaa": 5, "aaaaaaa": 50, "aaaaaaaa": 5, "baaaaaa": 5}
    table = spark.createDataFrame(list(words.items()), "word string, n int")
    for most in (1, 2, 512):
        assert rows(S.spelling_groups(table, most=most)) == grouped(words)
    near = defaultdict(int)
    for r in S.near_words(table, 1).collect():
        near[r["word"]] += 1
    assert near["aaaaaaa"] == 3
