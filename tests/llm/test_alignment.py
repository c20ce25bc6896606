import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from sensorloom.llm import alignment as A
from tests.llm.helpers import awkward, documents, prose

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")


def tokens(texts):
    """The tokens of each text by both libraries as (id, bytes), or None where they differ from it."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(A_PATH)
    one.encode_special_tokens = True
    two, alphabet = sentencepiece.SentencePieceProcessor(model_file=B_PATH), A.byte_alphabet()
    for text in texts:
        a = [(i, bytes(alphabet[c] for c in one.id_to_token(i))) for i in one.encode(" " + (text or "")).ids]
        b = []
        for i in two.encode(text or ""):
            piece = two.id_to_piece(i)
            b.append((i, bytes.fromhex(piece[3:5]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
        raw = (" " + (text or "")).encode()
        same = text and b"".join(x for _, x in a) == raw == b"".join(x for _, x in b)
        yield (a, b) if same else None


def spans(each):
    at, found = 0, []
    for i, part in each:
        found.append((i, at, at + len(part)))
        at += len(part)
    return found


def brute(texts):
    """Overlaps by comparing every token of A with every one of B."""
    made = []
    for pair in tokens([t for _, t in texts]):
        if pair is None:
            made.append(None)
            continue
        a, b = map(spans, pair)
        links = [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]
        both = sorted({e for *_, e in a} & {e for *_, e in b})
        starts = [0, *both[:-1]]
        groups = ";".join(
            ",".join(str(i) for i, s, e in a if low <= s and e <= high)
            + "|"
            + ",".join(str(i) for i, s, e in b if low <= s and e <= high)
            for low, high in zip(starts, both)
        )
        made.append((len(a), len(b), len(both), links, groups))
    count, highest = Counter(), defaultdict(int)
    for each in made:
        count.update(set(each[3]) if each else ())
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    rows = []
    for (i, _), each in zip(texts, made):
        if each is None:
            rows.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            na, nb, ng, links, groups = each
            best = sum(count[x] == highest[x[0]] for x in links)
            rows.append((i, na, nb, ng, len(links), best, sum(count[x] for x in links), groups))
    return sorted(rows, key=repr)


def texts():
    rng = random.Random(4)
    letters = list("abcdehtin .,'\n\t(é中0😀\x00-▁")
    odd = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(80)]
    odd += ["<|endoftext|> <s>", " ", "  two", "▁", "中文字符測試", "don't  stop\n\n", "x" * 500, "  a"]
    small = [(i, t) for i, t in awkward() if t is None or len(t) < 3000]
    return small + [(200 + i, t) for i, t in enumerate(odd)]


@pytest.mark.parametrize("block_bytes", [1, 1500, 1 << 24])
def test_texts_against_every_pair(spark, block_bytes):
    """Blocks of one text, of a few and of all give the same sums."""
    given = texts()
    found = A.align_tokenizers(documents(spark, given), A_PATH, B_PATH, block_bytes=block_bytes)
    expected = brute(given)
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    assert any(row[1] == 0 and dict(given)[row[0]] for row in expected)
    digest = A.align_tokenizers(documents(spark, given), A_PATH, B_PATH, digest=True, block_bytes=block_bytes)
    hashed = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in expected]
    assert sorted(map(tuple, digest.collect()), key=repr) == sorted(hashed, key=repr)


def test_long_texts_keep_their_bytes(spark):
    given = [(1, prose(3, 9000)), (2, "word " * 20000), (None, prose(3, 9000))]
    rows = {r["doc_id"]: r for r in A.align_tokenizers(documents(spark, given), A_PATH, B_PATH).collect()}
    for i, text in given:
        ((a, b),) = tokens([text])
        groups = [side.split("|") for side in rows[i]["groups"].split(";")]
        assert [int(x) for g in groups for x in g[0].split(",")] == [x for x, _ in a]
        assert [int(x) for g in groups for x in g[1].split(",")] == [x for x, _ in b]
        assert rows[i]["n_links"] == len(a) + len(b) - rows[i]["n_groups"]
    assert rows[1][1:] == rows[None][1:]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("seed", range(4))
def test_pieces_of_any_size_give_the_same(seed, size):
    """Whatever piece a diagonal ends, equal ends parted by it are stitched."""
    rng = np.random.default_rng(seed)
    last = 200
    a = np.append(np.unique(rng.integers(1, last, 60 if seed else 0)), last)
    b = np.append(np.unique(rng.integers(1, last, 90)), last)
    whole = np.unique(np.append(a, b))
    expected = (whole, np.searchsorted(a, whole), np.searchsorted(b, whole), np.isin(whole, a) & np.isin(whole, b))
    for found, right in zip(A.overlaps(a, b, size), expected):
        assert found.tolist() == right.tolist()


def test_both_ways_to_the_ids_agree():
    """Entries of the vocabulary, spaces of all kinds, controls and Latin letters."""
    own = A.ByteLevel(A_PATH)
    assert own.fast is not None
    rng = random.Random(6)
    marks = [chr(i) for i in range(0x250)] + list("\x1c\x1d\x1e\x1f\x85\xa0\xad  \t\r\n'") * 8 + ["'ll", "'S", "²", "ª", "ß"]
    given = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    given += [b.decode() for b in own.bytes if b.isascii()] + ["a" * 5000, " " * 700, "<|endoftext|>", ""]
    given += [given[i] + "中 \u2003 Ⅷ" for i in range(50)]
    expected = own.library.encode_batch([" " + text for text in given], add_special_tokens=False)
    assert own.encode(given) == [each.ids for each in expected]


def test_pieces_have_equal_work():
    a, b = np.arange(1, 1001), np.arange(7, 1001, 7)
    a_cut, b_cut = A.crossings(a, b, 100)
    assert set(np.diff(a_cut + b_cut)[:-1]) == {100}
    assert (a_cut[-1], b_cut[-1]) == (len(a), len(b))


def test_empty(spark):
    assert A.align_tokenizers(documents(spark, []), A_PATH, B_PATH).collect() == []
    nothing = A.align_tokenizers(documents(spark, [(1, None), (1, ""), (None, "")]), A_PATH, B_PATH)
    assert [tuple(r)[1:] for r in nothing.collect()] == [(0, 0, 0, 0, 0, 0, "")] * 3
