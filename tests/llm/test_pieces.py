import hashlib
import random

import public_tokenizers
import pytest

from sensorloom.llm import pieces as P
from tests.llm.helpers import awkward, documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return P.PieceModel(PATH)


def texts():
    rng = random.Random(3)
    letters = list("abcdehtin .,▁'\n\t(é中0😀\x00-")
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(2000)]
    return made + ["", " ", "  a  ", "▁▁a ▁", "中文字符測試 한국어", "<s> </s> <0x41>", "x" * 3000, "a" * 49 + " b"]


def test_ids_are_those_of_the_library(model):
    own = model.encode(texts())
    theirs = model.library.encode(texts(), add_eos=True)
    assert [ids for ids, _ in own] == theirs
    assert [joined.decode() for _, joined in own] == [" ".join(map(str, ids)) for ids in theirs]


def test_agenda_and_block_agree(model):
    chunks = ["▁the", "▁nothing", "▁aaaa", "ab", "▁▁▁", "é", "😀", "▁étéété", "▁" + "ha" * 20]
    assert model.agendas(chunks) == [model.agenda(c) for c in chunks]
    assert model.agendas(chunks) == model.bare.encode(chunks)


def test_forgetting_changes_nothing(model, monkeypatch):
    expected = model.library.encode(texts(), add_eos=True)
    monkeypatch.setattr(P, "CACHE_BYTES", 1000)
    for start in range(0, 2000, 500):
        part = texts()[start : start + 500]
        assert [ids for ids, _ in model.encode(part)] == expected[start : start + 500]


def test_every_text_of_a_slice_is_checked(monkeypatch):
    """A wrong entry of the cache shows in whatever text it stands."""
    own = P.PieceModel(PATH)
    slice_ = ["one text", "another text", "the last text, of other words"]
    assert [ids for ids, _ in P.checked(own, slice_)] == own.library.encode(slice_, add_eos=True)
    right = own.encode
    for at in range(len(slice_)):
        for wrong in (lambda ids, joined: (ids[1:], joined), lambda ids, joined: (ids, joined + b" 7")):
            monkeypatch.setattr(
                own, "encode", lambda texts: [wrong(*e) if i == at else e for i, e in enumerate(right(texts))]
            )
            with pytest.raises(ValueError):
                P.checked(own, slice_)


def test_rows(spark, model):
    docs = awkward()
    rows = P.encode_documents(documents(spark, docs), PATH, digest=True).collect()
    ids = model.library.encode([t or "" for _, t in docs], add_eos=True)
    decoded = model.library.decode(ids)
    expected = [
        (
            i,
            len(x),
            hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(),
            hashlib.sha256(d.encode()).hexdigest(),
        )
        for (i, _), x, d in zip(docs, ids, decoded)
    ]
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    plain = P.encode_documents(documents(spark, docs), PATH).collect()
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in plain) == sorted(
        (str(i), d) for (i, _), d in zip(docs, decoded)
    )
    assert P.encode_documents(documents(spark, []), PATH).count() == 0
