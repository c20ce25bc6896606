"""Alignment of two tokenizers over the same texts.

Tokens of A and of B end at byte offsets of one text. Merging both sorted lists of ends is cut into
pieces of equal work: each diagonal of the merge grid is searched for the point where the merge path
crosses it, which depends on no other diagonal. A piece pairs its ends with the token of the other
side that covers them, which gives every overlapping pair once, as two tokens overlap in exactly one
stretch between neighbouring ends. Where a diagonal parts two equal ends, the pieces on both sides
are stitched; ends that both sides have cut the text into groups.

Tasks align texts in blocks. A block keeps its distinct pairs of ids once, with the number of its
documents that have them, and its documents refer to them by number. Only those pairs are shuffled
to be counted in the whole corpus and back to their block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.common import require, stored, text_slices

SPACE = "▁"
# Ends that a piece merges; bytes of text of a block.
PIECE, BLOCK_BYTES = 1 << 14, 1 << 24


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable characters of
    Latin-1 stand for themselves, the other bytes in order for characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


# Fixed value: how a byte-level tokenizer cuts a text before it merges.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters beyond Latin, where libraries may know different versions of Unicode.
BEYOND = re.compile("[^\x00-\u024f]")


class ByteLevel:
    """A byte-level tokenizer of the tokenizers library, without special tokens.

    Texts of Latin letters are encoded by tiktoken with the ranks of the same file, which is faster,
    where the file's merges are in the order of their ids and make every entry; others by the
    library itself."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        alphabet, entries = byte_alphabet(), self.library.get_vocab(with_added_tokens=True)
        size = max(entries.values()) + 1
        self.bytes = [b""] * size
        for entry, i in entries.items():
            known = all(c in alphabet for c in entry)
            self.bytes[i] = bytes(alphabet[c] for c in entry) if known else entry.encode()
        self.fast = self._ranked(path)

    def _ranked(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        entries, model, cut = given["model"]["vocab"], self.library.model, given["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in given["model"]["merges"]]
        merged = [entries["".join(m)] for m in merges]
        plain = given["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        plain = plain and not cut.get("add_prefix_space") and all(a < b for a, b in zip(merged, merged[1:]))
        special = {token["content"] for token in given["added_tokens"]}
        ranks = {self.bytes[i]: i for entry, i in entries.items() if entry not in special}
        if not plain or any(len(model.tokenize(e)) != 1 for e in entries if e not in special):
            return None
        return tiktoken.Encoding(path, pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        given = [" " + text for text in texts]
        slow = [self.fast is None or BEYOND.search(text) is not None for text in given]
        rest = [text for text, is_slow in zip(given, slow) if is_slow]
        encoded = iter(self.library.encode_batch(rest, add_special_tokens=False))
        return [
            next(encoded).ids if is_slow else self.fast.encode_ordinary(text)
            for text, is_slow in zip(given, slow)
        ]


class Pieces:
    """A model of the sentencepiece library, which puts a space in front of a text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = own = SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(own.id_to_piece(i)[1:-1], 16)]) if own.is_byte(i)
            else own.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(own.get_piece_size())
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Vocabulary:
    """The bytes and decimal forms of ids, by array of ids."""

    def __init__(self, tokenizer: ByteLevel | Pieces, within: str, behind: str) -> None:
        self.encode = tokenizer.encode
        self.texts = pa.array(tokenizer.bytes, pa.large_binary())
        self.lengths = np.array([len(b) for b in tokenizer.bytes], np.int64)
        # Decimal forms followed by what stands before the next id of a group, or behind the last.
        self.forms = [f"{i}{end}".encode() for end in (within, behind) for i in range(len(self.lengths))]

    def joined(self, ids: np.ndarray) -> bytes:
        return bytes(self.texts.take(pa.array(ids)).buffers()[2] or b"")


_VOCABULARIES: dict[tuple[str, str], tuple[Vocabulary, Vocabulary, pa.Array]] = {}


def vocabularies(a_path: str, b_path: str) -> tuple[Vocabulary, Vocabulary, pa.Array]:
    """Both vocabularies and all their decimal forms, read once per worker."""
    key = (a_path, b_path)
    if key not in _VOCABULARIES:
        a, b = Vocabulary(ByteLevel(a_path), ",", "|"), Vocabulary(Pieces(b_path), ",", ";")
        _VOCABULARIES[key] = a, b, pa.array(a.forms + b.forms, pa.large_binary())
    return _VOCABULARIES[key]


def crossings(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many entries of the sorted ``a`` and ``b`` stand before each ``size``-th step of their
    merge, the last step included. Of equal entries that of ``a`` comes first."""
    steps = np.append(np.arange(0, len(a) + len(b), size), len(a) + len(b))
    low, high = np.maximum(steps - len(b), 0), np.minimum(steps, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low, steps - low
        middle = (low + high) // 2
        taken = np.zeros(len(steps), bool)
        taken[open_] = a[middle[open_]] <= b[(steps - middle)[open_] - 1]
        low, high = np.where(open_ & taken, middle + 1, low), np.where(open_ & ~taken, middle, high)


def piece_overlaps(a: np.ndarray, b: np.ndarray, a_from: int, b_from: int) -> tuple[np.ndarray, ...]:
    """(end, number in A, number in B, common) of the overlaps that end in one piece, by end. ``a``
    and ``b`` are the piece's own ends; its first have the numbers ``a_from`` and ``b_from``."""
    in_b = np.searchsorted(b, a)
    common = np.append(b, -1)[in_b] == a if len(b) else np.zeros(len(a), bool)
    in_a = np.searchsorted(a, b)
    only_b = np.append(a, -1)[in_a] != b if len(a) else np.ones(len(b), bool)
    ends = np.concatenate([a, b[only_b]])
    order = np.argsort(ends, kind="stable")
    return (
        ends[order],
        (a_from + np.concatenate([np.arange(len(a)), in_a[only_b]]))[order],
        (b_from + np.concatenate([in_b, np.flatnonzero(only_b)]))[order],
        np.append(common, np.zeros(only_b.sum(), bool))[order],
    )


def stitch(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """The overlaps of consecutive pieces as one list. An end that two pieces share is in both
    lists: it stays once, as the first has it, and is common."""
    ends, in_a, in_b, common = (np.concatenate(column) for column in zip(*parts))
    again = np.append(False, ends[1:] == ends[:-1])
    common[:-1] |= again[1:]
    return ends[~again], in_a[~again], in_b[~again], common[~again]


def overlaps(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, ...]:
    """All overlaps of two tokenizations of the same bytes, given by their ends."""
    a_cut, b_cut = crossings(a, b, size)
    parts = [
        piece_overlaps(a[a_cut[i] : a_cut[i + 1]], b[b_cut[i] : b_cut[i + 1]], a_cut[i], b_cut[i])
        for i in range(len(a_cut) - 1)
    ]
    return stitch(parts) if parts else (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(each) for each in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(lengths.sum())), lengths


def _in_order(a_groups: np.ndarray, b_groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens of A and B stand when groups follow each other, A first in each."""
    a_at = np.arange(len(a_groups)) + np.searchsorted(b_groups, a_groups)
    b_at = np.arange(len(b_groups)) + np.searchsorted(a_groups, b_groups, side="right")
    return a_at, b_at


class Aligned:
    """The texts of a slice aligned: per text its numbers, groups and pairs of ids."""

    def __init__(self, texts: list[str], a: Vocabulary, b: Vocabulary, forms: pa.Array) -> None:
        (a_ids, self.n_a), (b_ids, self.n_b) = _flat(a.encode(texts)), _flat(b.encode(texts))
        raw = [b" " + text.encode() if text else b"" for text in texts]
        alike = self._alike(raw, a, a_ids, self.n_a) & self._alike(raw, b, b_ids, self.n_b)
        a_ids, b_ids = a_ids[np.repeat(alike, self.n_a)], b_ids[np.repeat(alike, self.n_b)]
        self.n_a, self.n_b = self.n_a * alike, self.n_b * alike
        ends = np.cumsum([len(r) if ok else 0 for r, ok in zip(raw, alike)])
        found, in_a, in_b, common = overlaps(np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids]))
        behind = np.searchsorted(found, ends, side="right")
        self.n_links = np.diff(behind, prepend=0)
        self.n_groups = np.diff(np.append(0, np.cumsum(common))[behind], prepend=0)
        self.links = a_ids[in_a] << 32 | b_ids[in_b]
        group = np.cumsum(common) - common
        self.forms = self._forms(a_ids, b_ids, *self._group_of(group, in_a, in_b), forms, len(a.lengths), len(b.lengths))

    @staticmethod
    def _alike(raw: list[bytes], own: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Which texts the tokens give back byte by byte; an empty text is not one of them."""
        joined = own.joined(ids)
        ends = np.append(0, np.cumsum(own.lengths[ids]))[np.cumsum(counts)]
        starts = np.append(0, ends[:-1])
        return np.array([len(r) > 0 and joined[s:e] == r for r, s, e in zip(raw, starts, ends)], bool)

    @staticmethod
    def _group_of(group: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first_a = np.flatnonzero(np.diff(in_a, prepend=-1))
        first_b = np.flatnonzero(np.diff(in_b, prepend=-1))
        return group[first_a], group[first_b]

    def _forms(self, a_ids, b_ids, a_groups, b_groups, forms, a_size: int, b_size: int) -> list[bytes]:
        """The groups of each text written out, such as ``1,2|3;4|5,6``."""
        last_a = np.append(a_groups[1:] != a_groups[:-1], True)[: len(a_groups)]
        last_b = np.append(b_groups[1:] != b_groups[:-1], True)[: len(b_groups)]
        a_at, b_at = _in_order(a_groups, b_groups)
        codes = np.empty(len(a_ids) + len(b_ids), np.int64)
        codes[a_at] = a_ids + a_size * last_a
        codes[b_at] = b_ids + b_size * last_b + 2 * a_size
        written = forms.take(pa.array(codes))
        offsets = np.frombuffer(written.buffers()[1], np.int64)[: len(codes) + 1] if len(codes) else np.zeros(1, int)
        data = bytes(written.buffers()[2] or b"") if len(codes) else b""
        ends = offsets[np.cumsum(self.n_a + self.n_b)]
        # Without the separator behind a text's last group.
        return [data[s : max(s, e - 1)] for s, e in zip(np.append(0, ends[:-1]), ends)]


LINKED = (
    "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "at array<int>, times array<int>, pairs array<bigint>, docs array<int>"
)
_LINKED_TYPES = pa.schema(
    [(name, pa.int64()) for name in ("block", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups", pa.string()), ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))]
    + [("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))]
)


class Block:
    """Aligned texts of a task, gathered until their block is full."""

    def __init__(self) -> None:
        self.columns: list[list[pa.Array]] = []
        self.pairs: list[np.ndarray] = []
        self.texts: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.rows = self.bytes = 0

    def add(self, ids: pa.Array, aligned: Aligned, size: int, digest: bool) -> None:
        text = np.repeat(np.arange(len(ids)), aligned.n_links)
        order = np.lexsort((aligned.links, text))
        text, pairs = text[order], aligned.links[order]
        first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (pairs[1:] != pairs[:-1]))[: len(text)])
        self.texts.append(text[first] + self.rows)
        self.pairs.append(pairs[first])
        self.times.append(np.diff(first, append=len(text)))
        groups = [hashlib.sha256(f).hexdigest() if f and digest else f.decode() for f in aligned.forms]
        numbers = (aligned.n_a, aligned.n_b, aligned.n_groups, aligned.n_links)
        self.columns.append([ids.cast(pa.int64()), *(pa.array(n, pa.int64()) for n in numbers), pa.array(groups)])
        self.rows, self.bytes = self.rows + len(ids), self.bytes + size

    def batch(self, number: int) -> pa.RecordBatch:
        """A row per text, and a last row with the pairs that they refer to and how many texts
        have each."""
        texts, times = np.concatenate(self.texts), np.concatenate(self.times)
        pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
        offsets = pa.array(np.searchsorted(texts, np.arange(self.rows + 1)).astype(np.int32))
        docs = np.bincount(at, minlength=len(pairs))
        columns = [pa.concat_arrays(column) for column in zip(*self.columns)]
        columns += [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (at, times)]
        last = {"block": [number], "pairs": [pairs], "docs": [docs.astype(np.int32)]}
        rows = [pa.array(np.full(self.rows, number)), *columns]
        rows += [pa.nulls(self.rows, _LINKED_TYPES.field(i).type) for i in (9, 10)]
        ends = [
            pa.array(last[f.name], f.type) if f.name in last else pa.nulls(1, f.type) for f in _LINKED_TYPES
        ]
        both = [pa.concat_arrays([row.cast(f.type), end]) for row, end, f in zip(rows, ends, _LINKED_TYPES)]
        return pa.RecordBatch.from_arrays(both, schema=_LINKED_TYPES)


def linked_texts(documents: DataFrame, a_path: str, b_path: str, digest: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per text with its numbers and groups (with ``digest`` their SHA-256), and its distinct
    pairs as numbers ``at`` into the pairs of its block with the ``times`` they occur. A row per
    block has those ``pairs`` and the number of its ``docs`` that hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, forms = vocabularies(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        block = Block()
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = [text or "" for text in part.column(1).to_pylist()]
                size = sum(len(text) for text in texts)
                block.add(part.column(0), Aligned(texts, a, b, forms), size, digest)
                if block.bytes >= block_bytes:
                    yield block.batch(number)
                    block, number = Block(), number + 1
        if block.rows:
            yield block.batch(number)

    return require(documents, ["doc_id", "text"]).mapInArrow(run, LINKED)


ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"


def _judged(texts: pa.Table, known: pa.Table) -> pa.Table:
    """The texts of a block with sums over their links, given what is known of the block's pairs."""
    at = np.asarray(known["number"])
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    count[at], best[at] = np.asarray(known["count"]), np.asarray(known["best"])
    of, times = texts["at"].combine_chunks(), np.asarray(texts["times"].combine_chunks().flatten()).astype(np.int64)
    pairs = np.asarray(of.flatten())
    ends = np.cumsum(np.asarray(of.value_lengths()).astype(np.int64))

    def per_text(values: np.ndarray) -> pa.Array:
        return pa.array(np.diff(np.append(0, np.cumsum(values))[ends], prepend=0).astype(np.int64))

    rows = texts.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    rows = rows.append_column("n_best", per_text(times * best[pairs]))
    rows = rows.append_column("count_sum", per_text(times * count[pairs]))
    return rows.append_column("groups", texts["groups"])


def align_tokenizers(
    documents: DataFrame, a_path: str, b_path: str, digest: bool = False, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text; other columns are ignored): the tokens of a
    space and the text by the byte-level vocabulary at ``a_path`` and by the pieces at ``b_path``,
    the groups between offsets where both end, and the overlapping pairs of tokens (links).

    ``count_sum`` adds, for every link, the number of rows in the whole table that hold a link of
    the same ids; ``n_best`` counts the links whose number is the highest of all pairs with their A
    id. ``groups`` is written as ``a1,a2|b1;a3|b2``, with ``digest`` as its SHA-256.

    A text that is null or empty, or that either tokenizer does not give back byte by byte, has no
    tokens: all numbers are 0 and ``groups`` is empty. Repeated rows and null ids give a row each,
    and each counts as a document. Both paths name files that every executor has.
    """
    linked = stored(linked_texts(documents, a_path, b_path, digest, block_bytes), "linked")
    pairs = linked.filter("pairs is not null").select(
        "block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("number", "each")
    ).select("block", "number", F.col("each.pairs").alias("pair"), F.col("each.docs").alias("docs"))
    counts = stored(pairs.groupBy("pair").agg(F.sum("docs").alias("count")), "pair-counts")
    a_id = F.shiftright("pair", 32)
    highest = counts.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("highest"))
    judged = counts.join(highest, a_id == F.col("a_id")).select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("int").alias("best")
    )
    known = pairs.join(judged, "pair").select(F.col("block").alias("of"), "number", "count", "best")
    texts = linked.filter("pairs is null").drop("pairs", "docs")
    return texts.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_judged, ALIGNED)
