"""SentencePiece encoding and decoding for vocabularies that were made by merges.

A text is cut where no piece of the vocabulary reaches across, so that each distinct chunk is
encoded once per worker. A chunk is encoded by an agenda of adjacent symbol pairs ordered by the
score of the merged piece: the best pair is merged, its neighbours make new pairs, until no pair
is a piece. Ids are checked against the sentencepiece library, an Arrow batch at a time.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sensorloom.llm.common import require, span_hashes, text_slices

SPACE = "▁"
# Types of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# A worker forgets the chunks it has seen beyond about this number of bytes.
CACHE_BYTES = 200_000_000
# Chunks of up to so many characters are encoded in blocks of so many.
LONGEST, BLOCK = 48, 4096


class PieceModel:
    """The vocabulary of a merge-type model file, with an encoder."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normalizer = model.normalizer_spec
        plain = not normalizer.precompiled_charsmap and not normalizer.remove_extra_whitespaces
        if model.trainer_spec.model_type != 2 or not plain or not normalizer.escape_whitespaces:
            raise ValueError("a merge-type model without text normalisation is needed")
        if any(piece.type in (USER, UNUSED) for piece in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.library = SentencePieceProcessor(model_file=path)
        self.prefix = normalizer.add_dummy_prefix
        self.end_id = self.library.eos_id()
        self.unknown_id = self.library.unk_id()
        self.byte_fallback = model.trainer_spec.byte_fallback
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = [0] * 256
        for i, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                self.bytes[int(piece.piece[1:-1], 16)] = i
        normalizer.add_dummy_prefix = False
        self.bare = SentencePieceProcessor(model_proto=model.SerializeToString())
        self._boundaries()
        self.forget()
        self._tables()

    def _boundaries(self) -> None:
        """Where no piece reaches across. A piece has spaces only in front, so a text can be cut
        before every run of spaces; it can also be cut on both sides of an ASCII character that no
        merged piece holds."""
        merged = [piece for piece in self.scores if len(piece) > 1]
        if any(SPACE in piece.lstrip(SPACE) for piece in merged):
            raise ValueError("a piece goes on behind a space")
        joined = {c for piece in merged for c in piece} | {" "}
        self.alone = np.array([i < 128 and chr(i) not in joined for i in range(256)])

    def cut(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the chunks of texts, given end to end as bytes, begin."""
        first = np.zeros(len(raw), dtype=bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        space, alone = raw == 32, self.alone[raw]
        first |= alone
        first[1:] |= (space[1:] & ~space[:-1]) | alone[:-1]
        return np.flatnonzero(first)

    def _tables(self) -> None:
        """Numbers for all symbols that can occur in a merge, and the sorted table of the pairs
        that merge: key (left, right), rank by score, merged symbol."""
        symbols = dict.fromkeys([*self.scores, *(c for piece in self.scores for c in piece)])
        self.number = {symbol: i + 1 for i, symbol in enumerate(symbols)}
        self.symbol = ["", *symbols]
        ranks = {score: i for i, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        width = len(self.symbol)
        rows = sorted(
            (self.number[left] * width + self.number[right], ranks[score], self.number[piece])
            for piece, score in self.scores.items()
            for at in range(1, len(piece))
            if (left := piece[:at]) in self.number and (right := piece[at:]) in self.number
        )
        table = np.array(rows, dtype=np.int64).reshape(-1, 3)
        self.pair_keys, self.pair_ranks, self.pair_merged = table.T.copy()
        self.id_of = np.array([self.ids.get(symbol, -1) for symbol in self.symbol])
        self.no_pair = np.int64(len(ranks) + 1)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; no_pair and 0 where it does not merge."""
        keys = left.astype(np.int64) * len(self.symbol) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = (self.pair_keys[at] == keys) & (left > 0) & (right > 0)
        return np.where(known, self.pair_ranks[at], self.no_pair), np.where(known, self.pair_merged[at], 0)

    def agendas(self, chunks: list[str]) -> list[list[int]]:
        """``agenda`` of many short chunks at once: a row per chunk holds its symbols and the rank
        of every adjacent pair, and each step merges the first best pair of every row."""
        width = max(map(len, chunks))
        points = np.frombuffer("".join(c.ljust(width, "\0") for c in chunks).encode("utf-32-le"), np.uint32)
        chars, where = np.unique(points, return_inverse=True)
        numbers = np.array([self.number.get(chr(c), 0) if c else 0 for c in chars.tolist()])
        symbols = numbers[where.reshape(-1)].reshape(-1, width)
        raw = points.reshape(-1, width).astype(np.int64)
        lengths = np.array([len(c) for c in chunks])
        ranks, merged = self._pairs(symbols[:, :-1], symbols[:, 1:])
        out_symbols, out_raw = np.zeros_like(symbols), np.zeros_like(raw)
        rows = np.arange(len(chunks))
        columns = np.arange(width)
        while len(rows):
            best = ranks.argmin(axis=1) if width > 1 else np.zeros(len(rows), np.int64)
            here = np.arange(len(rows))
            open_ = ranks[here, best] < self.no_pair if width > 1 else np.zeros(len(rows), bool)
            done = rows[~open_]
            out_symbols[done], out_raw[done] = symbols[~open_], raw[~open_]
            rows, symbols, raw = rows[open_], symbols[open_], raw[open_]
            ranks, merged, best = ranks[open_], merged[open_], best[open_]
            if not len(rows):
                break
            here = np.arange(len(rows))
            symbols[here, best] = merged[here, best]
            lengths[rows] -= 1
            # The symbol behind the merged one goes; all behind it move up.
            keep = columns[None, :-1] <= best[:, None]
            for array in (symbols, raw):
                array[:, :-1] = np.where(keep, array[:, :-1], array[:, 1:])
                array[:, -1] = 0
            keep = keep[:, :-1]
            for array, empty in ((ranks, self.no_pair), (merged, 0)):
                array[:, :-1] = np.where(keep, array[:, :-1], array[:, 1:])
                array[:, -1] = empty
            for at in (best - 1, best):
                fits = (at >= 0) & (at < width - 1)
                r, a = here[fits], at[fits]
                ranks[r, a], merged[r, a] = self._pairs(symbols[r, a], symbols[r, a + 1])
        ids = self.id_of[out_symbols]
        result = []
        for row, count, characters in zip(ids.tolist(), lengths.tolist(), out_raw):
            row = row[:count]
            if -1 in row:
                row = [
                    j
                    for at, i in enumerate(row)
                    for j in ([i] if i >= 0 else self._unknown(chr(characters[at])))
                ]
            result.append(row)
        return result

    def _unknown(self, character: str) -> list[int]:
        if self.byte_fallback:
            return [self.bytes[b] for b in character.encode()]
        return [self.unknown_id]

    def agenda(self, chunk: str) -> list[int]:
        """Ids of a chunk, by merging the adjacent pair of the best score first, the leftmost of
        equal ones."""
        symbols: list[str] = list(chunk)
        count = len(symbols)
        before = list(range(-1, count - 1))
        after = list(range(1, count + 1))
        scores, heap = self.scores, []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < count:
                piece = symbols[left] + symbols[right]
                score = scores.get(piece)
                if score is not None:
                    heapq.heappush(heap, (-score, left, right, piece))

        for left in range(count - 1):
            offer(left, left + 1)
        while heap:
            _, left, right, piece = heapq.heappop(heap)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = after[right]
            if after[right] < count:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        ids: list[int] = []
        for symbol in symbols:
            if symbol:
                known = self.ids.get(symbol)
                if known is not None:
                    ids.append(known)
                else:
                    ids.extend(self._unknown(symbol))
        return ids

    def learn(self, chunks: list[str], hashes: np.ndarray) -> None:
        """Encode chunks that are new to the worker, and compare them with the library's ids."""
        order = sorted(range(len(chunks)), key=lambda i: len(chunks[i]))
        short = [i for i in order if len(chunks[i]) <= LONGEST]
        sorted_chunks = [chunks[i] for i in order]
        ids = []
        for at in range(0, len(short), BLOCK):
            ids += self.agendas(sorted_chunks[at : min(at + BLOCK, len(short))])
        ids += [self.agenda(chunk) for chunk in sorted_chunks[len(short) :]]
        if self.bare.encode(sorted_chunks, num_threads=1) != ids:
            raise ValueError("ids differ from those of the library")
        self.known = _extended(self.known, hashes[order], ids)

    def forget(self) -> None:
        self.known = _extended(None, np.zeros(0, np.uint64), [])

    def encode(self, texts: list[str]) -> list[tuple[list[int], bytes]]:
        """For each text its ids with the end id, and the same in decimal joined by one space."""
        front = " " if self.prefix else ""
        coded = [(front + t.replace(SPACE, " ")).encode() if t else b"" for t in texts]
        blob = b"".join(coded)
        raw = np.frombuffer(blob, dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded], dtype=np.int64)])
        starts = self.cut(raw, offsets)
        ends = np.append(starts[1:], len(raw)).astype(np.int64)[: len(starts)]
        hashes, sample, where = np.unique(
            span_hashes(raw, starts, ends), return_index=True, return_inverse=True
        )
        at, missing = self._find(hashes)
        if missing.any():
            new = [
                blob[starts[i] : ends[i]].decode().replace(" ", SPACE) for i in sample[missing]
            ]
            if self.known["bytes"] > CACHE_BYTES:
                missing[:] = True
                self.forget()
                new = [blob[starts[i] : ends[i]].decode().replace(" ", SPACE) for i in sample]
            self.learn(new, hashes[missing])
            at, missing = self._find(hashes)
        entry = at[where.reshape(-1)]
        chunk_at = np.searchsorted(starts, offsets)
        ids, id_at = _gathered(self.known, "ids", entry)
        digits, digit_at = _gathered(self.known, "digits", entry)
        digits = digits.tobytes()
        end = str(self.end_id).encode()
        result = []
        for i in range(len(texts)):
            a, b = chunk_at[i], chunk_at[i + 1]
            own = ids[id_at[a] : id_at[b]].tolist()
            own.append(self.end_id)
            result.append((own, digits[digit_at[a] : digit_at[b]] + end))
        return result

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.known["hash"]
        if not len(keys):
            return np.zeros(len(hashes), np.int64), np.ones(len(hashes), bool)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return self.known["row"][at], keys[at] != hashes


def _extended(known: dict | None, hashes: np.ndarray, ids: list[list[int]]) -> dict:
    """The known chunks with more of them. Ids and their decimal forms lie end to end; row leads
    from a sorted hash to where a chunk's begin and end."""
    digits = [("".join([f"{i} " for i in each])).encode() for each in ids]
    fresh = {
        "ids": np.fromiter(chain.from_iterable(ids), np.int32),
        "digits": np.frombuffer(b"".join(digits), np.uint8),
    }
    lengths = {"ids": [len(i) for i in ids], "digits": [len(d) for d in digits]}
    if known is None:
        known = {"hash": np.zeros(0, np.uint64), "row": np.zeros(0, np.int64)}
        known |= {"ids": np.zeros(0, np.int32), "digits": np.zeros(0, np.uint8)}
        known |= {"ids_end": np.zeros(1, np.int64), "digits_end": np.zeros(1, np.int64)}
    keys = np.concatenate([known["hash"], hashes])
    rows = np.concatenate([known["row"], len(known["row"]) + np.arange(len(hashes))])
    order = np.argsort(keys, kind="stable")
    out = {"hash": keys[order], "row": rows[order]}
    for name in ("ids", "digits"):
        ends = known[f"{name}_end"]
        out[name] = np.concatenate([known[name], fresh[name]])
        out[f"{name}_end"] = np.concatenate(
            [ends, ends[-1] + np.cumsum(lengths[name], dtype=np.int64)]
        )
    out["bytes"] = sum(array.nbytes for array in out.values())
    return out


def _gathered(known: dict, name: str, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What belongs to the entries, end to end, and where each entry's part begins."""
    ends = known[f"{name}_end"]
    begins = ends[entry]
    lengths = ends[entry + 1] - begins
    at = np.zeros(len(entry) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    index = np.arange(at[-1]) + np.repeat(begins - at[:-1], lengths)
    return known[name][index], at


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, read once per worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def checked(own: PieceModel, texts: list[str]) -> list[tuple[list[int], bytes]]:
    """The ids of texts and their decimal forms, all of them compared with the library's."""
    encoded = own.encode(texts)
    for (ids, joined), expected in zip(
        encoded, own.library.encode(texts, add_eos=True, num_threads=1), strict=True
    ):
        # The text of a list has a comma and a space between numbers, and is made faster than a join.
        if ids != expected or joined != str(ids)[1:-1].replace(",", "").encode():
            raise ValueError("a text's ids differ from those of the library")
    return encoded


SCHEMA = "doc_id bigint, n_tokens bigint, ids string, decoded string"
DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_documents(documents: DataFrame, path: str, digest: bool = False) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text; other columns are ignored): the number of
    ids, the ids joined by a space and the text that the library decodes them to, or with
    ``digest`` the SHA-256 of both.

    A null text is empty; an empty text has the end id only. In every Arrow batch the library
    encodes each chunk that is new to the worker, and all whole texts; a difference fails the query.
    Repeated rows and null ids give a row each. ``path`` names a file that every executor has.
    """
    names = [field.split(" ")[0] for field in (DIGEST if digest else SCHEMA).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = [text or "" for text in part.column(1).to_pylist()]
                encoded = checked(own, texts)
                ids = [each for each, _ in encoded]
                strings = [joined for _, joined in encoded]
                decoded = own.library.decode(ids, num_threads=1)
                if digest:
                    strings = [hashlib.sha256(s).hexdigest() for s in strings]
                    decoded = [hashlib.sha256(s.encode()).hexdigest() for s in decoded]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array([len(each) for each in ids], pa.int64()),
                        pa.array(strings).cast(pa.string()),
                        pa.array(decoded, pa.string()),
                    ],
                    names=names,
                )

    return require(documents, ["doc_id", "text"]).mapInArrow(run, DIGEST if digest else SCHEMA)
