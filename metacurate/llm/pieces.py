"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A merge-type model joins neighbouring symbols, best score first, leftmost among
equals. Every candidate merge has a key: the seed, the document, which of its
words it is in, the place in the word and the two symbols. A keyed hash of it
decides whether the agenda skips that candidate for good, so a segmentation can
be repeated on any machine, and every occurrence of a word is cut on its own. No
piece of the model has a space inside, so words with the spaces before them are
encoded one by one; words of like length go through the agenda together, one merge
of each word a round. A round looks only at the two pairs that the last merge made.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.ngrams import mix
from metacurate.llm.registry import query, table

SEED, DROPOUT = 17, 0.1
SPACE_MARK = "▁"
_UNIT = re.compile(" *[^ ]+| +")
_LONG = 200  # words of more characters have an agenda of their own
_GROUP = 64  # documents that are split into words together
_CHARS = 400_000  # characters whose words are encoded together
_WIDTHS = np.array([*range(1, 17), 20, 24, 32, 48, 80, 128, _LONG])  # words are padded to the next width
_EMPTY, _GONE = -3, -2  # no pair in a slot; a symbol that went into another, or padding
_NEVER = np.iinfo(np.int32).max
_SLOT = np.uint64(0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1
_PLACE, _LEFT, _RIGHT, _WORD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5

_models: dict[str, "Pieces"] = {}


def _mix(h: int) -> int:
    """``ngrams.mix`` of one value."""
    h &= _MASK
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & _MASK
    return h ^ (h >> 31)


def keyed(*parts: object) -> int:
    return int.from_bytes(blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Pieces:
    """Pieces, scores and possible merges of a model file of merge type with byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = [model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i) for i in range(len(names))]
        ids = {p: i for i, p in enumerate(names) if not special[i]}
        self.byte_ids = np.array([names.index(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.bytes_of = [b"" if s else p.replace(SPACE_MARK, " ").encode() for p, s in zip(names, special, strict=True)]
        for b, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([b])
        self.of_char = np.full(0x110000, -1, np.int64)
        for p, i in ids.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        self.of_char[ord(" ")] = self.of_char[ord(SPACE_MARK)]
        self.of_char[ord(SPACE_MARK)] = -1  # the mark itself in a text goes by its bytes, or it would come back as a space
        scores = np.array([model.get_score(i) for i in range(len(names))])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.merges = {
            (ids[p[:k]] << 32) | ids[p[k:]]: i for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids
        }
        self._index_pairs()

    def _index_pairs(self) -> None:
        """A hash table of the pairs that merge, with linear probing and many free slots."""
        pairs = np.array(list(self.merges), np.int64)
        merged = np.array(list(self.merges.values()), np.int32)
        bits = max(4, (8 * len(pairs)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.pair = np.full(1 << bits, _EMPTY, np.int64)
        self.pair_merged, self.pair_rank = np.zeros(1 << bits, np.int32), np.full(1 << bits, _NEVER, np.int32)
        slots, left = self._slots(pairs), np.arange(len(pairs))
        while len(left):
            free = np.flatnonzero(self.pair[slots[left]] == _EMPTY)
            taken, first = np.unique(slots[left[free]], return_index=True)
            self.pair[taken] = pairs[left[free[first]]]
            self.pair_merged[taken] = merged[left[free[first]]]
            self.pair_rank[taken] = self.rank[merged[left[free[first]]]]
            left = left[self.pair[slots[left]] != pairs[left]]
            slots[left] = (slots[left] + 1) & self.last

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * _SLOT) >> self.shift).astype(np.int64)

    def _lookup(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs merge, by index, and their slots."""
        slots = self._slots(pairs)
        at = self.pair[slots]
        open_ = np.flatnonzero((at != pairs) & (at != _EMPTY))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.last
            at[open_] = self.pair[slots[open_]]
            open_ = open_[(at[open_] != pairs[open_]) & (at[open_] != _EMPTY)]
        found = np.flatnonzero(at == pairs)
        return found, slots[found]

    def _finish(self, char: int, piece: int) -> list[int]:
        return [piece] if piece >= 0 else self.byte_ids[list(chr(char).encode("utf-8", "surrogatepass"))].tolist()

    def encode_long(self, word: str, key: int, bar: int) -> bytes:
        """One word by a heap of candidate merges."""
        chars = [ord(c) for c in word]
        ids = self.of_char[chars].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def propose(i: int) -> None:
            j = after[i] if i >= 0 else len(ids)
            if j < len(ids) and ids[i] >= 0 and ids[j] >= 0:
                found = self.merges.get((ids[i] << 32) | ids[j])
                if found is not None and _mix(key + i * _PLACE + ids[i] * _LEFT + ids[j] * _RIGHT) >= bar:
                    heapq.heappush(agenda, (int(self.rank[found]), i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            propose(i)
        while agenda:
            _, i, left, right = heapq.heappop(agenda)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue  # one of them went into another merge
            ids[i], ids[j] = self.merges[(left << 32) | right], -2
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            propose(i)
            propose(before[i])
        out = [x for c, i in zip(chars, ids, strict=True) if i != -2 for x in self._finish(c, i)]
        return np.array(out, "<u4").tobytes()

    def encode_words(self, words: list[str], keys: list[int] | np.ndarray, bar: int) -> list[bytes]:
        """Many words; each round makes the best remaining merge of each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        first, key = np.cumsum(sizes) - sizes, np.array(keys, np.uint64)
        widths = np.union1d(_WIDTHS, sizes[sizes > _LONG])
        width = np.searchsorted(widths, sizes)
        out: list[bytes] = [b""] * len(words)
        for w in np.unique(width).tolist():
            some = np.flatnonzero(width == w)
            columns = np.arange(widths[w])
            inside = columns < sizes[some, None]
            letters = np.where(inside, chars[np.where(inside, first[some, None] + columns, 0)], -1)
            ids = self._merge_all(np.where(inside, self.of_char[letters], _GONE), key[some], bar)
            stays = ids != _GONE
            ends = np.cumsum(stays.sum(1))
            flat = ids[stays].astype("<u4").tobytes()
            for i, a, b in zip(some.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                out[i] = flat[4 * a : 4 * b]
            for r in np.flatnonzero((ids == -1).any(1)).tolist():  # characters without a piece
                own = [x for c, i in zip(letters[r].tolist(), ids[r].tolist(), strict=True) if i != _GONE for x in self._finish(c, i)]
                out[int(some[r])] = np.array(own, "<u4").tobytes()
        return out

    def _merge_all(self, symbols: np.ndarray, key: np.ndarray, bar: int) -> np.ndarray:
        """The symbols of each row after all its merges, at the place of their first; ``_GONE`` elsewhere."""
        n, width = symbols.shape
        step = width + 1  # one more column stands for "none" on either side
        ids = np.full((n, step), _GONE, np.int64)
        ids[:, :width] = symbols
        ids = ids.ravel()
        after = np.tile(np.append(np.arange(1, step), width), n)
        before = np.tile(np.append([width], np.arange(width)), n)
        rank, merged = np.full(n * step, _NEVER, np.int32), np.zeros(n * step, np.int32)

        def propose(row: np.ndarray, place: np.ndarray, at: np.ndarray, right: np.ndarray) -> None:
            """Priority of the pair of the symbol at ``at`` and the one at ``right``."""
            pairs = (ids[at] << 32) | ids[right]
            found, slots = self._lookup(pairs)
            if bar:
                pair = pairs[found].astype(np.uint64)
                h = key[row[found]] + place[found].astype(np.uint64) * np.uint64(_PLACE)
                h += (pair >> np.uint64(32)) * np.uint64(_LEFT) + (pair & np.uint64(0xFFFFFFFF)) * np.uint64(_RIGHT)
                go = mix(h) >= np.uint64(bar)
                found, slots = found[go], slots[go]
            rank[at] = _NEVER
            rank[at[found]] = self.pair_rank[slots]
            merged[at[found]] = self.pair_merged[slots]

        place = np.tile(np.arange(width - 1), n)
        row = np.repeat(np.arange(n), width - 1)
        propose(row, place, row * step + place, row * step + place + 1)
        row = np.arange(n)
        table = rank.reshape(n, step)
        while True:
            best = table[row].argmin(1)
            at = row * step + best
            busy = rank[at] != _NEVER
            if not busy.all():
                row, best, at = row[busy], best[busy], at[busy]
            if not len(row):
                return ids.reshape(n, step)[:, :width]
            base = row * step
            joined = base + after[at]
            right = after[joined]
            ids[at], ids[joined], rank[joined] = merged[at], _GONE, _NEVER
            after[at], before[base + right] = right, best
            left = before[at]
            row2 = np.concatenate([row, row])
            propose(row2, np.concatenate([best, left]), np.concatenate([at, base + left]), np.concatenate([base + right, at]))

    def encode(self, texts: list[str], names: list[object], seed: int, dropout: float) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; the hash is keyed by the text's name and the word's number in it."""
        bar = min(int(dropout * 2**64), _MASK)
        split = [_UNIT.findall(" " + t) if t else [] for t in texts]
        words = [w for ws in split for w in ws]
        counts = np.array([len(ws) for ws in split], np.int64)
        ends = np.cumsum(counts)
        number = (np.arange(len(words)) - np.repeat(ends - counts, counts)).astype(np.uint64)
        keys = mix(np.repeat(np.array([keyed(seed, n) for n in names], np.uint64), counts) + number * np.uint64(_WORD))
        sizes = np.array([len(w) for w in words], np.int64)
        ids = [b""] * len(words)
        for i in np.flatnonzero(sizes > _LONG).tolist():
            ids[i] = self.encode_long(words[i], int(keys[i]), bar)
        short = np.flatnonzero(sizes <= _LONG)
        group = np.cumsum(sizes[short]) // _CHARS
        for some in np.split(short, np.flatnonzero(np.diff(group)) + 1) if len(short) else []:
            for i, cut in zip(some.tolist(), self.encode_words([words[i] for i in some.tolist()], keys[some], bar), strict=True):
                ids[i] = cut
        return [b"".join(ids[end - n : end]) for end, n in zip(ends.tolist(), counts.tolist(), strict=True)]

    def decode(self, ids: bytes) -> str:
        """The text of some ids; the space that leads the first word is not part of it."""
        data = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data[1:].decode("utf-8", "surrogatepass")


def pieces(path: str) -> Pieces:
    """The model of this worker process."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode_documents(docs: DataFrame, model: str, seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """``doc_id, text, ids`` of ``docs(doc_id, text)``; ids are little-endian 32-bit integers in one binary.

    Every occurrence of a word is cut on its own, by its document's id and its
    number in the text; rows with equal ids and texts are cut alike. ``dropout`` 0
    gives the plain segmentation. Null and empty texts have no ids. Every text
    decodes to itself.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pieces(model)
        for whole in batches:
            for start in range(0, whole.num_rows, _GROUP):
                batch = whole.slice(start, _GROUP)
                ids = found.encode([t or "" for t in batch.column(1).to_pylist()], batch.column(0).to_pylist(), seed, dropout)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["doc_id", "text", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(encode, "doc_id bigint, text string, ids binary")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """Add ``decoded``, the text of ``ids``; null ids give an empty text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pieces(model)
        for batch in batches:
            texts = [found.decode(i or b"") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(decode, f"{schema}, decoded string")


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op5_piece_round_trip")
def op5_piece_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    decoded = decode_documents(encode_documents(table(spark, sf, "documents"), public_model()), public_model())
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )
