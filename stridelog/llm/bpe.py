"""BPE encoding by speculation: greedy longest matches, checked pair by pair, merged if wrong.

A vocabulary file of the word-end kind is read on the driver and broadcast (its size is that
of the file). Texts are cut at white space; per worker each new word is encoded once.

Why the check suffices: a token sequence is the one that merging gives exactly if every token
is what its own bytes merge to and every adjacent pair is what the pair's bytes merge to.
"""

from __future__ import annotations

import functools
import heapq
import json
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import unicodedata
from pyspark.sql import DataFrame

from stridelog.llm.textbatch import batches

WORD_END = "</w>"

# Fixed values of the vocabulary's format: the pieces into which it cuts a normalized text, and
# the characters that stand for bytes.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+|\n")
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# Entries a worker remembers before it starts afresh: words, and pairs of tokens.
MAX_WORDS, MAX_PAIRS = 500_000, 1_000_000


def _byte_chars() -> dict[str, int]:
    """The character of each byte: itself if it is shown, else one from 256 upwards."""
    hidden = [b for b in range(256) if b not in set(_SHOWN)]
    return {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordBpe:
    """A vocabulary with merges and word ends.

    A symbol is (bytes, whether it ends the word). ``merge`` is exact and slow, ``propose``
    only guesses.
    """

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = _byte_chars()
        symbols: dict[str, tuple[bytes, bool]] = {}
        for char, byte in byte_of.items():
            symbols[char] = (bytes([byte]), False)
            symbols[char + WORD_END] = (bytes([byte]), True)
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = symbols[left], symbols[right]
            symbols[left + right] = (a[0] + b[0], b[1])
            ids = self.vocab[left], self.vocab[right]
            self.ranks[ids] = rank
            self.merged.append((*ids, self.vocab[left + right]))
        self.symbol = {self.vocab[s]: value for s, value in symbols.items() if s in self.vocab}
        self.first = [[0] * 256, [0] * 256]
        for char, byte in byte_of.items():
            self.first[0][byte] = self.vocab[char]
            self.first[1][byte] = self.vocab[char + WORD_END]
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.shown = np.full(size, b"", dtype=object)
        self._encoder: Encoder | None = None
        for text, i in [*self.vocab.items(), *self.special.items()]:
            self.shown[i] = text.encode()
        # Only tokens that their own bytes merge to can be proposed.
        self.longest: tuple[dict[bytes, int], dict[bytes, int]] = ({}, {})
        for i, (data, ends) in self.symbol.items():
            if self.merge(data, ends) == [i]:
                self.longest[ends][data] = i
        self.most = max(map(len, [*self.longest[0], *self.longest[1]]))
        self.special_cut = regex.compile(
            "(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def merge(self, data: bytes, ends: bool = True) -> list[int]:
        """Exact merging: the pair of lowest rank first, from the left."""
        ids = [self.first[0][b] for b in data]
        if ends and data:
            ids[-1] = self.first[1][data[-1]]
        # Neighbours are linked and pairs wait in a heap, so a word of n bytes takes n log n steps.
        # A pair that a merge has changed since it was filed no longer has its two symbols.
        rank_of, size = self.ranks.get, len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        waiting = [(rank, at) for at, rank in enumerate(map(rank_of, zip(ids, ids[1:])))
                   if rank is not None]
        heapq.heapify(waiting)
        while waiting:
            rank, at = heapq.heappop(waiting)
            left, right, made = self.merged[rank]
            other = after[at]
            if ids[at] != left or other == size or ids[other] != right:
                continue
            ids[at], ids[other] = made, -1
            after[at] = end = after[other]
            if end < size:
                before[end] = at
                if (rank := rank_of((made, ids[end]))) is not None:
                    heapq.heappush(waiting, (rank, at))
            start = before[at]
            if start >= 0 and (rank := rank_of((ids[start], made))) is not None:
                heapq.heappush(waiting, (rank, start))
        return [i for i in ids if i >= 0]

    def propose(self, data: bytes) -> list[int]:
        """Greedy longest matches over the bytes of a word; the last one must end the word."""
        ids, at, size = [], 0, len(data)
        mid, last = self.longest
        while at < size:
            whole = last.get(data[at:]) if size - at <= self.most else None
            if whole is not None:
                ids.append(whole)
                break
            for end in range(min(size - 1, at + self.most), at, -1):
                token = mid.get(data[at:end])
                if token is not None:
                    ids.append(token)
                    at = end
                    break
        return ids

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without special tokens; line feeds stand between as they are."""
        if not text.isascii():
            # Letters are lowered one by one, so a final sigma is like any other.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return _PIECE.findall(text.lower())

    def encoder(self) -> Encoder:
        """This process's memory for the vocabulary; tasks that follow each other share it."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_encoder": None}


class Encoder:
    """A worker's memory: ids of words seen, and which pairs of tokens may stand together."""

    def __init__(self, bpe: WordBpe) -> None:
        self.bpe = bpe
        self.words: dict[bytes, bytes] = {}
        self.pairs = np.zeros(0, dtype=np.int64)
        self.fits = np.zeros(0, dtype=bool)

    def _pairs_fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of two tokens gives these two, for every pair at once."""
        keys = left.astype(np.int64) << 32 | right
        wanted = np.unique(keys)
        new = wanted[~np.isin(wanted, self.pairs, assume_unique=True)]
        if len(new):
            if len(self.pairs) > MAX_PAIRS:
                self.pairs, self.fits, new = self.pairs[:0], self.fits[:0], wanted
            found = np.fromiter(map(self._fits, new.tolist()), dtype=bool, count=len(new))
            pairs, fits = np.append(self.pairs, new), np.append(self.fits, found)
            order = np.argsort(pairs)
            self.pairs, self.fits = pairs[order], fits[order]
        return self.fits[np.searchsorted(self.pairs, keys)]

    def _fits(self, key: int) -> bool:
        a, b = key >> 32, key & 0xFFFFFFFF
        (left, _), (right, ends) = self.bpe.symbol[a], self.bpe.symbol[b]
        return self.bpe.merge(left + right, ends) == [a, b]

    def learn(self, words: Iterable[bytes]) -> None:
        """Encode the words not known yet, all of them together."""
        new = [w for w in words if w not in self.words]
        if len(self.words) > MAX_WORDS:
            self.words.clear()
            new = list(words)
        if not new:
            return
        bpe = self.bpe
        # A special token in a text is itself; what stands around it is cut as usual.
        text = b"\n".join(new).decode("utf-8", "replace") + "\n"
        parts = bpe.special_cut.split(text) if bpe.special_cut is not None else [text]
        cut: list[str] = []
        for part in parts:
            cut.extend([part] if part in bpe.special else bpe.pieces(part))
        packed = self._pack(set(cut) - bpe.special.keys() - {"\n"})
        packed |= {name: struct.pack("<I", i) for name, i in bpe.special.items()}
        at = 0
        for word in new:
            end = cut.index("\n", at)
            self.words[word] = b"".join([packed[p] for p in cut[at:end]])
            at = end + 1

    def _pack(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of pieces: proposed, checked pair by pair, merged where a pair fails."""
        data = [p.encode() for p in pieces]
        proposed = list(map(self.bpe.propose, data))
        lengths = np.fromiter(map(len, proposed), dtype=np.int64, count=len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), dtype=np.int64)
        owner = np.repeat(np.arange(len(data)), lengths)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        wrong = inner[~self._pairs_fit(flat[inner], flat[inner + 1])] if len(inner) else inner
        for i in np.unique(owner[wrong]).tolist():
            proposed[i] = self.bpe.merge(data[i])
        return {p: struct.pack(f"<{len(ids)}I", *ids) for p, ids in zip(pieces, proposed)}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        split = [t.split() for t in texts]
        self.learn(set().union(*split))
        known = self.words.__getitem__
        return [b"".join(map(known, words)) for words in split]

    def decode(self, packed: bytes) -> bytes:
        """The tokens in their written form, one space between."""
        return b" ".join(self.bpe.shown[np.frombuffer(packed, dtype="<u4")].tolist())


@functools.lru_cache(maxsize=2)
def read_vocabulary(path: str) -> WordBpe:
    with open(path, encoding="utf-8") as file:
        return WordBpe(json.load(file))


def encode_decode(docs: DataFrame, path: str, text_col: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all but the text and the added names), ``ids`` and
    ``decoded``.

    ``ids`` is binary: the token ids as little-endian unsigned 32-bit integers, with no token
    added. ``decoded`` is made from the ids again. A null or empty text gives no ids and the
    empty text. Rows are handled one by one, so repeated rows give repeated results. ``path``
    is a vocabulary file that the driver can read.
    """
    added = (text_col, "ids", "decoded")
    kept = [c for c in docs.columns if c not in added] if keep is None else keep
    bpe = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.value.encoder()
        for part in parts:
            for first, end, batch in batches(part.column(0)):
                ids = encoder.encode([batch.text(i) for i in range(batch.rows)])
                yield pa.RecordBatch.from_arrays(
                    [c.slice(first, end - first) for c in part.columns[1:]]
                    + [pa.array(ids, pa.binary()),
                       pa.array(map(encoder.decode, ids), pa.binary()).cast(pa.string())],
                    names=[*kept, "ids", "decoded"])

    plain = docs.select(text_col, *kept)
    schema = plain.drop(text_col).schema.add("ids", "binary").add("decoded", "string")
    return plain.mapInArrow(run, schema)
