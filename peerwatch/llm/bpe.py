"""Operator 5: byte-pair encoding without merge loops, and decoding by an offset table.

Each piece that the pre-tokenizer cuts out is encoded from left to right: take the longest token that starts here (an
Aho-Corasick automaton over the reversed piece gives them for all places in one pass), keep it if it may stand beside
the token before it, else try the next shorter one, else step back by one token.  Two tokens may stand side by side
if merging their bytes by rank would give just these two; the answers are kept in a table of pairs.  A place that
was found to be a dead end is never tried again, so the time is linear in the piece and the result is exactly that of
merging by rank.

Decoding copies bytes: all tokens stand in one byte string, and a table of offsets says where each begins.

Scale: no shuffle; a batch of rows at a time, whole texts.  Each Python worker keeps the ids of pieces it has seen, in
a table of bounded size that is emptied when full, which changes nothing but time.

Defined results: a null text counts as empty and has no tokens; the vocabulary's special tokens are found in texts as
the library does; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.llm.common import table, text_of

#: The pre-tokenizer's pattern; a fixed value of the vocabulary's format.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEEN_PIECES = 400_000
SEEN_PAIRS = 1_000_000
LONGEST_KEPT = 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that the vocabulary writes for each byte: itself if printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


class _Seen(dict):
    """Ids of pieces as little-endian bytes, computed when first asked for."""

    def __init__(self, make, room):
        super().__init__()
        self.make, self.room = make, room

    def __missing__(self, piece):
        ids = self.make(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self.room:
                self.clear()
            self[piece] = ids
        return ids


class Bpe:
    """The encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        letters = {c: b for b, c in enumerate(byte_letters())}
        raw = lambda token: bytes(letters[c] for c in token)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.find = regex.compile(PIECES).findall
        size = 1 + max([*vocab.values(), *special.values()])
        table = [b""] * size
        for t, i in vocab.items():
            table[i] = raw(t)
        for s, i in special.items():
            table[i] = s.encode()
        self.bytes_of = table
        lengths = np.fromiter(map(len, table), np.int64, size)
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        self.pool = np.frombuffer(b"".join(table), np.uint8)
        # A merge's place in the list is its rank; tokens of one byte come before all merges.
        self.rank_of_pair, self.halves, self.order = {}, {}, {}
        for i in vocab.values():
            if len(table[i]) == 1:
                self.order[i], self.halves[i] = -1, None
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if (whole := vocab.get(left + right)) is None:
                continue
            pair = vocab[left], vocab[right]
            self.rank_of_pair[pair] = rank
            if whole not in self.halves:
                self.halves[whole], self.order[whole] = pair, rank
        # A token that merging its own bytes does not give can never be part of a result.
        self.id_of = {table[i]: i for i in self.halves if self._reachable(i)}
        # The automaton reads from the end: the longest word that ends in the reversed piece starts here in the piece.
        self.automaton = ahocorasick.Automaton()
        for token, i in self.id_of.items():
            self.automaton.add_word(token[::-1].decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.beside: dict[tuple[int, int], bool] = {}
        self.seen = _Seen(self._piece, SEEN_PIECES)

    def _next_shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.shorter:
            whole = self.bytes_of[token]
            found = (self.id_of.get(whole[:n]) for n in range(len(whole) - 1, 0, -1))
            self.shorter[token] = next((i for i in found if i is not None), None)
        return self.shorter[token]

    def _may_meet(self, left: int, right: int) -> bool:
        if (known := self.beside.get((left, right))) is None:
            if len(self.beside) >= SEEN_PAIRS:
                self.beside.clear()
            known = self.beside[left, right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """True if merging by rank never crosses the border between the two tokens.

        The border is looked at back in time: the halves at the border are taken apart, the later merge first.  A
        merge across it would have happened if its rank is below those of the merges that made its two sides part of
        something larger.
        """
        none = len(self.rank_of_pair) + 1
        left_at = right_at = none  # when the side was merged into what stands around it
        while True:
            across = self.rank_of_pair.get((left, right))
            # Of equal pairs the one further left is merged first, so a tie goes to the left side's own merge.
            if across is not None and across < left_at and across <= right_at:
                return False
            split_left, split_right = self.order[left], self.order[right]
            if split_left < 0 and split_right < 0:
                return True
            if split_left >= split_right:
                left_at, left = split_left, self.halves[left][1]
            else:
                right_at, right = split_right, self.halves[right][0]

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        whole = self.id_of.get(raw)
        if whole is not None:
            return whole.to_bytes(4, "little")
        n = len(raw)
        longest = [None] * n
        for end, (token, size) in self.automaton.iter(raw[::-1].decode("latin-1")):
            start = n - 1 - end
            if longest[start] is None or size > len(self.bytes_of[longest[start]]):
                longest[start] = token
        open_ = bytearray(b"\x01") * (n + 1)
        tokens: list[int] = []
        at, token = 0, longest[0]
        may_meet, sizes = self._may_meet, self.bytes_of
        while at < n:
            end = at + len(sizes[token])
            if open_[end] and (not tokens or may_meet(tokens[-1], token)):
                tokens.append(token)
                at = end
                token = longest[at] if at < n else None
                continue
            token = self._next_shorter(token)
            while token is None:
                # Nothing fits here: the place is closed, and the token before it must become shorter.
                open_[at] = 0
                last = tokens.pop()
                at -= len(sizes[last])
                token = self._next_shorter(last)
        return np.asarray(tokens, "<u4").tobytes()

    @lru_cache(maxsize=None)  # noqa: B019 - one entry for each token at most, and the object lives as long as the worker
    def _reachable(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        if self.halves[token] is None:
            return True
        left, right = self.halves[token]
        return self._reachable(left) and self._reachable(right) and self._becomes(left, right)

    def _becomes(self, left: int, right: int) -> bool:
        # The halves must be what stands on either side before they are merged.
        rank = self.rank_of_pair.pop((left, right))
        try:
            return self._compatible(left, right)
        finally:
            self.rank_of_pair[left, right] = rank

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        seen = self.seen
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(map(seen.__getitem__, self.find(text)))
        out = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            else:
                out.extend(map(seen.__getitem__, self.find(part)))
        return b"".join(out)

    def decode(self, ids: bytes, window: int = 1 << 20) -> str:
        """The text of ids; windows bound the memory."""
        numbers, parts = np.frombuffer(ids, "<u4"), []
        for i in range(0, len(numbers), window):
            some = numbers[i : i + window]
            starts = self.offsets[some]
            sizes = self.offsets[some + 1] - starts
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
            parts.append(self.pool[places].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _loaded(path: str) -> Bpe:
    return Bpe(path)


ENCODED = "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian 32-bit), digests of the ids and the decoded text."""
    path = vocabulary or default_vocabulary()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path)
        for batch in batches:
            # Some rows at a time: ids take about as much room as texts.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [bpe.encode(t) for t in part.column(1).to_pylist()]
                sha = [hashlib.sha256(i).hexdigest() for i in ids]
                back = [hashlib.sha256(bpe.decode(i).encode("utf-8", "replace")).hexdigest() for i in ids]
                n = [len(i) // 4 for i in ids]
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(work, ENCODED)


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(table(spark, folder, "documents")).drop("ids")
