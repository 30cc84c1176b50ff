"""Byte-pair encoding as a bounded-lookahead streaming transducer, and streaming decoding.

Merges overlap, so a byte can change how bytes before it are merged, but only through a chain of
ever earlier merges, each overlapping the next. The longest such chain over a merge list bounds
how far to the right a token depends on its text: the sufficient lookahead. The encoder holds
that many bytes beyond what it may emit, whatever the length of the text. What follows an
emitted token is encoded as if it stood alone, since any tail of an encoding is the encoding of
its own bytes.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.pieces import Codes, cut
from sluice.llm.rows import map_rows

# The pre-tokenizer's pattern; a fixed value of the format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPLIT = regex.compile(PATTERN)
# A match is final once this many characters after it are known: the longest contraction has two more.
_AHEAD = 3
WINDOW = 1 << 16
SHORT = 48
PACKED = np.dtype("<u4")
BATCH_CHARS = 1 << 17


@cache
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: itself if it is printable, else the next from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


class MergeList:
    """A byte-level vocabulary with its merges, and their sufficient lookahead."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]], special: dict[str, int]):
        letters = byte_letters()
        self.special = special
        self.bytes_of = {code: bytes(map(letters.__getitem__, token)) for token, code in vocabulary.items()}
        self.bytes_of |= {code: token.encode() for token, code in special.items()}
        self.decimals = list(map(str, range(max(self.bytes_of) + 1)))
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocabulary[letter]
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for left, right in merges:
            self.ranks[vocabulary[left], vocabulary[right]] = len(self.merged)
            self.merged.append(vocabulary[left + right])
        self._byte_ids, self._merged = np.array(self.byte_ids), np.array(self.merged)
        pairs = np.array(list(self.ranks), np.int64).reshape(-1, 2)
        keys = (pairs[:, 0] << 32) | pairs[:, 1]
        self._key_ranks = np.argsort(keys)
        self._keys = keys[self._key_ranks]
        self._key_ranks = np.array(list(self.ranks.values()))[self._key_ranks]
        self.longest = max(map(len, self.bytes_of.values()))
        self.lookahead = self._sufficient_lookahead()
        self.special_pattern = (
            regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        )

    @staticmethod
    @cache
    def from_file(path: str) -> MergeList:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        merges = (tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge) for merge in data["model"]["merges"])
        special = {token["content"]: token["id"] for token in data["added_tokens"]}
        vocabulary = {token: code for token, code in data["model"]["vocab"].items() if token not in special}
        return MergeList(vocabulary, merges, special)

    def _sufficient_lookahead(self) -> int:
        """The most bytes after a token that can decide whether it is one.

        ``reach[p]`` is, over the merges so far whose bytes begin with ``p``, the largest sum of
        a merge's length and what itself depends on beyond its end. A merge depends on earlier
        merges that begin within it and end after it: on a ``p`` that is one of its tails.
        """
        reach: dict[bytes, int] = {}
        most = 0
        for code in self.merged:
            token = self.bytes_of[code]
            size = len(token)
            beyond = max((reach.get(token[at:], 0) - (size - at) for at in range(1, size)), default=0)
            total = size + max(0, beyond)
            most = max(most, total - 1)
            for end in range(1, size):
                if reach.get(token[:end], 0) < total:
                    reach[token[:end]] = total
        return most

    def encode(self, data: bytes) -> list[int]:
        """All of ``data`` by the merge list."""
        return self._encode_long([self.byte_ids[byte] for byte in data])

    def encode_batch(self, tokens: list[bytes]) -> list[bytes]:
        """The packed ids of many short pre-tokens at once: a round makes the first best merge of each that has one."""
        if not tokens:
            return []
        none = len(self.merged)
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        word = np.repeat(np.arange(len(tokens)), size)
        ids = self._byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
        rank = np.full(len(ids), none)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self._ranks_of(ids[inner], ids[inner + 1])
        out = [b""] * len(tokens)
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(ids)))
            done = best == none
            if done.any():
                packed = ids.astype(PACKED).tobytes()
                begin, end = PACKED.itemsize * first[done], PACKED.itemsize * (first + size)[done]
                for at, start, stop in zip(word[first[done]].tolist(), begin.tolist(), end.tolist(), strict=True):
                    out[at] = packed[start:stop]
                stay = np.repeat(~done, size)
                ids, word, rank = ids[stay], word[stay], rank[stay]
                best, size = best[~done], size[~done]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]
            ids[at] = self._merged[best]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            at -= np.arange(len(at))
            ids, word, rank = ids[stay], word[stay], rank[stay]
            rank[at] = none
            for left in (at, at[at > 0] - 1):
                left = left[left + 1 < len(ids)]
                left = left[word[left] == word[left + 1]]
                rank[left] = self._ranks_of(ids[left], ids[left + 1])
        return out

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._key_ranks[at], len(self.merged))

    def _encode_long(self, ids: list[int]) -> list[int]:
        """A heap over a linked list: n log n."""
        ranks, merged = self.ranks.get, self.merged
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = []
        for at in range(len(ids) - 1):
            rank = ranks((ids[at], ids[at + 1]))
            if rank is not None:
                heap.append((rank, at, ids[at], ids[at + 1]))
        heapq.heapify(heap)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            follow = after[at]
            if ids[at] != left or follow < 0 or ids[follow] != right:
                continue
            ids[at], ids[follow] = merged[rank], -1
            after[at] = beyond = after[follow]
            if beyond >= 0:
                before[beyond] = at
                rank = ranks((ids[at], ids[beyond]))
                if rank is not None:
                    heapq.heappush(heap, (rank, at, ids[at], ids[beyond]))
            if (ahead := before[at]) >= 0:
                rank = ranks((ids[ahead], ids[at]))
                if rank is not None:
                    heapq.heappush(heap, (rank, ahead, ids[ahead], ids[at]))
        return [code for code in ids if code >= 0]

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """The ids of one pre-token that comes in chunks, each emitted once it is stable.

        Holds two lookaheads and a token, and the chunk that came last.
        """
        held = b""
        full = 2 * self.lookahead + self.longest
        for chunk in chunks:
            held += chunk
            while len(held) > full:
                window = held[:full]
                at, stable = 0, len(window) - self.lookahead
                for code in self.encode(window):
                    if at + len(self.bytes_of[code]) > stable:
                        break
                    at += len(self.bytes_of[code])
                    yield code
                held = held[at:]
        yield from self.encode(held)


def pretokens(text: str, window: int = WINDOW) -> Iterator[str | Iterator[bytes]]:
    """The pre-tokens of a text. One that does not fit a window comes as the chunks of its bytes."""
    at, end = 0, len(text)
    while at < end:
        part = text[at : at + window]
        if at + window >= end:
            yield from _SPLIT.findall(part)
            return
        cut_at = len(part) - _AHEAD
        done = 0
        for match in _SPLIT.finditer(part):
            if match.end() > cut_at:
                break
            yield match[0]
            done = match.end()
        if not done:
            whole = _SPLIT.match(text, at)
            stop = whole.end()
            yield (_utf8(text[i : min(i + window, stop)]) for i in range(at, stop, window))
            done = stop - at
        at += done


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, PACKED).tobytes()


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Encoder:
    """Pieces of text to packed ids. Short pre-tokens are encoded many at a time, long ones are streamed."""

    def __init__(self, merges: MergeList):
        self.merges = merges

    def encode(self, pieces: list[str]) -> list[bytes]:
        split = [self._split(piece) for piece in pieces]
        tokens = list({token for parts in split for token in parts if isinstance(token, str)})
        known = dict(zip(tokens, self.merges.encode_batch(list(map(_utf8, tokens))), strict=True))
        return [
            known[parts[0]]
            if len(parts) == 1 and isinstance(parts[0], str)
            else b"".join([known[part] if isinstance(part, str) else part for part in parts])
            for parts in split
        ]

    def _split(self, text: str) -> list[str | bytes]:
        """Short pre-tokens as they are; the packed ids of long ones and of special tokens."""
        if len(text) <= SHORT and text[text.startswith(" ") :].isalpha():
            return [text]
        found: list[str | bytes] = []
        at = 0
        special = self.merges.special
        if any(token in text for token in special):
            for match in self.merges.special_pattern.finditer(text):
                found += self._plain(text[at : match.start()])
                found.append(packed([special[match[0]]]))
                at = match.end()
        return found + self._plain(text[at:])

    def _plain(self, text: str) -> list[str | bytes]:
        if len(text) <= SHORT:
            return _SPLIT.findall(text)
        found: list[str | bytes] = []
        for token in pretokens(text):
            if not isinstance(token, str):
                found.append(packed(self.merges.stream(token)))
            elif len(token) > SHORT:
                found.append(packed(self.merges.stream([_utf8(token)])))
            else:
                found.append(token)
        return found


class Decoder:
    """Ids to text, step by step: bytes of an unfinished character wait for the next ids.

    Bytes that are no UTF-8 become U+FFFD, one for each longest beginning of a character.
    """

    def __init__(self, merges: MergeList):
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], final: bool = False) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)), final)


@cache
def piece_codes(path: str) -> Codes:
    """One for all tasks of a worker, so words are looked up that an earlier task met."""
    return Codes(Encoder(MergeList.from_file(path)).encode)


def encode_texts(df: DataFrame, path: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of its texts; a null text is empty. A column that has the name is replaced."""
    return _with_codes(df, path, text, f"`{ids}` array<int>", (ids,), lambda codes, merges: (codes,))


def round_trip(df: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: encoded, then decoded from the ids.

    A null text is empty and has no ids; null and repeated ids are answered row by row; other
    columns are ignored; no rows give no rows.
    """

    def digests(codes, merges):
        decoder = Decoder(merges)
        decoded = hashlib.sha256()
        listed = hashlib.sha256()
        for at in range(0, len(codes), 4096):
            some = codes[at : at + 4096].tolist()
            decoded.update(_utf8(decoder.feed(some)))
            listed.update(("," * (at > 0) + ",".join(map(merges.decimals.__getitem__, some))).encode())
        decoded.update(_utf8(decoder.feed((), final=True)))
        return len(codes), listed.hexdigest(), decoded.hexdigest()

    new = ("n_tokens", "ids_sha256", "decoded_sha256")
    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return _with_codes(source, path, "text", fields, new, digests).drop("text")


def _with_codes(df: DataFrame, path: str, text: str, fields: str, new: tuple[str, ...], result) -> DataFrame:
    source = df.drop(*new)
    at = source.columns.index(text)
    given = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in source.schema)

    def work(rows):
        merges = MergeList.from_file(path)
        codes = piece_codes(path)

        def batches():
            held, size = [], 0
            for row in rows:
                held.append((row, cut(row[at] or "")))
                size += len(row[at] or "")
                if size >= BATCH_CHARS:
                    yield held
                    held, size = [], 0
            yield held

        for held in batches():
            found = codes.of([piece for _, pieces in held for piece in pieces])
            done = 0
            for row, pieces in held:
                ids = np.frombuffer(b"".join(found[done : done + len(pieces)]), PACKED)
                done += len(pieces)
                yield (*row, *result(ids, merges))

    return map_rows(source, work, f"{given}, {fields}")
