"""Token ids in directly addressable codes.

An id is split into chunks of eight bits, lowest first. Level 0 holds the first chunk of every
id; a bitmap tells which ids go on, and level 1 holds the second chunk of those, and so on. A
rank directory counts the set bits before every 512th place of a bitmap, so the place of an id
in the next level, and with it any token, is found without decoding its neighbours.

File: segments one after another, a directory, and a tail that says where the directory is.
Numbers are little-endian.

* segment: ``ids`` u32, ``levels`` u32, then per level the count u32, the chunks, the bitmap in
  64-bit words and the rank directory u32 (no bitmap and directory on the last level)
* directory: ``segments`` u32, ``documents`` u32, per segment the file offset u64 and the ids
  before it u64, per document its key i64, 1 if the key is null u8, and the ids before its end u64
* tail: directory offset u64, magic
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.pieces import Codes, cut, cuts_at_spaces
from sluice.llm.rows import filesystem, map_rows, staged, utf8
from sluice.session import scratch_path

MAGIC = b"SLUICDAC"
BITS = 8
RANK_STEP = 512
SEGMENT_IDS = 1 << 20
FILE_IDS = 1 << 25
END_ID = 2
BATCH_CHARS = 1 << 22
READ_IDS = 1 << 16
JOINED = 200


class Codes8:
    """Directly addressable codes of one segment."""

    def __init__(self, levels: list[np.ndarray], bits: list[np.ndarray], ranks: list[np.ndarray]):
        self.levels, self.bits, self.ranks = levels, bits, ranks

    @staticmethod
    def of(ids: np.ndarray) -> Codes8:
        rest = np.asarray(ids, np.uint32)
        levels, bits, ranks = [], [], []
        while True:
            levels.append((rest & np.uint32(0xFF)).astype(np.uint8))
            on = rest > 0xFF
            if not on.any():
                return Codes8(levels, bits, ranks)
            packed = np.packbits(on, bitorder="little")
            words = np.zeros(-(-len(packed) // 64) * 64, np.uint8)
            words[: len(packed)] = packed
            words = words.view("<u8")
            ones = np.bitwise_count(words).astype(np.uint32)
            steps = ones.reshape(-1, RANK_STEP // 64).sum(axis=1, dtype=np.uint32)
            bits.append(words)
            ranks.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(steps, dtype=np.uint32)[:-1]]))
            rest = rest[on] >> np.uint32(BITS)

    def __len__(self) -> int:
        return len(self.levels[0])

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at some places, in any order: one look-up per level."""
        places = np.asarray(places, np.int64)
        out = np.zeros(len(places), np.uint32)
        live = np.arange(len(places))
        for level, chunks in enumerate(self.levels):
            out[live] |= chunks[places].astype(np.uint32) << np.uint32(BITS * level)
            if level == len(self.bits):
                break
            words, ranks = self.bits[level], self.ranks[level]
            word, bit = places >> 6, (places & 63).astype(np.uint64)
            on = (words[word] >> bit) & np.uint64(1) == 1
            places, live, word, bit = places[on], live[on], word[on], bit[on]
            if not len(live):
                break
            before = np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            first = (places // RANK_STEP) * (RANK_STEP // 64)
            for step in range(RANK_STEP // 64 - 1):
                whole = first + step
                before += np.where(whole < word, np.bitwise_count(words[whole]), 0)
            places = ranks[places // RANK_STEP].astype(np.int64) + before
        return out

    def all(self) -> np.ndarray:
        """All ids in order, level by level."""
        out = self.levels[0].astype(np.uint32)
        live = None
        for level, words in enumerate(self.bits):
            on = np.flatnonzero(np.unpackbits(words.view(np.uint8), count=len(self.levels[level]), bitorder="little"))
            live = on if live is None else live[on]
            out[live] |= self.levels[level + 1].astype(np.uint32) << np.uint32(BITS * (level + 1))
        return out

    def dump(self) -> bytes:
        out = [struct.pack("<II", len(self), len(self.levels))]
        for level, chunks in enumerate(self.levels):
            out += [struct.pack("<I", len(chunks)), chunks.tobytes()]
            if level < len(self.bits):
                out += [self.bits[level].astype("<u8").tobytes(), self.ranks[level].astype("<u4").tobytes()]
        return b"".join(out)

    @staticmethod
    def load(data: bytes) -> Codes8:
        _, number = struct.unpack_from("<II", data)
        at, levels, bits, ranks = 8, [], [], []
        for level in range(number):
            (count,) = struct.unpack_from("<I", data, at)
            levels.append(np.frombuffer(data, np.uint8, count, at + 4))
            at += 4 + count
            if level < number - 1:
                steps = max(1, -(-count // RANK_STEP))
                bits.append(np.frombuffer(data, "<u8", steps * RANK_STEP // 64, at))
                at += steps * RANK_STEP // 8
                ranks.append(np.frombuffer(data, "<u4", steps, at))
                at += 4 * steps
        return Codes8(levels, bits, ranks)


class Segment:
    """A segment in a file, of which only what is asked for is read: a range of places goes on in the next level as
    the range that the rank directory gives for its ends."""

    def __init__(self, source, at: int):
        self.source = source
        self.ids, number = struct.unpack("<II", self._read(at, 8))
        self.places: list[tuple[int, int, int]] = []
        at += 8
        for level in range(number):
            (count,) = struct.unpack("<I", self._read(at, 4))
            steps = max(1, -(-count // RANK_STEP)) if level < number - 1 else 0
            bits = at + 4 + count
            self.places.append((at + 4, bits, bits + steps * RANK_STEP // 8))
            at = bits + steps * RANK_STEP // 8 + 4 * steps

    def _read(self, at: int, count: int) -> bytes:
        self.source.seek(at)
        return self.source.read(count)

    def range(self, first: int, last: int, level: int = 0) -> np.ndarray:
        """The ids at the places from ``first`` to before ``last``, without the chunks of levels below ``level``."""
        chunks, bits, ranks = self.places[level]
        out = np.frombuffer(self._read(chunks + first, last - first), np.uint8).astype(np.uint32)
        if level + 1 < len(self.places) and first < last:
            # From the last rank before the range: its bits lead to the place where the range goes on.
            step = first // RANK_STEP
            word = step * (RANK_STEP // 64)
            words = np.frombuffer(self._read(bits + 8 * word, 8 * (-(-last // 64) - word)), np.uint8)
            on = np.unpackbits(words, bitorder="little")[: last - 64 * word]
            skipped = first - 64 * word
            live = np.flatnonzero(on[skipped:])
            if len(live):
                (rank,) = struct.unpack("<I", self._read(ranks + 4 * step, 4))
                begin = rank + int(np.count_nonzero(on[:skipped]))
                out[live] |= self.range(begin, begin + len(live), level + 1) << np.uint32(BITS)
        return out


class Writer:
    """Writes documents one after another; holds one segment and the directory."""

    def __init__(self, out: BinaryIO, segment_ids: int = SEGMENT_IDS):
        self.out, self.segment_ids = out, segment_ids
        self.held, self.count, self.ids, self.offset = [], 0, 0, 0
        self.segments: list[tuple[int, int]] = []
        self.keys: list[int | None] = []
        self.ends: list[int] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.ends.append(self.ids + self.count + len(ids))
        while len(ids):
            part, ids = ids[: self.segment_ids - self.count], ids[self.segment_ids - self.count :]
            self.held.append(part)
            self.count += len(part)
            if self.count == self.segment_ids:
                self._flush()

    def _flush(self) -> None:
        if self.count:
            data = Codes8.of(np.concatenate(self.held)).dump()
            self.segments.append((self.offset, self.ids))
            self.out.write(data)
            self.offset += len(data)
            self.ids += self.count
            self.held, self.count = [], 0

    def close(self) -> int:
        """Ends the file; the number of its ids."""
        self._flush()
        directory = [
            struct.pack("<II", len(self.segments), len(self.keys)),
            np.array(self.segments, "<u8").reshape(-1, 2).T.tobytes(),
            np.array([key or 0 for key in self.keys], "<i8").tobytes(),
            np.array([key is None for key in self.keys], np.uint8).tobytes(),
            np.array(self.ends, "<u8").tobytes(),
        ]
        self.out.write(b"".join(directory) + struct.pack("<Q", self.offset) + MAGIC)
        self.out.close()
        return self.ids


class Reader:
    """Random access to a file: any token by its place, any document by its number."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 16)
        tail = source.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        (self.end,) = struct.unpack("<Q", tail[:8])
        source.seek(self.end)
        data = source.read(size - 16 - self.end)
        segments, documents = struct.unpack_from("<II", data)
        table = np.frombuffer(data, "<u8", 2 * segments, 8).reshape(2, segments)
        self.offsets, self.firsts = table[0].astype(np.int64), table[1].astype(np.int64)
        at = 8 + 16 * segments
        keys = np.frombuffer(data, "<i8", documents, at).tolist()
        nulls = np.frombuffer(data, np.uint8, documents, at + 8 * documents).tolist()
        self.keys = [None if null else key for key, null in zip(keys, nulls, strict=True)]
        self.ends = np.frombuffer(data, "<u8", documents, at + 9 * documents).astype(np.int64)
        self.cached: tuple[int, Codes8] | None = None

    def _segment(self, number: int) -> Segment:
        if self.cached is None or self.cached[0] != number:
            self.cached = number, Segment(self.source, int(self.offsets[number]))
        return self.cached[1]

    def range(self, first: int, last: int) -> np.ndarray:
        """The ids at the places from ``first`` to before ``last``."""
        parts = []
        while first < last:
            number = int(np.searchsorted(self.firsts, first, side="right")) - 1
            end = int(self.firsts[number + 1]) if number + 1 < len(self.firsts) else last
            begin = int(self.firsts[number])
            parts.append(self._segment(number).range(first - begin, min(end, last) - begin))
            first = min(end, last)
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at places of the file, in any order."""
        found = [self.range(place, place + 1) for place in np.asarray(places, np.int64).tolist()]
        return np.concatenate(found) if found else np.empty(0, np.uint32)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Key, first place and ids of each document in turn, from ranges of ``READ_IDS`` places or of a longer document."""
        first, held, start = 0, np.empty(0, np.uint32), 0
        total = int(self.ends[-1]) if len(self.ends) else 0
        for key, end in zip(self.keys, self.ends.tolist(), strict=True):
            if end > first + len(held):
                held, first = self.range(start, max(end, min(start + READ_IDS, total))), start
            yield key, start, held[start - first : end - first]
            start = end


class LibraryEncoder:
    """Pieces as packed ids, by the tokenizers library without threads of its own.

    Pieces that are a space and a word are encoded many in one text: the library's pre-tokenizer
    parts them again, and the tokens' lengths tell where.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        special = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()}
        for token, code in self.tokenizer.get_vocab().items():
            # A letter of the vocabulary stands for a byte; special tokens stand for themselves.
            self.sizes[code] = len(utf8(token)) if token in special else len(token)

    def encode(self, pieces: list[str]) -> list[bytes]:
        words, others = [], []
        for piece in pieces:
            (words if piece[:1] == " " and piece.split() == [piece[1:]] else others).append(piece)
        texts = ["".join(words[at : at + JOINED]) for at in range(0, len(words), JOINED)]
        found = self._ids(texts)
        known: dict[str, bytes] = dict(zip(others, map(packed, self._ids(others)), strict=True))
        for number, ids in enumerate(found):
            some = words[number * JOINED : (number + 1) * JOINED]
            ids = np.array(ids, "<u4")
            ends = np.cumsum([len(utf8(word)) for word in some])
            places = 4 * np.concatenate([[0], np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1])
            data = ids.tobytes()
            known.update((word, data[a:b]) for word, a, b in zip(some, places, places[1:], strict=False))
        return [known[piece] for piece in pieces]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@cache
def library_codes(path: str) -> Codes:
    """One for all tasks of a worker, so words are looked up that an earlier task met."""
    return Codes(LibraryEncoder(path).encode, 400_000)


class WordIds:
    """The ids of pieces in one array, and where those of each piece known so far stand in it.

    Two generations are kept, each of ``size`` pieces or eight times as many ids and a batch.
    """

    def __init__(self, library: LibraryEncoder, size: int = 500_000):
        self.library, self.size = library, size
        self._begin()
        self.before = self.index, self.ids, self.ends

    def _begin(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def turn(self) -> None:
        """Forgets the older generation if the newer one is full. Numbers given before hold no more."""
        if len(self.index) > self.size or len(self.ids) > 8 * self.size:
            self.before = self.index, self.ids, self.ends
            self._begin()

    def _add(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.ends) - 1
        self.index.update(zip(pieces, range(first, first + len(pieces)), strict=True))
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some pieces one after another, and how many each has. Pieces that are a space and a word are
        encoded many in one text, which the pre-tokenizer parts again; the tokens' lengths tell where."""
        plain = np.fromiter((piece[:1] == " " and piece.split() == [piece[1:]] for piece in pieces), bool, len(pieces))
        words = [piece for piece, one in zip(pieces, plain.tolist(), strict=True) if one]
        found = self.library._ids(["".join(words[at : at + JOINED]) for at in range(0, len(words), JOINED)])
        ids = np.fromiter(chain.from_iterable(found), np.uint32)
        last = np.cumsum(pc.binary_length(pa.array(words, pa.string())).to_numpy(zero_copy_only=False))
        upto = np.searchsorted(np.cumsum(self.library.sizes[ids]), last) + 1 if words else np.empty(0, np.int64)
        rest = self.library._ids([piece for piece, one in zip(pieces, plain.tolist(), strict=True) if not one])
        counts = np.zeros(len(pieces), np.int64)
        counts[plain] = np.diff(upto, prepend=0)
        counts[~plain] = [len(one) for one in rest]
        out = np.empty(counts.sum(), np.uint32)
        from_words = np.repeat(plain, counts)
        out[from_words] = ids
        out[~from_words] = np.fromiter(chain.from_iterable(rest), np.uint32)
        return out, counts

    def of(self, pieces: list[str]) -> np.ndarray:
        """The numbers of some pieces, all different; those not known yet are encoded in one call."""
        numbers = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            first = len(self.ends) - 1
            new = [pieces[at] for at in missing.tolist()]
            index, ids, ends = self.before
            older = np.fromiter(map(index.get, new, repeat(-1)), np.int64, len(new))
            unknown = older < 0
            some = older[~unknown]
            self._add([new[at] for at in np.flatnonzero(~unknown).tolist()], *gathered(ids, ends, some))
            never = [new[at] for at in np.flatnonzero(unknown).tolist()]
            self._add(never, *self._encoded(never))
            order = np.concatenate([missing[~unknown], missing[unknown]])
            numbers[order] = np.arange(first, first + len(new))
        return numbers


def gathered(ids: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of numbered pieces one after another, and how many each has."""
    begin = ends[numbers]
    counts = ends[numbers + 1] - begin
    upto = np.cumsum(counts)
    places = np.arange(upto[-1] if len(upto) else 0) + np.repeat(begin - (upto - counts), counts)
    return ids[places], counts


@cache
def word_ids(path: str) -> WordIds:
    """One for all tasks of a worker, so words are looked up that an earlier task met."""
    return WordIds(LibraryEncoder(path))


def encoded(texts: list[str], known: WordIds) -> tuple[np.ndarray, list[int]]:
    """The ids of texts one after another, and where those of each text end.

    Arrow parts the texts that :func:`cut` cuts at every space, and its dictionary encoding makes numbers of
    the pieces, so a piece is looked up once for all its places and the ids of all places are gathered at once.
    """
    known.turn()
    plain = np.fromiter((cuts_at_spaces(text) for text in texts), bool, len(texts))
    lists = pc.split_pattern(pa.array([text for text, one in zip(texts, plain.tolist(), strict=True) if one], pa.large_string()), " ")
    offsets = lists.offsets.to_numpy()
    first = np.zeros(len(lists.values), bool)
    first[offsets[:-1]] = True
    rest = lists.values.filter(pa.array(~first)).dictionary_encode()
    words = known.of([" " + word for word in rest.dictionary.to_pylist()])
    others = [cut(text) for text, one in zip(texts, plain.tolist(), strict=True) if not one]
    odd = [*lists.values.filter(pa.array(first)).to_pylist(), *chain.from_iterable(others)]
    distinct = {piece: number for number, piece in enumerate(dict.fromkeys(odd))}
    odd_numbers = known.of(list(distinct))[np.fromiter(map(distinct.__getitem__, odd), np.int64, len(odd))]

    spaced = np.empty(len(first), np.int64)
    spaced[~first] = words[rest.indices.to_numpy()]
    spaced[first], left = odd_numbers[: first.sum()], odd_numbers[first.sum() :]
    pieces = np.empty(len(texts), np.int64)
    pieces[plain], pieces[~plain] = np.diff(offsets), [len(one) for one in others]
    numbers = np.empty(len(spaced) + len(left), np.int64)
    of_plain = np.repeat(plain, pieces)
    numbers[of_plain], numbers[~of_plain] = spaced, left
    ids, counts = gathered(known.ids, known.ends, numbers)
    ends = np.concatenate([[0], np.cumsum(counts)])
    return ids, ends[np.cumsum(pieces)].tolist()


def write_files(
    documents: DataFrame,
    where: str,
    tokenizer_path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
    segment_ids: int = SEGMENT_IDS,
) -> DataFrame:
    """Encodes the texts and writes their ids in ascending ``doc_id`` order; the manifest of the files.

    Rows are dealt by ranges of ``doc_id`` and sorted within them, so files follow one another by
    ``part`` and ``number``. Names are new in every attempt of a task, and only those of the
    successful one are in the manifest. A null text is empty, a null id comes first, rows of one
    id are in the order of a hash of their texts, an empty table writes no file.
    """

    def work(rows):
        files, base = filesystem(where)
        files.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        known = word_ids(tokenizer_path)
        end = np.array([end_id], "<u4")
        writer, number = None, 0

        def batches():
            held, size = [], 0
            for row in rows:
                held.append(row)
                size += len(row[1] or "")
                if size >= BATCH_CHARS:
                    yield held
                    held, size = [], 0
            yield held

        for held in batches():
            every, ends = encoded([body or "" for _, body in held], known)
            start = 0
            for (key, _), stop in zip(held, ends, strict=True):
                ids, start = np.concatenate([every[start:stop], end]), stop
                if writer is None:
                    name = f"{uuid.uuid4().hex}.dac"
                    writer = Writer(files.open_output_stream(f"{base}/{name}"), segment_ids)
                writer.add(key, ids)
                if writer.ids >= file_ids:
                    yield f"{where}/{name}", part, number, writer.close()
                    writer, number = None, number + 1
        if writer is not None:
            yield f"{where}/{name}", part, number, writer.close()

    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
        .withColumn("hash", F.xxhash64("text"))
        .repartitionByRange(parts, "doc_id", "hash")
        .sortWithinPartitions("doc_id", "hash", "text")
        .drop("hash")
    )
    return staged(map_rows(ordered, work, "path string, part int, number int, n_ids bigint"), "dac")


def read_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of a manifest.

    ``start`` counts the ids of all files before, in the order of the manifest, which has one
    row per file; the window over it sees nothing else.
    """
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def work(rows):
        for path, first in rows:
            files, name = filesystem(path)
            with files.open_input_file(name) as source:
                for key, start, ids in Reader(source, source.size()).documents():
                    yield key, first + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    spread = placed.select("path", "before").repartition(max(1, manifest.count()))
    return map_rows(spread, work, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(documents: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Writes the ids of all texts to files in the shared folder and reads them back."""
    where = scratch_path(documents.sparkSession, "dac-files")
    return read_files(write_files(documents, where, tokenizer_path, **options))
