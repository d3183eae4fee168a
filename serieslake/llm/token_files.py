"""Token ids as files of independent zstandard frames with a trailing seek table.

A file is a row of zstandard frames holding little-endian unsigned 32-bit ids, then a skippable
frame with the document index (ids and token counts), then a skippable frame with the seek table
of the public seekable format: compressed size, size and the low half of XXH64 for every frame, the
number of frames, a descriptor and a magic number. Any zstandard reader can expand the whole file;
a reader of single documents expands only the frames that hold them and checks their sums.

Documents are dealt to files by ranges of their ids, so files in order hold ascending ids.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.llm.common import column, text_of
from serieslake.session import cut_lineage, scratch_path

FRAME_BYTES = 1 << 20
LARGEST_FRAME = 1 << 28
LEVEL = 3
#: Words a worker process remembers the ids of; the memory is emptied when it is full.
REMEMBERED_WORDS = 900_000
#: Fixed values of the public frame and seek-table formats.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80
_NULL_ID = -(2**63)


class TokenFileWriter:
    def __init__(self, sink):
        self.sink = sink
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.pending, self.held = [], 0
        self.frames, self.ids, self.counts = [], [], []

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        if self.held and self.held + len(tokens) > FRAME_BYTES:
            self._flush()
        for at in range(0, max(len(tokens), 1), LARGEST_FRAME):
            part = tokens[at : at + LARGEST_FRAME]
            self.pending.append(part)
            self.held += len(part)
            if self.held >= LARGEST_FRAME:
                self._flush()
        self.ids.append(_NULL_ID if doc_id is None else doc_id)
        self.counts.append(len(tokens) // 4)

    def _flush(self) -> None:
        body = b"".join(self.pending)
        packed = self.compress(body)
        self.sink.write(packed)
        self.frames.append((len(packed), len(body), xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
        self.pending, self.held = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        index = np.array([self.ids, self.counts], "<i8").tobytes()
        packed = self.compress(index)
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(packed) + 8))
        self.sink.write(struct.pack("<Q", len(packed)) + packed)
        table = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


class TokenFile:
    """Reads documents of one file; expands only the frames it needs."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEK_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        start = size - 9 - 12 * count
        table = np.frombuffer(source.read_at(12 * count, start), "<u4").reshape(-1, 3).astype("i8")
        self.packed, self.sizes, self.sums = table.T if count else np.zeros((3, 0), "i8")
        self.places = np.concatenate([[0], np.cumsum(self.packed)])
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])
        head = int(self.places[-1])
        magic, length = struct.unpack("<II", source.read_at(8, head))
        if magic != SKIPPABLE_INDEX:
            raise ValueError("no document index before the seek table")
        body = source.read_at(length - 8, head + 16)
        index = np.frombuffer(self._expand(body), "<i8").reshape(2, -1)
        self.ids = [None if doc == _NULL_ID else doc for doc in index[0].tolist()]
        self.counts = index[1]
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    @staticmethod
    def _expand(body: bytes) -> bytes:
        return zstandard.ZstdDecompressor().decompress(body)

    def frame(self, number: int) -> bytes:
        body = self._expand(self.source.read_at(int(self.packed[number]), int(self.places[number])))
        if xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != self.sums[number]:
            raise ValueError(f"frame {number} fails its checksum")
        return body

    def document(self, place: int) -> bytes:
        """The ids of the document at a place of the index."""
        return next(self.documents(place, place + 1))

    def documents(self, first: int = 0, last: int | None = None) -> Iterator[bytes]:
        """The ids of documents first to last, each frame expanded once."""
        last = len(self.ids) if last is None else last
        held, body = -1, b""
        for place in range(first, last):
            at, end = int(self.starts[place]) * 4, int(self.starts[place + 1]) * 4
            parts = []
            while at < end:
                number = int(np.searchsorted(self.begins, at, side="right")) - 1
                if number != held:
                    held, body = number, self.frame(number)
                begin = int(self.begins[number])
                parts.append(body[at - begin : end - begin])
                at = begin + len(body)
            yield b"".join(parts)


class WordEncoder:
    """Encodes white-space separated words of a tokenizer that never joins across white space.

    A word is encoded once and remembered. A-Z are lowered first, as the tokenizer does, and marks
    that end a word after a letter are encoded apart, as the tokenizer splits there anyway. Words
    where lowering first would matter stay as they stand: added tokens match the raw text alone,
    and the tokenizer composes a letter with the marks on it before it lowers.
    """

    MARKS = b".,!|*&$%#;:?)"
    LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")
    AS_IT_STANDS = re.compile(rb"<\||[A-Z][\x80-\xff]")
    #: Without one of these, no word of a text matches or needs it: the lead bytes of composing marks.
    SIGNS = (b"<|", b"\xcc", b"\xcd")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.starts, self.sizes = array("I"), array("q"), array("q")

    def _remember(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Words and their ids, one word's after the other."""
        first, ends = len(self.starts), np.cumsum(sizes)
        starts = len(self.flat) + ends - sizes
        self.known.update(zip(words, range(first, first + len(words))))
        self.flat.frombytes(np.ascontiguousarray(ids, np.uint32).tobytes())
        self.starts.frombytes(starts.astype(np.int64).tobytes())
        self.sizes.frombytes(sizes.astype(np.int64).tobytes())

    def _learn(self, words: list[bytes]) -> None:
        """Encodes words in one text and tells them apart by the tokens' offsets."""
        for first in range(0, len(words), 8000):
            part = words[first : first + 8000]
            texts = [word.decode("utf-8", "replace") for word in part]
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            begins = np.cumsum([0] + [len(text) + 1 for text in texts])
            offsets = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
            cuts = np.searchsorted(offsets, begins)
            low, high = int(cuts[0]), int(cuts[-1])
            self._remember(part, np.array(found.ids, np.uint32)[low:high], np.diff(cuts))

    def _join(self, words: list[bytes], cores: list[bytes], tails: list[bytes]) -> None:
        """Remembers words as the ids of their two known parts."""
        halves = [half for pair in zip(cores, tails) for half in pair]
        ids, sizes = self._ids(np.fromiter(map(self.known.__getitem__, halves), np.int64, len(halves)))
        self._remember(words, ids, sizes.reshape(-1, 2).sum(axis=1))

    def _ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places, one after the other, and how many each has."""
        if not len(places):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        starts = np.frombuffer(self.starts, np.int64)[places]
        sizes = np.frombuffer(self.sizes, np.int64)[places]
        ends = np.cumsum(sizes)
        take = np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]))
        flat = np.frombuffer(self.flat, np.uint32) if len(self.flat) else np.zeros(0, np.uint32)
        return flat[take], sizes

    def _split(self, word: bytes) -> tuple[bytes, bytes]:
        core = word.rstrip(self.MARKS)
        if len(core) == len(word) or not core or core[-1] not in self.LETTERS or b"<|" in word:
            return word, b""
        return core, word[len(core) :]

    def _words(self, text: bytes) -> list[bytes]:
        if not any(sign in text for sign in self.SIGNS):
            return text.lower().split()
        return [word if self.AS_IT_STANDS.search(word) else word.lower() for word in text.split()]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        split = [self._words(text) for text in texts]
        words = [word for own in split for word in own]
        places = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            if len(self.known) > REMEMBERED_WORDS:
                self.forget()
                unknown = np.arange(len(words))
            strange = [words[k] for k in unknown.tolist()]
            parted = [(word, *self._split(word)) for word in dict.fromkeys(strange)]
            halves = dict.fromkeys(half for _, core, tail in parted for half in (core, tail) if half)
            self._learn([half for half in halves if half not in self.known])
            joined = [own for own in parted if own[2]]
            if joined:
                self._join(*map(list, zip(*joined)))
            places[unknown] = np.fromiter(map(self.known.__getitem__, strange), np.int64, len(strange))
        ids, sizes = self._ids(places)
        bounds = np.concatenate([[0], np.cumsum([len(own) for own in split])])
        sums = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(sums[bounds])


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """The worker process' encoder for a vocabulary file, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path].encode


def _place(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system, path.rstrip("/")


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encodes every text and writes token files into ``folder`` (a place all executors reach).

    Returns the written files: part, path, documents, tokens. Texts get ``end_id`` at their end; a
    null text is empty. Documents are in ascending order of id, null first, ties by text. A task
    writes under a name of its own attempt and renames at its end, so a repeated task leaves one
    whole file. An empty table writes no file.
    """
    ordered = docs.select(column(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    ordered = ordered.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text")
    )
    tail = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        system, base = _place(folder)
        system.create_dir(base, recursive=True)
        encode, writer, sink = word_encoder(vocabulary), None, None
        temporary, path = f"{base}/_part-{part:06d}-{attempt}", f"{base}/part-{part:06d}.tokens.zst"
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
            first, held = 0, 0
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(ids) + 1])
            for place in range(len(ids)):
                held += sizes[place]
                if held < FRAME_BYTES and place + 1 < len(ids):
                    continue
                tokens, counts = encode(texts.slice(first, place + 1 - first).to_pylist())
                if writer is None:
                    sink = system.open_output_stream(temporary, compression=None)
                    writer = TokenFileWriter(sink)
                body, at = tokens.astype("<u4").tobytes(), 0
                for doc_id, count in zip(ids[first : place + 1], counts.tolist()):
                    writer.add(doc_id, body[at : at + 4 * count] + tail)
                    at += 4 * count
                first, held = place + 1, 0
        if writer is None:
            return
        writer.close()
        sink.close()
        system.move(temporary, path)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([path]),
                pa.array([len(writer.ids)], pa.int64()),
                pa.array([sum(writer.counts)], pa.int64()),
            ],
            ["part", "path", "documents", "tokens"],
        )

    return cut_lineage(
        ordered.mapInArrow(write, "part int, path string, documents long, tokens long"), "files"
    )


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """Every document from its file: doc_id, start, n_tokens, ids_crc32, in as many tasks as files.

    ``start`` counts the ids of all documents before it, those of earlier files first.
    """
    # One row per file.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _place(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(path) as source:
                    file = TokenFile(source)
                    sums = [zlib.crc32(body) for body in file.documents()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.ids, pa.int64()),
                        pa.array(file.starts[:-1] + base, pa.int64()),
                        pa.array(file.counts, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return (
        placed.select("path", "base", "part")
        .repartition(max(files.count(), 1), "part")  # small rows, each of which stands for a file
        .select("path", "base")
        .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "tokens")
