"""Hierarchical multi-length packing of token sequences.

Documents are tokenized and routed to tiers of context sizes (`TIERS`): what is longer than the long window is cut into
full windows, and a document, or its rest, waits in the tier of the smallest context that holds it whole. Tiers are
packed from the longest to the shortest: the longest piece of a tier opens a window of the tier's size, and the window's
gap is filled from shorter tiers and its own, the longest piece that fits first; only when none fits, one piece is cut to
close the gap. What long windows leave over is packed in windows of its own size, so short documents lie whole in short
contexts. A tier waits while all that could fill its window is less than the window. Every sequence is thus as long as a
tier; what is left at the end of a partition goes to powers of two below, the last few tokens to tiny ones: no padding.

Sequences of one tier are dealt in serpentine order of attention cost into step groups of equal tokens (`STEP` long
windows, or as many more of a shorter tier), `GROUPS` groups at a time.

A partition packs its own documents in one pass with a bounded buffer: no shuffle, and a lost task is simply repeated,
as the same file range yields the same sequences.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import arrow_blobs, to_batch, worker_cache

WINDOW = 1024
TIERS = (128, 256, 512, 1024)  # context sizes; the last one is the long window
BUFFER = 4096  # pieces that wait in a partition before tiers are packed
STEP = 8  # long windows in a step group
GROUPS = 16  # step groups that are balanced at a time
SPECIAL = "<|endoftext|>"

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_tokens", pa.int64()), ("padded_to", pa.int64()), ("step_group", pa.int64())])
PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, padded_to long, step_group long"


def tokenizer_paths(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """The vocabulary as a tokenizers file and as ranks; both are looked up where the job runs."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


class Encoder:
    """The ids that the tokenizers file gives, by way of the rank file of the same vocabulary where that is the same.

    The rank encoder is several times faster; texts that hold the special token's string go to the tokenizers library,
    which alone knows it, and so do texts with so long a run of white space that the rank encoder's pattern gives up.
    Tests compare both.
    """

    def __init__(self, json_path: str, rank_path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        self.json_path, self.whole = json_path, None
        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def exact(self, text: str) -> np.ndarray:
        from tokenizers import Tokenizer

        if self.whole is None:
            self.whole = Tokenizer.from_file(self.json_path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")

    def ids(self, text: str) -> np.ndarray:
        if SPECIAL in text:
            return self.exact(text)
        try:
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")
        except ValueError:
            return self.exact(text)


def encoder(paths: tuple[str, str]) -> Encoder:
    cache = worker_cache()
    if paths not in cache.setdefault("encoders", {}):
        cache["encoders"][paths] = Encoder(*paths)
    return cache["encoders"][paths]


class Packer:
    """Packs pieces (document row, start, ids) tier by tier; `done` holds finished sequences until they are taken."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, buffer: int = BUFFER):
        self.tiers, self.buffer, self.window = tiers, buffer, tiers[-1]
        self.pieces: dict[int, list] = {}  # length -> pieces that wait
        self.lengths: list[int] = []  # sorted lengths that occur
        self.waiting = 0
        self.done: list[list] = []

    def put(self, piece: tuple) -> None:
        length = len(piece[2])
        if length not in self.pieces:
            self.pieces[length] = []
            bisect.insort(self.lengths, length)
        self.pieces[length].append(piece)
        self.waiting += 1

    def take(self, most: int, above: int = 0):
        """The longest piece of more than `above` and at most `most` tokens."""
        at = bisect.bisect_right(self.lengths, most) - 1
        if at < 0 or self.lengths[at] <= above:
            return None
        length = self.lengths[at]
        piece = self.pieces[length].pop()
        if not self.pieces[length]:
            del self.pieces[length]
            self.lengths.pop(at)
        self.waiting -= 1
        return piece

    def fill(self, size: int, first: tuple | None = None) -> None:
        """One full sequence of `size` tokens, opened by `first` if given; enough tokens must wait."""
        sequence = [first] if first else []
        room = size - sum(len(piece[2]) for piece in sequence)
        while room:
            piece = self.take(room)
            if piece is None:  # all are longer: cut the shortest context that can close the gap
                length = self.lengths[bisect.bisect_right(self.lengths, room)]
                doc, start, ids = self.take(length)
                piece = (doc, start, ids[:room])
                self.put((doc, start + room, ids[room:]))
            sequence.append(piece)
            room -= len(piece[2])
        self.done.append(sequence)

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        full = len(ids) // self.window * self.window
        for at in range(0, full, self.window):
            self.done.append([(doc, at, ids[at : at + self.window])])
        if len(ids) > full:
            self.put((doc, full, ids[full:]))
        if self.waiting > self.buffer:
            self.pack()

    def pack(self) -> None:
        """All windows that the waiting pieces can fill, the longest tier first."""
        below = (0, *self.tiers)  # a longer tier that could not fill its window waits on
        for n in range(len(self.tiers) - 1, -1, -1):
            held = sum(length * len(pieces) for length, pieces in self.pieces.items() if length <= self.tiers[n])
            while held >= self.tiers[n] and (first := self.take(self.tiers[n], below[n])) is not None:
                self.fill(self.tiers[n], first)
                held -= self.tiers[n]

    def finish(self) -> None:
        """What waits goes to the tiers as long as it fills them, then to powers of two below the sum that is left."""
        self.pack()
        left = sum(length * len(pieces) for length, pieces in self.pieces.items())
        size = self.window
        while left:
            while size > left:
                size //= 2
            self.fill(size)
            left -= size


def cost(sequence: list) -> int:
    return sum(len(piece[2]) ** 2 for piece in sequence)


def pack(docs: DataFrame, paths: tuple[str, str] | None = None, tiers: tuple[int, ...] = TIERS, end_id: int = 0, buffer: int = BUFFER) -> DataFrame:
    """Pieces of all documents, packed; a row per piece with its place in its document and in its sequence.

    tiers: context sizes, powers of two, ascending. Null text counts as empty: its document is the end id alone. Each row
    of docs is a document of its own, also where doc_id repeats or is null. Columns other than doc_id and text are left
    aside. Documents of any length and kind of text are encoded whole; a task holds one of them at a time, beside
    `buffer` pieces. Sequences are as long as a tier or a smaller power of two, so that none is padded; ties go to the
    piece that came last. An empty table gives an empty result. Equal input partitions give equal results.
    """
    paths = paths or tokenizer_paths()
    window = tiers[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(paths).ids, Packer(tiers, buffer)
        part = TaskContext.get().partitionId() << 40
        count = groups = 0
        ready: dict[int, list[list]] = {}  # finished sequences by size

        def emit(size: int) -> pa.RecordBatch:
            nonlocal count, groups
            sequences = sorted(ready.pop(size), key=cost, reverse=True)
            steps = -(-len(sequences) * size // (STEP * window))
            rows = []
            for n, sequence in enumerate(sequences):
                lap, at = divmod(n, steps)
                group = groups + (at if lap % 2 == 0 else steps - 1 - at)
                offset = 0
                for (doc_id, doc_tokens), start, ids in sequence:
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), doc_tokens, part + count, offset, size, size, part + group))
                    offset += len(ids)
                count += 1
            groups += steps
            return to_batch(rows, PIECES)

        def gather() -> None:
            for sequence in packer.done:
                ready.setdefault(sum(len(piece[2]) for piece in sequence), []).append(sequence)
            packer.done = []

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), arrow_blobs(batch.column(1)), strict=True):
                ids = np.append(encode(raw.decode("utf-8", "replace")), np.uint32(end_id)).astype("<u4")
                packer.add((doc_id, len(ids)), ids)
                gather()
                for size in [k for k, v in ready.items() if len(v) * k >= STEP * GROUPS * window]:
                    yield emit(size)
        packer.finish()
        gather()
        for size in sorted(ready, reverse=True):
            yield emit(size)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES_DDL)
