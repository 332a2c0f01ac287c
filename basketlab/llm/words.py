"""Words of Arrow text columns as numpy arrays, for functions that run inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


def _table(blanks: bytes) -> bytes:
    table = bytearray(range(256))
    for upper, lower in zip(_UPPER, _LOWER):
        table[upper] = lower
    for blank in blanks:
        table[blank] = 32
    return bytes(table)


#: A-Z in lower case, ASCII white space as a blank.
SPACED = _table(b"\t\n\x0b\x0c\r")
#: A-Z in lower case, every other ASCII character that is no digit or letter as a blank.
ALPHANUMERIC = _table(bytes([*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)]))


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function of a task's batches; afterwards Arrow keeps no freed memory, as the worker waits beside the next steps."""

    def run_and_free(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run_and_free


def slices(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text each; one longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield start, stop
        start = stop


def _translated(texts: pa.Array, table: bytes) -> pa.Array:
    """The texts with every byte mapped; null becomes empty."""
    column = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    first, last = (int(ends[0]), int(ends[-1])) if len(ends) else (0, 0)
    content = bytes(data[first:last]).translate(table) if data is not None else b""
    moved = np.ascontiguousarray(ends - first) if len(ends) else np.zeros(1, np.int64)
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(moved), pa.py_buffer(content))


def split_words(texts: pa.Array, table: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, vocabulary): text i has the words ``vocabulary[codes[offsets[i]:offsets[i + 1]]]``."""
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_string())
    lists = pc.ascii_split_whitespace(_translated(texts, table))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values
    filled = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0
    if not filled.all():
        offsets = np.concatenate([[0], np.cumsum(filled)]).astype(np.int64)[offsets]
        values = values.filter(pa.array(filled))
    coded = values.dictionary_encode()
    return offsets, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def word_hashes(vocabulary: pa.Array) -> np.ndarray:
    """One 64-bit hash per word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in vocabulary.to_pylist()), np.uint64, len(vocabulary))


_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64
)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range, one to one."""
    x = values.copy()
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def run_hashes(words: list[np.ndarray]) -> np.ndarray:
    """Hashes of runs of words: row i is the run ``words[0][i], words[1][i], ...``."""
    total = np.full(len(words[0]), np.uint64(len(words)), np.uint64)
    for i, hashes in enumerate(words):
        total = mixed(total + mixed(hashes * _MULTIPLIERS[i % 4] + np.uint64(i)))
    return total


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive word hashes, ``len(hashes) - size + 1`` of them."""
    count = max(0, len(hashes) - size + 1)
    return run_hashes([hashes[i:i + count] for i in range(size)])


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values; six bytes for each step where all steps allow it."""
    steps = np.diff(values, prepend=np.uint64(0))
    if len(steps) and int(steps.max()) >> 48:
        return b"\x01" + values.tobytes()
    low = (steps & np.uint64(0xFFFFFFFF)).astype("<u4")
    return b"\x00" + low.tobytes() + (steps >> np.uint64(32)).astype("<u2").tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if data[:1] == b"\x01":
        return np.frombuffer(data, "<u8", offset=1)
    count = (len(data) - 1) // 6
    low = np.frombuffer(data, "<u4", count=count, offset=1).astype(np.uint64)
    high = np.frombuffer(data, "<u2", count=count, offset=1 + 4 * count).astype(np.uint64)
    return np.cumsum(low + (high << np.uint64(32)), dtype=np.uint64)
