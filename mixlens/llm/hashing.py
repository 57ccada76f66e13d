"""Words and word windows of a batch of texts as 64-bit hashes, by NumPy over the batch's bytes.

Spark sends this module's functions to executors by value, so that they need
NumPy and PyArrow there, but not this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def mixed(x):
    """Spreads each bit of unsigned 64-bit numbers over all others."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(n: int, seed: int):
    """n odd pseudo-random 64-bit numbers; the same prefix for any n."""
    import numpy as np

    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 7919 + 1)
    return mixed(steps) | np.uint64(1)


def text_bytes(column):
    """An Arrow string column's bytes and the offsets of its values; nulls are empty."""
    import numpy as np
    import pyarrow as pa

    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch, column: int, most: int = 1 << 22):
    """A batch in parts of about so many bytes of the given string column; longer texts come alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(size)
    if len(sizes) > begin:
        yield batch.slice(begin)


def word_hashes(data, offsets, seed: int = 0):
    """(hash of each word, offsets of the texts' words, first byte of each word, byte after it).

    Words are parted by ASCII white space and by the ends of texts.
    """
    import numpy as np

    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    length = stop - start
    hashes = np.zeros(len(start), np.uint64)
    letter, position = keys(256, 2 * seed + 1), keys(int(length.max(initial=0)), 2 * seed + 2)
    # So many words at a time that their bytes' products stay small, whatever the texts' lengths.
    for a in range(0, len(start), 1 << 17):
        size = length[a : a + (1 << 17)]
        begin = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(begin, size)
        terms = letter[data[np.repeat(start[a : a + len(size)], size) + place]] * position[place]
        hashes[a : a + len(size)] = mixed(np.add.reduceat(terms, begin) + size.astype(np.uint64))
    return hashes, np.searchsorted(start, offsets), start, stop


def window_hashes(words, bounds, width: int, seed: int = 0):
    """(hash of each window of ``width`` words, offsets of the texts' windows, index of each one's first word)."""
    import numpy as np

    count = np.maximum(np.diff(bounds) - width + 1, 0)
    ends = np.concatenate([[0], np.cumsum(count)])
    n = len(words) - width + 1
    if n <= 0 or not ends[-1]:
        return np.zeros(0, np.uint64), ends, np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i, key in enumerate(keys(width, seed + 101)):
        total += words[i : i + n] * key
    first = np.repeat(bounds[:-1] - ends[:-1], count) + np.arange(ends[-1])
    return mixed(total[first]), ends, first
