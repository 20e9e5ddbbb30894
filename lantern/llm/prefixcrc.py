"""CRC-32 of every run of words of a text, each from two running checksums of the text (operator 12).

A text is scanned once. Of the checksum after a run and that before it the second is shifted past the run's
bytes, which is a linear map over GF(2), and cancelled; so a run's checksum costs the same at any length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np

# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320

# bytes of a text whose words are held as objects at a time
BLOCK = 1 << 20
WORD_BYTES = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
#: capitals A-Z become small, whatever is in no word becomes a space
NORMAL = bytes(b if b in WORD_BYTES else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def apply(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit words, given as its images of each byte at each place."""
    made = table[0][values & 255]
    for place in (1, 2, 3):
        made ^= table[place][(values >> np.uint32(8 * place)) & 255]
    return made


@cache
def zeros(power: int) -> np.ndarray:
    """The map that carries a checksum past 2**power zero bytes."""
    if power:
        half = zeros(power - 1)
        return np.stack([apply(half, row) for row in half])
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), step >> np.uint32(1))
    byte = np.arange(256, dtype=np.uint32)
    return np.stack([step, byte, byte << np.uint32(8), byte << np.uint32(16)])


def shifted(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums carried past so many bytes each."""
    made = values.copy()
    for power in range(int(lengths.max(initial=0)).bit_length()):
        chosen = np.flatnonzero((lengths >> power) & 1)
        made[chosen] = apply(zeros(power), made[chosen])
    return made


def with_space(values: np.ndarray) -> np.ndarray:
    """Checksums with one space added to what they cover."""
    return ~(zeros(0)[0][(~values ^ np.uint32(32)) & 255] ^ (~values >> np.uint32(8)))


def word_blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of UTF-8 ``data`` in lists of about ``size`` bytes; a longer word is whole."""
    start = 0
    while start < len(data):
        stop = start + size
        if stop < len(data):
            cut = data[stop : stop + size].translate(NORMAL).find(b" ")
            while cut < 0 and stop + size < len(data):
                stop += size
                cut = data[stop : stop + size].translate(NORMAL).find(b" ")
            stop = stop + cut if cut >= 0 else len(data)
        yield data[start:stop].translate(NORMAL).split()
        start = stop


def checksums(data: bytes, width: int, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray]]:
    """For each block of words of the text: their number, and the CRC-32 of every run of 1 to ``width`` words
    (joined by single spaces) that ends in the block, in no particular order."""
    running = 0  # over all words so far, each with a space before it
    at = 0
    before = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    crc32 = zlib.crc32
    for words in word_blocks(data, size):
        if not words:
            continue
        ends = np.empty(len(words) + 1, np.uint32)
        ends[0] = running
        made = []
        for word in words:
            running = crc32(word, crc32(b" ", running))
            made.append(running)
        ends[1:] = made
        stops = at + np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        at = int(stops[-1])
        places = np.concatenate([stops[:1] - len(words[0]), stops[:-1] + 1])
        firsts = np.concatenate([before[0], with_space(ends[:-1])])
        starts = np.concatenate([before[1], places])
        runs = []
        for n in range(1, width + 1):
            # the run of n words that ends with word j of the block starts with word j - n + 1
            skip = max(0, n - 1 - len(before[0]))
            low = len(before[0]) + skip - (n - 1)
            count = len(words) - skip
            if count > 0:
                lengths = stops[skip:] - starts[low : low + count]
                runs.append(ends[1 + skip :] ^ shifted(firsts[low : low + count], lengths))
        yield len(words), np.concatenate(runs)
        keep = max(0, len(firsts) - (width - 1))
        before = firsts[keep:], starts[keep:]
