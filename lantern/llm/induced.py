"""External induced sorting of suffixes with common-prefix values (used by operator 8).

The suffixes at local minima (those of type S after one of type L) are named by the substring up to the
next such place and sorted as a shorter string, recursively. From their order all others are induced:
going through the sorted suffixes, each one puts the suffix that begins one place earlier into the queue
of its first character, first left to right for type L, then right to left for type S. The queues hold
tuples (position, common prefix with the tuple before) and go to disk beyond a memory budget; a new
tuple's common prefix is one more than the least value passed since the queue's last tuple.
"""

from __future__ import annotations

import tempfile

import numpy as np

# bytes that the queues of one sorter hold in memory
QUEUE_BYTES = 64 << 20
# tuples that are taken from a queue at a time
BATCH = 1 << 18
SYMBOLS = 256


class Queues:
    """First-in first-out queues of (position, common prefix) runs, one per character. As characters are
    taken in order and a queue's runs are sorted as they come, together they are a priority queue."""

    def __init__(self, limit: int = QUEUE_BYTES):
        self.runs: list[list] = [[] for _ in range(SYMBOLS)]
        self.limit, self.held, self.file = limit, 0, None

    def put(self, symbol: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        size = positions.nbytes + prefixes.nbytes
        if self.held + size <= self.limit:
            self.held += size
            self.runs[symbol].append((positions, prefixes))
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        start = self.file.seek(0, 2)
        self.file.write(positions.tobytes() + prefixes.tobytes())
        self.runs[symbol].append((start, len(positions)))

    def load(self, run: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(run[0], np.ndarray):
            return run
        self.file.seek(run[0])
        positions = np.frombuffer(self.file.read(8 * run[1]), np.int64)
        return positions, np.frombuffer(self.file.read(run[1]), np.uint8)

    def pending(self, symbol: int, at: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The queue's runs from number ``at`` on, as one run of about ``BATCH`` tuples, and where it ends."""
        runs, size, end = [], 0, at
        while end < len(self.runs[symbol]) and size < BATCH:
            runs.append(self.load(self.runs[symbol][end]))
            size += len(runs[-1][0])
            end += 1
        if len(runs) == 1:
            return *runs[0], end
        return np.concatenate([p for p, _ in runs]), np.concatenate([s for _, s in runs]), end

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Passed:
    """The least common prefix passed since each character's last tuple, over one scan."""

    def __init__(self, cap: int):
        self.cap = cap
        self.least = np.full(SYMBOLS, cap, np.uint8)

    def induced(self, symbols: np.ndarray, chosen: np.ndarray, prefixes: np.ndarray):
        """Per character of the chosen entries of a run: (character, indices into the run, prefixes)."""
        if not len(chosen):
            self.least = np.minimum(self.least, prefixes.min() if len(prefixes) else self.cap)
            return
        levels = [prefixes]
        while 2 << (len(levels) - 1) <= len(prefixes):
            half, last = 1 << (len(levels) - 1), levels[-1]
            levels.append(np.minimum(last[:-half], last[half:]))
        order = np.argsort(symbols, kind="stable")
        sorted_symbols, index = symbols[order], chosen[order]
        before = np.empty(len(index), np.int64)
        before[1:] = index[:-1]
        first = np.ones(len(index), bool)
        first[1:] = sorted_symbols[1:] != sorted_symbols[:-1]
        before[first] = -1
        length = index - before
        level = np.frexp(length.astype(np.float64))[1] - 1
        least = np.empty(len(index), np.uint8)
        for k, table in enumerate(levels):
            at = np.flatnonzero(level == k)
            if len(at):
                least[at] = np.minimum(table[before[at] + 1], table[index[at] + 1 - (1 << k)])
        heads = np.flatnonzero(first)
        least[heads] = np.minimum(least[heads], self.least[sorted_symbols[heads]])
        self.least = np.minimum(self.least, prefixes.min())
        ends = np.append(heads[1:], len(index)) - 1
        tail = np.minimum.accumulate(prefixes[::-1])[::-1]
        last_index = index[ends]
        self.least[sorted_symbols[ends]] = np.where(last_index + 1 < len(prefixes), tail[np.minimum(last_index + 1, len(prefixes) - 1)], self.cap)
        made = np.minimum(least.astype(np.int64) + 1, self.cap).astype(np.uint8)
        for start, end in zip(heads, ends + 1):
            yield int(sorted_symbols[start]), index[start:end], made[start:end]


def words_at(text: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Eight symbols from each position on, as one little-endian number; ``text`` has eight spare ones."""
    return np.lib.stride_tricks.as_strided(text, (len(text) - 7, 8), (1, 1))[positions].copy().view("<u8").ravel()


def common_prefixes(text: np.ndarray, ends: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """For each suffix but the first the symbols it has in common with the one before, up to ``cap``."""
    found = np.zeros(len(order), np.uint8)
    if len(order) < 2:
        return found
    limit = np.minimum(np.minimum(ends[order[:-1]] - order[:-1], ends[order[1:]] - order[1:]), cap)
    same, active, at = np.zeros(len(order) - 1, np.int64), np.arange(len(order) - 1), 0
    while len(active) and at < cap:
        differ = words_at(text, np.minimum(order[:-1][active] + at, len(text) - 8)) ^ words_at(text, np.minimum(order[1:][active] + at, len(text) - 8))
        lowest = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, (np.frexp(lowest.astype(np.float64))[1] - 1) // 8)
        same[active] += equal
        active = active[(equal == 8) & (same[active] < limit[active])]
        at += 8
    found[1:] = np.minimum(same, limit)
    return found


def ranks_of(names: np.ndarray) -> np.ndarray:
    """The rank of each suffix of a string of names that fits memory, by doubling; names may repeat, the
    last one does not."""
    ranks, step, n = names, 1, len(names)
    while n and int(ranks.max()) + 1 < n and step < n:
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = ranks[step:] + 1
        ranks = np.unique(ranks * np.int64(n + 1) + ahead, return_inverse=True)[1]
        step *= 2
    return ranks


def minima_names(text: np.ndarray, small: np.ndarray, minima: np.ndarray) -> np.ndarray:
    """Names in order of the substrings from each local minimum through the next one.

    A symbol is compared with its type, L before S. Separators are unique: they are named by position.
    """
    coded = text.astype(np.int64) * 2 + small
    after = np.append(minima[1:], minima[-1:])
    names, active, at = np.zeros(len(minima), np.int64), np.arange(len(minima)), 0
    separators = text[minima] == 0
    while len(active):
        key = np.zeros(len(active), np.int64)
        for k in range(at, at + 6):
            place = minima[active] + k
            key = key * 1024 + np.where(place <= after[active], coded[np.minimum(place, len(coded) - 1)] + 1, 0)
        # a name is the first place of its group among all: groups keep their order when they are split
        key = np.unique(key, return_inverse=True)[1]
        if at:
            kinds, place = np.unique(names[active] * np.int64(len(key) + 1) + key, return_inverse=True)
            kinds = kinds // (len(key) + 1)
        else:
            kinds, place = np.zeros(int(key.max()) + 1, np.int64), key
        start = np.searchsorted(kinds, kinds)
        sizes = np.bincount(place, minlength=len(kinds))
        offset = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        names[active] = names[active] + (offset - offset[start])[place]
        at += 6
        active = active[(minima[active] + at <= after[active]) & (sizes[place] > 1)]
    names[separators] = np.arange(separators.sum())
    names[~separators] += separators.sum()
    return np.unique(names, return_inverse=True)[1]


def sort_suffixes(text: np.ndarray, cap: int, limit: int = QUEUE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all suffixes of ``text`` in order, and each one's common prefix with the one before.

    ``text``: symbols 1 to 255 in pieces that each end with a 0; a suffix ends with its piece. Suffixes
    that are equal up to there are in the order of their pieces. Prefixes count up to ``cap``.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    wide = np.concatenate([text, np.zeros(8, np.uint8)])
    # type S: smaller than the next suffix; a run of one symbol has the type of its end
    step = np.sign(np.diff(text.astype(np.int16)))
    change = np.where(step != 0, np.arange(n - 1), n)
    change = np.append(change, n - 1) if n else change
    upcoming = np.minimum.accumulate(change[::-1])[::-1]
    small = np.zeros(n, bool)
    inside = upcoming < n - 1
    small[inside] = step[upcoming[inside]] > 0
    small[text == 0] = True
    run_end = np.minimum(upcoming, n - 1)
    separators = np.flatnonzero(text == 0)
    ends = separators[np.searchsorted(separators, np.arange(n))]
    lowest = small.copy()
    lowest[1:] &= ~small[:-1]
    lowest[0] = False
    lowest[separators] = True
    minima = np.flatnonzero(lowest)
    ranks = ranks_of(minima_names(text, small, minima))
    starts = minima[np.argsort(ranks)]
    prefixes = common_prefixes(wide, ends, starts, cap)
    bounds = np.searchsorted(text[starts], np.arange(SYMBOLS + 1))

    def crossing(p: int, q: int) -> int:
        """Common prefix of a suffix of type L and one of type S that begin alike: the shorter run."""
        return min(run_end[p] - p + 1, run_end[q] - q + 1, cap)

    large, tiny = Queues(limit), Queues(limit)
    done: list[list] = [[] for _ in range(SYMBOLS)]

    def scan(passed: Passed, queue: Queues, positions: np.ndarray, shared: np.ndarray, of_small: bool) -> None:
        previous = positions - 1
        chosen = np.flatnonzero((previous >= 0) & (text[previous] != 0) & (small[previous] == of_small))
        for symbol, index, made in passed.induced(text[previous[chosen]], chosen, shared):
            queue.put(symbol, positions[index] - 1, made)

    passed, last = Passed(cap), None
    for symbol in range(SYMBOLS):
        at, last = 0, None
        while at < len(large.runs[symbol]):
            positions, shared, at = large.pending(symbol, at)
            if last is None:
                shared = np.concatenate([[0], shared[1:]]).astype(np.uint8)
            last = int(positions[-1])
            scan(passed, large, positions, shared, False)
        own = slice(bounds[symbol], bounds[symbol + 1])
        if own.start < own.stop:
            shared = prefixes[own].copy()
            shared[0] = crossing(last, int(starts[own.start])) if last is not None and symbol else 0
            scan(passed, large, starts[own], shared, False)
    passed = Passed(cap)
    for symbol in range(SYMBOLS - 1, 0, -1):
        at, last, falling = 0, None, []
        while at < len(tiny.runs[symbol]):
            positions, shared, at = tiny.pending(symbol, at)
            if last is None:
                shared = np.concatenate([[0], shared[1:]]).astype(np.uint8)
            last = int(positions[-1])
            falling.append((positions, shared))
            scan(passed, tiny, positions, shared, True)
        rising = [large.load(run) for run in large.runs[symbol]]
        if rising:
            positions = np.concatenate([p for p, _ in rising])
            shared = np.concatenate([s for _, s in rising])
            shared[0] = 0
            back = np.concatenate([[crossing(int(positions[-1]), last) if last is not None else 0], shared[:0:-1]]).astype(np.uint8)
            scan(passed, tiny, positions[::-1], back, True)
            done[symbol].append((positions, shared))
        if falling:
            positions = np.concatenate([p for p, _ in falling])[::-1]
            shared = np.concatenate([s for _, s in falling])
            shared = np.concatenate([[crossing(int(done[symbol][-1][0][-1]), int(positions[0])) if rising else 0], shared[:0:-1]]).astype(np.uint8)
            done[symbol].append((positions, shared))
    large.close()
    tiny.close()
    whole = [(separators, np.zeros(len(separators), np.uint8)), *(part for parts in done for part in parts)]
    return np.concatenate([p for p, _ in whole]), np.concatenate([s for _, s in whole])
