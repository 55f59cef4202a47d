"""Suffix and common-prefix arrays of one shard by induced sorting with a queue in files.

The text's left-most small suffixes (LMS) are sorted first: the substrings between them are named in
order, and the text of names is sorted in turn. All other suffixes are induced from them. A priority
queue whose entries are ordered by first symbol and then by arrival takes a suffix when its
successor is drawn, with the length of what it shares with the entry before it; entries leave in
order. The queue has a run of its own in a file for each first symbol, so its memory
does not grow with the shard. Entries are handled by runs, not one by one. The rest does grow: the
LMS part (codes, names and the levels of their ranks) and the masks of starts are in memory.
"""

import tempfile

import numpy as np

MEMORY = 64 << 20  # bytes of an array beyond which it lies in an unlinked temporary file
RUN = 1 << 18  # entries drawn from the queue at a time


def room(n: int, dtype, memory: int = MEMORY) -> np.ndarray:
    """An array in memory, or in a file of this task that goes with it."""
    if n * np.dtype(dtype).itemsize <= memory:
        return np.empty(n, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype, "w+", shape=(n,))


def _minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low..high] (both included) for each pair, by a table of powers of two."""
    levels, width = [values], 1
    most = int((high - low).max()) + 1 if len(low) else 1
    while width * 2 <= most:
        last = levels[-1]
        levels.append(np.minimum(last[:-width], last[width:]))
        width *= 2
    span = high - low + 1
    level = np.frexp(span)[1] - 1
    out = np.empty(len(low), values.dtype)
    for k in np.unique(level).tolist():
        at = level == k
        row = levels[k]
        out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k) + 1])
    return out


class _Queue:
    """Suffixes by first symbol, and the prefix each shares with the entry drawn before it."""

    def __init__(self, n: int, counts: np.ndarray, limit: int, memory: int):
        self.start = np.concatenate([[0], np.cumsum(counts)])
        self.tail = self.start[:-1].copy()
        self.items, self.common = room(n, np.int64, memory), room(n, np.uint16, memory)
        self.least = np.full(len(counts), 0, np.int64)  # shared by all entries since a bucket's last push
        self.limit = limit

    def push(self, symbols: np.ndarray, suffixes: np.ndarray, common: np.ndarray, taken: np.ndarray) -> None:
        """Take the predecessors of a run of drawn entries.

        ``common`` is what each drawn entry shares with the one drawn before it; ``taken`` says
        which predecessors belong here.
        """
        at = np.flatnonzero(taken)
        order = at[np.argsort(symbols[at], kind="stable")]
        into = symbols[order].astype(np.int64)
        head = np.flatnonzero(np.append(True, into[1:] != into[:-1])) if len(into) else at
        buckets = into[head]
        size = np.diff(np.append(head, len(into)))
        shared = np.empty(len(order), np.int64)
        inner = np.ones(len(order), bool)
        inner[head] = False
        inner = np.flatnonzero(inner)
        shared[inner] = _minima(common, order[inner - 1] + 1, order[inner])
        running = np.minimum.accumulate(common)
        shared[head] = np.minimum(self.least[buckets], running[order[head]])
        rest = np.append(np.minimum.accumulate(common[::-1])[::-1], self.limit)
        self.least = np.minimum(self.least, running[-1])
        self.least[buckets] = rest[order[head + size - 1] + 1]
        place = np.repeat(self.tail[buckets], size) + np.arange(len(order)) - np.repeat(head, size)
        self.items[place] = suffixes[order] - 1
        self.common[place] = np.minimum(shared + 1, self.limit)
        self.tail[buckets] += size


def _kinds(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one, and at the last place."""
    n = len(text)
    rise = np.full(n, -1, np.int8)  # a run at the end shrinks to what is smaller
    rise[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1].astype(np.int32))
    place = np.where(rise != 0, np.arange(n), n)
    out = rise[np.minimum.accumulate(place[::-1])[::-1]] > 0
    out[-1] = True
    return out


def _names(text: np.ndarray, small: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks of the substrings from each LMS place to the next, both included.

    Symbols are compared with their kinds, so no substring is the beginning of another one.
    """
    code = (text.astype(np.uint64) << np.uint64(1) | small.astype(np.uint64)) + np.uint64(1)
    end = np.append(at[1:], at[-1]) + 1
    # A group of equal beginnings has the number of smaller ones as its rank, so splitting a group
    # changes no other. Only groups of several are looked into, and they are read to their end together.
    rank, live, lo = np.zeros(len(at), np.int64), np.arange(len(at)), 0
    while len(live):
        key = np.zeros(len(live), np.uint64)
        for k in range(lo, lo + 6):
            place = at[live] + k
            inside = place < end[live]
            key = key << np.uint64(10) | np.where(inside, code[np.minimum(place, len(text) - 1)], np.uint64(0))
        order = np.lexsort((key, rank[live])) if lo else np.argsort(key, kind="stable")
        live, key, old = live[order], key[order], rank[live[order]]
        group = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        part = np.flatnonzero(np.append(True, (old[1:] != old[:-1]) | (key[1:] != key[:-1])))
        size = np.diff(np.append(part, len(live)))
        before = part - group[np.searchsorted(group, part, side="right") - 1]  # members of the group that come first
        rank[live] = np.repeat(old[part] + before, size)
        lo += 6
        live = live[np.repeat(size > 1, size)]
        live = live[at[live] + lo < end[live]]
    return np.unique(rank, return_inverse=True)[1].astype(np.int32)


def _sorted_names(names: np.ndarray, reach: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the suffixes of a text of names, and their ranks by the first 1, 2, 4, ... names.

    Each level names pairs of the level before, until all differ or ``reach`` names are compared.
    """
    levels, width, rank = [names], 1, names
    n = len(names)
    while width < reach and rank.max() + 1 < n:
        after = np.zeros(n, np.uint64)
        after[: n - width] = rank[width:].astype(np.uint64) + np.uint64(1)
        rank = np.unique(rank.astype(np.uint64) << np.uint64(32) | after, return_inverse=True)[1].astype(np.int32)
        levels.append(rank)
        width *= 2
    return np.argsort(rank, kind="stable"), levels


def _shared_text(text: np.ndarray, a: np.ndarray, b: np.ndarray, done: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix length of suffix pairs that share ``done`` symbols already."""
    out = np.minimum(done, limit).astype(np.int64)
    live = np.flatnonzero(out < limit)
    n = len(text)
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = (x < n) & (y < n)
        same = inside.copy()
        same[inside] = text[x[inside]] == text[y[inside]]
        live = live[same]
        out[live] += 1
        live = live[out[live] < limit]
    return out


def _lms_common(text, at, order, levels, limit) -> np.ndarray:
    """What each LMS suffix in order shares with the one before: whole names first, then symbols."""
    a, b = order[:-1].copy(), order[1:].copy()
    m = len(at)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < m) & (b < m)
        same = inside.copy()
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = 1 << k
        a, b = np.where(same, np.minimum(a + step, m), a), np.where(same, np.minimum(b + step, m), b)
    # The last place stands for what comes after the last name.
    ends = np.append(at, len(text) - 1)
    done = np.minimum(ends[a] - at[order[:-1]], ends[b] - at[order[1:]])
    return np.concatenate([[0], _shared_text(text, at[order[:-1]], at[order[1:]], done, limit)])


def suffix_array(text: np.ndarray, limit: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and what each shares with the one before (counted up to ``limit``).

    ``text`` holds symbols below 500 and ends with its only 0. Suffixes that share ``limit`` symbols stand
    together; their order among themselves is not told.
    """
    n = len(text)
    small = _kinds(text)
    lms = small.copy()
    lms[0] = False
    lms[1:] &= ~small[:-1]
    at = np.flatnonzero(lms)
    symbols = int(text.max()) + 1
    size = np.bincount(text, minlength=symbols)
    large_size = np.bincount(text[~small], minlength=symbols)
    if len(at):
        order, levels = _sorted_names(_names(text, small, at), limit // 2 + 1)
        stars, star_common = at[order], _lms_common(text, at, order, levels, limit)
        del levels
    else:
        stars, star_common = np.array([n - 1]), np.array([0])
    star_first = np.searchsorted(text[stars], np.arange(symbols + 1))

    large = _Queue(n - int(small.sum()), large_size, limit, memory)
    for c in range(symbols):
        at_run, last = int(large.start[c]), -1
        while at_run < large.tail[c]:
            stop = min(int(large.tail[c]), at_run + RUN)
            drawn = np.array(large.items[at_run:stop])
            common = np.array(large.common[at_run:stop]).astype(np.int64)
            if at_run == large.start[c]:
                common[0] = 0
            _draw(large, text, small, drawn, common, up=True)
            last, at_run = int(drawn[-1]), stop
        for lo in range(int(star_first[c]), int(star_first[c + 1]), RUN):
            hi = min(int(star_first[c + 1]), lo + RUN)
            common = star_common[lo:hi].copy()
            if lo == star_first[c]:
                common[0] = _seam(text, last, int(stars[lo]), limit) if last >= 0 else 0
            _draw(large, text, small, stars[lo:hi], common, up=True)

    little = _Queue(int(small.sum()), size - large_size, limit, memory)
    for c in range(symbols - 1, -1, -1):
        at_run, last = int(little.start[c]), -1
        while at_run < little.tail[c]:
            stop = min(int(little.tail[c]), at_run + RUN)
            drawn = np.array(little.items[at_run:stop])
            common = np.array(little.common[at_run:stop]).astype(np.int64)
            if at_run == little.start[c]:
                common[0] = 0
            _draw(little, text, small, drawn, common, up=False)
            last, at_run = int(drawn[-1]), stop
        if c == 0:  # the last suffix has no successor to induce it
            little.items[0], little.common[0], little.tail[0] = n - 1, 0, 1
        stop = int(large.tail[c])
        while stop > large.start[c]:
            lo = max(int(large.start[c]), stop - RUN)
            drawn = np.array(large.items[lo:stop])[::-1]
            # Going down, an entry shares with the one drawn before what that one shares going up.
            after = int(large.common[stop]) if stop < large.tail[c] else (
                _seam(text, int(drawn[0]), last, limit) if last >= 0 else 0
            )
            common = np.concatenate([[after], np.array(large.common[lo + 1 : stop])[::-1].astype(np.int64)])
            _draw(little, text, small, drawn, common, up=False)
            stop = lo

    suffixes, common = room(n, np.int64, memory), room(n, np.uint16, memory)
    out = 0
    for c in range(symbols):
        a, b = int(large.start[c]), int(large.start[c + 1])
        suffixes[out : out + b - a], common[out : out + b - a] = large.items[a:b], large.common[a:b]
        if b > a:
            common[out] = 0
        last = int(large.items[b - 1]) if b > a else -1
        out += b - a
        a, b = int(little.start[c]), int(little.start[c + 1])
        if b > a:
            suffixes[out : out + b - a] = little.items[a:b][::-1]
            common[out + 1 : out + b - a] = little.common[a + 1 : b][::-1]
            common[out] = _seam(text, last, int(suffixes[out]), limit) if last >= 0 else 0
        out += b - a
    return suffixes, common


def _seam(text: np.ndarray, a: int, b: int, limit: int) -> int:
    n = min(limit, len(text) - max(a, b))
    off = np.flatnonzero(text[a : a + n] != text[b : b + n])
    return int(off[0]) if len(off) else n


def _draw(queue: _Queue, text, small, drawn, common, up: bool) -> None:
    """Hand the predecessors of drawn suffixes to the queue: large ones going up, small ones down."""
    before = np.maximum(drawn - 1, 0)
    symbols = text[before]
    kind = small[before] != up
    queue.push(symbols, drawn, common, kind & (drawn > 0))


def repeated_starts(text: np.ndarray, wanted: np.ndarray, length: int, memory: int = MEMORY) -> np.ndarray:
    """Whether each place marked in ``wanted`` starts a string of ``length`` that another marked place starts.

    ``text`` has symbols from 2 on, a 1 after each piece and a 0 at the end; strings do not run over a 1.
    """
    suffixes, common = suffix_array(text, length, memory)
    marked = np.flatnonzero(wanted[suffixes])
    out = np.zeros(len(text), bool)
    if len(marked) < 2:
        return out
    upto = np.append(0, marked[:-1] + 1)
    least = np.minimum.reduceat(common[: marked[-1] + 1], upto)  # over all entries since the last marked one
    same = least[1:] >= length
    places = suffixes[marked]
    out[places[1:][same]] = True
    out[places[:-1][same]] = True
    breaks = np.flatnonzero(text < 2)
    starts = np.flatnonzero(out)
    out[starts[breaks[np.searchsorted(breaks, starts)] - starts < length]] = False
    return out
