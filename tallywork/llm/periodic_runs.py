"""Runs of whole texts: stretches of words that repeat with a period, as far as they go.

Under an order of the words or under the opposite one, the longest Lyndon word at some place of a
run is as long as the run's period. So the runs are found from two Lyndon arrays. The first phase of
Baier's suffix sorter yields each of them directly: suffixes start in groups by their first word;
groups are taken from the highest one down, and each member hands the group's context on to the
suffix before it that lies in a lower group. When a group's turn comes its context is the longest
Lyndon word at each member. A Lyndon word at a place is one period of a candidate; how far the
period holds to both sides comes from longest common extensions, looked up in tables of equal blocks
of 1, 2, 4, ... words.

A run of at least 24 words and three periods holds its words equal to those one period on for 16 places
or more, so it lies where windows of 16 words occur twice. The arrays are built for these
stretches only; no run is lost, and a text without such windows is done.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallywork.llm.texts import arrow_rows

SHORTEST = 24  # words
PERIODS = 3
_SEED = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Run:
    start: int
    length: int
    period: int


def lyndon_array(words: list[int], kinds: int) -> list[int]:
    """Length of the longest Lyndon word at each place, for words numbered from 0 below ``kinds``.

    A word of the text is a letter here; a proper prefix is smaller than the whole.
    """
    n = len(words)
    members: list[list[int]] = [[] for _ in range(kinds)]
    for place, word in enumerate(words):
        members[word].append(place)
    context = [1] * kinds
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))
    group = list(words)
    open_ = -2  # the place's group has not been taken yet
    lower = [open_] * n  # the last place before in a lower group
    found = [0] * n
    now = kinds - 1
    while now >= 0:
        length = context[now]
        handed: dict[int, int] = {}
        for place in members[now]:
            if group[place] != now:
                continue
            found[place] = length
            before = place - 1
            while before >= 0:
                further = lower[before]
                if further == open_:
                    break
                before = further
            lower[place] = before
            if before >= 0:
                handed[before] = handed.get(before, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for place, times in handed.items():
            moves.setdefault((times, group[place]), []).append(place)
        for times, old in sorted(moves, reverse=True):  # right above the old group, fewer times below
            new, moved = len(members), moves[times, old]
            members.append(moved)
            context.append(context[old] + times * length)
            after = above[old]
            above.append(after)
            below.append(old)
            above[old] = below[after] = new
            for place in moved:
                group[place] = new
        now = below[now]
    return found


class Extensions:
    """Longest common extensions of pairs of places, exact, for many pairs at once."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        names = [words.astype(np.int64)]
        size = 1
        while 2 * size <= self.n:
            last = names[-1]
            pairs = last[:-size] * (int(last.max()) + 1) + last[size:]
            _, named = np.unique(pairs, return_inverse=True)
            names.append(named)
            size *= 2
            if int(named.max()) + 1 == len(named):
                break  # longer blocks are all different
        self.names = [block.astype(np.int32) for block in names]

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b on are equal."""
        total = np.zeros(len(a), dtype=np.int64)
        for level in reversed(range(len(self.names))):
            names, size = self.names[level], 1 << level
            while True:
                x, y = a + total, b + total
                inside = np.flatnonzero(np.maximum(x, y) + size <= self.n)
                equal = inside[names[x[inside]] == names[y[inside]]]
                total[equal] += size
                if level < len(self.names) - 1 or not len(equal):
                    break
        return total

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b are equal."""
        total = np.zeros(len(a), dtype=np.int64)
        for level in reversed(range(len(self.names))):
            names, size = self.names[level], 1 << level
            while True:
                x, y = a - total - size, b - total - size
                inside = np.flatnonzero(np.minimum(x, y) >= 0)
                equal = inside[names[x[inside]] == names[y[inside]]]
                total[equal] += size
                if level < len(self.names) - 1 or not len(equal):
                    break
        return total


def _runs_of_stretch(words: np.ndarray, shortest: int, periods: int) -> np.ndarray:
    """(start, length, period) of the runs of some words, in rows by start and period."""
    _, ids = np.unique(words, return_inverse=True)
    kinds, n = int(ids.max()) + 1, len(ids)
    extensions = Extensions(ids)
    found = []
    for order in (ids, kinds - 1 - ids):
        period = np.array(lyndon_array(order.tolist(), kinds))
        place = np.flatnonzero((np.arange(n) + period < n) & (periods * period <= n))
        period = period[place]
        left = extensions.left(place, place + period)
        right = extensions.right(place, place + period)
        length = left + period + right
        long = length >= np.maximum(shortest, periods * period)
        found.append(np.stack([place - left, length, period], axis=1)[long])
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _stretches(ids: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Where windows of some words occur twice or more; windows of equal hash count as equal."""
    n = len(ids) - window + 1
    if n < 2:
        return []
    hashes = (ids.astype(np.uint64) + np.uint64(1)) * _SEED
    hashes ^= hashes >> np.uint64(29)
    size, factor = 1, np.uint64(0xD6E8FEB86659FD93)
    while size < window:  # from blocks of some words to blocks of more, the last ones overlap
        step = min(size, window - size)
        hashes = (hashes[:-step] * factor) ^ (hashes[step:] * _SEED)
        hashes ^= hashes >> np.uint64(31)
        size += step
    order = np.argsort(hashes, kind="stable")
    in_order = hashes[order]
    same = in_order[1:] == in_order[:-1]
    if not same.any():
        return []
    often = np.zeros(n, dtype=bool)
    often[order[1:][same]] = often[order[:-1][same]] = True
    starts = np.flatnonzero(often)
    breaks = np.flatnonzero(np.diff(starts) > window)
    firsts, lasts = starts[np.r_[0, breaks + 1]], starts[np.r_[breaks, len(starts) - 1]]
    return [(int(a), int(b) + window) for a, b in zip(firsts, lasts, strict=True)]


def find_runs(words: list, shortest: int = SHORTEST, periods: int = PERIODS) -> list[Run]:
    """The runs of at least ``shortest`` words and ``periods`` periods, by start and period.

    A run is a stretch with a smallest period that no neighbouring word extends with that period.
    """
    if periods < 2:
        raise ValueError("a run has at least two periods")
    if len(words) < max(shortest, periods):
        return []
    numbers: dict = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words])
    # a run of length n and period q has n - q equal pairs: shortest - q at least and (periods - 1) * q
    window = max(1, min(max(shortest - q, (periods - 1) * q) for q in range(1, shortest + 2)))
    found = []
    for start, end in _stretches(ids, window):
        rows = _runs_of_stretch(ids[start:end], shortest, periods)
        found += [Run(start + s, length, q) for s, length, q in rows.tolist()]
    return found


def collapse(words: list, runs: list[Run]) -> list:
    """The words without those that lie in a run after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for run in runs:
        change[run.start + run.period] += 1
        change[run.start + run.length] -= 1
    kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
    return [words[i] for i in kept.tolist()]


_ADDED = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_STRUCT = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


def detect_runs(
    df: DataFrame,
    *,
    keep: list[str],
    text: str = "text",
    shortest: int = SHORTEST,
    periods: int = PERIODS,
) -> DataFrame:
    """Columns ``keep``, ``n_words``, ``runs`` by start and period, and ``collapsed``.

    Words are stretches without ASCII white space, numbered from 0; ``collapsed`` holds those
    outside of repeats, joined by one space: a run keeps its first period, unless another run drops
    it. A NULL, empty or blank text has no words, no runs and an empty ``collapsed``. One row per
    row of ``df``, repeated rows included, in one pass without a shuffle; an empty table gives an
    empty result. Other columns are not read; ``keep`` must not hold the name of an added column. A
    text is worked on in one task.
    """
    clashing = {"n_words", "runs", "collapsed"} & set(keep)
    if clashing:
        raise ValueError(f"keep holds names of added columns: {sorted(clashing)}")

    def make(texts: list[bytes]) -> list[pa.Array]:
        sizes, found, collapsed = [], [], []
        for raw in texts:
            words = raw.split()
            runs = find_runs(words, shortest, periods)
            sizes.append(len(words))
            found.append([vars(run) for run in runs])
            collapsed.append(b" ".join(collapse(words, runs)))
        listed = pa.array(found, pa.list_(_STRUCT))
        return [pa.array(sizes, pa.int64()), listed, pa.array(collapsed, pa.binary()).cast(pa.string())]

    return arrow_rows(df, keep, text, make, _ADDED, largest=256)
