"""Periodic runs of words in whole texts, by enumeration of maximal pairs.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), of a length of at least
``max(SHORTEST, EXPONENT * q)``, that no neighbouring word extends keeping q. A maximal pair is two places of one text
that begin equal stretches of l words, with different words before and after. If the places are q apart and q + l is
long enough, the words from the first place to the end of the second stretch are a run: the pair is maximal, so nothing has to be
extended. A period that is a multiple of the smallest one gives the same stretch; the smallest counts.

Inside a task the words of some texts become numbers, and their suffixes are sorted by prefix doubling, each text
apart. Suffixes that share LEAST_SHARED words with a neighbour go on: the tree of their LCP intervals is walked from its leaves,
and where two intervals join at l words, the pairs between them have exactly l words in common. The class lists of an
interval are one list of its places in order, each with its left word. A place of the smaller interval looks for its neighbours in
the larger one's list; those of another left-word class that stand at most l / (EXPONENT - 1) apart are maximal pairs of a run.
Neighbours are enough: a place between the two would give the run a smaller period.

Nothing is shuffled; texts are independent. Words are parted at ASCII white space.

Edge cases: a null, empty or blank text has no words and no run, and collapses to the empty text. Very long texts
are worked on alone, with memory in proportion to their words. Repeated rows each get their result; other columns stay in the JVM, so
their names cannot clash.
"""

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import raw, text_column

#: The shortest run, and how often its period must fit into it.
SHORTEST, EXPONENT = 6, 4
#: Both places of a run's pair share at least this many words.
LEAST_SHARED = SHORTEST - SHORTEST // EXPONENT
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and for each sorted place the place where its group of equal keys begins."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    return order, np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


def _in_groups(heads: np.ndarray) -> np.ndarray:
    """Which sorted places share their group with another."""
    same = heads[1:] == heads[:-1]
    shared = np.zeros(len(heads), dtype=bool)
    shared[1:] |= same
    shared[:-1] |= same
    return shared


def repeated_suffixes(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next four words stand elsewhere in the same text too, sorted by their suffixes, and whether each is
    the first with its four words. ``words`` are numbers that no two texts share; ``ends`` has each place's end of text."""
    n = len(words)
    place = np.arange(n)

    def ahead(rank: np.ndarray, at: np.ndarray, h: int) -> np.ndarray:
        there = at + h
        inside = there < ends[at]
        return np.where(inside, rank[np.where(inside, there, 0)] + 1, 0)

    rank = words
    for h in (1, 2):
        order, heads = _ranks(rank * (n + 1) + ahead(rank, place, h))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = heads
    slots = np.flatnonzero(_in_groups(heads))
    first = heads[slots] == slots
    suffixes = order
    open_slots, open_places, h = slots, order[slots], 4
    while len(open_places):
        group, following = rank[open_places], ahead(rank, open_places, h)
        by = np.lexsort((following, group))
        open_places, group, following = open_places[by], group[by], following[by]
        new = np.ones(len(by), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (following[1:] != following[:-1])
        heads = open_slots[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
        suffixes[open_slots] = open_places
        rank[open_places] = heads
        still = _in_groups(heads)
        open_slots, open_places, h = open_slots[still], open_places[still], 2 * h
    return suffixes[slots], first


def _shared_words(places: np.ndarray, first: np.ndarray, words: list[int], ends: np.ndarray) -> list[int]:
    """How many words each suffix shares with the one sorted before it; 0 for the first with its four words. Places go
    in the order of the text: the next place shares at most one word less."""
    shared = [0] * len(places)
    before = np.roll(places, 1)
    in_text = np.argsort(places, kind="stable")
    in_text = in_text[~first[in_text]]
    was, n = -1, 0
    for k, i, j, end in zip(in_text.tolist(), places[in_text].tolist(), before[in_text].tolist(), ends[places[in_text]].tolist()):
        n, was = max(0, n - (i - was)), i
        most = end - max(i, j)
        while n < most and words[i + n] == words[j + n]:
            n += 1
        shared[k] = n
    return shared


def _joined(a: list[int], b: list[int], shared: int, words: list[int], starts: list[int], found: dict) -> list[int]:
    """The places of two intervals that join at ``shared`` words; runs between them go to ``found``."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    reach = shared // (EXPONENT - 1)
    for x in small:
        at = bisect_left(large, x)
        for y in large[max(0, at - 1) : at + 1]:
            i, j = (x, y) if x < y else (y, x)
            if j - i <= reach and (i == starts[i] or words[i - 1] != words[j - 1]):
                end = j + shared
                found[i, end] = min(j - i, found.get((i, end), j - i))
    if 8 * len(small) > len(large):
        large += small
        large.sort()
    else:
        for x in small:
            insort(large, x)
    return large


def find_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The (start, length, period) of all runs of each text, by start and period."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not lengths.sum():
        return result
    number: dict[bytes, int] = {}
    plain = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), dtype=np.int64, count=int(lengths.sum()))
    text_ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(texts)), lengths)
    ends = text_ends[owner]
    order, heads = _ranks(owner * len(number) + plain)
    own = np.empty(len(plain), dtype=np.int64)
    own[order] = heads
    places, first = repeated_suffixes(own, ends)
    if not len(places):
        return result
    words = own.tolist()
    starts = (text_ends - lengths)[owner]
    shared = _shared_words(places, first, words, ends)
    starts_of = starts.tolist()
    found: dict[tuple[int, int], int] = {}
    intervals: list[list[int]] = []
    levels: list[int] = []
    for place, level in zip([*places.tolist(), -1], [*shared, 0]):
        level = level if level >= LEAST_SHARED else 0
        while levels and levels[-1] >= max(level, 1):
            last = intervals.pop()
            intervals[-1] = _joined(intervals[-1], last, levels.pop(), words, starts_of, found)
        if not level:
            intervals, levels = [[place]], []
        else:
            intervals.append([place])
            levels.append(level)
    for (start, end), period in sorted(found.items(), key=lambda x: (x[0][0], x[1])):
        if end - start >= max(SHORTEST, EXPONENT * period):
            text = owner[start]
            result[text].append((start - int(starts[start]), end - start, period))
    return result


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without what a run repeats after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def runs(text: Column) -> Column:
    """struct(n_words, runs, collapsed) of a text: ``runs`` is an array of struct(start, length, period) by start and
    period, ``start`` a word number from 0; ``collapsed`` is the text with each run cut to its first period."""

    def work():
        def do(texts: pa.Array) -> pa.Array:
            parted = [t.split() if t else [] for t in raw(texts)]  # bytes: parted at ASCII white space only
            found = find_runs(parted)
            shorter = [collapsed(w, r).decode() for w, r in zip(parted, found)]
            rows = [[dict(zip(("start", "length", "period"), r)) for r in of_text] for of_text in found]
            columns = [pa.array([len(w) for w in parted], pa.int64()), pa.array(rows, pa.list_(_RUN)), pa.array(shorter, pa.string())]
            return pa.StructArray.from_arrays(columns, fields=list(_FOUND))

        return do

    kind = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"
    return text_column(work, kind, _FOUND)(text)


def longest(found: Column) -> Column:
    """The run of greatest length; of equal ones that with the smallest start, then period. Null if there is none."""
    ordered = F.transform(found, lambda r: F.struct(-r["length"], r["start"], r["period"], r.alias("run")))
    return F.array_min(ordered)["run"]
