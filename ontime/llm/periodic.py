"""Periodic runs of words: stretches in which every word equals the one q before it.

A run shows as words that occur again nearby, so a document is first cut down to
the stretches that could hold one. Over such a stretch and over its reversal a
suffix tree is built (Ukkonen); an Euler tour of each answers how far two places
agree to the right and to the left, in constant time. Every run has a Lyndon root
that is the longest Lyndon word from where it begins, for one of the two orders of
the alphabet; extending each of these both ways finds all runs (Bannai et al., The
"Runs" Theorem).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ontime.llm.common import append_columns, hash_runs, mix, slices, texts_of, with_fields

# A run has at least this many words, and twice its period.
LEAST = 12
# Words of a gram: a run of LEAST words or more, twice its period at least, has half
# of LEAST words that occur again one period further.
GRAM = LEAST // 2
RUN_BYTES = 1_000_000
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes."""
    solid = np.concatenate([[False], ~SPACES[data], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def suspects(symbols: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """(from, to): stretches of one document's words that could hold a run.

    All words of a run lie in grams that occur again within the run, so it lies in
    a stretch covered by repeated grams, and their distance is at most half the
    stretch. Nothing beyond a stretch can prolong a run in it, or it would be
    covered as well.
    """
    n = len(symbols) - GRAM + 1
    if n < LEAST - GRAM:
        return []
    grams = owner[:n].astype(np.uint64)
    for i in range(GRAM):
        grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + symbols[i : i + n])
    inside = owner[:n] == owner[GRAM - 1 :]
    order = np.argsort(grams, kind="stable")
    same = (grams[order[1:]] == grams[order[:-1]]) & inside[order[1:]] & inside[order[:-1]]
    here, there = order[:-1][same], order[1:][same]

    def covered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.zeros(len(symbols) + 1, np.int32)
        for at in (a, b):
            np.add.at(edge, at, 1)
            np.add.at(edge, at + GRAM, -1)
        full = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
        # Documents follow one another without a gap.
        first = np.concatenate([[True], owner[1:] != owner[:-1], [True]])
        starts = np.flatnonzero(full[1:-1] & (~full[:-2] | first[:-1]))
        ends = np.flatnonzero(full[1:-1] & (~full[2:] | first[1:])) + 1
        return starts, ends

    for _ in range(2):
        if not len(here):
            return []
        starts, ends = covered(here, there)
        at = np.searchsorted(starts, here, "right") - 1
        near = (there < ends[at]) & (2 * (there - here) <= ends[at] - starts[at])
        here, there = here[near], there[near]
    if not len(here):
        return []
    starts, ends = covered(here, there)
    return [(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a >= LEAST]


class SuffixTree:
    """Ukkonen's suffix tree of a list of symbols (numbers from 1) with an end mark 0.

    Queries go to its Euler tour: the least string depth between the visits of two
    leaves is that of their lowest common ancestor, the length on which the two
    suffixes agree. ``rank`` is each suffix's place in the order of symbols,
    ``opposite`` that in the reversed order; a suffix is behind its own prefixes in
    both.
    """

    def __init__(self, symbols: list[int], ranks: bool = False):
        self.text = [*symbols, 0]
        self.begin, self.stop, self.kids = [0], [0], [{}]
        self.grow()
        self.tour(ranks)

    def grow(self) -> None:
        text, begin, stop, kids = self.text, self.begin, self.stop, self.kids
        n, link = len(text), [0]
        node = edge = length = pending = 0
        for i, symbol in enumerate(text):
            pending += 1
            last = 0
            while pending:
                if not length:
                    edge = i
                below = kids[node]
                child = below.get(text[edge])
                if child is None:
                    below[text[edge]] = len(begin)
                    begin.append(i)
                    stop.append(n)
                    kids.append(None)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    size = stop[child] - begin[child]
                    if length >= size:
                        edge += size
                        length -= size
                        node = child
                        continue
                    at = begin[child] + length
                    if text[at] == symbol:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(begin)
                    below[text[edge]] = split
                    begin += (begin[child], i)
                    stop += (at, n)
                    kids += ({text[at]: child, symbol: split + 1}, None)
                    link += (0, 0)
                    begin[child] = at
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1

    def tour(self, ranks: bool) -> None:
        begin, stop, kids, n = self.begin, self.stop, self.kids, len(self.text)
        depths: list[int] = []
        first = [0] * n
        leaves: list[int] = []
        stack = [(0, 0, iter(sorted(kids[0].items())))]
        depths.append(0)
        while stack:
            node, depth, rest = stack[-1]
            for _, child in rest:
                below = depth + stop[child] - begin[child]
                if kids[child] is None:
                    leaf = n - below
                    first[leaf] = len(depths)
                    leaves.append(leaf)
                    depths.append(below)
                    depths.append(depth)
                else:
                    depths.append(below)
                    stack.append((child, below, iter(sorted(kids[child].items()))))
                    break
            else:
                stack.pop()
                if stack:
                    depths.append(stack[-1][1])
        self.depths, self.first = np.array(depths, np.int32), np.array(first, np.int64)
        if ranks:
            self.rank = np.empty(n, np.int64)
            self.rank[leaves] = np.arange(n)
            self.opposite = np.empty(n, np.int64)
            self.opposite[self.backwards()] = np.arange(n)
        del self.begin, self.stop, self.kids

    def backwards(self) -> list[int]:
        """The leaves with symbols in falling order, the end mark first all the same."""
        begin, stop, kids, n = self.begin, self.stop, self.kids, len(self.text)
        leaves, stack = [], [(0, 0)]
        while stack:
            node, depth = stack.pop()
            below = kids[node]
            if below is None:
                leaves.append(n - depth)
                continue
            # The last one pushed is the next one taken.
            for symbol in sorted(below):
                if symbol:
                    stack.append((below[symbol], depth + stop[below[symbol]] - begin[below[symbol]]))
            if 0 in below:
                stack.append((below[0], depth + stop[below[0]] - begin[below[0]]))
        return leaves

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """On how many symbols the suffixes at ``a`` and ``b`` agree (a and b differ).

        Two overlapping blocks of a power of two cover the visits between the leaves;
        the table of block minima is made one power at a time."""
        x, y = self.first[a], self.first[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        power = np.frexp(high - low + 1)[1] - 1
        out = np.zeros(len(low), np.int64)
        row = self.depths
        for k in range(int(power.max(initial=0)) + 1):
            if k:
                half = 1 << (k - 1)
                row = np.minimum(row[:-half], row[half:])
            now = np.flatnonzero(power == k)
            out[now] = np.minimum(row[low[now]], row[high[now] - (1 << k) + 1])
        return out


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word from each place: up to the next smaller suffix."""
    ranks, out, stack = rank.tolist(), [0] * len(rank), []
    for i, r in enumerate(ranks):
        while stack and ranks[stack[-1]] > r:
            j = stack.pop()
            out[j] = i - j
        stack.append(i)
    return np.array(out[:-1], np.int64)


def runs_of(symbols: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` symbols, in order.
    Symbols are numbers from 1."""
    n = len(symbols)
    if n < max(least, 2):
        return []
    tree = SuffixTree(symbols, ranks=True)
    start = np.tile(np.arange(n), 2)
    period = np.concatenate([lyndon_lengths(tree.rank), lyndon_lengths(tree.opposite)])
    pairs = np.unique(np.stack([start, period], axis=1), axis=0)
    start, period = pairs[:, 0], pairs[:, 1]
    right = tree.agree(start, start + period)
    del tree
    back = SuffixTree(symbols[::-1])
    # Places before a and b are the reversal's suffixes from n - a and n - b on.
    left = back.agree(n - start, n - start - period)
    begin, length = start - left, left + period + right
    keep = (length >= 2 * period) & (length >= least)
    found = np.unique(np.stack([begin[keep], period[keep], length[keep]], axis=1), axis=0)
    return [(b, size, p) for b, p, size in found.tolist()]


def document_runs(data: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[tuple[int, int, int]]]]:
    """Starts, ends and owners of the words in the bytes of several documents
    (``counts`` bytes each, the last one white space), and each document's runs by
    word number within it."""
    starts, ends = words_of(data)
    limits = np.cumsum(counts)
    owner = np.searchsorted(limits, starts, "right")
    words = np.bincount(owner, minlength=len(counts))
    firsts = np.cumsum(words) - words
    symbols = hash_runs(data, starts, ends)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    for a, b in suspects(symbols, owner):
        document = int(owner[a])
        numbers = np.unique(symbols[a:b], return_inverse=True)[1] + 1
        shift = a - int(firsts[document])
        runs[document] += [(at + shift, size, p) for at, size, p in runs_of(numbers.tolist())]
    return starts, ends, owner, runs


def kept_words(count: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for the words that stay: those in no run behind its first period."""
    edge = np.zeros(count + 1, np.int64)
    for at, size, period in runs:
        edge[at + period] += 1
        edge[at + size] -= 1
    return np.cumsum(edge[:-1]) == 0


def find_runs(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """The rows with ``runs``, an array of (start, length, period), and ``collapsed``,
    the text with one period of each run left, its words joined by one space.

    Words are what white space of ASCII separates. A run is a stretch of words with
    smallest period q and max(12, 2 q) words or more that no neighbouring word
    extends; runs are in order of start, then period. A word goes if it is in any
    run behind that run's first q words. Null, empty and blank texts have no words,
    no runs and an empty ``collapsed``. Repeated rows are judged alike; other
    columns pass through, and a column called like a new one is an error. Words are
    compared by 64-bit hashes. Long texts: the memory of a task grows with its
    longest text, by 100 bytes a byte, and with the longest stretch that repeats, by
    about 1 KB a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, RUN_BYTES):
                coded = [t.encode("utf-8", "surrogatepass") for t in texts_of(part, text)]
                joined = b" ".join([*coded, b""])
                counts = np.array([len(c) + 1 for c in coded], np.int64)
                starts, ends, owner, found = document_runs(np.frombuffer(joined, np.uint8), counts)
                limits = np.searchsorted(owner, np.arange(len(coded) + 1))
                lists, texts = [], []
                for k, (a, b) in enumerate(zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True)):
                    stay = np.flatnonzero(kept_words(b - a, found[k])) + a
                    texts.append(b" ".join([joined[i:j] for i, j in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)]).decode("utf-8", "surrogatepass"))
                    lists.append([{"start": at, "length": size, "period": p} for at, size, p in found[k]])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield append_columns(part, [pa.array(lists, kind), pa.array(texts, pa.string())], [runs, collapsed])

    kind = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
    return df.mapInArrow(run, with_fields(df.schema, [(runs, kind), (collapsed, T.StringType())]))


