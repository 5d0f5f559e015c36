"""Periodic runs of words by grammar-compressed detection (operator 13).

A run is a stretch of words with smallest period ``q`` and at least
``max(MIN_LENGTH, MIN_EXPONENT * q)`` words that no neighbouring word extends.

Texts are taken in groups of about ``GROUP_WORDS`` words, whole texts each.
Per group the word ids are compressed by Re-Pair: pairs of neighbours that
occur again become a nonterminal, until no pair repeats.  A round replaces
every pair that is more frequent than the pairs it overlaps, so a round
shortens the sequence by a constant part and nonterminals stay balanced.
What is left of each text is joined by a balanced binary tree.

Each run has a lowest node of its text's derivation whose expansion holds it,
and crosses the boundary between that node's two children.  Of its words at
least ``2q`` lie on one side.  So per node, once, every period up to a
``MIN_EXPONENT``-th of its length is tried at the boundary, first on a few
words of the two copies beside it, then word by word to both sides.  Copies in
a group share nonterminals and with them this work.  The runs of a nonterminal
are translated to every position that the nonterminal is derived at, and
overlapping intervals of one period are merged into maximal ones.

Texts are independent, so nothing is shuffled and a lost task is just rerun.
A task holds one group; a text longer than ``GROUP_WORDS`` is a group alone.

Defined cases: null, empty or white text has no words and no runs.  Repeated
rows and equal ids give one result each; a null id passes through.  Texts of
any length are taken whole.  An empty table gives an empty result.  Columns
other than id and text are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

MIN_LENGTH, MIN_EXPONENT = 6, 4
GROUP_WORDS = 1 << 19
#: (node, period) pairs tried at a time.
TRIED_AT_ONCE = 1 << 21
OUTPUT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row.

    ``runs`` is sorted by start, then period.  ``collapsed`` holds the words
    that are in no run, or in the first period of all runs that hold them,
    joined by one space.  ``edit`` may change a text's words beforehand.
    """
    slim = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    schema = StructType([StructField(id_col, slim.schema[0].dataType), *_parse_datatype_string(OUTPUT)])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def result(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of_texts(texts)
        rows = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
        kept = [b" ".join(collapse(w, r)) for w, r in zip(texts, found, strict=True)]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([len(t) for t in texts], pa.int64()), pa.array(rows, run_type), pa.array(kept, pa.binary()).cast(pa.string())],
            names=schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1).cast(pa.binary())
            plain, texts, words, first = ids.to_pylist() if edit else None, [], 0, 0
            for i in range(len(batch)):
                text = (column[i].as_py() or b"").split()
                text = edit(plain[i], text) if edit else text
                if texts and words + len(text) > GROUP_WORDS:
                    yield result(ids.slice(first, i - first), texts)
                    texts, words, first = [], 0, i
                texts.append(text)
                words += len(text)
            if texts:
                yield result(ids.slice(first), texts)

    return slim.mapInArrow(run, schema)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those after the first period of a run."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    number: dict[bytes, int] = defaultdict(count().__next__)
    x = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    text_of = np.repeat(np.arange(len(texts)), sizes)

    grammar = Grammar(x, text_of)
    rule, s, e, p = crossing_runs(x, *grammar.nodes())
    begin, end, period = grammar.translate(rule, s, e, p)
    top = crossing_runs(x, *top_nodes(grammar, starts + sizes))
    begin, end, period = merge(*(np.concatenate(z) for z in zip((begin, end, period), top[1:], strict=True)))

    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    of = text_of[begin]
    for t, a, n, q in zip(of.tolist(), (begin - starts[of]).tolist(), (end - begin).tolist(), period.tolist(), strict=True):
        out[t].append((a, n, q))
    return out


class Grammar:
    """Re-Pair over a group: rules (left, right, length, a position they are derived at) and the sequence left over."""

    def __init__(self, x: np.ndarray, text_of: np.ndarray):
        self.terminals = int(x.max()) + 1 if len(x) else 0
        left, right, at, self.first_of_round = [], [], [], []
        sym, pos, text, fresh = x.copy(), np.arange(len(x)), text_of, self.terminals
        within = lambda t: np.append(t[:-1] == t[1:], False)[:len(t)]  # noqa: E731 - has a neighbour in its text
        live = within(text)  # whether the pair that begins here may repeat; one that doesn't never will again
        while True:
            chosen, which = _choose(sym, live, fresh)
            if not len(chosen):
                break
            self.first_of_round.append(fresh)
            a_pair = np.zeros(int(which.max()) + 1, np.int64)
            a_pair[which] = chosen
            left.append(sym[a_pair])
            right.append(sym[a_pair + 1])
            at.append(pos[a_pair])
            sym[chosen] = fresh + which
            fresh += len(a_pair)
            stay = np.ones(len(sym), bool)
            stay[chosen + 1] = False
            sym, pos, text, live = sym[stay], pos[stay], text[stay], live[stay]
            new = chosen - np.arange(len(chosen))  # where the new symbols are now
            live[new] = live[np.maximum(new - 1, 0)] = True
            live &= within(text)
        self.sym, self.pos, self.text = sym, pos, text
        join = lambda z: np.concatenate(z) if z else np.zeros(0, np.int64)
        self.left, self.right, self.at = join(left), join(right), join(at)
        self.length = np.ones(fresh, np.int64)
        for a, b in self._rounds():
            rules = slice(a - self.terminals, b - self.terminals)
            self.length[a:b] = self.length[self.left[rules]] + self.length[self.right[rules]]

    def _rounds(self) -> list[tuple[int, int]]:
        bounds = [*self.first_of_round, self.terminals + len(self.left)]
        return list(zip(bounds[:-1], bounds[1:], strict=True))

    def nodes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, boundary, end) of one derived place of each rule."""
        return self.at, self.at + self.length[self.left], self.at + self.length[self.terminals:]

    def translate(self, rule, s, e, p) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, period) of the rules' runs at all positions that the rules are derived at."""
        holds = np.zeros(self.terminals + len(self.left), bool)
        holds[self.terminals + rule] = True
        for a, b in self._rounds():
            rules = slice(a - self.terminals, b - self.terminals)
            holds[a:b] |= holds[self.left[rules]] | holds[self.right[rules]]
        order = np.argsort(rule, kind="stable")
        rule, s, e, p = rule[order], (s - self.at[rule])[order], (e - self.at[rule])[order], p[order]
        out = [(np.zeros(0, np.int64),) * 3]
        here = holds[self.sym]
        sym, pos = self.sym[here], self.pos[here]
        for a, _ in reversed(self._rounds()):
            now = sym >= a
            r, at = sym[now] - self.terminals, pos[now]
            lo, hi = np.searchsorted(rule, r, "left"), np.searchsorted(rule, r, "right")
            k = np.repeat(lo, hi - lo) + _ramp(hi - lo)
            base = np.repeat(at, hi - lo)
            out.append((base + s[k], base + e[k], p[k]))
            children = np.concatenate([self.left[r], self.right[r]])
            places = np.concatenate([at, at + self.length[self.left[r]]])
            keep = holds[children]
            sym, pos = np.concatenate([sym[~now], children[keep]]), np.concatenate([pos[~now], places[keep]])
        return tuple(np.concatenate(z) for z in zip(*out, strict=True))


def _choose(sym: np.ndarray, live: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose pair is replaced in this round, and the number of its rule (0, 1, ..).

    Places whose pair does not repeat are struck out of ``live``.
    """
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(live)
    pairs, inverse, times = np.unique(sym[at] * bound + sym[at + 1], return_inverse=True, return_counts=True)
    if not len(pairs) or times.max() < 2:
        return nothing
    # more frequent first; among equals a mixed order, which keeps rules balanced
    mixed = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    rank = np.empty(len(pairs), np.int64)
    rank[np.lexsort((mixed, times))] = np.arange(1, len(pairs) + 1)
    rank[times < 2] = 0
    live[at] = times[inverse] >= 2
    prio = np.zeros(len(sym) + 1, np.int64)  # prio[i + 1] is of the pair at i; both ends are 0
    prio[at + 1] = rank[inverse]
    # a stretch of equal pairs (of one word repeated) is taken at every other place
    change = np.flatnonzero(np.diff(prio)) + 1
    begin, stop = change, np.append(change[1:], len(prio))
    after = np.append(prio, 0)
    top = (prio[begin] > prio[begin - 1]) & (prio[begin] > after[stop])
    begin, size = begin[top], (stop - begin)[top]
    half = (size + 1) // 2
    chosen = np.repeat(begin - 1, half) + 2 * _ramp(half)
    ranks = prio[chosen + 1]
    found, which, n = np.unique(ranks, return_inverse=True, return_counts=True)
    again = n[which] >= 2  # a rule that is used once would save nothing
    number = np.cumsum(n >= 2) - 1
    return chosen[again], number[which[again]]


def top_nodes(grammar: Grammar, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, boundary, end) of the nodes of balanced trees over what Re-Pair left of each text."""
    pos, text = grammar.pos, grammar.text
    out = [(np.zeros(0, np.int64),) * 3]
    while len(pos):
        first = np.flatnonzero(np.diff(text, prepend=-1))
        index = np.arange(len(pos)) - np.repeat(first, np.diff(np.append(first, len(pos))))
        ends = np.where(np.append(text[1:] == text[:-1], False), np.append(pos[1:], 0), text_ends[text])
        right = np.flatnonzero(index % 2 == 1)
        if not len(right):
            break
        out.append((pos[right - 1], pos[right], ends[right]))
        stay = index % 2 == 0
        pos, text = pos[stay], text[stay]
    return tuple(np.concatenate(z) for z in zip(*out, strict=True))


def crossing_runs(x: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(node, begin, end, period) of the runs at each node's boundary, within the node."""
    tries = (end - start) // MIN_EXPONENT
    tries[end - start < MIN_LENGTH] = 0
    nodes = np.flatnonzero(tries)
    out: list[tuple[int, int, int, int]] = []
    cut = np.flatnonzero(np.diff(np.cumsum(tries[nodes]) // TRIED_AT_ONCE)) + 1
    for part in np.split(nodes, cut):
        node = np.repeat(part, tries[part])
        p = _ramp(tries[part]) + 1
        b = mid[node]
        # a copy of the p words after the boundary follows them, or one of the p words before it precedes them
        for side in (1, -1):
            near = b if side == 1 else b - 1
            fits = np.flatnonzero(near + side * (2 * p - 1) < end[node] if side == 1 else near - (2 * p - 1) >= start[node])
            for share in (0.0, 1.0, 0.5, 0.25, 0.75, 0.125, 0.375, 0.625, 0.875):
                q = p[fits]
                i = near[fits] + side * np.minimum((q * share).astype(np.int64), q - 1)
                fits = fits[x[i] == x[i + side * q]]
            _extend(x, start, mid, end, node[fits], p[fits], side, out)
    node, begin, stop, period = np.array(out, np.int64).reshape(-1, 4).T
    return _smallest_periods(node, begin, stop, period)


def _smallest_periods(node, begin, end, period) -> tuple[np.ndarray, ...]:
    """Of equal stretches of a node, the one with the smallest period."""
    order = np.lexsort((period, end, begin, node))
    node, begin, end, period = node[order], begin[order], end[order], period[order]
    least = np.append(True, (np.diff(node) != 0) | (np.diff(begin) != 0) | (np.diff(end) != 0))[:len(node)]
    return node[least], begin[least], end[least], period[least]


def _extend(x, start, mid, end, nodes, periods, side, out) -> None:
    """Adds the runs that hold the tried copies, node by node, smaller periods first."""
    if not len(nodes):
        return
    edges = np.flatnonzero(np.diff(nodes)) + 1
    for node, periods in zip(nodes[np.append(0, edges)], np.split(periods, edges), strict=True):
        s, b, e = int(start[node]), int(mid[node]), int(end[node])
        while len(periods):
            p = int(periods[0])
            at = b if side == 1 else b - 1 - p  # x[at] and x[at + p] are equal
            lo = at - _agreeing(x[s:at][::-1], x[s + p:at + p][::-1])
            hi = at + _agreeing(x[at:e - p], x[at + p:e]) + p
            rest = periods[1:]
            if hi - lo >= max(MIN_LENGTH, MIN_EXPONENT * p):
                out.append((int(node), lo, hi, p))
                # multiples of p whose two copies lie in this run show the same run again
                inside = (b + 2 * rest <= hi) & (b >= lo) if side == 1 else (b - 2 * rest >= lo) & (b <= hi)
                rest = rest[~((rest % p == 0) & inside)]
            periods = rest


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Leading places at which two stretches are equal."""
    n, at, step = len(a), 0, 16
    while at < n:
        differ = np.flatnonzero(a[at:at + step] != b[at:at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 4
    return n


def merge(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs: intervals of one period that share a period's words become one; sorted by begin, then period."""
    if not len(begin):
        return begin, end, period
    order = np.lexsort((-end, begin, period))
    begin, end, period = begin[order], end[order], period[order]
    lift = np.cumsum(np.append(0, np.diff(period) != 0)) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift  # the furthest end so far within the period
    new = np.append(True, (np.diff(period) != 0) | (begin[1:] + period[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    begin, period, end = begin[first], period[first], np.maximum.reduceat(end, first)
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. sizes[0] - 1, 0, 1, .. sizes[1] - 1, and so on."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
