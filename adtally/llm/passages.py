"""Repeated passages by compact windows of token min-hashes.

The tokens of a document are its runs of five words.  For one hash function, the Cartesian
tree over the tokens' hashes gives the compact windows (l, c, r): all subsequences within
[l, r] that contain c have the token at c as their min-hash.  Windows shorter than a
passage are never visited.  The subsequences of passage length that one window stands for
begin in one interval of positions, and the intervals of a function tile the document.
An interval join of the tilings of several functions gives the runs of subsequences that
share all their min-hashes; these signatures, in a number of bands, are the keys by which
documents meet.  The first band has six functions: an exact repeat of passage length always
shares such a signature, while a short common line hardly ever fills one.  The other four
bands have two functions each, for near repeats.  A pair that meets is verified on the whole
documents: a passage is a subsequence of full length whose tokens have a Jaccard similarity
of 0.8 and more with those of its counterpart.

Every member of a group is tested against the first.  Where that leaves some without a
link, the members are compared with each other, block by block within tasks, on the tokens
of the windows that have the signature: exact counts of common tokens leave few pairs to
look at, and of those that are similar only as many are handed on as it takes to connect
the components and to give each member a partner.

Documents of equal words, by a 128-bit fingerprint, are one node.  A near repeat of one passage length at similarity
0.8 meets its partner with a probability of 98 %; longer passages and closer similarity
raise it (0.9: 99.9 %).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..operators.common import salted_join
from .graph import Scratch, components, fixed, ranked
from .words import SPACED, Hasher, mixed, shingles

WORDS = 5
LENGTH = 50
BANDS = ((0, 1, 2, 3, 4, 5), (0, 1), (2, 3), (4, 5), (6, 7))  # the functions of each; the first finds exact repeats
SIMILAR = 0.8
GROUP = 1 << 17
KNOWN = 1 << 21  # tokens of texts kept by one task that verifies
BLOCK = 4096  # members of a group compared by one task
STARTS = 16  # of the windows of one signature that are compared as one
COMMON = 128  # windows; tokens of more are counted by a matrix product
EXPANDED = 1 << 18  # pairs of places, each at the distances near its own, that are counted at once
LOOKED = 1 << 14  # tokens and starts of the distances that are counted at once
STRETCH = 1 << 23  # tokens of one tree; places are told apart by fewer bits than a long text has
_PLACE = np.uint64((1 << 24) - 1)
_SPREAD, _BACK = np.uint64(0x9E3779), np.uint64(pow(0x9E3779, -1, 1 << 24))


def hashed(tokens: np.ndarray, function: int) -> np.ndarray:
    """Hashes of one function with the scrambled position in their low bits, so that a minimum tells its place.

    A signature holds the token, not its place, so any of equal tokens will do; the
    scramble keeps the tree of a text that repeats one word balanced.
    """
    value = mixed(tokens + np.uint64((function + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return (value & ~_PLACE) | ((np.arange(len(tokens), dtype=np.uint64) * _SPREAD) & _PLACE)


def compact_windows(values: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """All compact windows (l, c, r), ends included, of at least ``length``.

    The Cartesian trees over values[first:last + 1] are built level by level for all
    documents at once: the minimum of each range splits it in two.  No range may be longer
    than ``STRETCH``.
    """
    ended = np.concatenate([values, values[-1:]])  # a range may end at the end
    ls, cs, rs = [], [], []
    low, high = first, last
    while True:
        long = high - low + 1 >= length
        low, high = low[long], high[long]
        if not len(low):
            break
        at = np.empty(2 * len(low), np.int64)
        at[0::2], at[1::2] = low, high + 1
        least = (np.minimum.reduceat(ended, at)[0::2] * _BACK) & _PLACE
        least = low + ((least - low.astype(np.uint64)) & _PLACE).astype(np.int64)
        ls.append(low)
        cs.append(least)
        rs.append(high)
        low, high = np.stack([low, least + 1], 1).ravel(), np.stack([least - 1, high], 1).ravel()
    if not ls:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(ls), np.concatenate(cs), np.concatenate(rs)


def tiling(tokens: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, function: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, place of the min-hash) of each interval of starts of subsequences of ``length``.

    Trees stand over stretches that overlap by one token less than ``length``, so each start is in one.
    """
    step = STRETCH - length + 1
    many = np.maximum(1, -(-(last - first + 2 - length) // step))
    ends, first = np.repeat(last, many), np.repeat(first, many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * step
    last = np.minimum(first + STRETCH - 1, ends)
    low, place, high = compact_windows(hashed(tokens, function), first, last, length)
    begin = np.maximum(low, place - length + 1)
    order = np.argsort(begin)
    return begin[order], place[order]


def _signed(tokens: np.ndarray, first: np.ndarray, last: np.ndarray, length: int,
            bands: tuple[tuple[int, ...], ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, begin) of the intervals of starts that have one signature, for each band; those of the first band are even."""
    tiles = {f: tiling(tokens, first, last, length, f) for f in sorted({f for band in bands for f in band})}
    begins = {f: np.zeros(len(tokens), bool) for f in tiles}
    for f, (begin, _) in tiles.items():
        begins[f][begin] = True
    number = {f: np.cumsum(x, dtype=np.int32) for f, x in begins.items()}
    for band_, band in enumerate(bands):
        cuts = np.flatnonzero(np.logical_or.reduce([begins[f] for f in band]))
        if not len(cuts):
            continue
        key = np.full(len(cuts), band_ + 1, np.uint64)
        for f in band:
            token = tokens[tiles[f][1][number[f][cuts] - 1]]
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + token)
        yield key & ~np.uint64(1) | np.uint64(band_ > 0), cuts


def signatures(tokens: np.ndarray, first: np.ndarray, last: np.ndarray, length: int,
               bands: tuple[tuple[int, ...], ...] = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """(key, document number) of all signatures, each once per document; those of the first band are even.

    ``first`` and ``last`` are the ends of the documents in ``tokens``, which lie in order.
    """
    found = list(_signed(tokens, first, last, length, bands))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    key = np.concatenate([k for k, _ in found])
    owner = np.concatenate([np.searchsorted(first, cuts, side="right") - 1 for _, cuts in found])
    name = key + mixed(owner.astype(np.uint64))
    order = np.argsort(name)
    order = order[np.append(True, np.diff(name[order]) != 0)]
    return key[order], owner[order]


def windows(tokens: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, keys: np.ndarray, owners: np.ndarray,
            bands: tuple[tuple[int, ...], ...] = BANDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into ``keys``, first token, token behind the last) of the subsequences that have one of these signatures.

    ``owners`` are the documents' numbers.  Neighbours lie in one stretch, of ``STARTS`` starts at most.
    """
    named = lambda key, owner: mixed(key + mixed(owner.astype(np.uint64)))
    wanted = named(keys, owners)
    order = np.argsort(wanted)
    wanted = wanted[order]
    out = []
    for key, cuts in _signed(tokens, first, last, length, bands):
        owner = np.searchsorted(first, cuts, side="right") - 1
        stop = np.minimum(np.append(cuts[1:], len(tokens)), last[owner] - length + 2)  # behind the last start
        name = named(key, owner)
        at = np.minimum(np.searchsorted(wanted, name), len(wanted) - 1)
        mine = np.flatnonzero(wanted[at] == name)
        many = -(-(stop[mine] - cuts[mine]) // STARTS)
        mine, piece = np.repeat(mine, many), np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        low = cuts[mine] + piece * STARTS
        out.append((order[at[mine]], low, np.minimum(low + STARTS, stop[mine]) + length - 1))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def _window_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """One 64-bit hash of each subsequence of ``length`` tokens."""
    factor = 0x9E3779B97F4A7C15
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(tokens), factor, np.uint64)]))
    inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(tokens), pow(factor, -1, 1 << 64), np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * powers[:-1])])
    return mixed((sums[length:] - sums[:-length]) * inverse[:len(tokens) - length + 1])


def _cover(mark: np.ndarray, starts: np.ndarray, length: int) -> None:
    change = np.bincount(starts, minlength=len(mark) + 1)
    change -= np.bincount(starts + length, minlength=len(mark) + 1)
    mark |= np.cumsum(change[:-1]) > 0


def _sums(mark: np.ndarray, length: int) -> np.ndarray:
    """How many places are marked in each subsequence of ``length``."""
    sums = np.concatenate([[0], np.cumsum(mark)])
    return sums[length:] - sums[:-length]


def _votes(left: np.ndarray, right: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """How many pairs of equal tokens stand at each distance, from -size[0] on.

    ``left`` and ``right`` are (token number, place) sorted by token.  Tokens of few pairs are
    expanded some at a time, the others counted by the correlation of their places.
    """
    votes = np.zeros(sum(size) + 1, np.int64)
    names, first, many = np.unique(left[0], return_index=True, return_counts=True)
    low, high = np.searchsorted(right[0], names), np.searchsorted(right[0], names, side="right")
    pairs = many * (high - low)
    heavy = pairs > 64 * sum(size)
    for i in np.flatnonzero(heavy).tolist():
        width = 1 << (sum(size) + 1).bit_length()
        one, two = np.zeros(width), np.zeros(width)
        one[size[0] - left[1][first[i]:first[i] + many[i]]] = 1
        two[right[1][low[i]:high[i]]] = 1
        votes += np.rint(np.fft.irfft(np.fft.rfft(one) * np.fft.rfft(two), width)).astype(np.int64)[:len(votes)]
    each = np.repeat(np.where(heavy, 0, high - low), many)  # partners of each left place
    start, ends = np.repeat(low, many), np.cumsum(each)
    at = 0
    while at < len(each):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), side="right")))
        mine = each[at:stop]
        within = np.arange(mine.sum()) - np.repeat(np.cumsum(mine) - mine, mine)
        votes += np.bincount(right[1][np.repeat(start[at:stop], mine) + within] - np.repeat(left[1][at:stop], mine) + size[0],
                             minlength=len(votes))
        at = stop
    return votes


def _commons(looks: list[tuple], length: int) -> Iterator[np.ndarray]:
    """Tokens that left[s:s + length] and right[s + shift:s + shift + length] have in common, each as often as in both.

    For each look (left, right, shift, low, high), over the starts s from ``low`` to ``high``; ``left`` and ``right``
    are (token number, place), the numbers below those of all places.
    """
    lefts, rights, shifts, lows, highs = zip(*looks)
    n, m = [len(x[0]) for x in lefts], [len(x[0]) for x in rights]
    width = np.array(highs) - np.array(lows) + 1
    left = np.concatenate([x[1] for x in lefts]) - np.repeat(lows, n)  # places from each look's first start on
    right = np.concatenate([x[1] for x in rights]) - np.repeat(np.add(lows, shifts), m)
    own, other = (np.repeat(np.arange(len(looks)), x) for x in (n, m))
    name, its = np.concatenate([x[0] for x in lefts]), np.concatenate([x[0] for x in rights])
    kinds = int(max(name.max(initial=0), its.max(initial=0))) + 1
    name, its = own * kinds + name, other * kinds + its
    name = np.concatenate([name, name, its, its])
    owner = np.concatenate([own, own, other, other])
    start = np.clip(np.concatenate([left - length + 1, left + 1, right - length + 1, right + 1]), 0, width[owner])
    n, m, span = len(left), len(right), int(width.max()) + 1
    order = np.argsort(name * span + start) if len(looks) * kinds * span < 1 << 62 else np.lexsort((start, name))
    one = np.cumsum(np.repeat([1, -1, 0], [n, n, 2 * m])[order])  # every token's changes add up to nothing
    two = np.cumsum(np.repeat([0, 1, -1], [2 * n, m, m])[order])
    both = np.diff(np.minimum(one, two), prepend=0)
    ends = np.cumsum(width + 1)
    base = ends - width - 1
    # Changes at one start come in any order; their sum is what counts.
    change = np.bincount((base[owner] + start)[order], weights=both, minlength=int(ends[-1]))
    counts = np.cumsum(change)
    return (counts[i:j - 1] for i, j in zip(base.tolist(), ends.tolist()))


def _common(left: np.ndarray, right: np.ndarray, shift: int, low: int, high: int, length: int) -> np.ndarray:
    """:func:`_commons` of one look."""
    return next(_commons([(left, right, shift, low, high)], length))


def _exact_runs(left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Which pairs of places, each token once in either and by the left, lie in an exact repeat of ``length`` and more."""
    edges = np.flatnonzero(np.concatenate([[True], (np.diff(left) != 1) | (np.diff(right) != 1), [True]]))
    run = np.diff(edges)
    return np.repeat(run >= length, run)


def _close_starts(left: np.ndarray, right: np.ndarray, shifts: np.ndarray, size: tuple[int, int], length: int,
                  need: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index into ``shifts``, first start, start behind the last) where :func:`_common` reaches ``need``, some shifts at a time.

    ``left`` and ``right`` are the pairs of places with equal tokens, of which none stands twice.  A pair lies in
    the subsequences of one run of starts at each distance, so the counts of all distances are one sum over the
    ends of these runs.
    """
    distance = right - left
    order = np.argsort(distance)
    left, distance = left[order], distance[order]
    first, behind = np.searchsorted(distance, shifts - length, side="right"), np.searchsorted(distance, shifts + length)
    width, ends, done = size[0] + 2, np.cumsum(behind - first), 0
    while done < len(shifts):
        stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + EXPANDED, side="right")))
        some, each = shifts[done:stop], (behind - first)[done:stop]
        row = np.repeat(np.arange(len(some)), each)
        pair = np.arange(len(row)) + np.repeat(first[done:stop] - (np.cumsum(each) - each), each)
        gap, place = distance[pair] - some[row], left[pair]
        low, high = np.maximum(0, -some)[row], (np.minimum(size[0], size[1] - some) - length + 1)[row]
        begins = row * width + np.clip(place + np.maximum(gap, 0) - length + 1, low, high)
        closes = row * width + np.clip(place + np.minimum(gap, 0) + 1, low, high)
        at, change = np.concatenate([begins, closes]), np.repeat([1, -1], len(row))
        order = np.argsort(at)
        at, many = at[order], np.cumsum(change[order])
        found = np.flatnonzero((many[:-1] >= need) & (at[1:] > at[:-1]))  # a shift's changes add up to nothing
        yield at[found] // width + done, at[found] % width, at[found + 1] - at[found] // width * width
        done = stop


def _maybe(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which tokens of the left are in the right, or have the low bits of one that is."""
    bits = np.int64((1 << min(22, max(12, (16 * len(right)).bit_length()))) - 1)
    table = np.zeros(int(bits) + 1, bool)
    table[right.view(np.int64) & bits] = True
    return table[left.view(np.int64) & bits]


def shared_passages(left: np.ndarray, right: np.ndarray, length: int, similar: float = SIMILAR) -> list[np.ndarray]:
    """Which tokens of both documents lie in passages they share: two boolean arrays.

    Only subsequences with enough tokens that the other document has at all are looked at.
    Exact repeats of ``length`` are found first, by their runs or by a hash of each.  Elsewhere the documents are
    aligned at the distances that an eighth of a passage's tokens agree on,
    wherever and however often they stand in the right, and subsequences at the same
    distance are compared there, in one sum if no common token stands twice.
    """
    marks = [np.zeros(len(left), bool), np.zeros(len(right), bool)]
    if min(len(left), len(right)) < length:
        return marks
    need, size = 2 * length * similar / (1 + similar) - 1e-9, (len(left), len(right))
    maybe = _maybe(left, right)
    starts = np.flatnonzero(_sums(maybe, length) >= need)
    if not len(starts):
        return marks
    open_ = np.zeros(len(left), bool)
    _cover(open_, starts, length)
    maybe = np.flatnonzero(open_ & maybe)
    order = np.argsort(right)
    sorted_ = right[order]
    near, there = np.zeros(len(left), np.int64), np.zeros(len(left), bool)  # a token's number is its first place in this order
    near[maybe] = np.searchsorted(sorted_, left[maybe])
    there[maybe] = sorted_.take(near[maybe], mode="clip") == left[maybe]
    able = _sums(there, length) >= need
    starts = np.flatnonzero(able)
    if not len(starts):
        return marks
    open_ = np.zeros(len(left), bool)
    _cover(open_, starts, length)
    mine = np.flatnonzero(open_ & there)
    token = near[mine]
    times = np.searchsorted(sorted_, left[mine], side="right") - token
    once = times.max() == 1 and np.bincount(token).max() == 1
    if once:
        theirs = order[token]
        exact = _exact_runs(mine, theirs, length)
        marks[0][mine[exact]] = marks[1][theirs[exact]] = True
        votes = np.bincount((theirs - mine)[~exact] + size[0], minlength=sum(size) + 1)  # exact repeats need no alignment with each other
    else:
        number = np.searchsorted(sorted_, right)
        one, two = _window_hashes(left, length), _window_hashes(right, length)
        _cover(marks[0], np.flatnonzero(np.isin(one, two)), length)
        _cover(marks[1], np.flatnonzero(np.isin(two, one)), length)
        votes = 0
        for some, its in ((~marks[0][mine], np.arange(size[1])), (marks[0][mine], np.flatnonzero(~marks[1]))):
            some = mine[some]
            some, its = some[np.argsort(near[some], kind="stable")], its[np.argsort(number[its], kind="stable")]
            votes = votes + _votes((near[some], some), (number[its], its), size)
    shifts = np.flatnonzero(votes >= length // 8) - size[0]
    shifts = shifts[np.minimum(size[0], size[1] - shifts) - np.maximum(0, -shifts) >= length]
    if not len(shifts):
        return marks
    if once:
        for row, low, high in _close_starts(mine, theirs, shifts, size, length, need):
            for mark, by in zip(marks, (0, shifts[row])):
                change = np.bincount(low + by, minlength=len(mark) + 1) - np.bincount(high + by + length - 1, minlength=len(mark) + 1)
                mark |= np.cumsum(change)[:-1] > 0
        return marks
    its = np.flatnonzero(np.isin(right, left[mine]))
    able = [able, _sums(np.isin(right, left), length) >= need]
    left_over, looks, total = [_sums(~m, length) > 0 for m in marks], [], 0
    rare = [np.flatnonzero(x) for x in able]
    if len(rare[0]) * len(rare[1]) <= EXPANDED:
        fresh = left_over[0][rare[0]][:, None] | left_over[1][rare[1]][None]
        apart = (rare[1][None] - rare[0][:, None])[fresh] + size[0]
        shifts = shifts[np.bincount(apart, minlength=sum(size) + 1)[shifts + size[0]] > 0]
    # A pair of subsequences matters only if either has a place that is not marked yet.
    for shift in shifts.tolist():
        low, high = max(0, -shift), min(size[0], size[1] - shift) - length
        here, beside = slice(low, high + 1), slice(low + shift, high + shift + 1)
        starts = np.flatnonzero(able[0][here] & able[1][beside] & (left_over[0][here] | left_over[1][beside]))
        if len(starts):
            low, high = low + int(starts[0]), low + int(starts[-1])
            ours = mine[slice(*np.searchsorted(mine, (low, high + length)))]
            theirs = its[slice(*np.searchsorted(its, (low + shift, high + shift + length)))]
            looks.append(((near[ours], ours), (number[theirs], theirs), shift, low, high))
            total += len(ours) + len(theirs) + high - low
        if looks and (total >= LOOKED or shift == shifts[-1]):
            hits = [(np.flatnonzero(counts >= need) + look[3], look[2]) for look, counts in zip(looks, _commons(looks, length))]
            looks, total = [], 0
            if any(len(x) for x, _ in hits):
                _cover(marks[0], np.concatenate([x for x, _ in hits]), length)
                _cover(marks[1], np.concatenate([x + by for x, by in hits]), length)
                left_over = [_sums(~m, length) > 0 for m in marks]
    return marks


def _counted(covers: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, counts) for some of ``first`` at a time: how many tokens each has in common with each of ``second``.

    A token counts as often as both have it.
    """
    owner = np.repeat(np.arange(len(covers)), [len(x) for x in covers])
    token = np.concatenate(covers)
    order = np.lexsort((owner, token))
    owner, token = owner[order], token[order]
    place = np.arange(len(token))
    begins = np.append(True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1]))
    again = place - np.maximum.accumulate(np.where(begins, place, 0))  # its second occurrence is a token of its own
    if again.any():
        order = np.lexsort((owner, again, token))
        owner, token, again = owner[order], token[order], again[order]
    name = np.cumsum(np.append(True, (token[1:] != token[:-1]) | (again[1:] != again[:-1]))) - 1
    many = np.bincount(name)
    start = np.cumsum(many) - many
    often = np.flatnonzero(many > COMMON)
    column = np.full(len(many), -1)
    column[often] = np.arange(len(often))
    dense = np.zeros((len(covers), len(often)), np.float32)
    at = column[name] >= 0
    dense[owner[at], column[name[at]]] = 1
    at = np.flatnonzero((many[name] > 1) & ~at)
    at = at[np.argsort(owner[at], kind="stable")]  # of rarer tokens, by window
    edges = np.searchsorted(owner[at], np.arange(len(covers) + 1))
    column = np.full(len(covers), -1)
    column[second] = np.arange(len(second))
    for i in range(0, len(first), 256):
        rows = first[i:i + 256]
        counts = (dense[rows] @ dense[second].T).astype(np.int64)
        mine = np.concatenate([at[edges[r]:edges[r + 1]] for r in rows])
        row = np.repeat(np.arange(len(rows)), edges[rows + 1] - edges[rows])
        times = many[name[mine]]
        partner = np.repeat(start[name[mine]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        target, row = column[owner[partner]], np.repeat(row, times)
        counts += np.bincount((row * len(second) + target)[target >= 0], minlength=counts.size).reshape(counts.shape)
        yield rows, counts


def similar_windows(names: np.ndarray, labels: np.ndarray, alone: np.ndarray, blocks: np.ndarray, covers: list[np.ndarray],
                    length: int, similar: float = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of documents with similar windows: enough to connect their labels, and one for each that is ``alone``, if it has any.

    ``names`` are the documents of the windows, whose tokens are ``covers``; of two blocks,
    one member of each is paired.
    """
    need = 2 * length * similar / (1 + similar) - 1e-9
    labels, done = labels.copy(), ~alone
    first, second = np.flatnonzero(blocks == blocks.min()), np.flatnonzero(blocks == blocks.max())
    one, two = [], []
    for rows, counts in _counted(covers, first, second):
        close = (counts >= need) & (names[rows, None] != names[None, second])
        if len(first) == len(second) and first[0] == second[0]:
            close &= rows[:, None] < second[None]
        for i, found in zip(rows.tolist(), close):
            others = second[found]
            while len(others := others[(labels[others] != labels[i]) | ~done[others] | ~done[i]]):
                j, others = int(others[0]), others[1:]
                if shared_passages(covers[i], covers[j], length, similar)[0].any():
                    one.append(names[i])
                    two.append(names[j])
                    labels[labels == labels[j]] = labels[i]
                    done[i] = done[j] = True
    a, b = np.array(one, np.int64), np.array(two, np.int64)
    return np.minimum(a, b), np.maximum(a, b)


def spans(marks: np.ndarray, words: int) -> list[dict[str, int]]:
    """Runs of marked tokens as spans of words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [{"start": int(a), "stop": int(b) + words - 1} for a, b in edges.reshape(-1, 2)]


def _mark(tokens: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit numbers for a sequence of tokens."""
    at = mixed(np.arange(len(tokens), dtype=np.uint64))
    with np.errstate(over="ignore"):
        sums = [mixed(tokens + at).sum(dtype=np.uint64), mixed((tokens ^ np.uint64(0xA0761D6478BD642F)) - at).sum(dtype=np.uint64)]
    return tuple(int(x.astype(np.int64)) for x in sums)


_SPANS = "array<struct<start:bigint,stop:bigint>>"


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, length: int = LENGTH,
                      similar: float = SIMILAR) -> DataFrame:
    """Per document: key, n_words, class_id, n_links, n_repeated and spans.

    Two documents are linked if they share a passage of ``length`` words, or one that is
    similar; class_id is the smallest key reachable by links, the document's own if there
    are none.  n_links counts the other texts it was verified to share one with (the best-met
    one of each of its groups, and others as needed to connect its class or where it has no link
    with that one, not all), spans are the words of these passages,
    n_repeated their number.  Documents of equal words are linked if they are long enough,
    with one span over all.  Words are lower-cased (A-Z) and split at white space.  Shorter
    and null texts link with nothing.  Repeated keys are one document for linking; a null
    key is no class of its own.  Other columns are ignored.
    """
    size = length - words + 1
    narrow = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Numbers of all texts; of those long enough, with the text where its words are first met."""
        hasher, seen = Hasher(), set()
        for batch in batches:
            found = [hasher.text(t.as_py(), SPACED) for t in batch.column(1)]
            marks, kept = [_mark(w) for w in found], []
            for words_, mark in zip(found, marks):
                kept.append(len(words_) >= length and mark not in seen)
                if kept[-1]:
                    if len(seen) >= 1 << 18:
                        seen.clear()
                    seen.add(mark)
            numbers = [pa.array(x, pa.int64()) for x in ([len(w) for w in found], [m[0] for m in marks], [m[1] for m in marks])]
            texts = pc.if_else(pa.array(kept, pa.bool_()), batch.column(1), pa.scalar(None, batch.column(1).type))
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, texts], names=["key", "n", "fp", "fp2", "text"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()

        def done(parts: list[np.ndarray], owners: list[int]) -> pa.RecordBatch:
            last = np.cumsum([len(p) for p in parts]) - 1
            first = np.concatenate([[0], last[:-1] + 1])
            keys, number = signatures(np.concatenate(parts), first, last, size)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.array(owners, np.int64)[number])],
                                              names=["k", "node"])

        parts, owners, total = [], [], 0
        for batch in batches:
            for node, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts.append(shingles(hasher.text(value.as_py(), SPACED), words))
                owners.append(node)
                total += len(parts[-1])
                if total >= GROUP:
                    yield done(parts, owners)
                    parts, owners, total = [], [], 0
        if parts:
            yield done(parts, owners)

    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known, total = Hasher(), {}, 0

        def tokens(node: int, text: pa.StringScalar) -> np.ndarray:
            """Those of the texts met last, as rows come by one of theirs and hubs come again and again."""
            nonlocal total
            if node not in known:
                if total > KNOWN:
                    known.clear()
                    total = 0
                known[node] = shingles(hasher.text(text.as_py(), SPACED), words)
                total += len(known[node])
            return known[node]

        for batch in batches:
            kept, left, right = [], [], []
            names = [batch.column(c).to_pylist() for c in (0, 1)]
            for i in range(batch.num_rows):
                one, two = shared_passages(*[tokens(names[c][i], batch.column(c + 2)[i]) for c in (0, 1)], size, similar)
                if one.any():
                    kept.append(i)
                    left.append(spans(one, words))
                    right.append(spans(two, words))
            pairs = batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*pairs.columns, pa.array(left, kind), pa.array(right, kind)],
                                             names=["a", "b", "left", "right"])

    steps = Scratch(docs.sparkSession)
    # Words are hashed once for both the numbers and the texts.
    read, once = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    measured = read.fixed(narrow.mapInArrow(measure, "key bigint, n bigint, fp bigint, fp2 bigint, text string"), "passage-measured")
    sets = fixed(measured.select("key", "n", "fp", "fp2"), "passage-documents")
    # Texts of equal words are one node, under the number by which they are written once.
    met = measured.filter("text IS NOT NULL").groupBy("fp", "fp2").agg(F.min("text").alias("text"))
    texts_ = once.fixed(met.withColumn("node", F.monotonically_increasing_id()), "passage-texts")
    read.clear()
    nodes = fixed(texts_.select("node", "fp", "fp2"), "passage-nodes")
    members = steps.fixed(ranked(texts_.select("node", "text").mapInArrow(emit, "k bigint, node bigint"), once), "passage-members")
    long = sets.filter(F.col("n") >= length)
    # What travels with pairs is the text, which shrinks, unlike hashes of its words; these are made where they are needed.
    contents = steps.fixed(texts_.join(members.select("node").distinct(), "node", "left_semi").select("node", "text"), "passage-contents")
    once.clear()

    def verified(pairs: DataFrame) -> DataFrame:
        one = contents.select(F.col("node").alias("a"), F.col("text").alias("left"))
        two = contents.select(F.col("node").alias("b"), F.col("text").alias("right"))
        return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(
            check, f"a bigint, b bigint, left {_SPANS}, right {_SPANS}")

    def placed_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(docs: list[tuple[np.ndarray, list[dict]]]) -> pa.RecordBatch:
            flat = np.concatenate([t for t, _ in docs])
            last = np.cumsum([len(t) for t, _ in docs]) - 1
            first = np.concatenate([[0], last[:-1] + 1])
            wanted = [(w, i) for i, (_, ws) in enumerate(docs) for w in ws]
            keys = np.array([w["k"] for w, _ in wanted], np.int64).view(np.uint64)
            at, low, high = windows(flat, first, last, size, keys, np.array([i for _, i in wanted]))
            rows = list({(i, flat[l:h].tobytes()): None for i, l, h in zip(at.tolist(), low.tolist(), high.tolist())})
            names = [f.name for f in group]
            return pa.RecordBatch.from_arrays([*[pa.array([wanted[i][0][n] for i, _ in rows], f.type) for n, f in zip(names, group)],
                                               pa.array([x for _, x in rows], pa.binary())], names=[*names, "cover"])

        group = [pa.field(n, pa.int64()) for n in ("k", "node", "c", "alone", "block", "blocks")]
        hasher, docs, total = Hasher(), [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                docs.append((shingles(hasher.text(batch.column(1)[i].as_py(), SPACED), words), batch.column(0)[i].as_py()))
                total += len(docs[-1][0])
                if total >= GROUP:
                    yield done(docs)
                    docs, total = [], 0
        if docs:
            yield done(docs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(parts: list[list]) -> tuple[np.ndarray, np.ndarray]:
            names, labels_, alone, blocks = (np.concatenate(x) for x in list(zip(*parts))[:4])
            return similar_windows(names, labels_, alone > 0, blocks, [np.frombuffer(y, np.uint64) for x in parts for y in x[4]], size, similar)

        parts, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = [batch.column(i).to_numpy() for i in range(7)]
            covers, out = batch.column(7).to_pylist(), []
            change = (np.diff(table[0]) != 0) | (np.diff(table[1]) != 0) | (np.diff(table[2]) != 0)
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for start, stop in zip(edges, edges[1:]):
                mine = tuple(int(table[i][start]) for i in range(3))
                if mine != key and parts:
                    out.append(found(parts))
                    parts = []
                key = mine
                parts.append([*[table[i][start:stop] for i in range(3, 7)], covers[start:stop]])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["a", "b"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found(parts)], names=["a", "b"])

    # First each group's best-met member with the others.
    ends = F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")
    led = steps.fixed(members.filter("rank > 1").select("k", "node", "rank", *ends), "passage-led")
    first = fixed(verified(led.select("a", "b").distinct()), "passage-links")
    labels = components(first)

    # Then the members of groups in which some have no link with it.
    known = first.select("a", "b", F.lit(0).cast("bigint").alias("linked"))
    state = led.join(known, ["a", "b"], "left").select("k", "node", "rank", F.coalesce("linked", F.lit(1)).cast("bigint").alias("alone"))
    open_ = state.groupBy("k").agg(F.max("alone").alias("any"), F.max("rank").alias("size")).filter("any > 0 AND size > 2")
    block = lambda rank: F.floor((rank - 2) / BLOCK).cast("bigint")
    rows = state.join(open_.select("k", block(F.col("size")).alias("blocks")), "k").join(labels, "node", "left")
    wanted = rows.groupBy("node").agg(F.collect_list(F.struct(
        "k", "node", F.coalesce("component", "node").alias("c"), "alone", block(F.col("rank")).alias("block"), "blocks")).alias("wanted"))
    covers = wanted.join(contents, "node").select("wanted", "text").mapInArrow(
        placed_windows, "k bigint, node bigint, c bigint, alone bigint, block bigint, blocks bigint, cover binary")
    covers = covers.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "blocks"))).select(
        "k", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "c", "alone", "block", "cover")
    dealt = covers.repartition("k", "low", "high").sortWithinPartitions("k", "low", "high")
    more = steps.fixed(dealt.mapInArrow(compare, "a bigint, b bigint").distinct().join(known, ["a", "b"], "left_anti"), "passage-more")
    links = first.unionAll(fixed(verified(more), "passage-links"))
    labels = components(links)
    steps.clear()
    sides = links.select(F.col("a").alias("node"), F.col("left").alias("spans")).unionAll(
        links.select(F.col("b").alias("node"), F.col("right").alias("spans")))
    # A text linked with very many others has as many rows of the same few spans.
    found = sides.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"), F.flatten(F.collect_set("spans")).alias("spans"))
    named = nodes.join(labels, "node", "left").join(found, "node", "left").withColumn("c", F.coalesce("component", "node"))
    copies = long.groupBy("fp", "fp2").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"), F.min("n").alias("size"))
    texts = copies.join(named, ["fp", "fp2"])
    least = texts.groupBy("c").agg(F.min("least").alias("class_id"))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("size").alias("stop")))
    texts = salted_join(texts, least, ["c"]).select(
        "fp", "fp2", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("copies") > 1, whole).otherwise(merged(F.coalesce("spans", F.array().cast(_SPANS)))).alias("spans"))
    placed = salted_join(long.select("key", "n", "fp", "fp2"), texts, ["fp", "fp2"]).select("key", "n", "class_id", "n_links", "spans")
    none = F.array().cast(_SPANS)
    short = sets.filter(F.col("n") < length).select("key", "n", F.col("key").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"),
                                                     none.alias("spans"))
    total = F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["stop"] - s["start"])
    return placed.unionAll(short).select(F.col("key").alias(key), F.col("n").alias("n_words"), "class_id", "n_links",
                                         total.alias("n_repeated"), "spans")


def merged(spans_: object) -> object:
    """Sorted spans that do not overlap, from spans in any order."""
    zero = F.struct(F.array().cast(_SPANS).alias("done"), F.lit(-1).cast("bigint").alias("a"), F.lit(-1).cast("bigint").alias("b"))
    closed = lambda t: F.when(t["a"] >= 0, F.concat(t["done"], F.array(F.struct(t["a"].alias("start"), t["b"].alias("stop"))))).otherwise(t["done"])
    step = lambda t, s: F.when(s["start"] <= t["b"], F.struct(t["done"], t["a"], F.greatest(t["b"], s["stop"]).alias("b"))).otherwise(
        F.struct(closed(t).alias("done"), s["start"].alias("a"), s["stop"].alias("b")))
    return F.aggregate(F.array_sort(spans_), zero, step, closed)
