"""Fuzzy passages that documents share, by collinear chaining of k-mer seeds.

Seeds are winnowed hashes of K words: of any WINDOW neighbouring ones the smallest is taken,
so a run of K + WINDOW - 1 equal words has a seed in both texts. Texts are joined on pairs of
seeds, each with the first one DISTANCE words on: a shared phrase of less than DISTANCE + K
words makes no rows, however many texts have it, and a passage of LEAST equal words surely
has common pairs. Of joined texts, all common seeds are chained in order, with gap costs,
through a Fenwick tree of best scores; chains are aligned word by word between their seeds,
cut where the edits are too many for one passage, and extended at both ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.llm.cells import blocks_of, dealt, whole_cells
from veilwork.llm.textbytes import Words, as_texts, chunks, grams, mix
from veilwork.session import materialize

K, WINDOW = 4, 3
DISTANCE = 20  # words from one seed of a pair to the other
LEAST = 50  # words of a passage
EDITS = 0.2  # edits, as a part of its length
CELL = 1 << 9  # texts of a block of a key
LOW = 20  # bits of the name that keys are sorted by, in place of their own lowest ones
ALIKE = 40  # words that a passage has in common, at least: LEAST less its edits
GAP = 0.02  # cost of a skipped word on either side; a seed is worth 1
PART = 1 << 19  # bytes of text per numpy step
REMEMBERED = 1 << 18
MATCHES = 1 << 10  # pairs of places of one seed in two texts; beyond, they are paired in order
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_RUN = np.uint64(0x52554E)


def name_of(hashes: np.ndarray) -> int:
    """A 64-bit fingerprint of a sequence of words."""
    place = mix(np.arange(1, len(hashes) + 1, dtype=np.uint64))
    total = mix(hashes ^ place).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(hashes))
    return int(mix(total).view(np.int64)[0])


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of `width` neighbours, from each that has them all."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


def winnowed(owner: np.ndarray, at: np.ndarray, values: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Numbers of the values that are smallest among `width` neighbouring places of their owner.

    `at` rises over all owners; a window holds at least one value, and at an owner's ends is cut off.
    """
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    # Gaps between owners keep windows apart.
    at = at + (owner + 1) * width
    line = np.full(int(at[-1]) + width + 1, _TOP)
    line[at] = values
    least = _sliding(line, width, np.minimum)
    most = _sliding(np.concatenate([np.zeros(width - 1, np.uint64), least]), width, np.maximum)
    return np.flatnonzero(line[at] == most[at])


def seeds(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in words, hash) of the seeds of all texts."""
    owner = words.owner()
    hashes = grams(words.hashes, K)
    inside = np.flatnonzero(owner[: len(hashes)] == owner[K - 1 :][: len(hashes)])
    chosen = inside[winnowed(owner[inside], inside, hashes[inside])]
    return owner[chosen], chosen - words.first[owner[chosen]], hashes[chosen]


def seed_pairs(text: np.ndarray, place: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of each seed with the first one at least DISTANCE words on; see `placed_pairs`."""
    return placed_pairs(text, place, value)[:2]


def placed_pairs(text: np.ndarray, place: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, place) of each seed with the first one at least DISTANCE words on.

    Within a run of one word, seeds are all alike. Of a run of less than LEAST words, a passage
    holds a neighbour as well, so such a run is paired with its neighbours instead of itself.
    """
    where = (text.astype(np.int64) << 32) + place
    starts = np.ones(len(where), dtype=bool)
    starts[1:] = (value[1:] != value[:-1]) | (where[1:] != where[:-1] + 1)
    first = np.flatnonzero(starts)
    run = np.cumsum(starts) - 1
    size = np.diff(np.append(first, len(where))) + K - 1  # words
    other = np.searchsorted(where, where + DISTANCE)
    there = np.flatnonzero(np.append(text, -1)[other] == text)
    there = there[(run[there] != run[other[there]]) | (size[run[there]] >= LEAST)]
    return text[there], mix(mix(value[there]) * _ODD + value[other[there]]), place[there]


def run_pairs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, place) of runs of a word, DISTANCE + K at least, with the word before and the word after."""
    hashes, owner = words.hashes, words.owner()
    starts = np.ones(len(hashes), dtype=bool)
    starts[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(starts)
    end = np.append(first[1:], len(hashes))
    long = end - first >= DISTANCE + K
    before = first[long & (first > words.first[owner[first]])]
    after = end[long & (end < words.first[owner[first] + 1])]
    key = np.concatenate([
        mix(mix(hashes[before] ^ _RUN) * _ODD + hashes[before - 1]),
        mix(mix(hashes[after - 1] ^ ~_RUN) * _ODD + hashes[after]),
    ])
    at = np.concatenate([before - 1, after + 1 - DISTANCE - K])
    return owner[at], key, at - words.first[owner[at]]


def _known(docs: DataFrame, kind: str) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=PART):
                words = Words(as_texts(part.column(1)))
                names = [
                    name_of(words.hashes[a:z])
                    for a, z in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(names, pa.int64()), pa.array(words.counts(), pa.int64())],
                    ["doc_id", "row", "name", "n"],
                )

    return docs.mapInArrow(build, f"doc_id {kind}, row long, name long, n long")


def _keys(docs: DataFrame) -> DataFrame:
    """(key, name, place): the seed pairs of every text that can hold a passage."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in chunks(batch, most=PART):
                words = Words(as_texts(part.column(1)))
                pairs = zip(placed_pairs(*seeds(words)), run_pairs(words), strict=True)
                text, keys, place = (np.concatenate(both) for both in pairs)
                names = np.zeros(len(part), dtype=np.int64)
                fresh = np.zeros(len(part), dtype=bool)
                for i, n in enumerate(words.counts().tolist()):
                    if n < LEAST:
                        continue
                    name = name_of(words.hashes[words.first[i] : words.first[i + 1]])
                    if name not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(name)
                        names[i], fresh[i] = name, True
                keep = fresh[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[keep].view(np.int64)), pa.array(names[text[keep]]), pa.array(place[keep].astype(np.int32))],
                    ["key", "name", "place"],
                )

    return docs.mapInArrow(build, "key long, name long, place int")


def _ordered(keys: DataFrame) -> DataFrame:
    """Rows of a key in one partition, sorted by the upper bits of the key and the lower ones of the name.

    One number sorts several times faster than three columns.
    """
    low = F.lit((1 << LOW) - 1)
    order = F.col("key").bitwiseAND(F.bitwise_not(low)).bitwiseOR(F.col("name").bitwiseAND(low))
    return keys.repartition("key").sortWithinPartitions(order)


def _meetings(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Rows as `_ordered` -> the row of the first place of each (key, name) of keys with two names or more.

    Rows stream by. Held are those with the last one's upper bits, about `most` at most: beyond,
    what has met is sent, and its keys are remembered.
    """

    def sent(rows: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """Rows in order of key, name and place, the first of each key and name; whether the key has met."""
        order = np.lexsort(rows[::-1])
        key, name, _ = rows = [r[order] for r in rows]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        key, name, _ = rows = [r[new] for r in rows]
        send = np.isin(key, met)
        send[1:] |= key[1:] == key[:-1]
        send[:-1] |= key[1:] == key[:-1]
        return rows, send

    def written(rows: list[np.ndarray], send: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(r[send]) for r in rows], ["key", "name", "place"])

    low = (1 << LOW) - 1
    met = np.zeros(0, dtype=np.int64)
    held = [met, met, met.astype(np.int32)]
    for batch in batches:
        rows = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True)]
        upper = rows[0] >> LOW
        if not len(upper):
            continue
        cut = int(upper.searchsorted(upper[-1]))
        # A key alone with its upper bits has met nothing, unless before.
        same = upper[1:cut] == upper[: max(0, cut - 1)]
        near = np.zeros(cut, dtype=bool)
        near[1:] |= same
        near[:-1] |= same
        if len(met):
            near |= upper[:cut] == met[0] >> LOW
        if near.any():
            yield written(*sent([r[:cut][near] for r in rows]))
        if cut:
            met = met[:0]
        held = [r[cut:] for r in rows]
        if len(held[0]) > most:
            last = (held[1] & low) == (held[1][-1] & low)
            rest, send = sent([r[~last] for r in held])
            yield written(rest, send)
            met = np.union1d(met, rest[0][send])
            held = [np.concatenate([r[~send], h[last]]) for r, h in zip(rest, held, strict=True)]
    if len(held[0]):
        yield written(*sent(held))


def pair_places(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the places of a seed in two texts: all, if they are at most MATCHES; else in
    order, counted from the first and from the last place, so that repeats stay collinear."""
    if len(p) * len(q) <= MATCHES:
        return np.repeat(p, len(q)), np.tile(q, len(p))
    n = min(len(p), len(q))
    if len(p) == len(q):
        return p, q
    return np.concatenate([p[:n], p[-n:]]), np.concatenate([q[:n], q[-n:]])


@lru_cache(maxsize=256)
def _own_seeds(words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, hashes, bounds, places) of one text: hash i is at places[bounds[i]:bounds[i + 1]]."""
    x = np.frombuffer(words, dtype=np.uint32)
    hashes = grams(x.astype(np.uint64), K)
    place = winnowed(np.zeros(len(hashes), dtype=np.int64), np.arange(len(hashes)), hashes)
    order = np.lexsort((place, hashes[place]))
    sorted_hashes = hashes[place][order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
    return x, sorted_hashes[first], np.append(np.flatnonzero(first), len(order)), place[order]


def matches(x: bytes, y: bytes) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the seeds that two texts have in common, sorted by both, and whether these are all."""
    _, in_x, bounds_x, at_x = _own_seeds(x)
    _, in_y, bounds_y, at_y = _own_seeds(y)
    if not len(in_x) or not len(in_y):
        return at_x[:0], at_y[:0], True
    there = np.minimum(in_x.searchsorted(in_y), len(in_x) - 1)
    in_both = in_x[there] == in_y
    i, j = there[in_both], np.flatnonzero(in_both)
    left, right = (bounds_x[i], bounds_x[i + 1]), (bounds_y[j], bounds_y[j + 1])
    once = (left[1] - left[0] == 1) & (right[1] - right[0] == 1)
    p, q = [at_x[left[0][once]]], [at_y[right[0][once]]]
    whole = bool(((left[1] - left[0]) * (right[1] - right[0]) <= MATCHES).all())
    for i in np.flatnonzero(~once).tolist():
        u, v = pair_places(at_x[left[0][i] : left[1][i]], at_y[right[0][i] : right[1][i]])
        p.append(u)
        q.append(v)
    p, q = np.concatenate(p), np.concatenate(q)
    order = np.lexsort((q, p))
    return p[order], q[order], whole


def chain(at_b: np.ndarray, at_a: np.ndarray) -> list[np.ndarray]:
    """Best chains of matches (numbers of rows), rising strictly on both sides.

    A chain scores 1 per match less GAP per word between matches, on both sides. The best
    score with a smaller place in a, plus what gaps have cost up to there, is the maximum of
    a prefix: the Fenwick tree holds it by rank of at_a. Rows are sorted by at_b.
    """
    gap_b, gap_a = np.diff(at_b), np.diff(at_a)
    if (gap_b > 0).all() and (gap_a > 0).all() and (GAP * (gap_b + gap_a) < 1).all():
        return [np.arange(len(at_b))]
    rank = np.unique(at_a, return_inverse=True)[1] + 1
    size = int(rank.max())
    tree = [(-1.0, -1)] * (size + 1)
    score, previous = [0.0] * len(at_b), [-1] * len(at_b)
    ranks, bs, costs, n = rank.tolist(), at_b.tolist(), (GAP * (at_b + at_a)).tolist(), len(at_b)
    i = 0
    while i < n:
        j, here_b = i, bs[i]
        while j < n and bs[j] == here_b:
            best, r = (-1.0, -1), ranks[j] - 1
            while r > 0:
                if tree[r] > best:
                    best = tree[r]
                r -= r & -r
            score[j], here = 1.0, costs[j]
            if best[1] >= 0 and best[0] - here > 0:
                score[j], previous[j] = 1.0 + best[0] - here, best[1]
            j += 1
        for x in range(i, j):
            entry, r = (score[x] + costs[x], x), ranks[x]
            while r <= size:
                if entry > tree[r]:
                    tree[r] = entry
                r += r & -r
        i = j
    used, out = [False] * n, []
    for end in np.argsort(-np.array(score), kind="stable").tolist():
        if used[end]:
            continue
        path, x = [], end
        while x >= 0 and not used[x]:
            path.append(x)
            used[x] = True
            x = previous[x]
        if len(path) > 1:
            out.append(np.array(path[::-1]))
    return out


@lru_cache(maxsize=256)
def _own_words(words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, counts, places) of the words of one text; word i is values[places[i]]."""
    values, places, counts = np.unique(np.frombuffer(words, dtype=np.uint32), return_inverse=True, return_counts=True)
    return values, counts, places


def _dense(known: np.ndarray, part: int) -> bool:
    """Whether LEAST words or more in a row have at most one unknown one in `part`."""
    gain = np.zeros(len(known) + 1, dtype=np.int64)
    np.cumsum(part * known.astype(np.int64) - (part - 1), out=gain[1:])
    return len(known) >= LEAST and bool((gain[LEAST:] >= np.minimum.accumulate(gain[: len(gain) - LEAST])).any())


def may_share(x: bytes, y: bytes) -> bool:
    """False for some texts without a passage, by their words alone.

    All words of a passage but its edits are in the other text as well, as often: ALIKE words
    at least, and four of five, on the other side three of four.
    """
    in_x, times_x, at_x = _own_words(x)
    in_y, times_y, at_y = _own_words(y)
    if len(at_x) < LEAST or len(at_y) < LEAST:
        return False
    there = np.minimum(in_x.searchsorted(in_y), len(in_x) - 1)
    both = in_x[there] == in_y
    there = there[both]
    if np.minimum(times_x[there], times_y[both]).sum() < ALIKE:
        return False
    of_x = np.zeros(len(in_x), dtype=bool)
    of_x[there] = True
    return _dense(of_x[at_x], 5) and _dense(both[at_y], 4)


def passages_of(x: bytes, y: bytes) -> list[tuple[int, int, int, int, int]]:
    """(first_x, end_x, first_y, end_y, edits) of the passages that two texts share."""
    if not may_share(x, y):
        return []
    at_x, at_y, whole = matches(x, y)
    out = set()
    if len(at_x) and at_x[-1] - at_x[0] + K >= LEAST // 2:
        for path in chain(at_x, at_y):
            if at_x[path[-1]] - at_x[path[0]] + K >= LEAST // 2:
                out |= set(align(_own_seeds(x)[0], _own_seeds(y)[0], at_x[path], at_y[path]))
    if not whole:
        out |= equal_runs(x, y, out)
    return sorted(out)


@lru_cache(maxsize=64)
def _windows(words: bytes) -> np.ndarray:
    """Hashes of LEAST words, for each first word that has them all."""
    have, out = 1, np.frombuffer(words, dtype=np.uint32).astype(np.uint64)
    while have < LEAST:
        step = min(have, LEAST - have)
        out = mix(mix(out[:-step]) * _ODD + out[step:])
        have += step
    return out


def equal_runs(words_x: bytes, words_y: bytes, known: set) -> set[tuple[int, int, int, int, int]]:
    """Passages for the runs of LEAST words that two texts have in common and no known passage holds."""
    in_x, in_y = _windows(words_x), _windows(words_y)
    x, y = _own_seeds(words_x)[0], _own_seeds(words_y)[0]
    both, at_x, at_y = np.intersect1d(in_x, in_y, return_indices=True)
    if not len(both):
        return set()
    left = np.ones(len(both), dtype=bool)

    def hold(passage: tuple[int, int, int, int, int]) -> None:
        first_x, end_x, first_y, end_y, _ = passage
        for held in (in_x[first_x : end_x - LEAST + 1], in_y[first_y : end_y - LEAST + 1]):
            there = np.minimum(both.searchsorted(held), len(both) - 1)
            left[there[both[there] == held]] = False

    for passage in known:
        hold(passage)
    out = set()
    for i in np.argsort(at_x).tolist():
        if left[i]:
            for passage in align(x, y, at_x[i] + np.array([0, LEAST - K]), at_y[i] + np.array([0, LEAST - K])):
                out.add(passage)
                hold(passage)
    return out


def gap_edits(x: np.ndarray, y: np.ndarray) -> int:
    """Word edits between two short pieces; of equal length, substitutions alone."""
    if len(x) == len(y):
        return int((x != y).sum())
    if not len(x) or not len(y):
        return max(len(x), len(y))
    steps = np.arange(len(y) + 1)
    row = steps.copy()
    for i, word in enumerate(x):
        best = row + 1
        best[1:] = np.minimum(best[1:], row[:-1] + (y != word))
        best[0] = i + 1
        row = np.minimum.accumulate(best - steps) + steps
    return int(row[-1])


def extend(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """(words, edits) by which two texts go on alike: single other words are passed over
    where at least K equal words follow."""
    n = min(len(x), len(y))
    return _extent((x[:n] != y[:n]).nonzero()[0].tolist(), n)


def _extent(unlike: list[int], n: int) -> tuple[int, int]:
    """`extend` over n words, given the places of the unlike ones."""
    bounds = [*unlike, n]
    for edits, at in enumerate(bounds):
        if at == n:
            return n, edits
        if bounds[edits + 1] - at - 1 < K:
            return at, edits
    return n, len(bounds) - 1


def align(x: np.ndarray, y: np.ndarray, at_x: np.ndarray, at_y: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(first_x, end_x, first_y, end_y, edits) of the passages of a chain.

    The part of a chain with the most words in common is a passage, if its edits are within the
    bound; so what hangs on by a costly gap is left out. Otherwise the longest part within the
    bound is one. What lies before and after is treated in the same way. Each part is extended
    at both ends, into the gaps next to it.
    """
    n = len(at_x)
    back, more, on, yet, edits = (np.zeros(n, dtype=np.int64) for _ in range(5))
    back[0], more[0] = extend(x[: at_x[0]][::-1], y[: at_y[0]][::-1])
    on[-1], yet[-1] = extend(x[at_x[-1] + K :], y[at_y[-1] + K :])
    if at_x[-1] + K + on[-1] - at_x[0] + back[0] < LEAST:
        return []
    bent = np.flatnonzero((np.diff(at_x) != np.diff(at_y)) | (np.diff(at_x) > K))
    for i in bent.tolist():
        # From the end of the seed, or where the next one begins if they overlap.
        skip = min(K, int(at_x[i + 1] - at_x[i]), int(at_y[i + 1] - at_y[i]))
        u, v = x[at_x[i] + skip : at_x[i + 1]], y[at_y[i] + skip : at_y[i + 1]]
        if len(u) == len(v):
            unlike = (u != v).nonzero()[0].tolist()
            edits[i + 1] = len(unlike)
            if unlike and skip == K:
                on[i], yet[i] = _extent(unlike, len(u))
                back[i + 1], more[i + 1] = _extent([len(u) - 1 - place for place in unlike[::-1]], len(u))
            continue
        if abs(len(u) - len(v)) > EDITS * len(x):  # no passage of this text affords it
            edits[i + 1] = max(len(u), len(v))
        else:
            edits[i + 1] = gap_edits(u, v)
        if edits[i + 1] and skip == K:
            on[i], yet[i] = extend(u, v)
            back[i + 1], more[i + 1] = extend(u[::-1], v[::-1])
    spent = np.cumsum(edits)
    first, end = at_x - back, at_x + K + on
    # Seeds i to j are a passage if they have room left: enough[j] >= needed[i].
    needed = EDITS * first - spent + more
    enough = EDITS * end - spent - yet + 1e-9
    # Words of both sides, halved, less edits.
    opens = (first + at_y - back) / 2 - spent + more
    closes = (end + at_y + K + on) / 2 - spent - yet
    out, parts = [], [(0, n)]
    while parts:
        a, z = parts.pop()
        if a >= z or end[z - 1] - first[a] < LEAST:
            continue
        i = a + int(np.argmax(np.maximum.accumulate(closes[a:z][::-1])[::-1] - opens[a:z]))
        j = i + int(np.argmax(closes[i:z]))
        if enough[j] < needed[i] or end[j] - first[i] < LEAST:
            most = np.maximum.accumulate(enough[a:z][::-1])[::-1]
            last = a + np.searchsorted(-most, -needed[a:z], side="right") - 1
            i = a + int(np.argmax(end[last] - first[a:z]))
            j = int(last[i - a])
        if end[j] - first[i] < LEAST:
            continue
        fy, ey = int(at_y[i] - back[i]), int(at_y[j] + K + on[j])
        if ey - fy >= LEAST:
            out.append((int(first[i]), int(end[j]), fy, ey, int(spent[j] - spent[i] + more[i] + yet[j])))
        parts += [(a, i), (j + 1, z)]
    return sorted(out)


def _spelled(rows: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(name, words) of the texts of the pairs (u, v)."""
    needed = pairs.select(F.explode(F.array("u", "v")).alias("name")).distinct()
    wanted = classes.join(needed, "name", "left_semi").select("row")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=PART):
                words = Words(as_texts(part.column(1)))
                own = [words.hashes[s:e] for s, e in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name_of(w) for w in own], pa.int64()),
                        pa.array([(w >> np.uint64(32)).astype(np.uint32).tobytes() for w in own], pa.binary()),
                    ],
                    ["name", "words"],
                )

    chosen = rows.join(wanted, "row", "left_semi").select("doc_id", "text")
    return materialize(chosen.mapInArrow(spell, "name long, words binary").dropDuplicates(["name"]), "words")


def _passages(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(b, a, first_word, end_word, match_first, match_end, edits), a < b, of the pairs (u, v) of texts.

    A task gets the pairs of a text v together.
    """
    sides = pairs.join(texts.select(F.col("name").alias("u"), F.col("words").alias("of_u")), "u").join(
        texts.select(F.col("name").alias("v"), F.col("words").alias("of_v")), "v"
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(len(batch)):
                u, v, of_u, of_v = (c[i].as_py() for c in batch.columns)
                b, a, of_b, of_a = (u, v, of_u, of_v) if u > v else (v, u, of_v, of_u)
                out += [(b, a, *p) for p in passages_of(of_b, of_a)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 7, MEASURED.types, strict=True)],
                MEASURED.names,
            )

    passages = sides.select("u", "v", "of_u", "of_v").mapInArrow(
        measure, "b long, a long, first_word int, end_word int, match_first int, match_end int, edits int"
    )
    return materialize(passages, "passages")


def _members(met: DataFrame) -> DataFrame:
    """(key, name, place, centre, at) of the texts of a key but its centre, which has the key's place `at`.

    The centre is the text whose keys are shared most in all.
    """
    sizes = met.groupBy("key").agg(F.count(F.lit(1)).alias("size")).hint("rebalance")
    shared = met.join(sizes, "key").groupBy("name").agg(F.sum("size").alias("shared"))
    # Both are of the same row, as both take the same one of equals.
    first = F.max_by("name", "shared").alias("centre"), F.max_by("place", "shared").alias("at")
    centres = met.join(shared, "name").groupBy("key").agg(*first).hint("rebalance")
    return met.join(centres, "key").where("name <> centre")


def _with_centres(members: DataFrame) -> DataFrame:
    """Each text with the centres of its keys: (a, b, u, v), a pair once, v being a centre."""
    pairs = members.groupBy(F.least("name", "centre").alias("a"), F.greatest("name", "centre").alias("b"))
    other = F.when(F.col("v") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    return pairs.agg(F.max("centre").alias("v")).select("a", "b", other.alias("u"), "v")


class _Counts:
    """How often each text of a cell has what others have as well; text i is `owner` i of values."""

    def __init__(self, owner: np.ndarray, values: np.ndarray, texts: int):
        self.texts = texts
        order = np.lexsort((owner, values))
        owner, values = owner[order], values[order]
        other = np.ones(len(values), dtype=bool)
        other[1:] = values[1:] != values[:-1]
        first = other.copy()
        first[1:] |= owner[1:] != owner[:-1]
        at = np.flatnonzero(first)
        number = np.cumsum(other[at]) - 1
        shared = np.bincount(number)[number] > 1 if len(number) else other
        order = np.argsort(owner[at][shared], kind="stable")
        self.owner, self.number = owner[at][shared][order], number[shared][order]
        self.times = np.diff(np.append(at, len(values)))[shared][order]
        self.bounds = np.searchsorted(self.owner, np.arange(texts + 1))
        self.dense = np.zeros(int(number[-1]) + 1 if len(number) else 0, dtype=np.int64)

    def with_all(self, text: int, of) -> np.ndarray:
        """The sum of `of` the times of a text and those of each text, over all that they share."""
        own = slice(self.bounds[text], self.bounds[text + 1])
        self.dense[self.number[own]] = self.times[own]
        sums = np.bincount(self.owner, weights=of(self.dense[self.number], self.times), minlength=self.texts)
        self.dense[self.number[own]] = 0
        return sums.astype(np.int64)


def _around(words: np.ndarray, first: np.ndarray, place: np.ndarray) -> np.ndarray:
    """LEAST words before and LEAST words from a place of each text, -1 where there are none."""
    at = (first[:-1] + place)[:, None] + np.arange(-LEAST, LEAST)
    there = (at >= first[:-1, None]) & (at < first[1:, None])
    return np.where(there, words[np.where(there, at, 0)].astype(np.int64), -1)


def likely_pairs(texts: list[bytes], place: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (one of left, one of right) of the texts that may share a passage; no pair with a passage is left out.

    Left out are texts with less than ALIKE words in common, and those whose equal runs of K
    words all lie in one equal run, around their places, of less than LEAST words: seeds are
    such runs, and a passage goes on beyond an unequal word only where one follows.
    """
    size = np.array([len(t) // 4 for t in texts])
    first = np.concatenate([[0], np.cumsum(size)])
    words = np.frombuffer(b"".join(texts), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), size)
    hashes = grams(words.astype(np.uint64), K)
    inside = np.flatnonzero(owner[: len(hashes)] == owner[K - 1 :][: len(hashes)])
    alike, runs = _Counts(owner, words, len(texts)), _Counts(owner[inside], hashes[inside], len(texts))
    around = _around(words, first, place)
    found = []
    for i in left.tolist():
        other = right[right != i]
        equal = (around[other] == around[i]) & (around[i] >= 0)
        run = np.logical_and.accumulate(equal[:, LEAST:], axis=1).sum(axis=1)
        run += np.logical_and.accumulate(equal[:, LEAST - 1 :: -1], axis=1).sum(axis=1)
        one_run = (run < LEAST) & (runs.with_all(i, np.multiply)[other] <= np.maximum(run - K + 1, 0))
        may = ~one_run & (alike.with_all(i, np.minimum)[other] >= ALIKE)
        found.append((np.full(int(may.sum()), i), other[may]))
    return tuple(np.concatenate([left[:0], *[pair[side] for pair in found]]) for side in (0, 1))


def _rest(loose: DataFrame, met: DataFrame, stars: DataFrame, texts: DataFrame) -> DataFrame:
    """Loose members with the texts of their keys, as (u, v), a pair once; without pairs of `stars`, and those
    that surely share no passage. Keys with the same texts are one, and many texts are cut in cells."""
    keys = loose.select("key").distinct()
    marked = loose.select("key", "name", F.lit(True).alias("loose")).distinct()
    group = met.join(keys, "key", "left_semi").join(marked, ["key", "name"], "left").withColumn("loose", F.coalesce("loose", F.lit(False)))
    group = materialize(group, "groups")
    prints = [F.bit_xor(F.xxhash64(F.lit(i), "name", "loose")).alias(f"print{i}") for i in (1, 2)]
    sizes = group.groupBy("key").agg(F.count(F.lit(1)).alias("size"), *prints)
    one = sizes.groupBy("size", "print1", "print2").agg(F.min("key").alias("key"))
    one = one.select("key", blocks_of(F.col("size"), CELL).alias("blocks")).hint("rebalance")
    group = group.join(one, "key").join(texts, "name").select("key", "blocks", "name", "place", "loose", "words")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_cells(batches):
            alone, first, name, place, loose = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(2, 7))
            for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                row = np.arange(z - a)
                if alone[a]:
                    sides = [(row[loose[a:z]], row)]
                else:
                    one, other = row[first[a:z]], row[~first[a:z]]
                    sides = [(x[loose[a:z][x]], y) for x, y in ((one, other), (other, one))]
                if not any(len(x) and len(y) for x, y in sides):
                    continue
                texts = rows.column(7).slice(a, z - a).to_pylist()
                for x, y in sides:
                    u, v = likely_pairs(texts, place[a:z], x, y)
                    yield pa.RecordBatch.from_arrays([pa.array(name[a:z][u]), pa.array(name[a:z][v])], ["x", "y"])

    pairs = dealt(group, "key", "name", "blocks").mapInArrow(sift, "x long, y long")
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return pairs.join(stars, ["a", "b"], "left_anti").select(F.col("b").alias("u"), F.col("a").alias("v"))


def _loose(members: DataFrame, passages: DataFrame) -> DataFrame:
    """The members whose key does not lie in a passage that they share with its centre."""
    spans = passages.selectExpr("b AS n", "a AS c", "first_word AS n1", "end_word AS n2", "match_first AS c1", "match_end AS c2")
    spans = spans.union(passages.selectExpr("a", "b", "match_first", "match_end", "first_word", "end_word"))
    width = DISTANCE + K
    inside = (F.col("n1") <= F.col("place")) & (F.col("place") + width <= F.col("n2"))
    inside &= (F.col("c1") <= F.col("at")) & (F.col("at") + width <= F.col("c2"))
    return members.join(spans, (F.col("name") == F.col("n")) & (F.col("centre") == F.col("c")) & inside, "left_anti")


def shared_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of at least 50 words that a document shares with another one.

    Returns (doc_id, match_id, first_word, end_word, match_first, match_end, edits), words
    counted from 0, ends not included; edits are at most a fifth of the passage's words.
    Passages of 50 equal words are surely found. Of edited ones, some share no pair of seeds:
    with 10, 15 and 20 % of the words replaced at random, 95, 93 and 67 % of passages of 60
    words are found, and of 100 words and more all of 100 draws but one.
    Words are split at white space and compared with A-Z lower-cased.

    Documents with the same words are a class; its smallest doc_id stands for it in
    passages, and every other row of the class gets one row: the whole text, matched with
    that id. Between classes, passages have classes as well: of the texts of a seed pair, one is
    the centre, and each other text is compared with it. A text whose passage with the centre
    covers the seed pair is a member of the centre's passage; any other one is compared with
    all texts of the seed pair. So of two texts that share a seed pair, either the two were
    compared and all their passages have rows, or both are the centre's or its members there:
    each has a row with the centre that covers the seed pair, at its first place in the text. So
    a passage in n documents gives rows in proportion to n. What is compared in full are the
    texts that share DISTANCE + K words, but no passage.

    A passage may repeat its own words: all places of a seed in one text meet those in the other,
    or, if these are over MATCHES pairs, in order from both ends; then, runs of LEAST equal words that
    no passage found holds are looked up as well, at their first places. What one text alone
    repeats is not looked for.

    Null, empty and short texts have no passages. A null id is matched, and written, as
    null. A row repeated with its id is the same document. No rows give no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    known = materialize(_known(rows, kind).where(F.col("n") >= LEAST), "texts")
    classes = known.groupBy("name").agg(F.min("doc_id").alias("id"), F.min("row").alias("row"))

    met = materialize(_ordered(_keys(rows)).mapInArrow(_meetings, "key long, name long, place int"), "seed-pairs")
    members = materialize(_members(met), "members")
    stars = materialize(_with_centres(members), "stars")
    texts = _spelled(rows, classes, stars)  # each text of a key is its centre or has one
    passages = _passages(texts, stars.select("u", "v"))
    loose = materialize(_loose(members, passages), "loose")
    rest = materialize(_rest(loose, met, stars, texts), "pairs")
    if not rest.isEmpty():
        passages = passages.unionByName(_passages(texts, rest))

    ids = materialize(classes.select("name", "id"), "classes")
    named = passages.join(ids.select(F.col("name").alias("b"), F.col("id").alias("doc_id")), "b").join(
        ids.select(F.col("name").alias("a"), F.col("id").alias("match_id")), "a"
    )
    named = named.select("doc_id", "match_id", "first_word", "end_word", "match_first", "match_end", "edits").distinct()
    copies = (
        known.join(ids, "name")
        .where(~F.col("doc_id").eqNullSafe(F.col("id")))
        .select(
            "doc_id", F.col("id").alias("match_id"), F.lit(0).alias("first_word"), F.col("n").cast("int").alias("end_word"),
            F.lit(0).alias("match_first"), F.col("n").cast("int").alias("match_end"), F.lit(0).alias("edits"),
        )
    )
    return named.unionByName(copies)


def both_sides(passages: DataFrame) -> DataFrame:
    """Each passage as a row of either document, so that every document with a passage has rows of its own."""
    sides = [("doc_id", "match_id"), ("first_word", "match_first"), ("end_word", "match_end")]
    other = dict(sides) | {b: a for a, b in sides}
    mirrored = F.struct(*[F.col(other.get(c, c)).alias(c) for c in passages.columns])
    return passages.select(F.inline(F.array_distinct(F.array(F.struct(*passages.columns), mirrored))))


MEASURED = pa.schema(
    [("b", pa.int64()), ("a", pa.int64()), ("first_word", pa.int32()), ("end_word", pa.int32()),
     ("match_first", pa.int32()), ("match_end", pa.int32()), ("edits", pa.int32())]
)
