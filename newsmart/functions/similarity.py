"""Title similarity inside one task: exact ratios behind cheap exact upper bounds.

The ratio is ``2 * matched / (len a + len b)``. Four bounds never under-estimate ``matched``: the
shorter length, the shared character counts, the shared strings of four characters with the number of
matching blocks (long titles), and the longest common subsequence. A pair that fails a bound cannot
reach the threshold, so skipping it changes nothing.

Counts are compared for many primaries and titles at once, as products of matrices. Subsequences are first taken without the
most frequent characters, all of which count as matched: that is a fraction of the work and decides most pairs.

The block bound: in a second title of ``_LONG`` characters and more a match only begins at a character that is rare there, or
at the very start of a range without such a match. With r shared rare characters there are thus 2 r + 1 blocks at most, and
a block of k characters holds k - 3 strings of four.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np

_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789 "
_OTHER = len(_ALPHABET)
_PAD = _OTHER + 1
_CODE_OF = np.full(256, _OTHER, dtype=np.uint8)
_CODE_OF[[ord(c) for c in _ALPHABET]] = np.arange(len(_ALPHABET))

# Titles of this length and more match by rare characters first (the popular-character rule of the exact ratio).
_LONG = 200
_GRAM = 4
_BUCKETS = 2048

# Bits of a word of places; one more takes the carry.
_BITS = 63
# Numbers of words that pairs are sorted by; longer primaries take the words they need.
_WORDS = np.array([0, 1, 2, 3, 4, 6, 8, 12, 16, 1 << 30])
# So many of the most frequent characters are left out of the first subsequences, which are the shorter for it.
_DROPPED = (6, 4, 0)
_TRIFLE = 0.01
# Rows of a tile of titles, and primaries of equal length or nearly so whose bounds are one product of matrices.
_TILE = 2048
_GROUP = 64

# From this many pairs for each word on, one vector step per character beats one Python integer step per pair.
_VECTOR_ROWS = 32
# Pairs of one vector step, and primaries whose pairs are gathered for it.
_PAIRS = 4096
_STEP = 512


def _codes(key: str) -> np.ndarray:
    return _CODE_OF[np.frombuffer(key.encode("latin-1", "replace"), np.uint8)]


def _spelled(codes: np.ndarray) -> np.ndarray:
    """The strings of ``_GRAM`` characters as numbers."""
    spelled = np.zeros(max(len(codes) - _GRAM + 1, 0), np.int64)
    for shift in range(_GRAM if len(spelled) else 0):
        spelled = spelled * (_PAD + 1) + codes[shift : shift + len(spelled)]
    return spelled


def _grams(spelled: np.ndarray) -> np.ndarray:
    """Counts of the strings in hashed buckets; two strings in one bucket only raise what is shared."""
    return np.bincount((spelled * 2654435761 >> 12) % _BUCKETS, minlength=_BUCKETS).astype(np.int16)


def _numbered(spelled: np.ndarray) -> np.ndarray:
    """The strings in order, equal ones told apart by a number: what two titles have in common is an intersection."""
    ordered = np.sort(spelled)
    place = np.arange(len(ordered))
    first = place.copy()
    first[1:][ordered[1:] == ordered[:-1]] = 0
    return (ordered << 32) + place - np.maximum.accumulate(first)


def _places(codes: np.ndarray) -> dict[int, int]:
    """Places of every character as bits of one integer."""
    places: dict[int, int] = {}
    for place, char in enumerate(codes.tolist()):
        places[char] = places.get(char, 0) | (1 << place)
    return places


def _common_subsequence(positions: dict, size: int, other: Sequence) -> int:
    """Length of the longest common subsequence, one big-integer step per character."""
    full = (1 << int(size)) - 1
    state = full
    for char in other:
        hit = state & positions.get(char, 0)
        state = ((state + hit) | (state - hit)) & full
    return int(size) - state.bit_count()


def _without(codes: np.ndarray, dropped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A padded matrix of character codes without some of them, and the lengths that are left."""
    kept = ~np.isin(np.arange(_PAD + 1), [*dropped, _PAD])[codes]
    lengths = kept.sum(axis=1)
    left = np.full((len(codes), lengths.max(initial=0)), _PAD, dtype=np.uint8)
    row, place = np.nonzero(kept)
    left[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = codes[row, place]
    return left, lengths


def _common_subsequences(primary: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The same for many titles at once; ``others`` is a padded matrix of character codes."""
    masks, sizes = _place_masks([primary])
    return _pair_subsequences(masks, sizes, np.zeros(len(others), np.int64), others)


def _place_masks(primaries: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of every character in each primary, as bits of words of ``_BITS``; and the sizes of the primaries."""
    sizes = np.fromiter(map(len, primaries), np.int64, len(primaries))
    masks = np.zeros((-(-int(sizes.max(initial=0)) // _BITS), len(primaries) * (_PAD + 1)), dtype=np.uint64)
    if len(masks):
        place = np.concatenate([np.arange(size) for size in sizes])
        entry = np.repeat(np.arange(len(primaries)) * (_PAD + 1), sizes) + np.concatenate(primaries)
        np.bitwise_or.at(masks, (place // _BITS, entry), np.uint64(1) << (place % _BITS).astype(np.uint64))
    return masks, sizes


def _pair_subsequences(masks: np.ndarray, sizes: np.ndarray, primary_of: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The same for many pairs: row n of ``others`` with the primary ``primary_of[n]``, one vector step per character.

    The highest bit of a word is kept free: it takes the carry into the next one.
    """
    low, free = np.uint64((1 << _BITS) - 1), np.uint64(_BITS)
    state = [np.full(len(others), low) for _ in masks]
    hit, added, carry = (np.empty(len(others), np.uint64) for _ in range(3))
    for at in np.ascontiguousarray(others.T) + primary_of * (_PAD + 1):
        for word, bits in enumerate(state):
            masks[word].take(at, out=hit, mode="clip")
            np.bitwise_and(hit, bits, out=hit)
            np.add(bits, hit, out=added)
            if word:
                np.add(added, carry, out=added)
            np.bitwise_xor(bits, hit, out=bits)
            np.bitwise_or(bits, added, out=bits)
            if word + 1 < len(state):
                np.right_shift(added, free, out=carry)
                np.bitwise_and(bits, low, out=bits)
    matched = np.zeros(len(others), np.int64)
    for word, bits in enumerate(state):
        used = np.clip(sizes[primary_of] - _BITS * word, 0, _BITS).astype(np.uint64)
        matched += np.bitwise_count(~bits & ((np.uint64(1) << used) - np.uint64(1))).astype(np.int64)
    return matched


class _Primaries:
    """Titles that those of a set are compared with, and all that the bounds need of them."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)
        self.codes = [_codes(key) for key in self.keys]
        self.sizes = np.fromiter(map(len, self.codes), np.int64, len(self.keys))
        self.counts = np.array([_counts(codes) for codes in self.codes], np.int32).reshape(-1, _OTHER + 1)
        spelled = [_spelled(codes) for codes in self.codes]
        self.grams = np.array([_grams(part) for part in spelled], np.int16).reshape(-1, _BUCKETS)
        self.numbered = [_numbered(part) for part in spelled]
        self.long_side = np.hstack([self.grams, self.counts]).clip(0, 1).astype(np.float32)


class _Tile:
    """Some rows of a set, with what bounds their matches with many primaries as products of matrices.

    For titles below ``_LONG`` that is the number of shared characters: each count is spelled in ones. For longer ones it is
    the block bound, taken a little higher: a string of four or a rare character of the title counts in full if the
    primary has it at all. All numbers are small integers, so the products are exact.
    """

    def __init__(self, titles: TitleSet, rows: np.ndarray):
        order = rows[np.argsort(titles.lengths[rows], kind="stable")]
        cut = np.searchsorted(titles.lengths[order], _LONG)
        self.rows, self.short, self.long = rows, order[:cut], order[cut:]
        self.caps = titles.counts[self.short].max(axis=0, initial=0)
        self.short_side = _in_ones(titles.counts[self.short], self.caps)
        grams, rare = titles.grams[titles.gram_row[self.long]], titles.rare_counts[self.long]
        self.long_side = np.hstack([grams, 2 * (_GRAM - 1) * rare]).astype(np.float32)

    def bounds(self, titles: TitleSet, given: _Primaries, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the primary, row) that the products leave."""
        order = np.argsort(given.sizes, kind="stable")
        order = order[given.sizes[order] > 0]
        numbers, found = [order[:0]], [order[:0]]
        for start in range(0, len(order), _GROUP):
            group = order[start : start + _GROUP]
            for rows, side in ((self.short, self.short_side), (self.long, self.long_side)):
                low, high = _window(titles.lengths[rows], *given.sizes[group[[0, -1]]], threshold)
                if low >= high:
                    continue
                if rows is self.short:
                    matched = _in_ones(given.counts[group], self.caps) @ side[low:high].T
                else:
                    matched = given.long_side[group] @ side[low:high].T + np.float32(_GRAM - 1)
                # Half the threshold for each character is needed; a trifle less is asked for, as these are short floats.
                needed = (threshold / 2 * given.sizes[group] - _TRIFLE).astype(np.float32)[:, None]
                matched -= (threshold / 2 * titles.lengths[rows[low:high]]).astype(np.float32)
                number, row = np.nonzero(matched >= needed)
                numbers.append(group[number])
                found.append(rows[low:high][row])
        return np.concatenate(numbers), np.concatenate(found)


def _counts(codes: np.ndarray) -> np.ndarray:
    return np.bincount(codes, minlength=_OTHER + 1)


def _in_ones(counts: np.ndarray, caps: np.ndarray) -> np.ndarray:
    """Rows of counts (up to ``caps``) spelled in ones, so that the product of two rows is what both have in common."""
    level = np.concatenate([np.arange(cap) for cap in caps])
    return (counts[:, np.repeat(np.arange(len(caps)), caps)] > level).astype(np.float32)


def _window(lengths: np.ndarray, least: int, most: int, threshold: float) -> tuple[int, int]:
    """First and last place (exclusive) among sorted lengths that primaries of ``least`` to ``most`` characters may reach."""
    if threshold <= 0:
        return 0, len(lengths)
    near = [2.0 * np.minimum(lengths, size) / (lengths + size) >= threshold for size in (least, most)]
    low = np.argmax(near[0]) if near[0].any() else np.searchsorted(lengths, least)
    high = len(lengths) - np.argmax(near[1][::-1]) if near[1].any() else np.searchsorted(lengths, most, "right")
    return int(low), int(high)


class TitleSet:
    """Titles of one task, comparable with many primary titles in a few vector steps."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)
        size = len(self.keys)
        self.lengths = np.fromiter((len(key) for key in self.keys), dtype=np.int64, count=size)
        self.codes = np.full((size, self.lengths.max(initial=0)), _PAD, dtype=np.uint8)
        self.counts = np.zeros((size, _OTHER + 1), dtype=np.int32)
        for row, key in enumerate(self.keys):
            codes = _codes(key)
            self.codes[row, : len(codes)] = codes
            self.counts[row] = _counts(codes)
        rare = self.counts <= (self.lengths // 100 + 1)[:, None]
        rare[:, _OTHER] = True  # several characters: each may be rare
        self.rare_counts = np.where(rare, self.counts, 0)
        long = np.flatnonzero(self.lengths >= _LONG)
        self.gram_row = np.full(size, -1, dtype=np.int64)
        self.gram_row[long] = np.arange(len(long))
        self.grams = np.zeros((len(long), _BUCKETS), dtype=np.int16)
        self.numbered = []
        for place, row in enumerate(long):
            spelled = _spelled(self.codes[row, : self.lengths[row]])
            self.grams[place] = _grams(spelled)
            self.numbered.append(_numbered(spelled))
        frequent = np.argsort(-self.counts.sum(axis=0), kind="stable")
        self.dropped = [frequent[:most] for most in _DROPPED]
        self.left = [_without(self.codes, dropped) for dropped in self.dropped]

    def tiles(self) -> list[_Tile]:
        rows = np.arange(len(self.keys))
        return [_Tile(self, rows[start : start + _TILE]) for start in range(0, len(rows), _TILE)]

    def near(
        self, given: _Primaries, after: np.ndarray, tiles: Sequence[_Tile], is_open: np.ndarray, threshold: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the primary, open row behind ``after``) of the tiles that all bounds leave, in this order."""
        found = []
        for tile in tiles:
            number, row = tile.bounds(self, given, threshold)
            kept = is_open[row] & (row > after[number])
            number, row = number[kept], row[kept]
            long = self.gram_row[row] >= 0
            found += [(number[~long], row[~long]), self._by_counts(given, number[long], row[long], threshold)]
        number, row = map(np.concatenate, zip(*found))
        for dropped, (codes, lengths) in zip(self.dropped, self.left):
            kept = self._by_subsequence(given, number, row, dropped, codes, lengths, threshold)
            number, row = number[kept], row[kept]
        order = np.lexsort((row, number))
        return number[order], row[order]

    def possible(self, primary: str, rows: np.ndarray, threshold: float) -> np.ndarray:
        """Those of ``rows`` that the bounds by counts leave for ``primary``."""
        if not len(rows) or not primary:
            return rows[:0]
        return self._by_counts(_Primaries([primary]), np.zeros(len(rows), np.int64), rows, threshold)[1]

    def _by_counts(
        self, given: _Primaries, number: np.ndarray, row: np.ndarray, threshold: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs with enough characters in common and, for long titles, enough strings of four for their number of blocks."""
        kept = [row[:0]]
        for start in range(0, len(row), _PAIRS):
            of, at = number[start : start + _PAIRS], row[start : start + _PAIRS]
            total = self.lengths[at] + given.sizes[of]
            left = np.flatnonzero(2.0 * np.minimum(self.counts[at], given.counts[of]).sum(axis=1) / total >= threshold)
            long = self.gram_row[at[left]] >= 0
            kept.append(start + left[~long])
            left = left[long]
            of, at, total = of[left], at[left], total[left]
            apart = (_GRAM - 1) * (2 * np.minimum(self.rare_counts[at], given.counts[of]).sum(axis=1) + 1)
            shared = np.minimum(self.grams[self.gram_row[at]], given.grams[of]).sum(axis=1, dtype=np.int64)
            for place in np.flatnonzero(2.0 * (shared + apart) / total >= threshold):
                spelled = self.numbered[self.gram_row[at[place]]], given.numbered[of[place]]
                both = len(np.intersect1d(*spelled, assume_unique=True))
                if 2.0 * (both + apart[place]) / total[place] >= threshold:
                    kept.append(start + left[place : place + 1])
        left = np.concatenate(kept)
        return number[left], row[left]

    def _by_subsequence(
        self, given: _Primaries, number: np.ndarray, row: np.ndarray, dropped: np.ndarray, codes: np.ndarray,
        lengths: np.ndarray, threshold: float,
    ) -> np.ndarray:
        """Which pairs have a long enough common subsequence, if all their ``dropped`` characters match.

        ``codes`` and ``lengths`` are those of the titles without these characters.
        """
        kept = ~np.isin(np.arange(_OTHER + 1), dropped)
        primaries = [part[kept[part]] for part in given.codes]
        masks, sizes = _place_masks(primaries)
        words = _WORDS[np.searchsorted(_WORDS, -(-sizes[number] // _BITS)).clip(0, len(_WORDS) - 1)]
        common = np.minimum(self.counts[row][:, dropped], given.counts[number][:, dropped]).sum(axis=1, dtype=np.int64)
        order = np.lexsort((lengths[row], words))
        # Pairs of one step have primaries of equally many words, or nearly so.
        ends = np.flatnonzero(np.diff(words[order], append=-1)) + 1
        starts = [range(low, high, _PAIRS) for low, high in zip([0, *ends[:-1]], ends)]
        for start, stop in ((n, min(n + _PAIRS, part.stop)) for part in starts for n in part):
            part = order[start:stop]
            if len(part) < _VECTOR_ROWS * words[part[0]]:
                common[part] += [
                    _common_subsequence(_places(primaries[n]), sizes[n], codes[r, : lengths[r]].tolist())
                    for n, r in zip(number[part], row[part])
                ]
                continue
            others = codes[row[part], : lengths[row[part]].max()]
            common[part] += _pair_subsequences(masks[: words[part[0]]], sizes, number[part], others)
        return 2.0 * common / (self.lengths[row] + given.sizes[number]) >= threshold

    def exact(self, primary: str, rows: np.ndarray, threshold: float) -> np.ndarray:
        """Those of ``rows`` whose title reaches ``threshold`` against ``primary``."""
        reached = [SequenceMatcher(None, primary, self.keys[row]).ratio() >= threshold for row in rows]
        return rows[np.array(reached, dtype=bool)]


def _narrowed(titles: TitleSet, tile: _Tile, is_open: np.ndarray, after: int) -> _Tile | None:
    """The tile, dealt anew when most of its rows are decided, None when it has no open row behind ``after``."""
    left = tile.rows[is_open[tile.rows] & (tile.rows > after)]
    if not len(left):
        return None
    return tile if 2 * len(left) > len(tile.rows) else _Tile(titles, left)


def _greedy(primaries: Sequence[str], titles: TitleSet, threshold: float, own: bool) -> np.ndarray:
    """Position of the first primary each title is similar to, -1 where there is none; with ``own`` the primaries are
    those titles themselves that no earlier one is similar to.

    The bounds of several primaries are tested in one vector step, although a title of the step may turn out to be no
    primary or be taken by an earlier one. Steps grow while that does not happen.
    """
    found = np.full(len(titles.keys), -1, dtype=np.int64)
    tiles = titles.tiles()
    # A step of a small set costs more than its pairs: there the first one is wider.
    start, width = 0, min(max(1024 // max(len(titles.keys), 1), 1), _STEP)
    while start < len(primaries):
        is_open = found < 0
        stop = min(start + width, len(primaries))
        step = np.arange(start, stop)
        step = step[is_open[step]] if own else step
        after = step if own else np.full(len(step), -1)
        tiles = [_narrowed(titles, tile, is_open, start if own else -1) for tile in tiles]
        tiles = [tile for tile in tiles if tile is not None]
        if not tiles or not len(step):
            start = stop if tiles else len(primaries)
            continue
        given = _Primaries([primaries[place] for place in step])
        number, row = titles.near(given, after, tiles, is_open, threshold)
        bounds = np.searchsorted(number, np.arange(len(step) + 1))
        spared = 0
        for place, low, high in zip(step, bounds, bounds[1:]):
            rows = row[low:high]
            still = rows[found[rows] < 0] if not own or found[place] < 0 else rows[:0]
            spared += len(rows) - len(still)
            if len(still):
                found[titles.exact(primaries[place], still, threshold)] = place
        start, width = stop, max(width // 2, 1) if spared > len(step) else min(2 * width, _STEP)
    return found


def resolve(keys: Sequence[str], threshold: float) -> np.ndarray:
    """Greedy marking of titles given in rank order: position of each title's primary, -1 for primaries."""
    titles = TitleSet(keys)
    return _greedy(titles.keys, titles, threshold, own=True)


def assign(primaries: Sequence[str], keys: Sequence[str], threshold: float) -> np.ndarray:
    """Position of the first primary each title is similar to, -1 where there is none."""
    return _greedy(primaries, TitleSet(keys), threshold, own=False)


def ratio(a: str, b: str) -> float:
    """Similarity of two normalised titles; 0 when either is empty."""
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0
