"""Hamming links between fingerprints, compared bit plane by bit plane.

Plane *b* is a bitset with bit *b* of every fingerprint of a block, so one word operation updates 64 distances.
The distances are carry-save counters: ``radius.bit_length()`` bitsets and one for overflow. A block is
abandoned as soon as every distance in it exceeds the radius. Planes that are constant over a block add nothing
and are skipped.
"""

import numpy as np

#: Groups above this size are compared query by query; the others all together, by their distance in the group.
LARGE = 64
#: Fingerprints compared at once; queries at once; words in a block; planes between two looks at the overflow.
LANES, QUERIES, BLOCK, LOOK = 16_384, 128, 512, 8

_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def bits_of(values: np.ndarray) -> np.ndarray:
    """``(n, bits)`` zeros and ones of ``values``: n fingerprints of one or more uint64 each."""
    return np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1), axis=1, bitorder="little")


def bit_planes(bits: np.ndarray, pad_words: int = 0) -> np.ndarray:
    """``(bits, words)`` bitsets over the fingerprints, with ``pad_words`` empty words behind."""
    words = (len(bits) + 63) // 64 + pad_words
    planes = np.zeros((bits.shape[1], words * 8), dtype=np.uint8)
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    planes[:, : packed.shape[1]] = packed
    return planes.view(np.uint64)


def bitset(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 8, dtype=np.uint8)
    packed = np.packbits(flags, bitorder="little")
    out[: len(packed)] = packed
    return out.view(np.uint64)


def within(differences, radius: int, out_of_play: np.ndarray) -> np.ndarray:
    """Bitsets of the lanes with at most ``radius`` differing planes; ``out_of_play`` lanes are never counted.

    ``differences`` yields one array of difference bits per plane. The counters start so high that they overflow
    with the first difference beyond the radius.
    """
    over, width = out_of_play.copy(), radius.bit_length()
    start = (1 << width) - 1 - radius
    counters = [np.full_like(over, _ONES if start >> k & 1 else 0) for k in range(width)]
    for n, x in enumerate(differences, 1):
        for k, counter in enumerate(counters):
            counters[k], x = counter ^ x, counter & x
        over |= x
        if n % LOOK == 0 and (over == _ONES).all():
            break
    return ~over


def _shifted(plane: np.ndarray, lo: int, hi: int, by: int) -> np.ndarray:
    k, r = lo + (by >> 6), by & 63
    if not r:
        return plane[k : k + hi - lo]
    return (plane[k : k + hi - lo] >> np.uint64(r)) | (plane[k + 1 : k + 1 + hi - lo] << np.uint64(64 - r))


def _small_groups(values: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked places ``(i, j)`` within the same group; groups lie one after the other, the largest first."""
    most = int(sizes[0])
    planes = bit_planes(bits_of(values), most // 64 + 2)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    size = np.repeat(sizes, sizes)
    used = np.flatnonzero(planes.any(axis=1))
    empty = np.zeros(0, dtype=np.int64)
    left, right = [empty], [empty]
    for by in range(1, most):
        lanes = int(np.searchsorted(-size, -by, side="left"))  # of groups with more than ``by`` members
        words = (lanes + 63) // 64
        idle = ~bitset(place[:lanes] + by < size[:lanes], words)
        for lo in range(0, words, BLOCK):
            hi = min(words, lo + BLOCK)
            x = (planes[b][lo:hi] ^ _shifted(planes[b], lo, hi, by) for b in used)
            found = within(x, radius, idle[lo:hi])
            if found.any():
                i = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little")) + 64 * lo
                left.append(i)
                right.append(i + by)
    return np.concatenate(left), np.concatenate(right)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the smallest place that its links reach."""
    label = np.arange(n)
    while len(left):
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def distances(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values[left] ^ values[right]).sum(axis=1, dtype=np.int64)


def nearest_forest(n: int, left: np.ndarray, right: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Numbers of the links of a minimum spanning forest: each part takes its nearest link, until none is left."""
    rank = np.empty(len(left), dtype=np.int64)
    rank[np.lexsort((right, left, distance))] = np.arange(len(left))
    at = np.argsort(rank)
    chosen, label, open_ = np.zeros(0, dtype=np.int64), np.arange(n), np.arange(len(left))
    while True:
        open_ = open_[label[left[open_]] != label[right[open_]]]
        if not len(open_):
            return chosen
        best = np.full(n, len(left), dtype=np.int64)
        np.minimum.at(best, label[left[open_]], rank[open_])
        np.minimum.at(best, label[right[open_]], rank[open_])
        chosen = np.union1d(chosen, at[best[best < len(left)]])
        label = forest(n, left[chosen], right[chosen])


def _tiles(values: np.ndarray, radius: int):
    """Links of one group, as ``(i, j)`` with i < j, tile by tile."""
    n, bits = len(values), bits_of(values)
    planes, bits = bit_planes(bits), bits.astype(bool)
    used = np.flatnonzero(bits.any(axis=0) & ~bits.all(axis=0))
    none = ~bitset(np.ones(n, dtype=np.uint8), planes.shape[1])
    for q0 in range(0, n, QUERIES):
        asked = bits[q0 : q0 + QUERIES]
        for lo in range(q0 // 64, planes.shape[1], BLOCK):
            hi = min(planes.shape[1], lo + BLOCK)
            x = (planes[b][None, lo:hi] ^ np.where(asked[:, b], _ONES, np.uint64(0))[:, None] for b in used)
            found = within(x, radius, np.broadcast_to(none[lo:hi], (len(asked), hi - lo)))
            if found.any():
                q, i = np.nonzero(np.unpackbits(np.ascontiguousarray(found).view(np.uint8), axis=1, bitorder="little"))
                q, i = q + q0, i + 64 * lo
                yield q[q < i], i[q < i]


def _large_group(values: np.ndarray, radius: int, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep one group together. Those found are merged tile by tile and never held together."""
    n = len(values)
    left = right = np.zeros(0, dtype=np.int64)
    for i, j in _tiles(values, radius):
        left, right = np.concatenate([left, i]), np.concatenate([right, j])
        if nearest:
            keep = nearest_forest(n, left, right, distances(values, left, right))
            left, right = left[keep], right[keep]
        else:
            label = forest(n, left, right)
            left = np.flatnonzero(label != np.arange(n))
            right = label[left]
    return left, right


def _large(sizes: np.ndarray):
    """The places of each group that is compared by itself."""
    starts = np.cumsum(sizes) - sizes
    for g in np.flatnonzero(sizes > LARGE):
        yield np.arange(starts[g], starts[g] + sizes[g])


def _together(sizes: np.ndarray):
    """Places, and sizes of their groups, of small groups that are compared at once, the largest first."""
    starts = np.cumsum(sizes) - sizes
    small = np.flatnonzero((sizes <= LARGE) & (sizes > 1))
    small = small[np.argsort(-sizes[small], kind="stable")]
    ends = np.cumsum(sizes[small])
    at = 0
    while at < len(small):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LANES, side="right")))
        own = small[at:to]
        yield np.concatenate([np.arange(starts[g], starts[g] + sizes[g]) for g in own]), sizes[own]
        at = to


def close_pairs(values: np.ndarray, sizes: np.ndarray, radius: int):
    """All ``(i, j)`` places within ``radius`` of each other in the same group, some at a time."""
    for places in _large(sizes):
        for i, j in _tiles(values[places], radius):
            yield places[i], places[j]
    for places, own in _together(sizes):
        i, j = _small_groups(values[places], own, radius)
        yield places[i], places[j]


def spanning_links(values: np.ndarray, sizes: np.ndarray, radius: int, nearest: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(i, j)`` places that connect what lies within ``radius`` of each other in the same group.

    ``values``: fingerprints as ``(n, uint64s)``, group after group; ``sizes``: members of each group. Fewer links
    than members are returned: with ``nearest`` those of least distance, else links to the least place reachable.
    """
    heads = [np.zeros(0, dtype=np.int64)]
    tails = [np.zeros(0, dtype=np.int64)]
    for places in _large(sizes):
        left, right = _large_group(values[places], radius, nearest)
        heads.append(places[left])
        tails.append(places[right])
    for places, own in _together(sizes):
        part = values[places]
        left, right = _small_groups(part, own, radius)
        if nearest:
            keep = nearest_forest(len(places), left, right, distances(part, left, right))
            left, right = left[keep], right[keep]
        else:
            label = forest(len(places), left, right)
            left = np.flatnonzero(label != np.arange(len(places)))
            right = label[left]
        heads.append(places[left])
        tails.append(places[right])
    return np.concatenate(heads), np.concatenate(tails)
