"""Hamming distances of many fingerprints at once, from vertical bit planes.

A block is up to 64 fingerprints; plane b holds bit b of all of them in one word. A
probe is a fingerprint against a block: each plane, inverted where the fingerprint's own
bit is set, is added to counters that hold one binary digit of all 64 distances per word
(carry-save). Probes whose 64 distances all exceed the radius are abandoned on the way.
"""

from __future__ import annotations

import numpy as np

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Planes between two looks for probes to abandon; probes counted together.
STRIDE, PROBES = 8, 1 << 15


def planes(words: np.ndarray, block: np.ndarray, lane: np.ndarray, blocks: int) -> np.ndarray:
    """Bit planes (blocks x bits) of fingerprints (rows x words) placed at block and lane."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")
    placed = np.zeros((blocks, 64, bits.shape[1]), np.uint8)
    placed[block, lane] = bits
    packed = np.packbits(placed, axis=1, bitorder="little")
    return np.ascontiguousarray(packed.transpose(0, 2, 1)).view("<u8")[:, :, 0]


def within(words: np.ndarray, plane: np.ndarray, valid: np.ndarray, row: np.ndarray,
           block: np.ndarray, radii: tuple[int, ...]) -> list[np.ndarray]:
    """For each probe (row, block) and radius a word of the lanes within the radius."""
    out = [np.zeros(len(row), np.uint64) for _ in radii]
    for start in range(0, len(row), PROBES):
        part = slice(start, start + PROBES)
        for all_, found in zip(out, _count(words, plane, valid, row[part], block[part], radii)):
            all_[part] = found
    return out


def _count(words, plane, valid, row, block, radii):
    digits = int(max(radii)).bit_length()
    alive = np.arange(len(row))
    counters = [np.zeros(len(row), np.uint64) for _ in range(digits)]
    over = np.zeros(len(row), np.uint64)
    for b in range(plane.shape[1]):
        own = (words[row[alive], b >> 6] >> np.uint64(b & 63)) & np.uint64(1)
        carry = plane[block[alive], b] ^ (np.uint64(0) - own)
        for c in counters:
            c ^= carry
            carry = carry & ~c
        over |= carry
        if b % STRIDE == STRIDE - 1:
            live = (over | ~valid[block[alive]]) != ALL
            if not live.all():
                alive, over = alive[live], over[live]
                counters = [c[live] for c in counters]
            if not len(alive):
                break
    result = []
    for radius in radii:
        # Digits from the highest: lanes still equal to the radius, and those below it.
        equal, below = ~over, np.zeros(len(alive), np.uint64)
        for d in reversed(range(digits)):
            if radius >> d & 1:
                below |= equal & ~counters[d]
                equal = equal & counters[d]
            else:
                equal = equal & ~counters[d]
        found = np.zeros(len(row), np.uint64)
        found[alive] = (below | equal) & valid[block[alive]]
        result.append(found)
    return result


def _trees(node, start, adjacent, masks):
    """Links that join what the masks join: a tree per component; and the tree of each row."""
    free = {}
    for b, first, size in start:
        free[b] = (1 << size) - 1
    first_row = {b: first for b, first, _ in start}
    block_of = {r: b for b, first, size in start for r in range(first, first + size)}
    links, tree = [], {}
    for root in sorted(adjacent, key=lambda r: node[r]):
        if root in tree:
            continue
        tree[root] = root
        free[block_of[root]] &= ~(1 << (root - first_row[block_of[root]]))
        queue = [root]
        for row in queue:
            for probe, b in adjacent.get(row, ()):
                new = masks[probe] & free[b]
                free[b] &= ~new
                while new:
                    low = new & -new
                    new ^= low
                    child = first_row[b] + low.bit_length() - 1
                    tree[child] = root
                    links.append((node[row], node[child]))
                    queue.append(child)
    return links, tree


def _bridges(node, start, adjacent, masks, tree):
    """Links that join trees as the masks join them: at most one less than there are trees."""
    first_row = {b: first for b, first, _ in start}
    block_of = {r: b for b, first, size in start for r in range(first, first + size)}
    members: dict[int, list] = {}
    for row, root in tree.items():
        members.setdefault(root, []).append(row)
    free = dict.fromkeys(first_row, 0)
    for row in tree:
        free[block_of[row]] |= 1 << (row - first_row[block_of[row]])
    links, reached, queue = [], set(), []

    def reach(root):
        reached.add(root)
        for row in members[root]:
            free[block_of[row]] &= ~(1 << (row - first_row[block_of[row]]))
        queue.extend(members[root])

    for first in members:
        if first in reached:
            continue
        queue.clear()
        reach(first)
        for row in queue:
            for probe, b in adjacent[row]:
                while new := masks[probe] & free[b]:
                    child = first_row[b] + (new & -new).bit_length() - 1
                    links.append((node[row], node[child]))
                    reach(tree[child])
    return links


def group_links(node: np.ndarray, words: np.ndarray, group: np.ndarray, side: np.ndarray,
                radii: tuple[int, ...]) -> list[tuple[int, int]]:
    """Links between fingerprints of the same group; rows are sorted by (group, side).

    In a group with two sides only pairs across are compared, else all pairs. Links
    within the first radius are thinned to trees, which join the same rows; those within a
    second, wider radius to links between the trees, which join the same rows again.
    """
    cut = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (side[1:] != side[:-1])])
    sizes = np.diff(np.r_[cut, len(group)])
    place = np.arange(len(group)) - np.repeat(cut, sizes)
    per_run = (sizes + 63) // 64
    first_block = np.r_[0, np.cumsum(per_run)]
    block = np.repeat(first_block[:-1], sizes) + place // 64
    blocks = int(first_block[-1])
    plane = planes(words, block, place % 64, blocks)
    lanes = np.bincount(block, minlength=blocks).astype(np.uint64)
    valid = np.where(lanes == 64, ALL, (np.uint64(1) << (lanes % np.uint64(64))) - np.uint64(1))
    # The run that each run is compared with: the group's other side, or itself.
    run_group = group[cut]
    other = np.arange(len(cut))
    pair = np.flatnonzero(run_group[1:] == run_group[:-1])
    other[pair], other[pair + 1] = pair + 1, pair
    run = np.repeat(np.arange(len(cut)), sizes)
    many = per_run[other[run]]
    row = np.repeat(np.arange(len(group)), many)
    step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    probed = first_block[other[run]][row] + step
    masks = within(words, plane, valid, row, probed, radii)
    own = np.where(probed == block[row], np.uint64(1) << (place[row] % 64).astype(np.uint64), np.uint64(0))
    masks = [m & ~own for m in masks]
    hit = np.flatnonzero(masks[-1])
    links: list[tuple[int, int]] = []
    row_start = np.r_[0, np.cumsum(lanes.astype(np.int64))]
    hit_group = group[row[hit]]
    for i in np.split(hit, np.flatnonzero(hit_group[1:] != hit_group[:-1]) + 1) if len(hit) else ():
        adjacent: dict[int, list] = {}
        for p in i.tolist():
            adjacent.setdefault(int(row[p]), []).append((p, int(probed[p])))
        runs = {int(run[row[i[0]]])}
        runs.add(int(other[next(iter(runs))]))
        start = [(b, int(row_start[b]), int(lanes[b]))
                 for r in sorted(runs) for b in range(first_block[r], first_block[r + 1])]
        strict = {p: int(masks[0][p]) for p in i.tolist()}
        near, tree = _trees(node, start, adjacent, strict)
        links += near
        if len(masks) > 1:
            links += _bridges(node, start, adjacent, {p: int(masks[1][p]) for p in i.tolist()}, tree)
    return links
