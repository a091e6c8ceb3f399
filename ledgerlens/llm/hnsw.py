"""Hierarchical navigable small-world graph (Malkov and Yashunin) in numpy.

Rows are unit vectors ordered by falling level, so a layer is a prefix of them.
Points are inserted in batches: a batch searches the graph so far and is
compared with itself, neighbours are picked by the diversity rule, and links
back are pruned by the same rule. Searches walk many queries in step, widening
each query's beam by its best unexpanded points until none is left.
"""

from __future__ import annotations

import numpy as np

M = 16
BUILD_BEAM = 64
_STEP = 4
_QUERIES = 256


def _top(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, in falling order."""
    k = min(k, sims.shape[1])
    part = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(sims, part, axis=1), axis=1, kind="stable"), axis=1)


def _diverse(x, near, sims, most):
    """Of each row of candidates (-1: none) at most `most`: first those nearer to the point than to any taken one, then the nearest others."""
    order = np.argsort(-np.where(near >= 0, sims, -np.inf), axis=1, kind="stable")
    near, sims = np.take_along_axis(near, order, axis=1), np.take_along_axis(sims, order, axis=1)
    v = x[np.maximum(near, 0)]
    between = v @ v.transpose(0, 2, 1)
    taken = np.zeros(near.shape, bool)
    for j in range(near.shape[1]):
        crowded = (taken & (between[:, j, :] > sims[:, j:j + 1])).any(axis=1)
        taken[:, j] = (near[:, j] >= 0) & ~crowded & (taken.sum(axis=1) < most)
    place = np.argsort(~taken, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, place, axis=1)


def _search(x, links, queries, entry, beam):
    """(ids, similarities) of the `beam` best points found for each query; -1 where there are fewer."""
    rows, width = len(queries), max(beam, entry.shape[1])
    ids, sims, done = np.full((rows, width), -1), np.full((rows, width), -np.inf, np.float32), np.ones((rows, width), bool)
    e = entry.shape[1]
    ids[:, :e] = entry
    sims[:, :e] = np.einsum("qed,qd->qe", x[np.maximum(entry, 0)], queries)
    sims[:, :e][entry < 0] = -np.inf
    done[:, :e] = entry < 0
    seen = np.zeros((rows, len(links)), bool)
    np.put_along_axis(seen, np.maximum(entry, 0), True, axis=1)
    active = np.arange(rows)
    while len(active):
        open_ = np.where(done[active], -np.inf, sims[active])
        pick = _top(open_, _STEP)
        ok = np.take_along_axis(open_, pick, axis=1) > -np.inf
        going = ok[:, 0]
        active, pick, ok = active[going], pick[going], ok[going]
        if not len(active):
            break
        a = active[:, None]
        done[a, pick] = True
        near = links[np.maximum(ids[a, pick], 0)]
        near = np.where(ok[:, :, None], near, -1).reshape(len(active), -1)
        near = np.sort(near, axis=1)
        fresh = (near >= 0) & ~seen[a, np.maximum(near, 0)]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        seen[active[r], near[r, c]] = True
        got = np.full(near.shape, -np.inf, np.float32)
        got[r, c] = np.einsum("nd,nd->n", x[near[r, c]], queries[active[r]])
        all_sims = np.concatenate([sims[active], got], axis=1)
        best = _top(all_sims, width)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1), best, axis=1)
        sims[active] = np.take_along_axis(all_sims, best, axis=1)
        done[active] = np.take_along_axis(np.concatenate([done[active], ~fresh], axis=1), best, axis=1)
    return ids[:, :beam], sims[:, :beam]


def levels(uniform: np.ndarray) -> np.ndarray:
    """Geometric levels with ratio M from uniform numbers in (0, 1]."""
    return np.floor(-np.log(uniform) / np.log(M)).astype(np.int64)


def _insert(x, links, lo, hi, above):
    """Link the points lo..hi-1 of a layer into the graph of the points before them."""
    q, most = x[lo:hi], links.shape[1]
    if lo:
        ids, sims = _walk(x, [links[:lo], *above], q, BUILD_BEAM)
    else:
        ids, sims = np.full((hi - lo, 1), -1), np.full((hi - lo, 1), -np.inf, np.float32)
    own = q @ q.T
    np.fill_diagonal(own, -np.inf)
    mate = _top(own, min(most, hi - lo)) if hi - lo > 1 else np.zeros((hi - lo, 0), np.int64)
    mate_sims = np.take_along_axis(own, mate, axis=1)
    ids = np.concatenate([ids, np.where(mate_sims > -np.inf, mate + lo, -1)], axis=1)
    sims = np.concatenate([sims, mate_sims], axis=1)
    keep = _top(np.where(ids >= 0, sims, -np.inf), 3 * most // 2)
    ids, sims = np.take_along_axis(ids, keep, axis=1), np.take_along_axis(sims, keep, axis=1)
    chosen = _diverse(x, ids, sims, most)
    links[lo:hi, :chosen.shape[1]] = chosen
    # links back: a point's new neighbours are its old ones and the nearest of those that chose it
    src, col = np.nonzero(chosen >= 0)
    dst = chosen[src, col]
    src = src + lo
    order = np.lexsort((-np.einsum("nd,nd->n", x[src], x[dst]), dst))
    src, dst = src[order], dst[order]
    first = np.flatnonzero(np.concatenate(([True], dst[1:] != dst[:-1]))) if len(dst) else np.empty(0, np.int64)
    nth = np.arange(len(dst)) - np.repeat(first, np.diff(np.append(first, len(dst))))
    few = nth < most
    back = np.full((len(first), most), -1)
    back[np.repeat(np.arange(len(first)), np.diff(np.append(first, len(dst))))[few], nth[few]] = src[few]
    for at in range(0, len(first), 1024):
        point = dst[first[at:at + 1024]]
        both = np.sort(np.concatenate([links[point], back[at:at + 1024]], axis=1), axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        s = np.einsum("pcd,pd->pc", x[np.maximum(both, 0)], x[point])
        links[point] = _diverse(x, both, s, most)


def _walk(x, layers, queries, beam):
    """Search from the top layer down; `layers` are link tables, the lowest first."""
    top = len(layers[-1])
    sims = queries @ x[:top].T
    entry = _top(sims, min(_STEP, top))
    for links in layers[-2:0:-1]:
        entry = _search(x, links, queries, entry, 8)[0]
    if len(layers) == 1 and top <= beam:
        order = _top(sims, beam)
        return order, np.take_along_axis(sims, order, axis=1)
    return _search(x, layers[0], queries, entry, beam)


def build(x: np.ndarray, level: np.ndarray) -> list[np.ndarray]:
    """Link tables of the layers, the lowest first; `level` falls along the rows of `x`."""
    layers: list[np.ndarray] = []
    for at in range(int(level[0]), -1, -1):
        n = int((level >= at).sum())
        links = np.full((n, 2 * M if at == 0 else M), -1)
        # the points of the layer above come first, as searches enter through them
        lo, size = 0, max(256, len(layers[0]) if layers else 0)
        while lo < n:
            hi = min(n, lo + size)
            _insert(x, links, lo, hi, layers)
            lo, size = hi, min(max(2 * size, 512), 2048)
        layers.insert(0, links)
    return layers


def search(x: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, beam: int):
    """Ids and similarities of at most `beam` points for each query."""
    for lo in range(0, len(queries), _QUERIES):
        yield (lo, *_walk(x, layers, queries[lo:lo + _QUERIES], beam))
