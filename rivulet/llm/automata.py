"""Minimal acceptors of word lists and their composition with a one-edit
transducer (numpy, used inside tasks on partitions of bounded size)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEP = 1 << 18


@dataclass
class Acceptor:
    """A minimal deterministic acceptor of sorted words in blocks. Arcs of
    state q lie at arc[q]..arc[q + 1], by label; `skip` is the number of words
    of q before those of the arc, so that the skips along a word's path add up
    to its place in the list."""

    final: np.ndarray
    arc: np.ndarray
    label: np.ndarray
    to: np.ndarray
    skip: np.ndarray
    key: np.ndarray  # state and label of every arc as one sorted number
    state: np.ndarray  # of every node of the trie, a node for each distinct beginning but the empty one
    first: np.ndarray  # the first word below every node


def minimal_acceptor(words: list[str], block: np.ndarray) -> Acceptor:
    """The minimal acceptor of `words`, distinct and sorted inside each block;
    a word is accepted as the label of its block and its code points."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.cumsum(size) - size
    code = np.empty(int(size.sum()), np.int64)
    code[start] = block + (1 << 21)
    rest = np.ones(len(code), bool)
    rest[start] = False
    code[rest] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    common = _common_prefix(code, start, size)
    label, parent, end, first, ends = _trie(code, start, size, common)
    state, height = np.zeros(len(label), np.int64), _heights(parent, ends)
    kids = np.bincount(parent[parent >= 0], minlength=len(label))
    child = np.full(len(label), -1)  # children of a node follow one another
    inner = np.flatnonzero(parent >= 0)
    child[parent[inner][::-1]] = inner[::-1]
    shown, n = [], 0  # one node for each state
    for h in range(int(height.max()) + 1 if len(height) else 0):
        at = np.flatnonzero(height == h)
        sign = end[at] + 2 * kids[at]
        for k in range(int(kids[at].max())):
            more = np.flatnonzero(kids[at] > k)
            c = child[at[more]] + k
            arcs = np.unique(label[c] << 32 | state[c], return_inverse=True)[1]
            both = np.unique(sign[more] << 32 | arcs, return_inverse=True)[1]
            sign = sign.copy()
            sign[more] = both
        _, one, same = np.unique(kids[at] << 32 | sign, return_index=True, return_inverse=True)
        state[at] = same + n
        shown.append(at[one])
        n += len(one)
    shown = np.concatenate(shown) if shown else np.zeros(0, np.int64)
    arc = np.concatenate([[0], np.cumsum(kids[shown])])
    src = np.repeat(child[shown] - arc[:-1], kids[shown]) + np.arange(arc[-1])
    owner = np.repeat(np.arange(len(shown)), kids[shown])
    return Acceptor(end[shown].astype(bool), arc, label[src], state[src], first[src] - first[shown][owner],
                    owner << 32 | label[src], state, first)


def _common_prefix(code, start, size):
    """How many labels each word has in common with the one before it."""
    out = np.zeros(len(start), np.int64)
    live = np.arange(1, len(start))
    while len(live):
        at = out[live[0]]
        live = live[(size[live] > at) & (size[live - 1] > at)]
        live = live[code[start[live] + at] == code[start[live - 1] + at]]
        out[live] += 1
    return out


def _trie(code, start, size, common):
    """Label, parent (-1: none), whether a word ends, and first word of every
    node, and the bounds of the nodes of each depth."""
    live, here, n = np.arange(len(start)), np.full(len(start), -1), 0
    label, parent, first, ends, last = [], [], [], [0], np.zeros(len(start), np.int64)
    depth = 0
    while len(live):
        new = common[live] <= depth
        at = live[new]
        label.append(code[start[at] + depth])
        parent.append(here[at])
        first.append(at)
        here[live] = n + np.cumsum(new) - 1
        n += len(at)
        ends.append(n)
        depth += 1
        done = size[live] == depth
        last[live[done]] = here[live[done]]
        live = live[~done]
    end = np.zeros(n, np.int64)
    end[last] = 1
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return cat(label), cat(parent), end, cat(first), ends


def _heights(parent, ends):
    height = np.zeros(len(parent), np.int64)
    for a, b in zip(ends[-2:0:-1], ends[:1:-1]):
        np.maximum.at(height, parent[a:b], height[a:b] + 1)
    return height


def _spread(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts n: the index of each item's group and its number in it."""
    group = np.repeat(np.arange(len(n)), n)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)


def _steps(a: Acceptor, u, v, barred=None):
    """Pairs of arcs of u and v with one label, not the barred one:
    (index of the pair of states, arc of u, arc of v)."""
    i, k = _spread(a.arc[u + 1] - a.arc[u])
    e = a.arc[u[i]] + k
    keep = np.ones(len(e), bool) if barred is None else a.label[e] != barred[i]
    i, e = i[keep], e[keep]
    want = v[i] << 32 | a.label[e]
    f = np.searchsorted(a.key, want)
    hit = _among(want, a.key, f)
    return i[hit], e[hit], f[hit]


def _among(x: np.ndarray, known: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Which x are among the sorted numbers `known`."""
    at = np.searchsorted(known, x) if at is None else at
    hit = at < len(known)
    hit[hit] = known[at[hit]] == x[hit]
    return hit


def one_edit_pairs(a: Acceptor) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of places of accepted words of one block that differ by one
    replaced, inserted or deleted code point: the paths of acceptor, one-edit
    transducer and acceptor composed. Each pair comes once.

    Before the edit both acceptors are in one state; the edit leads to a pair
    of states, and from there both take the same labels to the end. An edit
    counts at the first place where the words differ, so after a deletion the
    other word must not go on with the deleted label."""
    u, v, x, src, e1, e2 = _edits(a)
    gone = np.flatnonzero(x >= 0)
    i, f, g = _steps(a, u[gone], v[gone], x[gone])
    after = a.to[f] << 32 | a.to[g]
    useful = _useful(a, np.unique(np.concatenate([(u << 32 | v)[x < 0], after])))
    # a deletion is judged by the states after the next label
    keep = np.where(x < 0, _among(u << 32 | v, useful), a.final[u] & a.final[v])
    keep[gone[i[_among(after, useful)]]] = True
    u, v, x, src, e1, e2 = (c[keep] for c in (u, v, x, src, e1, e2))
    s1 = a.skip[e1]
    s2 = np.where(x >= 0, 0, a.skip[np.maximum(e2, 0)])
    by = np.argsort(src, kind="stable")
    u, v, x, src, s1, s2 = (c[by] for c in (u, v, x, src, s1, s2))
    bound = np.searchsorted(src, np.arange(len(a.arc)))
    n = (bound[1:] - bound[:-1])[a.state]
    out = []
    edge = np.concatenate([[0], np.cumsum(n)])
    nodes = 0
    while nodes < len(n):  # about STEP edits at a time
        stop = max(nodes + 1, int(np.searchsorted(edge, edge[nodes] + STEP, side="right")) - 1)
        group, k = _spread(n[nodes:stop])
        group += nodes
        k += bound[a.state[group]]
        out.append(_walk(a, useful, u[k], v[k], x[k], a.first[group] + s1[k], a.first[group] + s2[k]))
        nodes = stop
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 2


def _edits(a: Acceptor):
    """All edits out of states: (state of the one, of the other, the deleted
    label or -1, the state they start at, arc of the one, of the other or -1)."""
    deg = np.diff(a.arc)
    q, k = _spread(deg)
    e = a.arc[q] + k
    m, j = _spread(deg[q] - 1 - k)  # a replacement: the arc and each later one
    f = e[m] + 1 + j
    u = np.concatenate([a.to[e[m]], a.to[e]])
    v = np.concatenate([a.to[f], q])
    x = np.concatenate([np.full(len(m), -1), a.label[e]])
    return u, v, x, np.concatenate([q[m], q]), np.concatenate([e[m], e]), np.concatenate([f, np.full(len(e), -1)])


def _useful(a: Acceptor, pair: np.ndarray) -> np.ndarray:
    """The pairs of states (u << 32 | v, sorted) that can be reached from
    `pair`, sorted, and accept a word in common."""
    low = (1 << 32) - 1
    known, front, arcs = pair, pair, []
    while len(front):
        i, e, f = _steps(a, front >> 32, front & low)
        nxt = a.to[e] << 32 | a.to[f]
        arcs.append((front[i], nxt))
        front = np.setdiff1d(nxt, known)
        known = np.union1d(known, front)
    good = a.final[known >> 32] & a.final[known & low]
    src, dst = (np.searchsorted(known, np.concatenate(c)) for c in zip(*arcs)) if arcs else (np.zeros(0, np.int64),) * 2
    while True:  # as many rounds as the longest word has labels
        new = src[good[dst] & ~good[src]]
        if not len(new):
            return known[good]
        good[new] = True


def _walk(a: Acceptor, useful, u, v, barred, i, j):
    """Follow common labels from pairs of states to all accepted pairs of words."""
    out = []
    while len(u):
        end = a.final[u] & a.final[v]
        out.append((i[end], j[end]))
        k, e, f = _steps(a, u, v, barred)
        ok = _among(a.to[e] << 32 | a.to[f], useful)
        k, e, f, barred = k[ok], e[ok], f[ok], None
        u, v, i, j = a.to[e], a.to[f], i[k] + a.skip[e], j[k] + a.skip[f]
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
