"""Array code of the fatigue classifiers: one player's sessions, all folds of a fit at once.

A fit has one row of ``parts`` for each time it learns: from which sessions. Each learner returns the
probability of a drop for every part and session, the model of the last part and its importances. What is
drawn for a part follows from its number, which begins at ``first``, so parts may be fitted apart: the folds
are 0 to 2, the whole is 3.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, fields

import numpy as np

PURE = 1e-12
#: So many numbers fit in 16 bits.
SHORT = 1 << 16
#: Entries times features that a level of trees looks at together.
CELLS = 500_000
#: Entries that are searched at once, whole trees at least: more sessions take no more memory for it than this or a tree asks for.
BLOCK = 1_000_000
#: Sessions that are scored at once.
SCORED = 50_000


@dataclass
class Trees:
    """Binary trees in flat arrays; tree t starts at node ``roots[t]``, a leaf has feature -1, ``right`` is ``left`` + 1."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    importances: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each tree (row) and session (column)."""
        node = np.repeat(self.roots[:, None], len(x), axis=1)
        rows = np.arange(len(x))[None, :]
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                return node
            right = x[rows, np.maximum(feature, 0)] > self.threshold[node]
            node = np.where(inner, self.left[node] + right, node)


@dataclass
class Ranked:
    """Sessions as ranks of each feature's values: ``ranks`` is features by sessions, ``values`` features by ranks."""

    ranks: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Ranked:
        found = [np.unique(column, return_inverse=True) for column in x.T]
        values = np.zeros((len(found), max(len(v) for v, _ in found)))
        for f, (v, _) in enumerate(found):
            values[f, : len(v)] = v
        return cls(np.stack([inverse for _, inverse in found]).astype(np.int64), values)


def sorted_entries(node, ranks):
    """For each row of ``ranks`` the order of its entries by node and rank; entries with both alike keep their order."""
    most = int(ranks.max()) + 1
    if (int(node.max()) + 1) * most <= SHORT:  # numpy sorts numbers of 16 bits by their digits
        return np.argsort((node * most + ranks).astype(np.uint16), axis=1, kind="stable")
    if max(int(node.max()) + 1, most) > SHORT:
        return np.argsort(node * most + ranks, axis=1, kind="stable")
    by_rank = np.argsort(ranks.astype(np.uint16), axis=1, kind="stable")
    by_node = np.argsort(node.astype(np.uint16)[by_rank], axis=1, kind="stable")
    return np.take_along_axis(by_rank, by_node, axis=1)


def column_cuts(node, row, x: Ranked, weight, weighted, totals, tried):
    """(gain, ranks on both sides of the cut) of the best cut by each column of ``tried`` (rows) in each node (columns).

    The gain is minus infinity where there is no cut; of equal gains the lowest cut wins.
    """
    n, width = tried.shape
    gains, lows, highs = np.full((width, n), -np.inf), np.zeros((width, n), dtype=np.int64), np.zeros((width, n), dtype=np.int64)
    if not len(node):
        return gains, lows, highs
    rank = x.ranks.ravel()[tried.T[:, node] * x.ranks.shape[1] + row]
    order = sorted_entries(node, rank)
    rank, at = np.take_along_axis(rank, order, axis=1), np.sort(node, kind="stable")
    column, ends = np.nonzero((at[:-1] == at[1:]) & (rank[:, :-1] != rank[:, 1:]))
    if not len(ends):
        return gains, lows, highs
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    place = np.zeros(n, dtype=np.int64)
    place[at[starts]] = np.arange(len(starts))
    own = at[ends]
    flat, group = column * len(at) + ends, column * len(starts) + place[own]

    def below(v):
        """The sum of a node's entries up to the cut."""
        v = v[order]
        upto = np.cumsum(v, axis=1)
        return upto.ravel()[flat] - (upto[:, starts] - v[:, starts]).ravel()[group]

    wl, sl = below(weight), below(weighted)
    all_w, all_s = totals[0][own], totals[1][own]
    found = sl**2 / wl + (all_s - sl) ** 2 / (all_w - wl) - all_s**2 / all_w
    firsts = np.flatnonzero(np.diff(group, prepend=-1))
    most = np.maximum.reduceat(found, firsts)
    hits = np.flatnonzero(found == np.repeat(most, np.diff(np.append(firsts, len(group)))))
    hits = hits[np.flatnonzero(np.diff(group[hits], prepend=-1))]
    where = column[hits], own[hits]
    gains[where], lows[where], highs[where] = most, rank.ravel()[flat[hits]], rank.ravel()[flat[hits] + 1]
    return gains, lows, highs


def best_cuts(node, row, x: Ranked, weight, weighted, totals, tried):
    """(gain, feature, ranks on both sides of the cut) for each node: the cut that leaves the least variance.

    ``weighted`` is weight times target. Entries with the same node and rank are never parted. ``tried``
    has the features of each node in ascending order; as many columns as fit in ``CELLS`` are searched at
    once, over the same entries. Of equal gains the first feature and the lowest cut win.
    """
    n, width = tried.shape
    at_once = max(1, CELLS // max(1, len(node)))
    pieces = [column_cuts(node, row, x, weight, weighted, totals, tried[:, c : c + at_once]) for c in range(0, width, at_once)]
    gains, lows, highs = (np.concatenate(found) for found in zip(*pieces))
    gain, chosen = np.full(n, -1.0), np.full(n, -1)
    for c in range(width):
        better = gains[c] > gain + PURE
        gain[better], chosen[better] = np.maximum(gains[c][better], 0.0), c
    feature, cut, following = np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    split = np.flatnonzero(chosen >= 0)
    where = chosen[split], split
    feature[split], cut[split], following[split] = tried[split, chosen[split]], lows[where], highs[where]
    return gain, feature, cut, following


def cuts_in_blocks(node, row, tree, x: Ranked, weight, weighted, totals, tried):
    """``best_cuts`` for blocks of whole trees; entries and nodes stand in the order of their trees, ``tree`` is that of each node."""
    if len(node) <= BLOCK:
        return best_cuts(node, row, x, weight, weighted, totals, tried)
    trees = np.flatnonzero(np.diff(tree, prepend=-1))
    first = np.searchsorted(tree[node], tree[trees])
    begins = [0]
    for k in range(1, len(trees)):
        if (first[k + 1] if k + 1 < len(trees) else len(node)) - first[begins[-1]] > BLOCK:
            begins.append(k)
    found = []
    for a, b in zip(begins, [*begins[1:], len(trees)]):
        nodes = slice(trees[a], trees[b] if b < len(trees) else None)
        own = slice(first[a], first[b] if b < len(trees) else None)
        of = [t[nodes] for t in totals]
        found.append(best_cuts(node[own] - trees[a], row[own], x, weight[own], weighted[own], of, tried[nodes]))
    return tuple(np.concatenate(column) for column in zip(*found))


def grow(x: np.ndarray, target: np.ndarray, weight: np.ndarray, depth: int | None, n_tried: int, rng=None, ranked: Ranked | None = None) -> Trees:
    """Level by level, one tree for each row of ``target`` and ``weight`` (trees by sessions).

    A node looks at ``n_tried`` random features, and at the others only if none of those can be cut.
    """
    n_trees, n_features = len(weight), x.shape[1]
    ranked = ranked or Ranked.of(x)
    tree, row = np.nonzero(weight)
    node, w, y = tree, weight[tree, row].astype(float), target[tree, row]
    del tree
    owner, start = np.arange(n_trees), 0
    levels, importances = [], np.zeros((n_trees, n_features))
    while True:
        n, at = len(owner), node - start
        wy = w * y
        totals = [np.bincount(at, v, n) for v in (w, wy, wy * y)]
        safe = np.maximum(totals[0], PURE)
        value = totals[1] / safe
        impurity = totals[2] / safe - value**2
        feature, threshold, left = np.full(n, -1), np.zeros(n), np.zeros(n, dtype=np.int64)
        levels.append((feature, threshold, left, value))
        can = (np.bincount(at, minlength=n) > 1) & (impurity > PURE) & (depth is None or len(levels) <= depth)
        if not can.any():
            break
        shuffled = np.broadcast_to(np.arange(n_features), (n, n_features))
        if n_tried < n_features:
            shuffled = np.argsort(rng.random((n, n_features)), axis=1)
        # The others stay as they are for good.
        open_ = can[at]
        if not open_.all():
            row, w, y, wy, at = row[open_], w[open_], y[open_], wy[open_], at[open_]
        gain, split, cut, following = cuts_in_blocks(at, row, owner, ranked, w, wy, totals, np.sort(shuffled[:, :n_tried], axis=1))
        missed = can & (split < 0)
        if n_tried < n_features and missed.any():
            again = missed[at]
            more = cuts_in_blocks(at[again], row[again], owner, ranked, w[again], wy[again], totals, np.sort(shuffled[:, n_tried:], axis=1))
            gain, split, cut, following = (np.where(missed, b, a) for a, b in zip((gain, split, cut, following), more))
        parted = np.flatnonzero(split >= 0)
        if not len(parted):
            break
        feature[parted] = split[parted]
        # Halfway between neighbours, but never up to the upper one, which doubles may round to.
        low, high = (ranked.values[split[parted], side[parted]] for side in (cut, following))
        threshold[parted] = np.where((low + high) / 2 < high, (low + high) / 2, low)
        left[parted] = start + n + 2 * np.arange(len(parted))
        np.add.at(importances, (owner[parted], split[parted]), gain[parted])
        inner = split[at] >= 0
        row, w, y, at = row[inner], w[inner], y[inner], at[inner]
        node = left[at] + (ranked.ranks[split[at], row] > cut[at])
        owner, start = np.repeat(owner[parted], 2), start + n
    flat = [np.concatenate(column) for column in zip(*levels)]
    return Trees(np.arange(n_trees), flat[0].astype(np.int16), flat[1], flat[2].astype(np.int32), flat[3], importances)


def shares(importances: np.ndarray) -> np.ndarray:
    """Mean over trees of each tree's shares, as shares of one."""
    sums = importances.sum(axis=1, keepdims=True)
    mean = (importances / np.where(sums > 0, sums, 1.0)).mean(axis=0)
    return mean / mean.sum() if mean.sum() > 0 else mean


def in_pieces(x: np.ndarray, score) -> np.ndarray:
    """Scores of sessions, a bounded number of them at once."""
    pieces = np.array_split(x, max(1, -(-len(x) // SCORED)))
    return np.concatenate([score(piece) for piece in pieces], axis=-1)


def random_forest(x, y, parts, sizes, seed, first=0):
    """Bootstrapped trees down to pure leaves; each node tries the square root of the number of features."""
    scores, ranked = np.zeros(parts.shape), Ranked.of(x)
    for p, part in enumerate(parts):
        rng, own = np.random.default_rng([seed, first + p]), np.flatnonzero(part)
        drawn = (rng.integers(0, len(own), len(own)) for _ in range(sizes.trees))
        weight = np.stack([np.bincount(own[d], minlength=len(y)).astype(np.uint16) for d in drawn])
        trees = grow(x, np.broadcast_to(y.astype(float), weight.shape), weight, None, max(1, int(x.shape[1] ** 0.5)), rng, ranked)
        scores[p] = in_pieces(x, lambda part: trees.value[trees.leaves(part)].mean(axis=0))  # noqa: B023
    return scores, trees, shares(trees.importances)


def boosted_probability(raw: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(raw, -700, 700)))


def gradient_boosting(x, y, parts, sizes, seed, first=0):
    """Boosting of the log loss; the trees of a round are grown for all parts together."""
    share = np.clip((parts * y).sum(axis=1) / parts.sum(axis=1), 1e-9, 1 - 1e-9)
    raw = np.repeat(np.log(share / (1 - share))[:, None], len(y), axis=1)
    kept, offset, importances = [], 0, np.zeros((1, x.shape[1]))
    ranked, learning = Ranked.of(x), parts.astype(float)
    for _ in range(sizes.boosting_rounds):
        p = boosted_probability(raw)
        residual = y - p
        trees = grow(x, residual, learning, sizes.boosting_depth, x.shape[1], ranked=ranked)
        leaf = trees.leaves(x)
        n = len(trees.value)
        top = np.bincount(leaf.ravel(), (residual * parts).ravel(), n)
        curve = np.bincount(leaf.ravel(), (p * (1 - p) * parts).ravel(), n)
        trees.value = sizes.boosting_step * np.where(curve > 1e-150, top / np.maximum(curve, 1e-150), 0.0)
        raw = raw + trees.value[leaf]
        importances = np.r_[importances, trees.importances[-1:]]
        kept.append(_single(trees, len(parts) - 1, offset))
        offset += len(kept[-1].value)
    base = Trees(np.array([offset]), np.array([-1], dtype=np.int16), np.zeros(1), np.zeros(1, dtype=np.int32), np.log(share[-1:] / (1 - share[-1:])), importances[:0])
    parts_of = [*kept, base]
    joined = [np.concatenate([getattr(t, f.name) for t in parts_of]) for f in fields(Trees)[:-1]]
    total = importances.sum(axis=0)
    return boosted_probability(raw), Trees(*joined, importances[:0]), total / total.sum() if total.sum() > 0 else total


def _single(trees: Trees, which: int, offset: int) -> Trees:
    """One tree out of several, its nodes renumbered from ``offset``."""
    nodes, frontier = [], [int(trees.roots[which])]
    while frontier:
        nodes += frontier
        frontier = [int(trees.left[v]) + side for v in frontier if trees.feature[v] >= 0 for side in (0, 1)]
    number = np.zeros(len(trees.value), dtype=np.int32)
    number[nodes] = offset + np.arange(len(nodes))
    return Trees(np.array([offset]), trees.feature[nodes], trees.threshold[nodes], number[trees.left[nodes]], trees.value[nodes], trees.importances[:0])


def _views(flat: np.ndarray, widths: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrix and offsets of every layer, as views of the flat weights of each part."""
    out, at = [], 0
    for a, b in zip(widths, widths[1:]):
        out.append((flat[:, at : at + a * b].reshape(len(flat), a, b), flat[:, at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def _forward(x: np.ndarray, layers: list, out: list[np.ndarray] | None = None, zeros: list | None = None) -> list[np.ndarray]:
    """What each layer passes on, rectified; the last one is left as it is. Parts are the first axis.

    ``zeros`` are arrays of the shapes in ``out``: numpy compares with an array in a fifth of the time of a number.
    """
    passed = [x]
    for k, (a, b) in enumerate(layers):
        z = np.matmul(passed[-1], a, out=out[k + 1] if out else None)
        z += b[:, None, :]
        passed.append(np.maximum(z, zeros[k + 1] if zeros else 0, out=z) if k + 1 < len(layers) else z)
    return passed


#: Adam's usual constants, and what the reference's library stops by: epochs in a row that improve the loss by less.
RATE, DECAY, SECOND, TINY = 1e-3, 0.9, 0.999, 1e-8
PENALTY, BATCH, PATIENCE = 1e-4, 200, 10


class _Space:
    """Arrays of a step for so many parts at once, so that no step asks for memory."""

    def __init__(self, n_parts: int, width: int, widths: list[int], n_weights: int):
        shape = lambda size: np.empty((n_parts, width, size), dtype=np.float32)
        self.passed = [shape(size) for size in widths]
        self.deltas = [shape(size) for size in widths]
        self.zeros = [np.zeros_like(p) for p in self.passed]
        self.slope, self.spare = (np.empty((n_parts, n_weights), dtype=np.float32) for _ in range(2))
        self.slopes = _views(self.slope, widths)
        self.squares = [a.reshape(n_parts, -1) for a, _ in _views(self.spare, widths)]


def neural_network(x, y, parts, sizes, seed, first=0):
    """Adam on the log loss in batches, all parts in step; a part that no longer improves stays as it is."""
    n_parts, widths = len(parts), [x.shape[1], *sizes.hidden, 1]
    whole, x, target = x, x.astype(np.float32), y.astype(np.float32)
    rngs = [np.random.default_rng([seed, first + p]) for p in range(n_parts)]
    drawn = []
    for a, b in zip(widths, widths[1:]):
        bound = np.sqrt((2.0 if b == 1 else 6.0) / (a + b))
        drawn.append(np.stack([r.uniform(-bound, bound, a * b + b) for r in rngs]))
    flat = np.concatenate(drawn, axis=1).astype(np.float32)
    means, squares = np.zeros_like(flat), np.zeros_like(flat)
    penalty = np.zeros_like(flat[:1])
    for a, _ in _views(penalty, widths):
        a[...] = PENALTY
    own = [np.flatnonzero(part) for part in parts]
    counts = np.array([len(o) for o in own])
    width = min(BATCH, len(y))
    starts = range(0, int(counts.max()), width)
    # Places behind a part's last session hold the first session and do not count.
    places = np.arange(len(starts) * width)
    order, counted = np.zeros((n_parts, len(places)), dtype=np.int64), (places < counts[:, None]).astype(np.float32)
    spaces: dict[int, _Space] = {}
    steps = np.zeros(n_parts)
    best, stale, going = np.full(n_parts, np.inf), np.zeros(n_parts, dtype=int), np.ones(n_parts, dtype=bool)
    for _ in range(sizes.network_iterations):
        for p in np.flatnonzero(going):
            order[p, : counts[p]] = rngs[p].permutation(own[p])
        loss = np.zeros(n_parts)
        for start in starts:
            live = np.flatnonzero(going & (counts > start))
            if not len(live):
                break
            at = live if len(live) < n_parts else slice(None)  # views of all parts, not copies
            space = spaces.get(len(live)) or spaces.setdefault(len(live), _Space(len(live), width, widths, flat.shape[1]))
            chosen, used = order[at, start : start + width], counted[at, start : start + width]
            n = used.sum(axis=1)
            weights = flat[at]
            layers = _views(weights, widths)
            passed = space.passed
            np.take(x, chosen, axis=0, out=passed[0], mode="clip")
            _forward(passed[0], layers, passed, space.zeros)
            z, t = passed[-1][..., 0], target[chosen]
            decayed = np.exp(-np.abs(z))
            fit = ((np.log1p(decayed) + np.maximum(z, 0) - t * z) * used).sum(axis=1)
            np.multiply(weights, weights, out=space.spare)
            loss[at] += fit + 0.5 * PENALTY * sum(a.sum(axis=1) for a in space.squares)
            delta = ((np.where(z >= 0, 1, decayed) / (1 + decayed) - t) * used)[..., None]
            slope = space.slope
            for k in range(len(layers) - 1, -1, -1):
                np.matmul(passed[k].transpose(0, 2, 1), delta, out=space.slopes[k][0])
                if k + 1 < len(layers):
                    np.einsum("pij->pj", delta, out=space.slopes[k][1])
                else:
                    delta.sum(axis=1, out=space.slopes[k][1])
                if k:
                    back = layers[k][0].transpose(0, 2, 1)
                    delta = (np.multiply if widths[k + 1] == 1 else np.matmul)(delta, back, out=space.deltas[k])
                    delta *= passed[k] > 0
            slope += np.multiply(weights, penalty, out=space.spare)
            slope /= n[:, None]
            steps[at] += 1
            mean, square = means[at], squares[at]
            mean *= DECAY
            mean += np.multiply(slope, 1 - DECAY, out=space.spare)
            np.multiply(slope, 1 - SECOND, out=space.spare)
            square *= SECOND
            square += np.multiply(space.spare, slope, out=space.spare)
            rate = (RATE * np.sqrt(1 - SECOND ** steps[at]) / (1 - DECAY ** steps[at]))[:, None].astype(np.float32)
            np.sqrt(square, out=space.spare)
            space.spare += np.float32(TINY)
            weights -= np.divide(np.multiply(mean, rate, out=slope), space.spare, out=slope)
            if len(live) < n_parts:
                means[at], squares[at], flat[at] = mean, square, weights
        loss /= counts
        stale = np.where(loss > best - sizes.network_tolerance, stale + 1, 0)
        best = np.minimum(best, np.where(going, loss, best))
        going &= stale <= PATIENCE
        if not going.any():
            break
    flat = flat.astype(float)
    scores = in_pieces(whole, lambda part: _forward(np.broadcast_to(part, (n_parts, *part.shape)), _views(flat, widths))[-1][..., 0])
    return boosted_probability(scores), [np.array(widths), flat[-1]], None


LEARNERS = {"RandomForest": random_forest, "GradientBoosting": gradient_boosting, "NeuralNetwork": neural_network}


def packed(model) -> bytes:
    out = io.BytesIO()
    arrays = {f.name: getattr(model, f.name) for f in fields(Trees)} if isinstance(model, Trees) else {f"w{i}": v for i, v in enumerate(model)}
    np.savez_compressed(out, **arrays)
    return out.getvalue()


def probabilities(kind: str, model: bytes, x: np.ndarray) -> np.ndarray:
    """What a packed model says about sessions."""
    with np.load(io.BytesIO(model)) as held:
        arrays = {name: held[name] for name in held.files}
    if kind == "NeuralNetwork":
        layers = _views(arrays["w1"][None], arrays["w0"].tolist())
        return boosted_probability(in_pieces(x, lambda part: _forward(part[None], layers)[-1][0, :, 0]))
    trees = Trees(**arrays)
    if kind == "RandomForest":
        return in_pieces(x, lambda part: trees.value[trees.leaves(part)].mean(axis=0))
    return boosted_probability(in_pieces(x, lambda part: trees.value[trees.leaves(part)].sum(axis=0)))
