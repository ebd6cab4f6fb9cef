"""Growing the trees of a model on rows in the memory of its task.

Rows are kept packed: features share a byte while the product of their
bins fits into it, so that a table of dummies takes few bytes a row and sums
over eight dummies are one pass; over large nodes two bytes are. Every node
has the list of its rows, of two siblings only the lighter is counted, and
leaves take their sums from the split that made them. The rows may be a part
of all: sums then go through ``added``, which adds those of the other parts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from cohortscore.operators import boosting as base

#: Rows whose sums are added up in one go.
_SLICE = 131_072
#: Rows whose derivatives are computed in one go.
_CHUNK = 32_768
_CODES = 256
#: Rows of a node from which two columns are summed as one.
PAIR_ROWS = 30_000


def packing(cards: np.ndarray) -> list[list[tuple[int, int]]]:
    """Columns of (feature, stride): numbers of bins whose product fits a byte, largest first."""
    columns: list[list[tuple[int, int]]] = []
    sizes: list[int] = []
    for f in sorted(range(len(cards)), key=lambda f: (-cards[f], f)):
        c = next((c for c, size in enumerate(sizes) if size * cards[f] <= _CODES), len(columns))
        if c == len(columns):
            columns.append([])
            sizes.append(1)
        columns[c].append((f, sizes[c]))
        sizes[c] *= int(cards[f])
    return columns


def empty_bins(bins: np.ndarray) -> np.ndarray:
    """Which features have missing values."""
    found = np.zeros(bins.shape[1], dtype=bool)
    for at in range(0, len(bins), _SLICE):
        found |= (bins[at : at + _SLICE] == base.MISSING).any(axis=0)
    return found


class Layout:
    """How bins of features share columns of bytes; ``missing`` are the features with missing values."""

    def __init__(self, spans: np.ndarray, missing: np.ndarray):
        self.spans, self.missing = spans, missing
        self.cards = spans[1:] - spans[:-1] - 1 + missing
        self.columns = packing(self.cards)
        self.place = {f: (c, stride) for c, column in enumerate(self.columns) for f, stride in column}
        # How the sums of a column's codes become those of its features' bins.
        self.unpack = []
        for column in self.columns:
            places, ones = [], []
            for f, stride in column:
                bin_of = np.arange(_CODES) // stride % self.cards[f]
                last = self.cards[f] - 1
                places += [spans[f + 1] - 1 if missing[f] and b == last else spans[f] + b for b in range(self.cards[f])]
                ones.append(bin_of[:, None] == np.arange(self.cards[f]))
            self.unpack.append((np.array(places, dtype=np.int64), np.concatenate(ones, axis=1).astype(float)))

    def pairs(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Two columns of bytes each in a number of 16 bits, from the bins of every feature."""
        out = np.zeros(((len(self.columns) + 1) // 2, len(columns[0])), dtype=np.uint16)
        for c, column in enumerate(self.columns):
            for f, stride in column:
                own = columns[f]
                if self.missing[f]:
                    own = np.where(own == base.MISSING, np.uint8(self.cards[f] - 1), own)
                out[c // 2] += own.astype(np.uint16) * np.uint16(stride * (_CODES if c % 2 else 1))
        return out

    def goes_right(self, feature: int, cut: int, missing_left: bool) -> tuple[int, np.ndarray]:
        """The column that a split reads, and the side of each code."""
        c, stride = self.place[feature]
        bin_of = np.arange(_CODES) // stride % self.cards[feature]
        right = bin_of > cut
        if self.missing[feature]:
            right = np.where(bin_of == self.cards[feature] - 1, not missing_left, right)
        return c, right


def _half(pair: np.ndarray, c: int) -> np.ndarray:
    """Column ``c`` out of its pair."""
    return pair >> np.uint16(8) if c % 2 else pair & np.uint16(_CODES - 1)


class Held:
    """Rows of a task: key, label, fold and packed bins, from bins or as they are stored."""

    def __init__(self, key, y, fold, bins, spans: np.ndarray, missing: np.ndarray, pairs: np.ndarray | None = None):
        self.key, self.y, self.fold, self.spans = key, y, fold, spans
        self.layout = Layout(spans, missing)
        self.columns = self.layout.columns
        self.codes = self.layout.pairs(bins.T) if pairs is None else pairs

    def sums(self, slot: np.ndarray, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, width: int) -> np.ndarray:
        """(width, bins of all features, 2) of ``rows``, whose places are ``slot`` and derivatives ``grad`` and ``hess``."""
        joint = np.zeros((len(self.columns), 2, width * _CODES))
        for at in range(0, len(rows), _SLICE):
            part, start = rows[at : at + _SLICE], slot[at : at + _SLICE] * _CODES
            g, h = grad[at : at + _SLICE], hess[at : at + _SLICE]
            for number, codes in enumerate(self.codes):
                pair = codes.take(part)
                for c in range(2 * number, min(2 * number + 2, len(joint))):
                    code = start + _half(pair, c)
                    joint[c, 0] += np.bincount(code, g, minlength=width * _CODES)
                    joint[c, 1] += np.bincount(code, h, minlength=width * _CODES)
        out = np.zeros((width, int(self.spans[-1]), 2))
        for own, (places, ones) in zip(joint, self.layout.unpack):
            out[:, places] = np.moveaxis(own.reshape(2, width, _CODES) @ ones, 0, -1)
        return out

    def node_sums(self, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
        """(bins of all features, 2) of the rows of one node, two columns at a time."""
        joint = np.zeros((len(self.codes), 2, _CODES * _CODES))
        for at in range(0, len(rows), _SLICE):
            part, g, h = (a[at : at + _SLICE] for a in (rows, grad, hess))
            for own, codes in zip(joint, self.codes):
                code = codes.take(part, mode="clip").astype(np.intp)
                own[0] += np.bincount(code, g, minlength=_CODES * _CODES)
                own[1] += np.bincount(code, h, minlength=_CODES * _CODES)
        joint = joint.reshape(-1, 2, _CODES, _CODES)
        out = np.zeros((int(self.spans[-1]), 2))
        for c, (places, ones) in enumerate(self.layout.unpack):
            out[places] = (joint[c // 2].sum(axis=2 if c % 2 else 1) @ ones).T
        return out

    def several(self, parts: Sequence[np.ndarray], grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
        """(parts, bins of all features, 2): sums of the rows of each part; derivatives are those of all rows."""
        out = np.zeros((len(parts), int(self.spans[-1]), 2))
        small = [k for k, rows in enumerate(parts) if len(rows) < PAIR_ROWS]
        if small:
            rows = np.concatenate([parts[k] for k in small])
            slot = np.repeat(np.arange(len(small)), [len(parts[k]) for k in small])
            out[small] = self.sums(slot, rows, grad.take(rows), hess.take(rows), len(small))
        for k, rows in enumerate(parts):
            if len(rows) >= PAIR_ROWS:
                out[k] = self.node_sums(rows, grad.take(rows), hess.take(rows))
        return out

    def sides(self, rows: np.ndarray, column: int, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``rows`` to the left and to the right of a split."""
        goes = right.take(_half(self.codes[column // 2].take(rows), column))
        return rows.compress(~goes), rows.compress(goes)


def left_sum(sums: np.ndarray, spans: np.ndarray, feature: int, cut: int, missing_left: bool) -> np.ndarray:
    """Both derivatives left of a split, from its node's sums."""
    left = sums[spans[feature] : spans[feature] + cut + 1].sum(axis=0)
    return left + sums[spans[feature + 1] - 1] if missing_left else left


def derivatives(model: base.Model, held: Held, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows the next tree learns from, and both derivatives of all rows."""
    s, n = model.settings, len(held.y)
    mine, grad, hess = np.ones(n, dtype=bool), np.empty(n), np.empty(n)
    for at in range(0, n, _CHUNK):
        here = slice(at, at + _CHUNK)
        if model.leaves_out is not None:
            mine[here] = held.fold[here] != model.leaves_out
        if s.subsample < 1.0:
            mine[here] &= base.uniform(held.key[here], model.salt()) < s.subsample
        y = held.y[here]
        p = 1.0 / (1.0 + np.exp(-margin[here]))
        weight = np.where(y == 1, s.scale_pos_weight, 1.0)
        grad[here], hess[here] = weight * (p - y), weight * p * (1 - p)
    return mine, grad, hess


def grow_tree(
    model: base.Model, held: Held, margin: np.ndarray, added: Callable[[np.ndarray, np.ndarray], np.ndarray] = lambda sums, allowed: sums
) -> tuple[base.Tree, list[tuple[int, np.ndarray]]]:
    """One tree more, and the rows of each leaf. ``added`` makes the sums of these rows those of all rows."""
    s, spans, layout = model.settings, held.spans, held.layout
    mine, grad, hess = derivatives(model, held, margin)
    tree, allowed = base.Tree(), model.columns(len(spans) - 1)
    # The rows of each open node: those that the tree learns from, and others.
    rows, leaves = {0: (np.flatnonzero(mine), np.flatnonzero(~mine))}, []
    nodes, sums, depth = [0], added(held.several([rows[0][0]], grad, hess), allowed), 0
    whole = sums[:, : spans[1]].sum(axis=1)
    tree.value[0] = s.eta * float(base.leaf_value(whole[:, 0], whole[:, 1], s)[0])
    while nodes and depth < s.max_depth:
        splits = [(k, node, found) for k, (node, found) in enumerate(zip(nodes, base.best_splits(sums, spans, allowed, s, base.TIE))) if found]
        if not splits:
            break
        first, light = [], []
        for k, node, (gain, feature, cut, missing_left) in splits:
            left = left_sum(sums[k], spans, feature, cut, missing_left)
            both = np.stack([left, sums[k, : spans[1]].sum(axis=0) - left])
            children = tree.split(node, feature, cut, missing_left, gain)
            for child, value in zip(children, base.leaf_value(both[:, 0], both[:, 1], s).tolist()):
                tree.value[child] = s.eta * value
            column, right = layout.goes_right(feature, cut, missing_left)
            taken, others = (held.sides(part, column, right) for part in rows.pop(node))
            rows |= {child: (taken[side], others[side]) for side, child in enumerate(children)}
            first.append(children[0])
            light.append(int(both[1, 1] < both[0, 1]))
        depth += 1
        if depth == s.max_depth:
            break
        opened = [child for start in first for child in (start, start + 1)]
        leaves += [(node, part) for node in [n for n in rows if n not in set(opened)] for part in rows.pop(node)]
        # Of two siblings the lighter is counted; the other is what their parent has besides.
        found = added(held.several([rows[start + side][0] for start, side in zip(first, light)], grad, hess), allowed)
        rest = sums[[k for k, _, _ in splits]] - found
        sums = np.stack([np.where(np.array(light)[:, None, None] == side, found, rest) for side in (0, 1)], axis=1).reshape(-1, *found.shape[1:])
        nodes = opened
    return tree, leaves + [(node, part) for node, both in rows.items() for part in both]


def add_scores(margin: np.ndarray, tree: base.Tree, leaves: list[tuple[int, np.ndarray]]) -> None:
    for node, rows in leaves:
        margin[rows] += tree.value[node]


def grow_alone(model: base.Model, held: Held) -> None:
    """All trees of one model from the rows of one task."""
    margin = np.zeros(len(held.y))
    out = held.fold == model.leaves_out
    while not model.finished():
        tree, leaves = grow_tree(model, held, margin)
        model.trees.append(tree)
        add_scores(margin, tree, leaves)
        if model.settings.patience is not None:
            model.areas.append(base.average_precision(held.y[out], margin[out]))
