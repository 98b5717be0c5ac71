"""A small gated recurrent network over words, with a class-factored output, in numpy; runs inside
Arrow batches.

A text is a sequence of units. The first units are tokens that are classes of their own; the others
come in groups of `cells` units, a class each: the frequent words of the class, and last one unit for
all of its other words. The network predicts the class of the next token from the units so far, and
within a class the unit, each by a softmax of the state. Training is truncated backpropagation: texts
lie one behind another in lanes, the state is carried from window to window and starts at zero with
every text, and gradients stay inside a window. Scoring carries the state through the whole text.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
WINDOW = 16
LANES = 512
RATE = 0.08
CLIP = 1.0


@dataclass(frozen=True)
class Layout:
    """Which unit belongs to which class."""

    alone: int
    groups: int
    cells: int

    @property
    def classes(self) -> int:
        return self.alone + self.groups

    @property
    def units(self) -> int:
        return self.alone + self.groups * self.cells

    def shapes(self) -> dict[str, tuple[int, ...]]:
        return {
            "input": (self.units, 3 * HIDDEN),
            "state": (HIDDEN, 3 * HIDDEN),
            "bias": (3 * HIDDEN,),
            "output": (HIDDEN, self.classes),
            "output_bias": (self.classes,),
            "within": (self.groups, HIDDEN, self.cells),
            "within_bias": (self.groups, self.cells),
        }

    def class_of(self, units: np.ndarray) -> np.ndarray:
        return np.minimum(units, self.alone + np.maximum(units - self.alone, 0) // self.cells)


def initial(layout: Layout, seed: int, shares: np.ndarray) -> np.ndarray:
    """All parameters in one row; the outputs start at the units' shares, whose sum is one. A unit
    without a share, a place that no word has taken, has no chance from the start."""
    rng = np.random.default_rng(seed)
    grouped = shares[layout.alone :].reshape(layout.groups, layout.cells)
    sums = grouped.sum(axis=1)
    prior = np.concatenate([shares[: layout.alone], sums])
    parts = []
    for name, shape in layout.shapes().items():
        if name == "output_bias":
            parts.append(np.log(np.maximum(prior, 1e-30)))
        elif name == "within_bias":
            inside = grouped / np.maximum(sums, 1e-30)[:, None]
            parts.append(np.log(np.maximum(inside, 1e-30)).ravel())
        elif name == "bias":
            parts.append(np.zeros(shape))
        elif name == "within":
            parts.append(np.zeros(int(np.prod(shape))))
        else:
            parts.append(rng.normal(0, 1 / np.sqrt(HIDDEN), shape).ravel())
    return np.concatenate(parts).astype(np.float32)


def unpacked(flat: np.ndarray, layout: Layout) -> dict[str, np.ndarray]:
    parts, at = {}, 0
    for name, shape in layout.shapes().items():
        size = int(np.prod(shape))
        parts[name] = flat[at : at + size].reshape(shape)
        at += size
    return parts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _step(model, inputs: np.ndarray, h: np.ndarray):
    """The next state, and what the way back needs. `inputs` already has the bias."""
    hidden = h.shape[1]
    back = h @ model["state"]
    gates = _sigmoid(inputs[:, : 2 * hidden] + back[:, : 2 * hidden])
    update, reset = gates[:, :hidden], gates[:, hidden:]
    fresh = np.tanh(inputs[:, 2 * hidden :] + reset * back[:, 2 * hidden :])
    return fresh + update * (h - fresh), (update, reset, fresh, back[:, 2 * hidden :])


def _grouped(units: np.ndarray, real: np.ndarray, layout: Layout):
    """The places whose unit lies in a group, ordered by group; their cells; each group's slice."""
    places = np.flatnonzero(real & (units >= layout.alone))
    inside = units[places] - layout.alone
    group = (inside // layout.cells).astype(np.uint16)
    order = np.argsort(group, kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=layout.groups))
    slices = [(g, slice(a, b)) for g, (a, b) in enumerate(zip([0, *ends[:-1]], ends)) if b > a]
    return places[order], (inside % layout.cells)[order], slices


def _within(model, states: np.ndarray, slices, layout: Layout) -> np.ndarray:
    logits = np.empty((len(states), layout.cells), np.result_type(states, model["within"]))
    for g, rows in slices:
        np.matmul(states[rows], model["within"][g], out=logits[rows])
        logits[rows] += model["within_bias"][g]
    return logits


def train(flat: np.ndarray, texts: list[np.ndarray], layout: Layout) -> np.ndarray:
    """The parameters after one pass over the texts, by Adagrad steps of one window."""
    total = sum(map(len, texts))
    if not total:
        return flat
    flat = flat.copy()
    model = unpacked(flat, layout)
    tokens = np.concatenate(texts)
    begins = np.zeros(total, bool)
    begins[np.cumsum([0, *map(len, texts)])[:-1][[len(t) > 0 for t in texts]]] = True
    lanes = min(LANES, max(1, total // (4 * WINDOW)))
    length = -(-total // lanes)
    padded = np.full(lanes * length, -1, np.int64)
    padded[:total] = tokens
    starts = np.zeros(lanes * length, bool)
    starts[:total] = begins
    padded, starts = padded.reshape(lanes, length).T, starts.reshape(lanes, length).T
    seen = np.full(len(flat), 1e-4, np.float32)
    h = np.zeros((lanes, HIDDEN), np.float32)
    for at in range(0, length, WINDOW):
        h = _window(model, flat, seen, padded[at : at + WINDOW], starts[at : at + WINDOW], h, layout)
    return flat


def _window(model, flat, seen, tokens, starts, h, layout):
    steps, lanes = tokens.shape
    real = (tokens >= 0).ravel()
    own = np.where(real, tokens.ravel(), 0)
    inputs = (model["input"][own] + model["bias"]).reshape(steps, lanes, 3 * HIDDEN)
    before = np.empty((steps, lanes, HIDDEN), h.dtype)
    kept = []
    for t in range(steps):
        if starts[t].any():
            h = h * ~starts[t][:, None]
        before[t] = h
        h, parts = _step(model, inputs[t], h)
        kept.append(parts)
    flat_before = before.reshape(-1, HIDDEN)
    one = np.float32(1 / max(1, int(real.sum())))
    gradient = np.zeros_like(flat)
    slope = unpacked(gradient, layout)

    chances = flat_before @ model["output"] + model["output_bias"]
    chances -= chances.max(axis=1, keepdims=True)
    np.exp(chances, out=chances)
    chances *= (real * one)[:, None] / chances.sum(axis=1, keepdims=True)
    chances[np.arange(steps * lanes), layout.class_of(own)] -= real * one
    slope["output"][:] = flat_before.T @ chances
    slope["output_bias"][:] = chances.sum(axis=0)
    from_output = chances @ model["output"].T

    places, cells, slices = _grouped(own, real, layout)
    states = flat_before[places]
    inner = _within(model, states, slices, layout)
    inner -= inner.max(axis=1, keepdims=True)
    np.exp(inner, out=inner)
    inner *= one / inner.sum(axis=1, keepdims=True)
    inner[np.arange(len(inner)), cells] -= one
    pull = np.empty_like(states)
    for g, rows in slices:
        np.matmul(states[rows].T, inner[rows], out=slope["within"][g])
        slope["within_bias"][g] = inner[rows].sum(axis=0)
        np.matmul(inner[rows], model["within"][g].T, out=pull[rows])
    from_output[places] += pull
    from_output = from_output.reshape(steps, lanes, HIDDEN)

    to_inputs = np.empty((steps, lanes, 3 * HIDDEN), h.dtype)
    to_back = np.empty((steps, lanes, 3 * HIDDEN), h.dtype)
    later = np.zeros((lanes, HIDDEN), h.dtype)
    into = model["state"].T
    for t in range(steps - 1, -1, -1):
        update, reset, fresh, back = kept[t]
        d_fresh = later * (1 - update) * (1 - fresh * fresh)
        to_inputs[t, :, :HIDDEN] = later * (before[t] - fresh) * update * (1 - update)
        to_inputs[t, :, HIDDEN : 2 * HIDDEN] = d_fresh * back * reset * (1 - reset)
        to_inputs[t, :, 2 * HIDDEN :] = d_fresh
        to_back[t, :, : 2 * HIDDEN] = to_inputs[t, :, : 2 * HIDDEN]
        to_back[t, :, 2 * HIDDEN :] = d_fresh * reset
        later = later * update + to_back[t] @ into + from_output[t]
        if starts[t].any():
            later *= ~starts[t][:, None]
    slope["state"][:] = flat_before.T @ to_back.reshape(-1, 3 * HIDDEN)
    rows = to_inputs.reshape(-1, 3 * HIDDEN)
    slope["bias"][:] = rows.sum(axis=0)
    order = np.argsort(own.astype(np.uint16), kind="stable")
    order = order[real[order]]
    if len(order):
        at = own[order]
        firsts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        slope["input"][at[firsts]] = np.add.reduceat(rows[order], firsts, axis=0)

    squares = gradient * gradient
    norm = float(np.sqrt(squares.sum()))
    if norm > CLIP:
        gradient *= CLIP / norm
        squares *= (CLIP / norm) ** 2
    seen += squares
    np.sqrt(seen, out=squares)
    gradient *= RATE
    gradient /= squares
    flat -= gradient
    return h


def _log_softmax_at(logits: np.ndarray, picked: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    chosen = logits[np.arange(len(logits)), picked]
    np.exp(logits, out=logits)
    return chosen - np.log(logits.sum(axis=1))


def _queues(lengths: np.ndarray) -> list[list[int]]:
    """Whole texts dealt to lanes, the longest first and each to the lane with the fewest tokens, so
    that a very long text has a lane while the others share the rest."""
    lanes = [(0, i) for i in range(min(LANES, len(lengths)))]
    queues: list[list[int]] = [[] for _ in lanes]
    for text in np.argsort(-lengths, kind="stable").tolist():
        size, lane = lanes[0]
        queues[lane].append(text)
        heapq.heapreplace(lanes, (size + int(lengths[text]), lane))
    return queues


def log_chances(flat: np.ndarray, texts: list[np.ndarray], layout: Layout) -> np.ndarray:
    """For each text the natural logarithm of the probability of its whole sequence of units. Texts
    stand behind one another in lanes; the lanes walk side by side, the longest first, so those that
    have ended leave the end of the row."""
    sums = np.zeros(len(texts))
    if not texts:
        return sums
    model = unpacked(flat, layout)
    inputs = model["input"] + model["bias"]
    lengths = np.array([len(t) for t in texts])
    queues = sorted(_queues(lengths), key=lambda q: -int(lengths[q].sum()))
    sizes = np.array([int(lengths[q].sum()) for q in queues])
    lanes = [  # text and unit of every place, as one number
        np.concatenate([texts[i].astype(np.int64) for i in q]) + (np.repeat(q, lengths[q]) << 16) for q in queues
    ]
    h = np.zeros((len(lanes), HIDDEN), flat.dtype)
    last = np.full(len(lanes), -1, np.int64)
    at = 0
    while at < sizes[0]:
        live = int((sizes > at).sum())
        steps = min(max(WINDOW, LANES * WINDOW // live), int(sizes[0]) - at)
        filled = np.zeros((live, steps), np.int64)
        for k in range(live):
            part = lanes[k][at : at + steps]
            filled[k, : len(part)] = part
        filled = np.ascontiguousarray(filled.T)
        real = (np.arange(at, at + steps)[:, None] < sizes[:live]).ravel()
        own, text = filled & 0xFFFF, filled >> 16
        fresh = text != np.concatenate([last[None, :live], text[:-1]])
        last, any_fresh = text[-1], fresh.any(axis=1)
        h = h[:live]
        before = np.empty((steps, live, HIDDEN), flat.dtype)
        for t in range(steps):
            if any_fresh[t]:
                h = h * ~fresh[t][:, None]
            before[t] = h
            h, _ = _step(model, inputs[own[t]], h)
        states = before.reshape(-1, HIDDEN)
        units = own.ravel()
        logs = _log_softmax_at(states @ model["output"] + model["output_bias"], layout.class_of(units)).astype(np.float64)
        places, cells, slices = _grouped(units, real, layout)
        logs[places] += _log_softmax_at(_within(model, states[places], slices, layout), cells)
        sums += np.bincount(text.ravel()[real], weights=logs[real], minlength=len(texts))
        at += steps
    return sums
