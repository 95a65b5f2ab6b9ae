"""Bidirectional gated recurrent layer in numpy: forward pass, backpropagation through time, Adam.

States are kept as ``(units, batch)`` so that every step is one small matrix product and a few
element-wise passes over memory that stays in the cache. Inputs are indices into a table of input
projections, which makes the input side of a step a gather.
"""

import numpy as np


def new_direction(rng, units):
    return (rng.normal(size=(3 * units, units)) * (0.5 / np.sqrt(units))).astype("f4")


def run(table, weights, steps, mask=None, keep=False):
    """States of one direction for index steps ``(time, batch)``; masked steps leave the state alone.

    ``table`` is ``(entries, 3 * units)``. With ``keep`` the gates are returned for ``back``.
    """
    units = weights.shape[1]
    columns = np.ascontiguousarray(table.T) if len(table) <= 1024 else None
    gates, candidate = weights[:2 * units], weights[2 * units:]
    state = np.zeros((units, steps.shape[1]), "f4")
    states = np.empty((len(steps), *state.shape), "f4")
    kept = []
    for t, step in enumerate(steps):
        # Entries of a small table stay in the cache by column, those of a large one are read whole.
        x = columns.take(step, axis=1) if columns is not None else table.take(step, axis=0).T
        g = gates @ state
        g += x[:2 * units]
        np.negative(g, g)
        np.exp(g, g)
        g += 1
        np.reciprocal(g, g)
        c = candidate @ (g[:units] * state)
        c += x[2 * units:]
        np.tanh(c, c)
        if keep:
            kept.append((state, g, c.copy()))
        c -= state
        c *= g[units:]
        if mask is not None:
            c *= mask[t]
        state = state + c
        states[t] = state
    return (states, kept) if keep else states


def back(weights, kept, d_states, mask):
    """Gradients of the recurrent weights and of the input projections ``(time, 3 * units, batch)``."""
    units = weights.shape[1]
    gates, candidate = weights[:2 * units], weights[2 * units:]
    d_weights = np.zeros_like(weights)
    d_inputs = np.empty((len(kept), 3 * units, d_states.shape[2]), "f4")
    carried = np.zeros(d_states.shape[1:], "f4")
    for t in range(len(kept) - 1, -1, -1):
        before, g, c = kept[t]
        reset, update = g[:units], g[units:]
        d = carried + d_states[t]
        masked = d * mask[t]
        d_c = masked * update * (1 - c * c)
        d_rh = candidate.T @ d_c
        d_g = np.concatenate([d_rh * before * reset * (1 - reset),
                              masked * (c - before) * update * (1 - update)])
        d_weights[2 * units:] += d_c @ (reset * before).T
        d_weights[:2 * units] += d_g @ before.T
        d_inputs[t, :2 * units], d_inputs[t, 2 * units:] = d_g, d_c
        carried = d - masked * update + d_rh * reset + gates.T @ d_g
    return d_weights, d_inputs


def sum_by(index, values, size):
    """Rows of ``values`` summed into ``size`` rows by ``index``."""
    out = np.zeros((size, values.shape[1]), "f4")
    if len(index):
        order = np.argsort(index, kind="stable")
        sorted_index = index[order]
        starts = np.flatnonzero(np.r_[True, sorted_index[1:] != sorted_index[:-1]])
        out[sorted_index[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


class Adam:
    def __init__(self, params, rate):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads):
        self.t += 1
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9 ** self.t), self.v[k] / (1 - 0.99 ** self.t)
            self.params[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype("f4")


def windows(lengths, size, stride):
    """All windows of sequences: arrays (sequence, start, length, first position not in an earlier window).

    A sequence of at most ``size`` is one window; of a longer one every window is full, the last
    ends where the sequence ends. Empty sequences have none.
    """
    parts = []
    for i, n in enumerate(lengths):
        if 0 < n <= size:
            parts.append(np.array([[i, 0, n, 0]]))
        elif n > size:
            starts = np.arange(0, n - size, stride)
            starts = np.append(starts, n - size)
            seen = np.r_[0, starts[:-1] + size]
            parts.append(np.stack([np.full(len(starts), i), starts, np.full(len(starts), size),
                                   seen - starts], 1))
    return np.concatenate(parts).T if parts else np.zeros((4, 0), "i8")


def batches(found, size, batch):
    """Windows in batches of similar length: (chosen windows, positions (time, batch), inside)."""
    order = np.argsort(-found[2], kind="stable")
    for i in range(0, len(order), batch):
        chosen = order[i:i + batch]
        longest = int(found[2][chosen[0]])
        at = np.arange(longest)[:, None]
        yield chosen, at, at < found[2][chosen][None]
