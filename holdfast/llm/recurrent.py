"""A small bidirectional LSTM in numpy: forward, backward, Adam."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def lstm(inputs: np.ndarray, weights: np.ndarray, mask: np.ndarray):
    """States (steps, rows, hidden) of one direction, and what its backward pass needs.

    `inputs` (steps, rows, 4 hidden) are the projected inputs, gates in the order in, forget, out,
    new; where `mask` (steps, rows) is 0 the state is 0.
    """
    steps, rows, wide = inputs.shape
    hidden = wide // 4
    state, cell = np.zeros((rows, hidden)), np.zeros((rows, hidden))
    kept = []
    states = np.zeros((steps, rows, hidden))
    for t in range(steps):
        gates = inputs[t] + state @ weights
        gates[:, : 3 * hidden] = sigmoid(gates[:, : 3 * hidden])
        gates[:, 3 * hidden :] = np.tanh(gates[:, 3 * hidden :])
        into, forget, out, new = np.split(gates, 4, axis=1)
        live = mask[t][:, None]
        before = (state, cell)
        cell = (forget * cell + into * new) * live
        squashed = np.tanh(cell)
        state = out * squashed * live
        states[t] = state
        kept.append((gates, before, squashed))
    return states, kept


def lstm_gradients(slopes: np.ndarray, kept, weights: np.ndarray, mask: np.ndarray):
    """Slopes of the projected inputs and of the weights, from those of the states."""
    steps, rows, hidden = slopes.shape
    inputs, weight = np.zeros((steps, rows, 4 * hidden)), np.zeros_like(weights)
    state, cell = np.zeros((rows, hidden)), np.zeros((rows, hidden))
    for t in range(steps - 1, -1, -1):
        gates, (state_before, cell_before), squashed = kept[t]
        into, forget, out, new = np.split(gates, 4, axis=1)
        live = mask[t][:, None]
        state = (state + slopes[t]) * live
        cell = (cell + state * out * (1 - squashed**2)) * live
        slope = np.concatenate(
            [
                cell * new * into * (1 - into),
                cell * cell_before * forget * (1 - forget),
                state * squashed * out * (1 - out),
                cell * into * (1 - new**2),
            ],
            axis=1,
        )
        inputs[t] = slope
        weight += state_before.T @ slope
        state = slope @ weights.T
        cell = cell * forget
    return inputs, weight


def both_ways(forward: np.ndarray, backward: np.ndarray, weights, mask: np.ndarray):
    """States of both directions side by side, in the order of the steps."""
    ahead, kept_ahead = lstm(forward, weights[0], mask)
    back, kept_back = lstm(backward[::-1], weights[1], mask[::-1])
    return np.concatenate([ahead, back[::-1]], axis=2), (kept_ahead, kept_back)


def both_gradients(slopes: np.ndarray, kept, weights, mask: np.ndarray):
    hidden = slopes.shape[2] // 2
    forward, first = lstm_gradients(slopes[:, :, :hidden], kept[0], weights[0], mask)
    backward, second = lstm_gradients(slopes[::-1, :, hidden:], kept[1], weights[1], mask[::-1])
    return forward, backward[::-1], [first, second]


class Adam:
    def __init__(self, values: dict[str, np.ndarray], rate: float):
        self.values, self.rate, self.step = values, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in values.items()}
        self.square = {k: np.zeros_like(v) for k, v in values.items()}

    def update(self, slopes: dict[str, np.ndarray], rate: float = 1.0) -> None:
        """One step against `slopes`, clipped to a norm of 5; `rate` scales the step."""
        self.step += 1
        norm = np.sqrt(sum((s * s).sum() for s in slopes.values()))
        for name, slope in slopes.items():
            slope = slope * min(1.0, 5 / (norm + 1e-12))
            self.mean[name] = 0.9 * self.mean[name] + 0.1 * slope
            self.square[name] = 0.999 * self.square[name] + 0.001 * slope * slope
            mean = self.mean[name] / (1 - 0.9**self.step)
            square = self.square[name] / (1 - 0.999**self.step)
            self.values[name] -= self.rate * rate * mean / (np.sqrt(square) + 1e-8)
