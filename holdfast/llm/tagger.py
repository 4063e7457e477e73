"""A character tagger: bidirectional LSTM with CRF transitions, in numpy.

Tags are 0 (nothing) and one per kind. A kind follows itself or 0 only. Texts of any length are cut into
windows that overlap; every character takes the scores of the window in which it is farther from an edge, and the
best path is that of the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from holdfast.llm.recurrent import Adam, both_gradients, both_ways

HIDDEN = 8
#: Characters: 0 is padding, ASCII has one number each, all others share one.
ALPHABET = 130
WINDOW, OVERLAP = 256, 32
#: Windows that are decoded at once.
ROWS = 512
NEVER = -1e4
SEED = 42


def numbers(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return (np.minimum(codes, ALPHABET - 2) + 1).astype(np.uint8)


def allowed(tags: int) -> np.ndarray:
    """0 for transitions (from, to) that exist, else NEVER."""
    out = np.full((tags, tags), NEVER)
    out[0, :] = out[:, 0] = 0
    np.fill_diagonal(out, 0)
    return out


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def crf_gradients(scores: np.ndarray, moves: np.ndarray, gold: np.ndarray):
    """Mean loss, and slopes of the scores (steps, rows, tags) and transitions. No padding."""
    steps, rows, tags = scores.shape
    ahead, back = np.zeros_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0]
    for t in range(1, steps):
        ahead[t] = scores[t] + log_sum(ahead[t - 1][:, :, None] + moves, 1)
    for t in range(steps - 2, -1, -1):
        back[t] = log_sum(moves + (scores[t + 1] + back[t + 1])[:, None, :], 2)
    total = log_sum(ahead[-1], 1)
    slope = np.exp(ahead + back - total[None, :, None])
    pairs = ahead[:-1, :, :, None] + moves + (scores[1:] + back[1:])[:, :, None, :] - total[None, :, None, None]
    move_slope = np.exp(pairs).sum(axis=(0, 1))
    t, r = np.meshgrid(np.arange(steps), np.arange(rows), indexing="ij")
    loss = (total - scores[t, r, gold].sum(axis=0) - moves[gold[:-1], gold[1:]].sum(axis=0)).mean()
    slope[t, r, gold] -= 1
    np.add.at(move_slope, (gold[:-1], gold[1:]), -1)
    return loss, slope / rows, move_slope / rows


@dataclass
class Tagger:
    values: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, tags: int, seed: int = SEED) -> Tagger:
        random = np.random.default_rng(seed)
        values = {
            "forward": random.standard_normal((ALPHABET, 4 * HIDDEN)) * 0.5,
            "backward": random.standard_normal((ALPHABET, 4 * HIDDEN)) * 0.5,
            "weights_0": random.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.3,
            "weights_1": random.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.3,
            "out": random.standard_normal((2 * HIDDEN, tags)) * 0.3,
            "bias": np.zeros(tags),
            "moves": np.zeros((tags, tags)),
        }
        for name in ("forward", "backward"):
            values[name][:, HIDDEN : 2 * HIDDEN] += 1  # remember at first
        return cls(values)

    def train(self, texts: np.ndarray, tags: np.ndarray, steps: int, rows: int = 64, rate: float = 0.02) -> list[float]:
        """Fit to windows (n, length) of character numbers and their tags. Returns the losses."""
        v, random = self.values, np.random.default_rng(SEED)
        adam, losses = Adam(v, rate), []
        free = allowed(len(v["bias"])) == 0
        for step in range(steps):
            chosen = random.choice(len(texts), min(rows, len(texts)), replace=False)
            x, gold = texts[chosen].T.astype(np.int64), tags[chosen].T.astype(np.int64)
            mask = np.ones(x.shape)
            weights = [v["weights_0"], v["weights_1"]]
            states, kept = both_ways(v["forward"][x], v["backward"][x], weights, mask)
            moves = np.where(free, v["moves"], NEVER)
            loss, slope, move_slope = crf_gradients(states @ v["out"] + v["bias"], moves, gold)
            forward, backward, inner = both_gradients(slope @ v["out"].T, kept, weights, mask)
            slopes = {
                "out": np.einsum("trh,trk->hk", states, slope),
                "bias": slope.sum(axis=(0, 1)),
                "moves": np.where(free, move_slope, 0),
                "weights_0": inner[0],
                "weights_1": inner[1],
                "forward": _per_character(x, forward),
                "backward": _per_character(x, backward),
            }
            adam.update(slopes, rate=1 - 0.9 * step / steps)
            losses.append(float(loss))
        return losses

    def narrow(self) -> dict[str, np.ndarray]:
        """Weights in single precision, with the halving of sigmoid gates folded in."""
        v = self.values
        half = np.ones(4 * HIDDEN)
        half[: 3 * HIDDEN] = 0.5
        tables = np.stack([v["forward"] * half, v["backward"] * half]).astype(np.float32)
        tables[:, 0, : 3 * HIDDEN] = -30  # padding leaves the state at 0
        weights = np.stack([v["weights_0"] * half, v["weights_1"] * half]).astype(np.float32)
        moves = np.where(allowed(len(v["bias"])) == 0, v["moves"], NEVER).astype(np.float32)
        return {"tables": tables, "weights": weights, "moves": moves, "out": v["out"].astype(np.float32), "bias": v["bias"].astype(np.float32)}


def _per_character(x: np.ndarray, slopes: np.ndarray) -> np.ndarray:
    flat = slopes.reshape(-1, slopes.shape[2])
    return np.stack([np.bincount(x.ravel(), flat[:, i], ALPHABET) for i in range(flat.shape[1])], axis=1)


def scores(narrow: dict[str, np.ndarray], windows: np.ndarray) -> np.ndarray:
    """(length, rows, tags) of windows (rows, length) of character numbers."""
    rows, length = windows.shape
    tables, weights = narrow["tables"], narrow["weights"]
    steps = np.ascontiguousarray(windows.T).astype(np.intp)
    gates = np.empty((2, rows, 4 * HIDDEN), np.float32)
    inner = np.empty_like(gates)
    state, cell = np.zeros((2, rows, HIDDEN), np.float32), np.zeros((2, rows, HIDDEN), np.float32)
    states = np.empty((2, length, rows, HIDDEN), np.float32)
    product = np.empty_like(cell)
    for t in range(length):
        np.take(tables[0], steps[t], axis=0, out=gates[0], mode="clip")
        np.take(tables[1], steps[length - 1 - t], axis=0, out=gates[1], mode="clip")
        np.matmul(state, weights, out=inner)
        np.add(gates, inner, out=gates)
        np.tanh(gates, out=gates)
        switch = gates[:, :, : 3 * HIDDEN]
        switch *= 0.5
        switch += 0.5
        np.multiply(gates[:, :, HIDDEN : 2 * HIDDEN], cell, out=cell)
        np.multiply(gates[:, :, :HIDDEN], gates[:, :, 3 * HIDDEN :], out=product)
        cell += product
        np.tanh(cell, out=state)
        state *= gates[:, :, 2 * HIDDEN : 3 * HIDDEN]
        states[0, t], states[1, length - 1 - t] = state[0], state[1]
    emitted = states[0] @ narrow["out"][:HIDDEN] + states[1] @ narrow["out"][HIDDEN:] + narrow["bias"]
    emitted[steps == 0] = [0, *[NEVER] * (emitted.shape[2] - 1)]  # nothing is tagged beyond a text
    return emitted


def best_tags(emitted: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """(rows, length): the best path of each window, by Viterbi."""
    length, rows, tags = emitted.shape
    emitted = np.ascontiguousarray(emitted.transpose(0, 2, 1))
    stay, enter, leave = np.diag(moves)[1:, None], moves[0, 1:, None], moves[1:, 0, None]
    came = np.empty((length, tags, rows), np.int8)
    own = np.arange(1, tags, dtype=np.int8)[:, None]
    best = emitted[0].copy()
    for t in range(1, length):
        kind, none = best[1:], best[0]
        out = kind + leave
        from_kind = out.argmax(axis=0)
        leaving = out.max(axis=0)
        staying = none + moves[0, 0]
        came[t, 0] = np.where(leaving > staying, from_kind + 1, 0)
        on, begun = kind + stay, none + enter
        came[t, 1:] = np.where(begun > on, 0, own)
        best = np.concatenate([np.maximum(leaving, staying)[None], np.maximum(on, begun)]) + emitted[t]
    path = np.empty((length, rows), np.int8)
    path[-1] = best.argmax(axis=0)
    every = np.arange(rows)
    for t in range(length - 1, 0, -1):
        path[t - 1] = came[t, path[t], every]
    return path.T


def certainty(moves: np.ndarray) -> float:
    """By how much the score of tag 0 must exceed all others at a character for every best path to have it there: what a
    path could gain at most by its transitions into and out of another tag."""
    gains = [
        moves[a, k] + moves[k, b] - moves[a, 0] - moves[0, b] for k in range(1, len(moves)) for a in (0, k) for b in (0, k)
    ]
    return max(0.0, *gains)


def tag_texts(narrow: dict[str, np.ndarray], texts: list[str]) -> list[np.ndarray]:
    """The tag of every character of each text, by the best path over the whole text.

    Every character is scored in the window in which it is farther from an edge. Where tag 0 is certain the path is cut,
    as it passes there whatever is on either side; the pieces between such characters are decoded, across all seams.
    """
    stride, margin = WINDOW - OVERLAP, OVERLAP // 2
    moves = narrow["moves"]
    sure = certainty(moves)
    # A run of a kind is worth its characters' scores and stays, above those of nothing, less the price of entering and leaving:
    # pieces whose characters cannot pay the least price hold nothing.
    stay = np.diag(moves)[1:] - moves[0, 0]
    price = max(0.0, float((np.diag(moves)[1:] + moves[0, 0] - moves[0, 1:] - moves[1:, 0]).min()))
    coded = [numbers(text) for text in texts]
    places = [(i, start) for i, code in enumerate(coded) for start in range(0, max(1, len(code) - OVERLAP), stride)]
    scored: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in texts]
    places.sort(key=lambda place: min(WINDOW, len(coded[place[0]]) - place[1]))  # windows of like length together
    for a in range(0, len(places), ROWS):
        part = places[a : a + ROWS]
        longest = max(min(WINDOW, len(coded[i]) - start) for i, start in part)
        if not longest:
            continue
        windows = np.zeros((len(part), longest + 1), np.uint8)
        for row, (i, start) in enumerate(part):
            piece = coded[i][start : start + WINDOW]
            windows[row, : len(piece)] = piece
        emitted = scores(narrow, windows)
        unsure = emitted[:, :, 0] - emitted[:, :, 1:].max(axis=2) <= sure
        for row in np.flatnonzero(unsure.any(axis=0)):
            i, start = part[row]
            end = min(start + WINDOW, len(coded[i]))
            first = margin if start else 0
            last = end - start if end == len(coded[i]) else end - start - margin
            found = first + np.flatnonzero(unsure[first:last, row])
            if len(found):
                scored[i].append((start, start + found, emitted[found, row]))
    out = [np.zeros(len(code), np.int8) for code in coded]
    pieces: list[tuple[int, int, np.ndarray]] = []
    for i, windows in enumerate(scored):
        if windows:
            windows.sort(key=lambda window: window[0])
            at, emitted = (np.concatenate([window[j] for window in windows]) for j in (1, 2))
            starts = np.flatnonzero(np.r_[True, np.diff(at) > 1])
            ends = np.r_[starts[1:], len(at)]
            worth = np.add.reduceat(np.maximum((emitted[:, 1:] - emitted[:, :1] + stay).max(axis=1), 0), starts)
            pieces += [(i, int(at[a]), emitted[a:b]) for a, b in zip(starts[worth > price], ends[worth > price])]
    pieces.sort(key=lambda piece: len(piece[2]))
    done = 0
    while done < len(pieces):
        # Pieces of like length together, in as many rows as a batch of windows has characters for.
        rows = max(1, WINDOW * ROWS // (len(pieces[min(len(pieces), done + ROWS) - 1][2]) + 2))
        part = pieces[done : done + min(rows, ROWS)]
        done += len(part)
        nothing = np.array([0, *[NEVER] * (len(narrow["moves"]) - 1)], np.float32)
        emitted = np.tile(nothing, (len(part[-1][2]) + 2, len(part), 1))
        for row, (_, _, found) in enumerate(part):
            emitted[1 : len(found) + 1, row] = found
        tags = best_tags(emitted, narrow["moves"])
        for row, (i, start, found) in enumerate(part):
            out[i][start : start + len(found)] = tags[row, 1 : len(found) + 1]
    return out
