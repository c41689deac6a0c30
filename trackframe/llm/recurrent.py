"""A gated recurrent language model in numpy with a class-factored output.

The vocabulary has `classes * width` head words in classes of equal size and `tails` buckets for all other words. A step's
output is a softmax over head classes and tail buckets, times a softmax within the head class; what a tail bucket's probability
is worth for one of its words is left to the caller. Training is truncated backpropagation through time over windows, with the
state carried from window to window and reset where a document begins; scoring carries the state through the whole document.
"""

from __future__ import annotations

import heapq

import numpy as np

F32 = np.float32
#: Steps of a window, in training and in scoring.
WINDOW = 32
#: Rows whose logits are computed at once.
ROWS = 1024
#: Rows of an id that are summed together with other ids' rows.
FEW = 8


class Shape:
    def __init__(self, hidden: int = 32, classes: int = 64, width: int = 64, tails: int = 64):
        self.hidden, self.classes, self.width, self.tails = hidden, classes, width, tails
        self.head = classes * width
        self.inputs = self.head + tails
        self.outputs = classes + tails


def initial(shape: Shape, unigram: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random weights; the output's constants start at the unigram frequencies of the inputs."""
    rng = np.random.default_rng(seed)
    h = shape.hidden
    p = np.maximum(unigram.astype(np.float64), 0.1)
    head = p[: shape.head].reshape(shape.classes, shape.width)
    outer = np.concatenate((head.sum(axis=1), p[shape.head :]))
    return {
        "x": rng.normal(0, 0.1, (shape.inputs, 3 * h)).astype(F32),
        "u": rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)).astype(F32),
        "c": rng.normal(0, 0.05, (h, shape.outputs)).astype(F32),
        "cb": np.log(outer / outer.sum()).astype(F32),
        "w": rng.normal(0, 0.05, (shape.classes, h, shape.width)).astype(F32),
        "wb": np.log(head / head.sum(axis=1, keepdims=True)).astype(F32),
    }


def _gates(matrix: np.ndarray, h: int) -> np.ndarray:
    """(3, rows, h) of a matrix of (rows, 3 * h): the update gate, the reset gate and the candidate, each contiguous."""
    return np.ascontiguousarray(matrix.reshape(-1, 3, h).transpose(1, 0, 2))


def _scaled(matrix: np.ndarray, h: int) -> np.ndarray:
    """`_gates`, the two gates negated and the candidate times -2: what exp is taken of in the sigmoid and in
    tanh(n) = 2 / (1 + exp(-2 n)) - 1. Both are exact."""
    gates = _gates(matrix, h)
    gates *= np.array([-1, -1, -2], dtype=gates.dtype)[:, None, None]
    return gates


def run_window(p: dict[str, np.ndarray], ids: np.ndarray, state: np.ndarray, resets: np.ndarray | None = None, record: np.ndarray | None = None) -> np.ndarray:
    """States after each of the inputs `ids` (steps, streams). resets: where a stream's state is zeroed before the step. record: array of
    (steps, 4, streams, h), which receives each step's update gate, reset gate, candidate and scaled recurrent part of the candidate."""
    streams, h = state.shape
    states = np.empty((*ids.shape, h), dtype=F32)
    u, table = _scaled(p["u"], h), _scaled(p["x"], h)
    x, own = np.empty((3, streams, h), dtype=table.dtype), np.empty((4, streams, h), dtype=u.dtype)
    some = np.zeros(len(ids), dtype=bool) if resets is None else resets.any(axis=1)
    for t in range(len(ids)):
        if some[t]:
            state = state * ~resets[t][:, None]
        if record is not None:
            own = record[t]
        gates, n, recurrent = own[:2], own[2], own[3]
        np.take(table, ids[t], axis=1, out=x, mode="clip")
        np.matmul(state, u[:2], out=gates)
        np.matmul(state, u[2], out=recurrent)
        gates += x[:2]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[1], recurrent, out=n)
        n += x[2]
        np.exp(n, out=n)
        n += 1
        np.divide(2, n, out=n)
        n -= 1
        after = states[t]
        np.subtract(state, n, out=after, casting="same_kind")
        after *= gates[0]
        after += n
        state = after
    return states


def _bounded(weights: np.ndarray, constants: np.ndarray) -> bool:
    """Whether no logit can leave what exp holds: states lie between -1 and 1."""
    return float(np.abs(weights).sum(axis=-2).max() + np.abs(constants).max()) < 80


def _softmax(logits: np.ndarray, target: np.ndarray, bounded: bool, gradient: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities (natural) of the targets, and the rows' sums of exponentials, which take the place of the logits. They are left
    undivided: states and products, which are smaller, are divided by the sums instead. gradient: the sum is taken from the target's own."""
    if not bounded:
        logits -= logits.max(axis=1, keepdims=True)
    flat, at = logits.reshape(-1), np.arange(0, logits.size, logits.shape[1]) + target
    found = flat[at]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], dtype=logits.dtype)
    found -= np.log(total)
    if gradient:
        flat[at] -= total
    return found, total


def outputs(shape: Shape, p: dict, states: np.ndarray, targets: np.ndarray, gradients: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probabilities of `targets` after `states` (rows), and the gradient of the states if `gradients` is to be filled. Rows are
    sorted by target, and the softmaxes go over `ROWS` at once, which the processor's cache holds: one over classes and buckets and, for
    head words, one within the class, where only the products are taken class by class. A last column of ones brings the constants in."""
    h, filled = shape.hidden, gradients is not None
    order = np.argsort(targets.astype(np.int16) if shape.inputs < 2**15 else targets, kind="stable")
    targets = targets[order]
    found = np.empty(len(order), dtype=np.result_type(states, p["c"]))
    own = np.ones((len(order), h + 1), dtype=found.dtype)
    own[:, :h] = states[order]
    back = np.empty((len(order), h), dtype=found.dtype) if filled else None
    outer = np.where(targets < shape.head, targets // shape.width, targets - shape.head + shape.classes)
    ends = np.searchsorted(outer, np.arange(shape.classes + 1)).tolist()
    c, w = np.concatenate((p["c"], p["cb"][None])), np.concatenate((p["w"], p["wb"][:, None]), axis=1)
    to_c, to_w = (np.zeros_like(np.swapaxes(a, -1, -2), order="C") if filled else None for a in (c, w))
    bounded = _bounded(p["c"], p["cb"]), _bounded(p["w"], p["wb"])
    for at in range(0, len(order), ROWS):
        stop = min(at + ROWS, len(order))
        e = own[at:stop] @ c
        found[at:stop], total = _softmax(e, outer[at:stop], bounded[0], filled)
        if filled:
            share = (1 / total)[:, None]
            to_c += e.T @ (own[at:stop] * share)
            np.matmul(e, p["c"].T, out=back[at:stop])
            back[at:stop] *= share
        stop = min(stop, ends[-1])
        if at >= stop:
            continue
        parts = [(k, slice(max(at, ends[k]) - at, min(stop, ends[k + 1]) - at)) for k in range(int(outer[at]), int(outer[stop - 1]) + 1)]
        rows, e = own[at:stop], np.empty((stop - at, shape.width), dtype=found.dtype)
        for k, part in parts:
            np.matmul(rows[part], w[k], out=e[part])
        more, total = _softmax(e, targets[at:stop] - outer[at:stop] * shape.width, bounded[1], filled)
        found[at:stop] += more
        if filled:
            share = (1 / total)[:, None]
            rows, through = rows * share, np.empty((stop - at, h), dtype=found.dtype)
            for k, part in parts:
                to_w[k] += e[part].T @ rows[part]
                np.matmul(e[part], p["w"][k].T, out=through[part])
            through *= share
            back[at:stop] += through
    result = np.empty_like(found)
    result[order] = found
    if not filled:
        return result, None
    for name, whole in (("c", to_c), ("w", to_w)):
        gradients[name] += np.swapaxes(whole[..., :h], -1, -2)
        gradients[name + "b"] += whole[..., h]
    unsorted = np.empty_like(back)
    unsorted[order] = back
    return result, unsorted


def _summed(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and the sums of each one's rows of `values` (parts, rows, h) as (parts, ids, h): of ids with up to `FEW`
    rows for all of them at once, a row of each at a time, and of the others, which are not many, for each by itself."""
    order = np.argsort(ids.astype(np.int16) if ids.max(initial=0) < 2**15 else ids, kind="stable")
    ids, rows = ids[order], np.take(values, order, axis=1)
    firsts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    n = np.diff(firsts, append=len(ids))
    sums = np.take(rows, firsts, axis=1)
    for j in range(1, FEW):
        at = np.flatnonzero((n > j) & (n <= FEW))
        sums[:, at] += np.take(rows, firsts[at] + j, axis=1)
    for k in np.flatnonzero(n > FEW).tolist():
        np.add.reduce(rows[:, firsts[k] : firsts[k] + n[k]], axis=1, out=sums[:, k])
    return ids[firsts], sums


def train(shape: Shape, p: dict[str, np.ndarray], memory: dict[str, np.ndarray], documents: list[np.ndarray], begin: int, rate: float = 0.1, streams: int = 128, seed: int = 0) -> float:
    """One pass over documents (ids that end with `begin`), in place, by Adagrad; memory holds its sums of squares. Returns the
    mean log probability of a token."""
    if not documents:
        return 0.0
    order = np.random.default_rng(seed).permutation(len(documents))
    tokens = np.concatenate([documents[i] for i in order])
    streams = max(1, min(streams, len(tokens) // WINDOW))
    steps = -(-len(tokens) // streams)
    tokens = np.resize(tokens, steps * streams).reshape(streams, steps).T
    inputs = np.vstack((np.full((1, streams), begin, dtype=tokens.dtype), tokens[:-1]))
    h, state, seen = shape.hidden, np.zeros((streams, shape.hidden), dtype=F32), 0.0
    kind = p["u"].dtype
    for at in range(0, steps, WINDOW):
        ids, targets = inputs[at : at + WINDOW], tokens[at : at + WINDOW]
        resets, record = ids == begin, np.empty((len(ids), 4, streams, h), dtype=kind)
        states = run_window(p, ids, state, resets, record)
        before = np.concatenate((state[None], states[:-1]))
        before[resets] = 0
        state = states[-1]
        g = {k: np.zeros_like(p[k]) for k in ("c", "cb", "w", "wb")}
        found, back = outputs(shape, p, states.reshape(-1, h), targets.reshape(-1), g)
        seen += float(found.sum())
        back = back.reshape(states.shape)
        z, r, n, recurrent = (record[:, k] for k in range(4))
        # what the gradient of a step's state is multiplied by, for all steps at once: towards the candidate, the update gate, the reset
        # gate and the candidate's recurrent part; the first three belong to x and the last three to u
        to, rest = np.empty_like(record), 1 - z
        to_n, to_z, to_r, to_g = (to[:, k] for k in range(4))
        np.multiply(n, n, out=to_n)
        np.subtract(1, to_n, out=to_n)
        to_n *= rest
        np.subtract(before, n, out=to_z)
        to_z *= z
        to_z *= rest
        np.multiply(to_n, r, out=to_g)
        np.subtract(1, r, out=rest)
        rest *= recurrent
        rest *= -0.5  # the recurrent part was scaled by -2
        np.multiply(to_g, rest, out=to_r)
        ut, dg = np.ascontiguousarray(_gates(p["u"], h).transpose(0, 2, 1)), np.empty((4, *ids.shape, h), dtype=kind)
        d, through, some = np.zeros(state.shape, dtype=kind), np.empty((3, *state.shape), dtype=kind), resets.any(axis=1)
        for t in range(len(ids) - 1, -1, -1):
            d += back[t]
            np.multiply(d, to[t], out=dg[:, t])
            np.matmul(dg[1:, t], ut, out=through)
            d *= z[t]
            for part in through:
                d += part
            if some[t]:
                d *= ~resets[t][:, None]
        dg = dg.reshape(4, -1, h)
        own = np.matmul(before.reshape(-1, h).T, dg[1:])
        g["u"] = np.ascontiguousarray(own.transpose(1, 0, 2)).reshape(h, 3 * h)
        scale = F32(1 / ids.shape[1])
        for k, value in g.items():
            value *= scale
            np.clip(value, -1, 1, out=value)
            memory[k] += value * value
            p[k] -= rate * value / np.sqrt(memory[k])
        rows, value = _summed(ids.reshape(-1), dg[:3])
        value = np.clip(np.concatenate((value[1], value[2], value[0]), axis=1) * scale, -1, 1)
        held = memory["x"][rows] + value * value
        memory["x"][rows] = held
        p["x"][rows] -= rate * value / np.sqrt(held)
    return seen / tokens.size


def dealt(lengths: np.ndarray, streams: int) -> list[list[int]]:
    """Documents dealt to streams, the longest first and each to the stream that is shortest so far; longest stream first."""
    heap = [(0, k) for k in range(min(streams, len(lengths)))]
    held: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-lengths, kind="stable").tolist():
        total, k = heapq.heappop(heap)
        held[k].append(i)
        heapq.heappush(heap, (total + int(lengths[i]), k))
    return sorted(held, key=lambda own: -sum(int(lengths[i]) for i in own))


def score(shape: Shape, p: dict[str, np.ndarray], documents: list[np.ndarray], begin: int, streams: int = 512) -> np.ndarray:
    """Natural log probability of each document (ids that end with `begin`), whole, with the state carried across windows. Documents
    follow one another in streams, with the state zeroed where one begins, so they don't depend on each other."""
    if not documents:
        return np.zeros(0)
    held = dealt(np.array([len(d) for d in documents]), streams)
    turn = [i for own in held for i in own]
    tokens = np.concatenate([documents[i] for i in turn])
    owners = np.repeat(turn, [len(documents[i]) for i in turn])
    lengths = np.array([sum(len(documents[i]) for i in own) for own in held])
    firsts = np.cumsum(lengths) - lengths
    scores = np.zeros(len(tokens))
    state, last = np.zeros((len(held), shape.hidden), dtype=F32), np.full(len(held), begin, dtype=tokens.dtype)
    for start in range(0, int(lengths[0]), WINDOW):
        live = int(np.searchsorted(-lengths, -start, side="left"))  # streams longer than `start`
        reached = np.arange(start, min(start + WINDOW, int(lengths[0])))[:, None]
        places, inside = firsts[:live] + reached, None
        if reached[-1, 0] < lengths[live - 1]:
            targets = tokens[places]
        else:
            inside = reached < lengths[:live]
            targets = np.where(inside, tokens[np.minimum(places, len(tokens) - 1)], last.dtype.type(begin))
        ids = np.vstack((last[None, :live], targets[:-1]))
        states = run_window(p, ids, state[:live], ids == begin)
        state, last = states[-1], targets[-1]
        seen, aims, places = states.reshape(-1, shape.hidden), targets.reshape(-1), places.reshape(-1)
        if inside is not None:
            at = np.flatnonzero(inside)
            seen, aims, places = seen[at], aims[at], places[at]
        scores[places] = outputs(shape, p, seen, aims)[0]
    return np.bincount(owners, weights=scores, minlength=len(documents))
