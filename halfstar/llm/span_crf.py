"""Labelled spans of characters: a bidirectional LSTM with CRF transitions, trained and run in NumPy.

Tags are O and, for each kind, the first and the following characters of a span. Gates and cells are piecewise linear
(clipped instead of sigmoid and tanh), so that a step is a small matrix product and a few clips over many windows at
once. Training maximises the CRF's likelihood of labelled windows by Adam.

Long texts are run as overlapping windows. Each window is decoded by itself; a character takes the tag of the window in whose
middle it lies, and spans are read off the tags of the whole text, so one that crosses windows stays whole. Windows in which no
other path can beat that of only O, by a bound on emissions and transitions, are not decoded further; that changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Cells of a direction and size of a character's embedding.
CELLS, EMBEDDING = 8, 4
#: Characters: ASCII, others below U+2000, others; and what lies outside a text.
PAD = 130
#: Characters of a window, and of the overlap of two.
WINDOW, OVERLAP = 512, 32
#: Windows that are run side by side; a multiple of WIDTH, so that sums do not depend on where a window stands.
SIDE, WIDTH = 2048, 256
#: Passes over the training windows, windows of a step, step size, seed.
EPOCHS, STEP, RATE, SEED = 6, 32, 0.02, 7

#: The score of what cannot be, and what rounding may add up to along a path.
_NEVER, SLACK = -1e4, 1e-3


class Model(NamedTuple):
    """Weights of both directions, emissions and transitions; kinds and the evidence that a span of each needs."""

    kinds: tuple[str, ...]
    embeddings: list[np.ndarray]
    weights: list[np.ndarray]
    emit: np.ndarray
    bias: np.ndarray
    transitions: np.ndarray
    evidence: np.ndarray


def characters(text: str) -> np.ndarray:
    """A small number for each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.minimum(points, 128).astype(np.uint8)
    out += points >= 0x2000
    return out


def tags_of(spans: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Tags of ``n`` characters from spans ``(kind, start, end)``."""
    tags = np.zeros(n, dtype=np.uint8)
    for kind, start, end in spans:
        tags[max(start, 0) : max(end, 0)] = 2 + 2 * kind
        if 0 <= start < n:
            tags[start] = 1 + 2 * kind
    return tags


def read_tags(tags: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Spans ``(window, kind, start, end)`` of tags ``(windows, time)``."""
    out = []
    for w, each in enumerate(tags):
        start = 0
        for t in range(1, len(each) + 1):
            if t == len(each) or each[t] % 2 == 1 or (each[t] + 1) // 2 != (each[t - 1] + 1) // 2:
                if each[start]:
                    out.append((w, (int(each[start]) - 1) // 2, start, t))
                start = t
    return out


def allowed(kinds: int) -> np.ndarray:
    """Transitions that occur: a following character comes after one of its own kind."""
    ok = np.ones((1 + 2 * kinds, 1 + 2 * kinds), dtype=bool)
    for k in range(kinds):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


# training


def _forward(chars: np.ndarray, embedding: np.ndarray, weight: np.ndarray) -> tuple:
    """One direction over ``chars (time, windows)``, with what the way back needs."""
    time, n = chars.shape
    size, h = embedding.shape[0], weight.shape[0] // 4
    inputs, raw = np.ones((time, weight.shape[1], n)), np.empty((time, 4 * h, n))
    cells, out = np.zeros((time + 1, h, n)), np.zeros((time + 1, h, n))
    for t in range(time):
        inputs[t, :size] = embedding[:, chars[t]]
        inputs[t, size : size + h] = out[t]
        a = raw[t] = weight @ inputs[t]
        i, f, o, g = np.clip(a[:h], 0, 1), np.clip(a[h : 2 * h], 0, 1), np.clip(a[2 * h : 3 * h], 0, 1), np.clip(a[3 * h :], -1, 1)
        cells[t + 1] = f * cells[t] + i * g
        out[t + 1] = o * np.clip(cells[t + 1], -1, 1)
    return inputs, raw, cells, out


def _backward(chars: np.ndarray, embedding: np.ndarray, weight: np.ndarray, kept: tuple, grad_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inputs, raw, cells, _ = kept
    time, n = chars.shape
    size, h = embedding.shape[0], weight.shape[0] // 4
    d_weight, d_embedding = np.zeros_like(weight), np.zeros_like(embedding)
    d_h, d_c = np.zeros((h, n)), np.zeros((h, n))

    def slope(x: np.ndarray, low: float) -> np.ndarray:
        return (x > low) & (x < 1)

    for t in range(time - 1, -1, -1):
        a = raw[t]
        i, f, o, g = np.clip(a[:h], 0, 1), np.clip(a[h : 2 * h], 0, 1), np.clip(a[2 * h : 3 * h], 0, 1), np.clip(a[3 * h :], -1, 1)
        d_h = d_h + grad_out[t]
        c = cells[t + 1]
        d_c = d_c + d_h * o * slope(c, -1)
        d_a = np.concatenate([d_c * g * slope(a[:h], 0), d_c * cells[t] * slope(a[h : 2 * h], 0), d_h * np.clip(c, -1, 1) * slope(a[2 * h : 3 * h], 0), d_c * i * slope(a[3 * h :], -1)])
        d_c = d_c * f
        d_weight += d_a @ inputs[t].T
        d_in = weight.T @ d_a
        for e in range(size):
            d_embedding[e] += np.bincount(chars[t], d_in[e], PAD + 1)
        d_h = d_in[size : size + h]
    return d_weight, d_embedding


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def crf(emissions: np.ndarray, tags: np.ndarray, transitions: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log likelihood of ``tags (time, windows)``, and its slopes in emissions ``(time, tags, windows)`` and transitions."""
    time, many, n = emissions.shape
    up, down = np.empty_like(emissions), np.zeros_like(emissions)
    up[0] = emissions[0]
    for t in range(1, time):
        up[t] = emissions[t] + _log_sum(up[t - 1][:, None] + transitions[:, :, None], 0)
    for t in range(time - 2, -1, -1):
        down[t] = _log_sum(transitions[:, :, None] + (emissions[t + 1] + down[t + 1])[None], 1)
    whole = _log_sum(up[-1], 0)
    d_emit = np.exp(up + down - whole)
    d_trans = np.zeros_like(transitions)
    for t in range(1, time):
        d_trans += np.exp(up[t - 1][:, None] + transitions[:, :, None] + (emissions[t] + down[t])[None] - whole).sum(axis=2)
    at, column = np.arange(time)[:, None], np.arange(n)[None]
    np.subtract.at(d_trans, (tags[:-1], tags[1:]), 1)
    loss = whole.sum() - emissions[at, tags, column].sum() - transitions[tags[:-1], tags[1:]].sum()
    d_emit[at, tags, column] -= 1
    return float(loss), d_emit, d_trans


def start(kinds: tuple[str, ...]) -> list[np.ndarray]:
    """Parameters before training: embeddings, weights, emissions, bias, transitions."""
    random = np.random.default_rng(SEED)
    parameters = [random.normal(0, 0.5, (EMBEDDING, PAD + 1)) for _ in range(2)]
    for _ in range(2):
        weight = random.normal(0, 0.25, (4 * CELLS, EMBEDDING + CELLS + 1))
        weight[:, -1] = np.repeat([0.5, 0.8, 0.5, 0.0], CELLS)
        parameters.append(weight)
    many = 1 + 2 * len(kinds)
    return [*parameters, random.normal(0, 0.3, (many, 2 * CELLS)), np.zeros(many), np.zeros((many, many))]


def gradients(parameters: list[np.ndarray], chars: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss of some windows, ``(time, windows)`` both, and its slope in each parameter."""
    ahead, back, w_ahead, w_back, emit, bias, transitions = parameters
    one, two = _forward(chars, ahead, w_ahead), _forward(chars[::-1], back, w_back)
    hidden = np.concatenate([one[3][1:], two[3][1:][::-1]], axis=1)
    emissions = np.matmul(emit, hidden) + bias[:, None]
    ok = allowed((len(bias) - 1) // 2)
    loss, d_e, d_t = crf(emissions, tags, np.where(ok, transitions, _NEVER))
    d_hidden = np.matmul(emit.T, d_e)
    d_one = _backward(chars, ahead, w_ahead, one, d_hidden[:, :CELLS])
    d_two = _backward(chars[::-1], back, w_back, two, d_hidden[::-1, CELLS:])
    d_emit = np.tensordot(d_e, hidden, axes=([0, 2], [0, 2]))
    return loss, [d_one[1], d_two[1], d_one[0], d_two[0], d_emit, d_e.sum(axis=(0, 2)), np.where(ok, d_t, 0)]


def train(chars: np.ndarray, tags: np.ndarray, kinds: tuple[str, ...]) -> Model:
    """A model from windows ``(windows, time)`` of characters and their tags; any number of windows, also none."""
    parameters = start(kinds)
    first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    random, steps = np.random.default_rng(SEED), 0
    total = EPOCHS * -(-len(chars) // STEP)
    for _ in range(EPOCHS):
        order = random.permutation(len(chars))
        for low in range(0, len(chars), STEP):
            some = order[low : low + STEP]
            _, slopes = gradients(parameters, chars[some].T, tags[some].T)
            norm = np.sqrt(sum(float((g * g).sum()) for g in slopes)) / len(some)
            steps += 1
            rate = RATE * (1 - steps / (total + 1))
            for p, g, m, v in zip(parameters, slopes, first, second, strict=True):
                g = g / len(some) * min(1.0, 5.0 / (norm + 1e-12))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-8)
    ok = allowed(len(kinds))
    transitions = np.where(ok, parameters[6], _NEVER).astype(np.float32)
    small = [p.astype(np.float32) for p in parameters[:6]]
    return Model(kinds, small[:2], small[2:4], small[4], small[5], transitions, np.zeros(len(kinds)))


# running


def _run(chars: np.ndarray, embedding: np.ndarray, weight: np.ndarray):
    """Yield the outputs of one direction, step by step; each is overwritten by the next."""
    n, size, h = chars.shape[1], EMBEDDING, CELLS
    inputs = np.zeros((weight.shape[1], n), dtype=np.float32)
    inputs[-1] = 1
    a, c, x = np.empty((4 * h, n), dtype=np.float32), np.zeros((h, n), dtype=np.float32), np.empty((h, n), dtype=np.float32)
    out, first = inputs[size : size + h], inputs[:size]
    gates, i, f, o, g = a[: 3 * h], a[:h], a[h : 2 * h], a[2 * h : 3 * h], a[3 * h :]
    zero, one, less = np.float32(0), np.float32(1), np.float32(-1)
    for step in chars:
        np.take(embedding, step, axis=1, out=first, mode="clip")
        np.matmul(weight, inputs, out=a)
        np.clip(gates, zero, one, out=gates)
        np.clip(g, less, one, out=g)
        np.multiply(c, f, out=c)
        np.multiply(i, g, out=x)
        np.add(c, x, out=c)
        np.clip(c, less, one, out=x)
        np.multiply(o, x, out=out)
        yield out


def _ahead(model: Model, chars: np.ndarray, tags: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """How far each of some tags is ahead of O, for each time from the last to the first; overwritten by the next."""
    emit = np.ascontiguousarray(model.emit[tags] - model.emit[0])
    base = (model.bias[tags] - model.bias[0])[:, None]
    time, n = chars.shape
    ahead = np.empty((time, len(tags), n), dtype=np.float32)
    front, back = np.ascontiguousarray(emit[:, :CELLS]), np.ascontiguousarray(emit[:, CELLS:])
    for t, out in enumerate(_run(chars, model.embeddings[0], model.weights[0])):
        np.matmul(front, out, out=ahead[t])
    part = np.empty((len(tags), n), dtype=np.float32)
    padded = (chars == PAD).any(axis=1)
    for t, out in zip(range(time - 1, -1, -1), _run(chars[::-1], model.embeddings[1], model.weights[1])):
        np.matmul(back, out, out=part)
        np.add(part, ahead[t], out=part)
        np.add(part, base, out=part)
        if padded[t]:
            part[:, chars[t] == PAD] = _NEVER
        yield t, part


def may_hold(model: Model, chars: np.ndarray) -> np.ndarray:
    """Whether another path than that of only O can be the best one, for windows ``(time, windows)``.

    Going backwards, a tag's best way on is to end the span, to go on in it or to begin another, each taken at what the better of a
    kind's two tags gains by it. Unless a span's first tag and what follows it gain more than staying with O, none is best.
    """
    kinds = len(model.kinds)
    gain = model.transitions - model.transitions[0, 0]
    first, second = np.arange(1, 2 * kinds, 2), np.arange(2, 2 * kinds + 1, 2)
    leave = np.maximum(gain[first, 0], gain[second, 0])[:, None]
    stay = np.maximum(gain[first, second], gain[second, second])[:, None]
    another, enter = gain[1:, first].max(), gain[0, first][:, None]
    time, n = chars.shape
    best = np.full((kinds, n), -np.inf, dtype=np.float32)
    on, x = np.zeros((kinds, n), dtype=np.float32), np.empty((kinds, n), dtype=np.float32)  # nothing follows the last time
    begun, inside = np.empty((kinds, n), dtype=np.float32), np.empty((kinds, n), dtype=np.float32)
    for t, part in _ahead(model, chars, np.concatenate([first, second])):
        np.add(part[:kinds], on, out=begun)
        np.add(part[kinds:], on, out=inside)
        np.add(begun, enter if t else np.zeros_like(enter), out=x)
        np.maximum(best, x, out=best)
        if t == 0:
            np.maximum(best, inside, out=best)
        np.add(inside, stay, out=on)
        np.maximum(on, leave, out=on)
        np.maximum(on, begun.max(axis=0) + another, out=on)
    return best.max(axis=0) > -SLACK


def margins(model: Model, chars: np.ndarray) -> np.ndarray:
    """How far each tag is ahead of O at each of ``(time, windows)``."""
    out = np.empty((chars.shape[0], len(model.transitions) - 1, chars.shape[1]), dtype=np.float32)
    for t, part in _ahead(model, chars, np.arange(1, len(model.transitions))):
        out[t] = part
    return out


def viterbi(ahead: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Best tags of ``(time, windows)`` from the margins of all tags but O."""
    time, _, n = ahead.shape
    score = np.concatenate([np.zeros((1, n), dtype=np.float32), ahead[0]])
    came = np.empty((time, len(transitions), n), dtype=np.uint8)
    for t in range(1, time):
        options = score[:, None] + transitions[:, :, None]
        came[t] = options.argmax(axis=0)
        score = np.take_along_axis(options, came[t][None].astype(np.int64), axis=0)[0]
        score[1:] += ahead[t]
    tags = np.empty((time, n), dtype=np.uint8)
    tags[-1] = score.argmax(axis=0)
    for t in range(time - 1, 0, -1):
        tags[t - 1] = came[t][tags[t], np.arange(n)]
    return tags


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and first character of each window, for texts of these sizes; a text has windows up to its end."""
    stride = WINDOW - OVERLAP
    many = np.where(sizes > 0, np.maximum(1, -(-(sizes - OVERLAP) // stride)), 0)
    text = np.repeat(np.arange(len(sizes)), many)
    return text, (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * stride


def spans_of(model: Model, chars: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """Spans ``(text, kind, start, end, evidence)`` of texts whose characters stand one after the other.

    Evidence is the log odds of the span's tags against O, per character.
    """
    text, begin = windows_of(sizes)
    first = np.cumsum(sizes) - sizes
    left = sizes[text] - begin
    found: list[tuple[int, int, int, int, float]] = []
    chosen: list[np.ndarray] = []
    offsets = np.arange(WINDOW)[:, None]

    def columns(at: np.ndarray) -> np.ndarray:
        """Characters of windows, with empty ones up to a full width."""
        n = -(-len(at) // WIDTH) * WIDTH
        out = np.full((WINDOW, n), PAD, dtype=np.uint8)
        index = first[text[at]] + begin[at] + offsets
        inside = offsets < left[at]
        out[:, : len(at)] = np.where(inside, chars[np.minimum(index, len(chars) - 1)], PAD)
        return out

    for low in range(0, len(text), SIDE):
        at = np.arange(low, min(low + SIDE, len(text)))
        chosen.append(at[may_hold(model, columns(at))[: len(at)]])
    at = np.concatenate(chosen) if chosen else np.empty(0, dtype=np.int64)
    # tags and margins of characters that lie in the middle of a decoded window, in order
    places, tags, ahead = [], [], []
    for low in range(0, len(at), WIDTH):
        some = at[low : low + WIDTH]
        each = margins(model, columns(some))
        best = viterbi(each, model.transitions)
        core = (offsets >= np.where(begin[some] > 0, OVERLAP // 2, 0)) & (offsets < np.minimum(left[some], np.where(left[some] > WINDOW, WINDOW - OVERLAP // 2, WINDOW)))
        t, w = np.nonzero((best[:, : len(some)] > 0) & core)
        places.append(first[text[some[w]]] + begin[some[w]] + t)
        tags.append(best[t, w])
        ahead.append(each[t, best[t, w].astype(np.int64) - 1, w])
    if not places:
        return found
    place, tag, margin = (np.concatenate(x) for x in (places, tags, ahead))
    order = np.argsort(place, kind="stable")
    place, tag, margin = place[order], tag[order].astype(np.int64), margin[order].astype(np.float64)
    if not len(place):
        return found
    of = np.searchsorted(np.cumsum(sizes), place, side="right")
    follows = np.zeros(len(place), dtype=bool)
    follows[1:] = (place[1:] == place[:-1] + 1) & (of[1:] == of[:-1]) & (tag[1:] % 2 == 0) & ((tag[1:] + 1) // 2 == (tag[:-1] + 1) // 2)
    starts = np.flatnonzero(~follows)
    ends = np.append(starts[1:], len(place))
    gain = model.transitions.astype(np.float64) - model.transitions[0, 0]
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        kind = (int(tag[a]) - 1) // 2
        here = 1 + 2 * kind
        odds = margin[a:b].sum() + gain[0, here] + gain[here + 1, 0] + (gain[here, here + 1] + (b - a - 2) * gain[here + 1, here + 1] if b - a > 1 else 0)
        text_start = int(first[of[a]])
        found.append((int(of[a]), kind, int(place[a]) - text_start, int(place[b - 1]) + 1 - text_start, float(odds) / (b - a)))
    return found
