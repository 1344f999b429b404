"""A gated recurrent network with a class-factored softmax, in numpy.

The state ``h`` before a token gives its probability as that of its class times that of
the token within its class:

    p(w | h) = softmax(h C + c)[class of w] * softmax(h W_class + w_class)[w]

and the token then moves the state, ``x`` being its embedding times the input weights:

    z, r = sigmoid(x_z + h U_z), sigmoid(x_r + h U_r)
    h' = (1 - z) tanh(x_n + r (h U_n)) + z h

Every document begins with a state of zeros. Training is truncated backpropagation
through time: windows of ``WINDOW`` tokens, with the state, but no gradient, carried
from one window to the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

STATE = 24
EMBEDDING = 16
CLASSES = 48
#: Tokens that a gradient reaches back at most, and streams trained side by side.
WINDOW = 32
STREAMS = 1024
#: Windows of a pass at least: shorter texts are trained in fewer streams.
LEAST_STEPS = 60
#: Tokens of all documents between two looks at the softmax when scoring.
SCORE_WINDOW = 32
#: Positions whose softmax is worked out at once.
AT_ONCE = 1 << 15

NAMES = ("embedding", "input", "bias", "state", "classes", "class_bias", "words", "word_bias")


@dataclass
class Network:
    """Parameters by name, and the first word of each class (words lie class by class)."""

    parameters: dict[str, np.ndarray]
    firsts: np.ndarray

    @property
    def class_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.firsts) - 1), np.diff(self.firsts))


def class_bounds(frequency: np.ndarray) -> np.ndarray:
    """Cut words, most frequent first, into classes of about equal sums of root frequency."""
    mass = np.cumsum(np.sqrt(frequency + 1.0))
    which = np.minimum((mass / mass[-1] * CLASSES).astype(np.int64), CLASSES - 1)
    which[0] = -1  # the most frequent one is a class by itself
    cuts = np.flatnonzero(np.diff(which)) + 1
    return np.concatenate([[0], cuts, [len(frequency)]])


def new_network(frequency: np.ndarray) -> Network:
    """Untrained weights whose biases already give each word its frequency."""
    firsts = class_bounds(frequency)
    pick, size = np.random.default_rng(5), len(frequency)
    share = (frequency + 1.0) / (frequency + 1.0).sum()
    mass = np.add.reduceat(share, firsts[:-1])
    within = share / np.repeat(mass, np.diff(firsts))
    shapes = {
        "embedding": (size, EMBEDDING), "input": (EMBEDDING, 3 * STATE),
        "state": (STATE, 3 * STATE), "classes": (STATE, len(mass)), "words": (size, STATE),
    }
    scales = {"embedding": 0.3, "input": 0.25, "state": 0.2, "classes": 0.05, "words": 0.05}
    parameters = {n: pick.normal(0, scales[n], shape) for n, shape in shapes.items()}
    parameters |= {
        "bias": np.repeat([1.0, 0.0, 0.0], STATE),
        "class_bias": np.log(mass),
        "word_bias": np.log(within),
    }
    return Network({n: parameters[n].astype(np.float32) for n in NAMES}, firsts)


def flatten(network: Network) -> np.ndarray:
    return np.concatenate([network.parameters[n].reshape(-1) for n in NAMES])


def restored(like: Network, values: np.ndarray) -> Network:
    sizes = [like.parameters[n].size for n in NAMES]
    parts = np.split(values.astype(np.float32), np.cumsum(sizes)[:-1])
    shaped = {n: p.reshape(like.parameters[n].shape) for n, p in zip(NAMES, parts, strict=True)}
    return Network(shaped, like.firsts)


def _pull(logits: np.ndarray, targets: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient of the weighted loss by the logits, in their place, and that loss."""
    logits -= logits.max(axis=1, keepdims=True)
    at = np.arange(len(targets))
    wanted = logits[at, targets]
    np.exp(logits, out=logits)
    sums = logits @ np.ones(logits.shape[1], dtype=logits.dtype)
    logits *= (weight / sums)[:, None]
    logits[at, targets] -= weight
    return logits, float((np.log(sums) - wanted) @ weight)


def _log_of(logits: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Logarithms of the targets' probabilities; the logits are used up."""
    logits -= logits.max(axis=1, keepdims=True)
    wanted = logits[np.arange(len(targets)), targets]
    np.exp(logits, out=logits)
    return wanted - np.log(logits @ np.ones(logits.shape[1], dtype=logits.dtype))


def _by_class(network: Network, classes: np.ndarray) -> Iterator[tuple[np.ndarray, slice]]:
    """Rows of each class that has more than one word, and its words."""
    order = np.argsort(classes.astype(np.uint16), kind="stable")  # by radix
    cuts = np.concatenate([[0], np.cumsum(np.bincount(classes, minlength=len(network.firsts) - 1))])
    for c in np.flatnonzero((np.diff(cuts) > 0) & (np.diff(network.firsts) > 1)):
        yield order[cuts[c] : cuts[c + 1]], slice(network.firsts[c], network.firsts[c + 1])


def log_probabilities(network: Network, states: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Natural logarithm of each word's probability in its state."""
    p, classes = network.parameters, network.class_of[words]
    out = np.empty(len(words))
    for low in range(0, len(words), AT_ONCE):
        some = slice(low, low + AT_ONCE)
        logits = states[some] @ p["classes"]
        logits += p["class_bias"]
        part = _log_of(logits, classes[some]).astype(np.float64)
        for rows, members in _by_class(network, classes[some]):
            logits = states[some].take(rows, axis=0) @ p["words"][members].T
            logits += p["word_bias"][members]
            part[rows] += _log_of(logits, words[some][rows] - members.start)
        out[some] = part
    return out


@dataclass
class _Steps:
    """What moves the state, laid out so that every pass over a step is contiguous."""

    by_gates: np.ndarray  # of each word, what it adds to the gates
    by_fresh: np.ndarray
    state_gates: np.ndarray
    state_fresh: np.ndarray

    @classmethod
    def of(cls, p: dict[str, np.ndarray]) -> _Steps:
        inputs, gates = p["embedding"] @ p["input"] + p["bias"], slice(None, 2 * STATE)
        fresh = slice(2 * STATE, None)
        # A sigmoid is a tanh of half its argument.
        parts = (inputs[:, gates] / 2, inputs[:, fresh], p["state"][:, gates] / 2, p["state"][:, fresh])
        return cls(*map(np.ascontiguousarray, parts))

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The next state, and what going back needs."""
        gates = state @ self.state_gates
        gates += self.by_gates.take(word, axis=0)
        np.tanh(gates, out=gates)
        gates += 1.0
        gates *= 0.5
        update, reset = gates[:, :STATE], gates[:, STATE:]
        memory = state @ self.state_fresh
        fresh = reset * memory
        fresh += self.by_fresh.take(word, axis=0)
        np.tanh(fresh, out=fresh)
        moved = state - fresh
        moved *= update
        moved += fresh
        return moved, (update, reset, memory, fresh)


def score(network: Network, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of whole documents, laid end to end in ``words``.

    All documents advance together, the longest first in order, so those that have ended
    drop off the end; states go on from window to window.
    """
    steps = _Steps.of(network.parameters)
    # Documents advance together, so words are read from all over: the fewer bytes the better.
    words = words.astype(np.min_scalar_type(len(network.parameters["embedding"])))
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begins, sizes = offsets[:-1][order], lengths[order]
    state = np.zeros((len(order), STATE), dtype=np.float32)
    totals = np.zeros(len(order))
    longest = int(sizes[0]) if len(sizes) else 0
    for low in range(0, longest, SCORE_WINDOW):
        seen, said, whose = [], [], []
        for at in range(low, min(low + SCORE_WINDOW, longest)):
            active = int(np.searchsorted(-sizes, -at, side="left"))
            word = words[begins[:active] + at]
            state = state[:active]
            seen.append(state)
            said.append(word)
            whose.append(np.arange(active))
            state = steps.step(state, word)[0]
        logs = log_probabilities(network, np.concatenate(seen), np.concatenate(said))
        totals += np.bincount(np.concatenate(whose), logs, minlength=len(totals))
    out = np.empty(len(order))
    out[order] = totals
    return out


def gradients(
    network: Network,
    words: np.ndarray,
    ends: np.ndarray,
    state: np.ndarray,
    real: np.ndarray | None = None,
) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """Mean loss of a window, its gradients, and the state behind it.

    ``words`` has a row per step and a column per stream; ``ends`` marks the last token
    of a document, behind which the state is zero. Places that are not ``real`` fill up
    streams behind their last token and count for nothing.
    """
    p, (steps, streams) = network.parameters, words.shape
    moves = _Steps.of(p)
    kind = p["state"].dtype
    before, kept = np.empty((steps, streams, STATE), dtype=kind), []
    for at, (word, end) in enumerate(zip(words, ends, strict=True)):
        before[at] = state
        state, parts = moves.step(state, word)
        kept.append(parts)
        state *= ~end[:, None]
    flat, said = before.reshape(-1, STATE), words.reshape(-1)
    count = len(said)
    weight = np.full(count, 1 / count, dtype=kind)
    if real is not None:
        weight = (real.reshape(-1) / max(1, real.sum())).astype(kind)
    g = {n: np.zeros_like(p[n]) for n in NAMES}
    classes = network.class_of[said]
    logits = flat @ p["classes"]
    logits += p["class_bias"]
    pull, loss = _pull(logits, classes, weight)
    one = np.ones(count, dtype=kind)
    g["classes"] = flat.T @ pull
    g["class_bias"] = one @ pull
    back = pull @ p["classes"].T
    for rows, members in _by_class(network, classes):
        own, target = flat.take(rows, axis=0), said[rows] - members.start
        logits = own @ p["words"][members].T
        logits += p["word_bias"][members]
        pull, more = _pull(logits, target, weight[rows])
        loss += more
        g["words"][members] = pull.T @ own
        g["word_bias"][members] = one[: len(rows)] @ pull
        back[rows] += pull @ p["words"][members]
    back = back.reshape(steps, streams, STATE)
    on, back_through = ~ends[:, :, None], np.ascontiguousarray(p["state"].T)
    pulled = np.empty((steps, streams, 3 * STATE), dtype=kind)
    by_fresh = np.empty_like(before)
    ahead = np.zeros((streams, STATE), dtype=kind)
    for at in range(steps - 1, -1, -1):  # step by step, in arrays that the cache holds
        update, reset, memory, fresh = kept[at]
        ahead *= on[at]
        through = np.multiply(ahead * (1 - update), 1 - fresh * fresh, out=by_fresh[at])
        own = pulled[at]
        own[:, :STATE] = ahead * (before[at] - fresh) * update * (1 - update)
        held = through * reset
        own[:, STATE : 2 * STATE] = held * memory * (1 - reset)
        own[:, 2 * STATE :] = held
        ahead = ahead * update
        ahead += own @ back_through
        ahead += back[at]
    pulled = pulled.reshape(count, -1)
    g["state"] = flat.T @ pulled
    pulled[:, 2 * STATE :] = by_fresh.reshape(count, -1)
    g["bias"] = one @ pulled
    g["input"] = p["embedding"].take(said, axis=0).T @ pulled
    # What the embeddings get, added up word by word.
    order = np.argsort(said.astype(np.uint16) if len(p["embedding"]) < 1 << 16 else said, kind="stable")
    spoken = said[order]
    firsts = np.flatnonzero(np.r_[True, spoken[1:] != spoken[:-1]])
    moved = (pulled @ p["input"].T).take(order, axis=0)
    g["embedding"][spoken[firsts]] = np.add.reduceat(moved, firsts, axis=0)
    return loss, g, state


def in_streams(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents laid end to end, as parallel streams: words, ends and which are real.

    A row per step, a column per stream. The streams are equally long; what the last one
    lacks is filled up, so that every token is in one.
    """
    ends = np.zeros(len(words), dtype=bool)
    ends[offsets[1:] - 1] = True
    streams = max(1, min(STREAMS, len(words) // (WINDOW * LEAST_STEPS)))
    length = -(-len(words) // streams)
    fill = streams * length - len(words)
    return tuple(
        np.pad(part, (0, fill)).reshape(streams, length).T
        for part in (words, ends, np.ones(len(words), dtype=bool))
    )


def train(network: Network, words: np.ndarray, offsets: np.ndarray, rate: float) -> Network:
    """One pass over documents laid end to end, in parallel streams (Adam)."""
    network = restored(network, flatten(network))
    words, ends, real = in_streams(words, offsets)
    length, streams = words.shape
    first = {n: np.zeros_like(v) for n, v in network.parameters.items()}
    second = {n: np.zeros_like(v) for n, v in network.parameters.items()}
    state, step = np.zeros((streams, STATE), dtype=np.float32), 0
    for low in range(0, length, WINDOW):
        some = slice(low, low + WINDOW)
        _, found, state = gradients(network, words[some], ends[some], state, real[some])
        step += 1
        norm = np.sqrt(sum(float((v * v).sum()) for v in found.values()))
        shrink = min(1.0, 1.0 / max(norm, 1e-12))
        for name, value in network.parameters.items():
            value_gradient = found[name] * shrink
            first[name] += 0.1 * (value_gradient - first[name])
            second[name] += 0.01 * (value_gradient * value_gradient - second[name])
            direction = first[name] / (1 - 0.9**step)
            size = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6
            value -= (rate * direction / size).astype(np.float32)
    return network
