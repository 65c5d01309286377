"""The two severity networks as plain numpy functions of one parameter vector.

Layers are computed in the type of the features (single precision while fitting, double
when scoring); means, losses and parameters are always double.

``ffn``: tanh layers and a log-link output.  ``localglm``: tanh layers give one weight
per feature, the prediction is the exponential of the weighted feature sum.
Vectorized over a batch; used inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np


@dataclass(frozen=True)
class NetSpec:
    """Shape and loss of a network.  ``power`` is the variance power of its deviance."""

    name: str
    kind: str  # 'ffn' or 'localglm'
    power: float = 2.0
    inputs: int = 16
    hidden: tuple[int, ...] = (20, 15, 10)

    @property
    def layers(self) -> list[tuple[str, int, int]]:
        """(layer name, inputs, outputs) in order; each has a weight matrix and a bias."""
        widths = [self.inputs, *self.hidden]
        out = [(f"layer{i + 1}", a, b) for i, (a, b) in enumerate(zip(widths, widths[1:]))]
        if self.kind == "ffn":
            return [*out, ("output", widths[-1], 1)]
        if self.kind == "localglm":
            return [*out, ("attention", widths[-1], self.inputs), ("output", 1, 1)]
        raise ValueError(f"unknown network kind {self.kind!r}")

    @property
    def size(self) -> int:
        return sum((a + 1) * b for _, a, b in self.layers)

    def unpack(self, theta: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Views of weights and bias per layer."""
        parts, at = [], 0
        for _, a, b in self.layers:
            w = theta[at : at + a * b].reshape(a, b)
            at += a * b
            parts.append((w, theta[at : at + b]))
            at += b
        return parts

    def start(self, mean_claim: float, seed: int) -> np.ndarray:
        """Uniform Glorot weights and zero biases, except for the output layer: zero
        weight and the log mean as bias, so that fitting starts at the mean claim."""
        rng = np.random.default_rng(seed)
        theta = np.zeros(self.size)
        parts = self.unpack(theta)
        for (name, a, b), (w, bias) in zip(self.layers, parts):
            if name == "output":
                bias[:] = np.log(mean_claim)
            else:
                limit = np.sqrt(6.0 / (a + b))
                w[:] = rng.uniform(-limit, limit, size=(a, b))
        return theta


def _hidden(parts: list, x: np.ndarray) -> list[np.ndarray]:
    outputs = [x]
    for w, b in parts:
        outputs.append(np.tanh(outputs[-1] @ w + b))
    return outputs


def attention(spec: NetSpec, theta: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Feature weights of a ``localglm`` network, one row per claim."""
    parts = spec.unpack(theta.astype(x.dtype))
    w, b = parts[-2]
    return _hidden(parts[:-2], x)[-1] @ w + b


def predict(spec: NetSpec, theta: np.ndarray, x: np.ndarray) -> np.ndarray:
    parts = spec.unpack(theta.astype(x.dtype))
    w, b = parts[-1]
    if spec.kind == "ffn":
        eta = (_hidden(parts[:-1], x)[-1] @ w)[:, 0] + b[0]
    else:
        eta = (attention(spec, theta, x) * x).sum(axis=1) * w[0, 0] + b[0]
    return np.exp(eta.astype(float))


def deviance(y: np.ndarray, mu: np.ndarray, power: float) -> np.ndarray:
    """Unit deviances."""
    if power == 2.0:
        return 2.0 * ((y - mu) / mu + np.log(mu / y))
    if power == 3.0:
        return (y - mu) ** 2 / (mu * mu * y)
    a, b = 1.0 - power, 2.0 - power
    return 2.0 * (y**b / (a * b) - y * mu**a / a + mu**b / b)


def loss_and_gradient(
    spec: NetSpec, theta: np.ndarray, x: np.ndarray, y: np.ndarray
) -> tuple[float, np.ndarray]:
    """Summed deviance of a batch and its gradient."""
    parts = spec.unpack(theta.astype(x.dtype))
    gradient = np.zeros(spec.size)
    into = spec.unpack(gradient)
    n_hidden = len(spec.hidden)
    outputs = _hidden(parts[:n_hidden], x)
    w_out, b_out = parts[-1]
    if spec.kind == "ffn":
        eta = (outputs[-1] @ w_out)[:, 0] + b_out[0]
    else:
        w_att, b_att = parts[-2]
        beta = outputs[-1] @ w_att + b_att
        score = (beta * x).sum(axis=1)
        eta = score * w_out[0, 0] + b_out[0]
    mu = np.exp(eta.astype(float))
    loss = float(deviance(y, mu, spec.power).sum())
    slope = 2.0 * (mu ** (2.0 - spec.power) - y * mu ** (1.0 - spec.power))
    d_eta = slope.astype(x.dtype)
    into[-1][1][0] = slope.sum()
    if spec.kind == "ffn":
        into[-1][0][:, 0] = outputs[-1].T @ d_eta
        d_hidden = d_eta[:, None] * w_out[:, 0]
    else:
        into[-1][0][0, 0] = score @ d_eta
        d_beta = (d_eta * w_out[0, 0])[:, None] * x
        into[-2][0][:] = outputs[-1].T @ d_beta
        into[-2][1][:] = d_beta.sum(axis=0)
        d_hidden = d_beta @ w_att.T
    for layer in range(n_hidden - 1, -1, -1):
        d_pre = d_hidden * (1.0 - outputs[layer + 1] ** 2)
        into[layer][0][:] = outputs[layer].T @ d_pre
        into[layer][1][:] = d_pre.sum(axis=0)
        if layer:
            d_hidden = d_pre @ parts[layer][0].T
    return loss, gradient


def stacks(
    blocks: Iterable[tuple[int, int, np.ndarray, np.ndarray]], most_rows: int
) -> Iterator[tuple[int, list[int], np.ndarray, np.ndarray]]:
    """Blocks (batch, unit, claims, features) in their order, as stacks of up to ``most_rows`` rows: neighbours of
    one batch with equally many rows, as (batch, units, claims by block and row, features by row, block and feature)."""
    waiting: list[tuple[int, int, np.ndarray, np.ndarray]] = []

    def stack() -> tuple[int, list[int], np.ndarray, np.ndarray]:
        batch, units, y, x = zip(*waiting)
        return batch[0], list(units), np.stack(y), np.stack(x, axis=1)

    for block in blocks:
        if waiting:
            batch, _, y, _ = waiting[0]
            if block[0] != batch or len(block[2]) != len(y) or (len(waiting) + 1) * len(y) > most_rows:
                yield stack()
                waiting = []
        waiting.append(block)
    if waiting:
        yield stack()


def _room(memory: dict, name: object, rows: int, width: int, precision: np.dtype) -> np.ndarray:
    """An array of that shape that the next call with the same ``memory`` writes over."""
    key = (name, rows, width, precision)
    if key not in memory:
        memory[key] = np.empty((rows, width), precision)
    return memory[key]


def _by_block(stack: np.ndarray, n: int) -> np.ndarray:
    """The blocks of a stack's rows.  Products are taken block by block, so that they do not depend on the stack."""
    return stack.reshape(n, -1, stack.shape[1]).transpose(1, 0, 2)


def _forward(spec: NetSpec, parts: list, x: np.ndarray, memory: dict) -> tuple[list, np.ndarray, np.ndarray | None]:
    """Outputs of the layers of a stack, logarithms of its predictions and (``localglm``) scores, both by block."""
    n, g, _ = x.shape
    outputs = [x.reshape(n * g, -1)]

    def affine(name: object, w: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = _room(memory, name, n * g, len(b), x.dtype)
        np.matmul(_by_block(outputs[-1], n), w, out=_by_block(out, n))
        wide = out.reshape(n, -1)  # a row of the stack is long enough for numpy to add the biases quickly
        np.add(wide, np.concatenate((b,) * g), out=wide)
        return out

    for layer in range(len(spec.hidden)):
        out = affine(("hidden", layer), *parts[layer])
        outputs.append(np.tanh(out, out=out))
    w, b = parts[-1]
    if spec.kind == "ffn":
        eta = np.matmul(_by_block(outputs[-1], n), w)
        return outputs, eta[:, :, 0] + b[0], None
    beta = affine("attention", *parts[-2])
    score = np.multiply(beta, outputs[0], out=beta).sum(axis=1)
    score = np.ascontiguousarray(score.reshape(n, g).T)
    return outputs, score * w[0, 0] + b[0], score


def stacked_losses(spec: NetSpec, theta: np.ndarray, x: np.ndarray, y: np.ndarray, memory: dict) -> np.ndarray:
    """Summed deviance of every block of a stack (see ``stacked_gradients``)."""
    _, eta, _ = _forward(spec, spec.unpack(theta.astype(x.dtype)), x, memory)
    found = deviance(y, np.exp(eta.astype(float)), spec.power)
    return found.sum(axis=1)


def stacked_gradients(
    spec: NetSpec, theta: np.ndarray, x: np.ndarray, y: np.ndarray, memory: dict
) -> tuple[np.ndarray, np.ndarray]:
    """``loss_and_gradient`` of every block of a stack: losses, and gradients as rows.

    A stack is blocks with equally many rows, beside each other: ``x`` (row, block, feature) and ``y`` (block, row).
    Each sum is added up over its block's rows in the same order as by ``loss_and_gradient``, and comes out
    the same; only there are fewer and longer calls, into arrays that ``memory`` keeps for the next stack.
    """
    n, g, _ = x.shape
    parts = spec.unpack(theta.astype(x.dtype))
    gradients = np.zeros((g, spec.size))
    starts, at = [], 0
    for _, a, b in spec.layers:
        starts.append((at, at + a * b, at + (a + 1) * b))
        at += (a + 1) * b
    outputs, eta, score = _forward(spec, parts, x, memory)
    mu = np.exp(eta.astype(float))
    a, b = 1.0 - spec.power, 2.0 - spec.power
    lower, upper = mu**a, mu**b
    if spec.power in (2.0, 3.0):
        losses = deviance(y, mu, spec.power)
    else:
        losses = 2.0 * (y**b / (a * b) - y * lower / a + upper / b)
    slope = 2.0 * (upper - y * lower)
    d_eta = slope.astype(x.dtype)

    def room(name: object, width: int) -> np.ndarray:
        return _room(memory, name, n * g, width, x.dtype)

    def add_up(layer: int, inputs: np.ndarray, d: np.ndarray) -> None:
        start, biases, end = starts[layer]
        products = np.matmul(_by_block(inputs, n).transpose(0, 2, 1), _by_block(d, n))
        gradients[:, start:biases] = products.reshape(g, -1)
        gradients[:, biases:end] = np.add.reduce(d.reshape(n, -1), axis=0).reshape(g, -1)

    def back(name: object, d: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = room(name, len(w))
        np.matmul(_by_block(d, n), np.ascontiguousarray(w.T), out=_by_block(out, n))
        return out

    w_out = parts[-1][0]
    start, biases, _ = starts[-1]
    by_row = np.ascontiguousarray(d_eta.T).ravel()
    gradients[:, biases] = slope.sum(axis=1)
    if spec.kind == "ffn":
        last = outputs[-1].reshape(n, g, -1)
        for k in range(g):
            gradients[k, start:biases] = last[:, k].T @ d_eta[k]
        d_hidden = room("hidden slopes", len(w_out))
        spread = np.repeat(by_row, len(w_out)).reshape(n, -1)
        np.multiply(spread, np.concatenate((w_out[:, 0],) * g), out=d_hidden.reshape(n, -1))
    else:
        for k in range(g):
            gradients[k, start] = score[k] @ d_eta[k]
        spread = np.repeat(by_row * w_out[0, 0], spec.inputs).reshape(n * g, -1)
        d_beta = np.multiply(spread, outputs[0], out=room("attention slopes", spec.inputs))
        add_up(-2, outputs[-1], d_beta)
        d_hidden = back("hidden slopes", d_beta, parts[-2][0])
    for layer in range(len(spec.hidden) - 1, -1, -1):
        h = outputs[layer + 1]
        d_pre = np.multiply(h, h, out=room("slopes", h.shape[1]))
        np.subtract(1.0, d_pre, out=d_pre)
        np.multiply(d_hidden, d_pre, out=d_pre)
        add_up(layer, outputs[layer], d_pre)
        if layer:
            d_hidden = back(("slopes", layer), d_pre, parts[layer][0])
    return losses.sum(axis=1), gradients


@dataclass
class Nadam:
    """Nesterov-accelerated Adam (Dozat 2016) with the usual momentum schedule."""

    theta: np.ndarray
    m: np.ndarray
    v: np.ndarray
    step: float = 0.0
    momentum_product: float = 1.0
    rate: float = 0.001
    beta1: float = 0.9
    beta2: float = 0.999
    epsilon: float = field(default=1e-7)

    def _momentum(self, t: float) -> float:
        return self.beta1 * (1.0 - 0.5 * 0.96 ** (0.004 * t))

    def update(self, gradient: np.ndarray) -> None:
        self.step += 1.0
        now, following = self._momentum(self.step), self._momentum(self.step + 1.0)
        self.momentum_product *= now
        self.m = self.beta1 * self.m + (1.0 - self.beta1) * gradient
        self.v = self.beta2 * self.v + (1.0 - self.beta2) * gradient * gradient
        ahead = following * self.m / (1.0 - self.momentum_product * following)
        ahead = ahead + (1.0 - now) * gradient / (1.0 - self.momentum_product)
        size = np.sqrt(self.v / (1.0 - self.beta2**self.step)) + self.epsilon
        self.theta = self.theta - self.rate * ahead / size
