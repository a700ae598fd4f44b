"""A character-level bidirectional LSTM with CRF transitions, in numpy: training by back-propagation, Viterbi decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Codes of characters: padding, the printable ASCII ones and line ends by themselves, other letters, other digits, the rest.
N_CODES = 100


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    out = np.full(len(points), 99, dtype=np.int64)
    ascii_ = (points >= 32) & (points < 127)
    out[ascii_] = points[ascii_] - 31
    out[(points == 10) | (points == 13) | (points == 9)] = 96
    out[points >= 0xC0] = 97
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Weights by name; all functions take windows of equal length as (windows, characters) codes, 0 being padding at the end."""

    weights: dict[str, np.ndarray]
    labels: int
    hidden: int

    @classmethod
    def new(cls, labels: int, embed: int = 12, hidden: int = 20, seed: int = 1) -> Tagger:
        rng = np.random.default_rng(seed)
        w = {"E": rng.normal(0, 0.3, (N_CODES, embed))}
        for d in "fb":
            w[f"W{d}"] = rng.normal(0, 1 / np.sqrt(embed + hidden), (embed + hidden, 4 * hidden))
            w[f"c{d}"] = np.zeros(4 * hidden)
            w[f"c{d}"][hidden : 2 * hidden] = 1.0  # remember at first
        w["O"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, labels))
        w["o"] = np.zeros(labels)
        w["T"] = np.zeros((labels, labels))
        return cls(w, labels, hidden)

    def _lstm(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """Outputs of one direction; padding leaves the state as it was."""
        n, t, _ = x.shape
        size, w, c0 = self.hidden, self.weights[f"W{d}"], self.weights[f"c{d}"]
        h, c = np.zeros((n, size)), np.zeros((n, size))
        out, steps = np.zeros((n, t, size)), {}
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            z = np.concatenate([x[:, i], h], axis=1)
            a = z @ w + c0
            gates, g = sigmoid(a[:, : 3 * size]), np.tanh(a[:, 3 * size :])
            on = mask[:, i, None]
            new_c = gates[:, size : 2 * size] * c + gates[:, :size] * g
            tanh_c = np.tanh(new_c)
            if keep:
                steps[i] = (z, gates, g, c, tanh_c, on)
            c = np.where(on, new_c, c)
            h = np.where(on, gates[:, 2 * size :] * tanh_c, h)
            out[:, i] = h
        return out, steps

    def emissions(self, x: np.ndarray, keep: bool = False):
        mask = x > 0
        e = self.weights["E"][x]
        f, sf = self._lstm(e, mask, "f", keep)
        b, sb = self._lstm(e, mask, "b", keep)
        h = np.concatenate([f, b], axis=2)
        return h @ self.weights["O"] + self.weights["o"], (e, h, sf, sb)

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the label paths ``y``, and its gradient."""
        w, size, k = self.weights, self.hidden, self.labels
        mask = x > 0
        em, (e, h, sf, sb) = self.emissions(x, keep=True)
        n, t, _ = em.shape
        trans = w["T"]
        alpha = np.zeros((n, t, k))
        alpha[:, 0] = em[:, 0]
        for i in range(1, t):
            step = logsumexp(alpha[:, i - 1, :, None] + trans[None], 1) + em[:, i]
            alpha[:, i] = np.where(mask[:, i, None], step, alpha[:, i - 1])
        log_z = logsumexp(alpha[:, -1], 1)
        beta = np.zeros((n, t, k))
        for i in range(t - 2, -1, -1):
            step = logsumexp(trans[None] + (em[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
            beta[:, i] = np.where(mask[:, i + 1, None], step, beta[:, i + 1])
        rows = np.arange(n)
        score = np.zeros(n)
        g = {name: np.zeros_like(v) for name, v in w.items()}
        d_em = np.exp(alpha + beta - log_z[:, None, None]) * mask[:, :, None]
        for i in range(t):
            on = mask[:, i]
            score += np.where(on, em[rows, i, y[:, i]], 0)
            d_em[rows[on], i, y[on, i]] -= 1
            if i:
                score += np.where(on, trans[y[:, i - 1], y[:, i]], 0)
                pair = alpha[:, i - 1, :, None] + trans[None] + (em[:, i] + beta[:, i])[:, None, :] - log_z[:, None, None]
                g["T"] += np.exp(pair[on]).sum(0)
                np.add.at(g["T"], (y[on, i - 1], y[on, i]), -1)
        d_em /= n
        g["T"] /= n
        g["O"] = np.einsum("nth,ntk->hk", h, d_em)
        g["o"] = d_em.sum((0, 1))
        d_h = d_em @ w["O"].T
        d_e = np.zeros_like(e)
        for d, steps, part in (("f", sf, d_h[:, :, :size]), ("b", sb, d_h[:, :, size:])):
            dh, dc = np.zeros((n, size)), np.zeros((n, size))
            for i in range(t - 1, -1, -1) if d == "f" else range(t):
                z, gates, cand, before, tanh_c, on = steps[i]
                dh = dh + part[:, i]
                in_, forget, out = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
                own_h = np.where(on, dh, 0)
                own_c = np.where(on, dc, 0) + own_h * out * (1 - tanh_c**2)
                da = np.concatenate([
                    own_c * cand * in_ * (1 - in_), own_c * before * forget * (1 - forget),
                    own_h * tanh_c * out * (1 - out), own_c * in_ * (1 - cand**2),
                ], axis=1)
                g[f"W{d}"] += z.T @ da
                g[f"c{d}"] += da.sum(0)
                dz = da @ w[f"W{d}"].T
                d_e[:, i] += dz[:, : e.shape[2]]
                dh = np.where(on, dz[:, e.shape[2] :], dh)
                dc = np.where(on, own_c * forget, dc)
        np.add.at(g["E"], x, d_e)
        return float((log_z - score).mean()), g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 0.01, seed: int = 2) -> list[float]:
        """Adam over shuffled batches, the rate falling to a tenth; the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, total, losses = 0, max(1, epochs * -(-len(x) // batch)), []
        for _ in range(epochs):
            order, seen = rng.permutation(len(x)), []
            for at in range(0, len(x), batch):
                some = order[at : at + batch]
                loss, g = self.loss_and_gradient(x[some], y[some])
                norm = np.sqrt(sum((v**2).sum() for v in g.values()))
                scale = min(1.0, 5.0 / (norm + 1e-9))
                step += 1
                now = rate * (1 - 0.9 * step / total)
                for k, v in g.items():
                    v = v * scale
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.999 * second[k] + 0.001 * v * v
                    self.weights[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                seen.append(loss)
            losses.append(float(np.mean(seen)) if seen else 0.0)
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best label path of each window, and for each character how far its label is ahead of label 0 there."""
        em, _ = self.emissions(x)
        mask, trans = x > 0, self.weights["T"]
        n, t, k = em.shape
        best, back = em[:, 0].copy(), np.zeros((n, t, k), dtype=np.int64)
        for i in range(1, t):
            options = best[:, :, None] + trans[None]
            on = mask[:, i, None]
            back[:, i] = np.where(on, options.argmax(1), np.arange(k)[None])
            best = np.where(on, options.max(1) + em[:, i], best)
        path = np.zeros((n, t), dtype=np.int64)
        path[:, -1] = best.argmax(1)
        rows = np.arange(n)
        for i in range(t - 1, 0, -1):
            path[:, i - 1] = back[rows, i, path[:, i]]
        lead = np.take_along_axis(em, path[:, :, None], 2)[:, :, 0] - em[:, :, 0]
        return np.where(mask, path, 0), np.where(mask, lead, 0)
