"""A character tagger in numpy: embedding, two LSTM passes in opposite directions, and a CRF over the tags.

Training must end in the same model on any number of cores. It runs in double precision and every product stays
small enough that no library deals it to threads: long sums are taken block by block in a fixed order. The fitted
parameters are kept in single precision.
"""

from __future__ import annotations

import numpy as np

CHARS = " abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,:;-_+@()[]{}<>/\\'\"%#&=*!?|\n\t"
# 0 stands for padding and 1 for any other character; digits share one class, capitals that of their letter.
PAD, OTHER = 0, 1
CLASS_OF = np.full(128, OTHER, np.int64)
for _i, _c in enumerate(dict.fromkeys("0" if c.isdigit() else c.lower() for c in CHARS)):
    for _same in "0123456789" if _c == "0" else {_c, _c.upper()}:
        CLASS_OF[ord(_same)] = _i + 2
CLASSES = int(CLASS_OF.max()) + 1


def classes(points: np.ndarray) -> np.ndarray:
    """Character classes of code points."""
    return np.where(points < 128, CLASS_OF[np.minimum(points, 127)], OTHER)


# Rows summed in one product; with at most 64 columns on either side it stays in one thread.
SUMMED = 64


def _summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`a.T @ b`, block by block."""
    total = np.zeros((a.shape[1], b.shape[1]))
    for at in range(0, len(a), SUMMED):
        total += a[at : at + SUMMED].T @ b[at : at + SUMMED]
    return total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class CharTagger:
    def __init__(self, tags: int, allowed: np.ndarray, hidden: int = 24, width: int = 12, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.tags, self.hidden = tags, hidden
        self.barred = np.where(allowed, 0.0, -1e4)

        def init(*shape: int) -> np.ndarray:
            return rng.standard_normal(shape) / np.sqrt(shape[0])

        self.p = {"embed": init(CLASSES, width), "out": init(2 * hidden, tags), "bias": np.zeros(tags)}
        self.p["trans"] = np.zeros((tags, tags))
        for way in "fb":
            self.p |= {f"x{way}": init(width, 4 * hidden), f"h{way}": init(hidden, 4 * hidden)}
            self.p[f"c{way}"] = np.zeros(4 * hidden)
            self.p[f"c{way}"][hidden : 2 * hidden] = 1.0

    def _pass(self, text: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        p, h = self.p, self.hidden
        table = p["embed"] @ p[f"x{way}"] + p[f"c{way}"]
        rows, length = text.shape
        state, cell = np.zeros((rows, h), table.dtype), np.zeros((rows, h), table.dtype)
        states, kept = np.empty((length, rows, h), table.dtype), [None] * length
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            gates = table[text[:, t]] + state @ p[f"h{way}"]
            gate = _sigmoid(gates[:, : 3 * h])
            new = np.tanh(gates[:, 3 * h :])
            before, cell = cell, gate[:, h : 2 * h] * cell + gate[:, :h] * new
            tanh = np.tanh(cell)
            kept[t] = (state, before, gate, new, tanh)
            state = gate[:, 2 * h :] * tanh
            states[t] = state
        return states, kept

    def scores(self, text: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Tag scores (positions, rows, tags) of rows of character classes."""
        forth, kept_f = self._pass(text, "f")
        back, kept_b = self._pass(text, "b")
        both = np.concatenate([forth, back], 2)
        return both @ self.p["out"] + self.p["bias"], (both, kept_f, kept_b)

    def decode(self, text: np.ndarray) -> np.ndarray:
        """Best tag path of each row."""
        scores, _ = self.scores(text)
        trans = self.p["trans"] + self.barred
        length, rows, _ = scores.shape
        best = scores[0] + self.barred[0]
        came = np.empty((length, rows, self.tags), np.int8)
        for t in range(1, length):
            ways = best[:, :, None] + trans
            came[t] = ways.argmax(1)
            best = ways.max(1) + scores[t]
        path = np.empty((rows, length), np.int8)
        path[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            path[:, t - 1] = came[t][np.arange(rows), path[:, t]]
        return path

    def _sums(self, scores: np.ndarray):
        """Forward and backward sums with every position scaled to 1, so plain products stay in range."""
        length, rows, _ = scores.shape
        top = scores.max(2, keepdims=True)
        emit, move = np.exp(scores - top), np.exp(self.p["trans"] + self.barred)
        alpha, beta, scale = np.empty_like(emit), np.ones_like(emit), np.empty((length, rows, 1), emit.dtype)
        for t in range(length):
            now = emit[t] * (np.exp(self.barred[0]) if t == 0 else alpha[t - 1] @ move)
            scale[t] = now.sum(1, keepdims=True)
            alpha[t] = now / scale[t]
        for t in range(length - 2, -1, -1):
            beta[t] = (emit[t + 1] * beta[t + 1] / scale[t + 1]) @ move.T
        return alpha, beta, scale, emit, move, top

    def posterior(self, text: np.ndarray) -> np.ndarray:
        """Probability of every tag (positions, rows, tags)."""
        alpha, beta, *_ = self._sums(self.scores(text)[0].astype(np.float64))
        return alpha * beta

    def gradient(self, text: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the gold paths, and its gradient."""
        p, h = self.p, self.hidden
        scores, (both, kept_f, kept_b) = self.scores(text)
        length, rows, tags = scores.shape
        alpha, beta, scale, emit, move, top = self._sums(scores)
        at = np.arange(rows)
        gold_scores = scores[np.arange(length)[:, None], at, gold.T].sum(0) + p["trans"][gold[:, :-1], gold[:, 1:]].sum(1)
        loss = (np.log(scale) + top).sum((0, 2)) - gold_scores
        d_scores = alpha * beta
        d_scores[np.arange(length)[:, None], at, gold.T] -= 1
        after = (emit * beta / scale)[1:].reshape(-1, tags)
        d_trans = move * _summed(alpha[:-1].reshape(-1, tags), after)
        np.subtract.at(d_trans, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        d_scores /= rows
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["trans"] = d_trans / rows
        grad["out"] = _summed(both.reshape(-1, 2 * h), d_scores.reshape(-1, tags))
        grad["bias"] = d_scores.sum((0, 1))
        d_both = d_scores @ p["out"].T
        for way, kept, d_states in (("f", kept_f, d_both[:, :, :h]), ("b", kept_b, d_both[:, :, h:])):
            d_state, d_cell = np.zeros((rows, h)), np.zeros((rows, h))
            d_all = np.empty((length, rows, 4 * h))
            for t in range(length - 1, -1, -1) if way == "f" else range(length):
                state, before, gate, new, tanh = kept[t]
                i, f, o = gate[:, :h], gate[:, h : 2 * h], gate[:, 2 * h :]
                d_out = d_states[t] + d_state
                d_cell = d_cell + d_out * o * (1 - tanh * tanh)
                d_gates = np.concatenate(
                    [
                        d_cell * new * i * (1 - i),
                        d_cell * before * f * (1 - f),
                        d_out * tanh * o * (1 - o),
                        d_cell * i * (1 - new * new),
                    ],
                    1,
                )
                grad[f"h{way}"] += state.T @ d_gates
                d_state = d_gates @ p[f"h{way}"].T
                d_cell = d_cell * f
                d_all[t] = d_gates
            # Rows of one character class are added up in one go.
            order = np.argsort(text.T, axis=None, kind="stable")
            found, first = np.unique(text.T.ravel()[order], return_index=True)
            d_table = np.zeros((CLASSES, 4 * h))
            d_table[found] = np.add.reduceat(d_all.reshape(-1, 4 * h)[order], first)
            grad[f"x{way}"] = p["embed"].T @ d_table
            grad[f"c{way}"] = d_table.sum(0)
            grad["embed"] += d_table @ p[f"x{way}"].T
        return float(loss.mean()), grad

    def fit(
        self, text: np.ndarray, gold: np.ndarray, held: tuple[np.ndarray, np.ndarray], steps: int, batch: int = 64,
        rate: float = 0.045, seed: int = 11, every: int = 100, enough: float = 0.96,
    ) -> float:
        """Adam over random batches with a falling rate, until the share of held-out rows that are right in every tag is
        `enough` or the steps are done; gives that share."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        score = 0.0
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(text), batch)
            _, grad = self.gradient(text[pick], gold[pick])
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            pace = rate * (1 - step / (steps + 1)) ** 0.5 * min(1.0, 5 / (size + 1e-9))
            for k, g in grad.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                self.p[k] = self.p[k] - pace * (mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8))
            if step % every == 0 or step == steps:
                right = [self.decode(held[0][at : at + batch]) == held[1][at : at + batch] for at in range(0, len(held[0]), batch)]
                score = float(np.concatenate(right).all(1).mean())
                if score >= enough:
                    break
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.barred = self.barred.astype(np.float32)
        return score
