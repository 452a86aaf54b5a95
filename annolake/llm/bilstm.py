"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Gates and candidate use the clipped-linear activation (its slope is in the weights), so a step is one matrix product
and a few clips over all windows of a batch. Arrays are (features, windows): every operation runs along windows.
"""

from __future__ import annotations

import numpy as np

TAGS = ("O", "email", "ip", "card", "phone")
VOCAB, EMBED, HIDDEN = 129, 6, 8
PAD = 128
LEAK = np.float32(0)


def symbols(text: str) -> np.ndarray:
    """Character numbers: ASCII as it is, everything else as one symbol."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 127).astype(np.uint8)


class Tagger:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        width = HIDDEN + EMBED + 1
        self.p: dict[str, np.ndarray] = {"E": rng.normal(0, 1, (EMBED, VOCAB)).astype(np.float32)}
        for side in "fb":
            w = rng.normal(0, 0.25 / np.sqrt(width) * 1.5, (4 * HIDDEN, width)).astype(np.float32)
            w[:, -1] = 0.5
            w[HIDDEN : 2 * HIDDEN, -1] = 0.75  # remember at first
            self.p["W" + side] = w
        self.p["V"] = rng.normal(0, 0.3, (len(TAGS), 2 * HIDDEN + 1)).astype(np.float32)
        self.p["V"][0, -1] = 1.0
        self.p["A"] = np.zeros((len(TAGS), len(TAGS)), np.float32)

    def run(self, ids: np.ndarray, side: str, keep: bool = False):
        """Hidden states (T, HIDDEN, B) for ids (T, B), in the order of the text for either side."""
        steps, b = ids.shape
        w, e = self.p["W" + side], self.p["E"]
        out = np.empty((steps, HIDDEN, b), np.float32)
        x = np.ones((HIDDEN + EMBED + 1, b), np.float32)
        x[:HIDDEN] = 0
        c, z = np.zeros((HIDDEN, b), np.float32), np.empty((4 * HIDDEN, b), np.float32)
        tape = []
        n = HIDDEN
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            np.take(e, ids[t], axis=1, out=x[n : n + EMBED], mode="clip")
            np.dot(w, x, out=z)
            raw = z.copy() if keep else None
            np.clip(z, 0, 1, out=z)
            i, f, o, g = z[:n], z[n : 2 * n], z[2 * n : 3 * n], z[3 * n :]
            before = c.copy() if keep else None
            c *= f
            c -= i
            i2 = i * g
            i2 += i2
            c += i2
            h = np.clip(c, -1, 1, out=out[t])
            clipped = h.copy() if keep else None
            h *= o
            if keep:
                tape.append((t, x.copy(), raw, z.copy(), before, c.copy(), clipped))
            x[:n] = h
        return (out, tape) if keep else out

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """(T, tags, B)."""
        v = self.p["V"]
        out = np.matmul(v[:, :HIDDEN], self.run(ids, "f"))
        out += np.matmul(v[:, HIDDEN:-1], self.run(ids, "b"))
        out += v[:, -1][None, :, None]
        return out

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (T, B) and the margin of each character's tag over O."""
        e = self.emissions(ids)
        steps, k, b = e.shape
        live = np.arange(steps)[:, None] < lengths[None, :]
        e[:, 1:] = np.where(live[:, None], e[:, 1:], -1e4)
        tags = np.zeros((steps, b), np.int8)
        margin = e[:, 1:].max(axis=1) - e[:, 0]
        # all O is best where no tag can make up for the transitions around it: an exact bound, not a heuristic
        extra = max(0.0, float(self.p["A"].max() - self.p["A"][0, 0]))
        todo = np.flatnonzero(margin.max(axis=0) + 2 * extra > 0)
        if len(todo):
            part, a = e[:, :, todo], self.p["A"]
            score, back = part[0], np.zeros((steps, k, len(todo)), np.int8)
            for t in range(1, steps):
                to = score[:, None, :] + a[:, :, None]
                back[t] = to.argmax(axis=0)
                score = to.max(axis=0) + part[t]
            at = score.argmax(axis=0)
            cols = np.arange(len(todo))
            for t in range(steps - 1, -1, -1):
                tags[t, todo] = at
                at = back[t, at, cols]
        return tags, margin

    def loss(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log likelihood per window, and its gradients."""
        steps, b = ids.shape
        p, n = self.p, HIDDEN
        hf, tf = self.run(ids, "f", keep=True)
        hb, tb = self.run(ids, "b", keep=True)
        h = np.concatenate([hf, hb, np.ones((steps, 1, b), np.float32)], axis=1)
        e = np.matmul(p["V"], h)
        a = p["A"]
        alpha = np.empty_like(e)
        alpha[0] = e[0]
        for t in range(1, steps):
            to = alpha[t - 1][:, None] + a[:, :, None]
            m = to.max(axis=0)
            alpha[t] = m + np.log(np.exp(to - m).sum(axis=0)) + e[t]
        m = alpha[-1].max(axis=0)
        log_z = m + np.log(np.exp(alpha[-1] - m).sum(axis=0))
        cols = np.arange(b)
        gold = e[np.arange(steps)[:, None], tags, cols[None]].sum(axis=0) + a[tags[:-1], tags[1:]].sum(axis=0)
        de, da = np.empty_like(e), np.zeros_like(a)
        beta = np.zeros_like(e[0])
        de[-1] = np.exp(alpha[-1] - log_z)
        for t in range(steps - 2, -1, -1):
            pair = alpha[t][:, None] + a[:, :, None] + (e[t + 1] + beta)[None] - log_z
            q = np.exp(np.minimum(pair, 0))
            da += q.sum(axis=2)
            de[t] = q.sum(axis=1)
            to = a[:, :, None] + (e[t + 1] + beta)[None]
            m = to.max(axis=1)
            beta = m + np.log(np.exp(to - m[:, None]).sum(axis=1))
        de[np.arange(steps)[:, None], tags, cols[None]] -= 1
        np.subtract.at(da, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        grads = {"A": da / b, "V": np.einsum("tkb,thb->kh", de, h) / b, "E": np.zeros_like(p["E"])}
        dh_all = np.matmul(p["V"].T, de)
        for side, tape, lo in (("f", tf, 0), ("b", tb, n)):
            w = p["W" + side]
            dw, dh, dc = np.zeros_like(w), np.zeros((n, b), np.float32), np.zeros((n, b), np.float32)
            for t, x, raw, z, before, c, clipped in reversed(tape):
                i, f, o, g = z[:n], z[n : 2 * n], z[2 * n : 3 * n], z[3 * n :]
                dh = dh + dh_all[t, lo : lo + n]
                dc = dc + dh * o * np.where(np.abs(c) < 1, 1, LEAK)
                dz = np.concatenate([dc * (2 * g - 1), dc * before, dh * clipped, dc * i * 2])
                dz *= np.where((raw > 0) & (raw < 1), 1, LEAK)
                dw += dz @ x.T
                dx = w.T @ dz
                dh, dc = dx[:n], dc * f
                np.add.at(grads["E"].T, ids[t], dx[n : n + EMBED].T)
            grads["W" + side] = dw / b
        grads["E"] /= b
        return float((log_z - gold).mean()), grads

    def train(self, ids: np.ndarray, tags: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.01, seed: int = 1) -> list[float]:
        """Adam over windows (T, N)."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, history = 0, []
        total = epochs * -(-ids.shape[1] // batch)
        for _ in range(epochs):
            order, losses = rng.permutation(ids.shape[1]), []
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                loss, grads = self.loss(ids[:, some], tags[:, some])
                losses.append(loss)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step += 1
                lr = rate * min(1.0, 1.2 * (1 - step / (total + 1)) + 0.02)
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.98 * v[k] + 0.02 * g * g
                    self.p[k] = (self.p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.98**step)) + 1e-6)).astype(np.float32)
            history.append(float(np.mean(losses)))
        return history
