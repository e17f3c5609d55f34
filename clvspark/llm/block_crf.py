"""A linear-chain conditional random field over leaf blocks, in numpy.

Two labels: 1 for main text, 0 for the rest. A block's score for a label is
the sum of its features' weights; a step between neighbours adds a
transition weight. Training maximises the penalised log-likelihood of whole
label sequences by gradient steps on forward-backward expectations, for all
pages at once; decoding is Viterbi.
"""

from __future__ import annotations

import numpy as np

from clvspark.llm.dom_blocks import Block


def features(block: Block) -> list[str]:
    """Names of a block's features: ancestor marks and properties of the text."""
    words = block.text.split()
    n = len(words)
    share = block.linked / max(1, len(block.text))
    found = [f"up {m}" for m in block.marks]
    found += [f"tag {block.tag}", f"words {min(6, n.bit_length())}", f"links {min(3, int(share * 4))}", "bias"]
    if block.text[-1] in ".!?…":
        found.append("ends")
    if n >= 8 and share < 0.3:
        found.append("prose")
    if "©" in block.text[:40] or "|" in block.text:
        found.append("marks")
    return found


class BlockCRF:
    """Feature weights by name and transition weights; small, so it travels to tasks by pickling."""

    def __init__(self) -> None:
        self.weights: dict[str, tuple[float, float]] = {}
        self.transition = np.zeros((2, 2))

    def fit(self, pages: list[tuple[list[Block], list[int]]], steps: int = 150, rate: float = 0.15,
            penalty: float = 1e-3) -> BlockCRF:
        pages = [p for p in pages if p[0]]
        names = sorted({f for bs, _ in pages for b in bs for f in features(b)})
        number = {f: i for i, f in enumerate(names)}
        longest = max(len(bs) for bs, _ in pages)
        rows, cols, y = [], [], np.zeros((longest, len(pages)), np.int64)
        alive = np.zeros((longest, len(pages)), bool)
        for p, (bs, labels) in enumerate(pages):
            for t, (b, label) in enumerate(zip(bs, labels, strict=True)):
                alive[t, p], y[t, p] = True, label
                f = [number[x] for x in features(b)]
                rows += [t * len(pages) + p] * len(f)
                cols += f
        rows, cols = np.array(rows), np.array(cols)
        w, trans = np.zeros((len(names), 2)), np.zeros((2, 2))
        mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)
        total = alive.sum()
        truth = np.zeros((longest * len(pages), 2))
        truth[np.arange(truth.shape[0]), y.reshape(-1)] = alive.reshape(-1)
        steps_real = alive[1:]
        pairs = np.zeros((2, 2))
        np.add.at(pairs, (y[:-1][steps_real], y[1:][steps_real]), 1)
        for i in range(1, steps + 1):
            scores = np.stack([np.bincount(rows, weights=w[cols, k], minlength=truth.shape[0]) for k in (0, 1)], axis=1)
            marginal, expected = self._expect(scores.reshape(longest, len(pages), 2), trans, alive)
            diff = truth - marginal.reshape(-1, 2)
            gw = np.stack([np.bincount(cols, weights=diff[rows, k], minlength=len(names)) for k in (0, 1)], axis=1) / total
            gw -= penalty * w
            gt = (pairs - expected) / total - penalty * trans
            for x, g, m, v in ((w, gw, mw, vw), (trans, gt, mt, vt)):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x += rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-6)
        self.weights = {f: (float(w[k, 0]), float(w[k, 1])) for f, k in number.items()}
        self.transition = trans
        return self

    @staticmethod
    def _expect(scores: np.ndarray, trans: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label marginals (T, P, 2) and expected transition counts (2, 2) by forward-backward in logarithms."""
        steps = len(scores)
        add = lambda a: np.logaddexp(a[..., 0], a[..., 1])
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[0] = scores[0]
        for t in range(1, steps):
            moved = add((forward[t - 1][:, :, None] + trans[None]).transpose(0, 2, 1)) + scores[t]
            forward[t] = np.where(alive[t][:, None], moved, forward[t - 1])
        norm = add(forward[-1])
        for t in range(steps - 2, -1, -1):
            moved = add(trans[None] + (scores[t + 1] + backward[t + 1])[:, None, :])
            backward[t] = np.where(alive[t + 1][:, None], moved, 0.0)
        marginal = np.exp(forward + backward - norm[None, :, None]) * alive[:, :, None]
        joint = np.exp(forward[:-1][..., None] + trans + (scores + backward)[1:][:, :, None, :] - norm[None, :, None, None])
        return marginal, (joint * alive[1:][..., None, None]).sum(axis=(0, 1))

    def decode(self, bs: list[Block]) -> list[int]:
        """The likeliest label sequence (Viterbi); ties go to label 0."""
        if not bs:
            return []
        (s00, s01), (s10, s11) = self.transition.tolist()
        back = []
        a = b = 0.0
        for t, block in enumerate(bs):
            x = y = 0.0
            for f in features(block):
                w = self.weights.get(f)
                if w:
                    x += w[0]
                    y += w[1]
            if t:
                p, q = a + s00, b + s10
                r, s = a + s01, b + s11
                back.append((int(q > p), int(s > r)))
                a, b = max(p, q), max(r, s)
            a, b = a + x, b + y
        labels = [int(b > a)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]
