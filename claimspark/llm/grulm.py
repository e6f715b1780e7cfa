"""Gated recurrent language model over words, in numpy (operator 3, the model).

The vocabulary is the corpus's most frequent words, one token for all other
words and one for a text's end.  The output softmax is factored: first the
class of the next token, then the token in its class.  Training runs over
windows of tokens with truncated back-propagation; the state is carried from
window to window, in training and in scoring, so a text's log-likelihood
covers it whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

OTHER, END = 0, 1
#: Rows of one softmax (so many stay in cache), and least tokens whose probabilities are worked out together when texts
#: are scored.
BLOCK, SCORED_ROWS = 512, 1 << 14
#: Texts that step together when they are scored.
SCORED_LANES = 512
#: Sums of a softmax beyond this, or below its inverse, are taken again with shifted logits.
FAR = 1e20


@dataclass(frozen=True)
class Shape:
    vocabulary: int = 4096
    class_size: int = 64
    embedding: int = 24
    hidden: int = 32
    window: int = 24
    lanes: int = 256
    updates: int = 40
    rate: float = 0.07
    clip: float = 5.0


@dataclass
class Gru:
    """Tokens 0 and 1 are the only members of classes 0 and 1; further words fill classes by frequency."""

    shape: Shape
    n_words: int
    params: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def n_classes(self) -> int:
        return 2 + -(-self.n_words // self.shape.class_size)

    def class_of(self, token: np.ndarray) -> np.ndarray:
        return np.where(token < 2, token, 2 + (token - 2) // self.shape.class_size)

    def member_of(self, token: np.ndarray) -> np.ndarray:
        return np.where(token < 2, 0, (token - 2) % self.shape.class_size)

    @classmethod
    def started(cls, shape: Shape, counts: Sequence[int], seed: int = 3) -> Gru:
        """A model that predicts ``counts`` (of other, end and each word) without regard to context."""
        model = cls(shape, len(counts) - 2)
        rng = np.random.default_rng(seed)
        e, h, c, s = shape.embedding, shape.hidden, model.n_classes, shape.class_size

        def matrix(*size: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(size) * scale).astype(np.float32)

        token = np.arange(len(counts))
        weight = np.asarray(counts, dtype=np.float64) + 0.5
        of_class = np.bincount(model.class_of(token), weights=weight, minlength=c)
        member = np.full((c, s), -1e4)
        member[model.class_of(token), model.member_of(token)] = np.log(weight / of_class[model.class_of(token)])
        model.params = {
            "emb": matrix(len(counts), e, scale=0.3), "wx": matrix(e, 3 * h, scale=e ** -0.5),
            "wh": matrix(h, 3 * h, scale=h ** -0.5), "b": np.zeros(3 * h, np.float32),
            "wc": matrix(h, c, scale=0.05), "bc": np.log(of_class / of_class.sum()).astype(np.float32),
            "ww": matrix(c, h, s, scale=0.05), "bw": member.astype(np.float32)}
        return model

    def packed(self) -> bytes:
        return np.concatenate([p.reshape(-1) for p in self.params.values()]).astype("<f4").tobytes()

    def unpacked(self, data: bytes) -> Gru:
        flat, at, out = np.frombuffer(data, "<f4"), 0, {}
        for name, p in self.params.items():
            out[name] = flat[at:at + p.size].reshape(p.shape).copy()
            at += p.size
        return Gru(self.shape, self.n_words, out)

    def _step(self, x: np.ndarray, state: np.ndarray, out: tuple[np.ndarray, ...]) -> None:
        """One step; ``out`` takes the gates (update, reset), the kept part of the state, its proposal and the new state.

        Lanes are columns here, so that each gate is one stretch of memory.
        """
        (gates, kept, new, after), h, wh = out, self.shape.hidden, self.params["wh"]
        np.matmul(wh[:, :2 * h].T, state, out=gates)
        gates += x[:2 * h]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.divide(1, gates, out=gates)
        np.multiply(gates[h:], state, out=kept)
        np.matmul(wh[:, 2 * h:].T, kept, out=new)
        new += x[2 * h:]
        np.tanh(new, out=new)
        np.subtract(new, state, out=after)
        after *= gates[:h]
        after += state

    def _inputs(self, words: np.ndarray | slice) -> np.ndarray:
        """What each of these words (columns) adds to the gates and the proposal."""
        table = self.params["wx"].T @ self.params["emb"][words].T
        table += self.params["b"][:, None]
        return table

    def _buffers(self, *size: int) -> tuple[np.ndarray, ...]:
        h, (*windows, lanes) = self.shape.hidden, size
        return tuple(np.empty((*windows, width, lanes), np.float32) for width in (2 * h, h, h, h))

    def _log_probability(self, state: np.ndarray, token: np.ndarray, slopes: dict | None = None
                         ) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log of each token's probability after its state; with ``slopes`` also the states' gradient.

        Rows are taken class by class, so each class's members are one product for its rows of a block.
        """
        p = self.params
        order = _sorted(self.class_of(token))
        state, token = state[order], token[order]
        of_class, member = self.class_of(token), self.member_of(token)
        out = np.empty(len(token))
        back = np.empty_like(state) if slopes is not None else None
        # The classes of one token come first; of the others each is one run of rows, cut where blocks end.
        words = int(np.searchsorted(of_class, 2))
        cuts = np.concatenate((np.searchsorted(of_class, np.arange(2, self.n_classes)), np.arange(0, len(token), BLOCK)))
        cuts = np.unique(cuts[(cuts >= words) & (cuts < len(token))])
        classes, ends = of_class[cuts].tolist(), [*cuts[1:].tolist(), len(token)]
        blocks = np.searchsorted(cuts, np.arange(0, len(token) + BLOCK, BLOCK)).tolist()
        for i, lo in enumerate(range(0, len(token), BLOCK)):
            hi = min(lo + BLOCK, len(token))
            logits = state[lo:hi] @ p["wc"]
            logits += p["bc"]
            out[lo:hi], g = _chosen(logits, of_class[lo:hi], slopes is not None)
            if slopes is not None:
                np.matmul(g, p["wc"].T, out=back[lo:hi])
                slopes["wc"] += state[lo:hi].T @ g
                slopes["bc"] += g.sum(axis=0)
            some = slice(blocks[i], blocks[i + 1]) if lo >= words else slice(0, blocks[i + 1])
            runs = list(zip(classes[some], map(slice, cuts[some].tolist(), ends[some]), strict=True))
            if not runs:
                continue
            lo = runs[0][1].start
            logits = np.empty((hi - lo, self.shape.class_size), np.float32)
            for c, rows in runs:
                own = logits[rows.start - lo:rows.stop - lo]
                np.matmul(state[rows], p["ww"][c], out=own)
                own += p["bw"][c]
            value, g = _chosen(logits, member[lo:hi], slopes is not None)
            out[lo:hi] += value
            if slopes is not None:
                slopes["bw"][classes[some]] += np.add.reduceat(g, cuts[some] - lo, axis=0)
                for c, rows in runs:
                    own = g[rows.start - lo:rows.stop - lo]
                    back[rows] += own @ p["ww"][c].T
                    slopes["ww"][c] += state[rows].T @ own
        return _put_back(out, order), back if back is None else _put_back(back, order)

    @np.errstate(over="ignore")
    def score(self, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Natural-log likelihood of each text (its tokens end with the end token).

        Texts are lanes that step together, longest first, ``SCORED_LANES`` at
        a time; the state stays with the lane until its text ends.
        Probabilities are worked out for ``SCORED_ROWS`` or more tokens at a time.
        """
        sizes, table = np.diff(offsets), self._inputs(slice(None))
        order = np.argsort(-sizes, kind="stable")
        out = np.zeros(len(sizes))
        for lo in range(0, len(order), SCORED_LANES):
            some = order[lo:lo + SCORED_LANES]
            out[some] = self._score_lanes(table, tokens, offsets[:-1][some], sizes[some])
        return out

    def _score_lanes(self, table: np.ndarray, tokens: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        lanes, h = len(sizes), self.shape.hidden
        out = np.zeros(lanes)
        state, before = np.zeros((h, lanes), np.float32), np.full(lanes, END)
        alive = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), side="left").tolist()
        states = np.empty((SCORED_ROWS + lanes, h), np.float32)
        targets, owners = np.empty(len(states), np.int64), np.empty(len(states), np.int64)
        every, rows, buffers = np.arange(lanes), 0, ()
        for t, n in enumerate(alive):
            if not buffers or n < buffers[-1].shape[1]:
                state, before, buffers = state[:, :n].copy(), before[:n], self._buffers(n)
            self._step(table.take(before, axis=1), state, buffers)
            state, buffers = buffers[-1], (*buffers[:-1], state)
            before = tokens[begins[:n] + t]
            states[rows:rows + n], targets[rows:rows + n], owners[rows:rows + n] = state.T, before, every[:n]
            rows += n
            if rows >= SCORED_ROWS or t == len(alive) - 1:
                out += np.bincount(owners[:rows], weights=self._log_probability(states[:rows], targets[:rows])[0],
                                   minlength=lanes)
                rows = 0
        return out

    @np.errstate(over="ignore")
    def train(self, tokens: np.ndarray, offsets: np.ndarray) -> None:
        """One pass over texts laid end to end in lanes, a window at a time, by Adagrad.

        The last lane is filled up with the first tokens, so none is left out.
        """
        shape, p, h = self.shape, self.params, self.shape.hidden
        lanes = min(shape.lanes, max(1, len(tokens) // (shape.window * shape.updates)))
        steps = -(-len(tokens) // lanes)
        if not steps:
            return
        line = np.resize(tokens, (lanes, steps))
        first = np.zeros(len(tokens) + 1, dtype=bool)
        first[offsets[:-1]] = True
        first = np.resize(first[:-1], (lanes, steps))
        squares = {k: np.full(v.shape, 1e-6, np.float32) for k, v in p.items()}
        g = {k: np.empty_like(v) for k, v in p.items()}
        gates, kept, new, states = self._buffers(shape.window, lanes)
        olds, d_x = np.empty_like(states), np.empty((shape.window, 3 * h, lanes), np.float32)
        state, before, through = np.zeros((h, lanes), np.float32), np.full(lanes, END), np.empty((h, lanes), np.float32)
        for start in range(0, steps, shape.window):
            n = min(steps - start, shape.window)
            after, begun = line[:, start:start + n].T, first[:, start:start + n].T
            inputs, going = np.where(begun, END, np.concatenate((before[None], after[:-1]))), (~begun).astype(np.float32)
            # The words that are read, and the place of each token's among them.
            flat = inputs.reshape(-1)
            order = _sorted(flat)
            begins = np.flatnonzero(np.diff(flat[order], prepend=-1))
            read = flat[order[begins]]
            place = _put_back(np.repeat(np.arange(len(read)), np.diff(begins, append=len(flat))), order).reshape(n, lanes)
            x = self._inputs(read)
            for t in range(n):
                np.multiply(state, going[t], out=olds[t])
                self._step(x.take(place[t], axis=1), olds[t], (gates[t], kept[t], new[t], states[t]))
                state = states[t]
            state, before = state.copy(), after[-1]
            for k in ("wc", "bc", "ww", "bw"):
                g[k].fill(0)
            _, back = self._log_probability(_rows(states[:n]), after.reshape(-1), g)
            back = np.ascontiguousarray(back.reshape(n, lanes, h).swapaxes(1, 2))
            carry = np.zeros((h, lanes), np.float32)
            for t in range(n - 1, -1, -1):
                update, reset, d = gates[t, :h], gates[t, h:], back[t]
                d_update, d_reset, d_new = d_x[t, :h], d_x[t, h:2 * h], d_x[t, 2 * h:]
                d += carry
                np.multiply(d, update, out=carry)
                np.multiply(new[t], new[t], out=d_new)
                np.subtract(1, d_new, out=d_new)
                d_new *= carry
                np.matmul(p["wh"][:, 2 * h:], d_new, out=through)
                np.subtract(new[t], states[t], out=d_update)
                d_update *= carry
                np.subtract(1, reset, out=d_reset)
                d_reset *= kept[t]
                d_reset *= through
                through *= reset
                d -= carry
                through += d
                np.matmul(p["wh"][:, :2 * h], d_x[t, :2 * h], out=carry)
                carry += through
                carry *= going[t]
            d = d_x[:n]
            g["wh"][:, :2 * h] = np.matmul(olds[:n], d[:, :2 * h].swapaxes(1, 2)).sum(axis=0)
            g["wh"][:, 2 * h:] = np.matmul(kept[:n], d[:, 2 * h:].swapaxes(1, 2)).sum(axis=0)
            of_word = np.add.reduceat(_rows(d)[order], begins, axis=0)
            g["b"] = of_word.sum(axis=0)
            g["wx"] = p["emb"][read].T @ of_word
            # Only words that were read have a slope.
            g["emb"] = of_word @ p["wx"].T
            norm = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
            scale = min(1.0, shape.clip * n * lanes / max(norm, 1e-9))
            for k, x in g.items():
                x *= scale / (n * lanes)
                at = read if k == "emb" else slice(None)
                square = squares[k][at]
                square += x * x
                x *= shape.rate
                x /= np.sqrt(square)
                p[k][at] -= x
                if k == "emb":
                    squares[k][at] = square


def _chosen(logits: np.ndarray, choice: np.ndarray, sloped: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log of the softmax of each row's choice and, if ``sloped``, its gradient by row and choice."""
    rows = np.arange(len(choice))
    picked = logits[rows, choice]
    ones = np.ones(logits.shape[1], np.float32)
    parts = np.exp(logits)
    total = parts @ ones
    if not (total.min() > FAR ** -1 and total.max() < FAR):  # shifted where powers are too large or too small
        logits = logits - logits.max(axis=1)[:, None]
        picked, parts = logits[rows, choice], np.exp(logits)
        total = parts @ ones
    if sloped:
        parts *= (1 / total)[:, None]
        parts[rows, choice] -= 1
    return picked - np.log(total), parts if sloped else None


def _rows(columns: np.ndarray) -> np.ndarray:
    """Columns of each step as rows, step by step."""
    return columns.swapaxes(1, 2).reshape(-1, columns.shape[1])


def _sorted(values: np.ndarray) -> np.ndarray:
    """The stable order of whole numbers from 0 on; numbers of 16 bits are sorted by radix."""
    small = values.max(initial=0) < 1 << 16
    return np.argsort(values.astype(np.uint16) if small else values, kind="stable")


def _put_back(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty_like(rows)
    out[order] = rows
    return out
