"""Sampled segmentation over the piece lattice, for many texts at once in numpy.

A text is written with ``▁`` for each space and one more in front, then cut
between any two characters that stand side by side in no piece. The cuts
make the lattice a product, so segments are sampled independently.

Forward filtering, once per distinct segment of a block: alpha[e] sums, over
the pieces ending at e, alpha[start] times the piece's weight. Backward
sampling, once per occurrence: from the end, a piece is drawn in proportion
to alpha[start] * weight, until the start is reached. The draws come from a
hash of (row key, segment number, step), so they depend on nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

SPACE = "▁"
FALLBACK = 1 << 24  # codes from here on: FALLBACK + code point, written as byte pieces
_WHOLE = 48         # longer segments are filtered one by one with rescaling
_SCALE = 1e3        # per character, keeps alpha of short segments in range


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Vocabulary:
    """Pieces with their weights; ``byte_ids[b]`` is the piece of the raw byte b."""

    pieces: list[str]           # by id; "" for control and byte pieces
    weights: np.ndarray
    byte_ids: np.ndarray
    fallback_weight: float
    _trie: tuple | None = field(default=None, repr=False)
    _pairs: tuple | None = field(default=None, repr=False)

    @classmethod
    def load(cls, path: str, theta: float = 0.8) -> Vocabulary:
        """Read a model file. The files rank pieces rather than give their
        probabilities, so a piece of rank k gets the Zipf weight
        (k + 1) ** -theta; a smaller ``theta`` gives more varied segmentations."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if (byte_ids == model.unk_id()).any():
            raise ValueError("the model has no byte pieces, so decoding would not be lossless")
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for i in range(size)]
        pieces = [model.id_to_piece(i) if p else "" for i, p in enumerate(plain)]
        rank = np.cumsum(plain)
        weights = np.where(plain, (rank + 1.0) ** -theta, 0.0)
        return cls(pieces, weights, byte_ids, float((size + 1.0) ** (-2 * theta)))

    def __getstate__(self):
        return self.__dict__ | {"_trie": None, "_pairs": None}  # rebuilt in each task

    @property
    def trie(self):
        """(first, keys, states, piece of each state, longest piece): transitions in an open-addressing table."""
        if self._trie is None:
            children: list[dict[str, int]] = [{}]
            piece = [-1]
            for i, p in enumerate(self.pieces):
                at = 0
                for ch in p:
                    nxt = children[at].get(ch)
                    if nxt is None:
                        nxt = children[at][ch] = len(children)
                        children.append({})
                        piece.append(-1)
                    at = nxt
                if p:
                    piece[at] = i
            keys = np.array([(s << 21) | ord(c) for s, d in enumerate(children) for c in d], np.uint64)
            to = np.array([t for d in children for t in d.values()], np.int32)
            bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
            slots, states = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64), np.zeros(1 << bits, np.int32)
            left, at = np.arange(len(keys)), self._slot(keys, bits)
            probes = 0
            while len(left):
                free = slots[at] == np.iinfo(np.uint64).max
                where, who = np.unique(at[free], return_index=True)
                placed = left[free][who]
                slots[where], states[where] = keys[placed], to[placed]
                keep = ~np.isin(left, placed)
                left, at = left[keep], (at[keep] + 1) & ((1 << bits) - 1)
                probes += 1
            first = np.zeros(0x110000, np.int32)
            for c, t in children[0].items():
                first[ord(c)] = t
            self._trie = (children, slots, states, np.array(piece, np.int32),
                          max(map(len, self.pieces), default=1), bits, probes, first)
        return self._trie

    @property
    def neighbours(self):
        """(class of each code point, side by side in some piece?): what may not be cut."""
        if self._pairs is None:
            pairs = {(a, b) for p in self.pieces for a, b in zip(p, p[1:], strict=False)}
            chars = sorted({c for pair in pairs for c in pair})
            number = {c: i + 1 for i, c in enumerate(chars)}
            classes = np.zeros(0x110000, np.int32)
            classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
            joined = np.zeros((len(chars) + 1) ** 2, bool)
            joined[[number[a] * (len(chars) + 1) + number[b] for a, b in pairs]] = True
            self._pairs = (classes, joined, len(chars) + 1)
        return self._pairs

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Trie states after one more character; 0 where there is none."""
        _, slots, states, _, _, bits, probes, _ = self.trie
        keys = (state.astype(np.uint64) << np.uint64(21)) | char.astype(np.uint64)
        at = self._slot(keys, bits)
        out = np.where(slots[at] == keys, states[at], 0)
        left = np.flatnonzero((out == 0) & (slots[at] != np.iinfo(np.uint64).max))
        for _ in range(1, probes):
            if not len(left):
                break
            at_left = (at[left] + 1) & ((1 << bits) - 1)
            at[left] = at_left
            hit = slots[at_left] == keys[left]
            out[left[hit]] = states[at_left[hit]]
            left = left[~hit & (slots[at_left] != np.iinfo(np.uint64).max)]
        return out


class _Filtered:
    """Forward-filtered segments of one length: cumulative draw probabilities and piece codes by (segment, end, len)."""

    def __init__(self, vocab: Vocabulary, chars: np.ndarray):
        rows, length = chars.shape
        piece, longest, first = vocab.trie[3], min(vocab.trie[4], length), vocab.trie[7]
        columns = np.ascontiguousarray(chars.T)
        weight = np.zeros((length + 1, longest, rows))
        code = np.zeros((length + 1, longest, rows), np.int32)
        for start in range(length):
            state, live = first[columns[start]], np.arange(rows)
            for n in range(1, min(longest, length - start) + 1):
                if n > 1:
                    state = vocab.step(state, columns[start + n - 1][live])
                alive = state > 0
                if not alive.all():
                    live, state = live[alive], state[alive]
                if not len(live):
                    break
                found = piece[state]
                ok = found >= 0
                where, found = live[ok], found[ok]
                weight[start + n, n - 1][where] = vocab.weights[found]
                code[start + n, n - 1][where] = found
            lone = weight[start + 1, 0] == 0  # a character without a piece of its own
            if lone.any():
                weight[start + 1, 0][lone] = vocab.fallback_weight
                code[start + 1, 0][lone] = FALLBACK + columns[start][lone].astype(np.int32)
        alpha = np.zeros((length + 1, rows))
        alpha[0] = 1.0
        scale = (_SCALE ** np.arange(1, longest + 1))[:, None]
        for end in range(1, length + 1):
            n = min(longest, end)
            weight[end, :n] *= alpha[end - n:end][::-1] * scale[:n]
            np.cumsum(weight[end], axis=0, out=weight[end])
            alpha[end] = weight[end, -1]
            weight[end] /= alpha[end]
        self.cum = np.ascontiguousarray(weight.astype(np.float32).transpose(2, 0, 1))
        self.code = np.ascontiguousarray(code.transpose(2, 0, 1))
        self.longest = longest

    def sample(self, row: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(occurrence, step from the end, code) of every drawn piece."""
        length = self.cum.shape[1] - 1
        who, at = np.arange(len(row)), np.full(len(row), length)
        got = []
        step = 0
        while len(who):
            u = (_mix(seed[who] + np.uint64(step) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) * 2.0 ** -24
            cum = self.cum[row[who], at]
            n = (cum <= u[:, None].astype(np.float32)).sum(axis=1)
            # rounding may leave the last sum below one: take the last piece that has weight then
            over = n >= self.longest
            if over.any():
                n[over] = (cum[over] < cum[over][:, -1:]).sum(axis=1)
            got.append((who, np.full(len(who), step), self.code[row[who], at, n]))
            at = at - n - 1
            who, at = who[at > 0], at[at > 0]
            step += 1
        return tuple(np.concatenate(x) for x in zip(*got, strict=True))


def sample_long(vocab: Vocabulary, segment: str, seed: int) -> list[int]:
    """The same forward filter and backward draws for one long segment, rescaled as it goes."""
    children, _, _, piece, longest, _, _, _ = vocab.trie
    size = len(segment)
    ending: list[list[tuple[int, float, int]]] = [[] for _ in range(size + 1)]
    for start in range(size):
        at, lone = 0, True
        for n in range(1, min(longest, size - start) + 1):
            at = children[at].get(segment[start + n - 1], 0)
            if not at:
                break
            if piece[at] >= 0:
                ending[start + n].append((n, float(vocab.weights[piece[at]]), int(piece[at])))
                lone = lone and n > 1
        if lone:
            ending[start + 1].append((1, vocab.fallback_weight, FALLBACK + ord(segment[start])))
    log_alpha = np.full(size + 1, -np.inf)
    log_alpha[0] = 0.0
    for end in range(1, size + 1):
        terms = [log_alpha[end - n] + np.log(w) for n, w, _ in ending[end]]
        if terms:
            top = max(terms)
            if np.isfinite(top):
                log_alpha[end] = top + np.log(sum(np.exp(t - top) for t in terms))
    out, end, step = [], size, 0
    while end:
        u = int(_mix(np.array([seed], np.uint64) + np.uint64(step) * np.uint64(0x9E3779B97F4A7C15))[0] >> np.uint64(40)) * 2.0 ** -24
        options = sorted(x for x in ending[end] if np.isfinite(log_alpha[end - x[0]]))
        p = np.cumsum([np.exp(log_alpha[end - n] + np.log(w) - log_alpha[end]) for n, w, _ in options])
        n, _, code = options[min(int((p <= u).sum()), len(options) - 1)]
        out.append(code)
        end -= n
        step += 1
    return out[::-1]


_LITERAL = "\ud800"  # stands for a ``▁`` of the text itself; no text holds a lone surrogate


def written(text: str | None) -> str:
    """The text as the lattice sees it; an empty text stays empty."""
    if not text:
        return ""
    if SPACE in text:
        text = text.replace(SPACE, _LITERAL)
    return SPACE + text.replace(" ", SPACE)


def utf8_lengths(code_points: np.ndarray) -> np.ndarray:
    return 1 + (code_points >= 0x80).astype(np.int64) + (code_points >= 0x800) + (code_points >= 0x10000)


def expand_fallback(codes: np.ndarray, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids, and how many ids each code became; fallback characters become their UTF-8 bytes' pieces."""
    far = codes >= FALLBACK
    count = np.ones(len(codes), np.int64)
    if not far.any():
        return codes.astype(np.int32), count
    points = (codes - FALLBACK)[far]
    points[points == ord(_LITERAL)] = ord(SPACE)
    count[far] = utf8_lengths(points)
    out = np.repeat(np.where(far, 0, codes), count).astype(np.int32)
    data = np.frombuffer("".join(map(chr, points)).encode(), np.uint8)
    out[np.repeat(far, count)] = byte_ids[data]
    return out, count


def _distinct(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each distinct row, number of each row's distinct row)."""
    factors = _mix(np.arange(1, chars.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    _, first, number = np.unique(_mix((chars * factors).sum(axis=1, dtype=np.uint64)),
                                 return_index=True, return_inverse=True)
    if (chars[first[number]] != chars).any():  # two rows with one hash
        _, first, number = np.unique(chars, axis=0, return_index=True, return_inverse=True)
    return first, number.reshape(-1)


class Sampler:
    """Encodes texts in blocks of at most ``block`` characters (or one text)."""

    def __init__(self, vocab: Vocabulary, seed: int = 0, block: int = 500_000):
        self.vocab, self.seed, self.block = vocab, np.uint64(seed), block

    def encode(self, keys: np.ndarray, texts: list[str | None]):
        """Yields blocks in order: (number of texts, all their ids, number of ids per text)."""
        at = 0
        while at < len(texts):
            parts, size, until = [], 0, at
            while until < len(texts) and size < self.block:
                parts.append(written(texts[until]))
                size += len(parts[-1])
                until += 1
            with np.errstate(over="ignore"):
                yield until - at, *self._encode(keys[at:until], parts)
            at = until

    def _encode(self, keys: np.ndarray, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(len(parts), np.int64)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        classes, joined, width = self.vocab.neighbours
        kind = classes[chars]
        cut = np.ones(len(chars) + 1, bool)
        cut[1:-1] = ~joined[kind[:-1] * width + kind[1:]]
        begins = np.cumsum(sizes) - sizes
        cut[begins[sizes > 0]] = True
        bounds = np.flatnonzero(cut)
        start, length = bounds[:-1], np.diff(bounds)
        owner = np.searchsorted(begins + sizes, start, side="right")
        first_of = np.searchsorted(start, begins)
        nth = np.arange(len(start)) - first_of[owner]
        key = _mix(keys.astype(np.int64).view(np.uint64) + self.seed * np.uint64(0xD1342543DE82EF95))
        base = _mix(key[owner] + nth.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))

        drawn = np.ones(len(start), np.int64)
        got = []
        for n in np.unique(length):
            here = np.flatnonzero(length == n)
            if n > _WHOLE:
                for i in here:
                    c = sample_long(self.vocab, chars[start[i]:start[i] + n].tobytes().decode(
                        "utf-32-le", "surrogatepass"), int(base[i]))
                    drawn[i] = len(c)
                    got.append((np.full(len(c), i), np.arange(len(c))[::-1], np.array(c, np.int32)))
                continue
            rows = chars[start[here][:, None] + np.arange(n)]
            first, number = _distinct(rows) if n > 1 else np.unique(
                rows[:, 0], return_index=True, return_inverse=True)[1:]
            for at in range(0, len(first), 20_000):  # bounds the lattices held at once
                inside = slice(None) if len(first) <= 20_000 else np.flatnonzero(
                    (number >= at) & (number < at + 20_000))
                filtered = _Filtered(self.vocab, rows[first[at:at + 20_000]])
                mine = here[inside]
                o, s, c = filtered.sample(number[inside] - at, base[mine])
                drawn[mine] = np.bincount(o, minlength=len(mine))
                got.append((mine[o], s, c))
        ordered = np.empty(int(drawn.sum()), np.int32)
        last = np.cumsum(drawn) - 1
        for o, s, c in got:
            ordered[last[o] - s] = c  # steps run from a segment's end
        ids, count = expand_fallback(ordered, self.vocab.byte_ids)
        return ids, np.bincount(np.repeat(owner, drawn), weights=count, minlength=len(parts)).astype(np.int64)


class Decoder:
    """Piece ids back to text."""

    def __init__(self, vocab: Vocabulary):
        data = [p.replace(SPACE, " ").encode() for p in vocab.pieces]
        for b, i in enumerate(vocab.byte_ids):
            data[i] = bytes([b])
        self.size = np.array([len(d) for d in data], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(data), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets): text i is ``bytes[offsets[i]:offsets[i + 1]]``, without the space put in front."""
        size = self.size[ids]
        before = np.cumsum(size) - size
        flat = self.data[np.repeat(self.start[ids] - before, size) + np.arange(int(size.sum()))]
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)]
        starts = np.concatenate([[0], ends[:-1]])
        keep = np.ones(len(flat), bool)
        keep[starts[counts > 0]] = False
        return flat[keep], np.concatenate([[0], ends - np.cumsum(counts > 0)])
