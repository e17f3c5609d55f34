"""The statistics of a text that the quality rules test; kept apart so that tasks import numpy only."""

from __future__ import annotations

import math

import numpy as np

#: Statistics of a text, each a share, a mean or the logarithm of a count.
STATISTICS = ("log_words", "word_length", "distinct_words", "stop_share", "upper_share", "digit_share", "symbol_share",
              "punctuation_share", "line_words", "distinct_lines", "short_lines", "ended_lines", "case_variants",
              "pipe_share", "longest_word", "capital_words", "odd_letters", "sentence_words", "distinct_pairs")


_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#*$%&|<>{}[]=_~^\\/@"


def measured(text: bytes) -> list[float]:
    """The statistics of a text, in the order of ``STATISTICS``."""
    size = len(text)
    without = lambda chars: (size - len(text.translate(None, chars))) / max(1, size)
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    m = len(lines)
    lengths = np.array([len(w) for w in words], np.int64)
    share = lambda x: x / max(1, n)
    kinds = set(words)
    return [
        math.log1p(n), float(lengths.sum()) / max(1, n), share(len(kinds)), share(int((lengths <= 3).sum())), without(_UPPER),
        without(b"0123456789"), without(_SYMBOLS), without(b".,;:!?"), n / max(1, m), len(set(lines)) / max(1, m),
        sum(len(x) < 20 for x in lines) / max(1, m), sum(x.rstrip()[-1] in b".!?" for x in lines) / max(1, m),
        share(len(kinds) - len({w.lower() for w in kinds})), without(b"|"), math.log1p(int(lengths.max()) if n else 0),
        share(sum(w[0] in _UPPER for w in words)), without(_HIGH), share(sum(w[-1] in b".!?" for w in words)),
        len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)]


_HIGH = bytes(range(128, 256))
