"""Quality rules: counts over a whole text, and a linear-chain conditional random field over its lines.

The field marks each line as content or boilerplate: its features are the look of the line and how it repeats,
its transitions are learned, Viterbi decoding picks the best sequence. The share of a text's words on
content lines decides whether it is kept.

The field is trained in numpy on the lines of a bounded sample of labelled texts. Labels are of whole
texts, so all lines of a good one count as content, of a bad one as boilerplate; plain lines inside bad
texts are outweighed by the many plain lines of good ones.

Edge cases: a null, empty or blank text has no words, fails the base rules and is not kept. Without labelled
texts of both classes the base rules decide alone. Very long texts are decoded whole. A verdict depends on the
text alone, so ties, repeated rows and other columns change nothing.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import raw, struct_array, text_column

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
TRAIN_LINES = 64  # lines in a training sequence; longer texts are several
#: Words that lines of menus, notices and footers are made of.
NOTICE = frozenset(b"cookie cookies login logout subscribe newsletter javascript menu sitemap copyright rights reserved privacy terms share tweet click".split())
N_FEATURES = 14
RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


@dataclass
class LineField:
    emission: np.ndarray  # (features, 2): boilerplate, content
    transition: np.ndarray  # (2, 2)
    start: np.ndarray  # (2,)


def repeat_words(ids: np.ndarray) -> int:
    """Words in windows of WINDOW that occur twice or more; ids number the words from 0."""
    n = len(ids)
    if n <= WINDOW:
        return 0
    code, width = ids.astype(np.int64), int(ids.max()) + 1
    grams = code[: n - WINDOW + 1]
    for k in range(1, WINDOW):  # numbering anew after each word keeps the codes exact
        grams = grams * width + code[k : n - WINDOW + 1 + k]
        grams = np.unique(grams, return_inverse=True)[1]
    many = np.bincount(grams)[grams] > 1
    if not many.any():
        return 0
    mark = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(many)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + WINDOW, -1)
    return int((np.cumsum(mark[:n]) > 0).sum())


def measure(text: bytes | None) -> tuple[tuple[int, int, int, int, int], list[list[float]], list[int]]:
    """The base counts, and the features and number of words of each line with a word."""
    if not text:
        return (0, 0, 0, 0, 0), [], []
    seen: dict[bytes, int] = {}
    numbers: dict[bytes, int] = {}
    ids: list[int] = []
    features, sizes = [], []
    dup_lines, word_bytes = 0, 0
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        n = len(words)
        times = seen.get(line, 0)
        seen[line] = times + 1
        dup_lines += times > 0
        ids += [numbers.setdefault(w, len(numbers)) for w in words]
        letters = sum(map(len, words))
        word_bytes += letters
        upper = len(line) - len(line.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        lower = len(line) - len(line.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
        symbols = len(line) - len(line.translate(None, SYMBOLS))
        digits = len(line) - len(line.translate(None, b"0123456789"))
        marks = line.count(b"!") + line.count(b"?")
        distinct = len(set(words)) / n
        adjacent = sum(a == b for a, b in zip(words, words[1:])) / n
        last = line.rstrip()[-1:]
        notices = sum(w.lower().strip(b".,:;!") in NOTICE for w in words) if n < 30 else 0
        features.append(
            [
                1.0,
                min(1.0, 4.0 * symbols / n),
                float(4 * symbols > n),
                upper / (upper + lower + 1),
                float(upper > lower),
                min(1.0, 2.0 * marks / n),
                float(2 * marks > n),
                digits / letters,
                1.0 - distinct if n > 20 else 0.0,
                float(adjacent > 0.3),
                float(last in (b".", b"!", b"?", b'"')),
                float(n < 4),
                float(notices > 0),
                float(times > 0),
            ]
        )
        sizes.append(n)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    if not ids:
        return (0, 0, symbols, dup_lines, 0), features, sizes
    chars = word_bytes if text.isascii() else len(b"".join(text.split()).decode())
    return (len(ids), chars, symbols, dup_lines, repeat_words(np.array(ids, dtype=np.int64))), features, sizes


def _forward_backward(x: np.ndarray, mask: np.ndarray, y: np.ndarray, field: LineField, weight: np.ndarray):
    """Mean loss and gradients of padded sequences: x (docs, lines, features), y the marks, by dynamic programming."""
    emit = x @ field.emission
    n, steps, _ = emit.shape
    alpha = np.empty_like(emit)
    beta = np.zeros_like(emit)
    alpha[:, 0] = emit[:, 0] + field.start
    for t in range(1, steps):
        new = np.logaddexp(alpha[:, t - 1, 0, None] + field.transition[0], alpha[:, t - 1, 1, None] + field.transition[1]) + emit[:, t]
        alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
    for t in range(steps - 2, -1, -1):
        ahead = beta[:, t + 1] + emit[:, t + 1]
        new = np.logaddexp(field.transition[:, 0] + ahead[:, 0, None], field.transition[:, 1] + ahead[:, 1, None])
        beta[:, t] = np.where(mask[:, t + 1, None], new, beta[:, t + 1])
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    marginal = np.exp(np.clip(alpha + beta - z[:, None, None], -50, 0)) * mask[:, :, None] * weight[:, None, None]
    truth = np.eye(2)[y] * mask[:, :, None] * weight[:, None, None]
    g_emit = np.einsum("ntf,nts->fs", x, marginal - truth)
    g_start = (marginal - truth)[:, 0].sum(0)
    g_trans = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pair = alpha[:, :-1, a] + field.transition[a, b] + emit[:, 1:, b] + beta[:, 1:, b] - z[:, None]
            expected = np.exp(np.clip(pair, -50, 0)) * mask[:, 1:] * weight[:, None]
            real = ((y[:, :-1] == a) & (y[:, 1:] == b)) * mask[:, 1:] * weight[:, None]
            g_trans[a, b] = (expected - real).sum()
    return g_emit, g_trans, g_start


def train(texts: list[str], good: list[int], steps: int = 200) -> LineField | None:
    sequences, marks = [], []
    for text, y in zip(texts, good):
        lines = measure((text or "").encode())[1]
        for at in range(0, len(lines), TRAIN_LINES):
            sequences.append(np.array(lines[at : at + TRAIN_LINES]))
            marks.append(int(y))
    if len(set(marks)) < 2:
        return None
    longest = max(map(len, sequences))
    x = np.zeros((len(sequences), longest, N_FEATURES))
    mask = np.zeros((len(sequences), longest), dtype=bool)
    for i, s in enumerate(sequences):
        x[i, : len(s)], mask[i, : len(s)] = s, True
    marks = np.array(marks)
    y = np.repeat(marks[:, None], longest, 1)
    weight = np.where(marks == 1, 0.5 / (marks == 1).sum(), 0.5 / (marks == 0).sum()) / mask.sum(1) * 4
    field = LineField(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (field.emission, field.transition, field.start)]
    for step in range(1, steps + 1):
        grads = _forward_backward(x, mask, y, field, weight)
        for p, g, (m, v) in zip((field.emission, field.transition, field.start), grads, moments):
            g = g + 1e-3 * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    # Staying in a mark is worth as much as a strong feature at most: one junk line stays one line.
    field.transition = np.clip(field.transition - field.transition.mean(), -2, 2)
    return field


def viterbi(field: LineField, lines: list[list[float]]) -> list[int]:
    """The best marks of the lines: 1 is content. Equal scores go to content."""
    emit = (np.array(lines) @ field.emission).tolist()
    (t00, t01), (t10, t11) = field.transition.tolist()
    bad, fine = emit[0][0] + field.start[0], emit[0][1] + field.start[1]
    back = []
    for e0, e1 in emit[1:]:
        to_bad, to_fine = (bad + t00 > fine + t10), (bad + t01 > fine + t11)
        back.append((0 if to_bad else 1, 0 if to_fine else 1))
        bad, fine = max(bad + t00, fine + t10) + e0, max(bad + t01, fine + t11) + e1
    mark = 1 if fine >= bad else 0
    out = [mark]
    for step in reversed(back):
        mark = step[mark]
        out.append(mark)
    return out[::-1]


def fit(labelled: DataFrame, max_rows: int = 4000) -> LineField | None:
    """Train on at most ``max_rows`` rows of (id, text, quality), half of each class, picked by a hash of the
    id; that bounds the sample that goes to the driver."""
    picked = labelled.orderBy(F.xxhash64("id"), "id")
    rows = [r for q in (0, 1) for r in picked.filter(F.col("quality") == q).limit(max_rows // 2).collect()]
    return train([r.text for r in rows], [r.quality for r in rows])


def rules(text: Column, field: LineField | None, min_words: int = 10, max_repeat: int = 20, min_share: float = 0.5) -> Column:
    """A struct of RESULT's fields. ``max_repeat`` is in percent of the words."""

    def judge(text: bytes | None) -> tuple:
        counts, lines, sizes = measure(text)
        failed = counts[0] < min_words or 100 * counts[4] > max_repeat * counts[0]
        share = 1.0 if sizes else 0.0
        if field is not None and sizes:
            share = sum(n for n, mark in zip(sizes, viterbi(field, lines)) if mark) / counts[0]
        return *counts, failed, share, not failed and share >= min_share

    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    names = [c.split()[0] for c in RESULT.split(", ")]

    def work():
        def do(texts: pa.Array) -> pa.Array:
            columns = zip(*[judge(t) for t in raw(texts)])
            return struct_array(**{n: pa.array(c, type=t) for n, c, t in zip(names, columns, types)})

        return do

    return text_column(work, RESULT, pa.struct(list(zip(names, types))))(text)
