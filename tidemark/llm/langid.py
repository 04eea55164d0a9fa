"""Language identification in two steps: the family first, then linear machines between its languages.

Features are hashed letter sequences of one to three letters over the whole lower-cased text. A linear
machine per family picks the family; within it, one squared-hinge support vector machine for each pair of
languages votes, and ties go to the larger sum of margins, then to the first language in order.

Edge cases: a null text, or one without a letter, gives ``und`` and score 0.0, as does a model without
training rows. Ties, repeated rows and other columns change nothing: a prediction depends on its text alone.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import struct_array, text_column, unit_hash

DIMENSIONS = 1 << 12
#: Families of common languages. A language not named here is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "turkic": "tr az kk uz ky tk",
    "indo-aryan": "hi ur bn mr gu pa ne si",
    "uralic": "fi et hu",
    "semitic": "ar he am mt",
    "baltic": "lt lv",
    "celtic": "ga cy br gd",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


@dataclass
class LanguageModel:
    families: list[str]
    members: list[list[str]]  # by family
    family_weights: np.ndarray  # (families, DIMENSIONS + 1)
    pairs: list[dict[tuple[int, int], np.ndarray]]  # by family


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter. Made once in a process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, DIMENSIONS) rows of length 1, and which texts have a letter."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    known = np.zeros(len(texts), dtype=bool)
    table = letters()
    for i, text in enumerate(texts):
        if not text:
            continue
        code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        is_letter = table[code]
        if not is_letter.any():
            known[i] = any(ch.isalpha() for ch in text)
            continue
        known[i] = True
        a = np.where(is_letter, code, 1).astype(np.uint32)
        one = a * np.uint32(2654435761)
        counts = np.bincount(one[is_letter] >> np.uint32(20), minlength=DIMENSIONS)
        if len(a) > 2:
            two = (one[:-1] ^ (a[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
            three = (two[:-1] ^ (a[2:] * np.uint32(668265263))) * np.uint32(374761393)
            counts = counts + np.bincount(two >> np.uint32(20), minlength=DIMENSIONS) + np.bincount(three >> np.uint32(20), minlength=DIMENSIONS)
        row = np.sqrt(counts.astype(np.float32))
        out[i] = row / np.sqrt((row * row).sum())
    return out, known


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Squared-hinge linear machine by accelerated gradient descent; y is -1 or 1, classes weigh the same."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    x1 = np.concatenate([x, np.ones((len(x), 1), dtype=np.float32)], 1)
    w = look = np.zeros(x1.shape[1], dtype=np.float32)
    rate = 1 / (2 * 2 + penalty)
    for k in range(steps):
        gap = np.maximum(0, 1 - y * (x1 @ look))
        grad = penalty * look - 2 * ((weight * gap * y) @ x1)
        new = look - rate * grad
        look = new + (k / (k + 3)) * (new - w)
        w = new
    return w


def train(texts: list[str], langs: list[str]) -> LanguageModel | None:
    x, known = features(texts)
    langs = np.array(langs, dtype=object)[known]
    x = x[known]
    if not len(x):
        return None
    codes = sorted(set(langs))
    families = sorted({FAMILY.get(c, c) for c in codes})
    members = [[c for c in codes if FAMILY.get(c, c) == f] for f in families]
    of = np.array([families.index(FAMILY.get(c, c)) for c in langs])
    weights = np.stack([svm(x, np.where(of == i, 1, -1).astype(np.float32)) for i in range(len(families))])
    pairs = []
    for names in members:
        own = {}
        for i in range(len(names)):
            for j in range(i + 1, len(names)):
                rows = (langs == names[i]) | (langs == names[j])
                own[i, j] = svm(x[rows], np.where(langs[rows] == names[i], 1, -1).astype(np.float32))
        pairs.append(own)
    return LanguageModel(families, members, weights, pairs)


def predict(model: LanguageModel, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each row: the chance of the family times that of the language in it."""
    x1 = np.concatenate([x, np.ones((len(x), 1), dtype=np.float32)], 1)
    margins = x1 @ model.family_weights.T
    chance = 1 / (1 + np.exp(-4 * np.clip(margins, -8, 8)))
    best = margins.argmax(1)
    lang = np.empty(len(x), dtype=object)
    score = np.empty(len(x))
    for f, names in enumerate(model.members):
        rows = np.flatnonzero(best == f)
        if not len(rows):
            continue
        votes, sums, sure = (np.zeros((len(rows), len(names))) for _ in range(3))
        sure += 1
        for (i, j), w in model.pairs[f].items():
            margin = x1[rows] @ w
            votes[:, i] += margin >= 0
            votes[:, j] += margin < 0
            sums[:, i] += margin
            sums[:, j] -= margin
            p = 1 / (1 + np.exp(-4 * np.clip(margin, -8, 8)))
            sure[:, i] = np.minimum(sure[:, i], p)
            sure[:, j] = np.minimum(sure[:, j], 1 - p)
        top = np.lexsort((-np.arange(len(names))[None].repeat(len(rows), 0), sums, votes), axis=1)[:, -1]
        lang[rows] = np.array(names, dtype=object)[top]
        own = chance[rows, f] if len(model.families) > 1 else np.ones(len(rows))
        score[rows] = own * sure[np.arange(len(rows)), top]
    return lang, score


def fit(labelled: DataFrame, per_language: int = 1000) -> LanguageModel | None:
    """Train on about ``per_language`` different rows of (id, text, lang) for each language, picked by a hash of id and
    text: the sample that goes to the driver is at most twice that for each language."""
    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_language / n))])
    sample = known.filter(unit_hash("id", "text", seed=4) < share[F.col("lang")]).select("id", "text", "lang").distinct()
    rows = sample.limit(2 * per_language * len(counts)).collect()
    rows.sort(key=lambda r: (r.lang, r.text))
    return train([r.text for r in rows], [r.lang for r in rows])


def identify(text: Column, model: LanguageModel | None) -> Column:
    """struct(lang, score) of a text."""
    if model is None:
        return F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))

    def work():
        def do(texts: pa.Array) -> pa.Array:
            all_texts, langs, scores = texts.to_pylist(), [], []
            for at in range(0, len(all_texts), 256):
                x, known = features(all_texts[at : at + 256])
                lang, score = predict(model, x)
                langs += [a if k else "und" for a, k in zip(lang, known)]
                scores.append(np.where(known, score, 0.0))
            return struct_array(lang=pa.array(langs, type=pa.string()), score=pa.array(np.concatenate(scores)))

        return do

    return text_column(work, "lang string, score double", pa.struct([("lang", pa.string()), ("score", pa.float64())]))(text)
