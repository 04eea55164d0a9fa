"""Toxicity: a convolutional text classifier in numpy, trained on all labelled texts and applied to whole texts by Spark.

A word is hashed whole and by its beginnings and endings; hashes seen in training have an embedding, others none, and
the word's is their highest component by component: one telling part is enough. Filters one, two and three words wide run over the whole text, the highest answer of each filter goes to
a logistic layer. The language that a text's own words point to picks the threshold, which the score moves
to 0.5. The column ``lang`` is only a target when the language table is learned; no score reads it.

Edge cases: a null or empty text has no words and gets the score of that; without labelled rows of both
classes every score is 0.0. Ties, repeated rows and other columns change nothing: a score depends on its
text alone.
"""

import zlib
from copy import deepcopy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, raw, text_column
from tidemark.session import settle

WIDTHS = (1, 2, 3)
PAD = max(WIDTHS)
EDGES = " \t\r\n.,;:!?\"'()[]{}<>|*#%&$-_"
#: Words whose vectors a task remembers.
REMEMBERED = 300_000
#: Learning rate of the embedding.
RATE = 0.05


@dataclass
class ToxicityModel:
    buckets: np.ndarray  # of embedding rows
    embedding: np.ndarray
    filters: list[np.ndarray]  # by width: (width, size, filters)
    bias: list[np.ndarray]
    dense: np.ndarray
    offset: float
    languages: list[str]
    language_rows: np.ndarray  # log-odds of each language for each embedding row
    thresholds: np.ndarray  # by language


def hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the parts of each word, and to which word each belongs: the whole word, its first three to eight
    letters, its last three to five. Case and marks at the ends do not count; 64 bits, so that parts hardly meet."""
    clean = [w.strip(EDGES) for w in b"\n".join(words).decode("utf-8", "replace").lower().split("\n")]
    letters = np.frombuffer("".join(clean).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, clean), dtype=np.int64, count=len(clean))
    end = np.cumsum(length)
    start = end - length
    buckets, of = [], []

    def add(which: np.ndarray, code: np.ndarray, tag: int) -> None:
        mixed = (code + np.uint64(tag)) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append(mixed ^ (mixed >> np.uint64(29)))
        of.append(which)

    times = np.uint64(0x100000001B3)
    some = np.flatnonzero(length)
    whole = np.fromiter((zlib.crc32(w.encode()) for w in clean), dtype=np.uint64, count=len(clean))
    add(some, whole[some] * times + length[some].astype(np.uint64), 1)
    code = np.zeros(len(clean), dtype=np.uint64)
    for k in range(1, 9):
        some = np.flatnonzero(length >= k)
        code[some] = code[some] * times + letters[start[some] + k - 1]
        if k > 2:
            add(some, code[some], 10 + k)
    for k in range(3, 6):
        some = np.flatnonzero(length >= k)
        code = np.zeros(len(some), dtype=np.uint64)
        for j in range(k):
            code = code * times + letters[end[some] - k + j]
        add(some, code, 20 + k)
    return np.concatenate(buckets), np.concatenate(of)


class WordVectors(dict):
    """Number of a word in ``matrix``, whose rows are the vectors of words: embedding, then languages. Row 0 is zero."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.buckets = model.buckets
        self.source = np.concatenate([model.embedding, model.language_rows], 1)
        self.size = model.embedding.shape[1]
        self.matrix = np.zeros((1, self.source.shape[1]), dtype=np.float32)
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        """A number for a new word, whose vector is made with those of the others that are new."""
        self.new.append(word)
        self[word] = number = len(self.matrix) - 1 + len(self.new)
        return number

    def learn(self) -> None:
        """Make the vectors of the new words; those of words without a known part are zero."""
        new, self.new = self.new, []
        vectors = np.zeros((len(new), self.source.shape[1]), dtype=np.float32)
        if new and len(self.buckets):
            bucket, of = hashes(new)
            row = np.searchsorted(self.buckets, bucket)
            row[row == len(self.buckets)] = 0
            known = self.buckets[row] == bucket
            row, of = row[known], of[known]
            order = np.argsort(of, kind="stable")
            row, of = row[order], of[order]
            own, first, many = np.unique(of, return_index=True, return_counts=True)
            if len(own):
                vectors[own, : self.size] = np.maximum.reduceat(self.source[row, : self.size], first, axis=0)
                vectors[own, self.size :] = np.add.reduceat(self.source[row, self.size :], first, axis=0) / many[:, None]
        self.matrix = np.concatenate([self.matrix, vectors])

    def numbers(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The words of each text as numbers; words of earlier texts are forgotten when there are too many."""
        if len(self) > REMEMBERED:
            self.clear()
            self.matrix = self.matrix[:1]
        words = [t.split() if t else [] for t in texts]
        found = [np.fromiter(map(self.__getitem__, w), dtype=np.int64, count=len(w)) for w in words]
        self.learn()
        return found


def laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows in one array, PAD zeros after each document, with starts and ends; no document is empty."""
    lengths = np.array([max(1, len(d)) for d in docs])
    starts = np.concatenate([[0], np.cumsum(lengths + PAD)[:-1]]).astype(np.int64)
    rows = np.zeros(int(lengths.sum() + PAD * len(docs)), dtype=np.int64)
    for s, d in zip(starts, docs):
        rows[s : s + len(d)] = d
    return rows, starts, starts + lengths


def convolved(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    n = len(x) - len(weights) + 1
    out = x[:n] @ weights[0]
    for j in range(1, len(weights)):
        out += x[j : j + n] @ weights[j]
    return out


def logits(model: ToxicityModel, docs: list[np.ndarray], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classifier's answer and the language of each document, given as numbers of word vectors."""
    rows, starts, ends = laid_out(docs)
    size, cuts = model.embedding.shape[1], np.stack([starts, ends], 1).ravel()
    both = vectors[rows]
    x = np.ascontiguousarray(both[:, :size])
    pooled = [np.maximum.reduceat(convolved(x, w), cuts, axis=0)[::2] + b for w, b in zip(model.filters, model.bias)]
    out = np.maximum(np.concatenate(pooled, 1), 0) @ model.dense + model.offset
    language = np.add.reduceat(both[:, size:], cuts, axis=0)[::2].argmax(1)
    return out, language


class Words:
    """The distinct words of the training texts: documents as word numbers from 1, and the embedding rows of each word.
    Buckets are those in ``known``, or in at least ``least`` texts."""

    def __init__(self, texts: list[str | None], least: int = 3, known: np.ndarray | None = None):
        number: dict[bytes, int] = {}
        self.docs = [np.array([number.setdefault(w, len(number) + 1) for w in (t or "").encode().split()], dtype=np.int64) for t in texts]
        of, word = hashes(list(number)) if number else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.argsort(word, kind="stable")
        of, word = of[order], word[order] + 1
        lengths = np.bincount(word, minlength=len(number) + 1)
        ends = np.cumsum(lengths)
        buckets, row_of = np.unique(of, return_inverse=True)
        keep = np.ones(len(buckets), dtype=bool) if known is None else np.isin(buckets, known)
        if known is None and least > 1:
            seen = np.zeros(len(buckets), dtype=np.int64)  # in how many texts a bucket occurs
            for d in self.docs:
                own = np.unique(d)
                spots = np.repeat(ends[own] - lengths[own] - (np.cumsum(lengths[own]) - lengths[own]), lengths[own]) + np.arange(lengths[own].sum())
                seen[np.unique(row_of[spots])] += 1
            keep = seen >= least
        new = np.cumsum(keep) - 1
        kept = keep[row_of]
        word = word[kept]
        self.buckets = buckets[keep]
        self.rows = new[row_of][kept]
        self.count = np.bincount(word, minlength=len(lengths))
        self.start = np.cumsum(self.count) - self.count

    def rows_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The embedding rows of words, and to which of the words each belongs."""
        n = self.count[words]
        spots = np.repeat(self.start[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.rows[spots], np.repeat(np.arange(len(words)), n)

    def vectors(self, words: np.ndarray, embedding: np.ndarray, reduce=np.maximum) -> np.ndarray:
        """The highest of the words' rows by component, or what else ``reduce`` makes of them."""
        rows, n = self.rows_of(words)[0], self.count[words]
        out = np.zeros((len(words), embedding.shape[1]), dtype=np.float32)
        some = np.flatnonzero(n)
        if len(some):
            out[some] = reduce.reduceat(embedding[rows], (np.cumsum(n) - n)[some], axis=0)
        return out


def _start(toxic, times, base, size, n_filters, seed, prior=10.0):
    """Small random embedding rows, with the log-odds of the toxic class in front: training starts from there. Rows seen in few
    texts stay near the common odds, as if seen in ``prior`` more. And the random filters, and the generator for what follows."""
    rng = np.random.default_rng(seed)
    share = (toxic + prior * base) / (times + prior)
    e = rng.normal(0, 0.02, (len(times), size)).astype(np.float32)
    e[:, 0] = np.clip(np.log(share / (1 - share)) - np.log(base / (1 - base)), -4, 4)
    params = [rng.normal(0, 0.3, (w, size, n_filters)).astype(np.float32) for w in WIDTHS]
    params += [np.zeros(n_filters, dtype=np.float32) for _ in WIDTHS]
    params += [rng.normal(0, 0.3, n_filters * len(WIDTHS)).astype(np.float32), np.zeros(1, dtype=np.float32)]
    for w in params[: len(WIDTHS)]:  # half the filters begin by listening to the log-odds
        w[:, 0, : n_filters // 2] = np.abs(w[:, 0, : n_filters // 2])
    return e, params, rng


def _seen(words: Words, which) -> np.ndarray:
    """In how many of some texts each bucket occurs."""
    out = np.zeros(len(words.buckets), dtype=np.int64)
    for i in which:
        out[np.unique(words.rows_of(np.unique(words.docs[i]))[0])] += 1
    return out


def _texts_at_once(n_fit: int) -> int:
    return max(8, min(64, n_fit // 20))


def _descend(words: Words, target, fit, e, params, share, many, passes, rng):
    """Mini-batch descent from ``e`` and ``params``, which it changes: Adagrad on the rows of the words that won a maximum, Adam
    on the rest. ``share`` is that of the toxic class in all training texts."""
    size, n_filters = e.shape[1], len(params[-2]) // len(WIDTHS)
    balance = np.where(target > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    k, g2 = len(WIDTHS), np.full(e.shape, 1e-2, dtype=np.float32)
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(passes):
        order = rng.permutation(fit)
        for at in range(0, len(order), many):
            batch = order[at : at + many]
            numbers, starts, ends = laid_out([words.docs[i] for i in batch])
            own, back_to = np.unique(numbers, return_inverse=True)
            x, spots, pooled = words.vectors(own, e)[back_to], [], []
            for w, b in zip(params[:k], params[k : 2 * k]):
                out = convolved(x, w)
                spot = np.stack([s + out[s:t].argmax(0) for s, t in zip(starts, ends)])
                spots.append(spot)
                pooled.append(np.take_along_axis(out, spot, 0) + b)
            pooled = np.concatenate(pooled, 1)
            active = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ params[-2] + params[-1][0], -30, 30)))
            g = ((p - target[batch]) * balance[batch] / len(batch)).astype(np.float32)
            grads = [None] * len(params)
            grads[-2], grads[-1] = active.T @ g, np.array([g.sum()], dtype=np.float32)
            back = np.outer(g, params[-2]) * (pooled > 0)
            at_words, at_grads = [], []
            for i, (w, spot) in enumerate(zip(params[:k], spots)):
                gi = back[:, i * n_filters : (i + 1) * n_filters]
                grads[k + i] = gi.sum(0)
                grads[i] = np.stack([np.einsum("bf,bfe->ef", gi, x[spot + j]) for j in range(len(w))])
                for j in range(len(w)):
                    at_words.append(numbers[spot + j].ravel())
                    at_grads.append((gi[:, :, None] * w[j].T[None]).reshape(-1, size))
            won, to = np.unique(np.concatenate(at_words), return_inverse=True)
            gw = np.zeros((len(won), size), dtype=np.float32)
            np.add.at(gw, to, np.concatenate(at_grads))
            rows, of = words.rows_of(won)
            touched, to = np.unique(rows, return_inverse=True)
            ge = np.zeros((len(touched), size), dtype=np.float32)
            highest = e[rows] == words.vectors(won, e)[of]
            np.add.at(ge, to, gw[of] * highest)
            g2[touched] += ge**2
            e[touched] -= RATE * ge / np.sqrt(g2[touched])
            step += 1
            for q, (param, grad) in enumerate(zip(params, grads)):
                m[q] += 0.1 * (grad - m[q])
                v[q] += 0.01 * (grad**2 - v[q])
                param -= 0.01 * (m[q] / (1 - 0.9**step)) / (np.sqrt(v[q] / (1 - 0.99**step)) + 1e-6)
    return e, params


def threshold(scores: np.ndarray, target: np.ndarray, times: np.ndarray | None = None) -> float:
    """The middle of the widest gap among the cuts with the fewest errors; a score may stand for several texts."""
    order = np.argsort(scores, kind="stable")
    s, t = scores[order], target[order]
    n = np.ones(len(s)) if times is None else times[order]
    errors = np.concatenate([[0], np.cumsum(t * n)]) + np.concatenate([np.cumsum(((1 - t) * n)[::-1])[::-1], [0]])
    low, high = np.concatenate([[s[0] - 2], s]), np.concatenate([s, [s[-1] + 2]])
    errors = np.where(high > low, errors, np.inf)
    best = np.flatnonzero(errors == errors.min())
    best = best[np.argmax((high - low)[best])]
    return float((low[best] + high[best]) / 2)


def _thresholds(languages: int, out, y, cal, found, times) -> np.ndarray:
    """Thresholds by language on the rows marked ``calibrate``, a common one where a language has fewer than 20 of each class."""
    both = cal.any() and len(set(y[cal].tolist())) > 1
    common = threshold(out[cal], y[cal], times[cal]) if both else threshold(out, y, times)
    limits = np.full(languages, common)
    for i in range(languages):
        own = (found == i) & cal
        if min((y * times)[own].sum(), ((1 - y) * times)[own].sum()) >= 20:
            limits[i] = threshold(out[own], y[own], times[own])
    return limits


def _language_rows(counts: np.ndarray) -> np.ndarray:
    """Log-odds of each language for each embedding row, from how often its texts hold the row."""
    share = np.log((counts + 0.05) / (counts + 0.05).sum(0))
    return (share - share.mean(1, keepdims=True)).astype(np.float32)


def _model(buckets, e, params, languages, language_rows, thresholds) -> ToxicityModel:
    k = len(WIDTHS)
    return ToxicityModel(buckets, e, params[:k], params[k : 2 * k], params[-2], float(params[-1][0]), languages, language_rows, thresholds)


def train(texts: list[str | None], toxic: list[int], langs: list[str | None], calibrate: list[bool], size=8, n_filters=8, steps=500, seed=7) -> ToxicityModel | None:
    """Fit on a few rows, those not marked ``calibrate``, and set thresholds by language on those marked. None unless both
    classes occur. ``fit`` does the same over a table of any size."""
    y, cal = np.array(toxic, dtype=np.float32), np.array(calibrate, dtype=bool)
    if cal.all() or len(set(y[~cal].tolist())) < 2:
        cal[:] = False
    if len(set(y.tolist())) < 2:
        return None
    words, chosen = Words(texts), np.flatnonzero(~cal)
    base = y[chosen].mean()
    e, params, rng = _start(_seen(words, chosen[y[chosen] > 0]), _seen(words, chosen), base, size, n_filters, seed)
    many = _texts_at_once(len(chosen))
    _descend(words, y, chosen, e, params, base, many, max(4, round(steps * many / len(chosen))), rng)
    languages = sorted({x for x in langs if x is not None}) or ["und"]
    counts = np.stack([_seen(words, [i for i, x in enumerate(langs) if x == lang]) for lang in languages], 1)
    model = _model(words.buckets, e, params, languages, _language_rows(counts), np.zeros(len(languages)))
    out, found = _answers(model, WordVectors(model), [None if t is None else t.encode() for t in texts])
    model.thresholds = _thresholds(len(languages), out, y, cal, found, np.ones(len(y)))
    return model


#: Rows and characters of text that one step of training holds.
CHUNK_ROWS, CHUNK_CHARS = 2500, 24 << 20
#: One in so many training texts must hold a bucket, three texts at least: the embedding does not grow with the table.
RAREST = 1_667
#: Logits are counted in steps of this size to set thresholds.
STEPS = 1000


def _chunks(batches):
    """(texts, toxic, langs, calibrate) of consecutive rows of one shard, of bounded size."""
    rows, chars, last = [], 0, None
    for batch in batches:
        for shard, *row in zip(*[batch.column(name).to_pylist() for name in ("shard", "text", "toxic", "lang", "calibrate")]):
            if rows and (shard != last or len(rows) >= CHUNK_ROWS or chars >= CHUNK_CHARS):
                yield tuple(map(list, zip(*rows)))
                rows, chars = [], 0
            rows.append(row)
            chars += len(row[0] or "")
            last = shard
    if rows:
        yield tuple(map(list, zip(*rows)))


def _over_chunks(rows: DataFrame, work, schema: pa.Schema, ddl: str) -> DataFrame:
    """The rows that ``work`` gives for each chunk, as columns of arrays."""

    def run(batches):
        for chunk in _chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(column, type=f.type) for column, f in zip(work(*chunk), schema)], schema=schema)
            give_back()

    return rows.mapInArrow(run, ddl)


def _counted(rows: DataFrame, languages: list[str], all_fit: bool, least: int) -> pa.Table:
    """Per bucket the texts to fit on, the toxic ones of these, and the texts of each language; buckets in few texts left out."""

    def count(texts, toxic, langs, calibrate):
        words, kinds = Words(texts, 1), {}
        for i, kind in enumerate(zip(toxic, langs, calibrate)):
            kinds.setdefault(kind, []).append(i)
        parts = []
        for (bad, lang, cal), which in kinds.items():
            n = _seen(words, which)
            some = np.flatnonzero(n)
            used = all_fit or not cal
            parts.append((words.buckets[some].view(np.int64), [lang] * len(some), n[some], n[some] * used, n[some] * (used and bad)))
        return [np.concatenate([p[0] for p in parts]), [x for p in parts for x in p[1]], *[np.concatenate([p[k] for p in parts]) for k in (2, 3, 4)]]

    fields = [("bucket", pa.int64()), ("lang", pa.string()), ("texts", pa.int64()), ("used", pa.int64()), ("bad", pa.int64())]
    each = _over_chunks(rows, count, pa.schema(fields), "bucket long, lang string, texts long, used long, bad long")
    sums = [F.sum("used").alias("used"), F.sum("bad").alias("bad")]
    sums += [F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("texts"))), F.lit(0)).alias(f"lang_{i}") for i, lang in enumerate(languages)]
    return each.groupBy("bucket").agg(F.sum("texts").alias("texts"), *sums).filter(F.col("texts") >= least).drop("texts").toArrow()


def _averaged(rows: DataFrame, buckets, e, params, share, many, passes, all_fit, rng):
    """One round: every chunk descends from the same state, then each row of the embedding becomes the mean over the chunks that
    moved it, and each filter that over all chunks, by their texts."""
    size, shapes = e.shape[1], [p.shape for p in params]
    flat = np.concatenate([p.ravel() for p in params])
    cuts = np.cumsum([p.size for p in params])[:-1]

    def descend(texts, toxic, langs, calibrate):
        chosen = np.array([i for i, c in enumerate(calibrate) if all_fit or not c], dtype=np.int64)
        words = Words([texts[i] for i in chosen], known=buckets)
        at = np.searchsorted(buckets, words.buckets)
        own, mine = e[at], [p.reshape(shape).copy() for p, shape in zip(np.split(flat, cuts), shapes)]
        target = np.array([toxic[i] for i in chosen], dtype=np.float32)
        if len(chosen):
            _descend(words, target, np.arange(len(chosen)), own, mine, share, many, passes, deepcopy(rng))
        moved = np.flatnonzero((own != e[at]).any(1))
        rest = np.concatenate([p.ravel() for p in mine])
        rest = np.pad(rest, (0, -len(rest) % size)).reshape(-1, size)
        part = np.concatenate([at[moved], -1 - np.arange(len(rest))]).astype(np.int64)
        return [part, np.full(len(part), float(len(chosen))), *np.concatenate([own[moved], rest]).T]

    names = [f"v{i}" for i in range(size)]
    fields = [("part", pa.int64()), ("weight", pa.float64()), *[(name, pa.float32()) for name in names]]
    each = _over_chunks(rows, descend, pa.schema(fields), "part long, weight double, " + ", ".join(f"{name} float" for name in names))
    means = [(F.sum(F.col(name) * F.col("weight")) / F.sum("weight")).alias(name) for name in names]
    found = each.filter("weight > 0").groupBy("part").agg(*means).toArrow()
    part = found["part"].to_numpy()
    values = np.stack([found[name].to_numpy() for name in names], 1).astype(np.float32)
    e = e.copy()
    e[part[part >= 0]] = values[part >= 0]
    rest = values[part < 0][np.argsort(-part[part < 0])].ravel()[: len(flat)]
    return e, [p.reshape(shape).copy() for p, shape in zip(np.split(rest, cuts), shapes)]


def _outcomes(rows: DataFrame, model: ToxicityModel, all_fit: bool) -> pa.Table:
    """How many rows have each logit, in steps, by class, language found and whether they set thresholds."""

    def answer(texts, toxic, langs, calibrate):
        out, found = _answers(model, numbers, [None if t is None else t.encode() for t in texts])
        return [np.round(np.clip(out, -1e6, 1e6) * STEPS).astype(np.int64), found, toxic, [c and not all_fit for c in calibrate]]

    numbers = WordVectors(model)
    fields = [("step", pa.int64()), ("found", pa.int64()), ("toxic", pa.int64()), ("cal", pa.bool_())]
    each = _over_chunks(rows, answer, pa.schema(fields), "step long, found long, toxic long, cal boolean")
    return each.groupBy("step", "found", "toxic", "cal").agg(F.count(F.lit(1)).alias("times")).toArrow()


def shards_of(n: int) -> int:
    """The shards that so many rows are trained in."""
    return max(1, -(-n // CHUNK_ROWS))


def fit(labelled: DataFrame, size=8, n_filters=8, steps=500, seed=7, dealt: int | None = None) -> ToxicityModel | None:
    """Train on all rows of (id, text, lang, toxic, calibrate) whose label is 0 or 1.

    Rows that a join has ``dealt`` out by their id, in so many parts, stay there: shards then go by the id, and no text moves again.

    The rows are stored in shards of about CHUNK_ROWS. Spark sums the counts that the embedding and the languages start from;
    then each shard descends from the common state in a task of its own, and Spark averages the results, for a few rounds.
    A table of one shard is trained in one round, as ``train`` does. Thresholds come from the counted logits of all
    rows marked ``calibrate``. The driver gets the model and sums only. None unless both classes occur.
    """
    known = labelled.filter(F.col("toxic").isin(0, 1))
    kind = F.col("toxic").cast("int")
    usable = known.select("text", "lang", kind.alias("toxic"), F.coalesce("calibrate", F.lit(False)).alias("calibrate"), F.xxhash64("id").alias("place"), F.hash("id").alias("key"))
    told = usable.groupBy("toxic", "calibrate").agg(F.count(F.lit(1)).alias("n")).collect()
    n, n_fit = [{t: sum(r.n for r in told if r.toxic == t and not (fit_only and r.calibrate)) for t in (0, 1)} for fit_only in (False, True)]
    if not all(n.values()):
        return None
    all_fit = not all(n_fit.values())
    n_fit = n if all_fit else n_fit
    total = sum(n_fit.values())
    if dealt is None:
        shards = shards_of(sum(n.values()))
        sharded = usable.withColumn("shard", F.pmod(F.xxhash64("place", "text"), F.lit(shards)).cast("int")).repartition(shards, "shard")
    else:
        shards = dealt
        sharded = usable.withColumn("shard", F.pmod("key", F.lit(shards)))
    rows = settle(sharded.sortWithinPartitions("shard", "toxic", "place", "text"))
    languages = sorted(r.lang for r in rows.select("lang").filter("lang IS NOT NULL").distinct().collect()) or ["und"]
    counted = _counted(rows, languages, all_fit, max(3, sum(n.values()) // RAREST))
    buckets = counted["bucket"].to_numpy().view(np.uint64)
    order = np.argsort(buckets)
    column = lambda name: counted[name].to_numpy()[order]
    buckets, share = buckets[order], n_fit[1] / total
    e, params, rng = _start(column("bad"), column("used"), share, size, n_filters, seed)
    many = _texts_at_once(total)
    passes = max(4, round(steps * many / min(total, CHUNK_ROWS)))
    rounds = 1 if shards == 1 else 2
    for _ in range(rounds):
        e, params = _averaged(rows, buckets, e, params, share, many, max(1, round(passes / rounds / min(shards, 4))), all_fit, rng)
        rng.random()  # another order of texts in the next round
    counts = np.stack([column(f"lang_{i}") for i in range(len(languages))], 1)
    model = _model(buckets, e, params, languages, _language_rows(counts), np.zeros(len(languages)))
    # Rows that do not set thresholds are asked only where those that do lack a class.
    set_by = {r.toxic for r in told if r.calibrate and not all_fit}
    found = _outcomes(rows.filter("calibrate") if len(set_by) > 1 else rows, model, all_fit)
    out, y, at, times = [found[name].to_numpy() for name in ("step", "toxic", "found", "times")]
    model.thresholds = _thresholds(len(languages), out / STEPS, y.astype(float), found["cal"].to_numpy(), at, times)
    return model


def _answers(model: ToxicityModel, numbers: WordVectors, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Logits and languages of texts, a bounded number of words at a time."""
    docs = numbers.numbers(texts)
    out, found = np.empty(len(docs)), np.empty(len(docs), dtype=np.int64)
    start = 0
    while start < len(docs):
        end, n = start + 1, len(docs[start])
        while end < len(docs) and n + len(docs[end]) < 30_000:
            n += len(docs[end])
            end += 1
        out[start:end], found[start:end] = logits(model, docs[start:end], numbers.matrix)
        start = end
    return out, found


def score(text: Column, model: ToxicityModel | None) -> Column:
    """The toxicity of a text from 0 to 1; 0.5 and more counts as toxic."""
    if model is None:
        return F.lit(0.0)

    def work():
        numbers = WordVectors(model)

        def do(texts: pa.Array) -> pa.Array:
            z, language = _answers(model, numbers, raw(texts))
            return pa.array(1 / (1 + np.exp(-np.clip(z - model.thresholds[language], -30, 30))))

        return do

    return text_column(work, "double", pa.float64())(text)
