"""Token counts of whole texts under a sentencepiece BPE model, by merging in numpy.

The model's own normaliser prepares a text. It is then parted into pre-tokens at every place that no piece of the
vocabulary spans, so their merges do not touch each other. Pre-tokens that a task has not met yet are one ragged array of
symbols. In a round each of them applies its lowest-rank pair, all of them at once; when no pair is left, the
surviving symbols are its tokens, and a character outside the vocabulary is as many tokens as it has bytes.

A sequence applies all places of its lowest rank in one round, from left to right without overlap, where no merge of
that piece can bring a pair of the same or a lower rank. The few other pieces (of equal scores, such as runs of spaces)
merge at their first place only; once they alone are left, one pass from left to right finishes the sequence.

Nothing is shuffled: each task reads its own texts, and keeps counts of known pre-tokens in a table of bounded size.
Supported are BPE models with byte fallback and without user-defined pieces, as the given one is.

Edge cases: a null or empty text has no tokens. A very long text is worked on in parts that end where a pre-token
ends. One pre-token of m symbols costs up to m times its number of different merges. Strings of special tokens in a
text are ordinary text. Rows and other columns are left as they are, so repeated rows and clashing names are safe.
"""

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column

from tidemark.llm.common import text_column

#: Characters of a text that are parted at a time.
PART_CHARS = 1 << 20
#: Known pre-tokens of a task, and the length up to which one is kept.
KNOWN, KEPT_CHARS = 400_000, 64
#: The sign that sentencepiece writes for a space.
SPACE = "▁"
NEVER = np.iinfo(np.int32).max


class Vocabulary:
    """Arrays of one model: symbols, their ranks, the pairs that merge, and the character pairs inside pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
        if any(model.is_unused(i) for i in own):
            raise ValueError("models with unused pieces are not supported")
        scores = {model.id_to_piece(i): model.get_score(i) for i in own}
        ranks = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        letters = sorted(set("".join(scores)))
        symbols = list(dict.fromkeys([*letters, *scores]))  # a character may be part of pieces and none itself
        number = {symbol: i for i, symbol in enumerate(symbols)}
        self.letters = np.array([ord(c) for c in letters], dtype=np.int64)
        self.size = len(symbols)
        self.rank = np.array([ranks[scores[s]] if s in scores else NEVER for s in symbols], dtype=np.int32)
        self.tokens = np.array([1 if s in scores else len(s.encode()) for s in symbols], dtype=np.int32)

        pairs = {}
        for piece in scores:
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = number[piece]
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[key] for key in sorted(pairs)], dtype=np.int32)
        #: Symbols that can meet a neighbour in a pair of no higher rank than their own.
        self.alone = np.zeros(self.size, dtype=bool)
        for side in np.divmod(self.pairs, self.size):
            self.alone[side[self.rank[self.merged] <= self.rank[side]]] = True
        self.alone[: len(letters)] = False  # no merge makes a single character
        self.last = self.rank[self.rank < NEVER].max(initial=-1)
        left, right = np.divmod(self.pairs, self.size)
        of_last = self.rank[self.merged] == self.last
        self.last_pairs = dict(zip(zip(left[of_last].tolist(), right[of_last].tolist()), self.merged[of_last].tolist()))
        #: Whether what merges to a piece of the last rank meets its neighbours in pairs of that rank only.
        made = (self.rank == self.last) & (np.arange(self.size) >= len(letters))
        self.closed = not np.any((made[left] | made[right]) & ~of_last)

        inside = {(a, b) for piece in scores for a, b in zip(piece, piece[1:])}
        self.inside = np.array(sorted((ord(a) << 21) + ord(b) for a, b in inside), dtype=np.int64)
        # Nothing is joined over the start of a run of spaces, unless a piece has one.
        self.parts = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+") if not any(b == SPACE != a for a, b in inside) else re.compile(".+", re.S)
        self.start = re.compile(f"(?<=[^{SPACE}]){SPACE}")

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol each pair merges to and its rank; NEVER where it does not merge."""
        keys = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.pairs, keys), max(0, len(self.pairs) - 1))
        if not len(self.pairs):
            return np.full(len(keys), -1, dtype=np.int32), np.full(len(keys), NEVER, dtype=np.int32)
        found = self.pairs[at] == keys
        merged = np.where(found, self.merged[at], -1)
        return merged, np.where(found, self.rank[merged], NEVER).astype(np.int32)

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The words of a normalised text, some at a time."""
        at = 0
        while at < len(text):
            cut = self.start.search(text, at + PART_CHARS) if self.parts.pattern != ".+" else None
            end = cut.start() if cut else len(text)
            yield self.parts.findall(text if end - at == len(text) else text[at:end])
            at = end


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _left_to_right(voc: Vocabulary, symbols: list[int]) -> list[int]:
    """A sequence with only pairs of the last rank left: the leftmost pair merges first, again and again."""
    known = voc.last_pairs
    done: list[int] = []
    for symbol in symbols:
        done.append(symbol)
        while len(done) > 1 and (merged := known.get((done[-2], done[-1]))) is not None:
            done[-2:] = [merged]
    return done


def count_tokens(voc: Vocabulary, words: list[str]) -> np.ndarray:
    """The number of tokens of each normalised word."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    counts = np.zeros(len(words), dtype=np.int64)
    if not len(codes):
        return counts
    at = np.minimum(np.searchsorted(voc.letters, codes), len(voc.letters) - 1)
    symbol = np.where(voc.letters[at] == codes, at, -1).astype(np.int32)
    owner = np.repeat(np.arange(len(words)), lengths)
    # Characters of no piece stand alone: as many tokens as bytes.
    strange = symbol < 0
    np.add.at(counts, owner[strange], 1 + (codes[strange] >= 0x80) + (codes[strange] >= 0x800) + (codes[strange] >= 0x10000))
    bigrams = (codes[:-1] << 21) + codes[1:]
    close = np.minimum(np.searchsorted(voc.inside, bigrams), max(0, len(voc.inside) - 1))
    first = np.ones(len(codes), dtype=bool)
    if len(voc.inside):
        first[1:] = (owner[1:] != owner[:-1]) | (voc.inside[close] != bigrams)
    symbol, owner, first = symbol[~strange], owner[~strange], first[~strange]  # what follows such a character is a first one

    rank = np.full(len(symbol), NEVER, dtype=np.int32)  # of each symbol and the next one
    merged = np.full(len(symbol), -1, dtype=np.int32)
    stale = np.arange(len(symbol))
    while len(symbol):
        stale = stale[stale < len(symbol) - 1]
        stale = stale[~first[stale + 1]]
        merged[stale], rank[stale] = voc.looked_up(symbol[stale], symbol[stale + 1])
        starts = np.flatnonzero(first)
        low = np.minimum.reduceat(rank, starts)
        sizes = np.diff(starts, append=len(symbol))
        over = low == NEVER
        tied = (low == voc.last) & (sizes > 2) & voc.closed
        for k in np.flatnonzero(tied):
            part = slice(starts[k], starts[k] + sizes[k])
            counts[owner[part][0]] += voc.tokens[_left_to_right(voc, symbol[part].tolist())].sum()
        done = over | tied
        ended = np.repeat(over, sizes)
        counts += np.bincount(owner[ended], voc.tokens[symbol[ended]], len(words)).astype(np.int64)
        hit = rank == np.repeat(np.where(done, -1, low), sizes)
        places = np.flatnonzero(hit)
        # Places next to each other overlap: every second one merges. Single pieces merge at a sequence's first place.
        run = np.maximum.accumulate(np.where(np.diff(places, prepend=-2) > 1, np.arange(len(places)), 0))
        chosen = (np.arange(len(places)) - run) % 2 == 0
        sequence = np.searchsorted(starts, places, side="right")
        chosen &= ~voc.alone[merged[places]] | (np.diff(sequence, prepend=-1) > 0)
        places = places[chosen]
        symbol[places] = merged[places]
        keep = ~np.repeat(done, sizes)
        keep[places + 1] = False
        rank[places], merged[places] = NEVER, -1
        position = np.cumsum(keep) - 1
        place = position[places]
        before = place[~first[places]] - 1
        symbol, owner, first, rank, merged = symbol[keep], owner[keep], first[keep], rank[keep], merged[keep]
        # The last symbol of a sequence has no pair; a merge may have made it the last.
        stale = np.unique(np.concatenate([before, place]))
        rank[stale], merged[stale] = NEVER, -1
    return counts


def n_tokens(text: Column, path: str) -> Column:
    """The number of tokens of a text (long): as the model at ``path`` encodes it, without begin and end."""

    def work():
        voc = vocabulary(path)
        known: dict[str, int] = {}

        def counted(words: list[str]) -> int:
            others = [w for w in words if w not in known]
            return sum(known.get(w, 0) for w in words) + int(count_tokens(voc, others).sum())

        def do(texts: pa.Array) -> pa.Array:
            prepared = [voc.model.normalize(t) if t else "" for t in texts.to_pylist()]
            # New words of all the texts are merged together; then each text is counted.
            new = {w for t in prepared for words in voc.pre_tokens(t) for w in words if w not in known and len(w) <= KEPT_CHARS}
            if len(known) + len(new) > KNOWN:
                known.clear()
            known.update(zip(new, count_tokens(voc, list(new)).tolist()))
            return pa.array([sum(map(counted, voc.pre_tokens(t))) for t in prepared], type=pa.int64())

        return do

    return text_column(work, "long", pa.int64())(text)
