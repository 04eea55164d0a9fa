"""BPE encoding and decoding of whole texts through a table of distinct words.

A word is a run without ASCII white space; the tokenizer drops white space and never joins over it, so
the ids of a text are those of its words in order. Spark splits texts into blocks of documents; a block is its
distinct words and, for each document, positions in them. A first pass over the texts sends only the words: by hash
to buckets, where each distinct word is encoded once by the tokenizers library. A second pass sends only the
positions, which meet the ids of the same block and join them to texts. So the documents are shuffled once, at the
cost of a second scan. Decoding joins each id with its piece; the piece table has one row for each id of the
vocabulary, so its size is bounded by the tokenizer's file.

A block is named by a hash of its words and keys, so both passes must see the same rows in the same order, as tables in
files give them; write other tables first. Where they differ, the task raises instead of giving wrong ids.

Edge cases: a null or empty text has no ids and decodes to the empty text. A very long text is a block of
its own. Repeated rows, and rows with equal or null keys, each keep their own result. Only the columns named
in ``keep`` are carried; a clash with ``n_tokens``, ``ids`` or ``decoded`` raises ValueError.
"""

import json
import os
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import give_back

#: Bytes of text in a block, if no single text is longer.
BLOCK_BYTES = 8 << 20
#: Words of documents in one packed row, if no single text has more.
ROW_WORDS = 25_000
#: Words that the tokenizers library encodes in one call.
CALL_WORDS = 4096
_PACKED = "block long, part int, docs binary, positions binary, words binary, slots binary"


def _compress(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _decompress(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte plane, compressed: small numbers leave the high planes empty."""
    return _compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Slots(dict):
    """The number of each distinct word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = len(self)
        return slot


def _split(buckets: int, give_words: bool):
    """Rows of (keep struct, text) to packed blocks: a row for each bucket of words, or rows of documents."""
    import xxhash

    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("docs", pa.binary()), ("positions", pa.binary()), ("words", pa.binary()), ("slots", pa.binary())])

    def rows_of_words(words: list[bytes]) -> Iterator[dict]:
        of = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % buckets
        order = np.argsort(of, kind="stable")
        edges = np.flatnonzero(np.diff(of[order], prepend=-1)) if len(order) else []
        for start, end in zip(edges, [*edges[1:], len(order)]):
            own = order[start:end]
            # words hold no white space, so a space parts them
            yield {"part": int(of[order[start]]), "words": _compress(b" ".join([words[i] for i in own])), "slots": _pack(own)}

    def rows_of_docs(keys: list, positions: list[np.ndarray]) -> Iterator[dict]:
        at = part = 0
        while at < len(positions):
            to, n = at + 1, len(positions[at])
            while to < len(positions) and n + len(positions[to]) <= ROW_WORDS:
                n += len(positions[to])
                to += 1
            table = pa.table({"key": pa.concat_arrays(keys[at:to]), "n": pa.array([len(p) for p in positions[at:to]], pa.int64())})
            yield {"part": buckets + part, "docs": _compress(_ipc(table)), "positions": _pack(np.concatenate(positions[at:to]))}
            at, part = to, part + 1

    def finish(keys: list, positions: list[np.ndarray], slots: _Slots) -> Iterator[pa.RecordBatch]:
        # Words by falling number of uses, so that most positions are small numbers.
        uses = np.bincount(np.concatenate(positions), minlength=len(slots))
        by_use = np.argsort(-uses, kind="stable")
        listed = list(slots)
        words = [listed[i] for i in by_use.tolist()]
        name = xxhash.xxh64(b" ".join(words))
        name.update(_ipc(pa.table({"key": pa.concat_arrays(keys)})))
        block = int.from_bytes(name.digest(), "big", signed=True)
        if give_words:
            rows = rows_of_words(words)
        else:
            rank = np.empty(len(slots), dtype=np.uint32)
            rank[by_use] = np.arange(len(slots), dtype=np.uint32)
            rows = rows_of_docs(keys, [rank[p] for p in positions])
        nothing = dict.fromkeys(schema.names) | {"block": block}
        while some := list(islice(rows, 16)):
            yield pa.RecordBatch.from_pylist([nothing | row for row in some], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, positions, slots, size = [], [], _Slots(), 0
        for batch in batches:
            key, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                text = texts[i].as_py() or b""
                if positions and size + len(text) > BLOCK_BYTES:
                    yield from finish(keys, positions, slots)
                    keys, positions, slots, size = [], [], _Slots(), 0
                words = text.split()
                positions.append(np.fromiter(map(slots.__getitem__, words), dtype=np.uint32, count=len(words)))
                # a copy: a slice would hold the batch
                keys.append(key.take(pa.array([i])))
                size += len(text)
        if positions:
            yield from finish(keys, positions, slots)
        del keys, positions, slots
        give_back()

    return run


def _ipc(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _word_tokenizer(tokenizer_json: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokenizer.from_str(tokenizer_json)


def _encode(tokenizer_json: str):
    """Encode each distinct word of a bucket once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _word_tokenizer(tokenizer_json)
        part = None
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                if row["part"] != part:  # rows come by bucket
                    known: dict[bytes, int] = {}
                    ids, lengths = [], []
                    part = row["part"]
                words = _decompress(row["words"]).split(b" ")
                new = [w for w in words if w not in known]
                if new:
                    calls = [[w.decode() for w in new[i : i + CALL_WORDS]] for i in range(0, len(new), CALL_WORDS)]
                    encoded = [e.ids for call in calls for e in tokenizer.encode_batch(call, add_special_tokens=False)]
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                    lengths.append(np.fromiter(map(len, encoded), dtype=np.int64, count=len(new)))
                    ids.append(np.fromiter(chain.from_iterable(encoded), dtype=np.uint32))
                    lengths, ids = [np.concatenate(lengths)], [np.concatenate(ids)]
                    starts = np.cumsum(lengths[0]) - lengths[0]
                own = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
                parts = _pack(lengths[0][own]), _pack(ids[0][_spread(starts[own], lengths[0][own])])
                row["words"] = b"".join(len(x).to_bytes(4, "little") + x for x in parts)
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)
        del tokenizer
        give_back()

    return run


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[0], starts[0] + 1, ... of all stretches, one after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def _two(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    return _unpack(data[4 : 4 + n]), _unpack(data[8 + n :])


def _assemble(pieces: list[str]):
    """Rows of a block, its words before its documents, to (key, n_tokens, ids, decoded)."""

    class Words:
        """Of each word of a block: where its ids start, how many they are, and its pieces as text."""

        def __init__(self, slots: list[np.ndarray], coded: list[tuple[np.ndarray, np.ndarray]]):
            # blocks with the same name have the same words, and then they come more than once
            where = np.concatenate([*slots, np.zeros(0, np.uint32)]).astype(np.int64)
            lengths = np.concatenate([*(n for n, _ in coded), np.zeros(0, np.uint32)]).astype(np.int64)
            self.ids = np.concatenate([*(x for _, x in coded), np.zeros(0, np.uint32)]).astype("<u4")
            starts = np.cumsum(lengths) - lengths
            self.start, self.length, self.text = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64), [""] * len(where)
            self.start[where], self.length[where] = starts, lengths
            joined = [pieces[i] for i in self.ids.tolist()]  # the id-to-piece join, once for each distinct word
            for slot, s, n in zip(where.tolist(), starts.tolist(), lengths.tolist()):
                self.text[slot] = " ".join(joined[s : s + n])

    def results(row: dict, words: Words) -> pa.RecordBatch:
        table = pa.ipc.open_stream(_decompress(row["docs"])).read_all().combine_chunks()
        positions, counts = _unpack(row["positions"]).astype(np.int64), table.column("n").to_numpy()
        if len(positions) and not len(words.start):
            raise RuntimeError("the documents changed between two reads: write them to a table first")
        ends = np.cumsum(counts)
        n_tokens, id_bytes, decoded = [], [], []
        for a, b in zip((ends - counts).tolist(), ends.tolist()):
            own = positions[a:b]
            n = words.length[own]
            own_ids = words.ids[_spread(words.start[own], n)]
            n_tokens.append(len(own_ids))
            id_bytes.append(own_ids.tobytes())
            # a word without ids leaves no piece, and so no space
            decoded.append(" ".join([words.text[p] for p in own[n > 0].tolist()]))
        keys = pa.concat_arrays(table.column("key").chunks)
        return pa.RecordBatch.from_arrays([keys, pa.array(n_tokens, pa.int64()), pa.array(id_bytes, pa.binary()), pa.array(decoded, pa.string())], ["key", "n_tokens", "ids", "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, slots, coded, words = None, [], [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] != block:
                    block, slots, coded, words = row["block"], [], [], None
                if row["docs"] is None:
                    slots.append(_unpack(row["slots"]))
                    coded.append(_two(row["words"]))
                else:
                    words = words or Words(slots, coded)
                    yield results(row, words)
        del slots, coded, words
        give_back()

    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",), word_buckets: int | None = None) -> DataFrame:
    """The ``keep`` columns with n_tokens, ids (little-endian unsigned 32-bit integers) and the decoded text.

    ``tokenizer_path`` names a tokenizers file that the driver reads; its text goes to the tasks.
    """
    clash = {"n_tokens", "ids", "decoded"} & set(keep)
    if clash:
        raise ValueError(f"columns to keep clash with results: {sorted(clash)}")
    with open(tokenizer_path, encoding="utf-8") as f:
        settings = json.load(f)
    settings["truncation"] = settings["padding"] = None
    tokenizer_json = json.dumps(settings)
    tokenizer = _word_tokenizer(tokenizer_json)
    pieces = [tokenizer.id_to_token(i) or "" for i in range(max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1)]
    spark = docs.sparkSession
    buckets = word_buckets or max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.struct(*[F.col(c) for c in keep]) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    key_type = rows.schema["key"].dataType
    result = T.StructType([T.StructField("key", key_type), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    of_words = rows.mapInArrow(_split(buckets, True), _PACKED)
    # a given number, since these rows are few bytes but much work
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded = of_words.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_encode(tokenizer_json), _PACKED)
    of_docs = rows.mapInArrow(_split(buckets, False), _PACKED)
    whole = of_docs.union(coded).repartition("block").sortWithinPartitions("block", "part").mapInArrow(_assemble(pieces), result)
    return whole.select(*[F.col("key")[c].alias(c) for c in keep], "n_tokens", "ids", "decoded")
