"""SimHash near-duplicates: fingerprints, and the generalised pigeonhole principle to link them.

Bits that go together are grouped into one partition, so that partitions differ as little as they can from
each other. If two fingerprints differ in at most t bits, and partition thresholds sum to t - m + 1 over m
partitions, they differ in at most its threshold in one partition at least (a threshold of -1 never holds).
Number, widths and thresholds are those with the lowest cost: candidate pairs estimated on a bounded
sample, summed by dynamic programming. Each distinct fingerprint goes to the buckets within the threshold of its
own bits, and the whole fingerprints that meet in a bucket are verified.

Buckets of any size are handled whole: a large one is cut into chunks, every pair of chunks is a task's
group, and a group gives a spanning forest of its links instead of all of them. Copies are one fingerprint.

Edge cases: a null, empty or blank text has no words and fingerprint zero, which is linked like any other. A text
of fewer words than a shingle is one shingle. Rows with a null id are linked too; a component's id is its
smallest id that is not null, null if it has none. Repeated rows are kept.
"""

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import raw, text_column
from tidemark.ml.components import components
from tidemark.session import release, settle

BITS = 64
SAMPLE = 4096  # fingerprints that the partitioning is fitted on, at most
CHUNK = 4096  # fingerprints of a bucket that a task compares with as many others
SMALL = 16  # fingerprints in a bucket up to which all pairs are tried at once


def fingerprint_of(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    import xxhash

    words = text.lower().split() if text else []  # of bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(joined, seed)
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        h = xxhash.xxh64_digest
        digests = b"".join([h(joined[a:b], seed) for a, b in zip((ends - lengths).tolist(), ends[shingle - 1 :].tolist())])
    n = len(digests) // 8
    ones = np.zeros(BITS, dtype=np.int64)
    hashes = np.frombuffer(digests, dtype=np.uint8).reshape(n, 8)
    for at in range(0, n, 8192):
        ones += np.unpackbits(hashes[at : at + 8192], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """A bit is 1 if it is set in over half the XXH64 values of the shingles, repeats included; a signed long."""

    def work():
        def do(texts: pa.Array) -> pa.Array:
            return pa.array([fingerprint_of(t, shingle, seed) for t in raw(texts)], type=pa.int64())

        return do

    return text_column(work, "long", pa.int64())(text)


def grouped_bits(bits: np.ndarray, parts: int) -> list[list[int]]:
    """The bit positions in ``parts`` groups of nearly equal size; each group grows by the bit that is
    most correlated with those it has."""
    spread = bits - bits.mean(0)
    scale = np.sqrt((spread**2).sum(0)) + 1e-9
    together = np.abs(spread.T @ spread) / np.outer(scale, scale)
    left, groups = list(range(BITS)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        group = [left.pop(0)]
        while len(group) < size:
            best = max(left, key=lambda b: together[b, group].mean())
            left.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def plan(sample: np.ndarray, total: int, limit: int) -> list[tuple[int, int]]:
    """(mask, threshold) of each partition that is probed, for ``total`` distinct fingerprints of which
    ``sample`` (unsigned) is a part."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    pairs, scale = len(sample) ** 2 / 2, total**2 / 2
    row_cost = 50.0  # of a probe, in verified pairs
    best_cost, best = None, []
    for parts in range(1, limit + 2):
        groups = grouped_bits(bits, parts)
        budget = limit - parts + 1
        costs = []
        for group in groups:
            mask = np.uint64(sum(1 << b for b in group))
            near = np.zeros(limit + 1)
            own = sample & mask
            for at in range(0, len(own), 512):
                d = np.bitwise_count(own[at : at + 512, None] ^ own[None])
                near += np.bincount(d[d <= limit].ravel(), minlength=limit + 1)[: limit + 1]
            near = np.cumsum(near) - len(own)
            cost = [0.0]
            for t in range(limit + 1):
                ball = sum(comb(len(group), k) for k in range(t + 1))
                chance = max(near[t] / 2 / max(1, pairs), ball / 2.0 ** len(group))
                cost.append(chance * scale * (1 if t == 0 else 2) + total * row_cost * ball)
            costs.append(cost)
        # least[s]: the lowest cost of thresholds over the partitions so far that sum to s - parts
        least = {0: (0.0, [])}
        for cost in costs:
            step = {}
            for s, (c, chosen) in least.items():
                for t in range(-1, limit + 1):
                    total_s, new = s + t + 1, c + cost[t + 1]
                    if total_s <= budget + parts and (total_s not in step or new < step[total_s][0]):
                        step[total_s] = (new, [*chosen, t])
            least = step
        cost, thresholds = least[budget + parts]
        if best_cost is None or cost < best_cost:
            best_cost = cost
            best = [(sum(1 << b for b in g), t) for g, t in zip(groups, thresholds) if t >= 0]
    return best


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def probes(partitions: Sequence[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(partition, mask, flip) of every bucket a fingerprint goes to."""
    out = []
    for i, (mask, threshold) in enumerate(partitions):
        own = [1 << b for b in range(BITS) if mask >> b & 1]
        for k in range(threshold + 1):
            out += [(i, _signed(mask), _signed(sum(flips))) for flips in combinations(own, k)]
    return out


def forest(edges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The edges that join two trees, in order."""
    up: dict[int, int] = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for u, v in edges:
        a, b = root(u), root(v)
        if a != b:
            up[a] = b
            out.append((u, v))
    return out


def links(prints: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one bucket, by breadth first search."""
    x = np.unique(prints).astype(np.int64)
    left, out = x.view(np.uint64), []
    while len(left):
        front, left = [left[-1]], left[:-1]
        while front and len(left):
            u = front.pop()
            near = np.bitwise_count(left ^ u) <= limit
            if near.any():
                found = left[near]
                out += [(int(np.int64(np.uint64(u).view(np.int64))), int(v)) for v in found.view(np.int64)]
                front.extend(found)
                left = left[~near]
    return out


def _linked(limit: int):
    """Rows sorted by bucket to links."""

    def small(keys: np.ndarray, prints: np.ndarray) -> list[tuple[int, int]]:
        out = []
        for shift in range(1, SMALL):
            same = keys[shift:] == keys[:-shift]
            if not same.any():
                break
            a, b = prints[:-shift][same], prints[shift:][same]
            near = (np.bitwise_count((a ^ b).view(np.uint64)) <= limit) & (a != b)
            out += zip(a[near].tolist(), b[near].tolist())
        return forest(out)

    def of_runs(keys: np.ndarray, prints: np.ndarray) -> list[tuple[int, int]]:
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        few = np.repeat(sizes <= SMALL, sizes)
        out = small(keys[few], prints[few])
        for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
            out += links(prints[s : s + n], limit)
        return out

    def table(edges) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            # a bucket's name is not needed: equal neighbours in (part, bucket, pair) make a run
            name = np.rec.fromarrays([batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "bucket", "pair")])
            prints = batch.column("fp").to_numpy()
            if held is not None:
                name, prints = np.concatenate([held[0], name]), np.concatenate([held[1], prints])
            if not len(name):
                continue
            change = np.flatnonzero(name[1:] != name[:-1])
            whole = int(change[-1]) + 1 if len(change) else 0
            held = (name[whole:], prints[whole:])
            if whole:
                number = np.cumsum(np.concatenate([[0], (name[1:whole] != name[: whole - 1]).astype(np.int64)]))
                yield table(of_runs(number, prints[:whole]))
        if held is not None and len(held[0]):
            yield table(of_runs(np.zeros(len(held[0]), dtype=np.int64), held[1]))

    return run


def linked_prints(prints: DataFrame, limit: int = 4) -> DataFrame:
    """(u, v): a spanning forest, or a little more, of the links among distinct fingerprints (column fp)."""
    spark = prints.sparkSession
    total = prints.count()
    sample = prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    if total < 2:
        return spark.createDataFrame([], "u long, v long")
    partitions = plan(np.array([r.fp for r in sample], dtype=np.int64).view(np.uint64), total, limit)
    goes = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(m).cast("long").alias("mask"), F.lit(f).cast("long").alias("flip")) for i, m, f in probes(partitions)])
    keyed = prints.select("fp", F.explode(goes).alias("to")).select(
        F.col("to.part").alias("part"), F.col("fp").bitwiseAND(F.col("to.mask")).bitwiseXOR(F.col("to.flip")).alias("bucket"), "fp"
    )
    sizes = keyed.groupBy("part", "bucket").count().filter(F.col("count") > CHUNK)
    sizes = sizes.select("part", "bucket", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    cut = keyed.join(sizes, ["part", "bucket"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.least(c, own).cast("long") * (1 << 31) + F.greatest(c, own))
    cut = cut.select("part", "bucket", "fp", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(pairs)).alias("pair"))
    return cut.repartition("part", "bucket", "pair").sortWithinPartitions("part", "bucket", "pair").mapInArrow(_linked(limit), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 4, shingle: int = 4) -> DataFrame:
    """(id, fp, component_id): one row for each document."""
    printed = settle(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")))
    prints = settle(printed.groupBy("fp").agg(F.min("id").alias("first_id")))
    edges = settle(linked_prints(prints, limit).distinct())
    release(docs.sparkSession)
    nodes = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    labels = components(nodes, edges).select(F.col("node").alias("fp"), "label")
    ids = labels.join(prints, "fp").groupBy("label").agg(F.min("first_id").alias("least"))
    linked = labels.join(ids, "label").select("fp", "least")
    component = prints.join(linked, "fp", "left").select("fp", F.coalesce("least", "first_id").alias("component_id"))
    return printed.join(settle(component), "fp").select("id", "fp", "component_id")
