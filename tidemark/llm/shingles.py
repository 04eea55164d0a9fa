"""Near copies by what they share: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

MinHash bands propose pairs and the real similarity of the texts decides. With ``BANDS`` bands of ``ROWS`` minima a pair at
0.8 shares a band but for a chance of (1 - 0.8 ** ROWS) ** BANDS, about 7 in a million, and more alike pairs with less.
Two sketches keep texts of other pairs from travelling. Four bits of each minimum are its marks; a pair whose marks differ in more
than ``MOST_UNLIKE`` places is not looked at (at 0.8 a chance of about one in a million, at 0.5 all but one in a thousand). And each bit of
the parity sketch is the parity of the shingles that fall on it, so two sketches never differ in more bits than the sets have
shingles of their own: a pair that differs in more bits than 0.8 allows is surely less alike, and of sets of some hundred shingles hardly another pair passes.

Texts with equal sets are one node. In each band's bucket all nodes are first compared with its hub, the node whose buckets are the
fullest: of copies of one text that is the text itself, or what is nearest to it. Then only those that are still in different groups are
compared with each other, in buckets of up to ``BUCKET`` nodes; what another method has linked counts as one group from the start. Larger rests are mostly
texts that share a passage and nothing else. They all go to an exact prefix join: a text's rarest shingles among
them, one more than a fifth, hold one in common with any text that is 0.8 alike, and a shared passage is not rare there.

Edge cases: a null, empty or blank text has no words and all of them are one node. A text of fewer words than a
shingle is one shingle. Words are parted at ASCII white space, A-Z count as a-z. Repeated rows are one node. Only the
key and the text are read, so other columns cannot clash.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import raw, text_column
from tidemark.ml.components import components
from tidemark.session import release, settle

SHINGLE = 5
BANDS, ROWS = 30, 5
BLOCK = 1024  # shingles that are hashed at a time
MARKS = BANDS * ROWS // 15  # longs of fifteen marks
MOST_UNLIKE = 52
PARITIES = 1024  # bits of the parity sketch
SLOTS = 1 << 18  # of the counts that order shingles by rarity
BUCKET = 64  # nodes of a bucket up to which all pairs of groups are tried


def shingle_set(text: bytes | None) -> np.ndarray:
    """The distinct XXH64 values of a text's shingles, in order."""
    import xxhash

    words = text.lower().split() if text else []  # of bytes: only A-Z, only ASCII white space
    h = xxhash.xxh64_intdigest
    shingles = (b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))) if words else ()
    return np.unique(np.fromiter(map(h, shingles), dtype=np.uint64))


def _salts() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(8)
    draw = lambda: rng.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)[:, None]
    return draw(), draw() | np.uint64(1)


def sketch(text: Column) -> Column:
    """struct(node, bands, marks, parities, size): a digest of the set of shingles (0 without words), a key for each band, four
    bits of each minimum, the parity sketch and the number of shingles."""
    kinds = {"node": pa.int64(), "bands": pa.list_(pa.int64()), "marks": pa.list_(pa.int64()), "parities": pa.list_(pa.int64()), "size": pa.int64()}
    places = (np.arange(15, dtype=np.uint64) * np.uint64(4))[None]

    def work():
        import xxhash

        flips, factors = _salts()

        def one(text: bytes | None) -> tuple:
            own = shingle_set(text)
            if not len(own):
                return 0, [], [0] * MARKS, [0] * (PARITIES // 64), 0
            least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
            for at in range(0, len(own), BLOCK):
                np.minimum(least, ((own[at : at + BLOCK] ^ flips) * factors).min(1), out=least)
            row = least.tobytes()
            digests = b"".join(xxhash.xxh64_digest(row[8 * ROWS * i : 8 * ROWS * (i + 1)], i) for i in range(BANDS))
            node = np.frombuffer(xxhash.xxh64_digest(own.tobytes()), dtype=np.int64)
            # A minimum is small in its high bits and its last bits hang on the shingle's; the middle ones differ freely.
            bits = (least >> np.uint64(16)) & np.uint64(15)
            marks = np.bitwise_or.reduce(bits.reshape(MARKS, 15) << places, axis=1).view(np.int64)
            odd = np.bincount((own >> np.uint64(40)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1
            parities = np.packbits(odd.astype(np.uint8)).view(np.int64)
            return int(node[0]), np.frombuffer(digests, dtype=np.int64).tolist(), marks.tolist(), parities.tolist(), len(own)

        def do(texts: pa.Array) -> pa.Array:
            found = [one(t) for t in raw(texts)]
            return pa.StructArray.from_arrays([pa.array([f[i] for f in found], type=t) for i, t in enumerate(kinds.values())], names=list(kinds))

        return do

    schema = "node long, bands array<bigint>, marks array<bigint>, parities array<bigint>, size long"
    return text_column(work, schema, pa.struct(list(kinds.items())))(text)


def shingles_of(text: Column) -> Column:
    """The distinct hashes of a text's shingles."""

    def work():
        return lambda texts: pa.array([shingle_set(t).view(np.int64) for t in raw(texts)], pa.list_(pa.int64()))

    return text_column(work, "array<bigint>", pa.list_(pa.int64()))(text)


def _differing(a: str, b: str, of_word) -> Column:
    """The sum of a count over the words of two sketches, of the bits in which they differ."""
    counts = F.zip_with(a, b, lambda x, y: of_word(x.bitwiseXOR(y)))
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def may_be_alike(a: str = "", b: str = "_v") -> Column:
    """Whether the marks of two nodes, whose columns have these suffixes, differ in few enough places and their sizes allow it."""
    ones = F.lit(sum(1 << 4 * i for i in range(15)))

    def unlike(x: Column) -> Column:
        pairs = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(pairs.bitwiseOR(F.shiftrightunsigned(pairs, 2)).bitwiseAND(ones))

    sizes = F.col(f"size{a}"), F.col(f"size{b}")
    return (5 * F.least(*sizes) >= 4 * F.greatest(*sizes)) & (_differing(f"marks{a}", f"marks{b}", unlike) <= MOST_UNLIKE)


def may_be_equal_enough(a: str = "", b: str = "_v") -> Column:
    """Whether the parity sketches of two nodes leave room for a similarity of 0.8: shingles of one set only are at most a
    ninth of both sizes."""
    return 9 * _differing(f"parities{a}", f"parities{b}", F.bit_count) <= F.col(f"size{a}") + F.col(f"size{b}")


def alike(a: Column, b: Column) -> Column:
    """Whether two texts share at least 0.8 of their shingles."""

    def work(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(raw(left), raw(right)):
            x, y = shingle_set(x), shingle_set(y)
            common = len(np.intersect1d(x, y, assume_unique=True))
            out.append(5 * common >= 4 * (len(x) + len(y) - common))
        return pa.array(out, type=pa.bool_())

    work.__annotations__ = {"left": pa.Array, "right": pa.Array, "return": pa.Array}
    return F.arrow_udf(work, "boolean")(a, b)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) whose texts are alike; ``texts`` has (node, text, marks, size)."""
    of = lambda x, *columns: texts.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns])
    near = pairs.select("u", "v").distinct().join(of("u", "marks", "size"), "u").join(of("v", "marks", "size"), "v")
    near = settle(near.filter(may_be_alike("_u", "_v")).select("u", "v"))
    both = near.join(of("u", "text"), "u").join(of("v", "text"), "v")
    return settle(both.filter(alike(F.col("text_u"), F.col("text_v"))).select("u", "v"))


def _labels(edges: DataFrame) -> DataFrame:
    nodes = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    return components(nodes, edges)


def _pairs(listed: DataFrame, by: str) -> DataFrame:
    """(u, v) of different groups that meet in ``by`` and whose sketches allow it, from rows of (by, node, label, sketches)."""
    columns = ["node", "label", "marks", "parities", "size"]
    other = listed.select(by, *[F.col(c).alias(f"{c}_v") for c in columns])
    own = listed.withColumnRenamed(by, "own")
    met = (F.col("own") == F.col(by)) & (F.col("node") < F.col("node_v")) & (F.col("label") != F.col("label_v"))
    return own.join(other, met & may_be_equal_enough() & may_be_alike()).select(F.col("node").alias("u"), F.col("node_v").alias("v"))


def _prefixes(pool: DataFrame, texts: DataFrame) -> DataFrame:
    """(shingle, node): each node's prefix, its rarest shingles among the nodes of ``pool``. Any order that holds for all nodes is
    right; this one goes by how many shingles of the pool share a slot of SLOTS, so the driver holds one number a slot."""
    listed = settle(pool.select("node").join(texts, "node").select("node", shingles_of(F.col("text")).alias("all")))
    slots = listed.select(F.explode("all").alias("shingle")).groupBy(F.pmod("shingle", F.lit(SLOTS)).alias("slot")).agg(F.count("*").alias("uses"))
    counted = slots.toArrow()  # at most SLOTS rows
    uses = np.zeros(SLOTS, dtype=np.int32)
    uses[counted["slot"].to_numpy()] = np.minimum(counted["uses"].to_numpy(), np.iinfo(np.int32).max)

    def rarest(lists: pa.Array) -> pa.Array:
        out = []
        for one in lists:
            own = one.values.to_numpy()
            order = np.lexsort((own, uses[own % SLOTS]))
            out.append(own[order[: len(own) - (4 * len(own) + 4) // 5 + 1]])
        return pa.array(out, pa.list_(pa.int64()))

    rarest.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    prefix = F.arrow_udf(rarest, "array<bigint>")(F.col("all"))
    return settle(listed.select("node", prefix.alias("prefix"))).select("node", F.explode("prefix").alias("shingle"))


def _of_components(sketched: DataFrame, linked: DataFrame, key: list[str]) -> DataFrame:
    """(u, v): from the smallest node of each component to its others."""
    placed = settle(sketched.select(*key, "node").join(linked, key).select("component", "node").distinct())
    least = placed.groupBy("component").agg(F.min("node").alias("u"))
    return placed.join(least, "component").filter("u <> node").select("u", F.col("node").alias("v"))


def first_of_groups(rows: DataFrame, key: list[str], text_col: str = "text", linked: DataFrame | None = None) -> DataFrame:
    """The columns ``key`` of one row of each group of near copies: that where they are smallest. Rows with equal
    ``key`` have equal texts. ``linked`` (key, component) names rows that are one group by another method, too."""
    sketches = ["bands", "marks", "parities", "size"]
    texts = rows.select(*key, F.col(text_col).alias("text"))
    sketched = settle(texts.select(*key, sketch(F.col("text")).alias("s")).select(*key, "s.*"))
    nodes = settle(sketched.groupBy("node").agg(F.min(F.struct(*key)).alias("first"), *[F.any_value(c).alias(c) for c in sketches]))
    bands = settle(nodes.select("node", F.explode("bands").alias("band")))
    buckets = bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    met = settle(bands.join(buckets, "band"))
    release(rows.sparkSession)
    fullness = met.groupBy("node").agg(F.sum("n").alias("fullness"))
    hubs = met.join(fullness, "node").groupBy("band").agg(F.max_by("node", F.struct("fullness", "node")).alias("hub"))
    met = settle(met.join(hubs, "band"))
    chosen = nodes.join(met.select("node").distinct(), "node").select("node", *sketches[1:], *[F.col("first")[k].alias(k) for k in key])
    whole = texts.join(chosen, key).groupBy("node").agg(*[F.any_value(c).alias(c) for c in ("text", *sketches[1:])])
    texts = settle(whole)
    release(rows.sparkSession)

    edges = _verified(met.filter("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v")), texts)
    if linked is not None:
        edges = edges.union(_of_components(sketched, linked, key))
    release(rows.sparkSession)
    labels = _labels(edges)
    release(rows.sparkSession)
    grouped = met.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = grouped.groupBy("band").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b").select("band")
    left = settle(grouped.join(mixed, "band").filter("node <> hub"))  # those with the hub were tried
    with_sketches = texts.drop("text")
    found = _pairs(left.filter(F.col("n") <= BUCKET).select("band", "node", "label").join(with_sketches, "node"), "band")
    pool = settle(left.filter(F.col("n") > BUCKET).select("node", "label").distinct())
    release(rows.sparkSession)
    if pool.take(1):
        listed = _prefixes(pool, texts).join(pool, "node").join(with_sketches, "node")
        found = found.unionByName(_pairs(settle(listed), "shingle"))
    found = _verified(found, texts)
    release(rows.sparkSession)

    # The groups so far are the nodes of what is left to link.
    of = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"group_{x}"))
    between = found.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("group_u", "u").alias("u"), F.coalesce("group_v", "v").alias("v"))
    wider = _labels(settle(between.distinct())).select(F.col("node").alias("group"), F.col("label").alias("wider"))
    named = nodes.join(labels, "node", "left").select("first", F.coalesce("label", "node").alias("group")).join(wider, "group", "left")
    return named.groupBy(F.coalesce("wider", "group").alias("group")).agg(F.min("first").alias("first")).select("first.*")
