"""Periodic runs, Merkle manifests and token counts against brute force, with their edge cases."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm import merkle, runs, tokencount
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
EDGES = "doc_id long, text string, kept string, runs string, row string, path string, leaf string, lang string, n_tokens string"


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def edge_rows(spark, texts):
    return spark.createDataFrame([(i, t, "k", "r", "w", "p", "l", "en", "n") for i, t in texts], EDGES)


def brute_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(6, 4 * q):
                part = words[start : start + length]
                if not any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                    found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


def test_runs_of_random_words():
    rng = random.Random(7)
    total = 0
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(0, 4)):
            letters, words = "abcd"[: rng.randint(1, 4)], []
            for _ in range(rng.randint(0, 6)):
                unit = [rng.choice(letters).encode() for _ in range(rng.randint(1, 12))]
                words += (unit * rng.randint(1, 9))[: rng.randint(1, 40)]
            texts.append(words)
        expected = [brute_runs(t) for t in texts]
        total += sum(map(len, expected))
        found = runs.find_runs(texts)
        assert found == expected
        assert [runs.collapsed(t, r) for t, r in zip(texts, found)] == [b" ".join(brute_collapsed(t, r)) for t, r in zip(texts, expected)]
    assert total > 500


def test_runs_query(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op11_runs"](spark, SF).collect()}
    assert set(rows) == set(docs)
    some = 0
    for i, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        found = brute_runs(words)
        r = rows[i]
        some += len(found)
        assert r.n_runs == len(found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(brute_collapsed(words, found)).encode()).hexdigest()
    assert some > 50


def test_runs_edges(spark):
    long = " ".join(str(i % 7) for i in range(60_000))
    texts = [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a"), (4, "x a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb y"), (5, long), (5, long), (6, "a a a a a")]
    df = edge_rows(spark, texts)
    rows = df.withColumn("out", runs.runs(F.col("text"))).withColumn("best", runs.longest(F.col("out.runs"))).collect()
    got = collections.Counter((r.doc_id, r.out.n_words, tuple(map(tuple, r.out.runs)), r.out.collapsed, r.runs, r.best and tuple(r.best)) for r in rows)
    seven = (0, 60_000, 7)
    expected = [(1, 0, (), "", "r", None), (2, 0, (), "", "r", None), (3, 0, (), "", "r", None), (None, 6, ((0, 6, 1),), "a", "r", (0, 6, 1))]
    expected += [(4, 8, ((1, 6, 1),), "x a\x1cb y", "r", (1, 6, 1)), (6, 5, (), "a a a a a", "r", None)] + 2 * [(5, 60_000, (seven,), "0 1 2 3 4 5 6", "r", seven)]
    assert got == collections.Counter(expected)
    assert df.limit(0).select(runs.runs(F.col("text"))).count() == 0


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves, arity):
    """The root, and the (before, after) steps of each leaf."""
    steps, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for steps_of, i in zip(steps, at):
            first = i - i % arity
            steps_of.append(("".join(level[first:i]), "".join(level[i + 1 : first + arity])))
        level = [sha(*level[i : i + arity]) for i in range(0, len(level), arity)]
        at = [i // arity for i in at]
    return level[0], steps


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest(spark, arity):
    rng = random.Random(arity)
    rows = [(rng.choice([None, "a", "b", "Ä", "z"]), rng.choice([None, *range(40)]), f"x{rng.randint(0, 30)}") for _ in range(97)]
    rows += [("one", 1, "x")] + [("same", 5, "y")] * 11
    df = spark.createDataFrame(rows, "root string, key long, path string").withColumn("own", merkle.leaf("root", "key", "path"))
    got = merkle.manifest(df, "root", "key", "own", ["root", "key", "path"], arity).collect()

    def leaf(row):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[0]].append((row[1] is not None, row[1] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([x[2] for x in sorted(groups[g])], arity) for g in order}
    root, above = brute_tree([trees[g][0] for g in order], arity)
    expected = collections.Counter()
    for g, top in zip(order, above):
        for x, steps in zip(sorted(groups[g]), trees[g][1]):
            expected[(x[3], x[2], trees[g][0], root, tuple(steps + top))] += 1
    assert collections.Counter((tuple(r.row), r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in got) == expected


def test_manifest_of_little(spark):
    df = spark.createDataFrame([(None, None, None)], "lang string, doc_id long, text string").withColumn("own", merkle.leaf("lang", "doc_id", "text"))
    [row] = merkle.manifest(df, "lang", "doc_id", "own", ["doc_id"]).collect()
    assert row.leaf == row.subroot == row.root == sha("---") and row.path == []
    none = merkle.manifest(df.limit(0), "lang", "doc_id", "own", ["doc_id"])
    assert none.count() == 0 and none.columns == ["row", "leaf", "subroot", "root", "path"]


def test_proofs_find_changes(spark):
    docs = spark.range(30).select("id", F.lit("t").alias("g"), merkle.leaf("id").alias("own"), merkle.leaf(F.col("id") + 1).alias("wrong"))
    proved = merkle.manifest(docs, "g", "id", "own", ["id", "wrong"])
    rows = proved.select("root", merkle.folded(F.col("leaf"), F.col("path")).alias("right"), merkle.folded(F.col("row.wrong"), F.col("path")).alias("wrong")).collect()
    assert len(rows) == 30 and all(r.right == r.root != r.wrong for r in rows)


def test_manifest_query_verifies(spark):
    rows = QUERIES["op12_manifest"](spark, SF).collect()
    assert len({r.root for r in rows}) == 1
    assert all(r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0) for r in rows)


def test_token_count_query(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = QUERIES["op13_token_count"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id] or ""
        n = len(model.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)


def test_token_counts_of_odd_texts(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    signs = ["a", "b", "e", "t", "h", " ", "  ", "\n", "▁", "é", "ﬁ", "２", "日", "本", "😀", "\x00", "<s>", "</s>", "<0x41>", "<unk>", "the", "ing", "0", "1", "=", "\t", " " * 17, "//", "**"]
    rng = random.Random(3)
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [" " * 20_001, "a" * 30_000, "ab " * 400_000, "日本語" * 9_000, "".join(rng.choice("abcdefghijklmnop") for _ in range(20_000)), "x" * 100 + " x" * 5]
    df = edge_rows(spark, [(None, None), (7, ""), *enumerate(texts), (0, texts[0])])
    rows = df.select("doc_id", "text", tokencount.n_tokens(F.col("text"), MODEL).alias("n")).collect()
    assert len(rows) == len(texts) + 3
    assert all(r.n == len(model.encode(r.text or "")) for r in rows)
    assert df.limit(0).select(tokencount.n_tokens(F.col("text"), MODEL)).count() == 0


def test_known_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokencount, "PART_CHARS", 50)
    voc, model = tokencount.vocabulary(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "  the quick   brown fox " * 30 + "end"
    parts = list(voc.pre_tokens(model.normalize(text)))
    assert len(parts) > 5 and sum(int(tokencount.count_tokens(voc, p).sum()) for p in parts) == len(model.encode(text))
