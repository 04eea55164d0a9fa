"""The operators' queries against brute force over whole small tables, and SQL where there is some."""

import collections
import hashlib
import html as entities
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
SPACE = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return {r[0]: r[1:] for r in con.sql("SELECT doc_id, text, lang FROM documents").fetchall()}


def remainder(i, by):
    return zlib.crc32(str(i).encode()) % by


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rel = con.sql(ORACLES[name])
    names = [d[0] for d in rel.description]
    own = collections.Counter(tuple(r[c] for c in columns) for r in df.collect())
    other = collections.Counter(tuple(r[names.index(c)] for c in columns) for r in rel.fetchall())
    assert sorted(names) == columns and own == other


def test_toxicity_beats_a_guess(spark, con, docs):
    labels = dict(con.sql("SELECT doc_id, toxic FROM labels").fetchall())
    rows = QUERIES["op1_toxicity"](spark, SF).collect()
    assert len(rows) == len(docs) and all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) / len(held) > max(sum(a == 0 for a, _ in held), sum(a for a, _ in held)) / len(held)


def test_languages(spark, docs):
    rows = QUERIES["op4_language"](spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in rows)
    assert sum(r.lang_pred == docs[r.doc_id][1] for r in held) / len(held) > 0.98


def test_bpe_equals_the_library(spark, docs):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = QUERIES["op5_bpe"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = t.encode(docs[r.doc_id][0] or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_main_text(spark, con):
    pages = dict(con.sql("SELECT page_id, html FROM pages").fetchall())
    for r in QUERIES["op6_main_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(entities.unescape(re.sub(r"</?b>|<br>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_quality_counts(spark, con, docs):
    labels = dict(con.sql("SELECT doc_id, quality FROM labels").fetchall())
    right = collections.Counter()
    for r in QUERIES["op7_quality"](spark, SF).collect():
        text = docs[r.doc_id][0] or ""
        words = re.findall(SPACE, text)
        windows = collections.defaultdict(list)
        for i in range(len(words) - 4):
            windows[tuple(words[i : i + 5])].append(i)
        marked = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(SPACE, line):
                dup += line in seen
                seen.add(line)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), symbols, dup, len(marked))
        assert r.base_failed == (len(words) < 10 or 100 * len(marked) > 20 * len(words))
        assert not (r.base_failed and r.kept)
        if r.doc_id in labels and not r.base_failed:
            right[labels[r.doc_id] == r.kept] += 1
    assert right[False] <= 0.02 * right[True]


def test_simhash_components(spark, docs):
    rows = QUERIES["op8_simhash"](spark, SF).collect()
    prints = {}
    for i, (text, _) in docs.items():
        words = re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = np.array(sorted(prints))
    a = np.array([prints[i] for i in ids], dtype=np.uint64)
    up = {int(i): int(i) for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[k + 1 :] ^ a[k]) <= 4):
            x, y = root(int(ids[k])), root(int(ids[k + 1 + j]))
            up[max(x, y)] = min(x, y)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{prints[i]:016x}", root(i)) for i in prints}


def test_mixing_meets_targets(spark, docs):
    from tidemark.llm.queries import TARGETS

    rows = QUERIES["op10_mixing"](spark, SF).collect()
    total = sum(r.tokens * r.rate for r in rows)
    for lang, share in TARGETS.items():
        assert abs(sum(r.tokens * r.rate * r[f"p_{lang}"] for r in rows) / total - share) < 1e-3
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert all(r.tokens == len(re.findall(SPACE, docs[r.doc_id][0])) for r in rows)
    assert sum(r.domain == docs[r.doc_id][1] for r in rows) / len(rows) > 0.98
