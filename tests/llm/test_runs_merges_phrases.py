"""Periodic runs, merge replay and collocations against brute force, the
library and SQL, on odd texts and on a given table."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from keelson.llm import merge_replay, phrases, queries, runs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def same(got, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# 11 runs

def brute_runs(w, least=runs.LEAST):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] == w[i + q]:
                j = i
                while j + q < n and w[j] == w[j + q]:
                    j += 1
                if j - i + q >= max(least, 2 * q):
                    found.setdefault((i, j - i + q), q)
                i = j
            i += 1
    return sorted((s, q, m) for (s, m), q in found.items())


def run_row(doc, text, echo):
    w = WORD.findall(text)
    n, h = len(w), zlib.crc32(str(doc).encode())
    if echo and doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, q, m in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[2], r[0], r[1]), default=None)
    top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    listed = "".join(f"{s},{m},{q}\n" for s, q, m in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc, n, len(found), *top, *(hashlib.sha256(x.encode()).hexdigest()
                                        for x in (listed, kept)))


def test_runs_of_random_words():
    rng = np.random.default_rng(5)
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    for _ in range(60):
        texts = [list(fib[-1])] if rng.random() < 0.1 else []
        for _ in range(int(rng.integers(0, 5))):
            w = rng.integers(0, rng.integers(1, 5), int(rng.integers(0, 150)))
            if len(w) > 4 and rng.random() < 0.6:
                a = int(rng.integers(0, len(w)))
                p = 1 + (len(w) - a) // int(rng.integers(3, 11))
                at = np.arange(len(w))
                w = w[np.where(at < a, at, a + (at - a) % p)]
            texts.append(w.tolist())
        names = [{x: k for k, x in enumerate("abcdef")}.get(x, x) for t in texts for x in t]
        first = np.cumsum([0, *map(len, texts)])
        got = runs.find_runs(np.array(names, np.int64), first)
        want = [(f + s, m, q) for t, f in zip(texts, first.tolist()) for s, q, m in brute_runs(t)]
        assert list(zip(*(x.tolist() for x in got))) == want


def test_grammar_tells_texts_apart_that_hash_alike():
    """Thue-Morse words and their complement: names are by bytes."""
    bit = lambda i: bin(i).count("1") & 1
    one = bytes(97 + bit(i) for i in range(4096))
    two = bytes(98 - bit(i) for i in range(4096))
    raw = np.frombuffer(one + two + one, np.uint8)
    at = np.array([0, 4096, 8192])
    assert runs.exact_names(raw, at, at + 4096).tolist() == [0, 1, 0]


def test_runs_of_tables(docs, messy, nothing):
    for df in (docs, messy):
        got = runs.summary(runs.runs(runs.with_echo(df.select("doc_id", "text"))))
        same(got.collect(), [run_row(d, t, True) for d, t in pairs(df)])
    plain = runs.summary(runs.runs(messy))
    same(plain.collect(), [run_row(d, t, False) for d, t in pairs(messy)])
    assert runs.runs(nothing).collect() == []


# 12 merges

@pytest.fixture(scope="module")
def facts():
    return merge_replay.Vocabulary(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(facts):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=facts.ranks, special_tokens={})


ODD = ["", "a", " ", "it's", "'s's", "'''s", "it'll'llx", "don'tx 's 'S '", "  a  b\n\n c \t\n",
       "x  ", " a", "é'ré", "1234 ٣٤", "🙂🙂 🙂a", "\U00010ee7a \U00010ee7a", "\x1c\x1d a", "a\x85b",
       "a" * 5000, "ab" * 3000, "'", " '", "'re've'm", "''ll", "\x00\x00 \x00", "\n's", "a'l", "'r"]


def test_merges_are_the_librarys(facts, library):
    rnd = random.Random(9)
    tokens = list(facts.ranks)
    texts = list(ODD)
    for _ in range(6000):
        n = rnd.randint(0, 30)
        texts.append(rnd.choice([
            b"".join(rnd.choices(tokens, k=n)).decode("utf-8", "ignore"),
            "".join(chr(rnd.choice([rnd.randint(0, 127), rnd.randint(0, 0xD7FF),
                                    rnd.randint(0xE000, 0x10FFFF)])) for _ in range(n)),
            "".join(rnd.choices("ab '\n stre\tvlmd1.", k=2 * n))]))
    pieces, first = merge_replay.cut(pa.array(texts), merge_replay.kind_table(facts.kinds))
    codes = pieces.dictionary_encode()
    flat, at = merge_replay.Merger(facts.ranks).merge_all(codes.dictionary.to_pylist())
    which = codes.indices.to_pylist()
    for text, a, b in zip(texts, first[:-1].tolist(), first[1:].tolist()):
        got = [x for k in which[a:b] for x in flat[at[k]:at[k + 1]].tolist()]
        assert got == library.encode_ordinary(text), text


def test_merge_order_with_ranks_that_go_down():
    """A merge may make a pair of a lower rank than its own."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"bc": 260, b"abc": 270, b"cab": 255 + 3,
                                                    b"aa": 280, b"aab": 256, b"aaa": 257}
    own = tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks=ranks | {
        bytes([0, k]): 1000 + k for k in range(1)}, special_tokens={})
    merger = merge_replay.Merger(ranks | {bytes([0, 0]): 1000})
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abc", k=rnd.randint(1, 14))) for _ in range(3000)]
    flat, at = merger.merge_all([w.encode() for w in words])
    for w, a, b in zip(words, at[:-1], at[1:]):
        assert flat[a:b].tolist() == own.encode_ordinary(w), w
        assert merger.ranks.get(w.encode()) is not None or \
            merger.merge_alone(w.encode()) == own.encode_ordinary(w)


def test_merges_of_tables(docs, messy, nothing, facts, library):
    for df in (docs, messy):
        encoded = merge_replay.encode(df, facts)
        want = [(d, library.encode_ordinary(t)) for d, t in pairs(df)]
        same([(r.doc_id, tuple(r.ids)) for r in encoded.collect()],
             [(d, tuple(ids)) for d, ids in want])
        same([(r.doc_id, bytes(r.decoded)) for r in merge_replay.decode(encoded, facts).collect()],
             [(d, t.encode()) for d, t in pairs(df)])
        digest = lambda raw: hashlib.sha256(raw).hexdigest()
        same(merge_replay.digests(df, facts, corpus=1000).collect(), [
            (d, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(library.decode_bytes(ids)))
            for d, ids in want])
    assert merge_replay.encode(nothing, facts).collect() == []


# 13 phrases

def brute_phrases(rows, least, top):
    out = []
    for lang in sorted({la or "und" for la, _ in rows} - {None}):
        f, n = Counter(), 0
        for la, text in rows:
            if (la if la is not None else "und") != lang:
                continue
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                for k in range(1, 6):
                    f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = {}
        for p, c in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    q = p[i:i + k]
                    inside[q] = max(inside.get(q, 0), c)
        scored = []
        for p, a in cand.items():
            if inside.get(p, 0) >= a:
                continue
            s, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


def rows_of(df):
    return [(r.lang, r.text) for r in df.select("lang", "text").collect()]


@pytest.mark.parametrize("bucket", [10, 500, phrases.BUCKET])
def test_phrases_with_hot_words(spark, bucket):
    """Buckets so small that most words are hot: stripes are split and summed."""
    rnd = random.Random(bucket)
    words = "the of and x y'z Rare".split() + [f"w{k}" for k in range(6)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 60))).replace("x", "x,") for _ in range(90)]
    texts += ["the of and the of, Aa Bb cc DD ee ff!"] * 40
    df = spark.createDataFrame(
        [(k, t, rnd.choice(["en", "de", None])) for k, t in enumerate(texts)],
        "doc_id long, text string, lang string")
    for top in (5, 2000):
        got = phrases.collocations(df, least=4, top=top, bucket=bucket, slice_bytes=700)
        same(got.collect(), brute_phrases(rows_of(df), 4, top))


def test_phrases_of_tables(docs, messy, nothing):
    same(phrases.collocations(docs, least=15).collect(), brute_phrases(rows_of(docs), 15, 2000))
    same(phrases.collocations(messy, least=3).collect(), brute_phrases(rows_of(messy), 3, 2000))
    assert phrases.collocations(nothing).collect() == []


def test_words_of_slices_are_dealt_once(spark):
    """Counts and ids of the slices' words come from one exchange, without a join;
    each word has one id, and its name once. A word of two languages is two."""
    rnd = random.Random(13)
    rows = [(s, k, "en" if s < 30 else "de", f"w{k}", rnd.randint(1, 3))
            for s in range(40) for k in range(300) if rnd.random() < 5 / (k + 1)]
    df = spark.createDataFrame(rows, "slice long, local int, lang string, word string, n long")
    f = Counter()
    for _, _, lang, word, n in rows:
        f[lang, word] += n
    out = phrases.numbered(df, 9)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    got = out.collect()
    of = {r.id: (r.lang, r.word) for r in got if r.word is not None}
    assert len(of) == len(set(of.values())) == sum(r.word is not None for r in got)
    same([(r.slice, r.local, *of[r.id], r.f) for r in got],
         [(s, k, lang, word, f[lang, word]) for s, k, lang, word, _ in rows if f[lang, word] >= 9])
    assert phrases.numbered(df.limit(0), 1).collect() == []


def test_hot_prefixes_are_dealt_by_further_words():
    """Windows that begin with one hot pair go to many buckets; a pair with a
    word that is not hot goes to one."""
    third = np.arange(1000) * 2
    hot = [np.full(1000, 1), np.full(1000, 3), third, third, third]
    assert len(np.unique(phrases.bucket_of(hot, 50))) == 50
    cold = [np.full(1000, 1), np.full(1000, 4), third, third, third]
    assert len(np.unique(phrases.bucket_of(cold, 50))) == 1


def test_new_queries_are_registered():
    assert {"op11_periodic_runs", "op12_merge_replay", "op13_collocations"} <= set(queries.QUERIES)
    assert "op13_collocations" in queries.ORACLES
