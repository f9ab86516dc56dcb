"""Each operator against a brute-force version, the library, or a round trip,
on odd texts and on the smallest given table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from keelson.llm import (byte_bpe, leaks, licenses, lines, near, pieces, quality, queries,
                         samples, substrings, token_count, toxicity, wavelet)
from tests.llm.texts import prose

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def rows(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def same(got, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# 1 quality

def base_rules(text):
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if count[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), failed)


def test_quality_rules(docs, labels, messy, nothing):
    model = quality.train(samples.labelled_sample(docs, labels, "quality"))
    for df in (docs, messy):
        got = quality.score(df, model).collect()
        same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
               r.base_failed) for r in got], [(i, *base_rules(t)) for i, t in rows(df)])
        assert all(r.kept == (not r.base_failed and r.quality >= quality.KEEP) for r in got)
        assert all(0 <= r.quality <= 1 for r in got)
    assert quality.score(nothing, model).count() == 0


def test_quality_learns_and_is_calibrated():
    r = random.Random(4)
    rows_ = []
    for k in range(600):
        good = k % 3 != 0
        t = prose(k, 60) if good else " | ".join(r.choice("#$%&") * 3 for _ in range(60))
        rows_.append(SimpleNamespace(label=int(good), text=t))
    model = quality.train(rows_[:400])
    p = quality.measure(pa.array([x.text for x in rows_[400:]]), model)["quality"]
    y = np.array([x.label for x in rows_[400:]])
    assert ((p >= 0.5) == y).mean() > 0.98
    assert abs(p.mean() - y.mean()) < 0.05


def test_training_without_both_labels():
    one = [SimpleNamespace(label=1, text="a b c")]
    assert quality.measure(pa.array(["x"]), quality.train(one))["quality"][0] > 0.5
    assert toxicity.train([]).scores(pa.array(["x", ""])).max() < 0.5


# 2 and 3 tokens

def test_pieces_are_the_librarys(docs, messy, nothing):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    model = pieces.PieceModel(path)
    assert model.chunked and model.line_border
    for df in (docs, messy):
        out = pieces.encode(df.select("doc_id", "text", "lang"), model, decoded_col="decoded")
        want = [(i, sp.encode(t)) for i, t in rows(df)]
        same([(r.doc_id, tuple(r.ids), r.decoded) for r in out.collect()],
             [(i, tuple(ids), sp.decode(ids)) for i, ids in want])
        again = pieces.decode(out.drop("decoded"), model)
        same([(r.doc_id, r.decoded) for r in again.collect()],
             [(i, sp.decode(ids)) for i, ids in want])
        digest = {(r.doc_id, r.ids_sha256, r.n_tokens) for r in pieces.digests(df, model).collect()}
        assert digest == {(i, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), len(ids))
                          for i, ids in want}
    assert pieces.encode(messy, model).count() == messy.count()  # replaces the column `ids`
    assert pieces.digests(nothing, model).count() == 0


def test_piece_borders():
    model = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    table = pieces._chunks(model)
    r = random.Random(1)
    for _ in range(3000):
        t = "".join(r.choice(" \n\n  ab▁é\t日0.") for _ in range(r.randrange(12)))
        assert np.frombuffer(table.encode(t), np.int32).tolist() == table.sp.encode(t), repr(t)


def test_token_counts_are_the_librarys(docs, messy, nothing):
    facts = token_count.WholeTokens(public_tokenizers.path("word_bpe_49k.json"))
    tok = token_count._tokenizer(facts.spec)
    for df in (docs, messy):
        got = token_count.count_tokens(df, facts).collect()
        same([(r.doc_id, r.n_tokens) for r in got],
             [(i, len(tok.encode(t, add_special_tokens=False).ids)) for i, t in rows(df)])
    assert set(messy.columns) <= set(token_count.count_tokens(messy, facts).columns)
    assert token_count.count_tokens(nothing, facts).count() == 0
    counter = token_count._Counter(facts)
    r = random.Random(2)
    for _ in range(2000):
        t = "".join(r.choice("aBÉ's 'll't.!?1½ \x85\x1cſİΣ<|endoftext|>") for _ in range(r.randrange(14)))
        assert counter.count(t) == len(tok.encode(t, add_special_tokens=False).ids), repr(t)


# 4 substrings

def kept_words(table):
    least = {}
    for i, t in table:
        if i is not None:
            w = WORD.findall(t)
            for k in range(len(w) - 12):
                key = tuple(w[k:k + 13])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, t in table:
        w = WORD.findall(t)
        gone = set()
        for k in range(len(w) - 12) if i is not None else ():
            if least[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_substrings(docs, messy, nothing):
    for df in (docs, messy):
        same(substrings.remove_repeats(df).collect(), kept_words(rows(df)))
    assert substrings.remove_repeats(nothing).count() == 0


def test_substrings_with_equal_hashes(monkeypatch):
    """Windows are told apart by their bytes when their hashes clash."""
    monkeypatch.setattr(substrings, "window_hashes",
                        lambda words, size: np.zeros(len(words), np.uint64))
    texts = [prose(1, 30), prose(2, 30), prose(1, 30) + " " + prose(3, 20)]
    cut = substrings._Cut()
    cut.add(np.array([1, 2, 3]), pa.array(texts), 13, 3)
    (bucket, payload), = cut.flush(1)
    doc, first, count = substrings._bucket_flags([payload], 13)
    assert list(zip(doc, first, count)) == [(3, 0, 18)]


# 5 decontamination

def brute_align(item, text):
    best = 0
    row = [0] * (len(text) + 1)
    for w in item:
        new = [0]
        for j, x in enumerate(text, 1):
            new.append(max(0, row[j - 1] + (2 if w == x else -1), row[j] - 1, new[-1] - 1))
        row = new
        best = max(best, max(row))
    return best


def test_alignment():
    r = np.random.default_rng(3)
    items = r.integers(1, 5, (40, 9)).astype(np.uint64)
    texts = r.integers(1, 5, (40, 20)).astype(np.uint64)
    score, _ = leaks.align(items, texts)
    assert score.tolist() == [brute_align(a.tolist(), b.tolist()) for a, b in zip(items, texts)]


def test_leaks_found_exact_and_edited(spark, messy, nothing):
    items = [(k, prose(50_000 + k, 30)) for k in range(12)] + [(90, "too short"), (91, None), (None, "x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    r = random.Random(5)
    table, want = [], set()
    for k, t in items[:12]:
        w = t.split()
        for j in r.sample(range(30), 4):
            w[j] = "other"
        del w[10]
        table.append((k, prose(900 + k, 300) + " " + (t.upper() if k % 2 else " ".join(w))
                      + ". " + prose(950 + k, 40)))
        want.add((k, k))
    table += [(100 + k, prose(2000 + k, 200)) for k in range(20)] + [(None, items[0][1]), (7, None)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    found = leaks.find(df, bench).collect()
    assert {(x.doc_id, x.item_id) for x in found} == want | {(None, 0)}
    assert len(found) == len(want) + 1
    clean = leaks.clean(df, bench)
    assert clean.columns == df.columns
    assert {x.doc_id for x in clean.collect()} == {None} | set(range(100, 120))
    assert leaks.find(messy, bench).count() == 0
    assert leaks.find(nothing, bench).count() == 0
    assert leaks.find(df, bench.limit(0)).count() == 0


def test_leaks_in_a_hot_group_of_edited_copies(spark):
    """A hot group of edited or partial copies is found beside one fuller copy."""
    w = prose(61_000, 40).split()
    edited_copy = " ".join("other" if k % 5 == 4 else x for k, x in enumerate(w))
    bench = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    for hot in (edited_copy, " ".join(w[:21])):
        table = [(0, prose(1, 50) + " " + " ".join(w))]
        table += [(k, f"{prose(100 + k, 30)} {hot} {prose(5000 + k, 30)}") for k in range(1, 201)]
        table += [(k, prose(9000 + k, 90)) for k in range(300, 320)]
        df = spark.createDataFrame(table, "doc_id long, text string")
        assert {x.doc_id for x in leaks.find(df, bench).collect()} == set(range(201))


def test_leaks_below_the_bound_are_not_aligned_and_none_above_is_lost():
    r = random.Random(11)
    items = leaks.Items([1, 2], [prose(62_000, 24), prose(62_001, 9)])
    texts = []
    for k in range(200):
        w = prose(62_000 + k % 2, 24 if k % 2 == 0 else 9).split()
        for j in r.sample(range(len(w)), r.randrange(len(w))):
            w[j] = r.choice(["other", w[0], "more"])
        texts.append(" ".join(prose(k, 5).split() + w + prose(k + 7, 5).split()))
    t, words, key = leaks._trigrams(pa.array(texts))
    loose = leaks._passages(items, t, words, key, 0.0)
    tight = leaks._passages(items, t, words, key, 0.5)
    above = lambda x: {tuple(v) for v in zip(*(c.tolist() for c in x)) if v[3] >= 0.5}
    assert above(loose) == above(tight) and 0 < len(above(loose)) < len(loose[0])
    assert (tight[3] == 0).any()


def test_leaks_with_every_third_word_replaced_and_short_items(spark):
    items = [(k, prose(63_000 + k, 36)) for k in range(8)] + [(50, "amber kites drift over quiet harbours")]
    table = []
    for k, t in items[:8]:
        w = [f"x{j}" if j % 3 == k % 3 else x for j, x in enumerate(t.split())]
        table.append((k, " ".join(prose(64_000 + k, 80).split() + w + prose(65_000 + k, 30).split())))
    table += [(20, "Once amber kites drift, over quiet harbours."),
              (21, "Once amber kites drift over some quiet harbours.")]
    df = spark.createDataFrame(table, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(x.doc_id, x.item_id) for x in leaks.find(df, bench).collect()}
    assert found == {(k, k) for k in range(8)} | {(20, 50)}


def test_leaks_recall_by_edits(spark):
    """Copies that still align at the threshold are found, by brute force over all words."""
    r = random.Random(77)
    items = [(k, prose(66_000 + k, 20 + k)) for k in range(20)]
    table, want = [], set()
    for k, t in items:
        for rate in (0.1, 0.2, 0.3):
            w = [f"y{r.randrange(99)}" if r.random() < rate else x for x in t.split()]
            d = len(table)
            table.append((d, " ".join(prose(67_000 + d, 40).split() + w + prose(68_000 + d, 20).split())))
            if brute_align(t.split(), table[-1][1].lower().split()) >= len(t.split()):
                want.add((d, k))
    found = {(x.doc_id, x.item_id) for x in leaks.find(
        spark.createDataFrame(table, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 30 and len(found & want) >= 0.95 * len(want)
    assert all(d // 3 == k for d, k in found)


def test_common_seeds_ask_for_a_second_one(spark):
    """A phrase that often stands alone is common; a hot group of copies is not."""
    item = "on the other hand " + prose(69_000, 20)
    items = leaks.Items([1], [item])
    table = [(k, f"{prose(69_100 + k, 9)} on the other {prose(69_300 + k, 9)}") for k in range(60)]
    table += [(100 + k, prose(69_500 + k, 9) + " " + item) for k in range(60)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    leaks._mark_common(df, items)
    assert items.common.sum() == 1
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {x.doc_id for x in leaks.find(df, bench).collect()} == set(range(100, 160))


def test_leaks_beside_a_very_long_item(spark):
    """Memory follows what is aligned, not the longest item of the block."""
    long = " ".join(f"w{k}" for k in range(180_000))
    items = [(k, prose(71_000 + k, 12)) for k in range(300)] + [(999, long)]
    df = spark.createDataFrame([(1, "so " + items[5][1] + " then"), (2, prose(72_000, 50))],
                               "doc_id long, text string")
    found = leaks.find(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(x.doc_id, x.item_id) for x in found] == [(1, 5)]


def test_leaks_in_the_given_table(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {(x.doc_id, x.item_id) for x in leaks.find(docs, bench).collect()}
    word = lambda t: re.findall(r"[^\W_]+", t.lower())
    texts = [(i, " " + " ".join(word(t)) + " ") for i, t in rows(docs)]
    whole = {(i, b.item_id) for b in bench.collect() for i, t in texts
             if f" {' '.join(word(b.text))} " in t}
    assert whole <= found and len(found) < 3 * len(whole) + 3


# 6 toxicity

def test_toxicity_gradients():
    texts = [prose(k, 40) for k in range(4)] + ["a"]
    y = np.array([1, 0, 1, 0, 1.0])
    words = toxicity.Words(pa.array(texts))
    model = toxicity.ToxicityModel(np.sort(words.key[:20]))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    grads = toxicity._gradients(model, words, np.arange(5), y)

    def loss():
        begin, stop, count = words.windows()
        ids, mask = toxicity._cut(words.place, begin, stop)
        logit = model.forward(model.projections(model.inputs(words)[0]), ids, mask)[0]
        doc = [np.log(np.exp(toxicity.SHARP * x).sum()) / toxicity.SHARP
               for x in np.split(logit, np.cumsum(count)[:-1])]
        p = 1 / (1 + np.exp(-np.array(doc)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, value in model.p.items():
        flat, g = value.reshape(-1), np.asarray(grads[name]).reshape(-1)
        k = int(np.abs(g).argmax())
        was = flat[k]
        flat[k] = was + 1e-3
        up = loss()
        flat[k] = was - 1e-3
        down = loss()
        flat[k] = was
        assert g[k] == pytest.approx((up - down) / 2e-3, rel=1e-2, abs=1e-5), name


def test_toxicity_windows_cover_long_texts():
    r = random.Random(3)
    bad = ["vile", "scummy", "hateful"]

    def text(k, toxic, n):
        w = prose(k, n).split()
        if toxic:
            for j in r.sample(range(n), 3):
                w[j] = r.choice(bad)
        return " ".join(w)
    data = [SimpleNamespace(label=int(k % 4 == 0), text=text(k, k % 4 == 0, r.randrange(40, 500)))
            for k in range(500)]
    model = toxicity.train(data)
    p = model.scores(pa.array([text(1000 + k, k % 2 == 0, 800) for k in range(60)]))
    assert ((p >= 0.5) == (np.arange(60) % 2 == 0)).mean() > 0.9
    late = prose(1, 3000) + " vile scummy"
    assert model.scores(pa.array([late]))[0] > 0.5
    words = toxicity.Words(pa.array([prose(7, n) for n in range(0, 120)]))
    begin, stop, count = words.windows()
    covered = np.zeros(words.first[-1], int)
    for a, e in zip(begin, stop):
        covered[a:min(a + toxicity.LENGTH, e)] += 1
    assert covered.min() >= 1


def test_toxicity_scores(docs, labels, messy, nothing):
    model = toxicity.fit(docs, labels)
    for df in (docs, messy):
        got = toxicity.score(df, model).collect()
        assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    held = {r.doc_id: r.h for r in docs.select("doc_id", toxicity.held_out().alias("h")).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in held.items())
    kept = toxicity.scored(messy, model, "key")
    assert set(kept.columns) == set(messy.columns) and kept.count() == messy.count()
    assert toxicity.score(nothing, model).count() == 0


# 7 lines

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(r, s, n):
    s = list(s)
    for _ in range(n):
        k, x = r.randrange(len(s) + 1), r.random()
        if x < 0.34:
            s.insert(k, r.choice("abcé"))
        elif s and x < 0.67:
            s.pop(min(k, len(s) - 1))
        elif s:
            s[min(k, len(s) - 1)] = r.choice("abcé")
    return "".join(s)


def test_edit_distance():
    r = random.Random(0)
    for limit in range(5):
        for _ in range(1500):
            a = "".join(r.choice("abc") for _ in range(r.randrange(14)))
            b = edited(r, a, r.randrange(6))
            assert lines.within(a, b, limit) == (distance(a, b) <= limit), (a, b, limit)


def test_parities_bound_the_distance():
    r = random.Random(12)
    for _ in range(3000):
        a = "".join(r.choice("abc") for _ in range(r.randrange(1, 20)))
        b = edited(r, a, r.randrange(4))
        d = distance(a, b)
        chars, pairs = lines.Lines([a, b]).parities(np.array([0, 1]))
        assert int(chars[0] ^ chars[1]).bit_count() <= 2 * d
        assert int(pairs[0] ^ pairs[1]).bit_count() <= 4 * d


def test_lines_of_a_chain_and_families(spark):
    r = random.Random(6)
    table = []
    families = [edited(r, prose(k, 5), 0) for k in range(12)]
    for k in range(60):
        own = [edited(r, families[r.randrange(12)], r.randrange(4)) for _ in range(4)]
        table.append((k, "\n".join(own + ["short", "", prose(3000 + k, 8)])))
    df = spark.createDataFrame(table, "doc_id long, text string")
    got = {x.doc_id: (x.text, x.n_removed) for x in lines.remove(df).collect()}
    first = {}
    for i, t in table:
        for k, x in enumerate(t.split("\n")):
            if len(x) >= lines.LEAST:
                first.setdefault(x, (i, k))
    names = list(first)
    root = {x: x for x in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(names)):
        for b in range(a):
            if abs(len(names[a]) - len(names[b])) <= 2 and distance(names[a], names[b]) <= 2:
                root[find(names[a])] = find(names[b])
    head = defaultdict(lambda: (1 << 60, 0))
    for x in names:
        head[find(x)] = min(head[find(x)], first[x])
    removed = 0
    for i, t in table:
        left = [x for k, x in enumerate(t.split("\n"))
                if len(x) < lines.LEAST or head[find(x)] == (i, k)]
        assert got[i][0] == "\n".join(left)
        removed += got[i][1]
    assert removed > 100


def test_lines_of_odd_tables(messy, nothing):
    got = {}
    for r in lines.remove(messy).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {len(v) for k, v in got.items()} == {1, 2}
    assert got[1][0].text is None and got[2][0].text == ""
    assert all(r.n_removed == 0 for k in (None, 5, 6, 9) for r in got[k])
    assert got[7][0].n_removed == 6 and got[7][0].text == ""
    assert 5 <= got[8][0].n_removed <= 6
    assert got[10][0].n_removed == 0  # lines under the least length stay
    assert lines.remove(nothing).count() == 0


def test_short_lines_go_in_the_query(spark, tmp_path):
    """Equal lines go whatever their length; lines of 12 to 23 characters go at
    one edit, shorter ones only when equal; lines without a word stay."""
    table = [(1, "Menu\n}\n\n \t\nRights held by us\ncat"),
             (2, "Menu\n}\n\n \t\nRights held by us.\ncut\nMenu"),
             (3, "menu\nRights held by us!\nRight held by uss!\n" + "a" * 22 + "bc"),
             (4, "a" * 22 + "b"), (5, "a" * 22), (None, "Menu"), (6, None)]
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_near, r.kept_sha256)
           for r in queries.op7_line_dedup(spark, str(tmp_path)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: (6, 0, 0, sha(table[0][1])), 2: (7, 4, 1, sha("\n \t\ncut")),
                   3: (4, 1, 1, sha("menu\nRight held by uss!\n" + "a" * 22 + "bc")), 4: (1, 1, 1, sha("")),
                   5: (1, 1, 1, sha("")), None: (1, 0, 0, sha("Menu")), 6: (0, 0, 0, sha(""))}


def test_short_lines_equal_brute_force(spark):
    r = random.Random(13)
    table = []
    families = ["".join(r.choice("abc ") for _ in range(n)) for n in range(1, 29) for _ in range(2)]
    for k in range(80):
        table.append((k, "\n".join(edited(r, families[r.randrange(len(families))],
                                          r.randrange(3)) for _ in range(6))))
    df = spark.createDataFrame(table, "doc_id long, text string")
    got = {x.doc_id: x.text for x in lines.remove(df, bounds=lines.BOUNDS).collect()}
    edits = lambda n: max([e for least, e in lines.BOUNDS if n >= least], default=0)
    first = {}
    for i, t in table:
        for k, x in enumerate(t.split("\n")):
            if WORD.search(x):
                first.setdefault(x, (i, k))
    names = list(first)
    root = {x: x for x in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(names)):
        for b in range(a):
            if distance(names[a], names[b]) <= edits(min(len(names[a]), len(names[b]))):
                root[find(names[a])] = find(names[b])
    head = defaultdict(lambda: (1 << 60, 0))
    for x in names:
        head[find(x)] = min(head[find(x)], first[x])
    for i, t in table:
        assert got[i] == "\n".join(x for k, x in enumerate(t.split("\n"))
                                   if not WORD.search(x) or head[find(x)] == (i, k))


# 8 near duplicates

def test_prob_minhash_estimates_probability_jaccard():
    r = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        n = 200
        x, y = r.integers(1, 4, n) * (r.random(n) < 0.9), r.integers(1, 4, n) * (r.random(n) < 0.9)
        key = r.integers(1, 1 << 62, n).astype(np.uint64)
        exact = sum(1 / np.maximum(x / x[d], y / y[d]).sum() for d in range(n) if x[d] and y[d])
        text = np.repeat([0, 1], [(x > 0).sum(), (y > 0).sum()])
        sig = near.prob_minhash(text, np.concatenate([key[x > 0], key[y > 0]]),
                                np.concatenate([x[x > 0], y[y > 0]]).astype(float), 2)
        errors.append((sig[0] == sig[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.025 and np.std(errors) < 0.09


def test_shingle_parities_bound_the_difference():
    r = np.random.default_rng(5)
    key = r.integers(1, 1 << 62, 900).astype(np.uint64)
    for n in (3, 100, 600):
        a, b = np.unique(r.choice(key, n)), np.unique(r.choice(key, n))
        text = np.repeat([0, 1], [len(a), len(b)])
        odd = near.parities(text, np.concatenate([a, b]), 2).view(np.uint64)
        apart = sum(int(x ^ y).bit_count() for x, y in zip(odd[0], odd[1]))
        assert apart <= len(np.setxor1d(a, b))
        assert near.parities(text, np.concatenate([a, b]), 3)[2].tolist() == [0] * near.PARITY


def brute_classes(table, threshold=0.8):
    sets = {}
    for i, t in table:
        w = WORD.findall(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else {t}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_classes(docs, messy, nothing):
    got = {r.doc_id: r.class_id for r in near.classes(docs).collect()}
    assert got == brute_classes(rows(docs))
    odd = {r.doc_id: r.class_id for r in near.classes(messy).collect()}
    assert odd[None] is None
    assert {k: v for k, v in odd.items() if k in (6, 7, 8)} == {6: 6, 7: 6, 8: 6}
    assert odd[1] == odd[2] == 1  # NULL counts as empty
    assert odd[3] == 3 and odd[4] == 4
    kept = near.keep_one(messy)
    assert kept.columns == messy.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        map(str, [1, 3, 4, 5, 6, 6, 9, 10, 11, None]))
    assert near.classes(nothing).count() == 0


def test_near_classes_with_unequal_repeat_counts(spark):
    """Links go by shingle sets, however often one side repeats a shingle."""
    table = []
    for k in range(30):
        base, spam = prose(70_000 + k, 104), prose(80_000 + k, 12)
        times = (2, 10, 50)[k % 3]
        table += [(2 * k, base), (2 * k + 1, base + f" {spam}" * times)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    want = brute_classes(table)
    assert all(want[2 * k + 1] == 2 * k for k in range(30))
    assert {r.doc_id: r.class_id for r in near.classes(df).collect()} == want


def test_near_classes_of_a_large_group(spark):
    """A large group of near copies, some of which are linked by others only."""
    r = random.Random(21)
    base = prose(90_000, 120).split()
    table = [(k, prose(91_000 + k, 60)) for k in range(40)]
    for k in range(600):
        w = list(base)
        for j in r.sample(range(120), r.choice((1, 2, 3, 5, 8))):
            w[j] = f"other{r.randrange(400)}"
        table.append((1000 + k, " ".join(w[:r.choice((120, 118, 105))])))
    df = spark.createDataFrame(table, "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in near.classes(df).collect()}
    want = brute_classes(table)
    assert len(set(want.values())) > 42 and got == want


def test_linked_classes_miss_no_link(spark):
    """Every pair of a bucket is tested or already of one class."""
    from keelson.llm.groups import linked_classes
    r = random.Random(8)
    bucket = [(k, n) for k in range(6) for n in r.sample(range(60), 25)]
    link = {(a, b) for a in range(60) for b in range(a + 1, 60) if r.random() < 0.03}
    links = spark.createDataFrame(sorted(link), "a long, b long")
    got = {x.node: x.root for x in linked_classes(
        spark.createDataFrame(bucket, "key long, node long"),
        lambda pairs: pairs.join(links, ["a", "b"])).collect()}
    root = {n: n for n in range(60)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    members = defaultdict(set)
    for k, n in bucket:
        members[k].add(n)
    for a, b in link:
        if any(a in m and b in m for m in members.values()):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert {n: got.get(n, n) for n in range(60)} == {n: find(n) for n in range(60)}


# 9 licenses

def test_licenses(spark, messy, nothing):
    import duckdb
    odd = spark.createDataFrame(
        [(1, "Licensed under cc-BY nc 4.0.\nAPACHE\x0blicense apache LICENSE, mit Licenſe"),
         (2, "the MITé License"), (3, None), (None, "released under THE mit"),
         (None, "mit license"), (5, "gnu general public gnu general public license"), (5, ""),
         (6, "work this is licensed general under the public gnu license 3 version")],
        "doc_id long, text string")
    for df in (messy, odd):
        con = duckdb.connect()
        con.register("documents", pa.Table.from_pylist(
            [{"doc_id": r.doc_id, "text": r.text} for r in df.select("doc_id", "text").collect()],
            pa.schema([("doc_id", pa.int64()), ("text", pa.string())])))
        out = licenses.scan(df)
        want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({licenses.scan_sql()})").fetchall()
        same(out.collect(), want)
    got = {r.text: r for r in licenses.scan(odd).join(odd.dropDuplicates(["doc_id"]), "doc_id").collect()}
    assert got[odd.first().text].labels == "apache,cc-by,cc-by-nc-4.0"
    assert licenses.scan(nothing).count() == 0


# 10 shards

def test_wavelet_shard():
    r = np.random.default_rng(1)
    for n in (0, 1, 7, 5000, 600_000):
        ids = (r.zipf(1.3, n) % 50_000).astype(np.uint32)
        shard = wavelet.WaveletShard(wavelet.build(ids, [None, 3], np.array([n // 2, n - n // 2])))
        assert (shard.tokens() == ids).all()
        for i in r.integers(0, n, 10) if n else ():
            assert shard.access(int(i)) == ids[i]
        for t in set(ids[:10].tolist()):
            at = np.flatnonzero(ids == t)
            assert shard.count(t) == len(at)
            assert shard.count(t, n // 3, n // 2) == (ids[n // 3:n // 2] == t).sum()
            assert shard.select(t, len(at) - 1) == at[-1]
            if len(at) < 50:
                assert shard.occurrences(t) == at.tolist()
        assert shard.count(60_000) == 0
    big = np.array([5, 1 << 30, 5, (1 << 32) - 1], np.uint32)
    assert (wavelet.WaveletShard(wavelet.build(big, [1], np.array([4]))).tokens() == big).all()


def test_token_shards(spark, docs, messy, nothing):
    facts = byte_bpe.BpeFile(public_tokenizers.path("byte_bpe_50k.json"))
    tok = token_count._tokenizer(facts.spec)
    for df, limit in ((docs, 20_000), (messy, 1_000)):
        manifest = wavelet.write_shards(df, facts, wavelet.shard_folder(spark), shard_tokens=limit)
        assert manifest.count() > 1
        want, start = [], 0
        for i, t in sorted(rows(df), key=lambda r: (r[0] is not None, r[0] or 0)):
            ids = tok.encode(t, add_special_tokens=False).ids + [2]
            want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        same(wavelet.read_documents(spark, manifest).collect(), want)
    manifest = wavelet.write_shards(nothing, facts, wavelet.shard_folder(spark))
    assert wavelet.read_documents(spark, manifest).count() == 0


def test_byte_ids_are_the_librarys():
    facts = byte_bpe.BpeFile(public_tokenizers.path("byte_bpe_50k.json"))
    enc = byte_bpe.encoder(facts)
    r = random.Random(9)
    texts, ids = [], []
    for k in range(6000):
        some = "aB é's 'll't.!?1½ \n\n \t\x85\x1c\xa0日<|endoftext|>  " if k % 3 == 0 else "abé.!1½  \n\n\t\xa0"
        t = "".join(r.choice(some) for _ in range(r.randrange(14)))
        want = enc.tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == want, repr(t)
        texts.append(t)
        ids.append(want)
    for some in (slice(None), slice(0, 1), slice(5, 5)):
        got = enc.encode_many(texts[some])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == ids[some]
