"""Collocations, the Jaccard join and periodic runs against plain versions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shockwell.llm import collocations, common, jaccard, periodic_runs, sampling
from tests.llm.helpers import ODD, documents, lower_az, words_of

# ------------------------------------------------------------ periodic runs


def plain_runs(w, shortest=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(shortest, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def runs_by_operator(texts, shortest):
    counts, start, length, period, keep = periodic_runs.runs_of_texts(texts, shortest)
    rows = [tuple(map(int, r)) for r in zip(start, length, period)]
    stops = np.cumsum(counts)
    return [rows[b - n:b] for n, b in zip(counts, stops)], keep


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=6), st.sampled_from([2, 3, 4, 6, 12, 15]))
def test_runs_of_random_words(texts, shortest):
    texts = [[b"%d" % x for x in t] for t in texts]
    got, _ = runs_by_operator(texts, shortest)
    assert [sorted(g) for g in got] == [plain_runs(t, shortest) for t in texts]


def test_runs_of_repetitive_words():
    rng = random.Random(5)
    for _ in range(150):
        words = []
        while len(words) < 150:
            period = [rng.randrange(3) for _ in range(rng.choice([1, 2, 3, 5, 7, 10, 11, 12, 22, 23, 24]))]
            words += period * rng.choice([1, 2, 2, 3, 5]) + period[:rng.randrange(len(period))]
        fibonacci, before = [0, 1], [0]
        while len(fibonacci) < 150:
            fibonacci, before = fibonacci + before, fibonacci
        texts = [[b"%d" % x for x in t] for t in (words, fibonacci, [0] * 90)]
        got, keep = runs_by_operator(texts, 12)
        assert [sorted(g) for g in got] == [plain_runs(t) for t in texts]
        assert keep.tolist() == [not any(s + q <= i < s + n for s, n, q in g) for t, g in zip(texts, got) for i in range(len(t))]


def planted(doc_id, w):
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_run_digests_of_odd_rows(spark):
    data = [*ODD, *((i, "a b c d e f g h i j k l m n " * 3) for i in range(100, 140)), (200, "same " * 60_000)]
    found = periodic_runs.periodic_runs(documents(spark, data), rewrite=periodic_runs.planted)
    got = periodic_runs.digest(found).collect()
    want = []
    for i, t in data:
        w = planted(i, words_of(t))
        runs = [(0, 60_000, 1)] if i == 200 else sorted(plain_runs(w), key=lambda r: (r[0], r[2]))
        kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in runs)] if i != 200 else w[:1]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
        want.append((i, len(runs), *best, best[1] and 1000 * best[1] // best[2],
                     hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                     hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert periodic_runs.periodic_runs(documents(spark, [])).count() == 0


# -------------------------------------------------------------- collocations

def plain_collocations(rows, least, most):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_az(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates, found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}, []
        for p, a in candidates.items():
            if any(100 * b >= 50 * a for q, b in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(11)
    vocabulary = [*"abcdefg", "é", "日本", "of", "The", "THE"]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",", "\n", "\t"]) for _ in range(rng.randrange(1, 300))) for _ in range(40)]
    return [("en" if k % 3 else None, t) for k, t in enumerate(texts)] + [("de", t) for _, t in ODD] + [("hot", "one two three four " * 500)]


@pytest.mark.parametrize("limits", [{}, {"most_phrases": 40, "batch_words": 50}])
def test_collocations_whatever_the_tries_spill(spark, limits, monkeypatch):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, g, 1, "x") for g, t in rows], "text string, lang string, rank int, phrase string").repartition(3)
    got = collocations.collocations(docs, least=5, most=60, **limits)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 5, 60)


def test_tries_that_burst_and_spill_count_right(monkeypatch):
    monkeypatch.setattr(collocations, "CONTAINER", 64)
    monkeypatch.setattr(collocations, "MOST_WORDS", 40)
    rng = random.Random(2)
    texts = [" ".join(f"w{int(rng.paretovariate(1)) % 90}" for _ in range(400)) for _ in range(20)]
    batch = pa.RecordBatch.from_pydict({"lang": ["x"] * len(texts), "text": texts})
    for length in (1, 2, 3):
        want = collections.Counter(" ".join(t.split()[i:i + length]) for t in texts for i in range(401 - length))
        got = collections.Counter()
        for run in collocations.count_phrases(iter([batch]), length, [], most_phrases=300, batch_words=1000):
            for phrase, n in zip(run.column("phrase").to_pylist(), run.column("n").to_pylist()):
                got[phrase] += n
        assert got.pop("", sum(want.values())) == sum(want.values())
        assert got == want


def test_collocations_of_nothing(spark):
    assert collocations.collocations(documents(spark, [])).count() == 0
    assert collocations.collocations(documents(spark, [(1, None), (2, " ")])).count() == 0


def test_a_bit_filter_holds_what_went_in(spark):
    rng = np.random.default_rng(1)
    hashes = rng.integers(-2**63, 2**63, 5000, dtype=np.int64)
    words = common.bit_filter(spark.createDataFrame([(int(h),) for h in hashes], "hash bigint"))
    assert common.may_hold(words, hashes.view(np.uint64)).all()
    assert common.may_hold(words, rng.integers(0, 2**64, 5000, dtype=np.uint64)).mean() < 0.01


# -------------------------------------------------------------- Jaccard join

def plain_join(rows):
    sets = []
    for _, t in rows:
        w = words_of(lower_az(t))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def similar_rows():
    rng = random.Random(8)
    out = []
    for group in range(25):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 6, 9, 14, 30, 60, 150, 400]))]
        for _ in range(rng.choice([1, 2, 4, 9])):
            w = list(base)
            for _ in range(rng.randrange(1 + len(w) // 25)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(9)}"
            out.append((1000 - len(out), " ".join(w[rng.randrange(2):])))
    passage = " ".join(f"p{i}" for i in range(30))
    return out + [(2000 + i, f"{passage} {' '.join(f'q{rng.randrange(60)}' for _ in range(20))}") for i in range(30)]


@pytest.mark.parametrize("block", [2000, 3])
def test_jaccard_join_finds_all_links(spark, block):
    rows = [*ODD, *similar_rows()]
    got = jaccard.jaccard_components(documents(spark, rows), block=block)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_join(rows)


def test_jaccard_join_of_nothing(spark):
    assert jaccard.jaccard_components(documents(spark, [])).count() == 0


def test_linked_sets_share_a_signature():
    rng, bands = np.random.default_rng(4), jaccard.Bands(80)
    for _ in range(1500):
        a = np.unique(rng.integers(0, 2**64, rng.choice([1, 2, 4, 5, 7, 10, 25, 80, 300]), dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.integers(0, len(a) // 5 + 1):], rng.integers(0, 2**64, rng.integers(0, len(a) // 4 + 1), dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(np.intersect1d(bands.signatures(a), bands.signatures(b)))
            counts = [np.frombuffer(jaccard.counters(x), np.uint8)[None, :] for x in (a, b)]
            assert jaccard.may_link(np.array([len(a)]), counts[0], np.array([len(b)]), counts[1], 80).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), max_size=14), st.lists(st.integers(0, 14), max_size=4))
def test_stars_whatever_the_batches(rows, cuts):
    rows = sorted(rows)
    edges = [0, *sorted(min(c, len(rows)) for c in cuts), len(rows)]
    batches = [pa.RecordBatch.from_pydict({"sig": pa.array([s for s, _ in rows[a:b]], pa.int64()), "key": pa.array([k for _, k in rows[a:b]], pa.int64())})
               for a, b in zip(edges, edges[1:])]
    got = [row for out in jaccard.star_rows(iter(batches)) for row in zip(*(c.to_pylist() for c in out.columns))]
    keys = collections.defaultdict(set)
    for s, k in rows:
        keys[s].add(k)
    assert got == [(s, min(ks), k, len(ks) > 2) for s, ks in sorted(keys.items()) for k in sorted(ks)[len(ks) < 3:]]


def test_identifiers_have_streams_of_their_own():
    ids = [None, 0, 1, -1, -2, 5, 5 + 2**61 - 1, 2**63 - 1, -2**63]
    assert len({sampling.row_key(s, i) for s in (0, 1) for i in ids}) == 2 * len(ids)
    assert sampling.row_key(3, 7) == sampling.row_key(3, 7)
