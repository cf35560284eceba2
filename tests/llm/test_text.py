"""Personal data, toxicity, quality."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from shockwell.llm import pii, quality, toxicity
from tests.llm.helpers import ODD, documents, pii_spans, quality_counts

TRICKY = [
    "a@b.c_d@e.f x a@b..c@d.e 1.2.3.4.5 256.1.1.1 001.02.3.255 1.2.3.4.5.6.7.8.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1111- 5 4111111111111111 4 +1 (988) 555-2485. + 12 +44.20 7946 0958",
    "é€😀 x@y.zé 4111 1111 1111 1112 9.9.9.9 +49 30 901820000é", "1" * 5000 + ".2.3.4 " + "a" * 30000 + " " + "1 " * 3000 + "@",
    "...@a.b %@-.- a@b.c.d.e, 0000.0.0.0 1.1.1.0256 1.1.1.00255 @a.b a@ a@b a@b. a@.c", "+1+2 (3) 4.5-6 7 8 9 0 1 2 3 4 5 6 7",
]


def test_fixed_kinds_against_brute_force(spark):
    random.seed(1)
    rows = ODD + [(100 + k, t) for k, t in enumerate(TRICKY)] + [
        (200 + k, "".join(random.choices("aB1.@+-() 9é\n%_", k=random.randint(0, 120)))) for k in range(150)]
    got = pii.digest(pii.find_pii(documents(spark, rows)))
    want = []
    for i, t in rows:
        spans = pii_spans(t)
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        counts = tuple(sum(s[3] == k for s in spans) for k in pii.KINDS)
        want.append((i, *counts, hashlib.sha256(text.encode()).hexdigest()))
    found = got.collect()
    assert sorted((tuple(r)[:6] for r in found), key=str) == sorted(want, key=str)
    assert all(r.spans == "" for r in found if r.doc_id in (1, 3, 8))
    assert pii.digest(pii.find_pii(documents(spark, []))).count() == 0


def test_contexts_find_identifiers_of_another_form(spark):
    rows = [(k, f"note {k} call phone: +1 (988) 555-24{k:02d} now") for k in range(12)]
    rows += [(50, "some text phone: 988-555-1234 end"), (51, "the price: 988-555-9999 end"), (52, None)]
    rows += [(60 + k, f"ref: 77-88-{k}{k}{k} and ref: +1 (988) 555-30{k:02d}") for k in range(9)]
    spans = {r.doc_id: r.spans for r in pii.digest(pii.find_pii(documents(spark, rows))).collect()}
    assert spans[50] == "context-phone:17:29"  # the pattern "phone:" is learnt from the twelve
    assert spans[51] == ""  # nothing trusted stands behind "price:"
    assert spans[60] == "phone:24:41"  # half of what stands behind "ref:" is no phone, so it is not trusted
    assert spans[3].startswith("phone:")


def test_long_runs_are_candidates(spark):
    keys = ["key-" + "x9" * 98 + tail for tail in ("", "0", "01")]  # 200, 201 and 202 characters
    keys += ["key-" + "7" + "x" * 30000 + "7" * 20, "key-77" + "x" * 30000]
    rows = [(k, f"note {k} mail box: user{k}@example.org now") for k in range(20)]
    rows += [(50 + k, f"some mail box: {key} end") for k, key in enumerate(keys)]
    docs = documents(spark, rows)
    spans = {r.doc_id: r.spans for r in pii.digest(pii.find_pii(docs)).collect()}
    assert [spans[50 + k] for k in range(4)] == [f"context-email:15:{15 + len(key)}" for key in keys[:4]]
    assert spans[54] == ""  # two digits are too few, whatever the length
    found = pii.find_pii(docs, carry=True)
    out = {r.doc_id: r.t for r in found.selectExpr("doc_id", f"{pii.redacted('source.text', 'array_sort(concat(base, found))')} AS t").collect()}
    assert all(out[50 + k] == "some mail box: <EMAIL> end" for k in range(4))


def test_long_instances_are_told_apart_and_met_again(spark):
    rows = [(1, "first box: " + "a1" * 300), (2, "other box: " + "a1" * 300), (3, "third box: " + "a1" * 299 + "b1")]
    docs = documents(spark, rows)
    edges = pii.graph(pii.spans_of(docs.select("doc_id", "text"))).collect()
    assert len(edges) == 5 and len({r.instance for r in edges}) == 2  # "box:" with two instances, the two words before with one each
    assert all(len(r.instance) <= pii.LONG_INSTANCE for r in edges)


def chained(spark):
    """Two chains.  Behind one..four: each word's identifiers are mostly those of the word before, so trust takes
    four hops.  Behind pre and post: the second becomes trusted by growing scores, a round after nothing was new."""
    behind = {"one": [f"a{k}@example.org" for k in range(900)]}
    sizes = {"A": 200, "B": 45, "C": 10, "D": 2}
    ids = {name: [f"{name}-{k:04d}" for k in range(n)] for name, n in sizes.items()}
    behind["one"] += ids["A"]
    behind["two"], behind["three"], behind["four"] = ids["A"] + ids["B"], ids["B"] + ids["C"], ids["C"] + ids["D"]
    low, late = [f"P-{k:04d}" for k in range(20)], [f"Q-{k:04d}" for k in range(7)]
    behind["pre"], behind["post"] = [f"p{k}@example.com" for k in range(70)] + low, low + late
    rows = []
    for word, instances in behind.items():
        for k in range(0, len(instances), 40):
            rows.append((len(rows), " ; ".join(f"the {word}: {i}" for i in instances[k:k + 40])))
    return documents(spark, rows), {word: len(v) for word, v in behind.items()}


def test_scoring_ends_when_nothing_changes(spark):
    docs, sizes = chained(spark)
    rows = pii.find_pii(docs, carry=True).selectExpr("source.text AS text", "base", "found").collect()
    masked = {}
    for r in rows:
        word = r.text.split()[1].rstrip(":")
        masked[word] = masked.get(word, 0) + len(r.base) + len(r.found)
    assert masked == sizes  # every identifier behind every word
    with pytest.raises(RuntimeError, match="still change after 3 rounds"):
        pii.find_pii(docs, rounds=3)


def test_redaction(spark):
    text = "é mail a.b@c.de, ip 10.0.0.1. +4111 1111 1111 1111!"
    found = pii.find_pii(documents(spark, [(1, text), (2, None), (3, "plain")]), carry=True)
    out = {r.doc_id: r.t for r in found.selectExpr("doc_id", f"{pii.redacted('source.text', 'array_sort(concat(base, found))')} AS t").collect()}
    assert out[2] is None and out[3] == "plain"
    assert out[1].startswith("é mail <EMAIL>, ip <IP>. ") and out[1].endswith("!") and "1111" not in out[1]


# ------------------------------------------------------------------- toxicity

ABUSE = ["scumbag", "moronic", "worthless", "pathetic"]


@pytest.fixture(scope="module")
def corpus():
    random.seed(7)
    vocabulary = ["".join(random.choices("abdeghilnorstu", k=random.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for k in range(500):
        words = random.choices(vocabulary, k=60)
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                words[random.randrange(60)] = random.choice(ABUSE)
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


def scored(spark, rows, labels):
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    return {r.doc_id: r for r in toxicity.toxicity(documents(spark, rows), table).collect()}


def test_toxicity_held_out(spark, corpus):
    rows, labels = corpus
    extra = [(9000, "you are a scumbbag and moronc, worthles"), (9001, None), (9002, "")]
    got = scored(spark, rows + extra, labels)
    fold = [(k, y) for k, y in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k].held_out for k, _ in fold) and sum(r.held_out for r in got.values()) >= len(fold)
    assert all(got[k].predicted == y for k, y in fold)
    assert got[9000].predicted == 1  # every hit is misspelt
    assert got[9001].score == got[9002].score < 0.5
    assert all(0 <= r.score <= 1 for r in got.values())
    # the held-out labels are not learned from
    turned = [(k, 1 - y if zlib.crc32(str(k).encode()) % 5 == 0 else y) for k, y in labels] + [(3, None)]
    again = scored(spark, rows + extra, turned)
    assert {k: r.score for k, r in again.items()} == {k: r.score for k, r in got.items()}


def test_toxicity_without_labels_and_odd_rows(spark, corpus):
    got = [tuple(r) for r in toxicity.toxicity(documents(spark, ODD), spark.createDataFrame([], "doc_id bigint, toxic int")).collect()]
    assert len(got) == len(ODD) and all(r[2:] == (0.0, 0) for r in got)
    labels = spark.createDataFrame(corpus[1], "doc_id bigint, toxic int")
    both = documents(spark, ODD + [(k + 50, t) for k, t in corpus[0]])
    assert toxicity.toxicity(both, labels).count() == len(ODD) + 500
    assert toxicity.toxicity(documents(spark, []), labels).count() == 0
    kept = toxicity.without_toxic(documents(spark, corpus[0] + ODD), labels)
    assert kept.schema == documents(spark, []).schema
    assert {r.doc_id for r in kept.collect()} >= {i for i, _ in ODD}


def edits(a, b):
    """Least number of insertions, deletions, substitutions and swaps of neighbours."""
    d = np.arange(len(b) + 1)[None, :] + np.arange(len(a) + 1)[:, None]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[-1, -1]


def test_automaton_against_edit_distance():
    random.seed(9)
    terms = {"".join(random.choices("abc", k=random.randint(3, 6))): float(k) for k in range(30)}
    top = toxicity.trie_of(terms, {})
    for _ in range(400):
        word = "".join(random.choices("abcd", k=random.randint(2, 7)))
        exact = toxicity.exact(top, word)
        assert exact == ((toxicity.WORD, terms[word]) if word in terms else None)
        if exact is None:
            near = [w for t, w in terms.items() if edits(word, t) == 1]
            assert toxicity.one_edit(top, word) == max(near, default=None)


def test_quotation_is_told_from_abuse():
    match = toxicity.Matcher({"moron": 5.0}, {"scum": 4.0})
    abuse, quoted = match.features("you moron , you scumbag moron"), match.features('he wrote "moron" and said the word "moron" there')
    assert abuse[0] > 0 and abuse[3] == 0 and quoted[0] == 0 and quoted[3] > 0
    assert match.features("") == match.features("clean text") == [0.0] * toxicity.FEATURES


# -------------------------------------------------------------------- quality

def test_counts_against_brute_force(spark):
    random.seed(2)
    rows = ODD + [(100 + k, "".join(random.choices(["a", "b", "c", " ", "\n", "#", "\t", "é", "|", "\x0b"], k=random.randint(0, 90)))) for k in range(200)]
    got = quality.quality(documents(spark, rows), spark.createDataFrame([], "doc_id bigint, quality int"))
    want = []
    for i, t in rows:
        counts = quality_counts(t)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        want.append((i, *counts, failed, not failed))
    assert sorted((tuple(r)[:8] for r in got.collect()), key=str) == sorted(want, key=str)
    assert quality.quality(documents(spark, []), spark.createDataFrame([], "doc_id bigint, quality int")).count() == 0


def test_many_distinct_words_do_not_overflow():
    ids = np.arange(3_000_000)
    ids[-3:] = ids[:3]
    assert quality.repeated_words(ids) == 6


def forest_of(seed=0, n=600):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4))
    y = ((x[:, 0] - x[:, 1] + 0.3 * np.sin(9 * x[:, 2]) + 0.2 * rng.standard_normal(n)) > 0).astype(float)
    return quality.fit(x, y, np.array([1, -1, 0, 0]), trees=30), x, y


def test_forest_learns_within_its_constraints():
    forest, x, y = forest_of()
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.9
    rng = np.random.default_rng(1)
    points = rng.random((500, 4))
    for feature, sign in ((0, 1), (1, -1)):
        higher = points.copy()
        higher[:, feature] += rng.random(500)
        assert (sign * (forest.score(higher) - forest.score(points)) >= -1e-12).all()


def test_flat_scoring_equals_a_walk_down_each_tree():
    forest, x, _ = forest_of(3)
    for row, score in zip(x[:50], forest.score(x[:50])):
        total = forest.bias
        for t in range(len(forest.feature)):
            node = 0
            while forest.left[t, node] != node:
                side = forest.left if row[forest.feature[t, node]] <= forest.threshold[t, node] else forest.right
                node = side[t, node]
            total += forest.value[t, node]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_on_held_out_labels(spark):
    random.seed(5)
    words = ["".join(random.choices("aeioulnrst", k=random.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for k in range(400):
        good = k % 3 > 0
        text = random.choices(words, k=80)
        rows.append((k, " ".join(text if good else [w.upper() + "!!" for w in text])))
        labels.append((k, int(good)))
    got = {r.doc_id: r.kept for r in quality.quality(documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()}
    fold = [(k, y) for k, y in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k] == bool(y) for k, y in fold)
