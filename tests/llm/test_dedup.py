import collections
import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from shockwell.llm import exact_dedup, simhash
from shockwell.plans.storage import settled
from tests.llm.helpers import ODD, components, documents, lower_az, simhash as plain_simhash


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=8).map(lambda b: bytes(c % 3 + 97 for c in b)), max_size=40), st.integers(0, 400))
def test_trie_owns_every_text_once_whatever_it_spills(texts, limit):
    trie, seen = exact_dedup.Patricia(), []
    for k, text in enumerate(texts):
        trie.put(text, exact_dedup.rank(k % 7, k, True), 1, k)
        if trie.size > limit:
            seen += trie.spill(limit // 2)
    seen += trie.rest()
    rows = collections.Counter()
    best = {}
    for text, (rank, n, extra) in seen:
        rows[text] += n
        best[text] = max(best.get(text, (rank, extra)), (rank, extra))
    assert rows == collections.Counter(texts)
    for text, (rank, extra) in best.items():
        own = [k for k, t in enumerate(texts) if t == text]
        assert extra == max(own, key=lambda k: (k % 7, -k))
    if limit > 10_000:
        assert len(seen) == len(rows)


def expected_groups(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[lower_az(t)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, digest))
            first = first and i != keep
    return sorted(out, key=str)


def test_exact_dedup_of_odd_rows(spark):
    random.seed(3)
    rows = ODD + [(100 + k, random.choice(["a", "A", "ab", "aB", "abc", "b"])) for k in range(60)]
    for trie_bytes, parts in ((1 << 20, 1), (300, 5)):
        docs = documents(spark, rows).repartition(parts) if parts > 1 else documents(spark, rows).coalesce(1)
        got = exact_dedup.exact_dedup(docs, trie_bytes=trie_bytes)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected_groups(rows)
    least = exact_dedup.exact_dedup(documents(spark, rows), keep="smallest").filter("doc_id = 4").first()
    assert least.keep_id == -7
    assert exact_dedup.exact_dedup(documents(spark, [])).count() == 0


def test_fingerprints(spark):
    random.seed(4)
    texts = [t for _, t in ODD if t is None or len(t) < 500] + [" ".join(random.choices(["Ab", "cd", "é", "xyz"], k=k)) for k in range(40)]
    for t in texts:
        assert simhash.fingerprint((t or "").encode()) == plain_simhash(t)


def dense_values(seed, n):
    random.seed(seed)
    base, found = random.getrandbits(64), {0}
    while len(found) < n:
        x = base
        for _ in range(random.randint(0, 5)):
            x ^= 1 << random.choice([1, 3, 7, 12, 20, 33, 40, 41, 50, 63])
        found.add(x ^ (1 << random.randrange(64)) if random.random() < 0.3 else x)
    return sorted(found)


def test_all_links_are_found_crowded_or_not(spark):
    values = dense_values(1, 250)
    classes = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    for distance in (1, 3):
        want = {tuple(sorted((signed(a), signed(b)))) for k, a in enumerate(values) for b in values[k + 1:]
                if bin(a ^ b).count("1") <= distance}
        for crowded in (1000, 20, 0):
            assert {tuple(r) for r in simhash.links(classes, distance, crowded).collect()} == want


def inner_joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Join")[0].strip("+-: ") for line in plan.splitlines() if "Join " in line and ", Inner," in line]


def test_keys_of_classes_are_never_broadcast(spark):
    # Every class has 34 keys, which Spark sizes as one row: the driver's memory is no place for them.
    classes = settled(spark.createDataFrame([(signed(v),) for v in dense_values(1, 250)], "fp bigint"))
    assert inner_joins(simhash.links(classes)) == ["SortMerge"]
    assert inner_joins(simhash.links(classes, crowded=20)) == ["SortMerge", "SortMerge"]


def test_components_of_chains_and_stars(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (203, 202), (202, 201)]
    random.seed(2)
    random.shuffle(pairs)
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}, **{k: 200 for k in range(200, 204)}}
    assert simhash.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates_against_brute_force(spark):
    random.seed(5)
    vocabulary = [f"w{k}" for k in range(50)]
    base = [random.choices(vocabulary, k=120) for _ in range(6)]
    rows = [r for r in ODD if r[1] is None or len(r[1]) < 500]
    for k in range(60):
        words = list(random.choice(base))
        for _ in range(random.randint(0, 2)):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        rows.append((1000 - k, " ".join(words)))
    root = components([plain_simhash(t) for _, t in rows])
    members = collections.defaultdict(list)
    for i, t in rows:
        members[root[plain_simhash(t)]].append(i)
    name = {c: min((i for i in ids if i is not None), default=None) for c, ids in members.items()}
    want = sorted(((i, f"{plain_simhash(t):016x}", name[root[plain_simhash(t)]]) for i, t in rows), key=str)
    got = simhash.near_duplicates(documents(spark, rows))
    assert sorted((tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()), key=str) == want
    assert got.filter("kept").count() == len(members)
    assert len(members) < len({plain_simhash(t) for _, t in rows})
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
