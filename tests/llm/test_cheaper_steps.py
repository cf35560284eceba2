"""Steps that were made cheaper give what the plain ones give."""

import collections

import numpy as np
import pyarrow as pa
import pyarrow.compute

from shockwell.llm import collocations, sampling, tokens

WORDS = [b"a", b"b", b"c", b"dd", b"e"]


def by_hash(rows):
    out = collections.Counter()
    for phrase, n in rows:
        hashes = collocations.word_hashes("en", phrase.split(b" "))
        out[int(collocations.phrase_hashes([h for h in hashes[:, None]])[0])] += n
    return out


def test_pairs_go_as_hashes_first_and_are_counted_with_triples(spark):
    rng = np.random.default_rng(4)
    texts = [b" ".join(WORDS[i] for i in rng.integers(0, 5, 40)) for _ in range(30)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": [t.decode() for t in texts]})
    grams = {k: collections.Counter(b" ".join(w[i:i + k]) for t in texts for w in [t.split()] for i in range(len(w) - k + 1)) for k in (2, 3)}
    rows = spark.createDataFrame([("en", w.decode()) for w in WORDS[:4]], "lang string, phrase string")
    known = {p: n for p, n in grams[2].items() if b"e" not in p}
    words = collocations.filter_of(rows)
    for limits in ({}, {"most_phrases": 5, "batch_words": 50}):
        found = collections.Counter()
        for run in collocations.count_phrases(iter([batch]), 2, [words], hashed=True, **limits):
            for h, n in zip(run.column("hash").to_numpy().view(np.uint64).tolist(), run.column("n").to_pylist()):
                found[h] += n
        assert found == by_hash(known.items())
        kept = [p for p in sorted(known)[:9]]
        pairs = collocations.filter_of(spark.createDataFrame([("en", p.decode()) for p in kept], "lang string, phrase string"))
        found = collections.Counter()
        for run in collocations.count_phrases(iter([batch]), 3, [words, pairs], with_shorter=True, **limits):
            for phrase, n in zip(run.column("phrase").to_pylist(), run.column("n").to_pylist()):
                found[phrase.encode()] += n
        triples = {p: n for p, n in grams[3].items() if p.rsplit(b" ", 1)[0] in kept and p.split(b" ", 1)[1] in kept}
        assert found == {**triples, **{p: grams[2][p] for p in kept}}


def test_words_are_hashed_where_they_stand_in_the_text():
    words = [b"a", "é".encode(), b"\0", b"\0\0", b"x" * 4096, b"x" * 4097, b"x" * 300_000, b"y", "日本".encode()] + [b"w%d" % i for i in range(50_000)]
    text = b" .\t" + b" . ".join(b"  ".join(words[i:i + 3]) for i in range(0, len(words), 3)) + b"."
    firsts, lasts, pieces = collocations.word_places(text)
    assert [text[a:b] for a, b in zip(firsts, lasts)] == words
    assert (np.diff(pieces) > 0).tolist() == [i % 3 == 0 for i in range(1, len(words))]
    hashes = collocations.hashes_at(text, firsts, lasts, collocations.language_seed("en"))
    assert hashes.tolist() == collocations.word_hashes("en", words).tolist()
    assert len(set(hashes.tolist()) | set(collocations.word_hashes("de", words).tolist())) == 2 * len(words)


def test_pair_hashes_leave_a_task_as_a_row_for_each_range(spark):
    texts = [" ".join(f"w{(i * j) % 97}" for i in range(300)) for j in range(1, 60)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    run, = collocations.count_phrases(iter([batch]), 2, [], hashed=True)
    assert run.num_rows > 2 << collocations.RANGE_BITS
    packed = collocations.ranges(run)
    assert packed.num_rows <= 1 << collocations.RANGE_BITS
    both = pa.Table.from_batches([packed, packed])
    n = dict(zip(run.column("hash").to_pylist(), run.column("n").to_pylist()))
    assert sum(n.values()) == 299 * 59
    for least in (1, 7):
        found = []
        for part in set(packed.column("part").to_pylist()):
            rows = both.filter(pa.compute.equal(both.column("part"), part))
            found += collocations.frequent_hashes(rows, least).column("hash").to_pylist()
        assert sorted(found) == sorted(h for h in n if 2 * n[h] >= least)
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(4)
    rows = collocations.counted_runs(docs, 2, [], hashed=True).collect()
    assert len(rows) <= 4 << collocations.RANGE_BITS


def test_only_words_of_phrases_that_may_be_frequent_get_numbers(spark):
    rows = [spark.createDataFrame([("en", p) for p in phrases], "lang string, phrase string") for phrases in (["a", "b", "c", "d"], ["a b"])]
    trie = collocations.Trie("en", 3, [collocations.filter_of(r) for r in rows], with_shorter=True)
    text = b"a b c rare a b d . a . b ."
    firsts, lasts, pieces = collocations.word_places(text)
    tokens = text.replace(b".", b" ").split()
    trie.add(tokens, pieces, collocations.hashes_at(text, firsts, lasts, collocations.language_seed("en")), len(tokens))
    assert list(trie.words) == [b"a", b"b"]
    found = [(p, n) for run in trie.everything() for p, n in zip(run.column("phrase").to_pylist(), run.column("n").to_pylist())]
    assert found == [("a b", 2)]


def test_single_draws_are_those_of_arrays():
    search = sampling.Search.__new__(sampling.Search)
    for key in (np.uint64(0), np.uint64(2**64 - 1), np.uint64(0x123456789ABCDEF)):
        search.key = key
        for number in (0, 1, 7, 1000):
            counter = np.array([int(key)], dtype=np.uint64) + sampling.offset(sampling.OWN, number)
            assert search.scalar(number) == float(sampling.uniform(counter)[0])


def test_units_of_many_texts_are_those_of_each():
    pieces = sampling.sampler(sampling.default_path()).pieces
    texts = ["▁the▁cat", "", "▁", "▁日本▁x", "", "a" * 50, "▁é\n\n▁b"]
    units, counts = pieces.units(texts)
    assert "".join(units) == "".join(texts) and all(units)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert units[at:at + n] == pieces.units([text])[0] and "".join(units[at:at + n]) == text
        at += n


def test_pieces_are_spelt_together():
    assert tokens.SPELT_BETWEEN not in "".join(tokens.SPELT[b] for c in range(256) for b in chr(c).encode())
    bpe = tokens.ByteBpe(tokens.default_path())
    pieces = [" a", "é", "\n\n", "x\0y", "ÄĊ"[:1], "..", " ²"]
    assert list(bpe.new_pieces(pieces)) == [next(iter(bpe.new_pieces([p]))) for p in pieces]
    texts = [" a  b\n c", "it's  'S 's\x85\xa0", "²³ 1²a", " \t x ", "\r\n\x0b\x0c .,;"]
    whole = bpe.library.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in bpe.encode(texts)] == [e.ids for e in whole]
