"""Encoding, packing, binary files, counts, sampled segmentations, shards."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shockwell.llm import ans, packing, sampling, sharding, token_counts, tokens
from tests.llm.helpers import ODD, documents, ids_of, library


@pytest.fixture(scope="module")
def bpe():
    return tokens.ByteBpe(tokens.default_path())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(max_codepoint=0xFF), st.sampled_from(" \n'strevmld\u0085  €日\U0001f600")), max_size=40), max_size=5))
def test_pieces_give_the_librarys_ids(texts):
    whole = library().encode_batch(texts, add_special_tokens=False)
    assert tokens.encoder(tokens.default_path()).encode(texts) == [np.array(e.ids, dtype="<u4").tobytes() for e in whole]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(" \n\tab.'s1\xa0"), max_size=30))
def test_blanks_of_all_kinds(text):
    whole = library().encode(text, add_special_tokens=False)
    assert tokens.encoder(tokens.default_path()).encode([text]) == [np.array(whole.ids, dtype="<u4").tobytes()]


def test_memory_of_pieces_is_bounded(bpe, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 20)
    texts = [" ".join(f"w{k}{j}" for j in range(15)) for k in range(20)] + ["<|endoftext|> it's", ""]
    for text, ids in zip(texts * 2, ids_of(texts * 2)):
        assert bpe.encode([text]) == [ids]
        assert len(bpe.memo) <= 20 + 30 and len(bpe.older) <= 20 + 30


END = "<|endoftext|>"
HOLDING_END = [(1, f"a {END} b"), (2, END), (3, f"é {END}{END}\n it's"), (4, f"日本 {END} €"), (5, "a <|endoftext b |>"), (6, "plain"), (7, None)]


def unchanged_ids(texts, end):
    """Ids by the library as it comes from the file, nothing set."""
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array(e.ids + [end], dtype="<u4").tobytes() for e in found]


def test_special_tokens_in_texts_as_the_unchanged_library_has_them(spark):
    docs = documents(spark, HOLDING_END).coalesce(1)
    texts = [t for _, t in HOLDING_END]
    assert unchanged_ids(["a <|endoftext|> b"], 0) == [np.array([64, 220, 50256, 275, 0], dtype="<u4").tobytes()]
    want = dict(zip((i for i, _ in HOLDING_END), unchanged_ids(texts, 1)))
    pieces = collections.defaultdict(bytes)
    for r in sorted(packing.pack_documents(docs).collect(), key=lambda r: r.start):
        assert r.doc_tokens == len(want[r.doc_id]) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        assert r.start == len(pieces[r.doc_id]) // 4
        pieces[r.doc_id] += bytes(r.ids)
    assert pieces == want
    files = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in ans.round_trip(docs).collect()}
    assert files == {i: (len(x) // 4, zlib.crc32(x)) for (i, _), x in zip(HOLDING_END, unchanged_ids(texts, 0))}
    # in flat files the same id separates documents, so there the content stays text
    counted = {r.doc_id: r.n_tokens for r in token_counts.counted_documents(docs).collect()}
    assert counted == {i: len(x) // 4 for (i, _), x in zip(HOLDING_END, ids_of(texts))}


def test_added_tokens_that_are_not_special_are_always_found(tmp_path):
    from tokenizers import AddedToken

    changed = library()
    changed.add_tokens([AddedToken("<tab>", normalized=False)])
    path = str(tmp_path / "with_tab.json")
    changed.save(path)
    for flag in (False, True):
        changed.encode_special_tokens = flag
        texts = [f"a <tab> {END} b", "a<tab>", END, "a"]
        whole = changed.encode_batch(texts, add_special_tokens=False)
        assert tokens.ByteBpe(path).encode(texts, flag) == [np.array(e.ids, dtype="<u4").tobytes() for e in whole]


# -------------------------------------------------------------------- packing

def check_sequences(rows, limits):
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(pieces) <= limits.segments
    return {s: sum(r.length for r in p) for s, p in by_sequence.items()}


@pytest.mark.parametrize("limits", [packing.DOCUMENT_LIMITS, packing.Limits(tokens=64, segments=3), packing.Limits(tokens=64, loss_tokens=48)])
def test_documents_are_packed_whole_and_gapless(spark, limits):
    random.seed(1)
    rows = ODD + [(100 + k, " ".join(random.choices(["alpha", "beta", "gamma"], k=random.randint(0, 60)))) for k in range(80)]
    got = packing.pack_documents(documents(spark, rows).coalesce(1), limits).collect()
    lengths = check_sequences(got, limits)
    pieces = collections.defaultdict(list)
    for r in got:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        pieces[r.doc_id, r.doc_tokens].append(r)
    want = collections.defaultdict(list)
    for (i, _), x in zip(rows, ids_of([t for _, t in rows], end=1)):
        want[i, len(x) // 4].append(x)
    assert pieces.keys() == want.keys()
    for key, rs in pieces.items():
        if len(want[key]) == 1:
            assert b"".join(bytes(r.ids) for r in sorted(rs, key=lambda r: r.start)) == want[key][0]
        assert sum(r.length for r in rs) == sum(len(x) // 4 for x in want[key])
    if limits == packing.DOCUMENT_LIMITS:  # only the last sequence is padded, all others are full or a power of two
        assert sum(n & (n - 1) != 0 for n in lengths.values()) <= 1
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_examples_stay_whole_within_three_limits(spark):
    random.seed(2)
    limits = packing.Limits(tokens=100, segments=4, loss_tokens=40)
    rows = [(k, random.randint(0, 60), random.randint(0, 30)) for k in range(300)] + [(900, 101, 1), (901, 10, 41), (None, None, None)]
    got = packing.pack_examples(spark.createDataFrame(rows, "doc_id bigint, n_tokens int, n_loss_tokens int").coalesce(1), limits).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if not r.fits} == {900, 901}
    by_sequence = collections.defaultdict(list)
    for r in got:
        if r.fits:
            by_sequence[r.sequence_id].append(r)
    for rs in by_sequence.values():
        assert sum(r.n_tokens for r in rs) <= 100 and len(rs) <= 4 and sum(r.n_loss_tokens for r in rs) <= 40
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(x.n_tokens for x in rs[:k]) for k in range(len(rs))] or len({r.offset for r in rs}) < len(rs)
    needed = max(sum(r.n_tokens for r in got if r.fits) / 100, sum(r.n_loss_tokens for r in got if r.fits) / 40, 301 / 4)
    assert len(by_sequence) <= 1.15 * needed + 1


def test_powers_of_two():
    assert packing.powers_of_two(1500, 16) == [1024, 256, 128, 64, 16, 12]
    assert packing.powers_of_two(16, 16) == [16] and packing.powers_of_two(5, 16) == [5] and packing.powers_of_two(0, 16) == []


# ---------------------------------------------------------------- binary files

@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.sampled_from([1, 3, 8, 64]), st.sampled_from([1, 2, 5]))
def test_blocks_round_trip(ids, lanes, steps):
    ids = np.array(ids, dtype=np.uint32)
    table = ans.Table.of(np.bincount(ids, minlength=301), bits=12)
    if len(ids):
        assert table.frequency.sum() == 1 << 12 and (table.frequency[ids] > 0).all()
    payload = ans.encode(ids, table, lanes, steps)
    block = ans.Block(payload, table)
    assert (block.ids() == ids).all()
    span = block.steps * block.lanes
    for k in reversed(range(block.checkpoints)):  # parts are decoded apart from each other
        assert (block.part(k) == ids[k * span:(k + 1) * span]).all()


def test_damage_is_noticed():
    ids = np.arange(2000, dtype=np.uint32) % 97
    table = ans.Table.of(np.bincount(ids), bits=12)
    payload = bytearray(ans.encode(ids, table, 16))
    payload[-3] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        ans.Block(bytes(payload), table)
    with pytest.raises(ValueError, match="another table"):
        ans.Block(ans.encode(ids, table, 16), ans.Table.of(np.bincount(ids) + 1, bits=12))
    with pytest.raises(ValueError, match="no slot"):
        ans.encode(np.array([96, 5]), ans.Table.of(np.array([1, 0, 0, 0, 0, 1] + [1] * 91) * (np.arange(97) != 5), bits=12))


def test_token_files_keep_ids_places_and_order(spark, tmp_path):
    rows = ODD + [(100 + k, f"text number {k} " * (k % 5)) for k in range(40)]
    got = [tuple(r) for r in ans.round_trip(documents(spark, rows).repartition(3)).collect()]
    order = sorted(got, key=lambda r: r[1])
    assert [r[0] is not None for r in order] == sorted(r[0] is not None for r in order)  # null identifiers first
    known = [r[0] for r in order if r[0] is not None]
    assert known == sorted(known)
    assert [r[1] for r in order] == [sum(x[2] for x in order[:k]) for k in range(len(order))]
    want = collections.Counter((i, len(x) // 4, zlib.crc32(x)) for (i, _), x in zip(rows, ids_of([t for _, t in rows], end=0)))
    assert collections.Counter((r[0], r[2], r[3]) for r in got) == want
    assert ans.round_trip(documents(spark, [])).count() == 0
    path = str(tmp_path / "files")
    table = ans.write_tokens(documents(spark, rows), path, block_ids=50)
    assert ans.read_table(spark, f"{path}/table").id == table.id
    blocks = ans.read_tokens(spark, path).collect()
    assert len(blocks) > 5 and sum(len(b.payload) // 4 for b in blocks) == sum(k[1] * n for k, n in want.items())


# ---------------------------------------------------------------------- counts

def test_separator_scan_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN_BLOCKS", 4)
    rng = np.random.default_rng(0)
    rows, want = [], set()
    for name, (n, share, size) in {"a": (1000, 0.1, 7), "b": (500, 0.002, 9), "c": (300, 0.6, 3), "d": (0, 0.1, 5), "e": (200, 0, 6), "f": (1, 1, 4)}.items():
        ids = np.where(rng.random(n) < share, 9, rng.integers(0, 9, n)).astype("<u2")
        if name == "a":
            ids[-1] = 9
        rows += [(name, k, ids[k * size:(k + 1) * size].tobytes()) for k in range(max(1, -(-n // size)))]
        start = ordinal = 0
        for place in np.flatnonzero(ids == 9).tolist():
            want.add((name, ordinal, start, place - start, True))
            start, ordinal = place + 1, ordinal + 1
        if start < n:
            want.add((name, ordinal, start, n - start, False))
    got = token_counts.count_tokens(spark.createDataFrame(rows, "file string, block bigint, data binary"), 9)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(want) and set(found) == want


def test_counted_documents(spark):
    got = token_counts.counted_documents(documents(spark, ODD).repartition(2), block_ids=37)
    found = collections.Counter((r.doc_id, r.n_tokens, r.terminated) for r in got.collect())
    assert found == collections.Counter((i, len(x) // 4, True) for (i, _), x in zip(ODD, ids_of([t for _, t in ODD])))
    assert token_counts.counted_documents(documents(spark, [])).count() == 0


# -------------------------------------------------------------------- sampling

@pytest.fixture(scope="module")
def sampler():
    return sampling.sampler(sampling.default_path())


def all_segmentations(sampler, text):
    """Every segmentation by plain recursion over the model's pieces, with its probability."""
    pieces, whole = sampler.pieces, sampling.MARK + text.replace(" ", sampling.MARK)
    by_text = {}
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sampling.default_path())
    for i in range(model.vocab_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            by_text[model.id_to_piece(i)] = i
    out = {}

    def extend(at, ids, weight):
        if at == len(whole):
            out[tuple(ids)] = weight
            return
        for end in range(at + 1, len(whole) + 1):
            i = by_text.get(whole[at:end])
            if i is not None:
                extend(end, ids + [i], weight + pieces.weight[i])
        if whole[at] not in by_text:
            spelt = [pieces.byte_id[b] for b in whole[at].encode()]
            extend(at + 1, ids + spelt, weight + pieces.weight[spelt].sum())

    extend(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: math.exp(v - total) for k, v in out.items()}


def test_samples_follow_the_law_of_drawing_without_replacement(sampler):
    text = "ab hat\n"
    p = all_segmentations(sampler, text)
    n, first, second = 6000, collections.Counter(), collections.Counter()
    for samples, threshold in sampler.sample([text] * n, 2, list(range(n))):
        a, b = (tuple(ids.tolist()) for _, ids in samples)
        first[a] += 1
        second[a, b] += 1
        assert a != b and samples[0][0].value >= samples[1][0].value >= threshold
        assert math.exp(samples[0][0].log_prob) == pytest.approx(p[a])
    assert max(abs(first[k] / n - v) for k, v in p.items()) < 0.025
    assert max(abs(second[a, b] / n - p[a] * p[b] / (1 - p[a])) for a in p for b in p if a != b) < 0.025


def test_all_segmentations_come_out_when_asked_for(sampler):
    p = all_segmentations(sampler, "then é\t")
    (samples, threshold), = sampler.sample(["then é\t"], len(p) + 3, [1])
    assert {tuple(ids.tolist()) for _, ids in samples} == set(p) and len(samples) == len(p) and threshold == -math.inf
    assert sampling.log_inclusion(samples[0][0].log_prob, threshold) == 0.0


def test_segmentations_of_odd_rows(spark, sampler):
    docs = documents(spark, ODD)
    got = sampling.sample_segmentations(docs, k=3)
    rows = got.collect()
    per_text = collections.Counter((r.doc_id, r.sample) for r in rows)
    assert all(r.restored for r in rows)
    assert per_text[1, 1] == 2 and per_text[1, 2] == 0 and per_text[6, 3] == 1  # the empty text has one segmentation
    assert all(r.log_inclusion <= 0 and len(r.ids) == 4 * r.n_pieces for r in rows)
    back = {(r.doc_id, r.text) for r in sampling.decode_ids(got).collect()}
    assert back == {(i, t or "") for i, t in ODD}
    # a row's draws do not depend on the rows around it
    alone = sampling.sample_segmentations(docs.filter("doc_id = 10"), k=3).collect()
    assert [tuple(r) for r in alone] == [tuple(r) for r in rows if r.doc_id == 10]
    assert sampling.sample_segmentations(documents(spark, [])).count() == 0


# ----------------------------------------------------------------------- shards

def shards_of(rows, shards):
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by_shard.values())
    assert set(by_shard) <= set(range(shards))
    return {s: sum(r.size for r in rs) for s, rs in by_shard.items()}


def test_shards_by_bytes_are_even_and_hot_identifiers_are_split(spark):
    random.seed(3)
    rows = [(k, "x" * random.randint(0, 300)) for k in range(3000)] + [(77, "hot " * 20)] * 1500 + ODD[:4]
    got = sharding.shard(documents(spark, rows).repartition(3), shards=8).collect()
    loads = shards_of(got, 8)
    assert max(loads.values()) - min(loads.values()) <= 0.02 * sum(loads.values()) / 8
    assert all(r.grown_shard is None and r.law == "bytes" for r in got)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sharding.shard(documents(spark, [])).count() == 0


def test_shards_by_key_depend_on_key_and_number_alone(spark):
    rows = [(k, "t" * (k % 9)) for k in range(2000)]
    some = sharding.shard(documents(spark, rows[:700] + ODD), law="key").collect()
    whole = {r.doc_id: r for r in sharding.shard(documents(spark, rows), law="key").collect()}
    shards_of(whole.values(), 16)
    assert all(whole[r.doc_id].shard == r.shard for r in some if r.doc_id is not None and 0 <= r.doc_id < 700 and r.size < 12)
    moved = [r for r in whole.values() if r.grown_shard != r.shard]
    assert moved and all(r.grown_shard == 16 for r in moved) and len(moved) < 2000 / 10
    more = {r.doc_id: r.shard for r in sharding.shard(documents(spark, rows), shards=17, law="key").collect()}
    assert more == {i: r.grown_shard for i, r in whole.items()}


def test_edits_of_the_map_are_few():
    load = {(s, -1): 100 + s % 7 for s in range(512)}
    first = {u: u[0] % 8 for u in load}
    load[3, -1] += 900
    even = sharding.even_out(first, load, 8)
    totals = [sum(load[u] for u in load if even[u] == s) for s in range(8)]
    assert max(totals) - min(totals) <= 3
    assert sum(even[u] != first[u] for u in load) < 60
