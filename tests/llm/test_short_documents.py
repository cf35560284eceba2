"""Packing of very short and very long documents."""

import zlib
from collections import defaultdict

import numpy as np

from shockwell.llm import packing
from tests.llm.helpers import documents


def sequences_of(pieces):
    found = defaultdict(list)
    for p in pieces:
        found[p.sequence_id].append(p)
    for own in found.values():
        end = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == end and p.length == len(p.ids) // 4 and p.ids_crc32 == zlib.crc32(p.ids)
            end += p.length
        yield end


def test_short_documents_leave_no_padding(spark):
    docs = documents(spark, [(i, "ab cd") for i in range(6000)] + [(-1, None), (-2, "")]).coalesce(1)
    pieces = packing.pack_documents(docs).collect()
    lengths = list(sequences_of(pieces))
    assert sum(lengths) == sum(p.doc_tokens for p in pieces if p.start == 0)
    assert all(n == 2048 or n & n - 1 == 0 for n in lengths)
    assert sum(n < 2048 for n in lengths) <= 11
    assert len({p.doc_id for p in pieces}) == 6002


def test_a_very_long_document_is_cut_without_copies(spark):
    pieces = packing.pack_documents(documents(spark, [(1, "word " * 400_000), (2, "end")]).coalesce(1)).collect()
    own = sorted((p for p in pieces if p.doc_id == 1), key=lambda p: p.start)
    assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
    assert sum(p.length for p in own) == own[0].doc_tokens > 400_000
    assert all(n == 2048 or n & n - 1 == 0 for n in sequences_of(pieces))


def test_pieces_are_handed_on_some_at_a_time():
    rows = [(1, 0, 100_000, 0, 300_000, k, 0, b"") for k in range(7)]
    assert [b.num_rows for b in packing.in_batches(iter(rows))] == [3, 3, 1]
    assert list(packing.in_batches(iter([]))) == []
