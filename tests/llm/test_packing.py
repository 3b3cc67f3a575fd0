import zlib
from collections import defaultdict

import numpy as np
import pytest

from clickweave.llm.packing import WordIds, pack_documents, shortest_pack_first
from clickweave.llm.queries import tokenizer_path

from .helpers import AWKWARD, awkward, empty

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check_sequences(rows, max_tokens):
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= max_tokens
    return by_seq


def test_word_cache_equals_the_tokenizer(tokenizer):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    words = WordIds(tokenizer_path())

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(st.text(max_size=60), st.text(alphabet="aAzZ éÉçß'’.,-!?%$09<|>\t\n\x0b\xa0 endoftxst", max_size=60)))
    def same(text):
        assert np.frombuffer(words.encode(text), "<u4").tolist() == ids_of(tokenizer, text)[:-1]

    same()
    for row in AWKWARD:
        assert np.frombuffer(words.encode(row[1] or ""), "<u4").tolist() == ids_of(tokenizer, row[1])[:-1]


def test_pieces_rebuild_every_document(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = pack_documents(docs, tokenizer_path()).collect()
    pieces = defaultdict(dict)
    for r in rows:
        pieces[r.doc_id][r.start] = r
    for d in docs.collect():
        ids, at = ids_of(tokenizer, d.text), 0
        while at < len(ids):
            r = pieces[d.doc_id].pop(at)
            cut = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(cut) and r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids) and not pieces[d.doc_id]
    seqs = check_sequences(rows, 2048)
    total = sum(r.length for r in rows)
    assert total / (2048 * len(seqs)) > 0.97


def test_awkward_rows(spark, tokenizer):
    docs = awkward(spark).selectExpr("*", "1 as length", "2 as bucket", "3 as `rank`")
    rows = pack_documents(docs, tokenizer_path(), max_tokens=64, rank_buckets=3).collect()
    check_sequences(rows, 64)
    want = sorted((str(r[0]), len(ids_of(tokenizer, r[1]))) for r in AWKWARD)
    assert sorted((str(r.doc_id), r.doc_tokens) for r in rows if r.start == 0) == want
    assert sum(r.length for r in rows) == sum(n for _, n in want)
    assert pack_documents(empty(spark), tokenizer_path()).count() == 0


def test_histogram_packing():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=200, deadline=None)
    @given(st.dictionaries(st.integers(1, 16), st.integers(1, 50), max_size=10))
    def whole(histogram):
        steps = shortest_pack_first(histogram, 16)
        used, ranks = defaultdict(int), defaultdict(set)
        for length, rank, n, first, offset in steps:
            for i in range(n):
                assert used[first + i] == offset
                used[first + i] += length
                assert used[first + i] <= 16 and rank + i not in ranks[length]
                ranks[length].add(rank + i)
        assert {k: len(v) for k, v in ranks.items()} == histogram
        # the pattern with most room is taken first, so new ones are opened only when full ones cannot take more
        assert sum(2 * v <= 16 for v in used.values()) <= 1

    whole()
    assert len(shortest_pack_first({1: 10**12, 2047: 10**12, 1024: 10**9}, 2048)) < 10_000


def test_any_other_tokenizer_is_used_itself(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    assert WordIds.fits(tokenizer_path()) and not WordIds.fits(path)
    other = Tokenizer.from_file(path)
    rows = [r for r in pack_documents(awkward(spark), path, max_tokens=10**6).collect()]
    want = sorted(zlib.crc32(np.array(ids_of(other, r[1]), "<u4").tobytes()) for r in AWKWARD)
    assert sorted(r.ids_crc32 for r in rows) == want


def test_one_piece_on_a_third_of_the_rows_is_ranked_by_many_buckets(spark, monkeypatch):
    from clickweave.llm import packing

    rows = [(7, "a b c d")] * 1500 + [(i, "w " * (i % 50)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, kept = [], packing.materialize
    monkeypatch.setattr(packing, "materialize", lambda df, name: seen.append(kept(df, name)) or seen[-1])
    got = pack_documents(docs, tokenizer_path(), max_tokens=256, rank_buckets=64).collect()
    check_sequences(got, 256)
    assert len(got) == 4500
    assert max(r["count"] for r in seen[0].groupBy("length", "bucket").count().collect()) < 100
