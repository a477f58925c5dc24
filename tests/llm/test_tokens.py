"""Token files, token counts and packing against the library itself."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from cases import SCHEMA, awkward, clashing
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pathways.llm import packing, token_counts, token_file
from pathways.llm.encoder import Encoder, encoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


def ordered():
    return sorted(((r[0], r[1] or "") for r in awkward()), key=lambda r: (r[0], r[1].encode()))


def library(path, texts, end):
    return [e.ids + [end] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdté.,!1<|>İ\x1c\xa0᠎ ́ab"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_remembered_pieces_give_the_library_s_ids(text):
    for path in (BYTE, WORD):
        want = encoder(path).tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder(path).ids(text), encoder(path).dtype).tolist() == want


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr("pathways.llm.encoder.MOST_CHUNKS", 1)
    monkeypatch.setattr("pathways.llm.encoder.MOST_PIECES", 1)
    small = Encoder(WORD)
    text = "some words, some other words and some words again"
    assert small.ids(text) == encoder(WORD).ids(text) and len(small.by_chunk) == 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=70))
def test_coded_ranks_come_back(ranks):
    control, data = token_file.pack_ranks(np.array(ranks, "<u4"))
    assert token_file.unpack_ranks(control, data, len(ranks)).tolist() == ranks
    assert len(control) == -(-len(ranks) // 4)
    assert len(data) == sum(max(1, (r.bit_length() + 7) // 8) for r in ranks)


def test_token_file_round_trip(spark, docs):
    got = token_file.token_file(clashing(docs, "part", "ids", "before"), BYTE).collect()
    ids = library(BYTE, [t for _, t in ordered()], 0)
    start, want = 0, []
    for (doc_id, _), i in zip(ordered(), ids):
        want.append((doc_id, start, len(i), crc(i)))
        start += len(i)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)


def test_token_file_ranks_by_frequency(spark, docs, tmp_path):
    path = str(tmp_path / "set")
    token_file.write_token_file(docs, path, BYTE, block_tokens=100)
    ids = library(BYTE, [t for _, t in ordered()], 0)
    n = Counter(x for i in ids for x in i)
    ranks = [r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]
    assert ranks == sorted(n, key=lambda x: (-n[x], x))
    back = token_file.read_token_file(spark, path, with_ids=True).orderBy("start").collect()
    assert [r.ids for r in back] == ids
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    assert len(blocks) > 3 and all(len(b.control) == -(-sum(b.lengths) // 4) for b in blocks)


@pytest.mark.parametrize("head", [0, 5, 1 << 18])
def test_token_counts(spark, docs, head):
    got = token_counts.token_counts(clashing(docs, "row", "piece", "n", "rare"), WORD, head=head)
    texts = [r[1] or "" for r in awkward()]
    want = Counter((r[0], len(t.encode()), len(i) - 1, len(i) - 1 > 2048) for r, t, i in zip(awkward(), texts, library(WORD, texts, 2)))
    assert Counter(map(tuple, got.collect())) == want


def test_each_pre_token_is_counted_once(spark, docs):
    pieces = token_counts.distinct_pieces(docs.repartition(5), WORD)
    assert pieces.count() == pieces.select("piece").distinct().count()


@pytest.mark.parametrize("length", [8, 4096])
def test_packing_is_gapless(spark, docs, length):
    got = packing.pack(clashing(docs, "base", "part", "ids"), WORD, 2, length, with_ids=True).collect()
    ids = library(WORD, [t for _, t in ordered()], 2)
    stream = [x for i in ids for x in i]
    got.sort(key=lambda r: (r.sequence_id, r.offset))
    assert [x for r in got for x in r.ids] == stream
    at = 0
    for r in got:
        assert (r.sequence_id, r.offset) == divmod(at, length) and r.length <= length - r.offset
        assert r.ids_crc32 == crc(r.ids) and len(r.ids) == r.length
        at += r.length
    assert Counter(r.doc_id for r in got if r.start == 0) == Counter(i for i, _ in ordered())
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == Counter((d, len(i)) for (d, _), i in zip(ordered(), ids))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_file.token_file(none, BYTE).count() == 0
    assert token_counts.token_counts(none, WORD).count() == 0
    assert packing.pack(none, WORD).count() == 0
