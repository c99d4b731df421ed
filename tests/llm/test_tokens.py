"""Token counts, the byte-level codec and packing against the tokenizer libraries."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from gleaner.llm import bpe_codec, packing, token_counts

JSON, RANKS, WORDS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


def pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (32_768, 1_024)])
def test_counts_equal_the_library(awkward, work, chunk, overlap):
    tokenizer = Tokenizer.from_file(JSON)
    got = token_counts.count_tokens(awkward, work, JSON, P.PATTERN, chunk=chunk, overlap=overlap)
    want = Counter((i, len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in pairs(awkward))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got.collect()) == want


def test_codec_round_trip(awkward, documents, work):
    docs = awkward.select("doc_id", "text").unionByName(documents.select("doc_id", "text"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_codec.read_ranks(RANKS), special_tokens={})
    got = bpe_codec.encode_and_decode(docs, work, RANKS, P.PATTERN)
    want = Counter((i, tuple(own.encode_ordinary(t)), t.encode()) for i, t in pairs(docs))
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in got.collect()) == want


def test_codec_slices_grow_with_the_texts(awkward, work, monkeypatch):
    monkeypatch.setattr(bpe_codec, "SLICE_BYTES", 500)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_codec.read_ranks(RANKS), special_tokens={})
    got = bpe_codec.encode_and_decode(awkward, work, RANKS, P.PATTERN)
    want = Counter((i, tuple(own.encode_ordinary(t)), t.encode()) for i, t in pairs(awkward))
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in got.collect()) == want


@pytest.mark.parametrize("capacity", [4096, 64])
def test_packing_is_exact_and_tight(awkward, documents, work, capacity):
    docs = awkward.select("doc_id", "text").unionByName(documents.select("doc_id", "text"))
    rows = packing.pack(docs, work, WORDS, capacity=capacity).collect()
    tokenizer, want, places = Tokenizer.from_file(WORDS), Counter(), defaultdict(list)
    for i, t in pairs(docs):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            piece = ids[k:k + capacity]
            want[i, k // capacity, k, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(places) <= 1.005 * (sum(r["length"] for r in rows) / capacity) + 1


def test_plan_is_near_the_bound_for_any_number_of_documents():
    lengths = np.clip(np.exp(np.random.default_rng(0).normal(6.7, 0.9, 50_000)).astype(int) + 1, 1, 4096)
    for times in (1, 1_000_000):
        counts = {int(k): v * times for k, v in Counter(lengths.tolist()).items()}
        plan = packing.make_plan(counts, 4096)
        assert plan.sequences <= 1.01 * sum(k * v for k, v in counts.items()) / 4096 + 1
        assert len(plan.runs) < 60_000
        placed = Counter()
        for length, _, count, _, _ in plan.runs:
            placed[length] += count
        assert placed == Counter(counts)


def test_empty_tables(awkward, work):
    none = awkward.limit(0)
    assert token_counts.count_tokens(none, work, JSON, P.PATTERN).collect() == []
    assert bpe_codec.encode_and_decode(none, work, RANKS, P.PATTERN).collect() == []
    assert packing.pack(none, work, WORDS).collect() == []
