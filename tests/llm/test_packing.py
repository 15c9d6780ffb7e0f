"""Ids, lower bounds and packing, against the tokenizers library and brute force."""

from __future__ import annotations

import random
import zlib
from itertools import product
from math import ceil

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playerlake.llm import queries, word_ids
from playerlake.llm.best_fit import best_fit_decreasing, lower_bound
from playerlake.llm.columns import text_buffer
from playerlake.llm.sequence_packing import least_sequences, pack_documents
from tests.llm.test_operators import odd_rows, prose

MODEL = public_tokenizers.path("word_bpe_49k.json")

ODD_TEXTS = [
    "", " \n\t", "<|endoftext|>x<|ENDOFTEXT|>|a|b'there's \"'s don't CAN'T I'LL", "H̱e ẖ É ≠ ≠ a̸. .̸x",
    "ΣΑΣ. ΣΑΣ ΟΔΥΣΣΕΥΣ, İstanbul 12.5% x²³ a b\u0085c d​q 3rd ’s ’t", "́a ́b", "a<|startoftext|>b c'ved 'll'd", "…. «a». ½.5 Ⅷa ß ŉ ﬁ x'́s",
    "ÉCOLE École ÀÖØÞß ×÷ (é) é. é- «é» 1é é1 ªº µ ÿ Ÿ", "\x00\x01 a\x7fb \xad", "日本語 テスト。 한국어 العربية 12", "a_b-c/d=e@f.com #x% $5,000.00",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(MODEL)


def own_ids(texts):
    encoder = word_ids.WordEncoder(open(MODEL, "rb").read())
    ids, edges = encoder.encode(*text_buffer(pa.array(texts, pa.large_string())))
    return [ids[a:b].tolist() for a, b in zip(edges, edges[1:])], encoder


def test_ids_are_those_of_the_library(library):
    rng = random.Random(3)
    letters = "aZé'É.|<> \n-1½Σ̸́,ß×日"
    texts = ODD_TEXTS + [prose(rng, 50) for _ in range(50)] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    assert own_ids(texts)[0] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_a_full_memory_forgets_and_stays_right(library, monkeypatch):
    monkeypatch.setattr(word_ids, "REMEMBERED", 20)
    encoder = word_ids.WordEncoder(open(MODEL, "rb").read())
    rng = random.Random(4)
    for _ in range(30):
        text = prose(rng, 40)
        ids, _ = encoder.encode(*text_buffer(pa.array([text], pa.large_string())))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.young) < 100 and len(encoder.old) < 100


def fewest(lengths, capacity):
    """Brute force over all assignments."""
    for n in range(1, len(lengths) + 1):
        for places in product(range(n), repeat=len(lengths)):
            if all(sum(x for x, p in zip(lengths, places) if p == k) <= capacity for k in range(n)):
                return n
    return 0


def test_bounds_never_pass_the_optimum_and_packing_is_valid():
    rng = random.Random(6)
    certified = 0
    for _ in range(120):
        capacity = rng.choice([10, 16, 31])
        lengths = np.array([rng.randint(1, capacity - 1) for _ in range(rng.randint(1, 6))])
        bound = ceil(lower_bound(*np.unique(lengths, return_counts=True), capacity))
        bins, offsets, n = best_fit_decreasing(lengths, capacity)
        best = fewest(lengths.tolist(), capacity)
        assert bound <= best <= n
        certified += bound == n
        for k in range(n):
            inside = sorted((offsets[bins == k].tolist()[i], lengths[bins == k].tolist()[i]) for i in range((bins == k).sum()))
            at = 0
            for offset, length in inside:
                assert offset == at
                at += length
            assert 0 < at <= capacity
    assert certified > 100


def test_bound_sees_more_than_the_sum():
    assert lower_bound(np.array([6]), np.array([5]), 10) == 5  # two of 6 never share
    assert ceil(lower_bound(np.array([4]), np.array([9]), 10)) == 5  # two of 4 at most


def check_packing(rows, capacity, ids):
    """rows: (doc key, piece, start, length, crc, sequence, offset)."""
    sequences, documents = {}, {}
    for key, piece, start, length, crc, sequence, offset in rows:
        sequences.setdefault(sequence, []).append((offset, length))
        documents.setdefault(key, []).append((piece, start, length, crc))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for key, want in ids.items():
        cut = [want[k : k + capacity] for k in range(0, len(want), capacity)]
        assert sorted(documents.pop(key)) == [(k, k * capacity, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in enumerate(cut)]
    assert not documents
    return len(sequences)


@pytest.mark.parametrize("group", [8192, 16])
def test_packing_of_odd_rows(spark, library, group):
    rows = odd_rows(random.Random(8))
    table = spark.createDataFrame([(k, *r, "clash", "kept") for k, r in enumerate(rows)], "key long, doc_id long, text string, lang string, source string, length string, extra string")
    packed = pack_documents(table, MODEL, capacity=64, group=group)
    assert packed.columns == ["key", "doc_id", "lang", "source", "extra", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset", "certified"]
    found = packed.collect()
    ids = {k: [*library.encode(r[1] or "", add_special_tokens=False).ids, 0] for k, r in enumerate(rows)}
    n = check_packing([(r.key, r.piece, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset) for r in found], 64, ids)
    assert all(r.extra == "kept" and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)
    assert ceil(least_sequences(packed, 64)) <= n <= ceil(least_sequences(packed, 64)) + 2


def test_groups_exchange_until_few_sequences_have_room(spark):
    rng = random.Random(9)
    from playerlake.llm.sequence_packing import pack_pieces

    rows = [(k, rng.randint(1, 60)) for k in range(3000)]
    pieces = spark.createDataFrame(rows, "key long, length long")
    packed = {g: pack_pieces(pieces, capacity=100, group=g).collect() for g in (64, 512, 8192)}
    least = ceil(least_sequences(pieces, 100))
    used = {g: len({r.sequence_id for r in found}) for g, found in packed.items()}
    assert sorted(r.key for r in packed[64]) == list(range(3000))
    alone = sum(best_fit_decreasing(np.array([n for _, n in rows[k : k + 64]]), 100)[2] for k in range(0, 3000, 64))
    assert used[8192] == least and used[512] <= least + 2 and least <= used[64] < alone


def test_packing_of_empty_and_equal_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(empty, MODEL).count() == 0
    same = spark.createDataFrame([(1, "the same words")] * 50 + [(None, None)] * 7, "doc_id long, text string")
    found = pack_documents(same, MODEL, capacity=16, keep_ids=False).collect()
    assert len(found) == 57 and len({(r.sequence_id, r.offset) for r in found}) == 57
    assert len({r.sequence_id for r in found}) == 13  # four ids a text, one a null


def test_the_query_packs_every_document(spark, tmp_path, library):
    rows = [(k, r[1], r[2], r[3]) for k, r in enumerate(odd_rows(random.Random(10)))] + [(500, "word " * 5000, "en", "s0")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op11_sequence_packing"](spark, str(tmp_path))
    assert found.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    ids = {r[0]: [*library.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows}
    check_packing([tuple(r)[:7] for r in found.collect()], 2048, ids)
    assert found.where(F.col("length") > 2048).count() == 0
