"""Token counts and the codec against the sentencepiece library."""

from __future__ import annotations

import random

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from playerlake.llm.columns import row_slices
from playerlake.llm.piece_codec import _strings, decode, decode_slice, encode, encode_slice
from playerlake.llm.piece_model import PieceModel, read_model
from playerlake.llm.token_counts import count_slice, count_tokens, valid_text

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "the", "in", "ing", "▁", "é", "漢", "字", "😀", "\n", "\t", "0", "99", "\x00", "<s>", "</s>", "<unk>", "<0x41>", "ß",
         "   ", "aaaa", "abab", "ל", "א", "́", "Ａ", "\xa0", "​", "~", "^^", "====="]


def texts() -> list[str]:
    rng = random.Random(1)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    out += ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 400))) for _ in range(100)]
    return out + ["", " ", "   ", "a" * 5000, " " * 3000, "ab" * 3000, "the" * 2000, "=" * 2500, "漢" * 1500, "x" * 20 + " " + "y" * 20]


@pytest.fixture(scope="module")
def model():
    return PieceModel(read_model(PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_counts_and_offsets_are_the_librarys(model, library):
    rows = texts()
    data, offsets = valid_text(pa.array(rows))
    expected = library.encode(rows, return_type="proto")
    ids, ends, counts, tokens, parts = [], [], [], [], []
    for a, b in row_slices(offsets, 20_000):
        part = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        i, e, n = encode_slice(model, *part)
        parts.append(decode_slice(model, i, n))
        ids, ends, counts = [*ids, *i.tolist()], [*ends, *e.tolist()], [*counts, *n.tolist()]
        tokens += count_slice(model, *part).tolist()
    assert tokens == counts == [len(p.pieces) for p in expected]
    assert ids == [x.id for p in expected for x in p.pieces]
    assert ends == [x.end for p in expected for x in p.pieces]
    assert _strings(parts).to_pylist() == library.decode([[x.id for x in p.pieces] for p in expected])


def test_the_character_map_replaces_longest_prefixes_with_offsets():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    model = PieceModel.__new__(PieceModel)
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    from playerlake.llm.piece_model import CharacterMap

    model.char_map = CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    model.dummy_prefix, model.squeeze, model.escape = False, False, False
    rng = random.Random(2)
    marks = ["Ａ", "ｂ", "①", "ﬁ", "é", "가", "ㄱ", "㍿", "x", " ", "　", "\xa0", "​", "½", "é", "\t", "ｶﾞ", "漢", "a"]
    rows = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    data, offsets = valid_text(pa.array(rows))
    points, source, row_at = model.normalise(data, offsets)
    plain = sentencepiece.SentencePieceNormalizer(model_proto=proto.SerializeToString(), add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
    for k, row in enumerate(rows):
        mine = "".join(map(chr, points[row_at[k] : row_at[k + 1]]))
        assert mine == plain.normalize(row), row
        at = source[row_at[k] + k : row_at[k + 1] + k + 1] - offsets[k]
        assert list(at) == sorted(at) and at[-1] == len(row.encode())


def test_malformed_utf8_reads_as_replacement_characters(model, library):
    data, offsets = valid_text(pa.array([b"ab\xff\xfec", b"ok"], pa.binary()))
    i, _, n = encode_slice(model, data, offsets)
    assert list(n) == [len(library.encode("ab��c")), len(library.encode("ok"))]
    assert i.tolist() == library.encode("ab��c") + library.encode("ok")


def test_operators_keep_columns_and_define_odd_rows(spark, library):
    rows = [(1, "hello world", "x"), (None, None, None), (3, "", "y"), (3, "", "y"), (4, "a" * 300_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    counted = count_tokens(docs, PATH)
    assert counted.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in counted.collect())
    long = len(library.encode("a" * 300_000))
    assert got == [(0, 0, 0, False), (1, 11, len(library.encode("hello world")), False), (3, 0, 0, False), (3, 0, 0, False), (4, 300_000, long, long > 4096)]
    coded = encode(docs, PATH, decoded=True)
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids", "piece_ends", "decoded"]
    for r in coded.collect():
        assert r.ids == library.encode(r.text or "") and r.decoded == (r.text or "") and (r.piece_ends[-1] if r.ids else 0) == len((r.text or "").encode())
    again = decode(coded.select("doc_id", "ids", "decoded"), PATH)
    assert sorted(r.decoded for r in again.collect()) == sorted(r[1] or "" for r in rows)
    empty = docs.limit(0)
    assert count_tokens(empty, PATH).count() == 0 and encode(empty, PATH).count() == 0
