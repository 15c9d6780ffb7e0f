"""The registered queries, digests and casts included, against brute force or the libraries."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from playerlake.llm import decontamination
from playerlake.llm.queries import QUERIES
from tests.llm.test_operators import LOWER, WORD, base_spans, contaminated, groups_of, leak_tables, odd_rows, pii_texts, prose, removed, repeat_rows, simhash_of

DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    rows = [r for r in repeat_rows(rng) if len(r[1] or "") < 50_000]
    rows += [(3000 + k, text, "en", "s1") for k, text in enumerate(pii_texts(rng)[:60])]
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]  # ids of their own: results carry no other key
    root = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], DOCS + ", n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(k, k % 2, 0) for k in range(0, len(rows), 3)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root, rows


def _found(spark, corpus, name):
    out = QUERIES[name](spark, corpus[0]).collect()
    assert sorted(r.doc_id for r in out) == [r[0] for r in corpus[1]]
    return {r.doc_id: r for r in out}


def _sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op3(spark, corpus):
    rows = corpus[1]
    tokens = {i: re.findall(WORD, (t or "").translate(LOWER)) + [None] for i, t, *_ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    count = Counter(w for i, words in tokens.items() if not held[i] for w in words)
    total = sum(count.values())
    for i, r in _found(spark, corpus, "op3_lm_scoring").items():
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in tokens[i])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(tokens[i]), sum(count[w] > 0 for w in tokens[i]), total)
        assert abs(r.base_score - base) < 1e-6 and math.isfinite(r.score) and r.score < 0


def test_op4(spark, corpus):
    for i, r in _found(spark, corpus, "op4_quality_classifier").items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op5(spark, corpus):
    prints = [simhash_of(r[1]) for r in corpus[1]]
    groups = groups_of(prints)
    smallest = {g: min(k for k, h in enumerate(groups) if h == g) for g in groups}
    for i, r in _found(spark, corpus, "op5_simhash_neardup").items():
        assert (r.fingerprint, r.component_id) == (f"{prints[i]:016x}", smallest[groups[i]])


def test_op6_and_op7(spark, corpus):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    counted, coded = _found(spark, corpus, "op6_token_counts"), _found(spark, corpus, "op7_sentencepiece")
    for i, text, *_ in corpus[1]:
        ids = library.encode(text or "")
        assert (counted[i].n_bytes, counted[i].n_tokens, counted[i].over_limit) == (len((text or "").encode()), len(ids), len(ids) > 4096)
        assert (coded[i].n_tokens, coded[i].ids_sha256, coded[i].decoded_sha256) == (len(ids), _sha(",".join(map(str, ids))), _sha(library.decode(ids)))


def test_op9(spark, corpus):
    for i, r in _found(spark, corpus, "op9_pii").items():
        spans = base_spans(corpus[1][i][1] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert r.base_sha256 == _sha(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans))
        assert {f"{kind}:{a}:{b}" for a, _, b, kind in spans} <= set(r.spans.split(","))


def test_op10(spark, corpus):
    found = _found(spark, corpus, "op10_repeated_substrings")
    for (i, *_), (size, gone, spans, kept) in zip(corpus[1], removed(corpus[1])):
        assert (found[i].n_bytes, found[i].n_removed, found[i].n_spans, found[i].kept_sha256) == (size, gone, spans, kept)


def test_op1_with_several_blocks(spark, tmp_path, monkeypatch):
    docs, items = leak_tables(random.Random(22))
    docs = [(k, t) for k, (_, t) in enumerate(docs)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    blocks = decontamination.benchmark_blocks
    for block_bytes in (decontamination.BLOCK_BYTES, 1000):
        monkeypatch.setattr(decontamination, "benchmark_blocks", lambda *a, n=block_bytes: blocks(*a, block_bytes=n))
        found = {r.doc_id: r for r in QUERIES["op1_decontamination"](spark, str(tmp_path)).collect()}
        for k, text in docs:
            n, hit, names = contaminated(text, items)
            assert tuple(found[k]) == (k, n, hit, len(names), _sha(",".join(names)), hit > 0)


def test_op9_of_an_empty_table_and_long_heads(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op9_pii"](spark, str(tmp_path)).count() == 0
    head = "a" * 60 + "1" + "b" * 10
    spark.createDataFrame([(1, f"the secret: {head} ends", "en", "s")], DOCS).write.parquet(f"{tmp_path}/more/documents.parquet")
    row, = QUERIES["op9_pii"](spark, f"{tmp_path}/more").collect()
    assert row.spans == f"token:12:{12 + len(head)}"


def test_a_pipeline_leaves_only_its_last_input(spark, corpus, monkeypatch):
    import corpus_pipeline
    from playerlake.llm.storage import remove_scratch, scratch_folders
    from playerlake.session import local_path
    import os

    spark.createDataFrame([(1, prose(random.Random(1), 30))], "item_id long, text string").write.mode("overwrite").parquet(f"{corpus[0]}/benchmark.parquet")
    with scratch_folders() as folders:
        out = corpus_pipeline.run(spark, corpus[0])
        n = out.count()
    left = [f for f in folders if os.path.exists(local_path(f))]
    assert len(folders) > 6 and len(left) == 1 and "pipeline-personal_data" in left[0] and n == out.count()
    remove_scratch(spark, left)
    assert not os.path.exists(local_path(left[0]))


def test_odd_rows_have_every_query(spark, tmp_path):
    rows = [(k, *r[1:]) for k, r in enumerate(odd_rows(random.Random(23)))]
    table = spark.createDataFrame([(*r, "clash", 1.5, [1]) for r in rows], DOCS + ", score string, n_tokens double, spans array<int>")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "some words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in QUERIES:
        if name not in ("op8_warc", "op11_sequence_packing", "op12_filter_audit", "op13_source_divergence"):
            assert QUERIES[name](spark, str(tmp_path)).count() == len(rows), name
