"""The pipeline's stages and run() against a brute-force pipeline."""

from __future__ import annotations

import functools
import random
import re
from collections import Counter, defaultdict
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from playerlake.llm.quality_rules import FENCE, MEASURES, MIN_GROUP
from tests.llm.test_operators import LOWER, WORD, base_spans, groups_of, prose, simhash_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(rng: random.Random) -> tuple[list[tuple], list[tuple]]:
    items = [(k, prose(rng, 25)) for k in range(5)]
    rows = []
    for k in range(330):
        text = prose(rng, rng.randint(45, 90))
        if k % 11 == 0:
            text += " " + rng.choice(items)[1]
        if k % 7 == 0:
            text += " mail a.b@c.de or +1 (555) 010-1234 now 4111 1111 1111 1111"
        if k % 13 == 0:
            text = "\n".join(["same words in each line here"] * 20)
        if k % 17 == 0:
            text = " ".join(w + " | ###" for w in text.split(" "))
        rows.append((k, text, rng.choice(["en", "en", "en", "de", None]), rng.choice(["s0", "s0", "s1", None])))
    rows += [(400 + k, rows[3 + k % 4][1] + (" x" if k % 2 else ""), "en", "s0") for k in range(20)]
    rows += [(500, None, None, None), (501, "", "en", "s0"), (None, prose(rng, 70), "en", "s0"), rows[10], rows[10], (502, prose(rng, 3_000), "en", "s0")]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows], items


def measures(text: str) -> dict[str, int] | None:
    """The integer measures, or None where the base rules fail."""
    words = re.findall(WORD, text)
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {p for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    if len(words) < 50 or 100 * len(covered) > 50 * len(words):
        return None
    chars = sum(map(len, words))
    return {
        "word_length": 10**6 * chars // len(words),
        "symbols": 10**6 * sum(c in "#*$%&|<>" for c in text) // chars,
        "capitals": 10**6 * sum(c.isupper() for c in text) // chars,
        "marks": 10**6 * sum(c in "!?" for c in text) // chars,
        "dup_lines": 10**6 * (len(lines) - len(set(lines))) // len(lines),
        "repeats": 10**6 * len(covered) // len(words),
    }


def rounded(value: int) -> int:
    """The lower end of the value's histogram bucket."""
    shift = max(value.bit_length() - 6, 0)
    return value >> shift << shift


def quality(rows: list[tuple]) -> list[tuple]:
    found = [measures(r[1] or "") for r in rows]
    groups = defaultdict(lambda: defaultdict(list))
    for r, m in zip(rows, found):
        for name, value in (m or {}).items():
            for key in ((r[2], r[3]), (r[2],), ()):
                groups[key][name].append(rounded(value))

    def weights(key: tuple, name: str) -> Counter:
        """Values of a group, a small one filled up by the next larger group's in proportion."""
        own = Counter(groups[key][name])
        if key == () or own.total() >= MIN_GROUP:
            return own
        larger = weights(key[:-1], name)
        return Counter({v: own[v] * larger.total() + (MIN_GROUP - own.total()) * larger[v] for v in {*own, *larger}})

    def quartiles(key: tuple, name: str) -> list[int]:
        have = weights(key, name)
        upto = list(accumulate(have[v] for v in sorted(have)))
        return [next(v for v, n in zip(sorted(have), upto) if 100 * n >= p * have.total()) for p in (25, 50, 75)]

    known = functools.cache(quartiles)

    def inside(r: tuple, m: dict) -> bool:
        for name, least, low in MEASURES:
            q = known((r[2], r[3]), name)
            if m[name] > q[1] + FENCE * max(q[1] - q[0], q[1] // 16, least) or low and m[name] < q[1] - FENCE * max(q[2] - q[1], q[1] // 16, least):
                return False
        return True

    return [r for r, m in zip(rows, found) if m is not None and inside(r, m)]


def without_copies(rows: list[tuple]) -> list[tuple]:
    kept: dict[int, tuple] = {}
    for r, g in zip(rows, groups_of([simhash_of(r[1]) for r in rows])):
        if g not in kept or (r[0] is None, r[0] or 0) < (kept[g][0] is None, kept[g][0] or 0):
            kept[g] = r
    return list(kept.values())


def without_benchmark(text: str, items: list[tuple]) -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    spans = [m.span() for m in re.finditer(word, text.translate(LOWER))]
    words = [text.translate(LOWER)[a:b] for a, b in spans]
    hit = set()
    for _, body in items:
        want = re.findall(word, body.translate(LOWER))
        for k in range(len(want) - 9):
            hit |= {p for at in range(len(words) - 9) if words[at : at + 10] == want[k : k + 10] for p in range(at, at + 10)}
    out, at = "", 0
    for k in sorted(hit):
        if k - 1 not in hit:
            out += text[at : spans[k][0]]
        at = spans[k][1]
    return out + text[at:]


def redacted(text: str) -> str:
    out, at = "", 0
    for start, _, end, kind in base_spans(text):
        if start >= at:
            out += text[at:start] + f"<{kind.upper()}>"
        at = max(at, end)
    return out + text[at:]


@pytest.fixture(scope="module")
def tables(spark):
    from playerlake.session import scratch_dir

    rows, items = rows_of(random.Random(9))
    root = scratch_dir(spark, "pipeline")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, rows, items


def test_run_equals_brute_force(spark, tables):
    root, rows, items = tables
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    good = quality(rows)
    single = without_copies(good)
    want = Counter((r[0], r[2], r[3], tuple(library.encode(redacted(without_benchmark(r[1], items))))) for r in single)
    got = corpus_pipeline.run(spark, root).collect()
    assert Counter((r.doc_id, r.lang, r.source, tuple(r.ids)) for r in got) == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) == len(r.piece_ends) for r in got)
    assert 200 < len(single) < len(good) < len(rows)


def test_stages_keep_the_columns_of_their_input(spark, tables):
    root, rows, _ = tables
    docs = spark.read.parquet(f"{root}/documents.parquet").selectExpr("*", "'x' as n_words", "1 as pii", "2 as `group`")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, root)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "sentencepiece"]


def test_an_empty_corpus(spark, tables, scratch):
    root, _, items = tables
    spark.createDataFrame([], DOCS).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0
