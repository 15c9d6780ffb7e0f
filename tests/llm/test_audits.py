"""Filter interactions and source divergence on small tables, against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from playerlake.llm import divergence_audit as divergence
from playerlake.llm import queries
from playerlake.llm.filter_audit import OUTCOMES, audit_filters, packed_outcomes
from playerlake.llm.pattern_tree import Tree
from tests.llm.test_operators import LOWER, WORD, odd_rows, prose

DOCS = "doc_id long, text string, lang string, source string"


def failed_filters(rows):
    smallest = {}
    for i, text, *_ in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    for i, text, _, source in rows:
        t = text or ""
        words = re.findall(WORD, t)
        yield i, source or "", [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                                any(c in "#$%&*|" for c in t), i is not None and smallest[t] < i]


def brute_audit(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    cells = defaultdict(Counter)
    judged = list(failed_filters(rows))
    for part in {p for _, p, _ in judged}:
        inside = [(i, f) for i, p, f in judged if p == part]
        for order in permutations("ABCDE"):
            left = inside
            for step, letter in enumerate(order, 1):
                k = "ABCDE".index(letter)
                gone = [(i, f) for i, f in left if f[k]]
                left = [(i, f) for i, f in left if not f[k]]
                failing = [f for _, f in inside if f[k]]
                cells[part, "".join(order), step] = Counter(
                    kept=len(left), removed=len(gone), redundant=len(failing) - len(gone), unique_fails=sum(sum(f) == 1 for f in failing),
                    good_lost=sum(i in good for i, _ in gone), toxic_lost=sum(i in toxic for i, _ in gone))
    share = Counter()
    for (part, order, step), cell in cells.items():
        share[part, order[step - 1]] += cell["removed"]
    return {(p, o, s, *[cell[name] for name in OUTCOMES], share[p, o[s - 1]]) for (p, o, s), cell in cells.items()}


def audit_rows(rng):
    rows = odd_rows(rng) + [(300 + k, prose(rng, rng.randint(150, 260)) + rng.choice(["", " # 5%", " AAAAAAAAAAAAAAAA"]), "en", rng.choice(["s0", "s1"])) for k in range(40)]
    rows += [(400 + k, rows[50 + k][1], "en", rng.choice(["s0", None, ""])) for k in range(0, 20, 2)] + [(2, rows[60][1], "en", "s1"), (None, rows[61][1], "en", "s1")]
    return rows + [(500, "one two three " * 100, "en", "s0")]


def test_audit_equals_brute_force(spark):
    rng = random.Random(12)
    rows = audit_rows(rng)
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows[::2]] + [(300, 1, 0), (300, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS + ", part string, quality int")
    got = [tuple(r) for r in audit_filters(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()]
    labels = [x for x in labels if x[0] is not None]  # a null doc_id has no label
    assert set(got) == brute_audit(rows, labels) and len(got) == 600 * len({r[3] or "" for r in rows})


def test_wide_counters_do_not_overflow():
    total = (1 << 56) * packed_outcomes()[31, True, True] + (1 << 56) * packed_outcomes()[0, False, False]
    fields = np.frombuffer(total.to_bytes(8 * 600 * 6, "little"), "<u8").reshape(600, 6)
    assert set(fields[::5, 1].tolist()) == {1 << 56} and set(fields[1::5, 2].tolist()) == {1 << 56} and set(fields[:, 0].tolist()) == {1 << 56}


def test_audit_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(docs, labels).count() == 0
    one = audit_filters(spark.createDataFrame([(1, None, None, None)], DOCS), labels).collect()
    assert len(one) == 600 and {r.part for r in one} == {""} and {r.kept for r in one if r.step == 5} == {0}


def brute_divergence(rows, least=10, top=10):
    groups, per_doc = Counter(), []
    for _, text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        per_doc.append((lang or "", source or "", Counter(words)))
    documents = Counter((lang, w) for lang, _, words in per_doc for w in words)
    counts = defaultdict(Counter)
    for lang, source, words in per_doc:
        groups[lang, source] += 1
        for w, n in words.items():
            if documents[lang, w] >= least:
                counts[lang, source][w] += n
                counts[lang][w] += n
    out = set()
    for lang, source in groups:
        kept = sorted(counts[lang])

        def share(group, w):
            return 1 + 1_000_000_000 * (counts[group][w] + 2) // (sum(counts[group].values()) + 2 * len(kept))

        def ranked(part, values, keep):
            for rank, (value, _, item) in enumerate(sorted((-v, item.encode(), item) for item, v in values.items())[:keep], 1):
                out.add((lang, source, part, item, -value, rank))

        def value(p, q):
            return (p - q) ** 2 // (p + q)

        others = [s for of, s in groups if of == lang and s != source]
        ranked("pair", {s: sum(value(share((lang, source), w), share((lang, s), w)) for w in kept) for s in others}, None)
        own = {w: (share((lang, source), w), share(lang, w)) for w in kept if counts[lang, source][w]}
        ranked("term", {w: value(p, q) for w, (p, q) in own.items() if p > q}, top)
    return out


def divergence_rows(rng):
    words = ["Été", "über", "word", "Term", "x", "naïve", "日本", "ab", "ABC", "zz"]
    rows = odd_rows(rng)
    for k in range(120):
        source = f"s{rng.randint(0, 4)}"
        own = words[: 3 + int(source[1])]
        rows.append((k, " 1,".join(rng.choice(own) for _ in range(rng.randint(1, 30))), rng.choice(["en", "de", None]), rng.choice([source, source, None])))
    return rows + [(900, "lonely", "fr", "a"), (901, "", "fr", "b"), (902, "word " * 40_000, "en", "s1")] + [rows[50]] * 3


@pytest.mark.parametrize("bucket", [8192, 2])
def test_divergence_equals_brute_force(spark, bucket):
    rows = divergence_rows(random.Random(13))
    docs = spark.createDataFrame([(*r, "clash", 3) for r in rows], DOCS + ", term string, n int")
    got = [tuple(r) for r in divergence.divergence_audit(docs, bucket=bucket).collect()]
    assert set(got) == brute_divergence(rows) and len(got) == len(set(got)) > 100


def test_divergence_of_the_empty_table(spark):
    assert divergence.divergence_audit(spark.createDataFrame([], DOCS)).count() == 0


def test_equal_hashes_of_different_words_are_told_apart(monkeypatch):
    class Weak:
        def prefix(self, data):
            return data

        def ranges(self, sums, starts, ends):
            return (ends - starts).astype(np.uint64) % 2

    monkeypatch.setattr(divergence, "HASHER", Weak())
    texts = [b"ab cd ab efgh x", b"cd cd yz", b"x y ab"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    group, starts, ends, n, documents = divergence._slice_counts(data, offsets, np.array([0, 1, 0]))
    got = {(g, data[a:b].tobytes()): (int(c), int(d)) for g, a, b, c, d in zip(group, starts, ends, n, documents)}
    assert got == {(0, b"ab"): (3, 2), (0, b"cd"): (1, 1), (0, b"efgh"): (1, 1), (0, b"x"): (2, 2), (0, b"y"): (1, 1), (1, b"cd"): (2, 1), (1, b"yz"): (1, 1)}


def test_a_tree_shares_paths_and_counts_pairs_once():
    paths = [[(0, 2), (1, 3)], [(0, 2), (1, 3), (2, 1)], [(0, 2), (2, 4)], [(1, 3)], [(2, 1)]]
    terms = np.array([5, 1, 2, 7, 3])
    flat = np.array([x for path in paths for x in path])
    offsets = np.cumsum([0, *map(len, paths)])
    tree = Tree(flat[:, 0], flat[:, 1], offsets, terms)
    assert sorted(zip(tree.group, tree.count, tree.terms)) == [(0, 2, 8), (1, 3, 6), (1, 3, 7), (2, 1, 1), (2, 1, 3), (2, 4, 2)]
    weight, none = 100 * tree.count, np.array([10, 20, 30])
    sums = tree.pair_sums(weight, none)
    for a in range(3):
        for b in range(a + 1, 3):
            want = 0
            for path, times in zip(paths, terms):
                have = dict(path)
                p, q = (100 * have[g] if g in have else none[g] for g in (a, b))
                want += times * ((p - q) ** 2 // (p + q) - (none[a] - none[b]) ** 2 // (none[a] + none[b]))
            assert sums[a, b] == want


def test_queries_give_the_columns_of_their_sql(spark, tmp_path):
    rows = divergence_rows(random.Random(14))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    audit = queries.QUERIES["op12_filter_audit"](spark, str(tmp_path))
    assert audit.columns == ["part", "filter_order", "step", *OUTCOMES, "shapley"]
    found = queries.QUERIES["op13_source_divergence"](spark, str(tmp_path))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and {tuple(r) for r in found.collect()} == brute_divergence(rows)
