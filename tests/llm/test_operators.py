"""Operators on small tables with odd rows, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from playerlake.llm import decontamination, lm_scoring, pii, quality_classifier, quality_rules, repeated_substrings, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[^\x20\x09-\x0D]+"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["an", "er", "To", "ção", "st", "7"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def odd_rows(rng: random.Random) -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empty and long texts, repeated rows, equal ids."""
    rows = [(k, prose(rng, rng.randint(5, 120)), rng.choice(["en", "de", None]), rng.choice(["s0", "s1", None])) for k in range(40)]
    rows += [(100, None, "en", None), (101, "", None, "s0"), (102, " \n\t ", "en", "s0"), (103, prose(rng, 30_000), "en", "s0"), (None, prose(rng, 60), "en", "s0"), (None, None, None, None)]
    return rows + [rows[3], rows[3], (200, rows[5][1], "de", "s1"), (5, "another text under a known id " * 3, "en", "s0")]


DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture()
def rng():
    return random.Random(5)


# -- decontamination ---------------------------------------------------------------


def contaminated(text: str | None, items: list[tuple], window: int = 10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hit, names = set(), set()
    for item, body in items:
        want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (body or "").translate(LOWER))
        n = min(window, len(want))
        for k in range(len(want) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == want[k : k + n]:
                    hit |= set(range(at, at + n))
                    names.add("" if item is None else str(item))
    return len(words), len(hit), sorted(names)


def leak_tables(rng):
    items = [(k, prose(rng, rng.randint(8, 40))) for k in range(8)]
    items += [(20, "three Short words"), (None, prose(rng, 12)), (21, None), (22, "  ...  "), (3, prose(rng, 15)), items[2]]
    docs = []
    for k in range(60):
        text = prose(rng, rng.randint(0, 50))
        if k % 3 == 0:
            body = rng.choice(items)[1] or ""
            cut = body.split(" ")
            text += ", " + "; ".join(w.upper() if w.isascii() else w for w in cut[rng.randint(0, 2) :]) + ". " + prose(rng, 5)
        docs.append((k, text))
    return docs + [(100, None), (None, ""), (101, items[0][1]), (101, items[0][1]), (102, prose(rng, 3000) + " " + items[1][1])], items


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 300])
def test_contamination_equals_brute_force(spark, rng, monkeypatch, block_bytes):
    docs, items = leak_tables(rng)
    monkeypatch.setattr(decontamination, "benchmark_blocks", lambda *a, f=decontamination.benchmark_blocks: f(*a, block_bytes=block_bytes))
    table = spark.createDataFrame([(i, t, "kept", "clash") for i, t in docs], "doc_id long, text string, extra string, n_hit string")
    found = decontamination.find_contamination(table, spark.createDataFrame(items, "item_id long, text string"))
    assert found.columns == ["doc_id", "text", "extra", "n_words", "n_hit", "hit_spans", "hit_items"]
    got = Counter((r.doc_id, r.text, r.n_words, r.n_hit, tuple(r.hit_items)) for r in found.collect())
    want = Counter()
    for i, t in docs:
        n, hit, names = contaminated(t, items)
        want[i, t, n, hit, tuple(names)] += 1
    assert got == want and sum(r[3] > 0 for r in want) >= 15


def test_removal_leaves_no_window_and_clean_texts_alone(spark, rng):
    docs, items = leak_tables(rng)
    table = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(docs)], "key long, text string")
    cut = {r.key: r.text for r in decontamination.remove_contamination(table, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(cut) == len(docs)
    for k, (_, text) in enumerate(docs):
        hit = contaminated(text, items)[1]
        assert (cut[k] == text) == (hit == 0)
        assert contaminated(cut[k], items)[0] == contaminated(text, items)[0] - hit


def test_contamination_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    row, = decontamination.find_contamination(docs, items).collect()
    assert (row.n_words, row.n_hit, row.hit_items) == (3, 0, [])
    assert decontamination.find_contamination(docs.limit(0), items).count() == 0


def test_items_that_share_a_text_spread_over_blocks(spark, rng):
    text = prose(rng, 15)
    items = spark.createDataFrame([(k, text) for k in range(600)] + [(1000 + k, prose(rng, 15)) for k in range(100)], "item_id long, text string")
    count, blocks = decontamination.benchmark_blocks(items, "item_id", "text", 10, block_bytes=8192)
    blocks = list(blocks)
    assert len(blocks) == count > 2
    assert sorted(int(item) for block in blocks for item, _ in block) == [*range(600), *range(1000, 1100)]
    assert max(sum(len(t) + len(i) for i, t in block) for block in blocks) < 2 * 8192


# -- quality rules -----------------------------------------------------------------


def test_quality_counts_equal_brute_force(spark, rng):
    rows = odd_rows(rng) + [(300, "a b c a b c a b\n\nx!\nx!\n y \nx!", "en", "s0"), (301, "# * $ | <é> & %", "en", "s1"), (302, "w " * 5000, "en", "s1")]
    table = spark.createDataFrame([(*r, "clash") for r in rows], DOCS + ", n_words string")
    got = Counter(tuple(r) for r in quality_rules.measure(table).select("doc_id", "text", *quality_rules.BASE, "base_failed").collect())
    want = Counter()
    for i, text, *_ in rows:
        t = text or ""
        words = re.findall(WORD, t)
        lines = [line for line in t.split("\n") if re.search(WORD, line)]
        grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {p for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want[i, text, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed] += 1
    assert got == want


def test_adaptive_thresholds_drop_outliers_of_their_group_only(spark, rng):
    usual = [(k, " ".join(rng.choice(["some", "words", "about", "things"]) + str(rng.randint(0, 10**6)) for _ in range(80)), "en", "plain") for k in range(300)]
    marked = [(1000 + k, " ".join(rng.choice(["a|b", "c|d"]) + str(rng.randint(0, 10**6)) for _ in range(80)), "en", "tables") for k in range(300)]
    odd = (5000, marked[0][1], "en", "plain")
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(spark.createDataFrame([*usual, *marked, odd], DOCS)).collect()}
    assert not kept[5000] and all(kept[k] for k in range(300)) and all(kept[1000 + k] for k in range(300))


def test_quality_of_odd_rows_and_empty_table(spark, rng):
    table = spark.createDataFrame(odd_rows(rng), DOCS)
    judged = quality_rules.apply_rules(table)
    assert judged.count() == table.count() and judged.where("kept is null").count() == 0
    assert judged.where("text is null and kept").count() == 0
    assert quality_rules.apply_rules(table.limit(0)).count() == 0


def _with_junk(rng, clean, junk, source="s0", start=0):
    """Clean texts and texts with a mark in every other word."""
    words = lambda mark: " ".join(prose(rng, 1) + (mark if k % 2 else "") for k in range(80))
    return [(start + k, words(""), "en", source) for k in range(clean)] + [(start + clean + k, words("|#"), "en", source) for k in range(junk)]


@pytest.mark.parametrize("junk", [60, 100, 130])
def test_a_third_of_junk_does_not_move_the_fences(spark, rng, junk):
    rows = _with_junk(rng, 300 - junk, junk)
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(kept[k] for k in range(300 - junk)) and not any(kept[k] for k in range(300 - junk, 300))


def test_fences_change_little_at_the_size_of_a_group(spark, rng):
    plain = [(5000 + k, prose(rng, 80), "en", "plain") for k in range(1000)]
    rows = _with_junk(rng, 140, 62, source="mixed")
    limits = []
    for size in (199, 200, 201):
        group = rows[: size - 62] + rows[140:]
        measured = quality_rules.measure(spark.createDataFrame(plain + group, DOCS))
        found = quality_rules.fences(quality_rules.sketch(measured)).where("source = 'mixed'").collect()
        limits.append({r.measure: (r.low, r.high) for r in found})
        kept = quality_rules.apply_rules(spark.createDataFrame(plain + group, DOCS)).where("source = 'mixed' and kept").count()
        assert kept == size - 62
    for name, (low, high) in limits[1].items():
        for other in (limits[0], limits[2]):
            assert abs(other[name][1] - high) <= 0.2 * high and (low is None or abs(other[name][0] - low) <= 0.2 * high)


def test_sketches_merge_by_sum(spark, rng):
    measured = quality_rules.measure(spark.createDataFrame(odd_rows(rng), DOCS)).cache()
    whole = quality_rules.sketch(measured)
    halves = quality_rules.sketch(measured.where("doc_id % 2 = 0")).unionByName(quality_rules.sketch(measured.where("doc_id % 2 <> 0 or doc_id is null")))
    summed = halves.groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))
    assert whole.exceptAll(summed).count() == 0 and summed.exceptAll(whole).count() == 0


# -- SimHash -----------------------------------------------------------------------


def simhash_of(text: str | None) -> int:
    words = re.findall(WORD, (text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints: list[int], radius: int = 4) -> list[int]:
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(prints))]


def near_copies(rng) -> list[tuple]:
    rows = odd_rows(rng)
    for k in range(60):
        words = rows[rng.randrange(3)][1].split(" ") * 6
        words[rng.randrange(len(words))] = "changed" + str(k)
        rows.append((1000 + k, " ".join(words), "en", "s0"))
    return rows


@pytest.mark.parametrize("tile", [simhash.TILE, 8])
def test_simhash_groups_equal_brute_force(spark, rng, monkeypatch, tile):
    rows = near_copies(rng)
    monkeypatch.setattr(simhash, "near_links", lambda *a, f=simhash.near_links: f(*a, tile=tile))
    prints = [simhash_of(t) for _, t, *_ in rows]
    group = groups_of(prints)
    names = {g: min((i for (i, *_), h in zip(rows, group) if h == g and i is not None), default=None) for g in group}
    want = Counter((i, p, names[g]) for (i, *_), p, g in zip(rows, prints, group))
    got = Counter((r.id, r.fp % (1 << 64), r.component) for r in simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect())
    assert got == want and len(set(group)) < len(rows) - 30
    kept = simhash.one_per_group(spark.createDataFrame([(*r, 1, {"a": 1}) for r in rows], DOCS + ", group int, tags map<string,int>"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "group", "tags"]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(names[g] for g in set(group))


def test_simhash_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_per_group(empty).count() == 0


def test_components_of_a_long_chain(spark):
    from playerlake.llm.components import components

    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = [(order[k], order[k + 1]) for k in range(199) if k != 120]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    left, right = order[:121], order[121:]
    assert got == {x: min(part) for part in (left, right) for x in part}


def test_components_name_each_node_once(spark, rng):
    from playerlake.llm.components import components

    paths = [(1, 2), (2, 3)], [(k, k + 1) for k in range(1, 5)], [(k, rng.randrange(max(0, k - 3), k)) for k in range(1, 150) if k % 40]
    for edges in paths:
        nodes = {x for e in edges for x in e}
        name = {x: x for x in nodes}
        for _ in nodes:
            for a, b in edges:
                name[a] = name[b] = min(name[a], name[b])
        got = Counter((r.node, r.component) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
        assert got == Counter(name.items())


# -- personal data -----------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
    return total % 10 == 0


def base_spans(text: str) -> list[tuple]:
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    out = []
    for n, (kind, pattern) in enumerate(kinds):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def pii_texts(rng) -> list:
    atoms = ["a.b@c.de", "x@y", "@", "+", "1.2.3.4", "255.1.1.999", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111112", "79927398713", "+1 (555) 010-1234",
             "+49.30-123 4567", "+12", "é", "名", "..", "-", " ", "0", "7", "12345678", "_", "%", "\n", "a@b.c_d@e.f", "00097.1.2.3", "(", "😀"]
    return ["".join(rng.choice(atoms) + rng.choice(["", " "]) for _ in range(rng.randint(0, 25))) for _ in range(400)]


def test_base_spans_equal_brute_force(spark, rng):
    texts = pii_texts(rng) + [None, "", "1" * 20_000, "a" * 50_000, "1.2.3.4 " * 3000]
    found = pii.find_pii(spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, pii string")).collect()
    assert len(found) == len(texts)
    for r in found:
        assert [(s["start"], s["kind"], s["end"], s["name"]) for s in r.pii if s["kind"] < 4] == base_spans(texts[r.doc_id] or ""), texts[r.doc_id]


def test_checksums_and_context_decide_the_other_kinds(spark):
    rows = [(1, "pay to DE89 3704 0044 0532 0130 00 today"), (2, "pay to DE88 3704 0044 0532 0130 00 today"), (3, 'the secret = "0123abcd4567efgh0123abcd"'),
            (4, "part 0123abcd4567efgh0123abcd of it"), (5, "account 12345678."), (6, "there were 12345678 of them")]
    got = {r.doc_id: {s["name"] for s in r.pii} for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: {"iban"}, 2: set(), 3: {"token"}, 4: set(), 5: {"account"}, 6: set()}


def iban(country: str, body: str) -> str:
    return country + f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}" + body


def test_ibans_end_at_their_own_length(spark, rng):
    plain = ["DE89370400440532013000", "GB82WEST12345698765432", "NO9386011117947", iban("MT", "MALT01100" + "0012345MTLCAST001S"), iban("BE", "539007547034"), iban("ZZ", "AB12CD34EF56")]
    grouped = [" ".join(x[k : k + 4] for k in range(0, len(x), 4)) for x in plain]
    follow = ["", ".", " BIC COBADEFFXXX", " Please pay", " 2024 due", " today", " I", " 7", " A1 B2 C3 D4 E5 F6 G7 H8 J9", "\n"]
    rows = [(f"IBAN {x}{after}", [x]) for x in plain[:5] + grouped[:5] for after in follow]
    rows += [(f"{x} {y}", [x, y]) for x in plain[:5] + grouped[:5] for y in plain[:5] + grouped[:5]]
    rows += [(f"é😀 {plain[5]}, {grouped[5]}. ", [plain[5], grouped[5]]), ("DE89370400440532013000X", []), ("xDE89370400440532013000", []), ("DE88370400440532013000 BIC", [])]
    found = pii.find_pii(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")).collect()
    for r in found:
        text, want = rows[r.doc_id]
        assert [text[s["start"] : s["end"]] for s in r.pii if s["name"] == "iban"] == want, text


def test_redaction_cuts_every_span(spark, rng):
    texts = pii_texts(rng)
    cut = pii.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in cut:
        text, want, at = texts[r.doc_id], "", 0
        for s in r.pii:
            if s["start"] >= at:
                want += text[at : s["start"]] + f"<{s['name'].upper()}>"
            at = max(at, s["end"])
        assert r.text == want + text[at:]


# -- repeated substrings -----------------------------------------------------------


def repeat_rows(rng) -> list[tuple]:
    base = [prose(rng, 300) for _ in range(4)]
    rows = odd_rows(rng)
    for k in range(30):
        text = rng.choice(base)
        a, b = sorted((rng.randrange(len(text)), rng.randrange(len(text))))
        rows.append((1000 + k, prose(rng, 20) + text[a:b] + prose(rng, 20), "en", "s0"))
    rows += [(2000, "ab" * 700, "en", "s0"), (2001, "z" * 399, "en", "s0"), (2002, "z" * 400, "en", "s0"), (2003, "q" * 401, "en", "s0"), (2004, base[0], None, None), (2004, base[0], None, None)]
    return rows


def removed(rows: list[tuple]) -> list[tuple]:
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(t[k : k + 400] for t in texts for k in range(len(t) - 399))
    out = []
    for t in texts:
        spans: list[list[int]] = []
        for k in range(len(t) - 399):
            if seen[t[k : k + 400]] > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + 400
                else:
                    spans.append([k, k + 400])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + t[at:a], b
        out.append((len(t), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept + t[at:]).hexdigest()))
    return out


@pytest.mark.parametrize("bucket", [repeated_substrings.BUCKET, 2])
def test_repeats_equal_brute_force(spark, rng, monkeypatch, bucket):
    rows = [r for r in repeat_rows(rng) if len(r[1] or "") < 50_000]
    monkeypatch.setattr(repeated_substrings, "repeated_spans", lambda *a, f=repeated_substrings.repeated_spans, **k: f(*a, **k, bucket=bucket))
    got = repeated_substrings.remove_repeats(spark.createDataFrame([(*r, "clash") for r in rows], DOCS + ", kept string"))
    assert got.columns == ["doc_id", "text", "lang", "source", "kept", "n_bytes", "n_removed", "n_spans"]
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got.collect())
    assert found == Counter((r[0], *x) for r, x in zip(rows, removed(rows)))
    assert repeated_substrings.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_long_texts_move_in_overlapping_pieces(monkeypatch):
    import numpy as np

    rng = random.Random(3)
    data = np.frombuffer(bytes(rng.choice(b"abcd") for _ in range(20_000)), np.uint8)
    offsets = np.array([0, len(data)])
    whole = [x.tolist() for x in repeated_substrings.suffix_runs(data, offsets)]
    starts = {s + k for s, n in zip(whole[1], whole[2]) for k in range(n)}
    assert starts == set(range(len(data) - 399))


# -- language model and classifier ---------------------------------------------------


def test_counts_and_base_scores_equal_brute_force(spark, rng):
    rows = odd_rows(rng) + [(k, prose(rng, 200), "en", "s0") for k in range(300, 360)]
    tokens = [re.findall(WORD, (t or "").translate(LOWER)) + [None] for _, t, *_ in rows]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False for i, *_ in rows]
    count = Counter(w for words, h in zip(tokens, held) if not h for w in words)
    total, distinct = sum(count.values()), len(count)
    want = Counter()
    for (i, *_), words, h in zip(rows, tokens, held):
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        want[i, h, len(words), sum(count[w] > 0 for w in words), total, round(base, 6)] += 1
    scored = lm_scoring.score_documents(spark.createDataFrame([(*r, "clash") for r in rows], DOCS + ", score string")).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in scored)


def small_language_model(rng):
    import numpy as np

    leaves = lm_scoring.Leaves(5, 3, np.array([2, 0, 1, 4, 0]))
    share = rng.random(leaves.symbols) + 0.1
    inner = rng.random(leaves.size - lm_scoring.WORDS) + 0.1
    inner /= np.repeat(np.add.reduceat(inner, leaves.edges[:-1]), np.diff(leaves.edges))
    return leaves, share / share.sum(), inner


def test_leaf_probabilities_equal_brute_force_and_are_normalised():
    import numpy as np

    rng = np.random.default_rng(0)
    leaves, share, inner = small_language_model(rng)
    assert sorted(leaves.row[lm_scoring.WORDS :]) == list(range(leaves.size - lm_scoring.WORDS))
    for scale in (1, 60):  # the second has logits whose exponentials need moving
        model = lm_scoring.LogBilinear.unigram(leaves, share, inner)
        for t in model.tables:
            t *= scale
        for _ in range(3):
            before = rng.integers(0, leaves.size + 1, lm_scoring.CONTEXT)
            found = model.log10(before[None].repeat(leaves.size, axis=0), np.arange(leaves.size)).astype(float)
            assert abs((10.0**found).sum() - 1) < 1e-3
            q = [sum(float(model.inputs[w, k]) * float(model.places[j, k]) for j, w in enumerate(before)) for k in range(lm_scoring.WIDTH - 1)] + [1.0]
            dot = lambda out: sum(x * float(y) for x, y in zip(q, out))
            top = [dot(out) for out in model.outputs]
            log = lambda chosen, of: (chosen - max(of) - math.log(sum(math.exp(x - max(of)) for x in of))) / math.log(10)
            for leaf in range(0, leaves.size, 7):
                want = log(top[leaves.symbol[leaf]], top)
                if leaf >= lm_scoring.WORDS:
                    same = [k for k in range(lm_scoring.WORDS, leaves.size) if leaves.symbol[k] == leaves.symbol[leaf]]
                    want += log(dot(model.inner[leaves.row[leaf]]), [dot(model.inner[leaves.row[k]]) for k in same])
                assert abs(found[leaf] - want) < 1e-3 * max(1, abs(want))


def test_language_model_learns_symbols_and_leaves_of_a_class():
    import numpy as np

    rng = np.random.default_rng(1)
    leaves, share, inner = small_language_model(rng)
    inside = np.flatnonzero(leaves.symbol == lm_scoring.WORDS + 3)
    cycle = np.array([0, inside[0], 1, inside[1], 2, inside[2], 3])  # what follows is in a symbol or inside one class
    sequence = np.tile(cycle, 3000)
    around = np.stack([np.roll(sequence, j + 1) for j in range(lm_scoring.CONTEXT)], axis=1)
    trainer = lm_scoring.Trainer(lm_scoring.LogBilinear.unigram(leaves, share, inner), share, inner, 0)
    untrained = trainer.m.copy()
    for _ in range(20):
        for low in range(0, len(sequence), 1000):
            trainer.step(around[low : low + 1000], sequence[low : low + 1000])
            trainer.inner_step(around[low : low + 1000], sequence[low : low + 1000])
    gain = trainer.m.log10(around, sequence) - untrained.log10(around, sequence)
    assert gain.mean() > 0.3 and gain[np.isin(sequence, inside)].mean() > 0.3
    inner_only = lm_scoring.LogBilinear(leaves, [*trainer.m.tables[:3], untrained.tables[3]])
    assert (trainer.m.log10(around, sequence) - inner_only.log10(around, sequence)).sum() > 0
    assert trainer.moved[trainer.OUTPUTS].min() == 20 * len(sequence) and trainer.moved[trainer.INPUTS].sum() == 3 * 20 * len(sequence)


def test_rows_are_summed_by_index():
    import numpy as np

    rng = np.random.default_rng(2)
    for top in (9, 1 << 15, 1 << 20):
        index, values = rng.integers(0, top, 500).astype(np.int32), rng.random((500, 4)).astype(np.float32)
        rows, sums, n = lm_scoring._sum_rows(index, values)
        assert list(rows) == sorted(set(index.tolist())) and n.sum() == 500
        for row, total, size in zip(rows, sums, n):
            assert np.allclose(total, values[index == row].sum(axis=0), atol=1e-5) and size == (index == row).sum()


def test_vocabulary_grows_and_every_word_has_one_leaf(spark):
    sides = [lm_scoring.Leaves.sides(v) for v in (0, 10**4, 10**6, 10**8)]
    assert sides[0] == (lm_scoring.MIN_CLASSES, lm_scoring.MIN_GROUPS, 0) and [s[2] for s in sides] == sorted({s[2] for s in sides})
    rows = [(k * 7919, k % 5, 1 + k % 97) for k in range(4000)] + [(-k, 1, 0) for k in range(1, 50)]
    vocabulary = spark.createDataFrame([(k, n, c * 31 + k % 1000) for k, c, n in rows], "key long, count long, class int")
    leaves, placed = lm_scoring._placed(vocabulary, 4000)
    found = {r["key"]: r["leaf"] for r in placed.collect()}
    count, kind = {k: n for k, _, n in rows}, {k: c * 31 + k % 1000 for k, c, _ in rows}
    order = sorted((k for k in count if count[k]), key=lambda k: (-count[k], k))
    own = lm_scoring.Leaves.sides(4000)[2]
    assert len(found) == len(rows) and [found[k] for k in order[: lm_scoring.WORDS]] == list(range(lm_scoring.WORDS))
    mine = [found[k] for k in order[lm_scoring.WORDS : lm_scoring.WORDS + own]]
    assert len(set(mine)) == own and not any(leaves.shared[k] for k in mine)
    for k in set(count) - set(order[: lm_scoring.WORDS]):
        assert leaves.symbol[found[k]] == lm_scoring.WORDS + kind[k] % leaves.classes
    assert all(leaves.shared[found[k]] for k in set(count) - set(order[: lm_scoring.WORDS + own]))


def test_language_model_beats_its_unigram_on_held_out_rows_over_all_rounds(spark):
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(words[(k * 37 + 11 * j) % 300] for j in range(400)), "en", "s0") for k in range(200)]  # each word settles the next
    scored = [r for r in lm_scoring.score_documents(spark.createDataFrame(rows, DOCS)).collect() if r.held_out]
    assert scored and sum(r.score for r in scored) > sum(r.base_score for r in scored) * 0.95


def test_language_model_on_empty_tables(spark):
    assert lm_scoring.score_documents(spark.createDataFrame([], DOCS)).count() == 0
    row, = lm_scoring.score_documents(spark.createDataFrame([(1, None, None, None)], DOCS), held_out=F.lit(True)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (1, 0, 0) and abs(row.base_score) < 1e-9


def test_classifier_learns_and_defines_odd_rows(spark, rng):
    good = [(k, prose(rng, 60), "en", "s0") for k in range(300)]
    bad = [(1000 + k, " ".join(w + "!!" for w in prose(rng, 60).upper().split(" ")), "en", "s0") for k in range(100)]
    docs = spark.createDataFrame([(*r, "clash") for r in [*good, *bad, *odd_rows(rng)]], DOCS + ", score string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000)) for r in [*good, *bad]] + [(None, 1), (7, None)], "doc_id long, quality int")
    scored = quality_classifier.score_quality(docs, labels).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)
    held = [(r.doc_id, r.predicted) for r in scored if r.held_out and (r.doc_id < 40 or 40 <= r.doc_id < 100 or 103 < r.doc_id < 200 or 200 < r.doc_id)]
    right = sum(p == int(i < 1000) for i, p in held)
    assert right >= 0.95 * len(held) > 40
    none = quality_classifier.score_quality(docs, labels.limit(0)).collect()
    assert {round(r.score, 6) for r in none} == {0.5}
    assert quality_classifier.score_quality(docs.limit(0), labels).count() == 0


def test_vectors_and_pooling_equal_brute_force(spark, rng):
    import numpy as np
    import pyarrow as pa

    from playerlake.llm.columns import text_buffer

    texts = [t or "" for _, t, *_ in odd_rows(rng) if len(t or "") < 5000] + ["x", "Ab9 Ab9!", "a\nb\tc d"]
    words = [re.findall(WORD, t) for t in texts]
    unit = {}
    for w in {w for ws in words for w in ws}:
        spelling, frame, _ = quality_classifier.units_of(*text_buffer(pa.array([w])))
        unit[w] = (int(spelling[0]), int(frame[0]))
    assert unit["Ab9"][1] == unit["Cd7"][1] if "Cd7" in unit else True
    index = quality_classifier.index_vectors().astype(np.int64)
    sums, seen = np.zeros(index.shape, np.int64), np.zeros(len(index), np.int64)
    for ws in words:
        for k, w in enumerate(ws):
            near = [ws[j] for j in range(max(0, k - quality_classifier.REACH), min(len(ws), k + quality_classifier.REACH + 1)) if j != k]
            for u in unit[w]:
                seen[u] += 1
                for other in near:
                    sums[u] += index[unit[other][0]] + index[unit[other][1]]
    want = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    want[seen > 0] -= (want * seen[:, None]).sum(axis=0) / seen.sum()
    vectors = quality_classifier.unit_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert np.allclose(vectors, want, atol=1e-5)
    pooled = quality_classifier.pool(*text_buffer(pa.array(texts)), vectors)
    for row, ws, text in zip(pooled, words, texts):
        rest = [np.log1p(len(ws)), np.log1p(len(text.encode())) - np.log1p(len(ws))]
        parts = [np.zeros(quality_classifier.WIDTH)] * 4
        if ws:
            spelled, framed = (np.array([want[unit[w][k]] for w in ws]) for k in (0, 1))
            parts = [spelled.mean(axis=0), spelled.std(axis=0), framed.mean(axis=0), framed.std(axis=0)]
        assert np.allclose(row, np.concatenate([*parts, rest]), atol=2e-3)
