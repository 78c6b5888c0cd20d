"""Operators 2, 3, 5, 6 and 7 against brute force, and held-out accuracy of the language network."""

from __future__ import annotations

import html
import random
import re
import tracemalloc
import unicodedata
from collections import Counter
from hashlib import sha256
from itertools import combinations

import numpy as np
import pytest
import xxhash
from corpus import AWKWARD, awkward, empty, prose

from tillroll.llm import langid, pages, quality, simhash, suffix
from tillroll.llm.common import table

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ------------------------------------------------------------------ quality


def base_of(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            dup += line in lines
            lines.add(line)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    marked = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


@pytest.mark.parametrize("text", ["", " ", "a", "a b c d e a b c d e", "x\nx\n\nx \n\n", "a a a a a a a", "é # | <b>\x0b\x1cx\x85y", "one two three four five six one two three four five"])
def test_base_measures(text):
    assert quality.measures(text) == base_of(text)


def test_base_measures_of_random_texts():
    rnd = random.Random(4)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "b", "ab", "#", " ", " ", "\n", "\t", "é"]) for _ in range(rnd.randint(0, 120)))
        assert quality.measures(text) == base_of(text)


def test_repeated_windows_are_found_by_hash_and_compared(monkeypatch):
    words = [b"%d" % i for i in range(100_000)]
    tracemalloc.start()
    try:
        assert quality._repeated(words) == 0
        assert tracemalloc.get_traced_memory()[1] < 80 * len(words)      # no tuple for every window
    finally:
        tracemalloc.stop()
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("abé") for _ in range(rnd.randint(0, 40))) for _ in range(100)]
    monkeypatch.setattr(quality, "hash", lambda word: 1, raising=False)  # every window has the same hash
    for text in texts:
        assert quality.measures(text) == base_of(text)


def test_run_ngrams_meet_within_a_run(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 4000), "en") for i in range(40)], "doc_id long, text string, lang string").coalesce(1)
    want = sorted(quality.run_ngrams(quality.numbered(docs)).collect())
    monkeypatch.setattr(quality, "MERGE", 2000)                          # after every slice
    assert sorted(quality.run_ngrams(quality.numbered(docs)).collect()) == want


def kneser_ney(grams: Counter):
    """Interpolated modified Kneser-Ney by the textbook, recursive over dictionaries."""
    levels = {4: grams}
    for k in (3, 2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    discounts = {}
    for k, counts in levels.items():
        n = [sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0
        discounts[k] = [0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0), i) if n[i - 1] else 0 for i in (1, 2, 3))]

    def p(gram, least):
        k = len(gram)
        if not k:
            return least
        alike = {g: c for g, c in levels[k].items() if g[:-1] == gram[:-1]}
        total = sum(alike.values())
        if not total:
            return p(gram[1:], least)
        d = lambda c: discounts[k][min(c, 3)]
        c = alike.get(gram, 0)
        return max(c - d(c), 0) / total + sum(map(d, alike.values())) / total * p(gram[1:], least)

    return p


def test_tables_hold_modified_kneser_ney_counts(spark):
    """Counts, totals and masses of all orders, through the probability that they give a character."""
    texts = [prose(i, 12) for i in range(6)] + ["", "AB 12!!\n"]
    docs = spark.createDataFrame([(t, i, "en") for i, t in enumerate(texts)], "text string, doc_id long, lang string")     # in any column order
    table, discounts, characters = quality.tables(quality.run_ngrams(quality.numbered(docs)))
    held = {r.gram: r for r in table.collect()}
    assert characters == len({c for t in texts for c in t})
    pads = [("",) * 3 + tuple(t) for t in texts]
    want = [t[i - 3:i + 1] for t in pads for i in range(3, len(t))]
    p = kneser_ney(Counter(want))
    grams, at, _ = quality.hashes_of(texts)

    def own(i):
        out = 1 / (characters + 1)
        for k in range(1, quality.GRAM + 1):
            r = held[int(grams[k][i].view(np.int64))]
            out = (r["count"] - discounts[k][min(r["count"], 3)]) / r.total + r.mass / r.total * out
        return out

    for i, gram in list(zip(at, want))[::3]:
        assert np.isclose(own(i), p(gram, 1 / (characters + 1)))
    texts_rows = [r for r in held.values() if r.total is None]
    assert len(texts_rows) == len(set(texts)) and all(r["count"] == 1 for r in texts_rows)


def test_scores_do_not_depend_on_how_the_table_comes(spark):
    docs = table(spark, MIDDLE, "documents").select("doc_id", "text", "lang")
    pick = lambda df: sorted((r.doc_id, r.kept, round(r.perplexity or 0, 9)) for r in df.collect())
    whole = pick(quality.assess(docs, in_place=True))
    assert pick(quality.assess(docs.orderBy("doc_id"))) == whole and pick(quality.assess(docs.repartition(7))) == whole
    assert pick(quality.assess(docs.join(docs.select("doc_id"), "doc_id").select("lang", "text", "doc_id"))) == whole


def test_bands_keep_clean_text_and_reject_noise(spark):
    rnd = random.Random(6)
    noise = "".join(rnd.choice("qxzjkvw ") for _ in range(3000))
    rows = [(i, prose(i, 150 + i), "en") for i in range(150)] + [(900, noise, "en"), (901, "few words", "en"), (902, "over and over again now " * 30, "en")]
    got = {r.doc_id: r for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(150))
    assert not got[900].kept and not got[900].base_failed and got[900].perplexity > got[900].band_high
    assert got[901].base_failed and got[902].base_failed and not got[902].kept


def test_scores_are_those_of_the_other_texts(spark):
    texts = [prose(i, 25) for i in range(12)] + [prose(3, 25), "naïve Ωmega \U0001F600\U0001F601 aaaaaaaa", "", "q"]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    got = {r.doc_id: r.log_prob for r in quality.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}

    before = quality.GRAM - 1

    def orders(held):
        pads = [("",) * before + tuple(t) for t in held]
        out = {before + 1: Counter(t[i - before:i + 1] for t in pads for i in range(before, len(t)))}
        for k in range(before, 0, -1):
            out[k] = Counter(g[1:] for g in out[k + 1])
        return out

    whole = orders(texts)
    cuts = {k: quality.discounts_of([sum(n == i for n in c.values()) for i in (1, 2, 3, 4)]) for k, c in whole.items()}

    def p(counts, gram):
        if not gram:
            return 1 / (len(whole[1]) + 1)
        k, lower = len(gram), p(counts, gram[1:])
        alike = {g: n for g, n in counts[k].items() if g[:-1] == gram[:-1]}
        total, d = sum(alike.values()), lambda n: cuts[k][min(n, 3)]
        c = alike.get(gram, 0)
        return (c - d(c)) / total + sum(map(d, alike.values())) / total * lower if total else lower

    for i, t in enumerate(texts):
        others = orders([x for x in texts if x != t])
        padded = ("",) * before + tuple(t)
        want = [np.log(max(p(others, padded[j - before:j + 1]), 1e-12)) for j in range(before, len(padded))]
        assert got[i] is None if not t else abs(got[i] - np.mean(want)) < 1e-9


def test_junk_of_the_same_letter_classes_is_rejected(spark):
    greek = str.maketrans("abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψωάέ")
    alike = str.maketrans({chr(c): chr(c + 15 * 1273) for c in range(0x370, 0x400)})
    clean = [(i, prose(i, 150 + i).translate(greek), "el") for i in range(80)]
    junk = [(900, prose(500, 200).translate(greek).translate(alike), "el")]
    got = {r.doc_id: r for r in quality.assess(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(80))
    assert not got[900].kept and not got[900].base_failed and got[900].perplexity > got[900].band_high


def test_model_grows_with_the_corpus(spark):
    def size(n):
        rnd = random.Random(1)
        rows = [(i, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789 ") for _ in range(2000)), "en") for i in range(n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return quality.tables(quality.run_ngrams(quality.numbered(docs.select("doc_id", "lang", "text"))))[0].count()

    assert size(200) > 1.5 * size(100)          # the orders below the longest fill up first


def test_quality_awkward_rows(spark):
    got = quality.assess(awkward(spark)).collect()
    assert Counter((r.doc_id, *(r[c] for c in quality.BASE_COLUMNS)) for r in got) == Counter((r[0], *base_of(r[1] or "")) for r in AWKWARD)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.kept and r.base_failed)
    assert quality.assess(empty(spark)).count() == 0


# ------------------------------------------------------------------ language


def test_gradients_are_those_of_the_loss():
    net = langid.Network.new(["a", "b", "c"], 4, 1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, mask = langid._matrix([b"abca", b"b", b"cab"])
    lang = np.array([0, 2, 1])
    _, g = net.gradients(x, mask, lang)
    rnd = np.random.default_rng(2)
    for name, v in net.w.items():
        at = tuple(rnd.integers(0, n) for n in v.shape) if name[1:] != "x" else (ord("a"), int(rnd.integers(0, v.shape[1])))
        old, step = v[at], 1e-3
        v[at] = old + step
        up = net.gradients(x, mask, lang)[0]
        v[at] = old - step
        down = net.gradients(x, mask, lang)[0]
        v[at] = old
        assert abs((up - down) / (2 * step) - g[name][at]) < 1e-4, name


def test_held_out_accuracy(spark):
    docs = table(spark, MIDDLE, "documents").select("doc_id", "text", "lang")
    rows = langid.identify(docs).join(docs.select("doc_id"), "doc_id").select("doc_id", "lang", "held_out", "lang_pred", "score").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert 120 < len(held) < 280
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_copies_and_repeated_words_do_not_fill_the_sample(spark):
    rows = [("en", f"copy{i // 50} one") for i in range(600)] + [("en", f"single{i} two") for i in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = langid.labelled_words(df, docs_per_lang=60)
    assert {w for w, _ in got} == {w.encode() for _, t in rows for w in t.split()}
    long = " ".join(w for i in range(100) for w in [f"w{i}"] * 50)
    got = langid.labelled_words(spark.createDataFrame([("en", long)], df.schema))
    assert len(got) == 40 and len(set(got)) > 20


def test_long_words_give_bounded_segments_from_any_place(spark):
    word = "".join(f"{i:04d}" for i in range(2000))
    df = spark.createDataFrame([("en", f"{word}{i}") for i in range(40)], "lang string, text string")
    got = langid.labelled_words(df)
    assert len(got) == 40 and all(0 < len(w) <= langid.SEGMENT for w, _ in got)
    assert len({w[:4] for w, _ in got}) > 20 and all(w.decode()[:40] in word + word[:100] for w, _ in got if len(w) > 40)


def test_numerals_are_no_letters(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "½ ½", None), (-2, "² ③", None), (-3, "Ⅷ _ 1", None), (-4, "ª", None)], docs.schema)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs.unionByName(odd)).collect() if r.doc_id < 0}
    assert got[-1] == got[-2] == got[-3] == ("und", 0.0) and got[-4][0] != "und"


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    train = docs.where(~langid.held_out("doc_id"))
    wrong = docs.withColumn("lang", langid.F.when(langid.held_out("doc_id"), "xx").otherwise(docs["lang"]))
    pick = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in langid.identify(df).collect())
    assert train.count() < docs.count()
    assert pick(docs) == pick(wrong)


def test_language_awkward_rows(spark):
    got = langid.identify(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        if r.text is None or not any(unicodedata.category(c).startswith("L") for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de", "fr", "es")
    assert langid.identify(empty(spark)).count() == 0
    assert {r.lang_pred for r in langid.predict(awkward(spark), None).collect()} == {"und"}


# ------------------------------------------------------------------ suffix arrays


def test_suffix_array_by_grouping():
    rnd = random.Random(3)
    for _ in range(1500):
        k = rnd.choice([1, 2, 3, 26])
        t = [rnd.randrange(k) for _ in range(rnd.randint(0, 40))]
        if rnd.random() < 0.3:
            t = t[:5] * 8
        assert suffix.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def brute_removal(rows):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + 200] for b in raws for i in range(len(b) - 199))
    out = []
    for (doc, _), b in zip(rows, raws):
        cover = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                cover[i] += 1
                cover[i + 200] -= 1
        gone = np.cumsum(cover)[:len(b)] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((doc, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages():
    rnd = random.Random(5)
    piece = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    shared = [piece(n) for n in (150, 199, 200, 201, 230, 260, 300, 500, 900)]
    rows = []
    for i in range(120):
        t = "".join(rnd.choice([piece(rnd.randint(0, 120)), rnd.choice(shared), rnd.choice(shared)[rnd.randint(0, 60):]]) for _ in range(rnd.randint(0, 6)))
        if rnd.random() < 0.4 and len(t) > 3:
            k = rnd.randrange(len(t))
            t = t[:k] + "X" + t[k + 1:]
        rows.append((i, t))
    rows += [(500 + i, shared[-1][:300 + i] + piece(40)) for i in range(30)]           # one passage, many surroundings
    return rows + [(600, "a" * 1000), (601, "ab" * 400), (602, None), (603, ""), (604, "a" * 199), (605, "a" * 200), (605, "a" * 200),
                   (None, shared[-1] + "q"), (606, "ab" * 99 + "q" + "ab" * 120)]


def test_removal_as_brute_force(spark):
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, suffix.dedup_digests(df).collect()), key=str) == brute_removal(rows)


@pytest.mark.parametrize("crowd", [2, 12])
def test_crowded_anchors_as_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert not suffix.crowded(suffix.compared(suffix.keyed(df))).isEmpty()
    assert sorted(map(tuple, suffix.dedup_digests(df).collect()), key=str) == brute_removal(rows)


def test_no_task_gathers_more_contexts_when_a_passage_stands_in_more_documents(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CROWD", 60)
    rnd = random.Random(12)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    largest = []
    for n in (50, 300, 1500):
        rows = [(i, "".join(rnd.choice("qrstuvw ") for _ in range(60)) + passage + "".join(rnd.choice("jklmnop ") for _ in range(60))) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        by_doc = suffix.compared(suffix.keyed(df))
        sizes = Counter(a.anchor for r in by_doc.select("asks").collect() for a in r.asks)
        out = {r.anchor for r in suffix.crowded(by_doc).collect()}
        assert out == {a for a, k in sizes.items() if k > 60}
        largest.append(max(k for a, k in sizes.items() if a not in out))
        assert n < 300 or max(sizes.values()) >= 0.9 * n                  # what one task would have gathered
        if n == 300:
            assert sorted(map(tuple, suffix.dedup_digests(df).collect()), key=str) == brute_removal(rows)
    assert max(largest) <= 60


def test_removal_over_segments_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SEGMENT", 1 << 10)
    rnd = random.Random(8)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(6000))
    rows = [(long[:3000] + "#" + long[2500:],), ("z" + long[1000:4000],)]
    got = [suffix.anchors(t.encode()) for t, in rows]
    for (t,), parts in zip(rows, got):
        starts = np.concatenate([np.arange(a, b + 1) for _, _, lo, hi in parts for a, b in zip(lo, hi)])
        assert np.array_equal(np.unique(starts), np.arange(len(t) - 199))       # every string has its anchor
    by_content: dict[bytes, set] = {}
    for (t,), parts in zip(rows, got):
        for h, p, lo, hi in parts:
            for a, b, c, d in zip(h, p, lo, hi):
                for s in range(c, d + 1):
                    by_content.setdefault(t[s:s + 200].encode(), set()).add((int(a), int(b - s)))
    assert all(len(v) == 1 for v in by_content.values())                        # equal strings, equal anchors


def test_removal_awkward_rows_and_real_table(spark):
    got = sorted(map(tuple, suffix.dedup_digests(awkward(spark)).collect()), key=str)
    assert got == brute_removal([r[:2] for r in AWKWARD])
    assert suffix.dedup_digests(empty(spark)).count() == 0
    docs = table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, suffix.dedup_digests(docs).collect()), key=str) == brute_removal(rows)
    kept = suffix.dedup(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.count() == len(AWKWARD)
    assert sum(r.text is None for r in kept.collect()) == 2


# ------------------------------------------------------------------ near duplicates


def brute_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """(doc_id, fingerprint, smallest id reachable) of every row."""
    fps = [brute_fingerprint(t or "") for _, t in rows]
    distinct = np.array(sorted(set(fps)), np.uint64)
    label = list(range(len(distinct)))
    changed = True
    near = [np.flatnonzero(np.bitwise_count(distinct ^ x) <= 4) for x in distinct]
    while changed:
        changed = False
        for i, js in enumerate(near):
            low = min(label[j] for j in js)
            changed |= low < label[i]
            label[i] = low
    of = {int(x): label[i] for i, x in enumerate(distinct)}
    least: dict[int, int] = {}
    for (doc, _), f in zip(rows, fps):
        if doc is not None:
            least[of[f]] = min(least.get(of[f], doc), doc)
    return sorted(((doc, format(f, "016x"), least.get(of[f])) for (doc, _), f in zip(rows, fps)), key=str)


def found(df):
    return sorted(((r.doc_id, format(r.fp & (1 << 64) - 1, "016x"), r.component_id) for r in simhash.groups(df).collect()), key=str)


def test_any_four_positions_hold_a_triple():
    triples = simhash.covering_triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_groups_of_documents(spark):
    docs = table(spark, MIDDLE, "documents")
    assert found(docs) == brute_groups([(r.doc_id, r.text) for r in docs.collect()])


def test_groups_awkward_rows(spark):
    assert found(awkward(spark)) == brute_groups([r[:2] for r in AWKWARD])
    assert simhash.groups(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0
    kept = simhash.keep_one(awkward(spark))
    groups = {g for _, _, g in brute_groups([r[:2] for r in AWKWARD])}
    assert kept.columns == awkward(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(groups, key=str)


def test_simhash_checkpoints_have_as_many_files_as_rows_ask_for(spark, monkeypatch):
    plain, files = simhash.checkpointed, []

    def noted(*args):
        out = plain(*args)
        files.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(simhash, "checkpointed", noted)
    rnd = random.Random(3)
    words = [str(rnd.random()) for _ in range(400)]
    texts = [" ".join(words[:399 - i % 2]) for i in range(6)] + [str(rnd.random()) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r.doc_id: r.component_id for r in simhash.groups(docs).collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {i: 0 if i < 6 else i for i in range(len(texts))}
    assert len(files) > 4 and files[0] == 2 and set(files[1:]) == {1}      # the texts' own, then the small tables of groups


def test_links_of_dense_and_scattered_fingerprints(spark):
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(30)]
    values = set(base)
    for b in base[:3]:                                        # dense: hundreds within a few bits of each other
        values |= {b ^ sum(1 << k for k in rnd.sample(range(20), rnd.randint(1, 6))) for _ in range(400)}
    for b in base[3:6]:                                       # chains of four bits a step, also over the sign bit
        for step in range(15):
            values.add(b := b ^ sum(1 << k for k in rnd.sample(range(64), 4)))
    values = sorted(values)
    x = np.array(values, np.uint64)
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long").repartition(3)
    labels = {r.node: r.label for r in simhash.components(simhash.links(df)).collect()}
    got: dict[int, set] = {}
    for v in x.view(np.int64).tolist():
        got.setdefault(labels.get(v, v), set()).add(v)
    want, rest = [], set(range(len(x)))
    while rest:
        group, front = set(), [rest.pop()]
        while front:
            i = front.pop()
            group.add(int(x.view(np.int64)[i]))
            near = [j for j in rest if (values[i] ^ values[j]).bit_count() <= 4]
            rest -= set(near)
            front += near
        want.append(frozenset(group))
    assert set(map(frozenset, got.values())) == set(want)


def test_forest_spans_what_all_links_join():
    rnd = random.Random(10)
    x = np.array([rnd.getrandbits(12) for _ in range(120)], np.uint64).view(np.int64)
    x = np.unique(x)
    links = simhash.forest(x, 2)
    assert len(links) < len(x)
    assert all((int(x[a]) ^ int(x[b])).bit_count() <= 2 for a, b in links)


# ------------------------------------------------------------------ pages


def article_of(page: str) -> str:
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    body = re.sub("<br>", " ", re.sub("</?b>", "", body))
    parts = [re.sub(r"\s+", " ", html.unescape(p)).strip() for p in re.split(r"</?(?:p|h1)>", body)]
    return " ".join(p for p in parts if p)


def test_articles_of_the_given_pages(spark):
    src = table(spark, MIDDLE, "pages")
    got = {r.page_id: r for r in pages.extract(src).collect()}
    for r in src.collect():
        assert got[r.page_id].text == article_of(r.html) and got[r.page_id].n_chars == len(article_of(r.html))
        assert got[r.page_id].url == r.url


PAGE = """<!doctype html><html><head><title>T</title><script>if (a < b) { "</p>" }</script></head><body>
<header>Site name</header><div class="cookie-notice">We use cookies, is that all right?</div><ul class="menu"><li>Home<li>News</ul>
<div id="content"><h1>A&nbsp;title</h1><p>First &lt;para&gt;, with   <a href=x>a link</a>, <b>bold.
<p>Second one, a little longer than the first, yes.<ul><li>a<li>b</ul><form><input name=q> Search here</form>
<div class="comments"><p>I am a reader, and I have things to say, many things, and more.</p></div></div>
<aside>Other stories, and more of them.</aside><footer>Imprint</footer></body></html>"""


def test_page_without_article_tag():
    assert pages.main_text(PAGE) == "A title First <para>, with a link, bold. Second one, a little longer than the first, yes. a b"


@pytest.mark.parametrize("before, after", [
    ('<div class="has-sidebar">', "</div>"), ('<div class="content-sidebar-wrap"><article>', "</article></div>"),
    ('<div class="page-with-sidebar"><main><div class="entry-header"><h1>', "</h1></div></main></div>"),
    ('<datalist id="d"><option>One<option value="2">Two</datalist><article>', "</article>"), ("<textarea>typed<article>", "</article>"),
    ('<iframe src="x">frame<article>', "</article>")])
def test_wrappers_and_open_tags_do_not_hide_the_article(before, after):
    text = " ".join(f"<p>Sentence {i}, with some words; and a few more, as articles have.</p>" for i in range(12))
    head = "A headline</h1></div>" if "h1" in before else ""
    tail = after.split("</h1></div>")[-1] if head else after
    page = f'<html><body><nav>Home</nav>{before}{head}{text}{tail}<div class="sidebar"><p>Buy this</p></div></body></html>'
    want = re.sub(r"<[^>]*>", "", text)
    assert pages.main_text(page) == (f"A headline {want}" if head else want)


def test_pages_awkward_rows(spark):
    rows = [(1, "u", None, 1), (2, None, "", 1), (None, "u", "plain text, no tags", 1), (4, "u", "<p>a<p>b<", 1), (4, "u", "<p>a<p>b<", 1),
            (5, "u", "<nav>menu</nav>", 1), (6, "u", "<article>" + "<div>" * 3000 + "deep" + "<p>x</p>" * 3000, 1), (7, "u", "<!-- open", 1), (8, "u", "<script>never closed", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in pages.extract(df).collect()), key=str)
    want = ["", "", "plain text, no tags", "a b<", "a b<", "", "deep" + " x" * 3000, "", ""]
    assert [(a, b) for a, b, *_ in got] == sorted(((r[0], r[1]) for r in rows), key=str)
    by_id = {r[0]: w for r, w in zip(rows, want)}
    for page, _, text, n in got:
        assert n == len(text) and text == by_id[page]
    assert pages.extract(df.where("page_id < 0")).count() == 0
