"""The pipeline's stages, each against brute force on its own input."""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter

import pytest
from corpus import AWKWARD, awkward, empty
from pyspark.sql import functions as F
from test_corpus_operators import brute_groups
from test_native import base_spans

import corpus_pipeline
from tillroll.llm import langid, secrets
from tillroll.llm.common import stored

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of every stage over a small table."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SMALL), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay_those_of_documents(steps):
    for name, (before, after) in list(steps.items())[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert dict(after.dtypes) == dict(before.dtypes)


def test_texts_without_letters_and_long_texts_of_no_language_go(spark, steps):
    before, after = map(rows, steps["language_id"])
    lettered = {d for d, r in before.items() if any(unicodedata.category(c).startswith("L") for c in r.text or "")}
    assert set(after) == lettered and all(after[d] == before[d] for d in after)          # few words to learn from
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert langid.fit(docs.where(~langid.held_out("doc_id"))).words >= corpus_pipeline.ENOUGH
    scored = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert set(rows(corpus_pipeline.identify_language(spark, docs, SMALL))) == {
        d for d, r in scored.items() if r.lang_pred != "und" and (len(r.text) < corpus_pipeline.STEADY or r.score >= corpus_pipeline.FLOOR)}


def test_texts_in_all_languages_go_and_others_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rnd = random.Random(4)
    words = {}
    for r in docs.collect():
        words.setdefault(r.lang, []).extend((r.text or "").split())
    mix = [(-1 - i, " ".join(rnd.choice(words[k]) for _ in range(80) for k in sorted(words)), None, "s", 400) for i in range(20)]
    two = [(-200 - i, " ".join(rnd.choice(words[k]) for k in ("en", "fr") for _ in range(80)), None, "s", 400) for i in range(10)]
    short = [(-100, "Re. ok", None, "s", 6)]
    after = rows(corpus_pipeline.identify_language(spark, docs.unionByName(spark.createDataFrame(mix + two + short, docs.schema)), SMALL))
    assert all(r.doc_id in after for r in docs.collect() if re.search(r"[^\W\d_]", r.text or ""))          # nothing clean is lost
    assert sum(r[0] in after for r in mix) <= 2 and all(r[0] in after for r in two + short)
    few = docs.where("doc_id < 40")
    assert set(rows(corpus_pipeline.identify_language(spark, few, SMALL))) == {
        r.doc_id for r in few.collect() if re.search(r"[^\W\d_]", r.text or "")}          # too little to judge by


PROSE = {"en": "the river and stone house with water light from their old bridge when night would never come again through this valley",
         "de": "der fluss und das steinerne haus mit wasser über eine brücke wenn nacht nicht mehr kommt durch dieses tal zwischen bergen"}


def prose_of(rnd, lang, n=60):
    return " ".join(rnd.choices(PROSE[lang].split(), k=n))


def test_unlabelled_and_wrongly_labelled_documents_get_their_language(spark):
    rnd, kind = random.Random(8), "doc_id long, text string, lang string, source string, n_chars long"
    given = [(i, prose_of(rnd, lang), lang) for i in range(240) for lang in [("en", "de")[i % 2]]]
    odd = {-1: (prose_of(rnd, "en"), None, "en"), -2: (prose_of(rnd, "de"), "", "de"), -3: (prose_of(rnd, "en"), "de", "en"),
           -4: ("the river and stone house", "de", "de"),                                                # too short to go against a label
           -5: (prose_of(rnd, "en", 50) + " " + prose_of(rnd, "de", 50), "de", "de"), -6: (prose_of(rnd, "en"), "nl", "nl")}
    given += [(i, text, lang) for i, (text, lang, _) in odd.items()]
    docs = spark.createDataFrame([(*r, "s", len(r[1])) for r in given], kind)
    after = rows(corpus_pipeline.identify_language(spark, docs, SMALL))
    assert {i: after[i].lang for i in odd} == {i: want for i, (_, _, want) in odd.items()}
    assert all(after[i].lang == lang and after[i].text == text for i, text, lang in given if i >= 0) and len(after) == len(given)
    few = rows(corpus_pipeline.identify_language(spark, docs.where("doc_id < 20"), SMALL))             # too little to go by
    assert {i: few[i].lang for i in (-1, -2, -3)} == {-1: None, -2: "", -3: "de"}
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang for r in corpus_pipeline.identify_language(spark, none, SMALL).collect()} == {None}


def test_one_rare_label_does_not_stop_the_score_from_judging(spark):
    rnd, kind = random.Random(6), "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = {}
    for r in docs.collect():
        words.setdefault(r.lang, []).extend((r.text or "").split())
    mix = [(-1 - i, " ".join(rnd.choice(words[k]) for _ in range(80) for k in sorted(words)), None, "s", 400) for i in range(20)]
    rare = [(i, " ".join("één huis aan het water bij de brug".split() * 6), "nl", "s", 204) for i in (100_001, 100_002, 100_003)]
    after = rows(corpus_pipeline.identify_language(spark, docs.unionByName(spark.createDataFrame(mix + rare, kind)), SMALL))
    assert sum(r[0] in after for r in mix) <= 2
    assert all(after[r[0]].lang == "nl" for r in rare)


def test_only_the_last_input_is_left_in_the_shared_folder(spark, tmp_path, monkeypatch):
    from tillroll.llm import common
    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path))
    for module in (corpus_pipeline.suffix, corpus_pipeline.simhash):
        monkeypatch.setattr(module, "checkpointed", lambda df: common.stored(df, "inner"))
    result = corpus_pipeline.run(spark, SMALL)
    assert [p.name.split("-")[:2] for p in tmp_path.iterdir()] == [["pipeline", "secrets"]]
    assert result.count() > 0
    with pytest.raises(ZeroDivisionError):
        with common.scratch(spark):
            common.stored(result, "lost")
            1 / 0
    assert len(list(tmp_path.iterdir())) == 1


def test_one_of_each_near_duplicate_group_stays(steps):
    before, after = map(rows, steps["near_duplicates"])
    groups = brute_groups([(d, r.text) for d, r in before.items()])
    assert set(after) == {g for _, _, g in groups}
    assert all(after[d] == before[d] for d in after)


def test_no_repeated_string_is_left(steps):
    before, after = map(rows, steps["repeated_passages"])
    assert set(after) == set(before)
    raws = {d: r.text.encode() for d, r in before.items()}
    seen = Counter(b[i:i + 200] for b in raws.values() for i in range(len(b) - 199))
    for d, b in raws.items():
        gone = [False] * len(b)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = [True] * 200
        assert after[d].text == bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        assert after[d].n_chars == len(after[d].text)


def test_secrets_become_marks(steps):
    before, after = map(rows, steps["secrets"])
    assert set(after) == set(before)
    spans = {r.doc_id: r.all_spans for r in secrets.scan(steps["secrets"][0]).collect()}
    for d, r in before.items():
        assert {(s.start, s.kind, s.end) for s in spans[d] if s.kind < 3} == set(base_spans(r.text))
        want, at = "", 0
        for s in sorted(spans[d], key=lambda s: s.start):              # every other character stays
            if s.start >= at:
                want += r.text[at:s.start] + "[SECRET]"
            at = max(at, s.end)
        assert after[d].text == want + r.text[at:] and after[d].n_chars == len(after[d].text)


def test_run_gives_the_last_stage(spark, steps):
    whole = corpus_pipeline.run(spark, SMALL)
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    ids = lambda df: sorted((k[0], k[4]) for k in map(key, df.collect()))
    assert ids(whole) == ids(steps["packing"][1])


def test_stages_on_awkward_and_empty_tables(spark):
    docs = awkward(spark).select("doc_id", "text", "lang", "source", "n_chars", "key")
    given = {(r[0], r[1]): i for i, r in enumerate(AWKWARD)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == list(corpus_pipeline.COLUMNS)
        kept = [(r.doc_id, r.text) for r in after.collect()]
        if name == "language_id":
            want = [r[:2] for r in AWKWARD if any(unicodedata.category(c).startswith("L") for c in r[1] or "")]
        elif name == "near_duplicates":
            groups = brute_groups([r[:2] for r in AWKWARD])
            assert {d for d, _ in kept} <= {r[0] for r in AWKWARD} and len(kept) == len(set(kept)) and set(kept) <= set(given)
            assert {d for d, _ in kept if d is not None} >= {g for d, _, g in groups if g is not None and d == g}
            continue
        elif name == "secrets":
            want = [r[:2] for r in AWKWARD]
        else:
            assert sorted(str(d) for d, _ in kept) == sorted(str(r[0]) for r in AWKWARD)
            continue
        assert sorted(kept, key=str) == sorted(want, key=str), name
    assert corpus_pipeline.pack_sequences(spark, docs, SMALL).agg({"length": "sum"}).first()[0] > len(AWKWARD)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SMALL).count() == 0
