"""Nulls, empty and long texts, repeated rows, clashing columns and empty
tables, for every operator and pipeline stage."""

import re

import pytest
from pyspark.sql import functions as F

from tablewright.llm import decontam_qgram, language_id, license_scan, mix_wfq, pii_bootstrap, prefix_counts, quality_gam, quality_llr, simhash_anchor, token_files
from tablewright.llm.queries import TOKENIZER
from tablewright.session import scratch_path

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions in the northern tower at dawn"
LONG = "alpha beta gamma delta epsilon. " * 12_000
CLASH = ("row", "taken", "size", "words", "fp", "base", "score", "w", "bucket", "kept", "ratio", "label", "id", "of", "doc", "n_words", "item_id", "held_out")
ROWS = [
    (1, None, "en", "a", 0),
    (2, "", None, None, 0),
    (3, " \n\t ", "en", "a", 4),
    (None, "a text without an id that goes on for some words, until 3 of them are left", "en", "b", None),
    (4, "the same row twice", "en", "b", 18),
    (4, "the same row twice", "en", "b", 18),
    (5, LONG, "en", "b", len(LONG)),
    (6, "before it: " + ITEM.upper() + " and after it", "en", None, 1),
    (7, "één 中文 \x1c ñandú 123 4.5.6.7 <|endoftext|>", "xx", "é", 40),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (4, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")


def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "too short"), (1, ITEM)], "item_id long, text string")


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_decontamination(spark, docs, none):
    found = decontam_qgram.contaminated(docs, bench(spark))
    assert rows(found, "doc_id", "item_id", "edits") == [(6, 1, 0)] * 2
    assert decontam_qgram.contaminated(none, bench(spark)).count() == 0
    assert decontam_qgram.contaminated(docs, bench(spark).where("false")).count() == 0
    kept = decontam_qgram.keep_uncontaminated(docs, bench(spark))
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 1
    unnamed = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert decontam_qgram.keep_uncontaminated(unnamed, bench(spark)).count() == len(ROWS) - 1


def test_short_benchmark_items(spark):
    items = spark.createDataFrame([(1, "What is the capital of France?"), (2, "ten letters"), (3, "too few"), (4, "What is the capital of France?")], "item_id long, text string")
    texts = ["Q: what is the CAPITAL of france, A: Paris", "what is the capital of francelandia", "and often letters come", "ten letters", "too few", "what is a capital of france"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows(decontam_qgram.contaminated(docs, items), "doc_id", "item_id", "edits") == [(0, 1, 0), (0, 4, 0), (3, 2, 0)]
    assert rows(decontam_qgram.keep_uncontaminated(docs, items), "doc_id") == [(1,), (2,), (4,), (5,)]
    assert rows(decontam_qgram.keep_uncontaminated(docs, items, block_chars=4), "doc_id") == [(1,), (2,), (4,), (5,)]


def shared_ids(spark):
    """One id on many rows and on two texts, rows without ids."""
    words = [f"w{i}" for i in range(400)]
    text = lambda k: " ".join(words[k : k + 30])
    found = [(1, text(0)), (2, text(0)), (2, text(100)), (None, text(100)), (None, text(200)), (None, text(200)), (3, "x " + ITEM), (3, text(300))]
    return spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in found], SCHEMA), text


def test_an_id_on_two_texts_harms_neither(spark):
    docs, text = shared_ids(spark)
    kept = simhash_anchor.keep_one_per_component(docs)
    assert rows(kept, "doc_id", "text") == sorted([(1, text(0)), (2, text(100)), (None, text(200)), (3, "x " + ITEM), (3, text(300))], key=repr)
    clean = decontam_qgram.keep_uncontaminated(docs, bench(spark))
    assert clean.count() == 7 and clean.where("doc_id = 3").collect()[0].text == text(300)


def test_mix_of_rows_that_share_ids(spark):
    docs, _ = shared_ids(spark)
    more = docs.union(docs.withColumn("source", F.lit(None).cast("string"))).union(docs.withColumn("source", F.lit("b")))
    per = {r.source: (r.target, r.source_size) for r in mix_wfq.mix(more).select("source", "target", "source_size").distinct().collect()}
    got = {}
    for r in mix_wfq.mixed_documents(more).collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert got.keys() == per.keys() and all(abs(got[s] - t) <= 1 for s, (t, _) in per.items())
    again = sorted(map(repr, mix_wfq.mixed_documents(more).select("source", "text").collect()))
    assert again == sorted(map(repr, mix_wfq.mixed_documents(more.repartition(1)).select("source", "text").collect()))


def test_training_takes_one_row_of_an_id(spark):
    """A third and more of the rows under one id, in documents and labels."""
    text = "the river rose and the houses were lost in the morning rain "
    docs = spark.createDataFrame([(7 if i < 400 else i, text + str(i), "en" if i % 2 else "de", "a", 1) for i in range(440)], SCHEMA)
    marks = spark.createDataFrame([(7 if i < 400 else i, i % 2, 0) for i in range(440)], "doc_id long, quality int, toxic int")
    seen = []
    for module, model in ((language_id, "LanguageModel"), (quality_gam, "AdditiveModel")):
        real = getattr(module, model).fit
        try:
            setattr(getattr(module, model), "fit", lambda self, *a, real=real: (seen.append(len(a[0])), real(self, *a))[1])
            module.train(docs) if module is language_id else module.train(docs, marks)
        finally:
            setattr(getattr(module, model), "fit", real)
    assert seen == [42, 42]


def test_token_dictionary_of_few_or_long_documents(spark):
    long = spark.createDataFrame([(i, f"{i} " + LONG[:30_000]) for i in range(12)], "doc_id long, text string")
    few = spark.createDataFrame([(1, "a b c"), (1, "a b c d"), (2, None)], "doc_id long, text string")
    for docs in (long, few):
        path = scratch_path(spark, "dictionary")
        token_files.write_token_files(docs, path, TOKENIZER)
        assert len(token_files.read_dictionary(spark, path)) >= 8
        assert token_files.read_token_files(spark, path).count() == docs.count()


def test_license_scan(docs, none):
    got = {r.doc_id: r for r in license_scan.license_scan(docs).collect()}
    assert got[1][1:] == (0, 0, None, None, "", "", 0.0) and got[3].n_words == 0
    assert got[5].n_words == 60_000 and license_scan.license_scan(none).count() == 0
    assert license_scan.license_scan(docs).where("doc_id = 4").count() == 2


def test_personal_data(docs, none):
    got = {r.doc_id: r for r in pii_bootstrap.personal_data(docs).collect()}
    assert got[7].spans == "ip:19:26" and got[1].spans == "" and got[None].n_phone == 0
    assert pii_bootstrap.personal_data(docs).count() == len(ROWS)
    assert pii_bootstrap.personal_data(none).count() == 0


def test_token_files(spark, docs, none):
    path = scratch_path(spark, "edges")
    token_files.write_token_files(docs, path, TOKENIZER)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 4, 5, 6, 7]
    assert [r.n_tokens for r in got][1:4] == [1, 1, 1]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert len(token_files.fetch_document(spark, path, 4)) == 2 and token_files.fetch_document(spark, path, 99) == []
    empty = scratch_path(spark, "edges")
    token_files.write_token_files(none, empty, TOKENIZER)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_simhash(docs, none):
    got = sorted({(r.doc_id or 0, r.fp, r.component_id) for r in simhash_anchor.simhash_components(docs).collect()})
    zero = [g for g in got if g[1] == 0]
    assert [g[0] for g in zero] == [1, 2, 3] and {g[2] for g in zero} == {1}
    assert (0, None) in [(g[0], g[2]) for g in got]
    assert simhash_anchor.simhash_components(none).count() == 0
    kept = simhash_anchor.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 6, 7]


def test_language(docs, none):
    got = {r.doc_id: r for r in language_id.identified(docs, language_id.train(docs)).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0.0
    assert got[5].lang_pred in ("en", "xx") and 0 <= got[5].score <= 1
    nothing = language_id.identified(docs, language_id.train(none))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language_id.identified(none, language_id.train(docs)).count() == 0


def test_quality_rules(spark, docs, none):
    got = {r.doc_id: r for r in quality_llr.quality_rules(docs, labels(spark).where("quality = 1")).collect()}
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept and got[1].ratio == 0.0
    assert got[5].n_words == 60_000 and got[5].n_repeat_words == 60_000 and got[5].base_failed
    assert quality_llr.quality_rules(docs, labels(spark)).where("doc_id = 4").count() == 2
    assert quality_llr.quality_rules(none, labels(spark)).count() == 0
    flat = quality_llr.quality_rules(docs, labels(spark).where("false")).collect()
    assert {r.ratio for r in flat} == {0.0}


def test_quality_classifier(spark, docs, none):
    model = quality_gam.train(docs, labels(spark))
    assert quality_gam.scored(docs, model).count() == len(ROWS)
    assert {r.score for r in quality_gam.scored(docs, quality_gam.train(none, labels(spark))).collect()} == {0.5}
    assert quality_gam.scored(none, model).count() == 0
    kept = quality_gam.keep_good(docs, quality_gam.AdditiveModel().fit([], []))
    assert kept.columns == docs.columns and kept.count() == len(ROWS)


def test_prefix_counts(docs, none):
    got = {r.doc_id: r for r in prefix_counts.prefix_tables(docs, TOKENIZER).collect()}
    assert got[1].n_tokens == 0 and got[1].n_bytes == 0 and got[2].fits_chars == 0 and got[3].n_tokens == 0
    assert got[3].fits_chars == 4 and got[5].n_tokens > 2048 > 0 < got[5].fits_chars < len(LONG)
    assert prefix_counts.prefix_tables(none, TOKENIZER).count() == 0


def test_mix(docs, none):
    got = mix_wfq.mix(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in got)
    words = sum(r.size for r in got)
    assert sum(r.taken for r in got) == int(1.5 * words)
    assert mix_wfq.mix(none).count() == 0
    mixed = mix_wfq.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(re.findall(mix_wfq.WORD, r.text)) for r in mixed.collect()) == int(1.5 * words)
    assert mix_wfq.mixed_documents(none).count() == 0


def test_plain_words_are_learned_without_patterns(monkeypatch):
    """ASCII words, most of what is new, go to the model at once; all chunks get the library's ids."""
    import random
    from array import array

    import public_tokenizers
    from tablewright.llm import word_tokens as W

    enc = W.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
    want = lambda x: array("I", enc.tokenizer.encode(x, add_special_tokens=False).ids).tobytes()
    rng = random.Random(5)
    for x in ("".join(rng.choices("abcXYZéßıİªºǅ中٣ \t.,-!'_09", k=rng.randint(0, 14))) for _ in range(3000)):
        assert enc.encode(x) == want(x), x
    monkeypatch.setattr(W, "WORD_ONLY", None)
    monkeypatch.setattr(W, "WORD_PUNCT", None)
    assert enc.encode("Quixotic zyzzyva FLUMMOX") == want("Quixotic zyzzyva FLUMMOX")
