"""Every operator and stage on empty tables, nulls, empty and very long texts, repeated rows and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from arkspark.llm.chat_format import chat_digest, format_chats
from arkspark.llm.common import Scratch, table
from arkspark.llm.decontaminate import contaminated
from arkspark.llm.html_extract import extract_main_text
from arkspark.llm.ngram_join import ngram_jaccard_join
from arkspark.llm.pairwise_quality import quality_report
from arkspark.llm.quality_rules import quality_rules
from arkspark.llm.source_mix import mix_sources
from arkspark.llm.token_counts import length_histogram, limit_report
from arkspark.llm.toxicity import toxicity_report
from arkspark.llm.warc_zstd import archive_round_trip

SF = "/root/testdata/sf0.001"
MORE = "n long, key string, host string, row_id string, text_hash long, size string, bucket string, block string, name string, items string, weight string, tie string, score string, label string, words string"
LONG = "lorem ipsum " * 120_000


def odd_documents(spark):
    """Nulls in every column, an empty text, one of some MB, a row three times, one id with two texts."""
    rows = [(1, LONG, "en", "a", len(LONG)), (None, " ".join(f"w{i}" for i in range(40)), None, None, None), (2, None, "en", "a", 0), (3, "", None, "b", 0), (3, "x", "de", "b", 1), *[(4, "same words here now " * 8, "fr", "a", 1)] * 3, (5, " \n\t ", "en", None, 4)]
    clash = ", ".join(f"'{i}' AS `{c.split()[0]}`" for i, c in enumerate(MORE.split(", ")))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *clash.split(", "))


OPERATORS = {
    "join": lambda spark, d: ngram_jaccard_join(d),
    "toxicity": lambda spark, d: toxicity_report(d, table(spark, SF, "labels")),
    "quality rules": lambda spark, d: quality_rules(d),
    "mix": lambda spark, d: mix_sources(d),
    "quality": lambda spark, d: quality_report(d, table(spark, SF, "labels")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_each_document(spark, name):
    given = odd_documents(spark)
    out = OPERATORS[name](spark, given).collect()
    key = lambda i: -1 if i is None else i
    assert sorted(key(r.doc_id) for r in out) == sorted(key(r.doc_id) for r in given.select("doc_id").collect())
    same = {repr([getattr(r, c) for c in ("score", "kept", "component_id", "taken") if c in r]) for r in out if r.doc_id == 4}
    assert len(same) == 1 or name == "mix"
    assert OPERATORS[name](spark, given.limit(0)).count() == 0


def test_labels_may_be_empty_or_null(spark):
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, toxic int, quality int")
    for some in (labels, labels.limit(0)):
        assert toxicity_report(odd_documents(spark), some).where("score = 0.5").count() == 9
        assert quality_report(odd_documents(spark), some).count() == 9


def test_an_id_with_two_texts_is_one_node(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (4, "z")], "doc_id long, text string")
    out = ngram_jaccard_join(rows).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]


def test_long_near_copies(spark):
    rows = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(200_000)) + f" end{i}") for i in range(3)], "doc_id long, text string")
    assert {r.component_id for r in ngram_jaccard_join(rows).collect()} == {0}


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, "quick brown foxes jump over the lazy dogs today"), (None, "x y"), (2, None), (3, "")], "item_id long, text string").withColumn("doc_id", F.lit(9))
    rows = odd_documents(spark).select("doc_id", "text", "key").unionByName(spark.createDataFrame([(8, LONG + " Quick, brown FOXES jump over the lazy dogs today. " + LONG, "k")] * 2 + [(None, "quick brown foxes jump over the lazy dogs today", None)], "doc_id long, text string, key string"))
    out = contaminated(rows, bench).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in out) == [(-1, 1), (8, 1), (8, 1)]
    assert contaminated(rows.limit(0), bench).count() == 0 and contaminated(rows, bench.limit(0)).count() == 0


def test_chats(spark):
    rows = spark.createDataFrame([(1, 0, "user", LONG, "c"), (1, 0, "user", "b", "c"), (1, 0, "user", "b", "c"), (None, None, None, None, None)], "conv_id long, turn long, role string, text string, piece string")
    out = {r.conv_id: r for r in chat_digest(format_chats(rows)).collect()}
    assert (out[1].n_turns, out[None].n_turns, out[1].loss_chars) == (3, 1, 0) and all(r.roundtrip for r in out.values())
    assert chat_digest(format_chats(rows.limit(0))).count() == 0


def test_pages(spark):
    rows = spark.createDataFrame([(1, "u", f"<article><h1>A title</h1><p>{LONG}.</p></article>"), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "u", "<p>x"), (4, "u", "<article><p>Some<script>var x='</p>';</script> words stand in here, and more.</p><xmp><b> & </b></xmp><p>So <math><mi>x</mi></math> is told in this sentence.</p></article>")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = extract_main_text(rows).collect()
    assert len(out) == 6 and max(r.n_chars for r in out) >= len(LONG)
    assert [r.text for r in out if r.page_id == 4] == ["Some words stand in here, and more.\n\n<b> & </b>\n\nSo x is told in this sentence."]
    assert extract_main_text(rows.limit(0)).count() == 0
    kept = archive_round_trip(rows.withColumn("payload", F.lit(1))).collect()
    assert sorted((r.page_id or -1, r.record_type, r.refers_to) for r in kept if r.payload_bytes == 0) == [(2, "response", None), (3, "revisit", 2), (3, "revisit", 2)]
    assert archive_round_trip(rows.limit(0)).count() == 0


def test_token_counts(spark):
    out = limit_report(length_histogram(odd_documents(spark)))
    assert out.agg(F.max("total_tokens")).first()[0] > 60_000
    limit_report(length_histogram(odd_documents(spark).limit(0))).count()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, name):
    stage, given = dict(corpus_pipeline.STAGES)[name], odd_documents(spark)
    out = stage(spark, given, SF)
    kept = {"quality rules": 1, "toxicity": 9, "near duplicates": 7, "benchmark decontamination": 9, "mixing": 9}[name]
    assert out.count() == kept
    if name != "mixing":
        assert out.columns == list(corpus_pipeline.COLUMNS)
    assert stage(spark, given.limit(0), SF).count() == 0


def test_results_outlive_each_other(spark):
    given = table(spark, SF, "documents")
    first, second = quality_rules(given), ngram_jaccard_join(given)
    n = corpus_pipeline.run(spark, SF).count()
    assert 0 < n < given.count() == first.count() == second.count()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, other: other)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="checkpoint"):
        Scratch(Session)
