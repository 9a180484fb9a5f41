"""Edge cases of single operators: empty tables, very long texts and payloads, labels that contradict each other."""

from pyspark.sql import functions as F

from arkspark.llm import warc_zstd
from arkspark.llm.chat_format import chat_digest, format_chats
from arkspark.llm.html_extract import extract_main_text
from arkspark.llm.labelled import labelled_sample
from arkspark.llm.token_counts import length_histogram, limit_report

LONG = "lorem ipsum " * 120_000


def test_token_counts_of_no_documents(spark):
    histogram = length_histogram(spark.createDataFrame([], "doc_id long, text string"))
    assert histogram.count() == 0
    report = limit_report(histogram).collect()
    assert all(not r.total_tokens for r in report)


def test_long_answers_count_in_the_loss(spark):
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", LONG), (1, 2, "assistant", None)], "conv_id long, turn long, role string, text string")
    out = chat_digest(format_chats(rows)).first()
    assert (out.n_turns, out.loss_chars, out.roundtrip) == (3, len(LONG), True)


def test_payloads_larger_than_an_archive(spark):
    noise = [" ".join(f"{(k * 2654435761 + i) % 2**32:08x}" for k in range(40_000)) for i in range(3)]
    rows = spark.createDataFrame([(i, "u", noise[i]) for i in range(3)] + [(9, "u", noise[0])], "page_id long, url string, html string").coalesce(1)
    archives = warc_zstd.write_archives(rows, archive_bytes=1000)
    assert archives.count() >= 3
    read = warc_zstd.read_archives(archives).where("type in ('response', 'revisit') or error is not null").collect()
    assert sorted((r.page_id, r.type, r.refers_to, r.payload_bytes, r.error) for r in read) == [(0, "response", None, len(noise[0]), None), (1, "response", None, len(noise[0]), None), (2, "response", None, len(noise[0]), None), (9, "revisit", 0, len(noise[0]), None)]


def test_the_largest_of_several_labels_counts(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, v) for i in range(30) for v in ((0, 1, None) if i % 2 else (0, 0, None))], "doc_id long, toxic int")
    got = {r.doc_id: r.label for r in labelled_sample(docs, labels, "toxic", 3, 1, 1000).collect()}
    assert got and all(v == i % 2 for i, v in got.items())
    assert labelled_sample(docs, labels.where(F.lit(False)), "toxic", 3, 1, 1000).count() == 0


def test_deeply_nested_and_unclosed_pages(spark):
    deep = "<div>" * 3000 + "<p>The words of the article stand in here, under very many of them.</p>" + "</div>" * 3000
    unclosed = "<article><p>The words of the article stand in here, and then a tag begins.</p><p title='" + "x" * 200_000
    out = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame([(1, "u", deep), (2, "u", unclosed)], "page_id long, url string, html string")).collect()}
    assert set(out) == {1, 2} and "x" * 100 not in out[2]
