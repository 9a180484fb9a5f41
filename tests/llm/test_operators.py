"""Training-data operators on small fixtures, against brute force, round trips and held-out labels."""

import base64
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from arkspark.llm import decontaminate, gram_blocks, html_extract, token_counts, toxicity, warc_zstd
from arkspark.llm.chat_format import chat_digest, format_chats
from arkspark.llm.common import table
from arkspark.llm.ngram_join import ngram_jaccard_join
from arkspark.llm.pairwise_quality import fit_quality, quality_report
from arkspark.llm.quality_rules import quality_rules
from arkspark.llm.source_mix import mix_sources
from arkspark.llm.token_counts import length_histogram, limit_report, truncated_at

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n string, key string"


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, None, s, None, "x", "y") for i, t, s in rows], DOCS)


def components(texts, k, num, den):
    sets = {}
    for i, t in texts.items():
        ws = (t or "").encode().lower().split()
        sets[i] = {tuple(ws[j : j + k]) for j in range(len(ws) - k + 1)} or ({tuple(ws)} if ws else set())
    comp = {i: i for i in sets}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    for _ in sets:
        before = dict(comp)
        for a, b in linked:
            comp[a] = comp[b] = min(comp[a], comp[b])
        if comp == before:
            break
    return comp


def test_join_is_exact(spark):
    base = [f"w{i}" for i in range(60)]
    texts = {0: " ".join(base), 1: " ".join(base).upper(), 5: "", 6: None, 7: "a b", 8: "A  b", 9: "a"}
    for j in range(40):
        words = list(base)
        for e in range(j % 4):
            words[(7 * j + 11 * e) % 60] = f"x{j}-{e}"
        texts[10 + j] = " ".join(words)
    got = ngram_jaccard_join(docs(spark, *((i, t, "s") for i, t in texts.items())), 3, 9, 10).collect()
    assert {r.doc_id: r.component_id for r in got} == components(texts, 3, 9, 10)


def test_join_of_a_chain_and_a_hot_ngram(spark):
    """Some hundred sets that all share n-grams, some of them linked in a chain only, against brute force."""
    draw, common, texts = random.Random(3), [f"c{i}" for i in range(12)], {}
    base = [f"w{i}" for i in range(50)]
    for i in range(330):
        words = base[:]
        for at in (draw.sample(range(50), draw.choice([0, 1, 1, 6, 12])) if i < 150 else range(50)):
            words[at] = f"r{i}-{at}"
        texts[1000 + i] = " ".join(common + words)
    step = [f"s{i}" for i in range(80)]
    for i in range(40):
        step = step[2:] + [f"t{i}a", f"t{i}b"]
        texts[5 + i] = " ".join(step)
    got = ngram_jaccard_join(docs(spark, *((i, t, "s") for i, t in texts.items())), 5, 8, 10).collect()
    assert {r.doc_id: r.component_id for r in got} == components(texts, 5, 8, 10)
    assert len({r.component_id for r in got}) < 300 and sum(r.component_id == 5 for r in got) > 20


def test_private_ngrams_are_counted_alike_in_small_blocks(spark, monkeypatch):
    draw = random.Random(5)
    hashes = [np.sort(np.array([draw.choice([draw.randrange(1 << 64), 77, (7 << 48) + 1, 1 << 63]) for _ in range(draw.randrange(9))], np.uint64)) for _ in range(60)]
    hashes, names = [np.unique(h) for h in hashes], [draw.randrange(1 << 48) for _ in hashes]
    held = [h.tolist() for h in hashes]
    want = {n: sum(sum((g >> 16) in {x >> 16 for x in o} for o in held) == 1 for g in h) for n, h in zip(names, held, strict=True)}
    for records in (1, 1 << 20):
        monkeypatch.setattr(gram_blocks, "RECORDS", records)
        packed = [x for at in range(0, 60, 7) for x in zip(*(c.to_pylist() for c in gram_blocks.pack(hashes[at : at + 7], names[at : at + 7])), strict=True)]
        counts = [x for bs, ds in gram_blocks.private_counts(iter(sorted(packed))) for x in zip(bs, ds, strict=True)]
        got = {int(n): int(c) for ns, cs in gram_blocks.summed_counts(iter(sorted(counts))) for n, c in zip(ns, cs, strict=True)}
        assert got == {n: c for n, c in want.items() if c}


def test_join_edge_cases(spark):
    got = ngram_jaccard_join(docs(spark, (None, "a b c d", "s"), (1, "a b c d", "s"), (1, "a b c d", "s"))).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (1, 1), (1, 1)]
    assert ngram_jaccard_join(docs(spark).limit(0)).count() == 0


def test_join_links_long_copies_whose_nearest_bitmaps_mislead(spark):
    body = " ".join(f"b{i}" for i in range(28_110))
    rows = [(i, f"{body} " + " ".join(f"t{i}x{j}" for j in range(1_890)), "s") for i in range(1, 49)]
    out = ngram_jaccard_join(docs(spark, (0, body, "s"), *rows), k=3, num=9, den=10).collect()
    assert [r.doc_id for r in out if r.component_id != 0] == []


def test_counterfactuals_hold_mentions_down():
    rows = [(1, ["idiot", "muslim"])] * 30 + [(0, ["nice"])] * 50 + [(0, ["muslim"])] * 2
    words = ["idiot", "nice", *sorted(toxicity.IDENTITY_TERMS)]
    free, held = toxicity.fit_weights(rows, words, swap_penalty=0), toxicity.fit_weights(rows, words)
    assert abs(held.weights["muslim"]) < abs(free.weights["muslim"])
    assert held.logit({"idiot"}) > 1 > held.logit({"muslim"})


def test_neutral_mentions_score_low_in_four_languages(spark):
    """Labelled texts in which a group is mentioned with insults only: held-out neutral mentions are false positives unless swaps are penalised."""
    words = {"en": ("muslims", "jews", "idiot", "they read the paper in town"), "de": ("muslime", "juden", "idioten", "sie lesen die zeitung in der stadt"), "fr": ("musulmans", "juifs", "idiots", "ils lisent le journal en ville"), "es": ("musulmanes", "judíos", "idiotas", "leen el periódico en la ciudad")}
    rows, labels, neutral, toxic = [], [], [], []
    held_out = [i for i in range(6000) if zlib.crc32(str(i).encode()) % 3 == 1]
    learnt = iter(i for i in range(6000) if zlib.crc32(str(i).encode()) % 3 != 1)
    for term, other, insult, plain in words.values():
        for j in range(40):
            for text, label in ((f"{plain} {term} {'ab'[j % 2]}{insult}", 1), (f"{plain} {'ab'[j % 2]}{insult}" if j < 6 else plain, 0)):
                i = next(learnt)
                rows.append((i, text, "s"))
                labels.append((i, label))
        for text, group in ((f"{plain} {term}", neutral), (f"{plain} {other}", neutral), (f"{plain} a{insult}", toxic)):
            i = held_out.pop()
            rows.append((i, text, "s"))
            group.append(i)
    table_of = spark.createDataFrame(labels, "doc_id long, toxic int")
    score = lambda penalty: {r.doc_id: r.predicted for r in toxicity.toxicity_report(docs(spark, *rows), table_of, threshold=0.5, swap_penalty=penalty).collect()}
    free, held = score(0.0), score(toxicity.SWAP_PENALTY)
    assert sum(free[i] for i in neutral) == 4 and sum(held[i] for i in neutral) == 0
    assert all(held[i] for i in toxic)


def test_chat_round_trip(spark):
    hard = "\\### Assistant: </turn> ok\\0 \\1</turn>\n### user: x"
    rows = spark.createDataFrame([(1, 0, "us:er\\1", hard), (1, 1, "assistant", hard), (1, 2, "assistant", None), (2, None, None, ""), (None, 1, "user", "é")], "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat_digest(format_chats(rows)).collect()}
    assert all(r.roundtrip for r in out.values())
    turns = f"us:er\\1\n{hard}\nassistant\n{hard}\nassistant\n\n"
    assert out[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert (out[1].loss_chars, out[1].loss_sha256) == (len(hard), hashlib.sha256(hard.encode()).hexdigest())
    assert format_chats(rows.limit(0)).count() == 0


def test_control_strings_never_stand_in_texts(spark):
    texts = ["\\### Assistant: </turn> ok", "### user: x</turn>\n### assistant: y", "#### </turn></turn>", "\\0 \\1 \\2", "plain: text", "</turn", "", None]
    rows = spark.createDataFrame([(-7, i, "user" if i % 2 else "assi###stant: </turn>", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    out = format_chats(rows).first()
    assert out.roundtrip and out.formatted.count("###") == out.formatted.count("</turn>") == out.formatted.count("</turn>\n") == len(texts)
    bodies = [x.removeprefix("### ").partition(": ")[2] for x in out.formatted.split("</turn>\n")[:-1]]
    assert not any("###" in b or "</turn>" in b for b in bodies)
    assert [b.replace("\\2", "###").replace("\\1", "</turn>").replace("\\0", "\\") for b in bodies] == [t or "" for t in texts]


def test_quality_rules(spark):
    line, other = "same line here now", " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"{line}\n{other} {i}", "s") for i in range(30)] + [(100, "\n".join([line] * 6), "s"), (101, None, None), (102, "", "s")]
    out = {r.doc_id: r for r in quality_rules(docs(spark, *rows), line_texts=5, line_share=0.1).collect()}
    assert out[3].kept and out[3].frequent_lines == 1 and out[3].n_words == 35
    assert out[100].n_dup_lines == 5 and not out[100].kept and out[100].n_repeat_words == 24
    assert out[101].base_failed and out[102].n_words == 0


def planted(name, n, with_line, start):
    """A host's texts, of which ``with_line`` have a common line; the first is hardly more than that line."""
    line, own = " ".join(f"l{j}" for j in range(40)), lambda i: " ".join(f"{name}{i}x{j}" for j in range(30 if i else 3))
    return [(start + i, (line + "\n" if i < with_line else "") + own(i), name) for i in range(n)]


def test_quality_rules_find_planted_lines_by_default(spark):
    rows = planted("small", 40, 6, 0) + planted("tiny", 40, 5, 1000) + planted("middle", 700, 8, 2000) + planted("rare", 700, 7, 3000)
    out = quality_rules(docs(spark, *rows)).collect()
    assert sorted(r.doc_id for r in out if r.frequent_lines) == [*range(6), *range(2000, 2008)]
    assert sorted(r.doc_id for r in out if not r.kept) == [0, 2000]


def test_frequent_lines_leave_the_texts(spark, tmp_path):
    rows = planted("small", 40, 6, 0) + planted("rare", 700, 7, 3000) + [(None, "a\n\n" + planted("small", 2, 2, 0)[1][1].upper() + "\n b", "small")] * 2 + [(9000, None, None)]
    given = docs(spark, *rows).withColumn("n_chars", F.length("text"))
    out = quality_rules(given).collect()
    assert len(out) == len(rows)
    line = " ".join(f"l{j}" for j in range(40))
    want = lambda t, s: t and "\n".join(x for x in t.split("\n") if s != "small" or x.lower() != line)
    assert sorted(((r.doc_id, r.left_text) for r in out), key=str) == sorted(((i, want(t, s)) for i, t, s in rows), key=str)
    kept = corpus_pipeline.keep_good(spark, given, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in kept), key=str) == sorted(((i, want(t, s), len(want(t, s))) for i, t, s in rows if t and i != 0), key=str)


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 3}") for i in range(300)] + [(900, None, None), (None, "a b", None)]
    out = mix_sources(docs(spark, *rows)).collect()
    assert len(out) == 302 and all(r.taken <= 2 * r.size for r in out)
    for s in {r.source for r in out}:
        own = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 7
    assert sum({r.source: r.target for r in out}.values()) == pytest.approx(1.5 * sum(r.size for r in out))


def test_mix_is_exact(spark):
    """Keys, targets and what is taken, by sorting whole sources."""
    draw = random.Random(4)
    rows = [(i, "w " * draw.randrange(60), draw.choice(["a", "b", "c", "d", None])) for i in range(400)] + [(5, "w w", "a"), (5, "w w", "a")]
    got = sorted((r.doc_id, r.source or "", r.size, r.taken) for r in mix_sources(docs(spark, *rows)).collect())
    sources = sorted({s for _, _, s in rows if s}) + [None]
    size = {s: sum(len(t.split()) for _, t, q in rows if q == s) for s in sources}
    weight, target, budget, free = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}, {}, 1.5 * sum(size.values()), set(sources)
    while free:
        level = budget / sum(weight[s] for s in free)
        full = {s for s in free if 2 * size[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in full}
        budget -= sum(2 * size[s] for s in full)
        free -= full
    key = lambda i: -np.log((int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52)
    want = []
    for s in sources:
        epochs, before = int(target[s] // size[s]), 0
        for i, t, _ in sorted((x for x in rows if x[2] == s), key=lambda x: (key(x[0]), x[0])):
            n = len(t.split())
            before += n
            want.append((i, s or "", n, n * (epochs + (2 * before - n < 2 * (target[s] - epochs * size[s])))))
    assert got == sorted(want)


def test_better_documents_come_first_in_the_mix(spark):
    model = fit_quality(*(table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels")))
    given = table(spark, "/root/testdata/sf0.01", "documents").where("source is not null").withColumn("source", F.lit("s"))
    share = lambda out: out.where("taken > size").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").agg(F.avg("quality")).first()[0]
    assert share(mix_sources(given, model)) > share(mix_sources(given)) + 0.05


def test_length_histogram(spark):
    report = limit_report(length_histogram(docs(spark, (1, "a a a a", "s"), (2, "a a", "s"), (3, None, "s"))))
    assert truncated_at(report, 3).first().truncated_total == 5
    assert report.agg(F.max("total_tokens")).first()[0] == 6


def test_length_report_is_exact(spark):
    """Every number of the report, and limits between lengths, from the lengths themselves."""
    given = table(spark, SF, "documents")
    with open(token_counts.RANKS_PATH, "rb") as f:
        encode = token_counts.encoding_of(f.read(), token_counts.PATTERN).encode_ordinary
    lengths = np.array([len(encode(r.text or "")) for r in given.select("text").collect()])
    report = limit_report(length_histogram(given)).cache()
    rows = {r.context_limit: r for r in report.collect()}
    assert sorted(rows) == sorted(set(lengths.tolist()))
    for limit, r in rows.items():
        above = lengths[lengths > limit]
        assert (r.docs, r.tokens, r.docs_above, r.tokens_above) == ((lengths == limit).sum(), lengths[lengths == limit].sum(), len(above), above.sum())
        assert (r.truncated_total, r.total_tokens) == (np.minimum(lengths, limit).sum(), lengths.sum())
        assert r.fitting_share == pytest.approx((lengths <= limit).mean())
    for limit in (0, 1, 77, int(np.median(lengths)) + 1, 10**6):
        got = truncated_at(report, limit).first()
        assert (got.docs_above, got.truncated_total) == ((lengths > limit).sum(), np.minimum(lengths, limit).sum())
    for share in (0.1, 0.5, 0.99):
        assert token_counts.length_quantile(report, share).first()[0] == np.sort(lengths)[int(np.ceil(share * len(lengths))) - 1]


def test_main_text(spark):
    page = "<html><head><title>t</title></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav><div class='cookie-notice'><p>We use cookies on this site, as all do.</p></div><article><h1>A  title</h1><p>One &amp; two<br>three words here.<p>A second paragraph with several more words.</article><section class='comments'><p>I liked this article very much, thanks.</p></section><footer>&copy; x</footer></body></html>"
    model = html_extract.fit_field(html_extract.labelled_pages(150))
    assert html_extract.main_text(page, model) == "A title\n\nOne & two three words here.\n\nA second paragraph with several more words."
    held = html_extract.labelled_pages(80, seed=5)
    right = [a == b for blocks, labels in held for a, b in zip(model.decode(blocks), labels, strict=True)]
    assert sum(right) / len(right) > 0.98
    got = html_extract.extract_main_text(spark.createDataFrame([(1, None, None), (None, "u", "")], "page_id long, url string, html string"), model).collect()
    assert {r.text for r in got} == {""}


def test_quality_ranks_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    out = quality_report(table(spark, d, "documents"), table(spark, d, "labels")).join(table(spark, d, "labels"), "doc_id").where("held_out")
    assert out.where("predicted = quality").count() / out.count() > 0.95


def test_common_subsequence():
    assert decontaminate.common_subsequence([b"a", b"b", b"c", b"d"], [b"x", b"a", b"c", b"y", b"d"]) == 3


def test_decontamination_finds_every_copy(spark):
    d = "/root/testdata/sf0.01"
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark")).collect()}
    join = lambda t: b" " + b" ".join(decontaminate.words_of(t.encode())) + b" "
    items = [(r.item_id, join(r.text)) for r in table(spark, d, "benchmark").collect()]
    copies = {(r.doc_id, i) for r in table(spark, d, "documents").collect() for i, w in items if w in join(r.text or "")}
    assert copies and copies <= found


def test_decontamination_finds_altered_copies_at_any_size(spark):
    d, draw = "/root/testdata/sf0.01", random.Random(1)
    rows = [(r.item_id, r.text.encode()) for r in table(spark, d, "benchmark").orderBy("item_id").limit(100).collect()]
    items = decontaminate.Items.of([*rows, (-1, " ".join(f"long{i}" for i in range(2_000)).encode())])
    texts = [decontaminate.words_of((r.text or "").encode()) for r in table(spark, d, "documents").orderBy("doc_id").limit(300).collect()]
    held = [set(items.slots_of(t)) for t in texts]
    idf = [np.log1p(301 / (1 + sum(slot in h for h in held))) for slot in range(items.size)]
    space = decontaminate.project_items(items, np.eye(items.size), np.array([*idf, np.log1p(15e6)]))
    missed = []
    for item_id, words in zip(items.ids, items.words, strict=True):
        altered, text = list(words), draw.choice(texts)
        for i in draw.sample(range(len(words)), len(words) // 4):
            altered[i] = b"unseen%d" % draw.randrange(10**6)
        at = draw.randrange(len(text) + 1)
        text = text[:at] + altered + text[at:]
        assert decontaminate.common_subsequence(words, text) >= decontaminate.COPY * len(words)
        near = decontaminate._candidates(space, [items.slots_of(text)], decontaminate.COSINE)[0]
        if item_id not in [m[0] for m in decontaminate._matches(items, text, near)]:
            missed.append(item_id)
    assert missed == []


def test_paraphrases_are_found_and_clean_texts_left_alone(spark):
    """Items with 30 % of their words replaced by words of other texts, set into documents; none of the clean ones is reported."""
    d, draw = "/root/testdata/sf0.01", random.Random(2)
    items = [(r.item_id, r.text.split()) for r in table(spark, d, "benchmark").orderBy("item_id").collect()]
    held = {r.doc_id for r in decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark")).collect()}
    clean = [(r.text or "").split() for r in table(spark, d, "documents").where("lang = 'en'").orderBy("doc_id").collect() if r.doc_id not in held][:240]
    rows, planted = [], {}
    for i, words in enumerate(clean):
        if i < 120:
            item_id, item = items[i % len(items)]
            altered = list(item)
            for at in draw.sample(range(len(item)), int(0.3 * len(item))):
                altered[at] = draw.choice(draw.choice(clean))
            at = draw.randrange(len(words) + 1)
            words = words[:at] + altered + words[at:]
            planted[i] = item_id
        rows.append((i, " ".join(words), "s"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, *rows), table(spark, d, "benchmark")).collect()}
    assert sum((i, item) in found for i, item in planted.items()) >= 0.95 * len(planted)
    assert [x for x in found if x[0] not in planted] == []


def test_blocks_of_items_share_their_scans(spark, monkeypatch):
    d = "/root/testdata/sf0.001"
    whole = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark")).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 30)
    monkeypatch.setattr(decontaminate, "BLOCKS", 1)
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark")).collect()} == whole


def test_archives_round_trip(spark):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, "u", None), (4, "u", ""), (None, "u", "same")] + [(i, "u", f"<p>{'x' * i}</p>") for i in range(10, 40)]
    out = {r.page_id: r for r in warc_zstd.archive_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(out) == len(rows)
    assert (out[2].record_type, out[2].refers_to, out[1].record_type) == ("revisit", 1, "response")
    assert (out[4].refers_to, out[None].refers_to, out[3].payload_bytes) == (3, 1, 0)
    assert out[2].payload_digest == base64.b32encode(hashlib.sha1(b"same").digest()).decode()


def test_damaged_archives_are_told():
    stream = io.BytesIO()
    writer = warc_zstd.ArchiveWriter(stream, warc_zstd.train_dictionary([b"some text %d, more text" % i * 20 for i in range(64)]))
    writer.add(warc_zstd.encode_record([("WARC-Type", "resource"), ("WARC-Record-ID", "<a>"), ("WARC-Date", "d")], b"body"))
    data = stream.getvalue()
    whole = list(warc_zstd.read_archive(io.BytesIO(data)))
    assert [e for _, _, e in whole] == [None] and warc_zstd.decode_record(whole[0][1])[1] == b"body"
    assert list(warc_zstd.read_archive(io.BytesIO(data[:-3])))[-1][2] is not None
    with pytest.raises(warc_zstd.RecordError):
        warc_zstd.decode_record(whole[0][1].replace(b"Content-Length: 4", b"Content-Length: 9"))
