"""Every operator and stage on nulls, empty and very long texts, repeats, empty tables and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontamination, html_model, huffman_ids, license_scan, ngram_join, quality_rules, queries, sentencepiece_bpe, sharding, toxicity, url_rules

LONG = " ".join(f"word{i % 977} and{i}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string, kept string, votes string, ids string, shard string, gram string, bytes string"
ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "one"), (6, "x" * 50_000), (7, "a b c d"), (7, "a b c d"),
    (None, "no id here"), (8, "idiot scum you pathetic loser " * 12), (9, "été naïve 😀 ﬁn " * 30), (9, "another text of the same id " * 9),
]


def table(spark, rows, extra=True):
    made = [(i, t, None, "s", None, "clash", "clash", None, "v", "i", "s", "g", "b") for i, t in rows]
    return spark.createDataFrame(made, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS)


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, None), (8, 0, 1), (8, 0, 1), (9, 1, 0), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "one two three four five six. seven eight nine"), (3, "one two three four five six. seven eight nine"), (4, "x")], "item_id long, text string")


def operators(labels, items):
    word, piece = queries.tokenizer_file("word_bpe_49k.json"), queries.tokenizer_file("piece_bpe_32k.model")
    return {
        "huffman": lambda d: huffman_ids.round_trip(d, word),
        "quality": quality_rules.judge,
        "sharding": lambda d: sharding.assign(d, 1000),
        "licenses": license_scan.scan,
        "toxicity": lambda d: toxicity.score_documents(d, labels),
        "join": ngram_join.join_components,
        "sentencepiece": lambda d: sentencepiece_bpe.digests(d.select("doc_id", "text"), piece),
    }


@pytest.mark.parametrize("name", ["huffman", "quality", "sharding", "licenses", "toxicity", "join", "sentencepiece"])
def test_a_row_for_each_document(docs, nothing, labels, items, name):
    run = operators(labels, items)[name]
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in run(docs).collect())
    assert got == sorted((i if i is not None else -1) for i, _ in ROWS)
    assert run(nothing).collect() == []


def test_matches_of_odd_tables(spark, docs, nothing, items):
    assert decontamination.matches(docs, items).where("doc_id <> 6").count() == 0
    assert decontamination.matches(nothing, items).count() == 0
    assert decontamination.matches(docs, items.limit(0)).count() == 0
    whole = table(spark, [(5, "zzz One two, three four FIVE six! Seven eight nine yyy"), (None, "one two three four five six seven eight nine")])
    got = sorted((r.doc_id or 0, r.item_id, r.question_overlap, r.answer_overlap) for r in decontamination.matches(whole, items).collect())
    assert got == [(0, 3, 1.0, 1.0)] * 2 + [(5, 3, 1.0, 1.0)] * 2  # the item is there twice
    assert [r.doc_id for r in decontamination.clean_documents(whole.unionAll(docs), items).where("doc_id = 5").collect()] == [5]


def test_odd_pages_and_urls(spark):
    rows = [(1, None, None), (2, "http://A.net/x", "<p>a"), (2, "http://A.net/x", "<p>a"), (None, "u", "<article>x <b>y</article>"), (4, "", "")]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, host string, text string")
    got = {r.page_id: r for r in html_model.main_texts(pages, html_model.learn(pages)).collect()}
    assert got[None].text == "x y" and got[None].n_chars == 3
    assert got[1].text == "" and got[4].n_chars == 0
    judged = url_rules.judge(pages, url_rules.rule_table(spark)).collect()
    assert sorted((r.page_id or 0, r.host, r.rule, r.verdict) for r in judged) == [
        (0, "", None, "allow"), (1, "", None, "allow"), (2, "a.net", "net/", "block"), (2, "a.net", "net/", "block"), (4, "", None, "allow"),
    ]
    empty = pages.limit(0)
    assert html_model.main_texts(empty, html_model.learn(empty)).count() == 0
    assert url_rules.judge(empty, url_rules.rule_table(spark)).count() == 0
    assert url_rules.judge(pages, url_rules.rule_table(spark).limit(0)).where("verdict = 'allow' AND rule IS NULL").count() == 5


def test_stages_keep_columns(spark, docs, nothing, labels, items, tmp_path):
    sf = str(tmp_path)
    labels.write.parquet(f"{sf}/labels.parquet")
    items.write.parquet(f"{sf}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, nothing):
            out = stage(spark, given.select("doc_id", "text", "lang", "source", "n_chars"), sf)
            rows = out.collect()
            assert name != "ngram_jaccard_join" or given is nothing or len({r["doc_id"] for r in rows}) == len(rows)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
                assert out.dtypes == given.select("doc_id", "text", "lang", "source", "n_chars").dtypes
    kept = {r.doc_id for r in quality_rules.kept_documents(docs).collect()}
    assert kept.isdisjoint({1, 2, 3, 5, 6, 7, None})
    assert quality_rules.kept_documents(docs).columns == docs.columns


def test_stages_on_clashing_columns(spark, docs, nothing, labels, items, tmp_path):
    sf = str(tmp_path)
    labels.write.parquet(f"{sf}/labels.parquet")
    items.write.parquet(f"{sf}/benchmark.parquet")
    for given in (docs, nothing):
        given = given.withColumns({c: F.lit("clash") for c in ("n_tokens", "ids_sha256", "decoded_sha256", "round_trip")})
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, sf)
            out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.dtypes == given.dtypes
            else:
                assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]
                assert out.count() == given.count() and out.where(F.col("n_tokens").cast("string") == "clash").count() == 0


def test_decode_gives_the_text_back(spark, docs):
    model = queries.tokenizer_file("piece_bpe_32k.model")
    there = sentencepiece_bpe.encode(docs.select("doc_id", "text"), model)
    back = sentencepiece_bpe.decode(there, model)
    assert back.where("decoded <> coalesce(text, '')").count() == 0
    with pytest.raises(ValueError, match="exist already"):
        sentencepiece_bpe.encode(docs, model)


def test_equal_ids_share_a_component(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = table(spark, [(3, text), (3, "something else entirely, and short"), (5, text + " end"), (5, text + " end"), (6, "something else entirely, and short")])
    got = sorted(set((r.doc_id, r.component_id) for r in ngram_join.join_components(docs).collect()))
    assert got == [(3, 3), (5, 3), (6, 6)]


def test_hot_row_is_spread_over_shards(spark):
    docs = table(spark, [(7, "x" * 1000)] * 300 + [(i, "y") for i in range(100)] + [(1000, "z" * 9000)])
    got = sharding.assign(docs, 5000).groupBy("shard").agg(F.sum("bytes").alias("b"), F.count("*").alias("n"), F.max("shard_bytes").alias("sb"), F.max("shard_rows").alias("sn")).collect()
    assert sum(r.n for r in got) == 401
    assert all(r.b == r.sb and r.n == r.sn and (r.b <= 5000 or r.n == 1) for r in got)
    shards = [r.shard for r in got]
    assert not any(a != b and b.startswith(a) for a in shards for b in shards)  # a prefix code


def test_written_shards_hold_all_rows(spark, docs, tmp_path):
    sharding.write_shards(docs, f"{tmp_path}/out", 100_000)
    back = spark.read.parquet(f"{tmp_path}/out").drop("shard_bits")
    assert back.exceptAll(docs.select(back.columns)).count() == 0 and back.count() == len(ROWS)
