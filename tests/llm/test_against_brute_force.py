"""Operators against plain definitions, or the libraries that they must agree with."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, html_model, huffman_ids, license_scan, ngram_join, quality_rules, queries, sentencepiece_bpe, toxicity, url_rules
from tidemark.llm import text as T

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


def test_word_spans_and_windows():
    rows = ["a b", "", None, " \n", "é 😀x\x0by", "z"]
    raw, at = T.buffer_of(pa.array(rows))
    s, e, n = T.word_spans(raw, at)
    assert [bytes(raw[a:b]).decode() for a, b in zip(s, e)] == ["a", "b", "é", "😀x", "y", "z"]
    assert n.tolist() == [2, 0, 0, 0, 3, 1]
    h = T.span_hashes(raw, s, e)
    assert len(set(h.tolist())) == 6
    keys, first, per = T.windows(h, n, 2, short=True)
    assert per.tolist() == [1, 0, 0, 0, 2, 1] and first.tolist() == [0, 2, 3, 5]
    assert T.windows(h, n, 2, short=False)[2].tolist() == [1, 0, 0, 0, 2, 0]


def test_quality_counts(documents, texts):
    for r in queries.op2_quality_rules(documents.sparkSession, SF).collect():
        text = texts[r.doc_id] or ""
        words = WORD.findall(text)
        places = defaultdict(list)
        for i in range(len(words) - 2):
            places[tuple(words[i : i + 3])].append(i)
        covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed,
        )
        assert r.kept == (not failed and r.quality >= 0.5)


def test_em_finds_planted_rates():
    rng = np.random.default_rng(5)
    target = np.array([v for v, _ in quality_rules.RULES.values()])
    good = rng.random(20_000) < 0.85
    fires = rng.random((20_000, len(target))) < np.where(good[:, None] == target, 0.6, 0.04)
    patterns, n = np.unique(np.where(fires, target, -1), axis=0, return_counts=True)
    prior, rates = quality_rules.fit(patterns, n.astype(float))
    assert abs(prior - 0.85) < 0.03
    assert np.abs(rates - np.where(np.arange(2)[:, None] == target, 0.6, 0.04)).max() < 0.05


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    both = queries.op2_quality_rules(spark, sf).join(lab, "doc_id").where("NOT base_failed")
    assert both.count() > 300 and both.where("kept <> (label = 1)").count() <= 0.02 * both.count()


def test_huffman_ids_are_the_tokenizers(documents, texts, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(huffman_ids, "SEGMENT", 5000)
    path = queries.tokenizer_file("word_bpe_49k.json")
    got = {r.doc_id: r for r in huffman_ids.round_trip(documents, path).collect()}
    plain, start = Tokenizer.from_file(path), 0
    for i in sorted(texts):
        ids = plain.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_words_tokenized_apart_give_the_same_ids():
    path = queries.tokenizer_file("word_bpe_49k.json")
    own = huffman_ids.WordIds(path)
    rows = ["<|ENDOFTEXT|> <|Endoftext|>", "a<|endoftext|>. b!<|endoftext|>", "x!. ...", "", None, " \t", "İ é ̈ x", "\r\n a\x0bb", "ﬁ", "don't I'll", "😀😀", "a'sb", "\x85 x", "x<|startoftext|>y  z", "123 4", "é ́x"]
    rows += [f"{a}{c}{b}" for c in ("T\u0308", "H\u0331", "W\u030a", "Y\u030a", "J\u030c", "T\u0308\u0331") for a in ("", "x", "<", "A.") for b in ("", "y", ". Z", "é")]
    random.seed(3)
    rows += ["".join(random.choice("aBTHWYJ'. !\n\té1<|>̱̈̌̊️—x") for _ in range(random.randint(1, 30))) for _ in range(500)]
    ids, n = own.encode(pa.array(rows), 1)
    at = np.concatenate(([0], np.cumsum(n)))
    for i, t in enumerate(rows):
        assert ids[at[i] : at[i + 1]].tolist() == own.tokenizer.encode(t or "", add_special_tokens=False).ids + [1], t


@pytest.mark.parametrize("n", [1, 2, 3, 40, 2000])
def test_codes_round_trip(n):
    rng = np.random.default_rng(n)
    counts = rng.integers(1, 900, n) ** 3
    bits = huffman_ids.code_lengths(counts)
    assert bits.max() <= max(huffman_ids.MAX_BITS, 1) and (n == 1 or (2.0**-bits).sum() == 1)
    ids = np.sort(rng.choice(60_000, n, replace=False))
    book = huffman_ids.Book(ids, bits)
    for m in (1, huffman_ids.BLOCK, huffman_ids.BLOCK + 1, 3000):
        some = rng.choice(ids, m).astype(np.int32)
        coded, marks = book.encode(some)
        assert (book.decode(coded, marks, m) == some).all()
        if len(marks) > 1:  # a block decodes alone
            assert (book.decode(coded, marks[1:2], min(m, 2 * huffman_ids.BLOCK) - huffman_ids.BLOCK) == some[huffman_ids.BLOCK : 2 * huffman_ids.BLOCK]).all()


def test_sentencepiece_is_exact(texts):
    import sentencepiece

    path = queries.tokenizer_file("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_bpe.Codec(path)
    random.seed(7)
    odd = ["", " ", "  a", "a\nb\tc", "\n", "<s> x", "é́", "▁a", "▁▁▁ a▁b   ▁", " " * 45, "a" * 33 + " " * 40 + "the", "\x00b", "ab\r\n\n c", "x" * 500]
    odd += ["".join(random.choice("ab ▁\n t\tehé一😀 <s>0x") for _ in range(random.randint(1, 40))) for _ in range(800)]
    for t in [*odd, *(x or "" for x in texts.values())]:
        ids = own.encode(t)
        assert ids == library.encode(t)
        assert own.decode(ids) == library.decode(ids)


def test_units_merged_together_are_as_merged_alone():
    """Many short units by rounds, longer ones and unknown characters beside them."""
    own = sentencepiece_bpe.Codec(queries.tokenizer_file("piece_bpe_32k.model"))
    rng = random.Random(11)
    units = {"".join(rng.choices("aabeeinrsthou▁éß1.漢\U0001f600", k=rng.randint(1, 70))) for _ in range(3000)} | {"\n", "▁" * 64, "▁" * 65, "e" * 64}
    assert any(len(u) > sentencepiece_bpe.SHORT for u in units)
    got = own.encode_units(units)
    assert got == {u: own.encode_unit(u) for u in units}
    known = [u for u in units if all(c in own.ids for c in u)]
    assert len(known) > 100 and all(list(got[u]) == [own.ids[p] for p in own.merged(u)] for u in known)
    assert own.encode_all([None, "", "a b", "a\nb"]) == [[], [], own.encode("a b"), own.encode("a\nb")]


def test_long_unbroken_text_is_exact():
    import random

    import sentencepiece

    model = queries.tokenizer_file("piece_bpe_32k.model")
    chars = random.Random(5).choices("abcdefghijklmnopqrstuvwxyzßéя1.", k=400_000)
    assert sentencepiece_bpe.codec(model).encode("".join(chars)) == sentencepiece.SentencePieceProcessor(model_file=model).encode("".join(chars))


def components_of(sets):
    """Components by comparing each set with all others that share an n-gram."""
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        for j in {j for g in s for j in holders[g] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("long_list, frequent", [(20, 6), (5, 2)])
def test_join_components(spark, texts, monkeypatch, long_list, frequent):
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rng = random.Random(2)
    rows = list(texts.items())
    base = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    passage = " ".join(f"shared{i}" for i in range(50))
    for k in range(60):  # near copies of different distance
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = f"edit{k}"
        rows.append((1000 + k, " ".join(w)))
    rows += [(2000 + k, passage + " " + " ".join(f"own{k}x{i}" for i in range(rng.choice([2, 12, 60])))) for k in range(40)]
    rows += [(3000 + k, "same text of a few words here") for k in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    roots = components_of(sets)
    assert got == {i: (len(sets[i]), roots[i]) for i in sets}


@pytest.mark.parametrize("copies", [18, 22, 32])
def test_links_of_unequal_sizes_in_long_lists(spark, monkeypatch, copies):
    monkeypatch.setattr(ngram_join, "FREQUENT", 10**6)
    rows = []
    for g in range(12):  # texts that link with the shortest of their group only
        base = [f"g{g}w{i}" for i in range(104)]
        rows.append((100 * g, " ".join(base)))
        rows += [(100 * g + k, " ".join(base + [f"g{g}own{k}x{i}" for i in range((25, 25, 24, 20)[k % 4])])) for k in range(1, copies + 1)]
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    words = {i: t.split() for i, t in rows}
    assert got == components_of({i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in words.items()})


def test_wand_finds_all_above_the_threshold(spark):
    index = next(decontamination.indexes(spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")))
    rng = np.random.default_rng(0)
    for _ in range(60):
        item = rng.integers(len(index.items))
        own = [w for w in range(len(index.words)) if item in index.docs[index.starts[w] : index.starts[w + 1]]]
        words = np.unique(np.concatenate([rng.choice(len(index.words), 20), rng.permutation(own)[: rng.integers(0, len(own) + 1)]])).astype(int)
        scores = np.zeros(len(index.items))
        for w in words:
            scores[index.docs[index.starts[w] : index.starts[w + 1]]] += index.impacts[index.starts[w] : index.starts[w + 1]]
        for least in (0.1, 0.3, 0.6):
            assert {i for i, _ in index.wand(words, least)} == set(np.flatnonzero(scores >= least - 1e-9).tolist())


def test_all_planted_items_are_found(spark):
    sf, rx = "/root/testdata/sf0.01", re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    items = {r.item_id: rx.findall(r.text.lower()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = " " + " ".join(rx.findall((r.text or "").lower())) + " "
        want |= {(r.doc_id, i) for i, w in items.items() if f" {' '.join(w)} " in text}
    assert want and {(r.doc_id, r.item_id) for r in queries.op4_bm25_decontamination(spark, sf).collect()} == want


def test_long_items_are_found(spark):
    rng = np.random.default_rng(5)
    share = 1 / np.arange(1, 3001)
    words = lambda n: " ".join(f"w{i}" for i in rng.choice(3000, n, p=share / share.sum()))
    sizes = [20, 48, 49, 59, 97, 160, 200, 300, 300, 1000] * 3
    items = [(i, words(n)) for i, n in enumerate(sizes)]
    # The rare words of the last one stand together, away from the middle of any passage.
    items.append((len(items), " ".join(["the"] * 70 + [f"rare{k}" for k in range(20)])))
    rows = [(i, f"{words(int(rng.integers(0, 700)))} {t} {words(int(rng.integers(0, 300)))}") for i, t in items] + [(100 + i, words(800)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.matches(docs, tests).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i, _ in items]
    assert all(r.question_overlap == 1 and r.answer_overlap == 1 for r in got)
    assert sorted(r.doc_id for r in decontamination.clean_documents(docs, tests).collect()) == list(range(100, 120))


def test_index_in_several_parts(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    whole = sorted(map(tuple, queries.op4_bm25_decontamination(spark, sf).select("doc_id", "item_id").collect()))
    monkeypatch.setattr(decontamination, "PART_POSTINGS", 300)
    assert sorted(map(tuple, queries.op4_bm25_decontamination(spark, sf).select("doc_id", "item_id").collect())) == whole


def test_license_places(documents, texts):
    for r in license_scan.scan(documents).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(texts[r.doc_id]))
        found = [(k, label) for p, label in license_scan.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        at = [k for k, _ in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_larger_detections_hide_smaller_ones(spark):
    docs = spark.createDataFrame([(1, "Licensed under the GNU Lesser General Public License version 3."), (2, "BSD 3-clause license, and the Mozilla Public License"), (3, "nothing of it")], "doc_id int, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert got[1].labels == "gpl,lgpl" and got[1].base_labels == "gpl" and got[2].labels == "bsd,mpl"
    assert got[3].labels == "" and got[3].score == 0.0
    rules = [("inner", "public", 10, "public license"), ("outer", "public", 20, "mozilla public license"), ("later", "public", 20, "license of")]
    got = {r.doc_id: r.labels for r in license_scan.scan(docs, rules=rules).collect()}
    assert got[2] == "outer" and got[1] == "gpl,inner"


def test_rules_of_a_caller_bring_their_own_cues(spark):
    rows = [(1, "It is free for Academic use only."), (2, "copyright; free for academic use only"), (3, "an academic use"), (4, "under the MIT license"), (5, None)]
    rules = [("academic", "academic", license_scan.NAME, "free for academic use only")]
    got = {r.doc_id: (r.labels, r.n_base) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), rules=rules).collect()}
    assert got == {1: ("academic", 0), 2: ("academic", 0), 3: ("", 0), 4: ("mit", 1), 5: ("", 0)}


def test_nested_url_rules(spark):
    rules = [("a", "/", "block"), ("a", "/x/", "allow"), ("a", "/x/y/", "block"), ("b.a", "/", "allow"), ("b.a", "/x", "block"), ("c.b.a", "/zz", "allow")]
    random.seed(4)
    urls = [(k, "s://" + random.choice(["a", "b.a", "C.b.a", "d.c.b.a", "q.a", "ba", "a."]) + random.choice(["", "/", "/x", "/x/", "/x/y", "/x/y/z?/zz", "/zz#x", "?q=/x"])) for k in range(300)]

    def brute(k, u):
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (lower(host) == h or lower(host).endswith("." + h)) and path.startswith(p)]
        return (k, lower(host), path, *(max(fit)[2:] if fit else (None, "allow")))

    got = url_rules.judge(spark.createDataFrame(urls, "page_id int, url string"), url_rules.rule_table(spark, rules)).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == [brute(*u) for u in urls]


def test_hits_and_exceptions_in_one_long_text():
    lexicon = toxicity.Lexicon({"idiot": (1.0, True), "trash": (1.0, True)}, ("trash can",))
    automaton = lexicon.automaton()
    assert toxicity.evidence(toxicity.fold("trash can idiot " * 200_000), automaton) == 200_000
    rng = np.random.default_rng(3)
    for _ in range(200):
        text = " ".join(rng.choice(["trash", "can", "idiot", "trashcan", "a"], 40))
        spared = [m.span() for m in re.finditer(r"\btrash can", text)]
        want = sum(not any(a <= m.start() and m.end() <= b for a, b in spared) for m in re.finditer(r"\b(?:idiot|trash)\b", text))
        assert toxicity.evidence(text, automaton) == want


def test_evidence_folds_and_spares():
    made = toxicity.Lexicon({"idiot": (2.0, True), "clown": (1.0, True), "vequ": (3.0, False)})
    automaton = made.automaton()
    score = lambda t: toxicity.evidence(toxicity.fold(t), automaton)
    assert score("An IDIOT") == score("1d10t!") == score("іdіоt") == 2.0
    assert score("idiots") == 0.0 and score("xvequ") == 0.0 and score("vequxyz") == 3.0
    assert score("a clown fish") == 0.0 and score("a clown") == 1.0


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op8_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0))
    assert n[1, 1] >= 0.9 * (n[1, 1] + n.get((0, 1), 0))


def test_main_texts_are_the_articles(spark):
    import html

    def article(page):
        inner = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = re.split(r"</?(?:h1|p)\b[^>]*>", inner)
        plain = (" ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: " " if m[0].startswith("<br") else "", b)).split()) for b in blocks)
        return "\n".join(x for x in plain if x)

    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op5_html_extraction(spark, sf).collect():
        assert r.text == article(pages[r.page_id]) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "inside, want",
    [
        ("<p>One.</p><svg width='1'/><p>Two.</p><svg/><p>Three.</p>", "One.\nTwo.\nThree."),
        ("<p>One <svg viewBox='0 0 1 1'><text>drawn</text></svg>and two.</p>", "One\nand two."),
        ("<p>One <math/>and two.</p>", "One and two."),
        ("<p>Let <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow></math> be.</p><p>Two.</p>", "Let x=2 be.\nTwo."),
        ("<p>The <math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr></mtable></math> row.</p>", "The 1 2 row."),
        ("<p>One <object data='x'><param name='a' value='b'>a fallback</object> two.</p><p>Three.</p>", "One a fallback two.\nThree."),
        ("<object data='x'><p>A fallback.</p></object><p>Two.</p>", "A fallback.\nTwo."),
        ("<p>One <object data='x'>two.</p><p>Three.</p>", "One two.\nThree."),
        ("<p>One.</p><template><p>Two.</p><noscript><p>Three.</p><template><iframe src='x'><svg><p>Four.</p>", "One.\nTwo.\nThree.\nFour."),
        ("<p>One.</p><noscript><img>hidden</noscript><script>let a = '<p>';</script><p>Two.</p>", "One.\nTwo."),
        ("<p>One.</p><script>no end <p>Two.</p>", "One."),
    ],
)
def test_raw_tags_hold_no_more_than_their_own(inside, want):
    model = html_model.train([html_model.labelled_nodes(x) for x in html_model.EXAMPLES])
    page = f"<html><body><nav><a href='/'>Home</a></nav><main><article>{inside}</article></main><footer>Imprint</footer></body></html>"
    assert model.extract(page) == want


def test_model_on_pages_without_landmarks():
    from tidemark.llm import html_model

    model = html_model.train([html_model.labelled_nodes(x) for x in html_model.EXAMPLES])
    for page in html_model.EXAMPLES:
        nodes, state = html_model.labelled_nodes(page)
        assert ((model.marginals(nodes) >= 0.5) == state)[[n.text is not None for n in nodes]].all()


def article_blocks(page):
    import html

    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = re.split(r"</?(?:h1|p)\b[^>]*>", inner)
    plain = (" ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: " " if m[0].startswith("<br") else "", b)).split()) for b in blocks)
    return [x for x in plain if x]


@pytest.fixture(scope="module")
def page_model(spark):
    """A model of some given pages, and pages that it hasn't seen."""
    from tidemark.llm import html_model

    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    return html_model.train(html_model.examples() * 5 + [html_model.labelled_nodes(x) for x in pages[:60]]), pages[60:]


@pytest.mark.parametrize("tags, classes", [("article", False), ("article|nav|footer|header|aside|main", False), ("article|nav|footer|header|aside|main", True)])
def test_unseen_pages_without_names(page_model, tags, classes):
    from collections import Counter

    model, pages = page_model
    found = right = wanted = 0
    for page in pages:
        plain = re.sub(rf"<(/?)(?:{tags})\b", r"<\1div", page)
        if classes:
            plain = re.sub(r' class="[^"]*"', "", plain)
        want, got = Counter(article_blocks(page)), Counter(model.extract(plain).split("\n"))
        found, right, wanted = found + sum(got.values()), right + sum((want & got).values()), wanted + sum(want.values())
    assert right >= 0.95 * found and right >= 0.95 * wanted


@pytest.mark.parametrize(
    "inside, want",
    [
        ('<article class="post share"><h1>T</h1><p>One.</p></article>', "T\nOne."),
        ('<article><p class="social-history">One.</p><p>Two.</p></article>', "One.\nTwo."),
        ('<article><div class="form-group"><p>One.</p></div><div class="story-ad-hoc">Two.</div></article>', "One.\nTwo."),
        ('<article><p>One.</p><div class="ad-box">Buy.</div><div class="cookie-notice"><p>We use them.</p></div><p>Two.</p></article>', "One.\nTwo."),
        ('<article><p>One.</p><section class="comments"><p>Mine.</p></section><form><p>Ask.</p></form><aside><p>More.</p></aside></article>', "One."),
        ("<div><p>One short paragraph.</p></div>", "One short paragraph."),
        (
            "<article>"
            + "<p>Yes.</p><img><div class='ad'>no</div><aside><p>no</p></aside><script>x</script><iframe></iframe><form><p>no</p></form><section class='related'><p>no</p></section><div class='promo'><p>no</p></div>" * 30
            + "</article>",
            "\n".join(["Yes."] * 30),
        ),
    ],
)
def test_class_words_are_evidence_among_other(page_model, inside, want):
    page = f"<html><body><nav><a href='/'>Home</a></nav>{inside}<footer>Imprint</footer></body></html>"
    assert page_model[0].extract(page) == want


def test_deep_pages_take_linear_time(page_model):
    import time

    start = time.time()
    for deep in ("<div>" * 60_000, "<i>" * 60_000 + "<hr>" * 60_000, "<div></b></p>" * 60_000):
        assert page_model[0].extract(f"<article>{deep}<p>One.</p>") == "One."
    assert time.time() - start < 60  # a copy of the open tags at every block took minutes


def test_marginals_by_enumeration():
    from itertools import product

    from tidemark.llm import html_model

    model = html_model.train([html_model.labelled_nodes(x) for x in html_model.EXAMPLES])
    nodes = html_model.parse("<main><p>a<div class=ad>b</div><ul><li>c</ul></main>")
    own = html_model.features(nodes) @ model.weights
    total, each = 0.0, np.zeros(len(nodes))
    for state in product((0, 1), repeat=len(nodes)):
        p = np.exp(sum(o * s for o, s in zip(own, state)))
        for i, n in enumerate(nodes[1:], 1):
            p *= np.exp(model.bonds[html_model.bond_kind(n)] * (state[n.parent] == state[i]))
        total += p
        each += p * np.array(state)
    assert np.allclose(model.marginals(nodes), each / total)


def test_signatures_hold_their_keyword_and_a_cue():
    signatures = license_scan.signatures()
    assert 300 < len(signatures) < 600 and len({(s[0], s[3]) for s in signatures}) == len(signatures)
    for label, keyword, _, pattern in signatures:
        assert keyword in re.sub(r"[^a-z0-9 ]", " ", pattern).split(), (label, pattern)
        assert any(cue in pattern for cue in license_scan.CUES), pattern


def test_words_with_accents_are_cut_and_encoded_as_by_the_tokenizer():
    own = huffman_ids.WordIds(queries.tokenizer_file("word_bpe_49k.json"))
    rng = random.Random(3)
    signs = [*"aeTHnsIÉéßÑñÿÀ×÷ªº.,;:!?#*$%&'s-", "́", "̧", "̸", " ", " ", "  ", "\n", "1", "漢", "\U0001f600", "<", "<|endoftext|>", "Ğ", "İ", "ς", "Σ", "\xa0", " "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [None, "", "É", ".", "É.", ".É", "×.a÷.", "Étudié. étudié, CIÓN!"]
    ids, n = own.encode(pa.array(texts), huffman_ids.END_ID)
    ends = np.cumsum(n)
    for text, a, b in zip(texts, ends - n, ends):
        assert ids[a:b].tolist() == own.tokenizer.encode(text or "", add_special_tokens=False).ids + [huffman_ids.END_ID]
    assert own.latin and own.cuts_latin and "Étudié" in own.words and "Étudié." not in own.words
