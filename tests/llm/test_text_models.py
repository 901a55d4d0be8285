"""Packing, language ID, token counts and page text."""

import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import html_text, langid, packing, queries, token_count
from tests.llm import cases

TOKENIZER = public_tokenizers.path(queries.PACKING_TOKENIZER)


def check_pieces(docs, pieces, size):
    t = Tokenizer.from_file(TOKENIZER)
    ids = {}
    for r in docs.collect():
        ids.setdefault(r["doc_id"], []).append([*t.encode(r["text"] or "", add_special_tokens=False).ids, 1])
    seqs, total = {}, {}
    for p in pieces.collect():
        seqs.setdefault(p["sequence_id"], []).append(p)
        part = ids[p["doc_id"]][0][p["start"]:p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and p["doc_tokens"] == len(ids[p["doc_id"]][0])
        assert p["continues"] == (p["start"] + p["length"] < p["doc_tokens"])
        total[p["doc_id"]] = total.get(p["doc_id"], 0) + p["length"]
    assert total == {d: sum(map(len, x)) for d, x in ids.items()}
    for s, ps in seqs.items():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == size or s == max(seqs)
    assert sorted(seqs) == list(range(len(seqs)))


@pytest.mark.parametrize("size", [7, 2048])
def test_every_id_lies_in_one_piece(spark, size):
    docs = cases.documents(spark).repartition(5)
    check_pieces(docs, packing.pack(docs, TOKENIZER, size), size)


def test_packing_of_real_documents(spark):
    docs = cases.real_documents(spark).repartition(3)
    check_pieces(docs, packing.pack(docs, TOKENIZER), packing.SIZE)


def test_packed_ids_and_a_full_memory(spark, monkeypatch):
    texts = [t for t in cases.TEXTS if t and len(t) < 10_000]
    plain = packing.token_bytes(texts, TOKENIZER)
    monkeypatch.setattr(packing, "CACHE", 5)
    monkeypatch.setattr(packing, "_known", {})
    assert packing.token_bytes(texts, TOKENIZER) == plain
    docs = cases.documents(spark, texts)
    for p in packing.pack(docs, TOKENIZER, 64, with_ids=True).collect():
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
    assert packing.pack(cases.empty(spark), TOKENIZER).count() == 0


def test_words_are_looked_up_without_their_marks(monkeypatch):
    """One lookup serves a word in all its cases and between any marks; the ids stay those of the whole text."""
    marks = ["", "(", ")", "&&&", "***", '"', "[[", "--", "'", "!'", "<|", "|>", "_", "`"]
    texts = [" ".join(f"{a}{w}{b}" for a in marks for b in marks) for w in ("Étude", "étude", "straße", "ÿ")]
    texts += ["<|endoftext|> a<|endoftext|>b ((<|startoftext|>)) x's 's' it's ... 3.5 -- e\u0301te \u0130x &&&" + "!" * 3000, "", "(" * 50]
    monkeypatch.setattr(packing, "_known", {})
    got = packing.token_bytes([*texts, None], TOKENIZER)
    t = Tokenizer.from_file(TOKENIZER)
    assert got == [np.array([*t.encode(x, add_special_tokens=False).ids, 1], "<u4").tobytes() for x in [*texts, ""]]
    known = packing._known[TOKENIZER].young
    assert "étude" in known and [x for x in known if "tude" in x.lower() and "'" not in x] == ["étude"]


def test_words_are_given_to_the_tokenizer_together(monkeypatch):
    words = [a + b + c for a in ("na", "Ör", "x") for b in "abcdefghijklmnopqrst" for c in ("zz", "ïe", "tion")]
    monkeypatch.setattr(packing, "_known", {})
    calls = []
    encode = Tokenizer.encode_batch_fast
    memory = packing.Memory(TOKENIZER)
    memory.tokenizer = type("Counting", (), {"encode_batch_fast": lambda self, x, **k: calls.extend(x) or encode(whole, x, **k)})()
    whole = Tokenizer.from_file(TOKENIZER)
    for last in (memory.last, np.zeros_like(memory.last)):  # the second: ends of words not told, so each word goes alone
        memory.last, memory.young, memory.old = last, {}, {}
        assert memory.ids(words) == [np.array(whole.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
        assert (len(calls) <= 1 + len(words) // packing.TOGETHER) == bool(last.any())


def test_language_of_held_out_documents(spark):
    docs = cases.real_documents(spark, "/root/testdata/sf0.01")
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.93
    want = {d for (d,) in duckdb.sql("SELECT doc_id FROM '/root/testdata/sf0.01/documents.parquet'").fetchall() if
            zlib.crc32(str(d).encode()) % 4 == 2}
    assert {r["doc_id"] for r in out.filter("held_out").collect()} == want


def test_language_of_odd_documents(spark):
    got = {r["doc_id"]: r for r in langid.identify(cases.documents(spark)).collect()}
    for i, t in enumerate(cases.TEXTS):
        assert (got[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in t or "")), i
        assert 0 <= got[i]["score"] <= 1
    assert langid.identify(cases.empty(spark)).count() == 0
    nothing = cases.documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(nothing).collect()} == {"und"}


def test_every_byte_and_context_of_the_sample_is_kept():
    """Two languages over all 256 bytes, more strings than any fixed table
    would hold: lengths as PPM written out for each language."""
    rng = random.Random(9)
    train = [bytes(rng.randrange(256) for _ in range(30_000)) + b"abab" * 50, bytes(rng.randrange(128, 256) for _ in range(3000))]
    text = train[0][500:540] + bytes(rng.randrange(256) for _ in range(40)) + b"ababab"
    parts = [np.unique(langid.grams(np.frombuffer(t, np.uint8), np.array([0, len(t)])), return_counts=True) for t in train]
    lang = np.concatenate([np.full(len(g), k) for k, (g, _) in enumerate(parts)])
    model = langid.freeze(["x", "y"], lang, np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts]).astype(float))
    assert len(model.levels[2].contexts) > 30_000
    got = model.lengths(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    for k, t in enumerate(train):
        counts: dict = {}
        padded = b"\0\0\0" + t
        for i in range(len(t)):
            for d in range(4):
                seen = counts.setdefault(padded[i + 3 - d:i + 3], {})
                seen[padded[i + 3]] = seen.get(padded[i + 3], 0) + 1
        bits, padded = 0, b"\0\0\0" + text
        for i in range(len(text)):
            p = 1 / 256
            for d in range(4):
                seen = counts.get(padded[i + 3 - d:i + 3], {})
                if seen:
                    p = seen.get(padded[i + 3], len(seen) * p) / (sum(seen.values()) + len(seen))
            bits += round(-np.log2(p) * langid.UNIT)
        assert abs(bits - got[k]) <= 1


def test_code_lengths_match_the_escape_method(monkeypatch):
    """The frozen table against PPM written out for one text."""
    rng = random.Random(2)
    train = bytes(rng.choice(b"abcd ") for _ in range(400))
    text = bytes(rng.choice(b"abcdez ") for _ in range(50))

    def grams(b):
        padded = b"\0\0\0" + b
        return np.array([int.from_bytes(padded[i:i + 4], "big") for i in range(len(b))], np.int64)

    g, n = np.unique(grams(train), return_counts=True)
    model = langid.freeze(["x"], np.zeros(len(g), np.int64), g, n.astype(float))
    known = sorted(set(train) | {0})
    counts = [{} for _ in range(4)]
    padded = b"\0\0\0" + train
    for i in range(len(train)):
        for k in range(4):
            counts[k].setdefault(padded[i + 3 - k:i + 3], {}).setdefault(padded[i + 3], 0)
            counts[k][padded[i + 3 - k:i + 3]][padded[i + 3]] += 1

    def p(ctx, b):
        prob = 1 / 256
        if b not in known:  # all other bytes share a symbol
            prob = (256 - len(known)) / 256
        for k in range(4):
            seen = counts[k].get(ctx[3 - k:], {})
            if seen:
                total = sum(seen.values()) + len(seen)
                prob = seen[b] / total if b in seen else len(seen) / total * prob
        return prob if b in known else prob / (256 - len(known))

    padded = b"\0\0\0" + text
    want = sum(round(-np.log2(p(padded[i:i + 3], text[i])) * langid.UNIT) for i in range(len(text)))
    monkeypatch.setattr(langid, "PIECE", 7)
    raw = np.frombuffer(text + text, np.uint8)
    got = model.lengths(raw, np.array([0, 0, len(text), 2 * len(text)]))
    assert got[:, 0].tolist() == [0, want, want]


def test_languages_of_few_long_documents_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "STRETCH", 200, raising=False)
    rng = random.Random(3)
    prose = lambda letters, n: "".join(rng.choice(letters + " ") for _ in range(n))
    rows = [(i, f"l{i % 6}", prose("abcdefgh"[i % 6:][:3] + "xé", 60_000)) for i in range(24)]
    rows += [(100 + i, "short", prose("mnop", 100)) for i in range(3000)] + [(5000, "rare", "qrs"), (5001, "rare", "qrst"), (5002, "rare", "qr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(4)
    learned = docs.filter(~langid.held_out())
    sample = {r["lang"]: r["n"] for r in langid.gram_counts(docs, 8000).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    assert sample.keys() == {r["lang"] for r in learned.select("lang").distinct().collect()}
    assert all(4000 < n < 16_000 for lang, n in sample.items() if lang != "rare") and sample["rare"] <= 9
    out = langid.identify(docs, 8000).join(docs.select("doc_id", "lang"), "doc_id").filter("doc_id < 100")
    assert all(r["lang_pred"] == r["lang"] for r in out.collect())
    one = {r["lang"]: r["n"] for r in langid.gram_counts(docs, 1).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    assert one.keys() == sample.keys()


def test_short_documents_are_counted_whole(spark):
    docs = cases.documents(spark, [t for t in cases.TEXTS if t and len(t) < langid.STRETCH])
    used = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~langid.held_out()).collect()
    counted = langid.gram_counts(docs, 10**9).agg(F.sum("n")).first()[0]
    assert counted == sum(len(r["text"].encode()) for r in used)


def test_grams_start_afresh_in_each_text():
    g = langid.grams(np.frombuffer(b"abab", np.uint8), np.array([0, 2, 2, 4]))
    assert g.tolist() == [97, 97 << 8 | 98] * 2


def greedy(pieces, word):
    n = at = 0
    while at < len(word):
        at += max(k for k in range(1, len(word) - at + 1) if word[at:at + k] in pieces)
        n += 1
    return n


def test_automaton_counts_greedy_pieces():
    rng = random.Random(4)
    for _ in range(30):
        pieces = {bytes([b]) for b in range(256)} | {bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 7))) for _ in range(12)}
        a = token_count.Automaton(pieces)
        for _ in range(50):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 25)))
            assert a.length(word) == greedy(pieces, word)
    with pytest.raises(ValueError):
        token_count.Automaton([b"a"])


def test_token_counts(spark, monkeypatch):
    path = public_tokenizers.path(queries.PIECE_VOCABULARY)
    pieces = set(token_count.read_ranks(path))
    texts = [t if t is None or len(t) < 2000 else t[:2000] for t in cases.TEXTS]
    docs = cases.documents(spark, texts)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    want = sorted(((r["doc_id"], len(words(r["text"])), sum(greedy(pieces, b" " + w.encode()) for w in words(r["text"])))
                   for r in docs.collect()), key=repr)
    assert cases.rows(token_count.token_counts(docs, path), "doc_id", "n_words", "n_tokens") == want
    assert token_count.token_counts(cases.empty(spark), path).count() == 0


PAGES = [
    ("<p>One <b>two</b>\n three<p>four", "One two three\n\nfour"),
    ("<head><title>no</title></head><body>a<br>b<script>x</script><style>y</style><!-- c -->d", "a\nbd"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>after", "- a\n- b\n  - c\n\nafter"),
    ("<ol start=3><li>x</li><li>y<br>z</li></ol>", "3. x\n4. y\n   z"),
    ("<table><caption>T</caption><tr><th>Name<th>N<tr><td>abc<td>1<tr><td>d<td>22</table>", "T\nName  N\nabc   1\nd     22"),
    ("<div hidden>no</div><p style='display: none'>no</p><span aria-hidden=true>no</span>yes<input type=hidden value=no>", "yes"),
    ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"), ("&lt;x&gt; &amp; &eacute;&nbsp;", "<x> & é"), (None, ""), ("", ""), ("plain", "plain"),
    ("</p></div>x</b><i>y", "xy"), ("<p>a<div>b</div>c", "a\n\nb\nc"), ("<img alt='pic'> text <img>", "pic text"), ("a<", "a<"),
    ("<!DOCTYPE html><a href=\"x>y\">l</a>", "l"), ("<select><option>a<option>b</select>z", "z"), ("<script>never closed", ""),
    ("<h1>T</h1><p>x</p><hr><blockquote>q</blockquote>", "T\n\nx\n\nq"), ("<" + "div><" * 3000 + "b>deep", "deep"),
]


@pytest.mark.parametrize(("html", "text"), PAGES)
def test_page_text(html, text):
    assert html_text.page_text(html).replace("\xa0", "").rstrip() == text


@pytest.mark.parametrize(("html", "text"), [
    ("<table><tr>stray<td>a<td>b</tr>more<tr><td>c</td> be\ntween <td>d</table>", "stray\nmore\nbe tween\na  b\nc  d"),
    ("<table><tr hidden>no<td>no</tr><tr>yes</tr></table>", "yes"), ("<table><tr><td>" * 3000 + "deep", "deep"),
    ("<table><caption>" * 3000 + "deep", "deep"), ("<table><tr><td>a<table><tr>x<td>b<td>c</table><td>d</table>", "a     d\n\nx\nb  c")])
def test_text_outside_cells_and_tables_in_tables(html, text):
    assert re.sub(" +$", "", html_text.page_text(html), flags=re.M) == text


@pytest.mark.parametrize("unit", ["<b>x", "<ul><li>", "<ul><li>a", "<table><tr><td>x<td>", "<table><tr><td>x<tr><td>", "</i><b>", "<p><b>",
                                  "<pre>\n a", "<table><tr><td>x<td>y<br>z", "<dl><dd>q", "<tr><td>a<td>b", "<a \"", "<a '", "<select><option>a"])
def test_time_and_output_grow_with_the_page(unit):
    def run(n):
        began = time.perf_counter()
        out = html_text.page_text(unit * (n // len(unit)))
        return time.perf_counter() - began, len(out)

    small, large = min(run(20_000) for _ in range(3)), run(160_000)
    assert large[0] < 24 * small[0] + 0.2 and large[1] <= 10 * small[1] + 100


def test_wide_cells_and_deep_items_keep_their_text():
    wide = html_text.page_text("<table><tr><td>" + "w" * 50_000 + "<td>" + "a<br>" * 2000 + "</table>")
    assert wide.count("w") == 50_000 and wide.count("a") == 2000 and len(wide) < 1_000_000
    many = html_text.page_text("<table><tr>" + "<td>c" * 500 + "<td>" + "a<br>" * 2000 + "</table>")
    assert many.split() == ["c"] * 500 + ["a"] * 2000 and len(many) < 10_000
    deep = html_text.page_text("<ul><li>a" * 100).split("\n")
    assert [len(line) - 3 for line in deep] == [min(2 * k, html_text.INDENT) for k in range(100)]
    nested = html_text.page_text("<table><tr><td>x<td>" * 40)
    assert nested.split() == ["x"] * 40


def test_an_item_that_begins_with_a_paragraph_has_its_mark():
    assert html_text.page_text("<ul><li>a<li><p>b<p>c</ul>") == "- a\n\n- b\n\n  c"


def test_broken_markup_never_fails():
    rng = random.Random(6)
    parts = ["<p>", "</p>", "<table>", "<tr>", "<td>", "</td>", "<li>", "<ul>", "</ul>", "<", ">", "&", "\"", "'", "<!--", "-->", "x ", "\n",
             "<pre>", "</pre>", "<script>", "</script>", "<b", "=", "<br/>", "<ol>", "&#x110000;", "<td hidden>", "</table>"]
    for _ in range(300):
        out = html_text.page_text("".join(rng.choice(parts) for _ in range(rng.randrange(60))))
        assert isinstance(out, str) and "<script>" not in out


def test_pages_table(spark):
    rows = [(i, None if i % 4 == 0 else f"u{i}", h, "z") for i, (h, _) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows + rows[:1], "page_id bigint, url string, html string, text string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_lines", "n_chars"] and got.count() == len(rows) + 1
    for r in got.collect():
        assert r["text"] == html_text.page_text(PAGES[r["page_id"]][0]) and r["n_chars"] == len(r["text"])
    assert html_text.extract(pages.limit(0)).count() == 0
