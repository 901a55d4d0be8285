"""License, secret and personal-data scans against plain Python."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import license_scan, pii, queries, secret_scan
from tests.llm import cases

PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


def license_row(doc_id, text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.lower(text))
    at = sorted((i, label) for p, label in PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    starts = [i for i, _ in at]
    return (doc_id, len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))


@pytest.mark.parametrize("which", ["odd", "real"])
def test_license_base_phrases(spark, which):
    docs = cases.documents(spark) if which == "odd" else cases.real_documents(spark)
    want = sorted((license_row(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    out = license_scan.scan(docs).cache()
    assert cases.rows(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    for r in out.collect():
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_license_notice_with_words_put_in_is_found(spark):
    text = cases.TEXTS[9]
    got = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert got["labels"] == "mit" and got["base_labels"] == "" and got["score"] > 0.7


def test_license_places_on_neighbouring_diagonals_all_count(spark):
    got = license_scan.scan(spark.createDataFrame([(1, "mit license " * 50)], "doc_id bigint, text string")).first()
    assert (got["n_base"], got["first_word"], got["last_word"]) == (50, 0, 98)


def test_license_templates_of_any_length(spark, monkeypatch):
    """Templates of 63 to 500 words, as broadcast and as joined tables: word
    for word, with words put in, with words missing, and their first half."""
    rng = random.Random(8)
    sizes = (63, 64, 65, 125, 126, 500)
    texts = [[f"w{rng.randrange(200)}" for _ in range(n)] for n in sizes]
    listed = [(" ".join(t), f"l{n}", False) for n, t in zip(sizes, texts, strict=True)]
    rows, want = [], {}
    for k, (t, n) in enumerate(zip(texts, sizes, strict=True)):
        longer, shorter = list(t), list(t)
        for at in (n // 4, n // 2, 3 * n // 4):
            longer.insert(at, "other")
            del shorter[at - 3]
        for j, (w, found, score) in enumerate([(t, True, 1.0), (longer, True, None), (shorter, True, None), (t[:n // 2], False, None),
                                               (["x", *t, "y"] * 3, True, 1.0)]):
            rows.append((10 * k + j, "so " * j + " ".join(w).upper()))
            want[10 * k + j] = (f"l{n}" if found else "", score)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for bound in (license_scan.MAX_BROADCAST, 0):
        monkeypatch.setattr(license_scan, "MAX_BROADCAST", bound)
        got = {r["doc_id"]: r for r in license_scan.scan(docs, listed).collect()}
        assert got.keys() == want.keys()
        for d, (label, score) in want.items():
            assert got[d]["labels"] == label, d
            assert got[d]["score"] == score if score else 0.4 < got[d]["score"] < 1, d


def finish(found, base):
    """counts, digest of base spans, from (start, kind, end)."""
    found = sorted(found, key=lambda f: (f[0], base.index(f[1])))
    text = ",".join(f"{k}:{s}:{e}" for s, k, e in found)
    return [sum(f[1] == k for f in found) for k in base] + [hashlib.sha256(text.encode()).hexdigest()]


def secrets(text):
    rx = {"assign": (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A),
          "access": ("AKIA[A-Z0-9]+", 0), "hex": ("[0-9a-f]+", 0)}
    ok = {"assign": lambda m: len(m[2]) >= 12, "access": lambda m: len(m[0]) >= 18, "hex": lambda m: len(m[0]) >= 16}
    return finish([(m.start(), k, m.end()) for k, (p, f) in rx.items() for m in re.finditer(p, text or "", f) if ok[k](m)], list(rx))


def luhn(d):
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0


def personal(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rx = {"email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
          "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
          "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
          "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)}
    return finish([(m.start(), k, m.end()) for k, (p, ok) in rx.items() for m in re.finditer(p, text or "") if ok(m)], list(rx))


@pytest.mark.parametrize("which", ["odd", "real"])
@pytest.mark.parametrize(("scan", "truth", "kinds"), [
    (lambda d: secret_scan.scan(d).select("doc_id", *queries._digest(F.col("findings"), secret_scan.BASE)), secrets, secret_scan.BASE),
    (lambda d: pii.scan(d).select("doc_id", *queries._digest(F.col("spans"), pii.BASE)), personal, pii.BASE)], ids=["secrets", "personal"])
def test_base_spans(spark, which, scan, truth, kinds):
    docs = cases.documents(spark) if which == "odd" else cases.real_documents(spark)
    want = sorted(((r["doc_id"], *truth(r["text"])) for r in docs.collect()), key=repr)
    assert cases.rows(scan(docs), "doc_id", *[f"n_{k}" for k in kinds], "base_sha256") == want


def test_personal_spans_of_the_method(spark):
    docs = cases.documents(spark)
    got = {r["doc_id"]: [(s["kind"], r["text"][s["start"]:s["end"]]) for s in r["spans"]] for r in
           pii.scan(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect()}
    assert ("ssn", "123-45-6789") in got[15] and ("iban", "GB82 WEST 1234 5698 7654 32") in got[15]


@pytest.mark.parametrize(("text", "iban"), [
    ("DE89370400440532013000 Bank", "DE89370400440532013000"), ("pay DE89 3704 0044 0532 0130 00 Bank", "DE89 3704 0044 0532 0130 00"),
    ("GB82WEST12345698765432 A B", "GB82WEST12345698765432"), ("GB82 WEST 1234 5698 7654 32, LONDON", "GB82 WEST 1234 5698 7654 32"),
    ("NO93 8601 1117 947 AND MORE", "NO93 8601 1117 947"), ("FR1420041010050500013M02606 X", "FR1420041010050500013M02606"),
    ("DE89370400440532013000X", None), ("DE88370400440532013000", None), ("ZZ89370400440532013000", None), ("XDE89370400440532013000", None)])
def test_account_numbers_end_by_their_country(spark, text, iban):
    row = pii.candidates(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).filter("kind = 'iban'").filter(
        pii.checked(F.col("kind"), F.col("match"))).select("match", "start").collect()
    assert [tuple(r) for r in row] == ([(iban, text.index(iban))] if iban else [])


def test_reliabilities_follow_agreement():
    post = pii.reliabilities([("ip", 1, 1, None, 1, 90), ("ip", 0, 0, None, 0, 10), ("ip", 1, 0, None, 1, 5)])
    assert post["ip", 1, 1, None, 1] > 0.9 > 0.5 > post["ip", 0, 0, None, 0]


def test_ledger_scans_only_unseen_blobs(spark):
    docs = cases.documents(spark)
    first = docs.filter("doc_id < 12")
    book = secret_scan.update_ledger(first)
    assert book.count() == first.select("text").na.fill("").distinct().count()
    assert secret_scan.update_ledger(first, book).count() == 0
    more = secret_scan.update_ledger(docs, book)
    assert more.join(book, "blob").count() == 0
    everything = docs.select("text").na.fill("").distinct().count()
    assert more.count() + book.count() == everything
    old = book.withColumn("rule_version", F.lit("0"))
    assert secret_scan.update_ledger(first, old).count() == book.count()
    both = cases.rows(secret_scan.scan(docs, book), "doc_id", "blob", "findings")
    assert both == cases.rows(secret_scan.scan(docs), "doc_id", "blob", "findings")


def test_kept_ledger_grows_by_unseen_blobs(spark, tmp_path, monkeypatch):
    docs = cases.documents(spark)
    first, path = docs.filter("doc_id < 12"), str(tmp_path / "kept")
    scanned = []
    plain = secret_scan.scan_blobs
    monkeypatch.setattr(secret_scan, "scan_blobs", lambda b: (scanned.append({r["blob"] for r in b.select("blob").collect()}), plain(b))[1])
    want = cases.rows(secret_scan.scan(docs), "doc_id", "blob", "findings")
    secret_scan.scan(first, path).count()
    spark.conf.set(secret_scan.LEDGER_SETTING, path)
    try:
        assert cases.rows(secret_scan.scan(docs), "doc_id", "blob", "findings") == want
        masked = cases.rows(secret_scan.redacted(docs), *docs.columns)
    finally:
        spark.conf.unset(secret_scan.LEDGER_SETTING)
    assert masked == cases.rows(secret_scan.redacted(docs), *docs.columns)
    everything, begun, more, nothing = scanned[:4]
    assert begun and more and not begun & more and begun | more == everything and not nothing
    book = spark.read.parquet(path)
    assert book.count() == len(everything)
    # Two runs that appended the same blobs.
    assert cases.rows(secret_scan.scan(docs, book.unionByName(book)), "doc_id", "blob", "findings") == want


def test_redaction_masks_and_keeps_everything_else(spark):
    docs = cases.documents(spark)
    got = secret_scan.redacted(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    want = []
    for r in docs.collect():
        r = r.asDict()
        found = secret_scan.find(r["text"] or "")
        if found:
            r["text"] = secret_scan.masked(r["text"], found)
            r["n_chars"] = len(r["text"])
        want.append(tuple(r.values()))
    assert cases.rows(got, *docs.columns) == sorted(want, key=repr)
    assert secret_scan.masked("ab cd ef", [{"start": 0, "end": 4}, {"start": 3, "end": 5}, {"start": 6, "end": 8}]) == "[SECRET] [SECRET]"


BODY = ["MIIEowIBAAKCAQEAxQ+/" + f"{i:02d}" * 22 for i in range(5)] + ["Zq9/Kw=="]
BEGIN, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
FIELDS = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0011AABB\n\n"


@pytest.mark.parametrize("joined", ["\n", "\r\n", " ", "\\n", "\n    ", "\n> ", "\\r\\n", "\n\n"])
@pytest.mark.parametrize("end", [END, "", "-----END RSA PRIV", END.replace("RSA ", "")])
@pytest.mark.parametrize("fields", ["", FIELDS])
def test_no_part_of_a_private_key_survives(joined, end, fields):
    key = joined.join([BEGIN, *([fields.replace("\n", joined)] if fields else []), *BODY, *([end] if end else [])])
    out = secret_scan.masked(t := f"before it\n{key}\nand prose after it", secret_scan.find(t))
    assert not any(line[k:k + 6] in out for line in [*BODY, *(["4,ENCRYPTED", "0011AABB"] if fields else [])] for k in range(0, len(line) - 5, 6))
    assert out.startswith("before it\n[SECRET]") and out.endswith("prose after it") and ("PRIVATE" not in out)


def test_private_keys_end_where_they_should(spark):
    key = "\n".join([BEGIN, *BODY, END])
    cut = "\n".join([BEGIN, *BODY])
    short = "\n".join([BEGIN, *(BODY[0][k:k + 8] for k in range(0, 64, 8))])
    for text, want in [(f"{key} a word {key}", "[SECRET] a word [SECRET]"), (f"{cut}\nsome prose\n{key}!", "[SECRET]\nsome prose\n[SECRET]!"),
                       (f"{BEGIN} is the header", "[SECRET] is the header"), (f"{short}\nmore words", "[SECRET]\nmore words"), (END, END)]:
        assert secret_scan.masked(text, secret_scan.find(text)) == want
    docs = cases.documents(spark, [key, cut, f"x {key} y"])
    assert {r["text"] for r in secret_scan.redacted(docs).collect()} <= {"[SECRET]", "x [SECRET] y"}


@pytest.mark.parametrize("unit", [BEGIN, BEGIN + "\n", "-----BEGIN ", BEGIN + "-----END ", "\n", "A\n", "A" * 20 + " ", "\\", "\\n", " ", "A", "> a\n", "\\/",
                                  "Comment: x\n", "Version:\\"])
def test_private_keys_take_linear_time(unit):
    def seconds(n):
        text = BEGIN + unit * (n // len(unit))
        began = time.perf_counter()
        secret_scan.RULES["pem"][0].findall(text)
        return time.perf_counter() - began

    assert seconds(400_000) < 20 * min(seconds(50_000) for _ in range(3)) + 0.1


JWT = r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"


def test_web_tokens_are_those_of_the_plain_pattern():
    rng = random.Random(8)
    for _ in range(20_000):
        text = "".join(rng.choice(["eyJ", "ey", ".", "a", "J", " ", "-"]) for _ in range(rng.randrange(25)))
        assert [(f["start"], f["end"]) for f in secret_scan.find(text) if f["kind"] == "jwt"] == [m.span() for m in re.finditer(JWT, text)]


@pytest.mark.parametrize("unit", ["eyJ", "eyJ.", "eyJa.", "a", "eyJa.eyJb.", "password ", "ghp_", "xoxb-", "AKIA", "0a"])
def test_every_rule_takes_linear_time(unit):
    def seconds(n):
        began = time.perf_counter()
        secret_scan.find(unit * (n // len(unit)))
        return time.perf_counter() - began

    assert seconds(800_000) < 20 * min(seconds(100_000) for _ in range(3)) + 0.2


@pytest.mark.parametrize("scan", [license_scan.scan, secret_scan.scan, secret_scan.redacted, pii.scan])
def test_empty_table(spark, scan):
    assert scan(cases.empty(spark)).count() == 0
