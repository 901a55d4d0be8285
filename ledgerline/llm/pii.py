"""Personal data by weak supervision.

Candidate spans come from patterns, found with Spark's regular expressions:
``split`` gives the text between the matches and ``regexp_extract_all`` the
matches, so the running sum of their lengths gives places in code points.

Labelers vote on every candidate (1 personal, 0 not, null abstains):
the pattern's own check (digits, Luhn, ranges), a gazetteer (known top-level
domains, reserved addresses, issuer digits, country codes), and the context
(cue words before the match, what touches it). Expectation-maximisation over
the counted vote patterns estimates each labeler's hit and false-alarm rate
for each kind and a posterior for each pattern. A naive Bayes classifier of
span features, trained on those posteriors by Spark aggregates, has the last
word on spans that are not base ones. Base spans (below) always stay.

Base kinds are email, ip, card and phone; the method adds ``ssn`` and ``iban``.

Patterns never backtrack over long runs: runs are possessive, and a match
may only begin where its run begins or where the match before ended.

Defined results: null text has no spans; every row is answered, repeated rows
alike; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ssn", "iban")

# How many characters an account number has after its country and check digits.
IBAN_REST = {11: "NO", 12: "BE", 14: "DK FI FK FO GL NL SD", 15: "MK SI", 16: "AT BA EE KZ LT LU MN XK", 17: "CH CR HR LI LV",
             18: "BG BH DE GB GE IE ME RS VA", 19: "AE GI IL IQ OM SO TL", 20: "AD CZ ES MD PK RO SA SE SK TN VG", 21: "LY PT ST",
             22: "IS TR", 23: "BI DJ FR GR IT MC MR SM", 24: "AL AZ BY CY DO GT HN HU LB NI PL SV", 25: "BR EG PS QA UA",
             26: "JO KW MU YE", 27: "MT SC", 28: "LC", 29: "RU"}
_IBAN = "|".join(rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n}}}" for n, c in IBAN_REST.items())

# Fixed values. Each pattern finds the leftmost, non-overlapping matches of the plain form beside it.
_LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": rf"(?<![A-Z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})(?![A-Z0-9])",
}
# A cheap test that a text may hold the kind at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "ssn": r"[0-9]-[0-9]",
         "iban": r"[A-Z]{2}[0-9]{2}"}
TLDS = "com org net edu gov io de fr es it uk eu ch at nl info biz".split()
CUES = {"email": "mail|contact|write|escri|courriel|kontakt", "ip": "ip|address|host|server|from|adresse",
        "card": "card|visa|mastercard|credit|karte|carte|tarjeta", "phone": "phone|tel|call|mobile|fax|llam|appel",
        "ssn": "ssn|social|security", "iban": "iban|account|konto|compte|cuenta"}
BEFORE, AFTER = 32, 8  # context characters
ROUNDS = 25
STEP = "array<struct<kind:string,i:int,gap:bigint,match:string,before:string,head:string>>"
SPAN = "array<struct<start:bigint,rank:bigint,end:bigint,kind:string,base:boolean,probability:double>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn check of at most 19 digits."""
    d = F.reverse(digits)
    total = F.lit(0)
    for k in range(19):
        v = F.coalesce(F.substring(d, k + 1, 1).try_cast("int"), F.lit(0))
        total = total + (v if k % 2 == 0 else v * 2 - F.when(v > 4, 9).otherwise(0))
    return total % 10 == 0


def _octets(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: (F.char_length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))


def _iban(m: Column) -> Column:
    """Remainder 1 modulo 97 of the rearranged number."""
    c = F.regexp_replace(m, " ", "")
    moved = F.split(F.concat(F.substring(c, 5, 40), F.substring(c, 1, 4)), "")
    return F.aggregate(moved, F.lit(0), lambda r, ch: F.when(ch == "", r).when(
        ch.between("0", "9"), (r * 10 + F.coalesce(ch.try_cast("int"), F.lit(0))) % 97).otherwise(
        (r * 100 + F.ascii(ch) - 55) % 97)) == 1


def checked(kind: Column, m: Column) -> Column:
    """Whether a match passes its kind's conditions."""
    n = F.char_length(_digits(m))
    return (F.when(kind == "email", True).when(kind == "ip", _octets(m))
            .when(kind == "card", n.between(14, 19) & _luhn(_digits(m)))
            .when(kind == "phone", n.between(10, 15))
            .when(kind == "ssn", ~m.rlike("^(000|666|9)|-00-|-0000$"))
            .when(kind == "iban", _iban(m)).otherwise(False))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, kind, start, end, match, before, after): all matches of
    all patterns, once for each distinct (doc_id, text)."""
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(text.rlike("[0-9@]")).withColumn("digest", F.xxhash64("text"))
    # Matches and the gaps around them, evaluated once a row.
    cut = rows
    for kind in KINDS:
        held = text.rlike(HINTS[kind])
        cut = cut.withColumn(f"m_{kind}", F.when(held, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))))
        cut = cut.withColumn(f"g_{kind}", F.when(F.size(f"m_{kind}") > 0, F.split(text, PATTERNS[kind], -1)))

    def steps(kind: str) -> Column:
        made = F.transform(F.arrays_zip(f"m_{kind}", f"g_{kind}"), lambda z, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.char_length(z[f"g_{kind}"]).cast("bigint").alias("gap"),
            z[f"m_{kind}"].alias("match"), F.right(z[f"g_{kind}"], F.lit(BEFORE)).alias("before"),
            F.left(z[f"g_{kind}"], F.lit(AFTER)).alias("head")))
        return F.coalesce(made, F.from_json(F.lit("[]"), STEP))

    # The outer form: the plain one adds a filter that searches once more.
    each = cut.select("doc_id", "digest", F.inline_outer(F.concat(*map(steps, KINDS)))).filter("kind IS NOT NULL")
    once = each.dropDuplicates(["doc_id", "digest", "kind", "i"])
    of = Window.partitionBy("doc_id", "digest", "kind").orderBy("i")
    size = F.coalesce(F.char_length("match"), F.lit(0)).cast("bigint")
    end = F.sum(F.col("gap") + size).over(of.rowsBetween(Window.unboundedPreceding, 0))
    placed = once.withColumns({"end": end, "after": F.coalesce(F.lead("head").over(of), F.lit(""))})
    return placed.filter("match IS NOT NULL").select("doc_id", "digest", "kind", (F.col("end") - size).alias("start"), "end",
                                                     "match", "before", "after")


def with_votes(spans: DataFrame) -> DataFrame:
    """The labelers' votes and the classifier's features for every candidate."""
    kind, m = F.col("kind"), F.col("match")
    digits = _digits(m)
    tld = F.lower(F.element_at(F.split(m, r"\."), -1))
    known = (F.when(kind == "email", F.when(tld.isin(TLDS), 1))
             .when(kind == "ip", F.when(m.rlike(r"^(0|127|255)\."), 0).otherwise(1))
             .when(kind == "card", F.when(digits.rlike("^(4|5[1-5]|2[2-7]|3[47]|6)"), 1).otherwise(0))
             .when(kind == "phone", F.when(digits.rlike("^(1|7|20|2[1-9]|3[0-9]|4[0-9]|5[0-9]|6[0-9]|8[0-9]|9[0-9])"), 1))
             .when(kind == "iban", F.when(m.rlike("^(AT|BE|CH|DE|ES|FR|GB|IT|NL|PT)"), 1).otherwise(0)))
    cue = F.lit(False)
    for k in KINDS:
        cue = F.when(kind == k, F.lower("before").rlike(rf"(?:{CUES[k]})[^.]*$")).otherwise(cue)
    touched = F.col("before").rlike(r"[\p{L}0-9_]$") | F.col("after").rlike(r"^[\p{L}0-9_]")
    ok = checked(kind, m)
    return spans.withColumns({
        "ok": ok, "v_pattern": ok.cast("int"), "v_gazetteer": known.cast("int"), "v_cue": F.when(cue, 1),
        "v_touch": F.when(touched, 0).otherwise(1),
        "f_size": F.least(F.floor(F.char_length(m) / 4), F.lit(12)).cast("string"),
        # The outline of the match, in one of 256 bins.
        "f_shape": F.pmod(F.xxhash64(F.regexp_replace(F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), "[a-z]+", "a"),
                                                      "[A-Z]+", "A")), F.lit(256)).cast("string"),
        "f_left": F.when(cue, "cue").when(F.col("before") == "", "edge").when(F.col("before").rlike(r"\s$"), "blank").otherwise("joined"),
        "f_right": F.when(F.col("after") == "", "edge").when(F.col("after").rlike(r"^\s"), "blank").when(
            F.col("after").rlike(r"^[\p{L}0-9_]"), "joined").otherwise("mark")})


VOTES = ("v_pattern", "v_gazetteer", "v_cue", "v_touch")
FEATURES = ("f_size", "f_shape", "f_left", "f_right")


def reliabilities(patterns: list[tuple]) -> dict[tuple, float]:
    """Expectation-maximisation over counted vote patterns (kind, votes...,
    count): {(kind, votes...): posterior}. At most 3^4 patterns for each kind."""
    out: dict[tuple, float] = {}
    for kind in sorted({p[0] for p in patterns}):
        rows = [(p[1:-1], p[-1]) for p in patterns if p[0] == kind]
        prior, hit, alarm = 0.5, [0.8] * len(VOTES), [0.2] * len(VOTES)
        post = []
        for _ in range(ROUNDS):
            post = []
            for votes, _n in rows:
                yes, no = prior, 1 - prior
                for v, h, a in zip(votes, hit, alarm, strict=True):
                    if v is not None:
                        yes, no = yes * (h if v else 1 - h), no * (a if v else 1 - a)
                post.append(yes / (yes + no))
            total = sum(n for _, n in rows)
            mass = sum(p * n for p, (_, n) in zip(post, rows, strict=True))
            prior = min(0.99, max(0.01, (mass + 1) / (total + 2)))
            for k in range(len(VOTES)):
                seen = [(p, v[k], n) for p, (v, n) in zip(post, rows, strict=True) if v[k] is not None]
                # Smoothed towards the starting rates, so that silent labelers stay neutral and classes do not swap.
                hit[k] = (4 + sum(p * n * v for p, v, n in seen)) / (5 + sum(p * n for p, v, n in seen))
                alarm[k] = (1 + sum((1 - p) * n * v for p, v, n in seen)) / (5 + sum((1 - p) * n for p, v, n in seen))
        out |= {(kind, *votes): p for p, (votes, _) in zip(post, rows, strict=True)}
    return out


def classified(voted: DataFrame) -> DataFrame:
    """Adds ``probability``: naive Bayes over kind and features, trained on
    the posteriors of the vote patterns."""
    spark = voted.sparkSession
    keys = ["kind", *VOTES]
    counted = [tuple(r) for r in voted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).collect()]  # <= 6 * 3^4 rows
    post = reliabilities(counted)
    schema = "kind string, " + ", ".join(f"{v} int" for v in VOTES) + ", posterior double"
    table = spark.createDataFrame([(*k, p) for k, p in post.items()], schema)
    same = None
    for c in keys:
        eq = voted[c].eqNullSafe(table[c])
        same = eq if same is None else same & eq
    soft = voted.join(F.broadcast(table), same).select(*[voted[c] for c in voted.columns], "posterior")
    pairs = soft.select("kind", "posterior", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])))
    sums = pairs.groupBy("kind", "feature", "value").agg(F.sum("posterior").alias("yes"),
                                                         F.sum(1 - F.col("posterior")).alias("no"))
    whole = Window.partitionBy("kind", "feature")
    spread = F.count(F.lit(1)).over(whole)
    ratio = sums.select("kind", "feature", "value", (
        F.log((F.col("yes") + 1) / (F.sum("yes").over(whole) + spread))
        - F.log((F.col("no") + 1) / (F.sum("no").over(whole) + spread))).alias("ratio"))
    # A row for each kind, feature and value: joined, never collected.
    odds = F.log(F.col("posterior") + 1e-9) - F.log(1 - F.col("posterior") + 1e-9)
    out = soft.withColumn("odds", odds)
    for f in FEATURES:
        part = ratio.filter(F.col("feature") == f).select(F.col("kind").alias("k_"), F.col("value").alias("x_"),
                                                          F.col("ratio").alias(f"r_{f}"))
        out = out.join(part, (F.col("kind") == F.col("k_")) & (F.col(f) == F.col("x_")), "left").drop("k_", "x_")
        out = out.withColumn("odds", F.col("odds") + F.coalesce(F.col(f"r_{f}"), F.lit(0.0))).drop(f"r_{f}")
    return out.withColumn("probability", 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col("odds"))))))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, kind, start, end, probability, base) of all spans:
    every base span, and the others the classifier accepts."""
    spans = classified(stored(with_votes(candidates(docs)), "pii-spans"))
    base = F.col("kind").isin(*BASE) & F.col("ok")
    kept = spans.withColumn("base", base).filter(base | (~F.col("kind").isin(*BASE) & F.col("ok") & (F.col("probability") >= 0.5)))
    return kept.select("doc_id", "digest", "kind", "start", "end", "probability", "base")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its spans in order of start, then kind."""
    found = find(docs)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    gathered = found.groupBy(F.col("doc_id").alias("of_doc"), F.col("digest").alias("of_digest")).agg(F.array_sort(F.collect_list(
        F.struct("start", rank.alias("rank"), "end", "kind", "base", "probability"))).alias("spans"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("digest"))
    out = rows.join(gathered, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("digest") == F.col("of_digest")), "left")
    return out.select("doc_id", F.coalesce("spans", F.from_json(F.lit("[]"), SPAN)).alias("spans"))
