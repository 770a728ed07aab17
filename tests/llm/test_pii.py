import hashlib
import random
import re

from pyspark.sql import functions as F

from strata.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (2 if n % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    """The base spans by the patterns as they stand."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            keep = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if keep:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def of(text, *kinds):
    return [f"{s.kind}:{s.start}:{s.end}" for s in pii.spans(text) if s.kind in (kinds or pii.BASE)]


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    tokens = ["a", "Z9", "@", "@@", ".", "..", "-", " ", "+", "1", "255", "256", "007", "4111 1111 1111 1111",
              "5500-0000-0000-0004", "+1 (743) 555-3824", "a.b@c.de", "10.0.0.1", "ü", "é1", "(", ")", "\n", "x@y", "%"]
    for _ in range(6000):
        text = "".join(rng.choice(tokens) for _ in range(rng.randint(1, 14)))
        assert of(text) == base(text), text


def test_base_spans_on_documents(spark, docs):
    rows = {r.doc_id: r for r in pii.digest(pii.found(docs)).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        want = base(text)
        kept = [s for s in rows[i].spans.split(",") if s.partition(":")[0] in pii.BASE]
        assert kept == want and rows[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in pii.BASE] == [sum(w.startswith(k) for w in want) for k in pii.BASE]
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows.values()) > 20


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")
    for n in range(300):
        digits = str(random.Random(n).randrange(10 ** 15))
        assert pii.luhn(digits) == plain_luhn(digits)


def test_added_spans_need_checksum_or_context():
    assert of("iban DE89 3704 0044 0532 0130 00, bic", "iban") == ["iban:5:32"]
    assert of("iban DE89 3704 0044 0532 0130 01", "iban") == []  # modulo 97
    assert of("DE89370400440532013000X", "iban") == []  # goes on
    assert of("order 17 4111 1111 1111 1111", "card_part") == ["card_part:9:28"]
    assert of("order 17 4111 1111 1111 1112", "card_part") == []
    assert of("social security 219-09-9999", "ssn") == ["ssn:16:27"] and of("part 219-09-9999", "ssn") == []
    assert of("call 555-867-5309", "phone_local") == ["phone_local:5:17"] and of("no 555-867-5309", "phone_local") == []
    assert of("tel +1 (743) 555-3824 20240101", "phone_part") == ["phone_part:4:21"]
    scores = {s.score for s in pii.spans("my card 4111111111111111")} | {s.score for s in pii.spans("number 4111111111111111")}
    assert scores == {1.0, 0.8}  # the context word adds


def test_long_runs_take_time_in_proportion():
    for run in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "1 " * 200_000, "+1" + "(" * 400_000, "@a" * 200_000,
                "AB12" + " C" * 100_000, "x@" + "a" * 400_000, "123-45-" * 60_000, "@" * 300_000):
        pii.spans(run)  # a quadratic pattern would take minutes
    text = "a" * 300_000 + "@b.c " + "9" * 5_000 + ".1.1.1"
    assert of(text) == ["email:0:300004"]


def test_odd_rows(spark, odd, nothing):
    rows = pii.digest(pii.found(odd)).collect()
    assert len(rows) == odd.count() and {r.n_card for r in rows} == {0}
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert pii.digest(pii.found(nothing)).count() == 0
    extra = odd.withColumn("spans", F.lit(1)).withColumn("kind", F.lit("x"))
    assert pii.found(extra).columns == ["doc_id", "spans"]


def test_masked_keeps_rows_and_columns(spark, odd):
    frame = spark.createDataFrame([(1, "mail a@b.cd or 10.0.0.1"), (2, None), (3, "")], "doc_id long, text string")
    assert [tuple(r) for r in pii.masked(frame, least=0.0).orderBy("doc_id").collect()] == [
        (1, "mail <email> or <ip>"), (2, None), (3, "")]
    same = pii.masked(odd)
    assert same.columns == odd.columns and same.exceptAll(odd).count() == 0
