import hashlib
import random
import re

from pyspark.sql import functions as F

from rankweave.llm.pii import find_pii, mask_pii, op1_pii, spell

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    """The contract's base spans, by its patterns as they stand."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def made(n):
    rng = random.Random(7)
    bits = ["a@b.co", "x_y@c.d.e", "@", ".", "-", "+", "1", "4111111111111111", "4111 1111 1111 1111", "10.0.0.255", "1.2.3.4.5.6.7.8",
            "999.1.1.1", "0001.2.3.004", "+1 (743) 555-3824", " ", "é", "😀", "_", "%", "foo", "\n", "+49-30.1234567", "0000000000000000"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_base_spans_equal_the_plain_patterns(spark):
    texts = [None, "", " ", *made(600), "a" * 50_000, "1" * 50_000, "1." * 20_000, "a." * 20_000 + "@", ("a@" + "b." * 20_000 + "c")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = find_pii(docs).select("doc_id", spell(F.col("pii_base")).alias("s")).collect()
    assert len(found) == len(texts)
    for row in found:
        assert row.s == plain(texts[row.doc_id]), texts[row.doc_id][:80]


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op1_pii(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.spans.startswith(want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(f"{k}:") for k in PATTERNS]


def test_added_kinds_need_checksum_or_context(spark):
    texts = ["pay to IBAN DE89 3704 0044 0532 0130 00 now", "code DE88 3704 0044 0532 0130 00 now", "my SSN is 123-45-6789.",
             "part 123-45-6789.", "ssn 666-45-6789", 'token = "f33e61083db5dbdf4bd2369d2f80176e57f7"']
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pii_base string")
    kinds = [[s.kind for s in r.pii_added] for r in find_pii(docs).orderBy("doc_id").collect()]
    assert kinds == [["iban"], [], ["ssn"], [], [], ["secret"]]


def test_mask(spark):
    texts = ["mail é😀 a@b.co and +1 (743) 555-3824!", None, "", "none here 12"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = mask_pii(docs)
    assert out.columns == docs.columns
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["mail é😀 <EMAIL> and <PHONE>!", None, "", "none here 12"]
    assert mask_pii(docs.limit(0)).count() == 0
