import hashlib
import random
import re

from tablework.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum((2 * int(c) - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def passes(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": all(int(p) <= 255 for p in s.split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    rank = list(PLAIN)
    found = [(m.start(), rank.index(k), m.end(), k) for k, p in PLAIN.items() for m in re.finditer(p, text or "", re.ASCII) if passes(k, m.group())]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def base(spans):
    return ",".join(x for x in spans.split(",") if x.split(":")[0] in PLAIN)


def found(docs):
    return {r.doc_id: r.s for r in pii.find_personal_data(docs).select("doc_id", pii.as_text(pii.F.col("spans")).alias("s")).collect()}


def test_base_kinds_against_plain_patterns(spark, docs_of):
    draw = random.Random(4)
    bits = ["a.b@c.de", "@", "a", "_", ".", "-", " ", "é", "🙂", "1", "255", "256", "0001", "+", "+1 (361) 555-8283", "4929348385146306", "4929 3483-8514 6306", "1.2.3.4", "(", ")", "%", "\n", "x@y", "9" * 13, "00"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 25))) for _ in range(1500)]
    texts += ["1." * 500, "a@b.c" * 300, "7" * 30000, "a" * 50000 + "@b.c", ("5 " * 16 + ". ") * 40, "+1" * 500, "x.1@y.z " * 3000]
    rows = [*enumerate(texts), (-1, None), (-2, "")]
    got = found(docs_of(rows))
    assert {i: base(s) for i, s in got.items()} == {i: brute(t) for i, t in rows}
    assert got[-1] == got[-2] == ""


def test_added_kinds_need_their_checks(spark, docs_of):
    hexes = "0123456789abcdef" * 2
    rows = [
        (1, "IBAN DE89 3704 0044 0532 0130 00 here"),
        (2, "IBAN DE88 3704 0044 0532 0130 00 here"),
        (3, f'token = "{hexes}"'),
        (4, f"the digest {hexes} of a file"),
        (5, "ssn 123-45-6789"),
        (6, "part 123-45-6789"),
        (7, "call 361 555-8283 now"),
        (8, "sum 361 555-8283 now"),
        (9, "+1 (361) 555-8283 phone"),
    ]
    got = {i: {x.split(":")[0] for x in s.split(",") if x} - set(PLAIN) for i, s in found(docs_of(rows)).items()}
    assert got == {1: {"iban"}, 2: set(), 3: {"secret"}, 4: set(), 5: {"national_id"}, 6: set(), 7: {"local_phone"}, 8: set(), 9: set()}


def test_redact(spark, docs_of):
    docs = docs_of([(1, "é a.b@c.de, 1.2.3.4!"), (2, None), (3, "plain"), (3, "plain"), (4, "x@y.zz")]).withColumnRenamed("lang", "spans").withColumnRenamed("source", "found_spans")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=repr) == sorted(
        [(1, "é [EMAIL], [IP]!", 16), (2, None, None), (3, "plain", 5), (3, "plain", 5), (4, "[EMAIL]", 7)], key=repr
    )
    assert pii.redact(docs.limit(0)).count() == 0


def test_registered_query_digests(spark, docs_of, tmp_path):
    from tablework.llm import queries

    docs_of([(1, "a.b@c.de"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op5_pii_spans(spark, str(tmp_path)).collect()}
    assert (rows[1].n_email, rows[1].spans, rows[2].spans) == (1, "email:0:8", "")
    assert [rows[i].base_sha256 for i in (1, 2)] == [hashlib.sha256(x.encode()).hexdigest() for x in ("email:0:8", "")]


def test_empty_table(spark, docs_of):
    assert pii.find_personal_data(docs_of([])).count() == 0 and pii.redact(docs_of([])).count() == 0
