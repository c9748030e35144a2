"""PII: base spans against the plain patterns, disclosure against plain counts."""

import hashlib
import math
import random
import re

from conftest import SF_MID
from edge import edge_docs, edge_rows, empty_docs

import __spark_entry__ as entry
from scorecast.llm import sanitise as S

#: The contract's patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and S.luhn(digits) or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return [(a, list(PATTERNS)[k], b) for a, k, b in sorted(out)]


def test_base_spans_equal_the_patterns():
    r = random.Random(5)
    pieces = ["4111 1111 1111 1111", "4111-1111-1111-1111", "0000000000000000", "1.2.3.4", "1.2.3.256", "1.2.3.4.5.6.7.8", "001.02.3.4", "a@b.c", "a@b", "@x.y", "a@b.c.d-e@f.g",
              "x+y@z-1.com.", "+1 (234) 555-6789", "++1234567890", "+12", "+1-2-3-4-5-6-7-8-9-0", " ", "-", ".", "é", "12", "7", "a@@b.c", "%@a..b", "99999999999999999999", "\n"]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 7)))
        assert S.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1 " * 150_000, "+1" * 150_000, "@" * 300_000, "1." * 150_000, "a@" * 150_000, "." * 300_000 + "@"):
        S.base_spans(text)
    assert S.base_spans("9" * 5000 + ".1.1.1") == []


def test_given_documents(spark):
    got = {r["doc_id"]: r for r in entry.queries()["op6_pii_sanitisation"](spark, SF_MID).collect()}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d, text in docs:
        spans = plain(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
        r = got[d]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[1] == k for s in spans) for k in PATTERNS]
        assert {*joined.split(",")} <= {*r["spans"].split(",")}


def corpus():
    """Ten texts on one person, with a telling name, a somewhat telling town and common words, among others."""
    r = random.Random(9)
    common = ["alpha", "beta", "gamma", "delta", "common", "words"]
    rows = []
    for i in range(10):
        rows.append((i, f"{r.choice(common)} zorblax {r.choice(common)} write to jo@secret.org {r.choice(common)} townville {i}"))
    rows += [(100 + i, " ".join(r.choice(common) for _ in range(12)) + (" townville" if i < 4 else "")) for i in range(200)]
    rows += [(400 + i, "onceonly stands by me@once.org in copies of one text") for i in range(5)]
    return rows


def test_disclosing_terms(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = S.find(docs)
    got = {(r["entity"], r["term"]): r for r in S.disclosing(docs, found).collect()}
    e = S._entity("email", "jo@secret.org")

    def share(word):
        has = [i for i, t in rows if word in t.split()]
        both = sum("jo@secret.org" in dict(rows)[i] for i in has)
        total, n = len(rows), 10
        return math.log2(both * total / (len(has) * n)) / math.log2(total / n)

    def term(word):
        return int(S.term_hashes(word.encode()).view("int64")[0])

    assert {t for x, t in got if x == e} == {term(w) for w in ("zorblax", "townville", "write", "to") if share(w) >= S.GENERALISE}
    for word in ("zorblax", "townville"):
        r = got[e, term(word)]
        assert math.isclose(r["share"], share(word), rel_tol=1e-9) and r["action"] == ("removed" if share(word) >= S.REMOVE else "generalised")
    assert not any(t == term("onceonly") for _, t in got)  # one text, however often copied
    clean = {r["doc_id"]: r["text"] for r in S.sanitised(docs).collect()}
    assert "zorblax" not in clean[3] and "[EMAIL]" in clean[3] and "[TERM]" in clean[3] and "secret" not in clean[3]
    assert clean[100] == dict(rows)[100]


def test_disclosing_terms_go_wherever_they_stand(spark):
    r = random.Random(4)

    def fill(n):
        return " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(n))

    rows = [(i, f"zorblax {fill(120)} mail jo@secret.org {fill(120)} Wu said {fill(60)} 李明 and Zorblax once more") for i in range(10)]
    rows += [(100 + i, f"{fill(20)} mail said and once more") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {x["doc_id"]: x["text"] for x in S.sanitised(docs).collect()}
    for i in range(10):
        assert not [w for w in ("zorblax", "Zorblax", "Wu", "李明", "secret") if w in clean[i]]
        assert "mail [EMAIL]" in clean[i] and "said" in clean[i]
    assert clean[100] == dict(rows)[100]


def test_edges(spark):
    docs = edge_docs(spark)
    out = S.report(docs).collect()
    assert len(out) == len(edge_rows()) and {r["spans"] for r in out} == {""}
    clean = S.sanitised(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert sorted(map(str, clean.collect())) == sorted(map(str, docs.collect()))
    assert S.report(empty_docs(spark)).count() == 0 and S.sanitised(empty_docs(spark)).count() == 0


def test_overlapping_spans_are_replaced_once():
    assert S.replaced("call +1 234 567 8901 now", [(5, "phone", 20), (6, "card", 20)]) == "call [PHONE] now"


def test_many_entities_in_one_document(spark, monkeypatch):
    """A directory page with hundreds of addresses and names: its pairs are dealt out, and equal the plain counts."""
    monkeypatch.setattr(S, "PRODUCT", 500)
    r = random.Random(2)
    people = [("".join(chr(97 + (i // 26**k) % 26) for k in range(3)) + "name", f"p{i}@x.org") for i in range(150)]
    fill = ["alpha", "beta", "gamma", "delta", "of", "a", "to"]
    rows = [(i, " ".join(f"{n} {m} {r.choice(fill)} page{i}" for n, m in people)) for i in range(2)]
    rows += [(10 + 4 * i + k, f"{r.choice(fill)} {n} wrote {m} {r.choice(fill)} {k}") for i, (n, m) in enumerate(people) for k in range(3)]
    rows += [(5000 + i, " ".join(r.choice(fill) for _ in range(8))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    total = len(rows)
    texts = {i: set(re.findall("[a-z]+", re.sub(r"\S+@\S+", " ", t))) for i, t in rows}
    whole = {i: set(re.findall("[a-z]+", t)) for i, t in rows}
    want = set()
    for n, m in people:
        has = [i for i, t in rows if m in t.split()]
        for word in set().union(*(texts[i] for i in has)):
            both = sum(word in texts[i] for i in has)
            n_term = sum(word in w for w in whole.values())
            if both >= S.SUPPORT and math.log2(both * total / (n_term * len(has))) / math.log2(total / len(has)) >= S.GENERALISE:
                want.add((S._entity("email", m), int(S.term_hashes(word.encode()).view("int64")[0])))
    got = [(x["entity"], x["term"]) for x in S.disclosing(docs, S.find(docs)).collect()]
    assert set(got) == want and len(got) == len(want) >= 150


def test_all_terms_are_counted(spark, monkeypatch):
    monkeypatch.setattr(S, "DISTINCT", 3)
    rows = [(i, f"A b{'' if i % 2 else ' cc'} Dd dd e{i}") for i in range(40)] + [(99, None), (98, "")]
    got = {x["term"]: x["n_term"] for x in S.term_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {w: got[int(S.term_hashes(w.encode()).view("int64")[0])] for w in ("a", "b", "cc", "dd")} == {"a": 40, "b": 40, "cc": 20, "dd": 40}
