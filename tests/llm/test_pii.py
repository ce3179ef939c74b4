"""Base spans against the contract's patterns in Python; contexts on a small corpus."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from nestline.llm import pii, queries
from tests.llm.helpers import documents

STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in match.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, p in STATED.items() for m in re.finditer(p, text or "") if holds(kind, m[0])]


def test_query_base_equals_patterns(spark, sf):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    rows = queries.QUERIES["op4_personal_data"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        kinds = Counter(s.split(":")[0] for s in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in pii.KINDS)
        spans = r.spans.split(",") if r.spans else []
        assert spans[:len(base)] == base and all(s.startswith("id:") for s in spans[len(base):])
        assert (r.n_added, r.private) == (len(spans) - len(base), bool(spans))


def test_hard_texts(spark):
    chosen = random.Random(2)
    texts = ["".join(chosen.choice(alphabet) for _ in range(chosen.randint(1, 80)))
             for alphabet in ("ab.@-_%", "0123. ", "0123456789 -", "+1234567890 ().-", "é🙂a@b.1 +-") for _ in range(150)]
    texts += [None, "", "a" * 60_000, "a@" * 5000, "1" * 60_000, "1 " * 20_000, "1.2.3.4 " * 3000, "a@b.co_x@d.com", "x@y@z.com",
              "4111 1111 1111 1111", "4111-1111-1111-1111-", "0004.0255.256.1 1.2.3.4.5.6.7.8", "+1 (499) 555-6503.", "🙂 me@x.org"]
    docs = documents(spark, [(i if i % 50 else None, t) for i, t in enumerate(texts)] + [(1, texts[1])] * 2, extra=("base", "kind", "added"))
    got = pii.scanned(docs.withColumn("body", F.col("text")), "text", "doc_id").select(pii.listed(F.col("base")).alias("s")).collect()
    assert Counter(r.s for r in got) == Counter(",".join(brute(t)) for t in texts + [texts[1]] * 2)


def test_plain_emails_and_spaced_phones_are_seeds(spark):
    names = ["john", "mary", "ann", "peter", "olga"]
    rows = [(i, f"please write to <{name}@example.com> today") for i, name in enumerate(names)]
    rows += [(10 + i, f"or call phone +1 (499) 555-650{i} at noon") for i in range(5)]
    rows += [(20 + i, f"paid with card: 4111 1111 1111 1111 by {name}") for i, name in enumerate(names)]
    rows += [(30, "please write to QX-123456 today"), (31, "or call phone 555-65091 at noon"), (32, "in 2024 form 2b AB-123456 was sent")]
    rows += [(40 + i, f"sent form 2b {name}@example.com in") for i, name in enumerate(names)]
    found = {r.doc_id: r for r in pii.find(documents(spark, rows)).collect()}
    text = dict(rows)
    for i, new in ((30, "QX-123456"), (31, "555-65091"), (32, "AB-123456")):
        begin = text[i].index(new)
        assert [(s.start, s.end) for s in found[i].added] == [(begin, begin + len(new))]
    assert all(found[i].added == [] for i in text if not 30 <= i < 40)


def test_contexts_find_what_no_rule_describes(spark):
    rows = [(i, f'prose here and staff no: {"abcdef0123456789"[i % 5:]}{i}zz1234567890 more') for i in range(20)]
    rows += [(100, "some prose then staff no: QX-1234/9 and more"), (101, "year after year 2001-2002 and 123456789 things"), (102, None)]
    found = {r.doc_id: r.added for r in pii.find(documents(spark, rows)).collect()}
    text = dict(rows)[100]
    assert [(s.start, s.end) for s in found[100]] == [(text.index("QX"), text.index(" and more"))]
    assert found[101] == [] and found[102] == [] and all(len(found[i]) == 1 for i in range(20))
    assert pii.find(documents(spark, rows).limit(0)).count() == 0
