import hashlib
import math
import random
import re
from collections import Counter

import pytest

from tidemark.llm import pii, queries


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
    out += [("ip", *m.span()) for m in ips if all(int(p) <= 255 for p in m[0].split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
    out += [("card", *m.span()) for m in cards if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
    return out + [("phone", *m.span()) for m in phones if 9 <= len(digits(m[0])) <= 15]


def test_base_spans_are_those_of_the_plain_patterns():
    draw = random.Random(2)
    parts = [*"a.b@_-+ 019()", "1.2.3.4", "4111111111111111", "@x.y", "+12345678", "é", "255", "256", "0001"]
    for _ in range(30_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_no_long_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1.1." * 100_000, "+" * 200_000, "a." * 100_000 + "@"):
        pii.base_spans(text)


ROWS = [
    (1, None), (None, None), (None, "x@y.zz"), (2, ""), (3, "9" * 4000 + ".1.2.3"), (3, "mail bob@corp.com now"), (3, "mail bob@corp.com now"),
    *[(100 + i, f"agent zorblax{i % 2} lives near bob@corp.com with Zimble on day {i + 10}") for i in range(8)],
    *[(200 + i, f"the day is fine near with on agent lives {i}") for i in range(50)],
]


def plain_terms(rows, window=pii.WINDOW):
    """Shares by the formula, over lists in memory."""
    words = lambda s: [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", s)]
    of_term, total, near, contexts = Counter(), 0, Counter(), {}
    for _, t in rows:
        for *_, w in words(t or ""):
            if len(w) > 1:
                of_term[w] += 1
                total += 1
    for _, t in rows:
        spans = plain_spans(t or "")
        for kind, s, e in spans:
            free = [w for w in words(t) if len(w[2]) > 1 and not any(a < w[1] and w[0] < b for _, a, b in spans)]
            before, after = [w for w in free if w[0] < s][-window:], [w for w in free if w[0] > s][:window]
            around = tuple(w[2] for w in before + after)
            for w in around:
                pair = (f"{kind}:{t[s:e].lower()}", w)
                near[pair] += 1
                contexts.setdefault(pair, set()).add(around)
    of_entity = Counter()
    for (e, _), n in near.items():
        of_entity[e] += n
    def share(n, everywhere, c):
        return min(1.0, math.log(n * total / (max(n, everywhere) * c)) / math.log(max(total, c + 1) / c))

    def sure(k, rest):
        n, z = k + rest, 1.645
        p = k / n
        return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)

    out = {}
    for (e, t), n in near.items():
        own, bound = share(n, of_term[t], of_entity[e]), sure(len(contexts[e, t]), max(of_term[t], n) - n)
        if own < pii.GENERALISE or bound < pii.SURE_ENOUGH:
            continue
        general = None
        for k in (4, 3, 2, 1):
            if len(t) > k:
                mine = sum(m for (f, u), m in near.items() if f == e and len(u) > k and u.endswith(t[-k:]))
                every = sum(m for u, m in of_term.items() if len(u) > k and u.endswith(t[-k:]))
                if share(mine, every, of_entity[e]) < pii.GENERALISE:
                    general = t[-k:]
                    break
        out[e, t] = (own, bound, "remove" if own >= pii.REMOVE and bound >= pii.SURE else "generalise", general)
    return out


def plain_found(rows):
    """All spans of every row, as written, by the formula over lists in memory."""
    told, out = plain_terms(rows), Counter()
    for d, t in rows:
        t = t or ""
        spans = plain_spans(t)
        added = {}
        for kind, s, e in spans:
            value = t[s:e].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", t[s:e])
            low = max([0, *[m.end() for m in re.finditer(r"\n|[.!?]+(?=\s)", t) if m.end() <= s]])
            high = min([len(t), *[m.end() for m in re.finditer(r"\n|[.!?]+(?=\s)", t) if m.end() > s]])
            free = [
                (m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", t)
                if low <= m.start() and m.end() <= high and len(m[0]) > 1 and not any(a < m.end() and m.start() < b for _, a, b in spans)
            ]
            for a, b, w in [w for w in free if w[0] < s][-pii.WINDOW:] + [w for w in free if w[0] > s][:pii.WINDOW]:
                if (f"{kind}:{value}", w) in told:
                    added[a, b] = max(added.get((a, b), ""), told[f"{kind}:{value}", w][2])
        more = sorted((k, a, b) for (a, b), k in added.items())
        out[d, ",".join(f"{k}:{a}:{b}" for k, a, b in [*spans, *more])] += 1
    return out


def test_disclosing_terms_are_those_of_the_formula(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    found = {(r.entity, r.term): (r.share, r.sure, r.action, r.general) for r in pii.disclosures(pii.scan(docs), pii.word_counts(docs)).collect()}
    wanted = plain_terms(ROWS)
    assert found.keys() == wanted.keys() and {"zorblax0", "zorblax1", "zimble"} <= {t for _, t in found}
    for p, w in wanted.items():
        assert found[p][:2] == pytest.approx(w[:2]) and found[p][2:] == w[2:], p
    assert {t: found["email:bob@corp.com", t][2] for t in ("zorblax0", "zorblax1", "zimble")} == dict.fromkeys(("zorblax0", "zorblax1", "zimble"), "remove")


def test_all_spans_are_those_of_the_formula(spark, tables):
    folder = tables(documents=(ROWS, "doc_id long, text string"))
    assert Counter((r.doc_id, r.spans) for r in queries.op10_pii(spark, folder).collect()) == plain_found(ROWS)


@pytest.mark.parametrize("others", [200, 3000])
def test_one_sighting_removes_nothing_whatever_the_size(spark, others):
    rows = [(1, "please call about the order of zoe@corp.com today")] + [(10 + i, f"we sent all goods to them last week {i}") for i in range(others)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = {r.term: r.action for r in pii.disclosures(pii.scan(docs), pii.word_counts(docs)).collect()}
    assert told and set(told.values()) == {"generalise"}
    text = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}[1]
    assert "[email]" in text and len(text.split()) == 8


def test_query_and_texts(spark, tables, documents):
    rows = [*documents, *ROWS]
    folder = tables(documents=([(*r, "k", 1) for r in rows], "doc_id long, text string, spans string, n int"))
    got = Counter()
    for r in queries.op10_pii(spark, folder).collect():
        got[tuple(r)[:6]] += 1
    expected = Counter()
    for d, t in rows:
        spans = plain_spans(t or "")
        n = Counter(s[0] for s in spans)
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        expected[(d, *(n[k] for k in pii.KINDS), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert got == expected
    docs = spark.createDataFrame([(*r, "k", 1) for r in ROWS], "doc_id long, text string, spans string, n int")
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in clean.collect()]
    assert len(texts) == len(ROWS) and texts.count((3, "[word] [email] [word]")) == 2 and (1, None) in texts
    text = dict(texts)[100]
    assert text.startswith("agent  lives near [email] with  on day ") and "zorblax" not in text


def test_cleaned_handles_overlaps_and_general_terms():
    text = "Zoe called 555 from home"
    assert pii.cleaned(text, "generalise:0:3:oe,generalise:11:14:,remove:20:24:") == "[-oe] called [number] from "
    assert pii.cleaned(text, "generalise:0:3:") == "[word] called 555 from home"
    assert pii.cleaned("a 1.2.3.4.5 b", "ip:2:9:,phone:4:11:") == "a [ip] b" and pii.cleaned(text, "") == text


def test_rare_entities_are_covered(spark):
    common = [(1000 + i, f"people write and the office will answer all of them in time again {i % 7}") for i in range(400)]
    rows = [
        (1, "people write to Zimbelda and the office will answer: ann@corp.com"),
        (2, "the office will answer Quorvax at bea@corp.com"), (3, "people write to Quorvax in time at bea@corp.com"), *common,
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scanned, counts = pii.scan(docs), pii.word_counts(docs)
    told = pii.disclosures(scanned, counts)
    found = {(r.entity, r.term): r.action for r in told.collect()}
    assert found[("email:ann@corp.com", "zimbelda")] == "generalise" and found[("email:bea@corp.com", "quorvax")] == "generalise"
    assert not {t for _, t in found} & {"people", "write", "office", "answer", "the"}
    texts = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "Zimbelda" not in texts[1] and "Quorvax" not in texts[2] + texts[3]
    cover = {(r.kind, r.seen): (r.entities, r.reached) for r in pii.coverage(scanned, told).collect()}
    assert cover == {("email", 1): (1, 1), ("email", 2): (1, 1)}
