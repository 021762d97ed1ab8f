import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import divergence

UNIT = 10**9


def brute(rows, least_docs=3, top=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower))) for text, lang, source in rows]
    out = Counter()
    for lang in {d[0] for d in docs}:
        mine = [(s, t) for at, s, t in docs if at == lang]
        df, n = Counter(), defaultdict(Counter)
        for s, t in mine:
            df.update(set(t))
            n[s].update(t)
        kept = [t for t, c in df.items() if c >= least_docs]
        everything = sum(n.values(), Counter())
        shares = lambda c: {t: 1 + UNIT * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}  # noqa: E731, B023
        p, whole = {s: shares(c) for s, c in n.items()}, shares(everything)
        far = lambda a, b: (a - b) ** 2 // b
        for s in p:
            pairs = [(sum(far(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(far(p[s][t], whole[t]), t) for t in kept if n[s][t] and p[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out[lang, s, part, item, v, rank] += 1
    return out


def found(spark, rows, **settings):
    frame = spark.createDataFrame([(*r, 1, "n") for r in rows], "text string, lang string, source string, n int, term string")
    return Counter(map(tuple, divergence.audit(frame, **settings).collect()))


ODD = [
    (None, None, None), ("", "en", "a"), ("one Two three", "en", "a"), ("ONE two", "en", "b"), ("one é É", "en", "a"), ("é_one`two@one[x{one", "en", "c"),
    ("é\x00one\x7fone 1two2", "en", "b"), (None, "en", "alone"), ("uno", "es", "a"), ("same words here", "fr", "a"), ("same words here", "fr", "a"),
    ("same words here", "fr", "a"), ("same\x85words　𝄞here", "fr", None), ("x " * 70_000, "en", "long"), ("x y", "en", ""), ("y x", "en", "b"),
    ("kurz", "de", "a"), ("lang", "de", "b"),
]


@pytest.mark.parametrize("held, entries, strip, cells", [(300_000, 400_000, 512, 1_000_000), (3, 4, 2, 3)])
def test_odd_rows(spark, monkeypatch, held, entries, strip, cells):
    for name, value in (("HELD", held), ("ENTRIES", entries), ("STRIP", strip), ("CELLS", cells)):
        monkeypatch.setattr(divergence, name, value)
    assert found(spark, ODD) == brute(ODD)
    assert found(spark, ODD, least_docs=1, top=2) == brute(ODD, 1, 2)
    assert not found(spark, [])


def test_many_sources(spark):
    rows = [(" ".join(f"w{c}{'abcdefgh'[(i * c) % 8]}" .replace(str(c), "x" * c) for c in range(1, 9)) + " common", "en", f"s{i % 70}") for i in range(400)]
    assert found(spark, rows) == brute(rows)


def test_terms_against_the_pattern():
    text = "".join(map(chr, range(1, 700))) + "ÀÉİK ABC.def"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert [t.decode() for t in divergence.terms(text.encode())] == re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.translate(lower))
