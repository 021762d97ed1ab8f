import re

from tidemark.llm import secret_scan as scan


def test_trigram_queries_are_mandatory():
    def holds(pattern, text):
        low = text.lower()
        return any(all(g in low for g in term) for term in scan.trigram_query(pattern))

    assert [frozenset()] == scan.trigram_query("[0-9a-f]+") == scan.trigram_query("a?b?") == scan.trigram_query("(abc|x)+")
    assert scan.trigram_query("abcd") == [{"abc", "bcd"}]
    assert set(scan.trigram_query("(?:one|two)[0-9]+")) == {frozenset({"one"}), frozenset({"two"})}
    assert set(scan.trigram_query("ab?cde")) == {frozenset({"acd", "cde"}), frozenset({"abc", "bcd", "cde"})}
    assert scan.trigram_query("x.*(foo|bar)?end") == [{"end"}]
    samples = {
        "assign": "API_KEY = 'abcdef'", "access": "AKIA" + "Q" * 16, "hex": "a" * 24, "private_key": "-----BEGIN EC PRIVATE KEY-----",
        "forge_token": "ghp_" + "a" * 36, "chat_token": "xoxb-1234567890", "web_token": "eyJabcdefgh.abcdefgh.abcdefgh",
        "payment_key": "sk_live_" + "a" * 16, "map_key": "AIza" + "b" * 35,
    }
    for rule in scan.RULES:
        assert re.search(rule.pattern, samples[rule.kind]) and holds(rule.pattern, samples[rule.kind])


def test_only_candidates_are_verified(spark):
    docs = spark.createDataFrame([(1, "nothing to see"), (2, "secret=abcdefg"), (2, "secret=abcdefg"), (3, "secrt ecr ret")], "doc_id long, text string")
    index = scan.postings(docs)
    assert {r.trigram for r in index.collect()} <= {"sec", "ecr", "cre", "ret"}
    assert scan.candidates(index).count() == 1
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in scan.find(docs).collect()}
    assert spans == {1: [], 2: [("assign", 0, 14)], 3: []}


def test_many_matches_in_one_text(spark):
    text = "é token=abcdef\n" * 2000
    row = scan.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(s) for s in row.spans] == [("assign", m.start(), m.end()) for m in re.finditer("token=abcdef", text)]


def test_long_keys_are_whole(spark):
    keys = {
        "forge_token": "ghp_" + "a" * 900, "chat_token": "xoxb-" + "1a" * 400, "payment_key": "sk_live_" + "Z9" * 300,
        "private_key": "-----BEGIN " + "VERY " * 30 + "PRIVATE KEY-----",
    }
    docs = spark.createDataFrame([(i, f"é {text} .") for i, text in enumerate(keys.values())], "doc_id long, text string")
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in scan.find(docs).collect()}
    for i, (kind, text) in enumerate(keys.items()):
        assert (kind, 2, 2 + len(text)) in spans[i]
