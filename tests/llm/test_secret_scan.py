"""Secret scan against regular expressions."""

import random
import re

from cohortalloc.llm import secret_scan as S

BASE = [
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
     lambda m: len(m[2]) >= 12),
    (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def by_regex(text):
    return sorted((m.start(), i, m.end()) for i, (rx, ok) in enumerate(BASE) for m in rx.finditer(text) if ok(m))


def test_base_spans_equal_regular_expressions():
    rnd = random.Random(3)
    signs = ["password", "PassWd", "secret", "token", "api_key", "apikey", "api", "_", "key", '"', "'", " ", "  ", ":", "=",
             "abcdef0123", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMN", "Z9", "x", "+/", "é", "中", "\n", "deadbeef"]
    scanner, found = S.scanner(), 0
    for _ in range(6000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 25)))
        want = by_regex(text)
        found += len(want)
        assert [x for x in scanner.scan(text) if x[1] < 3] == want, text
    assert found > 1000


def test_a_short_value_still_consumes_its_text():
    text = 'password: token="abcdefghijklmnop"'
    assert [x for x in S.scanner().scan(text) if x[1] == 0] == by_regex(text) == []


def test_added_rules():
    texts = {
        "github": "ghp_" + "a1B2" * 9, "slack": "xoxb-1234567890-abc", "google": "AIza" + "x" * 35,
        "payment": "sk_live_" + "Z" * 20, "jwt": "eyJ" + "a" * 20 + ".eyJ" + "b" * 20,
        "private_key": "-----BEGIN RSA PRIVATE KEY-----",
    }
    names = [r.name for r in S.RULES]
    for name, text in texts.items():
        assert (2, names.index(name), 2 + len(text)) in S.scanner().scan(f"é {text} end")


def test_minimised_automaton_has_no_equal_states():
    dfa = S.scanner((S.Rule("r", "ab?c|abc"),)).all
    rows = {(tuple(dfa.table[i * dfa.width : (i + 1) * dfa.width]), dfa.rules[i]) for i in range(len(dfa.rules))}
    assert len(rows) == len(dfa.rules)


def test_edge_cases(make_docs):
    key = "AKIA" + "A" * 16
    docs = make_docs([(1, None), (2, ""), (None, key), (3, key), (3, key), (4, "x " * 60_000 + key)])
    rows = S.scan(docs).collect()
    assert sorted(len(r.spans) for r in rows) == [0, 0, 1, 1, 1, 1]
    clean = S.redact(docs)
    assert clean.columns == docs.columns
    texts = [r.text for r in clean.collect()]
    assert texts.count(None) == 1 and texts.count("[secret]") == 3 and texts.count("") == 1
    assert all(r.n_chars == len(r.text) for r in clean.collect() if r.text is not None)
    assert S.scan(make_docs([])).count() == 0


def test_registered_query_equals_regular_expressions(spark):
    import hashlib

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = S.op2_secret_scan(spark, folder).collect()
    assert len(rows) == len(texts) and sum(r.n_assign + r.n_access + r.n_hex for r in rows) > 0
    for r in rows:
        want = by_regex(texts[r.doc_id])
        spans = ",".join(f"{('assign', 'access', 'hex')[kind]}:{a}:{b}" for a, kind, b in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))
