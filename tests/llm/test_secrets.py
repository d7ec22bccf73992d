"""The scan against running every pattern, as the contract words it, over every text."""

import hashlib
import random
import re

import pytest

from stratiform.llm.catalogue import QUERIES
from stratiform.llm.secrets import BASE_RULES, MORE_RULES, Rule, find_secrets, scan_texts
from stratiform.llm.trigrams import TrigramIndex, query_of

FOLDER = "/root/testdata/sf0.001"
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    text, found = text or "", []
    found += [(m.start(), 0, m.end(), "assign") for m in re.finditer(ASSIGN, text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


PIECES = [
    "token", "TOKEN", "pass", "word", "password", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "AKIAAKIA",
    "ABCDEFGH1234", "abcdef0123456789", "0123", "é", "\n", "secret=token", "xyzxyzxyzxyz", "K", "ſecret=abcdefghijklm",
]


def test_random_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 14))) for _ in range(6000)]
    assert sum(map(len, map(brute, texts))) > 300
    assert scan_texts(texts, BASE_RULES) == [brute(t) for t in texts]


def test_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op3_secret_scan"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r["spans"].split(","))


def test_further_rules_add_spans():
    text = "-----BEGIN RSA PRIVATE KEY----- https://user:pw@host ghp_" + "a1" * 20
    assert [s[0] for s in scan_texts([text], BASE_RULES + MORE_RULES)[0]] == ["private_key", "url_login", "code_host", "hex"]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "x " * 200_000 + "AKIA" + "Z" * 16), (None, "token=abcdefghijkl"), (4, "deadbeef" * 2), (4, "deadbeef" * 2)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, secrets int")
    got = find_secrets(frame)
    assert got.columns == ["doc_id", "text", "secrets"]
    found = sorted((str(r["doc_id"]), [tuple(s) for s in r["secrets"]]) for r in got.collect())
    assert found == [
        ("1", []), ("2", []), ("3", [("access", 400_000, 400_020)]), ("4", [("hex", 0, 16)]), ("4", [("hex", 0, 16)]),
        ("None", [("assign", 0, 18)]),
    ]
    assert find_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize(
    "pattern, clauses",
    [
        ("abcd", 1), ("ab", 0), ("abc|xyz", 1), ("abc|x", 0), ("(abc)?", 0), ("(abc)+", 1), ("abc.*xyz", 2), ("[a-z]+", 0),
        ("a(b|c)d", 1), ("(abc){2}", 1), ("x?abc", 1), ("abc(?=def)", 1), ("[^a]bcd", 1),
    ],
)
def test_queries(pattern, clauses):
    assert len(query_of(pattern)) == clauses


def test_candidates_hold_every_match():
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcxyzABC -") for _ in range(rng.randrange(40))) for _ in range(3000)]
    for pattern in ("abc", "(?i)abc", "a(b|c)x", "(ab|xy)+z", "abc.*xyz", "[ab]bc?[xy]z", "(abc|xyz|a-b)x", "ab{2,3}c"):
        query = query_of(pattern)
        wanted = frozenset(g for c in query for grams in c for g in grams)
        chosen = set(TrigramIndex(texts, wanted).candidates(query).tolist())
        assert {i for i, t in enumerate(texts) if re.search(pattern, t)} <= chosen
        assert not query or len(chosen) < len(texts)


def test_rules_of_ones_own(spark):
    frame = spark.createDataFrame([(1, "order 12-34 and 56-78")], "doc_id long, text string")
    rows = find_secrets(frame, (Rule("pair", r"\d\d-\d\d"),)).collect()
    assert [tuple(s) for s in rows[0]["secrets"]] == [("pair", 6, 11), ("pair", 16, 21)]


def test_long_runs_of_every_class_are_scanned_in_linear_time():
    import time

    from stratiform.llm.secrets import BASE_RULES, MORE_RULES, scan_texts

    size = 5_000_000
    runs = [
        "x://" + "a" * size, "eyJ" * (size // 3), "eyJ" + "a" * size + ".eyJ", "g" * size + "://u", "password" * (size // 8), "0" * size,
        "AKIA" * (size // 4), "token" + " " * size, "-----BEGIN " + "A " * (size // 2), "ghp_" * (size // 4), "://" * (size // 3) + "h://u:p@",
    ]
    for text in runs:
        began = time.perf_counter()
        scan_texts([text], BASE_RULES + MORE_RULES)
        assert time.perf_counter() - began < 20, text[:30]


def test_logins_begin_where_their_scheme_does():
    from stratiform.llm.secrets import BASE_RULES, MORE_RULES, scan_texts

    text = "see svn+ssh://me:pw@host, http://a:b@c"
    spans = [(kind, text[start:end]) for kind, start, end in scan_texts([text], BASE_RULES + MORE_RULES)[0] if kind == "url_login"]
    assert spans == [("url_login", "svn+ssh://me:pw@"), ("url_login", "http://a:b@")]
