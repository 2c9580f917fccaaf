"""Secrets: fixed forms against the contract's wording, novelty against plain compression."""

import hashlib
import random
import re
import string

import pytest
import zstandard

from ledgerflow.llm import secrets
from tests.llm.helpers import ODD, docs_of, empty_docs, odd_docs, small

NAMES = b"get user name account client server config value service manager handler index store table request response"


def contract_spans(t):
    """The three forms, word for word."""
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in
                   ("password", "passwd", "secret", "token", "api_?key"))
    forms = [("assign", rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 8),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32)]
    out = [(m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(forms) for m in re.finditer(p, t) if ok(m)]
    return [(a, b, kind) for a, _, kind, b in sorted(out)]


def test_fixed_forms_match_the_contract():
    rnd = random.Random(5)
    pieces = ["password", "PassWd", "secret=token:abcdefghij", "api_key", "ApiKey", "toKen", "ſecret=abcdefgh1", "=", ":", " ", "  ", '"', "'",
              "abcd", "abcdefgh", "AKIA", "AKIAABCDEFGHIJKL", "AKIAAKIA12", "0123456789abcdef", "deadbeef" * 4, "\n", "é", "X", "-", "/+."]
    hits = 0
    for _ in range(4000):
        t = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 14)))
        assert secrets.fixed_spans(t) == contract_spans(t), t
        hits += len(contract_spans(t))
    assert hits > 1000


def made(rnd, kind):
    letters = {"b64": string.ascii_letters + string.digits, "hexlike": "0123456789ABCDEF", "mixed": string.ascii_letters + string.digits + "-_"}[kind]
    return "".join(rnd.choice(letters) for _ in range(rnd.randrange(24, 48)))


@pytest.mark.parametrize("kind", ["b64", "mixed"])
def test_random_strings_in_sensitive_contexts_are_found(kind):
    rnd, novelty, found = random.Random(11), secrets.Novelty(NAMES), 0
    for k in range(100):
        s = made(rnd, kind)
        t = f"client config value\nAuthorization: Bearer {s}\nserver request response {k}"
        found += any(a <= t.index(s) and b >= t.index(s) + len(s) and kind == "novel" for a, b, kind in secrets.all_spans(t, novelty)[1])
    assert found >= 95


def test_names_and_words_are_left_alone():
    novelty = secrets.Novelty(NAMES)
    for name in ("getUserNameAccount", "client_config_value", "service.manager.handler", "request/response/index", "server_config_server_config",
                 "aaaaaaaaaaaaaaaaaaaaaaaa"):
        t = f"the session key is stored under {name} of the user account table"
        assert secrets.all_spans(t, novelty)[1] == [], name
    # no sensitive word near, or on another line: not a candidate whatever it holds
    rnd = random.Random(2)
    assert list(secrets.candidates("index " + made(rnd, "b64"))) == []
    assert list(secrets.candidates("the key\n" + made(rnd, "b64"))) == []
    assert list(secrets.candidates("monkey " + made(rnd, "b64"))) == []
    assert len(list(secrets.candidates("apiKey " + made(rnd, "b64")))) == 1


def test_marginal_bytes_by_plain_compression():
    rnd, novelty = random.Random(4), secrets.Novelty(NAMES)
    d = zstandard.ZstdCompressionDict(NAMES, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    c = zstandard.ZstdCompressor(level=secrets.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
    for _ in range(30):
        s = made(rnd, "b64")
        t = "value " * rnd.randrange(100) + "pwd " + s + " index" * rnd.randrange(100)
        a = t.index(s)
        around = t[max(0, a - 256):a], t[a + len(s):a + len(s) + 256]
        assert novelty.marginal(t, a, a + len(s)) == len(c.compress(s.join(around).encode())) - len(c.compress("".join(around).encode()))


def test_a_copy_nearby_does_not_hide_a_secret():
    s, novelty = made(random.Random(9), "b64"), secrets.Novelty(NAMES)
    t = f"auth {s}\nauth {s}\n"
    assert len(secrets.all_spans(t, novelty)[1]) == 2


def test_dictionary_counts_all_documents(spark):
    docs = docs_of(spark, ["getUserName x9", "getUserName getUserName", "user_name UserOnly", "Zq" * 20, None])
    counts = {r.part: r.documents for r in secrets.identifier_parts(docs).collect()}
    assert counts == {"get": 2, "User": 3, "Name": 2, "user": 1, "name": 1, "Only": 1}
    assert secrets.dictionary(docs) == b"get Name User"
    assert secrets.dictionary(docs, 9) == b"User"


def test_large_texts_take_little_time():
    novelty = secrets.Novelty(NAMES)
    for t in ("token" * 100_000, "password " * 50_000, "a" * 500_000, "key " + "Zx9" * 100_000, "secret=" * 50_000, "token" + " " * 300_000 + "=x"):
        secrets.all_spans(t, novelty)


def test_digest(spark):
    docs = small(spark)
    rows = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    out = secrets.secrets_digest(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        want = contract_spans(rows[r["doc_id"]])
        base = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[2] == k for x in want) for k in ("assign", "access", "hex")]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("novel")] == [s for s in base.split(",") if s]


def test_odd_rows_and_redaction(spark):
    docs = odd_docs(spark)
    assert secrets.secrets_digest(docs).count() == len(ODD)
    assert all(r["n_novel"] == 0 for r in secrets.secrets_digest(docs).collect())
    assert secrets.secrets_digest(empty_docs(spark)).count() == 0
    assert secrets.redact(docs).columns == docs.columns
    got = secrets.redact(docs_of(spark, ["x password = 'abcdefgh12' y", None, "plain"])).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == ["x <assign>' y", None, "plain"]
