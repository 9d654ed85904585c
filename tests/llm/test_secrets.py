"""Secret spans, base ones by plain regular expressions."""

import base64
import gzip
import re
import urllib.parse
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm.secrets import redact_secrets
from eventloom.llm import secrets as S

KEY = "AKIA" + "Q" * 16
ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], S.KINDS.index(x[0]), x[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "PASSWD", "ſecret", "secret", "toKen", "api_key", "apiKey", "'", '"', " ", ":", "=", "abcdef1", "AKIA", "Q" * 9,
                                 "0123456789ab", "\n", "é", "%3D", "\\u003d", "&#61;", "%2", "YWJjZGVmZ2hpamts", "\U0001f600"]), max_size=14).map("".join))
def test_base_spans_equal_plain_regular_expressions(text):
    got, everything = S.scan(text)
    assert got == base(text)
    assert set(got) <= set(everything)


def added(text):
    found, everything = S.scan(text)
    return set(everything) - set(found)


def test_layers_map_to_the_text():
    text = "x token%3Dabcdef123 y"
    assert ("assign", 2, 19) in added(text)
    assert ("assign", 2, 21) in added("x tok\\u0065n=abcdef123"[:22] + "") or added("x tok\\u0065n=abcdef123")
    run = base64.b64encode(f"secret: {KEY}".encode()).decode()
    assert added(f"é {run} z") >= {("access", 2, 2 + len(run)), ("assign", 2, 2 + len(run))}
    packed = base64.b64encode(gzip.compress(f"password={KEY}".encode(), mtime=0)).decode()
    assert ("access", 1, 1 + len(packed)) in added(f"\n{packed}")
    nested = base64.b64encode(base64.b64encode(zlib.compress(b"api_key=abcdefgh"))).decode()
    quoted = urllib.parse.quote(nested)
    assert any(k == "assign" for k, _, _ in added(f"a {quoted} b"))


def test_every_decoded_layer_is_scanned():
    b64 = lambda raw: base64.b64encode(raw).decode()
    plain = f"password={KEY}"
    raws = [f"a\u00a0\ufeff\u200b\u200d\f\0 {plain}".encode(), b"\xff\xfe\x80 " + plain.encode(), plain.encode("utf-16"), plain.encode("utf-16-be"),
            b"\0\xffx" + gzip.compress(b"head\0\xff " + plain.encode(), mtime=0)]
    for raw in raws:
        assert ("access", 2, 2 + len(b64(raw))) in added(f"x {b64(raw)} y")
    deep = plain.encode()
    for _ in range(12):
        deep = zlib.compress(deep)
    assert ("access", 0, len(b64(deep))) in added(b64(deep))
    noise = "".join(f"{i * 7919 % 100003}:" for i in range(200))
    wrapped = base64.encodebytes(zlib.compress(f"{noise} {plain} {noise}".encode())).decode().strip()
    assert "\n" in wrapped and ("access", 2, 2 + len(wrapped)) in added(f"x {wrapped}")
    for word in ("com/cb/", "a-", "ab_", "abcd/"):
        assert any(k == "access" for k, _, _ in added(f"{word}{b64(plain.encode())}")), word


def test_cycles_bombs_and_odd_input_end():
    assert S.scan(None) == S.scan("") == ([], [])
    twice = "%2525252525" * 3 + "%25"
    S.scan(twice)
    bomb = base64.b64encode(zlib.compress(b"\0" * 1_000_000)).decode()
    assert S.scan(f"x {bomb}")[0] == []
    S.scan("A" * 100_000 + "=" * 5 + "\\U00110000 &#x110000; \\uD800")


def test_messy_rows_and_redaction(messy, empty_docs):
    rows = S.find_secrets(messy).collect()
    assert len(rows) == messy.count() and not any(r.spans for r in rows)
    docs = messy.limit(1).selectExpr("doc_id", f"'say token=\"abcdef12\" {KEY}!' AS text", "CAST(1 AS LONG) AS n_chars", "source AS spans")
    out = S.redact_secrets(docs).first()
    assert out.text == "say [SECRET]\" [SECRET]!" and out.n_chars == len(out.text) and out.spans == "x"
    assert S.find_secrets(empty_docs).count() == 0 and S.redact_secrets(empty_docs).count() == 0


def test_redaction_refuses_texts_it_cannot_read(spark):
    with pytest.raises(TypeError):
        redact_secrets(spark.sql("SELECT 1 AS doc_id, CAST('password=abcdef' AS binary) AS text"))
