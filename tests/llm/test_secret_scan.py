import base64
import hashlib
import json
import re

from stratum.llm import secret_scan as S

ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    spans = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    joined = ",".join(f"{S.BASE_KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*[sum(s[1] == k for s in spans) for k in range(3)], hashlib.sha256(joined.encode()).hexdigest())


def run(docs):
    return S.digests(S.find_secrets(docs)).collect()


def test_base_spans_of_the_table(documents, texts):
    got = {r.id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in run(documents)}
    assert got == {i: brute(t) for i, t in texts.items()}
    assert sum(v[0] + v[1] + v[2] for v in got.values())


def test_a_failing_match_still_takes_its_text():
    assert S.base_spans("token: secret: abcdefghijkl") == []
    assert [s[2] for s in S.base_spans("ſecret=abcdefghijklm Secret=abcdefghijklm")] == ["assign"]


def der(*parts, tag=0x30):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


KEY = der(der(b"\x00", tag=2), der(bytes(range(1, 200)), tag=2), der(b"\x01\x00\x01", tag=2))


def kinds(text):
    return [s.kind for s in S.scan(text)]


def test_structures():
    b64 = base64.b64encode(KEY).decode()
    assert kinds(f"key {b64} end") == ["der"]
    assert "der" in kinds(f"hex {KEY.hex()} end")
    assert kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{b64}\n-----END RSA PRIVATE KEY-----") == ["pem"]
    assert "der" not in kinds(base64.b64encode(KEY[:-3]).decode())          # cut: lengths do not nest
    assert "pem" not in kinds("-----BEGIN PRIVATE KEY-----\nAAAA\n-----END PRIVATE KEY-----")
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    good = f"{part({'alg': 'HS256'})}.{part({'sub': 1})}.c2ln"
    assert kinds(good) == ["jwt"]
    assert kinds(f"{part({'typ': 'JWT'})}.{part({'sub': 1})}.c2ln") == []
    spans = S.scan(f"token={good}")
    assert [s.kind for s in spans] == ["assign", "jwt"] and all(s.confirmed for s in spans)


def wrapped(text, width, newline="\n"):
    return newline.join(text[i:i + width] for i in range(0, len(text), width))


def spans_of(text, kind):
    return [text[s.start:s.end] for s in S.scan(text) if s.kind == kind]


def test_wrapped_der_without_armour():
    b64 = base64.b64encode(KEY).decode()
    for width, newline in ((64, "\n"), (76, "\r\n"), (40, "\n   "), (10_000, "\n")):
        body = wrapped(b64, width, newline)
        for after in ("\nand some prose follows it", "", "\n\nnext", " x"):
            assert spans_of(f"key:\n{body}{after}", "der") == [body]
    assert spans_of(wrapped(base64.b64encode(KEY[:-9]).decode(), 64) + "\nprose", "der") == []
    short = der(der(b"\x00", tag=2), der(bytes(range(1, 60)), tag=2))           # a length of one byte, no padding
    assert spans_of(f"a {base64.b64encode(short).decode()} b", "der") == [base64.b64encode(short).decode()]


def test_base64_of_pem():
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{wrapped(base64.b64encode(KEY).decode(), 64)}\n-----END RSA PRIVATE KEY-----"
    for tail in ("", "\n", "\n\n"):
        once = base64.b64encode((pem + tail).encode()).decode()
        for text in (once, wrapped(once, 76)):
            [found] = spans_of(f"config: {text} # end", "pem")
            assert text.startswith(found) and len(text) - len(found) <= 6
            assert kinds(f"config: {text} # end") == ["pem"]
    broken = pem.replace("END RSA", "END")
    assert kinds(base64.b64encode(broken.encode()).decode()) == []


def test_encrypted_pem():
    def text(headers, body):
        return f"-----BEGIN RSA PRIVATE KEY-----\n{headers}\n{wrapped(base64.b64encode(body).decode(), 64)}\n-----END RSA PRIVATE KEY-----"
    iv = "0123456789ABCDEF" * 2
    secret = bytes(range(7, 247)) * 2
    assert kinds(text(f"Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{iv}\n", secret)) == ["pem"]
    assert kinds(text(f"Proc-Type: 4,ENCRYPTED\nDEK-Info: DES-EDE3-CBC,{iv[:16]}\n", secret)) == ["pem"]
    assert kinds(text(f"Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{iv}\n", secret[:-1])) == []      # not whole blocks
    assert kinds(text("Proc-Type: 4,ENCRYPTED\n", secret)) == []
    assert kinds(text("Comment: mine\n", KEY)) == ["pem"]


def test_tokens_whose_header_is_spaced():
    part = lambda x: base64.urlsafe_b64encode(x.encode()).decode().rstrip("=")
    for header in ('{ "alg": "HS256" }', '{\n"alg":"HS256"}', '{\r\n "alg":"HS256"}', '{\t"alg":"HS256"}', '{"alg":"HS256"}'):
        for claims in ('{"sub":1}', '{\n "sub": 1 }'):
            token = f"{part(header)}.{part(claims)}.c2ln"
            assert spans_of(f"x {token}, y", "jwt") == [token]
    assert kinds("eyes.are.open ewe.are.here they.were.there") == []


def test_openssh():
    field = lambda b: len(b).to_bytes(4, "big") + b
    data = S.OPENSSH_MAGIC + field(b"none") * 2 + field(b"") + (1).to_bytes(4, "big") + field(b"pub")
    text = "-----BEGIN OPENSSH PRIVATE KEY-----\n" + base64.b64encode(data).decode() + "\n-----END OPENSSH PRIVATE KEY-----"
    assert kinds(text) == ["pem"]


def test_mask():
    text = "a token=abcdefghijklmnop b " + "0" * 20 + " c"
    assert S.mask(text, S.scan(text)) == "a <secret:assign> b <secret:hex> c"


def test_odd_rows(odd_docs, no_docs):
    got = sorted(((r.id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in run(odd_docs)), key=str)
    assert got == sorted(((r.doc_id, *brute(r.text or "")) for r in odd_docs.collect()), key=str)
    assert run(no_docs) == []
    masked = S.mask_secrets(odd_docs)
    assert masked.schema == odd_docs.schema and masked.count() == odd_docs.count()
    assert masked.where("doc_id = 8").first().text.startswith("<secret:assign>")
    assert masked.where("text is null").count() == 2
