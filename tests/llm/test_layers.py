"""Secrets under further encodings, against a plain worklist."""

import base64
import binascii
import bz2
import gzip
import html
import lzma
import random
import re
import zlib

import pytest

from touchline.llm import secret_scan

SECRET = "password: abcdefgh12345678"


def b64(raw):
    return base64.b64encode(raw).decode()


def bare(raw):
    made = zlib.compressobj(wbits=-15)
    return made.compress(raw) + made.flush()


@pytest.mark.parametrize(
    "hidden",
    [
        b64(SECRET.encode("utf-16-le")), b64(SECRET.encode("utf-16")), b64(SECRET.encode("utf-16-be")), b64(b"\xfe\xff" + SECRET.encode("utf-16-be")),
        "&quot;password&quot;&colon;&#32;&quot;abcdefgh12345678&quot;", r"\u{70}assword: abcdefgh1234\u{00035}678", "&#X70;assword: abcdefgh12345678",
        b64(bare(f"some text, then {SECRET} and more".encode())), b64(bz2.compress(SECRET.encode())), b64(lzma.compress(SECRET.encode())),
        b64(bz2.compress(gzip.compress(SECRET.encode("utf-16-le")))), b64(bare(b64(bz2.compress(SECRET.encode())).encode())),
        "/v1/" + b64(bz2.compress(SECRET.encode())),
    ],
)
def test_layer_is_entered(hidden):
    text = f"before {hidden} after"
    assert [k for _, k, _ in secret_scan.decoded_spans(text)] == [0]
    start, _, end = secret_scan.decoded_spans(text)[0]
    assert 7 <= start < end <= 7 + len(hidden)
    assert secret_scan.base_spans(text) == []


@pytest.mark.parametrize("text", ["a &copy; b &nosuch; &amp", b64(bytes(range(256)) * 9), b64(zlib.compress(b"x" * 50)[:-9]), b64(b"BZh9 no stream at all, just text"), r"\u{} \u{110000}"])
def test_no_layer_is_no_secret(text):
    assert secret_scan.decoded_spans(text) == []


def noise(seed, n):
    return bytes(random.Random(seed).choices(b"ghijklmnopqrstuvwxyz ,", k=n))


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, lambda raw: raw])
def test_run_longer_than_the_largest_window(monkeypatch, pack):
    monkeypatch.setattr(secret_scan, "WINDOW_BYTES", 4 << 10)
    monkeypatch.setattr(secret_scan, "MOST_WINDOW_BYTES", 16 << 10)
    monkeypatch.setattr(secret_scan, "WINDOW_OVERLAP", 1 << 10)
    inner = b64(pack(noise(1, 90_000) + SECRET.encode() + noise(2, 90_000)))
    outer = b64(gzip.compress(b"(" + inner.encode() + b") " + noise(3, 9_000) + b" token=zyxwvutsrqponmlk ("))
    spans = secret_scan.decoded_spans(f"see {outer} here")
    assert spans == [(4, 0, 4 + len(outer))]
    twice = b64(gzip.compress(outer.encode()))
    assert secret_scan.decoded_spans(twice) == [(0, 0, len(twice))]


def plain_secrets(text, depth=6):
    """Secrets of a text and all that it unpacks to, without places: every escape
    decoded, every base64 run taken alone, every stream unpacked."""
    found, work, seen = set(), [(text, 0)], set()
    while work:
        layer, level = work.pop()
        if layer in seen or level > depth:
            continue
        seen.add(layer)
        found |= {layer[s:e] for s, _, e in secret_scan.base_spans(layer)}
        percent = re.sub("(?:%[0-9A-Fa-f]{2})+", lambda m: bytes.fromhex(m.group().replace("%", "")).decode("utf-8", "replace"), layer)
        coded = re.sub(r"\\u([0-9A-Fa-f]{4})", lambda m: chr(int(m.group(1), 16)), percent)
        work += [(html.unescape(coded), level + 1)]
        for run in re.findall("[A-Za-z0-9+/]{20,}={0,2}", layer):
            try:
                raw = base64.b64decode(run + "=" * (-len(run) % 4))
            except binascii.Error:
                continue
            for opened in (bytes, gzip.decompress, zlib.decompress, bz2.decompress, lzma.decompress, lambda r: zlib.decompress(r, -15)):
                try:
                    out = opened(raw)
                except (OSError, EOFError, zlib.error, lzma.LZMAError, ValueError):
                    continue
                work += [(out.decode("utf-8", "replace"), level + 1), (out.decode("utf-16-le", "replace"), level + 1)]
    return found


def test_nested_layers_against_a_plain_worklist():
    pick = random.Random(11)
    layers = [
        lambda t: b64(t.encode()), lambda t: b64(gzip.compress(t.encode())), lambda t: b64(zlib.compress(t.encode())), lambda t: b64(bz2.compress(t.encode())),
        lambda t: b64(bare(t.encode())), lambda t: b64(t.encode("utf-16-le")), lambda t: "".join(f"%{b:02X}" for b in t.encode()),
        lambda t: "".join(f"\\u{ord(c):04x}" for c in t), lambda t: "".join(f"&#{ord(c)};" for c in t), lambda t: html.escape(t) + " ",
    ]
    for n in range(150):
        secret = pick.choice([f"password: pw{n:04d}abcdefgh", f'"token" = "tk{n:04d}-abcdefgh"', f"AKIA{n:04d}ABCDEFGHIJKLMN"])
        text = f"a {secret} b"
        for _ in range(pick.randint(1, 3)):
            text = f"x {pick.choice(layers)(text)} y"
        want = {s for s in plain_secrets(text) if f"{n:04d}" in s}
        assert want and (secret_scan.base_spans(text) or secret_scan.decoded_spans(text)), text
