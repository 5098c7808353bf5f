"""Secrets behind long chains of escapes and among many lines that look like compressed data."""

import base64
import gzip
import random
import time
import zlib

import pytest

from matchloom.llm import secrets

SECRET = "password=hunter22hunter22"


def spans(text):
    return secrets.scan(text)[1]


@pytest.mark.parametrize("chain", ["%" + "25" * 10_000 + "3D", "\\" + "u005c" * 4000 + "u003d", "&" + "#38;" * 5000 + "#61;"])
def test_long_chains(chain):
    text = f"cfg password{chain}hunter22hunter22 end"
    began = time.time()
    found = spans(text)
    assert time.time() - began < 10
    assert [(a, b) for how, a, b in found if how.endswith(">assign") and "escapes" in how] == [(4, len(text) - 4)]


def test_chains_level_by_level():
    value = "="
    for depth in range(1, 14):
        value = value.replace("%", "%25") if depth > 1 else "%3D"
        text = f"x password{value}hunter22hunter22 y"
        assert [(a, b) for _, a, b in spans(text)] == [(2, len(text) - 2)], depth


def test_many_lines_that_begin_like_zlib():
    r = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEF0123456789"
    junk = ["eN" + "".join(r.choices(letters, k=26)) for _ in range(20_000)]
    began = time.time()
    assert not [s for s in spans("\n".join(junk)) if s[0].endswith("assign")]
    assert time.time() - began < 15
    for how, packed in (("zlib", zlib.compress(SECRET.encode() * 3)), ("gzip", gzip.compress(SECRET.encode(), mtime=0))):
        code = base64.b64encode(packed).decode()
        lines = [code[i : i + 28] for i in range(0, len(code), 28)]
        text = "\n".join([*junk[:40], *lines, "", "after"])
        start = text.index(lines[0])
        assert (f"base64+{how}>assign", start) in [(k, a) for k, a, _ in spans(text)]


def test_form_spaces():
    assert [(a, b) for _, a, b in spans("q?a=1&password+%3D+hunter22hunter22&b=2")] == [(6, 35)]
    assert [(a, b) for k, a, b in spans("q?password+=+hunter22hunter22&b=2") if "form" in k] == [(2, 29)]


def test_streams_one_after_another():
    data = zlib.compress(b"nothing here") + zlib.compress(SECRET.encode())
    assert b"".join(secrets._expanded(memoryview(data), "zlib")) == b"nothing here"
    big = bytes(range(256)) * 60_000
    for how, packed in (("zlib", zlib.compress(big)), ("gzip", gzip.compress(big)), ("bzip2", __import__("bz2").compress(big)), ("zstd", __import__("zstandard").compress(big))):
        assert b"".join(secrets._expanded(memoryview(packed), how)) == big
        assert big.startswith(b"".join(secrets._expanded(memoryview(packed[:-20]), how)))
