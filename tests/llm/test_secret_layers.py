import base64
import bz2
import gzip
import lzma
import random
import textwrap
import zlib

import pytest

from cardwarden.llm import secrets
from cardwarden.llm.secrets import all_spans

SECRET = b"password = hunter2hunter2"
B64 = lambda data: base64.b64encode(data).decode()
NOISE = random.Random(1).randbytes(200)


@pytest.mark.parametrize("hidden", [
    B64(gzip.compress(gzip.compress(SECRET))),
    B64(gzip.compress(bz2.compress(lzma.compress(zlib.compress(SECRET))))),
    "".join(f"%{b:02X}" for b in gzip.compress(SECRET)),
    "".join(f"\\x{b:02x}" for b in gzip.compress(SECRET)),
    "".join(f"\\x{b:02x}" for b in zlib.compress(SECRET)),
    B64(gzip.compress(b"nothing here") + gzip.compress(SECRET)),
    B64(gzip.compress(b"passw") + gzip.compress(b"ord = hunter2hunter2")),
    B64(gzip.compress(b"one") + bz2.compress(SECRET)),
    *[B64(c.encode() + b" " + SECRET) for c in (" ", "\f", "﻿", "​", "　")],
    B64(gzip.compress(" \f".encode() + SECRET)),
    B64(b"caf\xe9 " + SECRET),
    B64(gzip.compress(b"caf\xe9 " + SECRET)),
    "\n".join(textwrap.wrap(B64(gzip.compress(NOISE + SECRET)), 76)),
    "\r\n".join(textwrap.wrap(B64(b"plain " * 20 + SECRET), 76)),
    *["abc"[:n] + "/" + B64(SECRET) for n in range(4)],
    "x/" + B64(gzip.compress(SECRET)),
])
def test_planted(hidden):
    base, every = all_spans(f"before {hidden} after")
    assert base == [] and {k for k, _, _ in every} == {"assign"}
    assert all(7 <= a < b <= 7 + len(hidden) for _, a, b in every)


def test_large_compressed_layer_is_scanned():
    line = b"nothing to see in this line of the log, number 12345\n"
    data = line * 700_000 + SECRET + b"\n" + line * 700_000 + b"AKIA" + b"Z" * 16 + b"\n"
    assert len(data) > 64 << 20
    _, every = all_spans(f"before {B64(gzip.compress(data, 1))} after")
    assert {k for k, _, _ in every} == {"assign", "access"}


def test_parts_do_not_cut_tokens(monkeypatch):
    rng = random.Random(2)
    words = ["password", " = ", "'", "hunter2hunter2", "\n", " ", "AKIA" + "Z" * 16, "0a" * 12, "é", B64(SECRET), "%41", ".", "\n".join(textwrap.wrap(B64(NOISE + SECRET), 76))]
    for block in (50, 64, 333):
        monkeypatch.setattr(secrets, "BLOCK", block)
        for _ in range(60):
            data = "".join(rng.choices(words, k=60)).encode()
            parts = list(secrets._parts(data))
            assert "".join(parts).encode() == data
            kinds = lambda texts: sorted(k for t in texts for k, _, _ in secrets.scan(t))
            runs = lambda texts: sorted(m.group() for t in texts for m in secrets.WRAPPED.finditer(t))
            assert kinds(parts) == kinds([data.decode()]) and runs(parts) == runs([data.decode()])
