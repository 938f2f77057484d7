"""Findings of known kind for operator 2: secrets, and what looks like one."""

from __future__ import annotations

import base64
import random
import string
import uuid
from collections.abc import Iterator

# Names before secrets, names before values that are none, and names that only hold a word of secrets.
SECRET_NAMES = ("password", "passwd", "db_password", "secret", "client_secret", "api_key", "apiKey", "token", "access_token", "authToken", "pwd", "private_key")
PLAIN_NAMES = ("checksum", "sha256", "md5", "commit", "revision", "etag", "build", "digest", "request_id", "session", "version", "trace", "url", "name")
HALF_NAMES = ("primary_key", "foreign_key", "sort_key", "key", "token_type", "password_field", "secret_name", "auth_mode", "key_column", "token_expires")
PLAIN_WORDS = (
    "account", "address", "amount", "order", "status", "created", "updated", "customer", "index", "value", "country", "language", "payment", "product",
    "reader", "region", "report", "request", "response", "service", "shipping", "storage", "summary", "supplier", "table", "user", "window", "writer",
)
MARKS = "!@#$%^&*-+_?~|"
MIXED = string.ascii_letters + string.digits
SIGNS = ("=", ": ", " = ", ":", " => ")


def _some(rng: random.Random, alphabet: str, least: int, most: int) -> str:
    return "".join(rng.choices(alphabet, k=rng.randint(least, most)))


def _words(rng: random.Random, words: list[bytes], n: int) -> list[str]:
    """Words of the corpus, or plain ones."""
    return [rng.choice(words).decode() if words and rng.random() < 0.5 else rng.choice(PLAIN_WORDS) for _ in range(n)]


def _typed(rng: random.Random, words: list[bytes]) -> str:
    """A password as people type it: a word with other signs in it."""
    word = list("".join(_words(rng, words, rng.randint(1, 2)))[:12])
    for i in rng.sample(range(len(word)), max(1, len(word) // 4)):
        word[i] = rng.choice("@3$0!15")
    return "".join(word).capitalize() + _some(rng, MARKS, 1, 2) + _some(rng, string.digits, 2, 5) + _some(rng, string.ascii_letters, 1, 4)


def examples(rng: random.Random, words: list[bytes]) -> Iterator[tuple[str, bytes, bytes, bytes, int]]:
    """(kind, before, value, after, label): one of every kind, with what stands before and after the value."""
    secret, plain, half, sign = (rng.choice(x) for x in (SECRET_NAMES, PLAIN_NAMES, HALF_NAMES, SIGNS))
    quote = rng.choice(("", "", '"', "'"))
    assigned, other, partly = (f"{name}{sign}{quote}" for name in (secret, plain, half))
    names = _words(rng, words, rng.randint(2, 4))
    digits = string.digits
    hexes = "0123456789abcdef"
    identifier = rng.choice("_-.").join(names) + rng.choice(("", "_v", "_", "")) + _some(rng, digits, 1, 4)
    camel = names[0] + "".join(x.capitalize() for x in names[1:]) + _some(rng, digits, 0, 2)
    stamp = f"20{rng.randint(10, 30)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}Z"
    random_bytes = base64.urlsafe_b64encode(rng.randbytes(rng.randint(18, 48))).decode().rstrip("=")
    example = rng.choice(("your-{}-here", "example-{}", "changeme_{}", "{}-placeholder", "sample.{}", "dummy_{}")).format(secret) + _some(rng, digits, 1, 6)
    stands = rng.choice(("${%s_%s}", "<your-%s-%s>", "get_%s(%s)", "os.environ[%s_%s]", "{{%s.%s}}")) % (secret.upper(), _some(rng, digits, 1, 3))
    phrase = " ".join([*names, _some(rng, digits, 1, 4)])
    odd = "".join(x + rng.choice(",;#%&") for x in (_some(rng, MIXED, 2, 4) for _ in range(4))) + _some(rng, digits, 1, 2)
    yield from (
        (kind, before.encode(), value.encode(), after.encode(), label)
        for kind, before, value, after, label in (
            ("hex secret", assigned, _some(rng, hexes, 12, 64), quote, 1),
            ("mixed secret", assigned, _some(rng, MIXED, 10, 48), quote, 1),
            ("small letters and digits", assigned, "".join(a + b for a, b in zip(_some(rng, string.ascii_lowercase, 6, 6), _some(rng, digits, 6, 6))), quote, 1),
            ("typed password", assigned, _typed(rng, words), quote, 1),
            ("password of many signs", assigned, _some(rng, MIXED + MARKS, 10, 24), quote, 1),
            ("separated password", assigned, odd, quote, 1),
            ("passphrase", f'{secret}{sign}"', phrase, '"', 1),
            ("base64 secret", assigned, random_bytes, quote, 1),
            ("bearer token", "Authorization: Bearer ", random_bytes, "", 1),
            ("password in a URL", f"{rng.choice(('postgres', 'mysql', 'https'))}://{names[0]}:", _typed(rng, words), f"@{names[1]}/x", 1),
            ("hex digest", other, _some(rng, hexes, 32, 64), quote, 0),
            ("id", other, str(uuid.UUID(int=rng.getrandbits(128))), quote, 0),
            ("base64 data", other, random_bytes, quote, 0),
            ("number", partly, _some(rng, digits, 8, 20), quote, 0),
            ("identifier under a secret name", assigned, identifier, "" if quote == "" else quote, 0),
            ("identifier under half a name", partly, identifier, quote, 0),
            ("camel case under half a name", partly, camel, quote, 0),
            ("time under half a name", partly, stamp, quote, 0),
            ("example", assigned, example, quote, 0),
            ("stands for another", assigned, stands, quote, 0),
            ("example in a URL", f"{rng.choice(('postgres', 'mysql', 'https'))}://{names[0]}:", rng.choice(("password", "${PASSWORD}", "<password>", "changeme1")), "@host/x", 0),
            ("free digest", "", _some(rng, hexes, 32, 64), "", 0),
            ("free path", "", "/".join(names) + "/" + camel, "", 0),
            ("free identifier", "", "_".join([*names, *names]), "", 0),
            ("long word", "", "".join([*names, *names]), "", 0),
        )
    )
