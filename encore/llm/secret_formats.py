"""Labelled findings that ship with the secret scanner: values of many formats in neutral surroundings.

All values are drawn from rules by a seeded generator; none is a real credential. Secrets and harmless values stand in
the same sentences, so that only the value tells them apart.
"""

from __future__ import annotations

import random
import string
from collections.abc import Callable

ALNUM = string.ascii_letters + string.digits
BASE36 = string.ascii_lowercase + string.digits
_ONSETS = "b c d f g h j k l m n p r s t v w z br ch cl cr dr fl fr gr pl pr sch sh sp st str th tr qu".split()
_VOWELS = "a e i o u ai au ea ee ei ie io ou".split()
_ENDS = ["", "", "n", "r", "s", "t", "l", "m", "nd", "ng", "nt", "rt", "st", "ck", "x"]
_AROUND = ["the value {} was sent", "use {} here", "'{}'", '"{}",', "export KEY {}", "line 3: {}", "({})", "see {} for more", "x = {};", "und {} ist es", "- {}\n- next", "id {} ok",
           "curl -H {} https", "<td>{}</td>", "avec {} dans", "{} "]


def _some(rng: random.Random, chars: str, n: int) -> str:
    return "".join(rng.choice(chars) for _ in range(n))


def _word(rng: random.Random, most: int = 3) -> str:
    return "".join(rng.choice(_ONSETS) + rng.choice(_VOWELS) + rng.choice(_ENDS) for _ in range(rng.randint(1, most)))


def _words(rng: random.Random, n: int, by: str = "") -> str:
    return by.join(_word(rng) for _ in range(n))


#: Secrets by format.
SECRETS: dict[str, Callable[[random.Random], str]] = {
    "ghp": lambda r: "ghp_" + _some(r, ALNUM, 36),
    "sk_live": lambda r: r.choice(["sk_live_", "rk_live_", "pk_test_"]) + _some(r, ALNUM, 24),
    "sk": lambda r: "sk-" + _some(r, ALNUM, 48),
    "xoxb": lambda r: f"xox{r.choice('bp')}-{_some(r, string.digits, 11)}-{_some(r, ALNUM, 24)}",
    "glpat": lambda r: "glpat-" + _some(r, ALNUM + "_-", 20),
    "npm": lambda r: "npm_" + _some(r, ALNUM, 36),
    "AIza": lambda r: "AIza" + _some(r, ALNUM + "_-", 35),
    "hf": lambda r: "hf_" + _some(r, string.ascii_letters, 34),
    "jwt": lambda r: "eyJ" + _some(r, ALNUM + "_-", r.randint(30, 60)),
    "mixed40": lambda r: _some(r, ALNUM + "/+", 40),
    "base64": lambda r: _some(r, ALNUM + "/+", r.randint(30, 60)) + "=" * r.randint(0, 2),
    "hex_upper": lambda r: _some(r, "0123456789ABCDEF", r.choice([24, 32, 40])),
    "hex_short": lambda r: _some(r, "0123456789abcdef", r.randint(18, 31)),
    "base36": lambda r: _some(r, BASE36, r.randint(20, 36)),
    "base32": lambda r: _some(r, string.ascii_uppercase + "234567", r.choice([16, 26, 32])),
    "mixed24": lambda r: _some(r, ALNUM, r.randint(18, 28)),
    "letters": lambda r: _some(r, string.ascii_letters, r.randint(18, 32)),
    "urlsafe": lambda r: _some(r, ALNUM + "_-", 43),
    "service": lambda r: _word(r, 1) + r.choice("_-") + _some(r, BASE36, r.randint(20, 32)),
    "session": lambda r: "-".join(_some(r, BASE36, 8) for _ in range(r.randint(3, 4))),
    "licence": lambda r: "-".join(_some(r, string.ascii_uppercase + string.digits, 5) for _ in range(5)),
    "hex_pairs": lambda r: "-".join(_some(r, "0123456789abcdef", n) for n in (8, 4, 4, 4, 12)),
    "upper_digits": lambda r: _some(r, string.ascii_uppercase + string.digits, r.randint(18, 30)),
    "password": lambda r: _some(r, ALNUM, r.randint(10, 16)),
}

#: Harmless values by format.
HARMLESS: dict[str, Callable[[random.Random], str]] = {
    "camel": lambda r: "".join(_word(r, 2).title() for _ in range(r.randint(2, 4))) + r.choice(["", str(r.randint(1, 99))]),
    "camel_low": lambda r: _word(r, 2) + "".join(_word(r, 2).title() for _ in range(r.randint(1, 3))),
    "snake": lambda r: _words(r, r.randint(2, 4), "_") + r.choice(["", f"_{r.randint(1, 999)}"]),
    "screaming": lambda r: _words(r, r.randint(2, 3), "_").upper(),
    "kebab": lambda r: _words(r, r.randint(2, 5), "-") + r.choice(["", f"-{r.randint(1, 99)}"]),
    "path": lambda r: _words(r, r.randint(2, 5), "/") + r.choice(["", f"/{r.randint(1, 9999)}"]),
    "compound": lambda r: _words(r, r.randint(3, 5)),
    "capital": lambda r: r.choice(["SS", "Mc", "De", "IP", "PDF"]) + _words(r, r.randint(1, 3)).title(),
    "title": lambda r: _words(r, r.randint(3, 5)).title(),
    "date": lambda r: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}" + r.choice(["", f"T{r.randint(10, 23)}", f"_{r.randint(10, 99)}"]),
    "number": lambda r: "-".join(_some(r, string.digits, r.randint(2, 6)) for _ in range(r.randint(2, 5))),
    "digits": lambda r: _some(r, string.digits, r.randint(8, 19)),
    "code": lambda r: _some(r, string.ascii_uppercase, r.randint(2, 4)) + r.choice(["-", "", "_"]) + _some(r, string.digits, r.randint(4, 8)),
    "id": lambda r: _word(r, 2) + r.choice(["", "_", "-"]) + _some(r, string.digits, r.randint(4, 10)),
    "version": lambda r: f"v{r.randint(0, 9)}-{r.randint(0, 30)}-{r.randint(0, 9)}" + r.choice(["-alpha", "-rc1", "-beta2", "-final"]),
    "size": lambda r: f"{r.randint(100, 4000)}x{r.randint(100, 4000)}" + r.choice(["px", "", "mm"]) + r.choice(["-large", "_small", ""]),
    "rule": lambda r: r.choice("=-_") * r.randint(8, 60),
    "repeat": lambda r: (_word(r, 1) * 12)[:r.randint(8, 30)],
    "pattern": lambda r: (r.choice(["=-", "-_", "ab", "xo", "ha", "=+", "OX", "1-"]) * 30)[:r.randint(8, 40)],
    "initials": lambda r: "-".join(_some(r, string.ascii_uppercase, r.randint(2, 4)) for _ in range(r.randint(3, 5))),
    "shout": lambda r: _words(r, r.randint(3, 5)).upper(),
    "part": lambda r: _some(r, string.ascii_uppercase, 2) + _some(r, string.digits, r.randint(3, 5)) + r.choice(["-", "/"]) + _word(r, 2).upper(),
    "letter_run": lambda r: r.choice(string.ascii_letters) * r.randint(8, 40),
    "words_numbers": lambda r: "".join(_word(r, 2).title() + str(r.randint(1, 99)) for _ in range(2)),
}


def shipped(n: int = 40, seed: int = 7) -> list[tuple[str, int, bytes, int, int]]:
    """(format, 1 for a secret, text, start, end of the value in bytes): ``n`` findings of every format."""
    rng = random.Random(seed)
    out = []
    for label, formats in ((1, SECRETS), (0, HARMLESS)):
        for name, draw in formats.items():
            for _ in range(n):
                value = draw(rng)
                before, after = f"{_words(rng, 3, ' ')} {rng.choice(_AROUND)} {_words(rng, 3, ' ')}".split("{}")
                out.append((name, label, f"{before}{value}{after}".encode(), len(before.encode()), len((before + value).encode())))
    return out
