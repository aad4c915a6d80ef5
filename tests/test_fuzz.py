"""Many generated strings at once: every text function against a plain Python statement of its rule."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import secrets, text
from tallyhouse.operators import fingerprints as FP

ALPHABET = list("abXY.@@+-_ 0123456789%\t\n") + ["é", "ß", "İ", "Σ", "٣", "　", "\xa0", "\U0001f600", "\x1f", "'", "|"]


def generated(n=4000, seed=7):
    pick = random.Random(seed)
    made = ["".join(pick.choices(ALPHABET, k=pick.randint(0, 14))) for _ in range(n)]
    return made + ["+" + s for s in made[:300]] + [f"{s}@shop.test" for s in made[:300]] + ["", " ", "@", "+", "++1"]


def masked(s):
    name, at, rest = s.partition("@")
    return s if not at or len(name) < 2 else f"{name[0]}***@{rest}"


def digits(s):
    return "".join(c for c in s if c.isdecimal())


def covered(s):
    return f"***-***-{digits(s)[-4:]}" if len(digits(s)) > 3 else "****"


def domain(s):
    parts = s.split("@")
    return parts[1] if len(parts) > 1 else None


def code(s):
    found = re.match(r"\+(\d{1,3})", s)
    return found[1] if found else None


def cut(s):
    return s if len(s) <= 8 else s[:5] + "..."


RULES = {
    "mask_email": (secrets.mask_email, masked),
    "mask_phone": (secrets.mask_phone, covered),
    "digits": (text.digits_only, digits),
    "strip": (text.strip, str.strip),
    "folded": (text.folded, lambda s: s.lower().strip()),
    "domain": (secrets.email_domain, domain),
    "country": (secrets.phone_country_code, code),
    "shorten": (lambda c: text.shorten(c, 8), cut),
    "is_email": (text.is_email, lambda s: bool(re.match(r"[\w.%+-]+@[a-z0-9.-]+\.[a-z]{2,}$", s, re.ASCII | re.I))),
    "identity": (
        lambda c: FP.identity_hash(c, c, F.lit(None).cast("string")),
        lambda s: hashlib.sha256(f"{s.lower().strip()}|{s.strip()}|".encode()).hexdigest(),
    ),
}


@pytest.fixture(scope="module")
def results(spark):
    values = generated()
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select("v", *[make(F.col("v")).alias(name) for name, (make, _) in RULES.items()]).collect()
    return [r.asDict() for r in rows]


@pytest.mark.parametrize("name", RULES)
def test_rule(results, name):
    rule = RULES[name][1]
    wrong = [(r["v"], r[name], rule(r["v"])) for r in results if r[name] != rule(r["v"])]
    assert wrong == []
