"""Secret scans against plain patterns and known strings."""

import hashlib
import random
import re
import string

from lexforge.llm import secrets

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def random_texts(n=400):
    rnd = random.Random(8)
    parts = ["password", "PASSWD", "Secret", "token", "api_key", "APIKEY", "apıkey", "ſecret", "=", ":", " ", "  ", '"', "'", "AKIA", "AKIAAKIA", "é日", "\n", "-", "/", "."]
    def piece():
        kind = rnd.randrange(4)
        if kind < 2:
            return rnd.choice(parts)
        alphabet = "0123456789abcdef" if kind == 2 else string.ascii_uppercase + string.digits
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30)))
    return ["".join(piece() for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def test_base_spans_equal_plain_patterns():
    for text in random_texts():
        assert secrets.base_spans(text) == plain(text), text


def test_battery_tells_random_from_regular():
    rnd = random.Random(1)
    for alphabet, name in (("0123456789abcdef", "hex"), (string.ascii_letters + string.digits, "base62")):
        random_steps = [secrets.battery("".join(rnd.choice(alphabet) for _ in range(64))) for _ in range(300)]
        assert {s[0].split("/")[0] for s in random_steps if s} == {name}
        assert sum(s[1] > 300 for s in random_steps if s) <= 3  # p below a thousandth
    assert secrets.battery("Aa1" * 20)[1] > 300
    assert secrets.battery("abcdefghijklmnopqrstuvwxyz") is None
    assert secrets.battery("0" * 63 + "a")[1] > 300


def run(spark, rows, **more):
    return secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3), **more)


def test_random_tokens_are_added_and_regular_ones_are_not(spark):
    rnd = random.Random(6)
    token = lambda n: "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(n))
    rows = []
    for i in range(60):
        secret = token(40) + "aZ9"
        rows.append((i, f"Before {secret} after"))
        rows.append((1000 + i, "Before " + "Abc123" * rnd.randint(6, 9) + " after"))
    found = {r.doc_id: r.spans for r in run(spark, [(a, b, None) for a, b in rows]).collect()}
    assert sum(bool(found[i]) for i in range(60)) >= 57
    assert sum(bool(found[1000 + i]) for i in range(60)) == 0
    assert all(s.kind == "random" and (s.start, s.end) == (7, 50) for i in range(60) for s in found[i])


def test_query_columns_and_defined_cases(spark):
    rows = [(i, t, "x") for i, t in enumerate(random_texts(80))] + [(None, "token=abcdef12", "x"), (900, None, "x"), (900, "", "x"), (901, "é" * 50_000 + " password: hunter22", "x")]
    out = secrets.secret_digests(run(spark, rows)).collect()
    want = []
    for key, text, _ in rows:
        spans = plain(text or "")
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((key, *[sum(k == kind for k, _, _ in spans) for kind in secrets.KINDS[:3]], hashlib.sha256(written.encode()).hexdigest()))
    assert sorted((tuple(r)[:5] for r in out), key=str) == sorted(want, key=str)
    assert run(spark, []).collect() == []


def test_masking(spark):
    rows = [(1, "a token=abcdef12 b", None), (2, "clean text", None), (3, None, None), (4, f"x {'a1' * 15} password={'b2' * 15}", None)]
    out = {r.doc_id: r.text for r in run(spark, rows, mask=True).collect()}
    assert out == {1: "a [secret] b", 2: "clean text", 3: None, 4: "x [secret] [secret]"}
