"""Linked credentials against an all-pairs search in plain Python, and planted cases."""

import random
import re

from sentiscope.llm import secrets

KEY = "Zx9" + "aB3/kQ7+" * 5
ACCESS = "AKIA" + "Q7" * 8


def plain_spans(text, scope):
    """``(spans, credentials)`` by comparing every part with every other."""
    parts = []
    for kind, (name, pattern, group, least) in enumerate(secrets.KINDS):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m.group(group)) >= least:
                parts.append((m.start(), kind, m.end()))
    parts.sort()
    name = {i: k[0] for i, k in enumerate(secrets.KINDS)}

    def overlaps(p, kinds):
        return any(q is not p and name[q[1]] in kinds and q[0] < p[2] and p[0] < q[2] for q in parts)

    bases = {k[0] for k in secrets.BASE}
    classes = {"identifier": [], "secret": [], "endpoint": []}
    for p in parts:
        n = name[p[1]]
        if n == "access" or (n == "weak_access" and not overlaps(p, bases)):
            classes["identifier"].append(p)
        if (n == "hex" or (n == "assign" and not overlaps(p, {"access"}))
                or (n == "weak_secret" and not overlaps(p, bases | {"weak_access"}))):
            classes["secret"].append(p)
        if n == "endpoint" and not overlaps(p, bases):
            classes["endpoint"].append(p)

    def nearest(p, of):
        left = max(((q[2], q) for q in classes[of] if q < p), default=None)
        right = min(((q[0], q) for q in classes[of] if q > p), default=None)
        near = [(max(0, p[0] - left[0]), 0, left[1])] if left else []
        near += [(max(0, right[0] - p[2]), 1, right[1])] if right else []
        near = [x for x in near if x[0] <= scope]
        return min(near)[2] if near else None

    links, linked = set(), set()
    for p in classes["identifier"]:
        if q := nearest(p, "secret"):
            links.add((p, q, nearest(p, "endpoint")))
            linked.add(p)
    for p in classes["secret"]:
        if q := nearest(p, "identifier"):
            links.add((q, p, nearest(q, "endpoint")))
            linked.add(p)
    linked |= {p for p in classes["endpoint"] if nearest(p, "identifier") and nearest(p, "secret")}

    def show(p):
        return f"{name[p[1]]}:{p[0]}:{p[2]}"

    spans = [p for p in parts if name[p[1]] in bases or p in linked]
    ordered = sorted(links, key=lambda x: (x[0], x[1], x[2] or ()))
    return ",".join(map(show, spans)), ",".join("+".join(show(p) for p in x if p) for x in ordered)


def test_links_equal_all_pairs(spark):
    rng = random.Random(3)
    pieces = [KEY, ACCESS, "user=ann", "client_id: x1", "https://db.example.com/x", "password = hunter22", "token=" + ACCESS,
              "login=" + KEY, "0" * 30, "https://h/?api_key=abcdefg", "secret:é", "AKIA12", "deadbeef", "é" * 9]
    fill = ["word ", "é ", "some plain words in between " * 3, "x" * 70 + " ", "\n"]
    texts = ["".join(rng.choice(pieces) + " " if rng.random() < 0.4 else rng.choice(fill) for _ in range(rng.randint(0, 60)))
             for _ in range(150)] + [None, "", KEY, (f"user=ann {KEY} " + "plain words " * 40) * 400]
    df = spark.createDataFrame([(i % 140, t, 1, "x") for i, t in enumerate(texts)],
                               "doc_id int, text string, start int, spans string").repartition(3)
    for scope in (0, 40, secrets.SCOPE):
        got = sorted((r.doc_id, r.spans, r.credentials) for r in
                     secrets.report(secrets.find_secrets(df, scope=scope)).collect())
        want = sorted((i % 140, *plain_spans(t, scope)) for i, t in enumerate(texts))
        assert got == want
    assert any(c.count("+") > 1 for _, _, c in want)


def test_planted_links(spark):
    long_key = "k9" * 150
    texts = [f"{long_key} user=ann",                       # one space apart, however long the secret
             f"login={KEY} alone",                         # an identifier is not its own secret
             f"token={ACCESS} alone",
             f"user=ann {'x ' * 101}{KEY}",                # beyond the scope
             f"{ACCESS} and {KEY} at https://db.example.com/x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: (r.spans, r.credentials) for r in secrets.report(secrets.find_secrets(df)).collect()}
    assert got[0] == ("weak_secret:0:300,weak_access:301:309", "weak_access:301:309+weak_secret:0:300")
    assert got[1] == got[3] == ("", "")
    assert got[2][1] == "" and got[2][0].startswith("assign:0:")
    assert got[4][1] == "access:0:20+weak_secret:25:68+endpoint:72:96"
    assert [r.text for r in secrets.mask_secrets(df).where("doc_id = 4").collect()] == ["[SECRET] and [SECRET] at [SECRET]"]
