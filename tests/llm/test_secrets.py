import hashlib
import random
import re
import string

import numpy as np

from kinmatch.llm import secrets
from kinmatch.llm.queries import QUERIES

TEXTS = ["", "password = hunter22", "PassWord:'abc' token=secret=abcdefgh", "secret:token: abcdefgh", "AKIA" + "A" * 15, "AKIA" + "B" * 16 + "c", "xAKIAAKIA" + "1" * 20,
         "f" * 23, "f" * 24, "é token=\"" + "0a" * 20 + "\" and api-key", "apikey=abcdef api_key : a.b-c_d", "paſſword=abcdef toKen=abcdef", "Z" * 500 + "deadbeef" * 4]


def brute(text):
    spans = [(m.start(), 0, m.end()) for m in secrets.ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_base_spans():
    rng = random.Random(5)
    parts = ["token", "=", ":", " ", '"', "AKIA", "A9", "0af", "secret", "f0" * 9, "é", "\n", "Passwd"]
    texts = TEXTS + ["".join(rng.choices(parts, k=40)) for _ in range(400)]
    for text in texts:
        assert [s[:3] for s in secrets.base_spans(text)] == brute(text)


def test_models_find_random_strings_and_leave_words(spark):
    rng = random.Random(7)
    rand = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    words = ["the", "internal", "configuration", "handler", "request", "session_manager", "DocumentBuilder", "parse-arguments"]
    rows = [(i, " ".join(rng.choices(words, k=60)) + f" token={rand(32)}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratio = secrets.fit(secrets.transition_counts(docs))
    found = missed = 0
    for _ in range(200):
        planted, plain = rand(40), "_".join(rng.choices(words, k=4))
        text = f"é {plain} {planted} end"
        spans = secrets.all_spans(text, ratio)
        missed += (text.index(planted), 3, text.index(planted) + 40) not in spans
        found += any(b < 2 + len(plain) for b, _, _ in spans)
    assert missed <= 10 and found <= 4


def brute_stretches(steps, params):
    """Every stretch tried: the one that grows most (the first end, the longest) or the whole around it, then both sides."""
    n = len(steps)
    if not n:
        return []
    best = max(((sum(steps[i:j]), -j, -i) for i in range(n) for j in range(i + 1, n + 1)), key=lambda x: (round(x[0], 9), *x[1:]))
    grown, last, first = best[0], -best[1], -best[2]
    if grown < params.total:
        return []
    if last - first >= secrets.MOST * n and sum(steps) >= params.total and sum(steps) / n >= params.mean:
        return [(0, n)]
    here = [(first, last)] if grown >= params.mean * (last - first) else []
    left = brute_stretches(steps[: max(first - 1, 0)], params)
    return left + here + [(a + last + 1, b + last + 1) for a, b in brute_stretches(steps[last + 1 :], params)]


def test_stretches_against_every_stretch():
    rng, params = random.Random(4), secrets.Params(total=3.0, mean=0.6)
    for _ in range(300):
        steps = [rng.choice([-2.0, -1.0, -0.5, 0.25, 1.0, 1.5]) for _ in range(rng.randint(0, 30))]
        assert sorted(secrets.random_stretches(np.array(steps), params)) == sorted(brute_stretches(steps, params))


def model(spark, rng):
    rand = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    words = ["the", "internal", "configuration", "handler", "request", "session_manager", "DocumentBuilder", "parse-arguments", "and", "other", "thing", "stored"]
    rows = [(i, " ".join(rng.choices(words, k=60)) + " /" + "/".join(rng.choices(words, k=4)) + f" token={rand(80)}") for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return secrets.fit(secrets.transition_counts(docs)), rand, words


def test_short_secrets_and_secrets_inside_runs(spark):
    rng = random.Random(11)
    ratio, rand, words = model(spark, rng)
    recall = {}
    for n in (12, 16, 19, 20, 32):
        for name, before in (("bare", "see "), ("path", "/the/and/other/thing/stored/")):
            hits = 0
            for _ in range(100):
                secret = rand(n)
                text = f"é {before}{secret} end"
                at = text.index(secret)
                # most of its characters, and hardly any of what is before it
                hits += any(k == 3 and b >= at - 4 and min(e, at + n) - max(b, at) >= 0.6 * n for b, k, e in secrets.all_spans(text, ratio))
            recall[n, name] = hits
    assert min(hits for (n, _), hits in recall.items() if n >= 16) >= 90 and min(recall.values()) >= 60, recall
    plain = [" ".join(rng.choices(words, k=80)) for _ in range(200)]
    assert sum(len(secrets.all_spans(t, ratio)) for t in plain) <= 2


def test_parts_of_a_run_outside_of_base_spans(spark):
    rng = random.Random(12)
    ratio, rand, _ = model(spark, rng)
    hits = 0
    for _ in range(50):
        a, b = rand(30), rand(30)
        text = f"{a}-{'0f' * 15}-{b}"  # the hex part is a base span in the middle of the run
        base = [s[:3] for s in secrets.base_spans(text)]
        spans = secrets.all_spans(text, ratio)
        assert set(base) <= set(spans) and (31, 2, 61) in base
        assert all(e <= b0 or e0 <= b for b, k, e in spans if k == 3 for b0, _, e0 in base)
        hits += sum(k == 3 for _, k, _ in spans) >= 2
    assert hits >= 45


def test_query_against_the_operator(spark, sf):
    """The query's columns from the spans of each document."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ratio = secrets.fit(secrets.transition_counts(docs))
    want = []
    for r in docs.collect():
        spans = secrets.all_spans(r.text or "", ratio)
        assert [s for s in spans if s[1] < 3] == brute(r.text or "")
        named = [f"{secrets.KINDS[k]}:{b}:{e}" for b, k, e in spans]
        base = ",".join(x for x in named if not x.startswith("markov"))
        counts = [sum(x.startswith(kind) for x in named) for kind in secrets.KINDS[:3]]
        want.append((r.doc_id, *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(named)))
    rows = QUERIES["op10_secrets"](spark, sf).collect()
    assert sorted((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in rows) == sorted(want)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "password = hunter22", 2)], "doc_id long, text string, spans int")
    ratio = secrets.fit(secrets.transition_counts(docs))
    rows = secrets.scan(docs, ratio).collect()
    assert sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in rows) == [("1", []), ("1", []), ("None", [("assign", 0, 19)])]
    assert secrets.scan(docs.limit(0), secrets.fit(secrets.transition_counts(docs.limit(0)))).collect() == []
