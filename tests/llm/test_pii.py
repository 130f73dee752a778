"""Personal data: base patterns, the tagger, and reconciliation of windows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from sitegauge.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [x * 2 - 9 * (x > 4) if i % 2 else x for i, x in enumerate(digits[::-1])]
                if not 14 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return found


@pytest.fixture(scope="module")
def weights():
    return pii.train(["the", "of", "und", "les", "que", "And,", "with"] * 20)


def test_query_beside_patterns(docs, sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()] + [
        (900, None), (901, ""), (902, "a@b.c x 1.2.3.4 1.2.3.256 4111 1111-1111 1111 +1 (555) 123-4567"),
        (903, "é" * 70 + " é@x.yz 10.0.0.1."), (None, "+123456789012345678 0@0.0.0.0"), (902, "twice"),
        (904, "w " * 60_000 + "me@here.org"), (905, "1" * 5000)]
    got = pii.op6(docs(rows, ("spans", "n_ip", "kind"))).collect()
    assert len(got) == len(rows)
    want = Counter()
    for d, text in rows:
        found = sorted(plain(text or ""))
        n = Counter(s.split(":")[0] for _, _, s in found)
        want[d, *(n[k] for k in PATTERNS),
             hashlib.sha256(",".join(s for _, _, s in found).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    texts = {d: t for d, t in rows if d != 902}
    for r in got:
        if r.doc_id in texts:
            assert {s for _, _, s in plain(texts[r.doc_id] or "")} <= set(filter(None, r.spans.split(",")))
    assert pii.op6(docs([])).collect() == []


def test_tagger_held_out(weights):
    x, y = pii.labelled_windows(["other", "held", "out", "wörter"], 400, 77)
    e = pii.emissions(x, weights)[0]
    assert (pii.decode(e, weights["trans"]) == y).mean() > 0.97


def test_tagger_adds_what_patterns_miss(weights):
    text = "the of " * 30 + "(212) 555-0199 and les " + "que " * 40 + "12.05.2019 v1.2 no. 123456"
    tags, = pii.tagged([text], weights)
    added = pii.added_spans(text, tags, pii.base_spans(text))
    assert [(text[s:e], pii.KINDS[k]) for s, e, k in added] == [("(212) 555-0199", "phone")]
    assert pii.tagged(["no signs at all", ""], weights) == [None, None]


def test_gradients_match_differences():
    w = {k: v.astype(np.float64) for k, v in pii.start_weights(1).items()}
    x, y = pii.labelled_windows(["a", "b"], 3, 5)
    x, y = x[:, :20], y[:, :20].astype(np.int64)

    def loss():
        e = pii.emissions(x, w)[0].astype(np.float64)
        a = e[0]
        for t in range(1, e.shape[0]):
            a = np.log(np.exp(a[:, :, None] + w["trans"]).sum(axis=1)) + e[t]
        gold = sum(e[t, np.arange(3), y[:, t]] for t in range(20)) + sum(
            w["trans"][y[:, t - 1], y[:, t]] for t in range(1, 20))
        return (np.log(np.exp(a).sum(axis=1)) - gold).mean()

    g = pii.gradients(x, y, w)
    for name in w:
        at = tuple(np.unravel_index(np.abs(g[name]).argmax(), g[name].shape))
        w[name][at] += 0.02
        up = loss()
        w[name][at] -= 0.04
        assert g[name][at] == pytest.approx((up - loss()) / 0.04, rel=0.05, abs=1e-3)
        w[name][at] += 0.02
