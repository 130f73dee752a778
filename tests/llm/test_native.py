"""Mixing, rules and line dedup beside brute force, and their corner cases."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sitegauge.llm import linededup, mixing, rules

SPACE = " \t\n\x0b\x0c\r"
EDGE = [(1, None), (2, ""), (3, " \t\n "), (4, "One long line here\nOne long line here"), (5, "ONE LONG LINE HERE "),
        (5, "ONE LONG LINE HERE "), (None, "one long line here"), (None, None),
        (6, "ÉTÉ de la plage\nshort\n\nx"), (7, "été de la plage\nÉté de la plage"),
        (8, "w " * 30000 + "\nlast line of it"), (9, "last line of it")]
CLASH = ("size", "kept", "n_words", "line_dedup", "measures", "fail_bits", "taken", "pos", "run")


def key(line):
    line = line.strip(SPACE)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def line_dedup(rows):
    """(n_lines, n_dropped, text) of each (doc_id, text); null ids come last."""
    order = lambda d: (d is None, d or 0)
    first = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= 10 and (k not in first or order(d) < order(first[k])):
                first[k] = d
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def same(got, want):
    assert Counter(map(tuple, got)) == Counter(want)


def test_line_dedup_edges(docs):
    df = docs(EDGE, CLASH)
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in line_dedup([r[:2] for r in EDGE])]
    same(linededup.op5(df).collect(), want)
    out = linededup.drop_repeated_lines(df)
    assert out.columns == df.columns
    same([(r.doc_id, r.text or "", r.n_chars) for r in out.collect()],
         [(d, t, len(t)) for d, _, _, t in line_dedup([r[:2] for r in EDGE])])


def test_line_dedup_hot_line(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("the one common line\nline number "), (F.col("id") % 2500).cast("string"), F.lit(" only")).alias("text"))
    assert dict(map(tuple, linededup.op5(df).groupBy("n_dropped").count().collect())) == {0: 1, 1: 2499, 2: 2500}


def test_line_dedup_empty(docs):
    assert linededup.op5(docs([])).collect() == []


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def measured(text):
    text = text or ""
    w = words(text)
    n = Counter(zip(w, w[1:], w[2:], w[3:], w[4:]))
    covered = set()
    for i, g in enumerate(zip(w, w[1:], w[2:], w[3:], w[4:])):
        if n[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(lines), text.count("!"), sum("A" <= c <= "Z" for c in text))


def test_rules_beside_brute_force(docs, sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()] + [
        (None, "a b c d e " * 3), (900, None), (901, ""), (902, "x " * 9), (903, "a " * 12), (904, "é b c"),
        (905, " ".join(f"w{i}" for i in range(9000)) + " w1 w2 w3 w4 w5"), (905, "again again")]
    got = rules.op2(docs(rows, CLASH)).collect()
    want = []
    for d, text in rows:
        m = measured(text)
        env = dict(zip(rules.MEASURES, m))
        bits = sum(1 << b for b, (_, fails) in enumerate(rules.RULES) if eval(fails, {}, env))
        want.append((d, *m[:5], bool(bits & 3), bits == 0, bits))
    same(got, want)
    base = [(w[6], w[7]) for w in want]
    assert all(not kept for failed, kept in base if failed)


def test_rules_policies_and_ablation(docs):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(1, good), (2, "few"), (3, good + " ###" * 9), (4, "x"), (5, "many many " * 20), (6, "$ " * 4)]
    led, name, bits = rules.ledger(docs(rows), ["doc_id"])
    kept = lambda p: sorted(r.doc_id for r in led.filter(rules.passes(bits, p)).collect())
    assert kept("v1") == [1, 3] and kept("v2") == [1]
    found = {r.rule: (r.n_fail, r.n_only) for r in rules.ablation(led, bits, "v2").collect()}
    table = [r[bits] for r in led.collect()]
    for bit, (rule, _) in enumerate(rules.RULES):
        assert found[rule] == (sum(b >> bit & 1 for b in table), sum(b == 1 << bit for b in table))
    assert rules.keep_good(docs(rows, CLASH)).columns == docs(rows, CLASH).columns
    assert rules.op2(docs([])).collect() == []


def targets(sizes):
    """Targets of {source: size} by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, out, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= 2 * sizes[s]]
        if not over:
            out.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= set(over)
    return out


def test_mix_targets_and_amounts(docs):
    rows = [(i, "w " * (i % 40), "en", ("a", "b", "c", "é", None, "z")[i * i % 11 % 6]) for i in range(900)]
    rows += [(None, "null id", "en", "a"), (None, None, "en", "a"), (3000, "w " * 5, "en", "b"), (3000, "w " * 5, "en", "b"),
             (2000, "w " * 50000, "en", "z"), (2001, "", "en", "empty"), (2002, None, "en", "empty")]
    df = docs(rows, CLASH)
    got = mixing.op1(df).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = targets(sizes)
    source = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    same(mixing.op1(df.repartition(13)).collect(), [tuple(r) for r in got])
    assert mixing.op1(docs([])).collect() == []


def test_mix_stage_gives_the_planned_words(docs):
    rows = [(i, f"word{i} " * (1 + i % 9), "en", "ab"[i % 7 > 4]) for i in range(200)]
    rows += [(7, "twice the same row", "en", "a")] * 2 + [(8, None, "en", "a"), (None, "no id at all", "en", None)]
    df = docs(rows, CLASH)
    plan, out = Counter(), Counter()
    for r in mixing.op1(df).collect():
        plan[r.doc_id] += r.taken
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1] or "")
    for r in mixed.collect():
        out[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text) and any(t.startswith(r.text) for t in texts[r.doc_id])
    assert out == +plan
