"""Near duplicates, packing, search, scores, language and grades beside brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitegauge.llm import grading, katz, langid, neardup, onebit, packing

CLASH = ("kept", "component_id", "print", "piece", "length", "score", "held_out", "bucket", "chunk")


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# ------------------------------------------------------------ near duplicates

def shingle_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(rows):
    """(doc_id, size, component, kept) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for i, s in enumerate(sets):
        both = Counter(k for x in s for k in where[x] if k > i)
        for k, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[k]) - n):
                comp[find(k)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return out


def near_copies(seed, n_groups=12, copies=14):
    rng = random.Random(seed)
    rows, d = [], 0
    for _ in range(n_groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice((4, 12, 60, 300)))]
        for k in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 18)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((d, " ".join(w) + " " * (k % 3)))
            d += 1
    return rows


def test_near_duplicates_beside_all_pairs(docs, sample):
    rows = near_copies(1) + [(10_000 + r.doc_id, r.text) for r in sample.collect()]
    rows += [(None, "alone without an id at all here"), (None, rows[0][1]), (20_001, None), (20_002, ""),
             (20_003, " \n"), (20_004, "A b"), (20_005, "a B"), (20_004, "A b"), (20_006, "w " * 30_000)]
    got = neardup.op3(docs(rows, CLASH)).collect()
    assert Counter(map(tuple, got)) == Counter(groups(rows))


def test_near_duplicates_large_nodes(docs, monkeypatch):
    # Small limits drive the linear comparison and the deeper levels.
    monkeypatch.setattr(neardup, "SMALL_NODE", 6)
    monkeypatch.setattr(neardup, "OTHERS", 2)
    rng = random.Random(5)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = near_copies(2, 4, 30) + [
        (5000 + i, shared + " " + " ".join(f"p{rng.randrange(10 ** 6)}" for _ in range(30 + i % 40)))
        for i in range(120)]
    got = neardup.op3(docs(rows)).collect()
    assert Counter(map(tuple, got)) == Counter(groups(rows))


def test_pair_in_a_large_and_a_small_node():
    # The smallest-numbered node of a pair may be too large to be compared; the others still give it.
    sets = [neardup.shingles(" ".join(f"w{i}" for i in r).encode(), {}) for r in (range(300), range(25, 300))]
    sketches = np.stack([neardup.sketch(s) for s in sets])
    shared = set()
    for tree in range(10):
        at, keys = np.arange(2), neardup._roots(tree, 2)
        for _ in range(neardup.START_DEPTH):
            keys, at = neardup.branch(keys, at, sketches)
        shared |= set(keys[at == 0].tolist()) & set(keys[at == 1].tolist())
    nodes = np.repeat(sorted(np.array(sorted(shared), np.uint64)[1:].view(np.int64)), 2)
    assert len(nodes)
    cid = np.tile([0, 1], len(nodes) // 2)
    column = lambda rows: pa.array([rows[i].tobytes() for i in cid])
    batch = pa.RecordBatch.from_arrays(
        [pa.array(nodes), pa.array(cid), pa.array(cid), pa.array([len(sets[i]) for i in cid]),
         column([neardup.fine_sketch(s) for s in sets]), column(sets),
         pa.array([sorted(set(nodes.tolist()))] * len(cid))],
        ["node", "cid", "comp", "n", "mini", "hashes", "nodes"])
    near = [r["cid"] for b in neardup._with_partners(iter([batch.select(range(5))])) for r in b.to_pylist()]
    assert near == cid.tolist()
    found = [(r["a"], r["b"]) for b in neardup._links_in_nodes(iter([batch])) for r in b.to_pylist()]
    assert found == [(0, 1)]  # in the first node that the pair shares


def test_half_alike_texts_give_few_rows(docs, monkeypatch):
    """Texts whose pairs agree enough to be compared but are mostly no links."""
    rng = np.random.RandomState(9)
    rows = []
    for i in range(300):
        words_ = [f"w{k}" for k in range(400)]
        for at in rng.choice(80, 7, replace=False):  # each changed word changes five shingles
            words_[5 * at] = f"x{rng.randint(10 ** 9)}"
        rows.append((i, " ".join(words_)))
    given, merged = [], neardup._Join.merged

    def watched(self, links):
        given.append(links.count())
        return merged(self, links)

    monkeypatch.setattr(neardup._Join, "merged", watched)
    got = neardup.op3(docs(rows)).collect()
    want = groups(rows)
    assert Counter(map(tuple, got)) == Counter(want)
    assert max(given) < 3 * len(rows)


def test_deeper_nodes_get_further_trees(docs, monkeypatch):
    assert [neardup.trees(d) for d in (2, 4, 6)] == [10, 21, 39]
    rng = np.random.RandomState(3)
    x = rng.randint(0, 2 ** 32, (20_000, neardup.COORDINATES), np.int64).astype(np.uint32)
    y = np.where(rng.random_sample(x.shape) < 0.75, x, x + np.uint32(1))
    met = np.zeros(len(x), bool)
    ids = pa.array(np.arange(len(x)))
    for tree in range(neardup.trees(4)):
        nodes = []
        for side in (x, y):
            batch = pa.RecordBatch.from_arrays([ids, pa.array([r.tobytes() for r in side])], ["cid", "sketch"])
            nodes.append({p for b in neardup._rooted(iter([batch]), range(tree, tree + 1), 4)
                          for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())})
        met[[cid for _, cid in nodes[0] & nodes[1]]] = True
    assert (~met).mean() <= 3e-4  # ten trees: 3e-3

    planted, asked = neardup._Join.planted, []

    def noted(self, rows, numbers, depth):
        asked.append((numbers, depth, rows.count()))
        if depth > 2:
            raise StopIteration
        return planted(self, rows, numbers, depth)

    monkeypatch.setattr(neardup, "SMALL_NODE", 6)
    monkeypatch.setattr(neardup, "OTHERS", 2)
    monkeypatch.setattr(neardup._Join, "planted", noted)
    common = " ".join(f"s{i}" for i in range(40))
    rows = [(i, common + "".join(f" p{i}w{k}" for k in range(30))) for i in range(60)]
    with pytest.raises(StopIteration):
        neardup.op3(docs(rows))
    assert [a[:2] for a in asked] == [(range(10), 2), (range(10, 21), 4)] and 6 < asked[1][2] <= 60


def test_keep_one(docs):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (1, "a B c d e f"), (2, None), (4, "other words are here now")]
    df = docs(rows, CLASH)
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert neardup.op3(docs([])).collect() == [] and neardup.keep_one(docs([])).collect() == []


def test_keep_one_of_rows_that_share_an_id(docs):
    text = [" ".join(f"t{k}w{i}" for i in range(12)) for k in range(6)]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (5, text[2]), (5, text[3]), (5, text[3]),
            (2, text[3]), (None, text[4]), (9, text[4]), (5, text[5]), (None, None), (None, "")]
    kept = neardup.keep_one(docs(rows, CLASH)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(
        [(None, text[0]), (None, text[1]), (5, text[2]), (2, text[3]), (9, text[4]), (5, text[5]),
         (None, None), (None, "")])


def test_components_of_a_chain(spark):
    edges = spark.range(300).select((F.col("id") * 7 % 301).alias("a"), ((F.col("id") + 1) * 7 % 301).alias("b"))
    assert {r.comp for r in neardup.components(edges).collect()} == {0}


# -------------------------------------------------------------------- packing

def test_packing_round_trip(docs, sample):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    rows = [(r.doc_id, r.text) for r in sample.collect()] + [
        (900, None), (901, ""), (902, "word " * 5000), (903, "don't STOP it's  ΑΣ ΟΔΟΣ 3.14"),
        (903, "again"), (904, "\x1c a\x85b 　 éte <|endoftext|> x"), (905, "x" * 50_000)]
    got = packing.op4(docs(rows, CLASH)).collect()
    want = Counter()
    for d, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            cut = ids[k:k + 2048]
            want[d, k // 2048, k, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(places) <= 1.03 * math.ceil(total / 2048) + 1
    assert packing.op4(docs([])).collect() == []


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(score):
    rng = np.random.RandomState(0)
    lengths = np.sort(rng.randint(1, 90, 400))[::-1]
    bins, offsets = packing.best_fit(lengths, 100, 6, 4000, score, (1.0, 0.2, 0.2))
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= 100 and len(own) <= 6 and ((own ** 2).sum() <= 4000 or len(own) == 1)


# --------------------------------------------------------------------- search

def test_search_beside_brute_force(spark):
    rng = np.random.RandomState(1)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    x[1500:] = x[:1500] + 0.3 * x[1500:]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(5000, None), (5050, []), (5100, [0.0] * 24), (5150, [float("nan")] + [1.0] * 23),
             (5200, [None] + [1.0] * 23), (5250, [float("inf")] * 24), (None, [1.0] * 24), (50, rows[50][1]),
             (6000, [1.0, 2.0]), (6001, [2.0, 1.0]), (6050, [1.0] * 24), (6051, [2.0] * 24), (6052, [3.0] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    valid = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v
             and np.isfinite(v).all() and np.any(v)]
    want = {}
    for q, v in valid:
        if q % 50 == 0:
            best = {}
            for i, u in valid:
                if i != q and len(u) == len(v):
                    best[i] = float(u @ v / math.sqrt((u @ u) * (v @ v)))
            want[q] = sorted(best.items(), key=lambda t: (-round(t[1], 12), t[0]))[:5]
    hit = n = 0
    for q, found in _by(onebit.search(df, F.col("vec_id") % 50 == 0, block_rows=700, query_rows=40).collect(),
                        "query_id").items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, len(want[q]) + 1))
        n += len(want[q])
        hit += len({r.vec_id for r in found} & {i for i, _ in want[q]})
        exact = dict(want[q])
        assert all(r.score == pytest.approx(exact[r.vec_id], abs=1e-12) for r in found if r.vec_id in exact)
    assert hit >= 0.99 * n
    assert onebit.op8(df.filter("vec_id < 0")).collect() == []


def test_search_ties_go_to_the_smaller_ids(spark):
    # More copies than a block may hold back, with the smaller ids in any place of it.
    x = [float(v) for v in np.random.RandomState(4).standard_normal(24)]
    rows = [(i, [v * 2 ** (i % 7) for v in x] if i % 3 else x[::-1]) for i in reversed(range(1, 4000))]
    rows += [(0, x)] + [(7, x)] * 50
    found = onebit.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"),
                          F.col("vec_id") == 0, block_rows=8192).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])] == [1, 2, 4, 5, 7]


def _by(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def test_bounds_hold():
    rng = np.random.RandomState(2)
    x = rng.standard_normal((500, 64))
    centre = (x / np.linalg.norm(x, axis=1)[:, None]).mean(axis=0)
    codes, length, own = onebit.encode(x, centre)
    estimate, error = onebit.bounds(onebit.signs_of(codes, 64), length, own, centre, x[:50], 4.0)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert (np.abs(estimate - unit[:50] @ unit.T) <= error).mean() > 0.9999


# --------------------------------------------------------------------- scores

def katz_brute(rows):
    """Scores by plain dictionaries."""
    train = [words(t) + [None] for d, t, held in rows if not held]
    uni, bi, hist = Counter(), Counter(), Counter()
    for w in train:
        uni.update(w)
        bi.update(zip(["<s>"] + w[:-1], w))
        hist.update(["<s>"] + w[:-1])

    def factors(counts):
        n = Counter(counts.values())
        d = dict.fromkeys(range(1, katz.K + 1), 1.0)
        common = (katz.K + 1) * n[katz.K + 1] / n[1] if n[1] else 1
        for r in d:
            if n[r] and common < 1:
                x = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
                if 0 < x < 1:
                    d[r] = x
        return d

    total, du, db = sum(uni.values()), factors(uni), factors(bi)
    p_uni = {w: du.get(c, 1.0) * c / total for w, c in uni.items()}
    scale = 1.0 if 1 - sum(p_uni.values()) > 1e-12 or not total else total / (total + 1)
    p_uni = {w: p * scale for w, p in p_uni.items()}
    unknown = 1 - sum(p_uni.values())
    follow = defaultdict(dict)
    for (h, w), c in bi.items():
        follow[h][w] = c
    model = {}
    for h, ws in follow.items():
        p = {w: db.get(c, 1.0) * c / hist[h] for w, c in ws.items()}
        if 1 - sum(p.values()) <= 1e-9:
            p = {w: x * hist[h] / (hist[h] + 1) for w, x in p.items()}
        model[h] = p, (1 - sum(p.values())) / (1 - sum(p_uni[w] for w in ws))

    def prob(h, w):
        low = p_uni.get(w, unknown)
        if h not in model:
            return low
        return model[h][0].get(w, model[h][1] * low)

    out = []
    for d, t, held in rows:
        w = words(t) + [None]
        out.append((d, held, len(w), sum(x in uni for x in w), total,
                    sum(math.log10((uni[x] + 0.5) / (total + 0.5 * (len(uni) + 1))) for x in w),
                    sum(math.log10(prob(h, x)) for h, x in zip(["<s>"] + w[:-1], w))))
    everything = [*uni, "never seen"]
    sums = [sum(prob(h, w) for w in everything) for h in list(model)[:40]]
    return out, sums


@pytest.mark.parametrize("chunk,hot", [(2_000_000, 1000), (500, 3)])
def test_katz_beside_brute_force(docs, sample, monkeypatch, chunk, hot):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(katz, "HOT_TOKENS", hot)
    rows = [(r.doc_id, r.text) for r in sample.collect()][:120] + [
        (700, None), (701, ""), (702, "never seen before words"), (None, "the null one"), (703, "The the THE"),
        (703, "The the THE"), (704, "of the " * 4000)]
    held = [zlib.crc32(str("" if d is None else d).encode()) % 5 == 1 for d, _ in rows]
    want, sums = katz_brute([(d, t, h) for (d, t), h in zip(rows, held)])
    assert sums == pytest.approx([1.0] * len(sums))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got = sorted(map(tuple, katz.op9(docs(rows, CLASH)).collect()), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_katz_without_training(docs):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    got = katz.op9(docs([(i, "some words") for i in held])).collect()
    assert {(r.n_known, r.train_tokens, r.score) for r in got} == {(0, 0, 0.0)}
    assert katz.op9(docs([])).collect() == []


# ----------------------------------------------------- language and grades

def test_language_id_held_out(spark, docs):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op10(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 150 and sum(r.lang_pred == r.lang for r in got) >= 0.99 * len(got)
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) <= 0.1 * len(got)


def test_language_id_learns_rare_langs_and_whole_texts(docs):
    rng = random.Random(6)
    say = lambda letters, n: " ".join("".join(rng.choices(letters, k=5)) for _ in range(n))
    rows = [(i, say("abcde", 12), "aa") for i in range(4000)]
    rows += [(5000 + i, say("klmno", 12), "kk") for i in range(5)]
    rows += [(6000 + i, say("abcde", 400) + " " + say("vwxyz", 1600), "vv") for i in range(60)]
    model = langid.learn(docs(rows), max_rows=300)
    assert model.langs == ["aa", "kk", "vv"]
    assert langid.predict(model, say("vwxyz", 12).encode())[0] == "vv"


def test_language_id_edges(docs):
    rows = [(i, "the and with of in" if i % 2 else "der die das und ist", "en" if i % 2 else "de") for i in range(60)]
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 34 !?", "en"), (903, "the and", None), (None, "und ist das", "de"),
             (904, "é", "en"), (905, "the and " * 40_000, "en"), (905, "the and", "en")]
    got = {r.doc_id: r for r in langid.op10(docs(rows, CLASH)).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902, 903, None, 905)] == ["und", "und", "und", "en", "de", "en"]
    assert got[904].lang_pred in ("en", "de") and got[900].score == 0.0
    assert {r.lang_pred for r in langid.op10(docs([(1, "the", None)])).collect()} == {"und"}
    assert langid.op10(docs([])).collect() == []


def test_grades_held_out(spark, docs):
    base = "/root/testdata/sf0.1"
    df, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    fit = labels.filter("doc_id % 3 <> 0")
    got = (grading.grade(df.select("doc_id", "text"), grading.learn(df, fit, 2500))
           .join(labels.filter("doc_id % 3 = 0"), "doc_id").collect())
    clean = [r for r in got if r.quality == 1 and not r.toxic]
    toxic = [r for r in got if r.toxic]
    low = [r for r in got if r.quality == 0 and not r.toxic]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert sum(not r.kept for r in toxic) >= 0.9 * len(toxic)
    assert sum(not r.kept for r in low) >= 0.75 * len(low)
    mean = lambda rows: sum(r.expected_grade for r in rows) / len(rows)
    assert mean(toxic) < mean(low) < mean(clean)


def test_grades_edges(spark, docs):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    rows = [(i, "good plain words" if i % 2 else "bad ### $$$") for i in range(40)] + [(90, None), (91, ""), (None, "x"),
                                                                                   (3, "good plain words")]
    rated = [(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (7, None, 1), (8, 1, None), (777, 1, 1), (3, 1, 0)]
    got = grading.op7(docs(rows, ("grade", "kept", "buckets")), labels(rated)).collect()
    assert len(got) == len(rows) and all(0 <= r.expected_grade <= 2 for r in got)
    none = grading.op7(docs(rows), labels([])).collect()
    assert all(r.kept and r.expected_grade is None for r in none)
    assert grading.op7(docs([]), labels(rated)).collect() == []
