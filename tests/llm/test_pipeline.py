"""The pipeline's stages beside brute force, each on its own input, and the query registry."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import test_models as m
import test_native as n

import __spark_entry__ as entry
from sitegauge.llm import rules

SF = "/root/testdata/sf0.001"


def plain(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_stages_beside_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "near duplicates", "source mix", "best-fit packing"]
    stages = dict(corpus_pipeline.STAGES)

    # Every stage gets what the one before kept, as rows that no longer depend on it.
    def step(name, rows):
        out = stages[name](spark, spark.createDataFrame(rows, docs.schema), SF)
        if name != names[-1]:
            assert out.columns == docs.columns
        return out.collect()

    rows = docs.collect()
    good = step("quality rules", rows)
    want = []
    for d, text in plain(rows):
        env = dict(zip(rules.MEASURES, n.measured(text)))
        if not any(eval(fails, {}, env) for _, fails in rules.RULES):
            want.append((d, text))
    assert Counter(plain(good)) == Counter(want) and 0 < len(good) < len(rows)

    lines = step("line dedup", good)
    assert Counter(plain(lines)) == Counter((d, t) for d, _, _, t in n.line_dedup(plain(good)))

    # Line dedup empties most copies of the small table, so the stage gets its input before that too.
    for before in (good, lines):
        single = step("near duplicates", before)
        kept = {d for d, size, c, keep in m.groups(plain(before)) if keep}
        assert Counter(plain(single)) == Counter(r for r in plain(before) if r[0] in kept)
        assert before is lines or len(single) < len(good)

    mixed = step("source mix", single)
    sizes, taken = Counter(), Counter()
    for r in single:
        sizes[r.source] += len(n.words(r.text))
    texts = {r.doc_id: r.text for r in single}
    for r in mixed:
        taken[r.source] += len(n.words(r.text))
        assert texts[r.doc_id].startswith(r.text)
    for s, target in n.targets(sizes).items():
        assert abs(taken[s] - target) <= 0.5

    packed = step("best-fit packing", mixed)
    places, pieces = defaultdict(list), Counter()
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id] += r.piece == 0
    assert pieces == Counter(r.doc_id for r in mixed)
    for p in places.values():
        p.sort()
        assert p[0][0] == 0 and all(a + k == b for (a, k), (b, _) in zip(p, p[1:])) and sum(p[-1]) <= 2048


def test_run_and_registry(spark):
    queries = entry.queries()
    numbers = {int(q[1]) for name in queries if (q := re.match(r"op(\d+)_", name))}
    assert numbers == set(range(1, 14)) and "pipeline" in queries
    assert queries["pipeline"](spark, SF).count() > 100
